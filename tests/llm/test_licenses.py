"""Licence scans against plain Python over lists of words."""

import math
import re

from datamove.llm.licenses import PHRASES, TEMPLATES, scan_licenses

SCHEMA = "doc_id long, text string, n_words string, labels string"
LEAST = 0.8


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def starts(w, phrase):
    p = phrase.split()
    return [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]


def brute(texts):
    docs = [words(t) for t in texts]
    vocabulary = {w for t in TEMPLATES for w in t.text.split()}
    idf = {w: math.log((len(docs) + 1) / (sum(w in d for d in docs) + 1)) + 1e-9 for w in vocabulary}
    out = []
    for w in docs:
        places = {label: (starts(w, p)) for p, label in PHRASES.items()}
        every = [i for found in places.values() for i in found]
        labels, best = {k for k, v in places.items() if v}, 0.0
        for t in TEMPLATES:
            parts = t.text.split()
            total = sum(idf[p] for p in parts)
            near = [sum(idf[p] for k, p in enumerate(parts) if 0 <= i + k < len(w) and w[i + k] == p) / total for i in range(-len(parts), len(w))]
            if near and max(near) >= LEAST and all(starts(w, k) for k in t.key_phrases):
                labels.add(t.label)
                best = max(best, max(near))
        first, last = (min(every), max(every)) if every else (None, None)
        out.append((len(w), len(every), first, last, sorted(k for k, v in places.items() if v), sorted(labels), 1.0 if every else best))
    return out


TEXTS = [
    None, "", "...", "Nothing here.", "CC BY", "cc-by cc by, CC/BY x", "All  rights\nreserved. All rights reserved", "accby cc byx",
    "Text. Licensed under the Apache License, Version 2.0.", "Apache License. the the the", "licensed under a apache license version 2 0",
    "Licensed under the GNU General Public License, version 3.", "foo general public license", "über CC BY NC 4.0 licensed under cc by-nc 4.0 end",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and more", "plain words " * 3000 + "cc by",
]


def test_matches_plain_python(spark):
    texts = TEXTS + TEXTS[4:9] + [f"filler text {i}" for i in range(20)]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    found = {r["doc_id"]: r for r in scan_licenses(frame, ["doc_id"]).collect()}
    assert len(found) == len(texts)
    for i, want in enumerate(brute(texts)):
        got = tuple(found[i][c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels"))
        assert got == want[:-1], texts[i]
        assert math.isclose(found[i]["score"], want[-1], abs_tol=1e-9)


def test_empty_table_and_plan(spark, plan):
    frame = spark.createDataFrame([], SCHEMA)
    found = scan_licenses(frame, ["doc_id"])
    assert found.collect() == []
    assert not re.search("Python|Pandas|Arrow|Exchange", plan(found))
