"""Resampling to a target by distinct lines, against counting every document alone."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from datamove.llm import target

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def buckets(text, ngram, many):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % many for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]


def brute(docs, aims, ngram, many, least, share, seed):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(buckets(text, ngram, many))
    for text in aims:
        t.update(buckets(text, ngram, many))
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + many) / ((s[b] + 1) * (T + many)))) for b in range(many)}
    out = []
    for key, text in docs:
        found = buckets(text, ngram, many)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        score = None
        if key is not None:
            h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(found), weight, score, None, len(words(text))])
    fit = sorted((r for r in out if r[0] is not None and r[5] >= least), key=lambda r: (-r[3], r[0], r[1]))
    for rank, row in enumerate(fit[: int(share * len(fit) + 1e-9)], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def some(n, seed=3):
    rng = random.Random(seed)
    vocabulary = ["The", "cat", "Émile", "42", "don't", "x-y", "straße", "日本", "a" * 80, "q"]
    lines = ["", " ", "A common line, seen often", *[" ".join(rng.choices(vocabulary, k=rng.randrange(12))) for _ in range(20)]]
    docs = [(i, "\n".join(rng.choices(lines, k=rng.randrange(8)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (n + 2, "\n\n"), (None, "The cat\nThe cat"), (5, docs[5][1]), (6, "other"), (n + 3, "one two\r\nthree " * 9000)]


@pytest.mark.parametrize("ngram", [1, 2, 3])
def test_equals_counting_each_document(spark, ngram):
    docs, aims = some(150), ["The cat sat", "42 straße\nThe cat", None, ""]
    options = {"ngram": ngram, "buckets": 500, "least_words": 4, "share": 0.3, "seed": 7}
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = target.resample_to(frame, spark.createDataFrame([(a,) for a in aims], "text string"), **options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, aims, ngram, 500, 4, 0.3, 7)


def test_hot_lines_change_nothing(spark, monkeypatch):
    docs, aims = some(60), ["The cat"]
    frame, aim = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(a,) for a in aims], "text string")
    want = brute(docs, aims, 1, 10_000, 20, 0.1, 2024)
    for share, most in ((1e-4, 10_000), (0.05, 10_000), (1.0, 10_000), (1e-4, 2)):
        monkeypatch.setattr(target, "HOT_SHARE", share)
        monkeypatch.setattr(target, "HOT_LINES", most)
        assert sorted(map(tuple, target.resample_to(frame, aim).collect()), key=repr) == want


def test_each_distinct_line_is_counted_once(spark):
    frame = spark.createDataFrame([(i, "same line here\nown %d" % i) for i in range(50)], "doc_id bigint, text string").repartition(5)
    lines = target.distinct_lines(frame, "text", 1, 100)
    assert lines.count() == 51
    assert lines.where("times = 50").select("words").collect()[0][0] == 3
    assert target.bucket_counts(lines, 100).sum() == 50 * 5


def test_empty_tables_clashing_names_and_shares(spark):
    kind = "doc_id bigint, text string, n bigint, gain string, words string, line string, row string, buckets string, score string, rank string"
    docs = [(i, "w%d " % i * 25, i, *["x"] * 7) for i in range(20)]
    frame, none = spark.createDataFrame(docs, kind), spark.createDataFrame([], "text string")
    want = brute([d[:2] for d in docs], [], 1, 10_000, 20, 0.1, 2024)
    assert sorted(map(tuple, target.resample_to(frame, none).collect()), key=repr) == want
    assert target.resample_to(frame.limit(0), none).collect() == []
    assert target.resample_to(frame, none, share=0).where("rank is not null").count() == 0
    assert target.resample_to(frame, none, share=1).where("rank is not null").count() == 20
    with pytest.raises(ValueError):
        target.resample_to(frame, none, ngram=0)


def test_registers_are_crc32():
    parts = [b"", b"a", b"caf\xc3\xa9", b"x" * 300, bytes(range(1, 60))]
    data = np.frombuffer(b"".join(parts), np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    got = ~target.crc_on(np.full(len(parts), 0xFFFFFFFF, np.uint32), data, starts, ends)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
