"""Licence notices in texts, found by their rarest words and the places of these.

The index lists for each word of the licence templates where in which template it stands, and
its inverse document frequency over all documents.  A text's highest-IDF licence words are
looked up there; a word at place i that a template has at place p puts that template's start
at i - p; the starts are scored by the weight of all template words in place.  A template counts
when enough of its weight is there and its key phrases stand in the text.

Built from column functions alone; a text's words never leave its row.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from datamove.llm.arrow import quoted
from datamove.llm.urlfilter import lowered

# Phrases that give a label wherever their words stand consecutively, fixed values.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key_phrases: tuple[str, ...]


# Notices as their licences word them, fixed values.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
)

# Bytes that part words, after A-Z is lowered, fixed values.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

GAP = "  "


def spaced(text: Column) -> Column:
    """Every word with a space of its own on either side: `` a  b  c ``; empty without words."""
    bare = F.trim(F.regexp_replace(lowered(F.coalesce(text, F.lit(""))), BETWEEN, GAP))
    return F.when(bare == "", "").otherwise(F.concat(F.lit(" "), bare, F.lit(" ")))


def spaced_phrase(phrase: str) -> str:
    return f" {GAP.join(phrase.split())} "


def count_words(spaced_text: Column) -> Column:
    return ((F.octet_length(spaced_text) - F.octet_length(F.replace(spaced_text, F.lit(" "), F.lit("")))) / 2).cast("long")


def _places(text: Column, n_words: Column, phrase: str) -> Column:
    """How often the phrase stands in a spaced text, and its first and last start."""
    pieces = F.split(text, spaced_phrase(phrase), -1)
    first, last = count_words(F.get(pieces, F.lit(0))), count_words(F.element_at(pieces, -1))
    found = F.struct(
        (F.size(pieces) - 1).cast("long").alias("n"),
        first.alias("first"),
        (n_words - last - len(phrase.split())).alias("last"),
    )
    return F.when(F.contains(text, F.lit(spaced_phrase(phrase))), found)


def _words(column: Column) -> Column:
    """A spaced text's words; one empty word where there are none."""
    return F.split(F.trim(column), GAP)


def _literals(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _weights(idf: Mapping[str, float]) -> Column:
    return F.map_from_arrays(_literals(list(idf)), F.array(*[F.lit(v) for v in idf.values()]))


def word_weights(docs: DataFrame, text: str, words: Sequence[str]) -> dict[str, float]:
    """The inverse document frequency of each of ``words`` over all documents.

    What reaches the driver is one count for each word.
    """
    present = docs.select(F.array_intersect(_words(spaced(quoted(text))), _literals(words)).alias("w"))
    # The empty word counts all documents.
    seen = present.select(F.explode(F.concat(F.array(F.lit("")), "w")).alias("w")).groupBy("w").count()
    counts = {r["w"]: r["count"] for r in seen.collect()}
    total = counts.get("", 0)
    return {w: math.log((total + 1) / (counts.get(w, 0) + 1)) + 1e-9 for w in words}


def _match(template: Template, idf: Mapping[str, float], present: Column, words: Column, text: Column, weights: Column, anchors: int, least: float) -> Column:
    """The template's best start and score in a text, null unless the score and key phrases do."""
    parts = template.text.split()
    total = sum(idf[w] for w in parts)
    # Only templates that could reach the score are placed.
    could = F.aggregate(F.filter(present, lambda w: F.array_contains(_literals(sorted(set(parts))), w)), F.lit(0.0), lambda s, w: s + weights[w] * F.lit(1.0))
    repeats = max(parts.count(w) for w in parts)
    rare = F.slice(F.sort_array(F.transform(F.array_intersect(present, _literals(sorted(set(parts)))), lambda w: F.struct((-weights[w]).alias("i"), w.alias("w")))), 1, anchors)
    rare_words = F.transform(rare, lambda r: r["w"])
    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(rare_words, h["w"]))
    postings = F.map_from_arrays(
        _literals(sorted(set(parts))),
        F.array(*[F.array(*[F.lit(p) for p, x in enumerate(parts) if x == w]) for w in sorted(set(parts))]),
    )
    starts = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(postings[h["w"]], lambda p: h["i"] - p))))

    def score(start: Column) -> Column:
        placed = [F.when(F.get(words, start + p) == w, idf[w]).otherwise(0.0) for p, w in enumerate(parts)]
        return functools.reduce(operator.add, placed) / total

    scored = F.transform(starts, lambda s: F.struct(score(s).alias("score"), (-s).alias("at")))
    best = F.array_max(scored)
    found = F.struct(F.lit(template.label).alias("label"), (-best["at"]).cast("long").alias("start"), best["score"].alias("score"))
    keys = functools.reduce(operator.and_, [F.contains(text, F.lit(spaced_phrase(k))) for k in template.key_phrases], F.lit(True))
    return F.when(could * repeats >= least * total, F.when((best["score"] >= least) & keys, found))


def scan_licenses(
    docs: DataFrame,
    keep: Sequence[str],
    *,
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[Template] = TEMPLATES,
    anchors: int = 4,
    least: float = 0.8,
) -> DataFrame:
    """Licence phrases and templates in each document.

    Returns the ``keep`` columns with ``n_words``; ``n_base``, ``first_word`` and ``last_word``,
    how often ``phrases`` stand in the text and where the first and the last start;
    ``base_labels`` of these; ``matches``, each template found with its start and score;
    ``labels`` of both kinds; and ``score``, 1 where a phrase stands, else the best of the
    templates, else 0.  A template's best place is the highest score, the first of equals.

    Null and empty texts have no words, no places and no labels; the label lists are then empty
    and the places null.  Repeated rows are each scanned.  Rows neither move nor meet: the
    counts of the few template words are the only shuffle.
    """
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    idf = word_weights(docs, text, vocabulary)
    weights = _weights(idf)
    base = docs.select(*[quoted(c) for c in keep], spaced(quoted(text)).alias("__text__"))
    base = base.withColumn("__n__", count_words(F.col("__text__")))
    for i, phrase in enumerate(phrases):
        base = base.withColumn(f"__p{i}__", _places(F.col("__text__"), F.col("__n__"), phrase))
    base = base.withColumn("__words__", _words(F.col("__text__")))
    base = base.withColumn("__present__", F.array_intersect("__words__", _literals(vocabulary)))
    columns = [F.col(c) for c in ("__present__", "__words__", "__text__")]
    matches = [_match(t, idf, *columns, weights, anchors, least) for t in templates]
    base = base.withColumn("__matches__", F.array_compact(F.array(*matches)))
    places = [F.col(f"__p{i}__") for i in range(len(phrases))]
    base_labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(p.isNotNull(), label) for p, label in zip(places, phrases.values())]))))
    n_base = functools.reduce(operator.add, [F.coalesce(p["n"], F.lit(0)) for p in places])
    score = F.when(n_base > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("__matches__", lambda m: m["score"])), F.lit(0.0)))
    return base.select(
        *[quoted(c) for c in keep],
        F.col("__n__").alias("n_words"),
        n_base.cast("long").alias("n_base"),
        F.array_min(F.array(*[p["first"] for p in places])).alias("first_word"),
        F.array_max(F.array(*[p["last"] for p in places])).alias("last_word"),
        base_labels.alias("base_labels"),
        F.col("__matches__").alias("matches"),
        F.array_sort(F.array_union(base_labels, F.transform("__matches__", lambda m: m["label"]))).alias("labels"),
        score.alias("score"),
    )
