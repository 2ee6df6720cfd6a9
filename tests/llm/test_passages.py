"""Benchmark passages against a search of every window at every place."""

import random
import re

import pytest
from pyspark.sql import functions as F

from datamove.llm import decontaminate
from datamove.llm.decontaminate import find_passages

DOCS = "doc_id long, text string, n_words string, spans int"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window):
    w, hit, found = words(text), set(), set()
    for name, body in items:
        b = words(body)
        size = min(window, len(b))
        for i in range(len(b) - size + 1 if size else 0):
            for at in range(len(w) - size + 1):
                if w[at : at + size] == b[i : i + size]:
                    hit.update(range(at, at + size))
                    found.add(str(name))
    return len(w), hit, sorted(found)


def run(spark, docs, items, window=4):
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(docs)], DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {r["doc_id"]: r for r in find_passages(frame, benchmark, ["doc_id"], window=window).collect()}


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_matches_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "É", "zwölf", "7", "A"]
    draw = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", " ...", "\n"]) for _ in range(n))
    items = [(i, draw(rng.choice([1, 2, 3, 6, 9]))) for i in range(12)] + [(3, draw(5)), (90, None), (91, ""), (None, "a b c"), (92, "!!")]
    docs = [draw(n) for n in (0, 1, 3, 4, 5, 30, 700, 30)] + [None, "", items[4][1], items[4][1]]
    named = [(i, t) for i, t in items if i is not None]
    found = run(spark, docs, items)
    for i, text in enumerate(docs):
        n, hit, ids = brute(text, named, 4)
        covered = {k for s in found[i]["spans"] for k in range(s["start"], s["end"])}
        assert (found[i]["n_words"], covered, found[i]["items"]) == (n, hit, ids)


def test_long_texts_and_full_windows(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = ["x " * 5000 + " ".join(f"W{i}" for i in range(5, 15)) + " y" * 700, " ".join(f"w{i}" for i in range(9)), item.upper() * 2]
    found = run(spark, docs, [(1, item)], window=10)
    assert [sum(s["end"] - s["start"] for s in found[i]["spans"]) for i in range(3)] == [10, 0, 58]


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert find_passages(nothing, items, ["doc_id"]).collect() == []
    one = spark.createDataFrame([(1, "a b", "x", 1)], DOCS)
    row = find_passages(one, items, ["doc_id", "text"]).first()
    assert (row["n_words"], row["spans"], row["items"], row["text"]) == (2, [], [], "a b")
    assert one.select(F.size(F.array())).count() == 1
