"""The pipeline's stages in order, each against a plain check of its own input."""

import os
import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from datamove.llm import queries  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _firsts(texts):
    """The smallest id of each group of texts that share four fifths of their runs of five words, and texts without words."""
    sets = {}
    for i, t in texts.items():
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(len(w) - 4, 1))} if w else set()
    group = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and a and 0.8 * len(a) <= len(b) and 0.8 * len(b) <= len(a) and 10 * len(a & b) >= 8 * len(a | b) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    return set(group.values())


def test_stages_and_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "copies", "benchmark", "tokens"]
    before, columns = {r["doc_id"] for r in docs.collect()}, docs.columns
    path = os.path.join(os.path.dirname(sf_dir), os.path.basename(sf_dir))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, path)
        assert kept.columns == columns
        ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
        assert set(ids) <= before and len(ids) == len(set(ids))
        if name == "copies":
            assert set(ids) == _firsts({r["doc_id"]: r["text"] for r in docs.collect()})
        if name == "benchmark":
            hits = {r["doc_id"] for r in queries.op1_decontaminate(spark, path).where("contaminated").collect()}
            assert set(ids) == before - hits
        before = set(ids)
        # A stage's rows are read twice by the next one.
        docs = spark.createDataFrame(kept.collect(), SCHEMA)
    out = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in out} == before
    assert all(r["ids_sha256"] and r["n_tokens"] >= 0 for r in out)


def test_stages_take_empty_tables_and_nulls(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some text here", None, "s", 3), (2, "", "en", "s", 0)]
    for docs in (spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows, SCHEMA)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, str(tmp_path)).collect()


def test_stages_keep_columns_of_any_name(spark, tmp_path, sf_dir):
    names = ["score", "languages", "lang_pred", "kept", "log_ratio", "gumbel_key", "spans", "items", "n_words", "id", "a", "b", "component", "row"]
    rows = [(i, f"some words of text {i} that nobody repeats at all", *[str(i)] * len(names)) for i in range(5)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in [*names, "lang"]))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        assert kept.columns == docs.columns
        assert all(r["score"] == str(r["doc_id"]) for r in kept.collect())


def test_held_out_is_never_null(spark, tmp_path):
    spark.createDataFrame([(None, "some text", "en"), (1, "more text", "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (queries.op2_toxicity, queries.op9_language_mixture):
        assert {type(r["held_out"]) for r in query(spark, str(tmp_path)).collect()} == {bool}


def test_copies_by_five_words_and_four_fifths(spark, tmp_path):
    words = [f"w{i}" for i in range(100)]
    near = words[:95] + [f"x{i}" for i in range(5)]
    changed = words[:50] + ["y"] + words[51:93]
    twice = words[:20] + ["z"] + words[21:60] + ["z"] + words[61:]
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate((words, near, changed, twice))]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (words, near, changed, twice)]
    alike = [len(sets[0] & s) / len(sets[0] | s) for s in sets]
    assert 0.8 <= alike[2] < 0.9 and 0.8 <= alike[3] < 0.9
    kept = dict(corpus_pipeline.STAGES)["copies"](spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path))
    assert [r["doc_id"] for r in kept.collect()] == [0]


def test_each_group_of_a_repeated_id_keeps_a_row(spark, tmp_path):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (5, b), (5, c), (6, c), (7, None), (7, ""), (8, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    kept = [(r["doc_id"], r["text"] or "") for r in dict(corpus_pipeline.STAGES)["copies"](spark, docs, str(tmp_path)).collect()]
    assert sorted(kept) == [(1, a), (5, b), (5, c), (7, ""), (8, "")]
