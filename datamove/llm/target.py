"""Documents drawn by their likeness to a target, with the features of repeated lines counted once.

Texts are cut into lines at newlines, which no word reaches over.  Each distinct line of all documents has its
n-grams put into buckets once; counts over the corpus are those of the distinct lines times their
occurrences, and a document's sum of gains is that of its lines.  N-grams that reach over a newline
belong to no line and are added for each document separately.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from datamove.llm.arrow import map_texts, quoted, ship_code, staged, text_slices
from datamove.llm.words import ALNUM, LOWER, spans

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 0.1
SEED = 2024

# A line with more than this share of all occurrences is sent to every task, so there are fewer than 10,000.
HOT_SHARE = 1e-4
HOT_LINES = 10_000

# Words longer than this are summed one by one.
SHORT = 64

NEWLINE = 10


def _crc_table() -> np.ndarray:
    """What one byte does to a crc32 register; 0xEDB88320 is the polynomial, a fixed value."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def crc_on(register: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 registers after the bytes of each span."""
    register = register.copy()
    alive = np.flatnonzero(ends - starts <= SHORT)
    depth = 0
    while len(alive):
        alive = alive[starts[alive] + depth < ends[alive]]
        now = register[alive]
        register[alive] = (now >> 8) ^ CRC[(now ^ data[starts[alive] + depth]) & 0xFF]
        depth += 1
    full = np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(ends - starts > SHORT).tolist():
        register[i] = full ^ np.uint32(zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(full ^ register[i])))
    return register


def features(data: np.ndarray, offsets: np.ndarray, ngram: int, buckets: int, across: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the runs of 1 to ``ngram`` words, the n + 1 offsets of texts among them, and words of each text.

    With ``across`` only the runs that reach over a newline.
    """
    data = LOWER[data]
    starts, ends, of = spans(data, offsets, ALNUM)
    words = np.diff(of)
    text = np.repeat(np.arange(len(words)), words)
    line = np.searchsorted(np.flatnonzero(data == NEWLINE), starts) if across else None
    register = crc_on(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, ends)
    found, owner = [], []
    for size in range(1, ngram + 1):
        if size > 1:
            # The word after, behind one space, for runs that have one in their text.
            whole = np.flatnonzero(text[: max(len(text) - size + 1, 0)] == text[size - 1 :])
            register = register[whole] if size == 2 else register[np.searchsorted(at, whole)]
            register = (register >> 8) ^ CRC[(register ^ 0x20) & 0xFF]
            register = crc_on(register, data, starts[whole + size - 1], ends[whole + size - 1])
            at = whole
        else:
            at = np.arange(len(starts))
        wanted = line[at] != line[at + size - 1] if across else slice(None)
        found.append((~register[wanted]).astype(np.int64) % buckets)
        owner.append(text[at[wanted]])
    found, owner = np.concatenate(found), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(words) + 1)), words


def _packed(found: np.ndarray, of: np.ndarray, kind: type) -> pa.Array:
    raw = found.astype(kind).tobytes()
    size = np.dtype(kind).itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(of) - 1, [None, pa.py_buffer((of * size).astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())


def _kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def _with_features(df: DataFrame, text: str, keep: list[str], ngram: int, buckets: int, across: bool) -> DataFrame:
    """The ``keep`` columns with ``words`` and ``buckets``, the packed buckets of all features."""

    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            words, packed = [pa.array([], pa.int64())], [pa.array([], pa.binary())]
            for _, _, data, offsets in text_slices(column):
                found, of, n = features(data, offsets, ngram, buckets, across)
                words.append(pa.array(n, pa.int64()))
                packed.append(_packed(found, of, _kind(buckets)))
            yield [pa.concat_arrays(words), pa.concat_arrays(packed)]

    return map_texts(df, text, keep, [("words", "bigint"), ("buckets", "binary")], work)


def _lines(docs: DataFrame, text: str) -> Column:
    return F.split(F.coalesce(quoted(text).cast("string"), F.lit("")), "\n")


def distinct_lines(docs: DataFrame, text: str, ngram: int, buckets: int) -> DataFrame:
    """Each distinct line once, written: ``line``, a digest, with ``times``, ``words`` and ``buckets``."""
    lines = docs.select(F.explode(_lines(docs, text)).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    lines = lines.withColumn("digest", F.unhex(F.md5("line")))
    made = _with_features(lines, "line", ["digest", "times"], ngram, buckets, False)
    return staged(made.withColumnRenamed("digest", "line"), "lines")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; rows have ``times`` and packed ``buckets``.  One row a bucket and task is shuffled."""
    kind = _kind(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            times = batch.column(0).to_numpy()
            packed = batch.column(1).cast(pa.large_binary())
            sizes = np.array([0 if x is None else len(x.as_buffer()) for x in packed], np.int64) // np.dtype(kind).itemsize
            found = np.frombuffer(b"".join(x.as_py() or b"" for x in packed), kind)
            weight = np.repeat(times, sizes)
            once = weight == 1
            total += np.bincount(found[once], minlength=buckets)
            np.add.at(total, found[~once], weight[~once])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = rows.select("times", "buckets").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for row in counted.collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares in target and source, rounded down."""
    many = float(len(source))
    ratio = (target + 1.0) * (float(source.sum()) + many) / ((source + 1.0) * (float(target.sum()) + many))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _gained(rows: DataFrame, keep: list[str], table: np.ndarray) -> DataFrame:
    """The ``keep`` columns with ``n``, the number of features, and ``gain``, their sum."""
    ship_code(rows.sparkSession)
    shared, kind = rows.sparkSession.sparkContext.broadcast(table), _kind(len(table))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema) + ", n bigint, gain bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(len(keep)).cast(pa.large_binary()).fill_null(b"")
            of = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1]
            raw = packed.buffers()[2]
            found = np.frombuffer(raw, np.uint8)[of[0] : of[-1]].view(kind) if raw is not None else np.zeros(0, kind)
            of = (of - of[0]) // np.dtype(kind).itemsize
            sums = np.concatenate(([0], np.cumsum(shared.value[found])))
            columns = [*batch.columns[: len(keep)], pa.array(np.diff(of)), pa.array(sums[of[1:]] - sums[of[:-1]])]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n", "gain"])

    return rows.select(*keep, "buckets").mapInArrow(run, schema)


def resample_to(
    docs: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    ngram: int = 1,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    share: float = SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Every document's weight, noisy score and place in the draw.

    Returns the key with ``n_features``, ``weight``, ``score`` and ``rank``.  Features are the runs
    of 1 to ``ngram`` words of letters and digits, repeats counted; ``weight`` is the mean of
    their buckets' gains, rounded down, 0 without features; ``score`` adds noise that depends on
    the key and seed alone. Of the documents with an id and at least ``least_words`` words the
    ``share`` with the highest scores is drawn, ties to the smaller key, and ranked from 1; the rank of
    others is null.

    Null texts have no words, and one empty line.  A row without a key has a null score and is not
    drawn or counted.  Repeated rows count each time and share their noise.  Without target texts, or
    without documents, all target counts are 0 or the result is empty.  Only ``key`` and ``text`` are
    read, so other columns may have any name.  Texts of any length are taken whole.
    """
    if ngram < 1 or buckets < 1 or not 0 <= share <= 1:
        raise ValueError("ngram and buckets must be at least 1, and share from 0 to 1")
    ship_code(docs.sparkSession)
    lines = distinct_lines(docs, text, ngram, buckets)
    source = bucket_counts(lines, buckets)
    target_lines = distinct_lines(target, target_text, ngram, buckets)
    aim = bucket_counts(target_lines, buckets)

    own = docs.select(quoted(key).alias("id"), quoted(text).cast("string").alias("text"))
    if ngram > 1:
        own = _with_features(own, "text", ["id", "text"], ngram, buckets, True)
        crossing = _with_features(target.select(quoted(target_text).alias("text")), "text", [], ngram, buckets, True)
        aim = aim + bucket_counts(crossing.withColumn("times", F.lit(1).cast("bigint")), buckets)
    else:
        own = own.withColumn("buckets", F.lit(b""))
    digests = F.transform(_lines(own, "text"), lambda line: F.unhex(F.md5(line)))
    # Written once, so that rows keep their numbers.
    own = staged(own.select("id", F.monotonically_increasing_id().alias("row"), digests.alias("lines"), "buckets"), "documents")
    if ngram > 1:
        source = source + bucket_counts(own.select(F.lit(1).cast("bigint").alias("times"), "buckets"), buckets)
    table = gains(source, aim)

    valued = _gained(lines, ["line", "times", "words"], table)
    total = lines.agg(F.sum("times")).first()[0] or 0
    common = valued.where(F.col("times") > HOT_SHARE * total).drop("times")
    hot = F.broadcast(common.limit(HOT_LINES).select("line", *[F.col(c).alias(f"hot_{c}") for c in ("words", "n", "gain")]))
    # Occurrences of common lines are answered here and need no partner in the shuffle.
    seen = own.select("id", "row", F.explode("lines").alias("line")).join(hot, "line", "left")
    seen = seen.withColumn("line", F.when(F.col("hot_n").isNotNull(), F.concat(F.lit("row "), F.col("row").cast("string")).cast("binary")).otherwise(F.col("line")))
    seen = seen.join(valued.drop("times").hint("merge"), "line", "left")
    parts = seen.select("id", "row", *[F.coalesce(f"hot_{c}", c).alias(c) for c in ("words", "n", "gain")])
    if ngram > 1:
        crossed = _gained(own, ["id", "row"], table)
        parts = parts.unionByName(crossed.withColumn("words", F.lit(0).cast("bigint")))
    sums = parts.groupBy("row").agg(F.max("id").alias("id"), *[F.sum(c).alias(c) for c in ("words", "n", "gain")])
    return _drawn(sums, seed, least_words, share).withColumnsRenamed({"id": key})


def _drawn(sums: DataFrame, seed: int, least_words: int, share: float) -> DataFrame:
    weight = F.when(F.col("n") > 0, F.expr("(gain - pmod(gain, n)) div n")).otherwise(F.lit(0).cast("bigint"))
    chance = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(-1000 * F.log(-F.log((chance + 0.5) / 4294967296.0)))
    scored = sums.withColumn("weight", weight)
    scored = scored.select("id", "words", F.col("n").alias("n_features"), "weight", (F.col("weight") + noise).alias("score"))
    scored = staged(scored, "scores")
    fit = (F.col("words") >= least_words) & F.col("score").isNotNull()
    # Weights and noise are whole and bounded by logs of 64-bit counts: there are some 200,000 scores at most.
    counts = sorted(((r["score"], r["count"]) for r in scored.where(fit).groupBy("score").count().collect()), reverse=True)
    wanted = int(Fraction(str(share)) * sum(n for _, n in counts))
    before, offsets = 0, []
    for score, n in counts:
        if before >= wanted:
            break
        offsets.append((score, before))
        before += n
    named = ["id", "n_features", "weight", "score"]
    if not offsets:
        return scored.select(*named, F.lit(None).cast("bigint").alias("rank"))
    least = offsets[-1][0]
    ahead = F.broadcast(scored.sparkSession.createDataFrame(offsets, "score bigint, ahead bigint"))
    # Noise spreads rows over scores, whatever they have in common, so no score has many.
    place = F.expr("row_number() OVER (PARTITION BY score ORDER BY id, n_features)").cast("bigint")
    placed = scored.where(fit & (F.col("score") >= least)).withColumn("place", place).join(ahead, "score")
    rank = F.col("ahead") + F.col("place")
    drawn = placed.select(*named, F.when(rank <= wanted, rank).alias("rank"))
    rest = scored.where(~F.coalesce(fit & (F.col("score") >= least), F.lit(False)))
    return drawn.unionByName(rest.select(*named, F.lit(None).cast("bigint").alias("rank")))
