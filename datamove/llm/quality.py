"""Texts chosen by importance resampling: how much likelier they are in good text than in any.

Two generative models over hashed n-grams, one of texts labelled good and one of all texts,
give each text the log of the ratio of its probabilities.  Adding Gumbel noise to that and
taking the k largest draws k texts without replacement in proportion to the ratio.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from datamove.llm.arrow import TEXT, map_texts, quoted, ship_code, staged, text_slices, tidied
from datamove.llm.words import ALNUM, LOWER, SOLID, U, hashes, joined, mix, spans

BUCKETS = 1 << 16

# Labelled rows that the model of good text is fitted on, those with the smallest hashes.
MOST_LABELLED = 50_000

# Bins in one round of looking for the k-th largest key.
BINS = 1024

UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
MARK = np.where(ALNUM | UPPER, 0, mix(np.arange(1, 257, dtype=U)))


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each text, and each one's text.

    Two views of the words, each as single words and as pairs: the letters, and the style, which
    is the marks in a word, its capitals, and whether it repeats the word before.
    """
    starts, ends, of = spans(data, offsets, SOLID)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(of) - 1), np.diff(of))
    word = hashes(LOWER[data], starts, ends)

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))
        return sums[ends] - sums[starts]

    upper, letters = total(UPPER[data].astype(np.int32)), total(LETTER[data].astype(np.int32))
    shape = np.where(letters == 0, 3, np.where(upper == 0, 0, np.where((upper >= 2) & (2 * upper >= letters), 2, 1)))
    follows = np.concatenate(([False], text[1:] == text[:-1]))
    repeats = follows & np.concatenate(([False], word[1:] == word[:-1]))
    style = mix(total(MARK[data]) + (shape * 2 + repeats).astype(U) * U(0x9E3779B97F4A7C15))
    pair = np.flatnonzero(follows)
    grams = [
        mix(word + U(1)),
        mix(style + U(2)),
        mix(joined(word[pair - 1], word[pair]) + U(3)),
        mix(joined(style[pair - 1], style[pair]) + U(4)),
    ]
    return (np.concatenate(grams) >> U(48)).astype(np.int64), np.concatenate((text, text, text[pair], text[pair]))


def learn_ratio(docs: DataFrame, good: Column, *, text: str = "text", smoothing: float = 2.0) -> np.ndarray:
    """Log of each bucket's probability where ``good`` holds over that in all documents.

    Tasks add up their counts before the shuffle; the driver gets two numbers a bucket.
    """
    ship_code(docs.sparkSession)
    source = docs.select(F.coalesce(good, F.lit(False)).alias("good"), quoted(text).cast("string").alias(TEXT))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, liked = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            flags = np.array(batch.column(0).to_pylist(), bool)
            for i, j, data, offsets in text_slices(batch.column(1)):
                buckets, owner = ngrams(data, offsets)
                every += np.bincount(buckets, minlength=BUCKETS)
                liked += np.bincount(buckets[flags[i:j][owner]], minlength=BUCKETS)
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, every[at], liked[at])], names=["bucket", "n", "liked"])

    sums = source.mapInArrow(tidied(count), "bucket bigint, n bigint, liked bigint").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("liked").alias("liked"))
    found = np.array([tuple(r) for r in sums.collect()], np.int64).reshape(-1, 3)
    every, liked = np.zeros(BUCKETS), np.zeros(BUCKETS)
    every[found[:, 0]], liked[found[:, 0]] = found[:, 1], found[:, 2]
    if not liked.sum():
        return np.zeros(BUCKETS)
    # The model of good text leans on that of all text where it has seen little.
    raw = (every + smoothing / BUCKETS) / (every.sum() + smoothing)
    return np.log((liked + smoothing * raw) / (liked.sum() + smoothing)) - np.log(raw)


def log_ratios(docs: DataFrame, keep: Sequence[str], ratio: np.ndarray, *, text: str = "text", name: str = "log_ratio") -> DataFrame:
    """The ``keep`` columns with the log importance of each document; 0 for one without words."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            parts = [np.zeros(0)]
            for i, j, data, offsets in text_slices(column):
                buckets, owner = ngrams(data, offsets)
                parts.append(np.bincount(owner, shared.value[buckets], minlength=j - i))
            yield [pa.array(np.concatenate(parts))]

    return map_texts(docs, text, keep, [(name, "double")], work)


def gumbel(key: Column, seed: int) -> Column:
    """Gumbel noise that depends on the key and the seed alone."""
    uniform = (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest value, by counting in ever narrower bins; null if there are fewer."""
    low, high, above = values.agg(F.min(column), F.max(column), F.lit(0)).first()
    if low is None or k < 1 or values.count() < k:
        return None
    while low < high:
        width = (high - low) / BINS
        place = F.least(F.floor((quoted(column) - low) / width), F.lit(BINS - 1))
        inside = values.where(quoted(column).between(low, high))
        bins = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if above + row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            above += row["n"]
    return low


def resample(
    docs: DataFrame,
    labels: DataFrame,
    keep: Sequence[str],
    *,
    key: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    k: int | None = None,
    seed: int = 1,
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """Draw ``k`` documents by their importance for good text.

    Returns the ``keep`` columns with ``log_ratio``, ``gumbel_key`` and ``kept``, true for the
    k largest keys.  Without ``k``, as many are drawn as have a ratio above zero, that is, as
    are likelier good than any; the draw decides between those near zero.

    Null and empty texts have ratio 0.  Rows with the same key value share their noise, and rows
    equal to the k-th largest key are all kept, so repeats stand or fall together.  Without any
    label, ratios are 0 and ``k`` decides by noise alone; without ``k`` too, none is kept.  Labels
    that contradict each other make a row good.  The k-th key is found by counting, without
    sorting the documents or collecting them.
    """
    liked = labels.where(quoted(quality) == 1).select(quoted(key).alias("__id__")).where("__id__ IS NOT NULL").distinct()
    sample = liked.orderBy(F.xxhash64("__id__"), "__id__").limit(most_labelled).withColumn("__good__", F.lit(True))
    # At most ``most_labelled`` ids go to every task.
    marked = docs.join(F.broadcast(sample), quoted(key) == F.col("__id__"), "left")
    ratio = learn_ratio(marked, F.col("__good__"), text=text)
    carried = [c for c in keep if c != key]
    scored = log_ratios(docs, [key, *carried], ratio, text=text, name="__ratio__")
    scored = staged(scored.withColumn("__noisy__", F.col("__ratio__") + gumbel(quoted(key), seed)), "resample")
    if k is None:
        k = scored.where("__ratio__ > 0").count()
    least = kth_largest(scored, "__noisy__", k)
    if least is None:
        kept = F.lit(k > 0)
    else:
        kept = F.col("__noisy__") >= least
    return scored.select(*[quoted(c) for c in keep], F.col("__ratio__").alias("log_ratio"), F.col("__noisy__").alias("gumbel_key"), kept.alias("kept"))
