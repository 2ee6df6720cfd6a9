"""Languages of texts as mixtures: shares by expectation-maximisation, the set by a penalty.

A text is cut into short windows of bytes.  For each language a window has a likelihood from
hashed byte trigrams; the text's language shares are those that explain its windows best.
Sets of one, two, three ... languages, the largest shares first, are fitted anew, and the set
with the best penalised likelihood is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from datamove.llm.arrow import TEXT, map_texts, quoted, ship_code, text_slices, tidied
from datamove.llm.words import LOWER

BUCKETS = 1 << 16
WINDOW = 64
ROUNDS = 12

# Log likelihood that one more language must gain, times half the log of the windows.
PENALTY = 6.0

UNKNOWN = "und"


@dataclass
class Languages:
    """Names, and for each the log probability of every bucket; one more bucket says nothing."""

    names: list[str]
    logs: np.ndarray


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at each byte; ``BUCKETS`` where it would leave its text."""
    low = LOWER[data].astype(np.uint32)
    keys = np.full(len(data), BUCKETS, np.uint32)
    if len(data) > 2:
        mixed = (low[:-2] | low[1:-1] << np.uint32(8) | low[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
        keys[:-2] = mixed >> np.uint32(16)
    ends = offsets[1:][np.diff(offsets) > 0]
    keys[ends - 1] = BUCKETS
    keys[np.maximum(ends - 2, 0)[np.diff(offsets)[np.diff(offsets) > 0] > 1]] = BUCKETS
    return keys


def learn_languages(docs: DataFrame, *, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Languages:
    """Trigram models from every document whose language is not null.

    Tasks count trigrams by language before anything is shuffled; the driver gets ``BUCKETS``
    numbers a language, whatever the size of the table.
    """
    ship_code(docs.sparkSession)
    labelled = docs.where(quoted(lang).isNotNull()).select(quoted(lang).cast("string").alias("lang"), quoted(text).cast("string").alias(TEXT))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for i, j, data, offsets in text_slices(batch.column(1)):
                keys = trigrams(data, offsets)
                owner = np.repeat(names[i:j], np.diff(offsets))
                for name in set(names[i:j]):
                    found = np.bincount(keys[owner == name], minlength=BUCKETS + 1)
                    totals[name] = totals.get(name, 0) + found
        for name, total in totals.items():
            at = np.flatnonzero(total[:BUCKETS])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at].astype(np.int64))], names=["lang", "bucket", "n"]
            )

    counted = labelled.mapInArrow(tidied(count), "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = counted.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).orderBy("lang")
    names, rows = [], []
    for row in packed.toLocalIterator():
        n = np.zeros(BUCKETS)
        n[[c["bucket"] for c in row["counts"]]] = [c["n"] for c in row["counts"]]
        names.append(row["lang"])
        rows.append(np.append(np.log((n + smoothing) / (n.sum() + smoothing * BUCKETS)), 0.0))
    return Languages(names, np.array(rows, np.float32).reshape(len(names), BUCKETS + 1))


def _shares(loglik: np.ndarray, of: np.ndarray, firsts: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each text's allowed languages, and the log likelihood they reach.

    ``loglik`` is windows by languages, ``of`` each window's text, ``firsts`` each text's first window.
    """
    windows = np.diff(np.append(firsts, len(loglik)))[:, None]
    shares = allowed / allowed.sum(1, keepdims=True)
    top = loglik.max(1, keepdims=True)
    scaled = np.exp(loglik - top)
    for _ in range(ROUNDS):
        joint = scaled * shares[of]
        joint /= joint.sum(1, keepdims=True) + 1e-300
        shares = np.add.reduceat(joint, firsts, axis=0) / windows
        shares = np.where(allowed > 0, shares + 1e-12, 0)
        shares /= shares.sum(1, keepdims=True)
    reached = np.add.reduceat(np.log((scaled * shares[of]).sum(1) + 1e-300) + top[:, 0], firsts)
    return shares, reached


def mixtures(data: np.ndarray, offsets: np.ndarray, model: Languages) -> np.ndarray:
    """Texts by languages: the shares of the chosen set; all zero for an empty text."""
    out = np.zeros((len(offsets) - 1, len(model.names)))
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    if not len(full) or not model.names:
        return out
    many = -(-sizes[full] // WINDOW)
    firsts = np.cumsum(many) - many
    of = np.repeat(np.arange(len(full)), many)
    starts = offsets[:-1][full][of] + (np.arange(len(of)) - firsts[of]) * WINDOW
    keys = trigrams(data, offsets)
    loglik = np.stack([np.add.reduceat(logs[keys].astype(np.float64), starts) for logs in model.logs], axis=1)
    shares, _ = _shares(loglik, of, firsts, np.ones((len(full), len(model.names))))
    rank = np.argsort(np.argsort(-shares, axis=1, kind="stable"), axis=1, kind="stable")
    best, best_shares = np.full(len(full), -np.inf), shares
    for size in range(1, len(model.names) + 1):
        fitted, reached = _shares(loglik, of, firsts, (rank < size).astype(float))
        penalised = reached - PENALTY * (size - 1) * 0.5 * np.log(many + 1)
        better = penalised > best
        best = np.where(better, penalised, best)
        best_shares = np.where(better[:, None], fitted, best_shares)
    out[full] = best_shares
    return out


def tell_languages(docs: DataFrame, model: Languages, keep: Sequence[str], *, text: str = "text") -> DataFrame:
    """The languages of each document.

    Returns the ``keep`` columns with ``lang_pred``, the language of the largest share, the
    first by name of equals; ``score``, that share; and ``languages``, the chosen set with its
    shares, largest first.

    Null and empty texts, and texts without a letter, are ``und`` with score 0 and no languages;
    so is everything if no language was learnt.  A text of under three bytes has no trigram: its
    languages share alike.  Repeated rows are each judged, and no row needs another.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))

    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        model = shared.value
        for column in columns:
            preds, scores, sets = [], [], []
            for i, j, data, offsets in text_slices(column):
                for value, shares in zip(column.slice(i, j - i), mixtures(data, offsets, model)):
                    if not model.names or not any(map(str.isalpha, value.as_py() or "")):
                        preds.append(UNKNOWN)
                        scores.append(0.0)
                        sets.append([])
                        continue
                    order = np.argsort(-shares, kind="stable")
                    chosen = [{"lang": model.names[k], "share": float(shares[k])} for k in order if shares[k] > 0]
                    preds.append(chosen[0]["lang"])
                    scores.append(min(1.0, chosen[0]["share"]))
                    sets.append(chosen)
            yield [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, kind)]

    fields = [("lang_pred", "string"), ("score", "double"), ("languages", "array<struct<lang:string,share:double>>")]
    return map_texts(docs, text, keep, fields, work)
