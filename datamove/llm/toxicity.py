"""Toxicity of texts from subword embeddings, averaged, under a linear softmax.

A word is the mean of the vectors of its character n-grams, a window of a few words the mean of
these, and a linear softmax over that gives its odds.  Vectors and softmax are trained together,
so a misspelling that was never seen stands near the words it shares n-grams with.  A text is as
toxic as its worst window: a mean over all of it would lose one insult among thousands of words.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from datamove.llm.arrow import map_texts, quoted
from datamove.llm.words import U, joined, mix

BUCKETS = 1 << 17
WIDTH = 8
SHORTEST, LONGEST = 3, 5

# Words that are averaged, and the share of the sample that sets the scale of the odds.
WINDOW = 8
HELD_BACK = 4

# The sample that the model is fitted on: labelled rows of each class, and characters in all, half
# for each class.  Of a text that is too long for its class, up to PIECES pieces are taken.
MOST_ROWS = 2_000
MOST_CHARS = 24_000_000
PIECES, LEAST_PIECE = 16, 400

# Words whose score a task remembers before it starts afresh, and texts it looks at together.
MOST_KNOWN = 500_000
TEXTS = 100


def buckets(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of marked words and of the words whole, and each one's word."""
    marked = [f"<{w}>" for w in words]
    letters = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U)
    sizes = np.array([len(w) for w in marked], np.int64)
    ends, word = np.cumsum(sizes), np.repeat(np.arange(len(marked)), sizes)
    found, owners = [], []
    for n in range(SHORTEST, LONGEST + 1):
        at = np.flatnonzero(np.arange(len(letters)) + n <= ends[word]) if len(letters) else np.zeros(0, np.int64)
        found.append(mix(joined(*[letters[at + i] for i in range(n)]) + U(n)))
        owners.append(word[at])
    found.append(mix(np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in marked], U)))
    owners.append(np.arange(len(marked)))
    return (np.concatenate(found) % U(BUCKETS)).astype(np.int64), np.concatenate(owners)


def tokens(text: str) -> list[str]:
    """Words in order; one that follows itself counts once."""
    words = text.lower().split()
    return [w for w, before in zip(words, ["", *words]) if w != before]


def bare(token: str) -> str:
    return token.strip(string.punctuation)


@dataclass
class Toxicity:
    """The vectors of all buckets, the softmax's two rows and biases, and the scale of the odds."""

    vectors: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def word_scores(self) -> "WordScores":
        # What each bucket adds to the odds; means of these are the odds of means.
        return WordScores(self.vectors @ (self.softmax[1] - self.softmax[0]), float(self.bias[1] - self.bias[0]))

    def chances(self, odds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * odds + self.shift, -60, 60)))


class WordScores:
    """Odds of tokens as they stand in texts, worked out once for each; NaN where there is no word."""

    def __init__(self, scores: np.ndarray, bias: float):
        self.scores, self.bias = scores, bias
        self.known: dict[str, float] = {}

    def _learn(self, found: set[str]) -> None:
        if len(self.known) + len(found) > MOST_KNOWN:
            self.known.clear()
        words = {token: bare(token) for token in found.difference(self.known)}
        named = [w for w in words.values() if w]
        gram, owner = buckets(named)
        means = np.bincount(owner, self.scores[gram], minlength=len(named)) / np.maximum(1, np.bincount(owner, minlength=len(named)))
        values = iter(means.tolist())
        self.known.update((token, next(values) if w else np.nan) for token, w in words.items())

    def texts(self, texts: Sequence[str]) -> np.ndarray:
        """The odds of the worst window of each text; without words, the bias alone."""
        out = np.full(len(texts), self.bias)
        for begin in range(0, len(texts), TEXTS):
            lists = [tokens(text) for text in texts[begin : begin + TEXTS]]
            self._learn(set().union(*lists))
            for i, found in enumerate(lists, begin):
                odds = np.fromiter(map(self.known.__getitem__, found), np.float64, len(found))
                odds = odds[odds == odds]
                if len(odds):
                    out[i] += worst(odds)
        return out


def worst(odds: np.ndarray) -> float:
    """The mean of the worst ``WINDOW`` words on end, wherever they begin.

    A shorter text is averaged as if the words that it lacks said nothing.
    """
    sums = np.concatenate(([0.0], np.cumsum(odds)))
    width = min(WINDOW, len(odds))
    return float((sums[width:] - sums[:-width]).max()) / WINDOW


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts by key, and the keys that occur with where their runs begin."""
    order = np.argsort(keys, kind="stable")
    found = np.flatnonzero(np.concatenate(([True], np.diff(keys[order]) > 0))) if len(keys) else np.zeros(0, np.int64)
    return order, found


def _summed(values: np.ndarray, keys: np.ndarray, order: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(keys):
        out[keys[order][begins]] = np.add.reduceat(values[order], begins, axis=0)
    return out


def fit(texts: Sequence[str], toxic: Sequence[int], prior: float, *, rounds: int = 60, rate: float = 0.1, seed: int = 7, width: int = WIDTH) -> Toxicity:
    """Train on windows of texts of both classes in even weight, each with its text's label.

    Windows to train on lie end to end, so each word is in one; the scale is set on what scoring finds.

    Words of a single text are left out: they tell nothing about others.  Every
    ``HELD_BACK``-th text is not trained on; these set the scale of the odds, for a share ``prior`` of
    toxic texts.  Too few texts for that are used for both.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-0.3 / width, 0.3 / width, (BUCKETS, width)).astype(np.float32)
    softmax, bias = rng.normal(0, 1, (2, width)).astype(np.float32), np.zeros(2, np.float32)
    labels = np.array(toxic, np.int64)
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    untrained = Toxicity(vectors * 0, softmax, bias, 0.0, float(np.log(prior / (1 - prior))))
    if not len(labels) or labels.min() == labels.max():
        return untrained
    held = np.arange(len(labels)) % HELD_BACK == HELD_BACK - 1
    if min((labels[held] == 1).sum(), (labels[held] == 0).sum()) < 10:
        held[:] = False
    ids: dict[str, int] = {}
    bags = [np.array([ids.setdefault(w, len(ids)) for w in map(bare, tokens(t)) if w], np.int64) for t, out in zip(texts, held) if not out]
    flat, sizes = np.concatenate(bags), np.array([len(bag) for bag in bags])
    text = np.repeat(np.arange(len(bags)), sizes)
    seen = np.bincount(np.unique(text * len(ids) + flat) % max(1, len(ids)), minlength=len(ids))
    number = np.where(seen > 1, np.cumsum(seen > 1) - 1, -1)
    n_words = int((number >= 0).sum())
    if not n_words:
        return untrained
    per_text = -(-sizes // WINDOW)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    window = (np.cumsum(per_text) - per_text)[text] + place // WINDOW
    known = number[flat] >= 0
    # A word counts once in a window.
    window, word = np.divmod(np.unique(window[known] * n_words + number[flat[known]]), n_words)
    n_windows = int(per_text.sum())
    gram, gram_word = buckets([w for w, i in ids.items() if number[i] >= 0])
    share = (1 / np.bincount(gram_word, minlength=n_words).astype(np.float32))[gram_word][:, None]
    weight = np.float32(1 / WINDOW)
    answer = np.repeat(labels[~held], per_text)
    # A long text counts for more than a short one, but not for all its windows.
    trust = np.repeat(1 / np.sqrt(np.maximum(per_text, 1)), per_text)
    even = (trust * np.where(answer == 1, 0.5 / trust[answer == 1].sum(), 0.5 / trust[answer == 0].sum())).astype(np.float32)
    target = np.eye(2, dtype=np.float32)[answer]
    by_gram_word, by_gram, by_window, by_word = _runs(gram_word), _runs(gram), _runs(window), _runs(word)
    state = [vectors, softmax, bias]
    first, second = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state]
    for step in range(1, rounds + 1):
        words = _summed(vectors[gram] * share, gram_word, *by_gram_word, n_words)
        means = _summed(words[word] * weight, window, *by_window, n_windows)
        logits = means @ softmax.T + bias
        chance = np.exp(logits - logits.max(1, keepdims=True))
        chance /= chance.sum(1, keepdims=True)
        wrong = (chance - target) * even[:, None]
        d_means = wrong @ softmax
        d_words = _summed(d_means[window] * weight, word, *by_word, n_words)
        slopes = [_summed(d_words[gram_word] * share, gram, *by_gram, BUCKETS), wrong.T @ means, wrong.sum(0)]
        for x, slope, m, v in zip(state, slopes, first, second):
            m += 0.1 * (slope - m)
            v += 0.05 * (slope * slope - v)
            square = v / (1 - 0.95**step)
            # Rare n-grams, whose slopes are small, move less than frequent ones.
            least = np.sqrt(square[square > 0].mean()) if x is vectors and square.any() else 0.0
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(square) + least + 1e-12)
    model = Toxicity(vectors, softmax, bias)
    check = held if held.any() else ~held
    scores = model.word_scores()
    odds = scores.texts([t for t, use in zip(texts, check) if use])
    model.slope, model.shift = _scale(odds, labels[check], prior)
    return model


def _scale(odds: np.ndarray, truth: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and shift that make the odds fit the truth best, for a share ``prior`` of toxic texts."""
    weight = np.where(truth == 1, prior / max(1, (truth == 1).sum()), (1 - prior) / max(1, (truth == 0).sum()))
    middle, spread = odds.mean(), odds.std() + 1e-9
    x = np.stack(((odds - middle) / spread, np.ones(len(odds))), axis=1)
    theta = np.array([1.0, np.log(prior / (1 - prior))])
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        curve = (x * (weight * chance * (1 - chance))[:, None]).T @ x + 1e-4 * np.eye(2)
        theta += np.clip(np.linalg.solve(curve, x.T @ (weight * (truth - chance)) - 1e-4 * theta * [1, 0]), -2, 2)
    return float(theta[0] / spread), float(theta[1] - theta[0] * middle / spread)


def longest_kept(lengths: Sequence[int], most: int) -> int:
    """The length to cut texts to so that all together have ``most`` characters, or the longest's own."""
    lengths, left = sorted(lengths), most
    for i, length in enumerate(lengths):
        share = left // (len(lengths) - i)
        if length > share:
            return share
        left -= length
    return lengths[-1] if lengths else 0


def _pieces(text: Column, kept: int) -> Column:
    """Pieces of a text longer than ``kept``, evenly from its start to its end; others whole."""
    n = max(1, min(PIECES, kept // LEAST_PIECE))
    width = max(0, kept // n - 1)
    gap = F.length(text) - width
    cut = F.concat_ws(" ", *[F.substring(text, (F.floor(gap * i / max(1, n - 1)) + 1).cast("int"), F.lit(width)) for i in range(n)])
    return F.when(F.length(text) > kept, cut).otherwise(F.coalesce(text, F.lit("")))


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    most_rows: int = MOST_ROWS,
    most_chars: int = MOST_CHARS,
) -> Toxicity:
    """Fit on a bounded sample of the labelled documents.

    Of each class the ``most_rows`` ids with the smallest hashes are taken, all of them whatever
    their lengths; where their texts exceed half of ``most_chars``, the longest ones are cut to
    pieces of one length that fits.  This much reaches the driver.  The share of toxic rows
    comes from all labels.  An id with contradicting labels is toxic.
    """
    known = labels.where(quoted(toxic).isin(0, 1) & quoted(key).isNotNull()).groupBy(quoted(key).alias("__id__")).agg(F.max(toxic).alias("__toxic__"))
    counts = {r["__toxic__"]: r["count"] for r in known.groupBy("__toxic__").count().collect()}
    chosen = None
    for label in (0, 1):
        rows = known.where(F.col("__toxic__") == label).orderBy(F.xxhash64("__id__"), "__id__").limit(most_rows)
        chosen = rows if chosen is None else chosen.unionByName(rows)
    # One text for each id, so repeated rows do not count twice; only lengths and hashes move.
    body = quoted(text).cast("string")
    one = F.min(F.struct(F.xxhash64(body).alias("hash"), F.coalesce(F.length(body), F.lit(0)).alias("length")))
    texts = docs.join(F.broadcast(chosen), quoted(key) == F.col("__id__")).groupBy("__id__", "__toxic__").agg(one.alias("__one__"))
    texts = texts.select("__id__", "__toxic__", F.col("__one__.hash").alias("__hash__"), F.col("__one__.length").alias("__length__"))
    sized = texts.collect()
    few = F.broadcast(docs.sparkSession.createDataFrame(sized, texts.schema))
    cut = F.lit("")
    for label in (0, 1):
        kept = longest_kept([r["__length__"] for r in sized if r["__toxic__"] == label], most_chars // 2)
        cut = F.when(F.col("__toxic__") == label, _pieces(body, kept)).otherwise(cut)
    found = docs.join(few, (quoted(key) == F.col("__id__")) & (F.xxhash64(body) == F.col("__hash__")))
    sample = found.select("__id__", "__toxic__", cut.alias("__text__")).groupBy("__id__", "__toxic__").agg(F.max("__text__").alias("__text__")).collect()
    sample.sort(key=lambda r: (str(r["__id__"]), r["__toxic__"]))
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    return fit([r["__text__"] or "" for r in sample], [r["__toxic__"] for r in sample], prior)


def score_toxicity(docs: DataFrame, model: Toxicity, keep: Sequence[str], *, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The ``keep`` columns with the ``score`` of each whole text and ``predicted``, 1 from ``threshold`` on.

    A null text, an empty one and one without words have the score of the biases alone.  Repeated
    rows are each scored; nothing moves but the model, whose size is fixed.
    """
    # Tasks need the sum over the softmax alone.
    small = Toxicity(model.vectors @ (model.softmax[1] - model.softmax[0])[:, None], np.array([[0.0], [1.0]]), model.bias, model.slope, model.shift)
    shared = docs.sparkSession.sparkContext.broadcast(small)

    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        model = shared.value
        known = model.word_scores()
        for column in columns:
            chance = model.chances(known.texts([value or "" for value in column.to_pylist()]))
            yield [pa.array(chance), pa.array((chance >= threshold).astype(np.int32))]

    return map_texts(docs, text, keep, [("score", "double"), ("predicted", "int")], work)
