"""Passages of benchmark items in documents, by Wu-Manber search over words.

The test strings are the windows of the items: ``window`` consecutive words, or the whole item
where it is shorter.  A shift table over blocks of two words says how far a search may jump
without missing a window; where it says zero, the windows that end in that block are looked up
by the block's hash, compared by their first block, and at last word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from datamove.llm.arrow import map_texts, quoted, text_slices
from datamove.llm.words import ALNUM, BASE, LOWER, U, hashes, mix, spans

# Words of benchmark items in one broadcast (about 100 bytes each); more items take more passes.
BLOCK_WORDS = 1_000_000

# Window ends that one cursor walks over; cursors move side by side.
REACH = 256

FIELDS = [
    ("n_words", "bigint"),
    ("spans", "array<struct<start:bigint,end:bigint>>"),
    ("items", "array<string>"),
]


def _block(words: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Hash of the block of ``size`` words that ends at each of ``ends``."""
    if size == 1:
        return words[ends]
    return mix(words[ends - 1] * U(BASE) + words[ends])


@dataclass
class WuManber:
    """Tables for windows of one length."""

    length: int
    windows: list[tuple[bytes, ...]] = field(default_factory=list)
    items: list[list[str]] = field(default_factory=list)

    def build(self) -> None:
        m, self.block = self.length, min(2, self.length)
        flat = b" ".join(w for window in self.windows for w in window)
        data = np.frombuffer(flat, np.uint8)
        starts, ends, _ = spans(data, np.array([0, len(data)]), ALNUM)
        words = hashes(data, starts, ends)
        first = np.arange(len(self.windows)) * m
        self.bits = max(12, min(22, int(np.ceil(np.log2(len(words) + 1))) + 3))
        self.shift = np.full(1 << self.bits, m - self.block + 1, np.int32)
        for at in range(self.block - 1, m):
            key = _block(words, first + at, self.block) >> U(64 - self.bits)
            np.minimum.at(self.shift, key, m - 1 - at)
        suffix = _block(words, first + m - 1, self.block)
        order = np.argsort(suffix, kind="stable")
        self.order, self.suffix = order, suffix[order]
        self.prefix = _block(words, first + self.block - 1, self.block)[order]

    def search(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First words and window numbers of what may be occurrences."""
        m = self.length
        lows, highs = offsets[:-1] + m - 1, offsets[1:] - 1
        pieces = np.maximum(0, -(-(highs - lows + 1) // REACH))
        owner = np.repeat(np.arange(len(lows)), pieces)
        rank = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = lows[owner] + rank * REACH
        last = np.minimum(at + REACH - 1, highs[owner])
        found = []
        while len(at):
            step = self.shift[_block(words, at, self.block) >> U(64 - self.bits)]
            if len(hit := at[step == 0]):
                found.append(hit)
            at = at + np.maximum(step, 1)
            going = at <= last
            at, last = at[going], last[going]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate(found)
        key = _block(words, at, self.block)
        low = np.searchsorted(self.suffix, key, "left")
        many = np.searchsorted(self.suffix, key, "right") - low
        which = np.repeat(np.arange(len(at)), many)
        slot = low[which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        first = at[which] - m + 1
        same = self.prefix[slot] == _block(words, first + self.block - 1, self.block)
        return first[same], self.order[slot[same]]


def item_words(text: str | None) -> list[bytes]:
    data = LOWER[np.frombuffer((text or "").encode(), np.uint8)]
    starts, ends, _ = spans(data, np.array([0, len(data)]), ALNUM)
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def _tables(items: list[tuple[str, list[bytes]]], window: int) -> list[WuManber]:
    owners: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for name, words in items:
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            owners.setdefault(size, {}).setdefault(tuple(words[i : i + size]), set()).add(name)
    tables = []
    for size, found in sorted(owners.items()):
        table = WuManber(size, list(found), [sorted(v) for v in found.values()])
        table.build()
        tables.append(table)
    return tables


def _item_blocks(benchmark: DataFrame, item: str, text: str, window: int) -> Iterator[list[WuManber]]:
    """Tables of items, a bounded number of words at a time."""
    items, total = [], 0
    rows = benchmark.where(quoted(item).isNotNull()).select(quoted(item).cast("string"), quoted(text).cast("string"))
    for name, body in rows.toLocalIterator(prefetchPartitions=False):
        if words := item_words(body):
            items.append((name, words))
            total += len(words)
        if total >= BLOCK_WORDS:
            yield _tables(items, window)
            items, total = [], 0
    if items:
        yield _tables(items, window)


def _scan(column: pa.Array, blocks: list[list[WuManber]] | list) -> list[pa.Array]:
    slices = []
    for i, j, data, offsets in text_slices(column):
        data = LOWER[data]
        starts, ends, of = spans(data, offsets, ALNUM)
        slices.append((data, starts, ends, of, np.zeros(len(starts) + 1, np.int64), {}))
    for block in blocks:
        tables = block.value if hasattr(block, "value") else block
        for data, starts, ends, of, cover, named in slices:
            _mark(data, starts, ends, of, cover, named, tables)
        if len(blocks) > 1:
            vars(block).pop("_value", None)  # a task holds one block at a time
    counts, runs_out, items_out = [], [], []
    for _, starts, _, of, cover, named in slices:
        hit = np.cumsum(cover[:-1]) > 0
        counts += np.diff(of).tolist()
        for k in range(len(of) - 1):
            runs = []
            if k in named:
                inside = np.concatenate(([False], hit[of[k] : of[k + 1]], [False]))
                edges = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
                runs = [{"start": s, "end": e} for s, e in edges.tolist()]
            runs_out.append(runs)
            items_out.append(sorted(named.get(k, ())))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return [pa.array(counts, pa.int64()), pa.array(runs_out, kind), pa.array(items_out, pa.list_(pa.string()))]


def _mark(data, starts, ends, of, cover, named, tables: list[WuManber]) -> None:
    """Note in ``cover`` where hit words begin and end, in ``named`` the items of each text."""
    words, raw = hashes(data, starts, ends), data.tobytes()
    for table in tables:
        m = table.length
        for first, which in zip(*(x.tolist() for x in table.search(words, of))):
            at = zip(starts[first : first + m].tolist(), ends[first : first + m].tolist())
            if all(raw[s:e] == w for (s, e), w in zip(at, table.windows[which])):
                cover[first] += 1
                cover[first + m] -= 1
                text = int(np.searchsorted(of, first, "right")) - 1
                named.setdefault(text, set()).update(table.items[which])


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> DataFrame:
    """Which words of each document stand in a passage of a benchmark item, and of which items.

    Returns the ``keep`` columns of every document with ``n_words``; ``spans``, the runs of hit
    words as ``[start, end)``; and ``items``, the ids as text, distinct and sorted.

    Null and empty texts have no words; null and empty items, and items without an id, have no
    windows; an empty benchmark hits nothing.  Repeated documents are each reported, repeated
    items count once.  Documents do not move: the tables go to them by broadcast, in blocks of
    ``BLOCK_WORDS`` benchmark words, of which the driver and a task hold one at a time.
    """
    context = docs.sparkSession.sparkContext
    blocks = []
    for tables in _item_blocks(benchmark, item, item_text, window):
        blocks.append(context.broadcast(tables))
        # Written for the tasks by now; the driver lets go of it before it makes the next one.
        vars(blocks[-1]).pop("_value", None)
        del tables

    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            yield _scan(column, blocks)

    return map_texts(docs, text, keep, FIELDS, work)
