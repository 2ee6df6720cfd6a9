"""Near copies by the Jaccard similarity of word n-grams, through R-trees over count vectors.

Every distinct shingle set is a point: its shingles hashed into groups and counted.  Two sets
share no more than the sum of the smaller count of every group, which bounds a whole R-tree node
by its largest corner; pairs that survive the bound are verified on the sets.

Which sets may link is found without loss.  Two sets that link differ in at most d
shingles, so of d + 1 parts one is equal in both: sets meet by the hash of a part's content.
Sets that met get an R-tree over their count vectors, which keeps of all pairs a few that join those the bound
lets pass.  Sets so joined, directly or through others, make a cell, whose pairs are verified in one task.  A cell too
large for one task is dealt over several; what those leave apart is compared across all of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from datamove.llm.arrow import TEXT, drop_staged, map_texts, quoted, ship_code, staged, text_slices, tidied
from datamove.llm.words import LOWER, SOLID, U, hashes, joined, mix, spans

SHINGLE, THRESHOLD = 3, 0.9

# Groups of a count vector, points in a leaf, and shingles of a cell that one task takes.
GROUPS = 32
LEAF = 16
CELL_SHINGLES = 2_000_000

# Sets that meet in one part up to which they get a tree; of more, which hardly differ or share a very common
# part, each is joined to the first.
MOST_MEETING = 4096

# Up to so many sets each is bounded against all before it at once, without a tree.
FEW = 64

# A count of a point that is so large or more bounds nothing.
FULL = 255

# Below this so many shingles may differ that groups of them say little.
LEAST_THRESHOLD = 0.7


@dataclass(frozen=True)
class Rule:
    """When two sets link: ``shared / union >= like / of``, which bounds all else in whole numbers."""

    like: int
    of: int

    @classmethod
    def at(cls, threshold: float) -> "Rule":
        if not LEAST_THRESHOLD <= threshold < 1:
            raise ValueError(f"threshold must be from {LEAST_THRESHOLD} to less than 1, not {threshold}")
        exact = Fraction(str(threshold))
        return cls(exact.numerator, exact.denominator)

    def links(self, shared, sizes):
        """Whether sets of ``sizes`` together that share so many shingles link."""
        return (self.like + self.of) * shared >= self.like * sizes

    def largest(self, size):
        """The size of the largest partner."""
        return size * self.of // self.like

    def smallest(self, size):
        return -(-size * self.like // self.of)

    def differ(self, sizes):
        """In how many shingles linking sets of ``sizes`` together differ at most."""
        return sizes * (self.of - self.like) // (self.of + self.like)

    @property
    def first_class(self) -> int:
        """The smallest size of a set that links with a smaller one."""
        return -(-self.of // (self.of - self.like))


RULE = Rule.at(THRESHOLD)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, and the n + 1 offsets of the texts among them."""
    data = LOWER[data]
    starts, ends, of = spans(data, offsets, SOLID)
    words = hashes(data, starts, ends)
    n = np.diff(of)
    text = np.repeat(np.arange(len(n)), n)
    at = np.flatnonzero(np.arange(len(words)) + shingle <= of[1:][text]) if len(words) else np.zeros(0, np.int64)
    keys, owners = [joined(*[words[at + i] for i in range(shingle)])], [text[at]]
    for size in range(1, shingle):  # fewer words than a shingle are one together
        short = np.flatnonzero(n == size)
        keys.append(joined(*[words[of[:-1][short] + i] for i in range(size)]) + U(size))
        owners.append(short)
    keys, owners = np.concatenate(keys), np.concatenate(owners)
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    keys, owners = keys[new], owners[new]
    return keys, np.searchsorted(owners, np.arange(len(n) + 1))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def set_hashes(keys: np.ndarray, offsets: np.ndarray, seed: int) -> np.ndarray:
    return mix(_sums(mix(keys + U(seed)), offsets) + np.diff(offsets).astype(U)).view(np.int64)


def class_starts(largest: int, rule: Rule = RULE) -> np.ndarray:
    """Sizes at which classes of sets begin, each half as large again as the one before."""
    starts = [rule.first_class]
    while starts[-1] <= largest:
        starts.append(-(-starts[-1] * 3 // 2))
    return np.array(starts)


def group_counts(starts: np.ndarray, rule: Rule) -> np.ndarray:
    """Groups for each class: more than its sets differ in, and spare ones for those left empty."""
    counts = []
    for most in (starts[1:] - 1).tolist():
        least = int(rule.differ(2 * most)) + 2
        n = least
        for _ in range(8):
            empty = n * math.exp(-most / n)
            n = least + int(empty + 4 * math.sqrt(empty))
        counts.append(n)
    return np.array(counts, np.int64)


def group_hashes(keys: np.ndarray, offsets: np.ndarray, rule: Rule = RULE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that two linking sets cannot fail to share, and the set of each.

    A set is cut into groups for its own class of sizes and, where a larger partner may be in
    the next class, for that one too; there are more groups than shingles that two linking
    sets of the class may differ in.  Empty groups say nothing, so a set left with no more groups
    than shingles it may differ in is cut anew as well: of two linking sets either one has
    groups enough in the first cut, and so one in common, or both are in the next.
    """
    sizes = np.diff(offsets)
    starts = class_starts(int(rule.largest(sizes.max(initial=0))), rule)
    by_class = group_counts(starts, rule)
    own = np.searchsorted(starts, sizes, "right") - 1
    upper = np.searchsorted(starts, rule.largest(sizes), "right") - 1
    sets = np.concatenate((np.flatnonzero(own >= 0), np.flatnonzero((upper > own) & (sizes > 0))))
    classes = np.concatenate((own[own >= 0], upper[(upper > own) & (sizes > 0)]))
    found, owner, cut = [np.zeros(0, U)], [np.zeros(0, np.int64)], 1
    while len(sets):
        n_groups = by_class[classes]
        many = sizes[sets]
        row = np.repeat(np.arange(len(sets)), many)
        at = offsets[:-1][sets][row] + np.arange(len(row)) - (np.cumsum(many) - many)[row]
        key = mix(keys[at] + U(0x51ED2701) * U(cut))
        begins = np.cumsum(n_groups) - n_groups
        group = begins[row] + (key >> U(33)).astype(np.int64) % n_groups[row]
        order = np.argsort(group, kind="stable")
        group, key = group[order], key[order]
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        total = np.add.reduceat(mix(key), first)
        count = np.diff(np.append(first, len(group)))
        place = group[first]
        whose = np.searchsorted(begins, place, "right") - 1
        which = (place - begins[whose]).astype(U) * U(1 << 20) + (n_groups[whose] * 64 + min(cut, 63)).astype(U)
        found.append(joined(total, count.astype(U), which))
        owner.append(sets[whose])
        # No partner is larger than the class, or than the set allows.
        differ = rule.differ(many + np.minimum(rule.largest(many), starts[classes + 1] - 1))
        full = np.bincount(whose, minlength=len(sets)) > differ
        sets, classes, cut = sets[~full], classes[~full], cut + 1
    return np.concatenate(found), np.concatenate(owner)


class CountTree:
    """An R-tree over count vectors, with each node's largest corner and range of sizes."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rule: Rule = RULE):
        self.points, self.sizes, self.rule = points, sizes, rule
        self.rows: list[np.ndarray] = []
        self.below: list[list[int]] = []
        self.high: list[np.ndarray] = []
        self.least: list[int] = []
        self.most: list[int] = []
        self.alike: list[bool] = []  # all members known to be of one component
        if len(points):
            self._add(np.arange(len(points)))

    def _add(self, rows: np.ndarray) -> int:
        node = len(self.rows)
        points, sizes = self.points[rows], self.sizes[rows]
        self.rows.append(rows)
        self.below.append([])
        self.high.append(points.max(0))
        self.least.append(int(sizes.min()))
        self.most.append(int(sizes.max()))
        self.alike.append(False)
        if len(rows) > LEAF:
            # Sizes count as a coordinate; the widest one is cut in the middle.
            spread = np.append(points.max(0) - points.min(0), sizes.max() - sizes.min())
            widest = int(spread.argmax())
            order = np.argsort(sizes if widest == points.shape[1] else points[:, widest], kind="stable")
            half = len(rows) // 2
            self.below[node] = [self._add(rows[order[:half]]), self._add(rows[order[half:]])]
        return node

    def candidates(self, query: int, labels: np.ndarray) -> Iterator[int]:
        """Members of other components that may share enough with the member ``query``."""
        point, size = self.points[query], int(self.sizes[query])
        least, most, links = self.rule.smallest(size), self.rule.largest(size), self.rule.links
        stack = [0]
        while stack:
            node = stack.pop()
            if self.most[node] < least or self.least[node] > most:
                continue
            rows = self.rows[node]
            if self.alike[node] and labels[rows[0]] == labels[query]:
                continue
            if not links(int(np.minimum(self.high[node], point).sum()), size + max(least, self.least[node])):
                continue
            if self.below[node]:
                if not self.alike[node] and all(self.alike[b] for b in self.below[node]):
                    left, right = (labels[self.rows[b][0]] for b in self.below[node])
                    self.alike[node] = bool(left == right)
                stack += self.below[node]
                continue
            other = rows[labels[rows] != labels[query]]
            if not len(other):
                self.alike[node] = True
                continue
            shared = np.minimum(self.points[other], point).sum(1)
            yield from other[links(shared, size + self.sizes[other])].tolist()


def count_vectors(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(offsets))
    group = (mix(keys + U(77)) >> U(40)).astype(np.int64) % GROUPS
    return np.bincount(text * GROUPS + group, minlength=n * GROUPS).reshape(n, GROUPS)


def points(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A count vector for each text, end to end with n + 1 offsets: two shingles a coordinate, in powers of two.

    Coordinates are the low bits of a hash, so a vector is folded to half its length by adding its halves.
    """
    sizes = np.diff(offsets)
    widths = np.maximum(8, 1 << np.ceil(np.log2(np.maximum(sizes, 2) / 2)).astype(np.int64))
    begins = np.concatenate(([0], np.cumsum(widths)))
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = begins[text] + ((mix(keys + U(77)) >> U(20)).astype(np.int64) & (widths[text] - 1))
    counts = np.minimum(np.bincount(at, minlength=int(begins[-1])), FULL).astype(np.uint8)
    return counts, begins


def folded(point: np.ndarray, width: int) -> np.ndarray:
    return point.reshape(-1, width).sum(0, dtype=np.int64) if len(point) > width else point.astype(np.int64)


def may_link(a: np.ndarray, b: np.ndarray, sizes: int, rule: Rule) -> bool:
    """Whether the sums of smaller counts let two points of ``sizes`` together link."""
    width = min(len(a), len(b))
    a, b = folded(a, width), folded(b, width)
    return bool((np.minimum(a, b) >= FULL).any()) or rule.links(int(np.minimum(a, b).sum()), sizes)


def joined_points(sizes: np.ndarray, vectors: list[np.ndarray], rule: Rule) -> np.ndarray:
    """For each point the first one it is joined to by pairs that may link."""
    n = len(sizes)
    labels = np.arange(n)
    width = min([len(v) for v in vectors] + [GROUPS] * (n > FEW))
    low = np.stack([folded(v, width) for v in vectors])
    low[low >= FULL] = sizes.max()
    tree = CountTree(low, sizes, rule) if n > FEW else None
    for i in range(n):
        if tree is None:
            others = np.flatnonzero(rule.links(np.minimum(low[:i], low[i]).sum(1), sizes[:i] + sizes[i])).tolist()
        else:
            others = tree.candidates(i, labels)
        for j in others:
            if labels[j] != labels[i] and may_link(vectors[i], vectors[j], int(sizes[i] + sizes[j]), rule):
                labels[labels == max(labels[i], labels[j])] = min(labels[i], labels[j])
    return labels


def linked(keys: np.ndarray, offsets: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """For each set the first set of its component of links."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    labels = np.arange(n)
    members: dict[int, list[int]] = {i: [i] for i in range(n)}
    tree = CountTree(count_vectors(keys, offsets), sizes, rule)
    for query in range(n):
        if not sizes[query]:
            continue
        own = keys[offsets[query] : offsets[query + 1]]
        for other in tree.candidates(query, labels):
            if labels[other] == labels[query]:
                continue
            theirs = keys[offsets[other] : offsets[other + 1]]
            place = np.searchsorted(theirs, own)
            shared = int((theirs[np.minimum(place, len(theirs) - 1)] == own).sum())
            if rule.links(shared, len(own) + len(theirs)):
                small, large = sorted((labels[query], labels[other]), key=lambda x: len(members[x]))
                moved = members.pop(small)
                labels[moved] = large
                members[large] += moved
    first = {label: min(rows) for label, rows in members.items()}
    return np.array([first[label] for label in labels], np.int64)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected to, for nodes that are not it.

    Alternating stars over edges ``a``, ``b``: each round hangs every node's neighbours below the
    smallest of them, until nothing changes.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        before, now = now, staged(small, "edges")
        drop_staged(before)
        if (found := state(now)) == seen:
            break
        seen = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _sets(docs: DataFrame, keep: Sequence[str], text: str, shingle: int, seed: int) -> DataFrame:
    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            made = [[np.zeros(0, np.int64)] for _ in range(3)]
            vectors = [pa.array([], pa.binary())]
            for _, _, data, offsets in text_slices(column):
                keys, of = shingle_sets(data, offsets, shingle)
                for out, values in zip(made, (np.diff(of), set_hashes(keys, of, seed), set_hashes(keys, of, seed + 1000))):
                    out.append(values)
                counts, begins = points(keys, of)
                buffers = [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(counts.tobytes())]
                vectors.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins) - 1, buffers).cast(pa.binary()))
            yield [*[pa.array(np.concatenate(x).astype(np.int64)) for x in made], pa.concat_arrays(vectors)]

    fields = [("__size__", "bigint"), ("__set__", "bigint"), ("__check__", "bigint"), ("__point__", "binary")]
    return map_texts(docs, text, keep, fields, work)


def runs(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """Neighbouring rows with the same value of ``by``, together, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch.column(by).to_numpy()
        cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
        if held and held[-1].column(by)[-1].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = []
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
            held.append(batch.slice(x, y - x))
            if y < len(key):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _meetings(docs: DataFrame, text: str, shingle: int, rule: Rule, seed: int) -> DataFrame:
    """Lists of sets that share a part: ``names``, and ``who``, which lists of the same sets have in common.

    A part of very many sets is told as several lists that begin with the same set, and has no ``who``.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: set[int] = set()  # a set asks once in a task
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                keys, of = shingle_sets(data, offsets, shingle)
                names = set_hashes(keys, of, seed)
                fresh = np.zeros(len(names), bool)
                for i, name in enumerate(names.tolist()):
                    fresh[i] = name not in asked
                    asked.add(name)
                keys = keys[np.repeat(fresh, np.diff(of))]
                names, of = names[fresh], np.concatenate(([0], np.cumsum(np.diff(of)[fresh])))
                parts, owner = group_hashes(keys, of, rule)
                for i in range(0, len(parts), 100_000):
                    columns = [pa.array(c[i : i + 100_000].view(np.int64)) for c in (parts, names[owner])]
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "name"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted: lists of the parts that several sets have; a part may go on in the next batch."""
        last, held, lead = None, np.zeros(0, np.int64), None

        def told(sizes: np.ndarray, names: np.ndarray, who: pa.Array) -> pa.RecordBatch:
            of = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            return pa.RecordBatch.from_arrays([who, pa.ListArray.from_arrays(of, pa.array(names))], names=["who", "names"])

        def common(names: np.ndarray, lead: int) -> pa.RecordBatch:
            return told(np.array([len(names) + 1]), np.concatenate(([lead], names)), pa.nulls(1, pa.int64()))

        def rest() -> Iterator[pa.RecordBatch]:
            if lead is not None and len(held):
                yield common(held, lead)
            elif lead is None and len(held) > 1:
                yield told(np.array([len(held)]), held, pa.array([int(np.sum(mix(held.view(U))).astype(np.int64))]))

        for batch in batches:
            part, name = (batch.column(c).to_numpy() for c in ("part", "name"))
            new = np.ones(len(part), bool)
            new[1:] = (part[1:] != part[:-1]) | (name[1:] != name[:-1])
            part, name = part[new], name[new]
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            size = np.diff(np.append(first, len(part)))
            for i in sorted({0, len(first) - 1}):  # the runs that may go on from or in another batch
                if part[first[i]] != last:
                    yield from rest()
                    last, held, lead = part[first[i]], np.zeros(0, np.int64), None
                more = name[first[i] : first[i] + size[i]]
                held = np.concatenate((held, more[more != (held[-1] if len(held) else lead)]))
                if len(held) > MOST_MEETING:
                    lead = int(held[0]) if lead is None else lead
                    yield common(held[held != lead], lead)
                    held = held[-1:]
                if i == 0:
                    inner = np.flatnonzero((size > 1) & (np.arange(len(size)) > 0) & (np.arange(len(size)) < len(size) - 1))
                    large = inner[size[inner] > MOST_MEETING]
                    for j in large.tolist():
                        names = name[first[j] : first[j] + size[j]]
                        yield common(names[1:], int(names[0]))
                    inner = inner[size[inner] <= MOST_MEETING]
                    if len(inner):
                        at = np.repeat(first[inner] - (np.cumsum(size[inner]) - size[inner]), size[inner]) + np.arange(int(size[inner].sum()))
                        sums = np.add.reduceat(mix(name[at].view(U)), np.cumsum(size[inner]) - size[inner])
                        yield told(size[inner], name[at], pa.array(sums.view(np.int64)))
        yield from rest()

    asked = docs.select(quoted(text).cast("string").alias(TEXT)).mapInArrow(tidied(ask), "part bigint, name bigint")
    met = asked.repartition("part").sortWithinPartitions("part", "name")
    return met.mapInArrow(tidied(gather), "who bigint, names array<bigint>")


def _joined(meetings: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Edges that join the sets of each list whose points may link: of each set to the first it is joined to."""

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []
        for run in runs(batches, "who"):
            names = run.column("name").to_numpy()
            vectors = [np.frombuffer(v.as_buffer(), np.uint8) for v in run.column("__point__")]
            label = joined_points(run.column("__size__").to_numpy(), vectors, rule)
            moved = label != np.arange(len(label))
            out.append(np.stack((names[moved], names[label[moved]])))
            if len(out) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, 1)], names=["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, 1)], names=["a", "b"])

    # Lists of the same sets are one.
    lists = meetings.where("who IS NOT NULL").groupBy("who").agg(F.first("names").alias("names"))
    named = lists.select("who", F.explode("names").alias("name")).join(sets, F.col("name") == F.col("__set__"))
    pruned = named.select("who", "name", "__size__", "__point__").repartition("who").sortWithinPartitions("who", "name")
    pruned = pruned.mapInArrow(tidied(prune), "a bigint, b bigint")
    common = meetings.where("who IS NULL").select(F.explode("names").alias("a"), F.get("names", F.lit(0)).alias("b"))
    return pruned.unionByName(common.where("a <> b")).distinct()


def _compared(docs: DataFrame, key: str, text: str, tasks: DataFrame, shingle: int, rule: Rule, seed: int) -> DataFrame:
    """Links among the sets of each task: ``a`` with the first set ``b`` of its component there.

    ``tasks`` has the document that stands for a set, the set, and the task.
    """

    def compare(table: pa.Table) -> pa.Table:
        parts, names = [], []
        unpack = zstandard.ZstdDecompressor().decompress
        for _, _, data, offsets in text_slices(pa.array([unpack(t) for t in table.column(TEXT).to_pylist()], pa.large_binary())):
            keys, of = shingle_sets(data, offsets, shingle)
            names.append(set_hashes(keys, of, seed))
            parts += [keys[x:y] for x, y in zip(of[:-1], of[1:])]
        names = np.concatenate(names)
        # A key that stands for several texts brings them all; only the one meant counts.
        rows = np.flatnonzero(names == table.column("__set__").to_numpy())
        rows = rows[np.unique(names[rows], return_index=True)[1]]
        offsets = np.concatenate(([0], np.cumsum([len(parts[i]) for i in rows])))
        root = linked(np.concatenate([np.zeros(0, U), *[parts[i] for i in rows]]), offsets, rule)
        return pa.table({"a": names[rows], "b": names[rows][root]})

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = [pack(t.as_buffer() or b"") for t in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["__id__", TEXT])

    # Texts are packed for the shuffle by key, which is asked for at every size alike.
    texts = docs.select(quoted(key).alias("__id__"), quoted(text).cast("string").alias(TEXT))
    schema = T.StructType([texts.schema["__id__"], T.StructField(TEXT, T.BinaryType())])
    texts = texts.mapInArrow(tidied(packed), schema)
    return tasks.join(texts.hint("merge"), "__id__").groupBy("__task__").applyInArrow(compare, "a bigint, b bigint").where("a <> b")


def _across(
    docs: DataFrame, key: str, text: str, wide: DataFrame, links: DataFrame, cell_shingles: int, shingle: int, rule: Rule, seed: int
) -> DataFrame:
    """Links in the cells of several tasks between the largest component so far and all else."""
    labelled = wide.join(links, wide["__set__"] == links["a"], "left").withColumn("__label__", F.coalesce("b", "__set__")).drop("a", "b")
    by_label = labelled.groupBy("__cell__", "__label__").agg(F.sum("__size__").alias("n"))
    main = by_label.groupBy("__cell__").agg(F.max_by("__label__", F.struct("n", "__label__")).alias("__main__"))
    rest = labelled.join(main, "__cell__").where("__label__ <> __main__")
    loads = rest.groupBy("__cell__").agg(F.ceil(F.sum("__size__") / cell_shingles).cast("int").alias("__rests__"))
    rest = rest.join(loads, "__cell__").withColumn("__rest__", F.pmod(F.xxhash64("__set__", F.lit(1)), F.col("__rests__")).cast("int"))
    every = labelled.join(loads, "__cell__")

    def tasks(rows: DataFrame, part: Column, rest: Column) -> DataFrame:
        rows = rows.select("__id__", "__set__", "__cell__", part.alias("__part__"), rest.alias("r"))
        return rows.select("__id__", "__set__", F.struct("__cell__", "__part__", "r").alias("__task__"))

    one = tasks(rest, F.explode(F.sequence(F.lit(0), F.col("__parts__") - 1)), F.col("__rest__"))
    two = tasks(every, F.col("__part__"), F.explode(F.sequence(F.lit(0), F.col("__rests__") - 1)))
    return _compared(docs, key, text, one.unionByName(two).distinct(), shingle, rule, seed)


def near_copies(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    cell_shingles: int = CELL_SHINGLES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The component of links that each document is in.

    Returns the key with ``n_shingles``, the size of the document's set of distinct runs of
    ``shingle`` words, and ``component_id``, the smallest key reachable by links. Two sets link
    when they share at least ``threshold``, from 0.7 to less than 1, of their union.  With ``keep`` it returns these columns of the row too, and ``component``, which tells
    components apart that have the same smallest key; null for an empty set.

    Fewer words than a shingle are one together.  A null or empty text, or one of white
    space, has an empty set and links with nothing, so its component is its own key; a row
    with a null key has component null and links with nothing.  Repeated rows are each returned, in
    the same component.  Equal sets always link, and are compared once; a key that repeats with
    several texts stands in the component of each.  The table is read more than once, so it must
    be one that reads the same each time.
    """
    rule = Rule.at(threshold)
    if shingle < 1:
        raise ValueError(f"shingle must be at least 1, not {shingle}")
    ship_code(docs.sparkSession)
    named = docs.where(quoted(key).isNotNull())
    seed = 1
    while True:
        sets = staged(_sets(docs, [key, *keep], text, shingle, seed), "sets")
        kept = sets.where((F.col("__size__") > 0) & quoted(key).isNotNull())
        clash = (F.min("__check__") != F.max("__check__")).alias("__clash__")
        point = F.first("__point__").alias("__point__")
        reps = kept.groupBy("__set__").agg(F.min(quoted(key)).alias("__id__"), F.max("__size__").alias("__size__"), point, clash)
        reps = staged(reps, "reps")
        if not reps.where("__clash__").head(1):
            break
        drop_staged(sets, reps)
        seed += 1  # two different sets had one name
    points_of = reps.select("__set__", "__size__", "__point__")
    reps = reps.drop("__point__")
    meetings = staged(_meetings(named, text, shingle, rule, seed), "meetings")
    found = components(_joined(meetings, points_of, rule))
    drop_staged(meetings)
    cells = found.unionByName(found.select(F.col("label").alias("node"), "label").distinct())
    members = cells.select(F.col("node").alias("__set__"), F.col("label").alias("__cell__")).join(reps, "__set__")
    loads = members.groupBy("__cell__").agg(F.ceil(F.sum("__size__") / cell_shingles).cast("int").alias("__parts__"))
    chance = F.xxhash64("__set__")
    members = members.join(loads, "__cell__").withColumn("__part__", F.pmod(chance, F.col("__parts__")).cast("int"))
    members = staged(members, "members")
    # Some sets of a divided cell go to each of its tasks, so that what is alike there meets.
    shared = (F.col("__parts__") > 1) & (F.pmod(F.shiftright(chance, 20), 10 * F.col("__parts__")) == 0)
    parts = F.when(shared, F.sequence(F.lit(0), F.col("__parts__") - 1)).otherwise(F.array("__part__"))
    tasks = members.select("__id__", "__set__", "__cell__", F.explode(parts).alias("__part__"))
    tasks = tasks.select("__id__", "__set__", F.struct("__cell__", "__part__", F.lit(-1).alias("r")).alias("__task__"))
    links = staged(_compared(named, key, text, tasks, shingle, rule, seed), "links")
    wide = members.where("__parts__ > 1")
    if wide.head(1):
        near = components(links).select(F.col("node").alias("a"), F.col("label").alias("b"))
        far = _across(named, key, text, wide, near, cell_shingles, shingle, rule, seed)
        links = components(near.unionByName(far)).select(F.col("node").alias("a"), F.col("label").alias("b"))
    labels = reps.join(links, reps["__set__"] == links["a"], "left").select("__set__", "__id__", F.coalesce("b", "__set__").alias("__label__"))
    smallest = labels.groupBy("__label__").agg(F.min("__id__").alias("__component__"))
    known = labels.join(smallest, "__label__").select("__set__", "__label__", "__component__")
    alone = sets.where((F.col("__size__") == 0) | quoted(key).isNull())
    more = [quoted(c) for c in keep]
    size, none = F.col("__size__").alias("n_shingles"), F.lit(None).cast("bigint")

    def result(rows: DataFrame, component: Column, label: Column) -> DataFrame:
        return rows.select(quoted(key), size, component.alias("component_id"), *([*more, label.alias("component")] if keep else []))

    return result(kept.join(known, "__set__"), F.col("__component__"), F.col("__label__")).unionByName(result(alone, quoted(key), none))
