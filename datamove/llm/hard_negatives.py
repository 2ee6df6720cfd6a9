"""Hard negatives by an inverted multi-index with certified scores.

Each vector is cut into halves, and each half has a codebook; a pair of codewords is a cell.  An
anchor's score with a cell's vectors is at most the sum of two half bounds, the half score with the codeword
plus the length of the anchor's half times the codeword's radius.  A heap takes cells by falling
bounds until they hold enough rows; the scores found there are certified where no other cell's bound
reaches them, and the cells whose bound does are visited too.  So results are those of all rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from datamove.llm.arrow import quoted, ship_code, staged

# Vectors, and bytes of them, that the codebooks are learnt from; every vector is indexed.
SAMPLE = 20_000
SAMPLE_BYTES = 32 << 20

# Rows of a cell to aim at, and codewords of a half.
CELL_ROWS = 32
MOST_CODEWORDS = 256

# Rows in the cells that the heap takes before anything is certified.
PROBE_ROWS = 2048

# Bytes of vectors of a bin of cells, which one task takes, and anchors that meet a bin in a task.
BIN_BYTES = 16 << 20
BIN_ANCHORS = 20_000

# Anchors whose scores with a bin are held at a time.
BLOCK = 64

# Sums of products stay whole numbers in double precision below this.
EXACT = 1 << 53


def codebook(x: np.ndarray, many: int, seed: int) -> np.ndarray:
    """Centres by k-means; fewer where vectors repeat."""
    rng = np.random.default_rng(seed)
    centres = np.unique(x[rng.choice(len(x), min(many, len(x)), replace=False)], axis=0)
    for _ in range(8):
        of = nearest(x, centres)
        used = np.unique(of)
        sums = np.zeros((len(centres), x.shape[1]))
        np.add.at(sums, of, x)
        centres = sums[used] / np.bincount(of, minlength=len(centres))[used, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(1)[None] - 2 * (x @ centres.T)).argmin(1)


@dataclass
class Index:
    """Two codebooks with their radii, the rows of each cell, and the bins that cells are dealt to.

    ``pairs`` and ``pair_of`` list the cells of each bin, a cell of several bins in each of them.
    """

    half: int
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray
    slack: float

    def deal(self, most: int) -> None:
        """Neighbouring cells share a bin of at most ``most`` rows; a cell of more has several bins."""
        self.first, self.pieces, self.pairs = np.zeros(len(self.rows), np.int64), np.ones(len(self.rows), np.int64), []
        held, bin_ = 0, -1
        for cell in np.flatnonzero(self.rows).tolist():
            n = int(self.rows[cell])
            if n > most or held + n > most or bin_ < 0:
                bin_, held = bin_ + 1, 0
            self.first[cell], self.pieces[cell] = bin_, max(1, math.ceil(n / most))
            self.pairs += [(bin_ + k, cell) for k in range(int(self.pieces[cell]))]
            bin_ += int(self.pieces[cell]) - 1
            held = most if n > most else held + n
        self.pair_bins = np.array([b for b, _ in self.pairs], np.int64)
        self.pair_cells = np.array([c for _, c in self.pairs], np.int64)
        self.bins = bin_ + 1

    def cells_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, : self.half], self.books[0]), nearest(x[:, self.half :], self.books[1])

    def halves(self, anchors: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For each half its scores with the codewords, and how far a member's may be from that."""
        parts = anchors[:, : self.half], anchors[:, self.half :]
        return tuple((p @ b.T, np.sqrt((p * p).sum(1))[:, None] * r[None]) for p, b, r in zip(parts, self.books, self.radii))

    def bounds(self, anchors: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and most that each anchor can score with the vectors of each cell."""
        (a, x), (b, y) = self.halves(anchors)
        i, j = np.divmod(cells, len(self.books[1]))
        middle, reach = a[:, i] + b[:, j], x[:, i] + y[:, j] + self.slack
        return middle - reach, middle + reach

    def probe(self, anchor: np.ndarray, enough: int) -> float:
        """The bound of the last cell that the heap takes, by falling bounds, until its cells hold ``enough`` rows."""
        (a, x), (b, y) = self.halves(anchor[None])
        one, two = (a + x)[0], (b + y)[0]
        by_one, by_two = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
        high_one, high_two = one[by_one].tolist(), two[by_two].tolist()
        width = len(high_two)
        rows = self.rows.reshape(len(high_one), width)[np.ix_(by_one, by_two)]
        queue, have = [(-(high_one[0] + high_two[0]), 0, 0)], 0
        while queue:
            bound, i, j = heapq.heappop(queue)
            have += int(rows[i, j])
            if have >= enough:
                return -bound
            if j + 1 < width:
                heapq.heappush(queue, (-(high_one[i] + high_two[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(high_one):
                heapq.heappush(queue, (-(high_one[i + 1] + high_two[0]), i + 1, 0))
        return -math.inf


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest finite scores, ties to the smaller id."""
    at = np.flatnonzero(scores > -np.inf)
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def _packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


# Anchors travel in packs: one row for each bin and batch.
PACK = "bin int, pack bigint, n bigint, ids binary, labels binary, vectors binary, ranges binary, windows binary"


def _visit(placed: DataFrame, anchors: DataFrame, index, width: int, kept: int, windows: int) -> DataFrame:
    """The first ``kept`` rows that each anchor finds in the cells it visits in a bin.

    ``anchors`` has ``id``, ``label``, ``v``, and ``range`` [floor, top, high]: cells are visited whose bound is at least
    ``floor`` and below ``top`` and whose least score is at most ``high``.  Without ``windows`` it finds rows of its label,
    else rows of other labels with a score inside each window, ``[low, high]`` pairs in ``window``.
    """

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = index.value
        starts = np.flatnonzero(np.concatenate(([True], at.pair_bins[1:] != at.pair_bins[:-1])))
        for batch in batches:
            x, ranges = _matrix(batch.column(2), width), _matrix(batch.column(3), 3)
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            window = _matrix(batch.column(4), 2 * windows) if windows else np.zeros((len(x), 0))
            asks = np.zeros((len(x), at.bins), bool)
            for i in range(0, len(x), BLOCK):
                asks[i : i + BLOCK] = np.logical_or.reduceat(visited(at, x[i : i + BLOCK], ranges[i : i + BLOCK], at.pair_cells), starts, axis=1)
            out = []
            for b in np.flatnonzero(asks.any(0)).tolist():
                rows = np.flatnonzero(asks[:, b])
                parts = (ids, labels, x, ranges, window)
                out.append({"bin": b, "pack": int(ids[rows[0]]), "n": len(rows)} | {n: _packed(p[rows]) for n, p in zip(("ids", "labels", "vectors", "ranges", "windows"), parts)})
                if len(out) == 16:
                    yield pa.RecordBatch.from_pylist(out, schema=packs)
                    out = []
            yield pa.RecordBatch.from_pylist(out, schema=packs)

    def visited(at: Index, x: np.ndarray, ranges: np.ndarray, cells: np.ndarray) -> np.ndarray:
        least, most = at.bounds(x, cells)
        return (most >= ranges[:, :1]) & (most < ranges[:, 1:2]) & (least <= ranges[:, 2:])

    binary = ("ids", "labels", "vectors", "ranges", "windows")
    packs = pa.schema([("bin", pa.int32()), ("pack", pa.int64()), ("n", pa.int64()), *[(c, pa.binary()) for c in binary]])
    columns = ["id", "label", "v", "range", *(["window"] if windows else [])]
    routed = staged(anchors.select(*columns).mapInArrow(route, PACK), "anchors")
    asked = {r["bin"]: r["n"] for r in routed.groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    # Rows of a bin that many anchors ask go to several tasks, each with some of the anchors.
    n_bins = index.value.bins
    parts = F.get(F.array(*[F.lit(math.ceil(asked.get(b, 0) / BIN_ANCHORS)) for b in range(n_bins)]), F.col("bin"))
    rows = placed.withColumn("part", F.explode(F.when(parts > 0, F.sequence(F.lit(0), parts.cast("int") - 1))))
    sent = routed.withColumn("part", F.pmod(F.xxhash64("pack"), parts).cast("int"))

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        at = index.value
        found = [[], [], [], []]
        if len(left) and len(right):
            cells, ids, labels = (left.column(c).to_numpy() for c in ("cell", "id", "label"))
            order = np.argsort(cells, kind="stable")
            cells, ids, labels = cells[order], ids[order], labels[order]
            vectors = _matrix(left.column("v"), width)[order]
            here, of = np.unique(cells, return_inverse=True)
            for pack in right.to_pylist():
                names, kinds = np.frombuffer(pack["ids"], np.int64), np.frombuffer(pack["labels"], np.int64)
                x, ranges = (np.frombuffer(pack[c], np.float64).reshape(len(names), -1) for c in ("vectors", "ranges"))
                window = np.frombuffer(pack["windows"], np.float64).reshape(len(names), windows, 2)
                for i in range(0, len(names), BLOCK):
                    part = slice(i, i + BLOCK)
                    scores = x[part] @ vectors.T
                    scores[~visited(at, x[part], ranges[part], here)[:, of]] = -np.inf
                    for k, row in enumerate(scores, i):
                        alike = labels == kinds[k]
                        if windows:
                            row[alike] = -np.inf
                            ways = [np.where((row >= low) & (row <= high), row, -np.inf) for low, high in window[k]]
                        else:
                            row[~alike | (ids == names[k])] = -np.inf
                            ways = [row]
                        for w, way in enumerate(ways):
                            best = _first(way, ids, kept)
                            for column, values in zip(found, (np.full(len(best), names[k]), np.full(len(best), w), ids[best], way[best])):
                                column.append(values)
        kinds = (np.int64, np.int32, np.int64, np.int64)
        return pa.table({n: np.concatenate([np.zeros(0, t), *f]).astype(t) for n, t, f in zip(("anchor", "way", "id", "score"), kinds, found)})

    by = ["bin", "part"]
    return rows.groupBy(*by).cogroup(sent.groupBy(*by)).applyInArrow(meet, "anchor bigint, way int, id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor", "way").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def build(rows: DataFrame, width: int, n: int, *, sample: int = SAMPLE, cell_rows: int = CELL_ROWS, bin_bytes: int = BIN_BYTES):
    """The index of ``rows`` (``id``, ``v``), and these with the ``cell`` of each and its ``bin``."""
    spark = rows.sparkSession
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(min(sample, max(1, SAMPLE_BYTES // (8 * width)))).select("v").toArrow()
    x = _matrix(chosen.column("v"), width)
    half = (width + 1) // 2
    many = max(1, min(MOST_CODEWORDS, round(math.sqrt(n / cell_rows))))
    books = codebook(x[:, :half], many, 1), codebook(x[:, half:], many, 2) if width > 1 else np.zeros((1, 0))
    index = Index(half, books, (np.zeros(len(books[0])), np.zeros(len(books[1]))), np.zeros(0, np.int64), 0.0)
    shared = spark.sparkContext.broadcast(index)
    across = len(books[1])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        count, far, longest = np.zeros(len(at.books[0]) * across, np.int64), [np.zeros(len(b)) for b in at.books], 0.0
        for batch in batches:
            v = _matrix(batch.column(0), width)
            places = at.cells_of(v)
            count += np.bincount(places[0] * across + places[1], minlength=len(count))
            for h, part in enumerate((v[:, :half], v[:, half:])):
                np.maximum.at(far[h], places[h], np.sqrt(((part - at.books[h][places[h]]) ** 2).sum(1)))
            longest = max(longest, float((v * v).sum(1).max(initial=0)))
        full = np.flatnonzero(count)
        made = [(0, full, count[full].astype(float)), (1, np.arange(len(far[0])), far[0]), (2, np.arange(len(far[1])), far[1]), (3, np.zeros(1, int), np.array([longest]))]
        for kind, place, value in made:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(place), kind), pa.int32()), pa.array(place, pa.int64()), pa.array(value)], names=["kind", "place", "value"])

    # At most MOST_CODEWORDS squared cells, and a radius for each codeword.
    measured = rows.select("v").mapInArrow(measure, "kind int, place bigint, value double").groupBy("kind", "place")
    measured = measured.agg(F.sum("value").alias("total"), F.max("value").alias("most")).collect()
    index.rows = np.zeros(len(books[0]) * across, np.int64)
    longest = 0.0
    for r in measured:
        if r["kind"] == 0:
            index.rows[r["place"]] = int(r["total"])
        elif r["kind"] == 3:
            longest = r["most"]
        else:
            index.radii[r["kind"] - 1][r["place"]] = r["most"]
    if longest >= EXACT:
        raise ValueError("vectors are too long: scores would not be whole numbers in double precision")
    # What rounding may take from a bound.
    index.slack = 1e-9 * longest + 1e-6
    index.deal(max(1, bin_bytes // (8 * width)))
    shared = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            i, j = at.cells_of(_matrix(batch.column(2), width))
            cell = i * across + j
            chance = batch.column(3).to_numpy() % at.pieces[cell]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cell), pa.array((at.first[cell] + chance).astype(np.int32))], names=["id", "label", "v", "cell", "bin"])

    placed = rows.select("id", "label", "v", F.xxhash64("id").alias("chance")).mapInArrow(place, "id bigint, label bigint, v array<double>, cell bigint, bin int")
    return shared, staged(placed, "placed")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: float = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    probe_rows: int = PROBE_ROWS,
    **index_options,
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels in a window.

    Components become ``floor(scale * x)``; a score is the inner product of these.  An anchor's positives are the
    ``positives`` other rows of its label with the highest scores, ties to the smaller id; the negatives of
    one are the first ``negatives`` rows of other labels whose score is from ``low`` to ``high`` percent of the
    positive's.  Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``;
    a positive without negatives has no row.

    Rows with a null key, label or vector, an empty vector, a component that is null or not
    finite, or of another length than the most frequent one, take no part.  Of rows that repeat a key the one with the smallest
    label, then vector, does.  Vectors whose squared length reaches 2**53 are refused.  Without usable rows or anchors
    the result is empty.  Results are exact for any codebooks: those only decide which cells are visited.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    whole = F.transform(quoted(vector).cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    given = quoted(vector).cast("array<double>")
    usable = vectors.where(quoted(key).isNotNull() & label.isNotNull() & _usable(given))
    usable = usable.select(quoted(key).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("q"))
    empty = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    width = usable.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if width is None:
        return empty
    usable = usable.where(F.size("v") == width["width"])
    if usable.groupBy("id").count().where("count > 1").head(1):
        usable = usable.groupBy("id").agg(F.min(F.struct("label", "v", "q")).alias("r")).select("id", "r.*")
    n, width = width["count"], width["width"]
    shared, placed = build(usable, width, n, **index_options)
    asking = usable.where("q").select("id", "label", "v")

    def stops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stop = [shared.value.probe(x, probe_rows) for x in _matrix(batch.column(2), width)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(stop, pa.float64())], names=["id", "label", "v", "stop"])

    asking = staged(asking.mapInArrow(stops, "id bigint, label bigint, v array<double>, stop double"), "asking")
    none, all_ = F.lit(-math.inf), F.lit(math.inf)

    # Positives: the heap's cells, then the cells whose bound reaches the last score found there.
    probed = _visit(placed, asking.withColumn("range", F.array("stop", all_, all_)), shared, width, positives, 0)
    probed = staged(_best(probed, positives), "probed")
    worst = probed.groupBy(F.col("anchor").alias("id")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
    floor = F.when(F.col("n") >= positives, F.col("least")).otherwise(none)
    rest = asking.join(worst, "id", "left").withColumn("range", F.array(floor, "stop", all_))
    more = _visit(placed, rest, shared, width, positives, 0)
    best = staged(_best(probed.drop("rank").unionByName(more), positives), "positives")

    # Negatives: the same for each positive's window.
    limits = best.withColumns(
        {
            "low": F.ceil(F.expr(f"score * {low} / 100.0BD")).cast("double"),
            "high": F.floor(F.expr(f"score * {high} / 100.0BD")).cast("double"),
        }
    )
    by_place = [F.struct(*[F.coalesce(F.max(F.when(F.col("rank") == i + 1, F.col(c))), d).alias(c) for c, d in (("low", all_), ("high", none))]) for i in range(positives)]
    windows = limits.where("low <= high").groupBy(F.col("anchor").alias("id"))
    windows = windows.agg(F.array(*by_place).alias("w"), F.min("low").alias("lowest"), F.max("high").alias("highest"))
    windows = windows.withColumn("window", F.flatten(F.transform("w", lambda x: F.array(x["low"], x["high"])))).drop("w")
    aimed = staged(asking.join(windows, "id"), "aimed")
    near = _visit(placed, aimed.withColumn("range", F.array("stop", all_, "highest")), shared, width, negatives, positives)
    near = staged(_best(near, negatives), "near")
    # A window is certified from its last score found, or from its lower end where it is not full.
    found = near.groupBy(F.col("anchor").alias("id"), "way").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
    full = found.where(F.col("n") >= negatives).groupBy("id").agg(F.map_from_arrays(F.collect_list("way"), F.collect_list("least")).alias("full"))
    ways = F.sequence(F.lit(0), F.lit(positives - 1))
    floors = F.transform(ways, lambda w: F.coalesce(F.try_element_at("full", w), F.get("window", 2 * w)))
    rest = aimed.join(full, "id", "left").withColumn("range", F.array(F.array_min(floors), "stop", "highest"))
    more = _visit(placed, rest, shared, width, negatives, positives)
    last = _best(near.drop("rank").unionByName(more), negatives)
    place = best.select(F.col("anchor").alias("anchor_id"), (F.col("rank") - 1).alias("way"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    last = last.select(F.col("anchor").alias("anchor_id"), "way", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return last.join(place, ["anchor_id", "way"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
