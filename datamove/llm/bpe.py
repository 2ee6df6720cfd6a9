"""Byte-level BPE: every distinct word of the corpus is encoded once.

Tasks cut texts into pre-tokens and number the distinct ones of a block of texts; a text becomes
the numbers in order.  The distinct words of all blocks meet in one shuffle by a hash of the word,
packed into one row for a block and hash; there each word is encoded once and its ids handed to
every block that asked.  A second shuffle by block puts them back in place.  A frequent word
costs an entry for each block, never for each use.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from datamove.llm.arrow import TEXT, quoted, ship_code, text_slices, tidied
from datamove.llm.words import hashes

# Bytes of text in a block, over which distinct words are shared; a longer text is its own.
BLOCK_BYTES = 6 << 20

# Hash values of words for each shuffle partition; a task remembers the words of one at a time.
HASHES_PER_PARTITION = 1

# Words of a hash that a task remembers; of more it encodes some again.
MOST_KNOWN = 500_000

# Bytes that may end, and may begin, a character of white space.
ENDS_BLANK, BEGINS_BLANK = np.zeros(256, bool), np.zeros(256, bool)
ENDS_BLANK[[*range(9, 14), *range(28, 33), *range(128, 192)]] = True
BEGINS_BLANK[[*range(9, 14), *range(28, 33), 0xC2, 0xE1, 0xE2, 0xE3]] = True

# The pattern that the rules for cutting texts below are made for, a fixed value.
PLAIN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Plain bytes: ASCII letters and the first of two-byte ones, digits, and marks but the apostrophe
# with which the pattern's contractions begin; a space stands before what it goes with.
KINDS = np.zeros(256, np.uint8)
KINDS[[*range(65, 91), *range(97, 123), 0xC3]] = 1
KINDS[48:58] = 2
KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = 3
KINDS[32] = 4

# A byte vocabulary beyond this is not sent to the tasks.
VOCABULARY_LIMIT = 64 << 20

BLOCK, HASH, WORDS, LENGTHS, IDS, ROWS, HASHES = (f"__{n}__" for n in ("block", "hash", "words", "lengths", "ids", "rows", "hashes"))


class Packer:
    """Compression with contexts made once."""

    def __init__(self) -> None:
        self.pack = zstandard.ZstdCompressor(level=3).compress
        self.unpack = zstandard.ZstdDecompressor().decompress

    def squeeze(self, values: np.ndarray) -> bytes:
        """32-bit numbers, compressed byte plane by byte plane."""
        planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
        return self.pack(planes.tobytes())

    def expand(self, data: bytes) -> np.ndarray:
        planes = np.frombuffer(self.unpack(data), np.uint8).reshape(4, -1)
        return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def read_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks, from a local file of base64 and number on each line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    if sum(map(len, ranks)) + 40 * len(ranks) > VOCABULARY_LIMIT:
        raise ValueError("the vocabulary is too large to send to every task")
    return ranks


class Block:
    """Pre-tokens of some texts, numbered as they first occur, and the texts as numbers.

    A text falls apart before each of its spaces into pieces whose pre-tokens do not depend on
    each other, unless a space has white space before it and white space or the end after it;
    a text with such a space is one piece.  A piece of nothing but letters, digits and marks that
    are plain (see ``KINDS``) falls apart where these change, its space going with what follows;
    other pieces go through the pattern.  Either way each distinct unit, told by a 64-bit
    hash, is looked at once.  Under any other pattern than ``PLAIN_PATTERN`` a text is one piece.
    """

    def __init__(self, pattern: str):
        self.match = regex.compile(pattern).findall
        self.plain = pattern == PLAIN_PATTERN
        self.words: dict[str, int] = {}
        self.units: dict[int, int] = {}
        self.flat: list[int] = []
        self.lengths: list[int] = []
        self.slices: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where units start, and which of them go through the pattern."""
        sizes = np.diff(offsets)
        space = data == 32
        last, first = np.zeros(len(data), bool), np.zeros(len(data), bool)
        last[(offsets[1:] - 1)[sizes > 0]] = True
        first[offsets[:-1][sizes > 0]] = True
        before = ENDS_BLANK[np.append(data[:1], data[:-1])] & ~first
        after = BEGINS_BLANK[np.append(data[1:], data[:1])] | last
        begins = space | first
        for text in np.unique(np.searchsorted(offsets, np.flatnonzero(space & before & after), "right") - 1).tolist():
            begins[offsets[text] + 1 : offsets[text + 1]] = False
        starts = np.flatnonzero(begins)
        kind = KINDS[data]
        # A two-byte letter is one by its second byte too.
        second = np.append(False, data[:-1] == 0xC3) & (data >= 0x80) & (data < 0xC0) & (data != 0x97) & (data != 0xB7)
        kind[second] = 1
        pair = np.flatnonzero(data == 0xC3)
        kind[pair[~np.append(second, False)[pair + 1]]] = 0
        odd = kind == 0
        odd |= space & (~begins | np.append(begins[1:], True))
        complex_ = np.add.reduceat(odd, starts) > 0
        change = np.append(False, kind[1:] != kind[:-1]) & ~np.append(False, (space & begins)[:-1])
        change &= ~np.repeat(complex_, np.diff(np.append(starts, len(data))))
        whole = np.zeros(len(data), bool)
        whole[starts[complex_]] = True
        starts = np.flatnonzero(begins | change)
        return starts, whole[starts]

    def add(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.size += len(data)
        if not len(data):
            self.slices.append((np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)))
            return
        if self.plain:
            starts, complex_ = self._cut(data, offsets)
        else:
            starts = offsets[:-1][np.diff(offsets) > 0]
            complex_ = np.ones(len(starts), bool)
        ends = np.append(starts[1:], len(data))
        keys = hashes(data, starts, ends) + complex_.astype(np.uint64)
        found, at, back = np.unique(keys, return_index=True, return_inverse=True)
        raw, found = data.tobytes(), found.tolist()
        numbers = np.array(list(map(self.units.get, found, [-1] * len(found))), np.int32)
        words, new = self.words, np.flatnonzero(numbers < 0)
        at = at[new]
        for i, start, end, by_pattern in zip(new.tolist(), starts[at].tolist(), ends[at].tolist(), complex_[at].tolist()):
            self.units[found[i]] = len(self.lengths)
            text = raw[start:end].decode()
            if by_pattern:
                parts = self.match(text)
                self.flat += [words.setdefault(w, len(words)) for w in parts]
                self.lengths.append(len(parts))
            else:
                self.flat.append(words.setdefault(text, len(words)))
                self.lengths.append(1)
        numbers[new] = np.arange(len(self.lengths) - len(new), len(self.lengths))
        self.slices.append((numbers[back.reshape(-1)], np.searchsorted(starts, offsets)))

    def sequences(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each slice of texts its word numbers in a row, and how many are each text's."""
        lengths, flat = np.array(self.lengths, np.int64), np.array(self.flat, np.uint32)
        begins = np.cumsum(lengths) - lengths
        for pieces, of in self.slices:
            ends = np.append(0, np.cumsum(lengths[pieces]))[of]
            yield gathered(flat, begins, lengths, pieces), np.diff(ends)

    def name(self, index: int) -> str:
        """Its task, its rank there, and its content, on which both readings must agree."""
        content = zlib.crc32("\0".join(self.words).encode(), len(self.slices))
        return f"{TaskContext.get().partitionId()}-{index}-{len(self.words)}-{content}"


def gathered(flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` that ``which`` names, one after another."""
    many = lengths[which]
    shift = begins[which] - (np.cumsum(many) - many)
    return flat[np.arange(int(many.sum())) + np.repeat(shift, many)]


def _packed_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, width: int, carry: bool) -> Iterator[tuple[list[bytes], Block]]:
    """The kept columns, if asked for, and the numbered texts of one block after another."""
    rows, block = [], Block(pattern)
    for batch in batches:
        kept = batch.select(list(range(width))) if width else None
        for i, j, data, offsets in text_slices(batch.column(width)):
            block.add(data, offsets)
            if carry:
                rows.append(_packed_rows(kept.slice(i, j - i)) if width else b"")
            if block.size >= BLOCK_BYTES:
                yield rows, block
                pa.default_memory_pool().release_unused()
                rows, block = [], Block(pattern)
    if block.slices:
        yield rows, block


def encode_texts(docs: DataFrame, keep: Sequence[str], *, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """The ``keep`` columns of every document with ``ids``, little-endian 32-bit token ids.

    Each match of ``pattern`` is encoded by itself, without special tokens.  Null and empty texts
    have no ids; repeated rows stay; an empty table gives none.  The table is read twice, so it
    must be one that reads the same each time: a stored table, or files.  If it does not, the
    job fails rather than mix up words.
    """
    spark = docs.sparkSession
    ship_code(spark)
    source = docs.select(*[quoted(c) for c in keep], quoted(text).cast("string").alias(TEXT))
    width = len(keep)
    kept = source.schema.fields[:-1]
    n_hashes = HASHES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def hashed(block: Block) -> np.ndarray:
        return np.fromiter((zlib.crc32(w.encode()) % n_hashes for w in block.words), np.uint32, len(block.words))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        for index, (_, block) in enumerate(_blocks(batches, pattern, width, carry=False)):
            of, words = hashed(block), np.array([w.encode() for w in block.words], object)
            order = np.argsort(of, kind="stable")
            values, first = np.unique(of[order], return_index=True)
            parts = np.split(words[order], first[1:]) if len(values) else []
            packed = [packer.pack(b"".join(part)) for part in parts]
            sizes = [packer.squeeze(np.fromiter(map(len, part), np.uint32, len(part))) for part in parts]
            columns = [pa.array([block.name(index)] * len(values), pa.string()), pa.array(values.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary()), pa.array(sizes, pa.binary())], names=[BLOCK, HASH, WORDS, LENGTHS])

    shared = spark.sparkContext.broadcast(ranks)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        current, known, packer = None, {}, Packer()
        for batch in batches:
            columns = [[], []]
            for value, packed, sizes in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                if value != current or len(known) > MOST_KNOWN:  # rows come sorted by hash
                    current, known = value, {}
                raw, ends = packer.unpack(packed), np.cumsum(packer.expand(sizes), dtype=np.int64).tolist()
                ids = []
                for begin, end in zip([0, *ends], ends):
                    word = raw[begin:end]
                    if word not in known:
                        known[word] = np.array(encoding.encode_ordinary(word.decode()), np.uint32).tobytes()
                    ids.append(known[word])
                columns[0].append(packer.squeeze(np.frombuffer(b"".join(ids), np.uint32)))
                columns[1].append(packer.squeeze(np.fromiter(map(len, ids), np.uint32, len(ids)) // 4))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, pa.binary()) for c in columns]], names=[BLOCK, HASH, IDS, LENGTHS])

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer()
        for index, (rows, block) in enumerate(_blocks(batches, pattern, width, carry=True)):
            made = [(packer.squeeze(numbers), packer.squeeze(counts)) for numbers, counts in block.sequences()]
            heads = [packer.squeeze(hashed(block))] + [None] * (len(rows) - 1)
            columns = [pa.array(c, pa.binary()) for c in (rows, [m[1] for m in made], [m[0] for m in made], heads)]
            yield pa.RecordBatch.from_arrays([pa.array([block.name(index)] * len(rows)), *columns], names=[BLOCK, ROWS, LENGTHS, IDS, HASHES])

    def put_back(left: pa.Table, right: pa.Table) -> pa.Table:
        packer = Packer()
        if not len(left):
            raise RuntimeError("the documents changed between two readings")
        of = packer.expand(next(h for h in left.column(HASHES).to_pylist() if h is not None))
        order = np.argsort(np.array(right.column(HASH).to_pylist(), np.int64), kind="stable").tolist()
        lengths, flat = (np.concatenate([np.zeros(0, np.uint32), *[packer.expand(right.column(c)[i].as_py()) for i in order]]) for c in (LENGTHS, IDS))
        if len(lengths) != len(of):
            raise RuntimeError("the documents changed between two readings")
        # Answers stand by hash, then as the words first occurred.
        place = np.empty(len(of), np.int64)
        place[np.argsort(of, kind="stable")] = np.arange(len(of))
        lengths = lengths.astype(np.int64)
        begins = (np.cumsum(lengths) - lengths)[place]
        lengths = lengths[place]
        done = []
        for rows, counts, numbers in zip(*(left.column(c).to_pylist() for c in (ROWS, LENGTHS, IDS))):
            numbers, counts = packer.expand(numbers).astype(np.int64), packer.expand(counts)
            ids = gathered(flat, begins, lengths, numbers).astype("<u4")
            ends = np.append(0, np.cumsum(lengths[numbers]))[np.append(0, np.cumsum(counts, dtype=np.int64))]
            made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)])
            kept = pa.ipc.open_stream(rows).read_all().columns if width else []
            done.append(pa.table([*kept, made.cast(pa.binary())], names=out.names))
        return pa.concat_tables(done).combine_chunks()

    asked = source.mapInArrow(tidied(ask), f"{BLOCK} string, {HASH} int, {WORDS} binary, {LENGTHS} binary")
    answered = asked.repartition(F.col(HASH)).sortWithinPartitions(HASH).mapInArrow(tidied(answer), f"{BLOCK} string, {HASH} int, {IDS} binary, {LENGTHS} binary")
    held = source.mapInArrow(tidied(hold), f"{BLOCK} string, {ROWS} binary, {LENGTHS} binary, {IDS} binary, {HASHES} binary")
    out = T.StructType([*kept, T.StructField("ids", T.BinaryType())])
    return held.groupBy(BLOCK).cogroup(answered.groupBy(BLOCK)).applyInArrow(put_back, out)


def decode_ids(encoded: DataFrame, keep: Sequence[str], *, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """The ``keep`` columns of every row with ``decoded``, the bytes that its token ids stand for.

    The token-byte table, whose size is checked, goes to every task and is joined there by id.
    Null ids decode to nothing; an id outside the table is an error.
    """
    ship_code(encoded.sparkSession)
    source = encoded.select(*[quoted(c) for c in keep], quoted(ids).cast("binary").alias(TEXT))
    width = len(keep)
    table = encoded.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(table.value.values(), default=-1) + 1
        tokens: list[bytes | None] = [None] * most
        for token, rank in table.value.items():
            tokens[rank] = token
        for batch in batches:
            out = [b"".join([tokens[i] for i in np.frombuffer(x.as_py() or b"", np.uint32).tolist()]) for x in batch.column(width)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(out, pa.binary())], names=schema.names)

    return source.mapInArrow(tidied(run), schema)
