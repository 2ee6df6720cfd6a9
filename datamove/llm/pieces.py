"""SentencePiece (BPE) encoding that keeps where each piece stands in the original bytes, and decoding.

A text is first normalised: at each place the longest prefix that the model's compiled character
map knows is replaced, any other character stays.  Every normalised byte remembers the original byte
it comes from, through the map, the escaped spaces and the space put in front, so each piece is
projected to a span of the original text.  Normalised texts are cut where no piece can reach over,
and each distinct part of a task's slice is merged once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from datamove.llm.arrow import map_texts, quoted, ship_code, text_slices
from datamove.llm.words import hashes

SPACE = "▁".encode()
REPLACEMENT = "�".encode()

# Kinds of pieces of a model file; fixed values of its format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

# Bytes of a part up to which parts are merged side by side; a longer one is merged alone.
SHORT = 96

# The rank of a pair that makes no piece.
NEVER = np.int64(1 << 30)


class CharacterMap:
    """The compiled map: a double array of keys, each with the place of its replacement.

    Its layout is the model format's: the size of the double array, the array of 32-bit units, and
    replacements that end in a zero byte.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        units = np.frombuffer(compiled, np.uint32, size // 4, 4).astype(np.int64)
        self.label = units & ((1 << 31) | 0xFF)
        self.below = (units >> 10) << ((units & (1 << 9)) >> 6)
        self.ends = (units >> 8) & 1 == 1
        self.value = units & ((1 << 31) - 1)
        self.strings = np.frombuffer(compiled, np.uint8, offset=4 + size)
        self.stops = np.flatnonzero(self.strings == 0)

    def longest(self, data: np.ndarray, starts: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each start the length of the longest key there, 0 for none, and its replacement's place."""
        length, value = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        alive = np.arange(len(starts))
        node = np.full(len(starts), self.below[0])
        depth = 0
        while len(alive):
            inside = starts[alive] + depth < limits[alive]
            alive, node = alive[inside], node[inside]
            byte = data[starts[alive] + depth].astype(np.int64)
            node = node ^ byte
            known = node < len(self.label)
            known[known] = self.label[node[known]] == byte[known]
            alive, node = alive[known], node[known]
            depth += 1
            full = self.ends[node]
            node = node ^ self.below[node]
            length[alive[full]] = depth
            value[alive[full]] = self.value[node[full]]
        return length, value


@dataclass(frozen=True)
class PieceModel:
    pieces: list[bytes]
    scores: list[float]
    kinds: np.ndarray
    end: int
    unknown: int
    unknown_surface: bytes
    byte_fallback: bool
    dummy_prefix: bool
    squeeze: bool  # runs of spaces become one, those at the ends go
    compiled: bytes

    @cached_property
    def ids(self) -> dict[bytes, int]:
        return {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == NORMAL}

    @cached_property
    def byte_ids(self) -> list[int]:
        place = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        return [place[b"<0x%02X>" % i] for i in range(256)] if place else []

    @cached_property
    def map(self) -> CharacterMap | None:
        return CharacterMap(self.compiled) if self.compiled else None

    @cached_property
    def cuts_at_spaces(self) -> bool:
        """Whether no piece goes on with a space after another character."""
        return not any(SPACE in p.lstrip(SPACE) for p in self.ids)

    @cached_property
    def table(self) -> "MergeTable":
        return MergeTable(self)

    def merge(self, part: bytes) -> list[bytes]:
        """The symbols of a normalised part: the pair with the best score is merged, the first of several."""
        ids, scores = self.ids, self.scores
        symbols = [c.encode() for c in part.decode()]
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, int, int]] = []

        def ask(left: int, right: int) -> None:
            if left >= 0 and right < n and (found := ids.get(symbols[left] + symbols[right])) is not None:
                heapq.heappush(queue, (-scores[found], left, right, len(symbols[left]) + len(symbols[right])))

        for i in range(n - 1):
            ask(i, i + 1)
        while queue:
            _, left, right, size = heapq.heappop(queue)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = b""
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            ask(before[left], left)
            ask(left, after[left])
        return [s for s in symbols if s]


class MergeTable:
    """What merging many parts at once looks up: symbols of characters, and of pairs the piece they make.

    Symbols are the ids of pieces, then characters that only stand inside pieces, then one for all
    others.
    """

    def __init__(self, model: PieceModel):
        ids = model.ids
        symbols = dict(ids)
        for piece in ids:
            for c in piece.decode():
                if c.encode() not in symbols:
                    symbols[c.encode()] = len(model.pieces) + len(symbols) - len(ids)
        self.none = len(model.pieces) + len(symbols) - len(ids)
        self.of_char = np.full(0x110000, self.none, np.int32)
        for name, symbol in symbols.items():
            if len(name.decode()) == 1:
                self.of_char[ord(name.decode())] = symbol
        # Pieces of one score are equally good.
        _, rank = np.unique(-np.array(model.scores), return_inverse=True)
        keys, made = [], []
        for piece, i in ids.items():
            chars = piece.decode()
            for cut in range(1, len(chars)):
                left, right = symbols.get(chars[:cut].encode()), symbols.get(chars[cut:].encode())
                if left is not None and right is not None:
                    keys.append(left * (self.none + 1) + right)
                    made.append(i)
        order = np.argsort(np.array(keys, np.int64))
        # A last entry that no pair has, so that every search ends inside.
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.made = np.append(np.array(made, np.int32)[order], 0)
        self.rank = rank

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that each pair makes, and its rank; ``NEVER`` where none."""
        key = left.astype(np.int64) * (self.none + 1) + right
        at = np.searchsorted(self.keys, key)
        made = self.made[at]
        return made, np.where(self.keys[at] == key, self.rank[made], NEVER)

    def merge(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of all parts, the part of each, and at which byte it begins; one merge of every part at a time."""
        at = _spread(starts, ends - starts)
        at = at[(data[at] & 0xC0) != 0x80]
        part = np.searchsorted(starts, at, "right") - 1
        symbol = self.of_char[_code_points(data, at)]
        made, rank = np.zeros(len(at), np.int32), np.full(len(at), NEVER)
        inner = np.flatnonzero(part[1:] == part[:-1])
        made[inner], rank[inner] = self.pairs(symbol[inner], symbol[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(at):
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            best = np.minimum.reduceat((rank << 32) + np.arange(len(rank)), first)
            open_ = best < (NEVER << 32)
            if not open_.all():
                width = np.diff(np.append(first, len(at)))
                whole = np.repeat(~open_, width)
                done.append((part[whole], at[whole], symbol[whole]))
                go_on = ~whole
                shift = np.cumsum(whole)
                left = (best[open_] & 0xFFFFFFFF)
                left = left - shift[left]
                part, at, symbol, made, rank = part[go_on], at[go_on], symbol[go_on], made[go_on], rank[go_on]
            else:
                left = best & 0xFFFFFFFF
            if not len(at):
                break
            symbol[left] = made[left]
            keep = np.ones(len(at), bool)
            keep[left + 1] = False
            part, at, symbol, made, rank = part[keep], at[keep], symbol[keep], made[keep], rank[keep]
            left = left - np.arange(len(left))  # one symbol fewer for each part before
            rank[left] = NEVER
            again = np.concatenate((left[left > 0] - 1, left[left + 1 < len(at)]))
            again = again[part[again] == part[again + 1]]
            made[again], rank[again] = self.pairs(symbol[again], symbol[again + 1])
        part, at, symbol = (np.concatenate([np.zeros(0, np.int64), *[d[i] for d in done]]) for i in range(3))
        order = np.argsort(part, kind="stable")
        return symbol[order], part[order], at[order]


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The characters that begin at these bytes of UTF-8."""
    lead = data[at].astype(np.int64)
    code = lead.copy()
    for size, low, bits in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        rows = np.flatnonzero(lead >= low)
        code[rows] = lead[rows] & bits
        for i in range(1, size):
            follow = data[np.minimum(at[rows] + i, len(data) - 1)]
            code[rows] = (code[rows] << 6) | (follow & 0x3F)
    return np.minimum(code, 0x10FFFF)


def read_model(path: str) -> PieceModel:
    """The model of a file; one that cuts texts in another way than here is refused."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    return _model(proto)


def _model(proto) -> PieceModel:
    train, norm = proto.trainer_spec, proto.normalizer_spec
    kinds = np.array([p.type for p in proto.pieces], np.int8)
    odd = {
        "models other than BPE": train.model_type != 2,
        "pieces defined by the user or unused": bool(np.isin(kinds, (USER_DEFINED, UNUSED)).any()),
        "spaces as suffixes": train.treat_whitespace_as_suffix,
        "spaces that are not escaped": not norm.escape_whitespaces,
        "maps for decoding": bool(proto.denormalizer_spec.precompiled_charsmap),
    }
    if any(odd.values()):
        raise ValueError("not supported: " + ", ".join(k for k, v in odd.items() if v))
    names = [p.piece for p in proto.pieces]
    return PieceModel(
        pieces=[n.encode() for n in names],
        scores=[p.score for p in proto.pieces],
        kinds=kinds,
        end=names.index(train.eos_piece),
        unknown=int(np.flatnonzero(kinds == UNKNOWN)[0]),
        unknown_surface=train.unk_surface.encode(),
        byte_fallback=train.byte_fallback,
        dummy_prefix=norm.add_dummy_prefix,
        squeeze=norm.remove_extra_whitespaces,
        compiled=norm.precompiled_charsmap,
    )


@dataclass
class Normalised:
    """Normalised texts end to end, the n + 1 offsets of the texts, and each byte's original place.

    ``origin`` counts from the text's own beginning; ``ends`` is where the last byte of each text ends there.
    """

    data: np.ndarray
    offsets: np.ndarray
    origin: np.ndarray
    ends: np.ndarray


def _kept(data: np.ndarray, offsets: np.ndarray, origin: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[offsets], origin[keep]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``lengths[i]`` places each."""
    begins = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - begins, lengths)


def normalise(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> Normalised:
    """Longest-prefix replacement, spaces squeezed, marked and put in front, as the model says."""
    sizes = np.diff(offsets)
    tail = sizes.copy()
    origin = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    if model.map is not None and len(data):
        starts = np.flatnonzero((data & 0xC0) != 0x80)
        text = np.searchsorted(offsets, starts, "right") - 1
        length, value = model.map.longest(data, starts, offsets[1:][text])
        char = np.diff(np.append(starts, len(data)))
        reach = starts + np.where(length, length, char)
        # A key longer than its first character takes the next ones with it.
        step = np.ones(len(starts), bool)
        until = 0
        for i in np.flatnonzero(length > char):
            if starts[i] >= until:
                until = reach[i]
                j = np.searchsorted(starts, until)
                step[i + 1 : j] = False
        starts, reach, length, value, text = starts[step], reach[step], length[step], value[step], text[step]
        stop = model.map.stops[np.minimum(np.searchsorted(model.map.stops, value), len(model.map.stops) - 1)] if len(model.map.stops) else value
        lengths = np.where(length > 0, stop - value, reach - starts)
        source = np.concatenate((data, model.map.strings))
        at = np.where(length > 0, value + len(data), starts)
        origin = np.repeat(origin[starts], lengths)
        total = np.concatenate(([0], np.cumsum(lengths)))
        offsets = total[np.searchsorted(text, np.arange(len(offsets)))]
        data = source[_spread(at, lengths)]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    space = data == 0x20
    if model.squeeze and len(data):
        follows = np.concatenate(([True], space[:-1])) | first[:-1]
        data, offsets, origin = _kept(data, offsets, origin, ~(space & follows))
        space = data == 0x20
    # Each space becomes the three bytes of its mark; one more goes in front of a text that is not empty.
    front = ((np.diff(offsets) > 0) if model.squeeze else sizes > 0) & model.dummy_prefix
    width = np.where(space, 3, 1)
    before = np.concatenate(([0], np.cumsum(width)))
    ahead = np.concatenate(([0], np.cumsum(3 * front)))
    begins = before[offsets] + ahead
    out = np.empty(int(before[-1] + ahead[-1]), np.uint8)
    where = np.empty(len(out), np.int64)
    text = np.repeat(np.arange(len(front)), np.diff(offsets))
    at = before[:-1] + ahead[1:][text]
    mark = np.frombuffer(SPACE, np.uint8)
    out[at[~space]] = data[~space]
    where[at] = origin
    # The mark in front stands where the text begins, behind spaces that go.
    lead = origin[np.minimum(offsets[:-1][front], len(data) - 1)] if model.squeeze else 0
    for i in range(3):
        out[at[space] + i] = mark[i]
        where[at[space] + i] = origin[space]
        out[begins[:-1][front] + i] = mark[i]
        where[begins[:-1][front] + i] = lead
    if model.squeeze:  # marks at a text's end go, even the one in front
        ends = begins[1:].copy()
        open_ = np.flatnonzero(ends > begins[:-1])
        while len(open_):
            at = ends[open_] - 3
            open_ = open_[(at >= begins[:-1][open_]) & (out[np.maximum(at, 0)] == mark[0]) & (out[at + 1] == mark[1]) & (out[at + 2] == mark[2])]
            ends[open_] -= 3
            tail[open_] = where[ends[open_]]
        gone = np.zeros(len(out), bool)
        gone[_spread(ends, begins[1:] - ends)] = True
        out, begins, where = _kept(out, begins, where, ~gone)
    return Normalised(out, begins, where, tail)


def _parts(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where parts begin that can be merged alone: at texts, and at marks after other characters."""
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    if model.cuts_at_spaces and len(data) > 3:
        mark = np.zeros(len(data) + 1, bool)
        mark[: len(data) - 2] = (data[:-2] == SPACE[0]) & (data[1:-1] == SPACE[1]) & (data[2:] == SPACE[2])
        after = np.zeros(len(data) + 1, bool)
        after[3:] = mark[:-3]
        begins |= mark & ~after
    begins[len(data)] = False
    return np.flatnonzero(begins)


def _merged(model: PieceModel, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all parts in order, the byte of its part at which each begins, and how many a part has."""
    short = np.flatnonzero(ends - starts <= SHORT)
    order = short[np.argsort(starts[short])]
    symbol, part, at = model.table.merge(data, starts[order], ends[order])
    part = order[part]
    long = np.flatnonzero(ends - starts > SHORT)
    if len(long):
        rows = [(i, model.merge(data[starts[i] : ends[i]].tobytes())) for i in long.tolist()]
        sizes = [np.array([len(s) for s in found], np.int64) for _, found in rows]
        name, none = model.ids, model.table.none
        symbol = np.concatenate((symbol, *[np.array([name.get(s, none) for s in found], np.int64) for _, found in rows]))
        part = np.concatenate((part, *[np.full(len(found), i) for i, found in rows]))
        at = np.concatenate((at, *[starts[i] + np.cumsum(size) - size for (i, _), size in zip(rows, sizes)]))
    order = np.argsort(part, kind="stable")
    symbol, part, at = symbol[order], part[order], at[order]
    unknown = symbol >= len(model.pieces)
    if unknown.any():
        if model.byte_fallback:  # a byte id for each byte; the last stands for the character, those before it for nothing
            lead = data[at]
            size = np.where(unknown, 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0), 1)
            byte = data[_spread(at, size)]
            symbol, part, at, unknown = (np.repeat(x, size) for x in (symbol, part, at, unknown))
            symbol[unknown] = np.array(model.byte_ids)[byte[unknown]]
        else:  # unknown characters in a row are one
            symbol[unknown] = model.unknown
            again = np.concatenate(([False], unknown[1:] & unknown[:-1] & (part[1:] == part[:-1])))
            symbol, part, at = symbol[~again], part[~again], at[~again]
    return symbol.astype(np.int32), at - starts[part], np.bincount(part, minlength=len(starts))


def encode_slice(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the texts end to end, the n + 1 offsets of texts, and each id's original span."""
    normal = normalise(model, data, offsets)
    starts = _parts(model, normal.data, normal.offsets)
    ends = np.append(starts[1:], len(normal.data))[: len(starts)]
    n = len(offsets) - 1
    if len(starts):
        _, first, which = np.unique(hashes(normal.data, starts, ends), return_index=True, return_inverse=True)
        lengths = ends - starts
        lead = first[which]
        # A hash only proposes that parts are alike.
        differ = lengths != lengths[lead]
        same = ~differ
        unequal = normal.data[_spread(starts[same], lengths[same])] != normal.data[_spread(starts[lead[same]], lengths[same])]
        if unequal.any() or differ.any():
            first, which = np.arange(len(starts)), np.arange(len(starts))
        ids, places, many = _merged(model, normal.data, starts[first], ends[first])
        begins = np.cumsum(many) - many
        count = many[which]
        take = _spread(begins[which], count)
        ids = ids[take]
        at = places[take] + np.repeat(starts, count)
        before = np.concatenate(([0], np.cumsum(count)))[np.searchsorted(starts, normal.offsets)]
        if not model.byte_fallback:  # unknown characters in a row are one also where parts meet
            text_first = np.zeros(len(ids) + 1, bool)
            text_first[before] = True
            again = np.concatenate(([False], (ids[1:] == model.unknown) & (ids[:-1] == model.unknown))) & ~text_first[:-1]
            before = np.concatenate(([0], np.cumsum(~again)))[before]
            ids, at = ids[~again], at[~again]
    else:
        ids, at, before = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    # A piece ends where the next one of its text begins, or with its text.
    sizes = np.diff(offsets)
    begin = normal.origin[at]
    stop = np.append(begin[1:], 0)[: len(begin)]
    last = before[1:][np.diff(before) > 0] - 1
    stop[last] = normal.ends[np.diff(before) > 0]
    # The end id follows each text.
    whole = before + np.arange(n + 1)
    out = np.empty(len(ids) + n, np.int32)
    kept = np.ones(len(out), bool)
    kept[whole[1:] - 1] = False
    spans = [np.empty(len(out), np.int32), np.empty(len(out), np.int32)]
    out[kept], out[~kept] = ids, model.end
    spans[0][kept], spans[0][~kept] = begin, sizes
    spans[1][kept], spans[1][~kept] = stop, sizes
    return out, whole, spans[0], spans[1]


def _loaded(spark: SparkSession, model: PieceModel):
    ship_code(spark)
    return spark.sparkContext.broadcast(model)


def encode_pieces(docs: DataFrame, keep: Sequence[str], *, model: PieceModel, text: str = "text") -> DataFrame:
    """The ``keep`` columns with the ids of each text, the end id last, and each id's original span.

    ``ids`` array<int>; ``starts`` and ``ends`` array<int>, bytes of the UTF-8 text.  Spans lie end to
    end in order; the mark put in front of a text and all but the last byte id of a character have
    empty ones, as has the end id.  A null or empty text has the end id alone.  Rows may repeat, and
    ``keep`` may not name a column like those added.  Texts are taken in slices of a megabyte; a longer one is taken
    alone, in memory of some 60 bytes a byte.
    """
    clash = {"ids", "starts", "ends"} & set(keep)
    if clash:
        raise ValueError(f"keep names columns of the result: {sorted(clash)}")
    loaded = _loaded(docs.sparkSession, model)

    def work(columns: Iterator[pa.Array]) -> Iterator[list[pa.Array]]:
        for column in columns:
            out = [[pa.array([], pa.list_(pa.int32()))] for _ in range(3)]
            for _, _, data, offsets in text_slices(column):
                ids, of, starts, ends = encode_slice(loaded.value, data, offsets)
                of = pa.array(of.astype(np.int32))
                for made, values in zip(out, (ids, starts, ends)):
                    made.append(pa.ListArray.from_arrays(of, pa.array(values, pa.int32())))
            yield [pa.concat_arrays(made) for made in out]

    return map_texts(docs, text, keep, [("ids", "array<int>"), ("starts", "array<int>"), ("ends", "array<int>")], work)


def _surfaces(model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ids end to end, and their offsets."""
    made = []
    for i, (piece, kind) in enumerate(zip(model.pieces, model.kinds)):
        if kind == CONTROL:
            made.append(b"")
        elif kind == UNKNOWN:
            made.append(model.unknown_surface)
        elif kind == BYTE:
            made.append(bytes([int(piece[3:5], 16)]))
        else:
            made.append(piece.replace(SPACE, b" "))
    return np.frombuffer(b"".join(made), np.uint8), np.concatenate(([0], np.cumsum([len(m) for m in made])))


def _repaired(run: bytes) -> bytes:
    """Bytes that begin no character become one replacement character each."""
    out, i = [], 0
    while i < len(run):
        for size in (1, 2, 3, 4):
            try:
                run[i : i + size].decode()
            except UnicodeDecodeError:
                continue
            if i + size <= len(run):
                out.append(run[i : i + size])
                i += size
                break
        else:
            out.append(REPLACEMENT)
            i += 1
    return b"".join(out)


def decode_ids(model: PieceModel, ids: np.ndarray, offsets: np.ndarray, surfaces: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
    """The text of each run of ids."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(model.pieces)):
        raise ValueError("an id is not one of the model's")
    data, of = surfaces
    lengths = (of[1:] - of[:-1])[ids]
    raw = data[_spread(of[ids], lengths)].tobytes()
    ends = np.concatenate(([0], np.cumsum(lengths)))
    kinds = model.kinds[ids]
    marked = np.array([p.startswith(SPACE) for p in model.pieces])
    strips = model.dummy_prefix or model.squeeze
    parted = np.zeros(len(ids), bool)
    parted[1:] = (kinds[1:] == CONTROL) & (kinds[:-1] == BYTE)
    out = []
    for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        first = x
        while first < y and kinds[first] == CONTROL:
            first += 1
        begin = int(ends[first])
        if strips:
            while first < y and kinds[first] == NORMAL and marked[ids[first]]:
                begin = int(ends[first]) + 1
                if not model.squeeze or begin < ends[first + 1]:
                    break
                first += 1
                while first < y and kinds[first] == CONTROL:
                    first += 1
        text = raw[begin : int(ends[y])]
        try:
            # Byte ids on both sides of one without a text make no character together.
            broken = parted[first:y].any()
            text.decode()
        except UnicodeDecodeError:
            broken = True
        if broken:
            parts, i = [], first
            while i < y:
                j = i + 1
                while j < y and (kinds[j] == BYTE) == (kinds[i] == BYTE):
                    j += 1
                part = raw[max(begin, int(ends[i])) : int(ends[j])]
                parts.append(_repaired(part) if kinds[i] == BYTE else part)
                i = j
            text = b"".join(parts)
        out.append(text)
    return out


def decode_pieces(df: DataFrame, keep: Sequence[str], *, model: PieceModel, ids: str = "ids") -> DataFrame:
    """The ``keep`` columns with ``decoded``, the text of the ids; null ids are an empty text."""
    if "decoded" in keep:
        raise ValueError("keep names a column of the result: decoded")
    loaded = _loaded(df.sparkSession, model)
    source = df.select(*[quoted(c) for c in keep], quoted(ids).alias("__ids__"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surfaces = _surfaces(loaded.value)
        for batch in batches:
            column = batch.column(len(keep)).fill_null([])
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            texts = decode_ids(loaded.value, values, offsets - offsets[0], surfaces)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([t.decode() for t in texts], pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)
