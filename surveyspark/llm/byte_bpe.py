"""Byte-level BPE encoding and decoding with a regex-free, vectorised pre-tokeniser.

Pre-tokenisation follows the pattern that the rank files are made for
(contractions, an optional space before letters, numbers or other characters,
white space up to the last before a word). Each code point gets a class; where
the pattern looks ahead, the class takes the next code points in. A class is a
transition function over eight states, and functions compose, so a scan over
blocks finds the state before every code point: blocks compose their functions
column by column, the blocks' functions are scanned by doubling, and a last
sweep marks the starts of slices.

Each distinct slice is merged once (by a list for short slices, by a heap for
long ones, always the lowest rank, leftmost first) and cached. Slices keep
their byte offsets; decoding joins the bytes of the ids.

A null text is empty and has no ids. Each row gives one row, repeated rows
included, and an empty table none; a text of any length is one row. Columns
other than the id and the text are not read; ``decode`` keeps all columns and
puts its text in place of one that has that name.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import small_batches, source
from .text import lean

# classes
LETTER, NUMBER, OTHER, APO1, APO2, WS_RUN, WS_SPACE, WS_LAST, RESET = range(9)
# states: nothing open, in letters, in numbers, in others, in white space, after a leading space,
# one or two letters of a contraction to come
FREE, IN_L, IN_N, IN_O, IN_W, LEAD, ONE, TWO = range(8)
#: The code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Ranges of letters and numbers later than Unicode 16, which the tiktoken library's tables have.
LATER = [(0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4),
         (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
         (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6),
         (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
         (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
         (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F)]
BLOCK = 64
CHUNK = 1 << 19
_CACHE = 300_000


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a slice starts, by class and state."""
    to, start = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for cls, state in ((LETTER, IN_L), (NUMBER, IN_N), (OTHER, IN_O)):
        to[cls] = state
        start[cls, [state, LEAD]] = False
    to[LETTER, ONE], to[LETTER, TWO] = FREE, ONE
    start[LETTER, [ONE, TWO]] = False
    for cls, state in ((APO1, ONE), (APO2, TWO)):
        to[cls] = state
        to[cls, [IN_O, LEAD]] = IN_O
        start[cls, [IN_O, LEAD]] = False
    to[WS_RUN] = IN_W
    start[WS_RUN, IN_W] = False
    to[WS_SPACE], to[WS_LAST], to[RESET] = LEAD, FREE, FREE
    return to, start


_TO, _START = _machine()
_CLASS: list[np.ndarray] = []


def class_table() -> np.ndarray:
    if not _CLASS:
        # the regex package's letters and numbers, as Python's own table is older than the library's
        table = np.full(0x110000, OTHER, np.uint8)
        all_ = "".join(map(chr, range(0x110000)))
        for kind, name in ((LETTER, "L"), (NUMBER, "N")):
            for m in regex.finditer(rf"\p{{{name}}}+", all_):
                table[m.start():m.end()] = kind
        for low, high in LATER:
            table[low:high + 1] = OTHER
        table[WHITE_SPACE] = WS_RUN
        _CLASS.append(table)
    return _CLASS[0]


def classes(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each code point; ``ends`` are the positions after the last point of each text."""
    n = len(points)
    cls = class_table()[points]
    last = np.zeros(n + 1, bool)  # last[i]: i is the last point of its text
    last[ends[ends > 0] - 1] = True
    inked = np.zeros(n, bool)
    inked[:-1] = (cls[1:] != WS_RUN) & ~last[:n - 1]
    white = cls == WS_RUN
    cls[white & inked] = WS_LAST
    cls[white & inked & (points == 0x20)] = WS_SPACE
    at = np.flatnonzero(points == 0x27)
    for p in at.tolist():
        if last[p]:
            continue
        a = points[p + 1]
        if a in (0x73, 0x74, 0x6D, 0x64):  # s t m d
            cls[p] = APO1
        elif not last[p + 1] and (int(a), int(points[p + 2])) in ((0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)):  # re ve ll
            cls[p] = APO2
    return cls


def slice_starts(cls: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Marks of the points that start a slice. Texts are scanned as one; a text's first point always starts one:
    the state before it is put back by composing the class before with a reset."""
    n = len(cls)
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, RESET, np.uint8)
    grid[:n] = cls
    reset = np.zeros(rows * BLOCK, bool)
    reset[ends[(ends > 0)] - 1] = True  # after the last point of a text the state is FREE
    grid, reset = grid.reshape(rows, BLOCK), reset.reshape(rows, BLOCK)
    flat = _TO.ravel()
    # the composed function of each block, over all start states
    f = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for j in range(BLOCK):
        f = flat[(grid[:, j, None].astype(np.int16) << 3) + f]
        f[reset[:, j]] = FREE
    # functions of all blocks up to each one, by doubling
    step = 1
    while step < rows:
        f[step:] = np.take_along_axis(f[step:], f[:-step], 1)
        step *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = f[:-1, FREE]
    marks = np.zeros((rows, BLOCK), bool)
    start = _START.ravel()
    for j in range(BLOCK):
        at = (grid[:, j].astype(np.int16) << 3) + state
        marks[:, j] = start[at]
        state = flat[at]
        state[reset[:, j]] = FREE
    return marks.ravel()[:n]


class ByteBpe:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one slice."""
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > 128:
            return self._merge_long(piece)
        parts = [piece[i:i + 1] for i in range(len(piece))]
        none = 1 << 60
        score = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while score:
            low = min(score)
            if low == none:
                break
            i = score.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del score[i]
            if i < len(score):
                score[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                score[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # end of the part that starts here; 0: no part starts here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (k := before[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def slices(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The bytes of all texts, the byte offsets of their slices (with the end) and, for each text and the
        end, its first slice."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
        data = joined.encode()
        if not len(points):
            return data, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
        starts = np.flatnonzero(slice_starts(classes(points, ends), ends))
        if len(data) == len(points):
            offs = np.append(starts, len(data))
        else:
            width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
            offs = np.append(np.concatenate([[0], np.cumsum(width)])[starts], len(data))
        return data, offs, np.searchsorted(starts, np.concatenate([[0], ends]))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        data, offs, first = self.slices(texts)
        offs = offs.tolist()
        pieces = [data[a:b] for a, b in zip(offs, offs[1:])]
        if len(self.cache) > _CACHE:
            self.old, self.cache = self.cache, {}
        cache, old = self.cache, self.old
        for p in {p for p in pieces if p not in cache}:
            cache[p] = old.get(p) or np.array(self.merge(p), "<u4").tobytes()
        ids = list(map(cache.__getitem__, pieces))
        return [b"".join(ids[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODERS: dict[str, ByteBpe] = {}


def coder(path: str) -> ByteBpe:
    if path not in _CODERS:
        _CODERS[path] = ByteBpe(path)
    return _CODERS[path]


def _runs(texts: list[str | None]):
    """Runs of rows of at most CHUNK characters; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        t = t or ""
        if run and size + len(t) > CHUNK:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t)
    if run:
        yield run


def _encoded(path: str):
    def run(batches):
        bpe = coder(path)
        for b in batches:
            at = 0
            for texts in _runs(b.column(1).to_pylist()):
                ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode(texts)]
                size = [np.array([len(bpe.bytes_of[i]) for i in x.tolist()], np.int32) for x in ids]
                offs = [np.cumsum(s, dtype=np.int32) - s for s in size]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(ids, pa.list_(pa.int32())), pa.array(offs, pa.list_(pa.int32()))],
                                                 [b.schema.names[0], "ids", "offsets"])
                at += len(texts)
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, offsets): the token ids of each text and the byte at which each token starts."""
    small_batches(docs.sparkSession)
    src = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    fields = T.StructType([src.schema[0]]).add("ids", T.ArrayType(T.IntegerType())).add("offsets", T.ArrayType(T.IntegerType()))
    return src.mapInArrow(lean(_encoded(path)), fields)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``tokens`` with the text of its ids; bytes that are no UTF-8 become the replacement character."""
    tokens = tokens.drop(text_col)

    def run(batches):
        bpe = coder(path)
        for b in batches:
            texts = [None if x is None else bpe.decode(np.array(x, "<u4").tobytes()).decode("utf-8", "replace") for x in b.column(b.schema.get_field_index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, text_col])
    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(text_col, T.StringType())]))


def _digests(path: str):
    def run(batches):
        bpe = coder(path)
        for b in batches:
            at = 0
            for texts in _runs(b.column(1).to_pylist()):
                ids = bpe.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                     pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids])], [b.schema.names[0], "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(texts)
    return run


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256) of each row, encoded and decoded in one pass."""
    small_batches(docs.sparkSession)
    src = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    fields = T.StructType([src.schema[0]]).add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return src.mapInArrow(lean(_digests(path)), fields)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` in the multilingual 50k byte-level vocabulary, and back."""
    import public_tokenizers

    return round_trip_digests(source(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
