"""Best-fit packing with bound-certified repacking.

Every text is encoded once; texts longer than a sequence are cut, and full
pieces are sequences of their own. The other pieces are dealt into groups of
about ``GROUP`` pieces, and each group is packed by best-fit decreasing in one
task. Dual-feasible functions over a group's lengths give a lower bound of its
sequence count: a group that meets its bound is certified and final. Groups
with a gap release the pieces of their sequences that are not nearly full;
these are dealt anew into (fewer) mixed groups and packed again, as long as the
total shrinks and a group has a gap. The first packing is kept where a repacking is no better.

Each row of ``docs`` is packed, repeated rows included; a null text is empty and
has only the end id. Group numbers are dealt by place in the input, not by key,
so equal ids or texts spread over all groups. An empty table gives an empty
result. Columns other than the id and the text are not read; an id column named
like a column of the result is an error.
"""

from __future__ import annotations

import itertools
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Shared, source
from .text import lean, mix

GROUP = 16_384
_CACHE = 250_000
#: Parts of more characters are encoded each time, so the cache is bounded in bytes too.
_LONG = 500


#: Lower-case letters of one code point that no normalisation changes: such a part is one token of the pattern.
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch


def _byte_letters() -> list[str]:
    """The letter that the byte-level vocabulary writes for each byte: printable bytes are themselves, the
    others the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordCache:
    """Packed ids (little-endian unsigned 32-bit) by white-space-free part of a text; the tokenizer never
    joins across white space, so a text's ids are those of its parts. Two generations of at most
    ``_CACHE`` parts bound the memory; parts still in use move to the newer one."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, p: str) -> bytes:
        """The ids of one part: one token of the pattern by the merges alone, others by the whole tokenizer."""
        if _PLAIN(p):
            s = p if p.isascii() else "".join(map(self.letters.__getitem__, p.encode()))
            return array("I", [t.id for t in self.model.tokenize(s)]).tobytes()
        return array("I", self.tokenizer.encode(p, add_special_tokens=False).ids).tobytes()

    def _find(self, p: str) -> bytes:
        ids = self.old.get(p)
        if ids is None:
            ids = self._ids(p)
        self.new[p] = ids
        return ids

    def learn(self, p: str) -> bytes:
        """Ids of a new part. A letter (that lower case leaves one) ends a token of the pattern before a full stop or
        comma, and such a mark at the end is a token of its own, so these parts are joined from the two. Very long
        parts are not kept."""
        new = self.new
        if (ids := new.get(p)) is not None:
            return ids
        if len(p) > _LONG:
            return self._ids(p)
        if (p[-1:] == "." or p[-1:] == ",") and p[-2:-1].isalpha() and p[:-1].lower()[-1].isalpha():
            word, mark = p[:-1], p[-1]
            ids = new[p] = (new.get(word) or self._find(word)) + (new.get(mark) or self._find(mark))
            return ids
        return self._find(p)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.new) > _CACHE:
            self.old, self.new = self.new, {}
        get, learn, out = self.new.get, self.learn, []
        for t in texts:
            t = t or ""
            # the vocabulary is of lower case; only a capital sigma is lowered by its place, and special tokens
            # are those of the text as it is
            t = t if "\u03a3" in t or "<|" in t else t.lower()
            parts = t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            found = list(map(get, parts))
            if None in found:
                found = [learn(p) if ids is None else ids for p, ids in zip(parts, found)]
            out.append(b"".join(found))
        return out


_WORDS: dict[str, WordCache] = {}


def _pieces(path: str, size: int, end_id: int):
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = _WORDS.setdefault(path, WordCache(path)) if path not in _WORDS else _WORDS[path]
        context = TaskContext.get()
        part, n = context.partitionId() if context else 0, 0
        for b in batches:
            for i in range(0, b.num_rows, 256):
                rows, out = b.slice(i, 256), []
                for r, ids in enumerate(words.encode(rows.column(1).to_pylist())):
                    ids += tail
                    for k, at in enumerate(range(0, len(ids), 4 * size)):
                        cut = ids[at:at + 4 * size]
                        out.append((r, k, at // 4, len(cut) // 4, zlib.crc32(cut)))
                row, k, at, length, crc = (np.array(x, np.int64) for x in zip(*out))
                deal = mix((np.arange(n, n + len(row)) + (part << 40)).astype(np.uint64)) >> np.uint64(2)
                n += len(row)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(row)), *(pa.array(x) for x in (k.astype(np.int32), at, length, crc, deal.astype(np.int64)))],
                    [b.schema.names[0], "piece", "start", "length", "ids_crc32", "deal"])
        words.old = {}  # the worker lives on
    return lean(run)


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each item: longest first, each into the fullest bin that still takes it."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: dict[int, list[int]] = {}  # bins by room left
    rooms = 0  # bit r: some bin has room r
    made = 0
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            stack = free[room]
            b = stack.pop()
            if not stack:
                rooms &= ~(1 << room)
        else:
            room, b, made = size, made, made + 1
        bins[i], offsets[i] = b, size - room
        left = room - n
        if left:
            stack = free.setdefault(left, [])
            stack.append(b)
            rooms |= 1 << left
    return bins, offsets


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """The largest bound of two families of dual-feasible functions: the cut-off functions of the small and
    large items, and the rounding functions x -> floor((k + 1) x) / k."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1).astype(np.int64)
    weight = count * np.arange(size + 1)
    c, w = np.cumsum(count), np.cumsum(weight)
    eps = np.arange(1, size // 2 + 1)
    large = c[size] - c[size - eps]  # longer than size - eps: one each
    middle = w[size - eps] - w[eps - 1]
    best = int((large + -(-middle // size)).max())
    best = max(best, -(-int(w[size]) // size))
    x = np.arange(size + 1)
    for k in range(1, 51):
        scaled = (k + 1) * x
        value = np.where(scaled % size == 0, x * k, (scaled // size) * size)  # times k * size
        best = max(best, -(-int((value * count).sum()) // (k * size)))
    return best


def _pack(size: int, fields: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("deal", kind="stable")
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(lengths, size)
        made = int(bins.max()) + 1 if len(bins) else 0
        gap = made - lower_bound(lengths, size)
        fill = np.bincount(bins, lengths, made).astype(np.int64)
        return pdf.assign(bin=bins, offset=offsets, fill=fill[bins], gap=gap)[fields]
    return run


def pack(docs: DataFrame, tokenizer_path: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
         group: int = GROUP) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every row of ``docs``."""
    shared = Shared(docs.sparkSession, "packing")
    src = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    fields = T.StructType([src.schema[0]]).add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long").add("deal", "long")
    pieces = shared.put(src.mapInArrow(_pieces(tokenizer_path, size, end_id), fields), "pieces")
    full = pieces.where(F.col("length") >= size).withColumn("sequence_id", F.col("deal").bitwiseOR(F.lit(1 << 62))).withColumn("offset", F.lit(0).cast("long"))
    out_cols = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    packed_fields = T.StructType([*fields.fields]).add("bin", "long").add("offset", "long").add("fill", "long").add("gap", "long").add("grp", "long")
    done = [full.select(out_cols)]
    todo, before = pieces.where(F.col("length") < size), None
    numbered = lambda df, r: df.withColumn("sequence_id", F.lit(r << 50).bitwiseOR(F.shiftleft("grp", 24)).bitwiseOR(F.col("bin"))).select(out_cols)
    for r in itertools.count():
        n = todo.count()
        if not n:
            break
        groups = -(-n // group)
        dealt = todo.withColumn("deal", F.xxhash64("deal")).withColumn("grp", F.pmod("deal", F.lit(groups)))
        new = shared.put(dealt.groupBy("grp").applyInPandas(_pack(size, packed_fields.names), packed_fields), f"round{r}")
        # a sequence is counted at the piece that starts it
        made, open_bins, open_gaps = new.where("offset = 0").agg(
            F.count("*"), F.count_if((F.col("gap") > 0) & (F.col("fill") < size - size // 256)), F.sum(F.when(F.col("gap") > 0, 1).otherwise(0))).first()
        if before is not None and made >= before[1]:
            break  # no better than the sequences that the pieces came from
        if before is not None:
            done[-1] = before[2]
        loose = (F.col("gap") > 0) & (F.col("fill") < size - size // 256)
        before = (new, open_bins, numbered(new.where(~loose), r))
        done.append(numbered(new, r))
        todo = new.where(loose).drop("bin", "offset", "fill", "gap", "grp")
        if not open_gaps or groups == 1:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` in sequences of at most 4096 ids of the 49k word vocabulary, each text ended by id 1."""
    import public_tokenizers

    return pack(source(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
