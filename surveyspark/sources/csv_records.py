"""CSV with quoted line breaks, read in splits.

The text reader cuts a file at every line break, also at those inside quotes.
Whether a line starts inside a quoted field depends on all lines before it, so
each line is a function of that state, and these functions compose: one pass
folds the lines of a split, a small table of splits, per file, gives the state
at the start of each, and the second pass cuts the records. Records that cross
splits are put together from their pieces; all others never leave their task.

A quote opens a field only at the field's start, as usual; elsewhere it is a
character. A doubled quote inside quotes is one quote. Empty fields and the
usual words for a missing value (``NA_TEXTS``) are null, blank lines are
skipped, fields missing at the end of a record are null and those too many are
left out. Files of one call must have the same header. A quote that is never
closed is an error, as it would take the rest of the file into one field.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts that stand for a missing value in a CSV field.
NA_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
            "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_SPLITS = "file string, block long, open0 boolean, open1 boolean, starts0 boolean, starts1 boolean"
_PARTS = "file string, block long, pos long, fields array<string>, owner long, piece string"


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a quoted field is open after ``line``, given whether one was open before it."""
    at = 0
    while True:
        if not inside:
            while not line.startswith('"', at):
                at = line.find(sep, at) + 1
                if not at:
                    return False
            at += 1
        end = line.find('"', at)
        while end >= 0 and line.startswith('"', end + 1):
            end = line.find('"', end + 2)
        if end < 0:
            return True
        at, inside = line.find(sep, end + 1) + 1, False
        if not at:
            return False


def split_fields(record: str, sep: str, na: frozenset) -> list[str | None]:
    """The fields of one record."""
    if '"' not in record:
        return [None if x in na else x for x in record.split(sep)]
    out, at = [], 0
    while True:
        head = ""
        if record.startswith('"', at):
            end = record.find('"', at + 1)
            while end >= 0 and record.startswith('"', end + 1):
                end = record.find('"', end + 2)
            head, at = record[at + 1:end].replace('""', '"'), end + 1
        stop = record.find(sep, at)
        value = head + (record[at:] if stop < 0 else record[at:stop])
        out.append(None if value in na else value)
        if stop < 0:
            return out
        at = stop + len(sep)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[str], bool]]:
    """(split, lines, whether the split goes on) in file order; a split is in one task, its lines in order."""
    split, held = None, None
    for b in batches:
        files, blocks, lines = (b.column(i) for i in range(3))
        if not b.num_rows:
            continue
        codes, starts, texts = files.dictionary_encode().indices.to_numpy(), blocks.to_numpy(), lines.to_pylist()
        at = 0
        for i in [*(np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1).tolist(), len(codes)]:
            key = (files[at].as_py(), blocks[at].as_py())
            if held is not None:
                yield split, held, key == split
            split, held, at = key, texts[at:i], i
    if held is not None:
        yield split, held, False


def _fold(sep: str):
    """Per split: whether a field is open at its end, and whether a record starts in it, for both states before it."""
    def run(batches):
        state, starts = [False, True], [False, False]
        for (file, block), lines, more in _runs(batches):
            for line in lines:
                starts = [starts[0] or not state[0], starts[1] or not state[1]]
                if '"' in line:
                    state = [ends_inside(line, s, sep) for s in state]
            if not more:
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (file, block, *state, *starts)], [c.split()[0] for c in _SPLITS.split(", ")])
                state, starts = [False, True], [False, False]
    return run


def _starts(splits: pd.DataFrame) -> pd.DataFrame:
    """The splits of a file that begin inside a record: ``owner`` is the split that the record began in;
    block -1 stands for the end of the file."""
    inside, owner, out = False, 0, []
    for s in splits.sort_values("block").itertuples():
        if inside:
            out.append((s.file, s.block, owner))
        if s.starts1 if inside else s.starts0:
            owner = s.block
        inside = s.open1 if inside else s.open0
    if inside:
        out.append((splits["file"].iloc[0], -1, owner))
    return pd.DataFrame(out, columns=["file", "block", "owner"])


def _records(sep: str, na: frozenset, owners: dict):
    """Records that lie in one split, parsed, and the pieces of those that do not."""
    def run(batches):
        begun, head, inside, pos, first = None, False, False, 0, True
        for (file, block), lines, more in _runs(batches):
            rows = []
            if first:
                inside, pos = (file, block) in owners, 0
                begun, head = ([], True) if inside else (None, False)
            for line in lines:
                if begun is None:
                    begun, head = [], False
                begun.append(line)
                if '"' in line:
                    inside = ends_inside(line, inside, sep)
                if not inside:
                    text = "\n".join(begun)
                    if head:
                        rows.append((file, block, -1, None, owners[file, block], text))
                    elif text.strip("\r"):
                        rows.append((file, block, pos, split_fields(text.removesuffix("\r"), sep, na), None, None))
                        pos += 1
                    begun = None
            first = not more
            if not more and begun:
                rows.append((file, block, -1 if head else pos, None, owners[file, block] if head else block, "\n".join(begun)))
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "pos", "fields", "owner", "piece"), r)) for r in rows],
                                             schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("pos", pa.int64()), ("fields", pa.list_(pa.string())),
                                                               ("owner", pa.int64()), ("piece", pa.string())]))
    return run


def csv_records(spark: SparkSession, path, sep: str = ",", na=NA_TEXTS, **options) -> DataFrame:
    """``(file, block, pos, fields)`` of every record, headers included; the first three give the file order.

    The first pass runs when the reader is called; what comes to the driver are the splits that begin inside a
    record."""
    lines = spark.read.options(lineSep="\n", **options).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    splits = lines.mapInArrow(_fold(sep), _SPLITS)
    inside = splits.groupBy("file").applyInPandas(_starts, "file string, block long, owner long").collect()
    for s in inside:
        if s.block < 0:
            raise ValueError(f"{s.file}: a quoted field is never closed.")
    owners = {(s.file, s.block): s.owner for s in inside}
    na = frozenset(na)
    parts = lines.mapInArrow(_records(sep, na, owners), _PARTS)
    whole = parts.where("piece is null").select("file", "block", "pos", "fields")
    if not owners:
        return whole

    def joined(batches):
        for b in batches:
            texts = [split_fields("\n".join(p["piece"] for p in sorted(ps, key=lambda p: p["block"])).removesuffix("\r"), sep, na) for ps in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(texts, pa.list_(pa.string()))], ["file", "block", "pos", "fields"])

    pieces = parts.where("piece is not null").groupBy("file", F.col("owner").alias("block")).agg(
        F.max("pos").alias("pos"), F.collect_list(F.struct("block", "piece")).alias("pieces"))
    return whole.unionByName(pieces.mapInArrow(joined, "file string, block long, pos long, fields array<string>"))


def read_csv(spark: SparkSession, path, sep: str = ",", na=NA_TEXTS, order: bool = False, **options) -> DataFrame:
    """A CSV file, or the ``.csv`` files of a folder, by their header, all columns as text; with ``order`` the
    rows' place as ``row_ord`` (file, block, pos). No file or an empty one has no columns."""
    records = csv_records(spark, path, sep, na, **options)
    is_head = (F.col("block") == 0) & (F.col("pos") == 0)
    heads = records.where(is_head).select("fields").distinct().limit(2).collect()
    if len(heads) > 1:
        raise ValueError(f"{path}: files with different headers.")
    names = [n or f"_c{i}" for i, n in enumerate(heads[0]["fields"])] if heads else []
    if names:
        names[0] = names[0].removeprefix("﻿")
    body = records.where(~is_head)
    cols = [F.get("fields", F.lit(i)).alias(n) for i, n in enumerate(names)]
    return body.select(*cols, *([F.struct("file", "block", "pos").alias("row_ord")] if order else []))
