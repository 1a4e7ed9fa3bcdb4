"""Best-fit packing of tokenised documents into sequences, by large-item matching.

Pieces longer than a third of a sequence share one with at most one more of their kind: the longest
takes the longest partner that fits. Shorter ones then go, longest first, to the least gap that
holds them. Only lengths matter, so the plan is made from the counts of lengths (as many as a
sequence has tokens); pieces are then dealt to the plan by their number among those of equal length.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .token_counts import Splitter, encodes_as_the_library, piece_encoder, vocabulary_path

CAPACITY = 2048
#: Pieces of one length are numbered in shares, so many for each shuffle partition, which are numbered apart.
SHARES = 16


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first, n, sequence, each, offset) that place n pieces of a length from number `first` on.

    They fill consecutive sequences from `sequence` on, `each` of them in one, from `offset` on.
    """
    rows, used = [], dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, n)
    order: list[int] = []  # gaps that have runs
    total = 0

    def put(gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, n))

    def place(length: int, n: int, first: int, each: int, offset: int) -> None:
        rows.append((length, used[length], n, first, each, offset))
        used[length] += n

    left = dict(counts)
    large = sorted((n for n in counts if 3 * n > capacity), reverse=True)
    ascending = large[::-1]
    for length in large:
        while left[length]:
            # the longest partner that fits and is left; the piece itself isn't its own partner
            at = bisect_left(ascending, capacity - length + 1) - 1
            while at >= 0 and (ascending[at] > length or left[ascending[at]] - (ascending[at] == length) <= 0):
                at -= 1
            partner = ascending[at] if at >= 0 else None
            if partner is None:
                n = left[length]
                place(length, n, total, 1, 0)
                put(capacity - length, total, n)
                left[length] = 0
            elif partner == length:
                n = left[length] // 2
                place(length, 2 * n, total, 2, 0)
                put(capacity - 2 * length, total, n)
                left[length] -= 2 * n
            else:
                n = min(left[length], left[partner])
                place(length, n, total, 1, 0)
                place(partner, n, total, 1, length)
                put(capacity - length - partner, total, n)
                left[length] -= n
                left[partner] -= n
            total += n
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        todo = counts[length]
        while todo:
            at = bisect_left(order, length)
            if at == len(order):
                new = -(-todo // (capacity // length))
                put(capacity, total, new)
                total += new
                continue
            gap = order[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            each = gap // length
            full = min(n, todo // each)
            if full:
                place(length, full * each, first, each, capacity - gap)
                put(gap - each * length, first, full)
                todo -= full * each
            elif todo:
                place(length, todo, first, todo, capacity - gap)
                put(gap - todo * length, first, 1)
                full, todo = 1, 0
            put(gap, first + full, n - full)
    return rows


def tokenized(docs: DataFrame, path: str, end: int, capacity: int) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids): whole documents, or parts of which only the first may be short."""
    held = {}

    def run(batches):
        if "split" not in held:
            held["split"], held["encode"] = Splitter(path), piece_encoder(path)
        split, encode = held["split"], held["encode"]
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = array("I")
                for part in split.parts(text or ""):
                    if part in split.added:
                        ids.append(split.added[part])
                    elif encodes_as_the_library(part):
                        ids.extend(encode(part))
                    else:
                        ids.extend(split.tokenizer.encode(part, add_special_tokens=False).ids)
                ids.append(end)
                raw, n = ids.tobytes(), len(ids)
                head = n % capacity or min(n, capacity)
                starts = [0, *range(head, n, capacity)]
                for i, (a, b) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                    for column, x in zip(out, (doc, i, a, b - a, raw[4 * a : 4 * b]), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def pack(docs: DataFrame, path: str, end: int = 0, capacity: int = CAPACITY, keep_ids: bool = True) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset): every token of every document.

    A document is its ids and then `end`. Longer ones than `capacity` are cut; their first piece may
    be short; of very long texts, too, every token is packed. Null and empty texts are the one id `end`. Null
    ids and repeated rows are documents of their own; which of equal rows gets which place is not said.
    Other columns are not carried. ids is little-endian 32-bit; keep_ids=False leaves it out.
    """
    pieces = tokenized(docs, path, end, capacity).withColumn("ids_crc32", F.crc32("ids"))
    # tokenised once; a row's number in its checkpoint deals equal pieces, too, to many shares
    pieces = common.cut(pieces if keep_ids else pieces.drop("ids"))
    shares = SHARES * common.partitions(docs)
    pieces = pieces.withColumn("_n", F.monotonically_increasing_id())
    pieces = pieces.withColumn("share", F.pmod(F.xxhash64("_n"), F.lit(shares)).cast("int"))
    counted = common.cut(pieces.groupBy("length", "share").agg(F.count("*").alias("n")))
    before = counted.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("share")) - F.col("n")).drop("n")
    totals = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    rows = sorted(plan(totals, capacity))
    lookup = np.array(rows, np.int64).reshape(-1, 6)
    own = F.row_number().over(Window.partitionBy("length", "share").orderBy("_n")) - 1
    placed = pieces.withColumn("number", own).join(before, ["length", "share"])
    placed = placed.select(*[c for c in pieces.columns if c not in ("share", "_n")], (F.col("before") + F.col("number")).alias("number"))

    key = lookup[:, 0] * (1 << 48) + lookup[:, 1]  # plan rows are sorted by length, then first number

    def run(batches):
        for batch in batches:
            length, number = (batch.column(i).to_numpy() for i in (batch.schema.get_field_index("length"), batch.schema.get_field_index("number")))
            row = lookup[np.searchsorted(key, length * (1 << 48) + number, "right") - 1]
            at = number - row[:, 1]
            names = [n for n in batch.schema.names if n != "number"]
            got = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*got, pa.array(row[:, 3] + at // row[:, 4]), pa.array(row[:, 5] + at % row[:, 4] * length)], [*names, "sequence_id", "offset"])

    kinds = {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids": "binary", "ids_crc32": "bigint"}
    schema = ", ".join(f"{c} {kinds[c]}" for c in placed.columns if c != "number") + ", sequence_id bigint, offset bigint"
    return placed.mapInArrow(run, schema)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pack(docs, vocabulary_path("byte_bpe_50k.json"), keep_ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
