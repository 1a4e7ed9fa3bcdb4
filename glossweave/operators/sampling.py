"""Samples with quotas over overlapping strata, and batches of bounded size. What one task handles is bounded by
the sample's size and the number of strata, or by the number of distinct sizes; never by the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossweave.functions import text as T

#: Ids of one stretch, which are numbered together.
SPAN = 4096


def quota_sample(rows: DataFrame, keys: Column, id: str, n: int, each: int | None = None, by_size: bool = False, fill: bool = False, seed: int = 42) -> DataFrame:
    """The ids of at most n rows, and the stratum each was taken for (null: fill).

    keys is a row's array of strata. Strata are visited in order of name (by_size: fewest rows first); each
    takes the first `each` of its rows, in hash order, that aren't taken yet (None: n by the number of
    strata, 1 at least). fill adds further rows in hash order up to n. Ids must not be null and are
    distinct; a row without strata can only be filled in.
    """
    order = T.hash_order(seed, F.col(id).cast("string"))
    listed = rows.select(id, order.alias("o"), F.explode(F.array_distinct(keys)).alias("key"))
    # no stratum can need more than its first n rows; the limit is applied before the shuffle
    first = listed.withColumn("r", F.row_number().over(Window.partitionBy("key").orderBy("o", id))).where(F.col("r") <= n)
    first = first.join(listed.groupBy("key").agg(F.count("*").alias("size")), "key").select(id, "o", "key", "size")
    if fill:
        first = first.unionByName(rows.select(id, order.alias("o"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("long").alias("size")).orderBy("o", id).limit(n))

    def take(got: pd.DataFrame) -> pd.DataFrame:
        strata = got[got["key"].notna()]
        sizes = strata.groupby("key")["size"].first()
        share = max(1, n // max(1, len(sizes))) if each is None else each
        taken: dict = {}
        visit = sorted(sizes.index, key=lambda k: (sizes[k] if by_size else 0, k))
        groups = {k: g.sort_values(["o", id])[id].tolist() for k, g in strata.groupby("key")}
        for key in visit:
            new = [i for i in groups[key] if i not in taken][: min(share, n - len(taken))]
            taken.update(dict.fromkeys(new, key))
        rest = got[got["key"].isna()].sort_values(["o", id])[id].tolist()
        for i in rest:
            if len(taken) < n:
                taken.setdefault(i, None)
        return pd.DataFrame({id: list(taken), "stratum": list(taken.values())})

    return first.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(take, f"{id} {dict(rows.dtypes)[id]}, stratum string")


def batch_runs(counts: list[tuple[int, int]], most: int) -> list[tuple[int, int, int, int]]:
    """Runs (size, first, each, batch): of a size's rows, those from number `first` on fill batches from `batch`
    on, `each` to one. Rows come in order of size; a batch ends before it would exceed `most`."""
    runs, batch, held, used = [], 0, 0, 0
    for size, n in sorted(counts):
        fits = min(n, max(0, most - used) // size if size else n) if held else 0
        if fits:  # the open batch takes what fits
            runs.append((size, 0, n, batch))
            held, used = held + fits, used + fits * size
        if fits < n:
            each = max(1, most // size) if size else n
            batch += held > 0
            runs.append((size, fits, each, batch))
            full, rest = divmod(n - fits, each)
            batch += full if rest else full - 1
            held = rest or each
            used = held * size
    return runs


def batches(rows: DataFrame, id: str, size: str, most: int, above: int | None = None) -> DataFrame:
    """Adds `lot` (normal, solo, skipped) and `batch`: rows by size, then id, packed greedily up to `most`.

    Rows larger than `above` (most, if None) stand alone, or are skipped beyond 3 * most; their batch is null.
    Null sizes are skipped. The plan needs only the counts of sizes up to `above`, which bounds it. Ids are whole
    numbers; rows of one size are numbered by stretches of SPAN ids, so that a frequent size isn't one task's.
    """
    above = most if above is None else above
    lot = F.when(F.col(size) <= above, "normal").when(F.col(size) <= 3 * most, "solo").otherwise("skipped")
    marked = rows.withColumn("lot", lot)
    sizes = marked.where("lot = 'normal'").groupBy(size).agg(F.count("*").alias("n")).collect()  # at most `above` + 1 rows
    runs = np.array(batch_runs([(r[0], r[1]) for r in sizes], most), np.int64).reshape(-1, 4)
    names = marked.columns
    stretched = marked.withColumn("_s", F.floor(F.col(id) / SPAN))
    counted = stretched.where("lot = 'normal'").groupBy("lot", size, "_s").agg(F.count("*").alias("_n"))
    before = counted.withColumn("_before", F.sum("_n").over(Window.partitionBy(size).orderBy("_s")) - F.col("_n")).drop("_n")
    own = F.row_number().over(Window.partitionBy("lot", size, "_s").orderBy(id)) - 1
    numbered = stretched.withColumn("_own", own).join(before, ["lot", size, "_s"], "left").select(*names, (F.col("_before") + F.col("_own")).alias("_n"))

    def place(parts):
        for part in parts:
            asked, at = part.column(names.index(size)), part.column(len(names))
            normal = at.is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros(len(at), np.int64)
            if normal.any():
                s, k = (np.asarray(c.filter(pa.array(normal))).astype(np.int64) for c in (asked, at))
                run = runs[np.searchsorted(runs[:, 0] * (1 << 40) + runs[:, 1], s * (1 << 40) + k, "right") - 1]
                out[normal] = run[:, 3] + (k - run[:, 1]) // run[:, 2]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out, mask=~normal)], [*names, "batch"])

    return numbered.mapInArrow(place, ", ".join(f"`{c}` {t}" for c, t in marked.dtypes) + ", batch bigint")
