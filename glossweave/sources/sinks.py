"""Sinks: JSON lines, chat rows, one JSON array for each batch, appended TSV, accepted rows beside failures, statistics.

All of them are Spark writers, so tasks that run again replace their own output only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_chat(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines that hold nothing but `messages`, an array of (role, content)."""
    rows.select("messages").write.mode(mode).json(path)


def batch_arrays(rows: DataFrame, batch: str, order: str) -> DataFrame:
    """Rows (batch, value): each batch as one compact JSON array in the given order; columns that begin with _ go.

    A batch must be bounded (see operators.sampling.batches). Rows without a batch are left out.
    """
    public = [c for c in rows.columns if c != batch and not c.startswith("_")]
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.struct(*public).alias("r"))))
    grouped = rows.where(F.col(batch).isNotNull()).groupBy(batch).agg(listed.alias("l"))
    return grouped.select(batch, F.to_json(F.transform("l", lambda x: x["r"])).alias("value"))


def write_batches(rows: DataFrame, path: str, batch: str, order: str, mode: str = "errorifexists") -> None:
    """One folder for each batch, with the array in it."""
    batch_arrays(rows, batch, order).write.mode(mode).partitionBy(batch).text(path)


def append_tsv(rows: DataFrame, path: str) -> None:
    """Appends to a folder of tab-separated files with a head line each; writers don't disturb one another."""
    rows.write.mode("append").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def outcomes(rows: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, failures as source_id, language, error); error is null for what is accepted."""
    marked = rows.withColumn("error", error)
    return marked.where("error IS NULL").drop("error"), marked.where("error IS NOT NULL").select("source_id", "language", "error")


def write_stats(stats: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small aggregate as one file of JSON lines."""
    stats.coalesce(1).write.mode(mode).json(path)
