"""Helpers shared by the training-data operators: keys, checkpoints, Arrow stages, word scanning."""

from __future__ import annotations

import itertools
import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words end at these bytes: space, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = b" \t\n\x0b\x0c\r"
NULL_KEY = -(2**63)
_SEP = np.zeros(256, bool)
_SEP[list(SEPARATORS)] = True
_RNG = np.random.Generator(np.random.PCG64(20240607))
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
MULT = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_key() -> Column:
    """Null ids get the smallest long, so that they join and sort before all others."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_KEY))


def cut(df: DataFrame) -> DataFrame:
    """Ends the lineage in the shared checkpoint folder that spark.checkpoint.dir names.

    Only a local master, whose executors share the driver's disk, may go without that setting.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", "")
        if not shared and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="glossweave-"))
    return df.checkpoint()


def spare(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows with a number of their own, in table order, that stays the same however often they are read.

    Rows of a file or a checkpoint are read in one order, so these are numbered as they are; what comes of
    a shuffle, or of anything else that may run differently again, is first cut off in the checkpoint folder.
    """
    plan, fixed = [df._jdf.queryExecution().optimizedPlan()], True
    while plan:
        node = plan.pop()
        fixed &= node.nodeName() in ("Project", "Filter", "LocalRelation", "LogicalRDD") or node.nodeName().startswith(("Relation", "LogicalRelation"))
        fixed &= node.nodeName() == "LocalRelation" or node.deterministic()
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
    return (df if fixed else cut(df)).withColumn(name, F.monotonically_increasing_id())


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def attach(df: DataFrame, fn: Callable, outputs: dict[str, str], inputs: tuple[str, ...] = ()) -> DataFrame:
    """Adds columns that fn computes for an Arrow batch.

    fn(row, *inputs) gets the row's columns as a struct array and the named extra columns, and
    returns one array for each output. Columns of df with an output's name (in any case) are replaced.
    """
    lowered = {c.lower() for c in (*outputs, *inputs)}
    kept = [c for c in df.columns if c.lower() not in lowered]
    inner = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), *inputs)
    names = list(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = fn(batch.column(0), *[batch.column(1 + i) for i in range(len(inputs))])
            yield pa.RecordBatch.from_arrays([batch.column(0), *got], ["_row", *names])

    schema = f"_row {_quoted(inner)}, " + ", ".join(f"{k} {v}" for k, v in outputs.items())
    return inner.mapInArrow(run, schema).select("_row.*", *names)


def _quoted(inner: DataFrame) -> str:
    fields = inner.schema["_row"].dataType.fields
    return "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in fields) + ">"


def field(rows: pa.StructArray, name: str) -> pa.Array:
    """A column of the row, with the struct's own nulls (there are none) ignored."""
    for i in range(rows.type.num_fields):
        if rows.type.field(i).name.lower() == name:
            return rows.field(i)
    raise KeyError(name)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift, multiply), to spread hashes."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Words of a block of documents, as arrays: the packed text holds each word and one space.

    packed: bytes; start, end: byte places there; hash: 64 bits of each word;
    first: the index of each document's first word, and the total at the end.
    """

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        inside = ~_SEP[data]
        at = np.flatnonzero(inside)
        if not len(at):
            self.packed, self.first = b"", np.zeros(len(texts) + 1, np.int64)
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        lengths = np.diff(begins, append=len(at))
        self.first = np.searchsorted(at[begins], np.concatenate([[0], np.cumsum(sizes)]))
        letters = data[at]
        word = np.repeat(np.arange(len(begins)), lengths)
        out = np.full(len(at) + len(begins), 32, np.uint8)
        out[np.arange(len(at)) + word] = letters
        self.packed = out.tobytes()
        self.start = begins + np.arange(len(begins))
        self.end = self.start + lengths
        power = np.cumprod(np.full(int(lengths.max()), MULT, np.uint64))
        place = np.arange(len(at)) - np.repeat(begins, lengths)
        self.hash = mix(np.add.reduceat(BYTE[letters] * power[place], begins))


_NOT_SEP = re.compile(rb"[^ \t\n\x0b\x0c\r]+")
_IS_SEP = re.compile(rb"[ \t\n\x0b\x0c\r]")


def word_parts(text: bytes, size: int, overlap: int) -> Iterator[tuple[int, bytes]]:
    """(words before, part) of a text: parts of about `size` bytes, each with the `overlap` words after it.

    So a long text never lies in arrays as a whole; the parts' windows are those of the text.
    """
    at = before = 0
    while len(text) - at > size and (m := _IS_SEP.search(text, at + size)):
        after = list(itertools.islice(_NOT_SEP.finditer(text, m.end()), overlap))
        yield before, text[at : after[-1].end() if after else m.end()]
        before += len(text[at : m.end()].split())
        at = m.end()
    yield before, text[at:]


def byte_parts(text: bytes, size: int, overlap: int) -> Iterator[tuple[int, bytes]]:
    """(bytes before, part), as word_parts."""
    for at in range(0, max(1, len(text) - overlap), size):
        yield at, text[at : at + size + overlap]


def blocks(batches, size: int, parts: Callable | None = None):
    """Documents of Arrow batches (key columns, then binary text last) in blocks of about `size` bytes of text.

    Yields (list of rows: the keys, then what lies before the part; list of texts); nulls are empty. Texts
    longer than `size` come in parts, where parts(text, size) gives (before, part); else whole.
    """
    rows, texts, held = [], [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            text = row[-1] or b""
            for before, part in parts(text, size) if parts and len(text) > size else ((0, text),):
                rows.append((*row[:-1], before))
                texts.append(part)
                held += len(part) + 1
                if held >= size:
                    yield rows, texts
                    rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each `width` consecutive ones (doubling, so log(width) passes)."""
    if len(keys) < width:
        return keys[:0]
    done = 1
    while done * 2 <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    return keys if done == width else np.minimum(keys[: len(keys) - (width - done)], keys[width - done :])
