"""The exchange of super-k-mers: packed strings of consecutive windows travel to their minimiser's bucket.

Documents are told apart by their row's number, which travels with the strings.

Shared by both exact substring operators. A map task holds back repeats of a packed string, so a
passage that a third of all documents share reaches its bucket once for each block of a task; the
places of the held-back repeats travel apart, spread over all buckets.

A piece that stands in ever new surroundings would be the minimiser of one huge group. Such pieces are
counted first, over all documents, and come last in the order of minimisers; windows that have no other
piece travel by themselves, to a bucket that the whole window gives. That moves strings to other buckets and
changes no result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of packed strings that a map task gathers before it sends them on.
FLUSH = 96 << 20
#: Bytes of text scanned at once.
BLOCK = 1 << 20
#: Pieces of text whose surroundings are counted at once.
COUNTED = 1 << 21
#: Of a task's last, smaller number of pieces, only counts above this are sent on.
LAST = 16
#: A group of fewer strings is never split.
FEW = 4096
#: Hashes lie above this many bits; those of frequent pieces are all ones.
LOW_BITS = np.uint64(28)
LOW = np.uint64((1 << 28) - 1)
#: Columns of the places in a message: document id, document number, first unit, units, minimiser, more.
WIDTH = 6


class Outbox:
    """What one map task sends: for each bucket the places and strings of super-k-mers.

    bits: how much of a minimiser travels; the bucket already tells the rest apart, or the string does.
    """

    def __init__(self, buckets: int, bits: int):
        self.buckets, self.bits, self.press = buckets, bits, zstandard.ZstdCompressor(level=6)
        self.clear()

    def clear(self) -> None:
        self.seen: dict[bytes, int] = {}
        self.places: list[tuple] = []
        self.strings: list[bytes] = []
        self.held = 0

    def messages(self) -> Iterator[pa.RecordBatch]:
        """One blob for each bucket that has something."""
        if not self.places:
            return
        places = np.array(self.places, np.int64)
        spread = np.where(places[:, 4] == -1, places[:, 0] + places[:, 2], places[:, 4])
        bucket = (common.mix(spread.astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)
        places[:, 4] = np.where(places[:, 4] == -1, -1, places[:, 4] & ((1 << self.bits) - 1))
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        ids, blobs = [], []
        for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
            own = order[a:b]
            strings = [self.strings[i] for i in own]
            sizes = np.fromiter(map(len, strings), np.int64, len(own))
            columns = places[own].T.copy()
            columns[:2] = np.diff(columns[:2], prepend=0)  # neighbours are often of one document
            body = np.int64(len(own)).tobytes() + columns.tobytes() + sizes.tobytes() + b"".join(strings)
            ids.append(int(bucket[own[0]]))
            blobs.append(self.press.compress(body))
        self.clear()
        for i in range(0, len(ids), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(ids[i : i + 4096], pa.int32()), pa.array(blobs[i : i + 4096], pa.binary())], ["bucket", "blob"])


def opened(blob: bytes) -> tuple[np.ndarray, list[bytes]]:
    body = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(body, np.int64, 1)[0])
    columns = np.frombuffer(body, np.int64, n * WIDTH, 8).reshape(WIDTH, n).copy()
    columns[:2] = np.cumsum(columns[:2], axis=1)
    places = columns.T
    sizes = np.frombuffer(body, np.int64, n, 8 + 8 * n * WIDTH)
    at = 8 + 8 * n * (WIDTH + 1)
    ends = at + np.cumsum(sizes)
    return places, [body[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def surroundings(pieces: np.ndarray, edges: np.ndarray, piece: int, reach: int, low: int = 64) -> np.ndarray:
    """Each piece's hash above 28 bits for the pieces of its document that start at most `reach` away.

    edges: where documents start, and the end of the last, in units of text; a piece has `piece` units, and
    those that cross into another document are left out, and so are hashes of more than `low` bits, which are
    hardly ever the least of a wide window.
    """
    sizes = np.diff(edges)
    last = np.repeat(edges[1:] - piece + 1, sizes)[: len(pieces)]
    first = np.repeat(edges[:-1], sizes)[: len(pieces)]
    at = np.flatnonzero((np.arange(len(pieces)) < last) & (pieces <= np.uint64(2**low - 1)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(pieces)])
    near = sums[np.minimum(at + reach + 1, last[at])] - sums[np.maximum(at - reach, first[at])]
    return (pieces[at] & ~LOW) | (common.mix(near) >> np.uint64(36))


def frequent(rows: DataFrame, look: Callable, parts: Callable, buckets: int) -> np.ndarray:
    """Hashes of the pieces in more than FEW and one of 32 * buckets of all surroundings, sorted; so at most 32 * buckets.

    look(texts) gives a block's surroundings. Of each COUNTED of them a task sends on the hashes that one of
    64 * buckets of them have, and two at least. So a sum lacks at most that share, or LAST for each task.
    """
    most = 16 * buckets

    def count(batches):
        held, size = [], 0

        def flush(least):
            hashes, counts = np.unique(np.unique(np.concatenate(held)) >> LOW_BITS, return_counts=True)
            often = counts > max(least, int(counts.sum()) // (4 * most))
            kept = [pa.array(np.concatenate([[-1], hashes[often].astype(np.int64)])), pa.array(np.concatenate([[counts.sum()], counts[often]]))]
            yield pa.RecordBatch.from_arrays(kept, ["piece", "n"])

        for _, texts in common.blocks(batches, BLOCK, parts):
            held.append(look(texts))
            size += len(held[-1])
            if size >= COUNTED:
                yield from flush(1)
                held, size = [], 0
        if size:
            yield from flush(LAST)

    counted = common.cut(rows.select(F.col("text").cast("binary").alias("text")).mapInArrow(count, "piece bigint, n bigint").groupBy("piece").agg(F.sum("n").alias("n")))
    whole = counted.where("piece = -1").first()
    if whole is None:
        return np.zeros(0, np.uint64)
    hot = counted.where((F.col("piece") >= 0) & (F.col("n") > max(FEW, whole["n"] // (2 * most)))).select("piece").toArrow()
    return np.sort(hot.column(0).to_numpy().astype(np.uint64))


def last_in_order(pieces: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Hashes above places, those of frequent pieces all ones, so that the least is the leftmost of the least."""
    keys = (pieces & ~LOW) | (np.arange(len(pieces), dtype=np.uint64) & LOW)
    if len(hot):
        own = pieces >> LOW_BITS
        at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
        keys[hot[at] == own] |= ~LOW
    return keys


def minimisers(least: np.ndarray, pieces: np.ndarray, offsets: list[int]) -> np.ndarray:
    """The minimiser of each window; where all its pieces are frequent, a hash of its pieces at the offsets."""
    mins = least >> LOW_BITS
    alone = np.flatnonzero(mins == ~np.uint64(0) >> LOW_BITS)
    if len(alone):
        whole = np.zeros(len(alone), np.uint64)
        for o in offsets:
            whole = common.mix(whole * common.MULT + pieces[alone + o])
        mins[alone] = whole >> LOW_BITS
    return mins


def repeats(rows: DataFrame, n: str, look: Callable, scan: Callable, judge: Callable, bits: int, parts: Callable, key: Callable | None = None) -> DataFrame:
    """Rows (number, spans) with the spans that repeat, as pairs of 64-bit integers (start, length).

    rows: documents with their numbers (common.numbered) in column n.
    look(texts) gives the surroundings of a block's pieces. scan(hot) makes a function (rows, texts, outbox)
    that adds a block's super-k-mers to the outbox; a row is (k, number, units before the text). judge(places, strings) yields (number, start, length) for a bucket, given its places and strings.
    parts cuts long texts. key(places, strings) gives what strings with one anchor have in common; the
    minimiser's `bits` low bits otherwise. A bucket has the minimisers of one hash class; there are 16 for
    each shuffle partition, so raise spark.sql.shuffle.partitions with the input to keep buckets small.
    """
    buckets = 16 * common.partitions(rows)
    add = scan(frequent(rows, look, parts, buckets))

    def send(batches):
        out = Outbox(buckets, bits)
        for block, texts in common.blocks(batches, BLOCK, parts):
            add(block, texts, out)
            if out.held >= FLUSH:
                yield from out.messages()
        yield from out.messages()

    def receive(group: pa.Table) -> pa.Table:
        opened_parts = [opened(b) for b in group.column("blob").to_pylist()]
        places = np.concatenate([p for p, _ in opened_parts])
        strings = [s for _, own in opened_parts for s in own]
        found = defaultdict(list)
        kept = places[:, 4] == -1  # repeats that the map task knew of
        for number, start, length in places[kept][:, 1:4].tolist():
            found[number].append((start, length))
        packed = np.flatnonzero(~kept)
        # only a minimiser that came twice can hold a repeated window
        common_to = key(places[packed], [strings[i] for i in packed]) if key else places[packed, 4]
        _, inverse, counts = np.unique(common_to, return_inverse=True, return_counts=True)
        often = packed[(counts[inverse] > 1) | (places[packed, 5] < 0)]
        for number, start, length in judge(places[often], [strings[i] for i in often]):
            found[number].append((start, length))
        return pa.table({"number": pa.array(list(found), pa.int64()), "spans": pa.array([np.array(x, np.int64).tobytes() for x in found.values()], pa.binary())})

    sent = rows.select(common.doc_key().alias("k"), F.col(n).alias("n"), F.col("text").cast("binary").alias("text")).mapInArrow(send, "bucket int, blob binary")
    return sent.groupBy("bucket").applyInArrow(receive, "number bigint, spans binary")


def finish(rows: DataFrame, n: str, spans: DataFrame, fn: Callable, outputs: dict[str, str]) -> DataFrame:
    """The documents with what fn(text, starts, ends) gives for each; spans sorted and merged."""
    lists = common.spare(rows, "_spans")
    each = spans.groupBy(F.col("number").alias(n)).agg(F.collect_list("spans").alias(lists))

    def run(own, found):
        texts = common.field(own, "text").to_pylist()
        got = [fn(t, *merged(s)) for t, s in zip(texts, found.to_pylist(), strict=True)]
        return [pa.array(c, _ARROW[kind]) for c, kind in zip(zip(*got, strict=True) if got else [[]] * len(outputs), outputs.values(), strict=True)]

    return common.attach(rows.join(each, n, "left").drop(n), run, outputs, (lists,))


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def merged(blobs: list[bytes] | None) -> tuple[list[int], list[int]]:
    """Starts and ends of the union of spans; spans that touch become one."""
    if not blobs:
        return [], []
    pairs = np.frombuffer(b"".join(blobs), np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    ends = np.maximum.accumulate(pairs[:, 0] + pairs[:, 1])
    new = np.concatenate([[True], pairs[1:, 0] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(pairs) - 1]])
    return pairs[new, 0].tolist(), ends[last].tolist()
