"""N-gram Jaccard join, by chosen paths.

A run splits the sets recursively: a path is a list of shingles, and a set takes from a path the
steps that its own shingles sample. All of a document's paths follow from hashes and its own set, so
they are found in the map task, to the depth at which buckets of unrelated documents are small.
Documents that share a path are a bucket. Near copies share many buckets, so that no pair is compared
twice, each document lies in one block (the blocks follow its least buckets), and two blocks, or a
block and itself, are compared by brute force, once, if any bucket has members in both. Runs repeat until a pair at the
threshold is found with the target recall.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9999
#: Documents, and shingles, of a block at most (about; one document may have more shingles).
GROUP, SHINGLES = 2048, 1 << 21
#: Bytes of a text that are scanned at once.
PART = 1 << 20
_RADIX = np.uint64(0xD6E8FEB86659FD93)


def plan(n: int, threshold: float, recall: float) -> tuple[float, int, int]:
    """(share of a set that a step samples, depth, runs).

    Sets with Jaccard j share at least j times the larger size, and a step goes on in the interval of
    the larger set, so a pair at the threshold goes on in at least rate * threshold steps on average
    (the least where one set lies within the other, one step where they have the same size). The
    chance to reach the depth follows from the Poisson law. Depth grows with the logarithm of the
    number of documents.
    """
    rate = (1 + threshold) / (2 * threshold)
    depth = max(3, math.ceil(math.log(max(n, 2)) / 2.5))
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(rate * threshold * (lost - 1))
    return rate, depth, math.ceil(math.log(1 - recall) / math.log(lost))


def _grams(words: common.Words, width: int) -> np.ndarray:
    grams = np.zeros(max(0, len(words.start) - width + 1), np.uint64)
    for j in range(width):
        grams = grams * _RADIX + words.hash[j : j + len(grams)]
    return common.mix(grams)


def _long(text: bytes, width: int) -> tuple[np.ndarray, str]:
    """The shingles and the print of one long text, part by part."""
    digest, found, last = hashlib.sha256(), [], 0
    for before, part in common.word_parts(text, PART, width - 1):
        found.append(np.unique(_grams(common.Words([part]), width)))
        own = part.split()
        new = own[last - before :] if last > before else own
        digest.update((b" " if last and new else b"") + b" ".join(new))
        last = before + len(own)
    own, name = np.unique(np.concatenate(found)), digest.hexdigest()[:32]
    return (np.array([int(name[:16], 16)], np.uint64) if 0 < last < width else own), name


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The sorted distinct 64-bit shingles of all texts, the first one's place for each, and a print of its words.

    A text with fewer words than `width` has one shingle, all its words; one without words none.
    """
    words = common.Words([b"" if len(t) > PART else t for t in texts])
    grams, first, prints, values = _grams(words, width), words.first, [], []
    for d, text in enumerate(texts):
        a, b = int(first[d]), int(first[d + 1])
        if len(text) > PART:
            own, name = _long(text, width)
        else:
            name = hashlib.sha256(words.packed[words.start[a] : words.end[b - 1]] if b > a else b"").hexdigest()[:32]
            own = np.unique(grams[a : b - width + 1]) if b - a >= width else np.array([int(name[:16], 16)] * (b > a), np.uint64)
        prints.append(name)
        values.append(own)
    sizes = np.fromiter(map(len, values), np.int64, len(texts))
    return (np.concatenate(values) if values else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)]), prints


def paths(values: np.ndarray, place: np.ndarray, rate: float, depth: int, runs: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, path) of every path of full depth.

    A path samples the shingles whose hash lies in an interval that starts at the path's own hash;
    its length is rate / size of the set. Intervals may wrap.
    """
    sizes = np.diff(place)
    docs = np.repeat(np.flatnonzero(sizes), runs)
    path = common.mix(np.tile(np.arange(1, runs + 1, dtype=np.uint64) * common.MULT, int((sizes > 0).sum())))
    # one sorted array of (document, high hash bits), so that all intervals are found at once
    top = np.uint64(36)
    flat = (np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes) << top) | (values >> np.uint64(28))
    span = np.minimum(np.ceil(rate / np.maximum(sizes, 1) * 2.0**36), 2.0**36).astype(np.uint64)
    unit = np.uint64(1) << top
    for _ in range(depth):
        low = common.mix(path + common.MULT) >> np.uint64(28)
        base = docs.astype(np.uint64) << top
        high = low + span[docs]
        a = np.searchsorted(flat, base | low)
        b = np.searchsorted(flat, base + np.minimum(high, unit))
        wrapped = np.where(high > unit, high - unit, np.uint64(0))
        c = place[docs]
        d = np.maximum(np.searchsorted(flat, base + wrapped), c)
        n1, n2 = b - a, d - c
        count = n1 + n2
        owner = np.repeat(np.arange(len(docs)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at = np.where(step < n1[owner], a[owner] + step, c[owner] + step - n1[owner])
        docs, path = docs[owner], common.mix(path[owner] * _RADIX + values[at])
    return docs, path


def text_key() -> Column:
    """128 bits of the text, which with the id find a row's text where ids are null or repeated."""
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def _signatures(docs: DataFrame, width: int, rate: float, depth: int, runs: int) -> DataFrame:
    def run(batches):
        for rows, texts in common.blocks(batches, PART):
            values, place, prints = shingle_sets(texts, width)
            owner, path = paths(values, place, rate, depth, runs)
            cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(path.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()), pa.array(prints), pa.array(np.diff(place), pa.int64()), lists], ["k", "h", "print", "size", "paths"])

    return docs.mapInArrow(run, "k bigint, h binary, print string, size bigint, paths array<bigint>")


def compare(values: np.ndarray, place: np.ndarray, threshold: float, left: int | None = None):
    """Index pairs of sets with Jaccard of at least threshold; with left, only of the first `left` with the rest.

    Shingles that many sets have are columns of a matrix, whose product counts them; of the others
    the pairs of sets are counted one by one.
    """
    n, sizes = len(place) - 1, np.diff(place)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    owner = owner[order]
    first = np.flatnonzero(np.diff(values[order], prepend=values[order][:1] ^ np.uint64(1)))
    often = np.diff(first, append=len(owner))
    top, base = left or n, left or 0
    both = np.zeros((top, n - base), np.float32)  # counts up to 2**24 are exact
    few, width, met = 16, 4096, [np.zeros(0, np.int64)]
    for k in range(2, few + 1):
        runs = first[often == k]
        for i in range(k if len(runs) else 0):
            for j in range(i + 1, k):  # owners of one shingle ascend
                a, b = owner[runs + i], owner[runs + j]
                ok = (a < top) & (b >= base)
                met.append(a[ok] * (n - base) + b[ok] - base)
    met = np.sort(np.concatenate(met))
    at = np.flatnonzero(np.diff(met, prepend=-1))
    both.flat[met[at]] = np.diff(at, append=len(met))
    many = np.flatnonzero(often > few)
    for c in range(0, len(many), width):
        own, hit = many[c : c + width], np.zeros((n, min(width, len(many) - c)), np.float32)
        column = np.repeat(np.arange(len(own)), often[own])
        hit[owner[np.repeat(first[own], often[own]) + np.arange(len(column)) - np.repeat(np.cumsum(often[own]) - often[own], often[own])], column] = 1
        both += hit[:top] @ hit[base:].T
    ok = both >= threshold * (sizes[:top, None] + sizes[None, base:] - both) - 1e-9
    if left is None:
        ok = np.triu(ok, 1)
    i, j = np.nonzero(ok)
    return i, j + base


def _verify(width: int, threshold: float):
    """Compares a block with itself, or with another one; rows (block, other block, side, id, text) sorted by the first two."""

    def judge(rows: list) -> list:
        rows = sorted(rows, key=lambda r: r[2:4])
        ids, left = [r[3] for r in rows], sum(r[2] == 0 for r in rows)
        values, place, _ = shingle_sets([r[4] for r in rows], width)
        i, j = compare(values, place, threshold, left if left < len(rows) else None)
        links = np.bincount(np.concatenate([i, j]), minlength=len(ids))
        up = list(range(len(ids)))  # union-find, so that links that leave are a forest

        def find(x):
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        return [(ids[x], int(links[x]), ids[find(x)]) for x in np.flatnonzero(links).tolist()]

    def run(batches):
        held, last = [], None

        def out(rows):
            got = judge(rows)
            return pa.RecordBatch.from_arrays([pa.array([g[n] for g in got], pa.int64()) for n in range(3)], ["id", "links", "other"])

        for batch in batches:
            for x, y, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if last is not None and (x != last[0] or y != last[1]):
                    yield out(held)
                    held = []
                last = (x, y)
                held.append((x, y, *row))
        if held:
            yield out(held)

    return run


def _dealt(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(x, y, side, id): the documents of the blocks x and y that some bucket joins; side 1 is of y.

    members: (id, path) of buckets with two members or more; sizes: (id, size) of all sets.
    """
    # the least bucket of each document, then the least of these among all whom it meets, so that a group
    # of near copies, which has many buckets, lies in few blocks
    least = members.groupBy("id").agg(F.min("path").alias("home"))
    wide = members.join(least, "id").groupBy("path").agg(F.min("home").alias("home"))
    homes = members.join(wide, "path").groupBy("id").agg(F.min("home").alias("home")).join(sizes, "id")
    blocks = homes.groupBy("home").agg(F.ceil(F.greatest(F.count("*") / GROUP, F.sum("size") / SHINGLES)).alias("n"))
    block = F.struct("home", F.pmod(F.xxhash64("id"), F.col("n")).alias("part"))
    placed = common.cut(homes.join(blocks, "home").select("id", block.alias("block")))
    met = members.join(placed, "id").groupBy("path", "block").agg(F.count("*").alias("n"))
    pairs = met.select("path", F.col("block").alias("x"), "n").join(met.select("path", F.col("block").alias("y")), "path")
    pairs = pairs.where("x < y OR x = y AND n > 1").select("x", "y").distinct()
    left = pairs.join(placed.withColumnRenamed("block", "x"), "x").select("x", "y", F.lit(0).alias("side"), "id")
    right = pairs.where("x <> y").join(placed.withColumnRenamed("block", "y"), "y").select("x", "y", F.lit(1).alias("side"), "id")
    return left.union(right)


def join(docs: DataFrame, width: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row (k, h, class_id, first, n_links, n_copies) for each document; k is doc_id, h the text's digest.

    Texts are sets of `width`-word shingles (all words, if fewer). class_id: a number of the class, which is
    all rows that links, or equal word sequences, connect; ids have no say in it, so null and repeated ids are
    as good as others. first: whether the row has the least (k, h) of its class. n_links: how many other
    word sequences have a Jaccard similarity of at least threshold. n_copies: rows with the same words, this one
    too. Rows without words (null and empty texts, too) are classes of their own, with no link. Null
    ids count as the least long. Very long texts are scanned in parts, with the same result.
    """
    keyed = docs.select(common.doc_key().alias("k"), text_key().alias("h"), F.col("text").cast("binary").alias("text"))
    rate, depth, runs = plan(keyed.count(), threshold, recall)
    signed = common.cut(_signatures(keyed, width, rate, depth, runs))
    # equal word sequences are one class from here on; one of its texts stands for it. The numbers
    # of classes are drawn once: what follows reads them from the checkpoint
    classes = signed.where("size > 0").groupBy("print").agg(F.min(F.struct("k", "h")).alias("rep"), F.count("*").alias("n_copies"), F.max("size").alias("size"))
    classes = common.cut(classes.orderBy("rep").withColumn("id", F.monotonically_increasing_id()))  # ids in order of the representatives
    chosen = signed.drop("size").join(classes, "print").where("k = rep.k AND h = rep.h")
    steps = chosen.select("id", F.explode(F.array_distinct("paths")).alias("path"))
    shared = steps.groupBy("path").agg(F.min("id").alias("low"), F.max("id").alias("top")).where("low <> top").select("path")
    members = common.cut(steps.join(shared, "path").distinct())
    dealt = _dealt(members, classes.select("id", "size"))
    where = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", F.col("rep.k").alias("k"), F.col("rep.h").alias("h"))
    texts = keyed.join(where, ["k", "h"]).dropDuplicates(["id"]).select("id", "text")
    dealt = dealt.join(texts, "id").select("x", "y", "side", "id", "text")
    dealt = dealt.repartition(common.partitions(docs), "x", "y").sortWithinPartitions("x", "y")
    found = common.cut(dealt.mapInArrow(_verify(width, threshold), "id bigint, links bigint, other bigint"))
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    graded = classes.join(links, "id", "left").join(roots, "id", "left").withColumn("class_id", F.coalesce("root", "id"))
    graded = graded.select("print", "class_id", F.when(F.col("id") == F.col("class_id"), F.col("rep")).alias("head"), "n_links", "n_copies")
    alone = -1 - F.monotonically_increasing_id()  # signed is read from its checkpoint, in one order
    out = signed.select("k", "h", F.when(F.col("size") > 0, F.col("print")).alias("print"), alone.alias("alone")).join(graded, "print", "left")
    first = F.col("class_id").isNull() | F.coalesce(F.struct("k", "h") == F.col("head"), F.lit(False))
    return out.select("k", "h", F.coalesce("class_id", "alone").alias("class_id"), first.alias("first"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class of near duplicates: of the least doc_id, and of its texts that of the least digest.

    Ids may be null or repeated; rows without words all stay. Columns stay as they are.
    """
    k, h, alone = (common.spare(docs, c) for c in ("_k", "_h", "_alone"))
    first = join(docs).where("first").select(F.col("k").alias(k), F.col("h").alias(h))
    wordless = F.coalesce(F.translate("text", common.SEPARATORS.decode(), "") == "", F.lit(True))
    keyed = docs.withColumns({k: common.doc_key(), h: text_key(), alone: F.when(wordless, F.monotonically_increasing_id())})
    return keyed.join(first, [k, h], "left_semi").dropDuplicates([k, h, alone]).drop(k, h, alone)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = join(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.nullif("k", F.lit(common.NULL_KEY)).alias("doc_id"), "class_id", "n_links", "n_copies")
