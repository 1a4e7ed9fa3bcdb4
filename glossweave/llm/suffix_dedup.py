"""Substring dedup over bytes, by deep-shallow sorting of a sparse suffix array.

Each window of bytes has an anchor, the leftmost least piece in it; equal windows have their
anchors at the same offset. Consecutive windows with one anchor travel together to the anchor's
bucket. There the suffixes that start at anchors are put in order: multikey quicksort to a shallow
depth (the anchor's piece), then blind tries order the groups that agree so far. The order comes with
the common prefixes of neighbours; suffixes of one interval of it agree on so many bytes to the right,
and with the bytes that also agree to the left, that gives every window that they share.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, exchange

WINDOW = 200
#: Bytes of an anchor, and the shallow depth of the sort; three keys of 8 bytes.
SHALLOW = 24
_RADIX = np.uint64(0xD6E8FEB86659FD93)


def _look(window: int):
    piece = min(SHALLOW, window // 8 * 8) or 8

    def look(texts) -> np.ndarray:
        edges = np.cumsum([0, *map(len, texts)])
        return exchange.surroundings(_pieces(np.frombuffer(b"".join(texts), np.uint8), piece), edges, piece, window - piece, 60)

    return look


def _scan(window: int, hot: np.ndarray):
    piece = min(SHALLOW, window // 8 * 8) or 8
    between = [*range(0, window - piece, piece), window - piece]

    def scan(rows, texts, out: exchange.Outbox) -> None:
        body = b"".join(texts)
        if len(body) < window:
            return
        pieces = _pieces(np.frombuffer(body, np.uint8), piece)
        least = common.sliding_min(exchange.last_in_order(pieces, hot), window - piece + 1)
        minimisers = exchange.minimisers(least, pieces, between)
        change = np.flatnonzero(np.diff(least)) + 1
        at, spot = 0, 0
        places, strings, seen = out.places, out.strings, out.seen
        for (k, number, before), text in zip(rows, texts, strict=True):
            a, b = at, at + len(text) - window + 1
            at += len(text)
            if b <= a:
                continue
            spot = int(np.searchsorted(change, a, "right"))
            upto = int(np.searchsorted(change, b))
            cuts = np.concatenate([[a], change[spot:upto], [b]])
            own = least[cuts[:-1]]
            where = (own & exchange.LOW).astype(np.int64)
            # places count modulo 2**28; a window's anchor is at its start or after
            where = cuts[:-1] + ((where - cuts[:-1]) & ((1 << 28) - 1))
            mins = minimisers[cuts[:-1]].tolist()
            offsets = (where - cuts[:-1]).tolist()
            rights = (cuts[1:] + (window - 1)).tolist()
            out.held += sum(rights) - int(cuts[:-1].sum()) + 160 * len(mins)
            for left, right, m, w in zip(cuts.tolist(), rights, mins, offsets):  # noqa: B905
                string = body[left:right]
                old = seen.setdefault(string, len(places))
                if old == len(places):
                    places.append((0, number, before + left - a, right - left, m, w))
                    strings.append(string)
                elif (number, before + left - a) != places[old][1:3]:
                    places.append((0, number, before + left - a, right - left, -1, 0))
                    strings.append(b"")
                    if places[old][5] >= 0:  # the first repeats too; less than 0 tells the bucket so
                        places[old] = (*places[old][:5], -1 - places[old][5])

    return scan


def _pieces(data: np.ndarray, piece: int) -> np.ndarray:
    """The hash of the `piece` bytes at each place."""
    if len(data) < piece:
        return np.zeros(0, np.uint64)
    sums = common.BYTE[data]
    size, radix, parts = 1, _RADIX, []
    while True:  # hashes of 1, 2, 4, ... bytes; those in piece's binary form are joined
        if piece & size:
            parts.append((size, sums, radix))
        if size * 2 > piece:
            break
        sums = sums[:-size] * radix + sums[size:]
        size, radix = size * 2, np.uint64(int(radix) ** 2 % 2**64)
    n, offset = len(data) - piece + 1, 0
    total = None
    for size, part, radix in reversed(parts):
        own = part[offset : offset + n]
        if total is None:
            total = own.copy()
        else:
            total *= radix
            total += own
        offset += size
    total ^= total >> np.uint64(31)
    total *= common.MULT
    return total


def shallow_groups(suffixes: list[bytes], depth: int) -> list[list[int]]:
    """Multikey quicksort over 8-byte characters to `depth`, which all have: in order, the groups that agree so far."""
    heads = np.frombuffer(b"".join(s[:depth] for s in suffixes), ">u8").reshape(-1, depth // 8).T.astype(np.uint64)
    done, todo = [], [(np.arange(len(suffixes)), 0)]
    while todo:
        own, at = todo.pop()
        if len(own) < 2 or at >= depth:
            if len(own):
                done.append(own.tolist())
            continue
        keys = heads[at // 8, own]
        pivot = np.partition(keys, len(keys) // 2)[len(keys) // 2]
        todo += [(own[keys > pivot], at), (own[keys == pivot], at + 8), (own[keys < pivot], at)]
    return done


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_length() + 7) // 8


class BlindTrie:
    """A Patricia trie of strings: nodes are [depth, {next byte: child}], leaves [depth, ids].

    A string's descent looks only at branching bytes; then one comparison with any leaf below
    gives the true common prefix, and with it the place to branch off. -1 branches at an end.
    """

    def __init__(self, strings: list[bytes], ids: list[int]):
        self.strings, self.root = strings, None
        for i in ids:
            self.add(i)

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [len(s), None, [i]]
            return
        node = self.root
        while node[1] is not None:
            node = node[1].get(s[node[0]] if node[0] < len(s) else -1) or next(iter(node[1].values()))
        other = self.strings[node[2][0]]
        agreed = common_prefix(s, other)
        up, byte, node = None, None, self.root
        while node[1] is not None and node[0] <= agreed:
            step = s[node[0]] if node[0] < len(s) else -1
            if node[0] == agreed and step not in node[1]:
                node[1][step] = [len(s), None, [i]]
                return
            up, byte, node = node, step, node[1][step]
        if node[1] is None and agreed == len(s) == len(other):
            node[2].append(i)
            return
        fork = [agreed, {other[agreed] if agreed < len(other) else -1: node, s[agreed] if agreed < len(s) else -1: [len(s), None, [i]]}, None]
        if up is None:
            self.root = fork
        else:
            up[1][byte] = fork

    def ordered(self) -> tuple[list[int], list[int]]:
        """The ids in order of their strings, and what each has in common with the one before (0 for the first)."""
        order, common_with_last = [], []
        todo = [(self.root, 0)] if self.root else []
        while todo:
            node, agreed = todo.pop()
            if node[1] is None:
                order += node[2]
                common_with_last += [agreed, *[node[0]] * (len(node[2]) - 1)]
            else:
                children = sorted(node[1].items())  # an end, -1, comes first
                todo += [(c, node[0]) for _, c in children[:0:-1]]
                todo.append((children[0][1], agreed))
        return order, common_with_last


def suffix_order(suffixes: list[bytes], depth: int) -> tuple[list[int], list[int]]:
    """Deep-shallow sort: (suffixes in order, bytes that each has in common with the one before).

    0 stands for less than `depth` bytes in common, where the shallow sort has told them apart.
    """
    order, agreed = [], []
    for group in shallow_groups(suffixes, depth):
        own, lengths = (group, [0]) if len(group) == 1 else BlindTrie(suffixes, group).ordered()
        order += own
        agreed += lengths
    return order, agreed


def intervals(agreed: list[int]):
    """(depth, first, last + 1) of all runs whose neighbours have `depth` or more in common, the deep ones first."""
    held: list[list[int]] = []
    for at, depth in enumerate([*agreed, 0]):
        first = at - 1
        while held and held[-1][0] > depth:
            deep, first = held.pop()
            yield deep, first, at
        if depth and (not held or held[-1][0] < depth):
            held.append([depth, first])


def shared_windows(lefts: list[bytes], order: list[int], agreed: list[int], window: int) -> dict[int, list[tuple[int, int]]]:
    """For each suffix the ranges of offsets (bytes before the anchor) whose windows it shares.

    lefts are reversed: they start at the byte before the anchor.
    """
    found: dict[int, list[tuple[int, int]]] = {}
    for depth, first, last in intervals(agreed):
        least = max(0, window - depth)  # offsets that depth bytes to the right suffice for
        able = [i for i in order[first:last] if len(lefts[i]) >= least]
        if len(able) < 2:
            continue
        able.sort(key=lefts.__getitem__)  # neighbours agree the most to the left
        same = [-1, *(common_prefix(lefts[a], lefts[b]) for a, b in zip(able, able[1:], strict=False)), -1]
        for n, i in enumerate(able):
            most = min(max(same[n], same[n + 1]), window)
            if most >= least:
                found.setdefault(i, []).append((least, most))
    return found


def _anchored(places: np.ndarray, strings: list[bytes]) -> np.ndarray:
    """The first key of the suffix at each anchor."""
    offsets = np.where(places[:, 5] >= 0, places[:, 5], -1 - places[:, 5]).tolist()
    return np.frombuffer(b"".join(s[o : o + 8] for s, o in zip(strings, offsets, strict=True)), ">u8")


def _judge(window: int):
    piece = min(SHALLOW, window // 8 * 8) or 8

    def judge(places: np.ndarray, strings: list[bytes]):
        rows = places.tolist()
        offsets = [r[5] if r[5] >= 0 else -1 - r[5] for r in rows]
        order, agreed = suffix_order([s[o:] for s, o in zip(strings, offsets, strict=True)], piece)
        lefts = [s[:o][::-1] for s, o in zip(strings, offsets, strict=True)]
        for i, ranges in shared_windows(lefts, order, agreed, window).items():
            _, number, start, size, *_ = rows[i]
            for low, high in ranges:
                a, b = max(0, offsets[i] - high), min(size, offsets[i] - low + window)
                if b - a >= window and rows[i][5] >= 0:
                    yield number, start + a, b - a
        for _, number, start, size, _, more in rows:
            if more < 0:  # the map task has met the whole string again
                yield number, start, size

    return judge


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without the bytes that a string of `window` bytes covers which starts anywhere else too.

    Texts are UTF-8 bytes; matches don't cross documents; overlapping places count, in one document
    too. Adds n_bytes, n_removed, n_spans (maximal removed runs) and kept (the bytes left; a cut
    may split a character). Null and empty texts have no bytes. Each row is a document, whatever its id, so
    repeated rows repeat each other. Very long texts are scanned in overlapping parts, with the same
    result. Other columns pass; those with an output's name are replaced.
    """
    n = common.spare(docs, "_n")
    rows = common.numbered(docs, n)
    parts = lambda text, size: common.byte_parts(text, size, window - 1)
    spans = exchange.repeats(rows, n, _look(window), lambda hot: _scan(window, hot), _judge(window), 0, parts, _anchored)

    def finish(text, starts, ends):
        body, at, kept = (text or "").encode(), 0, []
        for s, e in zip(starts, ends, strict=True):
            kept.append(body[at:s])
            at = e
        return len(body), sum(ends) - sum(starts), len(starts), b"".join([*kept, body[at:]])

    return exchange.finish(rows, n, spans, finish, {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept": "binary"})


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
