"""Substring dedup over words, by super-k-mer partitioning.

Consecutive windows that share a minimiser travel as one packed string to the minimiser's bucket,
where sorting the windows finds the first place of each word sequence exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, exchange

WINDOW = 20
#: Words in the pieces that minimisers are chosen from; common pairs of words don't get a bucket of their own.
PIECE = 4
_RADIX = np.uint64(0xD6E8FEB86659FD93)


def _pieces(words: common.Words, piece: int) -> np.ndarray:
    grams = np.zeros(max(0, len(words.start) - piece + 1), np.uint64)
    for j in range(piece):
        grams = grams * _RADIX + words.hash[j : len(grams) + j]
    return common.mix(grams)


def _look(window: int):
    piece = min(PIECE, window)

    def look(texts) -> np.ndarray:
        words = common.Words(texts)
        return exchange.surroundings(_pieces(words, piece), words.first, piece, window - piece)

    return look


def _scan(window: int, hot: np.ndarray):
    piece = min(PIECE, window)
    offsets = [*range(0, window - piece, piece), window - piece]

    def scan(rows, texts, out: exchange.Outbox) -> None:
        words = common.Words(texts)
        if len(words.start) < window:
            return
        grams = _pieces(words, piece)
        least = common.sliding_min(exchange.last_in_order(grams, hot), window - piece + 1)
        minimisers = exchange.minimisers(least, grams, offsets)
        first, spot = words.first.tolist(), 0
        starts, ends, packed = words.start, words.end, words.packed
        change = np.flatnonzero(np.diff(least)) + 1  # another place, so no window repeats within a string
        for d, row in enumerate(rows):
            a, b = first[d], first[d + 1] - window + 1  # this document's window starts
            if b <= a:
                continue
            while spot < len(change) and change[spot] <= a:
                spot += 1
            upto = int(np.searchsorted(change, b))
            cuts = [a, *change[spot:upto].tolist(), b]
            spot = upto
            k, number, before = row
            lefts = starts[cuts[:-1]].tolist()
            rights = ends[[c + window - 2 for c in cuts[1:]]].tolist()
            mins = minimisers[cuts[:-1]].tolist()
            for i, (left, right, m) in enumerate(zip(lefts, rights, mins, strict=True)):
                add(out, packed[left:right], k, number, before + cuts[i] - a, cuts[i + 1] - cuts[i] + window - 1, m)

    def add(out: exchange.Outbox, string: bytes, *place: int) -> None:
        # place: k, number, start, length, minimiser; places are ordered by the first three
        old = out.seen.setdefault(string, len(out.places))
        if old < len(out.places):
            first = out.places[old]
            if place[:3] < first[:3]:
                out.places[old], place = (*place, 0), first[:5]
            out.places.append((*place[:4], -1, 0))
            out.strings.append(b"")
            return
        out.places.append((*place, 0))
        out.strings.append(string)
        out.held += len(string) + 160

    return scan


def _judge(window: int):
    def judge(places: np.ndarray, strings: list[bytes]):
        order = np.argsort(places[:, 4], kind="stable").tolist()
        rows = places.tolist()
        group: list[int] = []
        for i in [*order, None]:
            if group and (i is None or rows[i][4] != rows[group[0]][4]):
                if len(group) > 1:
                    yield from one([rows[j] for j in group], [strings[j] for j in group])
                group = []
            if i is not None:
                group.append(i)

    def one(rows: list, strings: list[bytes]):
        least: dict[bytes, tuple] = {}
        for row, s in zip(rows, strings, strict=True):
            if s not in least or tuple(row[:3]) < least[s]:
                least[s] = tuple(row[:3])
        keep = []
        for row, s in zip(rows, strings, strict=True):
            if tuple(row[:3]) > least[s]:
                yield row[1], row[2], row[3]
            else:
                keep.append((row, s))
        if len(least) == 1:
            return
        windows = []
        for j, ((k, number, start, length, *_), s) in enumerate(keep):
            at = [-1, *_spaces(s), len(s)]
            windows += [(s[at[t] + 1 : at[t + window]], k, number, start + t, j, t) for t in range(length - window + 1)]
        windows.sort()  # the first of each word sequence leads
        gone: dict[int, list[int]] = {}
        leader = None
        for w, _, _, _, j, t in windows:
            if w == leader:
                gone.setdefault(j, []).append(t)
            leader = w
        for j, ts in gone.items():
            (_, number, start, *_), _ = keep[j]
            ts.sort()
            a = ts[0]
            for t, then in zip(ts, [*ts[1:], None], strict=True):
                if then != t + 1:
                    yield number, start + a, t - a + window
                    a = then

    return judge


def _spaces(s: bytes) -> list[int]:
    return np.flatnonzero(np.frombuffer(s, np.uint8) == 32).tolist()


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without the words that a window repeats from an earlier place.

    A window is `window` consecutive words ([^\\x20\\x09-\\x0D]+) of one document, which is one row; places
    are ordered by doc_id (null first), then row, then start: of rows with one doc_id, repeated rows too,
    the first in table order stays. Adds n_words, n_removed and kept_text (kept words, joined by one
    space). Null and empty texts have no words and kept_text ''. Very long texts are scanned in
    overlapping parts, with the same result. Other columns pass; those with an output's name are replaced.
    """
    n = common.spare(docs, "_n")
    rows = common.numbered(docs, n)
    parts = lambda text, size: common.word_parts(text, size, window - 1)
    spans = exchange.repeats(rows, n, _look(window), lambda hot: _scan(window, hot), _judge(window), 18, parts)

    def finish(text, starts, ends):
        words = (text or "").encode().translate(_TO_SPACE).split(b" ") if text else []
        words = [w for w in words if w]
        kept, at = [], 0
        for s, e in zip(starts, ends, strict=True):
            kept += words[at:s]
            at = e
        removed = sum(ends) - sum(starts)
        return len(words), removed, b" ".join(kept + words[at:]).decode()

    return exchange.finish(rows, n, spans, finish, {"n_words": "bigint", "n_removed": "bigint", "kept_text": "string"})


_TO_SPACE = bytes(32 if c in common.SEPARATORS else c for c in range(256))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


#: Every window with its first place, then the words that later windows cover.
SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i : i + 19], ' ')) AS h
  FROM w, unnest(generate_series(1, len(ws) - 19)) AS g(i)),
late AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
starts AS (SELECT doc_id, list(i) AS s FROM late GROUP BY doc_id),
gone AS (
  SELECT doc_id, list_distinct(flatten(list_transform(s, lambda a: range(a, a + 20)))) AS g FROM starts)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN g IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(g, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""
