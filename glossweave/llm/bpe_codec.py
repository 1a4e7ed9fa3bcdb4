"""BPE encoding and decoding with a contiguous rank array for each short word.

A word's part boundaries lie in one array beside the ranks of adjacent pairs. The least rank is
found by a scan, its boundary is deleted, and the two neighbouring ranks are looked up again.
Scans of a very long word would take the square of its length, so its ranks are also kept in a heap.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import itertools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .token_counts import Splitter, byte_symbols, vocabulary_path

_NONE = 1 << 60
_SPACE = regex.compile(r"\s+")


class WordBpe:
    """Ids of words as merges give them; the vocabulary's end-of-word suffix is part of the last symbol."""

    #: Characters from which on ranks lie in a heap.
    LONG = 200

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(a, b): n for n, (a, b) in enumerate(merges)}

    def encode(self, word: str) -> list[str]:
        """The tokens of one pre-token."""
        if not word:
            return []
        if len(word) > self.LONG:
            return self.encode_long(word)
        last = len(word) - 1
        symbol = lambda a, b: word[a:b] + self.suffix if b > last else word[a:b]
        rank = self.rank
        bounds = list(range(len(word) + 1))  # part i is word[bounds[i]:bounds[i + 1]]
        ranks = [rank.get((symbol(i, i + 1), symbol(i + 1, i + 2)), _NONE) for i in range(last)]
        while ranks:
            i = ranks.index(least := min(ranks))
            if least == _NONE:
                break
            del bounds[i + 1], ranks[i]
            new = symbol(bounds[i], bounds[i + 1])
            if i:
                ranks[i - 1] = rank.get((symbol(bounds[i - 1], bounds[i]), new), _NONE)
            if i < len(ranks):
                ranks[i] = rank.get((new, symbol(bounds[i + 1], bounds[i + 2])), _NONE)
        return [symbol(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode_long(self, word: str) -> list[str]:
        """The same for a word of any length: ranks in a heap, by place among equals; parts in a linked list."""
        parts = [*word[:-1], word[-1] + self.suffix]
        get, n = self.rank.get, len(parts)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:  # one of them has been merged since
                continue
            parts[i], parts[j] = a + b, ""
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := get((a + b, parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, a + b, parts[k]))
            if (h := left[i]) >= 0 and (r := get((parts[h], a + b))) is not None:
                heapq.heappush(heap, (r, h, parts[h], a + b))
        return [p for p in parts if p]


class Index(dict):
    """Numbers for pieces, in the order of their first look-up."""

    def __missing__(self, piece):
        self[piece] = n = len(self)
        return n


class Pool:
    """Runs of values by number; `gather` concatenates the runs of many numbers."""

    def __init__(self, dtype):
        self.data, self.sizes, self.starts = np.zeros(0, dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def extend(self, data: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.data) + np.cumsum(sizes) - sizes])
        self.data, self.sizes = np.concatenate([self.data, data]), np.concatenate([self.sizes, sizes])

    def gather(self, numbers: np.ndarray) -> np.ndarray:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        return self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - ends + sizes, sizes)]


class Codec:
    """Ids and decoded text of one worker, by pieces that white space parts.

    Pieces that the worker hasn't met are encoded together: row by row of a matrix, the same rank arrays as
    WordBpe's, with the least rank found, its boundary deleted and its neighbours refreshed in all rows.
    """

    SHORT, KNOWN = 24, 400_000

    def __init__(self, path: str):
        gc.set_threshold(200_000, 50, 1000)  # the index is large and holds no cycles
        self.split, self.bpe = Splitter(path), WordBpe(path)
        t = self.split.tokenizer
        self.normalize, self.pretokenize = t.normalizer.normalize_str, t.pre_tokenizer.pre_tokenize_str
        self.added = self.split.added
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        ids, suffix = self.bpe.ids, self.bpe.suffix
        names = [""] * (max(ids.values(), default=-1) + 1)
        names += [""] * (max(self.added.values(), default=-1) + 1 - len(names))
        for s, i in (ids | self.added).items():
            names[i] = s
        coded = [f"{s} ".encode() for s in names]
        self.tokens = Pool(np.uint8)  # decoded: each token and a space, which is how this vocabulary joins them
        self.tokens.extend(np.frombuffer(b"".join(coded), np.uint8), np.fromiter(map(len, coded), np.int64))
        self.symbol = byte_symbols()
        self.byte = {c: b for b, c in self.symbol.items()}
        self.base = np.array([ids[self.symbol[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[self.symbol[b] + suffix] for b in range(256)], np.int64)
        pairs = [(ids[a] << 20 | ids[b], n, ids[a + b]) for (a, b), n in self.bpe.rank.items() if a in ids and b in ids and a + b in ids]
        self.pair, self.rank, self.merge = np.array(sorted(pairs), np.int64).T.copy()
        self.forget()

    def forget(self) -> None:
        self.index, self.pool = Index(), Pool(np.uint32)

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged ids of pairs; an id of -1 has no pair."""
        key = a << 20 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = (self.pair[at] == key) & (a >= 0) & (b >= 0)
        return np.where(known, self.rank[at], _NONE), np.where(known, self.merge[at], -1)

    def encode_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short pre-tokens, given as bytes, and how many each has."""
        n, width = len(words), max(map(len, words)) + 1
        sizes = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), sizes)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        parts = np.full((n, width), -1, np.int64)
        parts[row, col] = self.base[flat]
        parts[np.arange(n), sizes - 1] = self.last[flat[np.cumsum(sizes) - 1]]
        ranks, merged = self.look(parts[:, :-1], parts[:, 1:])
        live, out = np.arange(n), np.full((n, width), -1, np.int64)
        while len(live):
            i = ranks.argmin(1)
            rows = np.arange(len(live))
            go = ranks[rows, i] < _NONE
            out[live[~go], : parts.shape[1]] = parts[~go]
            live, parts, ranks, merged, i = live[go], parts[go], ranks[go], merged[go], i[go]
            if not len(live):
                break
            rows = np.arange(len(live))
            parts[rows, i] = merged[rows, i]
            keep = np.ones(parts.shape, bool)
            keep[rows, i + 1] = False
            parts = parts[keep].reshape(len(live), -1)
            keep = np.ones(ranks.shape, bool)
            keep[rows, i] = False
            ranks, merged = ranks[keep].reshape(len(live), -1), merged[keep].reshape(len(live), -1)
            if not ranks.shape[1]:
                out[live, :1] = parts[:, :1]
                break
            for j in (i - 1, i):
                ok = (j >= 0) & (j < ranks.shape[1])
                r, j = rows[ok], j[ok]
                ranks[r, j], merged[r, j] = self.look(parts[r, j], parts[r, j + 1])
        real = out >= 0
        return out[real].astype(np.uint32), real.sum(1)

    def learn(self, pieces: list[str]) -> None:
        """Adds the pieces, which have no white space, to the pool in this order."""
        findall, index, flat, counts = self.pattern.findall, Index(), [], []
        for piece in pieces:
            if piece in self.added:
                own = [piece]
            elif piece.isascii() or max(piece) <= "ɏ":  # characters that NFC leaves, and the same classes
                own = [p.encode() for p in findall(piece.lower())]
            else:
                own = [bytes(self.byte[c] for c in p) for p, _ in self.pretokenize(self.normalize(piece))]
            flat += map(index.__getitem__, own)
            counts.append(len(own))
        words, order, runs = list(index), [], Pool(np.uint32)
        sizes = np.fromiter((len(w) if isinstance(w, bytes) else -1 for w in words), np.int64, len(words))
        for low, high in ((0, 6), (6, 9), (9, 12), (12, 16), (16, self.SHORT)):  # rows of like length
            own = np.flatnonzero((sizes > low) & (sizes <= high))
            for i in range(0, len(own), 4096):
                runs.extend(*self.encode_all([words[n] for n in own[i : i + 4096].tolist()]))
                order.append(own[i : i + 4096])
        for n in np.flatnonzero((sizes > self.SHORT) | (sizes <= 0)).tolist():
            w = words[n]
            found = [self.added[w]] if isinstance(w, str) else [self.bpe.ids[x] for x in self.bpe.encode("".join(self.symbol[b] for b in w)) if x in self.bpe.ids]
            runs.extend(np.array(found, np.uint32), np.array([len(found)]))
            order.append(np.array([n]))
        if not words:
            self.pool.extend(np.zeros(0, np.uint32), np.zeros(len(pieces), np.int64))
            return
        at = np.empty(len(words), np.int64)
        at[np.concatenate(order)] = np.arange(len(words))
        numbers = at[np.array(flat, np.int64)]
        ends = np.concatenate([[0], np.cumsum(runs.sizes[numbers])])
        cuts = np.concatenate([[0], np.cumsum(counts)])
        self.pool.extend(runs.gather(numbers), np.diff(ends[cuts]))

    def all(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """(little-endian ids, decoded UTF-8) of each text."""
        flat, cuts = [], [0]
        for text in texts:
            for part in self.split.parts(text or ""):
                if part in self.added:
                    flat.append(part)
                elif any(c in part for c in "\x1c\x1d\x1e\x1f"):  # no white space for the vocabulary's normaliser
                    flat += filter(None, _SPACE.split(part))
                else:
                    flat += part.split()
            cuts.append(len(flat))
        if len(self.index) > self.KNOWN:
            self.forget()
        known = len(self.index)
        numbers = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        self.learn(list(itertools.islice(self.index, known, None)))
        ids = self.pool.gather(numbers)
        places = np.concatenate([[0], np.cumsum(self.pool.sizes[numbers])])[cuts].tolist()
        decoded = self.tokens.gather(ids).tobytes()
        letters = np.concatenate([[0], np.cumsum(self.tokens.sizes[ids])])[places].tolist()
        raw = ids.astype("<u4").tobytes()
        return [(raw[4 * a : 4 * b], decoded[c : max(c, d - 1)]) for a, b, c, d in zip(places, places[1:], letters, letters[1:], strict=False)]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Adds n_tokens, ids (little-endian 32-bit) and decoded (the ids decoded again) to every document.

    Ids are those of the tokenizers library without added special tokens; special strings in a text
    are single ids. Null and empty texts give no ids and ''. Rows are independent: repeated rows and null
    ids pass; of merges with equal rank the first place is taken. Very long texts, and very long words, are
    encoded whole. Columns with an output's name are replaced.
    """
    out = _run(docs, path, {"ids": "binary", "decoded": "string"}, lambda got: [pa.array([g[0] for g in got], pa.binary()), pa.array([g[1].decode() for g in got], pa.string())])
    return out.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def _run(docs: DataFrame, path: str, outputs: dict[str, str], made) -> DataFrame:
    held: dict[str, Codec] = {}

    def run(rows):
        if "codec" not in held:
            held["codec"] = Codec(path)
        texts = common.field(rows, "text").to_pylist()
        return made([x for i in range(0, len(texts), 1000) for x in held["codec"].all(texts[i : i + 1000])])

    return common.attach(docs, run, outputs)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """encode_decode's n_tokens with the SHA-256 of ids and of the decoded text, made in the worker."""

    def made(got):
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return [pa.array([len(g[0]) // 4 for g in got], pa.int64()), pa.array([sha(g[0]) for g in got]), pa.array([sha(g[1]) for g in got])]

    return _run(docs, path, {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}, made)


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, vocabulary_path("word_bpe_49k.json")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
