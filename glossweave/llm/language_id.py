"""Language identification with string kernels.

The kernel of two texts is the cosine of the sets of character n-grams (blended spectrum: lengths 1 to 3)
present in them. Nystroem landmarks, a few labelled texts, turn a text into kernel values; a ridge
regression for each language, one against the rest, gives its scores. All of it is linear in the
n-grams present, so a text's scores are sums of the weights of its n-grams.
"""

from __future__ import annotations

import functools
import sys
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Labelled texts that the model is fitted on, whole (about; drawn by a hash, evenly from the languages),
#: landmarks among them, and the ridge.
SAMPLE, LANDMARKS, RIDGE = 2000, 160, 1e-2
#: Texts (about) and landmarks of each language, where many languages would leave it fewer.
LEAST_TEXTS, LEAST_LANDMARKS = 20, 3
UNKNOWN = "und"
#: Symbols of n-grams are lower-cased code points of 21 bits; 1, no letter itself, stands for what is none.
_BITS, _BLANK = 21, 1


@functools.cache
def _letters() -> np.ndarray:
    """The symbol of each code point: letters and the marks on them (vowel signs, say) count, in lower case."""
    table = np.full(sys.maxunicode + 1, _BLANK, np.int64)
    for cp in range(sys.maxunicode + 1):
        if (c := chr(cp)).isalpha() or unicodedata.category(c)[0] == "M":
            table[cp] = ord(c.lower()[0])
    return table


def _distinct(ordered: np.ndarray) -> np.ndarray:
    return ordered[np.diff(ordered, prepend=-1) > 0]


def grams(text: str) -> np.ndarray:
    """Sorted codes of the n-grams in a text; runs of other characters are one blank, so word ends count.

    Shorter n-grams are the heads of longer ones, so only the longest are sorted; two zeros let the last letters be heads.
    """
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = (c != _BLANK) | (np.concatenate([[0], c[:-1]]) != _BLANK)
    c = np.concatenate([[_BLANK], c[keep], [_BLANK, 0, 0]])
    three = _distinct(np.sort((c[:-2] << 2 * _BITS) | (c[1:-1] << _BITS) | c[2:]))
    two = _distinct(three >> _BITS)
    codes = np.concatenate([_distinct(two >> _BITS), two, three])
    return codes[codes & ((1 << _BITS) - 1) > 0]


def _sums(known: np.ndarray, table: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The sum of the table's rows over a text's known n-grams, divided by the root of all n-grams present."""
    if not len(known):
        return np.zeros(table.shape[1], np.float32)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return table[at[known[at] == own]].sum(0) / np.sqrt(max(1, len(own)), dtype=np.float32)


class Landmarks:
    """The n-grams of the landmark texts; kernels(text) are its kernel values with them."""

    def __init__(self, codes: list[np.ndarray]):
        self.known = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
        self.table = np.zeros((len(self.known), len(codes)), np.float32)
        for j, own in enumerate(codes):
            self.table[np.searchsorted(self.known, own), j] = 1 / np.sqrt(max(1, len(own)))

    def kernels(self, text: str) -> np.ndarray:
        return _sums(self.known, self.table, grams(text))


def chosen(langs: list[str]) -> list[int]:
    """The places of the landmarks: the first texts of each language in turn."""
    turns: dict[str, int] = {}
    spread = []
    for i, lang in enumerate(langs):
        turns[lang] = turns.get(lang, -1) + 1
        spread.append((turns[lang], lang, i))
    return [i for *_, i in sorted(spread)[: max(LANDMARKS, LEAST_LANDMARKS * len(turns))]]


class Model:
    """Landmarks' n-grams and their weights for each language."""

    def __init__(self, landmarks: Landmarks, kernels: np.ndarray, langs: list[str]):
        """kernels: the landmarks' values of all training texts, whose languages langs has; the landmarks are chosen(langs)."""
        self.langs, self.known = sorted(set(langs)), landmarks.known
        if not langs:
            return
        own = kernels.astype(np.float64)
        core = own[chosen(langs)]
        values, vectors = np.linalg.eigh((core + core.T) / 2)
        good = values > 1e-6 * values.max()
        root = vectors[:, good] / np.sqrt(values[good])  # kernel values -> coordinates
        x = np.hstack([own @ root, np.ones((len(langs), 1))])
        place = {k: n for n, k in enumerate(self.langs)}
        number = np.array([place[k] for k in langs])
        target = np.where(number[:, None] == np.arange(len(self.langs)), 1.0, -1.0)
        weight = 1.0 / np.bincount(number)[number]  # each language weighs the same
        w = np.linalg.solve((x * weight[:, None]).T @ x + RIDGE / len(langs) * np.eye(x.shape[1]), (x * weight[:, None]).T @ target)
        # kernel values are sums over n-grams, so their weights are too
        self.weights, self.bias = landmarks.table @ (root @ w[:-1]).astype(np.float32), w[-1].astype(np.float32)

    @classmethod
    def of(cls, texts: list[str], langs: list[str]) -> Model:
        landmarks = Landmarks([grams(texts[i]) for i in chosen(langs)])
        return cls(landmarks, np.array([landmarks.kernels(t) for t in texts]), langs)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Languages and scores; a text without a letter, or without a model, is UNKNOWN with 0."""
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        able = [i for i, t in enumerate(texts) if t and self.langs and any(map(str.isalpha, t))]
        for i in able:
            row = _sums(self.known, self.weights, grams(texts[i])) + self.bias
            best = int(row.argmax())
            odds = np.exp(4 * (row - row.max()).astype(np.float64))
            langs[i], scores[i] = self.langs[best], float(odds[best] / odds.sum())
        return langs, scores


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of all languages of (text, lang) rows with neither null, from a sample of about `sample` whole texts.

    With many languages the sample grows, so that each has about LEAST_TEXTS texts, or all that it has. The
    texts stay with the executors: the landmarks' distinct n-grams and one row of kernel values for each
    text reach the driver. Equal rows count once; ties have no say, as texts are taken in order of a hash.
    """
    spark = labelled.sparkSession
    hashed = labelled.select("lang", F.xxhash64("text").alias("x"))
    counts = hashed.groupBy("lang").agg(F.countDistinct("x").alias("n")).orderBy("lang").collect()
    if not counts:
        return Model(Landmarks([]), np.zeros((0, 0)), [])
    each = max(LEAST_TEXTS, sample // len(counts))
    shares = spark.createDataFrame([(r["lang"], min(1.0, each / r["n"])) for r in counts], "lang string, share double")
    drawn = F.pmod(F.col("x"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
    # copies of one text hash alike, so equal rows are dropped and only about `each` of a language are left
    rows = labelled.withColumn("x", F.xxhash64("text")).join(F.broadcast(shares), "lang").where(drawn)
    rows = common.cut(rows.select("x", "lang", "text").dropDuplicates(["x", "lang"]))
    listed = sorted((r["x"], r["lang"]) for r in rows.select("x", "lang").collect())
    langs = [lang for _, lang in listed]
    heads = [listed[i] for i in chosen(langs)]
    of_heads = rows.join(F.broadcast(spark.createDataFrame(heads, "x bigint, lang string")), ["x", "lang"], "left_semi")
    codes = {(r["x"], r["lang"]): np.array(r["v"], np.int64) for r in _mapped(of_heads, grams, "bigint").collect()}
    held = spark.sparkContext.broadcast(Landmarks([codes[h] for h in heads]))
    kernels = {(r["x"], r["lang"]): r["v"] for r in _mapped(rows, lambda t: held.value.kernels(t), "float").collect()}
    return Model(held.value, np.array([kernels[r] for r in listed]), langs)


def _mapped(rows: DataFrame, fn, kind: str) -> DataFrame:
    """(x, lang, v): what fn makes of each text, an array."""

    def run(batches):
        for batch in batches:
            made = [fn(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.list_({"bigint": pa.int64(), "float": pa.float32()}[kind]))], ["x", "lang", "v"])

    return rows.select("x", "lang", "text").mapInArrow(run, f"x bigint, lang string, v array<{kind}>")


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds lang_pred and score (0 to 1) to every document, from the whole text alone.

    Null and empty texts, and those without a letter, get `und` and 0. Rows are independent of each other:
    null ids and repeated rows pass. Of languages with equal scores the first by name is taken. Very long texts
    count whole. Columns with an output's name are replaced. The model, weights for the landmarks' n-grams, is broadcast.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        langs, scores = held.value.predict(common.field(rows, "text").to_pylist())
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

    return common.attach(docs, run, {"lang_pred": "string", "score": "double"})


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = fit(docs.where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang"))
    return predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
