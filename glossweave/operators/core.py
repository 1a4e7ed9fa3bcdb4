"""Relational operators over records, spans, turns and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossweave.functions import python as P
from glossweave.functions import text as T
from glossweave.functions import vocabulary as V

# -- dedup and split ---------------------------------------------------------------------------------


def record_text(text: Column, turns: Column | None = None) -> Column:
    """A record's text; of a conversation, the texts of its turns, one a line."""
    return text if turns is None else F.coalesce(text, F.array_join(F.transform(turns, lambda t: t["text"]), "\n"))


def with_hash(records: DataFrame, text: str | Column = "text") -> DataFrame:
    """Adds text_hash, the SHA-256 of the text's NFKC form; null for null."""
    return records.withColumn("text_hash", F.sha2(P.nfkc(F.col(text) if isinstance(text, str) else text), 256))


def keep_first(records: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, by an aggregate that combines before the shuffle."""
    rest = [c for c in records.columns if c not in key]
    picked = records.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*key, "_r.*")


def merge_duplicates(records: DataFrame, order: str) -> DataFrame:
    """One row for each text hash: the earliest id, the sources in order of appearance, the best tier, the size."""
    seen = F.array_sort(F.collect_list(F.struct(F.col(order), F.col("source"))))
    return records.groupBy("text_hash").agg(
        F.min(order).alias("base_id"),
        F.array_join(F.array_distinct(F.transform(seen, lambda x: x["source"])), ",").alias("provenance"),
        F.min("tier").alias("best_tier"),
        F.count("*").alias("n"),
    )


def stratified_split(records: DataFrame, strata: list[str], order: str, share: float = 0.05, seed: int | None = None) -> DataFrame:
    """Of a stratum of n > 2 rows the first max(1, floor(n * share)) in order are val, all others train.

    order is a hash in hex, or, with a seed, any column, whose hash with the seed is taken.
    """
    from .records import first_of_strata

    quota = F.when(F.col("n") > 2, F.greatest(F.lit(1), F.floor(F.col("n") * share))).otherwise(0)
    by = F.col(order) if seed is None else T.hash_order(seed, F.col(order).cast("string"))
    marked = first_of_strata(records, strata, by, order, quota)
    return marked.select(*records.columns, F.when(F.col("chosen"), "val").otherwise("train").alias("split"))


# -- tokens, tags, spans ------------------------------------------------------------------------------


def tokens(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, i, token, start): the text cut at blanks, with code point offsets, made within the row."""
    cut = docs.select(key, F.split(text, " ").alias("_t")).withColumn("_s", P.token_starts(F.col("_t")))
    return cut.select(key, F.posexplode(F.arrays_zip("_t", "_s")).alias("i", "x")).select(key, "i", F.col("x._t").alias("token"), F.col("x._s").alias("start"))


def bio_islands(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """Spans (key, type, first, last_end, start, end) of BIO tags; an I of another type, or after no span, opens one."""
    kind = F.when(F.col("tag").rlike("^[BI]-"), F.substring("tag", 3, 100))
    order = Window.partitionBy(key).orderBy("i")
    opens = kind.isNotNull() & (F.col("tag").startswith("B-") | ~F.lag(kind).over(order).eqNullSafe(kind))
    marked = tagged.withColumns({"type": kind, "opens": opens.cast("int")})
    marked = marked.withColumn("island", F.sum("opens").over(order)).where("type IS NOT NULL")
    return (
        marked.groupBy(key, "island", "type")
        .agg(F.min("i").alias("first"), (F.max("i") + 1).alias("last_end"), F.min("start").alias("start"), F.max(F.col("start") + F.length("token")).alias("end"))
        .drop("island")
    )


def io_islands(tagged: DataFrame, key: str = "doc_id") -> DataFrame:
    """Spans of tags without B: neighbours of one type are one span."""
    kind = F.when(F.col("tag") != "O", F.substring("tag", 3, 100))
    return bio_islands(tagged.withColumn("tag", F.when(kind.isNotNull(), F.concat(F.lit("I-"), kind)).otherwise("O")), key)


def valid_span(text: Column, surface: Column, start: Column, end: Column) -> Column:
    inside = (start >= 0) & (end > start) & (end <= F.length(text))
    return F.coalesce(inside & (F.substring(text, start + 1, end - start) == surface), F.lit(False))


def shifted_span(text: Column, surface: Column, start: Column, end: Column) -> Column:
    """The shift (d_start, d_end) of the first of the five readings that fits; null if none does."""
    out = F
    for a, b in P.READINGS:
        out = out.when(valid_span(text, surface, start + a, end + b), F.struct(F.lit(a).alias("d_start"), F.lit(b).alias("d_end")))
    return out


def occurrences(text: Column, surface: Column) -> Column:
    """Starts of all places of a surface, overlapping ones too (code points)."""
    places = F.sequence(F.lit(0), F.length(text) - F.length(surface))
    found = F.filter(places, lambda i: F.substring(text, i + 1, F.length(surface)) == surface)
    return F.when((F.length(surface) > 0) & (F.length(text) >= F.length(surface)), found).otherwise(F.array().cast("array<int>"))


def nearest_place(text: Column, surface: Column, hint: Column) -> Column:
    """The start nearest to the hint, the first of equals; null if the surface doesn't occur."""
    return F.element_at(F.array_sort(F.transform(occurrences(text, surface), lambda s: F.struct(F.abs(s - hint).alias("d"), s.alias("s")))), 1)["s"]


# -- conversations -------------------------------------------------------------------------------------


def gather_turns(turns: DataFrame) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("turn", F.col("role").alias("speaker"), "text")))
    return turns.groupBy("conv_id").agg(listed.alias("turns"))


def turn_windows(conversations: DataFrame, size: int = 4, stride: int = 2) -> DataFrame:
    """Rows (conv_id, w, n_windows, window): sliding windows; up to `size` turns are one window."""
    n = F.size("turns")
    starts = F.when(n <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), stride * F.ceil((n - size) / stride).cast("int"), F.lit(stride)))
    cut = conversations.withColumn("_w", F.transform(starts, lambda s: F.slice("turns", s + 1, size)))
    return cut.select("conv_id", F.size("_w").alias("n_windows"), F.posexplode("_w").alias("w", "window"))


def flatten_turns(conversations: DataFrame) -> DataFrame:
    """The text of `speaker: text` lines, and the offset at which each turn's own text starts in it."""
    line = lambda t: F.concat(t["speaker"], F.lit(": "), t["text"])
    text = F.array_join(F.transform("turns", line), "\n")
    start = lambda t, i: F.aggregate(F.slice("turns", 1, i), F.lit(0), lambda a, x: a + F.length(line(x)) + 1) + F.length(t["speaker"]) + 2
    return conversations.select("conv_id", text.alias("text"), F.transform("turns", start).alias("offsets"))


# -- backfills ------------------------------------------------------------------------------------------


def same_key(left: str, right: str, key: list[str]) -> Column:
    """All parts of a key are equal, two nulls too."""
    out = F.lit(True)
    for c in key:
        out &= F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def apply_backfill(entities: DataFrame, fills: DataFrame, key: list[str], least: float = 0.7, generic: bool = False) -> DataFrame:
    """Entities with the new type of the backfill that has their key, if it is sure enough and (unless asked
    for) not generic. Every entity stays, once: of several backfills of one key the last type by name counts."""
    fine = F.col("conf") >= least
    once = fills.where(fine if generic else fine & ~F.coalesce("generic", F.lit(False))).groupBy(*key).agg(F.max("new_type").alias("new_type"))
    joined = entities.alias("a").join(once.alias("b"), same_key("a", "b", key), "left")
    return joined.select("a.*", F.coalesce("b.new_type", "a.type").alias("_type")).drop("type").withColumnRenamed("_type", "type")


# -- containment -----------------------------------------------------------------------------------------

#: Bytes of items that one automaton holds; more items take several passes over the documents.
AUTOMATON = 32 << 20


def containing(docs: DataFrame, items: DataFrame, id: str, text: str = "text") -> DataFrame:
    """Rows (id, n): in how many documents an item's text occurs; items that occur nowhere have none.

    The items, whose size is measured first, are broadcast in blocks as an automaton that reads each document
    once; counts are summed in the task. Null items and documents take no part; the empty item is in every other.
    """
    import ahocorasick
    import pyarrow as pa

    size = items.agg(F.coalesce(F.sum(F.octet_length(text) + 64), F.lit(0))).first()[0]
    blocks, kind = max(1, -(-size // AUTOMATON)), dict(items.dtypes)[id]
    out = None
    for block in range(blocks):
        own = items.where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(text), F.lit(blocks)) == block)).select(id, text).collect()
        held = docs.sparkSession.sparkContext.broadcast(sorted({r[1] for r in own}))

        def count(batches, held=held):
            words, tally = held.value, {}
            automaton = ahocorasick.Automaton()
            for n, w in enumerate(words):
                if w:
                    automaton.add_word(w, n)
            automaton.make_automaton()
            for batch in batches:
                for body in batch.column(0).to_pylist():
                    if body is not None:
                        found = {n for _, n in automaton.iter(body)} if len(automaton) else set()
                        for n in found | ({0} if words and not words[0] else set()):
                            tally[n] = tally.get(n, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([words[n] for n in tally], pa.string()), pa.array(list(tally.values()), pa.int64())], ["_text", "_n"])

        found = docs.select(text).mapInArrow(count, "_text string, _n bigint").groupBy("_text").agg(F.sum("_n").alias("n"))
        found = docs.sparkSession.createDataFrame(own, f"`{id}` {kind}, _text string").join(found, "_text").select(id, "n")
        out = found if out is None else out.union(found)
    return out


# -- types ------------------------------------------------------------------------------------------------


def chat_rows(records: DataFrame) -> DataFrame:
    """One row for each query type: the surfaces of that type in entity order, as a JSON list."""
    asked = records.select("*", F.explode("query_types").alias("query_type"))
    own = F.filter("entities", lambda e: e["type"] == F.col("query_type"))
    return asked.withColumn("answer", F.to_json(F.transform(own, lambda e: e["surface"]))).drop("query_types", "entities")


# -- sampling ---------------------------------------------------------------------------------------------


def largest_remainder(weights: DataFrame, total: int) -> DataFrame:
    """Whole shares of a total in proportion to weight; what is left goes to the largest remainders."""
    every = Window.partitionBy(F.lit(0))
    exact = F.col("weight") * total / F.sum("weight").over(every)
    out = weights.withColumn("_floor", F.floor(exact)).withColumn("_rest", exact - F.col("_floor"))
    rank = F.row_number().over(every.orderBy(F.desc(F.round("_rest", 9)), "name"))
    left = F.lit(total) - F.sum("_floor").over(every)
    return out.withColumn("n", (F.col("_floor") + (rank <= left).cast("int")).cast("long")).drop("_floor", "_rest")


# -- metrics ------------------------------------------------------------------------------------------------


def matched(gold: DataFrame, pred: DataFrame, key: list[str]) -> DataFrame:
    """(type, tp, fp, fn) of distinct spans; each side is marked and grouped once, so no join is needed."""
    marked = gold.select(*key, F.lit(1).alias("g"), F.lit(0).alias("p")).union(pred.select(*key, F.lit(0), F.lit(1)))
    spans = marked.groupBy(*key).agg(F.max("g").alias("g"), F.max("p").alias("p"))
    return spans.groupBy("type").agg(F.sum(F.col("g") * F.col("p")).alias("tp"), F.sum((1 - F.col("g")) * F.col("p")).alias("fp"), F.sum(F.col("g") * (1 - F.col("p"))).alias("fn"))


def with_prf(counts: DataFrame) -> DataFrame:
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.withColumns({"precision": p, "recall": r}).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


# -- labels, validation, reports ------------------------------------------------------------------------------


def numbered_ids(rows: DataFrame, id: str, order: str) -> DataFrame:
    """The second and later rows of an id get a suffix: _1, _2 and so on, in the given order."""
    k = F.row_number().over(Window.partitionBy(id).orderBy(order)) - 1
    return rows.withColumn("_k", k).withColumn(id, F.when(F.col("_k") > 0, F.concat(F.col(id).cast("string"), F.lit("_"), F.col("_k"))).otherwise(F.col(id).cast("string"))).drop("_k")


def _named(rules: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), name) for name, broken in rules.items()]))


def _common_rules(holdouts: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """Rules of all records that come before and after those of their spans."""
    entities, asked = F.col("entities"), F.col("query_types")
    positive = F.array_distinct(F.transform(entities, lambda e: e["type"]))
    spare = F.size(asked) - F.size(positive)
    return {
        "schema_version": ~F.col("schema_version").eqNullSafe("1.0"),
        "split": ~F.coalesce(F.col("split").isin(V.SPLITS), F.lit(False)),
        "confidence": ~F.coalesce(F.col("confidence").isin(list(V.CONFIDENCE_RANK)), F.lit(False)),
        "no_provenance": F.coalesce(F.size("provenance"), F.lit(0)) < 1,
        "no_query_types": F.coalesce(F.size(asked), F.lit(0)) < 1,
        "query_types_repeat": F.size(F.array_distinct(asked)) < F.size(asked),
        "empty_span": F.exists(entities, lambda e: e["end"] <= e["start"]),
    }, {
        "type_not_asked": F.size(F.array_except(positive, asked)) > 0,
        "negatives_out_of_range": (spare < 2) | (spare > 5),
        "holdout_negative": F.size(F.array_intersect(F.array_except(asked, positive), holdouts)) > 0,
    }


def _none() -> Column:
    return F.array().cast("array<string>")


def record_errors(holdouts: Column | None = None) -> Column:
    """The names of the rules that a passage record (columns as in sources.readers.RECORD) breaks.

    holdouts: types that must not be asked for as negatives.
    """
    before, after = _common_rules(_none() if holdouts is None else holdouts)
    surfaces, starts, ends = (F.col(f"entities.{n}") for n in ("surface", "start", "end"))
    fits = P.span_fits(F.col("text"), surfaces, starts, ends)
    differs = F.exists(F.arrays_zip(fits.alias("f"), starts.alias("a"), ends.alias("b")), lambda x: (x["b"] > x["a"]) & ~x["f"])
    return _named({**before, "no_text": F.coalesce(F.length("text"), F.lit(0)) == 0, "surface_differs": differs, **after})


def conversation_errors(holdouts: Column | None = None, most: int | None = 4) -> Column:
    """The same for a conversation record: 2 to `most` turns (None: no upper bound) with speaker and text, and
    entities whose turn there is and whose offsets count in its text."""
    before, after = _common_rules(_none() if holdouts is None else holdouts)
    n = F.coalesce(F.size("turns"), F.lit(0))
    blank = lambda c: F.coalesce(F.length(c), F.lit(0)) == 0
    there = lambda e: (e["turn_index"] >= 0) & (e["turn_index"] < n)
    fits = lambda e: valid_span(F.get(F.col("turns"), e["turn_index"])["text"], e["surface"], e["start"], e["end"])
    own = {
        "too_few_turns": n < 2,
        "too_many_turns": n > (1 << 30 if most is None else most),
        "blank_turn": F.exists("turns", lambda t: blank(t["speaker"]) | blank(t["text"])),
        "turn_out_of_range": F.exists("entities", lambda e: ~F.coalesce(there(e), F.lit(False))),
        "surface_differs": F.exists("entities", lambda e: (e["end"] > e["start"]) & there(e) & ~fits(e)),
    }
    return _named({**before, **own, **after})


def markdown_table(rows: DataFrame, order: list[str]) -> DataFrame:
    """Lines (n, line) of a report: head, rule, and one for each row in order. For aggregates, which are small."""
    head = [(0, "| " + " | ".join(rows.columns) + " |"), (1, "|" + "---|" * len(rows.columns))]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns]
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    body = rows.select((F.row_number().over(Window.orderBy(*order)) + 1).alias("n"), line.alias("line"))
    return rows.sparkSession.createDataFrame(head, "n int, line string").union(body)
