"""Queries over whole records: granularity, validation, quotas, batches, token labels, type maps, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from glossweave.functions import granularity as G
from glossweave.functions import python as P
from glossweave.functions import text as T
from glossweave.operators import core as C
from glossweave.operators import records as R
from glossweave.operators import sampling as S

from .queries import BOTH, BROKEN, FITS, GOLD, ONE, PRED, WINDOWS, broken_spans, docs, read, spans, with_spans
from .registry import query

_MONTH = G._MONTH
#: RE2 has no look-ahead, so what must not follow is taken out first.
_TAKE_OUT = {"Hour": r"\b(noon|midnight)\s+sharp\b", "Month": rf"\b{_MONTH}\s+{G._DAY_OF_MONTH}\b"}


def _category_sql(name: str) -> str:
    patterns = [p.split("(?!")[0] for p in G.LATIN[name]]
    text = f"regexp_replace(t, '{_TAKE_OUT[name]}', '#', 'g')" if name in _TAKE_OUT else "t"
    return f"""CASE WHEN regexp_matches({text}, '{"|".join(patterns).replace("'", "''")}') THEN '{name}' END"""


@query("granularity", f"""WITH m AS (SELECT doc_id, list_filter([{", ".join(map(_category_sql, G.LATIN))}], lambda x: x IS NOT NULL) AS m
  FROM (SELECT doc_id, lower(coalesce(text, '')) AS t FROM documents))
SELECT doc_id, coalesce(m[1], 'Day') AS granularity, len(m) > 1 AS ambiguous, array_to_string(m, ',') AS matched FROM m""")
def granularity(spark, d):
    got = docs(spark, d, G.granularity(F.col("text")).alias("g"))
    return got.select("doc_id", "g.granularity", "g.ambiguous", F.array_join("g.matched_categories", ",").alias("matched"))


# -- quotas and batches ---------------------------------------------------------------------------------------

LABELLED = "SELECT d.doc_id, d.source, lang, quality, n_chars FROM documents d LEFT JOIN labels USING (doc_id)"


def labelled(spark, d):
    return docs(spark, d, "lang", "source", "n_chars").join(read(spark, d, "labels"), "doc_id", "left")


def _greedy_sql(strata: str, each: str, n: int, fill: bool = False) -> str:
    """Strata (key, k: place in the visit) of rows (doc_id, key, o), visited one by one."""
    rest = f"UNION ALL SELECT doc_id, NULL AS stratum FROM (SELECT doc_id FROM b WHERE doc_id NOT IN (SELECT doc_id FROM done) ORDER BY o, doc_id LIMIT (SELECT {n} - count(*) FROM done))" if fill else ""
    return f"""{strata},
g(k, ids, own) AS (SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[]
  UNION ALL SELECT g.k + 1, list_concat(g.ids, x.own), x.own FROM g, LATERAL (SELECT list_filter(l, lambda i: NOT list_contains(g.ids, i))[1 : least({each}, {n} - len(g.ids))] AS own FROM v WHERE v.k = g.k + 1) x),
done AS (SELECT unnest(own) AS doc_id, k FROM g)
SELECT doc_id, v.key AS stratum FROM done JOIN v USING (k) {rest}"""


@query("qa_sample", "WITH RECURSIVE " + _greedy_sql(f"""b AS (SELECT *, sha256('42|' || doc_id) AS o FROM ({LABELLED})),
s AS (SELECT doc_id, o, unnest(list_distinct([lang || ':' || coalesce(quality::VARCHAR, 'none'), lang || ':' || CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END])) AS key FROM b),
v AS (SELECT key, row_number() OVER (ORDER BY key) AS k, list(doc_id ORDER BY o, doc_id) AS l FROM s GROUP BY key)""", "(SELECT greatest(1, 60 // count(*)) FROM v)", 60))
def qa_sample(spark, d):
    keys = F.array(F.concat_ws(":", "lang", F.coalesce(F.col("quality").cast("string"), F.lit("none"))), F.concat_ws(":", "lang", F.when(F.col("n_chars") > 2000, "long").otherwise("short")))
    return S.quota_sample(labelled(spark, d), keys, "doc_id", 60)


@query("review_sample", "WITH RECURSIVE " + _greedy_sql(f"""a AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, lang LIMIT 2),
b AS (SELECT *, sha256('42|' || doc_id) AS o FROM ({LABELLED})),
s AS (SELECT doc_id, o, lang || '|' || coalesce(quality::VARCHAR, 'none') || '|' || CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS key FROM b
  UNION ALL SELECT doc_id, o, 'top' FROM b WHERE lang IN (SELECT lang FROM a)),
v AS (SELECT key, row_number() OVER (ORDER BY count(*), key) AS k, list(doc_id ORDER BY o, doc_id) AS l FROM s GROUP BY key)""", "4", 100, True))
def review_sample(spark, d):
    rows = labelled(spark, d)
    top = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(2).select("lang", F.lit("top").alias("top"))
    key = F.concat_ws("|", "lang", F.coalesce(F.col("quality").cast("string"), F.lit("none")), F.when(F.col("n_chars") > 2000, "long").otherwise("short"))
    marked = rows.join(F.broadcast(top), "lang", "left")  # two rows
    return S.quota_sample(marked, F.array_compact(F.array(key, "top")), "doc_id", 100, each=4, by_size=True, fill=True)


@query("batch_pack", """WITH RECURSIVE r AS (SELECT doc_id, octet_length(encode(text)) AS size, row_number() OVER (ORDER BY octet_length(encode(text)), doc_id) AS k FROM documents WHERE octet_length(encode(text)) <= 12000),
g AS (SELECT 0::BIGINT AS k, 0::BIGINT AS doc_id, 0::BIGINT AS used, 0::BIGINT AS batch
  UNION ALL SELECT r.k, r.doc_id, CASE WHEN used + size > 8000 THEN size ELSE used + size END, CASE WHEN used + size > 8000 AND r.k > 1 THEN batch + 1 ELSE batch END FROM g JOIN r ON r.k = g.k + 1)
SELECT doc_id, 'normal' AS lot, batch FROM g WHERE k > 0
UNION ALL SELECT doc_id, CASE WHEN octet_length(encode(text)) <= 24000 THEN 'solo' ELSE 'skipped' END, NULL FROM documents WHERE octet_length(encode(text)) > 12000 OR text IS NULL""")
def batch_pack(spark, d):
    sized = docs(spark, d, F.octet_length("text").cast("long").alias("size"))
    return S.batches(sized, "doc_id", "size", 8000, 12000).select("doc_id", "lot", "batch")


@query("holdout_indices", """SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('42|' || lang || '|' || doc_id), doc_id) <= 5""")
def holdout_indices(spark, d):
    rows = docs(spark, d, "lang").withColumn("key", F.concat_ws("|", "lang", "doc_id"))
    order = T.hash_order(42, F.col("key"))
    return R.first_of_strata(rows, ["lang"], order, "doc_id", F.lit(5)).where("chosen").select("lang", "doc_id")


# -- labels, types, validation ----------------------------------------------------------------------------------


@query("label_conflicts", f"""{BOTH.replace("WITH", "WITH RECURSIVE", 1)},
e AS (SELECT doc_id, start, "end", type FROM gold UNION SELECT doc_id, start, "end", type FROM pred),
n AS (SELECT e.doc_id, e.start, e."end", e.type, min(i) AS a, max(i) + 1 AS b FROM e JOIN tok ON tok.doc_id = e.doc_id AND tok.start < e."end" AND tok.start + length(token) > e.start GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start, "end" DESC, type) AS k FROM n),
g AS (SELECT doc_id, k, type, a, b, true AS kept, b AS reach FROM r WHERE k = 1
  UNION ALL SELECT r.doc_id, r.k, r.type, r.a, r.b, r.a >= g.reach, CASE WHEN r.a >= g.reach THEN r.b ELSE g.reach END FROM g JOIN r ON r.doc_id = g.doc_id AND r.k = g.k + 1)
SELECT doc_id, type, a::INT AS first, b::INT AS last_end FROM g WHERE kept""")
def label_conflicts(spark, d):
    rows = with_spans(spark, d, g=GOLD, p=PRED)
    plain = lambda c: F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["type"].alias("type")))
    rows = rows.select("doc_id", F.split("text", " ").alias("tokens"), F.concat(plain("g"), plain("p")).alias("e")).where(F.size("e") > 0)
    labelled = rows.select("doc_id", F.explode(P.token_labels(F.col("tokens"), F.col("e.start"), F.col("e.end"), F.col("e.type"))).alias("x"))
    return labelled.select("doc_id", "x.type", "x.first", "x.last_end")


@query("retype_fallback", f"""{ONE}, m(k, v) AS (VALUES ('PERSON', 'PERSON'), ('PLACE', 'LOCATION'), ('ORG:Firm', 'ORG'))
SELECT t AS type, original, count(*) AS n FROM (SELECT CASE WHEN type = 'PERSON' THEN type ELSE coalesce(m1.v, m2.v) END AS t, original
  FROM (SELECT type, CASE WHEN type = 'ORG' THEN 'ORG:Firm' ELSE type END AS original FROM gold) g LEFT JOIN m m1 ON m1.k = g.type LEFT JOIN m m2 ON m2.k = g.original) WHERE t IS NOT NULL GROUP BY ALL""")
def retype_fallback(spark, d):
    pairs = F.create_map(*[F.lit(x) for x in ("PERSON", "PERSON", "PLACE", "LOCATION", "ORG:Firm", "ORG")])
    own = spans(spark, d, GOLD).withColumn("original", F.when(F.col("type") == "ORG", "ORG:Firm").otherwise(F.col("type")))
    kind = F.coalesce(F.when(F.col("type") == "PERSON", F.col("type")), F.element_at(pairs, F.col("type")), F.element_at(pairs, F.col("original")))
    return own.select(kind.alias("type"), "original").where("type IS NOT NULL").groupBy("type", "original").agg(F.count("*").alias("n"))


#: Passages with faults of every kind, in the wide form of records: by the number of the document.
FAULTS = {
    "schema_version": "CASE WHEN doc_id % 11 = 0 THEN '0.9' ELSE '1.0' END",
    "split": "CASE WHEN doc_id % 13 = 0 THEN 'other' ELSE 'train' END",
    "confidence": "CASE WHEN doc_id % 17 = 0 THEN 'bronze' ELSE 'gold' END",
    "holdout": "doc_id % 7 = 0",
}


@query("validate_records", f"""{ONE}{BROKEN}, c AS (SELECT doc_id, bool_or(e <= s) AS empty, bool_or(e > s AND NOT {FITS.format(a='s', b='e')}) AS differs, list_distinct(list(type)) AS kinds FROM b GROUP BY 1),
r AS (SELECT c.*, {", ".join(f"{v} AS {k}" for k, v in FAULTS.items())} FROM c)
SELECT doc_id, array_to_string(list_filter([CASE WHEN schema_version <> '1.0' THEN 'schema_version' END, CASE WHEN split = 'other' THEN 'split' END, CASE WHEN confidence = 'bronze' THEN 'confidence' END,
  CASE WHEN empty THEN 'empty_span' END, CASE WHEN differs THEN 'surface_differs' END, CASE WHEN list_contains(kinds, 'ORG') THEN 'type_not_asked' END,
  CASE WHEN 4 - len(kinds) < 2 THEN 'negatives_out_of_range' END, CASE WHEN holdout THEN 'holdout_negative' END], lambda x: x IS NOT NULL), ',') AS errors FROM r""")
def validate_records(spark, d):
    rows = broken_spans(spark, d).where(F.size("x") > 0).withColumns({k: F.expr(v) for k, v in FAULTS.items()})
    entities = F.transform("x", lambda x: F.struct(x["surface"].alias("surface"), x["type"].alias("type"), x["s"].alias("start"), x["e"].alias("end")))
    asked = F.array(*map(F.lit, ("PERSON", "PLACE", "DATE", "EVENT")))
    records = rows.select("doc_id", "schema_version", "split", "confidence", F.array(F.lit("documents")).alias("provenance"), "text", asked.alias("query_types"), entities.alias("entities"), "holdout")
    holdouts = F.when(F.col("holdout"), F.array(F.lit("DATE"))).otherwise(F.array().cast("array<string>"))
    return records.select("doc_id", F.array_join(C.record_errors(holdouts), ",").alias("errors"))


@query("validate_conversations", f"""WITH {WINDOWS}, x AS (SELECT conv_id, s // 2 AS w, t[s + 1 : s + 4] AS win FROM w)
SELECT conv_id, w::INT AS w, array_to_string(list_filter([CASE WHEN len(win) < 2 THEN 'too_few_turns' END, CASE WHEN conv_id % 5 = 0 THEN 'turn_out_of_range' WHEN length(win[1].text) < 3 THEN 'surface_differs' END], lambda e: e IS NOT NULL), ',') AS errors FROM x""")
def validate_conversations(spark, d):
    """Windows as conversation records with one entity, the first three letters; of some its turn is out of range."""
    rows = C.turn_windows(C.gather_turns(read(spark, d, "conversations")))
    turn = F.when(F.col("conv_id") % 5 == 0, F.lit(9)).otherwise(0)
    entity = F.struct(F.substring(F.col("window")[0]["text"], 1, 3).alias("surface"), F.lit("PERSON").alias("type"), F.lit(0).alias("start"), F.lit(3).alias("end"), turn.cast("int").alias("turn_index"))
    fixed = {"schema_version": F.lit("1.0"), "split": F.lit("train"), "confidence": F.lit("silver"), "provenance": F.array(F.lit("c")), "turns": F.col("window"), "query_types": F.array(*map(F.lit, ("PERSON", "PLACE", "DATE"))), "entities": F.array(entity)}
    return rows.withColumns(fixed).select("conv_id", "w", F.array_join(C.conversation_errors(), ",").alias("errors"))


@query("duplicate_record_ids", "SELECT source, doc_id % 500 AS source_id, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1")
def duplicate_record_ids(spark, d):
    rows = docs(spark, d, "source").select("source", (F.col("doc_id") % 500).alias("source_id"))
    return rows.groupBy("source", "source_id").agg(F.count("*").alias("n")).where("n > 1")


@query("sequence_ids", """SELECT turn, CASE WHEN k > 0 THEN conv_id || '_' || k ELSE conv_id::VARCHAR END AS conv_id FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS k FROM conversations)""")
def sequence_ids(spark, d):
    return C.numbered_ids(read(spark, d, "conversations").select("conv_id", "turn"), "conv_id", "turn")


@query("required_coverage", f"""{ONE}, need(name) AS (VALUES ('PERSON'), ('PLACE'), ('EVENT')), have AS (SELECT DISTINCT type FROM gold)
SELECT coalesce(name, type) AS name, CASE WHEN type IS NULL THEN 'missing' WHEN name IS NULL THEN 'not required' ELSE 'covered' END AS state FROM need FULL JOIN have ON name = type""")
def required_coverage(spark, d):
    need = spark.createDataFrame([("PERSON",), ("PLACE",), ("EVENT",)], "name string").withColumn("needed", F.lit(1))
    have = spans(spark, d, GOLD).select(F.col("type").alias("name")).distinct().withColumn("present", F.lit(1))
    state = F.when(F.col("present").isNull(), "missing").when(F.col("needed").isNull(), "not required").otherwise("covered")
    return need.join(have, "name", "full").select("name", state.alias("state"))


@query("context_windows", f"""{ONE} SELECT doc_id, start, md5(substring(text, (greatest(0, start - 50) + 1)::INT, ("end" + 50 - greatest(0, start - 50))::INT)) AS digest FROM gold JOIN documents USING (doc_id)""")
def context_windows(spark, d):
    around = P.span_contexts(F.col("text"), F.col("x.start"), F.col("x.end"), 50)
    rows = with_spans(spark, d, x=GOLD).select("doc_id", F.explode(F.arrays_zip(F.col("x.start").cast("array<bigint>").alias("start"), around.alias("c"))).alias("z"))
    return rows.select("doc_id", "z.start", F.md5("z.c").alias("digest"))


@query("running_best", """SELECT event_id, event_type, value > coalesce(max(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '-infinity'::DOUBLE) AS keep FROM events""")
def running_best(spark, d):
    """The best of all earlier days, and of the day so far, so that no type of event is one task's."""
    rows = read(spark, d, "events").withColumn("day", F.to_date("ts"))
    days = rows.groupBy("event_type", "day").agg(F.max("value").alias("most"))
    days = days.withColumn("past", F.expr("max(most) OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"))
    today = F.expr("max(value) OVER (PARTITION BY event_type, day ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    met = rows.withColumn("today", today).join(days.drop("most"), ["event_type", "day"])
    return met.select("event_id", "event_type", (F.col("value") > F.coalesce(F.greatest("past", "today"), F.lit(float("-inf")))).alias("keep"))


@query("report_markdown", """WITH c AS (SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1)
SELECT 0 AS n, '| lang | n | chars |' AS line UNION ALL SELECT 1, '|---|---|---|' UNION ALL SELECT (row_number() OVER (ORDER BY lang) + 1)::INT, '| ' || coalesce(lang, '') || ' | ' || n || ' | ' || chars || ' |' FROM c""")
def report_markdown(spark, d):
    stats = docs(spark, d, "lang", "n_chars").groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    return C.markdown_table(stats, ["lang"])
