"""The registered queries: operators applied to the test tables, each with its SQL."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from glossweave.functions import python as P
from glossweave.functions import text as T
from glossweave.functions import vocabulary as V
from glossweave.operators import core as C
from glossweave.operators import records as R

from .registry import query

GOLD, PRED = 8, 9


def read(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def docs(spark, d, *columns):
    return read(spark, d, "documents").select("doc_id", *columns)


TAGGED = ["PERSON", "PLACE", "ORG"]


def tag(token, least: int):
    """Tags by rule: an upper-case initial begins a span, a long token goes on; the type follows the length."""
    kind = F.element_at(F.array(*map(F.lit, TAGGED)), (F.length(token) % 3 + 1).cast("int"))
    return F.when(token.rlike("^[A-Z]"), F.concat(F.lit("B-"), kind)).when(F.length(token) >= least, F.concat(F.lit("I-"), kind)).otherwise("O")


def tag_codes(tokens: pa.Array, least: np.ndarray) -> np.ndarray:
    """The same tags as numbers: 2 k for B and 2 k + 1 for I of TAGGED[k], -1 for O."""
    length = np.asarray(pc.utf8_length(tokens)).astype(np.int64)
    initial = np.asarray(pc.and_(pc.greater_equal(tokens, "A"), pc.less(tokens, "[")))  # the first byte is one of A to Z
    return np.where(initial, length % 3 * 2, np.where(length >= least, length % 3 * 2 + 1, -1))


def tagged(spark, d, least: int, text: str = "text"):
    return C.tokens(docs(spark, d, text), text=text).withColumn("tag", tag(F.col("token"), least))


#: Bytes below which a table may lie in one row group, which one task would read.
SMALL = 1 << 30


def spread(rows, key: str):
    """A small table of few files dealt to all cores; others have row groups enough, and are read as they lie."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < SMALL and len(rows.inputFiles()) < cores:
        return rows.repartition(cores, key)
    return rows


def with_spans(spark, d, *columns, **sides):
    """The documents with an array of spans for each name in sides, whose value is the tags' least length (also a column)."""
    rows = spread(docs(spark, d, "text", *columns), "doc_id")
    return rows.withColumns({name: P.text_spans(F.col("text"), F.lit(least) if isinstance(least, int) else least, tag_codes, TAGGED) for name, least in sides.items()})


def spans(spark, d, least: int):
    got = with_spans(spark, d, s=least).select("doc_id", F.explode("s").alias("x"))
    return got.select("doc_id", "x.type", F.col("x.start").cast("long").alias("start"), F.col("x.end").cast("long").alias("end"), "x.surface")


TOKENS = """tok AS (
  SELECT doc_id, i - 1 AS i, token, coalesce(sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token, unnest(generate_series(1, len(string_split(text, ' ')))) AS i FROM documents))"""


def span_sql(least: int, name: str) -> str:
    """The same tags and islands in SQL, as CTEs of the given name; needs TOKENS."""
    return f"""{name}_tag AS (SELECT *, CASE WHEN regexp_matches(token, '^[A-Z]') THEN 'B-' || k WHEN length(token) >= {least} THEN 'I-' || k ELSE 'O' END AS tag
  FROM (SELECT *, ['PERSON', 'PLACE', 'ORG'][length(token) % 3 + 1] AS k FROM tok)),
{name}_open AS (SELECT *, CASE WHEN tag <> 'O' AND (tag LIKE 'B-%' OR lag(ty) OVER w IS DISTINCT FROM ty) THEN 1 ELSE 0 END AS o
  FROM (SELECT *, CASE WHEN tag <> 'O' THEN tag[3:] END AS ty FROM {name}_tag) WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
{name} AS (SELECT doc_id, ty AS type, min(i) AS first, max(i) + 1 AS last_end, min(start) AS start, max(start + length(token)) AS "end"
  FROM (SELECT *, sum(o) OVER (PARTITION BY doc_id ORDER BY i) AS isl FROM {name}_open) WHERE ty IS NOT NULL GROUP BY doc_id, isl, ty)"""


BOTH = f"WITH {TOKENS}, {span_sql(GOLD, 'gold')}, {span_sql(PRED, 'pred')}"
ONE = f"WITH {TOKENS}, {span_sql(GOLD, 'gold')}"

# -- dedup and split ---------------------------------------------------------------------------------


@query("dedup_split_summary", """
WITH h AS (SELECT *, sha256(text) AS th FROM documents),
k AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY th ORDER BY doc_id) = 1),
s AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY lang, source) > 2 AND row_number() OVER (PARTITION BY lang, source ORDER BY th)
  <= greatest(1, floor(count(*) OVER (PARTITION BY lang, source) * 0.05)) THEN 'val' ELSE 'train' END AS split FROM k)
SELECT lang, split, count(*) AS n FROM s GROUP BY ALL""")
def dedup_split_summary(spark, d):
    kept = C.keep_first(C.with_hash(docs(spark, d, "text", "lang", "source")).drop("text"), ["text_hash"], ["doc_id"])
    return C.stratified_split(kept, ["lang", "source"], "text_hash").groupBy("lang", "split").agg(F.count("*").alias("n"))


@query("dedup_merge_provenance", """
WITH r AS (SELECT d.doc_id, sha256(text) AS text_hash, source, CASE WHEN quality = 1 AND toxic = 0 THEN 0 WHEN quality = 1 THEN 1 WHEN quality = 0 THEN 2 ELSE 3 END AS tier
  FROM documents d LEFT JOIN labels USING (doc_id)),
f AS (SELECT text_hash, source, min(doc_id) AS f FROM r GROUP BY ALL)
SELECT text_hash, min(doc_id) AS base_id, any_value(p) AS provenance, min(tier) AS best_tier, count(*) AS n
FROM r JOIN (SELECT text_hash, string_agg(source, ',' ORDER BY f) AS p FROM f GROUP BY 1) USING (text_hash) GROUP BY text_hash HAVING count(*) > 1""")
def dedup_merge_provenance(spark, d):
    tier = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 0).when(F.col("quality") == 1, 1).when(F.col("quality") == 0, 2).otherwise(3)
    rows = C.with_hash(docs(spark, d, "text", "source")).drop("text").join(read(spark, d, "labels"), "doc_id", "left").withColumn("tier", tier)
    return C.merge_duplicates(rows, "doc_id").where("n > 1")


@query("keep_richest_by_id", """
SELECT role, turn, conv_id, length(text) AS len FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) = 1""")
def keep_richest_by_id(spark, d):
    rows = read(spark, d, "conversations").select("conv_id", "role", "turn", F.length("text").cast("long").alias("len"), (-F.length("text")).alias("o"))
    return C.keep_first(rows, ["conv_id"], ["o", "turn"]).drop("o")


# -- tokens and spans ----------------------------------------------------------------------------------


@query("token_offsets", f"WITH {TOKENS} SELECT doc_id, count(*) AS n, sum(start)::BIGINT AS total, max(start + length(token))::BIGINT AS last FROM tok GROUP BY 1")
def token_offsets(spark, d):
    return C.tokens(docs(spark, d, "text")).groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("start").alias("total"), F.max(F.col("start") + F.length("token")).alias("last"))


@query("bio_islands", f'{ONE} SELECT doc_id, type, first::BIGINT AS first, last_end::BIGINT AS last_end, start::BIGINT AS start, "end"::BIGINT AS "end" FROM gold')
def bio_islands(spark, d):
    got = with_spans(spark, d, s=GOLD).select("doc_id", F.explode("s").alias("x"))
    return got.select("doc_id", "x.type", *[F.col(f"x.{c}").cast("long").alias(c) for c in ("first", "last_end", "start", "end")])


@query("io_islands", f"""WITH {TOKENS}, {span_sql(GOLD, 'gold')},
o AS (SELECT *, CASE WHEN ty IS NOT NULL AND lag(ty) OVER (PARTITION BY doc_id ORDER BY i) IS DISTINCT FROM ty THEN 1 ELSE 0 END AS b FROM gold_open),
g AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS isl FROM o)
SELECT type, count(*) AS n, sum(w)::BIGINT AS tokens FROM (SELECT doc_id, isl, ty AS type, count(*) AS w FROM g WHERE ty IS NOT NULL GROUP BY ALL) GROUP BY 1""")
def io_islands(spark, d):
    out = C.io_islands(tagged(spark, d, GOLD))
    return out.groupBy("type").agg(F.count("*").alias("n"), F.sum(F.col("last_end") - F.col("first")).cast("long").alias("tokens"))


def broken_spans(spark, d):
    """Documents with their gold spans, whose offsets (s, e) are off by one for some; the shift that mends each."""
    ds = lambda x: F.when(x["start"] % 5 == 1, 1).when(x["start"] % 5 == 2, -1).otherwise(0)
    de = lambda x: F.when(x["start"] % 7 == 3, 1).when(x["start"] % 5 == 1, 1).otherwise(0)
    off = lambda x: F.struct(x["type"].alias("type"), x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"), x["surface"].alias("surface"), (x["start"] + ds(x)).alias("s"), (x["end"] + de(x)).alias("e"))
    own = with_spans(spark, d, x=GOLD).withColumn("x", F.transform("x", off))
    return own.withColumn("shift", P.span_shifts(F.col("text"), F.col("x.surface"), F.col("x.s"), F.col("x.e")))


def broken(spark, d, *columns):
    """One row for each span of broken_spans; the text itself stays behind, only what is asked of it goes along."""
    own = broken_spans(spark, d).withColumn("n_text", F.length("text"))
    got = own.select("doc_id", "n_text", *columns, F.explode(F.arrays_zip("x", "shift")).alias("z"))
    return got.select("doc_id", "n_text", *columns, "z.x.*", F.col("z.shift").alias("shift"))


BROKEN = """, b AS (SELECT *, (start + CASE WHEN start % 5 = 1 THEN 1 WHEN start % 5 = 2 THEN -1 ELSE 0 END)::INT AS s,
  ("end" + CASE WHEN start % 7 = 3 THEN 1 WHEN start % 5 = 1 THEN 1 ELSE 0 END)::INT AS e,
  substring(text, (start + 1)::INT, ("end" - start)::INT) AS surface FROM gold JOIN documents USING (doc_id))"""
FITS = "({a} >= 0 AND {b} > {a} AND {b} <= length(text) AND substring(text, {a} + 1, {b} - {a}) = surface)"


@query("span_validity_report", f"""{ONE}{BROKEN} SELECT type, count(*) AS n, count(*) FILTER ({FITS.format(a='s', b='e')}) AS valid,
  count(*) FILTER (e > length(text)) AS beyond FROM b GROUP BY 1""")
def span_validity_report(spark, d):
    return broken(spark, d).groupBy("type").agg(F.count("*").alias("n"), F.count_if(fits(0, 0)).alias("valid"), F.count_if(F.col("e") > F.col("n_text")).alias("beyond"))


def fits(a: int, b: int):
    return F.coalesce((F.col("shift.d_start") == a) & (F.col("shift.d_end") == b), F.lit(False))


@query("span_off_by_one_fix", f"""{ONE}{BROKEN} SELECT doc_id, s, e, CASE {' '.join(f"WHEN {FITS.format(a=f'(s + {x})', b=f'(e + {y})')} THEN '{x},{y}'" for x, y in ((0, 0), (0, 1), (-1, 0), (1, 0), (0, -1)))} ELSE 'none' END AS fix FROM b""")
def span_off_by_one_fix(spark, d):
    return broken(spark, d).select("doc_id", "s", "e", F.when(F.col("shift").isNull(), "none").otherwise(F.concat_ws(",", "shift.d_start", "shift.d_end")).alias("fix"))


WORDS = "SELECT conv_id, turn, text, unnest(list_distinct(list_filter(string_split(text, ' '), lambda x: x <> ''))) AS surface FROM conversations"


def turn_words(spark, d, *columns):
    """Every distinct word of every turn."""
    words = F.filter(F.array_distinct(F.split("text", " ")), lambda w: w != "")
    return read(spark, d, "conversations").select("conv_id", "turn", *columns, words.alias("words"))


@query("span_nearest_fix", f"""WITH t AS ({WORDS}), p AS (SELECT conv_id, turn, surface, length(text) // 2 AS hint, string_split(text, surface) AS parts FROM t),
o AS (SELECT conv_id, turn, surface, hint, list_sum(list_transform(parts[1 : k], lambda x: length(x))) + (k - 1) * length(surface) AS s FROM p, unnest(generate_series(1, len(parts) - 1)) g(k))
SELECT conv_id, turn, surface, arg_min(s, abs(s - hint) * 1000000 + s)::INT AS start FROM o GROUP BY ALL""")
def span_nearest_fix(spark, d):
    """Every word of every turn at its place nearest to the middle."""
    rows = turn_words(spark, d, "text")
    rows = rows.withColumn("start", P.mention_starts(F.col("text"), F.col("words"), F.transform("words", lambda w: F.expr("length(text) div 2").cast("int"))))
    got = rows.select("conv_id", "turn", F.explode(F.arrays_zip("words", "start")).alias("x"))
    return got.select("conv_id", "turn", F.col("x.words").alias("surface"), "x.start")


@query("repeated_surface_audit", f"""WITH t AS ({WORDS}) SELECT conv_id, turn, surface, n FROM (SELECT *, ((length(text) - length(replace(text, surface, ''))) // length(surface))::BIGINT AS n FROM t) WHERE n > 1""")
def repeated_surface_audit(spark, d):
    n = lambda w: ((F.length("text") - F.length(F.replace(F.col("text"), w, F.lit("")))) / F.length(w)).cast("long")
    counted = F.filter(F.transform("words", lambda w: F.struct(w.alias("surface"), n(w).alias("n"))), lambda x: x["n"] > 1)
    return turn_words(spark, d, "text").select("conv_id", "turn", F.explode(counted).alias("x")).select("conv_id", "turn", "x.*")


@query("mention_occurrence_align", """WITH t AS (SELECT conv_id, turn, text, list_filter(string_split(text, ' '), lambda x: length(x) > 3) AS ws FROM conversations),
m AS (SELECT conv_id, turn, text, i, ws[i] AS surface, len(list_filter(ws[1 : i], lambda x: x = ws[i])) AS k FROM t, unnest(generate_series(1, len(ws))) g(i)),
p AS (SELECT *, string_split(text, surface) AS parts FROM m)
SELECT conv_id, turn, (i - 1)::INT AS mention, surface, CASE WHEN k < len(parts) THEN (list_sum(list_transform(parts[1 : k], lambda x: length(x))) + (k - 1) * length(surface))::INT END AS start FROM p""")
def mention_occurrence_align(spark, d):
    """Mentions of a turn, its words of four letters or more, find their offsets: the k-th of a surface gets its k-th occurrence."""
    rows = read(spark, d, "conversations").select("conv_id", "turn", "text", F.filter(F.split("text", " "), lambda w: F.length(w) > 3).alias("surface"))
    rows = rows.withColumn("start", P.mention_starts(F.col("text"), F.col("surface")))
    got = rows.select("conv_id", "turn", F.posexplode(F.arrays_zip("surface", "start")).alias("mention", "x"))
    return got.select("conv_id", "turn", "mention", "x.surface", "x.start")


@query("hinted_assignment", """WITH t AS (SELECT conv_id, turn, text, list_distinct(list_filter(string_split(text, ' '), lambda x: length(x) > 3)) AS ws FROM conversations),
m AS (SELECT conv_id, turn, text, unnest(ws) AS surface FROM t),
p AS (SELECT conv_id, turn, surface, length(text) AS n, string_split(text, surface) AS parts FROM m),
o AS (SELECT conv_id, turn, surface, n, list_sum(list_transform(parts[1 : k], lambda x: length(x))) + (k - 1) * length(surface) AS s FROM p, unnest(generate_series(1, len(parts) - 1)) g(k))
SELECT conv_id, turn, surface, arg_min(s, abs(s - n) * 1000000 + s)::INT AS start FROM o GROUP BY ALL""")
def hinted_assignment(spark, d):
    """Each distinct word goes to the occurrence nearest to a hint, here the turn's end."""
    rows = read(spark, d, "conversations").select("conv_id", "turn", "text", F.array_distinct(F.filter(F.split("text", " "), lambda w: F.length(w) > 3)).alias("surface"))
    hints = F.transform("surface", lambda w: F.length("text"))
    rows = rows.withColumn("start", P.mention_starts(F.col("text"), F.col("surface"), hints))
    return rows.select("conv_id", "turn", F.explode(F.arrays_zip("surface", "start")).alias("x")).select("conv_id", "turn", "x.surface", "x.start")


@query("span_mend_report", f"""{ONE}{BROKEN}, w AS (SELECT type, CASE WHEN {FITS.format(a='s', b='e')} THEN 'exact' ELSE 'nearest' END AS way FROM b)
SELECT type, way, count(*) AS n FROM w GROUP BY ALL""")
def span_mend_report(spark, d):
    """The chain of repairs over spans that are off by one: every surface occurs, so none is fuzzy or dropped."""
    rows = broken_spans(spark, d)
    ways = P.mended_spans(F.col("text"), F.col("x.surface"), F.col("x.s"), F.col("x.e"))["way"]
    rows = rows.select(F.explode(F.arrays_zip(F.col("x.type").alias("type"), ways.alias("way"))).alias("z"))
    return rows.groupBy("z.type", "z.way").agg(F.count("*").alias("n"))


# -- conversations ---------------------------------------------------------------------------------------

WINDOWS = """c AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn) AS t FROM conversations GROUP BY 1),
w AS (SELECT conv_id, t, unnest(CASE WHEN len(t) <= 4 THEN [0] ELSE range(0, 2 * ceil((len(t) - 4) / 2.0)::BIGINT + 1, 2) END) AS s FROM c)"""


@query("turn_windows", f"WITH {WINDOWS} SELECT conv_id, (s // 2)::INT AS w, len(t[s + 1 : s + 4])::INT AS size, array_to_string(list_transform(t[s + 1 : s + 4], lambda x: x.text), ' ') AS text FROM w")
def turn_windows(spark, d):
    out = C.turn_windows(C.gather_turns(read(spark, d, "conversations")))
    return out.select("conv_id", "w", F.size("window").alias("size"), F.array_join("window.text", " ").alias("text"))


@query("window_keyword_prefilter", f"""WITH {WINDOWS}, x AS (SELECT conv_id, s // 2 AS w, count(*) OVER (PARTITION BY conv_id) AS n, array_to_string(list_transform(t[s + 1 : s + 4], lambda x: x.text), ' ') AS text FROM w)
SELECT CASE WHEN n > 1 THEN conv_id || '__w' || w ELSE conv_id::VARCHAR END AS id FROM x WHERE regexp_matches(text, '(?i)(^|[^a-z])(that|with)([^a-z]|$)')""")
def window_keyword_prefilter(spark, d):
    out = C.turn_windows(C.gather_turns(read(spark, d, "conversations"))).withColumn("text", F.array_join("window.text", " "))
    own = F.col("conv_id").cast("string")
    return out.where(F.col("text").rlike("(?i)(^|[^a-z])(that|with)([^a-z]|$)")).select(F.when(F.col("n_windows") > 1, F.concat(own, F.lit("__w"), F.col("w"))).otherwise(own).alias("id"))


@query("conversation_flatten_offsets", """
WITH l AS (SELECT conv_id, turn, role, role || ': ' || text AS line FROM conversations),
o AS (SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(role) + 2 AS off FROM l)
SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY turn)) AS digest, string_agg(off::BIGINT::VARCHAR, ',' ORDER BY turn) AS offsets FROM o GROUP BY 1""")
def conversation_flatten_offsets(spark, d):
    out = C.flatten_turns(C.gather_turns(read(spark, d, "conversations")))
    return out.select("conv_id", F.sha2("text", 256).alias("digest"), F.array_join(F.col("offsets").cast("array<string>"), ",").alias("offsets"))


@query("prompt_render", "SELECT conv_id, string_agg('[Turn ' || r || '] ' || role || ': ' || text, chr(10) ORDER BY r) AS prompt FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS r FROM conversations) GROUP BY 1")
def prompt_render(spark, d):
    line = lambda t, i: F.concat(F.lit("[Turn "), i, F.lit("] "), t["speaker"], F.lit(": "), t["text"])
    return C.gather_turns(read(spark, d, "conversations")).select("conv_id", F.array_join(F.transform("turns", line), "\n").alias("prompt"))


@query("regroup_dialogue_rows", "SELECT conv_id, count(*) AS n, string_agg(text, '|' ORDER BY turn) FILTER (role = 'user') AS asked FROM conversations GROUP BY 1")
def regroup_dialogue_rows(spark, d):
    own = F.filter("turns", lambda t: t["speaker"] == "user")
    out = C.gather_turns(read(spark, d, "conversations"))
    return out.select("conv_id", F.size("turns").cast("long").alias("n"), F.when(F.size(own) > 0, F.array_join(F.transform(own, lambda t: t["text"]), "|")).alias("asked"))


@query("passage_chunks", r"""WITH RECURSIVE t AS (SELECT doc_id, length(text) AS n, list_transform(regexp_extract_all(text, '(?s).*?(?:\. |。|\n)'), lambda x: length(x)) AS ls FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, n, list_transform(range(1, len(ls) + 1), lambda i: list_sum(ls[1 : i])::BIGINT) AS ends FROM t),
c AS (SELECT doc_id, n, ends, 0::BIGINT AS start, CASE WHEN n <= 2000 THEN n ELSE coalesce(list_max(list_filter(ends, lambda x: x > 0 AND x <= 2000)), 2000) END::BIGINT AS cut FROM e
  UNION ALL SELECT doc_id, n, ends, s, CASE WHEN s + 2000 >= n THEN n ELSE coalesce(list_max(list_filter(ends, lambda x: x > s AND x <= s + 2000)), s + 2000) END::BIGINT
  FROM (SELECT doc_id, n, ends, CASE WHEN cut - 200 > start THEN cut - 200 ELSE cut END AS s FROM c WHERE start + 2000 < n))
SELECT doc_id, start::INT AS "offset", (cut - start)::INT AS size FROM c""")
def passage_chunks(spark, d):
    cut = docs(spark, d, "text").withColumn("c", F.explode(P.passage_chunks("text")))
    return cut.select("doc_id", F.col("c.offset").alias("offset"), F.length("c.text").alias("size"))


@query("clean_text", r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, 'https?://\S+', '', 'g'), '[*_~`#>\[\]()!]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS cleaned FROM documents""")
def clean_text(spark, d):
    return docs(spark, d, "text").select("doc_id", T.clean_text(F.col("text")).alias("cleaned"))


# -- types, views ------------------------------------------------------------------------------------------

@query("chat_explode", f"""{ONE}, e AS (SELECT doc_id, type, start, substring(text, (start + 1)::INT, ("end" - start)::INT) AS surface FROM gold JOIN documents USING (doc_id) WHERE regexp_full_match(substring(text, (start + 1)::INT, ("end" - start)::INT), '[A-Za-z ]+'))
SELECT doc_id, type AS query_type, '["' || string_agg(surface, '","' ORDER BY start) || '"]' AS answer FROM e GROUP BY ALL""")
def chat_explode(spark, d):
    fine = F.filter("x", lambda e: e["surface"].rlike("^[A-Za-z ]+$"))
    records = with_spans(spark, d, x=GOLD).select("doc_id", fine.alias("x")).where(F.size("x") > 0)
    entities = F.transform("x", lambda e: F.struct(e["type"].alias("type"), e["surface"].alias("surface")))
    return C.chat_rows(records.select("doc_id", entities.alias("entities"), F.array_distinct("x.type").alias("query_types")))


@query("type_frequency", f"{ONE} SELECT type, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM gold GROUP BY 1")
def type_frequency(spark, d):
    return spans(spark, d, GOLD).groupBy("type").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("n_docs"))


@query("offset_convention_vote", f"""{ONE}{BROKEN} SELECT type, count(*) AS n, count(*) FILTER ({FITS.format(a='s', b='e')}) AS exclusive, count(*) FILTER (NOT {FITS.format(a='s', b='e')} AND {FITS.format(a='s', b='(e + 1)')}) AS inclusive FROM b GROUP BY 1""")
def offset_convention_vote(spark, d):
    return broken(spark, d).groupBy("type").agg(F.count("*").alias("n"), F.count_if(fits(0, 0)).alias("exclusive"), F.count_if(fits(0, 1)).alias("inclusive"))


@query("field_presence", "SELECT source, count(*) AS n, count(text) AS n_text, count(*) FILTER (text LIKE '%@%') AS n_at, count(*) FILTER (n_chars > 2000) AS n_long FROM documents GROUP BY 1")
def field_presence(spark, d):
    return docs(spark, d, "text", "source", "n_chars").groupBy("source").agg(F.count("*").alias("n"), F.count("text").alias("n_text"), F.count_if(F.col("text").contains("@")).alias("n_at"), F.count_if(F.col("n_chars") > 2000).alias("n_long"))


# -- sampling ------------------------------------------------------------------------------------------------


def hashed(seed):
    return T.hash_order(seed, F.col("doc_id").cast("string"))


@query("language_cap", "SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY sha256('42|' || doc_id), doc_id) <= 50")
def language_cap(spark, d):
    return R.first_of_strata(docs(spark, d, "lang"), ["lang"], hashed(42), "doc_id", F.lit(50)).where("chosen").select("doc_id", "lang")


@query("source_cap", """SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY sha256('7|' || doc_id), doc_id) AS r FROM documents) WHERE r <= (SELECT floor(count(*) * 0.02) FROM documents)""")
def source_cap(spark, d):
    return R.first_of_strata(docs(spark, d, "source"), ["source"], hashed(7), "doc_id", F.floor(F.col("total") * 0.02)).where("chosen").select("doc_id", "source")


@query("bucket_sample", """WITH b AS (SELECT d.doc_id, CASE WHEN quality = 1 THEN 'gold' WHEN lang = 'en' THEN 'silver_en' ELSE 'silver_ml' END AS bucket FROM documents d LEFT JOIN labels USING (doc_id)),
n AS (SELECT *, count(*) OVER (PARTITION BY bucket) AS nb, count(*) OVER () AS n, row_number() OVER (PARTITION BY bucket ORDER BY sha256('42|' || doc_id), doc_id) AS r FROM b)
SELECT doc_id, bucket FROM n WHERE r <= greatest(1, floor(100 * nb / n))""")
def bucket_sample(spark, d):
    rows = docs(spark, d, "lang").join(read(spark, d, "labels"), "doc_id", "left")
    rows = rows.select("doc_id", F.when(F.col("quality") == 1, "gold").when(F.col("lang") == "en", "silver_en").otherwise("silver_ml").alias("bucket"))
    quota = F.greatest(F.lit(1), F.floor(100 * F.col("n") / F.col("total")))
    return R.first_of_strata(rows, ["bucket"], hashed(42), "doc_id", quota).where("chosen").select("doc_id", "bucket")


@query("mixture_sample", """WITH b AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'gold' WHEN 'de' THEN 'silver_en' ELSE 'silver_ml' END AS bucket FROM documents),
n AS (SELECT *, count(*) OVER (PARTITION BY bucket) AS nb, floor((SELECT count(*) FROM documents) * CASE bucket WHEN 'gold' THEN 0.75 WHEN 'silver_en' THEN 0.2 ELSE 0.05 END)::BIGINT AS want,
  row_number() OVER (PARTITION BY bucket ORDER BY sha256('1|' || doc_id), doc_id) AS r FROM b)
SELECT bucket, doc_id, (want // nb + CASE WHEN r <= want % nb THEN 1 ELSE 0 END)::BIGINT AS times FROM n WHERE want // nb + CASE WHEN r <= want % nb THEN 1 ELSE 0 END > 0""")
def mixture_sample(spark, d):
    rows = docs(spark, d, F.expr("CASE lang WHEN 'en' THEN 'gold' WHEN 'de' THEN 'silver_en' ELSE 'silver_ml' END").alias("bucket"))
    want = F.floor(F.col("total") * F.expr("CASE bucket WHEN 'gold' THEN 0.75D WHEN 'silver_en' THEN 0.2D ELSE 0.05D END"))
    marked = R.first_of_strata(rows, ["bucket"], hashed(1), "doc_id", want % F.col("n")).withColumn("want", want)
    return marked.select("bucket", "doc_id", F.expr("want div n + int(chosen)").alias("times")).where("times > 0")


@query("largest_remainder", """WITH w AS (SELECT n_name AS name, (length(n_name))::DOUBLE AS weight FROM nation), x AS (SELECT name, floor(weight * 100 / sum(weight) OVER ()) AS f, weight * 100 / sum(weight) OVER () - floor(weight * 100 / sum(weight) OVER ()) AS r FROM w)
SELECT name, (f + CASE WHEN row_number() OVER (ORDER BY round(r, 9) DESC, name) <= 100 - sum(f) OVER () THEN 1 ELSE 0 END)::BIGINT AS n FROM x""")
def largest_remainder(spark, d):
    return C.largest_remainder(read(spark, d, "nation").select(F.col("n_name").alias("name"), F.length("n_name").cast("double").alias("weight")), 100).select("name", "n")


@query("scenario_grid", "SELECT r_name AS lang, event_type AS scenario, count(*) OVER (PARTITION BY r_name) AS n FROM region, (SELECT DISTINCT event_type FROM events)")
def scenario_grid(spark, d):
    kinds = read(spark, d, "events").select(F.col("event_type").alias("scenario")).distinct()
    return read(spark, d, "region").select(F.col("r_name").alias("lang")).crossJoin(kinds).withColumn("n", F.expr("count(*) OVER (PARTITION BY lang)"))


@query("bucket_routing", """SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'gold' WHEN quality = 1 THEN (CASE WHEN doc_id % 2 = 1 THEN 'gold' WHEN lang = 'en' THEN 'silver_en' ELSE 'silver_ml' END)
  ELSE 'gold' END AS bucket FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY 1""")
def bucket_routing(spark, d):
    rows = docs(spark, d, "lang", "source").join(read(spark, d, "labels"), "doc_id", "left")
    confidence = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "gold").when(F.col("quality") == 1, "silver")
    fmt = F.when(F.col("doc_id") % 2 == 0, "conversation")
    return rows.groupBy(T.bucket(confidence, fmt, F.col("lang"), F.col("source")).alias("bucket")).agg(F.count("*").alias("n"))


# -- joins and audits --------------------------------------------------------------------------------------


@query("map_merge", """WITH a AS (SELECT n_name AS k, 'R' || n_regionkey AS v FROM nation WHERE n_nationkey < 15), b AS (SELECT n_name AS k, 'S' || n_nationkey % 3 AS v FROM nation WHERE n_nationkey >= 10)
SELECT k, coalesce(a.v, b.v) AS target, a.v IS NOT NULL AND b.v IS NOT NULL AS both FROM a FULL JOIN b USING (k)""")
def map_merge(spark, d):
    nation = read(spark, d, "nation")
    a = nation.where("n_nationkey < 15").select(F.col("n_name").alias("k"), F.concat(F.lit("R"), "n_regionkey").alias("a"))
    b = nation.where("n_nationkey >= 10").select(F.col("n_name").alias("k"), F.concat(F.lit("S"), F.col("n_nationkey") % 3).alias("b"))
    return a.join(b, "k", "full").select("k", F.coalesce("a", "b").alias("target"), (F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"))


@query("coverage_rollup", """WITH c AS (SELECT CASE event_type WHEN 'click' THEN 'A' WHEN 'view' THEN 'A' ELSE 'UNMAPPED' END AS target, event_type AS type, count(*) AS n FROM events GROUP BY ALL)
SELECT target, sum(n)::BIGINT AS n, string_agg(type, ',' ORDER BY n DESC, type) AS sources FROM c GROUP BY 1""")
def coverage_rollup(spark, d):
    target = F.when(F.col("event_type").isin("click", "view"), "A").otherwise("UNMAPPED")
    counts = read(spark, d, "events").groupBy(target.alias("target"), F.col("event_type").alias("type")).agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "type")))
    return counts.groupBy("target").agg(F.sum("n").alias("n"), F.array_join(F.transform(listed, lambda x: x["type"]), ",").alias("sources"))


@query("leakage_audit", """WITH r AS (SELECT conv_id || '__w' || turn AS id, turn % 3 = 0 AS val FROM conversations), b AS (SELECT regexp_replace(regexp_replace(id, '_canonical$', ''), '__(w|chunk)\\d+$', '') AS base, val FROM r)
SELECT base, count(*) FILTER (val) AS n_val, count(*) FILTER (NOT val) AS n_train FROM b GROUP BY 1 HAVING bool_or(val) AND bool_or(NOT val)""".replace("\\\\", "\\"))
def leakage_audit(spark, d):
    rows = read(spark, d, "conversations").select(F.concat(F.col("conv_id"), F.lit("__w"), "turn").alias("id"), (F.col("turn") % 3 == 0).alias("val"))
    out = rows.groupBy(T.base_id(F.col("id")).alias("base")).agg(F.count_if("val").alias("n_val"), F.count_if(~F.col("val")).alias("n_train"))
    return out.where("n_val > 0 AND n_train > 0")


@query("benchmark_contamination", "SELECT item_id, count(*) AS n_docs FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY 1")
def benchmark_contamination(spark, d):
    """Items whose text occurs in a document, whatever its length."""
    return C.containing(docs(spark, d, "text"), read(spark, d, "benchmark"), "item_id").withColumnRenamed("n", "n_docs")


@query("resume_anti_join", "SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations p WHERE p.conv_id = c.conv_id AND p.turn = c.turn AND p.turn % 2 = 0)")
def resume_anti_join(spark, d):
    rows = read(spark, d, "conversations").select("conv_id", "turn")
    return rows.join(rows.where("turn % 2 = 0"), ["conv_id", "turn"], "left_anti")


BACKFILL = """, f AS (SELECT doc_id, start, "end", type || '/Sub' AS new_type, (start % 100) / 100.0::DOUBLE AS conf, start % 4 = 0 AS generic FROM gold WHERE (doc_id + start) % 3 = 0)"""
ENTITY_KEY = ["source", "source_id", "turn_index", "start", "end", "surface"]


def entities(spark, d):
    """Gold spans as entities of records, with the six parts of their key; passages have no turn."""
    return spans(spark, d, GOLD).select(F.lit("documents").alias("source"), F.col("doc_id").alias("source_id"), F.lit(None).cast("int").alias("turn_index"), "start", "end", "surface", "type")


def backfill(spark, d):
    own = entities(spark, d).where("(source_id + start) % 3 = 0").withColumnRenamed("type", "old_type")
    return own.select(*ENTITY_KEY, F.concat("old_type", F.lit("/Sub")).alias("new_type"), (F.col("start") % 100 / F.lit(100.0)).alias("conf"), (F.col("start") % 4 == 0).alias("generic"))


@query("backfill_apply", f"""{ONE} SELECT doc_id AS source_id, start, CASE WHEN (doc_id + start) % 3 = 0 AND (start % 100) / 100.0::DOUBLE >= 0.7 AND start % 4 <> 0 THEN type || '/Sub' ELSE type END AS type FROM gold""")
def backfill_apply(spark, d):
    return C.apply_backfill(entities(spark, d), backfill(spark, d), ENTITY_KEY).select("source_id", "start", "type")


@query("upgrade_summary", f"""{ONE}{BACKFILL} SELECT type, new_type, CASE WHEN conf < 0.5 THEN '<.5' WHEN conf < 0.7 THEN '.5-.7' WHEN conf < 0.9 THEN '.7-.9' ELSE '>=.9' END AS band, count(*) AS n FROM gold JOIN f USING (doc_id, start, "end") WHERE type <> new_type GROUP BY ALL""")
def upgrade_summary(spark, d):
    fills = backfill(spark, d)
    joined = entities(spark, d).alias("a").join(fills.alias("b"), C.same_key("a", "b", ENTITY_KEY)).select("a.type", "b.new_type", "b.conf").where("type <> new_type")
    band = F.when(F.col("conf") < 0.5, "<.5").when(F.col("conf") < 0.7, ".5-.7").when(F.col("conf") < 0.9, ".7-.9").otherwise(">=.9")
    return joined.groupBy("type", "new_type", band.alias("band")).agg(F.count("*").alias("n"))


# -- lexicons -------------------------------------------------------------------------------------------------

@query("pronoun_filter", f"""WITH {TOKENS} SELECT token, count(*) AS n FROM tok WHERE lower(trim(token)) IN ('i', 'it', 'he', 'you', 'me', 'us', 'we', 'she', 'her', 'him') GROUP BY 1""")
def pronoun_filter(spark, d):
    own = F.explode(F.split("text", " ")).alias("token")
    rows = docs(spark, d, own).where(T.is_pronoun(F.col("token"))).where(F.lower(F.trim("token")).isin("i", "it", "he", "you", "me", "us", "we", "she", "her", "him"))
    return rows.groupBy("token").agg(F.count("*").alias("n"))


NOISY = sorted({w for words in V.NOISE.values() for w in words} | {"山", "犬"})
KINDS = ["ACTIVITY", "EMOTION", "RELATIONSHIP_REF/Friend", "EVENT/General", "DATE/Season", "PLACE"]
_NOISE = " OR ".join([f"(starts_with(type, '{k}') AND surface IN ({', '.join(repr(w) for w in ws)}))" for k, ws in V.NOISE.items()] + [f"(type = '{k}' AND surface = '{w}')" for k, w in V.NOISE_EXACT])


@query("noise_filter", f"""WITH t AS (SELECT conv_id, turn, {NOISY!r}[(conv_id * 7 + turn) % {len(NOISY)} + 1] AS surface, unnest({KINDS!r}) AS type FROM conversations) SELECT *, {_NOISE} AS noise FROM t""")
def noise_filter(spark, d):
    """A surface for every turn, under every type: is it noise there?"""
    surface = F.element_at(F.array(*map(F.lit, NOISY)), ((F.col("conv_id") * 7 + F.col("turn")) % len(NOISY) + 1).cast("int"))
    rows = read(spark, d, "conversations").select("conv_id", "turn", surface.alias("surface"), F.explode(F.array(*map(F.lit, KINDS))).alias("type"))
    return rows.withColumn("noise", T.is_noise(F.col("type"), F.col("surface")))


# -- metrics --------------------------------------------------------------------------------------------------


def counts(spark, d):
    return C.matched(spans(spark, d, GOLD), spans(spark, d, PRED), ["doc_id", "type", "start", "end"])


MATCHED = f"""{BOTH}, m AS (SELECT type, count(*) FILTER (g = 1 AND p = 1) AS tp, count(*) FILTER (g = 0) AS fp, count(*) FILTER (p = 0) AS fn FROM (
  SELECT doc_id, type, start, "end", max(g) AS g, max(p) AS p FROM (SELECT doc_id, type, start, "end", 1 AS g, 0 AS p FROM gold UNION ALL SELECT doc_id, type, start, "end", 0, 1 FROM pred) GROUP BY ALL) GROUP BY 1)"""


@query("span_f1", f"{MATCHED} SELECT type, tp, fp, fn, round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1 FROM m")
def span_f1(spark, d):
    out = C.with_prf(counts(spark, d))
    return out.select("type", F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"), F.col("fn").cast("long").alias("fn"), F.round("f1", 6).alias("f1"))


@query("macro_micro", f"{MATCHED} SELECT round(sum(2.0::DOUBLE * tp / (2 * tp + fp + fn)) / 6, 6) AS macro_f1, round(2.0::DOUBLE * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS micro_f1 FROM m")
def macro_micro(spark, d):
    each = C.with_prf(counts(spark, d))
    micro = 2 * F.sum("tp") / (2 * F.sum("tp") + F.sum("fp") + F.sum("fn"))
    return each.agg(F.round(F.sum("f1") / 6, 6).alias("macro_f1"), F.round(micro, 6).alias("micro_f1"))


@query("overlap_f1", f"""{BOTH} SELECT (SELECT count(*) FROM gold g WHERE EXISTS (SELECT 1 FROM pred p WHERE p.doc_id = g.doc_id AND p.type = g.type AND p.start < g."end" AND g.start < p."end")) AS gold_hit,
  (SELECT count(*) FROM pred p WHERE EXISTS (SELECT 1 FROM gold g WHERE p.doc_id = g.doc_id AND p.type = g.type AND p.start < g."end" AND g.start < p."end")) AS pred_hit""")
def overlap_f1(spark, d):
    """Spans that overlap one of the other side. Spans of one side don't overlap each other, so the neighbours decide."""
    both = spans(spark, d, GOLD).withColumn("side", F.lit(0)).union(spans(spark, d, PRED).withColumn("side", F.lit(1)))
    w = "PARTITION BY doc_id, type ORDER BY start, side"
    other = lambda s: f"max(CASE WHEN side = {s} THEN end END) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = lambda s: f"min(CASE WHEN side = {s} THEN start END) OVER ({w} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    hit = F.expr(f"CASE side WHEN 0 THEN coalesce({other(1)} > start, false) OR coalesce({after(1)} < end, false) ELSE coalesce({other(0)} > start, false) OR coalesce({after(0)} < end, false) END")
    return both.withColumn("hit", hit).agg(F.count_if(F.col("hit") & (F.col("side") == 0)).alias("gold_hit"), F.count_if(F.col("hit") & (F.col("side") == 1)).alias("pred_hit"))


@query("kappa", f"""{BOTH}, r AS (SELECT doc_id, t.type, bool_or(g.type IS NOT NULL) AS g, bool_or(p.type IS NOT NULL) AS p FROM documents CROSS JOIN (VALUES ('PERSON'), ('PLACE'), ('ORG')) t(type)
  LEFT JOIN (SELECT DISTINCT doc_id, type FROM gold) g USING (doc_id, type) LEFT JOIN (SELECT DISTINCT doc_id, type FROM pred) p USING (doc_id, type) GROUP BY ALL),
k AS (SELECT type, count(*)::DOUBLE AS n, count(*) FILTER (g) AS g1, count(*) FILTER (p) AS p1, count(*) FILTER (g = p) / count(*)::DOUBLE AS po FROM r GROUP BY 1), e AS (SELECT *, (g1 * p1 + (n - g1) * (n - p1)) / (n * n) AS pe FROM k)
SELECT type, round(CASE WHEN pe = 1 THEN 1.0 ELSE (po - pe) / (1 - pe) END, 4) AS kappa FROM e""")
def kappa(spark, d):
    gold, pred = (spans(spark, d, n).select("doc_id", "type").distinct() for n in (GOLD, PRED))
    sides = gold.withColumn("g", F.lit(1)).join(pred.withColumn("p", F.lit(1)), ["doc_id", "type"], "full").fillna(0, ["g", "p"])
    seen = sides.groupBy("type").agg(F.sum("g").alias("g1"), F.sum("p").alias("p1"), F.count_if(F.col("g") == F.col("p")).alias("same"), F.count("*").alias("present"))
    n = docs(spark, d).agg(F.count("*").cast("double").alias("n"))
    out = seen.crossJoin(F.broadcast(n)).withColumns({"po": (F.col("same") + F.col("n") - F.col("present")) / F.col("n"), "pe": (F.col("g1") * F.col("p1") + (F.col("n") - F.col("g1")) * (F.col("n") - F.col("p1"))) / (F.col("n") * F.col("n"))})
    return out.select("type", F.round(F.when(F.col("pe") == 1, 1.0).otherwise((F.col("po") - F.col("pe")) / (1 - F.col("pe"))), 4).alias("kappa"))


@query("token_metrics", f"""{BOTH} SELECT count(*) FILTER (g.tag = p.tag AND g.tag <> 'O') AS tp, count(*) FILTER (p.tag <> 'O' AND g.tag <> p.tag) AS fp, count(*) FILTER (g.tag <> 'O' AND g.tag <> p.tag) AS fn FROM gold_tag g JOIN pred_tag p USING (doc_id, i)""")
def token_metrics(spark, d):
    """Both taggers see the same tokens, so their tags are computed side by side."""
    g = tagged(spark, d, GOLD).withColumnRenamed("tag", "g")
    p = F.when(F.col("g").startswith("I-") & (F.length("token") < PRED), "O").otherwise(F.col("g"))
    rows = g.withColumn("p", p)
    same = F.col("g") == F.col("p")
    return rows.agg(F.count_if(same & (F.col("g") != "O")).alias("tp"), F.count_if(~same & (F.col("p") != "O")).alias("fp"), F.count_if(~same & (F.col("g") != "O")).alias("fn"))


@query("truncation_report", f"""{ONE} SELECT source, type, count(*) AS n, count(*) FILTER ("end" > 2000) AS cut FROM gold JOIN documents USING (doc_id) GROUP BY GROUPING SETS ((source), (type))""")
def truncation_report(spark, d):
    rows = spans(spark, d, GOLD).join(docs(spark, d, "source"), "doc_id")
    return rows.groupingSets([[F.col("source")], [F.col("type")]], F.col("source"), F.col("type")).agg(F.count("*").alias("n"), F.count_if(F.col("end") > 2000).alias("cut"))


@query("distribution_drift", """WITH f AS (SELECT lang, count(*) / sum(count(*)) OVER ()::DOUBLE AS full_share FROM documents GROUP BY 1), m AS (SELECT lang, count(*) / sum(count(*)) OVER ()::DOUBLE AS mini_share FROM documents WHERE doc_id % 10 = 3 GROUP BY 1)
SELECT lang, round(full_share, 6) AS full_share, round(coalesce(mini_share, 0), 6) AS mini_share, abs(full_share - coalesce(mini_share, 0)) > 0.02 AS drifts FROM f LEFT JOIN m USING (lang)""")
def distribution_drift(spark, d):
    out = docs(spark, d, "lang").groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("doc_id") % 10 == 3).alias("m"))
    out = out.withColumns({"f": F.expr("n / sum(n) OVER (PARTITION BY 1)"), "s": F.expr("m / sum(m) OVER (PARTITION BY 1)")})
    return out.select("lang", F.round("f", 6).alias("full_share"), F.round("s", 6).alias("mini_share"), (F.abs(F.col("f") - F.col("s")) > 0.02).alias("drifts"))


@query("composite_score", """SELECT l_returnflag AS run, round(0.4 * avg(l_discount) + 0.25 * avg(l_tax) + 0.2 * avg(l_quantity) / 50 + 0.1 * avg(l_discount * l_tax) + 0.05, 6) AS composite FROM lineitem GROUP BY 1""")
def composite_score(spark, d):
    weights = (0.40, F.avg("l_discount")), (0.25, F.avg("l_tax")), (0.20, F.avg("l_quantity") / 50), (0.10, F.avg(F.col("l_discount") * F.col("l_tax"))), (0.05, F.lit(1.0))
    return read(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("run")).agg(F.round(sum(w * m for w, m in weights), 6).alias("composite"))


@query("llm_output_parse", """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '[{"n":' || length(text) || '}]' WHEN 1 THEN '[{"n":' || length(text) || '}]' WHEN 2 THEN NULL WHEN 3 THEN '[' || doc_id || ',2]' END AS parsed FROM documents WHERE text IS NOT NULL""")
def llm_output_parse(spark, d):
    """An answer of some form for every document: a fenced list, an object in prose, none, a list in prose, a broken one."""
    shapes = ["concat('```json\n[{\"n\":', length(text), '}]\n```')", "concat('Here: {\"n\":', length(text), '} done')", "'no json at all'", "concat('x [', doc_id, ',2] y')", "'[1, 2'"]
    raw = F.expr("CASE doc_id % 5 " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(shapes)) + " END")
    return docs(spark, d, "text").where("text IS NOT NULL").select("doc_id", T.json_list(raw).alias("parsed"))
