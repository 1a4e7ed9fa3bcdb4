"""Queries over formats: each writes a test table in one of the formats, reads it back, and returns what it read."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import functions as F

from glossweave.functions import granularity as G
from glossweave.functions import python as P
from glossweave.operators import core as C
from glossweave.sources import readers, sinks

from .queries import BROKEN, GOLD, ONE, WINDOWS, docs, read, tag, with_spans
from .registry import query


def folder(spark) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir; a local one only under a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{shared or tempfile.mkdtemp(prefix='glossweave-')}/{uuid.uuid4().hex}"


def wide(spark, d):
    """Documents as records in the wide form."""
    entity = lambda e: F.struct(e["surface"].alias("surface"), e["type"].alias("type"), e["type"].alias("original_type"), e["start"].alias("start"), e["end"].alias("end"))
    rows = with_spans(spark, d, "source", "lang", x=GOLD).where("text IS NOT NULL")
    return rows.select(F.lit("1.0").alias("schema_version"), "source", F.col("doc_id").cast("string").alias("source_id"), F.col("lang").alias("language"), F.lit("train").alias("split"), F.lit("gold").alias("confidence"), F.array("source").alias("provenance"), "text", F.array(F.lit("PERSON")).alias("query_types"), F.transform("x", entity).alias("entities"))


@query("jsonl_records", f"""{ONE} SELECT doc_id::VARCHAR AS source_id, sha256(text) AS digest, count(type) AS n, coalesce(sum(start), 0)::BIGINT AS starts FROM documents LEFT JOIN gold USING (doc_id) WHERE text IS NOT NULL GROUP BY ALL""")
def jsonl_records(spark, d):
    path = folder(spark)
    readers.write_jsonl(wide(spark, d), path)
    got = readers.records(spark, path)
    return got.select("source_id", F.sha2("text", 256).alias("digest"), F.size("entities").cast("long").alias("n"), F.aggregate("entities", F.lit(0).cast("long"), lambda a, e: a + e["start"]).alias("starts"))


@query("jsonl_dispatch", "SELECT 'conversation' AS kind, count(DISTINCT conv_id) AS n, count(*) AS parts FROM conversations UNION ALL SELECT 'passage', count(*), count(*) FILTER (length(text) > 100) FROM documents WHERE text IS NOT NULL")
def jsonl_dispatch(spark, d):
    """Passages and conversations in one file, told apart by their format."""
    path = folder(spark)
    talks = C.gather_turns(read(spark, d, "conversations")).select(F.lit("conversation").alias("format"), F.col("conv_id").cast("string").alias("source_id"), F.transform("turns", lambda t: F.struct(t["speaker"].alias("speaker"), t["text"].alias("text"))).alias("turns"))
    readers.write_jsonl(wide(spark, d).unionByName(talks, allowMissingColumns=True), path)
    passages, conversations = readers.dispatched(readers.records(spark, path))
    return conversations.agg(F.lit("conversation").alias("kind"), F.count("*").alias("n"), F.sum(F.size("turns")).alias("parts")).union(passages.agg(F.lit("passage"), F.count("*"), F.count_if(F.length("text") > 100)))


@query("jsonl_with_place", "SELECT count(*) AS n, 1::BIGINT AS broken, count(*) + 1 AS places, true AS named FROM documents WHERE text IS NOT NULL")
def jsonl_with_place(spark, d):
    """Lines with file and order, and one that isn't JSON."""
    path = folder(spark)
    wide(spark, d).select(F.to_json(F.struct("*")).alias("value")).union(spark.createDataFrame([("{no json",), ("  ",)], "value string")).write.text(path)
    got = readers.records_with_place(spark, path)
    return got.agg(F.count_if(~F.col("broken")).alias("n"), F.count_if("broken").alias("broken"), F.countDistinct("file", "ord").alias("places"), F.min(F.col("file").contains(path.rsplit("/", 1)[-1])).alias("named"))


@query("preflight_report", "SELECT count(*) AS lines, 0::BIGINT AS broken, 0::BIGINT AS without_text, count(*) FILTER (lang IS NULL) AS without_language FROM documents WHERE text IS NOT NULL")
def preflight_report(spark, d):
    path = folder(spark)
    readers.write_jsonl(wide(spark, d), path)
    return readers.preflight(spark, path, ["text", "language"])


#: Sentences of up to eight words of four letters or more, without signs that formats need.
SENTENCE = "list_filter(regexp_extract_all(coalesce(text, ''), '[A-Za-z]{4,}'), lambda x: x <> '')[1:8]"
_TAG = "CASE WHEN regexp_matches(w, '^[A-Z]') THEN 'B-' WHEN length(w) >= 8 THEN 'I-' ELSE 'O' END || CASE WHEN regexp_matches(w, '^[A-Z]') OR length(w) >= 8 THEN ['PERSON', 'PLACE', 'ORG'][length(w) % 3 + 1] ELSE '' END"
TAGGED = f"s AS (SELECT doc_id, {SENTENCE} AS ws FROM documents), t AS (SELECT doc_id, ws, list_transform(ws, lambda w: {_TAG}) AS tags FROM s WHERE len(ws) > 0)"


def sentences(spark, d):
    words = F.slice(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("([A-Za-z]{4,})"), F.lit(1)), 1, 8)
    return docs(spark, d, words.alias("tokens")).where(F.size("tokens") > 0).withColumn("tags", F.transform("tokens", lambda w: tag(w, GOLD)))


@query("conll_read", f"WITH {TAGGED} SELECT doc_id::VARCHAR AS id, array_to_string(ws, ' ') AS tokens, array_to_string(tags, ' ') AS tags FROM t")
def conll_read(spark, d):
    path, line = folder(spark), lambda x: F.concat(x["tokens"], F.lit(" _ _ "), x["tags"])
    block = F.concat(F.lit("# id "), "doc_id", F.lit("\n"), F.array_join(F.transform(F.arrays_zip("tokens", "tags"), line), "\n"), F.lit("\n"))
    sentences(spark, d).select(block.alias("value")).write.text(path)
    return readers.conll(spark, path).select("id", F.array_join("tokens", " ").alias("tokens"), F.array_join("tags", " ").alias("tags"))


@query("tsv_bio_read", f"WITH {TAGGED} SELECT array_to_string(ws, ' ') AS tokens, array_to_string(tags, ' ') AS tags, count(*) AS n FROM t GROUP BY ALL")
def tsv_bio_read(spark, d):
    path, line = folder(spark), lambda x, i: F.concat_ws("\t", i + 1, x["tokens"], x["tags"], F.lit("O"))
    block = F.concat(F.lit("#\thttp://example.com/"), "doc_id", F.lit("\n"), F.array_join(F.transform(F.arrays_zip("tokens", "tags"), line), "\n"), F.lit("\n"))
    sentences(spark, d).select(block.alias("value")).write.text(path)
    got = readers.tsv_bio(spark, path)
    return got.groupBy(F.array_join("tokens", " ").alias("tokens"), F.array_join("tags", " ").alias("tags")).agg(F.count("*").alias("n"))


@query("token_tag_parquet", f"WITH {TAGGED} SELECT doc_id, array_to_string(tags, ' ') AS tags FROM t")
def token_tag_parquet(spark, d):
    """Integer tags in nested folders, one for each language."""
    names = ["O", *[f"{b}-{t}" for t in ("PERSON", "PLACE", "ORG") for b in "BI"]]
    path = folder(spark)
    coded = F.transform("tags", lambda t: F.array_position(F.array(*map(F.lit, names)), t).cast("int") - 1)
    sentences(spark, d).select("doc_id", "tokens", coded.alias("ner_tags"), (F.col("doc_id") % 3).alias("language")).write.partitionBy("language").parquet(path)
    return readers.token_tag_parquet(spark, path, names).select("doc_id", F.array_join("tags", " ").alias("tags"))


@query("char_span_parquet", f"""{ONE} SELECT lang AS language, doc_id, count(type) AS n FROM documents LEFT JOIN gold USING (doc_id) WHERE text IS NOT NULL AND lang IS NOT NULL GROUP BY ALL""")
def char_span_parquet(spark, d):
    """A file for each language, whose name is the file's."""
    path = folder(spark)
    rows = wide(spark, d).where("language IS NOT NULL").select("language", F.col("source_id").cast("long").alias("doc_id"), "text", F.col("entities").alias("char_spans"))
    for (name,) in rows.select("language").distinct().collect():  # a handful of languages
        rows.where(F.col("language") == name).drop("language").write.parquet(f"{path}/{name}.parquet")
    got = readers.char_span_parquet(spark, f"{path}/*.parquet", folders=True)
    return got.select("language", "doc_id", F.size("char_spans").cast("long").alias("n"))


@query("json_array_read", "SELECT item_id, text FROM benchmark")
def json_array_read(spark, d):
    """One JSON array for each batch of items."""
    path = folder(spark)
    rows = read(spark, d, "benchmark").select("item_id", "text", (F.col("item_id") % 4).alias("batch"))
    sinks.write_batches(rows, path, "batch", "item_id")
    return readers.json_array(spark, path, "item_id bigint, text string").select("item_id", "text")


@query("chat_write", f"{ONE} SELECT doc_id, type AS query_type, count(*) AS n FROM gold GROUP BY ALL")
def chat_write(spark, d):
    """Chat rows as JSON lines: what is asked, and the surfaces that answer it."""
    path = folder(spark)
    records = with_spans(spark, d, x=GOLD).where(F.size("x") > 0).select("doc_id", F.transform("x", lambda e: F.struct(e["type"].alias("type"), e["surface"].alias("surface"))).alias("entities"), F.array_distinct("x.type").alias("query_types"))
    rows = C.chat_rows(records)
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    asked = F.concat(F.lit("Text: "), "doc_id", F.lit("\nType: "), "query_type")
    sinks.write_chat(rows.select(F.array(message("system", F.lit("Extract.")), message("user", asked), message("assistant", F.col("answer"))).alias("messages")), path)
    got = spark.read.schema("messages array<struct<role:string,content:string>>").json(path)
    user = F.split(F.col("messages")[1]["content"], "\n")
    return got.select(F.substring_index(user[0], " ", -1).cast("long").alias("doc_id"), F.substring_index(user[1], " ", -1).alias("query_type"), F.size(F.from_json(F.col("messages")[2]["content"], "array<string>")).cast("long").alias("n"))


@query("tsv_log_append", "SELECT lang AS run, count(*) AS n, round(avg(n_chars), 4)::VARCHAR AS score FROM documents WHERE lang IS NOT NULL GROUP BY 1 UNION ALL SELECT 'all', count(*), 'none' FROM documents")
def tsv_log_append(spark, d):
    """Two runs append to one log."""
    path = folder(spark)
    rows = docs(spark, d, "lang", "n_chars")
    sinks.append_tsv(rows.where("lang IS NOT NULL").groupBy(F.col("lang").alias("run")).agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 4).cast("string").alias("score")), path)
    sinks.append_tsv(rows.agg(F.lit("all").alias("run"), F.count("*").alias("n"), F.lit("none").alias("score")), path)
    return spark.read.option("sep", "\t").option("header", True).schema("run string, n bigint, score string").csv(path)


@query("failure_output", f"""{ONE}{BROKEN}, c AS (SELECT doc_id, count(*) FILTER (e <= s) AS bad FROM b GROUP BY 1) SELECT 'failed' AS part, count(*) FILTER (bad > 0) AS n FROM c UNION ALL SELECT 'accepted', count(*) FILTER (bad = 0) FROM c""")
def failure_output(spark, d):
    """Records with an empty span go to a file of failures, all others to the accepted ones."""
    from .queries import broken_spans

    rows = broken_spans(spark, d).where(F.size("x") > 0).select(F.col("doc_id").alias("source_id"), F.lit("xx").alias("language"), F.exists("x", lambda e: e["e"] <= e["s"]).alias("bad"))
    good, failed = sinks.outcomes(rows, F.when(F.col("bad"), "empty_span"))
    path = folder(spark)
    good.write.json(f"{path}/good")
    failed.write.json(f"{path}/failed")
    return spark.read.json(f"{path}/failed").agg(F.lit("failed").alias("part"), F.count("*").alias("n")).union(spark.read.json(f"{path}/good").agg(F.lit("accepted"), F.count("*")))


@query("detokenized", f"""WITH {TAGGED} SELECT doc_id, array_to_string(ws, ' ') || '. (' || ws[1] || '), ' || ws[-1] || '!' AS text, (length(array_to_string(ws, ' ')) + 3)::INT AS place FROM t""")
def detokenized(spark, d):
    """Tokens with signs among them become text: blanks are left out before and after certain signs."""
    signs = lambda *x: F.array(*[F.lit(c) if isinstance(c, str) else c for c in x])
    tokens = F.concat("tokens", signs(".", "(", F.col("tokens")[0], ")", ",", F.element_at("tokens", -1), "!"))
    rows = sentences(spark, d).select("doc_id", F.size("tokens").alias("n"), P.detokenized(tokens, F.lit(False)).alias("x"))
    return rows.select("doc_id", "x.text", F.get(F.col("x.offsets"), F.col("n") + 2)["start"].alias("place"))


@query("script_dialogue", "SELECT conv_id, count(*) AS n, sha256(string_agg(role || '=' || trim(regexp_replace(text, '[\\s:：「」]+', ' ', 'g')), '|' ORDER BY turn)) AS digest FROM conversations GROUP BY 1")
def script_dialogue(spark, d):
    """Conversations written as a script, a line for each turn, and read again."""
    plain = F.trim(F.regexp_replace("text", r"[\s:：「」]+", " "))
    rows = read(spark, d, "conversations").withColumn("text", plain)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["speaker"], F.lit(":「"), t["text"], F.lit("」"))), "\n")
    got = C.gather_turns(rows).select("conv_id", readers.script_dialogue(lines).alias("t"))
    return got.select("conv_id", F.size("t").cast("long").alias("n"), F.sha2(F.array_join(F.transform("t", lambda t: F.concat(t["speaker"], F.lit("="), t["text"])), "|"), 256).alias("digest"))


@query("role_tags", "SELECT conv_id, count(*) FILTER (role <> 'system' AND trim(text, E' \\n\\t\\r') <> '') AS n, count(*) FILTER (role = 'user' AND trim(text, E' \\n\\t\\r') <> '') AS asked FROM conversations GROUP BY 1")
def role_tags(spark, d):
    body = F.array_join(F.transform("turns", lambda t: F.concat(F.lit("<|"), t["speaker"], F.lit("|>\n"), t["text"], F.lit("</s>"))), "\n")
    got = C.gather_turns(read(spark, d, "conversations")).select("conv_id", readers.role_tags(F.concat(F.lit("<|system|>be kind</s>"), body)).alias("t"))
    return got.select("conv_id", F.size("t").cast("long").alias("n"), F.size(F.filter("t", lambda t: t["speaker"] == "user")).cast("long").alias("asked"))


@query("window_records", f"""WITH {WINDOWS}, x AS (SELECT conv_id, s // 2 AS w, count(*) OVER (PARTITION BY conv_id) AS n, len(t[s + 1 : s + 4]) AS turns FROM w)
SELECT CASE WHEN n > 1 THEN conv_id || '__w' || w ELSE conv_id::VARCHAR END AS source_id, CASE WHEN n > 1 THEN conv_id || '_w' || w ELSE conv_id::VARCHAR END AS legacy_id, conv_id::VARCHAR AS base, turns::INT AS turns FROM x""")
def window_records(spark, d):
    """Windows as records, with both forms of their ids and the id they come from."""
    from glossweave.functions import text as T

    rows = C.turn_windows(C.gather_turns(read(spark, d, "conversations")))
    id = lambda sign: F.when(F.col("n_windows") > 1, F.concat("conv_id", F.lit(sign), "w")).otherwise(F.col("conv_id").cast("string"))
    rows = rows.select(id("__w").alias("source_id"), id("_w").alias("legacy_id"), F.size("window").alias("turns"))
    return rows.select("source_id", "legacy_id", T.base_id(F.col("source_id")).alias("base"), "turns")


#: A vocabulary file's form: languages, each with lists of phrases.
VOCABULARY = {"xx": {"weekdays": ["lundi"], "months": ["mois de mai"], "year_words": ["il y a {X} ans"], "vague": ["naguère", " "]}, "note": "not a table"}
ASKED = ["lundi", "Lundi ", "un lundi", "mois  de mai", "il y a 12 ans", "il y a X ans", "naguère", "x"]
GRADES = ["Day", "Day", "Day", "Month", "Year", "Day", "Vague", "Day"]
FOUND = ["Day", "Day", "", "Month", "Year", "", "Vague", ""]


@query("granularity_vocabulary", f"SELECT doc_id, {GRADES!r}[doc_id % {len(ASKED)} + 1] AS granularity, {FOUND!r}[doc_id % {len(ASKED)} + 1] AS matched FROM documents")
def granularity_vocabulary(spark, d):
    """Phrases of a vocabulary file, written and read; a phrase must be the whole surface."""
    import json

    path = folder(spark)
    spark.createDataFrame([(json.dumps(VOCABULARY),)], "value string").coalesce(1).write.text(path)
    own = G.load_vocabulary(spark, path)
    surface = F.element_at(F.array(*map(F.lit, ASKED)), (F.col("doc_id") % len(ASKED) + 1).cast("int"))
    return docs(spark, d).select("doc_id", G.granularity(surface, own).alias("g")).select("doc_id", "g.granularity", F.array_join("g.matched_categories", ",").alias("matched"))
