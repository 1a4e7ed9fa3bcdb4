"""Readers: every source format as a DataFrame, without reading rows on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ENTITY = "struct<surface:string,type:string,original_type:string,start:int,end:int,turn_index:int>"
RECORD = (
    "schema_version string, source string, source_id string, language string, split string, confidence string, "
    "provenance array<string>, format string, text string, turns array<struct<speaker:string,text:string>>, "
    f"query_types array<string>, entities array<{ENTITY}>"
)


def records(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines of passages and conversations in one wide schema; blank lines are skipped."""
    return spark.read.schema(RECORD).json(list(paths))


def records_with_place(spark: SparkSession, *paths: str) -> DataFrame:
    """Records with their file and an order (file, place in it) that merges can rely on."""
    rows = spark.read.text(list(paths)).where("trim(value) <> ''").select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("ord"), "value")
    parsed = rows.select("file", "ord", F.from_json("value", f"{RECORD}, _broken string", {"columnNameOfCorruptRecord": "_broken"}).alias("record"))
    return parsed.select("file", "ord", "record", F.col("record._broken").isNotNull().alias("broken"))


def dispatched(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passages, conversations) of wide records, told apart by their format."""
    talk = F.coalesce(F.col("format") == "conversation", F.lit(False))
    return rows.where(~talk).drop("turns"), rows.where(talk).drop("text")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def char_span_parquet(spark: SparkSession, path: str, folders: bool = False) -> DataFrame:
    """Text with character spans; the language is the stem of the file, or of the folder that a writer made of it."""
    rows = spark.read.parquet(path)
    stem = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/.]+)\.parquet/[^/]*$", 1) if folders else F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1)
    return rows.withColumn("language", stem)


def token_tag_parquet(spark: SparkSession, path: str, labels: list[str]) -> DataFrame:
    """Integer tags become names of the label list."""
    names = F.array(*map(F.lit, labels))
    return spark.read.option("recursiveFileLookup", True).parquet(path).withColumn("tags", F.transform("ner_tags", lambda t: F.get(names, t)))


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of lines that blank lines part (lines of blanks, and CRLF, too); files can be split at empty lines."""
    rows = spark.read.option("lineSep", "\n\n").text(path).select(F.explode(F.split(F.regexp_replace("value", "\r", ""), r"\n[ \t]*\n")).alias("value"))
    return rows.select(F.filter(F.split(F.trim("value"), "\n"), lambda x: F.trim(x) != "").alias("lines")).where(F.size("lines") > 0)


def conll(spark: SparkSession, path: str) -> DataFrame:
    """Sentences of `token _ _ tag` lines: id of a `# id` header, tokens, tags; lines under four fields don't count."""
    fields = lambda x: F.split(F.trim(x), r"\s+")
    rows = _blocks(spark, path).select(
        F.regexp_extract(F.array_join(F.filter("lines", lambda x: x.startswith("# id")), "\n"), r"# id (\S+)", 1).alias("id"),
        F.filter("lines", lambda x: ~x.startswith("#") & (F.size(fields(x)) >= 4)).alias("own"),
    )
    return rows.select("id", F.transform("own", lambda x: fields(x)[0]).alias("tokens"), F.transform("own", lambda x: F.element_at(fields(x), -1)).alias("tags")).where(F.size("tokens") > 0)


def tsv_bio(spark: SparkSession, path: str) -> DataFrame:
    """Sentences of tab-separated `index token tag` lines; quotes mean nothing, `#` lines don't count."""
    own = F.filter("lines", lambda x: ~x.startswith("#") & (F.size(F.split(x, "\t")) >= 3))
    rows = _blocks(spark, path).select(own.alias("own")).where(F.size("own") > 0)
    return rows.select(F.transform("own", lambda x: F.split(x, "\t")[1]).alias("tokens"), F.transform("own", lambda x: F.split(x, "\t")[2]).alias("tags"))


def inline_markup(annotated: Column) -> Column:
    """Parts of `<surface:TYPE>` text in order: (plain, surface, type), the last two null between marks."""
    parts = F.regexp_extract_all(annotated, F.lit(r"(<[^<>]*:[^<>:]+>|[^<]+|<)"), F.lit(1))
    mark = r"^<([^<>]*):([^<>:]+)>$"
    of = lambda p: F.struct(
        F.when(p.rlike(mark), F.regexp_extract(p, mark, 1)).otherwise(p).alias("plain"),
        F.when(p.rlike(mark), F.regexp_extract(p, mark, 2)).alias("type"),
    )
    return F.transform(parts, of)


def markup_text(annotated: Column) -> Column:
    return F.array_join(F.transform(inline_markup(annotated), lambda p: p["plain"]), "")


def markup_spans(annotated: Column, known: list[str]) -> Column:
    """Spans (surface, type, start, end) of known types; starts are the lengths before."""
    parts = inline_markup(annotated)
    start = lambda i: F.aggregate(F.slice(parts, 1, i), F.lit(0), lambda a, p: a + F.length(p["plain"]))
    spans = F.transform(parts, lambda p, i: F.struct(p["plain"].alias("surface"), p["type"].alias("type"), start(i).alias("start"), (start(i) + F.length(p["plain"])).alias("end")))
    return F.filter(spans, lambda s: s["type"].isin(known))


def script_dialogue(text: Column) -> Column:
    """Turns (speaker, text) of `speaker:utterance` lines; a line without a colon goes on with the turn before it."""
    line = r"^([^:：\n]{1,40})[:：](.*)$"
    joined = F.regexp_replace(text, r"\n(?![^:：\n]{1,40}[:：])", "\u0001")
    turns = F.filter(F.split(joined, "\n"), lambda x: x.rlike("(?s)" + line))
    return F.transform(turns, lambda x: F.struct(F.trim(F.regexp_extract(x, "(?s)" + line, 1)).alias("speaker"), F.trim(F.translate(F.regexp_extract(x, "(?s)" + line, 2), "「」\u0001", "  \n")).alias("text")))


def forum_dialogue(posts: Column, first_poster: Column) -> Column:
    """Turns of posts; posters are letters by first appearance, the thread's first poster is A, after Z they are numbered."""
    names = F.array_distinct(F.concat(F.array(first_poster), F.transform(posts, lambda p: p["poster"])))
    at = lambda p: F.array_position(names, p["poster"]).cast("int")
    name = lambda p: F.when(at(p) <= 26, F.char(at(p) + 64)).otherwise(F.concat(F.lit("Speaker"), at(p)))
    return F.transform(posts, lambda p: F.struct(name(p).alias("speaker"), p["post_content"].alias("text")))


def alternating_turns(utterances: Column) -> Column:
    """The last utterance's history and last candidate, speakers in turn."""
    last = F.element_at(utterances, -1)
    said = F.concat(last["history"], F.array(F.element_at(last["candidates"], -1)))
    return F.transform(said, lambda x, i: F.struct(F.when(i % 2 == 0, "A").otherwise("B").alias("speaker"), x.alias("text")))


def role_tags(text: Column) -> Column:
    """Turns of `<|role|>` text; system turns go, and so do end marks."""
    whole = F.regexp_extract_all(text, F.lit(r"(?s)(<\|\w+\|>.*?)(?=<\|\w+\|>|$)"), F.lit(1))
    turn = lambda x: F.struct(F.regexp_extract(x, r"<\|(\w+)\|>", 1).alias("speaker"), F.trim(F.replace(F.regexp_replace(x, r"^<\|\w+\|>", ""), F.lit("</s>"), F.lit(""))).alias("text"))
    return F.filter(F.transform(whole, turn), lambda t: (t["speaker"] != "system") & (t["text"] != ""))


def preflight(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """One row: lines, lines that aren't JSON objects, and lines that lack each required field."""
    rows = spark.read.text(path).where("trim(value) <> ''").withColumn("v", F.try_parse_json("value"))
    lacks = [F.count_if(F.try_variant_get("v", f"$.{f}", "string").isNull()).alias(f"without_{f}") for f in required]
    return rows.agg(F.count("*").alias("lines"), F.count_if(F.col("v").isNull()).alias("broken"), *lacks)


def write_jsonl(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).json(path)
