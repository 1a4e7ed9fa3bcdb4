"""Quality rules, line first, in DataFrame functions alone.

Each line is judged by punctuation, navigation and boilerplate rules; lines that fail are removed,
and a document that loses too much of its text is rejected. The base rules reject documents that are
too short or repeat themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Java's classes for the six separators, and what is left.
_SEPARATORS = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT, MAX_LOST_PERCENT = 8, 20, 30, 50
#: A line may have one symbol for so many words.
WORDS_PER_SYMBOL = 4
_TERMINAL = r"""[.!?…。！？:;,"'”’)\]][\x20\x09-\x0D]*$"""
_BOILERPLATE = r"(?iu)(licensed under|all rights reserved|terms of (use|service)|privacy policy|cookie|copyright|subscribe to|lorem ipsum|enable javascript)"
_NAVIGATION = r"(?iu)^[\x20\x09-\x0D]*(home|menu|next|previous|login|log in|sign up|search|back to top|read more|click here)\b.{0,40}$"


def _let(value: Column, then) -> Column:
    """then(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _SEPARATORS), lambda w: w != "")


def repeat_words(words: Column) -> Column:
    """How many words lie in windows whose words are found twice or more in the text."""
    size = REPEAT_WINDOW

    def of_windows(hashed: Column) -> Column:
        # (hash, place) sorted: a repeated window has a neighbour with its hash
        same = lambda s, i, j: (j >= 0) & (j < F.size(s)) & (F.get(s, j)["h"] == F.get(s, i)["h"])
        often = _let(F.array_sort(hashed), lambda s: F.transform(F.filter(F.transform(s, lambda x, i: F.struct(x["i"].alias("i"), (same(s, i, i - 1) | same(s, i, i + 1)).alias("often"))), lambda x: x["often"]), lambda x: x["i"]))
        return _let(F.array_sort(often), lambda at: F.aggregate(F.transform(at, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(at, i + 1) - x, F.lit(size)))), F.lit(0), lambda a, b: a + b))

    # windows are hashed from their words' hashes; most texts repeat none, which needs no order
    windows = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - size + 1), lambda i: F.xxhash64(F.slice(h, i, F.lit(size))))
    placed = lambda w: F.transform(w, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i")))
    counted = _let(_let(F.transform(words, lambda w: F.xxhash64(w)), windows), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(of_windows(placed(w))))
    return F.when(F.size(words) > size, counted).otherwise(0).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier one."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def line_fails(line: Column) -> Column:
    """Punctuation: no end of a sentence or clause. Navigation: link lists and menus. Boilerplate: known phrases."""
    spaces = F.size(F.split(F.trim(line), " "))
    symbols = F.length(line) - F.length(F.regexp_replace(line, _SYMBOLS, ""))
    return ~line.rlike(_TERMINAL) | (symbols * WORDS_PER_SYMBOL > spaces) | line.rlike(_NAVIGATION) | line.rlike(_BOILERPLATE)


def clean(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, cleaned and kept.

    cleaned is the text without the lines that fail; kept is false if base_failed, or if cleaned has
    lost more than MAX_LOST_PERCENT of the text's words' characters. Null and empty texts have no
    words, so they fail; cleaned is then ''. Very long texts are judged whole. Rows are independent of
    each other: null ids, repeated rows and ties have no say. Other columns pass; those with an output's name are replaced.
    """
    outputs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned", "kept")
    rest = docs.drop(*[c for c in docs.columns if c.lower() in outputs])
    text, lost = F.coalesce(F.col("text"), F.lit("")), common.spare(rest, "_lost")
    cleaned = F.array_join(F.filter(F.split(text, "\n"), lambda x: ~line_fails(x)), "\n")
    counted = lambda w, c: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        repeat_words(w).alias("n_repeat_words"),
        c.alias("cleaned"),
        F.when(c == text, 0).otherwise(F.length(F.array_join(w, "")) - F.length(F.regexp_replace(c, _SEPARATORS, ""))).cast("long").alias(lost),
    )
    # one generated row, so that the rules run once, below whatever filters on them
    made = F.transform(F.array(words_of(text)), lambda w: _let(cleaned, lambda c: counted(w, c)))
    out = rest.select("*", F.inline(made))
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    out = out.withColumn("kept", ~F.col("base_failed") & (100 * F.col(lost) <= MAX_LOST_PERCENT * F.col("word_chars")))
    return out.select(*[F.col(f"`{c}`") for c in rest.columns], *outputs)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: The same rules for DuckDB. RE2 has no look-around, and none is used.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i : i + 7], ' ') AS w FROM d, unnest(generate_series(1, len(ws) - 7)) AS g(i)),
often AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, sum(least(8, coalesce(next - i, 8)))::BIGINT AS r FROM often GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::BIGINT - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))::BIGINT AS n_dup_lines,
    coalesce(r, 0)::BIGINT AS n_repeat_words,
    array_to_string(list_filter(lines, lambda x: regexp_matches(x, '[.!?…。！？:;,"''”’)\]][\x20\x09-\x0D]*$')
      AND (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g'))) * 4 <= len(string_split(trim(x), ' '))
      AND NOT regexp_matches(x, '(?i)^[\x20\x09-\x0D]*(home|menu|next|previous|login|log in|sign up|search|back to top|read more|click here)\b.{0,40}$')
      AND NOT regexp_matches(x, '(?i)(licensed under|all rights reserved|terms of (use|service)|privacy policy|cookie|copyright|subscribe to|lorem ipsum|enable javascript)')), chr(10)) AS cleaned
  FROM d LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    100 * (word_chars - length(regexp_replace(cleaned, '[\x20\x09-\x0D]+', '', 'g'))) <= 50 * word_chars AS enough FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND enough AS kept FROM b
"""
