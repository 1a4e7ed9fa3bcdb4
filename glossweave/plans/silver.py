"""Silver labelling end to end: windows, keyword prefilter, annotation by a provider, cleaning, flags."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.functions import text as T
from glossweave.functions import vocabulary as V
from glossweave.operators import core as C

from .queries import WINDOWS, read
from .registry import query

#: A window with none or more than so many entities is flagged for review.
MOST = 10


def first_name(text: Column) -> Column:
    """An offline provider: the first capitalised word of a turn, as (surface, start, end); null if there is none."""
    surface = F.regexp_extract(text, "[A-Z][a-z]+", 0)
    start = F.instr(text, surface) - 1
    return F.when(surface != "", F.struct(surface.alias("surface"), start.alias("start"), (start + F.length(surface)).alias("end")))


def silver(conversations: DataFrame, keyword: str, provider: Callable[[Column], Column] = first_name) -> DataFrame:
    """Rows (id, n_windows, entities, flagged) of the windows that hold the keyword; entities have their turn's number.

    Pronouns and repeated entities go; so does an entity whose surface isn't at its place.
    """
    windows = C.turn_windows(conversations)
    kept = windows.where(F.array_join("window.text", " ").rlike(keyword))
    own = F.col("conv_id").cast("string")
    id = F.when(F.col("n_windows") > 1, F.concat(own, F.lit("__w"), F.col("w"))).otherwise(own)
    placed = F.transform("window", lambda t, i: F.struct(i.alias("turn_index"), t["text"].alias("text"), provider(t["text"]).alias("e")))
    fits = lambda x: x["e"].isNotNull() & C.valid_span(x["text"], x["e"]["surface"], x["e"]["start"], x["e"]["end"]) & ~T.is_pronoun(x["e"]["surface"])
    entity = lambda x: F.struct(x["turn_index"].alias("turn_index"), x["e"]["start"].alias("start"), x["e"]["end"].alias("end"), x["e"]["surface"].alias("surface"))
    entities = F.array_distinct(F.transform(F.filter(placed, fits), entity))
    out = kept.select(id.alias("id"), "n_windows", entities.alias("entities"))
    return out.withColumn("flagged", (F.size("entities") == 0) | (F.size("entities") > MOST))


_PRONOUNS = ", ".join("'" + w.replace("'", "''") + "'" for w in V.PRONOUNS)


@query("silver_end_to_end", f"""WITH {WINDOWS}, x AS (SELECT conv_id, s // 2 AS w, count(*) OVER (PARTITION BY conv_id) AS n, t[s + 1 : s + 4] AS win FROM w),
k AS (SELECT CASE WHEN n > 1 THEN conv_id || '__w' || w ELSE conv_id::VARCHAR END AS id, win FROM x WHERE regexp_matches(array_to_string(list_transform(win, lambda y: y.text), ' '), '(^|[^a-z])(that|with)([^a-z]|$)')),
e AS (SELECT id, i - 1 AS turn_index, regexp_extract(win[i].text, '[A-Z][a-z]+') AS surface, strpos(win[i].text, regexp_extract(win[i].text, '[A-Z][a-z]+')) - 1 AS start FROM k, unnest(generate_series(1, len(win))) g(i)),
f AS (SELECT * FROM e WHERE surface <> '' AND lower(trim(surface)) NOT IN ({_PRONOUNS}))
SELECT k.id, coalesce(string_agg(turn_index || ':' || start || ':' || surface, ',' ORDER BY turn_index), '') AS entities, count(surface) = 0 OR count(surface) > 10 AS flagged FROM k LEFT JOIN f USING (id) GROUP BY 1""")
def silver_end_to_end(spark, d):
    out = silver(C.gather_turns(read(spark, d, "conversations")), "(^|[^a-z])(that|with)([^a-z]|$)")
    line = lambda e: F.concat_ws(":", e["turn_index"], e["start"], e["surface"])
    return out.select("id", F.array_join(F.transform("entities", line), ",").alias("entities"), "flagged")
