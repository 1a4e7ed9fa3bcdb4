import json

from pyspark.sql import functions as F

from glossweave.operators import core as C
from glossweave.plans.silver import silver
from glossweave.sources import sinks


def test_batches_and_chat(spark, tmp_path):
    rows = spark.createDataFrame([(2, "zwei", 0, 1), (1, "één", 0, 1), (3, None, 1, 1), (4, "left out", None, 1)], "id int, t string, b int, _private int")
    got = {r["b"]: json.loads(r["value"]) for r in sinks.batch_arrays(rows, "b", "id").collect()}
    assert got == {0: [{"id": 1, "t": "één"}, {"id": 2, "t": "zwei"}], 1: [{"id": 3}]}
    sinks.write_batches(rows, str(tmp_path / "batches"), "b", "id")
    assert sorted(p.name for p in (tmp_path / "batches").glob("b=*")) == ["b=0", "b=1"]
    chat = spark.range(1).select("id", F.expr("array(named_struct('role', 'user', 'content', 'ü'))").alias("messages"))
    sinks.write_chat(chat, str(tmp_path / "chat"))
    assert [json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "chat")).collect()] == [{"messages": [{"role": "user", "content": "ü"}]}]


def test_tsv_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for run in ("a", "b"):
        sinks.append_tsv(spark.createDataFrame([(run, 0.5, None)], "run string, score double, note string"), path)
    got = spark.read.option("sep", "\t").option("header", True).csv(path).orderBy("run").collect()
    assert [(r["run"], r["score"], r["note"]) for r in got] == [("a", "0.5", None), ("b", "0.5", None)]


def test_outcomes_and_stats(spark, tmp_path):
    rows = spark.createDataFrame([("1", "en", "x"), ("2", "de", "")], "source_id string, language string, text string")
    good, bad = sinks.outcomes(rows, F.when(F.col("text") == "", "no text"))
    assert [tuple(r) for r in good.collect()] == [("1", "en", "x")] and [tuple(r) for r in bad.collect()] == [("2", "de", "no text")]
    sinks.write_stats(good.agg(F.count("*").alias("n")), str(tmp_path / "stats"))
    assert [r["n"] for r in spark.read.json(str(tmp_path / "stats")).collect()] == [1]


def test_silver(spark):
    turns = [(1, 0, "user", "talk with Anna"), (1, 1, "bot", "He said so"), (2, 0, "user", "nothing here"), (3, 0, "user", "that it is")]
    rows = C.gather_turns(spark.createDataFrame(turns, "conv_id int, turn int, role string, text string"))
    got = {r["id"]: ([tuple(e) for e in r["entities"]], r["flagged"]) for r in silver(rows, "(that|with)").collect()}
    assert got == {"1": ([(0, 10, 14, "Anna")], False), "3": ([], True)}
