import random

from pyspark.sql import functions as F

from glossweave.functions import granularity as G
from glossweave.functions import python as P
from glossweave.operators import core as C
from glossweave.operators import sampling as S

SURFACES = {
    "Exact": ["3:15pm", "at 8am", "noon sharp", "下午3点15分", "3時15分に", "오후 3시 15분"],
    "Hour": ["this morning", "last night", "今朝", "今天早上", "저녁에"],
    "Day": ["last Tuesday", "January 5th", "5 de septiembre de 2011", "1月5日", "2024-03-15", "어제", "unknown words", "", " \t", None],
    "Week": ["last week", "this weekend", "先週", "上周", "지난 주", "la scorsa settimana"],
    "Month": ["in March", "December 1830", "先月", "上个月", "1995年10月", "3月"],
    "Season": ["last summer", "over the holidays", "去年の夏", "지난 여름"],
    "Year": ["in 2023", "1859", "5 years ago", "2023年", "五年前", "去年", "작년"],
    "Vague": ["a while back", "recently", "しばらく前", "很久以前", "오래전에"],
}


def test_granularity(spark):
    rows = [(s, want) for want, own in SURFACES.items() for s in own]
    got = spark.createDataFrame(rows, "s string, want string").select("s", "want", G.granularity(F.col("s")).alias("g")).collect()
    assert [(r["s"], r["g"]["granularity"], r["g"]["ambiguous"]) for r in got] == [(s, want, False) for s, want in rows]
    both = spark.createDataFrame([("yesterday morning",), ("lunes",), ("hace 3 años",)], "s string")
    words = {"Day": ["lunes"], "Month": ["lunes"], "Year": ["hace {X} años"]}
    got = [r["g"] for r in both.select(G.granularity(F.col("s"), words).alias("g")).collect()]
    assert [(g["granularity"], g["ambiguous"], g["matched_categories"]) for g in got] == [("Hour", True, ["Hour", "Day"]), ("Day", True, ["Day", "Month"]), ("Year", False, ["Year"])]


def test_batch_runs_are_greedy():
    rng = random.Random(1)
    for _ in range(300):
        sizes = sorted(rng.choice([0, 0, 1, 2, 3, 5, 8, 13, 40]) for _ in range(rng.randint(0, 30)))
        want, held, used, batch = [], 0, 0, 0
        for s in sizes:
            if held and used + s > 20:
                batch, held, used = batch + 1, 0, 0
            want.append(batch)
            held, used = held + 1, used + s
        runs = S.batch_runs([(s, sizes.count(s)) for s in set(sizes)], 20)
        got = []
        for i, s in enumerate(sizes):
            k = i - sizes.index(s)
            _, first, each, b = max(r for r in runs if r[0] == s and r[1] <= k)
            got.append(b + (k - first) // each)
        assert got == want


def test_batches(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate([5, 5, 5, 30, 31, 11, None])], "id long, size long")
    got = {r["id"]: (r["lot"], r["batch"]) for r in S.batches(rows, "id", "size", 10).collect()}
    assert got == {0: ("normal", 0), 1: ("normal", 0), 2: ("normal", 1), 3: ("solo", None), 4: ("skipped", None), 5: ("solo", None), 6: ("skipped", None)}
    assert S.batches(rows.limit(0), "id", "size", 10).count() == 0


def test_quota_sample(spark):
    rows = spark.createDataFrame([(i, ["a", "b"] if i < 3 else ["b"] if i < 9 else None) for i in range(12)], "id int, keys array<string>")
    got = S.quota_sample(rows, F.col("keys"), "id", 6).collect()
    assert sorted(r["stratum"] for r in got) == ["a"] * 3 + ["b"] * 3 and len({r["id"] for r in got}) == 6
    filled = S.quota_sample(rows, F.col("keys"), "id", 11, each=2, by_size=True, fill=True).collect()
    assert len({r["id"] for r in filled}) == 11 and sum(r["stratum"] is None for r in filled) == 7
    assert S.quota_sample(rows.limit(0), F.col("keys"), "id", 5, fill=True).count() == 0


def test_label_tokens(spark):
    row = spark.createDataFrame([(["ab", "cd", "e", "fg"], [3, 0, 6, 6, 40], [5, 5, 7, 10, 44], ["B", "A", "C", "D", "E"]), (["x"], [], [], []), (None, None, None, None)], "t array<string>, a array<int>, b array<int>, c array<string>")
    got = [r["x"] for r in row.select(P.token_labels(*map(F.col, "tabc")).alias("x")).collect()]
    assert [tuple(x) for x in got[0]] == [("A", 0, 2), ("D", 2, 4)] and got[1:] == [[], []]


def test_record_errors(spark):
    base = dict(schema_version="1.0", split="train", confidence="gold", provenance=["s"], text="ab c", query_types=["A", "B", "C"], entities=[("ab", "A", 0, 2, None)])
    kind = "schema_version string, split string, confidence string, provenance array<string>, text string, query_types array<string>, entities array<struct<surface:string,type:string,start:int,end:int,turn_index:int>>"
    bad = dict(base, schema_version="2", split="x", confidence=None, provenance=[], text="", query_types=["B", "B"])
    span = dict(base, entities=[("ab", "A", 1, 3, None), ("c", "A", 3, 3, None)])
    rows = spark.createDataFrame([tuple(r.values()) for r in (base, bad, span)], kind)
    got = [r["x"] for r in rows.select(C.record_errors(F.array(F.lit("C"))).alias("x")).collect()]
    assert got[0] == ["holdout_negative"]
    assert got[1] == ["schema_version", "split", "confidence", "no_provenance", "query_types_repeat", "no_text", "surface_differs", "type_not_asked", "negatives_out_of_range"]
    assert got[2] == ["empty_span", "surface_differs", "holdout_negative"]


def test_conversation_errors(spark):
    kind = "schema_version string, split string, confidence string, provenance array<string>, turns array<struct<speaker:string,text:string>>, query_types array<string>, entities array<struct<surface:string,type:string,start:int,end:int,turn_index:int>>"
    rows = [("1.0", "val", "silver", ["s"], turns, ["A", "B", "C"], entities) for turns, entities in (
        ([("a", "hi Ann"), ("b", "yo")], [("Ann", "A", 3, 6, 0)]),
        ([("a", "hi Ann")], [("Ann", "A", 3, 6, 1)]),
        ([("a", "hi"), ("", "x")] * 3, [("Ann", "A", 0, 3, 0)]),
        (None, None),
    )]
    frame = spark.createDataFrame(rows, kind)
    got = [r["x"] for r in frame.select(C.conversation_errors().alias("x")).collect()]
    assert got[:3] == [[], ["too_few_turns", "turn_out_of_range"], ["too_many_turns", "blank_turn", "surface_differs"]] and got[3][0] == "too_few_turns"
    assert frame.select(C.conversation_errors(most=None).alias("x")).collect()[2]["x"] == ["blank_turn", "surface_differs"]
