from pyspark.sql import functions as F

from glossweave.functions import python as P
from glossweave.functions import text as T
from glossweave.operators import core as C
from glossweave.sources import readers as R
from glossweave.streaming import incremental


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


def tags(spark, *tags):
    rows = [(1, i, t, 2 * i, f"t{i % 10}") for i, t in enumerate(tags)]
    return spark.createDataFrame(rows, "doc_id int, i int, tag string, start long, token string")


def test_bio_islands(spark):
    got = C.bio_islands(tags(spark, "I-A", "I-A", "B-A", "I-B", "O", "I-B", "x", "B-B")).orderBy("first").select("type", "first", "last_end").collect()
    assert [tuple(r) for r in got] == [("A", 0, 2), ("A", 2, 3), ("B", 3, 4), ("B", 5, 6), ("B", 7, 8)]


def test_io_islands(spark):
    got = C.io_islands(tags(spark, "I-A", "I-A", "I-B", "O", "I-B")).orderBy("first").select("type", "first", "last_end").collect()
    assert [tuple(r) for r in got] == [("A", 0, 2), ("B", 2, 3), ("B", 4, 5)]


def test_spans_count_code_points(spark):
    text, surface = F.lit("😀ab ab"), F.lit("ab")
    assert one(spark, C.occurrences(text, surface)) == [1, 4]
    assert one(spark, C.nearest_place(text, surface, F.lit(3))) == 4
    assert one(spark, C.valid_span(text, surface, F.lit(-1), F.lit(2))) is False
    assert tuple(one(spark, C.shifted_span(text, surface, F.lit(0), F.lit(3)))) == (1, 0) and one(spark, C.shifted_span(text, surface, F.lit(0), F.lit(2))) is None


def test_turn_windows(spark):
    for n, sizes in ((1, [1]), (4, [4]), (5, [4, 3]), (6, [4, 4]), (7, [4, 4, 3])):
        rows = spark.createDataFrame([(1, i, "a", str(i)) for i in range(n)], "conv_id int, turn int, role string, text string")
        assert [len(r["window"]) for r in C.turn_windows(C.gather_turns(rows)).orderBy("w").collect()] == sizes


def test_chunks():
    text = "Ein Satz. " * 500
    cut = P.chunk(text)
    assert all(text[o : o + len(t)] == t and len(t) <= 2000 for t, o in cut)
    assert cut[0][0].endswith(". ") and cut[-1][1] + len(cut[-1][0]) == len(text)
    assert P.chunk("") == [("", 0)] and [o for _, o in P.chunk("x" * 4500)] == [0, 1800, 3600]
    assert P.fuzzy_place("the brown fox", "brawn", 3) == 4 and P.fuzzy_place("abc", "xyz", 0) == -1


def test_normal_forms(spark):
    got = spark.createDataFrame([("ＡＢ",), ("ascii",), (None,), ("ﬁ",)], "t string").select(P.nfkc(F.col("t")).alias("x")).collect()
    assert [r["x"] for r in got] == ["AB", "ascii", None, "fi"]


def test_types_and_lexicons(spark):
    assert one(spark, T.sync_type(F.lit("DATE -> Day"))) == "DATE/Day" and one(spark, T.sync_type(F.lit("MISC"))) is None
    assert one(spark, T.canonical_type(F.lit("DATE:Holiday"))) == "DATE"
    assert one(spark, T.event_subtype(F.lit("the wedding party"))) == "EVENT/Life"
    assert one(spark, T.event_subtype(F.lit("Hunger Games"))) is None
    assert one(spark, T.relation_subtype(F.lit("my best friend's"))) == "RELATIONSHIP_REF/Friend"
    assert one(spark, T.relation_subtype(F.lit("the tall aunt"))) == "RELATIONSHIP_REF/Family"
    assert one(spark, T.is_specific(F.lit("Mom"), F.lit(""))) and not one(spark, T.is_specific(F.lit("boss"), F.lit("my boss")))
    assert one(spark, T.is_specific(F.lit("coach"), F.lit("Ann's coach said")))
    assert one(spark, T.has_keyword(F.lit("ask your Mother-in-law"))) and not one(spark, T.has_keyword(F.lit("momentum")))
    assert one(spark, T.json_list(F.lit("```json\n[1, 2]\n```"))) == "[1, 2]" and one(spark, T.json_list(F.lit("none"))) is None
    assert one(spark, T.base_id(F.lit("a__w3_canonical"))) == "a"


def test_islands_within_rows():
    import pyarrow as pa

    tokens = pa.array([["Ab", "cdé", "x"], None, [], ["lm", "Zz", "q"], ["a", "b"]])
    tags = pa.array([["B-A", "I-A", "O"], None, [], ["I-B", "B-A", "I-B"], ["I-B", "O"]])
    got = [[tuple(s.values()) for s in r] for r in P.islands(tokens, tags).to_pylist()]
    assert got == [[("A", 0, 2, 0, 6, "Ab cdé")], [], [], [("B", 0, 1, 0, 2, "lm"), ("A", 1, 2, 3, 5, "Zz"), ("B", 2, 3, 6, 7, "q")], [("B", 0, 1, 0, 1, "a")]]
    assert P.islands(tokens[1:4], tags[1:4]).to_pylist() == P.islands(tokens, tags).to_pylist()[1:4]


def test_mentions_and_repairs():
    assert P.assign("Ann met Bob, Ann left", ["Ann", "Bob", "Ann", "Ann"]) == [0, 8, 13, None]
    assert P.assign("Ann met Bob, Ann left", ["Ann", "Ann"], [20, None]) == [13, 0]
    assert P.assign("ＡＢ x", ["AB"]) == [0] and P.assign("", [""]) == [None]
    assert P.mended("a Bob b", "Bob", 2, 5)["way"] == "exact" and P.mended("a Bob b", "Bob", 0, 3) == {"start": 2, "end": 5, "surface": "Bob", "way": "nearest"}
    assert P.mended("see Roberta now", "Robarta", 3, 10) == {"start": 4, "end": 11, "surface": "Roberta", "way": "fuzzy"} and P.mended("abc", "xyz", 0, 3)["way"] == "dropped"
    assert P.shift("x ﬁ", ("ﬁ", "fi"), 2, 2) == {"d_start": 0, "d_end": 1} and P.shift("x fi", ("ﬁ", "fi"), 2, 4) == {"d_start": 0, "d_end": 0}


def test_joined_tokens():
    assert P.joined(["Hi", ",", "(", "you", ")", "!"]) == ("Hi, (you)!", [(0, 2), (2, 3), (4, 5), (5, 8), (8, 9), (9, 10)])
    assert P.joined(["東京", "は", "big", "city"], True)[0] == "東京はbig city" and P.joined([]) == ("", [])


def test_containing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three"), (2, "two"), (3, None), (4, "")], "doc_id int, text string")
    items = spark.createDataFrame([(1, "two"), (2, "o t"), (3, ""), (4, None), (5, "two"), (6, "four")], "item int, text string")
    for most in (C.AUTOMATON, 70):
        monkeypatch.setattr(C, "AUTOMATON", most)
        assert sorted(map(tuple, C.containing(docs, items, "item").collect())) == [(1, 2), (2, 1), (3, 3), (5, 2)]


def test_readers(spark, tmp_path):
    (tmp_path / "x.conll").write_text("# id s1\nAnn _ _ B-PER\nran _ _ O\n\n# id s2\nOslo _ _ B-LOC\n")
    assert sorted((r["id"], r["tokens"], r["tags"]) for r in R.conll(spark, str(tmp_path / "x.conll")).collect()) == [("s1", ["Ann", "ran"], ["B-PER", "O"]), ("s2", ["Oslo"], ["B-LOC"])]
    (tmp_path / "x.tsv").write_text('#\tn\n1\t"\tO\tO\n2\tBonn\tB-LOC\tO\n\n1\tx\tO\tO\n')
    assert sorted(r["tokens"] for r in R.tsv_bio(spark, str(tmp_path / "x.tsv")).collect()) == [['"', "Bonn"], ["x"]]
    annotated = F.lit("I saw <Ann:PS> in <Oslo:LC>.")
    assert one(spark, R.markup_text(annotated)) == "I saw Ann in Oslo."
    assert [tuple(s) for s in one(spark, R.markup_spans(annotated, ["LC"]))] == [("Oslo", "LC", 13, 17)]
    assert [tuple(t) for t in one(spark, R.script_dialogue(F.lit("A:「hi」\nthere\nB：yo")))] == [("A", "hi \nthere"), ("B", "yo")]
    assert [tuple(t) for t in one(spark, R.role_tags(F.lit("<|system|>x<|user|>hi</s><|assistant|>yo")))] == [("user", "hi"), ("assistant", "yo")]
    (tmp_path / "r.jsonl").write_text('{"text": "a", "source": "s"}\n\nbroken\n{"text": "b"}\n')
    assert tuple(R.preflight(spark, str(tmp_path / "r.jsonl"), ["text", "source"]).first()) == (3, 1, 1, 2)


def test_stream_resumes(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for n, texts in enumerate((["a", "a", "b"], ["b", "c"])):
        spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.mode("append").json(source)
        incremental.append(incremental.dedup(incremental.new_records(spark, source, "text string")), out, checkpoint).awaitTermination()
        assert sorted(r["text"] for r in spark.read.parquet(out).collect()) == (["a", "b"] if n == 0 else ["a", "b", "c"])


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert C.tokens(none).count() == 0 and C.stratified_split(C.with_hash(none), ["lang"], "text_hash").count() == 0
    assert C.matched(*[spark.createDataFrame([], "doc_id int, type string")] * 2, ["doc_id", "type"]).count() == 0


def test_merging_records(spark):
    from glossweave.operators import records as R

    kind = "ord int, source string, source_id string, language string, confidence string, provenance array<string>, text string, turns array<struct<speaker:string,text:string>>, entities array<struct<surface:string,type:string,start:int,end:int>>"
    rows = [
        (2, "b", "2", "en", "human-gold", ["b", "a"], "ﬁne Ann", None, [("Ann", "P", 4, 7)]),
        (1, "a", "1", "en", "silver", ["a"], "fine Ann", None, [("fine", "Q", 0, 4), ("Ann", "P", 5, 8)]),
        (3, "c", "3", "en", "gold", ["c"], "fine Ann", None, [("Ann", "R", 5, 8), ("gone", "P", 9, 13)]),
        (4, "d", "4", "en", "gold", ["d"], None, [("x", "hi"), ("y", "yo")], [("hi", "P", 0, 2)]),
        (5, "e", "5", "en", "gold", ["e"], None, [("z", "hi"), ("y", "yo")], [("yo", "P", 0, 2)]),
        (6, "f", "6", "en", "gold", [], "", None, []),
    ]
    frame = C.with_hash(spark.createDataFrame(rows, kind), C.record_text(F.col("text"), F.col("turns")))
    got = {r["source_id"]: r for r in R.merge_by_text(frame).collect()}
    assert sorted(got) == ["1", "4", "6"] and (got["1"]["n"], got["1"]["confidence"], got["1"]["provenance"]) == (3, "human-gold", ["a", "b", "c"])
    assert [tuple(e) for e in got["1"]["entities"]] == [("fine", "Q", 0, 4), ("Ann", "P", 5, 8), ("Ann", "R", 5, 8), ("gone", "P", 9, 13)]
    assert [tuple(e) for e in got["4"]["entities"]] == [("hi", "P", 0, 2)] and got["6"]["entities"] == [] == got["6"]["provenance"]
    assert R.merge_by_text(frame.limit(0)).count() == 0


def test_realigned_entities():
    from glossweave.operators.records import aligned

    rows = [(True, "off", "P", 3, 6), (False, "Ann", "P", 0, 3), (False, "fine", "P", 9, 13), (False, "not", "P", 0, 3), (False, "Ann", "P", 5, 8)]
    assert [tuple(e.values()) for e in aligned("fine Ann", rows)] == [("off", "P", 3, 6), ("Ann", "P", 5, 8), ("fine", "P", 0, 4)]


def test_negatives(spark):
    import numpy as np

    from glossweave.operators import records as R

    types, weights = ["a", "b", "c", "d"], np.cumsum([100.0, 1, 1, 1])
    got = [R.drawn(str(k), {"b"}, types, weights, 42) for k in range(400)]
    assert all("b" not in g and 2 <= len(g) <= 3 and g == sorted(set(g)) for g in got) and sum("a" in g for g in got) > 350
    assert R.drawn("x", set(), [], np.array([]), 1) == []
    counts = spark.createDataFrame([("a", 4), ("a", 5), ("h", 9), ("", 9), ("b", 1), ("c", 1)], "type string, n long")
    rows = spark.createDataFrame([("1", ["a"]), ("2", None)], "k string, p array<string>")
    out = [set(r["x"]) for r in rows.select(R.negatives(F.col("k"), F.col("p"), counts, {"h"}).alias("x")).collect()]
    assert out[0] == {"b", "c"} and out[1] <= {"a", "b", "c"}


def test_first_of_strata(spark):
    from glossweave.operators import records as R

    rows = [(i, ["a", None, "b"][min(2, i // 500)], format(i * 7919 % 400 * 99, "05x")) for i in range(1010)]
    frame = spark.createDataFrame(rows, "id int, s string, h string")
    for quota, want in ((F.lit(3), 3), (F.floor(F.col("n") * 0.1), None), (F.lit(0), 0), (F.lit(10**6), 10**6)):
        got = R.first_of_strata(frame, ["s"], F.col("h"), "id", quota)
        assert got.count() == len(rows)
        for s in ("a", None, "b"):
            own = sorted((h, i) for i, x, h in rows if x == s)
            n = len(own) // 10 if want is None else want
            assert sorted(r["id"] for r in got.where(F.col("s").eqNullSafe(s) & F.col("chosen")).collect()) == sorted(i for _, i in own[:n])
    split = C.stratified_split(frame, ["s"], "id", seed=1)
    assert {r["s"]: r["n"] for r in split.where("split = 'val'").groupBy("s").agg(F.count("*").alias("n")).collect()} == {"a": 25, None: 25, "b": 1}


def test_blocks_that_blank_lines_part(spark, tmp_path):
    (tmp_path / "x.conll").write_bytes(b"# id s1\r\nAnn _ _ B-PER\r\n\r\n# id s2\r\nOslo _ _ B-LOC\r\n \t\r\n# id s3\r\nBonn _ _ B-LOC\r\n")
    assert sorted((r["id"], r["tokens"]) for r in R.conll(spark, str(tmp_path / "x.conll")).collect()) == [("s1", ["Ann"]), ("s2", ["Oslo"]), ("s3", ["Bonn"])]


def test_packed_entities(spark):
    import pyarrow as pa

    from glossweave.operators import records as R

    long = [{"surface": "é😀" * (i % 3), "type": f"T{i % 4}", "start": i * 7 % 50, "end": i} for i in range(1200)]
    rows = [None, [], long, [{"surface": None, "type": "P", "start": 1, "end": None}, None], [{"surface": "x", "type": "", "start": -(2**31), "end": 2**31 - 1}], long[:1]]
    for several in (1, 2, 500):
        got = [R.unpack(b) for b in R.pack(pa.array(rows, R._LIST)[0:], several).to_pylist()]
        assert got == [[tuple((e or dict.fromkeys(R._FIELDS)).values()) for e in row or []] for row in rows]
    plain = [R._unpacked(b) for b in R.pack(pa.array([long, [], long[:1]], R._LIST)).to_pylist()]
    assert R._entities(plain).to_pylist() == [long, [], long[:1]] and R.pack(pa.array([], R._LIST)).to_pylist() == []


def test_entities_are_joined_in_order_of_appearance(spark):
    from glossweave.operators import records as R

    kind = "ord int, source string, source_id string, language string, confidence string, provenance array<string>, text string, entities array<struct<surface:string,type:string,start:int,end:int>>"
    own = {1: [("b", "P", 2, 3), ("a", "P", 0, 1), ("a", "P", 0, 1)], 2: [("a", "Q", 0, 1), ("b", "P", 2, 3)], 0: None}
    frame = C.with_hash(spark.createDataFrame([(i, "s", str(i), "en", "gold", [f"p{i % 3}"], "a b", own[i % 3]) for i in range(300)], kind))
    row = R.merge_by_text(frame.repartition(7)).first()
    assert row["n"] == 300 and row["source_id"] == "0" and row["provenance"] == ["p0", "p1", "p2"]
    assert [tuple(e) for e in row["entities"]] == [("b", "P", 2, 3), ("a", "P", 0, 1), ("a", "Q", 0, 1)]


def test_texts_cut_in_slices(monkeypatch):
    import pyarrow as pa

    from glossweave.functions import python as P
    from glossweave.plans import queries as Q

    texts = [None, "", " ", "Ab  É abcd abcdefgh", "abcdefgh Abcdefghi x", None, "abcdefghi"]
    tag = lambda t, n: f"B-{Q.TAGGED[len(t) % 3]}" if "A" <= t < "[" else f"I-{Q.TAGGED[len(t) % 3]}" if len(t) >= n else "O"
    least = [8, 8, 8, 8, 9, 9, 8]
    tokens = [None if t is None else t.split(" ") for t in texts]
    want = P.islands(pa.array(tokens), pa.array([None if t is None else [tag(x, n) for x in t] for t, n in zip(tokens, least, strict=True)])).to_pylist()
    for size in (1, 4, 1 << 17):
        monkeypatch.setattr(P, "SLICE", size)
        assert P.text_islands(pa.array(texts), pa.array(least), Q.tag_codes, Q.TAGGED).to_pylist() == want


def test_conversion_merges_once(spark):
    from glossweave.plans.registry import QUERIES

    plan = QUERIES["convert_all"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [doc_id") <= 2  # texts, and lists of entities; each further reading would shuffle again
