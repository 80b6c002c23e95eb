import random
import zipfile
from io import BytesIO

from pyspark.sql import functions as F

from manualmill.functions import text as X
from manualmill.functions.ids import canonical_form, unit_key
from manualmill.operators import canonical as C
from manualmill.operators import orphans as O
from manualmill.operators.applicability import applicable_pairs
from manualmill.operators.chunking import ChunkRules, chunks, split_unit
from manualmill.operators.conversation import ANSWER, QUESTION, formatted
from manualmill.operators.convert import Converter, convert, table_rules, to_markdown
from manualmill.operators.evaluate import request_packing
from manualmill.operators.extract import extract
from manualmill.operators.fleet import serial_match
from manualmill.operators.profile import order_statistics
from manualmill.sources import archive, perfsql


def test_ids(spark):
    rows = [("IU1_v2",), (" iu-1_V2 ",), ("a/b/IU1_v2.XML",), ("\xa0Iu 1\t",), ("-",), ("",), (None,)]
    got = spark.createDataFrame(rows, "x string").select(canonical_form(F.col("x")).alias("c"), unit_key(F.col("x")).alias("k")).collect()
    assert [r.c for r in got] == ["IU1_v2"] * 3 + ["IU1"] + [None] * 3 and got[0].k == "IU1V2"


def test_titles(spark):
    cases = {"# A b\nx": "A b", "##\n\nfoo": "foo", "\n# late": "", "###   ": "", "#nosp": "", "#\xa0x": "x"}
    df = spark.createDataFrame([(k,) for k in cases], "md string")
    assert {r.md: r.t for r in df.select("md", X.title(F.col("md")).alias("t")).collect()} == cases


def test_order_statistics_take_upper_median(spark):
    for n in (1, 2, 5, 6, 20, 101):
        v = random.Random(n).sample(range(1000), n)
        r = order_statistics(spark.createDataFrame([("g", x) for x in v] + [("g", None)], "g string, v int"), "g", "v").first()
        s = sorted(v)
        assert (r.n, r.min, r.median, r["mean"], r.p95, r.max) == (n, s[0], s[n // 2], sum(v) // n, s[int(n * 0.95)], s[-1])


def test_canonical_cases(spark):
    base = [f"w{i}" for i in range(20)]
    rows = [
        ("one", "a b", 1), ("comment", "a <!-- x --> b", 1), ("comment", "a  b", 3), ("merge", " ".join(base[:16] + ["p"] * 3), 1), ("merge", " ".join(base[:16] + ["q", "r", "s"]), 1),
        ("split", "a b c", 1), ("split", "x y z q", 2), ("gone", None, 4), ("gone", None, 1), ("half", None, 9), ("half", "t u", 1),
    ]
    for _ in range(2):
        random.shuffle(rows)
        df = spark.createDataFrame(rows, "u string, c string, n int")
        got = {(r.canonical_id, r.resolution) for r in C.resolve(C.variants(df, "u", "c", F.col("n"))).collect()}
        assert got == {("one", "single"), ("comment", "trivial"), ("merge", "version_merge"), ("split_v1", "major_split"), ("split_v2", "major_split"), ("gone", "single"), ("half", "trivial")} or got == {
            ("one", "single"), ("comment", "trivial"), ("merge", "version_merge"), ("split_v1", "major_split"), ("split_v2", "major_split"), ("gone", "unfetchable"), ("half", "trivial")
        }


def plain_orphans(refs, recs):
    out = set()
    for table, key, t in refs:
        own = [r for r in recs if r[0] == key or (r[0].startswith(key + "_v") and r[0][len(key) + 2 :].isdigit())]
        if any(lo <= t and (de is None or de > t) for _, lo, de in own):
            continue
        out.add((table, key, "missing" if not own else "late" if all(lo > t for _, lo, _ in own) else "deleted"))
    return out


def test_orphans_equal_a_plain_model(spark):
    rng = random.Random(9)
    day = 86_400
    keys = ["IU1", "IU2", "IU3", "IU3_v1", "IU4", "IU5_v2", "IU6"]
    recs = []
    for _ in range(40):
        lo = rng.randrange(0, 60 * day, day // 2)
        recs.append((rng.choice(keys[:-1]), lo, rng.choice([None, lo + rng.randrange(0, 20 * day, day // 2)])))
    refs = [(rng.choice("ab"), rng.choice([*keys, "IU5"]), rng.randrange(0, 90 * day, day // 2)) for _ in range(400)] + [("a", "IU1", 5)] * 300
    df = spark.createDataFrame(recs, "id string, lo long, de long").selectExpr("id", "timestamp_seconds(lo) AS lo", "timestamp_seconds(de) AS de")
    parts = [O.reference_deltas(t, spark.createDataFrame([r[1:] for r in refs if r[0] == t] + [(None, 3), (" ", 4)], "k string, t long").selectExpr("k", "timestamp_seconds(t) AS t"), F.col("k"), F.col("t")) for t in "ab"]
    got = O.orphan_report(parts, O.record_deltas(df, "id", "lo", "de"))
    assert {(r.table_name, r.ref_key, r.reason) for r in got.collect()} == plain_orphans(refs, recs)
    n = sum(1 for r in refs if (r[0], r[1]) in {(x[0], x[1]) for x in plain_orphans([r], recs)})
    assert got.agg(F.sum("refs")).first()[0] == n
    deltas = parts[0].unionByName(parts[1]).unionByName(O.record_deltas(df, "id", "lo", "de"))
    whole = O.apply_deltas(None, deltas)
    steps = O.apply_deltas(O.apply_deltas(None, deltas.filter("at % 3 = 0")), deltas.filter("at % 3 <> 0"))
    assert sorted(map(str, O.current_orphans(whole).collect())) == sorted(map(str, O.current_orphans(steps).collect()))
    assert O.orphan_report([p.limit(0) for p in parts], O.record_deltas(df.limit(0), "id", "lo", "de")).count() == 0


def test_applicability_equals_nested_loops(spark):
    rng = random.Random(2)
    rules = [(f"u{i}", rng.choice("XY"), rng.choice([None, "m1", "m2", "m3"]), rng.choice([None, "t1", "t2"])) for i in range(60)]
    products = [(rng.choice("XY"), rng.randrange(8), rng.choice([None, "m1", "m2"]), rng.choice([None, "t1", "t2"])) for _ in range(40)]
    sets = {}
    for s, t, m, c in products:
        sets.setdefault((s, t), (set(), set()))
        sets[s, t][0].add(m), sets[s, t][1].add(c)
    want = {(u, t) for u, s, m, c in rules for (z, t), (ms, cs) in sets.items() if s == z and (m is None or m in ms) and (c is None or c in cs)}
    got = applicable_pairs(spark.createDataFrame(rules, "unit string, series string, app_mod string, app_tt string"), spark.createDataFrame(products, "series string, tt_id int, model_code string, tt_code string"))
    assert {tuple(r) for r in got.collect()} == want
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()


def test_serials(spark):
    rows = [("AB123", "A*100", "A*200", True), ("AB099", "A*100", "A*200", False), ("AB123", "A*100 -", "A*200", True), ("AB123", "A*100", "NULL", None), ("AB12", "A*100", "A*200", None), (None, "A", "B", None)]
    got = spark.createDataFrame(rows, "v string, a string, b string, want boolean").select("want", serial_match(F.col("v"), F.col("a"), F.col("b")).alias("m")).collect()
    assert all(r.want == r.m for r in got)


def test_perfsql(spark, tmp_path):
    text = "-- c\n\ninsert into T (a, B, c) VALUES\n('x, (y)', NULL, 1),\n('it\\'s\\n\\q', -2.5, word);\n('short', 1)\n('', null, '1')\nnot a row\n"
    data = ("﻿" + text).encode("utf-16-be")
    got = perfsql.read_dump(spark.createDataFrame([("f", data), ("empty", "no header\n(1)".encode("utf-16-be"))], "file string, content binary")).orderBy("line").collect()
    assert [list(r.vals) for r in got] == [["x, (y)", None, "1"], ["it's\nq", "-2.5", "word"], ["", None, "1"]]
    assert [list(r.kinds) for r in got] == [["string", "null", "int"], ["string", "float", "word"], ["string", "null", "string"]]
    (tmp_path / "t.perfsql").write_bytes(data)
    perfsql.register(spark)
    rows = spark.read.format("perfsql").option("columns", "C, a,zz").load(str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("1", "x, (y)", None), ("word", "it's\nq", None), ("1", "", None)]


def test_archives(spark, tmp_path):
    import zlib

    buffer = BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("iu/EN/a.xml", zlib.compress("<a>ü</a>".encode()))
        z.writestr("iu/EN/bad.xml", b"nope")
        z.writestr("iu/DE/b.xml", b"x")
    (tmp_path / "S1").mkdir()
    (tmp_path / "S1" / "docs.zip").write_bytes(buffer.getvalue())
    (tmp_path / "S1" / "broken.zip").write_bytes(b"no zip")
    rows = archive.scan(spark, str(tmp_path / "*" / "*.zip"), "iu/EN/", ".xml", archive.zlib_codec).withColumn("t", archive.as_text(F.col("content"))).collect()
    assert {(r.series, r.path, r.t, bool(r.error)) for r in rows} == {("S1", "iu/EN/a.xml", "<a>ü</a>", False), ("S1", "iu/EN/bad.xml", None, True), ("S1", None, None, True)}
    assert archive.unpad(b"abc" + b"\x05" * 5) == b"abc" and archive.unpad(b"abc\x07") == b"abc\x07"


XML = """<Service_IU><Title>T</Title><Fault_Code_Reference code="1" ecid="2">leak</Fault_Code_Reference><Fault_Code_Reference code="1" ecid="2">again</Fault_Code_Reference>
<Part_Reference> P1 </Part_Reference><Part_Reference/><Tool_Reference STName="puller">T9</Tool_Reference><Consumable_Reference csid="c">oil</Consumable_Reference><Warranty_Code code="w" time="3"/>
<IU_Reference icecode="i" ifsid="r">see</IU_Reference><IU_IFS_Link icecode="i" ifsid="l">go</IU_IFS_Link><Configuration configdata="x"/>
<Fault_Code_Resolution><Fault_Code_Reference code="7" ecid=""/><Possible_Failure_Mode>worn</Possible_Failure_Mode><Test number="1" testid="t"><Instruction>look</Instruction><Result_Action><Result>ok</Result><Action>stop</Action></Result_Action></Test></Fault_Code_Resolution></Service_IU>"""


def test_extract(spark):
    good, bad, null = (r.m for r in spark.createDataFrame([(0, XML), (1, "<a>"), (2, None)], "i int, x string").orderBy("i").select(extract(F.col("x")).alias("m")).collect())
    assert [(f.code, f.description) for f in good.fault_codes] == [("1", "leak"), ("7", "")] and good.part_numbers == ["P1"] and good.tool_references[0].name == "puller"
    assert [r.ifsid for r in good.iu_cross_references] == ["l", "r"] and good.fcr_chains[0].possible_failures == ["worn"] and good.fcr_chains[0].ccm is None
    assert good.fcr_chains[0].tests[0].results[0].action == "stop" and bad.error.startswith("ParseError") and bad.fault_codes is None and null.error is None


def test_convert(spark):
    c = Converter()
    out = c.document("<X_IU><Instruction>a</Instruction><Para>m</Para><Instruction>b</Instruction><Mystery>q</Mystery>t<Range><Min>1</Min><Max>2</Max><Unit>mm</Unit></Range><Image fileref='f.png'/></X_IU>")
    assert "<ol><li>a</li><p>m</p><li>b</li></ol>qt1–2\xa0mm<img" in out and dict(c.unknown) == {"Mystery": 1}
    assert c.document("a<Sub_Title>x</Sub_Title>") == "a<h4>x</h4>" and c.document("<a").startswith("<!-- parse error")
    assert to_markdown("<h2>A &amp; b</h2><table><tr><th>x</th><th>y</th></tr><tr><td>1</td><td>2</td></tr></table>") == "## A & b\n\n| x | y |\n|---|---|\n| 1 | 2 |"
    rows = [r.c for r in spark.createDataFrame([(0, XML), (1, "<a>"), (2, None)], "i int, x string").orderBy("i").select(convert(F.col("x")).alias("c")).collect()]
    assert rows[0].content_md.startswith("### T") and rows[0].md_length == len(rows[0].content_md) and rows[1].md_length == 0 and rows[1].error and rows[2].error


def test_chunks(spark):
    rules = ChunkRules()
    body = "sentence one. " * 700
    md = f"lead text that stands before everything, long enough to count\n\n# A\n\n{body}\n\n## B\n\n{'tiny ' * 20}\n\n## C\n\n{body}\n"
    parts = split_unit(md, rules)
    assert any(p.startswith("# A\n\n## B") and "## C" in p for p in parts) and all(len(p) // 4 >= 10 for p in parts)
    table = "| h1 | h2 |\n|---|---|\n" + "\n".join(f"| {i} | {'x' * 60} |" for i in range(400))
    cut = split_unit(table, rules)
    assert len(cut) > 3 and all(p.startswith("| h1 | h2 |\n|---|---|\n") for p in cut)
    assert len(split_unit("x" * 40_000, rules)) == 7
    rows = [("a", "w" * 39), ("b", "w" * 40), ("c", "w " * 4001), ("d", None), ("e", " " * 100), ("f", "w" * 8003)]
    got = chunks(spark.createDataFrame(rows, "u string, t string"), "u", "t").collect()
    assert {r.chunk_id for r in got} == {"b_c000", "c_c000", "f_c000"} or {r.unit for r in got} == {"b", "c", "f"}
    by = {}
    for r in got:
        by.setdefault(r.unit, []).append(r.chunk_index)
        assert r.num_chunks == sum(x.unit == r.unit for x in got)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_packing_requests(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(1, 500)) for i in range(200)] + [(500, 5000)]
    got = sorted(request_packing(spark.createDataFrame(rows, "i long, t long"), "i", "t", F.lit(0), 10, 2000).collect(), key=lambda r: r["item"])
    request, n, used = 0, 0, 0
    for r, (i, t) in zip(got, rows):
        if n and (n >= 10 or used + t > 2000):
            request, n, used = request + 1, 0, 0
        n, used = n + 1, used + t
        assert (r["item"], r.request) == (i, request)


def test_turns(spark):
    rows = [(1, 0, "user", "hi", None, None), (1, 1, "assistant", "?", [("q1", "Which model?")], None), (1, 2, "user", None, None, [("q1", ["A", "B"], None, None), ("q2", None, 3.0, None), ("q3", None, None, " free ")]), (1, 3, "user", " ", None, None)]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, text string, questions {QUESTION}, answers {ANSWER}")
    got = [r.content for r in formatted(df).orderBy("turn").collect()]
    assert got == ["hi", "?", "Which model?: A, B\nq2: 3\nq3: free", "(no response)"]


def test_every_name_of_the_table():
    rules = table_rules()
    assert len(rules) == 236 and all(rules[n].unwrap for n in ("Text_Config", "Paragraph_Config", "Para_No_Table_Config"))
    for name, r in rules.items():
        c = Converter()
        out = c.document(f"<{name} fileref='f.png'>word<Value>3</Value></{name}>")
        assert not c.unknown, name
        assert not r.handler or r.handler in c.handlers, name
        if r.strip:
            assert out == "", name
        elif r.handler in ("image", "icon"):
            assert out.startswith('<img src="f.png"'), name
        elif r.unwrap:
            assert out == "word3", name
        elif not r.handler:
            assert out.startswith(f"<{r.tag}") and "word3" in out and out.endswith(f"</{r.tag}>"), name
        else:
            assert "3" in out, name
    c = Converter()
    assert c.document("<Variable_NumMI><Physical_Data_M><Value>3</Value><Unit>mm</Unit></Physical_Data_M><Physical_Data_I><Value>1</Value></Physical_Data_I></Variable_NumMI>") == "3\xa0mm"
    assert c.document("<Range_MI><Range_M><Min_Value>1</Min_Value><Max_Value>2</Max_Value><Unit>bar</Unit></Range_M><Range_I>x</Range_I></Range_MI>") == "1\u20132\xa0bar"
