"""Operators on small fixtures."""

from pyspark.sql import functions as F

from lexgrid.functions import exprs as X
from lexgrid.operators import graph, headings, quality, resolve, windows
from lexgrid.operators import measure as M
from lexgrid.operators.align import positional


def test_running_base_is_the_sequential_scan(spark):
    import random

    rng = random.Random(3)
    rows = [(i, rng.randrange(60)) for i in range(400)]
    out = windows.running_base(spark.createDataFrame(rows, "i int, v int"), [], ["i"], F.col("v"), F.col("v").between(5, 50)).orderBy("i").collect()
    base = None
    for r in out:
        is_base = 5 <= r.v <= 50 and (base is None or r.v > base)
        base = r.v if is_base else base
        assert (r.is_base, r.base) == (is_base, base)


def test_positional_pairs(spark):
    a = spark.createDataFrame([("1", 1), ("2", 2), ("2", 3), ("4", 4)], "k string, x int")
    b = spark.createDataFrame([("1", 10), ("2", 20), ("3", 30)], "k string, y int")
    got = {(r.k, r.occurrence, r.x, r.y, r.method, r.status) for r in positional(a, b, "k", ["x"], ["y"]).collect()}
    assert got == {
        ("1", 1, 1, 10, "exact_key", "aligned"), ("2", 1, 2, 20, "positional_within_key", "aligned"), ("2", 2, 3, None, "positional_within_key", "left_only_occurrence"),
        ("3", 1, None, 30, "positional_within_key", "right_only"), ("4", 1, 4, None, "positional_within_key", "left_only"),
    }


def test_articles(spark):
    text = "front\n**Article 1. First** \nBody one.\n\n## **Article 2¹** \nThis article lost force.\n## **Section 144. Known** \nx\n## **Section 7. Part of the body** \n# **§ 3. Division** \n# **§ 268 Claim** \ny"
    rows = headings.lines(spark.createDataFrame([("d", text)], "d string, t string"), "d", "t").select("line_no", "line")
    got = [(r.key, r.title, r.start_line, r.end_line, r.repealed) for r in headings.articles(rows).orderBy("ordinal").collect()]
    assert got == [("1", "First", 2, 4, False), ("21", "", 5, 6, True), ("144", "Known", 7, 10, False), ("268", "Claim", 11, 12, False)]


def test_structure(spark):
    text = "**Part I. General**\n\n**Subsection 1. Basics**\n**Chapter 1.** Law (Articles 1–7)  \n**Chapter 4.** Entities  \n§ 1. Rules (Articles 8–9-1)  \n**Part II. Things**\n**Chapter 13.** Own (Article 10)"
    rows = headings.lines(spark.createDataFrame([("d", text)], "d string, t string"), "d", "t").select("line_no", "line")
    got = [(r.kind, r.number, r.label, r.art_from, r.art_to, r.part, r.subsection, r.chapter) for r in headings.structure(rows).orderBy("line_no").collect()]
    assert got == [
        ("part", "I", "General", None, None, "I", None, None), ("subsection", "1", "Basics", None, None, "I", "1", None), ("chapter", "1", "Law", 1, 7, "I", "1", "1"),
        ("chapter", "4", "Entities", None, None, "I", "1", "4"), ("section", "1", "Rules", 8, 9, "I", "1", "4"), ("part", "II", "Things", None, None, "II", None, None), ("chapter", "13", "Own", 10, 10, "II", None, "13"),
    ]


def test_classifier(spark):
    text = "# Title\n## 01.00.00.00 ORDER\n### 01.02.00.00 Symbols\n01.02.03.01 Use (see also 03.11.01.05)\n01.02.04. Short"
    rows = headings.lines(spark.createDataFrame([("d", text)], "d string, t string"), "d", "t").select("line_no", "line")
    got = [(r.code, r.level, r.parent_code, r.label, list(r.see_also)) for r in headings.classifier(rows).orderBy("line_no").collect()]
    assert got == [
        ("01.00.00.00", 1, None, "ORDER", []), ("01.02.00.00", 2, "01.00.00.00", "Symbols", []), ("01.02.03.01", 4, "01.02.03.00", "Use", ["03.11.01.05"]), ("01.02.04.00", 3, "01.02.00.00", "Short", []),
    ]


def test_cascade_with_fuzzy_tier(spark):
    items = spark.createDataFrame([(1, "d", "law on courts"), (2, "d", "about courts"), (3, "d", "law on curts"), (4, "e", "x"), (5, "d", "law on")], "i int, day string, title string")
    targets = spark.createDataFrame([(10, "d", "law on courts"), (11, "d", "decree about courts and judges"), (12, "d", "law on taxes")], "dst int, day string, title string")
    got = {r.i: (r.dst, r.method.split(":")[0]) for r in resolve.cascade(items, targets, "day", "title", fuzzy=0.8).collect()}
    assert got == {1: (10, "exact"), 2: (11, "substring"), 3: (10, "fuzzy"), 4: (None, "unresolved"), 5: (None, "unresolved")}


def test_tree_and_checks(spark):
    nodes = spark.createDataFrame([("a", None, "A"), ("b", "a", "B"), ("c", "b", "C"), ("x", "nowhere", "X"), ("y", None, " ")], "node_id string, parent_id string, label string")
    assert {r.node_id: tuple(r.labels) for r in graph.paths(spark, nodes).collect()} == {"a": ("A",), "b": ("A", "B"), "c": ("A", "B", "C"), "y": (" ",)}
    assert {(r.check, r.node_id) for r in graph.breadth_problems(nodes).collect()} == {("missing parent", "x"), ("empty label", "y")}
    q = quality.report([quality.unique(nodes, ["node_id"], "u"), quality.refers(nodes, "parent_id", nodes, "node_id", "r")])
    assert {(r.check, r.ok, r.detail) for r in q.collect()} == {("u", True, 0), ("r", False, 1)}


def test_scalars(spark):
    df = spark.createDataFrame([("  «Ush­bu» OʼZ  qonun; ", "dekabrdagi", 44)], "t string, m string, n int")
    r = df.select(X.collapse(F.lit(" a \n b ")).alias("c"), X.norm_title(F.lit(" Oʼz  Qonun; ")).alias("t"), X.month_number("m" and F.col("m")).alias("m"), X.roman(F.col("n")).alias("r"), X.tier(F.lit("law")).alias("l")).first()
    assert (r.c, r.t, r.m, r.r, r.l) == ("a b", "o'z qonun", 12, "XLIV", 3)


def test_nfc_and_ratio(spark):
    df = spark.createDataFrame([("é", "abcd", "abcx")], "a string, b string, c string")
    r = df.select(resolve.nfc("a").alias("a"), resolve.seq_ratio("b", "c").alias("r")).first()
    assert r.a == "é" and abs(r.r - 0.75) < 1e-9


def test_fuzzy_ratio_takes_every_part(spark, tmp_path):
    from difflib import SequenceMatcher

    from lexgrid.plans import catalog

    names = ["cold widget", "colder widget", "small bolt", "smaller bolts", "ring", None, "cold widget"]
    rows = [(1990 + i, f"b{i % 3 % 2}", names[i * 5 % 7]) for i in range(40)]
    spark.createDataFrame(rows, "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    expected = set()
    for i, brand, name in rows:
        found = [(-SequenceMatcher(None, name, f"{other}s").ratio(), j) for j, b, other in rows if name and other and b == brand and j != i]
        if found and min(found)[0] <= -0.8:
            expected.add((i, min(found)[1], round(-min(found)[0], 6)))
    got = {tuple(r) for r in catalog.queries()["fuzzy_ratio"](spark, str(tmp_path)).collect()}
    assert got == expected and max(expected)[0] > 2000


def test_fuzzy_against_difflib(spark, tmp_path):
    """The query's best names on a small table, against every pair."""
    import random
    from difflib import SequenceMatcher

    from lexgrid.plans import catalog

    rng = random.Random(4)
    words = ["steel", "copper", "linen", "small", "plated", "brushed"]
    parts = [(i, f"B{i % 3}", " ".join(rng.choices(words, k=rng.randint(1, 4))) + "x" * rng.randint(0, 2)) for i in range(60)]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    expected = {}
    for i, brand, name in parts:
        near = sorted((-SequenceMatcher(None, name, other + "s").ratio(), k) for k, b, other in parts if b == brand and k != i)
        if near and -near[0][0] >= 0.8:
            expected[i] = (near[0][1], round(-near[0][0], 6))
    assert {r.p_partkey: (r.q_partkey, r.ratio) for r in catalog.queries()["fuzzy_ratio"](spark, str(tmp_path)).collect()} == expected and len(expected) > 5


def test_cascade_tiers(spark):
    items = spark.createDataFrame([(1, "d", "act on land"), (2, "d", "act on lan"), (3, "d", "nothing alike"), (4, "e", "act on land"), (5, None, "act on land"), (6, "d", None), (7, "d", "act on land"), (8, "f", "abcdefghij"), (9, "g", "abcdefghij")], "i int, b string, t string")
    targets = spark.createDataFrame([(10, "d", "act on land"), (11, "d", "act on land"), (12, "d", "other thing"), (13, "f", "abcdefghiX"), (14, "g", "abcdefghiX"), (15, "g", "abcdefghiY")], "dst int, b string, t string")
    got = {r.i: (r.dst, r.method) for r in resolve.cascade(items, targets, "b", "t", fuzzy=0.8).collect()}
    assert got == {1: (11, "exact"), 2: (None, "unresolved"), 3: (None, "unresolved"), 4: (None, "unresolved"), 5: (None, "unresolved"), 6: (None, "unresolved"), 7: (11, "exact"), 8: (13, "fuzzy:0.90"), 9: (None, "unresolved")}


def test_excerpts_and_highlights(spark):
    from lexgrid.functions import display as V

    text = "a" * 500 + " Needle here " + "b" * 500
    rows = [(1, text, "needle HERE", 501, 507), (2, text, "absent", None, 3), (3, "x" * 50 + "Fuqarolik kodeksi", "absent", 5, 5), (4, "", "x", 0, 1), (5, None, None, 0, 1), (6, "short needle", "needle", 6, 12)]
    df = spark.createDataFrame(rows, "i int, t string, n string, a int, b int")
    got = {r.i: (r.e, r.h) for r in df.select("i", V.excerpt(df.t, df.n).alias("e"), V.highlight(df.t, df.a, df.b).alias("h")).collect()}
    assert got[1] == ("…" + text[101:901] + "…", text[:501] + "**Needle**" + text[507:])
    assert got[2] == (text[:400], text) and got[3] == (rows[2][1] + "…", rows[2][1]) and got[4] == ("", "") and got[5] == ("", None) and got[6] == ("short needle…", "short **needle**")
    from pyspark.sql import functions as F

    said = spark.range(1).select(V.snapshot_note(F.lit("2001-01-01"), F.lit("2011-01-01")).alias("a"), V.snapshot_note(F.lit("2010-01-01"), F.lit("2011-01-01")).alias("b"), V.snapshot_note(F.lit("no date"), F.lit("2011-01-01")).alias("c"), V.display_number(F.lit("1737"), F.lit(7), F.lit(None).cast("string")).alias("d")).first()
    assert said[:] == ("snapshot of 2001-01-01, about 10 years old", "", "", "Article 173⁷")


def test_shapes_read_patterns_as_sql_does(spark):
    """Words end at letters beyond ASCII, and (?i) knows the letters that fold to ASCII ones; a vertical tab is no white space."""
    import duckdb

    texts = ["Übob", "übob bob", "ʻmodda", "moddaʻ 1", "é1234é", "é12345", "1 ſ 2", "3 qiſm", "yo\u212ai", "1 yo\u212ai 2", "ik\u212ainchi", "\u212aband", "1\v,\v2", "1\v-\v2", "1\t-\f2", "5\vmodda", "5 moddaé", "IV\vbob", "IV bob", "4\u00a0va\u00a05", "4 va 5", "4 VA 5", "bo\u0301b", "e\u0301bob", "_bob", "9bob", "İband", "sakkızinchi", "ſakkizinchi", "paragraf", "ParaGrİf"]
    con = duckdb.connect()
    for name, pattern in M.SEPARATORS + M.SHAPES:
        got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(M.shape(F.col("t"), F.lit(""), F.lit(""))[name]).collect()]
        assert got == [con.execute("SELECT regexp_matches(?, ?)", [t, pattern]).fetchone()[0] for t in texts], name


def test_numeric_order_of_equal_texts(spark, tmp_path):
    """Where p_partkey alone tells rows apart, they come by it, however the table lies."""
    from lexgrid.plans import catalog

    keys = [1055, 55, 3055, 2055, 20, 7]
    spark.createDataFrame([(k, 49) for k in keys], "p_partkey long, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    got = {r.p_partkey: r.place for r in catalog.queries()["numeric_order"](spark, str(tmp_path)).collect()}
    assert got == {55: 1, 1055: 2, 2055: 3, 3055: 4, 7: 5, 20: 6}
