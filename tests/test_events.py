"""Repeals, amendments, currency and links on small legal fixtures."""

from lexgrid.operators import events as E
from lexgrid.operators import links as L
from lexgrid.operators.citations import citations

REPEAL = (
    "Quyidagilar oʻz kuchini yoʻqotgan deb topilsin: 1) Oʻzbekiston Respublikasining 2001-yil 6-dekabrda qabul qilingan “Masʼuliyati cheklangan jamiyatlar toʻgʻrisida”gi 310-II-sonli Qonuni (Axborotnoma, 2002-yil) 5-moddasi; "
    "2) 1998-yil 14-mayda qabul qilingan “Davlat boji haqida”gi Qarori"
)
NOTE = (
    "(65 va 66-moddalar Oʻzbekiston Respublikasining 2021-yil 5-apreldagi OʻRQ-683-sonli Qonuni tahririda — Qonunchilik bazasi) va "
    "(moddaning ikkinchi qismi Oʻzbekiston Respublikasining 2015-yil 20-avgustdagi 391-IV-sonli Qonuniga asosan chiqarib tashlangan (2015-yil 1-oktabrdan)) (boshqa gap)"
)


def test_repeals(spark):
    df = spark.createDataFrame([(1, 10, REPEAL), (2, 11, "hech narsa"), (3, 12, None)], "row_id int, doc_id int, text string")
    got = [(r.item_no, r.cited_date, r.iso_date, r.title, r.cited_number, r.locator, r.non_statute) for r in E.repeal_items(df).orderBy("item_no").collect()]
    assert got == [
        (1, "2001-yil 6-dekabrda", "2001-12-06", "mas'uliyati cheklangan jamiyatlar to'g'risida", "310-II", "5-moddasi", False),
        (2, "1998-yil 14-mayda", "1998-05-14", "davlat boji haqida", None, None, True),
    ]


def test_amendments_and_currency(spark):
    df = spark.createDataFrame([(7, 1, "65", NOTE), (8, 1, "9", None)], "row_id int, doc_id int, host_article string, note string")
    got = E.amendments(df)
    rows = [(r.clause_no, r.target_article, r.change_type, r.amend_date, r.act_number, r.effective_date) for r in got.orderBy("clause_no", "target_article").collect()]
    assert rows == [(1, "65", "restated", "2021-04-05", "OʻRQ-683", None), (1, "66", "restated", "2021-04-05", "OʻRQ-683", None), (2, None, "removed", "2015-08-20", "391-IV-son", "2015-10-01")]
    events = E.sequence_numbers(got, ["doc_id"], ["row_id", "clause_no", "target_article"])
    current = {r.article: (r.n_events, r.last_type, r.any_voided) for r in E.article_currency(events).collect()}
    assert current == {"65": (2, "restated", False), "66": (1, "restated", False)}
    again = spark.createDataFrame([(1, "5", "a qism", "removed", "2001-01-01", 1), (1, "5", "a qism", "inserted", "2002-01-01", 2), (1, "5", "b qism", "voided", "2003-01-01", 3)], "doc_id int, host_article string, locator string, change_type string, amend_date string, event_id int")
    assert [r.is_stale for r in E.locator_status(again).orderBy("event_id").collect()] == [True, False, False]


def test_acts(spark):
    clauses = spark.createDataFrame([(1, 100, 5, None, "2001-yil 3-may"), (2, 101, 5, None, "2001-yil 2-may"), (3, 102, 6, "4-modda", "1999-yil 1-may"), (4, 103, None, None, "1999-yil 1-may")], "clause_id int, src_doc_id int, dst_doc_id int, locator string, cited_date string")
    acts = spark.createDataFrame([(5,), (6,), (7,)], "doc_id int")
    assert {r.doc_id: (r.status, r.repealed_by) for r in E.act_currency(acts, clauses).collect()} == {5: ("superseded", 101), 6: ("in-force", None), 7: ("in-force", None)}
    assert [tuple(r) for r in E.partial_repeals(clauses).collect()] == [(6, 1, "4-modda", 102)]


def test_blocks(spark):
    df = spark.createDataFrame([(1, "kirish 1-modda. bir 2-modda. ikki"), (2, "markersiz")], "d int, t string")
    assert [(r.d, r.block.strip()) for r in E.blocks(df, "d", "t").orderBy("d", "block_no").collect()] == [(1, "kirish"), (1, "1-modda. bir"), (1, "2-modda. ikki"), (2, "markersiz")]


def test_clean_spans():
    text = "Oldingi tahrirga qarang.  Fuqarolik\n kodeksi  5-moddasi LexUZ sharhi tugadi ."
    a = text.index("5-moddasi")
    out, s, e = L.clean_span(text, a, a + 9)
    assert out == "Fuqarolik kodeksi 5-moddasi tugadi" and out[s:e] == "5-moddasi"
    assert L.clean_span(text, 0, 12)[1:] == (None, None)
    assert L.clean("  a  b. ") == "a b"


def test_links(spark):
    rows = spark.createDataFrame([(1, 50, 3, False, "Fuqarolik kodeksining 5-moddasi, 3-bobining 2-paragrafi", "law"), (2, 51, 9, False, "Fuqarolik kodeksining 7-moddasi va 9-bobi", "order"), (3, 52, 4, False, "Fuqarolik kodeksi", None)], "row_id int, doc_id int, tier int, is_the_code boolean, article_text string, doc_type string")
    found = citations(spark, rows.selectExpr("row_id", "false AS allow_fk_alias", "is_the_code", "doc_type", "article_text"), ("article_text",))
    norms = spark.createDataFrame([("n5", -111189, "5", 1), ("n5#2", -111189, "5", 2)], "norm_id string, doc_id long, article_number string, occurrence int")
    nodes = spark.createDataFrame([("C3",)], "node_id string")
    got = {(r.row_id, r.target_kind, r.dst_norm_id, r.dst_struct_node_id, r.dst_ambiguous, r.dst_dangling, r.hierarchy_rel, r.confidence) for r in L.edges(found, rows.select("row_id", "doc_id", "tier", "is_the_code"), norms, nodes).collect()}
    assert got == {
        (1, "article", "n5", None, True, False, "below", 0.85), (1, "section", None, "C3", False, False, "below", 0.9), (2, "article", None, None, False, True, "unknown", 0.88), (3, "act", None, None, False, False, "below", 0.8),
    }
