"""Derived views: each binds, in the order of what it reads, and gives what a small case says."""

from lexgrid.sources import views as V


def test_views_bind_on_empty_tables(spark):
    made = V.register(spark, {n: spark.createDataFrame([], s) for n, s in V.TABLES.items()})
    assert set(made) == set(V.VIEWS) and all(spark.table(n).count() == 0 for n in made)
    assert V.columns(spark, "v_act_currency")["derived_status"] == "string"
    assert V.reads("v_llc_realization") == {"llc_norm", "link_edge", "v_act_currency"}
    assert V.order().index("v_act_currency") < V.order().index("v_llc_realization") and V.order().index("v_locator_amendment_status") < V.order().index("v_article_currency")
    assert "v_article_currency" not in V.unread({"v_article_currency"}) and "v_act_currency" not in V.unread({"v_llc_realization"}) and "v_general_part" in V.unread({"v_llc_realization"})


def test_views_on_a_case(spark):
    row = lambda name, **cells: spark.createDataFrame([tuple(cells.get(c.strip().split()[0]) for c in V.TABLES[name].split(", "))], V.TABLES[name])
    acts = row("act", doc_id=1, doc_title="old", tier=3, status="in-force").union(row("act", doc_id=2, doc_title="new", tier=3, status="in-force"))
    nodes = row("struct_node", node_id="P1", kind="part", label_en="Part").union(row("struct_node", node_id="C1", kind="chapter", label_en="Chapter", parent_id="P1"))
    made = V.register(spark, {
        "act": acts, "repeal_clause": row("repeal_clause", clause_id=1, src_doc_id=2, dst_doc_id=1, cited_date="2001-yil 1-may"), "struct_node": nodes, "norm_unit": row("norm_unit", norm_id="n", struct_node_id="C1"),
        "article_amendment": row("article_amendment", event_id=1, doc_id=1, host_article_number="5", change_type="voided", amend_date="2001-01-01").union(row("article_amendment", event_id=2, doc_id=1, host_article_number="5", change_type="inserted", amend_date="2002-01-01")),
    })
    assert "v_realization" not in made and {"v_act_currency", "v_general_part", "v_article_currency"} <= set(made)
    assert sorted((r.doc_id, r.derived_status, r.repealed_by_title) for r in spark.table("v_act_currency").collect()) == [(1, "superseded", "new"), (2, "in-force", None)]
    assert [r.breadcrumb for r in spark.table("v_general_part").collect()] == ["Part > Chapter"]
    assert [(r.article_number, r.n_events, r.last_change_type, r.any_voided) for r in spark.table("v_article_currency").collect()] == [("5", 2, "inserted", False)]
