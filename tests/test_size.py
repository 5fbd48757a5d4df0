"""What keeps queries over large tables within bounds: tasks by the table's size, costly work on all cores, texts read once."""

import duckdb
import pyarrow as pa
import pytest

from lexgrid.operators import citations as C
from lexgrid.operators import events as E
from lexgrid.plans import catalog
from lexgrid.sources.tables import parts, table


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parts_grow_with_the_table(spark, sf):
    df = table(spark, sf, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    assert parts(df, 1 << 40) == cores
    few, many = parts(df, 4096), parts(df, 1024)
    assert many > few > cores and abs(many - 4 * few) <= 4


def test_pyramid_counts_acts_by_size_and_keeps_repeats(spark, tmp_path):
    """No distinct count in one task; repeated acts, acts of two tiers, and lines without norm or act count as the SQL has them."""
    orders = [(1, "1-URGENT", "2001-01-01"), (1, "1-URGENT", "2001-01-03"), (1, "2-HIGH", "2001-01-02"), (2, "1-URGENT", None), (3, None, "2001-02-01"), (None, "1-URGENT", "2001-03-01")]
    lines = [(1, 7), (1, 7), (1, 8), (2, 7), (3, 7), (None, 7), (2, None), (4, 7), (2, 99)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string, o_orderdate string").selectExpr("o_orderkey", "o_orderpriority", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS o_orderdate").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7,), (8,), (9,)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    df = catalog.queries()["pyramid"](spark, str(tmp_path))
    con = duckdb.connect()
    for t in ("orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, con.execute(catalog.oracle_sql()["pyramid"]).fetchall()))
    assert "distinct" not in plan(df) and "RepartitionByExpression [l_orderkey" in plan(df)


def test_void_citations_reads_only_edges_of_a_changed_article(spark):
    events = spark.createDataFrame([(1, 5, "1", "3-moddaning ikkinchi qismi", "voided", "2001-01-01"), (2, 5, "1", "3-moddaning birinchi qismi", "voided", "2001-01-02")], "event_id long, doc_id long, host_article string, locator string, change_type string, amend_date string")
    edges = spark.createDataFrame([(10, 5, "3", "2-qism"), (11, 5, "3", "birinchi qism"), (12, 5, "3", None), (13, 5, "3", "uchinchi qism"), (14, 5, "4", "2-qism"), (15, 6, "3", "2-qism")], "edge_id long, dst_doc_id long, dst_article_number string, dst_qism string")
    out = E.void_citations(edges, events)
    assert sorted(map(tuple, out.collect())) == [(10, 1), (11, 2)]
    below = plan(out).split("Join Inner", 1)[1].split("\n", 1)[1]
    assert "dst_qism" in below and not any("regexp" in x and "dst_qism" in x for x in below.split("\n"))  # patterns run on what met


def test_a_text_is_read_once(monkeypatch):
    """Rows of one text share what was found; texts that differ in a flag don't, and long ones aren't remembered."""
    calls = []
    own = C.extract
    monkeypatch.setattr(C, "extract", lambda *a: calls.append(a) or own(*a))
    C.lately.cache_clear()
    short, long_ = "Ushbu Fuqarolik kodeksining 5, 7-moddalari", "Fuqarolik kodeksining 9-moddasi " + "x" * C.SHORT
    texts = [short, "kodeks", short, long_, short, long_]
    batch = pa.RecordBatch.from_pydict({
        "row_id": [*range(6)], "field_ord": [0] * 6, "source_field": ["t"] * 6, "text": texts, "allow_fk_alias": [False, None, False, False, True, False], "is_the_code": [False] * 6, "doc_type": pa.array([None] * 6, pa.string()),
    })
    for _ in range(2):
        out = pa.Table.from_batches(C.read([batch])).to_pydict()
        assert [*zip(out["row_id"], out["article"], out["emit_ord"], strict=True)] == [(0, "5", 0), (0, "7", 1), (2, "5", 0), (2, "7", 1), (3, "9", 0), (4, "5", 0), (4, "7", 1), (5, "9", 0)]
    assert len(calls) == 3 + 2  # the long text twice


def test_sentences_are_read_once_for_each_part(spark, sf):
    """The grammar meets distinct parts, not lines."""
    text = plan(catalog.queries()["extract_citations"](spark, sf))
    assert "MapInArrow" in text and "Aggregate [l_partkey" in text.split("MapInArrow", 1)[1]


@pytest.mark.parametrize("name", ["regex_dates", "cited_units", "cited_parts", "late_locators", "repeal_items", "amendment_targets"])
def test_one_row_group_is_spread_over_all_cores(spark, sf, name):
    assert catalog.queries()[name](spark, sf).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_late_locators_reads_no_sentence_in_the_scan(spark, sf):
    """What finds items runs once they are spread, on neither side of the join before."""
    scans = plan(catalog.queries()["late_locators"](spark, sf)).split("RepartitionByExpression")[1:]
    assert len(scans) == 2 and not any("regexp_extract_all" in x.split(":- ")[0].split("+- Project [row_id")[0] for x in scans)
