import hashlib
import json

import pytest

from lexgrid.plans import catalog
from lexgrid.sources import files
from lexgrid.sources.tables import with_row_id
from lexgrid.streaming import events


def test_fingerprint_and_pointer(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc" * 1000)
    assert files.fingerprint(spark, str(tmp_path / "a.bin")).first().sha256 == hashlib.sha256(b"abc" * 1000).hexdigest()
    files.pulled(spark, str(tmp_path / "a.bin"))
    (tmp_path / "p.parquet").write_text("version https://git-lfs.example/spec/v1\noid sha256:0\nsize 1\n")
    with pytest.raises(FileNotFoundError):
        files.pulled(spark, str(tmp_path / "p.parquet"))


def test_json_records(spark, tmp_path):
    (tmp_path / "x.json").write_text(json.dumps({"metadata": {}, "articles": [{"article_id": "1", "article_number_base": 1, "line_range": {"start_line": 3, "end_line": 9}}]}, indent=2))
    r = files.parsed_articles(spark, str(tmp_path / "x.json")).first()
    assert (r.article_id, r.line_range.end_line, r.title) == ("1", 9, None)
    files.write_json(spark.range(3), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 3


def test_snapshot_checks_its_key(spark, tmp_path):
    assert files.snapshot(spark.range(5), str(tmp_path), "t", "r1", ["id"]).count() == 5
    with pytest.raises(ValueError, match="not unique"):
        files.snapshot(spark.range(5).selectExpr("id % 2 AS k"), str(tmp_path), "t", "r2", ["k"])


def test_row_ids_survive_filters(spark, sf):
    rows = with_row_id(spark, f"{sf}/orders.parquet").where("o_orderstatus = 'F'")
    assert rows.select("row_id").distinct().count() == rows.count()


def test_event_stream(spark, sf, tmp_path):
    spark.read.parquet(f"{sf}/events.parquet").repartition(3).write.parquet(str(tmp_path / "in"))
    stream = events.latest_status(events.read(spark, str(tmp_path / "in"), late="60 days"))
    run = stream.writeStream.format("memory").queryName("latest").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = {(r.user_id, r.n, r.last_type) for r in spark.table("latest").collect()}
    assert got == {(r.user_id, r.n, r.last_type) for r in catalog.queries()["argmax_latest"](spark, sf).collect()}


def test_every_query_binds(spark, sf):
    for name, query in catalog.queries().items():
        assert query(spark, sf).schema.names, name
