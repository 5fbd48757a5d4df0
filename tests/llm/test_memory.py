"""Memory that stages leave to each other."""

import corpus_pipeline
from lexgrid.llm import common


def test_heaps_are_given_back_between_stages(spark, sf, monkeypatch):
    """Garbage doesn't keep a heap large, and the pipeline collects it after each stage but the last."""
    calls = []
    monkeypatch.setattr(corpus_pipeline, "compact", lambda s: calls.append(1) or common.compact(s))
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert len(calls) == len(corpus_pipeline.STAGES) - 1
    runtime = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    collected = lambda: sum(runtime[i].getCollectionCount() for i in range(len(runtime)))
    before = collected()
    assert common.compact(spark) == 2 * spark.sparkContext.defaultParallelism and collected() > before
