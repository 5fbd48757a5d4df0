import zlib
from collections import Counter

import pytest

from lexgrid.llm import sharding as M

from .helpers import EDGES, docs, written


@pytest.mark.parametrize("count", [16, 17, 20])
def test_one_more_shard_takes_rows_only_into_itself(spark, count):
    df = spark.range(6000).withColumnRenamed("id", "doc_id")
    out = M.assign(M.assign(df, ["doc_id"], M.topology(count)), ["doc_id"], M.topology(count + 1), "grown").collect()
    moved = [r for r in out if r.shard != r.grown]
    assert moved and {r.grown for r in moved} == {count}
    sizes = Counter(r.shard for r in out)
    assert len(sizes) == count and max(sizes.values()) < 1.35 * 6000 / count and min(sizes.values()) > 0.65 * 6000 / count


def test_movement_stays_in_subtrees_whose_weights_change(spark):
    old = M.topology(16)
    new = [s._replace(weight=3.0) if s.shard == 5 else s for s in old]  # shard 5 is in region0/rack1
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    out = M.assign(M.assign(df, ["doc_id"], old), ["doc_id"], new, "grown").collect()
    rack = {s.shard: (s.region, s.rack) for s in old}
    for r in out:
        if r.shard != r.grown:
            assert rack[r.grown] == ("region0", "rack1") or rack[r.grown][0] == "region0" and rack[r.shard][0] != "region0"
        if rack[r.shard] == ("region0", "rack1"):
            assert rack[r.grown] == ("region0", "rack1") and (r.shard == r.grown or r.grown == 5)


def test_weights_decide_shares(spark):
    shards = [M.Shard("a", "r", 0, 1.0), M.Shard("a", "r", 1, 3.0), M.Shard("b", "q", 2, 4.0), M.Shard("b", "q", 3, 0.0)]
    sizes = Counter(r[0] for r in M.assign(spark.range(8000), ["id"], shards).select("shard").collect())
    assert 3 not in sizes and abs(sizes[0] / 8000 - 1 / 8) < 0.02 and abs(sizes[1] / 8000 - 3 / 8) < 0.02


def test_query(spark, tmp_path):
    out = M.op1_sharding(spark, written(spark, docs(spark, EDGES + [(i, "same") for i in range(100, 300)]), tmp_path)).collect()
    assert len(out) == len(EDGES) + 200 and {r.law for r in out} == {"key"}
    texts = {(r[0], r[1]) for r in EDGES}
    for r in out:
        own = [t or "" for i, t in texts if i == r.doc_id] or ["same"]
        assert (r.size, r.text_crc32) in {(len(t.encode()) + 1, zlib.crc32(t.encode())) for t in own}
    for shard in {r.shard for r in out}:
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in out if r.doc_id == 6}) == 1


def test_empty(spark, tmp_path):
    assert M.op1_sharding(spark, written(spark, docs(spark, []), tmp_path)).count() == 0




def plain_draw(key, level, node, weight):
    import math
    import struct

    import xxhash

    seed = xxhash.xxh64_intdigest(f"{level}/{node}".encode(), 42)
    bits = xxhash.xxh64_intdigest(struct.pack("<q", key), seed) >> 11
    return -math.log((bits + 0.5) * 2.0**-53) / weight


def plain_shard(key, shards):
    """Each level's draws one by one, from the hash library."""
    level, left = "root", shards
    for name in (lambda s: s.region, lambda s: s.rack, lambda s: s.shard):
        weights = {}
        for s in left:
            weights[name(s)] = weights.get(name(s), 0) + s.weight
        weights = {n: w for n, w in weights.items() if w > 0}
        won = min(weights, key=lambda n: plain_draw(key, level, n, weights[n]))  # noqa: B023
        left = [s for s in left if name(s) == won]
        level = won if level == "root" else f"{level}/{won}"
    return left[0].shard


def test_draws_against_plain_python(spark):
    for shards in (M.topology(16), M.topology(17), [M.Shard("a", "r", 0, 1.5), M.Shard("a", "r", 1, 3.0), M.Shard("a", "q", 2, 0.0), M.Shard("b", "q", 3, 4.0)]):
        got = {r.id: r.shard for r in M.assign(spark.range(-50, 400), ["id"], shards).collect()}
        assert got == {i: plain_shard(i, shards) for i in got}
