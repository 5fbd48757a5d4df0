"""Sharding by a hierarchical weighted hash tree: region, rack and shard, each chosen by weighted hash draws."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Store, table

SALTS = 1024  # sub-sequences of a shard's slots, so that no task numbers a whole shard


class Shard(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, racks: int = 2, per_rack: int = 4, base: int = 16) -> list[Shard]:
    """The first `base` shards in racks of `per_rack`, `racks` to a region; each further shard opens a region of its own.

    A shard in a new region changes weights at the root alone, and there only its own: rows move only into it.
    """
    out = [Shard(f"region{s // (per_rack * racks)}", f"rack{s // per_rack}", s) for s in range(min(shards, base))]
    return out + [Shard(f"region+{s}", f"rack+{s}", s) for s in range(base, shards)]


def draw(key: list[Column], level: str, node: str, weight: float) -> Column:
    """An exponential variable of rate `weight` from a hash of key and node; the least of several draws wins in proportion to weight.

    A draw depends on its own node and weight only, and shrinks as the weight grows: raising a weight moves keys only
    into that node, lowering it only out of it, and the rest of a level keeps its order.
    """
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(f"{level}/{node}"), *key), 11).cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(u) / F.lit(float(weight))


def choose(key: list[Column], level: str, nodes: dict, then) -> Column:
    """then(node) of the node with the least draw."""
    live = [(n, w) for n, w in nodes.items() if w > 0]
    if not live:
        return F.lit(None).cast("int")
    if len(live) == 1:
        return then(live[0][0])
    won = F.array_min(F.array(*[F.struct(draw(key, level, str(n), w).alias("e"), F.lit(i).alias("i")) for i, (n, w) in enumerate(live)]))["i"]
    return F.element_at(F.array(*[then(n) for n, _ in live]), won + 1)


def shard_of(key: list[Column], shards: list[Shard]) -> Column:
    """The shard of a key: a draw among regions by their total weight, among the region's racks, among the rack's shards."""

    def total(of: list[Shard], by) -> dict:
        out: dict = {}
        for s in of:
            out[by(s)] = out.get(by(s), 0.0) + s.weight
        return out

    def in_rack(region: str, rack: str) -> Column:
        own = [s for s in shards if (s.region, s.rack) == (region, rack)]
        return choose(key, f"{region}/{rack}", total(own, lambda s: s.shard), lambda n: F.lit(n))

    def in_region(region: str) -> Column:
        own = [s for s in shards if s.region == region]
        return choose(key, region, total(own, lambda s: s.rack), lambda rack: in_rack(region, rack))

    return choose(key, "root", total(shards, lambda s: s.region), in_region)


def assign(df: DataFrame, key: list[str], shards: list[Shard], name: str = "shard") -> DataFrame:
    """df with the shard of each row's key. Nulls are a key like any other; repeated keys share a shard."""
    return df.withColumn(name, shard_of([F.col(k) for k in key], shards).cast("int"))


def with_slots(df: DataFrame, shard: str, order: list[str], store: Store) -> DataFrame:
    """df with slot: 0, 1, ... within each shard.

    A shard is numbered in SALTS sub-sequences whose starts come from one small count per (shard, sub-sequence), so a
    shard of any size is spread over tasks. The counts joined are shards x SALTS rows at most.
    """
    salted = store.keep(df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int")))
    sizes = salted.groupBy(shard, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col(shard), "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy(shard, "_salt").orderBy(*order)
    numbered = salted.withColumn("_k", F.row_number().over(own) - 1)
    return numbered.join(F.broadcast(starts), [shard, "_salt"]).withColumn("slot", F.col("_start") + F.col("_k")).drop("_salt", "_k", "_start")


def op1_sharding(spark: SparkSession, sf_dir: str, count: int = 16) -> DataFrame:
    """Every document's shard under the `key` law: doc_id and the number of shards decide, nothing else.

    doc_id, size (UTF-8 bytes of the text plus 1; null text: 1), text_crc32 (null text: that of no bytes), law, shard, slot
    (gapless from 0 in a shard), grown_shard (with one more shard: the same shard or the new one). Equal texts are sharded
    by their own doc_ids; equal doc_ids share a shard; a null doc_id is one key. An empty table gives no row.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("_b"))
    docs = docs.select("doc_id", (F.octet_length("_b").cast("long") + 1).alias("size"), F.crc32("_b").alias("text_crc32"), F.lit("key").alias("law"))
    placed = assign(assign(docs, ["doc_id"], topology(count)), ["doc_id"], topology(count + 1), "grown_shard")
    out = with_slots(placed, "shard", ["doc_id", "text_crc32", "size"], Store(spark, "sharding"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
