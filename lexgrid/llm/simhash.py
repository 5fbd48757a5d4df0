"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Store, by_groups, components, forest, in_block_pairs, lean, table

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SEED = 42  # of XXH64, fixed by the fingerprint's definition
CHUNK = 8192  # shingles whose bits are counted at once


def fingerprint(text: str | None, words: int = 3) -> int:
    """64 bits, each set if over half of the shingles' hashes have it; 0 without words."""
    if not text:
        return 0
    tokens = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    ends = np.cumsum(sizes) - 1
    k = min(words, len(tokens))
    stops = ends[k - 1 :]
    starts = np.concatenate([[0], ends[: len(stops) - 1] + 1])
    view, h = memoryview(joined), xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(stops), CHUNK):
        hashes = np.array([h(view[a:b], SEED) for a, b in zip(starts[i : i + CHUNK].tolist(), stops[i : i + CHUNK].tolist(), strict=True)], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (counts * 2 > len(stops)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """2 ** (radius + 1) - 1 masks over bit positions; any `radius` positions are all outside one of them.

    Position i has the nonzero vector v(i) over GF(2) of radius + 1 coordinates; mask u holds i if <u, v(i)> = 1. Vectors
    of any `radius` positions leave some u orthogonal to all of them.
    """
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if bin(u & (i % n + 1)).count("1") % 2) for u in range(1, n + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near(df: DataFrame, store: Store, radius: int = 3, block: int = 1024) -> DataFrame:
    """Links (a, b) of distinct fingerprints `fp` (long) that connect all that differ in at most `radius` bits, and nothing else.

    A bucket gives a link from each fingerprint to the smallest place that it is connected with there.
    """
    masks = F.array(*[F.lit(signed(m)) for m in covering_masks(radius)])
    tables = df.select("fp", F.posexplode(F.transform(masks, lambda m: m.bitwiseAND(F.col("fp")))).alias("t", "key"))
    paired = in_block_pairs(tables, ["t", "key"], "fp", block)

    def links(g: pa.Table) -> pa.Table | None:
        fp, side = g.column("fp").to_numpy().view(np.uint64), g.column("side").to_numpy()
        if len(fp) < 2:
            return None
        from_, to = (np.flatnonzero(side == k) for k in (0, 1)) if g.column("block_i")[0] != g.column("block_j")[0] else (np.arange(len(fp)),) * 2
        if not len(from_) or not len(to):
            return None
        a, b = [], []
        for i in range(0, len(from_), 512):
            x, y = np.nonzero(np.bitwise_count(fp[from_[i : i + 512], None] ^ fp[to][None, :]) <= radius)
            x, y = from_[x + i], to[y]
            a.append(x[x != y])
            b.append(y[x != y])
        a, b = np.concatenate(a), np.concatenate(b)
        if not len(a):
            return None
        root = forest(len(fp), a, b)
        own = np.flatnonzero(root != np.arange(len(fp)))
        ids = g.column("fp").to_numpy()
        return pa.table({"a": ids[own], "b": ids[root[own]]})

    return by_groups(paired.select("t", "key", "block_i", "block_j", "side", "fp"), ["t", "key", "block_i", "block_j"], "a long, b long", links)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp): each row's fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                fp = np.array([fingerprint(x) for x in part.column(1).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(fp)], ["key", "fp"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(lean(run), "key long, fp long").withColumnRenamed("key", key)


def simhash_groups(spark: SparkSession, docs: DataFrame, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row of docs (doc_id, text and any other columns).

    Equal fingerprints are one class before any comparison, so copies cost a combined count. Every pair of distinct
    fingerprints within the radius meets in one of the covering tables; classes in a bucket are compared block by block.
    Null, empty and wordless texts have fingerprint zero and are linked by it like any other. Rows with a null doc_id
    are kept; component_id is the smallest non-null doc_id reachable, null if there is none. An empty table gives no row.
    """
    store = Store(spark, "simhash")
    prints = store.keep(fingerprints(docs))
    classes = store.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    parts = components(near(classes.select("fp"), store, radius), store)
    rooted = classes.join(parts, classes.fp == parts.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hexed(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document: doc_id, fingerprint (16 hex digits), component_id."""
    return simhash_groups(spark, table(spark, sf_dir, "documents")).select("doc_id", hexed(F.col("fp")).alias("fingerprint"), "component_id")
