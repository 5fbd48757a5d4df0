"""Near-duplicate embeddings: sign hashes in several tables, exact cosines, connected components."""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Store, by_groups, components, forest, lean, table

THRESHOLD = 0.93
MISS = 0.001  # share of pairs at exactly the threshold that may meet in no table
BUCKET = 64  # unlike vectors of the largest label that fall into a bucket, about: bits grow with the table
LEAST_BITS, MOST_BITS = 192, 16  # of a sketch, and of a bucket's hash
SURE = 6.0  # standard deviations above the expected number of unlike signs at the threshold that still call for the cosine
SEED = 20
BLOCK = 1024


class Plan(NamedTuple):
    """How many signs make a bucket's hash, and how many tables there are; all their signs, and a few more, are a vector's sketch."""

    bits: int
    tables: int

    @classmethod
    def of(cls, n: int, threshold: float) -> Plan:
        """For a largest label of n distinct vectors. No bits, so one bucket, where all of them fit in one."""
        agree = 1 - math.acos(threshold) / math.pi  # the chance that two vectors at the threshold agree in a sign
        bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, n / BUCKET)))))
        return cls(bits, 1 if not bits else math.ceil(math.log(MISS) / math.log1p(-(agree**bits))))

    @property
    def signs(self) -> int:
        return -(-max(LEAST_BITS, self.bits * self.tables) // 8) * 8

    def most(self, threshold: float) -> int:
        """Unlike signs of a sketch up to which two vectors may be at the threshold."""
        q = math.acos(threshold) / math.pi
        return math.floor(self.signs * q + SURE * math.sqrt(self.signs * q * (1 - q)))

    def planes(self, dim: int) -> np.ndarray:
        """The random hyperplanes for vectors of one dimension, from a fixed seed."""
        return np.random.default_rng([SEED, dim]).standard_normal((dim, self.signs))

    def hashes(self, signs: np.ndarray) -> np.ndarray:
        """rows x tables."""
        return signs[:, : self.bits * self.tables].reshape(len(signs), self.tables, self.bits) @ (1 << np.arange(self.bits))


def usable(v) -> F.Column:
    """Of vectors that can be compared: not null or empty, all components finite, not all zero."""
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & ok & F.exists(v, lambda x: x != 0), F.lit(False))


def unit_rows(flat: np.ndarray, n: int) -> np.ndarray:
    """n vectors of length 1, in double precision; scaled first, so that no square leaves the range."""
    m = flat.reshape(n, -1).astype(np.float64)
    m /= np.abs(m).max(1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def sketches(classes: DataFrame, plan: Plan) -> DataFrame:
    """(rep, label, dim, sketch): the signs of each class."""
    schema = "rep long, label long, dim int, sketch binary"

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                vectors = part.column(2)
                dims = np.diff(np.asarray(vectors.offsets))
                for dim in np.unique(dims):
                    rows = np.flatnonzero(dims == dim)
                    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
                    signs = np.packbits(unit_rows(flat, len(rows)) @ plan.planes(int(dim)) > 0, axis=1)
                    kept = [part.column(i).take(pa.array(rows)) for i in range(2)]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(np.full(len(rows), dim), pa.int32()), pa.array([x.tobytes() for x in signs], pa.binary())], schema_names(schema))

    return classes.select("rep", F.col("label").cast("long").alias("label"), "embedding").mapInArrow(lean(run), schema)


def schema_names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def signs_of(g: pa.Table) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b"".join(g.column("sketch").to_pylist()), np.uint8).reshape(g.num_rows, -1), axis=1)


def in_tables(sketched: DataFrame, plan: Plan) -> DataFrame:
    """(rep, label, dim, sketch, t, sig): each class once for each table."""
    schema = "rep long, label long, dim int, sketch binary, t int, sig int"

    def run(batches):
        for batch in batches:
            sigs = plan.hashes(signs_of(pa.table(batch))) if batch.num_rows else np.zeros((0, plan.tables), int)
            for t in range(plan.tables):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, t), pa.int32()), pa.array(sigs[:, t].astype(np.int32))], schema_names(schema))

    return sketched.mapInArrow(lean(run), schema)


KEYS = ["t", "label", "dim", "sig", "block_i", "block_j"]


def blocked(rows: DataFrame, block: int) -> DataFrame:
    """Rows of each bucket, once for each pair (block_i <= block_j) of its blocks to compare, with side (0: of block_i, 1: of block_j).

    Only buckets of more than a block are looked up: they are few. So a hot bucket is compared in full and nowhere at once.
    """
    bucket = KEYS[:4]
    hot = rows.groupBy(*bucket).agg(F.count("*").alias("_m")).where(F.col("_m") > block)
    blocks = F.coalesce(F.ceil(F.col("_m") / F.lit(block)).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64(F.lit(11), F.col("rep")), blocks).cast("int")
    out = rows.join(hot, bucket, "left").withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return (
        out.withColumn("block_i", F.least("_own", "_other")).withColumn("block_j", F.greatest("_own", "_other"))
        .withColumn("side", (F.col("_own") > F.col("_other")).cast("int")).drop("_m", "_own", "_other")
    )


def sides(g: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """Positions of the rows to compare with each other; whether these are two blocks or one with itself."""
    side = g.column("side").to_numpy()
    two = g.column("block_i")[0] != g.column("block_j")[0]
    return (*((np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(g.num_rows),) * 2), two)


def first_meeting(x: np.ndarray, y: np.ndarray, sigs: np.ndarray, t: int) -> np.ndarray:
    """Whether pairs agree in no table before t: each pair counts once."""
    return ~(sigs[x, :t] == sigs[y, :t]).any(1)


def plausible(g: pa.Table, plan: Plan, most: int) -> pa.Table | None:
    """The rows of one pair of blocks whose sketch is near another's that they meet here first: only these need their vectors."""
    left, right, two = sides(g)
    if not len(left) or not len(right):
        return None
    signs, t = signs_of(g), g.column("t")[0].as_py()
    near = signs.astype(np.float32) * 2 - 1  # unlike signs of s: (s - product) / 2, exact in single precision
    sigs, wanted = plan.hashes(signs), np.zeros(g.num_rows, bool)
    for i in range(0, len(left), 256):
        x, y = np.nonzero(near[left[i : i + 256]] @ near[right].T >= plan.signs - 2 * most)
        x, y = left[x + i], right[y]
        if not two:
            x, y = x[x < y], y[x < y]
        new = first_meeting(x, y, sigs, t)
        wanted[x[new]] = wanted[y[new]] = True
    return g.select([*KEYS, "side", "rep", "sketch"]).filter(pa.array(wanted))


def compare(g: pa.Table, plan: Plan, threshold: float) -> pa.Table | None:
    """(rep, links, root) of the classes in one pair of blocks: rows linked to in the other classes, and a spanning link."""
    left, right, two = sides(g)
    if not len(left) or not len(right):
        return None
    flat = g.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    unit, sigs, t = unit_rows(flat, g.num_rows), plan.hashes(signs_of(g)), g.column("t")[0].as_py()
    n, links, a, b = g.column("n").to_numpy(), np.zeros(g.num_rows, np.int64), [], []
    for i in range(0, len(left), 256):
        x, y = np.nonzero(unit[left[i : i + 256]] @ unit[right].T >= threshold)
        x, y = left[x + i], right[y]
        if not two:
            x, y = x[x < y], y[x < y]
        new = first_meeting(x, y, sigs, t)
        x, y = x[new], y[new]
        np.add.at(links, x, n[y])
        np.add.at(links, y, n[x])
        a.append(x)
        b.append(y)
    hit = np.flatnonzero(links)
    if not len(hit):
        return None
    root, rep = forest(g.num_rows, np.concatenate(a), np.concatenate(b)), g.column("rep").to_numpy()
    return pa.table({"rep": rep[hit], "links": links[hit], "root": rep[root[hit]]})


def near_vectors(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding, label and any other columns).

    Rows of equal label and equal vector are one class from the start. Bits and tables follow from the size of the
    largest label (Plan). In the tables, buckets first compare sketches, block by block; vectors go only to the blocks where
    their sketch is near another's, and there the cosine decides. Only counts and spanning links leave a block. Vectors that are null, empty, zero or hold null or non-finite
    components, and those without a label, link with nothing. Vectors of different lengths are never compared. Classes
    are named by their smallest vec_id, so rows of equal vec_id can join theirs. A null vec_id is kept in its row, its
    component the smallest other one reachable, null if there is none. An empty table gives no row.
    """
    store = Store(spark, "vectors")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    key = [F.xxhash64("label", "embedding").alias("h1"), F.xxhash64(F.lit(7), "label", "embedding").alias("h2")]
    fit = F.col("label").isNotNull() & usable(F.col("embedding"))
    classes = store.keep(
        rows.where(fit).select("*", *key).groupBy("h1", "h2").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"))
        .withColumn("rep", F.coalesce("first", F.col("h1")))
    )
    largest = classes.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    plan = Plan.of(largest, threshold)
    most = plan.most(threshold)
    sketched = store.keep(sketches(classes, plan))
    shape = "t int, label long, dim int, sig int, block_i int, block_j int, side int, rep long, sketch binary"
    paired = blocked(in_tables(sketched, plan), block).select(*KEYS, "side", "rep", "sketch")
    wanted = store.keep(by_groups(paired, KEYS, shape, lambda g: plausible(g, plan, most)))
    found = by_groups(wanted.join(classes.select("rep", "n", "embedding"), "rep"), KEYS, "rep long, links long, root long", lambda g: compare(g, plan, threshold))
    found = store.keep(found)
    store.drop(wanted)
    store.drop(sketched)
    parts = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), store)
    sums = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = classes.select("h1", "h2", "n", "rep", "first").join(sums, "rep", "left").join(parts, F.col("rep") == F.col("node"), "left")
    named = store.keep(named.select("h1", "h2", "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("root")))
    named = named.join(named.groupBy("root").agg(F.min("first").alias("component_id")), "root").drop("first", "root")
    out = rows.select("vec_id", F.when(fit, key[0]).alias("h1"), F.when(fit, key[1]).alias("h2")).join(named, ["h1", "h2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every embedding; see near_vectors()."""
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))
