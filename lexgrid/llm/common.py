"""What the operators of this subpackage share: tables, shared storage, grouped streams, blocks of pairs, components."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from typing import ClassVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one if they are one process, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "lexgrid-shared")
    return found.rstrip("/")


class Store:
    """Tables written to the shared folder in place of lineage: an executor's loss costs no recomputation of what is written.

    A result may read them as long as it lives, so they go when the driver's process ends, or before, by sweep().
    """

    made: ClassVar[list[Store]] = []  # those that still have their folder

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        Store.made.append(self)
        self.spark, self.base = spark, f"{shared_dir(spark)}/lexgrid-{name}-{uuid.uuid4().hex[:12]}"
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()  # these outlive the session
        self.n = 0

    def keep(self, df: DataFrame, *by: str) -> DataFrame:
        """df, written as Parquet (in a folder for each value of the columns `by`) and read again with the written schema."""
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._lexgrid_path = path
        return out

    def release(self) -> None:
        """Let Spark delete the shuffle files of plans that nothing refers to any more; it does so when the driver's garbage goes."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)  # the cleaner works beside us

    def drop(self, df: DataFrame, part: str = "") -> None:
        """Delete a kept table, or a folder in it, that nothing reads any more."""
        self.delete(f"{df._lexgrid_path}/{part}" if part else df._lexgrid_path)

    def delete(self, path: str) -> None:
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.conf).delete(where, True)

    @classmethod
    def sweep(cls, since: int = 0, *but: Store) -> None:
        """Delete the folders of the stores made since there were so many, but for some: nothing may read them any more."""
        gone = [s for s in cls.made[since:] if s not in but]
        for store in gone:
            store.delete(store.base)
            cls.made.remove(store)


@atexit.register
def _end() -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended first
        Store.sweep()


def lean(f: Callable) -> Callable:
    """f on a partition's batches; then the worker gives back the memory that it no longer needs, as it stays for other tasks."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            from .tokens import settle

            settle()
            gc.collect()
            if not gc.get_freeze_count():
                gc.freeze()  # modules and the like, which every later task would look through
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def compact(spark: SparkSession) -> int:
    """Have the executors' JVMs collect their garbage and give back the heap that it took; how many calls were made.

    A stage's shuffles grow a heap to its limit, where it stays, though the next stage needs the memory for its Python
    workers. One call for each core and one more, as free cores take them in turn.
    """
    n = 2 * spark.sparkContext.defaultParallelism
    return len(spark.range(0, n, 1, n).select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).collect())


def hold() -> None:
    """From here on this worker keeps what it frees until its task ends, see lean(): large arrays come and go, and each new page costs time."""
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL("libc.so.6")
        for what in (-1, -3):  # M_TRIM_THRESHOLD, M_MMAP_THRESHOLD
            libc.mallopt(what, 1 << 30)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Complete groups of equal keys (integers without nulls) from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        edge = np.zeros(batch.num_rows - 1, bool)
        for c in cols:
            edge |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        cuts = [0, *(np.flatnonzero(edge) + 1).tolist(), batch.num_rows]
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def column(table_: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return table_.column(name).to_numpy() if isinstance(table_, pa.Table) else table_.column(name).to_numpy(zero_copy_only=False)


def in_block_pairs(df: DataFrame, keys: list[str], spread: str, block: int) -> DataFrame:
    """Rows of each key's group, dealt into blocks of about `block` rows, once for each pair (block_i <= block_j) of blocks to compare.

    Adds block_i, block_j and side (0: the row is of block_i, 1: of block_j). Groups of one row go. A group of m rows
    becomes (m / block) ** 2 / 2 independent tasks of bounded size, so a hot key is compared in full and nowhere at once.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_m")).where("_m > 1")
    on = df.join(sizes, keys)
    blocks = F.ceil(F.col("_m") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit(11), F.col(spread)), blocks).cast("int")
    out = on.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return (
        out.withColumn("block_i", F.least("_own", "_other"))
        .withColumn("block_j", F.greatest("_own", "_other"))
        .withColumn("side", (F.col("_own") > F.col("_other")).cast("int"))
        .drop("_m", "_own", "_other")
    )


def by_groups(df: DataFrame, keys: list[str], schema: str, f: Callable[[pa.Table], pa.Table | None]) -> DataFrame:
    """f of each group of keys, groups streamed one after another through sorted partitions."""
    n = partitions(df.sparkSession)

    def run(batches):
        out, rows = [], 0
        for g in groups(batches, keys):
            made = f(g)
            if made is not None and made.num_rows:
                out.append(made)
                rows += made.num_rows
                if rows >= 20_000:
                    yield from pa.concat_tables(out).combine_chunks().to_batches()
                    out, rows = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return df.repartition(n, *keys).sortWithinPartitions(*keys).mapInArrow(lean(run), schema)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root (smallest position) of each of n positions under the links a-b."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        if (ra == rb).all():
            return root
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while (again := root[root]).tobytes() != root.tobytes():
            root = again


def components(edges: DataFrame, store: Store) -> DataFrame:
    """(node, component): the smallest node that links (a, b) lead to, for every node that has a link.

    Alternating large and small stars, each round a grouped minimum (combined before the shuffle) and an equi-join that
    adaptive execution can split at hot nodes; rounds grow with the logarithm of a component's size. Each round is
    written to the shared folder. Null ends are ignored. Only one pair of counters a round reaches the driver.
    """
    old = store.keep(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = old.unionByName(old.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") > F.col("m"), F.col("b")).otherwise(F.col("a")).alias("a"), F.col("m").alias("b")).distinct()
        new = store.keep(small)
        seen = new.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        store.drop(old)
        old = new
        if tuple(seen) == before:
            return new.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(new.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = tuple(seen)
