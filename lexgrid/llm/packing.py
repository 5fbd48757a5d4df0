"""Packing by cutting-stock column generation over a histogram of piece lengths."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Store, lean, table
from .sharding import with_slots
from .tokens import batched, encoder

LENGTH = 2048
CUT = 512  # what is left of a document after full sequences is cut at its last multiple of this, so that short tails can fill sequences
STEP = 4  # tokens to a class of piece lengths: the linear program has LENGTH / STEP rows, whatever the input
GAP = 5e-4  # columns are priced until the program is within this share of its bound
ROUNDS = 4000  # of pricing at most; any basis gives whole patterns, only with more padding
END = 1  # the id after each document


def cuts(n: int, length: int, cut: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document of n ids: full sequences, then a multiple of `cut`, then the tail."""
    at = [*range(0, n - n % length + 1, length), n - n % cut, n]
    return [(a, b) for a, b in zip(at, at[1:], strict=False) if a < b]


def pieces(docs: DataFrame, length: int = LENGTH, cut: int = CUT, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens) of the pieces of every document."""

    def run(batches):
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for part, texts in batched(batch, 1):
                rows = []
                for i, ids in enumerate(encoder(path).encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    rows += [(i, a, b - a, zlib.crc32(ids[4 * a : 4 * b]), n) for a, b in cuts(n, length, cut)]
                own = np.array(rows, np.int64).reshape(-1, 5)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()).take(pa.array(own[:, 0])), *map(pa.array, own.T[1:])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lean(run), schema)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most that pieces of these sizes are worth together in `room`, and how many of each: an unbounded knapsack."""
    value, took = np.zeros(room + 1), np.full(room + 1, -1)
    for c in range(1, room + 1):
        value[c] = value[c - 1]
        fit = np.searchsorted(sizes, c, "right")
        if fit:
            worth = prices[:fit] + value[c - sizes[:fit]]
            k = int(worth.argmax())
            if worth[k] > value[c] + 1e-12:
                value[c], took[c] = worth[k], k
    counts, c = np.zeros(len(sizes)), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            counts[took[c]] += 1
            c -= sizes[took[c]]
    return value[room], counts


def fractional(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, how often each is used) of the linear program, by the revised simplex method with priced columns.

    No threaded linear algebra: this runs in the driver, whose process has been forked to start the JVM.
    """
    m = len(sizes)
    basis = np.diag((room // sizes).astype(float))
    need = demand * (1 + 1e-7 * np.random.default_rng(0).random(m))  # breaks ties of the ratio test
    inverse = np.diag(1.0 / np.diag(basis))
    for _ in range(ROUNDS):
        worth, column = best_pattern(inverse.sum(0), sizes, room)
        if worth <= 1 + GAP:  # the bound is what is used, divided by worth
            break
        used, change = (inverse * need).sum(1), (inverse * column).sum(1)
        ratio = np.where(change > 1e-9, used / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    return basis, (inverse * demand).sum(1)


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {class: pieces} and copies of each that use up the histogram {class: pieces}; a class is a size of at most `room`.

    The fractional program's uses are rounded down; what is left over (less than one use of each of its patterns) is
    filled from the largest class down.
    """
    sizes = np.array(sorted(histogram), np.int64)
    left = np.array([histogram[int(c)] for c in sizes], np.int64)
    out = []
    if len(sizes):
        columns, used = fractional(sizes, left, room)
        for j in np.argsort(-used, kind="stable"):
            own = np.flatnonzero(columns[:, j] > 0.5)
            each = columns[own, j].round().astype(np.int64)
            copies = min(int(np.floor(used[j] + 1e-6)), int((left[own] // each).min()))
            if copies > 0:
                left[own] -= copies * each
                out.append(({int(sizes[i]): int(n) for i, n in zip(own, each, strict=True)}, copies))
    while left.any():
        free, own = room, {}
        for i in np.flatnonzero(left)[::-1]:
            n = min(int(left[i]), free // int(sizes[i]))
            if n:
                own[int(i)] = n
                free -= n * int(sizes[i])
        copies = min(int(left[i]) // n for i, n in own.items())
        for i, n in own.items():
            left[i] -= copies * n
        out.append(({int(sizes[i]): n for i, n in own.items()}, copies))
    return out


def pack(spark: SparkSession, docs: DataFrame, length: int = LENGTH, cut: int = CUT, step: int = STEP, path: str | None = None) -> DataFrame:
    """Pieces of docs (doc_id, text, any other columns) and where they lie: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is its end id alone. Piece lengths fall into classes of `step`, counted over all documents; a
    linear program over the classes' histogram makes the patterns, and the ranked pieces of a class take its places in
    them. Ranks come from sub-sequences (with_slots), so a class that holds most pieces is spread over tasks. The driver
    gets the histogram alone, length / step numbers. Rows of equal doc_id are documents of their own. An empty table
    gives no row.
    """
    store = Store(spark, "packing")
    cut = store.keep(pieces(docs, length, cut, path).withColumn("class", F.ceil(F.col("length") / F.lit(step)).cast("int")))
    histogram = {r["class"]: r["n"] for r in cut.groupBy("class").agg(F.count("*").alias("n")).collect()}
    patterns = plan(histogram, length // step)
    keys, firsts, each, seen, base = [], [], [], dict.fromkeys(histogram, 0), 0
    for own, copies in patterns:
        for c, n in own.items():
            keys.append((c << 40) + seen[c])
            firsts.append(base)
            each.append(n)
            seen[c] += n * copies
        base += copies
    order = np.argsort(np.array(keys, np.int64))
    keys, firsts, each = (np.array(x, np.int64)[order] for x in (keys, firsts, each))

    def place(batches):
        for batch in batches:
            c, k = (batch.column(i).to_numpy().astype(np.int64) for i in (batch.num_columns - 2, batch.num_columns - 1))
            key = (c << 40) + k
            at = np.searchsorted(keys, key, "right") - 1
            sequence = firsts[at] + (key - keys[at]) // each[at]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence)], [*batch.schema.names, "sequence_id"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ranked = with_slots(cut, "class", ["doc_id", "start", "ids_crc32", "doc_tokens"], store).select(*names, "class", F.col("slot").alias("rank"))
    schema = ", ".join(f"{n} long" for n in names) + ", class int, rank long, sequence_id long"
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.mapInArrow(lean(place), schema).withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return placed.select(*names, "sequence_id", "offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, packed into sequences of at most 2048 tokens; see pack()."""
    return pack(spark, table(spark, sf_dir, "documents"))
