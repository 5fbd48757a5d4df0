"""Approximate nearest neighbours: a forest of random-projection trees, one priority queue over all of them, exact reranking."""

from __future__ import annotations

import heapq
import pickle
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Store, by_groups, lean, table
from .neardup_vectors import unit_rows, usable

TREES = 8
LEAF = 64  # rows of a leaf, about: depth grows with the table
SAMPLE = 16_384  # vectors that the trees are fitted on, expected; all vectors are indexed
FITTED = 8  # of them in a leaf, at least
VISITS = 64  # leaves that a query may look into
JUDGES = 100  # vectors of the sample whose nearest ones in it say how many leaves that takes
RECALL = 0.97  # share of those that the leaves must hold
EXACT = 256  # vectors of a dimension in the sample under which it has no trees but one leaf, which every query looks into
TOP = 5
EVERY = 50  # the stated query set: vec_id divisible by this
ROWS, QUERIES = 20_000, 4_000  # of a block of a leaf, about
SEED = 9


@lru_cache(maxsize=64)
def planes(dim: int, seed: int, nodes: int) -> np.ndarray:
    """The unit normals of a tree's inner nodes, from a seed; those of a shallower tree are the first of a deeper one's."""
    out = np.random.default_rng([SEED, dim, seed]).standard_normal((nodes, dim))
    return out / np.linalg.norm(out, axis=1, keepdims=True)


class Tree:
    """Inner node k has children 2k+1 and 2k+2; points with <x, plane> <= cut go left. Leaves hold `shares` of the sample."""

    def __init__(self, dim: int, seed: int, cuts: np.ndarray, shares: np.ndarray):
        self.dim, self.seed, self.cuts, self.shares = dim, seed, cuts, shares

    @classmethod
    def grow(cls, x: np.ndarray, seed: int, depth: int) -> Tree:
        inner = (1 << depth) - 1
        cuts, at = np.zeros(inner), np.zeros(len(x), np.int64)
        normals = planes(x.shape[1], seed, inner)
        for level in range(depth):
            p = (x * normals[at]).sum(1)
            order = np.lexsort((p, at))
            nodes, first, count = np.unique(at[order], return_index=True, return_counts=True)
            cuts[nodes] = p[order][first + (count - 1) // 2]  # the lower median
            at = np.where(p <= cuts[at], 2 * at + 1, 2 * at + 2)
        return cls(x.shape[1], seed, cuts, np.bincount(at - inner, minlength=inner + 1) / max(1, len(x)))

    def cut_at(self, depth: int) -> Tree:
        """The same tree without what lies below a depth."""
        return Tree(self.dim, self.seed, self.cuts[: (1 << depth) - 1], self.shares.reshape(1 << depth, -1).sum(1))

    @cached_property
    def normals(self) -> np.ndarray:
        return planes(self.dim, self.seed, len(self.cuts))

    def __getstate__(self) -> dict:  # the normals are drawn again where they are needed
        return {k: v for k, v in self.__dict__.items() if k != "normals"}

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at, inner = np.zeros(len(x), np.int64), len(self.cuts)
        for _ in range(inner.bit_length()):
            at = 2 * at + 1 + ((x * self.normals[at]).sum(1) > self.cuts[at])
        return at - inner


def search(trees: list[Tree], x: np.ndarray):
    """(tree, leaf, share of the sample) for one vector, nearest first: one queue holds the open nodes of all trees by the largest margin crossed."""
    heap = [(-1e9, t, 0) for t in range(len(trees))]
    while heap:
        margin, t, k = heapq.heappop(heap)
        tree = trees[t]
        inner = len(tree.cuts)
        if k >= inner:
            yield t, k - inner, tree.shares[k - inner]
        else:
            d = float((tree.normals[k] * x).sum() - tree.cuts[k])
            heapq.heappush(heap, (max(margin, d), t, 2 * k + 1))
            heapq.heappush(heap, (max(margin, -d), t, 2 * k + 2))


class Forest:
    """Trees of one dimension, and how many leaves a query looks into."""

    def __init__(self, trees: list[Tree], visits: int, share: float):
        self.trees, self.visits, self.share = trees, visits, share  # share of all rows that a judge compared, on average

    @property
    def depth(self) -> int:
        return len(self.trees[0].cuts).bit_length()

    def probe(self, x: np.ndarray) -> list[tuple[int, int]]:
        found = search(self.trees, x)
        return [(t, leaf) for (t, leaf, _), _ in zip(found, range(self.visits))]  # noqa: B905

    @classmethod
    def fit(cls, x: np.ndarray, n: int, top: int) -> Forest:
        """For n vectors like the sample x: the deepest trees whose leaves, VISITS at most, hold RECALL of the judges' true neighbours.

        Leaves have about LEAF rows where the data let them; data without structure need trees so shallow that a query
        compares most rows. In a larger table neighbours are nearer, so they are found at least as well as in the sample.
        """
        depth = max(0, min(int(np.log2(max(1, n / LEAF))), int(np.log2(max(1, len(x) / FITTED)))))
        grown = [Tree.grow(x, t, depth) for t in range(TREES)]
        judges = np.random.default_rng(SEED).permutation(len(x))[:JUDGES]
        true = []
        for j in judges.tolist():
            score = (x * x[j]).sum(1)
            score[j] = -2
            true.append(np.argpartition(-score, min(top, len(x) - 1) - 1)[: min(top, len(x) - 1)])
        while True:
            trees = [t.cut_at(depth) for t in grown]
            lies = np.stack([t.leaves(x) for t in trees])
            rounds, shares = [], []  # after how many leaves each neighbour is met; what share of rows that many hold
            for j, near in zip(judges.tolist(), true, strict=True):
                met, seen, share = np.full(len(near), VISITS + 1), np.zeros(len(x), bool), np.zeros(VISITS + 1)
                for k, (t, leaf, _) in enumerate(search(trees, x[j]), 1):
                    if k > VISITS:
                        break
                    here = lies[t] == leaf
                    seen |= here
                    share[k:] = seen.mean()
                    met[(met > VISITS) & here[near]] = k
                rounds.append(met)
                shares.append(share)
            needed = int(np.sort(np.concatenate(rounds))[int(np.ceil(RECALL * top * len(rounds))) - 1]) if depth and rounds else 1
            if needed <= VISITS:
                return cls(trees, needed, float(np.mean([s[min(needed, VISITS)] for s in shares])))
            depth -= 1


def vectors_of(array: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, their vectors as a matrix of the array's own type) of a list array without nulls."""
    dims = np.diff(np.asarray(array.offsets))
    out = []
    for dim in np.unique(dims):
        rows = np.flatnonzero(dims == dim)
        out.append((int(dim), rows, array.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)))
    return out


def rerank(g: pa.Table, kind: str, top: int) -> pa.Table | None:
    """The exact `top` of each query among the rows of one block of one leaf."""
    side, ids = g.column("side").to_numpy(), g.column("ids").to_pylist()
    at_q, at_x = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(at_q) or not len(at_x):
        return None
    raw = np.frombuffer(b"".join(g.column("vec").to_pylist()), kind)
    unit = unit_rows(raw, g.num_rows)
    x = unit[at_x]
    out: dict[str, list] = {"query_id": [], "h1": [], "vec_id": [], "score": []}
    h1 = g.column("h1").to_numpy()
    need = min(top + 1, len(x))
    for i in range(0, len(at_q), 256):
        qs = at_q[i : i + 256]
        s = unit[qs] @ x.T
        least = np.partition(s, len(x) - need, axis=1)[:, len(x) - need] - 1e-12
        for row, q in enumerate(qs.tolist()):
            own = ids[q][0]
            near = np.flatnonzero(s[row] >= least[row])
            exact = (unit[q] * x[near]).sum(1)  # the same sum for a pair in whichever block it meets
            found = sorted((-v, n) for v, k in zip(exact.tolist(), near.tolist(), strict=True) for n in ids[at_x[k]] if n != own)[:top]
            for v, n in found:
                out["query_id"].append(own)
                out["h1"].append(h1[q])
                out["vec_id"].append(n)
                out["score"].append(-v)
    return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "h1": pa.array(out["h1"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64())})


def smallest_ids(rows: DataFrame, keep: int) -> DataFrame:
    """(h1, h2, embedding, ids): each distinct vector with its `keep` smallest ids.

    A batch keeps that many of each of its vectors, so a vector that many rows share is small before the shuffle; what
    batches kept is brought together in sub-groups first.
    """
    kind = rows.schema["embedding"].dataType.simpleString()

    def combine(batches):
        for batch in batches:
            h1, h2, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            order = np.lexsort((ids, h2, h1))
            new = np.ones(len(order), bool)
            new[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
            start = np.flatnonzero(new)
            at = np.arange(len(order)) - np.repeat(start, np.diff([*start, len(order)]))
            yield batch.take(pa.array(order[at < keep]))

    kept = rows.select("h1", "h2", "vec_id", "embedding").mapInArrow(lean(combine), f"h1 long, h2 long, vec_id long, embedding {kind}")
    least = lambda ids: F.slice(F.array_sort(F.array_distinct(ids)), 1, keep)
    part = kept.groupBy("h1", "h2", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("_s")).agg(least(F.collect_list("vec_id")).alias("ids"), F.any_value("embedding").alias("embedding"))
    return part.groupBy("h1", "h2").agg(least(F.flatten(F.collect_list("ids"))).alias("ids"), F.any_value("embedding").alias("embedding"))


def fitted(classes: DataFrame, n: int, top: int) -> dict[int, Forest]:
    """The forest of each dimension of which the sample holds EXACT vectors or more. The sample, about SAMPLE vectors, meets in one task; the driver gets cuts and shares."""
    share = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "h1"), 11).cast("double") * 2.0**-53

    def learn(batches):
        by: dict[int, list] = {}
        for batch in batches:
            h = batch.column(0).to_numpy()
            for dim, at, m in vectors_of(batch.column(1)):
                by.setdefault(dim, []).append((h[at], unit_rows(m.ravel(), len(at))))
        found = {dim: [np.concatenate(x) for x in zip(*parts, strict=True)] for dim, parts in by.items()}
        total, out = sum(len(h) for h, _ in found.values()), {}
        for dim, (h, x) in found.items():
            if len(x) >= EXACT:
                out[dim] = Forest.fit(x[np.argsort(h)], round(n * len(x) / total), top)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(out)], pa.binary())], ["forest"])

    sample = classes.where(share < SAMPLE / max(n, 1)).select("h1", "embedding").repartition(1)
    made = sample.mapInArrow(lean(learn), "forest binary").collect()
    return pickle.loads(made[0]["forest"]) if made else {}


def nearest(spark: SparkSession, vectors: DataFrame, is_query, top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query holds for, its nearest other rows by cosine.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without a vec_id
    or of another length than the query's. Equal vectors are indexed once with their smallest ids, which is all that a
    result can show of them. A dimension of few vectors is searched whole. For others the depth of the trees and the leaves that a query looks
    into follow from the table's size and from what a sample shows to be needed (Forest.fit), so both adapt to the data. Rows of the query's own vec_id are no candidates; an id whose rows hold several vectors is
    a query by each. Leaves are compared in blocks of rows and queries, so no task grows with the table. Ties go to the
    smaller vec_id. An empty table gives no row.
    """
    store = Store(spark, "ann")
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(7), "embedding").alias("h2")
    )
    classes = store.keep(smallest_ids(rows, top + 1))
    queries = store.keep(rows.where(is_query).dropDuplicates(["vec_id", "h1", "h2"]))
    n, n_queries = classes.count(), queries.count()
    forest = fitted(classes, n, top) if n else {}
    blocks = {dim: (max(1, -(-n // (ROWS << f.depth))), max(1, -(-n_queries * f.visits // (QUERIES * TREES << f.depth)))) for dim, f in forest.items()}  # of a leaf's rows, of its queries
    whole = (max(1, -(-n // ROWS)), max(1, -(-n_queries // QUERIES)))
    kind = "<f8" if dict(vectors.dtypes)["embedding"] == "array<double>" else "<f4"
    schema = "dim int, tree int, leaf int, rows int, queries int, side int, h1 long, ids array<long>, vec binary"
    names = [x.split()[0] for x in schema.split(", ")]

    def batch_of(dim, tree, leaf, r, q, side, h1, ids, vec):
        size = len(leaf)
        full = lambda x: pa.array(np.broadcast_to(np.asarray(x, np.int32), size))
        return pa.RecordBatch.from_arrays([full(dim), full(tree), full(leaf), full(r), full(q), full(side), pa.array(h1), ids, vec], names)

    def index(batches):
        for batch in batches:
            h1 = batch.column(0).to_numpy()
            for dim, at, m in vectors_of(batch.column(2)):
                unit = unit_rows(m.ravel(), len(at))
                vec = pa.array([v.tobytes() for v in np.ascontiguousarray(m, kind)], pa.binary())
                ids = batch.column(1).take(pa.array(at))
                row_blocks, query_blocks = blocks.get(dim, whole)
                block = (h1[at].view(np.uint64) % np.uint64(row_blocks)).astype(np.int64)
                for t, tree in enumerate(forest[dim].trees if dim in forest else [None]):
                    leaf = tree.leaves(unit) if tree else np.zeros(len(at), np.int64)
                    for q in range(query_blocks):
                        yield batch_of(dim, t, leaf, block, q, 1, h1[at], ids, vec)

    def probe(batches):
        for batch in batches:
            own, h1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for dim, at, m in vectors_of(batch.column(2)):
                unit, trees = unit_rows(m.ravel(), len(at)), forest.get(dim)
                row_blocks, query_blocks = blocks.get(dim, whole)
                for i in range(0, len(at), 500):
                    found = [(k, t, leaf) for k in range(i, min(i + 500, len(at))) for t, leaf in (trees.probe(unit[k]) if trees else [(0, 0)])]
                    k, t, leaf = np.array(found, np.int64).T
                    vec = pa.array([m[j].astype(kind).tobytes() for j in k.tolist()], pa.binary())
                    ids = pa.array([[x] for x in own[at[k]].tolist()], pa.list_(pa.int64()))
                    block = (h1[at[k]].view(np.uint64) % np.uint64(query_blocks)).astype(np.int64)
                    for r in range(row_blocks):
                        yield batch_of(dim, t, leaf, r, block, 0, h1[at[k]], ids, vec)

    sides = classes.select("h1", "ids", "embedding").mapInArrow(lean(index), schema).unionByName(queries.select("vec_id", "h1", "embedding").mapInArrow(lean(probe), schema))
    keys = ["dim", "tree", "leaf", "rows", "queries"]
    offered = by_groups(sides, keys, "query_id long, h1 long, vec_id long, score double", lambda g: rerank(g, kind, top))
    best = offered.groupBy("query_id", "h1", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id", "h1").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank.cast("int")).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest rows of every embedding whose vec_id is divisible by EVERY; see nearest()."""
    return nearest(spark, table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
