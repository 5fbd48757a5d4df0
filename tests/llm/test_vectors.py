import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexgrid.llm import ann
from lexgrid.llm import neardup_vectors as near
from lexgrid.llm.common import Store, components

V = "vec_id long, embedding array<float>, label int, extra string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], V)


def fixture():
    rng = np.random.default_rng(4)
    rows, n = [], 0
    for label in (0, 1, None):
        for _ in range(40):
            base = rng.standard_normal(16)
            for _ in range(int(rng.integers(1, 5))):
                rows.append((n, [float(np.float32(x)) for x in base + rng.standard_normal(16) * 0.18], label))
                n += 1
    hub = rows[0][1]
    rows += [(n + i, hub, 0) for i in range(60)]
    n += 60
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + hub[1:], 0), (n + 3, [float("inf")] + hub[1:], 0), (n + 4, [None] + hub[1:], 0), (n + 5, [], 0), (n + 6, hub[:8], 0), (n + 7, [x * 1e20 for x in hub], 0), (n + 8, [x * 2 for x in hub], 0)]
    return rows


def good(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = (np.array(x, np.float32).astype(float) for x in (a, b))
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def check(spark, rows, **sizes):
    got = {r.vec_id: r for r in near.near_vectors(spark, table(spark, rows), **sizes).collect()}
    links = {i: set() for i, _, _ in rows}
    for i, v, a in rows:
        for j, w, b in rows:
            if i < j and a is not None and a == b and good(v) and good(w) and len(v) == len(w) and cosine(v, w) >= near.THRESHOLD:
                links[i].add(j)
                links[j].add(i)
    assert {i: r.n_links for i, r in got.items()} == {i: len(x) for i, x in links.items()}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            todo = [k for j in todo for k in links[j] if k not in seen and not seen.add(k)]
        assert (got[i].component_id, got[i].kept) == (min(seen), i == min(seen))


def test_links_and_components(spark):
    check(spark, fixture())


def test_tables_of_few_bits_and_blocks(spark, monkeypatch):
    """Many small buckets in many tables, each compared in blocks: the same links."""
    monkeypatch.setattr(near, "BUCKET", 4)
    monkeypatch.setattr(near, "MISS", 1e-9)
    assert near.Plan.of(120, near.THRESHOLD).bits == 5
    check(spark, fixture(), block=4)


def test_plan():
    sizes = [0, 1, 64, 65, 1000, 10**5, 10**9]
    plans = [near.Plan.of(n, near.THRESHOLD) for n in sizes]
    assert [p.bits for p in plans] == [0, 0, 0, 1, 4, 11, 16] and plans[0].tables == 1
    agree = 1 - math.acos(near.THRESHOLD) / math.pi
    for p in plans[3:]:
        assert (1 - agree**p.bits) ** p.tables <= near.MISS < (1 - agree**p.bits) ** (p.tables - 1)
        assert p.signs >= p.bits * p.tables and p.most(near.THRESHOLD) < p.signs / 2 - 3 * math.sqrt(p.signs) / 2


def test_recall_of_the_tables():
    """Pairs at exactly the threshold: nearly all meet in a table and pass as plausible; unlike vectors don't."""
    plan, rng = near.Plan.of(50_000, near.THRESHOLD), np.random.default_rng(8)
    a, b = np.linalg.qr(rng.standard_normal((20_000, 32, 2)))[0].transpose(2, 0, 1)
    c = near.THRESHOLD * a + math.sqrt(1 - near.THRESHOLD**2) * b
    signs = [x @ plan.planes(32) > 0 for x in (a, b, c)]
    meet = (plan.hashes(signs[0]) == plan.hashes(signs[2])).any(1)
    most = plan.most(near.THRESHOLD)
    assert meet.mean() > 1 - 2 * near.MISS and ((signs[0] != signs[2]).sum(1) <= most).all() and ((signs[0] != signs[1]).sum(1) <= most).mean() < 0.01


def test_query(spark, sf):
    """All rows of the table against all others."""
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near.op4_vectors(spark, sf).collect()}
    fit = [(i, v, a) for i, v, a in rows if a is not None and good(v)]
    unit = np.array([v for _, v, _ in fit], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label, ids = np.array([a for *_, a in fit]), np.array([i for i, *_ in fit])
    x, y = np.nonzero((unit @ unit.T >= near.THRESHOLD) & (label[:, None] == label) & ~np.eye(len(fit), dtype=bool))
    root = {i: i for i, *_ in rows}
    for _ in range(20):
        for a, b in zip(ids[x].tolist(), ids[y].tolist(), strict=True):
            root[a] = root[b] = min(root[a], root[b])
    n = dict(zip(*(z.tolist() for z in np.unique(ids[x], return_counts=True)), strict=True))
    assert got == {i: (n.get(i, 0), root[i], root[i] == i) for i, *_ in rows}


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [0.0, 1.0], 2)]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near.near_vectors(spark, table(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 0, None, False)], key=str)
    assert near.near_vectors(spark, table(spark, [])).count() == 0


@pytest.mark.parametrize("n, m", [(60, 40), (200, 400), (300, 150)])
def test_components(spark, n, m):
    rng = np.random.default_rng(n)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, n, (m, 2))] + [(n + i, n + i + 1) for i in range(70)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), Store(spark, "t")).collect())
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((700, 16))
    rows = [(i, [float(np.float32(x)) for x in base[i]], 0) for i in range(700)]
    rows += [(700 + i, rows[3][1], 1) for i in range(120)]
    rows += [(820, None, 0), (821, [0.0] * 16, 0), (850, [float("nan")] * 16, 0), (900, [1.0, 2.0], 0), (None, rows[5][1], 0)]
    got = {}
    for r in ann.nearest(spark, table(spark, rows), F.expr("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    fit = [(i, v) for i, v, _ in rows if i is not None and good(v) and len(v) == 16]
    hit = total = 0
    for q, v in fit:
        if q % 50:
            continue
        truth = sorted((-round(cosine(v, w), 12), i) for i, w in fit if i != q)[:5]
        own = sorted(got[q])
        assert [r for r, _, _ in own] == [1, 2, 3, 4, 5]
        assert all(abs(s - cosine(v, dict(fit)[i])) < 1e-12 for _, i, s in own)
        assert [(-round(s, 12), i) for _, i, s in own] == sorted((-round(s, 12), i) for _, i, s in own)
        hit += len({i for _, i in truth} & {i for _, i, _ in own})
        total += 5
    assert hit / total >= 0.9
    assert [i for _, i, _ in sorted(got[750])] == [3, 700, 701, 702, 703]
    assert 850 not in got and 900 not in got
    assert ann.nearest(spark, table(spark, []), F.lit(True)).count() == 0


def test_small_tables_give_all_their_neighbours(spark):
    """Each dimension is a small table of its own: its exact nearest 5, or all others if fewer."""
    rng = np.random.default_rng(9)
    sizes = {3: 2, 4: 3, 5: 5, 6: 7, 7: 9, 8: 12, 9: 40, 10: 255}
    rows = [(1000 * dim + i, [float(np.float32(x)) for x in rng.standard_normal(dim)], 0) for dim, n in sizes.items() for i in range(n)]
    got = {}
    for r in ann.nearest(spark, table(spark, rows), F.expr("vec_id % 1000 < 12")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    by = dict((i, v) for i, v, _ in rows)
    assert set(got) == {i for i in by if i % 1000 < 12}
    for q, own in got.items():
        truth = sorted((-cosine(by[q], v), i) for i, v in by.items() if i != q and len(v) == len(by[q]))[:5]
        assert [i for _, i in sorted(own)] == [i for _, i in truth]


def unit_matrix(rng, n, clusters):
    x = rng.standard_normal((n, 32))
    if clusters:
        centres = rng.standard_normal((clusters, 32))
        x = centres[rng.integers(0, clusters, n)] + 0.35 * x
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def seen_share(forest, x, queries):
    """(recall at 5, share of rows compared) of a forest over x, against exact search."""
    lies, hit, share = [t.leaves(x) for t in forest.trees], 0, []
    for q in queries:
        score = x @ x[q]
        score[q] = -2
        seen = np.zeros(len(x), bool)
        for t, leaf in forest.probe(x[q]):
            seen |= lies[t] == leaf
        hit += seen[np.argsort(-score)[:5]].sum()
        share.append(seen.mean())
    return hit / 5 / len(queries), float(np.mean(share))


def test_the_forest_adapts_to_the_data():
    """Structured vectors: deeper trees, and a query compares a small share of the rows. Without structure most of them must be compared for the same recall."""
    rng = np.random.default_rng(2)
    structured, plain = unit_matrix(rng, 8000, 200), unit_matrix(rng, 8000, 0)
    forests = {name: ann.Forest.fit(x, len(x), 5) for name, x in (("structured", structured), ("plain", plain))}
    recall, share = seen_share(forests["structured"], structured, range(0, 8000, 80))
    assert recall >= 0.93 and share < 0.1 and forests["structured"].depth >= 6
    recall, plain_share = seen_share(forests["plain"], plain, range(0, 8000, 80))
    assert recall >= 0.9 and plain_share > 5 * share and forests["plain"].visits > 3 * forests["structured"].visits
    assert all(f.visits <= ann.VISITS for f in forests.values())


def test_a_tree_splits_evenly_and_nests():
    x = unit_matrix(np.random.default_rng(3), 4096, 0)
    tree = ann.Tree.grow(x, 1, 6)
    assert (np.bincount(tree.leaves(x), minlength=64) == 64).all() and np.allclose(tree.shares, 1 / 64)
    for depth in (0, 2, 5):
        short = tree.cut_at(depth)
        assert (short.leaves(x) == tree.leaves(x) >> (6 - depth)).all() and np.allclose(short.shares, 1 / (1 << depth))
    order = list(ann.search([tree], x[0]))
    assert len(order) == 64 and next(ann.search([tree], x[0]))[1] == tree.leaves(x[:1])[0]


def test_nearest_query(spark, sf):
    """Recall over all queries of the table against exact search; scores and ranks are exact."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if good(r.embedding)]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in ann.op9_ann(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % ann.EVERY == 0}
    hit = 0
    for q, own in got.items():
        own.sort()
        score = dict(zip(ids.tolist(), (x @ x[ids == q][0]).tolist(), strict=True))
        del score[q]
        true = sorted((-round(s, 12), i) for i, s in score.items())[:5]
        assert [r for r, _, _ in own] == list(range(1, 6)) and all(abs(score[i] - s) < 1e-12 for _, i, s in own)
        hit += len({i for _, i in true} & {i for _, i, _ in own})
    assert hit / 5 / len(got) >= 0.9


def test_stores_are_swept(spark, tmp_path):
    """A store's folder goes with what is in it; others stay."""
    import os

    before = len(Store.made)
    kept, gone = Store(spark, "kept"), Store(spark, "gone")
    rows = kept.keep(spark.range(5))
    gone.keep(spark.range(5).withColumn("k", F.col("id") % 2), "k")
    folder = lambda store: store.base.removeprefix("file://")
    assert os.path.isdir(folder(gone)) and sorted(x for x in os.listdir(f"{folder(gone)}/1") if x.startswith("k=")) == ["k=0", "k=1"]
    Store.sweep(before, kept)
    assert not os.path.exists(folder(gone)) and rows.count() == 5 and kept in Store.made
    Store.sweep(before)
    assert not os.path.exists(folder(kept)) and len(Store.made) == before
