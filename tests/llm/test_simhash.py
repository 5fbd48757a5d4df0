import itertools
import re

import numpy as np
import xxhash

from lexgrid.llm import simhash as M
from lexgrid.llm.common import Store

from .helpers import EDGES, docs


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(sf, spark):
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + [t for _, t in EDGES] + ["ÄÖ x \x0b y\x1cz", "İI"]
    assert [M.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    own = spark.createDataFrame([("a b c",)], "s string").selectExpr("xxhash64(s)").first()[0]
    assert own & (2**64 - 1) == xxhash.xxh64_intdigest("a b c", 42)


def test_masks_cover_every_pair_within_the_radius():
    for radius, bits in ((1, 12), (2, 16), (3, 20)):
        masks = M.covering_masks(radius, bits)
        for at in itertools.combinations(range(bits), radius):
            difference = sum(1 << i for i in at)
            assert any(m & difference == 0 for m in masks)
    assert len(M.covering_masks(3)) == 15 and all(m for m in M.covering_masks(3))


def plain_components(fps, radius=3):
    fps = list(fps)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def near_pairs(spark, fps, block):
    got = M.near(spark.createDataFrame([(M.signed(x),) for x in fps], "fp long"), Store(spark, "t"), 3, block).collect()
    where = {M.signed(x): i for i, x in enumerate(fps)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in got:
        a, b = find(where[r.a]), find(where[r.b])
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_no_link_is_lost(spark):
    rng = np.random.default_rng(8)
    fps = set()
    for _ in range(30):
        x = int(rng.integers(1 << 63)) * 2 + int(rng.integers(2))
        for _ in range(int(rng.integers(1, 25))):
            fps.add(x)
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                x ^= 1 << int(b)
    fps = sorted(fps)
    expected = plain_components(fps)
    assert near_pairs(spark, fps, 1024) == expected
    assert near_pairs(spark, fps, 3) == expected  # many blocks to a bucket


def test_groups(spark):
    rows = EDGES + [(i, "one and the same text of many copies") for i in range(200, 260)]
    got = M.simhash_groups(spark, docs(spark, rows)).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(fps)
    least = {}
    for (i, _), r in zip(rows, root, strict=True):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    expected = sorted(((i, M.signed(f), least.get(r)) for (i, _), f, r in zip(rows, fps, root, strict=True)), key=str)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=str) == expected
    assert M.simhash_groups(spark, docs(spark, [])).count() == 0


def test_query(spark, sf):
    out = M.op8_simhash(spark, sf).collect()
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert {r.doc_id: int(r.fingerprint, 16) for r in out} == {i: plain_fingerprint(t) for i, t in texts.items()}
    assert all(len(r.fingerprint) == 16 for r in out)
    ids = sorted(texts)
    root = plain_components([plain_fingerprint(texts[i]) for i in ids])
    assert {r.doc_id: r.component_id for r in out} == {i: ids[r] for i, r in zip(ids, root, strict=True)}


def test_a_very_long_text(spark):
    """Over many chunks of shingles: the same bits as one by one."""
    text = " ".join(f"W{i % 7919} word{i % 13}" for i in range(40_000))
    assert M.fingerprint(text) == plain_fingerprint(text)
