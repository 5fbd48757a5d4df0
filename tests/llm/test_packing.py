import zlib
from collections import defaultdict

import numpy as np

from lexgrid.llm import packing as M
from lexgrid.llm.tokens import Encoder, encoder

from .helpers import EDGES, docs, written


def test_encoder_is_the_library(sf):
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table(f"{sf}/documents.parquet").to_pydict()["text"]]
    texts += ["a  b", "  a b ", " a\n b\n", "", "\n", "a \n b", " ", "<|endoftext|> hi", "é" * 300 + " x", "it's  don't\t x", "a" * 3000 + " b"]
    own = Encoder(remembered=50)
    for _ in range(2):
        assert own.encode(texts) == own.whole(texts)


def test_pattern_is_worth_most():
    rng = np.random.default_rng(1)
    for _ in range(20):
        sizes = np.sort(rng.choice(np.arange(1, 15), 4, replace=False))
        prices = rng.random(4)
        worth, counts = M.best_pattern(prices, sizes, 20)
        table = np.zeros(21)
        for room in range(1, 21):
            table[room] = max([table[room - 1], *(table[room - s] + p for s, p in zip(sizes, prices) if s <= room)])
        assert abs(worth - table[20]) < 1e-9 and abs((counts * prices).sum() - worth) < 1e-9 and (counts * sizes).sum() <= 20


def test_plan_uses_everything_and_is_near_the_bound():
    rng = np.random.default_rng(2)
    histogram = {int(c): int(n) for c, n in zip(range(1, 129), rng.integers(0, 60, 128)) if n}
    used = defaultdict(int)
    plan = M.plan(histogram, 512)
    for pattern, copies in plan:
        assert sum(c * n for c, n in pattern.items()) <= 512 and copies > 0
        for c, n in pattern.items():
            used[c] += n * copies
    assert dict(used) == histogram
    bound = sum(c * n for c, n in histogram.items()) / 512
    assert sum(copies for _, copies in plan) <= bound * 1.01 + 2
    assert M.plan({}, 512) == []


def check(rows, texts):
    """Pieces tile their documents, sequences their room."""
    ids = {}
    for key, text in texts.items():
        ids[key] = np.frombuffer(encoder().whole([text or ""])[0] + b"\x01\0\0\0", "<u4")
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, own in by_doc.items():
        if doc in ids:
            assert sorted((r.start, r.length) for r in own)[0][0] == 0
            assert sum(r.length for r in own) == len(ids[doc]) == own[0].doc_tokens
            for r in own:
                assert r.ids_crc32 == zlib.crc32(ids[doc][r.start : r.start + r.length].tobytes())
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= M.LENGTH
    return sum(r.length for r in rows), len(by_sequence)


def test_query(spark, sf):
    rows = M.op3_packing(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    tokens, sequences = check(rows, texts)
    assert {r.doc_id for r in rows} == set(texts)
    assert sequences * M.LENGTH < 1.02 * tokens + M.LENGTH


def test_edges(spark, tmp_path):
    rows = M.op3_packing(spark, written(spark, docs(spark, EDGES), tmp_path)).collect()
    check(rows, {i: t for i, t in EDGES if i not in (None, 6)})
    assert sum(r.doc_id == 6 and r.start == 0 for r in rows) == 2 and sum(r.doc_id is None and r.start == 0 for r in rows) == 2
    assert M.op3_packing(spark, written(spark, docs(spark, []), tmp_path)).count() == 0
