import hashlib
import random

import numpy as np
import pytest

from lexgrid.llm import substrings as M

from .helpers import EDGES, docs


def brute(rows, length=M.LENGTH):
    """(bytes, removed, spans, rest) of each (doc_id, text); a null id comes after all others."""
    raw = [((M.NULL_ID if i is None else i), (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in raw:
        for k in range(len(t) - length + 1):
            w = t[k : k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if first[t[k : k + length]] < i:
                gone[k : k + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(t), int(gone.sum()), spans, bytes(c for c, g in zip(t, gone, strict=False) if not g)))
    return out


def compare(spark, rows, **sizes):
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in M.without_repeats(spark, docs(spark, rows), ["doc_id"], **sizes).collect()), key=str)
    assert got == sorted(((i, *b) for (i, _), b in zip(rows, brute(rows), strict=True)), key=str)
    return got


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 60))) for _ in range(8)]
    out = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(0, 6))]
        text = " ".join(parts)
        if rng.random() < 0.2 and text:
            k = rng.randrange(len(text))
            text = text[:k] + "#" + text[k + 1 :]
        out.append((rng.randrange(3 * n), text))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts(spark, seed):
    assert any(r[2] for r in compare(spark, corpus(seed)))


def test_edges(spark):
    long = "ab" * 400
    rows = EDGES + [(20, long), (21, long), (22, "x" * 49), (23, "x" * 49), (24, "y" * 50), (25, "y" * 50), (26, "z" * 300), (27, "q" + "z" * 299), (None, long), (30, long + "tail"), (30, "head" + long)]
    compare(spark, rows)
    assert M.without_repeats(spark, docs(spark, []), ["doc_id"]).count() == 0


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_small_buffers_and_batches(spark, batches):
    """A very long text in parts, many levels, many shards: the same result."""
    rows = corpus(5) + [(7, " ".join(t for _, t in corpus(6, 20))), (500, " ".join(t for _, t in corpus(6, 20)))]
    compare(spark, rows, batches=batches, buffer=700, share=900)


def test_a_text_beyond_one_buffer(spark):
    """Over 1.5 MB in one document, repeated in parts by two others."""
    rng = random.Random(3)
    text = "".join(rng.choices("abcdefgh ", k=1_700_000))
    got = {r.doc_id: r for r in M.without_repeats(spark, docs(spark, [(1, text), (2, "#" + text[:900_000] + "#"), (3, text[1_500_000:])]), ["doc_id"]).collect()}
    assert [(got[i].n_removed, bytes(got[i].kept)) for i in (1, 2, 3)] == [(0, text.encode()), (900_000, b"##"), (200_000, b"")]


@pytest.mark.parametrize("scanning", [True, False])
def test_the_scan_decides(monkeypatch, scanning):
    """Without the scan of the levels, a document would keep what one of an earlier batch has: it is the index that removes."""
    passage = " ".join(f"word{i}" for i in range(30))
    if not scanning:
        monkeypatch.setattr(M.Level, "scan", lambda self, other: np.full(len(other[0]), M.NULL_ID))
    family, found = M.Family([]), []
    for i in (1, 20, 2000):
        raw = f"{i} {i} {passage if i != 20 else passage[::-1]} {i}".encode()
        found.append(int(family.enter(M.Level(np.array([len(raw)]), np.array([i]), np.frombuffer(raw, np.uint8), np.zeros(0, np.int64)))[1].sum()))
    assert found == [0, 0, len(passage) + 2 - M.LENGTH + 1 if scanning else 0]


@pytest.mark.parametrize("seed", [0, 1])
def test_family(seed):
    """Batches of random texts against brute force; levels are sorted, distinct, and as many as the batches' number has ones."""
    rng = np.random.default_rng(seed)
    family, first, live = M.Family([]), {}, []
    for batch in range(11):
        sizes = rng.integers(50, 130, 12)
        text = rng.integers(97, 99, sizes.sum()).astype(np.uint8)
        text[text == 98] = 98 + (rng.random((text == 98).sum()) < 0.02)
        for k in range(0, len(text) - 60, 200):  # much repeats
            text[k : k + 60] = 97 + (np.arange(60) * 7919 >> (k // 200 % 4)) % 3
        docs_ = np.sort(rng.integers(batch * 4, batch * 4 + 4, 12))
        at, again = family.enter(M.Level(sizes, docs_, text, np.zeros(0, np.int64)))
        owner = np.searchsorted(np.cumsum(sizes), at, "right")
        strings = [text[p : p + M.LENGTH].tobytes() for p in at]
        assert len(set(at.tolist())) == (sizes - M.LENGTH + 1).sum()
        for w, d in zip(strings, docs_[owner].tolist(), strict=True):
            first[w] = min(first.get(w, d), d)
        assert again.tolist() == [first[w] < d for w, d in zip(strings, docs_[owner].tolist(), strict=True)]
        merged, size = 0, 1
        while merged < len(live) and live[-1 - merged] == size:
            merged, size = merged + 1, 2 * size
        live[len(live) - merged :] = [size]
        newest = M.Level.unpack(family.merge(merged).pack())
        family.levels[-1] = newest
        assert len(family.levels) == bin(batch + 1).count("1")
        for level in family.levels:
            own = [level.text[p : p + M.LENGTH].tobytes() for p in level.order.tolist()]
            assert own == sorted(set(own)) and all(first[w] == level.docs[level.owner(np.array([p]))[0]] for w, p in zip(own, level.order.tolist(), strict=True))
    assert sum(len(x.order) for x in family.levels) == len(first)


def test_a_task_tells_a_shared_anchor_once():
    """What many buffers of a task share goes to its shard once; all who have it are marked."""
    passage = b"the same passage of a licence in each and every document of the table, word for word"
    told, sizes = M.Told(), []
    for k in range(3):
        out = M.survey(M.Buffer([(10 * k + i, 100 * k + i, 0, passage) for i in range(3)]), 1, told)
        sizes.append((sum(len(M.unpack(x, ["<u4", "<u4", "u1"])[0]) for _, kind, x in out if kind == 1), sum(len(M.unpack(x, ["<u8"])[0]) for _, kind, x in out if kind == 0)))
    assert sizes[0][0] > 0 and sizes[1][0] == sizes[2][0] == 0 and sizes[0][1] == sizes[1][1] == sizes[2][1] > 0


def test_blobs_of_many_buffers():
    """A task deals its anchors once for many buffers: blobs go with tasks times shards, not with buffers times shards."""
    rows, shards = [(i, 7919 * i, (t or "").encode()) for i, t in corpus(5, 200)], 4
    few, many = (list(M.buffers(rows, size)) for size in (1 << 20, 300))
    assert len(few) == 1 and len(many) > 100
    one, other = ([x for blobs in M.surveys(iter(b), shards) for x in blobs] for b in (few, many))
    assert len(other) == len(one) <= 2 * shards
    met = [sorted(np.concatenate([M.unpack(x, ["<u8"])[0] for _, _, x in [y for y in out if y[1] == 0] + [z for s in range(shards) for z in M.meet([x for to, k, x in out if (to, k) == (s, 1)], shards)]]).tolist()) for out in (one, other)]
    assert set(met[0]) == set(met[1]) and met[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_scan_of_sorted_runs(seed):
    """Ties of the first eight bytes, in one level or the other, at its ends or nowhere: the document of each equal string."""
    rng = np.random.default_rng(seed)

    def level(n):
        text = np.frombuffer(b"".join(b"abcdefgh" * int(rng.integers(1, 6)) + rng.integers(97, 99, 50).astype("u1").tobytes() for _ in range(n)), np.uint8)
        at = np.arange(max(0, len(text) - M.LENGTH + 1))
        string = [text[p : p + M.LENGTH].tobytes() for p in at]
        at = np.array(sorted({w: p for p, w in zip(at.tolist(), string, strict=True)}.values(), key=string.__getitem__), np.int64)
        return M.Level(np.array([len(text)]), np.array([n]), text, at), {string[p] for p in at}

    for n, m in ((30, 20), (1, 40), (0, 5), (5, 0)):
        (a, have), (b, _) = level(n), level(m)
        assert a.scan(b).tolist() == [n if b.text[p : p + M.LENGTH].tobytes() in have else M.NULL_ID for p in b.order.tolist()]


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {i: (n, gone, spans, hashlib.sha256(rest).hexdigest()) for (i, _), (n, gone, spans, rest) in zip(rows, brute(rows), strict=True)}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in M.op6_substrings(spark, sf).collect()} == expected
