import zlib

import numpy as np

from lexgrid.llm import language as M

from .helpers import docs, written


def test_held_out_accuracy(spark, tmp_path):
    source = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in M.op5_language(spark, source).collect()}
    rows = spark.read.parquet(f"{source}/documents.parquet").select("doc_id", "lang").collect()
    assert len(out) == len(rows)
    hits = [out[r.doc_id].lang_pred == r.lang for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(hits) > 200 and np.mean(hits) > 0.98
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out.values())


def test_presence_is_blockwise_the_same(monkeypatch):
    text = "Ein Satz, äöü und 123 mehr. " * 40
    whole = M.presence(text)
    monkeypatch.setattr(M, "BLOCK", 37)
    assert (M.presence(text) == whole).all() and whole.sum() > 20


def test_edges(spark, tmp_path):
    rows = [(i, f"the cat and the dog {i} went home with them", "en") for i in range(40)] + [(100 + i, f"der Hund und die Katze {i} gehen nach Haus", "de") for i in range(40)]
    rows += [(200, None, "en"), (201, "", None), (202, "123 !!", "de"), (203, "the dog", None), (None, "die Katze", None), (203, "the dog", None), (204, "Ω", "en"), (205, "the dog and the cat " * 30_000, None)]
    out = M.op5_language(spark, written(spark, docs(spark, rows), tmp_path)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert by[200] == by[201] == by[202] == [("und", 0.0)]
    assert by[203][0] == by[203][1] and by[203][0][0] == "en" and by[None][0][0] == "de" and by[205][0][0] == "en"
    assert by[204][0][0] in ("en", "de")


def test_no_labels_and_no_rows(spark, tmp_path):
    out = M.op5_language(spark, written(spark, docs(spark, [(1, "abc"), (2, None)]), tmp_path)).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)] * 2
    assert M.op5_language(spark, written(spark, docs(spark, []), tmp_path)).count() == 0


def test_every_label_is_learned(spark):
    """More labels than the 256 that were learned before, the last ones rarer."""
    import random

    rng = random.Random(3)
    words = {f"l{k:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(5)] for k in range(290)}
    rows = [(i, " ".join(rng.sample(words[y], 4)), y) for i, y in enumerate(y for k, y in enumerate(words) for _ in range(12 if k < 256 else 8))]
    table = docs(spark, rows)
    got = M.predict(table.select("lang", "text"), M.train(table)).select("lang", "lang_pred").collect()
    assert len(got) == len(rows) and np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert {r.lang_pred for r in got} == set(words)


def test_blocks_of_the_fit_add_up():
    rng = np.random.default_rng(1)
    bits, labels = rng.integers(0, 256, (300, M.DIM // 8), np.uint8), [f"l{k % 3}" for k in range(300)]
    one, many = M.fit(bits, labels), M.fit(bits, labels, block=17)
    assert np.allclose(one.weights, many.weights, atol=1e-5) and abs(one.usual - many.usual) < 1e-3


def plain_presence(text):
    """The hashed n-grams of a text, one by one."""
    raw = b" " + bytes(b if b > 127 or chr(b).isalpha() else 32 for b in text.lower().encode()) + b" "
    out = set()
    for n in M.GRAMS:
        for i in range(len(raw) - n + 1):
            code = int.from_bytes(raw[i : i + n], "big")
            out.add((((code * 2654435761 + n * 40503) & 0xFFFFFFFF) * 2246822519 & 0xFFFFFFFF) >> 19)
    return out


def test_presence_against_plain_python():
    for text in ("", "a", "The cat, the CAT!", "Ähre über Öl 12", "日本語 text"):
        assert set(np.flatnonzero(M.presence(text)).tolist()) == plain_presence(text)


def test_scores_against_plain_regression():
    """The kernel by sets, and the ridge regression on the landmarks solved in its dual form, without features."""
    import random

    rng = random.Random(7)
    words = {y: ["".join(rng.choices(letters, k=6)) for _ in range(40)] for y, letters in (("a", "abcdefgh"), ("b", "efghijkl"), ("c", "ijklmnop"))}
    texts = [(" ".join(rng.choices(words[y], k=12)), y) for y in "aaabbc" * 25]
    bits = np.stack([np.packbits(M.presence(x) > 0) for x, _ in texts])
    labels = [y for _, y in texts]
    model = M.fit(bits, labels)
    sets = [plain_presence(x) for x, _ in texts]
    marks = [set(np.flatnonzero(column).tolist()) for column in model.landmarks.T]
    assert all(m in sets for m in marks) and len(marks) <= M.LANDMARKS + 2
    kernel = lambda a, b: np.array([[len(x & y) / (len(x) * len(y)) ** 0.5 for y in b] for x in a])
    names = sorted(set(labels))
    goal = np.array([[1.0 if y == z else -1.0 for z in names] + [1.0] for y in labels])
    share = np.array([1 / labels.count(y) for y in labels])
    k, m = kernel(sets, marks), kernel(marks, marks)
    alpha = np.linalg.lstsq((k * share[:, None]).T @ k + M.RIDGE / len(texts) * m, (k * share[:, None]).T @ goal, rcond=1e-12)[0]
    asked = [" ".join(rng.choices(words[y], k=9)) for y in "abcabc"] + ["zzz unlike", "abc"]
    got, plain = model.scores(asked), kernel([plain_presence(x) for x in asked], marks) @ alpha
    assert np.abs(got - plain).max() < 1e-3 and (got[:, :-1].argmax(1) == plain[:, :-1].argmax(1)).all()


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    """Texts of one length and no doc_id are samples of their own; equal ones are drawn once."""
    rows = [(None, f"{w} {w} {i:03d}", y) for i in range(40) for w, y in (("abcd", "x"), ("wxyz", "y"))]
    model = M.train(docs(spark, rows + rows[:10]))
    assert model.labels == ["x", "y"] and model.landmarks.shape[1] == 80
