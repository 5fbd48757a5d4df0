import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

from lexgrid.llm import bpe, idcoder
from lexgrid.llm.tokens import Encoder, batched, encoder

from .helpers import EDGES, docs, written


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.coder().ranks, special_tokens={})


def pieces():
    rng = random.Random(1)
    alphabet = "abcdefghij ABCé日ß1290.,!?\n\t'" + "🎉"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(300)] + ["ab" * 4000, "x" * 700, "日本語" * 200, "é" * 257, " " * 400, "\x00\x01" * 300] + [t or "" for _, t in EDGES]


def test_bpe_is_the_library(theirs):
    own = bpe.coder()
    for text in pieces():
        ids = own.encode([text])[0]
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_heap_and_matrix_agree():
    own = bpe.coder()
    for text in pieces()[:100]:
        raw = text.encode()[:256]
        if raw:
            assert own.long(raw) == own.merge([raw], 256)[0]


def test_bpe_query(spark, tmp_path, sf, theirs):
    for folder in (sf, written(spark, docs(spark, EDGES), tmp_path)):
        rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        expected = []
        for r in rows:
            ids = theirs.encode_ordinary(r.text or "")
            expected.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
        got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op10_bpe(spark, folder).collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
    assert bpe.op10_bpe(spark, written(spark, docs(spark, []), tmp_path)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 2047, 2048, 2049, 6000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    common = np.minimum(rng.zipf(1.3, n), 50256)
    for ids in (common, rng.integers(0, 1 << 32, n), np.zeros(n, int), np.arange(n) % 7):
        ids = ids.astype("<u4")
        tables, sizes, sums, data = idcoder.encode_ids(ids)
        assert len(sizes) == len(sums) == -(-n // idcoder.BLOCK) and (idcoder.decode_ids(tables, n, sizes, sums, data) == ids).all()


def test_a_segment_of_more_ids_than_lanes_hold(monkeypatch):
    monkeypatch.setattr(idcoder, "LANES", 3)
    monkeypatch.setattr(idcoder, "SEGMENT", 3 * idcoder.BLOCK)
    ids = np.random.default_rng(5).integers(0, 900, 8 * idcoder.BLOCK + 17).astype("<u4")
    tables, sizes, sums, data = idcoder.encode_ids(ids)
    assert (idcoder.decode_ids(tables, len(ids), sizes, sums, data) == ids).all()


def test_blocks_of_a_task_are_coded_side_by_side(monkeypatch):
    """Over two million ids, more than a thousand blocks, take no more steps than one block, each way; carries and the last, short block included."""
    steps, predict = [], idcoder.Lanes.predict
    monkeypatch.setattr(idcoder.Lanes, "predict", lambda self, n: steps.append(n) or predict(self, n))
    ids = np.minimum(np.random.default_rng(8).zipf(1.2, 1100 * idcoder.BLOCK + 77), 60_000).astype("<u4")
    tables, sizes, sums, data = idcoder.encode_ids(ids)
    assert (idcoder.decode_ids(tables, len(ids), sizes, sums, data) == ids).all()
    assert len(steps) == 2 * idcoder.BLOCK and sum(steps) == 2 * len(ids)


def test_carries_are_looked_for_in_what_was_written(monkeypatch):
    """Not in all the room that blocks could have needed."""
    seen, flatnonzero = [], np.flatnonzero
    monkeypatch.setattr(np, "flatnonzero", lambda a: seen.append(np.size(a)) or flatnonzero(a))
    ids = np.zeros(50 * idcoder.BLOCK + 9, "<u4")
    tables, sizes, sums, data = idcoder.encode_ids(ids)
    assert max(seen) <= 51 * int(sizes.max()) // 2 < len(ids) // 20
    monkeypatch.undo()
    assert (idcoder.decode_ids(tables, len(ids), sizes, sums, data) == ids).all()


@pytest.mark.parametrize("n", [(1 << 14) - 1, 1 << 14, (1 << 16) - 1])
def test_memories_are_as_wide_as_ids_need(n):
    """Two bytes a slot and less than a page of 4 KB a block and memory while places fit beside how sure they are, four from there on."""
    ids = np.random.default_rng(n).permutation(np.concatenate([np.arange(n), np.arange(6000) % 50])).astype("<u4")
    tables, sizes, sums, data = idcoder.encode_ids(ids)
    assert (idcoder.decode_ids(tables, len(ids), sizes, sums, data) == ids).all()
    assert idcoder.Lanes(idcoder.Tables.unpack(tables), 1).memory.nbytes == (4096 if n < 1 << 14 else 8192)


def test_blocks_are_words_of_32_bits():
    """So a range is widened half as often as by 16; a block ends in one word."""
    ids = np.concatenate([np.zeros(3 * idcoder.BLOCK, int), np.random.default_rng(4).integers(0, 900, idcoder.BLOCK + 5)]).astype("<u4")
    tables, sizes, sums, data = idcoder.encode_ids(ids)
    assert (sizes % 4 == 0).all() and len(data) == sizes.sum()
    assert (idcoder.decode_ids(tables, len(ids), sizes, sums, data) == ids).all()
    assert idcoder.encode_ids(ids[:1])[1].tolist() == [4]


def test_too_many_different_ids():
    with pytest.raises(ValueError, match="different ids"):
        idcoder.encode_ids(np.arange(70_000).astype("<u4"))


def test_coder_predicts():
    ids = np.tile(np.random.default_rng(1).integers(0, 50000, 50), 200).astype("<u4")
    assert len(idcoder.encode_ids(ids)[3]) < 0.05 * 4 * len(ids)


def order0(ids):
    n = np.bincount(ids)
    n = n[n > 0]
    return float(-(n / n.sum() * np.log2(n / n.sum())).sum())


def test_coder_foresees_passages():
    """Ids of ten passages in random order: what order 0 can't tell, the memories can once a passage has occurred in the block."""
    rng = np.random.default_rng(1)
    passages = [rng.integers(0, 3000, 40) for _ in range(10)]
    ids = np.concatenate([passages[k] for k in rng.integers(0, 10, 400)]).astype("<u4")
    assert 8 * len(idcoder.encode_ids(ids)[3]) / len(ids) < order0(ids) / 2


def test_coder_beats_order_0_and_zlib(sf):
    """All documents' ids, tables and checksums included."""
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table(f"{sf}/documents.parquet").column("text").to_pylist()]
    ids = np.frombuffer(b"".join(x + b"\x02\0\0\0" for x in encoder().encode(texts)), "<u4")
    tables, sizes, sums, data = idcoder.encode_ids(ids)
    bits = 8 * (len(tables) + 8 * len(sizes) + len(data)) / len(ids)
    assert bits < min(8.3, order0(ids), 8 * len(zlib.compress(ids.astype("<u2").tobytes(), 9)) / len(ids))


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(2).integers(0, 50000, 5000).astype("<u4")
    tables, sizes, sums, data = idcoder.encode_ids(ids)
    own = data[sizes[0] : sizes[0] + sizes[1]]  # the second block, decoded without the first
    assert (idcoder.decode_ids(tables, 2048, sizes[1:2], sums[1:2], own) == ids[2048:4096]).all()
    raw = bytearray(idcoder.write_segment([1, None], [4000, 1000], ids))
    docs_, lengths, back = idcoder.read_segment(bytes(raw))
    assert (docs_, lengths) == ([1, None], [4000, 1000]) and (back == ids).all()
    for at, what in ((len(raw) - 3000, "checksum"), (len(raw) - len(data) - 40, "damaged"), (0, "not a segment")):
        bad = bytearray(raw)
        bad[at] ^= 1
        with pytest.raises(ValueError, match=what):
            idcoder.read_segment(bytes(bad))


def test_id_files(spark, tmp_path, sf):
    for folder in (sf, written(spark, docs(spark, EDGES), tmp_path)):
        rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        ids = [x + b"\x02\0\0\0" for x in encoder().whole([r.text or "" for r in rows])]
        got = idcoder.op7_idcoder(spark, folder).collect()
        assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(((r.doc_id, len(x) // 4, zlib.crc32(x)) for r, x in zip(rows, ids, strict=True)), key=str)
        at = 0
        got.sort(key=lambda r: r.start)
        for r in got:
            assert r.start == at
            at += r.n_tokens
        order = [r.doc_id for r in got if r.doc_id is not None]
        assert order == sorted(order) and all(r.doc_id is None for r in got[len(order) :])
    assert idcoder.op7_idcoder(spark, written(spark, docs(spark, []), tmp_path)).count() == 0


def test_very_long_texts(theirs):
    """Beyond any batch or matrix: a text of 3 MB of words, and pieces of 100,000 letters."""
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 9))) for _ in range(500)]
    text = " ".join(rng.choices(words, k=500_000))
    own = bpe.coder()
    for each in (text, "x" * 100_000, "".join(rng.choices("abcde", k=100_000))):
        ids = own.encode([each])[0]
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(each) and own.decode(ids) == each.encode()
    assert encoder().encode([text])[0] == encoder().whole([text])[0]


def test_the_library_is_asked_for_letters_once():
    """Whatever marks follow a word, its letters go to the model once and not through the pattern."""
    rng = random.Random(4)
    stems = list(dict.fromkeys("".join(rng.choices("abcdeéñß", k=rng.randint(3, 9))) for _ in range(1000)))
    text = " ".join(s + m for s in stems for m in ("", ",", ".", "!!"))
    own = Encoder()
    whole, plain, sent, asked = own.whole, own.plain, [], []
    own.whole = lambda texts: sent.extend(texts) or whole(texts)
    own.plain = lambda words: asked.extend(words) or plain(words)
    assert own.encode([text]) == whole([text])
    assert sorted(asked) == sorted(stems) and sum(len(x) for x in sent if "Ġ" not in x) < 50


def test_marks_and_letters_that_are_not_settled():
    """Contractions, marks alone, letters of late Unicode versions, white space of Python's own, numbers that aren't digits, in any order."""
    rng = random.Random(3)
    words = ["don't", "it's,", "l'", "'s", "foo's'", "foo.", "Bar,", "é..", "x²", "½", "ª", "_a", "a_", "a_b", "日本", "日本.", "<|endoftext|>", "ab́c", "Ġa", "a.\nB", "\x1ca", "a\x1c", "a\x85", "", "\n", "Ԯԯ.", "Աբ", "ꟊ", "\U0001e900,", "..."]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 20))) for _ in range(400)]
    own = Encoder(remembered=40, longest=4)
    for part in (texts, texts[::-1], []):
        assert own.encode(part) == own.whole(part)


@pytest.mark.parametrize("remembered", [30, 700_000])
def test_ids_do_not_depend_on_chunks(remembered):
    """However much is told apart at once and however little is remembered, words that come again in other chunks included."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdeñßжԀ", k=rng.randint(1, 7))) + rng.choice(["", "", ",", ".", "!!", "1", "\n"]) for _ in range(600)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(200)]
    own = Encoder(remembered=remembered)
    whole = own.whole(texts)
    for room in (1, 500, 8 << 20):
        assert own.encode(texts, room) == whole


def test_batches_are_cut_by_the_size_of_texts():
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(7)), "text": ["a" * 30, None, "b" * 9, "", "c" * 200, "d", None]})
    parts = [(rows.column(0).to_pylist(), texts) for rows, texts in batched(batch, 1, 40)]
    assert [d for own, _ in parts for d in own] == list(range(7)) and [t for _, own in parts for t in own] == ["a" * 30, "", "b" * 9, "", "c" * 200, "d", ""]
    assert all(len(own) == 1 or sum(map(len, own)) <= 40 for _, own in parts) and [len(own) for _, own in parts] == [4, 1, 2]
