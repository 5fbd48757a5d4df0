"""Token-id files: blocks of ids, each reset and checksummed on its own, by an adaptive context-mixing range coder."""

from __future__ import annotations

import struct
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Store, hold, lean, partitions, table
from .tokens import batched, encoder

BLOCK = 2048  # ids; a block starts from the segment's tables and an empty memory
LANES = 4096  # blocks coded side by side: step k works on the k-th id of each
SEGMENT = BLOCK * LANES  # ids after which a segment ends with its document
ROOM = 8 << 20  # bytes of text tokenized at once
END = 2  # the id after each document
MAGIC = b"LXID3"
GROUPS = 16  # of ids that are followed alike: each has a table of what follows it
ROUNDS = 5  # of grouping
ONE, FINE = 12, 16  # bits of the probability that a guess holds, and of the tables'
SLOTS = 10  # bits of each block's memory of what followed an id, and of what followed two
CELLS = 32, 128  # adaptive probabilities of a block, of either kind
LOW, WORD = 30, 32  # a range below 1 << LOW is widened by a WORD
FLOOR, RATE = 2.0**-13, 2.0**-4  # what adaptive probabilities keep from 0 and 1, and how fast they move

i64 = np.int64
#: Where the adaptive probabilities start, of 1 << 16: the better what speaks for the guess, the likelier.
START = np.array(
    [1500 + 3500 * (k // 2) for k in range(32)] + [1000 + 8000 * (k >> 5) + 2000 * (k >> 3 & 3) + 5000 * (k >> 2 & 1) + 3000 * (k & 3) for k in range(128)],
    np.float32,
) / np.float32(1 << 16)


def placed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct ids, ascending; each id's place among them)."""
    if not len(ids) or ids.max() >= 1 << 22:
        return np.unique(ids, return_inverse=True)
    known = np.zeros(int(ids.max()) + 1, bool)
    known[ids] = True
    return np.flatnonzero(known), (np.cumsum(known, dtype=np.int32) - np.int32(1))[ids]


class Tables(NamedTuple):
    """The order-0 and order-1 predictions that every block of a segment starts from; they stand in its head."""

    ids: np.ndarray  # the distinct ids, ascending; below, an id is its place here
    group: np.ndarray  # of each id, and of a block's start, as what comes before
    freq: np.ndarray  # groups x ids, each group's row adding up to 1 << FINE; 0 where an id never follows

    @classmethod
    def of(cls, names: np.ndarray, x: np.ndarray) -> Tables:
        """Of a segment's ids, as placed(). Groups grow by likelihood: each id joins the group whose table codes its followers best."""
        d = len(names)
        if d >= 1 << FINE:
            raise ValueError(f"a segment holds at most {(1 << FINE) - 1} different ids")
        if not d:
            return cls(names.astype("<u4"), np.zeros(1, np.uint8), np.zeros((1, 0), np.int64))
        after = x.astype(np.uint32)
        pair = np.concatenate([after[:1], after[:-1]])
        pair[::BLOCK] = d
        pair *= d
        pair += after
        pair, n = np.unique(pair, return_counts=True)  # numbers of 32 bits are sorted much faster than longer ones
        pair = pair.astype(i64)
        of, follows = pair // d, pair % d
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        owner = of[first]
        weight = np.add.reduceat(n, first)
        k = min(GROUPS, len(owner))
        base = np.bincount(follows, n, d) / n.sum()
        group = np.full(d + 1, -1)
        group[owner[np.argsort(-weight, kind="stable")[:k]]] = np.arange(k)
        for _ in range(ROUNDS):
            own = group[of]
            seen = np.bincount(own[own >= 0] * d + follows[own >= 0], n[own >= 0], k * d).reshape(k, d)
            logs = np.log((seen + 2 * base) / (seen.sum(1, keepdims=True) + 2))
            fits = [np.add.reduceat(n * logs[j][follows], first) for j in range(k)]
            group[owner] = np.argmax(fits, 0)
        group = np.maximum(group, 0)
        seen = np.bincount(group[of] * d + follows, n, k * d).reshape(k, d).astype(i64)
        there = seen > 0
        freq = np.where(there, np.maximum(1, seen * ((1 << FINE) - there.sum(1, keepdims=True)) // np.maximum(seen.sum(1, keepdims=True), 1)), 0)
        rows = np.flatnonzero(there.any(1))
        freq[rows, freq[rows].argmax(1)] += (1 << FINE) - freq[rows].sum(1)
        return cls(names.astype("<u4"), group.astype(np.uint8), freq)

    def pack(self) -> bytes:
        flat = self.freq.T.astype("<u4").tobytes()  # an id's cells side by side
        return struct.pack("<II", *self.freq.shape) + zlib.compress(np.diff(self.ids, prepend=0).astype("<u4").tobytes() + self.group.tobytes() + flat, 6)

    @classmethod
    def unpack(cls, raw: bytes) -> Tables:
        k, d = struct.unpack_from("<II", raw)
        flat = zlib.decompress(raw[8:])
        ids = np.cumsum(np.frombuffer(flat, "<u4", d)).astype("<u4")
        return cls(ids, np.frombuffer(flat, np.uint8, d + 1, 4 * d), np.frombuffer(flat, "<u4", k * d, 5 * d + 1).reshape(d, k).T.astype(i64))


class Lanes:
    """The models of several blocks, and either end of their range coders.

    Two memories hold the id that last followed the same one or two ids of the block. The guess is what order 2 remembers,
    else what order 1 does. Whether it holds is one binary symbol: its probability mixes two adaptive ones, which are
    looked up by what the order-0 and order-1 tables give the guess, and by how sure both memories are and how guesses
    went lately; each weighs by how well it did. An id that wasn't guessed is a second symbol, coded by the table of the
    id before it. Arithmetic is on integers, or one rounded operation at a time on floats, so every machine decodes alike.
    """

    def __init__(self, tables: Tables, n: int, words: list[bytes] | None = None):
        k, d = tables.freq.shape
        self.d, self.ids = d, tables.ids
        self.kind = kind = np.uint16 if d < 1 << 14 else np.uint32  # of an id and how sure it is, in two bits
        self.group = tables.group.astype(i64)
        start = np.cumsum(tables.freq, 1) - tables.freq
        self.share = (start << FINE | (tables.freq - 1) & ((1 << FINE) - 1)).astype(np.uint32).ravel()
        self.grade = (2 * np.minimum(np.frexp(tables.freq.ravel().astype(float))[1], 15)).astype(kind)
        lane = np.arange(n)
        self.slot = np.stack([lane, lane]) * (2 << SLOTS) + np.array([[0], [1 << SLOTS]])
        self.cell = np.stack([lane, lane]) * sum(CELLS) + np.array([[0], [CELLS[0]]])
        self.i, self.k = np.empty((2, n), i64), np.empty((2, n), i64)
        self.memory = np.zeros(n * (2 << SLOTS), kind)
        self.cells = np.tile(START, n)
        self.merit = np.full((2, n), 0.5, np.float32)
        self.recent = np.zeros(n, kind)
        self.before = self.before2 = np.full(n, d)
        self.range, self.low = np.full(n, 1 << (LOW + WORD), i64), np.zeros(n, i64)
        if words is not None:
            self.lookup = np.zeros((k, 1 << FINE), np.uint16)
            for j, f in enumerate(tables.freq):
                if f.any():
                    self.lookup[j] = np.repeat(np.arange(d), f)
            self.lookup = self.lookup.ravel()
            size = np.array([len(w) // 4 + 3 for w in words])  # zeros stand after each block's words
            self.end = np.cumsum(size) - 2
            self.at = self.end + 2 - size
            raw = np.zeros(size.sum(), i64)
            for j, w in zip(self.at.tolist(), words, strict=True):
                raw[j : j + len(w) // 4] = np.frombuffer(w, ">u4", len(w) // 4)
            self.low += raw[self.at] << LOW | raw[self.at + 1] >> (WORD - LOW)
            self.at += 1
            self.words = ((raw[:-1] << LOW | raw[1:] >> (WORD - LOW)) & ((1 << WORD) - 1)).astype(np.uint32)  # what comes LOW bits after

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(guess, probability that it holds, the group of the id before) for the first n lanes."""
        one, self.i, self.k = self.before[:n], self.i[:, :n], self.k[:, :n]
        self.i[0] = one
        np.multiply(one, 40503, out=self.i[1])
        self.i[1] += self.before2[:n]
        self.i &= (1 << SLOTS) - 1
        self.i += self.slot[:, :n]
        self.e = self.memory.take(self.i, mode="wrap")  # which is faster; all are there
        self.sure, self.said = self.e & 3, self.e >> 2
        guess = self.said[1] + (self.e[1] == 0) * self.said[0]  # np.where is slower where neither side is likelier
        agree = self.said[0] == self.said[1]
        group = self.group.take(one)
        at = group * self.d
        at += guess
        np.add(self.grade.take(at, mode="wrap") + agree, self.cell[0, :n], out=self.k[0])
        trust = self.sure[1] << 2
        trust += self.sure[0]
        trust += trust
        trust += agree
        trust <<= 2
        trust += self.recent[:n]
        np.add(trust, self.cell[1, :n], out=self.k[1])
        self.p = self.cells.take(self.k, mode="wrap")
        w = np.square(self.merit[:, :n])
        v = w * self.p
        mixed = v[0] + v[1]
        mixed /= w[0] + w[1]
        mixed *= (1 << ONE) - 2
        p = mixed.astype(i64)
        p += 1
        return guess, p, group

    def learn(self, n: int, ids: np.ndarray, hit: np.ndarray) -> None:
        """ids: what came, of the memory's kind."""
        off = hit * np.float32(1 - 2 * FLOOR) + np.float32(FLOOR) - self.p
        self.cells[self.k] = self.p + off * np.float32(RATE)
        merit = self.merit[:, :n]
        np.abs(off, out=off)
        off += merit
        off -= 1
        off *= np.float32(RATE)
        merit -= off
        same = self.said == ids
        new = ids << 2
        new += 1
        value = self.e + same  # one more if right, one less if wrong
        value += same & (self.sure < 3)
        value -= 1
        same |= self.sure > 1
        value -= new
        value *= same
        value += new
        self.memory[self.i] = value
        recent = self.recent[:n]
        recent += recent
        recent += hit
        recent &= 3
        self.before2, self.before = self.before, ids.astype(i64)

    def encode(self, grid: np.ndarray, last: int) -> list[bytes]:
        """grid: lanes x steps of ids as places in the tables; the last lane has `last` ids."""
        lanes, steps = grid.shape
        grid = np.ascontiguousarray(grid.astype(self.kind, copy=False).T)
        owner, out = [], []
        for k in range(steps):
            n = lanes if k < last else lanes - 1
            if not n:
                break
            x = grid[k, :n]
            guess, p, at = self.predict(n)
            hit = guess == x
            at *= self.d
            at += x
            share = self.share.take(at, mode="wrap").astype(i64)
            low, span = self.low[:n], self.range[:n]
            yes = span >> ONE
            yes *= p
            fine = span - yes
            fine >>= FINE
            over = share >> FINE
            over *= fine
            over += yes
            over *= ~hit
            low += over
            share &= (1 << FINE) - 1
            share += 1
            share *= fine
            yes -= share
            yes *= hit
            np.add(yes, share, out=span)
            less = np.flatnonzero(span < 1 << LOW)
            if len(less):
                was = low[less]
                owner.append(less)
                out.append(was >> LOW)  # a 33rd bit is a carry, resolved at the end
                was &= (1 << LOW) - 1
                was <<= WORD
                low[less] = was
                span[less] = span[less] << WORD
            self.learn(n, x, hit)
        owner.append(np.arange(lanes))
        out.append((self.low + ((1 << LOW) - 1)) >> LOW)  # the range holds a number that ends in zeros
        owner = np.concatenate(owner).astype(np.uint16 if lanes <= 1 << 16 else i64)
        out = np.concatenate(out)[np.argsort(owner, kind="stable")]
        carry = np.flatnonzero(out >> WORD)
        while len(carry):  # few, and seldom one after another
            out[carry] &= (1 << WORD) - 1
            out[carry - 1] += 1
            carry = (carry - 1)[out[carry - 1] >> WORD > 0]
        raw = out.astype(">u4").tobytes()
        cuts = np.cumsum(4 * np.bincount(owner, minlength=lanes)).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def decode(self, steps: int, last: int) -> np.ndarray:
        lanes = len(self.range)
        grid = np.zeros((steps, lanes), self.kind)
        for k in range(steps):
            n = lanes if k < last else lanes - 1
            if not n:
                break
            guess, p, at = self.predict(n)
            code, span = self.low[:n], self.range[:n]
            yes = span >> ONE
            yes *= p
            hit = code < yes
            miss = ~hit
            fine = span - yes
            fine >>= FINE
            place = code - yes
            place *= miss
            place //= fine
            np.minimum(place, (1 << FINE) - 1, out=place)
            place += at << FINE
            x = self.lookup.take(place, mode="wrap").astype(self.kind, copy=False)
            guess -= x
            guess *= hit
            x += guess
            at *= self.d
            at += x
            share = self.share.take(at, mode="wrap").astype(i64)
            over = share >> FINE
            over *= fine
            over += yes
            over *= miss
            code -= over
            share &= (1 << FINE) - 1
            share += 1
            share *= fine
            yes -= share
            yes *= hit
            np.add(yes, share, out=span)
            less = np.flatnonzero(span < 1 << LOW)
            if len(less):
                at = self.at[less]
                code[less] = code[less] << WORD | self.words.take(np.minimum(at, self.end[less]))
                self.at[less] = at + 1
                span[less] = span[less] << WORD
            self.learn(n, x, hit)
            grid[k, :n] = x
        return self.ids.take(grid.T)


def encode_ids(ids: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, bytes]:
    """(tables, bytes of each block, checksums of each block's ids, data)."""
    names, x = placed(ids)
    tables, parts = Tables.of(names, x), []
    for at in range(0, len(ids), SEGMENT):
        own = x[at : at + SEGMENT]
        lanes = -(-len(own) // BLOCK)
        last = len(own) - (lanes - 1) * BLOCK
        grid = np.zeros((lanes, BLOCK), np.int32)
        grid.ravel()[: len(own)] = own
        steps = BLOCK if lanes > 1 else last
        parts += Lanes(tables, lanes).encode(grid[:, :steps], last)
    raw = ids.astype("<u4").tobytes()
    sums = [zlib.crc32(raw[4 * a : 4 * (a + BLOCK)]) for a in range(0, len(ids), BLOCK)]
    return tables.pack(), np.array([len(x) for x in parts], "<u4"), np.array(sums, "<u4"), b"".join(parts)


def decode_ids(tables: bytes, count: int, sizes: np.ndarray, sums: np.ndarray, data: bytes) -> np.ndarray:
    """The ids again; raises ValueError where a block differs from its checksum. Any run of whole blocks decodes alone."""
    model = Tables.unpack(tables)
    cuts = [0, *np.cumsum(sizes, dtype=i64).tolist()]
    blocks = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    out = []
    for at in range(0, len(blocks), LANES):
        own = blocks[at : at + LANES]
        left = min(count - at * BLOCK, len(own) * BLOCK)
        last = left - (len(own) - 1) * BLOCK
        steps = BLOCK if len(own) > 1 else last
        out.append(Lanes(model, len(own), own).decode(steps, last).ravel()[:left])
    ids = np.concatenate(out).astype("<u4") if out else np.zeros(0, "<u4")
    raw = ids.tobytes()
    bad = [k for k, s in enumerate(sums.tolist()) if zlib.crc32(raw[4 * k * BLOCK : 4 * (k + 1) * BLOCK]) != s]
    if bad:
        raise ValueError(f"blocks {bad[:5]} differ from their checksums")
    return ids


def write_segment(docs: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """MAGIC, counts, the documents' numbers (and which are null) and lengths, blocks' sizes and checksums, tables, a checksum of all that, data."""
    tables, sizes, sums, data = encode_ids(ids)
    head = MAGIC + struct.pack("<QQQQ", len(docs), len(ids), len(sizes), len(tables))
    head += np.array([d or 0 for d in docs], "<i8").tobytes() + bytes(d is None for d in docs) + np.array(lengths, "<u8").tobytes() + sizes.tobytes() + sums.tobytes() + tables
    return head + struct.pack("<I", zlib.crc32(head)) + data


def read_segment(raw: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    if raw[: len(MAGIC)] != MAGIC or len(raw) < len(MAGIC) + 36:
        raise ValueError("not a segment of token ids")
    n, count, blocks, more = struct.unpack_from("<QQQQ", raw, len(MAGIC))
    at = len(MAGIC) + 32
    tables = at + n * 17 + blocks * 8
    end = tables + more
    if len(raw) < end + 4 or struct.unpack_from("<I", raw, end)[0] != zlib.crc32(raw[:end]):
        raise ValueError("a damaged segment of token ids")
    docs = np.frombuffer(raw, "<i8", n, at).tolist()
    null = raw[at + 8 * n : at + 9 * n]
    lengths = np.frombuffer(raw, "<u8", n, at + 9 * n).tolist()
    sizes, sums = (np.frombuffer(raw, "<u4", blocks, at + 17 * n + k * 4 * blocks) for k in (0, 1))
    return [None if z else d for d, z in zip(docs, null, strict=True)], lengths, decode_ids(raw[tables:end], count, sizes, sums, raw[end + 4 :])


def segments(docs: DataFrame, end: int = END, path: str | None = None) -> DataFrame:
    """(part, segment, first, n_ids, payload): the documents' ids in ascending doc_id order, nulls last, equal ones by their text.

    first counts the ids of a part's earlier segments.
    """
    n = partitions(docs.sparkSession)

    def run(batches):
        part, at, tail = TaskContext.get().partitionId(), 0, np.array([end], "<u4").tobytes()
        ids, own, lengths, held, first = [], [], [], 0, 0
        hold()

        def emit():
            nonlocal ids, own, lengths, held, at, first
            payload = write_segment(own, lengths, np.frombuffer(b"".join(ids), "<u4"))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "segment": pa.array([at], pa.int32()), "first": pa.array([first], pa.int64()), "n_ids": pa.array([held], pa.int64()), "payload": pa.array([payload], pa.binary())})
            ids, own, lengths, held, at, first = [], [], [], 0, at + 1, first + held
            return row

        for batch in batches:
            for piece, texts in batched(batch, 1, ROOM):
                for d, x in zip(piece.column(0).to_pylist(), encoder(path).encode(texts, ROOM), strict=True):
                    ids.append(x + tail)
                    own.append(d)
                    lengths.append(len(x) // 4 + 1)
                    held += lengths[-1]
                    if held >= SEGMENT:
                        yield emit()
        if own:
            yield emit()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    return rows.repartitionByRange(n, *key).sortWithinPartitions(*key).mapInArrow(lean(run), "part int, segment int, first long, n_ids long, payload binary")


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in written segments; start counts the ids of all documents before it.

    Parts start after the totals of the parts before theirs. There is one row for each task that wrote, so what is
    broadcast is as long as the number of shuffle partitions.
    """
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))

    def run(batches):
        hold()
        for batch in batches:
            for k in range(batch.num_rows):
                docs, lengths, ids = read_segment(batch.column(0)[k].as_py())
                raw, ends = ids.tobytes(), np.cumsum(lengths).tolist()
                begin = [e - n for e, n in zip(ends, lengths, strict=True)]
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin, ends, strict=True)]
                start = batch.column(1)[k].as_py()
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(docs, pa.int64()), "start": pa.array([a + start for a in begin], pa.int64()), "n_tokens": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    found = files.join(F.broadcast(parts), "part")
    return found.select("payload", (F.col("first") + F.col("part_start")).alias("start")).mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_idcoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written in segments in ascending doc_id order and read back; see segments() and read_ids().

    doc_id, start, n_tokens (with the end id), ids_crc32. A null or empty text is its end id alone. Rows of equal or null
    doc_id are documents of their own. A table without rows gives none.
    """
    return read_ids(Store(spark, "idcoder").keep(segments(table(spark, sf_dir, "documents"))))
