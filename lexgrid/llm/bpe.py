"""Byte-level BPE: pieces of equal length class merge together in padded numpy matrices."""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, table

RANKS = "byte_bpe_multi_50k.tiktoken"
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128, 256)  # columns of the padded matrices; longer pieces merge from a heap
CELLS = 1 << 20  # of a matrix at most
NONE = np.int64(1) << 40  # the rank of a pair that never merges


class Coder:
    """Encodes and decodes with the ranks of one vocabulary."""

    def __init__(self, path: str, pattern: str, remembered: int = 250_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        self.pairs = pairs
        self.table(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64))
        self.size = remembered
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def table(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open hash table of pairs: colliding keys move on to the next cell."""
        self.bits = int(len(keys)).bit_length() + 1
        mask = (1 << self.bits) - 1
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int64)
        at, todo, self.steps = self.hash(keys), np.arange(len(keys)), 0
        while len(todo):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[todo[free]]  # of several keys for one cell the last stays
            won = self.keys[at] == keys[todo]
            self.values[at[won]] = values[todo[won]]
            todo, at = todo[~won], (at[~won] + 1) & mask
            self.steps += 1

    def hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank that each pair of ids merges to, NONE if it doesn't; negative ids are padding."""
        keys = left << 20 | right
        at, mask = self.hash(keys), (1 << self.bits) - 1
        out = np.where(self.keys[at] == keys, self.values[at], NONE)
        more = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] >= 0) & (left >= 0) & (right >= 0))
        at = at[more]
        while len(more):
            at = (at + 1) & mask
            found = self.keys[at] == keys[more]
            out[more[found]] = self.values[at[found]]
            on = ~found & (self.keys[at] >= 0)
            more, at = more[on], at[on]
        return np.where((left < 0) | (right < 0), NONE, out)

    def merge(self, pieces: list[bytes], width: int) -> list[bytes]:
        """The ids of pieces of at most `width` bytes. Each round merges the leftmost pair of least rank in every row that has one."""
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, n)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        ids = np.full((n, width), -1, np.int64)
        ids[np.arange(width) < sizes[:, None]] = self.byte[flat]
        rows = np.arange(n)
        out: list[bytes] = [b""] * n
        ranks = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
        while True:
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            live = least < NONE
            if not live.all():
                done = np.flatnonzero(~live)
                self.finish(out, rows[done], ids[done], sizes[done])
                keep = np.flatnonzero(live)  # finished rows leave the matrix
                rows, ids, sizes, at, least, ranks = rows[keep], ids[keep], sizes[keep], at[keep], least[keep], ranks[keep]
                if not len(rows):
                    return out
            r = np.arange(len(rows))
            w = ids.shape[1]
            ids[r, at] = least
            columns = np.arange(w - 1)
            shift = columns > at[:, None]  # what lies right of the pair moves one cell to the left
            ids[:, :-1] = np.where(shift, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            if w > 2:
                ranks[:, :-1] = np.where(shift[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NONE
            sizes = sizes - 1
            ranks[r, at] = np.where(at < w - 1, self.rank(ids[r, at], ids[r, np.minimum(at + 1, w - 1)]), NONE)
            has = np.flatnonzero(at > 0)
            ranks[has, at[has] - 1] = self.rank(ids[has, at[has] - 1], ids[has, at[has]])
            most = max(int(sizes.max()), 2)
            if most <= w // 2:  # the columns that no row needs any more go
                ids, ranks = ids[:, :most].copy(), ranks[:, : most - 1].copy()

    @staticmethod
    def finish(out: list[bytes], rows: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        raw = ids[np.arange(ids.shape[1]) < sizes[:, None]].astype("<u4").tobytes()
        cuts = [0, *(np.cumsum(sizes) * 4).tolist()]
        for row, a, b in zip(rows.tolist(), cuts, cuts[1:], strict=False):
            out[row] = raw[a:b]

    def long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: pairs wait in a heap by rank and place, so time grows as n log n."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        find = self.pairs.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := find(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue  # one of the two has merged since
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := find(rank << 20 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[k]))
            if (h := before[i]) >= 0 and (r := find(ids[h] << 20 | rank)) is not None:
                heapq.heappush(heap, (r, h, ids[h], rank))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def pieces(self, words: list[str]) -> dict[str, bytes]:
        """The ids of distinct matches of the pattern. A piece that is a token is that token."""
        out, by = {}, {w: [] for w in WIDTHS}
        for word in words:
            raw = word.encode("utf-8", "surrogatepass")
            rank = self.ranks.get(raw)
            if rank is not None:
                out[word] = rank.to_bytes(4, "little")
                continue
            width = next((w for w in WIDTHS if len(raw) <= w), 0)
            if width:
                by[width].append((word, raw))
            else:
                out[word] = self.long(raw)
        for width, own in by.items():
            for i in range(0, len(own), CELLS // width):
                part = own[i : i + CELLS // width]
                out.update(zip((w for w, _ in part), self.merge([r for _, r in part], width), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(x) for x in texts]
        found = [list(map(self.new.get, x)) for x in split]
        missed: dict[str, bytes | None] = {}
        for words, ids in zip(split, found, strict=True):
            if None in ids:
                missed.update((w, None) for w, x in zip(words, ids, strict=True) if x is None)
        fresh = []
        for w in missed:
            missed[w] = self.old.get(w)
            if missed[w] is None:
                fresh.append(w)
        missed.update(self.pieces(fresh))
        out = []
        for words, ids in zip(split, found, strict=True):
            if None in ids:
                ids = [missed[w] if x is None else x for w, x in zip(words, ids, strict=True)]
            out.append(b"".join(ids))
        self.new.update((w, x) for w, x in missed.items() if len(w) <= 48)
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        return out

    def decode(self, ids: bytes) -> bytes:
        many = np.frombuffer(ids, "<u4").tolist()
        return b"".join(itemgetter(*many)(self.tokens)) if len(many) > 1 else b"".join(self.tokens[i] for i in many)


@cache
def coder(path: str | None = None, pattern: str | None = None) -> Coder:
    """One for each Python worker."""
    import public_tokenizers

    return Coder(path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN)


def encode_docs(docs: DataFrame, path: str | None = None, pattern: str | None = None, key: str = "doc_id", keep: bool = True) -> DataFrame:
    """(key, ids, decoded) of every row: ids and what they decode to as binary; keep=False: only (key, n_tokens, ids_sha256, decoded_sha256)."""
    tail = "ids binary, decoded binary" if keep else "n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        own = coder(path, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                ids = own.encode([x or "" for x in part.column(1).to_pylist()])
                back = [own.decode(x) for x in ids]
                if keep:
                    cells = {"ids": pa.array(ids, pa.binary()), "decoded": pa.array(back, pa.binary())}
                else:
                    cells = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_sha256": [sha(x) for x in ids], "decoded_sha256": [sha(x) for x in back]}
                yield pa.RecordBatch.from_pydict({"key": part.column(0).cast(pa.int64())} | cells)

    return docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), f"key long, {tail}").withColumnRenamed("key", key)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: ids as the tiktoken library gives them, and what they decode to.

    A null text counts as empty: no ids. Rows are independent, so repeated rows, repeated doc_ids and null doc_ids each
    give their own row. An empty table gives no row.
    """
    return encode_docs(table(spark, sf_dir, "documents"), keep=False)
