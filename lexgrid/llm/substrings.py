"""Repeated byte strings across documents: a logarithmic family of suffix arrays, merge-scanned batch by batch."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Store, column, groups, lean, partitions, table

LENGTH = 50  # bytes of a match
GRAM = 16  # bytes by which suffixes are sampled; each match holds LENGTH - GRAM + 1 of them
BUFFER = 1 << 20  # bytes of text that a task looks at at once
SHARE = 4 << 20  # bytes of text whose anchors one shard gets
SPREAD = 2  # shards' worth of text to one shard of the index, which holds only what may repeat
BATCHES = 3  # by doc_id, that enter the index one after another
LEVEL, QUICK = 5, 1  # of compression: of texts, and of hashes, which hardly shrink
NEAR = 1 << 16  # places looked at at once within a buffer
HELD = 1 << 20  # anchors that a task sorts and deals at once
TOLD = 1 << 20  # hashes that a task remembers having sent on
PLACE = np.uint64((1 << 24) - 1)
NULL_ID = (1 << 63) - 1  # stands for a null doc_id: no document is after it

u64 = np.uint64


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random words for bytes, and the powers of an odd base and of its inverse modulo 2 ** 64."""
    rng = np.random.default_rng(50)
    base = int(rng.integers(1 << 62)) * 2 + 1
    inverse = pow(base, -1, 1 << 64)

    def upto(x: int) -> np.ndarray:
        out = np.full(n, x, u64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return rng.integers(1 << 63, size=256).astype(u64) * u64(2) + u64(1), upto(base), upto(inverse)


class Hashes:
    """Hashes of any substrings of a buffer, from prefix sums."""

    def __init__(self, t: np.ndarray):
        n = len(t)
        words, up, self.down = powers(1 << max(21, n.bit_length()))
        self.sums = np.zeros(n + 1, u64)
        np.cumsum(words[t] * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[start]
        return (x ^ (x >> u64(31))) * u64(0x9E3779B97F4A7C15) ^ (end - start).astype(u64)


def sample(t: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, anchor, hash): the runs of match starts that have one anchor, for documents [start, end) of the buffer.

    A match's anchor is the leftmost of its GRAMs with the least hash, so equal strings have it at the same place, and
    only suffixes that start at anchors (about one in 18) need to be indexed.
    """
    n = len(t)
    padded = np.concatenate([t, np.zeros(2 * LENGTH, np.uint8)])
    words = np.ndarray(n + LENGTH, "<u8", padded, strides=(1,))

    def grams(at):
        h = words[at] * u64(0x9E3779B97F4A7C15) ^ (words[at + 8 if isinstance(at, np.ndarray) else slice(at.start + 8, at.stop + 8)] + u64(0x632BE59BD9B4E019)) * u64(0xC2B2AE3D27D4EB4F)
        h ^= h >> u64(29)
        h *= u64(0xBF58476D1CE4E5B9)
        h ^= h >> u64(32)
        return h

    span = LENGTH - GRAM + 1
    anchor = np.zeros(max(0, n - span + 1), np.int32)
    for low in range(0, len(anchor), NEAR):  # what is worked on stays in the processor's cache
        high = min(low + NEAR, len(anchor))
        least = grams(slice(low, high + span - 1))
        least &= ~PLACE
        least |= np.arange(low, high + span - 1, dtype=u64)
        reach = 1
        while reach < span:
            step = min(reach, span - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        anchor[low:high] = least & PLACE
    ok = np.zeros(n + 2, np.int8)
    long = end - start >= LENGTH
    ok[start[long]] += 1
    ok[end[long] - LENGTH + 1] -= 1
    ok = np.cumsum(ok, dtype=np.int8)[: len(anchor)].astype(bool)
    new = ok.copy()
    new[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    stop = ok.copy()
    stop[:-1] &= ~ok[1:] | new[1:]
    found = anchor[first].astype(np.int64)
    return first, np.flatnonzero(stop), found, grams(found)


@cache
def compressor(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level)


def pack(arrays: list[np.ndarray], level: int = LEVEL) -> bytes:
    raw = [a.tobytes() for a in arrays]
    return compressor(level).compress(struct.pack(f"<{len(raw)}q", *map(len, raw)) + b"".join(raw))


def unpack(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = struct.unpack_from(f"<{len(kinds)}q", raw), 8 * len(kinds), []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def begins(x: np.ndarray) -> np.ndarray:
    """Which of sorted values begin a run of equal ones."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return new


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[begins(x)]


def by_number(to: np.ndarray) -> np.ndarray:
    """The stable order of small numbers from 0."""
    return np.argsort(to.astype(np.uint16) if len(to) and to.max() < 1 << 16 else to, kind="stable")


def digests(t: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of strings of at least 8 bytes, to hold against one another."""
    words = np.ndarray(len(t) + 1, "<u8", np.concatenate([t, np.zeros(8, np.uint8)]), strides=(1,))
    size, last = end - start, end - 8
    x = size.astype(u64) * u64(0xD6E8FEB86659FD93)
    for k in range(0, int(size.max()) if len(size) else 0, 8):
        x ^= words[np.minimum(start + k, last)]
        x *= u64(0x9E3779B97F4A7C15)
        x ^= x >> u64(29)
    return x


def slices(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions start .. start + size - 1, one range after another."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


CONTEXT = ["u1", "<u4", "<i8", "<i8", "<i8", "u1"]  # lengths; per place: context, document, its text's hash, position; bytes
SPANS = ["<i8", "<i8", "<i8", "<i8"]  # document, its text's hash, start, end


def marks(key: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A word for an anchor (32 of its hash's bits that are still even among minima) in a document (32 of its key's)."""
    x = (key.astype(u64) & u64(0xFFFFFFFF)) * u64(0x9E3779B97F4A7C15) ^ (h >> u64(24) & u64(0xFFFFFFFF)) * u64(0xC2B2AE3D27D4EB4F)
    return (x ^ (x >> u64(31))) * u64(0xBF58476D1CE4E5B9)


class Buffer:
    """Texts end to end, and their sampled suffixes."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]]):
        """rows: document, its text's key, the position in the document that the bytes start at, the bytes."""
        self.doc, self.key, self.base = (np.array([r[i] for r in rows], np.int64) for i in range(3))
        self.text = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        size = np.fromiter((len(r[3]) for r in rows), np.int64, len(rows))
        self.end = np.cumsum(size)
        self.start = self.end - size
        self.first, self.last, self.anchor, self.h = sample(self.text, self.start, self.end)
        self.own = np.searchsorted(self.end, self.first, "right")


def buffers(rows, size: int):
    """Buffers of about `size` bytes; the parts of a very long text share LENGTH - 1 bytes."""
    held, out = 0, []
    for doc, key, text in rows:
        for at in range(0, max(1, len(text) - LENGTH + 1), size):
            out.append((doc, key, at, text[at : at + size + LENGTH - 1]))
            held += len(out[-1][3])
            if held >= size:
                yield Buffer(out)
                held, out = 0, []
    if out:
        yield Buffer(out)


def deal(to: np.ndarray, kind: int, columns: list[np.ndarray], level: int = LEVEL) -> list[tuple[int, int, bytes]]:
    """(number, kind, blob of the columns' rows) for each number in `to`."""
    if not len(to):
        return []
    order = by_number(to)
    to, columns = to[order], [c[order] for c in columns]
    cuts = np.flatnonzero(begins(to)).tolist()
    return [(n, kind, pack([c[a:b] for c in columns], level)) for n, a, b in zip(to[cuts].tolist(), cuts, [*cuts[1:], len(to)], strict=True)]


class Told:
    """Hashes that a task has sent on before, the latest TOLD or so: what many of its buffers share is sent once."""

    def __init__(self) -> None:
        self.known = np.zeros(0, u64)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.known, h)
        return self.known[np.minimum(at, len(self.known) - 1)] == h if len(self.known) else np.zeros(len(h), bool)

    def add(self, h: np.ndarray) -> None:
        self.known = distinct(np.concatenate([self.known, h]) if len(self.known) < TOLD else h)


class Gathered(NamedTuple):
    """The anchors of several buffers, as of one: dealt together they are fewer blobs."""

    h: np.ndarray
    key: np.ndarray
    own: slice = slice(None)


def survey(b: Buffer, shards: int, told: Told) -> list[tuple[int, int, bytes]]:
    """Of kind 1, for shards: each distinct anchor once, with its document's key or as one of several; of kind 0, for parts: marks of the latter.

    An anchor that several documents of the task's buffers had isn't sent again: whoever has it is marked at once.
    """
    h, key = b.h, b.key[b.own]
    if not len(h):
        return []
    order = np.argsort(h)
    h, key = h[order], key[order]
    at = np.flatnonzero(begins(h))
    heads, least = h[at], np.minimum.reduceat(key, at)
    several = least != np.maximum.reduceat(key, at)
    known = told.has(heads)
    marked = np.repeat(several | known, np.diff(np.append(at, len(h))))
    word, key = marks(key[marked], h[marked]), key[marked]
    order = np.argsort(word)
    order = order[begins(word[order])]
    out = deal((key[order] & 0xFFFFFFFF) % shards, 0, [word[order]], QUICK)
    told.add(heads[several & ~known])
    h, key, several = heads[~known], np.where(several, 0, least)[~known].astype("<u4"), several[~known]
    order = np.argsort(key)
    h, key, several = h[order], key[order], several[order]
    to = (h & PLACE).astype(np.int64) % shards
    order = by_number(to)
    h, key, several, to = h[order], key[order], several[order], to[order]
    step = np.diff(key, prepend=key[:1])  # steps from key to key shrink, keys don't
    step[begins(to)] = key[begins(to)]
    return out + deal(to, 1, [(h >> u64(24)).astype("<u4"), step, several.astype("u1")], QUICK)


def surveys(found: Iterator[Buffer], shards: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """survey() of a task's buffers, of HELD anchors at a time: blobs go with tasks times shards, not with buffers times shards."""
    told, held, n = Told(), [], 0
    for b in found:
        held.append((b.h, b.key[b.own]))
        n += len(b.h)
        if n >= HELD:
            yield survey(Gathered(*map(np.concatenate, zip(*held, strict=True))), shards, told)
            held, n = [], 0
    if held:
        yield survey(Gathered(*map(np.concatenate, zip(*held, strict=True))), shards, told)


def meet(blobs: list[bytes], shards: int) -> list[tuple[int, int, bytes]]:
    """Marks, for parts, of the anchors of one shard that more than one buffer has."""
    h, step, several = zip(*(unpack(x, ["<u4", "<u4", "u1"]) for x in blobs), strict=True)
    key = np.concatenate([np.cumsum(x, dtype="<u4") for x in step]).astype(np.int64)
    h, several = np.concatenate(h).astype(u64) << u64(24), np.concatenate(several)
    order = np.argsort(h)
    h, key, several = h[order], key[order], several[order].astype(bool)
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[1:] == h[:-1]
    hit = (same[1:] | same[:-1]) & ~several
    return deal(key[hit] % shards, 0, [marks(key[hit], h[hit])], QUICK)


def like(t: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the `size` bytes at a and at b are the same."""
    if not len(a):
        return np.zeros(0, bool)
    equal = t[slices(a, size)] == t[slices(b, size)]
    return np.logical_and.reduceat(equal, np.cumsum(size) - size)


def contexts(b: Buffer, shared: np.ndarray, shards: int, indexes: int, bounds: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(number, kind, blob): of kind 1 + batch, for shards of the index, the contexts of the sampled suffixes whose marks are shared (sorted); of kind 0, for parts, spans that are known to repeat.

    A context is all strings of LENGTH bytes that have one anchor. Equal contexts (found by a hash, then compared) are
    one, with the smallest document's places; in later documents all of the context repeats.
    """
    word = marks(b.key[b.own], b.h)
    at = np.searchsorted(shared, word)
    hit = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == word) if len(shared) else np.zeros(0, np.int64)
    if not len(hit):
        return []
    t, doc, key, base, start = b.text, b.doc, b.key, b.base, b.start
    first, last, anchor, h, own = b.first[hit], b.last[hit], b.anchor[hit], b.h[hit], b.own[hit]
    stop = last + LENGTH
    same = digests(t, first, stop) ^ (anchor - first).astype(u64) * u64(0xD6E8FEB86659FD93)
    while True:
        order = np.argsort(same)
        new = begins(same[order])
        group = np.cumsum(new) - 1
        heads = order[new][group]
        size = stop[order] - first[order]
        alike = (size == stop[heads] - first[heads]) & (anchor[order] - first[order] == anchor[heads] - first[heads])
        ask = alike & ~new
        alike[ask] = like(t, first[order][ask], first[heads][ask], size[ask])
        if alike.all():
            break
        same[order[~alike]] += np.arange(1, len(order) + 1, dtype=u64)[~alike]  # of one hash but not equal: apart
    held = doc[own[order]]
    kept = held == np.minimum.reduceat(held, np.flatnonzero(new))[group]
    out = []
    gone = np.sort(order[~kept])
    if len(gone):
        o = own[gone]
        at = base[o] - start[o]
        out += deal((key[o] & 0xFFFFFFFF) % shards, 0, [doc[o], key[o], first[gone] + at, stop[gone] + at])
    chief = np.empty(int(group[-1]) + 1, np.int64)  # one of the smallest document's places
    chief[group[kept]] = order[kept]
    shard = (h & PLACE).astype(np.int64) % indexes
    batch = np.searchsorted(bounds, doc[own], "left")
    places, of = order[kept], chief[group[kept]]  # each place, and where its context stands
    to = shard[of] * (len(bounds) + 1) + batch[of]
    by = np.argsort(of << 32 | places)  # what lies side by side in the text compresses well
    by = by[by_number(to[by])]
    places, of, to = places[by], of[by], to[by]
    new = begins(of)
    edge = begins(to)
    cuts = np.flatnonzero(edge)
    which = np.cumsum(new) - 1
    ctx, which = of[new], which - np.repeat(which[cuts], np.diff(np.append(cuts, len(to))))
    lengths = stop[ctx] - first[ctx]
    text, o = t[slices(first[ctx], lengths)], own[places]
    docs, keys, spots = doc[o], key[o], first[places] - start[o] + base[o]
    low = np.append(np.flatnonzero(edge[new]), len(ctx)).tolist()  # a number's contexts, and their bytes
    bytes_ = np.concatenate([[0], np.cumsum(lengths)])[low].tolist()
    lengths, which, cuts = lengths.astype("u1"), which.astype("<u4"), [*cuts.tolist(), len(to)]
    for i, n in enumerate(to[cuts[:-1]].tolist()):
        a, b = cuts[i], cuts[i + 1]
        out.append((n // (len(bounds) + 1), 1 + n % (len(bounds) + 1), pack([lengths[low[i] : low[i + 1]], which[a:b], docs[a:b], keys[a:b], spots[a:b], text[bytes_[i] : bytes_[i + 1]]])))
    return out


class Strings:
    """The LENGTH bytes at places of a text, as big-endian numbers: they compare as the strings do."""

    def __init__(self, text: np.ndarray):
        self.text = text
        self.every = np.ndarray(len(text) + 1, ">u8", np.concatenate([text, np.zeros(8, np.uint8)]), strides=(1,))

    def word(self, at: np.ndarray, k: int) -> np.ndarray:
        """The k-th number of eight bytes of each; the last overlaps the one before it."""
        return self.every[at + min(8 * k, LENGTH - 8)].astype(u64)

    def equal(self, a: np.ndarray, b: np.ndarray, other: Strings | None = None) -> np.ndarray:
        """Which strings at a are those at b, here or in another text."""
        out, there = np.ones(len(a), bool), (other or self).every
        for k in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
            out &= self.every[a + k] == there[b + k]
        return out

    def unlike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which strings at a differ from those at b, with what runs on from them. Where both run on by one place, only the last byte is new."""
        begins = np.ones(len(a), bool)
        begins[1:] = (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
        same = self.text[a + LENGTH - 1] == self.text[b + LENGTH - 1]
        same[begins] &= self.equal(a[begins], b[begins])
        run = np.cumsum(begins) - 1
        broken = np.zeros(int(begins.sum()), bool)
        broken[run[~same]] = True
        return broken[run]

    def order(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, new): at[order] is sorted by the strings, equal ones by their place in `at`; new: which begin a run of equal strings.

        Sorted by the first eight bytes; then those that are still tied, by their tie and five bytes more at a time.
        """
        first = self.every[at].astype(u64)
        order = np.argsort(first)
        sorted_ = first[order]
        new = np.ones(len(order), bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        done = 8
        while done < LENGTH:
            edge = np.append(new, True)
            tied = np.flatnonzero(~(edge[:-1] & edge[1:]))
            if not len(tied):
                break
            tie = np.cumsum(new[tied]).astype(u64)  # of at most 1 << 24 ties
            size = min(5, LENGTH - done)
            key = tie << u64(40) | self.every[at[order[tied]] + done].astype(u64) >> u64(64 - 8 * size)
            by = np.argsort(key)
            order[tied] = order[tied[by]]
            key = key[by]
            new[tied[1:]] |= key[1:] != key[:-1]
            done += size
        edge = np.flatnonzero(new)
        many = np.repeat(edge, np.diff(np.append(edge, len(order))))
        tied = np.flatnonzero(~(np.append(new, True)[:-1] & np.append(new, True)[1:]))
        order[tied] = order[tied][np.lexsort((order[tied], many[tied]))]
        return order, new


class Level(NamedTuple):
    """A suffix array: places of distinct LENGTH-byte strings in a text of contexts, sorted by the strings, and the smallest document of each."""

    lengths: np.ndarray  # of the contexts
    docs: np.ndarray  # of the contexts
    text: np.ndarray
    order: np.ndarray  # the places

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.cumsum(self.lengths, dtype=np.int64), at, "right")

    def scan(self, other: Level) -> np.ndarray:
        """The smallest document here that has each string of another suffix array, NULL_ID where none has.

        Both are sorted, so the first eight bytes are met in one sweep; ties of them are halved by the next bytes until one place is
        left, whose string is compared.
        """
        mine, theirs, at = Strings(self.text), Strings(other.text), other.order
        first, asked = mine.word(self.order, 0), theirs.word(at, 0)
        low = np.flatnonzero(np.argsort(np.concatenate([asked, first]), kind="stable") < len(asked)) - np.arange(len(asked))  # two sorted runs are merged
        near = np.flatnonzero(first[np.minimum(low, len(first) - 1)] == asked) if len(first) else low[:0]
        low, at = low[near], at[near]
        new = begins(first)
        high = np.append(np.flatnonzero(new)[1:], len(first))[(np.cumsum(new) - 1)[low]]
        for k in range(1, -(-LENGTH // 8)):
            more = np.flatnonzero(high - low > 1)
            if not len(more):
                break
            key = theirs.word(at[more], k)
            for right in (False, True):
                a, b = low[more].copy(), high[more].copy()
                while len(live := np.flatnonzero(a < b)):
                    mid = (a[live] + b[live]) >> 1
                    here = mine.word(self.order[mid], k)
                    before = here <= key[live] if right else here < key[live]
                    a[live[before]] = mid[before] + 1
                    b[live[~before]] = mid[~before]
                if right:
                    high[more] = a
                else:
                    start = a
            low[more] = start
        found = np.flatnonzero(high > low)
        place = self.order[low[found]]
        same = mine.equal(place, at[found], theirs)
        out = np.full(len(other.order), NULL_ID)
        out[near[found[same]]] = self.docs[self.owner(place[same])]
        return out

    def merge(self, other: Level) -> Level:
        """Both as one; of a string that both have the place in the first stays."""
        text = np.concatenate([self.text, other.text])
        at = np.concatenate([self.order.astype(np.int64), other.order.astype(np.int64) + len(self.text)])
        order, new = Strings(text).order(at)
        return Level(np.concatenate([self.lengths, other.lengths]), np.concatenate([self.docs, other.docs]), text, at[order][new])

    def sorted(self, at: np.ndarray) -> tuple[Level, np.ndarray, np.ndarray]:
        """(the suffix array of the strings at the ascending places `at`, which of these its places are, where in it each one's string stands).

        Equal strings are found by a hash and compared, so that only distinct ones are sorted.
        """
        strings, h = Strings(self.text), Hashes(self.text).of(at, at + LENGTH)
        by = np.argsort(h)
        begins = np.flatnonzero(np.concatenate([np.ones(min(1, len(by)), bool), h[by][1:] != h[by][:-1]]))
        heads = np.minimum.reduceat(by, begins) if len(by) else by
        many = np.diff(np.append(begins, len(by)))
        member = np.empty(len(at), np.int64)
        member[by] = np.repeat(np.arange(len(heads)), many)
        odd = np.flatnonzero(strings.unlike(at, at[heads][member]))  # perhaps of one hash, but not equal: sorted on their own
        member[odd] = len(heads) + np.arange(len(odd))
        own = np.concatenate([heads, odd])
        order, new = strings.order(at[own])
        rank = np.empty(len(own), np.int64)
        rank[order] = np.cumsum(new) - 1
        least = np.full(int(new.sum()), len(at))
        np.minimum.at(least, rank, own) if len(odd) else least.__setitem__(rank, own)
        return self._replace(order=at[least]), least, rank[member]

    def compact(self, own: np.ndarray) -> Level:
        """Without the contexts that no place lies in; own: the contexts of the places."""
        begin = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        mark = np.zeros(len(self.lengths), bool)
        mark[own] = True
        used = np.flatnonzero(mark)
        moved = np.zeros(len(self.lengths), np.int64)
        moved[used] = np.cumsum(self.lengths[used], dtype=np.int64) - self.lengths[used]
        return Level(self.lengths[used], self.docs[used], self.text[slices(begin[used], self.lengths[used].astype(np.int64))], self.order - begin[own] + moved[own])

    def pack(self) -> bytes:
        return pack([self.lengths.astype("u1"), self.docs.astype("<i8"), self.text, self.order.astype("<u4")])

    @classmethod
    def unpack(cls, blob: bytes) -> Level:
        return cls(*unpack(blob, ["u1", "<i8", "u1", "<u4"]))


class Family:
    """A logarithmic family: the suffix array of a new batch is scanned against every level and becomes one; the newest levels merge while they stand for as many batches."""

    def __init__(self, levels: list[Level]):
        self.levels = levels  # oldest first

    def enter(self, batch: Level) -> tuple[np.ndarray, np.ndarray]:
        """(places, again) of the batch: whether the LENGTH bytes at each place stand in a document before its own, of the batch or of a level.

        Contexts come by ascending document, and no later than those of earlier batches.
        """
        sizes = batch.lengths.astype(np.int64)
        n = sizes - LENGTH + 1
        at = slices(np.cumsum(sizes) - sizes, n)
        own, first, rank = batch.sorted(at)
        context = np.repeat(np.arange(len(n)), n)
        least = batch.docs[context[first]]
        fresh = np.ones(len(least), bool)
        for level in self.levels:
            found = level.scan(own)
            fresh &= found == NULL_ID
            least = np.minimum(least, found)
        again = batch.docs[context] > least[rank]
        self.levels.append(own._replace(order=own.order[fresh]).compact(context[first[fresh]]))
        return at, again

    def merge(self, levels: int) -> Level:
        """The newest level, with that many before it."""
        for _ in range(levels):
            newer, older = self.levels.pop(), self.levels.pop()
            self.levels.append(older.merge(newer))
        return self.levels[-1]


def chiefs(text: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first context that has each one's bytes: found by a hash, then compared."""
    begin = np.cumsum(lengths) - lengths
    h = digests(text, begin, begin + lengths)
    by = np.argsort(h)
    new = begins(h[by])
    first = (np.minimum.reduceat(by, np.flatnonzero(new)) if len(by) else by)[np.cumsum(new) - 1]
    ask = np.flatnonzero((by != first) & (lengths[by] == lengths[first]))
    ask = ask[like(text, begin[by[ask]], begin[first[ask]], lengths[by[ask]])]
    out = np.arange(len(lengths))
    out[by[ask]] = first[ask]
    return out


NOTHING = Level(np.zeros(0, "u1"), np.zeros(0, "<i8"), np.zeros(0, "u1"), np.zeros(0, np.int64))


def enter_shard(levels: list[bytes | None], blobs: list[bytes], parts: int, merged: int | None) -> tuple[list[tuple[int, int, bytes]], bytes | None]:
    """(repeated spans among one batch's contexts of one shard, by parts; the new level: the batch with `merged` levels before it, none if merged is null)."""
    family, out = Family([NOTHING if x is None else Level.unpack(x) for x in levels]), []
    if blobs:
        got = [unpack(x, CONTEXT) for x in blobs]
        lengths = np.concatenate([x[0] for x in got]).astype(np.int64)
        shift = np.cumsum([0, *(len(x[0]) for x in got[:-1])])
        which = np.concatenate([x[1].astype(np.int64) + s for x, s in zip(got, shift, strict=True)])
        doc, key, pos = (np.concatenate([x[i] for x in got]) for i in (2, 3, 4))
        text = np.concatenate([x[5] for x in got])
        del got
        docs = np.empty(len(lengths), np.int64)
        docs[which] = doc
        order = np.argsort(docs, kind="stable")
        begin = np.cumsum(lengths) - lengths
        text, lengths, docs = text[slices(begin[order], lengths[order])], lengths[order], docs[order]
        moved = np.empty(len(order), np.int64)
        moved[order] = np.arange(len(order))
        chief = chiefs(text, lengths)
        which = moved[which]
        later = docs[which] > docs[chief[which]]  # all of a context repeats that an earlier document has
        spans = [doc[later], key[later], pos[later], pos[later] + lengths[which[later]]]
        own = np.flatnonzero(chief == np.arange(len(chief)))
        rank = np.cumsum(chief == np.arange(len(chief))) - 1
        of = rank[chief[which[~later]]]
        by = np.argsort(of, kind="stable")
        doc, key, pos = doc[~later][by], key[~later][by], pos[~later][by]
        many = np.bincount(of, minlength=len(own))
        place = np.cumsum(many) - many
        begin = np.cumsum(lengths) - lengths
        text, lengths, docs = text[slices(begin[own], lengths[own])], lengths[own], docs[own]
        at, again = family.enter(Level(lengths.astype("u1"), docs, text, np.zeros(0, np.int64)))
        n = lengths - LENGTH + 1
        owner = np.repeat(np.arange(len(n)), n)
        edge = np.ones(len(owner) + 1, bool)
        edge[1:-1] = owner[1:] != owner[:-1]
        begins = np.flatnonzero(again & (edge[:-1] | ~np.concatenate([[False], again[:-1]])))
        ends = np.flatnonzero(again & (edge[1:] | ~np.concatenate([again[1:], [False]])))
        c = owner[begins]
        offset = np.cumsum(lengths) - lengths
        record = slices(place[c], many[c])
        a, b = (np.repeat(x, many[c]) for x in (at[begins] - offset[c], at[ends] - offset[c] + LENGTH))
        found = [np.concatenate(x) for x in zip(spans, [doc[record], key[record], pos[record] + a, pos[record] + b], strict=True)]
        if len(found[0]):
            out = deal((found[1] & 0xFFFFFFFF) % parts, 0, found)
    elif merged is not None:
        family.levels.append(NOTHING)
    return out, family.merge(merged).pack() if merged is not None else None


def union(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of the (start, end) rows."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), bool)
    new[1:] = spans[1:, 0] > end[:-1]
    return np.stack([spans[new, 0], end[np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]], axis=1)


def without_repeats(
    spark: SparkSession, docs: DataFrame, keep: list[str], kept: str = "bytes", batches: int = BATCHES, buffer: int = BUFFER, share: int = SHARE
) -> DataFrame:
    """The columns `keep` of docs (doc_id, text and any other columns), with n_bytes, n_removed, n_spans and kept.

    Removed is each byte covered by a LENGTH-byte string that also starts in a document with a smaller doc_id. kept is
    what remains: as binary (kept="bytes"), its sha256 in hex (kept="sha256"), or the whole characters of it (kept="text"). A null text is empty. Texts under LENGTH bytes
    lose nothing. A null doc_id counts as larger than any other; rows of equal doc_id don't remove from one another.
    Repeated rows come out alike. An empty table gives no row.

    Shards first learn which sampled suffixes begin alike in several documents (a word for each); only the surroundings
    of those can repeat, and go to the index. It takes them in `batches` of ascending doc_id. Each shard of the index
    sorts a batch's suffixes, scans them against its levels, whose bytes are compared, and sends the repeated spans to
    where the documents are dealt. Levels are tables in the shared folder: the new batch's, merged with those that stand
    for as many batches. Shards get about `share` bytes of text each, so their number grows with the table.
    """
    store = Store(spark, "substrings")
    doc, raw = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    cuts = F.percentile_approx(doc, [(k + 1) / batches for k in range(batches - 1)] or [1.0], 1000)
    total, cuts = docs.agg(F.sum(F.octet_length("text").cast("long")), cuts).first()
    bounds = np.array(sorted(set(cuts or []))[: batches - 1], np.int64)
    shards = max(partitions(spark), -(-(total or 0) // share))
    indexes = max(1, shards // SPREAD)

    def emit(rows):
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["to", "kind", "blob"])

    def anchors(batches):
        pieces = (batch.slice(i, 500) for batch in batches for i in range(0, batch.num_rows, 500))
        for blobs in surveys(buffers((x for piece in pieces for x in zip(*(c.to_pylist() for c in piece.columns), strict=True)), buffer), shards):
            yield from emit(blobs)

    def meeting(batches):
        for g in groups(batches, ["to", "kind"]):
            if g.column("kind")[0].as_py() == 0:  # for a part already
                yield from g.combine_chunks().to_batches()
            else:
                yield from emit(meet(g.column("blob").to_pylist(), shards))

    def surroundings(batches):
        for blobs, texts in parts_of(batches):
            shared = distinct(np.concatenate([np.zeros(0, u64), *(unpack(x, ["<u8"])[0] for x in blobs)]))
            for b in buffers(((d, k, t) for piece in texts for d, k, t in zip(*(piece[c].to_pylist() for c in ("_d", "_k", "_t")), strict=True)), 2 * buffer):
                yield from emit(contexts(b, shared, shards, indexes, bounds))

    def entering(standing, merged):
        def run(batches):
            for g in groups(batches, ["to"]):
                kind, blob = column(g, "kind").tolist(), g.column("blob").to_pylist()
                levels = {k: x for k, x in zip(kind, blob, strict=True) if k < 0}
                own = [x for k, x in zip(kind, blob, strict=True) if k > 0]
                found, level = enter_shard([levels.get(k) for k in range(-standing, 0)], own, shards, merged)
                yield from emit(found)
                if level:
                    yield from emit([(g.column("to")[0].as_py(), 1, level)])

        return run

    schema, order = "to int, kind int, blob binary", ("to", "kind")
    key = F.xxhash64(doc, raw)
    source = docs.select(doc.alias("_d"), key.alias("_k"), raw.alias("_t"))

    def dealt(blobs: DataFrame, rows: DataFrame) -> DataFrame:
        """Blobs and rows (with _k) of one part together, blobs first."""
        rows = rows.withColumns({"to": (F.col("_k").bitwiseAND(F.lit(0xFFFFFFFF)) % shards).cast("int"), "kind": F.lit(1)})
        both = blobs.unionByName(rows, allowMissingColumns=True).repartition(shards, "to").sortWithinPartitions(*order)
        return both.select("to", "kind", "blob", *rows.drop("to", "kind").columns)

    long = source.where(F.octet_length("_t") >= LENGTH)
    met = store.keep(long.mapInArrow(lean(anchors), schema).repartition(shards, "to").sortWithinPartitions(*order).mapInArrow(lean(meeting), schema))
    store.release()
    near = store.keep(dealt(met, long).mapInArrow(lean(surroundings), schema), "kind")
    store.drop(met)
    store.release()
    spans, live = near.where("kind = 0"), []  # live: (batches that a level stands for, its table), oldest first
    for b in range(len(bounds) + 1):
        merged, size = 0, 1
        while merged < len(live) and live[-1 - merged][0] == size:
            merged, size = merged + 1, 2 * size
        last = b == len(bounds)  # nothing comes after it
        rows = near.where(F.col("kind") == b + 1)
        for k, (_, level) in enumerate(live):
            rows = rows.unionByName(level.where("kind = 1").withColumn("kind", F.lit(k - len(live))))
        entered = rows.select("to", "kind", "blob").repartition(indexes, "to").sortWithinPartitions(*order)
        out = store.keep(entered.mapInArrow(lean(entering(len(live), None if last else merged)), schema), "kind")
        spans = spans.unionByName(out.where("kind = 0"))
        for _, level in live[len(live) - merged :] if not last else live:
            store.drop(level, "kind=1")
        store.drop(near, f"kind={b + 1}")
        live[len(live) - merged :] = [(size, out)]
        del rows, entered
        store.release()

    names = [f"_c{i}" for i in range(len(keep))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], doc.alias("_d"), key.alias("_k"), raw.alias("_t"))
    fields = [docs.schema[c] for c in keep]
    result = pa.string() if kept in ("sha256", "text") else pa.binary()

    def cut(batches):
        for blobs, texts in parts_of(batches):
            index = by_document(blobs)
            for piece in texts:
                own = [remove(t, index.get((d, k)), kept) for d, k, t in zip(*(piece[c].to_pylist() for c in ("_d", "_k", "_t")), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(piece[c] for c in names), *(pa.array([x[j] for x in own], pa.int64()) for j in range(3)), pa.array([x[3] for x in own], result)],
                    names=[*names, "_n0", "_n1", "_n2", "_kept"],
                )

    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, fields, strict=True))
    out = dealt(spans.select("to", "kind", "blob"), rows).mapInArrow(lean(cut), f"{schema}, _n0 long, _n1 long, _n2 long, _kept {'binary' if result == pa.binary() else 'string'}")
    return out.toDF(*keep, "n_bytes", "n_removed", "n_spans", "kept")


class Stretches:
    """Sorted batches as (to, kind, rows) stretches, with a look at the next one."""

    def __init__(self, batches):
        self.source = self.cut(batches)
        self.next = next(self.source, None)

    @staticmethod
    def cut(batches):
        for batch in batches:
            to, kind = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("to", "kind"))
            edges = np.flatnonzero((np.diff(to) != 0) | (np.diff(kind) != 0)) + 1
            bounds = [0, *edges.tolist(), batch.num_rows] if batch.num_rows else []
            for a, b in zip(bounds, bounds[1:], strict=False):
                yield int(to[a]), int(kind[a]), batch.slice(a, b - a)

    def of(self, to: int, kind: int):
        """The stretches that come next, as long as they are these."""
        while self.next is not None and self.next[:2] == (to, kind):
            rows = self.next[2]
            self.next = next(self.source, None)
            yield rows


def parts_of(batches):
    """(blobs, rows) for each part in sorted batches: the blobs that stand first in it, then its rows in pieces, to be read before the next part."""
    ahead = Stretches(batches)
    while ahead.next is not None:
        part = ahead.next[0]
        blobs = [x for rows in ahead.of(part, 0) for x in rows.column(rows.schema.get_field_index("blob")).to_pylist()]
        yield blobs, (dict(zip(rows.schema.names, rows.slice(i, 500).columns, strict=True)) for rows in ahead.of(part, 1) for i in range(0, rows.num_rows, 500))


def by_document(blobs: list[bytes]) -> dict[tuple[int, int], np.ndarray]:
    """Each document's spans as rows of (start, end)."""
    if not blobs:
        return {}
    doc, key, a, b = (np.concatenate(x) for x in zip(*(unpack(x, SPANS) for x in blobs), strict=True))
    order = np.lexsort((doc, key))
    doc, key, spans = doc[order], key[order], np.stack([a[order], b[order]], axis=1)
    cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(key) != 0)) + 1
    return {(int(doc[i]), int(key[i])): x for i, x in zip([0, *cuts.tolist()], np.split(spans, cuts), strict=True)}


def remove(text: bytes, spans: np.ndarray | None, kept: str) -> tuple[int, int, int, object]:
    left, removed, n = text, 0, 0
    if spans is not None:
        runs, parts, at = union(spans), [], 0
        for a, b in runs.tolist():
            parts.append(text[at:a])
            removed += b - a
            at = b
        left, n = b"".join([*parts, text[at:]]), len(runs)
    out = hashlib.sha256(left).hexdigest() if kept == "sha256" else left.decode("utf-8", "ignore") if kept == "text" else left
    return len(text), removed, n, out


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document; see without_repeats()."""
    out = without_repeats(spark, table(spark, sf_dir, "documents"), ["doc_id"], "sha256")
    return out.withColumnRenamed("kept", "kept_sha256")
