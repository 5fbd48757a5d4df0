"""Ids of whole texts by the tokenizers library, with what it returned for recent words kept."""

from __future__ import annotations

import gc
import json
import os
import string
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the executor's cores are Spark's to deal out

TOGETHER = 100  # words to a text; the library takes half as long again for a word in very long ones
CHUNK = 4 << 20  # bytes of text, or one text, whose words are told apart at once
STRANGE = 0xD4  # bytes from here on begin letters from U+0500 on; before, what is a letter is the same in every Unicode that Arrow or the library knows
MARKS = string.punctuation  # in no letter, number or white space
SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}  # the library's name for public_tokenizers.PATTERN
VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    """Where the file of a public tokenizer lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def letters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints in Latin-1, else one from 256 on."""
    own = np.arange(256)
    other = (own < 33) | ((own > 126) & (own < 161)) | (own == 173)
    return np.where(other, 255 + np.cumsum(other), own).astype("<u4")


def chunks(sizes: list[int], room: int = CHUNK) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of texts that are about `room` together at most, or of one text."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > room:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def batched(batch: pa.RecordBatch, column: int, room: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch, and their texts (null: empty), that are about `room` bytes together, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for a, b in chunks(sizes, room):
        part = batch.slice(a, b - a)
        yield part, [x or "" for x in part.column(column).to_numpy(zero_copy_only=False).tolist()]


class Ids(NamedTuple):
    """Runs of ids, one after another."""

    flat: np.ndarray
    size: np.ndarray  # of each run

    @classmethod
    def of(cls, runs: list[bytes]) -> Ids:
        return cls(np.frombuffer(b"".join(runs), "<u4"), np.fromiter(map(len, runs), np.int64, len(runs)) >> 2)

    @classmethod
    def joined(cls, parts: list[Ids]) -> Ids:
        return cls(np.concatenate([x.flat for x in parts]), np.concatenate([x.size for x in parts]))

    def take(self, at: np.ndarray) -> Ids:
        size = self.size.take(at)
        return Ids(gathered(self.flat, (np.cumsum(self.size) - self.size).take(at), size), size)


def gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of values, each from its start on, one after another."""
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat((start - ends + size).astype(kind), size)
    at += np.arange(total, dtype=kind)
    return values.take(at)


def spread(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where each word begins in them, its bytes) of a large_string array without nulls."""
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset) if len(words) else np.zeros(1, np.int64)
    raw = words.buffers()[2]
    return np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8), ends[:-1], np.diff(ends)


def listed(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Where each word stands among others; -1 if it doesn't."""
    return pc.fill_null(pc.index_in(words, among), -1).to_numpy()


class Encoder:
    """encode(texts): each text's ids as little-endian unsigned 32-bit integers, those of the library for the whole text.

    The vocabulary's pattern never lets a piece reach across a space between two non-space characters, so a text's ids
    are those of its space-separated words, each with the space before it. A chunk's different words are looked up among
    those seen lately, the rest go to the library at once, many to a text. Texts where a space follows other white space
    go to it whole. Letters are one piece, and marks that end a word another: words of these need no pattern, and the
    library's model gets their letters alone. Words and ids stand in arrays, so that none becomes an object of its own
    but those that the library is asked for.
    """

    def __init__(self, path: str | None = None, remembered: int = 700_000, longest: int = 48):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path or vocabulary())
        self.model.encode_special_tokens = True
        self.size, self.longest = remembered, longest
        vocab = self.model.get_vocab()
        begins = np.zeros(self.model.get_vocab_size(), bool)
        for token, i in vocab.items():
            begins[i] = token.startswith("Ġ")  # how the vocabulary writes a space
        self.begins = begins
        self.split = self.model.pre_tokenizer
        known = self.split is not None and json.loads(self.split.__getstate__()) == SPLIT and self.model.normalizer is None
        self.bare = known and not any("Ġ" in t.lstrip("Ġ").replace("ÂłĠ", "") for t in vocab)  # no token of letters reaches across a space
        self.letters = letters()
        self.forget()

    def forget(self) -> None:
        self.names = pa.array([], pa.large_string())  # words seen lately
        self.ids = Ids.of([])  # theirs, after a space
        self.first: dict[str, bytes] = {}  # ids of texts' first words, which have no space before them

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def cut(self, n: int, texts: list[bytes]) -> Ids:
        """Each of n words' ids, of texts' ids where every word begins with a space and has no other."""
        flat = np.frombuffer(b"".join(texts), "<u4")
        cuts = np.flatnonzero(self.begins[flat])
        if len(cuts) != n:
            raise ValueError(f"{len(cuts)} words came back of {n}")
        return Ids(flat, np.diff(cuts, append=len(flat)))

    def plain(self, words: list[str]) -> Ids:
        """Ids of words of letters alone, none STRANGE, each after a space."""
        if not words:
            return Ids.of([])
        lines = "\n".join(" " + " ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER))
        lines = self.letters[np.frombuffer(lines.encode(), np.uint8)].tobytes().decode("utf-32-le").split("Ċ")
        self.model.pre_tokenizer = None
        try:
            return self.cut(len(words), self.whole(lines))
        finally:
            self.model.pre_tokenizer = self.split

    def words(self, words: pa.Array) -> tuple[pa.Array, Ids, np.ndarray]:
        """(words, their ids after a space, where each of the given stands): the given, different ones without spaces, and those that only marks were added to."""
        names, parts, at, held = [words.slice(0, 0)], [Ids.of([])], np.arange(len(words)), 0
        bare = np.zeros(len(words), bool)
        if self.bare and len(words):
            bodies = pc.ascii_rtrim(words, MARKS)
            raw, start, size = spread(bodies)
            bare = pc.utf8_is_alpha(bodies).to_numpy(zero_copy_only=False)
            strange = np.concatenate([[0], np.cumsum(raw >= STRANGE)])
            bare &= strange[start] == strange[start + size]
            stems = bodies.filter(pa.array(bare)).dictionary_encode()
            code, stems = stems.indices.to_numpy(), stems.dictionary
            old = places(stems, self.names).astype(np.int64)
            new = old < 0
            fresh = stems.filter(pa.array(new))
            old[new] = len(self.names) + np.arange(len(fresh))
            plain = self.plain(listed(fresh))
            raw, start, whole = spread(words)
            marked = np.flatnonzero(bare & (whole > size))
            tails = (whole - size)[marked]
            ends = pa.py_buffer(np.concatenate([[0], np.cumsum(tails)]).astype(np.int64))
            marks = pa.LargeStringArray.from_buffers(len(marked), ends, pa.py_buffer(gathered(raw, (start + size)[marked], tails))).dictionary_encode()
            pool = Ids.joined([self.ids, plain, Ids.of(self.whole(listed(marks.dictionary)))])
            at[bare] = old[code] - len(self.names)
            both = pool.take(np.stack([len(self.names) + at[marked], len(self.names) + len(fresh) + marks.indices.to_numpy()], 1).ravel())
            at[marked] = len(fresh) + np.arange(len(marked))
            names += [fresh, words.take(pa.array(marked))]
            parts += [plain, Ids(both.flat, both.size.reshape(-1, 2).sum(1))]
            held = len(fresh) + len(marked)
        rest = np.flatnonzero(~bare)
        if len(rest):
            names.append(words.take(pa.array(rest)))
            own = listed(names[-1])
            parts.append(self.cut(len(own), self.whole([" " + " ".join(own[i : i + TOGETHER]) for i in range(0, len(own), TOGETHER)])))
            at[rest] = held + np.arange(len(rest))
        return pa.concat_arrays(names), Ids.joined(parts), at

    def encode(self, texts: list[str], room: int = CHUNK) -> list[bytes]:
        collecting = gc.isenabled()
        gc.disable()  # the lists of words hold no cycles, and looking for them takes a seventh of the time
        try:
            return [x for a, b in chunks([*map(len, texts)], room) for x in self._encode(texts[a:b])]
        finally:
            if collecting:
                gc.enable()

    def known(self, names: pa.Array) -> tuple[Ids, np.ndarray]:
        """Ids of words, and where each of different words stands among them, after a space; -1 for those that only the whole text tells."""
        at = places(names, self.names).astype(np.int64)
        if len(self.names) > self.size:  # only what this chunk has is kept
            kept = np.flatnonzero(at >= 0)
            self.names, self.ids = self.names.take(pa.array(at[kept])), self.ids.take(at[kept])
            at[kept] = np.arange(len(kept))
        raw, start, size = spread(names)
        new = np.flatnonzero((at < 0) & (size > 0))
        last = raw[(start + size - 1)[new]]
        clear = (last > 32) & (last < 127)  # the others may be white space
        odd = np.flatnonzero(~clear)
        clear[odd] = [not w[-1].isspace() for w in listed(names.take(pa.array(new[odd])))]
        new = new[clear]
        made, ids, where = self.words(names.take(pa.array(new)))
        at[new] = len(self.names) + where
        found = Ids.joined([self.ids, ids])
        short = np.flatnonzero(pc.utf8_length(made).to_numpy(zero_copy_only=False) <= self.longest)
        if len(short) < len(made):
            made, ids = made.take(pa.array(short)), ids.take(short)
        self.names, self.ids = pa.concat_arrays([self.names, made]), Ids.joined([self.ids, ids])
        return found, at

    def firsts(self, names: list[str]) -> list[bytes]:
        """Ids of texts' first words."""
        unseen = [w for w in dict.fromkeys(names) if w not in self.first]
        if len(self.first) + len(unseen) > self.size // 8:
            self.first, unseen = {}, list(dict.fromkeys(names))
        fresh = dict(zip(unseen, self.whole(unseen), strict=True))
        self.first.update((w, x) for w, x in fresh.items() if len(w) <= self.longest)
        return [fresh[w] if w in fresh else self.first[w] for w in names]

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        begin, end = split.offsets.to_numpy()[:-1], split.offsets.to_numpy()[1:]
        words = split.values.dictionary_encode()
        ids, at = self.known(words.dictionary)
        own = Ids.of(self.firsts(listed(split.values.take(pa.array(begin)))))  # each text's
        code = at.take(words.indices.to_numpy())
        code[begin] = len(ids.size) + np.arange(len(texts))
        whole = np.flatnonzero(np.minimum.reduceat(code, begin) < 0).tolist()
        np.maximum(code, 0, out=code)
        ids = Ids.joined([ids, own]).take(code)
        ends = np.cumsum(ids.size)
        raw, cuts = ids.flat.tobytes(), (4 * ends[end - 1]).tolist()
        out = [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
        for i, x in zip(whole, self.whole([texts[i] for i in whole]), strict=True):
            out[i] = x
        return out


encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    """One for each Python worker."""
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def settle() -> None:
    """A task's words go with it: the next one's are others, and its memory is."""
    for each in encoders.values():
        each.forget()
