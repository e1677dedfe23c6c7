"""Token ids of text batches with the ``tokenizers`` library.

Two families of byte-pair vocabularies split a text into pre-tokens first and then merge inside
each of them, so a text's ids are the ids of its pre-tokens in turn. Pre-tokens of whole
batches are found by classes of characters and named by 64-bit hashes with NumPy; the library encodes
each different one once per worker, and the ids of the batch are gathered. Which family a vocabulary
belongs to is read from its file. Texts of other vocabularies, texts with characters whose class might depend on a
Unicode version, and texts with a special token's name or a very long pre-token go to the library as they are.

Memory is bounded: at most ``most_words`` pre-tokens of ``MOST_CHARS`` characters are remembered, about 70 MB
in all. When they are full those met only once are forgotten. Among so many 64-bit hashes two collide with a
chance of 1 in 10 million.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .words import mix

#: Characters that the classes below hold as the library does.
PLAIN = re.compile("[\t\n\r -~¡§«»¿À-ÿŒœ‘’“”„…–—€]*")
MOST_CHARS = 256
PART = 1 << 18

SPACE, LETTER, DIGIT, OTHER = 1, 2, 3, 4

#: How the two families split, as their files state it, and as a pattern for plain characters.
BYTE_SPLIT = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
WORD_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
WORD_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERNS = {
    "byte": re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"),
    "word": re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"),
}
_CUT = re.compile(r"[A-Za-z](?=[ \n])")
SHORT, LONG = "stmd", ("re", "ve", "ll")


def _class(c: str) -> int:
    if PLAIN.fullmatch(c) is None:
        return 0
    return SPACE if c.isspace() else LETTER if c.isalpha() else DIGIT if c.isdigit() else OTHER


CLASS = np.array([_class(chr(i)) for i in range(0x20AD)], np.uint8)
_RNG = np.random.default_rng(20240307)
_LETTER = _RNG.integers(0, 2**64, len(CLASS), dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

_ENCODERS: dict[str, Encoder] = {}


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the hash step and of its inverse, ``n`` at least."""
    if len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for k, base in enumerate((_STEP, _BACK)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[k] = np.multiply.accumulate(row)
    return _POWERS


@functools.cache
def _byte_names() -> dict[int, str]:
    """The character that stands for each byte inside byte-level vocabularies: printable ones themselves, the others from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {b: chr(b if b in shown else next(hidden)) for b in range(256)}


def family(description: dict) -> str | None:
    """``byte`` or ``word`` where a vocabulary file splits as those do, else null."""
    has = lambda found, wanted: isinstance(found, dict) and all(found.get(k) == v for k, v in wanted.items())
    model, split, normal = description["model"], description["pre_tokenizer"] or {}, description["normalizer"]
    if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or not all(t["content"].startswith("<|") for t in description["added_tokens"]):
        return None
    if has(split, BYTE_SPLIT) and normal is None:
        return "byte"
    parts = split.get("pretokenizers", [])
    if len(parts) == 2 and has(parts[0], WORD_SPLIT) and has(parts[1], BYTE_SPLIT | {"use_regex": False}) and (normal or {}).get("normalizers") == WORD_NORMAL:
        return "word"
    return None


class Memory:
    """Places of 64-bit hashes: open addressing over arrays, for whole arrays of keys at once."""

    def __init__(self, capacity: int):
        size = 1 << max(10, (2 * capacity - 1).bit_length())
        self.keys, self.values, self.mask = np.zeros(size, np.uint64), np.zeros(size, np.int32), np.uint64(size - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 where there is none."""
        out = np.full(len(keys), -1, np.int64)
        todo, at = np.arange(len(keys)), keys & self.mask
        while len(todo):
            held = self.keys[at]
            same = held == keys[todo]
            out[todo[same]] = self.values[at[same]]
            on = ~same & (held != 0)
            todo, at = todo[on], (at[on] + np.uint64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray, first: int) -> None:
        """Give different, new keys the places from ``first`` on."""
        todo, at = np.arange(len(keys)), keys & self.mask
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[todo[free]]
            won = self.keys[at] == keys[todo]
            self.values[at[won]] = first + todo[won]
            todo, at = todo[~won], (at[~won] + np.uint64(1)) & self.mask


class Encoder:
    """Encodes batches of texts; at most ``most_words`` pre-tokens are remembered between batches."""

    def __init__(self, path: str, most_words: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.family = family(json.loads(self.library.to_str()))
        self.most_words = most_words
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self._names = str.maketrans(_byte_names())
        self.count_one = functools.lru_cache(100_000)(lambda piece: len(self.library.encode(piece, add_special_tokens=False).ids))
        self._forget(np.zeros(0, np.int64))

    def _forget(self, keep: np.ndarray) -> None:
        """Remember only the pre-tokens at the places ``keep``."""
        hashes, lengths, flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, self.kind)
        if len(keep):
            hashes, lengths = self.hashes[keep], self.length[keep].astype(np.int64)
            ends = np.cumsum(lengths)
            flat = self.flat[np.repeat(self.start[keep] - (ends - lengths), lengths) + np.arange(int(ends[-1]))]
        self.memory, self.n, self.used = Memory(self.most_words), 0, 0
        self.flat, self.start, self.length = np.zeros(1 << 16, self.kind), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)
        self.hashes, self.again = np.zeros(1 << 14, np.uint64), np.zeros(1 << 14, bool)
        self._store(hashes, lengths, flat)

    def _store(self, hashes: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> None:
        n, used = self.n + len(hashes), self.used + len(flat)
        while used > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while n > len(self.start):
            self.start, self.length, self.hashes, self.again = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.length, self.hashes, self.again))
        self.flat[self.used : used] = flat
        self.start[self.n : n] = self.used + np.cumsum(lengths) - lengths
        self.length[self.n : n], self.hashes[self.n : n], self.again[self.n : n] = lengths, hashes, False
        self.memory.add(hashes, self.n)
        self.n, self.used = n, used

    def _make_room(self, new: int) -> None:
        keep = np.flatnonzero(self.again[: self.n])
        self._forget(keep if len(keep) + new <= self.most_words * 3 // 4 else np.zeros(0, np.int64))

    def plain(self, text: str) -> bool:
        return self.family is not None and "<|" not in text and PLAIN.fullmatch(text) is not None

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a plain text."""
        return PATTERNS[self.family].findall(text.lower() if self.family == "word" else text)

    def count(self, pieces: list[str]) -> np.ndarray:
        """How many tokens each of a few pre-tokens makes."""
        return np.fromiter(map(self.count_one, pieces), np.int64, len(pieces))

    def _bounds(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(begin, end)`` of the pre-tokens of plain texts that begin at ``starts`` of the characters ``codes``."""
        n, kind = len(codes), CLASS[codes]
        begins = np.empty(n, bool)
        begins[0] = True
        np.not_equal(kind[1:], kind[:-1], out=begins[1:])
        first = np.zeros(n + 1, bool)
        first[starts] = True
        begins |= first[:n]
        if self.family == "word":
            begins |= kind == DIGIT
        else:
            # The last white-space character before a word stands alone, or with the word if it is a space.
            at = np.flatnonzero(begins & (kind != SPACE) & ~first[:n])
            at = at[kind[at - 1] == SPACE]
            begins[at - 1] = True
            begins[at[codes[at - 1] == 32]] = False
        q = np.flatnonzero((codes == 39) & begins)
        if len(q):
            # An apostrophe before one of the short endings goes with it, up to the end of its text.
            stop = np.append(starts, n)[np.searchsorted(starts, q, "right")]
            q, stop = q[q + 1 < stop], stop[q + 1 < stop]
            one, two = codes[q + 1], np.where(q + 2 < stop, codes[np.minimum(q + 2, n - 1)], 0)
            size = np.where(np.isin(one, [ord(c) for c in SHORT]), 2, 0)
            for a, b in LONG:
                size[(one == ord(a)) & (two == ord(b))] = 3
            q, size = q[size > 0], size[size > 0]
            begins[q + 1] = False
            after = q + size
            begins[after[after < n]] = True
        begin = np.flatnonzero(begins)
        end = np.append(begin[1:], n)
        if self.family == "word":
            word = kind[begin] != SPACE
            begin, end = begin[word], end[word]
        return begin, end

    def _places(self, joined: str, codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place in memory of each pre-token; those not met before are encoded."""
        power, inverse = _powers(len(codes) + 1)
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(_LETTER[codes] * power[: len(codes)], out=total[1:])
        hashes = mix((total[end] - total[begin]) * inverse[begin])
        hashes[hashes == 0] = 1
        while True:
            at = self.memory.find(hashes)
            fresh = np.flatnonzero(at < 0)
            names, first, back, times = np.unique(hashes[fresh], return_index=True, return_inverse=True, return_counts=True)
            if self.n + len(names) <= self.most_words:
                break
            self._make_room(len(names))
        self.again[at[at >= 0]] = True
        tokenize, lengths, ids = self.library.model.tokenize, [], []
        for a, b in zip(begin[fresh[first]].tolist(), end[fresh[first]].tolist()):
            found = [t.id for t in tokenize(joined[a:b].encode().decode("latin-1").translate(self._names))]
            lengths.append(len(found))
            ids += found
        place = self.n
        self._store(names, np.array(lengths, np.int64), np.array(ids, self.kind))
        self.again[place : self.n] = times > 1
        at[fresh] = place + back
        return at

    def _batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Of plain texts the places of all pre-tokens, how many each text has, their characters, and which texts are left out for a very long one."""
        joined = "".join(texts)
        if self.family == "word":
            joined = joined.lower()
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        starts = np.cumsum([0, *map(len, texts)])
        begin, end = self._bounds(codes, starts[:-1])
        owner = np.searchsorted(starts, begin, "right") - 1
        long = np.unique(owner[end - begin > MOST_CHARS])
        if len(long):
            keep = ~np.isin(owner, long)
            begin, end, owner = begin[keep], end[keep], owner[keep]
        return self._places(joined, codes, begin, end), np.bincount(owner, minlength=len(texts)), end - begin, long.tolist()

    def _groups(self, texts: list[str]) -> Iterator[list[int]]:
        """Numbers of plain texts that go together; a group has at most half as many characters as pre-tokens are remembered."""
        most, group, size = min(2 * PART, self.most_words // 2), [], 0
        for i, text in enumerate(texts):
            if not 0 < len(text) <= most or not self.plain(text):
                continue
            if size + len(text) > most:
                yield group
                group, size = [], 0
            group.append(i)
            size += len(text)
        if group:
            yield group

    def leaves(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the characters and the tokens of its pre-tokens, which together are the text (family ``byte``)."""
        out: list = [None] * len(texts)
        for rows in self._groups(texts):
            at, sizes, chars, long = self._batch([texts[i] for i in rows])
            tokens, cuts = self.length[at].astype(np.int64), np.concatenate(([0], np.cumsum(sizes)))
            for k, i in enumerate(rows):
                if k not in long:
                    out[i] = chars[cuts[k] : cuts[k + 1]], tokens[cuts[k] : cuts[k + 1]]
        for i, text in enumerate(texts):
            if out[i] is None:
                pieces = self.split(text)
                out[i] = np.fromiter(map(len, pieces), np.int64, len(pieces)), self.count(pieces)
        return out

    def split(self, text: str) -> list[str]:
        """The pre-tokens of any text; names of special tokens are ordinary text."""
        if self.plain(text):
            return self.pieces(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _encode_parts(self, parts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(parts)
        for rows in self._groups(parts):
            at, sizes, _, long = self._batch([parts[i] for i in rows])
            length = self.length[at].astype(np.int64)
            end = np.cumsum(length)
            ids = self.flat[np.repeat(self.start[at] - (end - length), length) + np.arange(int(end[-1]) if len(end) else 0)].astype(np.uint32)
            cuts = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(sizes)))]
            for k, i in enumerate(rows):
                if k not in long:
                    out[i] = ids[cuts[k] : cuts[k + 1]]
        return [np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32) if ids is None else ids for text, ids in zip(parts, out)]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        parts = [_parts(text) if text else [] for text in texts]
        found = iter(self._encode_parts([p for own in parts for p in own]))
        rows = [[next(found) for _ in own] for own in parts]
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.uint32) for x in rows]


def _parts(text: str) -> list[str]:
    """A long text in parts that end before a white space after a letter, where pre-tokens always end."""
    parts, at = [], 0
    while len(text) - at > PART and (m := _CUT.search(text, at + PART)):
        parts.append(text[at : m.end()])
        at = m.end()
    return [*parts, text[at:]]


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Place of a vocabulary file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def crc(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def with_end(ids: np.ndarray, end_id: int) -> np.ndarray:
    return np.append(ids, np.uint32(end_id))


def encoded(batches: Iterator[pa.RecordBatch], column: int, path: str) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Each batch with the ids of its texts."""
    tokens = encoder(path)
    for batch in batches:
        yield batch, tokens.encode(batch.column(column).to_pylist())
