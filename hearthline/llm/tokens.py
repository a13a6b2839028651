"""Token ids of whole texts from a public tokenizer file, one call a distinct word.

The tokenizer drops white space before it cuts words, so the ids of a text are the ids of its
blank-separated words in turn (a test compares both). Each worker keeps the ids of the words
it met in sorted hash arrays; texts become ids by lookup, and the bytes of words with equal
hashes are compared, the first sixteen as two numbers. New words gather in a small array; when the large one has over ``_KEPT``
words, those that were not met again are let go. Words of plain letters skip the general
normaliser: for them it only lower-cases; those of ASCII and Latin-1 letters are lower-cased and spelt in the model's
letters all at once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

from . import bytewords as bw

_KEPT = 600_000
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ňŊ-ž]+)([.,;:!?]*)")


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


_BYTE_LETTERS = _byte_letters()
_BYTE_POINTS = np.array([ord(_BYTE_LETTERS[b]) for b in range(256)], "<u4")
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_HEAD = 16  # bytes of a word that are compared as numbers
U = np.uint64


def _heads(buffer: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the next eight bytes of each word as numbers, with zeros behind its end."""
    padded = np.concatenate([buffer, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(buffer) + 9, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    return eight[starts] & _MASKS[np.minimum(sizes, 8)], eight[starts + 8] & _MASKS[np.clip(sizes - 8, 0, 8)]


def _hashes(words: bw.Words, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    sizes = words.ends - words.starts
    out = bw.mix(bw.mix(one) + two * U(0x9E3779B97F4A7C15) + sizes.astype(np.uint64) * U(0xC2B2AE3D27D4EB4F))
    long = np.flatnonzero(sizes > _HEAD)
    out[long] ^= bw.hash_bytes(words.buffer, words.starts[long], words.ends[long])
    return out


def _rest_differs(a: np.ndarray, starts_a: np.ndarray, b: np.ndarray, starts_b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Numbers of the pairs of equally long words whose bytes behind the head differ."""
    long = np.flatnonzero(sizes > _HEAD)
    left = sizes[long] - _HEAD
    differ = _gather(a, starts_a[long] + _HEAD, left) != _gather(b, starts_b[long] + _HEAD, left)
    return long[np.unique(np.searchsorted(np.cumsum(left), np.flatnonzero(differ), "right"))]


@dataclass
class _Known:
    """Words by sorted hash: where their ids lie in the pool and their bytes in ``raw``; the heads of these as numbers."""

    keys: np.ndarray
    at: np.ndarray
    size: np.ndarray
    pool: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    raw: np.ndarray
    met: np.ndarray
    one: np.ndarray
    two: np.ndarray

    @classmethod
    def none(cls) -> _Known:
        return cls.of(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8), lambda *_: ([], []))

    @classmethod
    def of(cls, keys, starts, ends, buffer, encode) -> _Known:
        long = ends - starts
        raw, ends = _gather(buffer, starts, long), np.cumsum(long)
        ids, sizes = encode(raw, ends - long, ends)
        size, pool = np.array(sizes, np.int64), np.array(ids, np.uint32)
        return cls(keys, np.cumsum(size) - size, size, pool, ends - long, ends, raw, np.zeros(len(size), bool), *_heads(raw, ends - long, long))

    def find(self, keys: np.ndarray, words: bw.Words, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each word, and whether it is there, with the same bytes."""
        slot = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        if not len(self.keys):
            return slot, np.zeros(len(keys), bool)
        found = (self.keys[slot] == keys) & (self.ends[slot] - self.starts[slot] == words.ends - words.starts) & (self.one[slot] == one) & (self.two[slot] == two)
        rows = np.flatnonzero(found)
        found[rows[_rest_differs(words.buffer, words.starts[rows], self.raw, self.starts[slot[rows]], (words.ends - words.starts)[rows])]] = False
        self.met[slot[found]] = True
        return slot, found

    def joined(self, other: _Known) -> _Known:
        if not len(other.keys) or not len(self.keys):
            return self if len(self.keys) else other
        order = np.argsort(np.concatenate([self.keys, other.keys]), kind="stable")
        both = lambda a, b: np.concatenate([a, b])[order]
        pool, raw = len(self.pool), len(self.raw)
        return _Known(both(self.keys, other.keys), both(self.at, other.at + pool), both(self.size, other.size), np.concatenate([self.pool, other.pool]), both(self.starts, other.starts + raw), both(self.ends, other.ends + raw), np.concatenate([self.raw, other.raw]), both(self.met, other.met), both(self.one, other.one), both(self.two, other.two))

    def used(self) -> _Known:
        """The words that were met again, or none if these are too many still."""
        rows = np.flatnonzero(self.met)
        if len(rows) > _KEPT // 2:
            return _Known.none()
        size, long = self.size[rows], (self.ends - self.starts)[rows]
        return _Known(self.keys[rows], np.cumsum(size) - size, size, _gather(self.pool, self.at[rows], size), np.cumsum(long) - long, np.cumsum(long), _gather(self.raw, self.starts[rows], long), np.zeros(len(rows), bool), self.one[rows], self.two[rows])


def _gather(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    first = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))]


_LETTER, _MARK, _LATIN = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b'.,;:!?"#$%&()*+-/<=>@[\\]^_`{}~')] = True  # an apostrophe may begin a piece with the letters behind it, and special tokens hold bars
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True  # behind 0xC3: the letters from U+00C0 to U+00FF
_LATIN_LOWER = np.arange(256, dtype=np.uint8)
_LATIN_LOWER[0x80:0x9F] += 32


def _pieces(words: bw.Words) -> bw.Words:
    """Words cut where a mark follows a letter, as the tokenizer cuts them too. (It lower-cases as
    well, but looks for its special tokens first: texts with their brackets are not lowered.)"""
    cuts = np.flatnonzero(_LETTER[words.buffer[:-1]] & _MARK[words.buffer[1:]]) + 1
    if not len(cuts):
        return words
    at = np.zeros((2, len(words.buffer) + 1), bool)
    at[0, words.starts], at[1, words.ends], at[:, cuts] = True, True, True
    starts = np.flatnonzero(at[0])
    return bw.Words(words.buffer, words.offsets, starts, np.flatnonzero(at[1]), np.searchsorted(starts, words.offsets))


def _unlike(words: bw.Words, one: np.ndarray, two: np.ndarray, where: np.ndarray) -> np.ndarray:
    """The words whose bytes are not those of the word at ``where``, which stands for their hash."""
    size = words.ends - words.starts
    odd = (size != size[where]) | (one != one[where]) | (two != two[where])
    odd[_rest_differs(words.buffer, words.starts, words.buffer, words.starts[where], np.where(odd, 0, size))] = True
    return np.flatnonzero(odd)


class TokenCoder:
    _made: dict[str, TokenCoder] = {}

    @classmethod
    def get(cls, path: str) -> TokenCoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tails: dict[str, list[int]] = {}
        self.old, self.young = _Known.none(), _Known.none()

    def _general(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return self._general(word)
        stem, tail = plain.groups()
        letters = stem.lower() if stem.isascii() else stem.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
        ids = [t.id for t in self.tokenizer.model.tokenize(letters)]
        if tail:
            if tail not in self.tails:
                self.tails[tail] = self._general(tail)
            ids += self.tails[tail]
        return ids

    def _words(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
        """(ids, how many each word has) of the words of ``raw``, where they lie one behind the other. One list holds all ids:
        a list a word would have Python's garbage collector walk over all of them time and again."""
        ids, sizes = [], []
        if not len(starts):
            return ids, sizes
        second = np.zeros(len(raw), bool)  # of the two bytes of a Latin-1 letter
        second[1:] = raw[:-1] == 0xC3
        letter = np.where(second, _LATIN[raw], _LETTER[raw] | (raw == 0xC3))
        plain = np.logical_and.reduceat(letter, starts)
        spelt = _BYTE_POINTS[np.where(second, _LATIN_LOWER[raw], bw._LOWER[raw])].tobytes().decode("utf-32-le")
        whole, tokenize = raw.tobytes(), self.tokenizer.model.tokenize
        for p, a, b in zip(plain.tolist(), starts.tolist(), ends.tolist()):
            own = [t.id for t in tokenize(spelt[a:b])] if p else self._word(whole[a:b].decode())
            ids += own
            sizes.append(len(own))
        return ids, sizes

    def encode(self, words: bw.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, how many ids each word has, their hashes)."""
        if not len(words.starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        one, two = _heads(words.buffer, words.starts, words.ends - words.starts)
        hashes = _hashes(words, one, two)
        order = np.argsort(hashes)
        ranked = hashes[order]
        first = np.append(True, ranked[1:] != ranked[:-1])
        keys, where, inverse = ranked[first], order[first], np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(first) - 1
        asked = bw.Words(words.buffer, words.offsets, words.starts[where], words.ends[where], words.first)
        slot_old, in_old = self.old.find(keys, asked, one[where], two[where])
        slot_young, in_young = self.young.find(keys, asked, one[where], two[where])
        new = np.flatnonzero(~(in_old | in_young))
        odd = _unlike(words, one, two, where[inverse])  # words with the hash of another one: encoded on their own
        fresh = _Known.of(keys[new], asked.starts[new], asked.ends[new], words.buffer, self._words)
        rare = _Known.of(keys[inverse[odd]], words.starts[odd], words.ends[odd], words.buffer, self._words)
        bases = np.cumsum([0, len(self.old.pool), len(self.young.pool), len(fresh.pool)])
        at, size = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        for known, base, rows, slots in ((self.old, bases[0], np.flatnonzero(in_old), slot_old[in_old]), (self.young, bases[1], np.flatnonzero(in_young & ~in_old), slot_young[in_young & ~in_old]), (fresh, bases[2], new, np.arange(len(new)))):
            at[rows], size[rows] = known.at[slots] + base, known.size[slots]
        pool = np.concatenate([self.old.pool, self.young.pool, fresh.pool, rare.pool])
        at, counts = at[inverse], size[inverse]
        at[odd], counts[odd] = rare.at + bases[3], rare.size
        first = np.cumsum(counts) - counts
        ids = pool[np.repeat(at - first, counts) + np.arange(int(counts.sum()))]
        self.young = self.young.joined(fresh)
        if len(self.young.keys) > _KEPT // 4:
            self.old, self.young = self.old.joined(self.young), _Known.none()
            if len(self.old.keys) > _KEPT:
                self.old = self.old.used()
        return ids, counts, hashes

    def encode_pieces(self, buffer: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray, bw.Words, np.ndarray]:
        """(ids, offsets of each text's ids, the pieces of words that were looked up, their hashes), with
        ``end_id`` after each text."""
        words = _pieces(bw.find_words(buffer, offsets, lower=b"<|" not in buffer.tobytes()))
        ids, counts, hashes = self.encode(words)
        total = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=total[1:])
        bounds = total[words.first]
        if end_id is None:
            return ids, bounds, words, hashes
        return np.insert(ids, bounds[1:], np.uint32(end_id)), bounds + np.arange(len(bounds)), words, hashes

    def encode_texts(self, buffer: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids), with ``end_id`` after each text."""
        return self.encode_pieces(buffer, offsets, end_id)[:2]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
