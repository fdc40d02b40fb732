"""Hashes of template windows of many texts at once, in numpy: the first pass of the benchmark decontamination.

The canonical words are those of ``decontaminate.template``: lower case, without outer punctuation, with numbers, units
after a number and names as placeholders. Words of ASCII letters, with or without punctuation behind them, are hashed from
running sums over the whole slice of texts; others are put in canonical form one by one and remembered. Equal canonical
words have equal hashes, so windows that are equal there are equal here.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from txnspark.llm.common import worker_code
from txnspark.llm.word_hashes import BASE, SLICE_BYTES, _codes, _powers, mix

worker_code(__name__)

REMEMBERED = 200_000
_U = np.uint64
_NAME, _NUM, _UNIT = (_U(x) for x in (0x8D2C6A1F5B3E9701, 0x3F6B1C9E7A5D2405, 0xB5E3D7094C8A6F13))
_PLACES = [_U(x | 1) for x in (
    0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
    0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93,
)]
_DOTS = re.compile(r"[.,:/]+(?![0-9])")
_NUMBER = re.compile(r"[$]?[0-9][0-9.,:/]*%?")


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_LETTERS = _table(bytes(range(65, 91)) + bytes(range(97, 123)))
_UPPER, _LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_SPACES = _table(b" \t\n\x0b\x0c\r")
_ENDS = _table(b".!?:;")
_OTHER = _table(bytes(range(128, 256)) + b"0123456789$%\x01")  # what a word is not read at sight with


def _hash(text: str, codes: list[int]) -> int:
    total, power = 0, 1
    for b in text.encode():
        total, power = total + codes[b] * power, power * BASE
    return total % 2**64


def _canonical(token: str) -> tuple[str, bool, bool]:
    """(canonical word before placeholders, whether it is a number, whether it begins like a name)."""
    capital = len(token) > 1 and unicodedata.category(token[0]) == "Lu" and unicodedata.category(token[1]) == "Ll"
    bare = "".join(c for c in token if c in "$%.,:/\x01" or unicodedata.category(c)[0] in "LMN")
    word = re.sub("\x01.+", "<name>", _DOTS.sub("", bare).lower())
    return word, bool(_NUMBER.fullmatch(word)), capital


class Reader:
    """Canonical words of slices of texts."""

    def __init__(self, units: list[str]):
        self.codes = _codes()
        self.code_list = [int(c) for c in self.codes]
        self.read_codes = np.where(_LETTERS, self.codes, _U(0))
        self.units = np.array(sorted(_hash(u, self.code_list) for u in units), np.uint64)
        self.known: dict[bytes, tuple[int, bool, bool, bool]] = {}
        self.powers = _powers(SLICE_BYTES + 1)

    def _look_up(self, token: bytes) -> tuple[int, bool, bool, bool]:
        found = self.known.get(token)
        if found is None:
            word, number, capital = _canonical(token.decode())
            found = (int(_NAME) if word == "<name>" else _hash(word, self.code_list), number, capital, not word)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[token] = found
        return found

    def words(self, raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the canonical words of the texts between the cuts, number of words of each)."""
        n = len(raw)
        if n >= len(self.powers[0]):
            self.powers = _powers(n + 1)
        inside = ~_SPACES[raw]
        edge = np.zeros(n + 1, bool)
        edge[cuts] = True
        before, after = np.concatenate(([False], inside)), np.concatenate((inside, [False]))
        starts, stops = np.flatnonzero(after & (~before | edge)), np.flatnonzero(before & (~after | edge))
        letters = _LETTERS[raw]
        # Punctuation before a letter of the same word.
        hard = _OTHER[raw]
        hard[:-1] |= inside[:-1] & ~letters[:-1] & letters[1:] & ~edge[1:-1] if n else False
        count = lambda mask: np.concatenate(([0], np.cumsum(mask)))
        hards, known = count(hard), count(letters)
        slow = hards[stops] > hards[starts]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.read_codes[raw] * self.powers[0][:n], dtype=np.uint64)))
        h = (sums[stops] - sums[starts]) * self.powers[1][starts]
        empty = known[stops] == known[starts]
        second = np.minimum(starts + 1, max(n - 1, 0))
        capital = _UPPER[raw[starts]] & _LOWER[raw[second]] & (starts + 1 < stops)
        number = np.zeros(len(starts), bool)
        data = raw.tobytes()
        for i in np.flatnonzero(slow).tolist():
            h[i], number[i], capital[i], empty[i] = self._look_up(data[starts[i] : stops[i]])
        text = np.searchsorted(cuts, starts, "right") - 1
        begin = cuts[text]
        behind = raw[np.maximum(starts - 1, 0)] == 32
        ended = _ENDS[raw[np.maximum(starts - 2, 0)]] & (starts - 2 >= begin)
        name = capital & (starts > begin) & behind & ~ended
        unit = np.zeros(len(starts), bool)
        unit[1:] = number[:-1] & (starts[1:] - stops[:-1] == 1) & (text[1:] == text[:-1]) & behind[1:]
        unit &= ~name & np.isin(h, self.units)
        h = mix(np.select([name, number, unit], [_NAME, _NUM, _UNIT], h))
        keep = ~empty
        return h[keep], np.bincount(text[keep], minlength=len(cuts) - 1)


def windows(words: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the text, hash) of every run of ``length`` words."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = mix(sum(words[k : k + n] * _PLACES[k] for k in range(length)) + _U(length))
    text = np.repeat(np.arange(len(counts)), counts)
    start = np.cumsum(counts) - counts
    inside = np.flatnonzero(text[:n] == text[length - 1 :])
    return text[inside], inside - start[text[inside]], h[inside]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes of a run of texts, where each starts and the last ends); NULL is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def all_windows(units: list[str], longest: int):
    """(item, part, text) to (item, part, length, p, h): the windows of ``longest`` words, of a shorter text its only one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(units)
        for batch in batches:
            for first, raw, cuts in slices(batch.column("text")):
                words, counts = reader.words(raw, cuts)
                for length in range(1, longest + 1):
                    text, place, h = windows(words, counts, length)
                    mine = (counts[text] == length) if length < longest else np.ones(len(text), bool)
                    at = pa.array(text[mine] + first)
                    columns = [batch.column(c).take(at) for c in ("item", "part")]
                    columns += [pa.array(np.full(mine.sum(), length), pa.int32()), pa.array(place[mine], pa.int32()), pa.array(h[mine].view(np.int64))]
                    yield pa.RecordBatch.from_arrays(columns, names=["item", "part", "length", "p", "h"])

    return run


def found_windows(units: list[str], lengths: list[int], bits: np.ndarray):
    """(doc, body, text) to (doc, body, h): the windows whose hash has its bit set; a power of two of bits."""
    shift = _U(64 - (8 * len(bits)).bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(units)
        for batch in batches:
            for first, raw, cuts in slices(batch.column("text")):
                words, counts = reader.words(raw, cuts)
                for length in lengths:
                    text, _, h = windows(words, counts, length)
                    bit = h >> shift
                    hit = (bits[(bit >> _U(3)).astype(np.int64)] >> (bit & _U(7)).astype(np.uint8)) & 1 == 1
                    if hit.any():
                        at = pa.array(text[hit] + first)
                        columns = [batch.column(c).take(at) for c in ("doc", "body")]
                        yield pa.RecordBatch.from_arrays([*columns, pa.array(h[hit].view(np.int64))], names=["doc", "body", "h"])

    return run
