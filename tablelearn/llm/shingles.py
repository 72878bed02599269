"""Word shingles as 64-bit numbers, for many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, functions as F

WORDS = 5
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64 bits that looks random."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class WordHash(dict):
    """word -> 64-bit hash, remembered for the words seen lately."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def shingles(texts, memo: WordHash, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle), ordered by both, repeats kept. Words are lower-cased and cut at white space; a text of
    fewer words than a shingle is one shingle, a text without words has none."""
    lists = [(t or "").lower().split() for t in texts]
    lengths = np.array([len(w) for w in lists], np.int64)
    total = int(lengths.sum())
    flat = np.fromiter((memo[w] for ws in lists for w in ws), _U, total)
    owner = np.repeat(np.arange(len(lists)), lengths)
    place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    size = lengths[owner] if total else place
    starts = np.flatnonzero((place + words <= size) | ((size < words) & (place == 0)))
    value = mix(flat[starts])
    for k in range(1, words):
        at = starts + k
        inside = place[starts] + k < size[starts]
        value = np.where(inside, mix(value + flat[np.minimum(at, total - 1)]), value) if total else value
    order = np.lexsort((value, owner[starts]))
    return owner[starts][order], value[order]


def runs(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first of each run of equal (owner, value), and the length of the run."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1]))))
    return first, np.diff(np.append(first, len(owner)))


def elements(texts, memo: WordHash, words: int = WORDS) -> list[np.ndarray]:
    """Per text the distinct (shingle, how manieth) numbers: multiset overlap becomes set overlap."""
    owner, value = shingles(texts, memo, words)
    first, length = runs(owner, value)
    nth = np.arange(len(owner)) - np.repeat(first, length)
    marked = mix(value + nth.astype(_U) * _U(0x9E3779B97F4A7C15)).view(np.int64)
    return np.split(marked, np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1]) if len(texts) else []


def row_key(id_col: str, text_col: str) -> Column:
    """The id; where it is null a number above 2^62 made from the text, which ranks after any usual id."""
    high = F.lit(1 << 62) + F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col(id_col).cast("long"), high)
