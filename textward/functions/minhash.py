"""MinHash band keys of a text, as an Arrow UDF.

The arithmetic is the published universal-hash MinHash over 32-bit SHA-1 shingle hashes. Spark's
built-ins have neither wrapping 64-bit products nor a per-row set, hence Arrow and NumPy.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The modulus, the hash width and the seed of the permutation family.
MERSENNE_PRIME = (1 << 61) - 1
MAX_HASH = (1 << 32) - 1
PERMUTATION_SEED = 1

NUM_PERM = 128
SHINGLE = 4

# Texts are worked off in groups of up to this many characters, so that a shingle common to several
# is hashed once; it bounds the rows of the group's table at 512 bytes each.
_GROUP_CHARS = 1 << 18
_CHUNK = 512
_CACHE = 1 << 18
# Shingles whose permuted hashes a worker keeps between groups, at 512 bytes each.
_KEPT = 1 << 16


@functools.cache
def permutations(num_perm: int = NUM_PERM) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the hash family ``(a * h + b) mod p mod 2**32``."""
    rng = np.random.RandomState(PERMUTATION_SEED)
    pairs = np.empty((num_perm, 2), dtype=np.uint64)
    for row in pairs:
        row[0] = rng.randint(1, MERSENNE_PRIME, dtype=np.uint64)
        row[1] = rng.randint(0, MERSENNE_PRIME, dtype=np.uint64)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


@functools.cache
def band_layout(threshold: float, num_perm: int = NUM_PERM) -> tuple[int, int]:
    """(bands, rows) that minimise the summed false-positive and false-negative areas.

    A pair of similarity s meets in some band with probability ``1 - (1 - s**rows)**bands``.
    """
    below = np.linspace(0.0, threshold, 2001)
    above = np.linspace(threshold, 1.0, 2001)
    best = None
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            false_pos = np.trapezoid(1 - (1 - below**rows) ** bands, below)
            false_neg = np.trapezoid((1 - above**rows) ** bands, above)
            cost = false_pos + false_neg
            if best is None or cost < best[0]:
                best = (cost, bands, rows)
    return best[1], best[2]


@functools.lru_cache(maxsize=_CACHE)
def _hash32(shingle: str) -> int:
    return int.from_bytes(hashlib.sha1(shingle.encode("utf-8")).digest()[:4], "little")


def _permuted(shingles: list[str], num_perm: int) -> np.ndarray:
    """One row of permuted hashes per shingle."""
    a, b = permutations(num_perm)
    hashes = np.fromiter(map(_hash32, shingles), dtype=np.uint64, count=len(shingles))
    table = np.empty((len(shingles), num_perm), dtype=np.uint32)
    prime = np.uint64(MERSENNE_PRIME)
    for at in range(0, len(shingles), _CHUNK):
        part = hashes[at : at + _CHUNK, None] * a + b
        # Modulo 2^61 - 1: the high bits count once more, then at most one subtraction is left.
        low = part & prime
        part >>= np.uint64(61)
        low += part
        np.subtract(low, prime, out=low, where=low >= prime)
        table[at : at + _CHUNK] = low & np.uint64(MAX_HASH)
    return table


class _Kept:
    """Rows of permuted hashes of the shingles met so far; when it is full it starts anew."""

    def __init__(self, num_perm: int) -> None:
        self.num_perm = num_perm
        self.place: dict[str, int] = {}
        self.table = np.empty((_KEPT, num_perm), np.uint32)

    def rows(self, shingles: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A table, and the row of each of ``shingles`` in it."""
        size = len(self.table)
        if len(shingles) > size:
            return _permuted(shingles, self.num_perm), np.arange(len(shingles))
        new = list(dict.fromkeys(s for s in shingles if s not in self.place))
        if len(self.place) + len(new) > size:
            self.place.clear()
            new = list(dict.fromkeys(shingles))
        at = len(self.place)
        self.table[at : at + len(new)] = _permuted(new, self.num_perm)
        self.place.update(zip(new, range(at, at + len(new))))
        return self.table, np.fromiter(map(self.place.__getitem__, shingles), np.int64, len(shingles))


_kept = functools.cache(_Kept)


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorts ``numbers`` in place and returns each once; ``np.unique`` hashes them, which is slower."""
    numbers.sort()
    first = np.ones(len(numbers), bool)
    np.not_equal(numbers[1:], numbers[:-1], out=first[1:])
    return numbers[first]


def _windows(
    joined: str, starts: np.ndarray, text: np.ndarray, k: int
) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """The distinct windows of ``k`` characters, and each text and window in it, ordered by both.

    Characters are numbered within the group; None if a text and its window need over 64 bits.
    """
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(int(points.max(initial=0)) + 1, bool)
    seen[points] = True
    number = (np.cumsum(seen) - 1)[points].astype(np.uint64)
    bits = int(seen.sum()).bit_length()
    if bits * k + int(text.max(initial=0)).bit_length() > 64 or bits * k == 64:
        return None
    pairs = text.astype(np.uint64)
    for j in range(k):
        pairs = pairs << np.uint64(bits) | number[starts + j]
    pairs = _distinct(pairs)
    code = pairs & np.uint64((1 << bits * k) - 1)
    codes = _distinct(code.copy())
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64) * np.uint64(bits)
    digits = codes[:, None] >> shifts & np.uint64((1 << bits) - 1)
    letters = seen.nonzero()[0].astype("<u4")[digits].tobytes().decode("utf-32-le", "surrogatepass")
    shingles = [letters[i : i + k] for i in range(0, len(letters), k)]
    owner = (pairs >> np.uint64(bits * k)).astype(np.int64)
    return shingles, owner, np.searchsorted(codes, code)


def _shingle_rows(texts: list[str], k: int) -> tuple[list[str], list[np.ndarray]]:
    """The distinct shingles of a few texts, and for each text which of them it has.

    A text shorter than a shingle is one itself.
    """
    sizes = np.array([len(t) - k + 1 for t in texts], np.int64)
    joined = "".join(texts)
    offset = np.cumsum([0, *map(len, texts)])[:-1]
    held = np.maximum(sizes, 0)
    text = np.repeat(np.arange(len(texts)), held)
    starts = np.arange(int(held.sum())) + (offset - np.cumsum(held) + held)[text]
    windows = _windows(joined, starts, text, k)
    if windows is None:
        of: dict[str, int] = {}
        inverse = np.array([of.setdefault(joined[i : i + k], len(of)) for i in starts.tolist()], np.int64)
        shingles = list(of)
        pairs = _distinct(text * max(1, len(shingles)) + inverse)
        owner, held_at = np.divmod(pairs, max(1, len(shingles)))
    else:
        shingles, owner, held_at = windows
    rows = np.split(held_at, np.searchsorted(owner, np.arange(1, len(texts))))
    for i in np.flatnonzero(sizes <= 0).tolist():
        rows[i] = np.array([len(shingles)])
        shingles.append(texts[i])
    return shingles, rows


def _group_signatures(texts: list[str], num_perm: int, k: int) -> list[np.ndarray]:
    """Signatures of a few texts: a table over their shingles, then column minima per text."""
    shingles, rows = _shingle_rows(texts, k)
    table, place = _kept(num_perm).rows(shingles)
    # All of them before the table changes for another group.
    return [table.take(place[row], axis=0).min(axis=0) for row in rows]


def _long_signature(text: str, num_perm: int, k: int) -> np.ndarray:
    """The signature is the minimum over overlapping pieces of the text."""
    low = np.full(num_perm, MAX_HASH, dtype=np.uint32)
    for at in range(0, len(text) - k + 1, _GROUP_CHARS):
        piece = text[at : at + _GROUP_CHARS + k - 1]
        np.minimum(low, _group_signatures([piece], num_perm, k)[0], out=low)
    return low


def signatures(
    texts: Iterable[str], num_perm: int = NUM_PERM, k: int = SHINGLE
) -> Iterator[np.ndarray]:
    """MinHash signatures of normalized texts, in order; memory is bounded for texts of any length."""
    group: list[str] = []
    size = 0
    for text in texts:
        if size + len(text) > _GROUP_CHARS and group:
            yield from _group_signatures(group, num_perm, k)
            group, size = [], 0
        if len(text) > _GROUP_CHARS:
            yield _long_signature(text, num_perm, k)
            continue
        group.append(text)
        size += len(text)
    if group:
        yield from _group_signatures(group, num_perm, k)


def _band_keys(sig: np.ndarray, bands: int, rows: int) -> list[bytes]:
    """A 128-bit digest per band; the band number salts it, so bands never mix."""
    return [
        hashlib.blake2b(
            sig[i * rows : (i + 1) * rows].tobytes(), digest_size=16, salt=i.to_bytes(2, "big")
        ).digest()
        for i in range(bands)
    ]


def band_keys(normalized: Column, threshold: float, num_perm: int = NUM_PERM) -> Column:
    """One 128-bit key per band; two texts collide when any key is equal."""
    bands, rows = band_layout(threshold, num_perm)

    @F.pandas_udf("array<binary>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_band_keys(s, bands, rows) for s in signatures(texts, num_perm)])

    return keys(normalized)
