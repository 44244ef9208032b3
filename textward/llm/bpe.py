"""Byte-level BPE by corpus-level merge replay.

Texts are encoded block by block. The distinct words of a block, as far as they are not known yet,
lie behind each other in one array of symbols. An inverted index maps a merge to the positions
whose symbol and right neighbour form it. Merges are taken from the index in rank order, each one
at all its positions at once, and only the pairs with touched neighbours are looked up anew.

A block is a bounded number of characters, so memory doesn't grow with the corpus, and nothing is
shuffled: the words a worker has seen are kept, up to a bound, for its later blocks.

Defined results: null and empty texts have no ids; a repeated row has the same ids each time; ids,
ties and the order of merges depend on the text and the ranks alone; texts of any length are encoded
whole, one longer than a block is a block; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import gc
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from textward.llm.common import per_worker

# Larger blocks take less time and more memory per worker.
BLOCK_CHARS = 2_000_000
KEPT_CHUNKS = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in lines if line.strip())}


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    """The bytes of each id."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class Merges:
    """Which neighbouring symbols form which token; a token's rank is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        found = []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found.append((left << 32 | right, rank))
        found.sort()
        self.pairs = np.array([p for p, _ in found] or [-1], np.int64)
        self.merged = np.array([m for _, m in found] or [-1], np.int64)
        left, right = self.pairs >> 32, self.pairs & 0xFFFFFFFF
        # A symbol that can take part in a merge of a lower rank than its own.
        self.reopens = np.zeros(max(ranks.values()) + 1, bool)
        self.reopens[left[self.merged < left]] = True
        self.reopens[right[self.merged < right]] = True
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token that each pair forms, or -1."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.merged[at], -1)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """All words' token ids behind each other, and the number of ids of each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    symbol = merges.bytes[np.frombuffer(b"".join(words), np.uint8)]
    n = len(symbol)
    word = np.repeat(np.arange(len(words)), lengths)
    if n < 2:
        return symbol, lengths
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(lengths)[lengths > 0] - 1
    after[ends] = -1
    before[ends[:-1] + 1] = -1
    pair = np.full(n, -1, np.int64)
    inside = np.flatnonzero(after >= 0)
    pair[inside] = merges.of(symbol[inside], symbol[inside + 1])

    index: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def post(positions: np.ndarray) -> None:
        """Add positions to the index under the merge that they form now."""
        forms = pair[positions]
        positions, forms = positions[forms >= 0], forms[forms >= 0]
        if not len(positions):
            return
        order = np.argsort(forms, kind="stable")
        positions, forms = positions[order], forms[order]
        cuts = np.flatnonzero(forms[1:] != forms[:-1]) + 1
        starts = [0, *cuts.tolist(), len(forms)]
        for lo, hi in zip(starts, starts[1:]):
            rank = int(forms[lo])
            if rank not in index:
                index[rank] = []
                heapq.heappush(ranks, rank)
            index[rank].append(positions[lo:hi])

    post(inside)
    while ranks:
        rank = heapq.heappop(ranks)
        lists = index.pop(rank)
        at = lists[0] if len(lists) == 1 else _distinct(np.concatenate(lists))
        at = at[pair[at] == rank]
        if not len(at):
            continue
        if merges.reopens[rank]:
            # The new symbol may form a lower merge, which its word has to take first.
            first = np.r_[True, word[at[1:]] != word[at[:-1]]]
            if not first.all():
                index[rank] = [at[~first]]
                heapq.heappush(ranks, rank)
                at = at[first]
        else:
            chained = np.r_[False, after[at[:-1]] == at[1:]]
            if chained.any():
                # Overlapping pairs, as in a run of one letter: every other one from the left.
                place = np.arange(len(at))
                start = np.maximum.accumulate(np.where(chained, 0, place))
                at = at[(place - start) % 2 == 0]
        gone = after[at]
        follows = after[gone]
        symbol[at] = rank
        symbol[gone] = -1
        pair[gone] = -1
        pair[at] = -1
        after[at] = follows
        inner = follows >= 0
        before[follows[inner]] = at[inner]
        right = at[inner]
        pair[right] = merges.of(symbol[right], symbol[follows[inner]])
        left = before[at]
        left = left[left >= 0]
        pair[left] = merges.of(symbol[left], symbol[after[left]])
        post(_distinct(np.concatenate([left, right])))
    left_over = symbol >= 0
    return symbol[left_over], np.bincount(word[left_over], minlength=len(words))


_BLANK_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")


class Encoder:
    """Encodes texts; keeps the ids of the chunks that it has seen.

    A chunk ends before a blank that follows a visible character. No match of the word pattern goes
    over such a place, so a chunk has the same ids wherever it stands.
    """

    def __init__(self, merges: Merges, pattern: str, block_chars: int = BLOCK_CHARS):
        self.merges, self.find = merges, regex.compile(pattern).findall
        self.block_chars = block_chars
        self.clear()

    def clear(self) -> None:
        self.inner: dict[str, int] = {}
        self.first: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.start = np.empty(0, np.int64)
        self.length = np.empty(0, np.int64)

    def _learn(self, firsts: set[str], inners: set[str]) -> None:
        chunks = [*firsts, *(" " + c for c in inners)]
        if not chunks:
            return
        slot: dict[str, int] = {}
        members = [[slot.setdefault(w, len(slot)) for w in self.find(c)] for c in chunks]
        words = [w.encode() for w in slot]
        whole = np.array([self.merges.ranks.get(w, -1) for w in words], np.int64)
        split = np.flatnonzero(whole < 0)
        ids, counts = replay([words[i] for i in split.tolist()], self.merges)
        length = np.ones(len(words), np.int64)
        length[split] = counts
        flat = np.empty(int(length.sum()), np.int32)
        start = np.cumsum(length) - length
        flat[start[whole >= 0]] = whole[whole >= 0]
        flat[_spread(start[split], counts)] = ids
        used = np.fromiter(chain.from_iterable(members), np.int64)
        sizes = np.fromiter(map(len, members), np.int64, len(members))
        chunk_ids = flat[_spread(start[used], length[used])]
        ends = np.r_[0, np.cumsum(length[used])][np.cumsum(sizes)]
        begins = np.r_[0, ends[:-1]]
        base = len(self.start)
        self.start = np.concatenate([self.start, begins + len(self.ids)])
        self.length = np.concatenate([self.length, ends - begins])
        self.ids = np.concatenate([self.ids, chunk_ids])
        self.first.update(zip(firsts, range(base, base + len(firsts))))
        self.inner.update(zip(inners, range(base + len(firsts), base + len(chunks))))

    def block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids behind each other, and the number of ids of each text."""
        parts = [_CUT.split(t) if _BLANK_AFTER_SPACE.search(t) else t.split(" ") for t in texts]
        if len(self.start) > KEPT_CHUNKS:
            self.clear()
        firsts = {p[0] for p in parts if p[0] not in self.first}
        inners = {c for p in parts for c in p[1:] if c not in self.inner}
        self._learn(firsts, inners)
        slots = np.fromiter(
            chain.from_iterable(
                chain((self.first[p[0]],), map(self.inner.__getitem__, p[1:])) for p in parts
            ),
            np.int64,
        )
        length = self.length[slots]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        total = np.r_[0, np.cumsum(length)][ends]
        return self.ids[_spread(self.start[slots], length)], np.diff(np.r_[0, total])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        block, chars = [], 0
        for text in texts:
            if block and chars + len(text) > self.block_chars:
                yield self.block(block)
                block, chars = [], 0
            block.append(text)
            chars += len(text)
        if block:
            yield self.block(block)


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each of the pieces, behind each other."""
    ends = np.cumsum(length)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)


def _merges(path: str) -> Merges:
    return per_worker(("merges", path), lambda: Merges(read_ranks(path)))


def _encoder(ranks_path: str, pattern: str, block_chars: int = BLOCK_CHARS) -> Encoder:
    # The tables hold no cycles, and looking for some among millions of entries is slow.
    gc.disable()
    return per_worker(
        ("encoder", ranks_path, pattern, block_chars),
        lambda: Encoder(_merges(ranks_path), pattern, block_chars),
    )


class Decoder:
    """The bytes of lists of ids."""

    def __init__(self, tokens: list[bytes]):
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)
        self.length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.length) - self.length

    def of(self, ids: np.ndarray) -> bytes:
        return self.letters[_spread(self.start[ids], self.length[ids])].tobytes()


def _decoder(ranks_path: str) -> Decoder:
    return per_worker(("decoder", ranks_path), lambda: Decoder(_tokens(read_ranks(ranks_path))))


def _encoded(encoder: Encoder, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids behind each other, and where each text's ids end."""
    blocks = list(encoder.encode(texts))
    ids = np.concatenate([b[0] for b in blocks] or [np.empty(0, np.int32)])
    return ids, np.cumsum(np.concatenate([b[1] for b in blocks] or [np.empty(0, np.int64)]))


def _lists(ids: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    # A batch has 64 MB at most unless it is one row, so its ids are fewer than 2^31.
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(ids))


def encode(text: Column | str, ranks_path: str, pattern: str) -> Column:
    """Token ids (``array<int>``) of each whole text; a null or empty text has none.

    Each match of ``pattern`` is encoded separately by the ranks in the file ``ranks_path``, which
    every executor has to be able to open. No special tokens.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(ranks_path, pattern)
        for column in texts:
            yield _lists(*_encoded(encoder, [t or "" for t in column.to_pylist()]))

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<int>")(text)


def round_trip(
    text: Column | str,
    ranks_path: str,
    pattern: str,
    *,
    keep_decoded: bool = False,
    block_chars: int = BLOCK_CHARS,
) -> Column:
    """``struct<ids array<int>, same boolean, decoded binary>`` of each text, by one worker.

    ``same``: the bytes that the ids decode to are the text's. The bytes themselves are returned
    only if asked for, else null. A null text counts as empty.
    """

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = _encoder(ranks_path, pattern, block_chars), _decoder(ranks_path)
        for column in texts:
            read = [t or "" for t in column.to_pylist()]
            ids, ends = _encoded(encoder, read)
            same, decoded = [], []
            for t, lo, hi in zip(read, [0, *ends.tolist()], ends.tolist()):
                raw = decoder.of(ids[lo:hi])
                same.append(raw == t.encode())
                decoded.append(raw if keep_decoded else None)
            yield pa.StructArray.from_arrays(
                [_lists(ids, ends), pa.array(same, pa.bool_()), pa.array(decoded, pa.binary())],
                names=["ids", "same", "decoded"],
            )

    run.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<ids array<int>, same boolean, decoded binary>")(text)


def decode(ids: Column | str, ranks_path: str) -> Column:
    """The bytes (``binary``) of each list of ids; a null list or an empty one gives no bytes.

    An id that is null or not in the file is an error.
    """

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = _decoder(ranks_path)
        for column in columns:
            if column.flatten().null_count:
                raise ValueError("a null among the token ids")
            flat = column.flatten().to_numpy()
            sizes = np.array([n or 0 for n in pc.list_value_length(column).to_pylist()], int)
            ends = np.cumsum(sizes).tolist()
            out = [decoder.of(flat[lo:hi]) for lo, hi in zip([0, *ends], ends)]
            yield pa.array(out, pa.binary())

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "binary")(ids)
