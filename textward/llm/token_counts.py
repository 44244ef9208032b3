"""Token counts by dynamic programming over prefixes, for BPE with word ends.

The tokens of a sequence are its BPE encoding exactly if each two neighbours are the encoding of
their concatenation. So the last token of every prefix of a word can be found from the last tokens
of its shorter prefixes: it is the one token that ends there and agrees with the last token before
it. With the last token the prefix stores its count, which answers how many tokens any prefix has
and where a budget of tokens ends, without encoding again.

Words are taken in sorted order and share the entries of the prefix they have in common.

Defined results: null and empty texts have no tokens; repeated rows have equal counts; texts of any
length are counted whole, and a budget's end is found in time linear in the text, unless a chunk
without blanks isn't in NFC or changes its length in lower case: then each prefix of that chunk is
asked; an empty table gives no rows.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from textward.llm.common import per_worker

KEPT_CHUNKS = 700_000
KEPT_PAIRS = 500_000
BLOCK_CHARS = 3_000_000
# Chunks and words up to this length are asked for each prefix anew.
SHORT = 64


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class PrefixTables:
    """Counts of words for the merges of one vocabulary."""

    def __init__(self, merges: list[tuple[str, str]], vocabulary: set[str], end: str):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.end = end
        self.inner = {t for t in vocabulary if not t.endswith(end)}
        self.final = {t.removesuffix(end) for t in vocabulary if t.endswith(end)}
        self.longest = max((len(t) for t in self.inner | self.final), default=1)
        self.fits: dict[tuple[str, str, bool], bool] = {}

    def _merged(self, symbols: list[str]) -> list[str]:
        """Merge by rank; only for single tokens and pairs of them."""
        while len(symbols) > 1:
            best = min(
                range(len(symbols) - 1),
                key=lambda i: self.rank.get((symbols[i], symbols[i + 1]), len(self.rank)),
            )
            if (symbols[best], symbols[best + 1]) not in self.rank:
                break
            symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
        return symbols

    def agree(self, before: str, token: str, final: bool) -> bool:
        """Whether ``before`` (empty at the start) and ``token`` are the encoding of both."""
        key = (before, token, final)
        if key not in self.fits:
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            last = token + self.end if final else token
            symbols = [*before, *token]
            if final:
                symbols[-1] += self.end
            self.fits[key] = self._merged(symbols) == ([before, last] if before else [last])
        return self.fits[key]

    def _last(self, word: str, at: int, tokens: list[str], final: bool) -> str:
        """The last token of the word's prefix of length ``at``."""
        known = self.final if final else self.inner
        for size in range(min(at, self.longest), 1, -1):
            token = word[at - size : at]
            if token in known and self.agree(tokens[at - size], token, final):
                return token
        return word[at - 1]

    def extend(self, word: str, tokens: list[str], counts: list[int], shared: int) -> None:
        """Entries of the open prefixes of ``word``; the first ``shared`` are kept."""
        del tokens[shared + 1 :], counts[shared + 1 :]
        for at in range(shared + 1, len(word)):
            token = self._last(word, at, tokens, False)
            tokens.append(token)
            counts.append(counts[at - len(token)] + 1)

    def closed(self, word: str, tokens: list[str], counts: list[int], at: int) -> int:
        """Tokens of the word's prefix of length ``at`` taken as a whole word."""
        return counts[at - len(self._last(word, at, tokens, True))] + 1 if at else 0

    def count_all(self, words: list[str]) -> dict[str, int]:
        tokens, counts, found, last = [""], [0], {}, ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(last)) - 1
            while shared < most and word[shared] == last[shared]:
                shared += 1
            self.extend(word, tokens, counts, shared)
            found[word] = self.closed(word, tokens, counts, len(word))
            last = word
        return found


class Counter:
    """Counts the tokens of texts as the tokenizer described by a JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: not a lower-case BPE with word ends")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.tables = PrefixTables(merges, set(model["vocab"]), model["end_of_word_suffix"])
        pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.find, self.match = pattern.findall, pattern.finditer
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}

    def _words(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            # The tokenizer lowers letter by letter, without the rule for a sigma at a word's end.
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        found = self.find(chunk.lower())
        if chunk.isascii():
            return found
        return [w.encode().decode("latin-1").translate(self.letters) for w in found]

    def _split(self, chunk: str) -> tuple[int, list[str]]:
        """Special tokens in the chunk, and the words of the rest."""
        if self.special is None or "<" not in chunk:
            return 0, self._words(chunk)
        pieces = self.special.split(chunk)
        return len(pieces) - 1, [w for p in pieces for w in self._words(p)]

    def learn(self, chunks: set[str]) -> None:
        if len(self.chunks) > KEPT_CHUNKS:
            self.chunks.clear()
            self.words.clear()
        fresh = [c for c in chunks if c not in self.chunks]
        split = [self._split(c) for c in fresh]
        unknown = {w for _, words in split for w in words if w not in self.words}
        self.words.update(self.tables.count_all(list(unknown)))
        for chunk, (special, words) in zip(fresh, split):
            self.chunks[chunk] = special + sum([self.words[w] for w in words])

    def count(self, text: str) -> int:
        """Tokens of a text; no word goes over a blank, so its chunks are counted separately."""
        chunks = text.split(" ")
        try:
            return sum([self.chunks[c] for c in chunks])
        except KeyError:
            self.learn(set(chunks))
            return sum([self.chunks.get(c, 0) or self._count_new(c) for c in chunks])

    def _count_new(self, chunk: str) -> int:
        if chunk not in self.chunks:
            self.learn({chunk})
        return self.chunks[chunk]

    def prefix_counts(self, chunk: str) -> list[int]:
        """Tokens of ``chunk[:i]`` for each i from 0 to its length."""
        out = []
        for at in range(len(chunk) + 1):
            special, words = self._split(chunk[:at])
            whole, open_word = words[:-1], words[-1:]
            unknown = [w for w in whole if w not in self.words]
            if unknown:
                self.words.update(self.tables.count_all(unknown))
            total = special + sum(self.words[w] for w in whole)
            for word in open_word:
                tokens, counts = [""], [0]
                self.tables.extend(word, tokens, counts, 0)
                total += self.tables.closed(word, tokens, counts, len(word))
            out.append(total)
        return out

    def places(self, chunk: str) -> list[tuple[int, int, int, bool]] | None:
        """``(start, end, tokens, special)`` of the chunk's words; None if these have no place in it.

        Lower case and NFC can change a text's length; then words aren't parts of the chunk.
        """
        if len(chunk.lower()) != len(chunk) or not unicodedata.is_normalized("NFC", chunk):
            return None
        pieces, lo = [], 0
        for found in self.special.finditer(chunk) if self.special else ():
            pieces += [(lo, found.start(), False), (found.start(), found.end(), True)]
            lo = found.end()
        spans = []
        for lo, hi, special in [*pieces, (lo, len(chunk), False)]:
            if special:
                spans.append((lo, hi, True))
            else:
                lowered = chunk[lo:hi].replace("Σ", "σ").lower()
                spans += [(lo + m.start(), lo + m.end(), False) for m in self.match(lowered)]
        words = [self._words(chunk[lo:hi]) for lo, hi, special in spans if not special]
        if any(len(w) != 1 for w in words):
            return None
        unknown = {w for (w,) in words if w not in self.words}
        self.words.update(self.tables.count_all(list(unknown)))
        counts = iter(words)
        return [(lo, hi, 1 if s else self.words[next(counts)[0]], s) for lo, hi, s in spans]

    def word_prefixes(self, part: str) -> list[int]:
        """Tokens of ``part[:i]`` for each i, of one run of letters or of signs; linear."""
        (word,) = self._words(part)
        tokens, counts = [""], [0]
        self.tables.extend(word, tokens, counts, 0)
        ends, at = [0], 0
        for letter in part.replace("Σ", "σ").lower():
            at += len(letter.encode())
            ends.append(at)
        return [self.tables.closed(word, tokens, counts, at) for at in ends]

    def fitting(self, text: str, budget: int) -> int:
        """Length of the longest prefix, in characters, with at most ``budget`` tokens.

        Running totals of whole chunks and words lead to the word in which the budget ends; the
        stored counts of its prefixes tell where.
        """
        used = at = best = 0
        for chunk in text.split(" "):
            # A blank alone adds no token, so the place behind it fits if the place before does.
            if used + self._count_new(chunk) <= budget:
                used += self.chunks[chunk]
                at += len(chunk) + 1
                best = at - 1
                continue
            return max(best, at + self._fitting_chunk(chunk, budget - used))
        return len(text)

    def _fitting_chunk(self, chunk: str, budget: int) -> int:
        """As ``fitting`` for one chunk that has more tokens than the budget."""
        words = self.places(chunk) if len(chunk) > SHORT else None
        if words is None:
            # Counts inside a word can fall again, so every prefix of the chunk is asked.
            return max(i for i, n in enumerate(self.prefix_counts(chunk)) if n <= budget or not i)
        used = over = 0
        while used + words[over][2] <= budget:
            used += words[over][2]
            over += 1
        lo, hi, _, special = words[over]
        following = words[over + 1][3] if over + 1 < len(words) else False
        if special or following:
            # A cut special string is plain text, one word with signs before it.
            first = max(0, over - 1)
            used -= sum(n for _, _, n, _ in words[first:over])
            lo, hi = words[first][0], words[over + following][1]
            inside = self.prefix_counts(chunk[lo:hi])
        elif hi - lo <= SHORT:
            inside = self.prefix_counts(chunk[lo:hi])
        else:
            inside = self.word_prefixes(chunk[lo:hi])
        return lo + max(i for i, n in enumerate(inside) if used + n <= budget or not i)


def count_tokens(text: Column | str, tokenizer_path: str, budget: int | None = None) -> Column:
    """``struct<n_tokens bigint, fits bigint>`` of each whole text; a null text counts as empty.

    ``fits`` is the length in characters of the longest prefix with at most ``budget`` tokens, the
    whole length for texts within the budget and null without a budget. No special tokens are
    added; special strings inside a text count as their one token, which is the tokenizer's default.
    """

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # The tables hold no cycles, and looking for some among millions of entries is slow.
        gc.disable()
        counter = per_worker(("counter", tokenizer_path), lambda: Counter(tokenizer_path))
        for column in columns:
            texts = [t or "" for t in column.to_pylist()]
            lo, chars = 0, 0
            counts: list[int] = []
            fits: list[int | None] = []
            for hi, text in enumerate(texts, 1):
                chars += len(text)
                if chars <= BLOCK_CHARS and hi < len(texts):
                    continue
                block = texts[lo:hi]
                counter.learn({c for t in block for c in t.split(" ")})
                for t in block:
                    n = counter.count(t)
                    counts.append(n)
                    if budget is None:
                        fits.append(None)
                    else:
                        fits.append(len(t) if n <= budget else counter.fitting(t, budget))
                lo, chars = hi, 0
            yield pa.StructArray.from_arrays(
                [
                    pa.array(counts, pa.int64()),
                    pa.array(fits, pa.int64()),
                ],
                names=["n_tokens", "fits"],
            )

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<n_tokens bigint, fits bigint>")(text)
