"""Substring dedup by hashes of windows, after a filter by indexed blocks of all documents.

Every document is a reference for those with larger ids. Its blocks are runs of ``BLOCK`` words,
chosen by content: of each window of ``WINDOW`` consecutive words the block with the smallest hash
(a minimizer), so equal windows choose equal blocks wherever they stand. The index counts the
different texts that hold a block. A window whose block no other text holds can't be copied; all
others are open, and an open window is copied if its hash occurs in a document with a smaller id.
Runs of such windows are the duplicate spans. This stands in place of a relative Lempel-Ziv parse:
no match is extended greedily.

Texts that are equal as a whole are represented by the smallest id from the start. All shuffles
carry hashes and are reduced before (smallest id per hash), so a passage that a third of all
documents share is one row per task; only texts that hold a shared block move, once.

Hashes of windows and blocks have 64 bits.

Defined results: a null text has no words; a null id takes no part and keeps all words; rows with
one id are one document with several texts, none of which is a reference for the others; a repeated
row is parsed like the first; texts with fewer words than a window keep them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textward.llm.common import join_skewed, per_worker
from textward.sources.store import materialize

WINDOW = 50
BLOCK = 25
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base, np.uint64)])


class _Rolling:
    """Hashes of all runs of a length, from sums of word hashes times powers of an odd base."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if n >= len(self.up):
            n = 2 * n + 1024
            self.up = _powers(_BASE, n)
            self.down = _powers(pow(_BASE, -1, 2**64), n)

    def runs(self, hashes: np.ndarray, length: int) -> np.ndarray:
        n = len(hashes)
        self.grow(n)
        sums = np.r_[np.uint64(0), np.cumsum(hashes * self.up[:n])]
        x = (sums[length:] - sums[:-length]) * self.down[: n - length + 1]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def chosen_blocks(rolling: _Rolling, hashes: np.ndarray, window: int, block: int):
    """Hashes of all blocks, and for each window the place of the block that it chooses."""
    blocks = rolling.runs(hashes, block)
    choice = sliding_window_view(blocks, window - block + 1).argmin(axis=1)
    return blocks, choice + np.arange(len(choice))


def _mark(digest: str) -> int:
    """A text's 8-byte name in the tables of blocks and windows."""
    return int.from_bytes(bytes.fromhex(digest[:16]), "big", signed=True)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


_PARSED = (
    "struct<n_words bigint, digest string, mark bigint, blocks array<bigint>, places array<int>>"
)


def _parsed(text: Column, window: int, block: int) -> Column:
    """A text's number of words, digest, and its chosen blocks with their places."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rolling = per_worker("rolling", _Rolling)
        for column in columns:
            counts, digests, blocks, places = [], [], [], []
            for text in column.to_pylist():
                words = (text or "").encode().split()
                counts.append(len(words))
                digests.append(_digest(words))
                if len(words) < window:
                    blocks.append([])
                    places.append([])
                    continue
                hashes, choice = chosen_blocks(rolling, _word_hashes(words), window, block)
                at = choice[np.r_[True, choice[1:] != choice[:-1]]]
                at = np.unique(at)
                blocks.append(_signed(hashes[at]))
                places.append(at.astype(np.int32))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(map(_mark, digests), pa.int64()),
                    pa.array(blocks, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                names=["n_words", "digest", "mark", "blocks", "places"],
            )

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _PARSED)(text)


def _windows(text: Column, mark: Column, places: Column, window: int, block: int) -> Column:
    """``array<struct<start, hashes>>``: runs of windows whose chosen block is in ``places``.

    Null if the text isn't the one with the mark.
    """

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        rolling = per_worker("rolling", _Rolling)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("hashes", pa.list_(pa.int64()))]))
        for texts, marks, shared in columns:
            out = []
            for text, want, at in zip(texts.to_pylist(), marks.to_pylist(), shared.to_pylist()):
                words = (text or "").encode().split()
                if len(words) < window or _mark(_digest(words)) != want:
                    out.append(None)
                    continue
                hashes = _word_hashes(words)
                _, choice = chosen_blocks(rolling, hashes, window, block)
                asked = np.isin(choice, at)
                edges = np.flatnonzero(np.diff(np.r_[False, asked, False]))
                all_windows = _signed(rolling.runs(hashes, window))
                out.append(
                    [
                        {"start": int(lo), "hashes": all_windows[lo:hi]}
                        for lo, hi in zip(edges[::2], edges[1::2])
                    ]
                )
            yield pa.array(out, kind)

    run.__annotations__ = {
        "columns": Iterator[tuple[pa.Array, ...]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(run, "array<struct<start:int,hashes:array<bigint>>>")(text, mark, places)


_CUT = "struct<spans array<struct<start:int,end:int>>, n_removed bigint, kept string>"


def _cut(text: Column, starts: Column, window: int) -> Column:
    """Spans covered by windows at ``starts``, how many words they hold, and the other words."""

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        kind = pa.struct(
            [
                ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ("n_removed", pa.int64()),
                ("kept", pa.string()),
            ]
        )
        for texts, places in columns:
            out = []
            for text, at in zip(texts.to_pylist(), places.to_pylist()):
                words = (text or "").encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                change[at] += 1
                change[np.asarray(at) + window] -= 1
                gone = np.cumsum(change[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
                spans = [
                    {"start": int(lo), "end": int(hi)} for lo, hi in zip(edges[::2], edges[1::2])
                ]
                out.append({"spans": spans, "n_removed": int(gone.sum()), "kept": b" ".join(kept).decode()})
            yield pa.array(out, kind)

    run.__annotations__ = {
        "columns": Iterator[tuple[pa.Array, ...]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(run, _CUT)(text, starts)


def dedup_substrings(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, spans, n_removed, kept_sha256, kept``.

    ``spans`` are the removed ranges of words (start, end). ``kept`` is the rest of the words, joined
    by a blank, and null where nothing was removed (the text stays as it is).
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parsed = materialize(
        source.select("id", _parsed(F.col("text"), window, block).alias("p")).select("id", "p.*"),
        "substr-parsed",
    )
    long_enough = parsed.where((F.col("n_words") >= window) & F.col("id").isNotNull())
    firsts = long_enough.groupBy("digest").agg(F.min("id").alias("first"))
    texts = long_enough.join(firsts, "digest").where("id = first")

    held = texts.select("id", "mark", F.explode(F.arrays_zip("blocks", "places")).alias("b")).select(
        "id", "mark", F.col("b.blocks").alias("block"), F.col("b.places").alias("place")
    )
    index = held.groupBy("block").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi"))
    shared = index.where("lo < hi").select("block")
    factors = held.join(shared, "block", "left_semi").groupBy("id", "mark").agg(
        F.collect_set("place").alias("places")
    )
    open_texts = materialize(
        source.join(factors, "id").select(
            "id",
            "mark",
            "text",
            _windows(F.col("text"), F.col("mark"), F.col("places"), window, block).alias("runs"),
        ).where("runs IS NOT NULL"),
        "substr-windows",
    )
    windows = open_texts.select("id", "mark", F.explode("runs").alias("r")).select(
        "id", "mark", F.posexplode("r.hashes").alias("i", "hash"), F.col("r.start").alias("start")
    )
    origin = materialize(
        windows.groupBy("hash")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
        .where("first < last")
        .select("hash", "first", "n"),
        "substr-origins",
    )
    placed = windows.select("id", "mark", "hash", (F.col("start") + F.col("i")).alias("at"))
    copied = (
        join_skewed(placed, origin, "hash")
        .where("first < id")
        .groupBy("id", "mark")
        .agg(F.collect_set("at").alias("starts"))
    )
    cut = (
        open_texts.select("id", "mark", "text")
        .dropDuplicates(["id", "mark"])
        .join(copied, ["id", "mark"])
        .select("id", "mark", _cut(F.col("text"), F.col("starts"), window).alias("c"))
        .select("id", "mark", "c.*")
    )
    first = firsts.withColumnRenamed("digest", "_digest")
    rows = parsed.select("id", "digest", "mark", "n_words").join(
        first, (F.col("digest") == F.col("_digest")) & (F.col("n_words") >= window), "left"
    )
    whole = F.col("first") < F.col("id")
    found = cut.withColumnsRenamed({"id": "_id", "mark": "_cut_mark"})
    joined = rows.join(
        found, (F.col("id") == F.col("_id")) & (F.col("mark") == F.col("_cut_mark")), "left"
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    everything = F.array(
        F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))
    )
    kept = F.when(whole, F.lit("")).otherwise(F.col("kept"))
    return joined.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.when(whole, everything).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.coalesce(F.sha2(kept, 256), F.col("digest")).alias("kept_sha256"),
        kept.alias("kept"),
    )
