"""Ranked lexical search of items in documents, by dense multiplication of tiles.

Documents are packed into tiles once: per document its length and the counts of its terms, numbered
within the tile. Statistics come from the tiles: document frequencies are summed per tile before
they are shuffled. Items become weights per term, packed into blocks. A tile meets a block in the
task that reads the tile: the terms they share are the compact vocabulary, the documents' impacts
are a dense matrix over it, the items' weights another, and their product, taken by BLAS in doubles,
is the scores. The vocabulary is cut so that every partial sum stays below 2^53 and is exact; the
sums are added up as 64-bit integers.

Each task keeps the ``k`` best of every item, ties in order of the document's id, and only these are
shuffled, first to spread groups of an item and then to the item. Blocks are broadcast in groups of
at most about ``BROADCAST_TERMS`` weights; a larger set of items takes more groups, each of which
reads the tiles again.

Defined results: a null text has no terms; documents without an id count in the statistics but
can't be named, so they aren't ranked; every row is a document, repeated ones too; items without an
id take no part, of items with one id the smallest text counts; items without terms and documents
with a score of 0 give no rows; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textward.llm.common import ascii_lower
from textward.llm.decontaminate import WORD_LETTERS
from textward.sources.store import materialize

# Terms of a block of items, and of the blocks that are broadcast together.
BLOCK_TERMS = 100_000
BROADCAST_TERMS = 1_000_000
# Distinct terms per document, summed over a tile, and cells of a dense matrix.
TILE_TERMS = 60_000
STEP_CELLS = 1 << 21
SPREAD = 32
# Impacts are below 10^9 / 1000.
MOST_IMPACT = 10**6
EXACT = 2**53

_SPACE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

_TILE = (
    "n_docs bigint, n_terms bigint, terms array<binary>, df array<bigint>, ids binary,"
    " named binary, length binary, distinct binary, slot binary, tf binary"
)


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of digits, letters a-z (A-Z lower-cased) and all non-ASCII."""
    return text.translate(_SPACE).split()


def _tile(rows: list[tuple[int | None, int, Counter]]) -> pa.RecordBatch:
    slots: dict[bytes, int] = {}
    slot = np.array([slots.setdefault(t, len(slots)) for _, _, c in rows for t in c], np.int32)
    tf = np.array([n for _, _, c in rows for n in c.values()], np.int64)
    raw = lambda values, kind: np.array(values, kind).tobytes()
    one = {
        "n_docs": (sum(n > 0 for _, n, _ in rows), pa.int64()),
        "n_terms": (sum(n for _, n, _ in rows), pa.int64()),
        "terms": (list(slots), pa.list_(pa.binary())),
        "df": (np.bincount(slot, minlength=len(slots)).tolist(), pa.list_(pa.int64())),
        "ids": (raw([0 if i is None else i for i, _, _ in rows], np.int64), pa.binary()),
        "named": (raw([i is not None for i, _, _ in rows], bool), pa.binary()),
        "length": (raw([n for _, n, _ in rows], np.int64), pa.binary()),
        "distinct": (raw([len(c) for _, _, c in rows], np.int64), pa.binary()),
        "slot": (slot.tobytes(), pa.binary()),
        "tf": (tf.tobytes(), pa.binary()),
    }
    return pa.RecordBatch.from_arrays(
        [pa.array([v], kind) for v, kind in one.values()], names=list(one)
    )


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for batch in batches:
        for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            found = terms_of(text)
            if not found:
                continue
            counted = Counter(found)
            rows.append((key, len(found), counted))
            held += len(counted)
            if held >= TILE_TERMS:
                yield _tile(rows)
                rows, held = [], 0
    if rows:
        yield _tile(rows)


def pack_documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Tiles of documents with terms."""
    read = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    return read.mapInArrow(_pack, _TILE)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term, times`` of the items that have an id."""
    terms = F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD_LETTERS + "+"), F.lit(0))
    return (
        items.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("item"))
        .agg(F.min(text_col).alias("text"))
        .select("item", F.explode(terms.cast("array<binary>")).alias("term"))
        .groupBy("item", "term")
        .agg(F.count("*").alias("times"))
    )


def _impacts(tile: dict, n_docs: int, n_terms: int) -> np.ndarray:
    """``10^9 tf div (1000 tf + 12 m)`` of each entry of a tile."""
    length = np.frombuffer(tile["length"], np.int64).tolist()
    # In Python's integers, as 25 n N can be beyond 2^63.
    m = np.array([75 + 25 * n * n_docs // n_terms for n in length], np.int64)
    m = np.repeat(m, np.frombuffer(tile["distinct"], np.int64))
    tf = np.frombuffer(tile["tf"], np.int64)
    return 10**9 * tf // (1000 * tf + 12 * m)


def scores(
    weights: np.ndarray, vocabulary: np.ndarray, document: np.ndarray, impact: np.ndarray, n: int
) -> np.ndarray:
    """Scores (items x ``n`` documents) as 64-bit integers, exact.

    ``weights`` is items x terms; the other arrays are the entries (term, document, impact).
    """
    out = np.zeros((len(weights), n), np.int64)
    most = weights.max(axis=0, initial=0)
    cut = np.cumsum(most * MOST_IMPACT)
    step = max(1, STEP_CELLS // max(1, n, len(weights)))
    order = np.argsort(vocabulary, kind="stable")
    vocabulary, document, impact = vocabulary[order], document[order], impact[order]
    lo = 0
    while lo < weights.shape[1]:
        before = cut[lo - 1] if lo else 0
        hi = max(lo + 1, min(lo + step, int(np.searchsorted(cut, before + EXACT, "left"))))
        a, b = np.searchsorted(vocabulary, [lo, hi])
        dense = np.zeros((hi - lo, n), np.float64)
        dense[vocabulary[a:b] - lo, document[a:b]] = impact[a:b]
        part = weights[:, lo:hi]
        if hi == lo + 1 and most[lo] * MOST_IMPACT >= EXACT:
            out += part.astype(np.int64) @ dense.astype(np.int64)
        else:
            out += (part.astype(np.float64) @ dense).astype(np.int64)
        lo = hi
    return out


def best(score: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row of ``score`` the ids and scores of the k best above 0, ties by id."""
    found = []
    for row in score:
        at = np.flatnonzero(row > 0)
        if len(at) > k:
            least = np.partition(row[at], len(at) - k)[len(at) - k]
            at = at[row[at] >= least]
        at = at[np.lexsort((ids[at], -row[at]))[:k]]
        found.append((ids[at], row[at]))
    return found


class _Best:
    """The k best of each item of a block over the tiles of a task."""

    def __init__(self, entries: list[dict]):
        self.items = sorted({e["item"] for e in entries})
        self.slots: dict[bytes, int] = {}
        place = {item: i for i, item in enumerate(self.items)}
        cells = [
            (place[e["item"]], self.slots.setdefault(e["term"], len(self.slots)), e["weight"])
            for e in entries
        ]
        self.row, self.column, self.weight = np.array(cells, np.int64).reshape(-1, 3).T
        self.kept = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.items]

    def add(self, tile: dict, impact: np.ndarray, k: int) -> None:
        # The tile's terms that the block has, as columns.
        column = np.full(len(tile["terms"]), -1, np.int64)
        of = np.full(len(self.slots), -1, np.int64)
        shared = 0
        for i, term in enumerate(tile["terms"]):
            slot = self.slots.get(term)
            if slot is not None:
                column[i], of[slot], shared = shared, shared, shared + 1
        entry = column[np.frombuffer(tile["slot"], np.int32)]
        distinct = np.frombuffer(tile["distinct"], np.int64)
        named = np.frombuffer(tile["named"], bool)
        held = (entry >= 0) & np.repeat(named, distinct)
        document = np.repeat(np.arange(len(distinct)), distinct)[held]
        if not len(document):
            return
        mine = of[self.column] >= 0
        weights = np.zeros((len(self.items), shared), np.int64)
        weights[self.row[mine], of[self.column[mine]]] = self.weight[mine]
        ids = np.frombuffer(tile["ids"], np.int64)
        table = scores(weights, entry[held], document, impact[held], len(ids))
        for i, (more_ids, more) in enumerate(best(table, ids, k)):
            if len(more):
                all_ids = np.r_[self.kept[i][0], more_ids]
                all_scores = np.r_[self.kept[i][1], more]
                top = np.lexsort((all_ids, -all_scores))[:k]
                self.kept[i] = all_ids[top], all_scores[top]

    def batch(self) -> pa.RecordBatch:
        sizes = [len(ids) for ids, _ in self.kept]
        joined = lambda j: np.concatenate([x[j] for x in self.kept] or [np.empty(0, np.int64)])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, n in zip(self.items, sizes) for _ in range(n)], pa.string()),
                pa.array(joined(0), pa.int64()),
                pa.array(joined(1), pa.int64()),
            ],
            names=["item", "doc_id", "score"],
        )


def _search(
    batches: Iterator[pa.RecordBatch], n_docs: int, n_terms: int, k: int
) -> Iterator[pa.RecordBatch]:
    blocks: dict[int, _Best] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            tile = {c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "entries"}
            if tile["block"] not in blocks:
                blocks[tile["block"]] = _Best(batch.column("entries")[i].as_py())
            blocks[tile["block"]].add(tile, _impacts(tile, n_docs, n_terms), k)
    for block in blocks.values():
        yield block.batch()


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item, rank, doc_id, score``: the ``k`` best documents of each item; items as strings."""
    named = items.withColumn(item_id_col, F.col(item_id_col).cast("string"))
    asked = materialize(item_terms(named, item_id_col, item_text_col), "item-terms")
    tiles = materialize(pack_documents(docs, id_col, text_col), "document-tiles")
    n_docs, n_terms = (x or 0 for x in tiles.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    df = (
        tiles.select(F.inline(F.arrays_zip("terms", "df")))
        .join(asked.select(F.col("term").alias("terms")).distinct(), "terms", "left_semi")
        .groupBy(F.col("terms").alias("term"))
        .agg(F.sum("df").alias("df"))
    )
    weight = F.floor(1000 * F.log((F.lit(2.0 * n_docs + 2)) / (2 * F.col("df") + 1)))
    weighted = asked.join(df, "term").select(
        "item", "term", (F.col("times") * weight).alias("weight")
    )
    n_blocks = asked.count() // BLOCK_TERMS + 1
    blocks = materialize(
        weighted.groupBy(F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int").alias("block")).agg(
            F.collect_list(F.struct("item", "term", "weight")).alias("entries")
        ),
        "item-blocks",
    )
    at_once = max(1, BROADCAST_TERMS // BLOCK_TERMS)

    def found(first: int) -> DataFrame:
        numbers = F.sequence(F.lit(first), F.lit(min(first + at_once, n_blocks) - 1))
        some = blocks.where(F.col("block").between(first, first + at_once - 1))
        met = tiles.withColumn("block", F.explode(numbers)).join(F.broadcast(some), "block")
        return met.mapInArrow(
            lambda batches: _search(batches, n_docs, n_terms, k),
            "item string, doc_id bigint, score bigint",
        )

    everything = functools.reduce(
        DataFrame.union, [found(first) for first in range(0, n_blocks, at_once)]
    )

    def ranked(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "doc_id")
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    spread = everything.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    return ranked(ranked(spread, "item", "part").drop("rank", "part"), "item").select(
        "item", "rank", "doc_id", "score"
    )
