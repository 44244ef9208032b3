"""How the sources of a language differ in their terms, by chunk factorization.

A term never goes over white space, so a text's white-space chunks hold all its terms. A worker
counts the chunks of each document, tokenizes each distinct one once, however often it occurs, and
joins the terms back to the documents' counts. Only occurrences and documents per source and term are
shuffled, never documents or words, so a very frequent word is one row per source and
``HELD_CHUNKS`` counted chunks. A document is counted in one place only, so a term's documents add up.

A source's share of a term is ``1 + 10^9 (count + 1) div (N + V)``. Two shares differ by
``(p - q)^2 div q``; summed over all terms that compares two sources, and for one term it shows what
a source has more of than its language. Pairs of sources are compared in blocks of terms, dense, with
the share of a count of 0 for the terms that a source lacks. All is 64-bit integer arithmetic,
products that could be larger are decimals. A sum over terms is at most about (sum p)^2, so it
stays below 2^63 for vocabularies of up to 10^9 terms.

Defined results: null texts, languages and sources count as empty strings; every row is a document,
repeated ones too, whatever its id; a source without terms is compared by its shares of count 0; a
language without kept terms has pairs of value 0 and no terms; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textward.sources.store import materialize

# Terms are runs of these bytes, once A-Z are lower-cased: of letters and of all beyond ASCII.
_TERM_BYTES = bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
# What is no term's is a blank; the line feed stays, which stands between chunks.
_LOWERED = bytes(b if b in _TERM_BYTES + b"\n" else 0x20 for b in bytes(range(256)).lower())
LEAST_DOCS = 3
SCALE = 10**9
TOP_TERMS = 200
# Chunks of documents that a worker counts before it passes the counts on.
HELD_CHUNKS = 2_000_000
# What a source takes beside its chunks, in chunks.
_GROUP_SIZE = 16
# Terms of a block, sources of a tile, and cells computed at once.
BLOCK_TERMS = 4096
TILE_SOURCES = 256
STEP_CELLS = 1 << 20

_COUNTS = "lang string, source string, term binary, n bigint, df bigint"


class _Held:
    """Chunk counts of the documents seen so far: an entry per document and distinct chunk."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.slots: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.group, self.distinct = array("q"), array("q")
        self.slot, self.n = array("q"), array("q")
        self.size = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        name = (lang, source)
        if name not in self.groups:
            self.groups[name] = len(self.groups)
            self.size += _GROUP_SIZE
        # bytes.split goes by the blank and the five ASCII control spaces.
        counted = Counter(text.split())
        self.group.append(self.groups[name])
        self.distinct.append(len(counted))
        self.slot.extend(map(self.slots.__getitem__, counted))
        self.n.extend(counted.values())
        self.size += len(counted) + 1

    def _terms(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct terms, those of all chunks one after the other, and how many each chunk has."""
        numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        parts = [x.split() for x in b"\n".join(self.slots).translate(_LOWERED).split(b"\n")]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        of = np.fromiter(map(numbers.__getitem__, chain.from_iterable(parts)), np.int64, sizes.sum())
        return list(numbers), of, sizes

    def batch(self) -> pa.RecordBatch:
        """A row per group and term."""
        terms, of, sizes = self._terms()
        group, slot = np.asarray(self.group), np.asarray(self.slot)
        # Documents by group, so that those of a term's sources are next to each other.
        order = np.argsort(group, kind="stable")
        group, n_docs = group[order], len(order)
        place = np.empty(n_docs, np.int64)
        place[order] = np.arange(n_docs)
        # The terms of each entry's chunk. A term that a chunk holds twice is there twice.
        held = sizes[slot]
        within = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        key = of[np.repeat((np.cumsum(sizes) - sizes)[slot], held) + within]
        key = key * n_docs + np.repeat(np.repeat(place, np.asarray(self.distinct)), held)
        order = np.argsort(key)
        key, n = key[order], np.repeat(np.asarray(self.n), held)[order]
        term, of_group = key // n_docs, group[key % n_docs]
        first = np.ones(len(key), bool)
        first[1:] = (term[1:] != term[:-1]) | (of_group[1:] != of_group[:-1])
        document = np.ones(len(key), np.int64)
        document[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(first)
        add = lambda values: np.add.reduceat(values, starts) if len(starts) else values
        name = pa.array(of_group[starts])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g[0] for g in self.groups], pa.string()).take(name),
                pa.array([g[1] for g in self.groups], pa.string()).take(name),
                pa.array(terms, pa.binary()).take(pa.array(term[starts])),
                pa.array(add(n), pa.int64()),
                pa.array(add(document), pa.int64()),
            ],
            names=["lang", "source", "term", "n", "df"],
        )


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Held()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lang", "source", "text")]
        for lang, source, text in zip(*columns):
            held.add(lang, source, text)
            if held.size >= HELD_CHUNKS:
                yield held.batch()
                held = _Held()
    if held.groups:
        yield held.batch()


def _named(docs: DataFrame) -> DataFrame:
    """``lang, source, text`` without nulls."""
    empty = F.lit("")
    return docs.select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")])


def kept_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, count, total, leads`` of the terms in at least ``LEAST_DOCS`` documents.

    ``total`` counts the term's occurrences in the language; one source of each term leads.
    """
    of_term = Window.partitionBy("lang", "term")
    read = _named(docs).withColumn("text", F.col("text").cast("binary"))
    # By language and term, so that all sources of a term meet. Workers have counted already;
    # reducing their rows once more before the shuffle would find few equal ones.
    return (
        read.mapInArrow(_count_terms, _COUNTS)
        .repartition("lang", "term")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("count"), F.sum("df").alias("df"))
        .withColumns(
            {
                "n_docs": F.sum("df").over(of_term),
                "total": F.sum("count").over(of_term),
                "leads": F.col("source") == F.min("source").over(of_term),
            }
        )
        .where(F.col("n_docs") >= LEAST_DOCS)
        .select("lang", "source", F.col("term").cast("string").alias("term"), "count", "total", "leads")
    )


def _share(count: Column | str, n: str, v: str) -> Column:
    """``1 + SCALE * (count + 1) div (n + v)``, exact."""
    wide = lambda c: c.cast("decimal(19,0)")
    product = F.lit(SCALE).cast("decimal(10,0)") * wide(count + 1)
    of = wide(F.col(n) + F.col(v))
    # The whole part of a decimal quotient is taken by div, which has no function of its own.
    return F.lit(1) + F.call_function("div", product, of)


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


_PAIRS = "lang string, source string, item string, value bigint"


def _compare(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums over a block's terms, of the tile's sources against all sources of the language.

    Rows without a term name the sources, with the share of a count of 0 and whether the source is
    the tile's.
    """
    named = pc.is_null(rows["term"])
    listed = rows.filter(named).sort_by("source")
    names = listed["source"].to_pylist()
    zero = listed["share"].to_numpy()
    left = np.flatnonzero(listed["mine"].to_numpy()).tolist()
    held = rows.filter(pc.invert(named))
    terms = held["term"].combine_chunks().dictionary_encode()
    row = pc.index_in(held["source"], listed["source"].combine_chunks()).to_numpy()
    order = np.argsort(terms.indices.to_numpy(), kind="stable")
    row, column = row[order], terms.indices.to_numpy()[order]
    value, n_terms = held["share"].to_numpy()[order], len(terms.dictionary)
    sums = np.zeros((len(left), len(names)), np.int64)
    step = max(1, STEP_CELLS // max(1, len(names)))
    for lo in range(0, n_terms, step):
        hi = min(lo + step, n_terms)
        a, b = np.searchsorted(column, [lo, hi])
        shares = np.repeat(zero[:, None], hi - lo, axis=1)
        shares[row[a:b], column[a:b] - lo] = value[a:b]
        for i, s in enumerate(left):
            gap = shares[s] - shares
            sums[i] += (gap * gap // shares).sum(axis=1)
    pairs = [(i, j) for i, s in enumerate(left) for j in range(len(names)) if j != s]
    return pa.table(
        {
            "lang": pa.array([key[0].as_py()] * len(pairs), pa.string()),
            "source": pa.array([names[left[i]] for i, _ in pairs], pa.string()),
            "item": pa.array([names[j] for _, j in pairs], pa.string()),
            "value": pa.array([int(sums[i, j]) for i, j in pairs], pa.int64()),
        }
    )


_compare.__annotations__ = {"key": tuple, "rows": pa.Table, "return": pa.Table}


def _pair_values(cells: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for each source and each other one of its language."""
    sized = langs.select(
        "lang",
        F.expr(f"v div {BLOCK_TERMS} + 1").alias("blocks"),
        F.expr(f"n_sources div {TILE_SOURCES} + 1").alias("tiles"),
    )
    tiles = F.explode(F.sequence(F.lit(0), F.col("tiles").cast("int") - 1))
    tile_of = F.pmod(F.xxhash64("source"), F.col("tiles"))
    listed = (
        groups.join(sized, "lang")
        .withColumn("tile", tiles)
        .select(
            "lang",
            "tile",
            F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("block"),
            F.lit(None).cast("string").alias("term"),
            "source",
            F.col("base").alias("share"),
            (tile_of == F.col("tile")).alias("mine"),
        )
    )
    dealt = (
        cells.join(sized, "lang")
        .withColumn("tile", tiles)
        .select(
            "lang",
            "tile",
            F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"),
            "term",
            "source",
            F.col("p").alias("share"),
            F.lit(False).alias("mine"),
        )
    )
    return (
        listed.unionByName(dealt)
        .groupBy("lang", "block", "tile")
        .applyInArrow(_compare, _PAIRS)
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def divergence(docs: DataFrame, *, top_terms: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for the sources of each language.

    Part ``pair``: ``item`` is another source of the language, all ranks. Part ``term``: ``item`` is
    a term that the source has more of than its language, ranks to ``top_terms``.
    """
    occurring = materialize(kept_counts(docs), "source-terms")
    sources = _named(docs).select("lang", "source").distinct()
    vocabulary = occurring.where("leads").groupBy("lang").agg(F.count("*").alias("v"))
    totals = occurring.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    zero = F.lit(0).cast("bigint")
    groups = materialize(
        sources.join(totals, ["lang", "source"], "left")
        .join(vocabulary, "lang", "left")
        .select("lang", "source", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v"))
        .withColumn("base", F.when(F.col("v") > 0, _share(zero, "n", "v")).otherwise(F.lit(1))),
        "sources",
    )
    langs = materialize(
        groups.groupBy("lang").agg(
            F.sum("n").alias("n"), F.first("v").alias("v"), F.count("*").alias("n_sources")
        ),
        "languages",
    )
    cells = materialize(
        occurring.join(groups, ["lang", "source"])
        .join(langs.select("lang", F.col("n").alias("n_lang")), "lang")
        .select(
            "lang",
            "source",
            "term",
            _share(F.col("count"), "n", "v").alias("p"),
            _share(F.col("total"), "n_lang", "v").alias("q"),
        ),
        "source-shares",
    )
    ranked = lambda rows: rows.withColumn(
        "rank",
        F.row_number().over(
            Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        ),
    )
    terms = ranked(
        cells.where("p > q").select("lang", "source", F.col("term").alias("item"), _distance(F.col("p"), F.col("q")).alias("value"))
    ).where(F.col("rank") <= top_terms)
    pairs = ranked(_pair_values(cells, groups, langs))
    named = lambda rows, part: rows.select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
    )
    return named(pairs, "pair").unionByName(named(terms, "term"))
