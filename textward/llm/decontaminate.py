"""Benchmark decontamination by a broadcast hash set of normalised word windows.

A window is ``length`` consecutive words of a benchmark item, or all words of a shorter item. The
windows' hashes are broadcast, each document's windows are looked up in them, and a hit counts if
the words themselves are equal. Hits are found inside the task that reads the document: what is
shuffled are the places of true hits, reduced per task, so a passage that a third of all documents
share makes no hot key.

The benchmark is broadcast in blocks of at most about ``BLOCK_BYTES`` of window text. A larger
benchmark takes more blocks, each looked up in all documents; the results are the same. Built-in
expressions only.

Defined results: a null or empty text has no words and no hits; a null item id still marks words but
is no item; rows with one item id are one item; repeated documents get equal results; columns of the
documents are carried in a struct, so any names are allowed; an empty benchmark marks nothing.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textward.llm.common import ascii_lower, let
from textward.sources.store import materialize

# After lower-casing A-Z these are runs of digits, a-z and all that isn't ASCII.
WORD_LETTERS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
OTHER_LETTERS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
BLOCK_BYTES = 16 << 20


def _split(text: Column) -> Column:
    return F.array_remove(F.split(text, OTHER_LETTERS + "+", -1), "")


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none if it is null."""
    return F.coalesce(_split(ascii_lower(text)), F.array().cast("array<string>"))


def _windows(split: DataFrame, sizes: list[int]) -> DataFrame:
    """A row per window of the words ``w``, with ``start`` (from 1), ``size`` and ``hash``.

    Explodes places only: windows are cut and hashed in compiled code, not in lambdas.
    """
    size = F.lit(sizes[0]) if len(sizes) == 1 else F.explode(F.lit(sizes).cast("array<int>"))
    # The outer form, as the plain one would split the text a second time to filter empty arrays.
    return (
        split.select("*", F.posexplode_outer("w").alias("start", "_word"))
        .drop("_word")
        .withColumn("start", F.col("start") + 1)
        .withColumn("size", size)
        .where(F.col("start") + F.col("size") - 1 <= F.size("w"))
        .withColumn("hash", F.xxhash64(F.slice("w", F.col("start"), F.col("size"))))
    )


def item_windows(items: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """``block, size, hash, gram, items``: each window once a block, with the items that hold it."""
    split = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w"))
    whole = F.least(F.size("w"), F.lit(length))
    places = split.select("item", "w", whole.alias("size"), F.posexplode("w").alias("start", "word"))
    gram = F.slice("w", F.col("start") + 1, F.col("size"))
    grams = materialize(
        places.where(F.col("start") + F.col("size") <= F.size("w"))
        .select("item", "size", gram.alias("gram"))
        .distinct()
        .withColumn("hash", F.xxhash64("gram")),
        "item-windows",
    )
    held = F.octet_length(F.array_join("gram", " ")) + F.octet_length(
        F.coalesce(F.col("item").cast("string"), F.lit(""))
    )
    total = grams.agg(F.sum(held)).first()[0] or 0
    block = F.pmod(F.xxhash64("hash", "item"), F.lit(total // BLOCK_BYTES + 1)).cast("int")
    return materialize(
        grams.groupBy(block.alias("block"), "size", "hash", "gram").agg(
            F.collect_set("item").alias("items")
        ),
        "item-window-blocks",
    )


def _covered(hits: Column) -> Column:
    """Positions, ascending from 1, that the hits ``struct<start, size>`` cover."""
    each = F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["size"] - 1))
    return F.array_sort(F.array_distinct(F.flatten(each)))


def _runs(places: Column) -> Column:
    """``array<struct<start, size>>`` of the runs of neighbours among ascending places."""

    def runs(at: Column) -> Column:
        firsts = F.filter(at, lambda p, i: (i == 0) | (F.get(at, i - 1) != p - 1))
        lasts = F.filter(at, lambda p, i: F.coalesce(F.get(at, i + 1) != p + 1, F.lit(True)))
        return F.zip_with(
            firsts,
            lasts,
            lambda first, last: F.struct(first.alias("start"), (last - first + 1).alias("size")),
        )

    return let(places, runs)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    length: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document ``doc`` (its row), ``n_words, n_hit, items, spans``.

    ``items`` are the ids, ascending as strings, of the items with a window in the document;
    ``spans`` the runs of hit words (``start`` from 1). ``without_spans`` removes these, a filter on
    ``n_hit`` the documents.
    """
    grams = item_windows(items, length, item_id_col, item_text_col)
    sizes = sorted(r["size"] for r in grams.select("size").distinct().collect())
    n_blocks = (grams.agg(F.max("block")).first()[0] or 0) + 1
    # Names the document: equal for repeated rows only.
    key = F.md5(
        F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    )
    split = docs.where(F.col(text_col).isNotNull()).select(
        key.alias("key"), words(F.col(text_col)).alias("w")
    )
    looked_up = _windows(split, sizes or [length])

    def hits(block: int) -> DataFrame:
        wanted = grams.where(F.col("block") == block).select(
            F.col("hash").alias("_hash"), "gram", "items"
        )
        # Equality in two halves, so that the words don't become a second key of the hash table.
        own = F.slice("w", F.col("start"), F.col("size"))
        return (
            looked_up.join(F.broadcast(wanted), F.col("hash") == F.col("_hash"))
            .where((own >= F.col("gram")) & (own <= F.col("gram")))
            .select("key", "start", "size", "items")
        )

    found = (
        functools.reduce(DataFrame.union, [hits(b) for b in range(n_blocks)])
        .groupBy("key")
        .agg(
            F.collect_set(F.struct("start", "size")).alias("hits"),
            F.collect_set("items").alias("items"),
        )
        .select(
            F.col("key").alias("_other"),
            _covered(F.col("hits")).alias("places"),
            F.array_sort(
                F.transform(F.array_distinct(F.flatten("items")), lambda i: i.cast("string"))
            ).alias("items"),
        )
    )
    n_words = F.coalesce(F.size(_split(F.col(text_col))), F.lit(0))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        key.alias("_key"),
        n_words.cast("bigint").alias("n_words"),
    )
    joined = rows.join(found, F.col("_key") == F.col("_other"), "left")
    runs = "array<struct<start:int,size:int>>"
    return joined.select(
        "doc",
        "n_words",
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(_runs(F.col("places")), F.array().cast(runs)).alias("spans"),
    )


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words of ``spans`` and the separators behind each of them."""
    head = F.regexp_extract(text, rf"\A{OTHER_LETTERS}*", 0)
    pieces = F.regexp_extract_all(text, F.lit(f"{WORD_LETTERS}+{OTHER_LETTERS}*"), F.lit(0))

    def rest(tokens: Column) -> Column:
        # Kept parts begin where a span ends, the first one at the top.
        borders = F.concat(F.array(F.struct(F.lit(1).alias("start"), F.lit(0).alias("size"))), spans)
        parts = F.transform(
            borders,
            lambda b, i: F.slice(
                tokens,
                b["start"] + b["size"],
                F.coalesce(F.get(spans, i)["start"], F.size(tokens) + 1) - b["start"] - b["size"],
            ),
        )
        return F.array_join(F.flatten(parts), "")

    return F.when(F.size(spans) == 0, text).otherwise(F.concat(head, let(pieces, rest)))
