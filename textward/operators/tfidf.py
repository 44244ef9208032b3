"""TF-IDF with sublinear tf, smoothed idf and unit-length rows, as a long (id, term, weight) table.

The fit counts the terms of many texts inside each task, the transform those of a row, so exactly one
shuffle of distinct terms serves either. The fitted vocabulary has at most ``max_features`` rows and is broadcast.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textward.functions.text import term_counts, tokens, word_ngrams
from textward.sources.store import materialize

# A vocabulary up to this size (some tens of MB) is sent to every task.
BROADCAST_TERMS = 500_000


def doc_terms(
    df: DataFrame, *, id_col: str, text_col: str = "text", ngrams: tuple[int, int] = (1, 2)
) -> DataFrame:
    """Distinct terms of each document with their count: ``id, term, tf``."""
    entry = F.explode(term_counts(word_ngrams(tokens(text_col), *ngrams)))
    return df.select(id_col, entry.alias("_e")).select(id_col, "_e.term", "_e.tf")


# Words that a task counts at once, a few hundred MB with their n-grams at most.
COUNTED_WORDS = 2_000_000


def _counted(words: list[pa.ListArray], sizes: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Terms of some texts' words with their frequencies, each term once."""
    rows = pa.chunked_array(words).combine_chunks()
    flat = rows.flatten()
    if not len(flat):
        return
    named = flat.dictionary_encode()
    names, code = named.dictionary, named.indices.to_numpy().astype(np.int64)
    lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
    text = np.repeat(np.arange(len(rows)), lengths)
    # A number for the n-gram that starts at each word, and a place of every number.
    gram, held = code, np.arange(len(code))
    for n in range(1, sizes[1] + 1):
        if n > 1:
            held = held[held + n - 1 < len(code)]
            held = held[text[held] == text[held + n - 1]]
            pair = gram[held] * len(names) + code[held + n - 1]
            numbers = np.unique(pair, return_inverse=True)[1]
            gram = np.zeros(len(code), np.int64)
            gram[held] = numbers
        if n < sizes[0] or not len(held):
            continue
        order = held[np.lexsort((text[held], gram[held]))]
        g, t = gram[order], text[order]
        starts = np.r_[0, (np.diff(g) != 0).nonzero()[0] + 1]
        fresh = np.r_[True, (np.diff(g) != 0) | (np.diff(t) != 0)]
        first = order[starts]
        term = names.take(pa.array(code[first]))
        for j in range(1, n):
            term = pc.binary_join_element_wise(term, names.take(pa.array(code[first + j])), " ")
        yield pa.record_batch(
            {
                "term": term,
                "tf": pa.array(np.diff(np.r_[starts, len(g)]), pa.int64()),
                "df": pa.array(np.add.reduceat(fresh.astype(np.int64), starts), pa.int64()),
            }
        )


def term_statistics(
    df: DataFrame, *, id_col: str, text_col: str = "text", ngrams: tuple[int, int] = (1, 2)
) -> DataFrame:
    """Corpus frequency and document frequency of every term: ``term, tf, df``.

    Each task counts the terms of many texts before they are shuffled; a row is a text.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = [], 0
        for batch in batches:
            words.append(batch.column(0))
            n += len(batch.column(0).flatten())
            if n >= COUNTED_WORDS:
                yield from _counted(words, ngrams)
                words, n = [], 0
        if words:
            yield from _counted(words, ngrams)

    counted = df.select(tokens(text_col).alias("words")).mapInArrow(
        count, "term string, tf bigint, df bigint"
    )
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


@dataclass(frozen=True)
class Tfidf:
    """Settings; ``fit`` returns the model, so an unfitted transform cannot be written."""

    max_features: int = 50_000
    ngrams: tuple[int, int] = (1, 2)
    min_df: int = 2

    def fit(self, df: DataFrame, *, id_col: str, text_col: str = "text") -> TfidfModel:
        stats = term_statistics(df, id_col=id_col, text_col=text_col, ngrams=self.ngrams)
        top = (
            stats.where(F.col("df") >= self.min_df)
            .orderBy(F.desc("tf"), "term")
            .limit(self.max_features)
        )
        n_docs = df.select(F.count("*")).scalar()
        # At most max_features rows, so the numbering may run in one task.
        index = (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1).cast("int")
        vocab = top.select(
            "term",
            index.alias("idx"),
            "tf",
            "df",
            (F.log((1 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"),
        )
        return TfidfModel(materialize(vocab, "vocabulary"), self.ngrams)


@dataclass(frozen=True)
class TfidfModel:
    vocab: DataFrame
    ngrams: tuple[int, int] = (1, 2)

    @functools.cached_property
    def size(self) -> int:
        return self.vocab.count()

    def _known(self, terms: DataFrame) -> DataFrame:
        """Terms of the vocabulary with their index and idf.

        In a vocabulary too large to send to every task, the most frequent terms still are: joined
        by a shuffle, each of them would bring a row from almost every text to one task.
        """
        vocab = self.vocab.select("term", "idx", "idf")
        if self.size <= BROADCAST_TERMS:
            return terms.join(F.broadcast(vocab), "term")
        top = self.vocab.orderBy(F.desc("df"), "idx").limit(BROADCAST_TERMS)
        frequent = F.broadcast(materialize(top.select("term", "idx", "idf"), "frequent-terms"))
        others = vocab.join(frequent.select("term"), "term", "left_anti")
        rare = terms.join(frequent.select("term"), "term", "left_anti").join(others, "term")
        return terms.join(frequent, "term").unionByName(rare)

    def weights(self, df: DataFrame, *, id_col: str, text_col: str = "text") -> DataFrame:
        """``id, term, idx, weight``; terms outside the vocabulary are ignored."""
        raw = (1 + F.log(F.col("tf").cast("double"))) * F.col("idf")
        norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(id_col)))
        return (
            self._known(doc_terms(df, id_col=id_col, text_col=text_col, ngrams=self.ngrams))
            .select(id_col, "term", "idx", raw.alias("_w"))
            .select(id_col, "term", "idx", (F.col("_w") / norm).alias("weight"))
        )

    def vectors(
        self, df: DataFrame, *, id_col: str, text_col: str = "text", out_col: str = "features"
    ) -> DataFrame:
        """``df`` plus a sparse vector column; a text without known terms gets a zero vector."""
        return sparse_vectors(
            df, self.weights(df, id_col=id_col, text_col=text_col), self.size, id_col, out_col
        )

    def save(self, path: str) -> None:
        lo, hi = self.ngrams
        self.vocab.withColumns({"min_n": F.lit(lo), "max_n": F.lit(hi)}).write.mode(
            "overwrite"
        ).parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TfidfModel:
        saved = spark.read.parquet(path)
        sizes = saved.select("min_n", "max_n").first()
        ngrams = (sizes["min_n"], sizes["max_n"]) if sizes else (1, 2)
        return TfidfModel(saved.drop("min_n", "max_n"), ngrams)


def sparse_vectors(
    df: DataFrame, weights: DataFrame, size: int, id_col: str, out_col: str = "features"
) -> DataFrame:
    """Turn ``id, idx, weight`` rows into one Spark ML sparse vector per row of ``df``.

    The vector is built from its struct form by the JSON reader, which stays inside the JVM.
    """
    entries = F.array_sort(F.collect_list(F.struct("idx", "weight")))
    packed = weights.groupBy(id_col).agg(entries.alias("_e"))
    none = F.array().cast("array<struct<idx:int,weight:double>>")
    e = F.coalesce(F.col("_e"), none)
    layout = F.struct(
        F.struct(
            F.lit(0).cast("byte").alias("type"),
            F.lit(size).alias("size"),
            F.transform(e, lambda x: x["idx"]).alias("indices"),
            F.transform(e, lambda x: x["weight"]).alias("values"),
        ).alias("v")
    )
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return (
        df.join(packed, id_col, "left")
        .withColumn(out_col, F.from_json(F.to_json(layout), schema)["v"])
        .drop("_e")
    )
