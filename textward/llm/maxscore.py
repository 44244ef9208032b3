"""Exact top-k by integer inner product, by MaxScore over blocks of vectors.

Vectors are documents and their dimensions are terms: the posting list of a term is its column in a
block of vectors. For a query, a term's bound is the most that it can contribute within the block.
Terms are ordered by their bounds; the last ones, whose bounds together stay below the k-th best
score so far, are non-essential. The postings of the essential terms are added up for the whole
block, and the other terms are probed, strongest first, only for vectors that can still reach the
k-th best score. Each shard (a block) yields its k best of each query, and the shards are merged.

Queries and vectors are packed into blocks of bounded size, and every block of queries meets every
block of vectors. All arithmetic is exact: in doubles while the sums stay below 2^53, else in
64-bit integers.

Defined results: rows without an id, or whose vector is null or holds a null or non-finite
component, take no part; of rows with one id the smallest vector counts; missing dimensions of
shorter vectors are 0; equal scores are ordered by id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textward.sources.store import materialize

BLOCK = 4096
QUERY_BLOCK = 1024
_STEP = 512
_PROBE = 8


def quantized(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component as ``array<bigint>``; null if one isn't a number."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(vector.isNotNull() & ~bad, whole)


_PACK = "block int, n int, dims int, ids binary, weights binary"


def _pack(vectors: DataFrame, blocks: int) -> DataFrame:
    """``id, weights`` -> rows of at most about ``BLOCK`` vectors each."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["id"].to_numpy())
        lists = rows["weights"].combine_chunks().to_pylist()
        dims = max(map(len, lists), default=0)
        matrix = np.zeros((len(lists), dims), np.int64)
        for i, at in enumerate(order.tolist()):
            matrix[i, : len(lists[at])] = lists[at]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int32()),
                "n": pa.array([len(lists)], pa.int32()),
                "dims": pa.array([dims], pa.int32()),
                "ids": pa.array([rows["id"].to_numpy()[order].astype(np.int64).tobytes()], pa.binary()),
                "weights": pa.array([matrix.tobytes()], pa.binary()),
            }
        )

    run.__annotations__ = {"key": tuple, "rows": pa.Table, "return": pa.Table}
    numbered = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return numbered.groupBy("block").applyInArrow(run, _PACK)


def best_of_block(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """``(query id, id, score)`` of each query's k best in the block; ``ids`` ascend."""
    dims = max(queries.shape[1], vectors.shape[1])
    widen = lambda m: np.pad(m, ((0, 0), (0, dims - m.shape[1])))
    queries, vectors = widen(queries), widen(vectors)
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * dims
    kind = np.float64 if most < 2.0**53 else np.int64
    columns = np.ascontiguousarray(vectors.T.astype(kind))
    high, low = columns.max(axis=1), columns.min(axis=1)
    found = []
    for query, query_id in zip(queries.astype(kind), query_ids.tolist()):
        bounds = np.maximum(query * high, query * low)
        order = np.argsort(-bounds, kind="stable")
        # What the terms from a place on can add at most.
        rest = np.r_[np.cumsum(bounds[order][::-1])[::-1], 0]
        best_ids, best = np.empty(0, np.int64), np.empty(0, kind)
        for lo in range(0, len(ids), _STEP):
            at = np.arange(lo, min(lo + _STEP, len(ids)))
            at = at[ids[at] != query_id]
            least = best[-1] if len(best) == k else None
            essential = dims
            if least is not None:
                below = np.flatnonzero(rest < least)
                essential = int(below[0]) if len(below) else dims
                if essential == 0:
                    break
            terms = order[:essential]
            score = query[terms] @ columns[np.ix_(terms, at)]
            for place in range(essential, dims, _PROBE):
                # A tie can't win: ids ascend, so what is held has the smaller id.
                alive = score + rest[place] > least
                at, score = at[alive], score[alive]
                if not len(at):
                    break
                terms = order[place : place + _PROBE]
                score = score + query[terms] @ columns[np.ix_(terms, at)]
            best_ids, best = np.r_[best_ids, ids[at]], np.r_[best, score]
            top = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[top], best[top]
        found += zip([query_id] * len(best), best_ids.tolist(), map(int, best.tolist()))
    return found


def _score_pairs(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    matrix = lambda raw, n, dims: np.frombuffer(raw, np.int64).reshape(n, dims)
    for batch in batches:
        for row in batch.to_pylist():
            found = best_of_block(
                matrix(row["q_weights"], row["q_n"], row["q_dims"]),
                np.frombuffer(row["q_ids"], np.int64),
                matrix(row["weights"], row["n"], row["dims"]),
                np.frombuffer(row["ids"], np.int64),
                k,
            )
            query_ids, ids, scores = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (query_ids, ids, scores)],
                names=["query_id", "id", "score"],
            )


def top_k(vectors: DataFrame, is_query: Column, *, k: int = 5) -> DataFrame:
    """``id, weights array<bigint>`` -> ``query_id, rank, id, score`` for the rows of ``is_query``.

    Candidates are all rows but the query's own.
    """
    known = materialize(
        vectors.where("id IS NOT NULL AND weights IS NOT NULL")
        .groupBy("id")
        .agg(F.min("weights").alias("weights")),
        "topk-vectors",
    )
    asked = known.where(is_query)
    n, n_asked = known.count(), asked.count()
    blocks = _pack(known, n // BLOCK + 1)
    questions = n_asked // QUERY_BLOCK + 1
    packed = _pack(asked, questions).toDF("q_block", "q_n", "q_dims", "q_ids", "q_weights")
    pairs = blocks.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(questions - 1)))).join(
        packed, "q_block"
    )
    # A pair is a unit of work of bounded size; it goes to any task.
    spread = pairs.repartition(F.xxhash64("block", "q_block"))
    found = spread.mapInArrow(
        lambda batches: _score_pairs(batches, k), "query_id bigint, id bigint, score bigint"
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
