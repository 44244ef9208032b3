"""Mixing sources to target weights, in DataFrame operations only.

Targets: sources in code point order (null last) get the weights in turn and share a budget of
``share`` times all sizes; a target stops at ``max_repeats`` times its source's size and the excess
goes to the others by weight, until none is above.

Draw: a document has a fixed place between 0 and 1, the hash of its id and the seed. A source is
taken as often as its target holds it whole; of the rest, documents are taken in the order of their
places as far as they fit, with documents above an eighth of the rest last, since one of them could
overshoot it. The end is found from the sizes of a fixed number of cells of each source and then
inside one cell, so that no task sees a whole source. The remaining gap is filled from one untaken
document of each size class (powers of two), largest first, and at last the smallest of them that
is left is taken if it brings the sum nearer.

Split: the target is cut into blocks of equal size, and a binary tree deals the sources' exact
block quotas to the output shards: at every node the left half draws its blocks without replacement
from the node's quotas (multivariate hypergeometric). Each shard then has its own run of every
source's block sequence; a document's copy goes to the shard that holds its block, and inside a
shard rows are ordered by a hash.

Defined results: a null size counts as 0, a null source is a source, null and repeated ids are rows
like others (rows with equal id and size share a place and are taken together where they mark the
end). Documents of size 0 are taken as often as their source is whole. With no words at all every
target is 0; an empty table stays empty. The number of sources is taken to be moderate (thousands):
their quotas are one array. Equal input and seed give equal results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textward.llm.common import join_on
from textward.sources.store import materialize

CELLS = 1024
BLOCKS = 8192
# An eighth of the rest that a source has to give.
LARGE = 8
_PLACES = 2**53


@dataclass(frozen=True)
class Mix:
    """``documents``: ``doc, size, source_size, target, copies``, where doc is a struct of the
    columns that were kept and copies is ``array<struct<shard int, key bigint>>``. ``sources``: what
    was decided for each source."""

    documents: DataFrame
    sources: DataFrame

    def rows(self) -> DataFrame:
        """One row per copy, ``doc, shard, shard_key``, by shard and, inside a shard, at random.

        The range exchange splits a shard over as many tasks as its size asks for.
        """
        copies = self.documents.select("doc", F.explode("copies").alias("copy"))
        return (
            copies.select("doc", "copy.shard", F.col("copy.key").alias("shard_key"))
            .repartitionByRange("shard", "shard_key")
            .sortWithinPartitions("shard", "shard_key")
        )


def _place(id_col: Column, size: Column, seed: int) -> Column:
    """A document's place as a whole number below 2^53."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, size), 11)


def targets(sizes: DataFrame, weights: Sequence[int], share: float, max_repeats: int) -> DataFrame:
    """``source, source_size`` -> those with ``idx, weight, target``."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("idx") % len(weights) + 1).cast("int")
    )
    named = (
        sizes.withColumn("idx", F.row_number().over(order) - 1)
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("most", F.col("source_size") * max_repeats)
    )
    # Sources reach their limit in the order of limit / weight. Behind each of them stands the level
    # at which the rest of the budget would be shared; the first level below its limit holds.
    ratio = F.col("most") / F.col("weight")
    by_limit = Window.orderBy(ratio, "idx")
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    stopped = F.coalesce(F.sum("most").over(before), F.lit(0))
    levels = named.withColumn("ratio", ratio).withColumn(
        "level", (budget - stopped) / F.sum("weight").over(onwards)
    )
    level = F.min(
        F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "idx", "level"))
    ).over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    shared = F.when(level.isNull(), F.col("most").cast("double")).otherwise(
        F.least(F.col("most").cast("double"), level["level"] * F.col("weight"))
    )
    return levels.withColumn("target", shared).select(
        "source", "source_size", "idx", "weight", "target"
    )


def _hypergeometric(white: str, both: str, drawn: str, uniform: str) -> str:
    """SQL for the number of white balls among ``drawn`` of ``both`` balls, by inversion.

    Probabilities are relative to the mode and summed outwards from it, up to ten deviations.
    """
    rise = "(x.w - k) * (x.d - k) / ((k + 1) * (x.b - x.w - x.d + k + 1))"
    fall = "k * (x.b - x.w - x.d + k) / ((x.w - k + 1) * (x.d - k + 1))"
    mode, high, low = (f"cast(x.{v} AS bigint)" for v in ("m", "hi", "lo"))
    none = "cast(array() AS array<bigint>)"
    ups = f"if(x.m < x.hi, sequence({mode}, {high} - 1), {none})"
    downs = f"if(x.m > x.lo, sequence({mode}, {low} + 1, -1L), {none})"

    def total(ks: str, ratio: str) -> str:
        return (
            f"aggregate({ks}, named_struct('p', 1D, 's', 0D), (a, k) -> "
            f"named_struct('p', a.p * ({ratio}), 's', a.s + a.p * ({ratio})), a -> a.s)"
        )

    def walk(ks: str, ratio: str, step: int, aim: str) -> str:
        return (
            f"aggregate({ks}, named_struct('p', 1D, 's', 0D, 'k', cast(null AS bigint)), "
            f"(a, k) -> named_struct('p', a.p * ({ratio}), 's', a.s + a.p * ({ratio}), "
            f"'k', if(a.k IS NULL AND a.s + a.p * ({ratio}) > {aim}, k + {step}L, a.k)), a -> a.k)"
        )

    def let(fields: dict[str, str], body: str) -> str:
        """``body`` with ``x.name`` for each field; the fields may use an outer ``x``."""
        struct = ", ".join(f"'{k}', cast({v} AS double)" for k, v in fields.items())
        return f"transform(array(named_struct({struct})), x -> {body})[0]"

    same = {k: f"x.{k}" for k in ("w", "b", "d", "u")}
    aim = "x.u * (1 + x.up + x.down)"
    chosen = (
        f"CASE WHEN {aim} < 1 THEN {mode} WHEN {aim} < 1 + x.up THEN "
        f"coalesce({walk(ups, rise, 1, f'{aim} - 1')}, {high}) ELSE "
        f"coalesce({walk(downs, fall, -1, f'{aim} - 1 - x.up')}, {low}) END"
    )
    reach = "ceil(10 * sqrt(greatest(x.d * (x.w / x.b) * (1 - x.w / x.b), 0D))) + 10"
    body = let(
        {"w": white, "b": both, "d": drawn, "u": uniform},
        let(
            same | {"m": "floor((x.d + 1) * (x.w + 1) / (x.b + 2))", "r": reach},
            let(
                same
                | {
                    "m": "x.m",
                    "lo": "greatest(0D, x.d - (x.b - x.w), x.m - x.r)",
                    "hi": "least(x.d, x.w, x.m + x.r)",
                },
                let(
                    same
                    | {k: f"x.{k}" for k in ("m", "lo", "hi")}
                    | {"up": total(ups, rise), "down": total(downs, fall)},
                    chosen,
                ),
            ),
        ),
    )
    return f"if({white} = 0 OR {drawn} = 0, 0L, {body})"


def _left_half(seed: int) -> str:
    """SQL for the left child's quotas, from ``quotas, first, shards, n_left``."""
    uniform = f"shiftrightunsigned(xxhash64({seed}, first, shards, z.i), 11) / {_PLACES}D"
    draw = _hypergeometric("z.q", "acc.rest", "acc.need", uniform)
    step = (
        f"(acc, z) -> transform(array({draw}), n -> named_struct('rest', acc.rest - z.q,"
        " 'need', acc.need - n, 'out', array_append(acc.out, n)))[0]"
    )
    start = (
        "named_struct('rest', aggregate(quotas, 0L, (s, q) -> s + q), 'need', n_left,"
        " 'out', cast(array() AS array<bigint>))"
    )
    zipped = "transform(quotas, (q, i) -> named_struct('q', q, 'i', i))"
    return f"aggregate({zipped}, {start}, {step}, acc -> acc.out)"


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """One row ``quotas array<bigint>`` -> a row ``shard, quotas`` for every shard.

    Shards get equally many blocks, up to rounding; every source's quotas add up to its own.
    """
    nodes = quotas.select(F.lit(0).alias("first"), F.lit(shards).alias("shards"), "quotas")
    width = shards
    while width > 1:
        width = (width + 1) // 2
        total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda s, q: s + q)
        half = F.floor(F.col("shards") / 2)
        sized = nodes.withColumn("n_left", F.floor(total * half / F.col("shards")))
        drawn = sized.withColumn("left", F.expr(_left_half(seed)))
        right = F.zip_with("quotas", "left", lambda q, taken: q - taken)
        children = F.when(
            F.col("shards") == 1, F.array(F.struct("first", "shards", "quotas"))
        ).otherwise(
            F.array(
                F.struct("first", half.cast("int").alias("shards"), F.col("left").alias("quotas")),
                F.struct(
                    (F.col("first") + half).cast("int").alias("first"),
                    (F.col("shards") - half).cast("int").alias("shards"),
                    right.alias("quotas"),
                ),
            )
        )
        nodes = drawn.select(F.inline(children))
    return nodes.select(F.col("first").alias("shard"), "quotas")


def _shard_ends(sources: DataFrame, blocks: int, shards: int, seed: int) -> DataFrame:
    """``idx`` -> ``quota, ends``: the block numbers at which each shard's run of a source ends."""
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    quota = F.ceil(F.col("target") * blocks / F.greatest(F.sum("target").over(whole), F.lit(1.0)))
    counted = sources.select("idx", quota.alias("quota"))
    row = counted.agg(F.array_sort(F.collect_list(F.struct("idx", "quota"))).alias("q")).select(
        F.transform("q", lambda q: q["quota"]).alias("quotas")
    )
    dealt = split_quotas(row, shards, seed).select("shard", F.posexplode("quotas").alias("idx", "n"))
    runs = dealt.groupBy("idx").agg(F.array_sort(F.collect_list(F.struct("shard", "n"))).alias("r"))
    upto = lambda i: F.aggregate(
        F.slice("r", 1, i), F.lit(0).cast("bigint"), lambda s, r: s + r["n"]
    )
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), upto)
    return runs.select("idx", F.element_at(ends, -1).alias("quota"), ends.alias("ends"))


def _rest(small: DataFrame, sources: DataFrame) -> DataFrame:
    """``source`` -> ``late, last, fill``: which documents the incomplete pass over it takes."""
    rest = sources.select(
        "source",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
    )
    docs = (
        join_on(small, rest, "source", "inner")
        .where("rest > 0")
        .withColumn("late", (F.col("size") * LARGE > F.col("rest")).cast("int"))
        .withColumn("cell", F.floor(F.col("place") / F.lit(_PLACES / CELLS)))
    )
    cells = docs.groupBy("source", "late", "cell").agg(
        F.sum("size").alias("words"), F.first("rest").alias("rest")
    )
    order = Window.partitionBy("source").orderBy("late", "cell")
    running = cells.withColumn("upto", F.sum("words").over(order)).where("upto > rest")
    # The first cell that doesn't fit whole.
    edge = running.groupBy("source").agg(
        F.min(F.struct("late", "cell", (F.col("upto") - F.col("words")).alias("base"))).alias("e")
    )
    edge = materialize(
        edge.select("source", "e.late", "e.cell", "e.base"), "mix-edge"
    )
    at_edge = join_on(
        docs, edge.select("source", F.struct("late", "cell", "base").alias("e")), "source", "inner"
    )
    inside = at_edge.where("late = e.late AND cell = e.cell")
    ranked = inside.withColumn(
        "upto",
        F.col("e.base")
        + F.sum("size").over(
            Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
        ),
    )
    fits = F.col("upto") <= F.col("rest")
    edges = materialize(
        ranked.groupBy("source").agg(
            F.first("e.late").alias("edge_late"),
            F.coalesce(
                F.max(F.when(fits, F.col("place"))),
                # None of the cell: the end is just before the cell.
                F.min(F.floor(F.col("cell") * F.lit(_PLACES / CELLS))) - 1,
            ).alias("edge"),
            (
                F.first("rest")
                - F.coalesce(F.max(F.when(fits, F.col("upto"))), F.first("e.base"))
            ).alias("gap"),
        ),
        "mix-edges",
    )
    untaken = join_on(docs, edges, "source", "inner").where(
        "size > 0 AND (late > edge_late OR (late = edge_late AND place > edge))"
    )
    offers = untaken.groupBy("source", F.floor(F.log2("size")).alias("size_class")).agg(
        F.min(F.struct("late", "place", "size")).alias("o")
    )
    listed = offers.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct("o.size", "o.place")), asc=False).alias("offers")
    )
    empty = F.array().cast("array<bigint>")
    filled = F.aggregate(
        "offers",
        F.struct(
            F.col("gap").alias("gap"), empty.alias("places"), F.lit(None).cast("bigint").alias("over"),
            F.lit(None).cast("bigint").alias("over_place"),
        ),
        lambda acc, o: F.when(
            o["size"] <= acc["gap"],
            F.struct(
                (acc["gap"] - o["size"]).alias("gap"),
                F.array_append(acc["places"], o["place"]).alias("places"),
                acc["over"].alias("over"),
                acc["over_place"].alias("over_place"),
            ),
        ).otherwise(
            F.struct(
                acc["gap"].alias("gap"),
                acc["places"].alias("places"),
                o["size"].alias("over"),
                o["place"].alias("over_place"),
            )
        ),
        lambda acc: F.when(
            (acc["over"] - acc["gap"]) < acc["gap"],
            F.array_append(acc["places"], acc["over_place"]),
        ).otherwise(acc["places"]),
    )
    return join_on(edges, listed, "source").select(
        "source",
        "edge_late",
        "edge",
        F.coalesce(filled, empty).alias("fill"),
    )


def mix(
    docs: DataFrame,
    size: Column,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_repeats: int = 2,
    shards: int = 16,
    seed: int = 42,
    keep: Sequence[str] = (),
) -> Mix:
    """Mix ``docs`` by ``size``; ``keep`` names more columns to carry in ``doc``."""
    sized = F.coalesce(size, F.lit(0)).cast("bigint")
    small = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), sized.alias("size"))
        .withColumn("place", _place(F.col("id"), F.col("size"), seed))
        .drop("id"),
        "mix-sizes",
    )
    sizes = small.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("int")
    sources = materialize(
        targets(sizes, weights, share, max_repeats).withColumn("whole", whole), "mix-targets"
    )
    ends = _shard_ends(sources, BLOCKS, shards, seed)
    # Read back as a table of known size: Spark broadcasts it below its threshold, else joins.
    decided = materialize(
        join_on(sources.join(ends, "idx"), _rest(small, sources), "source"), "mix-sources"
    )
    rows = docs.select(
        F.struct(*dict.fromkeys((id_col, source_col, *keep))).alias("doc"),
        F.col(source_col).alias("_source"),
        sized.alias("size"),
        _place(F.col(id_col), sized, seed).alias("_place"),
    )
    joined = join_on(rows, decided.withColumnRenamed("source", "_source"), "_source")
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    late = (F.col("size") * LARGE > rest).cast("int")
    taken = (rest > 0) & (
        (late < F.col("edge_late"))
        | ((late == F.col("edge_late")) & (F.col("_place") <= F.col("edge")))
        | F.array_contains("fill", F.col("_place"))
    )
    n = F.col("whole") + F.coalesce(taken, F.lit(False)).cast("int")
    per_pass = F.col("quota") * F.col("source_size") / F.greatest(F.col("target"), F.lit(1e-9))

    def copy(i: Column) -> Column:
        # The copy's block in the source's sequence, then the shard whose run holds that block.
        block = F.least(
            F.floor((i + F.col("_place") / F.lit(float(_PLACES))) * per_pass), F.col("quota") - 1
        )
        shard = F.size(F.filter("ends", lambda e: e <= block))
        key = F.xxhash64(F.lit(seed + 1), F.col("_place"), i)
        return F.struct(shard.alias("shard"), key.alias("key"))

    none = F.array().cast("array<struct<shard:int,key:bigint>>")
    documents = joined.withColumn(
        "copies",
        F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), copy)).otherwise(none),
    ).select("doc", "size", "source_size", "target", "copies")
    return Mix(documents, sources)
