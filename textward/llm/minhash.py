"""Near-duplicates by bottom-k sketches of one hash function, verified on the full sets.

A document's set is its distinct shingles of words, each one a 64-bit hash. Its sketch retains the
smallest hashes. Inverted lists are kept for runs of neighbouring retained values: where
two sets agree on r neighbours of their union, they share a list. For a similarity of t the shared
values of a union outnumber the others by t / (1 - t), so with r below that number sets that fit
into a sketch always share a run; the few smallest sets, for which that needs shorter runs, list
their single values too. For larger sets the sketch is a sample of the union: at t = 0.8 and r = 3,
64 values without a shared run have a probability of 1e-12. Runs of three keep documents that only
share common phrases out of one list.

Lists are never expanded into pairs. A list's hub is its smallest member. First every
document is compared with one hub, the one with which it shares the most lists. Documents that are linked by then form components, and a list
whose members are all in one component is done. Each other list belongs to its largest component;
the members of all other components in the lists of that one meet its members and each other. So
every two documents that share a list and aren't connected yet are compared. A list that still has
more than ``WIDE`` components then holds a passage that many different documents quote; comparing
all of them would grow with the square of their number. Its documents get a second kind of lists in
its place, the bands of a MinHash signature, which two documents share as surely if they meet t, but
hardly ever if they have only a passage in common. What a comparison is:
an estimate of the similarity from the sketch of the union (the values up to which both sketches are
complete) removes clear misses (as far below t as a pair that meets t comes with a probability
below 2^-64), the rest is decided on the full sets. Equal sets are one node from the start.

The documents of such a meeting are cut into blocks of bounded size, and a block pair is one unit of
work, so a group of copies of any size is spread over the cluster; no two blocks meet twice. Where the
visitors are more than a block, the documents of each block meet among themselves first: near copies
of one text then are few components, and those left outside the largest one meet the others. Else
each pair of blocks would find links of its own between the same components, and their number would
grow with the square of the copies. Units receive packed words, which take a third of the space of
the hashes, and tell which components they join.

Defined results: an empty set (a null, empty or blank text) links with nothing; repeated rows have
equal sets and are linked; a null id is never a component's id unless it has no other, so null ids
with an empty set form no component; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textward.llm.common import connected, join_skewed
from textward.sources.store import materialize, materialize_by, temporary

# Probability at most that a pair that meets the threshold shares no list.
MISS = 2.0**-40
# The longest runs that are listed, and the smallest sketch.
RUN = 3
SKETCH = 64
# Values of each set that the similarity is estimated from, and the margin below t: Chernoff's bound
# of a mean of 256 draws that far below t is under 2^-64 for every t.
ESTIMATE = 256
SAFE = 0.3
BLOCK = 256
# Components of a list above which its documents get bands, at most BANDS of them as long as the
# threshold allows it. Bands cost a document about as much time as comparing it with a thousand
# others; with twice BLOCK here, check_l's 68 722 documents in such lists doubled the job's CPU time.
WIDE = 16 * BLOCK
BANDS = 250
BAND_ROWS = 10


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], length: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words are one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(length, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : len(hashes) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def run_length(t: Fraction) -> tuple[int, int]:
    """Length of the runs that are listed, and the largest union that may share only shorter ones."""
    length = min(max(1, math.ceil(t / (1 - t)) - 1), RUN) if t < 1 else RUN
    # A union of u values has u - c others at most, which cut the c shared ones into runs.
    shared = {u: math.ceil(t * u) for u in range(1, 1000)}
    short = [u for u, c in shared.items() if math.ceil(Fraction(c, u - c + 1)) < length]
    return length, max(short, default=0)


def sketch_size(t: Fraction, length: int) -> int:
    """Values of which a share of ``t`` is without a run of ``length`` as rarely as ``MISS``."""
    p, size = float(t), 0
    # The chance of no run so far, by the length of the last one.
    ends = [1.0] + [0.0] * (length - 1)
    while sum(ends) > MISS:
        ends = [(1 - p) * sum(ends), *(p * x for x in ends[:-1])]
        size += 1
    return max(size, SKETCH)


def list_keys(values: np.ndarray, length: int, small: int, size: int = SKETCH) -> np.ndarray:
    """Names of the lists of a set, given its sorted hashes."""
    sketch = values[:size]
    keys = np.full(max(len(sketch) - length + 1, 0), length, np.uint64)
    for i in range(length):
        keys = (keys ^ sketch[i : i + len(keys)]) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
    return np.unique(np.r_[keys, sketch]) if len(values) <= small else np.unique(keys)


def band_shape(t: Fraction) -> tuple[int, int]:
    """Bands, and values in each, that a pair of similarity ``t`` misses as rarely as ``MISS``."""

    def bands(rows: int) -> int:
        return math.ceil(math.log(MISS) / math.log1p(-(float(t) ** rows))) if t < 1 else 1

    rows = next((r for r in range(BAND_ROWS, 1, -1) if bands(r) <= BANDS), 1)
    return bands(rows), rows


@functools.cache
def _orders(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Salts and odd factors that put hashes into ``n`` orders."""
    salts, odd = np.random.RandomState(1).randint(0, 2**64, (2, n), np.uint64)
    return salts, odd | np.uint64(1)


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Names of the bands of a set that isn't empty: the smallest of its values in several orders."""
    salts, odd = _orders(bands * rows)
    least = np.full(bands * rows, 2**64 - 1, np.uint64)
    for at in range(0, len(values), BLOCK):
        ordered = (values[at : at + BLOCK, None] ^ salts) * odd
        np.minimum(least, ordered.min(axis=0), out=least)
    keys = np.arange(bands, dtype=np.uint64)
    for low in least.reshape(bands, rows).T:
        keys = (keys ^ low) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(32)
    return keys


def _banded(packed: Column, shingle: int, t: Fraction) -> Column:
    """The bands of packed words."""
    bands, rows = band_shape(t)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            keys = [
                band_keys(shingles(zlib.decompress(x).split(), shingle), bands, rows).view(np.int64)
                for x in column.to_pylist()
            ]
            yield pa.array(keys, pa.list_(pa.int64()))

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<bigint>")(packed)


def _node(values: np.ndarray) -> int | None:
    """Fingerprint of a set, as a signed number."""
    if not len(values):
        return None
    return int.from_bytes(hashlib.sha256(values.tobytes()).digest()[:8], "big", signed=True)


_SKETCHED = "struct<node:bigint,n_shingles:bigint,keys:array<bigint>,packed:binary>"


def _sketched(text: Column, shingle: int, t: Fraction) -> Column:
    """A text's set's name (null if empty) and size, its lists, and its words, packed."""
    length, small = run_length(t)
    size = sketch_size(t, length)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            nodes, sizes, keys, packed = [], [], [], []
            for text in column.to_pylist():
                words = _words(text)
                values = shingles(words, shingle)
                nodes.append(_node(values))
                sizes.append(len(values))
                keys.append(list_keys(values, length, small, size).view(np.int64))
                packed.append(zlib.compress(b" ".join(words), 1))
            yield pa.StructArray.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(packed, pa.binary()),
                ],
                names=["node", "n_shingles", "keys", "packed"],
            )

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, _SKETCHED)(text)


class _Inverted:
    """Sets as one sorted list of values, each with its set."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.values, self.owner = values[order], owner[order]

    def shared(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each value that ``asked`` has in common with a set, and that set."""
        lo = np.searchsorted(self.values, asked, "left")
        n = np.searchsorted(self.values, asked, "right") - lo
        hits = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.values[hits], self.owner[hits]


class _Sketches:
    """The smallest values of sets, to estimate their similarity to others from union sketches."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        sketches = [s[:ESTIMATE] for s in sets]
        self.index = _Inverted(sketches)
        # Up to its reach a sketch holds all values of its set.
        self.reach = np.array([_reach(s) for s in sets], np.uint64)
        self.sketches = sketches

    def estimate(self, other: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Similarity to the sets at ``of``, over the values that both sketches reach."""
        sketch = other[:ESTIMATE]
        reach = np.minimum(self.reach, _reach(other))
        values, owner = self.index.shared(sketch)
        both = np.bincount(owner[values <= reach[owner]], minlength=len(reach))[of]
        mine = np.searchsorted(sketch, reach[of], "right")
        theirs = [np.searchsorted(self.sketches[h], reach[h], "right") for h in of.tolist()]
        return both / (mine + np.array(theirs) - both)


def _reach(values: np.ndarray) -> np.uint64:
    return values[ESTIMATE - 1] if len(values) > ESTIMATE else np.uint64(2**64 - 1)


def links_of_unit(
    hubs: list[np.ndarray],
    hub_roots: np.ndarray,
    visitors: list[np.ndarray],
    visitor_roots: np.ndarray,
    threshold: Fraction,
) -> list[tuple[int, int]]:
    """``(visitor, hub)`` places of links that join all components that are linked in this unit.

    A link between components that earlier ones have joined is not listed again.
    """
    joined: dict[int, int] = {}

    def root_of(x: int) -> int:
        while x in joined:
            x = joined[x]
        return x

    index, sketches = _Inverted(hubs), _Sketches(hubs)
    sizes = index.sizes
    num, den = threshold.numerator, threshold.denominator
    found = []
    for i, visitor in enumerate(visitors):
        n = len(visitor)
        near = (den * np.minimum(sizes, n) >= num * np.maximum(sizes, n)) & (
            hub_roots != visitor_roots[i]
        )
        of = near.nonzero()[0]
        if not len(of):
            continue
        near[of] = sketches.estimate(visitor, of) >= float(threshold) - SAFE
        if not near.any():
            continue
        both = np.bincount(index.shared(visitor)[1], minlength=len(hubs))
        linked = (near & (den * both >= num * (sizes + n - both))).nonzero()[0]
        others, firsts = np.unique(hub_roots[linked], return_index=True)
        for other, first in zip(others.tolist(), firsts.tolist()):
            a, b = root_of(other), root_of(int(visitor_roots[i]))
            if a != b:
                joined[a] = b
                found.append((i, int(linked[first])))
    return found


_UNIT = ["unit", "p", "q", "met", "visits", "node", "root"]


def _verified(units: DataFrame, texts: DataFrame, length: int, t: Fraction) -> DataFrame:
    """Pairs ``a, b`` of components that a link joins, as many as connect those of each unit."""

    def run(rows: pa.Table) -> pa.Table:
        sets = [shingles(zlib.decompress(x).split(), length) for x in rows["packed"].to_pylist()]
        roots = rows["root"].to_numpy()
        hubs, visitors = (np.flatnonzero(rows[side].to_numpy()) for side in ("met", "visits"))
        found = []
        if len(hubs) and len(visitors):
            found = links_of_unit(
                [sets[i] for i in hubs], roots[hubs], [sets[i] for i in visitors], roots[visitors], t
            )
        return pa.table(
            {
                "a": pa.array([roots[visitors[i]] for i, _ in found], pa.int64()),
                "b": pa.array([roots[hubs[j]] for _, j in found], pa.int64()),
            }
        )

    run.__annotations__ = {"rows": pa.Table, "return": pa.Table}
    return (
        units.join(texts.select("node", "packed"), "node")
        .groupBy("unit", "p", "q")
        .applyInArrow(run, "a bigint, b bigint")
    )


def _sizes(own: DataFrame, visitors: DataFrame) -> DataFrame:
    """``unit, n, m``: the own documents and the visitors of each unit that has both."""
    return materialize(
        own.groupBy("unit")
        .agg(F.count("*").alias("n"))
        .join(visitors.groupBy("unit").agg(F.count("*").alias("m")), "unit"),
        "near-units",
    )


def _units(own: DataFrame, visitors: DataFrame, sizes: DataFrame, among: bool) -> DataFrame:
    """``unit, node, root`` of a unit's own documents and of its visitors -> rows of block pairs.

    Visitors meet the unit's own documents, and with ``among`` also each other. Own blocks come
    first. A pair has ``p <= q``, and q holds visitors: those of q meet the documents of p. A unit
    that fits into one block is one pair.
    """
    sizes = sizes.withColumn("one", F.lit(among) & (F.col("n") + F.col("m") <= BLOCK)).select(
        "unit",
        F.when(F.col("one"), 0).otherwise(F.ceil(F.col("n") / BLOCK)).cast("int").alias("np"),
        F.ceil(F.col("m") / BLOCK).cast("int").alias("nq"),
    )
    of = F.col("np")
    every = of + F.col("nq")
    place = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    posted = (
        own.join(sizes, "unit")
        .withColumn("p", place(of))
        .withColumn("q", F.explode(F.sequence(of, every - 1)))
        .withColumns({"met": F.lit(True), "visits": F.lit(False)})
    )
    block = of + place(F.col("nq"))
    # Blocks that a visitor's block meets: those before it and itself, then those behind it.
    other = F.sequence(F.lit(0), every - 1 if among else of - 1)
    visiting = (
        visitors.join(sizes, "unit")
        .withColumn("x", block)
        .withColumn("y", F.explode(other))
        .withColumns(
            {
                "p": F.least("x", "y"),
                "q": F.greatest("x", "y"),
                "met": F.col("x") <= F.col("y"),
                "visits": F.col("y") <= F.col("x"),
            }
        )
    )
    return posted.select(*_UNIT).union(visiting.select(*_UNIT))


def _within_blocks(own: DataFrame, visitors: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of units like those of ``_units``, in which visitors only meet the documents of a block."""
    block = F.pmod(F.xxhash64("node"), F.ceil((F.col("n") + F.col("m")) / BLOCK)).cast("int")
    side = lambda docs, visits: docs.withColumn("visits", F.lit(visits))
    return (
        side(own, False)
        .union(side(visitors, True))
        .join(sizes, "unit")
        .withColumns({"p": block, "q": block, "met": F.lit(True)})
        .select(*_UNIT)
    )


def _followed(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` once ``links`` between the components of ``roots`` have joined them."""
    joined = connected(links)
    to = joined.select(F.col("node").alias("_from"), F.col("root").alias("_to"))
    moved = roots.join(to, F.col("root") == F.col("_from"), "left").select(
        "node", F.coalesce("_to", "root").alias("root")
    )
    # Documents that nothing was linked with so far.
    fresh = joined.join(roots.select("node"), "node", "left_anti")
    return materialize(moved.union(fresh), "near-roots")


def _meetings(
    own: DataFrame, visitors: DataFrame, roots: DataFrame, texts: DataFrame, length: int, t: Fraction
) -> DataFrame:
    """``roots`` once all documents of each unit have met that aren't of one component."""
    sizes = _sizes(own, visitors)
    few, many = sizes.where(F.col("m") <= BLOCK), sizes.where(F.col("m") > BLOCK)
    crowded = not many.isEmpty()
    units = _units(own, visitors, few, among=True)
    if crowded:
        units = units.union(_within_blocks(own, visitors, many))
    links = materialize(_verified(units, texts, length, t), "near-links")
    roots = _followed(roots, links)
    if not crowded:
        return roots
    now = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    documents = materialize(
        own.union(visitors)
        .join(many.select("unit"), "unit", "left_semi")
        .join(now, F.col("node") == F.col("_node"), "left")
        .select("unit", "node", F.coalesce("_root", "node").alias("root")),
        "near-crowds",
    )
    largest = materialize(
        documents.groupBy("unit", "root")
        .agg(F.count("*").alias("size"))
        .groupBy("unit")
        .agg(F.max(F.struct("size", "root")).getField("root").alias("top"), F.count("*").alias("left"))
        .where("left > 1")
        .select("unit", "top"),
        "near-largest",
    )
    still = documents.join(largest, "unit")
    own = still.where("root = top").drop("top")
    visitors = still.where("root <> top").drop("top")
    units = _units(own, visitors, _sizes(own, visitors), among=True)
    return _followed(roots, materialize(_verified(units, texts, length, t), "near-links"))


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 5,
    threshold: Fraction | float = Fraction(4, 5),
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Links are pairs with a Jaccard similarity of at least ``threshold`` on shingles of ``length``
    words (runs of other than blanks and ASCII control spaces, A-Z in lower case).
    """
    t = Fraction(threshold).limit_denominator(10_000)
    if not 0 < t <= 1:
        raise ValueError("threshold must be above 0, and 1 at most")
    with temporary() as keep:
        return keep(_near_duplicates(docs, id_col, text_col, length, t), "near-classes")


def _near_duplicates(
    docs: DataFrame, id_col: str, text_col: str, length: int, t: Fraction
) -> DataFrame:
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sketches = materialize(
        source.select("id", _sketched(F.col("text"), length, t).alias("s")).select("id", "s.*"),
        "near-sketches",
    )
    rows = sketches.select("id", "n_shingles", "node")
    sketches = sketches.where("node IS NOT NULL")
    named = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("first"))

    entries = sketches.select("node", F.explode("keys").alias("value"))
    # Entries move once: most lists have a single member, so counting first would shrink nothing.
    of_list = Window.partitionBy("value")
    lists = entries.withColumns(
        {"hub": F.min("node").over(of_list), "_last": F.max("node").over(of_list)}
    )
    member = materialize(
        lists.where("hub < _last").select("value", "node", "hub").distinct(), "near-lists"
    )
    texts = sketches.groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("packed").alias("packed")
    )
    # Each meeting joins the texts by node; in buckets they are shuffled for this table only.
    texts = materialize_by(
        texts.join(member.select("node").distinct(), "node"), "node", "near-texts"
    )

    stars = (
        member.where("hub < node")
        .groupBy("node", "hub")
        .agg(F.count("*").alias("n"))
        .groupBy("node")
        .agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("unit"))
    )
    sizes = texts.select("node", "n_shingles")
    stars = materialize(stars.join(sizes, "node"), "near-stars")
    hubs = materialize(
        stars.groupBy("unit")
        .agg(F.count("*").alias("n"))
        .join(sizes.toDF("unit", "hub_shingles"), "unit"),
        "near-hubs",
    )
    # The smaller of two linked sets has at least the share t of the larger one's size.
    ends = ("n_shingles", "hub_shingles")
    fitting = t.denominator * F.least(*ends) >= t.numerator * F.greatest(*ends)
    stars = materialize(
        join_skewed(stars, hubs, "unit").where(fitting).select("unit", "node"), "near-stars"
    )
    centers = stars.select("unit").distinct()
    own = centers.select("unit", F.col("unit").alias("node"), F.col("unit").alias("root"))
    visitors = stars.select("unit", "node", F.col("node").alias("root"))
    units = _units(own, visitors, _sizes(own, visitors), among=False)
    roots = connected(materialize(_verified(units, texts, length, t), "near-links"))
    own, visitors = _open(member, roots, texts, length, t)
    roots = _meetings(own, visitors, roots, texts, length, t).withColumnRenamed("node", "_node")

    grouped = named.join(roots, F.col("node") == F.col("_node"), "left").select(
        "node", "first", F.coalesce("root", "node").alias("root")
    )
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = grouped.join(smallest, "root").select(F.col("node").alias("_node"), "component_id")
    component = F.coalesce("component_id", "id")
    return rows.join(classes, F.col("node") == F.col("_node"), "left").select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def _wide_lists_replaced(
    labelled: DataFrame, member: DataFrame, found: DataFrame, texts: DataFrame, length: int, t: Fraction
) -> DataFrame:
    """``value, root`` with the bands of their documents in place of lists with many components."""
    wide = materialize(
        labelled.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > WIDE).select("value"),
        "near-wide",
    )
    if wide.isEmpty():
        return labelled
    documents = materialize(
        member.join(wide, "value", "left_semi").select("node").distinct(), "near-wide"
    )
    packed = (
        documents.join(found, F.col("node") == F.col("_node"), "left")
        .select("node", F.coalesce("_root", "node").alias("root"))
        .join(texts, "node")
        # Little data and much work: as many tasks as there are blocks of documents.
        .repartition(1 + documents.count() // BLOCK, "node")
        .select("root", _banded(F.col("packed"), length, t).alias("keys"))
    )
    bands = packed.select(F.explode("keys").alias("value"), "root").distinct()
    of_band = Window.partitionBy("value")
    shared = bands.withColumns(
        {"_low": F.min("root").over(of_band), "_top": F.max("root").over(of_band)}
    ).where("_low < _top")
    return labelled.join(wide, "value", "left_anti").union(shared.select("value", "root"))


def _open(
    member: DataFrame, roots: DataFrame, texts: DataFrame, length: int, t: Fraction
) -> tuple[DataFrame, DataFrame]:
    """Own documents and visitors ``unit, node, root`` for the lists with several components.

    A list's unit is its largest component. Own are that component's documents, visitors the other
    documents of the unit's lists, with their whole components.
    """
    found = roots.withColumnRenamed("node", "_node").withColumnRenamed("root", "_root")
    sizes = roots.groupBy(F.col("root").alias("_root")).agg(F.count("*").alias("size"))
    labelled = materialize(
        member.join(found, F.col("node") == F.col("_node"), "left")
        .select("value", F.coalesce("_root", "node").alias("root"))
        .distinct(),
        "near-labels",
    )
    lists = _wide_lists_replaced(labelled, member, found, texts, length, t)
    ranked = materialize(
        lists.join(sizes, F.col("root") == F.col("_root"), "left").select(
            "value", "root", F.struct(F.coalesce("size", F.lit(1)).alias("n"), "root").alias("rank")
        ),
        "near-labels",
    )
    main = ranked.groupBy("value").agg(F.max("rank").alias("top"), F.min("rank").alias("low"))
    # Which components visit which.
    visits = materialize(
        ranked.join(main.where("low < top").select("value", "top"), "value")
        .where("rank < top")
        .select(F.col("top.root").alias("unit"), "root")
        .distinct(),
        "near-visits",
    )

    def documents(components: DataFrame) -> DataFrame:
        return components.join(found, F.col("root") == F.col("_root"), "left").select(
            "unit", F.coalesce("_node", "root").alias("node"), "root"
        )

    own = visits.select("unit", F.col("unit").alias("root")).distinct()
    return documents(own), documents(visits)
