"""Exact and near-duplicate removal.

Exact: the row with the lowest id stays. The text hashes are reduced to the lowest id per hash with map-side partial aggregates, and
the rows are then picked by id. No group of copies is ever brought together, whatever its size.

Near: two rows collide when they share a MinHash band key. Scanning in the order of a seeded hash of
the id, a row is dropped when it collides with a kept row. The scan is replaced by rounds over (row,
band key) that yield the same rows and never list pairs: in a round the first undecided row of a key
is its lead; a row that leads all its keys is kept, since every earlier row it collides with was
dropped already, and the rows that share a key with it are dropped. Work per round is linear in the
undecided rows. In id order a chain of versions of one text would take a round per link or two; in
hash order the rounds grow with the logarithm of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from textward.functions.minhash import band_keys, band_layout
from textward.functions.sampling import sample_key
from textward.functions.text import normalize
from textward.sources.store import materialize

DEFAULT_THRESHOLD = 0.85

# Keys with more rows than this join by broadcast. The limit grows with the data so that at most
# MAX_HOT_KEYS keys (a few MB) can exceed it.
HOT_KEY_ROWS = 100_000
MAX_HOT_KEYS = 50_000

# Leading hex digits of the sample key that order the scan; they fit into a bigint.
TURN_DIGITS = 15


def text_digest(text_col: str) -> Column:
    """Equal for texts that normalize alike; null for a null text."""
    return F.unhex(F.sha2(normalize(text_col), 256))


def exact_survivors(df: DataFrame, *, id_col: str, text_col: str = "text") -> DataFrame:
    """Ids of the first row of every distinct normalized text."""
    return (
        df.select(id_col, text_digest(text_col).alias("_digest"))
        .groupBy("_digest")
        .agg(F.min(id_col).alias(id_col))
        .select(id_col)
    )


def dedup_exact(df: DataFrame, *, id_col: str, text_col: str = "text") -> DataFrame:
    return df.join(exact_survivors(df, id_col=id_col, text_col=text_col), id_col, "left_semi")


def _join_keys(members: DataFrame, keys: DataFrame, limit: int) -> DataFrame:
    """Rows of ``members`` with their key's columns; a key of any size is spread over all tasks.

    ``keys`` has one row per key with its size ``_n``. Keys above ``limit`` rows are few, so they
    go to every task; the others are joined by a shuffle in which none is large.
    """
    hot = keys.where(F.col("_n") > limit)
    if hot.isEmpty():
        return members.join(keys, "_key")
    hot = F.broadcast(hot)
    cold = members.join(hot.select("_key"), "_key", "left_anti").join(
        keys.where(F.col("_n") <= limit), "_key"
    )
    return members.join(hot, "_key").unionByName(cold)


def greedy_losers(rows: DataFrame, n_keys: int, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Ids dropped by the hash-ordered scan over ``rows(_id, _keys)``, each with ``n_keys`` keys."""
    turn = F.conv(F.left(sample_key("_id"), F.lit(TURN_DIGITS)), 16, 10).cast("bigint")
    losers = []
    pending, left = rows, rows.count()
    while left:
        members = pending.select("_id", turn.alias("_turn"), F.explode("_keys").alias("_key"))
        # Reduced before the shuffle: a hot key sends one row per task.
        stats = members.groupBy("_key").agg(
            F.min(F.struct("_turn", "_id")).getField("_id").alias("_lead"),
            F.count("*").alias("_n"),
        )
        owned = F.count("*").over(Window.partitionBy("_lead"))  # at most n_keys rows each
        keys = materialize(
            stats.withColumn("_claimed", owned == n_keys)
            .where(F.col("_n") > 1)
            .select("_key", "_lead", "_n", "_claimed"),
            "near-dup-keys",
        )
        limit = max(hot_key_rows, left * n_keys // MAX_HOT_KEYS)
        leads = F.col("_lead") == F.col("_id")
        # Rows absent here share no key with anyone and are kept.
        verdict = materialize(
            _join_keys(members, keys, limit)
            .groupBy("_id")
            .agg(
                F.bool_or(F.col("_claimed") & ~leads).alias("_dropped"),
                F.bool_or(F.col("_claimed") & leads).alias("_kept"),
            ),
            "near-dup-verdict",
        )
        losers.append(verdict.where("_dropped").select("_id"))
        open_ids = verdict.where(~F.col("_dropped") & ~F.col("_kept")).select("_id")
        left = open_ids.count()
        if left:
            pending = materialize(pending.join(open_ids, "_id", "left_semi"), "near-dup-pending")
    if not losers:
        return rows.select("_id").limit(0)
    return reduce(DataFrame.unionAll, losers)


def near_survivors(
    df: DataFrame,
    *,
    id_col: str,
    text_col: str = "text",
    threshold: float = DEFAULT_THRESHOLD,
    hot_key_rows: int = HOT_KEY_ROWS,
    keep: tuple[str, ...] = (),
    observation: Observation | None = None,
) -> DataFrame:
    """Ids left after exact and near-duplicate removal, with the columns of ``keep``.

    The texts are read once, into a narrow table of ids, digests and band keys; everything else
    works on that table and no text is shuffled. ``observation`` gets ``n_rows``, the rows of
    ``df``, counted by the task that writes them.
    """
    bands, _ = band_layout(threshold)
    # Two uses in one projection would normalize each text twice.
    narrow = df.select(
        F.col(id_col).alias("_id"),
        normalize(text_col).alias("_text"),
        F.struct(F.lit(0).alias("_"), *keep).alias("_kept"),
    ).select(
        "_id",
        F.unhex(F.sha2("_text", 256)).alias("_digest"),
        band_keys(F.coalesce("_text", F.lit("")), threshold).alias("_keys"),
        "_kept",
    )
    if observation is not None:
        narrow = narrow.observe(observation, F.count(F.lit(1)).alias("n_rows"))
    hashed = materialize(narrow, "near-dup-hashes")
    firsts = hashed.groupBy("_digest").agg(F.min("_id").alias("_id")).select("_id")
    rows = materialize(
        hashed.drop("_digest").join(firsts, "_id", "left_semi"), "near-dup-bands"
    )
    losers = greedy_losers(rows.select("_id", "_keys"), bands, hot_key_rows)
    return rows.join(losers, "_id", "left_anti").select(
        F.col("_id").alias(id_col), *[F.col("_kept")[c].alias(c) for c in keep]
    )


def dedup_near(
    df: DataFrame,
    *,
    id_col: str,
    text_col: str = "text",
    threshold: float = DEFAULT_THRESHOLD,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Exact dedup, then near-duplicate removal."""
    kept = near_survivors(
        df, id_col=id_col, text_col=text_col, threshold=threshold, hot_key_rows=hot_key_rows
    )
    return df.join(kept, id_col, "left_semi")
