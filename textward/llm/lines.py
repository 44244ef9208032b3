r"""Line dedup by content-defined chunks of lines, in built-in expressions only.

A rolling hash over each two neighbouring lines' hashes stands at every place between lines. A chunk
ends where that hash is smaller than at the places before and behind, so boundaries depend on the
four lines around them and are found again when a passage is shifted. Chunks have two lines at least
(the document's first and last line are never cut off), three on the average.

Chunks that occur more than once anywhere are found by their digests: the first occurrence (by id,
then by place) stays, the others are removed once their bytes have been compared. Digests travel
without texts and are reduced before the shuffle. Texts move once, to meet the marks of their
repeated chunks; of these texts, only repeated chunks are compared. Chunks whose digests agree but
whose bytes don't are removed only if their bytes have occurred before.

Defined results: a null text has no lines and stays null; lines end with ``\n`` alone, and an empty
text is one empty line; documents of one line are left alone; a null id comes after all others;
repeated rows (equal id and text) are one document and lose the same lines; columns of any name are
passed on, but for those named like a result, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textward.llm.common import join_skewed, plain_names
from textward.sources.store import materialize, temporary

RESULTS = ("_kept", "_n_lines", "_n_removed")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though the body's lambdas use it per element."""
    return F.get(F.transform(F.array(value), body), 0)


def chunk_starts(lines: Column) -> Column:
    """Places (from 0) of the chunks' first lines, ``array<int>``; ``lines`` is a bound array."""
    n = F.size(lines)
    inner = F.when(n >= 4, F.sequence(F.lit(2), n - 2)).otherwise(F.array().cast("array<int>"))

    def rolling(hashes: Column) -> Column:
        # At i: the hash between lines i and i + 1.
        return F.transform(
            F.slice(hashes, 1, F.greatest(n - 1, F.lit(0))),
            lambda h, i: F.md5(F.concat(h, F.get(hashes, i + 1))),
        )

    def least(between: Column) -> Column:
        at = lambda i: F.get(between, i)
        return F.filter(inner, lambda i: (at(i - 1) < at(i - 2)) & (at(i - 1) <= at(i)))

    found = _let(F.transform(lines, F.md5), lambda hashes: _let(rolling(hashes), least))
    return F.concat(F.array(F.lit(0)), found)


def chunks(lines: Column) -> Column:
    """``array<struct<no, start, size>>`` of a bound array of lines."""
    return _let(
        chunk_starts(lines),
        lambda starts: F.transform(
            starts,
            lambda s, i: F.struct(
                i.alias("no"),
                s.alias("start"),
                (F.coalesce(F.get(starts, i + 1), F.size(lines)) - s).alias("size"),
            ),
        ),
    )


def _piece(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["start"] + 1, chunk["size"]), "\n")


def _digests(lines: Column) -> Column:
    """The chunks of two lines or more with their digests."""
    return F.transform(
        F.filter(chunks(lines), lambda c: c["size"] >= 2),
        lambda c: F.struct(
            c["no"].alias("no"),
            c["start"].alias("start"),
            c["size"].alias("size"),
            F.unhex(F.md5(_piece(lines, c))).alias("digest"),
        ),
    )


def _without(lines: Column, gone: Column) -> Column:
    """The text of the lines outside the ranges ``array<struct<start, size>>``, in order."""

    def rest(ranges: Column) -> Column:
        # Parts start where a removed range ends, the first one at the top.
        borders = F.concat(
            F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("size"))), ranges
        )
        return F.transform(
            borders,
            lambda r, i: F.slice(
                lines,
                r["start"] + r["size"] + 1,
                F.coalesce(F.get(ranges, i)["start"], F.size(lines)) - r["start"] - r["size"],
            ),
        )

    return F.array_join(F.flatten(_let(F.array_sort(gone), rest)), "\n")


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``_kept`` (the text without repeated chunks), ``_n_lines``, ``_n_removed``."""
    given = docs.columns
    docs, at = plain_names(docs)
    id_col, text_col = at[id_col], at[text_col]
    lines = F.split(F.col(text_col), "\n", -1)
    # Names the document: equal for repeated rows only.
    key = F.md5(
        F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col))
    )
    several = F.col(text_col).isNotNull() & F.col(text_col).contains("\n")
    with temporary() as keep:
        cut = docs.where(several).select(
            F.col(id_col).alias("id"), key.alias("key"), F.explode(_let(lines, _digests)).alias("c")
        )
        found = materialize(cut.select("id", "key", "c.*"), "line-chunks")
        place = F.struct(F.col("id").isNull().alias("last"), "id", "key", "no")
        index = materialize(
            found.groupBy("digest")
            .agg(F.min(place).alias("first"), F.max(place).alias("other"), F.count("*").alias("n"))
            .where("first < other")
            .select("digest", "first", "n"),
            "line-index",
        )
        marks = (
            join_skewed(found, index, "digest")
            .groupBy("key")
            .agg(
                F.collect_set(
                    F.struct("no", "start", "size", "digest", (place != F.col("first")).alias("again"))
                ).alias("_line_marks")
            )
            .withColumnRenamed("key", "_line_other")
        )
        joined = keep(
            docs.withColumn("_line_key", key).join(marks, F.col("_line_key") == F.col("_line_other"), "left").drop("_line_other"),
            "line-marked",
        )

        # Comparing bytes: digests whose chunks aren't all alike.
        marked = joined.where("_line_marks IS NOT NULL").select(
            F.col(id_col).alias("id"),
            F.col("_line_key").alias("key"),
            F.explode(
                _let(
                    lines,
                    lambda ls: F.transform(
                        "_line_marks",
                        lambda m: F.struct(
                            m["no"].alias("no"), m["digest"].alias("digest"), _piece(ls, m).alias("piece")
                        ),
                    ),
                )
            ).alias("m"),
        )
        pieces = marked.select("id", "key", "m.*")
        alike = pieces.groupBy("digest", "piece").agg(F.min(place).alias("first"))
        unlike = alike.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
        unlike = materialize(unlike, "line-unlike")
        exceptions = keep(
            pieces.join(unlike, "digest")
            .join(alike.join(unlike, "digest"), ["digest", "piece"])
            .groupBy("key")
            .agg(F.collect_set(F.struct("no", (place != F.col("first")).alias("again"))).alias("_line_x"))
            .withColumnRenamed("key", "_line_other"),
            "line-exceptions",
        )
    # A table without rows but for colliding digests, which Spark broadcasts by its size.
    decided = joined.join(exceptions, F.col("_line_key") == F.col("_line_other"), "left").drop("_line_other", "_line_key")
    none = F.array().cast("array<struct<no:int,again:boolean>>")
    excepted = F.transform(F.coalesce("_line_x", none), lambda e: e["no"])
    gone = F.transform(
        F.filter(
            "_line_marks",
            lambda m: F.when(
                F.array_contains(excepted, m["no"]),
                F.exists("_line_x", lambda e: (e["no"] == m["no"]) & e["again"]),
            ).otherwise(m["again"]),
        ),
        lambda m: F.struct(m["start"].alias("start"), m["size"].alias("size")),
    )
    some = F.coalesce(F.size("_line_gone") > 0, F.lit(False))
    kept = _let(lines, lambda ls: _without(ls, F.col("_line_gone")))
    n_lines = F.coalesce(F.length(text_col) - F.length(F.replace(text_col, F.lit("\n"))) + 1, F.lit(0))
    removed = F.aggregate("_line_gone", F.lit(0), lambda s, m: s + m["size"])
    return decided.withColumn("_line_gone", gone).select(
        *[F.col(at[c]).alias(c) for c in given if c.lower() not in RESULTS],
        F.when(some, kept).otherwise(F.col(text_col)).alias("_kept"),
        n_lines.cast("bigint").alias("_n_lines"),
        F.when(some, removed).otherwise(F.lit(0)).cast("bigint").alias("_n_removed"),
    )
