"""Readers that bring each source layout to the canonical table.

Readers of raw files take an explicit schema, so no pass over the data infers one, and filters sit
next to the scan so that Parquet evaluates them. Tables of this package bring theirs along.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textward.functions import text as tx
from textward.operators.sampling import sample_exact
from textward.sources.schema import canonical
from textward.sources.store import day_folders, materialize

# The source tags that downstream tables group by, and one data set id.
RECORD_SOURCE = "dmtrdr_ru"
PROMPT_SOURCE = "hivetrace_sysprompt"
SAFETY_SOURCE = "wildguardmix_ru"
SAFETY_DATASET = "allenai/wildguardmix"
VARIANT_SOURCE = "hivetracered_attack"
BENIGN_SOURCE = "benign_wiki"

RECORD_SCHEMA = "prompt_ru string, prompt_en string, class string, source string"
PROMPT_CSV_SCHEMA = "prompt string, category string, language string, subcategory string"
SAFETY_SCHEMA = (
    "prompt string, lang string, prompt_harm_category string, is_adversarial boolean"
)
VARIANT_SCHEMA = "seed_text string, attack_name string, attack_text string"


def _schema(columns: str, keep: str) -> str:
    return f"{keep}, {columns}" if keep else columns


def _names(keep: str) -> tuple[str, ...]:
    return tuple(part.split()[0] for part in keep.split(",")) if keep else ()


def read_record_json(
    spark: SparkSession,
    path: str,
    *,
    source: str = RECORD_SOURCE,
    lang: str = "ru",
    multi_line: bool = True,
    keep: str = "",
) -> DataFrame:
    """Injection records: every row is a positive.

    ``multi_line`` reads files holding one JSON array, one task per file; JSON lines
    (``multi_line=False``) are splittable and the layout to use for large inputs.
    ``keep`` is a DDL list of further columns to carry along, such as ``"doc_id bigint"``.
    """
    raw = spark.read.schema(_schema(RECORD_SCHEMA, keep)).json(path, multiLine=multi_line)
    return canonical(
        raw,
        text=F.col("prompt_ru"),
        label=F.lit(1),
        source=F.lit(source),
        subcategory=F.col("class"),
        lang=F.lit(lang),
        meta=F.struct(
            F.coalesce("prompt_en", F.lit("")).alias("prompt_en"),
            F.coalesce("source", F.lit("")).alias("orig_source"),
        ),
        keep=_names(keep),
    )


def read_prompt_csv(
    spark: SparkSession,
    path: str,
    *,
    source: str = PROMPT_SOURCE,
    lang: str = "ru",
    multi_line: bool = True,
    keep: str = "",
) -> DataFrame:
    """Prompt CSV with a header: rows of one language, all positive."""
    raw = (
        spark.read.schema(_schema(PROMPT_CSV_SCHEMA, keep))
        .csv(path, header=True, quote='"', escape='"', multiLine=multi_line)
        .where(F.col("language") == lang)
    )
    return canonical(
        raw,
        text=F.col("prompt"),
        label=F.lit(1),
        source=F.lit(source),
        subcategory=F.col("subcategory"),
        lang=F.lit(lang),
        meta=F.struct(F.col("category")),
        keep=_names(keep),
    )


def read_safety_parquet(
    spark: SparkSession,
    path: str,
    *,
    source: str = SAFETY_SOURCE,
    lang: str = "ru",
    on_null_label: str = "fail",
    keep: str = "",
) -> DataFrame:
    """Safety mix: rows of one language, label from ``is_adversarial``.

    A null flag fails the job when the row is read, or is dropped with ``on_null_label="drop"``.
    """
    if on_null_label not in ("fail", "drop"):
        raise ValueError(f"on_null_label must be 'fail' or 'drop', got {on_null_label!r}")
    raw = (
        spark.read.schema(_schema(SAFETY_SCHEMA, keep)).parquet(path).where(F.col("lang") == lang)
    )
    flag = F.col("is_adversarial")
    if on_null_label == "drop":
        raw = raw.where(flag.isNotNull())
        label = flag.cast("byte")
    else:
        label = F.when(flag.isNull(), F.raise_error(F.lit("is_adversarial is null"))).otherwise(
            flag.cast("byte")
        )
    return canonical(
        raw,
        text=F.col("prompt"),
        label=label,
        source=F.lit(source),
        subcategory=F.col("prompt_harm_category"),
        lang=F.lit(lang),
        meta=F.struct(F.lit(SAFETY_DATASET).alias("orig_source")),
        keep=_names(keep),
    )


def benign_lines(
    lines: DataFrame,
    line_col: str = "value",
    *,
    source: str = BENIGN_SOURCE,
    lang: str = "ru",
    min_chars: int = 30,
    max_chars: int = 2000,
    min_script_ratio: float = 0.7,
    script: str = tx.CYRILLIC,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Stripped, non-empty lines of acceptable length and script, all negative."""
    stripped = lines.select(*keep, tx.strip(line_col).alias("_line"))
    kept = stripped.where(
        (F.col("_line") != "")
        & tx.length_ok("_line", min_chars, max_chars)
        & tx.is_script("_line", min_script_ratio, script)
    )
    return canonical(
        kept,
        text=F.col("_line"),
        label=F.lit(0),
        source=F.lit(source),
        subcategory=F.lit(None),
        lang=F.lit(lang),
        meta=F.struct(F.lit(source).alias("orig_source")),
        keep=keep,
    )


def read_benign_text(spark: SparkSession, path: str, **options) -> DataFrame:
    return benign_lines(spark.read.text(path), "value", **options)


def article_sample(
    articles: DataFrame,
    n: int,
    *,
    id_col: str,
    text_col: str = "text",
    seed: int = 42,
    separator: str = "\n\n",
    **line_options,
) -> DataFrame:
    """First paragraphs of a seeded article sample.

    ``4 * n`` articles are drawn, the first ``n`` non-empty first paragraphs in draw order are
    taken, and only then the line filters apply, so fewer than ``n`` rows may remain. The drawn
    paragraphs are written once, so the second draw doesn't read the articles again.
    """
    drawn = sample_exact(articles.select(id_col, text_col), 4 * n, id_col=id_col, seed=seed)
    firsts = drawn.select(id_col, tx.first_paragraph(text_col, separator).alias("value")).where(
        F.col("value") != ""
    )
    drawn_once = materialize(firsts, "first-paragraphs")
    return benign_lines(
        sample_exact(drawn_once, n, id_col=id_col, seed=seed), "value", keep=(id_col,), **line_options
    )


def parse_variants(
    variants: DataFrame,
    *,
    source: str = VARIANT_SOURCE,
    lang: str = "ru",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Generated variants, all positive; the subcategory is the template's category."""
    return canonical(
        variants,
        text=F.col("attack_text"),
        label=F.lit(1),
        source=F.lit(source),
        subcategory=F.col("attack_name"),
        lang=F.lit(lang),
        meta=F.struct(F.coalesce("seed_text", F.lit("")).alias("seed_text")),
        keep=keep,
    )


def read_splits(
    spark: SparkSession, base: str, data_version: str, split: str | None = None
) -> DataFrame:
    """One data version of the split table; both conditions prune partitions."""
    df = spark.read.parquet(base).where(F.col("data_version") == data_version)
    return df if split is None else df.where(F.col("split") == split)


def recent_predictions(
    spark: SparkSession,
    base: str,
    family: str | None = None,
    *,
    days: int = 7,
    as_of: dt.date | Column | None = None,
    schema: str | None = None,
    skip_broken: bool = False,
) -> DataFrame:
    """Logged predictions of the last ``days`` UTC dates including ``as_of`` (default today).

    Dates and families are partitions, so other files are never opened. With a date of Python, only
    the folders of the wanted dates are listed, however long the log is (a log that a stream's file
    sink has written is read by the sink's own list of files). ``schema`` is the DDL of the
    log with ``date`` and ``family``; with it no file is opened to find the columns, and a log that
    doesn't exist yet has no rows. With ``skip_broken``, files that vanish or cannot be decoded are
    left out; otherwise they are errors.
    """
    if as_of is None:
        as_of = dt.datetime.now(dt.UTC).date()
    day = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    reader = spark.read.option("ignoreCorruptFiles", skip_broken).option(
        "ignoreMissingFiles", skip_broken
    )
    if schema:
        reader = reader.schema(schema)
    plain_date = isinstance(as_of, dt.date) and not isinstance(as_of, dt.datetime)
    folders = day_folders(spark, base, as_of, days) if plain_date else None
    try:
        if folders:
            log = reader.option("basePath", base).parquet(*folders)
        elif folders is not None and schema:
            log = spark.createDataFrame([], schema)
        else:
            log = reader.parquet(base)
    except AnalysisException as e:
        if not schema or e.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], schema)
    df = log.where(F.col("date").between(F.date_sub(day, days - 1), day))
    return df if family is None else df.where(F.col("family") == family)


def reference_sample(
    df: DataFrame, *, id_col: str, max_rows: int | None = None, seed: int = 42
) -> DataFrame:
    """The whole table, or an exact sample of ``max_rows`` rows if it is larger than asked for."""
    return df if max_rows is None else sample_exact(df, max_rows, id_col=id_col, seed=seed)


def with_row_id(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Id of a row read from Parquet: file name and position in the file.

    Stable under retries and repartitioning, and ordered like the files. Apply right after the
    read, while the file metadata is still available.
    """
    return df.select(
        F.concat_ws(
            ":",
            F.col("_metadata.file_name"),
            F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0"),
        ).alias(id_col),
        "*",
    )
