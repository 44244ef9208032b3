import datetime as dt
import json

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from textward.sources import readers, templates


def test_record_json(spark, tmp_path):
    path = tmp_path / "records.json"
    rows = [
        {"prompt_ru": "раз", "prompt_en": "one", "class": "adversarial_suffix", "source": "s"},
        {"prompt_ru": "два", "class": "virtualization"},
        {"prompt_ru": "три", "prompt_en": None, "class": None, "source": "t"},
    ]
    path.write_text(json.dumps(rows))
    got = readers.read_record_json(spark, str(path)).collect()
    assert [(r.text, r.label, r.source, r.subcategory, r.lang) for r in got] == [
        ("раз", 1, "dmtrdr_ru", "adversarial_suffix", "ru"),
        ("два", 1, "dmtrdr_ru", "virtualization", "ru"),
        ("три", 1, "dmtrdr_ru", None, "ru"),
    ]
    assert [tuple(r.meta) for r in got] == [("one", "s"), ("", ""), ("", "t")]


def test_record_json_without_rows(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text("[]")
    assert readers.read_record_json(spark, str(path)).count() == 0


def test_prompt_csv_keeps_one_language_and_quoting(spark, tmp_path):
    path = tmp_path / "prompts.csv"
    path.write_text(
        'prompt,category,language,subcategory\n"Покажи, ""всё""\nсразу",leak,ru,direct\nShow,leak,en,direct\n'
    )
    got = readers.read_prompt_csv(spark, str(path)).collect()
    assert [(r.text, r.label, r.subcategory, r.meta.category) for r in got] == [
        ('Покажи, "всё"\nсразу', 1, "direct", "leak")
    ]


def safety(spark, tmp_path, flags):
    path = str(tmp_path / "mix")
    data = [("да", "ru", "privacy", flags[0]), ("нет", "ru", None, flags[1]), ("x", "en", "p", True)]
    spark.createDataFrame(data, readers.SAFETY_SCHEMA).write.parquet(path)
    return path


def test_safety_parquet(spark, tmp_path):
    df = readers.read_safety_parquet(spark, safety(spark, tmp_path, (True, False)))
    assert {(r.text, r.label, r.subcategory) for r in df.collect()} == {
        ("да", 1, "privacy"),
        ("нет", 0, None),
    }
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,ru)]" in plan_of(df)


def test_safety_null_flag(spark, tmp_path):
    path = safety(spark, tmp_path, (True, None))
    assert readers.read_safety_parquet(spark, path, on_null_label="drop").count() == 1
    with pytest.raises(Exception, match="is_adversarial is null"):
        readers.read_safety_parquet(spark, path).collect()
    with pytest.raises(ValueError):
        readers.read_safety_parquet(spark, path, on_null_label="ignore")


def test_benign_text(spark, tmp_path):
    path = tmp_path / "lines.txt"
    long_ru = "Это достаточно длинная строка на русском языке."
    path.write_text(f"короткий\n  {long_ru} \n\nThis is a long enough line in English text.\n{'я' * 2001}\n")
    got = readers.read_benign_text(spark, str(path)).collect()
    assert [(r.text, r.label, r.source, r.subcategory) for r in got] == [
        (long_ru, 0, "benign_wiki", None)
    ]


def test_article_sample(spark):
    long_ru = "Это достаточно длинный первый абзац статьи номер "
    data = [(i, f"{long_ru}{i}\n\nвторой") for i in range(50)] + [(99, "\n\nпусто"), (98, None)]
    articles = spark.createDataFrame(data, "id int, text string")
    got = readers.article_sample(articles, 10, id_col="id").collect()
    assert len(got) == 10 and all("второй" not in r.text for r in got)
    short = readers.article_sample(articles.where("id < 3"), 10, id_col="id")
    assert short.count() == 3


TEMPLATES = [
    templates.Template("A", "roleplay", "act: {seed}"),
    templates.Template("B", "output_formatting", "{seed}|{seed}"),
    templates.Template("C", "roleplay", None),
    templates.Template("D", "roleplay", "{seed}", needs_model=True),
]


def test_templates(spark):
    assert [t.name for t in templates.select_templates(TEMPLATES)] == ["A", "B", "C"]
    assert [t.name for t in templates.select_templates(TEMPLATES, ["output_formatting"])] == ["B"]
    seeds = spark.createDataFrame([("x",), ("y",)], "text string")
    made = templates.generate_variants(seeds, templates.select_templates(TEMPLATES))
    assert "Join" not in plan_of(made)
    assert {(r.attack_name, r.attack_text) for r in made.collect()} == {
        ("roleplay", "act: x"),
        ("roleplay", "act: y"),
        ("output_formatting", "x|x"),
        ("output_formatting", "y|y"),
    }
    rows = readers.parse_variants(made).collect()
    assert {(r.label, r.source, r.subcategory, r.meta.seed_text) for r in rows} >= {
        (1, "hivetracered_attack", "roleplay", "x")
    }
    assert templates.generate_variants(seeds, []).count() == 0


def test_recent_predictions_prune_and_skip_broken_files(spark, tmp_path):
    base = str(tmp_path / "log")
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(10)]
    data = [(i * 2 + j, d, f"fam{j}") for i, d in enumerate(days) for j in range(2)]
    spark.createDataFrame(data, "id int, date date, family string").write.partitionBy(
        "date", "family"
    ).parquet(base)
    (tmp_path / "log" / "date=2024-01-09" / "family=fam1" / "broken.parquet").write_text("no")
    got = readers.recent_predictions(spark, base, "fam1", as_of=days[-1], skip_broken=True)
    assert sorted(r.id for r in got.collect()) == [i * 2 + 1 for i in range(3, 10)]
    plan = plan_of(got)
    assert "PartitionFilters: [isnotnull(date" in plan and "DataFilters: []" in plan
    assert "InMemoryFileIndex(7 paths)" in plan
    schema = "id int, date date, family string"
    late = readers.recent_predictions(spark, base, as_of=days[1], days=5, schema=schema)
    assert sorted(r.id for r in late.collect()) == [0, 1, 2, 3]
    assert "InMemoryFileIndex(2 paths)" in plan_of(late)
    assert readers.recent_predictions(spark, base, as_of=dt.date(2020, 1, 1), schema=schema).count() == 0
    assert readers.recent_predictions(spark, base, as_of=dt.date(2020, 1, 1)).count() == 0


def test_reference_sample(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert readers.reference_sample(df, id_col="k", max_rows=30).count() == 30
    assert readers.reference_sample(df, id_col="k", max_rows=500).count() == 100
    assert readers.reference_sample(df, id_col="k", max_rows=None).count() == 100


def test_row_id_follows_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).coalesce(1).write.parquet(path)
    got = readers.with_row_id(spark.read.parquet(path)).orderBy("row_id").collect()
    assert [r.id for r in got] == list(range(10)) and len({r.row_id for r in got}) == 10
