"""Each numbered query against its SQL or the tokenizers' libraries, and the pipeline's stages."""

import hashlib
import sys
import zlib
from pathlib import Path

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import check_oracles  # noqa: E402
import corpus_pipeline  # noqa: E402

from textward.llm import bpe, minhash, queries  # noqa: E402
from textward.sources.store import materialize  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    return check_oracles.connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, small, name):
    got = queries.QUERIES[name](spark, small).toPandas()
    assert check_oracles.compare(got, duck.execute(queries.ORACLES[name]).df()) is None
    assert len(got) > 0


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


def test_op1_as_the_library(spark, small, texts):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    rows = queries.op1_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == sha(" ".join(map(str, ids)).encode())
        assert r.decoded_sha256 == sha(texts[r.doc_id].encode())


def test_op2_as_the_library(spark, small, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = queries.op2_token_counts(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit) == (n, n > 2048)
        assert r.n_bytes == len(texts[r.doc_id].encode())


def test_op5_targets_by_resharing(spark, small, duck):
    rows = queries.op5_mixing(spark, small).toPandas()
    assert (rows.taken <= 2 * rows["size"]).all()
    source = duck.execute("SELECT doc_id, source FROM documents").df().set_index("doc_id").source
    by = rows.groupby(rows.doc_id.map(source), sort=True)
    sizes, taken, target = by["size"].sum(), by.taken.sum(), by.target.first()
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes.index)}
    stopped = set()
    while True:
        rest = 1.5 * sizes.sum() - sum(2 * sizes[s] for s in stopped)
        total = sum(w for s, w in weights.items() if s not in stopped)
        want = {s: 2.0 * sizes[s] if s in stopped else rest * weights[s] / total for s in weights}
        above = {s for s in weights if want[s] > 2 * sizes[s]}
        if not above:
            break
        stopped |= above
    largest = by["size"].max()
    for s in weights:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= largest[s]
    again = queries.op5_mixing(spark, small).toPandas()
    key = ["doc_id"]
    assert rows.sort_values(key).taken.tolist() == again.sort_values(key).taken.tolist()


def test_op8_on_held_out_rows(spark, small, duck):
    rows = queries.op8_quality(spark, "/root/testdata/sf0.01").toPandas()
    assert rows.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]
    assert rows.score.between(0, 1).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    labels = duck.execute("SELECT * FROM '/root/testdata/sf0.01/labels.parquet'").df()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() >= 0.95


def test_pipeline_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    kept = materialize(corpus_pipeline.quality_stage(spark, docs, small))
    assert kept.columns == columns and 0 < kept.count() < docs.count()
    lined = materialize(corpus_pipeline.line_stage(spark, kept, small))
    assert lined.columns == columns
    assert lined.where("n_chars <> length(text)").count() == 0
    near = materialize(corpus_pipeline.near_stage(spark, lined, small))
    found = minhash.near_duplicates(lined)
    assert near.count() == found.where("kept").count()
    mixed = corpus_pipeline.mixing_stage(spark, near, small)
    assert mixed.columns == columns
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    tokens = corpus_pipeline.bpe_stage(spark, near.limit(20), small).collect()
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in tokens)


def test_near_stage_keeps_one_row_of_each_group(spark, small, rows):
    base = [" ".join(f"{name}{i}" for i in range(40)) for name in "abcdefg"]
    a, b, c, d, e, f, g = base
    near = " ".join(a.split()[:-1])
    data = [(1, a), (2, near), (None, a), (3, b), (3, near), (4, c), (4, c), (4, d)]
    data += [(None, e), (None, e), (None, f), (5, g), (None, None), (None, None), (6, "")]
    docs = rows(data, "doc_id bigint, text string")
    got = [tuple(r) for r in corpus_pipeline.near_stage(spark, docs, small).collect()]
    grams = lambda t: {tuple(t.split()[i : i + 5]) for i in range(max(1, len(t.split()) - 4))}
    groups = []
    for row in sorted(data, key=lambda x: (x[0] is None, x[0] or 0)):
        alike = lambda o: 5 * len(grams(row[1]) & grams(o[1])) >= 4 * len(grams(row[1]) | grams(o[1]))
        if not row[1] or not any(o[1] and alike(o) for o in groups):
            groups.append(row)
    assert sorted(got, key=str) == sorted(groups, key=str)


def test_stages_take_empty_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() == 0
