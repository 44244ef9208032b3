"""Decontamination, divergence and search against brute force, with odd rows and hot groups."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from textward.llm import decontaminate, divergence, lexical

LOWER = {c: chr(c + 32) for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
ODD = [
    (1, "Ab cd, ef", "s", 5, 6, "x"),
    (1, "Ab cd, ef", "s", 5, 6, "x"),
    (2, None, None, None, None, None),
    (3, "", "t", 0, 0, ""),
    (None, "ab CD ef", None, 1, 1, "y"),
    (4, "İß Éa\u00a0b\u2003c 12x\x1cy ab", "s", 1, 1, "y"),
    (5, "...!\t\n", "s", 1, 1, "y"),
]
# Names that the operators use themselves.
ODD_SCHEMA = "doc_id bigint, text string, source string, hash bigint, start bigint, items string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def noise(r, n):
    letters = ["ab", "Cd", "é", "ß1", "x", "日本", "zz", "Σ", "q9"]
    seps = [" ", "\n", ", ", ".", "\t"]
    return "".join(r.choice(letters) + r.choice(seps) for _ in range(n))


def brute_hits(docs, items, length):
    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(len(w), length)
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i : i + n])].add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i : i + n])] - {None}
        out.append((doc_id, len(w), len(hit), sorted(map(str, found))))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_decontamination_by_brute_force(rows, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    r = random.Random(3)
    items = [(i, noise(r, r.choice([0, 1, 3, 9, 10, 11, 30]))) for i in range(25)]
    items += [(None, noise(r, 12)), (7, noise(r, 14)), (8, None)]
    docs = [(i, "".join(r.choice([noise(r, 8), r.choice(items)[1] or ""]) for _ in range(4))) for i in range(60)]
    docs += [(None, docs[0][1]), (0, docs[0][1]), (99, None), (100, ""), (101, "x, " * 3000 + items[6][1])]
    got = decontaminate.decontaminate(
        rows(docs, "doc_id bigint, text string"), rows(items, "item_id bigint, text string")
    )
    found = [(r.doc.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()]
    assert sorted(found, key=str) == brute_hits(docs, items, 10)


def test_a_passage_that_all_documents_share(spark, rows):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("own "), F.col("id").cast("string"), F.lit(" " + passage)).alias("text")
    )
    got = decontaminate.decontaminate(docs, rows([("a", passage), ("b", passage)], "item_id string, text string"))
    seen = got.select("n_words", "n_hit", "items", "spans").distinct().collect()
    assert [tuple(r[:3]) for r in seen] == [(42, 40, ["a", "b"])]
    assert [tuple(s) for s in seen[0].spans] == [(3, 40)]


def test_without_spans(rows):
    text = "  Keep: one. two! GONE, gone; last?"
    docs = rows([(1, text), (2, "clean one"), (3, None)], "doc_id bigint, text string")
    got = decontaminate.decontaminate(docs, rows([(1, "gone gone")], "item_id bigint, text string"), length=2)
    kept = got.select("doc.doc_id", decontaminate.without_spans(F.col("doc.text"), F.col("spans")).alias("t"))
    assert dict(map(tuple, kept.collect())) == {1: "  Keep: one. two! last?", 2: "clean one", 3: None}


def test_odd_rows_and_empty_tables(rows):
    docs, none = rows(ODD, ODD_SCHEMA), rows([], ODD_SCHEMA)
    items = rows([(1, "AB cd"), (2, None), (3, "")], "item_id bigint, text string")
    got = decontaminate.decontaminate(docs, items)
    assert got.select("doc.*").columns == docs.columns
    assert sorted((r.doc.doc_id or 0, r.n_words, r.n_hit) for r in got.collect()) == [
        (0, 3, 2), (1, 3, 2), (1, 3, 2), (2, 0, 0), (3, 0, 0), (4, 5, 0), (5, 0, 0)
    ]
    assert all(r.n_hit == 0 for r in decontaminate.decontaminate(docs, items.limit(0)).collect())
    assert decontaminate.decontaminate(none, items).count() == 0
    assert lexical.search(none, items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    # The document without an id counts, but isn't ranked; equal rows are ranked both.
    assert [tuple(r) for r in lexical.search(docs, items).select("item", "doc_id").collect()] == [
        ("1", 1), ("1", 1), ("1", 4)
    ]
    lang = docs.withColumn("lang", F.lit(None).cast("string"))
    assert divergence.divergence(lang.limit(0)).count() == 0
    assert {r.lang for r in divergence.divergence(lang).collect()} == {""}


def brute_divergence(docs, top):
    docs = [(lang or "", source or "", TERM.findall((t or "").translate(LOWER))) for t, lang, source in docs]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= 3}
        counts = {s: Counter() for _, s, _ in mine}
        for _, s, w in mine:
            counts[s].update(t for t in w if t in kept)
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept))
        whole = sum(counts.values(), Counter())
        f = lambda p, q: (p - q) ** 2 // q
        for s, c in counts.items():
            pairs = [(sum(f(share(c, t), share(d, t)) for t in kept), o) for o, d in counts.items() if o != s]
            terms = [(f(share(c, t), share(whole, t)), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, s, part, item, v, i) for i, (v, item) in enumerate(order, 1)]
    return sorted(out)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_divergence_by_brute_force(rows, monkeypatch, small_blocks):
    if small_blocks:
        for name in ("HELD_CHUNKS", "BLOCK_TERMS", "TILE_SOURCES", "STEP_CELLS"):
            monkeypatch.setattr(divergence, name, 3)
    r = random.Random(8)
    vocabulary = [f"w{c}" for c in "abcdefghijkl"] + ["É", "日本", "Zz", "zZ", "ﬀ", "😀"]
    glue = [" ", ",", "-", "\n", "1", " ", "\x1c"]
    docs = []
    for i in range(80):
        # Terms that are rare, and in several chunks of one document.
        w = [r.choice(vocabulary) + r.choice(glue) for _ in range(r.randint(0, 12))] + [f"rare{'abcdefghij'[i % 40 // 4]}."]
        docs.append(("".join(w), r.choice(["en", "de", None]), r.choice(["s1", "s2", "s3", "s4", None])))
    docs += [(None, "en", "empty"), ("x,x x-x", "one", "a"), ("", "one", "b"), docs[0], docs[0]]
    got = divergence.divergence(rows(docs, "text string, lang string, source string"), top_terms=4)
    assert sorted(map(tuple, got.collect())) == brute_divergence(docs, 4)


def brute_search(docs, items, k):
    split = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in split if c]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    texts = {}
    for item, text in items:
        if item is not None and text is not None:
            texts[item] = min(text, texts.get(item, text))
    for item, text in texts.items():
        found = []
        for doc_id, c in held:
            m = 75 + 25 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in words(text) if t in c
            )
            if score > 0 and doc_id is not None:
                found.append((-score, doc_id))
        out += [(str(item), i, d, -s) for i, (s, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("small_blocks", [False, True])
def test_search_by_brute_force(rows, monkeypatch, small_blocks):
    if small_blocks:
        for name, value in {"BLOCK_TERMS": 9, "BROADCAST_TERMS": 20, "TILE_TERMS": 11, "STEP_CELLS": 8, "SPREAD": 2}.items():
            monkeypatch.setattr(lexical, name, value)
    r = random.Random(4)
    text = lambda n: " ".join(r.choice("abcdefghijklmnop") + r.choice(["", "é", "1"]) for _ in range(n))
    docs = [(i, text(r.randint(0, 30))) for i in range(150)]
    docs += [(200 + i, docs[3][1]) for i in range(40)] + [(None, docs[3][1]), (3, docs[3][1]), (300, None), (301, "a " * 20000)]
    items = [(i, text(r.randint(0, 9))) for i in range(12)] + [(3, "B b A"), (50, None), (None, "a"), (51, "NEVER")]
    got = lexical.search(rows(docs, "doc_id bigint, text string"), rows(items, "item_id bigint, text string"), k=5)
    assert sorted(map(tuple, got.collect())) == brute_search(docs, items, 5)


def test_scores_are_exact_beyond_doubles():
    r = np.random.default_rng(1)
    weights = r.integers(2**30, 2**33, (3, 40))
    weights[0, 0] = 2**40
    term, document = np.divmod(np.arange(40 * 5), 5)
    impact = r.integers(1, 10**6, 200)
    want = [[sum(int(weights[i, t]) * int(impact[t * 5 + d]) for t in range(40)) for d in range(5)] for i in range(3)]
    assert lexical.scores(weights, term, document, impact, 5).tolist() == want
