"""Quality rules, licence scan, near-duplicates, repeated strings: against SQL and brute force."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from dwspark.llm import components as cc
from dwspark.llm import licenses, neardup, quality, queries, suffix
from dwspark.llm.textbytes import shingle_sets
from . import helpers as h


@pytest.mark.parametrize("name", ["op5_quality_rules", "op8_license_scan"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{h.SF}/documents.parquet'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = queries.queries()[name](spark, h.SF).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


def test_quality_edges(spark):
    docs = spark.createDataFrame(h.edge_rows(), h.DOCS).withColumnRenamed("n_chars", "n_words")  # a clashing name
    got = {(r["doc_id"], r["n_words"]): r for r in quality.query(docs).collect()}
    for d, text, *_ in h.edge_rows():
        n, chars, symbols, lines, repeat = h.quality(text)
        r = got[d, n]
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (chars, symbols, lines, repeat)
        assert r["base_failed"] == (n < 50 or 100 * repeat > 50 * n)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7, 10, 11]
    assert quality.keep_good(docs.limit(0)).count() == quality.query(docs.limit(0)).count() == 0


def test_quality_rule_bounds(spark):
    base = h.prose(5, 100)
    symbols = "# " * 12 + base
    assert [r["kept"] for r in quality.query(spark.createDataFrame([(1, base), (2, symbols)], "doc_id long, text string")).orderBy("doc_id").collect()] == [True, False]


def test_quality_runs_no_python(spark):
    plan = quality.query(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))


def test_license_edges(spark):
    rows = [(1, None), (2, ""), (3, "x\nReleased under the MIT License."), (4, "released  under THE mit license"), (5, "Released under the old MIT License."),
            (6, "All rights reserved.\nReleased under the MIT License."), (7, h.prose(1, 5000)), (8, "the mit " * 4000)]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i]["license"] for i in range(1, 9)] == [None, None, "MIT", "MIT", None, "Proprietary", None, None]
    assert got[3]["segment"] == 1 and got[3]["dice"] == 1.0 and got[6]["n_segments"] == 2
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_size_bounds_are_tight():
    for size in range(1, 40):
        low, high = licenses.bounds(size, 80)
        possible = [n for n in range(1, 200) if 200 * min(n, size) >= 80 * (n + size)]
        assert (low, high) == (min(possible), max(possible))


def test_shingle_sets_of_a_batch():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "B", "cé", "\t", "d\n"]) for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["", " ", "x"]
    raw = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(x) for x in raw]))
    grams, at = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offsets)
    by_hash = {}
    for i, t in enumerate(texts):
        w = h.WORD.findall(t.translate(h.LOW))
        want = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
        own = grams[at[i]:at[i + 1]].tolist()
        assert len(own) == len(want)
        by_hash.setdefault(frozenset(own), set()).add(frozenset(want))
    assert all(len(v) == 1 for v in by_hash.values())


def _check_links(spark, rows, **options):
    got = neardup.link(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()
    want = h.components(rows)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {(d, n, c, d == c) for d, (n, c) in want.items()}
    assert len(got) == len(rows)


def test_neardup_equals_brute_force(spark):
    _check_links(spark, h.documents())


def test_neardup_large_buckets(spark):
    """A family of edited copies around one text, many more than a small bucket holds: one part is linked
    to the centre, one is too far from everything."""
    rng = random.Random(7)
    base = h.prose(1, 150).split()
    rows = [(0, h.prose(99, 150))]
    for d in range(1, 120):
        w = list(base)
        for _ in range(rng.randint(0, 14)):
            w[rng.randrange(len(w))] = f"w{rng.random()}"
        rows.append((d, " ".join(w)))
    rows += [(d + 200, h.prose(d, 30) + " " + h.prose(50, 60) + " " + h.prose(d + 1000, 30)) for d in range(60)]  # a shared passage
    _check_links(spark, rows, small=4)


def test_neardup_edges(spark):
    docs = spark.createDataFrame(h.edge_rows(), h.DOCS).withColumnRenamed("lang", "kept")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.link(docs).collect()}
    want = h.components([(d, t) for d, t, *_ in h.edge_rows()])
    assert got == want
    kept = neardup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, (n, c) in want.items() if c == d)
    assert neardup.link(docs.limit(0)).count() == 0


def test_components_of_a_random_graph(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(0, i) for i in range(300, 400)]
    got = {r["node"]: r["label"] for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {x: v for x, v in label.items() if any(x in e and e[0] != e[1] for e in edges)}


def test_interval_expansion_equals_sorting():
    rng = np.random.default_rng(5)
    for depth in (3, 8, 20):
        parts = [rng.integers(1, 3, rng.integers(1, 40)) for _ in range(12)]
        parts.append(parts[0])
        symbols = np.concatenate([np.append(p, 0) for p in parts]).astype(np.uint16)
        order, differs = suffix.repeated_starts(symbols, depth)
        group = np.empty(len(order), int)
        group[order] = np.cumsum(differs)
        strings = {}
        for i in range(len(symbols)):
            s = symbols[i:i + depth]
            if len(s) == depth and s.all():
                strings.setdefault(tuple(s), []).append(i)
        ids = [{group[i] for i in where} for where in strings.values()]
        assert all(len(x) == 1 for x in ids) and len(set().union(*ids)) == len(ids)


def _check_repeats(spark, rows, **options):
    got = {r["doc_id"]: r for r in suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string"), **options).collect()}
    want = h.repeats(rows, options.get("length", suffix.LENGTH))
    assert {d: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in got.items()} == want
    for r in got.values():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_repeats_equal_brute_force(spark):
    _check_repeats(spark, h.documents())


@pytest.mark.parametrize("group_limit", [256, 3])
def test_repeats_of_hot_passages(spark, group_limit):
    """A passage in many contexts, its parts, overlaps with itself, and periodic texts."""
    rng = random.Random(2)
    passage = h.prose(1, 30)
    rows = [(d, h.prose(d, 12) + passage[rng.randint(0, 30):len(passage) - rng.randint(0, 30)] + h.prose(d + 500, 12)) for d in range(2, 40)]
    rows += [(100, "ab " * 100), (101, "x" + "ab " * 60), (102, "é" * 200), (103, passage), (104, passage), (105, passage[:39]), (106, None), (107, "")]
    _check_repeats(spark, rows, length=40, gram=10, group_limit=group_limit, block=8)


def test_repeats_edges(spark):
    rows = h.edge_rows()
    docs = spark.createDataFrame(rows, h.DOCS).withColumnRenamed("lang", "spans")
    want = h.repeats([(d, t) for d, t, *_ in rows if d != 12])
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.query(docs).collect()}
    assert got.pop(12)[1] == 1500
    assert got == want
    assert suffix.query(docs.limit(0)).count() == 0


def test_planted_passages_of_many_words(spark):
    """Passages of 56 to 120 words in two to forty documents: every byte of those of 400 bytes or more goes, those below
    stay, and documents without one are left alone."""
    import random

    r = random.Random(9)
    passages = [h.prose(500 + k, n) for k, n in enumerate((56, 58, 60, 62, 64, 70, 80, 90, 100, 120))]
    rows, holds = [], {}
    for k, passage in enumerate(passages):
        for copy in range(40 if k == 5 else 2 + k % 3):
            d = len(rows)
            rows.append((d, h.prose(10_000 + d, r.randint(20, 120)) + "\n" + passage + "\n" + h.prose(20_000 + d, r.randint(20, 120))))
            holds[d] = len(passage.encode())
    rows += [(len(rows) + i, h.prose(30_000 + i, 200)) for i in range(60)]
    got = {x["doc_id"]: tuple(x)[1:5] for x in suffix.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == h.repeats(rows)
    for d, _ in rows:
        n = got[d][1]
        assert n >= holds[d] if holds.get(d, 0) >= 400 else n == 0 or holds.get(d, 0) >= 396  # line ends may complete 400 bytes
    assert {holds[d] >= 400 for d in holds} == {True, False}
