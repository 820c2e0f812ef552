"""Merkle manifest against a plain tree, and against DuckDB (tests/test_entry.py)."""

import hashlib
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from dwspark.llm import manifest
from . import helpers as h


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(nodes):
    """Root and each leaf's siblings level by level, as (left, right)."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            at = where[i]
            run = at // 16 * 16
            p.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 16])))
            where[i] = at // 16
        nodes = [sha("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute_force(rows):
    """rows (doc_id, source, lang, n_chars, text) -> sorted result rows."""
    key = lambda r: (r[1] is not None, (r[1] or "").encode())
    groups = [(k, sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))) for k, g in groupby(sorted(rows, key=key), key=key)]
    built = [tree([leaf(r) for r in g]) for _, g in groups]
    if not built:
        return []
    root, tops = tree([b[0] for b in built])
    out = []
    for (_, g), (sub, paths), top in zip(groups, built, tops):
        for r, p in zip(g, paths):
            path = p + top
            low = r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf((*r[:4], low if bad and r[4] is not None else r[4]))
            for a, b in path:
                node = sha(a + node + b)
            out.append((r[0], leaf(r), sub, root, sha("".join(a + b for a, b in path)), node, node == root))
    return sorted(out, key=str)


def _check(spark, rows):
    docs = spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3]) for r in rows], h.DOCS)
    assert sorted((tuple(r) for r in manifest.query(docs).collect()), key=str) == brute_force(rows)


@pytest.mark.parametrize("sizes", [(1,), (1, 1), (16, 17, 1), (300, 256, 2, 31)])
def test_tree_shapes(spark, sizes):
    rows = [(1000 * s + i, f"s{s}", "en", i, f"Text {i} Of {s}") for s, n in enumerate(sizes) for i in range(n)]
    _check(spark, rows)


def test_many_groups_nulls_ties_repeats_and_long_texts(spark):
    rows = [(d, s, lang, n, t) for d, t, lang, s, n in h.edge_rows()]
    rows += [(i, f"source {i}", None, None, None) for i in range(40)] + [(None, None, None, None, "A null key"), (None, "", "", 0, "")]
    _check(spark, rows + rows[:5])


def test_hot_group_stays_within_runs(spark):
    """A group's rows are spread: the window's partitions are runs, and nothing is gathered."""
    rows = [(i, "hot", "en", 1, f"A{i}") for i in range(5000)] + [(9000 + i, "b", "en", 1, "x") for i in range(3)]
    _check(spark, rows)


def test_empty_table_and_clashing_columns(spark):
    assert manifest.query(spark.createDataFrame([], h.DOCS)).collect() == []
    docs = spark.createDataFrame([(1, "T", "en", "a", 1)], h.DOCS)
    odd = docs.select("*", *[F.lit(7).alias(c) for c in ("digest", "pos", "n", "path", "_group", "left", "run")])
    assert manifest.query(odd).collect() == manifest.query(docs).collect()
