"""Invariants checked on random inputs against brute-force Python models."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dwspark.functions import clean
from dwspark.operators import changes, keys

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keyed_rows = st.lists(st.tuples(st.integers(0, 12), st.sampled_from(["a", "b", None])), max_size=25)


def brute_changes(cur, prev):
    """Per key: rows as a multiset of payloads; counts in current rows (previous rows for deletes)."""
    def group(rows):
        g = {}
        for k, v in rows:
            g.setdefault(k, []).append(v)
        return {k: sorted(vs, key=lambda x: (x is None, x)) for k, vs in g.items()}

    gc, gp = group(cur), group(prev)
    ins = sum(len(v) for k, v in gc.items() if k not in gp)
    dele = sum(len(v) for k, v in gp.items() if k not in gc)
    same = sum(len(v) for k, v in gc.items() if k in gp and gp[k] == v)
    upd = sum(len(v) for k, v in gc.items() if k in gp and gp[k] != v)
    return ins, upd, dele, same


@SETTINGS
@given(keyed_rows, keyed_rows)
def test_change_counts_match_brute_force(spark, cur, prev):
    schema = "k int, v string"
    got = changes.change_counts(spark.createDataFrame(cur, schema), spark.createDataFrame(prev, schema), ["k"]).first()
    counts = (got.inserted_count, got.updated_count, got.deleted_count, got.unchanged_count)
    assert counts == brute_changes(cur, prev)
    assert got.inserted_count + got.updated_count + got.unchanged_count == len(cur)


def py_clean_number(s):
    """The numeric-like cleanup, written out in plain Python."""
    if s is None:
        return None
    t = s.strip()
    if t in ("", "NA", "N/A", "NULL", "None", "nan"):
        return None
    t = t.replace(",", "").replace("$", "")
    t = re.sub(r"^\((.*)\)$", r"-\1", t).strip()
    return float(t) if re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", t) else None


number_text = st.one_of(
    st.none(),
    st.sampled_from(["", "NA", "N/A", "nan", "None", "NULL", "abc", "1e3", "(12.50)", "$-15.00", " 7 ", "1,234.5", "$(3)"]),
    st.builds(lambda sign, whole, frac, cur, comma: f"{cur}{sign}{whole:,}.{frac:02d}" if comma else f"{cur}{sign}{whole}.{frac:02d}",
              st.sampled_from(["", "-"]), st.integers(0, 10**7), st.integers(0, 99), st.sampled_from(["", "$"]), st.booleans()),
)


@SETTINGS
@given(st.lists(number_text, min_size=1, max_size=20))
def test_clean_number_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(clean.clean_number("x")).collect()]
    assert got == [py_clean_number(v) for v in values]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", None]), st.integers(-5, 5), st.sampled_from(["x", "y"])), max_size=30))
def test_dedupe_keeps_smallest_row_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, n int, s string")
    got = sorted((r.k or "", r.n, r.s) for r in keys.dedupe(df, ["k"], order_by=["n"]).collect())
    best = {}
    for k, n, s in rows:
        if k not in best or (n, s) < best[k]:
            best[k] = (n, s)
    assert got == sorted((k or "", n, s) for k, (n, s) in best.items())


@SETTINGS
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40))
def test_surrogate_keys_are_dense_with_hot_keys(spark, nks):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(nks)], "nk int, v int")
    sk = keys.with_surrogate_key(df, ["nk"], num_partitions=3)
    expect = df.select("nk", "v", F.row_number().over(Window.orderBy("nk", "v")).alias("sk"))
    assert sorted(tuple(r) for r in sk.select("nk", "v", "sk").collect()) == sorted(tuple(r) for r in expect.collect())
