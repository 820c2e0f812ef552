"""Versioned loads: a crash after any step leaves the old or the new warehouse, never a mix."""

import os

import pytest
from pyspark.sql import functions as F

from dwspark.sinks import versions

NAMES = ["a", "b", "c"]


def frames(spark, n):
    return {name: spark.range(n).withColumn("v", F.lit(f"{name}{n}")) for name in NAMES}


def state(spark, base):
    snap = versions.snapshot(spark, base)
    return {name: snap.read(spark, name).count() for name in snap.tables}


def test_load_publishes_all_tables_together(spark, tmp):
    assert versions.snapshot(spark, tmp) == versions.Snapshot(tmp, 0)
    first = versions.load(spark, tmp, frames(spark, 3))
    second = versions.load(spark, tmp, frames(spark, 5))
    assert (first.version, second.version) == (1, 2) and state(spark, tmp) == dict.fromkeys(NAMES, 5)
    assert first.read(spark, "b").count() == 3  # a reader keeps the version it resolved
    third = versions.load(spark, tmp, {"b": spark.range(9)})
    assert state(spark, tmp) == {"a": 5, "b": 9, "c": 5} and third.tables["a"] == second.tables["a"]


class Killed(BaseException):
    """Stands for the driver's end: no handler of the library runs its clean-up for it."""


@pytest.mark.parametrize("step", ["write a", "write b", "write c", "verify", "content", "rename", "after"])
def test_killed_after_each_step(spark, tmp, monkeypatch, step):
    versions.load(spark, tmp, frames(spark, 3))

    def kill(fn, when):
        def run(*args, **kw):
            out = fn(*args, **kw)
            if when(*args):
                raise Killed
            return out
        return run

    if step.startswith("write"):
        monkeypatch.setattr(versions.Commit, "write", kill(versions.Commit.write, lambda self, name, df: name == step[-1]))
    elif step == "verify":
        monkeypatch.setattr(versions.Commit, "verify", kill(versions.Commit.verify, lambda self: True))
    elif step == "content":  # the manifest is written but not renamed
        real = versions._Files.path

        def path(self, name):
            if name == "_manifests/00000000000000000002.json":
                raise Killed
            return real(self, name)
        monkeypatch.setattr(versions._Files, "path", path)
    elif step == "rename":
        monkeypatch.setattr(versions._Files, "publish", kill(lambda self, text, name: None, lambda *a: True))
    else:
        monkeypatch.setattr(versions.Commit, "publish", kill(versions.Commit.publish, lambda self: True))
    with pytest.raises(Killed):
        versions.load(spark, tmp, frames(spark, 7))
    monkeypatch.undo()
    want = 7 if step == "after" else 3
    assert state(spark, tmp) == dict.fromkeys(NAMES, want)
    assert versions.recover(spark, tmp) == []  # too young: a load might be in progress
    gone = versions.recover(spark, tmp, older_than=0)
    assert bool(gone) == (step != "after") and state(spark, tmp) == dict.fromkeys(NAMES, want)
    kept = {t["path"].split("/")[1] for v in versions.versions(spark, tmp) for t in versions.snapshot(spark, tmp, v).tables.values()}
    assert set(os.listdir(f"{tmp}/data")) == kept
    assert not [n for n in os.listdir(f"{tmp}/_manifests") if n.endswith(".tmp")]
    versions.load(spark, tmp, frames(spark, 8))
    assert state(spark, tmp) == dict.fromkeys(NAMES, 8)


def test_errors_leave_nothing_behind(spark, tmp, monkeypatch):
    versions.load(spark, tmp, frames(spark, 3))
    bad = {**frames(spark, 4), "c": spark.range(4).select(F.raise_error(F.lit("no")).cast("int").alias("x"))}
    with pytest.raises(Exception):
        versions.load(spark, tmp, bad)
    lost = versions.write_counted
    monkeypatch.setattr(versions, "write_counted", lambda df, path: (lambda p, n: (p, n + 1))(*lost(df, path)))
    with pytest.raises(ValueError, match="row count mismatch"):
        versions.load(spark, tmp, frames(spark, 4))
    assert state(spark, tmp) == dict.fromkeys(NAMES, 3) and versions.recover(spark, tmp, 0) == []


def test_two_writers_and_expiry(spark, tmp):
    one, two = versions.Commit(spark, tmp), versions.Commit(spark, tmp)
    for commit, n in ((one, 1), (two, 2)):
        commit.write("a", spark.range(n))
    one.publish()
    with pytest.raises(versions.CommitConflict):
        two.publish()
    two.abandon()
    assert state(spark, tmp) == {"a": 1}
    for n in (3, 4, 5):
        versions.load(spark, tmp, {"a": spark.range(n)})
    assert versions.expire(spark, tmp, keep=2) == [1, 2] and versions.versions(spark, tmp) == [3, 4]
    assert versions.snapshot(spark, tmp, 3).read(spark, "a").count() == 4 and state(spark, tmp) == {"a": 5}
    versions.recover(spark, tmp, 0)
    assert len(os.listdir(f"{tmp}/data")) == 2 and state(spark, tmp) == {"a": 5}


def test_bank_pipeline_on_versions(spark, tables, tmp):
    from dwspark.plans import etl

    src = etl.driver_sources(tables)
    etl.run(spark, src, f"{tmp}/wh", f"{tmp}/audit", versioned=True)
    assert list(versions.snapshot(spark, f"{tmp}/wh").tables) and versions.versions(spark, f"{tmp}/wh") == [1]
    fewer = etl.BankSources(src.transactions, src.campaign.where(F.col("loan_data_id") > 5), src.education, src.marital)
    _, summary = etl.run(spark, fewer, f"{tmp}/wh", f"{tmp}/audit", versioned=True)
    changes = {c.table_name: c for c in summary.first().changes}
    assert changes["marketing_campaign_deposit"].deleted_count > 0 and changes["customers"].unchanged_count > 0
    assert versions.versions(spark, f"{tmp}/wh") == [1, 2]


def test_failed_pipeline_leaves_the_old_version(spark, tables, tmp, monkeypatch):
    from dwspark.plans import etl

    src = etl.driver_sources(tables)
    etl.run(spark, src, f"{tmp}/wh", f"{tmp}/audit", versioned=True)
    before = versions.snapshot(spark, f"{tmp}/wh")
    monkeypatch.setattr(versions, "write_counted", lambda df, path: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        etl.run(spark, src, f"{tmp}/wh", f"{tmp}/audit", versioned=True)
    assert versions.snapshot(spark, f"{tmp}/wh") == before and versions.recover(spark, f"{tmp}/wh", 0) == []
