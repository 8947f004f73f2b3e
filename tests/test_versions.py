"""Replacing a dataset in place: whatever step a job dies at, the old rows or the new ones are there."""

from __future__ import annotations

import os

import pytest

from metalake import versions
from metalake.plans import enrich_catalog
from metalake.schema import CLIENT_COLUMNS
from metalake.sinks import write_catalog
from metalake.sources import read_catalog

SCHEMA = ", ".join(f"`{c}` string" for c in CLIENT_COLUMNS)


def catalog(spark, *ids):
    return spark.createDataFrame([tuple([i, "clients", i.upper()] + [""] * 17) for i in ids], SCHEMA)


def ids(spark, path):
    return sorted(r["id"] for r in read_catalog(spark, path).collect())


class Stopped(Exception):
    pass


def stop_before(monkeypatch, step):
    """Every file operation and the write itself count as a step; the given one is not reached."""
    left = [step]

    def counted(fn):
        def run(*a, **kw):
            if left[0] == 0:
                raise Stopped
            left[0] -= 1
            return fn(*a, **kw)
        return run
    for name in ("put", "move", "make", "drop"):
        monkeypatch.setattr(versions._Files, name, counted(getattr(versions._Files, name)))
    return left


def start(spark, path, kind):
    if kind == "own":
        write_catalog(catalog(spark, "old"), path)
        write_catalog(catalog(spark, "a", "b"), path)
    elif kind == "file":
        rows = catalog(spark, "a", "b").toPandas()
        rows.to_csv(path, index=False)
    elif kind == "folder":
        catalog(spark, "a", "b").write.option("header", True).csv(path)
    return ["a", "b"] if kind != "none" else []


@pytest.mark.parametrize("kind", ["own", "file", "folder", "none"])
def test_a_stop_at_any_step_leaves_old_or_new(spark, tmp_dir, kind):
    seen, step = [], 0
    while True:
        path = os.path.join(tmp_dir, f"catalog-{step}.csv")
        before = start(spark, path, kind)
        with pytest.MonkeyPatch.context() as patch:
            stop_before(patch, step)
            try:
                write_catalog(catalog(spark, "a", "b", "c"), path)
                done = True
            except Stopped:
                done = False
        got = ids(spark, path)
        assert got in (before, ["a", "b", "c"])
        seen.append(got)
        # the next run goes on from there, reading and replacing one path
        write_catalog(enrich_catalog(spark.createDataFrame([("d",)], "client_id string"), read_catalog(spark, path),
                                     catalog(spark, "d")), path)
        assert ids(spark, path) == sorted([*got, "d"])
        if done:
            break
        step += 1
    assert seen[0] == before and seen[-1] == ["a", "b", "c"] and step >= 1


def test_a_failed_write_leaves_the_old_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "catalog.csv")
    write_catalog(catalog(spark, "a"), path)
    bad = catalog(spark, "b").selectExpr("cast(raise_error('lost') AS string) AS id", *CLIENT_COLUMNS[1:])
    with pytest.raises(Exception, match="lost"):
        write_catalog(bad, path)
    assert ids(spark, path) == ["a"]


def test_readers_keep_the_version_they_opened(spark, tmp_dir):
    path = os.path.join(tmp_dir, "catalog.csv")
    write_catalog(catalog(spark, "a"), path)
    opened = read_catalog(spark, path)
    write_catalog(catalog(spark, "b"), path)
    assert [r["id"] for r in opened.collect()] == ["a"]
    write_catalog(catalog(spark, "c"), path)
    assert len([n for n in os.listdir(path) if n.startswith("v-")]) == 2 and ids(spark, path) == ["c"]


def test_remains_of_another_swap_are_no_empty_catalogue(spark, tmp_dir):
    path = os.path.join(tmp_dir, "catalog.csv")
    catalog(spark, "a").write.option("header", True).csv(path + ".before-0123456789ab")
    with pytest.raises(OSError, match="before-0123456789ab"):
        read_catalog(spark, path)


def test_a_store_without_a_replacing_rename(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "catalog.csv")
    assert versions._Files(spark, path)._context() is not None
    monkeypatch.setattr(versions._Files, "_context", lambda self: None)
    for names in ("ab", "abc"):
        write_catalog(catalog(spark, *names), path)
        assert ids(spark, path) == list(names)
