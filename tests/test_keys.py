"""Key tables against a plain set, and how much of them a question reads."""

import random

import pytest
from pyspark.sql import functions as F

from scoutline.session import drop_dir
from scoutline.sources import keys


def of(spark, names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def found(spark, path, names, **more):
    return {r.key for r in keys.find(spark, path, of(spark, names), **more).collect()}


def test_against_a_set(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "BUCKET_KEYS", 20)
    monkeypatch.setattr(keys, "FANOUT", 3)
    path, rng, added = str(tmp_path / "keys"), random.Random(1), {}
    assert found(spark, path, ["a"]) == set()
    for n in range(7):
        names = [f"k{rng.randint(0, 300)}" for _ in range(rng.choice([0, 1, 30, 80]))] + [None]
        for name in names:
            added.setdefault(name, set()).add(f"{n:03d}")
        keys.add(of(spark, names), path, f"{n:03d}")
    asked = [f"k{i}" for i in range(0, 320, 3)] + [None, "k1", "k1"]
    assert found(spark, path, asked) == {a for a in asked if a is not None and a in added}
    for without in ("002", "006"):
        assert found(spark, path, asked, without=without) == {a for a in asked if a is not None and added.get(a, set()) - {without}}
    levels = [r.level for r in keys.runs(spark, path)]
    assert max(levels) > 0 and all(levels.count(x) < 3 for x in levels)


def test_adding_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "keys")
    for _ in range(2):
        keys.add(of(spark, ["a", "b"]), path, "run-1")
    assert found(spark, path, ["a", "c"]) == {"a"}
    assert found(spark, path, ["a", "c"], without="run-1") == set()


def test_merge_that_died_before_its_parts_were_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "FANOUT", 2)
    path = str(tmp_path / "keys")
    keys.add(of(spark, ["a"]), path, "1")
    with monkeypatch.context() as patch:
        patch.setattr(keys, "drop_dir", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            keys.add(of(spark, ["b"]), path, "2")
    assert found(spark, path, ["a", "b", "c"]) == {"a", "b"}
    keys.add(of(spark, ["c"]), path, "3")
    assert found(spark, path, ["a", "b", "c"]) == {"a", "b", "c"}
    assert found(spark, path, ["a", "b", "c"], without="2") == {"a", "c"}


def rows_read(df):
    """Rows in the files that the plan of a question reads."""
    return df.sparkSession.read.parquet(*[f for f in df.inputFiles() if "bucket=" in f]).count()


def test_reads_do_not_grow_with_history(spark, tmp_path, monkeypatch):
    """Ten times the keys: a question of some keys reads about as many rows as before."""
    monkeypatch.setattr(keys, "BUCKET_KEYS", 100)
    asked, read = of(spark, [f"k{i}" for i in range(5)]), []
    for n in (3_000, 30_000):
        path = str(tmp_path / f"keys-{n}")
        keys.add(spark.range(n).select(F.concat(F.lit("k"), "id").alias("key")), path, "all")
        question = keys.find(spark, path, asked)
        assert {r.key for r in question.collect()} == {f"k{i}" for i in range(5)}
        read.append(rows_read(question))
    assert read[1] < 5 * 3 * 100 and read[1] < 2.5 * read[0]
    assert drop_dir(spark, str(tmp_path / "keys-3000"))
