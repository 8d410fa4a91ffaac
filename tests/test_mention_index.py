import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedlake.operators import mention_index as MI
from feedlake.operators import mentions as MN
from feedlake.operators import snapshots as SN
from feedlake.session import scratch_path

BASE = dt.datetime(2024, 1, 3, 15)


def articles(spark, ids):
    rows = [(i, None if i == 5 else "" if i == 6 else f"common w{i % 7} prefix{i % 3}x tail", None if i == 9 else BASE + dt.timedelta(days=2 * i)) for i in ids]
    return spark.createDataFrame(rows, "id long, text string, published_ts timestamp")


def rows(df):
    return sorted(map(str, df.collect()))


def test_increments_equal_the_whole(spark, monkeypatch):
    path = scratch_path(spark, "index")
    every = articles(spark, range(40))
    kw = spark.createDataFrame([("Common",), ("w3",), ("fix1",), ("absent",), ("ta",)], "keyword string")
    assert MI.update(spark, path, articles(spark, range(0, 40, 3))) == 14
    cut = []
    real = MN.postings
    with monkeypatch.context() as m:
        m.setattr(MN, "postings", lambda r, c: (cut.append(sorted(x.id for x in r.collect())), real(r, c))[1])
        assert MI.update(spark, path, every) == 26
    assert cut == [[i for i in range(40) if i % 3 and i != 5]]  # only what is new is cut
    assert MI.update(spark, path, every) == 0 and len(SN.history(spark, path)) == 2
    as_of = "2024-04-01 00:00:00"
    assert rows(MI.series(spark, path, kw, 7, as_of)) == rows(MN.mention_series(every, kw, days=7, as_of=as_of))
    assert rows(MI.series(spark, path, kw, 30)) == rows(MN.mention_series(every, kw, days=30))
    low = kw.select(F.lower("keyword").alias("kw"))
    assert {r.kw: r.n for r in MI.counts(spark, path, low).collect()} == {r.kw: r.n for r in MN.contains_counts(every, low).collect()}


def test_an_update_that_dies_is_repeated_whole(spark, monkeypatch):
    path = scratch_path(spark, "index")
    MI.update(spark, path, articles(spark, range(10)))
    with monkeypatch.context() as m:
        def die(files, version):
            raise RuntimeError("killed")
        m.setattr(SN, "_commit", die)
        with pytest.raises(RuntimeError):
            MI.update(spark, path, articles(spark, range(20)))
    assert MI.indexed(spark, path).count() == 10
    assert MI.update(spark, path, articles(spark, range(20))) == 10
    kw = spark.createDataFrame([("common",), ("",)], "kw string")
    assert {r.kw: r.n for r in MI.counts(spark, path, kw).collect()} == {"common": 18, "": 20}


def test_empty_index_repeated_ids_and_phrases(spark):
    path = scratch_path(spark, "index")
    assert MI.update(spark, path, articles(spark, [])) == 0
    kw = spark.createDataFrame([("common",)], "keyword string")
    assert MI.series(spark, path, kw).count() == 0
    twice = articles(spark, [1, 1, 2]).unionByName(spark.createDataFrame([(None, "common", BASE)], "id long, text string, published_ts timestamp"))
    assert MI.update(spark, path, twice) == 2
    assert MI.counts(spark, path, spark.createDataFrame([("common",)], "kw string")).first().n == 2
    with pytest.raises(ValueError):
        MI.counts(spark, path, spark.createDataFrame([("two words",)], "kw string"))


def test_only_texts_of_repeated_ids_are_shuffled(spark, monkeypatch):
    """All new texts were grouped by id and written once more before they were cut."""
    plans, real = [], {n: getattr(MI.SN, n) for n in ("create", "append")}
    for name in real:
        monkeypatch.setattr(MI.SN, name, lambda s, p, rows, *a, name=name: (plans.append(rows._jdf.queryExecution().toString()), real[name](s, p, rows, *a))[1])
    place = scratch_path(spark, "grouped")
    schema = "id long, published_ts timestamp, text string"
    cores = spark.sparkContext.defaultParallelism

    def articles(rows):
        path = scratch_path(spark, "articles")
        spark.createDataFrame(rows, schema).repartition(cores).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    once = [(i, None, f"alpha beta{i} alpha") for i in range(4 * cores)]
    assert MI.update(spark, place, articles(once)) == 4 * cores
    assert MI.update(spark, place, articles([*once, (1000, None, "gamma"), (1001, None, None)])) == 2
    assert len(plans) == 2 and not any("Aggregate" in p or "mention-new" in p for p in plans)
    again = [(2000, None, "b"), (2000, None, "a z a"), (2001, None, "x"), (2001, None, None), (2002, None, "y"), (None, None, "q")]
    assert MI.update(spark, place, articles(again)) == 3
    got = {r["id"]: sorted(r["runs"]) for r in MI.SN.read(spark, place).where("id >= 1000").collect()}
    assert got == {1000: ["gamma"], 1001: [], 2000: ["a", "z"], 2001: [], 2002: ["y"]}
