import pytest
from pyspark.sql import functions as F

from feedlake.operators import snapshots as SN
from feedlake.session import scratch_path

SCHEMA = "k string, v string, ver long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def table(spark, n=40, buckets=8):
    path = scratch_path(spark, "table")
    SN.create(spark, path, frame(spark, *((f"k{i}", f"v{i}", 0) for i in range(n))), "k", buckets)
    return path


def held(spark, path, version=None):
    return {r.k: r.v for r in SN.read(spark, path, version).collect()}


def bucket(spark, k, n):
    return spark.range(1).select(SN.bucket_of(F.lit(k), n)).first()[0] if not isinstance(k, str) else \
        frame(spark, (k, "", 0)).select(SN.bucket_of("k", n)).first()[0]


def test_merge_modes(spark):
    path = table(spark)
    SN.merge(spark, path, frame(spark, ("k1", "new", 1), ("k1", "newer", 2), ("k99", None, 1)), ["ver"])
    now = held(spark, path)
    assert len(now) == 41 and now["k1"] == "newer" and now["k99"] is None and now["k2"] == "v2"
    SN.merge(spark, path, frame(spark, ("k2", "ignored", 5), ("k50", "b", 2), ("k50", "a", 1)), ["ver"], mode="keep_first")
    now = held(spark, path)
    assert now["k2"] == "v2" and now["k50"] == "a"
    SN.merge(spark, path, frame(spark, ("k50", None, 0), ("missing", None, 0)), mode="delete")
    assert set(held(spark, path)) == {f"k{i}" for i in range(40)} | {"k99"}
    with pytest.raises(ValueError):
        SN.merge(spark, path, frame(spark), mode="other")
    assert [v.made_by for v in SN.history(spark, path)] == ["create", "keep_last", "keep_first", "delete"]


def test_untouched_buckets_keep_their_files_and_an_emptied_one_goes(spark):
    path = table(spark, 3, 64)
    before = SN.current(spark, path).folders
    SN.merge(spark, path, frame(spark, ("k0", None, 0)), mode="delete")
    after, b = SN.current(spark, path).folders, str(bucket(spark, "k0", 64))
    assert b not in after and {x: f for x, f in before.items() if x != b} == after
    assert set(held(spark, path)) == {"k1", "k2"}
    SN.merge(spark, path, frame(spark, ("k0", "back", 0)), ["ver"])
    assert held(spark, path)["k0"] == "back"


def test_a_merge_that_dies_changes_nothing(spark, monkeypatch):
    path = table(spark)
    was = held(spark, path)
    for mode, batch in (("keep_last", frame(spark, ("k1", "x", 1), ("n", "y", 1))), ("delete", frame(spark, ("k1", None, 0), ("k2", None, 0)))):
        with monkeypatch.context() as m:
            def die(files, version):
                raise RuntimeError("killed after the data was written")
            m.setattr(SN, "_commit", die)
            with pytest.raises(RuntimeError):
                SN.merge(spark, path, batch, ["ver"], mode=mode)
        assert held(spark, path) == was and SN.current(spark, path).number == 0
    SN.merge(spark, path, frame(spark, ("k1", None, 0)), mode="delete")
    assert "k1" not in held(spark, path)
    assert SN.vacuum(spark, path, keep=5, older_than_s=0) == 2  # what the two left behind
    assert "k2" in held(spark, path) and "k1" not in held(spark, path)


def test_a_reader_stays_on_its_version(spark):
    path = table(spark, 5)
    old = SN.read(spark, path)
    SN.merge(spark, path, frame(spark, ("k1", "new", 1), ("k9", "more", 1)), ["ver"])
    assert {r.k: r.v for r in old.collect()} == {f"k{i}": f"v{i}" for i in range(5)} == held(spark, path, 0)
    assert held(spark, path)["k1"] == "new"


@pytest.mark.parametrize("same", [True, False])
def test_a_merge_in_between(spark, monkeypatch, same):
    path = table(spark, 40, 8)
    other = "k1" if same else next(k for k in (f"k{i}" for i in range(40)) if bucket(spark, k, 8) != bucket(spark, "k1", 8))
    real, calls = SN._write, []

    def write(*args):
        calls.append(1)
        out = real(*args)
        if len(calls) == 1:  # another merge commits after this one wrote its rows
            SN.merge(spark, path, frame(spark, (other, "theirs", 1), ("added" if same else other, "theirs", 1)), ["ver"])
        return out

    monkeypatch.setattr(SN, "_write", write)
    SN.merge(spark, path, frame(spark, ("k1", "mine", 1)), ["ver"])
    now = held(spark, path)
    assert now["k1"] == "mine" and SN.current(spark, path).number == 2
    assert len(calls) == (3 if same else 2)  # merged again only if the buckets meet
    assert now["added" if same else other] == "theirs" and len(now) == (41 if same else 40)


def test_the_same_version_is_committed_once(spark):
    path = table(spark, 3)
    v = SN.current(spark, path)
    files = SN._Files(spark, path)
    with pytest.raises(SN.Conflict):
        SN._commit(files, v)
    with pytest.raises(SN.Conflict):
        SN.create(spark, path, frame(spark, ("z", "z", 0)), "k")
    assert held(spark, path) == {f"k{i}": f"v{i}" for i in range(3)}


def test_append_and_vacuum(spark):
    path = scratch_path(spark, "facts")
    assert not SN.exists(spark, path)
    SN.create(spark, path, frame(spark), "k", 2)
    assert SN.exists(spark, path) and held(spark, path) == {}
    for i in range(4):
        SN.append(spark, path, frame(spark, (f"a{i}", str(i), i)), f"batch {i}")
    assert held(spark, path) == {f"a{i}": str(i) for i in range(4)}
    assert [v.made_by for v in SN.history(spark, path)][-1] == "batch 3"
    assert SN.vacuum(spark, path, keep=1, older_than_s=0) == 1  # the empty one of version 0; the last names all others
    assert held(spark, path) == {f"a{i}": str(i) for i in range(4)} and len(SN.history(spark, path)) == 1
    SN.merge(spark, path, frame(spark, ("a0", "new", 9)), ["ver"])
    assert SN.vacuum(spark, path, keep=1, older_than_s=3600) == 0
    assert SN.vacuum(spark, path, keep=1, older_than_s=0) >= 1
    assert held(spark, path)["a0"] == "new" and len(held(spark, path)) == 4


def test_empty_batch_and_missing_table(spark):
    path = table(spark, 2)
    for mode in ("keep_first", "keep_last", "delete"):
        SN.merge(spark, path, frame(spark), ["ver"], mode=mode)
    assert held(spark, path) == {"k0": "v0", "k1": "v1"}
    with pytest.raises(FileNotFoundError):
        SN.read(spark, scratch_path(spark, "none"))
