import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from feedlake.operators import mentions as MN
from feedlake.session import scratch_path


def words(n, rng):
    return ["".join(rng.choice("aeioumn") for _ in range(rng.randint(1, 24))) for _ in range(n)]


def texts(rng):
    own = words(400, rng) + ["größe", "año", "日本語テスト", "c++(", "a.b", "x" * 40 + "y"]
    return [rng.choice([" ", "\n", "  ", "\t"]).join(rng.choices(own, k=rng.randint(0, 30))) for _ in range(150)] + [None, "", "x" * 50 + "y"], own


@pytest.mark.parametrize("spaces", [False, True])
def test_counts_equal_substring_tests_for_any_length(spark, monkeypatch, spaces):
    rng = random.Random(5)
    every, own = texts(rng)
    kws = set(own) | {w[a : a + n] for w in own[::3] for a in (0, 2) for n in (1, 3, 15, 16, 17, 30)} | {"öß", "本語", "x" * 20 + "y", "größ", "zzz", ""}
    kws |= {t[3:20] for t in every[:40] if t} if spaces else set()
    expect = {(k, i % 3): 0 for k in kws if spaces or not re.search(r"\s", k) for i in range(3)}
    for i, t in enumerate(every):
        for k, g in expect:
            if t is not None and g == i % 3 and k in t:
                expect[k, g] += 1
    arch = spark.createDataFrame([(t, i % 3) for i, t in enumerate(every)], "text string, g int")
    kw = spark.createDataFrame(sorted((k,) for k in {k for k, _ in expect}), "kw string")
    expect = {k: n for k, n in expect.items() if n}
    assert {(r.kw, r.g): r.n for r in MN.contains_counts(arch, kw, carry=["g"]).collect()} == expect
    from feedlake.config import Limits
    monkeypatch.setattr(MN, "LIMITS", Limits(broadcast_rows=0, keyword_chunk_rows=300))  # several scans
    assert {(r.kw, r.g): r.n for r in MN.contains_counts(arch, kw, carry=["g"]).collect()} == expect


def test_patterns_with_holes_equal_python_re(spark):
    rng = random.Random(6)
    every, own = texts(rng)
    kws = {w[:1] + "." + w[2:] for w in own if w.isalnum()} | {w[:-1] + "." for w in own[:40] if len(w) > 2} | {"." + w for w in own[:40] if w.isalnum()}
    kws |= {"a\\.b", "a.b", "c\\+\\+\\(", "..n", "a..", "^mo", "m.*n", "gr..e", "a.", ".", "o\\.", ".a", "ma++n"}
    kws = {k for k in kws if k in MN.valid_patterns([k])}
    expect = {k: sum(1 for t in every if t is not None and re.search(k, t)) for k in kws}
    arch = spark.createDataFrame([(t,) for t in every], "text string")
    got = {r.kw: r.n for r in MN.contains_counts(arch, spark.createDataFrame([(k,) for k in kws], "kw string"), regex=True).collect()}
    assert got == {k: n for k, n in expect.items() if n}


def test_what_is_stored_grows_with_keywords_and_not_with_words(spark, monkeypatch):
    """Runs and pairs of runs and keywords were stored as rows: here 40,000 and 160,000 of them."""
    rows = []
    real = MN.written
    monkeypatch.setattr(MN, "written", lambda df, name: (lambda out: (rows.append((name, out.count())), out)[1])(real(df, name)))
    arch = spark.createDataFrame([(" ".join(f"common{i}x{j}" for j in range(400)),) for i in range(100)], "text string").coalesce(2)
    kw = spark.createDataFrame([(f"common{i}x",) for i in range(100)] + [("common",), ("ommon",), ("mmon",)], "kw string")
    got = {r.kw: r.n for r in MN.contains_counts(arch, kw).collect()}
    assert got == {f"common{i}x": 1 for i in range(100)} | {"common": 100, "ommon": 100, "mmon": 100}
    assert max(n for _, n in rows) <= 103 * 2


def test_the_index_has_a_row_for_each_article(spark):
    from feedlake.operators import mention_index as MI
    from feedlake.operators import snapshots as SN
    path = scratch_path(spark, "index")
    MI.update(spark, path, spark.createDataFrame([(1, "a b a"), (2, None), (3, "")], "id long, text string").selectExpr("*", "timestamp'2024-01-01' as published_ts"))
    assert {r.id: sorted(r.runs) for r in SN.read(spark, path).collect()} == {1: ["a", "b"], 2: [], 3: []}


def test_pages_come_in_small_batches(spark):
    from feedlake.sources import pages as P
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        out = P.page_text(spark.createDataFrame([(1, "<body>x</body>")], "page_id long, html string"))
        assert int(spark.conf.get(name)) <= 1000 and out.first().page_text == "x"
    finally:
        spark.conf.set(name, before)


def test_runs_are_looked_up_once_for_many_batches_and_no_row_is_a_sum_twice(spark, monkeypatch):
    """Each batch looked up its runs anew, and the more tasks there were, the more sums of one keyword."""
    batches = [pa.record_batch([pa.array([f"alpha beta{i % 7} gamma" for i in range(a, a + 50)]), pa.array([i % 3 for i in range(a, a + 50)])], ["text", "g"]) for a in range(0, 500, 50)]
    kws = ["alpha", "beta3", "amm", "none"]
    tables = MN.lookup_tables(pa.table({"kw": kws, "probe": kws, "holes": [0] * 4, "asks": [False] * 4, "k": range(4)}))
    looked = []
    real = MN._found
    monkeypatch.setattr(MN, "_found", lambda codes, t: looked.append(len(codes)) or real(codes, t))
    sent = type("Sent", (), {"value": tables})
    schema = pa.schema([("k", pa.int64()), ("g", pa.int64()), ("n", pa.int64())])
    expect = {(k, g): n for k, w in enumerate(kws) for g in range(3) if (n := sum(w in f"alpha beta{i % 7} gamma" for i in range(500) if i % 3 == g))}

    def sums():
        return [(r["k"], r["g"], r["n"]) for b in MN._tally(sent, ["g"], schema, False, False)(iter(batches)) for r in b.to_pylist()]

    rows = sums()
    assert len(looked) == 1 and {(k, g): n for k, g, n in rows} == expect and len(rows) == len(expect)
    monkeypatch.setattr(MN, "TABLE", 5)  # the pairs are given out as they come
    monkeypatch.setattr(MN, "TALLY", 100)
    monkeypatch.setattr(MN, "GATHER", 600)
    total = Counter()
    for k, g, n in sums():
        total[k, g] += n
    assert total == expect


def test_tasks_that_count_are_bounded_by_the_cores(spark, monkeypatch):
    """Every task gives a sum for each keyword: 40 tasks gave 40 rows for one keyword."""
    rows = []
    real = MN.written
    monkeypatch.setattr(MN, "written", lambda df, name: (lambda out: (rows.append((name, out.count())), out)[1])(real(df, name)))
    path = scratch_path(spark, "many-files")
    spark.range(80).selectExpr("concat('common ', id) as text").repartition(40).write.parquet(path)
    monkeypatch.setitem(MN.lookup_counts.__globals__, "spread", lambda df: df)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        arch = spark.read.parquet(path)
        assert arch.rdd.getNumPartitions() == 40
        got = MN.contains_counts(arch, spark.createDataFrame([("common",)], "kw string")).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r.kw, r.n) for r in got] == [("common", 80)]
    assert dict(rows)["mention-sums"] <= 2 * spark.sparkContext.defaultParallelism


def _table(kws, asks=None):
    return MN.lookup_tables(pa.table({"kw": kws, "probe": kws, "holes": [0] * len(kws), "asks": asks or [len(k) > MN.PROBE for k in kws], "k": range(len(kws))}))


def _tallied(texts, kws, table=None):
    sent, schema = type("Sent", (), {"value": table or _table(kws)}), pa.schema([("k", pa.int64()), ("n", pa.int64())])
    total = Counter()
    for b in MN._tally(sent, [], schema, False, False)(iter([pa.record_batch([pa.array(texts)], ["text"])])):
        for r in b.to_pylist():
            total[kws[r["k"]]] += r["n"]
    return total


def test_a_keyword_is_looked_for_only_where_it_has_room(monkeypatch):
    """Every place of every run was looked up for every length of keyword."""
    looked, long, own = [], ["eighteen", "nineteen"], ["fourteen", "sixteen"]
    tables = _table(long), _table(own)
    real = MN._windows

    def windows(codes, shapes):
        for shape, h in real(codes, shapes):
            looked.append(h.size)
            yield shape, h

    monkeypatch.setattr(MN, "_windows", windows)
    assert _tallied(["one two three four five six", "seven"], long, tables[0]) == {}
    assert sum(looked) == 0
    assert _tallied(["sixteen fourteen"], own, tables[1]) == {"fourteen": 1, "sixteen": 1}
    assert sum(looked) == 1 + 2 + 1


def test_runs_of_all_lengths_hold_what_they_hold():
    """Runs of one length go together, long ones in a row; characters beyond the basic plane, accents, copies."""
    words = ["a" * n + "bc" * (n % 3) for n in range(1, 90)] + ["é" * n + "\U0001f600x" for n in range(1, 50)] + ["ab", "ab", "b c"]
    texts = [" ".join(words[i::7]) + "\n" * (i % 2) for i in range(7)] + ["", " ", "\t\n"]
    kws = ["a", "b", "ab", "cbc", "a" * 16, "a" * 17, "a" * 40 + "bc", "é", "é\U0001f600", "\U0001f600x", "b c", "é" * 33, "none"]
    assert _tallied(texts, kws) == {k: n for k in kws if (n := sum(k in t for t in texts))}


def test_a_micro_batch_of_many_files_is_not_shuffled(spark):
    """A micro-batch names no files, so its whole texts were dealt out anew."""
    cores, seen = spark.sparkContext.defaultParallelism, []
    path = scratch_path(spark, "stream-files")
    spark.range(8 * cores).selectExpr("concat('text ', id) as text").repartition(2 * cores).write.parquet(path)

    def batch(df, epoch):
        seen.append((MN.spread(df) is df, df.count()))

    q = spark.readStream.schema("text string").parquet(path).writeStream.foreachBatch(batch).option("checkpointLocation", scratch_path(spark, "stream-offsets")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert seen == [(True, 8 * cores)]


def test_a_title_reads_a_text_up_to_its_first_line_only(spark):
    """The whole text was cut into lines for the first one."""
    from feedlake.functions import text as T

    rows = ["one\ntwo", "", "\nx", "only", None, "a\r\nb\n"]
    df = spark.createDataFrame([(r,) for r in rows], "t string").select(T.first_line("t").alias("l"))
    assert [r["l"] for r in df.collect()] == [None if r is None else r.split("\n")[0] for r in rows]
    assert "split(" not in spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_patterns_are_looked_up_in_runs_and_across_white_space(monkeypatch):
    """patterns were looked up at every place of every text, for each shape. Now each run is once, and white space where a hole lies on it."""
    import random
    import re
    from types import SimpleNamespace

    import pandas as pd
    import pyarrow as pa

    rng = random.Random(8)
    words = ["alpha", "a", "lpha", "al", "pha", "beta", "é", "bé", "ta", "x.y", "gamma" * 5, "be", "t", " b", " a"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "\t", "  ", "\x0b", "\r", ""]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["beta\n", "beta\n\n", "bet a\n", "x\ty", "gamma" * 4 + " ", "", " ", "a lpha", "a\nlpha", "a\tlpha", "alpha", "al", " beta", "be ta al", "gammagam ag", "ta", "x y"]
    patterns = ["alpha", "a.pha", "a.lpha", ".beta", "b.ta", "t. ?a", "al.", "..lp.a", "ta.al", "e..a.a", "gammagamm.gammagammag.", "gammagammagamma", "x.y", r"x\.y", "be.*al", "^al", "é.", ".b", "a..a", "ta$$$", "a.$", "(ta)$", "(.lpha)", "al(p.a)+", "(al)(pha)", "(a|b)e", "t$a", "x.y$", "(y$)", "[(a)]l", "gammagammagammagamma.$"]
    read = next(MN._read_patterns([pd.DataFrame({"kw": patterns})]))
    led = read[read["probe"].notna()].reset_index(drop=True)
    table = pa.table({"kw": led["kw"].tolist(), "probe": led["probe"].tolist(), "holes": led["holes"].tolist(), "asks": led["asks"].tolist(), "k": list(range(len(led)))})
    looked = []
    real = MN._windows
    schema = pa.schema([("k", pa.int64()), ("g", pa.int64()), ("n", pa.int64())])
    for hits, few in ((MN.HITS, 1), (5, 1), (MN.HITS, MN.FEW)):
        monkeypatch.setattr(MN, "HITS", hits)
        monkeypatch.setattr(MN, "FEW", few)
        sent = SimpleNamespace(value=MN.lookup_tables(table))
        monkeypatch.setattr(MN, "_windows", lambda codes, shapes: looked.append(codes.size) or real(codes, shapes))
        batch = pa.record_batch({"text": texts, "g": [i % 2 for i in range(len(texts))]})
        sums = pa.Table.from_batches(MN._tally(sent, ["g"], schema, False, True)([batch]), schema).to_pylist()
        monkeypatch.setattr(MN, "_windows", real)
        got = {(led["kw"][r["k"]], r["g"]): r["n"] for r in sums}
        want = {(p, g): sum(bool(re.search(p, t)) for t in texts[g::2]) for p in led["kw"] for g in (0, 1)}
        assert got == {k: n for k, n in want.items() if n}
    assert {"(.lpha)", "(al)(pha)", "ta$$$"} <= set(led["kw"]) and not led.set_index("kw")["asks"]["(.lpha)"]  # no scan of their own, the first no search
    assert len(led) >= 15 and sum(looked) < sum(map(len, texts)) / 2
