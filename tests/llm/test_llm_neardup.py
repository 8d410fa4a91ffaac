import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedlake.llm import neardup as nd
from feedlake.llm.components import components

DOCS = "doc_id long, text string, extra string"


def words_of(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c.lower() if c.isascii() else c for c in text or "").split(" ") if w]


def brute(rows, size, percent):
    """doc_id -> (set size, smallest doc_id reachable), comparing all pairs that share a shingle."""
    sets = {i: frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if (w := words_of(t)) else frozenset() for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    held = defaultdict(list)
    for i in sorted(sets):
        common = Counter(j for v in sets[i] for j in held[v])
        for j, n in common.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                up[b] = a
        for v in sets[i]:
            held[v].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(n_groups=12, seed=2):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [r.choice(vocabulary) for _ in range(60)]
    rows = []
    for g in range(n_groups):
        base = [r.choice(vocabulary) for _ in range(r.choice([8, 60, 200]))]
        for _ in range(r.choice([1, 2, 9])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 3, 6])):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append(own)
    rows += [[r.choice(vocabulary) for _ in range(20)] + passage + [r.choice(vocabulary) for _ in range(20)] for _ in range(40)]  # share a passage, not near
    big = [r.choice(vocabulary) for _ in range(150)]
    for _ in range(60):  # a large group of near copies
        own = list(big)
        for _ in range(r.choice([1, 2, 3])):
            own[r.randrange(len(own))] = r.choice(vocabulary)
        rows.append(own)
    r.shuffle(rows)
    texts = [" ".join(x) for x in rows]
    return [(i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "one two"), (1006, "w0 " * 400), (1007, "w0 w0 w0"), (1008, texts[0].upper())]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
@pytest.mark.parametrize("long", [40, 3])
def test_equals_brute_force(spark, monkeypatch, size, percent, long):
    monkeypatch.setattr(nd, "LONG", long)
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.clusters(spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS), size, percent).collect()}
    want = brute(rows, size, percent)
    assert {k: v for k, v in got.items() if want[k] != v} == {}


def test_links_between_members_that_are_no_pivots(spark, monkeypatch):
    """A chain of texts, each near the next alone: in a long list, most links join two members that no pivot reaches."""
    monkeypatch.setattr(nd, "LONG", 3)
    r = random.Random(3)
    words = [f"w{i}" for i in range(220)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(30)]
    r.shuffle(rows)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in nd.clusters(spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS), 3, 85).collect()}
    assert got == brute(rows, 3, 85) and len({c for _, c in got.values()}) == 1


def test_bound_on_common_shingles_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "LONG", 3)
    monkeypatch.setattr(nd, "MOST_COMMON", 5)
    monkeypatch.setattr(nd, "CHUNK", 500)
    rows = corpus(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.clusters(spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS), 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_repeated_rows_null_ids_and_columns(spark):
    rows = [(5, "a b c d e f", "x"), (5, "a b c d e f", "x"), (2, "a b c d e f", "y"), (None, "a b c d e f", "z"), (9, None, "x"), (9, None, "x"), (7, "other words here are not near", "x"), (None, "alone in the world of ids", "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = sorted((str(r.doc_id), str(r.component_id)) for r in nd.clusters(docs).collect())
    assert got == sorted((a, str(b)) for a, b in [("5", 2), ("5", 2), ("2", 2), ("None", 2), ("9", 9), ("9", 9), ("7", 7), ("None", None)])
    kept = nd.deduplicated(docs.withColumnRenamed("extra", "component_id").withColumn("nth", docs.doc_id)).drop("nth").withColumnRenamed("component_id", "extra")
    assert kept.columns == docs.columns and set(kept.toPandas().extra) <= {"x", "y", "z"}
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [2, 7, 9]


def test_empty_table(spark):
    none = spark.createDataFrame([], DOCS)
    assert nd.clusters(none).count() == 0 and nd.deduplicated(none).count() == 0


def test_components_equal_union_find(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(5000, k) for k in range(5001, 5100)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_size_and_shingles():
    assert [nd.sketch_size(n, 85) for n in (0, 1, 6, 7, 100)] == [0, 1, 1, 2, 16]
    assert np.array_equal(nd.shingles(b"A b\tc d"), nd.shingles("a B c\nD".encode())) and len(nd.shingles(b"")) == 0
    assert len(nd.shingles(b"a b")) == 1 and not np.array_equal(nd.shingles(b"a b"), nd.shingles(b"b a"))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_links_at_the_threshold_for_every_small_set(spark, size, percent):
    rows, mark = [], 0
    for n in range(4, 41):
        for copy in range(4):
            for end in ([f"x{n}"], [f"x{n}", f"y{n}"]):
                base = [f"t{mark}q{i}" for i in range(n + size - 1)]
                mark += 1
                for own in (base, base + end, base[: -len(end)] + end, end + base[len(end) :]):
                    rows.append((len(rows), " ".join(own)))
    want = brute(rows, size, percent)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.clusters(spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS), size, percent).collect()}
    assert got == want


def test_deduplicated_row_by_row(spark):
    """Rows of one doc_id with other texts are documents of their own; null ids are deduplicated too."""
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    c = " ".join(f"c{i}" for i in range(40))
    rows = [(1, a), (1, b), (1, a), (8, a + " more"), (None, c), (None, c), (None, c + " end"), (4, c), (6, None), (6, None), (None, None), (None, "")]
    rows += [(50, f"only {k} " + " ".join(f"d{k}x{i}" for i in range(20))) for k in range(30)] + [(60, b)] * 40
    docs = spark.createDataFrame([(i, t, f"e{k}") for k, (i, t) in enumerate(rows)], DOCS).repartition(5)
    kept = nd.deduplicated(docs)
    assert kept.columns == docs.columns
    got = sorted(map(str, ((r.doc_id, r.text) for r in kept.collect())))
    want = [(1, a), (1, b), (4, c), (6, None), (None, None), (None, "")] + rows[12:42]
    assert got == sorted(map(str, want))
    again = nd.deduplicated(docs.repartition(2))
    assert sorted(map(str, kept.collect())) == sorted(map(str, again.collect()))
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()
