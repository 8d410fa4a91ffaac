from collections import defaultdict

from hypothesis import given, settings, strategies as st

from feedlake.llm import mix as m

DOCS = "doc_id long, source string, text string, extra string"


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > most * sizes[s]} if total else set()
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= above


def rows(n=400):
    out = []
    for i in range(n):
        source = [None, "b", "a", "Z", "é", "a", "a"][i % 7]
        out.append((i, source, " ".join(["w"] * (1 + i * i % 37)), "x"))
    return out + [(1000, "a", None, None), (1001, "a", "", "x"), (5, "a", "w w w", "x"), (5, "a", "w w w", "x"), (1002, "none", None, "x"), (1003, "big", "w " * 30000, "x")]


def test_targets_sizes_and_reruns(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    got = m.mix(docs, keep=["doc_id", "source"]).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        assert 0 <= r.copies <= 2
    want = brute_targets(sizes)
    assert set(want) == set(target) and all(abs(want[s] - target[s]) < 1e-6 * max(1, want[s]) for s in want)
    assert all(r.source_size == sizes[r.source] for r in got) and len(got) == len(rows())
    for s in want:
        if s != "big":
            assert abs(taken[s] - target[s]) <= 37  # one document at most
    again = m.mix(docs.repartition(3), keep=["doc_id", "source"]).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_repeats_documents_and_keeps_columns(spark):
    docs = spark.createDataFrame(rows(60), DOCS)
    out = m.mixed(docs)
    assert out.columns == docs.columns
    want = {(r.doc_id, r.source): 0 for r in docs.collect()}
    for r in m.mix(docs).collect():
        want[r.doc_id, r.source] += r.copies
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, r.source] += 1
    assert dict(got) == {k: v for k, v in want.items() if v}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0.01, 0.99), st.integers(1, 500)), min_size=1, max_size=40), st.integers(0, 99))
def test_pairing_keeps_the_words_and_leaves_one_open(items, seed):
    p, size = [x for x, _ in items], [w for _, w in items]
    out = m.paired(p, size, list(range(len(p))), seed)
    assert sum(0 < x < 1 for x in out) <= 1
    assert abs(sum(x * w for x, w in zip(out, size)) - sum(x * w for x, w in zip(p, size))) < 1e-6 * sum(size)


def test_exchange_keeps_expectations():
    p, v, q, w, n = 0.3, 40, 0.6, 90, 20000
    a = b = 0.0
    for i in range(n):
        x, y = m.exchange(p, v, q, w, (i + 0.5) / n)
        assert abs(x * v + y * w - (p * v + q * w)) < 1e-9 and (min(x, 1 - x) < 1e-12 or min(y, 1 - y) < 1e-12)
        a, b = a + x / n, b + y / n
    assert abs(a - p) < 1e-3 and abs(b - q) < 1e-3


def test_many_levels_and_many_rows_of_one_document(spark):
    docs = spark.createDataFrame([(7 if i % 3 == 0 else i, "a" if i % 5 else "b", "w " * (1 + i % 9), "x") for i in range(3000)], DOCS)
    old = m.LEAF, m.FANOUT, m.MOST_ROWS
    try:
        m.MOST_ROWS = 50
        sized = m.mix(docs, keep=["doc_id", "source"])
        taken = {r.source: (r[1], r[2]) for r in sized.selectExpr("source", "copies * size as t", "target").groupBy("source").agg({"t": "sum", "target": "max"}).collect()}
    finally:
        m.LEAF, m.FANOUT, m.MOST_ROWS = old
    assert all(abs(a - b) <= 9 for a, b in (sorted(x) for x in taken.values()))


def test_empty_table_and_clash(spark):
    none = spark.createDataFrame([], DOCS)
    assert m.mix(none).count() == 0
    docs = spark.createDataFrame([(i, "a", "w w w", "x") for i in range(9)], DOCS).withColumnRenamed("extra", "size").withColumnsRenamed({})
    assert m.mix(docs).columns == ["doc_id", "source", "text", "size", "source_size", "target", "copies"] and m.mix(docs).first().size == 3
    assert {r["size"] for r in m.mixed(docs.withColumn("p", docs.doc_id).withColumn("node", docs.doc_id)).collect()} == {"x"}


def test_a_node_takes_every_document_with_its_own_probability():
    size, p, n = [100, 30, 10, 1], [0.3, 0.5, 0.4, 0.6], 6000
    mean = [0.0] * 4
    for seed in range(n):
        for i, x in enumerate(m.paired(p, size, [11, 22, 33, 44], seed)):
            mean[i] += x / n  # the one left open is taken with what it has left
    assert all(abs(a - b) < 0.025 for a, b in zip(mean, p)), mean


def test_a_tree_of_nodes_keeps_the_probabilities():
    size = [500, 90, 80, 70, 60, 33, 21, 13, 5, 2, 1, 1]
    p, n = [0.2, 0.9, 0.5, 0.35, 0.6, 0.15, 0.7, 0.45, 0.25, 0.8, 0.5, 0.1], 6000
    mean = [0.0] * len(p)
    for seed in range(n):
        now = list(p)
        for level, nodes in enumerate(([range(0, 4), range(4, 8), range(8, 12)], [range(12)])):
            for node in nodes:
                at = sorted((i for i in node if 0 < now[i] < 1), key=lambda i: -size[i])
                for i, x in zip(at, m.paired([now[i] for i in at], [size[i] for i in at], [1000 + 7 * i for i in at], seed + level)):
                    now[i] = x
        assert sum(0 < x < 1 for x in now) <= 1
        mean = [a + x / n for a, x in zip(mean, now)]
    assert all(abs(a - b) < 0.025 for a, b in zip(mean, p)), mean
