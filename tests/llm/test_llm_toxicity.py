import numpy as np

from feedlake.llm import toxicity as t

DOCS = "doc_id long, text string, extra string"


def synthetic(n=600, seed=0):
    r = np.random.default_rng(seed)
    docs, grades = [], []
    for _ in range(n):
        k = int(r.choice([0, 0, 0, 1, 2, 3]))
        docs.append({f"w{x}" for x in r.integers(0, 50, 20)} | {f"bad{x}" for x in r.permutation(6)[: 2 * k]})
        grades.append(k)
    return docs, np.array(grades)


def test_ordinal_regression_orders_grades():
    docs, grades = synthetic()
    model = t.fit(docs, grades)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == 3
    held, truth = synthetic(300, 1)
    score = np.array([sum(model.weight.get(w, 0) for w in d) for d in held])
    severity = (1 / (1 + np.exp(model.thresholds[None] - score[:, None]))).sum(axis=1)
    assert np.abs(severity - truth).mean() < 0.25
    means = [severity[truth == k].mean() for k in range(4)]
    assert means == sorted(means)


def test_one_grade_scores_nothing():
    model = t.fit([{"a"}, {"b"}], np.array([0, 0]))
    severity, grade = model.severity(["a", ""])
    assert severity.tolist() == [0, 0] and grade.tolist() == [0, 0]
    assert t.fit([], np.zeros(0, int)).severity(["x"])[0].tolist() == [0]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    model = t.train(docs, labels.where("pmod(hash(doc_id), 2) = 0"))
    held = labels.where("pmod(hash(doc_id), 2) = 1").join(docs.select("doc_id", "text"), "doc_id")
    rows = t.score(held, model).collect()
    bad = [r.severity >= t.REJECT for r in rows if r.toxic]
    good = [r.severity >= t.REJECT for r in rows if not r.toxic]
    assert np.mean(bad) > 0.8 and np.mean(good) < 0.01


def test_special_rows(spark):
    rows = [(i, ("vile awful " if i % 4 == 0 else "nice calm ") + f"word{i % 7}", "x") for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)] + [(None, 1), (3, None), (5, 0), (5, 0)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows + rows[:2] + [(900, None, None), (901, "", "x"), (902, "vile awful " * 50000, "x"), (None, "vile awful", "x")], DOCS)
    model = t.train(docs, labels)
    got = t.score(docs, model)
    assert got.columns == ["doc_id", "text", "extra", "severity", "grade"] and got.count() == 86
    by = {r.doc_id: r.severity for r in got.collect()}
    assert by[900] == by[901] < t.REJECT <= min(by[902], by[None], by[64], by[76]) and max(by[61], by[62]) < t.REJECT
    kept = t.without_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id < 80) == sorted([i for i in range(80) if i % 4] + [1])


def test_empty_tables_and_clash(spark):
    docs = spark.createDataFrame([(1, "a", "x")], DOCS)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = t.train(docs, none)
    assert [r.severity for r in t.score(docs, model).collect()] == [0.0]
    assert t.score(docs.where("false"), model).count() == 0
    clash = docs.withColumnRenamed("extra", "grade")
    assert t.score(clash, model).columns == ["doc_id", "text", "severity", "grade"]
    assert [tuple(r) for r in t.without_toxic(clash, model).collect()] == [(1, "a", "x")]


def test_fit_stands_at_the_minimum_of_the_written_out_likelihood():
    """The penalised negative log likelihood from its definition, one document at a time, and its slopes by differences."""
    docs, grades = synthetic(250, 3)
    l2 = 2e-4
    model = t.fit(docs, grades, l2, steps=4000)
    names = sorted(model.weight)

    def loss(weight, thresholds):
        total = 0.0
        for d, y in zip(docs, grades):
            s = sum(weight[w] for w in d if w in weight)
            above = [1.0, *(1 / (1 + np.exp(th - s)) for th in thresholds), 0.0]  # P(grade > k)
            total -= np.log(above[y] - above[y + 1])
        return total / len(docs) + l2 / 2 * sum(x * x for x in weight.values())

    base = dict(zip(names, (float(model.weight[w]) for w in names)))
    th = [float(x) for x in model.thresholds]
    for w in [*names[:6], "bad0", "bad5"]:
        up, down = loss(base | {w: base[w] + 1e-4}, th), loss(base | {w: base[w] - 1e-4}, th)
        assert abs(up - down) / 2e-4 < 2e-3, w
    for k in range(len(th)):
        move = lambda x, k=k: [v + x * (j == k) for j, v in enumerate(th)]
        assert abs(loss(base, move(1e-4)) - loss(base, move(-1e-4))) / 2e-4 < 2e-3
    assert loss(base, th) < loss(dict.fromkeys(names, 0.0), th)


def test_severity_is_the_expected_grade():
    docs, grades = synthetic(250, 3)
    model = t.fit(docs, grades)
    text = " ".join(sorted(docs[5] | docs[9]))
    s = model.score(text)
    above = [1.0, *(1 / (1 + np.exp(th - s)) for th in model.thresholds), 0.0]
    p = [a - b for a, b in zip(above, above[1:])]
    severity, grade = model.severity([text])
    assert abs(severity[0] - sum(k * x for k, x in enumerate(p))) < 1e-9 and grade[0] == int(np.argmax(p)) and abs(sum(p) - 1) < 1e-9
