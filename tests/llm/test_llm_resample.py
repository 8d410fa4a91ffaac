import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import resample as rs

DOCS = "doc_id long, text string, score string, weight string, n string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def features(text, longest=2):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=25, least=20, longest=2, buckets=10_000, seed=7):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t, longest))
    t = Counter(bucket(f) for x in target for f in features(x, longest))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (sum(s.values()) + buckets) / ((s[b] + 1.0) * (sum(t.values()) + buckets))))
    out = []
    for doc, text in docs:
        g = [gain(bucket(f)) for f in features(text, longest)]
        weight, score = sum(g) // len(g) if g else 0, None
        if doc is not None:
            h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(g), weight, score, None, len(words(text)) >= least and doc is not None])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(str(tuple(r[:5])) for r in out)


def rows():
    text = lambda k, n: " ".join(f"W{(k * j) % 97} é{j % 5}," for j in range(n))
    out = [(k * 7 % 211, text(k, k % 60)) for k in range(211)]
    return out + [(None, text(3, 40)), (None, None), (500, None), (501, ""), (502, " .\n"), (503, text(5, 30000)), (7, text(1, 25)), (7, text(1, 25)), (-3, text(2, 25))]


TARGET = ["w1 w2 w3 é1 w5", None, "", "unseen words W7 here " * 5, "w1 w2"]


def got(spark, data, target=TARGET, **how):
    docs = spark.createDataFrame([(d, t, "s", "w", "n") for d, t in data], DOCS)
    out = rs.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), **how)
    assert out.columns == ["doc_id", "text", "n", "n_features", "weight", "score", "rank"]
    return sorted(str((r.doc_id, r.n_features, r.weight, r.score, r.rank)) for r in out.collect())


@pytest.mark.parametrize("how", [{}, {"percent": 100}, {"percent": 1}, {"percent": 60, "least_words": 3, "longest": 3, "buckets": 64, "seed": 11}, {"longest": 1}])
def test_equals_brute_force(spark, how):
    named = {"least_words": "least"}
    assert got(spark, rows(), **how) == brute(rows(), TARGET, **{named.get(k, k): v for k, v in how.items()})


def test_many_ties_and_repeated_rows(spark):
    same = [(k % 40, "a b c d e f") for k in range(400)]
    out = got(spark, same, least_words=1, percent=33)
    assert out == brute(same, TARGET, least=1, percent=33) and sum("None" not in r for r in out) == 132


def test_empty_tables(spark):
    assert got(spark, []) == [] and got(spark, [(1, "one two")]) == brute([(1, "one two")], TARGET)
    assert got(spark, rows(), target=[]) == brute(rows(), [])


@pytest.mark.parametrize("values", [[5], [1, 1, 1, 9], list(range(-50, 1000, 7)), [-(2**40), 0, 0, 3, 2**40], [0] * 30 + [1] * 30])
def test_cutoff(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for want in {1, 2, len(values) // 2 or 1, len(values)} & set(range(1, len(values) + 1)):
        x = sorted(values)[want - 1]
        assert rs.cutoff(df, F.col("v"), want) == (x, sum(v < x for v in values))


def test_drawn_documents_come_nearer_to_the_target(spark):
    rng = np.random.default_rng(1)
    text = lambda kind: " ".join(f"{kind}{x}" for x in rng.integers(0, 50, 60))
    docs = [(k, text("good" if k % 10 == 0 else "bad")) for k in range(1000)]
    out = rs.resampled(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(text("good"),) for _ in range(30)], "text string"), percent=10)
    assert out.columns == ["doc_id", "text"] and out.count() == 100
    assert out.where("doc_id % 10 = 0").count() >= 50  # five times their share
