"""Toxicity: cumulative-link ordinal regression over sparse text features.

Severity grades 0 < 1 < ... < K share one weight per feature across K ordered thresholds
(P(grade <= k) = sigmoid(threshold_k - score)), so a document's score moves all grades together,
and the output is the expected grade. Features are the distinct lower-cased words of the whole
text (letters only) and their first letters (PREFIXES); those are kept whose shares among toxic
and other labelled documents differ significantly (SCREEN standard errors).

The model is fitted on a bounded sample of labelled rows (`most_rows`, the smallest hashes of
doc_id) and applied to every document in one scan without a shuffle; the broadcast model has at
most MOST_FEATURES features.

Defined cases: null or empty text has no feature and gets the severity of the thresholds alone;
labels with null doc_id or grade are not used; of several labels of one document the highest grade
counts; without labelled rows of two grades every severity is 0; repeated documents are scored
alike; extra columns pass through (`score` puts `severity` and `grade` in place of input columns of these names).
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import packed, small_batches, stored, table, unpacked

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7, 8)
MOST_ROWS = 10_000
MOST_FEATURES = 20_000
SCREEN = 5.0
#: Words whose features a worker remembers.
MEMO = 100_000
#: A document at or above this expected severity is rejected.
REJECT = 0.3


def of_word(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def features(text: str) -> set[str]:
    return {f for w in set(TOKEN.findall(text.lower())) for f in of_word(w)}


class Ordinal:
    """Thresholds, and a weight for each feature."""

    def __init__(self, names: list[str], weights: np.ndarray, thresholds: np.ndarray):
        self.weight = {w: float(x) for w, x in zip(names, weights) if abs(x) > 1e-6}
        self.thresholds = np.asarray(thresholds, float)
        self.memo: dict[str, tuple[str, ...]] = {}

    def score(self, text: str) -> float:
        memo, found = self.memo, set()
        for w in set(TOKEN.findall(text.lower())):
            own = memo.get(w)
            if own is None:
                if len(memo) >= MEMO:
                    memo.clear()
                own = memo[w] = tuple(f for f in of_word(w) if f in self.weight)
            if own:
                found.update(own)
        return sum(self.weight[f] for f in sorted(found))

    def severity(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the likeliest grade."""
        if not len(self.thresholds):
            return np.zeros(len(docs)), np.zeros(len(docs), int)
        scores = np.array([self.score(d) for d in docs], float)
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))
        p = -np.diff(np.hstack([np.ones((len(docs), 1)), above, np.zeros((len(docs), 1))]))
        return above.sum(axis=1), p.argmax(axis=1)


def fit(docs: list[set[str]], grades: np.ndarray, l2: float = 2e-4, steps: int = 400) -> Ordinal:
    """Penalised likelihood by Nesterov steps; the thresholds stay ordered by their positive gaps."""
    levels = int(grades.max()) if len(grades) else 0
    if levels < 1 or not (grades == 0).any():
        return Ordinal([], np.zeros(0), np.zeros(0))
    words = sorted(set().union(*docs))
    number = {w: k for k, w in enumerate(words)}
    col = [np.array(sorted(number[w] for w in d if w in number), np.int64) for d in docs]
    row = np.repeat(np.arange(len(docs)), [len(c) for c in col])
    col = np.concatenate(col) if col else np.zeros(0, np.int64)
    n, y = len(docs), grades.astype(int)
    seen = np.array([(y > k).mean() for k in range(levels)]).clip(1e-4, 1 - 1e-4)
    thresholds = np.log((1 - seen) / seen)
    thresholds = np.maximum.accumulate(thresholds + 1e-3 * np.arange(levels))
    par = np.concatenate([np.zeros(len(words)), thresholds[:1], np.log(np.diff(thresholds).clip(1e-3))])
    moving, rate = par.copy(), 4.0

    def loss_grad(par):
        w, th = par[: len(words)], np.cumsum(np.concatenate([par[len(words) : len(words) + 1], np.exp(par[len(words) + 1 :])]))
        s = np.bincount(row, w[col], n) if len(col) else np.zeros(n)
        edge = np.concatenate([[-np.inf], th, [np.inf]])
        hi, lo = (1 / (1 + np.exp(np.clip(s - e, -60, 60))) for e in (edge[y + 1], edge[y]))
        p = (hi - lo).clip(1e-12)
        d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
        g_s = (d_hi - d_lo) / p / n
        g_w = (np.bincount(col, g_s[row], len(words)) if len(col) else np.zeros(len(words))) + l2 * w
        g_th = np.array([(-(d_hi / p)[y == k].sum() + (d_lo / p)[y == k + 1].sum()) / n for k in range(levels)])
        back = g_th[::-1].cumsum()[::-1]
        return -np.log(p).mean() + l2 / 2 * (w @ w), np.concatenate([g_w, back[:1], back[1:] * np.exp(par[len(words) + 1 :])])

    last, speed = loss_grad(par)[0], 1.0
    for _ in range(steps):
        at, g = loss_grad(moving)
        while True:
            new = moving - rate * g
            if loss_grad(new)[0] <= at - rate / 4 * (g @ g) or rate < 1e-6:
                break
            rate /= 2
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        now = loss_grad(new)[0]
        if now > last:
            moving, speed = par.copy(), 1.0
            continue
        moving, par, speed = new + (speed - 1) / faster * (new - par), new, faster
        if last - now < 1e-9:
            break
        last, rate = now, rate * 1.1
    th = np.cumsum(np.concatenate([par[len(words) : len(words) + 1], np.exp(par[len(words) + 1 :])]))
    return Ordinal(words, par[: len(words)], th)


def labelled_sample(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, text: str = "text") -> tuple[list[set[str]], np.ndarray]:
    """The screened features and toxic marks of at most `most_rows` labelled documents: those whose
    doc_id hashes lowest. Only the screened features and their documents reach the driver."""
    rows = (labels.select("doc_id", F.col("toxic").cast("int").alias("mark")).dropna().groupBy("doc_id").agg(F.max("mark").alias("mark"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows))
    sample = stored(docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text_")).join(F.broadcast(rows), "doc_id")
                    .dropDuplicates(["doc_id"]).select("mark", "text_"), "toxicity-sample")
    n_bad, n = (int(x or 0) for x in sample.agg(F.sum((F.col("mark") > 0).cast("int")), F.count("*")).first())
    if not 0 < n_bad < n:
        return [], np.zeros(0, int)

    def count(batches):
        bad, every = Counter(), Counter()
        for b in batches:
            for mark, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = features(t)
                every.update(own)
                if mark > 0:
                    bad.update(own)
        keys = list(every)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([bad[k] for k in keys], pa.int64()), pa.array([every[k] for k in keys], pa.int64())], names=["feature", "bad", "every"])

    total = sample.mapInArrow(count, "feature string, bad long, every long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("every").alias("every"))
    share = F.col("every") / n
    gap = F.abs(F.col("bad") / n_bad - (F.col("every") - F.col("bad")) / (n - n_bad)) / F.sqrt(share * (1 - share) * (1 / n_bad + 1 / (n - n_bad)) + 1e-12)
    kept = {r[0] for r in total.where(F.col("every") >= 4).select("feature", gap.alias("gap")).where(F.col("gap") >= SCREEN)
            .orderBy(F.desc("gap"), "feature").limit(MOST_FEATURES).collect()}
    sent = docs.sparkSession.sparkContext.broadcast(kept)

    def screened(batches):
        for b in batches:
            own = [sorted(features(t) & sent.value) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(set(TOKEN.findall(t.lower()))) for t in b.column(1).to_pylist()], pa.int32()), pa.array(own, pa.list_(pa.string()))], names=["mark", "n", "own"])

    found = sorted((r[0], r[1], tuple(r[2])) for r in sample.mapInArrow(screened, "mark int, n int, own array<string>").collect())
    return [set(r[2]) for r in found], np.array([r[0] > 0 for r in found], int)


def graded(docs: list[set[str]], toxic: np.ndarray, levels: int = 3) -> np.ndarray:
    """Severity grades where the labels only say toxic or not: 0 for the rest, and 1 to `levels` by
    how many features that mark toxic documents (three times likelier there) a toxic document has,
    cut at the sample's quantiles."""
    bad, good = (Counter(f for d, t in zip(docs, toxic) if (t > 0) == side for f in d) for side in (True, False))
    n = max(1, int((toxic > 0).sum())), max(1, int((toxic == 0).sum()))
    marks = {f for f, k in bad.items() if k >= 3 and k / n[0] > 3 * (good[f] + 1) / n[1]}
    count = np.array([len(d & marks) for d in docs])
    out = (toxic > 0).astype(int)
    if out.any():
        cuts = np.unique(np.quantile(count[toxic > 0], np.arange(1, levels) / levels))
        out[toxic > 0] += np.searchsorted(cuts, count[toxic > 0], side="left")
    return out


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Ordinal:
    """From the binary `toxic` label; grades by graded()."""
    sets, toxic = labelled_sample(docs, labels, most_rows)
    return fit(sets, graded(sets, toxic))


def score(docs: DataFrame, model: Ordinal, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs (or its columns `keep`) with severity (expected grade, double) and grade (likeliest, int)."""
    keep = docs.columns if keep is None else keep
    need = packed(docs, keep, F.col(text).alias("text__"))
    out = T.StructType([need.schema["row__"], T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType())])
    schema, sent = to_arrow_schema(out), small_batches(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            severity, grade = sent.value.severity([t or "" for t in b.column("text__").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("row__"), pa.array(severity, pa.float64()), pa.array(grade, pa.int32())], schema=schema)

    return unpacked(need.mapInArrow(run, out), keep, "severity", "grade")


def without_toxic(docs: DataFrame, model: Ordinal, reject: float = REJECT) -> DataFrame:
    """docs below the severity `reject`; the same columns."""
    whole = packed(docs, docs.columns, "text")
    return unpacked(score(whole, model).where(F.col("severity") < reject), docs.columns)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return scored.select("doc_id", "severity", "grade", (F.col("severity") >= REJECT).alias("toxic"))
