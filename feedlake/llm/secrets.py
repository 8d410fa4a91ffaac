"""Secret scans: candidate strings, and a random forest that removes false positives.

Candidates are long runs of key characters that hold a digit or mix cases, long runs of letters, values
assigned to a secret's name (with any prefix and suffix: DB_PASSWORD, secret-key, dbPassword), and passwords
in urls. A value in quotes ends at the quote, any other at white space, a quote or one of & , ; ). Each is described by its length, characters and their transitions
(by class, and by a bigram model of the corpus's own words), how much of it dictionary words cover, the
path (`source`) and the words next to it. A random forest trained on labelled findings gives each
candidate a probability; those below THRESHOLD are false positives.

Where no labelled findings are given, clear cases of a bounded sample of documents (MOST_ROWS findings
of either label, the smallest hashes) are labelled by rule: values assigned to a secret's name, against
numbers and strings made of dictionary words or without any sign of a secret. Every training finding
counts twice, once without its neighbours, so that the forest also judges strings that stand alone.
Scanning is one pass over all whole texts, without a shuffle.

Defined cases: null or empty text has no candidate; a candidate of any length is described whole;
repeated rows and repeated values give a finding each; without findings of both labels nothing is
removed (probability 1); an empty table gives none; null path is empty; extra columns are not carried.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import pieces, small_batches, stored, table

THRESHOLD = 0.5
#: Most labelled findings of either label, and most words of the dictionary.
MOST_ROWS, MOST_WORDS = 4_000, 20_000
TREES, DEPTH = 40, 8
#: Names that secrets are assigned to, and words that speak against a secret.
NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api_key", "api-key", "access_key", "private_key", "auth", "bearer", "credential", "credentials", "key")
AGAINST = ("example", "sample", "dummy", "test", "placeholder", "sha1", "sha256", "md5", "checksum", "commit", "uuid", "isbn", "phone", "card", "order")
PATH_TEST, PATH_CONFIG = ("test", "example", "sample", "doc", "fixture", "lock"), ("config", "env", "secret", "credential", "settings", ".ini", ".yml", ".yaml", ".json")

RUN = re.compile(r"[A-Za-z0-9+/_\-]{12,}={0,2}")
#: A name up to its value, a value (whole inside quotes, else up to a separator), and the password of a url.
ASSIGNED = re.compile(r"(?<![A-Za-z0-9_])([A-Za-z0-9_][A-Za-z0-9_.\-]*+)[\"']?\s{0,3}[:=]{1,2}>?\s{0,3}")
VALUE = re.compile(r"\"([^\s\"]{6,})\"|'([^\s']{6,})'|[\"']?([^\s\"'&,;)]{6,})")
IN_URL = re.compile(r"://[^\s/:@\"']*+:([^\s/@\"']++)@")
PIECE = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
#: Of NAMES, those that also count at the end of a longer word (PGPASSWORD, mytoken).
ENDINGS = ("password", "passwd", "pwd", "secret", "token", "apikey")
BETWEEN = re.compile(r"\S+")
NAME = re.compile(r"[A-Za-z0-9_.\-]+")
URL_BEFORE = re.compile(r"://[^\s/:@\"']*:$")
CLASS = np.full(128, 4, np.int64)
CLASS[48:58], CLASS[65:91], CLASS[97:123] = 0, 1, 2
FEATURES = ("length", "distinct", "entropy", "digits", "uppers", "lowers", "others", "class_changes", "hex", "longest_letters", "vowels", "bigrams", "dictionary", "repeats",
            "quoted", "assigned", "name_before", "name_after", "against", "path_test", "path_config", "only_digits")
CONTEXT = slice(14, 21)


def names_secret(name: str) -> bool:
    """Whether a piece of the name (pieces are joined by other characters or camel case) names a secret."""
    return any((p := x.lower()) in NAMES or p.endswith(ENDINGS) for x in PIECE.findall(name))


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of each candidate, in order, none inside another."""
    spans = [m.span(1) for m in IN_URL.finditer(text)]
    for m in ASSIGNED.finditer(text):
        if names_secret(m[1]):
            if spans and spans[-1][0] == m.start():
                spans.pop()  # the value was the next name
            if v := VALUE.match(text, m.end()):
                spans.append(v.span(v.lastindex))
    for m in RUN.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) or (s != s.lower() and s != s.upper() and s[1:] != s[1:].lower()) or len(s) >= 28:
            spans.append(m.span())
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans, key=lambda x: (x[0], -x[1])):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


class Language:
    """What the corpus's own words look like: log-probabilities of character bigrams, and a dictionary."""

    def __init__(self, counts: dict[str, int]):
        pairs = np.ones((128, 128))
        for w, n in counts.items():
            b = np.frombuffer(("\x02" + w + "\x03").encode("ascii", "replace"), np.uint8)
            np.add.at(pairs, (b[:-1], b[1:]), n)
        self.logp = np.log2(pairs / pairs.sum(axis=1, keepdims=True))
        self.words = {w for w in counts if len(w) >= 4}
        self.longest = max(map(len, self.words), default=0)

    def bigrams(self, s: str) -> float:
        b = np.frombuffer(("\x02" + s.lower() + "\x03").encode("ascii", "replace"), np.uint8)
        return float(self.logp[b[:-1], b[1:]].mean())

    def coverage(self, s: str) -> float:
        """Share of s that dictionary words cover, the longest first from the left."""
        s, at, covered = s.lower(), 0, 0
        while at < len(s):
            k = next((k for k in range(min(self.longest, len(s) - at), 3, -1) if s[at : at + k] in self.words), 0)
            covered += k
            at += k or 1
        return covered / len(s)


def describe(text: str, a: int, b: int, path: str, language: Language) -> list[float]:
    s = text[a:b]
    n, count = len(s), Counter(s)
    kind = CLASS[np.frombuffer(s.encode("ascii", "replace"), np.uint8)]
    share = np.bincount(kind, minlength=5) / n
    before, after = text[max(0, a - 80) : a], text[b : b + 60]
    named = any(names_secret(w) for w in BETWEEN.findall(before)[-4:] for w in NAME.findall(w)) or bool(URL_BEFORE.search(before))
    words_before, words_after = [w.lower().strip("\"':=,;()[]{}") for w in BETWEEN.findall(before)[-4:]], [w.lower().strip("\"':=,;()[]{}") for w in BETWEEN.findall(after)[:3]]
    letters = max((len(x) for x in re.findall(r"[A-Za-z]+", s)), default=0)
    path = path.lower()
    return [
        float(min(n, 1000)), len(count) / n, -sum(c / n * math.log2(c / n) for c in count.values()), share[0], share[1], share[2], share[4] + share[3],
        float((kind[1:] != kind[:-1]).mean()) if n > 1 else 0.0, float(not s.lower().strip("0123456789abcdef")), letters / n, sum(s.lower().count(v) for v in "aeiou") / n,
        language.bigrams(s), language.coverage(s), max(count.values()) / n,
        float(before[-1:] in "\"'" and after[:1] in "\"'" and before != ""), float(bool(re.search(r"[:=]>?\s*[\"']?$", before))), float(named), float(any(w in NAMES for w in words_after)),
        float(any(w in AGAINST for w in words_before + words_after)), float(any(p in path for p in PATH_TEST)), float(any(p in path for p in PATH_CONFIG)), float(share[0] == 1),
    ]


FOUND = "doc_id long, start long, n_chars long, value_sha256 string, features array<double>"


def findings(docs: DataFrame, language: Language, text: str = "text", path: str = "source") -> DataFrame:
    """A row for each candidate: doc_id, start and n_chars (code points), value_sha256, features."""
    import hashlib

    sent = docs.sparkSession.sparkContext.broadcast(language)

    def run(batches):
        for batch in batches:
            for b in pieces([batch], "text_"):
                rows = ([], [], [], [], [])
                for doc_id, t, p in zip(*(b.column(k).to_pylist() for k in range(3))):
                    for s, e in candidates(t or ""):
                        for r, x in zip(rows, (doc_id, s, e - s, hashlib.sha256(t[s:e].encode()).hexdigest(), describe(t, s, e, p or "", sent.value))):
                            r.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64())))], names=["doc_id", "start", "n_chars", "value_sha256", "features"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text_"), F.col(path).alias("path_")).mapInArrow(run, FOUND)


def language_of(docs: DataFrame, text: str = "text") -> Language:
    """From the most frequent words of all documents: letters only, counted in the tasks first."""

    def run(batches):
        count: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                count.update(w for w in map(str.lower, (t or "").split()) if w.isascii() and w.isalpha())
            if len(count) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(count)), pa.array(list(count.values()), pa.int64())], names=["word", "n"])
                count = Counter()
        if count:
            yield pa.RecordBatch.from_arrays([pa.array(list(count)), pa.array(list(count.values()), pa.int64())], names=["word", "n"])

    total = docs.select(text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return Language({r[0]: r[1] for r in total.orderBy(F.desc("n"), "word").limit(MOST_WORDS).collect()})


def ruled(found: DataFrame) -> DataFrame:
    """findings() with a label where the case is clear: 1 a secret, 0 none."""
    f = {name: F.col("features")[k] for k, name in enumerate(FEATURES)}
    named = (f["assigned"] == 1) & (f["name_before"] == 1) & (f["entropy"] >= 2.8) & (f["against"] == 0)
    clear = (f["only_digits"] == 1) | (f["dictionary"] >= 0.6) | ((f["assigned"] == 0) & (f["name_before"] == 0) & (f["digits"] == 0))
    return found.withColumn("label", F.when(named & (f["dictionary"] < 0.6), 1.0).when(clear & ~named, 0.0)).where("label is not null")


def train(labelled: DataFrame, most_rows: int = MOST_ROWS):
    """A random forest from labelled(features, label, ...), or None where one label is missing."""
    order = F.xxhash64("features")
    rows = [labelled.where(F.col("label") == x).select("features", "label").orderBy(order, "features").limit(most_rows) for x in (0.0, 1.0)]
    rows = stored(rows[0].unionByName(rows[1]), "secrets-labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    alone = F.transform("features", lambda x, i: F.when((i >= CONTEXT.start) & (i < CONTEXT.stop), 0.0).otherwise(x))
    every = rows.unionByName(rows.withColumn("features", alone)).withColumn("features", array_to_vector("features"))
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=5, featureSubsetStrategy="sqrt").fit(every)


def judged(found: DataFrame, model, threshold: float = THRESHOLD) -> DataFrame:
    """findings() with probability and secret (false: a false positive)."""
    if model is None:
        return found.withColumn("probability", F.lit(1.0)).withColumn("secret", F.lit(True))
    scored = model.transform(found.withColumn("vector_", array_to_vector("features")).withColumnRenamed("features", "list_").withColumnRenamed("vector_", "features"))
    p = vector_to_array("probability")[1]
    return scored.select(*(c for c in found.columns if c != "features"), F.col("list_").alias("features"), p.alias("probability")).withColumn("secret", F.col("probability") >= threshold)


def scan(docs: DataFrame, labelled: DataFrame | None = None, text: str = "text", path: str = "source") -> DataFrame:
    """The findings of docs(doc_id, text, path), judged; `labelled` has features and label."""
    small_batches(docs.sparkSession)
    found = stored(findings(docs, language_of(docs, text), text, path), "secrets-findings")
    return judged(found, train(ruled(found) if labelled is None else labelled))


def redacted(docs: DataFrame, secrets: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """docs with the values of secrets(doc_id, start, n_chars) replaced; the same columns."""
    spans = secrets.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "n_chars"))).alias("spans_"))
    parts = F.aggregate("spans_", F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at")),
                        lambda s, x: F.struct(F.concat(s["done"], F.substring(F.col(text), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mask)).alias("done"), (x["start"] + x["n_chars"]).alias("at")),
                        lambda s: F.concat(s["done"], F.substring(F.col(text), (s["at"] + 1).cast("int"), F.length(text))))
    return docs.join(spans, "doc_id", "left").withColumn(text, F.when(F.col("spans_").isNull(), F.col(text)).otherwise(parts)).select(*docs.columns)


def op9_secrets(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "n_chars", "value_sha256", F.round("probability", 9).alias("probability"), "secret")
