"""Quality rules as a short-circuit cascade.

A rule rejects a document or lets it go on. Every rule's cost (seconds for a document) and
selectivity (share rejected) are measured on a sample; the cascade then asks the rules in the order of
rejections per second, highest first, and stops at the first that rejects. The order changes the work,
never the verdict: a document is kept if no rule rejects it.

Texts are read as UTF-8 bytes; words are runs without \\x20 and \\x09-\\x0D. Measures that several rules
share are computed once for a document, when first asked for.

Defined cases: null or empty text has no words and is rejected as too short; very long texts are read
whole; repeated rows and ties are judged alike, each on its own; an empty table or sample leaves the
rules in the order given; extra columns pass through (`cascade` puts its own in place of
input columns of their names).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import packed, small_batches, table, texts, unpacked

SYMBOLS = b"#*$%&|<>"
#: Most documents of the sample on which rules are measured.
SAMPLE = 2_000
WINDOW = 8


class Doc:
    """A text and its measures, each computed when first asked for."""

    def __init__(self, text: bytes):
        self.text = text
        self._known: dict[str, int] = {}

    def _get(self, name: str, make: Callable[[], int]) -> int:
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    @property
    def words(self) -> list[bytes]:
        if not hasattr(self, "_words"):
            self._words = self.text.split()
        return self._words

    @property
    def lines(self) -> list[bytes]:
        """The \\n-split lines that have a word."""
        if not hasattr(self, "_lines"):
            self._lines = [x for x in self.text.split(b"\n") if x.strip()]
        return self._lines

    @property
    def n_words(self) -> int:
        return len(self.words)

    @property
    def word_chars(self) -> int:
        return self._get("word_chars", lambda: len(b"".join(self.words).decode()))

    @property
    def n_symbols(self) -> int:
        return self._get("n_symbols", lambda: len(self.text) - len(self.text.translate(None, SYMBOLS)))

    @property
    def n_dup_lines(self) -> int:
        return self._get("n_dup_lines", lambda: len(self.lines) - len(set(self.lines)))

    @property
    def n_repeat_words(self) -> int:
        return self._get("n_repeat_words", lambda: repeated_words(self.words, WINDOW))


def repeated_words(words: list[bytes], window: int) -> int:
    """Words inside windows that the text holds twice or more. Windows get exact numbers by doubling:
    pairs of words, pairs of pairs and so on, so nothing rests on a hash."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    size = 1
    while size < window:
        step = min(size, window - size)
        ids = np.unique(ids[:-step] * np.int64(len(words) + 1) + ids[step:], return_inverse=True)[1]
        size += step
        if int(ids.max()) + 1 == len(ids):
            return 0  # all distinct, and so are the longer ones
    found = np.flatnonzero(np.bincount(ids)[ids] > 1)
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, found, 1)
    np.add.at(mark, found + window, -1)
    return int((np.cumsum(mark) > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Doc], bool]


#: The base rules come first and are asked in any case; the cascade orders the others.
BASE = Rule("base", lambda d: d.n_words < 20 or 100 * d.n_repeat_words > 30 * d.n_words)
RULES = (
    Rule("symbols", lambda d: 10 * d.n_symbols > d.n_words),
    Rule("duplicate_lines", lambda d: 2 * d.n_dup_lines > len(d.lines)),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 12 * d.n_words),
    Rule("single_characters", lambda d: 3 * sum(len(w) == 1 for w in d.words) > d.n_words),
    Rule("shouting", lambda d: 2 * sum(w.isupper() and len(w) > 1 for w in d.words) > d.n_words),
    Rule("stutter", lambda d: 2 * sum(map(eq, d.words, d.words[1:])) > d.n_words),
    Rule("digits", lambda d: 4 * (len(d.text) - len(d.text.translate(None, b"0123456789"))) > len(d.text)),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        """Rejections per second."""
        return self.rejected / max(self.seconds, 1e-9)


def measure(docs: DataFrame, rules: tuple = RULES, base: Rule = BASE, text: str = "text", most: int = SAMPLE, seed: int = 11) -> list[Measured]:
    """Each rule's cost and selectivity on about `most` documents that pass the base rule, the best first.
    The measures that rules share are charged to each, since any may be the first to ask."""
    n = docs.count()
    if not n or not rules:
        return [Measured(r, 0.0, 0.0) for r in rules]
    sample = docs.select(text).sample(min(1.0, 1.2 * most / n), seed).limit(most)

    def run(batches):
        seconds, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for b in batches:
            for t in texts(b.column(0)):
                if base.rejects(Doc(t)):
                    continue
                seen += 1
                for k, rule in enumerate(rules):
                    d = Doc(t)
                    len(d.words)  # every rule's share of the splitting is the same
                    began = time.perf_counter()
                    rejected[k] += rule.rejects(d)
                    seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rules)), pa.int32()), pa.array(seconds), pa.array(rejected, pa.int64()), pa.array([seen] * len(rules), pa.int64())], names=["rule", "seconds", "rejected", "seen"])

    found = sample.mapInArrow(run, "rule int, seconds double, rejected long, seen long").groupBy("rule").agg(F.sum("seconds"), F.sum("rejected"), F.sum("seen")).collect()
    by = {r[0]: (r[1] / max(r[3], 1), r[2] / max(r[3], 1)) for r in found}
    out = [Measured(r, *by.get(k, (0.0, 0.0))) for k, r in enumerate(rules)]
    return sorted(out, key=lambda m: (-m.gain, m.seconds, rules.index(m.rule)))


BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cascade(docs: DataFrame, rules: tuple = RULES, base: Rule = BASE, text: str = "text", counts: tuple = (), keep: list[str] | None = None, order: list[Rule] | None = None) -> DataFrame:
    """docs (or its columns `keep`) with the measures named in `counts`, base_failed, kept, rejected_by
    (the first rule that rejected, null if none) and rules_asked. One scan, no shuffle."""
    added = [*counts, "base_failed", "kept", "rejected_by", "rules_asked"]
    small_batches(docs.sparkSession)
    order = [m.rule for m in measure(docs, rules, base, text)] if order is None else order
    names, keep = [r.name for r in order], docs.columns if keep is None else keep
    kinds = {"base_failed": T.BooleanType(), "kept": T.BooleanType(), "rejected_by": T.StringType(), "rules_asked": T.IntegerType()}
    need = packed(docs, keep, F.col(text).alias("text__"))
    out = T.StructType([need.schema["row__"], *(T.StructField(c, kinds.get(c, T.LongType())) for c in added)])
    schema, all_rules = to_arrow_schema(out), {r.name: k for k, r in enumerate(rules)}
    ids = [all_rules[n] for n in names]

    def run(batches):
        for whole in batches:
            for b in (whole.slice(at, 1000) for at in range(0, whole.num_rows, 1000)):
                new = {c: [] for c in added}
                for t in texts(b.column("text__")):
                    d, by, asked = Doc(t), None, 0
                    failed = base.rejects(d)
                    if failed:
                        by = base.name
                    else:
                        for k in ids:
                            asked += 1
                            if rules[k].rejects(d):
                                by = rules[k].name
                                break
                    for c, x in (*((c, getattr(d, c)) for c in counts), ("base_failed", failed), ("kept", by is None), ("rejected_by", by), ("rules_asked", asked)):
                        new[c].append(x)
                yield pa.RecordBatch.from_arrays([pa.array(new[f.name], f.type) if f.name in new else b.column(f.name) for f in schema], schema=schema)

    return unpacked(need.mapInArrow(run, out), keep, *added)


def op1_quality(spark, sf_dir: str) -> DataFrame:
    judged = cascade(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=BASE_COUNTS, keep=["doc_id"])
    return judged.select("doc_id", *BASE_COUNTS, "base_failed", "kept")


OP1_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
window8 AS (SELECT r, i, array_to_string(w[i : i + 7], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM doc WHERE len(w) >= 8)),
twice AS (SELECT r, s FROM window8 GROUP BY r, s HAVING count(*) > 1),
repeat AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM window8 JOIN twice USING (r, s)) GROUP BY r),
base AS (
  SELECT doc_id, t, w, l, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN repeat USING (r)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(l) OR word_chars < 2 * n_words OR word_chars > 12 * n_words
            OR 3 * len(list_filter(w, lambda x: strlen(x) = 1)) > n_words
            OR 2 * len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]') AND strlen(x) > 1)) > n_words
            OR 2 * len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) > n_words
            OR 4 * (length(t) - length(regexp_replace(t, '[0-9]', '', 'g'))) > strlen(t)) AS kept
FROM judged
"""
