import hashlib
from collections import defaultdict

import pytest

from feedlake.llm import linededup as ld

DOCS = "doc_id long, text string, n_lines string, word string, doc_ string, keep string"
SPACE = " \t\n\x0b\f\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
A, B, C = "The line that many documents share, in any Case", "Zweite Zeile, länger als vierzig Zeichen, ÄÖ", "x" * 40


def key(line):
    return line.strip(SPACE).translate(UPPER)


def brute(rows, min_chars=40, min_docs=5):
    """Per row: lines, dropped lines, kept text."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(doc)
    least = lambda d: (d is not None, d or 0)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = [len(h := holders.get(key(x), ())) >= min_docs and doc != max(h, key=least) for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


def rows():
    out = [(k, f"own line {k}\n{A}\n  {A.upper()}\t\nshort\n") for k in range(0, 12)]
    out += [(100 + k, f"{B}\r\n{C}\n\n{C}") for k in range(4)]
    out += [(None, f"{B}\nrest"), (None, f"{B}\nother rest"), (200, None), (201, ""), (202, "\n"), (203, "\n\n"), (3, f"{A}\nsecond text of 3"), (5, "a\n" + A), (5, "a\n" + A)]
    out += [(300 + k, "\n".join(f"{'common line ' * 4}{i}" if i % (3 + k) else f"only {k} {i} " + "y" * 50 for i in range(400))) for k in range(6)]
    return out + [(400, f"\x0b{A}\f"), (-7, A), (401, "Ünd" + "É" * 40), (402, "ünd" + "é" * 40), (403, "x" * 39)]


def got(spark, data, **how):
    docs = spark.createDataFrame([(d, t, "n", "w", "d", "k") for d, t in data], DOCS)
    seen = ld.with_words(ld.line_bitmaps(docs, keep=["doc_id", "text", "word", "doc_", "keep"], **how))
    text = ld.kept_text("text", "words_").alias("kept")
    return sorted(map(str, ((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in seen.select("doc_id", "n_lines", "n_dropped", text).collect())))


@pytest.mark.parametrize("least", [1, 1000])
def test_equals_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(ld, "LEAST_ROWS", least)  # 1: the common keys go by aggregates; 1000: all go by ranges
    assert got(spark, rows()) == sorted(map(str, brute(rows())))


def test_few_partitions_and_other_limits(spark, monkeypatch):
    monkeypatch.setattr(ld, "LEAST_ROWS", 1)
    monkeypatch.setattr(ld, "SHARE", 1)
    data = rows() + [(1000 + k, A) for k in range(400)]
    assert got(spark, data, min_chars=3, min_docs=2) == sorted(map(str, brute(data, 3, 2)))


def test_bitmap_words(spark):
    data = [(k, "\n".join([A] + ["x"] * 200 + [A])) for k in range(5)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    out = {r.doc_id: r for r in ld.line_bitmaps(docs).collect()}
    assert out[4].keep_bitmap is None and out[4].n_dropped == 0
    words = {w.word: w.keep for w in out[0].keep_bitmap}
    assert words == {0: ~1, 3: ~(1 << (201 - 192))} and out[0].n_dropped == 2 and out[0].n_lines == 202
    assert ld.line_bitmaps(docs).columns == ["doc_id", "n_lines", "n_dropped", "keep_bitmap"]


def test_texts_keep_their_columns(spark):
    docs = spark.createDataFrame([(d, t, "n", "w", "d", "k") for d, t in rows()], DOCS)
    out = ld.deduplicated(docs)
    assert out.columns == docs.columns
    want = [(d, None if t is None else k) for (d, t), (_, _, _, k) in zip(rows(), brute(rows()))]
    assert sorted(map(str, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(str, want))
    assert {(r.n_lines, r.word, r.doc_, r.keep) for r in out.collect()} == {("n", "w", "d", "k")}


def test_empty_table_and_all_dropped(spark):
    none = spark.createDataFrame([], DOCS)
    assert ld.line_bitmaps(none).count() == 0 and ld.deduplicated(none).count() == 0
    assert got(spark, [(k, A) for k in range(5)])[0] == str((0, 1, 1, ""))


def test_no_python_and_one_range_shuffle(spark):
    df = ld.op11_line_dedup(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("rangepartitioning(h1") == 1
    r = df.where("n_dropped = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(f"doc_id = {r.doc_id}").first().text
    assert r.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
