import random

import pytest

from feedlake.llm import decontaminate as d

DOCS = "doc_id long, text string, extra string"


def fixture_rows():
    r = random.Random(1)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß1"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 3, 10, 12, 25])))) for i in range(30)] + [(31, None), (32, "!!! --"), (33, "W1, w2"), (33, "w1 w2")]
    docs = []
    for i in range(120):
        words = [r.choice(vocabulary) for _ in range(r.choice([0, 5, 30, 80]))]
        if i % 3 == 0:
            item = (r.choice(items)[1] or "").split()
            words[len(words) // 2 : len(words) // 2] = item
        docs.append((i, r.choice([" ", ", ", "\n--"]).join(words).upper() if i % 4 else " ".join(words), "x"))
    return docs + [(500, None, None), (501, "", "x"), (502, "...", "x"), (0, docs[0][1], "x"), (503, "filler word " * 50000 + " ".join(["w1", "w2"]), "x")], items


def brute(text, items, window):
    low = lambda t: [w for w in "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in "".join(c.lower() if c.isascii() else c for c in t or "")).split(" ") if w]
    words, hit, ids = low(text), set(), set()
    for item_id, t in items:
        w = low(t)
        n = min(window, len(w))
        own = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1 if own else 0):
            if tuple(words[i : i + n]) in own:
                hit |= set(range(i, i + n))
                ids.add(str(item_id))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("most_chars", [16_000_000, 300])
def test_equals_brute_force(spark, most_chars):
    docs, items = fixture_rows()
    got = d.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"), most_chars=most_chars).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, list(r.item_ids)) == brute(r.text, items, 10), r.doc_id


def test_documents_and_spans(spark):
    docs, items = fixture_rows()
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    kept = d.decontaminate(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t, _ in docs if not brute(t, items, 10)[1])
    cut = {(r.doc_id, r.text) for r in d.decontaminate(frame, bench, mode="span").collect()}
    assert len(d.decontaminate(frame, bench, mode="span").collect()) == len(docs) and (500, None) in cut
    for i, t in cut:
        n, hit, _ = brute(next(x[1] for x in docs if x[0] == i), items, 10)
        assert len(d.words_of((t or "").encode())) == n - hit
    with pytest.raises(ValueError):
        d.decontaminate(frame, bench, mode="x")


def test_empty_tables_and_clash(spark):
    docs, items = fixture_rows()
    frame, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    assert d.contamination(frame.where("false"), bench).count() == 0
    assert d.contamination(frame, bench.where("false")).where("n_hit > 0").count() == 0
    clash = frame.withColumnRenamed("extra", "n_hit")
    assert d.contamination(clash, bench).columns == ["doc_id", "text", "n_words", "n_hit", "item_ids", "hit_spans"]
    kept = d.decontaminate(clash.withColumn("text_", clash.text), bench)
    assert kept.columns == ["doc_id", "text", "n_hit", "text_"] and {r.n_hit for r in kept.collect()} == {"x", None}
    assert d.decontaminate(clash, bench, mode="span").columns == clash.columns
