"""The stages against brute force on small tables with planted cases."""

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from feedlake.llm import tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def planted(tmp_path, spark):
    r = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in "bdklmst" for b in "aeio" for c in ("na", "ri", "lo", "tu")]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, prose(25)) for i in range(5)]
    docs = {i: prose(60) for i in range(60)}
    for i in range(60, 80):
        docs[i] = prose(20) + " vile filth scum " + prose(20)
    for i in range(80, 84):
        docs[i] = prose(30) + " " + items[i - 80][1] + " " + prose(30)
    docs[90], docs[91] = docs[3], docs[4].rsplit(" ", 1)[0] + " changed"
    docs[95], docs[96] = None, ""
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in docs.items()]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(60 <= i < 80)) for i in range(80) if i % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return docs


def test_stages_on_planted_cases(spark, tmp_path):
    docs = planted(tmp_path, spark)
    own, left = cp.table(spark, str(tmp_path), "documents"), {}
    for name, stage in cp.STAGES[:-1]:
        own = cp.stored(stage(spark, own, str(tmp_path)), f"test-{name}")
        assert own.columns == [f.split()[0] for f in DOCS.split(", ")]
        left[name] = sorted(x.doc_id for x in own.collect())
    clean = [i for i in docs if not 60 <= i < 80]
    assert left["toxicity"] == clean
    assert left["near_duplicates"] == [i for i in clean if i not in (90, 91)]
    assert left["decontamination"] == [i for i in left["near_duplicates"] if not 80 <= i < 84]
    assert set(left["mixing"]) <= set(left["decontamination"]) and max(left["mixing"].count(i) for i in left["mixing"]) <= 2
    words = sum(len((docs[i] or "").split()) for i in left["decontamination"])
    assert abs(sum(len((docs[i] or "").split()) for i in left["mixing"]) - 1.5 * words) <= 3 * 80

    got = sorted((x.start, x.doc_id, x.n_tokens, x.ids_crc32) for x in cp.STAGES[-1][1](spark, own, str(tmp_path)).collect())
    t, at, want = Tokenizer.from_file(tokens.default_tokenizer()), 0, []
    for i in left["mixing"]:
        ids = np.array([*t.encode(docs[i] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((at, i, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want


def test_run_and_empty_table(spark, tmp_path):
    assert cp.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None
    for t in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_null_and_repeated_ids_go_through(spark, tmp_path):
    docs = planted(tmp_path / "a", spark)
    extra = [(7, "another text under the number of document seven " + docs[50][::-1], "en", "s0", 1), (7, docs[7], "en", "s1", 1), (None, docs[8], "en", None, 1),
             (None, "a text without a number " + docs[51][::-1], None, "s1", None), (None, None, None, None, None)]
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{tmp_path}/a/documents.parquet").collect()]
    (tmp_path / "b").mkdir()
    spark.createDataFrame(rows + extra, DOCS).write.parquet(f"{tmp_path}/b/documents.parquet")
    own = cp.table(spark, f"{tmp_path}/b", "documents")
    near = cp.drop_near_duplicates(spark, own, "").select("doc_id", "text").collect()
    left = [(r.doc_id, r.text) for r in near]
    assert (7, extra[0][1]) in left and left.count((7, docs[7])) == 1 and (None, docs[8]) not in left and (None, extra[3][1]) in left
    clean = [i for i in docs if i not in (90, 91)]
    assert sorted(i for i, _ in left if i is not None) == sorted(clean + [7])
    assert cp.run(spark, "/root/testdata/sf0.001").count() > 0
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{tmp_path}/a/{t}.parquet").write.parquet(f"{tmp_path}/b/{t}.parquet")
    assert cp.run(spark, f"{tmp_path}/b").count() > 0
