import random

import pytest

from feedlake.llm import urls as u

PAGES = "page_id long, url string, extra string"


def test_host_and_path(spark):
    cases = {"http://A.b/c?d#e": ("a.b", "/c"), "x://É.ORG": ("É.org".lower() if False else "É.org", ""), None: ("", ""), "no scheme/a": ("", ""), "": ("", ""), "http://h?q/x": ("h", ""), "http://h#f": ("h", ""),
             "a://b://c/d": ("b:", "//c/d"), "http:///p": ("", "/p"), "http://u@h:80/p/q/": ("u@h:80", "/p/q/")}
    df = spark.createDataFrame([(k,) for k in cases], "url string")
    host, path = u.host_and_path(df.url)
    assert {r.url: (r.h, r.p) for r in df.select("url", host.alias("h"), path.alias("p")).collect()} == cases


def test_longest_rule_wins(spark):
    rules = [("allow", "org", "/"), ("block", "a.org", "/x"), ("allow", "a.org", "/x/y"), ("block", "net", "/")]
    cases = {"http://a.org/x/y/z": ("a.org/x/y", "allow"), "http://s.a.org/x1": ("a.org/x", "block"), "http://ba.org/x": ("org/", "allow"), "http://org/": ("org/", "allow"), "http://a.org": (None, "allow"), "http://n.net/": ("net/", "block"), "http://l.com/": (None, "block"), None: (None, "allow")}
    pages = spark.createDataFrame([(i, k, "x") for i, k in enumerate(cases)], PAGES)
    listed = spark.createDataFrame([("l.com",), (None,)], "key string")
    got = u.judged(pages, listed, rules)
    assert got.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
    assert {r.url: (r.rule, r.verdict) for r in got.collect()} == cases


@pytest.mark.parametrize("bits,hashes,most", [(10, 7, 1 << 30), (2, 1, 1 << 30), (2, 1, 400)])
def test_cascade_is_exact(spark, monkeypatch, bits, hashes, most):
    monkeypatch.setattr(u, "BITS", bits)
    monkeypatch.setattr(u, "HASHES", hashes)
    monkeypatch.setattr(u, "MOST_BITS", most)
    r = random.Random(4)
    hosts = [f"{'www.' if r.random() < .5 else ''}h{i}.example.{r.choice(['com', 'org'])}" for i in range(600)]
    listed = {f"h{i}.example.com" for i in range(0, 600, 2)} | {"absent.example.com"}
    pages = spark.createDataFrame([(i, f"http://{h}/p", "x") for i, h in enumerate(hosts + hosts[:50])], PAGES)
    got = u.judged(pages, spark.createDataFrame([(k,) for k in listed], "key string"), [])
    for x in got.collect():
        parts = x.host.split(".")
        assert (x.verdict == "block") == any(".".join(parts[k:]) in listed for k in range(len(parts))), x.host
    if bits == 2 and most > 400:
        universe = pages.select(u.F.explode(u.host_keys(u.host_and_path(u.F.col("url"))[0])).alias("key"))
        assert len(u.build(spark.createDataFrame([(k,) for k in listed], "key string"), universe).levels) > 2


def test_empty_list_table_and_clash(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", "x"), (1, "http://a.b/", "x")], PAGES)
    none = spark.createDataFrame([], "key string")
    assert [r.verdict for r in u.judged(pages, none, []).collect()] == ["allow", "allow"]
    assert u.judged(pages.where("false"), none, []).count() == 0
    clash = u.judged(pages.withColumnRenamed("extra", "verdict").withColumn("keys_", pages.page_id), none, [])
    assert clash.columns == ["page_id", "url", "keys_", "host", "path", "rule", "verdict"] and {r.verdict for r in clash.collect()} == {"allow"}
