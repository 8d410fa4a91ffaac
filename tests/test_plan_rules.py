"""Scale rules checked on the physical plans of the registered queries."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
RUNS_ON_CALL = {"stream_ingest", "stream_seen", "stream_mentions", "stream_feed_ingest",
                "stream_keyword_mentions", "sitemap_documents"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n\n")[0]


@pytest.mark.parametrize("name", sorted(set(E.QUERIES) - RUNS_ON_CALL))
def test_no_cartesian_and_no_nested_loops(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p


def test_a_scan_has_no_exchange(spark):
    assert "Exchange" not in plan(E.queries()["archive_scan"](spark, SF))


def test_read_payloads(spark, tmp_path):
    from feedlake.sources import feeds as FD
    (tmp_path / "a.xml").write_text("<rss><channel><title>T</title><item><title>x</title></item></channel></rss>")
    (tmp_path / "b.xml").write_text("<rss><channel>\n<title>U</title></channel></rss>")
    rows = FD.read_payloads(spark, str(tmp_path)).collect()
    assert len(rows) == 2 and all(r.url.endswith((".xml")) for r in rows)
    items = FD.feed_items(FD.read_payloads(spark, str(tmp_path))).collect()
    assert [(i.title, i.source) for i in items] == [("x", "T")]
