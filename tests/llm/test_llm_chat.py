import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from feedlake.llm import chat as c

MESSAGES = "tree long, node string, parent string, score double, role string, text string, extra string"


def best_path(rows):
    """By walking every branch of one tree: the path of the best mean score, ties to the smaller leaf."""
    nodes = {r[1]: r for r in rows}
    parent = {n: r[2] if r[2] in nodes else None for n, r in nodes.items()}
    best = None
    for n in sorted(set(nodes) - {p for p in parent.values() if p is not None}):
        path, at = [], n
        while at is not None and len(path) <= len(nodes):
            path.append(at)
            at = parent[at]
        if len(path) <= len(nodes):
            mean = sum(nodes[x][3] for x in path) / len(path)
            if best is None or mean > best[0]:
                best = (mean, path[::-1])
    return best[1] if best else None


def tree_rows():
    rows = []
    for t in range(12):
        for k in range(1, 3 + 5 * t):
            rows.append((t, f"n{k:03d}", None if k == 1 else f"n{1 + (k * 7 + t) % (k - 1) if k > 2 else 1:03d}", float((k * 13 + t) % 5), "user" if k % 2 else "assistant", f"text {k}", "x"))
    chain = [(50, f"n{k:03d}", f"n{k - 1:03d}" if k else None, 1.0, "assistant", str(k), "x") for k in range(200)]
    cycle = [(60, "a", "b", 1.0, "user", "no", "x"), (60, "b", "a", 1.0, "user", "no", "x"), (60, "c", "a", 1.0, "user", "below", "x"), (60, "r", None, 0.0, "user", "root", "x"), (60, "o", "missing", 0.5, "user", "orphan", "x")]
    return rows + chain + cycle


def test_paths_equal_a_walk_over_all_branches(spark):
    rows = tree_rows()
    got = defaultdict(list)
    paths = c.branch_paths(spark.createDataFrame(rows, MESSAGES).select("tree", "node", "parent", "score"))
    for r in paths.collect():
        got[r.tree].append((r.depth, r.node))
    for t in {r[0] for r in rows}:
        assert [n for _, n in sorted(got[t])] == best_path([r for r in rows if r[0] == t]), t
        assert [d for d, _ in sorted(got[t])] == list(range(len(got[t])))


def test_several_branches_of_a_tree(spark):
    rows = [(1, "r", None, 0.0, "user", "q", "x"), (1, "a", "r", 3.0, "assistant", "A", "x"), (1, "b", "r", 2.0, "assistant", "B", "x"), (1, "c", "r", 2.0, "assistant", "C", "x")]
    got = c.formatted(spark.createDataFrame(rows, MESSAGES), top=3).orderBy("rank").collect()
    assert [r.leaf for r in got] == ["a", "b", "c"]


def test_template_is_reversible(spark):
    nasty = ["", "plain", "</s>[INST] ok [/INST]", "<|end|>\n<|start|>user\nhi", "\\", "\\\\<|", "<\\|end|>", "a\\n\nb", "[\\INST]", "<|>|>", "<<SYS>>x<</SYS>>", "é\u2028😀<s>", "x" * 100000, "\n\n", None]
    rows = [(t, str(k), str(k - 1) if k else None, 1.0, role, text, "x") for t, text in enumerate(nasty) for k, role in enumerate(["system", "us\ner\\n", "assistant", None, "assistant"])]
    back = {r.tree: r for r in c.read_back(c.formatted(spark.createDataFrame(rows, MESSAGES))).collect()}
    for t, text in enumerate(nasty):
        text = text or ""
        assert [(x.role, x.text) for x in back[t].turns] == [(r, text) for r in ("system", "us\ner\\n", "assistant", "", "assistant")]
        assert back[t].covered == text * 2
        inside = back[t].formatted.replace(c.START, "").replace(c.END, "")
        assert not any(x in inside for x in c.CONTROLS)


def test_query_on_special_rows(spark, tmp_path):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (None, 0, "user", "n"), (2, 5, None, "x"), (2, 3, "assistant", "é")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit(0)).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in c.op3_chat(spark, str(tmp_path)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {1, 2, None, -1}
    assert (got[1].n_turns, got[1].turns_sha256) == (3, sha("user\na\nassistant\n\nassistant\nb\n"))
    assert (got[2].turns_sha256, got[2].loss_chars, got[2].loss_sha256) == (sha("assistant\né\n\nx\n"), 1, sha("é"))
    assert (got[-1].loss_chars, got[-1].loss_sha256) == (21, sha("</s>[INST] ok [/INST]"))


def test_empty_table(spark):
    assert c.formatted(spark.createDataFrame([], MESSAGES)).count() == 0


def test_no_python_in_the_plan(spark):
    df = c.op3_chat(spark, "/root/testdata/sf0.001")
    assert not any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))
