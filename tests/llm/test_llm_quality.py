from collections import Counter

from hypothesis import given, settings, strategies as st

from feedlake.llm import quality as q

DOCS = "doc_id long, text string, extra string"


def brute_repeated(words, window):
    seen = Counter(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    mark = set()
    for i in range(len(words) - window + 1):
        if seen[tuple(words[i : i + window])] > 1:
            mark |= set(range(i, i + window))
    return len(mark)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60), st.integers(1, 9))
def test_repeated_words_equal_brute_force(words, window):
    assert q.repeated_words(words, window) == brute_repeated(words, window)


def test_measures():
    d = q.Doc("a bé\tcc\n\n#x *\na bé\tcc\n \x0b\n".encode())
    assert (d.n_words, d.word_chars, d.n_symbols, d.n_dup_lines) == (8, 13, 2, 1)
    empty = q.Doc(b"")
    assert (empty.n_words, empty.word_chars, empty.n_symbols, empty.n_dup_lines, empty.n_repeat_words) == (0, 0, 0, 0, 0)


def test_verdict_does_not_depend_on_the_order(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{'xyz'[i % 3]}" for i in range(40))
    rows = [(1, good, "x"), (2, good.replace("word", "# w"), "x"), (3, None, None), (4, "", "x"), (5, "so " * 30, "x"), (6, good.upper(), "x"), (1, good, "x"), (7, good * 2000, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    seen = []
    for order in (list(q.RULES), list(q.RULES)[::-1]):
        got = q.cascade(docs, order=order, counts=q.BASE_COUNTS)
        assert got.columns[:3] == ["doc_id", "text", "extra"]
        seen.append(sorted((r.doc_id, r.base_failed, r.kept) for r in got.collect()))
    assert seen[0] == seen[1] == [(1, False, True), (1, False, True), (2, False, False), (3, True, False), (4, True, False), (5, True, False), (6, False, False), (7, True, False)]


def test_cascade_stops_at_the_first_rejection(spark):
    docs = spark.createDataFrame([(1, "abc " * 3 + " ".join(str(i) for i in range(40)), "x")], DOCS)
    no, yes = q.Rule("no", lambda d: False), q.Rule("yes", lambda d: True)
    r = q.cascade(docs, rules=(no, yes), order=[yes, no]).first()
    assert (r.kept, r.rejected_by, r.rules_asked) == (False, "yes", 1)


def test_measured_rules_come_by_rejections_per_second(spark):
    docs = spark.createDataFrame([(i, " ".join(f"{i}w{k}" for k in range(30)), "x") for i in range(50)], DOCS)
    slow = q.Rule("slow", lambda d: sum(range(20000)) > 0)
    fast = q.Rule("fast", lambda d: True)
    never = q.Rule("never", lambda d: False)
    assert [m.rule.name for m in q.measure(docs, (never, slow, fast))] == ["fast", "slow", "never"]


def test_empty_table_and_clash(spark):
    none = spark.createDataFrame([], DOCS)
    assert q.cascade(none).count() == 0
    clash = q.cascade(spark.createDataFrame([(1, "few words", "x")], DOCS).withColumnRenamed("extra", "kept"))
    assert clash.columns == ["doc_id", "text", "base_failed", "kept", "rejected_by", "rules_asked"] and clash.first().kept is False
