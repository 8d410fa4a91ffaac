import hashlib
from collections import defaultdict

import pytest

from feedlake.llm import merkle as mk

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string, row__ string, i string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[k : k + 3])) for k in range(0, len(last), 3)])
    return out


def proof_of(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i // 3 * 3
        out.append((i - first, [nodes[k] for k in range(first, min(first + 3, len(nodes))) if k != i]))
        i //= 3
    return out


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def brute(rows):
    """(doc_id, leaf) -> subroot, root, siblings of every row, as sorted strings."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = levels_of([leaf(r) for r in groups[s]])
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = proof_of(trees[s], i) + proof_of(top, k)
            out.append(str((r[0], leaf(r), trees[s][-1][0], "".join(x for _, run in steps for x in run))))
    return sorted(out), top[-1][0]


def rows():
    sizes = {None: 5, "a": 1, "B": 2, "b": 3, "é": 4, "z": 10, "big": 100}
    sizes |= {f"one{k}": 1 for k in range(30)}
    out, k = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            k += 1
            out.append(((k * 37) % 1009, s, None if k % 3 else "en", k, None if k % 7 == 0 else "" if k % 11 == 0 else f"é text\n{k}\n", "t", "d", "r", "i"))
    return out + [(None, "z", "en", None, "no id", "t", "d", "r", "i")] * 2 + [(5, "z", "en", 1, "same", "t", "d", "r", "i")] * 2


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses_fill_the_layout_and_halves_lie_together(levels):
    at = [mk.address(levels, d, k) for d in range(levels) for k in range(3**d)]
    assert sorted(at) == list(range(mk.tree_size(levels)))
    top = levels // 2
    if top:
        assert max(at[: mk.tree_size(top)]) == mk.tree_size(top) - 1
        below = [mk.address(levels, d, k) for d in range(top, levels) for k in range(3 ** (d - top))]  # the first subtree below
        assert sorted(below) == list(range(mk.tree_size(top), mk.tree_size(top) + mk.tree_size(levels - top)))


@pytest.mark.parametrize("n", [*range(1, 31), 80, 81, 82, 243])
def test_one_block(n):
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    levels = levels_of([x.hex() for x in leaves])
    high = mk.height(n)
    assert high == len(levels) - 1
    block = mk.laid_out(leaves, high)
    for i in range(n):
        path = mk.siblings(block, n, high, i)
        assert [(a, [x.hex() for x in run]) for a, run in path] == proof_of(levels, i)
        assert mk.unpacked_path(mk.packed_path(path)) == path
        assert mk.folded(leaves[i], path).hex() == levels[-1][0]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_equals_brute_force_over_tiers(spark, levels):
    docs = spark.createDataFrame(rows(), DOCS)
    m = mk.manifest(docs, levels=levels)
    want, root = brute(rows())
    assert m.root == root and len(m.tiers) == {1: 5, 2: 3, 6: 1}[levels]
    seen = mk.proofs(m)
    got = seen.collect()
    assert sorted(str((r.row__.doc_id, bytes(r.digest).hex(), bytes(r.subroot).hex(), bytes(r.siblings).hex())) for r in got) == want
    assert {bytes(r.folded).hex() for r in got} == {root}
    assert {(r.row__.tree, r.row__.digest, r.row__["row__"], r.row__.i) for r in got} == {("t", "d", "r", "i")}


def test_a_changed_row_does_not_verify(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows(), DOCS)
    m = mk.manifest(docs, levels=2)
    claim = F.when(F.col("row__.n_chars") % 2 == 0, F.unhex(F.sha2("digest", 256))).otherwise(F.col("digest"))
    for r in mk.proofs(m, m.leaves.withColumn("claim", claim), "claim").collect():
        assert (bytes(r.folded).hex() == m.root) == (r.row__.n_chars is None or r.row__.n_chars % 2 == 1)


def test_empty_table_and_lone_row(spark):
    assert mk.manifest(spark.createDataFrame([], DOCS)).root is None
    assert mk.proofs(mk.manifest(spark.createDataFrame([], DOCS))).count() == 0
    one = rows()[:1]
    assert mk.manifest(spark.createDataFrame(one, DOCS)).root == leaf(one[0])


def test_null_and_empty_differ_and_long_texts_are_whole(spark):
    long = "wörd " * 200_000
    data = [(1, "s", "en", 1, None), (1, "s", "en", 1, ""), (1, "s", "en", 1, long), (1, "s", "en", 1, long + "x")]
    docs = spark.createDataFrame(data, "doc_id long, source string, lang string, n_chars long, text string")
    got = {bytes(r.digest).hex() for r in mk.manifest(docs).leaves.collect()}
    assert got == {leaf(r) for r in data}
