import random
from collections import defaultdict

import pytest
from brute import TEXTS, sha
from pyspark.sql import functions as F

from tidemark.llm import merkle

SCHEMA = "doc_id long, source string, text string"


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """The root, and per leaf the (before, after) siblings level by level."""
    paths, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        runs = [hashes[i : i + 3] for i in range(0, len(hashes), 3)]
        for i, a in enumerate(at):
            run, own = runs[a // 3], a % 3
            paths[i].append(("".join(run[:own]), "".join(run[own + 1 :])))
        at, hashes = [a // 3 for a in at], [sha("".join(r)) for r in runs]
    return hashes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for i, source, text in rows:
        groups[source].append((i, leaf(i, source, text)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        groups[s].sort(key=lambda g: (g[0] is not None, g[0] or 0, g[1]))
        subs[s] = tree([h for _, h in groups[s]])
    root, upper = tree([subs[s][0] for s in order])
    return sorted(
        (
            (i, s, h, subs[s][0], root, tuple(subs[s][1][k] + upper[order.index(s)]))
            for s in order
            for k, (i, h) in enumerate(groups[s])
        ),
        key=str,
    )


def made(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    own = docs.select("doc_id", "source", merkle.leaf_of(F.col("doc_id"), F.col("source"), F.col("text")).alias("leaf"))
    return merkle.manifest(own, "doc_id", "source")


def found(df):
    return sorted(
        ((r.doc_id, r.source, r.leaf, r.subroot, r.root, tuple((a, b) for a, b in r.levels)) for r in df.collect()),
        key=str,
    )


ROWS = {
    "awkward": [(i, "s", t) for i, t in TEXTS] + [(None, None, None), (None, None, None), (1, "é", ""), (2, "", "x")],
    "alone": [(1, "a", "x")],
    "two sources": [(i, "ab"[i % 2], str(i)) for i in range(7)],
    # Blocks of 243 leaves: a hot source of several tiers, and sizes about a block's.
    "tiers": [(i, "hot", "t") for i in range(800)] + [(i, "edge", "t") for i in range(243)]
    + [(i, "over", "t") for i in range(244)],
    "many sources": [(i, f"s{i % 300}", "t") for i in range(600)],
    "equal rows": [(5, "a", "same")] * 30,
}


@pytest.mark.parametrize("case", list(ROWS))
def test_equals_brute_force(spark, case):
    rows = list(ROWS[case])
    random.Random(1).shuffle(rows)
    assert found(made(spark, rows)) == brute(rows)


def test_folding_shows_changes(spark):
    proofs = made(spark, ROWS["tiers"])
    ok = proofs.where(merkle.folded(F.col("leaf"), F.col("levels")) == F.col("root"))
    assert ok.count() == len(ROWS["tiers"])
    assert proofs.where(merkle.folded(F.sha2("leaf", 256), F.col("levels")) == F.col("root")).count() == 0
    one = proofs.orderBy("source", "doc_id").select("levels", merkle.proof_digest(F.col("levels")).alias("p")).first()
    assert one.p == sha("".join(a + b for a, b in one.levels))


def test_columns_and_empty_table(spark):
    rows = [(i, s, leaf(i, s, t), "x") for i, s, t in ROWS["two sources"]]
    docs = spark.createDataFrame(rows, "tree long, rank string, hash string, payload string")
    got = merkle.manifest(docs, "tree", "rank", "hash", carry=["payload"])
    assert got.columns == ["tree", "rank", "payload", "leaf", "subroot", "root", "levels"]
    want = [(r[0], r[2], r[4]) for r in brute(ROWS["two sources"])]
    assert sorted(((r.tree, r.leaf, r.root) for r in got.collect()), key=str) == want
    assert merkle.manifest(docs.limit(0), "tree", "rank", "hash").count() == 0
