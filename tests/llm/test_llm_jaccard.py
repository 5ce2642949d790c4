import random
import tracemalloc

import numpy as np
import pyarrow as pa
from brute import BASE, TEXTS, similar_groups

from tidemark.llm import jaccard_join, shingles

SCHEMA = "doc_id long, text string"


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _varied(rng, words, n, changes):
    out = []
    for _ in range(n):
        mine = list(words)
        for _ in range(rng.randint(0, changes)):
            mine[rng.randrange(len(mine))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(mine))
    return out


def test_awkward_texts(spark):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    got = jaccard_join.similar_groups(docs, words=4, percent=85)
    assert _found(got) == similar_groups(TEXTS, 4, 85)


def test_near_copies_and_shared_passages(spark):
    rng = random.Random(5)
    passage = " ".join(f"common{i}" for i in range(40))
    texts = []
    for size, n, changes in ((30, 12, 2), (80, 25, 9), (200, 20, 12)):
        words = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += _varied(rng, words, n, changes)
    for _ in range(30):
        own = " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randint(3, 60)))
        texts.append(own + " " + passage)
    texts += texts[::9]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, SCHEMA)
    for words, percent in ((4, 85), (5, 80)):
        got = jaccard_join.similar_groups(df, words=words, percent=percent)
        assert _found(got) == similar_groups(docs, words, percent)


def test_matches_asked_for_grow_with_cost():
    import numpy as np

    rare = np.zeros(200, np.uint8)
    assert jaccard_join._matches(rare[:50], 20, 4) == 1
    assert jaccard_join._matches(rare, 1000, 151) >= 1
    common = np.full(100, 12, np.uint8)
    assert jaccard_join._matches(common, 300, 46) > jaccard_join._matches(rare, 300, 46)


def test_null_ids_and_empty_table(spark):
    rows = [(None, BASE), (7, BASE), (None, "alone in here"), (None, None)]
    got = jaccard_join.similar_groups(spark.createDataFrame(rows, SCHEMA), words=4, percent=85)
    assert sorted((r.doc_id, r.n_shingles) for r in got.collect() if r.doc_id) == [(7, 57)]
    assert got.count() == 4
    assert jaccard_join.similar_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_drop_keeps_one_of_each_group(spark):
    rows = [(t, i, n) for n, (i, t) in enumerate(TEXTS) if n != 16] + [(TEXTS[1][1], 2, 1)]
    docs = spark.createDataFrame(rows, "text string, doc_id long, stays int")
    kept = jaccard_join.drop_similar(docs)
    assert kept.columns == docs.columns
    expected = sorted(i for i, _, c in similar_groups(TEXTS[:16] + TEXTS[17:], 5, 80) if i == c)
    assert sorted(r.doc_id for r in kept.collect()) == expected


def _strange_ids():
    """Groups whose rows lack a doc_id or repeat one, as (doc_id, text)."""
    other = " ".join(f"other{i}" for i in range(60))
    third = " ".join(f"third{i}" for i in range(60))
    return [
        (None, BASE), (7, BASE), (9, BASE + " more"), (8, BASE),
        (None, other), (None, other), (None, other + " more"),
        (3, third), (3, third + " more"), (3, third), (5, third), (None, third),
        (-(2**63), "the smallest number is an id"), (1, "the smallest number is an id"),
        (None, None), (None, ""), (4, None), (4, None),
    ]


def test_component_is_the_smallest_id_that_is_there(spark):
    docs = _strange_ids()
    got = _found(jaccard_join.similar_groups(spark.createDataFrame(docs, SCHEMA)))
    assert got == similar_groups(docs, 5, 80)
    assert {c for i, n, c in got if i in (7, 8, 9)} == {7}


def test_drop_keeps_one_row_of_groups_with_strange_ids(spark):
    rows = [(i, t, n) for n, (i, t) in enumerate(_strange_ids())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, no int")
    kept = jaccard_join.drop_similar(docs).collect()
    of = {n: g for g, own in enumerate([range(4), range(4, 7), range(7, 12), (12, 13)]) for n in own}
    assert sorted(of.get(r.no, r.no) for r in kept) == [0, 1, 2, 3, 14, 15, 16, 17]
    ids = {of[r.no]: r.doc_id for r in kept if r.no in of}
    assert ids == {0: 7, 1: None, 2: 3, 3: -(2**63)}


def test_a_shared_passage_costs_no_pairs(spark):
    """Documents that share a passage but are not similar: nothing is paired, however many."""
    from tidemark.llm import jaccard_join as jj

    passage = " ".join(f"common{i}" for i in range(200))

    def candidates(n):
        own = "concat_ws(' ', transform(sequence(1, 20), x -> concat('d', id, 'w', x)))"
        docs = spark.range(n).selectExpr("id AS doc_id", f"concat({own}, ' {passage}') AS text")
        rows = jj._rows(docs, "doc_id", "text")
        measured = jj.stored(jj._measure(rows, 4), "measured")
        entries = jj._with_company(jj._prefixes(rows, 4, 85, jj._levels(measured)))
        useful = jj.stored(jj._useful(entries, 85), "useful")
        nothing = spark.createDataFrame([], "node long, component long")
        sides = jj._sides(useful, nothing, 85)
        return sides.where("NOT looks").count(), jj._cross_pairs(useful, nothing, 85).count()

    assert candidates(300) == (0, 0)
    assert candidates(6000) == (0, 0)


def test_blocks_and_bands_lose_no_pair(spark, monkeypatch):
    """Many sizes, many groups under one token, and blocks of a few entries."""
    import random

    from tidemark.llm import jaccard_join as jj

    monkeypatch.setattr(jj, "BLOCK", 3)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        at = rng.randrange(4) * 10
        text = words[at : at + rng.randrange(8, 24)]
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((2, 60), (4, 85), (1, 70)):
        got = jj.similar_groups(docs, words=k, percent=percent)
        assert sorted(map(tuple, got.collect()), key=str) == similar_groups(rows, k, percent)


def test_blocks_of_the_sketch_come_a_few_at_a_time(spark, monkeypatch):
    """Workers get the blocks of all tasks in batches of a bounded size, and sum them up."""
    kind = type(spark.range(1))
    plain = kind.mapInArrow

    def watched(df, function, schema):
        def few(batches):
            for batch in batches:
                assert batch.nbytes <= 8 << 20
                yield batch

        return plain(df, lambda batches: function(few(batches)), schema)

    monkeypatch.setattr(kind, "mapInArrow", watched)
    measured = spark.range(200).selectExpr(
        "0L AS n", "0 AS block", "CAST(repeat('ab', 65536) AS binary) AS counts"
    )
    levels = jaccard_join._levels(measured)
    assert (levels[:65536] == 22).all() and not levels[65536:].any()


def test_words_are_hashed_in_little_memory():
    """A text of a megabyte takes less than twenty times its bytes; blocks change no hash."""
    data = np.frombuffer(("lorem ipsum dolor sit " * 50_000).encode(), np.uint8)
    offsets = np.array([0, len(data)])
    tracemalloc.start()
    try:
        hashes, _ = shingles.word_hashes(data, offsets)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 32e6
    assert (hashes[:-4:4] == hashes[0]).all() and len(set(hashes.tolist())) == 4


def test_blocks_of_the_sketch_are_stored_small(spark):
    """A task's blocks take little room while most buckets are empty; levels are those of the counts."""
    text = " ".join(f"w{i}" for i in range(2_000))
    rows = [(i, f"{text} x{i}") for i in range(100)]
    docs = jaccard_join._rows(spark.createDataFrame(rows, SCHEMA).coalesce(1), "doc_id", "text")
    measured = jaccard_join._measure(docs, 5).cache()
    sizes = [r[0] for r in measured.selectExpr("octet_length(counts)").where("counts IS NOT NULL").collect()]
    assert sizes and max(sizes) < 1 << 14
    assert (jaccard_join._levels(measured) == 6).sum() > 1_900
    measured.unpersist()


def test_a_full_block_is_kept_as_it_is():
    rng = np.random.default_rng(5)
    for counts in (rng.integers(0, 65536, 1 << 16, np.uint16), np.zeros(1 << 16, np.uint16)):
        packed = jaccard_join._packed(counts)
        assert len(packed) <= counts.nbytes
        assert (jaccard_join._unpacked(pa.py_buffer(packed)) == counts).all()
