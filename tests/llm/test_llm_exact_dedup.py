import re

from brute import TEXTS, sha

from tidemark.llm.exact_dedup import drop_copies, exact_groups

SCHEMA = "doc_id long, text string"


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_equal_brute_force(spark):
    got = exact_groups(spark.createDataFrame(TEXTS, SCHEMA)).collect()
    assert len(got) == len(TEXTS)
    by_text = {}
    for i, t in TEXTS:
        by_text.setdefault(_norm(t), []).append(i)
    for r in got:
        texts = [t for i, t in TEXTS if i == r.doc_id]
        group = by_text[_norm(texts[0])]
        assert (r.keep_id, r.group_size) == (min(group), len(group))
        assert r.text_sha256 == sha(_norm(texts[0]))
    # One row of each group stays, of repeated rows too.
    assert sum(r.kept for r in got) == len(by_text)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_drop_keeps_columns_and_one_row_per_text(spark):
    rows = [(t, i, f"s{n}", n) for n, (i, t) in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "text string, doc_id long, _full string, c0 int")
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, _norm(r.text)) for r in kept.collect()]
    assert sorted(got) == sorted(
        {_norm(t): (min(i for i, u in TEXTS if _norm(u) == _norm(t)), _norm(t)) for _, t in TEXTS}
        .values()
    )


def test_rows_equal_in_every_column_and_null_ids(spark):
    rows = [(None, "a b"), (None, "a  b"), (5, "a b"), (5, "a b"), (None, "only")]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(drop_copies(docs).collect(), key=str) == sorted(
        [(5, "a b"), (None, "only")], key=str
    )
    got = exact_groups(docs).collect()
    assert [r.doc_id for r in got if r.kept and r.group_size == 4] == [5]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_groups(empty).count() == 0
    assert drop_copies(empty).count() == 0


def test_texts_that_share_length_and_prefix(spark):
    same = "p" * 100
    rows = [(i, same + c) for i, c in enumerate("abcabd")]
    got = {r.doc_id: r.keep_id for r in exact_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 0, 4: 1, 5: 5}
