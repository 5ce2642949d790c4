import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import TEXTS, lower

from tidemark.llm import collocations as co

SCHEMA = "lang string, text string"


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    big = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    inside = set()
    for (lang, w), c in big.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if c >= f[lang, w[i : i + k]]:
                    inside.add((lang, w[i : i + k]))
    per = {}
    for (lang, w), a in big.items():
        if (lang, w) not in inside:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            row = (" ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score)
            per.setdefault(lang, []).append(row)
    out = []
    for lang, found in per.items():
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(found[:top])]
    return sorted(out)


def rows_of(seed):
    """Random texts, some words and phrases common, with phrases that become common late."""
    rng = random.Random(seed)
    some = ["a", "b", "C", "dé", "e", "日本", "x1", "y-z"]
    rows = []
    for i in range(120):
        words = [rng.choice(some if rng.random() < 0.7 else [f"rare{rng.randrange(99)}"]) for _ in range(40)]
        for j in range(0, 40, 9):
            words[j] += rng.choice([".", ",", "\n", " ; ", "\r\n", "\x0b"])
        if i > 80:
            words += ["late", "phrase", "of", "five", "words"] * 2
        rows.append((rng.choice(["en", "de", None, ""]), " ".join(words)))
    return rows


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed, least, top, shards", [(1, 5, 2000, 3), (2, 12, 7, 1), (3, 20, 2000, 7)])
def test_equals_brute_force(spark, monkeypatch, seed, least, top, shards):
    monkeypatch.setattr(co, "BLOCK", 64)
    monkeypatch.setattr(co, "LAYOUT_BYTES", 700)  # many pieces, so that all shards have some
    rows = rows_of(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = found(co.collocations(docs, least=least, top=top, shards=shards))
    assert got == brute(rows, least, top) and got


def test_crowded_buckets_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(co, "BLOCK", 8)
    monkeypatch.setattr(co, "MOST_BUCKETS", 8)
    rows = rows_of(4)
    assert found(co.collocations(spark.createDataFrame(rows, SCHEMA), least=6)) == brute(rows, 6, 2000)


def test_awkward_rows(spark):
    rows = [("en", t) for _, t in TEXTS] + [(None, t) for _, t in TEXTS]
    rows += [("en", "a b c. a b c " + "z " * 3000)] * 4 + [("en", "und und"), ("und", "und und")] * 3
    docs = spark.createDataFrame([(t, i, 1, "x") for i, t in rows], "text string, lang string, w long, rank string")
    assert found(co.collocations(docs, least=3)) == brute(rows, 3, 2000)
    assert co.collocations(docs.limit(0)).count() == 0
    assert co.collocations(docs, least=10**6).count() == 0
    with pytest.raises(ValueError):
        co.collocations(docs, shards=60)


def test_scores_past_64_bits(spark):
    """The score is an integer division of products that no long holds."""
    counts = spark.createDataFrame([([1], 10**13), ([2], 10**13), ([1, 2], 10**13)], "w array<long>, n long")
    own = counts.where("size(w) = 2").selectExpr("w", "n AS a", "'en' AS lang")
    totals = spark.createDataFrame([("en", 3 * 10**14 + 1)], "lang string, n long")
    row = co._scored(own, counts, totals).first()
    assert row.score == 1000 * 10**13 * (3 * 10**14 + 1) // 10**26


def test_stored_codes_take_little_room(spark):
    """Words of a stretch are stored once each, with their places."""
    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.2, 150_000), 30_000)
    texts = [" ".join(f"w{i}" for i in part) for part in np.split(ids, 30)]
    docs = spark.createDataFrame([("en", t) for t in texts], SCHEMA).coalesce(1).select("text", "lang")
    path = co._laid_out(docs, 1, 0).removeprefix("file:")
    raw = co._coded(*co.text_of(pa.array(texts)), ["en"] * len(texts), 0)[0]
    found = pq.ParquetDataset(f"{path}/part=0").read()
    stored = [co._unpacked(*(x.as_buffer() for x in row)) for row in zip(found["codes"], found["places"])]
    assert sorted(np.concatenate(stored)) == sorted(raw)
    parts = [f.metadata.row_group(g) for f in map(pq.ParquetFile, pq.ParquetDataset(f"{path}/part=0").files) for g in range(f.metadata.num_row_groups)]
    size = sum(g.column(i).total_compressed_size for g in parts for i in range(g.num_columns))
    assert size < 0.8 * len(pa.Codec("zstd").compress(raw.tobytes()))


def test_full_buckets_send_no_totals(spark):
    """Totals of buckets that had reached the threshold in an earlier scan are not sent again."""
    docs = spark.createDataFrame([("en", "one two three four five " * 50)], SCHEMA).select("text", "lang")
    layout = co._read_layout(spark, co._laid_out(docs, 1, 0)).where("part = 0")
    none = np.full((co.LONGEST, co.BLOCK), co._NEVER, np.uint8)
    full = np.zeros_like(none)
    sent = [co._scan(layout, x, 0, 1, co.BLOCK, 9).where("block IS NOT NULL").count() for x in (none, full)]
    assert sent[0] > 0 and sent[1] == 0
