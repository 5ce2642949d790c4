"""Phrases whose words stand together more often than chance, by dynamic itemset counting.

The corpus is laid out once as word codes in ``SHARDS`` shards that are scanned in a cycle. All
lengths are counted side by side: a phrase starts to count in the scan after both its
subphrases (without the last, and without the first word) have reached the threshold, and stops
when it has seen each shard once. Common phrases of every length are thus under way within
the first cycle, and later scans only count what became frequent late.

What is counted is looked up in tables of a fixed number of buckets: a bucket's total is at
least that of any phrase in it, so no phrase starts too late to be found. A crowded bucket
only makes phrases count that need not; their totals are exact, and the threshold is applied
to totals of phrases, never of buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import pieces, strings, text_of
from tidemark.llm.shingles import mixed, word_spans
from tidemark.llm.store import stored
from tidemark.session import scratch_dir, settings_for

#: Parts of the corpus that are scanned in turn, and words of the longest phrase.
SHARDS, LONGEST = 3, 5
#: Buckets of a length's table: a 32nd of the words, in whole blocks, and at most so many.
WORDS_PER_BUCKET, MOST_BUCKETS = 32, 1 << 24
#: Occurrences that a task adds up at once.
OCCURRENCES = 1 << 20
#: Text bytes laid out at once.
LAYOUT_BYTES = 8 << 20

#: Totals of buckets travel in blocks of so many.
BLOCK = 1 << 16
_NEVER = 255
_WORDS_PART = -1
_BREAK, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK[[0x20, 0x09]] = True
_APART = _BREAK | _BLANK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
_COUNTS = ", ".join(["k byte", *[f"{w} long" for w in _WORDS], "n long", "block int, packed binary"])
_NAMES = ["k", *_WORDS, "n", "block", "packed"]


# -- layout ---------------------------------------------------------------------------------


def _code(lang: Column, word: Column, seed: int) -> Column:
    """The code of a word of a language; ``_coded`` works out the same from bytes."""
    code = F.xxhash64(F.concat(F.lit(_salt(seed)), lang), word)
    return F.when(code == 0, F.lit(1)).otherwise(code)


def _salt(seed: int) -> str:
    return f"{seed}/" if seed else ""


def _coded(data: np.ndarray, offsets: np.ndarray, langs: list[str], seed: int):
    """Codes of the words with a 0 wherever a piece or text ends, and the distinct words.

    Distinct words are (lang, word, count).
    """
    data = _LOWER[data]
    starts, ends, first = word_spans(data, offsets, _APART)
    cuts = np.concatenate([[0], np.cumsum(ends - starts)])
    words = strings(data[~_APART[data]], cuts).dictionary_encode()
    if not len(words):
        return np.empty(0, np.uint64), pa.array([], pa.string()), pa.array([], pa.string()), cuts[:0]
    names = words.dictionary.to_pylist()
    tongues, lang_of = np.unique(np.array(langs, object), return_inverse=True)
    pair = np.repeat(lang_of, np.diff(first)) * len(names) + words.indices.to_numpy()
    distinct, which, n = np.unique(pair, return_inverse=True, return_counts=True)
    lang_no, name_no = np.divmod(distinct, len(names))
    seeds = [xxhash.xxh64_intdigest((_salt(seed) + t).encode(), 42) for t in tongues]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(names[w], seeds[t]) or 1 for t, w in zip(lang_no.tolist(), name_no.tolist())], np.uint64
    )
    # A break stands before a word if a breaking byte or a text's end lies between it and the last.
    breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])
    text_no = np.repeat(np.arange(len(first) - 1), np.diff(first))
    apart = np.zeros(len(starts), np.int64)
    apart[1:] = (breaks[starts[1:]] != breaks[ends[:-1]]) | (text_no[1:] != text_no[:-1])
    codes = np.zeros(len(starts) + int(apart.sum()), np.uint64)
    codes[np.arange(len(starts)) + np.cumsum(apart)] = hashes[which]
    tongue = pa.array(tongues.tolist(), pa.string()).take(pa.array(lang_no))
    return codes, tongue, words.dictionary.take(pa.array(name_no)), n


def _planes(numbers: np.ndarray) -> bytes:
    """All lowest bytes, then all next ones and so on, which a codec packs closer."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), -1).T).tobytes()


def _from_planes(planes: pa.Buffer, kind: type) -> np.ndarray:
    rows = np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


def _packed(codes: np.ndarray) -> tuple[bytes, bytes]:
    """The distinct codes, about the most frequent first and else ascending, and their places."""
    distinct, at, n = np.unique(codes, return_inverse=True, return_counts=True)
    order = np.argsort(-np.frexp(n)[1], kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return _planes(distinct[order]), _planes(rank[at])


def _unpacked(distinct: pa.Buffer, places: pa.Buffer) -> np.ndarray:
    return _from_planes(distinct, np.uint64)[_from_planes(places, np.uint32)]


def _laid_out(docs: DataFrame, shards: int, seed: int) -> str:
    """Store word codes by shard, and the distinct words of each stretch; returns the folder."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = None
        for batch in batches:
            for piece in pieces(batch, "text", LAYOUT_BYTES):
                data, offsets = text_of(piece.column("text"))
                codes, lang, word, n = _coded(data, offsets, piece.column("lang").to_pylist(), seed)
                if not len(codes):
                    continue
                if turn is None:  # tasks begin with different shards
                    turn = int(codes[0] % np.uint64(shards))
                turn = (turn + 1) % shards
                m = len(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(m, _WORDS_PART, np.int32)), *[pa.nulls(m, pa.binary())] * 2,
                        lang, word.cast(pa.string()), pa.array(n.astype(np.int64)),
                    ],
                    ["part", "codes", "places", "lang", "word", "n"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([turn], pa.int32()), *[pa.array([x], pa.binary()) for x in _packed(codes)],
                        pa.nulls(1, pa.string()), pa.nulls(1, pa.string()),
                        pa.array([int(n.sum())], pa.int64()),
                    ],
                    ["part", "codes", "places", "lang", "word", "n"],
                )

    spark, path = docs.sparkSession, scratch_dir(docs.sparkSession, "layout")
    laid = docs.mapInArrow(made, "part int, codes binary, places binary, lang string, word string, n long")
    settings = {
        "spark.sql.maxConcurrentOutputFileWriters": str(shards + 2),
        "spark.sql.execution.arrow.maxBytesPerBatch": str(LAYOUT_BYTES),
    }
    with settings_for(spark, settings):
        laid.write.partitionBy("part").option("compression", "zstd").parquet(path)
    return path


def _read_layout(spark: SparkSession, path: str) -> DataFrame:
    schema = "codes binary, places binary, lang string, word string, n long, part int"
    return spark.read.schema(schema).parquet(path)


# -- scans ----------------------------------------------------------------------------------


def _hash(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mixed(prefix * np.uint64(0x9E3779B97F4A7C15) + last)


def _buckets(hashes: np.ndarray, size: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)


def _starts(reached: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """The scan in which phrases begin to count, from the buckets of both subphrases."""
    return np.maximum(reached[head], reached[tail]).astype(np.int64) + 1


def _added(found: list[np.ndarray], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct phrases (rows of word codes), their hashes and counts."""
    words = np.stack(found, axis=1)
    distinct, at, which, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    if (words[at][which] != words).any():  # two phrases of one hash
        words, at, n = np.unique(words, axis=0, return_index=True, return_counts=True)
        return words, hashes[at], n
    order = np.argsort(words[at, 0])  # rows of one first word together take less room
    return words[at[order]], distinct[order], n[order]


def _kind(least: int) -> type:
    """The numbers that totals up to ``least`` need; beyond it none is told apart."""
    return np.uint8 if least < 256 else np.uint16 if least < 65536 else np.uint32 if least < 2**32 else np.uint64


def _small(data: bytes) -> bytes:
    return pa.Codec("zstd", 9).compress(data, asbytes=True)


def _large(packed: bytes, count: int, kind: type) -> np.ndarray:
    size = count * np.dtype(kind).itemsize
    return np.frombuffer(pa.Codec("zstd").decompress(packed, size, asbytes=True), kind)


def _blocks(k: int, totals: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """A row for each block of a table that has a count."""
    blocks = totals.reshape(-1, size)
    for i in np.flatnonzero(blocks.any(axis=1)):
        none, packed = pa.nulls(1, pa.int64()), _small(blocks[i].tobytes())
        arrays = [pa.array([k], pa.int8()), *[none] * (LONGEST + 1), pa.array([i], pa.int32()),
                  pa.array([packed], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, _NAMES)


def _scan(
    shard: DataFrame, reached: np.ndarray, step: int, shards: int, buckets: int, least: int
) -> DataFrame:
    """Counts of one shard: a row per phrase and some of its occurrences, and totals of buckets.

    Counted are the single words in the first cycle, and all phrases whose turn it is. Buckets
    that had reached the threshold before need no more totals.
    """
    shared, block = shard.sparkSession.sparkContext.broadcast(_small(reached.tobytes())), BLOCK

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _large(shared.value, LONGEST * buckets, np.uint8).reshape(LONGEST, buckets)
        held = {k: [] for k in range(2, LONGEST + 1)}
        size = dict.fromkeys(held, 0)
        totals: dict[int, np.ndarray] = {}

        def add(k: int, hashes: np.ndarray, n: np.ndarray | None = None) -> None:
            if k not in totals:
                totals[k] = np.zeros(buckets, _kind(least))
            at, which, here = np.unique(
                _buckets(hashes, buckets), return_inverse=True, return_counts=True
            )
            here = here if n is None else np.bincount(which, n).astype(np.int64)
            totals[k][at] = np.minimum(totals[k][at] + here, least)

        def out(k: int) -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in zip(*held[k])]
            held[k], size[k] = [], 0
            words, hashes, n = _added(columns[1:], columns[0])
            add(k, hashes, n)
            none = pa.nulls(len(n), pa.int64())
            arrays = [
                pa.array(np.full(len(n), k, np.int8)),
                *[pa.array(words[:, i].view(np.int64)) if i < k else none for i in range(LONGEST)],
                pa.array(n.astype(np.int64)), none.cast(pa.int32()), pa.nulls(len(n), pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, _NAMES)

        for batch in batches:
            for distinct, places in zip(batch.column(0), batch.column(1)):
                codes = _unpacked(distinct.as_buffer(), places.as_buffer())
                at = np.flatnonzero(codes)
                hashes = codes[at]
                if step < shards:
                    add(1, hashes)
                for k in range(2, LONGEST + 1):
                    # Places whose first and last k - 1 words are subphrases seen often enough.
                    own = _buckets(hashes, buckets)
                    next_to = np.flatnonzero(at[1:] == at[:-1] + 1)
                    begin = _starts(table[k - 2], own[next_to], own[next_to + 1])
                    live = begin <= _NEVER
                    next_to, begin = next_to[live], begin[live]
                    last = codes[at[next_to] + k - 1]
                    at, hashes = at[next_to], _hash(hashes[next_to], last)
                    now = (begin <= step) & (step < begin + shards)
                    if now.any():
                        place = at[now]
                        held[k].append([hashes[now], *[codes[place + i] for i in range(k)]])
                        size[k] += len(place)
                        if size[k] >= OCCURRENCES:
                            yield out(k)
        for k in held:
            if size[k]:
                yield out(k)
        for k, total in totals.items():
            total[table[k - 1] != _NEVER] = 0
            yield from _blocks(k, total, block)

    return shard.select("codes", "places").mapInArrow(counted, _COUNTS)


def _summed(blocks: DataFrame, least: int) -> DataFrame:
    """One row per block of buckets: the sum of its totals in all tasks, streamed past."""
    size = BLOCK

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            packed = _small(np.minimum(total, least).astype(_kind(least)).tobytes())
            data = [pa.array([now[0]], pa.int8()), pa.array([now[1]], pa.int32()), pa.array([packed])]
            return pa.RecordBatch.from_arrays(data, ["k", "block", "packed"])

        now, total = None, None
        for batch in batches:
            for k, block, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if (k, block) != now:
                    if now is not None:
                        yield out()
                    now, total = (k, block), np.zeros(size, np.int64)
                total += _large(packed, size, _kind(least))
        if now is not None:
            yield out()

    dealt = blocks.repartition("k", "block").sortWithinPartitions("k", "block")
    return dealt.mapInArrow(summed, "k byte, block int, packed binary")


def _in_full_buckets(counts: DataFrame, reached: np.ndarray) -> DataFrame:
    """Counts (n by all other columns) of phrases whose bucket has reached the threshold.

    No others can have reached it. Counts are summed here as far as a task sees them, and there
    are no more tasks than cores, so a common phrase is a few rows of the shuffle that follows.
    """
    context = counts.sparkSession.sparkContext
    shared, buckets = context.broadcast(_small(reached.tobytes())), reached.shape[1]
    words = [c for c in counts.columns if c in _WORDS]
    keys, names = [c for c in counts.columns if c != "n"], counts.columns

    def summed(held: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(held).group_by(keys, use_threads=False).aggregate([("n", "sum")])
        return table.rename_columns(["n" if c == "n_sum" else c for c in table.column_names]).select(names)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _large(shared.value, LONGEST * buckets, np.uint8).reshape(LONGEST, buckets)
        held, size = [], 0
        for batch in batches:
            codes = [batch.column(batch.schema.get_field_index(w)) for w in words]
            length = sum(np.asarray(c.is_valid()).astype(np.int64) for c in codes)
            own = [c.fill_null(0).to_numpy().view(np.uint64) for c in codes]
            hashes = own[0].copy()
            for k in range(2, len(words) + 1):
                longer = length >= k
                hashes[longer] = _hash(hashes[longer], own[k - 1][longer])
            some = batch.filter(pa.array(table[length - 1, _buckets(hashes, buckets)] != _NEVER))
            held.append(some)
            size += some.num_rows
            if size >= OCCURRENCES:
                held = summed(held).to_batches()
                size = sum(b.num_rows for b in held)
                if size >= OCCURRENCES // 2:
                    yield from held
                    held, size = [], 0
        if size:
            yield from summed(held).to_batches()

    return counts.coalesce(context.defaultParallelism).mapInArrow(kept, counts.schema)


def _size(words: int) -> int:
    return min(-(-max(words, 1) // (WORDS_PER_BUCKET * BLOCK)) * BLOCK, MOST_BUCKETS)


def _frequent(
    spark: SparkSession, path: str, least: int, shards: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Words and phrases of enough occurrences: (lang, word, code, n) and (w, n).

    Words come with all that share a code with one of them, and their true counts.
    """
    layout = _read_layout(spark, path)
    size = _size(layout.where(f"part != {_WORDS_PART}").agg(F.sum("n")).first()[0] or 0)
    reached = np.full((LONGEST, size), _NEVER, np.uint8)
    totals = np.zeros((LONGEST, size), _kind(least))
    scans, step, steps = [], 0, []
    # A phrase of the next length can start one scan after the last bucket filled.
    while step < shards or step <= max(steps, default=-1) + shards:
        shard = layout.where(f"part = {step % shards}")
        scans.append(stored(_scan(shard, reached, step, shards, size, least), "scan", "zstd"))
        blocks = scans[-1].where("block IS NOT NULL").select("k", "block", "packed")
        # A number of at most ``least`` for each bucket, of which there is a fixed number.
        for k, block, packed in stored(_summed(blocks, least), "totals").collect():
            at = slice(block * BLOCK, (block + 1) * BLOCK)
            here = _large(packed, BLOCK, _kind(least)).astype(np.int64)
            totals[k - 1, at] = np.minimum(totals[k - 1, at] + here, least)
        fresh = (totals == least) & (reached == _NEVER)
        reached[fresh] = step
        if fresh[:-1].any():
            steps.append(step)
        step += 1
    found = layout.where(f"part = {_WORDS_PART}").select(
        "lang", "word", _code(F.col("lang"), F.col("word"), seed).alias("w1"), "n"
    )
    words = stored(
        _in_full_buckets(found, reached)
        .groupBy("lang", "word", F.col("w1").alias("code"))
        .agg(F.sum("n").alias("n")),
        "vocabulary",
    )
    counts = [s.where("block IS NULL").select(*_WORDS, "n") for s in scans]
    phrases = (
        _in_full_buckets(reduce(DataFrame.unionAll, counts), reached)
        .groupBy(*_WORDS)
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .select(F.array_compact(F.array(*_WORDS)).alias("w"), "n")
    )
    return words, stored(phrases, "phrases")


# -- scores ---------------------------------------------------------------------------------


def _scored(phrases: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``phrases`` (w, a, lang) with the cut that scores lowest: l, r, n and score."""
    k = F.size("w")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), k - 1)).alias("cut")).select(
        "w", "a", "lang", "cut",
        F.slice("w", F.lit(1), F.col("cut")).alias("head"),
        F.slice("w", F.col("cut") + 1, k - F.col("cut")).alias("tail"),
    )
    heads = counts.select(F.col("w").alias("head"), F.col("n").alias("l"))
    tails = counts.select(F.col("w").alias("tail"), F.col("n").alias("r"))

    def exact(c: str) -> Column:
        return F.col(c).cast("decimal(18,0)")

    score = F.expr("(CAST(a AS DECIMAL(18,0)) * n * 1000) div (CAST(l AS DECIMAL(18,0)) * r)")
    measured = (
        cuts.join(heads, "head")
        .join(tails, "tail")
        .join(totals, "lang")
        .withColumns({c: exact(c) for c in ("n", "r")})
        .select("w", "lang", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("at"))
    )
    best = measured.groupBy("w", "lang", "a", "n").agg(F.min("at").alias("at"))
    number = {c: F.col(f"at.{c}").cast("long") for c in ("l", "r", "score")}
    return best.withColumns({**number, "n": F.col("n").cast("long")}).drop("at")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    top: int = 2000,
    shards: int = SHARDS,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A-Z are lower-cased; texts end pieces at ``.,;:!?`` and at the bytes 0A to 0D, and space and
    tab part words. A phrase is 2 to 5 words of one piece that stand together ``a >= least``
    times in a language (null: ``und``), overlaps included; n is the language's words. Of all
    cuts into a first part (l times) and a rest (r times) the one with the lowest
    ``floor(1000 a n / (l r))`` counts, the shortest first part on ties. Phrases inside a longer one
    that is as frequent are left out. Order is score, then a, both descending, then the phrase by
    its UTF-8 bytes. Null and empty texts have no words; repeated rows count each time; texts
    are read whole, however long; an empty table, and one without frequent phrases, gives no
    rows; other columns, whatever their names, play no part.
    """
    spark = docs.sparkSession
    plain = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
    )
    if not 0 < shards * LONGEST < _NEVER:
        raise ValueError(f"shards must be 1 to {(_NEVER - 1) // LONGEST}")
    seed = 0
    while True:
        layout = _laid_out(plain, shards, seed)
        words, phrases = _frequent(spark, layout, least, shards, seed)
        shared = words.groupBy("code").agg(F.count(F.lit(1)).alias("words")).where("words > 1")
        if shared.isEmpty():
            break
        seed += 1  # two words of one code, one of them frequent: other codes
    words = words.where(F.col("n") >= least)
    every = _read_layout(spark, layout).where(f"part = {_WORDS_PART}")
    totals = every.groupBy("lang").agg(F.sum("n").alias("n"))
    counts = phrases.unionByName(words.select(F.array("code").alias("w"), "n"))
    inner = phrases.where(F.size("w") > 2).select(
        F.explode(F.array(F.slice("w", F.lit(1), F.size("w") - 1), F.slice("w", F.lit(2), F.size("w") - 1))).alias("w"),
        "n",
    )
    longer = inner.groupBy("w").agg(F.max("n").alias("longer"))
    tongue = words.select(F.col("code").alias("first"), "lang")
    own = (
        phrases.join(longer, "w", "left")
        .where("longer IS NULL OR longer < n")
        .select("w", F.col("n").alias("a"), F.col("w")[0].alias("first"))
        .join(tongue, "first")
        .drop("first")
    )
    scored = stored(_scored(own, counts, totals), "scored")
    names = words.select("code", "word")
    spelled = (
        scored.select("w", F.posexplode("w").alias("at", "code"))
        .join(names, "code")
        .groupBy("w")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled"))
        .select("w", F.array_join(F.transform("spelled", lambda s: s["word"]), " ").alias("phrase"))
    )
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.join(spelled, "w")
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
