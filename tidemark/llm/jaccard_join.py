"""Jaccard self-join of word-shingle sets by adaptive multi-match prefixes.

All tokens (hashed shingles) have one global order: those of rare buckets of a count sketch
first. Two sets that are similar enough share at least L of the tokens that begin them,
where the beginnings are L - 1 tokens longer than needed to share one. Each document
picks its L by estimated cost: a longer prefix is dearer to write and to shuffle, but
leaves fewer candidates to verify. A pair is a candidate if it shares as many prefix
tokens as the smaller L of the two.

Documents with equal sets are one class. Of the documents under a token each is first
compared with the one in which the token comes earliest; only documents that this leaves
in different components are paired up, so a large group of near copies never becomes all
of its pairs. Bounds on the overlap remove a pair only when it cannot be similar, and
whoever remains is verified on the whole sets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import Recent, forget, pieces, text_of
from tidemark.llm.components import components
from tidemark.llm.shingles import shingle_sets
from tidemark.llm.store import maybe_in, stored

#: Buckets of the count sketch: its size whatever the input; larger for larger corpora.
SKETCH_BITS = 23
_BLOCK_BITS = 16

#: Largest number of shared prefix tokens that a document may ask for.
MOST_MATCHES = 24
#: Estimated cost of verifying a candidate, in prefix tokens: fixed, and per token of the set.
VERIFY_FIXED, VERIFY_TOKEN = 2.0, 1 / 16
#: Entries of a side that meet at once.
BLOCK = 2048
#: Chance that a token of an ordinary bucket has another document.
ORDINARY = 0.1


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _class_of(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def _packed(counts: np.ndarray) -> bytes:
    """A block of the sketch, compressed unless that makes it no smaller: most buckets are empty."""
    plain = counts.tobytes()
    small = zlib.compress(plain, 1)
    return small if len(small) < len(plain) else plain


def _unpacked(packed: pa.Buffer) -> np.ndarray:
    plain = packed if packed.size == 2 << _BLOCK_BITS else zlib.decompress(packed)
    return np.frombuffer(plain, np.uint16)


def _up(numerator, denominator: int):
    return -(-numerator // denominator)


# -- sizes and token counts -----------------------------------------------------------


def _measure(docs: DataFrame, words: int) -> DataFrame:
    """Per document its set's size and class, and per task the blocks of the count sketch."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts = np.zeros(1 << SKETCH_BITS, np.uint16)
        recent = Recent()
        shift = np.uint64(64 - SKETCH_BITS)
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingle_sets(*text_of(piece.column("text")), words)
                classes = [_class_of(s) if len(s) else None for s in sets]
                fresh = [s for s, c in zip(sets, classes) if c is not None and recent.is_new(c)]
                if fresh:
                    at, n = np.unique(np.concatenate(fresh) >> shift, return_counts=True)
                    counts[at] = np.minimum(counts[at] + n, 65535)
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("id"),
                        piece.column("row"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(classes, pa.int64()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    ["id", "row", "n", "cls", "block", "counts"],
                )
        blocks = counts.reshape(-1, 1 << _BLOCK_BITS)
        for i in np.flatnonzero(blocks.any(axis=1)):
            packed = _packed(blocks[i])
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.nulls(1, pa.int64()) for _ in range(4)],
                    pa.array([i], pa.int32()), pa.array([packed], pa.binary()),
                ],
                ["id", "row", "n", "cls", "block", "counts"],
            )

    schema = "id long, row long, n long, cls long, block int, counts binary"
    return docs.mapInArrow(measured, schema)


def _levels(measured: DataFrame) -> np.ndarray:
    """The sketch's buckets as levels: 0 for an ordinary one, else the logarithm of its excess.

    Blocks are summed as they stream by; what reaches the driver is one byte a bucket.
    """
    total = measured.agg(F.sum("n")).first()[0] or 0
    mean = total / (1 << SKETCH_BITS)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(block: int, counts: np.ndarray) -> pa.RecordBatch:
            excess = np.maximum(counts - mean, 1.0)
            level = np.where(counts > 2 * mean + 4, np.floor(np.log2(excess)), 0)
            data = [pa.array([block], pa.int32()), pa.array([level.astype(np.uint8).tobytes()])]
            return pa.RecordBatch.from_arrays(data, ["block", "levels"])

        now, counts = None, None
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now:
                    if now is not None:
                        yield out(now, counts)
                    now, counts = block, np.zeros(1 << _BLOCK_BITS, np.int64)
                counts += _unpacked(packed.as_buffer())
        if now is not None:
            yield out(now, counts)

    blocks = stored(
        measured.where(F.col("block").isNotNull())
        .select("block", "counts")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(summed, "block int, levels binary"),
        "sketch",
    )
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for row in blocks.collect():  # one job, not one per partition
        at = row["block"] << _BLOCK_BITS
        levels[at : at + (1 << _BLOCK_BITS)] = np.frombuffer(row["levels"], np.uint8)
    return levels


# -- prefixes -----------------------------------------------------------------------------


def _matches(order_levels: np.ndarray, n: int, base: int) -> int:
    """How many shared tokens to ask for: the cheapest choice by the sketch's estimates.

    Every candidate shares as many tokens as asked for, so there are at most as many as
    documents under the prefix's tokens, divided by that number.
    """
    lengths = np.arange(base, min(n, base + MOST_MATCHES - 1) + 1)
    others = np.cumsum(np.where(order_levels > 0, np.exp2(order_levels.astype(float)), ORDINARY))
    asked = lengths - base + 1
    cost = lengths + (VERIFY_FIXED + VERIFY_TOKEN * n) * others[lengths - 1] / asked
    return int(asked[np.argmin(cost)])


def _prefixes(docs: DataFrame, words: int, percent: int, levels: np.ndarray) -> DataFrame:
    """``(token, cls, meta)`` of all prefixes; meta packs position, set size and matches."""
    shared = docs.sparkSession.sparkContext.broadcast(levels.tobytes())

    def begun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = np.frombuffer(shared.value, np.uint8)
        shift = np.uint64(64 - SKETCH_BITS)
        recent = Recent()
        for batch in batches:
            for piece in pieces(batch, "text"):
                tokens, classes, metas = [], [], []
                for s in shingle_sets(*text_of(piece.column("text")), words):
                    n = len(s)
                    if not n or not recent.is_new(c := _class_of(s)):
                        continue
                    level = level_of[s >> shift]
                    order = np.argsort(level, kind="stable")
                    base = n - _up(percent * n, 100) + 1
                    asked = _matches(level[order[: base + MOST_MATCHES]], n, base)
                    first = order[: base + asked - 1]
                    tokens.append(s[first])
                    classes.append(np.full(len(first), c, np.int64))
                    metas.append((np.arange(len(first), dtype=np.int64) << 36) | n << 8 | asked)
                if tokens:
                    columns = [_signed(np.concatenate(tokens)), *map(np.concatenate, (classes, metas))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], ["token", "cls", "meta"]
                    )

    return docs.select("text").mapInArrow(begun, "token long, cls long, meta long")


def _with_company(prefixes: DataFrame) -> DataFrame:
    """Prefix entries whose token has another class too, with the token's hub.

    The hub is the class in which the token comes earliest. Entries stream by in order, so
    a token with any number of documents needs no memory.
    """

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["token", "cls", "meta", "hub", "hub_meta"]
        held = None  # the last entry so far, its hub, and whether it is its token's first
        for batch in batches:
            token, cls, meta = (c.to_numpy() for c in batch.columns[:3])
            if not len(token):
                continue
            if held is not None:
                token, cls, meta = (
                    np.concatenate([[h], x]) for h, x in zip(held[:3], (token, cls, meta))
                )
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
            token, cls, meta = token[fresh], cls[fresh], meta[fresh]
            first = np.ones(len(token), bool)
            first[1:] = token[1:] != token[:-1]
            at = np.maximum.accumulate(np.where(first, np.arange(len(token)), 0))
            hub, hub_meta = cls[at], meta[at]
            if held is not None and not held[5]:
                own = at == 0
                hub[own], hub_meta[own] = held[3], held[4]
                first[0] = False
            live = ~first
            live[:-1] |= ~first[1:]
            live[-1] = False
            out = [pa.array(x[live]) for x in (token, cls, meta, hub, hub_meta)]
            held = (token[-1], cls[-1], meta[-1], hub[-1], hub_meta[-1], bool(first[-1]))
            yield pa.RecordBatch.from_arrays(out, names)
        if held is not None and not held[5]:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in held[:5]], names)

    return (
        prefixes.repartition("token")
        .sortWithinPartitions("token", "meta", "cls")
        .mapInArrow(streamed, "token long, cls long, meta long, hub long, hub_meta long")
    )


# -- candidates -----------------------------------------------------------------------------


def _size(meta: str) -> Column:
    return F.shiftright(meta, 8).bitwiseAND((1 << 28) - 1)


def _least_overlap(a: Column, b: Column, percent: int) -> Column:
    """The smallest overlap of two sets of these sizes that are similar enough."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent))


def _alike_sizes(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _useful(entries: DataFrame, percent: int) -> DataFrame:
    """Entries with ``cap``, the largest overlap that a pair under this token can have.

    A prefix token without company before this one is not shared with any document under
    this one, so each takes one from the size. Entries whose cap no partner allows go.
    """
    before = F.row_number().over(Window.partitionBy("cls").orderBy("pos")) - 1
    named = entries.select(
        "token", "cls", "hub", _size("meta").alias("n"), _size("hub_meta").alias("hub_n"),
        F.shiftright("meta", 36).alias("pos"), F.col("meta").bitwiseAND(255).alias("asked"),
        F.shiftright("hub_meta", 36).alias("hub_pos"),
    )
    cap = F.col("n") - (F.col("pos") - before)
    return named.withColumn("cap", cap).where(100 * F.col("cap") >= percent * F.col("n"))


def _own_prefixes(useful: DataFrame) -> DataFrame:
    """Per class its size, the matches it asks for and its useful prefix tokens."""
    return useful.groupBy("cls").agg(
        F.first("n").alias("n"),
        F.first("asked").alias("asked"),
        F.collect_list(F.struct("pos", "token")).alias("prefix"),
    )


def _enough_shared(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``(a, b)`` that share as many prefix tokens as the smaller asks for.

    With both sizes known, prefixes are as short as the pair allows: sets that need an
    overlap of ``least`` share L tokens among the first ``n - least + L`` of each.
    """

    def of(key: str, side: str) -> DataFrame:
        return own.select(
            F.col("cls").alias(key), *[F.col(c).alias(f"{side}_{c}") for c in ("n", "asked", "prefix")]
        )

    asked = F.least("x_asked", "y_asked")
    least = _least_overlap(F.col("x_n"), F.col("y_n"), percent)

    def begun(side: str) -> Column:
        reach = F.col(f"{side}_n") - least + asked
        some = F.filter(f"{side}_prefix", lambda e: e["pos"] < reach)
        return F.transform(some, lambda e: e["token"])

    shared = F.size(F.array_intersect(begun("x"), begun("y")))
    both = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b")
    return both.where(shared >= asked).select("a", "b")


def _hub_pairs(useful: DataFrame, percent: int) -> DataFrame:
    """Each class with the hubs of its tokens, ``(a, b)``: at most a pair per prefix entry."""
    n, hub_n = F.col("n"), F.col("hub_n")
    least = _least_overlap(n, hub_n, percent)
    return (
        useful.where("cls != hub")
        .where(_alike_sizes(n, hub_n, percent) & (F.col("cap") >= least))
        .where((F.col("pos") <= n - least) & (F.col("hub_pos") <= hub_n - least))
        .select(F.greatest("cls", "hub").alias("a"), F.least("cls", "hub").alias("b"))
        .distinct()
    )


def _band(size: Column, percent: int) -> Column:
    """The number of a size's band; bands ascend with the sizes in them.

    The sizes of all partners that are no larger lie in two bands at most.
    """
    return F.floor(F.log(size) / math.log(100 / min(percent, 90))).cast("int")


def _sides(useful: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Entries by the sizes of the partners that they allow, once per band and side.

    A set that needs an overlap of ``least`` with its partner shares a token among its first
    ``n - least + 1``, and no more tokens than ``cap``. Both bound the partner's size from above
    (``high``). The larger set of a pair looks for partners in all bands of sizes that it
    allows; the smaller one waits in its own, if a partner of its size or more is allowed.
    """
    n = F.col("n")
    overlap = F.least("cap", n - F.col("pos"))
    high = F.least(F.floor(100 * n / percent), F.floor(overlap * (100 + percent) / percent) - n)
    sized = useful.select(
        "token", "cls", "n", F.ceil(percent * n / 100).alias("low"), high.alias("high")
    ).where("high >= low")
    labelled = stored(
        sized.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select(
            "token", "cls", F.coalesce("component", "cls").alias("label"), "n", "low", "high"
        ),
        "labelled",
    )
    # Most tokens stay within one group: only the others get a row per band.
    mixed = (
        labelled.groupBy("token")
        .agg(F.min("label").alias("least"), F.max("label").alias("most"))
        .where("least != most")
    )
    labelled = labelled.join(mixed, "token", "left_semi")
    bands = F.sequence(_band(F.col("low"), percent), _band(F.least("high", "n"), percent))
    kept = ["token", "cls", "label", "n", "low", "high"]
    looking = labelled.select(*kept, F.lit(True).alias("looks"), F.explode(bands).alias("band"))
    waiting = labelled.where("high >= n").select(*kept, F.lit(False).alias("looks"), _band(n, percent).alias("band"))
    return looking.unionAll(waiting)


def _cross_pairs(useful: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different groups with a token early in both: ``(a, b)``.

    Pairs are made per token and band of sizes. The group that has most of its entries is
    paired with the others only, not with itself, and entries meet in blocks of a bounded size.
    """
    sides = stored(_sides(useful, groups, percent), "sides")
    looks = F.col("looks").cast("long")
    met = (
        sides.groupBy("token", "band")
        .agg(
            F.sum(looks).alias("p"), F.sum(1 - looks).alias("t"),
            F.min("label").alias("least"), F.max("label").alias("most"),
        )
        .where("least != most AND p > 0 AND t > 0")
        .select("token", "band", "p", "t")
    )
    # Only where entries fill blocks does it matter which group has most of them.
    crowded = F.col("p") * F.col("t") > BLOCK * BLOCK
    major = (
        sides.join(met.where(crowded), ["token", "band"])
        .groupBy("token", "band", "label").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("token", "band").agg(F.max_by("label", "n").alias("major"))
    )
    met = stored(met.join(major, ["token", "band"], "left"), "met").select(
        "token", "band", "major",
        F.ceil(F.col("p") / BLOCK).cast("int").alias("p"), F.ceil(F.col("t") / BLOCK).cast("int").alias("t"),
    )
    is_major = F.coalesce(F.col("label") == F.col("major"), F.lit(False))
    entries = stored(sides.join(met, ["token", "band"]).withColumn("is_major", is_major), "mixed-tokens")

    def dealt(looks: bool, own: str, other: str) -> DataFrame:
        """One side, each entry in its block and once for every block of the other side."""
        block = F.pmod(F.xxhash64("cls"), F.col(own)).cast("int")
        all_others = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        side = entries.where(F.col("looks") == looks)
        return side.select(
            "token", "band", "cls", "label", "n", "low", "high", "is_major",
            block.alias(f"_{own}"), all_others.alias(f"_{other}"),
        )

    x, y = dealt(True, "p", "t"), dealt(False, "t", "p")
    at = ["token", "band", "_p", "_t"]

    def met_in(x: DataFrame, y: DataFrame) -> DataFrame:
        fits = (
            (F.col("x.label") != F.col("y.label"))
            & ((F.col("x.n") > F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.cls") > F.col("y.cls")))
            & F.col("y.n").between(F.col("x.low"), F.col("x.high"))
            & (F.col("x.n") <= F.col("y.high"))
        )
        same = reduce(and_, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in at])
        return x.alias("x").join(y.alias("y"), same & fits).select(
            F.greatest("x.cls", "y.cls").alias("a"), F.least("x.cls", "y.cls").alias("b")
        )

    pairs = met_in(x.where("NOT is_major"), y).unionAll(met_in(x.where("is_major"), y.where("NOT is_major")))
    return pairs.distinct()


# -- verification -----------------------------------------------------------------------------


def _sets(docs: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """``(cls, tokens)`` of the classes in ``reps``, from one document each."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingle_sets(*text_of(piece.column("text")), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("row"),
                        pa.array([_class_of(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["row", "cls", "tokens"],
                )

    likely = maybe_in(docs.select("row", "text"), reps, ["row"])
    return (
        likely.mapInArrow(made, "row long, cls long, tokens binary")
        .join(reps, ["row", "cls"], "left_semi")
        .groupBy("cls")
        .agg(F.first("tokens").alias("tokens"))
    )


def _similar(
    pairs: DataFrame, docs: DataFrame, shapes: DataFrame, words: int, percent: int
) -> DataFrame:
    """The pairs whose whole sets are similar enough; sets are made for classes in a pair only."""
    paired = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select("b")).distinct()
    reps = shapes.join(paired, "cls", "left_semi").groupBy("cls").agg(F.min("row").alias("row"))
    sets = stored(_sets(docs, stored(reps, "representatives"), words), "sets")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("x"), batch.column("y")):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def of(name: str, column: str) -> DataFrame:
        return sets.select(F.col("cls").alias(name), F.col("tokens").alias(column))

    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").mapInArrow(
        checked, "a long, b long"
    )


# -- the join ----------------------------------------------------------------------------------


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with the number ``id``, ``text`` and ``row``, a key of both that is never null."""
    number = F.col(doc_id).cast("long")
    return docs.select(
        number.alias("id"), F.col(text).alias("text"), F.xxhash64(number, text).alias("row")
    )


def _labelled(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``(id, row, n, label)`` of each row; rows without words have no label."""
    measured = stored(_measure(rows, words), "measured")
    shapes = measured.where(F.col("block").isNull()).select("id", "row", "n", "cls")
    levels = _levels(measured)
    entries = stored(_with_company(_prefixes(rows, words, percent, levels)), "prefixes")
    useful = stored(_useful(entries, percent), "useful")
    own = stored(_own_prefixes(useful), "own-prefixes")
    hub_pairs = stored(_enough_shared(_hub_pairs(useful, percent), own, percent), "hub-pairs")
    links = stored(_similar(hub_pairs, rows, shapes, words, percent), "hub-links")
    cross = _cross_pairs(useful, components(links), percent).join(hub_pairs, ["a", "b"], "left_anti")
    cross = stored(_enough_shared(cross, own, percent), "cross-pairs")
    if not cross.isEmpty():
        more = _similar(cross, rows, shapes, words, percent)
        links = stored(links.unionAll(more), "links")
    groups = components(links).withColumnRenamed("node", "cls")
    linked = (
        shapes.where("n > 0")
        .join(groups, "cls", "left")
        .select("id", "row", "n", F.coalesce("component", "cls").alias("label"))
    )
    alone = shapes.where("n = 0")
    return linked.unionAll(alone.select("id", "row", "n", F.lit(None).cast("long").alias("label")))


def similar_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id.

    Words are what ASCII white space separates, A-Z lower-cased; a document's set has its
    distinct runs of ``words`` words, or all its words as one if there are fewer. Two
    documents are linked when ``100 * intersection >= percent * union``, and component_id
    is the smallest doc_id reachable by links, the document's own included; it is null only
    if none of them has one. Texts without words, null ones too, are linked with nothing.
    Equal sets are always linked; rows that repeat a doc_id and rows without one are
    documents like all others. Texts are read whole; no list of documents under a token is
    cut. An empty table gives an empty result; other columns play no part, whatever their
    names.
    """
    labelled = _labelled(_rows(docs, doc_id, text), words, percent)
    grouped = labelled.where("label IS NOT NULL")
    least = grouped.groupBy("label").agg(F.min("id").alias("least"))
    linked = grouped.join(least, "label").select("id", "n", "least")
    alone = labelled.where("label IS NULL").select("id", "n", F.col("id").alias("least"))
    return linked.unionAll(alone).select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("least").alias("component_id"),
    )


def drop_similar(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``docs`` with exactly one row of each group of similar ones, columns unchanged.

    The one with the smallest doc_id stays; a row without a doc_id does only if its group
    has none. Rows are told apart by doc_id and text, so of a group's rows that repeat the
    smallest doc_id one stays too, and of rows equal in both any one. Rows without words
    are in no group and stay.
    """
    columns = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    number = F.col(f"c{columns.index(doc_id)}").cast("long")
    own = f"c{columns.index(text)}"
    rows = _rows(docs.select(doc_id, text), doc_id, text)
    # Equal rows are counted first, so a group is as large as its different rows.
    grouped = stored(
        _labelled(rows, words, percent)
        .where("label IS NOT NULL")
        .groupBy("label", "id", "row")
        .agg(F.count(F.lit(1)).alias("copies")),
        "grouped",
    )
    least = (
        grouped.groupBy("label")
        .agg(F.min("id").alias("least"), F.sum("copies").alias("size"))
        .where("size > 1")
    )
    several = stored(grouped.join(least, "label").drop("size"), "several")
    first = several.where("id <=> least").groupBy("label").agg(F.min("row").alias("first"))
    decided = stored(
        several.join(first, "label").select(
            F.col("id").alias("_id"),
            F.col("row").alias("_row"),
            F.expr("id <=> least AND row = first").alias("_stays"),
            "copies",
        ),
        "decided",
    ).withColumnRenamed("copies", "_copies")
    keyed = plain.withColumns({"_id": number, "_row": F.xxhash64(number, own)})
    apart = maybe_in(keyed, decided, ["_row"], keep=False)
    near = maybe_in(keyed, decided, ["_row"]).alias("x").join(
        decided.alias("y"),
        (F.col("x._row") == F.col("y._row")) & F.col("x._id").eqNullSafe(F.col("y._id")),
        "left",
    )
    near = near.select("x.*", "_stays", "_copies")
    once = near.where("_stays IS NULL OR (_stays AND _copies = 1)")
    repeated = near.where("_stays AND _copies > 1").dropDuplicates(["_row", "_id"])
    kept = apart.unionByName(once.select(*apart.columns)).unionByName(
        repeated.select(*apart.columns)
    )
    return kept.select(*plain.columns).toDF(*columns)
