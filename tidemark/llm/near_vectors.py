"""Near-duplicate vectors by product quantisation, without losing a pair.

Vectors of a label are put on coarse inverted lists, each with codes of its residual by
subspace and the length of what the codes leave over. A vector looks through every list
that can hold a vector within the linking distance: a list's vectors lie on its side of the
plane half-way between two centroids. Table lookups give distances to the coded vectors;
what is left over bounds the error, so only pairs that cannot link are passed by, and all
others are decided by their exact cosine.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.store import stored

#: Vectors, picked by hash, that the quantiser is fitted on at most (about).
TRAIN_ROWS = 20_000
SUBSPACES, CODES = 8, 64
MOST_LISTS = 1024
ROUNDS = 8

#: Indexed vectors and looking vectors that meet in one group.
BLOCK, LOOKING = 4096, 8192
_CHUNK = 128

_SLACK = 1e-9


# -- quantiser ------------------------------------------------------------------------


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    norms = (centres**2).sum(1)
    for i in range(0, len(x), 2048):
        out[i : i + 2048] = np.argmin(norms - 2 * x[i : i + 2048] @ centres.T, axis=1)
    return out


def _cluster(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of ``k`` clusters at most, by Lloyd's rounds."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        of = _nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        n = np.bincount(of, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int) -> dict:
    """Coarse centroids and residual codebooks from a sample of unit vectors."""
    rng = np.random.default_rng(0)
    width = -(-sample.shape[1] // SUBSPACES)
    coarse = _cluster(sample, lists, rng)
    residual = _split(sample - coarse[_nearest(sample, coarse)], width)
    books = [_cluster(np.ascontiguousarray(residual[:, s]), CODES, rng) for s in range(SUBSPACES)]
    apart = np.stack([np.sqrt(np.maximum(((coarse - c) ** 2).sum(1), 1e-300)) for c in coarse])
    return {"coarse": coarse, "books": books, "width": width, "apart": apart}


def _split(x: np.ndarray, width: int) -> np.ndarray:
    """Rows cut into SUBSPACES parts of ``width``, the last ones filled up with zeros."""
    full = np.zeros((len(x), SUBSPACES * width))
    full[:, : x.shape[1]] = x
    return full.reshape(len(x), SUBSPACES, width)


def _padded(raw: list[bytes], width: int) -> np.ndarray:
    """Unit vectors of one width from stored ones; shorter ones are filled up with zeros."""
    out = np.zeros((len(raw), width))
    for i, b in enumerate(raw):
        x = np.frombuffer(b, np.float64)
        out[i, : len(x)] = x
    return out


# -- steps on the cluster ---------------------------------------------------------------


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors in double precision; a vector that links with nothing has none."""
    for batch in batches:
        lists = batch.column("embedding")
        labels = batch.column("label").to_pylist()
        units, classes, dims = [], [], []
        for label, x in zip(labels, lists):
            unit = cls = dim = None
            if label is not None and x.is_valid and x.values.null_count == 0:
                v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                scale = np.abs(v).max() if len(v) else 0.0
                if np.isfinite(scale) and scale > 0:
                    v = v / scale
                    raw = (v / np.sqrt(v @ v)).tobytes()
                    unit, dim = raw, len(v)
                    digest = xxhash.xxh3_64_intdigest(raw + f"|{label}|{dim}".encode())
                    cls = int(np.uint64(digest).astype(np.int64))
            units.append(unit)
            classes.append(cls)
            dims.append(dim)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"), batch.column("label").cast(pa.string()),
                pa.array(dims, pa.int32()), pa.array(classes, pa.int64()),
                pa.array(units, pa.binary()),
            ],
            ["vec_id", "label", "dim", "cls", "unit"],
        )


def _index(classes: DataFrame, model, radius: float) -> DataFrame:
    """Entries: each class once on its own list (``codes`` set) and once per list to probe."""

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pickle.loads(model.value)
        coarse, books, width, apart = m["coarse"], m["books"], m["width"], m["apart"]
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = _padded(part.column("unit").to_pylist(), coarse.shape[1])
                d2 = (x**2).sum(1)[:, None] - 2 * x @ coarse.T + (coarse**2).sum(1)
                own = np.argmin(d2, axis=1)
                rows = np.arange(len(x))
                plane = (d2 - d2[rows, own][:, None]) / (2 * apart[own])
                residual = _split(x - coarse[own], width)
                codes = np.empty((len(x), SUBSPACES), np.uint8)
                for s, book in enumerate(books):
                    codes[:, s] = _nearest(residual[:, s], book)
                    residual[:, s] -= book[codes[:, s]]
                left = np.sqrt((residual**2).sum((1, 2)))
                plane[rows, own] = 0
                looking, probed = np.nonzero(plane <= radius + _SLACK)
                take = np.concatenate([rows, looking])
                columns = [part.column(c).take(pa.array(take)) for c in ("label", "dim", "cls", "n", "unit")]
                columns += [
                    pa.array(np.concatenate([own, probed]).astype(np.int32)),
                    pa.array([c.tobytes() for c in codes] + [None] * len(looking), pa.binary()),
                    pa.array(np.concatenate([left, np.zeros(len(looking))])),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["label", "dim", "cls", "n", "unit", "list", "codes", "rest"]
                )

    return classes.select("label", "dim", "cls", "n", "unit").mapInArrow(
        entered,
        "label string, dim int, cls long, n long, unit binary, list int, codes binary, rest double",
    )


def _blocks(entries: DataFrame) -> DataFrame:
    """Entries dealt to groups of a bounded size in which every looking one meets every indexed.

    A list with many vectors of a label is cut: each block of indexed ones meets each block
    of looking ones in a group of its own.
    """
    place = ["label", "dim", "list"]
    sizes = entries.groupBy(*place).agg(
        F.ceil(F.count("codes") / BLOCK).alias("blocks"),
        F.ceil((F.count(F.lit(1)) - F.count("codes")) / LOOKING).alias("lookers"),
    )
    indexed = F.col("codes").isNotNull()
    every = F.sequence(F.lit(0), F.when(indexed, F.col("lookers")).otherwise(F.col("blocks")) - 1)
    own = F.pmod(F.xxhash64("cls"), F.when(indexed, F.col("blocks")).otherwise(F.col("lookers")))
    return (
        entries.join(sizes.where("blocks > 0 AND lookers > 0"), place)
        .withColumn("own", own)
        .withColumn("other", F.explode(every))
        .withColumn("block", F.when(indexed, F.col("own")).otherwise(F.col("other")))
        .withColumn("looker", F.when(indexed, F.col("other")).otherwise(F.col("own")))
    )


def _joined(a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Component labels of nodes after linking ``a`` with ``b``; labels are node numbers."""
    while True:
        new = label.copy()
        np.minimum.at(new, label[a], label[b])
        np.minimum.at(new, label[b], label[a])
        new = new[new]
        new = np.minimum(new, new[label])
        if (new == label).all() and (label[a] == label[b]).all():
            return label
        label = new


def _linked(model, threshold: float, radius: float):
    """The work of a group: links found, as counts and as a tree per component."""

    def found(table: pa.Table) -> pa.Table:
        m = pickle.loads(model.value)
        coarse, books, width = m["coarse"], m["books"], m["width"]
        indexed = np.array(table.column("codes").is_valid().to_pylist(), bool)
        cls = table.column("cls").to_numpy()
        sizes = table.column("n").to_numpy()
        x = _padded(table.column("unit").to_pylist(), coarse.shape[1])
        entry, look = np.flatnonzero(indexed), np.flatnonzero(~indexed)
        listed = coarse[table.column("list")[0].as_py()]
        packed = [c for c in table.column("codes").to_pylist() if c is not None]
        codes = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, SUBSPACES)
        reach = radius + table.column("rest").to_numpy()[entry] + _SLACK
        node = np.unique(cls, return_inverse=True)
        label, links = np.arange(len(node[0])), np.zeros(len(look), np.int64)
        for start in range(0, len(look), _CHUNK):
            q = look[start : start + _CHUNK]
            residual = _split(x[q] - listed, width)
            distance = np.zeros((len(q), len(entry)))
            for s, book in enumerate(books):
                to = ((residual[:, s, None] - book[None]) ** 2).sum(2)
                distance += to[:, codes[:, s]]
            near_q, near_e = np.nonzero(distance <= reach**2)
            for part in range(0, len(near_q), 1 << 16):
                a, b = q[near_q[part : part + (1 << 16)]], entry[near_e[part : part + (1 << 16)]]
                same = (cls[a] != cls[b]) & (np.einsum("ij,ij->i", x[a], x[b]) >= threshold)
                a, b = a[same], b[same]
                np.add.at(links, np.searchsorted(look, a), sizes[b])
                label = _joined(node[1][a], node[1][b], label)
        hung = np.flatnonzero(label != np.arange(len(label)))
        some = np.flatnonzero(links)
        return pa.table(
            {
                "cls": pa.array(np.concatenate([cls[look[some]], node[0][hung]])),
                "links": pa.array(np.concatenate([links[some], np.zeros(len(hung), np.int64)])),
                "to": pa.array([None] * len(some) + node[0][label[hung]].tolist(), pa.int64()),
            }
        )

    return found


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.98,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    Vectors of equal, non-null labels are linked when their cosine, in double precision, is
    ``threshold`` or more; those of other lengths never are. A vector that is null, empty,
    all zero, or holds null or non-finite components links with nothing. n_links counts the
    other vectors linked directly, repeated rows among them; component_id is the smallest
    vec_id reachable; kept tells whether it is the vector's own. Equal vectors are handled
    as one, and no list of pairs is ever made. The quantiser is fitted on about TRAIN_ROWS
    vectors; every vector is indexed and looks through all lists that can matter, so the
    fit decides the speed and not the result. An empty table gives an empty result.
    """
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"),
        F.col(label).cast("string").alias("label"),
    )
    units = stored(
        rows.mapInArrow(_units, "vec_id long, label string, dim int, cls long, unit binary"),
        "units",
    )
    classes = stored(
        units.where("cls IS NOT NULL")
        .groupBy("label", "dim", "cls")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("unit").alias("unit")),
        "classes",
    )
    total, width = classes.agg(F.count(F.lit(1)), F.max("dim")).first()
    result = units.select("vec_id", "cls")
    if total:
        picked = classes.where(F.pmod("cls", F.lit(max(total, 1))) < TRAIN_ROWS).select("unit")
        sample = _padded([r[0] for r in picked.limit(2 * TRAIN_ROWS).toLocalIterator()], width)
        if not len(sample):  # a few classes whose hashes all miss
            sample = _padded([classes.select("unit").first()[0]], width)
        lists = int(min(MOST_LISTS, max(1, np.sqrt(total) / 2)))
        model = vectors.sparkSession.sparkContext.broadcast(pickle.dumps(fit(sample, lists)))
        radius = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
        entries = stored(_index(classes, model, radius), "entries")
        found = stored(
            _blocks(entries)
            .groupBy("label", "dim", "list", "block", "looker")
            .applyInArrow(_linked(model, threshold, radius), "cls long, links long, to long"),
            "links",
        )
    else:
        found = classes.select("cls", F.lit(0).cast("long").alias("links"), F.col("cls").alias("to"))
    groups = components(found.where("to IS NOT NULL").select("cls", F.col("to")), "cls", "to")
    linked = found.groupBy("cls").agg(F.sum("links").alias("links"))
    known = (
        classes.select("cls", "least", "n")
        .join(linked, "cls", "left")
        .join(groups.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("component", F.coalesce("component", "cls"))
    )
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "component").select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    whole = result.where("cls IS NOT NULL").join(known, "cls")
    alone = result.where("cls IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        whole.select("vec_id", "n_links", "component_id")
        .unionAll(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
