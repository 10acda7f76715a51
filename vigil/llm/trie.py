"""Vector codes: product codebooks refined over a trie of the distinct parts.

A vector's components become integers and are cut into equal parts. For each
part position a codebook of at most ``entries`` entries starts from the vectors
with the smallest ids; each round assigns every part to its nearest entry and
moves the entries to their parts' means, all in integers.

Equal parts are counted once: a table of the distinct parts of each position
with their weights, in lexicographic order. A task reads runs of that order and
walks them as a trie, depth first. A node stands for the first dimensions of its
parts and holds the distances that these add to every entry, so parts that
share a prefix share this vector; at the leaves the nearest entry is the argmin,
and its weighted sum and count grow by the part. Subtrees of few parts are done
one level at a time as arrays. Only sums by position, entry and dimension come
to the driver.

Defined cases: vectors that are null or hold a null or a component that is not finite are
left out, and so are those whose length is not that of the kept vector with
the smallest vec_id; the length must be a multiple of ``parts`` (an error says so).
A null vec_id comes after all others; equal vec_ids go by their vectors, equal
rows are all kept. With fewer kept vectors than entries the codebooks are
smaller; an empty table gives an empty result. Null labels are one label.
Components beyond +-2^27 once scaled (32768 before) are taken as that bound, so
that every distance fits a long. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import prepare, salted_join, written

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE = 4096
BOUND = 1 << 27
#: Parts of a subtree that is done level by level.
SUBTREE = 1 << 13


def scaled(vector: Column) -> Column:
    """floor(4096 * x) of each component, as longs."""
    within = lambda x: F.greatest(F.lit(-float(BOUND)), F.least(F.lit(float(BOUND)), x.cast("double") * SCALE))
    return F.transform(vector, lambda x: F.floor(within(x)).cast("long"))


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _levels(parts: np.ndarray, depth: int, above: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Distances of sorted distinct parts (all below one node) to every entry:
    level by level, a distance vector for each node, from its parent's."""
    n, dims = parts.shape
    new = np.zeros(n, bool)
    new[0] = True
    parent = np.zeros(n, np.int64)  # each part's node of the level above
    acc = above[None, :]
    for d in range(depth, dims):
        new[1:] |= parts[1:, d] != parts[:-1, d]
        first = np.flatnonzero(new)
        gap = parts[first, d][:, None] - book[None, :, d]
        acc = acc[parent[first]] + gap * gap
        parent = np.cumsum(new) - 1
    return acc[parent]


def walk(parts: np.ndarray, book: np.ndarray, found, depth: int = 0, above: np.ndarray | None = None, at: int = 0) -> None:
    """Depth-first over the trie of ``parts`` (sorted, distinct). At the leaves
    ``found(first, distances)`` gets the distances of consecutive parts."""
    if above is None:
        above = np.zeros(len(book), np.int64)
    if len(parts) <= SUBTREE or depth == parts.shape[1]:
        if len(parts):
            found(at, _levels(parts, depth, above, book))
        return
    column = parts[:, depth]
    first = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
    ends = np.append(first[1:], len(parts))
    # Neighbouring children that are small together go through the levels as one.
    low = 0
    while low < len(first):
        high = low + 1
        while high < len(first) and ends[high] - first[low] <= SUBTREE:
            high += 1
        rows = slice(first[low], ends[high - 1])
        if high - low > 1:
            found(at + int(first[low]), _levels(parts[rows], depth, above, book))
        else:
            gap = column[first[low]] - book[:, depth]
            walk(parts[rows], book, found, depth + 1, above + gap * gap, at + int(first[low]))
        low = high


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of sorted distinct parts; ties go to the lower entry."""
    entry, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)

    def found(at, distances):
        best = distances.argmin(axis=1)
        entry[at:at + len(best)] = best
        error[at:at + len(best)] = distances[np.arange(len(best)), best]

    walk(parts, book, found)
    return entry, error


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, width)


def distinct_parts(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """(position, part, n) in lexicographic order: a table whose files are runs of it."""
    size = width // parts
    pieces = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)),
                         lambda j: F.struct(j.alias("position"), F.slice(F.col("v"), j * size + 1, size).alias("part")))
    counted = rows.select(F.inline(pieces)).groupBy("position", "part").agg(F.count(F.lit(1)).alias("n"))
    return written(counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "parts")


def _sums(books: np.ndarray, size: int):
    """Weighted sums and counts of each position's entries over runs of parts."""
    positions, entries = books.shape[:2]

    def run(batches):
        total = np.zeros((positions, entries, size + 1), np.int64)
        for batch in batches:
            position, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            part = _matrix(batch.column(1), size)
            for j in np.unique(position).tolist():
                own = position == j
                entry, _ = nearest(part[own], books[j])
                np.add.at(total[j], entry, np.concatenate([part[own], np.ones((own.sum(), 1), np.int64)], axis=1) * n[own][:, None])
        used = np.flatnonzero(total[:, :, -1].reshape(-1))
        flat = total.reshape(-1, size + 1)[used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, size + 1), pa.int32()), pa.array(np.tile(np.arange(size + 1), len(used)), pa.int32()),
             pa.array(flat.reshape(-1))], names=["entry", "dim", "total"])

    return run


def refine(table: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks (position, entry, dimension) after ``rounds`` rounds over the distinct parts."""
    positions, entries, size = books.shape
    for _ in range(rounds):
        got = (table.mapInArrow(_sums(books, size), "entry int, dim int, total long")
               .groupBy("entry", "dim").agg(F.sum("total").alias("total")).collect())  # at most entries * (size + 1) a position
        total = np.zeros((positions * entries, size + 1), np.int64)
        for r in got:
            total[r["entry"], r["dim"]] = r["total"]
        count = total[:, -1:]
        moved = total[:, :-1] // np.maximum(count, 1)  # rounds down
        books = np.where(count > 0, moved, books.reshape(-1, size)).reshape(positions, entries, size)
    return books


def codes(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """Each row's ``code`` (two hex digits a part) and ``error`` from the codebooks."""
    positions, _, size = books.shape
    digits = np.array([f"{k:02x}" for k in range(256)])

    def run(batches):
        for batch in batches:
            v = _matrix(batch.column(2), positions * size)
            text, error = np.full(len(v), "", "U1"), np.zeros(len(v), np.int64)
            for j in range(positions):
                distinct, place = np.unique(v[:, j * size:(j + 1) * size], axis=0, return_inverse=True)
                entry, far = nearest(distinct, books[j])
                text = np.char.add(text, digits[entry][place.reshape(-1)])
                error += far[place.reshape(-1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text.tolist(), pa.string()), pa.array(error)],
                                             names=["vec_id", "label", "code", "error"])

    kind = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v").mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(str(x) for x in books.reshape(-1).tolist())


def compress(vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(a row per kept vector: vec_id, label, code, error, label_error; the
    codebooks by position, entry, dimension). ``entries`` is at most 256."""
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col(vector)
    rows = written(vectors.filter(usable(v)).select(F.col("vec_id").cast("long").alias("vec_id"), "label", scaled(v).alias("v")), "vectors")
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    leader = rows.orderBy(*order).limit(1).collect()
    if not leader:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error")), np.zeros((parts, 0, 0), np.int64)
    width = len(leader[0]["v"])
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    rows = rows.filter(F.size("v") == width)
    first = [r["v"] for r in rows.orderBy(*order).limit(entries).collect()]
    books = np.array(first, np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    books = refine(distinct_parts(rows, width, parts), books, rounds)
    coded = codes(rows, books)
    known = F.coalesce(F.col("label").cast("string"), F.lit(""))
    coded = written(coded.withColumn("_label", F.struct(F.col("label").isNull().alias("none"), known.alias("name"))), "codes")
    sums = coded.groupBy("_label").agg(F.sum("error").alias("label_error"))
    return salted_join(coded, sums, "_label", "inner").select("vec_id", "label", "code", "error", "label_error"), books


def digest(made: tuple[DataFrame, np.ndarray]) -> DataFrame:
    rows, books = made
    sha = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return rows.select("vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
