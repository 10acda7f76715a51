"""Blocks of texts with a dictionary each, and messages between blocks and parts.

Operators that need something for every distinct word of the corpus at every
place where it occurs would move a row for each occurrence. Here texts are cut
into blocks of a bounded number of bytes, each word of a block is coded once,
and only the distinct words of a block travel: grouped by *part* (a hash of the
word), one packed row for each block and part. Everything that is known of a
word meets in its part; what the part answers goes back to the block as one
packed row again and is put in place of the codes. Packed arrays are compressed
byte plane by byte plane, and a block numbers its words by frequency, so that
most planes are nearly empty.

Blocks and parts grow in number with the input and stay alike in size, so no
group is larger because a word, a source or a document is frequent: a word is
at most once in a block. A single very long text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import prepare, work_dir

#: Bytes of text of a block; bytes of text for each part, and the least number of parts.
BLOCK_BYTES = 8 << 20
PART_BYTES = 12 << 20
LEAST_PARTS = 16

#: ASCII white space separates words (fixed values of the contracts).
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Messages sort before the block's own row.
OWN_ROW = 100
MESSAGE = "block long, part int, tag int, payload binary"


def squeeze(a: np.ndarray) -> bytes:
    """An array of numbers as compressed bytes (its type and length come first)."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return a.dtype.char.encode() + len(a).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(a) else b"")


def expand(b: bytes) -> np.ndarray:
    kind, n = np.dtype(b[:1].decode()), int.from_bytes(b[1:9], "little")
    if not n:
        return np.zeros(0, kind)
    planes = pa.decompress(b[9:], decompressed_size=n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(-1)


def part_count(docs: DataFrame, text: str) -> int:
    """Parts for these texts, from their bytes (counted once)."""
    total = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("long"))).first()[0] or 0
    return max(LEAST_PARTS, -(-total // PART_BYTES))


def split_words(texts: list[bytes], lower: bool, gaps: np.ndarray = _GAP) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts as one binary array, and how many each text has.
    ``gaps`` says of each byte whether it parts words (a line feed must)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    gap = gaps[data]
    word = ~gap
    first = word.copy()
    first[1:] &= gap[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    counts = np.diff(np.append(0, np.searchsorted(starts, ends)))
    kept = np.cumsum(word, dtype=np.int32 if len(word) < 1 << 31 else np.int64)
    offsets = np.append(kept[starts] - 1, kept[-1:])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[word]))])
    return words, counts


def hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word of a large binary array: a polynomial of its bytes, mixed."""
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    if not len(words):
        return np.zeros(0, np.uint64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].astype(np.uint64) + np.uint64(1)
    start, size = offsets[:-1] - offsets[0], np.diff(offsets)
    powers = np.cumprod(np.concatenate([[1], np.full(max(int(size.max()) - 1, 0), 0x9E3779B97F4A7C15, np.uint64)]).astype(np.uint64))
    h = np.add.reduceat(data * powers[np.arange(len(data)) - np.repeat(start, size)], start)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def coded(words: pa.Array, parts: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words by falling frequency, the part of each, the code of every word)."""
    both = words.dictionary_encode()
    codes = both.indices.to_numpy()
    order = np.argsort(-np.bincount(codes, minlength=len(both.dictionary)), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    distinct = both.dictionary.take(pa.array(order))
    return distinct, part_of(distinct, parts), place[codes]


def part_of(words: pa.Array, parts: int) -> np.ndarray:
    return (hashes(words) % np.uint64(parts)).astype(np.int32)


def packed(words: pa.Array) -> tuple[bytes, bytes]:
    """(the bytes of the words, their sizes) of a slice of a large binary array."""
    if not len(words):
        return squeeze(np.zeros(0, np.uint8)), squeeze(np.zeros(0, np.int32))
    offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return squeeze(data), squeeze(np.diff(offsets).astype(np.int32))


def unpacked(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes, dtype=np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def cut(docs: DataFrame, text: str, meta: list[str], parts: int, lower: bool = False, flag: str | None = None,
        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The blocks of ``docs`` as a table in the shared folder. Rows with a null
    ``part`` are the blocks: ``codes`` (of every word), ``parts`` (of every code),
    ``lens`` (words of each text), all squeezed, and the ``meta`` columns as arrays.
    The others are their dictionaries: ``words`` and ``sizes`` of one part, and
    ``counts``, how often each word occurs in the texts whose boolean column
    ``flag`` holds (in all without a flag). A null text has no words; ``meta`` and
    ``flag`` must not be named like a column made here."""
    prepare(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_text"), *meta)
    arrays = ", ".join(f"`{c}` array<{rows.schema[c].dataType.simpleString()}>" for c in meta)
    schema = f"block long, part int, codes binary, parts binary, lens binary, words binary, sizes binary, counts binary, {arrays}"
    names = ["block", "part", "codes", "parts", "lens", "words", "sizes", "counts", *meta]

    def block_rows(block: int, texts: list[bytes], columns: list[pa.Array]):
        words, lens = split_words(texts, lower)
        distinct, part, codes = coded(words, parts)
        seen = codes
        if flag is not None:
            seen = codes[np.repeat(columns[meta.index(flag)].to_numpy(zero_copy_only=False).astype(bool), lens)]
        counts = np.bincount(seen, minlength=len(distinct)).astype(np.int64)
        lists = [pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), c) for c in columns]
        own = [pa.array([squeeze(x)], pa.binary()) for x in (codes, part, lens.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.nulls(1, pa.int32()), *own, *[pa.nulls(1, pa.binary())] * 3, *lists], names=names)
        order = np.argsort(part, kind="stable")
        used, first = np.unique(part[order], return_index=True)
        distinct, counts = distinct.take(pa.array(order)), counts[order]
        ranges = list(zip(first.tolist(), [*first[1:].tolist(), len(order)]))
        if ranges:
            pieces = [packed(distinct.slice(low, high - low)) for low, high in ranges]
            n = len(used)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array(used, pa.int32()), *[pa.nulls(n, pa.binary())] * 3,
                 pa.array([d for d, _ in pieces], pa.binary()), pa.array([e for _, e in pieces], pa.binary()),
                 pa.array([squeeze(counts[low:high]) for low, high in ranges], pa.binary()),
                 *[pa.nulls(n, x.type) for x in lists]], names=names)

    def run(batches):
        # The rows of an input partition are the same in every attempt, so a block's number is too.
        block, texts, held, size = TaskContext.get().partitionId() << 32, [], [], 0

        def made():
            table = pa.Table.from_batches(held).combine_chunks()
            columns = [table.column(c).combine_chunks() if len(held) > 1 else table.column(c).chunk(0) for c in meta]
            return block_rows(block, texts, columns)

        for batch in batches:
            own_texts = batch.column(0).to_pylist()
            others = batch.select(meta)
            at = 0
            for k, t in enumerate(own_texts):
                if texts and size + len(t) > block_bytes:
                    if k > at:
                        held.append(others.slice(at, k - at))
                    yield from made()
                    block, texts, held, size, at = block + 1, [], [], 0, k
                texts.append(t)
                size += len(t) + 1
            if len(own_texts) > at:
                held.append(others.slice(at))
        if texts:
            yield from made()

    path = work_dir(docs.sparkSession, "blocks")
    made = rows.mapInArrow(run, schema)
    (made.withColumn("kind", F.when(F.col("part").isNull(), F.lit("block")).otherwise(F.lit("words")))
     .write.partitionBy("kind").parquet(path))
    return docs.sparkSession.read.schema(f"{schema}, kind string").parquet(path)


def dictionaries(table: DataFrame) -> DataFrame:
    return table.filter("kind = 'words'").select("block", "part", "words", "sizes", "counts")


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, Iterator[dict]]]:
    """Consecutive rows of one key, as dictionaries, in a stream sorted by it.
    Rows are packed (thousands of words each), so one step for each is cheap."""
    import itertools

    def rows():
        for batch in batches:
            for k in range(batch.num_rows):
                yield {c: batch.column(i)[k] for i, c in enumerate(batch.schema.names)}

    return itertools.groupby(rows(), key=lambda r: r[key].as_py())


def by_part(messages: DataFrame, fn: Callable[[int, Iterator[dict]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn(part, rows)`` over the packed rows of each part, in order of their blocks."""
    def run(batches):
        for part, rows in runs(batches, "part"):
            yield from fn(part, rows)

    return messages.repartition("part").sortWithinPartitions("part", "block").mapInArrow(run, schema)


def message(block: int | None, part: int | None, tag: int, payload: np.ndarray) -> pa.RecordBatch:
    """One row of ``MESSAGE``."""
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([part], pa.int32()), pa.array([tag], pa.int32()),
         pa.array([squeeze(payload)], pa.binary())], names=["block", "part", "tag", "payload"])


def by_block(table: DataFrame, meta: list[str], answers: DataFrame,
             fn: Callable[[dict, dict[int, np.ndarray], list[tuple[int, int]]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn(block row, {tag: payload}, sizes)`` for each block. Payloads are the
    messages that the parts sent it (``MESSAGE``), those of a tag joined in the
    order of the parts; the row's ``codes`` are numbered in that order too.
    ``sizes`` has each part and the length of its last message."""
    own = table.filter("kind = 'block'").select("block", "codes", "parts", "lens", *meta)
    empty = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("codes", "parts", "lens", *meta)]
    rows = (own.select("block", F.lit(None).cast("int").alias("part"), F.lit(OWN_ROW).alias("tag"),
                       F.lit(None).cast("binary").alias("payload"), "codes", "parts", "lens", *meta)
            .unionAll(answers.select("block", "part", "tag", "payload", *empty)))

    def run(batches):
        for block, group in runs(batches, "block"):
            got: dict[int, list[np.ndarray]] = {}
            sizes: dict[int, int] = {}
            for row in group:
                tag = row["tag"].as_py()
                if tag == OWN_ROW:
                    part = expand(row["parts"].as_py())
                    place = np.empty(len(part), np.int32)
                    place[np.argsort(part, kind="stable")] = np.arange(len(part), dtype=np.int32)
                    made = {"block": block, "codes": place[expand(row["codes"].as_py())], "lens": expand(row["lens"].as_py()),
                            **{c: row[c].values for c in meta}}
                    yield from fn(made, {k: np.concatenate(v) for k, v in got.items()}, list(sizes.items()))
                else:
                    payload = expand(row["payload"].as_py())
                    got.setdefault(tag, []).append(payload)
                    sizes[row["part"].as_py()] = len(payload)

    return rows.repartition("block").sortWithinPartitions("block", "tag", "part").mapInArrow(run, schema)
