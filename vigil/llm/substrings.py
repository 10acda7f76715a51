"""Repeated byte strings: removes every byte that a string of ``length`` bytes
covers which also starts somewhere else, by sorting suffixes.

1. Anchors deal the suffixes out. Of every window of ``length`` bytes the
   smallest hashed 8-gram among its first ``SPREAD`` positions is the window's
   anchor. Equal windows have their anchor at the same place, and all windows of
   an anchor hold the ``length - SPREAD + 1`` bytes that follow it, so suffixes
   that can share ``length`` bytes meet under the hash of those bytes. One row
   per anchor (about one for 70 bytes) stands for its run of window starts.
2. Only anchors whose bytes occur twice can have repeated windows; they are
   counted before any row is joined. Texts that occur more than once as a whole
   are repeated throughout; one of them goes on for the others' sake.
3. The texts of such anchors, from their first window start to the end of their
   last window, meet under the anchor's hash. Each batch of whole groups gets its
   suffix order by the difference-cover method (``diffcover``: sorted sample
   triples, recursion on their names, merge of the remaining suffixes), and
   neighbours in that order are compared over ``length`` bytes. Equal contexts
   are collapsed first. A group of more than ``GROUP`` contexts does not go to
   one task: its windows are counted one by one by a distributed aggregate.
4. The union of the repeated windows is cut from each text.

One exchange of the texts by document serves the contexts and the result.

Defined cases: null text is empty; texts shorter than ``length`` lose nothing;
repeated rows are copies of each other and lose everything (from ``length``
bytes on); matches do not cross rows; a null doc_id is a row like others; an
empty table gives an empty result. Extra columns are ignored. ``length`` is at
least 16 and at most 216 bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import prepare, salted_join, written
from vigil.llm.diffcover import DEPTH, order, same_prefix

LENGTH = 200
SPREAD = 141
#: Contexts of one anchor that a task sorts together (about 7 MB of text); more
#: take the distributed count.
GROUP = 20_000
#: Bytes of contexts that are sorted at once.
SORTED_BYTES = 2 << 20
#: Bytes of a text that are worked on at once (longer texts in overlapping parts).
PART = 4 << 20

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M2
    return h ^ (h >> np.uint64(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_POWERS: dict[str, np.ndarray] = {}


class Spans:
    """Hashes of any byte strings of a text, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_POWERS.get("up", ())) < n:
            size = max(2 * n, 1 << 14)
            _POWERS["up"], _POWERS["down"] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(_TABLE[data] * _POWERS["up"][:n - 1], out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _mix((self.sums[b] - self.sums[a]) * _POWERS["down"][a])


def anchors(data: np.ndarray, length: int, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window start, last window start) of each anchor of a part."""
    n = len(data) - length + 1  # windows
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    x = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    x = x[:-1] | x[1:] << np.uint64(8)
    x = x[:-2] | x[2:] << np.uint64(16)
    x = x[:-4] | x[4:] << np.uint64(32)
    x = _mix(x * _M1)
    bits = np.uint64(24)  # the place breaks ties, the leftmost wins
    x = (x >> bits << bits) | np.arange(len(x), dtype=np.uint64)
    m, w = x, 1
    while 2 * w <= spread:
        m = np.minimum(m[:len(m) - w], m[w:])
        w *= 2
    m = np.minimum(m[:n], m[spread - w:spread - w + n])
    place = (m & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[first], first, np.append(first[1:], n) - 1


def text_anchors(data: np.ndarray, length: int, spread: int):
    """(hash, place, first, last) of all anchors of a text, whatever its size."""
    out = []
    for at in range(0, max(1, len(data) - length + 1), PART):
        part = data[at:at + PART + length - 1]
        place, first, last = anchors(part, length, spread)
        if len(place):
            h = Spans(part)(place, place + (length - spread + 1))
            out.append((h, place + at, first + at, last + at))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3


def _identified(docs: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return (docs.select(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit((1 << 63) - 1)).alias("did"), t.alias("text"))
            .select("no_id", "text", "did",
                    F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2")))


def _anchored(rows: DataFrame, length: int, spread: int) -> DataFrame:
    """(h, did, t1, a): a packs place, window starts before it and their number."""
    def run(batches):
        for batch in batches:
            for did, t1, t in zip(*(c.to_pylist() for c in batch.columns)):
                h, place, first, last = text_anchors(np.frombuffer(t.encode("utf-8"), np.uint8), length, spread)
                if len(h):
                    packed = (place << 16) | ((place - first) << 8) | (last - first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(np.full(len(h), did)), pa.array(np.full(len(h), t1)),
                         pa.array(packed)], names=["h", "did", "t1", "a"])

    return rows.select("did", "t1", "text").mapInArrow(_gathered(run), "h long, did long, t1 long, a long")


def _gathered(run, most: int = 20_000):
    """Joins small result batches into larger ones."""
    def gather(batches):
        held, n = [], 0
        for out in run(batches):
            held.append(out)
            n += out.num_rows
            if n >= most:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return gather


CONTEXT = "h long, did long, t1 long, first long, context binary"


def _contexts(rows: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """(h, did, t1, first, context) of the anchors to compare: the bytes from
    the first window start to the end of the last window."""
    names = [c.split()[0] for c in CONTEXT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    per_text = (asked.groupBy(F.col("did").alias("d"), F.col("t1").alias("t"))
                .agg(F.collect_list(F.struct("h", "a")).alias("as")))
    met = rows.join(per_text.hint("merge"), (F.col("did") == F.col("d")) & (F.col("t1") == F.col("t")))

    def made(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches):
        out = []
        for batch in batches:
            for did, t1, t, found in zip(*(batch.column(k).to_pylist() for k in range(4))):
                data = t.encode("utf-8")
                for x in found:
                    a = x["a"]
                    first = (a >> 16) - (a >> 8 & 255)
                    out.append((x["h"], did, t1, first, data[first:first + (a & 255) + length]))
                if len(out) > 4000:
                    yield made(out)
                    out = []
        if out:
            yield made(out)

    # no_id goes in as well: the same columns as for the result, hence the same exchange.
    return met.select("did", "t1", "text", "as", F.col("no_id").alias("_1")).mapInArrow(run, CONTEXT)


def _runs(did, t1, first, row, k):
    """Batch of (did, t1, a, b): runs of repeated window starts, from (row, window) in order."""
    if not len(row):
        return None
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (k[1:] != k[:-1] + 1)])
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(row)) - 1
    r = row[start]
    return pa.RecordBatch.from_arrays([pa.array(did[r]), pa.array(t1[r]), pa.array(first[r] + k[start]), pa.array(first[r] + k[stop])],
                                      names=["did", "t1", "a", "b"])


RUNS = "did long, t1 long, a long, b long"


def _repeated(h: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(context, window in it) of every window of whole groups that occurs twice."""
    number: dict[tuple[int, bytes], int] = {}
    which = np.array([number.setdefault(k, len(number)) for k in zip(h.tolist(), contexts)])
    copies = np.bincount(which)
    distinct = [c for _, c in number]
    size = np.fromiter(map(len, distinct), np.int64, len(distinct))
    begin = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(begin, size)
    ranked, x = order(np.frombuffer(b"".join(distinct), np.uint8), at - np.repeat(size - length, size))
    same = same_prefix(x, ranked[1:], ranked[:-1], length)
    hit = np.zeros(len(at), bool)
    hit[ranked[1:][same]] = True
    hit[ranked[:-1][same]] = True
    hit |= np.repeat(copies > 1, size) & (at <= np.repeat(size - length, size))
    # From distinct contexts back to all of them.
    place = np.flatnonzero(hit)
    of = np.searchsorted(begin, place, side="right") - 1
    count = np.bincount(of, minlength=len(distinct))
    start = np.cumsum(count) - count
    n = count[which]
    row = np.repeat(np.arange(len(which)), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[which], n)
    return row, (place - begin[of])[k]


def _compare_small(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the groups that fit a task, in batches of whole groups in order of h."""
    def flush(rows):
        t = pa.Table.from_batches(rows).combine_chunks()
        h, did, t1, first = (t.column(c).to_numpy() for c in ("h", "did", "t1", "first"))
        cut = np.flatnonzero(h[1:] != h[:-1]) + 1
        size = np.cumsum([0, *(len(c) for c in t.column("context").to_pylist())])
        edges, last = [0], 0
        for c in [*cut.tolist(), len(h)]:  # groups, joined up to SORTED_BYTES
            if size[c] - size[edges[-1]] > SORTED_BYTES and last > edges[-1]:
                edges.append(last)
            last = c
        edges.append(len(h))
        for a, b in zip(edges, edges[1:]):
            row, k = _repeated(h[a:b], t.column("context").slice(a, b - a).to_pylist(), length)
            out = _runs(did[a:b], t1[a:b], first[a:b], row, k)
            if out is not None:
                yield out

    def run(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column(0).to_numpy()
            if held and held[-1].column(0)[-1].as_py() != h[0]:
                yield from flush(held)
                held = []
            cut = int(np.searchsorted(h, h[-1]))  # the last group may go on in the next batch
            if cut:
                yield from flush([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from flush(held)

    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, RUNS)


def _compare_large(contexts: DataFrame, length: int) -> DataFrame:
    """Repeated windows of larger groups: one row per window, counted by hash."""
    def spread(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            h, did, t1, first = (batch.column(k).to_numpy() for k in range(4))
            contexts = batch.column(4).to_pylist()
            size = np.fromiter(map(len, contexts), np.int64, len(contexts))
            count = size - length + 1
            row = np.repeat(np.arange(len(size)), count)
            k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            at = (np.cumsum(size) - size)[row] + k
            w = Spans(np.frombuffer(b"".join(contexts), np.uint8))(at, at + length)
            w = _mix(w ^ (h[row].view(np.uint64) * _M1))
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(did[row]), pa.array(t1[row]), pa.array(first[row] + k)],
                                             names=["w", "did", "t1", "a"])

    each = contexts.mapInArrow(spread, "w long, did long, t1 long, a long")
    twice = each.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w")
    return salted_join(each, twice, "w", "inner").select("did", "t1", "a", F.col("a").alias("b"))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (binary) of every row."""
    if not 16 <= length <= DEPTH:
        raise ValueError(f"length {length} is not in 16..{DEPTH}")
    spread = length * SPREAD // LENGTH
    prepare(docs.sparkSession)
    rows = _identified(docs, text)
    found = written(_anchored(rows, length, spread), "anchors")
    twice = (found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
             .select("h", (F.col("n") > group).alias("many")))
    ids = rows.select("did", "t1", "t2")
    copies = (ids.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n"), F.min("did").alias("lead"))
              .filter("n > 1").select("t1", "t2", "lead"))
    copied = written(salted_join(ids.distinct(), copies.select("t1", "t2", "lead"), ["t1", "t2"], "inner"), "copies")
    # Of equal texts only the first is compared with the others.
    others = copied.filter("did <> lead").select("did", "t1")
    asked = salted_join(found, twice.hint("merge"), "h", "inner").join(others.hint("merge"), ["did", "t1"], "left_anti")
    asked = written(asked.select("h", "did", "t1", "a", "many"), "asked")

    texts = rows.select("no_id", "text", "did", "t1")
    runs = (_compare_small(_contexts(texts, asked.filter("not many"), length), length)
            .unionByName(_compare_large(_contexts(texts, asked.filter("many"), length), length))
            # A repeated text is covered as a whole.
            .unionByName(copied.select("did", "t1", F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b"))))
    cut = runs.groupBy(F.col("did").alias("d"), F.col("t1").alias("t")).agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    joined = texts.join(cut.hint("merge"), (F.col("did") == F.col("d")) & (F.col("t1") == F.col("t")), "left")

    def finish(batches):
        for batch in batches:
            out = []
            for t, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = t.encode("utf-8")
                if not found:
                    out.append((len(data), 0, 0, data))
                    continue
                starts = np.array([(x["a"], x["b"]) for x in found])
                if starts[:, 0].min() < 0:  # a copy
                    starts = np.array([(0, len(data) - length)]) if len(data) >= length else starts[:0]
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, starts[:, 0], 1)
                np.add.at(edge, starts[:, 1] + length, -1)
                gone = np.cumsum(edge)[:-1] > 0
                spans = int((gone[1:] & ~gone[:-1]).sum()) + int(gone[:1].sum())
                out.append((len(data), int(gone.sum()), spans, np.frombuffer(data, np.uint8)[~gone].tobytes()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.select(F.when(~F.col("no_id"), F.col("did")).alias("doc_id"), "text", "runs").mapInArrow(
        finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
