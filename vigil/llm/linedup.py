"""Line deduplication: exact repeats, and lines within a small edit distance.

Lines are split at ``\\n``; lines without a word stay. In order of (doc_id,
text hash, position), a line goes when the same line came before anywhere in
the corpus, or when a near line came first: a different one within as many edits
(code points) as ``steps`` grants the longer of the two. By default that is none
under 16 code points, where one edit makes another word or number, 1 from 16,
2 from 32 and 3 from 256 on.

Edit join. A line of length L is cut into threshold + 1 even segments. A line
within ``threshold`` edits that isn't shorter contains one of them unchanged,
at a start that the length difference confines. Each line therefore enters its
segments under (threshold, length, segment, text hash) and probes, for every
shorter length in reach and every segment, only those substrings that can hold
it with the edits split left and right. It probes with its own threshold and
enters with that of each length in reach above it, so lines meet across a step.
Hashes of all substrings come from prefix sums over a whole batch of texts. Keys
meet as packed rows, a bucket of keys at a time. Only lines that meet another one
within a few bits of a parity signature of character pairs, which each edit can
change in at most four bits, go on (a key of very many lines is split by parts of
it). No pairs are formed: the lines of a key are put in order, and each is compared
on its full text, by a banded bit-parallel edit distance, with the earliest ones
first until one is near.

Exact repeats are collapsed first (per text, per task, then by key), so a line
that fills a third of the corpus enters once. The documents' texts cross one
exchange, used both for the check and for the result.

Defined cases: null text stays null and has no lines; texts and lines of any
length are compared whole; rows equal in doc_id and
text count as one document and keep the same lines; a null doc_id sorts last;
ties cannot occur beyond that; an empty table gives an empty result; other
columns are carried unless they are named like an output column.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import SALTS, kept, prepare, schema_of, slices, written

#: (length, edits): lines of so many code points or more may differ by so many edits.
STEPS = ((16, 1), (32, 2), (256, 3))
#: Rows under one segment key from which the key is split.
HOT_KEY = 20_000
#: Keys are dealt over so many buckets; a task sends the rows that it gathers as a value for each
#: bucket, so many values at a time, and holds so many of a bucket before it looks for hot keys.
BUCKET_BITS, SENT_ROWS, SENT_VALUES, HELD_ROWS = 14, 1 << 20, 1 << 11, 1 << 22
#: Pairs that a task forms at once.
PAIR_ROWS = 1_000_000
#: Lines of a key that are compared with as many others at once, and so few that they go one by one.
COMPARED, FEW = 512, 8
BATCH_CHARS = 400_000
#: Distinct lines that a task remembers so as not to send their keys again.
REMEMBERED = 500_000
LAST_ID = (1 << 63) - 1

_B = 0x9E3779B97F4A7C15
_INV = pow(_B, -1, 1 << 64)
_GAPS = " \t\n\x0b\x0c\r"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


class Substrings:
    """Hashes of substrings of one batch of code points, independent of place."""

    _pow = _powers(_B, 1 << 12)
    _inv = _powers(_INV, 1 << 12)

    def __init__(self, points: np.ndarray):
        n = len(points) + 1
        if len(self._pow) < n:
            type(self)._pow, type(self)._inv = _powers(_B, 2 * n), _powers(_INV, 2 * n)
        x = points.astype(np.uint64) + np.uint64(1)
        x = (x ^ (x << np.uint64(17))) * np.uint64(0xC2B2AE3D27D4EB4F)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(x * self._pow[:n - 1], out=self.sums[1:])

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self._inv[a]


def segments(length, parts: int):
    """(start, size) of even segments of a length (or of an array of lengths)."""
    small = length // parts
    long = length - small * parts  # so many at the end are one longer
    return [(k * small + np.maximum(0, k - (parts - long)), small + (k >= parts - long)) for k in range(parts)]


def granted(length, steps) -> np.ndarray:
    """The edits that ``steps`` grant a line of a length (or each of an array)."""
    starts, edits = zip(*sorted(steps))
    return np.array([0, *edits])[np.searchsorted(starts, length, side="right")]


def checked(steps) -> tuple:
    """``steps`` in order; edits must rise, and each segment hold a few code points."""
    steps = tuple(sorted((int(n), int(e)) for n, e in steps))
    if not steps or any(e < 1 or n < 2 * (e + 1) for n, e in steps) or any(a[1] >= b[1] for a, b in zip(steps, steps[1:])):
        raise ValueError(f"steps must rise in edits, with two code points or more a segment: {steps}")
    return steps


def _tag(h: np.ndarray, length, segment: int, threshold: int) -> np.ndarray:
    h = h * np.uint64(_B) + np.asarray(length).astype(np.uint64) * np.uint64(131) + np.uint64(segment + 1 + 64 * threshold)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(29))


def segment_keys(hashes: Substrings, start: np.ndarray, length: np.ndarray, threshold: int):
    """(row, key) of the segments of lines given by start and length."""
    keys = [_tag(hashes(start + p, start + p + n), length, k, threshold)
            for k, (p, n) in enumerate(segments(length, threshold + 1))]
    return np.tile(np.arange(len(start)), threshold + 1), np.concatenate(keys)


def probe_keys(hashes: Substrings, start: np.ndarray, length: np.ndarray, threshold: int):
    """(row, key) of the substrings that can be a segment of a line that isn't longer."""
    every = np.arange(len(start))
    rows, keys = [], []
    for delta in range(threshold + 1):
        shorter = length - delta
        for k, (p, n) in enumerate(segments(shorter, threshold + 1)):
            # At most k edits left of segment k and threshold - k right of it.
            low = max(-k, delta - (threshold - k))
            high = min(k, delta + (threshold - k))
            for shift in range(low, high + 1):
                a = p + shift
                ok = (a >= 0) & (a + n <= length)
                rows.append(every[ok])
                keys.append(_tag(hashes((start + a)[ok], (start + a + n)[ok]), shorter[ok], k, threshold))
    return np.concatenate(rows), np.concatenate(keys)


def parity(points: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64 parities of hashed neighbouring pairs of each line."""
    h = points.astype(np.uint64) * np.uint64(_B)
    pair = (h[:-1] ^ (h[1:] * np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    flips = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(np.uint64(1) << (pair >> np.uint64(58)))])
    return flips[start + length - 1] ^ flips[start]


def _shared(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def within(a: str, b: str, most: int) -> bool:
    """Edit distance of ``a`` and ``b`` is at most ``most``: bit-parallel over
    the band of 2 * most + 1 diagonals, between what both begin and end with."""
    if len(a) > len(b):
        a, b = b, a
    gap = len(b) - len(a)
    if gap > most:
        return False
    n = _shared(a, b)
    a, b = a[n:], b[n:]
    n = _shared(a[::-1], b[::-1])
    a, b = a[:len(a) - n], b[:len(b) - n]
    if not a:
        return True
    # Bit d of a row's vectors stands for column row + d - most of the table.
    width = 2 * most + 1
    full = (1 << width) - 1
    masks: dict[str, int] = {}
    for i, c in enumerate(b):
        masks[c] = masks.get(c, 0) | 1 << (i + most)
    # reach[e]: diagonals on which e edits suffice for the rows so far.
    reach = [0] * (most + 1)
    for e in range(most + 1):
        for d in range(width):
            if 0 <= d - most <= e:
                reach[e] |= 1 << d
    for i, c in enumerate(a):
        # Columns past the ends of b fall outside the masks and cannot match.
        eq = (masks.get(c, 0) >> i) & full
        before = reach
        reach = [before[0] & eq]
        for e in range(1, most + 1):
            moves = (before[e] & eq) | before[e - 1] | (before[e - 1] >> 1) | (reach[e - 1] << 1)
            reach.append(moves & full)
        # No column before the first or after the last.
        low, high = most - (i + 1), len(b) - (i + 1) + most
        valid = full
        if low > 0:
            valid &= full << low
        if high < width - 1:
            valid &= (1 << (high + 1)) - 1
        reach = [r & valid for r in reach]
        if not reach[most]:
            return False
    return bool(reach[most] >> (gap + most) & 1)


def _lines(text: str) -> list[tuple[int, str]]:
    """(position, line) of the first occurrence in the text of each line with a word."""
    first: dict[str, int] = {}
    for pos, line in enumerate(text.split("\n")):
        if line not in first and line.strip(_GAPS):
            first[line] = pos
    return [(p, line) for line, p in first.items()]


def _hash(line: str) -> tuple[int, int]:
    h = xxhash.xxh128_intdigest(line.encode("utf-8"))
    return (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63)


def _identified(docs: DataFrame, text: str) -> DataFrame:
    t = F.col(text).cast("string")
    return docs.withColumns({"_did": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), "_th": F.xxhash64(t)})


def _occurrences(rows: DataFrame, text: str) -> DataFrame:
    """(did, th, pos, h1, h2): every line of every document once."""
    def run(batches):
        for batch in batches:
            out = []
            for did, th, t in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(did, th, p, *_hash(line)) for p, line in _lines(t)] if t else []
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[k], pa.int32() if k == 2 else pa.int64()) for k in range(5)],
                                                 names=["did", "th", "pos", "h1", "h2"])

    return rows.select("_did", "_th", F.col(text).cast("string")).mapInArrow(run, "did long, th long, pos int, h1 long, h2 long")


KEYS = "bucket int, rows binary"
#: A key row: the key with the side as its last byte, the line's hash, its parity signature.
_ROW, _SHIFT = 24, np.uint64(64 - BUCKET_BITS)


def _joined(key: np.ndarray, side: np.ndarray) -> np.ndarray:
    return (key & ~np.uint64(255)) | side.astype(np.int8).view(np.uint8).astype(np.uint64)


def _side(word: np.ndarray) -> np.ndarray:
    return word.astype(np.uint8).view(np.int8)


def _bucketed(tables):
    """Batches of key rows (``KEYS``): the rows of a bucket, of many tables, as one value."""
    def out(held):
        rows = np.concatenate(held)
        bucket = (rows[:, 0] >> _SHIFT).astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        rows, bucket = rows[order], bucket[order]
        edge = np.flatnonzero(np.diff(bucket, prepend=bucket[0] + np.uint16(1)))
        for k in range(0, len(edge), SENT_VALUES):
            at = edge[k:k + SENT_VALUES]
            end = edge[k + SENT_VALUES] if k + SENT_VALUES < len(edge) else len(rows)
            offsets = (np.append(at, end) - at[0]).astype(np.int32) * np.int32(_ROW)
            values = pa.BinaryArray.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(rows[at[0]:end])])
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at].astype(np.int32)), values], names=["bucket", "rows"])

    held, n = [], 0
    for table in tables:
        held.append(table)
        n += len(table)
        if n >= SENT_ROWS:
            yield from out(held)
            held, n = [], 0
    if n:
        yield from out(held)


def _rows_of(batch: pa.RecordBatch) -> np.ndarray:
    """The key rows of a batch of buckets, in their order."""
    col = batch.column(1)
    offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint64, (offsets[-1] - offsets[0]) // 8, offsets[0]).reshape(-1, 3)


def line_keys(hashes: Substrings, start: np.ndarray, length: np.ndarray, steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, side) of all segments and probes of lines: ``side`` is the
    threshold, negative for a segment."""
    rows, keys, sides = [], [], []
    for _, t in steps:
        enters = np.any([granted(length + d, steps) == t for d in range(t + 1)], axis=0)
        for which, sign, make in ((enters, -1, segment_keys), (granted(length, steps) == t, 1, probe_keys)):
            at = np.flatnonzero(which)
            row, key = make(hashes, start[at], length[at], t)
            rows.append(at[row])
            keys.append(key)
            sides.append(np.full(len(row), sign * t, np.int8))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(sides)


def _keyed(rows: DataFrame, text: str, steps) -> DataFrame:
    """The segments and the probes of the lines that can have a near line."""
    least = min(n - e for n, e in steps)

    def tables(batches):
        sent: set[int] = set()
        for batch in batches:
            texts = [t for t in batch.column(0).to_pylist() if t]
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                lines, ids = [], []
                for t in texts[a:b]:
                    for line in t.split("\n"):
                        if len(line) >= least and line.strip(_GAPS):
                            h = _hash(line)[0]
                            if h not in sent:
                                if len(sent) >= REMEMBERED:
                                    sent.clear()
                                sent.add(h)
                                lines.append(line)
                                ids.append(h)
                if not lines:
                    continue
                length = np.array([len(x) for x in lines], np.int64)
                start = np.cumsum(length) - length
                points = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32)
                row, key, side = line_keys(Substrings(points), start, length, steps)
                yield np.stack([_joined(key, side), np.array(ids, np.int64).view(np.uint64)[row],
                                parity(points, start, length)[row]], axis=1)

    return rows.select(F.col(text).cast("string")).mapInArrow(lambda batches: _bucketed(tables(batches)), KEYS)


def _partnered(key, side, h1, par) -> np.ndarray:
    """Which rows, in order of key, have a partner: a segment and a probe of
    different lines under one key, with parities near enough."""
    found = np.zeros(len(key), bool)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    group = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(key))))
    x, y = np.flatnonzero(side < 0), np.flatnonzero(side > 0)
    m = np.bincount(group[x], minlength=len(edge))  # segments of each key
    first = np.cumsum(m) - m
    n = m[group[y]]
    # Probes in parts, so that the rows of a step stay few.
    cuts = np.flatnonzero(np.diff(np.cumsum(n) // PAIR_ROWS, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(y)]):
        k = n[a:b]
        right = np.repeat(y[a:b], k)
        left = x[np.repeat(first[group[y[a:b]]], k) + np.arange(len(right)) - np.repeat(np.cumsum(k) - k, k)]
        ok = (h1[left] != h1[right]) & (np.bitwise_count(par[left] ^ par[right]) <= 4 * side[right])
        found[left[ok]] = True
        found[right[ok]] = True
    return found


MET = "key long, side tinyint, h1 long, par long"


def _met_batch(word, h1, par, raw: bool):
    names = [c.split()[0] for c in MET.split(", ")]
    side = pa.array(_side(word)) if raw else pa.nulls(len(word), pa.int8())
    return pa.RecordBatch.from_arrays([pa.array((word & ~np.uint64(255)).view(np.int64)), side, pa.array(h1.view(np.int64)),
                                       pa.array(par.view(np.int64))], names=names)


def _met_rows(rows: np.ndarray, hot_key: int, last: bool):
    """Batches of ``MET`` from rows that hold their keys completely."""
    word = np.ascontiguousarray(rows[:, 0])
    order = np.argsort(word)
    key = word[order] >> np.uint64(8)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    h1 = rows[order, 1]
    # Most keys have one line alone.
    several = np.minimum.reduceat(h1, edge) != np.maximum.reduceat(h1, edge)
    at = order[np.repeat(several, np.diff(np.append(edge, len(key))))]
    if not len(at):
        return
    word, h1, par = (np.ascontiguousarray(rows[at, k]) for k in range(3))
    order = np.lexsort((h1, word))
    word, h1, par = word[order], h1[order], par[order]
    once = np.concatenate([[True], (word[1:] != word[:-1]) | (h1[1:] != h1[:-1])])
    word, h1, par = word[once], h1[once], par[once]
    key = word >> np.uint64(8)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(edge, len(key)))
    large = np.repeat(size > hot_key, size)
    if large.any() and not last:
        yield _met_batch(word[large], h1[large], par[large], True)
    found = large if last else np.zeros(len(key), bool)
    small = np.flatnonzero(~large)
    if len(small):
        found[small] = _partnered(key[small], _side(word[small]), h1[small], par[small])
    if found.any():
        key, h1, par = key[found] << np.uint64(8), h1[found], par[found]
        order = np.lexsort((h1, key))
        key, h1, par = key[order], h1[order], par[order]
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (h1[1:] != h1[:-1])])
        yield _met_batch(key[once], h1[once], par[once], False)


def _met_batches(batches, hot_key: int, last: bool, held_rows: int):
    """``MET`` of batches of buckets that come in order. Of a bucket that goes on
    beyond ``held_rows``, hot keys are passed on as they come."""
    held, n, limit, hot = [], 0, held_rows, np.zeros(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = _rows_of(batch)
        bucket = rows[:, 0] >> _SHIFT
        cut = int(np.searchsorted(bucket, bucket[-1]))
        if held and (cut or held[0][0, 0] >> _SHIFT != bucket[0]):
            same = int(np.searchsorted(bucket, held[0][0, 0] >> _SHIFT, side="right"))
            own = rows[:same]
            if len(hot):
                passed = np.isin(own[:, 0] >> np.uint64(8), hot)
                if passed.any():
                    yield _met_batch(*own[passed].T.copy(), True)
                own = own[~passed]
            yield from _met_rows(np.concatenate([*held, own]), hot_key, last)
            held, n, limit, hot = [], 0, held_rows, hot[:0]
            rows, cut = rows[same:], max(0, cut - same)
        if not held and cut:
            yield from _met_rows(rows[:cut], hot_key, last)
            rows = rows[cut:]
        if len(hot) and len(rows):
            passed = np.isin(rows[:, 0] >> np.uint64(8), hot)
            if passed.any():
                yield _met_batch(*rows[passed].T.copy(), True)
            rows = rows[~passed]
        if len(rows):
            held.append(rows)
            n += len(rows)
        if n > limit and not last:
            rows = np.concatenate(held)
            key, which, size = np.unique(rows[:, 0] >> np.uint64(8), return_inverse=True, return_counts=True)
            large = size[which] > hot_key
            if large.any():
                hot = np.concatenate([hot, key[size > hot_key]])
                yield _met_batch(*rows[large].T.copy(), True)
                rows = rows[~large]
            held, n, limit = [rows] if len(rows) else [], len(rows), max(held_rows, 2 * len(rows))
    if held:
        yield from _met_rows(np.concatenate(held), hot_key, last)


def _met(keys: DataFrame, hot_key: int, last: bool = False) -> DataFrame:
    """(key, null, h1, par) of the lines that meet another one under a key, once
    for each key: as many rows as came in at most, not the pairs. The rows of keys
    with more than ``hot_key`` of them come out as they are, with their side; in
    the ``last`` round all lines of such a key count as met."""
    return (keys.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(lambda batches: _met_batches(batches, hot_key, last, HELD_ROWS), MET))


def _split(hot: DataFrame) -> DataFrame:
    """The rows of hot keys under keys of their own for each of 4 * threshold + 1
    parts of the parity signature, with the part's bits: near lines differ in at
    most 4 * threshold bits, so they agree in a part; others mostly do not."""
    def tables(batches):
        for batch in batches:
            key, side, h1, par = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            for t in np.unique(np.abs(side)).tolist():
                own = np.abs(side) == t
                bits = max(1, 64 // (4 * t + 1))
                for k in range(4 * t + 1):
                    v = (par[own].view(np.uint64) >> np.uint64(min(63, k * bits))) & np.uint64((1 << bits) - 1)
                    yield np.stack([_joined(_tag(key[own].view(np.uint64) ^ (v * np.uint64(_INV)), 0, k, t), side[own]),
                                    h1[own].view(np.uint64), par[own].view(np.uint64)], axis=1)

    return hot.mapInArrow(lambda batches: _bucketed(tables(batches)), KEYS)


def _candidates(keys: DataFrame, hot_key: int) -> DataFrame:
    """(key, h1, par): the lines to compare under each key. Those of a key with
    more than ``hot_key`` rows are met once more, split by their parities."""
    met = written(_met(keys, hot_key), "line-keys")
    hot = _met(_split(met.filter("side is not null")), hot_key, last=True)
    return met.filter("side is null").unionByName(hot).select("key", "h1", "par")


def _text_of(lines: DataFrame, exchanged: DataFrame, text: str) -> DataFrame:
    """(h1, h2, did, th, pos, line) of lines given with the place of their first
    occurrence. The join takes all columns of ``exchanged``, so that Spark can
    use one exchange of the texts for it and for the result."""
    asked = lines.groupBy("did", "th").agg(F.collect_list("pos").alias("ps"))
    others = [c for c in exchanged.columns if c not in ("_did", "_th", text)]

    def run(batches):
        for batch in batches:
            out = []
            for did, th, ps, t in zip(*(batch.column(k).to_pylist() for k in range(4))):
                parts = t.split("\n")
                out += [(*_hash(parts[p]), did, th, p, parts[p]) for p in sorted(set(ps))]
            if out:
                cols = list(zip(*out))
                types = [pa.int64()] * 4 + [pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=["h1", "h2", "did", "th", "pos", "line"])

    found = exchanged.join(asked.hint("merge"), (exchanged["_did"] == asked["did"]) & (exchanged["_th"] == asked["th"]))
    return found.select("did", "th", "ps", F.col(text).cast("string").alias("text"),
                        *[F.col(c).alias(f"_{k}") for k, c in enumerate(others)]).mapInArrow(
        run, "h1 long, h2 long, did long, th long, pos int, line string")


def _later(par: np.ndarray, lines: list[str], steps) -> list[int]:
    """Which of the lines of one key, in their order, have an earlier near line.
    Each is compared with the earliest ones first, and no more once one is found,
    so a group of near lines takes as many comparisons as it has lines."""
    starts, edits = zip(*sorted(steps))
    grant = (0, *edits)

    def near(x: str, y: str) -> bool:
        return within(x, y, grant[bisect.bisect_right(starts, max(len(x), len(y)))])

    if len(lines) <= FEW:
        bits = [4 * grant[bisect.bisect_right(starts, len(x))] for x in lines]
        own = par.tolist()
        return [z for z in range(1, len(lines)) if any(
            (own[z] ^ own[c]).bit_count() <= max(bits[z], bits[c]) and near(lines[z], lines[c]) for c in range(z))]
    length = np.array([len(x) for x in lines])
    bits = 4 * granted(length, steps)
    left, found = np.arange(1, len(lines)), []
    for a in range(0, len(lines), COMPARED):
        left = left[left > a]
        if not len(left):
            break
        here = []
        for part in range(0, len(left), COMPARED):
            z, c = left[part:part + COMPARED], np.arange(a, min(a + COMPARED, len(lines)))
            ok = ((np.bitwise_count(par[z][:, None] ^ par[c]) <= np.maximum(bits[z][:, None], bits[c])) & (c < z[:, None])
                  & (np.abs(length[z][:, None] - length[c]) <= edits[-1]))
            done = -1
            for i, k in np.argwhere(ok).tolist():
                if i != done and near(lines[z[i]], lines[a + k]):
                    here.append(int(z[i]))
                    done = i
        found += here
        left = np.setdiff1d(left, here, assume_unique=True)
    return found


def _near(first: DataFrame, candidates: DataFrame, exchanged: DataFrame, text: str, steps) -> DataFrame:
    """(h1, h2) of the lines that have an earlier near line."""
    candidates = written(candidates, "candidates")
    asked = candidates.select("h1").distinct()
    places = first.join(asked.hint("merge"), "h1", "left_semi").select("did", "th", "pos")
    texts = _text_of(places, exchanged, text).distinct()
    rows = (candidates.join(texts.hint("merge"), "h1").select("key", "par", "h1", "h2", "line", "did", "th", "pos")
            .repartition("key").sortWithinPartitions("key", "did", "th", "pos"))

    def near(held):
        key, par, h1, h2 = (np.concatenate([h[k] for h in held]) for k in range(4))
        lines = [x for h in held for x in h[4]]
        at = []
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(cuts, cuts[1:]):
            at += [a + k for k in _later(par[a:b], lines[a:b], steps)]
        if at:
            yield pa.RecordBatch.from_arrays([pa.array(h1[at]), pa.array(h2[at])], names=["h1", "h2"])

    def run(batches):
        held = []  # rows of the key that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            key, par, h1, h2 = (batch.column(k).to_numpy() for k in range(4))
            cols = [key, par.view(np.uint64), h1, h2, batch.column(4).to_pylist()]
            last = int(np.searchsorted(key, key[-1]))
            if last or held and held[0][0][0] != key[-1]:
                yield from near([*held, [c[:last] for c in cols]])
                held = []
            held.append([c[last:] for c in cols])
        if held:
            yield from near(held)

    return rows.mapInArrow(run, "h1 long, h2 long").distinct()


MADE = ("n_lines", "n_repeats", "n_near")


def line_dedup(docs: DataFrame, text: str = "text", steps=STEPS,
               keep: list[str] | None = None, hot_key: int = HOT_KEY) -> DataFrame:
    """``docs`` with the lines that go taken out of ``text``, and ``n_lines``
    (lines with a word), ``n_repeats`` and ``n_near`` (lines taken out)."""
    steps = checked(steps)
    prepare(docs.sparkSession)
    own = kept(docs, docs.columns if keep is None else keep, (*MADE, "_did", "_th", "_gone"))
    rows = _identified(docs, text)
    seen = written(_occurrences(rows, text), "lines")
    place = F.struct("did", "th", "pos")
    first = (seen.groupBy("h1", "h2").agg(F.min(place).alias("f"), F.min(place) != F.max(place))
             .toDF("h1", "h2", "f", "many").select("h1", "h2", "f.*", "many"))
    first = written(first, "first-lines")
    exchanged = rows.select(*own, *([text] if text not in own else []), "_did", "_th")
    near = _near(first, _candidates(_keyed(rows, text, steps), hot_key), exchanged, text, steps)

    # Only lines that repeat or have an earlier near line can go; a hot one is dealt over the salts.
    marked = (first.join(near.withColumn("near", F.lit(True)).hint("merge"), ["h1", "h2"], "left")
              .filter("many or near")
              .select("h1", "h2", F.struct("did", "th", "pos").alias("f"), F.coalesce("near", F.lit(False)).alias("near")))
    salt = F.pmod(F.xxhash64("did", "th"), F.lit(SALTS)).cast("int")
    each = marked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    gone = (seen.withColumn("salt", salt).join(each.hint("merge"), ["h1", "h2", "salt"])
            .filter(F.col("near") | (F.struct("did", "th", "pos") != F.col("f")))
            .groupBy("did", "th").agg(F.collect_list(F.struct("pos", "near")).alias("gone")))
    joined = exchanged.join(gone.hint("merge"), (exchanged["_did"] == gone["did"]) & (exchanged["_th"] == gone["th"]), "left")
    columns = [c for c in own if c != text]

    def run(batches):
        k = len(columns)
        for batch in batches:
            out = []
            for t, g in zip(batch.column(k).to_pylist(), batch.column(k + 1).to_pylist()):
                drop = {x["pos"]: x["near"] for x in g or []}
                lines, left, seen_here, counts = (t or "").split("\n"), [], set(), [0, 0, 0]
                for pos, line in enumerate(lines):
                    if line.strip(_GAPS):
                        counts[0] += 1
                        if line in seen_here or pos in drop:
                            near_here = pos in drop and drop[pos]
                            counts[2 if near_here else 1] += 1
                            seen_here.add(line)
                            continue
                        seen_here.add(line)
                    left.append(line)
                out.append((None if t is None else "\n".join(left), *counts))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(j) for j in range(k)), pa.array(cols[0], pa.string()),
                 *(pa.array(cols[j], pa.int64()) for j in (1, 2, 3))], names=[*columns, text, *MADE])

    schema = ", ".join(filter(None, [schema_of(docs, columns), f"`{text}` string, n_lines long, n_repeats long, n_near long"]))
    made = joined.select(*columns, F.col(text).cast("string"), "gone").mapInArrow(run, schema)
    return made.select(*own, *([text] if text not in own else []), *MADE)
