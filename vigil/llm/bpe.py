"""Byte-level BPE: encode texts to ids and decode ids to bytes.

Pre-tokenisation runs on arrays of code points, without regex. Every code
point becomes a symbol (letter, number, other, white space with the look-ahead
the pattern needs, contraction start, end of text). A symbol is a transition
function on eight states. Composition of these functions is associative, so
the states of a whole batch come from one blocked prefix scan: the functions
reachable by composition are numbered once (a small closed set), composing two
is a table look-up, each block is scanned side by side with all others, and the
block totals are scanned in turn. Token boundaries follow from (state before,
symbol).

Each slice is merged once per worker and cached (cache bounded by entries).
The ends of the slices, in ids and in bytes, stay with the ids: decoding (array
look-ups in the vocabulary's bytes) checks them, and ``decode_span`` decodes a
run of slices alone.

Ids and offsets are binary columns of little-endian unsigned 32-bit integers.

Defined cases: null text is the empty text (no ids); a text without white
space is one long slice, merged with a heap (n log n); repeated rows give
repeated rows; an empty table gives an empty table. Extra columns named in
``keep`` are carried; those named like an output column are left out.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import kept, prepare, schema_of, slices

CACHE_ENTRIES = 250_000
CACHED_BYTES = 64
BATCH_CHARS = 500_000
#: A rank file larger than this is refused: it is sent to every executor.
MOST_RANK_BYTES = 64 << 20

# White space of the pattern, and letters and numbers of
# Unicode 16 that the interpreter's tables (15.1) do not have yet.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
         0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LATER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0)]
LATER_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]

# Symbols.
LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, GAP, LAST_SPACE, LAST_GAP, END = range(9)
# States: nothing open, in letters, in numbers, in others, in white space, a
# space that joins the next run, one or two characters of a contraction to come.
OPEN, IN_L, IN_N, IN_O, IN_GAP, JOIN, MORE1, MORE2 = range(8)


def _step(state: int, sym: int) -> tuple[int, bool]:
    """(next state, a slice starts here)."""
    if sym == LETTER:
        if state == MORE2:
            return MORE1, False
        if state == MORE1:
            return OPEN, False
        return IN_L, state not in (IN_L, JOIN)
    if sym == NUMBER:
        return IN_N, state not in (IN_N, JOIN)
    if sym == OTHER:
        return IN_O, state not in (IN_O, JOIN)
    if sym in (QUOTE2, QUOTE3):
        if state in (IN_O, JOIN):
            return IN_O, False
        return (MORE1 if sym == QUOTE2 else MORE2), True
    if sym == GAP:
        return IN_GAP, state != IN_GAP
    if sym == LAST_SPACE:
        return JOIN, True
    if sym == LAST_GAP:
        return IN_GAP, True
    return OPEN, True


def _tables():
    """Ids of the transition functions closed under composition, the table of
    compositions, each function's value at OPEN, and the boundary table."""
    gens = [tuple(_step(s, y)[0] for s in range(8)) for y in range(9)]
    funcs = [tuple(range(8))]
    ids = {funcs[0]: 0}
    for f in funcs:  # grows while it is read
        for g in gens:
            h = tuple(g[f[s]] for s in range(8))
            if h not in ids:
                ids[h] = len(funcs)
                funcs.append(h)
    n = len(funcs)
    comp = np.zeros((n, n), np.uint16)
    for a, f in enumerate(funcs):
        for b, g in enumerate(funcs):
            comp[a, b] = ids[tuple(g[f[s]] for s in range(8))]
    starts = np.array([[_step(s, y)[1] for y in range(9)] for s in range(8)])
    return (np.array([ids[g] for g in gens], np.uint16), comp.ravel(), n,
            np.array([f[OPEN] for f in funcs], np.uint8), starts.ravel())


GEN, COMP, N_FUNCS, AT_OPEN, STARTS = _tables()
_CLASS: list[np.ndarray] = []


def class_table() -> np.ndarray:
    """LETTER, NUMBER, OTHER or GAP of every code point."""
    if not _CLASS:
        t = np.full(0x110000, OTHER, np.uint8)
        for c in range(0x110000):
            k = unicodedata.category(chr(c))[0]
            if k == "L":
                t[c] = LETTER
            elif k == "N":
                t[c] = NUMBER
        for a, b in LATER_LETTERS:
            t[a:b + 1] = LETTER
        for a, b in LATER_NUMBERS:
            t[a:b + 1] = NUMBER
        t[WHITE] = GAP
        _CLASS.append(t)
    return _CLASS[0]


def prefix_functions(f: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of an array of function ids."""
    n = len(f)
    if n <= 64:
        out = np.empty_like(f)
        at = 0
        for k in range(n):
            at = COMP[at * N_FUNCS + int(f[k])]
            out[k] = at
        return out
    rows = min(256, int(np.sqrt(n)) + 1)
    cols = -(-n // rows)
    a = np.zeros(rows * cols, np.uint16)  # id 0 is the identity
    a[:n] = f
    a = np.ascontiguousarray(a.reshape(cols, rows).T)
    for k in range(1, rows):
        a[k] = COMP[a[k - 1].astype(np.uint32) * N_FUNCS + a[k]]
    before = np.zeros(cols, np.uint16)
    before[1:] = prefix_functions(a[-1])[:-1]
    a = COMP[before.astype(np.uint32)[None, :] * N_FUNCS + a]
    return np.ascontiguousarray(a.T).ravel()[:n]


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions in ``points`` (code points of several texts, each followed by
    one filler at the positions ``ends``) where slices or fillers start."""
    sym = class_table()[points]
    gap = sym == GAP
    gap[ends] = False
    stop = np.zeros(len(points), bool)
    stop[ends] = True
    followed = np.zeros(len(points), bool)  # by something that isn't white space
    followed[:-1] = ~(gap[1:] | stop[1:])
    last = gap & followed
    sym[last] = LAST_GAP
    sym[last & (points == 0x20)] = LAST_SPACE
    quotes = np.flatnonzero(points == 0x27)
    if len(quotes):
        sym[ends] = END
        pad = np.concatenate([points, np.zeros(2, points.dtype)])
        pad[ends] = 0
        one, two = pad[quotes + 1], pad[quotes + 2]
        sym[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = QUOTE2
        three = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e"))
                 | (one == ord("l")) & (two == ord("l")))
        sym[quotes[three]] = QUOTE3
    sym[ends] = END
    after = AT_OPEN[prefix_functions(GEN[sym])]
    before = np.zeros(len(after), np.uint16)
    before[1:] = after[:-1]
    return np.flatnonzero(STARTS[before * 9 + sym])


class Merger(dict):
    """Cache from a slice to its ids (bytes of little-endian uint32)."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.whole = ranks
        self.bytes = [ranks[bytes([k])] for k in range(256)]
        #: From two neighbouring ids to the id of their concatenation.
        self.pairs = {ranks[t[:k]] << 32 | ranks[t[k:]]: v for t, v in ranks.items()
                      for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8")
        one = self.whole.get(raw)
        ids = self.merge(raw) if one is None else [one]
        out = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = out
        return out

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one slice: always the pair of lowest id, the leftmost of
        equal ones. Short slices keep a plain list of pair ids, long ones a
        linked list with a heap."""
        get, none = self.pairs.get, 1 << 62
        ids = [self.bytes[c] for c in raw]
        made = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        if len(raw) > CACHED_BYTES:
            return self._merge_long(ids, made, none)
        while made:
            low = min(made)
            if low == none:
                break
            k = made.index(low)
            ids[k] = low
            del ids[k + 1], made[k]
            if k:
                made[k - 1] = get(ids[k - 1] << 32 | low, none)
            if k < len(made):
                made[k] = get(low << 32 | ids[k + 1], none)
        return ids

    def _merge_long(self, ids: list[int], made: list[int], none: int) -> list[int]:
        get, n = self.pairs.get, len(ids)
        after, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, k) for k, m in enumerate(made) if m != none]
        heapq.heapify(heap)
        made.append(none)
        while heap:
            low, k = heapq.heappop(heap)
            if made[k] != low:
                continue  # one of the two has changed since
            j = after[k]
            ids[k], made[j], after[k] = low, none, after[j]
            ids[j] = -1
            if after[k] < n:
                prev[after[k]] = k
                made[k] = get(low << 32 | ids[after[k]], none)
                if made[k] != none:
                    heapq.heappush(heap, (made[k], k))
            else:
                made[k] = none
            if prev[k] >= 0:
                p = prev[k]
                made[p] = get(ids[p] << 32 | low, none)
                if made[p] != none:
                    heapq.heappush(heap, (made[p], p))
        return [i for i in ids if i >= 0]


class Vocabulary:
    """The bytes of every id, end to end, for decoding by array look-ups."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        self.length = np.full(size, -1, np.int64)
        pieces = [b""] * size
        for t, v in ranks.items():
            pieces[v], self.length[v] = t, len(t)
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.start = np.cumsum(np.maximum(self.length, 0)) - np.maximum(self.length, 0)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, end of every id in them)."""
        n = self.length[ids]
        if (n < 0).any():
            raise IndexError("an id is not in the vocabulary")
        ends = np.cumsum(n)
        out = np.arange(int(ends[-1]) if len(ends) else 0)
        out += np.repeat(self.start[ids] - (ends - n), n)
        return self.flat[out], ends


_WORKER: dict[tuple[bytes, str], object] = {}


def _cached(rank_file: bytes, kind):
    """This worker's Merger or Vocabulary of a rank file, kept from task to task."""
    key = hashlib.sha256(rank_file).digest(), kind.__name__
    if key not in _WORKER:
        _WORKER[key] = kind({base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())})
    return _WORKER[key]


def encode_texts(texts: list[str], merger: Merger) -> list[tuple[bytes, bytes, bytes]]:
    """(ids, slice ends in ids, slice ends in bytes) of each text."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    cuts = boundaries(points, ends)
    at = cuts.tolist()
    parts = [merger[joined[a:b]] for a, b in zip(at, at[1:])]  # fillers too, dropped below
    stops = np.searchsorted(cuts, ends)  # the filler of each text
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    nbytes = np.concatenate([[0], np.cumsum(width)])
    out, first, begin = [], 0, 0
    for stop, end in zip(stops.tolist(), ends.tolist()):
        own = parts[first:stop]
        sizes = np.cumsum(np.fromiter(map(len, own), np.int64, len(own))) // 4
        byte_ends = nbytes[np.append(cuts[first + 1:stop], end)] - nbytes[begin] if own else []
        out.append((b"".join(own), sizes.astype("<u4").tobytes(), np.asarray(byte_ends, "<u4").tobytes()))
        first, begin = stop + 1, end + 1
    return out


def read_ranks(path: str) -> bytes:
    """The rank file, read on the driver; refused beyond MOST_RANK_BYTES."""
    with open(path, "rb") as f:
        data = f.read(MOST_RANK_BYTES + 1)
    if len(data) > MOST_RANK_BYTES:
        raise ValueError(f"{path} exceeds {MOST_RANK_BYTES} bytes")
    return data


ENCODED = ("n_tokens", "ids", "slice_ids", "slice_bytes")


def _decoded(vocabulary: Vocabulary, ids: bytes, by_ids: bytes, by_bytes: bytes) -> bytes:
    """The bytes of the ids, after a check of the slice ends against them."""
    text, stops = vocabulary.decode(np.frombuffer(ids, "<u4"))
    by_ids, by_bytes = (np.frombuffer(e, "<u4").astype(np.int64) for e in (by_ids, by_bytes))
    if len(by_ids) and not np.array_equal(stops[by_ids - 1], by_bytes):
        raise ValueError("the slice offsets do not fit the ids")
    return text.tobytes()


def encode(df: DataFrame, ranks_path: str, text: str = "text", keep=("doc_id",), decoded: str | None = None) -> DataFrame:
    """``keep`` columns plus ``n_tokens``, ``ids`` and the slice ends
    (``slice_ids`` counts ids, ``slice_bytes`` bytes). With ``decoded``, a column
    of that name holds the bytes that the made ids decode to (a round trip in
    one worker). No shuffle."""
    prepare(df.sparkSession)
    made = (*ENCODED, *filter(None, [decoded]))
    own = kept(df, keep, made)
    file = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        merger = _cached(file.value, Merger)
        vocabulary = _cached(file.value, Vocabulary) if decoded else None
        for batch in batches:
            texts = [t or "" for t in batch.column(len(own)).to_pylist()]
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                got = encode_texts(texts[a:b], merger)
                cols = [batch.column(k).slice(a, b - a) for k in range(len(own))]
                cols += [pa.array([len(i) // 4 for i, _, _ in got], pa.int64())]
                cols += [pa.array([g[k] for g in got], pa.binary()) for k in range(3)]
                if decoded:
                    cols += [pa.array([_decoded(vocabulary, *g) for g in got], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=[*own, *made])

    schema = ", ".join(filter(None, [schema_of(df, own),
                                     "n_tokens long, ids binary, slice_ids binary, slice_bytes binary",
                                     decoded and f"`{decoded}` binary"]))
    return df.select(*own, F.col(text).cast("string")).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, keep=("doc_id",), name: str = "decoded") -> DataFrame:
    """``keep`` columns plus the bytes of ``ids``; the retained slice ends are
    checked against them. Null ids are no ids; an id outside the vocabulary
    or offsets that do not fit fail."""
    prepare(df.sparkSession)
    own = kept(df, keep, (name,))
    file = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        vocabulary = _cached(file.value, Vocabulary)
        for batch in batches:
            k = len(own)
            out = []
            for row in zip(*(batch.column(k + j).to_pylist() for j in range(3))):
                out.append(_decoded(vocabulary, *(x or b"" for x in row)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(j) for j in range(k)), pa.array(out, pa.binary())], names=[*own, name])

    schema = ", ".join(filter(None, [schema_of(df, own), f"`{name}` binary"]))
    return df.select(*own, "ids", "slice_ids", "slice_bytes").mapInArrow(run, schema)


def decode_span(row, vocabulary: Vocabulary, first: int, stop: int) -> bytes:
    """The bytes of slices ``first`` to ``stop`` (exclusive) of an encoded row."""
    ends = np.concatenate([[0], np.frombuffer(row["slice_ids"], "<u4")]).astype(np.int64)
    return vocabulary.decode(np.frombuffer(row["ids"], "<u4")[ends[first]:ends[stop]])[0].tobytes()


def ids_array(ids) -> F.col:
    """A binary id column as array<long> (for consumers that want numbers)."""
    hexed = F.hex(ids)
    digits = F.filter(F.split(F.regexp_replace(hexed, "(.{8})", "$1 "), " "), lambda x: x != "")
    turned = lambda x: F.concat(*[F.substring(x, k, 2) for k in (7, 5, 3, 1)])
    return F.transform(digits, lambda x: F.conv(turned(x), 16, 10).cast("long"))
