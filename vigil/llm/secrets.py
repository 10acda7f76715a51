"""Secret scan: fixed patterns, and random strings by token efficiency.

Three kinds of spans come from fixed patterns (assignments, access keys, long
hex). The fourth, ``random``, is a run of token characters that a byte-pair
vocabulary compresses badly: its characters per token fall below a ratio that
words of natural language do not reach. A run shorter than ``least`` counts as
that long, so it needs as many tokens as the shortest longer run that is random;
there is no other lower bound. Known digests and identifiers (pure
digits, UUIDs, single-case words and words joined by ``_ - / = +``) are left out
first; the base spans stay as they are. In a run that is not random as a whole,
the pieces between separators that are not words are judged together with their
neighbours of that kind, so words next to a secret do not hide it; single-case
pieces count as words only if they compress like words. Runs are found on arrays
of code points, one batch of texts at a time; no shuffle.

Spans are ``kind:start:end`` in code points, end exclusive, ordered by start,
then by kind. Defined cases: null text is empty and has no spans; whole texts
are scanned at any length; repeated rows give repeated results; extra columns
are ignored unless named in ``keep``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.bpe import BATCH_CHARS, Merger, _cached, encode_texts, read_ranks
from vigil.llm.common import kept, prepare, schema_of, slices

KINDS = ("assign", "access", "hex", "random")
# Fixed patterns. Letters of the keyword in either case, ASCII only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
#: Length that shorter runs count as, and characters per token below which a run is random.
LEAST_RANDOM = 20
LOW_RATIO = 2.2
# What a low ratio does not make a secret: digests by length, and identifiers.
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
IDENTIFIER = re.compile(
    r"[0-9]+|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+|)(?:[-_/=+](?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+|))*")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PIECE = re.compile(r"[A-Za-z0-9]+")
#: Shorter pieces do not tell words from random strings.
LEAST_WORD = 4

_BITS = np.zeros(128, np.uint8)
_BITS[[ord(c) for c in "0123456789abcdef"]] |= 1
_BITS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] |= 2


def _runs(member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of at least ``least``; ``member`` ends in False."""
    edge = np.flatnonzero(member[1:] != member[:-1]) + 1
    if member[0]:
        edge = np.concatenate([[0], edge])
    a, b = edge[::2], edge[1::2]
    long = b - a >= least
    return a[long], b[long]


def _digest(s: str) -> bool:
    return len(s) in DIGEST_LENGTHS and DIGEST.fullmatch(s) is not None


def _sizes(strings: list[str], merger: Merger) -> list[int]:
    """Tokens of each string."""
    return [len(ids) // 4 for ids, _, _ in encode_texts(strings, merger)] if strings else []


def _within(runs: list[tuple[int, int, str]], merger: Merger, ratio: float, least: int) -> list[tuple[int, int]]:
    """The random parts of runs that are not random as a whole: neighbouring
    pieces that are not words, and single-case pieces that compress like none."""
    pieces = [(k, m.start(), m.end(), m[0]) for k, (_, _, s) in enumerate(runs) for m in PIECE.finditer(s)]
    parts: list[tuple[int, list]] = []  # (run, its neighbouring pieces that are not words)
    last = None
    for piece, n in zip(pieces, _sizes([p[3] for p in pieces], merger)):
        s = piece[3]
        if _digest(s) or len(s) >= LEAST_WORD and (s.isdigit() or len(s) >= ratio * n):
            last = None
        elif last == piece[0]:
            parts[-1][1].append(piece)
        else:
            last = piece[0]
            parts.append((last, [piece]))
    judged, letters = [], []
    for k, own in parts:
        a, b = own[0][1], own[-1][2]
        s = runs[k][2][a:b]
        if ratio * (b - a) <= least or UUID.fullmatch(s):  # no token is shorter than a character
            continue
        if IDENTIFIER.fullmatch(s):  # words by their form: judged by the letters, in lower case
            words = [p[3].lower() for p in own if len(p[3]) >= LEAST_WORD and not p[3].isdigit()]
            if ratio * sum(map(len, words)) > least:
                letters.append((k, a, b, words))
        else:
            judged.append((k, a, b, [s]))
    judged += letters
    sizes = iter(_sizes([s for j in judged for s in j[3]], merger))
    return [(runs[k][0] + a, runs[k][0] + b) for k, a, b, strings in judged
            if max(least, sum(map(len, strings))) < ratio * sum([next(sizes) for _ in strings])]


def scan_texts(texts: list[str], merger: Merger, ratio: float = LOW_RATIO,
               least: int = LEAST_RANDOM) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) of the spans of each text, sorted."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    bits = _BITS[np.minimum(points, 127)]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]

    def add(kind: int, a: np.ndarray, b: np.ndarray) -> None:
        row = np.searchsorted(first, a, side="right") - 1
        for r, x, y in zip(row.tolist(), (a - first[row]).tolist(), (b - first[row]).tolist()):
            found[r].append((x, kind, y))

    add(2, *_runs((bits & 1) > 0, LEAST_HEX))
    a, b = _runs((bits & 2) > 0, int(least / ratio) + 1)
    runs = [(x, y, joined[x:y]) for x, y in zip(a.tolist(), b.tolist())]
    runs = [r for r in runs if not (_digest(r[2]) or UUID.fullmatch(r[2]))]
    if runs:
        whole = [r for r in runs if not IDENTIFIER.fullmatch(r[2])]
        low = [(x, y) for (x, y, s), n in zip(whole, _sizes([r[2] for r in whole], merger)) if max(least, len(s)) < ratio * n]
        taken = {x for x, _ in low}
        low += _within([r for r in runs if r[0] not in taken], merger, ratio, least)
        low = np.array(low, np.int64).reshape(-1, 2)
        add(3, low[:, 0], low[:, 1])
    if "AKIA" in joined:
        hits = [m.span() for m in ACCESS.finditer(joined) if m.end() - m.start() >= LEAST_ACCESS]
        hits = np.array(hits, np.int64).reshape(-1, 2)
        add(1, hits[:, 0], hits[:, 1])
    marks = np.flatnonzero((points == ord(":")) | (points == ord("=")))
    for r in np.unique(np.searchsorted(first, marks, side="right") - 1).tolist():  # every assignment has one
        found[r] += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(texts[r])
                     if m.end(2) - m.start(2) >= LEAST_VALUE]
    for spans in found:
        spans.sort()
    return found


SCANNED = ("n_assign", "n_access", "n_hex", "n_random", "base_spans", "spans")


def scan(df: DataFrame, ranks_path: str, text: str = "text", keep=("doc_id",), ratio: float = LOW_RATIO,
         least: int = LEAST_RANDOM) -> DataFrame:
    """``keep`` columns, the counts by kind, ``base_spans`` and all ``spans``."""
    prepare(df.sparkSession)
    own = kept(df, keep, SCANNED)
    file = df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def listed(spans) -> str:
        return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])

    def run(batches):
        merger = _cached(file.value, Merger)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(own)).to_pylist()]
            got = []
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                got += scan_texts(texts[a:b], merger, ratio, least)
            cols = [batch.column(k) for k in range(len(own))]
            cols += [pa.array([sum(s[1] == k for s in spans) for spans in got], pa.int64()) for k in range(4)]
            cols += [pa.array([listed([s for s in spans if s[1] < 3]) for spans in got], pa.string()),
                     pa.array([listed(spans) for spans in got], pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*own, *SCANNED])

    schema = ", ".join(filter(None, [
        schema_of(df, own), "n_assign long, n_access long, n_hex long, n_random long, base_spans string, spans string"]))
    return df.select(*own, F.col(text).cast("string")).mapInArrow(run, schema)
