"""Benchmark decontamination: item-sized windows of documents against items.

Documents and items are sequences of word shingles (five words; an item with
fewer is one shingle of its own width). Items of equal width and number of
shingles have windows in common: the runs of a document with as many shingles.
Windows without any shingle of such items have similarity 0 and are passed over.
The others are fingerprinted by SimHash (128 bits), with prefix sums of signed
bits over the text, and ask a multi-index for the items within ``radius``:
fingerprints are split into blocks of 16 bits, a pair within the radius agrees
in some block up to radius // blocks bits, and the index has every block value
that close to an item's. The items it names, confirmed by their distance, are
the candidates; they are verified by the exact weighted similarity of the two
shingle bags: the sum of the smaller over the sum of the larger counts, at least
``least``.

A pair of similarity 0.8 differs in 19.4 of 128 bits on average (standard
deviation 4.1); the radius of 36 lies four deviations above. A bag that repeats
one shingle for a tenth of its length leans to that shingle and may lie further
away. Items reach the executors in blocks of bounded number and size, one pass
over the documents for each block; there is no shuffle, so neither a long text
nor a passage in a third of all documents gathers rows anywhere.

Defined cases: null or empty texts match nothing, items without words are
never found; whole texts are searched at any length, their windows in stretches
of bounded size; a document shorter than an item is one window; equal items are
all reported; of equally similar windows the first is reported; repeated
documents are reported each; empty tables give no matches. Other columns are
carried unless named like an output column.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import kept, prepare, schema_of
from vigil.llm.neardup import _mix, in_order, word_hashes

SIZE = 5
LEAST = 0.8
BITS, RADIUS, BLOCKS = 128, 36, 8
#: Bounds of a block of items.
BLOCK_ITEMS, BLOCK_WORDS = 2048, 500_000
FILTER_BITS = 20
#: Windows fingerprinted at once.
WINDOWS = 4096

_SHIFTS = np.arange(64, dtype=np.uint64)
_VALUES = 1 << 16


def _signed(h: np.ndarray) -> np.ndarray:
    """(shingles, BITS) of +1 and -1, from as many hashes of each shingle as it takes."""
    words = [h if k == 0 else _mix(h + np.uint64(k)) for k in range(BITS // 64)]
    bits = np.concatenate([(w[:, None] >> _SHIFTS) & np.uint64(1) for w in words], axis=1)
    return (bits.astype(np.int32) << 1) - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """(windows, blocks) of 16-bit values: the signs of the sums."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint16)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class Items:
    """A block of items, by window size, with shingle lookup and multi-index."""

    def __init__(self, rows: list[tuple[int, str]], size: int, radius: int, least: float):
        self.radius, self.least = radius, least
        made = []
        for item_id, text in rows:
            words = word_hashes(text)
            if len(words):
                run = in_order(words, min(size, len(words)))
                made.append((min(size, len(words)), len(run), item_id, run))
        made.sort(key=lambda m: m[:3])  # items of one window size are neighbours
        self.ids = [m[2] for m in made]
        self.bags = [Counter(m[3].tolist()) for m in made]
        self.keys = [np.unique(m[3]) for m in made]
        self.prints = (np.concatenate([_fingerprints(_signed(m[3]).sum(axis=0, keepdims=True)) for m in made])
                       if made else np.zeros((0, BITS // 16), np.uint16))
        #: Of each group: shingle width, window size, first item, last item + 1.
        self.groups: list[tuple[int, int, int, int]] = []
        owner: dict[int, dict[int, set[int]]] = {}
        for k, (width, count, _, run) in enumerate(made):
            if not self.groups or self.groups[-1][:2] != (width, count):
                self.groups.append((width, count, k, k))
            self.groups[-1] = (width, count, self.groups[-1][2], k + 1)
            for h in run.tolist():
                owner.setdefault(width, {}).setdefault(h, set()).add(len(self.groups) - 1)
        self.owner = owner
        self.seen = {}
        for width, hashes in owner.items():
            table = np.zeros(1 << FILTER_BITS, bool)
            table[(np.array(list(hashes), np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.seen[width] = table
        self._index()

    def _index(self) -> None:
        """For each block and block value: the items with a value within the allowed errors, as bits."""
        flips = np.array([sum(1 << b for b in c) for n in range(self.radius // BLOCKS + 1)
                          for c in combinations(range(16), n)], np.uint16)
        self.near = np.zeros((BLOCKS, _VALUES, -(-len(self.ids) // 8) or 1), np.uint8)
        for k, blocks in enumerate(self.prints):
            for b, value in enumerate(blocks):
                self.near[b, value ^ flips, k >> 3] |= np.uint8(1 << (k & 7))

    def within_radius(self, prints: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within the radius, through the index, of the items ``low`` to ``high``."""
        first = low >> 3
        found = np.zeros((len(prints), -(-high // 8) - first), np.uint8)
        for b in range(BLOCKS):
            found |= self.near[b, prints[:, b], first:first + found.shape[1]]
        named = np.unpackbits(found, axis=1, bitorder="little")[:, low - 8 * first:high - 8 * first]
        window, item = np.nonzero(named)
        item += low
        near = _distance(prints[window], self.prints[item]) <= self.radius
        return window[near], item[near]

    def match(self, text: str | None) -> list[tuple[int, float, int]]:
        """(item id, best similarity, first word of the window) of the items in a text."""
        words = word_hashes(text)
        best: dict[int, tuple[float, int]] = {}
        for width, hashes in self.owner.items():
            run = in_order(words, width)
            maybe = np.flatnonzero(self.seen[width][(run >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            hits: dict[int, list[int]] = {}
            for p in maybe.tolist():
                for g in hashes.get(int(run[p]), ()):
                    hits.setdefault(g, []).append(p)
            for g, places in hits.items():
                self._windows(g, run, np.array(places), best)
        return sorted((self.ids[k], s, a) for k, (s, a) in best.items())

    def _windows(self, g: int, run: np.ndarray, places: np.ndarray, best: dict) -> None:
        """Tries the windows of a group's size that hold a shingle of its items."""
        _, count, low, high = self.groups[g]
        n = min(count, len(run))
        last = len(run) - n
        cover = np.zeros(last + 2, np.int64)
        np.add.at(cover, np.maximum(places - n + 1, 0), 1)
        np.add.at(cover, np.minimum(places, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(cover)[:last + 1] > 0)
        for stretch in np.split(starts, np.flatnonzero(np.diff(starts) > n) + 1):
            for a in range(0, len(stretch), WINDOWS):
                part = stretch[a:a + WINDOWS]
                base = part[0]
                piece = run[base:part[-1] + n]
                sums = np.zeros((len(piece) + 1, BITS), np.int32)
                np.cumsum(_signed(piece), axis=0, out=sums[1:])
                window, item = self.within_radius(_fingerprints(sums[part - base + n] - sums[part - base]), low, high)
                for k in np.unique(item).tolist():
                    self._verify(k, piece, part[window[item == k]] - base, n, int(base), best)

    def _verify(self, k: int, piece: np.ndarray, starts: np.ndarray, n: int, base: int, best: dict) -> None:
        """The exact similarity of item ``k`` and its candidate windows. The window's
        shingles that the item has, repeats included, bound what can be shared."""
        own, count = self.bags[k], self.bags[k].total()
        has = np.concatenate([[0], np.cumsum(np.isin(piece, self.keys[k]))])
        most = has[starts + n] - has[starts]
        for at in starts[most >= self.least * (n + count - most) - 1e-9].tolist():
            bag = Counter(piece[at:at + n].tolist())
            shared = sum(min(c, own[h]) for h, c in bag.items() if h in own)
            s = shared / (n + count - shared)
            if s >= self.least and s > best.get(k, (0.0, 0))[0]:
                best[k] = (s, base + at)


def item_blocks(items: DataFrame, text: str, most_items: int, most_words: int):
    """Blocks of (item_id, text), read one after the other."""
    block, words = [], 0
    for row in items.select(F.col("item_id").cast("long"), F.col(text).cast("string")).orderBy("item_id").toLocalIterator():
        n = len((row[1] or "").split())
        if block and (len(block) >= most_items or words + n > most_words):
            yield block
            block, words = [], 0
        block.append((row[0], row[1]))
        words += n
    if block:
        yield block


MATCHES = "array<struct<item_id: long, similarity: double, word: long>>"


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", keep: list[str] | None = None, size: int = SIZE,
                  least: float = LEAST, radius: int = RADIUS, block_items: int = BLOCK_ITEMS,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``matches``: every item that a window reaches, with the
    best similarity and the window's first word."""
    spark = docs.sparkSession
    prepare(spark)
    own = kept(docs, docs.columns if keep is None else keep, ("matches",))
    carried = own if text in own else [*own, text]
    k_text = carried.index(text)
    made = docs.select(*carried, F.array().cast(MATCHES).alias("matches"))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("word", pa.int64())]))
    schema = ", ".join([schema_of(docs, carried), f"matches {MATCHES}"])
    for rows in item_blocks(items, "text", block_items, block_words):
        sent = spark.sparkContext.broadcast(rows)

        def run(batches, sent=sent):
            block = Items(sent.value, size, radius, least)
            for batch in batches:
                out = []
                for t, before in zip(batch.column(k_text).to_pylist(), batch.column(len(carried)).to_pylist()):
                    got = block.match(t)
                    out.append((before or []) + [{"item_id": i, "similarity": s, "word": w} for i, s, w in got])
                yield pa.RecordBatch.from_arrays([*(batch.column(j) for j in range(len(carried))), pa.array(out, kind)],
                                                 names=[*carried, "matches"])

        made = made.mapInArrow(run, schema)
    return made.select(*own, "matches")
