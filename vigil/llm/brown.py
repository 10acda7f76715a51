"""Class-based bigram language model: exchange clustering and scoring.

Words are put into classes so that the class bigrams of the training texts are
as likely as possible: with N the matrix of class successions (start and end of
a text are a class of their own), the objective is

    sum N(a,b) ln N(a,b) - sum N(a,.) ln N(a,.) - sum N(.,b) ln N(.,b).

*Exchange*: the ``classes`` - 1 most frequent words start in a class each, all
others in the last one; in each round every word of one half (by its number)
moves to the class that gains most, all words judged against the same N, which
is then counted anew from the texts. The classes of the best round are used.

A round is two exchanges of packed rows (``blocks.py``): each block of texts
sends, for its words, how often each class came before and after them to the
words' parts; a part adds these up, moves its words and tells the blocks the
new classes. Only N (``classes`` + 1 squared cells) and a few sums come to the
driver. Every word of the training texts takes part.

*Score*: P(w | v) = 0.9 P(class(w) | class(v)) P(w | class(w)) + 0.1 P1(w). The
transitions are smoothed towards the classes' own shares, the emissions are
discounted by D = n1 / (n1 + 2 n2) for each word type, which leaves a class's
share for the unknown word, and P1 is the add-0.1 unigram. For every history
the probabilities of all known words, the end and the unknown word add up to 1.

Defined cases: null and empty texts have the end token only; a null doc_id
counts as the empty text under crc32 (remainder 0: held out); repeated rows count and are
returned as often as they occur; an empty table gives an empty result; without
training texts N is 0, every word is unknown and the score is the base score; ties
between classes go to the present class, then to the lowest number, ties
between frequent words to the lower part and number; very long texts are one
block each. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.blocks import MESSAGE, by_block, by_part, cut, dictionaries, expand, message, part_count, squeeze, unpacked
from vigil.llm.common import written

CLASSES = 64
ROUNDS = 4
#: Weight of the class model, pseudo-count of the transitions, pseudo-count of the unigram (of the contract).
MIX, PRIOR, ADD = 0.9, 5.0, 0.1
HELD_MOD = 10

# Tags of messages; labels come last and tell a block how many words of each part it has.
COUNTS, IDS, LABELS = 0, 1, 2
NONE = 255
NO_LABELS = np.zeros(0, np.uint8)
#: Counts whose gains are made at once, and counts whose gains are tabled.
STEP, TABLED = 1 << 13, 32


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_MOD == 0


def xlogx(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def objective(n: np.ndarray) -> float:
    return float(xlogx(n).sum() - xlogx(n.sum(axis=1)).sum() - xlogx(n.sum(axis=0)).sum())


class Gains:
    """What it gains to put a word into each class, given the succession counts ``n``."""

    def __init__(self, n: np.ndarray):
        self.k = len(n)  # classes and the boundary
        # One column per cell of a word's counts: class before it (n[c, b]), class after it (n[b, c]).
        self.cells = np.ascontiguousarray(np.concatenate([n, n.T]).T.astype(float)[:-1])
        self.logs = xlogx(self.cells)
        self.table = np.concatenate([xlogx(self.cells + r) - self.logs for r in range(TABLED + 1)], axis=1)
        self.margins = [n.sum(axis=1).astype(float)[:-1], n.sum(axis=0).astype(float)[:-1]]

    def best(self, word: np.ndarray, cell: np.ndarray, count: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The new class of each word. ``word``, ``cell``, ``count`` are the
        words' non-zero counts, by word (0, 1, ... all present); ``label`` their classes."""
        new = label.copy()
        start = np.searchsorted(word, np.arange(len(label) + 1))
        stay = self.logs[label[word], cell] - xlogx(self.cells[label[word], cell] - count)
        size = np.add.reduceat(np.where(cell < self.k, count, 0), start[:-1])
        stay = np.add.reduceat(stay, start[:-1])
        for margin in self.margins:  # its own class counts without the word
            stay -= xlogx(margin[label]) - xlogx(margin[label] - size)
        at = 0
        while at < len(label):  # whole words, about STEP counts at once
            to = max(at + 1, int(np.searchsorted(start, start[at] + STEP, side="right")) - 1)
            c, r = cell[start[at]:start[to]], count[start[at]:start[to]]
            gain = np.take(self.table, c + 2 * self.k * np.minimum(r, TABLED), axis=1)
            big = np.flatnonzero(r > TABLED)
            if len(big):
                gain[:, big] = xlogx(self.cells[:, c[big]] + r[big]) - self.logs[:, c[big]]
            total = np.add.reduceat(gain, start[at:to] - start[at], axis=1)
            sizes, place = np.unique(size[at:to], return_inverse=True)
            for margin in self.margins:
                margin = margin[:, None]
                total -= np.take(xlogx(margin + sizes) - xlogx(margin), place, axis=1)
            own = np.arange(to - at)
            total[label[at:to], own] = stay[at:to]
            top = total.argmax(axis=0)
            better = total[top, own] > stay[at:to] + 1e-9 * np.abs(stay[at:to])
            new[at:to][better] = top[better]
            at = to
        return new


def _vocabulary(top: int):
    """Per part: the count of each word, and a number for each word that
    training texts have; sums and the ``top`` most frequent words come along (null block)."""
    def run(part, rows):
        blocks, words, counts = [], [], []
        for row in rows:
            blocks.append(row["block"].as_py())
            words.append(unpacked(expand(row["words"].as_py()), expand(row["sizes"].as_py())))
            counts.append(expand(row["counts"].as_py()))
        size = [len(w) for w in words]
        both = pa.concat_arrays(words).dictionary_encode()
        code = both.indices.to_numpy()
        total = np.zeros(len(both.dictionary), np.int64)
        np.add.at(total, code, np.concatenate(counts))
        order = pc.sort_indices(both.dictionary).to_numpy()
        known = order[total[order] > 0]
        ids = np.full(len(total), -1, np.int32)
        ids[known] = np.arange(len(known), dtype=np.int32)
        at = np.cumsum([0, *size])
        for k, block in enumerate(blocks):
            own = code[at[k]:at[k + 1]]
            yield message(block, part, COUNTS, total[own])
            yield message(block, part, IDS, ids[own])
        n = total[known]
        first = np.argsort(-n, kind="stable")[:top]
        yield message(None, part, COUNTS, np.array([len(n), n.sum(), (n == 1).sum(), (n == 2).sum()], np.int64))
        yield message(None, part, IDS, np.concatenate([n[first], first]).astype(np.int64))

    return run


def _sums(messages: DataFrame, part_rows: str, width: int) -> np.ndarray:
    """The parts' own rows (int64 payloads of ``width``) added up by Spark."""
    def cells(batches):
        for batch in batches:
            total = np.zeros(width, np.int64)
            for x in batch.column(0):
                total += expand(x.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array(total)], names=["i", "n"])

    got = (messages.filter(part_rows).select("payload").mapInArrow(cells, "i int, n long")
           .groupBy("i").agg(F.sum("n").alias("n")).toArrow())
    out = np.zeros(width, np.int64)
    out[got.column("i").to_numpy()] = got.column("n").to_numpy()
    return out


def _top_words(vocabulary: DataFrame, top: int) -> dict[int, list[tuple[int, int]]]:
    """{part: [(number, class)]} of the ``top`` most frequent words of all."""
    def rows(batches):
        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                n, first = expand(payload).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(n), pa.int32()), pa.array(first), pa.array(n)],
                                                 names=["part", "id", "n"])

    found = (vocabulary.filter(f"block IS NULL AND tag = {IDS}").select("part", "payload")
             .mapInArrow(rows, "part int, id long, n long").orderBy(F.desc("n"), "part", "id").limit(top).collect())
    out: dict[int, list[tuple[int, int]]] = {}
    for k, r in enumerate(found):
        out.setdefault(r["part"], []).append((r["id"], k))
    return out


def _first_labels(vocabulary: DataFrame, tops: dict, classes: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, part, payload in zip(*(batch.column(k).to_pylist() for k in range(3))):
                ids = expand(payload)
                label = np.where(ids >= 0, classes - 1, NONE).astype(np.uint8)
                for number, k in tops.get(part, ()):
                    label[ids == number] = k
                yield message(block, part, LABELS, label)

    return (vocabulary.filter(f"block IS NOT NULL AND tag = {IDS}").select("block", "part", "payload").mapInArrow(run, MESSAGE))


def _training(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """The codes of the training texts one after another, and the places (in
    these codes with a boundary, -1, before each text and after the last) of the words."""
    lens = row["lens"]
    train = row["_train"].to_numpy(zero_copy_only=False).astype(bool)
    codes = row["codes"][np.repeat(train, lens)]
    own = lens[train]
    at = np.arange(len(codes)) + np.repeat(np.arange(len(own)), own) + 1
    line = np.full(len(codes) + len(own) + 1, -1, np.int32)
    line[at] = codes
    return line, at


def _classes_of(line: np.ndarray, label: np.ndarray, boundary: int) -> np.ndarray:
    return np.append(label, np.uint8(boundary))[line]  # -1 is the last


def _successions(classes: int):
    k = classes + 1

    def run(row, got, sizes):
        line, at = _training(row)
        if len(line) > 1:
            c = _classes_of(line, got.get(LABELS, NO_LABELS), classes).astype(np.int64)
            n = np.bincount(c[:-1] * k + c[1:], minlength=k * k)
            yield message(row["block"], None, LABELS, n.astype(np.int64))

    return run


def _contexts(classes: int, half: int):
    """Each block's message to the parts: of every word its number and class,
    and of the words that may move how often each class came before and after them."""
    k = classes + 1

    def run(row, got, sizes):
        line, at = _training(row)
        label, ids = got.get(LABELS, NO_LABELS), got.get(IDS, np.zeros(0, np.int32))
        c = _classes_of(line, label, classes)
        code = line[at]
        moving = (ids >= 0) & ((ids + half) % 2 == 0)
        use = moving[code]
        w = code[use].astype(np.int64) * (2 * k)
        keys = np.sort(np.concatenate([w + c[at - 1][use], w + k + c[at + 1][use]]))
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        counts = np.diff(np.append(first, len(keys))).astype(np.int32)
        keys = keys[first]
        local = keys // (2 * k)
        ends = np.searchsorted(local, np.arange(len(ids) + 1))
        keys += (ids[local].astype(np.int64) - local) * (2 * k)
        block, at = row["block"], 0
        for part, size in sizes:
            low, high = ends[at], ends[at + size]
            # Keys rise within a part only after sorting by number; steps between them are small.
            own = np.argsort(keys[low:high])
            packed = (ids[at:at + size], label[at:at + size], np.diff(keys[low:high][own], prepend=0), counts[low:high][own])
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([part], pa.int32()), *[pa.array([squeeze(x)], pa.binary()) for x in packed]],
                names=["block", "part", "ids", "labels", "cells", "counts"])
            at += size

    return run


CONTEXT = "block long, part int, ids binary, labels binary, cells binary, counts binary"


def _moved(n: np.ndarray, classes: int, half: int):
    k = classes + 1

    def run(part, rows):
        gains = Gains(n)
        asked, label = [], np.zeros(0, np.uint8)
        acc = np.zeros((0, 2 * k), np.int64)  # a line for each word that may move
        for row in rows:
            ids, own = expand(row["ids"].as_py()), expand(row["labels"].as_py())
            asked.append((row["block"].as_py(), ids))
            size = int(ids.max()) + 1
            if size > len(label):
                label = np.concatenate([label, np.full(size - len(label), NONE, np.uint8)])
                acc.resize(((size - half + 1) // 2, 2 * k), refcheck=False)
            known = ids >= 0
            label[ids[known]] = own[known]
            # A block names each word and class once, so no place repeats.
            cells = np.cumsum(expand(row["cells"].as_py()))
            number, cell = np.divmod(cells, 2 * k)
            acc[number // 2, cell] += expand(row["counts"].as_py())
        label = label.astype(np.int64)
        if len(acc):
            word, cell = np.nonzero(acc)
            label[half::2] = gains.best(word, cell, acc[word, cell], label[half::2])
        final = np.append(label, NONE).astype(np.uint8)  # -1, an unknown word, is the last
        for block, ids in asked:
            yield message(block, part, LABELS, final[ids])
        yield message(None, part, LABELS, np.bincount(label, minlength=classes)[:classes].astype(np.int64))

    return run


class Model:
    """Log probabilities from the succession counts ``n``, the word types of each
    class and the counts of the corpus (``tokens`` with ends, ``types``, n1, n2)."""

    def __init__(self, n: np.ndarray, types: np.ndarray, tokens: int, n_types: int, ones: int, twos: int):
        k = len(n)
        self.k, self.tokens, self.n_types = k, tokens, n_types
        self.d = ones / (ones + 2 * twos) if ones and twos else 0.5
        share = n.sum(axis=0) / max(tokens, 1)
        out = n.sum(axis=1, keepdims=True)
        self.trans = (n + PRIOR * share) / (out + PRIOR)
        self.trans = np.vstack([self.trans, share])  # after an unknown word
        size = n.sum(axis=0).astype(float)  # tokens of each class (the last: ends)
        self.size = np.maximum(size, 1)
        left = np.append(self.d * types / self.size[:-1], 0.0)
        self.unknown = self.trans @ left

    def base(self, count: np.ndarray) -> np.ndarray:
        return (count + ADD) / (self.tokens + ADD * (self.n_types + 1))

    def scores(self, count: np.ndarray, label: np.ndarray, line: np.ndarray, ends: int) -> tuple[np.ndarray, np.ndarray]:
        """log10 of the base and of the model for each place of ``line`` but the
        first. ``count`` and ``label`` go by code; -1 in ``line`` is a boundary."""
        k = self.k
        c = np.append(np.where(label == NONE, k, label), k - 1)[line]
        n = np.append(count, ends)[line[1:]]
        base = self.base(n)
        if not self.tokens:
            return np.log10(base), np.log10(base)
        now, before = c[1:], c[:-1]
        known = now < k
        at = np.where(known, now, 0)
        emit = np.where(now == k - 1, 1.0, (n - self.d) / self.size[at])
        p = np.where(known, self.trans[before, at] * emit, self.unknown[before])
        return np.log10(base), np.log10(MIX * p + (1 - MIX) * base)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(model: Model, ends: int):
    def run(row, got, sizes):
        lens, codes = row["lens"].astype(np.int64), row["codes"]
        count, label = got.get(COUNTS, np.zeros(0, np.int64)), got.get(LABELS, NO_LABELS)
        line = np.full(len(codes) + len(lens) + 1, -1, np.int32)
        line[np.arange(len(codes)) + np.repeat(np.arange(len(lens)), lens) + 1] = codes
        base, own = model.scores(count, label.astype(np.int64), line, ends)
        start = np.cumsum(lens + 1) - lens - 1  # a text's words and its end
        known = np.append(count > 0, ends > 0)[line[1:]]
        m = len(lens)
        yield pa.RecordBatch.from_arrays(
            [row["doc_id"], pa.array(~row["_train"].to_numpy(zero_copy_only=False).astype(bool)),
             pa.array(lens + 1), pa.array(np.add.reduceat(known.astype(np.int64), start)),
             pa.array(np.full(m, model.tokens, np.int64)), pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(own, start))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, text: str = "text", classes: int = CLASSES, rounds: int = ROUNDS,
          block_bytes: int | None = None, trace: list | None = None) -> DataFrame:
    """One row per document (``SCORED``): ``score`` is the log10 probability of
    its text. ``trace`` gets the objective of the start and of each round."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).withColumn("_train", ~held_out(F.col("doc_id")))
    more = {"block_bytes": block_bytes} if block_bytes else {}
    table = cut(docs, text, ["doc_id", "_train"], part_count(docs, text), lower=True, flag="_train", **more)
    vocabulary = written(by_part(dictionaries(table), _vocabulary(classes - 1), MESSAGE), "vocabulary")
    n_types, tokens, ones, twos = _sums(vocabulary, f"block IS NULL AND tag = {COUNTS}", 4).tolist()
    ends = docs.filter("_train").count()
    tops = _top_words(vocabulary, classes - 1)
    to_blocks = vocabulary.filter("block IS NOT NULL")
    k = classes + 1

    def successions(labels):
        made = by_block(table, ["_train"], labels, _successions(classes), MESSAGE)
        return _sums(made, "true", k * k).reshape(k, k)

    labels = _first_labels(vocabulary, tops, classes)
    used = sum(len(v) for v in tops.values())
    types = np.array([1] * used + [0] * (classes - 1 - used) + [n_types - used], np.int64)
    n = successions(labels)
    best = (objective(n), labels, n, types)
    history = [best[0]]
    for half in range(rounds if n_types else 0):
        asked = by_block(table, ["_train"], labels.unionAll(to_blocks.filter(f"tag = {IDS}")), _contexts(classes, half % 2), CONTEXT)
        moved = written(by_part(asked, _moved(n, classes, half % 2), MESSAGE), "classes")
        labels = moved.filter("block IS NOT NULL")
        n = successions(labels)
        types = _sums(moved, "block IS NULL", classes)
        history.append(objective(n))
        if history[-1] > best[0]:
            best = (history[-1], labels, n, types)
    if trace is not None:
        trace.extend(history)
    model = Model(best[2], best[3], tokens + ends, n_types + (ends > 0), ones, twos)
    answers = best[1].unionAll(to_blocks.filter(f"tag = {COUNTS}"))
    return by_block(table, ["doc_id", "_train"], answers, _score(model, ends), SCORED)
