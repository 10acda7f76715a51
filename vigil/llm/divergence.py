"""Source divergence audit: how the sources of a language differ in their terms.

Texts are factored into white-space chunks. Each block of texts (``blocks.py``)
counts its chunks by document; each globally distinct chunk is cut into terms
once, in the part of its hash, and the terms go back to the blocks that have the
chunk. A block then adds up, by term and (lang, source), the distinct documents
and the occurrences, and sends them to the parts of the terms, where they are
summed over all blocks. Terms in at least ``least`` documents of a language are kept.

With p = 1 + floor(10^9 (count + 5) / (N + 5 V)) for each kept term, a group's
distance to another source of its language is the sum of |p - q| over all kept
terms, and a term's excess is p - q against the whole language. Distances are
made from tiles: the terms of a language are cut into blocks, its sources
into tiles, and a task fills the matrix of one term block and two tiles.

Defined cases: null text, lang and source count as empty; a group without kept
terms has its distances (all its terms have count 0) and no excess; a language
without kept terms has distances 0; a language with one source has no distances;
ties go by the item's bytes; repeated rows (also of one doc_id, or without one)
are documents each; very long texts are one block each; an empty table gives an empty
result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.blocks import (MESSAGE, by_block, by_part, cut, dictionaries, expand, message, packed, part_count, part_of, split_words,
                              squeeze, unpacked)
from vigil.llm.common import written

LEAST, PSEUDO, UNIT, RANKS = 30, 5, 1_000_000_000, 50
#: Terms of a block and sources of a tile, about.
TERMS, SOURCES = 4096, 256

# Fixed values of the contract: bytes that are no part of a term (the ranges 00-40, 5B-60 and 7B-7F).
_NO_TERM = np.zeros(256, bool)
_NO_TERM[0x00:0x41] = _NO_TERM[0x5B:0x61] = _NO_TERM[0x7B:0x80] = True

N_TERMS, SIZES, BYTES = 0, 1, 2


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], ..., start[0] + size[0] - 1, start[1], ..."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - size - start, size)


def _tokenized(part, rows):
    """The terms of every distinct chunk of a part, made once, for each block that asked."""
    blocks, chunks = [], []
    for row in rows:
        blocks.append(row["block"].as_py())
        chunks.append(unpacked(expand(row["words"].as_py()), expand(row["sizes"].as_py())))
    both = pa.concat_arrays(chunks).dictionary_encode()
    terms, n = split_words(both.dictionary.to_pylist(), True, _NO_TERM)
    start, code, at = np.cumsum(n) - n, both.indices.to_numpy(), 0
    for block, own in zip(blocks, map(len, chunks)):
        mine = code[at:at + own]
        at += own
        data, sizes = packed(terms.take(pa.array(_ranges(start[mine], n[mine]))))
        yield message(block, part, N_TERMS, n[mine].astype(np.int32))
        yield message(block, part, SIZES, expand(sizes))
        yield message(block, part, BYTES, expand(data))


COUNTED = ("block long, part int, words binary, sizes binary, term binary, grp binary, occ binary, docs binary, "
           "langs array<string>, sources array<string>")


def _counted(parts: int):
    """A block's documents and occurrences by term and (lang, source), for the terms' parts."""
    def run(row, got, sizes):
        if not len(got.get(SIZES, ())):
            return
        n, lens, code = got[N_TERMS].astype(np.int64), row["lens"], row["codes"]
        terms = unpacked(got[BYTES], got[SIZES])
        both = terms.dictionary_encode()
        local, names = both.indices.to_numpy().astype(np.int64), both.dictionary
        # Every occurrence of a term with its document: chunks are replaced by their terms.
        doc = np.repeat(np.repeat(np.arange(len(lens)), lens), n[code])
        term = local[_ranges((np.cumsum(n) - n)[code], n[code])]
        group_of: dict[tuple, int] = {}
        langs, sources = row["_lang"].to_pylist(), row["_source"].to_pylist()
        group = np.array([group_of.setdefault(g, len(group_of)) for g in zip(langs, sources)], np.int64)
        # Distinct (term, document), then (term, group).
        d = len(lens)
        pair = np.sort(term * d + doc)
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        occ = np.diff(np.append(first, len(pair)))
        key = (pair[first] // d) * len(group_of) + group[pair[first] % d]
        order = np.argsort(key, kind="stable")
        key, occ = key[order], occ[order]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        total, docs, key = np.add.reduceat(occ, start), np.diff(np.append(start, len(key))), key[start]
        # By part: the terms in its order, entries follow their terms.
        part = part_of(names, parts)
        by_part_order = np.argsort(part, kind="stable")
        place = np.empty(len(part), np.int64)
        place[by_part_order] = np.arange(len(part))
        at = place[key // len(group_of)]
        order = np.argsort(at, kind="stable")
        at, grp, total, docs = at[order], (key % len(group_of))[order], total[order], docs[order]
        names, part = names.take(pa.array(by_part_order)), part[by_part_order]
        every = list(group_of)
        for p in np.unique(part).tolist():
            low, high = np.searchsorted(part, [p, p + 1])
            own = slice(*np.searchsorted(at, [low, high]))
            used, mine = np.unique(grp[own], return_inverse=True)
            data, word_sizes = packed(names.slice(low, high - low))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]], pa.int64()), pa.array([p], pa.int32()), pa.array([data], pa.binary()),
                 pa.array([word_sizes], pa.binary()),
                 *[pa.array([squeeze(np.asarray(x, np.int32))], pa.binary())
                   for x in (np.diff(at[own], prepend=low), mine, total[own], docs[own])],
                 pa.array([[every[g][0] for g in used]], pa.list_(pa.string())),
                 pa.array([[every[g][1] for g in used]], pa.list_(pa.string()))],
                names=["block", "part", "words", "sizes", "term", "grp", "occ", "docs", "langs", "sources"])

    return run


def _kept(least: int):
    def run(part, rows):
        words, term, grp, occ, docs = [], [], [], [], []
        groups: dict[tuple, int] = {}
        at = 0
        for row in rows:
            w = unpacked(expand(row["words"].as_py()), expand(row["sizes"].as_py()))
            own = np.array([groups.setdefault(g, len(groups)) for g in zip(row["langs"].as_py(), row["sources"].as_py())], np.int64)
            words.append(w)
            term.append(np.cumsum(expand(row["term"].as_py()), dtype=np.int64) + at)
            grp.append(own[expand(row["grp"].as_py())])
            occ.append(expand(row["occ"].as_py()))
            docs.append(expand(row["docs"].as_py()))
            at += len(w)
        both = pa.concat_arrays(words).dictionary_encode()
        term, grp = both.indices.to_numpy()[np.concatenate(term)].astype(np.int64), np.concatenate(grp)
        every = list(groups)
        lang_of: dict[str, int] = {}
        lang = np.array([lang_of.setdefault(g[0], len(lang_of)) for g in every], np.int64)
        in_lang = np.bincount(term * len(lang_of) + lang[grp], np.concatenate(docs), len(both.dictionary) * len(lang_of))
        use = in_lang[term * len(lang_of) + lang[grp]] >= least
        if not use.any():
            return
        key, place = np.unique(term[use] * len(groups) + grp[use], return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, place, np.concatenate(occ)[use])
        names = both.dictionary.take(pa.array(key // len(groups))).cast(pa.binary()).cast(pa.string())
        group = (key % len(groups)).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([every[g][0] for g in group], pa.string()), pa.array([every[g][1] for g in group], pa.string()), names,
             pa.array(total)], names=["lang", "source", "term", "n"])

    return run


def term_counts(docs: DataFrame, text: str = "text", least: int = LEAST, block_bytes: int | None = None) -> DataFrame:
    """(lang, source, term, n): occurrences of the kept terms, where there are any."""
    rows = named(docs, text)
    parts = part_count(rows, text)
    more = {"block_bytes": block_bytes} if block_bytes else {}
    table = cut(rows, text, ["_lang", "_source"], parts, **more)
    answers = by_part(dictionaries(table), _tokenized, MESSAGE)
    counted = by_block(table, ["_lang", "_source"], answers, _counted(parts), COUNTED)
    return written(by_part(counted, _kept(least), "lang string, source string, term string, n long"), "term-counts")


def named(docs: DataFrame, *cols: str) -> DataFrame:
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}")
    return docs.select(*cols, name("lang"), name("source"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), exact; 0 where there are no kept terms."""
    big = lambda c: c.cast("decimal(38,0)")
    over = F.lit(UNIT).cast("decimal(12,0)") * (n.cast("decimal(20,0)") + PSEUDO)
    under = big(total) + big(terms) * PSEUDO
    whole = F.call_function("div", big(over), under)
    return F.when(terms > 0, whole + 1).otherwise(F.lit(0)).cast("long")


def _distances(table: pa.Table) -> pa.Table:
    """Sums of |p - q| over one block of terms, for the sources of two tiles."""
    lang, left, right, terms = (table.column(c)[0].as_py() for c in ("lang", "left", "right", "n_terms"))
    kind = table.column("term").is_null().to_numpy()
    source, tile, p = (table.column(c) for c in ("source", "tile", "p"))
    names = source.combine_chunks().dictionary_encode()
    names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
    code, value, tiles = names.indices.to_numpy(), p.to_numpy(), tile.to_numpy()
    size = len(names.dictionary)
    zero, of_tile = np.zeros(size, np.int64), np.zeros(size, np.int64)
    zero[code[kind]], of_tile[code[kind]] = value[kind], tiles[kind]
    words = table.column("term").combine_chunks().dictionary_encode()
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    column = words.indices.filter(pa.array(~kind)).to_numpy()
    matrix = np.repeat(zero[:, None], len(words.dictionary), axis=1)
    matrix[code[~kind], column] = value[~kind]
    absent = (terms or 0) - matrix.shape[1]  # terms that none of these sources has
    a, b = np.flatnonzero(of_tile == left), np.flatnonzero(of_tile == right)
    out = [[], [], []]
    for x in a.tolist():
        far = np.abs(matrix[b] - matrix[x]).sum(axis=1) + absent * np.abs(zero[b] - zero[x])
        use = b != x if left != right else b > x
        out[0] += [x] * int(use.sum())
        out[1] += b[use].tolist()
        out[2] += far[use].tolist()
    text = names.dictionary
    return pa.table({"lang": pa.array([lang] * len(out[0]), pa.string()), "a": text.take(pa.array(out[0], pa.int64())),
                     "b": text.take(pa.array(out[1], pa.int64())), "value": pa.array(out[2], pa.int64())})


def audit(docs: DataFrame, text: str = "text", least: int = LEAST, ranks: int = RANKS, block_bytes: int | None = None,
          block_terms: int = TERMS, tile_sources: int = SOURCES) -> DataFrame:
    """lang, source, part (``pair``, ``term``), item, value, rank."""
    counts = term_counts(docs, text, least, block_bytes)
    by_term = written(counts.groupBy("lang", "term").agg(F.sum("n").alias("n")), "lang-terms")
    langs = by_term.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seen = (named(docs).groupBy("_lang", "_source").agg(F.lit(1).alias("one"))
            .select(F.col("_lang").alias("lang"), F.col("_source").alias("source")))
    groups = (seen.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .na.fill(0, ["total", "lang_total", "terms"]))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / block_terms)).cast("int")
    n_tiles = F.ceil(F.col("sources") / tile_sources).cast("int")
    groups = groups.join(sizes, "lang").withColumn("blocks", n_blocks).withColumn("tiles", n_tiles)
    groups = written(groups.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
                     .withColumn("zero", share(F.lit(0), F.col("total"), F.col("terms"))), "groups")
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    rows = written(counts.join(groups, ["lang", "source"])
                   .select("lang", "source", "term", p.alias("p"), "tile", "tiles",
                           F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")), "shares")

    # Excess over the language.
    whole = by_term.join(langs, "lang").select("lang", "term", share(F.col("n"), F.col("lang_total"), F.col("terms")).alias("q"))
    more = rows.join(whole, ["lang", "term"]).filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    excess = more.withColumn("rank", place).filter(F.col("rank") <= ranks)

    # Distances between the sources of a language.
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    pairs = F.transform(every, lambda t: F.struct(F.least(t, F.col("tile")).alias("left"), F.greatest(t, F.col("tile")).alias("right")))
    blank = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), "tile", "tiles",
                          F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    in_block = (by_term.join(groups.groupBy("lang").agg(F.max("blocks").alias("blocks")), "lang")
                .groupBy("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"))
                .agg(F.count(F.lit(1)).alias("n_terms")))
    tiled = (rows.select(*blank.columns).unionAll(blank).join(in_block, ["lang", "block"], "left")
             .select("lang", "block", "source", "term", "p", "tile", "n_terms", F.inline(pairs)))
    sums = (tiled.groupBy("lang", "block", "left", "right").applyInArrow(_distances, "lang string, a string, b string, value long")
            .groupBy("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("value").alias("value")))
    both = sums.select("lang", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), "value"),
                                                F.struct(F.col("b").alias("source"), F.col("a").alias("item"), "value"))))
    distances = both.withColumn("rank", place)
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return (distances.withColumn("part", F.lit("pair")).select(*cols)
            .unionAll(excess.withColumn("part", F.lit("term")).select(*cols)))
