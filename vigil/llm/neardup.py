"""Near-duplicate documents: MinHash signatures joined within a signature distance.

1. Sets. A document's word shingles (distinct, as 64-bit hashes) give a set and
   a signature of ``symbols`` b-bit minima. Documents with equal sets form a
   class, represented by its smallest doc_id; only classes go on.
2. Multi-index join. The signature is split into chunks. A pair whose
   signatures differ in at most ``chunks * (errors + 1) - 1`` symbols has, by
   the pigeonhole principle, a chunk with at most ``errors`` wrong symbols.
   Each class therefore enters one key for every chunk and every choice of
   symbols that may be wrong; such a pair meets under a common key. With the
   default 30 symbols in 5 chunks and 2 errors the guarantee is a distance of
   14; a pair of similarity 0.8 exceeds it with probability below 0.0003.
3. Blocks. Rows that share a key meet by one exchange, with four bits of each
   symbol of their signature, and only those within the guaranteed distance by
   these bits go on: unrelated classes that meet by chance, whose number grows
   with the square of the table, end there. Classes so joined form a cluster; its members are dealt
   over blocks of bounded size, and only pairs of blocks that some key spans
   are compared: each block by itself, then a few members for all that are
   linked there, then the members that share a key and are in different groups
   still. No row pairs are emitted: a task holds two blocks and returns
   the links that join its members into groups, at most one per member.
4. Check. Within a task the signatures of two members are compared, and pairs
   beyond the guaranteed distance go no further. The others are confirmed on the
   full sets: shared shingles by bit masks over the shingles that occur more than
   once in the two blocks.
5. Components of the confirmed links, then back to all documents.

Defined cases: null, empty or blank text has an empty set and is linked with
nothing (component: itself); fewer words than a shingle make the whole
sequence one shingle; whole texts are taken at any length; equal texts are one
class; documents with a null doc_id keep a null component and are kept; rows
that repeat a doc_id with different texts link through that id; an empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import prepare, salted_join, written
from vigil.llm.components import components

SYMBOLS, CHUNKS, ERRORS = 30, 5, 2
#: Shingles in a block of classes, on average; one task compares two blocks. Each
#: class counts MEMBER more, which bounds the members of a block of short texts.
BLOCK_SHINGLES = 400_000
MEMBER = 500
#: Rows of a key that are compared by their sketches; those of a larger key are all joined
#: to its first one, and compared in blocks like others. Rows compared with each other at once.
KEY_ROWS, AT_ONCE = 20_000, 16
#: Members of linked ones of a block (as many at least) that are compared with those of other blocks first.
DELEGATES = 16

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text (A-Z lower-cased)."""
    words = (text or "").encode("utf-8").lower().split()  # both ASCII only, as bytes
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def in_order(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    stop = len(h) - width + 1
    if stop <= 0:
        return np.zeros(0, np.uint64)
    out = h[:stop].copy()
    for k in range(1, width):
        out = _mix(out) * _ODD + h[k:stop + k]
    return _mix(out + np.uint64(width))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    h = word_hashes(text)
    return np.unique(in_order(h, min(size, len(h)))) if len(h) else h


def _multipliers(symbols: int) -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 1 << 63, symbols, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(sets: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The upper 16 bits of the smallest product by each multiplier, of a set that isn't empty."""
    low = np.array([(_mix(sets * a)).min() for a in multipliers])
    return _mix(low).astype(np.uint16)


def _keys(sigs: np.ndarray, chunks: int, errors: int) -> np.ndarray:
    """(rows, keys): a hash for each chunk and choice of symbols that must agree."""
    n, symbols = sigs.shape
    width = symbols // chunks
    out = []
    for c in range(chunks):
        part = sigs[:, c * width:(c + 1) * width if c < chunks - 1 else symbols].astype(np.uint64)
        for number, own in enumerate(combinations(range(part.shape[1]), part.shape[1] - errors)):
            h = np.full(n, (c << 16) + number + 1, np.uint64)
            for k in own:
                h = _mix(h * _ODD + part[:, k])
            out.append(h)
    return np.stack(out, axis=1)


def _column(a: np.ndarray) -> pa.Array:
    return pa.array(a.astype(np.uint64).view(np.int64), pa.int64())


def signed(docs: DataFrame, text: str, size: int, symbols: int) -> DataFrame:
    """(doc_id, n_shingles, set_hash, signature) of every row; null hash and signature for empty sets."""
    def run(batches):
        mult = _multipliers(symbols)
        for batch in batches:
            n, hashes, sigs = [], [], []
            for t in batch.column(1).to_pylist():
                s = shingles(t, size)
                n.append(len(s))
                hashes.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signature(s, mult).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(hashes, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "set_hash", "signature"])

    return (docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string"))
            .mapInArrow(run, "doc_id long, n_shingles long, set_hash binary, signature binary"))


def n_sketch(symbols: int) -> int:
    return -(-symbols // 16)


def sketch(sigs: np.ndarray) -> np.ndarray:
    """(rows, words): the lowest four bits of each symbol. Sketches differ in no
    more symbols than the signatures."""
    out = np.zeros((len(sigs), n_sketch(sigs.shape[1])), np.uint64)
    for k in range(sigs.shape[1]):
        out[:, k // 16] |= (sigs[:, k].astype(np.uint64) & np.uint64(15)) << np.uint64(4 * (k % 16))
    return out


def sketch_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that differ, row by row (``b`` may be one row)."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def keyed(classes: DataFrame, chunks: int, errors: int, symbols: int = SYMBOLS) -> DataFrame:
    """(key, node, s0, s1, ...): the keys of every class, with its sketch."""
    words = [f"s{k}" for k in range(n_sketch(symbols))]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            for a in range(0, batch.num_rows, 1000):
                k = _keys(sigs[a:a + 1000], chunks, errors)
                nodes = np.repeat(batch.column(0).to_numpy()[a:a + 1000], k.shape[1])
                own = np.repeat(sketch(sigs[a:a + 1000]), k.shape[1], axis=0)
                yield pa.RecordBatch.from_arrays([_column(k.ravel()), pa.array(nodes, pa.int64()), *map(_column, own.T)],
                                                 names=["key", "node", *words])

    return (classes.select("node", "signature")
            .mapInArrow(run, ", ".join(["key long", "node long", *(f"{w} long" for w in words)])))


def near_rows(key: np.ndarray, sketches: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(head, row) indexes that join the rows of each key (equal keys side by
    side) into the groups that pairs within ``distance`` by their sketches make.
    Every row of such a group is the second of a pair; single rows are left out."""
    n = len(key)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, n))
    heads, tails = [], []
    # Small groups all together, each row with the ones before it at 1, 2, ... places.
    small = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= AT_ONCE), sizes))
    for k in range(1, AT_ONCE):
        later = small[small >= k]
        later = later[key[later] == key[later - k]]
        if not len(later):
            break
        later = later[sketch_distance(sketches[later], sketches[later - k]) <= distance]
        heads.append(later - k)
        tails.append(later)
    if heads:
        u, v = np.concatenate(heads), np.concatenate(tails)
        first = np.arange(n)
        np.minimum.at(first, v, u)
        # Of pairs to rows of one head the one to the head is enough.
        use = (u == first[v]) | (first[u] != first[v])
        heads, tails = [u[use]], [v[use]]
    for g in np.flatnonzero(sizes > AT_ONCE):
        rest = np.arange(starts[g], starts[g] + sizes[g])
        while len(rest) > 1:
            head, rest = rest[0], rest[1:]
            todo = [head]
            while todo and len(rest):
                near = sketch_distance(sketches[rest], sketches[todo.pop()]) <= distance
                found, rest = rest[near], rest[~near]
                todo += found.tolist()
                heads.append(np.full(len(found), head))
                tails.append(found)
    if not heads:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = np.concatenate(heads), np.concatenate(tails)
    alone = np.setdiff1d(u, v)
    return np.concatenate([alone, u]), np.concatenate([alone, v])


def meeting(keys: DataFrame, distance: int, key_rows: int = KEY_ROWS) -> DataFrame:
    """(key, head, node): the classes of each key that are near another one of
    it by their sketches, each with one that it is joined to (or itself). The rows of a key
    come as a sorted run of one task, which holds ``key_rows`` of them; where
    there are more, all of them are joined to the first."""
    words = [c for c in keys.columns if c not in ("key", "node")]

    def run(batches):
        held: list[np.ndarray] = []  # rows (key, node, sketch) of the last key so far, fewer than key_rows
        hot = None  # (key, first node) of a key that had more

        def made(key, head, node):
            return pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(head, pa.int64()), pa.array(node, pa.int64())],
                                              names=["key", "head", "node"])

        def near(rows):
            u, v = near_rows(rows[:, 0], rows[:, 2:].view(np.uint64), distance)
            return made(rows[v, 0], rows[u, 1], rows[v, 1])

        for batch in batches:
            rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
            if hot is not None and len(rows):
                own = np.searchsorted(rows[:, 0], hot[0], side="right")
                yield made(rows[:own, 0], np.full(own, hot[1]), rows[:own, 1])
                rows = rows[own:]
            if not len(rows):
                continue
            hot = None
            last = np.searchsorted(rows[:, 0], rows[-1, 0])
            if held and held[0][0, 0] != rows[-1, 0]:
                yield near(np.concatenate([*held, rows[:last]]))
                held = []
            elif last:
                yield near(rows[:last])
            held.append(rows[last:])
            if sum(map(len, held)) > key_rows:
                rows, held = np.concatenate(held), []
                hot = (rows[0, 0], rows[0, 1])
                yield made(rows[:, 0], np.full(len(rows), hot[1]), rows[:, 1])
        if held:
            yield near(np.concatenate(held))

    return (keys.select("key", "node", *words).repartition("key").sortWithinPartitions("key", "node")
            .mapInArrow(run, "key long, head long, node long"))


def link_block(nodes: np.ndarray, sets: list[np.ndarray], sigs: np.ndarray, first: np.ndarray, percent: int,
               distance: int) -> list[tuple[int, int]]:
    """Links (signatures within ``distance`` and 100 * shared >= percent * union)
    that connect the members of two blocks (``first``: in the first block): a
    spanning forest of them."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[k]) for k in order])
    both = np.concatenate([sets[k] for k in order])
    own = np.repeat(np.arange(len(order)), sizes)
    values, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
    place = np.cumsum(counts > 1) - 1  # only shingles that occur twice can be shared
    use = counts[inverse] > 1
    n_bits = int((counts > 1).sum())
    bits = np.zeros((len(order), -(-n_bits // 64) or 1), np.uint64)
    col = place[inverse[use]]
    np.bitwise_or.at(bits, (own[use], col >> 6), np.uint64(1) << (col & 63).astype(np.uint64))
    group = np.arange(len(order))

    out = []
    side, sigs = first[order], sigs[order]
    one_block = bool(side.all())
    for k in range(len(order) - 1):
        # Larger sets up to the size bound, of another group, across the blocks.
        stop = np.searchsorted(sizes, sizes[k] * 100 / percent, side="right")
        rest = np.arange(k + 1, stop)
        rest = rest[group[rest] != group[k]]
        if not one_block:
            rest = rest[side[rest] != side[k]]
        rest = rest[(sigs[rest] != sigs[k]).sum(axis=1) <= distance]
        while len(rest):
            part, rest = rest[:256], rest[256:]
            shared = np.bitwise_count(bits[part] & bits[k]).sum(axis=1, dtype=np.int64)
            for j in part[100 * shared >= percent * (sizes[part] + sizes[k] - shared)]:
                if group[j] != group[k]:
                    out.append((int(nodes[order[k]]), int(nodes[order[j]])))
                    group[group == group[j]] = group[k]
            rest = rest[group[rest] != group[k]]
    return out


def full_sets(clustered: DataFrame, docs: DataFrame, text: str, size: int) -> DataFrame:
    """``clustered`` with the ``shingles`` of each text of a node, as a table."""
    def sets(batches):
        for batch in batches:
            got = [shingles(t, size).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], names=["node", "shingles"])

    # One text of each class: the rows of its smallest doc_id (equal sets, or any of them).
    texts = (docs.select(F.col("doc_id").cast("long").alias("node"), F.col(text).cast("string").alias("text"))
             .join(clustered.select("node").hint("merge"), "node", "left_semi"))
    full = texts.mapInArrow(sets, "node long, shingles binary").filter(F.octet_length("shingles") > 0)
    return written(full.join(clustered.hint("merge"), "node"), "shingles")


def linked(tasks: DataFrame, percent: int, symbols: int, distance: int) -> DataFrame:
    """Confirmed links (u, v) of ``tasks``: (cluster, a, b, block, node, signature,
    shingles), the rows of the blocks ``a`` and ``b`` of each comparison."""
    def run(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        sets_ = [np.frombuffer(b, np.uint64) for b in table.column("shingles").to_pylist()]
        first = (table.column("block").to_numpy() == table.column("a").to_numpy())
        mult = _multipliers(symbols)
        sigs = np.stack([np.frombuffer(b, np.uint16) if b else signature(s, mult)
                         for b, s in zip(table.column("signature").to_pylist(), sets_)])
        links = link_block(nodes, sets_, sigs, first, percent, distance)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    made = tasks.select("cluster", "a", "b", "block", "node", "signature", "shingles").groupBy("cluster", "a", "b")
    return written(made.applyInArrow(run, "u long, v long"), "links")


def delegates(members: DataFrame, block_shingles: int) -> DataFrame:
    """(cluster, a, b, block, node): comparisons of some members of each block for
    all those of it that are linked. ``members``: (node, n, cluster, block, group)."""
    at = Window.partitionBy("cluster", "block", "group").orderBy(F.xxhash64("node"))
    some = (members.withColumn("rank", F.row_number().over(at))
            .withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("cluster", "block", "group")))
            .filter((F.col("size") >= DELEGATES) & (F.col("rank") <= DELEGATES)))
    filled = some.groupBy("cluster").agg(F.ceil(F.sum(F.col("n") + MEMBER) / block_shingles).cast("long").alias("parts"))
    some = some.join(filled.hint("merge"), "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "parts"))
    each = some.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return each.select("cluster", F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), "block", "node")


def across(met: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster, a, b, block, node): the members of different blocks that share a
    key with some that are not linked to them yet. ``members``: (node, cluster, block, group)."""
    rows = met.select("key", "node").join(members.select("node", "cluster", "block", "group").hint("merge"), "node").distinct()
    open_ = (rows.groupBy("key", "cluster").agg(F.collect_set("block").alias("blocks"), F.min("group").alias("least"),
                                                F.max("group").alias("most"))
             .filter((F.col("least") < F.col("most")) & (F.size("blocks") > 1)).select("key", "cluster", "blocks"))
    each = (rows.join(open_.hint("merge"), ["key", "cluster"])
            .select("cluster", "block", "node", F.explode("blocks").alias("with")).filter("block <> with"))
    return each.select("cluster", F.least("block", "with").alias("a"), F.greatest("block", "with").alias("b"), "block", "node").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", size: int = 5, percent: int = 80, symbols: int = SYMBOLS,
                    chunks: int = CHUNKS, errors: int = ERRORS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    prepare(docs.sparkSession)
    rows = written(signed(docs, text, size, symbols), "signatures")
    known = rows.filter("set_hash is not null and doc_id is not null")
    classes = known.groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"),
                                            F.min("signature").alias("signature"))
    classes = written(classes, "classes")

    distance = chunks * (errors + 1) - 1
    met = written(meeting(keyed(classes, chunks, errors, symbols), distance), "met")
    clusters = written(components(met.select(F.col("head").alias("u"), F.col("node").alias("v"))), "clusters")

    # Blocks: members dealt by a hash over as many blocks as the cluster's shingles fill.
    # Where one doc_id stands for several sets, each text's own signature is made when it is compared.
    one = F.when(F.count(F.lit(1)) == 1, F.min("signature")).alias("signature")
    members = (classes.groupBy("node").agg(F.max("n").alias("n"), one)
               .join(clusters.select("node", F.col("component").alias("cluster")).hint("merge"), "node"))
    filled = members.groupBy("cluster").agg(F.ceil(F.sum(F.col("n") + MEMBER) / block_shingles).cast("long").alias("blocks"))
    clustered = written(
        salted_join(members, filled, "cluster", "inner")
        .select("node", "n", "signature", "cluster", "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("block")), "blocks")
    full = full_sets(clustered, docs, text, size)
    edges = linked(full.select("*", F.col("block").alias("a"), F.col("block").alias("b")), percent, symbols, distance)
    several = clustered.filter("blocks > 1").drop("signature")
    if not several.isEmpty():
        rest = full.filter("blocks > 1").select("node", "signature", "shingles")

        def grouped(edges: DataFrame) -> DataFrame:
            own = components(edges.join(several.select(F.col("node").alias("u")).hint("merge"), "u", "left_semi"))
            return several.join(own.hint("merge"), "node", "left").select("*", F.coalesce("component", "node").alias("group"))

        for tasks in (lambda m: delegates(m, block_shingles), lambda m: across(met, m)):
            pairs = written(tasks(written(grouped(edges), "groups")), "comparisons")
            edges = edges.unionByName(linked(rest.join(pairs.hint("merge"), "node"), percent, symbols, distance))

    # Classes that share a smallest doc_id, and ids that repeat, link by that id.
    final = components(edges)
    own = salted_join(known.select("doc_id", "set_hash"), classes.select("set_hash", "node").hint("merge"), "set_hash")
    found = (own.join(final, "node", "left")
             .select("doc_id", F.coalesce("component", "node").alias("component_id"))
             .groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    out = rows.select("doc_id", "n_shingles").join(found, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
