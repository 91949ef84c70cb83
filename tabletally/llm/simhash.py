"""SimHash near-duplicates with BK-trees.

A text's fingerprint has 64 bits: bit i is set if it is set in over half of
the XXH64 hashes of the text's word shingles. Texts are linked if their
fingerprints differ in at most ``radius`` bits; the classes are the connected
components.

Finding the links. Equal fingerprints are one node. The bits are cut into
``radius + 2`` blocks, of which two fingerprints within the radius agree on at
least two; every pair of blocks is a key, so all partners of a fingerprint
share a key with it, exactly. Each key's fingerprints form a *shard* with a
BK-tree: a child hangs under its parent at their Hamming distance, and a search
follows only the edges within the radius of the query's distance. A shard of
more than ``shard`` fingerprints is cut into parts; each part's tree is sent to
the queries of every part, so that no task holds a whole hot shard. Trees of
many shards are built and searched level by level as one forest with array
operations.

A task reports the links it found as a spanning star per local component:
nothing is lost for connectivity, and a dense group does not emit all its
pairs. The components of the stars are found by contraction: every node points
to its smallest neighbour in a random order, edges are moved to the pointed
nodes, until none is left (a logarithmic number of rounds; each is
checkpointed).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from .common import free_name, reliable, table, with_text_columns

SEED = 42
QUERIES_AT_ONCE = 128
ROWS_AT_ONCE = 30_000


def fingerprint(text: str, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number; no words: 0."""
    words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(len(words) - shingle + 1, 1)
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    first = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)], "<u8", n)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    votes = 2 * bits.sum(axis=0, dtype=np.int64) > n
    return int(np.packbits(votes, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, text: str, shingle: int, keep: list[str] | None = None) -> DataFrame:
    def make() -> Callable[[list[str]], list]:
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]

    return with_text_columns(df, text, StructType().add("fp", LongType()), make, keep)


def block_keys(fp: Column, radius: int) -> Column:
    """Array of (pair of blocks, their bits): partners within the radius share at least one."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    both = [m | n for m, n in combinations(masks, 2)]
    return F.array(*[
        F.struct(F.lit(k).alias("blocks"), fp.bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("long")).alias("bits"))
        for k, m in enumerate(both)
    ])


class Forest:
    """BK-trees of several shards; members of one shard are neighbours in the arrays."""

    def __init__(self, fps: np.ndarray, shards: np.ndarray):
        self.fps = fps
        self.children = np.full((len(fps), 65), -1, np.int32)
        first = np.concatenate([[True], shards[1:] != shards[:-1]])
        roots = np.flatnonzero(first)
        self.root_of = dict(zip(shards[roots].tolist(), roots.tolist(), strict=True))
        rest = np.flatnonzero(~first)
        at = roots[np.cumsum(first) - 1][rest]
        while len(rest):  # one tree level a turn
            far = np.bitwise_count(fps[rest] ^ fps[at])
            empty = np.flatnonzero(self.children[at, far] < 0)
            _, new = np.unique(at[empty].astype(np.int64) * 65 + far[empty], return_index=True)
            new = empty[new]
            self.children[at[new], far[new]] = rest[new]
            stays = np.ones(len(rest), bool)
            stays[new] = False
            rest, at, far = rest[stays], at[stays], far[stays]
            at = self.children[at, far]

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, member) index pairs within the radius, a tree level of a few queries at a time."""
        around = np.arange(-radius, radius + 1)
        for start in range(0, len(queries), QUERIES_AT_ONCE):
            q = np.arange(start, min(start + QUERIES_AT_ONCE, len(queries)), dtype=np.int32)
            node = roots[q]
            while len(q):
                far = np.bitwise_count(queries[q] ^ self.fps[node])
                hit = far <= radius
                yield q[hit], node[hit]
                edges = far[:, None].astype(np.int16) + around
                down = self.children[node[:, None], np.clip(edges, 0, 64)]
                down[(edges < 0) | (edges > 64)] = -1
                which = np.nonzero(down >= 0)
                q, node = q[which[0]], down[which]


def join_sets(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Disjoint sets as pointers to the least member, with the sets of a[i] and b[i] joined."""
    a, b = roots[a], roots[b]
    while len(a):
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while (roots[roots] != roots).any():
            roots = roots[roots]
        a, b = roots[a], roots[b]
        a, b = a[a != b], b[a != b]
    return roots


def stars(rows: np.ndarray, radius: int) -> np.ndarray:
    """Rows (shard number, fingerprint, in the tree, asks) -> links (fingerprint, least of its local component).

    Links are joined as they are found and not kept, so a dense shard costs no memory.
    """
    values, index = np.unique(rows[:, 1], return_inverse=True)
    in_tree, asks = rows[:, 2] == 1, rows[:, 3] == 1
    forest = Forest(rows[in_tree, 1].view(np.uint64), rows[in_tree, 0])
    asks &= np.isin(rows[:, 0], rows[in_tree, 0])
    start = np.array([forest.root_of[s] for s in rows[asks, 0].tolist()], np.int32)
    members, askers, roots = index[in_tree], index[asks], np.arange(len(values))
    for q, m in forest.search(rows[asks, 1].view(np.uint64), start, radius):
        a, b = askers[q], members[m]
        roots = join_sets(roots, a[a != b], b[a != b])
    linked = roots != np.arange(len(values))
    return np.column_stack([values[linked], values[roots[linked]]])


def links(nodes: DataFrame, radius: int, shard: int) -> DataFrame:
    """(a, b) fingerprints whose connected components are those of all links within the radius."""
    keyed = nodes.select("fp", F.explode(block_keys(F.col("fp"), radius)).alias("key"))
    shared = keyed.groupBy("key").count().where("count > 1")
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    placed = (
        keyed.join(shared, "key")
        .withColumn("parts", F.ceil(F.col("count") / shard))
        .withColumn("part", part)
        # the trees of part i meet the queries of every part j >= i
        .select("fp", "key", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
        .select(
            "fp", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            (F.col("part") <= F.col("other")).cast("long").alias("tree"), (F.col("part") >= F.col("other")).cast("long").alias("asks"),
        )
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows not yet searched; the last shard may go on in the next batch
        number, last = 0, None

        def search(rows: np.ndarray) -> pa.RecordBatch:
            found = stars(rows, radius)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        for batch in batches:
            fp, blocks, bits, i, j, tree, asks = (c.to_numpy() for c in batch.columns)
            group = np.column_stack([blocks, bits, i, j])
            if not len(group):
                continue
            new = np.concatenate([[last is None or (group[0] != last).any()], (group[1:] != group[:-1]).any(axis=1)])
            numbers = number + np.cumsum(new)
            number, last = int(numbers[-1]), group[-1]
            held.append(np.column_stack([numbers, fp, tree, asks]))
            if sum(map(len, held)) >= ROWS_AT_ONCE:
                rows = np.concatenate(held)
                whole = rows[:, 0] != number
                held = [rows[~whole]]
                for start in cuts(rows[whole]):
                    yield search(start)
        if held:
            for start in cuts(np.concatenate(held)):
                yield search(start)

    ordered = placed.select("fp", F.col("key.blocks").cast("long").alias("blocks"), "key.bits", "i", "j", "tree", "asks")
    return (
        ordered.repartition("blocks", "bits", "i", "j")
        .sortWithinPartitions("blocks", "bits", "i", "j", "fp")
        .mapInArrow(find, "a long, b long")
        .distinct()
    )


def cuts(rows: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of about ROWS_AT_ONCE rows that end where a shard ends."""
    start = 0
    while start < len(rows):
        end = start + ROWS_AT_ONCE
        if end < len(rows):
            end = int(np.searchsorted(rows[:, 0], rows[end, 0], "right"))
        yield rows[start:end]
        start = end


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); equal roots: connected."""
    edges = reliable(edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b")))  # one to one on longs
    both = edges.select("a", "b").union(edges.select("b", "a"))
    known = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = reliable(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).select("node", F.least("node", "to").alias("to")))
        if known is None:
            known = points.select("node", F.col("to").alias("root"))
        else:
            moved = points.select(F.col("node").alias("root"), "to")
            known = known.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        known = reliable(known)
        left = points.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        pairs = edges.join(left, "a").join(right, "b").where("x != y")
        edges = reliable(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return known if known is not None else both.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2, shard: int = 2000
) -> DataFrame:
    """One row per row of ``df``: key, ``text_hash`` (xxhash64 of the text), ``fp``,
    ``component`` (smallest key reachable) and ``stays`` (true for the row, by key
    then text hash, that represents its component; equal rows share it).

    Defined cases: a null text counts as empty; texts without words have the
    fingerprint 0 and are linked like any other; null keys come last, and a
    component of null keys has a null id; an empty table gives no rows; texts
    are read whole; other columns of ``df`` are not used.
    """
    hashed = df.select(F.col(key).alias("_key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("_text"))
    docs = reliable(fingerprints(hashed, "_text", shingle, ["_key", "text_hash"]))
    row = F.struct(F.col("_key").isNull().alias("none"), "_key", "text_hash")
    nodes = reliable(docs.groupBy("fp").agg(F.min(row).alias("first")))
    found = components(links(nodes, radius, shard))
    rooted = nodes.withColumn("node", F.xxhash64("fp")).join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    labels = rooted.select("fp", "root").join(least, "root").select("fp", "first")
    return docs.join(labels, "fp").select(
        F.col("_key").alias(key), "text_hash", "fp", F.col("first._key").alias("component"), (row == F.col("first")).alias("stays")
    )


def keep_representatives(df: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with one row of every near-duplicate class, columns unchanged.

    Of equal rows one stays. Only those take part in the second shuffle, which
    tells them apart; the others are joined once.
    """
    mark, of, repeats = free_name(df, "_hash"), free_name(df, "_of"), free_name(df, "_repeats")
    keepers = (
        near_duplicates(df, key, text, **options).where("stays")
        .groupBy(F.col(key).alias(of), F.col("text_hash").alias(mark + "_of")).agg(F.count(F.lit(1)).alias(repeats))
    )
    rows = df.withColumn(mark, F.xxhash64(text))
    same = rows[key].eqNullSafe(keepers[of]) & (rows[mark] == keepers[mark + "_of"])
    kept = rows.join(keepers, same)
    once = kept.where(F.col(repeats) == 1).select(*df.columns)
    return once.unionByName(kept.where(F.col(repeats) > 1).dropDuplicates([key, mark]).select(*df.columns))


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id")
    )
