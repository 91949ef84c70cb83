"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are integers; a dimension's positive and negative values are its two
terms. The rows are ordered by the signs of their components (then by id) and
cut into *blocks*, ranges of that order. A block keeps a forward index (the
vectors of its rows) and the maxima of its terms (the greatest and the least
value of each dimension). For a query the sum over its components of component
x matching maximum bounds every score in the block. Blocks are visited by
falling bound, and scored through their forward index, until the bound falls
below the query's k-th score. A query starts with the k-th score inside its own
block, which lies among the rows most like it.

On Spark: blocks are built by one range shuffle and kept in the shared folder.
Consecutive blocks make a *shard* (a bounded number of values), queries make
*chunks*. Every chunk meets every shard once: one shuffle brings a shard's
blocks, then the chunks one after another, to the task that searches it. Beyond
``lane`` queries a shard is searched in several tasks. Each reports at most k
rows a query; a window with a limit by group merges them. Neither a task nor
the driver holds more than a shard, a chunk and one number a partition.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import reliable, table

ROWS_IN_BLOCK = 128
VALUES_IN_SHARD = 1 << 22
QUERIES_IN_CHUNK = 256
QUERIES_IN_LANE = 1 << 17
#: Blocks a query scores between two looks at its k-th score.
BLOCKS_AT_ONCE = 4
LEAST = np.iinfo(np.int64).min


def finite(vector: Column) -> Column:
    """True if the array is there and every entry is a finite number."""
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * c) of every entry c, as double, in longs."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


class Vectors:
    """Equally many integers a row, and the exact inner products of two such tables."""

    def __init__(self, values: np.ndarray):
        self.values = values
        low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
        self.most = max(-low, high)
        self.floats = values.astype(np.float64)

    def products(self, other: Vectors, rows: np.ndarray | slice, cols: np.ndarray | slice) -> np.ndarray:
        if self.most * other.most * max(self.values.shape[1], 1) < 1 << 53:  # exact in doubles
            return (self.floats[rows] @ other.floats[cols].T).astype(np.int64)
        exact = self.values[rows].astype(object) @ other.values[cols].astype(object).T
        return np.clip(exact, LEAST, np.iinfo(np.int64).max).astype(np.int64)


def matrix(lengths: np.ndarray, flat: np.ndarray, dims: int) -> np.ndarray:
    """Rows of different lengths as one table; what a row lacks is zero."""
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows (id, long array) -> one row per block, numbered in the partition."""
    part, number, held = TaskContext.get().partitionId(), itertools.count(), []

    def block(rows: pa.Table) -> pa.RecordBatch:
        vectors = rows.column(1).combine_chunks()
        lengths = vectors.value_lengths().to_numpy()
        dims = int(lengths.max())
        values = matrix(lengths, vectors.flatten().to_numpy(), dims)
        ids = rows.column(0)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.array([next(number)], pa.int64()), pa.array([len(rows)]), pa.array([dims], pa.int32()),
             pa.array([ids.fill_null(0).to_numpy().tobytes()]), pa.array([ids.is_null().to_numpy().tobytes()]),
             pa.array([values.tobytes()])],
            names=["part", "number", "n", "dims", "ids", "no_id", "vectors"],
        )

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS_IN_BLOCK:
            rows = pa.Table.from_batches(held)
            whole = len(rows) - len(rows) % ROWS_IN_BLOCK
            for start in range(0, whole, ROWS_IN_BLOCK):
                yield block(rows.slice(start, ROWS_IN_BLOCK))
            held = rows.slice(whole).to_batches()
    if sum(b.num_rows for b in held):
        yield block(pa.Table.from_batches(held))


def blocks_of(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """Blocks (part, number, n, dims, ids, no_id, vectors) of the rows that have a finite vector."""
    rows = df.where(finite(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), quantised(F.col(vector), scale).alias("x")
    )
    signs = F.concat_ws("", F.transform("x", lambda c: F.when(c < 0, "0").otherwise("1")))
    order = [F.col("signs"), F.col("id"), F.col("x")]
    ordered = rows.withColumn("signs", signs).repartitionByRange(*order).sortWithinPartitions(*order).select("id", "x")
    return reliable(ordered.mapInArrow(
        cut_blocks, "part long, number long, n long, dims int, ids binary, no_id binary, vectors binary"
    ))


class Best:
    """The k best rows so far of each query of a chunk: score falling, rows without an id last, id, row."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.kth = k, floor.copy()
        self.rows = np.empty((0, 5), np.int64)  # query, score, no id, id, row

    def add(self, found: list[np.ndarray]) -> None:
        rows = np.concatenate([self.rows, *found])
        order = np.lexsort((rows[:, 4], rows[:, 3], rows[:, 2], ~rows[:, 1], rows[:, 0]))
        rows = rows[order]
        starts = np.searchsorted(rows[:, 0], rows[:, 0])
        place = np.arange(len(rows)) - starts
        self.rows = rows[place < self.k]
        last = rows[place == self.k - 1]
        self.kth[last[:, 0]] = np.maximum(self.kth[last[:, 0]], last[:, 1])


class Shard:
    """Blocks with their term maxima, searched for a chunk of queries at a time."""

    def __init__(self, dims: int):
        self.dims, self.blocks = dims, []

    def add(self, first: int, ids: bytes, no_id: bytes, vectors: bytes, n: int, dims: int) -> None:
        values = matrix(np.full(n, dims), np.frombuffer(vectors, np.int64), self.dims)
        self.blocks.append((first, np.frombuffer(ids, np.int64), np.frombuffer(no_id, np.bool_), Vectors(values)))

    def bounds(self, queries: Vectors) -> np.ndarray:
        """Of each query and block: the sum of component x the block's matching maximum (or minimum)."""
        high = np.array([b[3].values.max(axis=0) for b in self.blocks])
        low = np.array([b[3].values.min(axis=0) for b in self.blocks])
        terms = np.concatenate([np.maximum(queries.values, 0), np.minimum(queries.values, 0)], axis=1)
        return Vectors(terms).products(Vectors(np.concatenate([high, low], axis=1)), slice(None), slice(None))

    def score(self, queries: Vectors, own: np.ndarray, rows: np.ndarray, block: int, kth: np.ndarray) -> np.ndarray:
        """Rows (query, score, no id, id, row) of a block that reach the k-th scores of the given queries."""
        first, ids, no_id, vectors = self.blocks[block]
        scores = queries.products(vectors, rows, slice(None))
        q, at = np.nonzero((scores >= kth[rows, None]) & (own[rows, None] != first + np.arange(len(ids))))
        return np.column_stack([rows[q], scores[q, at], no_id[at], ids[at], first + at])

    def search(self, queries: Vectors, own: np.ndarray, floor: np.ndarray, k: int) -> np.ndarray:
        best, bounds = Best(floor, k), self.bounds(queries)
        order = np.argsort(-bounds.astype(np.float64), axis=1, kind="stable")
        for start in range(0, len(self.blocks), BLOCKS_AT_ONCE):
            next_ones = order[:, start : start + BLOCKS_AT_ONCE]
            due = np.take_along_axis(bounds, next_ones, axis=1) >= best.kth[:, None]
            rows, at = np.nonzero(due)
            if not len(rows):
                # bounds fall from left to right up to the rounding of the sort key, k-th scores only rise
                if not (np.take_along_axis(bounds, order[:, start:], axis=1) >= best.kth[:, None]).any():
                    break
                continue
            blocks = next_ones[rows, at]
            by_block = np.argsort(blocks, kind="stable")
            rows, blocks = rows[by_block], blocks[by_block]
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            best.add([
                self.score(queries, own, r, int(b[0]), best.kth)
                for r, b in zip(np.split(rows, cuts), np.split(blocks, cuts), strict=True)
            ])
        return best.rows


def queries_in(blocks: DataFrame, every: int, k: int) -> DataFrame:
    """Chunks of the rows whose id ``every`` divides, with their k-th score inside their own block as the floor."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def chunk() -> pa.RecordBatch:
            dims = max(v.shape[1] for _, _, v, _ in held)
            values = np.concatenate([np.pad(v, ((0, 0), (0, dims - v.shape[1]))) for _, _, v, _ in held])
            row, ids, floor = (np.concatenate([h[i] for h in held]).astype(np.int64).tobytes() for i in (0, 1, 3))
            out = pa.RecordBatch.from_arrays(
                [pa.array([len(values)], pa.int64()), pa.array([dims], pa.int32()), pa.array([row]), pa.array([ids]),
                 pa.array([floor]), pa.array([values.tobytes()])],
                names=["n", "dims", "rows", "ids", "floor", "vectors"],
            )
            held.clear()
            return out

        for batch in batches:
            for r in batch.to_pylist():
                ids, no_id = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["no_id"], np.bool_)
                asks = np.flatnonzero((ids % every == 0) & ~no_id)
                if not len(asks):
                    continue
                vectors = Vectors(np.frombuffer(r["vectors"], np.int64).reshape(r["n"], r["dims"]))
                floor = np.full(len(asks), LEAST)
                if r["n"] > k:
                    scores = vectors.products(vectors, asks, slice(None))
                    scores[np.arange(len(asks)), asks] = LEAST  # not the query's own row
                    floor = np.sort(scores, axis=1)[:, -k]
                held.append((r["first"] + asks, ids[asks], vectors.values[asks], floor))
                if sum(len(h[0]) for h in held) >= QUERIES_IN_CHUNK:
                    yield chunk()
        if held:
            yield chunk()

    return blocks.select("first", "n", "dims", "ids", "no_id", "vectors").mapInArrow(
        pick, "n long, dims int, rows binary, ids binary, floor binary, vectors binary"
    )


def top_k(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, scale: int = 1024,
    lane: int = QUERIES_IN_LANE,
) -> DataFrame:
    """Each query's k best rows by integer inner product: query_id, rank (from 1), key, score.

    Components count as floor(scale * component). Queries are the rows whose
    key ``every`` divides; candidates are all rows but the query's own. Ties go
    to the smaller key, then to the earlier row of the block order.

    Defined cases: rows whose vector is null or holds a null, NaN or infinite
    component take no part; a null key is no query, but a candidate that comes
    last among ties and is returned with a null id; a key that occurs twice is
    two rows (each may be the other's candidate, and as queries each has its
    own ranks); components that a shorter vector lacks are zero, an empty
    vector scores 0; products beyond a long's range are cut to it; an empty
    table gives no rows; other columns are not used.
    """
    spark = df.sparkSession
    blocks = blocks_of(df, key, vector, scale)
    # one row a partition of the range shuffle, a setting that does not grow with the rows
    parts = blocks.groupBy("part").agg(F.count("*").alias("blocks"), F.max("dims").alias("dims")).orderBy("part").collect()
    dims = max([r["dims"] for r in parts], default=0)
    in_shard = max(1, VALUES_IN_SHARD // (ROWS_IN_BLOCK * max(dims, 1)))
    shards_in = [math.ceil(r["blocks"] / in_shard) for r in parts]
    starts = [0, *itertools.accumulate(shards_in)]
    n_shards = starts[-1]
    offsets = spark.createDataFrame(
        [(r["part"], s) for r, s in zip(parts, starts, strict=False)], "part long, shard_offset long"
    )
    shard = F.col("shard_offset") + F.floor(F.col("number") / in_shard)
    # rows are numbered by shard, block in the shard and place in the block
    first = (shard * in_shard + F.col("number") % in_shard) * ROWS_IN_BLOCK
    placed = blocks.join(F.broadcast(offsets), "part").select("*", shard.alias("shard"), first.alias("first"))
    chunks = reliable(queries_in(placed, every, k).withColumn("chunk", F.monotonically_increasing_id()))
    n_queries = chunks.agg(F.sum("n")).head()[0] or 0
    lanes = max(1, math.ceil(n_queries / lane))

    def at(column: str, kind: str) -> Column:
        return F.lit(None).cast(kind).alias(column)

    kept = placed.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.col("first").alias("at"), F.lit(0).alias("asks"),
        "n", "dims", "ids", "no_id", "vectors", at("floor", "binary"), at("rows", "binary"),
    )
    asked = chunks.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_shards - 1, 0)).cast("long"))).alias("shard"),
        F.pmod(F.xxhash64("chunk"), F.lit(lanes)).cast("int").alias("lane"), F.col("chunk").alias("at"), F.lit(1).alias("asks"),
        "n", "dims", "ids", at("no_id", "binary"), "vectors", "floor", "rows",
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, Shard(dims)
        for batch in batches:
            for r in batch.to_pylist():
                if (r["shard"], r["lane"]) != now:
                    now, shard = (r["shard"], r["lane"]), Shard(dims)
                if not r["asks"]:
                    shard.add(r["at"], r["ids"], r["no_id"], r["vectors"], r["n"], r["dims"])
                    continue
                if not shard.blocks:
                    continue
                values = matrix(np.full(r["n"], r["dims"]), np.frombuffer(r["vectors"], np.int64), dims)
                own, ids, floor = (np.frombuffer(r[c], np.int64) for c in ("rows", "ids", "floor"))
                found = shard.search(Vectors(values), own, floor, k)
                q, score, no_id, vec, row = found.T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[q]), pa.array(ids[q]), pa.array(score), pa.array(vec, mask=no_id == 1), pa.array(row)],
                    names=["asker", "query_id", "score", "id", "row"],
                )

    met = kept.unionByName(asked).repartition("shard", "lane").sortWithinPartitions("shard", "lane", "asks", "at")
    found = met.mapInArrow(search, "asker long, query_id long, score long, id long, row long")
    best = Window.partitionBy("asker").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(key), "score")
    )


def op11_topk(spark, sf_dir: str) -> DataFrame:
    """The 10 best rows of every embedding whose id 100 divides."""
    return top_k(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH rows AS (
    SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM rows q JOIN rows c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 10
"""
