"""Exact top-k inner-product search by MaxScore.

Dimensions are terms: a vector's posting in a dimension is its integer component, and a query's
weight there its own. In a shard, the most that a term can add is known from the least and the
greatest component. Terms whose bounds together cannot lift a row over the k-th best score so
far are non-essential: rows are scored by the essential terms alone, and only those that stay
competitive are probed in the others, some at a time. Shards' results are merged by rank.

Rows are dealt by a hash into shards of about ``shard_rows``, packed as blobs; queries into blocks
of about ``block_rows``. First every query meets one shard, whose k-th best score is its threshold
everywhere. Then a task holds the queries of a tile (``tile_blocks`` blocks) while a tile's shards
(``tile_shards``) pass by one after the other, and carries each query's threshold from one to the
next. So a row is copied once for 32,768 queries, and a task emits k rows a query at most; the
number of tasks is that of pairs of tiles, about 3 * 10 ** 10 scores each.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no part,
neither as queries nor as rows. A row counts only for queries of its own dimension. Ties go to the
smaller id. Equal ids: a query never meets rows that carry its id; repeated rows are kept apart.
Fewer than k rows: all. Components of any size are multiplied exactly; only a score among a query's
best that does not fit 64 bits raises an error. Extra columns are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def integers(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and the components floor(scale * x), x as double."""
    kept = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


def _packed(rows: DataFrame, parts: int, name: str) -> DataFrame:
    """One row a part and dimension: ids and components."""
    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias(name)
    packed = rows.groupBy(part, F.size("v").alias("dim")).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
    return packed.select(name, "dim", F.transform("rows", lambda r: r["vec_id"]).alias(f"{name}_ids"), F.flatten(F.transform("rows", lambda r: r["v"])).alias(f"{name}_v"))


def shard_best(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: list, step: int = 8) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query (its place) its k best rows of one shard and their scores, but none below its floor (None: it has none).

    Components are small enough for doubles to hold every sum exactly; larger ones go by Python's integers.
    """
    largest = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    most = largest(rows) * largest(queries) * rows.shape[1]
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order].astype(kind)
    by_term = np.ascontiguousarray(rows.T)
    low, high = rows.min(axis=0), rows.max(axis=0)
    for i, (qid, q) in enumerate(zip(query_ids, queries.astype(kind))):
        top, least = np.maximum(q * low, q * high), np.minimum(q * low, q * high)
        terms = np.argsort(least - top, kind="stable")  # widest range first
        rest = np.concatenate([np.cumsum(top[terms][::-1])[::-1], np.zeros(1, kind)])  # the most that terms from here on add
        limit = floors[i]
        if limit is not None and rest[0] < limit:
            continue
        alive = np.flatnonzero(ids != qid)
        # A threshold of the shard's own: the k-th best of a few rows scored in full.
        seeds = rows[alive[: 4 * k]] @ q
        if len(seeds) >= k:
            own = np.sort(seeds)[-k]
            limit = own if limit is None else max(limit, own)
        # Essential: the shortest run of terms after which the others together stay below the threshold. Every row
        # has a posting in each, so these are traversed for all rows; the others are probed for what stays competitive.
        at, score = 0, np.zeros(len(alive), kind)
        below = np.flatnonzero(rest[1:] < limit) if limit is not None else []
        essential = int(below[0]) + 1 if len(below) else step
        while at < len(terms) and len(alive):
            to = min(len(terms), at + (step if at else essential))
            part = terms[at:to]
            score = score + (q[part] @ by_term[np.ix_(part, alive)] if len(alive) < len(ids) // 2 else (q[part] @ by_term[part])[alive])
            at = to
            if limit is not None:
                keep = score + rest[at] >= limit
                if not keep.all():
                    alive, score = alive[keep], score[keep]
            step_up = np.minimum.reduce([len(alive), 4 * k])
            if at < len(terms) and len(alive) > step_up >= k:
                # Rows that lead so far are likely to raise the threshold: probe them in full.
                lead = alive[np.argpartition(-score, k - 1)[:k]]
                best = np.min(rows[lead] @ q)
                limit = best if limit is None else max(limit, best)
        if len(alive):
            # ``alive`` runs in order of id, so a stable sort gives ties to the smaller id.
            chosen = np.argsort(-score, kind="stable")[:k]
            yield i, ids[alive[chosen]], score[chosen].astype(np.int64)


def shard_top(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The k best rows of one shard of each query, as (query, row, score) arrays."""
    found = [(np.full(len(r), query_ids[i]), r, s) for i, r, s in shard_best(ids, rows, query_ids, queries, k, [None] * len(queries))]
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))


def _matrix(batch: pa.RecordBatch, i: int, name: str, dim: int | None = None) -> np.ndarray:
    values = batch.column(name)[i].values.to_numpy(zero_copy_only=False)
    return values.reshape(-1, dim) if dim else values


def with_floors(blocks: DataFrame, shard: DataFrame, k: int) -> DataFrame:
    """``blocks`` (of queries) with ``floors``: each query's k-th best score among the rows of one shard, null if they are fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids = batch.column("dim")[i].as_py(), _matrix(batch, i, "block_ids")
                floors = [None] * len(ids)
                if batch.column("shard_ids")[i].is_valid:
                    for at, _, scores in shard_best(_matrix(batch, i, "shard_ids"), _matrix(batch, i, "shard_v", dim), ids, _matrix(batch, i, "block_v", dim), k, floors):
                        if len(scores) == k:
                            floors[at] = int(scores[-1])
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([one.column(c) for c in ("block", "dim", "block_ids", "block_v")] + [pa.array([floors], pa.list_(pa.int64()))], names=["block", "dim", "block_ids", "block_v", "floors"])

    # One shard: about shard_rows rows.
    met = blocks.join(F.broadcast(shard.drop("shard")), "dim", "left").select("block", "dim", "block_ids", "block_v", "shard_ids", "shard_v")
    return met.mapInArrow(run, "block int, dim int, block_ids array<long>, block_v array<long>, floors array<long>")


def tile_top(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows by tile and dimension, blocks of queries before shards: the k best rows of a tile's shards for each of its queries."""
    tile, held, ids, queries, floors, best = None, [], None, None, [], {}

    def found() -> pa.RecordBatch:
        parts = [(np.full(len(r), ids[i]), r, s) for i, (r, s) in best.items()]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([p[j] for p in parts]) if parts else np.zeros(0, np.int64), pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])

    for batch in batches:
        for i in range(batch.num_rows):
            dim = batch.column("dim")[i].as_py()
            here = (batch.column("row_tile")[i].as_py(), batch.column("query_tile")[i].as_py(), dim)
            if here != tile:
                yield found()
                tile, held, ids, best = here, [], None, {}
            if batch.column("kind")[i].as_py() == 0:
                held.append((_matrix(batch, i, "ids").copy(), _matrix(batch, i, "v", dim).copy(), batch.column("floors")[i].as_py() or [None] * len(batch.column("ids")[i])))
                continue
            if not held:
                continue
            if ids is None:
                ids, queries, floors = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), [f for h in held for f in h[2]]
            for at, rows, scores in shard_best(_matrix(batch, i, "ids"), _matrix(batch, i, "v", dim), ids, queries, k, floors):
                if at in best:
                    rows, scores = np.concatenate([best[at][0], rows]), np.concatenate([best[at][1], scores])
                    first = np.lexsort((rows, -scores))[:k]
                    rows, scores = rows[first], scores[first]
                best[at] = rows, scores
                if len(scores) == k and (floors[at] is None or scores[-1] > floors[at]):
                    floors[at] = int(scores[-1])
    yield found()


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10, shard_rows: int = 8192, block_rows: int = 1024, tile_shards: int = 128, tile_blocks: int = 32) -> DataFrame:
    """Both: vec_id, v (arrays of long). Returns query_id, rank, vec_id, score."""
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    query_tiles = -(-blocks // tile_blocks)
    # At least as many tasks as a shuffle has, if there are shards for them.
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_tiles = max(-(-shards // tile_shards), min(shards, -(-width // query_tiles)))
    by_shard, by_block = _packed(rows, shards, "shard"), _packed(queries, blocks, "block")
    none = F.lit(None).cast("array<long>")
    by_block = with_floors(by_block, by_shard.where("shard = 0"), k) if shards > 1 else by_block.withColumn("floors", none)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = by_block.select(F.pmod("block", F.lit(query_tiles)).alias("query_tile"), every(row_tiles).alias("row_tile"), "dim", F.lit(0).alias("kind"), F.col("block_ids").alias("ids"), F.col("block_v").alias("v"), "floors")
    given = by_shard.select(every(query_tiles).alias("query_tile"), F.pmod("shard", F.lit(row_tiles)).alias("row_tile"), "dim", F.lit(1).alias("kind"), F.col("shard_ids").alias("ids"), F.col("shard_v").alias("v"), none.alias("floors"))
    met = asked.unionByName(given).repartition(query_tiles * row_tiles, "query_tile", "row_tile").sortWithinPartitions("query_tile", "row_tile", "dim", "kind")
    merged = met.mapInArrow(lambda batches: tile_top(batches, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = integers(table(spark, sf_dir, "embeddings"))
    return top_k(rows.where(F.col("vec_id") % 100 == 0), rows)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""
