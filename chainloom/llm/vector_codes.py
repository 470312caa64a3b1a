"""Product codes for vectors: every sixteenth of a vector becomes the number of its nearest codebook entry.

Codebooks are fitted by Lloyd rounds with Yinyang bounds. The entries of a codebook are clustered into
groups once. For each part of a vector the table keeps its entry and, for each group, a lower bound of
the distance to any other entry there. After an update a bound falls by the group's greatest drift;
only groups whose bound no longer exceeds the distance to the part's own entry are scanned. Scans
compare integer squares, so ties go to the lower index exactly; bounds are rounded down and only ever
say where no scan is needed.

A round is one pass over the rows. Each task adds up its parts by entry, so a codebook's update moves
no more than one row an entry and component from a task, and the driver holds the codebooks alone
(64 entries a part, whatever the table's size). Rows and bounds lie in the checkpoint folder between passes.

Defined cases: vectors that are null, or hold null or non-finite components, are dropped, and so are
those that cannot be cut into equal parts (no component, or a length that 16 does not divide). Vectors of
different lengths have codebooks and label sums of their own, length by length (16 lengths at most).
Fewer than 64 vectors: as many entries. Among equal ids the start takes the smaller vector first, null
ids last; repeated rows are coded alike and each counts. Null labels are summed together. Extra columns
are ignored. A component beyond 2^28 after scaling raises an error, as squares then leave 64 bits. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .topk import usable

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 28


def integers(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """vec_id, label, x: the components floor(scale * c) of vectors that can be cut into parts."""
    kept = vectors.where(usable(F.col("embedding")) & (F.size("embedding") % parts == 0))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("x"))


def grouped(book: np.ndarray, groups: int, rounds: int = 5) -> np.ndarray:
    """The group of each entry, by a few plain Lloyd rounds over the entries themselves. Any grouping gives right results."""
    centre = book[np.linspace(0, len(book) - 1, groups).astype(int)].astype(float)
    for _ in range(rounds):
        near = ((book[:, None, :] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
        centre = np.array([book[near == g].mean(axis=0) if (near == g).any() else centre[g] for g in range(groups)])
    return near


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries, exact: every value is an integer that ``x``'s type holds."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)[None]


def nearest(x: np.ndarray, book: np.ndarray, group: np.ndarray, own: np.ndarray | None, bound: np.ndarray | None, drift: np.ndarray | None):
    """(entry, its squared distance, lower bounds by group) of one part of many rows.

    ``own`` and ``bound`` are those of the codebook before, ``drift`` how far each of its entries went; None: scan all."""
    n, groups = len(x), int(group.max()) + 1
    if own is None:
        best, at = np.full(n, np.iinfo(np.int64).max if x.dtype == np.int64 else np.inf, x.dtype), np.full(n, len(book))
        lower, radius = np.full((n, groups), -np.inf), None
    else:
        at = own.astype(np.int64)
        best = ((x - book[at]) ** 2).sum(axis=1)
        lower = bound - np.array([drift[group == g].max(initial=0.0) for g in range(groups)])[None]
        radius = np.sqrt(best.astype(float)) * (1 + 1e-12)
    start, start_square = at.copy(), best.copy()
    leaders, scanned = {}, {}
    for g in range(groups):
        members = np.flatnonzero(group == g)
        rows = np.arange(n) if radius is None else np.flatnonzero(lower[:, g] <= radius)
        if not len(members) or not len(rows):
            continue
        d = squares(x[rows], book[members]).astype(float if x.dtype != np.int64 else np.int64)
        far = np.inf if d.dtype != np.int64 else np.iinfo(np.int64).max
        d[members[None] == start[rows][:, None]] = far  # a part's own entry is no rival
        first = d.argmin(axis=1)
        least = d[np.arange(len(rows)), first]
        d[np.arange(len(rows)), first] = far
        leaders[g], scanned[g] = (members[first], least, d.min(axis=1)), rows
        better = (least < best[rows]) | ((least == best[rows]) & (members[first] < at[rows]))
        best[rows[better]], at[rows[better]] = least[better], members[first][better]
    root = lambda v: np.sqrt(v.astype(float))
    for g, (leader, least, second) in leaders.items():
        rows = scanned[g]
        lower[rows, g] = root(np.where(leader == at[rows], second, least))
    moved = np.flatnonzero((at != start) & (start < len(book)))
    home = group[start[moved]]
    lower[moved, home] = np.minimum(lower[moved, home], root(start_square[moved]))
    return at.astype(np.uint8), best, np.nextafter(lower.astype(np.float32), np.float32(-np.inf))


def assign(rows: DataFrame, books: np.ndarray, groups: np.ndarray, drift: np.ndarray | None) -> DataFrame:
    """``rows`` (vec_id, label, x, and after the first time codes and bounds) with codes, bounds and error of ``books`` (part, entry, component)."""
    parts, entries, width = books.shape
    kind = np.float64 if width * (2 * max(int(np.abs(books).max()), 1)) ** 2 < 1 << 51 else np.int64
    label = rows.schema["label"].dataType.simpleString()
    count = groups.max(axis=1) + 1
    to = np.concatenate([[0], np.cumsum(count)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(n, parts, width)
            most = int(max(x.max(), -x.min()))
            if most > LARGEST:
                raise ValueError(f"component {most} is larger than {LARGEST}")
            use = np.float64 if kind == np.float64 and width * (2 * most) ** 2 < 1 << 51 else np.int64
            x, of = x.astype(use), books.astype(use)
            if drift is not None:
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(n, parts)
                bounds = np.frombuffer(b"".join(batch.column("bounds").to_pylist()), np.float32).reshape(n, to[-1])
            new, low, error = np.empty((n, parts), np.uint8), np.empty((n, to[-1]), np.float32), np.zeros(n, np.int64)
            for p in range(parts):
                old = (None, None, None) if drift is None else (codes[:, p], bounds[:, to[p] : to[p + 1]], drift[p])
                new[:, p], best, low[:, to[p] : to[p + 1]] = nearest(np.ascontiguousarray(x[:, p]), of[p], groups[p], *old)
                error += best.astype(np.int64)
            blobs = lambda a: pa.array([r.tobytes() for r in a], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("x"), blobs(new), blobs(low), pa.array(error)], names=["vec_id", "label", "x", "codes", "bounds", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {label}, x array<long>, codes binary, bounds binary, error long")


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """``books`` with each used entry at the floor of its parts' mean. A task sends one row an entry and component that it has."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy().reshape(-1, width)
            at = (np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, parts) + entries * np.arange(parts)).ravel()
            order = np.argsort(at, kind="stable")
            used, starts, times = np.unique(at[order], return_index=True, return_counts=True)
            total[used] += np.add.reduceat(x[order], starts, axis=0)
            n[used] += times
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))), pa.array(np.repeat(n[used], width)), pa.array(total[used].ravel())], names=["entry", "at", "n", "s"])

    sums = rows.select("x", "codes").mapInArrow(run, "entry long, at long, n long, s long").groupBy("entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    new = books.reshape(parts * entries, width).copy()
    for r in sums.collect():  # parts * entries * width rows at most
        new[r["entry"], r["at"]] = r["s"] // r["n"]
    return new.reshape(books.shape)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``rows`` (vec_id, label, x of one length) with their codes and errors, and the codebooks: (part, entry, component)."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    if np.abs(books).max() > LARGEST:
        raise ValueError(f"a component is larger than {LARGEST}")
    groups = np.stack([grouped(b, max(1, len(first) // 10)) for b in books])
    state, drift = rows, None
    for _ in range(rounds):
        state = cut(assign(state, books, groups, drift))
        new = moved(state, books)
        drift = np.sqrt(((new - books).astype(float) ** 2).sum(axis=2)) * (1 + 1e-12)
        books = new
    return assign(state, books, groups, drift), books


def with_label_error(coded: DataFrame, most: int = 100_000, salts: int = 64) -> DataFrame:
    """``coded`` (label, error, vec_id, ...) with ``label_error``, the error summed over equal labels.

    Up to ``most`` sums are broadcast. More are joined: rows of a label are dealt to ``salts`` keys, so none is hot."""
    sums = cut(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    if sums.count() <= most:
        return coded.join(F.broadcast(sums.withColumnRenamed("label", "_label")), F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
    dealt = sums.withColumnRenamed("label", "_label").withColumn("_to", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    return rows.join(dealt, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_to"))).drop("_salt", "_label", "_to")


def codes(vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code (hex), error, label_error, codebooks_sha256."""
    rows = integers(vectors, scale, parts)
    lengths = [r[0] for r in rows.select(F.size("x")).distinct().limit(17).collect()]
    if len(lengths) > 16:
        raise ValueError("vectors of more than 16 lengths")
    label = rows.schema["label"].dataType.simpleString()
    out = []
    for length in sorted(lengths):
        coded, books = fit(rows.where(F.size("x") == length), parts, entries, rounds)
        coded = cut(coded.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error"))
        digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
        out.append(with_label_error(coded).withColumn("codebooks_sha256", F.lit(digest)))
    return reduce(DataFrame.unionByName, out) if out else rows.sparkSession.createDataFrame([], f"vec_id long, label {label}, code string, error long, label_error long, codebooks_sha256 string")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _round(k: int) -> str:
    """SQL of one round: the nearest entry of each part, then the entries' means."""
    return f"""a{k} AS MATERIALIZED (
  SELECT r, part, min_by(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT r, part, entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p JOIN b{k} b USING (part)) GROUP BY r, part
), m{k} AS MATERIALIZED (
  SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY pos) AS x FROM (
    SELECT part, entry, pos, sum(x[pos]) AS s, count(*) AS n FROM a{k} JOIN p USING (r, part), (SELECT unnest(range(1, w + 1)) AS pos FROM (SELECT max(len(x)) AS w FROM p)) GROUP BY part, entry, pos) GROUP BY part, entry
), b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (part, entry))"""


ORACLE = f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * 256) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(embedding) % 16 = 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), p AS MATERIALIZED (
  SELECT r, part, x[part * (len(x) // 16) + 1 : (part + 1) * (len(x) // 16)] AS x FROM v, (SELECT unnest(range(16)) AS part)
), b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM p WHERE r <= 64),
{_round(0)},
{_round(1)},
{_round(2)},
c AS (SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c JOIN v USING (r), h"""
