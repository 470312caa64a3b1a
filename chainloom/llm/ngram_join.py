"""N-gram Jaccard join by signature trees.

Documents are sets of hashed word shingles; equal sets form a class, and classes are compared once.

Blocks. Sets are ordered by hash, very frequent shingles last. Sets as similar as the threshold
share one of the first n - ceil(t n) + 1 shingles, so the classes with a shingle among these form
a block. Blocks of one class, and blocks that hold the same classes as another, go.

Trees. In a block, a class has a bitmap of its shingles. A tree over the block's classes holds in
each node the OR of the bitmaps below, the range of set sizes, and the largest number of shingles
that collide in a bitmap. Pairs of nodes are traversed together: a pair is pruned when its sizes
are too far apart, or the overlap cannot reach the threshold (colliding shingles plus common bits),
or all below is already one component. Pairs of classes are bounded by bits of one missing in the other.

Two rounds. First each block emits a spanning forest of the pairs whose estimated similarity
passes; exact verification makes links of them. Then blocks that still hold more than one component
are searched for pairs across components that the bounds allow. A group with few of them emits
them; in a group with many, where classes lie close to the threshold, the sets themselves are
brought together and only links that join two components leave the task. So a group of thousands
of near copies costs rows by its number of members, and yet no link between components is lost.

A shingle of more than ``chunk`` classes, known from the counts before, is dealt into chunks by hash
from the start. The first round works inside chunks, dealt differently for each shingle. The second
keeps the members of a block's largest component apart: its chunks meet those of the others, never
each other, so a block of one component and some strays costs a copy of it for each chunk of strays.

Defined cases: null, empty or blank text has no shingles, n_shingles 0, and is its own component;
fewer words than a shingle make one of all of them. Repeated rows and ids are judged row by row;
a null doc_id never becomes a component's id unless it stands alone, but its text links others.
Extra columns are ignored. An empty table gives no rows. Very long texts are hashed in parts and
compared whole. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table, utf8
from .components import components
from .shingles import mixed, shingle_sets


@dataclass(frozen=True)
class JoinConf:
    """``percent``: least similarity, as a percentage. ``hot_shingles``: how many of the most frequent
    shingles go last in the order, which is a matter of speed alone. ``bits``: bits of a bitmap a shingle,
    ``width``: of any bitmap at least. ``dense``: pairs a member from which a group is verified by sets in one task."""

    percent: int = 80
    words: int = 5
    hot_shingles: int = 20_000
    hot_count: int = 16
    bits: int = 2
    width: int = 4096
    leaf: int = 64
    fan: int = 8
    chunk: int = 1024
    margin: float = 0.01
    dense: int = 4


def class_of(shingles: np.ndarray) -> int:
    """One 64-bit name for a set, whatever its order."""
    with np.errstate(over="ignore"):
        both = np.array([np.add.reduce(mixed(shingles)), np.bitwise_xor.reduce(shingles), len(shingles)], np.uint64)
        return int(np.add.reduce(mixed(both * np.array([3, 5, 7], np.uint64))).astype(np.int64))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def documents_and_counts(docs: DataFrame, conf: JoinConf, least: int = 4) -> DataFrame:
    """Rows of two kinds: a document (kind 0: doc_id, class, size) or a shingle that ``least`` classes of a
    task have (kind 1: shingle in ``class``, number in ``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, seen = ["kind", "doc_id", "cid", "n"], set()
        for batch in batches:
            cids, sizes, sets, held = [], [], [], 0

            def frequent() -> pa.RecordBatch:
                values, n = np.unique(np.concatenate(sets), return_counts=True)  # noqa: B023
                values, n = values[n >= least], n[n >= least].astype(np.int64)
                return pa.RecordBatch.from_arrays([pa.array(np.ones(len(n), np.int32)), pa.nulls(len(n), pa.int64()), _signed(values), pa.array(n)], names=names)

            for s in shingle_sets([t.lower() for t in batch.column("text").to_pylist()], conf.words):
                cids.append(class_of(s) if len(s) else None)
                sizes.append(len(s))
                if len(s) and cids[-1] not in seen:
                    seen.add(cids[-1])
                    sets.append(s)
                    held += len(s)
                    if held > 1 << 22:
                        yield frequent()
                        sets, held = [], 0
            if sets:
                yield frequent()
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(cids), np.int32)), batch.column("doc_id").cast(pa.int64()), pa.array(cids, pa.int64()), pa.array(sizes, pa.int64())], names=names)

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, "kind int, doc_id long, cid long, n long")


def bitmap(shingles: np.ndarray, bits: int, width: int = 4096) -> bytes:
    while width < bits * len(shingles):
        width *= 2
    out = np.zeros(width // 8, np.uint8)
    at = (shingles >> np.uint64(7)) & np.uint64(width - 1)
    np.bitwise_or.at(out, (at >> np.uint64(3)).astype(np.int64), np.left_shift(1, (at & np.uint64(7)).astype(np.int64)).astype(np.uint8))
    return out.tobytes()


def bitmaps(docs: DataFrame, conf: JoinConf) -> DataFrame:
    """cid, bits: one row a class and task that meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            rows = {}
            for s in shingle_sets([t.lower() for t in batch.column("text").to_pylist()], conf.words):
                if len(s) and (cid := class_of(s)) not in seen:
                    seen.add(cid)
                    rows[cid] = bitmap(s, conf.bits, conf.width)
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int64()), pa.array(list(rows.values()), pa.binary())], names=["cid", "bits"])

    return docs.select(utf8().alias("text")).mapInArrow(run, "cid long, bits binary")


def prefixes(docs: DataFrame, hot: np.ndarray, conf: JoinConf) -> DataFrame:
    """Classes with their prefix shingles: one row a class and task that meets it."""
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(hot))  # hot_shingles numbers at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, seen = shared.value, set()
        for batch in batches:
            rows = []
            for s in shingle_sets([t.lower() for t in batch.column("text").to_pylist()], conf.words):
                if not len(s) or (cid := class_of(s)) in seen:
                    continue
                seen.add(cid)
                n = len(s)
                at = np.minimum(np.searchsorted(hot, s), max(0, len(hot) - 1))
                last = hot[at] == s if len(hot) else np.zeros(n, bool)
                prefix = n - -(-conf.percent * n // 100) + 1
                rows.append((cid, n, np.concatenate([s[~last], s[last]])[:prefix].view(np.int64)))
            cids, sizes, keys = zip(*rows) if rows else ((), (), ())
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*keys, np.zeros(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array(sizes, pa.int64()), lists], names=["cid", "n", "keys"])

    return docs.select(utf8().alias("text")).mapInArrow(run, "cid long, n long, keys array<long>")


class Tree:
    """Classes of one bitmap width as leaves of ``leaf`` members, and nodes of ``fan`` children above them."""

    def __init__(self, n: np.ndarray, comp: np.ndarray, bits: np.ndarray, leaf: int, fan: int) -> None:
        self.n, self.bits, self.leaf, self.fan = n, bits, leaf, fan
        self.pop = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        starts = np.arange(0, len(n), leaf)
        level = (np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts), np.maximum.reduceat(n - self.pop, starts), np.bitwise_or.reduceat(bits, starts, axis=0), np.minimum.reduceat(comp, starts), np.maximum.reduceat(comp, starts))
        self.levels = [level]
        while len(level[0]) > 1:
            starts = np.arange(0, len(level[0]), fan)
            least, most, either = np.minimum.reduceat, np.maximum.reduceat, np.bitwise_or.reduceat
            level = (least(level[0], starts), most(level[1], starts), most(level[2], starts), either(level[3], starts, axis=0), least(level[4], starts), most(level[5], starts))
            self.levels.append(level)


def node_pairs(x: Tree, y: Tree, percent: int) -> np.ndarray:
    """Pairs of leaves that can hold a pair of similar classes: dual traversal from the roots."""
    same = x is y
    i, j = len(x.levels) - 1, len(y.levels) - 1
    pairs = np.array([[0, 0]])
    while True:
        a, b = x.levels[i], y.levels[j]
        p, q = pairs.T
        close = (100 * a[1][p] >= percent * b[0][q]) & (100 * b[1][q] >= percent * a[0][p])
        close &= ~((a[4][p] == a[5][p]) & (b[4][q] == b[5][q]) & (a[4][p] == b[4][q]))  # one component already
        pairs = pairs[close]
        kept = []
        for s in range(0, len(pairs), 4096):
            p, q = pairs[s : s + 4096].T
            common = np.bitwise_count(a[3][p] & b[3][q]).sum(axis=1).astype(np.int64)
            most = np.minimum(np.minimum(a[2][p] + common, b[2][q] + common), np.minimum(a[1][p], b[1][q]))
            kept.append(pairs[s : s + 4096][(100 + percent) * most >= percent * (a[0][p] + b[0][q])])
        pairs = np.concatenate(kept) if kept else pairs
        if not len(pairs) or (i == 0 and j == 0):
            return pairs
        down_x, down_y = i > 0 and (i >= j or same), j > 0 and (j >= i or same)
        p, q = pairs.T
        if down_x:
            i -= 1
            p = (p[:, None] * x.fan + np.arange(x.fan)).repeat(1, axis=1)
            q = np.broadcast_to(q[:, None], p.shape)
            ok = p < len(x.levels[i][0])
            p, q = p[ok], q[ok]
        if down_y:
            j -= 1
            q = q[:, None] * y.fan + np.arange(y.fan)
            p = np.broadcast_to(p[:, None], q.shape)
            ok = q < len(y.levels[j][0])
            p, q = p[ok], q[ok]
        pairs = np.stack([p, q], axis=1)
        if same:
            pairs = pairs[pairs[:, 0] <= pairs[:, 1]]


def block_pairs(cid: np.ndarray, n: np.ndarray, comp: np.ndarray, maps: list[bytes], side: np.ndarray | None, conf: JoinConf, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block, as class names. ``side``: pairs must lie across its two values (chunks).
    ``forest``: only enough probable pairs to connect what is probably linked."""
    percent = conf.percent
    label = np.unique(comp, return_inverse=True)[1] if not forest else np.arange(len(cid))
    out: list[tuple[int, int]] = []
    width = np.array([len(m) for m in maps])
    whole = {w: np.frombuffer(b"".join(maps[i] for i in np.flatnonzero(width == w)), np.uint64).reshape(-1, w // 8) for w in np.unique(width)}
    for w in sorted(whole):
        mine = np.flatnonzero(width == w)
        x = Tree(n[mine], label[mine], whole[w], conf.leaf, conf.fan)
        others = [(mine, x)]
        if 2 * w in whole:
            # Similar sets differ in width by one doubling at most; folding halves keeps every bit's meaning.
            wide, more = whole[2 * w], np.flatnonzero(width == 2 * w)
            others.append((more, Tree(n[more], label[more], wide[:, : w // 8] | wide[:, w // 8 :], conf.leaf, conf.fan)))
        for theirs, y in others:
            for p, q in node_pairs(x, y, percent):
                i, j = mine[p * conf.leaf : (p + 1) * conf.leaf], theirs[q * conf.leaf : (q + 1) * conf.leaf]
                apart = label[i][:, None] != label[j][None, :]
                if side is not None:
                    apart &= side[i][:, None] != side[j][None, :]
                if x is y and p == q:
                    apart &= np.arange(len(i))[:, None] < np.arange(len(j))[None, :]
                r, c = np.nonzero(apart)
                na, nb = n[i][r], n[j][c]
                ok = (100 * na >= percent * nb) & (100 * nb >= percent * na)
                r, c, na, nb = r[ok], c[ok], na[ok], nb[ok]
                if not len(r):
                    continue
                a, b = x.bits[p * conf.leaf + r], y.bits[q * conf.leaf + c]
                common = np.bitwise_count(a & b).sum(axis=1).astype(np.int64)
                pa_, pb = x.pop[p * conf.leaf + r], y.pop[q * conf.leaf + c]
                # Bits that only one has are shingles that the other lacks.
                most = np.minimum(na - (pa_ - common), nb - (pb - common))
                ok = (100 + percent) * most >= percent * (na + nb)
                if forest:
                    free = 1 - np.maximum(pa_, pb) / (8 * w)  # of what one lacks, the share not hidden by collisions
                    overlap = np.minimum(na - (pa_ - common) / free.clip(0.05), nb - (pb - common) / free.clip(0.05))
                    ok &= (100 + percent) * overlap >= (percent - 100 * conf.margin) * (na + nb)
                r, c = i[r[ok]], j[c[ok]]
                if not forest:
                    out += zip(r.tolist(), c.tolist())
                    continue
                while len(r):
                    out.append((int(r[0]), int(c[0])))
                    label[label == label[c[0]]] = label[r[0]]
                    rest = label[r] != label[c]
                    r, c = r[rest], c[rest]
    at = np.array(out, np.int64).reshape(-1, 2)
    a, b = cid[at[:, 0]], cid[at[:, 1]]
    return np.minimum(a, b), np.maximum(a, b)


def dealt_groups(blocks: DataFrame, conf: JoinConf, forest: bool) -> DataFrame:
    """``blocks``: key, chunk, chunks, cid, n, comp. Rows of groups (key, lo, hi): chunk, cid, n, comp."""
    names = ("key", "lo", "hi", "chunk", "cid", "n", "comp")
    alone = blocks.withColumns({"lo": F.col("chunk"), "hi": F.col("chunk")})
    if forest:
        return alone.select(*names)
    large = blocks.where("chunks > 1")
    by_comp = large.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    major = by_comp.groupBy("key").agg(F.max(F.struct("m", "comp")).alias("top"), F.sum("m").alias("all"))
    major = major.select("key", F.col("top.comp").alias("major"), F.ceil((F.col("all") - F.col("top.m")) / conf.chunk).cast("int").alias("strays"))
    rows = large.join(major, "key").withColumn("pure", F.col("comp") == F.col("major"))
    rows = rows.withColumn("chunk", F.when(F.col("pure"), F.col("chunk")).otherwise(F.col("chunks") + F.pmod(F.xxhash64("cid", "key"), F.col("strays")).cast("int")))
    # A chunk of the largest component meets the strays' chunks, a strays' chunk meets all.
    others = F.when(F.col("pure"), F.sequence(F.col("chunks"), F.col("chunks") + F.col("strays") - 1)).otherwise(F.sequence(F.lit(0), F.col("chunks") + F.col("strays") - 1))
    rows = rows.withColumn("other", F.explode(others)).withColumns({"lo": F.least("chunk", "other"), "hi": F.greatest("chunk", "other")})
    return alone.where("chunks = 1").select(*names).union(rows.select(*names))


def candidate_pairs(blocks: DataFrame, maps: DataFrame, conf: JoinConf, forest: bool) -> DataFrame:
    """``maps``: cid, bits. Returns a, b, comp: distinct pairs of classes to verify, comp null; and, not in the
    first round, classes (a) of groups (b) that are to be verified by sets, with their component.

    Chunks are dealt before the bitmaps are joined, so that these move as seldom as possible."""
    dealt = dealt_groups(blocks, conf, forest).join(maps, "cid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, sent = None, [], set()

        def found() -> list[tuple[int, int, int | None]]:
            chunk, cid, n, comp, maps = zip(*held)
            side = np.array(chunk) if group[1] != group[2] else None
            a, b = block_pairs(np.array(cid), np.array(n), np.array(comp), list(maps), side, conf, forest)
            if not forest and len(a) > conf.dense * len(held):
                name = int(mixed(np.array([group[0]], np.int64).view(np.uint64) ^ np.uint64(group[1] << 32 | group[2]))[0].astype(np.int64))
                return [(c, name, k) for c, k in set(zip(cid, comp))]
            new = set(zip(a.tolist(), b.tolist())) - sent
            sent.update(new)
            return [(x, y, None) for x, y in new]

        def rows(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["a", "b", "comp"])

        out: list = []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "lo", "hi", "chunk", "cid", "n", "comp", "bits")]
            for key, lo, hi, *row in zip(*columns):
                if (key, lo, hi) != group:
                    if len(held) > 1:
                        out += found()
                        if len(sent) > 1_000_000:
                            sent.clear()
                    group, held = (key, lo, hi), []
                    if len(out) > 50_000:
                        yield rows(out)
                        out = []
                held.append(row)
        if len(held) > 1:
            out += found()
        yield rows(out)

    return dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "n", "cid").mapInArrow(run, "a long, b long, comp long").distinct()


def similar_sets(sets: list[np.ndarray], label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Places of pairs that are as similar as asked, enough to connect what they connect across labels.

    Overlaps are products of 0/1 matrices over shingles that two sets share, some thousand at once."""
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    values, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    order = order[n[at[order]] > 1]
    owner, at = owner[order], at[order]
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    place = np.cumsum(np.concatenate([np.zeros(min(1, len(at)), bool), at[1:] != at[:-1]]))
    for first in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        lo, hi = np.searchsorted(place, [first, first + width])
        has = np.zeros((len(sets), width), np.float32)
        has[owner[lo:hi], place[lo:hi] - first] = 1
        overlap += has @ has.T
    both = overlap.astype(np.int64)
    alike = np.triu((100 * both >= percent * (size[:, None] + size[None, :] - both)) & (both > 0), 1)
    label, out = label.copy(), []
    for i, j in zip(*(x.tolist() for x in np.nonzero(alike & (label[:, None] != label[None, :])))):
        if label[i] != label[j]:
            out.append((i, j))
            label[label == label[j]] = label[i]
    return out


def class_sets(classes: DataFrame, docs: DataFrame, reps: DataFrame, conf: JoinConf) -> DataFrame:
    """cid, s: the sets of the classes asked for, from the texts of one document a class."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for cid, s in zip(batch.column("cid").to_pylist(), shingle_sets([t.lower() for t in batch.column("text").to_pylist()], conf.words)):
                if len(s) and cid in (None, mine := class_of(s)):  # an id may stand for several texts
                    found[mine] = s.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["cid", "s"])

    wanted = classes.select("cid").distinct().join(reps, "cid").select("cid", F.col("rep").alias("doc_id"))
    texts = docs.select("doc_id", utf8().alias("text"))
    named = texts.join(wanted, "doc_id").select("cid", "text").mapInArrow(sets, "cid long, s binary")
    # Classes of which no document has an id.
    nameless = texts.where("doc_id is null").select(F.lit(None).cast("long").alias("cid"), "text").mapInArrow(sets, "cid long, s binary")
    return cut(named.union(nameless.join(wanted.where("doc_id is null").select("cid"), "cid", "left_semi")).dropDuplicates(["cid"]))


def verified(found: DataFrame, docs: DataFrame, reps: DataFrame, conf: JoinConf) -> DataFrame:
    """``found``: rows of candidate_pairs(). The pairs (a, b) whose sets are as similar as asked; of a group, enough of them."""
    pairs, groups = found.where("comp is null").select("a", "b"), found.where("comp is not null")
    known = class_sets(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).union(groups.select("a")), docs, reps, conf)
    both = pairs.join(known.select(F.col("cid").alias("b"), F.col("s").alias("sb")), "b").join(known.select(F.col("cid").alias("a"), F.col("s").alias("sa")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                together = np.sort(np.concatenate([x, y]), kind="stable")
                overlap = int(np.count_nonzero(together[1:] == together[:-1]))
                keep.append(100 * overlap >= conf.percent * (len(x) + len(y) - overlap))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def links() -> pa.RecordBatch:
            label = np.unique([x[1] for x in held], return_inverse=True)[1]
            at = similar_sets([np.frombuffer(x[2], np.uint64) for x in held], label, conf.percent) if len(held) > 1 else []
            ends = [(min(held[i][0], held[j][0]), max(held[i][0], held[j][0])) for i, j in at]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in ends], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for g, *row in zip(*(batch.column(c).to_pylist() for c in ("b", "a", "comp", "s"))):
                if g != group:
                    yield links()
                    group, held = g, []
                held.append(row)
        yield links()

    of_groups = groups.join(known.select(F.col("cid").alias("a"), "s"), "a").select("a", "b", "comp", "s").repartition("b").sortWithinPartitions("b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").union(of_groups.mapInArrow(within, "a long, b long")).distinct()


def block_rows(docs: DataFrame, hot: DataFrame, names: np.ndarray, conf: JoinConf) -> DataFrame:
    """key, chunk, chunks, cid, n: the classes of each block of two or more; of blocks with the same classes only one.

    ``hot``: cid (a shingle), n (about how many classes have it)."""
    large = hot.where(F.col("n") > conf.chunk).select(F.col("cid").alias("key"), F.ceil(F.col("n") / conf.chunk).cast("int").alias("chunks"))
    keyed = prefixes(docs, names, conf).select("cid", "n", F.explode("keys").alias("key")).join(F.broadcast(large), "key", "left")  # hot_shingles rows at most
    keyed = keyed.withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("key", "cid"), F.col("chunks")).cast("int"))
    keyed = keyed.repartition("key", "chunk").dropDuplicates(["key", "chunk", "cid"])
    of_chunk = Window.partitionBy("key", "chunk")
    counted = keyed.withColumns({"size": F.count(F.lit(1)).over(of_chunk), "x": F.bit_xor(F.xxhash64("cid")).over(of_chunk), "y": F.bit_xor(F.xxhash64("cid", F.lit(1))).over(of_chunk)})
    rows = cut(counted.where("size > 1 or chunks > 1"))
    chunks = rows.groupBy("key", "chunk").agg(F.first("size").alias("size"), F.first("x").alias("x"), F.first("y").alias("y"))
    blocks = chunks.groupBy("key").agg(F.sum("size").alias("size"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    kept = blocks.groupBy("size", "x", "y").agg(F.min("key").alias("key")).where("size > 1").select("key")
    return cut(rows.select("key", "chunk", "chunks", "cid", "n").join(kept, "key", "left_semi"))


def unsettled(blocks: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows of blocks that hold more than one component: those of block_rows() with comp."""
    known = cut(blocks.join(comps, "cid", "left").withColumn("comp", F.coalesce("comp", "cid")))
    several = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return known.join(several, "key", "left_semi")


def jaccard_components(docs: DataFrame, conf: JoinConf = JoinConf()) -> DataFrame:
    """``docs``: doc_id, text. Returns doc_id, n_shingles, component_id, row by row."""
    first = cut(documents_and_counts(docs, conf))
    per_doc = first.where("kind = 0").select("doc_id", "cid", "n")
    hot = cut(first.where("kind = 1").groupBy("cid").agg(F.sum("n").alias("n")).where(F.col("n") >= conf.hot_count).orderBy(F.desc("n"), "cid").limit(conf.hot_shingles))
    names = np.array([r[0] for r in hot.select("cid").collect()], np.int64).view(np.uint64)  # hot_shingles at most
    reps = cut(per_doc.where("cid is not null").groupBy("cid").agg(F.min("doc_id").alias("rep")))
    maps = cut(bitmaps(docs, conf).dropDuplicates(["cid"]))
    blocks = block_rows(docs, hot, names, conf)

    links = cut(verified(cut(candidate_pairs(blocks.withColumn("comp", F.col("cid")), maps, conf, forest=True)), docs, reps, conf))
    comps = cut(components(links)).select(F.col("node").alias("cid"), F.col("root").alias("comp"))
    more = cut(verified(cut(candidate_pairs(unsettled(blocks, comps), maps, conf, forest=False)), docs, reps, conf))
    roots = components(links.union(more)).select(F.col("node").alias("cid"), "root")

    placed = reps.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = cut(placed.join(least, "root").select("cid", "component_id"))
    return per_doc.join(of_class, "cid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)
), r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (SELECT a AS doc_id, min(b) AS least FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(c.least, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""
