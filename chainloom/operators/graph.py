"""Field statistics and the edges of the endpoint graph.

``fields``: endpoint, tool, category, kind (output or input), field, and optionally type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.lineage import cut
from ..functions.text import field_root, types_compatible
from .meeting import best_fields, shared_keys


def field_stats(fields: DataFrame, fraction: float = K.GENERIC_FRACTION) -> DataFrame:
    """field, df, categories, idf, specificity, class (generic, bridge or rare)."""
    # Each endpoint and category once before they are counted.
    totals = fields.select("endpoint", "category").distinct().agg(F.count_distinct("endpoint").alias("n"), F.count_distinct("category").alias("c"))
    each = fields.groupBy("field").agg(F.count_distinct("endpoint").alias("df"), F.count_distinct("category").alias("categories"))
    out = each.join(F.broadcast(totals)).withColumn("idf", F.ln(F.col("n") / F.col("df")))
    specific = F.when(F.col("n") <= 1, 0.5).otherwise(F.least(F.col("idf") / F.ln(F.greatest("n", F.lit(2)).cast("double")), F.lit(1.0)))
    kind = F.when(F.col("df") < F.col("n") * fraction, "rare").when(F.col("categories") >= F.col("c") * 0.5, "generic").otherwise("bridge")
    return out.select("field", "df", "categories", "idf", specific.alias("specificity"), kind.alias("class"))


def _typed(fields: DataFrame) -> DataFrame:
    return fields if "type" in fields.columns else fields.withColumn("type", F.lit("string"))


def sides(fields: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What endpoints give (src, src_tool, src_category, field, src_type) and what they take (dst, ...)."""
    f = _typed(fields)
    out = f.where("kind = 'output'").select(F.col("endpoint").alias("src"), F.col("tool").alias("src_tool"), F.col("category").alias("src_category"), "field", F.col("type").alias("src_type"))
    into = f.where("kind = 'input'").select(F.col("endpoint").alias("dst"), F.col("tool").alias("dst_tool"), F.col("category").alias("dst_category"), "field", F.col("type").alias("dst_type"))
    return out, into


def same_tool_edges(fields: DataFrame) -> DataFrame:
    """src, dst, shared_fields: another endpoint of the tool takes what one produces."""
    out, into = sides(fields)
    pairs = out.join(into, (out.src_tool == into.dst_tool) & (out.field == into.field) & (out.src != into.dst) & types_compatible(out.src_type, into.dst_type))
    return pairs.groupBy("src", "dst").agg(F.array_sort(F.collect_set(out.field)).alias("shared_fields"))


def confidence(name_quality: float, same_type: Column, same_category: Column, specificity: Column) -> Column:
    return name_quality * K.NAME_WEIGHT + F.when(same_type, 1.0).otherwise(0.7) * K.TYPE_WEIGHT + F.when(same_category, 1.0).otherwise(0.3) * K.CATEGORY_WEIGHT + specificity * K.SPECIFICITY_WEIGHT


def confidences(name_quality: float) -> Column:
    """Of a field with ``specificity``: for a type and category alike, the type alone, the category alone, neither."""
    yes, no, known = F.lit(True), F.lit(False), F.coalesce("specificity", F.lit(0.0))
    return F.array(*[confidence(name_quality, t, c, known) for t, c in ((yes, yes), (yes, no), (no, yes), (no, no))])


def classed(best: DataFrame) -> DataFrame:
    """Edges of pairs with their best ``c`` and its field: hard or soft. Thresholds apply before rounding."""
    return best.select("src", "dst", F.round("c", 3).alias("confidence"), F.when(F.col("c") >= K.HARD, "hard").otherwise("soft").alias("edge_class"), "field")


def _graded(pairs: DataFrame, name_quality: float, field: Column) -> DataFrame:
    """The most confident field of each pair; hard, soft, or not an edge. Thresholds apply before rounding."""
    c = confidence(name_quality, F.col("src_type") == F.col("dst_type"), F.col("src_category") == F.col("dst_category"), F.coalesce("specificity", F.lit(0.0)))
    best = pairs.select("src", "dst", c.alias("c"), field.alias("field")).where(F.col("c") >= K.SOFT).groupBy("src", "dst").agg(F.max(F.struct("c", "field")).alias("b"))
    return best.select("src", "dst", F.round("b.c", 3).alias("confidence"), F.when(F.col("b.c") >= K.HARD, "hard").otherwise("soft").alias("edge_class"), F.col("b.field").alias("field"))


def feeds_exact(fields: DataFrame, fraction: float = K.GENERIC_FRACTION, within: DataFrame | None = None) -> DataFrame:
    """Edges between tools on equal names. Generic fields go before the join, which also keeps hubs from skewing it.
    ``within`` (endpoint, group): only edges between endpoints that have a group in common are made."""
    stats = field_stats(fields, fraction)
    out, into = sides(fields)
    out = out.join(stats.where("class <> 'generic'").select("field", "specificity"), "field")
    if within is None:
        # Only fields that something takes; pairs are made and graded in blocks of sources.
        some = out.join(into.select("field").distinct(), "field", "left_semi").withColumns({"key": F.col("field"), "own": F.lit(None).cast("string"), "c": confidences(1.0)})
        taken = into.join(stats.where("class <> 'generic'").select("field"), "field", "left_semi").withColumns({"key": F.col("field"), "own": F.lit(None).cast("string")})
        return classed(best_fields(some, taken, K.SOFT, into))
    out, into = (rows.join(within.withColumnRenamed("endpoint", end), end) for rows, end in ((out, "src"), (into, "dst")))
    pairs = out.join(into, ["field", "group"])
    return _graded(pairs.where((F.col("src_tool") != F.col("dst_tool")) & types_compatible(F.col("src_type"), F.col("dst_type"))), 1.0, F.col("field"))


def independent_pairs(ends: DataFrame, flow: DataFrame, size: int = 16_384) -> DataFrame:
    """a, b: endpoints of a group (``ends``: endpoint, group) between which nothing of ``flow`` (src, dst) runs either way.

    A group's endpoints lie in blocks, a list each; an endpoint meets a block with those of it that it depends on, so pairs are
    made last and no shuffle holds them."""
    blocks = max(1, -(-ends.count() // size))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias("block")
    lists = ends.groupBy("group", block("endpoint")).agg(F.collect_list("endpoint").alias("all"))
    either = flow.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    bound = either.groupBy("a", block("b")).agg(F.collect_set("b").alias("bound"))
    asking = ends.select(F.col("endpoint").alias("a"), "group", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    met = asking.join(bound, ["a", "block"], "left").join(lists, ["group", "block"])
    free = F.when(F.col("bound").isNull(), F.col("all")).otherwise(F.array_except("all", "bound"))
    return met.select("a", F.explode(F.filter(free, lambda b: b > F.col("a"))).alias("b"))


def hard_sources(fields: DataFrame, fraction: float = K.GENERIC_FRACTION) -> DataFrame:
    """endpoint: sources of the hard edges of ``feeds_exact``. A field's takers are met by category and type, with the first and the last
    of their tools, one of which is another than the source's if any is; so no pair of endpoints is made."""
    stats = field_stats(fields, fraction)
    out, into = sides(fields)
    takers = into.groupBy("field", "dst_category", "dst_type").agg(F.min("dst_tool").alias("first"), F.max("dst_tool").alias("last"))
    pairs = out.join(stats.where("class <> 'generic'").select("field", "specificity"), "field").join(takers, "field")
    c = confidence(1.0, F.col("src_type") == F.col("dst_type"), F.col("src_category") == F.col("dst_category"), F.coalesce("specificity", F.lit(0.0)))
    other = (F.col("first") != F.col("src_tool")) | (F.col("last") != F.col("src_tool"))
    return pairs.where(other & types_compatible(F.col("src_type"), F.col("dst_type")) & (c >= K.HARD)).select(F.col("src").alias("endpoint")).distinct()


def same_tool_sources(fields: DataFrame) -> DataFrame:
    """endpoint: sources of ``same_tool_edges``, by the first and the last endpoint of the tool that takes a field."""
    out, into = sides(fields)
    takers = into.groupBy(F.col("dst_tool").alias("src_tool"), "field", "dst_type").agg(F.min("dst").alias("first"), F.max("dst").alias("last"))
    pairs = out.join(takers, ["src_tool", "field"]).where(types_compatible(F.col("src_type"), F.col("dst_type")))
    return pairs.where((F.col("first") != F.col("src")) | (F.col("last") != F.col("src"))).select(F.col("src").alias("endpoint")).distinct()


def feeds_root(fields: DataFrame, fraction: float = K.GENERIC_FRACTION) -> DataFrame:
    """Edges between tools on equal roots of different names, without pairs that ``feeds_exact`` has.

    Equal names meet as well, above all roots, so a pair that has them is known where it is graded and no shuffle holds pairs."""
    above = 10.0
    stats = field_stats(fields, fraction)
    out, into = sides(fields)
    useful = stats.where("class <> 'generic'").select("field", "specificity")
    none, root = F.lit(None).cast("string"), field_root(F.col("field"))
    key = lambda kind, c: F.concat(F.lit(kind), c)
    exact = F.transform(confidences(1.0), lambda c: F.when(c >= K.SOFT, c + above).otherwise(0.0))
    both = lambda rows, *more: rows.withColumn("root", root).withColumn("way", F.array(*[F.struct(k.alias("key"), own.alias("own"), *[c.alias("c") for c in cs]) for k, own, *cs in more])).select("*", F.inline("way")).drop("way").where("length(root) >= 3 or own is null").drop("root")
    given = both(out.join(useful, "field"), (key("=", F.col("field")), none, exact), (key("~", F.col("root")), F.col("field"), confidences(0.5))).where(F.array_max("c") >= K.SOFT)
    taken = both(into, (key("=", F.col("field")), none), (key("~", F.col("root")), F.col("field")))
    some = given.join(taken.select("key").distinct(), "key", "left_semi")
    return classed(best_fields(some, taken.join(given.select("key").distinct(), "key", "left_semi"), K.SOFT, into).where(F.col("c") < above))


def category_affinity(fields: DataFrame, stats: DataFrame, least: int = 3) -> DataFrame:
    """Pairs of categories that share at least so many fields that aren't generic."""
    pairs = fields.select("category", "field").distinct().join(stats.where("class = 'generic'").select("field"), "field", "left_anti")
    lists = pairs.groupBy("field").agg(F.collect_set("category").alias("all")).select("all", F.explode("all").alias("a"))  # a list of categories
    each = lists.select("a", F.explode(F.filter("all", lambda b: b > F.col("a"))).alias("b"))
    return each.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least)


def semantic_bridge(vectors: DataFrame, allowed: DataFrame | None, threshold: float, tile: int = 1024, most: int = 32, widest: int = 65_536) -> DataFrame:
    """Pairs of other categories (of ``allowed`` pairs ca, cb in either order, if given) with a cosine of at least the threshold, in both directions.

    Rows are dealt to tiles of about ``tile``, or to ``most`` larger ones of up to about ``widest``, and each pair of tiles is matrix products
    of so many rows at once: a row is sent once a tile, so what is sent grows as the rows do while tiles can, and pairs below the threshold
    never leave a task. Vectors that are null or zero, or hold null, have no cosine."""
    n = vectors.count()
    tiles = max(1, min(most, -(-n // tile)), -(-n // widest))
    usable = vectors.where("id is not null and category is not null and size(v) > 0").where(~F.exists("v", lambda x: x.isNull()))
    dealt = usable.select("id", "category", "v", F.size("v").alias("long"), F.pmod(F.xxhash64("id"), F.lit(tiles)).alias("t"))
    other = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    rows = other.select(F.least("t", "o").alias("x"), F.greatest("t", "o").alias("y"), "long", "t", "id", "category", "v")

    def close(frame: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(frame["v"].to_numpy())
        with np.errstate(all="ignore"):
            unit = v / np.sqrt((v * v).sum(axis=1, keepdims=True))
        x, y = (np.flatnonzero(frame["t"] == frame[c].iloc[0]) for c in ("x", "y"))
        ids, (kinds, _) = frame["id"].to_numpy(), pd.factorize(frame["category"])
        names, right = frame["category"].to_numpy(), unit[y].T
        a, b, c = [x[:0]], [y[:0]], [unit[:0, 0]]
        rows_at_once = max(1, (tile << 12) // max(1, len(y)))  # of numbers: 32 MB for tiles of 1,024
        for i in range(0, len(x), rows_at_once):
            some = x[i : i + rows_at_once]
            cosine = unit[some] @ right
            p, q = np.nonzero((cosine >= threshold) & (kinds[some][:, None] != kinds[y][None, :]))
            a.append(some[p])
            b.append(y[q])
            c.append(cosine[p, q])
        a, b = np.concatenate(a), np.concatenate(b)
        found = pd.DataFrame({"src": ids[a], "dst": ids[b], "ca": names[a], "cb": names[b], "cosine": np.concatenate(c)})
        back = found.rename(columns={"src": "dst", "dst": "src", "ca": "cb", "cb": "ca"})
        both = found if frame["x"].iloc[0] == frame["y"].iloc[0] else pd.concat([found, back])[found.columns]
        return both

    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    hits = rows.groupBy("x", "y", "long").applyInPandas(close, f"src {kind['id']}, dst {kind['id']}, ca {kind['category']}, cb {kind['category']}, cosine double")
    if allowed is not None:
        both = allowed.select("ca", "cb").union(allowed.select("cb", "ca")).distinct()
        hits = hits.join(both, ["ca", "cb"], "left_semi")
    return hits.where("src <> dst").select("src", "dst", F.round("cosine", 6).alias("cosine"))


def field_sets(fields: DataFrame) -> DataFrame:
    """endpoint, outputs, inputs: the names that an endpoint gives and takes, sorted."""
    of = lambda kind: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.col("field"))))
    return fields.groupBy("endpoint").agg(of("output").alias("outputs"), of("input").alias("inputs"))  # an endpoint's own names


def text_vectors(words: DataFrame) -> DataFrame:
    """``words``: id, category, word (one row an occurrence). id, category, word, df, w: unit vectors by tf-idf; words that all have weigh nothing."""
    counts = words.groupBy("id", "category", "word").agg(F.count(F.lit(1)).alias("tf"))
    df = counts.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    n = F.broadcast(words.agg(F.count_distinct("id").alias("n")))
    raw = counts.join(df, "word").join(n).withColumn("x", F.col("tf") * F.ln(F.col("n") / F.col("df"))).where("x > 0")
    return raw.select("id", "category", "word", "df", (F.col("x") / F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("id")))).alias("w"))


def packed_texts(texts: DataFrame) -> DataFrame:
    """``texts``: id, words (an array). id, df, word, x: a row an id with its words as 64-bit hashes, in how many ids each is, and its tf-idf.

    A text's words travel as counts of hashes, once by word and once by id."""
    id_ = {f.name: f.dataType.simpleString() for f in texts.schema}["id"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch.column("words"))))
            word = batch.column("words").flatten().to_numpy(zero_copy_only=False)
            by = np.lexsort((word, of))
            of, word = of[by], word[by]
            first = np.flatnonzero(np.append(len(of) > 0, (of[1:] != of[:-1]) | (word[1:] != word[:-1])))
            tf = np.diff(np.append(first, len(word)))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(of[first])), pa.array(word[first]), pa.array(tf)], names=["id", "word", "tf"])

    hashed = texts.where("id is not null and size(words) > 0").select("id", F.transform("words", lambda w: F.xxhash64(w)).alias("words"))
    n = hashed.agg(F.count_distinct("id").alias("n"))  # one row
    each = hashed.mapInArrow(count, f"id {id_}, word long, tf long").repartition("word").groupBy("word", "id").agg(F.sum("tf").alias("tf"))
    known = each.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("word"))).join(F.broadcast(n))  # spilled where a word is in many ids
    rows = known.select("id", "word", F.col("df").cast("int").alias("df"), (F.col("tf") * F.ln(F.col("n") / F.col("df"))).alias("x")).where("x > 0")
    return rows.repartition("id").groupBy("id").agg(F.collect_list("df").alias("df"), F.collect_list("word").alias("word"), F.collect_list("x").alias("x"))


def with_tails(rows: DataFrame, threshold: float, unit: bool = False) -> DataFrame:
    """``rows``: id, category, df, word, x (arrays). id, category, word, w (of unit vectors; ``unit``: they are), and ``tail`` of the last words, by which
    alone a pair can reach the threshold: the norm of a word and all that are more common. Words run from common to rare for all vectors; words that
    one vector has count in its norm alone, and vectors that cannot reach the threshold with the others leave."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = lambda values, size, type_: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(values, type_))
        for batch in batches:
            of = np.repeat(np.arange(batch.num_rows), np.asarray(pc.list_value_length(batch.column("word"))))
            df, word, x = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("df", "word", "x"))
            w = x if unit else x / np.sqrt(np.bincount(of, x * x, batch.num_rows))[of]
            at = np.flatnonzero(df > 1)
            at = at[np.lexsort((word[at], -df[at], of[at]))]
            of, word, w = of[at], word[at], w[at]
            size = np.bincount(of, minlength=batch.num_rows)
            before = np.concatenate([[0], np.cumsum(size)])
            tail = np.empty(len(w))
            for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
                tail[a:b] = np.sqrt(np.cumsum(w[a:b] * w[a:b]))
            rare = tail >= threshold - 1e-9
            last = np.bincount(of[rare], minlength=batch.num_rows)
            out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("category"), lists(word, size, pa.int64()), lists(w, size, pa.float64()), lists(tail[rare], last, pa.float64())], names=["id", "category", "word", "w", "tail"])
            yield out.filter(pa.array(last > 0))

    return rows.mapInArrow(run, f"id {kind['id']}, category {kind['category']}, word array<long>, w array<double>, tail array<double>")


def cosine_candidates(vectors: DataFrame, threshold: float, allowed: DataFrame | None = None) -> DataFrame:
    """``vectors`` as of ``with_tails``. a, b: pairs of other categories (``allowed`` in either order) that may reach the threshold; some come more than once.

    At the rarest word that two vectors share their product is at most that of the word's tails, so a pair is sent on at those words only."""
    last = F.slice("word", F.size("word") - F.size("tail") + 1, F.size("tail"))
    post = vectors.select("id", "category", F.inline(F.arrays_zip(last.alias("word"), F.col("tail").alias("tail"))))
    side = lambda k: post.select("word", *[F.col(c).alias(f"{c}_{k}") for c in ("id", "category", "tail")])
    left, right = side("a"), side("b")
    if allowed is not None:
        both = allowed.select(F.explode(F.array(F.struct("ca", "cb"), F.struct(F.col("cb").alias("ca"), F.col("ca").alias("cb")))).alias("p")).select("p.*")
        left = left.join(both.groupBy(F.col("ca").alias("category_a")).agg(F.collect_set("cb").alias("to")), "category_a")  # a list of categories for each
    pairs = left.join(right, "word").where((F.col("id_a") < F.col("id_b")) & (F.col("category_a") != F.col("category_b")) & (F.col("tail_a") * F.col("tail_b") >= threshold - 1e-9))
    pairs = pairs.where(F.array_contains("to", F.col("category_b"))) if allowed is not None else pairs
    return pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def packed_cosine_join(rows: DataFrame, threshold: float = 0.75, allowed: DataFrame | None = None, unit: bool = False, tile: int = 6_000_000) -> DataFrame:
    """src, dst, cosine: as ``cosine_join``, of ``rows``: id, category, df, word, x (arrays of a vector's words, its values not yet of unit length but for ``unit``).

    Vectors are dealt to tiles of about ``tile`` words, and candidates are worked out by pairs of tiles: a vector goes once to each in which
    it has a candidate, however many it has there."""
    vectors = cut(with_tails(rows, threshold, unit))
    words = vectors.agg(F.sum(F.size("word").cast("long")).alias("n")).first()["n"] or 0
    tiles = max(1, -(-words // tile))
    of = lambda c: F.pmod(F.xxhash64(c), F.lit(tiles)).cast("int")
    lists = cosine_candidates(vectors, threshold, allowed).groupBy("b", of("a").alias("t")).agg(F.collect_set("a").alias("a"))
    asked = cut(lists.select((F.least("t", of("b")) * tiles + F.greatest("t", of("b"))).alias("group"), "b", "a"))
    sent = asked.select(F.col("group").alias("to"), F.explode(F.array_append("a", F.col("b"))).alias("id")).distinct().join(vectors.select("id", "word", "w"), "id").toDF("id", "to", "word", "w")
    id_ = {f.name: f.dataType.simpleString() for f in rows.schema}["id"]

    def work(ask: pa.Table, have: pa.Table) -> pa.Table:
        ids = have.column("id").combine_chunks()
        size = np.asarray(pc.list_value_length(have.column("word").combine_chunks()))
        start = np.concatenate([[0], np.cumsum(size)])
        _, word = np.unique(have.column("word").combine_chunks().flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        w = have.column("w").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        dense = np.zeros(int(word.max()) + 1 if len(word) else 0)
        lists = ask.column("a").combine_chunks()
        place = np.asarray(pc.index_in(lists.flatten(), value_set=ids))
        end = np.cumsum(np.asarray(pc.list_value_length(lists)))
        own = np.asarray(pc.index_in(ask.column("b").combine_chunks(), value_set=ids))
        x, y, c = [own[:0]], [own[:0]], [w[:0]]
        for k, b in enumerate(own.tolist()):
            mine = slice(start[b], start[b + 1])
            dense[word[mine]] = w[mine]
            others = place[end[k - 1] if k else 0 : end[k]]
            for i in range(0, len(others), 1024):
                some = others[i : i + 1024]
                first = np.cumsum(size[some]) - size[some]
                at = np.repeat(start[some] - first, size[some]) + np.arange(size[some].sum())
                dot = np.add.reduceat(dense[word[at]] * w[at], first)
                ok = dot >= threshold
                x.append(some[ok])
                y.append(np.full(ok.sum(), b))
                c.append(dot[ok])
            dense[word[mine]] = 0.0
        return pa.table({"a": ids.take(pa.array(np.concatenate(x))), "b": ids.take(pa.array(np.concatenate(y))), "c": pa.array(np.concatenate(c))})

    full = asked.groupBy("group").cogroup(sent.groupBy("to")).applyInArrow(work, f"a {id_}, b {id_}, c double")
    both = F.explode(F.array(F.struct(F.col("a").alias("src"), F.col("b").alias("dst")), F.struct(F.col("b").alias("src"), F.col("a").alias("dst"))))
    return full.select(both.alias("p"), F.round("c", 6).alias("cosine")).select("p.*", "cosine")


def cosine_join(vectors: DataFrame, threshold: float = 0.75, allowed: DataFrame | None = None) -> DataFrame:
    """src, dst, cosine: pairs of sparse unit vectors (id, category, word, df, w) of other categories with a cosine of at least the threshold, in
    both directions. Exact but for collisions of 64-bit hashes of words: candidates meet on the words of prefix postings, and each is worked out in
    full. Work follows the rare words that vectors share; a vector without words meets none."""
    rows = vectors.groupBy("id", "category").agg(F.collect_list(F.col("df").cast("int")).alias("df"), F.collect_list(F.xxhash64("word")).alias("word"), F.collect_list("w").alias("x"))
    return packed_cosine_join(rows, threshold, allowed, unit=True)


def node_counts(fields: DataFrame) -> DataFrame:
    """node_type, n."""
    n = lambda df, kind: df.distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("node_type"), "n")
    parts = [n(fields.select("category"), "category"), n(fields.select("tool"), "tool"), n(fields.select("endpoint"), "endpoint"), n(fields.where("kind = 'input'").select("endpoint", "field"), "parameter"), n(fields.where("kind = 'output'").select("endpoint", "field"), "output_field")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def structural_edges(fields: DataFrame) -> DataFrame:
    """src, dst, edge_type for belongs_to, has_endpoint, takes_input and produces."""
    text = lambda c: F.col(c).cast("string")
    edge = lambda df, a, b, kind: df.select(a.alias("src"), b.alias("dst"), F.lit(kind).alias("edge_type")).distinct()
    name = F.concat_ws("/", text("endpoint"), F.col("field"))
    out = edge(fields, F.col("tool"), F.col("category"), "belongs_to").unionByName(edge(fields, F.col("tool"), text("endpoint"), "has_endpoint"))
    return out.unionByName(edge(fields.where("kind = 'input'"), text("endpoint"), name, "takes_input")).unionByName(edge(fields.where("kind = 'output'"), text("endpoint"), name, "produces"))


def nodes(fields: DataFrame) -> DataFrame:
    """id, node_type, name, category: categories, tools, endpoints, and the parameters and output fields of endpoints. Ids carry their kind, so equal names of two kinds are two nodes.

    An endpoint's names meet in one row, so fields are read twice and no name is a key of a shuffle."""
    text = lambda c: F.col(c).cast("string")
    node = lambda df, kind, name, *key: df.select(F.concat(F.lit(f"{kind}:"), F.concat_ws("/", *key)).alias("id"), F.lit(kind).alias("node_type"), name.alias("name"), "category").distinct()
    ends = fields.select("endpoint", "tool", "category").distinct()
    out = node(ends, "category", F.col("category"), F.col("category")).unionByName(node(ends, "tool", F.col("tool"), F.col("tool"))).unionByName(node(ends, "endpoint", text("endpoint"), text("endpoint")))
    kind = F.when(F.col("kind") == "input", "parameter").when(F.col("kind") == "output", "output_field")
    own = fields.select("endpoint", "category", kind.alias("node_type"), "field").where("node_type is not null")
    lists = own.groupBy("endpoint", "category", "node_type").agg(F.array_distinct(F.collect_list("field")).alias("names"))
    each = lists.select("endpoint", "category", "node_type", F.explode("names").alias("name"))
    return out.unionByName(each.select(F.concat(F.col("node_type"), F.lit(":"), F.concat_ws("/", text("endpoint"), "name")).alias("id"), "node_type", "name", "category"))


def build(fields: DataFrame, fraction: float = K.GENERIC_FRACTION, semantic: DataFrame | None = None) -> dict[str, DataFrame]:
    """The graph as two tables, ``nodes`` and ``edges`` (src, dst, edge_type, confidence, edge_class), for ``catalogue.save``: structure, endpoints of one
    tool, flows between endpoints, and semantic bridges (src, dst, cosine) if given. Ends are node ids."""
    from . import transitions as X

    end = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    name = F.concat_ws("/", F.col("endpoint").cast("string"), "field")
    # Only tools and endpoints are made distinct by a shuffle; endpoints' names meet in one row, and the other edges come once.
    row = lambda df, kind, a, b, confidence=F.lit(None), grade=F.lit(None): df.select(a.alias("src"), b.alias("dst"), (F.lit(kind) if isinstance(kind, str) else kind).alias("edge_type"), confidence.cast("double").alias("confidence"), grade.cast("string").alias("edge_class"))
    ends = (end("endpoint", "src"), end("endpoint", "dst"))
    known = fields.select("tool", "category", "endpoint").distinct()
    out = row(known, "belongs_to", end("tool", "tool"), end("category", "category")).distinct().unionByName(row(known, "has_endpoint", end("tool", "tool"), end("endpoint", "endpoint")).distinct())
    lists = fields.where("kind in ('input', 'output')").groupBy("endpoint", "kind").agg(F.array_distinct(F.collect_list(F.struct("field"))).alias("names"))
    takes, node = F.col("kind") == "input", F.when(F.col("kind") == "input", "parameter:").otherwise("output_field:")
    out = out.unionByName(row(lists.select("endpoint", "kind", F.inline("names")), F.when(takes, "takes_input").otherwise("produces"), end("endpoint", "endpoint"), F.concat(node, name)))
    out = out.unionByName(row(same_tool_edges(fields), "same_tool", *ends, F.lit(1.0), F.lit("hard"))).unionByName(row(X.flows(fields, fraction), "feeds_into", *ends, F.col("confidence"), F.col("edge_class")))
    if semantic is not None:
        out = out.unionByName(row(semantic, "semantic_bridge", *ends, F.round("cosine", 3), F.lit("soft")).distinct())
    return {"nodes": nodes(fields), "edges": out}


def category_fallback(fields: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Pairs within a category by shared names: confidence .5 + .3 n. ``sources``: the endpoints that they may start at, if not all.

    Names are compared by 64-bit hashes. Endpoints of several categories, of whose pairs names count once, meet each other in a join."""
    name = lambda kind: F.collect_set(F.when(F.col("kind") == kind, F.xxhash64("field")))
    of = fields.where("endpoint is not null and category is not null and field is not null").groupBy("endpoint", "category").agg(name("output").alias("given"), name("input").alias("taken"))
    if sources is not None:
        of = of.join(sources.select("endpoint", F.lit(True).alias("may")), "endpoint", "left").withColumn("given", F.when(F.col("may"), F.col("given")).otherwise(F.array().cast("array<bigint>"))).drop("may")
    ends = cut(of.withColumn("many", F.count(F.lit(1)).over(Window.partitionBy("endpoint")) > 1).select(F.col("endpoint").alias("end"), F.col("category").alias("group"), "given", "taken", "many"))
    found = shared_keys(ends)
    several = ends.where("many")
    if not several.isEmpty():
        both = several.select("end").distinct()
        src, dst = both.withColumnRenamed("end", "src").withColumn("a", F.lit(True)), both.withColumnRenamed("end", "dst").withColumn("b", F.lit(True))
        found = found.join(src, "src", "left").join(dst, "dst", "left").where("a is null or b is null").select("src", "dst", "shared")
        out, into = several.select(F.col("end").alias("src"), "group", F.explode("given").alias("field")), several.select(F.col("end").alias("dst"), "group", F.explode("taken").alias("field"))
        found = found.unionByName(out.join(into, ["group", "field"]).where("src <> dst").groupBy("src", "dst").agg(F.count_distinct("field").alias("shared")))
    return found.withColumn("confidence", F.round(0.5 + 0.3 * F.col("shared"), 6))
