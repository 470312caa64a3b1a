"""Quality rules as a learned decision list [native].

Statistics of a text are Spark expressions. From labelled documents, sequential covering grows
rules for the low-quality class one at a time: each is a conjunction of thresholds on statistics,
grown by information gain on two thirds of the rows and pruned on the other third. Growing stops
when no rule is precise enough on the pruning rows. The ordered list becomes one Spark ``when``
chain, so applying it needs no Python on the executors.

Learning uses a bounded sample: the ``max_rows`` labelled documents with the smallest hash of
their id. Only their numbers, not their texts, reach the driver.

Defined cases: a null, empty or blank text has no words and fails the base rule. Rows that repeat
an id are judged one by one. Without labelled documents of both classes the list is empty and
only the base rule rejects. An empty table gives no rows. Windows are compared by their whole 64-bit
hashes, whatever the text's length. Extra columns of ``documents`` pass through untouched unless they
carry the name of a statistic; the query selects the columns that its contract names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP_CHARS, WORD_GAP, cut, let, table

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Texts of up to 2 ** PLACE_BITS windows are sorted as longs that hold a place in so many bits.
PLACE_BITS = 24
#: Statistics that rules may test, as expressions over the counts below.
RATIOS = ("n_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "shout_per_word", "words_per_line")


@dataclass(frozen=True)
class Rule:
    """All of ``tests`` (statistic, ``<=`` or ``>=``, threshold) must hold; the document is then rejected."""

    tests: tuple[tuple[str, str, float], ...]


def _without(text: Column, chars: str) -> Column:
    """``text`` without ``chars``; byte searches, where translate() would look up every character."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 5-word window found twice or more in the text, the first included."""

    def of_hashes(hashes: Column) -> Column:
        # Single elements are read by place: slice() would copy the whole array for every window.
        starts = F.slice(hashes, 1, F.greatest(F.lit(0), F.size(hashes) - (WINDOW - 1)))
        return let(F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)])), of_windows)

    def of_windows(win: Column) -> Column:
        return F.when(F.size(win) > F.size(F.array_distinct(win)), let(_repeated(win), _covered)).otherwise(F.lit(0))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _repeated(win: Column) -> Column:
    """Places, in order, of the windows that another one equals."""
    # Sorted as primitive longs: the hash's upper bits and the place below them. Where these bits are the same for
    # different windows, or a text has more places than fit, pairs of hash and place are sorted instead.
    keys = F.transform(win, lambda h, i: F.shiftleft(F.shiftright(h, PLACE_BITS), PLACE_BITS) + i)
    by_keys = let(F.sort_array(keys), lambda s: F.when(_mixed(s, win), _by_pairs(win)).otherwise(_positions(s, win)))
    return F.when(F.size(win).cast("long") > F.lit(1 << PLACE_BITS).cast("long"), _by_pairs(win)).otherwise(by_keys)


def _place(key: Column) -> Column:
    return F.when(key.isNotNull(), key.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))


def _mixed(keys: Column, win: Column) -> Column:
    """Whether neighbours in ``keys`` share the upper bits of different hashes."""
    alike = lambda k, n: (F.shiftright(k, PLACE_BITS) == F.shiftright(n, PLACE_BITS)) & (F.get(win, _place(k)) != F.get(win, _place(n)))
    return F.array_contains(F.transform(keys, lambda k, j: F.coalesce(alike(k, F.get(keys, j + 1)), F.lit(False))), True)


def _by_pairs(win: Column) -> Column:
    def of_sorted(pairs: Column) -> Column:
        twin = lambda x, j: F.coalesce(F.get(pairs, j)["h"] == x["h"], F.lit(False))
        marked = F.transform(pairs, lambda x, j: F.when(twin(x, j - 1) | twin(x, j + 1), x["i"]))
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    return let(F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted)


def _positions(keys: Column, win: Column) -> Column:
    """Places, in order, of the windows whose whole hash a neighbour in ``keys`` shares."""
    twin = lambda k, j: F.coalesce(F.get(win, _place(F.get(keys, j))) == F.get(win, _place(k)), F.lit(False))
    marked = F.transform(keys, lambda k, j: F.when(twin(k, j - 1) | twin(k, j + 1), _place(k)))
    return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))


def _covered(places: Column) -> Column:
    """Length of the union of [place, place + WINDOW)."""
    steps = F.transform(places, lambda p, j: F.coalesce(F.least(F.lit(WINDOW), F.get(places, j + 1) - p), F.lit(WINDOW)))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def counts(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the counts of the whole text, as longs."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(x, F.lit(GAP_CHARS))) > 0)
    nested = let(words, lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    out = docs.withColumns({"_w": nested, "_l": of_lines})
    long = lambda c: c.cast("long")
    return out.withColumns({
        "n_words": long(F.col("_w.n_words")), "n_repeat_words": long(F.col("_w.n_repeat_words")),
        "n_lines": long(F.col("_l.n_lines")), "n_dup_lines": long(F.col("_l.n_dup_lines")),
        "word_chars": long(F.length(_without(text, GAP_CHARS))), "n_symbols": long(F.length(text) - F.length(_without(text, SYMBOLS))),
        "n_upper": long(F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))), "n_shout": long(F.length(text) - F.length(_without(text, "!"))),
    }).drop("_w", "_l")


def ratios() -> dict[str, Column]:
    """The statistics, rounded so that thresholds and values compare alike everywhere."""
    per = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a).cast("double"), b), F.lit(0.0)), 4)
    return {
        "n_words": F.col("n_words").cast("double"), "mean_word_chars": per("word_chars", F.col("n_words")), "symbols_per_word": per("n_symbols", F.col("n_words")),
        "dup_line_share": per("n_dup_lines", F.col("n_lines")), "repeat_share": per("n_repeat_words", F.col("n_words")), "upper_share": per("n_upper", F.col("word_chars")),
        "shout_per_word": per("n_shout", F.col("n_words")), "words_per_line": per("n_words", F.col("n_lines")),
    }


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def _gain(p0: int, n0: int, p: int, n: int) -> float:
    """FOIL's gain: positives kept times the bits saved for each."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _fits(row: tuple, tests) -> bool:
    return all(row[f] <= t if op == "<=" else row[f] >= t for f, op, t in tests)


def learn(rows: list[tuple[tuple[float, ...], bool, bool]], max_rules: int = 12, max_tests: int = 3, cuts: int = 64, precision: float = 0.9, least: int = 5) -> list[Rule]:
    """Sequential covering. ``rows``: statistics in the order of RATIOS, low quality, for pruning.

    Each step takes the threshold of the highest gain among at most ``cuts`` quantiles of every
    statistic; a grown rule then loses trailing tests while that does not lower its precision
    on the pruning rows. It is kept if there it is at least ``precision`` precise.
    """
    out: list[Rule] = []
    grow = [(x, y) for x, y, z in rows if not z]
    prune = [(x, y) for x, y, z in rows if z]
    for _ in range(max_rules):
        covered, tests = grow, []
        while len(tests) < max_tests:
            p0 = sum(y for _, y in covered)
            n0 = len(covered) - p0
            if not p0 or not n0:
                break
            best: tuple[float, tuple] | None = None
            for f in range(len(RATIOS)):
                ordered = sorted((x[f], y) for x, y in covered)
                before, marks = 0, []  # positives up to a value's last row
                for i, (v, y) in enumerate(ordered):
                    before += y
                    if i + 1 < len(ordered) and ordered[i + 1][0] != v:
                        marks.append((i + 1, before, v, ordered[i + 1][0]))
                for i, below, v, after in marks[:: max(1, len(marks) // cuts)]:
                    cut = round((v + after) / 2, 6)
                    for op, p, n in (("<=", below, i - below), (">=", p0 - below, n0 - (i - below))):
                        gain = _gain(p0, n0, p, n) if p >= least else 0.0
                        if gain > 0 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, (f, op, cut))
            if best is None:
                break
            tests.append(best[1])
            covered = [r for r in covered if _fits(r[0], tests[-1:])]
        if not tests:
            break

        def worth(of: list) -> float:
            hit = [y for x, y in prune if _fits(x, of)]
            return (sum(hit) + 0.5) / (len(hit) + 1)

        while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):
            tests.pop()
        if worth(tests) < precision:
            break
        out.append(Rule(tuple((RATIOS[f], op, t) for f, op, t in tests)))
        grow, prune = ([r for r in part if not _fits(r[0], tests)] for part in (grow, prune))
    return out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> list[Rule]:
    """Rules learned from at most ``max_rows`` labelled documents: those with the smallest hash of their id."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # The counts are kept once: the statistics below would work them out anew, each from the whole text.
    found = counts(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))  # max_rows at most
    found = cut(found.drop("text"))
    rows = found.select("doc_id", "quality", *[c.alias(f"f_{k}") for k, c in ratios().items()], (F.xxhash64("doc_id", F.lit(1)) % 3 == 0).alias("prune"), base_failed().alias("base"))
    rows = sorted({tuple(r) for r in rows.where("not base").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).collect()})
    return learn([(r[2:-2], r[1] == 0, r[-2]) for r in rows])


def verdict(rules: list[Rule], stats: dict[str, Column] | None = None) -> Column:
    """True: keep. The ordered list as one conditional expression; no rule fires: keep."""
    stats = stats or ratios()
    out = None
    for rule in rules:
        fires = F.lit(True)
        for name, op, cut in rule.tests:
            fires = fires & (stats[name] <= cut if op == "<=" else stats[name] >= cut)
        out = F.when(fires, F.lit(False)) if out is None else out.when(fires, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` with its counts, ``base_failed`` and ``kept``."""
    return counts(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(docs, fit(docs, table(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
