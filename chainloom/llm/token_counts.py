"""Token counts of whole texts, with huge documents encoded in overlapping chunks.

A byte-level vocabulary splits a text by a pattern that scans forward and never looks back, so what it
makes of a text after one of its boundaries depends on nothing before it. If a chunk and the chunk that
starts inside it have a boundary in common, both go on alike from there: that boundary is a splice. It is
right if it is right in the earlier chunk, and a boundary there can only be wrong near the chunk's end,
within the length of a special string (``margin``); by induction from the text's start all splices are boundaries of the whole text. Each chunk
carries its offset and gives its boundaries in both overlaps with the tokens before them; the tokens
between two splices then add up to the whole text's. A seam whose overlap has no common boundary (a run
without one is longer) is tried again with wider overlaps, eight times as wide each time, until the chunk is
the text.

Only texts beyond ``huge`` are cut, and only their chunks are shuffled, so a huge text is encoded by many
tasks; all others are counted where they are read. Tokens of a run between white space depend on that run
and on a space before it alone, so each worker keeps the counts of runs it has met, within a bound.

Defined cases: null text counts as empty (0 bytes, 0 tokens). A special string inside a text is its own token,
as the library has it by default. Bytes that aren't UTF-8 count as U+FFFD. Very long texts: above. Repeated
rows are counted each; null ids are kept; extra columns are ignored. An empty table gives no rows. Vocabularies
with a normaliser, a prefix space or special strings that take white space along are not of this kind: their
texts are counted whole.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table, utf8

#: Bytes from which a text is cut, characters of a chunk and of what follows it, and the limit that the query reports.
HUGE, CHUNK, OVERLAP, LIMIT = 32_768, 16_384, 1_024, 512
#: White space as the vocabulary's pattern takes it.
GAP = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNIT = re.compile(f" ?[^{GAP}]+|[{GAP}]+(?![^{GAP}])|[{GAP}]+")
OUT = "doc_id long, n_bytes long, n_tokens long"


class TokenCounter:
    """Counts of one vocabulary, and boundaries for splicing."""

    def __init__(self, path: str, max_cached: int = 500_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, processors

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        pre, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(f"[{GAP}]", t["content"]) for t in added)
        self.splices = plain and not spec["normalizer"] and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        if self.splices:
            self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets with the space before
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, strings))) if strings else None
        self.margin = max(map(len, strings), default=0) + 4
        self.counts: dict[str, int] = {}
        self.max_cached = max_cached

    def _encode(self, unit: str):
        return self.tokenizer.encode(unit, add_special_tokens=False)

    def _unit(self, unit: str) -> int:
        n = len(self._encode(unit).ids)
        if len(unit) <= 64:
            if len(self.counts) >= self.max_cached:
                self.counts.clear()
            self.counts[unit] = n
        return n

    def segments(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """(start, end, special) of the text between special strings, and of these."""
        at = 0
        for m in self.specials.finditer(text) if self.specials else ():
            yield at, m.start(), False
            yield m.start(), m.end(), True
            at = m.end()
        yield at, len(text), False

    def count(self, text: str) -> int:
        if not self.splices:
            return len(self._encode(text).ids)
        get, new = self.counts.get, self._unit
        return sum(1 if special else sum([get(u) or new(u) for u in UNIT.findall(text, a, b)]) for a, b, special in self.segments(text))

    def boundaries(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where the pattern's parts start, and the end; the tokens before each."""
        at: list[int] = []
        before: list[int] = []
        n = 0
        for a, b, special in self.segments(text):
            if special:
                at.append(a)
                before.append(n)
                n += 1
                continue
            for m in UNIT.finditer(text, a, b):
                unit = m.group()
                if len(unit) <= 64:
                    at.append(m.start())
                    before.append(n)
                    n += self.counts.get(unit) or self._unit(unit)
                else:  # the pattern's own parts, as such a run may be very long
                    e = self._encode(unit)
                    new = np.flatnonzero(np.diff(np.array(e.word_ids), prepend=-1))
                    at += [m.start() + e.offsets[i][0] for i in new]
                    before += [n + int(i) for i in new]
                    n += len(e.ids)
        return np.array([*at, len(text)], np.int64), np.array([*before, n], np.int64)


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One for each worker process."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def count_whole(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of texts that are encoded in one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            n = [c.count(t.decode(errors="replace")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return docs.select("doc_id", "n_bytes", "text").mapInArrow(run, OUT)


@dataclass(frozen=True)
class Cut:
    """Characters of a chunk, and how far it reads on into the next."""

    chunk: int = CHUNK
    overlap: int = OVERLAP

    def wider(self) -> Cut:
        return Cut(self.chunk * 8, self.overlap * 8)


def chunks(docs: DataFrame, how: Cut) -> DataFrame:
    """key, doc_id, n_bytes, i, start, last, ends, piece: the overlapping chunks of each text with their offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                text = r["text"].decode(errors="replace")
                starts = range(0, max(len(text), 1), how.chunk)
                for i, at in enumerate(starts):
                    row = {k: [r[k]] for k in ("key", "doc_id", "n_bytes")} | {"i": [i], "start": [at], "last": [at + how.chunk >= len(text)], "ends": [at + how.chunk + how.overlap >= len(text)], "piece": [text[at : at + how.chunk + how.overlap]]}
                    yield pa.RecordBatch.from_pydict(row, schema=schema)

    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("i", pa.int64()), ("start", pa.int64()), ("last", pa.bool_()), ("ends", pa.bool_()), ("piece", pa.string())])
    return docs.mapInArrow(run, "key binary, doc_id long, n_bytes long, i long, start long, last boolean, ends boolean, piece string")


HALF = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("seam", pa.int64()), ("later", pa.bool_()), ("at", pa.list_(pa.int64())), ("before", pa.list_(pa.int64()))])


def seams(pieces: DataFrame, path: str, how: Cut) -> DataFrame:
    """The two sides of every seam: the boundaries that either chunk has in the overlap, and the tokens before them.
    A text's start and end are seams of one side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for r in batch.to_pylist():
                at, before = c.boundaries(r["piece"])
                sure = len(r["piece"]) - (0 if r["ends"] else c.margin)  # beyond it the cut may have made a boundary
                sides = [(r["i"], True, at <= how.overlap if r["i"] else slice(0, 1))]
                sides.append((r["i"] + 1, False, slice(-1, None) if r["last"] else (at >= how.chunk) & (at <= sure)))
                rows = [{"key": r["key"], "doc_id": r["doc_id"], "n_bytes": r["n_bytes"], "seam": s, "later": later, "at": (r["start"] + at[which]).tolist(), "before": before[which].tolist()} for s, later, which in sides]
                yield pa.RecordBatch.from_pylist(rows, schema=HALF)

    return pieces.mapInArrow(run, "key binary, doc_id long, n_bytes long, seam long, later boolean, at array<long>, before array<long>")


def splice(halves: DataFrame) -> DataFrame:
    """key, doc_id, n_bytes, copies (equal rows), n_tokens, whole (whether every seam has a splice)."""
    side = lambda c, later: F.first(F.when(F.col("later") == later, F.col(c)), ignorenulls=True)
    each = halves.groupBy("key", "seam").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.count(F.when(F.col("later"), 1)).alias("copies"),
        side("at", False).alias("at_a"), side("before", False).alias("before_a"), side("at", True).alias("at_b"), side("before", True).alias("before_b"),
    )
    inner = F.col("at_a").isNotNull() & F.col("at_b").isNotNull()
    at = F.when(inner, F.array_min(F.array_intersect("at_a", "at_b")))
    # The earlier side's tokens before the splice, less the later side's; at the end there is but the earlier side, all of whose tokens count.
    tokens = lambda s: F.element_at(F.col(f"before_{s}"), F.array_position(F.col(f"at_{s}"), F.col("p")).cast("int"))
    gain = F.when(F.col("at_b").isNull(), F.col("before_a")[0]).when(F.col("at_a").isNull(), F.lit(0)).otherwise(F.when(F.col("p").isNotNull(), tokens("a") - tokens("b")))
    found = each.withColumn("p", at).withColumn("gain", gain)
    return found.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.max("copies").alias("copies"), F.sum("gain").cast("long").alias("n_tokens"), F.bool_and(F.col("gain").isNotNull()).alias("whole"))


def count_huge(docs: DataFrame, path: str, how: Cut = Cut()) -> DataFrame:
    """``docs``: doc_id, n_bytes, text (bytes). Their counts by chunks; equal rows are chunked each and told apart by their number."""
    left = docs.withColumn("key", F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"), F.lit(b"|"), F.col("text")), 256)))
    done = []
    for _ in itertools.count():
        found = cut(splice(seams(chunks(left, how).repartition("key", "i"), path, how)))
        done.append(found.where("whole"))
        again = found.where("not whole").select("key")
        if again.isEmpty():
            break
        how = how.wider()
        left = left.join(again, "key", "left_semi")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.select("doc_id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, huge: int = HUGE, how: Cut = Cut()) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).withColumn("n_bytes", F.length("text").cast("long"))
    if counter(path).splices:
        out = count_whole(rows.where(F.col("n_bytes") <= huge), path).unionByName(count_huge(rows.where(F.col("n_bytes") > huge), path, how))
    else:
        out = count_whole(rows, path)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), path or public_tokenizers.path("byte_bpe_50k.json"))
