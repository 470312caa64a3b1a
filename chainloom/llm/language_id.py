"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A letter 3-gram is bound by multiplying its
letters' vectors, each permuted (rotated) by its place; a text is the bundle (sum) of its 3-grams.
A language's prototype bundles the unit vectors of its learning texts; a text gets the language
whose prototype has the greatest cosine with it.

Learning takes at most ``per_lang`` texts a language, those with the smallest hash of the id, and
languages up to ``max_langs`` by number of texts. Components are summed as integers, so the
prototypes don't depend on how the rows were dealt.

Defined cases: null text, or text without a letter, is ``und`` with score 0. Null languages are
not learned. Ties go to the language first in order. With nothing to learn from, all are ``und``.
Very long texts are counted in whole; repeated rows are judged alike; extra columns are ignored.
A null id is not held out and not learned from. An empty table gives no rows. Languages beyond
``max_langs`` by number of texts are not learned: what is broadcast is bounded by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, least_hashes, table

UND = "und"
UNIT = 1 << 20
#: Characters counted at once.
BLOCK = 400_000


class Profiles:
    """Bundles of texts. One for each worker process."""

    def __init__(self, dim: int, seed: int = 7) -> None:
        self.dim, self.seed = dim, seed
        self.alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self.letters: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng((self.seed, code)).choice(np.array([-1, 1], np.float32), self.dim)
        return self.letters[code]

    def bundle(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, whether a text has a letter). Other characters are one gap between letters."""
        lowered = [t.lower() for t in texts]
        codes = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le", "replace"), "<u4")
        of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
        letter = self.alpha[codes]
        has = np.bincount(of[letter], minlength=len(texts)) > 0
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first of a run of gaps
        codes, of = np.where(letter, codes, 32)[keep], of[keep]
        out = np.zeros((len(texts), self.dim), np.float32)
        same = np.flatnonzero(of[:-2] == of[2:]) if len(codes) > 2 else np.zeros(0, np.int64)
        if not len(same):
            return out, has
        alphabet, at = np.unique(codes, return_inverse=True) if codes.max() > 0xFFFF else self._compact(codes)
        k = len(alphabet)
        grams = (at[same] * k + at[same + 1]) * k + at[same + 2]
        if k**3 <= 1 << 23:
            seen = np.zeros(k**3, bool)
            seen[grams] = True
            distinct = np.flatnonzero(seen)
            place = np.zeros(k**3, np.int32)
            place[distinct] = np.arange(len(distinct))
            grams = place[grams]
        else:
            distinct, grams = np.unique(grams, return_inverse=True)
        vectors = np.stack([self.letter(int(c)) for c in alphabet])
        first, second = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1)
        width = 4096  # 3-grams at once, to bound memory for large alphabets
        cell = of[same] * np.int64(len(distinct)) + grams
        if len(texts) * len(distinct) <= 1 << 24:
            counts = np.bincount(cell, minlength=len(texts) * len(distinct)).astype(np.float32).reshape(len(texts), -1)
            for s in range(0, len(distinct), width):
                d = distinct[s : s + width]
                out += counts[:, s : s + width] @ (first[d // (k * k)] * second[d // k % k] * vectors[d % k])
        else:
            cells, n = np.unique(cell, return_counts=True)
            for s in range(0, len(cells), width):
                c = cells[s : s + width]
                d = distinct[c % len(distinct)]
                np.add.at(out, c // len(distinct), n[s : s + width, None] * (first[d // (k * k)] * second[d // k % k] * vectors[d % k]))
        return out, has

    @staticmethod
    def _compact(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen = np.zeros(0x10000, bool)
        seen[codes] = True
        alphabet = np.flatnonzero(seen)
        place = np.zeros(0x10000, np.int64)
        place[alphabet] = np.arange(len(alphabet))
        return alphabet, place[codes]


_profiles: dict[int, Profiles] = {}


def profiles(dim: int) -> Profiles:
    if dim not in _profiles:
        _profiles[dim] = Profiles(dim)
    return _profiles[dim]


def blocks(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) of about BLOCK characters together."""
    start, size, part = 0, 0, []
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= BLOCK or len(part) >= 256:
            yield start, part
            start, size, part = i + 1, 0, []
    if part:
        yield start, part


def learn(labelled: DataFrame, dim: int = 256, per_lang: int = 4000, max_langs: int = 1000) -> list[tuple[str, np.ndarray]]:
    """``labelled``: doc_id, text, lang. Prototypes as unit vectors, in order of language."""
    known = labelled.where("lang is not null and text is not null and doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    # Each language's limit on the hash, over ids alone.
    top = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).select("lang")
    order = F.shiftrightunsigned("h", 1)  # as unsigned numbers
    limits = least_hashes(known.select("lang", "h").join(F.broadcast(top), "lang"), "lang", per_lang).groupBy("lang").agg(F.max(order).alias("most"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, sums = profiles(dim), {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for start, texts in blocks(batch.column("text").to_pylist()):
                vectors, has = p.bundle(texts)
                norms = np.linalg.norm(vectors, axis=1)
                for i in np.flatnonzero(has & (norms > 0)):
                    sums[langs[start + i]] = sums.get(langs[start + i], 0) + np.rint(vectors[i] / norms[i] * UNIT).astype(np.int64)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(range(dim), pa.int32()), pa.array(v)], names=["lang", "i", "v"])

    # max_langs rows at most are broadcast.
    chosen = known.join(F.broadcast(limits), "lang").where(order <= F.col("most")).select("lang", "text")
    parts = chosen.mapInArrow(run, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    out: dict[str, np.ndarray] = {}
    for r in parts.collect():  # max_langs * dim numbers at most
        out.setdefault(r["lang"], np.zeros(dim))[r["i"]] = r["v"]
    return [(k, v / np.linalg.norm(v)) for k, v in sorted(out.items()) if np.any(v)]


def identify(docs: DataFrame, prototypes: list[tuple[str, np.ndarray]], dim: int = 256) -> DataFrame:
    """doc_id, lang_pred, score: the cosine carried from [-1, 1] to [0, 1]."""
    names = [k for k, _ in prototypes]
    shared = docs.sparkSession.sparkContext.broadcast(np.array([v for _, v in prototypes]).reshape(-1, dim))  # max_langs * dim numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = profiles(dim)
        for batch in batches:
            langs, scores = [], []
            for _, texts in blocks(batch.column("text").to_pylist()):
                vectors, has = p.bundle(texts)
                if not names:
                    has[:] = False
                    best, cosine = np.zeros(len(texts), int), np.zeros(len(texts))
                else:
                    norms = np.linalg.norm(vectors.astype(np.float64), axis=1)
                    cosines = vectors.astype(np.float64) @ shared.value.T / np.where(norms > 0, norms, 1)[:, None]
                    best = np.argmax(cosines, axis=1)
                    cosine = cosines[np.arange(len(texts)), best]
                langs += [names[b] if h else UND for b, h in zip(best, has)]
                scores.append(np.where(has, np.clip((1 + cosine) / 2, 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(langs, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]))], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    prototypes = learn(docs.where(fold_of(F.col("doc_id"), 5) != 0).select("doc_id", "text", "lang"))
    found = identify(docs, prototypes)
    return found.select("doc_id", (F.coalesce(fold_of(F.col("doc_id"), 5), F.lit(1)) == 0).alias("held_out"), "lang_pred", "score")
