"""Best-fit packing of documents into token sequences, by sums of squares.

State is, for every residual gap, how many open sequences have it. Of the open sequences that fit, a
piece goes where the sum of the squared counts becomes smallest; an open sequence that fits is always
preferred to a new one. That keeps gaps varied, so that later pieces find one that fits. Pieces come
longest first.

Documents longer than a sequence are cut into whole sequences; what remains is packed like the
others. Packing runs in shards of about ``shard_rows`` pieces chosen by a hash, each one task of
bounded memory; each shard leaves a few sequences unfilled.

Defined cases: null text counts as empty and is one piece, the end id alone. Repeated ids are
separate documents (each row is tokenised by itself); extra columns are ignored. Very long texts
are tokenised whole. Among equal lengths the smaller id comes first, among equal changes the least
gap. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, utf8

CAPACITY = 2048
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_marks() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where it is
    printable, else the next unused one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Token ids of whole texts. A word between white space is tokenised once and kept, within a bound;
    so are the parts that the vocabulary's pattern makes of it. Its rules never look across white space.

    Words of Latin-1 characters are normalised and split here, others and words that may hold a special
    token by the library as they are.
    """

    def __init__(self, path: str, max_cached: int = 500_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            pattern = next(p["pattern"]["Regex"] for p in json.load(f)["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern).findall
        self.marks = byte_marks()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.max_cached = max_cached

    def _part(self, part: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(part.encode().decode("latin-1").translate(self.marks))]
        if len(self.parts) >= self.max_cached:
            self.parts.clear()
        found = self.parts[part] = np.array(ids, "<u4").tobytes()
        return found

    def _word(self, word: bytes) -> bytes:
        text = word.decode()
        if b"<|" in word or max(text) > "\xff":
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            parts = self.parts
            found = b"".join([parts.get(p) or self._part(p) for p in self.split(text.lower())])
        if len(word) <= 64:
            if len(self.words) >= self.max_cached:
                self.words.clear()
            self.words[word] = found
        return found

    def encode_all(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        get = self.words.get
        for text in texts:
            yield b"".join([get(w) or self._word(w) for w in text.split()])


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Each document's ids and the end id, cut where they exceed ``capacity``. ``with_ids``: the ids as well, as bytes."""
    end = np.array([end_id], "<u4").tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for batch in batches:
            docs_, parts = batch.column("doc_id").to_pylist(), []
            for doc, ids in zip(docs_, t.encode_all(batch.column("text").to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    part = ids[at : at + width]
                    parts.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            columns = list(zip(*parts)) or [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names[: len(kinds)])

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, PIECE + (", ids binary" if with_ids else ""))


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece by sums of squares, longest first; bins count from 0."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    gaps = np.zeros(capacity + 1, np.int64)  # open sequences by gap; what is full isn't counted
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        # The change of the sum of squares, halved and less one, for each gap that has an open sequence.
        change = np.where(gaps[s:capacity] > 0, gaps[: capacity - s] - gaps[s:capacity], capacity * len(lengths) + 1)
        if len(change):
            change[0] = -gaps[s] if gaps[s] else change[0]  # a filled sequence leaves the counts
            gap = s + int(np.argmin(change))
            fits = gaps[gap] > 0
        else:
            fits = False
        # A new sequence only where no open one fits.
        if fits:
            b = heapq.heappop(open_[gap])
            gaps[gap] -= 1
        else:
            b, gap, made = made, capacity, made + 1
        bins[i], offsets[i] = b, capacity - gap
        if gap > s:
            gaps[gap - s] += 1
            heapq.heappush(open_[gap - s], b)
    return bins, offsets


def pack(found: DataFrame, capacity: int = CAPACITY, shard_rows: int = 16_384) -> DataFrame:
    """``found``: rows of pieces(), kept in a table. Adds sequence_id and the offset in it."""
    n = found.count()
    shards = max(1, -(-n // shard_rows))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = pack_lengths(pdf["length"].to_numpy(), capacity)
        return pdf.drop(columns="shard").assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)

    # ``found`` is a table that is kept, so a row's number stays; equal ids and rows are dealt over all shards.
    shard = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(shards))
    return found.withColumn("shard", shard).groupBy("shard").applyInPandas(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema) + ", sequence_id long, offset long")


def best_fit(docs: DataFrame, path: str, capacity: int = CAPACITY, shard_rows: int = 16_384) -> DataFrame:
    """Tokenise, cut and pack. The pieces are kept once, as counting and packing both read them."""
    from .common import cut

    return pack(cut(pieces(docs, path, capacity)), capacity, shard_rows)


def op6_best_fit(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    return best_fit(table(spark, sf_dir, "documents"), path or public_tokenizers.path("word_bpe_49k.json"))
