"""SentencePiece encoding and decoding by a merge-type prefix table.

For a merge vocabulary, the encoding of every prefix of a text has one last token. The table
stores it for each prefix: an automaton lists the pieces that end there, and a piece is the one
if it is compatible with the last token of the prefix before it. The ids are then read backwards.
Two tokens are compatible if encoding their joined text gives just the two; that is decided from
the order in which the edges facing each other were merged, without encoding anything.

Tables are filled for chunks (a run of spaces and what follows up to the next space) and kept in
a bounded dictionary, as no piece has a space after another character. Vocabularies that have
such a piece are encoded text by text.

Defined cases: null text counts as empty; an empty text has the end id only, and decodes to an
empty text. Characters outside the vocabulary become byte ids. Very long texts are linear: one
automaton pass and a table of one entry a character of a chunk. Repeated rows are encoded alike.
Extra columns are passed through by ``encode_column``; the query selects its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, utf8

SPACE = "▁"
INF = 1 << 60


class PieceCodec:
    """Encoder and decoder for one model file (merge type with byte fallback)."""

    def __init__(self, path: str, max_cached: int = 500_000) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.eos = sp.eos_id()
        self.byte_id = [0] * 256
        self.out: list[bytes] = [b""] * n
        score: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.out[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                score[piece] = sp.get_score(i)
                self.out[i] = piece.replace(SPACE, " ").encode()
        # A piece with the higher score is merged first: rank 0 is the best.
        self.rank = {p: k for k, p in enumerate(sorted(score, key=lambda p: -score[p]))}
        self.by_chunk = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.left: dict[str, list[tuple[int, str]] | None] = {}
        self.right: dict[str, list[tuple[int, str]] | None] = {}
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            tree = self._tree(p)
            if tree is not None:
                self.left[p], self.right[p] = self._edge(tree, 0), self._edge(tree, 1)
                self.automaton.add_word(p, (self.ids[p], len(p)))
        self.automaton.make_automaton()
        self.known: dict[int, bool] = {}  # pairs already tested
        self.top = n
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.decimal = [b"%d" % i for i in range(n)]
        self.cache: dict[bytes, tuple[bytes, bytes]] = {}
        self.max_cached = max_cached

    def _merged(self, symbols: list) -> list:
        """Plain merging of (text, left, right) nodes: best rank first, leftmost among equals."""
        symbols = list(symbols)
        while True:
            best, at = INF, -1
            for i in range(len(symbols) - 1):
                k = self.rank.get(symbols[i][0] + symbols[i + 1][0], INF)
                if k < best:
                    best, at = k, i
            if at < 0:
                return symbols
            a, b = symbols[at : at + 2]
            symbols[at : at + 2] = [(a[0] + b[0], a, b)]

    def _tree(self, piece: str):
        """How ``piece`` is merged from its characters; None if merging gives other tokens."""
        found = self._merged([(c, None, None) for c in piece])
        return found[0] if len(found) == 1 else None

    def _edge(self, tree, side: int) -> list[tuple[int, str]] | None:
        """The symbols that stand at one edge while the piece is merged: (rank of its making, text), the
        character first. None if a later one has a better rank, as order in time then isn't order of rank."""
        spine = []
        while tree is not None:
            spine.append((self.rank[tree[0]] if tree[1] else -1, tree[0]))
            tree = tree[1 + side] if tree[1] else None
        spine.reverse()
        return spine if all(x[0] < y[0] for x, y in zip(spine, spine[1:])) else None

    def compatible(self, a: str, b: str) -> bool:
        """Whether the encoding of a + b is a, b."""
        right, left = self.right[a], self.left[b]
        if right is None or left is None:
            return [x[0] for x in self._merged([(c, None, None) for c in a + b])] == [a, b]
        i = j = 0
        while True:
            next_a = right[i + 1][0] if i + 1 < len(right) else INF
            next_b = left[j + 1][0] if j + 1 < len(left) else INF
            across = self.rank.get(right[i][1] + left[j][1], INF)
            # Among equal ranks the leftmost is merged first: one inside a precedes, one inside b follows.
            if across < next_a and across <= next_b and across < INF:
                return False
            if next_a == INF and next_b == INF:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def encode_symbols(self, s: str) -> list[int]:
        """Ids of a text in which spaces are already marked."""
        n = len(s)
        known, top = self.known, self.top
        last = [-1] * (n + 1)  # the last token of each prefix; -1: a character as bytes
        size = [1] * (n + 1)
        done = 0
        for end, (piece, long) in self.automaton.iter(s):
            end += 1
            if end <= done:
                continue
            start = end - long
            before = last[start]
            if start and before >= 0:
                pair = before * top + piece
                if (fits := known.get(pair)) is None:
                    if len(known) >= 2_000_000:
                        known.clear()
                    fits = known[pair] = self.compatible(self.text[before], self.text[piece])
                if not fits:
                    continue
            last[end], size[end] = piece, long
            done = end
        out: list[int] = []
        while n:
            if last[n] < 0:
                out += [self.byte_id[x] for x in reversed(s[n - 1].encode())]
            else:
                out.append(last[n])
            n -= size[n]
        out.reverse()
        return out

    def _chunk(self, key: bytes) -> tuple[bytes, bytes]:
        """Decimal ids and decoded bytes of one chunk; its first space is not in ``key``."""
        ids = self.encode_symbols(SPACE + key.decode().replace(" ", SPACE))
        found = (b" ".join([self.decimal[i] for i in ids]), b"".join(map(self.out.__getitem__, ids)))
        if len(key) <= 64:
            if len(self.cache) >= self.max_cached:
                self.cache.clear()
            self.cache[key] = found
        return found

    def coded(self, text: bytes) -> tuple[bytes, bytes]:
        """Decimal ids joined by one space, the end id last, and the text that they decode to."""
        if not text:
            return b"%d" % self.eos, b""
        if SPACE.encode() in text:
            text = text.replace(SPACE.encode(), b" ")
        if not self.by_chunk:
            chunks = [text]
        elif b"  " in text or text[:1] == b" ":
            chunks = [x[1:] for x in re.findall(rb" +[^ ]*", b" " + text)]
        else:
            chunks = text.split(b" ")
        get = self.cache.get
        found = [get(x) or self._chunk(x) for x in chunks]
        ids = b" ".join([x[0] for x in found])
        return ids + b" %d" % self.eos, b"".join([x[1] for x in found])[1:]

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.coded(text.encode())[0].split()]

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, marks as spaces, without the first space; broken byte runs become U+FFFD."""
        joined = b"".join(self.out[i] for i in ids)
        return joined[joined[:1] == b" " :].decode(errors="replace")


_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One for each worker process."""
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode_column(docs: DataFrame, path: str, digest: bool = False) -> DataFrame:
    """doc_id with ids and decoded text, or with their number and SHA-256 if ``digest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            coded = (c.coded(t) for t in batch.column("text").to_pylist())
            if digest:
                rows = [(i.count(b" ") + 1, hashlib.sha256(i).hexdigest(), hashlib.sha256(d).hexdigest()) for i, d in coded]
                columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
            else:
                rows = [([int(x) for x in i.split()], d.decode()) for i, d in coded]
                columns = [pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *columns], names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<int>, decoded string"
    names = [x.strip().split(" ")[0] for x in schema.split(",")]
    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, schema)


def op3_piece_codec(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    return encode_column(table(spark, sf_dir, "documents"), path or public_tokenizers.path("piece_bpe_32k.model"), digest=True)
