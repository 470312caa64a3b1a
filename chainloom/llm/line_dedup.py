"""Line dedup with fuzzy lines.

Lines are normalised (A-Z lowered, digits as 0, white space collapsed). Every line with a word takes
part. Its units are its words, or its characters if it has fewer than ``min_words`` words: short
lines, and whole lines of scripts without spaces. Equal normalised lines form a class by hash, counted before
any join. Classes meet by a prefix filter that is derived from the threshold and misses no pair:
edits within it destroy at most d of a line's pairs of neighbouring units (see ``destroyed``), so
alike lines share ``COMMON`` of the first d + ``COMMON`` of their distinct pairs, whatever order of
pairs both use, or at least one if either line has fewer. What survives the edits stays near its
place, so a shared pair counts only where the edits that its places imply are allowed. The order is
rarest first, by counts of a bounded sample; it decides speed alone. Edit similarity of unit
sequences, computed exactly, links classes that meet. Of every connected group of lines
the occurrence with the least (doc_id, row, line) stays; all others go.

Few classes at a key give pairs, which stay if lengths and 256 parities of the units allow it (an
edit changes two at most). Each class is first tested against one other, which finds most groups by
a test a class; the other pairs are tested only across the components so far. At a larger key, if
its classes are of several components, a class is compared with earlier ones of others that its words
allow, likeliest first, and with a component no further once one member matches. Of keys with the
same classes one is kept.

SimHash blocks, which the method names, miss most lines that are alike at 80 % (see README).

Defined cases: null text stays null, texts without dropped lines stay as they are. A document all
of whose lines go keeps its row with an empty text, if asked to (``keep_empty``); else it goes too,
and documents that had no words before always stay. Rows equal in id and text are one document and
are treated alike. A null doc_id sorts first, of equal places any counts, as their lines are equal. Very long
texts are handled whole. Extra columns are kept, also those of names used here, but for dropped_lines,
which is replaced. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP_CHARS, cut, release, table, utf8
from .components import components
from .shingles import PRIME, mixed, words_with_places

NORMAL = bytes(48 if 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class LineConf:
    """Lines of fewer than ``min_words`` words are compared by characters."""

    min_words: int = 3
    percent: int = 80


#: Bits of the table of sampled counts that orders pairs of words, and the sample's documents.
ORDER_BITS, ORDER_DOCS = 22, 5_000
#: Classes at one key up to which every pair is made.
FEW = 256
#: Pairs that are looked at at once, about.
AT_ONCE = 1 << 21
#: Keys that one task of the prefix filter holds, about.
PART_KEYS = 1 << 18
#: Keys that alike lines share at least, if both have as many as are asked.
COMMON = 2
#: Numbers of units from which a line counts as long: its number and places aren't looked at. A place of this says nothing.
LONG = 32_767
SKETCH = ("s0", "s1", "s2", "s3")


def row_id() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def characters(line: bytes) -> np.ndarray:
    """A line's code points."""
    return np.frombuffer(b" ".join(line.split()).decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


class Lines:
    """The lines with a word of a run of texts. ``doc``: place of the text, ``line``: of the line in it, from 0; ``h``: its
    class; ``words``: hashes of all words, those of a line from ``start``, ``n`` of them."""

    def __init__(self, texts: list[bytes]) -> None:
        self.flat = b"\n".join(texts).translate(NORMAL)
        self.words, word_at = words_with_places(self.flat)
        breaks = np.flatnonzero(np.frombuffer(self.flat, np.uint8) == 10)
        self.edge = np.concatenate([[0], breaks + 1, [len(self.flat) + 1]])  # where lines begin
        of = np.searchsorted(breaks, word_at)
        self.start = np.flatnonzero(np.concatenate([np.ones(min(1, len(of)), bool), of[1:] != of[:-1]]))
        self.n = np.diff(np.append(self.start, len(of)))
        self.number = of[self.start]  # among all lines of the run
        first = np.cumsum([0, *(t.count(b"\n") + 1 for t in texts[:-1])])  # each text's first line
        self.doc = np.searchsorted(first, self.number, side="right") - 1
        self.line = self.number - first[self.doc]
        place = (np.arange(len(of)) - np.repeat(self.start, self.n)).astype(np.uint64)
        each = mixed(self.words + PRIME * (place + np.uint64(1)))
        self.h = mixed(np.add.reduceat(each, self.start)) if len(self.start) else np.zeros(0, np.uint64)

    def units(self, lines: np.ndarray, conf: LineConf) -> tuple[np.ndarray, np.ndarray]:
        """(units of the lines asked, one after the other, how many each has)."""
        n = self.n[lines].copy()
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.start[lines], n)
        narrow = (self.words[at] >> np.uint64(32)).astype(np.uint32)  # enough to tell two lines' words apart
        short = np.flatnonzero(n < conf.min_words)
        if not len(short):
            return narrow, n
        parts = np.split(narrow, np.cumsum(n)[:-1])
        for i in short.tolist():
            k = self.number[lines[i]]
            parts[i] = characters(self.flat[self.edge[k] : self.edge[k + 1] - 1])
            n[i] = len(parts[i])
        return np.concatenate(parts), n


def runs_of(batch: pa.RecordBatch, size: int = 1 << 21) -> Iterator[tuple[int, Lines]]:
    """(place of the first text, the lines) of runs of about ``size`` bytes of a batch's texts."""
    texts, first, held = batch.column("text"), 0, 0
    part: list[bytes] = []
    for i in range(batch.num_rows):
        part.append(texts[i].as_py())
        held += len(part[-1])
        if held >= size or i + 1 == batch.num_rows:
            yield first, Lines(part)
            first, held, part = i + 1, 0, []


def line_table(docs: DataFrame) -> DataFrame:
    """doc_id, rid, line (from 0), h (class): lines that have a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, lines in runs_of(batch):
                of = pa.array(lines.doc + first)
                columns = [batch.column("doc_id").cast(pa.int64()).take(of), batch.column("rid").take(of), pa.array(lines.line.astype(np.int32)), pa.array(lines.h.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "rid", "line", "h"])

    return docs.select("doc_id", row_id().alias("rid"), utf8().alias("text")).mapInArrow(run, "doc_id long, rid long, line int, h long")


def fresh_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Lines, np.ndarray]]:
    """Runs of lines with those whose class the run has first, without most of those that came earlier in the task."""
    seen: set[int] = set()
    for batch in batches:
        for _, lines in runs_of(batch):
            h, at = np.unique(lines.h, return_index=True)
            new = np.array([x not in seen for x in h.tolist()], bool)
            if len(seen) < 1_000_000:
                seen.update(h[new].tolist())
            yield lines, at[new] if len(new) else at


def sequences(docs: DataFrame, conf: LineConf) -> DataFrame:
    """h, w (32-bit units), n (how many), s0 to s3 (whether an odd number of units falls to each of 256 bits): a row a class and task that meets it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines, at in fresh_lines(batches):
            w, n = lines.units(at, conf)
            ends = np.concatenate([[0], np.cumsum(4 * n)]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(w))])
            sketch = parities(w, n, 4)
            yield pa.RecordBatch.from_arrays([pa.array(lines.h[at].view(np.int64)), packed, pa.array(n.astype(np.int32)), *(pa.array(sketch[:, k].view(np.int64)) for k in range(4))], names=["h", "w", "n", *SKETCH])

    return docs.select(utf8().alias("text")).mapInArrow(run, "h long, w binary, n int, s0 long, s1 long, s2 long, s3 long")


def edits(a: list[int], b: list[int], most: int | None = None) -> int:
    """Insertions, deletions and replacements of words between two lines, by Myers' bit vectors. Where they are more than ``most``, some number above it."""
    if not a or not b:
        return max(len(a), len(b))
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = every, 0, len(a)
    left = len(b)
    for y in b:
        # Each word that is left takes one off at most.
        if most is not None and distance - left > most:
            return distance - left
        left -= 1
        equal = at.get(y, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = down | (~(across | up) & every), up & across
        if more & last:
            distance += 1
        elif less & last:
            distance -= 1
        more, less = (more << 1 | 1) & every, (less << 1) & every
        up, down = less | (~(vertical | more) & every), more & vertical
    return distance


def similar(a: list[int], b: list[int], percent: int) -> bool:
    """Whether 1 - edits / longer length reaches the percentage. What both begin and end with costs nothing."""
    allowed = (100 - percent) * max(len(a), len(b)) // 100
    if abs(len(a) - len(b)) > allowed:
        return False
    left, least = 0, min(len(a), len(b))
    while left < least and a[left] == b[left]:
        left += 1
    right = 0
    while right < least - left and a[-1 - right] == b[-1 - right]:
        right += 1
    a, b = a[left : len(a) - right], b[left : len(b) - right]
    if max(len(a), len(b)) <= allowed:
        return True
    x, y = set(a), set(b)
    if max(len(x - y), len(y - x)) > allowed:
        return False
    if len(x) < len(a) or len(y) < len(b):
        # Each occurrence counts, which tells lines that repeat few words apart.
        x, y = Counter(a), Counter(b)
        if max((x - y).total(), (y - x).total()) > allowed:
            return False
    return edits(a, b, allowed) <= allowed


def numbered(units: np.ndarray) -> np.ndarray:
    """Hashes of a line's units, each with the number of its occurrence, so that repeated ones are told apart."""
    by = np.argsort(units, kind="stable")
    of = units[by]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(of)), bool), of[1:] != of[:-1]]))
    number = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    return mixed(of.astype(np.uint64) + PRIME * (number.astype(np.uint64) + np.uint64(1)))


@cache
def destroyed(n: int, percent: int) -> int:
    """The most pairs of neighbouring words that a line of n words can lose to an alike one, -1: there is no other.

    A replaced or deleted word costs two pairs, an inserted one a single pair; a line longer by k has k insertions."""
    lost, k = -1, 0
    while k <= (allowed := (100 - percent) * (n + k) // 100):
        if allowed:
            lost = max(lost, 2 * allowed - k)
        k += 1
    return lost


def pair_hashes(units: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of pairs of neighbouring units, the line of each)."""
    of = np.repeat(np.arange(len(n)), n)
    at = np.flatnonzero(of[1:] == of[:-1])
    return mixed((units[at].astype(np.uint64) << np.uint64(32)) | units[at + 1]), of[at]


def sampled_order(docs: DataFrame, conf: LineConf) -> bytes:
    """How often pairs of units occur in a bounded sample of documents, by hash, up to 63. It orders keys and changes no result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << ORDER_BITS, np.int64)
        for lines, at in fresh_lines(batches):
            counts += np.bincount((pair_hashes(*lines.units(at, conf))[0] >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=1 << ORDER_BITS)
        yield pa.RecordBatch.from_arrays([pa.array([zstandard.compress(np.minimum(counts, 63).astype(np.uint8).tobytes(), 1)])], names=["t"])

    found = docs.select(utf8().alias("text")).limit(ORDER_DOCS).coalesce(1).mapInArrow(run, "t binary").first()
    return bytes(found["t"]) if found else zstandard.compress(bytes(1 << ORDER_BITS))


def prefix_keys(units: np.ndarray, n: np.ndarray, order: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, the line of each, its place there or LONG if it has several, which lines have all keys that are asked):
    of each line the first of its distinct pairs, rarest first, ``COMMON`` more than can be destroyed."""
    pairs, of = pair_hashes(units, n)
    inside = np.arange(len(of)) - np.searchsorted(of, of)
    rank = order[(pairs >> np.uint64(64 - ORDER_BITS)).astype(np.int64)].astype(np.uint64)
    # Sorted by line, rank and the hash's lower bits, which fit one number (two pairs that these don't tell apart may change places).
    by = np.argsort((of.astype(np.uint64) << np.uint64(40)) | (rank << np.uint64(34)) | (pairs & np.uint64((1 << 34) - 1)), kind="stable")
    keys, of, inside = pairs[by], of[by], np.minimum(inside[by], LONG)
    fresh = np.ones(len(keys) + 1, bool)
    fresh[1:-1] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    inside = np.where(fresh[1:], inside, LONG)[fresh[:-1]]  # the next one isn't the same
    keys, of = keys[fresh[:-1]], of[fresh[:-1]]
    place = np.arange(len(of)) - np.searchsorted(of, of)
    kinds, at = np.unique(n, return_inverse=True)
    lost = np.array([destroyed(x, percent) for x in kinds.tolist()], np.int64)[at] if len(kinds) else n
    wanted = np.where(lost < 0, 0, lost + COMMON)
    taken = place < wanted[of]
    return keys[taken], of[taken], inside[taken], np.bincount(of, minlength=len(n)) >= wanted


def bytes_of(values: np.ndarray) -> bytes:
    """16-bit numbers, all lower bytes first: most upper ones are zero and compress to nothing."""
    return np.ascontiguousarray(values.astype("<u2").view(np.uint8).reshape(-1, 2).T).tobytes()


def numbers_of(packed: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(2, -1).T).view("<u2").ravel().astype(np.int64) for x in packed)])


def parities(units: np.ndarray, n: np.ndarray, wide: int) -> np.ndarray:
    """64 * ``wide`` bits of each line: whether an odd number of its units falls to each. An edit changes two at most."""
    out, some = np.zeros((len(n), wide), np.uint64), np.flatnonzero(n)
    place = (units & np.uint32(64 * wide - 1)).astype(np.uint64)
    bits = np.uint64(1) << (place & np.uint64(63))
    for k in range(wide if len(some) else 0):
        out[some, k] = np.bitwise_xor.reduceat(np.where(place >> np.uint64(6) == k, bits, np.uint64(0)), (np.cumsum(n) - n)[some])
    return out


class Block:
    """Lines that share a key. A line is tested against earlier ones that its words and its pairs of neighbours allow
    (an occurrence that only one of two lines has costs an edit, two of pairs do), likeliest first, and once a component."""

    BITS, PAIRS = 16, 64  # 64-bit words of a line's bitmaps, of its words and of its pairs

    def __init__(self, percent: int) -> None:
        self.percent, self.n = percent, 0
        self.bits, self.sizes, self.label = np.zeros((self.BITS, 16), np.uint64), np.zeros(16, np.int64), np.zeros(16, np.int64)
        self.lines: list[tuple[int, list[int]]] = []
        self.leader = 0  # a line of the component that was met last
        self.roots: dict[int, int] = {}  # the first line of each component known before
        self.paired: dict[int, np.ndarray] = {}  # bitmaps of pairs, of lines that needed one

    @staticmethod
    def bitmap(units: np.ndarray, wide: int) -> np.ndarray:
        bits = np.zeros(64 * wide, np.uint8)
        bits[(numbered(units) & np.uint64(64 * wide - 1)).astype(np.int64)] = 1
        return np.packbits(bits).view(np.uint64)

    def pairs(self, i: int) -> np.ndarray:
        if i not in self.paired:
            words = np.array(self.lines[i][1], np.uint64)
            self.paired[i] = self.bitmap(mixed((words[:-1] << np.uint64(32)) | words[1:]), self.PAIRS)
        return self.paired[i]

    def add(self, h: int, words: np.ndarray, root: int) -> Iterator[tuple[int, int]]:
        """Links of the line, which is of the component ``root``, to one line of each other component that holds a similar one."""
        n = self.n
        if n == len(self.sizes):
            self.bits, self.sizes, self.label = (np.concatenate([x, np.zeros_like(x)], axis=-1) for x in (self.bits, self.sizes, self.label))
        line = words.tolist()
        self.bits[:, n], self.sizes[n] = self.bitmap(words, self.BITS), len(line)
        self.lines.append((h, line))
        self.n += 1
        self.label[n] = self.label[self.roots[root]] if root in self.roots else n
        self.roots.setdefault(root, n)
        if n and self.label[self.leader] != self.label[n] and similar(line, self.lines[self.leader][1], self.percent):
            # In a block of alike lines this is the only test; the component's other lines need none.
            other = self.lines[self.leader][0]
            yield min(h, other), max(h, other)
            self.label[: n + 1][self.label[: n + 1] == self.label[n]] = self.label[self.leader]
        tested = np.flatnonzero(self.label[:n] != self.label[n])
        if not len(tested):
            return
        mine = self.bits[:, n, None]
        before = self.bits[:, :n] if 4 * len(tested) > n else self.bits[:, tested]
        least = np.maximum(np.bitwise_count(before & ~mine).sum(axis=0, dtype=np.uint16), np.bitwise_count(mine & ~before).sum(axis=0, dtype=np.uint16)).astype(np.int64)
        least, sizes = least[tested] if before.shape[1] == n else least, self.sizes[tested]
        most = (100 - self.percent) * np.maximum(sizes, len(line)) // 100
        allowed = np.maximum(least, np.abs(sizes - len(line))) <= most
        for i in tested[allowed][np.argsort(least[allowed], kind="stable")].tolist():
            if self.label[i] == self.label[n]:
                continue  # joined meanwhile
            other, theirs = self.lines[i]
            x, y, most = self.pairs(i), self.pairs(n), 2 * ((100 - self.percent) * max(len(theirs), len(line)) // 100)
            if np.bitwise_count(x & ~y).sum() <= most and np.bitwise_count(y & ~x).sum() <= most and similar(line, theirs, self.percent):
                yield min(h, other), max(h, other)
                self.leader = i
                self.label[: n + 1][self.label[: n + 1] == self.label[n]] = self.label[i]


def key_parts(docs: DataFrame, order: bytes, parts: int, conf: LineConf) -> DataFrame:
    """Keys of the prefix filter, packed: part (by the key's hash), and of a run's keys in that part k (32 bits more of it), h, n (units, and whether the line has all keys asked), at (place)."""
    shared = docs.sparkSession.sparkContext.broadcast(order)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.frombuffer(zstandard.decompress(shared.value), np.uint8)
        for lines, at in fresh_lines(batches):
            units, n = lines.units(at, conf)
            k, of, inside, full = prefix_keys(units, n, order, conf.percent)
            size = np.minimum(n, LONG) + full * (LONG + 1)
            part = (k % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            k, of, inside, part = k[by], of[by], inside[by], part[by]
            columns = [((k >> np.uint64(32)).astype(np.uint32), np.ndarray.tobytes), (lines.h[at][of], np.ndarray.tobytes), (size[of], bytes_of), (inside, bytes_of)]
            begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(part)), bool), part[1:] != part[:-1]]))
            bounds = list(zip(begin.tolist(), [*begin[1:].tolist(), len(part)]))
            packed = [pa.array([as_bytes(x[a:b]) for a, b in bounds], pa.binary()) for x, as_bytes in columns]
            yield pa.RecordBatch.from_arrays([pa.array(part[begin]), *packed], names=["part", "k", "h", "n", "at"])

    return docs.select(utf8().alias("text")).mapInArrow(run, "part long, k binary, h binary, n binary, at binary")


def meetings(parts: DataFrame, conf: LineConf) -> DataFrame:
    """a, b: pairs of classes to be tested (k null); or k, a: all classes (a) at a key of many (b null)."""

    def groups(part: int | None, rows: list[list[bytes]]) -> pa.RecordBatch:
        packed = list(zip(*rows)) or [()] * 4
        k, h = np.frombuffer(b"".join(packed[0]), np.uint32), np.frombuffer(b"".join(packed[1]), np.int64)
        n_units, inside = numbers_of(packed[2]), numbers_of(packed[3])
        by = np.argsort(k)
        shared = np.zeros(len(k) + 1, bool)  # most keys occur once
        shared[1:-1] = k[by][1:] == k[by][:-1]
        by = by[shared[1:] | shared[:-1]]
        by = by[np.lexsort((h[by], k[by]))]
        by = by[np.concatenate([np.ones(min(1, len(by)), bool), (k[by][1:] != k[by][:-1]) | (h[by][1:] != h[by][:-1])])]
        k, h, n_units, full, inside = k[by], h[by], n_units[by] & LONG, n_units[by] > LONG, inside[by]
        start = np.flatnonzero(np.concatenate([np.ones(min(len(k), 1), bool), k[1:] != k[:-1]]))
        size = np.diff(np.append(start, len(k)))
        left, right, weak = [], [], []
        for n in np.unique(size[(size > 1) & (size <= FEW)]).tolist():
            i, j = np.triu_indices(n, 1)
            keys = start[size == n][:, None]
            step = max(1, AT_ONCE // len(i))
            for at in (keys[c : c + step] for c in range(0, len(keys), step)):
                x, y = (at + i).ravel(), (at + j).ravel()
                allowed = (100 - conf.percent) * np.maximum(n_units[x], n_units[y]) // 100
                longer = n_units[x] - n_units[y]
                moved = inside[x] - inside[y]
                # Insertions and deletions before the pair, and after it.
                implied = np.where(np.maximum(inside[x], inside[y]) < LONG, np.abs(moved) + np.abs(longer - moved), np.abs(longer))
                able = (implied <= allowed) | (np.maximum(n_units[x], n_units[y]) == LONG)
                left.append(h[x[able]])
                right.append(h[y[able]])
                weak.append(~(full[x] & full[y])[able])
        a, b = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (left, right))
        times = np.where(np.concatenate([*weak, np.zeros(0, bool)]), COMMON, 1)
        a, b = np.minimum(a, b), np.maximum(a, b)
        by = np.lexsort((b, a))
        a, b, times = a[by], b[by], times[by]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        a, b, times = a[first], b[first], np.minimum(np.add.reduceat(times, first), COMMON) if len(first) else times
        many = np.repeat(size > FEW, size)
        no, some = len(a), int(many.sum())
        columns = [pa.array(np.concatenate([h[many], a])), pa.concat_arrays([pa.nulls(some, pa.int64()), pa.array(b)]), pa.concat_arrays([pa.array(k[many].astype(np.int64) + ((part or 0) << 32)), pa.nulls(no, pa.int64())]), pa.array(np.concatenate([np.full(some, COMMON), times]).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "k", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in batches:
            for p, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "k", "h", "n", "at"))):
                if p != part:
                    yield groups(part, rows)
                    part, rows = p, []
                rows.append(row)
        yield groups(part, rows)

    return parts.repartition("part").sortWithinPartitions("part").mapInArrow(run, "a long, b long, k long, times int").groupBy("a", "b", "k").agg(F.sum("times").alias("times")).where(F.col("times") >= COMMON).drop("times")


def fuzzy_links(docs: DataFrame, n_lines: int, conf: LineConf) -> DataFrame:
    """Returns a, b: linked classes that connect all alike ones. ``n_lines``: about how many there are.

    Each class is first tested against one other, which finds most groups by a test a class; all other pairs and keys count only
    across the components so far."""
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_lines * 16 // PART_KEYS)
    met = cut(meetings(key_parts(docs, sampled_order(docs, conf), parts, conf), conf))
    release(docs.sparkSession)
    known = cut(sequences(docs, conf).join(met.select(F.explode(F.array("a", "b")).alias("h")).where("h is not null").distinct(), "h", "left_semi").dropDuplicates(["h"]))
    release(docs.sparkSession)
    close = cut(_close(met.where("k is null").select("a", "b"), known, conf))
    roots = cut(components(_alike(close.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), known, conf))).withColumnRenamed("node", "h")
    root = lambda side: roots.select(F.col("h").alias(side), F.col("root").alias(f"r{side}"))
    apart = close.join(root("a"), "a", "left").join(root("b"), "b", "left").where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")
    links = roots.where("h <> root").select(F.col("h").alias("a"), F.col("root").alias("b")).union(_alike(apart, known, conf))
    if met.where("k is not null").isEmpty():
        return links
    blocks = met.where("k is not null").select("k", F.col("a").alias("h")).join(roots, "h", "left").withColumn("root", F.coalesce("root", "h"))
    # Keys whose classes are of one component by now have nothing to tell, and of keys at which the same classes meet one is enough.
    kinds = blocks.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("first"), F.max("root").alias("last"), F.bit_xor(F.xxhash64("h")).alias("x"), F.bit_xor(F.xxhash64("h", F.lit(1))).alias("y"))
    kinds = kinds.where("first <> last").groupBy("n", "x", "y").agg(F.min("k").alias("k")).select("k")
    blocks = blocks.join(kinds, "k", "left_semi").join(known.select("h", "w"), "h").select("k", "h", "root", "w")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for k, h, root, w in zip(*(batch.column(c).to_pylist() for c in ("k", "h", "root", "w"))):
                if k != key or block is None:
                    key, block = k, Block(conf.percent)
                out += block.add(h, np.frombuffer(w, np.uint32), root)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    # Dealt by number, as few bytes may be much work.
    return links.union(blocks.repartition(4 * docs.sparkSession.sparkContext.defaultParallelism, "k").sortWithinPartitions("k", "h").mapInArrow(run, "a long, b long"))


def _alike(pairs: DataFrame, known: DataFrame, conf: LineConf) -> DataFrame:
    """a, b: those pairs whose units reach the similarity asked."""
    of = lambda side: known.select(F.col("h").alias(side), F.col("w").alias(f"w{side}"))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = [[memoryview(x).cast("I").tolist() for x in batch.column(c).to_pylist()] for c in ("wa", "wb")]
            alike = pa.array([similar(x, y, conf.percent) for x, y in zip(*of)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(alike)

    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "wa", "wb").mapInArrow(test, "a long, b long")


def _close(pairs: DataFrame, known: DataFrame, conf: LineConf) -> DataFrame:
    """Pairs whose lengths and sketches allow the similarity asked."""
    for side in ("a", "b"):
        pairs = pairs.join(known.select(F.col("h").alias(side), *[F.col(c).alias(f"{c}{side}") for c in ("n", *SKETCH)]), side)
    allowed = F.floor(F.greatest("na", "nb") * F.lit(100 - conf.percent) / F.lit(100))
    apart = sum((F.bit_count(F.col(f"{c}a").bitwiseXOR(F.col(f"{c}b"))) for c in SKETCH), F.lit(0))
    return pairs.where((apart <= 2 * allowed) & (F.abs(F.col("na") - F.col("nb")) <= allowed)).select("a", "b")


def dedup_lines(docs: DataFrame, conf: LineConf = LineConf(), keep_empty: bool = True) -> DataFrame:
    """``docs`` with its texts less the repeated lines, and dropped_lines (array of places from 0)."""
    place = F.struct("doc_id", "rid", "line")
    lines = cut(line_table(docs))
    classes = cut(lines.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")))
    roots = components(fuzzy_links(docs, classes.count(), conf)).withColumnRenamed("node", "h")
    grouped = classes.join(roots, "h", "left")
    linked = grouped.where("root is not null")
    least = linked.groupBy("root").agg(F.min("first").alias("keep"))
    # Only classes with more than one occurrence, or in a group of several, can lose lines.
    keepers = linked.join(least, "root").select("h", "keep").union(grouped.where("root is null and n > 1").select("h", F.col("first").alias("keep")))
    gone = lines.join(keepers, "h").where(~place.eqNullSafe(F.col("keep")))
    per_doc = gone.groupBy("rid").agg(F.array_sort(F.collect_set("line")).alias("dropped_lines"))  # at most a document's lines
    names = [c for c in docs.columns if c != "dropped_lines"]
    # The documents' own columns travel in a struct, so that no name of theirs can meet one of these.
    out = docs.select(row_id().alias("rid"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc")).join(per_doc, "rid", "left")
    kept = F.filter(F.split("doc.text", "\n"), lambda x, i: ~F.array_contains(F.col("dropped_lines"), i))
    had = F.col("dropped_lines").isNotNull()
    out = out.withColumn("text", F.when(had, F.array_join(kept, "\n")).otherwise(F.col("doc.text")))
    if not keep_empty:
        out = out.where(~had | (F.length(F.trim(F.col("text"), F.lit(GAP_CHARS))) > 0))
    return out.select(*[F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in names], F.coalesce("dropped_lines", F.array().cast("array<int>")).alias("dropped_lines"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dedup_lines(docs)
    return found.select("doc_id", F.size("dropped_lines").cast("long").alias("n_dropped"), "dropped_lines", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.col("text"), 256).alias("kept_sha256"))
