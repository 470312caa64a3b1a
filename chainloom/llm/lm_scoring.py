"""Language-model scoring by logistic context mixing over bits.

A text is its words and one end. A token is coded as its bytes and a closing space, the end as one
line feed; each byte as eight binary decisions. For every decision several predictors give the log
odds that their own context has seen: hashed contexts (the last none to four bytes of the word,
each with the class of the words before), and the whole word so far, exactly, among all learning
words and among those of that class. Weights from a set that a gate chooses (how sure the exact
predictors are) mix the log odds; an adaptive table refines the mixed probability by what really
happened at that probability. Weights and refinement are learned online over all learning words.

The class of a token is the kind of text that the words before it point to: frequent words are
grouped by the company they keep, and the group that the text's last words name most often counts.
The model adapts while a text is scored: experts that trust, more or less, words that the text has
used before, and words that it has put after the word before, are weighed by how well they have
done so far. All of that is a distribution over texts; ``bits_per_byte`` is its cost.

What is gathered grows with the corpus: counts of all learning words, and of all by class, are kept
in distributed tables and joined with the words asked. Broadcast are the hashed contexts of parts of
words alone, in tables of fixed size (``TABLE_BITS``), as letters don't become more with the corpus.

Defined cases: null text counts as empty and has the end alone. Ids repeated are scored row by
row; a null id is not held out, but not learned from either. With no learning texts every
decision has probability one half. An empty table gives no rows. Very long texts and words are
handled in whole, long texts by themselves; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fold_of, table, utf8
from .shingles import mixed, word_hashes, word_hashes_of

END = b"\n"
#: Bits of the hash table of each hashed predictor: none to four bytes before, each with the class.
TABLE_BITS = (17, 19, 21, 21, 21)
HASHED = len(TABLE_BITS)
#: Then the exact predictors: the word so far among all words, and among those of its class.
ORDERS = HASHED + 2
#: Gates: how far in the word (from which byte), how sure the exact predictors are (0: don't know, then by the count's logarithm), in class
#: and among all, and the longest hashed one that knows. Far in a word that goes on as known ones do, exact predictors are trusted more from the start.
FAR, TRUST, SURE, KNOWS = (8, 32), (1.0, 1.5, 3.0), 5, 3
GATES = len(TRUST) * SURE * SURE * KNOWS
BUCKETS = 33
DELTA = 0.4
PRIME = np.uint64(0x9E3779B97F4A7C15)
BLOCKS = 16
CLASSES, FREQUENT, WINDOW = 8, 256, 24
#: Words that a task handles together, at least.
TOGETHER = 100_000
#: Bytes of texts that make one chunk, and decisions of one learning step.
CHUNK, AT_ONCE = 1 << 23, 8192
#: Bits of the place of a word with a class in its chunk.
PLACE_BITS = 28
#: Bytes of a word whose counts are global, the nodes of these, and bytes of a word that are sorted as one fixed field (longer ones are told apart by what follows, too).
HEAD, HEAD_NODES, PREFIX = 2, 256 * 257, 32
#: Places after PREFIX are handled so many pairs at a time.
FLAT = 1 << 10
#: Words with the same first bytes go to tasks by longer heads where they are more than SPLIT, or than a share of 1 / HEADS of all
#: words (so heavy heads of one length are no more than HEADS); heads are no longer than DEEPEST. Estimated from the words with one of SAMPLED hashes.
SPLIT, HEADS, DEEPEST, SAMPLED = 20_000, 4096, 255, 16
#: Experts: shares given to words used before in the text, and to words put after the word before.
EXPERTS = ((0.0, 0.0), (0.03, 0.0), (0.1, 0.0), (0.3, 0.0), (0.05, 0.3), (0.05, 0.7), (0.02, 0.93))


@dataclass(frozen=True)
class Conf:
    rate: float = 0.02


LOGS = np.log(np.arange(1 << 12) + DELTA).astype(np.float32)


def log_of(n: np.ndarray) -> np.ndarray:
    """log(n + DELTA); read from a list where n is small, as it nearly always is."""
    out = LOGS[np.minimum(n, len(LOGS) - 1)]
    large = np.flatnonzero(n >= len(LOGS))
    if len(large):
        out[large] = np.log(n[large] + DELTA)
    return out


#: 0 for a count of 0, else by counts of 1, 2 to 4, 5 to 31, more.
SURE_OF = np.digitize(np.arange(33), (1, 2, 5, 32))


def sure(n: np.ndarray) -> np.ndarray:
    return SURE_OF[np.minimum(n, 32)]


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def closed_of(word: bytes) -> bytes:
    return word if word == END else word + b" "


def after_byte(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The hash of what a word begins with, one byte longer."""
    return mixed(h * PRIME + byte.astype(np.uint64) + np.uint64(1))


class Deep:
    """Counts at the decisions inside of heads of more than HEAD bytes: all words that meet such a decision have such heads,
    so they follow from how often each head occurs in each class."""

    def __init__(self, heads: list[bytes], classes: np.ndarray, counts: np.ndarray) -> None:
        size = np.fromiter(map(len, heads), np.int64, len(heads))
        flat, start = np.frombuffer(b"".join(heads), np.uint8), np.cumsum(size) - size
        h, names, ones, n = np.zeros(len(heads), np.uint64), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for j in range(int(size.max(initial=0))):
            at = np.flatnonzero(size > j)
            byte = flat[start[at] + j]
            for b in range(8) if j >= HEAD else ():
                node, bit = node_of(byte, b)
                for g in (np.full(len(at), CLASSES + 1), classes[at]):
                    names.append(self._name(h[at], node, g))
                    ones.append(counts[at] * bit)
                    n.append(counts[at])
            h[at] = after_byte(h[at], byte)
        self.names, of = np.unique(np.concatenate(names), return_inverse=True)
        self.ones, n = (np.bincount(of, weights=np.concatenate(x), minlength=len(self.names)).astype(np.int64) for x in (ones, n))
        self.zeros = n - self.ones

    @staticmethod
    def _name(h: np.ndarray, node: np.ndarray, g: np.ndarray) -> np.ndarray:
        return mixed(mix_node(h, node) + PRIME * (g.astype(np.uint64) + np.uint64(1)))

    def counts(self, h: np.ndarray, node: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        name = self._name(h, node, g)
        at = np.minimum(np.searchsorted(self.names, name), len(self.names) - 1)
        found = self.names[at] == name
        return np.where(found, self.zeros[at], 0), np.where(found, self.ones[at], 0)


class Words:
    """Distinct pairs of a word and a class, laid out for the decisions of one byte after the other.

    Pairs come in order of class and closed word, so all that begin alike are neighbours: what an exact
    predictor counts at a decision is a sum over a run of neighbours. All words that share their head, the
    first ``heads`` bytes (HEAD, if not given), must be there; for the head's bytes themselves counts are
    global: see ``head_place`` for the first HEAD bytes, ``Deep`` for those after.
    """

    def __init__(self, words: list[bytes], classes: np.ndarray, counts: np.ndarray, heads: np.ndarray | None = None, deep: Deep | None = None) -> None:
        closed = np.array([closed_of(w) for w in words], object)
        short = np.array(closed.tolist(), f"S{PREFIX}")
        tails = self._tails(closed)
        self.order = np.lexsort((tails, short, classes))
        closed, short, tails = closed[self.order], short[self.order], tails[self.order]
        self.deep, self.heads = deep, np.full(len(closed), HEAD) if heads is None else heads[self.order]
        self.g, self.c = classes[self.order].astype(np.int64), counts[self.order].astype(np.int64)
        self.size = np.fromiter(map(len, closed.tolist()), np.int64, len(closed))
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(closed.tolist()), np.uint8)
        self.same = self._common(closed, short, self.g)
        # All words whatever their class: the place of each pair's word, a pair of each word, and the sums of their counts.
        by_name = np.lexsort((tails, short))
        fresh = np.ones(len(closed), bool)
        fresh[1:] = (short[by_name[1:]] != short[by_name[:-1]]) | (tails[by_name[1:]] != tails[by_name[:-1]])
        self.of_word = np.empty(len(closed), np.int64)
        self.of_word[by_name] = np.cumsum(fresh) - 1
        self.first = by_name[fresh]
        self.total = np.bincount(self.of_word, weights=self.c, minlength=len(self.first)).astype(np.int64)
        self.same_word = self._common(closed[self.first], short[self.first], np.zeros(len(self.first), np.int64))

    @staticmethod
    def _tails(closed: np.ndarray) -> np.ndarray:
        """The rank of what follows the first PREFIX bytes, 0 if nothing does."""
        out = np.zeros(len(closed), np.int64)
        long = [(w[PREFIX:], i) for i, w in enumerate(closed.tolist()) if len(w) > PREFIX]
        rank = {t: k for k, t in enumerate(sorted({t for t, _ in long}), 1)}
        for t, i in long:
            out[i] = rank[t]
        return out

    @staticmethod
    def _common(closed: np.ndarray, short: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Bits that each of the sorted words has in common with the one before, -1 at the first and where the class changes."""
        n = len(short)
        byte = np.ascontiguousarray(short).view(np.uint8).reshape(n, -1)
        out = np.full(n, -1, np.int64)
        apart = byte[1:] != byte[:-1]
        k = np.where(apart.any(axis=1), np.argmax(apart, axis=1), PREFIX) if n > 1 else np.zeros(0, np.int64)
        at = np.arange(1, n)
        x = np.where(k < PREFIX, byte[at, np.minimum(k, PREFIX - 1)] ^ byte[at - 1, np.minimum(k, PREFIX - 1)], 0)
        lead = 8 - np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)  # zero bits before the first one
        out[1:] = np.where(classes[1:] == classes[:-1], 8 * k + np.where(k < PREFIX, lead, 0), -1)
        for i in np.flatnonzero(out == 8 * PREFIX).tolist():  # alike so far: compare the rest
            x, y = (np.frombuffer(w, np.uint8, min(len(closed[i]), len(closed[i - 1])) - PREFIX, PREFIX) for w in (closed[i], closed[i - 1]))
            d = int(np.argmax(x != y))  # no closed word begins another one
            out[i] += 8 * d + 8 - int(x[d] ^ y[d]).bit_length()
        return out

    def _contexts(self, at: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
        """Hashes of the hashed predictors' contexts before the byte at a place of each pair."""
        h = (self.g[at].astype(np.uint64) + np.uint64(1)) * PRIME
        out = [h + np.minimum(place, 3).astype(np.uint64)]
        for k in range(1, HASHED):
            b = np.where(place >= k, self.flat[np.maximum(self.start[at] + place - k, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
            h = (h + b) * PRIME
            h ^= h >> np.uint64(29)
            out.append(h + np.uint64(k))
        return out

    def decisions(self) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray | None, list[np.ndarray] | None]]:
        """(pairs, where runs of pairs that are alike so far begin among them, and for each run: hashes of contexts with
        the bits before; for each pair its bit; for each run: place among head counts, exact counts of 0 and 1 among all and in class and how far in the word it is).

        A run meets one decision. The last two: places for the first HEAD bytes, counts then."""
        end, j, h = int(self.size.max(initial=0)), 0, np.zeros(len(self.size), np.uint64)
        while j < end:
            at, near = self._alive(self.size, self.same, j)
            # Of long words several places at once, as far as none of them ends.
            stop = j + 1 if j < max(PREFIX, self.heads.max(initial=0)) else max(j + 1, min(int(self.size[at].min()), j + FLAT // len(at)))
            place = np.repeat(np.arange(j, stop), len(at))
            if j >= HEAD:
                heads, near_head = self._alive(self.size[self.first], self.same_word, j)
                head_place_ = np.repeat(np.arange(j, stop), len(heads))
                where = np.full(len(self.first), -1, np.int64)
                where[heads] = np.arange(len(heads))
                where = (where[self.of_word[at]][None, :] + len(heads) * np.arange(stop - j)[:, None]).ravel()
                heads, near_head = np.tile(heads, stop - j), np.tile(near_head, stop - j)
                head_byte, head_c = self.flat[self.start[self.first[heads]] + head_place_], self.total[heads]
            at, near = np.tile(at, stop - j), np.tile(near, stop - j)
            byte = self.flat[self.start[at] + place]
            begin = np.flatnonzero(near < 8 * place)
            of_byte = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(at))))
            contexts = self._contexts(at[begin], place[begin])
            for b in range(8):
                runs = np.flatnonzero(near < 8 * place + b)
                node, bit = node_of(byte[runs], b)[0], node_of(byte, b)[1]
                hashes = [mix_node(c[of_byte[runs]], node) for c in contexts]
                if j < HEAD:
                    before = self.flat[self.start[at[runs]]].astype(np.int64) if j else None
                    yield at, runs, hashes, bit, head_place(self.g[at[runs]], before, node), None
                    continue
                starts = np.flatnonzero(near_head < 8 * head_place_ + b)
                every = counts_of(starts, head_c, node_of(head_byte, b)[1])
                mine = np.searchsorted(starts, where[runs], side="right") - 1
                counts = [every[0][mine], every[1][mine], *counts_of(runs, self.c[at], bit), np.searchsorted(FAR, place[runs], side="right")]
                in_head = np.flatnonzero(self.heads[at[runs]] > j)
                if len(in_head):
                    of = at[runs[in_head]]
                    for k, g in ((0, np.full(len(of), CLASSES + 1)), (2, self.g[of])):
                        counts[k][in_head], counts[k + 1][in_head] = self.deep.counts(h[of], node[in_head], g)
                yield at, runs, hashes, bit, None, counts
            if j < self.heads.max(initial=0):
                h[at] = after_byte(h[at], byte)
            j = stop

    @staticmethod
    def _alive(size: np.ndarray, same: np.ndarray, j: int) -> tuple[np.ndarray, np.ndarray]:
        """(those with a byte at ``j``, the bits that each has in common with the one before among them)."""
        at = np.flatnonzero(size > j)
        near = np.full(len(at), -1, np.int64)
        if len(at) > 1:
            near[1:] = np.minimum.reduceat(same[: at[-1] + 1], at[:-1] + 1)
        return at, near


def counts_of(runs: np.ndarray, c: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``c`` where the bit is 0 and where it is 1, of each run."""
    if not len(runs):
        return np.zeros(0, c.dtype), np.zeros(0, c.dtype)
    ones = np.add.reduceat(c * bit, runs)
    return np.add.reduceat(c, runs) - ones, ones


def node_of(byte: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(a 1 and the bits before bit ``b``, bit ``b``)."""
    node = np.uint64(1 << b) | (byte >> np.uint8(8 - b)).astype(np.uint64) if b else np.ones(len(byte), np.uint64)
    return node, ((byte >> np.uint8(7 - b)) & np.uint8(1)).astype(np.int64)


def mix_node(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    return (context ^ (node * PRIME)) * np.uint64(0xFF51AFD7ED558CCD)


def head_place(g: np.ndarray, before: np.ndarray | None, node: np.ndarray) -> np.ndarray:
    """Places of the counts of the first byte's nodes, and of the second's given the first, in each class."""
    return g * HEAD_NODES + node.astype(np.int64) + (0 if before is None else 256 * (before + 1))


def slot(k: int, h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - TABLE_BITS[k])).astype(np.int64)


def empty_tables() -> list[np.ndarray]:
    """Counts of 0 and 1 by slot of each hashed predictor; last those of the head's places, by tokens."""
    return [*(np.zeros(2 << b, np.int32) for b in TABLE_BITS), np.zeros(2 * HEAD_NODES * (CLASSES + 1), np.int64)]


def count_into(tables: list[np.ndarray], words: Words) -> None:
    """Each learning word counts once in each class it is met in, as how letters follow each other is learned
    from kinds of words; in the head it counts as often as it occurs."""
    known = (words.c > 0).astype(np.int64)
    for at, runs, hashes, bit, head, _ in words.decisions():
        kinds = counts_of(runs, known[at], bit)
        for b in (0, 1):
            some = np.flatnonzero(kinds[b])
            for k in range(HASHED):
                np.add.at(tables[k], slot(k, hashes[k][some]) * 2 + b, kinds[b][some].astype(np.int32))
        if head is not None:
            for b, n in enumerate(counts_of(runs, words.c[at], bit)):
                np.add.at(tables[HASHED], head * 2 + b, n)


class Mixer:
    """Weights by gate, and the refinement: a probability for each gate and bucket of mixed log odds."""

    def __init__(self, weights: np.ndarray | None = None, hits: np.ndarray | None = None, ones: np.ndarray | None = None) -> None:
        grid = np.tile(squash((np.arange(BUCKETS) - BUCKETS // 2) / 2.0), (GATES, 1))
        self.weights = first_weights() if weights is None else weights
        self.hits, self.ones = (np.zeros((GATES, BUCKETS)) if x is None else x for x in (hits, ones))
        self.refined = (self.ones + 32 * grid) / (self.hits + 32)

    def probability(self, gate: np.ndarray, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(final probability of a 1, mixed probability, nearest bucket)."""
        x = np.zeros(len(gate))
        for k in range(ORDERS):
            x += self.weights[:, k].take(gate) * inputs[k]
        p = squash(x)
        place = np.clip(x * 2.0 + BUCKETS // 2, 0, BUCKETS - 1.001)
        low = place.astype(np.int64)
        share = place - low
        r = self.refined[gate, low] * (1 - share) + self.refined[gate, low + 1] * share
        return np.clip((p + r) / 2, 1e-7, 1 - 1e-7), p, np.rint(place).astype(np.int64)

    def learn(self, gate: np.ndarray, inputs: np.ndarray, bit: np.ndarray, weight: np.ndarray, rate: float) -> None:
        _, p, near = self.probability(gate, inputs)
        error = (bit - p) * weight
        n = np.maximum(np.bincount(gate, weights=weight, minlength=GATES), 1e-9)
        for k in range(ORDERS):
            self.weights[:, k] += rate * np.bincount(gate, weights=error * inputs[k], minlength=GATES) / n
        cell = gate * BUCKETS + near
        self.hits += np.bincount(cell, weights=weight, minlength=GATES * BUCKETS).reshape(GATES, BUCKETS)
        self.ones += np.bincount(cell, weights=weight * bit, minlength=GATES * BUCKETS).reshape(GATES, BUCKETS)


def first_weights() -> np.ndarray:
    """Before anything is learned the surest exact predictor counts most, and without one the longest hashed one."""
    out = np.zeros((GATES, ORDERS))
    for gate in range(GATES):
        far, in_class, every, knows = gate // (SURE * SURE * KNOWS), gate // (SURE * KNOWS) % SURE, gate // KNOWS % SURE, gate % KNOWS
        out[gate, -1] = 0.25 * in_class
        out[gate, -2] = 0.2 * every if not in_class else 0.05 * every
        left = max(0.0, 1 - out[gate, -1] - out[gate, -2])
        out[gate, 2 + knows] = left * 0.8
        out[gate, 1 + knows] = left * 0.2
        out[gate, HASHED:] *= TRUST[far]
    return out


class Evidence:
    """Counts as they were gathered, and what they say of decisions."""

    def __init__(self, tables: list[np.ndarray]) -> None:
        self.tables, self.head = [t.reshape(-1, 2) for t in tables[:HASHED]], tables[HASHED]
        self.every = self.head.reshape(CLASSES + 1, -1).sum(axis=0)

    def of(self, hashes: list[np.ndarray], head: np.ndarray | None, counts: list[np.ndarray] | None, own: tuple = (0, 0), last: tuple = (0, 0)) -> tuple[np.ndarray, np.ndarray]:
        """(gate, inputs: a row each). ``own``: for each bit, occurrences of the token itself that don't count; ``last``: whether it is the only one of its kind."""
        inputs = np.zeros((ORDERS, len(hashes[0])), np.float32)
        knows = np.zeros(len(hashes[0]), np.int64)
        for k in range(HASHED):
            n = self.tables[k][slot(k, hashes[k])]
            n0, n1 = np.maximum(n[:, 0] - last[0], 0), np.maximum(n[:, 1] - last[1], 0)
            inputs[k] = log_of(n1) - log_of(n0)
            if k >= HASHED - 2:
                knows += n0 + n1 > 0
        if head is not None:
            of_all = head % HEAD_NODES
            counts = [self.every[2 * of_all], self.every[2 * of_all + 1], self.head[2 * head], self.head[2 * head + 1]]
        level = counts[4] if len(counts) > 4 else np.zeros(len(hashes[0]), np.int64)
        for k, at in ((HASHED + 1, 2), (HASHED, 0)):
            n0, n1 = np.maximum(counts[at] - own[0], 0), np.maximum(counts[at + 1] - own[1], 0)
            inputs[k] = log_of(n1) - log_of(n0)
            level = level * SURE + sure(n0 + n1)
        return level * KNOWS + knows, inputs


def learn_into(mixer: Mixer, evidence: Evidence, words: Words, rate: float) -> None:
    """One online pass over learning words; a word of count c weighs the root of c. What goes on alike after a run
    counts together, with one occurrence of its own taken out."""
    weight = np.sqrt(words.c)
    for at, runs, hashes, bit, head, counts in words.decisions():
        weights, totals = counts_of(runs, weight[at], bit), counts_of(runs, words.c[at], bit)
        use = np.concatenate([np.flatnonzero(n) * 2 + b for b, n in enumerate(totals)])
        use.sort()
        for s in range(0, len(use), AT_ONCE):
            u, b = use[s : s + AT_ONCE] >> 1, use[s : s + AT_ONCE] & 1
            alone = np.where(b == 1, totals[1][u], totals[0][u]) == 1
            gate, inputs = evidence.of([h[u] for h in hashes], None if head is None else head[u], None if counts is None else [x[u] for x in counts], (1 - b, b), (alone * (1 - b), alone * b))
            mixer.learn(gate, inputs, b.astype(np.float64), np.where(b == 1, weights[1][u], weights[0][u]), rate)


def rate_words(mixer: Mixer, evidence: Evidence, words: Words) -> np.ndarray:
    """log10 of each pair's probability, in the order in which they were given."""
    total = np.zeros(len(words.size))
    for at, runs, hashes, bit, head, counts in words.decisions():
        p = mixer.probability(*evidence.of(hashes, head, counts))[0]
        both = np.log10(np.stack([1 - p, p])).ravel()
        of = np.repeat(np.arange(len(runs)), np.diff(np.append(runs, len(at))))
        if np.any(at[1:] <= at[:-1]):  # several bytes of one word
            np.add.at(total, at, both[bit * len(runs) + of])
        else:
            total[at] += both[bit * len(runs) + of]
    out = np.empty(len(total))
    out[words.order] = total
    return out


def chunks(docs: DataFrame) -> DataFrame:
    """``docs``: doc_id, text (bytes), learn. One row a run of about CHUNK bytes: their tokens as places in a
    list of the run's distinct words, and how often each is in its learning texts."""

    def row_of(number: int, ids: list, texts: list[bytes], learn: list) -> pa.RecordBatch:
        hashes = list(word_hashes_of(texts))
        sizes = np.array([len(h) for h in hashes], np.int64)
        distinct, first, at = np.unique(np.concatenate([*hashes, np.zeros(0, np.uint64)]), return_index=True, return_inverse=True)
        del hashes
        ends = np.cumsum(sizes)
        order = np.argsort(first)
        owner = np.searchsorted(ends, first[order], side="right")
        words: list[bytes] = [b""] * len(distinct)
        split_of, split = -1, []
        for w, doc in zip(order.tolist(), owner.tolist()):
            if doc != split_of:
                split_of, split = doc, texts[doc].split()
            words[w] = split[int(first[w]) - int(ends[doc] - sizes[doc])]
        row = [[number], [ids], [sizes.tolist()], [[len(t) for t in texts]], [[bool(x) for x in learn]], [pack_places(at)], [zstandard.compress(b" ".join(words), 1)]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 2]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["chunk", "doc_ids", "sizes", "bytes", "learn", "tokens", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 14  # a task has some thousand chunks at most
        held: list[tuple] = []
        size = 0
        for batch in batches:
            ids, texts, learn = (batch.column(c) for c in ("doc_id", "text", "learn"))
            for i in range(batch.num_rows):
                held.append((ids[i].as_py(), texts[i].as_py().lower(), learn[i].as_py()))
                size += len(held[-1][1])
                if size >= CHUNK:
                    yield row_of(number, *(list(x) for x in zip(*held)))
                    number, held, size = number + 1, [], 0
        if held:
            yield row_of(number, *(list(x) for x in zip(*held)))

    return docs.mapInArrow(run, "chunk long, doc_ids array<long>, sizes array<long>, bytes array<long>, learn array<boolean>, tokens binary, words binary")


def pack_places(places: np.ndarray) -> bytes:
    """32-bit numbers, all their lowest bytes first: most of the others are small, and compress well together."""
    return zstandard.compress(np.ascontiguousarray(places.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpack_places(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Chunk:
    """A row of chunks(), read."""

    def __init__(self, batch: pa.RecordBatch, i: int) -> None:
        of = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)
        self.name = batch.column("chunk")[i].as_py()
        self.ids, self.sizes, self.bytes, self.learn = batch.column("doc_ids")[i].as_py(), of("sizes"), of("bytes"), of("learn").astype(bool)
        self.tokens = unpack_places(batch.column("tokens")[i].as_py())
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.packed = zstandard.decompress(batch.column("words")[i].as_py())
        if len(self.packed) and self.packed[:1] == END:  # no words, but the places of frequent ones, see slim()
            self.n, self.h = int.from_bytes(self.packed[1:9], "little"), None
            self.known = np.frombuffer(self.packed, np.int64, offset=9).reshape(2, -1)
        else:
            self.h = word_hashes(self.packed)  # in order: the list is sorted by it
            self.n = len(self.h)

    def slim(self, names: np.ndarray) -> bytes:
        """What classes() needs of the words: how many there are, and which are frequent."""
        found, at, place = np.intersect1d(self.h, names, assume_unique=True, return_indices=True)
        return zstandard.compress(END + self.n.to_bytes(8, "little") + np.stack([at, place]).astype(np.int64).tobytes(), 1)

    def words(self) -> list[bytes]:
        return self.packed.split()

    def frequent(self, names: np.ndarray) -> np.ndarray:
        """For each token its place among the frequent words (sorted by hash), -1: not among them."""
        at, place = self.known if self.h is None else np.intersect1d(self.h, names, assume_unique=True, return_indices=True)[1:]
        out = np.full(self.n, -1, np.int64)
        out[at] = place
        return out[self.tokens]

    def classes(self, names: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """The class of each token, then of each text's end: the group that most of the WINDOW tokens before name; CLASSES if none does."""
        kind = self.frequent(names)
        kind = np.where(kind >= 0, groups[kind], -1) if len(groups) else kind
        begin = np.cumsum(self.sizes) - self.sizes
        # Ends are tokens after all others here: the window of each token or end, as bounds in the token list.
        stop = np.concatenate([np.arange(len(kind)), begin + self.sizes])
        low = np.maximum(stop - WINDOW, np.concatenate([begin[self.doc], begin]))
        best, most = np.full(len(stop), CLASSES, np.int64), np.zeros(len(stop), np.int64)
        for g in range(CLASSES):
            n = np.concatenate([[0], np.cumsum(kind == g)])
            n = n[stop] - n[low]
            best, most = np.where(n > most, g, best), np.maximum(n, most)
        return best

    def pairs(self, names: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair of each token and end as word * (CLASSES + 1) + class, whether it is learned from); the end's word is one past the list."""
        word = np.concatenate([self.tokens, np.full(len(self.sizes), self.n)])
        return word * (CLASSES + 1) + self.classes(names, groups), np.concatenate([self.learn[self.doc], self.learn])


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, the place of each value among them) of numbers up to some times the words of a chunk: without a sort."""
    seen = np.zeros(int(values.max(initial=-1)) + 1, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen) - 1)[values]


def name_of(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """One 64-bit name for a word in a class."""
    return mixed(h + PRIME * (g.astype(np.uint64) + np.uint64(1))).view(np.int64)


def grouped(names: np.ndarray, together: np.ndarray) -> np.ndarray:
    """Groups of frequent words by the company they keep: their profiles of neighbours, unit vectors, around CLASSES
    centres, which begin as far apart as can be."""
    if not len(names):
        return np.zeros(0, np.int64)
    profile = np.sqrt(together + together.T)
    profile /= np.maximum(np.linalg.norm(profile, axis=1), 1e-9)[:, None]
    centres = profile[[int(np.argmax(together.sum(axis=1)))]]
    while len(centres) < min(CLASSES, len(names)):
        centres = np.vstack([centres, profile[int(np.argmin((profile @ centres.T).max(axis=1)))]])
    for _ in range(20):
        of = np.argmax(profile @ centres.T, axis=1)
        sums = np.stack([profile[of == k].sum(axis=0) if (of == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-9)[:, None]
    return np.argmax(profile @ centres.T, axis=1)


def _company(by_chunk: DataFrame, names: np.ndarray) -> np.ndarray:
    """How often one frequent word is the next frequent one after another in a learning text."""
    shared = by_chunk.sparkSession.sparkContext.broadcast(names)  # FREQUENT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(shared.value)
        out = np.zeros(n * n, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk(batch, i)
                kind = c.frequent(shared.value)
                at = np.flatnonzero((kind >= 0) & c.learn[c.doc])
                near = c.doc[at[1:]] == c.doc[at[:-1]]
                out += np.bincount(kind[at[:-1]][near] * n + kind[at[1:]][near], minlength=n * n)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], names=["i", "n"])

    found = np.zeros(len(names) ** 2, np.int64)
    for r in by_chunk.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():  # FREQUENT squared at most
        found[r["i"]] = r["n"]
    return found.reshape(len(names), len(names))


def read_words(batch: pa.RecordBatch, deep: Deep | None = None) -> Words:
    """A batch of k, word, g, c."""
    heads = np.fromiter(map(len, batch.column("k").to_pylist()), np.int64, batch.num_rows)
    return Words(batch.column("word").to_pylist(), batch.column("g").to_numpy(), batch.column("c").to_numpy(), heads, deep)


def head_of(closed: bytes, heavy: set[bytes]) -> bytes:
    """The shortest beginning, of HEAD bytes at least, that is not heavy."""
    k = closed[:HEAD]
    while k in heavy and len(k) < len(closed):
        k = closed[: len(k) + 1]
    return k


def heavy_heads(by_chunk: DataFrame, words: int) -> set[bytes]:
    """Beginnings that too many of the distinct words share for one task; no result depends on them, so a sample by hash does."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("words").to_pylist():
                packed = zstandard.decompress(packed)
                some = np.flatnonzero(word_hashes(packed) % np.uint64(SAMPLED) == 0).tolist()
                of = packed.split() if some else []
                yield pa.RecordBatch.from_arrays([pa.array([closed_of(of[i]) for i in some], pa.binary())], names=["word"])

    many = max(SPLIT, words // HEADS) / SAMPLED
    sample = by_chunk.select("words").mapInArrow(sampled, "word binary").distinct()
    out: set[bytes] = set()
    for low, high in ((HEAD, HEAD), (HEAD + 1, 8), (9, 32), (33, DEEPEST)):
        size = F.explode(F.sequence(F.lit(low), F.least(F.length("word"), F.lit(high)))).alias("n")
        long = sample.where(F.length("word") >= low)
        if low > HEAD:  # no more than HEADS
            long = long.where(F.substring("word", 1, low - 1).isin([k for k in out if len(k) == low - 1]))
        found = long.select("word", size).groupBy(F.expr("substring(word, 1, n)").alias("k")).count().where(F.col("count") > many)
        out |= {bytes(r["k"]) for r in found.collect()}
        if not any(len(k) == high for k in out):
            break
    return out


def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together so that words with the same head (``k``, sorted) are never parted."""
    held: list[pa.RecordBatch] = []

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column("k").to_pylist()
        if held and k[0] != held[-1].column("k")[-1].as_py() and sum(b.num_rows for b in held) >= TOGETHER:
            yield joined(held)
            held = []
        first = next((i for i in range(len(k) - 1, 0, -1) if k[i] != k[i - 1]), 0)
        if first and sum(b.num_rows for b in held) + first >= TOGETHER:
            yield joined([*held, batch.slice(0, first)])
            held, batch = [], batch.slice(first)
        held.append(batch)
    if held:
        yield joined(held)


def counted_tables(words: DataFrame, deep) -> list[np.ndarray]:
    """The hashed predictors' counts: each task sends its tables in compressed blocks, which are added by block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = empty_tables()
        for batch in whole(batches):
            count_into(tables, read_words(batch, deep.value))
        for k, t in enumerate(tables):
            for b, part in enumerate(np.split(t, BLOCKS)):
                some = np.flatnonzero(part).astype(np.uint32)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([b], pa.int32()), pa.array([zstandard.compress(np.diff(some, prepend=some[:1] * 0).tobytes(), 1)]), pa.array([zstandard.compress(part[some].tobytes(), 1)])], names=["k", "b", "i", "t"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for k, b, i, t in zip(*(batch.column(c).to_pylist() for c in ("k", "b", "i", "t"))):
                if (k, b) not in sums:
                    sums[k, b] = np.zeros(sizes[k] // BLOCKS, kinds[k])
                sums[k, b][np.cumsum(np.frombuffer(zstandard.decompress(i), np.uint32))] += np.frombuffer(zstandard.decompress(t), kinds[k])
        for (k, b), v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([b], pa.int32()), pa.array([zstandard.compress(v.tobytes(), 1)])], names=["k", "b", "t"])

    tables = empty_tables()
    sizes, kinds = [len(t) for t in tables], [t.dtype for t in tables]
    summed = words.mapInArrow(count, "k int, b int, i binary, t binary").repartition(BLOCKS * (HASHED + 1), "k", "b").mapInArrow(add, "k int, b int, t binary")
    for r in summed.collect():  # tables of fixed size
        part = np.frombuffer(zstandard.decompress(r["t"]), kinds[r["k"]])
        tables[r["k"]][r["b"] * len(part) : (r["b"] + 1) * len(part)] += part
    return tables


def sent(tables: list[np.ndarray]) -> list[bytes]:
    return [zstandard.compress(t.tobytes(), 1) for t in tables]


def received(packed: list[bytes]) -> Evidence:
    return Evidence([np.frombuffer(zstandard.decompress(x), np.int64 if k == HASHED else np.int32) for k, x in enumerate(packed)])


def learned_mixer(words: DataFrame, tables, deep, conf: Conf) -> Mixer:
    """Every task learns online over its words; weights are averaged by what each gate saw, the refinement's cells are added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, held = Mixer(), received(tables.value)
        for batch in whole(batches):
            learn_into(mixer, held, read_words(batch, deep.value), conf.rate)
        n = mixer.hits.sum(axis=1)
        values = np.concatenate([(mixer.weights * n[:, None]).ravel(), n, mixer.hits.ravel(), mixer.ones.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["i", "v"])

    found = np.zeros(GATES * (ORDERS + 1 + 2 * BUCKETS))
    for r in words.mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # of fixed size
        found[r["i"]] = r["v"]
    weights, n, hits, ones = np.split(found, np.cumsum([GATES * ORDERS, GATES, GATES * BUCKETS]))
    seen = n[:, None] > 0
    averaged = np.where(seen, weights.reshape(GATES, ORDERS) / np.where(seen, n[:, None], 1), first_weights())
    return Mixer(averaged, hits.reshape(GATES, BUCKETS), ones.reshape(GATES, BUCKETS))


def used_before(keys: np.ndarray) -> np.ndarray:
    """How many equal keys come earlier."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    fresh = np.concatenate([np.ones(min(1, len(k)), bool), k[1:] != k[:-1]])
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(k)), 0))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(k)) - start
    return out


def text_scores(sizes: np.ndarray, doc: np.ndarray, tokens: np.ndarray, n_words: int, p: np.ndarray) -> np.ndarray:
    """log10 of each text's probability. ``p``: log10 by the model of each token, then of each text's end.

    Experts mix the model with the text's own past; their weights are Bayesian, so the text's
    probability is the mean of theirs. An end is never in the past."""
    begin, n = np.cumsum(sizes) - sizes, len(tokens)
    i = np.concatenate([np.arange(n) - begin[doc], sizes])
    of = np.concatenate([doc, np.arange(len(sizes))])
    token = np.concatenate([tokens, np.full(len(sizes), n_words)])
    before = np.full(len(token), n_words + 1)  # a text's first token follows nothing
    later = np.flatnonzero(i > 0)
    before[later] = tokens[(np.concatenate([begin[doc], begin]) + i)[later] - 1]
    share = used_before(of * np.int64(n_words + 2) + token) / np.maximum(i, 1)
    # How often the word before was followed by something, and by this word.
    after = mixed(mixed((of * np.int64(n_words + 2) + before).astype(np.uint64)))
    followed = used_before(after.view(np.int64))
    follow = used_before(mixed(after ^ mixed(token.astype(np.uint64) + np.uint64(1))).view(np.int64)) / np.maximum(followed, 1)
    model, used = p * np.log(10), np.flatnonzero(share + follow > 0)
    each = []
    for a, b in EXPERTS:
        a_, b_ = np.where(i > 0, a, 0.0), np.where(followed > 0, b, 0.0)
        each_token = np.log(1 - a_ - b_) + model
        past = (a_ * share + b_ * follow)[used]
        some = past > 0
        each_token[used[some]] = np.logaddexp(each_token[used[some]], np.log(past[some]))
        each.append(np.bincount(of, weights=each_token, minlength=len(sizes)) / np.log(10))
    top = np.max(each, axis=0)
    return top + np.log10((10.0 ** (np.array(each) - top)).mean(axis=0))


def score_texts(docs: DataFrame, learn: F.Column, conf: Conf = Conf()) -> DataFrame:
    """``learn``: whether a document is learned from. Returns doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    by_chunk = cut(chunks(docs.select("doc_id", utf8().alias("text"), (F.coalesce(learn, F.lit(False)) & F.col("doc_id").isNotNull()).alias("learn"))))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk(batch, i)
                n = np.bincount(c.tokens, weights=c.learn[c.doc], minlength=len(c.h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c.h[n > 0].view(np.int64)), pa.array(n[n > 0])], names=["h", "c"])
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([int(c.learn.sum())])], names=["h", "c"])

    totals = cut(by_chunk.mapInArrow(counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    n, v, ends = totals.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("h"), F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("c"))), F.lit(0))).first()
    v += ends > 0
    top = totals.where("h is not null").orderBy(F.desc("c"), "h").limit(FREQUENT)
    names = np.sort(np.array([r["h"] for r in top.collect()], np.int64).view(np.uint64))
    groups = grouped(names, _company(by_chunk, names))
    heavy = heavy_heads(by_chunk, v)

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk(batch, i)
                pair, learned = c.pairs(names, groups)
                kinds, at = distinct(pair)
                words = [*c.words(), END]
                heads = [head_of(closed_of(w[: DEEPEST + 1])[: DEEPEST + 1], heavy) for w in words]
                kind = (kinds // (CLASSES + 1)).tolist()
                of = [words[x] for x in kind]
                yield pa.RecordBatch.from_arrays([pa.array([heads[x] for x in kind], pa.binary()), pa.array(of, pa.binary()), pa.array(kinds % (CLASSES + 1)), pa.array(np.bincount(at, weights=learned, minlength=len(kinds)).astype(np.int64))], names=["k", "word", "g", "c"])

    # No name is kept for what leads to a table that is cut: its shuffle files would stay as long.
    words = cut(by_chunk.mapInArrow(worded, "k binary, word binary, g long, c long").groupBy("k", "word", "g").agg(F.sum("c").alias("c")).repartition("k").sortWithinPartitions("k"))
    found = words.where(F.length("k") > HEAD).groupBy("k", "g").agg(F.sum("c").alias("c")).collect() if heavy else []  # the classes of what follows HEADS heavy heads of a length
    deep = spark.sparkContext.broadcast(Deep([bytes(r["k"]) for r in found], np.array([r["g"] for r in found], np.int64), np.array([r["c"] for r in found], np.int64)))
    tables = counted_tables(words, deep) if ends else empty_tables()
    shared = spark.sparkContext.broadcast(sent(tables))  # of fixed size
    mixer = learned_mixer(words, shared, deep, conf) if ends else Mixer()

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = received(shared.value)
        for batch in whole(batches):
            w = read_words(batch, deep.value)
            p = rate_words(mixer, held, w)
            given = batch.column("word").to_pylist()
            hashes = hashes_of(given)
            every = np.empty(len(given), np.int64)
            every[w.order] = w.total[w.of_word]
            yield pa.RecordBatch.from_arrays([pa.array(name_of(hashes, batch.column("g").to_numpy())), pa.array(every), pa.array(p.astype(np.float32))], names=["h", "c", "p"])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = Chunk(batch, i)
                kinds = distinct(c.pairs(names, groups)[0])[0]
                h = name_of(np.append(c.h, np.uint64(0))[kinds // (CLASSES + 1)], kinds % (CLASSES + 1))
                yield pa.RecordBatch.from_arrays([pa.array((c.name << PLACE_BITS) + np.arange(len(kinds))), pa.array(h)], names=["place", "h"])

    rated = cut(words.mapInArrow(rate, "h long, c long, p float"))
    met = by_chunk.mapInArrow(asked, "place long, h long").join(rated, "h").select("place", "c", "p")
    answers = met.groupBy(F.shiftright("place", PLACE_BITS).alias("chunk")).agg(F.collect_list(F.struct("place", "c", "p")).alias("a"))
    answers = answers.select("chunk", *[F.col(f"a.{k}").alias(f"a_{k}") for k in ("place", "c", "p")])  # a chunk's distinct words
    below = np.log10(n + 0.5 * (v + 1))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row)
                of = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
                order = np.argsort(of("a_place"))
                c, p = of("a_c")[order], of("a_p")[order].astype(np.float64)
                at = distinct(chunk.pairs(names, groups)[0])[1]
                docs_ = np.concatenate([chunk.doc, np.arange(len(chunk.sizes))])
                known, base = (np.bincount(docs_, weights=x, minlength=len(chunk.sizes)) for x in ((c > 0)[at].astype(np.float64), np.log10(c + 0.5)[at] - below))
                score = text_scores(chunk.sizes, chunk.doc, chunk.tokens, chunk.n, p[at])
                bits = -score * np.log2(10) / np.maximum(chunk.bytes, 1)
                columns = [pa.array(chunk.ids, pa.int64()), pa.array(chunk.sizes + 1), pa.array(known.astype(np.int64)), pa.array(np.full(len(chunk.sizes), n, np.int64)), pa.array(base), pa.array(score), pa.array(bits)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    def slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = pa.array([Chunk(batch, i).slim(names) for i in range(batch.num_rows)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names[:-1]), words], names=batch.schema.names)

    joined = by_chunk.mapInArrow(slim, by_chunk.schema).join(answers, "chunk")  # words move no more
    return joined.mapInArrow(add_up, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")


def hashes_of(words: list[bytes]) -> np.ndarray:
    """The hash of each word, the end's 0."""
    found = np.concatenate([*word_hashes_of([w for w in words if w != END]), np.zeros(0, np.uint64)])
    out, real = np.zeros(len(words), np.uint64), np.array([w != END for w in words], bool)
    out[real] = found
    return out


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, fold_of(F.col("doc_id"), 5) != 1)
    return scored.select("doc_id", (F.coalesce(fold_of(F.col("doc_id"), 5), F.lit(0)) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
