"""Vector codes, token counts and whitening against brute force."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainloom.llm import token_counts, vector_codes, whitening
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, label int, x string, code string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], VEC)


def odd_vectors(n=300, d=32, seed=3):
    r = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in r.normal(0, 0.2, d).round(2)], int(r.integers(4)) if i % 7 else None) for i in range(n)]
    rows += [(n, None, 1), (n + 1, [None] * d, 1), (n + 2, [float("nan")] + [0.0] * (d - 1), 1), (n + 3, [], 2), (None, rows[0][1], 3)]
    return rows + [(5, rows[5][1], 2), (n + 4, rows[9][1], 0), (n + 5, [0.0] * d, None), (n + 6, [float("inf")] * d, None)]


def coded(rows, entries=64, rounds=2):
    kept = [(i, [int(np.floor(np.float32(c).astype(float) * 256)) for c in v], label) for i, v, label in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // 16
    books = [[r[1][p * w : (p + 1) * w] for r in kept[:entries]] for p in range(16)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(16):
            of = {}
            for _, x, _ in kept:
                part = x[p * w : (p + 1) * w]
                of.setdefault(near(part, books[p])[1], []).append(part)
            books[p] = [[sum(c) // len(of[k]) for c in zip(*of[k])] if k in of else e for k, e in enumerate(books[p])]
    out, totals = [], {}
    for i, x, label in kept:
        found = [near(x[p * w : (p + 1) * w], books[p]) for p in range(16)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        totals[label] = totals.get(label, 0) + out[-1][3]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[label], digest) for i, label, c, e in out), key=repr)


@pytest.mark.parametrize("n", [300, 20])
def test_codes_equal_plain_rounds(spark, n):
    rows = odd_vectors(n)
    got = vector_codes.codes(vectors(spark, rows).repartition(5)).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == coded(rows)


def test_codes_with_many_labels(spark):
    rows = vectors(spark, odd_vectors(60))
    coded_rows = vector_codes.codes(rows).drop("label_error")
    a, b = (sorted(map(tuple, vector_codes.with_label_error(coded_rows, most=m).select("vec_id", "label_error").collect()), key=repr) for m in (100, 0))
    assert a == b


@pytest.mark.parametrize("integer", [False, True])
def test_bounds_never_hide_an_entry(integer):
    r = np.random.default_rng(7)
    kind = np.int64 if integer else np.float64
    for trial in range(30):
        x, book = r.integers(-6, 7, (200, 3)), r.integers(-6, 7, (40, 3))
        group = vector_codes.grouped(book, 4)
        at, best, low = vector_codes.nearest(x.astype(kind), book.astype(kind), group, None, None, None)
        for _ in range(4):
            full = ((x[:, None] - book[None]) ** 2).sum(axis=2)
            assert (at == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
            new = book + r.integers(-2, 3, book.shape) * (r.random((40, 1)) < 0.3)
            drift = np.sqrt(((new - book) ** 2.0).sum(axis=1))
            at, best, low = vector_codes.nearest(x.astype(kind), new.astype(kind), group, at, low, drift)
            book = new


def test_codes_of_other_lengths_and_none(spark):
    assert vector_codes.codes(vectors(spark, [])).count() == 0
    rows = [(1, [0.5] * 16, 1), (2, [0.25] * 32, 1), (3, [1.0] * 15, 1)]
    assert {r["vec_id"]: r["code"] for r in vector_codes.codes(vectors(spark, rows)).collect()} == {1: "00" * 16, 2: "00" * 16}


def test_codes_equal_sql(spark):
    assert_same(vector_codes.op11_vector_codes(spark, SF), connect(SF), vector_codes.ORACLE)


ODD = ["", " ", "a", "Hello  world's ", " <|endoftext|>x  <|endoftext|>", "a\n\n b\t\tc  \n", "日本語テキスト。中文", "é́ \U0001f600 \x85\xa0x　y​", "don't we'll I'd 'tis '' 12345 6,7", "x" * 300, " " * 90 + "a", "\x1c\x1d a\x1f", "<|endoftext|", "<|endoftext|><|endoftext|>", "a <|endoftext|> b"]


def texts(n, seed):
    r = random.Random(seed)
    bits = ODD + ["word", " the", "\n", "  ", "'s", "ab1", "--", "<|", "|>", "é", "文", "-", "\t"]
    return ["".join(r.choice(bits) for _ in range(r.randrange(1, 80))) for _ in range(n)]


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    return path, lambda s: len(t.encode(s, add_special_tokens=False).ids)


def test_counts_equal_library(plain):
    c = token_counts.counter(plain[0])
    for t in ODD + texts(300, 1):
        at, before = c.boundaries(t)
        assert c.count(t) == before[-1] == plain[1](t)
        assert all(plain[1](t[a:]) == before[-1] - b for a, b in list(zip(at.tolist(), before.tolist()))[:: max(1, len(at) // 8)])


DOC = "doc_id long, text string, n_bytes long, key string, i int"


def test_chunks_splice_to_the_whole(spark, plain):
    rows = [*ODD, None, *texts(120, 2), "x" * 5000, " " * 3000, "文字" * 900, "<|endoftext|>" * 200, "ab " * 1500]
    rows = [(k, t, 0, "k", 1) for k, t in enumerate(rows)] + [(None, "a b " * 50, 0, "k", 1)] * 3 + [(5, "twice " * 30, 0, "k", 1)] * 2
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    want = sorted(((i, len((t or "").encode()), plain[1](t or ""), plain[1](t or "") > 20) for i, t, *_ in rows), key=repr)
    for how in (token_counts.Cut(64, 32), token_counts.Cut(40, 8)):
        got = token_counts.token_counts(docs, plain[0], limit=20, huge=50, how=how)
        assert sorted(map(tuple, got.collect()), key=repr) == want


def test_counts_of_very_long_text_and_none(spark, plain):
    r = random.Random(4)
    long = " ".join(f"w{r.randrange(10**6)}" for _ in range(150_000)) + "y" * 40_000 + " end"
    got = token_counts.token_counts(spark.createDataFrame([(1, long, 0, "", 0)], DOC), plain[0]).collect()
    assert [tuple(x) for x in got] == [(1, len(long), plain[1](long), True)]
    assert token_counts.token_counts(spark.createDataFrame([], DOC), plain[0]).count() == 0


def exact(rows):
    """Integer vectors, the distinct ones, and their exact covariance."""
    kept = [(i, [int(np.floor(np.float32(c).astype(float) * 64)) + 10**6 for c in v]) for i, v, _ in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    y = fit * n - s
    return kept, n, s, np.array([[float(Fraction(int(c), n**3)) for c in row] for row in y.T @ y])


def test_whitening_equals_exact_covariance(spark):
    rows = odd_vectors(300, 24)
    kept, n, s, v = exact(rows)
    values, bases = np.linalg.eigh(v)
    values, bases = values[::-1][:16], bases[:, ::-1][:, :16]
    got = whitening.whitened(vectors(spark, rows).repartition(5)).collect()
    assert len(got) == 16 * len(kept) and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9
    want = {}
    for i, x in kept:
        want.setdefault(i, []).append((np.array([float(Fraction(int(n * c - t), n)) for c, t in zip(x, s)]) @ bases / np.sqrt(values), sum((n * c - t) ** 2 for c, t in zip(x, s))))
    sign = {}
    for r in got:
        k = r["component"] - 1
        w, deviation = want[r["vec_id"]][0]
        assert r["deviation"] == deviation and abs(r["explained"] - values[k] / np.trace(v)) < 1e-12
        if abs(w[k]) > 1e-6:
            assert sign.setdefault(k, np.sign(r["whitened"] * w[k])) * r["whitened"] == pytest.approx(w[k], rel=1e-7)


def test_outer_sums_hold_twice_double_precision():
    r = np.random.default_rng(2)
    x = r.normal(0, 1, (3000, 3)) * 10.0 ** r.integers(-9, 9, (3000, 3))
    h, l = whitening.outer_sums(x)  # noqa: E741
    for i in range(3):
        for j in range(3):
            true = sum(Fraction(a) * Fraction(b) for a, b in zip(x[:, i], x[:, j]))
            scale = sum(abs(Fraction(a) * Fraction(b)) for a, b in zip(x[:, i], x[:, j]))
            assert abs(Fraction(h[i, j]) + Fraction(l[i, j]) - true) < scale * Fraction(1, 2**58)


def test_whitening_without_variance(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    one = whitening.whitened(vectors(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["identity_error"]) for r in sorted(one)] == [(i, k, 1, 0, None, 0.0) for i in (1, 2) for k in (1, 2)]
    flat = whitening.whitened(vectors(spark, [(i, [float(i), 1.0, 2.0 * i], 0) for i in range(50)] + [(99, [1.0], 0)])).collect()
    assert {r["component"]: r["whitened"] is None for r in flat if r["vec_id"] == 7} == {1: False, 2: True, 3: True}
    assert [r["n"] for r in flat if r["vec_id"] == 99] == [1]


def test_deviations_beyond_64_bits_in_between():
    c = whitening.Centre(2**40, (2**40 * 3,))
    assert c.deviations(np.array([[3], [4]])) == [0, 2**80]


def test_queries_read_whole_tables(spark):
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert whitening.op13_whitening(spark, SF).count() == 16 * n
    counts = token_counts.op12_token_counts(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert counts.count() == docs.count() and counts.agg(F.sum("n_bytes")).first()[0] == docs.agg(F.sum(F.octet_length("text"))).first()[0]
