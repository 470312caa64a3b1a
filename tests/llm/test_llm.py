"""Each operator against brute force on small fixtures with nulls, ties, repeats and odd columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainloom.llm import language_id, line_dedup, lm_scoring, ngram_join, packing, piece_codec, quality_classifier, quality_rules, queries, topk, url_filter
from tests.oracle import assert_same, connect

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long, cid long, comp string, h string"


def documents(spark, texts, ids=None):
    """Extra columns carry names that operators use inside."""
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", "y") for i, t in zip(ids, texts)], DOC)


def prose(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


ODD = [None, "", " \n\t ", "one", "a b c d", "a b c d", "A B c D", "x" * 3000, "日本語 テキスト é́ \U0001f600"]


def near_copies():
    base = prose(300, 1, 10**6)
    out = [" ".join(base)]
    for k in range(1, 12):
        words = list(base)
        for j in range(k):
            words[(37 * j + 11 * k) % 300] = f"edit{k}_{j}"
        out.append(" ".join(words))
    return out + out[:2] + [" ".join(prose(200, s)) for s in range(5, 15)]


def jaccard_components(rows):
    sets, n = [], []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.append(s)
        n.append(len(s))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (n[i] + n[j] - both):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return sorted((d, n[i], min(least[find(i)])) for i, (d, _) in enumerate(rows))


def test_ngram_join(spark):
    texts = ODD + near_copies()
    ids = list(range(len(texts)))[::-1]
    docs = documents(spark, texts, ids)
    expected = jaccard_components(list(zip(ids, texts)))
    assert sorted(tuple(r) for r in ngram_join.jaccard_components(docs).collect()) == expected
    small = ngram_join.JoinConf(leaf=2, fan=2, chunk=3, hot_count=2)
    assert sorted(tuple(r) for r in ngram_join.jaccard_components(docs.repartition(3), small).collect()) == expected
    assert ngram_join.jaccard_components(docs.limit(0)).count() == 0


def test_ngram_join_links_through_null_ids(spark):
    """A text without an id links the two that are alike to it; a borderline group and strays around a large component."""
    words = prose(300, 2, 10**6)
    first, last = ["other", *words[1:-20]], words[20:]
    ids, texts = [1, 2, None, None], [" ".join(first), " ".join(last), " ".join(words), None]
    got = [(r.doc_id, r.component_id) for r in ngram_join.jaccard_components(documents(spark, texts, ids)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (None, 1), (None, None)], key=str)


def test_ngram_join_borderline_group(spark):
    """Hundreds of copies with up to two edits in 60 words: most pairs lie below the threshold, few above."""
    r, base, texts = random.Random(31), prose(60, 3, 10**6), []
    for k in range(300):
        words = list(base)
        for _ in range(r.randrange(3)):
            words[r.randrange(60)] = f"e{r.randrange(5)}"
        texts.append(" ".join(words))
    expected = jaccard_components(list(enumerate(texts)))
    docs = documents(spark, texts)
    for conf in (ngram_join.JoinConf(width=64, dense=1), ngram_join.JoinConf(width=64, chunk=40, leaf=8, fan=2, hot_count=4)):
        assert sorted(tuple(x) for x in ngram_join.jaccard_components(docs, conf).collect()) == expected


def test_similar_sets_join_what_is_alike():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[int(rng.integers(0, 14)) :], rng.integers(0, 2**63, int(rng.integers(1, 9)), dtype=np.uint64)])) for _ in range(80)]
    links = ngram_join.similar_sets(sets, np.arange(80), 80)
    root = list(range(80))
    for i, j in links:
        o = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o)
        root = [root[i] if x == root[j] else x for x in root]
    for i in range(80):
        for j in range(i):
            o = len(np.intersect1d(sets[i], sets[j]))
            assert root[i] == root[j] or 100 * o < 80 * (len(sets[i]) + len(sets[j]) - o)


def test_block_pairs_lose_nothing():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 120, dtype=np.uint64)
    sets = []
    for _ in range(150):
        k = int(rng.integers(0, 40))
        sets.append(np.unique(np.concatenate([rng.permutation(base)[k:], rng.integers(0, 2**63, int(rng.integers(0, 40)), dtype=np.uint64)])))
    conf = ngram_join.JoinConf(leaf=4, fan=3)
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    sets, n = [sets[i] for i in order], n[order]
    a, b = ngram_join.block_pairs(np.arange(150), n, np.arange(150), [ngram_join.bitmap(s, 4) for s in sets], None, conf, forest=False)
    found = set(zip(a.tolist(), b.tolist()))
    true = {(i, j) for i in range(150) for j in range(i + 1, 150) if 100 * (o := len(np.intersect1d(sets[i], sets[j]))) >= 80 * (n[i] + n[j] - o)}
    assert true and true <= found


def test_components_settle_or_raise(spark):
    from chainloom.llm.components import components

    links = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 21)], "a long, b long")
    assert {(r.node, r.root) for r in components(links).collect()} == {(i, 0) for i in range(10)} | {(20, 20), (21, 20)}
    with pytest.raises(RuntimeError, match="not settled"):
        components(links, rounds=1)


def test_lm_scoring(spark):
    texts = [" ".join(prose(60, s, 30)) for s in range(20)] + ODD
    docs = documents(spark, texts)
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [(t or "").encode().lower().split() + [b"\n"] for t in texts]
    c = collections.Counter(w for i, t in enumerate(tokens) if not held(i) for w in t)
    total, kinds = sum(c.values()), len(c)
    got = {r.doc_id: r for r in lm_scoring.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1).collect()}
    for i, t in enumerate(tokens):
        base = sum(np.log10((c[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(c[w] > 0 for w in t), total)
        assert got[i].base_score == pytest.approx(base) and got[i].score < 0
    # It learns: held-out texts of the learned words are far likelier than eight even bits a byte, and cost so much a byte.
    long = [i for i in range(20) if held(i)]
    assert sum(got[i].score for i in long) > 0.5 * sum(len(texts[i]) for i in long) * 8 * np.log10(0.5)
    assert all(got[i].bits_per_byte == pytest.approx(-got[i].score * np.log2(10) / max(1, len((t or "").encode()))) for i, t in enumerate(texts))
    assert lm_scoring.score_texts(docs.limit(0), F.lit(True)).count() == 0
    assert lm_scoring.score_texts(documents(spark, ["ab", None], [None, 5]), F.lit(False)).where("score < 0 and train_tokens = 0").count() == 2


def test_lm_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(8)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    r = lm_scoring.score_texts(docs, ~held).where(held).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] > r[1] and r[2] > 70_000


def lm_pairs(seed=3):
    r = random.Random(seed)
    words = sorted({bytes(r.choice(b"abc") for _ in range(r.randrange(1, 7))) for _ in range(60)} | {b"x" * 40 + b"abc", b"x" * 40 + b"abd", b"\xc3\xa9", b"x" * 32, b"x" * 32 + b"q", b"y" * 90, b"y" * 90 + b"z" * 50, b"x" * 31, b"z\x00\x00" * 20})
    pairs = [(w, g) for w in [*words, lm_scoring.END] for g in r.sample(range(lm_scoring.CLASSES + 1), 2)]
    return [w for w, _ in pairs], np.array([g for _, g in pairs]), np.array([r.choice((0, 1, 1, 3, 40)) for _ in pairs])


def test_lm_words_equal_a_scalar_reference():
    m = lm_scoring
    given, classes, counts = lm_pairs()
    words = m.Words(given, classes, counts)
    tables = m.empty_tables()
    m.count_into(tables, words)
    evidence, mixer = m.Evidence(tables), m.Mixer()
    m.learn_into(mixer, evidence, words, 0.02)
    mixer = m.Mixer(mixer.weights, mixer.hits, mixer.ones)
    got = m.rate_words(mixer, evidence, words)
    mask, prime = (1 << 64) - 1, int(m.PRIME)
    closed = [w if w == m.END else w + b" " for w in given]
    level = lambda n: sum(n >= x for x in (1, 2, 5, 32))
    odds = lambda n0, n1: float(np.log(np.float64((n1 + m.DELTA) / (n0 + m.DELTA))).astype(np.float32))
    seen: dict = {}
    for w, g, c in zip(closed, classes.tolist(), counts.tolist()):  # counts by all bits before, and by hashed contexts
        for depth in range(8 * len(w)):
            bits = int.from_bytes(w, "big") >> (8 * len(w) - depth)
            bit = w[depth // 8] >> (7 - depth % 8) & 1
            for key in ((g, depth, bits), (None, depth, bits)):
                seen.setdefault(key, [0, 0])[bit] += c
    for i in range(0, len(given), 3):
        w, g, total = closed[i], int(classes[i]), 0.0
        for depth in range(8 * len(w)):
            j, b = divmod(depth, 8)
            bits, bit, node = int.from_bytes(w, "big") >> (8 * len(w) - depth), w[j] >> (7 - b) & 1, (1 << b) | (w[j] >> (8 - b))
            h, inputs, knows = (g + 1) * prime & mask, [], 0
            for k in range(m.HASHED):
                if k:
                    h = (h + (w[j - k] + 1 if j >= k else 0)) * prime & mask
                    h ^= h >> 29
                context = h + (min(j, 3) if k == 0 else k) & mask
                s = ((context ^ node * prime & mask) * 0xFF51AFD7ED558CCD & mask) >> (64 - m.TABLE_BITS[k])
                n0, n1 = tables[k][2 * s : 2 * s + 2].tolist()
                inputs.append(odds(n0, n1))
                knows += k >= m.HASHED - 2 and n0 + n1 > 0
            every, mine = (seen[k, depth, bits] for k in (None, g))
            inputs += [odds(*every), odds(*mine)]
            far = (j >= 8) + (j >= 32)
            gate = ((far * m.SURE + level(sum(mine))) * m.SURE + level(sum(every))) * m.KNOWS + knows
            x = sum(float(a) * b for a, b in zip(mixer.weights[gate], inputs))
            p = 1 / (1 + np.exp(-max(-30, min(30, x))))
            place = max(0, min(m.BUCKETS - 1.001, 2 * x + m.BUCKETS // 2))
            low = int(place)
            r = mixer.refined[gate][low] * (1 - place + low) + mixer.refined[gate][low + 1] * (place - low)
            q = max(1e-7, min(1 - 1e-7, (p + r) / 2))
            total += np.log10(q if bit else 1 - q)
        assert got[i] == pytest.approx(total, rel=1e-5)


def test_lm_words_are_a_distribution():
    """All words of two letters up to six long, the empty one and the end: learned from a part, they share nearly all probability, and no more."""
    import itertools

    m = lm_scoring
    every = [bytes(x) for n in range(7) for x in itertools.product(b"ab", repeat=n)] + [m.END]
    counts = np.array([k % 3 * 20 for k in range(len(every))])
    words = m.Words(every, np.zeros(len(every), np.int64), counts)
    tables = m.empty_tables()
    m.count_into(tables, words)
    evidence, mixer = m.Evidence(tables), m.Mixer()
    m.learn_into(mixer, evidence, words, 0.02)
    p = m.rate_words(mixer, evidence, words)
    assert 0.8 < (10.0**p).sum() <= 1 + 1e-9
    # Words that begin otherwise don't matter to a word, so parts of the words give the same.
    for k in {w[:2] for w in every}:
        at = [i for i, w in enumerate(every) if w[:2] == k]
        part = m.rate_words(mixer, evidence, m.Words([every[i] for i in at], np.zeros(len(at), np.int64), counts[at]))
        assert part == pytest.approx(p[at])


def test_lm_words_with_longer_heads_give_the_same():
    """Words parted by heads of any length, with counts inside of the heads from all of them, are rated as in one place."""
    m = lm_scoring
    given, classes, counts = lm_pairs(4)
    words = m.Words(given, classes, counts)
    tables = m.empty_tables()
    m.count_into(tables, words)
    evidence, mixer = m.Evidence(tables), m.Mixer()
    m.learn_into(mixer, evidence, words, 0.02)
    p = m.rate_words(mixer, evidence, words)
    heavy = {b"x" * n for n in range(2, 42)} | {b"ab", b"aba", b"abac", b"yy", b"b "}
    heads = [m.head_of(m.closed_of(w), heavy) for w in given]
    deep = m.Deep([h for h in heads if len(h) > m.HEAD], classes[[len(h) > m.HEAD for h in heads]], counts[[len(h) > m.HEAD for h in heads]])
    assert max(map(len, heads)) == 41 and len(set(heads)) > 15
    parts = m.empty_tables()
    for k in sorted(set(heads)):
        at = [i for i, h in enumerate(heads) if h == k]
        part = m.Words([given[i] for i in at], classes[at], counts[at], np.full(len(at), len(k)), deep)
        assert m.rate_words(mixer, evidence, part) == pytest.approx(p[at])
        m.count_into(parts, part)
    assert all((a == b).all() for a, b in zip(tables, parts))


def test_lm_long_words_are_known_in_whole(spark, monkeypatch):
    """Texts of words of one length: however long these are, learned words are likely; also where heads of words are split."""
    r, rates = random.Random(8), {}
    for letters, n in (("abcdefghijklmnopqrstuvwxyz", 20), ("abcdefghijklmnopqrstuvwxyz", 120), ("\u4e2d\u6587\u5b57\u65e5\u672c\u8a9e\u6c34\u706b", 40)):
        vocabulary = ["".join(r.choice(letters) for _ in range(n)) for _ in range(100)]
        docs = documents(spark, [" ".join(r.choice(vocabulary) for _ in range(80)) for _ in range(100)]).cache()
        for split in (lm_scoring.SPLIT, 3) if n == 120 else (lm_scoring.SPLIT,):
            monkeypatch.setattr(lm_scoring, "SPLIT", split)
            held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
            got = lm_scoring.score_texts(docs, ~held).where(held).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
            rates[n, split] = (got[0] - got[1]) / got[2]
    # Log10 a token against the base score, which has no letters to tell apart and of which 8,000 tokens are all there is to learn from.
    assert min(rates.values()) > -0.5 and max(rates.values()) - min(rates.values()) < 0.2, rates


def test_lm_one_very_long_word():
    """Two words of a million bytes that differ at the end alone: each decision is met, at the price of its bytes."""
    m = lm_scoring
    given = [b"ab" * 500_000 + b"c", b"ab" * 500_000 + b"d", b"ab"]
    words = m.Words(given, np.zeros(3, np.int64), np.array([5, 0, 1]))
    tables = m.empty_tables()
    m.count_into(tables, words)
    p = m.rate_words(m.Mixer(), m.Evidence(tables), words)
    assert sum(len(runs) for _, runs, *_ in words.decisions()) < 8 * 1_000_010
    assert (p < 0).all() and p[0] > p[1]


def test_lm_texts_equal_a_scalar_reference():
    m, r = lm_scoring, random.Random(5)
    texts = [[r.randrange(6) for _ in range(n)] for n in (0, 1, 30, 2, 80)]
    sizes = np.array([len(t) for t in texts])
    p = np.array([-r.random() * 3 - 0.1 for _ in range(sizes.sum() + len(texts))])
    got = m.text_scores(sizes, np.repeat(np.arange(len(texts)), sizes), np.array(sum(texts, [])), 6, p)
    at = 0
    for d, text in enumerate(texts):
        each = []
        for a, b in m.EXPERTS:
            total = 0.0
            for i, w in enumerate([*text, None]):
                q = 10 ** (p[at + i] if w is not None else p[sizes.sum() + d])
                pairs = list(zip(text[:i], text[1 : i] ))
                follows = [y for x, y in pairs if i and x == text[i - 1]]
                a_, b_ = a if i else 0, b if follows else 0
                total += np.log10((1 - a_ - b_) * q + (a_ * text[:i].count(w) / i if i else 0) + (b_ * follows.count(w) / len(follows) if follows else 0))
            each.append(10**total)
        at += len(text)
        assert got[d] == pytest.approx(np.log10(sum(each) / len(each)))


def test_piece_codec(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(4)
    letters = [*"abcde tionsher  éèß\n\tAB01.,!?▁日本語執\U0001f600\x00", "the", " in", "ation", "    "]
    texts = ODD + ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(500)]
    got = {x.doc_id: x for x in piece_codec.encode_column(documents(spark, texts), path, digest=True).collect()}
    for i, t in enumerate(texts):
        ids = sp.encode(t or "", add_eos=True)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    real = piece_codec.encode_column(documents(spark, ["Hello there"]), path).first()
    assert (real.ids, real.decoded) == (sp.encode("Hello there", add_eos=True), "Hello there")


def test_top_k(spark):
    r = np.random.default_rng(5)
    rows = [(i, [float(x) for x in r.normal(size=8)]) for i in range(400)] + [(400, rows_tie := [0.5] * 8), (401, rows_tie), (500, None), (600, [float("nan")] * 8), (700, [None] + [0.0] * 7), (800, [1.0, 2.0]), (900, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    v = topk.integers(df)
    got = topk.top_k(v.where("vec_id % 100 = 0"), v, 10, shard_rows=50, block_rows=2).collect()
    whole = {i: [int(np.floor(float(np.float32(x)) * 1024)) for x in e] for i, e in rows if e and all(x is not None and np.isfinite(x) for x in e)}
    expected = set()
    for q in (i for i in whole if i % 100 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], e)), i) for i, e in whole.items() if i != q and len(e) == len(whole[q]))[:10]
        expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(x) for x in got} == expected


def test_quality_classifier(spark):
    good = [" ".join(prose(80, s)) for s in range(60)]
    bad = [" ".join(w + "%%%" for w in prose(80, 100 + s)) for s in range(60)]
    docs = documents(spark, good + bad + ODD)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120) if i % 4 != 2] + [(1, None, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_classifier.score(docs, quality_classifier.fit(docs, labels, quality_classifier.Training(updates=3000))).collect()}
    held = [i for i in range(120) if i % 4 == 2]
    assert sum(got[i].predicted == int(i < 60) for i in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == docs.count()
    assert {r.score for r in quality_classifier.score(docs, quality_classifier.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_features_count_each_occurrence():
    f = quality_classifier
    # Words 2, 3-grams with edges 3 + 2, 4-grams 2 + 1, 5-grams 1, no lag.
    assert sum(map(len, f.features(b"abc de"))) == 2 + (3 + 2) + (2 + 1) + 1
    assert list(f.features(b"  ")) == []


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    texts = ODD + [" ".join(prose(n, n)) for n in (5, 100, 700, 1500, 2000, 900, 40, 350)] + ["It's <|endoftext|> DON'T ½ Σσ"]
    got = packing.best_fit(documents(spark, texts), path, 512, shard_rows=10).collect()
    taken = collections.defaultdict(list)
    for r in got:
        taken[r.sequence_id].append((r.offset, r.length))
    for places in taken.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == i)
        assert mine == [(k, k * 512, len(p := ids[k * 512 : (k + 1) * 512]), zlib.crc32(np.array(p, "<u4").tobytes())) for k in range(-(-len(ids) // 512))]


def test_sums_of_squares_is_tight():
    r = np.random.default_rng(6)
    lengths = r.integers(1, 1200, 4000)
    bins, offsets = packing.pack_lengths(lengths)
    assert np.bincount(bins, weights=lengths).max() <= 2048
    assert bins.max() + 1 <= 1.01 * np.ceil(lengths.sum() / 2048) + 1


def test_an_open_sequence_that_fits_is_preferred():
    bins, offsets = packing.pack_lengths(np.array([6, 6, 3, 3]), 10)
    assert bins.tolist() == [0, 1, 0, 1] and offsets.tolist() == [0, 0, 6, 6]


def test_line_dedup(spark):
    long = prose(40, 7)
    edited = [*long[:20], "changed", *long[21:]]
    texts = [" ".join(long) + "\nfirst of its own", " ".join(edited) + "\nSame Line Here 12", "same line here 34\nanother line stays here", "same line here 34\nsame line here 34", *ODD]
    docs = documents(spark, texts)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[0].dropped_lines == [] and got[0].text == texts[0]
    assert got[1].dropped_lines == [0] and got[1].text == "Same Line Here 12"
    assert got[2].text == "another line stays here"
    assert got[3].text == "" and got[4].text is None and set(got[2].asDict()) == set(docs.columns) | {"dropped_lines"}
    kept = {r.doc_id for r in line_dedup.dedup_lines(docs, keep_empty=False).collect()}
    assert 3 not in kept and {0, 1, 2, 4, 5, 6} <= kept
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def letters(n, r):
    """Digits are all one in lines."""
    return ["".join(r.choice("abcdefghij") for _ in range(7)) for _ in range(n)]


def test_line_dedup_misses_no_alike_pair(spark):
    r = random.Random(12)
    texts, pairs = [], []
    for n in (4, 5, 9, 10, 20, 50, 120):
        for share in (1, 5, 10, 15, 20):
            for _ in range(6):
                line = letters(n, r)
                other = list(line)
                for _ in range(max(1, n * share // 100)):
                    at = r.randrange(len(other))
                    kind = r.randrange(3)
                    other[at : at + (kind > 0)] = letters(kind < 2, r)
                longer = max(len(line), len(other))
                pairs.append((len(texts), line_dedup.edits(line, other) <= longer * 20 // 100))
                texts += [" ".join(line), " ".join(other)]
    got = {x.doc_id: x.dropped_lines for x in line_dedup.dedup_lines(documents(spark, texts)).collect()}
    assert sum(alike for _, alike in pairs) > 100 and not all(alike for _, alike in pairs)
    assert [(i, got[i + 1] == [0]) for i, _ in pairs] == pairs and all(got[i] == [] for i, _ in pairs)


def test_line_dedup_tests_large_blocks(spark):
    line = letters(40, random.Random(21))
    texts = [" ".join([*line[:k], "other", *line[k + 1 :]]) for k in range(40)] * 2
    got = [x.dropped_lines for x in line_dedup.dedup_lines(documents(spark, texts)).orderBy("doc_id").collect()]
    assert got == [[]] + [[0]] * 79


def test_line_dedup_takes_short_lines(spark):
    texts = ["Menu\n今日は天気がとても良いので散歩に行きました", "menu\nLog in\n今日は天気がとても良いので公園に行きました", "Log in\nSubscribe now!\nHouse", "log in\nSubscribe now.\nHorses\n明日は雨が降る"]
    got = [x.text for x in line_dedup.dedup_lines(documents(spark, texts)).orderBy("doc_id").collect()]
    assert got == [texts[0], "Log in", "Subscribe now!\nHouse", "Horses\n明日は雨が降る"]


def test_edits():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    r = random.Random(8)
    for _ in range(500):
        a, b = ([r.randrange(5) for _ in range(r.randrange(12))] for _ in range(2))
        assert line_dedup.edits(a, b) == plain(a, b)


def test_language_id(spark):
    r = random.Random(9)
    say = lambda parts: " ".join("".join(r.choice(parts) for _ in range(3)) for _ in range(40))
    en, de = ["the", "ing", "and", "tion", "er"], ["sch", "ung", "ein", "heit", "ü"]
    rows = [(i, say(en if i % 2 else de), "en" if i % 2 else "de") for i in range(60)]
    df = spark.createDataFrame([*rows, (90, None, "en"), (91, "123 !!", None), (92, "", "de")], "doc_id long, text string, lang string")
    found = {x.doc_id: x for x in language_id.identify(df, language_id.learn(df.where("doc_id < 40"))).collect()}
    assert all(found[i].lang_pred == lang for i, _, lang in rows)
    assert {found[i].lang_pred for i in (90, 91, 92)} == {"und"} and all(0 <= x.score <= 1 for x in found.values())
    assert {x.lang_pred for x in language_id.identify(df, []).collect()} == {"und"}


def test_url_filter(spark):
    urls = ["http://a.example.net/en/1", "https://b.NET/x", "http://z.example.com/de/3?q=1", "http://q.org/fr/4#x", "http://bad.com/en/5", None, "no scheme", "http://net/", "http://xnet/", "http://x.net"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labelled = spark.createDataFrame([("bad.com", 1)] * 50 + [("good.com", 0)] * 50, "host string, bad int")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, labelled).collect()}
    assert [got[i].rule for i in range(10)] == ["example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None, "net/", None, None]
    assert [got[i].verdict for i in range(5)] == ["allow", "block", "block", "allow", "block"]
    assert (got[5].host, got[5].path, got[6].host) == ("", "", "") and got[2].path == "/de/3"
    assert url_filter.filter_urls(pages, labelled.limit(0)).where("verdict = 'block'").count() == 3


def counted(text):
    w = [x for x in re.split("[\x20\x09-\x0d]+", text or "") if x]
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark):
    texts = [*ODD, "a b c d e a b c d e a b c d e f", "x y\nx y\n\nx y", "# * $ % & | < >", *[" ".join(prose(50, s, 6)) for s in range(10)]]
    got = {r.doc_id: r for r in quality_rules.judge(documents(spark, texts), []).collect()}
    for i, t in enumerate(texts):
        n = counted(t)
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == n
        assert got[i].base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0]) and got[i].kept == (not got[i].base_failed)
    clean, junk = [" ".join(prose(60, s)) for s in range(80)], [" ".join(w + "|" for w in prose(60, 200 + s)) for s in range(80)]
    docs = documents(spark, clean + junk)
    labels = spark.createDataFrame([(i, int(i < 80), 0) for i in range(160)], "doc_id long, quality int, toxic int")
    rules = quality_rules.fit(docs, labels)
    kept = {r.doc_id for r in quality_rules.judge(docs, rules).where("kept").collect()}
    assert rules and kept == set(range(80))
    assert quality_rules.fit(docs, labels.where("quality = 1")) == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    assert_same(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name])


def test_pipeline_rules_learn_from_all_labels(spark, tmp_path):
    import corpus_pipeline

    clean, junk = [" ".join(prose(60, s)) for s in range(80)], [" ".join(w + "|" for w in prose(60, 200 + s)) for s in range(90)]
    docs = documents(spark, clean + junk)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 80), 0) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    # The stage before has left no labelled junk, but some without a label.
    left = docs.where("doc_id < 80 or doc_id >= 160")
    assert {r.doc_id for r in corpus_pipeline.rules(spark, left, str(tmp_path)).collect()} == set(range(80))


def test_pipeline(spark):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert 0 < docs.count() <= before
    assert docs.count() < before
    packed = corpus_pipeline.pack(spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    """Repeated ids, nulls, repeats, and columns whose names operators use."""
    import corpus_pipeline

    kind = DOC + ", n_words string, kept string, dropped_lines string, row string, base_failed string"
    a, other = letters(60, random.Random(1)), " ".join(letters(60, random.Random(2)))
    near = " ".join([*a[:-1], "changed"])
    rows = [(1, " ".join(a)), (1, " ".join(a)), (2, near), (2, other), (None, near), (None, other + "\n" + other), (5, None), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", "y", "mine", "k", "d", "r", "b") for i, t in rows], kind)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    of = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and of(kept) == sorted([(1, " ".join(a)), (2, other), (5, None), (5, None), (6, "")], key=str)
    good = corpus_pipeline.rules(spark, docs, str(tmp_path))
    assert good.columns == docs.columns and of(good) == sorted([r for r in rows if r[1] and not r[1].startswith(other + "\n")], key=str)
    assert {(r.n_words, r.kept, r.row, r.base_failed) for r in good.collect()} == {("mine", "k", "r", "b")}
    lines = corpus_pipeline.lines(spark, docs, str(tmp_path))
    assert lines.columns == docs.columns and {r.dropped_lines for r in lines.collect()} == {"d"}
    # The null id comes first: its lines stay, and all that are like them go elsewhere.
    assert of(lines) == sorted([(None, near), (None, other), (5, None), (5, None), (6, "")], key=str)
    assert corpus_pipeline.classify(spark, docs, str(tmp_path)).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_empty_tables_and_null_ids(spark):
    import public_tokenizers

    docs = documents(spark, ["some words here", None], [None, None])
    assert {r.lang_pred for r in language_id.identify(docs.limit(0), []).collect()} == set()
    assert packing.best_fit(docs.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert piece_codec.encode_column(docs.limit(0), public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert quality_rules.judge(docs.limit(0), []).count() == 0 and quality_rules.judge(docs, []).count() == 2
    v = topk.integers(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert topk.top_k(v, v).count() == 0


@pytest.mark.parametrize("bits", [24, 3, 56, 62])
def test_repeated_words_by_any_sort(spark, monkeypatch, bits):
    """Few bits for places: pairs are sorted; many: hashes share what is left of them."""
    monkeypatch.setattr(quality_rules, "PLACE_BITS", bits)
    r = np.random.default_rng(8)
    texts = [" ".join(map(str, r.integers(0, top, n))) for top, n in ((2, 60), (3, 200), (9, 9), (4, 900), (1, 30), (10**6, 300))] + ["a b c d e " * 3 + "x y z " + "a b c d e f", "a b c d", ""]
    got = {x.doc_id: x.n_repeat_words for x in quality_rules.counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        windows = [tuple(w[j : j + 5]) for j in range(len(w) - 4)]
        covered = {j + o for j, x in enumerate(windows) if windows.count(x) > 1 for o in range(5)}
        assert got[i] == len(covered), (i, bits)


def test_top_k_over_tiles(spark):
    r = np.random.default_rng(5)
    # Three dimensions, many ties, repeated rows, and one direction that most rows share.
    rows = [(i, [int(x) for x in r.integers(-3, 4, 4) + (np.arange(4) == 1) * 5 * (i % 3 > 0)]) for i in range(400)] + [(i, [1, 2]) for i in range(400, 430)] + [(7, [1, 1, 1, 1]), (430, [9] * 5)]
    v = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(5)
    want = set()
    for qid in {i for i, _ in rows if i % 10 == 0}:
        every = sorted((-sum(a * b for a, b in zip(q, x)), i) for j, q in rows if j == qid for i, x in rows if i != qid and len(x) == len(q))
        want |= {(qid, n, i, -s) for n, (s, i) in enumerate(every[:6], 1)}
    asked = v.where("vec_id % 10 = 0")
    for conf in ({"shard_rows": 30, "block_rows": 5, "tile_shards": 3, "tile_blocks": 2}, {"shard_rows": 500, "block_rows": 500}, {"shard_rows": 40, "block_rows": 7, "tile_shards": 100, "tile_blocks": 100}):
        df = topk.top_k(asked, v, 6, **conf)
        got = [tuple(x) for x in df.collect()]
        assert len(got) == len(want) and set(got) == want


def test_floors_drop_no_ties():
    rows = np.array([[1], [3], [2], [3]])
    [(_, ids, scores)] = topk.shard_best(np.array([4, 1, 2, 3]), rows, np.array([9]), np.array([[1]]), 2, [3])
    assert ids.tolist() == [1, 3] and scores.tolist() == [3, 3]
    assert list(topk.shard_best(np.array([4, 1, 2, 3]), rows, np.array([9]), np.array([[1]]), 2, [4])) == []


def test_top_k_with_large_components():
    rows = np.array([[1 << 40, 1 << 40], [2, 3], [5, 1]], np.int64)
    found = topk.shard_top(np.array([1, 2, 3]), rows, np.array([2]), np.array([[1 << 21, -(1 << 21)]]), 3)
    assert list(zip(*(x.tolist() for x in found))) == [(2, 3, 4 << 21), (2, 1, 0)]


def test_least_hashes(spark):
    from chainloom.llm.common import least_hashes

    rows = spark.range(5000).select((F.col("id") % 3).alias("y"), F.xxhash64("id").alias("h"))
    got = {(r.y, r.h) for r in least_hashes(rows, "y", 700).collect()}
    every = collections.defaultdict(list)
    for r in rows.collect():
        every[r.y].append(r.h)
    assert got == {(y, h) for y, hs in every.items() for h in sorted(hs, key=lambda x: x % 2**64)[:700]}


def test_line_dedup_keys_of_many_unlike_lines_give_no_rows(spark):
    """Forty lines that share a rare pair of words but are not alike: their key sends no words to be compared."""
    r = random.Random(5)
    texts = [" ".join([*letters(20, r), "shared", "pair", *letters(20, r)]) for _ in range(40)]
    conf, docs = line_dedup.LineConf(), documents(spark, texts)
    parts = line_dedup.key_parts(docs, line_dedup.sampled_order(docs, conf), 4, conf)
    assert line_dedup.meetings(parts, conf).count() == 0
    assert all(x.dropped_lines == [] for x in line_dedup.dedup_lines(docs).collect())


def test_line_dedup_finds_near_copies_across_components(spark, monkeypatch):
    """Near copies of two lines and of their mixtures, by pairs and by large keys."""
    r = random.Random(6)
    lines = [letters(40, r) for _ in range(2)]
    texts = [" ".join([*line[:k], *letters(1, r), *line[k + 1 :]]) for line in lines for k in range(40)]
    texts += [" ".join([*lines[0][:12], *letters(16, r), *lines[0][28:]]) for _ in range(40)]
    for few in (line_dedup.FEW, 8):
        monkeypatch.setattr(line_dedup, "FEW", few)
        got = [x.dropped_lines for x in line_dedup.dedup_lines(documents(spark, texts)).orderBy("doc_id").collect()]
        assert got == [[]] + [[0]] * 39 + [[]] + [[0]] * 39 + [[]] * 40
