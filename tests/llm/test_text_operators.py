"""Operators on texts against brute force, with the awkward rows."""

import hashlib
import random
import re

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

LONG = "lorem ipsum dolor " * 20_000
ROWS = [(1, "Hello world, it's 2024! <|endoftext|> ok"), (2, None), (3, ""), (4, "   \n\t "), (5, "é漢字😀 naïve Σίσυφος"), (6, LONG), (7, "Hello world, it's 2024! <|endoftext|> ok"),
        (8, "a" * 5000 + " " + "1" * 700), (8, "same id, other text"), (None, "no id")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in ROWS], "doc_id long, text string, n_tokens int, score string")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    from panelkit.llm.bpe import decode, encode_decode

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    out = encode_decode(docs, path)
    got = sorted((r.doc_id or 0, bytes(r.ids), r.n_tokens, r.decoded) for r in out.collect())
    want = []
    for i, text in ROWS:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i or 0, np.array(ids, "<u4").tobytes(), len(ids), t.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert sorted(r.decoded for r in decode(out, path).collect()) == sorted(w[3] for w in want)
    assert encode_decode(docs.limit(0), path).count() == 0


def test_bpe_streams_with_bounded_lookahead():
    from tokenizers import Tokenizer

    from panelkit.llm.bpe import Memo, encode_text, load_merges

    path = public_tokenizers.path("byte_bpe_50k.json")
    merges, t, rnd = load_merges(path), Tokenizer.from_file(path), random.Random(5)
    assert merges.lookahead < 1000
    for _ in range(60):
        text = "".join(rnd.choice(["the", "re", "tion", "a", "aa", "zz", "é", "ing", "eu"]) for _ in range(rnd.randint(300, 2500)))
        ids = np.frombuffer(b"".join(encode_text(text, merges, Memo(merges))), "<u4").tolist()
        assert ids == t.encode(text, add_special_tokens=False).ids
        # what is final stays final when text is appended
        first = [*merges.transduce(text.encode())]
        more = [*merges.transduce((text + "ation" * 30).encode())]
        ends = np.cumsum([merges.length[i] for i in first])
        final = int((ends <= len(text.encode()) - merges.lookahead).sum())
        assert first[:final] == more[:final]


def test_token_counts_equal_the_library(spark, docs):
    from tokenizers import Tokenizer

    from panelkit.llm.tokcount import token_counts

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts(docs, path).collect())
    assert got == sorted((i or 0, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in ROWS)
    assert token_counts(docs.limit(0), path).count() == 0


def brute_substring(rows, n):
    first, out = {}, {}
    big = 1 << 62
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - n + 1):
            key = tuple(w[k:k + n])
            first[key] = min(first.get(key, big), big if i is None else i)
    res = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if first[tuple(w[k:k + n])] < (big if i is None else i):
                gone[k:k + n] = [True] * n
        res.append((i or 0, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(res)


@pytest.mark.parametrize("seed,n", [(1, 4), (2, 10), (3, 50)])
def test_substring_dedup_equals_brute_force(spark, seed, n):
    from panelkit.llm.substr import remove_repeats

    rnd = random.Random(seed)
    passage = [f"p{k}" for k in range(3 * n)]
    rows = [(k, None if k == 3 else "" if k == 4 else " ".join(
        [f"w{rnd.randint(0, 6 if k % 5 == 0 else 400)}" for _ in range(rnd.randint(0, 4 * n))] + (passage[rnd.randint(0, n):rnd.randint(n, 3 * n)] if k % 3 == 0 else [])
        + [f"v{rnd.randint(0, 3)}" for _ in range(rnd.randint(0, 3 * n))])) for k in range(120)]
    rows += [(200, rows[0][1]), (201, rows[0][1]), (202, "spam " * 300), (203, "spam " * 200), (204, "a b c " * 90), (205, "\x85x a b c " * 70), (7, rows[9][1]), (None, rows[12][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, first int")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in remove_repeats(df, n).collect())
    assert got == brute_substring(rows, n)
    assert remove_repeats(df.limit(0), n).count() == 0


def test_simhash_fingerprint_and_components(spark):
    import xxhash

    from panelkit.llm.simhash import fingerprint, near_duplicates

    for text in ("", None, "one", "One TWO", "a b c d e f a b c", "É é Z" * 50):
        w = [x for x in words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))]
        sh = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert fingerprint(text, 3) & (2**64 - 1) == want
    rows = [(5, None), (4, ""), (9, "x y z w"), (8, "X y  z w"), (8, "other words here now"), (None, "x y z w")]
    got = {(r.doc_id, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (5, 4) in got and (4, 4) in got and (9, 8) in got
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_ball_hashing_finds_every_link(spark, k):
    from panelkit.llm.components import components
    from panelkit.llm.simhash import links

    rnd = random.Random(k)
    fps = [0, 1, 2**63, 2**64 - 1]
    for _ in range(60):
        x = rnd.getrandbits(64)
        for _ in range(6):
            fps.append(x)
            x ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5)))
    fps = sorted({x - 2**64 if x >= 2**63 else x for x in fps})
    u = np.array(fps, np.int64).view(np.uint64)
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(fps)):
        for b in np.flatnonzero(np.bitwise_count(u ^ u[a]) <= k):
            x, y = sorted((find(a), find(int(b))))
            root[y] = x
    found = links(spark.createDataFrame([(x,) for x in fps], "fp long"), k)
    for r in found.collect():
        assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= k and r.a < r.b
    got = {r.node: r.root for r in components(found).collect()}
    assert [got.get(x, x) for x in fps] == [fps[find(a)] for a in range(len(fps))]


def test_language_id(spark):
    from panelkit.llm.langid import fit, identify

    en = "the quick brown fox jumps over the lazy dog and then it runs through the wood with that other thing".split()
    de = "der schnelle braune fuchs springt über den faulen hund und dann läuft er durch den wald mit diesem ding".split()
    rnd = random.Random(1)
    train = [(k, " ".join(rnd.choices(en if k % 2 else de, k=40)), "en" if k % 2 else "de") for k in range(200)]
    model = fit(spark.createDataFrame([*train, (900, None, "en"), (901, "words without language", None)], "doc_id long, text string, lang string"), sample=60)
    assert model.languages == ["de", "en"]
    rows = [(1, "The dog runs through the wood."), (2, "Der Hund läuft durch den Wald."), (3, None), (4, "123 456 !!!"), (5, ""), (5, "the fox " * 30_000), (6, "zqxj kvwq xxqz jqjq zzqk " * 20)]
    out = identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert [r.lang_pred for r in out] == ["en", "de", "und", "und", "und", "en", out[6].lang_pred]
    assert all(0 <= r.score <= 1 for r in out)
    assert [r.rejected for r in out] == [False, False, True, True, True, False, True]
    empty = fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in identify(spark.createDataFrame(rows, "doc_id long, text string"), empty).collect()} == {"und"}


def test_language_models_are_distributions():
    from collections import Counter

    from panelkit.llm.langid import CHARACTERS, build

    m = build({"a": Counter({"abab": 3, "ba": 2, "aab": 1}), "b": Counter({"xyx": 2, "ab": 1})}, 3)
    # after any context, what the model gives to all characters sums to one
    alphabet = [chr(c) for c in range(33, 33 + 90)] + [" "]
    for context in ("", "a", "ab", "xy", "zz"):
        base = m.word_scores([context])[0] if context else None
        total = np.zeros(2)
        for c in alphabet:
            if c == " ":
                whole = m.word_scores([context])[0][0] if context else None
                continue
            # P(context + c) / P(context), without the closing space: difference of scores of longer words
            s = m.word_scores([context + c])[0][0] - _closing(m, context + c)
            s0 = (m.word_scores([context])[0][0] - _closing(m, context)) if context else 0
            total += np.exp(s - s0)
        space = np.exp(_closing(m, context)) if context else 0
        rest = CHARACTERS - len(alphabet)
        assert ((total + space) <= 1 + 1e-4).all() and (total + space > 1 - rest / CHARACTERS - 0.05).all()


def _closing(m, word):
    """Log probability of the space after a word, by the model's own tables."""
    from panelkit.llm.langid import code_points, gram_hashes, lookup

    codes, out = code_points([word]), np.zeros(len(m.languages))
    for n in range(m.order, 0, -1):
        if len(codes) < n:
            continue
        found, row = lookup(m.grams[n - 1], gram_hashes(codes[-n:], n))
        if found[0]:
            return out + m.logp[n - 1][row[0]]
        known, row = lookup(m.contexts[n - 1], gram_hashes(codes[-n:-1], n - 1)) if n > 1 else (np.array([True]), np.array([0]))
        if known[0]:
            out = out + m.backoff[n - 1][row[0]]
    from panelkit.llm.langid import CHARACTERS

    return out - np.log(CHARACTERS)


def test_decontamination(spark):
    from panelkit.llm.decontam import find_leaks

    rnd = random.Random(3)
    vocab = [f"w{k}" for k in range(3000)]
    items = [(k, " ".join(rnd.choices(vocab, k=rnd.randint(8, 60)))) for k in range(40)] + [(100, "only three words"), (101, None), (102, "")]
    text = lambda n: " ".join(rnd.choices(vocab, k=n))
    docs, want = [], {}
    for k in range(60):
        item = items[k % 40]
        body = item[1].split()
        if k % 3 == 0:
            docs.append((k, f"{text(50)}\n{item[1].upper()} {text(80)}"))
            want[k] = {item[0]}
        elif k % 3 == 1 and len(body) > 50:
            body[len(body) // 2] = "changed"
            docs.append((k, f"{text(30)} {' '.join(body)} {text(30)}"))
            want[k] = {item[0]} if (len(body) - 9) / (len(body) + 1) >= 0.81 else None
        else:
            docs.append((k, f"{text(70)} {' '.join(body[:len(body) // 3])}"))
            want[k] = set()
    docs += [(200, None), (201, ""), (202, "we have Only Three words here"), (203, items[0][1])]
    want |= {200: set(), 201: set(), 202: {100}, 203: {0}}
    d = spark.createDataFrame([(*x, "m") for x in docs], "doc_id long, text string, matches string")
    b = spark.createDataFrame(items, "item_id long, text string")
    one = {r.doc_id: {m["item"] for m in r.matches} for r in find_leaks(d, b).collect()}
    for k, w in want.items():
        assert w is None or one[k] == w, k
    many = {r.doc_id: {m["item"] for m in r.matches} for r in find_leaks(d, b, slice_items=7).collect()}
    assert many == one
    assert all(not r.matches for r in find_leaks(d, b.limit(0)).collect()) and find_leaks(d.limit(0), b).count() == 0


def test_multi_index_guarantees_the_radius():
    from panelkit.llm.decontam import Index

    rng = np.random.default_rng(1)
    index = Index([(k, " ".join(f"a{k}b{j}" for j in range(30))) for k in range(20)], 5, 19)
    fps = index.fps[rng.integers(0, 20, 300)] ^ np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 24), False)) for _ in range(300)], np.uint64)
    w, i = index.near(fps)
    want = {(a, b) for a in range(300) for b in range(20) if int(np.bitwise_count(fps[a] ^ index.fps[b])) <= 19}
    assert set(zip(w.tolist(), i.tolist())) == want


def test_quality(spark):
    from panelkit.llm.quality import score_quality

    rnd = random.Random(2)
    good, bad, rude = [f"fine{k}" for k in range(50)], [f"junk{k}###" for k in range(50)], ["awful", "nasty"]
    docs, labels = [], []
    for k in range(600):
        kind = k % 3
        w = rnd.choices(bad if kind == 1 else good, k=40) + (rude if kind == 2 else [])
        docs.append((k, " ".join(w), f"h{k % 7}", "en", "extra"))
        if k % 2:
            labels.append((k, int(kind != 1), int(kind == 2)))
    docs += [(700, None, None, None, "x"), (701, "", "h1", "en", "x")]
    labels += [(700, None, None), (5, 1, 1), (None, 1, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, lang string, p_quality string")
    out = {r.doc_id: r for r in score_quality(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(out) == 602
    assert all(out[k].keep == (k % 3 == 0) for k in range(600))
    none = score_quality(d, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert len(none) == 602 and all(r.keep and r.p_quality is None for r in none)


def test_lm_scores(spark):
    import collections
    import math

    from pyspark.sql import functions as F

    from panelkit.llm.maxent import score_texts

    rnd = random.Random(4)
    langs = [[f"{s}{k}" for k in range(60)] for s in ("tha", "der", "qu")]
    langs = [[w + e for w in ws] for ws, e in zip(langs, ("ing", "ung", "eau"))]
    rows = [(k, " ".join(rnd.choices(langs[k % 3], k=60))) for k in range(300)] + [(400, None), (401, ""), (402, "A " * 30_000), (400, "twice")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bundle int")
    out = score_texts(df, F.col("doc_id") % 7 == 2).collect()
    c = collections.Counter()
    for i, t in rows:
        if i % 7 != 2:
            c.update([*words((t or "").lower()), None])
    n, v = sum(c.values()), len(c)
    want = collections.Counter((i, len(words(t)) + 1, sum(c[x] > 0 for x in [*words((t or "").lower()), None]),
                                round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in [*words((t or "").lower()), None]), 5)) for i, t in rows)
    assert collections.Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 5)) for r in out) == want
    assert {r.train_tokens for r in out} == {n}
    held = [r for r in out if r.held_out and r.doc_id < 300]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score < 0 for r in held)
    assert score_texts(df.limit(0), F.lit(False)).count() == 0
    assert {r.base_score for r in score_texts(df.where("doc_id = 401"), F.lit(True)).collect()} == {0.0}


def test_quality_fit_takes_one_text_of_a_repeated_id(spark):
    from panelkit.llm.quality import fit_evidence

    rows = [(k, f"{'good plain words' if k % 2 else 'buy cheap spam'} number {k}") for k in range(40)]
    more = [(k, f"zz other text {k} {j}") for k in range(40) for j in range(5)]
    labels = spark.createDataFrame([(k, k % 2, (k + 1) % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    fits = [fit_evidence(spark.createDataFrame(x, "doc_id long, text string"), labels, sample=30) for x in (rows, rows + more, more[::-1] + rows[::-1])]
    assert all(np.array_equal(f.weights, fits[0].weights) for f in fits)


def test_lm_word_factor_sees_the_words_before(spark):
    from pyspark.sql import functions as F

    from panelkit.llm.maxent import score_texts

    rnd = random.Random(7)
    # all words end alike, so they are of one class
    rows = [(k, " ".join(f"p{j}xx q{j}xx" for j in rnd.choices(range(20), k=40))) for k in range(600)]
    tests = [(1000 + j, f"p{j}xx q{j}xx") for j in range(20)] + [(2000 + j, f"p{j}xx q{(j + 7) % 20}xx") for j in range(20)] + [(3000, "newxx p1xx")]
    df = spark.createDataFrame(rows + tests, "doc_id long, text string")
    out = {r.doc_id: r for r in score_texts(df, F.col("doc_id") >= 1000).collect()}
    assert sum(out[1000 + j].score for j in range(20)) > sum(out[2000 + j].score for j in range(20)) + 1
    assert out[3000].n_known == 2 and out[3000].score < 0


def test_lm_word_factor_sums_to_one():
    from panelkit.llm.maxent import LEAST_ROWS, WIDTH, WORD_FEATURES, column_of, features, log_softmax, word_code

    rng = np.random.default_rng(1)
    vocabulary = [b"w%d" % k for k in range(500)]
    counts, columns = rng.integers(1, 90, 500), column_of(np.array([word_code(w) for w in vocabulary]))
    mass = np.ones(WIDTH) + np.bincount(columns, counts + 1, WIDTH)
    weights = rng.normal(size=(LEAST_ROWS, WIDTH))
    codes = np.array([word_code(b"a"), word_code(b"b"), word_code(b"c")], np.int64)
    feats = features(WORD_FEATURES, codes, np.ones(3, np.int64), np.array([3]), LEAST_ROWS, given=True)
    logp = log_softmax(weights, feats, np.log(mass)) - np.log(mass)
    # all known words, and the unknown word of each column
    assert np.allclose((np.exp(logp[:, columns]) * (counts + 1)).sum(1) + np.exp(logp).sum(1), 1)
    flat = np.log(counts + 1) + sum(weights[f] for f in feats)[:, columns]
    unknown = sum(weights[f] for f in feats)
    z = np.log(np.exp(flat).sum(1) + np.exp(unknown).sum(1))
    assert np.allclose(flat - z[:, None], logp[:, columns] + np.log(counts + 1))


def test_lm_digits_sum_to_one_and_cells_grow():
    from panelkit.llm.maxent import BUCKETS, CELL_WORDS, CLASSES, DIGIT, JOINT, PAIRS, SEEN, cells, column_of, depth_of, new_tables, token_scores, word_code

    assert [depth_of(v) for v in (0, CLASSES * 64 * CELL_WORDS, CLASSES * 64 * CELL_WORDS + 1, 1 << 60)] == [2, 2, 3, 7]
    assert len(new_tables(0)[1][0]) < len(new_tables(10 ** 9)[1][0]) < len(new_tables(10 ** 13)[1][0]) < 1 << 20
    # a joint row has the weights of the classes before, one by one and together
    assert JOINT.sum(1).tolist() == [len(parts) for _, parts in PAIRS for _ in range(SEEN * SEEN)]
    rng = np.random.default_rng(2)
    vocabulary = [b"w%d" % k for k in range(400)]
    codes = np.array([word_code(w) for w in vocabulary], np.int64)
    classes = np.r_[0, rng.integers(1, CLASSES, BUCKETS - 1)]
    for depth in (2, 3):
        counts, own, columns = rng.integers(1, 90, 400), classes[codes % BUCKETS], column_of(codes, DIGIT ** depth)
        mass = np.ones((CLASSES, DIGIT ** depth))
        np.add.at(mass, (own, columns), counts + 1)
        cell = cells(mass, classes)
        tables = [rng.normal(size=w.shape).astype(np.float32) for w, _ in new_tables(1000)]
        # the next token after "a b": a known word each, one code of each cell, the end
        every = [(c, d) for c in range(1, CLASSES) for d in range(DIGIT ** depth)]
        bucket = {c: int(np.flatnonzero(classes[1:] == c)[0]) + 1 for c in range(1, CLASSES)}
        after = np.concatenate([codes, [bucket[c] + BUCKETS * d for c, d in every], [0]])
        texts = np.array([[word_code(b"a"), word_code(b"b"), x] for x in after], np.int64)
        logp = token_scores(tables, texts.ravel(), np.full(len(texts), 3), cell)[2::3]
        known, unknown, end = np.split(logp, [400, 400 + len(every)])
        total = (np.exp(known) * (counts + 1)).sum() + np.exp(unknown).sum() + np.exp(end[0])
        assert abs(total - 1) < 1e-3


def test_lm_words_of_many_texts_at_once(spark, monkeypatch):
    from collections import Counter

    import pyarrow as pa
    from pyspark.sql import functions as F

    from panelkit.llm.maxent import bundles, codes_of, score_texts, split_texts, word_code
    from panelkit.llm.tokcount import records

    texts = [b"  A bc\x0bBC\x1cx\t\r\n", None, b"", b" \f ", "Grün ÜBER\u00a0x grün".encode(), b"\xff\xc3 \x80Z \x00 a", b"Z" * 400 + b" z" * 700]
    column = pa.array([b"cut off", *texts, b"cut off"], pa.binary()).slice(1, len(texts))
    want = [(t or b"").lower().split() for t in texts]
    sizes, words, lens = split_texts(column)
    assert sizes.tolist() == [len(t or b"") for t in texts] and lens.tolist() == [*map(len, want)]
    found = words.cast(pa.large_binary()).to_pylist()
    assert found == sum(want, []) and codes_of(found).tolist() == [word_code(w) for w in found]
    for few in ([], [None, None], [b""]):
        assert len(split_texts(pa.array(few, pa.binary()))[1]) == 0

    # every bundle's postings and sequences, with and without a cut between documents
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, b"again a"), (None, b"a")]
    held = F.coalesce(F.col("doc_id") == 0, F.lit(False))
    df = spark.createDataFrame(rows, "doc_id long, text binary").coalesce(1)
    for docs in (60_000, 2):
        monkeypatch.setattr("panelkit.llm.maxent.BUNDLE_DOCS", docs)
        out = bundles(df, held, "doc_id", "text").collect()
        of = {(r.bundle, r.doc): r for r in out if r.word is None}
        assert sorted((r.id is None, r.id or 0, [*np.frombuffer(r.codes, "<i4")]) for r in of.values()) == sorted((k is None, k or 0, [*map(word_code, (t or b"").lower().split()), 0]) for k, t in rows)
        per_doc = Counter()
        for r in out:
            if r.word is not None:
                doc, freq, _ = records(pa.array([bytes(r.postings)], pa.binary()))
                assert r.code == word_code(r.word) and r.train == sum(int(f) for d, f in zip(doc, freq) if not of[r.bundle, d].held_out)
                for d, f in zip(doc, freq):
                    per_doc[of[r.bundle, d].id, bytes(r.word)] += int(f)
        assert per_doc == Counter((k, w) for k, t in rows for w in (t or b"").lower().split())
        assert len({r.bundle for r in out}) == (1 if docs > 2 else 5)
        assert sum(r.n_tokens for r in score_texts(df, held).collect()) == sum(len((t or b"").split()) + 1 for _, t in rows)


def test_lm_counts_and_postings_take_one_shuffle(spark, monkeypatch):
    from pyspark.sql import functions as F

    from panelkit.llm import maxent

    plans = {}
    write = maxent.materialize

    def written(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(maxent, "materialize", written)
    out = maxent.score_texts(spark.createDataFrame([(k, f"a b{k % 3} c") for k in range(30)], "doc_id long, text string"), F.col("doc_id") % 7 == 2)
    assert {r.n_known for r in out.collect()} == {4}
    last = out._jdf.queryExecution().executedPlan().toString()
    assert sum(p.count("Exchange hashpartitioning(word#") for p in (*plans.values(), last)) == 1


def test_lm_gradients_add_up_by_row():
    from panelkit.llm.maxent import DIGIT, MEMORY, adagrad, chosen, errors, gathered, learn, log_softmax

    rng = np.random.default_rng(5)
    n, size = 4500, 700
    weights, feats, y = rng.normal(size=(size, DIGIT)).astype(np.float32), rng.integers(0, size, (3, n)), rng.integers(0, DIGIT, n)
    start = rng.normal(size=(n, DIGIT)).astype(np.float32)
    logp = log_softmax(weights, feats, start)
    assert np.allclose(chosen([(weights, feats)], y, start), logp[np.arange(n), y], atol=1e-5)
    scale = (rng.random(n) < 0.8) * np.float32(1 / n)
    want = np.zeros((size, DIGIT))
    for f in feats:
        np.add.at(want, f, (np.exp(logp) - np.eye(DIGIT)[y]) * scale[:, None])
    error = errors([(weights, feats)], y, scale, start)
    assert np.allclose(gathered(feats, error, size), want, atol=1e-7)
    # on all rows of a small table, or on the batch's rows of a large one
    for rows in (size, 4 * feats.size):
        table = np.resize(weights, (rows, DIGIT)), np.full((rows, DIGIT), MEMORY, np.float32)
        whole = [x.copy() for x in table]
        learn(table, feats, error)
        adagrad(*whole, slice(None), gathered(feats, error, rows))
        assert np.array_equal(table[0], whole[0]) and np.array_equal(table[1], whole[1])


def test_stray_labels_do_not_switch_off_rejection(spark):
    from panelkit.llm.langid import fit, identify

    rnd = random.Random(5)
    texts = {"en": "the of and to in is that was for with".split(), "de": "der die und das nicht ein ist von mit auch".split()}
    rows = [(k, " ".join(rnd.choices(texts[lang], k=40)), lang) for k, lang in enumerate(["en", "de"] * 100)]
    rows += [(1000 + k, f"zebra quilt {w} xylophone jukebox vortex", "typo") for k, w in enumerate(("one", "two", "six", "ten"))]
    schema = "doc_id long, text string, lang string"
    foreign = [(1, "съешь же ещё этих мягких французских булок да выпей чаю " * 4, None), (2, "ξεσκεπάζω την ψυχοφθόρα βδελυγμία και άλλα πράγματα " * 4, None), (3, rows[0][1], None), (4, rows[1][1], None)]
    model = fit(spark.createDataFrame(rows, schema))
    assert model.languages == ["de", "en", "typo"] and np.isfinite(model.limit).all()
    out = {r.doc_id: r.rejected for r in identify(spark.createDataFrame(foreign, schema), model).collect()}
    assert out == {1: True, 2: True, 3: False, 4: False}
    few = fit(spark.createDataFrame(rows[-4:], schema))
    assert np.isfinite(few.limit).all()


def test_only_letters_make_a_language():
    from panelkit.llm.langid import has_letter

    assert [has_letter(w) for w in ("½", "²", "①", "Ⅷ", "12", "_", "!", "a", "½é", "漢", "ª", "x1", "Σ!")] == [False] * 7 + [True] * 6
