"""Source mixing, centroid clustering and fill-in-middle against brute force."""

import hashlib
import math
import random
import re
from fractions import Fraction

import pytest

LONG = "lorem ipsum dolor " * 30_000


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# ---- mixing


def shares(sizes, weights, most):
    """Targets by handing out the excess round by round, in exact fractions."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, out, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(out.values())
        share = {s: Fraction(left * weight[s], sum(weight[o] for o in open_)) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return out | share
        out |= {s: most * sizes[s] for s in over}
        open_ -= over
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows = []
    for k in range(600):
        source = rng.choice(["b", "b", "b", "Z", "é", "", "z\U0001F600", None, "tiny"])
        n = 1 if source == "tiny" else rng.choice([0, 1, 5, 40, 300])
        rows.append((k, " ".join(["w"] * n) if n or k % 2 else None, source, -1, "x"))
    rows += [(7, "same id again", "b", 0, "y"), (None, "no id one", "b", 0, "y"), (None, "no id two", None, 0, "y"), (900, LONG, "b", 1, ""), (901, " \t\n", "only space", 1, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, rate string"), rows


@pytest.mark.parametrize("weights,most", [((5, 2, 1), 3), ((1,), 1), ((1, 1000), 2)])
def test_targets_and_copies(spark, corpus, weights, most):
    from panelkit.llm.mixing import mixture

    df, rows = corpus
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = shares(sizes, weights, most)
    got = mixture(df, weights, most).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert r.target <= most * r.source_size + 1e-9 and math.floor(r.rate) <= r.copies <= min(most, math.floor(r.rate) + 1)
    assert sum(want.values()) == sum(sizes.values())
    assert sorted(map(str, got)) == sorted(map(str, mixture(df.repartition(5), weights, most).collect()))
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len(words(t))) for i, t, *_ in rows)


def test_taken_words_come_near_the_target(spark):
    from pyspark.sql import functions as F

    from panelkit.llm.mixing import mixture

    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"),
                                      F.concat(F.lit("s"), (F.least(F.col("id") % 12, F.lit(5))).cast("string")).alias("source"))
    out = mixture(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("taken")).collect()
    assert len(out) == 6 and all(abs(r.taken / r.t - 1) < 0.05 for r in out)


def test_mix_emits_the_copies(spark, corpus):
    from panelkit.llm.mixing import mix, mixture

    df, _ = corpus
    plan, out = mixture(df).collect(), mix(df)
    assert out.columns == df.columns and out.schema == df.schema
    assert sum(len(words(r.text)) for r in out.collect()) == sum(r.size * r.copies for r in plan)
    assert out.count() == sum(r.copies for r in plan)


def test_rates_join_by_source_beyond_the_broadcast_bound(spark, corpus):
    from panelkit.llm.mixing import copies, rates, sized

    df, _ = corpus
    sizes = sized(df)
    table = rates(sizes)
    key = lambda d: sorted(map(str, d.collect()))
    assert key(copies(sizes, table)) == key(copies(sizes, table, broadcast_rows=0))
    assert key(copies(sizes, rates(sizes.limit(0)))) == []


def test_mixing_runs_no_python(spark, corpus):
    from panelkit.llm.mixing import mix, mixture

    for out in (mixture(corpus[0]), mix(corpus[0])):
        assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())


# ---- clustering


def lloyd(rows, k, rounds, dims, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) <= (1 << 27) / scale for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]
    best = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(best(v)[1], []).append(v)
        for n, vs in groups.items():
            centroids[n] = [sum(x) // len(vs) for x in zip(*vs)]
    return centroids, [(i, best(v)[1], best(v)[0]) for i, v in kept]


@pytest.mark.parametrize("k", [1, 4, 40])
def test_clustering_equals_brute_force(spark, k):
    from panelkit.llm.centroids import cluster, report

    rng = random.Random(k)
    rows = [(i, [rng.gauss(i % 3, 0.4) for _ in range(5)]) for i in range(30)]
    rows += [(30, None), (31, []), (32, [1.0, None, 0.0, 0.0, 0.0]), (33, [float("nan")] * 5), (34, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (35, [0.0] * 4),
             (36, [1e30] * 5), (3, rows[3][1]), (3, [-1.0] * 5), (None, [0.25] * 5), (37, [0.5] * 5), (38, [0.5] * 5), (39, [-131072.0] * 5)]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, distance string").repartition(4)
    found = cluster(df, k=k, rounds=4, dims=5)
    centroids, want = lloyd(rows, k, 4, 5, 1024, 3)
    assert found.centroids == centroids
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = report(found).collect()
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=key) == sorted(want, key=key)
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) and r.inertia == sum(d for *_, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_clustering_of_nothing_and_without_python(spark):
    from panelkit.llm.centroids import cluster, report, whole_vectors

    df = spark.createDataFrame([(1, [0.0] * 3)], "vec_id long, embedding array<float>")
    assert report(cluster(df)).collect() == [] and report(cluster(df.limit(0), dims=3)).collect() == []
    out = report(cluster(df, dims=3))
    assert [r.distance for r in out.collect()] == [0]
    assert not re.search("Python|Arrow|Pandas", whole_vectors(df)._jdf.queryExecution().executedPlan().toString())


# ---- fill-in-middle


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42, share=50, spm_share=80):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= share:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_share:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    rng = random.Random(3)
    texts = [None, "", " ", "\t\n ", "one", " lead", "trail ", "a  b\x0bc\x0cd", "has <P> mark", "<M>", "almost < P><S <M", "<<P", "é漢字😀 naïve Σ x", LONG, "x" * 200_000, "漢" * 70_000 + " end ", "<" * 70_000]
    texts += ["".join(rng.choice(["<", ">", "P", "S", "M", " ", "\n", "é", "ab"]) for _ in range(rng.randrange(60))) for _ in range(150)]
    rows = [(k * 4 + j, t) for k, t in enumerate(texts) for j in range(3)]
    return rows + [(1, "same id"), (1, "same id"), (None, "no id here, but words"), (-5, "negative id with words")]


@pytest.fixture(scope="module")
def fim_docs(spark):
    return spark.createDataFrame([(i, t, "key", 3) for i, t in fim_rows()], "doc_id long, text string, key string, pos int").repartition(3)


@pytest.mark.parametrize("share,spm_share", [(50, 80), (100, 50), (100, 0), (0, 80)])
def test_fill_in_middle_equals_brute_force(spark, fim_docs, share, spm_share):
    from panelkit.llm import fim

    pieces = fim.pieces(fim_docs, share=share, spm_share=spm_share)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, *brute(i, t, share=share, spm_share=spm_share), t or "") for i, t in fim_rows()]
    got = fim.digests(fim.restore(pieces)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((*w[:5], sha(w[5]), sha(w[6]))) for w in want)
    if share == 50:
        assert sorted(str(tuple(r)) for r in fim.assemble(pieces).collect()) == sorted(str(w[:6]) for w in want)


def test_restoration_reads_the_output_alone(spark):
    from panelkit.llm import fim

    rng = random.Random(1)
    for form in ("psm", "spm", "plain"):
        for _ in range(300):
            p, m, s = ("".join(rng.choice(["<", "P>", "S", ">", "M", " x"]) for _ in range(rng.randrange(8))) for _ in range(3))
            if form != "plain" and re.search("<[PSM]>", p + m + s):
                continue
            out = {"psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}", "plain": p + m + s}[form].encode()
            state, parts = fim.Restorer(form), []
            while out:
                n = rng.randrange(1, 5)
                parts += state.feed(out[:n])
                out = out[n:]
            parts += state.feed(b"", True)
            assert b"".join(d for _, d in sorted(parts)).decode() == p + m + s


def test_units_across_blocks(monkeypatch):
    from panelkit.llm import fim

    rng = random.Random(2)
    for block in (1, 2, 3, 7):
        monkeypatch.setattr(fim, "BLOCK", block)
        for _ in range(200):
            text = "".join(rng.choice("ab \té") for _ in range(rng.randrange(25)))
            units, ends = fim.Units(text.encode()), [0]
            for u in UNIT.findall(text):
                ends.append(ends[-1] + len(u.encode()))
            assert units.n == len(ends) - 1 and [units.end(k) for k in range(units.n + 1)] == ends
            assert units.chars(0, len(text.encode())) == len(text)


def test_fill_in_middle_of_nothing_and_one_shuffle(spark, fim_docs):
    from panelkit.llm import fim

    assert fim.digests(fim.restore(fim.pieces(fim_docs.limit(0)))).collect() == []
    assert fim.assemble(fim.pieces(fim_docs.limit(0))).collect() == []
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = fim.digests(fim.restore(fim.pieces(table)))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan.split("== Initial Plan ==")[-1])) == 1
