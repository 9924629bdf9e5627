"""Document quality by hierarchical empirical Bayes.

*Document evidence.* A logistic model over hashed words (present or not) and a
few shape features, for each target (``quality``, ``toxic``), fitted on at most
``sample`` labelled documents, those with the least hash of their id: bounded by
that parameter. Whole texts count, at fit and at scoring.

*Site levels.* All labelled documents are counted per site (``host``) and per
path within the site, by grouped aggregation. A site's rate is a Beta posterior
that shrinks to the global rate, a path's one that shrinks to its site's; how
strongly is estimated from the spread between groups (method of moments), so
sparse sites fall back to the global prior.

*Combination.* The path posterior replaces the base rate in the document's
odds: ``logit p = evidence + logit(path) - logit(global)``.

Nulls: a null text is empty (shape features only); a null host or path is a
group of its own; null or repeated labels are ignored or averaged per id.
Without labels of a target its probability is null and decides nothing.
Repeated ids keep one row each. Input columns with other names are not read.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
SHAPE = 7
TARGETS = ("quality", "toxic")


class Features(dict):
    """Hash of a lower-case word; remembers words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = zlib.crc32(word) & ((1 << BITS) - 1)
        return h


def shape(text: str, words: list[bytes]) -> list[float]:
    n, chars = max(len(words), 1), max(len(text), 1)
    ascii_text = text.encode("ascii", "ignore")
    odd = len(ascii_text) - len(ascii_text.translate(None, b"!#$%&*+/<=>@[\\]^_`{|}~"))
    upper = len(ascii_text) - len(ascii_text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = len(ascii_text) - len(ascii_text.translate(None, b"0123456789"))
    same = sum(map(bytes.__eq__, words, words[1:]))
    return [1.0, min(odd / chars * 10, 5), min(upper / chars * 5, 5), min(digits / chars * 5, 5), same / n * 3, len(set(words)) / n, min(chars / n / 20, 3)]


def featurize(text: str | None, memo: Features) -> tuple[np.ndarray, list[float]]:
    text = text or ""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    hashed = np.unique(np.fromiter(map(memo.__getitem__, words), np.int32, len(words)))
    return hashed, shape(text, words)


@dataclass
class Evidence:
    weights: np.ndarray  # [2^BITS + SHAPE, targets]: log odds less the base rate's
    known: np.ndarray    # which targets have labels of both kinds


def fit_logistic(rows: list[np.ndarray], dense: np.ndarray, y: np.ndarray, steps: int = 150, l2: float = 2e-6) -> np.ndarray:
    """Full-batch Adam over sparse rows; ``y``: 0, 1 or NaN. Returns the weights."""
    n, lens = len(rows), np.array([len(r) for r in rows])
    at, doc = np.concatenate(rows), np.repeat(np.arange(n), lens)
    use = ~np.isnan(y)
    target, count = np.where(use, y, 0), max(use.sum(), 1)
    w = np.zeros((1 << BITS) + SHAPE)
    rate = min(max(target.sum() / count, 1e-3), 1 - 1e-3)
    w[1 << BITS] = np.log(rate / (1 - rate))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.bincount(doc, w[at], n) + dense @ w[1 << BITS:]
        g = np.where(use, 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target, 0) / count
        grad = np.r_[np.bincount(at, g[doc], 1 << BITS), dense.T @ g] + l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    w[1 << BITS] -= np.log(rate / (1 - rate))
    return w


def label_rows(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc"))
            .agg(*[F.avg(F.col(t).cast("double")).alias(t) for t in TARGETS]))


def fit_evidence(docs: DataFrame, labels: DataFrame, sample: int = 6000, id_col: str = "doc_id", text_col: str = "text") -> Evidence:
    """The logistic models, from at most ``sample`` labelled documents; of rows of one
    id the least text counts, so each chosen label is one example."""
    spark = docs.sparkSession
    chosen = label_rows(labels, id_col).orderBy(F.xxhash64("doc", F.lit("sample")), "doc").limit(sample)
    schema = pa.schema([("hashed", pa.list_(pa.int32())), ("dense", pa.list_(pa.float64())), *[(t, pa.float64()) for t in TARGETS]])

    def run(batches):
        memo = Features()
        for b in batches:
            for text, *y in zip(*(b.column(c).to_pylist() for c in ("text", *TARGETS))):
                hashed, dense = featurize(text, memo)
                yield pa.record_batch([pa.array([hashed], schema.field(0).type), pa.array([dense], schema.field(1).type), *[pa.array([v], pa.float64()) for v in y]], schema=schema)

    # at most `sample` rows of four numbers: a bounded broadcast
    picked = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "doc")
    picked = picked.groupBy("doc", *TARGETS).agg(F.min("text").alias("text")).orderBy("doc").select("text", *TARGETS)
    got = picked.mapInArrow(run, "hashed array<int>, dense array<double>, quality double, toxic double").toPandas()
    weights, known = np.zeros(((1 << BITS) + SHAPE, len(TARGETS))), np.zeros(len(TARGETS), bool)
    for k, t in enumerate(TARGETS):
        y = got[t].to_numpy(np.float64)
        known[k] = len(np.unique(y[~np.isnan(y)])) > 1
        if known[k]:
            weights[:, k] = fit_logistic([np.asarray(h, np.int64) for h in got["hashed"]], np.stack(got["dense"].to_list()), y)
    return Evidence(weights, known)


def posteriors(sites: DataFrame, target: str) -> tuple[DataFrame, float]:
    """``(host, path, <target>_prior)`` from ``(host, path, <target>)``, and the
    global rate. One row per labelled path; the driver sees six sums."""
    paths = sites.where(F.col(target).isNotNull()).groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(target).alias("k"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk"))
    t = hosts.agg(F.sum("hn"), F.sum("hk"), F.sum(F.col("hn") ** 2), F.count("*"), F.sum(F.col("hk") ** 2 / F.col("hn"))).first()
    n, k = float(t[0] or 0), float(t[1] or 0)
    rate = (k + 0.5) / (n + 1)

    def strength(total, squares, groups, between):
        spread = between - (groups - 1) * rate * (1 - rate)  # sum of n (p - rate)^2, less what chance gives
        room = total - squares / total if total else 0
        tau = max(spread / room if room > 0 else 0, 1e-4)
        return min(max(rate * (1 - rate) / tau - 1, 2.0), 1e4)

    s_host = strength(n, float(t[2] or 0), t[3], float(t[4] or 0) - n * (k / n) ** 2 if n else 0)
    named = hosts.withColumnRenamed("host", "h")
    both = paths.join(named, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    u = both.agg(F.sum(F.col("n") ** 2), F.count("*"), F.sum(F.col("k") ** 2 / F.col("n")), F.countDistinct(F.coalesce("host", F.lit("")))).first()
    inside = float(u[2] or 0) - float(t[4] or 0)  # spread of paths within hosts
    s_path = strength(n, float(u[0] or 0), u[1] - (u[3] or 0) + 1, inside)
    host_rate = (F.col("hk") + s_host * rate) / (F.col("hn") + s_host)
    return both.select("host", "path", host_rate.alias(f"{target}_host"), ((F.col("k") + s_path * host_rate) / (F.col("n") + s_path)).alias(f"{target}_prior")), rate


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = 6000, keep_at: float = 0.5, toxic_at: float = 0.5,
                  id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """``(id, host, path, p_quality, p_toxic, keep)`` per row."""
    evidence = fit_evidence(docs, labels, sample, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(evidence)
    schema = pa.schema([("id", pa.int64()), ("host", pa.string()), ("path", pa.string()), *[(f"e_{t}", pa.float64()) for t in TARGETS]])

    def run(batches):
        memo, e = Features(), shared.value
        sparse, dense = e.weights[:1 << BITS], e.weights[1 << BITS:]
        for b in batches:
            out = np.full((b.num_rows, len(TARGETS)), np.nan)
            for k, text in enumerate(b.column(1).to_pylist()):
                hashed, s = featurize(text, memo)
                out[k] = np.where(e.known, sparse[hashed].sum(0) + np.array(s) @ dense, np.nan)
            yield pa.record_batch([b.column(0), b.column(2).cast(pa.string()), b.column(3).cast(pa.string()), *[pa.array(out[:, k], from_pandas=True) for k in range(len(TARGETS))]], schema=schema)

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"))
    scored = d.mapInArrow(run, "id long, host string, path string, e_quality double, e_toxic double")
    sites = d.select("id", "host", "path").join(label_rows(labels, id_col), F.col("id") == F.col("doc"))
    for t in TARGETS:
        prior, rate = posteriors(sites, t)
        p = prior.select(F.col("host").alias("h"), F.col("path").alias("p"), f"{t}_prior", f"{t}_host")
        scored = scored.join(p, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left").drop("h", "p", f"{t}_host")
        q = F.coalesce(f"{t}_prior", F.lit(rate))
        scored = scored.withColumn(f"p_{t}", 1 / (1 + F.exp(-(F.col(f"e_{t}") + F.log(q / (1 - q))))))
    # the evidence is log odds less the base rate's, so the path's odds take the base rate's place
    keep = F.coalesce(F.col("p_quality") >= keep_at, F.lit(True)) & F.coalesce(F.col("p_toxic") < toxic_at, F.lit(True))
    return scored.select(F.col("id").alias(id_col), "host", "path", "p_quality", "p_toxic", keep.alias("keep"))
