"""Substring dedup by level-wise doubling over windows of words.

Two levels carry a window of ``n`` words: its half-length windows first; what
repeats there alone is extended to twice the length.

*Level 1, n/2 words.* Of the half-length windows of an n-word window the one with
the least hash (leftmost on ties) is its anchor. The choice depends on the words
alone, so equal n-word windows have equal anchors at the same place: a window
whose anchor is not repeated in two documents is not repeated itself, and the
anchors (about two of 27 positions for n = 50) stand for all windows, without
loss. An anchor row holds the run of windows it stands for, and a hash of the
words of that run.

*Level 2, n words.* Repeated anchors are extended. Where all runs of an anchor
are equal, all their windows are equal, and the least document decides. Where
they differ, one representative of each distinct run is extended window by
window, 128 bits each, and the least document of each window decides.

A document's later windows are removed on the input as it was. Counting is by
grouped minima (partially aggregated) and joins that Spark may split, so a
passage in a third of all documents is neither one task's nor a list.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Null text: no words. Texts shorter
than the window keep all words. Rows with the same id keep their own texts and
never remove from each other (the rule asks for a smaller id). Only the id and
the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import map_rows, materialize

#: A null id counts as larger than any other.
NULL_ID = 2**63 - 1
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, as long as needed."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def upto(self, n: int):
        if n > self.n:
            self.n = max(n, 2 * self.n, 4096)
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(self.n, b, np.uint64)]) for b in (self.base, self.inverse))
        return self.up, self.down


class Spans:
    """Hashes of spans of words, from running sums: equal words, equal hash."""

    def __init__(self, words: np.ndarray, powers: Powers):
        up, self.down = powers.upto(len(words))
        self.sums = np.r_[np.uint64(0), np.cumsum(words * up[:len(words)])]

    def __call__(self, lo, hi):
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo])


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_digest

    return np.frombuffer(b"".join(map(xxh64_digest, words)), "<u8")


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def anchor_runs(spans: Spans, n_words: int, window: int):
    """Anchors of all windows, leftmost least, as runs: place, first window, windows."""
    half = window // 2
    value = spans(np.arange(n_words - half + 1), np.arange(half, n_words + 1))
    low, at, width, need = value, np.arange(len(value)), 1, window - half + 1
    while width < need:
        step = min(width, need - width)
        right = low[step:] < low[:-step]
        low, at, width = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step]), width + step
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return low[first], at[first], first, np.diff(np.r_[first, len(at)])


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """``(doc, th, anchor, run, first, n)`` from ``(doc, th, text)``."""
    schema = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("anchor", pa.int64()), ("run", pa.int64()), ("first", pa.int32()), ("n", pa.int8())])

    def run(batches):
        powers = Powers(BASES[0])
        for batch in batches:
            held, size = [], 0
            for doc, th, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = split_words(text)
                if len(words) < window:
                    continue
                spans = Spans(word_hashes(words), powers)
                low, at, first, n = anchor_runs(spans, len(words), window)
                whole = spans(first, first + n + (window - 1)) ^ mix(((at - first) << 8 | n).astype(np.uint64))
                k = len(first)
                held.append((np.full(k, doc), np.full(k, th), low.view(np.int64), whole.view(np.int64), first.astype(np.int32), n.astype(np.int8)))
                size += k
                if size > 200_000:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)
                    held, size = [], 0
            if held:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)

    return docs.mapInArrow(run, "doc long, th long, anchor long, run long, first int, n byte")


def run_windows(texts: DataFrame, window: int) -> DataFrame:
    """Every window of the given runs: ``(h1, h2, anchor, run, off, d0, d1)`` from
    ``(text, runs array<struct<first,n,anchor,run,d0,d1>>)``."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("anchor", pa.int64()), ("run", pa.int64()), ("off", pa.int8()), ("d0", pa.int64()), ("d1", pa.int64())])

    def run(batches):
        powers = [Powers(b) for b in BASES]
        for batch in batches:
            runs = batch.column(1)
            for text, at in zip(batch.column(0).to_pylist(), range(batch.num_rows)):
                hashed = word_hashes(split_words(text))
                both = [Spans(hashed, p) for p in powers]
                of = runs[at].values
                first, n, anchor, whole, d0, d1 = (of.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "n", "anchor", "run", "d0", "d1"))
                off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                s = np.repeat(first, n) + off
                yield pa.record_batch([pa.array(h(s, s + window).view(np.int64)) for h in both]
                                      + [pa.array(np.repeat(x, n)) for x in (anchor, whole)] + [pa.array(off.astype(np.int8))]
                                      + [pa.array(np.repeat(x, n)) for x in (d0, d1)], schema=schema)

    return texts.mapInArrow(run, "h1 long, h2 long, anchor long, run long, off byte, d0 long, d1 long")


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   carry: str | None = None) -> DataFrame:
    """``(id, text, n_words, n_removed, removed, kept)``: the text as given, its
    words, the words removed, their spans ``[(from, to)]`` in words, and the kept
    words joined by one space. ``window``: even, 4 to 126 words.
    ``carry`` names a column that goes along."""
    if window % 2 or not 4 <= window <= 126:
        raise ValueError("window must be even, 4 to 126")
    # keys that can't be null: both joins with the texts then read one and the same exchange
    d = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NULL_ID)).alias("doc"), docs[text_col].cast("string").alias("text"),
                    *([F.col(carry).alias("carry")] if carry else []))
    d = d.withColumn("th", F.xxhash64("text"))
    found = materialize(anchors(d.select("doc", "th", "text"), window), "anchors")

    # level 1: only anchors in two documents or more are extended
    repeated = found.groupBy("anchor").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("anchor")
    # a table of its own: the join below then has two plain exchanges, which Spark may split where an anchor is hot
    repeated = materialize(repeated, "repeated_anchors")
    live = materialize(found.join(repeated, "anchor"), "repeated")
    runs = live.groupBy("anchor", "run").agg(F.min(F.struct("doc", "th", "first", "n")).alias("rep"), F.max("doc").alias("d1"))
    runs = materialize(runs.select("anchor", "run", "rep.*", "d1"), "distinct_runs")
    n_runs = materialize(runs.groupBy("anchor").agg(F.count("*").alias("n_runs")), "run_counts")
    runs = materialize(runs.join(n_runs, "anchor"), "runs")

    # level 2: one distinct run decides at once, several are extended to windows
    alike = runs.where("n_runs = 1").select("anchor", "run", F.col("doc").alias("least"), F.expr("shiftleft(1L, cast(n AS int)) - 1").alias("mask"))
    reps = (runs.where("n_runs > 1").groupBy("doc", "th")
            .agg(F.collect_list(F.struct("first", "n", "anchor", "run", F.col("doc").alias("d0"), "d1")).alias("runs")))
    windows = run_windows(d.join(reps, ["doc", "th"]).select("text", "runs"), window)
    least = windows.groupBy("h1", "h2").agg(F.min("d0").alias("least"))
    extended = (windows.join(least, ["h1", "h2"]).where("least < d1")
                .groupBy("anchor", "run", "least").agg(F.bit_or(F.expr("shiftleft(1L, cast(off AS int))")).alias("mask")))
    hits = (live.select("anchor", "run", "doc", "th", "first").join(alike.unionByName(extended), ["anchor", "run"]).where("doc > least")
            .groupBy("doc", "th").agg(F.collect_list(F.struct("first", "mask")).alias("hits")))

    schema = pa.schema([(id_col, pa.int64()), (text_col, pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("removed", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), ("kept", pa.string())])

    def start():
        bits = np.arange(64)

        def each(key, text, hits):
            words = split_words(text)
            gone, spans = None, []
            if hits:
                first, mask = (np.array([h[c] for h in hits], np.int64) for c in ("first", "mask"))
                at, bit = np.nonzero(mask[:, None] >> bits & 1)
                s = first[at] + bit
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, s, 1)
                np.add.at(edge, s + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
                step = np.flatnonzero(np.diff(np.r_[0, gone.view(np.int8), 0]))
                spans = [{"from": a, "to": b} for a, b in zip(step[::2].tolist(), step[1::2].tolist())]
                kept = b" ".join([w for w, x in zip(words, gone.tolist()) if not x])
            else:
                kept = b" ".join(words)
            yield 2 * len(kept), None if key == NULL_ID else key, text, len(words), int(gone.sum()) if gone is not None else 0, spans, kept.decode("utf-8", "surrogatepass")

        return each

    return map_rows(d.join(hits, ["doc", "th"], "left").select("doc", "text", "hits", *([F.col("carry").alias(carry)] if carry else [])), schema,
                    f"`{id_col}` long, `{text_col}` string, n_words long, n_removed long, removed array<struct<from:long,to:long>>, kept string", start, carry)
