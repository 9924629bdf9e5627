"""Benchmark decontamination by SimHash over item-sized windows.

1. Only windows that share a shingle with some item can be similar to it: a
   bitmap of the items' shingles, then a sorted lookup, finds those places of a
   text. Nothing is lost by it.
2. Around them, every window of each concerned item's length gets a SimHash of
   its shingles, weighted by their distinct words, from running sums.
3. Multi-index Hamming blocks: fingerprints of 64 bits in four blocks. Two at
   ``radius`` bits or fewer agree up to ``radius // 4`` bits in one block, so each
   item is entered under all such values of each block, and four lookups per
   window find every item within the radius.
4. Candidates within the radius are verified by the exact weighted multiset
   similarity of their shingles (sum of minima over sum of maxima).

The benchmark is read in slices of about ``slice_items`` items, each with an index
of bounded size that is broadcast; documents are scanned once a slice.

Words are white-space separated, lower case; items with fewer words than
``shingle`` are one shingle. A text shorter than an item is one window. Null and
empty texts or items match nothing; repeated rows and ids are separate rows;
an empty benchmark marks nothing. Only ids and texts are read.
"""

from __future__ import annotations

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelkit.llm.substr import mix, word_hashes

BITMAP = 22
C = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def shingles(hashed: np.ndarray, k: int) -> np.ndarray:
    n = len(hashed) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(k))
    for j in range(k):
        h = (h ^ hashed[j:j + n]) * C
        h ^= h >> np.uint64(29)
    return mix(h)


def weights(hashed: np.ndarray, k: int) -> np.ndarray:
    """Distinct words of each shingle."""
    n = len(hashed) - k + 1
    out = np.zeros(max(n, 0), np.int64)
    for j in range(k):
        fresh = np.ones(max(n, 0), bool)
        for i in range(j):
            fresh &= hashed[i:i + n] != hashed[j:j + n]
        out += fresh
    return out


def signs(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Each shingle's weight, signed by its hash's bits: ``[shingles, 64]``."""
    bits = np.unpackbits(h.astype(">u8").view(np.uint8)).reshape(-1, 64).astype(np.int32)
    return (2 * bits - 1) * w[:, None].astype(np.int32)


def pack(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).view(">u8").ravel().astype(np.uint64)


def similarity(a: Counter, b: Counter, w: dict) -> float:
    """Weighted multiset similarity: sum of minima over sum of maxima."""
    low = sum(w[s] * min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(w[s] * n for s, n in a.items()) + sum(w[s] * n for s, n in b.items())
    return low / (total - low) if total > low else 0.0


class Index:
    """The items of one slice."""

    def __init__(self, items: list[tuple], shingle: int, radius: int):
        self.ids, self.size, self.k, self.bags, self.weight = [], [], [], [], {}
        fps, where = [], {}
        for key, text in items:
            hashed = word_hashes(words_of(text))
            if key is None or not len(hashed):
                continue
            k = min(shingle, len(hashed))
            h, w = shingles(hashed, k), weights(hashed, k)
            for s in set(h.tolist()):
                where.setdefault((k, s), []).append(len(self.ids))
            self.weight |= zip(h.tolist(), w.tolist())
            self.ids.append(key)
            self.size.append(len(hashed))
            self.k.append(k)
            self.bags.append(Counter(h.tolist()))
            fps.append(pack(signs(h, w).sum(0, keepdims=True))[0])
        self.fps = np.array(fps, np.uint64)
        self.radius = radius
        self.lookup = {}
        for k in sorted(set(self.k)):
            keys = np.array(sorted(s for kk, s in where if kk == k), np.uint64)
            bitmap = np.zeros(1 << BITMAP, bool)
            bitmap[(keys >> np.uint64(64 - BITMAP)).astype(np.int64)] = True
            self.lookup[k] = (bitmap, keys, [where[k, s] for s in keys.tolist()])
        masks = np.array([sum(1 << b for b in c) for r in range(radius // 4 + 1) for c in itertools.combinations(range(16), r)], np.uint16)
        self.blocks = []
        for b in range(4):
            part = (self.fps >> np.uint64(16 * b)).astype(np.uint16)
            values = np.bitwise_xor.outer(part, masks).ravel().astype(np.int64)
            order = np.argsort(values, kind="stable")
            self.blocks.append((np.searchsorted(values[order], np.arange(65537)), (order // max(len(masks), 1)).astype(np.int32)))

    def near(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(window, item)`` pairs within the radius."""
        found = []
        for b, (offsets, items) in enumerate(self.blocks):
            v = (fps >> np.uint64(16 * b) & np.uint64(65535)).astype(np.int64)
            n = offsets[v + 1] - offsets[v]
            window = np.repeat(np.arange(len(fps)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(offsets[v], n)
            item = items[at]
            ok = np.bitwise_count(fps[window] ^ self.fps[item]) <= self.radius
            found.append(window[ok].astype(np.int64) * len(self.ids) + item[ok])
        both = np.unique(np.concatenate(found))
        return both // max(len(self.ids), 1), both % max(len(self.ids), 1)

    def matches(self, text: str | None, least: float) -> list[dict]:
        """Best window of each item that the text holds: ``{item, from, to, similarity}``."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        hashed, best = word_hashes(words), {}
        for k, (bitmap, keys, where) in self.lookup.items():
            h = shingles(hashed, k)
            at = np.flatnonzero(bitmap[(h >> np.uint64(64 - BITMAP)).astype(np.int64)])
            if not len(at):
                continue
            row = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
            ok = keys[row] == h[at]
            at, row = at[ok], row[ok]
            if not len(at):
                continue
            sizes: dict[int, list] = {}
            for p, r in zip(at.tolist(), row.tolist()):
                for size in {min(self.size[i], len(words)) for i in where[r]}:
                    sizes.setdefault(size, []).append(p)
            for size, places in sizes.items():
                self._windows(h, hashed, k, size, np.array(places), len(words), least, best)
        return [{"item": self.ids[i], "from": s, "to": e, "similarity": x} for i, (x, s, e) in sorted(best.items(), key=lambda b: self.ids[b[0]])]

    def _windows(self, h, hashed, k, size, places, n, least, best) -> None:
        """Windows of ``size`` words that hold a shingle at one of ``places``."""
        inside = size - k + 1  # shingles of a window
        lo, hi = np.maximum(places - inside + 1, 0), np.minimum(places, n - size)
        edge = np.zeros(n - size + 2, np.int64)
        np.add.at(edge, lo, 1)
        np.add.at(edge, hi + 1, -1)
        covered = np.cumsum(edge)[:-1] > 0
        step = np.flatnonzero(np.diff(np.r_[0, covered.view(np.int8), 0]))
        for a, b in zip(step[::2].tolist(), step[1::2].tolist()):
            for c in range(a, b, 1 << 14):
                d = min(b, c + (1 << 14))
                part = h[c:d + inside - 1]
                w = weights(hashed[c:d + size - 1], k)
                sums = np.concatenate([np.zeros((1, 64), np.int64), np.cumsum(signs(part, w), 0, dtype=np.int64)])
                window, item = self.near(pack(sums[inside:inside + d - c] - sums[:d - c]))
                for s, i in zip(window.tolist(), item.tolist()):
                    if self.k[i] != k or min(self.size[i], n) != size:
                        continue
                    bag = Counter(part[s:s + inside].tolist())
                    own = dict(zip(part[s:s + inside].tolist(), w[s:s + inside].tolist()))
                    x = similarity(bag, self.bags[i], self.weight | own)
                    if x >= least and (i not in best or x > best[i][0]):
                        best[i] = (x, c + s, c + s + size)


def find_leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 19, slice_items: int = 512,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               carry: str | None = None) -> DataFrame:
    """``(id, matches array<struct<item, from, to, similarity>>)`` for every row:
    its best window (in words) of each item it holds. ``carry`` names a column
    that goes along."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text")).where("item is not null and text is not null").distinct()
    n_slices = max(1, -(-items.count() // slice_items))
    match = pa.list_(pa.struct([("item", pa.int64()), ("from", pa.int64()), ("to", pa.int64()), ("similarity", pa.float64())]))
    schema, out = pa.schema([("id", pa.int64()), ("matches", match)]), None
    d = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"), *([carry] if carry else []))
    if n_slices > 1:  # slices are put together again by row
        d = d.withColumn("text_hash", F.xxhash64("text"))
    along = d.columns[2:]
    for k in range(n_slices):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(n_slices)) == k).orderBy("item", "text").collect()
        index = docs.sparkSession.sparkContext.broadcast(Index([(r["item"], r["text"]) for r in part], shingle, radius))

        def run(batches, index=index):
            for b in batches:
                found = [index.value.matches(t, similarity) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, match), *b.columns[2:]], [*schema.names, *along])

        ddl = StructType.fromDDL("id long, matches array<struct<item:long,from:long,to:long,similarity:double>>")
        got = d.mapInArrow(run, StructType([*ddl, *[d.schema[c] for c in along]]))
        out = got if out is None else out.unionByName(got)
    if n_slices > 1:
        # a row comes back once a slice; equal rows come back equally often
        out = (out.groupBy("id", *along).agg(F.flatten(F.collect_set("matches")).alias("matches"), (F.count("*") / n_slices).cast("int").alias("times"))
               .select("id", F.array_sort("matches").alias("matches"), *along, F.explode(F.sequence(F.lit(1), "times")).alias("time")).drop("time", "text_hash"))
    return out.withColumnRenamed("id", id_col)
