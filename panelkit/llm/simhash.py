"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at ``k`` bits or fewer meet half-way: flipping up to ``k // 2``
bits of either gives a common variant if they differ in ``k - 1`` bits or fewer
(``k`` even: ``k``). For an odd ``k`` the other pairs differ in exactly ``k`` bits,
so their parities differ, and one 32-bit half holds ``(k + 1) / 2`` of the bits:
fingerprints of even parity also emit the variants with ``(k + 1) / 2`` flips in
one half. For ``k = 3`` that is 65 or 1,057 variants (no smaller set of pairs of
bits meets every triple, by Mantel's theorem).

Only distinct fingerprints emit. A variant travels as 8 bytes (its scrambled
value, and which flips made it), packed per bucket of the value, so a bucket
holds an even share however close the fingerprints lie. Equal variants imply a
link; a star from one of the near fingerprints keeps all of them connected
without all pairs of a group. Each link is verified by its Hamming distance.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; shingles repeat. Null
and empty texts have fingerprint zero and link like any other. Repeated ids keep
one row each. Only the id and the text are read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import map_rows, materialize
from panelkit.llm.components import components
from panelkit.llm.tokcount import groups

#: Fixed value: the seed of the shingles' XXH64.
SEED = 42
#: Fingerprints that emit their variants at once, and shingles whose bits are counted at once.
EMIT, COUNT = 2048, 1 << 16
SCRAMBLE = np.uint64(0x9E3779B97F4A7C15)
UNSCRAMBLE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOW = np.uint64((1 << 52) - 1)


def fingerprint(text: str | None, shingle: int) -> int:
    """64 bits: a bit is set if more than half of the shingles' hashes have it."""
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:len(words) - k]].tolist()
    ends = (ends[k - 1:] - 1).tolist()
    counts, n = np.zeros(64, np.int64), len(ends)
    for at in range(0, n, COUNT):
        digests = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in zip(starts[at:at + COUNT], ends[at:at + COUNT])])
        counts += np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)``: the fingerprint as a signed long."""
    def start():
        def each(key, text):
            yield 16, key, fingerprint(text, shingle)
        return each

    return map_rows(docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")),
                    pa.schema([(id_col, pa.int64()), ("fp", pa.int64())]), f"`{id_col}` long, fp long", start)


def flips(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the near variants, and of the far ones (odd ``k``)."""
    def masks(bits, r):
        return [sum(1 << b for b in c) for c in itertools.combinations(bits, r)]

    near = [m for r in range(k // 2 + 1) for m in masks(range(64), r)]
    far = [m for half in (range(32), range(32, 64)) for m in masks(half, (k + 1) // 2)] if k % 2 else []
    return np.array(near, np.uint64), np.array(far, np.uint64)


def links(fps: DataFrame, max_bits: int = 3, fp_col: str = "fp") -> DataFrame:
    """``(a, b)``, ``a < b``: distinct links between distinct fingerprints, each at
    ``max_bits`` or fewer, that connect whatever such links connect."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3: the flips of a variant take 12 bits")
    near, far = flips(max_bits)
    all_flips = np.concatenate([near, far])
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shift = np.uint64(64 - max(12, (4 * n - 1).bit_length()))
    schema = pa.schema([("bucket", pa.int32()), ("variants", pa.binary())])

    def emit(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fp), EMIT):
                own = fp[at:at + EMIT]
                even = own[np.bitwise_count(own) % 2 == 0]
                v = np.concatenate([np.bitwise_xor.outer(own, near).ravel(), np.bitwise_xor.outer(even, far).ravel()])
                code = np.concatenate([np.tile(np.arange(len(near), dtype=np.uint64), len(own)),
                                       np.tile(np.arange(len(near), len(all_flips), dtype=np.uint64), len(even))])
                u = (v ^ (v >> np.uint64(32))) * SCRAMBLE
                order = np.argsort(u)
                bucket, packed = (u[order] >> shift).astype(np.int32), ((u[order] & LOW) << np.uint64(12)) | code[order]
                cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)]
                yield pa.record_batch([pa.array(bucket[cuts[:-1]], pa.int32()),
                                       pa.array([packed[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())], schema=schema)

    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def meet(batches):
        found, size = [], 0

        def flush():
            pairs = np.unique(np.concatenate(found), axis=0).view(np.int64) if found else np.zeros((0, 2), np.int64)
            found.clear()
            return pa.record_batch([pa.array(pairs.min(1, initial=2**63 - 1) if len(pairs) else [], pa.int64()),
                                    pa.array(pairs.max(1, initial=-2**63) if len(pairs) else [], pa.int64())], schema=out)

        for held in groups(batches, "bucket"):
            bucket = np.uint64(held[0].column("bucket")[0].as_py())
            x = np.frombuffer(b"".join(b for part in held for b in part.column("variants").to_pylist()), np.uint64)
            x = np.sort(x)
            value, code = x >> np.uint64(12), (x & np.uint64(4095)).astype(np.int64)
            # the top of the value is the bucket's (of 12 bits or more)
            u = (value & LOW) | ((bucket << shift) & ~LOW)
            w = u * UNSCRAMBLE
            fp = (w ^ (w >> np.uint64(32))) ^ all_flips[code]
            first = np.r_[True, u[1:] != u[:-1]]
            head = np.maximum.accumulate(np.where(first, np.arange(len(x)), 0))
            keep = ~first & (code[head] < len(near))
            a, b = fp[head[keep]], fp[keep]
            ok = (a != b) & (np.bitwise_count(a ^ b) <= max_bits)
            if ok.any():
                pairs = np.unique(np.sort(np.stack([a[ok], b[ok]], 1), 1), axis=0)
                found.append(pairs)
                size += len(pairs)
                if size > 1 << 20:
                    yield flush()
                    size = 0
        yield flush()

    variants = fps.select(F.col(fp_col).cast("long")).distinct().repartition(n, F.xxhash64(fp_col)).mapInArrow(emit, "bucket int, variants binary")
    return variants.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component_id)``: the least id that links reach."""
    fps = materialize(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    least = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = components(links(fps, max_bits))
    by_fp = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    of_root = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    return fps.join(by_fp.join(of_root, "root").select("fp", "component_id"), "fp").select(id_col, "fp", "component_id")
