"""Token counts without token ids: each distinct pre-token is counted once.

1. A map over the documents makes *bundles* (some thousand documents): one row
   per distinct pre-token of a bundle, with packed postings (document of the
   bundle, frequency). That is the per-document frequency table, pre-aggregated.
2. Those rows are partitioned and sorted by pre-token; each distinct one goes
   through the tokenizer once, and its number of pieces is joined to all its
   postings as they pass (a merge join whose other side is made on the spot).
3. pieces x frequency is summed per document, first within the partition (packed
   per bundle), then per bundle.

A word in every document has one row per bundle, not per occurrence, so no key
is hot. Memory: one bundle per task, bounded by ``BUNDLE_BYTES`` of text (or one
longer document), and ``SUM_POSTINGS`` postings. Nulls: a null text is an empty
text (0 bytes, 0 tokens). Repeated ids stay separate rows. Columns other than id
and text are not read. Documents are expected from a table, whose partitions
hold the same rows in the same order if a task is run again.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.bpe import RECENT, WHITE, unicode_class

#: A bundle closes at so much text or so many documents.
BUNDLE_BYTES, BUNDLE_DOCS = 24 << 20, 60_000
#: Partial sums leave a task after so many postings.
SUM_POSTINGS = 1 << 21
#: Words that go through the tokenizer in one call.
COUNT_BATCH = 4096
#: Rows of a record batch that a bundle is handed over in.
ROWS = 20_000


@cache
def word_pieces(recent: bool):
    if not recent:
        return regex.compile(rf"\p{{L}}+|'(?:[stmd]|re|ve|ll)|\p{{N}}|[^{WHITE}\p{{L}}\p{{N}}]+").findall
    l, n = unicode_class("L"), unicode_class("N")
    return re.compile(rf"[{l}]+|'(?:[stmd]|re|ve|ll)|[{n}]|[^{WHITE}{l}{n}]+").findall


#: Lower case as the library has it where Python's differs (final sigma; letters of Unicode 16 and 17).
LOWER = ({0x3A3: 0x3C3, 0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB,
          0xA7DC: 0x19B} | {cp: cp + 0x20 for cp in range(0x10D50, 0x10D66)} | {cp: cp + 0x1B for cp in range(0x16EA0, 0x16EB9)})
SIGMA = chr(0x3A3)


def normalize(text: str) -> str:
    """Canonical composition, then lower case code point by code point."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if SIGMA in text or RECENT.search(text):
            text = text.translate(LOWER)
    return text.lower()


def pretokens(text: str, specials) -> list[str]:
    """Pre-tokens of a text; a special string is one of its own."""
    if specials is None or "<|" not in text:
        s = normalize(text)
        return word_pieces(RECENT.search(s) is not None)(s)
    out = []
    for k, part in enumerate(specials(text)):
        if k % 2:
            out.append(part)
        elif part:
            s = normalize(part)
            out += word_pieces(RECENT.search(s) is not None)(s)
    return out


class Ids(dict):
    """Words to 0, 1, 2, ... in order of appearance."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Bundle:
    """Pre-token frequencies of some documents."""

    def __init__(self):
        self.ids, self.words, self.docs, self.n_bytes, self.size = Ids(), [], [], [], 0

    def add(self, key, words: list, n_bytes: int) -> None:
        self.words.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.docs.append(key)
        self.n_bytes.append(n_bytes)
        self.size += n_bytes

    def full(self) -> bool:
        return self.size >= BUNDLE_BYTES or len(self.docs) >= BUNDLE_DOCS

    def postings(self) -> tuple[pa.Array, pa.Array]:
        """``(words, postings)`` in order of the words' numbers."""
        lens = np.fromiter(map(len, self.words), np.int64, len(self.docs))
        words, self.words = np.concatenate(self.words), []
        return pa.array(list(self.ids), pa.string()), packed_postings(words, lens, len(self.ids))


def packed_postings(words: np.ndarray, lens: np.ndarray, size: int) -> pa.Array:
    """From the word numbers (below ``size``) of texts in a row and the texts' lengths: per
    word its records of 3 bytes (document number, 16 bits; frequency, 8 bits; a frequency
    over 255 takes several records)."""
    n = len(lens)
    at = words.astype(np.int64) * n + np.repeat(np.arange(n), lens)
    at.sort()
    first = np.flatnonzero(np.diff(at, prepend=-1))
    freq = np.diff(first, append=len(at))
    word, doc = np.divmod(at[first], n)
    if len(freq) and int(freq.max()) > 255:
        times = (freq + 254) // 255
        word, doc, left = np.repeat(word, times), np.repeat(doc, times), freq - 255 * (times - 1)
        last = np.cumsum(times) - 1
        freq = np.full(len(doc), 255, np.int64)
        freq[last] = left
    records = np.empty((len(doc), 3), np.uint8)
    records[:, 0], records[:, 1], records[:, 2] = doc & 255, doc >> 8, freq
    ends = np.searchsorted(word, np.arange(size), "right") if len(word) else np.zeros(0)
    offsets = np.r_[0, 3 * ends].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(offsets), pa.py_buffer(records.tobytes())])


def records(postings: pa.Array):
    """``(document numbers, frequencies, records per row)`` of a column of postings; null rows have none."""
    postings = postings.fill_null(b"")
    offsets = np.frombuffer(postings.buffers()[1], np.int32)[postings.offset:postings.offset + len(postings) + 1]
    data = postings.buffers()[2]
    r = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].reshape(-1, 3) if data is not None and len(offsets) and offsets[-1] > offsets[0] else np.zeros((0, 3), np.uint8)
    return r[:, 0] | r[:, 1].astype(np.int64) << 8, r[:, 2].astype(np.int64), np.diff(offsets) // 3


DOC = pa.list_(pa.struct([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_words", pa.int64())]))


def bundle_rows(docs: DataFrame, words_of, id_col: str, text_col: str) -> DataFrame:
    """``(bundle, word, postings, docs)``: a row per distinct word of a bundle,
    and one with a null word that lists its documents ``[(id, n_bytes, n_words)]``.
    ``words_of()`` runs once per task and gives the function text -> words."""
    schema = pa.schema([("bundle", pa.int64()), ("word", pa.string()), ("postings", pa.binary()), ("docs", DOC)])

    def run(batches):
        from pyspark import TaskContext

        task, split, serial = TaskContext.get().partitionId(), words_of(), 0

        def close(b: Bundle):
            nonlocal serial
            name = task << 32 | serial
            serial += 1
            listed = [{"id": i, "n_bytes": n, "n_words": len(w)} for i, n, w in zip(b.docs, b.n_bytes, b.words)]
            yield pa.record_batch([pa.array([name]), pa.array([None], pa.string()), pa.array([None], pa.binary()), pa.array([listed], DOC)], schema=schema)
            words, postings = b.postings()
            for at in range(0, len(words), ROWS):
                w = words.slice(at, ROWS)
                yield pa.record_batch([pa.array(np.full(len(w), name)), w, postings.slice(at, ROWS), pa.nulls(len(w), DOC)], schema=schema)

        bundle = Bundle()
        for batch in batches:
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                bundle.add(key, split(text), len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass")))
                if bundle.full():
                    yield from close(bundle)
                    bundle = Bundle()
        if bundle.docs:
            yield from close(bundle)

    return docs.select(docs[id_col].cast("long"), docs[text_col].cast("string")).mapInArrow(
        run, "bundle long, word string, postings binary, docs array<struct<id:long,n_bytes:long,n_words:long>>")


def special_split(tokenizer_path: str):
    import json

    with open(tokenizer_path, encoding="utf-8") as f:
        strings = [t["content"] for t in json.load(f)["added_tokens"]]
    return re.compile("(" + "|".join(map(re.escape, sorted(strings, key=len, reverse=True))) + ")").split if strings else None


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens)`` per row."""
    def words_of():
        specials = special_split(tokenizer_path)
        return lambda text: pretokens(text, specials)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    freq = bundle_rows(docs, words_of, id_col, text_col)
    # the lists of documents travel along, dealt by bundle; a hash sorts faster than a string;
    # beyond 4096 tasks (about 400 GB of text) a word in all bundles is split between partitions
    by_word = (freq.withColumn("h", F.xxhash64(F.coalesce("word", F.col("bundle").cast("string")), F.shiftright("bundle", 32 + 12)))
               .repartition(n, "h").sortWithinPartitions("h").select("bundle", "word", "postings", "docs")
               .mapInArrow(piece_sums(tokenizer_path), PARTIAL_DDL))
    schema = pa.schema([(id_col, pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def total(batches):
        for held in groups(batches):
            sums, docs = np.zeros(1 << 16, np.int64), []
            for part in held:
                for packed, listed in zip(part.column("sums").to_pylist(), part.column("docs").to_pylist()):
                    if packed:
                        add_packed(sums, packed)
                    docs = listed or docs
            yield pa.record_batch([pa.array([d["id"] for d in docs], pa.int64()), pa.array([d["n_bytes"] for d in docs], pa.int64()),
                                   pa.array(sums[:len(docs)], pa.int64())], schema=schema)

    return (by_word.repartition(n, "bundle").sortWithinPartitions("bundle")
            .mapInArrow(total, f"`{id_col}` long, n_bytes long, n_tokens long"))


PARTIAL_DDL = "bundle long, sums binary, docs array<struct<id:long,n_bytes:long,n_words:long>>"
PARTIAL = pa.schema([("bundle", pa.int64()), ("sums", pa.binary()), ("docs", DOC)])


class PieceCounter:
    """Pieces of pre-tokens by the tokenizers library: many in one call, between
    spaces, where only the last piece of a pre-token is marked as an end."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        if mark := spec["model"].get("end_of_word_suffix"):
            self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(mark)]] = True
        self.ends[[t["id"] for t in spec["added_tokens"]]] = True

    def __call__(self, words: list[str]) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for k in range(0, len(words), COUNT_BATCH):
            some = words[k:k + COUNT_BATCH]
            ids = self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids
            counts = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if len(counts) != len(some) or counts.sum() != len(ids):
                counts = np.array([len(e.ids) for e in self.tokenizer.encode_batch(some, add_special_tokens=False)], np.int64)
            out.append(counts)
        return np.concatenate(out)


class DocSums:
    """Sums per (bundle, document) of what passes, packed when they leave."""

    def __init__(self, kind: str = "<i8"):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, bundles: np.ndarray, postings: pa.Array, weights: np.ndarray) -> None:
        doc, freq, per_row = records(postings)
        self.parts.append((np.repeat(bundles, per_row), doc, np.repeat(weights, per_row) * freq))
        self.size += len(doc)

    def take(self):
        """``(bundles, packed sums)``: per bundle, document numbers (16 bits), then sums."""
        if not self.parts:
            return [], []
        bundle, doc, value = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.size = [], 0
        names, index = np.unique(bundle, return_inverse=True)
        key = index.astype(np.int64) << 16 | doc
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        sums, key = np.add.reduceat(value, first) if len(first) else value, key[first]
        cuts = np.searchsorted(key >> 16, np.arange(len(names) + 1))
        doc = (key & 0xFFFF).astype("<u2")
        return names, [doc[a:b].tobytes() + sums[a:b].astype(self.kind).tobytes() for a, b in zip(cuts, cuts[1:])]


def add_packed(sums: np.ndarray, packed: bytes, kind: str = "<i8") -> None:
    k = len(packed) // 10
    sums[np.frombuffer(packed, "<u2", k)] += np.frombuffer(packed, kind, k, 2 * k)


def piece_sums(tokenizer_path: str):
    """Over rows grouped by word: pieces of each distinct word, times its
    frequencies, added up per bundle and document."""
    def run(batches):
        count, sums, last = PieceCounter(tokenizer_path), DocSums(), (None, 0)

        def flush():
            names, packed = sums.take()
            return pa.record_batch([pa.array(names, pa.int64()), pa.array(packed, pa.binary()), pa.nulls(len(packed), DOC)], schema=PARTIAL)

        for batch in batches:
            coded = batch.column(1).cast(pa.string()).dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            if not distinct:
                distinct = [""]
            if distinct[0] == last[0]:
                pieces = np.r_[last[1], count(distinct[1:])]
            else:
                pieces = count(distinct)
            last = (distinct[-1], pieces[-1])
            row = coded.indices.fill_null(0).to_numpy(zero_copy_only=False)
            bundles = batch.column(0).to_numpy()
            sums.add(bundles, batch.column(2).cast(pa.binary()), pieces[row])
            lists = batch.column(3).is_valid()
            if lists.true_count:
                kept = batch.filter(lists)
                yield pa.record_batch([kept.column(0), pa.nulls(kept.num_rows, pa.binary()), pa.array(kept.column(3).to_pylist(), DOC)], schema=PARTIAL)
            if sums.size >= SUM_POSTINGS:
                yield flush()
        yield flush()

    return run


def groups(batches, key: str = "bundle"):
    """Runs of equal keys over sorted record batches: each an iterator of slices."""
    held, name = [], None
    for b in batches:
        if not b.num_rows:
            continue
        names = b.column(b.schema.get_field_index(key)).to_pylist()
        cuts = [k for k in range(1, len(names)) if names[k] != names[k - 1]]
        for lo, hi in zip([0, *cuts], [*cuts, len(names)]):
            if names[lo] != name:
                if held:
                    yield held
                held, name = [], names[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield held
