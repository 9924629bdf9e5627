"""Fill-in-middle transformation by secondary sort.

A text is cut into units (``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``: a word
with the space before it, or space at the end). A task cuts its documents into
prefix, middle and suffix and emits them as pieces of at most ``CHUNK`` bytes, keyed
by document and position in the output. The pieces are partitioned by document
and sorted by position within each partition (the only shuffle); a stream of them
goes through an incremental digest or is joined into the output text.

Restoration reads the output alone: a state machine finds the marks in the
stream, whatever the piece they are in, and gives each part its place in the text.
The pieces are already with their document, so a second sort within the
partitions puts them in order, without a shuffle, for another stream.

A task holds one batch of documents or pieces and ``FLUSH_BYTES`` of output; a long
text is one row where it enters, and pieces from there on.

Null text: empty. A null id hashes as the empty string. Every row is a document
of its own (the key is its place in ``docs``, so give a stored table: the place
must be the same if a task is repeated), with the same id or not; rows of one id
spread over all tasks. An empty table gives no rows. Only the id and the text are
read, so other columns don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import Rows

#: Bytes of a piece, without its mark.
CHUNK = 1 << 16
#: Bytes looked at together for unit ends.
BLOCK = 1 << 20
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: The parts of a form in the order of its output.
FORMS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle"), "plain": ()}
#: The parts in the order of the text.
PLACE = {"prefix": 0, "middle": 1, "suffix": 2}
#: Pieces of one part of a text, at most.
PART = 1 << 40

FACTS = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
FACTS_DDL = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
PIECES = pa.schema([("key", pa.int64()), ("pos", pa.int64()), *FACTS, ("data", pa.binary())])
PIECES_DDL = f"key long, pos long, {FACTS_DDL}, data binary"
RESTORED = pa.schema([*PIECES, ("output_sha256", pa.string())])
RESTORED_DDL = f"{PIECES_DDL}, output_sha256 string"
DIGESTS = pa.schema([*FACTS, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
DIGESTS_DDL = f"{FACTS_DDL}, output_sha256 string, restored_sha256 string"
TEXTS = pa.schema([*FACTS, ("output", pa.string())])


class Units:
    """Where the units of a text end, found a block at a time."""

    def __init__(self, data: bytes):
        self.data, self.size = np.frombuffer(data, np.uint8), len(data)
        self.upto = np.cumsum([0, *(len(self._ends(k)) for k in range(0, self.size, BLOCK))])
        #: units; the last one ends with the text
        self.n = int(self.upto[-1]) + (self.size > 0)

    def _ends(self, at: int) -> np.ndarray:
        """Ends within a block: the places of spaces that follow a word."""
        b = self.data[max(at - 1, 0):at + BLOCK]
        space = (b == 32) | ((b >= 9) & (b <= 13))
        return np.flatnonzero(space[1:] & ~space[:-1]) + max(at - 1, 0) + 1

    def end(self, k: int) -> int:
        """Where unit k (from 1) ends, in bytes."""
        if k == 0 or k == self.n:
            return self.size if k else 0
        block = int(np.searchsorted(self.upto, k)) - 1
        return int(self._ends(block * BLOCK)[k - 1 - self.upto[block]])

    def chars(self, a: int, b: int) -> int:
        return sum(int(np.count_nonzero((self.data[k:min(k + BLOCK, b)] & 0xC0) != 0x80)) for k in range(a, b, BLOCK))


def draws(doc_id, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]


def cut(doc_id, data: bytes, seed: int = 42, share: int = 50, spm_share: int = 80):
    """``(n, form, prefix_chars, middle_chars, [(mark, start, end), ...])`` of a text:
    the parts in the order of the output, as places in its bytes."""
    units, (h1, h2, h3, h4) = Units(data), draws(doc_id, seed)
    if not data or h3 % 100 >= share or any(m in data for m in MARKS.values()):
        return units.n, "plain", None, None, [(b"", 0, len(data))]
    form = "spm" if h4 % 100 < spm_share else "psm"
    a, b = (units.end(k) for k in sorted((h1 % (units.n + 1), h2 % (units.n + 1))))
    at = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(data))}
    return units.n, form, units.chars(0, a), units.chars(a, b), [(MARKS[p], *at[p]) for p in FORMS[form]]


class Restorer:
    """From the output of a form, byte by byte, to parts of the text with their places."""

    def __init__(self, form: str):
        self.left, self.rest, self.place, self.seq = list(FORMS[form]), b"", 0, 0

    def feed(self, data: bytes, last: bool = False):
        """``(pos, bytes)`` as soon as the bytes can't be part of a mark."""
        data = self.rest + data
        while self.left and (at := data.find(MARKS[self.left[0]])) >= 0:
            yield from self._out(data[:at])
            data = data[at + 3:]
            self.place, self.seq = PLACE[self.left.pop(0)], 0
        keep = min(2, len(data)) if self.left and not last else 0
        self.rest = data[len(data) - keep:]
        yield from self._out(data[:len(data) - keep])

    def _out(self, data: bytes):
        if data:
            yield self.place * PART + self.seq, data
            self.seq += 1


def pieces(docs: DataFrame, seed: int = 42, share: int = 50, spm_share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The output as ``(key, pos, doc_id, n, form, prefix_chars, middle_chars, data)``
    rows, by document and in order within each partition; what describes the document
    stands in its first piece."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(f"`{id_col}`").cast("long"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary"))

    def run(batches):
        out = Rows(PIECES)
        for b in batches:
            for key, doc_id, data in zip(*(c.to_pylist() for c in b.columns)):
                *facts, parts = cut(doc_id, data, seed, share, spm_share)
                pos = 0
                for mark, start, end in parts:
                    for at in range(start, max(end, start + 1), CHUNK):
                        piece = mark * (at == start) + data[at:min(at + CHUNK, end)]
                        out.add(len(piece) + 60, key, pos, doc_id, *(facts if pos == 0 else (None,) * 4), piece)
                        pos += 1
                        if out.full():
                            yield out.take()
        yield out.take()

    return rows.mapInArrow(run, PIECES_DDL).repartition("key").sortWithinPartitions("key", "pos")


def by_document(batches):
    """``(document, first row, is it new)`` per row of sorted batches, as tuples."""
    key = None
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            yield row, row[0] != key
            key = row[0]


def restore(sorted_pieces: DataFrame) -> DataFrame:
    """The texts again, as sorted pieces like those of ``pieces``, from the stream of
    the output. A first row per document (``pos`` -1, no data) has what describes it
    and the digest of its output."""

    def run(batches):
        out, head, state, digest = Rows(RESTORED), None, None, None

        def ended():
            for pos, data in state.feed(b"", True):
                out.add(len(data) + 60, head[0], pos, *(None,) * 5, data, None)
            out.add(200, head[0], -1, *head[2:7], None, digest.hexdigest())

        for row, new in by_document(batches):
            if new:
                if head:
                    ended()
                head, state, digest = row, Restorer(row[4]), hashlib.sha256()
            digest.update(row[-1])
            for pos, data in state.feed(row[-1]):
                out.add(len(data) + 60, row[0], pos, *(None,) * 5, data, None)
            if out.full():
                yield out.take()
        if head:
            ended()
        yield out.take()

    return sorted_pieces.mapInArrow(run, RESTORED_DDL).sortWithinPartitions("key", "pos")


def digests(restored: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``."""

    def run(batches):
        out, head, digest = Rows(DIGESTS), None, None
        for row, new in by_document(batches):
            if new:
                if head:
                    out.add(250, *head[2:7], head[8], digest.hexdigest())
                    if out.full():
                        yield out.take()
                head, digest = row, hashlib.sha256()
            else:
                digest.update(row[7])
        if head:
            out.add(250, *head[2:7], head[8], digest.hexdigest())
        yield out.take()

    return restored.mapInArrow(run, DIGESTS_DDL)


def assemble(sorted_pieces: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output string)``: the training texts."""

    def run(batches):
        out, head, parts = Rows(TEXTS), None, []
        for row, new in by_document(batches):
            if new:
                if head:
                    out.add(sum(map(len, parts)) + 60, *head[2:7], b"".join(parts).decode("utf-8"))
                    if out.full():
                        yield out.take()
                head, parts = row, []
            parts.append(row[-1])
        if head:
            out.add(0, *head[2:7], b"".join(parts).decode("utf-8"))
        yield out.take()

    return sorted_pieces.mapInArrow(run, f"{FACTS_DDL}, output string")
