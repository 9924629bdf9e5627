"""Byte-level BPE as a bounded-lookahead streaming transducer, and its decoder.

Why a bounded lookahead is enough. Run the merge list over a text and over the
same text with more bytes appended, rule by rule, and look at the first token
in which the two differ. A rule ``(u, v)`` moves that place to the left, by
``len(u)``, only if it applies in one run and not in the other: ``v`` is then
the differing token of that run, and that token begins with the left part of
the rule that moved the place before. Each rule moves it once at most, and the
rules of such a chain have rising ranks. So the place never moves further than
the heaviest chain, and :meth:`Merges.lookahead` is its weight (339 bytes for
the 50k list): a token that ends so many bytes before the end of the bytes read
so far is final and is emitted. What follows a final token is encoded as if it
stood alone, so the transducer holds one window of ``block + lookahead`` bytes,
however long a piece is.

Nulls: a null text is an empty text (no ids, empty decoding). Rows are
independent; ties, repeated rows and empty tables need no care. Input columns
other than the id and the text are not read.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from array import array
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from panelkit.llm.common import map_rows

#: The 25 code points of Unicode's White_Space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters and numbers of Unicode 16 that Python's table (15.1) lacks, as code point ranges.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
               (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
               (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
               (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: Where Unicode versions differ. Texts with one of these take the slower, explicit pattern.
RECENT_RANGES = [(0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x1C89, 0x1C8A), (0x208F, 0x208F),
                 (0x209D, 0x209F), (0xA7CB, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x10000, 0x10FFFF)]


def ranges(pairs) -> str:
    """Text of code point ranges for a character class."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in pairs)


RECENT = re.compile(f"[{ranges(RECENT_RANGES)}]")
#: Texts are cut into segments of about so many characters, at places where every piece ends.
SEGMENT = 1 << 18
SAFE_CUT = regex.compile(r"\p{L}(?= \p{L})")
#: A worker's memo holds so many short pieces; when full it starts anew.
MEMO_ENTRIES, MEMO_PIECE = 400_000, 64


@cache
def unicode_class(initial: str) -> str:
    """Ranges of a general category (``L``, ``N``) as text for a character class."""
    cps = np.fromiter((cp for cp in range(0x110000) if unicodedata.category(chr(cp))[0] == initial), np.int64)
    breaks = np.flatnonzero(np.diff(cps) != 1)
    return ranges([*zip(cps[np.r_[0, breaks + 1]], cps[np.r_[breaks, len(cps) - 1]]), *(NEW_LETTERS if initial == "L" else NEW_NUMBERS)])


@cache
def byte_pieces(recent: bool):
    """Splits a text into the pieces within which merges happen."""
    if not recent:
        s = WHITE
        return regex.compile(rf" ?\p{{L}}+|'(?:[stmd]|re|ve|ll)| ?\p{{N}}+| ?[^{s}\p{{L}}\p{{N}}]+|[{s}]+(?![^{s}])|[{s}]+").findall
    l, n, s = unicode_class("L"), unicode_class("N"), WHITE
    return re.compile(rf" ?[{l}]+|'(?:[stmd]|re|ve|ll)| ?[{n}]+| ?[^{s}{l}{n}]+|[{s}]+(?![^{s}])|[{s}]+").findall


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable, else 256 and up in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """A byte-level BPE file: ranks, token bytes, special strings, lookahead."""

    def __init__(self, path: str, block: int = 512):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        raw = byte_alphabet()
        vocab = {bytes(map(raw.__getitem__, t)): i for t, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [tuple(bytes(map(raw.__getitem__, x)) for x in (m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        self.rank = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in reversed([*enumerate(pairs)])}
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        self.token = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in vocab.items():
            self.token[i] = t
        for t, i in self.special.items():
            self.token[i] = t.encode()
        self.length = [len(t) for t in self.token]
        self.lookahead = self._lookahead(pairs)
        self.block = max(block, max(map(len, vocab)))
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")").split if self.special else None

    @staticmethod
    def _lookahead(pairs: list[tuple[bytes, bytes]]) -> int:
        """Weight of the heaviest chain of rules: rule ``(u, v)`` follows an
        earlier one whose left part begins ``v``."""
        best: dict[bytes, int] = {}
        most = 0
        for u, v in pairs:
            d = len(u) + max(best.get(v[:k], 0) for k in range(1, len(v) + 1))
            best[u] = max(best.get(u, 0), d)
            most = max(most, d)
        return most

    def merge(self, data: bytes) -> list[int]:
        """All merges within ``data``: lowest rank first, leftmost first."""
        ids, rank = [self.byte_id[b] for b in data], self.rank
        if len(ids) > 48:
            return self._merge_long(ids)
        while len(ids) > 1:
            best = None
            for k, pair in enumerate(zip(ids, ids[1:])):
                r = rank.get(pair)
                if r is not None and (best is None or r < best):
                    best, at = r, k
            if best is None:
                break
            ids[at:at + 2] = [best[1]]
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list."""
        n, rank = len(ids), self.rank
        nxt, prv = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(r[0], k, r[1], ids[k], ids[k + 1]) for k in range(n - 1) if (r := rank.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, new, a, b = heapq.heappop(heap)
            j = nxt[k]
            if ids[k] != a or j >= n or ids[j] != b:
                continue
            ids[k], ids[j], nxt[k] = new, -1, nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = k
                if r := rank.get((new, ids[nxt[j]])):
                    heapq.heappush(heap, (r[0], k, r[1], new, ids[nxt[j]]))
            if prv[k] >= 0 and (r := rank.get((ids[prv[k]], new))):
                heapq.heappush(heap, (r[0], prv[k], r[1], ids[prv[k]], new))
        return [i for i in ids if i >= 0]

    def transduce(self, data: bytes):
        """Ids of one piece, in order, as soon as they are final."""
        window, at, length = self.block + self.lookahead, 0, self.length
        while len(data) - at > window:
            final, end = self.block, 0
            for i in self.merge(data[at:at + window]):
                if end + length[i] > final:
                    break
                end += length[i]
                yield i
            at += end
        yield from self.merge(data[at:] if at else data)


@cache
def load_merges(path: str) -> Merges:
    return Merges(path)


class Memo(dict):
    """Ids (packed, little-endian) of short pieces seen lately; bounded."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> bytes:
        ids = array("I", self.merges.transduce(piece.encode("utf-8", "surrogatepass"))).tobytes()
        if len(piece) <= MEMO_PIECE:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = ids
        return ids


def segments(text: str):
    """The text in parts that end where a piece ends whatever follows (a letter
    before a space and a letter); a part has no bound only if no such place comes."""
    at = 0
    while len(text) - at > SEGMENT and (m := SAFE_CUT.search(text, at + SEGMENT)):
        yield text[at:m.end()]
        at = m.end()
    yield text[at:] if at else text


def encode_text(text: str, merges: Merges, memo: Memo):
    """Packed ids of a text, part by part."""
    for k, part in enumerate(merges.split_special(text) if merges.split_special else [text]):
        if k % 2:
            yield array("I", [merges.special[part]]).tobytes()
        elif part:
            for s in segments(part):
                yield b"".join(map(memo.__getitem__, byte_pieces(RECENT.search(s) is not None)(s)))


def decode_parts(parts, merges: Merges):
    """Text of packed ids: bytes go through an incremental UTF-8 machine that
    keeps an unfinished character until its last byte, and replaces bad bytes."""
    state, token = codecs.getincrementaldecoder("utf-8")("replace"), merges.token
    for p in parts:
        yield state.decode(b"".join(map(token.__getitem__, np.frombuffer(p, "<u4").tolist())))
    yield state.decode(b"", True)


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", carry: str | None = None) -> DataFrame:
    """``(id, n_tokens long, ids binary, decoded string)`` per row: ids as
    little-endian unsigned 32-bit integers, and the text they decode to. ``carry``
    names a column that goes along."""
    schema = pa.schema([(id_col, pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def start():
        merges = load_merges(tokenizer_path)
        memo = Memo(merges)

        def each(key, text):
            parts = [*encode_text(text or "", merges, memo)]
            decoded = "".join(decode_parts(parts, merges))
            ids = b"".join(parts)
            yield len(ids) + len(decoded), key, len(ids) // 4, ids, decoded

        return each

    return map_rows(docs.select(docs[id_col].cast("long"), docs[text_col].cast("string"), *[carry] * bool(carry)), schema,
                    f"`{id_col}` long, n_tokens long, ids binary, decoded string", start, carry)


def decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id, decoded string)`` of packed ids (null: empty), 65,536 ids at a time."""
    schema = pa.schema([(id_col, pa.int64()), ("decoded", pa.string())])

    def start():
        merges, step = load_merges(tokenizer_path), 4 << 16

        def each(key, ids):
            ids = ids or b""
            text = "".join(decode_parts((ids[k:k + step] for k in range(0, len(ids), step)), merges))
            yield len(text), key, text

        return each

    return map_rows(encoded.select(encoded[id_col].cast("long"), encoded[ids_col]), schema, f"`{id_col}` long, decoded string", start)
