"""Language identification by interpolated Kneser-Ney character models.

One model per language over the characters of words (a word starts and ends with
a space), of order ``order``. Raw counts at the top order, continuation counts
below, absolute discounting, interpolated down to a uniform character. All
models share one sorted array of 64-bit hashes per order: a row holds, for each
language, the finished log probability of that n-gram, or the weight with which
a context backs off. A text gets, per language, its cross-entropy in nats per
character; the least wins. A word is scored once per batch of documents and
then counted, so the whole text counts at the cost of its distinct words.

The fit uses at most ``sample`` texts of each language (those with the least
hash of their id): the model is bounded by that parameter, so it may be
broadcast. A fifth of them calibrates instead: a text is *rejected* if its
cross-entropy is above the worst calibration text of its language by more than
``slack``, or if it has no letter. A language without a calibration text takes
the limit of all languages' calibration texts together; without any, no text may
be worse than evenly drawn characters.

Null or letterless texts: ``und``, score 0, rejected. Null languages teach
nothing; with no labelled text all is ``und``. Ties go to the language that
sorts first. Repeated rows and ids are separate rows. Only the id, the text and,
for the fit, the language are read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit.llm.common import out_schema
from panelkit.llm.substr import mix
from panelkit.llm.tokcount import Ids

#: Probability of a character never seen: one of so many.
CHARACTERS = 4096
DISCOUNT = 0.75
#: Words scored at once, and words a worker remembers with their scores.
CHUNK, MEMO = 1 << 20, 400_000
#: Calibration texts scored at once.
TEST_TEXTS = 16
_LETTER = re.compile(r"[^\W\d_]").search
B = np.uint64(0x9E3779B97F4A7C15)


def has_letter(word: str) -> bool:
    """Whether a character is of category L (fractions and circled digits are not)."""
    return word.isalpha() or _LETTER(word) is not None and any(map(str.isalpha, word))


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n-gram that starts at each place (short by n - 1 at the end)."""
    h = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        h = mix(h + codes[k:len(codes) - n + 1 + k] * B + np.uint64(k + 1))
    return h


def code_points(words: list[str]) -> np.ndarray:
    """Code points of `` word word ... `` (a space before, between and after)."""
    return np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


@dataclass
class LanguageModels:
    languages: list[str]
    order: int
    grams: list[np.ndarray]      # per order, sorted hashes
    logp: list[np.ndarray]       # per order, [grams, languages]: finished log probabilities
    contexts: list[np.ndarray]   # per order, sorted hashes of contexts
    backoff: list[np.ndarray]    # per order, [contexts, languages]: log weight of the lower order
    limit: np.ndarray | None = None  # per language: cross-entropy above which a text is rejected

    def word_scores(self, words: list[str]):
        """``[words, languages]`` log probabilities, characters per word, letters or not."""
        codes = code_points(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1  # with the space after it
        n_lang, space = len(self.languages), np.flatnonzero(codes == 32)
        starts = space[:-1] if len(space) == len(words) + 1 else np.r_[0, np.cumsum(lengths)[:-1]]
        # place of each character in its word: its context reaches back to the space before it
        total = int(lengths.sum())
        in_word = np.arange(total) - np.repeat(starts, lengths)
        out = np.zeros((total, n_lang), np.float32)
        left = np.arange(total)
        for n in range(self.order, 0, -1):
            h = gram_hashes(codes, n)
            fits = in_word[left] + 2 >= n
            at = left[fits] + 1 - (n - 1)  # the n-gram ends at character left + 1
            found, row = lookup(self.grams[n - 1], h[at])
            hit = left[fits][found]
            out[hit] += self.logp[n - 1][row[found]]
            miss = np.ones(len(left), bool)
            miss[np.flatnonzero(fits)[found]] = False
            if n > 1:
                lost = np.flatnonzero(fits)[~found]
                c = gram_hashes(codes, n - 1)
                known, row = lookup(self.contexts[n - 1], c[left[lost] + 1 - (n - 1)])
                out[left[lost][known]] += self.backoff[n - 1][row[known]]
            left = left[miss]
        out[left] -= np.float32(np.log(CHARACTERS)) - self.backoff[0][0]
        sums = np.add.reduceat(out, np.r_[0, np.cumsum(lengths)[:-1]], axis=0) if len(words) else np.zeros((0, n_lang), np.float32)
        letters = np.fromiter(map(has_letter, words), bool, len(words))
        return sums, lengths, letters


def lookup(table: np.ndarray, keys: np.ndarray):
    at = np.minimum(np.searchsorted(table, keys), max(len(table) - 1, 0))
    return (table[at] == keys) if len(table) else np.zeros(len(keys), bool), at


def build(counts: dict[str, Counter], order: int) -> LanguageModels:
    """Models from word counts per language."""
    languages = sorted(counts)
    per = []  # [language][order] -> (hashes, numerators)
    contexts_of: list[dict] = [{} for _ in range(order)]
    for lang in languages:
        words = list(counts[lang])
        codes, freq = code_points(words), np.fromiter(counts[lang].values(), np.float64, len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        in_word = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        weight, place = np.repeat(freq, lengths), np.arange(lengths.sum())
        tables = []
        higher = None
        for n in range(order, 0, -1):
            at = place[in_word + 2 >= n] + 1 - (n - 1)
            g, first, index = np.unique(gram_hashes(codes, n)[at], return_index=True, return_inverse=True)
            num = np.bincount(index, weight[in_word + 2 >= n], len(g))
            whole = num
            if higher is not None:
                # below the top: distinct continuations to the left, and the raw count where the word starts
                ext = np.zeros(len(g))
                np.add.at(ext, np.searchsorted(g, higher), 1)
                num = np.where(ext > 0, ext, num)
            ctx = gram_hashes(codes, n - 1)[at[first]] if n > 1 else np.zeros(len(g), np.uint64)
            low = gram_hashes(codes, n - 1)[at[first] + 1] if n > 1 else None
            tables.append((g, num, ctx, low, whole))
            higher = low
        per.append(tables[::-1])
    grams, logp, contexts, backoff = [], [], [], []
    lower = None
    for n in range(1, order + 1):
        g = np.unique(np.concatenate([p[n - 1][0] for p in per]))
        ctx = np.unique(np.concatenate([p[n - 1][2] for p in per]))
        low = np.zeros(len(g), np.uint64)
        ctx_of = np.zeros(len(g), np.int64)
        for p in per:
            at = np.searchsorted(g, p[n - 1][0])
            ctx_of[at] = np.searchsorted(ctx, p[n - 1][2])
            if n > 1:
                low[at] = p[n - 1][3]
        p_out, b_out = np.zeros((len(g), len(languages))), np.zeros((len(ctx), len(languages)))
        for k, p in enumerate(per):
            own, num, own_ctx, _, _ = p[n - 1]
            at, c = np.searchsorted(g, own), np.searchsorted(ctx, own_ctx)
            total, types = np.bincount(c, num, len(ctx)), np.bincount(c, minlength=len(ctx))
            weight = np.where(total > 0, np.minimum(1.0, DISCOUNT * types / np.maximum(total, 1e-9)), 1.0)
            full = np.zeros(len(g))
            full[at] = np.maximum(num - DISCOUNT, 0)
            base = 1 / CHARACTERS if n == 1 else np.exp(lower[:, k][np.searchsorted(grams[-1], low)])
            t = total[ctx_of]
            p_out[:, k] = np.log(np.where(t > 0, full / np.maximum(t, 1e-9), 0) + weight[ctx_of] * base)
            b_out[:, k] = np.log(weight)
        grams.append(g)
        lower = p_out
        logp.append(p_out.astype(np.float32))
        contexts.append(ctx)
        backoff.append(b_out.astype(np.float32))
    return LanguageModels(languages, order, grams, logp, contexts, backoff)


class Scorer:
    """Scores texts in chunks; words seen lately keep their scores."""

    def __init__(self, model: LanguageModels):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.ids, self.known = Ids(), 0
        self.score = np.zeros((0, len(self.model.languages)), np.float32)
        self.length, self.letters = np.zeros(0, np.int64), np.zeros(0, bool)

    def __call__(self, texts: list[str | None]):
        """``[texts, languages]`` log probabilities and characters, over words with a letter."""
        if len(self.ids) > MEMO:
            self._reset()
        rows = []
        for t in texts:
            words = (t or "").lower().split()
            rows.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        fresh = list(self.ids)[self.known:]
        for k in range(0, len(fresh), CHUNK // 8):
            s, n, has = self.model.word_scores(fresh[k:k + CHUNK // 8])
            self.score, self.length, self.letters = np.concatenate([self.score, s * has[:, None]]), np.r_[self.length, n * has], np.r_[self.letters, has]
        self.known = len(self.ids)
        lens = np.array([len(r) for r in rows], np.int64)
        out, chars = np.zeros((len(rows), len(self.model.languages))), np.zeros(len(rows))
        full = np.flatnonzero(lens)
        if len(full):
            at = np.concatenate(rows)
            cuts = np.r_[0, np.cumsum(lens[full])[:-1]]
            for k in range(out.shape[1]):
                out[full, k] = np.add.reduceat(self.score[:, k][at].astype(np.float64), cuts)
            chars[full] = np.add.reduceat(self.length[at], cuts)
        return out, chars


def chunks(keys: list, texts: list):
    """Rows in lists of about ``CHUNK`` characters."""
    k, size = 0, 0
    for j, t in enumerate(texts):
        size += len(t or "")
        if size > 4 * CHUNK:
            yield keys[k:j + 1], texts[k:j + 1]
            k, size = j + 1, 0
    yield keys[k:], texts[k:]


def fit(docs: DataFrame, order: int = 4, sample: int = 1000, slack: float = 0.6, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> LanguageModels:
    """Models from at most ``sample`` labelled texts of each language."""
    labelled = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    # the least hashes of each language: thinned by its count first, so that no sort sees a whole language
    n = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.xxhash64("id", F.lit("sample")).bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    # one row per language, as the model has a column per language: it may be broadcast
    thin = (labelled.select("id", "lang").join(F.broadcast(n), "lang").withColumn("u", share).where(F.col("u") * F.col("n") < 2.0 * sample + 40)
            .withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("u", "id"))).where(F.col("r") <= sample).select("id", "lang", "r"))
    # bounded by sample x languages, so it may be broadcast
    chosen = labelled.join(F.broadcast(thin), ["id", "lang"])
    schema = pa.schema([("lang", pa.string()), ("test", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches):
        words: dict = {}
        for b in batches:
            for text, lang, r in zip(*(b.column(c).to_pylist() for c in ("text", "lang", "r"))):
                if r % 5:
                    words.setdefault(lang, Counter()).update(w for w in text.lower().split() if has_letter(w))
                else:
                    yield pa.record_batch([pa.array([lang]), pa.array([True]), pa.array([text], pa.string()), pa.array([1])], schema=schema)
        for lang, c in words.items():
            yield pa.record_batch([pa.array([lang] * len(c), pa.string()), pa.array([False] * len(c)), pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], schema=schema)

    rows = chosen.mapInArrow(count, "lang string, test boolean, word string, n long").groupBy("lang", "test", "word").agg(F.sum("n").alias("n")).toArrow()
    counts: dict[str, Counter] = {}
    test_langs, texts = [], []
    for batch in rows.to_batches(max_chunksize=10_000):
        for lang, test, word, freq in zip(*(c.to_pylist() for c in batch.columns)):
            if test:
                test_langs.append(lang)
                texts.append(word)
            else:
                counts.setdefault(lang, Counter())[word] = freq
    del rows
    if not counts:
        return LanguageModels([], order, [], [], [], [])
    model = build(counts, order)
    del counts
    model.limit = np.full(len(model.languages), 0.0)
    # a few texts at a time: the driver holds the arrays of those alone
    scorer = Scorer(model)
    parts = [scorer(texts[k:k + TEST_TEXTS]) for k in range(0, len(texts), TEST_TEXTS)] or [scorer([])]
    score, chars = np.concatenate([s for s, _ in parts]), np.concatenate([c for _, c in parts])
    alone = []
    for k, lang in enumerate(model.languages):
        own = (np.array(test_langs, object) == lang) & (chars >= 20)
        if own.any():
            model.limit[k] = (-score[own, k] / chars[own]).max() * (1 + slack)
        else:
            alone.append(k)
    if alone:
        model.limit[alone] = model.limit.max() if len(alone) < len(model.languages) else np.log(CHARACTERS)
    return model


def identify(docs: DataFrame, model: LanguageModels, id_col: str = "doc_id", text_col: str = "text", carry: str | None = None) -> DataFrame:
    """``(id, lang_pred, score, entropy, rejected)``: ``score`` is the winner's
    share of the likelihood (0 to 1), ``entropy`` its nats per character. ``carry`` names a
    column that goes along."""
    schema = pa.schema([(id_col, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("entropy", pa.float64()), ("rejected", pa.bool_())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        names, scorer = np.array([*m.languages, "und"], object), Scorer(m)
        for b in batches:
            done = 0
            for keys, texts in chunks(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s, chars = scorer(texts) if m.languages else (np.zeros((len(keys), 0)), np.zeros(len(keys)))
                ok = chars > 0
                best = s.argmax(1) if s.shape[1] else np.zeros(len(keys), int)
                top = s[np.arange(len(keys)), best] if s.shape[1] else np.zeros(len(keys))
                share = 1 / np.exp(s - top[:, None]).sum(1) if s.shape[1] else np.zeros(len(keys))
                entropy = -top / np.maximum(chars, 1)
                # a short text's cross-entropy is noisy: its limit is wider
                over = entropy > m.limit[best] * (1 + 2 / np.sqrt(np.maximum(chars, 1))) if s.shape[1] else ~ok
                out = pa.record_batch([pa.array(keys, pa.int64()), pa.array(names[np.where(ok, best, len(names) - 1)].tolist(), pa.string()),
                                       pa.array(np.where(ok, share, 0.0)), pa.array(np.where(ok, entropy, np.nan), from_pandas=True), pa.array(~ok | over)], schema=schema)
                yield pa.RecordBatch.from_arrays([*out.columns, b.columns[2].slice(done, len(keys))], [*schema.names, carry]) if carry else out
                done += len(keys)

    rows = docs.select(docs[id_col].cast("long"), docs[text_col].cast("string"), *([carry] if carry else []))
    return rows.mapInArrow(run, out_schema(f"`{id_col}` long, lang_pred string, score double, entropy double, rejected boolean", rows, carry))


def training_rows(id_col: str = "doc_id") -> Column:
    """The fold that may teach: crc32 of the id as text, mod 5, is not 0."""
    return F.crc32(F.col(id_col).cast("string")) % 5 != 0
