"""Mixing sources to target weights, in DataFrame expressions alone.

Words are summed by source (partial sums first, so a hot source is a few rows
before it moves). The sources in code point order (null last) take the weights in
turn. A source's target is its weight's share of all words, but no more than
``most`` times its own words; what is over goes to the others by weight until
none is above. A round of that needs two sums over the sources: the words and
the weights of those at their limit. The driver holds these two whole numbers
only, so the comparison is exact. The rate of a source is its target by its
words. A document is taken floor(rate) times, and once more if its draw, from a
hash of seed and id, is below the fraction.

Sources in global order come from a range partitioned sort, not from one task.
The rates are broadcast if they are few and short (counted first); otherwise the
join goes by source, with the sources of over a thousandth of the rows (fewer than
a thousand of them) spread over ``SALTS`` tasks each.

Null text: no words. A null source is a source, the last one. A null id draws by
its text. Rows with the same id draw alike. A source without words has target and
rate 0. An empty table gives no rows. Other columns are not read; ``carry`` and
``mix`` take them along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import materialize
from panelkit.operators.ranking import global_rank

WORD = r"[^\x20\x09-\x0D]+"
#: A rate table up to this size is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20
SALTS = 64
#: A draw has so many hexadecimal digits, as many as a double holds exactly.
DIGITS = 13
ROW = "__row__"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number from 0 to below 1, the same in every run."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text.cast("string"), F.lit(""))))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key), 256), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** DIGITS))


def sized(docs: DataFrame, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: str | None = None) -> DataFrame:
    """``(doc_id, source, size long, draw double)`` per row, and the carried column."""
    i, t = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(i.alias("doc_id"), F.col(f"`{source_col}`").alias("source"), words(t).alias("size"), draw(i, t, seed).alias("draw"),
                       *([F.col(f"`{carry}`")] if carry else []))


def rates(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """``(source, n_docs, source_size, weight, target, rate)`` from ``(source, size)`` rows."""
    if most < 1 or not weights or min(weights) < 1:
        raise ValueError("weights and the limit are whole numbers from 1")
    sums = materialize(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "sources")
    ranked = global_rank(sums, [F.col("source").asc_nulls_last()], "at")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    exact = lambda c: c.cast("decimal(18,0)")
    sources = materialize(ranked.select("source", "n_docs", "source_size", F.element_at(turn, ((F.col("at") - 1) % len(weights) + 1).cast("int")).alias("weight"),
                                        (exact(F.col("source_size")) * exact(F.lit(most))).cast("decimal(20,0)").alias("limit")), "weights")
    total = sources.agg(F.sum(exact(F.col("source_size"))), F.sum("weight")).first()
    words_all, weight_all = int(total[0] or 0), int(total[1] or 0)
    share = (words_all, weight_all)  # words for each unit of weight, as a fraction
    while True:
        at_limit = F.col("limit") * F.lit(share[1]).cast("decimal(18,0)") <= exact(F.col("weight")) * F.lit(share[0]).cast("decimal(20,0)")
        held = sources.where(at_limit).agg(F.sum("limit"), F.sum("weight")).first()
        was, share = share, (words_all - int(held[0] or 0), weight_all - int(held[1] or 0))
        if share in (was, (share[0], 0)):
            break
    free = F.col("weight").cast("double") * F.lit(float(share[0])) / F.lit(float(share[1] or 1))
    target = F.when(at_limit, F.col("limit").cast("double")).otherwise(free)
    out = sources.select("source", "n_docs", "source_size", "weight", target.alias("target"))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    return out.withColumn("rate", F.least(rate, F.lit(float(most))))


def copies(sizes: DataFrame, rate_table: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``sizes`` with its source's ``source_size``, ``target`` and ``rate``, and the
    times each row is taken (``copies``)."""
    r = rate_table.select(F.col("source").alias("s"), "source_size", "target", "rate", "n_docs")
    n, length, rows = r.agg(F.count(F.lit(1)), F.sum(F.octet_length("s")), F.sum("n_docs")).first()
    if n <= broadcast_rows and (length or 0) <= BROADCAST_BYTES:
        joined = sizes.join(F.broadcast(r), F.col("source").eqNullSafe(F.col("s")))
    else:
        hot = F.col("n_docs") * 1000 > F.lit(rows)
        often = r.where(hot).select(F.col("s").alias("h"), F.lit(True).alias("often"))
        dealt = sizes.join(F.broadcast(often), F.col("source").eqNullSafe(F.col("h")), "left")
        salt = F.when(F.col("often"), F.floor(F.col("draw") * 2 ** 20).cast("int") % SALTS).otherwise(0)
        spread = r.withColumn("t", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
        joined = dealt.withColumn("salt", salt).join(spread, F.col("source").eqNullSafe(F.col("s")) & (F.col("salt") == F.col("t")))
    whole = F.floor("rate")
    more = F.when(F.col("draw") < F.col("rate") - whole, 1).otherwise(0)
    return joined.select(*sizes.columns, "source_size", "target", "rate", (whole + more).cast("int").alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 42, **cols: str) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as it is taken, with
    the columns of ``docs``. Texts are read twice, first for the sums."""
    whole = docs.select("*", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    taken = copies(sized(whole, seed, carry=ROW, **cols), rates(sized(docs, seed, **cols), weights, most))
    each = taken.where("copies > 0").select(ROW, F.explode(F.array_repeat(F.lit(1), F.col("copies"))))
    return each.select(*[F.col(f"{ROW}.`{c}`") for c in docs.columns])


def mixture(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 42, **cols: str) -> DataFrame:
    """``(doc_id, source, size, source_size, target, rate, copies)`` per document;
    texts are read once."""
    sizes = materialize(sized(docs, seed, **cols), "sizes")
    return copies(sizes, rates(sizes, weights, most)).drop("draw")
