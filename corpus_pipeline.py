"""The corpus pipeline: documents through five stages, each one dealt operator.

A stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; its
result is written as Parquet in the shared folder and read again as the next
stage's ``docs``. All but the last return the columns of ``documents`` (and
whatever other columns came in); the last adds the encoding. An empty table goes
through as one. Ids may repeat or be null: the stages on single texts treat each
row by itself, near_duplicates says what it does with them, and substring_dedup
takes a null id as the last one and removes nothing between rows of one id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import materialize, table

#: One struct of all input columns goes through an operator under this name.
ROW = "__row__"


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))


def _unpacked(out: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs`` again, with some of them changed."""
    return out.select(*[changed.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language the models reject, and those without letters."""
    from panelkit.llm.langid import fit, identify, training_rows

    out = identify(_packed(docs), fit(docs.where(training_rows())), carry=ROW)
    return _unpacked(out.where(~F.col("rejected")), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, the one with the least id (null last), then the
    least text hash: shingles of three words, three bits. Rows are told apart by id
    and text together, so rows of one id with different texts stand for themselves,
    rows without id are deduplicated like others, and of rows equal in both one stays."""
    from panelkit.llm import simhash

    row = F.xxhash64("doc_id", "text").alias("row")
    groups = simhash.near_duplicates(docs.select(row, "text"), shingle=3, max_bits=3, id_col="row").select("row", "component_id").distinct()
    rows = docs.select("doc_id", row).groupBy("row").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first"), F.count("*").alias("n"))
    least = rows.join(groups, "row").groupBy("component_id").agg(F.min(F.struct("first", "row", "n")).alias("x"))
    keep = least.select(F.col("x.row").alias("row"), F.col("x.n").alias("n")).distinct()
    kept = _packed(docs).select("doc_id", "text", ROW, row).join(keep, "row")
    once = kept.where("n = 1").unionByName(kept.where("n > 1").dropDuplicates(["doc_id", "text"]))
    return _unpacked(once, docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated 50-word windows go. Untouched texts stay as they are,
    others become their kept words; a document with none left goes."""
    from panelkit.llm.substr import remove_repeats

    out = remove_repeats(_packed(docs), window=50, carry=ROW)
    touched = F.col("n_removed") > 0
    text = F.when(touched, F.col("kept")).otherwise(F.col("text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(touched, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col(f"{ROW}.n_chars"))
    return _unpacked(out.where(~(touched & (F.col("n_removed") == F.col("n_words")))), docs, **changed)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    from panelkit.llm.decontam import find_leaks

    out = find_leaks(_packed(docs), table(spark, sf_dir, "benchmark"), carry=ROW)
    return _unpacked(out.where(F.size("matches") == 0), docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids (little-endian, 32 bits) and whether they decode to the text."""
    from panelkit.llm.bpe import encode_decode
    from panelkit.llm.queries import tokenizer_file

    out = encode_decode(_packed(docs), tokenizer_file("byte_bpe_50k.json"), carry=ROW)
    own = [F.col(f"{ROW}.`{c}`").alias(c) for c in docs.columns if c not in ("n_tokens", "ids", "ids_sha256", "round_trip")]
    return out.select(*own, "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"),
                      (F.col("decoded") == F.coalesce(F.col(f"{ROW}.text"), F.lit(""))).alias("round_trip"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("encoding", encoding)]
#: SQL can't express the stages' models and fingerprints; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
