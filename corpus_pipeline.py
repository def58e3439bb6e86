"""The corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of documents. The stages cannot be expressed in SQL (trained model, patience diff, sketches, latent
search, tokenizer), so ``ORACLE_SQL`` is None and the tests compare them with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, free_name, table
from ledgerloom.llm.decontaminate import without_leaks
from ledgerloom.llm.language_id import UNKNOWN, train, with_language
from ledgerloom.llm.line_dedup import dedup_lines
from ledgerloom.llm.near_dedup import MAX_BROADCAST, near_duplicates
from ledgerloom.llm.packing import pack_documents
from ledgerloom.llm.queries import tokenizer_path

#: A text below this score is claimed by no language's classifier, not even weakly.
LEAST_SCORE = 0.25


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (null and empty ones too) and texts that every classifier disowns.

    Rows are judged one by one, so repeated rows and null ids are kept or go alike. Where nothing can be learned
    (no labels, an empty table) no text has a language, and nothing stays.
    """
    tag = free_name(docs.columns, "_language")
    scored = with_language(docs, train(docs), into=tag)
    return scored.where((F.col(f"{tag}.lang_pred") != UNKNOWN) & (F.col(f"{tag}.score") >= LEAST_SCORE)).select(*_columns(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later documents lose the passages they share with earlier ones; one of which nothing is left goes.

    ``n_chars``, where there is such a column, counts the text that is left. Rows without an id or a text, and repeated
    rows of one id, lose nothing on each other's account. An empty table stays empty.
    """
    tag = free_name(docs.columns, "_cut")
    cut = dedup_lines(docs, into=tag)
    kept = cut.where(F.col(tag).isNull() | (F.length(F.trim(F.regexp_replace("text", r"\s+", " "))) > 0))
    length = F.when(F.col(tag).isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return kept.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; of rows that repeat an id, one (the least by hash and text).

    Rows without an id stay, and so do null and empty texts, which are linked with nothing. An empty table stays empty.
    """
    judged = Scratch(spark, "near-stage").keep(near_duplicates(docs), "judged")
    named = judged.where("doc_id is not null")
    gone = named.where("not kept").select("doc_id").distinct()
    kept = docs.join(F.broadcast(gone) if gone.count() <= MAX_BROADCAST else gone, "doc_id", "left_anti").select(*_columns(docs))
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    place = free_name(docs.columns, "_n")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    single = kept.where("doc_id is not null").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    return single.select(*_columns(docs)).union(kept.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a paraphrase of one, go.

    Rows are judged one by one on their whole texts, repeated ones and those without an id too; null and empty texts hold
    nothing. Without documents or benchmark items nothing goes.
    """
    return without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*_columns(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents in sequences of at most 4096 tokens; see ``pack_documents`` for odd rows."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again.

    What a stage kept for itself, and its predecessor's documents, go once its own are written.
    """
    scratch = Scratch(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        mark = Scratch.mark()
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        Scratch.sweep(spark, mark)
        if last:
            scratch.drop(last)
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
