"""From raw documents to packed sequences: five stages, each one operator of ``cinderlake.llm``.

A stage sees what the one before kept, and all but the last return the columns of the documents as
they came. Rows without a doc_id or text, and ids that repeat, are handled as each operator says. The
session's bound on the rows of an Arrow batch is lowered, as rows are whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderlake.llm import dedup, jaccard, mixing, packing, quality
from cinderlake.llm.common import id_crc, short_batches, table, without
from cinderlake.llm.queries import LANGUAGE_WEIGHTS, absent_languages, tokenizer_path
from cinderlake.workspace import materialize

LEAST_QUALITY = 0.7
# Rows of an Arrow batch at most; the executor and its worker both hold one, and its buffers double as they grow.
BATCH_ROWS = 500


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.7 or more; learned from ids whose crc32 mod 4 is not 2."""
    short_batches(spark, BATCH_ROWS)
    labels = table(spark, sf_dir, "labels").filter(id_crc() % 4 != 2)
    return quality.keep_good(docs, quality.fit(docs, labels), LEAST_QUALITY)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id; of rows that repeat both, one."""
    short_batches(spark, BATCH_ROWS)
    verdicts = materialize(dedup.exact_groups(docs), "verdicts")
    sha = F.sha2(F.coalesce(docs["text"], F.lit("")).cast("binary"), 256)
    dropped = verdicts.where("NOT kept").select(
        F.col("doc_id").alias("dropped_id"), F.col("text_sha256").alias("dropped_sha")
    )
    dropped = materialize(dropped.distinct(), "dropped")
    kept = without(
        docs, dropped, docs["doc_id"].eqNullSafe(F.col("dropped_id")) & (sha == F.col("dropped_sha"))
    )
    repeated = verdicts.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
    repeated = materialize(
        repeated.select(F.col("doc_id").alias("repeated_id")).distinct(), "repeated"
    )
    if repeated.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(F.col("repeated_id"))
    again = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return without(kept, repeated, same).unionByName(again)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at 0.8 or more, the one with the smallest doc_id."""
    short_batches(spark, BATCH_ROWS)
    found = jaccard.jaccard_components(docs, n=5, num=80)
    dropped = found.where("component_id <> doc_id").select(F.col("doc_id").alias("dropped_id"))
    dropped = materialize(dropped.distinct(), "dropped")
    return without(docs, dropped, docs["doc_id"] == F.col("dropped_id"))


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of the documents whose expected tokens have the wanted share of each language.

    A wanted language that no labelled document has is left out, and the shares of the others are
    scaled to add up to 1; the log says which.
    """
    short_batches(spark, BATCH_ROWS)
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct()
    labelled = docs.select("doc_id", "lang").join(labelled, "doc_id", "left_semi")
    absent = absent_languages(labelled)
    mixer, _ = mixing.fit(docs, labelled, "lang", LANGUAGE_WEIGHTS, ignored=absent)
    return mixing.keep_mixed(docs, mixer)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 512 to 4096 tokens."""
    short_batches(spark, BATCH_ROWS)
    return packing.pack(docs, packing.word_tokenizer(tokenizer_path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_languages),
    ("packing", pack),
]

# Two stages are trained models and packing cuts by tokens, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents. Each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
