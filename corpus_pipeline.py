"""The corpus pipeline: stages that each read what the one before has written.

toxicity -> exact_dedup -> near_dedup -> pii -> packing. Every stage takes (spark, docs, sf_dir) and
returns a table; all but the last return the columns of documents, whole and of those documents
that stay. Rows with null texts, empty texts or repeated ids pass through as the operators say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import bpe, exact_dedup, jaccard, packing, pii, toxicity
from winnow.llm.common import delete, durable, ensure_checkpoint_dir, table, text_of
from winnow.llm.queries import public_codec

#: The last stage's rows depend on trained models and on packing, which SQL does not express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator scores below its threshold, trained on the labelled ones among docs."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return toxicity.keep_below(docs, model, 0.3)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the least id."""
    return exact_dedup.exact_dedup(docs, keep="min")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id."""
    return jaccard.one_of_each_class(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind; n_chars counts the new text."""
    done = pii.redact_texts(docs)
    return done.withColumn("n_chars", F.length(text_of("text")).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the permitted lengths with the tokens of all documents, by the vocabulary that op2 encodes by."""
    return packing.pack(docs, public_codec(spark, bpe.LibraryCodec))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("pii", redact_personal_data), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents. What a stage returns is written to the shared folder and read again; it is deleted when no stage reads it any more."""
    docs, folder = table(spark, sf_dir, "documents"), f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if k:
            delete(spark, f"{folder}/{STAGES[k - 1][0]}")
    done = durable(STAGES[-1][1](spark, docs, sf_dir))
    delete(spark, folder)
    return done
