"""Queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, exact_dedup, fingerprint, jaccard, licenses, packing, pii, quality, toxicity
from .common import fold_of, small_batches, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, by a model fitted to labelled documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), folds=4, held_out=2)
    return toxicity.score_toxicity(docs, model, 0.3).withColumn("held_out", fold_of("doc_id", 4) == 2)


def public_codec(spark: SparkSession, kind: type[bpe.Codec] | type[bpe.LibraryCodec] = bpe.Codec) -> bpe.Codec | bpe.LibraryCodec:
    """A codec of the public vocabulary. Both kinds give the same ids."""
    import public_tokenizers

    return kind(bpe.load_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of tokens, and digests of its ids and of the bytes that they decode to."""
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), public_codec(spark))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score, by a model fitted to labelled documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return quality.fitted_scores(docs, table(spark, sf_dir, "labels"), 0.5, folds=3, held_out=1).withColumn("held_out", fold_of("doc_id", 3) == 1)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near copies, and its number of links."""
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of equal texts; of each group the largest id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, encoded and packed: a row for each bin, with its tokens and the documents that they are from."""
    return packing.pack(table(spark, sf_dir, "documents"), public_codec(spark, bpe.LibraryCodec))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    own = spark.createDataFrame([(-7, n, role, r"\### Assistant: </turn> ok") for n, role in enumerate(("user", "assistant"))], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.format_conversations(rows)


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness."""
    return fingerprint.edit_report(table(spark, sf_dir, "documents"))


# --- parts of the above that SQL can express ----------------------------------------------------


def bpe_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2's ids decode to."""
    return op2_bpe(spark, sf_dir).select("doc_id", "decoded_sha256")


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many spans of each kind op7's plain patterns find."""
    return op7_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edited texts that op10 compares."""
    return op10_fingerprint(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def packed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that op8's sequences decode to, pieces put together again."""
    bins = op8_packing(spark, sf_dir)
    at = F.transform(F.sequence(F.lit(1), F.size("lengths")), lambda k: F.aggregate(F.slice("lengths", F.lit(1), k - 1), F.lit(0).cast("long"), lambda acc, n: acc + n))
    each = bins.select("tokens", F.explode(F.arrays_zip("doc_ids", "pieces", "lengths", at.alias("at"))).alias("p"))
    part = F.expr("substring(tokens, cast(4 * p.at as int) + 1, cast(4 * p.lengths as int))")
    whole = each.select(F.col("p.doc_ids").alias("doc_id"), F.struct("p.pieces", part.alias("part")).alias("x")).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["part"]).alias("parts"))
    codec = spark.sparkContext.broadcast(public_codec(spark, bpe.LibraryCodec))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec.value
        for b in small_batches(batches, "parts"):
            texts = [c.decode(np.frombuffer(b"".join(parts), dtype="<u4")[:-1].tolist()) for parts in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([hashlib.sha256(t).hexdigest() for t in texts])], names=["doc_id", "text_sha256"])

    return whole.mapInArrow(decoded, "doc_id bigint, text_sha256 string")


_LUHN = "list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(d[-i] AS INTEGER) ELSE CAST(d[-i] AS INTEGER) * 2 - CASE WHEN CAST(d[-i] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
_FOUND = "list_transform(regexp_extract_all(coalesce(text, ''), '{pattern}'), lambda x: regexp_replace(x, '[^0-9]', '', 'g'))"
SQL = {
    "bpe_decoded": "SELECT doc_id, sha256(coalesce(text, '')) AS decoded_sha256 FROM documents",
    "packed_texts": "SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents",
    "pii_counts": f"""SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+')) AS n_email,
len(list_filter(regexp_extract_all(coalesce(text, ''), '[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)'), lambda x: len(list_filter(string_split(x, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(p AS INTEGER), 256) > 255)) = 0)) AS n_ip,
len(list_filter({_FOUND.format(pattern="[0-9]([ -]?[0-9])+")}, lambda d: length(d) BETWEEN 16 AND 19 AND {_LUHN})) AS n_card,
len(list_filter({_FOUND.format(pattern=chr(92) + "+[0-9][ ().0-9-]+[0-9]")}, lambda d: length(d) BETWEEN 8 AND 15)) AS n_phone FROM documents""",
    "edited_texts": """WITH n AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) // 4 AS cut, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id), first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS f FROM documents)
SELECT doc_id, length(t) AS n_chars, sha256(substr(t, 1, length(t) - cut) || substr(f, 1, cut)) AS edited_sha256 FROM n""",
}


def queries() -> dict[str, Query]:
    own = (op1_toxicity, op2_bpe, op3_quality, op4_license_scan, op5_jaccard_join, op6_exact_dedup, op7_pii, op8_packing, op9_chat_format, op10_fingerprint)
    return {f.__name__: f for f in (*own, bpe_decoded, packed_texts, pii_counts, edited_texts)}


def oracle_sql() -> dict[str, str]:
    return {"op4_license_scan": licenses.ORACLE_SQL, "op5_jaccard_join": jaccard.ORACLE_SQL, "op6_exact_dedup": exact_dedup.ORACLE_SQL, "op9_chat_format": chat.ORACLE_SQL, **SQL}
