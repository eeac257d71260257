"""From raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
rereads as the next stage's documents. All but the last return the columns of
the documents. Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripgauge.llm import linededup, packing, quality, secrets, simhash
from tripgauge.session import materialize, table_path


def _tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _counted(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The documents' own columns, with n_chars of the text as it is now (where there is such a column)."""
    size = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return rows.select(*(size.alias("n_chars") if c == "n_chars" else c for c in like.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the weak-supervision verdict reject; a null or empty text is rejected."""
    return quality.judge(docs).filter("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines out of the texts; every document stays, with the lines it keeps."""
    return _counted(linededup.dedup_lines(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each near-duplicate group the document with the smallest id. Of its rows (an id may occur with several texts) one a
    fingerprint stays, so that no text is lost to another of its id. Rows with a null id can't be named by a group and stay."""
    bodied = lambda rows: rows.withColumn("_body", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = simhash.near_duplicates(bodied(docs), keep=["_body"]).filter("doc_id = component_id")
    stay = found.groupBy("doc_id", "simhash").agg(F.min("_body").alias("_body")).select("doc_id", "_body")
    named = bodied(docs).join(stay, ["doc_id", "_body"], "left_semi").dropDuplicates(["doc_id", "_body"])
    return named.select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark of its kind; every document stays."""
    return _counted(secrets.find_secrets(docs, mask=True), docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its place in a sequence of at most 1024 tokens."""
    return packing.pack(packing.pieces(docs, _tokenizer_path())).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash_near_dedup", near_dedup),
          ("secret_scans", mask_secrets), ("best_fit_packing", best_fit_packing)]

#: Expectation-maximisation, XXH64 fingerprints and tokenizers are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
