"""From raw documents to a tokenised training mix, in stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; between stages the documents are a Parquet table in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from ticklake.llm import bpe, minhash, mixing, pii, toxicity
from ticklake.llm.common import Work, broadcast_if_small, ship_package, staged, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Documents with this toxicity score or more go.
TOXIC = 0.7
#: Rows to drop, told by two numbers, that may be broadcast.
KEYS = 1_000_000
#: Of the registered pipeline; a deployment passes its own secret.
PSEUDONYM_KEY = b"registered pipeline"


def renamed(docs: DataFrame, *used: str) -> tuple[DataFrame, list[Column]]:
    """`docs` with private names for the columns that an operator doesn't use,
    and the columns under their old names: no name can meet one of its own."""
    names = {c: c if c in used else f"__own_{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), [F.col(n).alias(c) for c, n in names.items()]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under TOXIC, with their columns."""
    ship_package(spark)
    own, columns = renamed(docs, "doc_id", "text")
    out = toxicity.toxicity(own, table(spark, sf_dir, "labels"), threshold=TOXIC)
    return out.where("predicted = 0").select(*columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are near copies (five-word shingles, similarity of
    0.8 or more) one row stays, that with the smallest id.

    Rows are told apart by id and text.  If the smallest id has several texts
    in the group, that with the smallest digest stays, of equal texts the row
    whose columns are smallest.  An id's texts that aren't near copies are each
    decided on in their own group.  Rows without id or words all stay.
    """
    ship_package(spark)
    found = minhash.near_duplicates(docs, shingle=5, percent=80, by_row=True).where("component is not null")
    kept = found.where("kept")
    several = kept.groupBy("component").agg(F.min("doc_id").alias("doc_id"), F.min("digest").alias("digest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    several = staged(several, "pipeline_repeated")
    keys = ["doc_id", "digest"]
    gone = found.where("not kept").select(keys)
    if not (none := several.isEmpty()):
        gone = gone.unionByName(kept.join(broadcast_if_small(several.select("component"), KEYS), "component", "left_semi").select(keys))
    gone = broadcast_if_small(staged(gone.distinct(), "pipeline_copies"), KEYS)
    own, columns = renamed(docs, "doc_id", "text")
    told = own.withColumn("digest", minhash.text_digest(F.col("text")))
    out = told.join(gone, keys, "left_anti").select(*columns)
    if none:
        return out
    again = told.join(broadcast_if_small(several.select(keys), KEYS), keys, "left_semi")
    again = again.groupBy(keys).agg(F.min(F.struct(*columns)).alias("row"))
    return out.unionByName(again.select("row.*"))


def pseudonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal data; n_chars follows the text."""
    ship_package(spark)
    own, columns = renamed(docs, "text", "n_chars")
    out = pii.without_personal_data(own, PSEUDONYM_KEY)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, 0 to 3 times."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of ids and decoded bytes."""
    ship_package(spark)
    out = bpe.bpe_digests(docs.select("doc_id", "text"), "text", public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", without_toxic),
    ("minhash_near_dedup", one_of_each_group),
    ("pii", pseudonymous),
    ("source_mixing", target_mix),
    ("byte_bpe", tokens),
]

#: SQL can't express near duplicates, pseudonyms or BPE; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, work = table(spark, sf_dir, "documents"), Work(spark)
    try:
        for name, stage in STAGES[:-1]:
            docs = work(stage(spark, docs, sf_dir), f"pipeline_{name}")
        name, stage = STAGES[-1]
        return staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    finally:
        work.end()
