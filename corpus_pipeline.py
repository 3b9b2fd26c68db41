"""The corpus pipeline: five stages over the documents table, each written and read again.

language ID -> near-dedup -> substring dedup -> decontamination -> mixing. Each stage takes
(spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm import decontaminate, language, mixing, near_dedup, substring_dedup
from pulseframe.session import scratch_path

# A text whose best language is less likely than this is rejected, like one without letters.
LEAST_SURE = 0.5

# No SQL: the first, second and last stage are not expressible in it.
ORACLE_SQL = None


# Put before the documents' own column names, so that they meet no column that an operator adds.
OWN = "doc__"
TEXT, DOC_ID = f"{OWN}text", f"{OWN}doc_id"


def _own(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.col(f"`{c}`").alias(OWN + c) for c in docs.columns])


def _back(found: DataFrame, docs: DataFrame, **changed) -> DataFrame:
    """The columns of ``docs``, with the types they had there."""
    columns = {c: changed.get(c, F.col(f"`{OWN}{c}`")) for c in docs.columns}
    return found.select(*[v.cast(docs.schema[c].dataType).alias(c) for c, v in columns.items()])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; the rest, such as empty texts, goes."""
    model = language.train(docs)
    judged = language.predict(_own(docs), model, text=TEXT)
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SURE)
    return _back(judged.filter(sure), docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return _back(near_dedup.dedup(_own(docs), TEXT, DOC_ID), docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; one that is nothing else goes.

    ``n_chars`` is counted again where the text has changed.
    """
    cut = substring_dedup.substring_dedup(_own(docs), TEXT, DOC_ID)
    cut = cut.filter((F.col("n_removed") == 0) | (F.col(TEXT) != ""))
    changed = {}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length(TEXT)).otherwise(F.col(f"{OWN}n_chars"))
    return _back(cut, docs, **changed)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(_own(docs), benchmark, text=TEXT)
    return _back(found.filter(~F.col("contaminated")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents to draw, with ``n_words``, domain posteriors, ``rate`` and ``copies``.

    The wanted total grows until no wanted domain shrinks, so the weights are reached by repeating
    documents, and only those of unwanted domains go. ``copies`` is the rate, rounded up or down by
    a hash of the id with the odds of its fraction, and at least 1 from a rate of 0.5 on. Columns of
    ``docs`` named like the new ones are replaced.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("doc_id", DOC_ID)
    mixed = mixing.mix(_own(docs), labels, TEXT, DOC_ID, whole=True)
    fraction = F.pmod(F.xxhash64(F.lit("copies"), DOC_ID), F.lit(1_000_000)) / 1_000_000
    copies = F.floor(F.col("rate") + fraction)
    copies = F.when(F.col("rate") >= 0.5, F.greatest(F.lit(1), copies)).otherwise(copies)
    mixed = mixed.withColumn("copies", copies.cast("int")).filter("copies > 0")
    new = ["n_words", *[f"p_{d}" for d in mixing.DOMAINS], "rate", "copies"]
    return mixed.select(*[F.col(f"`{OWN}{c}`").alias(c) for c in docs.columns if c not in new], *new)


STAGES = [
    ("language", identify_language),
    ("near_dedup", remove_near_duplicates),
    ("substring_dedup", remove_repeated_passages),
    ("decontaminate", remove_contaminated),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
