"""Documents to a training mix: quality, near copies, benchmark leaks, secrets, source weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog import table
from ledgerloom.llm import decontamination, mixing, quality, secrets, simhash
from ledgerloom.llm.rows import ROW, boxed, field, unboxed
from ledgerloom.session import stage

ID, TEXT = field("doc_id"), field("text")

#: No SQL: the quality stage samples by trained models and Python's hashes; tests hold the stages against brute force.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the good labelled ones keeps."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    found = quality.resample(boxed(docs), labels, text=TEXT, doc_id=ID)
    return unboxed(found.filter("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash, with the operator's own shingles and distance, the one with the smallest id."""
    return unboxed(simhash.one_of_each(boxed(docs), ID, TEXT), docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark, whole or edited."""
    return unboxed(decontamination.cleaned(boxed(docs), table(spark, sf_dir, "benchmark"), ID, TEXT), docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts, and ``n_chars`` (if there is such a column) of the new text."""
    found = secrets.scan(boxed(docs), TEXT)
    new = F.when(F.size("secrets") > 0, secrets.masked(TEXT)).otherwise(F.col(TEXT))
    changed = found.withColumn("masked", new)
    fields = [("text", F.col("masked"))]
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        fields.append(("n_chars", F.when(F.size("secrets") > 0, F.length("masked").cast(kind)).otherwise(F.col(field("n_chars")))))
    row = F.col(ROW)
    for name, value in fields:
        row = row.withField(name, value)
    return unboxed(changed.select(row.alias(ROW)), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document once per copy that it is given, with its size, its source's size and target, and the copy."""
    mixed = mixing.mixture(boxed(docs), doc_id=ID, text=TEXT, source=field("source"))
    extra = [c for c in mixed.columns if c != ROW]
    return mixed.select(*[F.col(field(c)).alias(c) for c in docs.columns], *[c for c in extra if c not in docs.columns])


STAGES = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
