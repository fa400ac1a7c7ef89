"""A corpus pipeline of five stages, each one operator of ``clickforge.llm`` over all that the stage before it kept."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickforge.llm import bpe, decontaminate, lines, minhash, quality  # noqa: E402
from clickforge.llm.common import parted, row_id, stored  # noqa: E402
from clickforge.llm.queries import tokenizer  # noqa: E402

#: No SQL says the sketches and the byte-pair merges; the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, rid): every row as one struct, so that no name a stage uses can clash with a column of the documents."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_id().alias("rid"))


def _texts(packed: DataFrame) -> DataFrame:
    return packed.select("rid", F.col("doc.doc_id").alias("doc_id"), F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the adaptive thresholds of their language and source."""
    packed = _packed(docs)
    verdicts = quality.quality_verdicts(packed.select(F.col("rid").alias("doc_id"), "doc.text", "doc.lang", "doc.source"))
    rejected, _ = stored(verdicts.where("not kept").select(F.col("doc_id").alias("rid")).distinct(), "rejected")
    return parted(packed, rejected)[1].select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of three lines or 13 words; those with no word left go."""
    packed = _packed(docs)
    runs, _ = stored(lines.repeated_runs(_texts(packed), min_lines=3, min_words=13), "runs")
    touched, plain = parted(packed, runs.select("rid").distinct())
    cut = touched.join(runs.select("rid", "runs"), "rid").withColumn("text", F.col("doc.text")).withColumn("text", lines.without_runs())
    cut = cut.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    made = {"text": F.col("text"), "n_chars": F.char_length("text")}
    columns = [made.get(f.name, F.col(f"doc.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema.fields]
    return plain.select("doc.*").unionByName(cut.select(*columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest doc_id (null last); repeated rows are one.

    Texts are near at a similarity of 0.8: 24 bands of 4 miss a pair there with a probability of about 3e-6. Rows without a word
    have no duplicates but equal rows.
    """
    packed = _packed(docs)
    found, _ = stored(minhash.near_duplicates(docs, percent=80, shingle=5, bands=24).select("doc_id", "rid", "part"), "found")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid")).alias("first")
    winners = found.where("part is not null").groupBy("part").agg(first).select("first.rid")
    kept, _ = stored(winners.unionByName(found.where("part is null").select("rid").distinct()), "kept")
    rows = parted(packed, kept)[0]
    again, _ = stored(found.groupBy("rid").count().where("count > 1").select("rid"), "again")
    repeated, single = parted(rows, again)
    return single.select("doc.*").unionByName(repeated.dropDuplicates(["rid"]).select("doc.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    packed = _packed(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit, _ = stored(decontaminate.hits(_texts(packed).select("rid", "text"), benchmark, window=10).select("rid").distinct(), "hit")
    return parted(packed, hit)[1].select("doc.*")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the token ids of the whole text, their number and the digest of the decoded bytes."""
    path, pattern = tokenizer()
    ranks = bpe.load_ranks(spark, path)
    both = bpe.encode(docs, ranks, pattern, decoded=True)
    made = both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))
    return stored(made, "tokens")[0]


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules), ("lines", line_dedup), ("near", near_dedup), ("benchmark", decontamination), ("bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
