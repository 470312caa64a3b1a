"""A corpus pipeline: five stages, each calling one operator, from documents to packed sequences.

Each stage takes (spark, docs, sf_dir), is written as Parquet, and is read again as the next one's
docs. All but the last return the columns of documents. SQL cannot express learned stages, so
ORACLE_SQL is None and the stages are tested against brute force.

Defined cases, for every stage: a null id is an id like others; rows that repeat an id are judged by
their own text; equal rows share a verdict (near_duplicates keeps one of them). A null, empty or blank
text has the classifier's score of no features, and fails the rules as it has no words. Very long texts
are handled whole. Columns of any name pass through unchanged, but for text and n_chars after lines.
An empty table gives an empty table of the same columns, and no pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainloom.llm import line_dedup, ngram_join, packing, quality_classifier, quality_rules
from chainloom.llm.common import ensure_checkpoint_dir, ship, table


def _row() -> Column:
    """One name for rows that are equal in id and text."""
    return F.xxhash64("doc_id", "text")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    labels = table(spark, sf_dir, "labels")
    found = quality_classifier.score(docs.select(_row().alias("doc_id"), "text"), quality_classifier.fit(docs, labels))
    # The verdict belongs to an id and a text, so that a repeated id keeps only its good rows.
    good = found.where("predicted = 1").select(F.col("doc_id").alias("row")).distinct()
    return _unpacked(_packed(docs).join(good, "row", "left_semi"), docs)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned rules keep. They are learned from all labelled documents: the classifier has left hardly any bad one."""
    learned = quality_rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return _unpacked(quality_rules.judge(_packed(docs), learned).where("kept"), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; documents of nothing but repeated lines go."""
    found = line_dedup.dedup_lines(docs.withColumnRenamed("dropped_lines", "dropped_lines "), keep_empty=False).drop("dropped_lines")
    return _counted(found.withColumnRenamed("dropped_lines ", "dropped_lines").select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id (a null one last), of rows with one id that of
    the least hash, of equal rows any. Documents without words are nobody's duplicates and all stay."""
    rows = _packed(docs)
    found = ngram_join.jaccard_components(rows.select(F.col("row").alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias("row"), "n_shingles", "component_id").distinct()
    named = rows.select("row", F.col("doc.doc_id").alias("id")).distinct()
    first = F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"]
    kept = found.where("n_shingles > 0").join(named, "row").groupBy("component_id").agg(first.alias("row")).select("row")
    alone = found.where("n_shingles = 0").select("row")
    return _unpacked(rows.join(kept, "row", "left_semi").dropDuplicates(["row"]).union(rows.join(alone, "row", "left_semi")), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with the sequence and place that each has."""
    import public_tokenizers

    return packing.best_fit(docs, public_tokenizers.path("word_bpe_49k.json"))


def _packed(docs: DataFrame) -> DataFrame:
    """A name of each row's id and text, the text, and the whole row as a struct, so that no column's name meets an operator's."""
    return docs.select(_row().alias("row"), "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [("quality_classifier", classify), ("quality_rules", rules), ("line_dedup", lines), ("ngram_join", near_duplicates), ("best_fit_packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written in the shared checkpoint folder and read again."""
    ship(spark)
    ensure_checkpoint_dir(spark)
    at = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
