"""The training-data pipeline: toxicity, near duplicates, decontamination, PII, packing.

Each stage works on all rows that the one before it kept and returns the columns of documents; the last returns pieces.
Rows with null or empty texts pass all filters (they are neither toxic nor copies nor contaminated) and are packed as
their end id; an empty table goes through as one.  Texts may be of any length.  Other columns than doc_id and text stay as
they are, whatever their names, but for n_chars, which follows a text that the PII stage changes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import common, decontaminate, jaccard, packing, pii, toxicity

MOST_BROADCAST = 1_000_000


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose score is 0.7 or more, each by itself: rows that repeat go or stay together, null ids too."""
    model = toxicity.fit(docs, toxicity.train_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the least doc_id of each group of near duplicates.

    Rows of one id are kept or dropped together, also where their texts differ; rows with a null id stay.  Documents that a filter of the dropped ids clears
    stay where they are.  Of the others the ids are looked up; what the filter held wrongly, a document in a hundred, is
    brought back by a join with their ids, which are broadcast up to MOST_BROADCAST of them."""
    found = common.written(jaccard.near_duplicates(docs).filter("doc_id != component_id").select("doc_id").distinct(), "copies")
    wanted = spark.sparkContext.broadcast(jaccard.bloom(found))

    def part(hit: bool, place: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(place)
                held = wanted.value.has(ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(held == hit))

        return run

    place = docs.columns.index("doc_id")
    ids = docs.select(F.col("doc_id").cast("long"))
    back = ids.mapInArrow(part(True, 0), ids.schema).distinct().join(found, "doc_id", "left_anti").checkpoint()
    back = F.broadcast(back) if back.count() <= MOST_BROADCAST else back
    rest = docs.mapInArrow(part(True, place), docs.schema).join(back, "doc_id", "left_semi").select(*docs.columns)
    return docs.mapInArrow(part(False, place), docs.schema).union(rest)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item, each by itself; without items none goes."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates, equal entities by equal ones in all rows; n_chars follows the text."""
    out = pii.pseudonymised(docs, pii.TABLES_KEY)
    out = out.drop(out.columns[-1])
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 ids, with the ids, by ascending doc_id, null ones first, rows of one id by text."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("pii", private),
    ("packing", packed),
]

#: Fitted models, fuzzy matching, permutations and dynamic programming are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written before the next reads it; then the table before it goes."""
    docs, before = common.documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            common.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
