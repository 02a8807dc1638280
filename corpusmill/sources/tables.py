"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.dedup import nearest, nearest_bucketed
from corpusmill.sources.files import file_system

SMALL = 256 << 20


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table.  Rows of a small one in fewer files than there are cores are dealt out, as a file may be one row
    group, which is one task's; larger ones stay as they lie."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))  # texts can be long
    df, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    fs, at = file_system(spark, path)
    return df.repartition(cores) if fs.getContentSummary(at).getLength() <= SMALL else df


class VectorStore:
    """A collection of vectors (doc_id, doc_pos, vector) in a folder, compared by cosine."""

    SCHEMA = "doc_id string, doc_pos long, vector array<double>"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def create(self) -> VectorStore:
        """An empty collection; what was there goes."""
        self.spark.createDataFrame([], self.SCHEMA).write.mode("overwrite").parquet(self.path)
        return self

    def add(self, vectors: DataFrame) -> VectorStore:
        """Append vectors; raises if they are empty or differ in length from each other or from those there are."""
        rows = vectors.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("doc_pos").cast("long").alias("doc_pos"), F.col("vector").cast("array<double>").alias("vector"))
        sizes = {r.n for r in rows.select(F.size("vector").alias("n")).union(self.vectors().select(F.size("vector").alias("n"))).distinct().limit(3).collect()}
        if len(sizes) > 1 or sizes & {-1, 0}:
            raise ValueError("a collection's vectors have one length")
        rows.write.mode("append").parquet(self.path)
        return self

    def vectors(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def nearest(self, top_k: int = 10, bucketed: bool = False) -> DataFrame:
        """src, dst, similarity, rank of all vectors; exact, or by buckets where there are many."""
        return (nearest_bucketed if bucketed else nearest)(self.vectors(), top_k)
