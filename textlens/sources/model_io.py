"""Semantic model files: the Word2Vec model (Spark ML format, or a table of
word vectors), the document vectors and the vector size, all in one folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml.feature import Word2VecModel
from pyspark.sql import DataFrame, SparkSession

from textlens.operators.semantic import WordTable


@dataclass
class SemanticModel:
    model: Word2VecModel | WordTable
    doc_vectors: DataFrame  # (doc_id, vector ARRAY<DOUBLE>)

    @property
    def vector_size(self) -> int:
        return self.model.getVectorSize()


def save_semantic_model(sem: SemanticModel, path: str) -> None:
    as_table = isinstance(sem.model, WordTable)
    if as_table:
        sem.model.vectors.write.mode("overwrite").parquet(f"{path}/word_table")
    else:
        sem.model.write().overwrite().save(f"{path}/word2vec")
    kind = sem.doc_vectors.sparkSession.createDataFrame([(as_table, sem.vector_size)], "as_table boolean, size int")
    kind.write.mode("overwrite").json(f"{path}/kind")
    sem.doc_vectors.select("doc_id", "vector").write.mode("overwrite").parquet(f"{path}/doc_vectors")


def load_semantic_model(spark: SparkSession, path: str) -> SemanticModel:
    try:
        kind = spark.read.schema("as_table boolean, size int").json(f"{path}/kind").first()
    except AnalysisException:  # a folder saved before there were tables
        kind = None
    if kind is not None and kind["as_table"]:
        model = WordTable(spark.read.parquet(f"{path}/word_table"), kind["size"])
    else:
        model = Word2VecModel.load(f"{path}/word2vec")
    return SemanticModel(model=model, doc_vectors=spark.read.parquet(f"{path}/doc_vectors"))
