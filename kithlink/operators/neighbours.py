"""Nearest neighbours of dense vectors: exact, in blocks of queries, or approximate by random projections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithlink.functions.similarity import dot
from kithlink.session import checkpointed

#: Query vectors sent to every task at once.
BLOCK = 4096


def unit(vectors: DataFrame, column: str = "vector") -> DataFrame:
    """Vectors of length one; zero vectors stay."""
    length = F.sqrt(dot(F.col(column), F.col(column)))
    return vectors.withColumn(column, F.when(length > 0, F.transform(column, lambda x: x / length)).otherwise(F.col(column)))


def nearest(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(source1_id, candidate_id, source, similarity, rank): the k candidates of the highest cosine for each query, exactly.

    queries: (id, vector); candidates: (source, id, vector); vectors of one dimension, null ones take no part. Queries go
    out in blocks of BLOCK; each task keeps its k best of each query, so k rows a query and task are shuffled. Of several blocks
    each one's result is checkpointed before the next one's queries are read, so the driver holds one block at a time.
    """
    asked = unit(queries.select("id", "vector").filter("vector is not null"))
    others = unit(candidates.select("source", "id", "vector").filter("vector is not null"))
    blocks = max(1, -(-asked.count() // BLOCK))
    out = None
    for b in range(blocks):
        part, sent = _nearest(asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b), others, k)
        if blocks > 1:
            part = checkpointed(part)
            sent.destroy()
        out = part if out is None else out.unionByName(part)
    return out


def _nearest(asked: DataFrame, others: DataFrame, k: int) -> tuple[DataFrame, Broadcast]:
    """The result of one block, and the broadcast that it reads."""
    rows = asked.collect()
    ids = [r["id"] for r in rows]
    matrix = others.sparkSession.sparkContext.broadcast(np.array([r["vector"] for r in rows], np.float64).reshape(len(rows), -1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in ids]
        for batch in batches:
            if not ids or not batch.num_rows:
                continue
            sources, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            vectors = np.array(batch.column(2).to_pylist(), np.float64)
            for at in range(0, len(names), 1024):
                scores = np.round(matrix.value @ vectors[at:at + 1024].T, 12)
                for q, row in enumerate(scores):
                    take = np.flatnonzero(row >= np.partition(row, -k)[-k]) if len(row) > k else range(len(row))
                    best[q] += [(-float(row[j]), sources[at + j], names[at + j]) for j in take]
                    if len(best[q]) > 64 * k:
                        best[q] = sorted(best[q])[:k]
        found = [(ids[q], name, source, -score) for q, kept in enumerate(best) for score, source, name in sorted(kept)[:k]]
        if found:
            yield pa.RecordBatch.from_pydict(dict(zip(["source1_id", "candidate_id", "source", "similarity"], map(list, zip(*found)))))

    order = Window.partitionBy("source1_id").orderBy(F.desc("similarity"), "source", "candidate_id")
    scored = others.mapInArrow(run, "source1_id string, candidate_id string, source string, similarity double")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), matrix


def nearest_approximate(queries: DataFrame, candidates: DataFrame, k: int, bucket_length: float = 0.5, tables: int = 8) -> DataFrame:
    """As nearest(), among the candidates that share a bucket of a random projection; recall grows with `tables`."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    top = candidates.filter("vector is not null").select(F.size("vector").alias("n")).first()
    # the optimiser may hash a row before it is filtered out, so a null vector becomes zeros of the right length
    whole = F.coalesce("vector", F.array_repeat(F.lit(0.0), top["n"] if top else 1))
    asked = unit(queries.select("id", "vector").filter("vector is not null")).select("id", array_to_vector(whole).alias("features"), F.col("vector").alias("v"))
    others = unit(candidates.select("source", "id", "vector").filter("vector is not null")).select("source", "id", array_to_vector(whole).alias("features"), F.col("vector").alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=42).fit(others)
    met = model.approxSimilarityJoin(asked, others, 2.0, "distance")
    pairs = met.select(F.col("datasetA.id").alias("source1_id"), F.col("datasetB.id").alias("candidate_id"), F.col("datasetB.source").alias("source"), dot(F.col("datasetA.v"), F.col("datasetB.v")).alias("similarity"))
    order = Window.partitionBy("source1_id").orderBy(F.desc("similarity"), "source", "candidate_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def pluggable_encoder(function):
    """An Arrow UDF from text to vector around a function of a list of texts; the model loads once a worker, on first use."""
    import pandas as pd
    from pyspark.sql.types import ArrayType, FloatType

    @F.pandas_udf(ArrayType(FloatType()))
    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(list(map(list, function(texts.fillna("").tolist()))))

    return encode
