"""Exact top-k search by distributed histogram selection.

Every score of a block of queries is computed where the candidates are; each task counts scores in equal bins
of an interval that holds the query's k-th value, and only counts are shuffled. The bin with the k-th value
becomes the next interval, until it is one score wide or holds few scores. One more pass keeps what reaches the
k-th value. Ties at it go to smaller ids: each task hands on its k best, so a third of all rows may tie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithlink.llm.common import scratch_path

#: Queries whose vectors are sent to every task at once: BLOCK x dimension x 8 bytes.
BLOCK = 2048
BINS = 1024
#: Candidates that are scored at once in a task.
ROWS = 512


class _Scorer:
    """A block of queries, by dimension; scores are exact integers."""

    def __init__(self, ids: list[int], vectors: list[list[float]], scale: int) -> None:
        self.ids, self.scale, self.by_dim = np.array(ids, np.int64), scale, {}
        for d in {len(v) for v in vectors}:
            at = np.array([i for i, v in enumerate(vectors) if len(v) == d])
            self.by_dim[d] = at, _whole(np.array([vectors[i] for i in at], np.float64).reshape(len(at), d), scale)

    def __call__(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Positions of queries, ids of candidates, scores[candidate, query]."""
        ids, lists = batch.column(0).to_numpy(), batch.column(1)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy().astype(np.float64)
        starts = np.concatenate(([0], np.cumsum(sizes)))
        for d, (at, block) in self.by_dim.items():
            rows = np.flatnonzero(sizes == d)
            for part in (rows[i:i + ROWS] for i in range(0, len(rows), ROWS)):
                vectors = _whole(flat[starts[part][:, None] + np.arange(d)].reshape(len(part), d), self.scale)
                yield at, ids[part], _products(vectors, block)


def _whole(x: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * x)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.shape[1] == 0:
        return np.zeros((len(a), len(b)), np.int64)
    most = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("a score does not fit into a long")


def exact_top_k(vectors: DataFrame, is_query, k: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, bins: int = BINS) -> DataFrame:
    """The k candidates with the largest integer inner product for each query row.

    Components become floor(scale * x). Queries are the rows for which the column condition `is_query` holds; candidates
    are all rows with another id. Result: query_id, rank (from 1), the id column, score; ties go to smaller ids; fewer
    than k rows where there are fewer candidates. Null vectors, vectors with null or non-finite components and null ids
    take no part; vectors meet only vectors of their own dimension. Rows that repeat an id each count as candidates;
    equal query rows are one query. A score beyond a long raises OverflowError. Other columns are not read. No query, or an empty table: no rows.
    Queries go in blocks of about `block`; a block's vectors and intervals (bounded by that number) are all the driver holds.
    """
    spark = vectors.sparkSession
    usable = F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asked")).filter(F.col("id").isNotNull() & usable)
    asked = rows.filter("asked").select("id", "vector").distinct()
    out = scratch_path(spark, "top-k")
    schema = f"query_id long, rank int, {id_col} long, score long"
    blocks = -(-asked.count() // block)
    for b in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b) if blocks > 1 else asked
        found = mine.orderBy("id").collect()
        for at in range(0, len(found), block):  # a hash block may hold somewhat more than `block`
            part = found[at:at + block]
            _block(rows.select("id", "vector"), [r["id"] for r in part], [r["vector"] for r in part], k, scale, bins).withColumnRenamed("id", id_col).write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out) if blocks else spark.createDataFrame([], schema)


def _block(rows: DataFrame, ids: list[int], vectors: list[list[float]], k: int, scale: int, bins: int) -> DataFrame:
    spark, n = rows.sparkSession, len(ids)
    scorer = spark.sparkContext.broadcast(_Scorer(ids, vectors, scale))
    norm = F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x.cast("double") * scale).cast("double"), 2.0)))
    longest = float(rows.agg(norm.alias("n")).first()["n"] or 0) ** 0.5
    own = np.array([float((_whole(np.array(v, np.float64), scale) ** 2).sum()) ** 0.5 for v in vectors])
    reach = np.minimum(own * longest * 1.0001 + 2, 2**61).astype(np.int64)
    low, width, above = -reach, (2 * reach) // bins + 1, np.zeros(n, np.int64)
    top = low + width * bins  # the interval ends before it; refined bins may reach past it, where scores are in `above` already
    open_ = np.ones(n, bool)
    while open_.any():
        at, base, step, end = np.flatnonzero(open_), low.copy(), width.copy(), top.copy()

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            score, place = scorer.value, np.full(n, -1)
            place[at] = np.arange(len(at))
            held = np.zeros(len(at) * bins, np.int64)
            for batch in batches:
                for queries, names, scores in score(batch):
                    of = place[queries]
                    cell = (scores - base[queries]) // step[queries]
                    good = (of >= 0) & (cell >= 0) & (scores < end[queries]) & (names[:, None] != score.ids[queries])
                    held += np.bincount((of * bins + cell)[good], minlength=len(held))
            some = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([pa.array(at[some // bins], pa.int32()), pa.array(some % bins, pa.int32()), pa.array(held[some])], ["q", "bin", "n"])

        counts = rows.mapInArrow(count, "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        reached = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")))
        ends = counts.select("q", "bin", "n", reached.alias("reached"))
        lacking = spark.createDataFrame([(int(q), int(above[q])) for q in at], "q int, above long")
        kth = ends.join(F.broadcast(lacking), "q").filter((F.col("above") + F.col("reached") >= k) & (F.col("above") + F.col("reached") - F.col("n") < k)).select("q", "bin", "n", "reached").collect()
        open_[:] = False
        seen = set()
        for r in kth:
            q = r["q"]
            seen.add(q)
            low[q] += width[q] * r["bin"]
            top[q] = min(top[q], low[q] + width[q])
            above[q] += r["reached"] - r["n"]
            if width[q] > 1 and above[q] + r["n"] > 4 * k:
                open_[q] = True
                width[q] = -(-width[q] // bins)
        for q in at:
            if int(q) not in seen:  # fewer than k candidates: all of them
                low[q] = -(2**62)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer.value
        best = [np.empty((0, 3), np.int64)]

        def pruned() -> np.ndarray:
            all_ = np.concatenate(best)
            all_ = all_[np.lexsort((all_[:, 1], -all_[:, 2], all_[:, 0]))]
            starts = np.searchsorted(all_[:, 0], all_[:, 0])
            return all_[np.arange(len(all_)) - starts < k]

        held = 0
        for batch in batches:
            for queries, names, scores in score(batch):
                c, q = np.nonzero((scores >= low[queries]) & (names[:, None] != score.ids[queries]))
                best.append(np.column_stack((queries[q], names[c], scores[c, q])))
                held += len(c)
                if held > max(4 * n * k, 100_000):
                    best[:] = [pruned()]
                    held = len(best[0])
        rows_ = pruned()
        yield pa.RecordBatch.from_arrays([pa.array(score.ids[rows_[:, 0]]), pa.array(rows_[:, 1]), pa.array(rows_[:, 2])], ["query_id", "id", "score"])

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = rows.mapInArrow(keep, "query_id long, id long, score long").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
