"""Candidates for records that arrive as a stream, against a stored index of blocking keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kithlink.operators.blocking import MAX_CANDIDATES, REFERENCE, candidate_counts, keyed, top_candidates
from kithlink.sources.tsv import RECORD_COLUMNS


def stream_candidates(arriving: DataFrame, index: DataFrame, out: str, checkpoint: str, profile: str = "evaluate", k: int = MAX_CANDIDATES):
    """Start a query that blocks every micro-batch of reference records (id, name, address) against the index (see blocking.save_index).

    Each batch is written once below `out`, in a folder of its number, so a batch that runs again replaces itself.
    """
    from pyspark.sql import functions as F

    def one(batch: DataFrame, number: int) -> None:
        mine = batch.select(*RECORD_COLUMNS, F.lit(REFERENCE).alias("source"), F.lit(0).cast("long").alias("row"))
        others = index.filter(F.col("source") != REFERENCE)
        keys = keyed(mine, profile).unionByName(others.select("source", "id", "row", "place", "key"))
        top_candidates(candidate_counts(keys), k).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arriving.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).start()
