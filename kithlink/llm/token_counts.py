"""Token counts: lengths only, from Arrow batches balanced by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithlink.llm.common import byte_batches, utf8_lengths
from kithlink.llm.subwords import LONG_TEXT, encoder, safe_pieces

#: Bytes of text that are split and encoded at once.
BATCH_BYTES = 6 << 20


def count_texts(texts: pa.Array, vocabulary: str, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Token counts of an Arrow array of strings; null counts as empty.

    Texts are taken in ranges of about batch_bytes; a longer one is cut at spaces, where no token can span,
    and its pieces' counts are added up.
    """
    texts = pc.fill_null(texts, "")
    sizes, counts, enc = utf8_lengths(texts), np.zeros(len(texts), np.int64), encoder(vocabulary)
    for a, b in byte_batches(sizes, batch_bytes):
        if b == a + 1 and sizes[a] > LONG_TEXT and not vocabulary.endswith(".model"):
            pieces = safe_pieces(texts[a].as_py())
            counts[a] = sum(int(enc.lengths(pa.array([p]))[0]) for p in pieces)
        else:
            counts[a:b] = enc.lengths(texts.slice(a, b - a))
    return counts


def token_counts(docs: DataFrame, vocabulary: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows and ids each give a row. A null id stays null.
    Other columns of docs are not read, so their names can't clash. An empty table gives an empty result.
    No shuffle: rows are counted where they are read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(utf8_lengths(texts), pa.int64()), pa.array(count_texts(texts, vocabulary))], ["id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
