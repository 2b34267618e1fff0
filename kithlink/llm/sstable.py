"""Token-id shards as sorted string tables.

A shard holds documents in ascending key order:

    magic | block ... block | block index | Bloom filter | footer

A block is a run of entries (varint shared key bytes, varint further key bytes, varint value bytes, key rest,
value) whose keys are stored against the key before; its first entry shares nothing. The sparse index has one
entry a block: first key, offset, bytes, entries, ids before it in the shard. The footer has the place of
index and filter, the counts, the width of an id, and the magic again. A lookup asks the filter, searches the
index by halves and reads one block (more only while a key's copies go on).

Files are written under names that no other attempt uses and listed in a manifest only by tasks that ended, so
lost or repeated tasks leave nothing that is read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kithlink.llm.common import byte_batches, utf8_lengths
from kithlink.llm.subwords import encoder
from kithlink.llm.token_counts import BATCH_BYTES

MAGIC = b"KLSST001"
FOOTER = struct.Struct("<QQQQQQBBH8s")  # index at, filter at, filter bytes, docs, ids, blocks, id width, hashes, 0, magic
INDEX = struct.Struct("<HQIIQ")  # key bytes, offset, bytes, entries, ids before
BLOCK_BYTES = 64 << 10
BITS_PER_KEY = 10
N_HASHES = 7


def key_bytes(key: int | None) -> bytes:
    """Bytes that sort as the keys do; null comes first."""
    return b"\0" if key is None else b"\1" + (key + (1 << 63)).to_bytes(8, "big")


def key_value(data: bytes) -> int | None:
    return None if data[:1] == b"\0" else int.from_bytes(data[1:], "big") - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    a, b = struct.unpack("<QQ", hashlib.blake2b(key, digest_size=16).digest())
    return [(a + i * (b | 1)) % (1 << 64) % bits for i in range(N_HASHES)]


class ShardWriter:
    """Writes one shard to a binary stream; keys must come in ascending order, equal keys may repeat."""

    def __init__(self, sink, id_width: int, block_bytes: int = BLOCK_BYTES) -> None:
        self.sink, self.width, self.most = sink, id_width, block_bytes
        self.dtype = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[id_width]
        self.block, self.entries, self.first, self.last = bytearray(), 0, b"", None
        self.index, self.hashed, self.docs, self.ids, self.before = [], [], 0, 0, 0
        sink.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, key: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> 8 * self.width:
            raise OverflowError(f"id {int(ids.max())} does not fit into {self.width} bytes")
        data, value = key_bytes(key), np.ascontiguousarray(ids, self.dtype).tobytes()
        if self.last is not None and data < self.last:
            raise ValueError("keys must ascend")
        if len(self.block) >= self.most:
            self._close()
        shared = 0
        if self.entries:
            last = self.last
            while shared < min(len(data), len(last)) and data[shared] == last[shared]:
                shared += 1
        else:
            self.first = data
        rest = data[shared:]
        self.block += bytes((shared, len(rest))) + _varint(len(value)) + rest + value
        if data != self.last:
            self.hashed.append(data)
        self.last, self.entries = data, self.entries + 1
        self.docs, self.ids = self.docs + 1, self.ids + len(ids)

    def _close(self) -> None:
        if self.entries:
            self.index.append((self.first, self.at, len(self.block), self.entries, self.before))
            self.sink.write(bytes(self.block))
            self.at += len(self.block)
            self.block, self.entries, self.before = bytearray(), 0, self.ids

    def finish(self) -> int:
        """Write index, filter and footer; return the shard's bytes."""
        self._close()
        index = b"".join(INDEX.pack(len(k), *rest) + k for k, *rest in self.index)
        bits = max(64, BITS_PER_KEY * len(self.hashed))
        bloom = bytearray((bits + 7) // 8)
        for key in self.hashed:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        self.sink.write(index)
        self.sink.write(struct.pack("<Q", bits) + bytes(bloom))
        size = 8 + len(bloom)
        self.sink.write(FOOTER.pack(self.at, self.at + len(index), size, self.docs, self.ids, len(self.index), self.width, N_HASHES, 0, MAGIC))
        return self.at + len(index) + size + FOOTER.size


class ShardReader:
    """Reads one shard from a seekable binary file."""

    def __init__(self, source) -> None:
        self.source = source
        source.seek(0, 2)
        size = source.tell()
        source.seek(size - FOOTER.size)
        self.index_at, filter_at, filter_size, self.docs, self.ids, blocks, width, _, _, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        self.dtype = {2: np.dtype("<u2"), 4: np.dtype("<u4")}[width]
        source.seek(self.index_at)
        data, at, self.index = source.read(filter_at - self.index_at), 0, []
        for _ in range(blocks):
            n, *rest = INDEX.unpack_from(data, at)
            at += INDEX.size
            self.index.append((data[at:at + n], *rest))
            at += n
        self.bloom = source.read(filter_size)
        self.bits = struct.unpack_from("<Q", self.bloom)[0]

    def _block(self, n: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, offset, size, entries, _ = self.index[n]
        self.source.seek(offset)
        data, at, key = self.source.read(size), 0, b""
        for _ in range(entries):
            shared, rest = data[at], data[at + 1]
            length, at = _read_varint(data, at + 2)
            key = key[:shared] + data[at:at + rest]
            at += rest
            yield key, np.frombuffer(data, self.dtype, length // self.dtype.itemsize, at)
            at += length

    def __iter__(self) -> Iterator[tuple[int | None, np.ndarray]]:
        for n in range(len(self.index)):
            for key, ids in self._block(n):
                yield key_value(key), ids

    def may_hold(self, key: int | None) -> bool:
        return all(self.bloom[8 + (p >> 3)] >> (p & 7) & 1 for p in _probes(key_bytes(key), self.bits))

    def get(self, key: int | None) -> list[np.ndarray]:
        """The id arrays of every document with this key."""
        if not self.index or not self.may_hold(key):
            return []
        sought, found = key_bytes(key), []
        n = max(0, bisect_left(self.index, sought, key=lambda e: e[0]) - 1)
        while n < len(self.index) and self.index[n][0] <= sought:
            found += [ids for k, ids in self._block(n) if k == sought]
            n += 1
        return found


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or not uri.startswith("file:") else "file://" + uri[5:])


MANIFEST = "shard int, path string, first_key long, last_key long, n_docs long, n_ids long, n_bytes long"


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append end_id, and write shards of ascending id below `folder`; return the manifest.

    Null texts count as empty (their ids are just end_id). Null ids sort first. Rows of equal id all stay, in an order
    fixed by their texts; they may span shards, so one id can hold any share of the rows. Only id and text are read.
    One range shuffle of the texts; the writer holds one block, and of a very long text all its ids. An empty table writes an empty manifest.
    Ids have id_width bytes, 2 or 4; one that doesn't fit raises OverflowError.
    """
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = store = None
        shard = TaskContext.get().partitionId()
        first = last = None
        enc, end = encoder(vocabulary), np.uint32(end_id)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), pc.fill_null(batch.column(1), "")
            for a, b in byte_batches(utf8_lengths(texts), BATCH_BYTES):
                ids, bounds = enc.encode(texts.slice(a, b - a))
                for i in range(a, b):
                    if writer is None:
                        store, base = _filesystem(folder)
                        store.create_dir(base, recursive=True)
                        path = f"{base}/{shard:06d}-{uuid.uuid4().hex}.sst"
                        sink = store.open_output_stream(path + ".part")
                        writer, first = ShardWriter(sink, id_width), keys[i]
                    last = keys[i]
                    writer.add(last, np.append(ids[bounds[i - a]:bounds[i - a + 1]], end))
        if writer is not None:
            size = writer.finish()
            sink.close()
            store.move(path + ".part", path)
            row = {"shard": shard, "path": f"{folder}/{path.rsplit('/', 1)[1]}", "first_key": first, "last_key": last, "n_docs": writer.docs, "n_ids": writer.ids, "n_bytes": size}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("shard", pa.int32()), ("path", pa.string()), *((n, pa.int64()) for n in ("first_key", "last_key", "n_docs", "n_ids", "n_bytes"))]))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")
    placed = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie, "text")
    placed.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Every document from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of little-endian uint32 ids).

    The running count over shards needs the manifest only: a row a shard.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, place = _filesystem(path)
                with store.open_input_file(place) as file:
                    rows = []
                    for key, ids in ShardReader(file):
                        rows.append((key, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield _columns(rows)
                            rows = []
                    if rows:
                        yield _columns(rows)

    return based.repartition(max(1, manifest.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _columns(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def lookup(manifest: DataFrame, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The ids of the given documents: doc_id, ids array<int>; a key without a document gives no row.

    Every task has the first and last key of each shard, a row of the manifest, and finds a key's shards among them by bisection;
    each shard's keys then go to one task. Null keys are not looked up.
    """
    spark = manifest.sparkSession
    wanted = keys.select(F.col(id_col).cast("long").alias("doc_id")).dropna().distinct()
    # null keys come first in a shard, so any key up to its last one may follow them
    shards = manifest.filter("last_key is not null").select(F.coalesce("first_key", F.lit(-(1 << 63))).alias("first"), F.col("last_key").alias("last"), "path").orderBy("shard").toArrow()
    bounds = spark.sparkContext.broadcast((shards.column("first").to_numpy(), shards.column("last").to_numpy(), shards.column("path").to_pylist()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last, paths = bounds.value
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            begin, end = np.searchsorted(last, own, "left"), np.searchsorted(first, own, "right")
            times = np.maximum(end - begin, 0)
            at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(begin, times)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(own, times)), pa.array([paths[k] for k in at.tolist()], pa.string())], ["doc_id", "path"])

    here = wanted.mapInArrow(find, "doc_id long, path string").repartition("path").sortWithinPartitions("path", "doc_id")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, ShardReader] = {}
        for batch in batches:
            found = []
            for key, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path not in opened:
                    if len(opened) > 16:
                        opened.clear()
                    store, place = _filesystem(path)
                    opened[path] = ShardReader(store.open_input_file(place))
                found += [(key, ids.tolist()) for ids in opened[path].get(key)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return here.select("doc_id", "path").mapInArrow(read, "doc_id long, ids array<int>")
