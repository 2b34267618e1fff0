"""Candidates by shared keys, counted in arrays instead of in a shuffle of pairs.

Most pairs of records share some key, so the pairs are never rows: the candidates' keys are written once, in the order that
breaks ties, and each task counts for its reference records, block by block of candidates, how many keys meet. What crosses
the shuffle and lies on disk grows with the records; only the time grows with the pairs, by about a nanosecond for each key
that meets. Keys are compared by 64-bit hashes. The checkpoint folder must be a store that pyarrow.fs opens.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithlink.session import kept, opened, ship

REFERENCE = "source1"
#: Candidates, and keys of theirs, that a task holds at once.
BLOCK, BLOCK_KEYS = 1 << 16, 4 << 20
#: Reference records that a task holds at once, with their best candidates.
REFERENCES = 8192
#: Keys that more than one in so many candidates of a block have are added as a row of bytes.
DENSE = 24
#: -shared and the first key met are one number: shared times this.
SHIFT = 31
OUT_ROWS = 1 << 17


class Block:
    """The keys of some candidates: for each key the candidates that have it, and how often."""

    def __init__(self, rows: pa.RecordBatch, start: int):
        self.start, self.n, self.ids, self.sources = start, rows.num_rows, rows["id"], rows["source"].to_pylist()
        owner, keys, _, row = _flat(rows["rows"])
        self.rows = rows["rows"]
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])))) if len(keys) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(keys)))
        keys, self.owner, self.times = keys[new], owner[new], times
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else new
        self.keys, self.bounds = keys[first], np.append(first, len(keys))
        self.plain = np.maximum.reduceat(times, first) == 1 if len(first) else np.zeros(0, bool)
        held = np.diff(self.bounds)
        dense = np.flatnonzero((held * DENSE > self.n) & (held > 64) & self.plain)
        self.dense = np.full(len(self.keys), -1)
        self.dense[dense] = np.arange(len(dense))
        self.bytes = np.zeros((len(dense), self.n), np.uint8)
        for i, k in enumerate(dense.tolist()):
            self.bytes[i, self.owner[self.bounds[k]:self.bounds[k + 1]]] = 1
        self.scratch = np.empty(self.n, np.int64)

    def counts(self, keys: list[int], times: list[int]) -> np.ndarray:
        """How many keys meet, by candidate; keys: places in self.keys."""
        sparse, weighted, total, acc, added = [], [], None, np.zeros(self.n, np.uint8), 0
        for k, n in zip(keys, times):
            if n > 1 or not self.plain[k]:
                weighted.append((k, n))
            elif (d := self.dense[k]) >= 0:
                if added == 255:
                    total, added = acc.astype(np.int64) if total is None else total + acc, 0
                    acc = np.zeros(self.n, np.uint8)
                acc += self.bytes[d]
                added += 1
            else:
                sparse.append(self.owner[self.bounds[k]:self.bounds[k + 1]])
        found = np.bincount(np.concatenate(sparse), minlength=self.n) if sparse else np.zeros(self.n, np.int64)
        found += acc
        if total is not None:
            found += total
        for k, n in weighted:
            a, b = self.bounds[k], self.bounds[k + 1]
            found[self.owner[a:b]] += self.times[a:b] * n
        return found

    def first_met(self, chosen: np.ndarray, keys: list[int], places: list[int]) -> np.ndarray:
        """The least place of a key that meets, for each chosen candidate. places: ascending."""
        self.scratch.fill(1 << SHIFT - 1)
        dense = []
        for k, place in zip(reversed(keys), reversed(places)):
            if (d := self.dense[k]) >= 0:
                dense.append((d, place))
            else:
                self.scratch[self.owner[self.bounds[k]:self.bounds[k + 1]]] = place
        at = self.scratch[chosen]
        for d, place in dense:
            np.minimum(at, place, out=at, where=self.bytes[d][chosen].view(bool))
        return at


def _flat(lists: pa.Array) -> tuple[np.ndarray, ...]:
    """Of a list of (row, keys) a record: owner, key, place and row of every key that is not null."""
    per_record = np.diff(lists.offsets.to_numpy())
    items = lists.flatten()
    keys = items.field("keys")
    per_item = np.diff(keys.offsets.to_numpy())
    values = keys.flatten()
    there = values.is_valid().to_numpy(zero_copy_only=False)
    item = np.repeat(np.arange(len(items)), per_item)
    place = np.arange(len(values)) - np.repeat(np.cumsum(per_item) - per_item, per_item)
    owner = np.repeat(np.arange(len(lists)), per_record)[item]
    row = items.field("row").fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)[item]
    return owner[there], values.fill_null(0).to_numpy(zero_copy_only=False)[there], place[there], row[there]


def _blocks(files: list[str]) -> Iterator[Block]:
    """The candidates in their order, in blocks of a bounded number of records and keys."""
    import pyarrow.parquet as pq

    held, size, start = [], 0, 0

    def block() -> Block:
        return Block(pa.Table.from_batches(held).combine_chunks().to_batches()[0], start)

    for uri in files:
        store, path = opened(uri)
        with store.open_input_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(min(2048, BLOCK), columns=["source", "id", "rows"], use_threads=False):
                if not batch.num_rows:
                    continue
                held.append(batch)
                size += len(batch["rows"].flatten().field("keys").flatten())
                if sum(b.num_rows for b in held) >= BLOCK or size >= BLOCK_KEYS:
                    yield (now := block())
                    held, size, start = [], 0, start + now.n
    if held:
        yield block()


class References:
    """Distinct keys of some reference records, by record and first place."""

    def __init__(self, rows: pa.RecordBatch):
        self.n, self.ids = rows.num_rows, rows["id"]
        owner, keys, place, _ = _flat(rows["rows"])
        order = np.lexsort((place, keys, owner))
        owner, keys, place = owner[order], keys[order], place[order]
        new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])))) if len(keys) else np.zeros(0, np.int64)
        times, owner, keys, place = np.diff(np.append(new, len(keys))), owner[new], keys[new], place[new]
        order = np.lexsort((place, owner))
        self.keys, self.place, self.times, owner = keys[order], place[order], times[order], owner[order]
        self.bounds = np.searchsorted(owner, np.arange(self.n + 1))

    def met(self, block: Block) -> Iterator[tuple[int, list[int], list[int], list[int]]]:
        """For each record with a key of the block: its number, and the keys' numbers in the block, places and times."""
        if not len(block.keys):
            return
        at = np.minimum(np.searchsorted(block.keys, self.keys), len(block.keys) - 1)
        there = block.keys[at] == self.keys
        kept_, bounds = np.flatnonzero(there), np.concatenate(([0], np.cumsum(there)))[self.bounds].tolist()
        keys, place, times = at[kept_].tolist(), self.place[kept_].tolist(), self.times[kept_].tolist()
        for r in range(self.n):
            a, b = bounds[r], bounds[r + 1]
            if a < b:
                yield r, keys[a:b], place[a:b], times[a:b]


def _least_shared(counts: np.ndarray, k: int) -> int:
    """The k-th highest count; 1 if fewer are above 0."""
    if len(counts) <= k:
        return 1
    top = int(counts.max())
    if top > 1 << 16:
        return max(1, int(np.partition(counts, len(counts) - k)[len(counts) - k]))
    above = np.cumsum(np.bincount(counts, minlength=top + 1)[::-1])
    return max(1, top - int(np.searchsorted(above, k)))


def _best(references: References, files: list[str], k: int) -> Iterator[pa.RecordBatch]:
    best: list[tuple[np.ndarray, np.ndarray] | None] = [None] * references.n
    ids, sources = [], []
    for block in _blocks(files):
        ids.append(block.ids)
        sources += block.sources
        for r, keys, places, times in references.met(block):
            counts, before = block.counts(keys, times), best[r]
            full = before is not None and len(before[0]) == k
            least = max(_least_shared(counts, k), -(int(before[0][-1]) >> SHIFT) if full else 1)
            chosen = np.flatnonzero(counts >= least)
            if not len(chosen):
                continue
            order = (-counts[chosen] << SHIFT) + block.first_met(chosen, keys, places)
            if len(order) > 4 * k:
                near = order <= np.partition(order, k - 1)[k - 1]
                chosen, order = chosen[near], order[near]
            chosen = chosen + block.start
            if before is not None:
                order, chosen = np.concatenate((before[0], order)), np.concatenate((before[1], chosen))
            first = np.argsort(order, kind="stable")[:k]
            best[r] = order[first], chosen[first]
    yield from _rows(references, best, pa.chunked_array(ids, pa.string()) if ids else None, sources)


def _rows(references: References, best: list, ids: pa.ChunkedArray | None, sources: list[str]) -> Iterator[pa.RecordBatch]:
    names = ["source1_id", "candidate_id", "source", "shared", "rank"]
    if ids is None:
        return
    ids, coded = ids.combine_chunks(), pa.array(sources, pa.string())
    done, held = [], 0
    for r in range(references.n):
        if best[r] is not None:
            done.append(r)
            held += len(best[r][0])
        if done and (held >= OUT_ROWS or r == references.n - 1):
            sizes = [len(best[i][0]) for i in done]
            order, chosen = np.concatenate([best[i][0] for i in done]), pa.array(np.concatenate([best[i][1] for i in done]))
            ranks = np.concatenate([np.arange(1, n + 1, dtype=np.int32) for n in sizes])
            yield pa.RecordBatch.from_arrays([references.ids.take(pa.array(np.repeat(done, sizes))), ids.take(chosen), coded.take(chosen), pa.array(-(order >> SHIFT)), pa.array(ranks)], names)
            done, held = [], 0


def _best_of_repeated(references: References, files: list[str], k: int) -> Iterator[pa.RecordBatch]:
    """As _best where an id of a source has several rows: the row of the first key met, not of the record, breaks ties."""
    best: list[list[tuple]] = [[] for _ in range(references.n)]
    for block in _blocks(files):
        several = set(np.flatnonzero(np.diff(block.rows.offsets.to_numpy()) > 1).tolist())
        names = block.ids.to_pylist()
        for r, keys, places, times in references.met(block):
            counts = block.counts(keys, times)
            chosen = np.flatnonzero(counts >= _least_shared(counts, k))
            met = block.first_met(chosen, keys, places)
            of_key = dict(zip(block.keys[keys].tolist(), places))
            for c, at in zip(chosen.tolist(), met.tolist()):
                rows = block.rows[c].as_py()
                row = rows[0]["row"]
                if c in several:
                    row = min(x["row"] for x in rows if any(of_key.get(key) == at for key in x["keys"]))
                best[r].append((-int(counts[c]), at, block.sources[c], row, names[c] is not None, names[c]))
            best[r] = heapq.nsmallest(k, best[r])
    rows = [(name, c[-1], c[2], -c[0], i) for name, found in zip(references.ids.to_pylist(), best) for i, c in enumerate(found, 1)]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int32())
    for a in range(0, len(rows), OUT_ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows[a:a + OUT_ROWS]), kinds)], ["source1_id", "candidate_id", "source", "shared", "rank"])


def _totals(references: References, files: list[str]) -> Iterator[pa.RecordBatch]:
    rows: dict[str, list[int]] = {}
    for block in _blocks(files):
        ends = [i for i in range(1, block.n) if block.sources[i] != block.sources[i - 1]] + [block.n]
        for _, keys, _, times in references.met(block):
            counts, start = block.counts(keys, times), 0
            for end in ends:
                part, now = counts[start:end], rows.setdefault(block.sources[start], [0, 0, 0])
                start = end
                now[0] += int(np.count_nonzero(part))
                now[1] += int(part.sum())
                now[2] = max(now[2], int(part.max()))
    there = [(s, *v) for s, v in sorted(rows.items()) if v[0]]
    if there:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*there)], ["source", "pairs", "shared", "most"])


def _by_reference(found: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(reference, [(shared, source, candidate)]) of what _best yields."""
    name, held = None, []
    for batch in found:
        for one, *row in zip(*(batch[c].to_pylist() for c in ("source1_id", "shared", "source", "candidate_id"))):
            if held and one != name:
                yield name, held
                held = []
            name = one
            held.append(row)
    if held:
        yield name, held


def _with_near(found: Iterator[pa.RecordBatch], near: dict, k: int) -> Iterator[pa.RecordBatch]:
    """Of each reference the best k of its candidates by keys, most shared first, and of near: reference -> [{source, candidate_id, similarity}]."""
    done: list[tuple] = []

    def best(name, rows: list, close: list[dict]) -> Iterator[tuple]:
        similar = {(c["source"], c["candidate_id"]): c["similarity"] for c in close}
        if len(rows) > k:
            least = rows[k - 1][0]
            rows = [row for row in rows if row[0] >= least]
        rows = [(-shared, source, c, similar.pop((source, c), None)) for shared, source, c in rows]
        rows += [(0, source, c, similarity) for (source, c), similarity in similar.items()]
        value = lambda x: (1, 0.0) if x is None else (0, -x if x == x else -math.inf)  # noqa: E731 - not a number comes first, as in Spark
        rows.sort(key=lambda row: (row[0], value(row[3]), row[1] is not None, row[1] or "", row[2] is not None, row[2] or ""))
        return ((name, source, c, -shared, similarity, i) for i, (shared, source, c, similarity) in enumerate(rows[:k], 1))

    def out(most: int) -> Iterator[pa.RecordBatch]:
        while len(done) > most:
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*done[:OUT_ROWS]), kinds)], ["source1_id", "source", "candidate_id", "shared", "similarity", "rank"])
            del done[:OUT_ROWS]

    for name, rows in _by_reference(found):
        done += best(name, rows, near.pop(name, []))
        yield from out(OUT_ROWS)
    for name, close in near.items():
        done += best(name, [], close)
    yield from out(0)


def _per_reference(lists: DataFrame, work, schema: str, near: DataFrame | None = None) -> DataFrame:
    """work(references, files, whether an id of a source has several rows) over all reference records, some thousand at a time.

    near: (id, near), which goes with the record of this id to work as a fourth argument, a dict; ids without a record come too.
    """
    spark = ship(lists.sparkSession)
    hashed = F.transform("keys", lambda key: F.when(key.isNotNull(), F.xxhash64(key)))
    records = lists.select("source", F.col("id").cast("string").alias("id"), F.struct(F.col("row").cast("long").alias("row"), hashed.alias("keys")).alias("r")).filter("source is not null and r.keys is not null")
    records = kept(records.groupBy("source", "id").agg(F.sort_array(F.collect_list("r")).alias("rows")), "record-keys")
    size = records.agg(F.count_if(F.col("source") == REFERENCE).alias("left"), F.max(F.size("rows")).alias("most")).first()
    others = kept(records.filter(F.col("source") != REFERENCE).orderBy("source", F.col("rows")[0]["row"], "id"), "candidate-keys")
    files = sorted(others.inputFiles(), key=lambda uri: uri.rsplit("/", 1)[-1])  # numbered in order by Spark
    repeated = (size["most"] or 0) > 1

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        more = [dict((name, close) for name, close in zip(rows["id"].to_pylist(), rows["near"].to_pylist()) if close)] if "near" in rows.schema.names else []
        yield from work(References(rows), files, repeated, *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= REFERENCES:
                yield from done(held)
                held, n = [], 0
        if n:
            yield from done(held)

    left = records.filter(F.col("source") == REFERENCE).select("id", "rows")
    if near is not None:
        beside = near.select(F.col("id").alias("near_id"), "near")
        none = F.array().cast(left.schema["rows"].dataType)
        left = left.join(beside, F.col("id").eqNullSafe(F.col("near_id")), "full").select(F.coalesce("id", "near_id").alias("id"), F.coalesce("rows", none).alias("rows"), "near")
    parts = max(1, min(spark.sparkContext.defaultParallelism * 2, size["left"] // 64), -(-size["left"] // REFERENCES))
    return left.repartition(parts).mapInArrow(run, schema)


def best_candidates(lists: DataFrame, k: int) -> DataFrame:
    """(source1_id, candidate_id, source, shared, rank): the k candidates with most shared keys for each reference record.

    lists: (source, id, row, keys). Repeated keys multiply, as bags do. Ties go to the key met first, then to source, row and id.
    """
    return _per_reference(lists, lambda r, files, repeated: (_best_of_repeated if repeated else _best)(r, files, k), "source1_id string, candidate_id string, source string, shared long, rank int")


def best_hybrid(lists: DataFrame, near: DataFrame, k_keys: int, k: int) -> DataFrame:
    """(source1_id, source, candidate_id, shared, similarity, rank): the best k of best_candidates(lists, k_keys) and near (source1_id, source, candidate_id, similarity) together.

    Each pair once, by shared keys, then similarity, source and id. What is near goes to its reference record, so no candidate crosses a shuffle.
    """
    once = near.groupBy("source1_id", "source", "candidate_id").agg(F.max("similarity").cast("double").alias("similarity"))
    close = once.groupBy(F.col("source1_id").alias("id")).agg(F.collect_list(F.struct("source", "candidate_id", "similarity")).alias("near"))
    schema = "source1_id string, source string, candidate_id string, shared long, similarity double, rank int"
    return _per_reference(lists, lambda r, files, repeated, beside: _with_near((_best_of_repeated if repeated else _best)(r, files, k_keys), beside, k), schema, close)


def pair_totals(lists: DataFrame) -> DataFrame:
    """(source, pairs, shared, most): pairs of a reference record and one of the source that share a key, the keys shared in all, and by one pair at most."""
    some = _per_reference(lists, lambda r, files, _: _totals(r, files), "source string, pairs long, shared long, most long")
    return some.groupBy("source").agg(F.sum("pairs").alias("pairs"), F.sum("shared").alias("shared"), F.max("most").alias("most"))
