"""Exact Jaccard self-join of documents over word shingles, with token-combination prefixes.

Tokens (shingles) fall into classes by how many documents hold them, as a sketch of the whole corpus tells.
Every set is ordered rare tokens first. If two sets share at least `need` tokens, at most size - need tokens of
either are missing in the other; so a prefix that holds size - need + 1 tokens more than a class may share
without a common signature must have one. A rare token is a signature by itself; a prefix of rare tokens is made longer
still, so that similar sets must share a number of them, which tells candidates from documents that only share
a passage. Frequent tokens fall into groups, and a signature is a pair of tokens of one group; each group
a prefix touches costs it one token more. One document of each class of equal sets stands for all of them. In a bucket of documents
with a common signature each is compared with a hub, the one with most equal copies (linking.py); documents with the same hub are then
compared in blocks, those with other hubs where they share a bucket. Every link is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithlink.llm.common import byte_batches, drop_scratch, frugal, materialize, release, utf8_lengths
from kithlink.llm.linking import components, hub_edges, shared_keys, stray_pairs, undirected
from kithlink.llm.shingles import mix, shingle_sets

SIZE = 5
PERCENT = 75
#: Counters of the frequency sketch; two bytes each in a task, one bit each when broadcast.
BUCKETS = 1 << 20
PARTS = 16
#: Sets of at most so many tokens use single tokens only; then groups of frequent tokens by size of the smaller set.
SMALL = 16
GROUPS = ((2048, 8), (16384, 64), (1 << 62, 512))
#: Percent of its tokens by which a prefix of rare tokens is longer than one common signature needs.
FURTHER = 8
#: Documents that one copy of a hub's set is compared with.
FAN = 100
BROADCAST_ROWS = 300_000
#: Documents and bytes of sets in a block.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
BATCH_BYTES = 1 << 20


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) >> np.uint64(44)).astype(np.int64)  # 20 bits


def frequent_buckets(docs: DataFrame, text_col: str = "text", size: int = SIZE) -> np.ndarray:
    """A bit for each bucket of tokens: whether clearly more documents than usual hold its tokens.

    Every task counts all its documents' distinct tokens in BUCKETS cells; cells are added up in three
    levels of at most 64 arrays, so no group grows with the number of tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in byte_batches(utf8_lengths(texts), BATCH_BYTES):
                held += np.bincount(_bucket(shingle_sets(texts.slice(a, b - a), size)[0]), minlength=BUCKETS)
        parts = [np.minimum(p, 0xFFFF).astype("<u2").tobytes() for p in np.split(held, PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([TaskContext.get().partitionId()] * PARTS, pa.int32()), pa.array(parts, pa.binary())], ["part", "task", "cells"])

    def add(table: pa.Table) -> pa.Table:
        kind = "<u2" if len(table.column("cells")[0].as_py()) == 2 * BUCKETS // PARTS else "<u4"
        total = sum(np.frombuffer(c.as_py(), kind).astype(np.uint32) for c in table.column("cells"))
        return pa.table({"part": table.column("part").slice(0, 1), "task": table.column("task").slice(0, 1), "cells": pa.array([total.astype("<u4").tobytes()], pa.binary())})

    def mark(table: pa.Table) -> pa.Table:
        total = np.frombuffer(add(table).column("cells")[0].as_py(), "<u4")
        usual = float(np.median(total))
        bits = np.packbits(total > usual + 6 * usual**0.5 + 48)
        return pa.table({"part": table.column("part").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    cells = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(frugal(count), "part int, task int, cells binary")
    for level in (64, 4096):
        cells = cells.withColumn("g", (F.col("task") / level).cast("int")).groupBy("part", "g").applyInArrow(add, "part int, task int, cells binary")
    rows = cells.groupBy("part").applyInArrow(mark, "part int, bits binary").collect()  # BUCKETS bits in all
    bits = {r["part"]: np.frombuffer(r["bits"], np.uint8) for r in rows}
    none = np.zeros(BUCKETS // PARTS // 8, np.uint8)
    return np.unpackbits(np.concatenate([bits.get(p, none) for p in range(PARTS)])).astype(bool)


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The signatures of one set, given as distinct tokens in ascending order, and which of them are frequent.

    And how many of them a similar set shares at least, unless the other set's number is lower: the set whose prefix ends first
    in the common order has all its shared prefix tokens in the other's prefix, and lacks size - need of them at most.
    """
    n = len(tokens)
    if n == 0:
        return np.empty(0, np.uint64), 0
    need = -(-n * percent // 100)
    wanted = n - need + 1
    least = need  # the smallest set that can link with this one
    out = []
    if least <= SMALL:
        out.append(mix(tokens[:wanted] ^ np.uint64(0x5EED)))
    if n > SMALL:
        rare = tokens[~frequent]
        longer = n * FURTHER // 100
        if least > SMALL and len(rare) >= wanted + longer:
            return rare[:wanted + longer], 1 + longer
        out.append(rare[:wanted])
        if len(rare) < wanted:
            common, low = tokens[frequent], SMALL
            for high, groups in GROUPS:
                if least <= high and n > low:
                    out.append(_pairs(common, groups, wanted - len(rare)))
                low = high
    return np.concatenate(out), 1


def _pairs(tokens: np.ndarray, groups: int, wanted: int) -> np.ndarray:
    """Pairs of tokens of a group, from the shortest prefix that has `wanted` tokens besides the first of each group."""
    group = (mix(tokens ^ np.uint64(groups)) % np.uint64(groups)).astype(np.int64)
    _, first = np.unique(group, return_index=True)
    further = np.ones(len(tokens), bool)
    further[first] = False
    end = int(np.searchsorted(np.cumsum(further), wanted)) + 1
    tokens, group = tokens[:end], group[:end]
    order = np.argsort(group, kind="stable")
    tokens, group = tokens[order], group[order]
    cuts = np.flatnonzero(np.diff(group)) + 1
    out = []
    with np.errstate(over="ignore"):
        for part in np.split(tokens, cuts):
            i, j = np.triu_indices(len(part), 1)
            out.append(mix(part[i] * np.uint64(0x9E3779B97F4A7C15) ^ mix(part[j])) ^ np.uint64(groups))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _signed(docs: DataFrame, marked: np.ndarray, size: int, percent: int) -> DataFrame:
    """A row a document: id, n, fp1, fp2 (of its set), least (shared signatures), keys (signatures; none without an id, or where the task has had the same set before)."""
    shared = docs.sparkSession.sparkContext.broadcast(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            texts = batch.column(1)
            for a, b in byte_batches(utf8_lengths(texts), BATCH_BYTES):
                tokens, bounds = shingle_sets(texts.slice(a, b - a), size)
                frequent = shared.value[_bucket(tokens)]
                sizes = np.diff(bounds)
                some = np.flatnonzero(sizes)
                fp = [np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)]
                with np.errstate(over="ignore"):
                    for k, salt in enumerate((0x51, 0xA7)):
                        fp[k][some] = mix(np.add.reduceat(mix(tokens ^ np.uint64(salt)), bounds[:-1][some]) + sizes[some].astype(np.uint64)) if len(some) else 0
                named = batch.column(0).slice(a, b - a).is_valid().to_pylist()
                keys, least = [], np.zeros(b - a, np.int32)
                for i, (x, y) in enumerate(zip(fp[0].tolist(), fp[1].tolist())):
                    if sizes[i] == 0 or not named[i] or (x, y) in seen:  # rows without an id link with nothing
                        keys.append(np.empty(0, np.int64))
                        continue
                    if len(seen) < 200_000:
                        seen.add((x, y))
                    own, least[i] = signatures(tokens[bounds[i]:bounds[i + 1]], frequent[bounds[i]:bounds[i + 1]], percent)
                    keys.append(own.view(np.int64) >> 16)
                ends = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), pa.array(fp[0].view(np.int64)), pa.array(fp[1].view(np.int64)), pa.array(least), lists], ["node", "n", "fp1", "fp2", "least", "keys"])

    return docs.mapInArrow(frugal(run), "node long, n long, fp1 long, fp2 long, least int, keys array<long>")


def _sets_at(docs: DataFrame, goals: DataFrame, size: int) -> DataFrame:
    """goals: (node, and the columns of its goal). A row (of these columns, node, tokens) for each, with the set of the node's text.

    The texts meet the goals by a broadcast of these while they are at most BROADCAST_ROWS rows, else by a shuffle.
    """
    columns = [c for c in goals.columns if c != "node"]
    kinds = {c: goals.schema[c].dataType for c in columns}
    wanted = materialize(goals.groupBy("node").agg(F.collect_list(F.struct(*columns)).alias("goals")), "goals")
    numbers = wanted.agg(F.sum(F.size("goals")).alias("n")).first()["n"] or 0
    here = docs.join(F.broadcast(wanted) if numbers <= BROADCAST_ROWS else wanted, "node").select("node", "text", "goals")
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [*(pa.field(c, arrow[k.simpleString()]) for c, k in kinds.items()), pa.field("node", pa.int64()), pa.field("tokens", pa.binary())]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, nodes, all_goals = batch.column(1), batch.column(0), batch.column(2)
            for a, b in byte_batches(utf8_lengths(texts), BATCH_BYTES):
                tokens, bounds = shingle_sets(texts.slice(a, b - a), size)
                rows, held = [], 0
                for i in range(b - a):
                    data, node = tokens[bounds[i]:bounds[i + 1]].tobytes(), nodes[a + i].as_py()
                    for goal in all_goals[a + i].as_py():
                        rows.append((*(goal[c] for c in columns), node, data))
                        held += len(data)
                        if held > BATCH_BYTES:
                            yield _sent(rows, fields)
                            rows, held = [], 0
                if rows:
                    yield _sent(rows, fields)

    return here.mapInArrow(frugal(send), ", ".join([*(f"{c} {k.simpleString()}" for c, k in kinds.items()), "node long", "tokens binary"]))


def _verified(docs: DataFrame, edges: DataFrame, size: int, percent: int) -> DataFrame:
    """Of candidate edges (a, b) those whose sets reach the bound.

    Each a's set goes to b, whose own set goes there once for every FAN of them: no task holds more of a hub's pairs than that.
    """
    fans = edges.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / FAN).cast("int").alias("salts"))
    placed = edges.join(fans, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    members = placed.select(F.col("a").alias("node"), F.col("b").alias("target"), "salt", F.lit(True).alias("member"))
    hubs = placed.select(F.col("b").alias("node"), F.col("b").alias("target"), "salt", F.lit(False).alias("member")).distinct()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own = None, []
        for batch in batches:
            found = []
            for target, salt, member, node, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (target, salt) != place:
                    place, own = (target, salt), []
                tokens = np.frombuffer(data, np.uint64)
                if not member:
                    own.append(tokens)
                elif any(_similar(other, tokens, percent) for other in own):
                    found.append((node, target))
            if found:
                yield _links(found)

    sets = _sets_at(docs, members.unionByName(hubs), size)
    return sets.repartition("target", "salt").sortWithinPartitions("target", "salt", "member").mapInArrow(frugal(compare), "a long, b long").distinct()


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def links_of_block(nodes: np.ndarray, own: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what hangs together among the sets of a block; own: the components so far.

    side: 0 for the sets of one tile and 1 for those of another, of which only pairs across count; all 0: all pairs count. A token of one set whose bit
    the other's bitmap lacks is missing there, so the bits tell most pairs apart; the rest is compared whole.
    """
    n = np.array([len(s) for s in sets])
    bits = 1 << int(np.clip(np.ceil(np.log2(4 * np.median(n) + 64)), 8, 15))
    maps = np.zeros((len(sets), bits // 64), np.uint64)
    for i, s in enumerate(sets):
        at = (mix(s) & np.uint64(bits - 1)).astype(np.int64)
        np.bitwise_or.at(maps[i], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    own, found = own.copy(), []
    names, counts = np.unique(own, return_counts=True)
    largest = names[np.argmax(counts)]
    two = len(np.unique(side)) > 1
    for i in np.flatnonzero(own != largest).tolist():
        near = (own != own[i]) & (np.minimum(n, n[i]) * 100 >= percent * np.maximum(n, n[i]))
        if two:
            near &= side != side[i]
        at = np.flatnonzero(near)
        need = -(-percent * (n[at] + n[i]) // (100 + percent))
        at = at[(np.bitwise_count(maps[i] & ~maps[at]).sum(1) <= n[i] - need) & (np.bitwise_count(maps[at] & ~maps[i]).sum(1) <= n[at] - need)]
        for j in at.tolist():
            if own[i] != own[j] and _similar(sets[i], sets[j], percent):
                found.append((int(nodes[i]), int(nodes[j])))
                own[own == own[j]] = own[i]
    return found


def _links_by_pivot(docs: DataFrame, pivots: DataFrame, sizes: DataFrame, named: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among nodes with the same pivot, in tiles of bounded size: every pair of tiles is a block, and no pair is a row.

    Groups where all hang together have nothing left to compare and are left out.
    """
    own = pivots.join(named.withColumnRenamed("component", "own"), "node", "left").select("node", "pivot", F.coalesce("own", "node").alias("own"))
    own = own.join(sizes, "node")
    groups = own.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"), F.min("own").alias("least"), F.max("own").alias("most"), F.sum("n").alias("tokens")).filter("members > 1 and least <> most")
    tiles = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("tokens") * 8 / BLOCK_BYTES)).cast("int")
    placed = own.join(groups.select("pivot", tiles.alias("tiles")), "pivot").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda k: F.struct(F.least("tile", k).alias("i"), F.greatest("tile", k).alias("j")))
    goals = placed.select("node", "pivot", "own", "tile", F.inline(others)).select("node", "pivot", "i", "j", (F.col("tile") != F.col("i")).cast("int").alias("side"), "own")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []

        def ended() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            nodes, own, side = (np.array([h[k] for h in held], np.int64) for k in range(3))
            return links_of_block(nodes, own, side, [h[3] for h in held], percent)

        for batch in batches:
            for pivot, i, j, side, own, node, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (pivot, i, j) != place:
                    if found := ended():
                        yield _links(found)
                    place, held = (pivot, i, j), []
                held.append((node, own, side, np.frombuffer(data, np.uint64)))
        if found := ended():
            yield _links(found)

    sets = _sets_at(docs, goals, size)
    return sets.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j").mapInArrow(frugal(compare), "a long, b long").filter("a <> b").distinct()


def _links(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])


def _sent(rows: list[tuple], fields: list[pa.Field]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), fields)], schema=pa.schema(fields))


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(id, n_shingles) of every row, and verified links (a, b) that connect every group; links inside a connected group may be missing."""
    base = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(_signed(base, frequent_buckets(docs, text_col, size), size, percent), "signed")
    sizes = materialize(signed.select("node", "n", "fp1", "fp2"), "set-sizes")

    # equal sets are linked without a comparison, each to the least id of its kind; one that has keys stands for all
    alive = sizes.filter("node is not null and n > 0")
    first = alive.groupBy("fp1", "fp2", "n").agg(F.min("node").alias("a"))
    links = materialize(alive.join(first, ["fp1", "fp2", "n"]).select("a", F.col("node").alias("b")).filter("a <> b").distinct(), "links")
    kinds = signed.filter("node is not null and n > 0").groupBy("fp1", "fp2", "n").agg(F.min(F.when(F.size("keys") > 0, F.col("node"))).alias("node"), F.count(F.lit(1)).alias("often"))
    kinds = materialize(kinds, "set-kinds")
    chosen = signed.filter(F.size("keys") > 0).join(kinds, ["fp1", "fp2", "n", "node"]).dropDuplicates(["fp1", "fp2", "n"])
    # two numbers in one: fewer bytes cross the shuffle
    exploded = chosen.select("node", (F.shiftleft(F.col("n"), 31) + F.col("least")).alias("sized"), F.col("often").cast("int").alias("often"), F.explode("keys").alias("key"))
    buckets = materialize(shared_keys(exploded).select("key", "node", F.shiftright("sized", 31).alias("n"), F.col("sized").bitwiseAND((1 << 31) - 1).cast("int").alias("least"), "often"), "buckets")
    drop_scratch(signed, kinds)
    release(docs.sparkSession)

    near = F.least("n", "hub_n") * 100 >= percent * F.greatest("n", "hub_n")
    hubs = materialize(hub_edges(buckets, "often", ["n", "least"], near, F.least("least", "hub_least")), "hub-edges")
    links = materialize(links.unionByName(_verified(base, hubs.select(F.col("x").alias("a"), F.col("y").alias("b")), size, percent)), "links")
    release(docs.sparkSession)
    pivots = hubs.select(F.col("x").alias("node"), F.col("y").alias("pivot"))
    of_node = alive.groupBy("node").agg(F.max("n").alias("n"))
    links = materialize(links.unionByName(_links_by_pivot(base, pivots, of_node, components(links), size, percent)), "links")
    release(docs.sparkSession)

    fits = F.least("l.n", "r.n") * 100 >= percent * F.greatest("l.n", "r.n")
    met = stray_pairs(buckets, components(links), ["n", "least"], fits, enough=F.least("l.least", "r.least"), pivots=pivots)
    strays = materialize(met.filter("shared >= enough").select("a", "b").join(undirected(hubs), ["a", "b"], "left_anti"), "stray-pairs")
    drop_scratch(buckets)
    release(docs.sparkSession)
    if not strays.isEmpty():
        links = materialize(links.unionByName(_verified(base, strays, size, percent)), "links")
    return sizes.select("node", "n"), links


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (the least id reachable by links, its own included).

    Null and empty texts, and texts without words, have 0 shingles and link with nothing. Rows that repeat an id are one
    node with the links of all of them; null ids link with nothing and have a null component. Only the named
    columns are read. An empty table gives an empty result.
    """
    sizes, links = jaccard_links(docs, id_col, text_col, size, percent)
    named = components(links).select(F.col("node").alias("of"), "component")
    out = sizes.join(named, F.col("node") == F.col("of"), "left")
    return out.select(F.col("node").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all their columns, but those whose component has a smaller id; null ids stay."""
    groups = near_duplicate_groups(docs, id_col, text_col)
    gone = materialize(groups.filter(F.col("component_id") != F.col(id_col)).select(id_col).distinct(), "duplicates")
    right = F.broadcast(gone) if gone.count() <= 2_000_000 else gone
    return docs.join(right, id_col, "left_anti")
