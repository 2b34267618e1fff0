"""Cumulative-link ordinal regression on hashed text features.

P(grade <= j | x) = sigmoid(threshold[j] - w . x): one weight vector for all grades and ascending thresholds.
Features are present or absent and are named by 32-bit hashes; an L1 penalty leaves few weights, so the hash
space costs nothing and features that were never seen weigh nothing. Two grades make it logistic regression.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithlink.llm.common import byte_batches, frugal, utf8_lengths

#: Labelled rows that a fit takes at most, those with the smallest hash of their id.
MAX_TRAINING_ROWS = 4000
#: Bytes of text whose features are found at once.
BATCH_BYTES = 1 << 20

#: An Arrow array of texts, and the hashes that matter (None: all), to (text positions, hashes), each pair once.
Featurizer = Callable[[pa.Array, np.ndarray | None], tuple[np.ndarray, np.ndarray]]


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass"))


def _chunks(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct chunks between white space; every chunk's number, and its text's position."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().dictionary_encode()
    sizes = np.diff(lists.offsets.to_numpy())
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(), np.repeat(np.arange(len(texts)), sizes)


def _pairs(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(rows.astype(np.uint64) << np.uint64(32) | hashes.astype(np.uint64))
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)


_EDGES = "".join(map(chr, [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])) + "“”‘’«»…—–¡¿"


#: Besides whole words, their beginnings of so many letters: inflected forms share a stem.
STEMS = (4, 5, 6)


def word_features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A feature for each lower-cased word without the marks around it, and one for each of its stems."""
    names, numbers, of = _chunks(texts)
    words = [n.strip(_EDGES).lower() for n in names]
    columns = [np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words))]
    columns += [np.fromiter((zlib.crc32((w[:k] + "*").encode()) for w in words), np.uint32, len(words)) for k in STEMS]
    rows, hashes = [], []
    for column in columns:
        at, text = numbers, of
        if wanted is not None:
            mine = np.isin(column, wanted)[numbers] if len(names) else np.empty(0, bool)
            at, text = numbers[mine], of[mine]
        rows.append(text)
        hashes.append(column[at])
    return _pairs(np.concatenate(rows), np.concatenate(hashes))


def _shape(chunk: str) -> str:
    body = chunk.strip(_EDGES)
    tail = chunk[len(chunk.rstrip(_EDGES)):] if body else chunk
    kind = "" if not body else "0" if body.isdigit() else "A" if body.isupper() and len(body) > 1 else "a" if body.isalpha() else "?"
    return kind + "".join(dict.fromkeys(tail))[:4] + ("+" if len(tail) > 1 else "")


def form_features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What a text looks like: the share of each chunk shape, of repeated and of distinct chunks, its length.

    A share gives a feature for each power of two that it reaches, so the weights can form any rising curve.
    """
    names, numbers, of = _chunks(texts)
    total = np.bincount(of, minlength=len(texts))
    shapes: dict[str, int] = {}
    code = np.fromiter((shapes.setdefault(_shape(n), len(shapes)) for n in names), np.int64, len(names))
    rows, hashes = [], []

    def add(positions: np.ndarray, name: str, share: np.ndarray) -> None:
        for p in range(10):
            hit = positions[share >= 0.9 * 0.5**p]
            rows.append(hit)
            hashes.append(np.full(len(hit), _hash(f"{name}>{p}"), np.uint32))

    if len(numbers):
        cells, counts = np.unique(of * len(shapes) + code[numbers], return_counts=True)
        doc, shape = cells // len(shapes), cells % len(shapes)
        for name, s in shapes.items():
            here = shape == s
            add(doc[here], f"shape {name}", counts[here] / total[doc[here]])
        again = np.flatnonzero((numbers[1:] == numbers[:-1]) & (of[1:] == of[:-1]))
        some = np.flatnonzero(total)
        add(some, "again", (np.bincount(of[again], minlength=len(texts)) / np.maximum(total, 1))[some])
        distinct = np.bincount(np.unique(of * len(names) + numbers) // len(names), minlength=len(texts))
        long_ = np.flatnonzero(total >= 16)
        add(long_, "distinct", (distinct / np.maximum(total, 1))[long_])
        letters = np.fromiter(map(len, names), np.int64, len(names))
        mean = np.bincount(of, letters[numbers], minlength=len(texts)) / np.maximum(total, 1)
        add(some, "length", np.minimum(1, mean[some] / 32))
    at = np.concatenate(rows) if rows else np.empty(0, np.int64)
    seen = np.concatenate(hashes) if hashes else np.empty(0, np.uint32)
    if wanted is not None:
        mine = np.isin(seen, wanted)
        at, seen = at[mine], seen[mine]
    return _pairs(at, seen)


def quality_features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Words and form together."""
    a, b = word_features(texts, wanted), form_features(texts, wanted)
    return np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1]))


@dataclass
class OrdinalModel:
    """features (ascending hashes) with their weights, and the thresholds between grades in ascending order."""

    grades: list[int]
    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: pa.Array, featurize: Featurizer) -> np.ndarray:
        rows, hashes = featurize(texts, self.features)
        at = np.searchsorted(self.features, hashes)
        return np.bincount(rows, self.weights[at], minlength=len(texts)) if len(rows) else np.zeros(len(texts))

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for the second and every later grade, a column each."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])

    def expected(self, tails: np.ndarray) -> np.ndarray:
        steps = np.diff(np.array(self.grades, float))
        return (self.grades[0] if self.grades else 0.0) + tails @ steps if len(steps) else np.full(len(tails), float(self.grades[0] if self.grades else 0))

    def tail_from(self, tails: np.ndarray, grade: int) -> np.ndarray:
        """P(grade >= the given one); a grade below all: 1, above all: 0."""
        j = int(np.searchsorted(self.grades, grade))
        return np.full(len(tails), 0.0 if j >= len(self.grades) else 1.0) if j == 0 or j >= len(self.grades) else tails[:, j - 1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(rows: np.ndarray, hashes: np.ndarray, grades: np.ndarray, l1: float = 2e-4, min_rows: int = 3, screen: int = 4000, rounds: int = 300) -> OrdinalModel:
    """Fit with an L1 penalty on the `screen` features of the steepest gradient at the start, then anew without it on those that it leaves.

    The penalty selects; the second fit takes back the shrinkage, under a weak L2 term that keeps separable grades finite.
    rows and hashes: a feature of a row each; grades: one a row.
    """
    levels, y = np.unique(grades, return_inverse=True)
    features, column, seen = np.unique(hashes, return_inverse=True, return_counts=True)
    if len(levels) > 1:
        rank = y - y.mean()
        pull = np.abs(np.bincount(column, rank[rows], minlength=len(features)))
        pull[seen < min_rows] = 0
        least = np.sort(pull)[-screen] if len(pull) > screen else 0
        use = ((pull >= least) & (pull > 0))[column]
        rows, hashes = rows[use], hashes[use]
    first = _descend(rows, hashes, grades, l1, 0.0, rounds)
    if not len(first.features):
        return first
    use = np.isin(hashes, first.features)
    return _descend(rows[use], hashes[use], grades, 0.0, 1e-4, rounds)


def _descend(rows: np.ndarray, hashes: np.ndarray, grades: np.ndarray, l1: float, l2: float, rounds: int) -> OrdinalModel:
    """Accelerated proximal gradient on the mean loss; thresholds are the first one plus exponentials, so they ascend."""
    levels, y = np.unique(grades, return_inverse=True)
    n, k = len(grades), len(levels)
    if k < 2:
        return OrdinalModel([int(x) for x in levels], np.empty(0, np.uint32), np.empty(0), np.empty(0))
    features, column = np.unique(hashes, return_inverse=True)
    share = np.cumsum(np.bincount(y, minlength=k))[:-1] / n
    start = np.log(share / (1 - share))
    theta = np.concatenate(([start[0]], np.log(np.maximum(np.diff(start), 1e-3))))
    w, m = np.zeros(len(features)), len(features)

    def bounds(t: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate(([t[0]], np.exp(t[1:]))))

    def loss(w: np.ndarray, t: np.ndarray, gradient: bool = True):
        s, b = np.bincount(rows, w[column], minlength=n) if m else np.zeros(n), bounds(t)
        upper = np.where(y < k - 1, _sigmoid(b[np.minimum(y, k - 2)] - s), 1.0)
        lower = np.where(y > 0, _sigmoid(b[np.maximum(y - 1, 0)] - s), 0.0)
        p = np.maximum(upper - lower, 1e-12)
        value = -np.log(p).mean() + l2 / 2 * (w @ w)
        if not gradient:
            return value
        by_score = (1 - upper - lower) / n
        by_bound = np.bincount(np.minimum(y, k - 2), -upper * (1 - upper) / p / n * (y < k - 1), minlength=k - 1) + np.bincount(np.maximum(y - 1, 0), lower * (1 - lower) / p / n * (y > 0), minlength=k - 1)
        after = np.cumsum(by_bound[::-1])[::-1]
        return value, np.bincount(column, by_score[rows], minlength=m) + l2 * w if m else w, np.concatenate(([after[0]], after[1:] * np.exp(t[1:])))

    step, speed, old_w, old_t, at_w, at_t = 4.0, 1.0, w, theta, w, theta
    for _ in range(rounds):
        value, gw, gt = loss(at_w, at_t)
        while True:
            new_w, new_t = at_w - step * gw, at_t - step * gt
            new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * l1, 0)
            dw, dt = new_w - at_w, new_t - at_t
            if loss(new_w, new_t, False) <= value + gw @ dw + gt @ dt + (dw @ dw + dt @ dt) / (2 * step) + 1e-12 or step < 1e-6:
                break
            step /= 2
        if ((at_w - new_w) @ (new_w - old_w)) > 0:
            speed = 1.0
        faster = (1 + (1 + 4 * speed * speed) ** 0.5) / 2
        at_w, at_t = new_w + (speed - 1) / faster * (new_w - old_w), new_t + (speed - 1) / faster * (new_t - old_t)
        moved = max(np.abs(new_w - old_w).max(initial=0), np.abs(new_t - old_t).max())
        old_w, old_t, speed = new_w, new_t, faster
        if moved < 1e-5:
            break
        step *= 1.1
    held = np.flatnonzero(old_w)
    return OrdinalModel([int(x) for x in levels], features[held], old_w[held], bounds(old_t))


def fit_on(docs: DataFrame, labels: DataFrame, grade_col: str, featurize: Featurizer, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_TRAINING_ROWS, l1: float = 2e-4, rounds: int = 300) -> OrdinalModel:
    """Fit on at most max_rows labelled rows: a documented bound, chosen by the hash of the id, so by chance and always the same.

    Rows without id, grade or text are left out; of rows that repeat a labelled id the least text counts, so no more than max_rows come to the driver. No labels: a model without grades, which expects 0 everywhere.
    """
    chosen = labels.select(F.col(id_col).alias("id"), F.col(grade_col).cast("int").alias("grade")).dropna().distinct().orderBy(F.xxhash64("id"), "id", "grade").limit(max_rows)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).dropna().join(F.broadcast(chosen), "id")
    sample = sample.groupBy("id", "grade").agg(F.min("text").alias("text")).select("grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in byte_batches(utf8_lengths(batch.column(1)), BATCH_BYTES):
                rows, hashes = featurize(batch.column(1).slice(a, b - a), None)
                order = np.argsort(rows, kind="stable")
                ends = np.searchsorted(rows[order], np.arange(b - a + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hashes[order].astype(np.int32, casting="unsafe")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["grade", "features"])

    found = sample.mapInArrow(frugal(run), "grade int, features array<int>").toArrow()
    grades = found.column("grade").to_numpy()
    lists = found.column("features").combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    hashes = lists.flatten().to_numpy().astype(np.int32).view(np.uint32)
    rows = np.repeat(np.arange(len(grades)), np.diff(lists.offsets.to_numpy()))
    order = np.lexsort((hashes, rows))
    return fit(rows[order], hashes[order], grades, l1=l1, rounds=rounds)


def score(docs: DataFrame, model: OrdinalModel, featurize: Featurizer, grade: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, expected grade and P(grade >= `grade`), read where the row is: no shuffle. Null texts count as empty."""
    return _scored(docs, model, featurize, grade, [id_col], text_col).select(F.col("c0").alias(id_col), "expected", "tail")


def below(docs: DataFrame, model: OrdinalModel, featurize: Featurizer, grade: int, bound: float, text_col: str = "text") -> DataFrame:
    """The whole rows of docs for which P(grade >= `grade`) is less than the bound; any column names may be there."""
    names = docs.columns
    kept = _scored(docs, model, featurize, grade, names, text_col).filter(F.col("tail") < bound)
    return kept.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)))


def _scored(docs: DataFrame, model: OrdinalModel, featurize: Featurizer, grade: int, carried: list[str], text_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carried))
    rows = docs.select(F.col(text_col).cast("string").alias("scored"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carried)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            texts, out = pc.fill_null(batch.column(0), ""), []
            for a, b in byte_batches(utf8_lengths(texts), BATCH_BYTES):
                out.append(own.tails(own.scores(texts.slice(a, b - a), featurize)))
            tails = np.concatenate(out) if out else np.empty((0, len(own.thresholds)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(own.expected(tails)), pa.array(own.tail_from(tails, grade))], [*(f"c{i}" for i in range(len(carried))), "expected", "tail"])

    return rows.mapInArrow(frugal(run), f"{kinds}, expected double, tail double")
