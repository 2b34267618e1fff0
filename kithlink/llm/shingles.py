"""Word hashes and shingle sets of Arrow string arrays, column by column."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z lower-cased; split at ASCII white space) and each text's bounds; null has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten().dictionary_encode()
    names = words.dictionary.to_numpy(zero_copy_only=False)
    numbers = words.indices.to_numpy()
    hashed = pd.util.hash_array(names, categorize=False).astype(np.uint64) if len(names) else np.empty(0, np.uint64)
    flat, bounds = hashed[numbers], bounds - bounds[0]
    blank = np.flatnonzero(names == "")
    if len(blank):  # white space at an end of a text leaves an empty word there
        real = numbers != blank[0]
        bounds = np.concatenate(([0], np.cumsum(real)))[bounds]
        flat = flat[real]
    return flat, bounds


def shingles(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words in order; a text of fewer words, but not none, is one run. And each text's bounds."""
    counts = np.diff(bounds)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate(([0], np.cumsum(each)))
    with np.errstate(over="ignore"):
        n = max(0, len(words) - size + 1)
        run = np.full(n, np.uint64(size), np.uint64)
        for k in range(size):
            run = (run ^ words[k:k + n]) * _ODD
            run ^= run >> np.uint64(32)
    out = np.empty(out_bounds[-1], np.uint64)
    long_ = np.flatnonzero(counts >= size)
    if len(long_):
        starts, sizes = bounds[long_], each[long_]
        place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(out_bounds[long_], sizes) + place] = run[np.repeat(starts, sizes) + place]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        whole = np.array([np.uint64(counts[i])])
        with np.errstate(over="ignore"):
            for w in words[bounds[i]:bounds[i + 1]]:
                whole = (whole ^ w) * _ODD2
                whole ^= whole >> np.uint64(29)
        out[out_bounds[i]] = whole[0]
    return out, out_bounds


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, ascending, and the bounds."""
    runs, bounds = shingles(*word_hashes(texts), size)
    keep = np.ones(len(runs), bool)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        runs[a:b].sort()
    keep[1:] = runs[1:] != runs[:-1]
    keep[bounds[:-1][np.diff(bounds) > 0]] = True
    return runs[keep], np.concatenate(([0], np.cumsum(keep)))[bounds]
