"""What several operators share: words, shingle hashes in numpy, stage tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadwright.session import materialise

__all__ = ["SPACES", "concat", "documents", "doc_texts", "lower_bytes", "materialise", "partitions", "shingles",
           "wide_texts", "word_hashes", "words"]

# The white space of `[^\x20\x09-\x0D]+`, as a character class body and as characters.
SPACES = r"\x20\x09-\x0D"
_SPACE_CHARS = " \t\n\x0b\x0c\r"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, which its owner sets in proportion to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(text: Column) -> Column:
    """Array of the words of a text, split at ASCII white space; empty for null."""
    inner = F.trim(F.coalesce(text, F.lit("")), F.lit(_SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{SPACES}]+"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def doc_texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the bounds of each text; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def wide_texts(bounds: np.ndarray, limit: int = 4 << 20):
    """Runs of texts that hold about ``limit`` bytes together, so that temporary arrays stay small."""
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def lower_bytes(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(data: np.ndarray, bounds: np.ndarray, lower: bool = True, breaks: np.ndarray = _IS_SPACE,
                prefixes: tuple[int, ...] = ()) -> tuple:
    """64-bit hash of every word in turn, and each text's bounds in that array.

    ``breaks`` tells which bytes part words. For each of ``prefixes`` the hashes of the first so many bytes follow.
    """
    first, last = int(bounds[0]), int(bounds[-1])
    data, bounds = data[first:last], bounds - first
    solid = ~breaks[data]
    before = np.empty_like(solid)
    before[:1], before[1:] = False, solid[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    before[edge] = False
    starts = np.flatnonzero(solid & ~before)
    doc_words = np.searchsorted(starts, bounds)
    if not len(starts):
        return (np.zeros(0, np.uint64), doc_words, *[np.zeros(0, np.uint64)] * len(prefixes))
    at = np.flatnonzero(solid)
    counts = np.diff(np.append(np.searchsorted(at, starts), len(at)))
    inside = at - np.repeat(starts, counts)
    powers = np.cumprod(np.full(int(counts.max()), _ODD))
    chars = (_LOWER[data[at]] if lower else data[at]).astype(np.uint64) + np.uint64(1)
    terms, heads = chars * powers[inside], np.concatenate(([0], np.cumsum(counts)[:-1]))
    hashes = mix(np.add.reduceat(terms, heads) + counts.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    cut = [mix(np.add.reduceat(np.where(inside < k, terms, np.uint64(0)), heads) + np.uint64(k)) for k in prefixes]
    return (hashes, doc_words, *cut)


def shingles(hashes: np.ndarray, doc_words: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text; a shorter text is one shingle, an empty one none."""
    factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes) - k + 1
    grams = np.zeros(max(n, 0), np.uint64)
    for i in range(k if n > 0 else 0):
        grams += hashes[i:i + n] * factors[i]
    grams = mix(grams)
    out = []
    for a, b in zip(doc_words[:-1].tolist(), doc_words[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(grams[a:b - k + 1]))
        elif b > a:
            part = (hashes[a:b] * factors[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([part], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def concat(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)
