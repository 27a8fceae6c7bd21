"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last ``window`` lines makes a line a boundary unless it is 0 modulo ``spread``. A boundary
depends on these lines alone and not on their place or on the text around them, so an insertion moves only the boundaries next to it.
From each boundary a chunk runs to the first later boundary with which it has ``min_chars`` characters, and to each boundary
one runs from the last earlier such boundary; both have two lines or more, and overlap. Every chunk is made of lines that it
holds itself, so a passage is covered from its first to its last boundary wherever it stands.

Chunks are grouped over the corpus by their own bytes; grouping on the text is the byte comparison. Of a chunk found in several documents the
one with the smallest doc_id keeps it, and there its first occurrence; all others lose it. A match then grows line by line to both sides, up to
the next boundary, as long as the lines equal those next to the keeper's chunk: what lies beyond that boundary belongs to chunks of
its own. So repeated passages go whole. A copy of every removed line is left in a document with a smaller doc_id, or further up in the same text.

Lines that are no boundary, one in ``spread``, cost recall only in very short passages: one of two lines is found where both lines are
boundaries (94 % at 32), one of three where two of them are (over 99 %), longer ones nearly always.

Defined cases: a null text stays null and an empty one empty; single lines are never removed; a row without
doc_id keeps everything that does not repeat inside it and takes no chunk from others; rows with the same
doc_id count as one document, each keeping its first occurrence; ties fall to the smaller doc_id; an empty
table gives an empty result; further columns are carried along and cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from leadwright.llm import tools

WINDOW, SPREAD, MIN_CHARS = 1, 32, 40
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def boundaries(lines: list[str], window: int = WINDOW, spread: int = SPREAD) -> list[int]:
    """Lines at which the rolling hash over them and the ``window`` - 1 lines before them is not 0 modulo ``spread``."""
    hashes = [zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in lines]
    out, rolled, leaving = [], 0, pow(_BASE, window, _PRIME)
    for i, h in enumerate(hashes):
        rolled = (rolled * _BASE + h + 1 - ((hashes[i - window] + 1) * leaving if i >= window else 0)) % _PRIME
        if i >= window - 1 and (rolled * 0x9E3779B97F4A7C15 >> 32) % spread:
            out.append(i)
    return out


def chunks(lines: list[str], window: int = WINDOW, spread: int = SPREAD, min_chars: int = MIN_CHARS) -> list[tuple[int, int, int, int]]:
    """(first, last, low, high): the lines of each chunk, and how far it may grow: to the boundaries around it."""
    marks = boundaries(lines, window, spread)
    ends = [0]
    for x in lines:
        ends.append(ends[-1] + len(x) + 1)
    starts = [m - window + 1 for m in marks]
    size = lambda i, j: ends[marks[j] + 1] - 1 - ends[starts[i]]
    long = lambda i, j: size(i, j) >= min_chars and marks[j] > starts[i]
    found, j = set(), 0
    for i in range(len(marks)):
        j = max(j, i)
        while j < len(marks) and not long(i, j):
            j += 1
        if j == len(marks):
            break
        found.add((i, j))
    i = 0
    for j in range(len(marks)):
        while i < j and long(i + 1, j):
            i += 1
        if long(i, j):
            found.add((i, j))
    return [(starts[i], marks[j], marks[i - 1] + 1 if i else 0, starts[j + 1] - 1 if j + 1 < len(marks) else len(lines) - 1)
            for i, j in sorted(found)]


def _key(part: str) -> bytes:
    return hashlib.blake2b(part.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _first_chunks(lines: list[str], options: tuple) -> dict[str, tuple[int, int, int, int]]:
    """The different chunks of a text, each with the place of its first occurrence."""
    out: dict = {}
    for place in chunks(lines, *options):
        out.setdefault("\n".join(lines[place[0]:place[1] + 1]), place)
    return out


def _chunk_rows(options: tuple, texts: bool):
    """doc_id and key of the different chunks of each document, with their text, or with the lines that stand next to them."""
    names = ["doc_id", "key", "text"] if texts else ["doc_id", "key", "before", "after"]
    kinds = [pa.binary(), pa.string()] if texts else [pa.binary(), pa.list_(pa.string()), pa.list_(pa.string())]

    def batch_of(doc_ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        ids = doc_ids.take(pa.array([r[0] for r in rows], pa.int64()))
        return pa.RecordBatch.from_arrays([ids, *(pa.array([r[c + 1] for r in rows], kind) for c, kind in enumerate(kinds))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, rows, size = batch.column("doc_id"), [], 0
            for at, text in enumerate(batch.column("text")):
                lines = (text.as_py() or "").split("\n")
                for part, (first, last, low, high) in _first_chunks(lines, options).items():
                    if texts:
                        rows.append((at, _key(part), part))
                    else:
                        rows.append((at, _key(part), lines[low:first], lines[last + 1:high + 1]))
                    size += len(part)
                if size > 4 << 20 or len(rows) > 50_000:
                    yield batch_of(doc_ids, rows)
                    rows, size = [], 0
            yield batch_of(doc_ids, rows)

    return run


def _grown(lines: list[str], place: tuple[int, int, int, int], before: list[str], after: list[str]) -> tuple[int, int]:
    """First and last line of a match, with the lines next to it that equal the last of ``before`` and the first of ``after``."""
    first, last, low, high = place
    for other in reversed(before):
        if first <= low or lines[first - 1] != other:
            break
        first -= 1
    for other in after:
        if last >= high or lines[last + 1] != other:
            break
        last += 1
    return first, last


def lines_left(lines: list[str], drops: dict[bytes, tuple[list[str], list[str]]], options: tuple = (WINDOW, SPREAD, MIN_CHARS)) -> list[bool]:
    """Which lines stay: those of no chunk in ``drops`` (key -> lines next to the keeper's) and of none that stands further up."""
    stays, seen = [True] * len(lines), {}
    for place in chunks(lines, *options):
        part = "\n".join(lines[place[0]:place[1] + 1])
        own = seen.setdefault(part, place)
        key = _key(part) if drops else b""
        if key in drops:
            first, last = _grown(lines, place, *drops[key])
        elif own[1] < place[0]:
            # The first occurrence keeps what it grows by, so growth ends between the two.
            first, last = _grown(lines, place, lines[own[2]:own[0]], lines[own[1] + 1:min(own[3] + 1, place[0])])
            first = max(first, own[1] + 1)
        else:
            continue
        stays[first:last + 1] = [False] * (last + 1 - first)
    return stays


def _shortened(options: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, drops in zip(batch.column("text"), batch.column("drops")):
                text = text.as_py()
                lines = (text or "").split("\n")
                stays = lines_left(lines, {d["key"]: (d["before"] or [], d["after"] or []) for d in drops.as_py() or ()}, options)
                runs = sum(not s and (i == 0 or stays[i - 1]) for i, s in enumerate(stays))
                texts.append(None if text is None else "\n".join(x for x, s in zip(lines, stays) if s))
                counts.append((len(lines), len(lines) - sum(stays), runs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3))],
                ["row", "text", "n_lines", "n_removed", "n_chunks_removed"])

    return run


def repeated_chunks(given: DataFrame, options: tuple) -> DataFrame:
    """key and keeper of the chunks that more than one document has, their bytes found equal.

    Every document gives a chunk once, so counts are numbers of documents; the sums form before the shuffle, which
    keeps a chunk of a third of all documents to one row per task. A key with two different texts (never seen) is left alone.
    """
    shape = StructType([given.schema["doc_id"], StructField("key", BinaryType()), StructField("text", StringType())])
    by_text = given.mapInArrow(_chunk_rows(options, True), shape).groupBy("text", "key").agg(
        F.count("*").alias("docs"), F.min("doc_id").alias("keeper"))
    by_key = by_text.groupBy("key").agg(F.count("*").alias("texts"), F.sum("docs").alias("docs"), F.min("keeper").alias("keeper"))
    return by_key.filter("docs > 1 AND texts = 1").select("key", "keeper")


def dedup(docs: DataFrame, window: int = WINDOW, spread: int = SPREAD, min_chars: int = MIN_CHARS, carry: list[str] | None = None) -> DataFrame:
    """Input rows as ``row`` (the columns ``carry``, or all) with ``text`` (what is left), ``n_lines``, ``n_removed`` (lines) and
    ``n_chunks_removed`` (runs of removed lines)."""
    options = (window, spread, min_chars)
    given = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    repeated = tools.materialise(repeated_chunks(given, options), "line-chunks")
    beside = ArrayType(StringType())
    shape = StructType([given.schema["doc_id"], StructField("key", BinaryType()), StructField("before", beside), StructField("after", beside)])
    places = tools.materialise(given.mapInArrow(_chunk_rows(options, False), shape).join(repeated, "key"), "line-places")
    # What stands next to the keeper's chunk, where anything may: few chunks have room to grow.
    sides = places.filter((F.col("doc_id") == F.col("keeper")) & ((F.size("before") > 0) | (F.size("after") > 0))).groupBy("key").agg(
        F.min(F.struct("before", "after")).alias("side"))
    drops = places.filter(F.col("doc_id") > F.col("keeper")).select("doc_id", "key").join(sides, "key", "left").groupBy("doc_id").agg(
        F.collect_set(F.struct("key", F.col("side.before").alias("before"), F.col("side.after").alias("after"))).alias("drops"))
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"), "doc_id",
                       F.col("text").cast("string").alias("text"))
    joined = base.join(drops, "doc_id", "left").select("row", "text", "drops")
    counts = [StructField(c, LongType()) for c in ("n_lines", "n_removed", "n_chunks_removed")]
    return joined.mapInArrow(_shortened(options), StructType([joined.schema["row"], StructField("text", StringType()), *counts]))
