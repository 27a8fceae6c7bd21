"""Best-fit packing planned on the histogram of lengths.

1. Documents become token ids, then an end id; what is longer than a sequence is cut into pieces. Every piece gets
   its rank among the pieces of its length in its own task.
2. The histogram (at most ``size`` counts) is packed best-fit decreasing with whole runs of equal sequences: a step
   puts one piece of a length into each sequence of a run that has the least sufficient room. The plan has one row
   per step, whatever the number of documents.
3. Ranks within a length become global by adding the counts of earlier tasks (one row per task and length); a piece
   then takes the slot that the plan holds for its length and rank.

No window runs over the documents: a third of them may have one length. The driver sees the histogram and the plan.

Defined cases: a null or empty text is the end id alone; null and repeated doc_ids are carried as they are, each row
being a document of its own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadwright.llm import tools

SIZE, END_ID = 2048, 0
#: Bounds the word cache of a worker, about 200 bytes a word; a matter of speed only. A task of 16 MB of text can have 300,000 words,
#: and with a smaller cache most of them are gone when they come again.
CACHE_WORDS = 400_000
_TAIL = b".,;:!?%&$#*"
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves, the rest follow."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids, as bytes, of each run without ASCII white space.

    This vocabulary drops white space and never joins ids across it, so the ids of a text are those of its runs, one
    after the other. It starts a new piece between a letter or digit and following punctuation, so both parts of such
    a run are looked up on their own. Words of Latin letters go to the tokenizer's model without its normaliser and
    splitter, which for them only lower the case and write bytes as letters. All else takes the whole tokenizer.
    Tests compare whole texts with the tokenizer. Of the last looked up runs one to two times ``CACHE_WORDS`` are kept.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters, self.older = self.tokenizer.model, _byte_letters(), {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            core = word.rstrip(_TAIL)
            if core and len(core) < len(word) and core[-1:].isalnum():
                return self[core] + self[word[len(core):]]
            ids = self.ids(word)
            found = _packed(len(ids))(*ids)
        if len(self) >= CACHE_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found

    def ids(self, word: bytes) -> list[int]:
        if word.isalpha() and word.isascii():
            return [t.id for t in self.model.tokenize(word.decode().lower())]
        text = word.decode()
        if text.isalpha() and max(text) < "\u0180" and "\u0130" not in text:
            return [t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, text.lower().encode())))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids


@functools.lru_cache(256)
def _packed(n: int) -> Callable[..., bytes]:
    """Writes ``n`` ids as little-endian 32-bit numbers."""
    return struct.Struct(f"<{n}I").pack


_loaded: dict[str, WordIds] = {}


def token_pieces(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """One row per piece, with its rank (``place``) among the pieces of its length in this task (``part``)."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _loaded:
            _loaded[path] = WordIds(path)
        lookup, end = _loaded[path].__getitem__, np.array([END_ID], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.large_binary())
            rows, numbers, pieces, starts, lengths, sums, places = 0, [], [], [], [], [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                tokens = b"".join(map(lookup, text.split())) + end if text else end
                for piece, at in enumerate(range(0, len(tokens), 4 * size)):
                    part_ids = tokens[at:at + 4 * size]
                    length = len(part_ids) // 4
                    numbers.append(i), pieces.append(piece), starts.append(at // 4), lengths.append(length)
                    sums.append(zlib.crc32(part_ids)), places.append(seen[length])
                    seen[length] += 1
                    rows += 1
            yield pa.RecordBatch.from_arrays([
                ids.take(pa.array(numbers, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()), pa.array(sums, pa.int64()), pa.array([part] * rows, pa.int32()),
                pa.array(places, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _PIECES)


def plan_slots(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, first rank, next rank, first sequence, offset).

    The piece of rank r goes to sequence ``first sequence + r - first rank``.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by room: (first sequence, number of sequences)
    rooms: list[int] = []
    rows, sequences = [], 0

    def add(room: int, first: int, n: int) -> None:
        if not runs[room]:
            bisect.insort(rooms, room)
        runs[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, total = 0, histogram[length]
        while rank < total:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                n = -(-(total - rank) // (size // length))
                add(size, sequences, n)
                sequences += n
                continue
            room = rooms[at]
            first, n = runs[room].pop()
            if not runs[room]:
                rooms.pop(at)
            m = min(n, total - rank)
            rows.append((length, rank, rank + m, first, size - room))
            if m < n:
                add(room, first + m, n - m)
            if room > length:
                add(room - length, first, m)
            rank += m
    return rows


def pack(docs: DataFrame, size: int = SIZE, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: where each piece of each document goes."""
    pieces = tools.materialise(token_pieces(docs, size, path), "pieces")
    counts = pieces.groupBy("part", "length").agg((F.max("place") + 1).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = np.array(plan_slots(histogram, size), np.int64).reshape(-1, 5)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    keys = rows[:, 0] << np.int64(48) | rows[:, 1]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length << np.int64(48) | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(rows[at, 3] + rank - rows[at, 1]), pa.array(rows[at, 4])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
