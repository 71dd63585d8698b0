"""Runs of periodic words, found in tiles scaled to the period.

A run is a stretch of words with smallest period q, at least ``least`` words and ``copies`` times q
long, that no neighbour extends. Positions i with word i equal to word i+q form intervals; a run is
such an interval with q words more.

1. Periods fall into octaves [S, 2S). In a run of an octave every word comes again within 2S, but
   for the last q; so only stretches of such words, 3S and longer, are exploded into tiles, one
   set for each octave. Tiles hold boundaries S apart and overlap by the reach of these.
2. A tile is solved by itself. At a boundary, one Z-function over the words ahead and one over the
   words behind give, for every period of the octave at once, how far matches go both ways. A
   period whose unit is a power of a shorter one is left out.
3. The intervals of a document and period are shuffled together and stitched where they touch.

Documents without a stretch, nearly all of them, are done after the first step. Texts of the others
wait in the stored table for their runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railstream.llm.blocks import text_blocks
from railstream.llm.store import stored

LEAST = 6
COPIES = 4
BLOCK_BYTES = 1 << 20
# Boundaries of a tile, and the words they span at least.
BOUNDARIES = 8
TILE_WORDS = 512
# Tile words of one output batch.
BATCH_WORDS = 1 << 18

SPACES = r"[\x20\x09-\x0D]+"

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Block:
    """The words of a block of texts: bytes, borders, text of each, and exact numbers."""

    def __init__(self, texts: pa.LargeBinaryArray) -> None:
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
        data = texts.buffers()[2]
        self.raw = (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[
            offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.ink = ~_SPACE[self.raw]
        edge = np.zeros(len(self.raw) + 1, bool)
        edge[self.offsets] = True
        first, last = self.ink.copy(), self.ink.copy()
        if len(self.raw):
            first[1:] &= ~self.ink[:-1] | edge[1:-1]
            last[:-1] &= ~self.ink[1:] | edge[1:-1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(self.offsets, self.starts, "right") - 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)

    def words(self) -> pa.DictionaryArray:
        """The words, distinct ones listed once."""
        borders = np.empty(2 * len(self.starts) + 1, np.int64)
        borders[:-1:2], borders[1::2] = self.starts, self.ends
        borders[-1] = len(self.raw)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), 2 * len(self.starts),
            [None, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(self.raw))])
        return words.take(pa.array(np.arange(0, 2 * len(self.starts), 2))).dictionary_encode()

    def joined(self, kept: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The kept words of each text, joined by one space: all bytes, and the ends of texts."""
        words = np.flatnonzero(kept)
        glued = words[:-1][self.doc[words[:-1]] == self.doc[words[1:]]]
        keep = np.zeros(len(self.raw) + 1, np.int8)
        np.add.at(keep, self.starts[words], 1)
        np.add.at(keep, self.ends[words], -1)
        keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
        keep[self.ends[glued]] = True
        shown = self.raw.copy()
        shown[self.ends[glued]] = 0x20
        return shown[keep].tobytes(), np.concatenate([[0], np.cumsum(keep)])[self.offsets]


def stretches(numbers: np.ndarray, doc: np.ndarray, counts: np.ndarray,
              copies: int = COPIES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Octave, first words and ends of the stretches in which a run of the octave may lie."""
    if not len(numbers):
        return
    key = doc * (int(numbers.max()) + 1) + numbers
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), np.int64)
    same = key[order[1:]] == key[order[:-1]]
    # Words to the next occurrence in the text, 0 if there is none.
    again[order[:-1]] = np.where(same, order[1:] - order[:-1], 0)
    far = np.where(again > 0, np.frexp(np.maximum(again, 1))[1] - 1, 64)
    breaks, octave = np.arange(len(key)), 0
    while copies << octave <= counts.max():
        breaks = breaks[far[breaks] > octave]
        before = np.concatenate([[-1], breaks[:-1]])
        long = np.flatnonzero(breaks - before - 1 >= (copies - 1) << octave)
        if len(long):
            yield octave, before[long] + 1, breaks[long]
        octave += 1


def z_function(word: list[int]) -> list[int]:
    """For each place, how many words from there equal the beginning."""
    n = len(word)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        length = 0
        if i < right:
            length = z[i - left]
            if length < right - i:
                z[i] = length
                continue
            length = right - i
        while i + length < n and word[length] == word[i + length]:
            length += 1
        z[i] = length
        if i + length > right:
            left, right = i, i + length
    return z


def _power(period: int, z: list[int]) -> bool:
    """Whether the first ``period`` words are copies of a shorter unit, by their Z-function."""
    at = 1
    while at * at <= period:
        if period % at == 0:
            for part in (at, period // at):
                if part < period and part < len(z) and z[part] >= period - part:
                    return True
        at += 1
    return False


def solved(words: list[int], start: int, octave: int, first: int, last: int,
           most: int) -> list[tuple[int, int, int]]:
    """(period, begin, end) of the matches that cross the boundaries from ``first`` before ``last``.

    ``words`` are those of the tile, which begins at word ``start``; ``most`` is the longest period
    that fits. Intervals of a period that touch inside the tile come as one.
    """
    step = 1 << octave
    found: dict[int, list[list[int]]] = {}
    for boundary in range(first, last, step):
        c = boundary - start
        ahead = words[c:c + most + step + 1]
        longest = min(most, len(words) - c)
        if longest < step:
            continue
        z = z_function(ahead)
        behind = words[max(0, c - step):c][::-1]
        n = len(behind)
        back = z_function([*behind, -1, *words[c:c + longest][::-1]])
        for period in range(step, longest + 1):
            forward = z[period] if period < len(z) else 0
            backward = back[n + 1 + longest - period] if n else 0
            if (forward >= step or backward >= step) and not _power(period, z):
                begin, end = boundary - backward, boundary + forward
                parts = found.setdefault(period, [])
                if parts and begin <= parts[-1][1]:
                    parts[-1][1] = max(parts[-1][1], end)
                else:
                    parts.append([begin, end])
    return [(period, begin, end) for period, parts in found.items() for begin, end in parts]


_FOUND = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("text", pa.string()),
    ("collapsed", pa.string()), ("octave", pa.int32()), ("start", pa.int64()), ("first", pa.int64()),
    ("last", pa.int64()), ("most", pa.int32()), ("words", pa.binary())])
_FOUND_TYPE = ("row long, doc_id long, n_words long, text string, collapsed string, octave int, "
               "start long, first long, last long, most int, words binary")


def _batch(**columns) -> pa.RecordBatch:
    n = len(columns["row"])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _FOUND],
        schema=_FOUND)


def _tiles(block: Block, numbers: np.ndarray, octave: int, begin: int, end: int,
           copies: int) -> Iterator[dict]:
    """The tiles of one stretch, places counted in its text."""
    step, doc = 1 << octave, int(block.doc[begin])
    zero, beyond = int(block.bounds[doc]), int(block.bounds[doc + 1])
    most = min(2 * step - 1, max(step, (end - begin) // (copies - 1)))
    span = step * max(BOUNDARIES, TILE_WORDS // step)
    at = zero + -(-(begin - zero) // step) * step
    while at < end:
        upto = min(at + span, end)
        start, stop = max(begin, at - step), min(upto + 2 * most + step, beyond)
        yield {"doc": doc, "octave": octave, "start": start - zero, "first": at - zero,
               "last": upto - zero, "most": most,
               "words": numbers[start:stop].astype("<i4").tobytes()}
        at += span


def _shown(text: bytes, with_text: bool) -> str:
    return text.decode("utf-8") if with_text else hashlib.sha256(text).hexdigest()


def _exploded(copies: int, with_text: bool):
    """Rows of documents, done or with their text, and rows of tiles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows are numbered anew in every attempt; the stored table is of one attempt a task.
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch, texts in text_blocks(batches, "text", BLOCK_BYTES):
            block = Block(texts)
            numbers = np.asarray(block.words().indices)
            waits = np.zeros(len(texts), bool)
            held: list[dict] = []
            size = 0
            for octave, begins, ends in stretches(numbers, block.doc, block.counts, copies):
                for begin, end in zip(begins.tolist(), ends.tolist()):
                    for tile in _tiles(block, numbers, octave, begin, end, copies):
                        waits[tile["doc"]] = True
                        held.append(tile | {"row": row + tile["doc"]})
                        size += len(tile["words"]) // 4
                        if size >= BATCH_WORDS:
                            yield _batch(**{k: [t[k] for t in held] for k in held[0] if k != "doc"})
                            held, size = [], 0
            if held:
                yield _batch(**{k: [t[k] for t in held] for k in held[0] if k != "doc"})
            shown, at = block.joined(np.ones(len(block.starts), bool))
            words = [shown[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield _batch(
                row=row + np.arange(len(texts)), doc_id=batch.column("id"), n_words=block.counts,
                text=[w.decode("utf-8") if wait else None for w, wait in zip(words, waits.tolist())],
                collapsed=[None if wait else _shown(w, with_text)
                           for w, wait in zip(words, waits.tolist())])
            row += len(texts)
    return run


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = ("row", "octave", "start", "first", "last", "most")
        for row, *place, words in zip(*(batch.column(c).to_pylist() for c in names),
                                      batch.column("words")):
            octave, start, first, last, most = place
            found = solved(np.frombuffer(words.as_buffer(), "<i4").tolist(), start, octave, first,
                           last, most)
            if found:
                period, begin, end = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(found), pa.int64()),
                     *(pa.array(x, pa.int64()) for x in (period, begin, end))],
                    ["row", "period", "begin", "end"])


_RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def stitched(parts: DataFrame, least: int = LEAST, copies: int = COPIES) -> DataFrame:
    """``runs`` of each ``row``, by start and period, from intervals (row, period, begin, end)."""
    order = Window.partitionBy("row", "period").orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (parts.withColumn("apart", (F.col("begin") > F.coalesce(before, F.lit(-1))).cast("int"))
               .withColumn("island", F.sum("apart").over(
                   order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
               .groupBy("row", "period", "island")
               .agg(F.min("begin").alias("start"), F.max("end").alias("end")))
    length = F.col("end") - F.col("start") + F.col("period")
    return (islands.withColumn("length", length)
            .where((length >= least) & (length >= copies * F.col("period")))
            .groupBy("row")
            .agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
            .select("row", F.transform("runs", lambda r: F.struct(
                r["start"], r["length"], r["period"])).alias("runs")))


def _collapsed(with_text: bool):
    """Texts without the words that a run holds after its first period."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text", BLOCK_BYTES):
            block = Block(texts)
            drop = np.zeros(len(block.starts) + 1, np.int64)
            runs = batch.column("runs").to_pylist()
            for doc, found in enumerate(runs):
                for r in found or []:
                    drop[block.bounds[doc] + r["start"] + r["period"]] += 1
                    drop[block.bounds[doc] + r["start"] + r["length"]] -= 1
            shown, at = block.joined(np.cumsum(drop)[:-1] == 0)
            out = [_shown(shown[a:b], with_text) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), batch.column("runs"),
                 pa.array(out, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
    return run


def runs(docs: DataFrame, least: int = LEAST, copies: int = COPIES, id_col: str = "doc_id",
         text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row for each row: doc_id, n_words, runs (start, length, period; by start, then period)
    and what is left without repeated words: ``collapsed_sha256``, or ``collapsed`` itself.

    Words are separated by ASCII white space and joined by one space. Repeated rows and rows
    without an id are documents of their own; a missing or empty text has no words, no runs and an
    empty rest. An empty table gives no rows. Other columns are not read.
    """
    if copies < 2 or least < copies:
        raise ValueError("a run has two copies or more, and at least as many words as copies")
    parted = stored(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(_exploded(copies, with_text), _FOUND_TYPE), "periods")
    tiles = (parted.where(F.col("octave").isNotNull())
             .select("row", "octave", "start", "first", "last", "most", "words")
             # Small for the work they take: the count is given, so that they are not coalesced.
             .repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                          "row", "octave", "start"))
    found = stitched(tiles.mapInArrow(_solve, "row long, period long, begin long, end long"),
                     least, copies)
    rest = parted.where(F.col("octave").isNull())
    plain = rest.where(F.col("text").isNull()).select(
        "doc_id", "n_words", F.array().cast(_RUNS).alias("runs"), "collapsed")
    joined = (rest.where(F.col("text").isNotNull()).select("row", "doc_id", "n_words", "text")
              .join(found, "row", "left")
              .select("doc_id", "n_words", "text",
                      F.coalesce("runs", F.array().cast(_RUNS)).alias("runs"))
              .mapInArrow(_collapsed(with_text),
                          f"doc_id long, n_words long, runs {_RUNS}, collapsed string"))
    return plain.unionByName(joined).withColumnRenamed(
        "collapsed", "collapsed" if with_text else "collapsed_sha256")


def longest(found: str | Column) -> Column:
    """The longest run of a list, of those the one that starts first, then of shortest period."""
    found = F.col(found) if isinstance(found, str) else found
    best = F.array_max(F.transform(found, lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.struct((-best["start"]).alias("start"), best["length"].alias("length"),
                    (-best["period"]).alias("period"))
