"""Harmonic packing of tokenized documents into sequences of fixed capacity.

A length in (C/(k+1), C/k] belongs to class k; a bin of that class takes exactly k pieces, whatever
they are. So a piece's bin follows from its number within the class alone: workers number their own
rows, one small table of counts gives each worker its first number, and no bin is ever searched.

Documents are cut where that saves padding: whole sequences first, then the largest C/k that fits,
until what is left fills its class but for ``slack``. At most k-1 pieces of each class remain
without a full bin; classes are few, so these leftovers are a fixed number whatever the input, and
are packed together by first fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railstream.llm.blocks import text_blocks
from railstream.llm.periods import Block
from railstream.llm.store import stored
from railstream.llm.wordsplit import is_plain, load_tokenizer, tokenizer_path, words_of

CAPACITY = 4096
END_ID = 2
SLACK = 0.02
LANES = 256
# Runs of text whose ids a worker process keeps; later ones are encoded again.
KEPT_RUNS = 400_000
# Fixed value: how the pieces that end a word end in the vocabulary.
WORD_END = "</w>"

PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "class int, lane int")


@lru_cache(maxsize=1 << 16)
def cut_remainder(length: int, capacity: int, slack: float) -> tuple[int, ...]:
    """Piece lengths of a document rest shorter than the capacity."""
    pieces = []
    while length:
        k = capacity // length
        full = capacity // k
        if full - length <= slack * full:
            pieces.append(length)
            break
        piece = capacity // (k + 1)
        pieces.append(piece)
        length -= piece
    return tuple(pieces)


def _offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _blobs(ids: np.ndarray, offsets: np.ndarray) -> pa.LargeBinaryArray:
    """Arrays of ids, cut at ``offsets`` of a flat one, as bytes."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(4 * offsets), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))])


class RunIds:
    """Ids of runs of text as little-endian 32-bit numbers, with those of many runs at hand."""

    def __init__(self, path: str) -> None:
        self.tokenizer = load_tokenizer(path)
        size = self.tokenizer.get_vocab_size()
        self.ends_word = np.array([(self.tokenizer.id_to_token(i) or "").endswith(WORD_END)
                                   for i in range(size)])
        self.places: dict[bytes, int] = {}
        self.ids = pa.array([], pa.large_binary())

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and id counts of plain words, many in one text; a mark ends each word's ids."""
        texts = [" ".join(words[at:at + 256]) for at in range(0, len(words), 256)]
        found = [np.asarray(e.ids, np.int64) for e in
                 self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.int64), *found])
        counts = np.diff(np.flatnonzero(self.ends_word[ids]) + 1, prepend=0)
        if len(counts) != len(words) or counts.sum() != len(ids):
            return self._alone(words)
        return ids, counts

    def _alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, counts.sum()), counts

    def _encoded(self, runs: list[bytes]) -> pa.LargeBinaryArray:
        """Each different word of the runs goes to the tokenizer once."""
        split = [[run.decode().lower()] if run.isalpha() else words_of(run) for run in runs]
        words = pa.array(list(chain.from_iterable(split)), pa.string()).dictionary_encode()
        distinct = words.dictionary.to_pylist()
        # Plain words hold no white space and no special token, and are lower-cased already.
        plain = np.fromiter((is_plain(w) for w in distinct), bool, len(distinct))
        parts = [self._together(words.dictionary.filter(pa.array(plain)).to_pylist()),
                 self._alone(words.dictionary.filter(pa.array(~plain)).to_pylist())]
        by_word = _blobs(*(np.concatenate(x) if i == 0 else _offsets(np.concatenate(x))
                           for i, x in enumerate(zip(*parts))))
        place = np.empty(len(distinct), np.int64)
        place[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(distinct))
        ids = pa.concat_arrays([by_word.take(pa.array(place)).take(words.indices)])
        ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1]
        bounds = _offsets(np.fromiter(map(len, split), np.int64, len(split)))
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(split),
            [None, pa.py_buffer(np.ascontiguousarray(ends[bounds])), ids.buffers()[2]])

    def of(self, runs: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Ids of each of some distinct runs. Runs beyond the bound are encoded again next time."""
        shown = runs.to_pylist()
        kept = len(self.places)
        at = np.fromiter((self.places.get(run, -1) for run in shown), np.int64, len(shown))
        missing = np.flatnonzero(at < 0)
        if not len(missing):
            return self.ids.take(pa.array(at))
        new = [shown[i] for i in missing.tolist()]
        ids = pa.concat_arrays([self.ids, self._encoded(new)])
        at[missing] = kept + np.arange(len(new))
        if kept < KEPT_RUNS:
            self.places.update(zip(new[:KEPT_RUNS - kept], range(kept, KEPT_RUNS)))
            self.ids = pa.concat_arrays([ids.slice(0, len(self.places))])
        return ids.take(pa.array(at))


_LOADED: dict[str, RunIds] = {}


def ids_of(path: str) -> RunIds:
    """The worker process's own copy for a tokenizer file."""
    if path not in _LOADED:
        _LOADED[path] = RunIds(path)
    return _LOADED[path]


def encoded(texts: pa.LargeBinaryArray, known: RunIds) -> Iterator[memoryview]:
    """The ids of each text."""
    block = Block(texts)
    runs = block.words()
    ids = pa.concat_arrays([known.of(runs.dictionary).take(runs.indices)])
    ends = np.frombuffer(ids.buffers()[1], np.int64)[:len(ids) + 1][block.bounds].tolist()
    data = memoryview(ids.buffers()[2] or b"")
    for first, end in zip(ends[:-1], ends[1:]):
        yield data[first:end]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, slack: float = SLACK,
           lanes: int = LANES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize each document, add the end id, and cut it; one row for each piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids_of(path)
        end = np.asarray([END_ID], "<u4").tobytes()
        for batch, texts in text_blocks(batches, "text", 4 << 20):
            out: list[list] = [[] for _ in range(7)]
            for doc, found in zip(batch.column("id").to_pylist(), encoded(texts, known)):
                ids = b"".join([found, end])
                total = len(ids) // 4
                lengths = [capacity] * (total // capacity)
                lengths += cut_remainder(total % capacity, capacity, slack)
                start = 0
                for length in lengths:
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    # Copies of a text differ in their ids, and so spread over the lanes.
                    lane = zlib.crc32(b"%d,%d,%d" % (crc, start, -1 if doc is None else doc)) % lanes
                    values = (doc, start, length, crc, total, capacity // length, lane)
                    for column, value in zip(out, values):
                        column.append(value)
                    start += length
            kinds = [pa.int64()] * 5 + [pa.int32()] * 2
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "lane"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, PIECE_SCHEMA))


def assigned(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset. ``cut`` is read twice, so it should be a stored table."""
    # At most (classes x lanes) rows, for any input.
    counts = cut.groupBy("class", "lane").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("class")
    before = by_class.orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    lanes = counts.select("class", "lane",
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lane_first"),
                          F.floor(F.sum("n").over(by_class) / F.col("class")).alias("bins"))
    # One row for each class; there are at most 2 * sqrt(capacity) of them.
    earlier = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    firsts = lanes.groupBy("class").agg(F.first("bins").alias("class_bins")).select(
        "class", F.coalesce(F.sum("class_bins").over(earlier), F.lit(0)).alias("class_first"),
        F.sum("class_bins").over(Window.partitionBy()).alias("all_bins"))
    lanes = lanes.join(F.broadcast(firsts), "class")
    own = Window.partitionBy("class", "lane").orderBy("doc_id", "start", "ids_crc32")
    numbered = (cut.withColumn("own", F.row_number().over(own) - 1)
                .join(F.broadcast(lanes), ["class", "lane"])
                .withColumn("number", F.col("lane_first") + F.col("own"))
                .withColumn("bin", F.floor(F.col("number") / F.col("class"))))
    ahead = (Window.partitionBy("sequence_id").orderBy("number")
             .rowsBetween(Window.unboundedPreceding, -1))
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = (numbered.filter(F.col("bin") < F.col("bins"))
             .withColumn("sequence_id", F.col("class_first") + F.col("bin"))
             .withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
             .select(*kept, "sequence_id", "offset"))
    left = (numbered.filter(F.col("bin") >= F.col("bins")).select(*kept, "all_bins")
            .groupBy("all_bins").applyInArrow(
                lambda rows: _first_fit(rows, capacity),
                "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                "sequence_id long, offset long"))
    return whole.unionByName(left)


def _first_fit(rows: pa.Table, capacity: int) -> pa.Table:
    """Pack the leftovers, long ones first, behind the whole bins. At most k-1 rows of each class."""
    rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
    first = rows["all_bins"][0].as_py()
    used = np.zeros(0, np.int64)
    bins, offsets = [], []
    for length in rows["length"].to_pylist():
        free = np.flatnonzero(used + length <= capacity)
        if not len(free):
            used = np.append(used, 0)
            free = [len(used) - 1]
        bins.append(first + int(free[0]))
        offsets.append(int(used[free[0]]))
        used[free[0]] += length
    return (rows.drop_columns("all_bins").append_column("sequence_id", pa.array(bins, pa.int64()))
            .append_column("offset", pa.array(offsets, pa.int64())))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, slack: float = SLACK,
         lanes: int = LANES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of the input is one document, also with a missing or repeated id; a missing or
    empty text has the end id alone. An empty table gives no rows. Other columns are not read.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    return assigned(stored(pieces(docs, path, capacity, slack, lanes, id_col, text_col), "pieces"),
                    capacity)
