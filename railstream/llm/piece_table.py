"""SentencePiece encoding and decoding through a table of distinct marked words.

A marked word is a run of whitespace markers with what follows it up to the next marker; runs of
newlines stand by themselves. Where no piece of the vocabulary holds a marker after another
character, and none but its byte piece holds a newline, no merge crosses such a border, so each
distinct marked word is segmented once:

1. Documents are gathered into chunks of bounded text. A chunk lists its distinct marked words and
   keeps, for every position, the number of its word.
2. The lists are dealt out by a hash of the word, so that equal words of all chunks meet in one
   bucket, where each is segmented once.
3. The ids go back to their chunk and replace the numbers position by position.

A bucket holds a word once for each chunk, not for each occurrence, and buckets grow in number with
the shuffle partitions, so frequent words weigh no more than rare ones. Decoding joins ids to pieces by position in the vocabulary, whose size the model file fixes.
A vocabulary with pieces across markers makes each whole text one word; results are the same.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railstream.llm.blocks import text_blocks
from railstream.llm.wordsplit import tokenizer_path

CHUNK_BYTES = 16 << 20
BLOCK_BYTES = 4 << 20
# Words of a bucket that are segmented at a time.
HELD_WORDS = 1 << 18
# Buckets of distinct words for each shuffle partition.
BUCKETS = 8

MARKER = "▁"
_MARKER = MARKER.encode()


@cache
def load_model(path: str):
    """The worker process's own processor of a model file."""
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=path)


@cache
def cuts_at_markers(path: str) -> bool:
    """Whether no piece can cross the border of a marked word or touch a newline.

    The white space of a text must also reach the pieces unchanged.
    """
    model = load_model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_byte(i)]
    if any(MARKER in p.lstrip(MARKER) or "\n" in p for p in pieces):
        return False
    return model.normalize(" \n  a \n b ") == f"{MARKER * 2}\n{MARKER * 2}a{MARKER}\n{MARKER}b{MARKER}"


def packed(*parts: np.ndarray, tail: bytes | memoryview = b"") -> bytes:
    """Arrays of whole numbers below 2^32, byte plane by byte plane, and a tail, compressed."""
    sizes = np.asarray([len(parts), *map(len, parts)], "<i8").tobytes()
    planes = [np.ascontiguousarray(p, "<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for p in parts]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([sizes, *planes, tail]))


def unpacked(blob: pa.Buffer) -> tuple[list[np.ndarray], bytes]:
    """The arrays given to ``packed``, and the tail."""
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", n, 8).tolist()
    at, out = 8 + 8 * n, []
    for size in sizes:
        planes = np.frombuffer(data, np.uint8, 4 * size, at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 4 * size
    return out, data[at:]


def marked_words(texts: pa.LargeBinaryArray, cut: bool) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The marked words of each text one after another, and their number by text.

    The model puts one marker before a text that is not empty, so a space is put there.
    """
    filled = pc.greater(pc.binary_length(texts), 0)
    space, nothing = (pa.scalar(x, pa.large_binary()) for x in (b" ", b""))
    texts = pa.concat_arrays([
        pc.if_else(filled, pc.binary_join_element_wise(space, texts, nothing), nothing)])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[:len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    raw = np.frombuffer(data, np.uint8)[:offsets[-1]]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    if cut and len(raw):
        # 0: other, 1: marker, 2: newline.
        kind = (raw == 0x20).astype(np.uint8)
        if len(raw) > 2:
            at = np.flatnonzero(raw[:-2] == _MARKER[0])
            at = at[(raw[at + 1] == _MARKER[1]) & (raw[at + 2] == _MARKER[2])]
            kind[at] = kind[at + 1] = kind[at + 2] = 1
        kind[raw == 0x0A] = 2
        turn = kind[1:] != kind[:-1]
        turn &= ~((kind[:-1] == 1) & (kind[1:] == 0))
        border[1:-1] |= turn
    border[-1] = True
    at = np.flatnonzero(border).astype(np.int64)
    if not len(raw):
        at = np.zeros(1, np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), data])
    return words.dictionary_encode(), np.diff(np.searchsorted(at, offsets))


def _values(words: pa.Array) -> tuple[np.ndarray, bytes]:
    """Lengths and bytes of an array of words."""
    words = pa.concat_arrays([words.cast(pa.large_binary())])
    return (np.asarray(pc.binary_length(words)),
            words.buffers()[2].to_pybytes()[:pc.sum(pc.binary_length(words)).as_py() or 0]
            if words.buffers()[2] else b"")


def _array(lengths: np.ndarray, data: bytes) -> pa.LargeBinaryArray:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


class _Chunk:
    """Documents of bounded text as word numbers, and their distinct words."""

    def __init__(self) -> None:
        self.docs, self.coded, self.counts, self.size = [], [], [], 0

    def add(self, docs: pa.Array, texts: pa.LargeBinaryArray, cut: bool) -> None:
        words, counts = marked_words(texts, cut)
        self.docs.append(pa.concat_arrays([docs]))
        self.coded.append(words)
        self.counts.append(counts)
        self.size += pc.sum(pc.binary_length(texts)).as_py() or 0

    def close(self) -> None:
        words = pa.chunked_array(self.coded).unify_dictionaries()
        self.words = words.chunk(0).dictionary
        self.numbers = np.concatenate([np.asarray(part.indices) for part in words.chunks])
        self.ids = pa.concat_arrays(self.docs)
        counts = np.concatenate(self.counts)
        digest = xxhash.xxh3_64(np.ascontiguousarray(counts))
        digest.update(np.ascontiguousarray(self.numbers))
        digest.update(np.ascontiguousarray(self.ids.fill_null(-1)))
        self.name = digest.intdigest() - (1 << 63)
        self.counts = counts

    def positions(self) -> pa.RecordBatch:
        """One row: document ids, words of each document, number of the word at each position."""
        return pa.RecordBatch.from_arrays(
            [pa.array([self.name], pa.int64()), pa.ListArray.from_arrays([0, len(self.ids)], self.ids),
             pa.array([packed(self.counts, self.numbers)], pa.binary())], ["chunk", "docs", "payload"])

    def listed(self, buckets: int) -> pa.RecordBatch:
        """The distinct words with their numbers, one row for each bucket."""
        bucket = np.fromiter(map(zlib.crc32, self.words.to_pylist()), np.int64, len(self.words)) % buckets
        order = np.argsort(bucket, kind="stable")
        lengths, data = _values(self.words.take(pa.array(order)))
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.array([self.name] * len(spans), pa.int64()),
             pa.array([bucket[order[a]] for a, _ in spans], pa.int32()),
             pa.array([packed(np.diff(order[a:b], prepend=0), lengths[a:b], tail=data[ends[a]:ends[b]])
                       for a, b in spans], pa.binary())], ["chunk", "bucket", "listed"])


def _chunks(path: str, limit: int, buckets: int | None = None):
    """The positions of each chunk or, with a number of buckets, its words.

    Both come from a pass of their own over the texts, which costs less than to shuffle the words
    along with the positions. Chunks are cut alike and named by their content in either pass.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, chunk = cuts_at_markers(path), _Chunk()

        def row() -> pa.RecordBatch:
            chunk.close()
            return chunk.listed(buckets) if buckets else chunk.positions()

        for batch, texts in text_blocks(batches, "text", min(BLOCK_BYTES, limit)):
            chunk.add(batch.column("id"), texts, cut)
            if chunk.size >= limit:
                yield row()
                chunk = _Chunk()
        if chunk.docs:
            yield row()
    return run


def segmented(model, words: list[bytes], cut: bool) -> pa.ListArray:
    """Ids of marked words, by the model itself.

    A newline in front keeps the model from putting a marker there; its two ids are cut off.
    Whole texts have the marker already, as a space that the model would add itself.
    """
    front = "\n" if cut else ""
    texts = [front + w.decode("utf-8")[0 if cut else 1:] for w in words]
    first = len(model.encode(front))
    found = [ids[first:] for ids in model.encode(texts, num_threads=1)] if texts else []
    ends = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(ids) for ids in found], out=ends[1:])
    flat = np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


class _Segmented:
    """The distinct words of one bucket and their ids."""

    def __init__(self, path: str) -> None:
        self.model, self.cut = load_model(path), cuts_at_markers(path)
        self.clear()

    def clear(self) -> None:
        self.words = pa.array([], pa.large_binary())
        self.ids = pa.array([], pa.list_(pa.int32()))

    def of(self, words: pa.LargeBinaryArray) -> pa.ListArray:
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        new = distinct.filter(pc.invert(pc.is_in(distinct, value_set=self.words)))
        if len(new):
            self.words = pa.concat_arrays([self.words, new])
            self.ids = pa.concat_arrays([self.ids, segmented(self.model, new.to_pylist(), self.cut)])
        return self.ids.take(pc.index_in(distinct, value_set=self.words)).take(coded.indices)


def _segments(path: str):
    """Ids of the words of each row; rows come by bucket, and a word is segmented once in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Segmented(path)
        bucket, rows, held = None, [], 0

        def returned() -> pa.RecordBatch:
            ids = known.of(pa.concat_arrays([_array(lengths, data) for _, _, lengths, data in rows]))
            at, blobs = 0, []
            for _, numbers, lengths, _ in rows:
                part = ids.slice(at, len(lengths))
                blobs.append(packed(numbers, np.asarray(pc.list_value_length(part)),
                                    np.asarray(part.flatten())))
                at += len(lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk for chunk, *_ in rows], pa.int64()), pa.array(blobs, pa.binary())],
                ["chunk", "coded"])

        for batch in batches:
            for chunk, home, listed in zip(batch.column("chunk").to_pylist(),
                                           batch.column("bucket").to_pylist(), batch.column("listed")):
                if rows and (home != bucket or held >= HELD_WORDS):
                    yield returned()
                    rows, held = [], 0
                if home != bucket:
                    known.clear()
                    bucket = home
                (numbers, lengths), data = unpacked(listed.as_buffer())
                rows.append((chunk, numbers, lengths, data))
                held += len(lengths)
        if rows:
            yield returned()
    return run


def _pieces(model) -> pa.Array:
    """The id-to-piece table: the bytes of id i at place i, none for control ids."""
    def shown(i: int) -> bytes:
        if model.is_control(i):
            return b""
        piece = model.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace(MARKER, " ").encode()
    return pa.array([shown(i) for i in range(model.get_piece_size())], pa.large_binary())


def _joined(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """Each list of ids with the ids joined to their pieces, without the marker before the text."""
    bounds = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    shown = pa.concat_arrays([pieces.take(lists.flatten())])
    ends = np.frombuffer(shown.buffers()[1], np.int64)[:len(shown) + 1]
    texts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lists), [None, pa.py_buffer(np.ascontiguousarray(ends[bounds])),
                                        shown.buffers()[2] or pa.py_buffer(b"")])
    marked = np.asarray(pc.starts_with(texts, " "))
    # The bytes are one after another; a marker left out moves the start of its text only.
    spans = np.stack([ends[bounds[:-1]] + marked, ends[bounds[1:]]], 1).ravel()
    spans = np.append(spans, spans[-1:] if len(spans) else 0)
    texts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), 2 * len(lists), [None, pa.py_buffer(spans), texts.buffers()[2]]).take(
            pa.array(np.arange(0, 2 * len(lists), 2)))
    if lists.null_count:
        texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.large_binary()))
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        # Ids that no text has: stray byte pieces.
        return pa.array([t if t is None else t.decode("utf-8", "replace") for t in texts.to_pylist()],
                        pa.string())


def _placed(path: str, schema: pa.Schema):
    """Ids of each document of a chunk, from the ids of the chunk's words."""
    def run(chunks: pa.Table, coded: pa.Table) -> pa.Table:
        model = load_model(path)
        pieces = _pieces(model) if "text" in schema.names else None
        parts = [unpacked(blob.as_buffer())[0] for blob in coded["coded"]]
        number = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(p[0], dtype=np.int64) for p in parts)])
        lists = [pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(p[1])]).astype(np.int32)),
            pa.array(p[2].astype(np.int32))) for p in parts]
        end_id = pa.ListArray.from_arrays([0, 1], pa.array([model.eos_id()], pa.int32()))
        # Ids by word number, and the end id as one word more.
        order = np.concatenate([np.argsort(number, kind="stable"), [len(number)]])
        by_number = pa.concat_arrays([*lists, end_id]).take(pa.array(order))
        sizes = np.asarray(pc.list_value_length(by_number))
        out = []
        for docs, payload in zip(chunks["docs"], chunks["payload"]):
            (counts, words), _ = unpacked(payload.as_buffer())
            ends = np.cumsum(counts, dtype=np.int64)
            if len(number) != (int(words.max()) + 1 if len(words) else 0):
                raise ValueError("documents differed between two reads; store them first")
            words = np.insert(words.view("<i4"), ends, len(number))
            bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
            offsets = np.concatenate([[0], np.cumsum(sizes[words], dtype=np.int32)])[bounds].astype(np.int32)
            ids = by_number.take(pa.array(words)).flatten()
            found = pa.ListArray.from_arrays(pa.array(offsets), ids)
            columns = [docs.values, found] + ([_joined(found, pieces)] if pieces is not None else [])
            out.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(out, schema)
    return run


def encode(docs: DataFrame, path: str | None = None, chunk_bytes: int = CHUNK_BYTES,
           id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id and ids of each row, as the model gives them with its end id and no other.

    ``with_text`` adds the decoded text in the same pass. Rows in, rows out, also with missing or
    repeated ids; a missing or empty text has the end id alone. An empty table gives no rows.
    Other columns are not read. ``docs`` is read twice and must give the same rows in the same order,
    as a stored table does; what comes from a shuffle is to be stored first.
    """
    path = path or tokenizer_path("piece_bpe_32k.model")
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chunks = rows.mapInArrow(_chunks(path, chunk_bytes), "chunk long, docs array<long>, payload binary")
    coded = (rows.mapInArrow(_chunks(path, chunk_bytes, buckets), "chunk long, bucket int, listed binary")
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_segments(path), "chunk long, coded binary"))
    kinds = {"doc_id": pa.int64(), "ids": pa.list_(pa.int32())} | ({"text": pa.string()} if with_text else {})
    return (chunks.groupBy("chunk").cogroup(coded.groupBy("chunk"))
            .applyInArrow(_placed(path, pa.schema(kinds)),
                          "doc_id long, ids array<int>" + ", text string" * with_text))


def decode(coded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """The input with its ids replaced by ``text``, as the model decodes them.

    A missing list gives a missing text; an empty one, or control ids alone, an empty text.
    """
    path = path or tokenizer_path("piece_bpe_32k.model")
    others = [c for c in coded.columns if c != ids_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema
                       if f.name != ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(load_model(path))
        for batch in batches:
            # Bounded slices: the text of a list is longer than the list.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), _joined(part.column(ids_col), pieces)],
                    [*others, "text"])

    return coded.mapInArrow(run, f"{schema}, text string" if schema else "text string")
