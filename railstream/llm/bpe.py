"""BPE encoding and decoding through a table of distinct words.

1. Documents are gathered into chunks of bounded text, compressed, and dealt out by chunk.
2. Each chunk lists its distinct words under a local number. The lists are sorted by word across
   the cluster, so equal words of all chunks meet, and each distinct word is encoded once.
3. The ids go back to their chunk, where they replace the words position by position.

A key of the first shuffle is a word with one row for each chunk, not for each occurrence, so
frequent words weigh no more than rare ones. Decoding joins each id to its piece by position in
the vocabulary, a table whose size the tokenizer file fixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railstream.llm.blocks import text_blocks
from railstream.llm.wordsplit import load_tokenizer, tokenizer_path, words_of

CHUNK_BYTES = 24 << 20
# Rows of one task that are grouped by chunk before they go back.
RETURNED_ROWS = 1 << 20

_DOCS = pa.schema([("id", pa.int64()), ("text", pa.large_binary())])


def _packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _DOCS) as writer:
        for part in parts:
            writer.write_batch(part)
    payload = zstandard.ZstdCompressor(level=5).compress(sink.getvalue())
    return pa.RecordBatch.from_arrays(
        [pa.array([xxhash.xxh3_64_intdigest(payload) - (1 << 63)], pa.int64()),
         pa.array([payload], pa.binary())], ["chunk", "payload"])


def _chunks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch, texts in text_blocks(batches, "text"):
            # Copies only the rows of this slice.
            texts = pa.concat_arrays([texts])
            parts.append(pa.RecordBatch.from_arrays([batch.column("id"), texts], schema=_DOCS))
            size += pc.sum(pc.binary_length(texts)).as_py() or 0
            if size >= limit:
                yield _packed(parts)
                parts, size = [], 0
        if parts:
            yield _packed(parts)
    return run


def _opened(payload: pa.Scalar) -> Iterator[pa.RecordBatch]:
    data = zstandard.ZstdDecompressor().decompress(payload.as_buffer())
    with pa.ipc.open_stream(data) as reader:
        yield from reader


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chunk, number, word of each distinct word of each chunk, numbered as they first appear."""
    for batch in batches:
        for chunk, payload in zip(batch.column("chunk"), batch.column("payload")):
            runs: set[bytes] = set()
            words: dict[str, None] = {}
            for part in _opened(payload):
                for text in part.column("text").to_pylist():
                    for run in dict.fromkeys(text.split()):
                        if run not in runs:
                            runs.add(run)
                            words.update(dict.fromkeys(words_of(run)))
            del runs
            listed = pa.array(words, pa.string())
            for at in range(0, len(listed), 50_000):
                part = listed.slice(at, 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(chunk, len(part)), pa.array(range(at, at + len(part)), pa.int32()),
                     part], ["chunk", "number", "word"])


def _id_type(tokenizer) -> str:
    return "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def _encoded(path: str):
    """Ids of words that come in order; a word is encoded where it first appears.

    Ids of many words go back to their chunk in one row: word numbers, id counts, and the ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        kind = _id_type(tokenizer)
        pack = zstandard.ZstdCompressor(level=1).compress
        last, last_ids = None, b""
        chunks, numbers, ids, rows = [], [], [], 0

        def returned():
            chunk, number = np.concatenate(chunks), np.concatenate(numbers)
            every = pa.concat_arrays(ids)
            order = np.lexsort((number, chunk))
            chunk, number = chunk[order], number[order]
            bounds = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1], [True]]))
            for first, end in zip(bounds[:-1], bounds[1:]):
                part = every.take(pa.array(order[first:end]))
                counts = pc.divide(pc.binary_length(part), np.dtype(kind).itemsize).to_numpy()
                blob = pack(b"".join([np.uint32(end - first).tobytes(),
                                      np.diff(number[first:end], prepend=0).astype("<u4").tobytes(),
                                      counts.astype("<u4").tobytes(), *part.to_pylist()]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk[first]], pa.int64()), pa.array([blob], pa.binary())],
                    ["chunk", "coded"])

        for batch in batches:
            words = batch.column("word").dictionary_encode()
            distinct = words.dictionary.to_pylist()
            fresh = [last_ids] if distinct and distinct[0] == last else []
            rest = distinct[len(fresh):]
            for at in range(0, len(rest), 4096):
                fresh += [np.asarray(e.ids, kind).tobytes() for e in tokenizer.encode_batch_fast(
                    rest[at:at + 4096], add_special_tokens=False)]
            if distinct:
                last, last_ids = distinct[-1], fresh[-1]
            chunks.append(batch.column("chunk").to_numpy())
            numbers.append(batch.column("number").to_numpy())
            ids.append(pa.array(fresh, pa.binary()).take(words.indices))
            rows += batch.num_rows
            if rows >= RETURNED_ROWS:
                yield from returned()
                chunks, numbers, ids, rows = [], [], [], 0
        if rows:
            yield from returned()
    return run


def _by_number(blobs: pa.ChunkedArray, kind: str) -> list[bytes]:
    """Ids of a chunk's words, by word number."""
    unpack = zstandard.ZstdDecompressor().decompress
    found: dict[int, bytes] = {}
    width = np.dtype(kind).itemsize
    for blob in blobs:
        data = unpack(blob.as_buffer())
        n = int(np.frombuffer(data, "<u4", 1)[0])
        numbers = np.cumsum(np.frombuffer(data, "<u4", n, 4))
        counts = np.frombuffer(data, "<u4", n, 4 + 4 * n)
        at = 4 + 8 * n
        ends = at + width * np.cumsum(counts.astype(np.int64))
        for number, end in zip(numbers.tolist(), ends.tolist()):
            found[number] = data[at:end]
            at = end
    return [found[i] for i in range(len(found))]


def _pieces(tokenizer) -> pa.Array:
    """The id-to-piece table: piece of id i at place i."""
    return pa.array([tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())])


def _joined(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """Each list of ids with the ids joined to their pieces, as one text."""
    found = pa.ListArray.from_arrays(
        pc.subtract(lists.offsets, lists.offsets[0]), pieces.take(lists.flatten()),
        mask=lists.is_null() if lists.null_count else None)
    return pc.binary_join(found, " ")


def _placed(path: str, with_text: bool):
    """Ids of each document of a chunk, from the ids of the chunk's words."""
    names = ["doc_id", "ids", "text"] if with_text else ["doc_id", "ids"]

    def run(chunks: pa.Table, coded: pa.Table) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        kind = _id_type(tokenizer)
        pieces = _pieces(tokenizer) if with_text else None
        by_number = _by_number(coded["coded"], kind)
        for payload in chunks["payload"]:
            words: dict[str, bytes] = {}
            runs: dict[bytes, bytes] = {}
            for part in _opened(payload):
                out = []
                for text in part.column("text").to_pylist():
                    split = text.split()
                    for run in dict.fromkeys(split):
                        if run not in runs:
                            ids = []
                            for word in words_of(run):
                                if word not in words:
                                    words[word] = by_number[len(words)]
                                ids.append(words[word])
                            runs[run] = b"".join(ids)
                    out.append(b"".join(map(runs.__getitem__, split)))
                ends = np.zeros(len(out) + 1, np.int32)
                np.cumsum([len(c) // np.dtype(kind).itemsize for c in out], out=ends[1:])
                flat = np.frombuffer(b"".join(out), kind).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                columns = [part.column("id"), lists]
                yield pa.RecordBatch.from_arrays(
                    [*columns, _joined(lists, pieces)] if with_text else columns, names)

    return run


def encode(docs: DataFrame, path: str | None = None, chunk_bytes: int = CHUNK_BYTES,
           id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """doc_id and ids of each row, as the tokenizer gives without special tokens.

    ``with_text`` adds the decoded text in the same pass. Rows in, rows out, also with missing or
    repeated ids; a missing or empty text has no ids. An empty table gives no rows. Other columns
    are not read.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    chunks = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
              .mapInArrow(_chunks(chunk_bytes), "chunk long, payload binary")
              .repartition("chunk"))
    coded = (chunks.mapInArrow(_listed, "chunk long, number int, word string")
             .repartition("word").sortWithinPartitions("word")
             .mapInArrow(_encoded(path), "chunk long, coded binary"))
    place = _placed(path, with_text)

    def tables(chunk: pa.Table, words: pa.Table) -> pa.Table:
        return pa.Table.from_batches(place(chunk, words), schema)

    kinds = {"doc_id": pa.int64(), "ids": pa.list_(pa.int32())} | ({"text": pa.string()} if with_text else {})
    schema = pa.schema(kinds)
    return chunks.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(
        tables, "doc_id long, ids array<int>" + ", text string" * with_text)


def decode(coded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """The input with its ids replaced by ``text``: their pieces, joined as the tokenizer does.

    A missing list gives a missing text, an empty list an empty one.
    """
    path = path or tokenizer_path("word_bpe_49k.json")
    others = [c for c in coded.columns if c != ids_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in coded.schema
                       if f.name != ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(load_tokenizer(path))
        for batch in batches:
            # Bounded slices: the text of a list is longer than the list.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in others), _joined(part.column(ids_col), pieces)],
                    [*others, "text"])

    return coded.mapInArrow(run, f"{schema}, text string" if schema else "text string")
