"""Toxicity by compression distance.

Two zstandard dictionaries are trained on toxic and on ordinary text. Every text is cut into
overlapping windows, and each window is compressed with both; a window that the toxic dictionary
shortens more is suspect. The gains of a text's windows, against a threshold that few windows of
ordinary texts pass, become a score by a logistic fit on texts that the dictionaries have not seen.

Both dictionaries hold the same common words at the same distance from their end, so gains come
from the rest alone: the words that one class uses far more than the other. Words count once for
each different word before them, so a text with many copies counts as one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railstream.llm.blocks import text_blocks
from railstream.llm.store import rejoined

# Bound of the labelled sample that is collected for training, in texts of each class.
TOXIC_TEXTS = 2_500
ORDINARY_TEXTS = 5_000
FOLDS = 5

WINDOW = 64
STEP = 48
COMMON_BYTES = 96 << 10
CLASS_BYTES = 8 << 10
# A class word has this many different words before it, and this times the other class's share.
MIN_CONTEXTS = 3
MIN_RATIO = 8
# Share of ordinary windows beyond the window threshold.
WINDOW_TAIL = 0.001

_WORD = regex.compile(rb"[^\s\x21-\x40\x5b-\x60\x7b-\x7e]+")


def _contexts(texts: list[bytes]) -> dict[bytes, int]:
    """Number of different words that come before each word."""
    numbers: dict[bytes, int] = {b"": 0}
    seen = np.zeros(0, np.int64)
    for at in range(0, len(texts), 500):
        parts = [seen]
        for text in texts[at:at + 500]:
            words = np.array([0, *(numbers.setdefault(w, len(numbers)) for w in _WORD.findall(text))])
            parts.append(words[:-1] << 32 | words[1:])
        seen = np.unique(np.concatenate(parts))
    counts = np.bincount(seen & 0xFFFFFFFF, minlength=len(numbers))
    return dict(zip(numbers, counts.tolist()))


def _dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Toxic and ordinary dictionary content: class words, then the words common in ordinary text."""
    counts = _contexts(toxic), _contexts(ordinary)
    totals = [max(1, sum(c.values())) for c in counts]

    def own(mine: int, other: int) -> bytes:
        words = [w for w, n in counts[mine].items() if n >= MIN_CONTEXTS
                 and n * totals[other] >= MIN_RATIO * (counts[other].get(w, 0) + 1) * totals[mine]]
        words.sort(key=lambda w: (counts[mine][w], w))
        return b" ".join(words)[-CLASS_BYTES:]

    common = sorted(counts[1], key=lambda w: (counts[1][w], w))
    shared = b" ".join(common)[-COMMON_BYTES:]
    parts = own(0, 1), own(1, 0)
    width = max(map(len, parts))
    toxic_part, ordinary_part = (p.rjust(width, b"\0") for p in parts)
    return (b" ".join([toxic_part, shared, b""]), b" ".join([ordinary_part, shared, b""]))


class _Lengths:
    """Compressed lengths of windows under one dictionary."""

    def __init__(self, content: bytes) -> None:
        given = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        # The search tree has to hold every place of a dictionary, the class words at its start
        # too: 2^17 nodes take a chain_log of 18.
        setting = zstandard.ZstdCompressionParameters(
            compression_level=3, strategy=zstandard.STRATEGY_BTLAZY2, min_match=4, window_log=17,
            chain_log=18, hash_log=17, search_log=4,
            write_content_size=0, write_dict_id=0, write_checksum=0)
        given.precompute_compress(compression_params=setting)
        self.compressor = zstandard.ZstdCompressor(dict_data=given, compression_params=setting)

    def of(self, data: bytes, segments: np.ndarray) -> np.ndarray:
        sizes = []
        for at in range(0, len(segments), 20_000):
            part = zstandard.BufferWithSegments(data, segments[at:at + 20_000].tobytes())
            got = self.compressor.multi_compress_to_buffer(part, threads=1)
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
        return np.concatenate(sizes) if sizes else np.zeros(0, np.int64)


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offset, length) of the windows of texts that lie one after another, and windows of each.

    Every byte lies in a window; an empty text has none.
    """
    counts = np.where(sizes > 0, np.maximum(0, -(-(sizes - WINDOW) // STEP)) + 1, 0)
    first = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), counts)
    inner = (np.arange(len(text)) - (np.cumsum(counts) - counts)[text]) * STEP
    segments = np.stack([first[text] + inner, np.minimum(WINDOW, sizes[text] - inner)], 1)
    return segments.astype(np.uint64), counts


@dataclass
class Model:
    """Dictionaries, the window threshold, and the weights of a text's features."""

    toxic: bytes = b""
    ordinary: bytes = b""
    threshold: float = 0.0
    centre: np.ndarray = field(default_factory=lambda: np.zeros(4))
    spread: np.ndarray = field(default_factory=lambda: np.ones(4))
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 0, 0, 0, 0]))

    def gains(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Gain of every window, and the number of windows of each text."""
        if not hasattr(self, "_lengths"):
            self._lengths = _Lengths(self.ordinary), _Lengths(self.toxic)
        segments, counts = _windows(np.array([len(t) for t in texts], np.int64))
        data = b"".join(texts)
        plain, toxic = (lengths.of(data, segments) for lengths in self._lengths)
        return plain - toxic, counts

    def features(self, gains: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Largest gain, mean of the two largest, mean gain, share of windows over the threshold."""
        out = np.zeros((len(counts), 4))
        for row, part in enumerate(np.split(gains, np.cumsum(counts)[:-1])):
            if len(part):
                top = np.sort(part)[::-1]
                out[row] = top[0], top[:2].mean(), top.mean(), (part > self.threshold).mean()
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not self.toxic:
            return np.full(len(texts), 1 / (1 + np.exp(-self.weights[0])))
        scaled = (self.features(*self.gains(texts)) - self.centre) / self.spread
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + scaled @ self.weights[1:], -30, 30)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_lengths"}


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Weights, the constant first, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty @ weights
        bend = (x * (p * (1 - p))[:, None]).T @ x + penalty
        weights -= np.linalg.solve(bend + 1e-9 * np.eye(len(bend)), slope)
    return weights


def fit(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    """Dictionaries from two thirds of the texts; threshold and weights from the other third.

    The fewer texts, the fewer class words are found; without any, every score is low.
    """
    contents = _dictionaries([t for i, t in enumerate(toxic) if i % 3],
                             [t for i, t in enumerate(ordinary) if i % 3])
    if contents[0] == contents[1]:
        return Model()
    model = Model(*contents)
    rest = [ordinary[::3], toxic[::3]]
    measured = [model.gains(texts) for texts in rest]
    model.threshold = float(np.quantile(measured[0][0], 1 - WINDOW_TAIL)) if len(measured[0][0]) else 0.0
    x = np.concatenate([model.features(*m) for m in measured])
    y = np.repeat([0.0, 1.0], [len(texts) for texts in rest])
    model.centre, model.spread = x.mean(0), x.std(0) + 1e-9
    model.weights = _logistic((x - model.centre) / model.spread, y)
    return model


def _plain(texts: pa.Array) -> list[bytes]:
    return [t.decode("utf-8").lower().encode("utf-8") for t in texts.to_pylist()]


def in_fold(doc_id: str, folds: int = FOLDS):
    """Whether a document is held out from learning."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          toxic_texts: int = TOXIC_TEXTS, ordinary_texts: int = ORDINARY_TEXTS) -> Model:
    """Fit on a bounded sample of labelled texts, none of them held out.

    The sample is drawn from ``labels`` by a hash of the id, so it is the same in every run; its
    bound is ``toxic_texts + ordinary_texts``, whatever the size of the tables.
    """
    known = labels.filter(~in_fold(id_col) & F.col("toxic").isNotNull()).select(
        F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    order = F.xxhash64("id", F.lit(7)), F.col("id")
    drawn = (known.filter("toxic = 1").orderBy(*order).limit(toxic_texts)
             .unionAll(known.filter("toxic = 0").orderBy(*order).limit(ordinary_texts)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = (texts.filter("text is not null").join(F.broadcast(drawn), "id")
             .select("id", "text", "toxic").toArrow().sort_by("id"))
    sides = [found.filter(pc.equal(found["toxic"], side))["text"] for side in (1, 0)]
    return fit(*(_plain(side.cast(pa.large_binary())) for side in sides))


def score(docs: DataFrame, model: Model, text_col: str = "text",
          carry: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """``row`` with the columns to carry, the score of each row's whole text, and the text if asked.

    A missing text scores as an empty one. Repeated rows score alike; an empty table gives no
    rows. Carried columns stay inside ``row``, so their names cannot clash with ``score``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(model.scores(_plain(texts)), pa.float64())],
                [*kept, "score"])

    kept = ["row", "text"] if with_text else ["row"]
    docs = docs.select((F.struct(*carry) if carry else F.lit(0)).alias("row"),
                       F.col(text_col).alias("text"))
    return docs.mapInArrow(run, f"row {docs.schema['row'].dataType.simpleString()}, "
                                + "text string, " * with_text + "score double")


def accepted(docs: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose score is below ``limit``, with the columns of ``docs``."""
    others = tuple(c for c in docs.columns if c != text_col)
    scored = score(docs, model, text_col, others, with_text=True)
    return scored.filter(F.col("score") < limit).select(rejoined(docs.columns, text_col))
