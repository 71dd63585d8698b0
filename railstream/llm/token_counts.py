"""Token counts of a unigram vocabulary by a Viterbi search that keeps counts only.

An Aho-Corasick automaton lists the pieces that end at each character, longest first. The search
carries the best score up to each character and the number of pieces on the way; no pieces are kept.
Ties go as in the tokenizer: a candidate replaces the best only if its score is higher, and pieces
that begin earlier come first. Characters without a piece of their own count as their UTF-8 bytes.

A whole text is counted as the tokenizer normalises it: one space mark before it and one for each
space; other white space stays and has pieces or bytes of its own. Where no piece of the vocabulary
reaches over the border, a text is cut before spaces and around tabs and line ends; each distinct
span is searched once in a worker, and counts are added. Words alone can be counted instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railstream.llm.blocks import text_blocks
from railstream.llm.wordsplit import tokenizer_path

SPACE_MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 300_000

# A carriage return is no border: pieces of program text end in it.
_SPAN = re.compile(rb"[\t-\x0c]+| +[^ \t-\x0c]*|[^ \t-\x0c]+")
# A piece that would reach over the border of two spans.
_CROSSING = re.compile(rf"[^{SPACE_MARK}]{SPACE_MARK}|.[\t-\x0c]|[\t-\x0c].", re.DOTALL)


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the pieces of words, or of the spans of whole texts, under one vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], whole: bool = False) -> None:
        self.one = self.span if whole else self.word
        self.cuts = not any(_CROSSING.search(piece) for piece, _ in pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[bytes, int] = {}

    def unit(self, text: str) -> int:
        """Pieces of one word that begins with the space mark."""
        n = len(text)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(text):
            found[last + 1].append(match)
        scores, counts = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            best, count, single = None, 0, False
            for length, score in sorted(found[end], reverse=True):
                start = end - length
                candidate = score + scores[start]
                single = single or length == 1
                if best is None or candidate > best:
                    best, count = candidate, counts[start] + 1
            if not single:
                candidate = self.unknown + scores[end - 1]
                if best is None or candidate > best:
                    best = candidate
                    count = counts[end - 1] + len(text[end - 1].encode("utf-8"))
            scores[end], counts[end] = best, count
        return counts[n]

    def word(self, word: bytes) -> int:
        """Pieces of one word without white space; a space mark inside begins another unit."""
        text = word.decode("utf-8")
        units = text.split(SPACE_MARK)
        first = [SPACE_MARK + units[0]] if units[0] else []
        return sum(map(self.unit, first + [SPACE_MARK + u for u in units[1:]]))

    def spans(self, text: bytes) -> list[bytes]:
        """A whole text, a space before it, in spans that no piece reaches over."""
        if not text:
            return []
        # A space mark in the text is a space to the tokenizer.
        text = b" " + text.replace(SPACE_MARK.encode("utf-8"), b" ")
        return _SPAN.findall(text) if self.cuts else [text]

    def span(self, span: bytes) -> int:
        """Pieces of one span, every space of it a space mark."""
        return self.unit(span.decode("utf-8").replace(" ", SPACE_MARK))

    def texts(self, texts: list[list[bytes]]) -> list[int]:
        """Pieces of each text, given its words or spans."""
        known = self.known
        new = {w: self.one(w) for w in set().union(*texts).difference(known)}
        if len(known) < CACHED_WORDS:
            known.update(new)
            new = {}
        return [sum(known[w] if w in known else new[w] for w in words) if new
                else sum(map(known.__getitem__, words)) for words in texts]


_LOADED: dict[tuple[str, bool], Counter] = {}


def counted(docs: DataFrame, path: str | None = None, id_col: str = "doc_id",
            text_col: str = "text", whole: bool = False) -> DataFrame:
    """doc_id, n_words, n_tokens of each row's text.

    With ``whole``, all of the text is counted, white space too; without, its words alone, each
    with a space mark before it. A missing or empty text has none of both. Repeated rows each have a row; an empty table gives
    no rows. Other columns are not read. ``path`` names a sentencepiece model file that every
    worker can open; its pieces and scores are the unigram vocabulary.
    """
    path = path or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, whole) not in _LOADED:
            _LOADED[path, whole] = Counter(vocabulary(path), whole)
        counter = _LOADED[path, whole]
        for batch, texts in text_blocks(batches, "text", 1 << 20):
            raw = texts.to_pylist()
            words = [t.split() for t in raw]
            parts = [counter.spans(t) for t in raw] if whole else words
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, words), pa.int64()),
                 pa.array(counter.texts(parts), pa.int64())],
                ["doc_id", "n_words", "n_tokens"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_tokens long"))
