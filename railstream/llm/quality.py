"""Quality rules whose cut-offs come from the data.

Each document's measures are taken once. Quantile summaries of them, mergeable across tasks, are
kept for every language and source, in two steps. The quartiles of a group set wide fences, which
leave out what is junk beyond doubt. The thresholds are then far quantiles of the rest of the group,
drawn towards those of its language the fewer rows it has, and widened a little. Two rules are
fixed: too few words, and too many repeated ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railstream.llm.blocks import Words, text_blocks
from railstream.llm.store import rejoined, stored

MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"

# Step 1: middle halves of its group that a measure may lie outside of it, and the least width that
# counts as a middle half.
FENCE = 6.0
LEAST_WIDTH = {"symbol_share": 0.02, "duplicate_share": 0.08, "word_length": 0.25, "repeat_share": 0.05}
MEASURES = tuple(LEAST_WIDTH)
# Step 2: the far quantile, the share of its distance from the median that is added, and an
# allowance for measures that hardly vary.
FAR = 0.998
WIDER = 0.25
ALLOWANCE = {"symbol_share": 0.02, "duplicate_share": 0.02, "word_length": 0.1, "repeat_share": 0.02}
# Rows for which a group counts as much as its language.
PRIOR_ROWS = 200
# Relative rank error of the summaries is the inverse of this.
ACCURACY = 2000

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def _repeated(words: Words) -> np.ndarray:
    """For each word, whether a window that comes twice in its document covers it."""
    at, value = words.windows(REPEAT_WINDOW)
    order = np.lexsort((value, words.doc[at]))
    docs, value = words.doc[at][order], value[order]
    same = (docs[1:] == docs[:-1]) & (value[1:] == value[:-1])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hits = at[order][twice]
    edges = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(edges, hits, 1)
    np.add.at(edges, hits + REPEAT_WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def measures(docs: DataFrame, text_col: str = "text", groups: tuple[str, ...] = ("lang", "source"),
             carry: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """Counts and measures of each row, its groups as text, and ``row`` with the columns to carry.

    ``with_text`` keeps the text beside them.

    Carried columns stay inside ``row``, so their names cannot clash with those made here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            words = Words(texts, lower=False)
            lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts.to_pylist()]
            counts = [
                words.counts, _sums(words.ink & ((words.raw & 0xC0) != 0x80), words.offsets),
                _sums(_SYMBOL[words.raw], words.offsets), [len(x) for x in lines],
                [len(x) - len(set(x)) for x in lines], _sums(_repeated(words), words.bounds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(c, pa.int64()) for c in counts],
                [*names, *_COUNTS])

    keys = [f"group_{i}" for i in range(len(groups))]
    names = ["row", *keys, *(["text"] if with_text else [])]
    read = [(F.struct(*carry) if carry else F.lit(0)).alias("row"), F.col(text_col).alias("text"),
            *(F.col(g).cast("string").alias(k) for g, k in zip(groups, keys))]
    docs = docs.select(read)
    schema = ", ".join([f"row {docs.schema['row'].dataType.simpleString()}",
                        *(f"{k} string" for k in names[1:]), *(f"{c} long" for c in _COUNTS)])
    words = F.greatest("n_words", F.lit(1))
    return (docs.mapInArrow(run, schema)
            .withColumns({
                "symbol_share": F.col("n_symbols") / words,
                "duplicate_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
                "word_length": F.col("word_chars") / words,
                "repeat_share": F.col("n_repeat_words") / words,
                "base_failed": (F.col("n_words") < MIN_WORDS) | (
                    100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))}))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join in which missing keys are equal; the keys come once."""
    right = right.withColumnsRenamed({k: f"other_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"other_{k}")) for k in keys]
    return left.join(right, on, how).drop(*(f"other_{k}" for k in keys))


def _inside(m: str) -> Column:
    return F.coalesce(F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(True))


def fences(measured: DataFrame, keys: list[str], fence: float = FENCE,
           accuracy: int = ACCURACY) -> DataFrame:
    """Step 1: lowest and highest value of each measure that is not junk beyond doubt, by group."""
    quartiles = measured.groupBy(*keys).agg(*(
        F.percentile_approx(m, [0.25, 0.75], accuracy).alias(m) for m in MEASURES))
    columns = [F.col(k) for k in keys]
    for m, least in LEAST_WIDTH.items():
        low, high = F.col(m)[0], F.col(m)[1]
        width = fence * F.greatest(high - low, F.lit(least))
        columns += [(low - width).alias(f"{m}_low"), (high + width).alias(f"{m}_high")]
    return quartiles.select(columns)


def _far(rows: DataFrame, keys: list[str], prefix: str, far: float, accuracy: int) -> DataFrame:
    """Rows, and low and high threshold of each measure, by group."""
    found = rows.groupBy(*keys).agg(F.count("*").alias(f"{prefix}rows"), *(
        F.percentile_approx(m, [1 - far, 0.5, far], accuracy).alias(m) for m in MEASURES))
    columns = [*keys, f"{prefix}rows"]
    for m in MEASURES:
        low, middle, high = (F.col(m)[i] for i in range(3))
        columns += [(low - WIDER * (middle - low)).alias(f"{prefix}{m}_low"),
                    (high + WIDER * (high - middle)).alias(f"{prefix}{m}_high")]
    return found.select(*columns)


def thresholds(measured: DataFrame, fence: float = FENCE, far: float = FAR,
               accuracy: int = ACCURACY, n_groups: int = 2) -> DataFrame:
    """Lowest and highest accepted value of each measure, for each group.

    ``measured`` is read three times, so it should be a stored table. Documents that fail a fixed
    rule do not count. Summaries are built in each task and merged, so a group with most of the
    rows costs no more than others. A group all of whose rows lie outside the fences has none.
    """
    keys = [f"group_{i}" for i in range(n_groups)]
    sound = measured.filter(~F.col("base_failed"))
    coarse = fences(sound, keys, fence, accuracy)
    inside = F.lit(True)
    for m in MEASURES:
        inside &= _inside(m)
    rest = _joined(sound, coarse, keys).filter(inside).select(*keys, *MEASURES)
    own = _far(rest, keys, "", far, accuracy)
    # The language of a group; with one grouping column, the whole corpus.
    upper = keys[:-1] or ["whole"]
    if not keys[:-1]:
        own, rest = own.withColumn("whole", F.lit(0)), rest.withColumn("whole", F.lit(0))
    above = _far(rest, upper, "all_", far, accuracy)
    both = _joined(own, above, upper)
    weight = F.col("rows") / (F.col("rows") + PRIOR_ROWS)
    columns = [F.col(k) for k in keys]
    for m, allowance in ALLOWANCE.items():
        for side, sign in (("low", -1), ("high", 1)):
            mixed = weight * F.col(f"{m}_{side}") + (1 - weight) * F.col(f"all_{m}_{side}")
            columns.append((mixed + sign * allowance).alias(f"{m}_{side}"))
    return both.select(columns)


def _judge(measured: DataFrame, limits: DataFrame, n_groups: int) -> DataFrame:
    keys = [f"group_{i}" for i in range(n_groups)]
    failed = F.filter(F.array(*(F.when(~_inside(m), F.lit(m)) for m in MEASURES)),
                      lambda m: m.isNotNull())
    return (_joined(measured, limits, keys, "left")
            .withColumn("failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))


def rejections(found: DataFrame) -> DataFrame:
    """How many rows each measure rejects of those that pass the fixed rules (``rejected``), how many
    by itself alone (``alone``), and the range of its thresholds over the groups."""
    sound = found.filter(~F.col("base_failed"))
    parts = [F.struct(
        F.lit(m).alias("measure"),
        F.count_if(F.array_contains("failed", m)).alias("rejected"),
        F.count_if(F.array_contains("failed", m) & (F.size("failed") == 1)).alias("alone"),
        *(f(f"{m}_{side}").alias(f"{name}_{side}") for side in ("low", "high")
          for name, f in (("least", F.min), ("most", F.max)))) for m in MEASURES]
    return sound.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def judged(docs: DataFrame, fence: float = FENCE, far: float = FAR, text_col: str = "text",
           groups: tuple[str, ...] = ("lang", "source"),
           carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row``, counts, measures, ``base_failed``, ``failed`` (measures beyond a threshold) and
    ``kept`` of each row.

    Missing languages and sources form groups of their own; a missing text has no words and fails.
    Repeated rows are judged alike. A group in which all documents fail a fixed rule has no
    thresholds and needs none. An empty table gives no rows.
    """
    measured = stored(measures(docs, text_col, groups, carry), "measures")
    limits = stored(thresholds(measured, fence, far, n_groups=len(groups)), "thresholds")
    return _judge(measured, limits, len(groups))


def passing(docs: DataFrame, fence: float = FENCE, far: float = FAR, text_col: str = "text",
            groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """The rows that pass, with the columns of ``docs``.

    Texts are measured twice, once for the thresholds and once with their rows, rather than
    joined back by id: ids may be missing or repeated.
    """
    measured = stored(measures(docs, text_col, groups, ()), "measures")
    limits = stored(thresholds(measured, fence, far, n_groups=len(groups)), "thresholds")
    others = tuple(c for c in docs.columns if c != text_col)
    rows = measures(docs, text_col, groups, others, with_text=True)
    return (_judge(rows, limits, len(groups)).filter("kept")
            .select(rejoined(docs.columns, text_col)))
