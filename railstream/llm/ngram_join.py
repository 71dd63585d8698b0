"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its connected documents.

A document is the set of its distinct word shingles, in one global order. If sets x and y link, they
have at least a = ceil(p (|x| + |y|) / (1 + p)) tokens in common, and for every l up to a, the first
|x| - a + l tokens of x and |y| - a + l of y share l tokens. A longer prefix meets more documents but
asks for more shared tokens. So each document picks its own l: the one with the least estimated
cost, from the lengths of the posting lists of its prefix tokens. A pair uses the larger l of
the two, and its own a: in a group of texts that nearly link, tokens of one text alone fill the
prefixes, and pairs of them are not even listed.

Rare tokens come first in the order. Shingles that come in many documents are found in one pass with
bounded summaries that merge, and only move a token's place; results do not depend on them.

Documents with the same set are one row from then on. A first round verifies each document against
the first document of its posting lists, which joins most groups; after it, pairs inside one
component are not looked at again, and every remaining pair that the prefixes allow is verified on
its whole texts. So no link between components is lost, and a group of n near copies needs about n
verifications, not n squared.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from railstream.llm.blocks import Words, bounds_of, mix, text_blocks
from railstream.llm.components import components
from railstream.llm.store import stored

WORDS = 4
PERCENT = 85
LEVELS = 6
# Bounds of the frequent-shingle summaries: entries kept in a task, sent by a task, and in all.
TASK_ENTRIES = 1 << 18
SENT_ENTRIES = 1 << 15
ALL_ENTRIES = 1 << 17
FREQUENT = 8
# Cost of verifying a pair, in posting-list entries: a fixed part and one for each shingle.
VERIFY_FIXED = 20
VERIFY_SHINGLE = 0.2
LEADERS = 2
FILTER_BITS = 24

_U = np.uint64


def _summed(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(tokens, kind="stable")
    tokens, counts = tokens[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else []
    return tokens[first], np.add.reduceat(counts, first) if len(tokens) else counts


def _largest(tokens: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(tokens) <= n:
        return tokens, counts
    keep = np.argpartition(counts, len(counts) - n)[-n:]
    return tokens[keep], counts[keep]


def frequent_shingles(docs: DataFrame, words: int = WORDS, text_col: str = "text") -> dict:
    """Shingles that come in many documents and about how many, as two arrays; bounded in size.

    Each task keeps the counts of the shingles seen most often so far, sends the largest ones,
    and the sums of what was sent are ranked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        fresh, size = [held[0]], 0
        def merged():
            new = np.concatenate(fresh)
            got = _summed(np.concatenate([held[0], new]),
                          np.concatenate([held[1], np.ones(len(new), np.int64)]))
            return _largest(*got, TASK_ENTRIES)
        for _, texts in text_blocks(batches, "text"):
            fresh.append(Words(texts, lower=True).shingles(words)[1])
            size += len(fresh[-1])
            if size > TASK_ENTRIES:
                held, fresh, size = merged(), [], 0
        tokens, counts = merged() if size else held
        some = counts > 1
        tokens, counts = _largest(tokens[some], counts[some], SENT_ENTRIES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens.view(np.int64)), pa.array(counts)], ["token", "n"])

    sent = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "token long, n long")
    ranked = (sent.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= FREQUENT)
              .orderBy(F.desc("n"), "token").limit(ALL_ENTRIES).toArrow())
    tokens = ranked["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return {"tokens": tokens[order], "counts": ranked["n"].to_numpy()[order]}


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of size n with any set it links to."""
    return -(-percent * n // 100)


def signatures(docs: DataFrame, frequent: dict, words: int = WORDS, percent: int = PERCENT,
               levels: int = LEVELS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, set size, 128-bit digest of the set, and the tokens of the longest prefix, in order."""
    known, counts = frequent["tokens"], frequent["counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "text"):
            docs_, tokens = Words(texts, lower=True).shingles(words)
            rank = np.zeros(len(tokens), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                rank = np.where(known[at] == tokens, counts[at], 0)
            order = np.lexsort((tokens, rank, docs_))
            tokens = tokens[order]
            bounds = bounds_of(docs_, batch.num_rows)
            sizes = np.diff(bounds)
            digests = []
            for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
                total = np.zeros(len(tokens) + 1, np.uint64)
                np.cumsum(mix(tokens ^ _U(salt)), out=total[1:])
                digests.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
            length = np.minimum(sizes, sizes - _needed(sizes, percent) + levels)
            place = np.arange(len(tokens)) - bounds[docs_]
            prefix = tokens[place < length[docs_]].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), *map(pa.array, digests),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix))],
                ["doc_id", "n", "d1", "d2", "prefix"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n long, d1 long, d2 long, prefix array<long>"))


def _common(n, m, percent: int):
    """Tokens that sets of sizes n and m need in common."""
    return F.ceil((n + m) * percent / (100 + percent))


def postings(sets: DataFrame) -> DataFrame:
    """(token, rep, n, place, leader) of the prefix tokens that two sets share at least.

    ``place`` is the token's place in the set's order, from 0, ``leader`` the token's first set.
    """
    flat = sets.select("rep", "n", F.posexplode("prefix").alias("place", "token"))
    token = Window.partitionBy("token")
    return (flat.withColumn("entries", F.count("*").over(token))
            .withColumn("leader", F.min(F.struct("rep", "n")).over(token))
            .filter("entries > 1").drop("entries"))


def chosen(rows: DataFrame, percent: int = PERCENT, levels: int = LEVELS) -> DataFrame:
    """Add ``l``, each set's choice, to posting-list entries (token, rep, n, place, component).

    For each l, a set meets the entries of other components that lie in prefixes of that length,
    its own and theirs; their number is exact but for the sizes, which are taken as equal. At
    most one l-th of them are documents met l times. Each costs one, each such document a check.
    """
    token, group, own = (Window.partitionBy(*c) for c in (("token",), ("token", "component"), ("rep",)))
    free = F.col("n") - _common(F.col("n"), F.col("n"), percent)
    cost = []
    for level in range(1, levels + 1):
        inside = F.col("place") < free + level
        rows = rows.withColumn(f"others_{level}", F.count_if(inside).over(token) - F.count_if(inside).over(group))
        met = F.sum(F.when(inside, F.col(f"others_{level}")).otherwise(0)).over(own)
        estimate = met + met / level * (VERIFY_FIXED + VERIFY_SHINGLE * F.col("n"))
        allowed = F.lit(level) <= F.ceil(F.col("n") * percent / 100)
        cost.append(F.struct(F.when(allowed, estimate).otherwise(float("inf")).alias("cost"),
                             F.lit(level).alias("l")))
    return rows.withColumn("l", F.least(*cost)["l"]).drop(*(f"others_{k}" for k in range(1, levels + 1)))


def _shingle_set(text: bytes, words: int) -> frozenset:
    """Shingles of one text, as bytes; the exact counterpart of ``Words.shingles``."""
    parts = text.translate(_ASCII_LOWER).split()
    if len(parts) < words:
        return frozenset([b" ".join(parts)] if parts else [])
    return frozenset(b" ".join(parts[i:i + words]) for i in range(len(parts) - words + 1))


_ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def active_texts(docs: DataFrame, used: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(rep, packed text) of the sets in ``used``.

    A bit map of the ids, of fixed size, keeps most other texts out of the shuffle; the join after
    it is exact.
    """
    slot = F.pmod(F.xxhash64("rep"), F.lit(1 << FILTER_BITS))
    # Bits are numbered from 1 in these functions.
    rows = (used.select((slot + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    bits = np.zeros(1 << FILTER_BITS, np.uint8)
    for row in rows:
        part = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        first = (row["bucket"] - 1) * len(part)
        bits[first:first + len(part)] |= part
    packed_bits = np.packbits(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.unpackbits(packed_bits).astype(bool)
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch, texts in text_blocks(batches, "text"):
            keep = np.flatnonzero(may[batch.column("slot").to_numpy()])
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep").take(pa.array(keep)),
                 pa.array([pack(texts[int(i)].as_py()) for i in keep], pa.binary())], ["rep", "packed"])

    read = (docs.filter(F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
            .select("rep", "text", slot.alias("slot")))
    return (read.mapInArrow(run, "rep long, packed binary").join(used, "rep", "left_semi")
            .dropDuplicates(["rep"]))


def verified(pairs: DataFrame, texts: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose whole texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        recent: OrderedDict[int, frozenset] = OrderedDict()

        def of(rep: int, packed: bytes) -> frozenset:
            if rep not in recent:
                recent[rep] = _shingle_set(unpack(packed), words)
                if len(recent) > 64:
                    recent.popitem(last=False)
            return recent[rep]

        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            good = []
            for row, (x, y) in enumerate(zip(a, b)):
                one = of(x, batch.column("packed_a")[row].as_py())
                two = of(y, batch.column("packed_b")[row].as_py())
                common = len(one & two)
                good.append(100 * common >= percent * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = texts.select(F.col("rep").alias("a"), F.col("packed").alias("packed_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("packed").alias("packed_b"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "packed_a", "packed_b")
            .mapInArrow(run, "a long, b long"))


def _sizes_allow(n, m, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def links_to_leaders(entries: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified links of each set with the leaders that it shares most tokens with."""
    votes = (entries.filter((F.col("rep") != F.col("leader.rep"))
                            & _sizes_allow(F.col("n"), F.col("leader.n"), percent))
             .groupBy(F.col("leader.rep").alias("a"), F.col("rep").alias("b")).agg(
                 F.count("*").alias("votes")))
    best = Window.partitionBy("b").orderBy(F.desc("votes"), "a")
    tried = votes.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= LEADERS)
    return verified(tried.select("a", "b"), texts, words, percent)


def links_between(entries: DataFrame, grouped: DataFrame, texts: DataFrame, words: int,
                  percent: int, levels: int) -> DataFrame:
    """All verified links between sets of different components."""
    token = Window.partitionBy("token")
    rows = (entries.join(grouped.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("component", F.coalesce("component", "rep"))
            .withColumn("low", F.min("component").over(token))
            .withColumn("high", F.max("component").over(token))
            .filter("low < high").select("token", "rep", "n", "place", "component"))
    rows = stored(chosen(rows, percent, levels), "mixed-postings")
    one, two = (rows.select("token", *(F.col(c).alias(f"{c}_{side}") for c in
                                       ("rep", "n", "place", "l", "component")))
                for side in ("a", "b"))
    least = F.greatest("l_a", "l_b")
    common = _common(F.col("n_a"), F.col("n_b"), percent)
    met = (one.join(two, "token")
           .filter((F.col("rep_a") < F.col("rep_b")) & (F.col("component_a") != F.col("component_b"))
                   & _sizes_allow(F.col("n_a"), F.col("n_b"), percent)
                   & (F.col("place_a") < F.col("n_a") - common + least)
                   & (F.col("place_b") < F.col("n_b") - common + least))
           .groupBy(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), least.alias("least"))
           .agg(F.count("*").alias("shared")).filter("shared >= least"))
    return verified(met.select("a", "b"), texts, words, percent)


def grouped_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT,
                      levels: int = LEVELS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (smallest linked doc_id) of each row.

    Texts without words have an empty set and link with nothing, also not with each other; a
    missing text is one of them. Repeated rows each have a row. Rows without an id get their size
    and no component. An id names one text: where rows of one id differ, one of the texts stands
    for the id when links are verified. Other columns are not read. An empty table gives no rows.
    """
    frequent = frequent_shingles(docs, words, text_col)
    signed = stored(signatures(docs, frequent, words, percent, levels, id_col, text_col), "signatures")
    sets = stored(signed.filter("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix")), "sets")
    entries = stored(postings(sets), "postings")
    used = entries.select("rep").distinct()
    texts = stored(active_texts(docs, used, id_col, text_col), "texts")
    near = stored(links_to_leaders(entries, texts, words, percent), "leader-links")
    first = components(near)
    rest = links_between(entries, first, texts, words, percent, levels)
    whole = components(near.unionByName(rest))
    groups = stored(sets.select("d1", "d2", F.col("n").alias("size"), "rep")
                    .join(whole.withColumnRenamed("node", "rep"), "rep", "left")
                    .select("d1", "d2", "size", F.coalesce("component", "rep").alias("component")),
                    "groups")
    same = ((signed["d1"] == groups["d1"]) & (signed["d2"] == groups["d2"])
            & (signed["n"] == groups["size"]))
    return (signed.drop("prefix").join(groups, same, "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(),
                           F.coalesce("component", "doc_id")).alias("component_id")))


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group left, that with the smallest id.

    Rows without an id stay, as do texts without words. Repeated rows of one id count as one.
    """
    named = grouped_documents(docs, words, percent, id_col=id_col, text_col=text_col)
    kept = stored(named.filter("doc_id = component_id").select("doc_id").distinct(), "kept-ids")
    row = Window.partitionBy(id_col).orderBy(id_col)
    return (docs.join(kept, docs[id_col] == kept["doc_id"], "left_semi")
            .withColumn("__row", F.row_number().over(row)).filter("__row = 1").drop("__row")
            .unionByName(docs.filter(F.col(id_col).isNull())))
