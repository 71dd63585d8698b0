"""A Merkle manifest of a table, stored as aligned subtrees in van Emde Boas order.

Each source has a tree over its rows by id, and the roots of the sources, by name, have one more.
A tree is cut into aligned subtrees (blocks) of a fixed height. The nodes of a block lie in one
array: the upper half of its levels first, then each subtree below it, every part laid out alike.
``address`` finds a node from its depth and number by arithmetic alone; building a block and
reading the siblings of a leaf both go through it. The roots of the blocks are the leaves of the
next round, so there are as many rounds as the height of the largest tree over that of a block.

Rows find their place in a tree from a range partition by source and id, so a large source is
spread like any other. A task holds one block at a time. Paths come down the other way: each block
hands its children their siblings, joined by block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railstream.functions.slices import in_blocks, with_previous
from railstream.llm.store import stored

ARITY = 3
# Levels below the root of a block: 729 leaves.
HEIGHT = 6
DIGEST = 32

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<place: int, siblings: string>>"


def size_of(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(depth: int, number: np.ndarray, levels: int) -> np.ndarray:
    """Where nodes of a depth lie in the array of a complete tree, by their number from the left."""
    number = np.asarray(number, np.int64)
    at = np.zeros(number.shape, np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        below = ARITY ** (depth - upper)
        at += size_of(upper) + number // below * size_of(levels - upper)
        number = number % below
        depth, levels = depth - upper, levels - upper
    return at


def hashed(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def levels_of(leaves: int, first: bool, height: int) -> int:
    """Levels of a block. One that begins its tree and is not full is the whole tree, and ends
    with its root; any other has the height of all."""
    if not first or leaves >= ARITY ** height:
        return height + 1
    levels = 1
    while ARITY ** (levels - 1) < leaves:
        levels += 1
    return levels


def built(leaves: list[bytes], levels: int) -> np.ndarray:
    """The nodes of a block as rows of bytes; places without a node are zero."""
    nodes = np.zeros((size_of(levels), DIGEST), np.uint8)
    row = np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, DIGEST)
    for depth in range(levels - 1, -1, -1):
        nodes[address(depth, np.arange(len(row)), levels)] = row
        if depth:
            text = row.tobytes().hex()
            step = 2 * DIGEST * ARITY
            row = np.frombuffer(b"".join(
                hashlib.sha256(text[i:i + step].encode()).digest()
                for i in range(0, len(text), step)), np.uint8).reshape(-1, DIGEST)
    return nodes


def paths(nodes: np.ndarray, leaves: int, levels: int) -> list[list[tuple[int, str]]]:
    """For each leaf of a block its place among its siblings and their digests, upwards."""
    shown = [bytes(node).hex() for node in nodes]
    found: list[list[tuple[int, str]]] = [[] for _ in range(leaves)]
    count = leaves
    for depth in range(levels - 1, 0, -1):
        row = [shown[i] for i in address(depth, np.arange(count), levels).tolist()]
        below = ARITY ** (levels - 1 - depth)
        for number in range(count):
            start = number - number % ARITY
            step = (number % ARITY, "".join(row[start:number] + row[number + 1:start + ARITY]))
            for leaf in found[number * below:(number + 1) * below]:
                leaf.append(step)
        count = -(-count // ARITY)
    return found


def folded(digest: str, path: list[tuple[int, str]]) -> str:
    """The root that a leaf and the siblings on its path give."""
    for place, siblings in path:
        at = 2 * DIGEST * place
        digest = hashed(siblings[:at] + digest + siblings[at:])
    return digest


_BLOCK_TYPE = ("tree string, block long, doc_ids array<long>, leaves int, levels int, "
               "found array<binary>, nodes binary, top binary")
_BLOCK = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                    ("leaves", pa.int32()), ("levels", pa.int32()), ("found", pa.list_(pa.binary())),
                    ("nodes", pa.binary()), ("top", pa.binary())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _block_rows(height: int):
    """One row for each block, from rows that come by tree, block and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), rows in groupby(_rows(batches), lambda row: row[:2]):
            _, _, _, ids, leaves, found = zip(*rows)
            levels = levels_of(len(leaves), block == 0, height)
            nodes = built(leaves, levels)
            values = (tree, block, ids, len(leaves), levels, found, nodes.tobytes(), nodes[0].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], kind) for v, kind in zip(values, _BLOCK.types)], schema=_BLOCK)
    return run


def _rounds(rows: DataFrame, label: str, height: int) -> list[DataFrame]:
    """Stored blocks of all rounds, from rows of (tree, position, doc_id, leaf, found)."""
    rounds = []
    while True:
        ordered = (rows.select("tree", F.floor(F.col("position") / ARITY ** height).alias("block"),
                               "position", "doc_id", "leaf", "found")
                   .repartition("tree", "block").sortWithinPartitions("tree", "block", "position"))
        rounds.append(stored(ordered.mapInArrow(_block_rows(height), _BLOCK_TYPE), f"{label}-{len(rounds)}"))
        if not rounds[-1].agg(F.max("block")).first()[0]:
            return rounds
        rows = rounds[-1].select("tree", F.col("block").alias("position"),
                                 F.lit(None).cast("long").alias("doc_id"), F.col("top").alias("leaf"),
                                 F.lit(None).cast("binary").alias("found"))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``position`` of each row in its tree."""
    blocks = in_blocks(rows.withColumn("one", F.lit(1).cast("long")), ["tree"], order)
    return with_previous(blocks, ["tree"], order, weight="one").withColumnRenamed("_before", "position")


@dataclass
class Manifest:
    """Stored blocks, round by round, of the trees of the sources and of the tree over them."""

    sources: list[DataFrame]
    top: list[DataFrame]
    # Source and root of each leaf of the tree over the sources.
    places: DataFrame
    height: int


def leaf_of(fields: list[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 length, a colon and its value, or a dash."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"),
                                 f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def manifest(docs: DataFrame, found_text: Column | None = None, height: int = HEIGHT) -> Manifest:
    """Build and store the trees over the rows of ``docs``.

    ``found_text`` is what a later check finds as the text of a row (default: the same text); its
    leaf is kept beside the row's own. A missing id comes before all others, as does a missing
    source; rows that share source and id are ordered by their leaf, and repeated rows are leaves
    of their own. An empty table has trees without blocks. Other columns are not read.
    """
    own = leaf_of([F.col(c) for c in FIELDS])
    found = own
    if found_text is not None:
        other = leaf_of([*(F.col(c) for c in FIELDS[:-1]), found_text])
        found = F.when(found_text.eqNullSafe(F.col("text")), F.lit(None)).otherwise(other)
    rows = docs.select(
        # Orders a missing source before any other.
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), own.alias("leaf"), found.alias("found"))
    sources = _rounds(_placed(rows, ["doc_id", "leaf"]), "merkle", height)
    roots = sources[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"),
                               F.lit(None).cast("long").alias("doc_id"), F.col("top").alias("leaf"),
                               F.lit(None).cast("binary").alias("found"))
    placed = _placed(roots, ["source_tree"])
    places = stored(placed.select("tree", "position", "doc_id", "leaf", "found", "source_tree"), "roots")
    return Manifest(sources, _rounds(places, "merkle-top", height), places, height)


_CHILD_TYPE = f"tree string, block long, subroot string, root string, upper {_PATH}"


def _children(height: int):
    """For each leaf of a block, which is a block of the round below, its path to the root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
                upper = [(s["place"], s["siblings"]) for s in row["upper"] or []]
                steps = paths(nodes, row["leaves"], row["levels"])
                first = row["block"] * ARITY ** height
                out = {"tree": [row["tree"]] * len(steps),
                       "block": [first + i for i in range(len(steps))],
                       "subroot": [row["subroot"]] * len(steps), "root": [row["root"]] * len(steps),
                       "upper": [[{"place": p, "siblings": s} for p, s in own + upper] for own in steps]}
                yield pa.RecordBatch.from_pydict(out, schema=_CHILD)
    return run


_STEPS = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))
_CHILD = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.string()),
                    ("root", pa.string()), ("upper", _STEPS)])
_CHECKED_TYPE = (f"doc_id long, leaf string, subroot string, root string, proof {_PATH}, "
                 "proof_sha256 string, folded_root string, verified boolean")
_CHECKED = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
                      ("root", pa.string()), ("proof", _STEPS), ("proof_sha256", pa.string()),
                      ("folded_root", pa.string()), ("verified", pa.bool_())])


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
            at = address(row["levels"] - 1, np.arange(row["leaves"]), row["levels"]).tolist()
            upper = [(s["place"], s["siblings"]) for s in row["upper"]]
            out = {name: [] for name in _CHECKED.names}
            for i, own in enumerate(paths(nodes, row["leaves"], row["levels"])):
                leaf = bytes(nodes[at[i]]).hex()
                found = row["found"][i]
                path = own + upper
                fold = folded(leaf if found is None else found.hex(), path)
                values = (row["doc_ids"][i], leaf, row["subroot"], row["root"],
                          [{"place": p, "siblings": s} for p, s in path],
                          hashed("".join(s for _, s in path)), fold, fold == row["root"])
                for column, value in zip(out.values(), values):
                    column.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_CHECKED)


def checked(made: Manifest) -> DataFrame:
    """One row for each leaf: doc_id, leaf, subroot, root, proof (its place among its siblings and
    their digests, level by level), proof_sha256, folded_root (from the leaf as found and the
    stored siblings), verified."""
    no_path = F.lit(None).cast(_PATH)
    shown = F.lower(F.hex("top"))
    upper = made.top[-1].select("tree", "block", F.lit(None).cast("string").alias("subroot"),
                           shown.alias("root"), no_path.alias("upper"))
    for blocks in reversed(made.top):
        upper = (blocks.select("tree", "block", "leaves", "levels", "nodes")
                 .join(upper, ["tree", "block"]).mapInArrow(_children(made.height), _CHILD_TYPE))
    # A leaf of the top tree is the tree of a source.
    upper = upper.select(F.col("block").alias("position"), "root", "upper").join(
        made.places.select("position", F.col("source_tree").alias("tree"),
                      F.lower(F.hex("leaf")).alias("subroot")), "position").select(
        "tree", F.lit(0).cast("long").alias("block"), "subroot", "root", "upper")
    for blocks in reversed(made.sources[1:]):
        upper = (blocks.select("tree", "block", "leaves", "levels", "nodes")
                 .join(upper, ["tree", "block"]).mapInArrow(_children(made.height), _CHILD_TYPE))
    return (made.sources[0].select("tree", "block", "doc_ids", "leaves", "levels", "found", "nodes")
            .join(upper, ["tree", "block"]).mapInArrow(_checked, _CHECKED_TYPE))
