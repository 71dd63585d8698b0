"""Periodic runs, SentencePiece by distinct words, Merkle manifests: each against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railstream.llm import merkle, periods, piece_table
from railstream.llm.queries import QUERIES
from railstream.llm.wordsplit import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def with_clashes(frame):
    """Columns whose names the operators use inside."""
    names = ("row", "runs", "start", "period", "chunk", "ids", "bucket", "tree", "leaf", "block",
             "position", "id", "_block", "_before", "found", "octave")
    return frame.withColumns({n: F.lit("x") for n in names})


# Runs

def brute_runs(words):
    numbers = {}
    x = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    out = []
    for q in range(1, len(x) // 4 + 1):
        edges = np.diff(np.concatenate([[0], x[:-q] == x[q:], [0]]).astype(int))
        for s, e in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            shorter = any(q % p == 0 and (x[s:s + q - p] == x[s + p:s + q]).all() for p in range(1, q))
            if e - s + q >= max(6, 4 * q) and not shorter:
                out.append((s, e - s + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def rest_of(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_text(seed, size=300):
    rng = random.Random(seed)
    kinds, words = rng.choice([1, 2, 3, 50]), []
    while len(words) < size:
        if rng.random() < 0.5:
            unit = [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(1, rng.choice([3, 10, 60])))]
            words += unit * rng.randint(1, 9) + unit[:rng.randrange(len(unit))]
        else:
            words += [f"w{rng.randrange(kinds)}" for _ in range(rng.randint(1, 20))]
    return rng.choice([" ", "\n", " \t"]).join(words)


def periodic_rows():
    long = " ".join(str(i % 701) for i in range(3200))
    texts = [None, "", " \n\t ", "one", "a " * 6, "a " * 5, "a b " * 4, "a b " * 3 + "a",
             "x " * 3000, long, f"{long} tail {long}", "é 字 é 字 é 字 é 字", "A a A a A a A a",
             *(periodic_text(i) for i in range(60))]
    rows = [(i, "s", "en", 1, t) for i, t in enumerate(texts)]
    return [*rows, rows[6], rows[6], (None, "s", "en", 1, "a b " * 9), (None,) * 5]


def test_runs(spark):
    docs = with_clashes(spark.createDataFrame(periodic_rows(), DOCS))
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed_sha256)
                 for r in periods.runs(docs).collect())
    want = []
    for doc, *_, text in periodic_rows():
        words = WORD.findall(text or "")
        found = brute_runs(words)
        want.append((str(doc), len(words), found, sha(rest_of(words, found))))
    assert got == sorted(want)
    assert sum(bool(runs) for _, _, runs, _ in got) > 50


def test_collapsed_text_and_other_limits(spark):
    docs = spark.createDataFrame([(1, "s", "en", 1, "a b a b  a c c\n"), (2, "s", "en", 1, "x y")], DOCS)
    got = {r.doc_id: (r.collapsed, [tuple(x) for x in r.runs])
           for r in periods.runs(docs, least=2, copies=2, with_text=True).collect()}
    assert got == {1: ("a b c", [(0, 5, 2), (5, 2, 1)]), 2: ("x y", [])}
    with pytest.raises(ValueError):
        periods.runs(docs, copies=1)


def test_runs_of_nothing(spark):
    assert periods.runs(spark.createDataFrame([], DOCS)).count() == 0


def test_tiles_overlap_and_are_bounded():
    """A run longer than a tile is cut into fragments that touch; no tile grows with the run."""
    texts = [" ".join(str(i % 97) for i in range(20_000))]
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1], pa.int64()), "text": texts})
    tiles = [t for out in periods._exploded(4, False)(iter([batch])) for t in out.to_pylist()
             if t["octave"] == 6]
    assert len(tiles) > 10 and max(len(t["words"]) for t in tiles) < 4 * 2000
    parts = sorted((begin, end) for t in tiles for period, begin, end in periods.solved(
        np.frombuffer(t["words"], "<i4").tolist(), t["start"], 6, t["first"], t["last"], t["most"])
        if period == 97)
    assert len(parts) > 10 and all(b[0] <= a[1] for a, b in zip(parts, parts[1:]))
    assert (parts[0][0], max(end for _, end in parts)) == (0, 20_000 - 97)


def planted(doc, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_period_query(spark, tmp_path):
    rows = [r for r in periodic_rows() if r[0] is not None]
    rows = [(100 * k + r[0], *r[1:]) for k in range(4) for r in rows[:40]]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_tiled_periods"](spark, str(tmp_path)).collect()}
    changed = 0
    for doc, *_, text in rows:
        words = planted(doc, text)
        changed += words != WORD.findall(text or "")
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        assert got[doc] == (
            doc, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(rest_of(words, runs)))
    assert changed > 5


# Pieces

def odd_texts():
    rng = random.Random(5)
    parts = ["a", "the", "Don't", "字", "é", "\U0001F600", " ", "  ", "     ", "\n", "\n\n", "\t", "▁", "▁▁",
             "\x00", "\r\n", "foo.bar", "12345", " ", "</s>", "<0x0A>", "é"]
    texts = ["", None, " ", "\n", "▁", "  x", "x  ", " ".join(["word"] * 3000), "z" * 4000]
    return texts + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(150)]


def test_pieces(spark):
    model = piece_table.load_model(tokenizer_path("piece_bpe_32k.model"))
    rows = [(i, "s", "en", 1, t) for i, t in enumerate(odd_texts())]
    rows += [rows[20], (None, None, None, None, "a b"), (None, None, None, None, None)]
    docs = with_clashes(spark.createDataFrame(rows, DOCS))
    coded = piece_table.encode(docs, chunk_bytes=500, with_text=True)
    got = sorted(((str(r.doc_id), list(r.ids), r.text) for r in coded.collect()))
    want = []
    for doc, *_, text in rows:
        ids = model.encode(text or "", add_eos=True)
        want.append((str(doc), ids, model.decode(ids)))
    assert got == sorted(want)


def test_piece_decoding(spark):
    model = piece_table.load_model(tokenizer_path("piece_bpe_32k.model"))
    lists = [model.encode(t, add_eos=True) for t in odd_texts() if t] + [[], [2], None, [1, 2]]
    frame = spark.createDataFrame(list(enumerate(lists)), "n int, ids array<int>")
    got = {r.n: r.text for r in piece_table.decode(frame).collect()}
    assert got == {n: None if ids is None else model.decode(ids) for n, ids in enumerate(lists)}


def test_whole_texts_where_pieces_cross_markers():
    model = piece_table.load_model(tokenizer_path("piece_bpe_32k.model"))
    texts = [t for t in odd_texts() if t]
    words, counts = piece_table.marked_words(pa.array([t.encode() for t in texts], pa.large_binary()), False)
    assert counts.tolist() == [1] * len(texts)
    found = piece_table.segmented(model, words.dictionary.to_pylist(), False)
    assert found.take(words.indices).to_pylist() == [model.encode(t) for t in texts]


def test_each_word_is_segmented_once():
    known = piece_table._Segmented(tokenizer_path("piece_bpe_32k.model"))
    first = known.of(pa.array([b" a", b" b", b" a"], pa.large_binary())).to_pylist()
    again = known.of(pa.array([b" b", b" c"], pa.large_binary())).to_pylist()
    assert first[0] == first[2] and again[0] == first[1] and len(known.words) == 3


def test_pieces_of_nothing(spark):
    assert piece_table.encode(spark.createDataFrame([], DOCS)).count() == 0


# Manifest

def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree_of(row):
    levels = [row]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return levels


def siblings(levels, i):
    for level in levels[:-1]:
        a = i - i % 3
        yield i - a, [x for j, x in enumerate(level[a:a + 3], a) if j != i]
        i //= 3


def brute_manifest(rows):
    def leaf(r):
        return sha("".join(map(field, r)))

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(((r[0] is not None, r[0] or 0), leaf(r), r) for r in groups[name])
        trees[name] = ordered, tree_of([x[1] for x in ordered])
    top = tree_of([trees[name][1][-1][0] for name in names])
    for n, name in enumerate(names):
        ordered, levels = trees[name]
        for i, (_, own, r) in enumerate(ordered):
            path = [*siblings(levels, i), *siblings(top, n)]
            fold = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                fold = leaf((*r[:4], r[4].replace("\n", "")))
            for place, others in path:
                fold = sha("".join([*others[:place], fold, *others[place:]]))
            yield (r[0], own, levels[-1][0], top[-1][0], sha("".join(x for _, o in path for x in o)),
                   fold, fold == top[-1][0])


def manifest_rows():
    rng = random.Random(1)
    rows = [(i if i % 17 else None, rng.choice(["a", "a", "a", "a", "b", "é", "c", None, ""]),
             None if i % 5 == 0 else "en", i if i % 3 else None,
             rng.choice([None, "", "x\ny", "abc", "\n", "é\n"])) for i in range(400)]
    return rows + rows[:20] + [(5000 + i, f"s{i}", "en", None, f"{i}\n") for i in range(30)]


@pytest.mark.parametrize("height,n", [(1, 430), (2, 450), (6, 450), (2, 1), (2, 4)])
def test_manifest(spark, height, n):
    rows = manifest_rows()[:n]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    found = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    made = merkle.manifest(with_clashes(spark.createDataFrame(rows, DOCS)), found, height)
    got = merkle.checked(made).select("doc_id", "leaf", "subroot", "root", "proof_sha256",
                                      "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_manifest(rows), key=str)
    if n > 400:
        assert {r.verified for r in got} == {True, False}
        assert len(made.sources) == {1: 5, 2: 3, 6: 1}[height]


def test_manifest_of_nothing(spark):
    made = merkle.manifest(spark.createDataFrame([], DOCS))
    assert merkle.checked(made).count() == 0


def test_unchanged_rows_fold_to_the_root(spark):
    made = merkle.manifest(spark.createDataFrame(manifest_rows(), DOCS))
    rows = merkle.checked(made).collect()
    assert all(r.verified for r in rows)
    assert all(merkle.folded(r.leaf, [tuple(s) for s in r.proof]) == r.root for r in rows)


@pytest.mark.parametrize("levels", range(1, 8))
def test_addresses_are_a_layout(levels):
    """Every node has a place of its own, and aligned subtrees are without gaps."""
    rows = [merkle.address(d, np.arange(3 ** d), levels) for d in range(levels)]
    assert sorted(np.concatenate(rows).tolist()) == list(range(merkle.size_of(levels)))
    upper = levels // 2
    if upper:
        for tree in range(3 ** upper):
            inside = np.concatenate([rows[d][tree * 3 ** (d - upper):(tree + 1) * 3 ** (d - upper)]
                                     for d in range(upper, levels)])
            assert np.ptp(inside) == len(inside) - 1
