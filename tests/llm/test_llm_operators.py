"""Each operator against a brute-force version, on small fixtures with the awkward cases."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from railstream.llm import (
    bpe,
    chat,
    ngram_join,
    packing,
    permutation_index,
    quality,
    secrets,
    sharding,
    token_counts,
    toxicity,
)
from railstream.llm.components import components
from railstream.llm.wordsplit import load_tokenizer, tokenizer_path, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abdehinorst") for _ in range(rng.randint(1, 8)))
                    for _ in range(n))


def awkward():
    """Nulls in every column, empty and long texts, ties, repeated rows, odd characters."""
    long = prose(1, 6000)
    base = prose(2, 120)
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", None, "a", 7),
        (4, "one", "en", None, 3), (5, "One", "en", "a", 3), (6, "one two three", "en", "a", 13),
        (7, long, "en", "a", 1), (8, long.upper(), "de", "b", 1), (9, long + " tail", "en", "a", 1),
        (10, base, "fr", "b", 1), (11, base + " x", "fr", "b", 1), (12, "x " + base, "fr", "b", 1),
        (13, base, "fr", "b", 1), (13, base, "fr", "b", 1),
        (14, "é ÀB c <|endoftext|>z 字́ 'S don't 12", "en", "a", 1),
        (None, base, None, None, None), (None, None, None, None, None),
    ]
    rows += [(20 + i, prose(50 + i, 30 + 7 * i), "en", "abc"[i % 3], 1) for i in range(25)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    # Columns whose names the operators use inside.
    return spark.createDataFrame(awkward(), DOCS).withColumns(
        {"score": F.lit("x"), "row": F.lit(1), "n": F.lit(2), "component": F.lit(3), "rep": F.lit(4),
         "kept": F.lit(5), "size": F.lit(6), "slot": F.lit(7), "token": F.lit(8)})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, k):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def brute_groups(rows, k, percent):
    sets = {}
    for i, text, *_ in rows:
        if i is not None:
            sets[i] = shingles(text, k)
    group = {i: i for i in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= percent * len(sets[a] | sets[b]):
            one, two = sorted((root(a), root(b)))
            group[two] = one
    return sets, {i: root(i) for i in sets}


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_jaccard_join(docs, k, percent):
    sets, groups = brute_groups(awkward(), k, percent)
    got = ngram_join.grouped_documents(docs, k, percent).collect()
    assert len(got) == len(awkward())
    for row in got:
        if row.doc_id is None:
            assert row.component_id is None
        else:
            assert (row.n_shingles, row.component_id) == (len(sets[row.doc_id]), groups[row.doc_id])


def chain(n):
    """Texts of which only neighbours link, copies of one, and passages that many share."""
    words = prose(3, 200).split()
    rows = []
    for i in range(n):
        changed = list(words)
        for j in range(i):
            changed[j * 7 % len(words)] = f"w{j}"
        rows.append((i + 1, " ".join(changed), "en", "a", 1))
    shared = prose(4, 60)
    rows += [(100 + i, f"{shared} {prose(200 + i, 60)}", "en", "a", 1) for i in range(40)]
    rows += [(200 + i, rows[0][1], "en", "a", 1) for i in range(30)]
    return rows


def test_jaccard_join_of_chains_and_shared_passages(spark):
    rows = chain(30)
    _, groups = brute_groups(rows, 4, 85)
    got = {r.doc_id: r.component_id for r in
           ngram_join.grouped_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == groups and 1 < len(set(groups.values())) < len(rows)


def test_longer_prefixes_ask_for_more_matches(spark):
    rows = spark.createDataFrame(chain(12), DOCS)
    nowhere = {"tokens": np.zeros(0, np.uint64), "counts": np.zeros(0, np.int64)}
    sets = (ngram_join.signatures(rows, nowhere).groupBy("d1", "d2", "n")
            .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix")))
    rows = ngram_join.postings(sets).withColumn("component", F.col("rep"))
    entries = ngram_join.chosen(rows).toPandas()
    assert entries["l"].max() > 1 and entries["l"].min() >= 1
    # Sets that link share l tokens in their l-prefixes, for every l.
    tokens = {rep: part for rep, part in entries.groupby("rep")}
    full = {i: shingles(t, 4) for i, t, *_ in chain(12)}
    for a, b in combinations(tokens, 2):
        common = len(full[a] & full[b])
        if 100 * common >= 85 * len(full[a] | full[b]):
            needed = -(-85 * (len(full[a]) + len(full[b])) // 185)
            for level in range(1, ngram_join.LEVELS + 1):
                x, y = (set(tokens[i].token[tokens[i].place < len(full[i]) - needed + level])
                        for i in (a, b))
                assert len(x & y) >= level


def test_one_of_each_group(docs, nothing):
    _, groups = brute_groups(awkward(), 5, 80)
    got = ngram_join.one_of_each(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(groups.values()))
    assert ids.count(None) == 2
    assert ngram_join.one_of_each(nothing).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    rng = random.Random(0)
    edges = [(b, a) if rng.random() < .5 else (a, b) for a, b in path + star] + [(7, 7), (5, 6)]
    got = {r.node: r.component for r in
           components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    return load_tokenizer(tokenizer_path("word_bpe_49k.json"))


def test_bpe_round(docs, tokenizer, nothing):
    rows = sorted(((i, t or "") for i, t, *_ in awkward()), key=str)
    expected = sorted((str(i), tokenizer.encode(t, add_special_tokens=False).ids) for i, t in rows)
    coded = bpe.encode(docs, chunk_bytes=20_000)
    assert sorted((str(r.doc_id), r.ids) for r in coded.collect()) == expected
    texts = sorted((str(r.doc_id), r.text) for r in bpe.decode(coded).collect())
    both = sorted((str(r.doc_id), r.text) for r in bpe.encode(docs, with_text=True).collect())
    assert texts == both == sorted(
        (i, tokenizer.decode(ids, skip_special_tokens=False)) for i, ids in expected)
    assert bpe.encode(nothing).count() == 0


def test_words_encode_alone_as_in_their_text(tokenizer):
    signs = "aAbB'sSéÉİŉſßΣσς \t\n\x0b\x0c\r\x1c\x85\xa0́<|>1२!.-_字😀ǅ"
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 12)))
        text += rng.choice(["", "<|endoftext|>", "<|startoftext|>x"])
        alone = [i for run in text.encode().split() for w in words_of(run)
                 for i in tokenizer.encode(w, add_special_tokens=False).ids]
        assert alone == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_decode_missing_and_empty_lists(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [3306, 1002])], "k int, ids array<int>")
    got = {r.k: r.text for r in bpe.decode(rows).collect()}
    assert got == {1: None, 2: "", 3: "hello</w> world</w>"}


def test_perspectives(spark):
    turns = [(1, 1, "ann", "hi <|im_end|>"), (1, 0, "system", "be kind"), (1, 2, "bob", None),
             (1, 3, "ann", "é!"), (2, 0, "system", "alone"), (None, 0, "eve", "x"),
             (1, None, None, "first"), (3, 700, "ann", "late"), (3, 2, "ann", "twice"),
             (3, 2, "ann", "twice")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    frame = frame.withColumn("part", F.lit("own")).withColumn("said", F.lit(1))
    got = {(r.conv_id, r.perspective, r.part): r for r in chat.perspectives(frame).collect()}
    assert {k[:2] for k in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "eve"), (3, "ann")}
    ann = got[1, "ann", 0]
    assert ann.rendered == ("<|im_start|>system\nbe kind<|im_end|>\n"
                            "<|im_start|>assistant\nhi < |im_end|><|im_end|>\n"
                            "<|im_start|>user name=bob\n<|im_end|>\n"
                            "<|im_start|>assistant\né!<|im_end|>\n")
    said = [ann.rendered[int(a):int(b)] for a, b in (s.split(":") for s in ann.mask.split(","))]
    assert said == ["hi < |im_end|><|im_end|>", "é!<|im_end|>"]
    assert got[1, "unknown", -1].rendered == "<|im_start|>assistant\nfirst<|im_end|>\n"
    assert got[3, "ann", 0].n_turns == 2 and got[3, "ann", 2].n_turns == 1
    assert chat.perspectives(frame.limit(0)).count() == 0


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


@pytest.mark.parametrize("text,base,every", [
    ("xx token=abcdefg yy", ["assign:3:16"], ["assign:3:16"]),
    ("token=abc", [], []),
    ("A PassWord : \"hunter22\" é", ["assign:2:22"], ["assign:2:22"]),
    ("AKIA" + "A" * 16, ["access:0:20"], ["access:0:20"]),
    ("AKIA" + "A" * 15, [], []),
    ("x" + "ab" * 12 + "G" + "c" * 23, ["hex:1:25"], ["hex:1:25"]),
    ("é password%3Dabcdefgh w", [], ["assign:2:21"]),
    ("é \\u0074oken=abcdefgh", [], ["assign:2:21"]),
    ("q " + b64("password: hunter22x") + " z", [], ["assign:2:30"]),
    ("k=" + b64(b64("api_key=1234567")), [], ["assign:2:30"]),
    ("%25252525", [], []),
])
def test_secret_layers(text, base, every):
    own, found, unread = secrets.scan(text)
    assert [s.text() for s in own] == base and [s.text() for s in found] == every and not unread


def test_compressed_layers_cycles_and_bombs():
    inner = b64(zlib.compress(gzip.compress(b"my secret = zzzzzzz")))
    text = f"a {inner} b"
    assert [s.text() for s in secrets.scan(text)[1]] == [f"assign:2:{2 + len(inner)}"]
    bomb = b64(gzip.compress(b"a" * 100_000))
    assert secrets.scan(bomb, limit=1000)[2] == 1
    assert secrets.masked("x token=abcdefg y", secrets.scan("x token=abcdefg y")[1]) == "x [SECRET] y"


def compressors():
    import bz2
    import lzma

    import zstandard
    return gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress


def test_layers_that_are_not_plain_ascii_or_not_aligned():
    for odd in ("\xa0", "\u3000", "\u200b", "\xad", "\ufeff", "\x0c", "\x00"):
        run = b64(f"le {odd} secret=abcdefgh é")
        assert [s.text() for s in secrets.scan("q " + run)[1]] == [f"assign:2:{2 + len(run)}"]
    run = b64(b"\xff\xfe token=abcdefgh \xff")
    assert [s.text() for s in secrets.scan(run)[1]] == [f"assign:0:{len(run)}"]
    for data in (b"token=abcdefgh", gzip.compress(b"token=abcdefgh")):
        run = b64(data)
        for path in ("https://h.io/v1/", "https://h.io/v12/", "https://h.io/v/a/b/"):
            assert [s.text() for s in secrets.scan(path + run)[1]] == [
                f"assign:{len(path)}:{len(path + run)}"], path
        for letters in ("a", "ab", "abc", "abcd"):
            found = secrets.scan(letters + run)[1]
            assert found and found[0].start <= len(letters) and found[0].end == len(letters + run)
    assert secrets.scan("%FF%74oken%3Dabcdefgh")[1] and secrets.scan("%74oken%3Dabcdefgh%C3")[1]


def test_all_members_of_compressed_runs():
    for pack in compressors():
        for data in (pack(b"a") + pack(b"token=abcdefgh"), pack(b"tok") + pack(b"en=abcdefgh"),
                     pack(b"a") + b"??" + pack(b"token=abcdefgh") + b"\0\0"):
            run = b64(data)
            assert {s.end for s in secrets.scan(run)[1]} == {len(run)}


def test_runs_beyond_the_limit_are_read_and_masked(spark):
    for pack in compressors():
        run = b64(pack(b"a b " * 30_000 + b"token=abcdefgh" + b" c d" * 30_000))
        _, found, unread = secrets.scan("x " + run, limit=5000)
        assert [s.text() for s in found] == [f"assign:2:{2 + len(run)}"] and unread == 1
        inner = b64(pack(pack(b"a b " * 30_000 + b"token=abcdefgh")))
        assert secrets.scan(inner, limit=5000)[1]
    bomb = b64(gzip.compress(b"a b " * 30_000))
    frame = spark.createDataFrame([(1, f"x {bomb} y", "en", "a", 1)], DOCS)
    assert [r.text for r in secrets.redacted(frame, limit=5000).collect()] == ["x [SECRET] y"]


def test_secret_tables(spark, docs, nothing):
    plain = [r for r in secrets.finds(docs).collect()]
    assert len(plain) == len(awkward()) and not any(r.base for r in plain)
    rows = [(1, "token=abcdefg", "en", "a", 1), (None, None, None, None, None), (1, "token=abcdefg", "en", "a", 1)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("row", F.lit(1))
    got = secrets.redacted(frame)
    assert got.columns == frame.columns
    assert sorted((r.text or "") for r in got.collect()) == ["", "[SECRET]", "[SECRET]"]
    assert secrets.finds(nothing).count() == secrets.redacted(nothing).count() == 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(600, 16))
    vectors[100:110] = vectors[99]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] * 16), (1003, [None] * 16),
             (1004, [1.0]), (None, [1.0] * 16), (5, vectors[5].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(0))
    query = F.col("id") % 20 == 0
    got = permutation_index.search(frame, query, k=5, block=200).toPandas()
    hits = 0
    for i in range(0, 600, 20):
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        best = np.lexsort((np.arange(600), -scores))[:5]
        mine = got[got.query_id == i].sort_values("rank")
        assert list(mine["rank"]) == [1, 2, 3, 4, 5]
        hits += len(set(best) & set(mine.vec_id))
        np.testing.assert_allclose(mine.score, scores[mine.vec_id], rtol=1e-12)
    assert hits >= 0.9 * 150 and got.query_id.nunique() == 30
    few = permutation_index.search(frame.filter("vec_id < 4"), query, k=5).toPandas()
    assert list(few.vec_id) == [v for v in few.vec_id if v != 0] and len(few) == 3
    assert permutation_index.search(frame.limit(0), query).count() == 0


def recall_of(spark, vectors, queries, k=10):
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                                  "vec_id long, embedding array<double>")
    got = permutation_index.search(frame, F.col("id").isin(queries), k=k).toPandas()
    hits = 0
    for i in queries:
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        hits += len(set(np.argsort(-scores, kind="stable")[:k]) & set(got[got.query_id == i].vec_id))
    return hits / (k * len(queries))


def clustered(seed, n=6000, width=32):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(n // 40, width))[rng.integers(0, n // 40, n)]
    vectors += 0.6 * rng.normal(size=vectors.shape)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


@pytest.mark.parametrize("noise", [0.0, 0.01])
def test_recall_beside_a_third_of_copies(spark, noise):
    vectors = clustered(1)
    vectors[4000:] = vectors[0] + noise * np.random.default_rng(2).normal(size=(2000, 32))
    assert len(vectors) <= permutation_index.BLOCK and len(vectors) > 10 * permutation_index.RERANKED_LEAST
    assert recall_of(spark, vectors, list(range(20, 4000, 40))) >= 0.9


def test_recall_with_unequal_lengths(spark):
    vectors = clustered(3)
    vectors *= np.exp(0.5 * np.random.default_rng(4).normal(size=(6000, 1)))
    assert recall_of(spark, vectors, list(range(0, 6000, 60))) >= 0.9


def test_equal_vectors_come_by_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(50)] + [(60, [1.0, 0.0])]
    got = permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"),
                                   F.col("id") == 20, k=20).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [i for i in range(21) if i != 20]


def test_toxicity_learns_and_holds_out(spark, docs, nothing):
    rng = random.Random(5)
    bad = ["grobbleton", "snarfquist", "vexmoor"]
    rows, labels = [], []
    for i in range(600):
        words = prose(1000 + i, 80).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(80)] = rng.choice(bad)
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    frame = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels + [(5000, 1, 1), (None, 0, 1), (7, None, None)],
                                  "doc_id long, quality int, toxic int")
    model = toxicity.train(frame, known)
    got = {r.doc_id: r.score for r in toxicity.score(frame, model).select("row.*", "score").collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i in held]) > 0.95
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == len(awkward()) and all(0 <= r.score <= 1 for r in odd)
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns
    assert toxicity.score(nothing, model).count() == 0
    untaught = toxicity.train(frame, known.limit(0))
    assert {r.score < 0.5 for r in toxicity.score(docs, untaught).collect()} == {True}


def test_windows_cover_every_byte():
    sizes = np.array([0, 1, 63, 64, 65, 112, 113, 1000])
    segments, counts = toxicity._windows(sizes)
    covered = np.zeros(sizes.sum(), bool)
    for at, length in segments.astype(int):
        covered[at:at + length] = True
    assert covered.all() and counts[0] == 0 and segments[:, 1].max() <= toxicity.WINDOW


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1
                for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(repeated))


def quality_rows():
    rows = awkward()
    line = prose(9, 12)
    rows += [(300, "\n".join([line, " ", line, line + " ", line]), "en", "a", 1),
             (301, prose(10, 40) + " " + prose(10, 40), "en", "a", 1),
             (302, " ".join(w + "###" for w in prose(11, 90).split()), "en", "a", 1),
             (303, "x\ny\n\nx", None, None, 1)]
    return rows


def test_quality_counts_and_thresholds(spark, nothing):
    frame = spark.createDataFrame(quality_rows(), DOCS).withColumn("kept", F.lit("own"))
    got = quality.judged(frame, carry=("doc_id", "text", "lang", "source")).collect()
    assert len(got) == len(quality_rows())
    for r in got:
        counts = brute_quality(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 20 or 100 * counts[4] > 30 * counts[0])
        assert not (r.base_failed and r.kept)
    by_id = {r.row.doc_id: r.kept for r in got}
    assert not by_id[302] and not by_id[301] and all(by_id[20 + i] for i in range(25))
    passed = quality.passing(frame)
    assert passed.columns == frame.columns
    assert passed.count() == sum(r.kept for r in got)
    assert quality.judged(nothing).count() == quality.passing(nothing).count() == 0


def test_thresholds_follow_their_group(spark):
    rows = [(i, " ".join((w + "#") if s == "code" else w for w in prose(i, 60).split()), "en", s, 1)
            for i in range(200) for s in ["code" if i % 2 else "news"]]
    rows.append((999, " ".join(w + "#" for w in prose(999, 60).split()), "en", "news", 1))
    got = {r.row.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, DOCS)).collect()}
    assert not got.pop(999) and all(got.values())


def test_thresholds_act_on_every_measure(spark):
    """Each kind of junk is cut by its own measure, beside a tenth of other junk in the group; a
    group of other habits keeps them."""
    rng = random.Random(3)

    def text(seed, repeats):
        words = prose(seed, 100).split()
        return "\n".join(" ".join(words[10 * i:10 * i + 10]) for i in range(10)) + "\n" + "\n".join(
            " ".join(words[:10]) for _ in range(repeats))

    rows = [(i, text(i, 0), "en", "plain", 1) for i in range(400)]
    rows += [(1000 + i, text(1000 + i, 1 + rng.randrange(2)), "en", "poems", 1) for i in range(400)]
    rows += [(2000 + i, " ".join(w + "###" for w in prose(2000 + i, 60).split()), "en", "plain", 1)
             for i in range(40)]
    rows += [(3000, text(3000, 2), "en", "plain", 1),
             (3001, " ".join(w * 3 for w in prose(3001, 60).split()), "en", "plain", 1)]
    found = quality.judged(spark.createDataFrame(rows, DOCS), far=0.99)
    got = {r.row.doc_id: r for r in found.collect()}
    assert sum(got[i].kept for i in [*range(400), *range(1000, 1400)]) > 780
    assert all(got[2000 + i].failed for i in range(40))
    assert "duplicate_share" in got[3000].failed and "repeat_share" in got[3000].failed
    assert got[3001].failed == ["word_length"]
    shown = {r.measure: r for r in quality.rejections(found).collect()}
    assert set(shown) == set(quality.MEASURES)
    for m, r in shown.items():
        failed = [x.failed for x in got.values() if not x.base_failed]
        assert (r.rejected, r.alone) == (sum(m in f for f in failed), failed.count([m]))
    assert all(shown[m].most_high > shown[m].least_high + 0.05 for m in ("duplicate_share", "repeat_share"))
    whole = quality.judged(spark.createDataFrame(rows, DOCS), far=0.99, groups=("source",)).collect()
    assert abs(sum(r.kept for r in whole) - sum(r.kept for r in got.values())) < 20


def test_viterbi_counts(docs, nothing):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers
    pieces = token_counts.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    reference = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    reference.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed"),
        pre_tokenizers.Metaspace(prepend_scheme="always")])
    expected = sorted((str(i), len(WORD.findall(t or "")), len(reference.encode(t or "").ids))
                      for i, t, *_ in awkward())
    got = token_counts.counted(docs).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in got) == expected
    rng = random.Random(5)
    counter = token_counts.Counter(pieces)
    for _ in range(3000):
        text = "".join(rng.choice("abtheон▁ <0x4字😀́é!1\n") for _ in range(rng.randint(0, 14)))
        assert sum(map(counter.word, text.encode().split())) == len(reference.encode(text).ids), text
    assert token_counts.counted(nothing).count() == 0


def test_whole_texts_keep_their_white_space(docs, nothing):
    from tokenizers import Tokenizer, models, normalizers
    pieces = token_counts.vocabulary(tokenizer_path("piece_bpe_32k.model"))
    reference = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    reference.normalizer = normalizers.Sequence(
        [normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    expected = sorted((str(i), len(WORD.findall(t or "")), len(reference.encode(t or "").ids))
                      for i, t, *_ in awkward())
    got = token_counts.counted(docs, whole=True).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in got) == expected
    counter = token_counts.Counter(pieces, whole=True)
    assert counter.cuts and counter.texts([counter.spans(b"a b\n\nc")]) == [5]
    rng = random.Random(5)
    texts = ["".join(rng.choice("abth  е▁<0x4字😀́!1\n\t\r\x0b\xa0") for _ in range(rng.randint(0, 14)))
             for _ in range(3000)]
    assert counter.texts([counter.spans(t.encode()) for t in texts]) == [
        len(reference.encode(t).ids) for t in texts]
    crossing = token_counts.Counter([*pieces, ("a▁b", -1.0)], whole=True)
    assert not crossing.cuts and crossing.texts([crossing.spans(b"a b")]) == [2]
    assert token_counts.counted(nothing, whole=True).count() == 0


def test_viterbi_ties():
    from tokenizers import Tokenizer, models
    rng = random.Random(2)
    for _ in range(300):
        pieces = {"<unk>": 0.0} | {"".join(rng.choice("ab") for _ in range(rng.randint(1, 3))):
                                   -float(rng.randint(1, 3)) for _ in range(6)}
        reference = Tokenizer(models.Unigram(list(pieces.items()), unk_id=0, byte_fallback=False))
        counter = token_counts.Counter(list(pieces.items()))
        if {"a", "b"} <= set(pieces):
            text = "".join(rng.choice("ab") for _ in range(9))
            assert counter.unit(text) == len(reference.encode(text).ids)


def check_packed(rows, got, tokenizer):
    by_id = {}
    for i, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        by_id.setdefault(i, []).append(np.asarray(ids, "<u4"))
    for i, mine in got.groupby(got.doc_id.fillna(-1)):
        expected = sorted(((s, s + len(a)) for a in by_id[None if i == -1 else i] for s in [0]), key=str)
        pieces = mine.sort_values("start")
        assert pieces.length.sum() == sum(end for _, end in expected)
        if len(expected) == 1:
            ids, at = by_id[None if i == -1 else i][0], 0
            for p in pieces.itertuples():
                assert p.start == at and p.doc_tokens == len(ids)
                assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
                at += p.length
    for _, mine in got.groupby("sequence_id"):
        mine = mine.sort_values("offset")
        assert list(mine.offset) == [0, *mine.length.cumsum()[:-1]] and mine.length.sum() <= 4096


def test_packing(docs, tokenizer, nothing):
    got = packing.pack(docs).toPandas()
    check_packed(awkward(), got, tokenizer)
    assert sorted(got.sequence_id.unique()) == list(range(got.sequence_id.nunique()))
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("length", [0, 1, 2, 63, 64, 1000, 2047, 2048, 2049, 3000, 4095])
def test_cut_pieces_nearly_fill_their_class(length):
    pieces = packing.cut_remainder(length, 4096, 0.02)
    assert sum(pieces) == length
    assert all((4096 // (4096 // p)) - p <= 0.02 * (4096 // (4096 // p)) for p in pieces)


def test_shards(docs, nothing):
    got = sharding.shard(docs, shards=4, slots=64).collect()
    assert len(got) == len(awkward())
    sizes = sorted(len((t or "").encode()) + 16 for _, t, *_ in awkward())
    assert sorted(r["size"] for r in got) == sizes
    for one in range(4):
        places = sorted(r.slot for r in got if r.shard == one)
        assert places == list(range(len(places)))
    crcs = Counter(zlib.crc32((t or "").encode()) for _, t, *_ in awkward())
    assert Counter(r.text_crc32 for r in got) == crcs
    assert sharding.shard(nothing, 4, 64).count() == 0


def test_map_versions_move_few_slots():
    rng = random.Random(1)
    totals = [{"virtual_slot": s, "slot_bytes": rng.randint(1, 100), "slot_rows": 2} for s in range(512)]
    keys = ["version", "virtual_slot", "shard", "slot_bytes", "slot_rows", "first_place"]
    first = [dict(zip(keys, e)) for e in sharding.first_map(totals, 10, 512)]
    for shards in (11, 9, 10):
        entries = [dict(zip(keys, e)) for e in sharding.edited_map(first, totals, shards)]
        assert {e["version"] for e in entries} == {2} and len(entries) == 512
        load = Counter()
        for e in entries:
            load[e["shard"]] += e["slot_bytes"]
        assert len(load) == shards and max(load.values()) - min(load.values()) <= 100
        moved = sum(a["shard"] != b["shard"] for a, b in zip(first, entries))
        assert moved <= 512 * 2 / 10
    assert all(a["shard"] == b["shard"] for a, b in zip(first, entries))


def test_digest_of_no_finds():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
