"""Lexical search, periodic runs and bin completion against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from grantweave.llm import queries as corpus
from grantweave.llm.bin_completion import bin_packed, bins, best_fit, lower_bound
from grantweave.llm.lexical_search import ranked
from grantweave.llm.periodic_runs import periodic_runs, runs_of

SF = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("_row", T.StringType()),
    ]
)
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def docs_of(spark, texts):
    """Ids may be given; extra columns have names that the operators use inside."""
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "s", "r") for i, t in rows], DOCS).repartition(3)


# --- lexical search -------------------------------------------------------------------------


def plain_search(docs, items, limit):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))

    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, all_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 50 + (50 * c.total() * n_docs) // all_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scores)[:limit], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=str)


@pytest.mark.parametrize("query_chars", [1 << 20, 40])
def test_search(spark, query_chars):
    rnd = random.Random(4)
    vocabulary = ["w%d" % i for i in range(60)] + ["Éa", "éa", "ÀB9", "x_y", "A-b"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(0, 60))) for _ in range(300)]
    texts += [None, "", " \n", "w1", "W1", texts[0], texts[0], "w1 " * 5000, "\x7fw2\x00w3", (0, texts[5]), (None, texts[7])]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 80)))) for i in range(6)]
    items += [(6, None), (7, "..."), (8, "absent words"), (1, "w1 w1 W2"), (None, "w5 w59")]
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    got = ranked(docs_of(spark, texts), spark.createDataFrame(items, ITEMS), limit=12, query_chars=query_chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(rows, items, 12)


def test_search_with_more_terms_than_a_mask_word(spark):
    texts = [" ".join(f"t{j}" for j in range(150) if (i * 7 + j * j) % 11 < 3) for i in range(80)]
    items = [(0, " ".join(f"t{j}" for j in range(150)))]
    got = ranked(docs_of(spark, texts), spark.createDataFrame(items, ITEMS), limit=5)
    assert sorted(map(tuple, got.collect()), key=str) == plain_search(list(enumerate(texts)), items, 5)


def test_search_in_empty_tables(spark):
    none, items = docs_of(spark, []), spark.createDataFrame([(0, "a")], ITEMS)
    assert ranked(none, items).count() == 0
    assert ranked(docs_of(spark, ["a b"]), items.filter("item_id > 0")).count() == 0
    assert ranked(docs_of(spark, [None, ""]), items).count() == 0


# --- periodic runs --------------------------------------------------------------------------


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            begin = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - begin >= max(12, 2 * q):
                found.setdefault((begin, i + q), q)
            i += i == begin
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_texts(rnd):
    """Arrays of few different words: random, periodic, of runs in a row, and self-similar."""
    k, n = rnd.choice([1, 2, 3, 5]), rnd.randrange(0, 160)
    root = [rnd.randrange(k) for _ in range(rnd.randrange(1, 40))]
    yield [rnd.randrange(k) for _ in range(n)]
    yield (root * 160)[:n]
    rows = []
    while len(rows) < n:
        rows += [rnd.randrange(k) for _ in range(rnd.randrange(1, 8))] * rnd.randrange(1, 12)
    yield rows
    a, b, thue = [0], [0, 1], [0]
    while len(b) < n:
        a, b, thue = b, b + a, thue + [1 - x for x in thue]
    yield b[:n]
    yield thue[:n]
    grown = root[:5]
    while len(grown) < n:
        i = rnd.randrange(len(grown))
        grown = grown + grown[i : rnd.randrange(i, len(grown)) + 1] * rnd.randrange(1, 4)
    yield grown


def test_runs():
    rnd = random.Random(9)
    for _ in range(120):
        texts = list(periodic_texts(rnd))
        got = runs_of([np.array(t, np.int64) for t in texts])
        assert [list(map(tuple, g.tolist())) for g in got] == [plain_runs(t) for t in texts]


def test_long_runs_are_found_in_linear_work():
    for text, runs in (
        ([0] * 300_000, [(0, 300_000, 1)]),
        (list(range(70_000)) * 4, [(0, 280_000, 70_000)]),
        (([0] * 100 + [1]) * 1000, 1001),
    ):
        found = runs_of([np.array(text, np.int64)])[0]
        assert len(found) == runs if isinstance(runs, int) else list(map(tuple, found.tolist())) == runs


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_documents(spark):
    texts = [
        None, "", " \n\t", "a " * 11, "a " * 12, "x\n" + "b c\t" * 9 + "y", "é ü " * 40,
        "one two three " * 3 + "one", "p q r s t u v " * 2 + "w", "long " * 60_000 + "end",
        (3, "a " * 30), (3, "a " * 30), (None, "z " * 14),
    ]
    got = periodic_runs(docs_of(spark, texts)).collect()
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    expected = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        # No need to try long periods of the one very long text.
        runs = [(0, 60_000, 1)] if len(words) > 10_000 else plain_runs(words)
        expected.append((i, len(words), runs, plain_collapsed(words, runs)))
    assert sorted([(r.doc_id, r.n_words, list(map(tuple, r.runs)), r.collapsed) for r in got], key=str) == sorted(expected, key=str)
    assert periodic_runs(docs_of(spark, [])).count() == 0


def test_runs_query(spark):
    expected = {}
    for doc_id, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        expected[doc_id] = (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
        )
    got = corpus.op12_periodic_runs(spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected
    assert sum(v[0] for v in expected.values()) > 10


# --- bin completion -------------------------------------------------------------------------


def fewest(sizes, room):
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k, left in enumerate(rooms):
            if left >= sizes[i] and left not in rooms[:k]:
                go(i + 1, [*rooms[:k], left - sizes[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, room - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    go(0, [])
    return best


def test_bins_are_the_fewest():
    rnd = random.Random(2)
    for _ in range(300):
        room = rnd.choice([10, 20, 50, 100])
        sizes = [rnd.randrange(1, room) for _ in range(rnd.randrange(0, 10))]
        counts = np.bincount(np.array(sizes, int), minlength=room + 1)
        for uses in (bins(counts), best_fit(counts)):
            used = Counter()
            for n, whole in uses:
                assert n > 0 and sum(whole) <= room
                for size in whole:
                    used[size] += n
            assert used == Counter(sizes)
        least = fewest(sizes, room)
        assert lower_bound(counts) <= least == sum(n for n, _ in bins(counts))


def test_search_beats_best_fit():
    sizes = np.random.default_rng(1).integers(200, 700, 3000)
    counts = np.bincount(sizes, minlength=1025)
    assert lower_bound(counts) <= sum(n for n, _ in bins(counts)) < sum(n for n, _ in best_fit(counts))


def check_pieces(rows, texts, length):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % length or min(length, len(ids))
        for piece, start in enumerate([0, *range(first, len(ids), length)]):
            part = ids[start : first if piece == 0 else start + length]
            expected[i, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in placed.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(placed)


def test_bin_packed(spark):
    texts = [None, "", "word", "a b c " * 700, "same", "same", "Ünïcode 漢字 " * 50, "x<|endoftext|>y <|endoftext|>",
             "very long " * 30_000, (3, "again"), (None, "null id")]
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    got = bin_packed(docs_of(spark, texts), group_pieces=4).collect()
    check_pieces(got, rows, 1024)
    assert bin_packed(docs_of(spark, [])).count() == 0


def test_bin_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = corpus.op13_bin_completion(spark, SF).collect()
    sequences = check_pieces(got, [tuple(r) for r in rows], 1024)
    sizes = [r.length for r in got]
    assert sequences <= lower_bound(np.bincount(sizes, minlength=1025)) + 2
