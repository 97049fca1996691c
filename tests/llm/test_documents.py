"""Operators on documents against plain Python, on rows with nulls, copies, ties and odd texts."""

import base64
import hashlib
import random
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from grantweave.llm import blocks as bl
from grantweave.llm import quality
from grantweave.llm.components import components
from grantweave.llm.exact_dedup import BLOCK_CHARS, drop_copies, exact_duplicates, named
from grantweave.llm.jaccard_join import drop_near_copies, jaccard_components
from grantweave.llm.packing import hilbert_keys, packed
from grantweave.llm.quality import keep_good, quality_rules
from grantweave.llm.substring_dedup import COVER, PERIOD, repeated_passages, without_repeats
from grantweave.llm.token_ids import TextIds

SCHEMA = "doc_id long, text string, n_words long, name string, _block string"


def prose(seed: int, n: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(1, 7))) for _ in range(n)]


def edited(words: list[str], seed: int, share: float) -> list[str]:
    draw = random.Random(seed)
    return [w + "x" if draw.random() < share else w for w in words]


def corpus() -> list[tuple[int | None, str | None]]:
    base, passage = prose(1, 400), prose(2, 60)
    long = " ".join(prose(3, 9_000))
    rows: list[tuple[int | None, str | None]] = [
        (0, None),
        (1, ""),
        (2, " \n\t "),
        (3, "one"),
        (4, "One\x0btwo three"),
        (5, "one two  three"),
        (6, " ".join(base)),
        (7, "\n".join(base)),
        (8, " ".join(base).replace(" ", "  ")),
        (9, long),
        (10, long[:-1] + "q"),
        (11, long),
        (12, "same same " * 300),
        (13, "no break space and more words here"),
        (14, "line a\nline a\n\n \nline b # $ <b>\nline a"),
        (None, " ".join(prose(4, 80))),
        (None, " ".join(prose(4, 80))),
        (15, " ".join(prose(5, 80))),
        (15, " ".join(prose(5, 80))),
        (15, " ".join(prose(6, 80))),
    ]
    for k in range(16, 40):
        rows.append((k, " ".join(edited(base, k, 0.012))))
    for k in range(40, 60):
        rows.append((k, " ".join(prose(100 + k, 70) + passage + prose(200 + k, 30))))
    for k in range(60, 64):
        rows.append((k, " ".join(passage + prose(300 + k, 3))))
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """Extra columns clash with names that the operators use."""
    return spark.createDataFrame([(i, t, 1, "n", "b") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def counted(values) -> Counter:
    return Counter(map(tuple, values))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


# --- quality ---------------------------------------------------------------------------------


def test_quality_counts(docs, rows, empty):
    expected = []
    for i, text in rows:
        found = words(text)
        windows = Counter(zip(found, found[1:], found[2:]))
        covered = set()
        for k in range(len(found) - 2):
            if windows[tuple(found[k : k + 3])] > 1:
                covered |= {k, k + 1, k + 2}
        seen, duplicates = set(), 0
        for line in (text or "").split("\n"):
            if line.encode().split():
                duplicates += line in seen
                seen.add(line)
        failed = len(found) < 50 or 100 * len(covered) > 50 * len(found)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        expected.append((i, len(found), sum(len(w.decode()) for w in found), symbols, duplicates, len(covered), failed))
    result = quality_rules(docs)
    got = result.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert counted(got.collect()) == counted(expected)
    assert not result.filter("base_failed and kept").count()
    assert quality_rules(empty).count() == 0


def test_quality_bands():
    """Prose stays; repetition, noise and texts with many bad chunks go, whatever their length."""
    press = zstandard.ZstdCompressor(level=quality.LEVEL)
    draw = random.Random(5)
    for n in (60, 300, 2_000, 20_000):
        assert quality.judged(" ".join(prose(n, n)), press)[-1]
        cycle = prose(n, 41)
        assert not quality.judged(" ".join(cycle[k % 41] for k in range(max(n, 400))), press)[-1]
    noise = " ".join("".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(6)) for _ in range(3_000))
    assert quality.judged(noise, press)[0] == 3_000
    half = " ".join(prose(7, 4_000)) + " " + "".join(f"{k} " * 3 + "zz yy xx ww " * 40 for k in range(40))
    verdict = dict(zip([n for n, _ in quality.COLUMNS], quality.judged(half, press)))
    assert verdict["n_bad_chunks"] > quality.BAD_CHUNKS * verdict["n_chunks"] and not verdict["kept"]


@pytest.mark.parametrize("size", [800, 1_100, 2_000, 4_000, 5_000, 20_000, 580_000])
def test_encoded_data_is_rejected(size):
    """Random bytes in base64, at any line length, and random words leave the band."""
    press = zstandard.ZstdCompressor(level=quality.LEVEL)
    draw = random.Random(size)
    code = base64.b64encode(draw.randbytes(size)).decode()
    texts = ["\n".join(code[k : k + width] for k in range(0, len(code), width))[:size] for width in (10, 20, 64, 76)]
    signs = string.ascii_letters + string.digits
    texts += [" ".join("".join(draw.choices(signs, k=n)) for _ in range(size // (n + 1))) for n in (5, 12)]
    for text in texts:
        assert not quality.judged(text, press)[-1]
        assert not quality.in_band(len(text), len(press.compress(text.encode())))


def test_keep_good_keeps_columns(docs):
    kept = keep_good(docs)
    assert kept.schema == docs.schema
    expected = quality_rules(docs).filter("kept").select("doc_id")
    assert counted(kept.select("doc_id").collect()) == counted(expected.collect())


# --- exact dedup -----------------------------------------------------------------------------


def normal(text: str | None) -> str:
    return "".join(" " if k == " " else k for k in __import__("re").sub(r"[\x20\x09-\x0D]+", " ", text or ""))


def test_exact_duplicates(docs, rows, empty):
    groups = defaultdict(list)
    for i, text in rows:
        groups[normal(text)].append(i)
    got = exact_duplicates(docs).collect()
    assert len(got) == len(rows)
    kept = Counter()
    for r in got:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        members = groups[text]
        known = [m for m in members if m is not None]
        assert r.group_size == len(members) and r.keep_id == (min(known) if known else None)
        if r.kept:
            assert r.doc_id == r.keep_id
            kept[text] += 1
    assert kept == Counter(groups.keys())
    assert exact_duplicates(empty).count() == 0
    assert max(len(normal(t)) for _, t in rows) > 5 * BLOCK_CHARS


def test_drop_copies(docs, rows):
    kept = drop_copies(docs)
    assert kept.schema == docs.schema
    assert sorted(normal(r.text) for r in kept.collect()) == sorted({normal(t) for _, t in rows})


def test_named_hot_values_equal_cold(spark):
    """A value with most of the rows gets its name by another way, but as any other value does."""
    few = spark.range(50).select("id", (F.col("id") % 10).cast("string").alias("v"))
    many = few.unionByName(spark.range(50, 2_000).select("id", F.lit("3").alias("v")))
    a = {r.v: r.name for r in named(few.withColumn("w", F.col("v")), ["w"], "name").collect()}
    b = {r.v: r.name for r in named(many.withColumn("w", F.col("v")), ["w"], "name").collect()}
    assert a == b and len(set(a.values())) == 10


# --- near copies -----------------------------------------------------------------------------


def brute_components(rows, width=4, percent=85):
    sets = []
    for _, text in rows:
        found = (text or "").encode().lower().split()
        n = len(found)
        sets.append({tuple(found[k : k + width]) for k in range(n - width + 1)} if n >= width else {tuple(found)} if n else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for k in range(len(rows)):
        ids[root(k)].append(rows[k][0])
    smallest = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return [(rows[k][0], len(sets[k]), smallest[root(k)]) for k in range(len(rows))], len(ids)


def test_jaccard_components(docs, rows, empty):
    expected, groups = brute_components(rows)
    got = jaccard_components(docs)
    assert counted(got.select("doc_id", "n_shingles", "component_id").collect()) == counted(expected)
    assert got.filter("kept").count() == groups
    assert jaccard_components(empty).count() == 0


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 30)] + [(100, 90), (90, 95), (200, 200), (300, 300 - 1), (299, 300)]
    links = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == {**{k: 0 for k in range(1, 31)}, 95: 90, 100: 90, 300: 299}


# --- substring dedup -------------------------------------------------------------------------


def brute_passages(rows, width=13):
    first = {}
    for i, text in rows:
        number, found = (float("inf") if i is None else i), words(text)
        for k in range(len(found) - width + 1):
            key = tuple(found[k : k + width])
            first[key] = min(first.get(key, float("inf")), number)
    out = []
    for i, text in rows:
        number, found = (float("inf") if i is None else i), words(text)
        gone = set()
        for k in range(len(found) - width + 1):
            if first[tuple(found[k : k + width])] < number:
                gone |= set(range(k, k + width))
        out.append((i, found, [w for k, w in enumerate(found) if k not in gone]))
    return out


def test_repeated_passages(docs, rows, empty):
    expected = [(i, len(a), len(a) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for i, a, k in brute_passages(rows)]
    assert counted(repeated_passages(docs).collect()) == counted(expected)
    assert repeated_passages(empty).count() == 0


def test_without_repeats(docs, rows):
    out = without_repeats(docs)
    assert out.columns == docs.columns
    expected = [
        (i, t if len(a) == len(k) else b" ".join(k).decode()) for (i, t), (_, a, k) in zip(rows, brute_passages(rows))
    ]
    assert counted(out.select("doc_id", "text").collect()) == counted(expected)


def test_cover_differences():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_blocks_grow_with_ids(docs):
    placed, n = bl.in_blocks(docs, "doc_id")
    found = placed.select("doc_id", F.col(bl.BLOCK).alias("at")).collect()
    ordered = sorted(found, key=lambda r: (r.doc_id is None, r.doc_id))
    assert [r.at for r in ordered] == sorted(r.at for r in ordered)
    assert max(r.at for r in found) < n


# --- packing ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_token_ids(rows, tokenizer):
    texts = [t or "" for _, t in rows] + ["a  b", " a", "a ", "x\n\ny", "\r\n a", "<|endoftext|> it's 12 3!", "a <|endoftext|><|endoftext|>  b", "<|endoftext", "  x", "\x1f \x1fy"]
    ids = TextIds()
    for text in texts:
        assert np.frombuffer(ids.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_packed(docs, rows, empty, tokenizer):
    pieces = packed(docs).collect()
    expected = Counter()
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            expected[i, start, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == expected
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packed(empty).count() == 0


def test_hilbert_curve_steps():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline(spark, rows, tmp_path):
    extra = [(k, " ".join(prose(500 + k, 90))) for k in range(70, 74)]
    table = spark.createDataFrame([Row(doc_id=i, text=t, lang="xx", source="s", n_chars=len(t or "")) for i, t in [*rows, *extra]])
    table.write.parquet(str(tmp_path / "documents.parquet"))
    press = zstandard.ZstdCompressor(level=quality.LEVEL)
    left = [(i, t) for i, t in [*rows, *extra] if quality.judged(t, press)[-1]]
    seen, unique = set(), []
    for i, t in sorted(left, key=lambda r: (r[0] is None, r[0])):
        if normal(t) not in seen:
            seen.add(normal(t))
            unique.append((i, t))
    labels, _ = brute_components(unique)
    stay = [(i, t) for (i, t), (_, _, c) in zip(unique, labels) if i == c]
    expected = {i: len(k) for i, _, k in brute_passages(stay)}
    out = corpus_pipeline.run(spark, str(tmp_path))
    docs = table.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert {r.doc_id: len(words(r.text)) for r in docs.collect()} == expected
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(expected)


def test_pipeline_near_copies(spark, tmp_path):
    """Five words and 0.8: a text with a fifth appended goes, one with more appended stays; equal to brute force."""
    rows = []
    for k in range(4):
        text = prose(900 + k, 480)
        rows += [(10 * k + j, " ".join(text[:n])) for j, n in enumerate((400, 478, 480))]
    rows += [(100, " ".join(prose(950, 400))), (101, " ".join(prose(950, 400) + prose(951, 130)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels, _ = brute_components(rows, 5, 80)
    expected = {i for i, _, c in labels if i == c}
    assert expected == {0, 10, 20, 30, 100, 101}
    stage = dict(corpus_pipeline.STAGES)["jaccard_join"]
    assert {r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()} == expected


def test_copies_of_repeated_ids(spark):
    """Rows are told by id and text, and extra columns may have any name."""
    rows = [(0, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None), (None, ""), (None, "a c"), (3, "a  c")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table = table.withColumn("_sha", F.lit("x")).withColumn("_kept_id", F.lit(1)).withColumn("own_id", F.lit(2))
    out = drop_copies(table)
    assert out.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == [(0, "b"), (1, "a"), (2, None), (3, "a  c")]
    assert drop_copies(table.filter("false")).count() == 0


def test_near_copies_of_repeated_ids(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long), (1, long + " x"), (1, "other words"), (2, long), (None, long + " y"), (None, None), (0, "else")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("number", F.lit(1))
    out = drop_near_copies(table.coalesce(1), width=5, percent=80)
    assert out.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(0, "else"), (1, long), (1, "other words"), (None, None)], key=str)


def test_clashing_names_and_ids_of_other_types(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    table = spark.createDataFrame([(1, passage), (2, "a " + passage), (3, None), (4, "")], "doc_id long, text string")
    table = table.withColumn("_block_of_ids", F.lit("kept")).withColumn("c0", F.lit(0))
    out = without_repeats(table)
    assert out.columns == table.columns
    assert {r.doc_id: (r.text, r["_block_of_ids"]) for r in out.collect()} == {
        1: (passage, "kept"), 2: ("a", "kept"), 3: (None, "kept"), 4: ("", "kept")
    }
    assert without_repeats(table.filter("false")).count() == 0
    by_text = table.withColumn("doc_id", F.col("doc_id").cast("string"))
    for call in (repeated_passages, without_repeats, jaccard_components, drop_near_copies):
        with pytest.raises(ValueError, match="integer"):
            call(by_text)
