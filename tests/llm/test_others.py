"""Chats, licenses, pages, segmentation and toxicity on small inputs with known answers."""

import hashlib
import itertools
import json
import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from grantweave.llm import license_scan as ls
from grantweave.llm import segmentation as sg
from grantweave.llm.chat_format import canonical, formatted, layout_counts, read_back
from grantweave.llm.html_template import extracted, main_text, out_of_order, templates
from grantweave.llm.html_template import pieces as page_pieces
from grantweave.llm.license_scan import NOTICES, scanned
from grantweave.llm.queries import op3_chat_format, op7_segmentation
from grantweave.llm.segmentation import Pieces, merged, segmented
from grantweave.llm.toxicity import scored, trained

# --- chats -----------------------------------------------------------------------------------

RECORDS = {
    "turn": ({"text": "hi", "role": "user"}, [("user", "hi")]),
    "messages": ({"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]}, [("user", "a"), ("assistant", "b")]),
    "conversations": ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, [("user", "a"), ("assistant", "b")]),
    "instruction": ({"instruction": "do", "input": "x", "output": "y"}, [("user", "do\nx"), ("assistant", "y")]),
    "instruction_only": ({"output": "y", "instruction": "do"}, [("user", "do"), ("assistant", "y")]),
    "system_prompt": ({"system": "", "prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")]),
    "prompt": ({"prompt": "p", "response": None}, [("user", "p"), ("assistant", "")]),
    "completion": ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    "question": ({"question": 7, "answer": True}, [("user", "7"), ("assistant", "true")]),
}


def test_layouts(spark):
    rows = [(k, json.dumps(record), k, "t") for k, (record, _) in RECORDS.items()]
    rows += [("odd", '{"a": {"b": 1}}', "x", "t"), ("bad", "{", "x", "t"), ("null", None, "x", "t")]
    got = {r.id: r for r in canonical(spark.createDataFrame(rows, "id string, record string, layout string, turns string"), "record").collect()}
    for name, (_, turns) in RECORDS.items():
        assert got[name].layout == name
        assert [tuple(t) for t in got[name].turns] == turns
    assert got["odd"].layout is None and got["odd"].turns is None and got["odd"].fingerprint is not None
    assert got["bad"].turns is None and got["null"].fingerprint is None
    assert len({got[n].fingerprint for n in RECORDS}) == len(RECORDS)


def test_layouts_with_other_fields(spark):
    """Fields that no mapping names do not hide a layout; what cannot be mapped is counted."""
    cases = {
        '{"messages":[{"role":"user","content":"a"}],"id":7}': ("messages", [("user", "a")]),
        '{"messages":[{"role":"user","name":"n","content":"a"},{"role":"tool","calls":[1]}]}': ("messages", [("user", "a"), ("tool", "")]),
        '{"messages":[]}': ("messages", []),
        '{"messages":[{"role":"user","content":[{"type":"text","text":"a"},{"type":"image","url":"u"},{"text":"b"}]}]}': ("messages", [("user", "a\nb")]),
        '{"conversations":[{"from":"human","value":"a","w":1}],"source":{"x":[1,2]}}': ("conversations", [("user", "a")]),
        '{"prompt":"p","response":"r","meta":null}': ("prompt", [("user", "p"), ("assistant", "r")]),
        '{"messages":[{"speaker":"x"}]}': (None, None),
        '{"messages":"text"}': (None, None),
        '["a"]': (None, None),
        '7': (None, None),
    }
    mapped = canonical(spark.createDataFrame([(r,) for r in cases], "record string").select("record", F.col("record").alias("j")), "j")
    for row in mapped.collect():
        turns = None if row.turns is None else [tuple(t) for t in row.turns]
        assert (row.layout, turns) == cases[row.record], row.record
    counts = {(r.layout is None): r.records for r in layout_counts(mapped).filter("layout is null or layout = 'prompt'").groupBy("layout").agg(F.sum("records").alias("records")).collect()}
    assert counts == {True: 4, False: 1}


def test_format_round_trip(spark):
    odd = ["", "</turn>", "\\", "\\b\\l\\g", "<turn assistant>x</turn>", "a > b < c", "é\u2003😀\n", "x" * 50_000, "\\</turn>\\"]
    rows = [(k % 5, k, random.Random(k).choice(["user", "assistant", "sys<>\\tem"]), t) for k, t in enumerate(odd * 3)]
    rows += [(7, 0, None, None), (None, 1, "assistant", "n"), (8, 0, "assistant", "b"), (8, 0, "assistant", "a"), (8, 0, "assistant", "a")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in read_back(formatted(table.withColumn("formatted", F.lit(1)), "conv_id", "turn")).collect()}
    assert len(got) == 8
    for conv, row in got.items():
        turns = sorted(((n, r or "", t or "") for c, n, r, t in rows if c == conv))
        assert [(t.role, t.text) for t in row.turns] == [(r, t) for _, r, t in turns]
        assert row.loss_text == [t for _, r, t in turns if r == "assistant"]
        assert row.formatted.count("</turn>") == len(turns)
    assert formatted(table.filter("false"), "conv_id", "turn").count() == 0


def test_query_keeps_huge_turns(spark, tmp_path):
    """A text above the JSON reader's limit of 20 million characters is a turn like any other."""
    size = 20_500_000
    row = spark.range(1).select("id", F.lit(0).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.repeat(F.lit("x"), size).alias("text"))
    row.withColumnRenamed("id", "conv_id").write.parquet(str(tmp_path / "conversations.parquet"))
    got = op3_chat_format(spark, str(tmp_path)).filter("conv_id = 0").select("n_turns", "loss_chars", "loss_sha256").collect()
    assert [tuple(r) for r in got] == [(1, size, hashlib.sha256(b"x" * size).hexdigest())]


# --- licenses --------------------------------------------------------------------------------


def test_licenses(spark):
    draw = random.Random(9)
    filler = lambda n: " ".join("".join(draw.choice("abcdef") for _ in range(5)) for _ in range(n))
    rows, expected = [], {}
    for k, (name, text) in enumerate(NOTICES.items()):
        for copy in range(8):
            i = 100 * k + copy
            rows.append((i, filler(copy * 3) + " " + text.upper().replace(" ", "\n  ") + " " + filler(20)))
            expected[i] = name
    rows += [(9_000, None), (9_001, ""), (9_002, filler(3_000)), (9_003, "the MIT license"), (9_004, "mit")]
    rows.append((9_005, NOTICES["mit"] + filler(900) + " " + NOTICES["cc-by-nc-4.0"]))
    got = {r.doc_id: r for r in scanned(spark.createDataFrame(rows, "doc_id long, text string").withColumn("licenses", F.lit(1))).collect()}
    missed = [i for i, name in expected.items() if name not in got[i].licenses.split(",")]
    assert len(missed) <= 0.02 * len(expected)
    assert all(got[i].n_licenses == 0 for i in (9_000, 9_001, 9_002, 9_003, 9_004))
    assert got[9_005].licenses == "cc-by-nc-4.0,mit"
    assert scanned(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_variants(spark):
    """A license is not taken for one that differs in version or variant."""
    cc = "This work is licensed under a Creative Commons Attribution{} International License."
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    free = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
        "License as published by the Free Software Foundation"
    )
    cases = [
        (cc.format(" 4.0"), "cc-by-4.0"),
        (cc.format("-NonCommercial 4.0"), "cc-by-nc-4.0-sentence"),
        (cc.format("-ShareAlike 4.0"), "cc-by-sa-4.0-sentence"),
        (cc.format("-NonCommercial-NoDerivatives 4.0"), "cc-by-nc-nd-4.0-sentence"),
        (cc.format(" 2.0"), ""),
        ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", "cc-by-3.0"),
        ("Licensed under CC BY-NC-SA 4.0.", "cc-by-nc-sa-4.0"),
        (gnu.format("", 3), "gpl-3.0"),
        (gnu.format("", 2), "gpl-2.0"),
        (gnu.format("Lesser ", 3), "lgpl-3.0"),
        (gnu.format("Affero ", 3), "agpl-3.0"),
        (free.format(""), "gpl-header"),
        (free.format("Lesser "), "lgpl"),
        (free.format("Affero "), "agpl"),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", "mpl-1.1-form"),
        (NOTICES["mpl-2.0"], "mpl-2.0"),
    ]
    docs = spark.createDataFrame([(k, text) for k, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in scanned(docs).collect()}
    assert {text: got[k] for k, (text, _) in enumerate(cases)} == dict(cases)


def test_license_windows(spark):
    """Windows without a shingle of a notice are left out, and no band value that a notice has is lost."""
    draw = random.Random(5)
    known = list(range(1, 40))
    texts = [[draw.choice(known) if draw.random() < share else draw.randrange(10**6, 10**18) for _ in range(n)]
             for n in (0, 1, 2, 6, 7, 8, 9, 31, 300) for share in (0, 0.02, 0.3, 1)]
    texts.append([10**9 + k for k in range(3_000)] + [7] + [10**10 + k for k in range(3_000)])
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, hashes array<bigint>")
    rows = ls._once(docs, "places", ls.places_of("hashes", known))
    rows = ls._once(rows, "starts", ls.windows_over("places"))
    got = {r.id: r for r in rows.select("id", "starts", ls.band_values("hashes", "starts").alias("bands")).collect()}
    for k, text in enumerate(texts):
        windows = {i + 1: text[i : i + ls.WINDOW] for i in range(0, len(text), ls.STEP)}
        assert sorted(got[k].starts) == [i for i, w in windows.items() if set(w) & set(known)]
        signed = lambda v: (v + (1 << 63)) % (1 << 64) - (1 << 63)
        of = lambda w: {signed(min(x ^ seed for x in w) & ~(ls.BANDS - 1) | b) for b, seed in enumerate(ls._SEEDS)}
        listed = {v for x in known for v in of([x])}
        assert set(got[k].bands) & listed == {v for w in windows.values() for v in of(w)} & listed
    assert len(got[len(texts) - 1].bands) <= 2 * ls.BANDS
    plain = spark.createDataFrame([(1, "one two three " * 2_000)], "doc_id long, text string")
    assert scanned(plain).collect()[0].n_licenses == 0


# --- pages -----------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{{}}</style><script>var t="<p>no</p>";</script></head><body>
<header>no</header><nav><ul><li><a href="/x">no</a><li>no</ul></nav><div class="cookie-notice">no <p>no</p></div>
<aside>no</aside><form><label>no</label><p>no</p></form><!-- <p>no</p> -->
<article class="post"><h1>{title}</h1><p>one &amp; <b>two</b>&nbsp;three<p>four<br>five<div class="ad">no</div>
<ul><li>six<li>seven</ul>{more}</article><section id="comments"><p>no</p></section><footer>no</footer></body></html>"""
TEXT = "{title}\none & two three\nfour five\nsix\nseven"


def test_pages(spark):
    rows = [(k, f"https://h{k % 2}.example/{k}", PAGE.format(title=f"Title {k}", more="<p>more</p>" * k)) for k in range(6)]
    expected = {k: TEXT.format(title=f"Title {k}") + "\nmore" * k for k in range(6)}
    rows += [(10, "https://h0.example/", None), (11, None, ""), (12, None, "just text"), (13, "x", "<p>a<p>b</div></p>c")]
    rows += [(14, "HTTPS://H1.example/y", PAGE.format(title="cut", more="<p>tail &lt; <i>end")[:-20].split("</article>")[0])]
    expected |= {10: "", 11: "", 12: "just text", 13: "a\nb\nc", 14: TEXT.format(title="cut") + "\ntail < end"}
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn("text", F.lit(2))
    got = {r.page_id: r for r in extracted(table).collect()}
    assert {i: r.text for i, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extracted(table.filter("false")).count() == 0


def host_pages(spark, *hosts):
    rows = [
        (100 * h + k, f"https://h{h}.example/", f"<html><body>{body}</body></html>")
        for h, bodies in enumerate(hosts)
        for k, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)


def prose(k, n=30):
    return " ".join(f"w{k * k + i * (k + 3)}" for i in range(n))


def test_classes_against_brute_force(spark):
    """Classes, their order and nesting from the vectors of all pages; an element that moves leaves, so does a rare one."""
    bodies = []
    for k in range(8):
        box = "<aside><h2>x</h2></aside>" if k % 4 else ""
        moved = "<section>m</section>"
        items = "".join(f"<li>{prose(k + j, 2)}</li>" for j in range(k % 3 + 1))
        bodies.append(f"{moved if k % 2 else ''}<nav>Home</nav>{box}<div><ul>{items}</ul></div>{'' if k % 2 else moved}{'<hr><pre>r</pre>' if k < 3 else ''}")
    bodies.append(bodies[0])
    rows = host_pages(spark, bodies).withColumn("host", F.lit("h"))
    found = templates(rows).first()
    assert (found._rows, found._n) == (9, 8)

    pages = [[p.token() for p in page_pieces(f"<html><body>{b}</body></html>")] for b in bodies[:8]]
    vectors = {}
    for token in {t for p in pages for t in p}:
        vector = tuple(p.count(token) for p in pages)
        if sum(map(bool, vector)) >= max(4, 3 if token & 1 else 2):
            vectors.setdefault(vector, set()).add(token)
    moves = {p.token() for p in page_pieces(f"<html><body>{bodies[1]}</body></html>") if p.element.name == "section"}
    classes = set()
    for tokens in vectors.values():
        orders = set()
        for p in pages:
            run = [t for t in p if t in tokens - moves]
            if run:
                k = len(tokens - moves)
                orders.add(tuple(run[:k]) if run == run[:k] * (len(run) // k) else None)
        if len(orders) == 1 and None not in orders:
            classes |= orders
    assert {tuple(c.order) for c in found.classes} == classes
    names = {p.token(): (p.kind, p.element.name, p.text) for p in page_pieces(f"<html><body>{bodies[1]}</body></html>")}
    got = {tuple(names[t] for t in order) for order in classes}
    assert (("open", "aside", ""), ("open", "h2", ""), ("text", "h2", "x"), ("close", "h2", ""), ("close", "aside", "")) in got
    assert (("open", "li", ""), ("close", "li", "")) in got


def test_out_of_order():
    for k in range(200):
        rng = random.Random(k)
        order = rng.sample(range(8), 8)
        left = [t for t in order if t not in out_of_order(list(range(8)), order)]
        most = max(n for n in range(9) for part in itertools.combinations(order, n) if list(part) == sorted(part))
        assert left == sorted(left) and len(left) == most
    assert out_of_order([], []) == []


def test_slots_overrule_names(spark):
    """Where the names mislead, text that varies over the host is taken, and text that does not is left."""
    cases = [
        # The article is in an element called a widget; what is called the content is the same everywhere.
        ('<div class="widget"><h2>{k} title</h2><p>{text}</p></div><div class="content"><p>Buy now, all days.</p></div>', "{k} title\n{text}"),
        # Nothing is named; a notice is the same everywhere.
        ('<div class="x1"><p>We value your privacy a lot.</p></div><div class="x2"><p>{text}</p></div>', "{text}"),
        # Of two main elements only one varies.
        ("<article><p>Ten tips that never change.</p></article><article><h1>{k}</h1><p>{text}</p></article>", "{k}\n{text}"),
        # Names decide between slots that vary.
        ('<div class="ad">{k}{k} off</div><div class="x2"><p>{text}</p></div>', "{text}"),
        # Repeated parts of an article that varies stay.
        ("<article><p>Dear reader,</p><p>{text}</p></article>", "Dear reader,\n{text}"),
    ]
    pages = host_pages(spark, *([body.format(k=k, text=prose(k)) for k in range(5)] for body, _ in cases))
    got = {r.page_id: r.text for r in extracted(pages).collect()}
    assert got == {100 * h + k: expected.format(k=k, text=prose(k)) for h, (_, expected) in enumerate(cases) for k in range(5)}
    # By names alone the first two are wrong.
    for body, expected in cases[:2]:
        assert main_text(body.format(k=1, text=prose(1)), None) != expected.format(k=1, text=prose(1))


def test_copies_of_a_page_are_no_template(spark):
    """Pages that were fetched again, or differ beside the article only, keep their text."""
    same = [f"<div class=x><p>{prose(1)}</p></div>"] * 4
    ads = [f"<nav>{k}</nav><div class=ad>{prose(k)}</div><article><p>{prose(1)}</p></article>" for k in range(4)]
    assert {r.text for r in extracted(host_pages(spark, same, ads)).collect()} == {prose(1)}


def test_deep_and_long_pages(spark):
    deep = "<div>" * 5_000 + "deep" + "</div>" * 5_000
    long = "<article>" + "<p>word</p>" * 100_000 + "</article>"
    got = {r.page_id: r.text for r in extracted(host_pages(spark, [deep, long])).collect()}
    assert got == {0: "deep", 1: "\n".join(["word"] * 100_000)}


def test_main_text_without_article():
    assert main_text("<body><div>a</div><nav>b</nav><div id=content><p>c</p></div></body>", None) == "c"
    assert main_text("<div><p>a</p></div><footer>b</footer>", None) == "a"


def test_no_article_is_dropped():
    """Names on what holds the article, parts of names and slugs do not mark it; every main root stays."""
    body = "<article><h1>a</h1><p>b</p></article>"
    for page in (
        f'<body class="has-sidebar">{body}</body>',
        f'<body class="sidebar">{body}</body>',
        f'<div class="content has-sidebar">{body}</div>',
        f'<div class="sidebar">{body}</div>',
        '<div class="banner"><main><h1>a</h1><p>b</p></main></div>',
        '<article><h2 id="social">a</h2><section id="related-work"><p>b</p></section></article>',
        '<article><h2 id="social-history">a</h2><section id="social"><p>b</p></section></article>',
        '<div class="post-meta">x</div><div class="entry"><p>a</p><p>b</p></div>',
        '<div class="entry"><p>a</p></div><div class="story"><p>b</p></div>',
        '<article class="one">a</article><aside>x</aside><article class="two">b</article>',
    ):
        assert main_text(page, None) == "a\nb", page
    assert main_text('<article>a</article><section id="comments"><article>x</article></section>', None) == "a"


@pytest.mark.parametrize(
    "inside",
    [
        '<a title="a > b">a</a><p>b', "<img alt='x > y' src=z>a<p>b", '<svg-icon name="x"></svg-icon>a<p>b', "<title-bar>a</title-bar><p>b",
        "<object-card>a</object-card><p>b", '<svg class="i" width="1"/>a<p>b', "<svg><path d='x'/><title>no</title></svg>a<p>b",
        '<p title="unclosed>a<p>b', '<script>if (a > b) "x"</script>a<p>b', "<p data-x='1 > 0' class=\"y\">a</p>b",
    ],
)
def test_tags_end_where_they_end(inside):
    assert main_text(f"<article>{inside}</article>", None) == "a\nb"


def test_compound_names_beside_the_article():
    for name in ("sidebar-left", "left-menu", "nav-list", "ad-box", "user-comments", "site_nav"):
        assert main_text(f'<div><p>a</p></div><div class="{name}">no</div><div><p>b</p></div>', None) == "a\nb", name
    assert main_text('<div class="has-sidebar"><p>a</p></div><div class="no-menu"><p>b</p></div>', None) == "a\nb"


# --- segmentation ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pieces():
    return Pieces()


def every_path(pieces, word):
    """All segmentations of a word, by walking its lattice."""
    ending = pieces.lattice(word)

    def walk(j):
        if not j:
            yield 0.0, ()
        for i, ids, score in ending[j]:
            for total, before in walk(i):
                yield total + score, before + ids

    return sorted(walk(len(word)), key=lambda p: -p[0])


@pytest.mark.parametrize("word", ["\u2581the", "\u2581thble", "a\nb", "ç\ud800x", "\u2581\u2581in", "q"])
def test_best_against_all(pieces, word):
    full = every_path(pieces, word)
    found = pieces.best(word, 7)
    assert [s for s, _ in found] == [s for s, _ in full[:7]]
    assert len({ids for _, ids in found}) == len(found) and all(p in full for p in found)


def test_long_unbroken_word(pieces):
    """Memory and time grow with the word, not with its square or with the number of equal paths."""
    for word in ("a" * 4_000, "".join(random.Random(3).choices("ACGTacgt0189", k=40_000))):
        tracemalloc.start()
        found = pieces.best(word, 3)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len({ids for _, ids in found}) == 3 and peak < 5_000 * len(word)
        assert all("".join(pieces.text[i] for i in ids) == word for _, ids in found)


def test_query_reads_documents_and_chats(spark, tmp_path):
    spark.createDataFrame([(1, "the thing"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 0, "a")], "conv_id long, turn long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = op7_segmentation(spark, str(tmp_path)).filter("rank = 1 and exact").collect()
    assert {(r.doc_id, r.conv_id, r.turn) for r in got} == {(1, None, None), (2, None, None), (None, 1, 0)}


def test_merged_against_all():
    draw = random.Random(2)
    for _ in range(30):
        parts = [sorted(((-float(draw.randint(0, 9)), (k, r)) for r in range(draw.randint(1, 4))), reverse=True) for k in range(6)]
        full = sorted((sum(p[0] for p in choice) for choice in itertools.product(*parts)), reverse=True)
        for n in (1, 2, 3, 5):
            cut = [p[:n] for p in parts]
            got = merged(cut, n)
            assert [s for s, _ in got] == full[:n]
            assert len({ids for _, ids in got}) == len(got)


def test_segmented(spark, pieces):
    texts = ["", None, "a", " lead  and  trail ", "\u2581own\u2581 mark", "é 漢字 😀\n\ttab", "word " * 3_000, "x" * 200]
    table = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "id long, text string, rank long")
    got = segmented(table, ["id"]).collect()
    assert all(r.exact for r in got)
    assert {r.id for r in got if r["rank"] == 1} == set(range(len(texts)))
    for k, t in enumerate(texts):
        scores = [r.score for r in sorted((r for r in got if r.id == k), key=lambda r: r["rank"])]
        assert scores == sorted(scores, reverse=True) and scores == [s for s, _ in pieces.encode(t or "")]
    assert segmented(table.filter("false"), ["id"]).count() == 0
    assert sg.OWN not in "".join(pieces.decode(ids) for _, ids in pieces.encode(texts[4]))


# --- toxicity --------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    draw = random.Random(4)
    filler = ["".join(draw.choice("abdeginorst") for _ in range(draw.randint(2, 8))) for _ in range(600)]
    rude = ["grumbok", "flatzard", "wozzle"]
    rows = []
    for k in range(900):
        toxic = k % 5 == 0
        found = draw.choices(filler, k=draw.randint(5, 120))
        if toxic:
            for word in draw.choices(rude, k=2):
                found.insert(draw.randrange(len(found)), word)
        rows.append((k, " ".join(found), int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    learn = table.filter("doc_id % 7 != 0")
    odd = spark.createDataFrame([(None, "wozzle", 1), (5_000, None, 0), (5_001, "x", None), (3, rows[3][1], 0)], table.schema)
    learn = learn.unionByName(odd)
    model = trained(learn.drop("toxic"), learn.drop("text"), rows_per_task=400)
    got = scored(table.filter("doc_id % 7 = 0").withColumn("score", F.lit("x")), model).join(table, "doc_id").collect()
    toxic, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    again = trained(learn.drop("toxic").repartition(5), learn.drop("text").repartition(3), rows_per_task=400)
    assert (again.weights == model.weights).all()
    blank = scored(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), model).collect()
    assert len(blank) == 2 and blank[0].score == blank[1].score
    assert scored(table.filter("false"), model).count() == 0


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string, toxic int")
    model = trained(none.drop("toxic"), none.drop("text"))
    got = scored(spark.createDataFrame([(1, "a")], "doc_id long, text string"), model).collect()
    assert [r.score for r in got] == [0.5]
