"""Hand-checked micro inputs."""

import dataclasses
import json
import random
import re
from collections import Counter
from itertools import combinations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from grantweave import queries
from grantweave.functions.pattern import term_pattern
from grantweave.functions.text import concat_text, fold_accents, normalize_key, normalize_keyword
from grantweave.functions.translit import sequences, spellings
from grantweave.functions.variants import variant_terms
from grantweave.operators import append as ap
from grantweave.operators import link, match, outcomes, split, stats
from grantweave.operators import terms as tm
from grantweave.operators import types as ty
from grantweave.plans import DEFAULT_CONFIG, StageConfig, keywords, metrics, mlexport, preprocess
from grantweave.plans.stages import (
    config_terms,
    export_stage_csv,
    linked_outcomes,
    stored_links,
    terms_used,
)
from grantweave.sources import csv_source as cs
from grantweave.sources import keyed as kd
from grantweave.sources import tables as tb


@pytest.fixture
def grants(spark):
    text = lambda *names: ", ".join(f"`{n}` string" for n in names)
    make = lambda rows, *names: spark.createDataFrame(rows, text(*names))
    return {
        "PRJ": make(
            [
                ("1", "P1", "Gene therapy for X"),
                ("2", "P1", "CRISPR"),
                (" 3", "p2 ", "none"),
                ("4", None, "n"),
                ("5", "P5", "dup"),
                ("5", "P5", "dup"),
            ],
            "APPLICATION_ID",
            "PROJECT_NUMBER",
            "PROJECT_TITLE",
        ),
        "PRJABS": make(
            [("1", "a1"), ("1", "a1b"), ("3 ", "a3"), ("9", "orph")],
            "APPLICATION_ID",
            "ABSTRACT_TEXT",
        ),
        "PUBLINK": make(
            [("10", "P1"), ("10", "p1 "), ("11", "P1"), (None, "P1"), ("12", "P2"), ("13", "P7")],
            "PMID",
            "PROJECT_NUMBER",
        ),
        "Patents": make(
            [("US1", "P1"), ("US1", "P1"), ("US1", "P1"), ("US2", "P5")],
            "PATENT_ID",
            "PROJECT_NUMBER",
        ),
    }


def test_metrics_stage(spark, grants, tmp_path):
    result, summary = metrics(grants, output=str(tmp_path / "metrics"))
    assert result.columns == [
        "APPLICATION_ID",
        "PROJECT_NUMBER",
        "PROJECT_TITLE",
        "ABSTRACT_TEXT",
        "publication_count",
        "patent_count",
    ]
    rows = {
        (r.APPLICATION_ID, r.ABSTRACT_TEXT): (r.publication_count, r.patent_count)
        for r in result.collect()
    }
    assert rows == {
        ("1", "a1"): (3, 1),
        ("1", "a1b"): (3, 1),
        ("2", None): (3, 1),
        ("3", "a3"): (1, 0),
        ("4", None): (0, 0),
        ("5", None): (0, 1),
    }
    row = summary.first().asDict(recursive=True)
    assert row["linked"]["left_rows"] == 6
    assert row["linked"]["merged_rows"] == 7
    assert row["linked"]["rows_added"] == 1
    assert row["deduplication"] == {
        "unique_duplicate_rows": 1,
        "total_duplicates": 2,
        "extra_duplicates": 1,
    }
    assert row["dimensions"] == {"rows": 6, "columns": 6}
    figures = {
        a["outcome"]: (a["unique_duplicate_rows"], a["total_duplicates"], a["extra_duplicates"])
        for a in row["aggregate_outcomes"]
    }
    assert figures == {"publication_count": (1, 2, 1), "patent_count": (1, 3, 2)}


def test_left_key_can_stay_raw(grants):
    raw = dataclasses.replace(DEFAULT_CONFIG, normalize_left=False)
    table = linked_outcomes(grants, raw)
    assert table.filter("APPLICATION_ID = '3'").first().publication_count == 0


def test_null_ids_meet_only_when_asked(spark):
    prj = spark.createDataFrame(
        [(None, "P1")], "APPLICATION_ID string, PROJECT_NUMBER string"
    )
    absent = spark.createDataFrame([(None, "x")], "APPLICATION_ID string, ABSTRACT_TEXT string")
    tables = {"PRJ": prj, "PRJABS": absent}
    assert linked_outcomes(tables).first().ABSTRACT_TEXT is None
    safe = dataclasses.replace(DEFAULT_CONFIG, null_safe=True)
    assert linked_outcomes(tables, safe).first().ABSTRACT_TEXT == "x"


def test_missing_project_source_is_an_error(grants):
    with pytest.raises(ValueError, match="PRJABS"):
        metrics({"PRJ": grants["PRJ"]})


def test_metrics_without_outcomes(grants):
    result, summary = metrics({k: grants[k] for k in ("PRJ", "PRJABS")})
    assert "publication_count" not in result.columns
    assert result.count() == 6
    assert "aggregate_outcomes" not in summary.columns


def test_link_suffix(spark, grants):
    abstracts = grants["PRJABS"].withColumn("PROJECT_NUMBER", F.lit("other"))
    abstracts = abstracts.withColumn("project_title", F.lit("small"))
    result, _ = metrics({"PRJ": grants["PRJ"], "PRJABS": abstracts})
    assert {"PROJECT_NUMBER_abs", "project_title_abs"} <= set(result.columns)
    assert result.filter("APPLICATION_ID = '2'").first().PROJECT_NUMBER == "P1"


VARIANTS = {
    "CRISPR": "crispr, crisprs",
    "gene therapy": "gene therapy, gene therapys, gene therapies",
    "Cystic Fibrosis": "cystic fibrosis, cystic fibrosises",
    "Friedreich's Ataxia": (
        "friedreich's ataxia, friedreich's ataxias, friedreichs ataxia, friedreichs ataxias"
    ),
    "Bardet-Biedl Syndrome": (
        "bardet-biedl syndrome, bardet-biedl syndromes, bardet biedl syndrome, "
        "bardet biedl syndromes, bardetbiedl syndromes"
    ),
    "Alström Syndrome": "alstrom syndrome, alstrom syndromes",
    " \tRay Box ": "ray box, ray boxs, ray boxes",
    "array": "array, arrays",
    "taxiy": "taxiy, taxiys, taxiies",
}


def test_variants(spark):
    df = spark.createDataFrame([(k,) for k in VARIANTS], "k string")
    found = df.select("k", variant_terms(normalize_keyword(F.col("k"))).alias("t")).collect()
    for row in found:
        assert set(row.t) == set(VARIANTS[row.k].split(", ")), row.k


def test_configured_dictionary(spark):
    counts = {r.category: r.terms for r in tm.dictionary_stats(config_terms(spark)).collect()}
    assert counts == {"treatment": 21, "disease": 159, "pool": 180}


def test_stopword_filter_only_whole_keywords(spark):
    table = tm.keyword_table(spark, {"c": ["The", " of ", "the gene", "gene"]})
    kept = tm.remove_stopwords(table, tm.english_stopwords(spark))
    assert {r.keyword for r in kept.collect()} == {"the gene", "gene"}


KEYWORDS = [
    "gene therapy",
    "CRISPR",
    "ASO",
    "Tay-Sachs Disease",
    "Wilson's Disease",
    "Alström Syndrome",
]
TEXTS = [
    ("CRISPR, crispr and CRISPRs.", 3, ["crispr", "crisprs"]),
    ("gene gene editing gene", 3, ["gene", "gene editing"]),
    ("gene therapies | gene therapy", 2, ["gene therapies", "gene therapy"]),
    ("xaso aso_ aso1 ASO", 1, ["aso"]),
    ("éaso asoé", 2, ["aso"]),
    (
        "Tay-Sachs disease; Tay Sachs diseases; TaySachs disease",
        2,
        ["tay-sachs disease", "tay sachs diseases"],
    ),
    (
        "Wilson's disease Wilsons disease Wilson disease",
        2,
        ["wilson's disease", "wilsons disease"],
    ),
    ("Alström syndrome", 0, []),
    ("gene  therapy", 1, ["gene"]),
    ("crispr-aso", 2, ["crispr", "aso"]),
    ("", 0, []),
    (None, 0, []),
]


@pytest.fixture
def sample_terms(spark):
    expanded = tm.expand_terms(tm.keyword_table(spark, {"c": KEYWORDS}))
    bare = spark.createDataFrame([("c", "gene"), ("c", "gene editing")], "category string, term string")
    return expanded.unionByName(bare)


@pytest.fixture
def sample_texts(spark):
    rows = [(i, t[0]) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id bigint, text string")


def _check_hits(df):
    for row in df.collect():
        _, total, flagged = TEXTS[row.id]
        assert (row.total_count, row.total_unique_count, row.flagged) == (
            total,
            len(flagged),
            flagged,
        ), TEXTS[row.id]


def test_match_by_pattern(sample_texts, sample_terms):
    _check_hits(match.enrich(sample_texts, ["text", "absent"], sample_terms))


@pytest.mark.parametrize("limit", [10**6, 0], ids=["broadcast", "shuffled"])
def test_match_by_join(sample_texts, sample_terms, limit):
    _check_hits(
        match.match_join(sample_texts, concat_text(["text"]), sample_terms, max_broadcast_chars=limit)
    )


@pytest.mark.parametrize("above", [-1, 0, 1])
def test_dictionary_size_changes_nothing(sample_texts, sample_terms, above):
    limit = sample_terms.select("term").distinct().count() + above
    _check_hits(match.enrich(sample_texts, ["text"], sample_terms, max_pattern_terms=limit))


def test_repeated_ids_and_texts(spark):
    rows = [(1, "gene x"), (1, "y gene gene"), (2, "gene x"), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    terms = spark.createDataFrame([("GENE",), ("gene",)], "term string")
    expected = sorted([(1, 1), (1, 2), (2, 1), (None, 0), (3, 0)], key=str)
    for limit in (0, 10):
        found = match.enrich(df, ["text"], terms, max_pattern_terms=limit).collect()
        assert sorted([(r.id, r.total_count) for r in found], key=str) == expected


@pytest.mark.parametrize(
    "keyword, expected",
    [
        ("болезнь", {"болезнь", "болезньs"}),
        ("病気", {"病気", "病気s"}),
        ("™", {"™", "™s"}),
        ("ά-synuclein", {"ά-synuclein", "ά-synucleins", "ά synuclein", "ά synucleins", "άsynucleins"}),
        ("---", {"---", "---s", "   ", "   s"}),
    ],
)
def test_keywords_beyond_latin(spark, keyword, expected):
    found = spark.createDataFrame([(keyword,)], "k string").select(variant_terms(F.col("k"))).first()[0]
    assert set(found) == expected and "s" not in found


def test_folded_text(sample_texts, sample_terms):
    folded = match.enrich(sample_texts, ["text"], sample_terms, fold_text=True)
    assert folded.filter("text = 'Alström syndrome'").first().flagged == ["alstrom syndrome"]


def test_no_text_column_returns_the_input(sample_texts, sample_terms):
    result, summary = keywords(sample_texts, StageConfig(text_columns=("absent",)))
    assert result is sample_texts
    assert summary is None


def test_empty_dictionary(spark, sample_texts):
    nothing = spark.createDataFrame([], "category string, term string")
    for df in (
        match.enrich(sample_texts, ["text"], nothing),
        match.match_join(sample_texts, concat_text(["text"]), nothing),
    ):
        assert df.agg(F.sum("total_count")).first()[0] == 0
        assert df.count() == len(TEXTS)


def test_terms_with_regex_characters(spark):
    terms = ["c++", "a.b", "(x)", "[y]", "p^q", "a-b", "a|b", "$1", "c"]
    texts = ["c++ and c", "a.b axb", "(x) [y] p^q", "a-b a|b $1", "c++x"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    table = spark.createDataFrame([(t,) for t in terms], "term string")
    by_regex = match.match_regex(df, F.col("text"), terms)
    by_join = match.match_join(df, F.col("text"), table)
    expected = [["c++", "c"], ["a.b"], ["(x)", "[y]", "p^q"], ["a-b", "a|b", "$1"], ["c"]]
    assert [r.flagged for r in by_regex.orderBy("id").collect()] == expected
    assert [r.flagged for r in by_join.orderBy("id").collect()] == expected


def test_pattern_is_prefix_factored():
    assert term_pattern(["gene", "genes"]).count("gene") == 1


def test_filter_does_not_repeat_the_match(sample_texts, sample_terms):
    enriched = match.enrich(sample_texts, ["text"], sample_terms)
    kept = enriched.filter("total_unique_count >= 1")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_normalize_key(spark):
    df = spark.createDataFrame([("\t a1 \n",), (" 　x ",), (None,), ("",)], "k string")
    assert [r[0] for r in df.select(normalize_key("k")).collect()] == ["A1", "X", None, ""]


def test_fold_accents(spark):
    texts = ["Ærøskøbing", "straße", "l’été", "plain", "e\u0301", "β-θ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(fold_accents(F.col("t"))).collect()] == [
        "AEroskobing",
        "strasse",
        "l'ete",
        "plain",
        "e",
        "b-th",
    ]


def _write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def _rows(df):
    return {tuple(r) for r in df.collect()}


CSV = (
    b'\xef\xbb\xbf"APPLICATION_ID","T"\n1,a\n2,b,EXTRA\n3\n,"x, y"\n'
    b'5,"multi\nline ""q"""\n6,NA\n7,z,\n'
)


@pytest.mark.parametrize("multi_line", [None, True])
def test_csv_rows(spark, tmp_path, multi_line):
    _write(tmp_path / "PRJ" / "a.csv", CSV)
    files = cs.inspect_files(spark, cs.list_folders(spark, str(tmp_path), ["PRJ"]), {}, multi_line)
    assert files[0].columns == ("APPLICATION_ID", "T")
    assert _rows(cs.read_source(spark, files)) == {
        ("1", "a"),
        ("3", None),
        (None, "x, y"),
        ("5", 'multi\nline "q"'),
        ("6", None),
    }


def test_csv_without_quoted_newlines_is_read_in_splits(spark, tmp_path):
    _write(tmp_path / "S" / "a.csv", 'K,V\n1,"caf\xe9, ""x"""\n2\n3,a,b\n4,a,\n'.encode("latin1"))
    files = cs.inspect_files(spark, cs.list_folders(spark, str(tmp_path), ["S"]))
    assert files[0].parse == cs.SPLITS
    expected = {("1", 'caf\xe9, "x"'), ("2", None)}
    assert _rows(cs.read_source(spark, files)) == expected
    assert cs.read_source(spark, files).count() == 2


def _span_lines(pick, source):
    cells = ["x", "", '"a, ""b"""', '"l1\nl2\n\nl""4"', "caf\xe9", "NA"]
    lines = []
    for i in range(60):
        row = [str(source * 1000 + i), pick.choice(cells), pick.choice(cells)]
        lines.append(",".join([row[:2], row, row, row, [*row, "over"]][pick.randrange(5)]))
    return ["ID,U,W", *lines[:5], "", *lines[5:]]


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
def test_blank_lines_in_every_parser(spark, tmp_path, end):
    """Leading blank lines, lines of spaces, and cells of spaces: one answer, however the file is parsed."""
    lines = ["", " ", "K,V", "1,b", "   ", "2,c", "\t", "3", "4,d,EXTRA", "  ,", '" ",', '" "']
    _write(tmp_path / "S" / "f.csv", (end.join(lines) + end).encode("latin1"))
    folders = cs.list_folders(spark, str(tmp_path), ["S"])
    expected = [("1", "b"), ("2", "c"), ("3", None), ("  ", None), (" ", None), (" ", None)]
    for multi_line in (True, False, None):
        files = cs.inspect_files(spark, folders, multi_line=multi_line)
        rows = [tuple(r) for r in cs.read_source(spark, files).collect()]
        assert sorted(rows, key=str) == sorted(expected, key=str), multi_line


def test_one_column_keeps_quoted_white_space(spark, tmp_path):
    _write(tmp_path / "S" / "f.csv", b'K\n1\n" "\n  \n\n2,\n"3,4"\n"  "\n')
    folders = cs.list_folders(spark, str(tmp_path), ["S"])
    for multi_line in (True, False):
        scanned = cs.scan_source(spark, cs.inspect_files(spark, folders, multi_line=multi_line))
        assert sorted(r.K for r in cs.rows_of(scanned).collect()) == [" ", "  ", "1", "3,4"]
        assert [(r.text.strip(), r.reason) for r in cs.rejected_of(scanned).collect()] == [("2,", "too many cells")]


@pytest.mark.parametrize("seed", range(4))
def test_parsers_agree_on_random_cells(spark, tmp_path, seed):
    """Files without line breaks in cells give the same rows and rejected records in splits and as a whole."""
    pick = random.Random(seed)
    cells = ["", "a", " ", "  b", '"q"', '""', '" "', '"x, y"', '"d""e"', "NA", "caf\xe9", "\t"]
    ends = pick.choice(["\n", "\r\n", "\r"])
    lines = [",".join(pick.choice(cells) for _ in range(pick.randrange(1, 5))) for _ in range(80)]
    _write(tmp_path / "S" / "f.csv", ends.join(["K,U,V", *lines, ""]).encode("latin1"))
    folders = cs.list_folders(spark, str(tmp_path), ["S"])
    found = []
    for multi_line in (True, False):
        scanned = cs.scan_source(spark, cs.inspect_files(spark, folders, multi_line=multi_line))
        rows = sorted((tuple(r) for r in cs.rows_of(scanned).collect()), key=str)
        found.append((rows, sorted(r.text.strip("\r\n") for r in cs.rejected_of(scanned).collect())))
    assert found[0] == found[1]
    assert len(found[0][0]) + len(found[0][1]) == sum(bool(x.strip()) for x in lines)


def test_header_scan_needs_one_job(spark, tmp_path):
    _write(tmp_path / "S" / "empty.csv", b"")
    _write(tmp_path / "S" / "header.csv", b"K,V\n\n  \n")
    _write(tmp_path / "S" / "long.csv", b"K,V\n1,2,3\n4,5,\n")
    _write(tmp_path / "S" / "spanning long.csv", b'K,V\n"1\n2",2,3\n')
    _write(tmp_path / "S" / "spanning.csv", b'K,V\n"1\n2",2,3\n"4\n",5\n')
    _write(tmp_path / "S" / "broken header.csv", b'"K\nL",V\n1,2\n')
    folders = cs.list_folders(spark, str(tmp_path), ["S"])
    found = {f.path.rsplit("/", 1)[1]: (f.columns, f.parse) for f in cs.inspect_files(spark, folders)}
    assert found == {
        "spanning.csv": (("K", "V"), cs.WHOLE),
        "broken%20header.csv" if "broken%20header.csv" in found else "broken header.csv": (("K\nL", "V"), cs.WHOLE),
    }
    jobs = []
    for n in (2, 30):
        for i in range(n):
            _write(tmp_path / f"T{n}" / f"f{i}.csv", b"K,V\n1,2\n")
        folders = cs.list_folders(spark, str(tmp_path), [f"T{n}"])
        spark.sparkContext.setJobGroup(f"headers {n}", "headers")
        try:
            assert len(cs.inspect_files(spark, folders)) == n
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers {n}")))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] <= 3  # the stages of one query


def test_rejected_records_are_stored_and_counted(spark, tmp_path):
    _write(tmp_path / "raw" / "PRJ" / "a.csv", b'A,B\n1,x\n2,y,z\n"3\n4",q,r\n5\n')
    _write(tmp_path / "raw" / "PUB" / "b.csv", b"C\n1\n")
    for output in (None, str(tmp_path / "out")):
        tables, summary = preprocess(spark, str(tmp_path / "raw"), output=output)
        assert _rows(tables["PRJ"]) == {("1", "x"), ("5", None)}
        load = {r.source: (r.total_rows, r.rejected_records) for r in summary.first().initial_load}
        assert load == {"PRJ": (2, 2), "PUB": (1, 0)}
    stored = tb.read_snapshot(spark, str(tmp_path / "out"), ["PRJ", "PUB"])
    assert _rows(stored["PRJ"]) == {("1", "x"), ("5", None)} and stored["PUB"].columns == ["C"]
    rejected = tb.read_rejected(spark, str(tmp_path / "out"), "PRJ").collect()
    assert {r.text.strip() for r in rejected} == {"2,y,z", '"3\n4",q,r'}
    assert all(r.path.endswith("a.csv") and r.reason == "too many cells" for r in rejected)


@pytest.mark.parametrize(
    "values, kind",
    [
        (["1", "-2", None, "007"], "bigint"),
        (["1", "2.5"], "double"),
        ([".5", "1e3", "-4."], "double"),
        (["1", "x"], "string"),
        (["1d", "2f"], "string"),
        (["True", "false"], "boolean"),
        (["True", "1"], "string"),
        (["99999999999999999999"], "string"),
        (["99999999999999999999", "1.5"], "string"),
        (["NaN", "1"], "string"),
        ([None, None], "string"),
    ],
)
def test_column_types(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = ty.column_types(df)
    assert found == {"v": kind}
    cast = ty.typed(df, found)
    assert cast.schema["v"].dataType.simpleString() == kind
    assert cast.filter("v is null").count() == values.count(None)


def test_types_are_agreed_on_over_files(spark, tmp_path):
    _write(tmp_path / "PRJ" / "a.csv", b"ID,N,T\n1,2,3\n")
    _write(tmp_path / "PRJ" / "b.csv", b"ID,N,T\n4,5.5,x\n,NA,\n")
    tables, _ = preprocess(spark, str(tmp_path), StageConfig(infer_types=True))
    assert [f.dataType.simpleString() for f in tables["PRJ"].schema] == ["bigint", "double", "string"]
    assert _rows(tables["PRJ"]) == {(1, 2.0, "3"), (4, 5.5, "x"), (None, None, None)}


def test_names_that_differ_by_case(spark, tmp_path):
    _write(tmp_path / "S" / "f.csv", b"K,k,V\n1,2,3\n")
    files = cs.inspect_files(spark, cs.list_folders(spark, str(tmp_path), ["S"]))
    table = cs.read_source(spark, files)
    assert table.columns == ["K", "k.1", "V"] and tuple(table.first()) == ("1", "2", "3")


@pytest.mark.parametrize("multi_line", [None, True])
@pytest.mark.parametrize("seed", [11, 12])
def test_csv_rows_agree_with_pandas(spark, tmp_path, seed, multi_line):
    lines = _span_lines(random.Random(seed), 1)
    lines.insert(1, "0,first,row")  # the first row decides how many cells pandas expects
    _write(tmp_path / "S" / "a.csv", ("\n".join(lines) + "\n").encode("latin1"))
    files = cs.inspect_files(
        spark, cs.list_folders(spark, str(tmp_path), ["S"]), multi_line=multi_line
    )
    theirs = pd.read_csv(
        tmp_path / "S" / "a.csv", encoding="latin1", on_bad_lines="skip", dtype=str
    ).astype(object)
    expected = {tuple(None if pd.isna(v) else v for v in row) for row in theirs.values}
    assert len(expected) > 30
    assert _rows(cs.read_source(spark, files)) == expected


def test_header_cleanup():
    assert cs.clean_header(["A", "A", "B", None]) == ("A", "A.1", "B", "Unnamed: 3")
    assert cs.clean_header(['ï»¿"X"', "﻿Y", '"Z"']) == ("X", "Y", "Z")


def test_rename_refuses_two_columns_with_one_name():
    names = {"a": "k", "b": "k"}
    assert cs.rename_header(["a", "c"], names) == ("k", "c")
    with pytest.raises(ValueError, match="k"):
        cs.rename_header(["a", "b"], names)


def test_schema_drift():
    drift = ap.schema_drift([["K", "V"], ["K", "Z"]], force_append=False)
    assert drift.unexpected == ("V", "Z")
    assert drift.skipped
    assert not ap.schema_drift([["K", "V"], ["K", "Z"]], force_append=True).skipped
    assert not ap.schema_drift([["K"], ["K"]], force_append=False).skipped
    by_case = ap.schema_drift([["id", "Name"], ["id", "NAME"]], force_append=False)
    assert by_case.all_columns == ("id", "Name") and not by_case.unexpected and not by_case.skipped


def _source_tree(root):
    _write(
        root / "PRJ" / "y1.csv",
        b"APPLICATION_ID,CORE_PROJECT_NUM,PROJECT_TITLE\n1,P1,Gene therapy\n2,P2,x\n",
    )
    _write(root / "PRJ" / "y2.csv", b"APPLICATION_ID,CORE_PROJECT_NUM,PHR\nA1,P1,crispr\n")
    _write(root / "PRJ" / "empty.csv", b"APPLICATION_ID,OTHER\n")
    _write(root / "PRJABS" / "y1.csv", b'APPLICATION_ID,ABSTRACT_TEXT\n1,"long\ntext on ASO"\n')
    _write(root / "PUBLINK" / "y1.csv", b"PMID,PROJECT_NUMBER\n7,p1\n8,P1\n")
    _write(root / "Patents" / "y1.csv", b"PATENT_ID,PROJECT_ID\nUS1,P2\n")
    _write(root / "PUB" / "y1.csv", b"")
    (root / "ClinicalStudies").mkdir()


def test_preprocess_stage(spark, tmp_path):
    _source_tree(tmp_path / "raw")
    tables, summary = preprocess(spark, str(tmp_path / "raw"), output=str(tmp_path / "out"))
    assert set(tables) == {"PRJ", "PRJABS", "PUBLINK", "Patents"}
    assert _rows(tables["PRJ"]) == {
        ("1", "P1", "Gene therapy", None),
        ("2", "P2", "x", None),
        ("A1", "P1", None, "crispr"),
    }
    row = summary.first().asDict(recursive=True)
    status = {s["source"]: (s["status"], s["file_count"]) for s in row["sources"]}
    assert status["ClinicalStudies"] == ("empty", 0)
    assert status["PUB"] == ("ok", 1)
    assert status["PRJ"] == ("ok", 3)
    appended = {a["source"]: a for a in row["appended"]}
    assert appended["PRJ"]["file_count"] == 2
    assert appended["PRJ"]["total_rows"] == 3
    assert appended["PRJ"]["unexpected_columns"] == ["PHR", "PROJECT_TITLE"]
    assert appended["PUB"]["file_count"] == 0
    assert appended["PUB"]["total_rows"] == 0
    loaded = {a["source"]: a for a in row["initial_load"]}
    assert loaded["PRJ"]["total_rows"] == 3
    assert {(r["file"], r["old"]) for r in row["columns_renamed"]} == {
        ("y1", "CORE_PROJECT_NUM"),
        ("y2", "CORE_PROJECT_NUM"),
        ("y1", "PROJECT_ID"),
    }
    assert row["dimensions"] == {"total_rows": 7, "total_columns": 7}
    stored = tb.read_snapshot(spark, str(tmp_path / "out"), ["PRJ", "PUB"])
    assert list(stored) == ["PRJ"]


def test_preprocess_skips_drifting_sources(spark, tmp_path):
    _source_tree(tmp_path / "raw")
    strict = dataclasses.replace(DEFAULT_CONFIG, force_append=False)
    tables, summary = preprocess(spark, str(tmp_path / "raw"), strict)
    assert "PRJ" not in tables
    appended = {a["source"]: a for a in summary.first().asDict(recursive=True)["appended"]}
    assert appended["PRJ"]["skipped"]
    assert appended["PRJ"]["total_rows"] == 0


def test_four_stages(spark, tmp_path):
    _source_tree(tmp_path / "raw")
    _write(
        tmp_path / "raw" / "PRJ" / "y3.csv",
        b"APPLICATION_ID,CORE_PROJECT_NUM,PROJECT_TERMS\n5,P9,nothing\n5,P9,nothing\n",
    )
    tables, _ = preprocess(spark, str(tmp_path / "raw"), output=str(tmp_path / "s1"))
    projects, _ = metrics(tables, output=str(tmp_path / "s2"))
    enriched, summary = keywords(projects, output=str(tmp_path / "s3"))
    row = summary.first().asDict(recursive=True)
    library = {r["category"]: r["terms"] for r in row["keyword_library"]}
    assert library == {"treatment": 21, "disease": 159, "pool": 180}
    assert row["enrichment_metrics"]["total_keyword_hits"] == 3
    assert row["enrichment_metrics"]["rows_with_hits_pct"] == 50.0
    assert [t["term"] for t in row["top_flagged_terms"]] == ["aso", "crispr", "gene therapy"]
    assert {r["terms"] for r in row["keyword_library"] if r["category"] != "pool"} == {21, 159}
    retained, dropped, figures = mlexport(enriched, output=str(tmp_path / "s4"))
    assert {r.APPLICATION_ID for r in retained.collect()} == {"1", "A1"}
    assert {r.APPLICATION_ID for r in dropped.collect()} == {"2", "5"}
    tb.export_summary(figures, str(tmp_path / "summary"))
    stored = spark.read.text(str(tmp_path / "summary")).collect()
    assert len(stored) == 1
    assert json.loads(stored[0][0])["filter_summary"]["percent_dropped"] == 50.0
    export_stage_csv(retained, str(tmp_path / "csv"))
    header = spark.read.option("header", True).option("multiLine", True).csv(str(tmp_path / "csv"))
    assert "total unique count" in header.columns


def test_split_guards(spark, sample_texts):
    with pytest.raises(ValueError, match="total_unique_count"):
        split.split_by_cutoff(sample_texts, 1, ["id"])
    with pytest.raises(ValueError, match="no training columns"):
        split.split_by_cutoff(sample_texts, 1, [])


def test_split_puts_null_counts_nowhere(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, None)], "id bigint, total_unique_count bigint")
    retained, dropped = split.split_by_cutoff(df, 1, ["id"])
    assert (retained.count(), dropped.count()) == (1, 1)
    row = split.split_stats(df, 1, "id").first()
    assert (row.total_input_rows, row.percent_retained, row.retained_min_id) == (3, 33.33, 2)


def test_empty_tables_give_null_shares(spark):
    df = spark.createDataFrame(
        [], "id bigint, total_count bigint, total_unique_count bigint, flagged array<string>"
    )
    assert stats.enrichment_stats(df).first().rows_with_hits_pct is None
    assert split.split_stats(df, 1).first().percent_retained is None


def test_null_items_count_once(spark):
    df = spark.createDataFrame([("p", None), ("p", None), ("p", "x")], "k string, i string")
    assert outcomes.count_unique_pairs(df, "k", "i", "n").first().n == 2


def test_missing_export_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        cs.read_table_csv(spark, str(tmp_path / "absent"), "a string").count()


def test_scratch_folder():
    from types import SimpleNamespace

    from grantweave.session import shared_dir

    def session(master, folder):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda *_: folder),
            sparkContext=SimpleNamespace(master=master, applicationId=f"{master}-{folder}"),
        )

    assert shared_dir(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("local[2]", None)) == shared_dir(session("local[2]", None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn", None))


def test_mlexport_summary_does_not_match_again(spark, sample_texts, sample_terms, tmp_path):
    config = StageConfig(ml_columns=("id", "total_unique_count"), cutoff_value=1)
    enriched = match.enrich(sample_texts, ["text"], sample_terms)
    for drop in (True, False):
        config = StageConfig(ml_columns=("id", "total_unique_count"), cutoff_value=1, export_drop_output=drop)
        retained, dropped, summary = mlexport(enriched, config, str(tmp_path / str(drop)), row_id="id")
        plan = summary._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in plan
        expected = mlexport(enriched, config, row_id="id")
        assert summary.collect() == expected[2].collect()
        assert retained.exceptAll(expected[0]).count() == expected[0].exceptAll(retained).count() == 0
        assert dropped.count() == expected[1].count()


def test_terms_used_is_a_table_of_any_size(spark, sample_texts):
    many = spark.range(6_000).select(F.lit("c").alias("category"), F.concat(F.lit("t"), "id").alias("term"))
    _, summary = keywords(sample_texts, StageConfig(text_columns=("text",)), terms=many)
    assert "terms_used" not in summary.columns
    assert {(r.category, r.terms) for r in summary.first().keyword_library} == {("c", 6_000), ("pool", 6_000)}
    assert terms_used(many.union(many)).count() == 6_000


def _transliterated(text):
    """The longest sequence first, code point by code point."""
    table, longer = spellings(), sequences()
    out, i = "", 0
    while i < len(text):
        for n in range(3, 0, -1):
            part = text[i : i + n]
            if len(part) == n and (part in longer or (n == 1 and part in table)):
                out += table[longer.get(part, part)]
                i += n
                break
        else:
            out += text[i]
            i += 1
    return out


def test_transliteration(spark):
    table = spellings()
    assert len(table) > 3_000 and all(v.isascii() for v in table.values())
    texts = [f"x{c}{v}y" for c, v in table.items()] + [f"{s}и" for s in sequences()]
    pick = random.Random(1)
    letters = [*table, *sequences(), "a", " ", "病", "\u0301"]
    texts += ["".join(pick.choice(letters) for _ in range(20)) for _ in range(300)]
    df = spark.createDataFrame([(t, _transliterated(t)) for t in texts], "t string, e string")
    assert df.filter(~fold_accents(F.col("t")).eqNullSafe(F.col("e"))).collect() == []


@pytest.mark.parametrize(
    "text, expected",
    [
        ("άλφα", "alpha"), ("болезнь", "bolezn'"), ("ﬁbrosis", "fibrosis"), ("Щёлково", "Shchiolkovo"),
        ("е\u0308", "io"), ("Ἀθήνα", "Athena"), ("𝐀𝟏", "A1"), ("½ ㎏", "1/2 kg"), ("病気 ok", "病気 ok"),
        ("´", "´"), ("a\U0010f000b é", "ab e"), (None, None), ("", ""),
    ],
)
def test_transliterated_words(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t string").select(fold_accents(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize("min_rows", [1, 3, 6, 50])
def test_frequent_pairs(spark, min_rows):
    pick = random.Random(min_rows)
    rows = [[pick.choice("abcdefgh") for _ in range(pick.randrange(5))] for _ in range(60)]
    df = spark.createDataFrame([(r,) for r in rows] + [(None,)], "flagged array<string>")
    expected = Counter(p for r in rows for p in combinations(sorted(set(r)), 2))
    found = stats.frequent_pairs(df, min_rows).collect()
    assert {(r.term_a, r.term_b): r.row_count for r in found} == {p: n for p, n in expected.items() if n >= min_rows}


def test_profiles_merge_within_their_error(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 4).cast("string").alias("year"),
        (F.col("id") % 7_000).alias("k"),
        F.when(F.col("id") % 3 > 0, F.repeat(F.lit("x"), (F.col("id") % 100).cast("int"))).alias("t"),
        F.lit(None).cast("string").alias("none"),
    )
    parts = stats.column_sketches(df, ["k", "t", "none"], "year")
    assert parts.count() == 12
    merged = {r.column_name: r for r in stats.merged_profile(parts).collect()}
    assert abs(merged["k"].distinct_estimate - 7_000) < 0.08 * 7_000
    assert abs(merged["t"].distinct_estimate - 100) <= 2 and 45 <= merged["t"].median_length <= 55
    assert (merged["t"].row_count, merged["t"].null_count) == (20_000, 6_667)
    assert (merged["none"].distinct_estimate, merged["none"].median_length) == (0, None)
    whole = stats.merged_profile(stats.column_sketches(df, ["k"])).first()
    assert whole.distinct_estimate == merged["k"].distinct_estimate


def test_row_positions(spark, tmp_path):
    spark.range(0, 1_000, 1, 7).write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        placed = tb.read_with_positions(spark, str(tmp_path / "t"))
        assert placed.filter("id != row_position").count() == 0 and placed.count() == 1_000
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.range(0).write.parquet(str(tmp_path / "none"))
    assert tb.read_with_positions(spark, str(tmp_path / "none")).count() == 0


def test_tables_stored_by_key_are_not_shuffled_again(spark, tmp_path):
    """Link, duplicates and counts by the key read the buckets in place, also in a session that opens the table."""
    left = spark.range(3_000).select(
        F.concat(F.lit(" k"), F.col("id") % 700).alias("K"), F.col("id").alias("a b"), F.lit("x").alias("S")
    )
    right = spark.range(900).select(F.concat(F.lit("K"), F.col("id") % 800, F.lit(" ")).alias("K"), F.lit(1).alias("r"))
    expected = link.link_left(left, right.distinct(), "K")
    for name, df, n in (("left", left, 8), ("right", right, 4)):
        kd.write_linkable(df, str(tmp_path / name), "K", n)
    a, b = (kd.open_keyed(spark, str(tmp_path / name)) for name in ("left", "right"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
    try:
        linked = link.link_left(a, b.distinct(), "K", normal=True)
        counts = a.distinct().groupBy("K").count()
        for df, exchanges in ((counts, 0), (b.distinct(), 0), (link.link_left(a, a.select("K").distinct(), "K", normal=True), 0)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == exchanges, plan
        # Only the smaller of two tables with unlike numbers of buckets moves.
        assert linked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
        assert linked.exceptAll(expected).count() == expected.exceptAll(linked).count() == 0
        assert counts.count() == 700
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.bucketing.coalesceBucketsInJoin.enabled")
    assert kd.buckets_for(left) in {1 << i for i in range(16)}


def test_stored_abstracts_are_linked_in_place(spark, grants, tmp_path):
    tables = stored_links(grants, str(tmp_path), 4)
    expected, figures = metrics(grants)
    found, same = metrics(tables, output=str(tmp_path / "out"), normal=True)
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0
    assert same.first() == figures.first()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = linked_outcomes(tables, normal=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Projects move for their counts and come back; abstracts stay.
    assert plan.count("Exchange hashpartitioning(APPLICATION_ID") <= 1
    assert "Exchange hashpartitioning(_right_0" not in plan


def test_stored_tables_have_buckets_by_size(spark, monkeypatch):
    """A bucket, which one task holds, does not grow with the table."""
    for n in (20, 25, 30, 33):
        ids = spark.range(1 << n)  # eight bytes a row
        assert kd.buckets_for(ids) * 16 * 1024**2 >= 8 << n
        assert kd.buckets_for(ids) >= 8
    sf = "/root/testdata/sf0.001"
    expected = queries.project_outcomes(spark, sf)
    monkeypatch.setattr(kd, "BUCKET_BYTES", 10_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = queries.project_outcomes_stored(spark, sf)
        for df in (found, queries.link_stored(spark, sf)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert max(map(int, re.findall(r"SelectedBucketsCount: \d+ out of (\d+)", plan))) > 8, plan
        assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
