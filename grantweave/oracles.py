"""DuckDB twins of the queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

import re

from grantweave.plans.config import DISEASES, TREATMENTS
from grantweave.queries import CUTOFF, LINE_ORDER, PAIR_ROWS, TEXT_TERMS


def _alternation(terms) -> str:
    """Flat longest-first pattern; this engine's ``\\b`` is ASCII."""
    ordered = sorted(set(terms), key=lambda t: (-len(t), t))
    return r"\b(?:" + "|".join(re.sub(r"([^\w\s])", r"\\\1", t) for t in ordered) + r")\b"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plural_forms(keyword: str) -> set[str]:
    """The variant rules restated for the configured lists (one of them has an umlaut)."""
    word = keyword.lower().replace("ö", "o")
    bare = "".join(c for c in word if c.isalnum() or c in "_ ")
    forms = {word, word.replace("'s", "s")}
    if word[-1] != "s":
        forms.add(word + "s")
    if "-" in word:
        forms |= {word.replace("-", " "), word.replace("-", " ") + "s"}
    if re.search("[^aeou]y$", bare):
        forms.add(bare[:-1] + "ies")
    elif re.search("(s|x|z|ch|sh)$", bare):
        forms.add(bare + "es")
    else:
        forms.add(bare + "s")
    return forms


def _hits(text: str, terms, source: str = "documents", carry: str = "doc_id") -> str:
    """``carry`` columns, hits and distinct hits in order of first occurrence."""
    return f"""
        select {carry}, k, list_filter(k, lambda x, i: list_position(k, x) = i) as u
        from (select {carry}, regexp_extract_all({text}, {_quoted(_alternation(terms))}) as k
              from {source})"""


_DOC_HITS = _hits("lower(text)", TEXT_TERMS)
_COUNTS = """doc_id, len(k)::bigint as total_count, len(u)::bigint as total_unique_count,
             array_to_string(u, '|') as flagged"""

_PEOPLE = """
    select c_custkey as id, c_name as name, c_mktsegment as segment, null::double as balance
    from customer
    union all
    select s_suppkey, s_name, null, s_acctbal from supplier"""

_TERM_ROWS = ", ".join(
    f"({_quoted('phrase' if ' ' in t else 'word')}, {_quoted(t)})" for t in TEXT_TERMS
) + ", ('word', 'de la')"

_DUPLICATE_FIGURES = """
    count_if(n > 1)::bigint as unique_duplicate_rows,
    coalesce(sum(n) filter (n > 1), 0)::bigint as total_duplicates,
    coalesce(sum(n - 1), 0)::bigint as extra_duplicates"""

_NORMAL = r"upper(regexp_replace({}, '^\s+|\s+$', '', 'g'))"

_PART_TERMS = r"""
    k as (
        select distinct p_type as category, strip_accents(lower(trim(case p_type
            when 'ECONOMY' then upper(p_name)
            when 'SMALL' then replace(p_name, ' ', '-')
            when 'MEDIUM' then replace(p_name, ' ', '''s ')
            when 'LARGE' then p_name || ' thérapy'
            when 'PROMO' then p_name || ' öesophagus'
            else p_name || '-ray' end))) as o
        from part),
    c as (select *, regexp_replace(o, '[^\w\s]', '', 'g') as b from k),
    terms as (
        select category, o as term from c
        union select category, o || 's' from c where not o like '%s'
        union select category, replace(o, '''s', 's') from c where o like '%''s%'
        union select category, replace(o, '-', ' ') from c where o like '%-%'
        union select category, replace(o, '-', ' ') || 's' from c where o like '%-%'
        union select category, case
            when regexp_matches(b, '[^aeou]y$') then regexp_replace(b, 'y$', 'ies')
            when regexp_matches(b, '(s|x|z|ch|sh)$') then b || 'es'
            else b || 's' end from c)"""

_LINE_KEYS = ", ".join(LINE_ORDER)
_FLAGS = f"""
    select {_LINE_KEYS},
        count(*) over (partition by l_partkey, l_suppkey) > 1 as dup_all,
        row_number() over (partition by l_partkey, l_suppkey order by {_LINE_KEYS}) > 1 as dup_extra
    from lineitem"""

_GRANTS = """
    prj as (
        select o_orderkey::varchar as "APPLICATION_ID", ' p' || o_custkey as "PROJECT_NUMBER",
               o_orderpriority as "PROJECT_TITLE"
        from orders),
    abstracts as (
        select l_orderkey::varchar as "APPLICATION_ID",
               l_returnflag || ' ' || l_linestatus as "ABSTRACT_TEXT"
        from lineitem),
    linked as (select p.*, a."ABSTRACT_TEXT" from prj p left join abstracts a using ("APPLICATION_ID")),
    links as (
        select 'publication_count' as outcome, 'P' || user_id as project, upper(event_type) as item
        from events
        union all
        select 'patent_count', 'P' || l_suppkey, nullif(l_partkey::varchar, '1') from lineitem
        union all
        select 'clinical_study_count', 'P' || c_nationkey, c_mktsegment from customer),
    pairs as (select outcome, project, item, count(*) as n from links group by all),
    per_project as (
        select project,
            count_if(outcome = 'publication_count') as pub,
            count_if(outcome = 'patent_count') as pat,
            count_if(outcome = 'clinical_study_count') as cli
        from pairs group by project),
    full_rows as (
        select l.*, coalesce(pub, 0)::bigint as publication_count,
            coalesce(pat, 0)::bigint as patent_count, coalesce(cli, 0)::bigint as clinical_study_count
        from linked l left join per_project c on upper(trim(l."PROJECT_NUMBER")) = c.project)"""


def _attach(table: str, key: str, other: str, link: str, key2: str, item: str, name: str) -> str:
    return f"""
        select {key}, {other}, coalesce(n, 0)::bigint as {name}
        from {table} left join (
            select {key2} as k, count(*) as n
            from (select distinct {key2}, {item} from {link}) group by 1) on k = {key}"""


_ENRICHMENT = """
    count(*)::bigint as total_rows_processed,
    sum(len(k))::bigint as total_keyword_hits,
    round(avg(len(k)), 2) as avg_hits_per_row,
    round(avg(len(u)), 2) as avg_unique_per_row,
    count_if(len(k) > 0)::bigint as rows_with_hits,
    round(count_if(len(k) > 0) / count(*) * 100, 2) as rows_with_hits_pct,
    count_if(len(k) = 0)::bigint as rows_without_hits,
    round(count_if(len(k) = 0) / count(*) * 100, 2) as rows_without_hits_pct,
    count_if(len(u) > 0)::bigint as rows_flagged"""

_TOP = """
    select t as term, count(*)::bigint as row_count
    from (select unnest(u) as t from h) group by 1 order by 2 desc, 1"""

_SPLIT = f"""
    count(*)::bigint as total_input_rows,
    count_if(len(u) >= {CUTOFF})::bigint as total_retained_rows,
    count_if(len(u) < {CUTOFF})::bigint as total_dropped_rows,
    round(count_if(len(u) >= {CUTOFF}) / count(*) * 100, 2) as percent_retained,
    round(count_if(len(u) < {CUTOFF}) / count(*) * 100, 2) as percent_dropped"""


def all_sql() -> dict[str, str]:
    configured = set().union(*map(_plural_forms, (*TREATMENTS, *DISEASES)))
    return {
        "ml_export": f"""
            select doc_id, lang, total_count, total_unique_count, flagged from (
                select {_COUNTS}, lang from ({_hits(
                    "concat_ws(' | ', lower(source), lower(lang), lower(text))",
                    configured | set(TEXT_TERMS), carry="doc_id, lang")}))
            where total_unique_count >= {CUTOFF}""",
        "csv_scan": r"""
            select c_custkey::varchar as c_custkey,
                case when c_acctbal < 0 or c_mktsegment = 'HOUSEHOLD' then null
                     when c_mktsegment = 'BUILDING' then 'a' || chr(10) || 'b, "c"'
                     else c_name end as c_name,
                case when c_acctbal < 0 then null else c_mktsegment end as c_mktsegment
            from customer where c_mktsegment <> 'FURNITURE'""",
        "source_presence": """
            select 'customer' as source, 'ok' as status, count(*) > 0 as has_files from customer
            union all select 'supplier', 'ok', count(*) > 0 from supplier
            union all select 'absent', 'missing', false""",
        "load_audit": """
            select 'region' as source, count(*)::bigint as total_rows, 0::bigint as rejected_records from region
            union all select 'nation', count(*), 0 from nation
            union all select 'customer', count(*) filter (c_mktsegment <> 'FURNITURE'),
                count(*) filter (c_mktsegment = 'FURNITURE') from customer""",
        "rejected_records": """
            select c_custkey || ',' || c_name || ',EXTRA' as text, 'too many cells' as reason
            from customer where c_mktsegment = 'FURNITURE'""",
        "typed_append": """
            select p_partkey::bigint as k, p_size::double as n, p_name as t, 'bigint|double|string' as types from part
            union all
            select s_suppkey::bigint, s_acctbal, s_nationkey::varchar, 'bigint|double|string' from supplier""",
        "drift_by_case": """
            select 'both' as source, (2 * count(*))::bigint as total_rows, 3::bigint as total_columns,
                0::bigint as unexpected_columns_added, false as skipped from customer""",
        "absent_outcome": f"""
            with {_GRANTS} select patent_count, count(*)::bigint as projects, false as has_publications,
                true as refused_without_abstracts
            from (select distinct * exclude (publication_count) from full_rows) group by 1""",
        "keyword_scripts": """
            select p_partkey, lower(case p_type
                when 'PROMO' then p_name || ' fibrofluff alpha'
                when 'ECONOMY' then p_name when 'SMALL' then p_name when 'MEDIUM' then p_name
                when 'LARGE' then p_name
                else p_name || ' bolezn'' shchio' end) as keyword
            from part""",
        "keyword_hits_shuffled": f"select {_COUNTS} from ({_DOC_HITS})",
        "frequent_pairs": f"""
            with h as ({_DOC_HITS}), f as (select doc_id, unnest(u) as t from h)
            select a.t as term_a, b.t as term_b, count(*)::bigint as row_count
            from f a join f b on a.doc_id = b.doc_id and a.t < b.t group by 1, 2
            having count(*) >= {PAIR_ROWS}""",
        "merged_profile": " union all ".join(
            f"""select '{c}' as column_name, count(*)::bigint as row_count,
                count_if({v} is null)::bigint as null_count,
                min(length({v}::varchar))::bigint as min_length,
                max(length({v}::varchar))::bigint as max_length, true as distinct_within_error from documents"""
            for c, v in (
                ("doc_id", "doc_id"),
                ("lang", "nullif(lang, 'de')"),
                ("source", "source"),
                ("text", "text"),
            )
        ),
        "terms_used": f"with {_PART_TERMS} select distinct category, term from terms",
        "split_positions": f"""
            select {_SPLIT},
                min(p) filter (len(u) >= {CUTOFF}) as retained_min_id,
                max(p) filter (len(u) >= {CUTOFF}) as retained_max_id,
                min(p) filter (len(u) < {CUTOFF}) as dropped_min_id,
                max(p) filter (len(u) < {CUTOFF}) as dropped_max_id
            from ({_hits("lower(text)", TEXT_TERMS,
                         "(select text, row_number() over (order by doc_id) - 1 as p from documents)", "p")})""",
        "column_guard": """
            select count(*)::bigint as rows, 5::bigint as "columns",
                'total_unique_count|absent|flagged' as missing, true as refused from documents""",
        "rename_audit": """
            select 'customer' as source, 'c_custkey' as old, 'custkey' as new from customer
            union select 'supplier', 's_suppkey', 'suppkey' from supplier""",
        "snapshot_round_trip": """
            select 'customer' as source, c_custkey as id, c_name as name from customer
            union all select 'supplier', s_suppkey, s_name from supplier""",
        "csv_export": f"""
            select doc_id, len(k)::bigint as total_count, len(u)::bigint as total_unique_count,
                '[' || array_to_string(list_transform(u, lambda x: '"' || x || '"'), ',') || ']'
                    as flagged
            from ({_DOC_HITS})""",
        "split_write": f"""
            select {_COUNTS}, case when len(u) >= {CUTOFF} then 'retained' else 'dropped' end as side
            from ({_DOC_HITS})""",
        "split_write_retained": f"""
            select doc_id, total_count, d.n as total_dropped_rows, 0::bigint as exported_dropped_rows
            from (select {_COUNTS}, len(u) as kept from ({_DOC_HITS})),
                (select count_if(len(u) < {CUTOFF})::bigint as n from ({_DOC_HITS})) d
            where kept >= {CUTOFF}""",
        "summary_json": f"""
            select 'doc_id|total_count|total_unique_count|flagged' as ml_columns_used,
                {CUTOFF}::bigint as cutoff_value, {_SPLIT}, 4::bigint as total_columns,
                count_if(len(u) < {CUTOFF})::bigint as exported_dropped_rows
            from ({_DOC_HITS})""",
        "rename_columns": """
            select c_custkey as "PROJECT_NUMBER", c_name as "PROJECT_TITLE", c_nationkey, c_acctbal,
                c_mktsegment from customer""",
        "key_normalize": rf"""
            select p_partkey,
                {_NORMAL.format("chr(9) || ' ' || lower(p_brand) || ' ' || chr(10)")} as brand_key
            from part""",
        "append_by_name": _PEOPLE,
        "append_type_widen": """
            select p_partkey::varchar as k, p_name, null::varchar as s_nationkey from part
            union all select s_name, null, s_nationkey::varchar from supplier""",
        "append_audit": f"""
            select 'people' as source, 2::bigint as file_count, count(*)::bigint as total_rows,
                4::bigint as total_columns, 'balance|segment' as unexpected_columns,
                2::bigint as unexpected_columns_added, false as skipped
            from ({_PEOPLE})
            union all select 'customer', 1, count(*), 3, '', 0, false from customer""",
        "schema_drift": f"""
            select 'refused' as source, 0::bigint as total_rows, 0::bigint as total_columns,
                'balance|segment' as unexpected_columns, true as skipped
            union all
            select 'forced', count(*), 4, 'balance|segment', false from ({_PEOPLE})""",
        "appended_dimensions": f"""
            select count(*)::bigint as total_rows, 4::bigint as total_columns from ({_PEOPLE})""",
        "link_left": """
            select d.doc_id::varchar as doc_id, lang, source, quality, toxic,
                case when l.doc_id is not null then 'labels' end as source_abs
            from documents d left join labels l on d.doc_id = l.doc_id""",
        "link_stored": """
            select d.doc_id::varchar as doc_id, lang, source, quality, toxic,
                case when l.doc_id is not null then 'labels' end as source_abs
            from documents d left join (select distinct * from labels) l on d.doc_id = l.doc_id""",
        "link_audit": """
            select (select count(*) from orders)::bigint as left_rows, 6::bigint as left_cols,
                (select count(*) from lineitem)::bigint as right_rows, 11::bigint as right_cols,
                count(*)::bigint as merged_rows, 16::bigint as merged_cols,
                (count(*) - (select count(*) from orders))::bigint as rows_added,
                10::bigint as cols_added
            from orders left join lineitem on o_orderkey = l_orderkey""",
        "count_unique_pairs": """
            select l_partkey, count(*)::bigint as supplier_count
            from (select distinct l_partkey, l_suppkey from lineitem) group by 1""",
        "count_unique_pairs_null": """
            select l_partkey, count(*)::bigint as item_count
            from (select distinct l_partkey, nullif(l_suppkey, 1) as item from lineitem) group by 1""",
        "keep_first": "select distinct l_partkey, l_suppkey from lineitem",
        "publication_count": _attach(
            "orders", "o_orderkey", "o_orderstatus", "lineitem", "l_orderkey", "l_partkey",
            "publication_count",
        ),
        "patent_count": _attach(
            "customer", "c_custkey", "c_name", "orders", "o_custkey", "o_orderpriority",
            "patent_count",
        ),
        "study_count": _attach(
            "customer", "c_custkey", "c_name", "events", "user_id", "event_type",
            "clinical_study_count",
        ),
        "project_outcomes": f"with {_GRANTS} select distinct * from full_rows",
        "project_outcomes_stored": f"with {_GRANTS} select distinct * from full_rows",
        "outcome_duplicates": f"""
            with {_GRANTS} select outcome, {_DUPLICATE_FIGURES} from pairs group by outcome""",
        "metrics_summary": f"""
            with {_GRANTS},
            copies as (select count(*) as n from full_rows group by all full_rows)
            select (select count(*) from prj)::bigint as left_rows,
                (select count(*) from abstracts)::bigint as right_rows,
                (select count(*) from linked)::bigint as merged_rows, 4::bigint as merged_cols,
                ((select count(*) from linked) - (select count(*) from prj))::bigint as rows_added,
                {_DUPLICATE_FIGURES}, count(*)::bigint as rows, 7::bigint as columns,
                3::bigint as outcome_sources
            from copies""".replace(
            "select count(*) as n from full_rows group by all full_rows",
            'select count(*) as n from full_rows group by "APPLICATION_ID", "PROJECT_NUMBER", '
            '"PROJECT_TITLE", "ABSTRACT_TEXT", publication_count, patent_count, '
            "clinical_study_count",
        ),
        "dup_stats_subset": f"""
            select {_DUPLICATE_FIGURES}
            from (select count(*) as n from lineitem group by l_partkey, l_suppkey)""",
        "dedupe_full_row": "select distinct text, lang, source from documents",
        "dup_stats_full_row": f"""
            select {_DUPLICATE_FIGURES}
            from (select count(*) as n from documents group by text, lang, source)""",
        "dup_flags": _FLAGS,
        "dup_representatives": """
            select l_partkey, l_suppkey, count(*)::bigint as copies from lineitem
            group by 1, 2 having count(*) > 1""",
        "dup_sample": f"""
            select {_LINE_KEYS} from ({_FLAGS}) where dup_all order by {_LINE_KEYS} limit 5""",
        "term_variants": f"with {_PART_TERMS} select category, term from terms",
        "sorted_terms": f"with {_PART_TERMS} select category, term from terms order by 1, 2",
        "stopword_filter": r"""
            select distinct 'said' as category, upper(w) as keyword
            from (select unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w from conversations)
            where w not in (
                select unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) from benchmark)""",
        "dictionary_stats": f"""
            with {_PART_TERMS}
            select category, count(distinct term)::bigint as terms from terms group by 1
            union all select 'pool', count(distinct term)::bigint from terms""",
        "category_union": f"with {_PART_TERMS} select distinct term from terms",
        "text_concat": """
            select doc_id, concat_ws(' | ', lower(nullif(lang, 'de')), lower(source), lower(text))
                as combined
            from documents""",
        "keyword_hits": f"select {_COUNTS} from ({_DOC_HITS})",
        "keyword_hits_join": f"select {_COUNTS} from ({_DOC_HITS})",
        "data_dictionary_hits": r"""
            with d as (
                select distinct unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from benchmark),
            t as (
                select conv_id || ':' || turn as turn_id,
                    unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from conversations)
            select c.conv_id || ':' || c.turn as turn_id, coalesce(n, 0)::bigint as total_count,
                coalesce(u, 0)::bigint as total_unique_count
            from conversations c left join (
                select turn_id, count(*) as n, count(distinct w) as u
                from t where w in (select w from d) group by 1) on turn_id = c.conv_id || ':' || c.turn""",
        "hits_repeated_ids": r"""
            with d as (
                select distinct unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from benchmark),
            t as (
                select conv_id, turn,
                    unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from conversations),
            h as (
                select conv_id, turn, count(*) as n, count(distinct w) as u
                from t where w in (select w from d) group by 1, 2)
            select c.conv_id, coalesce(n, 0)::bigint as total_count,
                coalesce(u, 0)::bigint as total_unique_count
            from conversations c left join h on h.conv_id = c.conv_id and h.turn = c.turn""",
        "large_dictionary_hits": r"""
            with d as (
                select distinct unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from documents),
            t as (
                select item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from benchmark),
            h as (
                select item_id, count(*) as n, count(distinct w) as u
                from t where w in (select w from d) group by 1)
            select b.item_id, coalesce(n, 0)::bigint as total_count,
                coalesce(u, 0)::bigint as total_unique_count
            from benchmark b left join h using (item_id)""",
        "shuffled_dictionary_hits": r"""
            with d as (
                select distinct unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from documents),
            t as (
                select item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as w
                from benchmark),
            h as (
                select item_id, count(*) as n, count(distinct w) as u
                from t where w in (select w from d) group by 1)
            select b.item_id, coalesce(n, 0)::bigint as total_count,
                coalesce(u, 0)::bigint as total_unique_count
            from benchmark b left join h using (item_id)""",
        "no_text_columns": "select doc_id, length(text) as chars from documents",
        "hits_folded": f"""
            select {_COUNTS} from ({_hits("replace(strip_accents(lower(text)), 'ß', 'ss')",
                                          ["le", "eau", "un la"])})""",
        "enrichment_stats": f"select {_ENRICHMENT} from ({_DOC_HITS})",
        "top_terms": f"with h as ({_DOC_HITS}) {_TOP} limit 10",
        "cooccurrence": f"""
            with h as ({_DOC_HITS}), f as (select doc_id, unnest(u) as t from h)
            select a.t as term_a, b.t as term_b, count(*)::bigint as row_count
            from f a join f b on a.doc_id = b.doc_id and a.t < b.t group by 1, 2""",
        "category_frequency": f"""
            with h as ({_DOC_HITS}), f as (select doc_id, unnest(k) as t from h)
            select category, term, count(*)::bigint as hit_count,
                count(distinct doc_id)::bigint as row_count
            from f join (values {_TERM_ROWS}) d(category, term) on t = term group by 1, 2""",
        "column_stats": " union all ".join(
            f"""select '{c}' as column_name, count_if({v} is null)::bigint as null_count,
                count(distinct {v})::bigint as distinct_count,
                min(length({v}::varchar))::bigint as min_length,
                max(length({v}::varchar))::bigint as max_length from documents"""
            for c, v in (
                ("doc_id", "doc_id"),
                ("lang", "nullif(lang, 'de')"),
                ("source", "source"),
                ("text", "text"),
            )
        ),
        "dimensions": 'select count(*)::bigint as rows, 5::bigint as "columns" from documents',
        "keywords_summary": f"""
            with h as ({_DOC_HITS}), top as ({_TOP} limit 1)
            select (1 + (select count(distinct category) from (values {_TERM_ROWS}) d(category, term))
                    )::bigint as library_rows,
                'text' as text_columns_used, {_ENRICHMENT},
                (select term from top) as top_term, (select row_count from top) as top_term_rows,
                count(*)::bigint as rows, 8::bigint as "columns"
            from h""",
        "cutoff_retained": f"select {_COUNTS} from ({_DOC_HITS}) where len(u) >= {CUTOFF}",
        "cutoff_dropped": f"select {_COUNTS} from ({_DOC_HITS}) where len(u) < {CUTOFF}",
        "split_stats": f"""
            select {_SPLIT},
                min(doc_id) filter (len(u) >= {CUTOFF}) as retained_min_id,
                max(doc_id) filter (len(u) >= {CUTOFF}) as retained_max_id,
                min(doc_id) filter (len(u) < {CUTOFF}) as dropped_min_id,
                max(doc_id) filter (len(u) < {CUTOFF}) as dropped_max_id
            from ({_DOC_HITS})""",
        "preprocess_tables": """
            select c_custkey::varchar as "PROJECT_NUMBER", c_name, null::varchar as o_orderkey
            from customer
            union all select o_custkey::varchar, null, o_orderkey::varchar from orders""",
        "preprocess_summary": """
            select 3::bigint as expected_sources,
                ((select count(*) from customer) + (select count(*) from orders))::bigint as total_rows,
                10::bigint as total_columns, 'customer|orders' as appended_sources,
                'c_custkey|o_custkey' as renamed""",
    }
