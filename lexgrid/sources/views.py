"""The derived views by name, as SQL over the derived tables, registered in the order of their dependencies."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Which tables and views each reads follows from its text. Dates are written ones and compare as strings.
VIEWS = {
    "v_general_part": """
        WITH RECURSIVE way(node_id, root_id, breadcrumb) AS (
          SELECT node_id, node_id, CAST(label_en AS STRING) FROM struct_node WHERE parent_id IS NULL
          UNION ALL SELECT c.node_id, w.root_id, concat(w.breadcrumb, ' > ', c.label_en) FROM way w JOIN struct_node c ON c.parent_id = w.node_id)
        SELECT n.*, s.kind AS node_kind, s.label_en AS node_label, w.root_id, w.breadcrumb FROM norm_unit n LEFT JOIN struct_node s ON s.node_id = n.struct_node_id LEFT JOIN way w ON w.node_id = n.struct_node_id""",
    "v_realization": """
        SELECT e.*, n.article_title_uz, n.article_title_en, p.article_title AS src_article_title, p.is_whole_act_blob, a.doc_title AS src_doc_title, a.doc_date AS src_doc_date
        FROM link_edge e LEFT JOIN norm_unit n ON n.norm_id = e.dst_norm_id LEFT JOIN src_provision p ON p.row_id = e.src_row_id LEFT JOIN act a ON a.doc_id = e.src_doc_id""",
    "v_realization_struct": "SELECT r.*, s.label_en AS dst_label_en, s.kind AS dst_node_kind FROM v_realization r JOIN struct_node s ON s.node_id = r.dst_struct_node_id",
    "v_locator_amendment_status": """
        SELECT x.*, change_type IN ('removed', 'voided') AND locator_latest_change_type NOT IN ('removed', 'voided') AS is_stale FROM (
          SELECT m.*, last_value(change_type) OVER (PARTITION BY doc_id, host_article_number, lower(trim(coalesce(locator, ''))) ORDER BY amend_date, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS locator_latest_change_type FROM article_amendment m) x""",
    "v_article_currency": """
        SELECT doc_id, coalesce(target_article_number, host_article_number) AS article_number, count(*) AS n_events, max(amend_date) AS last_amend_date,
          max_by(change_type, struct(amend_date, -event_id)) AS last_change_type, bool_or(change_type = 'voided' AND NOT is_stale) AS any_voided
        FROM v_locator_amendment_status GROUP BY ALL""",
    "v_act_currency": """
        WITH whole AS (SELECT dst_doc_id, src_doc_id, cited_date, row_number() OVER (PARTITION BY dst_doc_id ORDER BY cited_date, clause_id) AS k FROM repeal_clause WHERE dst_doc_id IS NOT NULL AND target_locator IS NULL)
        SELECT a.doc_id, a.tier, a.doc_title, CASE WHEN w.src_doc_id IS NULL THEN a.status ELSE 'superseded' END AS derived_status, w.src_doc_id AS repealed_by, r.doc_title AS repealed_by_title, w.cited_date
        FROM act a LEFT JOIN whole w ON w.dst_doc_id = a.doc_id AND w.k = 1 LEFT JOIN act r ON r.doc_id = w.src_doc_id""",
    "v_act_partial_repeal": """
        SELECT dst_doc_id AS doc_id, count(*) AS n_partial, array_join(array_sort(collect_set(target_locator)), ', ') AS locators, max_by(src_doc_id, struct(cited_date, clause_id)) AS last_repealed_by
        FROM repeal_clause WHERE dst_doc_id IS NOT NULL AND target_locator IS NOT NULL GROUP BY dst_doc_id""",
    "v_qism_void_citation": """
        SELECT q.edge_id, q.amend_event_id, e.src_doc_id, e.dst_doc_id, e.dst_article_number, e.dst_qism, m.change_type, m.amend_date, m.amend_act_number
        FROM qism_void_citation q JOIN link_edge e ON e.edge_id = q.edge_id JOIN article_amendment m ON m.event_id = q.amend_event_id""",
    "v_en_amendment_staleness": """
        SELECT s.*, s.en_latest_act_number < s.uz_latest_act_number AS en_text_stale, d.amend_date AS uz_latest_amend_date, CAST(datediff(current_date(), try_to_date(d.amend_date)) AS BIGINT) AS days_since_uz_amend
        FROM en_amendment_staleness s JOIN norm_unit n ON n.norm_id = s.norm_id
        LEFT JOIN (SELECT DISTINCT try_cast(regexp_extract(amend_act_number, '([0-9]+)$', 1) AS BIGINT) AS act, amend_date FROM article_amendment) d ON d.act = s.uz_latest_act_number""",
    "v_okoz_general_part": """
        WITH RECURSIVE up(code, label, above, n) AS (
          SELECT code, label_en, parent_code, 0 FROM okoz_node UNION ALL SELECT u.code, k.label_en, k.parent_code, u.n + 1 FROM up u JOIN okoz_node k ON k.code = u.above),
        crumb AS (SELECT code, listagg(label, ' > ') WITHIN GROUP (ORDER BY n DESC) AS okoz_breadcrumb FROM up GROUP BY code)
        SELECT n.norm_id, n.article_number, a.okoz_code, a.method, a.confidence, a.validated_by, c.okoz_breadcrumb FROM norm_unit n JOIN okoz_assignment a ON a.struct_node_id = n.struct_node_id LEFT JOIN crumb c ON c.code = a.okoz_code""",
    "v_llc_realization": """
        SELECT DISTINCT l.stage_no, l.norm_key, e.edge_id, e.src_doc_id, e.hierarchy_rel, e.evidence_kind, e.confidence, c.derived_status
        FROM llc_norm l JOIN link_edge e ON e.dst_norm_id = l.cc_norm_id JOIN v_act_currency c ON c.doc_id = e.src_doc_id WHERE l.layer = 'foundation' AND e.hierarchy_rel = 'below'""",
}

#: The derived tables, by their columns.
TABLES = {
    "act": "doc_id long, act_group_id string, doc_title string, doc_type string, tier int, doc_number string, doc_date string, version_date string, status string, source_url string, n_articles long, tier_note string",
    "norm_unit": "norm_id string, doc_id long, src_row long, part_raw string, chapter_raw string, article_number string, occurrence int, article_base int, superscript int, struct_node_id string, article_title_uz string, article_text_uz string, n_tokens_uz int, okoz_codes_doc array<string>, article_title_en string, article_text_en string, en_display_number string, en_heading_type string, en_titleless boolean, en_repealed boolean, en_line_start int, en_line_end int, en_align_method string, en_align_status string, en_align_note string, en_run_id string",
    "struct_node": "node_id string, kind string, number string, label_en string, parent_id string, ordinal int, depth int, art_from int, art_to int, doc_id long, n_units long",
    "link_edge": "edge_id long, run_id string, src_row_id long, src_doc_id long, src_doc_type string, src_tier int, src_article_number string, dst_kind string, dst_doc_id long, dst_article_number string, dst_norm_id string, dst_struct_node_id string, dst_qism string, dst_ambiguous boolean, dst_dangling boolean, hierarchy_rel string, relation string, anchor string, listing string, source_field string, evidence_kind string, method string, confidence double, evidence string, evidence_clean string, ev_start int, ev_end int, ev_clean_start int, ev_clean_end int, validated_by string, validated_at timestamp",
    "src_provision": "row_id long, doc_id long, article_number string, article_title string, article_text string, text_len int, chapter_raw string, is_whole_act_blob boolean",
    "repeal_clause": "clause_id int, src_doc_id long, src_row_id long, item_no int, cited_date string, cited_number string, dst_doc_id long, match_method string, target_locator string, evidence string",
    "article_amendment": "event_id int, doc_id long, host_article_number string, target_article_number string, norm_id string, locator string, change_type string, amend_date string, amend_act_number string, effective_date string, amending_doc_id long, match_method string, evidence string",
    "qism_void_citation": "edge_id long, amend_event_id int", "en_amendment_staleness": "norm_id string, en_latest_act_number long, uz_latest_act_number long, uz_latest_change_type string",
    "okoz_node": "code string, parent_code string, level int, label_en string, see_also string, ordinal int", "okoz_assignment": "assignment_id int, okoz_code string, struct_node_id string, method string, confidence double, rationale string, proposed_at timestamp, validated_by string, validated_at timestamp",
    "llc_norm": "norm_key string, stage_no int, layer string, doc_id long, article_number string, article_title string, article_text string, article_title_en string, cc_norm_id string, rationale string, row_id long",
}


def reads(name: str) -> set[str]:
    """The derived tables and views that a view reads."""
    return {w for w in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", VIEWS[name]) if w in VIEWS or w in TABLES}


def order() -> list[str]:
    """Views after all that they read."""
    out: list[str] = []
    while len(out) < len(VIEWS):
        out += [v for v in VIEWS if v not in out and all(r in out or r in TABLES for r in reads(v))]
    return out


def unread(used: set[str]) -> set[str]:
    """Views that none of the names in `used` reads, directly or through other views."""
    seen, todo = set(), set(used) & set(VIEWS)
    while todo:
        seen |= todo
        todo = {r for v in todo for r in reads(v) if r in VIEWS} - seen
    return set(VIEWS) - seen


def register(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Temp views of the given derived tables, and of all derived views whose tables are there; the latter's names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    done: list[str] = []
    for name in order():
        if all(r in tables or r in done for r in reads(name)):
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {VIEWS[name]}")
            done.append(name)
    return done


def columns(spark: SparkSession, name: str) -> dict[str, str]:
    """A table's or view's columns and their types."""
    return {f.name: f.dataType.simpleString() for f in spark.table(name).schema}
