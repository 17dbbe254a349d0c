"""SQL for a second engine (DuckDB), one text per registered query."""

from __future__ import annotations

from linkloom.sources.derived import second_engine_sql

_TABLES = second_engine_sql()

# Intermediate relations; each may use those above it.
_RELATIONS: dict[str, str] = {
    **_TABLES,
    "fp": "SELECT * FROM page WHERE page_namespace = 0",
    "pr": """
SELECT page_id, page_title, page_namespace, page_is_redirect, rd_title
FROM fp LEFT JOIN redirect ON page_id = rd_from""",
    "lt": """
SELECT lt_id, page_id, page_title, page_namespace, page_is_redirect, rd_title
FROM pr JOIN linktarget ON page_title = lt_title AND page_namespace = lt_namespace""",
    "titles": """
SELECT lt_id, CASE WHEN page_is_redirect = FALSE THEN page_title ELSE rd_title END
       AS lt_title_updated
FROM lt""",
    "resolved": """
SELECT lt_id, lt_title_updated, fp.page_id
FROM titles LEFT JOIN fp ON lt_title_updated = fp.page_title""",
    "links": """
SELECT DISTINCT pl_from AS page_a, page_id AS page_b
FROM resolved JOIN pagelinks ON lt_id = pl_target_id""",
    "sorted_pairs": """
SELECT page_a, page_b,
       CASE WHEN page_a IS NULL THEN page_b WHEN page_b IS NULL THEN page_a
            WHEN page_a <= page_b THEN page_a ELSE page_b END AS lo,
       CASE WHEN page_a IS NULL OR page_b IS NULL THEN NULL
            WHEN page_a <= page_b THEN page_b ELSE page_a END AS hi
FROM links""",
    "frequencies": "SELECT lo, hi, count(*) AS frequency FROM sorted_pairs GROUP BY lo, hi",
    "mutual": """
SELECT x.page_a, x.page_b FROM links x JOIN links y ON x.page_a = y.page_b AND x.page_b = y.page_a
WHERE x.page_a < x.page_b""",
    "ascending": "SELECT page_a, page_b FROM links WHERE page_a < page_b",
    "v1_page": """
SELECT lt_id, page_id AS lt_page_id FROM linktarget JOIN page ON lt_title = page_title""",
    "v1_redirect": """
SELECT lt_id, lt_page_id, rd_title FROM v1_page LEFT JOIN redirect ON lt_page_id = rd_from""",
    "v1_resolved": """
SELECT lt_id, coalesce(page_id, lt_page_id) AS resolved_page_id
FROM v1_redirect LEFT JOIN page ON rd_title = page_title""",
    "v1_links": """
SELECT DISTINCT resolved_page_id AS page_a, lt_id AS page_b
FROM v1_resolved JOIN pagelinks pl1 ON resolved_page_id = pl1.pl_from
     JOIN pagelinks pl2 ON lt_id = pl2.pl_target_id AND pl2.pl_from = resolved_page_id""",
}

# Label propagation over a pair list: all labels of every round, until a round
# changes none.
_ROUNDS = """
edges AS MATERIALIZED (
  SELECT page_a AS src, page_b AS dst FROM {pairs}
  UNION ALL SELECT page_b, page_a FROM {pairs}),
rounds(round, vertex, component, changed) AS (
  SELECT DISTINCT CAST(-1 AS BIGINT), src, src, TRUE FROM edges
  UNION ALL
  SELECT p.round + 1, p.vertex, least(p.component, n.component), n.component < p.component
  FROM rounds p JOIN (
    SELECT e.dst AS vertex, min(q.component) AS component
    FROM edges e JOIN rounds q ON q.vertex = e.src GROUP BY e.dst) n ON n.vertex = p.vertex
  WHERE EXISTS (SELECT 1 FROM rounds WHERE changed)),
labels AS MATERIALIZED (
  SELECT vertex, component FROM rounds WHERE round = (SELECT max(round) FROM rounds)),
sizes AS (SELECT component, count(*) AS size FROM labels GROUP BY component),
largest AS (SELECT component FROM sizes ORDER BY size DESC, component LIMIT 1)"""


def _with(select: str, needs: str, recursive_on: str | None = None) -> str:
    """``select`` with the relations up to ``needs`` in front."""
    parts = []
    for name, text in _RELATIONS.items():
        legacy = name.startswith("v1_")
        if legacy == needs.startswith("v1_") or name in _TABLES:
            parts.append(f"{name} AS MATERIALIZED ({text.strip()})")
        if name == needs:
            break
    if recursive_on:
        parts.append(_ROUNDS.format(pairs=recursive_on).strip())
    return f"WITH {'RECURSIVE ' if recursive_on else ''}" + ",\n".join(parts) + f"\n{select}"


def _on_components(select: str, pairs: str = "mutual") -> str:
    return _with(select, pairs, recursive_on=pairs)


def oracle_sql() -> dict[str, str]:
    pages = "SELECT page_id, page_title, page_namespace, page_is_redirect FROM"
    both_ways = (
        "SELECT page_a AS src, page_b AS dst FROM mutual "
        "UNION ALL SELECT page_b, page_a FROM mutual"
    )
    one_round = f"""
e AS MATERIALIZED ({both_ways}),
one_round AS (
  SELECT vertex, min(component) AS component
  FROM (SELECT dst AS vertex, src AS component FROM e UNION ALL SELECT src, src FROM e)
  GROUP BY vertex)"""
    after_mutual = _with("", "mutual").rstrip() + ",\n" + one_round.strip()
    labels = _on_components("SELECT vertex, component FROM labels")
    return {
        "q01_main_pages": _with(f"{pages} fp", "fp"),
        "q01_main_pages_sql": _with(f"{pages} fp", "fp"),
        "q02_page_redirects": _with("SELECT * FROM pr", "pr"),
        "q03_link_targets": _with("SELECT * FROM lt", "lt"),
        "q04_effective_titles": _with("SELECT * FROM titles", "titles"),
        "q05_resolved_links": _with("SELECT * FROM resolved", "resolved"),
        "q06_page_links": _with("SELECT * FROM links", "links"),
        "q07_sorted_pairs": _with("SELECT * FROM sorted_pairs", "sorted_pairs"),
        "q07_sorted_pair_arrays": _with("SELECT * FROM sorted_pairs", "sorted_pairs"),
        "q08_pair_frequencies": _with("SELECT * FROM frequencies", "frequencies"),
        "q09_mutual_links": _with("SELECT * FROM mutual", "mutual"),
        "q09_mutual_links_by_steps": _with("SELECT * FROM mutual", "mutual"),
        "q09_mutual_links_by_arrays": _with("SELECT * FROM mutual", "mutual"),
        "q09_mutual_links_salted": _with("SELECT * FROM mutual", "mutual"),
        "q10_mutual_count": _with("SELECT count(*) AS n FROM mutual", "mutual"),
        "q11_edges": _with(both_ways, "mutual"),
        "q11_graph_counts": _with(
            f"SELECT count(*) AS edges, count(DISTINCT src) AS vertices FROM ({both_ways})",
            "mutual",
        ),
        "q12_vertices": _with(
            f"SELECT DISTINCT src AS vertex, src AS component FROM ({both_ways})", "mutual"
        ),
        "q13_one_round": f"{after_mutual}\nSELECT vertex, component FROM one_round",
        "q14_changed_after_round": (
            f"{after_mutual}\nSELECT count(*) AS changed FROM one_round WHERE component <> vertex"
        ),
        "q15_components": labels,
        "q15_components_hot": labels,
        "q15_components_min_label": labels,
        "q16_component_stats": _on_components("SELECT component, size FROM sizes"),
        "q17_top_components": _on_components(
            "SELECT component, size FROM sizes ORDER BY size DESC, component LIMIT 10"
        ),
        "q18_largest_members": _on_components(
            "SELECT vertex, component FROM labels WHERE component = (SELECT component FROM largest)"
        ),
        "q18_first_members": _on_components(
            "SELECT vertex, component FROM labels "
            "WHERE component = (SELECT component FROM largest) ORDER BY vertex LIMIT 20"
        ),
        "q19_component_members": _on_components(
            "SELECT component, CAST(floor(vertex / 1000.0) AS BIGINT) AS id_block, "
            "string_agg(CAST(vertex AS VARCHAR), ',' ORDER BY vertex) AS members "
            "FROM labels GROUP BY 1, 2"
        ),
        "q20_pairs_sink": _with("SELECT * FROM mutual", "mutual"),
        "q20_components_sink": labels,
        "q20_largest_sink": _on_components(
            "SELECT vertex, component FROM labels WHERE component = (SELECT component FROM largest)"
        ),
        "q20_count_sink": _with("SELECT count(*) AS n FROM mutual", "mutual"),
        "q21_ascending_links": _with("SELECT * FROM ascending", "ascending"),
        "q21_ascending_components": _on_components(
            "SELECT vertex, component FROM labels", "ascending"
        ),
        "q22_round_metrics": _on_components(
            "SELECT round, count(*) FILTER (WHERE changed) AS changed FROM rounds "
            "WHERE round >= 0 GROUP BY round"
        ),
        "q23_jsonl_load": _with(f"{pages} page", "page"),
        "q23_jsonl_mutual_links": _with("SELECT * FROM mutual", "mutual"),
        "q23_graph_views": _on_components(
            "SELECT src, dst, component FROM edges JOIN labels ON src = vertex"
        ),
        "q23_step_views": _with("SELECT * FROM mutual", "mutual"),
        "q24_jsonl_quarantine": _with(
            "SELECT CASE WHEN page_namespace <> 0 THEN 'not a JSON object' "
            "WHEN page_is_redirect THEN 'page_id is no bigint' ELSE 'good' END AS outcome, "
            "count(*) AS n FROM page GROUP BY 1",
            "page",
        ),
        "q23_views_by_name": _with("SELECT * FROM mutual", "mutual"),
        "v1_step_views": _with(
            "SELECT p.lt_id, p.lt_page_id, r.rd_title FROM v1_page p "
            "JOIN v1_redirect r ON p.lt_id = r.lt_id AND p.lt_page_id = r.lt_page_id "
            "WHERE EXISTS (SELECT 1 FROM v1_resolved s WHERE s.lt_id = p.lt_id)",
            "v1_resolved",
        ),
        "v1_lt_page": _with("SELECT * FROM v1_page", "v1_page"),
        "v1_lt_redirect": _with("SELECT * FROM v1_redirect", "v1_redirect"),
        "v1_lt_resolved": _with("SELECT * FROM v1_resolved", "v1_resolved"),
        "v1_reciprocal": _with("SELECT * FROM v1_links", "v1_links"),
        "v1_components": _on_components("SELECT vertex, component FROM labels", "v1_links"),
    }
