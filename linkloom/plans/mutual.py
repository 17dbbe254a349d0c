"""Pages that link to each other, after resolving redirects."""

from pyspark.sql import DataFrame

from linkloom.operators import graph, links, redirects, selflinks
from linkloom.sources.tables import LinkTables


JOINS = {"adaptive": links.raw_links, "salted": links.raw_links_salted}


def mutual_links(tables: LinkTables, hot_targets: str = "adaptive") -> DataFrame:
    """(page_a, page_b) with page_a < page_b for pages that link to each other.

    Only pages of the main namespace are link targets; a target leads one
    redirect hop on. One lazy plan: the link table is shuffled twice, once to
    find its targets' pages and once to bring both directions together.

    ``hot_targets`` says what keeps a target with very many links from one task: ``adaptive`` execution,
    which also leaves a link table that is bucketed by target in its buckets, or salts for the targets
    that one more pass over the link table finds (``salted``), which works without adaptive execution.
    """
    if hot_targets not in JOINS:
        raise ValueError(f"unknown way {hot_targets!r}; use one of {sorted(JOINS)}")
    resolved = redirects.resolve_targets(tables.page, tables.redirect, tables.linktarget)
    return links.mutual_from_links(JOINS[hot_targets](resolved, tables.pagelinks))


def mutual_link_steps(tables: LinkTables, register: bool = False) -> dict[str, DataFrame]:
    """Every intermediate relation behind ``mutual_links``, by name.

    All are lazy. With ``register`` each is also a temp view of that name.
    """
    pages = redirects.main_pages(tables.page)
    redirected = redirects.page_redirects(pages, tables.redirect)
    targets = redirects.link_targets(redirected, tables.linktarget)
    titles = redirects.effective_titles(targets)
    resolved = redirects.resolved_links(titles, pages)
    page_links = links.page_links(resolved, tables.pagelinks)
    pairs = links.sorted_pairs(page_links)
    frequencies = links.pair_frequencies(pairs)
    # The names under which callers know the relations.
    return _registered(
        {
            "filtered_pages": pages,
            "page_redirects": redirected,
            "link_targets": targets,
            "updated_link_targets": titles,
            "resolved_links": resolved,
            "page_links": page_links,
            "sorted_pairs": pairs,
            "pair_frequencies": frequencies,
            "mutual_links": links.frequent_pairs(frequencies),
        },
        register,
    )


def register_graph_views(pairs: DataFrame, labels: DataFrame) -> None:
    """Views ``edges`` (src, dst; both directions) and ``connected_components`` (vertex, component)."""
    graph.edges(pairs).createOrReplaceTempView("edges")
    labels.select("vertex", "component").createOrReplaceTempView("connected_components")


def self_link_steps(tables: LinkTables, register: bool = False) -> dict[str, DataFrame]:
    """Every relation of the first-generation rules, by name; the last is the result."""
    targets = selflinks.target_pages(tables.linktarget, tables.page)
    redirected = selflinks.target_redirects(targets, tables.redirect)
    resolved = selflinks.resolved_targets(redirected, tables.page)
    # The names under which callers know the relations.
    return _registered(
        {
            "lt_page": targets,
            "lt_redirect": redirected,
            "lt_resolved": resolved,
            "reciprocal_links": selflinks.links_to_own_target(resolved, tables.pagelinks),
        },
        register,
    )


def _registered(steps: dict[str, DataFrame], register: bool) -> dict[str, DataFrame]:
    if register:
        for name, frame in steps.items():
            frame.createOrReplaceTempView(name)
    return steps
