"""Redirect rules and mutual links."""

import random

import pytest
from conftest import rows

from linkloom import mutual_link_steps, mutual_links
from linkloom.operators import links, redirects
from linkloom.operators.links import (
    ascending_links,
    mutual_from_links,
    pair_count,
    pair_frequencies,
    sorted_pair_arrays,
)


def test_harbour_resolve_and_pair(harbour):
    steps = mutual_link_steps(harbour)
    assert rows(steps["resolved_links"], "lt_id", "page_id") == [
        (101, 11), (102, 11), (103, 13), (104, 15), (105, 13), (106, 16), (107, 17), (108, None),
    ]
    assert rows(steps["page_links"]) == [
        (11, 13), (11, None), (13, 11), (14, 15), (15, 15), (16, 11), (16, 13), (16, 17), (17, 16),
    ]
    assert rows(steps["mutual_links"]) == [(11, 13), (16, 17)]
    assert rows(mutual_links(harbour)) == [(11, 13), (16, 17)]
    assert rows(pair_count(mutual_links(harbour))) == [(2,)]


def test_harbour_ascending(harbour):
    ascending = ascending_links(mutual_link_steps(harbour)["page_links"])
    assert rows(ascending) == [(11, 13), (14, 15), (16, 17)]


def test_steps_become_views(spark, harbour):
    mutual_link_steps(harbour, register=True)
    assert rows(spark.table("mutual_links")) == [(11, 13), (16, 17)]
    assert spark.table("updated_link_targets").columns == ["lt_id", "lt_title_updated"]


def small(link_tables, page, redirect, pagelinks):
    """Link target i + 100 names page i in that page's namespace."""
    targets = [(p[0] + 100, p[1], p[2]) for p in page]
    return link_tables(page, redirect, targets, [(a, 0, b) for a, b in pagelinks])


@pytest.fixture
def both(link_tables):
    """Mutual links by the short plan, checked against the step-by-step one."""

    def run(page, redirect, pagelinks):
        tables = small(link_tables, page, redirect, pagelinks)
        short = rows(mutual_links(tables))
        assert short == rows(mutual_link_steps(tables)["mutual_links"])
        return short

    return run


def test_empty_inputs(both):
    assert both([], [], []) == []


def test_self_link_is_not_mutual(both):
    assert both([(1, "a", 0, False)], [], [(1, 101), (1, 101)]) == []


def test_self_link_with_unresolved_link_is_not_mutual(both):
    """(1, 1) and (1, NULL) must not be counted as one pair seen twice."""
    pages = [(1, "a", 0, False), (2, "b", 0, True)]
    assert both(pages, [(2, 0, "nowhere")], [(1, 101), (1, 102)]) == []


def test_unknown_link_source_is_no_pair(both):
    pages = [(1, "a", 0, False), (2, "b", 0, True)]
    assert both(pages, [(2, 0, None)], [(None, 101), (1, 102), (None, 102)]) == []


def test_duplicate_links_do_not_look_mutual(both):
    pages = [(1, "a", 0, False), (2, "b", 0, False), (3, "c", 0, True)]
    assert both(pages, [(3, 0, "b")], [(1, 102), (1, 102), (1, 103)]) == []


def test_redirect_makes_a_pair(both):
    pages = [(1, "a", 0, False), (2, "b", 0, False), (3, "c", 0, True)]
    assert both(pages, [(3, 0, "b")], [(1, 103), (2, 101)]) == [(1, 2)]


def test_link_source_is_not_resolved(both):
    pages = [(1, "a", 0, False), (2, "b", 0, False), (3, "c", 0, True)]
    assert both(pages, [(3, 0, "b")], [(1, 102), (3, 101)]) == []


def test_double_redirect_ends_on_the_middle_page(both):
    pages = [(1, "a", 0, False), (2, "b", 0, True), (3, "c", 0, True), (4, "d", 0, False)]
    hops = [(2, 0, "c"), (3, 0, "d")]
    assert both(pages, hops, [(1, 102), (3, 101), (4, 101)]) == [(1, 3)]


def test_redirect_namespace_is_ignored(both):
    pages = [(1, "a", 0, False), (2, "b", 0, False), (3, "c", 0, True)]
    assert both(pages, [(3, 14, "b")], [(1, 103), (2, 101)]) == [(1, 2)]


def test_flag_without_row_leads_nowhere(both):
    pages = [(1, "a", 0, False), (2, "b", 0, True)]
    assert both(pages, [], [(1, 102), (2, 101)]) == []


def test_row_without_flag_is_ignored(both):
    pages = [(1, "a", 0, False), (2, "b", 0, False), (3, "c", 0, False)]
    assert both(pages, [(2, 0, "c")], [(1, 102), (2, 101)]) == [(1, 2)]


def test_unknown_flag_counts_as_redirect(both):
    pages = [(1, "a", 0, False), (2, "b", 0, None), (3, "c", 0, False)]
    assert both(pages, [(2, 0, "c")], [(1, 102), (2, 101), (3, 101)]) == [(1, 3)]
    assert both(pages, [], [(1, 102), (2, 101)]) == []


def test_only_the_main_namespace_counts(both):
    pages = [(1, "a", 0, False), (2, "a", 1, False), (3, "b", 0, False), (4, "x", None, False)]
    every = [(a, b + 100) for a in (1, 2, 3, 4) for b in (1, 2, 3, 4)]
    assert both(pages, [], every) == [(1, 3)]


def test_title_match_is_exact(link_tables):
    tables = link_tables(
        [(1, "A", 0, False), (2, "b ", 0, False)],
        [],
        [(7, "a", 0), (8, "b", 0)],
        [(1, 0, 8), (2, 0, 7)],
    )
    assert rows(mutual_links(tables)) == []


def test_repeated_titles_and_redirect_rows(both):
    """Keys are not assumed to be unique: title "a" stands for 1, 2, and through 2 for 3, 4."""
    pages = [(1, "a", 0, False), (2, "a", 0, True), (3, "b", 0, False), (4, "c", 0, False)]
    hops = [(2, 0, "b"), (2, 0, "c")]
    got = both(pages, hops, [(3, 101), (4, 102), (1, 103), (2, 103), (2, 104), (1, 104)])
    assert got == [(1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]


def brute_force(tables):
    page, redirect, linktarget, pagelinks = ([tuple(r) for r in t.collect()] for t in tables)
    main = [p for p in page if p[2] == 0]
    seen = set()
    for source, _, target in pagelinks:
        for lt_id, lt_title, lt_namespace in linktarget:
            if lt_id != target or lt_namespace != 0 or lt_title is None:
                continue
            for page_id, title, _, flag in main:
                if title != lt_title:
                    continue
                if flag is False:
                    ends = {title}
                else:
                    ends = {r[2] for r in redirect if r[0] == page_id}
                seen |= {(source, p[0]) for p in main if p[1] in ends - {None}}
    return sorted((a, b) for a, b in seen if a is not None and a < b and (b, a) in seen)


@pytest.mark.parametrize("seed", range(4))
def test_random_tables_against_brute_force(link_tables, seed):
    rng = random.Random(seed)
    titles = [f"t{i}" for i in range(6)] + [None]
    page = [
        (i, rng.choice(titles), rng.choice([0, 0, 0, 1, None]), rng.choice([True, False, False, None]))
        for i in range(14)
    ]
    redirect = [(rng.randrange(14), rng.choice([0, 1]), rng.choice(titles)) for _ in range(8)]
    target = [(100 + i, rng.choice(titles), rng.choice([0, 0, 1])) for i in range(14)]
    link = [
        (rng.choice([None, *range(14)]), 0, rng.choice([None, *range(100, 114)])) for _ in range(240)
    ]
    tables = link_tables(page, redirect, target, link)
    want = brute_force(tables)
    assert rows(mutual_links(tables)) == want
    assert rows(mutual_link_steps(tables)["mutual_links"]) == want
    assert want


def test_pair_forms_agree(spark):
    frame = spark.createDataFrame(
        [(2, 1), (1, 2), (3, 3), (4, None), (None, 4), (None, None)], "page_a long, page_b long"
    )
    arrays = sorted_pair_arrays(frame).select("sorted_pair")
    assert [tuple(r[0]) for r in arrays.collect()] == [
        (1, 2), (1, 2), (3, 3), (4, None), (4, None), (None, None),
    ]
    pairs = links.sorted_pairs(frame)
    assert rows(pairs, "lo", "hi") == [(1, 2), (1, 2), (3, 3), (4, None), (4, None), (None, None)]
    assert rows(pair_frequencies(pairs)) == [(1, 2, 2), (3, 3, 1), (4, None, 2), (None, None, 1)]
    by_array = pair_frequencies(sorted_pair_arrays(frame), "sorted_pair")
    assert sorted(r["frequency"] for r in by_array.collect()) == [1, 1, 2, 2]
    assert rows(links.unpacked_pairs(by_array)) == [(1, 2)]
    assert rows(mutual_from_links(frame)) == [(1, 2)]


def test_short_resolution_equals_the_steps(harbour):
    steps = mutual_link_steps(harbour)["resolved_links"].where("page_id is not null")
    short = redirects.resolve_targets(harbour.page, harbour.redirect, harbour.linktarget)
    assert rows(short) == rows(steps, "lt_id", "page_id")
