"""First-generation rules."""

from conftest import rows

from linkloom import connected_components
from linkloom.plans.mutual import self_link_steps


def test_harbour(harbour):
    steps = self_link_steps(harbour)
    assert rows(steps["lt_resolved"]) == [
        (101, 11), (102, 11), (103, 13), (104, 15), (105, 13), (106, 16), (107, 16), (108, 18),
    ]
    assert rows(steps["reciprocal_links"]) == [(15, 104), (16, 107)]
    run = connected_components(steps["reciprocal_links"])
    assert rows(run.vertices) == [(15, 15), (16, 16), (104, 15), (107, 16)]


def test_every_namespace_and_fallback(link_tables):
    tables = link_tables(
        page=[(1, "a", 0, False), (2, "a", 1, False), (3, "b", 0, True)],
        redirect=[(3, 0, "gone"), (2, 0, None)],
        linktarget=[(10, "a", 0), (11, "b", 5)],
        pagelinks=[(1, 0, 10), (2, 0, 10), (3, 0, 11), (3, 0, 11)],
    )
    steps = self_link_steps(tables, register=True)
    assert rows(steps["lt_page"]) == [(10, 1), (10, 2), (11, 3)]
    assert rows(steps["lt_redirect"]) == [(10, 1, None), (10, 2, None), (11, 3, "gone")]
    assert rows(steps["lt_resolved"]) == [(10, 1), (10, 2), (11, 3)]
    assert rows(steps["reciprocal_links"]) == [(1, 10), (2, 10), (3, 11)]
