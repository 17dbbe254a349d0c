"""First-generation link rules, kept for callers that depend on their result.

No namespace is checked, redirect rows apply whatever the page's flag says, and
a target that cannot be resolved stands for itself. The result lists pages with
a link to a target that resolves to the page itself: an audit of self links
behind redirects rather than a list of mutual links.
"""

from pyspark.sql import DataFrame, functions as F

from linkloom.functions.columns import spread_null_key


def target_pages(linktarget: DataFrame, page: DataFrame) -> DataFrame:
    """Link targets with every page of the same title, in any namespace."""
    return linktarget.join(page, linktarget.lt_title == page.page_title).select(
        "lt_id", F.col("page_id").alias("lt_page_id")
    )


def target_redirects(targets: DataFrame, redirect: DataFrame) -> DataFrame:
    """Adds the redirect title of the target's page, NULL without a redirect row."""
    return targets.join(redirect, targets.lt_page_id == redirect.rd_from, "left").select(
        "lt_id", "lt_page_id", "rd_title"
    )


def resolved_targets(redirected: DataFrame, page: DataFrame) -> DataFrame:
    """Page that each target leads to; the target's own page if there is none.

    Most targets have no redirect, so most keys here are NULL: they are spread.
    """
    title = F.col("rd_title")
    by_title = page.select("page_id", F.col("page_title").alias("found_title"))
    found = (spread_null_key(title, F.col("lt_page_id")) == F.col("found_title")) & (
        title.isNotNull()
    )
    return redirected.join(by_title, found, "left").select(
        "lt_id", F.coalesce("page_id", "lt_page_id").alias("resolved_page_id")
    )


def links_to_own_target(resolved: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """Pairs (page, link target) where the page links to a target that is itself.

    The semi join asks for the very link row. That the page has links at all
    follows from it and needs no join of its own.
    """
    linked = (resolved.lt_id == pagelinks.pl_target_id) & (
        resolved.resolved_page_id == pagelinks.pl_from
    )
    return (
        resolved.join(pagelinks, linked, "left_semi")
        .select(F.col("resolved_page_id").alias("page_a"), F.col("lt_id").alias("page_b"))
        .distinct()
    )
