"""From pages, redirects and link targets to resolved link targets."""

from pyspark.sql import DataFrame, functions as F

from linkloom.functions.columns import effective_title, spread_null_key
from linkloom.schemas import MAIN_NAMESPACE


def main_pages(page: DataFrame) -> DataFrame:
    """Pages of the main namespace. The filter reaches the Parquet scan."""
    return page.where(F.col("page_namespace") == MAIN_NAMESPACE)


def page_redirects(pages: DataFrame, redirect: DataFrame) -> DataFrame:
    """Every page with the title its redirect row names, or NULL without a row."""
    return pages.join(redirect, pages.page_id == redirect.rd_from, "left").select(
        "page_id", "page_title", "page_namespace", "page_is_redirect", "rd_title"
    )


def link_targets(redirected: DataFrame, linktarget: DataFrame) -> DataFrame:
    """Link targets with the page of the same title and namespace."""
    same_page = (linktarget.lt_title == redirected.page_title) & (
        linktarget.lt_namespace == redirected.page_namespace
    )
    return linktarget.join(redirected, same_page).select(
        "lt_id", "page_id", "page_title", "page_namespace", "page_is_redirect", "rd_title"
    )


def effective_titles(targets: DataFrame) -> DataFrame:
    """Title that each link target leads to after one redirect hop."""
    title = effective_title(F.col("page_is_redirect"), F.col("page_title"), F.col("rd_title"))
    return targets.select("lt_id", title.alias("lt_title_updated"))


def resolved_links(titles: DataFrame, pages: DataFrame) -> DataFrame:
    """Link targets with the page they lead to; NULL where there is none.

    Targets without a title stay, and may be many: their keys are spread, so
    they do not meet in one task.
    """
    title = F.col("lt_title_updated")
    by_title = pages.select("page_id", F.col("page_title").alias("found_title"))
    found = (spread_null_key(title, F.col("lt_id")) == F.col("found_title")) & title.isNotNull()
    return titles.join(by_title, found, "left").select("lt_id", "lt_title_updated", "page_id")


def resolve_targets(page: DataFrame, redirect: DataFrame, linktarget: DataFrame) -> DataFrame:
    """(lt_id, page_id) of the targets that lead to a page: the short way.

    Same pairs as the steps above without the unresolved rows. Only flagged
    pages take part in the redirect join, because the others keep their own
    title whatever the redirect table says, and all joins are inner, so rows
    with a NULL title drop out before any shuffle.

    Titles are shuffled as keys only: targets and redirects once, pages once by what they are and once to be
    looked up. What titles lead to are page ids, and redirects meet the targets' pages on these. Targets of
    unflagged pages look up their own title, by which they lie already: another page may have it too.
    """
    pages = main_pages(page)
    by_title = pages.select("page_id", F.col("page_title").alias("found_title"))
    is_flagged = F.coalesce("page_is_redirect", F.lit(True))
    plain = pages.where(~is_flagged).select("page_title")
    flagged = pages.where(is_flagged).select(F.col("page_id").alias("own_id"), "page_title")
    targets = linktarget.where(F.col("lt_namespace") == MAIN_NAMESPACE).select("lt_id", "lt_title")
    own_title = F.col("lt_title") == F.col("page_title")
    leading = redirect.select("rd_from", F.col("rd_title").alias("leads_to")).join(
        by_title, F.col("leads_to") == F.col("found_title")
    )
    direct = targets.join(plain, own_title).join(
        by_title, F.col("lt_title") == F.col("found_title")
    )
    redirected = targets.join(flagged, own_title).join(
        leading, F.col("own_id") == F.col("rd_from")
    )
    return direct.select("lt_id", "page_id").unionByName(redirected.select("lt_id", "page_id"))
