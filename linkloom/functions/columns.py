"""Column expressions shared by the operators. All run inside Spark's codegen."""

from pyspark.sql import Column, functions as F


def effective_title(is_redirect: Column, own_title: Column, redirect_title: Column) -> Column:
    """Title a link target stands for: its own, or where the page redirects to.

    Only a flag that is false keeps the page's own title. A NULL flag counts as
    a redirect, so it takes the redirect title, which may be NULL.
    """
    return F.when(~is_redirect, own_title).otherwise(redirect_title)


def pair_low(a: Column, b: Column) -> Column:
    """First entry of the ascending pair. NULLs sort last, so the known end wins."""
    return F.least(a, b)


def pair_high(a: Column, b: Column) -> Column:
    """Second entry of the ascending pair: NULL as soon as one end is NULL.

    ``greatest`` alone skips NULLs and would turn (a, NULL) into the self pair
    (a, a).
    """
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def pair_array(a: Column, b: Column) -> Column:
    """Ascending pair as an array, NULLs last."""
    return F.array_sort(F.array(a, b))


def spread_null_key(key: Column, row_id: Column) -> Column:
    """String join key that scatters NULLs instead of hashing them to one task.

    A left join keeps rows with a NULL key, and Spark sends all of them to the
    same partition. The stand-in differs per row; callers must add
    ``key.isNotNull()`` to the join condition, so that it can never match.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_id.cast("string")))
