"""Declared schemas of the four input tables."""

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Table names, column names and types of the input data model.
SCHEMAS: dict[str, T.StructType] = {
    "page": _table(
        page_id=T.LongType(),
        page_title=T.StringType(),
        page_namespace=T.LongType(),
        page_is_redirect=T.BooleanType(),
    ),
    "redirect": _table(
        rd_from=T.LongType(),
        rd_namespace=T.LongType(),
        rd_title=T.StringType(),
    ),
    "linktarget": _table(
        lt_id=T.LongType(),
        lt_title=T.StringType(),
        lt_namespace=T.LongType(),
    ),
    "pagelinks": _table(
        pl_from=T.LongType(),
        pl_from_namespace=T.LongType(),
        pl_target_id=T.LongType(),
    ),
}

# Fixed value: the namespace that holds articles.
MAIN_NAMESPACE = 0
