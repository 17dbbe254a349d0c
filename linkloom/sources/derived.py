"""A link graph made from star-schema tables, for checks and benchmarks.

Parts, orders and regions become pages. Every line item links its order to its
part, and every further link follows from a column of a whole table, so the
graph grows with the data. One SQL text per table runs on Spark and, for the
cross-check, on a second engine; ``{part}`` and the like stand for the inputs.
"""

from pyspark.sql import SparkSession

from linkloom.sources.tables import LinkTables, conform

# Columns read from each input.
INPUTS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint",
    "part": "p_partkey bigint, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_orderstatus string, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, "
    "l_returnflag string, l_linestatus string",
}

# Ids: parts keep theirs; orders start at 1e12, talk pages at 2e12, portals at
# 3e12. Link target ids start at 4e12 (parts), 5e12 (orders), 6e12 (portals),
# 7e12 (targets without a page) and 8e12 (talk pages).
DERIVED_SQL: dict[str, str] = {
    "page": """
SELECT p_partkey AS page_id,
       'part_' || CAST(p_partkey AS STRING) AS page_title,
       CAST(CASE WHEN p_size > 45 THEN 1 ELSE 0 END AS BIGINT) AS page_namespace,
       p_type = 'ECONOMY' AS page_is_redirect
FROM {part}
UNION ALL
SELECT 2000000000000 + p_partkey, 'part_' || CAST(p_partkey AS STRING), CAST(1 AS BIGINT), FALSE
FROM {part} WHERE p_brand = 'Brand#9' AND p_size <= 45
UNION ALL
SELECT 1000000000000 + o_orderkey, 'order_' || CAST(o_orderkey AS STRING),
       CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 2 ELSE 0 END AS BIGINT),
       o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
FROM {orders}
UNION ALL
SELECT 3000000000000 + r_regionkey, 'portal_' || r_name, CAST(0 AS BIGINT), FALSE FROM {region}
""",
    "redirect": """
SELECT p_partkey AS rd_from,
       CAST(CASE WHEN p_size > 30 THEN 1 ELSE 0 END AS BIGINT) AS rd_namespace,
       CASE WHEN p_size <= 5 THEN 'portal_AFRICA'
            WHEN p_size <= 30 THEN 'part_' || CAST(p_partkey + 7 AS STRING)
            ELSE 'part_' || CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS STRING) END AS rd_title
FROM {part} WHERE p_type = 'ECONOMY' AND p_brand <> 'Brand#5'
UNION ALL
SELECT p_partkey, CAST(0 AS BIGINT), 'part_' || CAST(p_partkey + 1 AS STRING)
FROM {part} WHERE p_type = 'SMALL' AND p_size = 30
UNION ALL
SELECT 1000000000000 + o_orderkey, CAST(0 AS BIGINT), 'order_' || CAST(o_orderkey + 1 AS STRING)
FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
""",
    "linktarget": """
SELECT 4000000000000 + p_partkey AS lt_id, 'part_' || CAST(p_partkey AS STRING) AS lt_title,
       CAST(CASE WHEN p_size > 45 THEN 1 ELSE 0 END AS BIGINT) AS lt_namespace
FROM {part}
UNION ALL
SELECT 8000000000000 + p_partkey, 'part_' || CAST(p_partkey AS STRING), CAST(1 AS BIGINT)
FROM {part} WHERE p_brand = 'Brand#9' AND p_size <= 45
UNION ALL
SELECT 5000000000000 + o_orderkey, 'order_' || CAST(o_orderkey AS STRING),
       CAST(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 2 ELSE 0 END AS BIGINT)
FROM {orders}
UNION ALL
SELECT 6000000000000 + r_regionkey, 'portal_' || r_name, CAST(0 AS BIGINT) FROM {region}
UNION ALL
SELECT 7000000000000 + s_suppkey, 'missing_' || CAST(s_suppkey AS STRING), CAST(0 AS BIGINT)
FROM {supplier}
""",
    "pagelinks": """
SELECT 1000000000000 + l_orderkey AS pl_from, CAST(0 AS BIGINT) AS pl_from_namespace,
       4000000000000 + l_partkey AS pl_target_id
FROM {lineitem}
UNION ALL
SELECT l_partkey, CAST(0 AS BIGINT), 5000000000000 + l_orderkey
FROM {lineitem} WHERE l_returnflag = 'R' AND l_linestatus = 'O'
UNION ALL
SELECT l_partkey, CAST(0 AS BIGINT), CAST(6000000000000 AS BIGINT)
FROM {lineitem} WHERE l_linestatus = 'F'
UNION ALL
SELECT l_partkey, CAST(0 AS BIGINT), 7000000000000 + l_suppkey
FROM {lineitem} WHERE l_returnflag = 'A'
UNION ALL
SELECT CAST(3000000000000 AS BIGINT), CAST(0 AS BIGINT), 4000000000000 + p_partkey
FROM {part} WHERE p_type = 'PROMO'
UNION ALL
SELECT p_partkey, CAST(0 AS BIGINT), 4000000000000 + p_partkey + 1 FROM {part}
UNION ALL
SELECT p_partkey, CAST(0 AS BIGINT), 4000000000000 + p_partkey - 1 FROM {part} WHERE p_size <= 5
UNION ALL
SELECT p_partkey, CAST(0 AS BIGINT), 4000000000000 + p_partkey - 8
FROM {part} WHERE p_type = 'LARGE'
UNION ALL
SELECT p_partkey, CAST(0 AS BIGINT), 4000000000000 + p_partkey FROM {part} WHERE p_size = 13
""",
}


def derived_tables(spark: SparkSession, folder: str) -> LinkTables:
    """The four link tables from the Parquet tables in ``folder``, lazily."""
    inputs = {
        name: spark.read.schema(columns).parquet(f"{folder}/{name}.parquet")
        for name, columns in INPUTS.items()
    }
    frames = {}
    for name, text in DERIVED_SQL.items():
        used = {k: v for k, v in inputs.items() if "{" + k + "}" in text}
        frames[name] = conform(spark.sql(text, **used), name)
    return LinkTables(**frames)


def second_engine_sql() -> dict[str, str]:
    """The same SELECTs over tables of the inputs' own names."""
    return {
        name: text.format(**{k: k for k in INPUTS}).strip() for name, text in DERIVED_SQL.items()
    }
