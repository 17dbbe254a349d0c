"""URL filter: rules first, then a block list behind a blocked Bloom filter.

Listed URLs and page URLs are compared in a canonical form. The filter is a
table of blocks of eight 32-bit words; a URL picks one block and one bit in
every word. It has at most ``MAX_BLOCKS`` rows (8 MB of bits) however long the
list is, so it can go to every executor: with a longer list more pages pass it,
and no result changes, as all that pass meet the list itself in a hash join.
"""

from pyspark.sql import Column, DataFrame, functions as F

from linkloom.llm.tables import lower_ascii
from linkloom.sources.workspace import Workspace

MAX_BLOCKS = 1 << 18
URLS_PER_BLOCK = 16
WORDS = 8

# Query parameters that only track where a visitor came from.
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid)(=|$)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; '' without."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for a URL: host without ``www.``, path without a final ``/``,
    and its parameters in order without those that track. NULL or no ``://``: NULL.
    """
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    )
    whole = F.concat(
        F.regexp_replace(host_of(url), r"^www\.", ""),
        F.regexp_replace(path_of(url), "/$", ""),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""),
    )
    return F.when(F.instr(url, "://") > 0, whole)


def rule_for(host: Column, path: Column, rules) -> Column:
    """The longest rule ``(action, host, path)`` that fits, as struct (rule, action).

    A rule fits its host and all subdomains where the URL's path starts with the
    rule's. Rules are configuration: each adds one branch to the expression.
    """
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in sorted(
        rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])
    ):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))
        found = F.when(fits, value).otherwise(found)
    return found


def _place(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number of a URL and its bit in each word of the block."""
    second = F.xxhash64(url, F.lit("bits"))
    bits = [
        F.call_function(
            "shiftleft", F.lit(1), F.shiftrightunsigned(second, 5 * i).bitwiseAND(31).cast("int")
        )
        for i in range(WORDS)
    ]
    return F.pmod(F.xxhash64(url), F.lit(blocks)), bits


def bloom_filter(listed: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """Filter over the column ``url`` of ``listed``, and its number of blocks."""
    blocks = 1
    while blocks * URLS_PER_BLOCK < rows and blocks < MAX_BLOCKS:
        blocks *= 2
    block, bits = _place(F.col("url"), blocks)
    table = listed.groupBy(block.alias("block")).agg(
        *(F.bit_or(bit).alias(f"w{i}") for i, bit in enumerate(bits))
    )
    return table, blocks


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules=(), id_col="page_id", url_col="url"
) -> DataFrame:
    """Verdict for every row of ``pages``; ``listed`` has URLs to block in ``url``.

    Returns id, host, path, rule, verdict (``allow`` or ``block``) and
    ``listed`` (whether the canonical URL is on the list). The longest rule that fits
    decides, else the list.

    NULL or a text without ``://`` has an empty host and path, fits no rule and
    is on no list: allowed. NULLs and repeats in ``listed`` count for nothing, an
    empty list blocks nothing. Repeated pages give repeated rows. Other columns of
    ``pages`` are not read.
    """
    spark = pages.sparkSession
    work = Workspace(spark)
    urls, seen = work.store(
        listed.select(canonical(F.col("url")).alias("url")).where(F.col("url").isNotNull()).distinct(),
        "listed",
        n=F.count("*"),
    )
    table, blocks = bloom_filter(urls, seen["n"])
    url = F.col("__url")
    rows = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("__url")).select(
        id_col,
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        canonical(url).alias("__canonical"),
    )
    block, bits = _place(F.col("__canonical"), blocks)
    all_set = F.lit(True)
    for i, bit in enumerate(bits):
        all_set = all_set & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    # The filter has at most MAX_BLOCKS rows.
    probed = rows.join(F.broadcast(table), block == F.col("block"), "left").select(
        *rows.columns, F.coalesce(all_set, F.lit(False)).alias("__maybe")
    )
    hits = probed.where("__maybe").join(
        urls.withColumnRenamed("url", "__listed"), F.col("__canonical") == F.col("__listed"), "left"
    )
    passed = probed.where(~F.col("__maybe")).withColumn("__listed", F.lit(None).cast("string"))
    on_list = F.col("__listed").isNotNull()
    rule = rule_for(F.col("host"), F.col("path"), rules)
    return (
        hits.unionByName(passed)
        .withColumn("__rule", rule)
        .select(
            id_col,
            "host",
            "path",
            F.col("__rule.rule").alias("rule"),
            F.coalesce(
                F.col("__rule.action"), F.when(on_list, F.lit("block")).otherwise("allow")
            ).alias("verdict"),
            on_list.alias("listed"),
        )
    )
