"""Page-to-page links and the pairs of pages that link to each other."""

from pyspark.sql import DataFrame, functions as F

from linkloom.functions.columns import pair_array, pair_high, pair_low

# A target with more than one such part of all links is hot, and gets a salt for each part.
SHARES = 200
# Targets that the sketch of link counts keeps track of: its size, and a bound of its error.
TRACKED = 10_000


def raw_links(resolved: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """One (page_a, page_b) row per link row whose target is in ``resolved``.

    The largest join. Both sides are shuffled as they are, which lets adaptive
    execution split the partition of a hot target into several tasks.
    """
    return pagelinks.join(resolved, pagelinks.pl_target_id == resolved.lt_id).select(
        F.col("pl_from").alias("page_a"), F.col("page_id").alias("page_b")
    )


def hot_targets(pagelinks: DataFrame) -> DataFrame:
    """(hot_target, salts) of targets with more than a ``1 / SHARES`` share of all links, from one pass.

    A sketch of fixed size finds the ``TRACKED`` heaviest targets; at most ``SHARES`` of them can have
    so many links, so the result is small whatever the data. It is one row of counts until it is unpacked,
    and lazy. A target's estimate may exceed its count a little, which costs a salt and changes no result.
    """
    sketch = pagelinks.agg(
        F.expr(f"approx_top_k(pl_target_id, {SHARES}, {TRACKED})").alias("top"),
        F.count("pl_target_id").alias("n"),
    )
    heavy = sketch.select(F.inline("top"), "n").toDF("hot_target", "links", "n")
    return heavy.where(F.col("links") * SHARES > F.col("n")).select(
        "hot_target", F.ceil(F.col("links") * SHARES / F.col("n")).cast("int").alias("salts")
    )


def raw_links_salted(resolved: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """The rows of ``raw_links``, with the links of hot targets spread by salts.

    A hot target's links get as many salts as it has shares, by the page they come from, and its resolved rows a copy for
    each. All other rows have one salt. The plan does not need adaptive execution to keep tasks alike.
    """
    hot = F.broadcast(hot_targets(pagelinks))
    salts = F.coalesce("salts", F.lit(1))
    salt = F.pmod(F.xxhash64("pl_from"), salts).cast("int")
    spread = pagelinks.join(hot, F.col("pl_target_id") == F.col("hot_target"), "left").select(
        "pl_from", "pl_target_id", salt.alias("salt")
    )
    copies = resolved.join(hot, F.col("lt_id") == F.col("hot_target"), "left").select(
        "lt_id", "page_id", F.explode(F.sequence(F.lit(0), salts - 1)).alias("copy")
    )
    met = (F.col("pl_target_id") == F.col("lt_id")) & (F.col("salt") == F.col("copy"))
    return spread.join(copies, met).select(F.col("pl_from").alias("page_a"), F.col("page_id").alias("page_b"))


def page_links(resolved: DataFrame, pagelinks: DataFrame) -> DataFrame:
    """Distinct page-to-page links. ``page_b`` is NULL for unresolved targets."""
    return raw_links(resolved, pagelinks).distinct()


def ascending_links(links: DataFrame) -> DataFrame:
    """Links from a smaller to a larger page id, whether answered or not."""
    return links.where(F.col("page_a") < F.col("page_b")).distinct()


def sorted_pairs(links: DataFrame) -> DataFrame:
    """Links with their ends in ascending order as ``lo`` and ``hi``."""
    a, b = F.col("page_a"), F.col("page_b")
    return links.select(a, b, pair_low(a, b).alias("lo"), pair_high(a, b).alias("hi"))


def sorted_pair_arrays(links: DataFrame) -> DataFrame:
    """Links with their ends in ascending order as one array column."""
    return links.withColumn("sorted_pair", pair_array(F.col("page_a"), F.col("page_b")))


def pair_frequencies(pairs: DataFrame, *keys: str) -> DataFrame:
    """Number of distinct links per unordered pair: 2 when both directions exist."""
    return pairs.groupBy(*(keys or ("lo", "hi"))).agg(F.count("*").alias("frequency"))


def frequent_pairs(frequencies: DataFrame) -> DataFrame:
    """Pairs that were seen in both directions, from counted pairs."""
    return frequencies.where((F.col("frequency") > 1) & F.col("hi").isNotNull()).select(
        F.col("lo").alias("page_a"), F.col("hi").alias("page_b")
    )


def unpacked_pairs(frequencies: DataFrame) -> DataFrame:
    """Pairs that were seen in both directions, from counted pair arrays."""
    first, second = F.col("sorted_pair")[0], F.col("sorted_pair")[1]
    return frequencies.where((F.col("frequency") > 1) & second.isNotNull()).select(
        first.alias("page_a"), second.alias("page_b")
    )


def mutual_from_links(links: DataFrame) -> DataFrame:
    """Pairs linked both ways, from links that may repeat, in one shuffle.

    One bit per direction notes what was seen, so repeated links need no
    ``distinct`` of their own. Links to oneself and links with an unknown end
    cannot be mutual and never enter the shuffle.
    """
    a, b = F.col("page_a"), F.col("page_b")
    upward, downward = F.lit(1).cast("tinyint"), F.lit(2).cast("tinyint")
    return (
        links.where(a != b)
        .groupBy(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .agg(F.bit_or(F.when(a < b, upward).otherwise(downward)).alias("directions"))
        .where(F.col("directions") == upward + downward)
        .select(F.col("lo").alias("page_a"), F.col("hi").alias("page_b"))
    )


def pair_count(pairs: DataFrame) -> DataFrame:
    """Number of pairs, as one row."""
    return pairs.agg(F.count("*").alias("n"))
