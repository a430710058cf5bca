"""Connected components of links, by contraction under random priorities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id in ``links``; a component is named by its smallest id.

    Each round maps an id to the neighbour (or itself) that comes first in a
    random order of that round, renames the ends of the links and drops those
    within one id. The order being random, a constant share of the ids goes in
    each round, for chains as for stars, so rounds grow with the logarithm of the
    longest chain. Every grouping is a minimum, combined before its shuffle; no
    id's links are gathered. Links and names are tables in the shared folder.
    Empty links give an empty frame; null ends and links of an id to itself do
    not link.
    """
    kind = dict(links.dtypes)[a]
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    links = stored(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    names = None
    seed = 0
    while not links.isEmpty():
        seed += 1
        both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
        rank = [F.struct(F.xxhash64(F.lit(seed), F.col(c)).alias("r"), F.col(c).alias("id")) for c in ("u", "v")]
        first = both.groupBy("u").agg(F.least(F.min(rank[1]), F.min(rank[0])).alias("m"))
        parent = stored(first.select(F.col("u").alias("id"), F.col("m.id").alias("parent")), "parents")
        left = parent.select(F.col("id").alias("u"), F.col("parent").alias("pu"))
        right = parent.select(F.col("id").alias("v"), F.col("parent").alias("pv"))
        moved = links.join(left, "u").join(right, "v").where(F.col("pu") != F.col("pv"))
        moved = moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct()
        links = stored(moved, "links")
        if names is None:
            names = parent.select("id", F.col("parent").alias("name"))
        else:
            step = parent.select(F.col("id").alias("name"), "parent")
            names = stored(names.join(step, "name", "left").select(
                "id", F.coalesce("parent", "name").alias("name")), "names")
    if names is None:
        return links.select(F.col("u").cast(kind).alias("id"), F.col("v").cast(kind).alias("component"))
    smallest = names.groupBy("name").agg(F.min("id").alias("component"))
    return names.join(smallest, "name").select("id", "component")
