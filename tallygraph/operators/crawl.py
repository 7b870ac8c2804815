"""Crawl order over a captured link table: breadth first per site."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.operators.positions import first_per_group, ranked
from tallygraph.session import materialize, union_all

JOINED = 16             # levels after which what was taken is written as one table


def bfs_order(edges: DataFrame, seeds: DataFrame, cap: int | None, blocked: DataFrame | None = None) -> DataFrame:
    """(site, url, ord, level): the order in which a polite crawler takes the pages of each site.

    ``edges`` has site, url, link; ``seeds`` has site, url, ord (the seed page is
    0, sitemap pages follow).  New links queue behind older ones, sorted per
    page; a page is taken once; a site ends at ``cap`` pages, if there is one.
    ``blocked`` (site, url) pages count but their links are not read.

    All sites advance one level per round.  A round reads the links of the last level only
    and writes the new level; pages taken before are read to leave them out, not written
    again.  A level's order comes from range parts, so one huge site is many tasks.
    With a cap, of one page only the first ``2 * cap`` links can matter: fewer than ``cap``
    of them are known already, and at most ``cap`` more are taken.
    """
    listed = edges.select("site", "url", "link").distinct()
    useful = materialize(first_per_group(listed, ["site", "url"], ["link"], 2 * cap) if cap else listed)
    level = materialize(first_per_group(seeds.select("site", "url", "ord"), ["site"], ["ord"], cap or 0)
                        .select("site", "url", F.col("ord").cast("bigint").alias("ord"), F.lit(0).alias("level")))
    levels, done = [level], level.groupBy("site").agg(F.count(F.lit(1)).alias("done"))
    for depth in itertools.count(1):
        if level.isEmpty():
            break
        readable = level if blocked is None else level.join(blocked, ["site", "url"], "left_anti")
        new = (readable.select("site", "url", F.col("ord").alias("parent"))
               .join(useful, ["site", "url"])
               .groupBy("site", F.col("link").alias("url")).agg(F.min("parent").alias("parent")))
        for before in levels:
            new = new.join(before.select("site", "url"), ["site", "url"], "left_anti")
        placed = ranked(new, ["site"], ["parent", "url"], "place").join(done, "site") \
            .select("site", "url", (F.col("done") + F.col("place")).alias("ord"), F.lit(depth).alias("level"))
        level = materialize(placed.filter(F.col("ord") < cap) if cap else placed)
        done = materialize(done.unionByName(level.groupBy("site").agg(F.count(F.lit(1)).alias("done")))
                           .groupBy("site").agg(F.sum("done").alias("done")))
        levels.append(level)
        if len(levels) > JOINED:
            levels = [materialize(union_all(levels))]
    return union_all(levels)
