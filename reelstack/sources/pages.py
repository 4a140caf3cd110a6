"""Paginated API documents, flattened.

The reference crawls ``discover`` pages year by year and genre by genre, from
page 1 upward, and stops a (year, genre) crawl at the first failed response or
after the page that reaches ``total_pages``. Here the pages are landed documents
and the stop rule becomes a filter computed per crawl group, so all groups are
flattened in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions._util import names
from ..session import materialize


_KEYS, _FAIL, _LAST, _GAP = "_pg_keys", "_pg_fail", "_pg_last", "_pg_gap"


def stop_points(pages: DataFrame, keys, page_col: str = "page") -> DataFrame:
    """One row per crawl group: its first failed page, its first last page
    (``page >= total_pages``) and the first page that was never landed.

    A landed page whose predecessor is missing begins an island; the crawl ends
    before the first one. Predecessors are found by a join on (group, page), which
    spreads a group over tasks, so no group is sorted or collected."""
    group = F.struct(*[F.col(k) for k in names(keys)]).alias(_KEYS)
    page = F.col(page_col).cast("long")
    ends = pages.groupBy(group).agg(
        F.min(F.when(F.col("status") != 200, page)).alias(_FAIL),
        F.min(F.when((F.col("status") == 200) & (page >= F.col("total_pages")), page)).alias(_LAST))
    landed = pages.filter(page >= 1).select(group, page.alias("_p")).distinct()
    followed = landed.select(_KEYS, (F.col("_p") + 1).alias("_p"))
    islands = landed.filter("_p > 1").join(followed, [_KEYS, "_p"], "left_anti")
    # A group whose first page is missing ends before page 1.
    starts = landed.groupBy(_KEYS).agg(F.min("_p").alias("_lo")).filter("_lo > 1").select(_KEYS, F.lit(1).cast("long").alias("_p"))
    gaps = islands.unionByName(starts).groupBy(_KEYS).agg(F.min("_p").alias(_GAP))
    return ends.join(gaps, _KEYS, "left")


def flatten_pages(pages: DataFrame, keys, max_pages: int | None = None,
                  page_col: str = "page", pos_col: str | None = "position") -> DataFrame:
    """Rows of the pages a sequential crawl would have read, one per result.

    A page of a crawl group is kept when its status is 200, it is at most
    ``max_pages``, no earlier page of the group failed or is missing, and no earlier
    page was already the last one (``page >= total_pages``). ``position`` is the
    0-based place of the row inside its page, so (keys, page, position) is the
    crawl order. Null keys are a group like any other.

    The landed pages are already what the crawl's page cap let through;
    ``max_pages`` applies such a cap again, for documents landed without it.

    The stop points are one row per crawl group, taken from the small fields (a
    reader with a declared schema parses no results for them) and
    stored; AQE picks the join with the pages from its measured size.
    """
    keys = names(keys)
    page = F.col(page_col)
    ends = materialize(stop_points(pages, keys, page_col), "stop_points")
    reached = lambda c, op: F.col(c).isNull() | op(page, F.col(c))
    kept = pages.withColumn(_KEYS, F.struct(*[F.col(k) for k in keys])).join(ends, _KEYS).filter(
        (F.col("status") == 200) & (page >= 1)
        & reached(_FAIL, lambda p, c: p < c) & reached(_GAP, lambda p, c: p < c) & reached(_LAST, lambda p, c: p <= c)
        & (F.lit(True) if max_pages is None else page <= max_pages))
    exploded = kept.select(*keys, page, F.posexplode("results").alias("_pos", "_r"))
    cols = [*keys, page_col] + ([F.col("_pos").alias(pos_col)] if pos_col else [])
    return exploded.select(*cols, "_r.*")
