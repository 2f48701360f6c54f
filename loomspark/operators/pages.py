"""Pages of documents put together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat_pages(pages: DataFrame, by: list[str], texts: list[str], lists: tuple[str, ...] = ()) -> DataFrame:
    """by, n_pages, the columns ``texts`` of the pages in order (page), those that aren't empty joined by a blank line, and the
    columns ``lists`` in one list each."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("page", F.col(c).alias("x")))), lambda p: p["x"])
    filled = lambda c: F.filter(ordered(c), lambda x: x.isNotNull() & (x != ""))
    flat = lambda c: F.flatten(F.filter(ordered(c), lambda x: x.isNotNull()))
    return pages.groupBy(*by).agg(F.count("*").alias("n_pages"), *[F.array_join(filled(c), "\n\n").alias(c) for c in texts], *[flat(c).alias(c) for c in lists])
