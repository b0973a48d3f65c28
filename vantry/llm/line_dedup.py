"""Removal of boilerplate lines by their frequency within a site.

A line is boilerplate on a host if it stands on at least `min_pages` of its pages and on more
than `max_ratio` of them. Each page counts once for a line, however often it repeats there.
Only hashes and counts are shuffled, summed before they travel, so a host with a third of all
pages is no hot spot; texts stay where they are read unless the list of boilerplate grows
beyond `broadcast_rows`, when pages and lists meet by a shuffled join.

Null texts stay null and count as pages of their host; a null host is a host of its own. Blank
lines are never boilerplate. A page of which every line goes keeps an empty text. Repeated
rows are separate pages. Other columns, whatever their names, are carried along unchanged (n_lines and
n_dropped, where asked for, come last, also beside columns of these names). An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantry.llm.scratch import BROADCAST_BYTES, written

MAX_RATIO = 0.10
MIN_PAGES = 5


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """_host, line_hash (md5), n_pages, n_host_pages of the lines that exceed the ratio."""
    rows = pages.select(F.col(host).alias("_host"), F.col(text).alias("_text"))
    lines = rows.select("_host", F.explode(F.array_distinct(F.split("_text", "\n", -1))).alias("_line"))
    counts = (
        lines.where(F.trim("_line") != "")
        .select("_host", F.unhex(F.md5(F.col("_line").cast("binary"))).alias("line_hash"))
        .groupBy("_host", "line_hash")
        .agg(F.count("*").alias("n_pages"))
        .where(F.col("n_pages") >= min_pages)
    )
    hosts = rows.groupBy(F.col("_host").alias("_site")).agg(F.count("*").alias("n_host_pages"))
    found = counts.join(hosts, F.col("_host").eqNullSafe(F.col("_site")))
    return found.where(F.col("n_pages") > max_ratio * F.col("n_host_pages")).drop("_site")


def clean(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, counts: bool = False, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """pages with boilerplate lines cut out of the text; with counts also n_lines and n_dropped (long)."""
    bad = boilerplate(pages, host, text, max_ratio, min_pages).select("_host", "line_hash")
    # a line above the ratio is on so large a share of the pages that a host has at most
    # (mean distinct lines of its pages) / max_ratio of them
    lists = written(bad.groupBy(F.col("_host").cast("string").alias("_site")).agg(F.collect_list("line_hash").alias("_bad")), "boilerplate")
    held = lists.agg(F.sum(40 * F.size("_bad") + 40)).first()[0] or 0
    whole = pages.select(F.struct("*").alias("row"))  # so that no name can clash
    body = F.col("row").getField(text)
    site = F.col("row").getField(host).cast("string")
    joined = whole.join(F.broadcast(lists) if held <= broadcast_bytes else lists, site.eqNullSafe(F.col("_site")), "left")
    lines = F.split(body, "\n", -1)
    kept = F.filter(lines, lambda line: ~F.array_contains("_bad", F.unhex(F.md5(line.cast("binary")))))
    kept = F.when(F.col("_bad").isNull(), lines).otherwise(kept)
    columns = [F.array_join(kept, "\n").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in pages.columns]
    if not counts:
        return joined.select(*columns)
    size = lambda c: F.when(body.isNull(), F.lit(0)).otherwise(F.coalesce(F.size(c), F.lit(0))).cast("long")
    return joined.select(*columns, size(lines).alias("n_lines"), (size(lines) - size(kept)).alias("n_dropped"))
