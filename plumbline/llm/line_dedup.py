"""Line dedup by site-relative frequency, in DataFrame functions only.

A line that stands on more than ``ratio`` of a host's pages is boilerplate of that host and is
dropped from all of its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import fresh, written

RATIO = 0.1
MIN_PAGES = 3
BROADCAST_LINES = 200_000  # 16-byte keys, so a broadcast of a few MB at most


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    n_lines: str | None = None,
    n_dropped: str | None = None,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; all other columns stay as they are.

    Lines end at ``\\n`` and are compared without the blanks around them. A line is dropped where its
    pages are at least ``min_pages`` and more than ``ratio`` of the host's pages. ``n_lines`` and
    ``n_dropped`` name columns to add: lines before, lines dropped.

    - Every row is a page, repeated rows too; a line counts once per page.
    - Blank lines are never counted or dropped.
    - NULL hosts are one host of their own. A NULL text stays NULL: a page without lines (0 lines).
    - An empty text has one blank line. A page whose lines all go keeps its row with an empty text.
    - An empty table gives an empty table. Columns with clashing names are left alone.

    The only rows that are shuffled are (host, line key, pages), added up before they leave a task; a
    hot host or line is a few such rows per task. The lines over the ratio are few: their shares of a
    host's pages add up to no more than the mean number of lines on a page, so a host has at most
    ``mean lines / ratio`` of them. They are broadcast if all hosts together have up to
    ``BROADCAST_LINES``; beyond that the pages are joined to them by host (AQE splits a hot host).
    """
    h, keys, bad = fresh(docs, "__host", "__keys", "__bad")
    host_key = F.coalesce(F.concat(F.lit("="), F.col(f"`{host}`").cast("string")), F.lit(""))
    lines = F.split(F.col(f"`{text}`"), "\n", -1)
    pages = docs.select(host_key.alias("h"), F.array_distinct(F.filter(F.transform(lines, _key), lambda k: k.isNotNull())).alias("ks"))
    counts = pages.select("h", F.explode("ks").alias("k")).groupBy("h", "k").agg(F.count(F.lit(1)).alias("n"))
    totals = pages.groupBy("h").agg(F.count(F.lit(1)).alias("total"))
    over = (
        counts.where(F.col("n") >= min_pages)
        .join(totals, "h")
        .where(F.col("n") > F.lit(float(ratio)) * F.col("total"))
        .groupBy(F.col("h").alias(h))
        .agg(F.collect_list("k").alias(bad))
    )
    over = written(over, "boilerplate")
    n_bad = over.agg(F.sum(F.size(bad))).first()[0] or 0
    marked = docs.withColumn(h, host_key).join(F.broadcast(over) if n_bad <= BROADCAST_LINES else over, h, "left")
    found = F.coalesce(F.col(bad), F.array().cast("array<binary>"))
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(found, _key(x)), F.lit(False)))
    out = marked.withColumn(keys, kept)
    if n_lines:
        out = out.withColumn(n_lines, F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(lines)).cast("long"))
    if n_dropped:
        out = out.withColumn(n_dropped, F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(lines) - F.size(F.col(keys))).cast("long"))
    return out.withColumn(text, F.when(F.col(bad).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(F.col(keys), "\n"))).drop(h, keys, bad)


def _key(line: Column) -> Column:
    """16 bytes that stand for a line; NULL for a blank one."""
    trimmed = F.trim(line)
    return F.when(trimmed != "", F.unhex(F.md5(trimmed)))
