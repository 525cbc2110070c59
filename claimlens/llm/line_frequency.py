"""Removing a site's boilerplate lines by how many of the site's pages contain them.

A line's share of a site is the number of the site's pages that contain it, divided by the number of the
site's pages. Lines above a share are dropped from every page of that site; elsewhere they stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.session import stage

SHARE = 0.02
LEAST_PAGES = 3  # a line that fewer pages of a site contain is no boilerplate, however small the site


def line_key(line: Column) -> Column:
    """What makes two lines the same: their text without white space at either end (64-bit hash)."""
    return F.xxhash64(F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", ""))


def has_words(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def boilerplate(
    pages: DataFrame, site: str, text: str, share: float, least_pages: int, copies: str | None, same: DataFrame | None
) -> DataFrame:
    """(site, keys): the keys of each site's boilerplate lines.

    A page adds each of its lines once, and sites and lines are counted before anything moves, so a large
    site or a line of every page is no large group. Since a page's lines are divided among the lines of
    a site, a site has at most (lines a page, on average) / share of them: its array stays small. With
    ``copies``, lines and pages are made distinct per group of copies before they are counted. A page meets ``same``
    with the keys of its lines, not with its text.
    """
    named = [] if copies is None else [F.col(f"`{copies}`").alias("__copies")]
    lines = F.split(F.col(text).cast("string"), "\n")
    keys = F.array_distinct(F.transform(F.filter(lines, has_words), line_key))
    rows = pages.where(F.col(site).isNotNull()).select(F.col(site).alias("__site"), keys.alias("__keys"), *named)
    if same is not None:
        rows = rows.join(same.select(F.col(f"`{copies}`").alias("__copies"), "__first"), "__copies", "left")
        rows = rows.select("__site", "__keys", F.coalesce("__first", "__copies").alias("__copies"))
    held, sites = rows.select("__site", F.explode_outer("__keys").alias("__line"), *rows.columns[2:]), rows.drop("__keys")
    # explode() would filter by the array below the join and so make it twice.
    held = held.where(F.col("__line").isNotNull())
    if copies is not None:
        held, sites = held.distinct(), sites.distinct()
    counts = held.groupBy("__site", "__line").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= least_pages)
    sizes = stage(sites.groupBy("__site").agg(F.count(F.lit(1)).alias("__pages")), "site-pages")
    often = counts.join(sizes, "__site").where(F.col("__n") > share * F.col("__pages"))
    return often.groupBy("__site").agg(F.sort_array(F.collect_list("__line")).alias("__drop"))


def without_boilerplate(
    pages: DataFrame,
    site: str,
    text: str = "text",
    share: float = SHARE,
    least_pages: int = LEAST_PAGES,
    copies: str | None = None,
    same: DataFrame | None = None,
) -> DataFrame:
    """The pages with their boilerplate lines removed from ``text``, and n_lines and n_dropped.

    Lines are what newlines divide; a line without a word is never dropped and never counted as dropped.
    A null text stays null and is a page without lines (0, 0). A page whose site is null belongs to none
    and stays as it is. Repeated rows are pages of their own, unless ``copies`` names a column: rows of a
    site with one value of it count as one page, which holds the lines of them all; a value that ``same`` has in that
    column, once, counts as its ``__first``. An empty table gives no rows. Columns named n_lines and n_dropped are replaced, all others kept.

    The pages stay where they are unless the sites' arrays, whose written size the planner knows, are too
    many to send to every task; then both are dealt by site, and a large site is split.
    """
    found = stage(boilerplate(pages, site, text, share, least_pages, copies, same), "boilerplate")
    kept = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{site}`").alias("__site")).join(found, "__site", "left")
    drop = F.coalesce("__drop", F.array().cast("array<bigint>"))
    lines = F.split(F.col(f"`{text}`").cast("string"), "\n")
    stays = F.filter(lines, lambda line: ~has_words(line) | ~F.array_contains(drop, line_key(line)))
    rows = rows.withColumns({"__lines": F.when(F.size(drop) > 0, stays).otherwise(lines), "__all": F.size(lines)})
    return rows.withColumns(
        {
            text: F.when(F.size(drop) > 0, F.array_join("__lines", "\n")).otherwise(F.col(f"`{text}`")),
            "n_lines": F.coalesce(F.greatest(F.lit(0), F.col("__all")), F.lit(0)).cast("bigint"),
            "n_dropped": F.coalesce(F.greatest(F.lit(0), F.col("__all") - F.size("__lines")), F.lit(0)).cast("bigint"),
        }
    ).drop("__site", "__drop", "__lines", "__all")
