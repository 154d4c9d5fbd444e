"""Lines that a site repeats on too many of its pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.llm.scratch import cut

#: Share of a site's pages and number of pages from which a line is boilerplate.
RATIO, PAGES = 0.05, 5
#: Boilerplate lines up to which the list is sent to every task; above it the tables are joined by site.
SMALL = 50_000


def parts(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(df: DataFrame, host: Column, text: str = "text", ratio: float = RATIO, pages: int = PAGES) -> DataFrame:
    """(host, line, n_pages, of_pages): md5 of each boilerplate line of each host.

    Pages of a host are its distinct texts, so copies of one page do not turn its
    own lines into boilerplate. Only digests are shuffled, one row per distinct page
    and then one per page and line, counted before the shuffle. A host has at most
    its mean lines per page divided by ``ratio`` of such lines.
    """
    solid = F.filter(parts(F.col(text)), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    digests = F.array_distinct(F.transform(solid, lambda x: F.unhex(F.md5(x))))
    site = df.filter(F.col(text).isNotNull() & host.isNotNull()).select(
        host.alias("host"), F.unhex(F.md5(text)).alias("page"), digests.alias("lines"))
    site = site.groupBy("host", "page").agg(F.first("lines").alias("lines"))
    rows = site.select("host", F.explode(F.concat(F.array(F.lit(None).cast("binary")), F.col("lines"))).alias("line"))
    counts = rows.groupBy("host", "line").agg(F.count("*").alias("n_pages"))
    counts = cut(counts.filter(F.col("line").isNull() | (F.col("n_pages") >= pages)), "lines")  # null: the pages of the host
    totals = counts.filter("line is null").select("host", F.col("n_pages").alias("of_pages"))
    return counts.filter("line is not null").join(totals, "host").filter(
        F.col("n_pages") >= F.col("of_pages") * ratio).select("host", "line", "n_pages", "of_pages")


def drop_lines(df: DataFrame, host: Column | None = None, text: str = "text", ratio: float = RATIO,
               pages: int = PAGES, dropped: str | None = "n_dropped") -> DataFrame:
    """``df`` with its text without the boilerplate lines of its host, and ``n_dropped``, the lines that went.

    A line goes if at least ``pages`` pages and at least a share ``ratio`` of the
    host's pages have it; every place of it goes, the others keep their order.
    Lines of white space alone stay. A null text stays null, a null host has no
    boilerplate, a text that was all boilerplate becomes empty, equal rows are
    treated alike. Other columns keep their names, whatever these are; a column named like ``dropped`` is
    replaced, and with None no count is added.

    DataFrame operations only. The boilerplate list is written first; up to
    ``SMALL`` lines it is broadcast and no text moves, beyond that texts are
    joined by host, where Spark splits a hot host. Both give the same rows.
    """
    host = F.col("source") if host is None else host
    found = cut(boilerplate(df, host, text, ratio, pages), "boilerplate")
    by_host = found.groupBy(F.col("host").alias("site_host")).agg(F.collect_set("line").alias("site_lines"))
    if found.count() <= SMALL:
        by_host = F.broadcast(by_host)
    # numbered names meet no name of the list
    names = [c for c in df.columns if c != dropped]
    own = df.select(*(F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(names)), host.alias("d_host"), F.col(f"`{text}`").alias("d_text"))
    joined = own.join(by_host, F.col("d_host") == F.col("site_host"), "left")
    kept = F.filter(parts(F.col("d_text")), lambda x: ~F.array_contains(F.col("site_lines"), F.unhex(F.md5(x))))
    done = joined.select(*(f"d{i}" for i, c in enumerate(names) if c != text), F.when(F.col("site_lines").isNull(), F.struct(
        F.col("d_text").alias("t"), F.lit(0).cast("bigint").alias("n"))).otherwise(F.struct(
            F.array_join(kept, "\n").alias("t"), (F.size(parts(F.col("d_text"))) - F.size(kept)).cast("bigint").alias("n"))).alias("done"))
    count = [F.coalesce("done.n", F.lit(0).cast("bigint")).alias(dropped)] if dropped else []
    return done.select(*(F.col("done.t" if c == text else f"d{i}").alias(c) for i, c in enumerate(names)), *count)
