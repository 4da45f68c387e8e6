"""Line dedup by site-relative frequency (operator 10).

A line's ratio on a host is the number of the host's pages that contain it by the number of the host's pages.  Lines whose
ratio exceeds ``ratio``, on ``least_pages`` pages at least, are boilerplate and go from every page of that host.

Lines are first counted by a 64-bit hash, which is what is shuffled; the few whose count could be enough are then counted by
their bytes, so no collision drops a line.  Hosts are no key of any shuffle by themselves: lines meet the boilerplate by host
and line, and pages what they lose by host and digest, so a host with a third of all pages is spread like the others.  Only
lines that a bit map takes for boilerplate, and the texts of pages that lose one, are moved.

Cases: a page counts a line once, however often it repeats in it; lines are equal if their bytes are; blank lines neither
count nor go.  A page that has nothing but boilerplate keeps its text: it is a copy, not a frame around something.  A null
host is the host with the empty name; a null or empty text has no lines and stays as it is.  An empty table gives no rows.
All columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import keep, likely

#: Real boilerplate is on a tenth of a host's pages and more; lines of groups of near copies stay under a twentieth.
RATIO, LEAST_PAGES = 0.06, 5


def _lines(text: Column) -> Column:
    return F.split(text.cast("string"), "\n", -1)


def _counted(text: Column) -> Column:
    """The distinct lines of a page that count."""
    return F.array_distinct(F.filter(_lines(text), lambda line: F.trim(line) != ""))


def _owner(host: Column) -> Column:
    return F.coalesce(host.cast("string"), F.lit(""))


def boilerplate(pages: DataFrame, host: Column, text: Column, ratio: float, least_pages: int) -> DataFrame:
    """(host, line, h): the boilerplate of each host, and the hash of host and line."""
    owner = _owner(host).alias("host")
    totals = pages.select(owner).groupBy("host").agg(F.count("*").alias("pages"))
    enough = (F.col("n") >= least_pages) & (F.col("n") > F.lit(ratio) * F.col("pages"))
    hashed = pages.select(owner, F.explode(F.transform(_counted(text), lambda line: F.xxhash64(line))).alias("h"))
    often = hashed.groupBy("host", "h").agg(F.count("*").alias("n")).filter(F.col("n") >= least_pages)
    candidates = keep(often.join(totals, "host").filter(enough).select("host", "h", "pages", F.xxhash64("host", "h").alias("key")), "likely")
    every = pages.select(owner, F.explode(_counted(text)).alias("line")).withColumn("h", F.xxhash64("line"))
    exact = likely(every, F.xxhash64("host", "h"), candidates.select("key"), "counts").filter("counts").join(candidates, ["host", "h"])
    found = exact.groupBy("host", "line").agg(F.count("*").alias("n"), F.max("pages").alias("pages")).filter(enough)
    return keep(found.select("host", "line", F.xxhash64("host", F.xxhash64("line")).alias("h")), "boilerplate")


def losses(pages: DataFrame, host: Column, text: Column, found: DataFrame) -> DataFrame:
    """(host, page, key, gone): the places of the lines that go, by host and digest of the text; key: the hash of these two."""
    every = pages.select(_owner(host).alias("host"), F.unhex(F.sha2(text, 256)).alias("page"), F.posexplode(_lines(text)).alias("at", "line"))
    hit = likely(every, F.xxhash64("host", F.xxhash64("line")), found.select("h"), "goes").filter("goes").join(found.drop("h"), ["host", "line"])
    gone = hit.groupBy("host", "page").agg(F.sort_array(F.collect_set("at")).alias("gone"))
    return keep(gone.withColumn("key", F.xxhash64("host", "page")), "losses")


def drop_boilerplate(pages: DataFrame, *, host: str | Column = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, dropped: str | None = None) -> DataFrame:
    """pages with the boilerplate gone from ``text``.  dropped: a column to add, with the number of lines that went."""
    own, body = F.col(host) if isinstance(host, str) else host, F.col(text)
    cuts = losses(pages, own, body, boilerplate(pages, own, body, ratio, least_pages))
    taken = {c.lower() for c in pages.columns}
    owner, page, loses, lines, gone, kept = [name for name in (f"tidemark_{k}" for k in range(len(taken) + 6)) if name not in taken][:6]
    columns = [F.col(f"`{c}`") for c in pages.columns]

    def told(frame: DataFrame, cleaned: Column, n: Column) -> DataFrame:
        return frame.select(*[cleaned.alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns], *([n.cast("long").alias(dropped)] if dropped else []))

    named = pages.withColumns({owner: _owner(own), page: F.unhex(F.sha2(body, 256))})
    marked = likely(named, F.xxhash64(owner, page), cuts.select("key"), loses)
    whole = told(marked.filter(~F.col(loses)), body, F.lit(0))
    # lines in place of the text: they are the text, joined, and so are split once
    moved = marked.filter(F.col(loses)).select(*[c for c, name in zip(columns, pages.columns, strict=True) if name != text], owner, page, _lines(body).alias(lines))
    met = moved.join(cuts.select(F.col("host").alias(owner), F.col("page").alias(page), F.col("gone").alias(gone)), [owner, page], "left")
    borders = F.concat(F.array(F.lit(-1)), F.col(gone), F.array(F.size(lines)))
    between = F.arrays_zip(F.slice(borders, 1, F.size(gone) + 1).alias("a"), F.slice(borders, 2, F.size(gone) + 1).alias("b"))
    rest = F.flatten(F.transform(between, lambda x: F.slice(F.col(lines), x["a"] + 2, x["b"] - x["a"] - 1)))
    cut = met.withColumn(kept, F.when(F.col(gone).isNotNull(), rest))
    acts = F.col(kept).isNotNull() & F.exists(kept, lambda line: F.trim(line) != "")
    left = F.when(acts, F.array_join(kept, "\n")).otherwise(F.array_join(lines, "\n"))
    return whole.unionByName(told(cut, left, F.when(acts, F.size(gone)).otherwise(0)))
