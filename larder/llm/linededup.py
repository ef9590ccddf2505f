"""Site-relative line dedup: a line on too large a share of a host's pages is boilerplate and goes.

A line is compared without blanks around it, by its MD5. Empty lines are layout and stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import fresh, without
from larder.sources.staging import settle

RATIO = 0.05
MIN_PAGES = 5


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    return F.unhex(F.md5(F.encode(F.btrim(line, F.lit(" \t\r")), "UTF-8")))


def _blank(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r")) == ""


def boilerplate(
    pages: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False
) -> DataFrame:
    """(host, lines) of each host that has lines on more than `ratio`, and at least `min_pages`, of its pages.

    A page counts once for a line however often it repeats it. With `copies_once`, pages of one host with the same whole
    text (by MD5) are one page, for the lines as for the host. Counting combines before the shuffle. A host's list is
    short by proof: it holds at most (mean lines per page) / `ratio` digests of 16 bytes, in order. On hosts of fewer than
    `min_pages` / `ratio` pages, 100 by default, `min_pages` decides and not the ratio: without such a floor every line of a
    host of under 1 / `ratio` pages would be boilerplate.
    """
    keys = F.array_distinct(F.transform(F.filter(_lines(F.col(text)), lambda x: ~_blank(x)), _key))
    if copies_once:
        whole = F.unhex(F.md5(F.encode(F.col(text), "UTF-8"))).alias("page")
        counted = pages.select(F.col(host).alias("host"), whole, keys.alias("keys")).groupBy("host", "page").agg(F.first("keys").alias("keys"))
        found = counted.select("host", F.explode("keys").alias("line"))
        sites = pages.select(F.col(host).alias("host"), whole).distinct()
    else:
        found = pages.select(F.col(host).alias("host"), F.explode(keys).alias("line"))
        sites = pages.select(F.col(host).alias("host"))
    on = found.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = sites.groupBy(F.col("host").alias("site")).agg(F.count("*").alias("pages"))
    common = on.join(totals, F.col("host").eqNullSafe(F.col("site"))).where(F.col("n") > F.lit(ratio) * F.col("pages"))
    return common.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def _holds(sorted_keys: Column, key: Column) -> Column:
    """Whether the array, in order, holds the key: a binary search, so that a page's lines cost no more on a host with many keys."""
    size = F.size(sorted_keys)
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.greatest(size, F.lit(1)))).cast("int") + 1)

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["lo"] + state["hi"], 1)
        below = F.get(sorted_keys, middle) < key
        lo, hi = F.when(below, middle + 1).otherwise(state["lo"]), F.when(below, state["hi"]).otherwise(middle)
        done = state["lo"] >= state["hi"]
        return F.struct(F.when(done, state["lo"]).otherwise(lo).alias("lo"), F.when(done, state["hi"]).otherwise(hi).alias("hi"))

    place = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), size.alias("hi")), halve, lambda state: state["lo"])
    return F.coalesce(F.get(sorted_keys, place) == key, F.lit(False))


def drop_boilerplate(
    pages: DataFrame, host: str, text: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False
) -> DataFrame:
    """The pages with `text` cleared of boilerplate lines, and `n_lines`, `n_dropped`.

    Every row stays, an all-boilerplate text as an empty one; a null text stays null, with no lines. Pages without a
    host are a site of their own. Repeated rows are separate pages, so a large group of copies loses its lines in each;
    with `copies_once` they count as one page, for frames whose copies are dropped only later. Columns named as the added
    ones are replaced. The texts aren't regrouped: the hosts' short lists are a table of their own, so that Spark knows
    their size and sends them to the pages where they are small.
    """
    listed = boilerplate(pages, host, text, ratio, min_pages, copies_once)
    rows = without(pages, ["n_lines", "n_dropped"])
    order = rows.columns
    site, lines, left = (fresh(c, rows) for c in ("site", "lines", "left"))
    listed = settle(listed.select(F.col("host").alias(site), F.col("lines").alias(lines)), "boilerplate")
    joined = rows.join(listed, rows[f"`{host}`"].eqNullSafe(listed[site]), "left")
    whole = _lines(F.col(f"`{text}`"))
    kept = F.when(F.col(lines).isNull(), whole).otherwise(F.filter(whole, lambda x: _blank(x) | ~_holds(F.col(lines), _key(x))))
    n = F.coalesce(F.size(whole), F.lit(0))
    joined = joined.withColumn(left, kept)
    clean = F.when(F.col(f"`{text}`").isNotNull(), F.concat_ws("\n", left))
    n_lines = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(n)
    return joined.select(
        *(clean.alias(c) if c == text else F.col(f"`{c}`") for c in order),
        n_lines.cast("long").alias("n_lines"),
        (n_lines - F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(left))).cast("long").alias("n_dropped"),
    )


def host_of(url: Column) -> Column:
    """Host of a URL, in lower case, without a leading www."""
    return F.regexp_replace(F.lower(F.parse_url(url, F.lit("HOST"))), r"^www\.", "")


SQL = f"""
WITH l AS (SELECT doc_id, source, md5(text) AS whole, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos FROM documents),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS k FROM l),
f AS (SELECT source, k, count(DISTINCT whole) AS n FROM k WHERE k <> '' GROUP BY source, k),
t AS (SELECT source, count(DISTINCT text) + count(DISTINCT CASE WHEN text IS NULL THEN 1 END) AS pages FROM documents GROUP BY source),
b AS (SELECT f.source, f.k, true AS gone FROM f JOIN t ON f.source IS NOT DISTINCT FROM t.source
      WHERE n >= {MIN_PAGES} AND n > {RATIO}::DOUBLE * pages),
r AS (SELECT k.doc_id, count(*) AS n_lines, count(gone) AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone IS NULL), '') AS text
      FROM k LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.k = b.k GROUP BY k.doc_id)
SELECT d.doc_id, r.text AS text, coalesce(r.n_lines, 0)::BIGINT AS n_lines, coalesce(r.n_dropped, 0)::BIGINT AS n_dropped
FROM documents d LEFT JOIN r ON d.doc_id = r.doc_id
"""
