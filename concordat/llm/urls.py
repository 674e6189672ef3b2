"""URL verdicts: host and path rules, and block decisions carried over redirect equivalence.

Pages that name each other by a canonical link or an immediate redirect are aliases of one
another. A page that a rule fits takes the rule's verdict, so an explicit allow always stands.
A page that no rule fits is blocked where any alias of it is blocked by a rule, else allowed.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii
from .components import connected

PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
# What a reader of a page does not see as tags: comments, and elements whose content is plain text.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title)\b.*?(?:</\1\b|\z)"
TAG = r"(?is)<((?:link|meta)[\s/][^>]*)"
ATTRIBUTE = r"""(?s)(?<![^\s"'/])([^\s"'>/=]++)\s*+=\s*+("[^"]*+"?|'[^']*+'?|[^\s"'>]++)"""
TARGET = r"""(?is)^\s*[\d.]*\s*[;,]?\s*url\s*=\s*["']?([^"']*)"""


def host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))


def address(url: Column) -> Column:
    """Host, path and query: the node of a URL, whatever its scheme and fragment; null where there is no host."""
    place = F.when(path(url) == "", "/").otherwise(path(url))
    node = F.concat(host(url), place, F.coalesce(F.regexp_extract(url, PARTS, 4), F.lit("")))
    return F.when(host(url) != "", node)


def _resolved(target: Column, url: Column) -> Column:
    """`target` as an absolute URL, read on the page at `url`; null where it names no other page."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, PARTS, 1)
    site = F.concat(scheme, F.lit("://"), host(url))
    folder = F.concat(F.regexp_extract(path(url), r"(?s)^(.*/)", 1))
    return (
        F.when((target == "") | target.startswith("#"), None)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, path(url), target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses of a page and of each page that its canonical links and redirects name.

    Links are `<link>` tags whose `rel` holds the word canonical, and `<meta http-equiv="refresh">` tags of any delay. All of
    a page count, so an unusable one hides no other. Tags in comments, scripts, styles, text areas and titles are no tags.
    Attributes are read by their whole name, quoted or not, the first of a name. A `>` ends a tag even inside quotes.
    """
    shown = F.regexp_replace(html, HIDDEN, " ")
    tags = pages.where(F.col(html).rlike("(?i)canonical|refresh")).select(
        F.col(url).alias("u"), F.explode(F.regexp_extract_all(shown, F.lit(TAG), F.lit(1))).alias("tag")
    )
    told = tags.select(
        "u", F.lower(F.substring("tag", 1, 4)).alias("kind"),
        F.transform(F.regexp_extract_all("tag", F.lit(ATTRIBUTE), F.lit(1)), F.lower).alias("names"),
        F.regexp_extract_all("tag", F.lit(ATTRIBUTE), F.lit(2)).alias("values"),
    )

    def value(name: str) -> Column:
        said = F.get("values", (F.array_position("names", F.lit(name)) - 1).cast("int"))
        return F.regexp_replace(said, r"""^["']?\s*|\s*["']?$""", "")

    canonical = (F.col("kind") == "link") & F.array_contains(F.split(F.lower(value("rel")), r"\s+"), "canonical")
    refresh = (F.col("kind") == "meta") & (F.lower(value("http-equiv")) == "refresh")
    target = F.when(canonical, value("href")).when(refresh, F.trim(F.regexp_extract(value("content"), TARGET, 1)))
    found = told.select("u", target.alias("t")).where("t <> ''")
    links = found.select(address(F.col("u")).alias("a"), address(_resolved(F.col("t"), F.col("u"))).alias("b"))
    return links.where("a is not null and b is not null")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) of each rule."""
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), rule))) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def fit_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct `places` (host, path) that a rule fits.

    A rule fits its host and all hosts below it where the path starts with the rule's. The
    longest rule wins, an allow before a block of the same length. A place meets the rules by
    equality of host suffix and path prefix, so hosts with many rules cost no more than others.
    """
    rules = rules.select(
        F.col("host").alias("on"), F.col("path").alias("start"), F.col("verdict"),
        F.concat("host", "path").alias("rule"),
    )
    lengths = rules.select("on", F.length("start").alias("n")).distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    return (
        places.select("host", "path").distinct()
        .withColumn("on", F.explode(suffixes))
        .join(lengths, "on")
        .where("length(path) >= n")
        .withColumn("start", F.expr("substring(path, 1, n)"))
        .join(rules, ["on", "start"])
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("verdict") == "allow", "rule")).alias("w"))
        .select("host", "path", "w.rule", "w.verdict")
    )


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of `pages`, repeated rows included.

    A null URL, or one without `://`, has an empty host and path, no rule and no alias. Null or
    empty HTML names no alias. Texts of any length are read whole. `rules` has host, path and verdict (allow or block).
    """
    link = F.col(url)
    own = pages.select(
        F.col(page_id).alias("page_id"), host(link).alias("host"), path(link).alias("path"), address(link).alias("node")
    )
    fitted = fit_rules(own, rules)
    ruled = own.join(fitted, ["host", "path"], "left")

    groups = connected(alias_links(pages, url, html), "a", "b")
    at = groups.select("node", "component", F.concat(F.lit("x://"), "node").alias("u"))
    at = at.select("node", "component", host(F.col("u")).alias("host"), path(F.col("u")).alias("path"))
    barred = fit_rules(at, rules).where("verdict = 'block'")
    barred = at.join(barred.select("host", "path"), ["host", "path"], "left_semi").select("component").distinct()
    aliases = at.join(barred, "component", "left_semi").select("node", F.lit("block").alias("passed"))
    verdict = F.coalesce("verdict", "passed", F.lit("allow"))
    return ruled.join(aliases, "node", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
