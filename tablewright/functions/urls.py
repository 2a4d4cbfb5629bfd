"""URL and link columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The rewrites that turn a path into its family, in this order.
FAMILY_RULES = (
    (r"/([a-z])/[a-z]+\d+[a-z]?\.html$", "/$1/{id}.html"),
    (r"/(coaches|players|teams)/[a-z]+\d+[a-z]?\.html$", "/$1/{id}.html"),
    (r"\d{4,}", "{year}"),
    (r"/\d+", "/{n}"),
    (r"/(?=[a-z0-9]*-)[a-z0-9-]{6,}/", "/{slug}/"),
    (r"/[a-z0-9]{14,}/", "/{slug}/"),
    (r"\b(p|t|l|in|pro)-[A-Za-z0-9-]{3,}", "$1-{id}"),
)
SKIPPED_SCHEMES = ("mailto:", "javascript:", "#", "tel:")


def url_path(url: Column) -> Column:
    """The path as it stands, also of URLs that a strict parser refuses."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def url_pattern(path: Column) -> Column:
    """The family of a path: entity names collapse, section words stay."""
    p = F.regexp_replace(path, r"[#?].*", "")
    for rule, to in FAMILY_RULES:
        p = F.regexp_replace(p, rule, to)
    return F.when(p == "", "/").otherwise(p)


def url_allowed(url: Column, domains: list[str] | Column, prefixes: list[str] | Column) -> Column:
    """http(s), an exact host with its port, and a path that begins with one of the prefixes."""
    d = F.array(*map(F.lit, domains)) if isinstance(domains, list) else domains
    p = F.array(*map(F.lit, prefixes)) if isinstance(prefixes, list) else prefixes
    path = url_path(url)
    ok = url_scheme(url).isin("http", "https") & F.array_contains(d, url_host(url)) & F.exists(p, lambda x: F.startswith(path, x))
    return F.coalesce(ok, F.lit(False))


def page_links(html: Column) -> Column:
    """Quoted hrefs of anchors, in order."""
    return F.regexp_extract_all(html, F.lit(r"(?i)<a[^>]+href=[\"']([^\"']+)[\"']"), F.lit(1))


def followable(href: Column) -> Column:
    return ~F.exists(F.array(*map(F.lit, SKIPPED_SCHEMES)), lambda p: F.startswith(href, p))


def is_sitemap(body: Column) -> Column:
    return body.rlike(r"\A\s*<\?xml") | body.contains("<urlset") | body.contains("<sitemapindex")


def sitemap_links(body: Column) -> Column:
    return F.array_sort(F.array_distinct(F.regexp_extract_all(body, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))))


def _join_all(base: pd.Series, href: pd.Series) -> pd.Series:
    from urllib.parse import urljoin

    def join(b, h):
        if b is None or h is None:
            return None
        try:
            return urljoin(b, h)
        except ValueError:
            return None

    return pd.Series([join(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def resolve(base: Column, href: Column, exact: bool = True) -> Column:
    """href against base. Absolute and plain rooted hrefs stay in the JVM; the rest goes to the standard
    library's join, unless exact is false, when it becomes null."""
    rooted = F.startswith(href, F.lit("/")) & ~F.startswith(href, F.lit("//")) & ~href.rlike(r"(^|/)\.{1,2}(/|$|[?#])|;|[?#]$")
    absolute = href.rlike(r"^[a-z]+://[^/?#\s]+/[^\s.;#?]*$")
    other = F.pandas_udf(_join_all, StringType())(base, href) if exact else F.lit(None).cast("string")
    return F.when(absolute, href).when(rooted, F.concat(url_scheme(base), F.lit("://"), url_host(base), href)).otherwise(other)


def seed_url(template: Column, year: Column, team: Column | None = None) -> Column:
    out = F.replace(template, F.lit("{year}"), year.cast("string"))
    return out if team is None else F.replace(out, F.lit("{team}"), team)


def dataset_name(family: Column) -> Column:
    """A dataset's name from the segments of its family that are no placeholders."""
    parts = F.filter(F.split(F.btrim(family, F.lit("/")), "/"), lambda p: (p != "") & ~p.contains("{"))
    slugs = F.transform(parts, lambda p: F.btrim(F.regexp_replace(F.replace(F.lower(p), F.lit(".html"), F.lit("")), "[^a-z0-9]+", "_"), F.lit("_")))
    name = F.array_join(F.filter(slugs, lambda s: s != ""), "_")
    return F.when(name == "", "family").otherwise(name)


def robots_url(url: Column) -> Column:
    return F.concat(url_scheme(url), F.lit("://"), url_host(url), F.lit("/robots.txt"))
