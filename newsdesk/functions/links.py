"""Links: picking, building and resolving them with built-in expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The generic URI grammar of RFC 3986, appendix B, as one pattern.
URI = r"^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def regex_after(c: Column, literal: str) -> Column:
    """The word right behind a literal, NULL where there is none."""
    return F.nullif(F.regexp_extract(c, re.escape(literal) + r"((?U)\w+)", 1), F.lit(""))


def post_url(site: str, user: Column, post_id: Column) -> Column:
    return F.concat(F.lit(f"{site}/"), user, F.lit("/status/"), post_id.cast("string"))


def first_external_url(urls: Column, own: Column, missing: str = "None") -> Column:
    """First link of an entity list that does not point to the user's own pages.

    `urls` is array<struct<url, expanded_url>>; gives struct<ref_url, ref_text>.
    """
    hit = F.get(F.filter(urls, lambda u: ~F.contains(u["expanded_url"], own)), F.lit(0))
    return F.struct(
        F.coalesce(hit["url"], F.lit(missing)).alias("ref_url"),
        F.when(hit.isNotNull(), F.lit("[ LINK ]")).otherwise(F.lit(missing)).alias("ref_text"),
    )


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found on the page `base`."""
    scheme, host, path, query = (F.regexp_extract(base, URI, i) for i in (1, 2, 3, 4))
    root = F.concat(scheme, host)
    ref_path = F.regexp_extract(link, URI, 3)
    ref_tail = F.concat(F.regexp_extract(link, URI, 4), F.regexp_extract(link, URI, 5))
    rooted = link.startswith("/")
    # A relative path hangs below the folder of the base; doubled slashes collapse.
    folder = F.regexp_replace(path, "[^/]*$", "")
    joined = F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), ref_path), "/{2,}", "/")
    target = F.when(rooted, ref_path).otherwise(joined)
    return (
        F.when(link == "", base)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("#"), F.concat(root, path, query, link))
        .when(link.startswith("?"), F.concat(root, path, link))
        .when(target.rlike(r"(^|/)\.{1,2}(/|$)"), F.concat(root, _without_dots(target), ref_tail))
        .otherwise(F.concat(root, target, ref_tail))
    )


def _without_dots(path: Column) -> Column:
    """Remove `.` and `..` segments from an absolute path."""
    def step(done: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    closing = F.when(path.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), closing)


def link_host_contains(url: Column, part: str) -> Column:
    """True where the url is handled by the reader for `part`."""
    return F.coalesce(url.contains(part), F.lit(False))
