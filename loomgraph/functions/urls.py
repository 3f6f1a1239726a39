"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track visitors.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "fbclid", "gclid"]


def host(c: Column) -> Column:
    """Host in lower case, without port; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(c, r"^[a-zA-Z]+://([^/?#:]+)", 1)), F.lit(""))


def join_url(base: Column, url: Column) -> Column:
    """An address as a page at ``base`` writes it, made absolute; up to eight steps upward are resolved."""
    site = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]+)", 1)
    folder = F.concat(site, F.regexp_replace(F.regexp_extract(base, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1), "[^/]*$", ""))
    folder = F.when(F.endswith(folder, F.lit("/")), folder).otherwise(F.concat(folder, F.lit("/")))
    joined = (
        F.when(url.rlike("^[a-zA-Z][a-zA-Z+.-]*:"), url).when(F.startswith(url, F.lit("//")), F.concat(F.regexp_extract(base, "^([a-zA-Z]+:)", 1), url))
        .when(F.startswith(url, F.lit("/")), F.concat(site, url)).when(url.rlike("^[#?]"), F.concat(F.regexp_replace(base, "[#?].*$", ""), url)).otherwise(F.concat(folder, url))
    )
    joined = F.regexp_replace(joined, r"/(?:\./)+", "/")
    for _ in range(8):
        joined = F.regexp_replace(joined, r"(?<![:/])/(?!\.\./)[^/?#]+/\.\./", "/")
    return F.regexp_replace(joined, r"^([a-zA-Z]+://[^/]+)(?:/\.\.)+/", "$1/")


def canonical_url(c: Column, aliases: Column | None = None) -> Column:
    """https, host in lower case and by the alias map (alias -> host), single slashes, no slash
    at the end but for the root, tracking and empty parameters left out, the others sorted,
    no fragment. Null for what is no absolute URL."""
    bare = F.regexp_replace(F.trim(c), "#.*$", "")
    named = host(c) if aliases is None else F.coalesce(F.try_element_at(aliases, host(c)), host(c))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[a-zA-Z]+://[^/?]+([^?]*)", 1), "/{2,}", "/")
    path = F.when(F.length(path) <= 1, "/").otherwise(F.regexp_replace(path, "/+$", ""))
    params = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: p.rlike("=.") & ~F.substring_index(p, "=", 1).isin(*TRACKING))
    query = F.array_join(F.array_sort(params), "&")
    return F.concat(F.lit("https://"), named, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def _id_of(c: Column, site: str, rule: str) -> Column:
    return F.when(F.instr(c, site) > 0, F.nullif(F.regexp_extract(c, rule, 1), F.lit("")))


def mtmt_id(c: Column) -> Column:
    return _id_of(c, "mtmt.hu", r"(?:sel=(?:authors)?|/authors?/)(\d{4,})")


def orcid_id(c: Column) -> Column:
    return _id_of(c, "orcid.org", r"(\d{4}-\d{4}-\d{4}-\d{3}[\dX])")


def scholar_id(c: Column) -> Column:
    return _id_of(c, "scholar.google", r"[?&]user=([\w-]{6,})")


def registry_grant(c: Column, site: str, param: str) -> Column:
    """``grant:<number>`` of a link to a grant registry's record."""
    number = F.regexp_extract(c, rf"[?&]{param}=(\d{{5,6}})(?:\D|$)", 1)
    return F.when((host(c) == site) & (number != ""), F.concat(F.lit("grant:"), number))


def well_formed(c: Column) -> Column:
    """http or https, with a dot in the host and no space."""
    return F.coalesce(c.rlike(r"^https?://[^/?#\s]+\.[^/?#\s]+([/?#]\S*)?$"), F.lit(False))


def slug_of(c: Column) -> Column:
    """The person part of a profile address."""
    return F.nullif(F.regexp_extract(c, "/kutato/([^/?#]+)", 1), F.lit(""))


def site_family(ref: Column) -> Column:
    """First part of the source key of a record reference."""
    return F.substring_index(F.substring_index(ref, "|", 1), "_", 1)


def ref_url(ref: Column) -> Column:
    """The address in a record reference, null if it holds none."""
    url = F.split_part(ref, F.lit("|"), F.lit(2))
    return F.when(url.rlike("^https?://"), url)
