"""URL normalization and completion, as expressions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules

#: The five parts of a URI by RFC 3986, appendix B.
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _decoded(c: Column) -> Column:
    return F.url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def normalize_url(raw: Column, keys: tuple[str, ...] = rules.TRACKING_KEYS, prefix: str = rules.TRACKING_PREFIX) -> Column:
    """Scheme and host in lower case, no fragment, no trailing slashes, no tracking parameters; blank values and order stay.

    A null counts as an empty URL, which becomes /. A URL whose host is none only loses its trailing slashes.
    """
    url = strip(F.coalesce(raw, F.lit("")))
    part = lambda i: F.regexp_extract(url, _PARTS, i)
    scheme, host, query = F.lower(part(1)), F.lower(part(2)), part(4)
    path = F.regexp_replace(part(3), "/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p != ""),
        lambda p: F.struct(
            _decoded(F.substring_index(p, "=", 1)).alias("k"),
            _decoded(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "(?s)^[^=]*=", "")).otherwise(F.lit(""))).alias("v"),
        ),
    )
    kept = F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*keys) & ~F.startswith(F.lower(p["k"]), F.lit(prefix)))
    text = F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    whole = F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")),
        F.when((host != "") & ~F.startswith(path, F.lit("/")), F.concat(F.lit("/"), path)).otherwise(path),
        F.when(text != "", F.concat(F.lit("?"), text)).otherwise(F.lit("")),
    )
    # A host with one square bracket, or with something else than an address in a pair of them, is none.
    broken = host.rlike(r"^[^\[\]]*[\[\]][^\[\]]*$|\][^\[]*\[") | (F.contains(host, F.lit("[")) & ~host.rlike(r"^([^@]*@)?\[([0-9a-f:.]+|v[0-9a-f]+\..+)\](:\d*)?$"))
    return F.when(broken, F.regexp_replace(url, "/+$", "")).otherwise(whole)


def is_http(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\Ahttps?://"), F.lit(False))


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def absolute(href: Column, page: Column) -> Column:
    """A link completed by its page: absolute ones stay, whatever their host; // takes the scheme, / the origin, others the folder."""
    folder = F.regexp_replace(F.regexp_replace(page, r"[?#].*$", ""), r"(?<=[^/:])/[^/]*$", "")
    return (
        F.when(href.rlike(r"(?i)^[a-z][a-z0-9+.\-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), href))
        .when(F.startswith(href, F.lit("/")), F.concat(origin(page), href))
        .otherwise(F.concat(folder, F.lit("/"), href))
    )


def links(html: Column, types: tuple[str, ...] | None = rules.ATTACHMENT_TYPES) -> Column:
    """All double-quoted href values, those with one of the extensions only; None takes all."""
    tail = "" if types is None else r"\.(?:" + "|".join(types) + ")"
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(f'(?i)href="([^"]*{tail})"'), 1)
