"""Scalar URL functions as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Suffixes of two labels under which names are registered.
DOUBLE_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "com.br", "org.br", "gov.br", "co.jp", "or.jp", "ne.jp", "com.au", "com.mx", "com.ar", "com.co",
    "co.kr", "co.in", "co.za", "com.sg", "co.nz", "com.tr",
)
#: Beginnings of query parts that only track.
TRACKING = ("utm_", "ref=", "gclid", "fbclid")
#: scheme, authority, path, query of a URL with a scheme.
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def with_scheme(url: Column, scheme: str = "https") -> Column:
    """The trimmed URL, completed when it has no scheme; empty stays empty."""
    u = F.trim(url)
    return F.when((u == "") | u.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), u).otherwise(F.concat(F.lit(f"{scheme}://"), F.regexp_replace(u, "^//", "")))


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(with_scheme(url), _PARTS, n)


def canonical(url: Column) -> Column:
    """One form for one address: scheme and host in lower case, no fragment, no parameters, no tracking keys, no slash at the end."""
    path = F.regexp_replace(_part(url, 3), ";[^/]*$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    path = F.when((path != "/") & path.endswith("/"), F.regexp_replace(path, "/$", "")).otherwise(path)
    keep = F.filter(F.split(_part(url, 4), "&"), lambda q: (q != "") & ~F.lower(q).rlike("^(" + "|".join(TRACKING) + ")"))
    query = F.array_join(keep, "&")
    return F.concat(F.lower(_part(url, 1)), F.lit("://"), F.lower(_part(url, 2)), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def host(url: Column) -> Column:
    """Host in lower case without user, port and a leading www."""
    net = F.regexp_replace(F.lower(_part(url, 2)), "^.*@", "")
    return F.regexp_replace(F.regexp_replace(net, ":.*$", ""), r"^www\.", "")


def path(url: Column) -> Column:
    return _part(url, 3)


def registrable(url: Column) -> Column:
    """The domain that somebody registered: two labels, or three under a suffix of two."""
    labels = F.split(host(url), r"\.")
    n = F.when(F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".").isin(*DOUBLE_SUFFIXES), 3).otherwise(2)
    start = F.greatest(F.size(labels) - n + 1, F.lit(1))
    return F.array_join(F.slice(labels, start, n), ".")


def file_slug(url: Column, most: int = 70) -> Column:
    """A readable file name for a URL, made unique by ten hex digits of its hash."""
    readable = F.regexp_replace(F.lower(F.regexp_replace(url, "^[a-z]+://", "")), "[^a-z0-9]+", "-")
    return F.concat(F.left(readable, F.lit(most)), F.lit("-"), F.left(F.sha2(url, 256), F.lit(10)))


def id_and_place(url: Column) -> Column:
    """struct<id,lat,lng> of a map or profile URL; empty id and null coordinates when there are none."""
    ident = F.coalesce(
        F.nullif(F.regexp_extract(url, r"[?&](?:id|cid|place_id)=([^&#]+)", 1), F.lit("")), F.nullif(F.regexp_extract(url, r"!1s([^!?&]+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(url, r"/([^/?#]+)/?(?:[?#].*)?$", 1), F.lit("")), F.lit(""),
    )
    number = lambda n: F.nullif(F.regexp_extract(url, r"@(-?\d+\.\d+),(-?\d+\.\d+)", n), F.lit("")).cast("double")
    return F.struct(ident.alias("id"), number(1).alias("lat"), number(2).alias("lng"))


def unwrapped(url: Column, keys: Iterable[str] = ("url", "u", "q")) -> Column:
    """The target of a redirect link that carries it as a query value; other URLs as they are."""
    inner = F.regexp_extract(url, "[?&](?:" + "|".join(keys) + ")=(https?(?::|%3A|%3a)[^&#]+)", 1)
    return F.when(inner != "", F.url_decode(inner)).otherwise(url)


def path_words(url: Column) -> Column:
    return F.trim(F.regexp_replace(path(url), "[-_/]+", " "))


def on_list(url: Column, patterns: Iterable[str]) -> Column:
    """Whether a URL is on a domain, below it, or below a domain and path of a short list.

    All patterns are one expression over host and path, which are taken from the URL once.
    """
    patterns = list(patterns)
    if not patterns:
        return F.lit(False)
    paths = any("/" in p for p in patterns)
    quoted = "|".join(re.escape(p if "/" in p or not paths else p + "/") for p in patterns)
    if not paths:
        return host(url).rlike(rf"^(?s:.*\.)?(?:{quoted})\z")
    return F.concat(host(url), F.lit("/"), F.regexp_replace(path(url), "^/+", "")).rlike(rf"^(?:[^/]*\.)?(?:{quoted})")