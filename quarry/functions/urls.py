"""URL scalars: native for absolute URLs, one Arrow UDF where links are relative."""

from __future__ import annotations

import ipaddress
import socket
from collections.abc import Callable
from urllib.parse import parse_qsl, urlencode, urljoin, urlparse, urlsplit, urlunparse, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import slug, text_of

# Paths and statuses that classification depends on.
LISTING_PATH, FILES_PATH, DOCUMENTATION_END = "/cms-data", "/cms-data/files/", "/data-documentation"
ASSET_KINDS = ("pdf", "xlsx", "xls", "csv", "zip")
CONTENT_TYPES = {
    "application/pdf": "pdf",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
    "application/vnd.ms-excel": "xlsx",
    "text/csv": "csv",
    "application/zip": "zip",
}
TRANSIENT = (429, 500, 502, 503, 504)
HTML_KINDS = ("listing_page", "dataset_page", "documentation_page")
NOT_HTTP = "archive URL must be an absolute http(s) URL"
PRIVATE = "archive URL host resolves to a private or local address"

_PARTS = r"(?s)\A([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?\z"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _PARTS, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _PARTS, 2)


def path(url: Column) -> Column:
    """The path of an absolute or relative URL, without parameters of its last part."""
    whole = F.when(url.rlike(_PARTS), F.regexp_extract(url, _PARTS, 3)).otherwise(F.regexp_extract(url, r"(?s)\A([^?#]*)", 1))
    return F.regexp_replace(whole, r";[^/]*\z", "")


def without_www(host: Column) -> Column:
    return F.regexp_replace(host, r"\Awww\.", "")


def normalized(url: Column) -> Column:
    """An absolute URL in its one spelling: scheme and host lowered, no ``www.``, no slash at the end, no fragment."""
    p = F.regexp_extract(url, _PARTS, 3)
    p = F.when(p == "/", p).otherwise(F.regexp_replace(p, r"/+\z", ""))
    query = F.regexp_extract(url, _PARTS, 4)
    query = F.when(query == "?", F.lit("")).otherwise(query)
    return F.when(url.rlike(_PARTS), F.concat(scheme(url), F.lit("://"), without_www(F.lower(netloc(url))), p, query)).otherwise(url)


def resolve(base: str | None, href: str | None) -> str | None:
    """``href`` as a link on page ``base``, in its one spelling; None: no URL at all."""
    try:
        parts = urlparse(urljoin(base or "", href or ""))
    except ValueError:
        return None
    end = parts.path if parts.path == "/" else parts.path.rstrip("/")
    return urlunparse((parts.scheme.lower(), parts.netloc.lower().removeprefix("www."), end, parts.params, parts.query, ""))


@F.pandas_udf(T.StringType())
def _resolved(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([resolve(b, h) for b, h in zip(base, href)])


#: ``resolve`` on columns.  Declared not deterministic only so that it is evaluated
#: once where its result is used several times.
resolved = _resolved.asNondeterministic()


def resource_kind(url: Column) -> Column:
    p = F.lower(path(url))
    return (
        F.when(p == LISTING_PATH, "listing_page")
        .when(p.endswith(DOCUMENTATION_END), "documentation_page")
        .when(p.contains(FILES_PATH), "dataset_page")
        .when(p.rlike(rf"\.({'|'.join(ASSET_KINDS)})\z"), "asset")
        .otherwise("other")
    )


def asset_kind(url: Column, content_type: Column) -> Column:
    p, out = F.lower(path(url)), None
    for kind in ASSET_KINDS:
        typed = [t for t, k in CONTENT_TYPES.items() if k == kind]
        hit = p.endswith(f".{kind}") | (text_of(content_type).isin(typed) if typed else F.lit(False))
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("other")


def link_state(status: Column) -> Column:
    """An unreachable page (no status, or 0) is unknown: it is no live link."""
    return F.when(status.isNull() | (status == 0) | status.isin(*TRANSIENT), "unknown").when(status < 400, "live").otherwise("dead")


def listing_url(base: str, page: int) -> str:
    parts = urlsplit(base)
    return urlunsplit((parts.scheme, parts.netloc, parts.path, urlencode(dict(parse_qsl(parts.query, keep_blank_values=True)) | {"page": str(page)}), ""))


def is_relevant(base: Column, absolute: Column) -> Column:
    """Whether a normalised link leads to a dataset page of the same site, or to an asset of any."""
    p = F.lower(path(absolute))
    same_site = without_www(F.lower(netloc(absolute))) == without_www(F.lower(netloc(base)))
    on_web = scheme(absolute).isin("http", "https") & (netloc(absolute) != "")
    return on_web & F.when(p.startswith(FILES_PATH), same_site).otherwise(p.rlike(rf"\.({'|'.join(ASSET_KINDS)})\z"))


def _segments(url: Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda x: x != "")


def _stem(name: Column) -> Column:
    """A file name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(name, r"(?<=[^/])\.[^.]+\z", "")


def _suffix(name: Column) -> Column:
    return F.regexp_extract(name, r"(?<=[^/])\.([^.]+)\z", 1)


def dataset_id_of_file_url(url: Column) -> Column:
    parts = _segments(url)
    return F.when((F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == "cms-data") & (F.get(parts, F.lit(1)) == "files"), slug(F.get(parts, F.lit(2))))


def dataset_id(url: Column) -> Column:
    return F.coalesce(dataset_id_of_file_url(url), slug(_stem(F.coalesce(F.element_at(_segments_or_none(url), -1), F.lit("")))))


def _segments_or_none(url: Column) -> Column:
    parts = _segments(url)
    return F.when(F.size(parts) > 0, parts)


def document_suffix(url: Column) -> Column:
    name = F.coalesce(F.element_at(_segments_or_none(url), -1), F.lit(""))
    ext = F.lower(_suffix(name))
    return (
        F.when(name == "data-documentation", name)
        .when(name == "", "document")
        .when(ext != "", F.concat_ws("_", slug(_stem(name)), slug(ext)))
        .otherwise(slug(_stem(name)))
    )


def url_hash(url: Column) -> Column:
    return F.substr(F.sha1(url), F.lit(1), F.lit(10))


def document_id(dataset: Column, url: Column) -> Column:
    return F.concat_ws("__", dataset, document_suffix(url), url_hash(url))


def document_kind(resource: Column, asset: Column) -> Column:
    return F.when(resource == "documentation_page", "html").when(text_of(asset) == "", "other").otherwise(asset)


def variable_id(dataset: Column, name: Column) -> Column:
    return F.concat_ws("__var__", slug(dataset), slug(name))


def archive_path(url: Column, resource: Column, asset: Column, content_type: Column, root: str) -> Column:
    name = F.sha1(url)
    html = F.concat(F.lit(f"{root}/html/"), resource, F.lit("/"), name, F.lit(".html"))
    kind = F.when(text_of(asset) == "", asset_kind(url, content_type)).otherwise(asset)
    ext = F.lower(_suffix(F.coalesce(F.element_at(_segments_or_none(url), -1), F.lit(""))))
    named = asset_kind(url, content_type)
    ext = F.when(ext != "", ext).when(named != "other", named).otherwise("bin")
    return F.when(resource.isin(*HTML_KINDS), html).otherwise(F.concat(F.lit(f"{root}/assets/"), kind, F.lit("/"), name, F.lit("."), ext))


def is_valid_url(url: Column) -> Column:
    """Has a scheme and a host."""
    return text_of(url).rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+")


def _addresses(host: str, resolve: Callable = socket.getaddrinfo) -> list:
    try:
        return [ipaddress.ip_address(host)]
    except ValueError:
        try:
            return [ipaddress.ip_address(x[4][0].split("%")[0]) for x in resolve(host, None, type=socket.SOCK_STREAM)]
        except OSError:
            return []  # a name that does not resolve is left to the download


def archive_url_error(url: str) -> str:
    """Why a URL must not be fetched; the empty text if it may."""
    try:
        parts = urlsplit(url or "")
        host = parts.hostname
    except ValueError:
        return NOT_HTTP
    if parts.scheme not in ("http", "https") or not host:
        return NOT_HTTP
    bad = ("is_private", "is_loopback", "is_link_local", "is_multicast", "is_reserved", "is_unspecified")
    return PRIVATE if host.lower() == "localhost" or any(getattr(a, b) for a in _addresses(host) for b in bad) else ""


@F.pandas_udf(T.StringType())
def url_error(url: pd.Series) -> pd.Series:
    return url.map(archive_url_error)
