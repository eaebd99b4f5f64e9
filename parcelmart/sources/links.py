"""Download links in payloads and pages, and the classification of responses."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.functions.text import strip

# What marks a download link, and what marks an export response.
LINK_TOKENS = ["download", "export", ".xlsx", ".xls", ".csv"]
RESOURCE_TYPES = ["fetch", "xhr", "document", "other"]
TASK_URL_TOKENS = ["/task", "task_status", "task-id", "task_id"]
EXPORT_TYPE_TOKENS = ["spreadsheet", "excel", "csv"]
EXPORT_URL_TOKENS = ["/download", "/export", ".xlsx", ".xls", ".csv"]

_JSON_STRING = r'"((?:[^"\\]|\\.)*+)"(\s*+:)?'


def json_strings(payload: Column) -> Column:
    """All string values of a JSON text at any depth, in document order. Keys are the
    literals before a colon; the values are unescaped by the JSON reader."""
    literals = F.regexp_extract_all(payload, F.lit(_JSON_STRING), F.lit(0))
    values = F.filter(literals, lambda s: ~F.endswith(s, F.lit(":")))
    as_list = F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))
    return F.from_json(as_list, "array<string>")


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))


def absolute_url(text: Column, host: str) -> Column:
    """http(s) URLs as they are, rooted paths under ``host``, null for the rest."""
    low = F.lower(text)
    return F.when(
        F.startswith(low, F.lit("http://")) | F.startswith(low, F.lit("https://")), text
    ).when(F.startswith(text, F.lit("/")), F.concat(F.lit(host), text))


def contains_token(text: Column, tokens: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(t)) for t in tokens])


def extract_links(
    df: DataFrame, strings: Column, host: str, tokens: list[str] | None = None
) -> DataFrame:
    """One row per link of each input row: (…, link_order, link). Links keep the order
    of their first occurrence; a row's list is made unique in place, without a shuffle."""
    tokens = LINK_TOKENS if tokens is None else tokens
    urls = F.transform(strings, lambda s: absolute_url(strip(s), host))
    wanted = F.filter(urls, lambda u: u.isNotNull() & contains_token(F.lower(u), tokens))
    return df.select("*", F.posexplode(F.array_distinct(wanted)).alias("link_order", "link"))


def export_extension(content_type: Column, url: Column) -> Column:
    """File extension of an export response; spreadsheets are the default."""
    kind, low = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(F.coalesce(url, F.lit("")))
    return (
        F.when(F.contains(kind, F.lit("csv")) | F.endswith(low, F.lit(".csv")), ".csv")
        .when(
            contains_token(kind, ["spreadsheetml", "excel"]) | F.endswith(low, F.lit(".xlsx")),
            ".xlsx",
        )
        .when(F.endswith(low, F.lit(".xls")), ".xls")
        .otherwise(".xlsx")
    )


def is_export(
    resource_type: Column, content_type: Column, disposition: Column, url: Column
) -> Column:
    """1 where a logged response carries an export file."""
    low = [F.lower(F.coalesce(c, F.lit(""))) for c in (resource_type, content_type, disposition, url)]
    resource, kind, disposed, address = low
    return (
        F.when((resource != "") & ~resource.isin(RESOURCE_TYPES), 0)
        .when(F.contains(kind, F.lit("json")) | contains_token(address, TASK_URL_TOKENS), 0)
        .when(F.contains(disposed, F.lit("attachment")), 1)
        .when(contains_token(kind, EXPORT_TYPE_TOKENS), 1)
        .when(contains_token(address, EXPORT_URL_TOKENS), 1)
        .otherwise(0)
    )
