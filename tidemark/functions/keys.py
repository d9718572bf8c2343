"""Identifiers: id from a URL, landing key, posting uid."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import once


def url_param(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, decoded; null when absent."""
    pattern = rf"^[^?#]*\?(?:[^#]*?&)?{re.escape(name)}=([^&#]+)"
    return once(
        F.regexp_extract(url, pattern, 1),
        lambda raw: F.when(raw != "", F.coalesce(F.try_url_decode(raw), raw)),
    )


def text_id(text: Column, modulus: int | None = None) -> Column:
    """Stable id of a text. The default is the whole 128-bit digest, so that ids stay apart
    at any number of rows; `modulus` (10**10 for ten digits) gives a short number instead,
    which collides from about 100,000 rows on."""
    digest = F.md5(text)
    if modulus is None:
        return digest
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % modulus).cast("string")


def url_id(
    url: Column,
    title: Column,
    param: str,
    modulus: int | None = None,
) -> Column:
    """Id from the URL parameter, else from a hash of title and URL."""
    empty = F.lit("")
    fallback = F.concat(F.coalesce(title, empty), F.coalesce(url, empty))
    return F.coalesce(url_param(url, param), text_id(fallback, modulus))


def bronze_key(source: Column, job_id: Column) -> Column:
    """source/source-job_id"""
    return F.concat(source, F.lit("/"), source, F.lit("-"), job_id)


def posting_uid(source: Column, job_id: Column) -> Column:
    """source-job_id; a null part is skipped, so the uid is never null."""
    return F.concat_ws("-", source, job_id)
