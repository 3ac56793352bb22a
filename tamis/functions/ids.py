"""Spellings of record ids, addresses and author names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as outer blanks of an id.
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip_blank(c: Column) -> Column:
    """Outer Unicode white space removed; null stays null."""
    return F.regexp_replace(c, rf"\A{BLANK}+|{BLANK}+\z", "")


def _path(c: Column) -> Column:
    """Lower case, without blanks, scheme, host, query, outer slashes and ``.git``."""
    c = F.lower(strip_blank(c))
    c = F.regexp_replace(c, r"^(?:git\+)?[a-z][a-z0-9+.-]*://[^/]*/*", "")
    c = F.regexp_replace(c, r"^git@[^:/]+:", "")
    # Without a scheme a first part with dots is a host only if an id follows it.
    c = F.regexp_replace(c, r"^(?:[a-z0-9-]+\.)+[a-z]{2,}(?::\d+)?/+(?=[^/]+/[^/]|(?:abs/|pdf/)?(?:arxiv:)?\d{4}\.\d{4,5})", "")
    c = F.regexp_replace(c, r"[/\s]+$", "")
    c = F.regexp_replace(c, r"\.git$", "")
    return F.regexp_replace(c, r"^/+|/+$", "")


def norm_id(c: Column) -> Column:
    """An id in lower case, without outer blanks, address, ``.git``, final ``/``
    and, for paper ids, version. Null and blank ids give null."""
    p = _path(c)
    p = F.regexp_replace(p, r"^(?:arxiv:|(?:abs|pdf)/)(?=[\w.-]+(?:/\d+)?(?:v\d+)?(?:\.pdf)?$)", "")
    p = F.regexp_replace(p, r"^(\d{4}\.\d{4,5}|[a-z-]+(?:\.[a-z]{2})?/\d{7})(?:v\d+)?(?:\.pdf)?$", "$1")
    return F.when(p != "", p)


def owner_of(norm: Column) -> Column:
    """The part before ``/`` of a normalised id; null without one. Old-style paper ids have none."""
    o = F.regexp_extract(norm, r"^([^/]+)/", 1)
    return F.when((o != "") & ~norm.rlike(r"^[a-z-]+(?:\.[a-z]{2})?/\d{7}$"), o)


def norm_url(c: Column) -> Column:
    """A repository address as ``owner/name``; null and blank give null."""
    p = _path(c)
    return F.when(p != "", p)
