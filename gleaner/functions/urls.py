"""Host names and their parent domains."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gleaner.functions.text import let

# Fixed value: scheme, optional user part, then the host (group 1).
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)"


def url_host(url: Column) -> Column:
    """Lower-case host without user part, port and final dot; NULL when there is none."""
    host = F.regexp_replace(F.regexp_extract(F.lower(url), HOST, 1), r"\.+$", "")
    return F.nullif(host, F.lit(""))


def domain_suffixes(host: Column) -> Column:
    """``a.b.c`` gives ``[a.b.c, b.c, c]``."""

    def suffixes(labels: Column) -> Column:
        size = F.size(labels)
        return F.transform(F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(labels, i, size), "."))

    return let(F.split(host, r"\."), suffixes)
