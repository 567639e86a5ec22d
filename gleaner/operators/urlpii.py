"""Drop documents by domain, redact personal data in the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gleaner.functions import pii
from gleaner.functions.names import all_columns, column, fresh
from gleaner.functions.urls import domain_suffixes, url_host
from gleaner.operators.skew import HOT_ROWS, lookup


def domain_table(lines: DataFrame, column: str = "value") -> DataFrame:
    """Distinct, trimmed, non-blank entries of a list with one domain per line."""
    return lines.select(F.trim(F.col(column)).alias("domain")).filter(F.col("domain") != "").distinct()


def load_domain_list(spark: SparkSession, path: str) -> DataFrame:
    """Read a domain list; a missing file is an error."""
    return domain_table(spark.read.text(path))


def host_or_empty(url: Column) -> Column:
    return F.coalesce(url_host(url), F.lit(""))


def listed_hosts(docs: DataFrame, domains: DataFrame, url: str = "url", hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(host, listed_domain, rows)``: hosts in the data that, or a parent of which, are listed.

    Only distinct hosts are expanded into their parent domains; the most specific
    entry that matched is kept. Unlisted hosts above ``hot_rows`` are there too,
    with a NULL domain, so that a join by host knows to spread them.
    """
    hosts = docs.groupBy(host_or_empty(F.col(url)).alias("host")).agg(F.count(F.lit(1)).alias("rows"))
    parents = hosts.select("host", F.explode(domain_suffixes(F.col("host"))).alias("domain"))
    # A last label like "com" is the parent of most hosts: a listed one is known with its size.
    sized = domains.select("domain").join(parents.groupBy("domain").agg(F.count(F.lit(1)).alias("hosts")), "domain")
    listed = (
        lookup(parents, sized, "domain", spread_by="host", size_col="hosts", hot_rows=hot_rows)
        .groupBy("host")
        .agg(F.max_by("domain", F.length("domain")).alias("listed_domain"))
    )
    return hosts.join(listed, "host", "left").filter(F.col("listed_domain").isNotNull() | (F.col("rows") > hot_rows))


def flag_listed(docs: DataFrame, domains: DataFrame, url: str, key: str, out: str = "listed_domain") -> DataFrame:
    """Add ``out``: the list entry that matched, or NULL. Documents are not shuffled
    while the listed hosts are few enough to broadcast."""
    host, rows = fresh(docs, "_host"), fresh(docs, "_rows")
    keyed = docs.withColumn(host, host_or_empty(column(url)))
    hosts = listed_hosts(docs, domains, url).select(F.col("host").alias(host), F.col("listed_domain").alias(out), F.col("rows").alias(rows))
    return lookup(keyed, hosts, host, spread_by=key, size_col=rows, how="left").drop(host)


def robots_filter(docs: DataFrame, domains: DataFrame, url: str = "url", key: str = "warc_id") -> DataFrame:
    """Documents whose host and parent domains are all unlisted; a NULL URL is kept."""
    listed = fresh(docs, "listed_domain")
    flagged = flag_listed(docs, domains, url, key, listed)
    return flagged.filter(F.col(listed).isNull()).select(*all_columns(docs))


def robots_removed(docs: DataFrame, domains: DataFrame, url: str = "url", key: str = "warc_id") -> DataFrame:
    """The excluded documents with their raw text, and the entry that matched as ``listed_domain``
    (with underscores in front, where the documents have such a column)."""
    listed = fresh(docs, "listed_domain")
    flagged = flag_listed(docs, domains, url, key, listed)
    return flagged.filter(F.col(listed).isNotNull()).select(*all_columns(docs), listed)


def extra_blocklists(
    docs: DataFrame,
    domains: DataFrame | None = None,
    urls: DataFrame | None = None,
    words: list[str] | None = None,
    url: str = "url",
    key: str = "warc_id",
) -> DataFrame:
    """Further optional lists: domains, whole URLs, and words that may not occur in a URL."""
    out = docs
    if words:
        pattern = "(^|[^a-z0-9])(" + "|".join(rf"\Q{w}\E" for w in sorted(words)) + ")($|[^a-z0-9])"
        out = out.filter(F.coalesce(~F.lower(F.col(url)).rlike(pattern), F.lit(True)))
    if urls is not None:
        at, flag, rows = fresh(docs, "_url"), fresh(docs, "_listed"), fresh(docs, "_rows")
        listed = urls.select(F.trim("url").alias(at)).filter(F.col(at) != "").distinct().withColumn(flag, F.lit(True))
        keyed = out.withColumn(at, F.coalesce(column(url), F.lit("")))
        sizes = keyed.groupBy(at).agg(F.count(F.lit(1)).alias(rows))
        hits = sizes.join(listed, at, "left").filter(F.col(flag) | (F.col(rows) > HOT_ROWS))
        out = lookup(keyed, hits, at, spread_by=key, size_col=rows, how="left")
        out = out.filter(F.col(flag).isNull()).select(*all_columns(docs))
    if domains is not None:
        out = robots_filter(out, domains, url, key)
    return out


def redact_pii(
    df: DataFrame, text: str = "text", emails: bool = True, ibans: bool = True, ips: bool = True
) -> DataFrame:
    """Redact in the order e-mail, IBAN, IP and add ``pii_count``; all else stays in place.

    Row-wise only, so it also runs on a streaming DataFrame.
    """
    steps = [
        (emails, pii.count_emails, pii.redact_emails),
        (ibans, pii.count_ibans, pii.redact_ibans),
        (ips, pii.count_ips, pii.redact_ips),
    ]
    out = df.withColumn("pii_count", F.lit(0).cast("bigint"))
    for wanted, count, redact in steps:
        if wanted:
            out = out.withColumns({"pii_count": F.col("pii_count") + count(F.col(text)), text: redact(F.col(text))})
    return out


def url_pii_stage(
    docs: DataFrame, domains: DataFrame, url: str = "url", text: str = "text", key: str = "warc_id"
) -> tuple[DataFrame, DataFrame]:
    """Kept documents (redacted, with ``pii_count``) and removed ones (raw, input schema)."""
    listed = fresh(docs, "listed_domain")
    flagged = flag_listed(docs, domains, url, key, listed)
    kept = redact_pii(flagged.filter(F.col(listed).isNull()).select(*all_columns(docs)), text)
    removed = flagged.filter(F.col(listed).isNotNull()).select(*all_columns(docs))
    return kept, removed
