"""Domain lists and redaction of personal data."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import query, table
from gleaner.functions.urls import domain_suffixes, url_host
from gleaner.operators import urlpii as ops
from gleaner.session import scratch_path, spread_small_input

# SQL building blocks. DuckDB has no lookaround, so the text is cut into runs and
# each run is matched as a whole.
_RE_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
_RE_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_RE_IPV4 = rf"(?:{_RE_OCTET}\.){{3}}{_RE_OCTET}"
_RE_IPV6 = r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
_RE_IBAN = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"
_RE_PRINTED = r"\b[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?\b"


def _runs(text: str, run: str, gap: str) -> str:
    return f"regexp_extract_all({text}, '{run}|{gap}')"


def _iban_ok(run: str) -> str:
    return (
        f"(regexp_full_match({run}, '{_RE_IBAN}') AND list_reduce(list_prepend(0, list_transform(string_split("
        f"substr({run}, 5) || substr({run}, 1, 4), ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 "
        f"ELSE ascii(c) - 55 END)), lambda a, v: CASE WHEN v < 10 THEN (a * 10 + v) % 97 ELSE (a * 100 + v) % 97 END) = 1)"
    )


_JOINED_SQL = "array_to_string(string_split(m, ' ')[1:n], '')"


def emails_sql(text: str) -> tuple[str, str]:
    return (
        f"regexp_replace({text}, '{_RE_EMAIL}', '[EMAIL]', 'g')",
        f"len(regexp_extract_all({text}, '{_RE_EMAIL}'))",
    )


def ibans_sql(text: str) -> tuple[str, str]:
    runs = _runs(text, "[A-Za-z0-9]+", "[^A-Za-z0-9]+")
    compact = f"array_to_string(list_transform({runs}, lambda r: CASE WHEN {_iban_ok('r')} THEN '[IBAN]' ELSE r END), '')"
    # Group counts that make an IBAN, the greatest first.
    fits = f"list_filter(range(len(string_split(m, ' ')), 2, -1), lambda n: {_iban_ok(_JOINED_SQL)})"
    rest = f"list_prepend('[IBAN]', string_split(m, ' ')[{fits}[1] + 1:])"
    hit = f"CASE WHEN len({fits}) = 0 THEN m ELSE array_to_string({rest}, ' ') END"
    matches = f"list_transform(regexp_extract_all({compact}, '{_RE_PRINTED}'), lambda m: {hit})"
    gaps = f"string_split_regex({compact}, '{_RE_PRINTED}')"
    woven = f"list_transform(list_zip({gaps}, {matches}), lambda z: z[1] || coalesce(z[2], ''))"
    return (
        f"array_to_string({woven}, '')",
        f"(len(list_filter({runs}, lambda r: {_iban_ok('r')}))"
        f" + len(list_filter(regexp_extract_all({text}, '{_RE_PRINTED}'), lambda m: len({fits}) > 0)))",
    )


def ips_sql(text: str) -> tuple[str, str]:
    """IPv4 runs first, IPv6 runs on the outcome, then short ones; no mark holds a digit or colon."""
    four = _runs(text, r"[0-9]+(?:\.[0-9]+)*", "[^0-9]+")
    ok4 = f"regexp_full_match(r, '{_RE_IPV4}')"
    after4 = f"array_to_string(list_transform({four}, lambda r: CASE WHEN {ok4} THEN '[IP]' ELSE r END), '')"
    six = _runs(after4, "[0-9A-Fa-f:]+", "[^0-9A-Fa-f:]+")
    ok6 = f"regexp_full_match(r, '{_RE_IPV6}')"
    after6 = f"array_to_string(list_transform({six}, lambda r: CASE WHEN {ok6} THEN '[IP]' ELSE r END), '')"
    short = _runs(after6, "[0-9A-Za-z_:]+", "[^0-9A-Za-z_:]+")
    # Two colons once; up to seven groups of up to four hex digits, one of them a decimal digit.
    sides = "list_filter(string_split(replace(r, '::', ':'), ':'), lambda g: g <> '')"
    ok0 = (
        f"(len(string_split(r, '::')) = 2 AND NOT contains(r, ':::') AND regexp_matches(r, '[0-9]') AND len({sides}) <= 7 "
        f"AND regexp_full_match(r, '(?:[0-9A-Fa-f]{{1,4}}:)*:?(?::[0-9A-Fa-f]{{1,4}})*') "
        f"AND len(list_filter({sides}, lambda g: NOT regexp_full_match(g, '[0-9A-Fa-f]{{1,4}}'))) = 0)"
    )
    return (
        f"array_to_string(list_transform({short}, lambda r: CASE WHEN {ok0} THEN '[IP]' ELSE r END), '')",
        f"(len(list_filter({four}, lambda r: {ok4})) + len(list_filter({six}, lambda r: {ok6})) + len(list_filter({short}, lambda r: {ok0})))",
    )


def redacted_sql(source: str, keep: str) -> str:
    """All three redactions of ``text`` in ``source``, with ``pii_count``; ``keep`` are further columns."""
    t1, n1 = emails_sql("text")
    t2, n2 = ibans_sql("text")
    t3, n3 = ips_sql("text")
    first = f"SELECT * REPLACE ({t1} AS text), {n1} AS pii_count FROM ({source})"
    second = f"SELECT * EXCLUDE (pii_count) REPLACE ({t2} AS text), pii_count + {n2} AS pii_count FROM ({first})"
    return f"SELECT {keep}, {t3} AS text, (pii_count + {n3})::BIGINT AS pii_count FROM ({second})"


# Right IBANs, some with a wrong check digit; compact, and printed with a year or word behind.
_IBANS = (
    " Pay DE89370400440532013000 or GB82WEST12345698765432, not DE88370400440532013000."
    " Print GB82 WEST 1234 5698 7654 32, AT61 1904 3002 3457 3201 2024 or NO93 8601 1117 947 BY MAIL, not AT62 1904 3002 3457 3201."
)
# Short IPv6, and what isn't one.
_IPS = " Hosts 2001:db8::8a2e:370:7334, ::1 and fe80::1%eth0 (1:2:3:4:5:6:7::), not std::abs, A::B, 12::34::56 or 1::2:3:4:5:6:7:8."
_WITH_IPS_SQL = f"SELECT doc_id, text || CASE WHEN doc_id % 5 = 1 THEN '{_IPS}' ELSE '' END AS text FROM documents"
_WITH_IBANS_SQL = f"SELECT doc_id, text || CASE WHEN doc_id % 5 = 0 THEN '{_IBANS}' ELSE '' END AS text FROM documents"


def _with_ibans(spark, sf_dir):
    extra = F.when(F.col("doc_id") % 5 == 0, F.lit(_IBANS)).otherwise(F.lit(""))
    return spread_small_input(table(spark, sf_dir, "documents")).select("doc_id", F.concat("text", extra).alias("text"))


def _with_ips(spark, sf_dir):
    extra = F.when(F.col("doc_id") % 5 == 1, F.lit(_IPS)).otherwise(F.lit(""))
    return spread_small_input(table(spark, sf_dir, "documents")).select("doc_id", F.concat("text", extra).alias("text"))


# Host of a URL and whether it, or a parent of it, is listed.
_HOST_SQL = r"rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]+)', 1), '.')"
# The list follows from the pages: a quarter of the hosts, of some the parent, with blanks, blank lines and repeats.
_HOSTS_SQL = f"SELECT DISTINCT host, md5(host) AS m FROM (SELECT {_HOST_SQL} AS host FROM pages) WHERE host <> ''"
_LIST_SQL = f"""
SELECT '  ' || CASE WHEN m < '1' AND len(string_split(host, '.')) > 3 THEN regexp_replace(host, '^[^.]*[.]', '') ELSE host END || ' ' AS value
FROM ({_HOSTS_SQL}) WHERE m < '4'
UNION ALL SELECT '' UNION ALL SELECT host FROM ({_HOSTS_SQL}) WHERE m < '2' AND m >= '1'
"""
_DOMAINS_SQL = f"SELECT DISTINCT trim(value) AS domain FROM ({_LIST_SQL}) WHERE trim(value) <> ''"
FLAGGED_SQL = (
    f"SELECT p.*, (SELECT arg_max(domain, length(domain)) FROM ({_DOMAINS_SQL}) d "
    "WHERE p.host = d.domain OR ends_with(p.host, '.' || d.domain)) AS listed_domain "
    f"FROM (SELECT *, {_HOST_SQL} AS host FROM pages) p"
)


def list_lines(spark, sf_dir):
    """The lines of a domain list, derived from the pages' hosts."""
    hosts = spread_small_input(table(spark, sf_dir, "pages")).select(url_host(F.col("url")).alias("h")).distinct().filter("h <> ''")
    m, labels = F.md5("h"), F.size(F.split("h", r"\."))
    parent = F.when((m < "1") & (labels > 3), F.regexp_replace("h", r"^[^.]*\.", "")).otherwise(F.col("h"))
    dressed = F.array(F.concat(F.lit("  "), parent, F.lit(" ")), F.lit(""), F.when(m.between("1", "1z"), F.col("h")).otherwise(""))
    return hosts.filter(m < "4").select(F.explode(dressed).alias("value"))


def domains(spark, sf_dir):
    return ops.domain_table(list_lines(spark, sf_dir))


@query(
    "url_host",
    f"""
    WITH h AS (SELECT page_id, {_HOST_SQL} AS host FROM pages), l AS (SELECT *, string_split(host, '.') AS labels FROM h)
    SELECT page_id, host, unnest(list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.'))) AS domain FROM l
    """,
)
def host_query(spark, sf_dir):
    pages = spread_small_input(table(spark, sf_dir, "pages")).select("page_id", url_host(F.col("url")).alias("host"))
    return pages.select("page_id", "host", F.explode(domain_suffixes(F.col("host"))).alias("domain"))


@query("load_domain_list", _DOMAINS_SQL)
def load_domain_list(spark, sf_dir):
    path = scratch_path(spark, "domains")
    list_lines(spark, sf_dir).coalesce(1).write.text(path)
    return ops.load_domain_list(spark, path)


@query("robots_filter", f"SELECT page_id, url FROM ({FLAGGED_SQL}) WHERE listed_domain IS NULL")
def robots_filter(spark, sf_dir):
    pages = spread_small_input(table(spark, sf_dir, "pages"))
    return ops.robots_filter(pages, domains(spark, sf_dir), key="page_id").select("page_id", "url")


@query("robots_removed", f"SELECT page_id, url, html, listed_domain FROM ({FLAGGED_SQL}) WHERE listed_domain IS NOT NULL")
def robots_removed(spark, sf_dir):
    return ops.robots_removed(spread_small_input(table(spark, sf_dir, "pages")), domains(spark, sf_dir), key="page_id")


@query(
    "extra_blocklists",
    f"""
    SELECT page_id, url FROM ({FLAGGED_SQL}) WHERE listed_domain IS NULL
      AND NOT regexp_matches(lower(url), '(^|[^a-z0-9])(feed|page)($|[^a-z0-9])')
      AND url NOT IN (SELECT url FROM pages WHERE contains(url, 'html'))
    """,
)
def extra_blocklists(spark, sf_dir):
    pages = spread_small_input(table(spark, sf_dir, "pages"))
    urls = pages.filter(F.col("url").contains("html")).select("url")
    out = ops.extra_blocklists(pages, domains(spark, sf_dir), urls, ["feed", "page"], key="page_id")
    return out.select("page_id", "url")


_E_TEXT, _E_N = emails_sql("text")
_I_TEXT, _I_N = ips_sql("text")
_B_TEXT, _B_N = ibans_sql("text")


@query("redact_emails", f"SELECT doc_id, {_E_TEXT} AS text, {_E_N}::BIGINT AS pii_count FROM documents")
def redact_emails(spark, sf_dir):
    return ops.redact_pii(spread_small_input(table(spark, sf_dir, "documents")).select("doc_id", "text"), ibans=False, ips=False)


@query("redact_ips", f"SELECT doc_id, {_I_TEXT} AS text, {_I_N}::BIGINT AS pii_count FROM ({_WITH_IPS_SQL})")
def redact_ips(spark, sf_dir):
    return ops.redact_pii(_with_ips(spark, sf_dir), emails=False, ibans=False)


@query("redact_ibans", f"SELECT doc_id, {_B_TEXT} AS text, {_B_N}::BIGINT AS pii_count FROM ({_WITH_IBANS_SQL})")
def redact_ibans(spark, sf_dir):
    return ops.redact_pii(_with_ibans(spark, sf_dir), emails=False, ips=False)


@query("pii_count", f"SELECT doc_id, pii_count FROM ({redacted_sql(_WITH_IBANS_SQL, 'doc_id')})")
def pii_count(spark, sf_dir):
    return ops.redact_pii(_with_ibans(spark, sf_dir)).select("doc_id", "pii_count")


@query("keep_schema", redacted_sql("SELECT * FROM documents", "doc_id, lang, source, n_chars"))
def keep_schema(spark, sf_dir):
    return ops.redact_pii(spread_small_input(table(spark, sf_dir, "documents")))


_STAGE_DOCS_SQL = f"SELECT page_id, url, html || ' mail a.b@c.example.org from 10.0.0.' || page_id || {_IBANS!r} AS text, listed_domain FROM ({FLAGGED_SQL})"


@query(
    "url_pii_stage",
    f"""
    SELECT page_id, url, text, pii_count, 'kept' AS side FROM ({redacted_sql(f"SELECT * FROM ({_STAGE_DOCS_SQL}) WHERE listed_domain IS NULL", "page_id, url")})
    UNION ALL
    SELECT page_id, url, text, NULL, 'removed' FROM ({_STAGE_DOCS_SQL}) WHERE listed_domain IS NOT NULL
    """,
)
def url_pii_stage(spark, sf_dir):
    text = F.concat("html", F.lit(" mail a.b@c.example.org from 10.0.0."), "page_id", F.lit(_IBANS))
    docs = spread_small_input(table(spark, sf_dir, "pages")).select("page_id", "url", text.alias("text"))
    kept, removed = ops.url_pii_stage(docs, domains(spark, sf_dir), key="page_id")
    return kept.withColumn("side", F.lit("kept")).unionByName(
        removed.withColumn("side", F.lit("removed")), allowMissingColumns=True
    )
