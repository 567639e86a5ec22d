"""Exact and near duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import query, table
from gleaner.catalog.filters import CANONICAL_SQL, canonical
from gleaner.functions import digests
from gleaner.operators import exact, fuzzy
from gleaner.operators.components import connected_components
from gleaner.session import bounded_batches, spread_small_input

EXACT_KEPT_SQL = "SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1"
_EXACT_DUP_SQL = "SELECT doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1"

_P = 2**31 - 1


def _coef(kind: str, i: str) -> str:
    return f"(('0x' || substr(md5('minhash:{kind}:' || {i}), 1, 8))::BIGINT % {_P - 1} + 1)"


def signatures_sql(source: str) -> str:
    """``(doc_id, sig)`` with the 260 minima of every document of ``source``."""
    return f"""
    SELECT doc_id, list(m ORDER BY i) AS sig FROM (
      SELECT doc_id, i, min((a * h + b) % {_P}) AS m
      FROM (
        SELECT DISTINCT doc_id, list_sum(list_transform(range(24), lambda j: w[j + 1] * coalesce(codes[s + j], 0)))::BIGINT % {_P} AS h
        FROM (SELECT doc_id, codes, unnest(range(1, greatest(len(codes) - 24 + 1, 1) + 1)) AS s FROM (
          SELECT doc_id, list_transform(string_split(text, ''), lambda c: unicode(c)::BIGINT) AS codes FROM ({source}))),
        (SELECT list({_coef("w", "j")} ORDER BY j) AS w FROM range(24) t(j))
      ), (SELECT i, {_coef("a", "i")} AS a, {_coef("b", "i")} AS b FROM range(260) t(i))
      GROUP BY doc_id, i) GROUP BY doc_id
    """


def bands_sql(source: str) -> str:
    return f"""
    SELECT doc_id, band, md5(band || ',' || array_to_string(sig[band * 13 + 1:band * 13 + 13], ',')) AS band_hash
    FROM ({signatures_sql(source)}), (SELECT range::INTEGER AS band FROM range(20))
    """


def edges_sql(source: str) -> str:
    return f"""
    SELECT DISTINCT src, dst FROM (
      SELECT min(doc_id) OVER (PARTITION BY band_hash) AS src, doc_id AS dst FROM ({bands_sql(source)})) WHERE src <> dst
    """


def components_ctes(edges: str) -> str:
    """CTEs ending in ``comp(id, component)``."""
    return f"""
    e AS MATERIALIZED ({edges}),
    s AS MATERIALIZED (SELECT src AS u, dst AS v FROM e UNION SELECT dst, src FROM e),
    reach(id, other) AS (SELECT u, u FROM s UNION SELECT r.id, s.v FROM reach r JOIN s ON r.other = s.u),
    comp AS (SELECT id, min(other) AS component FROM reach GROUP BY id)
    """


def kept(spark, sf_dir):
    return exact.exact_dedup(spread_small_input(table(spark, sf_dir, "documents")))


@query("assign_ids", f"SELECT url, row_number() OVER (ORDER BY url) - 1 AS id FROM ({CANONICAL_SQL})")
def assign_ids(spark, sf_dir):
    return exact.assign_ids(canonical(spark, sf_dir), "url")


@query("text_hash", "SELECT doc_id, md5(text) AS hash FROM documents")
def text_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", exact.text_hash(F.col("text")).alias("hash"))


@query("exact_dup_ids", _EXACT_DUP_SQL)
def exact_dup_ids(spark, sf_dir):
    return exact.exact_dup_ids(table(spark, sf_dir, "documents"))


@query(
    "remove_by_ids",
    f"SELECT url, warc_id, source_id, language, text, file_name FROM ({CANONICAL_SQL}) WHERE doc_id NOT IN ({_EXACT_DUP_SQL})",
)
def remove_by_ids(spark, sf_dir):
    docs = canonical(spark, sf_dir)
    ids, _ = exact.run_exact_dedup(docs, identify=True)
    return exact.run_exact_dedup(docs, ids, remove=True)[1]


@query("exact_dedup", EXACT_KEPT_SQL)
def exact_dedup(spark, sf_dir):
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


@query(
    "dup_counts",
    f"SELECT count(*) AS num_duplicates, count(*) AS num_duplicates_removed FROM ({_EXACT_DUP_SQL})",
)
def dup_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return exact.dup_counts(docs, exact.exact_dup_ids(docs))


@query(
    "char_shingles",
    """
    SELECT doc_id, count(*) AS shingles, min(shingle) AS first, max(shingle) AS last, sum(length(shingle))::BIGINT AS chars,
      min(md5(shingle)) AS low
    FROM (SELECT DISTINCT doc_id, substr(text, s, 24) AS shingle
          FROM (SELECT doc_id, text, unnest(range(1, greatest(length(text) - 23, 1) + 1)) AS s FROM documents))
    GROUP BY doc_id
    """,
)
def char_shingles(spark, sf_dir):
    docs = spread_small_input(table(spark, sf_dir, "documents"))
    shingles = fuzzy.char_shingles(docs, summary=(digests.SUMMARY, digests.list_summary))
    return shingles.groupBy("doc_id").agg(
        F.sum("size").alias("shingles"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("chars").alias("chars"),
        F.min("low").alias("low"),
    )


@query("minhash", f"SELECT doc_id, array_to_string(sig, ',') AS signature FROM ({signatures_sql('SELECT * FROM documents')})")
def minhash(spark, sf_dir):
    bounded_batches(spark)
    docs = spread_small_input(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", F.array_join(fuzzy.minhash(F.col("text")).cast("array<string>"), ",").alias("signature"))


@query("lsh_bands", bands_sql("SELECT * FROM documents"))
def lsh_bands(spark, sf_dir):
    bands = fuzzy.lsh_bands(spread_small_input(table(spark, sf_dir, "documents")))
    return bands.select("doc_id", "band", F.lower(F.hex("band_hash")).alias("band_hash"))


@query("lsh_edges", edges_sql(EXACT_KEPT_SQL))
def lsh_edges(spark, sf_dir):
    return fuzzy.lsh_edges(kept(spark, sf_dir))


def verified_sql(source: str) -> str:
    """Pairs of a shared band whose sets of shingles have at least 80 percent in common."""
    return f"""
    SELECT src, dst FROM (
      SELECT src, dst, len(list_intersect(s.grams, d.grams)) AS common, len(s.grams) + len(d.grams) AS sizes
      FROM (SELECT DISTINCT a.doc_id AS src, b.doc_id AS dst FROM bands a JOIN bands b ON a.band_hash = b.band_hash AND a.doc_id < b.doc_id)
      JOIN (SELECT doc_id, {_GRAMS_SQL} AS grams FROM ({source})) s ON s.doc_id = src
      JOIN (SELECT doc_id, {_GRAMS_SQL} AS grams FROM ({source})) d ON d.doc_id = dst)
    WHERE 100 * common >= 80 * (sizes - common)
    """


_GRAMS_SQL = "list_distinct(list_transform(range(1, greatest(length(text) - 23, 1) + 1), lambda s: substr(text, s, 24)))"


@query(
    "lsh_groups_verified",
    f"WITH RECURSIVE bands AS MATERIALIZED ({bands_sql('SELECT * FROM documents')}), "
    f"{components_ctes(verified_sql('SELECT * FROM documents'))} SELECT id, component FROM comp",
)
def lsh_groups_verified(spark, sf_dir):
    return fuzzy.verified_groups(spread_small_input(table(spark, sf_dir, "documents")))


_CHAIN_LINKS = "SELECT doc_id AS dst, doc_id - 1 AS src FROM documents WHERE doc_id % 25 <> 0"


@query(
    "connected_components",
    f"WITH RECURSIVE {components_ctes(_CHAIN_LINKS)} SELECT id, component FROM comp",
)
def components(spark, sf_dir):
    chains = table(spark, sf_dir, "documents").filter("doc_id % 25 <> 0")
    return connected_components(chains.select((F.col("doc_id") - 1).alias("src"), F.col("doc_id").alias("dst")))


# Ids by their remainder of 3: a star around 0, a chain, and a binary tree below 2.
_SHAPES = """
SELECT CASE doc_id % 3 WHEN 0 THEN 0 WHEN 1 THEN doc_id - 3 ELSE 2 + 3 * (doc_id // 3 // 2) END AS src, doc_id AS dst
FROM documents WHERE doc_id > 2
"""


@query("component_shapes", f"WITH RECURSIVE {components_ctes(_SHAPES)} SELECT id, component FROM comp")
def component_shapes(spark, sf_dir):
    i = F.col("doc_id")
    parent = F.when(i % 3 == 0, F.lit(0)).when(i % 3 == 1, i - 3).otherwise(F.expr("2 + 3 * (doc_id div 3 div 2)"))
    links = table(spark, sf_dir, "documents").filter("doc_id > 2")
    return connected_components(links.select(parent.cast("bigint").alias("src"), i.alias("dst")))


@query(
    "fuzzy_dup_ids",
    f"WITH RECURSIVE {components_ctes(edges_sql(EXACT_KEPT_SQL))} SELECT id AS doc_id FROM comp WHERE id <> component",
)
def fuzzy_dup_ids(spark, sf_dir):
    return fuzzy.fuzzy_dup_ids(kept(spark, sf_dir))


@query(
    "fuzzy_dedup",
    f"WITH RECURSIVE {components_ctes(edges_sql(EXACT_KEPT_SQL))} "
    f"SELECT * FROM ({EXACT_KEPT_SQL}) WHERE doc_id NOT IN (SELECT id FROM comp WHERE id <> component)",
)
def fuzzy_dedup(spark, sf_dir):
    return fuzzy.fuzzy_dedup(kept(spark, sf_dir))
