"""Repeated passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleaner.catalog.base import query, table
from gleaner.catalog.dedup import EXACT_KEPT_SQL, kept
from gleaner.operators import substring as ops
from gleaner.session import cut_lineage

TOKENS_SQL = r"regexp_extract_all(text, '^[ \t\n\r\f]+|[^ \t\n\r\f]+[ \t\n\r\f]*')"


def repeated_sql(source: str, keep_first: bool) -> str:
    """``(doc_id, pos)`` of repeated 50-grams, by md5 over the md5 of each token."""
    return f"""
    SELECT doc_id, pos FROM (
      SELECT doc_id, pos, count(*) OVER (PARTITION BY gram) AS n,
        row_number() OVER (PARTITION BY gram ORDER BY doc_id, pos) AS nth
      FROM (
        SELECT doc_id, p AS pos, md5(array_to_string(hashes[p + 1:p + 50], '')) AS gram
        FROM (SELECT doc_id, hashes, unnest(range(0, len(hashes) - 49)) AS p FROM (
          SELECT doc_id, list_transform({TOKENS_SQL}, lambda t: md5(t)) AS hashes FROM ({source})))
      )) WHERE n > 1 {"AND nth > 1" if keep_first else ""}
    """


def islands_sql(spans: str) -> str:
    """Merge ``(doc_id, start, end)`` spans that overlap or touch."""
    return f"""
    SELECT doc_id, min("start") AS "start", max("end") AS "end" FROM (
      SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT *, CASE WHEN coalesce("start" > max("end") OVER (PARTITION BY doc_id ORDER BY "start", "end"
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 1 ELSE 0 END AS opens FROM ({spans})))
    GROUP BY doc_id, island
    """


def ranges_sql(source: str) -> str:
    return islands_sql(f'SELECT doc_id, pos AS "start", pos + 50 AS "end" FROM ({repeated_sql(source, True)})')


def cut_sql(source: str) -> str:
    """``source`` with repeated passages cut from ``text``, the first copy kept."""
    return f"""
    SELECT d.* REPLACE (CASE WHEN c.cuts IS NULL THEN text ELSE
      array_to_string(list_filter({TOKENS_SQL}, lambda t, i: NOT list_bool_or(list_transform(c.cuts,
        lambda x: i > x."start" AND i <= x."end"))), '') END AS text)
    FROM ({source}) d LEFT JOIN (
      SELECT doc_id, list(struct_pack("start" := "start", "end" := "end")) AS cuts FROM ({ranges_sql(source)}) GROUP BY doc_id) c
      USING (doc_id)
    """


@query("token_stream", f"SELECT doc_id, (generate_subscripts(t, 1) - 1)::INTEGER AS pos, unnest(t) AS token FROM (SELECT doc_id, {TOKENS_SQL} AS t FROM documents)")
def token_stream(spark, sf_dir):
    return ops.token_stream(table(spark, sf_dir, "documents"))


_OFFSETS_SQL = f"""
SELECT source, doc_id, n_tokens, (sum(12 + 2 * n_tokens) OVER w)::BIGINT - 12 - 2 * n_tokens AS doc_start,
  (sum(12 + 2 * n_tokens) OVER w)::BIGINT AS doc_end
FROM (SELECT source, doc_id, len({TOKENS_SQL}) AS n_tokens FROM documents)
WINDOW w AS (ORDER BY source, doc_id ROWS UNBOUNDED PRECEDING)
"""


def _offsets(spark, sf_dir):
    return ops.doc_offsets(table(spark, sf_dir, "documents"), ["source", "doc_id"])


@query("doc_offsets", _OFFSETS_SQL)
def doc_offsets(spark, sf_dir):
    return _offsets(spark, sf_dir)


@query("repeated_kgrams", repeated_sql(EXACT_KEPT_SQL, False))
def repeated_kgrams(spark, sf_dir):
    return ops.repeated_kgrams(kept(spark, sf_dir))


@query("merge_intervals", ranges_sql(EXACT_KEPT_SQL))
def merge_intervals(spark, sf_dir):
    return ops.cut_ranges(ops.repeated_kgrams(kept(spark, sf_dir), keep="first"))


# Byte intervals made from the offsets: around document ends, inside separators,
# with odd ends, overlapping, and too short.
_SPANS_SQL = f"""
SELECT doc_start + doc_id % 300 + k AS "start", doc_start + doc_id % 300 + k + 40 + doc_id * 7 % 2500 AS "end"
FROM ({_OFFSETS_SQL}), (SELECT unnest([0, 111]) AS k) WHERE doc_id % 3 <> 1
"""


def _spans(offsets):
    begin = F.col("doc_start") + F.col("doc_id") % 300 + F.col("k")
    return (
        offsets.filter("doc_id % 3 <> 1")
        .withColumn("k", F.explode(F.array(F.lit(0), F.lit(111))))
        .select(begin.alias("start"), (begin + 40 + F.col("doc_id") * 7 % 2500).alias("end"))
    )


_ADJUSTED_SQL = f"""
SELECT doc_id, c."start" AS "start", c."end" AS "end" FROM (
  SELECT doc_id, unnest(list_reduce(list_prepend(
      {{'s': 0::BIGINT, 'e': 0::BIGINT, 'free': doc_start + 12, 'cuts': []::STRUCT("start" BIGINT, "end" BIGINT)[]}},
      list_transform(pieces, lambda p: {{'s': p.s, 'e': p.e, 'free': 0::BIGINT, 'cuts': []::STRUCT("start" BIGINT, "end" BIGINT)[]}})),
    lambda acc, p: CASE
      WHEN (doc_start + 12 + ((p.e - doc_start - 12 + 4000000) // 2 - 2000000) * 2)
         - (doc_start + 12 + ((greatest(p.s, acc.free) - doc_start - 12 + 1) // 2) * 2) >= 100
      THEN {{'s': 0::BIGINT, 'e': 0::BIGINT, 'free': doc_start + 12 + ((p.e - doc_start - 12) // 2) * 2,
        'cuts': list_append(acc.cuts, {{'start': doc_start + 12 + ((greatest(p.s, acc.free) - doc_start - 12 + 1) // 2) * 2,
                                      'end': doc_start + 12 + ((p.e - doc_start - 12) // 2) * 2}})}}
      ELSE acc END).cuts) AS c
  FROM (SELECT o.doc_id, o.doc_start, list({{'s': greatest(i."start", o.doc_start), 'e': least(i."end", o.doc_end)}}
          ORDER BY greatest(i."start", o.doc_start), least(i."end", o.doc_end)) AS pieces
        FROM ({_OFFSETS_SQL}) o JOIN ({_SPANS_SQL}) i ON i."start" < o.doc_end AND i."end" > o.doc_start
        GROUP BY o.doc_id, o.doc_start))
"""


def _adjusted(offsets):
    return ops.adjust_intervals(_spans(offsets), offsets, threshold=100)


@query("adjust_intervals", _ADJUSTED_SQL)
def adjust_intervals(spark, sf_dir):
    return _adjusted(_offsets(spark, sf_dir))


@query(
    "dedup_offsets",
    f"""
    SELECT source, doc_id, (sum(rest) OVER w)::BIGINT - rest AS doc_start, (sum(rest) OVER w)::BIGINT AS doc_end FROM (
      SELECT source, doc_id, doc_end - doc_start - coalesce(cut, 0)::BIGINT AS rest FROM ({_OFFSETS_SQL})
      LEFT JOIN (SELECT doc_id, sum("end" - "start") AS cut FROM ({_ADJUSTED_SQL}) GROUP BY doc_id) USING (doc_id))
    WINDOW w AS (ORDER BY source, doc_id ROWS UNBOUNDED PRECEDING)
    """,
)
def dedup_offsets(spark, sf_dir):
    offsets = _offsets(spark, sf_dir)
    return ops.dedup_offsets(offsets, _adjusted(offsets), ["source", "doc_id"])


@query(
    "cut_intervals",
    f"SELECT doc_id, text FROM ({cut_sql(EXACT_KEPT_SQL)})",
)
def cut_intervals(spark, sf_dir):
    docs = kept(spark, sf_dir)
    cuts = ops.cut_ranges(ops.repeated_kgrams(docs, keep="first"))
    return ops.cut_intervals(docs.select("doc_id", "text"), cuts)


@query("reconstruct_documents", cut_sql(EXACT_KEPT_SQL))
def reconstruct_documents(spark, sf_dir):
    docs = kept(spark, sf_dir)
    # Both uses read the stored cuts.
    cuts = cut_lineage(ops.cut_ranges(ops.repeated_kgrams(docs, keep="first")))
    affected = docs.select("doc_id", "text").join(cuts.select("doc_id").distinct(), "doc_id", "left_semi")
    return ops.reconstruct_documents(docs, ops.cut_intervals(affected, cuts))


@query("substring_dedup", cut_sql(EXACT_KEPT_SQL))
def substring_dedup(spark, sf_dir):
    return ops.substring_dedup(kept(spark, sf_dir))
