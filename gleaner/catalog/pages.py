"""Page extraction, language and character clean-up."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import functions as F

from gleaner.catalog.base import query, table
from gleaner.functions.unicode import to_nfc, unicode_cleanup
from gleaner.operators import extract as ops, langid
from gleaner.session import bounded_batches, spread_small_input

_ATTR = r"(?:[ \t\n\r\f/][^>]*)?"
_BLOCKS = (
    "address|article|aside|blockquote|body|caption|center|dd|div|dl|dt|fieldset|figcaption|figure|footer|form"
    "|h[1-6]|header|hr|html|legend|li|main|ol|optgroup|option|p|pre|section|select|table|tbody|td|textarea|tfoot|th|thead|tr|ul"
)
_WORD_RE = r"[^ \t\n\r\f.,;:!?()\[\]\"]+"


def _unescaped(text: str) -> str:
    digits = "regexp_extract(e, '#[xX]?([0-9A-Fa-f]+);', 1)"
    code = f"CASE WHEN regexp_matches(e, '^&#[xX]') THEN ('0x' || {digits})::BIGINT ELSE {digits}::BIGINT END"
    named = " ".join(
        f"WHEN e = '{n}' THEN {v}"
        for n, v in {"&amp;": "'&'", "&lt;": "'<'", "&gt;": "'>'", "&quot;": "'\"'", "&apos;": "''''", "&nbsp;": "' '"}.items()
    )
    known = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
    names = sorted(n for n in html5 if n.endswith(";"))
    values = "\x01".join(html5[n] for n in names).replace("'", "''")
    table = f"map(string_split('{' '.join(names)}', ' '), string_split('{values}', chr(1)))"
    return (
        rf"array_to_string(list_transform(regexp_extract_all({text}, '&(?:[A-Za-z][A-Za-z0-9]{{1,31}}|#[0-9]{{1,7}}|#[xX][0-9A-Fa-f]{{1,6}});|[^&]+|&'), "
        f"lambda e: CASE {named} WHEN regexp_full_match(e, '{known}') AND (({code}) BETWEEN 1 AND 55295 OR ({code}) BETWEEN 57344 AND 1114111) "
        f"THEN chr(({code})::INTEGER) WHEN regexp_full_match(e, '&[A-Za-z][A-Za-z0-9]*;') THEN coalesce({table}[substr(e, 2)], e) ELSE e END), '')"
    )


def _plain(text: str) -> str:
    bare = _unescaped(f"regexp_replace(regexp_replace({text}, '(?i)<br{_ATTR}>', ' ', 'g'), '<[^>]*>', '', 'g')")
    return rf"trim(regexp_replace({bare}, '[ \t\n\r\f]+', ' ', 'g'), ' ')"


def _visible(html: str) -> str:
    out = rf"regexp_replace({html}, '(?s)<!--.*?-->', '', 'g')"
    for name in ["head", "script", "style", "nav", "noscript", "template"]:
        out = rf"regexp_replace({out}, '(?is)<{name}{_ATTR}>.*?</{name}[ \t\n\r\f]*>', '', 'g')"
    return out


_LANG = r"""regexp_extract(html, '(?i)<html[^>]*[ \t\n\r\f]lang=["'']?([a-z]{2})', 1)"""
PARAGRAPHS_SQL = rf"""
SELECT page_id, lang, (i - 1)::INTEGER AS para_no, tag, text, link_chars FROM (
  SELECT page_id, lang, i, lower(tag) AS tag, {_plain("piece")} AS text,
    coalesce(list_sum(list_transform(regexp_extract_all(piece, '(?is)<a{_ATTR}>(.*?)</a[ \t\n\r\f]*>', 1), lambda a: length({_plain("a")}))), 0)::INTEGER AS link_chars
  FROM (SELECT page_id, CASE WHEN {_LANG} = '' THEN 'en' ELSE lower({_LANG}) END AS lang,
      unnest(regexp_split_to_array(v, '(?i)</?(?:{_BLOCKS}){_ATTR}>')) AS piece,
      unnest(list_prepend('', regexp_extract_all(v, '(?i)</?({_BLOCKS}){_ATTR}>', 1))) AS tag,
      generate_subscripts(regexp_split_to_array(v, '(?i)</?(?:{_BLOCKS}){_ATTR}>'), 1) AS i
    FROM (SELECT *, {_visible("html")} AS v FROM pages)))
WHERE text <> ''
"""
STOPWORDS_SQL = f"""
SELECT lang, word, doc_freq FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_freq DESC, word) AS n FROM (
    SELECT lang, word, count(*) AS doc_freq FROM (
      SELECT lower(lang) AS lang, unnest(list_distinct(regexp_extract_all(lower(text), '{_WORD_RE}'))) AS word FROM documents)
    GROUP BY ALL)) WHERE n <= 50
"""
FEATURES_SQL = f"""
SELECT p.* EXCLUDE (words), length(text)::INTEGER AS length,
  coalesce(round(len(list_filter(words, lambda w: list_contains(stops, w)))::DOUBLE / nullif(len(words), 0), 6), 0) AS stop_density,
  round(link_chars::DOUBLE / length(text), 6) AS link_density
FROM (SELECT *, regexp_extract_all(lower(text), '{_WORD_RE}') AS words FROM ({PARAGRAPHS_SQL})) p
LEFT JOIN (SELECT lang, list(word) AS stops FROM ({STOPWORDS_SQL}) GROUP BY lang) USING (lang)
"""
CLASS_SQL = f"""
SELECT *, CASE WHEN link_density > 0.2 THEN 'bad' WHEN length < 70 THEN CASE WHEN link_chars > 0 THEN 'bad' ELSE 'short' END
  WHEN stop_density >= 0.32 THEN CASE WHEN length > 200 THEN 'good' ELSE 'neargood' END
  WHEN stop_density >= 0.30 THEN 'neargood' ELSE 'bad' END AS cls FROM ({FEATURES_SQL})
"""


def _near(column: str, kinds: str, before: bool) -> str:
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING" if before else "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    pick = "last_value" if before else "first_value"
    return (
        f"coalesce({pick}(CASE WHEN {column} IN ({kinds}) THEN {column} END IGNORE NULLS) OVER "
        f"(PARTITION BY page_id ORDER BY para_no {frame}), 'bad')"
    )


_TWO, _THREE = "'good', 'bad'", "'good', 'bad', 'neargood'"
CONTEXT_SQL = f"""
SELECT * EXCLUDE (c2, b, a), CASE WHEN c2 = 'neargood' THEN CASE WHEN b = 'bad' AND a = 'bad' THEN 'bad' ELSE 'good' END ELSE c2 END AS final
FROM (SELECT *, {_near("c2", _TWO, True)} AS b, {_near("c2", _TWO, False)} AS a FROM (
  SELECT * EXCLUDE (p, pa, n, na), CASE WHEN cls <> 'short' THEN cls WHEN p = n THEN p
    WHEN (p = 'bad' AND pa = 'neargood') OR (n = 'bad' AND na = 'neargood') THEN 'good' ELSE 'bad' END AS c2
  FROM (SELECT *, {_near("cls", _TWO, True)} AS p, {_near("cls", _THREE, True)} AS pa,
          {_near("cls", _TWO, False)} AS n, {_near("cls", _THREE, False)} AS na FROM ({CLASS_SQL}))))
"""
EXTRACT_SQL = f"SELECT page_id, string_agg(text, chr(10) ORDER BY para_no) AS text FROM ({CONTEXT_SQL}) WHERE final = 'good' GROUP BY page_id"


def pages(spark, sf_dir):
    return spread_small_input(table(spark, sf_dir, "pages"))


def stopwords(spark, sf_dir):
    return ops.stopword_table(spread_small_input(table(spark, sf_dir, "documents")))


def _features(spark, sf_dir):
    return ops.paragraph_features(ops.page_paragraphs(pages(spark, sf_dir)), stopwords(spark, sf_dir))


@query("page_paragraphs", PARAGRAPHS_SQL)
def page_paragraphs(spark, sf_dir):
    return ops.page_paragraphs(pages(spark, sf_dir))


@query("stopword_table", STOPWORDS_SQL)
def stopword_table(spark, sf_dir):
    return stopwords(spark, sf_dir)


@query("paragraph_features", FEATURES_SQL)
def paragraph_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query("paragraph_class", CLASS_SQL)
def paragraph_class(spark, sf_dir):
    return ops.paragraph_class(_features(spark, sf_dir))


@query("paragraph_context", CONTEXT_SQL)
def paragraph_context(spark, sf_dir):
    return ops.paragraph_context(pages(spark, sf_dir), stopwords(spark, sf_dir))


@query("extract_text", EXTRACT_SQL)
def extract_text(spark, sf_dir):
    return ops.extract_text(pages(spark, sf_dir), stopwords(spark, sf_dir))


# Naive Bayes over lower-cased trigrams, trained on the labelled documents.
_GRAMS = "SELECT {keys}, unnest(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))) AS gram FROM (SELECT *, lower(text) AS t FROM ({source}))"


def lang_ctes(source: str, key: str) -> str:
    """CTEs ending in ``lid(key, code, score)`` for ``source(key, text)``."""
    return f"""
    cnt AS MATERIALIZED (SELECT lang, gram, count(*) AS n FROM ({_GRAMS.format(keys="lang", source="SELECT * FROM documents")}) GROUP BY ALL),
    voc AS MATERIALIZED (SELECT DISTINCT gram FROM cnt),
    kpt AS MATERIALIZED (SELECT lang, gram, n FROM cnt JOIN voc USING (gram)),
    tot AS MATERIALIZED (SELECT lang, sum(n)::BIGINT AS total, (SELECT count(*) FROM voc) AS size FROM kpt GROUP BY lang),
    mdl AS MATERIALIZED (SELECT t.lang, v.gram, round(ln((coalesce(k.n, 0) + 1)::DOUBLE / (t.total + t.size + 1)) * 10000)::BIGINT AS weight
      FROM tot t CROSS JOIN (SELECT gram FROM voc UNION ALL SELECT NULL) v LEFT JOIN kpt k ON k.lang = t.lang AND k.gram = v.gram),
    grm AS MATERIALIZED (SELECT {key}, gram, count(*) AS c FROM ({_GRAMS.format(keys=key, source=source)}) GROUP BY ALL),
    sms AS (SELECT {key}, lang, sum(c * coalesce(m.weight, u.weight))::BIGINT AS s FROM grm
      CROSS JOIN (SELECT lang, weight FROM mdl WHERE gram IS NULL) u LEFT JOIN mdl m USING (lang, gram) GROUP BY {key}, lang),
    al AS (SELECT d.{key}, t.lang, coalesce(s.s, 0) AS s FROM ({source}) d CROSS JOIN (SELECT lang FROM tot) t LEFT JOIN sms s ON s.{key} = d.{key} AND s.lang = t.lang),
    lid AS (SELECT {key}, upper(arg_max(lang, (s, -rnk))) AS code, round(1.0::DOUBLE / sum(exp((s - top) / 10000.0::DOUBLE)), 6) AS score
      FROM (SELECT *, max(s) OVER (PARTITION BY {key}) AS top, row_number() OVER (PARTITION BY {key} ORDER BY lang) AS rnk FROM al) GROUP BY {key})
    """


@query("lang_id", f"WITH {lang_ctes('SELECT doc_id, text FROM documents', 'doc_id')} SELECT doc_id, code, score FROM lid")
def lang_id(spark, sf_dir):
    docs = spread_small_input(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    scorer = langid.language_scorer(langid.train_language_model(docs))
    return docs.select("doc_id", scorer(F.col("text")).alias("l")).select("doc_id", "l.code", "l.score")


_ODD = "“x” ‘y’\r\nﬁn ﬂy\x07​﻿end"
_ODD_CLEAN = "\"x\" 'y'\nfin flyend"
# Runs misread as Windows-1252 or Latin-1 beside other characters, and text that only looks so.
_RUNS = " itâ€™s cafÃ© 漢字 dÃ¼nn Ð¿Ñ€Ð¸Ð²ÐµÑ‚ ðŸ˜€ â€” “CAFÉ” «\u00a0été\u00a0» می\u200cخواهم"
_RUNS_CLEAN = " it's café 漢字 dünn привет 😀 — \"CAFÉ\" «\u00a0été\u00a0» می\u200cخواهم"


@query(
    "unicode_cleanup",
    f"SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN '{_ODD_CLEAN.replace(chr(39), chr(39) * 2)}' "
    f"WHEN 1 THEN '{_RUNS_CLEAN.replace(chr(39), chr(39) * 2)}' ELSE '' END AS text FROM documents",
)
def cleanup(spark, sf_dir):
    """Documents spoilt on purpose: read as Latin-1, or with odd characters or misread runs at the end."""
    docs = table(spark, sf_dir, "documents")
    misread = F.decode(F.col("text").cast("binary"), "ISO-8859-1")
    rest = F.col("doc_id") % 3
    spoilt = F.when(rest == 0, F.concat("text", F.lit(_ODD))).when(rest == 1, F.concat("text", F.lit(_RUNS))).otherwise(misread)
    return docs.select("doc_id", unicode_cleanup(spoilt).alias("text"))


@query("unicode_nfc", "SELECT doc_id, nfc_normalize(replace(text, 'é', 'e' || chr(769))) AS text FROM documents")
def unicode_nfc(spark, sf_dir):
    bounded_batches(spark)
    split = F.replace(F.col("text"), F.lit("é"), F.lit("é"))
    return table(spark, sf_dir, "documents").select("doc_id", to_nfc(split).alias("text"))
