"""One query per operator over the whole of its table, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gleaner.llm import archives, attribution, bpe, disclosure, exact, mixing, near, neighbours, postings, rules, spelling, toxicity, turns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file, which is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Whole characters that count as blanks, as a DuckDB pattern.
_BLANK = "[\\x20\\x09-\\x0D]"

MIX_SQL = f"""
WITH r AS (
  SELECT doc_id, source, coalesce('=' || source, 'none') AS skey,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS hash
  FROM documents
), s AS (
  SELECT skey, source, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY skey, source
), w AS (
  SELECT skey, source_size,
         CAST(list_extract([3, 1, 2], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)) AS BIGINT) AS weight
  FROM s
), l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM w
  WINDOW before AS (ORDER BY source_size::DOUBLE / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT skey, source_size,
         least(2.0::DOUBLE * source_size, max(level) OVER () * weight) AS target
  FROM l
), g AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS BIGINT), 2) ELSE 0 END AS copies FROM t
), u AS (
  SELECT skey, hash, CAST(sum(size) AS BIGINT) AS words FROM r GROUP BY skey, hash
), c AS (
  SELECT u.skey, hash, g.target - g.copies * g.source_size AS need, words,
         sum(words) OVER (PARTITION BY u.skey ORDER BY hash) AS upto
  FROM u JOIN g USING (skey)
)
SELECT r.doc_id, r.size, g.source_size, g.target,
       CAST(r.size * (g.copies + CASE WHEN need > 0 AND (upto <= need OR upto - need < need - (upto - words)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r JOIN g USING (skey) JOIN c USING (skey, hash)
"""


@query("op2_mixing", MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(_table(spark, sf_dir, "documents"))


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 100 OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to, true AS verified
FROM m
"""


@query("op3_warc", WARC_SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.archive_round_trip(_table(spark, sf_dir, "pages"))


EXACT_SQL = f"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g') AS norm FROM documents
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM (
  SELECT doc_id, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size, sha256(norm) AS text_sha256
  FROM n
)
"""


@query("op4_exact_dedup", EXACT_SQL)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_rows(_table(spark, sf_dir, "documents"))


@query("op5_minhash")
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin on whole tables (all pairs); tested against brute force."""
    return near.near_duplicate_rows(_table(spark, sf_dir, "documents"), size=3, percent=85)


def _rules_sql() -> str:
    share = "{}::DOUBLE / greatest({}, 1)"
    shares = {
        "symbols": ("n_symbols", "word_chars"), "duplicate_lines": ("n_dup_lines", "n_lines"), "repeated_words": ("n_repeat_words", "n_words"),
        "capitals": ("n_capitals", "word_chars"), "short_words": ("n_words", "word_chars"),
    }
    first = ", ".join(f"CASE WHEN {share.format(*shares[r])} >= {c}::DOUBLE THEN {j} END" for j, (r, c) in enumerate(rules.PATH))
    p, end = rules.ALPHA, len(rules.PATH) - 1
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, regexp_extract_all(t, '{word}') AS ws FROM d
), win AS (
  SELECT rid, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5
), grams AS (
  SELECT rid, i, ws[i:i + 4] AS g FROM win
), starts AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams) WHERE n > 1
), rep AS (
  SELECT rid, CAST(sum(least(5, coalesce(nxt - i, 5))) AS BIGINT) AS n
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM starts) GROUP BY rid
), lines AS (
  SELECT rid, CAST(count(*) AS BIGINT) AS n, CAST(count(*) - count(DISTINCT x) AS BIGINT) AS dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{word}') GROUP BY rid
), c AS (
  SELECT d.rid, doc_id, lang, md5(t) AS sha, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '{_BLANK}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(lines.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals
  FROM d JOIN w USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)
), f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, coalesce('=' || lang, 'none') AS lang_key,
         CASE WHEN n_words < {rules.LONG_TEXT_WORDS} THEN '/short' ELSE '/long' END AS size, least({first}) AS first
  FROM c
), good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), held AS (
  SELECT min(lang_key) AS lang_key, any_value(size) AS size, any_value(first) AS first FROM f JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY sha
), leaf AS (
  SELECT lang_key, lang_key || size AS stratum, first, count(*) AS k FROM held GROUP BY ALL
), need AS (
  SELECT ceil(ln({rules.DELTA}::DOUBLE / greatest(count(DISTINCT stratum), 1)) / ln(1 - {p}::DOUBLE)) AS needed FROM leaf
), own AS (
  SELECT *, sum(k) OVER (PARTITION BY stratum) >= needed AS own FROM leaf, need
), merged AS (
  SELECT CASE WHEN own THEN stratum WHEN sum(k) FILTER (NOT own) OVER (PARTITION BY lang_key) >= needed THEN lang_key || '/*' ELSE '*' END AS stratum, first, k FROM own
), sized AS (
  SELECT stratum, CAST(sum(k) AS BIGINT) AS n FROM merged GROUP BY stratum
), level AS (
  SELECT {rules.DELTA}::DOUBLE / greatest(count(*), 1) AS level FROM sized
), k AS (
  SELECT stratum, step, n, CAST(coalesce(sum(k) FILTER (first <= step), 0) AS BIGINT) AS k
  FROM merged JOIN sized USING (stratum), (SELECT unnest(range(-1, {end + 1})) AS step) GROUP BY stratum, step, n
), tail AS (
  SELECT stratum, step, CASE WHEN k < n * {p} THEN (
           SELECT sum(exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({p}) + (n - j) * ln(1 - {p})))
           FROM (SELECT unnest(range(0, k + 1)) AS j)) ELSE 1 END AS tail
  FROM k
), last AS (
  SELECT stratum, coalesce(min(CASE WHEN tail > level THEN step END) - 1, {end}) AS last FROM tail, level GROUP BY stratum
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(first <= coalesce(o.last, g.last, (SELECT last FROM last WHERE stratum = '*'), -1), false) AS kept
FROM f LEFT JOIN last o ON o.stratum = lang_key || size LEFT JOIN last g ON g.stratum = lang_key || '/*'
"""


@query("op6_quality_rules", _rules_sql())
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rule_rows(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op8_bpe")
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: SQL has no BPE; tested against the vocabulary's library."""
    return bpe.encode_rows(_table(spark, sf_dir, "documents"), tokenizer_path())


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: a trained model; tested by held-out accuracy."""
    return toxicity.toxicity_rows(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op9_quality_neighbours")
def op9_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: a trained model; tested by held-out accuracy."""
    return neighbours.quality_rows(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line. No SQL twin: SQL has no BPE; tested against the library's offsets."""
    starts, ends = attribution.line_sections(F.col("text"))
    return attribution.attribute(_table(spark, sf_dir, "documents"), tokenizer_path(), starts, ends)


@query("op10_disclosure")
def op10_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No SQL twin: DuckDB's patterns give no places; tested against brute force."""
    return disclosure.digest_rows(_table(spark, sf_dir, "documents"))


#: Table of CRC-32 as a list, made by its rule, and the checksum of a list of bytes.
_CRC_TABLE = """crc AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS tab
  FROM range(256) AS t(n)
)"""
_CRC = "xor(list_reduce(list_prepend(4294967295, {bytes}), lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SPELLING_SQL = f"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS marked, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= {spelling.MIN_LETTERS} GROUP BY ALL
), hashed AS (
  SELECT run, n, {_CRC.format(bytes="""flatten(list_transform(string_split(marked, ''), lambda x:
    CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))""")} AS h
  FROM runs, crc
), results AS (
  SELECT CASE WHEN h % {spelling.DAMAGED} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(word) >= {spelling.MIN_LETTERS} GROUP BY word HAVING sum(n) >= {spelling.MIN_COUNT}
), cut AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON cut.rest = words.word
  UNION SELECT words.word, cut.word FROM cut JOIN words ON cut.rest = words.word
), best AS (
  SELECT near.word, count(*) AS n_near, first(other ORDER BY w.n DESC, other) AS other, max(w.n) AS other_n
  FROM near JOIN words w ON w.word = other GROUP BY near.word
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= {spelling.FORM_TIMES} * n THEN other END AS form,
         CASE WHEN other_n >= {spelling.FORM_TIMES} * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT way.word, formed.form FROM way JOIN formed ON formed.word = way.at WHERE formed.form IS NOT NULL
)
SELECT f.word, f.form, way.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN way ON way.word = f.word JOIN formed e ON e.word = way.at AND e.form IS NULL
"""


@query("op11_spelling", SPELLING_SQL)
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"))


def _turns_sql() -> str:
    """The cheapest edits by a recursion over the rows of each conversation, last to first, with a cost for each of four states."""
    pair = "{{'c': {c}, 'a': {a}, 'r': {r}}}"
    state = lambda i: f"v[{i + 1}]"

    def base(q: int) -> str:
        name, after, keeps = turns.NAME[q], state(turns.NEXT[q]), turns.STEP[q]
        kept = "CASE initial " + " ".join(f"WHEN '{x}' THEN {state(k)}" for x, k in zip(turns.INITIALS, keeps) if k is not None) + " END"
        options = [
            pair.format(c=f"{turns.DELETE} + {state(q)}.c", a=f"'D' || {state(q)}.a", r=f"{state(q)}.r"),
            f"CASE WHEN NOT gone AND {kept} IS NOT NULL THEN " + pair.format(c=f"late + ({kept}).c", a=f"'K' || ({kept}).a", r=f"list_prepend(role || ':' || text, ({kept}).r)") + " END",
            "CASE WHEN NOT gone THEN " + pair.format(c=f"{turns.RETYPE} + late + {after}.c", a=f"'R' || {after}.a", r=f"list_prepend('{name}:' || text, {after}.r)") + " END",
        ]
        return f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1] AS b{q}"

    def closed(q: int) -> str:
        one = turns.NEXT[q]
        two = turns.NEXT[one]
        names = f"'{turns.NAME[q]}:'", f"'{turns.NAME[one]}:'"
        options = [
            f"b{q}",
            pair.format(c=f"{turns.INSERT} + b{one}.c", a=f"'I' || b{one}.a", r=f"list_prepend({names[0]}, b{one}.r)"),
            pair.format(c=f"{2 * turns.INSERT} + b{two}.c", a=f"'II' || b{two}.a", r=f"list_prepend({names[0]}, list_prepend({names[1]}, b{two}.r))"),
        ]
        return f"list_sort([{', '.join(options)}])[1]"

    end = ", ".join(
        pair.format(c=f"CAST({turns.INSERT * len(letters)} AS BIGINT)", a=f"'{letters}'", r=f"CAST([{', '.join(lines)}] AS VARCHAR[])")
        for letters, lines in (("", []), ("II", ["'user:'", "'assistant:'"]), ("I", ["'assistant:'"]), ("", []))
    )
    return f"""
WITH RECURSIVE {_CRC_TABLE}, hashed AS (
  SELECT coalesce('=' || CAST(conv_id AS VARCHAR), 'none') AS conv, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format(bytes="list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(unicode(x) AS BIGINT))")} % 20 AS h
  FROM conversations, crc
), damaged AS (
  SELECT conv, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE h <> 0
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i, substr(role, 1, 1) AS initial FROM damaged
), faults AS (
  SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS seen,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS open, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS two
  FROM ordered
), checked AS (
  SELECT *, blank OR seen AS gone, CASE WHEN open THEN {turns.TRUNCATED} ELSE 0 END AS late FROM faults
), counts AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE seen AND NOT blank) AS duplicate, count(*) FILTER (WHERE open AND NOT gone) AS truncated,
         count(*) FILTER (WHERE two IS NOT NULL AND two NOT IN ('su', 'ua', 'au')) AS illegal
  FROM checked GROUP BY conv
), every AS (
  SELECT DISTINCT conv, conv_id FROM hashed
), priced AS (
  SELECT e.conv, coalesce(n, 0) AS i, [{end}] AS v FROM every e LEFT JOIN counts USING (conv)
  UNION ALL
  SELECT conv, i - 1, [{", ".join(closed(q) for q in range(4))}]
  FROM (SELECT p.conv, p.i, {", ".join(base(q) for q in range(4))} FROM priced p JOIN checked k ON k.conv = p.conv AND k.i = p.i)
)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(v[1].c AS BIGINT) AS cost, v[1].a AS audit, sha256(array_to_string(v[1].r, chr(10))) AS repaired_sha256
FROM every e JOIN priced p ON p.conv = e.conv AND p.i = 0 LEFT JOIN counts c ON c.conv = e.conv
"""


@query("op12_conversations", _turns_sql())
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_rows(_table(spark, sf_dir, "conversations"))


_PLAIN_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
POSTINGS_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_PLAIN_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents
), b AS (
  SELECT item_id, {_PLAIN_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM benchmark
), windows AS (
  SELECT item_id, ws[i:i + {postings.WINDOW_WORDS - 1}] AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - {postings.WINDOW_WORDS - 1}) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT len(w) AS size FROM windows
), spots AS (
  SELECT rid, i, size, ws[i:i + size - 1] AS w FROM (SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d, sizes)
), found AS (
  SELECT rid, i, size, item_id FROM spots JOIN windows USING (w)
), hit AS (
  SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS place FROM found) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS name FROM found WHERE item_id IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""


@query("op13_decontamination", POSTINGS_SQL)
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.digest_rows(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
