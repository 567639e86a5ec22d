"""Inputs at the edges: missing values, long documents, other versions, lists with odd entries."""

import gzip
import time

import pytest
from pyspark.sql import functions as F

from gleaner.functions import pii
from gleaner.operators import extract, fuzzy, langid, segments, stats, urlpii
from gleaner.operators.exact import exact_dedup
from gleaner.operators.quality import digitize
from gleaner.session import shared_dir
from gleaner.sources.files import read_jsonl
from gleaner.sources.warc import read_warc


def seconds(lines: int) -> float:
    start = time.perf_counter()
    cuts = segments.greedy_cuts([10] * lines, 10, 1)
    assert len(cuts) == lines
    return time.perf_counter() - start


def test_chunker_is_linear():
    least = lambda lines: min(seconds(lines) for _ in range(3))  # noqa: E731  (other work may slow one of them)
    assert least(1_000_000) < 2_000 * max(least(10_000), 1e-3)  # 10_000 times if it were quadratic


def test_chunker_takes_a_million_lines(spark):
    docs = spark.createDataFrame([(1,)], "id long").withColumn("text", F.repeat(F.lit("a b c\n"), 1_000_000))
    row = segments.chunk_documents(docs, 3, 1).agg(F.count(F.lit(1)), F.max("segment_id"), F.min("text"), F.max("text")).first()
    assert tuple(row) == (1_000_000, 999_999, "a b c", "a b c")


def test_chunker_plan_holds_no_lines_behind_a_generator(spark):
    docs = spark.createDataFrame([(1, "a\nb")], "id long, text string")
    plan = segments.chunk_documents(docs, 3, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_missing_text_has_no_segment(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b\nc")], "id long, text string")
    assert [tuple(r) for r in segments.chunk_documents(docs, 9, 1).collect()] == [(3, "a b\nc", 0, 4)]


def test_every_row_gets_an_id(spark):
    docs = spark.createDataFrame([("b", "1"), (None, "2"), ("a", "3"), ("b", "4"), (None, "5")], "url string, text string")
    rows = segments.add_document_id(docs, "url").collect()
    assert sorted(r.id for r in rows) == [0, 1, 2, 3, 4]
    assert len({r.text for r in rows}) == 5


def test_missing_texts_are_no_copies(spark):
    docs = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, "x")], "doc_id long, text string")
    assert sorted(r.doc_id for r in exact_dedup(docs).collect()) == [1, 2, 3]
    assert sorted(r.doc_id for r in fuzzy.fuzzy_dedup(docs).collect()) == [1, 2, 3]
    assert docs.select(fuzzy.minhash(F.col("text")).alias("m")).filter("m is null").count() == 2


def test_missing_text_has_no_language(spark):
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string")
    model = langid.train_language_model(docs)
    given = spark.createDataFrame([(1, None), (2, "the dog"), (3, "")], "id long, text string")
    got = {r.id: r.language for r in langid.lang_id(given, model).collect()}
    assert got[1] is None and "EN" in got[2]


def record(version: str, url: str, body: bytes) -> bytes:
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    head = f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Target-URI: {url}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def test_all_versions_of_warc_and_late_charsets(spark, tmp_path):
    late = b"<html><head>" + b"<!-- x -->" * 400 + b'<meta charset="windows-1251"></head>' + "привет".encode("cp1251")
    bodies = [b"one", b"says WARC/1.0\r\n and WARC/1.1\r\n", late]
    data = b"".join(record(v, f"http://h/{i}", b) for i, (v, b) in enumerate(zip(("1.1", "1.0", "1.1"), bodies)))
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data))
    rows = {r.url: r.content for r in read_warc(spark, str(tmp_path)).collect()}
    assert len(rows) == 3
    assert rows["http://h/0"] == "one" and rows["http://h/1"] == bodies[1].decode()
    assert rows["http://h/2"].endswith("привет")


def test_long_local_part(spark):
    text = "mail " + "a" * 100 + "@example.com and b@x.org%c@y.org"
    got = spark.createDataFrame([(text,)], "t string").select(pii.redact_emails(F.col("t")), pii.count_emails(F.col("t"))).first()
    assert tuple(got) == ("mail [EMAIL] and [EMAIL][EMAIL]", 3)


def test_stray_files_are_not_read(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n')
    (tmp_path / "notes.txt").write_text("not json\n")
    assert [r.x for r in read_jsonl(spark, str(tmp_path), spark.createDataFrame([], "x long").schema).collect()] == [1]


def test_words_of_a_blocklist_are_plain(spark):
    docs = spark.createDataFrame([(1, "http://axb.com/"), (2, "http://a.b/")], "warc_id long, url string")
    assert [r.warc_id for r in urlpii.extra_blocklists(docs, words=["a.b"]).collect()] == [1]


def test_hot_suffix_and_unbroadcast_list(spark):
    docs = spark.range(400).select(
        F.col("id").alias("warc_id"), F.concat(F.lit("http://h"), (F.col("id") % 50).cast("string"), F.lit(".x.com/")).alias("url")
    )
    listed = spark.createDataFrame([("h7.x.com",), ("org",)], "domain string")
    hosts = urlpii.listed_hosts(docs, listed, hot_rows=5)
    assert [r.host for r in hosts.filter("listed_domain is not null").collect()] == ["h7.x.com"]
    assert urlpii.robots_filter(docs, listed).count() == 392
    assert urlpii.robots_filter(docs, spark.createDataFrame([("com",)], "domain string")).count() == 0


def test_squares_of_long_texts(spark):
    sums = spark.createDataFrame([("a", 3, 6_000_000_000, 2_000_000_000, 2_000_000_000, 0, 0)], "path string, n long, sum long, min long, max long, sum_lines long, max_lines long")
    row = stats.global_char_stats(sums.withColumn("sumsq", F.lit("12000000000000000000").cast("decimal(38,0)"))).first()
    assert (row["mean"], row["std"]) == (2e9, 0.0)


@pytest.mark.parametrize("score", [None, float("nan")])
def test_missing_score_is_above_all(spark, score):
    assert spark.createDataFrame([(score,)], "s double").select(digitize(F.col("s"), [0.1, 0.2, 0.3])).first()[0] == 3


def test_language_without_a_list(spark):
    stops = spark.createDataFrame([("en", "the"), ("de", "der")], "lang string, word string")
    rows = spark.createDataFrame([("it", "the der casa", 0), ("en", "der the", 0)], "lang string, text string, link_chars int")
    got = {r.lang: r.stop_density for r in extract.paragraph_features(rows, stops).collect()}
    assert got["it"] == pytest.approx(2 / 3, abs=1e-6) and got["en"] == 0.5


def test_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_entity_names(spark):
    from gleaner.functions.html import unescape

    text = "caf&eacute; &ndash; &copy;2020 &amp;lt; &lt;b&gt; &#233;&#xe9; &nosuch; &AMP; a&b &notin; R&D; &"
    got = spark.createDataFrame([(text,)], "t string").select(unescape(F.col("t"))).first()[0]
    assert got == "café – ©2020 &lt; <b> éé &nosuch; & a&b ∉ R&D; &"


def test_repeated_page_ids_do_not_multiply(spark):
    from gleaner.plans.curate import curate_pages

    body = "<html lang=en><body><p>" + "the cat and the dog are in the house and the garden is on the hill " * 6 + "{}</p></body></html>"
    pages = [("http://a.example/1", "w1", "s", body.format("one"), "f"), ("http://b.example/2", "w1", "s", body.format("two"), "f")]
    df = spark.createDataFrame(pages, "url string, warc_id string, source_id string, content string, file_name string")
    stops = spark.createDataFrame([("en", w) for w in ("the", "and", "in", "is", "on", "are")], "lang string, word string")
    model = langid.train_language_model(spark.createDataFrame([("the cat and the dog", "en"), ("der hund", "de")], "text string, lang string"))
    listed = spark.createDataFrame([("b.example",)], "domain string")
    assert [r.url for r in curate_pages(df, stops, model, listed).collect()] == ["http://a.example/1"]


HELPERS = ["host", "rows", "listed_domain", "_gone", "_host", "_rows", "_url", "_listed", "_salt", "_hot", "_times", "_n", "_lang", "_stops", "_made"]


def test_columns_called_like_helpers(spark):
    from gleaner.operators import layout

    docs = spark.createDataFrame([(1, "http://a.example/x", "t"), (2, "http://b.example/y", "t"), (3, None, "t")], "warc_id long, url string, text string")
    docs = docs.withColumns({c: F.lit("mine") for c in HELPERS})
    listed = spark.createDataFrame([("b.example",)], "domain string")
    urls = spark.createDataFrame([("http://a.example/x",)], "url string")
    kept, removed = urlpii.url_pii_stage(docs, listed)
    here, gone = layout.kept_and_removed(docs, docs.filter("warc_id = 2"), "warc_id")
    frames = {
        "filter": (urlpii.robots_filter(docs, listed), [1, 3]),
        "removed": (urlpii.robots_removed(docs, listed), [2]),
        "lists": (urlpii.extra_blocklists(docs, listed, urls), [3]),
        "kept side": (kept, [1, 3]),
        "removed side": (removed, [2]),
        "here": (here, [1, 3]),
        "gone": (gone, [2]),
        "limit": (layout.record_limit(docs, 2, "text", "warc_id"), [1, 2]),
    }
    for name, (df, ids) in frames.items():
        rows = df.collect()
        assert sorted(r.warc_id for r in rows) == ids, name
        assert all(r[c] == "mine" for r in rows for c in HELPERS), name


def test_language_model_in_a_join(spark):
    """A model that isn't sent gives the same scores: short, empty and missing texts, unseen trigrams, ties."""
    docs = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("le chat et le chien", "fr")], "text string, lang string")
    model = langid.train_language_model(docs)
    given = spark.createDataFrame([(1, None), (2, "the dog"), (3, ""), (4, "xx"), (5, "ZZZ qqq"), (6, "die Katze et"), (2, "the dog")], "id long, text string")
    sent = sorted(map(str, langid.lang_id(given, model).collect()))
    assert sorted(map(str, langid.lang_id(given, model, max_rows=0).collect())) == sent


def test_salts_grow_with_the_rows_of_a_key(spark):
    from gleaner.operators.skew import spread_join

    rows = spark.range(5000).select((F.col("id") % 5 == 0).cast("int").alias("k"), "id")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.max("id").alias("top"))
    out = spread_join(rows, groups, "k", "size", spread_by="id", hot_rows=100, salts=2)
    assert out.count() == 5000 and out.columns == ["k", "id", "top"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_times" in plan
