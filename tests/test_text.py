import pytest
from pyspark.sql import functions as F

from gleaner.functions import html, markdown, pii, unicode, urls
from gleaner.functions.text import ngrams
from gleaner.operators import extract, filters, urlpii


def value(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("at 10.0.0.1.", "at [IP]."),
        ("1.2.3.4 5.6.7.8,9.9.9.9", "[IP] [IP],[IP]"),
        ("version 1.2.3.4.5 and 256.1.1.1 and 1.2.3.4567", "version 1.2.3.4.5 and 256.1.1.1 and 1.2.3.4567"),
        ("see 2001:0db8:0:0:0:0:0:1 there", "see [IP] there"),
        ("1:2:3:4:5:6:7:8:9 12:30:45", "1:2:3:4:5:6:7:8:9 12:30:45"),
        ("::1, 2001:db8::1; fe80::1%eth0 [::2]", "[IP], [IP]; [IP]%eth0 [[IP]]"),
        ("1:2:3:4:5:6:7:: ::2:3:4:5:6:7:8 1:2:3::6:7:8", "[IP] [IP] [IP]"),
        ("std::abs A::B :: 1::2::3 1:2:3:4::5:6:7:8 x1::2 12345::1", "std::abs A::B :: 1::2::3 1:2:3:4::5:6:7:8 x1::2 12345::1"),
    ],
)
def test_ips(spark, text, expected):
    assert value(spark, text, pii.redact_ips) == expected
    assert value(spark, text, pii.count_ips) == expected.count("[IP]")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("DE89370400440532013000.", "[IBAN]."),
        ("xDE89370400440532013000", "xDE89370400440532013000"),
        ("DE88370400440532013000 GB82WEST12345698765432", "DE88370400440532013000 [IBAN]"),
        ("none", "none"),
        ("GB82 WEST 1234 5698 7654 32, NO93 8601 1117 947.", "[IBAN], [IBAN]."),
        ("AT61 1904 3002 3457 3201 2024 OK", "[IBAN] 2024 OK"),
        ("AT62 1904 3002 3457 3201 and xAT61 1904 3002 3457 3201", "AT62 1904 3002 3457 3201 and xAT61 1904 3002 3457 3201"),
        ("DE89 3704 0044 0532 0130 00 DE89370400440532013000", "[IBAN] [IBAN]"),
    ],
)
def test_ibans(spark, text, expected):
    assert value(spark, text, pii.redact_ibans) == expected
    assert value(spark, text, pii.count_ibans) == expected.count("[IBAN]")


def test_null_text_stays_null_and_counts_nothing(spark):
    out = urlpii.redact_pii(spark.createDataFrame([(None,), ("a@b.org",)], "text string")).collect()
    assert [tuple(r) for r in out] == [(None, 0), ("[EMAIL]", 1)]


@pytest.mark.parametrize(
    "url, host",
    [
        ("HTTP://User:pw@Www.Example.COM:8080/a?b#c", "www.example.com"),
        ("https://example.org.", "example.org"),
        ("https://[::1]:80/x", "[::1]"),
        ("not a url", None),
        (None, None),
    ],
)
def test_hosts(spark, url, host):
    assert value(spark, url, urls.url_host) == host


def test_domain_filter_matches_parents_only_at_dots(spark):
    rows = [("1", "https://a.b.org/"), ("2", "https://xb.org/"), ("3", "https://b.org"), ("4", None), ("5", "https://org/")]
    docs = spark.createDataFrame([(*r, "mail me@x.org") for r in rows], "warc_id string, url string, text string")
    domains = urlpii.domain_table(spark.createDataFrame([(" b.org ",), ("",), ("b.org",)], "value string"))
    kept, removed = urlpii.url_pii_stage(docs, domains)
    assert sorted(r["warc_id"] for r in kept.collect()) == ["2", "4", "5"]
    assert kept.columns == [*docs.columns, "pii_count"]
    raw = removed.collect()
    assert sorted(r["warc_id"] for r in raw) == ["1", "3"]
    assert removed.columns == docs.columns and all(r["text"] == "mail me@x.org" for r in raw)


def test_hot_host_is_salted_when_the_list_is_large(spark):
    from gleaner.operators.skew import lookup

    docs = spark.createDataFrame([(i, "hot" if i % 3 else f"h{i}") for i in range(300)], "id bigint, host string")
    table = docs.groupBy("host").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("low"))
    broadcast = lookup(docs, table, "host", "id", "rows")
    salted = lookup(docs, table, "host", "id", "rows", max_bytes=0, hot_rows=50, salts=7)
    assert sorted(map(tuple, broadcast.select("id", "host", "low").collect())) == sorted(map(tuple, salted.select("id", "host", "low").collect()))
    left = lookup(docs, table.filter("host <> 'hot'"), "host", "id", "rows", how="left", max_bytes=0, hot_rows=0, salts=7)
    assert left.count() == 300 and left.filter("low IS NULL").count() == 200


def test_hot_unlisted_hosts_are_in_the_lookup_table(spark):
    rows = [(str(i), None if i % 3 == 0 else "https://big.org/x" if i % 3 == 1 else f"https://h{i}.net/") for i in range(90)]
    docs = spark.createDataFrame(rows, "warc_id string, url string")
    domains = spark.createDataFrame([("h2.net",)], "domain string")
    table = urlpii.listed_hosts(docs, domains, hot_rows=20)
    assert sorted(map(tuple, table.collect()), key=str) == [("", 30, None), ("big.org", 30, None), ("h2.net", 1, "h2.net")]


def test_missing_domain_list_is_an_error(spark):
    with pytest.raises(Exception):
        urlpii.load_domain_list(spark, "/no/such/list").count()


@pytest.mark.parametrize(
    "fragment, text",
    [
        ("a&amp;lt;b &#65;&#x42; &nbsp; c", "a&lt;b AB c"),
        ("&#38;amp; &#38;lt; &amp;#65; &lt;p&gt;", "&amp; &lt; &#65; <p>"),
        ("x<br/>y<b>z</b> &unknown; & &#0; &#xD800;", "x yz &unknown; & &#0; &#xD800;"),
        ("&#128512;", "😀"),
    ],
)
def test_plain_text(spark, fragment, text):
    assert value(spark, fragment, html.plain_text) == text


def test_paragraphs(spark):
    page = (
        "<html lang=fr><head><title>t</title></head><body><!-- <p>no</p> --><script>var a='<p>';</script>"
        "<P class=x>One <a href='/'>li&amp;nk</a></P><div></div>two<br>three<p>four"
    )
    df = spark.createDataFrame([(1, page)], "page_id bigint, html string")
    rows = [(r["lang"], r["tag"], r["text"], r["link_chars"]) for r in extract.page_paragraphs(df).orderBy("para_no").collect()]
    assert rows == [("fr", "p", "One li&nk", 5), ("fr", "div", "two three", 0), ("fr", "p", "four", 0)]


@pytest.mark.parametrize(
    "classes, final",
    [
        (["short"], ["bad"]),
        (["good", "short", "good"], ["good", "good", "good"]),
        (["bad", "short", "bad"], ["bad", "bad", "bad"]),
        (["bad", "short", "good"], ["bad", "bad", "good"]),
        (["bad", "neargood", "short", "good"], ["bad", "good", "good", "good"]),
        (["bad", "neargood", "bad"], ["bad", "bad", "bad"]),
        (["good", "neargood", "bad"], ["good", "good", "bad"]),
    ],
)
def test_context(classes, final):
    assert extract.settle("".join(c[0] for c in classes)) == "".join(f[0] for f in final)


def test_context_of_long_pages_is_linear():
    """A page of a million short paragraphs between a bad and a good one."""
    page = "b" + "s" * 500_000 + "n" + "s" * 500_000 + "g"
    assert extract.settle(page) == "b" + "b" * 500_000 + "g" + "g" * 500_000 + "g"


def test_extraction_moves_no_text(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>", "k")], "page_id bigint, html string, paragraphs string")
    stops = spark.createDataFrame([("en", "the")], "lang string, word string")
    for df in (extract.with_main_text(pages, stops), extract.with_paragraphs(pages, stops)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression" not in plan and "Window" not in plan
        assert "page_id" not in " ".join(line for line in plan.splitlines() if "Aggregate" in line)


@pytest.mark.parametrize(
    "text, clean",
    [
        ("d\u00c3\u00a9j\u00c3\u00a0 vu", "déjà vu"),
        ("café Ã", "café Ã"),
        ("a\r\nb\rc\x00\x07d​e", "a\nb\ncde"),
        ("“q” ‘s’ ﬁx", "\"q\" 's' fix"),
        ("€ Ã©", "€ Ã©"),
    ],
)
def test_unicode(spark, text, clean):
    assert value(spark, text, unicode.unicode_cleanup) == clean


def test_ngrams_go_by_code_point(spark):
    assert value(spark, "a😀bc", lambda c: ngrams(c, 3)) == ["a😀b", "😀bc"]
    assert value(spark, "ab", lambda c: ngrams(c, 3)) == []


@pytest.mark.parametrize("targets, kept", [(["en"], ["EN"]), (None, ["EN", "DE", "en"]), (["xx"], [])])
def test_language_filter(spark, targets, kept):
    df = spark.createDataFrame([("EN",), ("DE",), ("en",)], "language string")
    assert sorted(r[0] for r in filters.language_filter(df, targets).collect()) == sorted(kept)


def test_language_field(spark):
    df = spark.createDataFrame([("[0.95, 'EN']",), ("[1.0E-4, 'DE']",), ("broken",)], "language string")
    assert [r[0] for r in df.select(filters.language_score(F.col("language"))).collect()] == [0.95, 1e-4, None]
    assert [r[0] for r in filters.parse_language(df).collect()] == ["EN", "DE", ""]


def test_markdown_and_lines(spark):
    dressed = "# Head\n**bold** and *it* `code` [t](u) __b__\n---\n* item one * two"
    assert value(spark, dressed, markdown.strip_markdown) == "Head\nbold and it code t b\n\n* item one * two"
    assert value(spark, '"a "b" c"', markdown.strip_quotes) == 'a "b" c'
    assert value(spark, '"open', markdown.strip_quotes) == '"open'
    assert value(spark, "x\n Passage: \nPassage 1: y", lambda c: markdown.remove_lines(c, markdown.PASSAGE_LINES)) == "x\nPassage 1: y"
    assert value(spark, "intro\n - a\n•  b\n1. c", markdown.bulleted_lines) == "a\nb"
    assert value(spark, "a L b R c", lambda c: markdown.slice_after(c, "L", "R")) == "b"
    assert value(spark, " no mark ", lambda c: markdown.slice_after(c, "L")) == "no mark"
    pairs = value(spark, "x\nQuestion: a?\nAnswer: b\nQuestion: c?\nQuestion:\nAnswer: d", markdown.question_answer_pairs)
    assert pairs == ["Question: a?\nAnswer: b"]
    with pytest.raises(ValueError):
        markdown.has_substring(F.lit("x"), "x", "middle")


def test_trigrams_are_counted_without_a_row_a_character(spark):
    from collections import Counter

    from gleaner.operators.langid import trigram_counts

    rows = [("en", "Abab aB"), ("en", "ab"), ("en", ""), ("en", "a😀bc"), ("de", "ÄÖÜ\x00ß"), ("de", None), (None, "abc"), ("en", "x"), ("en", "yz")]
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    low = [(lang, text.lower()) for lang, text in rows if text is not None]
    expected = Counter((lang, t[i : i + 3]) for lang, t in low for i in range(len(t) - 2))
    counts = trigram_counts(df)
    assert {(r.lang, r.gram): r.n for r in counts.collect()} == expected
    assert "Generate" not in counts._jdf.queryExecution().toString()


def test_stop_words_are_searched_as_one_text(spark):
    from gleaner.operators import extract

    stops = spark.createDataFrame([("en", "the"), ("en", "of"), ("en", "a b"), ("de", "und")], "lang string, word string")
    page = "<html lang='{}'><p>The  cat\tof the&amp;the &lt;of&gt; a<br>b und<p>x"
    pages = spark.createDataFrame([(1, page.format("en")), (2, page.format("fr")), (3, None)], "page_id bigint, html string")
    rows = extract.paragraph_context(pages, stops)
    found = {(r.page_id, r.text): r.stop_density for r in rows.collect()}
    text = "The cat of the&the <of> a b und"
    assert found == {(1, text): 0.25, (1, "x"): 0.0, (2, text): 0.375, (2, "x"): 0.0}
    assert "array_contains" not in rows._jdf.queryExecution().toString()


@pytest.mark.parametrize("texts", [["a"], ["", "ab"], [None], ["ab", "abc"]])
def test_languages_of_short_texts_have_no_trigrams(spark, texts):
    """A batch in which a language has no trigram gives no rows, where it ended the query."""
    from gleaner.operators.langid import train_language_model, trigram_counts

    df = spark.createDataFrame([("xx", t) for t in texts], "lang string, text string").repartition(1)
    assert sorted(map(tuple, trigram_counts(df).collect())) == [("xx", "abc", 1) for t in texts if t == "abc"]
    long = spark.createDataFrame([("en", "abcd")], "lang string, text string")
    model = train_language_model(df.unionByName(long).repartition(1))
    assert {r.lang for r in model.collect()} >= {"en"}
