"""Main text of web pages: paragraphs told apart by stop words, links and neighbours.

After the published boilerplate-removal method of Pomikálek (2011). A page is one row:
its paragraphs are an array of that row, so its text isn't shuffled. What the neighbours of a
paragraph decide is folded over one letter per paragraph.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gleaner.functions.html import block_pieces, drop_hidden, html_language, link_chars, plain_text
from gleaner.functions.names import column, fresh
from gleaner.functions.text import let
from gleaner.operators.skew import first_per_group

# Thresholds and the size of the stop lists.
LENGTH_LOW = 70
LENGTH_HIGH = 200
STOP_LOW = 0.30
STOP_HIGH = 0.32
MAX_LINK_DENSITY = 0.2
STOP_WORDS_PER_LANGUAGE = 50
WORD = r"[^ \t\n\r\f.,;:!?()\[\]\"]+"


def page_paragraphs(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(key, lang, para_no, tag, text, link_chars)``; pieces without text are left out, so numbers may skip."""
    # Step by step, so that each pattern runs once over a page or piece.
    visible = pages.select(key, html_language(F.col(html)).alias("lang"), drop_hidden(F.col(html)).alias("_visible"))
    pieces, tags = block_pieces(F.col("_visible"))
    zipped = F.arrays_zip(pieces.alias("piece"), tags.alias("tag"))
    rows = visible.select(key, "lang", F.posexplode(zipped).alias("para_no", "_p"))
    # A one-element array that is filtered and exploded computes the text once; a plain filter would do so twice.
    text = F.filter(F.array(plain_text(F.col("_p.piece"))), lambda t: t != "")
    filled = rows.select(key, "lang", "para_no", "_p", F.explode(text).alias("text"))
    return filled.select(key, "lang", "para_no", "_p.tag", "text", link_chars(F.col("_p.piece")).alias("link_chars"))


def stopword_table(
    docs: DataFrame, top: int = STOP_WORDS_PER_LANGUAGE, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``(lang, word, doc_freq)``: the words found in most documents of each language."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), 0))
    counts = (
        docs.select(F.lower(F.col(lang)).alias("lang"), F.explode(words).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("doc_freq"))
    )
    return first_per_group(counts, "lang", [F.desc("doc_freq"), "word"], top, spread_by="word")


def _between_blanks(words: Column) -> Column:
    """The words as one text; no word that is looked up holds a blank, so it is found with the blanks around it."""
    single = F.filter(words, lambda w: ~F.contains(w, F.lit(" ")))
    return F.concat(F.lit(" "), F.array_join(single, " "), F.lit(" "))


def _with_stops(df: DataFrame, stopwords: DataFrame, lang: Column, out: str) -> DataFrame:
    """Add ``out``: the words of the row's language, or of all languages where it has no list, each between blanks.

    What is broadcast is one row, with a fixed number of words per language.
    """
    lists = stopwords.groupBy("lang").agg(F.collect_set("word").alias("words"))
    by_lang, every = f"{out}_by_lang", f"{out}_every"
    one = lists.agg(
        F.map_from_entries(F.collect_list(F.struct("lang", _between_blanks(F.col("words"))))).alias(by_lang),
        _between_blanks(F.array_distinct(F.flatten(F.collect_list("words")))).alias(every),
    )
    joined = df.join(F.broadcast(one), how="left")
    return joined.withColumn(out, F.coalesce(F.element_at(F.col(by_lang), lang), F.col(every))).drop(by_lang, every)


def _stop_density(text: Column, stops: Column) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)
    # One search in the text of stop words; an array of them would be walked word by word inside the lambda.
    found = lambda w: F.size(F.coalesce(F.filter(w, lambda x: F.contains(stops, F.concat(F.lit(" "), x, F.lit(" ")))), F.array()))
    share = let(words, lambda w: F.try_divide(found(w).cast("double"), F.size(w)))
    return F.round(F.coalesce(share, F.lit(0.0)), 6)


def _link_density(links: Column, text: Column) -> Column:
    return F.round(links.cast("double") / F.length(text), 6)


def paragraph_features(paragraph_rows: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Add ``length``, ``stop_density``, ``link_density``.

    The stop list is one row per language with a fixed number of words, so it is
    broadcast. A language without one gets the words of all.
    """
    stops = fresh(paragraph_rows, "_stops")
    return _with_stops(paragraph_rows, stopwords, F.col("lang"), stops).withColumns(
        {
            "length": F.length("text"),
            "stop_density": _stop_density(F.col("text"), F.col(stops)),
            "link_density": _link_density(F.col("link_chars"), F.col("text")),
        }
    ).drop(stops)


def _class(length: Column, links: Column, stop_density: Column, link_density: Column) -> Column:
    return (
        F.when(link_density > MAX_LINK_DENSITY, "bad")
        .when(length < LENGTH_LOW, F.when(links > 0, "bad").otherwise("short"))
        .when(stop_density >= STOP_HIGH, F.when(length > LENGTH_HIGH, "good").otherwise("neargood"))
        .when(stop_density >= STOP_LOW, "neargood")
        .otherwise("bad")
    )


def paragraph_class(features: DataFrame) -> DataFrame:
    """Add ``cls`` from the paragraph alone: good, neargood, short or bad."""
    return features.withColumn("cls", _class(*[F.col(c) for c in ("length", "link_chars", "stop_density", "link_density")]))


def settle(classes: str) -> str:
    """Classes by their first letters, short (s) and neargood (n) ones decided by their neighbours.

    Two folds, forward and backward, each linear in the page; its edges count as bad. A
    short paragraph takes the class of the decided ones around it; where they differ it is good
    only if a neargood one stands between it and the bad side. A neargood one is bad
    only between bad ones.
    """
    n = len(classes)

    def nearest(letters: str, kinds: str, backward: bool) -> list[str]:
        out, last = ["b"] * n, "b"
        for i in range(n - 1, -1, -1) if backward else range(n):
            out[i] = last
            if letters[i] in kinds:
                last = letters[i]
        return out

    before, before_any = nearest(classes, "gb", False), nearest(classes, "gbn", False)
    after, after_any = nearest(classes, "gb", True), nearest(classes, "gbn", True)
    first = []
    for c, p, pa, q, qa in zip(classes, before, before_any, after, after_any):
        if c == "s":
            lifted = (p == "b" and pa == "n") or (q == "b" and qa == "n")
            c = p if p == q else "g" if lifted else "b"
        first.append(c)
    decided = "".join(first)
    before, after = nearest(decided, "gb", False), nearest(decided, "gb", True)
    return "".join("b" if c == "n" and p == q == "b" else "g" if c == "n" else c for c, p, q in zip(decided, before, after))


@F.pandas_udf(T.StringType())
def _settled(classes: pd.Series) -> pd.Series:
    """Only these letters go to Python: a running value over an array has no linear built-in form."""
    return classes.map(lambda c: None if c is None else settle(c))


def with_paragraphs(pages: DataFrame, stopwords: DataFrame, html: str = "html", out: str = "paragraphs") -> DataFrame:
    """Add ``out``: a struct of the page's ``lang`` and its ``items``, the paragraphs in order, with
    ``para_no, tag, text, link_chars, length, stop_density, link_density, cls, final``.

    No row moves. Pieces without text are left out, so numbers may skip; a page without html has none.
    """
    lang, made, letters = (fresh(pages, n) for n in ("_lang", "_made", "_letters"))
    stops = fresh(pages, "_stops")
    read = _with_stops(pages.withColumn(lang, html_language(column(html))), stopwords, F.col(lang), stops)

    def pieces(visible: Column) -> Column:
        parts, tags = block_pieces(visible)
        return F.zip_with(parts, tags, lambda p, t: F.struct(p.alias("piece"), t.alias("tag")))

    # Step by step, so that each pattern runs once over a page or piece.
    numbered = F.transform(
        let(drop_hidden(column(html)), pieces),
        lambda p, i: F.struct(i.alias("para_no"), p["tag"].alias("tag"), plain_text(p["piece"]).alias("text"), p["piece"].alias("piece")),
    )
    filled = F.filter(numbered, lambda p: p["text"] != "")
    counted = F.transform(
        filled,
        lambda p: F.struct(
            p["para_no"].alias("para_no"), p["tag"].alias("tag"), p["text"].alias("text"), link_chars(p["piece"]).alias("link_chars"),
            F.length(p["text"]).alias("length"), _stop_density(p["text"], F.col(stops)).alias("stop_density"),
        ),
    )
    linked = F.transform(counted, lambda p: p.withField("link_density", _link_density(p["link_chars"], p["text"])))
    classed = F.transform(
        linked, lambda p: p.withField("cls", _class(p["length"], p["link_chars"], p["stop_density"], p["link_density"]))
    )
    told = read.withColumn(made, classed).withColumn(
        letters, _settled(F.array_join(F.transform(F.col(f"{made}.cls"), lambda c: F.substring(c, 1, 1)), ""))
    )
    name = lambda c: F.when(c == "g", "good").otherwise("bad")
    items = F.transform(F.col(made), lambda p, i: p.withField("final", name(F.substring(F.col(letters), i + 1, F.lit(1)))))
    struct = F.struct(F.col(lang).alias("lang"), items.alias("items")).alias(out)
    return told.select(*[column(c) for c in pages.columns if c != out], struct)


def paragraph_context(pages: DataFrame, stopwords: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per paragraph with its features, ``cls``, and ``final``: short and neargood ones decided by their neighbours."""
    rows = with_paragraphs(pages.select(key, html), stopwords, html, "_paragraphs")
    return rows.select(key, F.col("_paragraphs.lang").alias("lang"), F.explode("_paragraphs.items").alias("p")).select(key, "lang", "p.*")


def with_main_text(pages: DataFrame, stopwords: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Replace ``html`` by ``out``: the good paragraphs of each page in order. Pages left empty are dropped; no row moves."""
    held = fresh(pages, "_paragraphs")
    rows = with_paragraphs(pages, stopwords, html, held)
    good = F.filter(F.col(f"{held}.items"), lambda p: p["final"] == "good")
    text = F.array_join(F.transform(good, lambda p: p["text"]), "\n")
    return rows.select(*[column(c) for c in pages.columns if c not in (html, out)], text.alias(out)).filter(column(out) != "")


def extract_text(pages: DataFrame, stopwords: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(key, text)``: the good paragraphs of each page in order; pages left empty are dropped."""
    return with_main_text(pages.select(key, html), stopwords, html)
