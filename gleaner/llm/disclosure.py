"""Personal data: patterns, and terms that give protected entities away.

Patterns find e-mail addresses, IP addresses, card and phone numbers with their places.
The corpus then shows which words share their texts with an entity so often, and stand
elsewhere so seldom, that they reveal it: from the number of distinct texts with both, with
the term, with the entity and in all follow the chance of the entity given the term and the
log-likelihood ratio against the entity's share of all texts. Terms above the thresholds
are generalised or removed. All of it is made of built-in expressions and joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from gleaner.llm.text import bound, column, fresh, whole, words
from gleaner.operators.skew import lookup
from gleaner.session import store

#: Kinds in the order of the result. The patterns give the leftmost, longest matches of
#: the plain ones; they start only where a run starts and never backtrack into one, so
#: they take linear time and no deep recursion on texts of any length.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a search to make sense.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

#: Distinct texts that must show term and entity together.
SUPPORT = 3
#: Least log-likelihood ratio of the chance against the entity's share of all texts. Words
#: without a bearing on the entity exceed it about once in a thousand.
LEAST_RATIO = 10.83
#: Chance of the entity given the term from which the term is generalised, and removed.
GENERALISE = 0.5
REMOVE = 0.8
#: Entities of a text up to which it is paired with all its terms at once, and the pairs a
#: task makes of a text with more.
LIGHT = 64
TASK_PAIRS = 1_000_000
#: A term is any word with a letter or digit.
TERM = r"[\p{L}\p{N}]"

_BLOCK = 256
_PIECE = 1024
_SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
_ORDERED = "array<struct<start:int,end:int,kind:string>>"


def placed(text: Column, pattern: str, kind: str) -> Column:
    """All matches with their places in code points.

    The gaps between matches and the matches together make up the text, so places
    are running sums of lengths; they are summed within blocks, then over blocks.
    """
    steps = F.filter(
        F.zip_with(
            F.split(text, pattern, -1),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda gap, v: F.struct(F.length(gap).alias("gap"), F.length(v).alias("size"), v.alias("value")),
        ),
        lambda s: s["value"].isNotNull(),
    )
    add = lambda total, s: total + s["gap"] + s["size"]

    def offsets(s: Column, block: Column) -> Column:
        """Characters before each block."""
        blocks = F.sequence(F.lit(0), F.floor((F.size(s) - 1) / block).cast("int"))
        sums = F.transform(blocks, lambda b: F.aggregate(F.slice(s, b * block + 1, block), F.lit(0), add))
        return F.aggregate(sums, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def place(s: Column, block: Column, before: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            b = F.floor(i / block).cast("int")
            start = F.get(before, b) + F.aggregate(F.slice(s, b * block + 1, i - b * block), F.lit(0), add) + x["gap"]
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["size"]).alias("end"), x["value"].alias("value"))

        return F.transform(s, one)

    none = F.array().cast(_SPAN)
    # A block of the root of their number costs least.
    size = lambda s: F.least(F.ceil(F.sqrt(F.size(s))), F.lit(_BLOCK)).cast("int")
    in_blocks = lambda s: bound(size(s), lambda n: bound(offsets(s, n), lambda before: place(s, n, before)))
    return bound(steps, lambda s: F.when(F.size(s) > 0, in_blocks(s)).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        n = F.length(_digits(value))

        def luhn(digits: Column) -> Column:
            doubled = F.transform(F.reverse(F.split(digits, "")), lambda d, i: d.try_cast("int") * (1 + i % 2))
            return F.aggregate(doubled, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0

        return F.when((n >= 13) & (n <= 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _checked(kind: str):
    return lambda s: _valid(kind, s["value"])


def base_spans(text: Column) -> Column:
    """Spans of all kinds, by kind as listed, then by place; matches that aren't valid are dropped."""
    none = F.array().cast(_SPAN)
    found = []
    for kind, pattern in PATTERNS.items():
        spans = F.filter(placed(text, pattern, kind), _checked(kind))
        found.append(F.when(F.regexp_like(text, F.lit(HINTS[kind])), spans).otherwise(none))
    return F.concat(*found)


def term_of(word: Column) -> Column:
    """The word in small letters without marks around it."""
    return F.lower(F.btrim(word, F.lit(".,;:!?\"'()[]{}<>*")))


def in_order(spans: Column) -> Column:
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))


def _apart(spans: Column) -> Column:
    """The spans in order but for those that begin within a kept one before them.

    They are kept in blocks of the root of their number, as adding to an array copies it.
    """
    none = F.array().cast(_ORDERED)

    def keep(state: Column, s: Column) -> Column:
        more = F.struct(s["end"].alias("at"), F.concat(state["kept"], F.array(s)).alias("kept"))
        return F.when(s["start"] >= state["at"], more).otherwise(state)

    def in_blocks(all_spans: Column, n: Column) -> Column:
        def block(state: Column, b: Column) -> Column:
            begin = F.struct(state["at"].alias("at"), none.alias("kept"))
            here = F.aggregate(F.slice(all_spans, b * n + 1, n), begin, keep)
            return bound(here, lambda x: F.struct(x["at"].alias("at"), F.concat(state["kept"], F.array(x["kept"])).alias("kept")))

        begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_ORDERED}>").alias("kept"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(all_spans) - 1) / n).cast("int"))
        return F.aggregate(blocks, begin, block, lambda state: F.flatten(state["kept"]))

    root = lambda s: F.ceil(F.sqrt(F.size(s))).cast("int")
    return bound(spans, lambda s: F.when(F.size(s) > 0, bound(root(s), lambda n: in_blocks(s, n))).when(s.isNotNull(), none))


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """The text with marks for spans in order; of overlapping ones the first counts. Null for null spans.

    A place in a long string is found by walking to it, so the text is cut into pieces first:
    the time is linear in the text and the spans.
    """

    def between(pieces: Column, low: Column, high: Column) -> Column:
        first, last = F.floor(low / _PIECE).cast("int"), F.floor((high - 1) / _PIECE).cast("int")
        here = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return F.when(high > low, F.substring(here, low - first * _PIECE + 1, high - low)).otherwise("")

    def built(kept: Column, pieces: Column) -> Column:
        lows = F.concat(F.array(F.lit(0)), F.transform(kept, lambda s: s["end"]))
        highs = F.concat(F.transform(kept, lambda s: s["start"]), F.array(F.length(text)))
        gaps = F.zip_with(lows, highs, lambda low, high: between(pieces, low, high))
        marks = F.concat(F.transform(kept, mark), F.array(F.lit("")))
        return F.array_join(F.flatten(F.zip_with(gaps, marks, lambda gap, m: F.array(gap, m))), "")

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))
    return bound(_apart(spans), lambda kept: bound(pieces, lambda cut: F.when(kept.isNotNull(), built(kept, cut))))


def terms_of(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.filter(F.transform(words(text), term_of), lambda t: F.regexp_like(t, F.lit(TERM))))


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, key, uid, base, entities, terms, inner``: base spans, and of texts with spans the distinct values and terms.

    A word that occurs only within spans is no term of its text but an ``inner`` one.
    Mail and IP addresses lie within a word, cards and phone numbers may take several.
    """
    texts = docs.select(column(id_col).alias("doc_id"), whole(column(text_col)).alias("text"))
    found = texts.select("doc_id", "text", F.md5("text").alias("key"), base_spans(F.col("text")).alias("base"))
    value = lambda s: F.lower(s["value"])
    single = F.transform(F.filter("base", lambda s: s["kind"].isin("email", "ip")), value)
    several = F.filter("base", lambda s: s["kind"].isin("card", "phone"))
    # The mark is no blank, so what is stuck to a number doesn't become a word.
    apart = F.when(F.size(several) > 0, replaced(F.col("text"), in_order(several), lambda s: F.lit("\ue000"))).otherwise(F.col("text"))
    held = F.size("base") > 0
    found = found.withColumn("every", F.when(held, terms_of(F.col("text")))).withColumn("terms", F.when(held, F.array_except(terms_of(apart), single)))
    return store(
        found.select(
            "doc_id", "key", F.monotonically_increasing_id().alias("uid"), "base",
            F.when(held, F.array_distinct(F.transform("base", value))).alias("entities"),
            "terms", F.array_except("every", "terms").alias("inner"),
        ),
        "spans",
    )


def _classes(texts: DataFrame, items: str, name: str, n: str) -> DataFrame:
    """``name, n, same``: the items of SUPPORT texts and more, the texts of each, and the least item in just the same texts.

    Items in the same texts have all counts in common, so one of them is counted for all.
    Sets of distinct texts are the same if their size and 128 bits of their hashes are.
    """
    said = texts.select("key", F.explode(items).alias(name))
    bits = [F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"set{i}") for i in (0, 1)]
    counts = store(said.groupBy(name).agg(F.count(F.lit(1)).alias(n), *bits).filter(F.col(n) >= SUPPORT), f"{name}-counts")
    least = counts.groupBy(n, "set0", "set1").agg(F.min(name).alias("same"))
    return store(counts.join(least, [n, "set0", "set1"]).select(name, n, "same"), f"{name}-classes")


def _distinct(rows: DataFrame) -> DataFrame:
    """One row of each text with spans."""
    held = rows.filter("size(base) > 0").select("key", "uid", "entities", "terms", "inner")
    first = store(held.groupBy("key").agg(F.min("uid").alias("uid")).select("uid"), "first")
    return store(lookup(held, first, "uid", spread_by="key"), "texts")


def _need() -> Column:
    """Texts that a term must share with an entity."""
    return F.greatest(F.lit(SUPPORT), F.ceil(F.col("n_w") * GENERALISE))


def _pairs(terms: DataFrame, entities: DataFrame) -> DataFrame:
    """``term, entity, n_w, n_e, n_te``: pairs of the light texts whose entity is in enough texts for the term."""
    said = terms.filter(~F.col("heavy")).drop("heavy", "spread").join(entities.filter(~F.col("heavy")).drop("heavy", "spread"), "uid")
    return said.filter(_need() <= F.col("n_e")).groupBy("term", "entity", "n_w", "n_e").agg(F.count(F.lit(1)).alias("n_te"))


def _with_heavy(light: DataFrame, terms: DataFrame, entities: DataFrame) -> DataFrame:
    """``light`` with the heavy texts counted, and the pairs that occur in enough heavy texts and in no light one.

    A pair seen in a light text is looked up in the heavy texts of its term. A pair never
    seen in one needs a term and an entity that both are in enough heavy texts, so what a
    directory shares with light texts alone is never multiplied there. The pairs of one
    heavy text are made in as many tasks as their number asks for.
    """
    light = store(light, "light-pairs")
    terms, entities = store(terms.filter("heavy").drop("heavy"), "heavy-terms"), store(entities.filter("heavy").drop("heavy"), "heavy-entities")
    h_w = terms.groupBy("term").agg(F.count(F.lit(1)).alias("h_w"))
    h_e = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("h_e"))
    open_pairs = light.join(h_w, "term").join(h_e, "entity").filter(F.col("n_te") + F.least("h_w", "h_e") >= _need())
    again = open_pairs.select("term", "entity").join(terms.select("term", "uid"), "term").join(entities.select("entity", "uid"), ["entity", "uid"])
    more = again.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("more"))
    total = F.col("n_te") + F.coalesce("more", F.lit(0))
    seen = light.join(more, ["term", "entity"], "left").select("term", "entity", "n_w", "n_e", total.alias("n_te"))

    dealt = terms.join(h_w, "term").filter(F.col("h_w") >= _need()).withColumn("salt", F.pmod(F.xxhash64("term"), F.col("spread")).cast("int"))
    often = entities.join(h_e, "entity").filter(F.col("h_e") >= SUPPORT).withColumn("salt", F.explode(F.sequence(F.lit(0), (F.col("spread") - 1).cast("int"))))
    made = dealt.drop("spread").join(often.drop("spread"), ["uid", "salt"]).filter(_need() <= F.col("h_e"))
    made = made.groupBy("term", "entity", "n_w", "n_e").agg(F.count(F.lit(1)).alias("n_te")).filter(F.col("n_te") >= _need())
    return seen.unionByName(made.join(light, ["term", "entity"], "left_anti"))


def _likely(texts: DataFrame) -> DataFrame:
    """``term, n_te, n_e``: terms that may reveal an entity, by the texts with entities alone.

    A term occurs in no fewer texts than in texts with entities. If it fails by that
    count it fails by the whole count. A pair is only made where the entity is in enough
    texts for the term: words more common than twice the entity are never paired with it.
    Texts with up to ``LIGHT`` entities give pairs in proportion to their terms; for the
    others see :func:`_with_heavy`.
    """
    entities = _classes(texts, "entities", "entity", "n_e")
    most = entities.agg(F.coalesce(F.max("n_e"), F.lit(0))).first()[0]
    terms = _classes(texts, "terms", "term", "n_w").filter(F.col("n_w") * GENERALISE <= most)
    sizes = F.size("terms").cast("bigint") * F.size("entities")
    weighed = texts.withColumns({"heavy": F.size("entities") > LIGHT, "spread": F.greatest(F.ceil(sizes / TASK_PAIRS), F.lit(1))})

    def chosen(items: str, name: str, table: DataFrame, n: str) -> DataFrame:
        """``uid, heavy, spread, name, n``: the items of each text that stand for their class."""
        said = weighed.select("uid", "heavy", "spread", F.explode(items).alias(name))
        return lookup(said, table.filter(F.col(name) == F.col("same")).select(name, n, F.col(n).alias("rows")), name, spread_by="uid", size_col="rows")

    said_terms, said_entities = chosen("terms", "term", terms, "n_w"), chosen("entities", "entity", entities, "n_e")
    pairs = _pairs(said_terms, said_entities)
    if not weighed.filter("heavy").isEmpty():
        pairs = _with_heavy(pairs, said_terms, said_entities)
    counts = pairs.filter(F.col("n_te") >= _need()).select(F.col("term").alias("same"), "n_te", "n_e").distinct()
    return terms.select("term", "same").join(counts, "same").drop("same")


def _salted(candidates: DataFrame) -> DataFrame:
    """Their terms, once each. How often a term occurs isn't known yet: beyond a broadcast all are salted."""
    return candidates.select("term").distinct().withColumn("rows", F.lit(1 << 40))


def _ratio(total: float) -> Column:
    """Log-likelihood ratio of term and entity, 0 where the term makes the entity no more likely.

    Unlike the mutual information it isn't bounded by the entity's rarity: it grows with the
    texts that bear it out, also for an entity in most of them and in a small table.
    """
    both, term, entity, every = F.col("n_te"), F.col("n_t"), F.col("n_e"), F.lit(total)

    def cell(seen: Column, row: Column, col: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * every / (row * col))).otherwise(0.0)

    cells = cell(both, term, entity) + cell(term - both, term, every - entity)
    cells += cell(entity - both, every - term, entity) + cell(every - term - entity + both, every - term, every - entity)
    return F.when(both * every > term * entity, 2 * cells).otherwise(0.0)


def revealing_terms(docs: DataFrame, rows: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """``(term, action)`` for the terms above the thresholds, and ``(key, term)`` of the texts that hold candidates.

    Copies of a text count once. A term is counted by whole texts, however far it stands
    from the entity. Only likely terms are searched in the whole corpus.
    """
    texts = _distinct(rows)
    candidates = store(_likely(texts), "candidates")
    if candidates.isEmpty():
        return candidates.select("term", F.lit("").alias("action")).limit(0), None
    text = whole(column(text_col))
    spoken = docs.select(F.md5(text).alias("key"), F.explode(F.array_distinct(F.transform(words(text), term_of))).alias("term"))
    hits = store(lookup(spoken, _salted(candidates), "term", spread_by="key", size_col="rows").distinct(), "hits")
    inner = texts.select(F.explode("inner").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_inner"))
    counts = hits.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(inner, "term", "left")
    counts = counts.select("term", (F.col("n_t") - F.coalesce("n_inner", F.lit(0))).alias("n_t"))
    total = rows.select("key").distinct().count()
    chance = F.col("n_te") / F.col("n_t")
    scored = candidates.join(counts, "term").filter((chance >= GENERALISE) & (_ratio(float(total)) >= LEAST_RATIO))
    actions = scored.groupBy("term").agg(F.when(F.max(chance) >= REMOVE, "remove").otherwise("generalise").alias("action"))
    return store(actions, "actions"), hits


def _term_spans(docs: DataFrame, actions: DataFrame, hits: DataFrame, text_col: str) -> DataFrame:
    """``(key, terms)``: places of the terms in each distinct text that holds one."""
    per_text = hits.join(actions.withColumn("one", F.lit(1)), "term").groupBy("key").agg(
        F.map_from_entries(F.collect_set(F.struct("term", "action"))).alias("actions")
    )
    texts = docs.select(whole(column(text_col)).alias("text")).withColumn("key", F.md5("text"))
    found = lookup(texts, per_text.withColumn("rows", F.lit(1 << 40)), "key", spread_by="text", size_col="rows").dropDuplicates(["key"])

    def lean(s: Column) -> Column:
        """The span without the marks around the term."""
        left = F.length(s["value"]) - F.length(F.ltrim(s["value"], F.lit(".,;:!?\"'()[]{}<>*")))
        size = F.length(term_of(s["value"]))
        action = F.element_at("actions", term_of(s["value"]))
        return F.struct(action.alias("kind"), (s["start"] + left).alias("start"), (s["start"] + left + size).alias("end"), term_of(s["value"]).alias("value"))

    word_spans = placed(F.col("text"), r"[^\x20\x09-\x0D]++", "term")
    terms = F.transform(F.filter(word_spans, lambda s: F.map_contains_key("actions", term_of(s["value"]))), lean)
    return found.select("key", terms.alias("terms"))


def span_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, terms`` for every document: arrays of ``(kind, start, end, value)``.

    Places count code points, ends are exclusive. ``terms`` holds the words that give an
    entity away, their kind being what is to be done: generalise or remove; words inside a
    base span aren't repeated. A null or empty text has no span; null ids and
    repeated rows keep their rows; an empty table gives an empty table; further
    columns are ignored.
    """
    rows = _found(docs, id_col, text_col)
    actions, hits = revealing_terms(docs, rows, text_col)
    none = F.array().cast(_SPAN)
    if hits is None or actions.isEmpty():
        return rows.select("doc_id", "key", "base", none.alias("terms"))
    rows = rows.select("doc_id", "key", "base")
    table = store(_term_spans(docs, actions, hits, text_col), "term-spans")
    sizes = lookup(rows.select("key"), table.select("key"), "key", spread_by="key").groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    joined = lookup(rows, table.join(sizes, "key"), "key", spread_by="doc_id", size_col="rows", how="left")
    apart = F.filter(
        F.coalesce("terms", none), lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    return joined.select("doc_id", "key", "base", apart.alias("terms"))


def _joined(spans: Column, kind: Column | None = None) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind if kind is not None else s["kind"], s["start"], s["end"])), ",")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: counts per kind, ``base_sha256`` and all ``spans``; see :func:`span_rows`."""
    rows = span_rows(docs, id_col, text_col)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    base = _joined(F.col("base"))
    every = F.array_join(F.filter(F.array(base, _joined(F.col("terms"), F.lit("term"))), lambda x: x != ""), ",")
    return rows.select("doc_id", *[count(k) for k in PATTERNS], F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "sanitised") -> DataFrame:
    """``docs`` with a column ``out``: spans replaced by their kind, generalised terms by [TERM], removed ones by nothing.

    Of overlapping spans the one that starts first counts. Spans depend on the text
    alone and are joined by its hash.
    """
    key, spans = fresh(docs, "_key"), fresh(docs, "_spans")
    found = span_rows(docs, id_col, text_col).filter("size(base) + size(terms) > 0")
    order = in_order(F.concat("base", "terms"))
    table = found.groupBy("key").agg(F.first(order).alias(spans), F.count(F.lit(1)).alias("_rows")).withColumnRenamed("key", key)
    text = whole(column(text_col))
    joined = lookup(docs.withColumn(key, F.md5(text)), table, key, spread_by=text_col, size_col="_rows", how="left")

    def mark(s: Column) -> Column:
        return F.when(s["kind"] == "remove", "").when(s["kind"] == "generalise", "[TERM]").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    changed = replaced(text, F.col(spans), mark)
    return joined.select(*[column(c) for c in docs.columns], F.coalesce(changed, column(text_col)).alias(out))
