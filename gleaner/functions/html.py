"""HTML to text, with pattern functions only."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, functions as F

from gleaner.functions.text import let, replace_matches

# What is dropped with its content, what starts a new paragraph, entity names.
_ATTRIBUTES = r"(?:[ \t\n\r\f/][^>]*)?"
DROPPED = ["head", "script", "style", "nav", "noscript", "template"]
BLOCK_TAGS = (
    "address|article|aside|blockquote|body|caption|center|dd|div|dl|dt|fieldset|figcaption|figure|footer|form"
    "|h[1-6]|header|hr|html|legend|li|main|ol|optgroup|option|p|pre|section|select|table|tbody|td|textarea|tfoot|th|thead|tr|ul"
)
BLOCK = rf"(?i)</?({BLOCK_TAGS}){_ATTRIBUTES}>"
LINK = rf"(?is)<a{_ATTRIBUTES}>(.*?)</a[ \t\n\r\f]*>"
LINE_BREAK = rf"(?i)<br{_ATTRIBUTES}>"
ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]{1,31}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});"
NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " "}


def _entity_names() -> Column:
    """All names of the standard with their characters, as a map that is folded into a constant."""
    names = sorted(n for n in html5 if n.endswith(";"))
    return F.map_from_arrays(F.split(F.lit(" ".join(names)), " "), F.split(F.lit("\x01".join(html5[n] for n in names)), "\x01"))


def _entity_text(entity: Column) -> Column:
    digits = F.regexp_extract(entity, "#[xX]?([0-9A-Fa-f]+);", 1)
    decimal = F.conv(digits, 10, 10).cast("bigint")
    hexadecimal = F.conv(digits, 16, 10).cast("bigint")
    code = F.when(entity.rlike("^&#[xX]"), hexadecimal).otherwise(decimal)
    is_char = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    named = F.element_at(_entity_names(), F.substring(entity, 2, 40))
    return F.when(entity == "&amp;", F.lit("&")).when(is_char, char).otherwise(F.coalesce(named, entity))


def unescape(text: Column) -> Column:
    """Replace all named and numeric entities, each once; unknown names stay.

    Names that do not give an ampersand are plain replacements. Ampersands and
    numbers go together in one pass, so that none is read twice.
    """

    def rest(t: Column) -> Column:
        numbered = replace_matches(t, ENTITY, _entity_text)
        return F.when(t.rlike("&(?!amp;)[A-Za-z#]"), numbered).otherwise(F.replace(t, F.lit("&amp;"), F.lit("&")))

    def all_of(t: Column) -> Column:
        plain = t
        for name, value in NAMED.items():
            plain = F.replace(plain, F.lit(name), F.lit(value))
        # Most texts have no entity at all.
        return F.when(F.contains(t, F.lit("&")), let(plain, rest)).otherwise(t)

    return let(text, all_of)


def drop_hidden(html: Column) -> Column:
    """Remove comments and elements that hold no page text."""
    html = F.when(F.contains(html, F.lit("<!--")), F.regexp_replace(html, r"(?s)<!--.*?-->", "")).otherwise(html)
    for name in DROPPED:
        html = F.regexp_replace(html, rf"(?is)<{name}{_ATTRIBUTES}>.*?</{name}[ \t\n\r\f]*>", "")
    return html


def plain_text(fragment: Column) -> Column:
    """Text without tags, entities resolved, blanks collapsed."""
    spaced = F.regexp_replace(fragment, LINE_BREAK, " ")
    bare = F.when(F.contains(fragment, F.lit("<")), F.regexp_replace(spaced, r"<[^>]*>", "")).otherwise(fragment)
    # Single blanks stay as they are.
    return F.trim(F.regexp_replace(unescape(bare), r"[ \t\n\r\f]{2,}|[\t\n\r\f]", " "))


def block_pieces(visible: Column) -> tuple[Column, Column]:
    """Pieces of a page between block tags, and the tag before each (empty for the first)."""
    tags = F.concat(F.array(F.lit("")), F.transform(F.regexp_extract_all(visible, F.lit(BLOCK), 1), F.lower))
    return F.split(visible, BLOCK, -1), tags


def link_chars(piece: Column) -> Column:
    """Characters of the plain text inside links."""
    links = F.transform(F.regexp_extract_all(piece, F.lit(LINK), 1), lambda a: F.length(plain_text(a)))
    return F.aggregate(links, F.lit(0), lambda a, b: a + b)


def html_language(html: Column, default: str = "en") -> Column:
    """Two-letter code of the ``lang`` attribute of the ``html`` element."""
    code = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*[ \t\n\r\f]lang=[\"']?([a-z]{2})", 1))
    return F.when(code == "", F.lit(default)).otherwise(code)
