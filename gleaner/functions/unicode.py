"""Repair of wrongly decoded and odd characters."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from gleaner.functions.text import replace_matches

# Fixed values.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
CURLY = "“”„‟‘’‚‛"
STRAIGHT = "\"\"\"\"''''"
CONTROL = "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\x7F-\\x9F\\u200B\\u2060\\uFEFF]"
_LATIN1 = "^[\\x00-\\xFF]*\\z"
_TWICE_ENCODED = "[\\xC2-\\xDF][\\x80-\\xBF]|[\\xE0-\\xEF][\\x80-\\xBF]{2}|[\\xF0-\\xF4][\\x80-\\xBF]{3}"

# Windows-1252 reads the bytes 80 to 9F as these characters; five of them it leaves out.
WINDOWS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
WINDOWS_BYTES = "".join(chr(c.encode("cp1252")[0]) for c in WINDOWS)
# What may follow a first byte: as Latin-1 or as Windows-1252.
_NEXT = f"[\\x80-\\xBF{WINDOWS}]"
_SEQUENCE = f"(?:[\\xC2-\\xDF]{_NEXT}|[\\xE0-\\xEF]{_NEXT}{{2}}|[\\xF0-\\xF4]{_NEXT}{{3}})"
# One sequence alone can be plain text (É” in quoted capitals, é and a blank before »), two together can't.
# Alone these can't either: Â and Ã before what isn't a quote or dash, â€ and what follows, ðŸ and two more.
_ALONE = f"[ÂÃ][\\x80-\\xBF€‚ƒ„†‡ˆ‰Š‹ŒŽ•˜™š›œžŸ]|â[€\\x80]{_NEXT}|ð[Ÿ\\x9F]{_NEXT}{{2}}"
MISREAD = f"{_SEQUENCE}{{2,}}|{_ALONE}"


def _reread(run: Column) -> Column:
    """The characters whose UTF-8 bytes ``run`` shows one by one, or ``run`` if it doesn't."""
    as_bytes = F.encode(F.translate(run, WINDOWS, WINDOWS_BYTES), "ISO-8859-1")
    return F.when(F.is_valid_utf8(as_bytes.cast("string")), as_bytes.cast("string")).otherwise(run)


def repair_mojibake(text: Column) -> Column:
    """Undo UTF-8 that was read as Latin-1 or Windows-1252: in the whole text, if all of it shows that, else run by run."""
    as_bytes = F.encode(text, "ISO-8859-1")
    fixable = text.rlike(_TWICE_ENCODED) & text.rlike(_LATIN1) & F.is_valid_utf8(as_bytes.cast("string"))
    by_runs = F.when(text.rlike(MISREAD), replace_matches(text, MISREAD, _reread)).otherwise(text)
    return F.when(fixable, as_bytes.cast("string")).otherwise(by_runs)


def unicode_cleanup(text: Column) -> Column:
    """Mojibake, line ends, control and zero-width characters, curly quotes, ligatures.

    Joiners (U+200C, U+200D) stay: Persian, Hindi and emoji need them.
    """
    out = repair_mojibake(text)
    out = F.regexp_replace(out, "\\r\\n?", "\n")
    out = F.regexp_replace(out, CONTROL, "")
    out = F.translate(out, CURLY, STRAIGHT)
    for ligature, letters in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(letters))
    return out


@F.pandas_udf(T.StringType())
def to_nfc(texts: pd.Series) -> pd.Series:
    """Composed form; Spark has no such function of its own."""
    return texts.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))
