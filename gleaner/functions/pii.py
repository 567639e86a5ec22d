"""Finding and replacing personal data in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gleaner.functions.text import replace_matches

# Patterns and placeholders.
# The run before the sign is taken whole and only from its start, which keeps the search linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"(?:{OCTET}\.){{3}}{OCTET}"
IPV6 = r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
IBAN = r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"
# The printed form: groups of four, the last one may be shorter.
PRINTED_IBAN = r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?"
EMAIL_MARK = "[EMAIL]"
IP_MARK = "[IP]"
IBAN_MARK = "[IBAN]"



def short_ipv6() -> str:
    """IPv6 with ``::`` for at least one group, by the number of groups before it."""
    groups = lambda least, most: rf"[0-9A-Fa-f]{{1,4}}(?::[0-9A-Fa-f]{{1,4}}){{{least - 1},{most - 1}}}"
    forms = ["::" + groups(1, 7)]
    forms += [f"{groups(n, n)}::(?:{groups(1, 7 - n)})?" for n in range(1, 7)]
    return "|".join([*forms, groups(7, 7) + "::"])


# An address must be the whole dotted (or hex and colon) run, not a part of a longer one.
_WHOLE_IP = (
    rf"(?<![0-9])(?<![0-9]\.){IPV4}(?![0-9])(?!\.[0-9])"
    rf"|(?<![0-9A-Fa-f:]){IPV6}(?![0-9A-Fa-f:])"
    # The short form needs a digit, so names like A::B stay.
    rf"|(?<![0-9A-Za-z_:])(?=[A-Fa-f:]*+[0-9])(?:{short_ipv6()})(?![0-9A-Za-z_:])"
)
_WHOLE_IBAN = rf"(?<![A-Za-z0-9]){IBAN}(?![A-Za-z0-9])"
_WHOLE_PRINTED = rf"(?<![A-Za-z0-9_]){PRINTED_IBAN}(?![A-Za-z0-9_])"


def iban_remainder(iban: Column) -> Column:
    """ISO 7064 mod 97 of an IBAN in compact form; 1 when it is valid."""
    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 4))
    return F.aggregate(
        F.split(moved, "(?!^)(?!$)"),
        F.lit(0),
        lambda acc, c: F.when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97).otherwise(
            (acc * 100 + F.ascii(c) - 55) % 97
        ),
    )


# Cheap tests that most texts fail; only the others are searched in full.
def _may_hold_email(text: Column) -> Column:
    return text.contains("@")


def _may_hold_iban(text: Column) -> Column:
    return text.rlike(r"[0-9]{2}[A-Z0-9]{11}")


def _may_hold_ip(text: Column) -> Column:
    return text.rlike(r"[0-9]\.[0-9]{1,3}\.[0-9]") | (text.contains(":") & text.rlike(r":[0-9A-Fa-f]{0,4}:"))


def redact_emails(text: Column) -> Column:
    return F.when(_may_hold_email(text), F.regexp_replace(text, EMAIL, EMAIL_MARK)).otherwise(text)


def count_emails(text: Column) -> Column:
    return F.when(_may_hold_email(text), F.regexp_count(text, F.lit(EMAIL))).otherwise(0).cast("bigint")


def _may_hold_printed(text: Column) -> Column:
    return text.rlike("[A-Z]{2}[0-9]{2} [A-Z0-9]{4} [A-Z0-9]{4}")


def _iban_groups(match: Column) -> Column:
    """How many groups, from the first on, are an IBAN: the most that fit, null for none.

    Words and years in capitals and digits that follow a printed IBAN look like further groups.
    """
    groups = F.split(match, " ")

    def fits(n: Column) -> Column:
        joined = F.array_join(F.slice(groups, 1, n), "")
        return (F.length(joined) >= 15) & (iban_remainder(joined) == 1)

    return F.get(F.filter(F.sequence(F.size(groups), F.lit(3), F.lit(-1)), fits), F.lit(0))


def _marked_printed(match: Column) -> Column:
    groups, n = F.split(match, " "), _iban_groups(match)
    rest = F.slice(groups, n + 1, F.size(groups))
    return F.when(n.isNull(), match).otherwise(F.array_join(F.concat(F.array(F.lit(IBAN_MARK)), rest), " "))


def redact_ibans(text: Column) -> Column:
    """Replace IBANs, compact or printed in groups of four, whose check digits are right."""
    marked = replace_matches(
        text, _WHOLE_IBAN, lambda m: F.when(iban_remainder(m) == 1, F.lit(IBAN_MARK)).otherwise(m)
    )
    compact = F.when(_may_hold_iban(text), marked).otherwise(text)
    return F.when(_may_hold_printed(text), replace_matches(compact, _WHOLE_PRINTED, _marked_printed)).otherwise(compact)


def count_ibans(text: Column) -> Column:
    hits = F.filter(F.regexp_extract_all(text, F.lit(_WHOLE_IBAN), 0), lambda m: iban_remainder(m) == 1)
    printed = F.filter(F.regexp_extract_all(text, F.lit(_WHOLE_PRINTED), 0), lambda m: _iban_groups(m).isNotNull())
    compact = F.when(_may_hold_iban(text), F.size(hits)).otherwise(0)
    return (compact + F.when(_may_hold_printed(text), F.size(printed)).otherwise(0)).cast("bigint")


def redact_ips(text: Column) -> Column:
    return F.when(_may_hold_ip(text), F.regexp_replace(text, _WHOLE_IP, IP_MARK)).otherwise(text)


def count_ips(text: Column) -> Column:
    return F.when(_may_hold_ip(text), F.regexp_count(text, F.lit(_WHOLE_IP))).otherwise(0).cast("bigint")
