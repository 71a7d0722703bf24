"""Company-name cleaning, blocking identifiers and name tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_IDENTIFIER_LENGTH = 4

# Legal-form endings removed from company names, several words first.
LEGAL_FORMS = (
    "gmbh & co kg", "gmbh & co kgaa", "private limited", "pte limited", "pty limited", "pvt limited",
    "pte ltd", "pty ltd", "pvt ltd", "sdn bhd", "co ltd", "sp zoo", "s de rl", "sa de cv",
    "incorporated", "corporation", "company", "limited", "inc", "corp", "co", "ltd", "llc", "llp", "lp",
    "lllp", "plc", "pllc", "pc", "gmbh", "kgaa", "ag", "kg", "ohg", "ug", "ev", "se", "sa", "sas", "sasu",
    "sarl", "srl", "spa", "snc", "bv", "nv", "cv", "vof", "ab", "hb", "as", "asa", "aps", "oy", "oyj",
    "kk", "gk", "kft", "zrt", "nyrt", "sro", "doo", "dd", "ood", "ad", "eood", "sl", "slu", "ltda", "eireli",
    "bhd", "tbk", "jsc", "ooo", "oao", "pao", "zao",
)

_SHORT = 4


def legal_form_pattern(forms: tuple[str, ...] = LEGAL_FORMS) -> str:
    """One end-anchored pattern; short forms may carry dots (`B.V.`), longest form first."""

    def word(w: str) -> str:
        if w == "&":
            return "&"
        return r"\.?".join(w) + r"\.?" if len(w) <= _SHORT else w + r"\.?"

    ordered = sorted(forms, key=lambda f: (-len(f.split()), -len(f)))
    return r"(?:[\s,]+(?:" + "|".join(r"\s+".join(word(w) for w in f.split()) for f in ordered) + r"))+$"


def squeeze(text: Column) -> Column:
    """Trim and turn every run of blanks into one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def camel_case(text: Column) -> Column:
    """Capitalise each word, one blank between words."""
    return F.initcap(F.lower(squeeze(text)))


def _strip_tail(text: Column) -> Column:
    return F.regexp_replace(text, r"[^.\p{L}\p{N}_]+$", "")


def strip_legal_form(text: Column, forms: tuple[str, ...] = LEGAL_FORMS) -> Column:
    """Company name without its legal ending; the first word always stays."""
    return _strip_tail(F.regexp_replace(_strip_tail(squeeze(text)), "(?i)" + legal_form_pattern(forms), ""))


def clean_company_name(
    name: Column,
    aliases: tuple[str, ...] = ("dba", "aka"),
    drop_after_comma: bool = True,
    drop_open_bracket_tail: bool = True,
    drop_number_and_bullet: bool = True,
    fix_upper_case: bool = True,
    forms: tuple[str, ...] = LEGAL_FORMS,
) -> Column:
    """Comparable company name: alias, comma, bracket, trailing number, bullet, case, legal ending, quotes.

    The older cleaner keeps commas and numbers and removes only closed brackets: switch the flags off.
    """
    alias = F.trim(F.regexp_extract(name, rf"(?i)(?:{'|'.join(aliases)})\s+([^)]+)", 1))
    out = F.coalesce(F.nullif(alias, F.lit("")), name)
    if drop_after_comma:
        out = F.regexp_replace(out, ",.*", "")
    out = F.regexp_replace(out, r"\(.*" if drop_open_bracket_tail else r"\(.*\)", "")
    if drop_number_and_bullet:
        out = F.regexp_replace(F.regexp_replace(out, r" \d+$", ""), r"^\* ", "")
    if fix_upper_case:
        out = F.when(out == F.upper(out), camel_case(out)).otherwise(out)
    return F.replace(strip_legal_form(out, forms), F.lit('"'), F.lit(""))


def block_identifier(name: Column, min_length: int = MIN_IDENTIFIER_LENGTH) -> Column:
    """All words but the last, lower case; the whole name when that front part is too short."""
    words = F.split(F.trim(name), r"\s+")
    front = F.slice(words, F.lit(1), F.size(words) - 1)
    long_enough = (F.size(words) > 1) & (F.length(F.array_join(front, "")) >= min_length)
    return F.lower(F.when(long_enough, F.array_join(front, " ")).otherwise(name))


def has_letter(name: Column) -> Column:
    """False for names made only of digits, blanks and signs."""
    return name.rlike("[A-Za-z]")


def comparable(name: Column) -> Column:
    """Lower case with every sign turned into a blank: the form in which names are scored."""
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}_]", " "))
