"""Free-text cleaning as built-in column expressions."""

from __future__ import annotations

import html
import html.entities
import json
import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, placeholders and length limits the cleaned text must agree with.
# (?U) makes \s \d \b follow Unicode; word characters are spelled out as letters, numbers, `_`.
SPACE = r"[\s\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
TAG = r"<[^>]+>"
EMAIL = r"(?U)\b[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.]{2,}\b"
LINK = r"(?iuU)\b(?:https?://|www\.)[^\s\x1c-\x1f]+"
PHONE = (
    r"(?U)(?:\(?\d{2}\)?[\s.-]*)?(?:9[\s.-]*)?\d{4}[\s.-]?\d{4}"
    r"|\+?55[\s.-]?\d{2}[\s.-]?\d{4,5}[\s.-]?\d{4}"
)
LINK_START = r"(?i)https?://|www\."
PHONE_CORE = r"\p{Nd}{4}[\s\x{85}\p{Z}.-]?\p{Nd}{4}"
SNIPPET_LENGTH = 400
MAX_SKILLS = 6

NON_ASCII = r"[^\x00-\x7F]"
# Latin fractions and digraph letters, and everything past the Latin blocks
LATIN_LONGER = r"[\xbc-\xbe\u0132-\u0133\u01c4-\u01cc\u01f1-\u01f3\u0250-\x{10ffff}]"

# Entities that are plain replacements; a text holding any other kind goes to `_unescape`.
SIMPLE_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": "\u00a0",
    "&middot;": "·", "&copy;": "©", "&reg;": "®", "&euro;": "€",
    "&ndash;": "–", "&mdash;": "—", "&hellip;": "…", "&amp;": "&",
}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used.

    Spark repeats a costly operand in every branch of a conditional; a lambda's
    variable is bound once.
    """

    def body(bound: Column) -> Column:
        return use(bound)

    return F.transform(F.array(value), body)[0]


def constant_map(entries: dict[str, str]) -> Column:
    """A constant map, handed over as one literal and folded by the optimizer."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def trim_space(text: Column) -> Column:
    """Drop whitespace of any kind at both ends (SQL `trim` only drops blanks)."""
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
MAX_CODE_POINT = 0x10FFFF
REPLACEMENT = "\ufffd"


@lru_cache(maxsize=1)
def _reference_tables() -> tuple[dict[str, str], dict[str, str], str]:
    """Named references, numeric ones that do not stand for their own code point, and the names
    that count without a semicolon too, longest first, as a regex."""
    names = html.entities.html5
    odd = {str(n): html.unescape(f"&#{n};") for n in range(0xA0) if html.unescape(f"&#{n};") != chr(n)}
    bare = sorted((n for n in names if not n.endswith(";")), key=len, reverse=True)
    return names, odd, "|".join(bare)


def _code_point(number: Column) -> Column:
    """The character of a code point, by its UTF-16 form."""
    above = number - 0x10000
    pair = F.concat(
        F.lpad(F.hex(F.shiftright(above, 10) + 0xD800), 4, "0"), F.lpad(F.hex(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00), 4, "0"))
    units = F.when(number < 0x10000, F.lpad(F.hex(number), 4, "0")).otherwise(pair)
    return F.decode(F.unhex(units), "UTF-16BE")


def _numeric(digits: Column, base: int, longest: int) -> Column:
    """The character that a numeric reference stands for; '' for non-characters."""
    _, odd, _ = _reference_tables()
    bare = F.regexp_replace(digits, r"\A0+(?=.)", "")
    number = F.when(F.length(bare) <= longest, F.conv(bare, base, 10).cast("bigint"))

    def char(n: Column) -> Column:
        none = n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
        wrong = n.isNull() | (n > MAX_CODE_POINT) | n.between(0xD800, 0xDFFF)
        special = F.try_element_at(constant_map(odd), n.cast("string"))
        return F.when(wrong, REPLACEMENT).when(none, "").otherwise(F.coalesce(special, _code_point(n)))

    return let(number, char)


def _decoded(reference: Column) -> Column:
    """What a reference (from its `&` on) stands for; itself if it is none."""
    names, _, bare = _reference_tables()
    table = constant_map(names)

    def named(body: Column) -> Column:
        start = F.regexp_extract(body, rf"\A({bare})", 1)
        by_start = F.when(start != "", F.concat(F.try_element_at(table, start), F.substr(body, F.length(start) + 1)))
        return F.coalesce(F.try_element_at(table, body), by_start, F.concat(F.lit("&"), body))

    return (
        F.when(reference.rlike(r"\A&#[xX]"), _numeric(F.regexp_extract(reference, "([0-9a-fA-F]+);?$", 1), 16, 6))
        .when(reference.startswith("&#"), _numeric(F.regexp_extract(reference, "([0-9]+)", 1), 10, 7))
        .otherwise(let(F.substr(reference, F.lit(2)), named))
    )


def _unescape(text: Column) -> Column:
    """Every character reference of a text decoded; the text between them is kept."""
    pieces = F.regexp_extract_all(text, F.lit(f"({REFERENCE}|[^&]+|&)"), 1)
    return F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(r"\A&."), _decoded(p)).otherwise(p)), "")


def unescape_entities(text: Column) -> Column:
    """HTML character references to characters, all names and numeric forms, as browsers read them.

    The common names are plain replacements; only texts with other references are taken apart.
    """
    names = "|".join(sorted(e[1:] for e in SIMPLE_ENTITIES))

    def decoded(t: Column) -> Column:
        plain = t
        for entity, char in SIMPLE_ENTITIES.items():
            plain = F.replace(plain, F.lit(entity), F.lit(char))
        return F.when(t.rlike(rf"&(?!(?:{names}))[#a-zA-Z]"), _unescape(t)).otherwise(plain)

    return let(text, decoded)


def scrub_contacts(text: Column) -> Column:
    """Mask e-mails, then links, then phone numbers, in that order.

    Each pattern only runs on texts that hold what it cannot do without.
    """
    steps = (
        (lambda t: t.contains("@"), EMAIL, "[email]"),
        (lambda t: t.rlike(LINK_START), LINK, "[link]"),
        (lambda t: t.rlike(PHONE_CORE), PHONE, "[phone]"),
    )
    out = F.coalesce(text, F.lit(""))
    for possible, pattern, mask in steps:
        def masked(t: Column, possible=possible, pattern=pattern, mask=mask) -> Column:
            return F.when(possible(t), F.regexp_replace(t, pattern, mask)).otherwise(t)

        out = let(out, masked)
    return out


def start_of(text: Column, length: int | None) -> Column:
    """The first `length` characters, or all."""
    return text if length is None else F.substring(text, 1, length)


def strip_html(text: Column, limit: int | None = None, scrub: bool = False) -> Column:
    """Tags to blanks, entities decoded, optional masking, whitespace runs collapsed; cut if a limit is given."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), TAG, " ")
    out = unescape_entities(out)
    if scrub:
        out = scrub_contacts(out)
    out = F.regexp_replace(out, rf"(?U){SPACE}{{2,}}", " ")
    return start_of(trim_space(out), limit)


@lru_cache(maxsize=1)
def _ascii_forms() -> tuple[str, str, dict[str, str], str]:
    """Characters whose compatibility form holds ASCII.

    One-to-one pairs as two texts, longer forms as a mapping, and the characters
    with longer forms as the inside of a regex class.
    """
    sources, targets, longer = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        form = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(form) == 1:
            sources.append(char)
            targets.append(form)
        elif form:
            longer[char] = form
    runs: list[list[int]] = []
    for code in map(ord, longer):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    spans = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)
    return "".join(sources), "".join(targets), longer, spans


def fold_accents(text: Column) -> Column:
    """Lower-case ASCII form: accents dropped, compatibility forms spelled out, rest removed."""
    sources, targets, longer, spans = _ascii_forms()
    table = constant_map(longer)

    def spelled(t: Column) -> Column:
        # only the characters with longer forms are looked up; the runs between them are kept
        runs = F.regexp_extract_all(t, F.lit(f"([{spans}]|[^{spans}]+)"), 1)
        return F.array_join(F.transform(runs, lambda r: F.coalesce(F.try_element_at(table, r), r)), "")

    def folded(t: Column) -> Column:
        # past Latin letters, or one of the few Latin characters with a longer form
        rare = t.rlike(LATIN_LONGER) & t.rlike(f"[{spans}]")
        ascii_form = F.translate(F.when(rare, spelled(t)).otherwise(t), sources, targets)
        return F.when(~t.rlike(NON_ASCII), t).otherwise(F.regexp_replace(ascii_form, NON_ASCII, ""))

    return F.lower(let(F.coalesce(text, F.lit("")), folded))


def skills_join(skills: Column, limit: int = MAX_SKILLS) -> Column:
    """The first few skills as one delimited text."""
    return F.array_join(F.slice(F.coalesce(skills, F.array().cast("array<string>")), 1, limit), " · ")


def snippet(text: Column, length: int = SNIPPET_LENGTH) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, length)


def search_text(title: Column, company: Column) -> Column:
    """What a free-text search looks into."""
    return F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(company, F.lit(""))))


def title_case(text: Column) -> Column:
    """Capital after every non-letter (`initcap` only looks at blanks)."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(F.transform(runs, F.initcap), "")
