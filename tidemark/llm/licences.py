"""Licence recognition by sentence rules.

A text is cleaned of comment marks and cut into sentences; each normalised sentence that speaks of
a licence is mapped to the identifier of the known sentence it matches, and the text's sequence of
identifiers is matched against ordered licence rules: a rule takes its sequence out, so a longer
or more exact rule goes before the ones it contains. An SPDX tag is a sentence of its own, mapped
to one identifier for each licence of its expression; those name their licence and need no rule.
Everything is column expressions on a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import doc_texts

#: A text or sentence without any of these is not looked at further.
KEYWORDS = (
    r"\b(?:licen[cs]e[sd]?|licen[cs]ing|copyright|rights reserved|public domain|permission|redistributions?|"
    r"warrant(?:y|ies)|spdx|creative commons|cc[ -]by|cc0|mit no attribution|provided \W?as[ -]is|unlicense|liable|liability|endorse or promote|[al]?gpl)\b"
)

# Known sentences, as patterns of their normalised form.
SENTENCES: list[tuple[str, str]] = [
    ("apache-2.0-ref", r"\b(licensed|released|distributed|available) under the( terms of the)? apache license,? version 2\.0\b"),
    ("apache-2.0-unless", r"^unless required by applicable law or agreed to in writing\b"),
    ("apache-2.0-see", r"^see the license for the specific language governing permissions and limitations\b"),
    ("apache-not-except", r"^you may not use this file except in compliance with the license\b"),
    ("apache-obtain", r"^you may obtain a copy of the license at\b"),
    ("mit-ref", r"\b(licensed|released|distributed|available) under the( terms of the)? (mit|expat) licen[cs]e\b"),
    ("mit-0-ref", r"\b(licensed|released|distributed|available) under the( terms of the)? mit (0|no attribution)( licen[cs]e)?\b"),
    ("mit-title", r"^(the )?mit licen[cs]e( mit)?$"),
    ("mit-0-title", r"^(the )?mit (no attribution|0)( licen[cs]e)?$"),
    ("mit-grant", r"^permission is hereby granted, free of charge, to any person obtaining a copy\b"),
    ("mit-notice", r"^the above copyright notice and this permission notice shall be included\b"),
    ("isc-grant", r"^permission to use, copy, modify, and or distribute this software for any purpose\b"),
    ("boost-title", r"^boost software licen[cs]e version 1\.0, august 17th, 2003\b"),
    ("boost-grant", r"^permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation\b"),
    ("boost-ref", r"\b(licensed|released|distributed|available|subject to|use, modification and distribution are subject to)( under)?( the terms of)? the boost software licen[cs]e\b"),
    ("zlib-as-is", r"^this software is provided as is ?, without any express or implied warranty\b"),
    ("zlib-grant", r"^permission is granted to anyone to use this software for any purpose\b"),
    ("as-is", r"\bis provided as is\b"),
    ("no-liability", r"^in no event (shall|will)\b.*\bliable\b"),
    ("bsd-redistribution", r"^redistribution and use in source and binary forms\b"),
    ("bsd-source", r"^redistributions of source code must retain the above copyright notice\b"),
    ("bsd-binary", r"^redistributions in binary form must reproduce the above copyright notice\b"),
    ("bsd-endorse", r"^neither the name of\b.*\bmay be used to endorse or promote\b"),
    ("apache-2.0-title", r"^apache licen[cs]e version 2\.0, january 2004\b"),
    ("agpl-3.0-title", r"^gnu affero general public licen[cs]e version 3, 19 november 2007\b"),
    ("lgpl-3.0-title", r"^gnu lesser general public licen[cs]e version 3, 29 june 2007\b"),
    ("lgpl-2.1-title", r"^gnu lesser general public licen[cs]e version 2\.1, february 1999\b"),
    ("gpl-3.0-title", r"^gnu general public licen[cs]e version 3, 29 june 2007\b"),
    ("gpl-2.0-title", r"^gnu general public licen[cs]e version 2, june 1991\b"),
    ("fsf-verbatim", r"^everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document\b"),
    ("mpl-2.0-title", r"^mozilla public licen[cs]e,? version 2\.0$"),
    ("epl-2.0-title", r"^eclipse public licen[cs]e v ?2\.0$"),
    ("epl-1.0-title", r"^eclipse public licen[cs]e v ?1\.0$"),
    ("epl-2.0-ref", r"\bunder the( terms of the)? eclipse public licen[cs]e,? (version|v) ?2\.0\b"),
    ("epl-1.0-ref", r"\bunder the( terms of the)? eclipse public licen[cs]e,? (version|v) ?1\.0\b"),
    ("agpl-3.0-ref", r"\bunder the( terms of the)? gnu affero general public licen[cs]e,? (as published .*)?(version|v) ?3\b"),
    ("lgpl-3.0-ref", r"\bunder the( terms of the)? gnu lesser general public licen[cs]e,? (as published .*)?(version|v) ?3\b"),
    ("lgpl-2.1-ref", r"\bunder the( terms of the)? gnu lesser general public licen[cs]e,? (as published .*)?(version|v) ?2\.1\b"),
    ("gpl-3.0-ref", r"\bunder the( terms of the)? gnu general public licen[cs]e,? (as published .*)?(version|v) ?3\b"),
    ("gpl-2.0-ref", r"\bunder the( terms of the)? gnu general public licen[cs]e,? (as published .*)?(version|v) ?2\b"),
    ("mpl-2.0-ref", r"\b(subject to the terms of|under)( the terms of)? the mozilla public licen[cs]e,? (version|v) ?2\.0\b"),
    ("cc-by-nc-sa-4.0-ref", r"\b(cc by nc sa|creative commons attribution noncommercial sharealike) 4\.0\b"),
    ("cc-by-nc-nd-4.0-ref", r"\b(cc by nc nd|creative commons attribution noncommercial noderivatives) 4\.0\b"),
    ("cc-by-nc-4.0-ref", r"\b(cc by nc|creative commons attribution noncommercial) 4\.0\b"),
    ("cc-by-sa-4.0-ref", r"\b(cc by sa|creative commons attribution sharealike) 4\.0\b"),
    ("cc-by-nd-4.0-ref", r"\b(cc by nd|creative commons attribution noderivatives) 4\.0\b"),
    ("cc-by-4.0-ref", r"\b(cc by|creative commons attribution) 4\.0\b"),
    ("cc0-ref", r"\b(cc0( 1\.0)?|creative commons zero)\b"),
    ("unlicense", r"^this is free and unencumbered software released into the public domain\b"),
    ("public-domain", r"\bpublic domain\b"),
    ("rights-reserved", r"^all rights reserved\b"),
    ("copyright", r"^copyright\b"),
]

# Licences by their sequence of sentences, in the order in which they are tried.
RULES: list[tuple[str, tuple[str, ...]]] = [
    ("Apache-2.0", ("apache-2.0-ref", "apache-not-except", "apache-obtain", "apache-2.0-unless", "apache-2.0-see")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "as-is", "no-liability")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "as-is", "no-liability")),
    ("BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("ISC", ("isc-grant", "as-is")),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("unlicense",)),
    ("Apache-2.0", ("apache-2.0-ref",)),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-title",)),
    ("MIT-0", ("mit-0-title", "copyright", "mit-grant", "as-is", "no-liability")),
    ("MIT-0", ("mit-0-title",)),
    ("MIT-0", ("mit-0-ref",)),
    ("MIT-0", ("mit-grant", "as-is")),
    ("BSL-1.0", ("boost-title", "boost-grant")),
    ("BSL-1.0", ("boost-title",)),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-1.0", ("boost-ref",)),
    ("Zlib", ("zlib-as-is", "no-liability", "zlib-grant")),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("AGPL-3.0", ("agpl-3.0-title", "copyright", "fsf-verbatim")),
    ("LGPL-3.0", ("lgpl-3.0-title", "copyright", "fsf-verbatim")),
    ("LGPL-2.1", ("lgpl-2.1-title", "copyright", "fsf-verbatim")),
    ("GPL-3.0", ("gpl-3.0-title", "copyright", "fsf-verbatim")),
    ("GPL-2.0", ("gpl-2.0-title", "copyright", "fsf-verbatim")),
    ("Apache-2.0", ("apache-2.0-title",)),
    ("AGPL-3.0", ("agpl-3.0-title",)),
    ("LGPL-3.0", ("lgpl-3.0-title",)),
    ("LGPL-2.1", ("lgpl-2.1-title",)),
    ("GPL-3.0", ("gpl-3.0-title",)),
    ("GPL-2.0", ("gpl-2.0-title",)),
    ("MPL-2.0", ("mpl-2.0-title",)),
    ("EPL-2.0", ("epl-2.0-title",)),
    ("EPL-1.0", ("epl-1.0-title",)),
    ("EPL-2.0", ("epl-2.0-ref",)),
    ("EPL-1.0", ("epl-1.0-ref",)),
    ("AGPL-3.0", ("agpl-3.0-ref",)),
    ("LGPL-3.0", ("lgpl-3.0-ref",)),
    ("LGPL-2.1", ("lgpl-2.1-ref",)),
    ("GPL-3.0", ("gpl-3.0-ref",)),
    ("GPL-2.0", ("gpl-2.0-ref",)),
    ("MPL-2.0", ("mpl-2.0-ref",)),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4.0-ref",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd-4.0-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0-ref",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4.0-ref",)),
    ("CC-BY-4.0", ("cc-by-4.0-ref",)),
    ("CC0-1.0", ("cc0-ref",)),
    ("LicenseRef-Public-Domain", ("public-domain",)),
    ("LicenseRef-All-Rights-Reserved", ("copyright", "rights-reserved")),
    ("LicenseRef-All-Rights-Reserved", ("rights-reserved",)),
]


# Licence identifiers that an SPDX tag may name, without `-only`, `-or-later` or `+`.
SPDX_IDS = (
    "0BSD AFL-3.0 AGPL-1.0 AGPL-3.0 Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0 BlueOak-1.0.0 "
    "BSD-1-Clause BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-4-Clause BSL-1.0 BUSL-1.1 "
    "CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 "
    "CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.2 GFDL-1.3 "
    "GPL-1.0 GPL-2.0 GPL-3.0 HPND ICU IJG ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 Libpng Linux-syscall-note LPPL-1.3c MIT MIT-0 "
    "MIT-CMU MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL "
    "PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()

_ONE = r"[A-Za-z0-9][A-Za-z0-9.+:-]*"
_WITH = rf"{_ONE}(?:[ \t]+(?i:with)[ \t]+{_ONE})?"
#: The expression at the head of a tag: identifiers, exceptions, OR and AND, brackets. What follows it is no part.
_EXPRESSION = rf"^[( \t]*{_WITH}[) \t]*(?:(?i:\bor|\band)[( \t]+{_WITH}[) \t]*)*"
_TAG = "spdx-license-identifier "

_OFFERED = r"(?:licen[cs]ed|released|distributed|available|covered|offered|published|provided)"
_DENIED = rf"\b(?:not(?! (?:only|just|merely)\b)|never|no longer|isn t|aren t|wasn t)(?: [\p{{L}}]+){{0,3}}? {_OFFERED} under\b"


def sentences(text: Column) -> Column:
    """Normalised licence sentences of a text, in order.

    Lines lose comment marks. A sentence ends at an end mark before white space, at a blank line,
    or at a line end that a capital letter or a list mark follows; other lines are joined, as are
    the words of a licence's name and a title with the version below it. The colon of an SPDX tag ends none; the tag stands alone, up to
    its line's end or a comment's, and keeps its marks and capitals.
    """
    bare = F.regexp_replace(text, r"(?m)^[ \t]*(?:[#*;%>]|//+|/\*+|--+|dnl |rem )+[ \t]?", "")
    bare = F.regexp_replace(bare, r"(?i)\bSPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*?)[ \t]*(?:\*+/|--+>)?[ \t]*(?=[\r\n]|$)", "\n\nSPDX-License-Identifier $1\n\n")
    bare = F.regexp_replace(bare, r"(?i)\b(gnu|affero|lesser|general|mozilla|eclipse|public|apache|software|mit)[ \t]*\r?\n[ \t]*(?=(?:affero|lesser|general|public|software|licen[cs]e)\b)", "$1 ")
    bare = F.regexp_replace(bare, r"(?i)\b((?:public|apache|software) licen[cs]e,?)\s+(?:-\s+)?(?=v(?:ersion|\.)?\s*\d)", "$1 ")
    bare = F.regexp_replace(bare, r"(?i)\bv\.\s*(?=\d)", "v ")
    cut = F.split(bare, r"(?<=[.!?;:])\s+|\n\s*\n\s*|\n\s*(?=[A-Z0-9(\p{Lu}])")

    def plain(s: Column) -> Column:
        words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), r"[^\p{L}\p{N}.,]+", " "), r"[ .,]+$|^[ .,]+", ""))
        return F.when(F.startswith(s, F.lit("SPDX-License-Identifier ")), F.concat(F.lit(_TAG), F.substring(s, len(_TAG) + 1, 1 << 30))).otherwise(words)

    return F.transform(F.filter(cut, lambda s: F.lower(s).rlike(KEYWORDS)), plain)


def _is_tag(sentence: Column) -> Column:
    return F.startswith(sentence, F.lit(_TAG))


def _expression(sentence: Column) -> Column:
    """The SPDX expression of a tag, white space made single."""
    found = F.regexp_extract(F.substring(sentence, len(_TAG) + 1, 1 << 30), _EXPRESSION, 0)
    return F.trim(F.regexp_replace(F.regexp_replace(found, r"[ \t]+", " "), r"[ .]+$", ""))


def _tag_ids(sentence: Column) -> Column:
    """spdx: and a licence for each one of the expression, by exact identifier; `unknown` for others."""
    known = F.create_map(*[F.lit(x) for name in SPDX_IDS for x in (name.lower(), name)])

    def licence(one: Column) -> Column:
        head = F.regexp_replace(F.lower(F.regexp_replace(one, r"(?i)[ \t]+with[ \t]+.*$", "")), r"(?:\+|-only|-or-later)?\.*$", "")
        beside = F.regexp_replace(F.regexp_extract(one, rf"(?i)[ \t]+with[ \t]+({_ONE})$", 1), r"\.+$", "")
        name = F.coalesce(F.try_element_at(known, head), F.when(head.rlike("^licenseref-."), one))
        return F.coalesce(F.concat(F.lit("spdx:"), name, F.when(beside != "", F.concat(F.lit(" WITH "), beside)).otherwise("")), F.lit("unknown"))

    parts = F.filter(F.regexp_extract_all(_expression(sentence), F.lit(f"({_WITH})"), 1), lambda x: ~F.lower(x).isin("or", "and"))
    return F.when(F.size(parts) > 0, F.transform(parts, licence)).otherwise(F.array(F.lit("unknown")))


def _affirmed(sentence: Column) -> Column:
    """A sentence without what it denies: `not licensed under A but under B` speaks of B alone."""
    turned = F.regexp_replace(sentence, rf"{_DENIED}.*? but (?:rather |instead |only |is )*(?:{_OFFERED} )?under\b", "licensed under")
    return F.when(_is_tag(sentence), sentence).otherwise(F.regexp_replace(turned, rf"{_DENIED}.*$", "is denied"))


def _identify(sentence: Column) -> Column:
    named = [F.when(sentence.rlike(p), F.lit(name)) for name, p in SENTENCES]
    plain = F.coalesce(*named, F.when(sentence.rlike(r"\bis denied$"), F.lit("denied")), F.lit("unknown"))
    return F.when(_is_tag(sentence), _tag_ids(sentence)).otherwise(F.array(plain))


def licence_scan(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, sentence_ids, licences, n_unknown, expressions.

    sentence_ids: identifiers of the licence sentences in order, joined by commas: `unknown` for
    one that speaks of a licence but matches none, `denied` for one that only says what does not
    apply, spdx: and the licence for those of tags. licences: distinct licences, those of tags in
    order of the text, then those of rules in order of the rules; `-only`, `-or-later` and `+` are
    left out, exceptions kept. expressions: the expressions of SPDX tags as they stand, joined by
    semicolons. A text without licence sentences, a null one too, gives empty strings and 0; a
    null id stays null, repeated rows are repeated, an empty table gives no rows.
    """
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit("," + ",".join(ids) + ",").alias("ids")) for name, ids in RULES]
    )
    none = F.array().cast("array<string>")
    # each step is bound once: a lambda's argument is not computed again wherever it is named
    said = F.transform(sentences(F.col("text")), _affirmed)
    found = doc_texts(docs).select("doc_id", F.when(F.lower("text").rlike(KEYWORDS), said).otherwise(none).alias("said"))
    found = found.select("doc_id", F.flatten(F.transform("said", _identify)).alias("ids"), F.transform(F.filter("said", _is_tag), _expression).alias("tags"))
    tagged = F.transform(F.filter("ids", lambda x: F.startswith(x, F.lit("spdx:"))), lambda x: F.substring(x, 6, 1 << 30))
    # a comma on both sides of every identifier, so that no rule matches a part of one
    joined = F.concat(F.lit(","), F.array_join("ids", ",,"), F.lit(","))
    start = F.struct(F.regexp_replace(joined, ",,", ",").alias("rest"), tagged.alias("licences"))

    def apply(done: Column, rule: Column) -> Column:
        hit = F.instr(done["rest"], rule["ids"]) > 0
        return F.when(
            hit,
            F.struct(
                F.replace(done["rest"], rule["ids"], F.lit(",-,")).alias("rest"),
                F.array_append(done["licences"], rule["name"]).alias("licences"),
            ),
        ).otherwise(done)

    matched = F.when(F.size("ids") > 0, F.aggregate(rules, start, apply, lambda done: done["licences"])).otherwise(none)
    return found.select(
        "doc_id",
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.array_distinct(matched), ",").alias("licences"),
        F.size(F.filter("ids", lambda x: x == "unknown")).alias("n_unknown"),
        F.array_join("tags", ";").alias("expressions"),
    )
