"""Column functions on inputs whose results were worked out by hand."""

from __future__ import annotations

import html
import unicodedata

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, geo, keys, labels, numbers, scores, taxonomy, text


def values(spark, rows, schema, column):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in frame.select("i", column.alias("v")).orderBy("i").collect()]


def check(spark, cases, schema, column):
    got = values(spark, [c[0] if isinstance(c[0], tuple) else (c[0],) for c in cases], schema, column)
    assert got == [c[1] for c in cases]


def test_seniority(spark):
    check(spark, [
        (("Senior Data Engineer", None), "senior"), (("Lead Senior Analyst", None), "lead/management"),
        (("Gerente de Produto", None), "lead/management"), (("Headhunter", None), "lead/management"),
        (("Analista de Dados Pleno", None), "mid-level"), (("Analista I", None), "junior"),
        (("Engineer II", None), "mid-level"), (("Engineer III", None), "senior"),
        (("ENGENHEIRO SÊNIOR", None), "senior"), (("Estágio em TI", None), "internship"),
        (("International Account Executive", None), "internship"), (("Data Analyst", None), "n/a"),
        (("Senior X", ["Mid Level"]), "mid-level"), (("Senior X", ["?", " Management "]), "lead/management"),
        ((None, None), "n/a"), (("ésr dev", None), "n/a"), (("Entry-Level Dev", None), "junior"),
    ], "t string, l array<string>", taxonomy.seniority(F.col("t"), F.col("l")))


def test_area(spark):
    check(spark, [
        (("Data Analyst", None), "data"), (("Analista de BI", None), "data"),
        (("Backend Developer (Java)", None), "software engineering"), (("Product Designer", None), "design"),
        (("UX Designer", None), "design"), (("Customer Success Manager", None), "customer support"),
        (("Growth Marketing", None), "marketing"), (("Receptionist", None), "other"),
        (("X", ["DevOps and Sysadmin"]), "software engineering"), (("Data Analyst", ["Business"]), "other"),
        (("Data Analyst", ["?"]), "data"), (("ANALISTA DE OPERAÇÕES", None), "operations"),
        (("FP&A", None), "finance"), ((".NET guru", None), "other"), (("ASP.NET guru", None), "software engineering"),
    ], "t string, c array<string>", taxonomy.area(F.col("t"), categories=F.col("c")))


def test_area_description_counts_once_per_keyword_and_may_be_cut(spark):
    check(spark, [
        (("X", "python react node"), "software engineering"), (("X", "python python python"), "other"),
        (("X", "python react"), "other"), (("X", " " * 500 + "python react node"), "software engineering"),
    ], "t string, d string", taxonomy.area(F.col("t"), F.col("d")))
    check(spark, [(("X", " " * 500 + "python react node"), "other")],
          "t string, d string", taxonomy.area(F.col("t"), F.col("d"), description_length=500))


def test_area_pattern_with_alternatives_counts_once(spark):
    column = taxonomy.area(F.col("t"), keywords={"a": ("x|y",), "b": ("x", "y")})
    check(spark, [("x y", "b"), ("x", "a")], "t string", column)


def test_work_model(spark):
    check(spark, [
        (("x", True), "remote"), (("Remoto - SP", None), "remote"), (("Remote/Hybrid", None), "remote"),
        (("Híbrido", False), "hybrid"), (("Presencial", None), "on-site"), (("", None), ""), ((None, None), ""),
    ], "t string, f boolean", labels.work_model_label(F.col("t"), F.col("f")))


def test_market(spark):
    place = F.col("t")
    check(spark, [
        ("São Paulo, Remote", "BR/BR"), ("Brasília", "BR/BR"), ("Remote - US", "Remote - US/Global remote"),
        ("Berlin", "Berlin/Global"),
    ], "t string", F.concat_ws("/", labels.country_from_location(place), labels.market_from_location(place)))


def test_as_int(spark):
    check(spark, [
        ("2354", 2354), ("", None), ("0", None), ("1.600", 1600), ("R$\u00a01.600,50", 1600), ("-5", 5),
        (None, None), ("9" * 30, None), ("a,5", None),
    ], "t string", numbers.as_int(F.col("t")))
    check(spark, [(-5, None), (7, 7), (0, None)], "t int", numbers.positive(F.col("t")))
    check(spark, [(["12 m"], 12), ([], None), (None, None)], "t array<string>", numbers.first_int(F.col("t")))


def test_iso_date(spark):
    check(spark, [
        ("2024-05-06T10:00:00Z", "2024-05-06"), ("1700000000", "2023-11-14"), ("2024", ""), ("20240506", "1970-08-23"),
        ("1700000000000", ""), (None, ""), ("", ""), ("  2024-05-06", "2024-05-06"), ("May 2024", ""),
        ("9" * 25, ""), ("-1700000000", ""), ("1_700_000_000", "2023-11-14"),
    ], "t string", dates.iso_date(F.col("t")))
    check(spark, [("1700000000000", "2023-11-14")], "t string", dates.iso_date(F.col("t"), "ms"))
    assert values(spark, [("2024-13-45",)], "t string", dates.feed_date(F.col("t"))) == [None]


def test_rfc822_date(spark):
    check(spark, [
        ("Mon, 06 May 2024 10:00:00 +0000", "2024-05-06"), ("6 May 2024 23:30:00 -0800", "2024-05-06"),
        ("Mon, 06 May 24 10:00 GMT", "2024-05-06"), ("Sat, 06 May 78 10:00:00 GMT", "1978-05-06"),
        ("06 May 2024", ""), ("31 Feb 2024 10:00:00 +0000", ""), ("06 May 2024 25:00:00 +0000", ""), ("soon", ""), (None, ""),
    ], "t string", dates.rfc822_date(F.col("t")))


def test_company_title(spark):
    t = F.col("t")
    check(spark, [("Acme: Dev: Lead", "Acme|Dev: Lead"), ("Dev", "|Dev"), (": Dev", "|Dev"), ("Acme:", "|Acme:")],
          "t string", F.concat_ws("|", labels.company_of(t), labels.title_of(t)))
    check(spark, [("wildlifestudios", "Wildlife Studios"), ("stripe", "Stripe"), ("open-ai", "Open-Ai"), ("a1b", "A1B")],
          "t string", labels.company_from_slug(t))


def test_job_keys(spark):
    check(spark, [
        (("Analista de Dados Sênior", "Ação S.A."), "de dados|acao s a"), (("Jr. Engineer 2", "X"), "engineer|x"),
        ((None, None), "|"), (("Home  Office Dev", "ﬁrm №1"), "dev|firm no1"),
    ], "t string, c string", keys.job_dedupe_key(F.col("t"), F.col("c")))
    check(spark, [(("s", "7", "u"), "s:7"), (("s", "", "u"), "s:u"), (("s", None, "u"), "s:u")],
          "s string, n string, u string", keys.job_uid(F.col("s"), F.col("n"), F.col("u")))


def test_property_type(spark):
    check(spark, [
        (("Sítio em Atibaia", "FARM"), "Sítio"), (("Fazenda e haras", "FARM"), "Fazenda"),
        (("Rancho beira rio", "HOME"), "Chácara"), (("Chácara com área verde", "FARM"), "Chácara"),
        (("Terreno 5.000m²", "HOME"), "Terreno"), (("Linda casa", "home"), "Casa com terreno"), (("Casa", "XYZ"), "Chácara"),
        ((None, None), "Chácara"), (("Áreas", "HOME"), "Casa com terreno"), (("ÁREA", "HOME"), "Terreno"),
    ], "t string, u string", taxonomy.property_type(F.col("t"), F.col("u")))


def test_features(spark):
    check(spark, [
        (("Casa", "piscina e pomar, Wi-Fi, açude", ["gourmet_balcony"]),
         ["Piscina", "Lago ou represa", "Área gourmet", "Pomar", "Internet"]),
        (("Poço", None, None), ["Poço ou nascente"]), (("x", "riozinho", ["AIR_CONDITIONING", None]), ["Ar-condicionado"]),
        (("x", "quadra poliesportiva, mina d água, mina dagua, placa solar", []), ["Poço ou nascente", "Campo ou quadra", "Energia solar"]),
        (("x", "a" * 2495 + " piscina", []), ["Piscina"]), ((None, None, None), []),
    ], "t string, d string, a array<string>", taxonomy.features(F.col("t"), F.col("d"), F.col("a")))
    check(spark, [(("x", "a" * 2495 + " piscina", []), [])], "t string, d string, a array<string>",
          taxonomy.features(F.col("t"), F.col("d"), F.col("a"), text_length=2500))


def test_distance(spark):
    km = geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))
    got = values(spark, [(1.0, 2.0, 1.0, 2.0), (0.0, 0.0, 1.0, 0.0), (None, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 180.0)],
                 "a double, b double, c double, d double", F.round(km, 3))
    assert got == [0.0, 111.195, None, 20015.087]
    check(spark, [(25.0, "até 25 km"), (25.01, "25–50 km"), (200.0, "150–200 km"), (200.1, ""), (None, "")],
          "k double", geo.distance_band(F.col("k")))
    check(spark, [((0.0, 0.0), False), ((0.0, 1.0), True), ((91.0, 0.0), False), ((None, 1.0), False), ((1.0, -181.0), False)],
          "a double, b double", geo.usable_point(F.col("a"), F.col("b")))


def test_listing_scores(spark):
    check(spark, [
        ((-22.90991, -47.06264, 6500, 10500, 0), "-22.91,-47.063|6|10"), ((-22.9, -47.0, 6500, 10500, 1), ""),
        ((None, -47.0, 1, 1, 0), ""), ((1.0, 2.0, None, None, None), "1.0,2.0|0|0"),
    ], "a double, o double, l int, r int, x int",
        keys.listing_dedupe_key(F.col("a"), F.col("o"), F.col("l"), F.col("r"), F.col("x")))
    check(spark, [((10000, 6000), 1.667), ((10000, 99), None), ((None, 500), None), ((0, 500), None)],
          "r int, l int", scores.price_per_m2(F.col("r"), F.col("l")))
    check(spark, [((6000, 4000), 1), ((14001, 4000), 0), ((14000, 3999), 0), ((None, 5000), 0), ((7000, None), 0)],
          "r int, l int", scores.is_match(F.col("r"), F.col("l")))


def test_leads(spark):
    score = scores.digital_score(*[F.col(c) for c in "wprv"])
    check(spark, [
        ((True, True, 4.0, 50), "100 benchmark"), ((True, False, 3.9, 49), "30 hot lead"), ((False, True, None, 50), "40 hot lead"),
        ((True, True, None, None), "55 established"), ((True, True, None, 50), "70 established"), ((True, None, 4.5, 60), "75 benchmark"),
    ], "w boolean, p boolean, r double, v int", F.concat_ws(" ", score, scores.digital_tier(score)))


def test_pixels_need_the_install_snippet(spark):
    check(spark, [
        ("<script>fbq( 'init', '1')</script>", ["Meta Pixel"]), ("<p>Meta Pixel, Hotjar, Google Ads</p>", []), (None, None),
        ("src=https://www.googletagmanager.com/gtag/js?id=G-1 s.pinimg.com/ct/core.js", ["Google Analytics", "Pinterest Tag"]),
        ("ttq.load('x'); _linkedin_partner_id = 1; clarity.ms/tag/1", ["TikTok Pixel", "LinkedIn Insight", "Microsoft Clarity"]),
    ], "h string", taxonomy.pixels(F.col("h")))


def test_prices(spark):
    check(spark, [(None, "Sob consulta"), (1234.5, "R$\u00a01.234,50"), (0.0, "R$\u00a00,00")], "p double", scores.price_label(F.col("p")))
    label = scores.basket_label(F.col("t"), F.col("o"), F.col("n"))
    check(spark, [((0.0, False, 0), "—"), ((0.0, True, 1), "A combinar"), ((5.0, True, 2), "R$\u00a05,00 + a combinar"),
                  ((5.0, False, 2), "R$\u00a05,00")], "t double, o boolean, n int", label)


def test_risk_flag_treats_unknown_as_ok(spark):
    check(spark, [(None, "OK"), (0.29, "OK"), (0.30, "WARN"), (0.45, "BREACH")], "v double", scores.risk_flag(F.col("v")))


STRIPPED = [
    "<p>Fish &amp; chips</p>", "a&lt;b&gt;c", "&amp;lt; stays", "caf&eacute; &#33; &#x1F600; &copy2", "&notanentity; &ampx", "a \t\n b&nbsp;&nbsp;c",
    "  <b>x</b>  ", "&#0; &#128; &#xD800;", "tags <a\nhref='x'>y</a>", "", None, "&", "&&lt;;", "&quot;q&quot; &apos;a&apos; &#39;",
]


def python_strip(s: str | None) -> str:
    """The rule in plain Python: tags, references, whitespace runs, ends."""
    import re

    s = html.unescape(re.sub(r"<[^>]+>", " ", s or ""))
    return re.sub(r"\s{2,}", " ", s).strip()


def test_strip_html(spark):
    got = values(spark, [(s,) for s in STRIPPED], "s string", text.strip_html(F.col("s")))
    assert got == [python_strip(s) for s in STRIPPED]


def test_scrub(spark):
    check(spark, [
        ("mail a.b+c@d-e.com.br, (19) 3232-1010", "mail [email], [phone]"), ("see HTTPS://x.y/z?a=b and www.q.com", "see [link] and [link]"),
        ("+55 11 91234-5678", "[phone]"), ("id 1234567", "id 1234567"), ("12345678901234567890", "[phone][phone]"), (None, ""),
        ("joão@ção.com", "[email]"), ("1234 5678 e a@b", "[phone] e a@b"),
    ], "s string", text.scrub_contacts(F.col("s")))


def test_fold_matches_compatibility_decomposition(spark):
    samples = ["Ação ÜBER ñ", "ﬁ ½ № ™ … ² ª º", "①⑴㎏ Ⅷ", "日本 ひらがな", "", None, "ÆŒßø", "Ａｂｃ", "x́y", "Ǆ ĳ ŉ ¨ ¾", "𝒜𝟘", "´¸¯"]
    want = [unicodedata.normalize("NFKD", s or "").encode("ascii", "ignore").decode().lower() for s in samples]
    assert values(spark, [(s,) for s in samples], "s string", text.fold_accents(F.col("s"))) == want


def test_fold_every_character(spark):
    chars = [chr(c) for c in range(1, 0x2FFFF) if not 0xD800 <= c <= 0xDFFF and unicodedata.decomposition(chr(c))]
    blocks = ["".join(chars[i:i + 200]) for i in range(0, len(chars), 200)]
    want = [unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode().lower() for s in blocks]
    assert values(spark, [(s,) for s in blocks], "s string", text.fold_accents(F.col("s"))) == want


@pytest.mark.parametrize("pattern, word", [
    (r"\bdata\b", "data"), ("plain", "plain"), (r"wi-?fi", "wi"), (r"placas? solar", " solar"), (r"a[çc]ude", "ude"),
    (r"quadra (poli)?esportiva", "esportiva"), (r"\b(a|b)\b", ""), (r"x\.y", "x"),
])
def test_needed_word(pattern, word):
    assert taxonomy._needed_word(pattern) == word


def test_alternatives_ignore_groups_classes_and_escapes():
    assert taxonomy._alternatives(r"a(b|c)|d[|]|e\|f|\(g|h") == ["a(b|c)", "d[|]", r"e\|f", r"\(g", "h"]


def test_small_texts(spark):
    check(spark, [((["a", "b"],), "a · b"), ((None,), ""), ((list("abcdefgh"),), "a · b · c · d · e · f")],
          "s array<string>", text.skills_join(F.col("s")))
    check(spark, [(("A b", "C"), "a b c"), ((None, "X"), " x")], "t string, c string", text.search_text(F.col("t"), F.col("c")))
    check(spark, [((5, "M"), "5::M"), ((5, None), "5::")], "p int, v string", keys.cart_key(F.col("p"), F.col("v")))


def test_words_are_only_taken_where_a_match_must_hold_them():
    for pattern in ("colou{0,1}r", "(?i)track", "(a(bcdef)?gh)?x", "(?:foo(?:bar)?baz)?q", r"\Qa|b\E"):
        assert [t["word"] for t in taxonomy._tests(pattern)] == [""], pattern
    assert [t["word"] for t in taxonomy._tests(r"gtag\(|fbq")] == ["gtag", "fbq"]
    assert taxonomy._lowered(r"C\+\+\W\p{L}") == r"c\+\+\W\p{L}"


def test_area_keeps_the_case_of_escapes(spark):
    frame = spark.createDataFrame([("C++ daily",), ("c++x",)], "t string")
    found = frame.select("t", taxonomy.area(F.col("t"), keywords={"cpp": (r"C\+\+\W",)}, category_labels={}).alias("a")).collect()
    assert {r.t: r.a for r in found} == {"C++ daily": "cpp", "c++x": "other"}


def test_every_reference_is_decoded_as_the_standard_says(spark):
    from html.entities import html5

    texts = [f"&{name}" for name in html5] + [f"a&{name}x &{name}; &{name}=1" for name in html5 if not name.endswith(";")]
    numbers = [*range(0x200), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFEFF, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000,
               0x1F600, 0x1FFFD, 0x1FFFE, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000, 10**9, 10**30, *range(0x300, 0x10FFFF, 9973)]
    texts += [f"&#{n};" for n in numbers] + [f"&#x{n:x}z" for n in numbers] + [f"&#X000{n:X};" for n in numbers]
    texts += ["&", "&&", "&#", "&#;", "&#x;", "&#xg", "&;", "& lt;", "&lt", "&ltx;", "&notit;", "&notin;", "&amp;lt;", "&amp;#65;", "&é;", "x&#65", "&\n",
              "&" + "a" * 40 + ";", "&CounterClockwiseContourIntegral;", "&#0000000000065;", "&lt&gt&#65&bogus;&eacute;", "&AMP;&aMp;", None, ""]
    check(spark, [(t, None if t is None else html.unescape(t)) for t in texts], "t string", text.unescape_entities(F.col("t")))
    plan = spark.range(1).select(text.strip_html(F.lit("x").cast("string"))).select("*")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
