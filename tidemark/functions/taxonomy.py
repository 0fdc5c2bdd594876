"""Keyword taxonomies as data, and the expressions that apply them.

A pattern is split into its alternatives. All whole words (`\\bword\\b`) of a taxonomy
are found in one pass over the text and looked up in a constant map. Plain
alternatives, and the plain word that any other cannot match without, are substring
tests; phrases that hold a shorter one are only looked for where that occurs. A
regex runs only on texts that hold its word, and is a constant, compiled once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import constant_map, fold_accents, let, start_of

# Labels and patterns the classification must agree with.
SENIORITY_PATTERNS = (
    ("internship", r"est[aá]gi|trainee|intern(ship)?|aprendiz|\bstage\b"),
    ("junior", r"j[uú]nior|\bjr\b|entry[- ]?level|\bi\b\s*$"),
    ("mid-level", r"pleno|\bpl\b|mid[- ]?level|\bmid\b|\bii\b\s*$"),
    ("senior", r"s[eê]nior|\bsr\b|\bsenior\b|\biii\b\s*$"),
    ("lead/management", r"especialista|coordenador|gerente|\blead\b|principal|"
                        r"staff|head|diretor|director|manager|supervisor|\bvp\b|chefe"),
)
LEVEL_LABELS = {
    "internship": "internship", "entry level": "junior", "mid level": "mid-level",
    "senior level": "senior", "management": "lead/management",
}
NO_SENIORITY = "n/a"

AREA_KEYWORDS = {
    "data": ("analista de dados", "cientista de dados", "data analyst", "data scientist",
             "data engineer", "engenheiro de dados", "business intelligence", " bi ",
             "power bi", "analytics", "machine learning", "estatística", r"\betl\b",
             r"\bsql\b", "dados", r"\bdata\b", "big data", "data science"),
    "software engineering": (
        "desenvolvedor", "developer", "software engineer", "engenheiro de software",
        "backend", "back-end", "frontend", "front-end", "full stack", "fullstack",
        "full-stack", "programador", "devops", r"\bsre\b", r"\bqa\b", "quality assurance",
        "tester", "mobile", r"\bandroid\b", r"\bios\b", r"\bjava\b", "python", "react",
        "node", r"\b.net\b", "cloud", "infra"),
    "product": ("product manager", "gerente de produto", "product owner", r"\bpo\b",
                r"\bpm\b", "produto", "product designer"),
    "design": ("designer", r"\bux\b", r"\bui\b", "ux/ui", "user experience", "design"),
    "marketing": ("marketing", "growth", r"\bseo\b", "mídia", r"\bads\b", "conteúdo",
                  "social media", "brand", "comunicação", "publicidade"),
    "sales": ("vendas", r"\bsales\b", "comercial", r"\bsdr\b", r"\bbdr\b",
              "account executive", "business development", "pré-vendas", "representante"),
    "finance": ("financeiro", "finance", "contábil", "contabil", "controladoria",
                "accounting", "fp&a", "tesouraria", "fiscal", "auditor"),
    "operations": ("operações", "operations", "logística", "supply", r"\bops\b",
                   "processos", r"\bpcp\b", "produção"),
    "hr": ("recursos humanos", r"\brh\b", "people", "talent", "recrutador", "recruiter",
           "human resources", r"\bdp\b", "departamento pessoal"),
    "customer support": (
        "customer success", "customer support", "customer experience", "suporte",
        "atendimento", r"\bcs\b", "success", "help desk", "helpdesk"),
}
CATEGORY_LABELS = {
    "data": "data", "data science": "data", "analytics": "data",
    "software development": "software engineering", "development": "software engineering",
    "engineering": "software engineering", "devops and sysadmin": "software engineering",
    "system administration": "software engineering", "qa": "software engineering",
    "product": "product", "design": "design", "marketing": "marketing",
    "sales": "sales", "sales and marketing": "sales", "finance": "finance",
    "finance and legal": "finance", "human resources": "hr", "hr": "hr",
    "customer service": "customer support", "customer support": "customer support",
    "all others": "other", "business": "other", "management": "other",
}
TITLE_WEIGHT, DESCRIPTION_WEIGHT, AREA_MIN_SCORE = 3, 1, 3
NO_AREA = "other"

# Property types by the portal's unit type, and the title patterns that come first.
UNIT_TYPE_LABELS = {
    "FARM": "Chácara", "COUNTRY_HOUSE": "Chácara", "ALLOTMENT_LAND": "Terreno",
    "HOME": "Casa com terreno", "RESIDENTIAL_ALLOTMENT_LAND": "Terreno",
}
DEFAULT_PROPERTY_TYPE = "Chácara"
# matched on accent-folded titles
PROPERTY_PATTERNS = (
    ("Fazenda", r"\bfazenda|\bharas\b"),
    ("Sítio", r"\bs[ií]tio"),
    ("Chácara", r"\bch[aá]cara|\bran(cho|char)"),
    ("Terreno", r"\b(terreno|[aá]rea|lote|gleba)\b"),
)

# Feature labels by the portal's amenity code, by pattern, and their display order.
AMENITY_LABELS = {
    "POOL": "Piscina", "PRIVATE_POOL": "Piscina", "SWIMMING_POOL": "Piscina",
    "BARBECUE_GRILL": "Área gourmet", "PIZZA_OVEN": "Área gourmet",
    "GOURMET_BALCONY": "Área gourmet", "GOURMET_SPACE": "Área gourmet",
    "PARTY_HALL": "Área gourmet",
    "FOOTBALL_FIELD": "Campo ou quadra", "SPORTS_COURT": "Campo ou quadra",
    "TENNIS_COURT": "Campo ou quadra", "PLAYGROUND": "Campo ou quadra",
    "FIREPLACE": "Lareira", "FURNISHED": "Mobiliada",
    "SECURITY_CAMERA": "Segurança", "ELECTRONIC_GATE": "Segurança",
    "24H_CONCIERGE": "Segurança", "GATED_COMMUNITY": "Segurança",
    "ALARM_SYSTEM": "Segurança", "SECURITY_24H": "Segurança",
    "INTERNET_ACCESS": "Internet", "AIR_CONDITIONING": "Ar-condicionado",
    "LAKE": "Lago ou represa", "ARTESIAN_WELL": "Poço ou nascente",
}
# matched on accent-folded text
FEATURE_PATTERNS = {
    "Piscina": r"piscina",
    "Área gourmet": r"[aá]rea gourmet|churrasqueira|forno de pizza|espa[çc]o gourmet|sal[ãa]o de festas",
    "Poço ou nascente": r"po[çc]o artesiano|\bpo[çc]o\b|nascente|mina d'?[aá]gua|[aá]gua de mina",
    "Lago ou represa": r"\blago\b|lagoa|represa|a[çc]ude|tanque de peixe|pesqueiro",
    "Rio ou córrego": r"\brio\b|c[oó]rrego|riacho|beira[- ]rio|cachoeira",
    "Casa de caseiro": r"caseiro|casa de caseiro|casa do caseiro|zelador",
    "Pomar": r"\bpomar\b|[aá]rvores frut[ií]feras|frut[ií]feras",
    "Baias ou haras": r"\bbaia[s]?\b|cocheira|\bharas\b|estrebaria|para cavalos|piquete",
    "Campo ou quadra": r"campo de futebol|quadra (poli)?esportiva|quadra de t[êe]nis",
    "Lareira": r"lareira",
    "Mobiliada": r"mobiliad[oa]|semi[- ]mobiliad[oa]",
    "Segurança": r"condom[ií]nio fechado|portaria 24|seguran[çc]a 24|guarita",
    "Internet": r"internet|fibra [oó]ptica|\bwi-?fi\b",
    "Energia solar": r"energia solar|placas? solar|fotovoltaic",
    "Heliponto": r"helipont",
}
FEATURE_ORDER = (
    "Piscina", "Poço ou nascente", "Lago ou represa", "Rio ou córrego", "Área gourmet",
    "Casa de caseiro", "Pomar", "Baias ou haras", "Campo ou quadra", "Lareira", "Mobiliada",
    "Segurança", "Internet", "Ar-condicionado", "Energia solar", "Heliponto",
)

# Install signatures of the nine trackers, from their public setup snippets.
PIXEL_SIGNATURES = {
    "Meta Pixel": r"connect\.facebook\.net/[a-zA-Z_]+/fbevents\.js|fbq\(\s*['\"]init['\"]",
    "Google Analytics": r"googletagmanager\.com/gtag/js\?id=(?:G|UA)-|google-analytics\.com/(?:analytics|ga)\.js",
    "Google Tag Manager": r"googletagmanager\.com/gtm\.js|googletagmanager\.com/ns\.html\?id=GTM-",
    "Google Ads": r"googletagmanager\.com/gtag/js\?id=AW-|googleadservices\.com/pagead/conversion",
    "TikTok Pixel": r"analytics\.tiktok\.com/i18n/pixel/events\.js|ttq\.load\(",
    "LinkedIn Insight": r"snap\.licdn\.com/li\.lms-analytics/insight|_linkedin_partner_id",
    "Hotjar": r"static\.hotjar\.com/c/hotjar-|_hjSettings",
    "Pinterest Tag": r"s\.pinimg\.com/ct/core\.js|pintrk\(\s*['\"]load['\"]",
    "Microsoft Clarity": r"clarity\.ms/tag/",
}

def _alternatives(pattern: str) -> list[str]:
    """Parts of a pattern between its top-level `|`; one part where quoting or a flag spans them."""
    if re.search(r"\\Q|\(\?[^:]", pattern):
        return [pattern]
    parts, depth = [""], 0
    for token in re.findall(r"\\.|\[[^\]]*\]|.", pattern, re.S):
        depth += (token == "(") - (token == ")")
        if token == "|" and depth == 0:
            parts.append("")
        else:
            parts[-1] += token
    return parts


def _needed_word(alternative: str) -> str:
    """Longest plain text every match must hold: no escapes, groups, classes, optional characters.

    Empty, so that the regex decides alone, where counts, flags, quoting or nested groups would
    take a parser to be sure.
    """
    if re.search(r"\{|\(\?[^:]|\\[QE]|\([^)]*\(", alternative):
        return ""
    gap = "\0"
    for piece in (r"\\.[?*+]?", r"\[[^\]]*\][?*+]?", r"\([^)]*\)[?*+]?", r".[?*]", r"[.^$+]"):
        alternative = re.sub(piece, gap, alternative)
    return max(alternative.split(gap), key=len)


def _test(alternative: str) -> dict[str, str | None]:
    word = _needed_word(alternative)
    return {"word": word, "regex": None if word == alternative else "(?U)" + alternative}


def _tests(pattern: str) -> list[dict[str, str | None]]:
    return [_test(a) for a in _alternatives(pattern)]


def _lowered(pattern: str) -> str:
    """Literal letters in lower case; escapes such as `\\W` and `\\p{L}` keep theirs."""
    return re.sub(r"\\[pP]\{[^}]*\}|\\.|[^\\]", lambda m: m[0] if m[0][0] == "\\" else m[0].lower(), pattern, flags=re.S)


def _folded(pattern: str) -> str:
    """The pattern for accent-folded text, where a letter's accented twin cannot occur."""
    return re.sub(
        r"\[([^\]]*)\]",
        lambda m: m[0] if m[1].isascii() else m[1].encode("ascii", "ignore").decode(), pattern,
    )


def _tree(phrases: Iterable[str]) -> str:
    """A regex for the longest of the phrases at a place: common starts are tried once."""
    heads: dict[str, list[str]] = {}
    for phrase in sorted(set(phrases)):
        if phrase:
            heads.setdefault(phrase[0], []).append(phrase[1:])
    branches = []
    for head, rests in heads.items():
        tail = _tree(rests)
        if tail and ("|" in tail or "" in rests):
            tail = f"(?:{tail})" + ("?" if "" in rests else "")
        branches.append(re.escape(head) + tail)
    return "|".join(branches)


class Index:
    """The phrases and regexes of numbered patterns."""

    def __init__(self, patterns: Iterable[str]):
        self.plain: dict[str, set[int]] = {}
        self.whole: dict[str, set[int]] = {}
        self.asked: dict[str, set[int]] = {}  # phrase: places in `regexes`
        self.regexes: list[tuple[int, str]] = []
        self.always: list[tuple[int, str]] = []  # regexes that no word can be named for
        for number, pattern in enumerate(patterns):
            for alternative in _alternatives(pattern):
                bounded = re.fullmatch(r"\\b([^\W_]+)\\b", alternative)
                test = _test(alternative)
                if bounded:
                    self.whole.setdefault(bounded[1], set()).add(number)
                elif not test["word"]:
                    self.always.append((number, test["regex"] or ""))
                elif test["regex"] is None:
                    self.plain.setdefault(test["word"], set()).add(number)
                else:
                    self.asked.setdefault(test["word"], set()).add(len(self.regexes))
                    self.regexes.append((number, test["regex"]))

    def _phrases(self) -> list[dict]:
        """The shortest phrases with what they tell, and under each the phrases that hold it.

        A number from 0 on is a pattern that occurs, one below a regex that is asked for.
        """
        def marks(phrase: str) -> list[int]:
            return sorted({*self.plain.get(phrase, ()), *(-1 - n for n in self.asked.get(phrase, ()))})

        groups: dict[str, dict] = {}
        for phrase in sorted({*self.plain, *self.asked}, key=lambda p: (len(p), p)):
            root = next((r for r in groups if r in phrase), None)
            if root is None:
                groups[phrase] = {"word": phrase, "marks": marks(phrase), "longer": []}
            else:
                groups[root]["longer"].append({"word": phrase, "marks": marks(phrase)})
        return list(groups.values())

    def _phrases_in(self, text: Column) -> Column:
        longer = "array<struct<word: string, marks: array<int>>>"
        groups = F.from_json(F.lit(json.dumps(self._phrases())), f"array<struct<word: string, marks: array<int>, longer: {longer}>>")

        def present(entries: Column) -> Column:
            return F.filter(entries, lambda e: F.contains(text, e["word"]))

        return F.flatten(F.transform(present(groups), lambda g: F.concat(
            g["marks"], F.flatten(F.transform(present(g["longer"]), lambda e: e["marks"])))))

    def _words_in(self, text: Column) -> Column:
        table = F.from_json(F.lit(json.dumps({w: sorted(n) for w, n in self.whole.items()})), "map<string,array<int>>")
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?U)\b({_tree(self.whole)})\b"), 1))
        return F.flatten(F.transform(found, lambda word: F.try_element_at(table, word)))

    def hits(self, text: Column) -> Column:
        """Numbers of the patterns that occur in a text, each once."""
        none = F.array().cast("array<int>")
        parts = ([self._phrases_in(text)] if self.plain or self.asked else []) + ([self._words_in(text)] if self.whole else [])

        def settled(marks: Column) -> Column:
            ran = [
                F.when(F.array_contains(marks, -1 - k), F.when(F.rlike(text, F.lit(regex)), number))
                for k, (number, regex) in enumerate(self.regexes)
            ] + [F.when(F.rlike(text, F.lit(regex)), number) for number, regex in self.always]
            sure = F.filter(marks, lambda m: m >= 0)
            return F.array_distinct(F.concat(sure, F.array_compact(F.array(*ran))) if ran else sure)

        return let(F.coalesce(F.concat(*parts), none) if parts else none, settled)


def _first_label(text: Column, patterns: Iterable[tuple[str, str]]) -> Column:
    """Label of the first of (label, pattern) that occurs, else NULL."""
    rules = list(patterns)
    labels = F.array(*[F.lit(label) for label, _ in rules])
    return let(text, lambda t: F.get(labels, F.array_min(Index(p for _, p in rules).hits(t))))


def _lookup(labels: dict[str, str], key: Column) -> Column:
    return F.try_element_at(constant_map(labels), key)


def _first_mapped(hints: Column, labels: dict[str, str], clean: Callable[[Column], Column]) -> Column:
    """Label of the first hint the mapping knows, else NULL."""
    mapped = F.transform(hints, lambda h: _lookup(labels, clean(h)))
    return F.get(F.filter(mapped, lambda m: m.isNotNull()), F.lit(0))


def _clean_hint(hint: Column) -> Column:
    return F.lower(F.trim(hint))


def seniority(title: Column, levels: Column | None = None) -> Column:
    """Structured level first; else the patterns, most senior one first; else `n/a`."""
    padded = F.concat(F.lit(" "), F.lower(F.coalesce(title, F.lit(""))), F.lit(" "))
    label = F.coalesce(_first_label(padded, reversed(SENIORITY_PATTERNS)), F.lit(NO_SENIORITY))
    if levels is None:
        return label
    return F.coalesce(_first_mapped(levels, LEVEL_LABELS, _clean_hint), label)


def area(
    title: Column,
    description: Column | None = None,
    categories: Column | None = None,
    keywords: dict[str, tuple[str, ...]] = AREA_KEYWORDS,
    category_labels: dict[str, str] = CATEGORY_LABELS,
    description_length: int | None = None,
) -> Column:
    """Structured category first; else the best-scoring keyword area, ties to the earlier one.

    A pattern counts once per text, however many of its alternatives occur. Of the description
    the first `description_length` characters count, or all of it.
    """
    index = Index(_lowered(p) for patterns in keywords.values() for p in patterns)
    padded = F.concat(F.lit(" "), F.coalesce(title, F.lit("")), F.lit(" "))
    texts = [index.hits(F.lower(padded)).alias("title")]
    if description is not None:
        lead = start_of(F.coalesce(description, F.lit("")), description_length)
        texts.append(let(F.lower(lead), index.hits).alias("lead"))

    def score(found: Column, numbers: list[int]) -> Column:
        own = F.array(*[F.lit(n) for n in numbers])
        total = TITLE_WEIGHT * F.size(F.array_intersect(found["title"], own))
        if description is not None:
            total = total + DESCRIPTION_WEIGHT * F.size(F.array_intersect(found["lead"], own))
        return total

    def best(found: Column) -> Column:
        scores, at = [], 0
        for rank, (name, patterns) in enumerate(keywords.items()):
            numbers = list(range(at, at + len(patterns)))
            at += len(patterns)
            scores.append(F.struct(score(found, numbers).alias("score"), F.lit(-rank).alias("rank"), F.lit(name).alias("area")))
        return F.array_max(F.array(*scores))

    label = let(let(F.struct(*texts), best), lambda b: F.when(b["score"] >= AREA_MIN_SCORE, b["area"]).otherwise(NO_AREA))
    if categories is None:
        return label
    return F.coalesce(_first_mapped(categories, category_labels, _clean_hint), label)


def property_type(title: Column, unit_type: Column) -> Column:
    """First title pattern that matches, else the portal's unit type, else the default."""
    patterns = [(name, _folded(p)) for name, p in PROPERTY_PATTERNS]
    by_unit = _lookup(UNIT_TYPE_LABELS, F.upper(F.coalesce(unit_type, F.lit(""))))
    return F.coalesce(_first_label(fold_accents(title), patterns), by_unit, F.lit(DEFAULT_PROPERTY_TYPE))


def features(title: Column, description: Column, amenities: Column, text_length: int | None = None) -> Column:
    """Amenity labels found in the portal's list or the text (its start, if cut), in display order."""
    by_text = [label for label in FEATURE_ORDER if label in FEATURE_PATTERNS]
    index = Index(_folded(FEATURE_PATTERNS[label]) for label in by_text)
    text = F.concat(fold_accents(title), F.lit(" "), start_of(fold_accents(description), text_length))
    listed = F.transform(
        F.coalesce(amenities, F.array().cast("array<string>")),
        lambda a: F.upper(F.coalesce(a, F.lit(""))),
    )
    labels = F.array(*[F.lit(label) for label in by_text])
    told = F.transform(let(text, index.hits), lambda n: F.get(labels, n))
    mapped = F.transform(listed, lambda a: _lookup(AMENITY_LABELS, a))
    found = F.concat(told, mapped)
    return F.array_intersect(F.array(*[F.lit(label) for label in FEATURE_ORDER]), found)


def pixels(page: Column, signatures: dict[str, str] = PIXEL_SIGNATURES) -> Column:
    """Names of the trackers whose install signature occurs in the page."""
    index = Index(signatures.values())
    names = F.array(*[F.lit(name) for name in signatures])
    found = F.transform(F.array_sort(index.hits(page)), lambda n: F.get(names, n))
    return F.when(page.isNotNull(), found)
