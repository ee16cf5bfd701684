"""Text functions as column expressions; all run in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UNICODE_SPACE = r"(?U)\s+"
#: Fixed value: every blank of Unicode's class Zs, which SQL's trim takes away.
BLANKS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row, also inside branches."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(text: Column) -> Column:
    """Whitespace-separated tokens; null and blank have none."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), UNICODE_SPACE), lambda w: w != ""))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, UNICODE_SPACE, " "))


def tidy(text: Column) -> Column:
    """ASCII whitespace collapsed and all blanks trimmed; characters stay as they are written."""
    return F.btrim(F.regexp_replace(text, r"[ \t\n\f\r]+", " "), F.lit(BLANKS))


def strip_html(html: Column) -> Column:
    """Markup to text: scripts and styles go, tags become spaces, four entities are decoded in
    this order (so a doubly escaped bracket is decoded twice), numeric ones are dropped."""
    out = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", "")
    out = F.regexp_replace(out, r"(?is)<style[^>]*>.*?</style>", "")
    out = F.regexp_replace(out, "<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return collapse_space(F.regexp_replace(out, r"&#\d+;", ""))


def plain(markup: Column) -> Column:
    """The text of an element's markup: tags become spaces, brackets and ampersands are decoded
    once and all other references, also ones cut short, stay as they are written."""
    out = F.regexp_replace(markup, "<[^>]+>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(out, r"[ \t\n\f\r]+", " "))


def collapse_newlines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def normalise_url(url: Column) -> Column:
    return F.rtrim(F.regexp_replace(url, "(?s)#.*$", ""), F.lit("/"))


def url_hash(url: Column) -> Column:
    return F.sha2(normalise_url(url), 256)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def qa_hash(question: Column, answer: Column) -> Column:
    return F.sha2(F.concat(question, F.lit("|"), answer), 256)


def sanitise_filename(name: Column, longest: int = 200) -> Column:
    safe = F.regexp_replace(name, r'[<>:"/\\|?*]', "_")
    safe = F.substring(F.regexp_replace(safe, r"^[. ]+|[. ]+$", ""), 1, longest)
    return F.when(safe == "", "unnamed").otherwise(safe)


# Patterns of what forums leave in texts, in the order in which they are removed.
NOISE = (
    (r"(?i)\[[^\]\n]{0,60}\|\s*score[^\]\n]*\]", " "),
    (r"(?i)(?<![A-Za-z0-9])/?[ur]/[A-Za-z0-9_-]+", " "),
    (r"(?i)\[(?:deleted|removed)\]", " "),
    (r"[ \t]{2,}", " "),
    (r"\n{3,}", "\n\n"),
)


def strip_noise(text: Column) -> Column:
    for pattern, by in NOISE:
        text = F.regexp_replace(text, pattern, by)
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


# Separators in order of preference.
CUT_AT = ("\n\n", ". ", "? ", "! ", "\n")


def truncate(text: Column, longest: int) -> Column:
    """At most ``longest`` characters, cut after the last separator that keeps over half."""
    window = F.substring(text, 1, longest)
    cuts = []
    for sep in CUT_AT:
        # Where the last one begins, from the end of the reversed window.
        back = F.instr(F.reverse(window), sep[::-1])
        start = F.length(window) - back - len(sep) + 1
        cuts.append(F.when((back > 0) & (start > longest // 2), window.substr(F.lit(1), start + len(sep))))
    cut = F.regexp_replace(F.coalesce(*cuts, window), r"(?U)\s+$", "")
    return F.when(F.length(text) <= longest, text).otherwise(cut)


# The vocabulary that raises a text's estimate.
TECHNICAL_TERMS = (
    "engine", "transmission", "brake", "suspension", "turbo", "diesel", "gasoline",
    "horsepower", "torque", "fuel", "mph", "hp", "cc", "cylinder",
    "automatic", "manual", "clutch", "radiator", "coolant",
    "filter", "brake pad", "shock absorber", "wheel bearing", "tire", "wheel",
    "abs", "traction control", "airbag", "alternator", "starter",
    "injector", "exhaust", "catalytic converter", "intercooler",
    "valve", "camshaft", "crankshaft", "piston", "head gasket",
    "timing belt", "timing chain", "serpentine belt", "oil change",
    "obd", "check engine", "misfire", "spark plug", "dtc",
)


def term_hits(text: Column, terms: tuple[str, ...] = TECHNICAL_TERMS) -> Column:
    """How many of the terms occur in a lower-cased text."""
    return let(F.lower(text), lambda low: sum((F.contains(low, F.lit(t)).cast("int") for t in terms), F.lit(0)))


def content_quality(text: Column, words: Column | None = None, hits: Column | None = None) -> Column:
    """Estimate between 0 and 1 from the number of words and of technical terms, which are counted
    unless given."""
    n = word_count(text) if words is None else words
    base = F.when(n < 50, 0.2).when(n < 200, 0.4).when(n < 500, 0.6).otherwise(0.8)
    full = F.least(F.lit(1.0), base + F.least(F.lit(0.2), (term_hits(text) if hits is None else hits) * 0.02))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, 0.0).when(n < 20, 0.1).otherwise(full)


# Brands in order of preference with their models.
VEHICLES = {
    "Toyota": ["Camry", "Corolla", "RAV4", "Tacoma", "Highlander", "Prius", "Tundra", "Sienna", "Avalon", "Venza", "4Runner", "Sequoia", "Land Cruiser"],
    "Honda": ["Civic", "Accord", "CR-V", "Pilot", "Odyssey", "HR-V", "Passport", "Ridgeline", "Fit", "Insight"],
    "Ford": ["F-150", "F-250", "F-350", "Escape", "Explorer", "Mustang", "Bronco", "Edge", "Expedition", "Ranger", "Fusion", "Focus", "Transit"],
    "Chevrolet": ["Silverado", "Equinox", "Malibu", "Traverse", "Tahoe", "Suburban", "Colorado", "Trax", "Blazer", "Camaro", "Corvette"],
    "Chevy": ["Silverado", "Equinox", "Malibu", "Traverse", "Tahoe", "Suburban"],
    "Nissan": ["Altima", "Rogue", "Sentra", "Pathfinder", "Frontier", "Murano", "Armada", "Maxima", "Versa", "Kicks", "Titan"],
    "Hyundai": ["Elantra", "Sonata", "Tucson", "Santa Fe", "Palisade", "Kona", "Ioniq", "Veloster", "Accent"],
    "Kia": ["Optima", "Sorento", "Sportage", "Telluride", "Stinger", "Soul", "Forte", "Seltos", "Niro", "K5"],
    "Subaru": ["Outback", "Forester", "Crosstrek", "Impreza", "Legacy", "Ascent", "WRX", "BRZ"],
    "Jeep": ["Wrangler", "Grand Cherokee", "Cherokee", "Compass", "Renegade", "Gladiator"],
    "BMW": ["328i", "330i", "530i", "540i", "X5", "X3", "X1", "3 Series", "5 Series", "7 Series", "M3", "M5", "M4"],
    "Volkswagen": ["Jetta", "Tiguan", "Atlas", "Passat", "Golf", "GTI", "ID.4", "Taos"],
    "VW": ["Jetta", "Tiguan", "Atlas", "Passat", "Golf", "GTI"],
    "Mercedes-Benz": ["C300", "E350", "GLC", "GLE", "C-Class", "E-Class", "S-Class", "A-Class", "GLS", "CLA"],
    "Mercedes": ["C300", "E350", "GLC", "GLE", "C-Class", "E-Class", "S-Class"],
    "Dodge": ["Ram 1500", "Charger", "Challenger", "Durango", "Journey"],
    "Ram": ["1500", "2500", "3500", "ProMaster"],
    "GMC": ["Sierra", "Terrain", "Acadia", "Yukon", "Canyon"],
    "Mazda": ["CX-5", "Mazda3", "CX-9", "MX-5", "Mazda6", "CX-30"],
    "Lexus": ["RX350", "RX450h", "IS300", "ES350", "GX460", "RX", "IS", "ES", "GX"],
    "Audi": ["A4", "Q5", "A3", "Q7", "Q3", "A6", "Q8", "TT", "e-tron"],
    "Tesla": ["Model 3", "Model Y", "Model S", "Model X", "Cybertruck"],
    "Acura": ["MDX", "RDX", "TLX", "ILX"],
    "Infiniti": ["QX60", "Q50", "QX80", "QX50"],
    "Mitsubishi": ["Outlander", "Eclipse Cross", "Galant", "Lancer"],
    "Volvo": ["XC90", "XC60", "S60", "V60", "XC40"],
    "Porsche": ["911", "Cayenne", "Macan", "Panamera", "Taycan"],
    "Cadillac": ["Escalade", "XT5", "CT5", "XT4"],
    "Buick": ["Enclave", "Encore", "LaCrosse"],
    "Lincoln": ["Navigator", "Aviator", "Corsair"],
    "Chrysler": ["300", "Pacifica", "Voyager"],
}


def _first_in(low: Column, names: list[str]) -> Column:
    return F.coalesce(*(F.when(F.contains(low, F.lit(n.lower())), n) for n in names), F.lit(""))


def vehicle_brand(text: Column) -> Column:
    """The first brand of the list that occurs anywhere in the text, else empty."""
    return let(F.lower(text), lambda low: _first_in(low, list(VEHICLES)))


def vehicle_model(text: Column, brand: Column) -> Column:
    """The first model of that brand that occurs in the text, else empty."""
    def model(low: Column) -> Column:
        return F.coalesce(*(F.when(brand == b, _first_in(low, models)) for b, models in VEHICLES.items()), F.lit(""))

    return let(F.lower(text), model)


def vehicle_year(text: Column) -> Column:
    return F.regexp_extract(text, r"\b(19[6-9]\d|20[0-3]\d)\b", 1)


# What a question must not lean on, and its least length.
LEAKS = (
    "the post", "the text", "the author", "the comment", "this post", "this text", "this comment", "the user",
    "the discussion", "the thread", "the article", "mentioned", "someone says", "the passage",
)
MIN_QUESTION, MIN_ANSWER = 60, 20


def acceptable_question(question: Column, shortest: int = MIN_QUESTION) -> Column:
    return (F.length(question) >= shortest) & ~F.regexp_like(question, F.lit(rf"(?i)\b({'|'.join(LEAKS)})\b"))


def acceptable_answer(answer: Column) -> Column:
    return F.length(F.regexp_replace(answer, r"(?U)^\s+|\s+$", "")) > MIN_ANSWER


# Signs of a page that stands before the real one.
CHALLENGE_MARKERS = ("just a moment", "cf-challenge", "enable javascript and cookies", "attention required", "cf-browser-verification")


def page_status(status: Column, html: Column, title: Column) -> Column:
    """403 and 503 count as 200 if neither title nor body has a sign of an interstitial page."""
    low = F.lower(F.concat_ws("\n", title, html))
    blocked = F.lit(False)
    for marker in CHALLENGE_MARKERS:
        blocked = blocked | F.contains(low, F.lit(marker))
    return F.when(status.isin(403, 503) & ~blocked, 200).otherwise(status)


def listing_links(links: Column, base: Column, page: Column, exclude: tuple[str, ...] = (), most: int = 80) -> Column:
    """The distinct links below ``base`` other than the page itself, in order; the first ``most``."""

    def keep(u: Column) -> Column:
        ok = F.contains(u, base) & (u != page)
        for part in exclude:
            ok = ok & ~F.contains(u, F.lit(part))
        return ok

    return F.slice(F.array_distinct(F.filter(links, keep)), 1, most)


# Parts of links that lead to lists, not articles.
LIST_PAGES = ("/category/", "/tag/", "/author/", "/page/")


def forum_address(url: Column) -> Column:
    """(name, sort, time filter) of a forum listing's URL; sort is hot unless the path says."""
    path = F.filter(F.split(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), "/"), lambda p: p != "")
    is_forum = (F.size(path) >= 2) & (F.get(path, F.lit(0)) == "r")
    third = F.get(path, F.lit(2))
    period = F.regexp_extract(F.coalesce(F.parse_url(url, F.lit("QUERY")), F.lit("")), "t=([a-z]+)", 1)
    return F.struct(
        F.when(is_forum, F.get(path, F.lit(1))).otherwise("").alias("name"),
        F.when(is_forum & third.isin("top", "new", "hot", "rising", "controversial"), third).otherwise("hot").alias("sort"),
        F.when(period != "", period).alias("time_filter"),
    )
