"""Listing fields from a page's raw texts, as native expressions built from a site profile.

A profile is one JSON file (``read_profile``): the selectors of the site, the rules of each field, those of colours, and
the site's constants. ``extract_pages`` compiles it: the columns asked for decide which raw texts are needed, these
decide which selectors the page reader matches, and the rules become Columns. Rules may name a selector of their own and
an attribute, so that a profile can describe fields that the listing record does not have.

A raw record has title, details (texts of the details list), and what ``lotframe.sources.pages`` reads from a page. Rules
are tried in order and the first success counts. Comment rules are built but off by default (``enable_comment_rules``),
as the observed behaviour never reaches them; ``k_aware`` mileage reads ``17k Miles`` as 17,000 instead of 17, also off.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotframe.functions.text import ANY, TRANSFORMS, first_match, first_of, is_ascii, not_empty, once, piece, py_strip, rx, rx_first, short_date, to_int, unify_dashes, words_of
from lotframe.schema import LISTING_SCHEMA
from lotframe.sources.pages import NEEDS, PLAIN, SELECTORS, read_pages, texts_of

# Patterns, words and names that results depend on.
VIN_TEXT = r"([A-HJ-NPR-Z0-9]{17})"
VIN_WHOLE = r"^[A-HJ-NPR-Z0-9]{17}$"
VIN_COMMENTS = (r"chassis[:\s]+([A-HJ-NPR-Z0-9]{17})", r"vin[:\s]+([A-HJ-NPR-Z0-9]{17})", r"\b([A-HJ-NPR-Z0-9]{17})\b")
ENGINE = (r"([\d.]+[- ]?(?:Liter|L)\s+[\w\s-]*)",)
TRANSMISSION = (r"[\w\s-]*\b(\w+)-Speed[\w\s-]*",)
MILEAGE_DETAIL = (r"([\d,]+)\s*(?:k\s+)?miles",)
MILEAGE_DETAIL_K = (r"([\d,.]+\s*k?)\s*miles",)
MILEAGE_TITLE = (r"(\d+\.?\d*)k-Mile",)
MILEAGE_COMMENTS = (r"(\d{1,3}(?:,\d{3})*)\s*miles", r"odometer\s*(?:shows|reads)?\s*(\d{1,3}(?:,\d{3})*)")
EXTERIOR = (r"([^\n]+?Paint)",)
INTERIOR_WORDS = ("leather", "cloth", "upholstery", "nappa", "alcantara", "vinyl", "suede", "interior")
NOT_INTERIOR_WORDS = ("chassis", "miles", "turbo", "liter", "speed", "transmission", "engine", "brake", "exhaust")
NO_VARIANT_WORDS = ("for", "with", "in", "at", "by", "from", "on", "and", "the")
SELLER_TYPES = ("Private Party", "Dealer")
BASE_URL = "https://bringatrailer.com"
SOURCE_NAME = "bringatrailer"


#: Kinds of rules: the raw texts that a rule reads.
KINDS = {"detail": "details", "title": "title", "links": "links", "comments": "comments", "author_comments": "author_comments", "selector": "picks"}
#: Kinds that count only where comment rules are enabled.
COMMENTS = ("comments", "author_comments")


@dataclass(frozen=True)
class FieldRule:
    """One way to find a field. kind: detail, title, links, comments or author_comments (which raw texts are read), or
    selector, with the selector and the attribute (or ``text``) of its own; hint: see ``first_match``."""

    kind: str
    patterns: tuple[str, ...] = (ANY,)
    group: int = 1
    transform: str = "identity"
    dashes: bool = False
    hint: str = ""
    selector: str = ""
    attribute: str = "text"

    def __post_init__(self):
        if self.kind not in KINDS or self.transform not in TRANSFORMS or (self.kind == "selector") != bool(self.selector):
            raise ValueError(f"not a rule: {self}")

    @property
    def pick(self) -> str:
        return f"{self.selector} @{self.attribute}"


@dataclass(frozen=True)
class ColorRules:
    """How colours are found: the exterior in the first detail that holds ``marker`` and fits a pattern; the interior in the
    next one (``next_is_interior``) or in the first short detail with a keyword and no word of another part."""

    marker: str = "paint"
    patterns: tuple[str, ...] = EXTERIOR
    next_is_interior: bool = True
    keywords: tuple[str, ...] = INTERIOR_WORDS
    skip_keywords: tuple[str, ...] = NOT_INTERIOR_WORDS
    most_words: int = 8


@dataclass(frozen=True)
class SiteProfile:
    """Selectors, rules by field, colour rules and the constants of a site; another site is another profile."""

    source_name: str = SOURCE_NAME
    base_url: str = BASE_URL
    rules: dict[str, tuple[FieldRule, ...]] = field(
        default_factory=lambda: {
            "vin": (FieldRule("links", (VIN_TEXT,)), FieldRule("author_comments", VIN_COMMENTS)),
            "engine": (FieldRule("detail", ENGINE, 0, dashes=True),),
            "transmission": (FieldRule("detail", TRANSMISSION, 0, dashes=True, hint="-speed"),),
            "mileage": (
                FieldRule("detail", MILEAGE_DETAIL, transform="handle_k_miles", hint="miles"),
                FieldRule("title", MILEAGE_TITLE, transform="multiply_1000"),
                FieldRule("comments", MILEAGE_COMMENTS, transform="remove_commas"),
            ),
        }
    )
    selectors: dict[str, str] = field(default_factory=dict)
    colors: ColorRules = ColorRules()
    closed_references: bool = False  # only character references that end with a semicolon are decoded


def profile_of(text: str) -> SiteProfile:
    """A profile from the text of a JSON file; see ``read_profile``."""
    given, default = json.loads(text), SiteProfile()
    unknown = set(given) - {"source_name", "base_url", "rules", "selectors", "colors", "closed_references"} | set(given.get("selectors", {})) - set(SELECTORS) - set(PLAIN)
    if unknown:
        raise ValueError(f"not part of a profile: {', '.join(sorted(unknown))}")
    listed = lambda r: {k: tuple(v) if isinstance(v, list) else v for k, v in r.items()}
    rules = {f: tuple(FieldRule(**listed(r)) for r in some) for f, some in given.get("rules", {}).items()}
    return SiteProfile(
        given.get("source_name", default.source_name), given.get("base_url", default.base_url), {**default.rules, **rules}, given.get("selectors", {}), ColorRules(**listed(given.get("colors", {}))),
        given.get("closed_references", default.closed_references),
    )


def read_profile(spark: SparkSession, path: str) -> SiteProfile:
    """A profile from a JSON file: source_name, base_url, selectors by name, rules by field, each with the attributes of
    ``FieldRule``, colors with those of ``ColorRules``, and closed_references. What the file leaves out is that of the default profile; names that
    a profile does not have are refused."""
    return profile_of(spark.read.text(path, wholetext=True).first()[0])




def cascade(raw: dict[str, Column], rules: Sequence[FieldRule], check: str | None = None, enable_comment_rules: bool = False, text: Column | None = None) -> Column:
    """The value of the first rule that succeeds; a value that is not what ``check`` matches passes the turn to the next
    rule. text: lists of texts are places in it (``first_match``), those of selectors by name in ``raw["places"]``."""
    found = []
    for rule in rules:
        if rule.kind in COMMENTS and not enable_comment_rules:
            continue
        within = None if rule.kind == "title" or rule.kind == "selector" and rule.attribute != "text" else text
        texts = raw[KINDS[rule.kind]] if within is None or rule.kind != "selector" else raw["places"]
        if rule.kind == "title":
            texts = F.array(texts)
        elif rule.kind == "selector":
            texts = F.try_element_at(texts, F.lit(rule.pick))
        value = first_match(texts, rule.patterns, rule.group, unify_dashes if rule.dashes else None, rule.hint, within)
        value = value if rule.transform == "identity" else once(value, TRANSFORMS[rule.transform])
        found.append(rx_first(value, check, 0, ignore_case=False) if check else value)
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def year(title: Column) -> Column:
    return to_int(rx_first(title, r"\b(19|20)\d{2}\b", 0, ignore_case=False))


def engine(details: Column, rules: Sequence[FieldRule] | None = None) -> Column:
    return py_strip(cascade({"details": details}, rules or SiteProfile().rules["engine"]))


def transmission(details: Column, rules: Sequence[FieldRule] | None = None) -> Column:
    return py_strip(cascade({"details": details}, rules or SiteProfile().rules["transmission"]))


def mileage(details: Column, title: Column, comments: Column | None = None, k_aware: bool = False, rules: Sequence[FieldRule] | None = None) -> Column:
    rules = list(rules or SiteProfile().rules["mileage"])
    if k_aware:
        rules[0] = FieldRule("detail", MILEAGE_DETAIL_K, transform="handle_k_miles")
    raw = {"details": details, "title": title, "comments": comments, "author_comments": comments}
    return cascade(raw, rules, enable_comment_rules=comments is not None).cast("int")


def vin(links: Column, comments: Column | None = None, rules: Sequence[FieldRule] | None = None) -> Column:
    """The first match of each rule has to be a VIN as it stands, in capitals; if not, the next rule is tried."""
    raw = {"links": links, "comments": comments, "author_comments": comments}
    return cascade(raw, rules or SiteProfile().rules["vin"], VIN_WHOLE, enable_comment_rules=comments is not None)


def colors(details: Column, rules: ColorRules | None = None, text: Column | None = None) -> tuple[Column, Column]:
    """(exterior, interior). The interior is the detail after the exterior, whatever it says; failing that, the first
    short detail with an interior word and no word of another part. text: details are places in it (``piece``)."""
    rules = rules or ColorRules()

    def fits(d: Column) -> Column:
        found = lambda kind: F.greatest(*(d.rlike(kind(p)) for p in rules.patterns), F.lit(False))
        return F.contains(F.lower(d), F.lit(rules.marker)) & F.when(is_ascii(d), found("(?i){}".format)).otherwise(found(rx))

    def is_interior(d: Column) -> Column:
        low = F.lower(d)
        other = low.rlike("|".join(rules.skip_keywords)) if rules.skip_keywords else F.lit(False)
        return low.rlike("|".join(rules.keywords)) & ~other & once(F.size(words_of(d)), lambda n: n.between(1, rules.most_words))

    def first_place(good: Callable[[Column], Column]) -> Column:
        numbered = F.transform(details, lambda p, i: F.struct(p.alias("place"), i.alias("i")))
        return once(text, lambda t: F.aggregate(numbered, F.lit(None).cast("int"), lambda known, x: F.coalesce(known, once(piece(t, x["place"]), lambda d: F.when(good(d), x["i"])))))

    if text is None:
        at, detail = F.array_min(F.transform(details, lambda d, i: F.when(fits(d), i))), lambda i: F.get(details, i)
        inside = F.get(F.filter(details, is_interior), F.lit(0))
    else:
        at, detail = first_place(fits), lambda i: once(text, lambda t: piece(t, F.get(details, i)))
        inside = detail(first_place(is_interior))
    named = py_strip(inside) if rules.keywords else F.lit(None).cast("string")
    after = not_empty(py_strip(detail(at + 1))) if rules.next_is_interior else F.lit(None).cast("string")
    return py_strip(F.coalesce(*(rx_first(detail(at), p) for p in rules.patterns))), F.coalesce(after, named)


def variant(title: Column, make: Column, model_short: Column) -> Column:
    """What follows make and model in the title, up to the number of speeds; Standard if nothing does."""

    def after(text: Column, word: Column) -> Column:
        """What follows the word; null if it is not there."""
        at = F.position(F.upper(word), F.upper(text))
        return once(at, lambda at: F.when(at > 0, py_strip(F.substr(text, at + F.length(word)))))

    def named(name: Column) -> Column:
        first = F.lower(F.try_element_at(words_of(name), F.lit(1)))
        return F.when((name != "") & ~first.isin(*NO_VARIANT_WORDS), name)

    after_model = once(after(title, make), lambda rest: after(rest, model_short))
    name = py_strip(F.regexp_replace(after_model, r"(?isU)\d+-Speed.*", ""))
    return F.coalesce(once(name, named), F.lit("Standard"))


def price_and_date(text: Column) -> tuple[Column, Column]:
    """(whole dollars, ISO date) of a results text such as ``Sold for $ 12,500 on 9/9/21``."""
    return TRANSFORMS["remove_commas"](rx_first(text, r"\$\s?([\d,]+)", ignore_case=False)), short_date(rx_first(text, r"on\s+(\d{1,2}/\d{1,2}/\d{2,4})", ignore_case=False))


def convertible(group_titles: Column) -> Column:
    return F.coalesce(F.exists(group_titles, lambda g: F.contains(g, F.lit("Convertible"))), F.lit(False))


def _labelled(essentials: Column, label: str, value: Callable[[Column], Column]) -> Column:
    """The value of the last entry of a label that has one."""
    found = F.transform(F.filter(essentials, lambda e: e["label"] == label), value)
    return F.try_element_at(F.filter(found, lambda x: x.isNotNull()), F.lit(-1))


def location(essentials: Column) -> Column:
    return _labelled(essentials, "Location", lambda e: e["map_link"])


def seller(essentials: Column) -> Column:
    return _labelled(essentials, "Seller", lambda e: e["member_link"])


def seller_type(essentials: Column) -> Column:
    def after_colon(e: Column) -> Column:
        value = py_strip(F.regexp_replace(e["parent_text"], "(?s)^[^:]*:", ""))
        return F.when(F.contains(e["parent_text"], F.lit(":")) & value.isin(*SELLER_TYPES), value)

    return _labelled(essentials, "Private Party or Dealer", after_colon)


def lot_number(essentials: Column) -> Column:
    return _labelled(essentials, "Lot", lambda e: rx_first(e["parent_text"], r"#?(\d+)"))


def number_of_bids(stats: Column) -> Column:
    """The digits of the first stat whose label speaks of bids and whose value has digits; ``1,234`` gives 1."""
    return to_int(first_of(stats, lambda s: F.when(F.contains(F.lower(s["label"]), F.lit("bids")), rx_first(s["value"], r"(\d+)"))))


def high_bidder(bids: Column, price: Column) -> Column:
    """The last bidder, or with a price the last whose bid is that price. bids: (bidder, text) in page order."""
    amount = F.transform(bids, lambda b: F.struct(py_strip(b["bidder"]).alias("bidder"), TRANSFORMS["remove_commas"](rx_first(b["text"], r"USD\s+\$([0-9,]+)")).alias("amount")))
    unsold = F.coalesce(price, F.lit(0)) == 0
    return F.try_element_at(F.filter(amount, lambda b: unsold | (b["amount"] == price)), F.lit(-1))["bidder"]


def result(price: Column) -> Column:
    return F.when(F.coalesce(price, F.lit(0)) != 0, "Sold").otherwise("Reserve Not Met")


def card_links(pages: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    """(slug, _pos, url) of the cards of category pages; relative links get the base url, cards without a link go.
    pages: slug, cards (array of hrefs in page order)."""
    link = F.when(F.startswith("href", F.lit("http")), F.col("href")).otherwise(F.concat(F.lit(base_url), F.col("href")))
    return pages.select("slug", F.posexplode("cards").alias("_pos", "href")).where("href is not null and href <> ''").select("slug", "_pos", link.alias("url"))


#: The raw texts that a column of the listing record reads; those of rules come from the rules.
INPUTS = {
    "title": ("title",),
    "lot_number": ("essentials",),
    "seller": ("essentials",),
    "seller_type": ("essentials",),
    "high_bidder": ("bids",),
    "number_of_bids": ("stats",),
    "year": ("title",),
    "variant": ("title",),
    "convertible": ("group_titles",),
    "exterior_color": ("details",),
    "interior_color": ("details",),
    "location": ("essentials",),
    "country": ("country",),
    "listing_details": ("details",),
    "excerpt": ("excerpt",),
}
RECORD = tuple(f.name for f in LISTING_SCHEMA if f.name != "url")


def _rules(column: str, profile: SiteProfile, enable_comment_rules: bool) -> list[FieldRule]:
    return [r for r in profile.rules.get(column, ()) if enable_comment_rules or r.kind not in COMMENTS]


def inputs_of(columns: Iterable[str], profile: SiteProfile | None = None, enable_comment_rules: bool = False) -> tuple[list[str], list[tuple[str, str]]]:
    """(raw texts, picks) that columns of a profile need: what the page reader has to look for."""
    profile = profile or SiteProfile()
    rules = [r for c in columns for r in _rules(c, profile, enable_comment_rules)]
    raw = [n for c in columns if c not in profile.rules for n in INPUTS.get(c, ())] + [KINDS[r.kind] for r in rules if r.kind != "selector"]
    return [n for n in dict.fromkeys(raw) if n in NEEDS], list(dict.fromkeys((r.selector, r.attribute) for r in rules if r.kind == "selector"))


def listing_columns(profile: SiteProfile, price: Column, targets: Iterable[str], enable_comment_rules: bool = False, k_aware: bool = False, whole: bool = False) -> dict[str, Callable[[], Column]]:
    """Every column that a profile describes, by name, as a function that builds it: those not asked for are never built.
    targets: columns that come with the page; make and model count as null where they do not. whole: the pages were read whole."""
    r = F.col("raw")
    text = r["text"] if whole else None
    items = lambda name: F.try_element_at(r["places"], F.lit(name)) if whole else r[name]
    texts = lambda name: texts_of(name) if whole else r[name]
    given = lambda name: F.col(name) if name in targets else F.lit(None).cast("string")
    raw = {n: r[n] if n in ("title", "picks") else items(n) for n in dict.fromkeys(KINDS.values())} | ({"places": r["places"]} if whole else {})
    built = {
        "source": lambda: F.lit(profile.source_name),
        "title": lambda: F.coalesce(r["title"], F.lit("")),
        "lot_number": lambda: lot_number(r["essentials"]),
        "seller": lambda: seller(r["essentials"]),
        "seller_type": lambda: seller_type(r["essentials"]),
        "result": lambda: result(price),
        "high_bidder": lambda: high_bidder(r["bids"], price),
        "price": lambda: price.cast("bigint"),
        "sale_date": lambda: F.lit(None).cast("string"),
        "number_of_bids": lambda: number_of_bids(r["stats"]),
        "year": lambda: year(r["title"]),
        "make": lambda: given("make"),
        "model": lambda: given("model_full"),
        "variant": lambda: variant(F.coalesce(r["title"], F.lit("")), given("make"), given("model_short")),
        "convertible": lambda: convertible(texts("group_titles")),
        "exterior_color": lambda: colors(items("details"), profile.colors, text)[0],
        "interior_color": lambda: colors(items("details"), profile.colors, text)[1],
        "location": lambda: location(r["essentials"]),
        "country": lambda: r["country"],
        "listing_details": lambda: F.coalesce(texts("details"), F.array().cast("array<string>")),
        "excerpt": lambda: F.coalesce(texts("excerpt"), F.array().cast("array<string>")),
    }

    def ruled(name: str) -> Column:
        rules = list(profile.rules[name])
        if name == "mileage" and k_aware:
            rules[0] = FieldRule("detail", MILEAGE_DETAIL_K, transform="handle_k_miles")
        value = cascade(raw, rules, VIN_WHOLE if name == "vin" else None, enable_comment_rules, text)
        if name in RECORD:  # a field of the record has the record's type
            return py_strip(value) if name in ("engine", "transmission") else value.try_cast(LISTING_SCHEMA[name].dataType)
        return value

    return built | {name: (lambda name=name: ruled(name)) for name in profile.rules}


def extract_listings(raw: DataFrame, profile: SiteProfile | None = None, price: Column | None = None, enable_comment_rules: bool = False, k_aware: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Listing records from raw page structs joined with their targets (make, model_full, model_short, and whatever
    else; those other columns are kept). ``columns``: those wanted, of the record or of the profile's rules; the whole record
    if not given. ``_error`` is set for pages that could not be read."""
    profile = profile or SiteProfile()
    price = price if price is not None else F.lit(None).cast("bigint")
    kind = raw.schema["raw"].dataType
    built = listing_columns(profile, price, raw.columns, enable_comment_rules, k_aware, whole="places" in kind.names)
    columns = RECORD if columns is None else tuple(columns)
    others = [c for c in raw.columns if c not in columns and c not in ("raw", "url")]
    if columns == RECORD:
        others = [c for c in others if c not in built]
    url = ["url"] if "url" in raw.columns else []
    return raw.select(*url, *(built[c]().alias(c) for c in columns), *(F.col(f"`{c}`") for c in others))


def extract_pages(pages: DataFrame, profile: SiteProfile | None = None, columns: Sequence[str] | None = None, price: Column | None = None, enable_comment_rules: bool = False, k_aware: bool = False, whole: bool = False) -> DataFrame:
    """Records straight from pages (html, and whatever else) by a profile alone: only selectors that the wanted columns need
    are matched, and only their rules are evaluated. whole: see ``read_pages``; ``_error`` then has nothing to say."""
    profile = profile or SiteProfile()
    wanted, picks = inputs_of(RECORD if columns is None else columns, profile, enable_comment_rules)
    return extract_listings(read_pages(pages, wanted, profile.selectors, picks=picks, closed=profile.closed_references, whole=whole), profile, price, enable_comment_rules, k_aware, columns)


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound rows, rows with ``_error``): one bad row never costs another."""
    return df.where("_error is null").drop("_error"), df.where("_error is not null")
