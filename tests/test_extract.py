"""Field rules on invented listings, and their quirks."""

import pytest
from pyspark.sql import functions as F

from lotframe.functions.text import TRANSFORMS, py_strip, short_date
from lotframe.operators import extract
from lotframe.sources.pages import read_pages

#: Invented listings: a mileage in thousands, one with a comma, a hyphen of another kind, a colour whose next detail says nothing.
ROWS = [
    ("1999 Norvane Tessera RX Coupe", ["Chassis: NVT00X1234567890A", "31k Miles", "4.1-Liter V10", "Seven-Speed Dual-Clutch Transmission", "Harbour Slate Paint", "Oat Cloth w/Checked Inserts"], 31, "4.1-Liter V10", "Seven-Speed Dual-Clutch Transmission", "Harbour Slate Paint", "Oat Cloth w/Checked Inserts", "RX Coupe"),
    ("2011 Norvane Tessera Estate 5-Speed", ["8,250 Miles Shown", "2.9-Liter Flat-Six", "Five-Speed Manual Gearbox", "Pine Shadow Paint", "Rust & Cream Vinyl"], 8250, "2.9-Liter Flat-Six", "Five-Speed Manual Gearbox", "Pine Shadow Paint", "Rust & Cream Vinyl", "Estate"),
    ("2005 Norvane Tessera Spider", ["62k Miles", "4.1‑Liter V10", "Sequential", "Dusk Copper Paint", "Detachable Grey Roof Panel", "Tan Leather"], 62, "4.1-Liter V10", None, "Dusk Copper Paint", "Detachable Grey Roof Panel", "Spider"),
]


def test_details(spark):
    df = spark.createDataFrame([(i, r[0], r[1]) for i, r in enumerate(ROWS)], "i int, title string, details array<string>")
    outside, inside = extract.colors(F.col("details"))
    got = df.select(
        "i",
        extract.mileage(F.col("details"), F.col("title")),
        extract.engine(F.col("details")),
        extract.transmission(F.col("details")),
        outside,
        inside,
        extract.variant(F.col("title"), F.lit("Norvane"), F.lit("Tessera")),
        extract.year(F.col("title")),
        extract.mileage(F.col("details"), F.col("title"), k_aware=True),
    ).orderBy("i")
    for row, want in zip(got.collect(), ROWS, strict=True):
        assert tuple(row)[1:7] == want[2:]
        assert row[7] == int(want[0][:4])
    assert [r[8] for r in got.collect()] == [31000, 8250, 62000]


@pytest.mark.parametrize(
    ("title", "make", "short", "want"),
    [
        ("2003 BMW M3 Competition Package", "BMW", "M3", "Competition Package"),
        ("2003 BMW M3", "BMW", "M3", "Standard"),
        ("2003 BMW M3 with Box", "BMW", "M3", "Standard"),
        ("2006 Aston Martin DB9", "Aston Martin", "DB9 ", "Standard"),
        ("Other", "BMW", "M3", "Standard"),
        ("", "BMW", "M3", "Standard"),
        ("bmw m3 6-Speed", "BMW", "M3", "Standard"),
    ],
)
def test_variant(spark, title, make, short, want):
    assert spark.range(1).select(extract.variant(F.lit(title), F.lit(make), F.lit(short))).first()[0] == want


def test_vin_cascade(spark):
    good, low = "NVT00Y7654321098B", "nvt00y7654321098b"
    rows = [([f"Chassis: {good}"], []), ([low, good], [f"vin: {good}"]), (["NVT00Y7654"], []), ([], None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, links array<string>, comments array<string>").orderBy("i")
    assert [r[0] for r in df.select(extract.vin(F.col("links"))).collect()] == [good, None, None, None]
    assert [r[0] for r in df.select(extract.vin(F.col("links"), F.col("comments"))).collect()] == [good, good, None, None]


def test_prices_dates_and_transforms(spark):
    texts = ["Sold for $ 12,500 on 9/9/21", "Bid to $1 on 9/9/2015", "on 1/2/95", "$", None, "on 13/45/20"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [tuple(r) for r in df.select(*extract.price_and_date(F.col("t"))).collect()] == [(12500, "2021-09-09"), (1, None), (None, "1995-01-02"), (None, None), (None, None), (None, None)]
    one = spark.range(1)
    assert one.select(TRANSFORMS["multiply_1000"](F.lit("1.5")), TRANSFORMS["handle_k_miles"](F.lit("1,5k")), TRANSFORMS["remove_commas"](F.lit("1,234")), short_date(F.lit("2/30/20"))).first()[:] == (1500, 15000, 1234, None)
    assert one.select(py_strip(F.lit("\t  a b \n"))).first()[0] == "a b"


PAGE = """
<html><body><h1 class="post-title">2003 BMW M3 <b>Coupe</b></h1><span class="show-country-name"> USA </span>
<button class="group-title">Open Convertible Roofs &amp; more</button>
<div class="essentials"><p><strong>Location</strong>: <a href="https://www.google.com/maps/x">Austin, Texas</a></p>
<p><strong>Seller</strong>: <a href="/member/joe">joe</a></p><p><strong>Private Party or Dealer</strong>: Dealer</p><p><strong>Lot</strong> #123</p>
<ul><li>Chassis: <a href="#">NVT00Y7654321098B</a></li><li> </li><li>3.2-Liter Inline-Six</li></ul><ul><li>second</li></ul></div>
<div id="listing-bid"><div class="listing-stats-stat"><span class="listing-stats-label">Bids</span><span class="listing-stats-value">1,234</span></div></div>
<div class="post-excerpt"><p>One.</p><p> </p><p>Two<br>lines.</p></div>
<div id="comments"><div><p>bid USD $5,000 by <a class="bid-notification-link">ann</a></p></div><div><p>bid USD $6,000 by <a class="bid-notification-link">bob</a></p></div></div></body></html>
"""


def test_page_to_listing(spark):
    pages = spark.createDataFrame([("u1", PAGE, "BMW", "M3 Full", "M3"), ("u2", None, "BMW", "M3 Full", "M3")], "url string, html string, make string, model_full string, model_short string")
    raw = read_pages(pages)
    rows = {r["url"]: r for r in extract.extract_listings(raw).collect()}
    r = rows["u1"]
    assert (r["title"], r["country"], r["convertible"], r["location"], r["seller"], r["seller_type"], r["lot_number"]) == ("2003 BMW M3Coupe", "USA", True, "Austin, Texas", "joe", "Dealer", "123")
    assert (r["number_of_bids"], r["high_bidder"], r["vin"], r["year"], r["engine"], r["result"]) == (1, "bob", "NVT00Y7654321098B", 2003, "3.2-Liter Inline-Six", "Reserve Not Met")
    assert r["listing_details"] == ["Chassis:NVT00Y7654321098B", "3.2-Liter Inline-Six"] and r["excerpt"] == ["One.", "Twolines."]
    assert rows["u2"]["title"] == "" and rows["u2"]["listing_details"] == [] and rows["u2"]["_error"] is None
    paid = {r["url"]: r for r in extract.extract_listings(raw, price=F.lit(5000)).collect()}["u1"]
    assert (paid["high_bidder"], paid["result"]) == ("ann", "Sold")


def test_only_wanted_fields_are_read(spark):
    pages = spark.createDataFrame([("u1", PAGE)], "url string, html string")
    raw = read_pages(pages, ["title"]).first()["raw"]
    assert raw["title"] == "2003 BMW M3Coupe" and raw["details"] is None


def test_card_links(spark):
    html = '<div class="listing-card"><a href="/x">x</a></div><div class="listing-card">none</div><div class="listing-card"><a href="http://y/z">y</a></div>'
    pages = read_pages(spark.createDataFrame([("s", html)], "slug string, html string"), ["cards"])
    got = extract.card_links(pages.select("slug", F.col("raw.cards").alias("cards")), "https://b").orderBy("_pos").collect()
    assert [r["url"] for r in got] == ["https://b/x", "http://y/z"]


def test_strip_and_ascii_agree_with_python(spark):
    import re

    texts = ["\u3000 a\u00a0b\t", "\x1f x \x85", "", " ", "é 17é", "٣ miles", "12 miles", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    from lotframe.functions.text import rx_first

    got = df.select(py_strip(F.col("t")), rx_first(F.col("t"), r"(\d+)\s*miles"), rx_first(F.col("t"), r"\w+", 0)).collect()
    for t, r in zip(texts, got, strict=True):
        number, word = (re.search(p, t or "") for p in (r"(\d+)\s*miles", r"\w+"))
        assert tuple(r) == ((None, None, None) if t is None else (t.strip(), number and number[1], word and word[0]))


def test_first_text_with_a_match_wins(spark):
    rows = [(["x-Speed", "Six-Speed a", "Two-Speed"],), (["5-", "Speed Six-Speed"],), (["-Speed"],), ([],), (None,)]
    df = spark.createDataFrame(rows, "d array<string>")
    assert [r[0] for r in df.select(extract.transmission(F.col("d"))).collect()] == ["x-Speed", "Speed Six-Speed", None, None, None]


def test_read_profile(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"source_name": "s", "rules": {"engine": [{"kind": "title", "patterns": ["(V\\\\d+)"]}]}}')
    profile = extract.read_profile(spark, str(tmp_path / "p.json"))
    assert profile.source_name == "s" and profile.base_url == extract.BASE_URL and profile.rules["vin"] == extract.SiteProfile().rules["vin"]
    assert spark.range(1).select(extract.cascade({"title": F.lit("a V12")}, profile.rules["engine"])).first()[0] == "V12"


def test_values_are_evaluated_once(spark):
    """A rule's text is found once, however often its transform or what follows names it."""
    df = spark.createDataFrame([("1999 Norvane Tessera RX Coupe", ["31k Miles"], "Norvane", "Tessera")], "title string, details array<string>, make string, model string")
    plan = lambda c: df.select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan(extract.mileage(F.col("details"), F.col("title"))).count("(?iU)([\\d,]+)\\s*(?:k\\s+)?miles") == 1
    assert plan(extract.variant(F.col("title"), F.col("make"), F.col("model"))).count("-Speed.*") == 1


@pytest.mark.parametrize("dash", ["-", "–", "‑", "—"])
def test_hints_and_dashes_outside_ascii(spark, dash):
    rows = [([f"4.1{dash}Liter V10 é", f"ſix{dash}Speed Manual"],), ([f"4.1{dash}Liter V10", f"Six{dash}ſpeed Manual"],), ([f"Six{dash}SPEED é—b"],), ([None, ""],), (None,)]
    df = spark.createDataFrame(rows, "d array<string>")
    got = [tuple(r) for r in df.select(extract.engine(F.col("d")), extract.transmission(F.col("d"))).collect()]
    assert got == [("4.1-Liter V10 é", "ſix-Speed Manual"), ("4.1-Liter V10", "Six-ſpeed Manual"), (None, "Six-SPEED é-b"), (None, None), (None, None)]


def test_variants_of_odd_titles(spark):
    rows = [("Norvane Tessera", "Norvane", "Tessera"), ("Norvane GT", "Norvane", "Tessera"), (None, "a", "b"), ("x y z", None, "y"), ("x y z", "x", None), ("x y with z", "X", "Y"), ("x y z 5-Speed w", "x", "Y "), ("y x z", "x", "y")]
    df = spark.createDataFrame(rows, "t string, a string, b string")
    assert [r[0] for r in df.select(extract.variant(F.col("t"), F.col("a"), F.col("b"))).collect()] == ["Standard"] * 6 + ["z", "Standard"]
