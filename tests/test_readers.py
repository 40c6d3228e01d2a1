"""Readers over texts in the layouts that the sources deliver."""

import json

import pytest

from pricewave.operators import bundles
from pricewave.sources import parsers, tables, variants

HEAD = "Retailer,Name,Category,Regular,Unit,Sale,Off,Unit,Last"


def sheet(spark, tmp_path, **bodies):
    for name, body in bodies.items():
        (tmp_path / f"{name}.csv").write_text(body)
    lines = tables.sheet_lines(tables.read_sheets(spark, f"{tmp_path}/*.csv"))
    return lines, tables.sheet_specials(lines)


def test_sheets(spark, tmp_path):
    """A good, a short, an empty, a useless and a changed sheet: the good one's rows, and what became of each."""
    rows = [
        'Coles,"Tea, ""green""\n100g",Drinks,$4.00,$1 / 100g, $ 2.00 ,50.4%,x,8 weeks ago @ CL',
        "Woolies,Milk, ,$4.00,,$3.00,25%,,—",
        "WW,Milk,Dairy,$4.00,,$3.00,25%,,",
        "Coles,,Dairy,$4.00,,$3.00,25%,,",
        "Coles,No percentage,Dairy,$4.00,,$3.00,,,",
        "Coles,Dear,Dairy,$3.00,,$3.00,0%,,",
        "Coles,Short,Dairy,$4.00,,$3.00,25%,",
        "Coles,Free,Dairy,$4.00,,$0.00,100%,,1 week ago @ ww,more",
    ]
    good = "banner\n" + HEAD + "\n" + "\n".join(rows) + "\n"
    lines, specials = sheet(spark, tmp_path, good=good, short="banner\n" + HEAD + "\n", useless=f"b\n{HEAD}\nColes,x\n", changed=good.replace("Retailer", "Shop"))
    got = specials.orderBy("line").collect()
    assert [(r.line, r.retailer, r.name, r.category, r.regular_cents, r.sale_cents, r.discount_pct, r.is_half_price, r.last_weeks, r.last_retailer) for r in got] == [
        (2, "coles", 'Tea, "green"\n100g', "Drinks", 400, 200, 50, True, 8, "coles"),
        (3, "woolworths", "Milk", "Uncategorised", 400, 300, 25, False, None, None),
        (9, "coles", "Free", "Dairy", 400, 0, 100, True, 1, "woolworths"),
    ]
    runs = {r.file.rsplit("/", 1)[1]: (r.status, r["items"]) for r in tables.sheet_runs(lines, specials).collect()}
    assert runs == {"good.csv": ("success", 3), "short.csv": ("no_data", 0), "useless.csv": ("no_data", 0), "changed.csv": ("failed", 0)}
    assert tables.sheet_specials(lines, limit=2).count() == 2


def cells(*x):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in x) + "</tr>"


def test_tables_in_pages(spark):
    """The report's heading is no category, unclosed cells and rows end where the next begins, and rows outside a body do not count."""
    a = cells("Coles", "A <b>1</b>", "$4.00", "u", "$2.00", "50%", "8 weeks ago @ WW")
    first = (
        "<h5>Catalogue Half-Price Report — 2001-06-13</h5><table class='data'><tr><td>Coles<td>out</tr><tbody>" + cells("WW", "early", "$1,000", "u", "$9.5", "99%") + "</tbody></table>"
        "<h5>Tea &amp; <i>more</i></h5><table class='x data'><thead>" + a + "</thead><tbody>" + a + a
        + "<tr><td>Woolworths<td>B<td>$3<td>u<td>$2<td>33 %" + cells("Coles", "bad price", "$4", "u", "n/a", "50%") + cells("Coles", "bad percent", "$4", "u", "$2", "50.5%") + cells("Aldi", "C", "$4", "u", "$2", "50%")
        + cells("Coles", "short", "$4", "u", "$2") + "</tbody></table><table><tbody>" + cells("Coles", "no data", "$4", "u", "$2", "50%") + "</tbody></table>"
    )
    second = "<h5>Late</h5><table class='data'><tbody>" + a + cells("Coles", "A 1", "$4", "u", "$1.99", "50%") + "<tr><td>Coles<td>last<td>$4<td>u<td>$2<td>50%"
    pages = spark.createDataFrame([(2, second), (1, first), (3, None), (4, "")], "page int, html string")
    got = tables.table_specials(pages).orderBy("page", "pos").collect()
    assert [(r.page, r.retailer, r.name, r.category, r.regular_cents, r.sale_cents, r.discount_pct, r.last_raw, r.last_weeks) for r in got] == [
        (1, "woolworths", "early", "Uncategorised", 100000, 950, 99, "", None),
        (1, "coles", "A 1", "Tea & more", 400, 200, 50, "8 weeks ago @ WW", 8),
        (1, "woolworths", "B", "Tea & more", 300, 200, 33, "", None),
        (2, "coles", "A 1", "Late", 400, 199, 50, "", None),
        (2, "coles", "last", "Late", 400, 200, 50, "", None),
    ]


def test_catalogues(spark):
    """Items in and out of a wrapping object, JSON in and out of a callback, and the ways to write a price before."""
    item = lambda sku, option, **price: {"SKU": sku, "itemName": f" Tea &amp; {sku} ", "description": "1/2 Price", "prices": [{"priceOptionDesc": option, **price}]}
    bodies = [
        (0, "cb(" + json.dumps({"items": [{"items": item("1P", "Was $4.00.", priceSale="2.00")}, item("2", "was $ 4.50 each", priceSale="", priceReg=2)]}) + ") ;\n"),
        (1, json.dumps({"items": [item("3", "WAS5", priceSale=0, priceReg="2.5"), {"SKU": "P", "itemName": "x"}, {"SKU": "9", "itemName": None}, {"SKU": "4", "itemName": "bare"}, "word", None]})),
        (2, "cb(not json)"),
        (3, None),
    ]
    got = parsers.catalogue_items(spark.createDataFrame(bodies, "pos int, body string")).orderBy("id").collect()
    assert [(r.id, r.name, r.is_half, r.sale_cents, r.was_cents) for r in got] == [("1", "Tea & 1P", True, 200, 400), ("2", "Tea & 2", True, 200, 450), ("3", "Tea & 3", True, 250, 500), ("4", "bare", False, None, None)]
    listed = [{"items": {"saleId": 7, "startDate": "2001-06-01", "endDate": "2001-07-01"}}, {"saleId": "8", "startDate": "soon", "endDate": "2001-07-01"}, {"saleId": "9", "startDate": "2001-06-01"}]
    sales = parsers.sale_rows(spark.createDataFrame([(f"x({json.dumps({'items': listed})})",)], "body string"))
    assert sorted(r.id for r in sales.collect()) == ["7", "8"]
    assert [r.id for r in parsers.running_sales(sales, "2001-06-15").collect()] == ["7"]


@pytest.mark.parametrize("saved, pct", [(33, 33), ("33", 50), (33.5, 50), (None, 50), ("half", 50)])
def test_saved_percentages(spark, saved, pct):
    row = {"_type": "PRODUCT", "id": 12, "name": " tea ", "brand": "Tea", "pricing": {"now": "2.00", "was": 4, "savePercent": saved}}
    bad = [{**row, "pricing": {"now": None, "was": 4}}, {**row, "id": None}, {**row, "_type": "AD"}, {**row, "pricing": {"now": 4, "was": 4}}, {**row, "name": ""}, 7]
    got = parsers.listing_specials(spark.createDataFrame([(json.dumps([row, *bad]),), ("no json",), (None,)], "results string"), cdn="c").collect()
    assert [(r.name, r.sale_cents, r.regular_cents, r.discount_pct, r.image_url, r.sku) for r in got] == [("tea", 200, 400, pct, "c/1/12.jpg", "12")]


def test_drafts(spark):
    """Servings and lists by their JSON type: 3.5 is three, "3.5" no number, null a text, a list's null a text too."""
    base = {"title": "T", "serves": 2, "ingredients": [{"product_id": "p", "label": None}, 3], "pantry": ["salt", None, True], "instructions": "i", "tags": None}
    changed = [{}, {"serves": 3.5}, {"serves": "3.5"}, {"serves": " 3 "}, {"serves": None}, {"serves": 0}, {"serves": ""}, {"serves": [1]}, {"title": None}, {"ingredients": None}, {"ingredients": 5}, {"pantry": "abc"}, {"tags": {"k": 1}}]
    body = json.dumps({"recipes": [{**base, **c} for c in changed] + ["words", None, {}]})
    got = bundles.drafted(spark.createDataFrame([(1, body), (2, "no"), (3, '{"recipes": null}'), (4, "[]")], "reply int, body string")).orderBy("pos").collect()
    assert [(r.pos, r.serves) for r in got] == [(0, 2), (1, 3), (3, 3), (4, 4), (5, 4), (6, 4), (8, 2), (9, 2), (11, 2), (12, 2), (15, 4)]
    by = {r.pos: r for r in got}
    assert by[0].pantry == ["salt", "None", "True"] and [i.product_id for i in by[0].ingredients] == ["p"] and by[0].tags == []
    assert by[8].title == "None" and by[15].title == "" and by[9].ingredients == [] and by[11].pantry == ["a", "b", "c"] and by[12].tags == ["k"]


def test_variants(spark):
    values = ['"33"', "33", "33.0", "3.5e2", "true", "null", "[]", "[1]", "{}", '{"a": 1}', '""', "0", None]
    v = variants.parsed("j")
    got = spark.createDataFrame([(i, j) for i, j in enumerate(values)], "i int, j string").select(
        "i", variants.is_whole(v).alias("whole"), variants.number(v).alias("number"), variants.filled(v).alias("filled"), variants.is_object(v).alias("object")
    ).orderBy("i").collect()
    assert [r.i for r in got if r.whole] == [1, 11]
    assert [(r.i, r.number) for r in got if r.number is not None] == [(0, 33.0), (1, 33.0), (2, 33.0), (3, 350.0), (11, 0.0)]
    assert [r.i for r in got if r.filled] == [0, 1, 2, 3, 4, 7, 9] and [r.i for r in got if r.object] == [8, 9]


def test_folders_of_files(spark, tmp_path):
    """A good, a short and a broken file of each kind: the good one's records, and a row for each file."""
    import gzip

    from pricewave.sources import formats

    formats.register(spark)
    good = {
        "dump": gzip.compress(json.dumps([{"id": "1"}, {"id": "é"}]).encode()),
        "callback": b'cb({"items": [{"items": {"SKU": "1P"}}, {"SKU": "2"}]});',
        "sheet": f"banner\n{HEAD}\nColes,\"a\nb\",x\n".encode(),
        "sitemap": b"<urlset><url><loc>https://x/1</loc></url><url><loc>https://x/2</loc></url></urlset>",
    }
    short = {"dump": b"[]", "callback": b'{"items": null}', "sheet": f"banner\n{HEAD}\n".encode(), "sitemap": b"<urlset/>"}
    broken = {"dump": b'{"no": "list"}', "callback": b"cb(nothing)", "sheet": b"banner\nShop,Name,Category\nx\ny\n", "sitemap": b"\xff\xfe"}
    for kind in good:
        (tmp_path / kind).mkdir()
        for name, body in (("good", good[kind]), ("short", short[kind]), ("broken", broken[kind]), ("_hidden", b"?")):
            (tmp_path / kind / name).write_bytes(body)
        read = spark.read.format("retail_files").option("kind", kind).load(str(tmp_path / kind))
        assert read.rdd.getNumPartitions() == 3
        held = formats.records(read).orderBy("pos").collect()
        assert {r.file.rsplit("/", 1)[1] for r in held} == {"good"} and [r.pos for r in held] == list(range(len(held))) and len(held) in (2, 3)
        ends = {r.file.rsplit("/", 1)[1]: (r.status, r.error is not None) for r in formats.outcomes(read).collect()}
        assert ends == {"good": ("success", False), "short": ("no_data", False), "broken": ("failed", True)}
    with pytest.raises(Exception, match="kind must be"):
        spark.read.format("retail_files").load(str(tmp_path)).count()
