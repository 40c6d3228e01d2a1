"""Queries over the readers: the driver's rows are written as the texts that a source would give, and parsed by the library."""

from pyspark.sql import DataFrame, functions as F

from pricewave.functions import scalars
from pricewave.operators import digests, matching, pricing, writes
from pricewave.plans.adapter import AS_OF, WEEK, table
from pricewave.plans.book import query
from pricewave.sources import parsers, tables

_CENTS = "CAST(rint(p_retailprice * 100) AS BIGINT)"
_CENTS_SQL = "CAST(round_even(p_retailprice * 100, 0) AS BIGINT)"
#: A part's price now as a share of its price before.
_SHARE = "CASE p_partkey % 4 WHEN 0 THEN 1.2D WHEN 1 THEN 0.5D WHEN 2 THEN 0.7D ELSE 0.45D END"
_SHARE_SQL = "CASE p_partkey % 4 WHEN 0 THEN 1.2e0 WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.7e0 ELSE 0.45e0 END"
_SALES_SQL = f"""p AS (SELECT *, {_CENTS_SQL} AS regular, CAST(round_even(p_retailprice * 100 * {_SHARE_SQL}, 0) AS BIGINT) AS sale FROM part),
s AS (SELECT *, CAST(round_even(100e0 * (regular - sale) / regular, 0) AS INT) AS pct FROM p WHERE sale > 0 AND regular > 0 AND sale < regular)"""


def _offers(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.withColumn("regular", F.expr(_CENTS)).withColumn("sale", F.expr(f"CAST(rint(p_retailprice * 100 * {_SHARE}) AS BIGINT)"))


@query("""WITH o AS (SELECT o_custkey, CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
  AND o_totalprice > 0 THEN CAST(round_even(o_totalprice * 100, 0) AS BIGINT) END AS cents, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS id, 'Cust ' || o_custkey AS name, count(cents) AS n, CAST(sum(cents) AS BIGINT) AS total,
  min(d) FILTER (cents IS NOT NULL) AS first, max(d) FILTER (cents IS NOT NULL) AS last
FROM o WHERE o_custkey % 11 <> 0 AND o_custkey % 7 <> 0 GROUP BY o_custkey HAVING count(cents) > 0""")
def dump_items(spark, sf_dir):
    """Dumps of customers as items and their orders as change points, some malformed."""
    o = table(spark, sf_dir, "orders")
    point = F.struct(
        F.when(F.col("o_orderkey") % 13 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"), F.when(F.col("o_orderkey") % 17 == 0, "dear").otherwise(F.col("o_totalprice").cast("string")).alias("price")
    )
    items = o.groupBy("o_custkey").agg(F.collect_list(point).alias("priceHistory")).select(
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).alias("id"), F.when(F.col("o_custkey") % 7 == 0, "  ").otherwise(F.concat(F.lit(" Cust "), F.col("o_custkey").cast("string"), F.lit(" "))).alias("name"), F.lit("779").alias("category"), "priceHistory", F.floor(F.col("o_custkey") / 100).alias("part")
    )
    bodies = items.groupBy("part").agg(F.to_json(F.collect_list(F.struct("id", "name", "category", "priceHistory"))).alias("body"))
    found = parsers.usable_items(parsers.dump_items(bodies))
    days = F.transform("hist", lambda h: h["on_date"])
    return found.select("id", "name", F.size("hist").cast("bigint").alias("n"), F.aggregate("hist", F.lit(0).cast("bigint"), lambda a, h: a + h["cents"]).alias("total"), F.array_min(days).alias("first"), F.array_max(days).alias("last"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation")
def category_dimension(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return parsers.labels_of(n.groupBy("n_regionkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name")))).alias("body")))


@query(f"""WITH {_SALES_SQL}
SELECT p_name || ' ' || p_partkey AS name, CASE WHEN p_partkey % 5 = 0 THEN 'Uncategorised'
  ELSE p_type END AS category, regular AS regular_cents, sale AS sale_cents,
       pct AS discount_pct, pct >= 50 AS is_half_price, CASE p_partkey % 3 WHEN 0 THEN 'L' || p_partkey WHEN 1 THEN 'S' || p_partkey END AS image_url,
       CASE WHEN p_partkey % 29 <> 0 THEN 'woolworths:' || p_partkey END AS sku FROM s WHERE p_partkey % 19 <> 0 AND p_partkey % 31 <> 0""")
def browse_rows(spark, sf_dir):
    """Bundles of products, some without a name, a price or a stock number."""
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    tile = F.struct(
        F.when(k % 19 == 0, "  ").otherwise(F.concat(F.lit(" "), F.concat_ws(" ", "p_name", key))).alias("Name"),
        F.when(k % 31 != 0, F.col("sale") / 100.0).alias("Price"), (F.col("regular") / 100.0).cast("string").alias("WasPrice"), F.when(k % 29 != 0, k).alias("Stockcode"),
        F.when(k % 5 == 0, " ").otherwise(F.col("p_type")).alias("Department"), F.when(k % 3 == 0, F.concat(F.lit("L"), key)).otherwise("").alias("LargeImageFile"),
        F.when(k % 3 == 1, F.concat(F.lit("S"), key)).alias("SmallImageFile"),
    )
    page = F.floor(k / 400).alias("page")
    bundle = _offers(spark, sf_dir).groupBy(page, "p_brand").agg(F.struct(F.collect_list(tile).alias("Products")).alias("b"))
    return parsers.browse_specials(bundle.groupBy("page").agg(F.to_json(F.struct(F.collect_list("b").alias("Bundles"))).alias("body")))


_RUNS_SQL = """WITH o AS (SELECT o_custkey % 200 AS run, o_orderkey % 10 AS page, row_number() OVER (PARTITION BY o_custkey % 200,
  o_orderkey % 10 ORDER BY o_orderkey) - 1 AS pos, CASE WHEN o_orderkey % 3 = 0 THEN 'ITEM ' ELSE 'Item ' END || (o_orderkey // 10 % 37) AS name
  FROM orders),
g AS (SELECT DISTINCT run, page, (run % 5 = 0 AND page = 6) AS failed, (run % 7 = 3 AND page = 4) AS empty FROM o),
b AS (SELECT run, min(page) AS stop, arg_min(failed, page) AS failed FROM g WHERE failed OR empty GROUP BY run),
e AS (SELECT o.*, CASE o.run % 4 WHEN 0 THEN 20 WHEN 1 THEN NULL ELSE 35 END AS total FROM o LEFT JOIN b USING (run) WHERE stop IS NULL OR page < stop),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, lower(name) ORDER BY page, pos) AS r FROM e) WHERE r = 1),
k AS (SELECT f.*, (SELECT count(*) FROM f x WHERE x.run = f.run AND x.page < f.page) AS had FROM f)"""


def _paged(spark, sf_dir):
    """Runs of pages of names; some end in an empty page, some fail at one."""
    run, page = (F.col("o_custkey") % 200).alias("run"), (F.col("o_orderkey") % 10).alias("page")
    name = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "ITEM ").otherwise("Item "), (F.floor(F.col("o_orderkey") / 10) % 37).cast("string"))
    p = table(spark, sf_dir, "orders").groupBy(run, page).agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", name.alias("n")))), lambda x: x["n"]).alias("names"))
    empty = (F.col("run") % 7 == 3) & (F.col("page") == 4)
    total = F.when(F.col("run") % 4 == 0, 20).when(F.col("run") % 4 != 1, 35)
    return p.select("run", "page", F.when(~empty, F.col("names")).otherwise(F.expr("CAST(array() AS ARRAY<STRING>)")).alias("names"), total.alias("total"), ((F.col("run") % 5 == 0) & (F.col("page") == 6)).alias("failed"))


@query(_RUNS_SQL + " SELECT run, page, CAST(pos AS INT) AS pos, name FROM k WHERE total IS NULL OR had < total")
def paged_items(spark, sf_dir):
    return parsers.collect_pages(_paged(spark, sf_dir))[0]


@query(_RUNS_SQL + """, h AS (SELECT run, count(*) AS items, max(total) AS total FROM k WHERE total IS NULL OR had < total GROUP BY run)
SELECT g.run, coalesce(items, 0) AS items, CASE WHEN coalesce(b.failed, false) AND (h.total IS NULL OR coalesce(items, 0) < h.total) THEN CASE
  WHEN items > 0 THEN 'partial' ELSE 'failed' END WHEN items > 0 THEN 'success' ELSE 'no_data' END AS status
FROM (SELECT DISTINCT run FROM g) g LEFT JOIN b USING (run) LEFT JOIN h USING (run)""")
def paged_runs(spark, sf_dir):
    return parsers.collect_pages(_paged(spark, sf_dir))[1]


@query("SELECT DISTINCT o_custkey % 200 AS run, o_orderkey % 10 AS page FROM orders WHERE (o_custkey % 200, o_orderkey % 10) NOT IN (SELECT (o_custkey % 200, o_orderkey % 10) FROM orders WHERE o_orderstatus = 'F')")
def resumed_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 200).alias("run"), (F.col("o_orderkey") % 10).alias("page"), "o_orderstatus")
    return parsers.remaining_pages(pages.select("run", "page").distinct(), pages.where("o_orderstatus = 'F'"))


@query(f"""WITH {_SALES_SQL}
SELECT CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN lower(p_brand) || ' ' ELSE p_brand || ' ' END || p_name || ' ' || p_partkey AS name,
       regular AS regular_cents, sale AS sale_cents, CASE WHEN p_partkey % 6 = 1 THEN 33 ELSE pct END AS discount_pct,
       CASE WHEN p_partkey % 6 = 1 THEN false ELSE pct >= 50 END AS is_half_price,
       'https://img' || CASE
  WHEN p_partkey % 4 = 1 THEN '/u/' || p_partkey ELSE '/' || left(CAST(p_partkey AS VARCHAR), 1) || '/' || p_partkey || '.jpg' END AS image_url,
       CAST(p_partkey AS VARCHAR) AS sku
FROM s WHERE p_partkey % 10 <> 7""")
def embedded_listing(spark, sf_dir):
    """Pages with the listing's JSON in a script element; saved percentages as numbers, texts, fractions and nulls, prices as numbers and texts."""
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    said = lambda c: F.to_json(F.struct(c.alias("x"))).substr(F.lit(6), F.lit(1 << 20))  # noqa: E731  the value and the closing brace
    json = lambda c: F.regexp_replace(said(c), r"\}$", "")
    money = lambda c: F.when(k % 5 == 0, F.concat(F.lit('"'), (F.col(c) / 100.0).cast("string"), F.lit('"'))).otherwise((F.col(c) / 100.0).cast("string"))
    named = F.concat_ws(" ", "p_name", key)
    brand = F.when(k % 3 != 0, F.concat(F.lit(',"brand":'), json(F.col("p_brand")))).otherwise("")
    saved = F.element_at(F.array(*map(F.lit, ("", ',"savePercent":33', ',"savePercent":"33"', ',"savePercent":null', ',"savePercent":33.5', ',"savePercent":"half"'))), (k % 6 + 1).cast("int"))
    product = F.concat(
        F.lit('{"_type":'), F.when(k % 10 == 7, '"AD"').otherwise('"PRODUCT"'), F.lit(',"id":'), F.when(k % 2 == 0, key).otherwise(F.concat(F.lit('"'), key, F.lit('"'))),
        F.lit(',"name":'), json(F.when(k % 3 == 1, F.concat_ws(" ", F.lower("p_brand"), named)).otherwise(F.concat(F.lit("  "), named))), brand,
        F.lit(',"pricing":{"now":'), money("sale"), F.lit(',"was":'), money("regular"), saved, F.lit("}"),
        F.when(k % 4 == 1, F.concat(F.lit(',"imageUris":[{"uri":"/u/'), key, F.lit('"}]'))).when(k % 4 == 2, ',"imageUris":[]').otherwise(""), F.lit("}"),
    )
    body = F.concat(F.lit('{"props":{"pageProps":{"searchResults":{"results":['), F.array_join(F.collect_list(product), ","), F.lit("]}}}}"))
    html = F.concat(F.lit('<html><script>var a = 1;</script><script type="application/json" id="__NEXT_DATA__">'), body, F.lit("</script></html>"))
    pages = _offers(spark, sf_dir).groupBy(F.floor(k / 200)).agg(html.alias("html"))
    found = pages.select(parsers.embedded_json("html", path="$.props.pageProps.searchResults.results").alias("results"))
    return parsers.listing_specials(found, cdn="https://img")


@query("""SELECT n_nationkey AS k, CASE WHEN n_nationkey % 5 = 0 THEN 'https://x.org/node/1' || n_nationkey
  WHEN n_nationkey % 5 = 1 THEN 'https://site.org/node/2' || n_nationkey WHEN n_nationkey % 5 = 2 THEN 'https://site.org/node/3' || n_nationkey END AS link,
CASE WHEN n_nationkey % 3 = 0 THEN DATE '2001-06-13' ELSE DATE '2001-06-27' END AS week_start, CASE WHEN n_nationkey % 3 = 0 THEN DATE '2001-06-19'
  ELSE DATE '2001-07-03' END AS week_end FROM nation""")
def report_posts(spark, sf_dir):
    """The report's link on a user page, else on the search page, and the week that its heading names."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey").cast("string")
    kind = F.col("n_nationkey") % 5
    a = lambda href, title: F.concat(F.lit('<a class="x" href="'), href, F.lit('">'), F.lit(title), F.lit("</a>"))
    noise = F.concat(a(F.lit("/user/1"), "Catalogue Half-Price Report"), a(F.lit("/node/9"), "Another deal"))
    user = F.concat(noise, F.when(kind == 0, a(F.concat(F.lit("https://x.org/node/1"), key), "The <b>catalogue</b>\n half-price report")).when(kind == 1, a(F.concat(F.lit("/node/2"), key), "1/2 Price Tea + 12 more")).otherwise(""), a(F.lit("/node/8"), "1/2 price tea"))
    search = F.concat(noise, F.when(kind < 3, a(F.concat(F.lit("/node/3"), key), "12 price things + 3 MORE")).otherwise(""))
    head = F.when(F.col("n_nationkey") % 3 == 0, "<h5>Intro 2001-01-01</h5><h5 class='a'>Catalogue Half-Price Report — 2001-06-13</h5>").when(F.col("n_nationkey") % 3 == 1, "<h5>Catalogue Half-Price Report</h5>").otherwise("<p>none</p>")
    pages = n.select("n_nationkey", user.alias("user"), search.alias("search"), head.alias("post"))
    week = parsers.report_week("post", F.lit(AS_OF).cast("date"))
    return pages.select(F.col("n_nationkey").alias("k"), F.coalesce(parsers.report_link("user", "https://site.org"), parsers.report_link("search", "https://site.org")).alias("link"), week["week_start"].alias("week_start"), week["week_end"].alias("week_end"))


_SHEETS_SQL = f"""p AS (SELECT *, {_CENTS_SQL} AS regular, CAST(round_even(p_retailprice * 100 * {_SHARE_SQL}, 0) AS BIGINT) AS sale FROM part),
l AS (SELECT *, 's' || p_partkey // 700 AS file, row_number() OVER (PARTITION BY p_partkey // 700 ORDER BY p_partkey) + 1 AS line,
      CASE p_partkey % 5 WHEN 0 THEN 'coles' WHEN 1 THEN 'woolworths' WHEN 2 THEN 'woolworths' WHEN 4 THEN 'coles' END AS retailer FROM p),
g AS (SELECT * FROM l WHERE p_partkey // 700 % 4 <> 3 AND retailer IS NOT NULL AND p_partkey % 9 <> 0 AND p_partkey % 8 <> 1 AND p_partkey % 19 <> 0
  AND sale < regular)"""


def _sheets(spark, sf_dir) -> DataFrame:
    """Sheets of 700 parts each, in the order of the file's cells; every fourth has another header."""
    k = F.col("p_partkey")
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(c, '"', '""'), F.lit('"'))
    dollars = lambda c: quoted(F.concat(F.lit(" $ "), F.format_number(F.col(c) / 100.0, 2), F.lit(" ")))
    shop = F.element_at(F.array(*map(F.lit, ("Coles", "Woolworths", " Woolies ", "Aldi", "COLES "))), (k % 5 + 1).cast("int"))
    name = F.when(k % 19 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("p_name"), F.lit(', "big"\nnumber '), k.cast("string"), F.lit(" ")))
    pct = F.when(k % 8 == 1, "").otherwise(F.concat(F.lit(" "), (k % 90).cast("string"), F.lit(".25% ")))
    last = F.when(k % 3 == 0, F.concat((k % 9 + 1).cast("string"), F.lit(" weeks ago @ CL"))).when(k % 3 == 1, " 1 week ago @ ww ").otherwise("—")
    cells = [shop, quoted(name), F.when(k % 6 == 0, " ").otherwise(F.col("p_type")), dollars("regular"), F.lit("each"), dollars("sale"), pct, F.lit("")]
    row = F.concat(F.array_join(F.array(*cells), ","), F.when(k % 9 == 0, "").otherwise(F.concat(F.lit(","), last)))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("r")))), lambda x: x["r"])
    head = F.when(F.col("part") % 4 == 3, "Shop,Name,Category").otherwise(" Retailer,Name ,Category,Regular,Unit,Sale,Off,Unit,Last")
    made = _offers(spark, sf_dir).groupBy(F.floor(k / 700).alias("part")).agg(rows.alias("rows"))
    body = F.concat(F.lit("All offers of the week\n"), head, F.lit("\n"), F.array_join("rows", "\n"), F.lit("\n"))
    return tables.sheet_lines(made.select(F.concat(F.lit("s"), F.col("part").cast("string")).alias("file"), body.alias("body")))


@query(f"""WITH {_SHEETS_SQL}
SELECT file, CAST(line AS INT) AS line, retailer, p_name || ', "big"' || chr(10) || 'number ' || p_partkey AS name,
       CASE WHEN p_partkey % 6 = 0 THEN 'Uncategorised' ELSE p_type END AS category, regular AS regular_cents, sale AS sale_cents,
       CAST(p_partkey % 90 AS INT) AS discount_pct, p_partkey % 90 >= 50 AS is_half_price,
       CASE p_partkey % 3 WHEN 0 THEN (p_partkey % 9 + 1) || ' weeks ago @ CL' WHEN 1 THEN ' 1 week ago @ ww ' ELSE '—' END AS last_raw,
       CASE p_partkey % 3 WHEN 0 THEN CAST(p_partkey % 9 + 1 AS INT) WHEN 1 THEN 1 END AS last_weeks,
       CASE p_partkey % 3 WHEN 0 THEN 'coles' WHEN 1 THEN 'woolworths' END AS last_retailer FROM g""")
def sheet_rows(spark, sf_dir):
    """The specials of sheets, five thousand of a sheet at most as its format has it."""
    return tables.sheet_specials(_sheets(spark, sf_dir))


@query(f"""WITH {_SHEETS_SQL}, n AS (SELECT file, count(*) AS items FROM g GROUP BY file)
SELECT DISTINCT file, CASE WHEN p_partkey // 700 % 4 = 3 THEN 'failed' WHEN items > 0 THEN 'success' ELSE 'no_data' END AS status, coalesce(items, 0) AS items
FROM l LEFT JOIN n USING (file)""")
def sheet_status(spark, sf_dir):
    """How the reading of each sheet ended; a sheet with another header fails without stopping the others."""
    lines = _sheets(spark, sf_dir)
    return tables.sheet_runs(lines, tables.sheet_specials(lines))


@query(f"""WITH p AS (SELECT *, {_CENTS_SQL} AS regular, CAST(round_even(p_retailprice * 100 * {_SHARE_SQL}, 0) AS BIGINT) AS sale,
  p_partkey // 300 AS own FROM part),
q AS (SELECT *, p_partkey % 4 = 1 AND own > 0 AS early FROM p WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 17 <> 0)
SELECT CASE WHEN early THEN own - 1 ELSE own END AS page, CASE WHEN p_partkey % 2 = 0 THEN 'coles'
  ELSE 'woolworths' END AS retailer, p_name || ' & ' || p_partkey AS name,
       CASE WHEN early THEN 'Group 8'
  WHEN p_size % 5 = 0 THEN 'Uncategorised' ELSE 'Group ' || p_size % 5 END AS category, regular AS regular_cents, sale AS sale_cents,
       CAST(p_partkey % 90 AS INT) AS discount_pct, p_partkey % 90 >= 50 AS is_half_price,
       CASE p_partkey % 3 WHEN 0 THEN '8 weeks ago @ CL' WHEN 1 THEN '—' ELSE '' END AS last_raw, CASE WHEN p_partkey % 3 = 0 THEN 8 END AS last_weeks,
       CASE WHEN p_partkey % 3 = 0 THEN 'coles' END AS last_retailer FROM q""")
def html_table_rows(spark, sf_dir):
    """A report over several pages: its own heading is no category, rows of other shapes are left out, and of a row on two pages the earlier page's counts."""
    k, own = F.col("p_partkey"), F.floor(F.col("p_partkey") / 300)
    shown = lambda c: F.concat(F.lit("$"), F.format_number(F.col(c) / 100.0, 2))
    shop = F.when(k % 11 == 0, "Aldi").when(k % 2 == 0, "<b>Coles</b> online").otherwise(" WW ")
    cells = [
        shop, F.concat(F.col("p_name"), F.lit(" &amp; <i>"), k.cast("string"), F.lit("</i>")), shown("regular"), F.lit("$1 / 100g"), F.when(k % 13 == 0, "n/a").otherwise(shown("sale")),
        F.concat((k % 90).cast("string"), F.when(k % 17 == 0, ".5%").otherwise("% ")), F.when(k % 3 == 0, "8 weeks ago @ CL").when(k % 3 == 1, "—"),
    ]
    row = F.concat(F.lit("<tr>"), F.array_join(F.transform(F.slice(F.array_compact(F.array(*cells)), F.lit(1), F.when(k % 7 == 0, 5).otherwise(7)), lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))), ""), F.lit("</tr>"))
    place = lambda at, sec: F.struct(at.alias("page"), sec.alias("sec"))
    places = F.array(place(own, F.col("p_size") % 5), F.when(k % 4 == 0, place(own + 1, F.lit(9))), F.when((k % 4 == 1) & (own > 0), place(own - 1, F.lit(8))))
    each = _offers(spark, sf_dir).select("p_partkey", row.alias("r"), F.explode(F.array_compact(places)).alias("at")).select("p_partkey", "r", "at.*")
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "r"))), lambda x: x["r"]), "")
    sections = each.groupBy("page", "sec").agg(F.concat(F.lit("<table class='wide data'><thead><tr><th>Shop</th></tr></thead><tbody>"), rows, F.lit("</tbody></table>")).alias("t"))
    named = F.concat(F.when(F.col("sec") > 0, F.concat(F.lit("<h5>Group <b>"), F.col("sec").cast("string"), F.lit("</b></h5>"))).otherwise(""), F.col("t"), F.lit("<table><tr><td>x</td></tr></table>"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sec", named.alias("h")))), lambda x: x["h"]), "<p>next</p>")
    pages = sections.groupBy("page").agg(F.concat(F.lit("<h5>Catalogue Half-Price Report — 2001-06-13</h5>"), whole).alias("html"))
    return tables.table_specials(pages).drop("pos")


@query(f"""WITH {_SALES_SQL}, x AS (SELECT p_partkey AS k, p_name || ' & ' || p_partkey AS name, p_partkey % 6 = 0 AS half, sale, regular
  FROM p WHERE p_partkey % 23 <> 0)
SELECT CAST(k AS VARCHAR) AS id, name, half AS is_half, sale AS sale_cents, CASE WHEN k % 4 < 3 THEN regular END AS was_cents,
       left(CASE WHEN half THEN '1/2 Price — ' ELSE 'Special: ' END || name || ' of the week, while stocks last everywhere', 40) AS discount_desc FROM x""")
def callback_catalogue(spark, sf_dir):
    """Catalogues in and out of a callback, items in and out of a wrapping object, with character references; of an item read twice the half-price reading counts."""
    k, key = F.col("p_partkey"), F.col("p_partkey").cast("string")
    name = F.concat(F.lit(" "), F.col("p_name"), F.lit(" &amp; "), key)
    half = k % 6 == 0
    says = lambda h: F.concat(F.when(h, "1/2 Price &mdash; ").otherwise("Special: "), F.trim(name), F.lit(" of the week, while stocks last everywhere"))
    was = F.format_string("%.2f", F.col("regular") / 100.0)
    option = F.when(k % 4 == 0, F.concat(F.lit("Was $"), was, F.lit("."))).when(k % 4 == 1, F.concat(F.lit("was $ "), was, F.lit(" each"))).when(k % 4 == 2, F.concat(F.lit("each, WAS"), was)).otherwise("each")
    sale = (F.col("sale") / 100.0).cast("string")
    first = F.element_at(F.array(F.lit('"priceSale":""'), F.concat(F.lit('"priceSale":"'), sale, F.lit('"')), F.concat(F.lit('"priceSale":'), sale), F.lit('"priceSale":0'), F.lit('"priceSale":null')), (k % 5 + 1).cast("int"))
    rest = F.concat(F.lit(',"priceReg":"'), sale, F.lit('","priceOptionDesc":"'), option, F.lit('"}]}'))
    code = F.when(k % 23 == 0, "P").otherwise(F.concat(key, F.lit("P")))
    plain = lambda h: F.regexp_replace(F.to_json(F.struct(code.alias("SKU"), name.alias("itemName"), says(h).alias("description"))), r"\}$", "")
    item = lambda h: F.concat(plain(h), F.lit(',"prices":[{'), first, rest)
    wrapped = lambda j: F.when(k % 2 == 0, F.concat(F.lit('{"items":'), j, F.lit("}"))).otherwise(j)
    listed = F.array_join(F.flatten(F.collect_list(F.array(wrapped(item(F.lit(False))), wrapped(item(half))))), ",")
    made = _offers(spark, sf_dir).groupBy(F.floor(k / 300).alias("pos")).agg(F.concat(F.lit('{"items":['), listed, F.lit("]}")).alias("json"))
    body = F.when(F.col("pos") % 3 == 0, F.col("json")).otherwise(F.concat(F.lit("cb_1("), F.col("json"), F.lit(") ;\n")))
    return parsers.catalogue_items(made.select("pos", body.alias("body")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 9 <> 0 AND CAST(o_orderdate AS DATE) <= DATE '1998-06-30' AND CAST(o_orderdate AS DATE) + 300 >= DATE '1998-06-30'")
def running_catalogues(spark, sf_dir):
    """Callbacks that list catalogues, every second one wrapped; malformed dates leave a catalogue out."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    start = F.when(k % 9 == 0, "soon").otherwise(day.cast("string"))
    sale = F.to_json(F.struct(k.alias("saleId"), start.alias("startDate"), F.date_add(day, 300).cast("string").alias("endDate")))
    wrapped = F.when(k % 2 == 0, F.concat(F.lit('{"items":'), sale, F.lit("}"))).otherwise(sale)
    bodies = table(spark, sf_dir, "orders").groupBy(F.floor(k / 1000)).agg(F.concat(F.lit('cb({"items":['), F.array_join(F.collect_list(wrapped), ","), F.lit("]});")).alias("body"))
    return parsers.running_sales(parsers.sale_rows(bodies), "1998-06-30").select(F.col("id").cast("bigint").alias("o_orderkey"))


@query("""SELECT 'coles' AS retailer, CAST(p_partkey AS VARCHAR) AS id, replace(p_name, ' ', '-') AS slug FROM part WHERE p_partkey % 2 = 0
UNION ALL SELECT 'woolworths', CAST(p_partkey AS VARCHAR), replace(p_name, ' ', '-') FROM part WHERE p_partkey % 2 = 1
  UNION ALL SELECT 'index', '', 'https://x/Product-' || n_nationkey || '.xml' FROM nation WHERE n_nationkey % 2 = 0""")
def sitemap_rows(spark, sf_dir):
    """Product addresses of two layouts, and the product sitemaps of an index."""
    p, n = table(spark, sf_dir, "part"), table(spark, sf_dir, "nation")
    key, slug = F.col("p_partkey").cast("string"), F.regexp_replace("p_name", " ", "-")
    loc = lambda *c: F.concat(F.lit("<url><loc>"), *c, F.lit("</loc></url>"))
    address = F.when(F.col("p_partkey") % 2 == 0, loc(F.lit("https://x/product/"), slug, F.lit("-"), key)).otherwise(loc(F.lit("https://x/shop/productdetails/"), key, F.lit("/"), slug, F.lit("/")))
    maps = p.groupBy("p_size").agg(F.concat(F.lit("<urlset><url><loc>https://x/about</loc></url>"), F.array_join(F.collect_list(address), "\n"), F.lit("</urlset>")).alias("xml"))
    index = n.groupBy("n_regionkey").agg(F.array_join(F.collect_list(loc(F.when(F.col("n_nationkey") % 2 == 0, "https://x/Product-").otherwise("https://x/recipes-"), F.col("n_nationkey").cast("string"), F.lit(".xml"))), "").alias("xml"))
    links = [parsers.sitemap_links(maps, r).select(F.lit(r).alias("retailer"), "id", "slug") for r in ("coles", "woolworths")]
    return links[0].union(links[1]).union(parsers.child_sitemaps(index).select(F.lit("index"), F.lit(""), "loc"))


_FOUND_SQL = """WITH n AS (SELECT p_partkey AS k, p_name || ' ' || p_type || ' ' || p_size || 'g' AS name FROM part), m AS (SELECT count(*) AS c FROM part),
r AS (SELECT a.k AS pid, d AS pos, b.name FROM n a, m, (VALUES (0), (1), (2), (3), (4), (5)) t(d) JOIN n b ON b.k = (a.k + 7 * d + 1) % c WHERE a.k % 3 = 0)"""


def _searched(spark, sf_dir):
    """What a search gives for every third name: six names further on, in tiles of two."""
    p = table(spark, sf_dir, "part")
    named = p.select(F.col("p_partkey").alias("k"), F.concat_ws(" ", "p_name", "p_type", F.concat(F.col("p_size").cast("string"), F.lit("g"))).alias("name"))
    count = F.broadcast(p.agg(F.count("*").alias("c")))  # one row
    asked = named.where("k % 3 = 0")
    wanted = asked.crossJoin(count).select(F.col("k").alias("pid"), "c", F.explode(F.expr("sequence(0, 5)")).alias("d"))
    wanted = wanted.withColumn("k", (F.col("pid") + 7 * F.col("d") + 1) % F.col("c")).drop("c")
    product = F.struct(F.col("name").alias("Name"), F.col("k").cast("string").alias("Stockcode"), F.when(F.col("k") % 2 == 0, "slug").otherwise("").alias("UrlFriendlyName"), F.lit("").alias("LargeImageFile"), F.concat(F.lit("m"), F.col("k").cast("string")).alias("MediumImageFile"))
    got = wanted.join(named, "k").groupBy("pid").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", product.alias("p")))), lambda x: x["p"]).alias("ps"))
    tiles = F.array(*[F.struct(F.slice("ps", s, 2).alias("Products")) for s in (1, 3, 5)])
    bodies = got.select("pid", F.to_json(F.struct(tiles.alias("Products"))).alias("body"))
    return asked.select(F.col("k").alias("pid"), "name"), parsers.search_results(bodies, site="https://x/p")


@query(_FOUND_SQL + " SELECT pid, CAST(pos AS INT) AS pos, name, 'm' || ((pid + 7 * pos + 1) % c) AS image_url, CASE WHEN ((pid + 7 * pos + 1) % c) % 2 = 0 THEN 'https://x/p/' || ((pid + 7 * pos + 1) % c) || '/slug' ELSE '' END AS product_url FROM r, m")
def search_tiles(spark, sf_dir):
    return _searched(spark, sf_dir)[1]


@query(_FOUND_SQL + """, t AS (SELECT pid, pos, r.name, list_distinct(list_filter(string_split(lower(n.name), ' '), lambda w: length(w) > 1)) AS q,
  list_distinct(list_filter(string_split(lower(r.name), ' '), lambda w: length(w) > 1)) AS o FROM r JOIN n ON n.k = pid),
s AS (SELECT *, len(list_intersect(q, o)) / len(q) AS overlap FROM t) SELECT pid, CAST(pos AS INT) AS pos, name, overlap
  FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY overlap DESC, pos) AS r FROM s WHERE overlap >= 0.6) WHERE r = 1""")
def best_search_result(spark, sf_dir):
    asked, found = _searched(spark, sf_dir)
    return writes.resolved_names(asked, found, scalars.search_tokens("name"), scalars.search_tokens("name"))


@query("SELECT o_orderkey AS id, o_orderstatus AS status FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
def newest_scrape(spark, sf_dir):
    """The specials of the newest of many runs, by the runs' names."""
    o = table(spark, sf_dir, "orders")
    runs = o.groupBy(F.concat(F.lit("specials_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("file")).agg(F.collect_list(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))).alias("specials"))
    return parsers.newest_run(runs)



@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 < 2 THEN CAST(round_even(o_totalprice * 100, 0) AS BIGINT) END AS cents, CASE
  WHEN o_orderkey % 4 <> 3 THEN CAST(round_even(o_totalprice * 100, 0) AS BIGINT) END AS amount,
CAST(o_custkey % 100 AS INT) AS percent, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 30 AS INT) END AS weeks, CASE
  WHEN o_orderkey % 3 = 0 THEN 'woolworths' END AS hinted,
CASE o_orderkey % 6 WHEN 0 THEN 'coles' WHEN 1 THEN 'woolworths' WHEN 2 THEN 'woolworths' WHEN 5 THEN 'coles' END AS retailer,
CASE o_orderkey % 6 WHEN 4 THEN 'woolworths' WHEN 5 THEN 'coles' END AS exact_retailer FROM orders""")
def money_cells(spark, sf_dir):
    """Prices, percentages, hints and retailers as texts of different care."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    fixed = F.format_string("%.2f", "o_totalprice")
    x = o.select(
        k.alias("k"), F.element_at(F.array(fixed, F.concat(F.lit(" "), fixed, F.lit(" ")), F.concat(F.lit("-"), fixed), F.lit("soon"), F.lit(None).cast("string")), (k % 5 + 1).cast("int")).alias("price"),
        F.element_at(F.array(F.concat(F.lit("$"), F.format_number("o_totalprice", 2)), F.concat(F.lit("now $ "), fixed, F.lit(" ea")), fixed, F.lit("free")), (k % 4 + 1).cast("int")).alias("dollars"),
        F.concat(F.lit(" "), (F.col("o_custkey") % 100).cast("string"), F.lit("% ")).alias("pct"),
        F.when(k % 3 == 0, F.concat((F.col("o_custkey") % 30).cast("string"), F.lit(" Weeks  ago @ WW (approx)"))).when(k % 3 == 1, "about 3 weeks ago @ CL").alias("last"),
        F.element_at(F.array(*map(F.lit, ("Coles Express", " ww", "The Woolworths", "Aldi", "Woolies ", " COLES"))), (k % 6 + 1).cast("int")).alias("shop"),
    )
    h = scalars.hint("last")
    return x.select("k", scalars.cents("price").alias("cents"), scalars.dollars_to_cents("dollars").alias("amount"), scalars.percent("pct", strict=True).alias("percent"), h["weeks"].alias("weeks"), h["retailer"].alias("hinted"), scalars.retailer_cell("shop").alias("retailer"), scalars.retailer_cell("shop", exact=True).alias("exact_retailer"))


@query("""SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE 'stockup:' || lower(p_name) || ' big' END AS sku,
  CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' 500g' WHEN 2 THEN p_name ELSE p_name || ' pack' END AS query,
CASE WHEN p_partkey % 2 = 0 THEN 'https://b/large/' || p_partkey || '.jpg'
  ELSE 'https://a/' || left(CAST(p_partkey AS VARCHAR), 1) || '/' || p_partkey || '.jpg' END AS image,
CASE p_partkey % 4 WHEN 0 THEN 'http://y/z' WHEN 1 THEN 'https://y/z' WHEN 2 THEN 'https://x.org/z'
  ELSE 'https://x.org/z' END AS url, 'the cafe ' || replace(p_name, ' ', ' and ') AS folded FROM part""")
def text_keys(spark, sf_dir):
    """Stock keys, cleaned queries, image addresses, absolute addresses and folded names."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    x = p.select(
        k.alias("k"), F.when(k % 3 == 0, k.cast("string")).alias("sku"), F.concat(F.lit("  "), F.initcap("p_name"), F.lit("   BIG ")).alias("name"), k.cast("string").alias("id"), F.when(k % 2 == 0, "woolworths").otherwise("coles").alias("retailer"),
        F.element_at(F.array(F.concat(F.lit("NEW "), "p_name", F.lit(" or other things")), F.concat("p_name", F.lit(" 500g - 1kg")), F.concat("p_name", F.lit(" – from the Bakery")), F.concat("p_name", F.lit(" pack"))), (k % 4 + 1).cast("int")).alias("long"),
        F.element_at(F.array(*map(F.lit, ("http://y/z", "//y/z", "/z", "z"))), (k % 4 + 1).cast("int")).alias("href"),
        F.concat(F.lit("ＴＨＥ Café™ "), F.regexp_replace("p_name", " ", " & ")).alias("marked"),
    )
    return x.select("k", scalars.sku_key("sku", "name").alias("sku"), scalars.search_query("long").alias("query"), scalars.image_url("retailer", "id", "https://a", "https://b").alias("image"), scalars.absolute_url("href", "https://x.org").alias("url"), scalars.normal_name(F.col("marked")).alias("folded"))


_WORDS_SQL = "array_to_string(list_sort(list_distinct(list_filter(string_split(replace(lower(p_name), 'ring', '{}'), ' '), lambda w: length(w) > 1))), ' ')"


@query(f"SELECT p_partkey AS k, {_WORDS_SQL.format('cafe')} AS folded, {_WORDS_SQL.format('caf')} AS plain FROM part")
def name_words(spark, sf_dir):
    """Search words with and without accents folded."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.regexp_replace(F.initcap("p_name"), "(?i)ring", "Café").alias("n"))
    return p.select("k", F.array_join(F.array_sort(scalars.search_tokens("n")), " ").alias("folded"), F.array_join(F.array_sort(scalars.search_tokens("n", folded=False)), " ").alias("plain"))


_PRODUCTS_SQL = """pr AS (SELECT p_partkey AS product_id, CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END AS retailer, p_name AS name, CASE
  WHEN p_size % 4 <> 0 THEN p_type END AS category FROM part),
st AS (SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS week_start, count(*) AS sale_cents, bool_or(l_discount >= 0.05) AS is_half_price
  FROM lineitem WHERE l_partkey % 3 = 0 GROUP BY ALL)"""


@query(f"WITH {_PRODUCTS_SQL} SELECT retailer, name, coalesce(category, 'Uncategorised') AS category, CAST(2 * sale_cents AS BIGINT) AS regular_cents, sale_cents, is_half_price, week_start FROM st JOIN pr USING (product_id)")
def stored_specials(spark, sf_dir):
    """Stored specials with their products, as the predictor reads them."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.when(F.col("p_partkey") % 2 == 0, "A").otherwise("B").alias("retailer"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 4 != 0, F.col("p_type")).alias("category"))
    s = table(spark, sf_dir, "lineitem").where("l_partkey % 3 = 0").groupBy(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("week_start")).agg(F.count("*").alias("sale_cents"), F.bool_or(F.col("l_discount") >= 0.05).alias("is_half_price"))
    s = s.select("*", (2 * F.col("sale_cents")).alias("regular_cents"), F.lit(50).alias("discount_pct"), F.date_add("week_start", 6).alias("week_end"), F.lit("dump").alias("source"))
    return writes.weekly_specials(s, p).drop("discount_pct", "week_end", "source")


@query("SELECT o_custkey AS a, o_orderkey AS b FROM orders ORDER BY md5('42:' || o_custkey || ':' || o_orderkey), a, b LIMIT 100")
def audit_sample(spark, sf_dir):
    """A hundred pairs for a manual audit, as the feature has it."""
    return digests.audit_sample(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b")), 100)


@query("SELECT o_custkey AS a, o_orderkey AS b, o_totalprice AS score FROM orders ORDER BY score DESC, a, b LIMIT 6")
def top_matches(spark, sf_dir):
    """The six matches that a report lists."""
    return matching.top_matches(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b"), F.col("o_totalprice").alias("score")))


@query(f"""WITH x AS (SELECT p_partkey AS k, p_partkey % 4 = 0 AS market, {_CENTS_SQL} AS cents
  FROM part) SELECT 'products' AS name, CAST(count(*) FILTER (NOT market) AS BIGINT) AS n FROM x
  UNION ALL SELECT 'half_now', CAST(count(*) FILTER (NOT market AND k % 3 = 1) AS BIGINT) FROM x
UNION ALL SELECT 'half_ever', CAST(count(*) FILTER (NOT market AND k % 3 > 0) AS BIGINT) FROM x
  UNION ALL SELECT 'marketplace', CAST(count(*) FILTER (market) AS BIGINT) FROM x""")
def parse_summary(spark, sf_dir):
    """Counts of one parse: a third of the parts half price now, a third long ago, a third never."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.expr(_CENTS).alias("cents"))
    on = lambda days, price: F.struct(F.date_sub(F.lit(WEEK).cast("date"), days).alias("on_date"), price.cast("bigint").alias("cents"))
    third = F.col("k") % 3
    hist = F.when(third == 1, F.array(on(1, F.col("cents")), on(90, 3 * F.col("cents")))).when(third == 2, F.array(on(100, 3 * F.col("cents")), on(200, F.col("cents")), on(300, 3 * F.col("cents")))).otherwise(F.array(on(1, F.col("cents"))))
    items = p.select(F.lit("A").alias("retailer"), F.col("k").alias("item"), hist.alias("hist"), (F.col("k") % 4 == 0).alias("marketplace"))
    return parsers.parse_counts(items, pricing.products(items.where("NOT marketplace"), WEEK))


_FORMS_SQL = """WITH p AS (SELECT p_partkey AS k, p_size AS n, p_partkey % 40 + 1 AS m FROM part),
q AS (SELECT k, n, m, CASE k % 7 WHEN 0 THEN n * m WHEN 1 THEN m * 1000 WHEN 2 THEN m WHEN 3 THEN m * 250 WHEN 4 THEN n * 500 + m END AS g,
      CASE k % 7 WHEN 2 THEN n WHEN 5 THEN n * m * 1000 + 1500 WHEN 3 THEN 330 * n END AS ml, CASE k % 7 WHEN 6 THEN CAST(n AS VARCHAR)
  WHEN 4 THEN '4' ELSE '' END AS counts FROM p)"""


@query(_FORMS_SQL + """ SELECT k, concat_ws(' ', CASE WHEN g > 0 THEN 'g:' || g || '.0' END, CASE WHEN ml > 0 THEN 'ml:' || ml || '.0' END) AS quantity, counts FROM q""")
def quantity_forms(spark, sf_dir):
    """Sizes and counts in the forms that names have: multipacks, kilograms and litres, fractions, two families, packs."""
    k, n, m = F.col("p_partkey"), F.col("p_size").cast("string"), (F.col("p_partkey") % 40 + 1).cast("string")
    forms = [
        F.concat(n, F.lit("x"), m, F.lit("g")), F.concat(m, F.lit(" kg")), F.concat(n, F.lit("ml with "), m, F.lit("g")), F.concat(m, F.lit(" x 0.25kg and "), n, F.lit(" x 330 ml")),
        F.concat(n, F.lit(" x 500g plus "), m, F.lit("g 4 pack")), F.concat(n, F.lit(" x "), m, F.lit("l twice, not 1.5 of 1.5l")), F.concat(n, F.lit("pk of size 7")),
    ]
    made = table(spark, sf_dir, "part").select(k.alias("k"), F.concat(F.lit("item "), F.element_at(F.array(*forms), (k % 7 + 1).cast("int"))).alias("norm"))
    return made.select("k", scalars.quantity_signature("norm").alias("quantity"), scalars.pack_counts("norm").alias("counts"))
