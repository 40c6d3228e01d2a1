"""Readers of price dumps and catalogue pages, from files or text columns."""

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from pricewave.functions import scalars
from pricewave.operators import pricing
from pricewave.sources import variants
from pricewave.sources.tables import REPORT_HEADING

DUMP = StructType([
    StructField("id", StringType()), StructField("name", StringType()), StructField("category", StringType()),
    StructField("priceHistory", ArrayType(StructType([StructField("date", StringType()), StructField("price", StringType())]))),
])


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """A JSON dump (gzip by its file name); one file cannot be split, so its rows are dealt out after reading."""
    return spark.read.schema(DUMP).option("multiLine", True).json(path).repartition(spark.sparkContext.defaultParallelism)


def dump_items(bodies: DataFrame, body: str = "body") -> DataFrame:
    """The items of dumps that are held as text."""
    return bodies.select(F.explode(F.from_json(body, ArrayType(DUMP))).alias("i")).select("i.*")


def usable_items(items: DataFrame) -> DataFrame:
    """Items with an id, a name and at least one valid change point, names trimmed; adds hist, the change points in order."""
    found = items.where("id IS NOT NULL AND trim(coalesce(name, '')) <> ''").withColumns({"name": F.trim("name"), "hist": pricing.parse_history()})
    return found.where(F.size("hist") > 0)


def parse_counts(items: DataFrame, products: DataFrame) -> DataFrame:
    """One row for a run's log: products, half_now, half_ever, and how many items were skipped as marketplace ones."""
    skipped = items.agg(F.count_if("marketplace").alias("n")).select(F.lit("marketplace").alias("name"), "n")
    made = products.agg(F.count("*").alias("products"), F.count_if("is_half").alias("half_now"), F.count_if(F.size("events") > 0).alias("half_ever"))
    return made.select(F.expr("stack(3, 'products', products, 'half_now', half_now, 'half_ever', half_ever) AS (name, n)")).unionByName(skipped)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(code, label) of a JSON object of category codes."""
    return labels_of(spark.read.text(path, wholetext=True), "value")


def labels_of(bodies: DataFrame, body: str = "body") -> DataFrame:
    return bodies.select(F.explode(F.from_json(body, "map<string,string>")).alias("code", "label"))


def discounted(sale: Column, regular: Column) -> Column:
    return (regular > 0) & (sale > 0) & (sale < regular)


def browse_specials(pages: DataFrame, body: str = "body", retailer: str = "woolworths") -> DataFrame:
    """Rows of a browse API's Bundles[].Products[]: name, category, prices, discount, image, sku (with the retailer before the stock number).

    Prices are numbers or texts of numbers; a product without a name or both prices, or without a real discount, is left out.
    """
    m = lambda c: variants.member(F.col("p"), c)
    bundles = pages.select(F.explode(variants.elements(variants.member(variants.parsed(body), "Bundles"))).alias("b"))
    tile = bundles.select(F.explode(variants.elements(variants.member(F.col("b"), "Products"))).alias("p")).where(variants.is_object(F.col("p")))
    cents = lambda c: F.rint(variants.number(m(c)) * 100).try_cast("bigint")
    image = F.coalesce(*[F.nullif(variants.text(m(c)), F.lit("")) for c in ("LargeImageFile", "MediumImageFile", "SmallImageFile")])
    rows = tile.select(
        scalars.strip(variants.text(m("Name"))).alias("name"), F.nullif(scalars.strip(variants.text(m("Department"))), F.lit("")).alias("department"),
        cents("WasPrice").alias("regular"), cents("Price").alias("sale"), image.alias("image_url"), variants.text(m("Stockcode")).alias("code"),
    )
    pct = F.rint(100.0 * (F.col("regular") - F.col("sale")) / F.col("regular")).cast("int")
    return rows.where((F.col("name") != "") & discounted(F.col("sale"), F.col("regular"))).select(
        "name", F.coalesce("department", F.lit(scalars.UNCATEGORISED)).alias("category"), F.col("regular").alias("regular_cents"), F.col("sale").alias("sale_cents"),
        pct.alias("discount_pct"), (pct >= 50).alias("is_half_price"), "image_url", F.concat(F.lit(f"{retailer}:"), F.col("code")).alias("sku"),
    )


def collect_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of paged runs (run, page, names, total, failed) the products (run, page, pos, name) and the runs (run, items, status).

    A run reads its pages in order until one is empty or fails, or until it has
    as many distinct names, whatever the case, as its first page announces in
    total. Of equal names the first counts. A failed page that was reached makes
    the run partial, or failed if nothing was collected before it.
    """
    by_run = Window.partitionBy("run").orderBy("page")
    bad = F.col("failed") | (F.size("names") <= 0)
    seen = pages.withColumn("ended", F.max(bad.cast("int")).over(by_run.rowsBetween(Window.unboundedPreceding, Window.currentRow)) > 0).withColumn("announced", F.first("total").over(by_run))
    rows = seen.where(~F.col("ended")).select("run", "page", "announced", F.posexplode("names").alias("pos", "name"))
    firsts = rows.where("name IS NOT NULL").withColumn("r", F.row_number().over(Window.partitionBy("run", F.lower("name")).orderBy("page", "pos"))).where("r = 1").drop("r")
    # How many names a run has before each page.
    new = firsts.groupBy("run", "page").agg(F.count("*").alias("new"), F.first("announced").alias("announced"))
    had = new.withColumn("had", F.coalesce(F.sum("new").over(by_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    read = had.where(F.col("announced").isNull() | (F.col("had") < F.col("announced"))).select("run", "page", "new", "had", "announced")
    items = firsts.join(read.select("run", "page"), ["run", "page"]).select("run", "page", "pos", "name")
    sums = read.groupBy("run").agg(F.sum("new").alias("items"), F.max("announced").alias("announced"))
    ends = seen.groupBy("run").agg(F.min_by("failed", F.when(F.col("ended"), F.col("page"))).alias("failed"))
    short = F.col("announced").isNull() | (F.coalesce("items", F.lit(0)) < F.col("announced"))
    stopped = F.coalesce(F.col("failed"), F.lit(False)) & short
    status = F.when(stopped & F.col("items").isNotNull(), "partial").when(stopped, "failed").when(F.col("items").isNotNull(), "success").otherwise("no_data")
    runs = ends.join(sums, "run", "left").select("run", F.coalesce("items", F.lit(0)).alias("items"), status.alias("status"))
    return items, runs


def remaining_pages(planned: DataFrame, done: DataFrame) -> DataFrame:
    """What a resumed collection still has to read: planned (run, page) without done."""
    return planned.join(done.select("run", "page"), ["run", "page"], "left_anti")


# Titles of report posts.
REPORT_TITLES = (r"(?i)Catalogue\s+Half-Price\s+Report", r"(?i)1/?2\s*price.*\+\s*\d+\s+more")


def report_link(html: str, prefix: str = "", titles: tuple[str, ...] = REPORT_TITLES) -> Column:
    """The address of the first link to a /node/ page whose title matches; null without one. coalesce() a page and its fallback."""
    links = F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>'), F.lit(0))
    parts = F.transform(links, lambda a: F.struct(F.regexp_extract(a, r'(?i)href="([^"]*)"', 1).alias("href"), F.trim(F.regexp_replace(F.regexp_replace(a, r"(?s)<[^>]*>", " "), r"\s+", " ")).alias("title")))
    fits = lambda p: p["href"].contains("/node/") & p["title"].rlike("|".join(f"(?:{t})" for t in titles))
    href = F.get(F.filter(parts, fits), F.lit(0))["href"]
    return F.when(href.rlike("^https?://"), href).otherwise(F.concat(F.lit(prefix), href))


def report_week(html: str, today: Column) -> Column:
    """struct(week_start, week_end) from the date in the report's heading, else of the most recent Wednesday."""
    heads = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<h5[^>]*>.*?</h5>"), F.lit(0)), lambda h: h.contains(REPORT_HEADING) & h.rlike(r"\d{4}-\d{2}-\d{2}"))
    start = F.coalesce(F.regexp_extract(F.get(heads, F.lit(0)), r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date"), scalars.week_start(today))
    return F.struct(start.alias("week_start"), F.date_add(start, 6).alias("week_end"))


_SEARCH = "Products array<struct<Products: array<struct<Name: string, Stockcode: string, UrlFriendlyName: string, LargeImageFile: string, MediumImageFile: string, SmallImageFile: string>>>>"


def search_results(bodies: DataFrame, body: str = "body", site: str = "", keys: tuple[str, ...] = ("pid",)) -> DataFrame:
    """(keys, pos, name, image_url, product_url): the products of a search API's tiles in order; the address is empty without number and slug."""
    flat = F.flatten(F.transform(F.from_json(body, _SEARCH)["Products"], lambda t: F.coalesce(t["Products"], F.expr("CAST(array() AS ARRAY<STRUCT<Name: STRING, Stockcode: STRING, UrlFriendlyName: STRING, LargeImageFile: STRING, MediumImageFile: STRING, SmallImageFile: STRING>>)"))))
    p = bodies.select(*keys, F.posexplode(flat).alias("pos", "p")).where("p IS NOT NULL")
    full = lambda c: F.nullif(F.col(f"p.{c}"), F.lit(""))
    address = F.concat_ws("/", F.lit(site), full("Stockcode"), full("UrlFriendlyName"))
    return p.select(*keys, "pos", F.coalesce("p.Name", F.lit("")).alias("name"), F.coalesce(*[full(c) for c in ("LargeImageFile", "MediumImageFile", "SmallImageFile")]).alias("image_url"), F.when(full("Stockcode").isNotNull() & full("UrlFriendlyName").isNotNull(), address).otherwise("").alias("product_url"))


def embedded_json(html: str, script_id: str = "__NEXT_DATA__", path: str = "$.props.pageProps.searchResults") -> Column:
    """The JSON at path in a page's script element; null without one."""
    body = F.regexp_extract(html, rf'(?s)<script[^>]*id="{script_id}"[^>]*>(.*?)</script>', 1)
    return F.get_json_object(F.nullif(body, F.lit("")), path)


def listing_specials(pages: DataFrame, results: str = "results", cdn: str = "") -> DataFrame:
    """Rows of a listing's results array: products only, brand put first unless the name starts with it.

    Prices are numbers or texts of numbers. savePercent counts where it is a
    whole number; a text, a fraction or none at all leaves the discount to be computed.
    """
    p = pages.select(F.explode(variants.elements(variants.parsed(results))).alias("p"))
    m = lambda *path: functools.reduce(variants.member, path, F.col("p"))
    cents = lambda v: F.rint(variants.number(v) * 100).try_cast("bigint")
    named = lambda c: scalars.strip(F.coalesce(variants.text(m(c)), F.lit("")))
    uri = variants.text(variants.member(F.get(variants.elements(m("imageUris")), F.lit(0)), "uri"))
    saved = m("pricing", "savePercent")
    rows = p.where(variants.text(m("_type")) == "PRODUCT").select(
        variants.text(m("id")).alias("id"), named("name").alias("bare"), named("brand").alias("brand"), cents(m("pricing", "now")).alias("sale"), cents(m("pricing", "was")).alias("regular"),
        F.when(variants.is_whole(saved), variants.text(saved).cast("int")).alias("saved"), F.nullif(uri, F.lit("")).alias("uri"),
    )
    full = F.when((F.col("brand") != "") & ~F.startswith(F.lower("bare"), F.lower("brand")), F.concat_ws(" ", "brand", "bare")).otherwise(F.col("bare"))
    pct = F.coalesce("saved", F.rint(100.0 * (F.col("regular") - F.col("sale")) / F.col("regular")).cast("int"))
    image = F.concat(F.lit(cdn), F.coalesce("uri", F.concat(F.lit("/"), scalars.image_path("id"))))
    return rows.where((F.col("bare") != "") & F.col("id").isNotNull() & discounted(F.col("sale"), F.col("regular"))).select(
        full.alias("name"), F.col("regular").alias("regular_cents"), F.col("sale").alias("sale_cents"), pct.alias("discount_pct"), (pct >= 50).alias("is_half_price"),
        image.alias("image_url"), F.col("id").alias("sku"),
    )


def jsonp(text: str) -> Column:
    """The JSON inside a callback's parentheses; a text without them is the JSON itself."""
    inner = F.regexp_extract(text, r"(?s)\((.*)\)\s*;?\s*$", 1)
    return F.when(F.col(text).rlike(r"(?s)\((.*)\)\s*;?\s*$"), inner).otherwise(F.col(text))


# How a catalogue says half price and names the price before.
HALF_PRICE = r"(?i)1/2\s*price|half\s*price"
WAS_PRICE = r"(?i)was\s*\$?\s*([0-9]+(?:\.[0-9]+)?)"


def _wrapped(bodies: DataFrame, body: str, keys: tuple[str, ...]) -> DataFrame:
    """(keys, i, x): the items of callbacks in order, each in or out of a wrapping object, as VARIANTs."""
    listed = variants.elements(variants.member(variants.parsed(jsonp(body)), "items"))
    return bodies.select(*keys, F.posexplode(listed).alias("i", "w")).select(*keys, "i", variants.unwrapped(F.col("w")).alias("x"))


def sale_rows(bodies: DataFrame, body: str = "body") -> DataFrame:
    """(id, start, end) of the catalogues that callbacks list; those without all three are left out."""
    x = F.col("x")
    named = {n: variants.text(variants.member(x, c)) for n, c in (("id", "saleId"), ("start", "startDate"), ("end", "endDate"))}
    return _wrapped(bodies, body, ()).select(*[c.alias(n) for n, c in named.items()]).where("id <> '' AND start <> '' AND end <> ''")


def catalogue_items(bodies: DataFrame, body: str = "body", position: str = "pos") -> DataFrame:
    """One row per id of the catalogues in callbacks: half-price readings first, then order.

    Ids are the digits of the stock number; items without one or without a name
    are left out. Character references are written out. The sale price is
    priceSale or, where that is missing, empty or 0, priceReg of the first price;
    the price before stands in its description.
    """
    x = F.col("x")
    price = F.get(variants.elements(variants.member(x, "prices")), F.lit(0))
    plain = lambda c: F.coalesce(variants.text(variants.member(x, c)), F.lit(""))
    sale = F.when(variants.filled(variants.member(price, "priceSale")), variants.member(price, "priceSale")).otherwise(variants.member(price, "priceReg"))
    was = F.regexp_extract(F.coalesce(variants.text(variants.member(price, "priceOptionDesc")), F.lit("")), WAS_PRICE, 1)
    rows = _wrapped(bodies.withColumn("p", F.col(position)), body, ("p",)).select(
        "p", "i", F.regexp_replace(plain("SKU"), "[^0-9]", "").alias("id"), scalars.strip(plain("itemName")).alias("raw"), plain("description").alias("says"),
        variants.number(sale).alias("sale"), was.alias("was"),
    )
    rows = rows.withColumns({"name": scalars.unescape("raw"), "text": scalars.strip(scalars.unescape("says"))}).where("id <> '' AND name <> ''")
    rows = rows.withColumn("is_half", F.col("text").rlike(HALF_PRICE))
    best = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("is_half"), "p", "i"))
    return rows.withColumn("_best", best).where("_best = 1").select(
        "id", "name", "is_half", scalars.cents("sale").alias("sale_cents"), scalars.cents("was").alias("was_cents"), F.substring("text", 1, 40).alias("discount_desc")
    )


def running_sales(sales: DataFrame, today: str) -> DataFrame:
    """Catalogues (id, start, end as text) that run today; malformed dates leave a row out."""
    day = F.lit(today).cast("date")
    return sales.where((F.try_to_date("start") <= day) & (day <= F.try_to_date("end")))


# Product addresses of the two shops' sitemaps, with the groups of id and slug.
SITEMAP_PATTERNS = {"coles": (r"/product/([a-z0-9-]+?)-(\d+)/?$", 2, 1), "woolworths": (r"/shop/productdetails/(\d+)/([a-z0-9-]+)/?$", 1, 2)}


def _locations(docs, xml):
    return docs.select(F.explode(F.regexp_extract_all(xml, F.lit(r"<loc>(.*?)</loc>"), F.lit(1))).alias("loc"))


def child_sitemaps(docs: DataFrame, xml: str = "xml", word: str = "product") -> DataFrame:
    """(loc) of an index's sitemaps whose address holds the word."""
    return _locations(docs, xml).where(F.lower("loc").contains(word))


def sitemap_links(docs: DataFrame, retailer: str, xml: str = "xml") -> DataFrame:
    """(id, slug) of the product addresses in sitemaps."""
    pattern, of_id, of_slug = SITEMAP_PATTERNS[retailer]
    loc = _locations(docs, xml).where(F.col("loc").rlike(pattern))
    return loc.select(F.regexp_extract("loc", pattern, of_id).alias("id"), F.regexp_extract("loc", pattern, of_slug).alias("slug")).distinct()


def newest_specials(spark: SparkSession, glob: str, schema: StructType | None = None) -> DataFrame:
    """specials[] of the newest file by name."""
    runs = spark.read.option("multiLine", True).json(glob) if schema is None else spark.read.schema(schema).option("multiLine", True).json(glob)
    return newest_run(runs.withColumn("_file", F.col("_metadata.file_path")), "_file")


def newest_run(runs: DataFrame, file: str = "file") -> DataFrame:
    newest = runs.agg(F.max(file).alias("_newest"))
    return runs.join(F.broadcast(newest), F.col(file) == F.col("_newest")).select(F.explode("specials").alias("s")).select("s.*")  # one row is broadcast


def write_run(specials: DataFrame, folder: str, stamp: str) -> str:
    """One run's specials as JSON lines under a name that sorts by time; newest_specials reads them by the last such name."""
    path = f"{folder}/specials_{stamp}"
    specials.write.mode("overwrite").json(path)
    return path
