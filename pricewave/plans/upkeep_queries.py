"""Queries over what keeps the stored tables in order: pulls put into a table on disk, repeated rows, purges, backfill and the audit's entry."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pricewave.operators import backfill, digests, merge, pricing, purges, writes
from pricewave.plans.adapter import table
from pricewave.plans.book import query
from pricewave.session import work_folder
from pricewave.sinks.weekly import WeeklyTable, put_pull

WEEK = "1998-07-01"

# Fixed values of the fixtures: products with made-up, long and plain stock numbers under labels of which some are denied.
_PRODUCTS_SQL = """pr AS (SELECT p_partkey AS product_id, CASE WHEN p_partkey % 2 = 0 THEN 'woolworths' ELSE 'coles' END AS retailer,
       CASE WHEN p_partkey % 10 = 3 THEN 'stockup:' || p_name ELSE CASE WHEN p_partkey % 2 = 0 THEN 'woolworths:' ELSE 'coles:' END || CASE
  WHEN p_partkey % 5 = 0 THEN '1234' ELSE '' END || (p_partkey + 1000) END AS sku,
       'Group ' || p_size % 45 AS category FROM part),
li AS (SELECT l_partkey AS product_id, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN 'stockup_post' WHEN 1 THEN 'stockup_sheet'
  ELSE 'dump' END AS source FROM lineitem)"""
_TABLES_SQL = f"""WITH {_PRODUCTS_SQL}, sp AS (SELECT product_id, source FROM li WHERE l_linenumber <= 3), ob AS (SELECT product_id, source
  FROM li WHERE l_linenumber > 3),
pd AS (SELECT p_partkey AS product_id FROM part WHERE p_partkey % 3 = 0), al AS (SELECT p_partkey AS canonical, p_partkey + 1 AS variant
  FROM part WHERE p_partkey % 4 = 1), """


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    retailer = F.when(k % 2 == 0, "woolworths").otherwise("coles")
    plain = F.concat(retailer, F.lit(":"), F.when(k % 5 == 0, "1234").otherwise(""), (k + 1000).cast("string"))
    sku = F.when(k % 10 == 3, F.concat(F.lit("stockup:"), "p_name")).otherwise(plain)
    products = p.select(k.alias("product_id"), retailer.alias("retailer"), sku.alias("sku"), F.concat(F.lit("Group "), (F.col("p_size") % 45).cast("string")).alias("category"))
    source = F.element_at(F.array(*map(F.lit, ("stockup_post", "stockup_sheet", "dump"))), F.col("l_linenumber") % 3 + 1)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("product_id"), "l_linenumber", source.alias("source"))
    return {
        "products": products, "specials": li.where("l_linenumber <= 3").drop("l_linenumber"), "observations": li.where("l_linenumber > 3").drop("l_linenumber"),
        "predictions": p.where("p_partkey % 3 = 0").select(k.alias("product_id")), "aliases": p.where("p_partkey % 4 = 1").select(k.alias("canonical"), (k + 1).alias("variant")),
    }


def _counted(found: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("name"), "rows") for name, df in found.items()])


_CASCADED = """SELECT 'products' AS name, count(*) AS rows FROM gone UNION ALL SELECT 'specials', count(*) FROM sp JOIN gone USING (product_id)
UNION ALL SELECT 'observations', count(*) FROM ob JOIN gone USING (product_id) UNION ALL SELECT 'predictions', count(*) FROM pd JOIN gone USING (product_id)
UNION ALL SELECT 'aliases', count(*) FROM al WHERE canonical IN (SELECT product_id FROM gone) OR variant IN (SELECT product_id FROM gone)"""


@query(_TABLES_SQL + "gone AS (SELECT product_id FROM pr WHERE sku LIKE 'stockup:%') " + _CASCADED)
def purge_synthetic(spark, sf_dir):
    """What a purge of made-up stock numbers would take, in each table."""
    t = _tables(spark, sf_dir)
    return _counted(purges.cascade(t, "products", purges.synthetic(t["products"])))


_MARKET = """labels AS (SELECT DISTINCT p_size AS code, 'Group ' || p_size % 45 AS label FROM part), denied AS (SELECT label
  FROM labels WHERE code < 10 EXCEPT SELECT label FROM labels WHERE code >= 10),
gone AS (SELECT product_id FROM pr WHERE (retailer = 'woolworths' AND length(split_part(sku, ':', 2)) >= 8) OR category IN (SELECT label FROM denied)) """


@query(_TABLES_SQL + _MARKET + _CASCADED)
def purge_marketplace(spark, sf_dir):
    """What a purge of marketplace products would take: long stock numbers of one retailer, and labels that only denied codes have."""
    t = _tables(spark, sf_dir)
    codes = table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("code"), F.concat(F.lit("Group "), (F.col("p_size") % 45).cast("string")).alias("label")).distinct()
    gone = purges.marketplace(t["products"], codes, denied=[str(k) for k in range(10)])
    return _counted(purges.cascade(t, "products", gone))


@query(_TABLES_SQL + _MARKET + """SELECT 'products' AS name, CAST(sum(product_id) AS BIGINT) AS total
  FROM pr WHERE product_id NOT IN (SELECT product_id FROM gone)
UNION ALL SELECT 'specials', CAST(sum(product_id) AS BIGINT) FROM sp WHERE product_id NOT IN (SELECT product_id FROM gone)
UNION ALL SELECT 'aliases', CAST(sum(canonical * 3 + variant) AS BIGINT) FROM al WHERE canonical NOT IN (SELECT product_id
  FROM gone) AND variant NOT IN (SELECT product_id FROM gone)""")
def purged_marketplace(spark, sf_dir):
    """What stays once that purge is confirmed."""
    t = _tables(spark, sf_dir)
    codes = table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("code"), F.concat(F.lit("Group "), (F.col("p_size") % 45).cast("string")).alias("label")).distinct()
    left = purges.cascade(t, "products", purges.marketplace(t["products"], codes, denied=[str(k) for k in range(10)]), confirm=True)
    sums = {"products": F.sum("product_id"), "specials": F.sum("product_id"), "aliases": F.sum(F.col("canonical") * 3 + F.col("variant"))}
    return reduce(DataFrame.union, [left[n].agg(F.lit(n).alias("name"), s.alias("total")) for n, s in sums.items()])


@query(_TABLES_SQL + """m AS (SELECT product_id
  FROM pr WHERE retailer = 'coles') SELECT 'specials' AS name, count(*) FILTER (source <> 'dump') AS rows FROM sp JOIN m USING (product_id)
UNION ALL SELECT 'observations', count(*) FILTER (source <> 'dump') FROM ob JOIN m USING (product_id)""")
def purge_stockup(spark, sf_dir):
    """What a purge of the posted lists' rows of one retailer would take."""
    t = _tables(spark, sf_dir)
    return _counted(purges.drop_sources({n: t[n] for n in ("specials", "observations")}, t["products"], "coles"))


_HISTORY_SQL = """WITH h AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, max(CAST(round_even(o_totalprice * 100, 0) AS BIGINT)) AS c
  FROM orders GROUP BY ALL),
e AS (SELECT k, d, c AS sale, was, row_number() OVER (PARTITION BY k ORDER BY d DESC) AS pos
  FROM (SELECT *, lead(c) OVER (PARTITION BY k ORDER BY d DESC) AS was FROM h) WHERE was > 0 AND c > 0 AND 1e0 - c / was >= 0.48e0),
st AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0),
id AS (SELECT DISTINCT k, CASE WHEN k % 3 = 0 THEN 'p' || k ELSE 'A:' || k END AS product_id FROM e),
past AS (SELECT product_id, d, sale, was, CAST(round_even(100e0 * (1e0 - sale / was), 0) AS BIGINT) AS pct
  FROM e JOIN id USING (k) WHERE d < DATE '1998-07-01'),
old AS (SELECT product_id, d FROM past WHERE sale % 2 = 0) """


def _backfilled(spark, sf_dir) -> dict[str, DataFrame]:
    """Histories of all customers' orders; every third product is stored, and so are the specials and observations of even prices, as their own."""
    o = table(spark, sf_dir, "orders")
    day = o.groupBy(F.col("o_custkey").cast("string").alias("item"), F.to_date("o_orderdate").alias("on_date")).agg(F.max(F.rint(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    parsed = pricing.products(pricing.history(day, "item"), "2001-06-30").withColumns(
        {"retailer": F.lit("A"), "name": F.concat(F.lit("new "), "item"), "category": F.lit("Tea"), "image_url": F.lit("img")}
    )
    key = F.col("c_custkey").cast("string")
    products = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(
        F.concat(F.lit("p"), key).alias("product_id"), F.lit("A").alias("retailer"), key.alias("sku"), F.concat(F.lit("old "), key).alias("name"), F.lit("Old").alias("category"),
        F.lit(1).cast("bigint").alias("regular_price_cents"), F.lit(None).cast("string").alias("image_url"),
    )
    each = parsed.join(products.select(F.col("sku").alias("item"), "product_id"), "item", "left").select(
        F.coalesce("product_id", F.concat(F.lit("A:"), "item")).alias("product_id"), F.explode("events").alias("e")
    )
    known = each.select("product_id", "e.*").where("on_date < DATE '1998-07-01' AND sale_cents % 2 = 0")
    specials = known.select(
        "product_id", F.col("on_date").alias("week_start"), F.date_add("on_date", 6).alias("week_end"), F.lit(7).cast("bigint").alias("regular_cents"),
        F.lit(3).cast("bigint").alias("sale_cents"), F.lit(57).cast("bigint").alias("discount_pct"), F.lit(True).alias("is_half_price"), F.lit("live").alias("source"),
    )
    observations = known.select(
        "product_id", F.lit(3).cast("bigint").alias("price_cents"), F.lit(True).alias("is_special"), F.lit(57).cast("bigint").alias("discount_pct"), F.col("on_date").alias("observed_at"), F.lit("live").alias("source")
    )
    return backfill.backfill(parsed, products, specials, observations, WEEK)


@query(_HISTORY_SQL + """SELECT product_id, d AS week_start, d + 6 AS week_end, CASE WHEN sale % 2 = 0 THEN 7 ELSE was END AS regular_cents, CASE
  WHEN sale % 2 = 0 THEN 3 ELSE sale END AS sale_cents,
       CASE WHEN sale % 2 = 0 THEN 57 ELSE pct END AS discount_pct, true AS is_half_price, CASE WHEN sale % 2 = 0 THEN 'live'
  ELSE 'dump' END AS source FROM past""")
def backfilled_specials(spark, sf_dir):
    """Past events as specials from their own day; stored ones stay."""
    return _backfilled(spark, sf_dir)["specials"]


@query(_HISTORY_SQL + """SELECT product_id, d AS observed_at, sale AS price_cents, pct AS discount_pct, 'dump' AS source FROM past UNION ALL SELECT product_id, d, 3, 57, 'live' FROM old""")
def backfilled_observations(spark, sf_dir):
    """Past events as observations; those of another source stay beside them."""
    return _backfilled(spark, sf_dir)["observations"].drop("is_special")


@query(_HISTORY_SQL + """SELECT 'ever_half' AS name, count(*) AS n FROM id UNION ALL SELECT 'event_rows', count(*) FROM past
UNION ALL SELECT 'specials_inserted', count(*) FROM past WHERE sale % 2 = 1 UNION ALL SELECT 'observations_inserted', count(*) FROM past""")
def backfill_counts(spark, sf_dir):
    return _backfilled(spark, sf_dir)["counts"]


_PULL_SQL = """WITH li AS (SELECT l_partkey AS product_id, CASE WHEN l_partkey % 2 = 0 THEN 'A'
  ELSE 'B' END AS retailer, date_trunc('month', l_shipdate)::DATE AS week_start,
  l_orderkey * 8 + l_linenumber AS pos, CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS sale_cents FROM lineitem),
s AS (SELECT product_id, retailer, week_start, arg_max(sale_cents, pos) AS sale_cents, CASE WHEN product_id % 3 = 0 THEN 'live'
  ELSE 'dump' END AS source FROM li WHERE product_id % 5 <> 0 GROUP BY ALL),
one AS (SELECT product_id, retailer, week_start, arg_max(sale_cents + 1, pos) AS sale_cents, 'dump' AS source
  FROM li WHERE product_id % 4 = 0 AND week_start = DATE '1998-03-01' GROUP BY ALL),
two AS (SELECT product_id, retailer, week_start, arg_max(sale_cents + 2, pos) AS sale_cents, 'live' AS source
  FROM li WHERE product_id % 7 = 0 AND week_start = DATE '1998-04-01' GROUP BY ALL) """


def _pulls(spark, sf_dir):
    li, k = table(spark, sf_dir, "lineitem"), F.col("l_partkey")
    return li.select(
        k.alias("product_id"), F.when(k % 2 == 0, "A").otherwise("B").alias("retailer"), F.trunc("l_shipdate", "month").alias("week_start"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("sale_cents"),
    )


@query(_PULL_SQL + """SELECT * FROM s WHERE week_start NOT IN (DATE '1998-03-01', DATE '1998-04-01') UNION ALL SELECT * FROM one
  UNION ALL SELECT * FROM s WHERE week_start = DATE '1998-03-01' AND retailer <> 'A'
UNION ALL SELECT * FROM two UNION ALL SELECT * FROM s WHERE week_start = DATE '1998-04-01' AND NOT EXISTS (SELECT 1
  FROM two WHERE two.product_id = s.product_id)""")
def stored_pulls(spark, sf_dir):
    """A table on disk, a whole pull and a partial one put into two of its weeks, the first once more under its own id, and the table read again."""
    rows = _pulls(spark, sf_dir)
    source = F.when(F.col("product_id") % 3 == 0, "live").otherwise("dump")
    stored = merge.last_wins(rows.where("product_id % 5 <> 0"), ["product_id", "retailer", "week_start"], "pos").drop("pos").withColumn("source", source)
    t = WeeklyTable(spark, work_folder(spark, "specials"), "product_id long, retailer string, sale_cents long, source string, week_start date")
    t.apply_rows("base", stored, lambda old, new: old.unionByName(new))
    one = rows.where("product_id % 4 = 0 AND week_start = DATE '1998-03-01'").withColumns({"sale_cents": F.col("sale_cents") + 1, "source": F.lit("dump")})
    two = rows.where("product_id % 7 = 0 AND week_start = DATE '1998-04-01'").withColumns({"sale_cents": F.col("sale_cents") + 2, "source": F.lit("live")})
    put_pull(t, "one", one, "1998-03-01", "dump", ["A"])
    put_pull(t, "two", two, "1998-04-01", "live", ["A", "B"], partial=True)
    put_pull(t, "one", one.withColumn("sale_cents", F.lit(0).cast("bigint")), "1998-03-01", "dump", ["A"])
    return t.read()


_REPEATS_SQL = _PULL_SQL + """, pr AS (SELECT p_partkey AS product_id FROM part WHERE p_partkey % 6 <> 0) """


def _repeated(spark, sf_dir):
    rows = _pulls(spark, sf_dir).where("week_start >= DATE '1998-01-01'").withColumns({"source": F.lit("dump"), "discount_pct": F.lit(50).cast("bigint")})
    old = rows.where("product_id % 3 = 0").groupBy("product_id", "week_start").agg(F.lit(1).cast("bigint").alias("sale_cents")).withColumns({"source": F.lit("row"), "discount_pct": F.lit(10).cast("bigint")})
    return old, rows


_LAST = """, r AS (SELECT product_id, week_start, arg_max(sale_cents, pos) AS last, arg_min(sale_cents, pos) AS first FROM li WHERE week_start >= DATE '1998-01-01' GROUP BY ALL) """


@query(_PULL_SQL + _LAST + "SELECT product_id, week_start, last AS sale_cents, CASE WHEN product_id % 3 = 0 THEN 'row' ELSE 'dump' END AS source, 50 AS discount_pct FROM r")
def upsert_special_rows(spark, sf_dir):
    """Of rows that repeat a key the last one goes in; a row that was there keeps its source."""
    old, rows = _repeated(spark, sf_dir)
    return merge.upsert_specials(old, rows.drop("retailer"), keep_source=True)


@query(_PULL_SQL + _LAST + """SELECT product_id, week_start, CASE WHEN product_id % 3 = 0 THEN 1 ELSE first END AS sale_cents, CASE
  WHEN product_id % 3 = 0 THEN 'row' ELSE 'dump' END AS source,
       CASE WHEN product_id % 3 = 0 THEN 10 ELSE 50 END AS discount_pct FROM r""")
def inserted_first_rows(spark, sf_dir):
    """Of rows that repeat a key that is not there the first one goes in."""
    old, rows = _repeated(spark, sf_dir)
    return merge.insert_absent(old, rows.drop("retailer"), ["product_id", "week_start"], "pos")


@query(_REPEATS_SQL + _LAST + "SELECT product_id, week_start AS observed_at, last AS price_cents FROM r JOIN pr USING (product_id)")
def last_observations(spark, sf_dir):
    """Of a pull's rows of one product and day the last one is the observation."""
    _, rows = _repeated(spark, sf_dir)
    products = table(spark, sf_dir, "part").where("p_partkey % 6 <> 0").select(
        F.when(F.col("p_partkey") % 2 == 0, "A").otherwise("B").alias("retailer"), F.col("p_partkey").cast("string").alias("sku"), F.col("p_partkey").alias("product_id")
    )
    pull = rows.select("retailer", F.col("product_id").cast("string").alias("sku"), "sale_cents", "discount_pct", "week_start", "source", "pos")
    old = spark.createDataFrame([], "product_id long, price_cents long, is_special boolean, discount_pct long, observed_at date, source string")
    return writes.upsert_observations(old, pull, products).select("product_id", "observed_at", "price_cents")


@query("""WITH p AS (SELECT p_partkey, p_partkey % 3 = 0 AS t, p_partkey % 5 <> 0 AS have, p_partkey % 4 = 0 AS mine, p_size * 10 AS cents, CASE
  WHEN p_partkey % 8 = 0 THEN p_size * 10 ELSE 1 END AS ours FROM part),
c AS (SELECT count(*) FILTER (t) AS a, count(*) FILTER (t AND have) AS m, count(*) FILTER (t AND have AND mine) AS f, count(*) FILTER (t AND have
  AND NOT mine) AS x, count(*) FILTER (t AND NOT have) AS n,
  count(*) FILTER (NOT t AND have) AS h, count(*) FILTER (NOT t AND have AND mine) AS w, count(*) FILTER (t AND have AND mine AND ours = cents) AS e FROM p)
SELECT 'coles' AS retailer, DATE '1998-07-01' AS week_start, a AS ground_truth_half, m AS matched, f AS we_flag_half, round_even(1000e0 * f / m,
  0) / 10 AS recall_pct, round_even(1000e0 * (h - w) / h, 0) / 10 AS precision_pct,
  round_even(1000e0 * e / f, 0) / 10 AS price_exact_pct, 'missed=' || x || ' not_stocked=' || n || ' false_pos=' || w || ' sales=7,9' AS sample_note FROM c""")
def audit_entry(spark, sf_dir):
    """The row that an audit adds to its table."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    truth = p.select(k.alias("id"), (k % 3 == 0).alias("is_half"), (10 * F.col("p_size")).cast("bigint").alias("sale_cents"))
    ours = p.where("p_partkey % 5 <> 0").select(k.alias("id"), (k % 4 == 0).alias("is_half"), F.when(k % 8 == 0, 10 * F.col("p_size")).otherwise(1).cast("bigint").alias("sale_cents"))
    return digests.audit_entry(digests.audit(truth, ours), "coles", WEEK, "catalogue", ["7", "9"], "1998-07-02 12:00:00").drop("measured_at", "source")
