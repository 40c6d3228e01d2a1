"""Queries over guards and invariants."""

from pyspark.sql import functions as F

from pricewave.functions import scalars
from pricewave.operators import digests, guards
from pricewave.plans.adapter import table
from pricewave.plans.book import query

_DAYS_SQL = """d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) AS f, CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS p, bool_or(o_custkey % 5 = 0) AS forced, min(o_custkey) % 4 AS k FROM orders GROUP BY 1)"""


def _days(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"), F.count_if(F.col("o_orderstatus") == "P").alias("p"), F.bool_or(F.col("o_custkey") % 5 == 0).alias("forced"), (F.min("o_custkey") % 4).alias("k")
    )


@query(f"""WITH {_DAYS_SQL} SELECT day, k % 2 = 0 AND f * 100 >= 400 AS keeps_live, CASE WHEN f - 1 = 0 THEN 1 ELSE 0 END AS exit_code, k > 0
  AND (forced OR k = 1) AS digest, 10 * n > 0 AND (10 * f >= 0.9 * 10 * n OR 10 * f >= 10 * n - 40) AS complete,
(10 * f >= 0.9 * 10 * n OR 10 * f >= 10 * n - 40) OR (forced AND 10 * f >= 0.5 * 10 * n) AS writes, CASE WHEN n * 5 < 20 THEN 'none'
  WHEN f >= 2 THEN 'draft' WHEN p >= 2 THEN 'seed' ELSE 'none' END AS source,
CASE WHEN k <> 1 THEN 'skip' WHEN f > 0 AND p = 0 THEN 'keep' ELSE 'make' END AS daily FROM d""")
def guard_days(spark, sf_dir):
    """Each day's counts through the guards of live rows, exits, digests, slow collections and bundles."""
    d = _days(spark, sf_dir).withColumns({"dump": F.col("k") % 2 == 0, "live": F.col("f") * 100, "written": F.col("f") - 1, "got": F.col("f") * 10, "total": F.col("n") * 10, "offers": F.col("n") * 5, "db_max": F.when(F.col("k") > 0, F.date_sub("day", F.when(F.col("k") == 1, 0).otherwise(7)))})
    return d.select(
        "day", guards.keeps_live("dump", "live").alias("keeps_live"), guards.exit_code("written").alias("exit_code"), guards.digest_proceeds("db_max", "day", "forced").alias("digest"), guards.trickle_complete("got", "total").alias("complete"),
        guards.trickle_writes("got", "total", "forced").alias("writes"), guards.bundle_source("offers", "f", "p").alias("source"), guards.revalidate("day", "db_max", "f", "p").alias("daily"),
    )


@query("SELECT o_orderkey FROM orders WHERE (SELECT count(*) FROM orders) >= 1000")
def dump_floor(spark, sf_dir):
    """A dump that holds enough items is read on; a smaller one would fail."""
    return guards.enough_items(table(spark, sf_dir, "orders").select("o_orderkey"), 1000)


@query("SELECT arg_max(o_totalprice, o_orderdate) AS recall_pct FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS r FROM orders WHERE o_orderstatus = 'F') WHERE r = 1)")
def latest_recall(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    first = o.groupBy("o_orderstatus", "o_orderdate").agg(F.min_by("o_totalprice", "o_orderkey").alias("recall_pct"))
    return digests.latest_recall(first.select(F.col("o_orderstatus").alias("retailer"), "recall_pct", F.col("o_orderdate").alias("measured_at")), "F")


NOW = "2001-06-30 18:00:00"
_FLOORS = {"half": 20, "catalogue": (100, 100_000), "predictions": 10, "links": 1_000, "recall": 70, "uncategorised": 25}
_TABLES_SQL = f"""WITH sp AS (SELECT l_partkey AS product_id, CASE WHEN l_partkey % 2 = 0 THEN 'coles'
  ELSE 'woolworths' END AS retailer, CAST(d - CAST((isodow(d) - 3 + 7) % 7 AS INT) AS DATE) AS week_start, bool_or(l_discount >= 0.08) AS is_half_price,
  max(l_tax) > 0.07 AS dear FROM (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem) WHERE d <= DATE '2001-06-30' GROUP BY ALL),
pr AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'coles' ELSE 'woolworths' END AS retailer, CASE
  WHEN p_partkey % 97 = 0 THEN 'stockup:' || p_name ELSE 'x:' || (p_partkey * CASE WHEN p_partkey % 5 = 0 THEN 100000 ELSE 1 END) END AS sku, CASE
  WHEN p_size % 4 = 0 THEN 'Uncategorised' ELSE p_type END AS category FROM part),
ru AS (SELECT CASE o_orderpriority WHEN '5-LOW' THEN 'live' WHEN '1-URGENT' THEN 'dump' ELSE 'post' END AS source, CASE o_orderstatus
  WHEN 'F' THEN 'success' WHEN 'P' THEN 'partial' ELSE 'failed' END AS status, o_orderdate AS run_at
  FROM orders WHERE o_orderdate <= TIMESTAMP '2001-06-30'),
nw AS (SELECT max(week_start) AS week FROM sp), hf AS (SELECT CAST(count(*) FILTER (is_half_price
  AND retailer = 'coles') AS DOUBLE) AS a, CAST(count(*) FILTER (is_half_price
  AND retailer = 'woolworths') AS DOUBLE) AS b, CAST(count(*) FILTER (dear) AS DOUBLE) AS inv FROM sp WHERE week_start = (SELECT week FROM nw)),
re AS (SELECT o_custkey AS k, CAST(d - CAST((isodow(d) - 3 + 7) % 7 AS INT) AS DATE) AS week_start, d AS generated_at, o_orderkey
  FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) WHERE d <= DATE '2001-06-30'),
he AS (SELECT week_start, l_partkey AS product_id FROM re JOIN lineitem ON l_orderkey = o_orderkey WHERE week_start = (SELECT week FROM nw))"""
_AGE = "epoch(TIMESTAMP '2001-06-30 18:00:00' - {}) / 86400e0"


@query(_TABLES_SQL + f""", v AS (SELECT 'a_current_half' AS name, a AS value, a >= 20 AS passed, '>= 20' AS expect FROM hf
  UNION ALL SELECT 'b_current_half', b, b >= 20, '>= 20' FROM hf
UNION ALL SELECT 'half_ratio', r, r >= 0.4, '>= 0.4' FROM (SELECT CASE WHEN a = 0 THEN 1 ELSE round_even(100e0 * b / a, 0) / 100 END AS r FROM hf)
UNION ALL SELECT 'week_is_current', w, w = 0, '= 0' FROM (SELECT week - DATE '2001-06-27' AS w FROM nw)
  UNION ALL SELECT 'no_inverted_prices', inv, inv = 0, '= 0' FROM hf
UNION ALL SELECT 'no_synthetic_products', n, n = 0, '= 0' FROM (SELECT count(*) AS n FROM pr WHERE sku LIKE 'stockup:%')
  UNION ALL SELECT 'no_marketplace_products', n, n = 0, '= 0' FROM (SELECT count(*) AS n
  FROM pr WHERE retailer = 'woolworths' AND length(split_part(sku, ':', 2)) >= 8)
UNION ALL SELECT 'a_catalogue_floor', n, n >= 100, '>= 100' FROM (SELECT count(*) AS n FROM pr WHERE retailer = 'coles')
  UNION ALL SELECT 'b_catalogue_floor', n, n >= 100000, '>= 100000' FROM (SELECT count(*) AS n FROM pr WHERE retailer = 'woolworths')
UNION ALL SELECT 'uncategorised_share', s, s <= 25, '<= 25'
  FROM (SELECT round_even(100e0 * count(*) FILTER (category = 'Uncategorised') / count(*), 0) AS s FROM pr)
UNION ALL SELECT 'a_scraped_recently', n, n >= 1, '>= 1' FROM (SELECT count(*) AS n
  FROM ru WHERE status <> 'failed' AND source = 'dump' AND run_at > TIMESTAMP '{NOW}' - INTERVAL 26 HOUR)
UNION ALL SELECT 'b_scraped_recently', n, n >= 1, '>= 1' FROM (SELECT count(*) AS n
  FROM ru WHERE status <> 'failed' AND source IN ('live', 'dump') AND run_at > TIMESTAMP '{NOW}' - INTERVAL 26 HOUR)
UNION ALL SELECT 'predictions_fresh', a, a <= 9, '<= 9' FROM (SELECT {_AGE.format('max(run_at)')} AS a FROM ru WHERE status = 'success')
  UNION ALL SELECT 'predictions_floor', n, n >= 10, '>= 10' FROM (SELECT count(*) AS n FROM ru WHERE status = 'success')
UNION ALL SELECT 'accuracy_fresh', a, a <= 9, '<= 9' FROM (SELECT {_AGE.format('max(run_at)')} AS a FROM ru WHERE run_at < TIMESTAMP '2001-06-10')
UNION ALL SELECT 'counterpart_links_floor', n, n >= 1000, '>= 1000' FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey % 3 > 0)
UNION ALL SELECT 'recall_floor', r, r >= 70, '>= 70' FROM (SELECT arg_max(n % 100, day) AS r FROM (SELECT run_at AS day, count(*) AS n FROM ru GROUP BY 1))
UNION ALL SELECT 'audit_fresh', a, a <= 9, '<= 9' FROM (SELECT {_AGE.format('max(run_at)')} AS a FROM ru)
UNION ALL SELECT 'bundles_fresh_when_live', n, n >= 2, '>= 2'
  FROM (SELECT CASE WHEN count(*) FILTER (generated_at > TIMESTAMP '{NOW}' - INTERVAL 8 DAY) = 0 THEN 99
  ELSE count(*) FILTER (week_start = (SELECT week FROM nw)) END AS n FROM re)
UNION ALL SELECT 'heroes_half_price', n, n = 0, '= 0' FROM (SELECT count(*) AS n FROM he WHERE NOT EXISTS (SELECT 1
  FROM sp WHERE sp.week_start = he.week_start AND sp.product_id = he.product_id AND is_half_price)))
SELECT name, CAST(value AS DOUBLE) AS value, passed, expect FROM v""")
def invariants(spark, sf_dir):
    """All twenty over tables made of the driver's rows, on which most values are not what they should be."""
    li, o, p = (table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    day = F.to_date("l_shipdate")
    sold = li.where(day <= F.lit("2001-06-30").cast("date")).groupBy(F.col("l_partkey").alias("product_id"), F.when(F.col("l_partkey") % 2 == 0, "coles").otherwise("woolworths").alias("retailer"), scalars.week_start(day).alias("week_start"))
    specials = sold.agg(F.bool_or(F.col("l_discount") >= 0.08).alias("is_half_price"), F.when(F.max("l_tax") > 0.07, 2).otherwise(1).alias("sale_cents"), F.lit(1).alias("regular_cents"))
    k = F.col("p_partkey")
    products = p.select(F.when(k % 3 == 0, "coles").otherwise("woolworths").alias("retailer"), F.when(k % 97 == 0, F.concat(F.lit("stockup:"), "p_name")).otherwise(F.concat(F.lit("x:"), (k * F.when(k % 5 == 0, 100000).otherwise(1)).cast("string"))).alias("sku"), F.when(F.col("p_size") % 4 == 0, "Uncategorised").otherwise(F.col("p_type")).alias("category"))
    past = o.where("o_orderdate <= timestamp '2001-06-30'")
    runs = past.select(F.when(F.col("o_orderpriority") == "5-LOW", "live").when(F.col("o_orderpriority") == "1-URGENT", "dump").otherwise("post").alias("source"), F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "partial").otherwise("failed").alias("status"), F.col("o_orderdate").alias("run_at"))
    made = past.select("o_orderkey", scalars.week_start(F.to_date("o_orderdate")).alias("week_start"), F.col("o_orderdate").alias("generated_at"))
    lists = made.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey", "week_start", "generated_at").agg(F.collect_list(F.struct(F.col("l_partkey").alias("product_id"))).alias("ingredients"))
    lists = lists.withColumn("ingredients", F.filter("ingredients", lambda i: i["product_id"].isNotNull()))
    tables = {
        "specials": specials, "products": products, "runs": runs, "predictions": runs.where("status = 'success'").select(F.col("run_at").alias("computed_at")), "accuracy": runs.where("run_at < timestamp '2001-06-10'").select(F.col("run_at").alias("computed_at")),
        "links": o.select(F.when(F.col("o_orderkey") % 3 > 0, "counterpart").otherwise("alias").alias("kind")), "bundles": lists,
        "audits": runs.groupBy(F.col("run_at").alias("measured_at")).agg((F.count("*") % 100).cast("double").alias("recall_pct")).withColumns({"retailer": F.lit("coles"), "source": F.lit("catalogue")}),
    }
    return guards.standard_checks(tables, NOW, floors=_FLOORS)
