"""Queries over the writes: stored tables and what a run brings, made from the driver's rows."""

from pyspark.sql import functions as F

from pricewave.operators import bundles, cycles, digests, merge, pricing, writes
from pricewave.plans.adapter import table
from pricewave.plans.book import query

WEEK, NOW = "1998-07-01", "1998-07-02 12:00:00"
_RETAILER, _SKU = "CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'B' END", "'k' || (p_partkey // 2)"
_PRODUCTS_SQL = f"pr AS (SELECT p_partkey AS product_id, {_RETAILER} AS retailer, {_SKU} AS sku, p_name AS name FROM part WHERE p_partkey % 7 <> 0)"
_PULLED_SQL = """pu AS (SELECT CASE WHEN l_partkey % 2 = 0 THEN 'A'
  ELSE 'B' END AS retailer, 'k' || (l_partkey // 2) AS sku, CAST(l_shipdate AS DATE) AS week_start, max(CAST(round_even(l_extendedprice * 100,
  0) AS BIGINT)) AS sale_cents, 'dump' AS source
FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL)"""
_OBSERVED_SQL = """ob AS (SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS observed_at, CASE WHEN l_partkey % 3 = 0 THEN 'live' ELSE 'dump' END AS source, CAST(count(*) AS BIGINT) AS price_cents FROM lineitem WHERE l_linenumber >= 2 GROUP BY ALL)"""


def _products(spark, sf_dir):
    p = table(spark, sf_dir, "part").where("p_partkey % 7 <> 0")
    return p.select(F.col("p_partkey").alias("product_id"), F.when(F.col("p_partkey") % 2 == 0, "A").otherwise("B").alias("retailer"), F.concat(F.lit("k"), F.floor(F.col("p_partkey") / 2).cast("string")).alias("sku"), F.col("p_name").alias("name"))


def _pulled(spark, sf_dir):
    """Specials of a pull, by retailer and stock key; every seventh product is unknown."""
    li = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2")
    by = [F.when(F.col("l_partkey") % 2 == 0, "A").otherwise("B").alias("retailer"), F.concat(F.lit("k"), F.floor(F.col("l_partkey") / 2).cast("string")).alias("sku"), F.to_date("l_shipdate").alias("week_start")]
    found = li.groupBy(*by).agg(F.max(F.rint(F.col("l_extendedprice") * 100).cast("bigint")).alias("sale_cents"))
    return found.select("*", F.lit(50).cast("bigint").alias("discount_pct"), F.lit("dump").alias("source"), F.lit(0).alias("pos"))


@query(f"WITH {_PRODUCTS_SQL}, {_PULLED_SQL} SELECT product_id, week_start, sale_cents FROM pu JOIN pr USING (retailer, sku)")
def product_ids(spark, sf_dir):
    return writes.with_product_ids(_pulled(spark, sf_dir), _products(spark, sf_dir)).select("product_id", "week_start", "sale_cents")


@query(f"""WITH {_PRODUCTS_SQL}, {_PULLED_SQL}, {_OBSERVED_SQL}, n AS (SELECT product_id, week_start AS observed_at, source,
  sale_cents AS price_cents FROM pu JOIN pr USING (retailer, sku))
SELECT product_id, observed_at, source, coalesce(n.price_cents, ob.price_cents) AS price_cents, n.price_cents IS NOT NULL AS is_special, CASE
  WHEN n.price_cents IS NOT NULL THEN 50 END AS discount_pct FROM ob FULL JOIN n USING (product_id, observed_at, source)""")
def upsert_observations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").where("l_linenumber >= 2")
    old = li.groupBy(F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("observed_at"), F.when(F.col("l_partkey") % 3 == 0, "live").otherwise("dump").alias("source")).agg(F.count("*").alias("price_cents"))
    old = old.select("product_id", "price_cents", F.lit(False).alias("is_special"), F.lit(None).cast("bigint").alias("discount_pct"), "observed_at", "source")
    return writes.upsert_observations(old, _pulled(spark, sf_dir), _products(spark, sf_dir))


_PREDICTED_SQL = f"""{_PRODUCTS_SQL}, q AS (SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS retailer, CASE
  WHEN o_orderkey % 10 = 3 THEN 'nothing' ELSE c END AS name, CAST(o_orderdate AS DATE) AS computed_at, count(*) AS cycle_count
  FROM orders JOIN (SELECT p_partkey AS pk, p_name AS c FROM part WHERE p_partkey < 500) ON pk = o_orderkey % 500 GROUP BY ALL),
l AS (SELECT retailer, name, max(product_id) AS product_id FROM pr GROUP BY ALL), f AS (SELECT q.*, product_id FROM q LEFT JOIN l USING (retailer, name))"""


def _predicted(spark, sf_dir):
    """Predictions by retailer and name, with names that no product has, and spaces around others."""
    names = table(spark, sf_dir, "part").where("p_partkey < 500").select(F.col("p_partkey").alias("pk"), F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("c"))
    o = table(spark, sf_dir, "orders").join(names, F.col("pk") == F.col("o_orderkey") % 500)
    by = [F.when(F.col("o_orderkey") % 2 == 0, "A").otherwise("B").alias("retailer"), F.when(F.col("o_orderkey") % 10 == 3, "nothing").otherwise(F.col("c")).alias("name"), F.to_date("o_orderdate").alias("computed_at")]
    return o.groupBy(*by).agg(F.count("*").alias("cycle_count"))


@query(f"WITH {_PREDICTED_SQL} SELECT retailer, name, computed_at, cycle_count, product_id FROM f")
def predicted_products(spark, sf_dir):
    return writes.predicted_products(_predicted(spark, sf_dir), _products(spark, sf_dir)).withColumn("name", F.trim("name"))


@query(f"""WITH {_PREDICTED_SQL}, o AS (SELECT product_id, computed_at, 0 AS cycle_count FROM f WHERE product_id % 3 = 0)
SELECT * FROM o UNION ALL SELECT product_id, computed_at, cycle_count FROM f WHERE product_id IS NOT NULL AND product_id % 3 <> 0""")
def insert_predictions(spark, sf_dir):
    """Predictions of a third of the products are stored already and stay."""
    p, products = _predicted(spark, sf_dir), _products(spark, sf_dir)
    old = writes.predicted_products(p, products).where("product_id % 3 = 0").select("product_id", "computed_at", F.lit(0).cast("bigint").alias("cycle_count"))
    return writes.insert_predictions(old, p, products)


@query(f"""WITH {_PRODUCTS_SQL}, s AS (SELECT l_orderkey, l_linenumber, l_partkey AS product_id, CAST(l_shipdate AS DATE) AS week_start,
  CASE l_linenumber % 3 WHEN 0 THEN 'post' WHEN 1 THEN 'sheet' ELSE 'dump' END AS source FROM lineitem)
SELECT s.* FROM s LEFT JOIN pr USING (product_id) WHERE NOT (coalesce(retailer, '') = 'A' AND week_start = DATE '{WEEK}' AND source IN ('post', 'sheet'))""")
def drop_leftovers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    s = li.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("week_start"), F.element_at(F.array(*map(F.lit, ("post", "sheet", "dump"))), (F.col("l_linenumber") % 3 + 1).cast("int")).alias("source"))
    return writes.drop_leftovers(s, _products(spark, sf_dir), WEEK, "A", ["post", "sheet"])


@query("""WITH o AS (SELECT o_custkey AS a, o_orderkey AS b, o_totalprice / 200000e0 AS s, o_orderkey % 5 AS r FROM orders),
n AS (SELECT a, b, round_even(least(s, 1e0) * 100, 0) / 100 AS confidence FROM o WHERE r > 1)
SELECT a AS canonical, b AS variant, 'counterpart' AS kind, confidence, CASE WHEN b % 5 = 2 THEN 'hand' ELSE 'auto' END AS created_by FROM n
  UNION ALL SELECT a, b, 'alias', 0.5e0, 'hand' FROM o WHERE r = 1""")
def replace_links(spark, sf_dir):
    """Old counterparts go, aliases stay, and an alias that is matched becomes a counterpart."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b"), (F.col("o_totalprice") / 200000.0).alias("score"), (F.col("o_orderkey") % 5).alias("r"))
    old = o.where("r <= 2").select(F.col("a").alias("canonical"), F.col("b").alias("variant"), F.when(F.col("r") == 0, "counterpart").otherwise("alias").alias("kind"), F.lit(0.5).alias("confidence"), F.lit("hand").alias("created_by"))
    return writes.replace_links(old, o.where("r > 1"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey + 1000000, 'P', 1e0 FROM orders WHERE o_orderkey % 10 = 0")
def replace_scope(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = o.where("o_orderkey % 10 = 0").select((F.col("o_orderkey") + 1000000).alias("o_orderkey"), F.lit("P").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"))
    return merge.replace_scope(o, new, F.col("o_orderstatus") == "P")


_HALF_SQL = f"""sp AS (SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS week_start, CAST(count(*) * 500 AS BIGINT) AS regular_cents,
  CAST(count(*) * 300 AS BIGINT) AS sale_cents,
  l_partkey % 2 = 1 AS flagged FROM lineitem GROUP BY ALL),
t AS (SELECT p_partkey AS id, p_partkey % 3 = 0 AS is_half,
  CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_size * 20 AS BIGINT) END AS was_cents, CAST(p_size * 10 AS BIGINT) AS sale_cents FROM part),
n AS (SELECT id AS product_id, DATE '{WEEK}' AS week_start, coalesce(was_cents, 2 * sale_cents) AS was, sale_cents AS sale FROM t
      WHERE is_half AND sale_cents > 0 AND id NOT IN (SELECT product_id FROM sp WHERE flagged AND week_start = DATE '{WEEK}'))"""


@query(f"""WITH {_HALF_SQL}
SELECT product_id, week_start, CASE WHEN sp.sale_cents IS NOT NULL THEN week_start + 6 ELSE week_start END AS week_end,
       CASE WHEN n.was IS NULL THEN regular_cents
  WHEN sp.sale_cents IS NULL THEN n.was ELSE greatest(regular_cents, n.was) END AS regular_cents, coalesce(n.sale, sp.sale_cents) AS sale_cents,
       CASE WHEN n.was IS NULL THEN 40 ELSE CAST(round_even(100e0 * (n.was - n.sale) / n.was, 0) AS BIGINT) END AS discount_pct, n.was IS NOT NULL
  OR flagged AS is_half_price,
       CASE WHEN n.was IS NULL THEN 'dump' ELSE 'catalogue' END AS source FROM sp FULL JOIN n USING (product_id, week_start)""")
def audit_corrections(spark, sf_dir):
    """Half prices of a catalogue put into one week: of products without a row there, with a row that is no half price, and, to no effect, with one that is."""
    by = [F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("week_start")]
    s = table(spark, sf_dir, "lineitem").groupBy(*by).agg(F.count("*").alias("n"))
    s = s.select(
        "product_id", "week_start", F.date_add("week_start", 6).alias("week_end"), (500 * F.col("n")).alias("regular_cents"), (300 * F.col("n")).alias("sale_cents"),
        F.lit(40).cast("bigint").alias("discount_pct"), (F.col("product_id") % 2 == 1).alias("is_half_price"), F.lit("dump").alias("source"),
    )
    k = F.col("p_partkey")
    truth = table(spark, sf_dir, "part").select(
        k.alias("id"), (k % 3 == 0).alias("is_half"), (10 * F.col("p_size")).cast("bigint").alias("sale_cents"), F.when(k % 6 != 0, (20 * F.col("p_size")).cast("bigint")).alias("was_cents")
    )
    return digests.corrections(s, truth, WEEK)


@query("SELECT c_custkey FROM customer JOIN (SELECT o_custkey, max(o_orderdate) AS synced FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey WHERE synced >= TIMESTAMP '2001-08-01 12:00:00' - INTERVAL 60 DAY UNION ALL SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def synced_watchlists(spark, sf_dir):
    """Watchlists synced in the last sixty days, and those that never say when."""
    last = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last_synced_at"))
    lists = table(spark, sf_dir, "customer").select("c_custkey").join(last, "c_custkey", "left")
    return merge.drop_orphans(lists.withColumn("last_synced_at", F.coalesce("last_synced_at", F.lit("2001-08-01").cast("timestamp"))), "2001-08-01 12:00:00").select("c_custkey")


_LOG_SQL = f"""m AS (SELECT o_custkey % 300 AS batch, o_orderkey // 7 AS pos, o_custkey AS device_id, 1 + o_orderkey % 3 AS n
  FROM orders WHERE o_orderkey % 7 = 0),
t AS (SELECT o_custkey % 300 AS batch, o_orderkey // 7 AS pos, 't' || o_orderkey AS ticket_id, CASE WHEN o_orderkey % 5 = 0 THEN 'error'
  ELSE 'ok' END AS status, CASE WHEN o_orderkey % 10 = 0 THEN 'DeviceNotRegistered' END AS error
  FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 11 <> 0)"""


def _sent(spark, sf_dir):
    """Messages in batches, and the tickets that answer most of them."""
    o = table(spark, sf_dir, "orders").where("o_orderkey % 7 = 0").select((F.col("o_custkey") % 300).alias("batch"), F.floor(F.col("o_orderkey") / 7).alias("pos"), F.col("o_custkey").alias("device_id"), F.col("o_orderkey").alias("k"))
    items = F.expr("transform(sequence(1L, 1 + k % 3), x -> x)")
    messages = o.select("batch", "pos", "device_id", items.alias("product_ids"), F.transform(items, lambda x: x.cast("string")).alias("names"))
    tickets = o.where("k % 11 <> 0").select("batch", "pos", F.concat(F.lit("t"), F.col("k").cast("string")).alias("ticket_id"), F.when(F.col("k") % 5 == 0, "error").otherwise("ok").alias("status"), F.when(F.col("k") % 10 == 0, writes.GONE_DEVICE).alias("error"), F.when(F.col("k") % 5 == 0, F.repeat(F.lit("long "), 200)).alias("message"))
    return messages, tickets


@query(f"WITH {_LOG_SQL} SELECT device_id, ticket_id, n AS item_count, CASE WHEN status = 'ok' THEN 'sent' ELSE 'errored' END AS status, CASE WHEN status <> 'ok' THEN left(coalesce(error, repeat('long ', 200)), 500) END AS error_detail FROM m JOIN t USING (batch, pos)")
def sent_digests(spark, sf_dir):
    return writes.sent_rows(*_sent(spark, sf_dir), WEEK).select("device_id", "ticket_id", "item_count", "status", "error_detail")


@query(f"WITH {_LOG_SQL} SELECT device_id, count(*) AS rows, bool_or(old) AS old FROM (SELECT DISTINCT device_id, device_id % 4 = 0 AS old FROM m JOIN t USING (batch, pos) UNION SELECT c_custkey, true FROM customer WHERE c_custkey % 4 = 0) GROUP BY device_id")
def logged_digests(spark, sf_dir):
    """One row per device, week and kind, rows logged before staying."""
    sent = writes.sent_rows(*_sent(spark, sf_dir), WEEK)
    old = table(spark, sf_dir, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("device_id"), F.lit("weekly_digest").alias("alert_type"), F.lit(WEEK).cast("date").alias("week_start"), F.lit("old").alias("ticket_id"))
    return writes.log_digests(old, sent).groupBy("device_id").agg(F.count("*").alias("rows"), F.bool_or(F.col("ticket_id") == "old").alias("old"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{NOW}' - INTERVAL 30 MINUTE
  AND o_orderkey % 3 <> 0 THEN CASE WHEN o_orderkey % 3 = 1 THEN 'receipt_ok' ELSE 'receipt_error' END WHEN o_orderstatus = 'F' THEN 'sent'
  ELSE 'errored' END AS status,
CASE WHEN o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{NOW}' - INTERVAL 30 MINUTE AND o_orderkey % 3 = 2 THEN 'Too big' END AS error_detail FROM orders""")
def applied_receipts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    ticket = F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))
    log = o.select("o_orderkey", ticket.alias("ticket_id"), F.when(F.col("o_orderstatus") == "F", "sent").otherwise("errored").alias("status"), F.col("o_orderdate").alias("sent_at"), F.lit(None).cast("string").alias("error_detail"))
    receipts = o.where("o_orderkey % 3 <> 0").select(ticket.alias("ticket_id"), F.when(F.col("o_orderkey") % 3 == 1, "ok").otherwise("error").alias("outcome"), F.lit(None).cast("string").alias("error"), F.lit("Too big").alias("message"))
    return writes.apply_receipts(log, receipts, NOW).select("o_orderkey", "status", "error_detail")


@query("SELECT c_custkey AS device_id, CASE WHEN c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 10 = 0) THEN 'tok' || c_custkey END AS push_token FROM customer")
def live_tokens(spark, sf_dir):
    failures = table(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select(F.col("o_custkey").alias("device_id"), F.when(F.col("o_orderkey") % 10 == 0, writes.GONE_DEVICE).otherwise("Busy").alias("error"))
    lists = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("device_id"), F.concat(F.lit("tok"), F.col("c_custkey").cast("string")).alias("push_token"))
    return writes.drop_tokens(lists, failures)


@query("SELECT c_custkey AS id, n AS items_found, CASE WHEN n IS NULL THEN 'running' WHEN n > 12 THEN 'success' ELSE 'partial' END AS status FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey")
def finished_runs(spark, sf_dir):
    runs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit(None).cast("bigint").alias("items_found"), F.lit("running").alias("status"))
    done = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("items_written")).withColumn("status", F.when(F.col("items_written") > 12, "success").otherwise("partial"))
    return writes.finish_runs(runs, done)


@query(f"""SELECT p_partkey AS product_id, CASE WHEN p_partkey % 5 = 0 AND p_partkey % 2 = 0 THEN 'new' || p_partkey WHEN p_partkey % 3 = 0 THEN 'old' END AS image_url, CASE WHEN p_partkey % 5 = 0 THEN TIMESTAMP '{NOW}' END AS image_fetched_at FROM part""")
def written_images(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.when(F.col("p_partkey") % 3 == 0, "old").alias("image_url"), F.lit(None).cast("timestamp").alias("image_fetched_at"))
    tried = p.where("product_id % 5 = 0").select("product_id", F.when(F.col("product_id") % 2 == 0, F.concat(F.lit("new"), F.col("product_id").cast("string"))).alias("image_url"))
    return writes.write_images(p, tried, NOW)


@query("SELECT p_partkey AS product_id FROM part WHERE p_partkey % 4 = 1 ORDER BY CASE WHEN p_partkey % 3 > 0 THEN p_size END DESC NULLS LAST, p_partkey LIMIT 200")
def image_queue(spark, sf_dir):
    """The next two hundred lookups, as the feature has it."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(k.alias("product_id"), F.when(k % 2 == 0, "x").alias("image_url"), F.when(k % 4 == 3, F.lit(NOW).cast("timestamp")).alias("image_fetched_at"), F.when(k % 3 > 0, F.col("p_size")).alias("last_seen"))
    return writes.image_work(p, 200).select("product_id")


@query("""WITH r AS (SELECT p_brand AS method, p_size % 3 = 0 AS hit
  FROM part) SELECT method, count(*) AS considered, CAST(count(*) FILTER (hit) AS BIGINT) AS hits, count(*) FILTER (hit) / count(*) AS hit_rate
  FROM r GROUP BY method
UNION ALL SELECT 'all', count(*), CAST(count(*) FILTER (hit) AS BIGINT), count(*) FILTER (hit) / count(*) FROM r""")
def lookup_counts(spark, sf_dir):
    return writes.lookup_counts(table(spark, sf_dir, "part").select(F.col("p_brand").alias("method"), F.when(F.col("p_size") % 3 == 0, "u").alias("image_url")))


@query("""WITH c AS (SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS sku, CAST(round_even(p_retailprice * 100, 0) AS BIGINT) AS cents, p_type,
  p_name FROM part)
SELECT sku, p_name AS name, CASE WHEN k % 3 <> 0 AND k % 9 <> 1 THEN p_type WHEN k % 2 = 0 THEN 'New' END AS category, CASE
  WHEN k % 3 <> 0 THEN greatest(cents, CASE WHEN k % 2 = 0 THEN cents + CASE WHEN k % 4 = 0 THEN 9 ELSE -9 END END) ELSE cents + CASE
  WHEN k % 4 = 0 THEN 9 ELSE -9 END END AS regular_price_cents,
       CASE WHEN k % 3 <> 0 AND k % 5 = 0 THEN 'old' || k WHEN k % 2 = 0 AND k % 7 <> 0 THEN 'new' || k END AS image_url
  FROM c WHERE k % 3 <> 0 OR k % 2 = 0""")
def upsert_product_rows(spark, sf_dir):
    """The row-wise rule, under which a category that is there stays."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").withColumn("cents", F.rint(F.col("p_retailprice") * 100).cast("bigint"))
    key = k.cast("string")
    old = p.where(k % 3 != 0).select(
        key.alias("sku"), F.col("p_name").alias("name"), F.when(k % 9 != 1, F.col("p_type")).alias("category"), F.col("cents").alias("regular_price_cents"),
        F.when(k % 5 == 0, F.concat(F.lit("old"), key)).alias("image_url"),
    )
    new = p.where(k % 2 == 0).select(
        key.alias("sku"), F.col("p_name").alias("name"), F.lit("New").alias("category"), (F.col("cents") + F.when(k % 4 == 0, 9).otherwise(-9)).alias("regular_price_cents"),
        F.when(k % 7 != 0, F.concat(F.lit("new"), key)).alias("image_url"),
    )
    return merge.upsert(old, new, ["sku"], merge.product_rules("old"))


@query("SELECT p_type AS label FROM (SELECT DISTINCT p_type FROM part) WHERE p_type NOT IN (SELECT upper(c_mktsegment) FROM customer) AND p_type <> 'PROMO'")
def changed_labels(spark, sf_dir):
    allowed = table(spark, sf_dir, "customer").select(F.upper("c_mktsegment").alias("label")).distinct().union(spark.range(1).select(F.lit("PROMO").alias("label")))
    return writes.changed_labels(table(spark, sf_dir, "part").select(F.col("p_type").alias("label")), allowed)


@query("""WITH w AS (SELECT o_custkey AS item, CAST(o_orderdate AS DATE) AS d,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 9 AS INT) END AS h FROM orders),
e AS (SELECT item, d FROM w UNION ALL SELECT item, d - 7 * h FROM w WHERE h > 0)
SELECT item, count(*) AS n, min(d) AS first, max(d) AS last, CAST(sum(d - DATE '1990-01-01') AS BIGINT) AS days FROM e GROUP BY item""")
def hinted_dates(spark, sf_dir):
    """Sale dates with those that hints name."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("item"), F.to_date("o_orderdate").alias("week_start"), F.when(F.col("o_orderkey") % 4 == 0, (F.col("o_orderkey") % 9).cast("int")).alias("hint_weeks"))
    s = o.groupBy("item").agg(F.collect_list(F.struct("week_start", "hint_weeks")).alias("entries")).withColumn("dates", cycles.sale_dates())
    days = F.aggregate("dates", F.lit(0).cast("bigint"), lambda a, d: a + F.datediff(d, F.lit("1990-01-01").cast("date")))
    return s.select("item", F.size("dates").cast("bigint").alias("n"), F.get("dates", F.lit(0)).alias("first"), F.element_at("dates", -1).alias("last"), days.alias("days"))


@query("""WITH h AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS d, max(CAST(round_even(o_totalprice * 100, 0) AS BIGINT)) AS c
  FROM orders GROUP BY ALL),
n AS (SELECT k, coalesce(max(c) FILTER (d >= DATE '2001-06-30' - 300), max(c)) AS regular
  FROM h WHERE k % 3 <> 0 GROUP BY k), o AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0)
SELECT CAST(coalesce(o.k, n.k) AS VARCHAR) AS sku, CASE WHEN o.k IS NULL THEN 'new ' || n.k ELSE 'old ' || o.k END AS name, CASE
  WHEN o.k IS NULL THEN CASE WHEN n.k % 5 = 0 THEN 'Uncategorised' ELSE 'Tea' END WHEN n.k IS NOT NULL AND n.k % 5 <> 0 THEN 'Tea'
  ELSE 'Old' END AS category,
CASE WHEN o.k IS NULL THEN n.regular ELSE 1 END AS regular_price_cents, CASE WHEN n.k IS NOT NULL THEN 'img' END AS image_url
  FROM o FULL JOIN n ON o.k = n.k""")
def ingest_retailer(spark, sf_dir):
    """A parsed catalogue put into stored products, names and prices of known ones staying."""
    o = table(spark, sf_dir, "orders").where("o_custkey % 3 <> 0")
    day = o.groupBy(F.col("o_custkey").alias("item"), F.to_date("o_orderdate").alias("on_date")).agg(F.max(F.rint(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    items = pricing.history(day, "item").withColumn("retailer", F.lit("A"))
    k = F.col("item").cast("string")
    parsed = pricing.products(items, "2001-06-30").withColumns({"name": F.concat(F.lit("new "), k), "category": F.when(F.col("item") % 5 == 0, "Uncategorised").otherwise("Tea"), "image_url": F.lit("img")})
    # Every item comes twice; the last one counts.
    first = parsed.withColumns({"pos": F.lit(1), "name": F.lit("first"), "category": F.lit("First"), "regular": F.lit(5).cast("bigint"), "image_url": F.lit("zzz")})
    parsed = first.unionByName(parsed.withColumn("pos", F.lit(2)))
    stored = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("sku"), F.concat(F.lit("old "), F.col("c_custkey").cast("string")).alias("name"), F.lit("Old").alias("category"), F.lit(1).cast("bigint").alias("regular_price_cents"), F.lit(None).cast("string").alias("image_url"))
    return merge.ingest_retailer(stored, parsed)


_DRAFTS_SQL = """d AS (SELECT o_custkey AS reply, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos
  FROM orders WHERE o_custkey % 10 <> 0),
g AS (SELECT reply, CAST(pos AS INT) AS pos, k,
  CASE WHEN k % 6 = 0 THEN '' ELSE left('Dinner of a long name ' || k || repeat(' and more', 12), 80) END AS title, 
      CASE k % 5 WHEN 0 THEN 4 WHEN 1 THEN 0 WHEN 2 THEN 40 ELSE CAST(k % 12 AS INT) END AS serves
  FROM d WHERE k % 7 <> 0 AND k % 11 <> 0 AND (k % 13 <> 0 OR k % 5 = 0))"""


def _drafts(spark, sf_dir):
    """Replies of a model: every tenth is no JSON, and some entries are no drafts."""
    k = F.col("o_orderkey")
    item = lambda n: F.struct(F.concat(F.lit("p"), ((k + n) % 50).cast("string")).alias("product_id"), F.concat(F.lit(" "), F.repeat(F.lit("label "), 10)).alias("label"))
    title = F.when(k % 6 == 0, "  ").otherwise(F.concat(F.lit(" Dinner of a long name "), k.cast("string"), F.repeat(F.lit(" and more"), 12)))
    serves = F.element_at(F.array(F.lit(None).cast("string"), F.lit("0"), F.lit("40"), (k % 12).cast("string"), (k % 12).cast("string")), (k % 5 + 1).cast("int"))
    listed = lambda n, text: F.array_repeat(F.lit(text), n)
    draft = F.to_json(F.struct(title.alias("title"), F.when(k % 11 == 0, "some").otherwise(serves).alias("serves"), F.when(k % 3 != 0, F.array(item(0), item(1), item(1), item(60))).alias("ingredients"), listed(9, " pepper and " + "salt " * 20).alias("pantry"), F.lit(" cook ").alias("instructions"), listed(7, "quick " * 9).alias("tags")))
    # Servings as texts, as fractions and, where no draft is to come of it, as texts of fractions.
    draft = F.when(k % 13 == 0, F.regexp_replace(draft, r'"serves":"(\d+)"', r'"serves":"$1.5"')).when(k % 2 == 0, F.regexp_replace(draft, r'"serves":"(\d+)"', r'"serves":$1.5')).otherwise(draft)
    body = F.concat(F.lit('{"recipes": ['), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", F.when(k % 7 == 0, '"words"').otherwise(draft).alias("d")))), lambda x: x["d"]), ","), F.lit("]}"))
    replies = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("reply")).agg(body.alias("b"))
    return bundles.drafted(replies.select("reply", F.when(F.col("reply") % 10 == 0, "no json").otherwise(F.col("b")).alias("body")))


@query(f"WITH {_DRAFTS_SQL} SELECT reply, pos, title, serves, CASE WHEN k % 3 <> 0 THEN 4 ELSE 0 END AS ingredients, 6 AS pantry, 40 AS longest, 5 AS tags FROM g")
def drafted_bundles(spark, sf_dir):
    d = _drafts(spark, sf_dir)
    return d.select("reply", "pos", "title", "serves", F.size("ingredients").alias("ingredients"), F.size("pantry").alias("pantry"), F.array_max(F.transform("pantry", F.length)).alias("longest"), F.size("tags").alias("tags"))


@query(f"""WITH {_DRAFTS_SQL}, i AS (SELECT DISTINCT reply, pos, title, serves, (k + n) % 50 AS p
  FROM g, (VALUES (0), (1), (60)) t(n) WHERE k % 3 <> 0 AND title <> '')
SELECT reply, pos, title,
  CASE WHEN serves BETWEEN 1 AND 12 THEN serves
  ELSE 4 END AS serves, count(*) AS items, CAST(sum(p * 10 + 5) AS BIGINT) AS cost_cents, CAST(sum(p * 20 + 10) AS BIGINT) AS regular_cents, 40 AS longest
FROM i WHERE p < 45 GROUP BY ALL HAVING count(*) >= 2""")
def validated_bundles(spark, sf_dir):
    """Drafts whose products are on offer, costed."""
    p = spark.range(45).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("product_id"), (10 * F.col("id") + 5).alias("sale_cents"), (20 * F.col("id") + 10).alias("regular_cents"))
    v = bundles.validated(_drafts(spark, sf_dir), p, ("reply", "pos"))
    return v.select("reply", "pos", "title", "serves", "items", "cost_cents", "regular_cents", F.array_max(F.transform("labels", lambda x: F.length(x))).alias("longest"))


@query("""WITH o AS (SELECT p_partkey AS product_id, CASE WHEN p_partkey % 3 = 0 THEN 'Tomato '
  ELSE '' END || p_name AS name, CAST(round_even(p_retailprice * 100, 0) AS BIGINT) AS sale_cents FROM part)
SELECT product_id FROM o WHERE product_id % 3 = 0 ORDER BY sale_cents, product_id LIMIT 45""")
def meal_menu(spark, sf_dir):
    """The menu's forty-five, as the feature has it."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.concat(F.when(F.col("p_partkey") % 3 == 0, "Tomato ").otherwise(""), "p_name").alias("name"), F.rint(F.col("p_retailprice") * 100).cast("bigint").alias("sale_cents"))
    return bundles.menu(p).select("product_id")
