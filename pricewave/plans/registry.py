"""Named queries over the reference operators, with their DuckDB twins."""

from pyspark.sql import functions as F

from pricewave.functions import scalars
from pricewave.operators import bundles, cycle_state, cycles, digests, guards, matching, merge, pricing
from pricewave.operators.cycle_state import CycleTable
from pricewave.plans.adapter import AS_OF, WEEK, catalogue, price_points, table, watched
from pricewave.plans.book import ORACLES, QUERIES, query  # noqa: F401
from pricewave.session import stored, work_folder

FLAGSHIP = "predictions"


# Common table expressions of the DuckDB side.
_POINTS = """pp AS (SELECT retailer, item, on_date, cents FROM (
  SELECT {retailer} AS retailer, l_partkey AS item, CAST(l_shipdate AS DATE) AS on_date,
         CAST(round_even(l_extendedprice / l_quantity * 100, 0) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY {retailer}, l_partkey, CAST(l_shipdate AS DATE)
  ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) AS rn
  FROM lineitem{when}) WHERE rn = 1)"""
_SIDE, _UNTIL = "(CASE l_linestatus WHEN 'F' THEN 'A' ELSE 'B' END)", " WHERE CAST(l_shipdate AS DATE) <= DATE '2001-06-30'"
_SPLIT, _SPLIT_ALL = _POINTS.format(retailer=_SIDE, when=_UNTIL), _POINTS.format(retailer=_SIDE, when="")
_POOLED, _POOLED_ALL = _POINTS.format(retailer="'X'", when=_UNTIL), _POINTS.format(retailer="'X'", when="")
_EVENTS = """ev AS (SELECT retailer, item, on_date, cents AS sale_cents, was AS regular_cents,
  CAST(round_even(100e0 * (1e0 - cents / was), 0) AS BIGINT) AS discount_pct
  FROM (SELECT *, lead(cents) OVER (PARTITION BY retailer, item ORDER BY on_date DESC) AS was FROM pp)
  WHERE was > 0 AND cents > 0 AND (1e0 - cents / was) >= 0.48e0)"""
_PRODUCTS = """pr AS (SELECT *, (coalesce(last_event = changed, false) OR (regular > 0 AND 1e0 - current / regular >= 0.48e0))
  AND DATE '2001-06-30' - changed <= 14 AS is_half,
    CASE WHEN 1e0 - current / regular >= 0.30e0 THEN CAST(round_even(100e0 * (1e0 - current / regular), 0) AS BIGINT) END AS pct
  FROM (SELECT retailer, item, coalesce(max(cents) FILTER (on_date >= DATE '2001-06-30' - 300), max(cents)) AS regular, arg_max(cents,
  on_date) AS current, max(on_date) AS changed
        FROM pp GROUP BY ALL) LEFT JOIN (SELECT retailer, item, max(on_date) AS last_event, count(*) AS n_events
  FROM ev GROUP BY ALL) USING (retailer, item))"""
_SPECIALS = """sp AS (SELECT retailer, item, regular AS regular_cents, current AS sale_cents, pct AS discount_pct, is_half AND pct >= 48 AS is_half_price,
  DATE '2001-06-27' AS week_start, DATE '2001-07-03' AS week_end FROM pr WHERE pct IS NOT NULL)"""
_PRICING = f"WITH {_SPLIT}, {_EVENTS}, {_PRODUCTS}, {_SPECIALS} "
# The greedy fold carries the last kept date along each series.
_FOLD_ROWS = f"""{_EVENTS}, o AS (SELECT item, on_date AS d, row_number() OVER (PARTITION BY item ORDER BY on_date) AS k FROM ev),
f AS (SELECT item, k, d, d AS kept, 0::BIGINT AS w FROM o WHERE k = 1 UNION ALL
      SELECT o.item, o.k, o.d, CASE WHEN o.d - f.kept < 7 THEN f.kept ELSE o.d END, CASE WHEN o.d - f.kept < 7 THEN 0
  ELSE CAST(round((o.d - f.kept) / 7e0) AS BIGINT) END
      FROM f JOIN o ON o.item = f.item AND o.k = f.k + 1),
st AS (SELECT item, k, d, sum(CASE WHEN w >= 2 THEN 1 ELSE 0 END) OVER x AS n, sum(CASE WHEN w >= 2 THEN w ELSE 0 END) OVER x AS s, sum(CASE
  WHEN w >= 2 THEN w * w ELSE 0 END) OVER x AS q, w
       FROM f WINDOW x AS (PARTITION BY item ORDER BY k))"""
_FOLD, _FOLD_ALL = (f"WITH RECURSIVE {points}, {_FOLD_ROWS}" for points in (_POOLED, _POOLED_ALL))
_WINDOW = """w1 AS (SELECT *, s / n AS mean,
  CASE WHEN n = 1 THEN 1.5e0 WHEN n < 4 THEN greatest(sqrt((n::DOUBLE * q - s::DOUBLE * s) / (n * (n - 1))), 1e0)
  ELSE sqrt((n::DOUBLE * q - s::DOUBLE * s) / (n * (n - 1))) END AS sd, CAST((7 * s) // n AS INT) AS step FROM base WHERE n > 0),
w2 AS (SELECT *, CAST(floor(round_even(greatest(1e0, least(sd, 4e0)) * 7 * 86400e6, 0) / 86400e6) AS INT) AS hd, last_sale + step AS nx FROM w1),
w3 AS (SELECT * REPLACE (CASE WHEN nx + hd < today THEN nx + step ELSE nx END AS nx) FROM w2),
w4 AS (SELECT *, nx - hd AS win_start, nx + hd AS win_end, round_even(least(0.95e0, 0.5e0 * least(n / 8e0,
  1e0) + 0.5e0 * (1e0 - least(sd / greatest(mean, 1e0), 1e0))), 2) AS confidence FROM w3),
pw AS (SELECT *, CASE WHEN n < 3 OR confidence < 0.45 THEN 'low' WHEN confidence >= 0.75 THEN 'high' ELSE 'medium' END AS tier FROM w4)"""
_PREDICT = _FOLD + """, base AS (SELECT item, arg_max(n, k)::BIGINT AS n, arg_max(s, k)::BIGINT AS s, arg_max(q, k)::BIGINT AS q, max(d) AS last_sale, DATE '2001-06-30' AS today FROM st GROUP BY item), """ + _WINDOW
_BACKTEST = _FOLD_ALL + """, base AS (SELECT a.item, b.d AS actual, a.d AS last_sale, a.n::BIGINT AS n, a.s::BIGINT AS s, a.q::BIGINT AS q, a.d + 1 AS today
  FROM st a JOIN st b ON a.item = b.item AND b.k = a.k + 1 WHERE b.k >= 3 AND b.d - a.d >= 14), """ + _WINDOW + ", bt AS (SELECT *, actual BETWEEN win_start AND win_end AS hit FROM pw)"


def _products(spark, sf_dir):
    return pricing.products(pricing.history(price_points(spark, sf_dir), "retailer", "item"), AS_OF)


def _events(spark, sf_dir, pooled=False, as_of=AS_OF):
    hist = pricing.history(price_points(spark, sf_dir, pooled, as_of), "retailer", "item")
    return hist.select("retailer", "item", F.explode(pricing.events()).alias("e")).select("retailer", "item", "e.*")


def _specials(spark, sf_dir):
    return pricing.specials(_products(spark, sf_dir), AS_OF)


def _sales(spark, sf_dir, as_of=AS_OF):
    return _events(spark, sf_dir, True, as_of).select("retailer", F.concat(F.lit(" item "), F.col("item").cast("string")).alias("name"), "item", F.col("on_date").alias("week_start"), F.lit(None).cast("int").alias("hint_weeks"))


@query(f"WITH {_SPLIT_ALL} SELECT * FROM pp")
def price_point_rows(spark, sf_dir):
    return price_points(spark, sf_dir, as_of=None)


@query(f"WITH {_SPLIT_ALL}, {_EVENTS} SELECT * FROM ev")
def half_price_events(spark, sf_dir):
    return _events(spark, sf_dir, as_of=None)


@query(f"WITH {_SPLIT}, {_EVENTS}, {_PRODUCTS} SELECT retailer, item, regular, current, changed, is_half, coalesce(n_events, 0) AS n_events FROM pr")
def product_prices(spark, sf_dir):
    return _products(spark, sf_dir).select("retailer", "item", "regular", "current", "changed", "is_half", F.size("events").cast("bigint").alias("n_events"))


@query(_PRICING + "SELECT * FROM sp")
def current_specials(spark, sf_dir):
    return _specials(spark, sf_dir)


@query(f"WITH {_SPLIT}, {_EVENTS}, {_PRODUCTS} SELECT retailer, count(*) AS products, CAST(count(*) FILTER (is_half) AS BIGINT) AS half_now, CAST(count(*) FILTER (n_events > 0) AS BIGINT) AS half_ever FROM pr GROUP BY retailer")
def specials_summary(spark, sf_dir):
    p = _products(spark, sf_dir)
    return p.groupBy("retailer").agg(F.count("*").alias("products"), F.count_if("is_half").alias("half_now"), F.count_if(F.size("events") > 0).alias("half_ever"))


@query("SELECT o_orderkey, CAST(d - CAST((isodow(d) - 3 + 7) % 7 AS INT) AS DATE) AS week_start, CAST(d - CAST((isodow(d) - 3 + 7) % 7 AS INT) + 6 AS DATE) AS week_end FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def week_math(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return o.select("o_orderkey", scalars.week_start("d").alias("week_start"), scalars.week_end("d").alias("week_end"))


@query(f"WITH {_SPLIT} SELECT CAST(count(*) FILTER (m >= DATE '2001-06-16') AS BIGINT) AS fresh, count(*) AS items FROM (SELECT max(on_date) AS m FROM pp GROUP BY retailer, item)")
def fresh_item_count(spark, sf_dir):
    return pricing.fresh_items(pricing.history(price_points(spark, sf_dir), "retailer", "item"), "2001-06-16")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Size ' || p_size WHEN p_name ILIKE '%frozen%' THEN 'Frozen' WHEN p_name ILIKE '%chocolate%' OR p_name ILIKE '%candy%' THEN 'Confectionery' ELSE 'Uncategorised' END AS category FROM part")
def category_label(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    dim = part.select(F.col("p_size").cast("string").alias("code")).distinct().where("code % 3 = 0").withColumn("label", F.concat(F.lit("Size "), F.col("code")))
    return pricing.category_labels(part.withColumn("code", F.col("p_size").cast("string")), dim, "code", "p_name").select("p_partkey", "category")


@query("SELECT p_partkey, (p_brand = 'Brand#1' AND length(CAST(p_partkey * 100000 AS VARCHAR)) >= 8) OR CAST(778 + p_size % 3 AS VARCHAR) IN ('778', '779') AS excluded FROM part")
def marketplace_filter(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_brand") == "Brand#1", "woolworths").otherwise("other").alias("r"), (F.col("p_partkey") * 100000).cast("string").alias("id"), (778 + F.col("p_size") % 3).cast("string").alias("code"))
    return part.select("p_partkey", pricing.is_marketplace("r", "id", "code").alias("excluded"))


@query(_FOLD_ALL + " SELECT item, string_agg(CAST(w AS VARCHAR), ',' ORDER BY k) FILTER (w >= 2) AS weeks FROM st GROUP BY item")
def cycle_intervals(spark, sf_dir):
    s = _sales(spark, sf_dir, None).groupBy("item").agg(F.array_sort(F.collect_list("week_start")).alias("dates")).withColumn("w", cycles.intervals())
    return s.select("item", F.when(F.size("w") > 0, F.array_join(F.transform("w", lambda x: x.cast("string")), ",")).alias("weeks"))


@query(_PREDICT + """ SELECT 'X' AS retailer, 'item ' || item AS name, n AS cycle_count, last_sale, win_start, win_end, confidence, tier,
  round_even(mean, 2) AS mean_weeks, round_even(sd, 2) AS sd_weeks,
  (CASE WHEN today - last_sale <= 7 THEN 'Currently half-price'
  ELSE 'Last seen half-price ' || CAST((today - last_sale) // 7 AS VARCHAR) || ' weeks ago' END) ||
  CASE WHEN n = 1 THEN '. Only one historical cycle observed so far — predicted window ' || win_start || ' to ' || win_end || ' is a rough estimate.'
       ELSE '. Half-price about every ' || CAST(CAST(round_even(mean,
  0) AS BIGINT) AS VARCHAR) || ' weeks on average over ' || n || ' cycles (±' || printf('%.1f', round_even(sd * 10,
  0) / 10) || ' weeks). Predicted next window: ' || win_start || ' to ' || win_end || '.' END AS rationale FROM pw""")
def predictions(spark, sf_dir):
    p = cycles.predictions(_sales(spark, sf_dir), AS_OF)
    return p.select("retailer", "name", F.col("n").alias("cycle_count"), "last_sale", "win_start", "win_end", "confidence", "tier", (F.rint(F.col("mean") * 100) / 100).alias("mean_weeks"), (F.rint(F.col("sd") * 100) / 100).alias("sd_weeks"), "rationale")


def _predicted(p):
    rounded = lambda c: F.rint(F.col(c) * 100) / 100
    return p.select(
        "retailer", "name", F.col("n").alias("cycle_count"), "last_sale", "win_start", "win_end", "confidence", "tier", rounded("mean").alias("mean_weeks"),
        rounded("sd").alias("sd_weeks"), "rationale",
    )


@query(ORACLES["predictions"])
def advanced_predictions(spark, sf_dir):
    """The same predictions from a state that was advanced three times, the last time by early sales of every tenth item too."""
    sales = stored(_sales(spark, sf_dir).withColumn("name", F.trim("name")), "sales")
    late = (F.crc32(F.col("name").cast("binary")) % 10 == 0) & (F.month("week_start") == 3)
    parts = [~late & (F.col("week_start") < "1995-01-01"), ~late & (F.col("week_start") >= "1995-01-01") & (F.col("week_start") < "1998-01-01"), late | (F.col("week_start") >= "1998-01-01")]
    kept = CycleTable(spark, work_folder(spark, "cycles"), "retailer", "name")
    for k, part in enumerate(parts):
        kept.advance(f"run {k}", sales.where(part), lambda: sales)
    return _predicted(cycle_state.predictions(kept.read(), AS_OF))


@query(_FOLD + " SELECT count(*) AS considered, CAST(count(*) FILTER (n > 0) AS BIGINT) AS emitted, CAST(count(*) FILTER (n = 0) AS BIGINT) AS gated FROM (SELECT item, arg_max(n, k) AS n FROM st GROUP BY item)")
def prediction_summary(spark, sf_dir):
    return cycles.prediction_summary(_sales(spark, sf_dir))


@query(_PREDICT + " SELECT 'item ' || item AS name, confidence, win_start FROM pw ORDER BY confidence DESC, win_start, 'item ' || item LIMIT 10")
def top_predictions(spark, sf_dir):
    """The report's top ten."""
    return cycles.predictions(_sales(spark, sf_dir), AS_OF).orderBy(F.desc("confidence"), "win_start", "name").limit(10).select("name", "confidence", "win_start")


@query(_BACKTEST + " SELECT item, actual, last_sale, n, win_start, win_end, confidence, tier, hit FROM bt")
def backtest_windows(spark, sf_dir):
    return cycles.backtest(_sales(spark, sf_dir, None)).select("item", "actual", "last_sale", "n", "win_start", "win_end", "confidence", "tier", "hit")


@query(_BACKTEST + " SELECT item, count(*) AS tested, CAST(count(*) FILTER (hit) AS BIGINT) AS hits, CAST(count(*) FILTER (r <= 6) AS BIGINT) AS last6_tested, CAST(count(*) FILTER (r <= 6 AND hit) AS BIGINT) AS last6_hits FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY actual DESC) AS r FROM bt) GROUP BY item")
def backtest_by_product(spark, sf_dir):
    return cycles.by_product(cycles.backtest(_sales(spark, sf_dir, None)))


@query(_BACKTEST + ", s AS (SELECT coalesce(tier, 'overall') AS tier, count(*) AS tested, CAST(count(*) FILTER (hit) AS BIGINT) AS hits FROM bt GROUP BY ROLLUP (tier)) SELECT t.tier, coalesce(tested, 0) AS tested, coalesce(hits, 0) AS hits, CASE WHEN tested > 0 THEN 100e0 * hits / tested END AS rate FROM (VALUES ('high'), ('medium'), ('low'), ('overall')) t(tier) LEFT JOIN s USING (tier)")
def backtest_tiers(spark, sf_dir):
    return cycles.by_tier(cycles.backtest(_sales(spark, sf_dir, None)))


_NAMES = "nm AS (SELECT p_partkey AS pid, CAST(round_even(p_retailprice * 100, 0) AS BIGINT) AS cents, p_size, trim(regexp_replace(regexp_replace(lower(concat_ws(' ', replace(p_brand, '#', ''), p_name, p_type, p_size || 'g')), '[^a-z0-9.]+', ' ', 'g'), ' +', ' ', 'g')) AS norm FROM part), it AS (SELECT *, list_sort(list_distinct(string_split(norm, ' '))) AS tokens FROM nm), ix AS (SELECT pid, p_size, unnest(tokens) AS token FROM it)"
_STOP = ", ".join(f"'{w}'" for w in scalars.STOPWORDS)
_CAND = f"""WITH {_NAMES}, ok AS (SELECT * FROM ix WHERE token NOT IN ({_STOP}) AND NOT regexp_matches(token, '^[0-9]')),
df AS (SELECT token, count(*) AS df FROM ok WHERE pid % 2 = 1 GROUP BY token),
ra AS (SELECT pid AS a, p_size, token FROM (SELECT ok.*, row_number() OVER (PARTITION BY pid ORDER BY coalesce(df, 0), token) AS r
  FROM ok LEFT JOIN df USING (token) WHERE pid % 2 = 0) WHERE r <= 3),
cd AS (SELECT DISTINCT a, pid AS b FROM ra JOIN ok ON ok.token = ra.token AND ok.p_size = ra.p_size AND pid % 2 = 1)"""
_WORDS = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
_GATED = _CAND + f""", g AS (SELECT a, b, x.tokens AS xt, y.tokens AS yt, x.norm AS xn, y.norm AS yn, x.cents AS xc, y.cents AS yc,
    list_intersect(x.tokens, {_WORDS(scalars.SOFT_VARIANTS)}) AS xs, list_intersect(y.tokens, {_WORDS(scalars.SOFT_VARIANTS)}) AS ys
  FROM cd JOIN it x ON x.pid = a JOIN it y ON y.pid = b),
j AS (SELECT a, b, len(list_intersect(xt, yt)) / len(list_distinct(list_concat(xt, yt))) AS jaccard FROM g
  WHERE (list_contains(yt, split_part(xn, ' ', 1)) OR list_contains(xt, split_part(yn, ' ', 1)))
    AND list_sort(list_intersect(xt, {_WORDS(scalars.STRICT_VARIANTS)})) = list_sort(list_intersect(yt, {_WORDS(scalars.STRICT_VARIANTS)}))
    AND (len(xs) = 0 OR len(ys) = 0 OR list_has_all(xs, ys) OR list_has_all(ys, xs))
    AND (least(xc, yc) <= 0 OR greatest(xc, yc) / least(xc, yc) <= 1.6e0)),
k AS (SELECT * FROM j WHERE jaccard >= 0.3e0)"""


def _sides(spark, sf_dir):
    # Names are read at length, and a table of a million short rows may be one file that one task would read.
    items = matching.items(catalogue(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "pid"))
    return items.where("pid % 2 = 0"), items.where("pid % 2 = 1")


@query("SELECT p_partkey AS pid, 'g:' || CAST(p_size::DOUBLE AS VARCHAR) AS quantity FROM part")
def quantity_signature(spark, sf_dir):
    return matching.items(catalogue(spark, sf_dir)).select("pid", "quantity")


@query(_CAND + " SELECT token, df FROM df")
def token_df(spark, sf_dir):
    return matching.token_frequency(_sides(spark, sf_dir)[1])


@query(_CAND + " SELECT a, b FROM cd")
def match_candidates(spark, sf_dir):
    return matching.candidates(*_sides(spark, sf_dir))


@query(_GATED + " SELECT a, b, jaccard FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY jaccard DESC, b) AS ra, row_number() OVER (PARTITION BY b ORDER BY jaccard DESC, a) AS rb FROM k) WHERE ra = 1 AND rb = 1")
def match_jaccard_best(spark, sf_dir):
    a, b = _sides(spark, sf_dir)
    return matching.mutual_best(matching.gated_matches(a, b).select("a", "b", "jaccard"), "jaccard")


@query()
def match_full(spark, sf_dir):
    """With the sequence ratio, which SQL does not have; the tests hold it against a brute-force matcher."""
    return matching.matches(*_sides(spark, sf_dir))


def _product_tables(spark, sf_dir):
    c = catalogue(spark, sf_dir)
    base = lambda df, f: df.select("sku", "name", "category", F.col("cents").alias("regular_price_cents"), F.when(F.col("pid") % f == 0, F.concat(F.lit("img"), "sku")).alias("image_url"))
    old = base(c.where("pid % 3 <> 0"), 2)
    new = base(c.where("pid % 2 = 0"), 5).withColumn("regular_price_cents", F.when(F.col("sku").cast("bigint") % 4 == 0, F.col("regular_price_cents") + 100).otherwise(F.col("regular_price_cents") - 100)).withColumn("category", F.when(F.col("sku").cast("bigint") % 10 == 0, "Uncategorised").otherwise(F.concat(F.lit("New "), "category")))
    return old, new


_PRODUCT_SQL = """c AS (SELECT p_partkey AS pid, CAST(p_partkey AS VARCHAR) AS sku, concat_ws(' ', replace(p_brand, '#', ''), p_name, p_type,
  p_size || 'g') AS name, p_type AS category, CAST(round_even(p_retailprice * 100, 0) AS BIGINT) AS cents FROM part),
o AS (SELECT sku, name, category, cents AS regular, CASE WHEN pid % 2 = 0 THEN 'img' || sku END AS image FROM c WHERE pid % 3 <> 0),
n AS (SELECT sku, name, CASE WHEN pid % 10 = 0 THEN 'Uncategorised' ELSE 'New ' || category END AS category, CASE WHEN pid % 4 = 0 THEN cents + 100
  ELSE cents - 100 END AS regular, CASE WHEN pid % 5 = 0 THEN 'img' || sku END AS image FROM c WHERE pid % 2 = 0)"""


@query(f"WITH {_PRODUCT_SQL} SELECT coalesce(o.sku, n.sku) AS sku, coalesce(n.name, o.name) AS name, CASE WHEN o.sku IS NULL OR (n.category IS NOT NULL AND n.category <> 'Uncategorised') THEN n.category ELSE o.category END AS category, greatest(o.regular, n.regular) AS regular_price_cents, coalesce(o.image, n.image) AS image_url FROM o FULL JOIN n ON o.sku = n.sku")
def upsert_products(spark, sf_dir):
    old, new = _product_tables(spark, sf_dir)
    return merge.upsert(old, new, ["sku"], merge.product_rules())


@query(f"WITH {_PRODUCT_SQL} SELECT coalesce(o.sku, n.sku) AS sku, coalesce(o.name, n.name) AS name, CASE WHEN o.sku IS NULL OR (n.category IS NOT NULL AND n.category <> 'Uncategorised') THEN n.category ELSE o.category END AS category, coalesce(o.regular, n.regular) AS regular_price_cents, coalesce(o.image, n.image) AS image_url FROM o FULL JOIN n ON o.sku = n.sku")
def upsert_catalogue(spark, sf_dir):
    return merge.upsert_catalogue(*_product_tables(spark, sf_dir), ["sku"])


def _stored(spark, sf_dir):
    """Stored specials of two sources, and the rows a new pull writes: some known, some of a product not yet stored."""
    s = _specials(spark, sf_dir).select(F.col("item").alias("product_id"), "retailer", "week_start", "sale_cents", F.when(F.col("item") % 2 == 0, "dump").otherwise("live").alias("source"))
    new = s.where("product_id % 3 = 0").withColumn("sale_cents", F.col("sale_cents") + 1).withColumn("source", F.lit("dump"))
    return s.where("product_id % 6 <> 3"), new


_STORED = _PRICING + """, a AS (SELECT item AS product_id, retailer, week_start, sale_cents, CASE WHEN item % 2 = 0 THEN 'dump'
  ELSE 'live' END AS source FROM sp),
s AS (SELECT * FROM a WHERE product_id % 6 <> 3), n AS (SELECT * REPLACE (sale_cents + 1 AS sale_cents, 'dump' AS source) FROM a WHERE product_id % 3 = 0) """


@query(_STORED + "SELECT * FROM n UNION ALL SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.product_id = s.product_id AND n.retailer = s.retailer AND n.week_start = s.week_start)")
def upsert_specials(spark, sf_dir):
    return merge.upsert(*_stored(spark, sf_dir), ["product_id", "retailer", "week_start"])


@query(_STORED + "SELECT * FROM s WHERE source <> 'dump' OR retailer <> 'A' OR product_id IN (SELECT product_id FROM n)")
def sync_week(spark, sf_dir):
    s, new = _stored(spark, sf_dir)
    return merge.sync_week(s, new, WEEK, "dump", ["A"])


@query(_STORED + "SELECT * FROM s WHERE NOT (retailer = 'B' AND source <> 'live')")
def sweep_source(spark, sf_dir):
    return merge.sweep_sources(_stored(spark, sf_dir)[0], WEEK, "B", "live")


@query(f"WITH {_SPLIT}, {_EVENTS}, w AS (SELECT retailer, item, CAST(on_date - CAST((isodow(on_date) - 3 + 7) % 7 AS INT) AS DATE) AS week_start, min(sale_cents) AS sale_cents FROM ev GROUP BY ALL) SELECT * REPLACE (CASE WHEN item % 2 = 0 THEN sale_cents + 7 ELSE sale_cents END AS sale_cents) FROM w WHERE week_start < DATE '2001-06-27'")
def history_backfill(spark, sf_dir):
    """Stored weeks (of even items, with prices of their own) stay; the others are put in."""
    weeks = _events(spark, sf_dir).groupBy("retailer", "item", scalars.week_start("on_date").alias("week_start")).agg(F.min("sale_cents").alias("sale_cents"))
    past = weeks.where(F.col("week_start") < F.lit(WEEK).cast("date"))
    return merge.insert_absent(past.where("item % 2 = 0").withColumn("sale_cents", F.col("sale_cents") + 7), past, ["retailer", "item", "week_start"])


@query(_PRICING + "SELECT 'products' AS name, CAST(count(*) FILTER (p_size <= 5) AS BIGINT) AS rows FROM part UNION ALL SELECT 'specials', count(*) FROM sp JOIN part ON item = p_partkey WHERE p_size <= 5")
def purge_preview(spark, sf_dir):
    gone = table(spark, sf_dir, "part").where("p_size <= 5").select(F.col("p_partkey").alias("product_id"))
    found = merge.purge({"products": table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id")), "specials": _specials(spark, sf_dir).select(F.col("item").alias("product_id"))}, gone)
    rows = [f.select(F.lit(name).alias("name"), "rows") for name, f in found.items()]
    return rows[0].union(rows[1])


_DIGEST = _PRICING + """, hs AS (SELECT item AS product_id, max(discount_pct) AS pct,
  'Product number ' || item || ' in its extra long named family pack' AS name FROM sp WHERE is_half_price GROUP BY item),
w AS (SELECT DISTINCT user_id AS device_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id FROM events WHERE event_type = 'view'),
m AS (SELECT device_id, product_id, pct, name, row_number() OVER (PARTITION BY device_id ORDER BY pct DESC, name, product_id) AS r
  FROM w JOIN hs USING (product_id) WHERE device_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND user_id % 4 = 0))"""


@query(_DIGEST + " SELECT device_id, count(*) AS n, CASE WHEN count(*) = 1 THEN '1 of your items is' ELSE count(*) || ' of your items are' END || ' half-price this week: ' || string_agg(CASE WHEN length(name) > 40 THEN left(name, 39) || '…' ELSE name END, ', ' ORDER BY r) FILTER (r <= 3) || CASE WHEN count(*) > 3 THEN ' + ' || (count(*) - 3) || ' more' ELSE '' END || '.' AS body FROM m GROUP BY device_id")
def watchlist_digest(spark, sf_dir):
    s = _specials(spark, sf_dir).where("is_half_price").groupBy(F.col("item").alias("product_id")).agg(F.max("discount_pct").alias("discount_pct"))
    s = s.select("product_id", "discount_pct", F.concat(F.lit("Product number "), F.col("product_id").cast("string"), F.lit(" in its extra long named family pack")).alias("name"), F.lit(WEEK).cast("date").alias("week_start"), F.lit(True).alias("is_half_price"))
    lists = watched(spark, sf_dir).groupBy("device_id").agg(F.collect_set("product_id").alias("watched"))
    sent = watched(spark, sf_dir, "signup").where("device_id % 4 = 0").select("device_id", F.lit(WEEK).cast("date").alias("week_start"), F.lit("weekly_digest").alias("alert_type"))
    d = digests.eligible(lists, s, sent, WEEK)
    return d.select("device_id", F.size("names").cast("bigint").alias("n"), "body")


@query(f"""WITH {_SPLIT}, {_EVENTS}, {_PRODUCTS}, t AS (SELECT item AS id, pct >= 40 AS t_half, current AS t_cents
  FROM pr WHERE retailer = 'A' AND pct IS NOT NULL), o AS (SELECT item AS oid, is_half AS o_half, current AS o_cents FROM pr WHERE retailer = 'B'),
j AS (SELECT * FROM t LEFT JOIN o ON id = oid),
c AS (SELECT CAST(count(*) FILTER (t_half) AS BIGINT) AS catalogue_half, CAST(count(*) FILTER (t_half
  AND oid IS NOT NULL) AS BIGINT) AS matched, CAST(count(*) FILTER (t_half AND o_half) AS BIGINT) AS flagged, CAST(count(*) FILTER (t_half
  AND NOT o_half) AS BIGINT) AS missed, CAST(count(*) FILTER (t_half AND oid IS NULL) AS BIGINT) AS not_stocked,
  CAST(count(*) FILTER (NOT t_half AND oid IS NOT NULL) AS BIGINT) AS non_half, CAST(count(*) FILTER (NOT t_half
  AND o_half) AS BIGINT) AS false_pos, CAST(count(*) FILTER (t_half AND o_half AND t_cents <> 0
  AND o_cents <> 0) AS BIGINT) AS priced, CAST(count(*) FILTER (t_half AND o_half AND t_cents <> 0 AND o_cents = t_cents) AS BIGINT) AS exact FROM j)
SELECT *, CASE WHEN matched > 0 THEN round_even(1000e0 * flagged / matched, 0) / 10 END AS recall_pct, CASE
  WHEN non_half > 0 THEN round_even(1000e0 * (non_half - false_pos) / non_half, 0) / 10 END AS precision_pct, CASE
  WHEN priced > 0 THEN round_even(1000e0 * exact / priced, 0) / 10 END AS price_pct FROM c""")
def audit_metrics(spark, sf_dir):
    p = _products(spark, sf_dir)
    truth = p.where("retailer = 'A' AND pct IS NOT NULL").select(F.col("item").alias("id"), (F.col("pct") >= 40).alias("is_half"), F.col("current").alias("sale_cents"))
    return digests.audit(truth, p.where("retailer = 'B'").select(F.col("item").alias("id"), "is_half", F.col("current").alias("sale_cents")))


@query("SELECT CAST(o_orderdate AS DATE) AS expected, count(*) AS n, bool_or(o_custkey % 5 = 0) AS any_null, count(*) < 200 AS blocked, count(*) FILTER (o_orderstatus = 'F') = 0 AS solo, CASE WHEN count(*) FILTER (o_orderstatus = 'P') = 0 THEN 1 ELSE 0 END AS exit_code FROM orders GROUP BY 1")
def guard_new_week(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("expected")).agg(F.count("*").alias("n"), F.bool_or(F.col("o_custkey") % 5 == 0).alias("any_null"), F.count_if(F.col("o_orderstatus") == "F").alias("other"), F.count_if(F.col("o_orderstatus") == "P").alias("written"))
    o = o.withColumn("db_max", F.when(~F.col("any_null"), F.date_sub("expected", 7)))
    return o.select("expected", "n", "any_null", guards.blocks_new_week("db_max", "expected", "n").alias("blocked"), guards.solo_roll("db_max", "expected", "other").alias("solo"), guards.exit_code("written").alias("exit_code"))


_HELD = "CASE p_partkey % 6 WHEN 0 THEN p_name || ' treats' WHEN 1 THEN 'Cat ' || p_name WHEN 2 THEN p_name || ' instant' WHEN 3 THEN p_name || ' recipe base' ELSE p_name END"


@query(f"SELECT p_partkey, regexp_matches(lower(n), '\\b(red|blue|hot)\\b') AS fits_raw, regexp_matches(lower(n), '\\b(red|blue|hot)\\b') AND p_partkey % 6 NOT IN (2, 3) AS fits, p_partkey % 6 IN (0, 1) AS junk FROM (SELECT p_partkey, {_HELD} AS n FROM part)")
def bundle_candidates(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumn("n", F.expr(_HELD))
    words = ("red", "blue", "hot")
    return part.select("p_partkey", bundles.slot_match("n", bundles.Slot(words, "1", True)).alias("fits_raw"), bundles.slot_match("n", bundles.Slot(words, "1")).alias("fits"), bundles.is_junk("n").alias("junk"))


def _pick(k, word, used):
    free = " AND ".join(f"pid NOT IN (SELECT pid FROM {u})" for u in used) or "true"
    return f"s{k} AS (SELECT pid FROM nm WHERE regexp_matches(lower(name), '\\b{word}\\b') AND {free} ORDER BY cents, pid LIMIT 1)"


# A bundle with two picks or more keeps them; with one it gives it back.
_PLAN = f"""WITH nm AS (SELECT p_partkey AS pid, concat_ws(' ', replace(p_brand, '#', ''), p_name, p_type, p_size || 'g') AS name,
  CAST(round_even(p_retailprice * 100, 0) AS BIGINT) AS cents FROM part),
{_pick(1, 'red', [])}, {_pick(2, 'blue', ['s1'])}, b1 AS (SELECT 0 AS bundle, 'Red and blue' AS title, 0 AS slot, pid FROM s1
  UNION ALL SELECT 0, 'Red and blue', 1, pid FROM s2), k1 AS (SELECT * FROM b1 WHERE (SELECT count(*) FROM b1) >= 2),
{_pick(3, 'hot', ['k1'])}, {_pick(4, 'green', ['k1', 's3'])}, {_pick(5, 'steel', ['k1', 's3', 's4'])}, b2 AS (SELECT 1 AS bundle,
  'Hot and green' AS title, 0 AS slot, pid FROM s3 UNION ALL SELECT 1, 'Hot and green', 1, pid FROM s4
  UNION ALL SELECT 1, 'Hot and green', 2, pid FROM s5), k2 AS (SELECT * FROM b2 WHERE (SELECT count(*) FROM b2) >= 2),
{_pick(6, 'cold', ['k1', 'k2'])}, {_pick(7, 'ring', ['k1', 'k2', 's6'])}, b3 AS (SELECT 2 AS bundle, 'Cold ring' AS title, 0 AS slot, pid
  FROM s6 UNION ALL SELECT 2, 'Cold ring', 1, pid FROM s7)
SELECT bundle, title, slot, pid AS product_id, '1' AS label FROM (SELECT * FROM k1 UNION ALL SELECT * FROM k2
  UNION ALL SELECT * FROM b3 WHERE (SELECT count(*) FROM b3) >= 2)"""


@query(_PLAN)
def bundle_plan(spark, sf_dir):
    """Greedy bundles over the driver's names: of the second bundle one slot only is filled, so it gives its pick back."""
    offers = catalogue(spark, sf_dir).select(F.col("pid").alias("product_id"), "name", F.col("cents").alias("sale_cents"))
    made = (bundles.Bundle("Red and blue", (bundles.Slot(("red",), "1"), bundles.Slot(("blue",), "1"))), bundles.Bundle("Hot and green", (bundles.Slot(("hot",), "1"), bundles.Slot(("green",), "1"), bundles.Slot(("steel",), "1"))), bundles.Bundle("Cold ring", (bundles.Slot(("cold",), "1"), bundles.Slot(("ring",), "1"))))
    return bundles.compose(offers, made)


@query(_PRICING + ", i AS (SELECT DISTINCT o_custkey AS r, l_partkey AS p FROM orders JOIN lineitem ON l_orderkey = o_orderkey) SELECT 'recipe ' || r AS title, count(*) AS missing FROM i WHERE p NOT IN (SELECT item FROM sp WHERE is_half_price) GROUP BY r")
def stale_heroes(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    recipes = o.join(li, o.o_orderkey == li.l_orderkey).groupBy(F.concat(F.lit("recipe "), F.col("o_custkey").cast("string")).alias("title")).agg(F.collect_set(F.struct(F.col("l_partkey").alias("product_id"), F.lit("1").alias("label"))).alias("ingredients"))
    offers = _specials(spark, sf_dir).where("is_half_price").select(F.col("item").alias("product_id"))
    return bundles.stale(recipes, offers)


@query("SELECT c_custkey FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 50")
def work_queue(spark, sf_dir):
    """A queue of fifty, as the feature has it."""
    return table(spark, sf_dir, "customer").where("c_acctbal > 0").orderBy(F.col("c_acctbal").desc_nulls_last(), "c_custkey").limit(50).select("c_custkey")


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def dedup_first_wins(spark, sf_dir):
    return merge.first_wins(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def dedup_last_wins(spark, sf_dir):
    return merge.last_wins(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


@query("SELECT o_custkey, coalesce(min(o_orderkey) FILTER (o_orderstatus = 'F'), min(o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def dedup_prefer_flag(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderstatus") == "F").alias("flag"))
    return merge.prefer_flag(o, ["o_custkey"], "flag", "o_orderkey").select("o_custkey", "o_orderkey")


@query(r"SELECT page_id, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1) AS lang, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) AS id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM pages")
def url_parse(spark, sf_dir):
    pattern = r"/([a-z]{2})/([0-9]+)"
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", pattern, 1).alias("lang"), F.regexp_extract("url", pattern, 2).alias("id"), scalars.slug("url").alias("slug"))


@query("""WITH nm AS (SELECT p_partkey AS pid, lower(concat_ws(' ', replace(p_brand, '#', ''), p_name, p_type, p_size || 'g')) AS name FROM part),
t AS (SELECT pid, list_distinct(string_split(name, ' ')) AS w, split_part(name, ' ', 1) AS lead FROM nm),
x AS (SELECT pid, lead, len(w) AS n, unnest(w) AS word FROM t WHERE pid % 2 = 0), y AS (SELECT pid AS entry, len(w) AS m, unnest(w) AS word
  FROM t WHERE pid % 2 = 1),
k AS (SELECT pid, entry, n, m, count(*) AS k FROM x JOIN y USING (word) GROUP BY ALL HAVING count(*) / n >= 0.6),
a AS (SELECT k.* FROM k JOIN t p ON p.pid = k.pid JOIN t e ON e.pid = k.entry WHERE list_contains(p.w, e.lead) OR list_contains(e.w, p.lead))
SELECT pid, entry, k / n AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY pid ORDER BY k DESC, abs(m - n), entry) AS r FROM a) WHERE r = 1""")
def overlap_best_match(spark, sf_dir):
    """Catalogue names matched to slugs of the other half's names."""
    c = catalogue(spark, sf_dir)
    return matching.best_slugs(c.where("pid % 2 = 0").select("pid", "name"), c.where("pid % 2 = 1").select(F.col("pid").alias("entry"), scalars.slug("name").alias("slug")))


from pricewave.plans import check_queries, source_queries, upkeep_queries, write_queries  # noqa: E402, F401
