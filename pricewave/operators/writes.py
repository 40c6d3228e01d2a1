"""What a run writes beside its specials: product ids looked up, logs, receipts, runs and images, as tables to tables."""

from pyspark.sql import Column, DataFrame, functions as F

from pricewave.operators.merge import insert_absent, last_wins, upsert

DIGEST_KEYS = ["device_id", "week_start", "alert_type"]
MAX_DETAIL = 500
GONE_DEVICE = "DeviceNotRegistered"


def with_product_ids(rows: DataFrame, products: DataFrame) -> DataFrame:
    """rows (retailer, sku, ...) with the product_id of that retailer's product; rows without a product are left out."""
    return rows.join(products.select("retailer", "sku", "product_id"), ["retailer", "sku"])


def upsert_observations(old: DataFrame, specials: DataFrame, products: DataFrame, position: str = "pos") -> DataFrame:
    """Price observations on the day a special starts, by product, day and source; of rows that share these the last by position counts, over what is stored too."""
    keys = ["product_id", "observed_at", "source"]
    found = with_product_ids(specials, products).select(
        "product_id", F.col("sale_cents").alias("price_cents"), F.lit(True).alias("is_special"), "discount_pct", F.col("week_start").alias("observed_at"), "source", F.col(position).alias("_pos")
    )
    return upsert(old, last_wins(found, keys, "_pos").drop("_pos"), keys)


def predicted_products(predictions: DataFrame, products: DataFrame) -> DataFrame:
    """predictions (retailer, name, ...) with product_id, null where no product has that name.

    Of products that share a retailer and a name the last one counts; a
    prediction's name is trimmed, a product's is taken as stored.
    """
    last = products.groupBy(F.col("retailer").alias("_retailer"), F.col("name").alias("_name")).agg(F.max("product_id").alias("product_id"))
    return predictions.join(last, (F.col("retailer") == F.col("_retailer")) & (F.trim("name") == F.col("_name")), "left").drop("_retailer", "_name")


def insert_predictions(old: DataFrame, predictions: DataFrame, products: DataFrame) -> DataFrame:
    """old and the predictions of known products, unless old has one of the same product and time."""
    return insert_absent(old, predicted_products(predictions, products).where("product_id IS NOT NULL"), ["product_id", "computed_at"])


def drop_leftovers(specials: DataFrame, products: DataFrame, week: str, retailer: str, sources: list[str]) -> DataFrame:
    """Without the retailer's specials of the week that come from these sources."""
    mine = products.where(F.col("retailer") == retailer).select("product_id").distinct().withColumn("_mine", F.lit(True))
    gone = F.col("_mine").isNotNull() & (F.col("week_start") == F.lit(week).cast("date")) & F.col("source").isin(sources)
    return specials.join(mine, "product_id", "left").where(~F.coalesce(gone, F.lit(False))).select(*specials.columns)


def replace_links(old: DataFrame, matches: DataFrame) -> DataFrame:
    """Aliases (canonical, variant, kind, confidence, created_by): all counterpart rows give way to the matches (a, b, score); a pair that is known by another kind is changed."""
    new = matches.select(F.col("a").alias("canonical"), F.col("b").alias("variant"), F.lit("counterpart").alias("kind"), (F.rint(F.least("score", F.lit(1.0)) * 100) / 100).alias("confidence"), F.lit("auto").alias("created_by"))
    return upsert(old.where("kind <> 'counterpart'"), new, ["canonical", "variant"], {"created_by": F.col("o.created_by")})


def _detail(error: str, message: str) -> Column:
    return F.left(F.coalesce(error, message), F.lit(MAX_DETAIL))


def sent_rows(messages: DataFrame, tickets: DataFrame, week: str) -> DataFrame:
    """Log rows of messages (batch, pos, device_id, product_ids, names) and the tickets (batch, pos, ticket_id, status, error, message) that answer them by position; what has no counterpart is left out."""
    ok = F.col("status") == "ok"
    return messages.join(tickets, ["batch", "pos"]).select(
        "device_id", F.lit("weekly_digest").alias("alert_type"), F.lit(week).cast("date").alias("week_start"), "product_ids", F.size("names").cast("bigint").alias("item_count"),
        "ticket_id", F.when(ok, "sent").otherwise("errored").alias("status"), F.when(~F.coalesce(ok, F.lit(False)), _detail("error", "message")).alias("error_detail"),
    )


def log_digests(log: DataFrame, sent: DataFrame) -> DataFrame:
    """The log with the rows sent, once per device, week and kind."""
    return insert_absent(log, sent, DIGEST_KEYS)


def apply_receipts(log: DataFrame, receipts: DataFrame, now: str, wait_minutes: int = 30) -> DataFrame:
    """The log with the outcome of the tickets that were sent long enough ago; receipts is (ticket_id, outcome, error, message), unknown tickets change nothing."""
    r = receipts.select(F.col("ticket_id").alias("_ticket"), "outcome", F.col("error").alias("_error"), F.col("message").alias("_message"))
    due = (F.col("status") == "sent") & (F.col("sent_at") < F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(wait_minutes)))
    hit = F.coalesce(F.col("outcome").isNotNull() & due, F.lit(False))
    good = F.col("outcome") == "ok"
    found = log.join(r, F.col("ticket_id") == F.col("_ticket"), "left")
    status = F.when(hit & good, "receipt_ok").when(hit, "receipt_error").otherwise(F.col("status"))
    detail = F.when(hit & ~good, _detail("_error", "_message")).otherwise(F.col("error_detail"))
    return found.withColumns({"status": status, "error_detail": detail}).select(*log.columns)


def drop_tokens(watchlists: DataFrame, failures: DataFrame) -> DataFrame:
    """Watchlists (device_id, push_token, ...) without the tokens of devices (device_id, error) that are gone."""
    gone = failures.where(F.col("error") == GONE_DEVICE).select("device_id").distinct().withColumn("_gone", F.lit(True))
    found = watchlists.join(gone, "device_id", "left")
    return found.withColumn("push_token", F.when(F.col("_gone").isNull(), F.col("push_token"))).select(*watchlists.columns)


def finish_runs(runs: DataFrame, written: DataFrame) -> DataFrame:
    """Runs (id, ..., items_found, status) with the counts and states (id, items_written, status) of those that have ended."""
    w = written.select("id", F.col("items_written").alias("_n"), F.col("status").alias("_status"))
    found = runs.join(w, "id", "left")
    ended = F.col("_status").isNotNull() | F.col("_n").isNotNull()
    return found.withColumns({"items_found": F.when(ended, F.col("_n")).otherwise(F.col("items_found")), "status": F.when(ended, F.col("_status")).otherwise(F.col("status"))}).select(*runs.columns)


def image_work(products: DataFrame, n: int) -> DataFrame:
    """The next n products to look an image up for: neither found nor tried, the latest seen first."""
    return products.where("image_url IS NULL AND image_fetched_at IS NULL").orderBy(F.col("last_seen").desc_nulls_last(), "product_id").limit(n)


def write_images(products: DataFrame, results: DataFrame, now: str) -> DataFrame:
    """Products with the results (product_id, image_url, method) of lookups: a hit sets address and time, a miss the time only."""
    r = results.groupBy("product_id").agg(F.max("image_url").alias("_url")).withColumn("_tried", F.lit(True))
    found = products.join(r, "product_id", "left")
    at = F.when(F.col("_tried").isNotNull(), F.lit(now).cast("timestamp")).otherwise(F.col("image_fetched_at"))
    return found.withColumns({"image_url": F.coalesce("_url", "image_url"), "image_fetched_at": at}).select(*products.columns)


def lookup_counts(results: DataFrame) -> DataFrame:
    """(method, considered, hits, hit_rate) per method, and overall with method "all"."""
    sums = results.rollup("method").agg(F.count("*").alias("considered"), F.count("image_url").alias("hits"), F.grouping("method").alias("g"))
    return sums.select(F.when(F.col("g") == 1, "all").otherwise(F.col("method")).alias("method"), "considered", "hits", (F.col("hits") / F.greatest("considered", F.lit(1))).alias("hit_rate"))


def resolved_names(asked: DataFrame, found: DataFrame, tokens: Column, other: Column, least: float = 0.6) -> DataFrame:
    """(pid, pos, name, overlap): of a search's results (pid, pos, name, ...) the one that holds most of the asked name's words, the first of equals."""
    q = asked.select("pid", tokens.alias("_q")).where(F.size("_q") > 0)
    scored = found.where("name <> ''").withColumn("_t", other).join(q, "pid").withColumn("overlap", F.size(F.array_intersect("_q", "_t")) / F.size("_q")).where(F.col("overlap") >= least)
    best = scored.groupBy("pid").agg(F.max_by(F.struct("pos", "name", "overlap"), F.struct("overlap", -F.col("pos"))).alias("m"))
    return best.select("pid", "m.*")


def weekly_specials(specials: DataFrame, products: DataFrame) -> DataFrame:
    """Stored specials with retailer, name and category of their product, in the order of retailer, name and week."""
    p = products.select("product_id", "retailer", "name", F.coalesce("category", F.lit("Uncategorised")).alias("category"))
    return specials.join(p, "product_id").select("retailer", "name", "category", "regular_cents", "sale_cents", "discount_pct", "is_half_price", "week_start", "week_end", "source").orderBy("retailer", "name", "week_start")


def changed_labels(known: DataFrame, allowed: DataFrame) -> DataFrame:
    """Labels of known that allowed lacks."""
    return known.select("label").distinct().subtract(allowed.select("label"))
