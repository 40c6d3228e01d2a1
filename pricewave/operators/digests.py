"""Watchlist digests, and the audit against an external catalogue."""

from pyspark.sql import DataFrame, functions as F

from pricewave.functions.scalars import digest_text
from pricewave.operators.merge import upsert


def eligible(watch: DataFrame, specials: DataFrame, sent: DataFrame, week: str) -> DataFrame:
    """(device_id, names, product_ids, body): one row per device due a digest.

    watch is (device_id, watched array); specials (product_id, name,
    discount_pct, week_start, is_half_price); sent (device_id, week_start,
    alert_type). The watched ids are exploded into an equi-join.
    """
    day = F.lit(week).cast("date")
    due = watch.join(sent.where((F.col("week_start") == day) & (F.col("alert_type") == "weekly_digest")).select("device_id").distinct(), "device_id", "left_anti")
    asked = due.select("device_id", F.explode(F.array_distinct("watched")).alias("product_id"))
    now = specials.where((F.col("week_start") == day) & F.col("is_half_price")).select("product_id", "name", "discount_pct")
    found = asked.join(now, "product_id").groupBy("device_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("discount_pct")).alias("o"), "name", "product_id"))).alias("x"))
    names, ids = F.transform("x", lambda r: r["name"]), F.transform("x", lambda r: r["product_id"])
    return found.select("device_id", names.alias("names"), ids.alias("product_ids")).withColumn("body", digest_text("names"))


def audit(truth: DataFrame, ours: DataFrame) -> DataFrame:
    """One row of measures: truth (id, is_half, sale_cents) against ours (id, is_half, sale_cents), ids unique in each."""
    t = truth.select("id", F.col("is_half").alias("t_half"), F.col("sale_cents").alias("t_cents"))
    j = t.join(ours.select(F.col("id").alias("oid"), F.col("is_half").alias("o_half"), F.col("sale_cents").alias("o_cents")), t["id"] == F.col("oid"), "left")
    have, mine = F.col("oid").isNotNull(), F.coalesce("o_half", F.lit(False))
    half = F.col("t_half")
    priced = half & have & mine & (F.coalesce("t_cents", F.lit(0)) != 0) & (F.coalesce("o_cents", F.lit(0)) != 0)
    n = lambda c, name: F.count_if(c).alias(name)
    counts = j.agg(
        n(half, "catalogue_half"), n(half & have, "matched"), n(half & have & mine, "flagged"), n(half & have & ~mine, "missed"), n(half & ~have, "not_stocked"),
        n(~half & have, "non_half"), n(~half & have & mine, "false_pos"), n(priced, "priced"), n(priced & (F.col("t_cents") == F.col("o_cents")), "exact"),
    )
    pct = lambda x, y: F.when(y > 0, F.rint(1000.0 * x / y) / 10)
    c = F.col
    return counts.select("*", pct(c("flagged"), c("matched")).alias("recall_pct"), pct(c("non_half") - c("false_pos"), c("non_half")).alias("precision_pct"), pct(c("exact"), c("priced")).alias("price_pct"))


def corrections(specials: DataFrame, truth: DataFrame, week: str) -> DataFrame:
    """Specials of the week with the half prices put in that they miss: changed where there is a row that is none, else inserted.

    truth is (id, is_half, sale_cents, was_cents), ids being those of products,
    each once. A row of the week that is at half price already stays as it is. A
    missing was-price is twice the sale. A row's regular price never falls, the
    discount is that of the catalogue's own prices, and an inserted row ends in
    the week it starts, as its catalogue gives no more.
    """
    day = F.lit(week).cast("date")
    was = F.when(F.coalesce("was_cents", F.lit(0)) != 0, F.col("was_cents")).otherwise(2 * F.col("sale_cents"))
    flagged = specials.where((F.col("week_start") == day) & F.col("is_half_price")).select(F.col("product_id").alias("id"))
    missed = truth.where("is_half AND sale_cents > 0").withColumn("was", was).where("was > 0").join(flagged, "id", "left_anti")
    fix = missed.select(
        F.col("id").alias("product_id"), day.alias("week_start"), day.alias("week_end"), F.col("was").alias("regular_cents"), "sale_cents",
        F.rint(100.0 * (F.col("was") - F.col("sale_cents")) / F.col("was")).cast("bigint").alias("discount_pct"), F.lit(True).alias("is_half_price"), F.lit("catalogue").alias("source"),
    )
    rules = {"regular_cents": F.greatest("o.regular_cents", "n.regular_cents"), "week_end": F.col("o.week_end")}
    return upsert(specials, fix, ["product_id", "week_start"], rules)


def audit_entry(measures: DataFrame, retailer: str, week: str, source: str, sales: list[str], measured_at: str) -> DataFrame:
    """The row that an audit adds to its table, from the one row of audit(): counts, rates and a note."""
    c = lambda n: F.col(n).cast("string")
    note = F.concat(F.lit("missed="), c("missed"), F.lit(" not_stocked="), c("not_stocked"), F.lit(" false_pos="), c("false_pos"), F.lit(" sales=" + ",".join(sales)))
    return measures.select(
        F.lit(retailer).alias("retailer"), F.lit(week).cast("date").alias("week_start"), F.lit(source).alias("source"), F.col("catalogue_half").alias("ground_truth_half"), "matched",
        F.col("flagged").alias("we_flag_half"), "recall_pct", "precision_pct", F.col("price_pct").alias("price_exact_pct"), note.alias("sample_note"), F.lit(measured_at).cast("timestamp").alias("measured_at"),
    )


def latest_recall(audits: DataFrame, retailer: str) -> DataFrame:
    """(recall_pct) of the retailer's latest audit; null without one."""
    return audits.where(F.col("retailer") == retailer).agg(F.max_by("recall_pct", "measured_at").alias("recall_pct"))


def audit_sample(matches: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n pairs (a, b) for a manual audit: the least by a hash of the seed and the pair, so that a run can be repeated."""
    return matches.orderBy(F.md5(F.concat_ws(":", F.lit(seed).cast("string"), "a", "b")), "a", "b").limit(n)
