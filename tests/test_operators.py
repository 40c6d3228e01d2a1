"""Operators on literal cases and against plain loops."""

import datetime as dt
import gzip
import html
import json
import random
import re
import unicodedata
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from pricewave.functions import scalars
from pricewave.operators import bundles, cycles, digests, guards, matching, merge, pricing
from pricewave.plans import registry
from pricewave.sources import parsers
from pricewave.streaming import changes

TODAY = "2026-06-17"


def day(text):
    return dt.date.fromisoformat(text)


def back(n):
    return day(TODAY) - dt.timedelta(days=n)


def histories(spark, *found):
    rows = [(str(i), [(back(d), c) for d, c in h]) for i, h in enumerate(found)]
    return spark.createDataFrame(rows, "item string, hist array<struct<on_date: date, cents: bigint>>").withColumn("retailer", F.lit("A"))


def test_cents(spark):
    rows = spark.createDataFrame([("3.5",), ("2.00",), ("0",), (None,), ("abc",), ("0.125",), ("NaN",)], "p string")
    assert [r[0] for r in rows.select(scalars.cents("p")).collect()] == [350, 200, None, None, None, 12, None]


def test_history_keeps_order_and_drops_malformed(spark):
    raw = [("2026-06-10", "5.0"), ("bad-date", "4.0"), ("2026-05-01", None), ("2026-04-01", "10.0")]
    df = spark.createDataFrame([(raw,), (None,)], "priceHistory array<struct<date: string, price: string>>")
    found = [[tuple(p) for p in r[0]] for r in df.select(pricing.parse_history()).collect()]
    assert found == [[(day("2026-06-10"), 500), (day("2026-04-01"), 1000)], []]


def test_events_and_prices(spark):
    df = histories(spark, [(2, 500), (9, 1000)], [(2, 700), (9, 1000)], [(2, 500), (400, 2000)], [(3, 200), (200, 400)], [(20, 200), (200, 400)], [(2, 700), (100, 1000)])
    p = {r.item: r for r in pricing.products(df, TODAY).collect()}
    assert [(e.sale_cents, e.regular_cents, e.discount_pct) for e in p["0"].events] == [(500, 1000, 50)] and p["1"].events == []
    assert (p["0"].regular, p["2"].regular) == (1000, 500)
    assert (p["3"].is_half, p["3"].regular, p["3"].current) == (True, 400, 200)
    assert not p["4"].is_half and (p["5"].is_half, p["5"].pct) == (False, 30)


def test_folding_equals_unicode(spark):
    """Names and search words against Python's NFKD, over every character up to U+2FFFF that is no surrogate."""
    given = [f"a{chr(c)}b {chr(c)}" for c in range(32, 0x30000) if not 0xD800 <= c < 0xE000]
    got = spark.createDataFrame([(t,) for t in given], "t string").repartition(4).select("t", scalars.normal_name(F.col("t")), scalars.search_tokens("t"), scalars.search_tokens("t", False)).collect()

    def name(t):
        t = "".join(c for c in unicodedata.normalize("NFKD", t.lower()) if not unicodedata.combining(c)).replace("&", " and ")
        return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9.]+", " ", t)).strip()

    words = lambda t: {w for w in re.sub(r"[^a-z0-9\s]+", " ", t.lower()).split() if len(w) > 1}
    assert [r for r in got if (r[1], set(r[2]), set(r[3])) != (name(r.t), words(unicodedata.normalize("NFKD", r.t).encode("ascii", "ignore").decode()), words(r.t))] == []


def test_unescape(spark):
    given = ["a &amp; b", "&lt;&#65;&#x1F600;&eacute;&nbsp;x", "&bogus; & x", "AT&T &quot;q&quot;", "", "no"]
    got = spark.createDataFrame([(t,) for t in given], "t string").select("t", scalars.unescape("t").alias("u")).collect()
    assert all(r.u == html.unescape(r.t) for r in got) and len(got) == len(given)


def test_week_start(spark):
    days = [day("2026-06-17") + dt.timedelta(days=k) for k in (-1, 0, 6, 7)]
    got = [str(r[0]) for r in spark.createDataFrame([(d,) for d in days], "d date").select(scalars.week_start("d")).collect()]
    assert got == ["2026-06-10", "2026-06-17", "2026-06-17", "2026-06-24"]


@pytest.mark.parametrize("sales, weeks", [
    ([("2026-01-07", None), ("2026-01-28", None), ("2026-02-18", None)], [3, 3]), ([("2026-02-18", 3)], [3]),
    ([("2026-01-07", None), ("2026-01-10", None), ("2026-01-28", None)], [3]), ([("2026-01-07", None), ("2026-01-14", None)], []), ([("2026-01-07", None)], []),
])
def test_intervals(spark, sales, weeks):
    df = spark.createDataFrame([([(day(d), h) for d, h in sales],)], "entries array<struct<week_start: date, hint_weeks: int>>")
    assert df.withColumn("dates", cycles.sale_dates()).select(cycles.intervals()).first()[0] == weeks


def test_greedy_fold_keeps_the_last_kept_date(spark):
    df = spark.createDataFrame([([day("2026-01-01"), day("2026-01-06"), day("2026-01-09"), day("2026-02-12")],)], "dates array<date>")
    assert [(s.last.day, s.n) for s in df.select(cycles.running()).first()[0]] == [(1, 0), (1, 0), (9, 0), (12, 1)]


def test_windows(spark):
    rows = [("one", 1, 3, 9, day("2026-06-10")), ("two", 2, 6, 18, day("2026-06-10")), ("wild", 4, 64, 1808, day("2026-06-10")), ("old", 2, 6, 18, back(42))]
    df = spark.createDataFrame(rows, "k string, n bigint, s bigint, q bigint, last_sale date").withColumn("today", F.lit(TODAY).cast("date"))
    w = {r.k: r for r in cycles.with_window(df, "today").collect()}
    assert (w["one"].mean, w["one"].sd, w["two"].sd) == (3.0, 1.5, 1.0)
    assert (w["one"].win_end - w["one"].win_start).days == 20
    assert (w["wild"].win_end - w["wild"].win_start).days <= 58
    assert w["old"].win_end >= day(TODAY) and w["one"].tier == "low"


def test_quantities(spark):
    names = ["5x70g", "24x375ml", "1.2kg", "36pk", "plain"]
    df = spark.createDataFrame([(n,) for n in names], "norm string")
    got = [tuple(r) for r in df.select(scalars.quantity_signature("norm"), scalars.pack_counts("norm")).collect()]
    assert got == [("g:350.0", ""), ("ml:9000.0", ""), ("g:1200.0", ""), ("", "36"), ("", "")]


def plain_matches(rows):
    """The matching rules over all pairs, in plain Python."""
    made = {}
    for pid, name, cents in rows:
        norm = re.sub(" +", " ", re.sub("[^a-z0-9.]+", " ", name.lower())).strip()
        toks = sorted(set(norm.split()))
        made[pid] = (norm, toks, sum(map(int, re.findall(r"(\d+)g\b", norm))), cents, [t for t in toks if t not in scalars.STOPWORDS and not t[0].isdigit()])
    left, right = [p for p in made if p % 2 == 0], [p for p in made if p % 2]
    freq = {}
    for b in right:
        for t in made[b][4]:
            freq[t] = freq.get(t, 0) + 1
    scores = {}
    for a in left:
        rare = sorted(made[a][4], key=lambda t: (freq.get(t, 0), t))[:3]
        for b in right:
            (an, at, aq, ac, _), (bn, bt, bq, bc, bi) = made[a], made[b]
            if not set(rare) & set(bi) or (aq and bq and aq != bq):
                continue
            if an.split()[0] not in bt and bn.split()[0] not in at:
                continue
            sets = [set(x) & set(scalars.STRICT_VARIANTS) for x in (at, bt)] + [set(x) & set(scalars.SOFT_VARIANTS) for x in (at, bt)]
            if sets[0] != sets[1] or (sets[2] and sets[3] and not (sets[2] <= sets[3] or sets[3] <= sets[2])):
                continue
            jac = len(set(at) & set(bt)) / len(set(at) | set(bt))
            sized = aq > 0 and bq > 0
            if jac < 0.3 or (ac and bc and max(ac, bc) / min(ac, bc) > (1.6 if sized else 1.4)):
                continue
            score = 0.5 * jac + 0.5 * SequenceMatcher(None, " ".join(at), " ".join(bt)).ratio()
            if score >= (0.6 if sized else 0.75):
                scores[a, b] = score
    best = lambda i, x: min((p for p in scores if p[i] == x), key=lambda p: (-scores[p], p[1 - i]))
    return {p: round(s, 9) for p, s in scores.items() if best(0, p[0]) == p and best(1, p[1]) == p}


def test_matching_equals_all_pairs(spark):
    rng = random.Random(5)
    brands, words = ["acme", "zest", "moor"], ["sauce", "bean", "lemon", "lime", "blue", "red", "rice", "soup", "fresh", "with", "mint"]
    rows = [(i, " ".join([rng.choice(brands), *rng.sample(words, rng.randint(1, 4)), *rng.choice([["500g"], ["400g"], []])]), rng.choice([None, 100, 130, 150, 190])) for i in range(160)]
    made = matching.items(spark.createDataFrame(rows, "pid long, name string, cents long"))
    found = matching.matches(made.where("pid % 2 = 0"), made.where("pid % 2 = 1"))
    got = {(r.a, r.b): round(r.score, 9) for r in found.collect()}
    assert len(got) > 10 and got == plain_matches(rows)


def test_slugs_equal_all_pairs(spark):
    rng = random.Random(6)
    words = ["acme", "zest", "bean", "rice", "soup", "mint", "tea", "oat"]
    asked = [(i, " ".join(rng.sample(words, rng.randint(2, 4)))) for i in range(40)]
    entries = [(i, "-".join(rng.sample(words, rng.randint(2, 5)))) for i in range(40)]
    want = {}
    for pid, name in asked:
        q, best = name.split(), None
        for e, s in entries:
            t = s.split("-")
            k = len(set(q) & set(t)) / len(q)
            if k >= 0.6 and (t[0] in q or q[0] in t):
                best = max(best or (0,), (k, -abs(len(t) - len(q)), -e))
        if best:
            want[pid] = (-best[2], best[0])
    got = matching.best_slugs(spark.createDataFrame(asked, "pid long, name string"), spark.createDataFrame(entries, "entry long, slug string"))
    assert want and {r.pid: (r.entry, r.overlap) for r in got.collect()} == want


def test_fold_looks_up_rare_characters_alone(spark):
    """Every character of the basic plane as NFKD has it; long ASCII beside one of several letters costs no look-ups."""
    import time

    def plain(c):
        to = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        return to if not to or any(x.isascii() for x in to) else c

    chars = [chr(c) for c in range(1, 65536) if not 0xD800 <= c < 0xE000]
    rows = [(i, "a" + "b".join(chars[i : i + 64])) for i in range(0, len(chars), 64)]
    got = {r.i: r.t for r in spark.createDataFrame(rows, "i int, t string").select("i", scalars.fold("t").alias("t")).collect()}
    assert got == {i: "a" + "b".join(map(plain, chars[i : i + 64])) for i, _ in rows}
    long = spark.range(2000).select(F.concat(F.repeat(F.lit("abcdefghij"), 200), F.lit("™"), F.col("id").cast("string")).alias("t"))
    start = time.perf_counter()
    assert long.where(scalars.fold("t").contains("jTM")).count() == 2000
    assert time.perf_counter() - start < 10


def test_strip_and_kinds(spark):
    """White space of any script goes at both ends alone; kinds of values by their outermost form, and long lists are read no further than wanted."""
    import time

    from pricewave.sources import variants

    space = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
    rows = [(i, f"{chr(i)}a{chr(i)} b{chr(i)}") for i in range(1, 65536) if not 0xD800 <= i < 0xE000]
    got = spark.createDataFrame(rows, "i int, t string").select("i", scalars.strip("t").alias("t")).collect()
    assert {r.i for r in got if r.t == f"a{chr(r.i)} b"} == set(map(ord, space)) and all(r.t == f"a{chr(r.i)} b" or r.t == f"{chr(r.i)}a{chr(r.i)} b{chr(r.i)}" for r in got)
    values = spark.createDataFrame([(x,) for x in ("{}", '{"a": null}', "[]", "[1, {}]", "null", "1", '"x"', "true")], "t string").select("t", variants.parsed("t").alias("v"))
    kinds = {r.t: (r.o, r.l) for r in values.select("t", variants.is_object(F.col("v")).alias("o"), variants.is_list(F.col("v")).alias("l")).collect()}
    assert {t for t, k in kinds.items() if k[0]} == {"{}", '{"a": null}'} and {t for t, k in kinds.items() if k[1]} == {"[]", "[1, {}]"} and not kinds["null"][0]
    wide = spark.range(200).select(F.col("id").alias("reply"), F.concat(F.lit('{"recipes": [{"title": "t", "pantry": ["'), F.array_join(F.array_repeat(F.repeat(F.lit("a "), 2000), 60), '","'), F.lit('"]}]}')).alias("body"))
    start = time.perf_counter()
    assert bundles.drafted(wide).where("pantry[5] = trim(left(pantry[5], 40))").count() + bundles.drafted(wide).where("size(pantry) = 6").count() >= 200
    assert time.perf_counter() - start < 20


def test_copies_are_searched_once(spark, monkeypatch):
    """Catalogues of many copies: the pairs of classes are as few as those of one copy, all pairs and matches come out."""
    monkeypatch.setattr(matching, "LISTED", 3)
    once = [(i, f"acme{i // 2 % 3} {'rice' if i // 2 % 2 else 'soup'} bean 100g", 100 + i // 2) for i in range(12)]
    many = [(i + 12 * k, name, cents) for k in range(8) for i, name, cents in once]
    sides = lambda rows: [matching.items(spark.createDataFrame(rows, "pid long, name string, cents long")).where(f"pid % 2 = {r}") for r in (0, 1)]
    pairs = lambda rows: sorted((r.a, r.b) for r in matching.candidates(*sides(rows)).collect())
    few = pairs(once)
    assert few and pairs(many) == sorted((a + 12 * k, b + 12 * m) for a, b in few for k in range(8) for m in range(8))
    assert matching.gated_matches(*sides(many)).count() == matching.gated_matches(*sides(once)).count() > 0
    assert {(r.a, r.b): round(r.score, 9) for r in matching.matches(*sides(many)).collect()} == plain_matches(many)


def _match_sides(spark, rows):
    return [matching.items(spark.createDataFrame(rows, "pid long, name string, cents long")).where(f"pid % 2 = {r}") for r in (0, 1)]


def test_matches_of_equal_words_and_far_prices(spark):
    """An item whose equals are turned away by price or size is matched to others, as over all pairs; prices that are fair to all make no classes."""
    rng = random.Random(9)
    names = [" ".join([rng.choice(["acme", "zest"]), *rng.sample(["rice", "soup", "bean", "red", "lemon", "lime"], 2), *rng.choice([["500g"], ["400g"], []])]) for _ in range(14)]
    rows = [(i, rng.choice(names[5 * (i % 2) :][:9]), rng.choice([None, 0, 100, 120, 170, 400])) for i in range(90)]
    got = {(r.a, r.b): round(r.score, 9) for r in matching.matches(*_match_sides(spark, rows)).collect()}
    assert len(got) > 5 and any(score < 1 for score in got.values()) and got == plain_matches(rows)
    alike = [(i, "acme rice 500g", 100 + i) for i in range(20)]
    assert [(r.a, r.b) for r in matching.gated_matches(*_match_sides(spark, alike)).collect()] == [(0, 1)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_items_are_not_broadcast(spark):
    """Written tables are small as files and large as rows: none goes through the driver."""
    rows = [(i, f"acme{i % 3} rice bean {100 + i % 2}g", 100 + i) for i in range(8)]
    assert "SortMergeJoin" in (plan := _plan(matching.gated_matches(*_match_sides(spark, rows)))) and "BroadcastHashJoin" not in plan


def test_pairs_are_not_shuffled(spark):
    """Candidates come out of the join that makes them: nothing is dealt out or counted after it, and no list is broadcast."""
    rows = [(i, f"acme{i % 3} rice bean {100 + i % 2}g", 100 + i) for i in range(8)]
    plan = _plan(matching.candidates(*_match_sides(spark, rows)))
    above = plan[: plan.index("SortMergeJoin")]
    assert "Exchange" not in above and "Aggregate" not in above and "BroadcastHashJoin" not in plan


def test_copies_of_slugs(spark):
    asked = [(k, ("zest bean tea", "bean rice")[k % 2]) for k in range(10)]
    entries = [(k, ("zest-bean", "bean-rice-soup")[k % 2]) for k in range(20, 30)]
    got = matching.best_slugs(spark.createDataFrame(asked, "pid long, name string"), spark.createDataFrame(entries, "entry long, slug string"))
    assert sorted((r.pid, r.entry) for r in got.collect()) == [(k, 20 + k % 2) for k in range(10)]


def test_bundles_equal_a_plain_loop(spark):
    rng = random.Random(7)
    words = ["pasta sauce", "penne", "tortilla", "salsa", "cheddar", "curry", "rice", "naan", "pizza base", "soup", "chocolate", "cup a soup", "ramen", "soy sauce"]
    offers = [(i, f"Brand {rng.choice(words)} {rng.choice(['large', 'small'])}", rng.randint(100, 300)) for i in range(50)]
    used, want, made = set(), [], 0
    for b, bundle in enumerate(bundles.BUNDLES):
        picks = []
        for s, slot in enumerate(bundle.slots):
            fits = [(c, p) for p, n, c in offers if p not in used and not any(j in n.lower() for j in bundles.JUNK) and any(re.search(rf"\b{re.escape(k)}\b", n.lower()) for k in slot.keys) and (slot.raw or not any(d in n.lower() for d in bundles.DECOYS))]
            if fits:
                used.add(min(fits)[1])
                picks.append((b, s, min(fits)[1]))
        if len(picks) < 2:
            used -= {p[2] for p in picks}
        elif made < bundles.MAX_BUNDLES:
            want, made = want + picks, made + 1
    got = bundles.compose(spark.createDataFrame(offers, "product_id long, name string, sale_cents long"))
    assert made > 2 and sorted((r.bundle, r.slot, r.product_id) for r in got.collect()) == want


def test_bundles_validated_and_stale(spark):
    kind = "title string, serves int, instructions string, ingredients array<struct<product_id: string, label: string>>"
    recipes = spark.createDataFrame([("good", 40, "x", [("a", "1"), ("b", "1")]), ("single", 2, "x", [("a", "1")]), ("twice", 2, "x", [("a", "1"), ("a", "2")]), ("unknown", 2, "x", [("a", "1"), ("q", "1")]), ("null", 2, "x", [(None, "1")]), ("empty", 2, "x", [])], kind)
    offers = spark.createDataFrame([("a", 200, 400), ("b", 150, 300)], "product_id string, sale_cents long, regular_cents long")
    assert [tuple(r) for r in bundles.validated(recipes, offers).select("title", "serves", "cost_cents", "regular_cents").collect()] == [("good", 4, 350, 700)]
    assert {r.title for r in bundles.stale(recipes, offers).collect()} == {"unknown", "null"}


def test_upsert_twice_is_once(spark):
    kind = "sku string, name string, category string, regular_price_cents long, image_url string"
    old = spark.createDataFrame([("1", "a", "Milk", 500, "i1"), ("2", "b", "Tea", 100, None)], kind)
    new = spark.createDataFrame([("1", "A", "Uncategorised", 300, None), ("3", "c", "Uncategorised", 7, "i3")], kind)
    once = merge.upsert(old, new, ["sku"], merge.product_rules())
    rows = lambda df: sorted(tuple(r[c] for c in old.columns) for r in df.collect())
    assert rows(once) == [("1", "A", "Milk", 500, "i1"), ("2", "b", "Tea", 100, None), ("3", "c", "Uncategorised", 7, "i3")]
    assert rows(merge.upsert(once, new, ["sku"], merge.product_rules())) == rows(once)


def test_guards(spark):
    rows = [(day("2026-06-10"), 0, 3), (None, 0, 3), (day("2026-06-17"), 0, 0), (None, 1070, 1500), (day("2026-06-10"), 5, None)]
    df = spark.createDataFrame(rows, "db_max date, other bigint, fresh bigint").withColumn("expected", F.lit(TODAY).cast("date"))
    got = [tuple(r) for r in df.select(guards.solo_roll("db_max", "expected", "other"), guards.blocks_new_week("db_max", "expected", "fresh")).collect()]
    assert got == [(True, True), (True, True), (False, False), (False, False), (False, True)]


def test_audit_of_nothing_is_null(spark):
    kind = "id long, is_half boolean, sale_cents long"
    row = digests.audit(spark.createDataFrame([], kind), spark.createDataFrame([], kind)).first()
    assert (row.recall_pct, row.precision_pct, row.price_pct) == (None, None, None)


def test_weekly_counts_and_once_per_key(spark, tmp_path):
    kind = "device string, ts timestamp"
    for n, rows in enumerate([["2026-06-16 23:59:00", "2026-06-17 00:00:00", "2026-06-17 00:00:00"], ["2026-06-23 12:00:00", "2026-06-24 01:00:00"], ["2026-07-20 00:00:00"], ["2026-07-21 00:00:00"], ["2026-08-20 00:00:00"]]):
        spark.createDataFrame([("a" if k else "b", dt.datetime.fromisoformat(r + "+00:00")) for k, r in enumerate(rows)], kind).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    for name, frame in (("weeks", changes.weekly(stream)), ("once", changes.once_per_key(stream, ["device"]))):
        run = frame.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        assert run.awaitTermination(120)
    weeks = {str(r.week_start): r.n for r in spark.table("weeks").collect()}
    assert {w: n for w, n in weeks.items() if w < "2026-07"} == {"2026-06-10": 1, "2026-06-17": 3, "2026-06-24": 1} and weeks.get("2026-07-15", 2) == 2
    once = [(r.device, r.ts.day, r.ts.month) for r in spark.table("once").orderBy("ts").collect()]
    assert len(once) == 3 and {d for d, _, _ in once[:2]} == {"a", "b"} and once[2][2] == 8


def test_dump_and_labels_from_files(spark, tmp_path):
    items = [{"id": "1", "name": " Tea ", "category": "9", "priceHistory": [{"date": "2026-06-10", "price": 3.5}, {"date": "bad", "price": 1}]}, {"id": None, "name": "x", "priceHistory": [{"date": "2026-06-10", "price": "2"}]}, {"id": "3", "name": "No points", "priceHistory": None}]
    with gzip.open(tmp_path / "dump.json.gz", "wt") as f:
        json.dump(items, f)
    (tmp_path / "labels.json").write_text(json.dumps({"9": "Drinks", "10": "Other"}))
    dump = parsers.read_dump(spark, str(tmp_path / "dump.json.gz"))
    assert [(r.id, r.name, [p.cents for p in r.hist]) for r in parsers.usable_items(dump).collect()] == [("1", "Tea", [350])]
    assert {tuple(r) for r in parsers.read_labels(spark, str(tmp_path / "labels.json")).collect()} == {("9", "Drinks"), ("10", "Other")}
    with pytest.raises(ValueError):
        guards.enough_items(dump, 10)


def test_runs_are_written_and_read_again(spark, tmp_path):
    for stamp, rows in (("20260610", [(1, "a")]), ("20260617", [(2, "b"), (3, "c")])):
        parsers.write_run(spark.createDataFrame(rows, "id long, name string"), str(tmp_path), stamp)
    (tmp_path / "one").mkdir()
    for day_, ids in (("0610", [1]), ("0617", [2, 3])):
        (tmp_path / "one" / f"specials_{day_}.json").write_text(json.dumps({"specials": [{"id": i} for i in ids]}, indent=2))
    assert {r.id for r in parsers.newest_specials(spark, str(tmp_path / "one" / "*.json")).collect()} == {2, 3}
    assert {tuple(r) for r in spark.read.json(str(tmp_path / "specials_20260617")).select("id", "name").collect()} == {(2, "b"), (3, "c")}


def test_sync_keeps_other_retailers_and_empty_pulls(spark):
    rows = [(1, "A", "live"), (1, "B", "live"), (2, "A", "live"), (2, "B", "live"), (3, "A", "dump")]
    s = spark.createDataFrame(rows, "product_id long, retailer string, source string").withColumn("week_start", F.lit(TODAY).cast("date"))
    left = lambda kept: sorted(tuple(r)[:3] for r in merge.sync_week(s, spark.createDataFrame(kept, "product_id long"), TODAY, "live", ["A"]).collect())
    assert left([(2,)]) == sorted(set(rows) - {(1, "A", "live")}) and left([]) == sorted(rows)


def test_purge_confirmed(spark):
    t = spark.createDataFrame([(1,), (2,), (2,)], "product_id long")
    gone = spark.createDataFrame([(2,)], "product_id long")
    assert merge.purge({"t": t}, gone)["t"].first().rows == 2 and [r.product_id for r in merge.purge({"t": t}, gone, True)["t"].collect()] == [1]


def test_exit_and_partial_sweeps(spark):
    df = spark.createDataFrame([(0,), (-1,), (5,)], "n int")
    assert [r[0] for r in df.select(guards.exit_code("n")).collect()] == [1, 0, 0]
    s = spark.createDataFrame([("A", "dump")], "retailer string, source string").withColumn("week_start", F.lit(TODAY).cast("date"))
    assert merge.sweep_sources(s, TODAY, "A", "live").count() == 0 and merge.sweep_sources(s, TODAY, "A", "live", partial=True).count() == 1


def test_invariants_of_empty_tables(spark):
    kinds = {
        "specials": "product_id long, retailer string, week_start date, is_half_price boolean, sale_cents long, regular_cents long", "products": "retailer string, sku string, category string", "runs": "source string, status string, run_at timestamp",
        "predictions": "computed_at timestamp", "accuracy": "computed_at timestamp", "links": "kind string", "audits": "retailer string, source string, recall_pct double, measured_at timestamp", "bundles": "week_start date, generated_at timestamp, ingredients array<struct<product_id: long>>",
    }
    got = {r.name: (r.value, r.passed) for r in guards.standard_checks({k: spark.createDataFrame([], v) for k, v in kinds.items()}, TODAY + " 00:00:00").collect()}
    assert len(got) == 20 and got["half_ratio"] == (1.0, True) and got["recall_floor"] == (100.0, True) and got["audit_fresh"] == (0.0, True)
    assert got["predictions_fresh"] == (999.0, False) and got["bundles_fresh_when_live"] == (99.0, True) and got["week_is_current"][1] is False and got["heroes_half_price"] == (0.0, True)


def test_match_full_equals_all_pairs(spark):
    """The one query without SQL, over the driver's names."""
    from pricewave.plans.adapter import catalogue

    sf = "/root/testdata/sf0.01"
    want = plain_matches([(r.pid, r.name, r.cents) for r in catalogue(spark, sf).collect()])
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"match_full"}
    assert {(r.a, r.b): round(r.score, 9) for r in registry.QUERIES["match_full"](spark, sf).collect()} == want and len(want) > 20
