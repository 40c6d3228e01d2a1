"""Bundles of complementary half-price items, filled slot by slot."""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewave.functions import scalars
from pricewave.sources import variants

# Words that rule a name out, decoys of ingredient slots, and the bundles' slots in order.
JUNK = (
    "month", "baby", "infant", "toddler", " cat ", "cat ", " dog", "puppy", "kitten", " pet ", "treat", "wipe", "sponge", "deodorant", "shampoo",
    "soap", "cleaner", "detergent", "laundr", "popcorn", " chip", "chip ", "lolli", "biscuit", "candy", "dishwash", "toilet", "tissue", "litter",
    "formula", "rusk", "teether", "cordial", "soft drink", "energy drink", "chocolate", "lip ", "razor", "vitamin", "supplement", "moistur",
    "shapes", "cracker", "crisp", "snack", "muesli bar", "chips",
)
DECOYS = (
    "cup a soup", "cup-a-soup", "cup a pasta", "cup-a-pasta", "cup noodle", "cup soup", "cup", "noodle", "ramen", "instant", "suimin", "sachet",
    "soup", "seasoning", "stock", "flavour", "flavoured", "recipe base", "2 minute", "2-minute", "tempters", "serves", "popper",
)


@dataclass(frozen=True)
class Slot:
    keys: tuple[str, ...]
    label: str
    raw: bool = False


@dataclass(frozen=True)
class Bundle:
    title: str
    slots: tuple[Slot, ...]


CHEESE = Slot(("parmesan", "mozzarella", "tasty cheese", "cheese block", "shredded cheese", "grated cheese", "cheddar", "pizza cheese"), "1 block")
BUNDLES = (
    Bundle("Pasta night", (
        Slot(("pasta sauce", "passata", "napoletana", "bolognese sauce", "arrabbiata", "marinara", "tomato & herb"), "1 jar"),
        Slot(("spaghetti", "penne", "fusilli", "macaroni", "lasagne", "rigatoni", "spirals", "pasta 500"), "1 pack"), CHEESE)),
    Bundle("Mexican night", (
        Slot(("tortilla", "wrap", "taco shell", "taco kit"), "1 pack"),
        Slot(("salsa", "mexican", "burrito", "taco sauce", "enchilada", "chipotle", "guacamole"), "1 jar"), CHEESE)),
    Bundle("Curry night", (
        Slot(("curry", "butter chicken", "massaman", "korma", "tikka", "rogan", "simmer sauce", "dahl", "dal makhani"), "1 jar"),
        Slot(("rice", "basmati", "jasmine rice", "microwave rice"), "1 pack"),
        Slot(("pappadum", "naan", "roti", "paratha"), "1 pack"))),
    Bundle("Stir-fry night", (
        Slot(("stir fry", "stir-fry", "pad thai", "satay sauce", "teriyaki sauce", "honey soy", "oyster sauce", "kecap"), "1 bottle"),
        Slot(("hokkien", "udon", "egg noodle", "rice noodle", "basmati", "jasmine rice"), "1 pack", True))),
    Bundle("Creamy pasta bake", (
        Slot(("pasta & sauce", "pasta and sauce", "pasta bake", "mac & cheese", "macc & chees", "spaghetti bowl", "carbonara", "alfredo"), "1 pack"), CHEESE)),
    Bundle("Pizza night", (
        Slot(("pizza base", "pizza", "flatbread", "naan"), "1 pack"),
        Slot(("pizza sauce", "pasta sauce", "passata", "tomato paste", "napoletana"), "1 jar"), CHEESE)),
    Bundle("Noodle bowl", (
        Slot(("ramen", "laksa", "tom yum", "hokkien noodle", "udon", "soba", "pad thai"), "2 packs", True),
        Slot(("soy sauce", "kecap", "oyster sauce", "satay sauce", "sesame oil", "chilli oil"), "1 bottle"))),
    Bundle("Soup & cheesy toast", (
        Slot(("pumpkin soup", "minestrone", "tomato soup", "chicken soup", "vegetable soup", "soup"), "1 tub", True),
        Slot(("sourdough", "baguette", "ciabatta", "turkish bread", "bread roll", "dinner roll"), "1 loaf"), CHEESE)),
)
#: Words that make an offer part of a meal beside the slots' own.
MEAL_WORDS = ("sauce", "noodle", "pasta", "rice", "curry", "soup", "beans", "tomato", "coconut", "stock", "gravy", "wrap", "tortilla", "cheese")
MAX_BUNDLES, MIN_ITEMS, MENU = 6, 2, 45


def is_junk(name: str) -> Column:
    return F.lower(name).rlike("|".join(rf"\Q{j}\E" for j in JUNK))


def slot_match(name: str, slot: Slot) -> Column:
    """A keyword at word boundaries; unless the slot is raw, no decoy in the name."""
    low = F.lower(name)
    hit = low.rlike(r"\b(?:" + "|".join(re.escape(k) for k in slot.keys) + r")\b")
    return hit if slot.raw else hit & ~low.rlike("|".join(rf"\Q{d}\E" for d in DECOYS))


def slot_candidates(offers: DataFrame, bundles=BUNDLES) -> DataFrame:
    """(bundle, slot, product_id, sale_cents, rank): for each slot its cheapest matches.

    A product is used once over all bundles, so a slot can lose at most as many
    candidates as there are slots: that many of the cheapest are enough, and a
    fixed bound on what the choice below reads.
    """
    slots = [(b, s, slot) for b, bundle in enumerate(bundles) for s, slot in enumerate(bundle.slots)]
    flags = F.array(*[F.when(slot_match("name", slot), F.struct(F.lit(b).alias("bundle"), F.lit(s).alias("slot"))) for b, s, slot in slots])
    pairs = offers.where(~is_junk("name")).select("product_id", "sale_cents", F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("x")).select("x.*", "product_id", "sale_cents")
    rank = F.row_number().over(Window.partitionBy("bundle", "slot").orderBy("sale_cents", "product_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= len(slots))


def compose(offers: DataFrame, bundles=BUNDLES, limit: int = MAX_BUNDLES) -> DataFrame:
    """(bundle, title, slot, product_id, label): bundles in order, slots in order, the cheapest unused match each.

    A bundle with fewer than two filled slots gives its picks back. The choice
    is sequential over at most (slots)^2 candidate rows, which one task takes.
    """
    found = slot_candidates(offers, bundles)

    def choose(pdf):
        import pandas as pd

        used, out, made = set(), [], 0
        for b, bundle in enumerate(bundles):
            picks = []
            for s, slot in enumerate(bundle.slots):
                at = pdf[(pdf.bundle == b) & (pdf.slot == s)].sort_values("rank")
                free = [p for p in at.product_id if p not in used]
                if free:
                    used.add(free[0])
                    picks.append((b, bundle.title, s, free[0], slot.label))
            if len(picks) < MIN_ITEMS:
                used.difference_update(p[3] for p in picks)
                continue
            out += picks
            made += 1
            if made == limit:
                break
        return pd.DataFrame(out, columns=["bundle", "title", "slot", "product_id", "label"])

    kind = offers.schema["product_id"].dataType.simpleString()
    return found.groupBy().applyInPandas(choose, f"bundle int, title string, slot int, product_id {kind}, label string")


def menu(offers: DataFrame, bundles=BUNDLES, limit: int = MENU) -> DataFrame:
    """The cheapest offers that read like a meal's parts, as many as the feature lists."""
    words = dict.fromkeys([k for b in bundles for slot in b.slots for k in slot.keys] + list(MEAL_WORDS))
    return offers.where(F.lower("name").rlike("|".join(rf"\Q{w}\E" for w in words))).orderBy("sale_cents", "product_id").limit(limit)


def _entries(value: Column, n: int, size: int) -> Column:
    """The first n entries of a list as texts of that size; the characters of a text, the names in an object, none of nothing."""
    each = F.when(variants.is_list(value), F.transform(F.slice(variants.elements(value), 1, n), variants.written))
    each = each.when(variants.is_text(value), F.filter(F.split(variants.text(value), ""), lambda c: c != ""))
    each = each.when(variants.is_object(value), F.map_keys(F.try_variant_get(value, "$", "map<string, variant>")))
    return F.transform(F.slice(F.coalesce(each, F.array().cast("array<string>")), 1, n), lambda x: F.left(scalars.strip(x), F.lit(size)))


def drafted(replies: DataFrame, body: str = "body") -> DataFrame:
    """(reply, pos, title, serves, ingredients, pantry, instructions, tags) of the drafts in replies (reply, body) of a model.

    Replies that are no JSON give none, and entries that are no objects are left
    out. Servings are whole numbers, fractions cut off; a text must hold a whole
    number, and nothing or zero is 4. A draft with other servings, or with a
    number in place of a list, is left out; missing lists are empty. Titles keep 80 characters,
    pantries 6 entries of 40, tags 5 of 20. A null that stands for a text reads "None".
    """
    listed = variants.elements(variants.member(variants.parsed(body), "recipes"))
    each = replies.select("reply", F.posexplode(listed).alias("pos", "r")).where(variants.is_object(F.col("r")))
    m = lambda c: variants.member(F.col("r"), c)
    said = lambda c: F.when(variants.kind(m(c)).isNull(), "").otherwise(scalars.strip(variants.written(m(c))))
    whole = scalars.strip(variants.text(m("serves")))
    serves = (
        F.when(variants.kind(m("serves")).isNull() | ~variants.filled(m("serves")), 4)
        .when(variants.is_number(m("serves")), variants.number(m("serves")).try_cast("int"))
        .when(variants.is_text(m("serves")) & whole.rlike(r"^[+-]?\d+$"), whole.try_cast("int"))
        .when(variants.kind(m("serves")) == "BOOLEAN", 1)
    )
    no_list = lambda c: variants.filled(m(c)) & (variants.is_number(m(c)) | (variants.kind(m(c)) == "BOOLEAN"))
    objects = F.filter(F.coalesce(variants.elements(m("ingredients")), F.expr("CAST(array() AS ARRAY<VARIANT>)")), variants.is_object)
    text = lambda v, c: variants.text(variants.member(v, c)).alias(c)
    items = F.transform(objects, lambda v: F.struct(text(v, "product_id"), text(v, "label")))
    good = each.where(~(F.coalesce(no_list("ingredients"), F.lit(False)) | F.coalesce(no_list("pantry"), F.lit(False)) | F.coalesce(no_list("tags"), F.lit(False))))
    return good.select(
        "reply", "pos", F.left(said("title"), F.lit(80)).alias("title"), serves.alias("serves"), items.alias("ingredients"), _entries(m("pantry"), 6, 40).alias("pantry"),
        said("instructions").alias("instructions"), _entries(m("tags"), 5, 20).alias("tags"),
    ).where("serves IS NOT NULL")


def validated(recipes: DataFrame, offers: DataFrame, keys: tuple[str, ...] = ("title",)) -> DataFrame:
    """(keys, title, serves, items, cost_cents, regular_cents, labels, pantry): ids resolved and distinct, two items at least, serves 1 to 12 else 4.

    keys tell recipes apart. Labels keep 40 characters, in the order of the
    ingredients; a pantry keeps 6 entries of 40. Without title, instructions or
    ingredients a recipe is left out.
    """
    by = [k for k in dict.fromkeys([*keys, "title", "serves"])]
    pantry = F.slice(F.transform(F.coalesce("pantry", F.expr("CAST(array() AS ARRAY<STRING>)")), lambda x: F.substring(F.trim(x), 1, 40)), 1, 6) if "pantry" in recipes.columns else F.expr("CAST(array() AS ARRAY<STRING>)")
    items = recipes.where("title <> '' AND instructions <> ''").select(*by, pantry.alias("pantry"), F.posexplode("ingredients").alias("_pos", "i")).select(*by, "pantry", "_pos", F.col("i.product_id").alias("product_id"), F.substring(F.trim(F.coalesce("i.label", F.lit(""))), 1, 40).alias("label"))
    first = items.groupBy(*by, "product_id").agg(F.min(F.struct("_pos", "label", "pantry")).alias("m")).select(*by, "product_id", "m.*")
    sums = first.join(offers.select("product_id", "sale_cents", "regular_cents"), "product_id").groupBy(*by).agg(
        F.count("*").alias("items"), F.sum("sale_cents").alias("cost_cents"), F.sum("regular_cents").alias("regular_cents"),
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "label"))), lambda x: x["label"]).alias("labels"), F.first("pantry").alias("pantry"),
    )
    return sums.where(F.col("items") >= MIN_ITEMS).withColumn("serves", F.when(F.col("serves").between(1, 12), F.col("serves")).otherwise(4))


def stale(recipes: DataFrame, offers: DataFrame) -> DataFrame:
    """(title, missing): recipes with a hero that is no longer on offer; a null id is missing, an empty list is not stale."""
    heroes = recipes.select("title", F.explode("ingredients").alias("i")).select("title", F.col("i.product_id").alias("product_id"))
    gone = heroes.join(offers.select("product_id").distinct(), "product_id", "left_anti")
    return gone.groupBy("title").agg(F.count("*").alias("missing"))
