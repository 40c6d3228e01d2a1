"""Column functions: money, weeks, names and quantities. Column in, Column out; no Python workers."""

import sys
import unicodedata
from functools import lru_cache
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

# Fixed values.
STOPWORDS = "the and with of a in for x ml g kg l pk pack packs each ea value multipack".split()
STRICT_VARIANTS = "blue red green black white pink purple gold silver yellow hot mild".split()
SOFT_VARIANTS = (
    "citrus lily lavender rose vanilla chocolate strawberry banana mango berry apple peach mint peppermint "
    "spearmint caramel coffee coconut honey tropical pineapple raspberry blueberry passionfruit grape watermelon "
    "cherry eucalyptus menthol aloe lemon lime orange medium"
).split()
KEYWORD_RULES = (
    ("Ice Cream & Frozen Desserts", ("ice cream", "gelato", "icy pole", "paddle pop")),
    ("Frozen", ("frozen",)),
    ("Savoury Snacks", ("potato chips", "corn chips", "crisps", "popcorn", "pretzel", "doritos", "pringles", "cheezels", "twisties", "burger rings", "grain waves", "rice crackers", "snack mix")),
    ("Confectionery", ("chocolate", "lollies", "gummy", "gummi", "licorice", "liquorice", "candy", "marshmallow", "fudge", "chewing gum")),
    ("Biscuits & Crackers", ("biscuit", "cookie", "cracker", "wafer")),
    ("Soft Drinks", ("soft drink", "cola", "lemonade")),
    ("Energy Drinks", ("energy drink",)),
    ("Juice", ("juice",)),
    ("Yogurt", ("yoghurt", "yogurt")),
    ("Cheese", ("cheese block", "cheese slices", "shredded cheese", "cheese grated")),
    ("Milk", ("milk 1l", "milk 2l", "milk 3l", "long life milk", "uht milk")),
    ("Laundry", ("laundry", "fabric softener", "stain remover")),
    ("Toilet Paper, Tissues & Paper Towels", ("toilet paper", "toilet tissue", "paper towel", "facial tissues")),
    ("Cleaning Goods", ("dishwash", "disinfectant", "bleach", "toilet cleaner", "multipurpose cleaner", "surface spray")),
)
UNCATEGORISED = "Uncategorised"
# How sizes and counts are written in names.
MULTIPACK = r"(\d+)\s*[x×]\s*(\d+(?:\.\d+)?)\s*(g|kg|ml|l)\b"
SIZE = r"(\d+(?:\.\d+)?)\s*(g|kg|ml|l)\b"
# Unicode's white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
COUNT_UNITS = "pk|pack|packs|each|ea|bags?|rolls?|sheets?|capsules?|tablets?|wipes|pods?|loads?|pairs?|serves?"


def strip(text) -> Column:
    """Without white space at both ends, that of any script."""
    return F.btrim(text, F.lit(WHITE))


def cents(price: str | Column) -> Column:
    """Price to whole cents, half to even; null where unparsable, not finite or not positive."""
    c = F.rint((F.col(price) if isinstance(price, str) else price).try_cast("double") * 100)
    return F.when((c > 0) & (c < 9e18), c.cast("bigint"))


def dollars_to_cents(text: str) -> Column:
    """The first amount in a text like "$1,234.50"."""
    amount = F.regexp_extract(text, r"\$?\s*([\d,]+(?:\.\d+)?)", 1)
    return F.rint(F.regexp_replace(amount, ",", "").try_cast("double") * 100).try_cast("bigint")


def percent(text: str, strict: bool = False) -> Column:
    """"50%" to 50; strict takes whole numbers only."""
    bare = F.trim(F.rtrim(F.trim(text), F.lit("%")))
    return bare.try_cast("int") if strict else F.rint(bare.try_cast("double")).try_cast("int")


def hint(text: str) -> Column:
    """"8 weeks ago @ CL" to struct(weeks, retailer); nulls where the text does not start so."""
    pattern = r"(?i)^(\d+)\s+weeks?\s+ago\s+@\s+(CL|WW)"
    side = F.upper(F.regexp_extract(F.trim(text), pattern, 2))
    return F.struct(
        F.regexp_extract(F.trim(text), pattern, 1).try_cast("int").alias("weeks"),
        F.when(side == "CL", "coles").when(side == "WW", "woolworths").alias("retailer"),
    )


def retailer_cell(text: str, exact: bool = False) -> Column:
    t = F.lower(F.trim(text))
    if exact:
        return F.when(t == "coles", "coles").when(t.isin("woolworths", "woolies"), "woolworths")
    return F.when(t.contains("coles"), "coles").when(t.contains("woolworth") | (t == "ww"), "woolworths")


def week_start(day) -> Column:
    """The most recent Wednesday, the day itself included."""
    day = F.col(day) if isinstance(day, str) else day
    return F.date_sub(day, F.pmod(F.weekday(day) - 2, F.lit(7)))


def week_end(day) -> Column:
    return F.date_add(week_start(day), 6)


def discount(now, was) -> Column:
    return F.rint(F.lit(100.0) * (F.lit(1.0) - now / was)).cast("bigint")


def slug(name: str) -> Column:
    return F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))


def image_path(item: str) -> Column:
    return F.concat(F.substring(item, 1, 1), F.lit("/"), F.col(item), F.lit(".jpg"))


def image_url(retailer: str, item: str, sharded: str = "", flat: str = "", flat_retailer: str = "woolworths") -> Column:
    """An item's image by the retailer's layout: in a folder of the id's first character, or in one folder of large images."""
    return F.when(F.col(retailer) == flat_retailer, F.concat(F.lit(f"{flat}/large/"), F.col(item), F.lit(".jpg"))).otherwise(F.concat(F.lit(sharded + "/"), image_path(item)))


def sku_key(sku: str, name: str) -> Column:
    """The stock number, or a key made of the name."""
    return F.coalesce(sku, F.concat(F.lit("stockup:"), F.lower(F.regexp_replace(F.trim(name), r"\s+", " "))))


def keyword_category(name) -> Column:
    """The first rule of which the name holds a keyword, whatever the case."""
    low, out = F.lower(name), None
    for label, keys in KEYWORD_RULES:
        hit = low.rlike("|".join(rf"\Q{k}\E" for k in keys))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(UNCATEGORISED)


def search_query(name: str) -> Column:
    """A catalogue name without bundles, weight ranges, department suffixes and the NEW badge."""
    unit = r"(?:g|kg|ml|l|each|pk|pack)"
    q = F.regexp_replace(name, r"(?is)\s+or\s+.*$", "")
    q = F.regexp_replace(q, rf"(?i)(\d+(?:\.\d+)?\s*{unit})\s*-\s*\d+(?:\.\d+)?\s*{unit}", "$1")
    q = F.regexp_replace(q, r"(?i)\s*[‒-―]\s*(?:from the \w+|assorted|varieties)\b.*$", "")
    return F.trim(F.regexp_replace(q, r"^NEW\s+", ""))


@lru_cache(None)
def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """By Unicode's NFKD without combining marks: characters that become one character or none, and those that become several.

    Only results with an ASCII character matter; all others become a space in the end.
    """
    one, several = {}, {}
    for code in range(128, sys.maxunicode + 1):
        c = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        if unicodedata.combining(c):
            one[c] = ""
            continue
        to = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if to != c and (not to or any(x.isascii() for x in to)):
            (one if len(to) < 2 else several)[c] = to
    return one, several


def fold(text) -> Column:
    """Compatibility forms and marks taken off letters and digits, as NFKD does; other characters are left."""
    one, several = _folds()
    to = sorted(one, key=lambda c: one[c] == "")  # those without a counterpart go
    text = F.col(text) if isinstance(text, str) else text
    plain = F.translate(text, "".join(to), "".join(one[c] for c in to))
    known = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    # Only characters outside ASCII are looked up, as the map is searched from its start.
    each = F.regexp_extract_all(plain, F.lit("[\\x00-\\x7F]+|[^\\x00-\\x7F]"), F.lit(0))
    spread = F.array_join(F.transform(each, lambda c: F.when(c.rlike("^[\\x00-\\x7F]"), c).otherwise(F.coalesce(F.element_at(known, c), c))), "")
    beyond = lambda t: t.rlike("[^\\x00-\\x7F]")
    return F.when(~beyond(text), text).when(beyond(plain), spread).otherwise(plain)


def unescape(text: str) -> Column:
    """HTML's character references written out: named ones of HTML 4, decimal and hexadecimal ones; unknown ones stay."""
    known = ", ".join(f"'{name}', {code}" for name, code in name2codepoint.items())
    code = f"""CASE WHEN p RLIKE '^&#[xX][0-9a-fA-F]{{1,6}};$' THEN CAST(conv(substr(p, 4, length(p) - 4), 16, 10) AS INT)
                    WHEN p RLIKE '^&#[0-9]{{1,7}};$' THEN CAST(substr(p, 3, length(p) - 3) AS INT)
                    WHEN p RLIKE '^&[a-zA-Z0-9]+;$' THEN element_at(map({known}), substr(p, 2, length(p) - 2)) END"""
    shown = f"transform(regexp_extract_all({text}, r'&#?[0-9a-zA-Z]+;|[^&]+|&', 0), p -> coalesce(transform(array({code}), c -> IF(c BETWEEN 1 AND 1114111, decode(unhex(lpad(hex(c), 8, '0')), 'UTF-32'), NULL))[0], p))"
    return F.expr(f"IF(contains({text}, '&'), array_join({shown}, ''), {text})")


def normal_name(name) -> Column:
    bare = F.regexp_replace(F.regexp_replace(fold(F.lower(name)), "&", " and "), "[^a-z0-9.]+", " ")
    return F.trim(F.regexp_replace(bare, " +", " "))


def tokens(normal) -> Column:
    """Distinct words, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(normal, " "), lambda t: t != "")))


def index_tokens(words) -> Column:
    return F.filter(words, lambda t: ~t.isin(STOPWORDS) & ~t.rlike(r"^\d"))


def search_tokens(text, folded: bool = True) -> Column:
    """Distinct words of two letters or more, accents folded unless told otherwise."""
    text = F.col(text) if isinstance(text, str) else text
    bare = F.regexp_replace(F.lower(F.regexp_replace(fold(text), "[^\\x00-\\x7F]", "") if folded else text), r"[^a-z0-9\s]+", " ")
    return F.array_distinct(F.filter(F.split(bare, r"\s+"), lambda t: F.length(t) > 1))


def quantity_signature(normal: str) -> Column:
    """Totals by family as text, like "g:350.0"; "" if none. Multipacks count n times, kilograms and litres a thousand."""
    many, one = MULTIPACK, SIZE
    rest = rf"regexp_replace({normal}, r'{many}', ' ')"
    part = lambda text, pattern, k: f"regexp_extract_all({text}, r'{pattern}', {k})"
    size = "CAST({q} AS DOUBLE) * IF({u} IN ('kg', 'l'), 1000D, 1D)"
    packs = f"zip_with({part(normal, many, 1)}, zip_with({part(normal, many, 2)}, {part(normal, many, 3)}, (q, u) -> struct(q, u)), (n, s) -> struct(IF(s.u IN ('g', 'kg'), 'g', 'ml') AS f, CAST(n AS DOUBLE) * {size.format(q='s.q', u='s.u')} AS v))"
    singles = f"zip_with({part(rest, one, 1)}, {part(rest, one, 2)}, (q, u) -> struct(IF(u IN ('g', 'kg'), 'g', 'ml') AS f, {size.format(q='q', u='u')} AS v))"
    total = lambda f: f"aggregate(filter(concat({packs}, {singles}), x -> x.f = '{f}'), 0D, (a, x) -> a + x.v)"
    shown = lambda f: f"IF({total(f)} > 0, concat('{f}:', CAST(rint({total(f)} * 100) / 100 AS STRING)), NULL)"
    return F.expr(f"concat_ws(' ', {shown('g')}, {shown('ml')})")


def pack_counts(normal: str) -> Column:
    """Sorted pack counts as text."""
    return F.expr(f"array_join(transform(array_sort(transform(regexp_extract_all({normal}, r'(\\d+)\\s*(?:{COUNT_UNITS})\\b', 1), x -> CAST(x AS BIGINT))), x -> CAST(x AS STRING)), ' ')")


def shorten(name) -> Column:
    return F.when(F.length(name) > 40, F.concat(F.substring(name, 1, 39), F.lit("…"))).otherwise(name)


def digest_text(names: str) -> Column:
    """The digest's sentence over an array of names: three at most are listed."""
    n = F.size(names)
    listed = F.array_join(F.transform(F.slice(names, 1, 3), shorten), ", ")
    more = F.when(n > 3, F.concat(F.lit(" + "), (n - 3).cast("string"), F.lit(" more"))).otherwise("")
    head = F.when(n == 1, "1 of your items is").otherwise(F.concat(n.cast("string"), F.lit(" of your items are")))
    return F.concat(head, F.lit(" half-price this week: "), listed, more, F.lit("."))


def absolute_url(href: str, prefix: str) -> Column:
    h = F.col(href)
    return (
        F.when(h.rlike("^https?://"), h)
        .when(h.startswith("//"), F.concat(F.lit("https:"), h))
        .when(h.startswith("/"), F.concat(F.lit(prefix), h))
        .otherwise(F.concat(F.lit(prefix + "/"), h))
    )
