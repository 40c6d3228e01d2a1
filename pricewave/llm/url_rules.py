"""URL allow and block rules by a sort-merge sweep.

A host's labels are reversed, each followed by a dot, so that a host and its
subdomains share a prefix and a rule's host becomes the interval
["com.example.", "com.example/"), "/" following "." in order. Urls and interval
starts are sorted together; a sweep keeps the stack of intervals that hold the
current url, which are nested, and judges the url by their rules' paths.
"""

from bisect import bisect_left, bisect_right, insort

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricewave.llm.common import LOWER, UPPER, partitions

#: About this many keys, chosen by hash, are sampled to cut the key order into ranges.
MAX_SAMPLE = 20_000


def split_url(url):
    """(host, path) columns: after the first :// up to / ? #, A-Z lower-cased; then up to ? or #. Null or no ://: both empty."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def host_key(host):
    """Reversed labels, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _sweep(default):
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])

    def run(batches):
        stack, cell = [], None  # stack: (key prefix, {path: (rule, verdict)}, lengths of the paths), each prefix holding the next
        for batch in batches:
            out = []
            for part, key, page, host, path, rule, verdict, is_rule in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "page_id", "host", "path", "rule", "verdict", "is_rule"))):
                if part != cell:
                    stack, cell = [], part
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if is_rule:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    _, rules, lengths = stack[-1]
                    if len(path) not in lengths:
                        insort(lengths, len(path))
                    if path not in rules or verdict == "block":
                        rules[path] = rule, verdict
                    continue
                # Of one host the longest fitting path is looked up by length, whatever the number of its rules.
                fits = []
                for k, rules, lengths in stack:
                    hit = next((rules[path[:n]] for n in reversed(lengths) if n <= len(path) and path[:n] in rules), None)
                    if hit:
                        fits.append((len(hit[0]), len(k), hit[1] == "block", *hit))
                out.append((page, host, path, *(max(fits)[3:] if fits else (None, default))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", ranges: int | None = None) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict.

    pages has page_id (whole numbers) and url; rules has host, path, verdict
    (allow or block). A rule fits its host and all subdomains if the url's path
    starts with the rule's; the longest rule string wins, block winning over
    allow for equal rules, and without a rule the default holds. Null urls and
    urls without :// have empty host and path and fit no rule, as no rule's host
    is empty; rules with a null or empty host are ignored, a null path being
    empty. Repeated rows are each judged; empty tables give no rows.

    Keys are cut into ranges at quantiles of a bounded sample, which decides the
    layout only. Rows of one key that spans several ranges are spread over them,
    and a rule goes to every range that its interval meets.
    """
    n = ranges or partitions(pages)
    host, path = split_url("url")
    asked = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    asked = asked.withColumn("key", host_key(F.col("host"))).withColumn("spread", F.xxhash64("page_id", "path"))
    given = rules.where("host is not null and host <> ''").select(host_key(F.translate("host", UPPER, LOWER)).alias("key"), F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    one_in = max(1, asked.count() // MAX_SAMPLE)
    sample = sorted(r.key for r in asked.where(F.pmod(F.xxhash64("spread"), F.lit(one_in)) == 0).select("key").collect())
    cuts = [sample[len(sample) * i // n] for i in range(1, n)] if sample else []

    def place(keys, spread):
        low = [bisect_left(cuts, k) for k in keys]
        return [a + s % (bisect_right(cuts, k) - a + 1) for k, a, s in zip(keys, low, spread)]

    @F.pandas_udf("int")
    def part_of(key: pd.Series, spread: pd.Series) -> pd.Series:
        return pd.Series(place(key, spread), dtype="int32")

    @F.pandas_udf("array<int>")
    def parts_of(key: pd.Series) -> pd.Series:
        return pd.Series([list(range(bisect_left(cuts, k), bisect_right(cuts, k[:-1] + "/") + 1)) for k in key])

    left = asked.select(part_of("key", "spread").alias("part"), "key", F.lit(False).alias("is_rule"), "page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    right = given.select(F.explode(parts_of("key")).alias("part"), "key", F.lit(True).alias("is_rule"), F.lit(None).cast("long").alias("page_id"), "host", "path", F.concat("host", "path").alias("rule"), "verdict")
    both = left.union(right).withColumn("late", ~F.col("is_rule"))
    dealt = both.repartitionById(n, F.col("part")).sortWithinPartitions("part", "key", "late")
    return dealt.mapInArrow(_sweep(default), "page_id long, host string, path string, rule string, verdict string")
