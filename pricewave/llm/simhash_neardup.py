"""Near duplicates by SimHash, found with a generalised pigeonhole search.

The 64 bits are split into parts of correlated bits. With thresholds t_i whose
sum of (t_i + 1) is max_bits + 1, two fingerprints within max_bits agree to
within t_i on some part i, so probing every part's values with up to t_i bits
flipped finds every link. Part count and thresholds come from a dynamic program
over estimated candidate counts.

Documents alike in their five-word shingles are found by the same search on the
fingerprints of their shingle sets; bands of MinHashes find those that it leaves
apart. All are decided by the exact Jaccard similarity of their shingle sets.
"""

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pricewave.llm.common import ASCII_LOWER, arrow_rows, components, cut, keyed, once, rows_in, texts

BITS = 64
#: A bucket with more fingerprints than the first and so many times the mean is compared in cells of blocks.
HOT_BUCKET, HOT_FACTOR = 16, 4
BLOCK = 2048
#: Blocks of shingle sets are smaller, as each set is long and each comparison dear.
SET_BLOCK = 512
#: Checking a candidate pair costs this much of shuffling a probe row.
CHECK_COST = 0.05
#: MinHashes of a shingle set: of two sets with similarity 0.8, some band of rows agrees in all but 2 of 10,000 cases.
BANDS, BAND_ROWS = 16, 4
#: Pairs of hot buckets that agree in fewer MinHashes are not compared further; at similarity 0.8 the mean is 51, the deviation 3.
MIN_EQUAL = 32
#: A block of a hot bucket holds about this many shingles at most.
BLOCK_SHINGLES = 1 << 21


def _grams(raw: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles of a text, A-Z lower-cased; fewer words: of all of them; none: none."""
    w = raw.translate(ASCII_LOWER).split()
    if not w:
        return np.zeros(0, np.uint64)
    n = max(1, len(w) - size + 1)
    return np.fromiter((xxhash.xxh64_intdigest(b" ".join(w[i : i + size]), 42) for i in range(n)), dtype=np.uint64, count=n)


def _majority(h: np.ndarray) -> int:
    """Bits set in over half of the hashes; 0 without any."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 65536):
        ones += np.unpackbits(h[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprint(text: str | bytes | None, shingle: int = 4) -> int:
    """Bit majority over the hashes of the word shingles, repeats included; 0 without words."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    return _majority(_grams(raw, shingle))


def shingle_set(raw: bytes, shingle: int = 5) -> np.ndarray:
    """The distinct hashes of the word shingles, in order."""
    return np.unique(_grams(raw, shingle))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)


_SALTS = _mixed(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]


def min_hashes(h: np.ndarray) -> np.ndarray:
    """The least of the set's hashes under each of the rehashes; of no set at all, the greatest number."""
    out = np.full(len(_SALTS), 2**64 - 1, np.uint64)
    for i in range(0, len(h), 4096):
        out = np.minimum(out, _mixed(h[None, i : i + 4096] ^ _SALTS).min(axis=1))
    return out


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) for each row of docs; fp is the fingerprint as a signed long."""
    rows = texts(docs)
    key = rows.schema["doc_id"].dataType.simpleString()
    out = pa.schema([("doc_id", {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[key]), ("fp", pa.int64())])

    def make(batch):
        fps = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column("text")], dtype=np.uint64)
        return [batch.column("doc_id"), fps.view(np.int64)]

    return rows.mapInArrow(arrow_rows(make, out), f"doc_id {key}, fp long")


def marks_of(docs: DataFrame) -> DataFrame:
    """(doc_id, row, node, n, fp, low_bytes, bands): node tells shingle sets apart, n is the set's size, fp its fingerprint; low_bytes and bands come from its MinHashes."""
    fields = [("doc_id", pa.int64()), ("row", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("low_bytes", pa.binary()), ("bands", pa.list_(pa.int64()))]
    out = pa.schema(fields)

    def make(batch):
        cols = ([], [], [], [], [])
        for t in batch.column("text"):
            h = shingle_set(t.as_buffer().to_pybytes())
            m = min_hashes(h)
            keys = m.reshape(BANDS, BAND_ROWS)
            key = keys[:, 0]
            for k in range(1, BAND_ROWS):
                key = _mixed(key) + keys[:, k]
            for c, v in zip(cols, (_node(h), len(h), _signed(_majority(h)), m.astype(np.uint8).tobytes(), key.view(np.int64).tolist() if len(h) else [])):
                c.append(v)
        return [batch.column("doc_id"), batch.column("row"), *cols]

    return keyed(docs).mapInArrow(arrow_rows(make, out), "doc_id long, row long, node long, n long, fp long, low_bytes binary, bands array<long>")


def _node(h: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(h.tobytes()))


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, low_bytes, hs): the shingle sets of nodes (node, low, low_bytes), computed anew from the rows that low names."""
    out = pa.schema([("node", pa.int64()), ("low_bytes", pa.binary()), ("hs", pa.list_(pa.int64()))])

    def make(batch):
        found = [shingle_set(t.as_buffer().to_pybytes()) for t in batch.column("text")]
        own = [i for i, (h, node) in enumerate(zip(found, batch.column("node").to_pylist())) if _node(h) == node]
        return [*(batch.column(c).take(pa.array(own, pa.int64())) for c in ("node", "low_bytes")), [found[i].view(np.int64) for i in own]]

    rows, named = keyed(docs), nodes.select("node", "low_bytes", F.col("low.doc_id").alias("_id"), F.col("low.row").alias("_row"))
    rows = rows.join(named, rows["doc_id"].eqNullSafe(named["_id"]) & (rows["row"] == named["_row"])).select("node", "low_bytes", "text")
    return rows.mapInArrow(arrow_rows(make, out), "node long, low_bytes binary, hs array<long>").dropDuplicates(["node"])


def bit_pairs(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Over all fingerprints: their number, and how often each two bits are both set."""

    def partial(batches):
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for b in batches:
            x = np.unpackbits(b["fp"].to_numpy().astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n, both = n + len(x), both + np.rint(x.T @ x).astype(np.int64)
        yield pd.DataFrame({"n": [n], "both": [both.ravel().tolist()]})

    parts = fps.select("fp").mapInPandas(partial, "n long, both array<long>")
    sums = parts.select("n", F.posexplode("both").alias("i", "x")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    both = np.zeros(BITS * BITS, np.int64)
    for r in sums:
        both[r["i"]] = r["x"]
    return (sums[0]["n"] if sums else 0), both.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Parts of equal size; each starts at the freest bit and takes the bits most correlated with it."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    free, groups = set(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups))) // (parts - k)
        group = [min(free, key=lambda b: (abs(p[b] - 0.5), b))]
        free.remove(group[0])
        while len(group) < size:
            b = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(b)
            free.remove(b)
        groups.append(sorted(group))
    return groups


def plan(n: int, both: np.ndarray, max_bits: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of least estimated cost: probe rows plus candidate pairs.

    The chance that two fingerprints differ in at most t bits of a part is taken
    from the bits' own frequencies; the dynamic program shares max_bits + 1
    among the parts, a share of 0 meaning that a part is not probed.
    """
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    best = None
    for m in range(1, max_bits + 2):
        groups = group_bits(n, both, m)
        costs = []
        for g in groups:
            at = np.zeros(max_bits + 1)
            at[0] = 1
            for b in g:
                at[1:] = at[1:] * (1 - differ[b]) + at[:-1] * differ[b]
                at[0] *= 1 - differ[b]
            probes = np.cumsum([comb(len(g), t) for t in range(max_bits + 1)])
            costs.append([0.0] + [max(n, 1) * probes[t] + CHECK_COST * n * n * at[: t + 1].sum() for t in range(max_bits + 1)])
        table = {0: (0.0, [])}
        for cost in costs:
            table = {
                total: min((c + cost[s], shares + [s]) for was, (c, shares) in table.items() for s in [total - was] if 0 <= s < len(cost))
                for total in range(max_bits + 2)
            }
        cost, shares = table[max_bits + 1]
        if best is None or cost < best[0]:
            best = (cost, [(g, s - 1) for g, s in zip(groups, shares) if s])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(part: int, key, flips: list[int]):
    return F.transform(F.array(*[F.lit(f).cast("long") for f in flips]), lambda f: F.struct(F.lit(part).alias("part"), key.bitwiseXOR(f).alias("key")))


def links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """(u, v) edges, some more than once, that connect exactly the nodes linked by at most max_bits differing bits of fp.

    nodes is (node, fp), node a unique long. Ordinary buckets
    give each of their links; hot ones are compared in cells of bounded blocks,
    of which each gives a spanning forest of its links.
    """
    n, both = bit_pairs(nodes)
    index, probe, limits = [], [], []
    for i, (bits, t) in enumerate(plan(n, both, max_bits)):
        limits.append(F.lit(HOT_BUCKET + HOT_FACTOR * n // (1 << len(bits))))
        key = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in bits))).cast("long"))
        flips = [_signed(sum(1 << b for b in c)) for k in range(t + 1) for c in combinations(bits, k)]
        index.append(_keys(i, key, [0]))
        probe.append(_keys(i, key, flips))
    spread = lambda arrays, name: nodes.select(F.col("node").alias(name), F.col("fp").alias(name + "_fp"), F.explode(F.concat(*arrays)).alias("k")).select(name, name + "_fp", "k.part", "k.key")
    index, probe = spread(index, "u"), spread(probe, "v")
    hot = cut(index.groupBy("part", "key").count().where(F.col("count") > F.get(F.array(*limits), F.col("part"))))
    any_hot = not hot.isEmpty()
    near = F.bit_count(F.col("u_fp").bitwiseXOR(F.col("v_fp"))) <= max_bits
    cool = lambda df: df.join(hot.select("part", "key"), ["part", "key"], "left_anti") if any_hot else df
    found = cool(index).join(cool(probe), ["part", "key"]).where((F.col("u") < F.col("v")) & near).select("u", "v")
    if not any_hot:
        return found
    # Of a hot bucket, block b of the index rows meets block c of the probes.
    sized = lambda df: df.join(hot, ["part", "key"]).withColumn("n", F.ceil(F.col("count") / BLOCK).cast("int"))
    block = lambda c: F.pmod(F.xxhash64(c), F.col("n")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    left, right = sized(index), sized(probe)
    left = left.select("part", "key", block("u").alias("b"), every.alias("c"), F.col("u").alias("node"), F.col("u_fp").alias("fp"), F.lit(True).alias("indexed"))
    right = right.select("part", "key", every.alias("b"), block("v").alias("c"), F.col("v").alias("node"), F.col("v_fp").alias("fp"), F.lit(False).alias("indexed"))
    forest = left.union(right).groupBy("part", "key", "b", "c").applyInPandas(lambda cell: _forest(cell, max_bits), "u long, v long")
    return found.union(forest)


def _forest(cell: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Edges from each node of a cell to the root of its component under the cell's links."""
    a, b = cell[cell.indexed].drop_duplicates("node"), cell[~cell.indexed].drop_duplicates("node")
    x, y = (s.fp.to_numpy(np.int64).view(np.uint64) for s in (a, b))
    p, q = a.node.to_numpy(np.int64), b.node.to_numpy(np.int64)
    root: dict[int, int] = {}

    def find(k):
        while root.setdefault(k, k) != k:
            root[k] = k = root[root[k]]
        return k

    for i in range(0, len(x), 256):
        at, to = np.nonzero(np.bitwise_count(x[i : i + 256, None] ^ y[None, :]) <= max_bits)
        for u, v in zip(p[i + at].tolist(), q[to].tolist()):
            u, v = find(u), find(v)
            root[max(u, v)] = min(u, v)
    pairs = np.array([(k, find(k)) for k in list(root) if find(k) != k], dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})


def near_dups(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z only and cut into words at ASCII white space.
    Fingerprints at max_bits or fewer differing bits are linked; component_id is
    the smallest doc_id reachable over links, the document itself included.
    Null and empty texts and texts without words have fingerprint zero and are
    linked like any other. A null doc_id is never a component_id unless its
    component holds no other id. Repeated rows each give a row; an empty table
    gives none.
    """
    fps = cut(fingerprints(docs, shingle))
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(links(classes.select(F.col("fp").alias("node"), "fp"), max_bits))
    placed = classes.join(roots, classes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = cut(placed.groupBy("root").agg(F.min("low").alias("component_id")))  # the join can then split a large component
    named = placed.join(lows, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fps.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def alike(docs: DataFrame, classes: DataFrame, least: float, max_bits: int = 4) -> DataFrame:
    """(u, v) edges, some more than once, that connect the nodes of classes (node, low, n, fp, low_bytes, bands) whose shingle sets have a Jaccard similarity of least or more.

    Candidates are the links of the fingerprints, at most max_bits apart, and,
    beyond these, nodes that agree in a band; each pair is decided once. Pairs of
    ordinary buckets are all decided. In a hot bucket each node is decided
    against the least one; only those that are not linked to it meet the whole
    bucket, in cells of bounded blocks.
    """
    close = links(classes.where("n > 0").select("node", "fp"), max_bits).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    index = classes.select("node", "n", F.posexplode("bands").alias("part", "key"))
    counts = index.groupBy("part", "key").agg(F.count("*").alias("count"), F.sum("n").alias("total"), F.min("node").alias("pivot")).where("count > 1")
    counts = cut(counts)  # the join can then split a hot bucket
    held = cut(index.join(counts, ["part", "key"]))
    is_hot = F.col("count") > HOT_BUCKET + HOT_FACTOR
    cool, hot = held.where(~is_hot), held.where(is_hot)
    side = lambda df, name: df.select("part", "key", F.col("node").alias(name), F.col("n").alias(name + "_n"))
    pairs = side(cool, "u").join(side(cool, "v"), ["part", "key"]).where("u < v").where(F.least("u_n", "v_n") >= least * F.greatest("u_n", "v_n")).select("u", "v")
    stars = hot.where("node <> pivot").select(F.col("pivot").alias("u"), F.col("node").alias("v"))
    pairs = cut(close.union(pairs).union(stars).distinct())
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = cut(sets_of(docs, classes.join(ends, "node", "left_semi")))
    whole = lambda name: sets.select(F.col("node").alias(name), F.col("hs").alias(name + "_hs"))
    both = F.size(F.array_intersect("u_hs", "v_hs"))
    linked = cut(pairs.join(whole("u"), "u").join(whole("v"), "v").where(both >= least * (F.size("u_hs") + F.size("v_hs") - both)).select("u", "v"))
    rest = cut(hot.where("node <> pivot").join(linked.select(F.col("u").alias("pivot"), F.col("v").alias("node")), ["pivot", "node"], "left_anti"))
    if rest.isEmpty():
        return linked
    # Block b of the rest of a bucket meets block c of the whole bucket.
    blocks = lambda count, total: F.greatest(F.ceil(F.col(count) / SET_BLOCK), F.ceil(F.col(total) / BLOCK_SHINGLES)).cast("int")
    over = cut(rest.groupBy("part", "key").agg(F.count("*").alias("few"), F.sum("n").alias("few_total")))
    home = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sized = lambda df: df.join(over, ["part", "key"]).withColumn("nb", blocks("few", "few_total")).withColumn("nc", blocks("count", "total")).join(sets, "node")
    left = sized(rest).select("part", "key", home("nb").alias("b"), every("nc").alias("c"), "node", "low_bytes", "hs", F.lit(True).alias("asked"))
    right = sized(hot).select("part", "key", every("nb").alias("b"), home("nc").alias("c"), "node", "low_bytes", "hs", F.lit(False).alias("asked"))
    return linked.union(left.union(right).groupBy("part", "key", "b", "c").applyInPandas(lambda cell: _spanning(cell, least), "u long, v long"))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sets in order, not both empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def _spanning(cell: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links between the asked nodes of a cell and its others; those between nodes already connected are left out."""
    asked, others = cell[cell.asked], cell[~cell.asked]
    bytes_of = lambda df: np.frombuffer(b"".join(df.low_bytes), np.uint8).reshape(len(df), -1)
    (x, y), (xs, ys) = ((bytes_of(asked), bytes_of(others)), (asked.hs.tolist(), others.hs.tolist()))
    names, at = np.unique(np.concatenate([asked.node.to_numpy(np.int64), others.node.to_numpy(np.int64)]), return_inverse=True)
    p, q, label = at[: len(x)], at[len(x) :], np.arange(len(names))
    size, edges = np.array([len(h) for h in ys], np.int64), []
    for i in range(len(x)):
        n = len(xs[i])
        fit = (np.minimum(size, n) >= least * np.maximum(size, n)) & (label[q] != label[p[i]])
        equal = np.where(fit, (y == x[i]).sum(axis=1), 0)
        left = np.flatnonzero(equal >= MIN_EQUAL)
        left = left[np.argsort(-equal[left], kind="stable")]
        while len(left):
            k, left = left[0], left[1:]
            if jaccard(xs[i], ys[k]) >= least:
                edges.append((names[p[i]], names[q[k]]))
                label[label == label[q[k]]] = label[p[i]]
                left = left[label[q[left]] != label[p[i]]]
    pairs = np.array(edges, dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})


def similar_groups(docs: DataFrame, least: float = 0.8, max_bits: int = 4) -> tuple[DataFrame, DataFrame]:
    """(doc_id, row, keep_id) of the rows that share a component with another that stays, and (doc_id, row) of those that occur more than once.

    Texts are linked when the Jaccard similarity of their sets of five-word
    shingles is least or more; it is computed for each candidate pair. Candidates
    are linked by their SimHash fingerprints, at most max_bits apart, or, where
    that leaves them apart, agree in a band of MinHashes, which depends on the
    similarity alone and not on where the edits lie. Equal sets always link. Of a component the row with
    the smallest doc_id stays, rows without an id coming last and, of rows that
    repeat an id, the one whose text has the least hash; ids are whole numbers.
    """
    marks = cut(marks_of(docs))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    classes = cut(marks.groupBy("node").agg(F.min(place).alias("low"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("low_bytes").alias("low_bytes"), F.first("bands").alias("bands")))
    roots = components(alike(docs, classes, least, max_bits))
    placed = classes.join(roots, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lows = cut(placed.groupBy("root").agg(F.min("low").alias("keep")))  # the join can then split a large component
    named = placed.join(lows, "root").select("node", "keep")
    lost = marks.join(named, "node").where(place != F.col("keep")).select("doc_id", "row", F.col("keep.doc_id").alias("keep_id"))
    return lost, cut(marks.groupBy("doc_id", "row").count().where("count > 1").select("doc_id", "row"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs that stay when of each group of similar texts one row with the smallest doc_id is kept; columns unchanged."""
    lost, repeated = similar_groups(docs, **how)
    return once(rows_in(docs, lost, "left_anti"), repeated)
