"""Duplicate operators against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewave.llm import common, exact_dedup, line_dedup, simhash_neardup, substring_dedup

BLANK = " \t\n\x0b\f\r"


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def texts_of(corpus):
    return {r.doc_id: r.text or "" for r in corpus.collect()}


def union(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def plain_fingerprint(text, size):
    import xxhash

    w = [x for x in re.split("[" + BLANK + "]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if x]
    if not w:
        return 0
    hs = [xxhash.xxh64(" ".join(w[i : i + size]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - size + 1))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


@pytest.mark.parametrize("bits", [0, 4, 9])
@pytest.mark.parametrize("hot", [False, True])
def test_near_dups(corpus, monkeypatch, bits, hot):
    if hot:
        monkeypatch.setattr(simhash_neardup, "HOT_BUCKET", 0)
        monkeypatch.setattr(simhash_neardup, "HOT_FACTOR", 0)
        monkeypatch.setattr(simhash_neardup, "BLOCK", 3)
    docs = corpus.where("length(coalesce(text, '')) < 5000")
    text = texts_of(docs)
    fps = {i: plain_fingerprint(t, 4) for i, t in text.items()}
    want = union(sorted(text), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= bits)
    got = rows(simhash_neardup.near_dups(docs, max_bits=bits))
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {i: (f"{fps[i]:016x}", want[i]) for i in text}


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_plan_misses_nothing(bits):
    rng = np.random.default_rng(bits)
    z = rng.integers(0, 2**63, 4000).astype(np.uint64)
    x = np.unpackbits(z.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    parts = simhash_neardup.plan(len(z), (x.T @ x).astype(int), bits)
    assert sum(t + 1 for _, t in parts) == bits + 1
    for _ in range(500):
        flip = set(rng.choice(64, bits, replace=False).tolist())
        assert any(len(flip & set(g)) <= t for g, t in parts)


def test_keep_one(corpus):
    kept = {r.doc_id for r in simhash_neardup.keep_one(corpus).collect()}
    assert 0 in kept and not kept & {1, 2, 3, 4, 8, 13}
    assert set(range(20, 50)) <= kept


def five_words(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def exact_components(texts):
    """By exact five-word Jaccard similarity of all pairs; texts without words are alike."""
    sets = {i: five_words(t) for i, t in texts.items()}
    return union(sorted(texts), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))


@pytest.mark.parametrize("hot", [False, True])
def test_whole_passages_link(spark, monkeypatch, hot):
    """Cut off, added, inserted and moved passages and one-word edits at a similarity of 0.8 or a little more."""
    if hot:
        monkeypatch.setattr(simhash_neardup, "HOT_BUCKET", -9)
        monkeypatch.setattr(simhash_neardup, "SET_BLOCK", 3)
    rng, docs = random.Random(8), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    for k in range(30):
        w = [word() for _ in range(300)]
        new = [word() for _ in range(60)]
        one = [word() if i % 50 == 7 else x for i, x in enumerate(w)]
        docs += [w, (w[:245], w + new, w[:150] + new + w[150:], w[200:] + w[:200], one)[k % 5]]
    texts = {i: " ".join(w) for i, w in enumerate(docs)}
    want = exact_components(texts)
    assert sum(i != c for i, c in want.items()) == 30
    kept = {r.doc_id for r in simhash_neardup.keep_one(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert kept == {i for i, c in want.items() if i == c}


@pytest.mark.parametrize("hot", [False, True])
def test_texts_below_the_threshold_stay(spark, monkeypatch, hot):
    """One-word edits and cut passages at similarities of 0.7 to 0.79, beside chains that link only step by step."""
    if hot:
        monkeypatch.setattr(simhash_neardup, "HOT_BUCKET", -9)
        monkeypatch.setattr(simhash_neardup, "SET_BLOCK", 3)
    rng, docs = random.Random(9), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    for k in range(20):
        w = [word() for _ in range(300)]
        docs += [w, [word() if i % 40 == 7 else x for i, x in enumerate(w)] if k % 2 else w[: 230 + k % 3]]
    w = [word() for _ in range(400)]
    docs += [w[20 * k : 20 * k + 300] for k in range(6)]
    texts = {i: " ".join(w) for i, w in enumerate(docs)}
    want = exact_components(texts)
    assert all(want[i] == i for i in range(40)) and {want[i] for i in range(40, 46)} == {40}
    kept = {r.doc_id for r in simhash_neardup.keep_one(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert kept == set(range(41))


def test_near_stage_searches_by_simhash(spark):
    """Without any band, those link whose fingerprints are at most four bits apart and whose similarity is 0.8 or more."""
    rng, docs = random.Random(10), []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    for k in range(20):
        w = [word() for _ in range(400)]
        docs += [w, [word() if i == 7 or (k % 2 and i % 19 == 7) else x for i, x in enumerate(w)]]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    sets = [simhash_neardup.shingle_set(" ".join(w).encode()) for w in docs]
    fps = [simhash_neardup._majority(h) for h in sets]
    pairs = [(a, b) for a in range(40) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    want = {frozenset(p) for p in pairs if simhash_neardup.jaccard(sets[p[0]], sets[p[1]]) >= 0.8}
    place = F.struct("doc_id", "row").alias("low")
    classes = simhash_neardup.marks_of(frame).select("node", place, "n", "fp", "low_bytes", F.array().cast("array<long>").alias("bands"))
    name = {r.node: r.low.doc_id for r in classes.collect()}
    assert len(want) >= 8 and {frozenset((name[r.u], name[r.v])) for r in simhash_neardup.alike(frame, classes, 0.8).collect()} == want


def counted_cuts(monkeypatch):
    """A list that gets an item for each table that is written in the shared folder."""
    written, real = [], common.cut
    for module in (common, simhash_neardup):
        monkeypatch.setattr(module, "cut", lambda df: written.append(1) or real(df))
    return written


def test_near_stage_writes_few_tables(spark, monkeypatch):
    """Each pair is decided once, whichever search found it, and components are sought once."""
    written = counted_cuts(monkeypatch)
    rng, docs = random.Random(13), []
    for k in range(10):
        w = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(200)]
        docs += [w, ["other" if i == 7 else x for i, x in enumerate(w)]]
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    assert {r.doc_id for r in simhash_neardup.keep_one(frame).collect()} == set(range(0, 20, 2))
    assert len(written) <= 12


def test_components_take_no_round_that_changes_nothing(spark, monkeypatch):
    written = counted_cuts(monkeypatch)
    found = lambda edges: {r.node: r.root for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found([(1, k) for k in range(2, 9)] + [(30, 20), (20, 30), (40, 40)]) == {k: 1 for k in range(2, 9)} | {30: 20}
    assert len(written) == 1
    assert found([(k, k + 1) for k in range(9)]) == {k: 0 for k in range(1, 10)}


def test_exact(corpus):
    text = {i: re.sub("[" + BLANK + "]+", " ", t) for i, t in texts_of(corpus).items()}
    groups = defaultdict(list)
    for i, t in text.items():
        groups[t].append(i)
    got = rows(exact_dedup.groups(corpus))
    assert {i: (r.keep_id, r.group_size, r.kept, r.text_sha256) for i, r in got.items()} == {
        i: (min(groups[t]), len(groups[t]), min(groups[t]) == i, hashlib.sha256(t.encode()).hexdigest()) for i, t in text.items()
    }


def test_exact_with_clashing_fingerprints(corpus, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MEAN_CHUNK", 64)
    one, two = exact_dedup._recipes("keys", exact=True), exact_dedup._recipes("keys")
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "row": [3, 4], "text": ["a b" * 100, "a  b" * 100]})
    assert len(next(one([batch])).column("chunks")[0][0].as_py()) == 48
    assert len(next(two([batch])).column("chunks")[0][0].as_py()) == 16


def test_chunks_follow_content():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 200_000, dtype=np.uint8).tobytes()
    pieces = lambda d: [d[a:b] for a, b in zip([0, *exact_dedup.cuts(d)], exact_dedup.cuts(d))]
    assert b"".join(pieces(data)) == data
    assert len(set(pieces(data)) & set(pieces(b"inserted" + data))) > 0.9 * len(pieces(data))


def test_lines(corpus):
    text = texts_of(corpus)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))
    held = defaultdict(set)
    for i, t in text.items():
        for line in t.split("\n"):
            held[key(line)].add(i)
    got = rows(line_dedup.drop_lines(corpus))
    for i, t in text.items():
        lines = t.split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(held[key(x)]) < 2 or min(held[key(x)]) == i]
        assert (got[i].kept, got[i].n_lines, got[i].n_dropped) == ("\n".join(kept), len(lines), len(lines) - len(kept)), i
    assert len(got) == len(text)


@pytest.mark.parametrize("sample", [1, 32])
def test_repeats(corpus, monkeypatch, sample):
    monkeypatch.setattr(substring_dedup, "SAMPLE", sample)
    text = texts_of(corpus)
    seen, gone = {}, defaultdict(set)
    for i in sorted(text):
        w = text[i].encode().split()
        for s in range(len(w) - 19):
            k = b" ".join(w[s : s + 20])
            if k in seen:
                gone[i].update(range(s, s + 20))
            seen.setdefault(k, i)
    got = rows(substring_dedup.drop_repeats(corpus))
    for i, t in text.items():
        w = t.encode().split()
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone[i])
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), len(gone[i]), hashlib.sha256(kept).hexdigest()), i
    assert sum(map(len, gone.values())) > 500


def test_repeats_of_ids_with_other_texts(spark):
    """Rows that share a doc_id are told apart: a text unlike all others loses nothing, and a shared passage stays in one of them."""
    rng = random.Random(11)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    a, b, shared = text(50), text(40), text(30)
    given = [(1, a), (2, a), (2, b), (3, text(25) + " " + shared), (3, shared + " " + text(25)), (None, shared), (4, shared), (4, shared)]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in given], "doc_id long, text string, tag int, lo int, spans int").repartition(3)
    got = substring_dedup.drop_repeats(docs).collect()
    assert len(got) == len(given)
    removed = sorted(((r.doc_id or 0), r.n_words, r.n_removed) for r in got)
    assert removed == [(0, 30, 0), (1, 50, 0), (2, 40, 0), (2, 50, 50), (3, 55, 0), (3, 55, 30), (4, 30, 30), (4, 30, 30)]
    assert next(r.kept for r in got if r.n_words == 40) == b


def test_repeated_rows_and_null_ids(corpus):
    twice = corpus.union(corpus.where("doc_id < 3")).union(corpus.where("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long")))
    n = twice.count()
    for found in (exact_dedup.groups(twice), line_dedup.drop_lines(twice), substring_dedup.drop_repeats(twice), simhash_neardup.near_dups(twice)):
        assert found.count() == n
    assert exact_dedup.groups(twice).where("doc_id is null").first().keep_id == 0
    assert simhash_neardup.keep_one(twice).where("doc_id is null").count() == 0


def test_stages_judge_rows(spark):
    """Repeated and null ids: rows, not ids, are dropped; of equal rows one stays."""
    rng = random.Random(21)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    same, other, rep, alone = (text() for _ in range(4))
    edited = same.replace(same.split()[30], "changed")
    given = [(1, same), (5, same), (5, other), (None, same), (None, alone), (7, rep), (7, rep), (7, rep.replace(" ", "  ")), (8, ""), (9, None), (None, None), (6, edited)]
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumn("row", F.lit("clash")).withColumn("keep", F.lit(1)).repartition(3)
    exact = exact_dedup.keep_first(docs)
    assert exact.columns == docs.columns
    flat = lambda df: sorted(((r.doc_id, " ".join((r.text or "").split())) for r in df.collect()), key=str)
    want = sorted([(1, same), (5, other), (None, alone), (7, rep), (8, ""), (6, edited)], key=str)
    assert flat(exact) == want
    near = simhash_neardup.keep_one(docs)
    assert near.columns == docs.columns and flat(near) == [x for x in want if x[0] != 6]
    assert flat(simhash_neardup.keep_one(exact)) == flat(near)


def test_empty(nothing):
    for found in (exact_dedup.groups(nothing), line_dedup.drop_lines(nothing), substring_dedup.drop_repeats(nothing), simhash_neardup.near_dups(nothing), simhash_neardup.keep_one(nothing), exact_dedup.keep_first(nothing)):
        assert found.count() == 0
