"""Ranked search, token files and conversation repair against brute force."""

import glob
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st

from pricewave.llm import chat_repair, ranked_search, token_files
from pricewave.llm.queries import tokenizer_path

WORDS = tokenizer_path("word_bpe_49k.json")
LETTERS = set("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


# Ranked search


def plain_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in LETTERS or ord(c) > 0x7F:
            word += c.lower() if "A" <= c <= "Z" else c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_search(docs, items, k=10):
    found = [(d, plain_terms(t)) for d, t in docs]
    found = [(d, t) for d, t in found if t]
    n_docs, total = len(found), sum(len(t) for _, t in found)
    df = {}
    for _, t in found:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for d, t in found:
            m = 10 + (90 * len(t) * n_docs) // total
            score = 0
            for w in set(plain_terms(text)) & set(t):
                tf = t.count(w)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, 1 << 63 if d is None else d))
        for rank, (score, d) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if d == 1 << 63 else d, -score))
    return out


def ranked(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark, corpus):
    texts = [r["text"] for r in corpus.where("length(text) > 20").orderBy("doc_id").limit(12).collect()]
    rows = [(i, t[:400], "clash") for i, t in enumerate(texts)] + [(50, None, "x"), (51, "", "x"), (52, "!?", "x"), (53, "nowhere-to-be-found", "x")]
    rows += [(54, "Line LINE number É Ümlaut", "x"), (54, "another text of this item, one two", "x"), (55, "one two", "x"), (55, "one two", "x")]
    return spark.createDataFrame(rows, "item_id long, text string, score string")


@pytest.mark.parametrize("size", [5, 4096])
def test_ranked_search(spark, corpus, items, size):
    docs = [(r["doc_id"], r["text"]) for r in corpus.collect()]
    wanted = plain_search(docs, sorted({(r["item_id"], r["text"]) for r in items.collect()}, key=repr))
    got = ranked_search.search(ranked_search.build(corpus, segment_docs=size), items, block_terms=60)
    assert ranked(got) == sorted(wanted, key=repr)


def test_ranked_search_ties_repeats_and_null_ids(spark):
    """40 equal documents: the ten smallest ids, of which one comes twice; rows without an id come last."""
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(3, "same words here"), (None, "same words here"), (None, "better match"), (7, "words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(1, "same words"), (2, "better"), (3, "here")], "item_id long, text string")
    for size in (3, 4096):
        got = ranked_search.search(ranked_search.build(docs, segment_docs=size), items)
        assert ranked(got) == sorted(plain_search(rows, [(1, "same words"), (2, "better"), (3, "here")]), key=repr)


def test_ranked_search_opens_few_ranges(spark):
    """One document in 4000 has the rare words: its ranges are opened, the others are not."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(20)) for _ in range(4000)]
    texts[1234] += " rare words"
    row = ranked_search._segment(list(range(4000)), [len(t.split()) for t in texts], [ranked_search.Counter(ranked_search.terms(t)) for t in texts], 4000, 80002)
    batch = pa.RecordBatch.from_pydict({"top": [ranked_search._packed(row, ranked_search._TOP)], "rest": [ranked_search._packed(row, ranked_search._REST)]})
    held = ranked_search._Items(pa.table({"item": [1] * 3, "item_id": [1] * 3, "term": pa.array([b"rare", b"words", b"a"], pa.binary())}))
    held.weigh({0: 1, 1: 1, 2: 3700}, 4000)
    tree, best, opened = ranked_search._Tree(batch, 0, held.words), ranked_search._Best(1, 1), [0]
    places, weights = held.here(tree, 0)
    ranked_search._search(tree, places, weights, best, opened)
    assert [-d for _, d in best.held] == [1234] and opened == [ranked_search.LEVELS]


def test_ranked_search_of_nothing(spark, corpus, items, nothing):
    assert ranked(ranked_search.search(ranked_search.build(nothing), items)) == []
    assert ranked(ranked_search.search(ranked_search.build(corpus), items.limit(0))) == []
    assert ranked_search.build(nothing).segments.count() == 0


# Token files


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, corpus, library, tmp_path, encoding):
    folder = f"{tmp_path}/t"
    token_files.write_tokens(corpus, folder, WORDS, end_id=2, metadata=("lang", "part", "word"), encoding=encoding, by_word=True, group_bytes=1 << 14, page_bytes=1 << 10, page_rows=4)
    got = token_files.read_tokens(spark, folder, columns=("tokens", "meta")).orderBy("doc_id").collect()
    wanted = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [2] for r in corpus.collect()}
    start = 0
    for r in got:
        assert (r["tokens"], r["start"], r["n_tokens"]) == (wanted[r["doc_id"]], start, len(wanted[r["doc_id"]]))
        assert r["meta"].asDict() == {"lang": "en", "part": 1, "word": "w"}
        start += r["n_tokens"]
    assert len(got) == len(wanted)
    sums = {r["doc_id"]: r["ids_crc32"] for r in token_files.checksums(token_files.read_tokens(spark, folder)).collect()}
    assert sums == {d: zlib.crc32(np.array(ids, "<u4").tobytes()) for d, ids in wanted.items()}
    seen, indexed = set(), True
    for f in glob.glob(f"{folder}/tokens/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            seen |= set(columns["tokens.list.element"].encodings)
            indexed &= columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
            assert "DELTA_BINARY_PACKED" in columns["offset"].encodings
    assert indexed
    assert ("DELTA_BINARY_PACKED" in seen, "RLE_DICTIONARY" in seen) == (encoding == "delta", encoding == "dictionary")


def test_selective_reads(spark, corpus, tmp_path):
    folder = f"{tmp_path}/t"
    token_files.write_tokens(corpus, folder, WORDS, end_id=2, by_word=True)
    few, every = token_files.read_tokens(spark, folder, 5, 9), token_files.read_tokens(spark, folder)
    assert sorted(few.collect()) == sorted(r for r in every.collect() if 5 <= r["doc_id"] <= 9)
    plan = few._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan and "LessThanOrEqual(doc_id,9)" in plan
    scan = token_files.read_metadata(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in scan and "n_tokens" in scan


def test_row_groups(spark, tmp_path):
    """Row groups keep to their size, so that a reader of few documents reads few of them."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat(concat(id, ' word '), 30) AS text").coalesce(1)
    few, many = f"{tmp_path}/few", f"{tmp_path}/many"
    token_files.write_tokens(docs, few, WORDS, by_word=True)
    token_files.write_tokens(docs, many, WORDS, by_word=True, group_bytes=1 << 14)
    count = lambda folder: sum(pq.ParquetFile(f).metadata.num_row_groups for f in glob.glob(f"{folder}/tokens/*.parquet"))
    assert count(many) > 3 * count(few)
    assert token_files.read_tokens(spark, many, 700, 703).count() == 4


def test_token_files_odd_rows(spark, nothing, library, tmp_path):
    rows = [(None, "b a"), (None, None), (4, "x"), (4, "x"), (4, "other"), (1, "<|endoftext|>x <|startoftext|>"), (2, "word " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    token_files.write_tokens(docs, f"{tmp_path}/a", WORDS, end_id=2, by_word=True)
    got = token_files.read_tokens(spark, f"{tmp_path}/a").orderBy("start").collect()
    wanted = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    assert sorted(((r["doc_id"], r["tokens"]) for r in got), key=repr) == sorted(wanted, key=repr)
    assert [r["doc_id"] for r in got] == [None, None, 1, 2, 4, 4, 4]
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]]
    token_files.write_tokens(nothing, f"{tmp_path}/b", WORDS, end_id=2)
    assert token_files.checksums(token_files.read_tokens(spark, f"{tmp_path}/b")).collect() == []
    with pytest.raises(ValueError):
        token_files.write_tokens(docs, f"{tmp_path}/c", WORDS, encoding="plain")


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("ab'sÉé̀‍\xa0\x85\x1c  \t\n.,<|>endoftextİΣς１²"))
def test_ids_by_word(text):
    whole, apart = token_files.encoder(WORDS, False), token_files.encoder(WORDS, True)
    both = pa.array([text, text + " x", "", text])
    assert [x.tolist() for x in apart.ids(both, 2)] == [x.tolist() for x in whole.ids(both, 2)]


def test_words_are_forgotten_and_kept(library, monkeypatch):
    """A worker that may remember few words gives the same ids."""
    monkeypatch.setattr(token_files, "WORDS_HELD", 20)
    rng, enc = random.Random(4), token_files.Encoder(WORDS, True)
    for _ in range(12):
        texts = [" ".join(rng.choice(["the", "of", "don't", "x1,", "Größe!!", "".join(rng.choice("abc") for _ in range(9))]) for _ in range(30)) for _ in range(4)]
        flat, counts = enc.ids(pa.array(texts))
        wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert flat.tolist() == [i for w in wanted for i in w] and counts.tolist() == [len(w) for w in wanted]
    assert len(enc.words) < 200


# Conversation repair


def plain_repair(rows):
    """rows (turn, role, text) in order: the report, audit and lines, by a program over whole strings."""
    seen, best, counts = [], {"": (0, "", [])}, [0, 0, 0]
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
        seen.append((role, text))
        if fault is not None:
            counts[fault] += 1
        now = {}
        for made, (cost, audit, lines) in list(best.items()):
            for added in inserted(made):
                left, c, a, ls = made + added, cost + 3 * len(added), audit + "I" * len(added), lines + [ROLES[x] + ":" for x in added]
                ways = [(left, c + 4, a + "D", ls)]
                if fault not in (0, 1):
                    more = 3 if fault == 2 else 0
                    ways.append((left + (role[:1] or "?"), c + more, a + "K", ls + [role + ":" + text]))
                    ways += [(left + x, c + 3 + more, a + "R", ls + [ROLES[x] + ":" + text]) for x in "ua"]
                for end, c, a, ls in ways:
                    key = norm(end)
                    if key is not None and (key not in now or (c, a) < now[key][:2]):
                        now[key] = (c, a, ls)
        best = now
    ends = [(c + 3 * len(x), a + "I" * len(x), ls + [ROLES[y] + ":" for y in x]) for made, (c, a, ls) in best.items() for x in inserted(made) if norm(made + x) in ("", "sua")]
    cost, audit, lines = min(ends)
    numbers = {t for t, _, _ in rows if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum((a[1][:1], b[1][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip(rows, rows[1:]))
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


ROLES = {"u": "user", "a": "assistant"}


def inserted(made):
    return ["", "u", "a", "ua", "au", "uau", "aua"]


def norm(made):
    """What can follow depends on this only; None if nothing can."""
    for short in ("", "s", "u", "su"):
        if made == short:
            return {"u": "su"}.get(short, short)
    body = made[1:] if made[:1] == "s" else made
    if body.replace("ua", "") not in ("", "u") or "ua" * (len(body) // 2) + "u" * (len(body) % 2) != body:
        return None
    return "su" if len(body) % 2 else "sua"


def conversations(rng, n):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            number = None if rng.random() < 0.05 else t + rng.choice([0, 0, 0, 1])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "unit", None])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t", "Why? ", "x.\n", "other.", None, f"{t}."])
            rows.append((c if c % 17 else None, number, role, text, "clash"))
    return rows


@pytest.mark.parametrize("rows,chars,parts", [(4096, 8 << 20, 3), (2, 8 << 20, 5), (4096, 150, 2)])
def test_repair(spark, rows, chars, parts):
    made = conversations(random.Random(7), 120)
    turns = spark.createDataFrame(made, "conv_id long, turn long, role string, text string, place string").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = chat_repair.digests(chat_repair.repair(turns, rows, chars)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    by_conv = {}
    for c, number, role, text, _ in made:
        by_conv.setdefault(c, []).append((number, " " if role is None else role, " " if text is None else text))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    wanted = {c: plain_repair(sorted(rs, key=order)) for c, rs in by_conv.items()}
    assert len(got) == len(wanted)
    for r in got:
        assert tuple(r)[1:] == wanted[r["conv_id"]], (r["conv_id"], by_conv[r["conv_id"]])


def test_long_conversation(spark):
    """One conversation of 3000 rows is cut into blocks of 100 and equals the whole; its pieces put together are the repaired conversation."""
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{t}!", ""])) for t in range(3000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    pieces = chat_repair.repair(turns, block_rows=100)
    found = pieces.orderBy("piece").collect()
    assert len(found) > 20 and {r["pieces"] for r in found} == {len(found)}
    lines = [t["role"] + ":" + t["text"] for r in found for t in r["turns"]]
    wanted = plain_repair([r[1:] for r in rows])
    assert "".join(r["audit"] for r in found) == wanted[6] and hashlib.sha256("\n".join(lines).encode()).hexdigest() == wanted[7]
    assert [tuple(r)[1:] for r in chat_repair.digests(pieces).collect()] == [wanted]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(10)] + [(None, None, None, None), (1, None, "user", "x.")]
    got = chat_repair.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    wanted = []
    for c, t, role, text in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if role is None else role), (" " if text is None else text)
        text = "" if fault == 1 else text.translate({ord(x): None for x in ".!?"}) if fault == 2 else text
        wanted += [(c, t, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_repair_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_repair.digests(chat_repair.repair(chat_repair.damage(none))).collect() == []
