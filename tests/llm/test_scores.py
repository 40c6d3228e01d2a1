"""Classifier, decontamination, licences, packing, chats and url rules."""

import random
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewave.llm import chat_template as chat, decontaminate, license_scan, pack_dp, quality_fm, url_rules
from pricewave.llm.queries import URL_RULES, tokenizer_path


def test_machine_equals_pairwise_sum():
    rng = np.random.default_rng(1)
    m = quality_fm.Machine(rank=4)
    m.w, m.b = rng.normal(size=quality_fm.SIZE), 0.3
    rows = [(rng.choice(quality_fm.SIZE, 6, replace=False), rng.normal(size=6)) for _ in range(3)]
    for (idx, val), got in zip(rows, m.margins(rows)[0]):
        pairs = sum(m.v[idx[i]] @ m.v[idx[j]] * val[i] * val[j] for i in range(6) for j in range(i))
        assert got == pytest.approx(0.3 + m.w[idx] @ val + pairs)


def test_classifier_learns_and_scores_all(spark, corpus, nothing):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    docs = [(i, " ".join(word() + ("###" if i % 4 == 0 else "") for _ in range(40))) for i in range(400)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    machine = quality_fm.fit(d, labels)
    got = quality_fm.score(d, machine).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 400 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert sum(r.predicted == (r.doc_id % 4 != 0) for r in held) > 0.97 * len(held)
    assert quality_fm.keep_good(d, machine).count() == sum(r.predicted for r in got)
    edge = quality_fm.score(corpus, machine).collect()
    assert len(edge) == corpus.count() and all(0 <= r.score <= 1 for r in edge)
    assert quality_fm.score(nothing, quality_fm.fit(nothing, labels)).count() == 0


def test_held_out_labels(spark):
    """Figures on the driver's labelled rows that are never fitted on: area under the curve, and accuracy."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_fm.score(docs, quality_fm.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert len(good) > 30 and len(bad) > 10
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) > 0.97 * len(good) * len(bad)
    assert sum(r.predicted == r.quality for r in scored) > 0.93 * len(scored)
    assert quality_fm.score(docs.unionByName(docs.limit(9)), quality_fm.fit(docs.unionByName(docs), labels)).count() == docs.count() + 9


def plain_align(item, passage):
    best, h = (0, 0), [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if item[i - 1] == passage[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, (h[i][j], -j))
    return best[0]


def test_align():
    rng = random.Random(2)
    for _ in range(200):
        item, passage = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        score, start, end = decontaminate.align(item, passage)
        assert score == plain_align(item, passage)
        assert score == plain_align(item, passage[start:end])


@pytest.mark.parametrize("shipped", [True, False])
def test_decontaminate(spark, nothing, monkeypatch, shipped):
    if not shipped:
        monkeypatch.setattr(decontaminate, "MAX_SHIPPED_GRAMS", 0)
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_PAIRS", 0)
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choice("aeioulmn") for _ in range(5)) for _ in range(n))
    items = [text(30) for _ in range(5)]
    edited = items[1].split()
    edited[4], edited[12] = "changed", "also"
    del edited[20]
    docs = [(0, text(200)), (1, text(50) + " " + items[0].upper() + ", " + text(40)), (2, text(90) + " " + " ".join(edited) + " end"), (3, None), (4, ""), (5, text(300) + " " + items[2]), (6, " ".join(items[3].split()[:8]) + " " + text(100)), (None, items[0])]
    d = spark.createDataFrame(docs + [docs[1]], "doc_id long, text string")
    b = spark.createDataFrame([*enumerate(items), (9, None), (10, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(d, b).collect()}
    assert set(got) == {(1, 0), (2, 1), (5, 2)}
    assert got[1, 0].score == 1.0 and (got[1, 0].start, got[1, 0].end) == (50, 80) and 0.8 < got[2, 1].score < 1
    assert {r.doc_id for r in decontaminate.clean(d, b).collect()} == {0, 3, 4, 6}  # the row without an id is item 0
    assert decontaminate.matches(nothing, b).count() == 0 and decontaminate.matches(d, nothing.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_copies_do_not_choose_seeds(spark):
    """Exact and edited copies of the same items, against alignment of all pairs."""
    rng = random.Random(6)
    text = lambda n: [rng.choice("aeiou") + "".join(rng.choice("aeioulmn") for _ in range(5)) for _ in range(n)]
    items = [text(36) for _ in range(4)]
    docs = [text(60) + text(40) for _ in range(5)]
    for k, item in enumerate(items):
        docs += [text(20) + item + text(20)] * (1, 1, 1, 5)[k]
        broken = [f"new{i}" if i in range(3, 36, 7 - k % 3) else w for i, w in enumerate(item)]
        docs += [text(30) + broken + text(10)] * (1, 1, 1, 3)[k]
        docs.append(text(30) + item[:5] + text(10))
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(docs)], "doc_id long, text string")
    b = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = {(i, j): s for i, t in enumerate(docs) for j, item in enumerate(items) if (s := plain_align(item, t) / (2 * len(item))) >= 0.5}
    assert len(want) == 14
    assert {(r.doc_id, r.item_id): r.score for r in decontaminate.matches(d, b).collect()} == pytest.approx(want)
    assert {r.doc_id for r in decontaminate.clean(d, b).collect()} == set(range(len(docs))) - {i for i, _ in want}


@pytest.mark.parametrize("own", [14, 26])
def test_phrases_that_items_share(spark, own):
    """Items of a common phrase and words of their own, repeated items, and copies, edited copies and the phrase alone, against alignment of all pairs."""
    rng = random.Random(14)
    text = lambda n: [rng.choice("aeiou") + "".join(rng.choice("aeioulmn") for _ in range(5)) for _ in range(n)]
    phrase = text(20)
    items = [phrase + text(own) for _ in range(12)]
    items += [items[0], items[0]]
    docs = [text(10) + phrase + text(10), text(60), text(8) + items[3] + text(8), items[0], items[5][10:] + text(5)]
    docs += [text(8) + [f"new{i}" if i in range(k, 99, 7) else w for i, w in enumerate(items[k])] + text(8) for k in range(6)]
    want = {(i, j): s for i, t in enumerate(docs) for j, item in enumerate(items) if (s := plain_align(item, t) / (2 * len(item))) >= 0.5}
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(docs)], "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    b = spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id long, text string").withColumn("doc_id", F.lit(5))
    assert {(r.doc_id, r.item_id): r.score for r in decontaminate.matches(d, b).collect()} == pytest.approx(want)


def test_long_texts_are_aligned_in_pieces(spark, monkeypatch):
    """A text whose copies lie beyond one piece, by the shuffled plan too."""
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_PLACES", 0)
    rng = random.Random(15)
    text = lambda n: [rng.choice("aeiou") + "".join(rng.choice("aeioulmn") for _ in range(4)) for _ in range(n)]
    item = text(30)
    # Seeds of the item all along make one long region; its best copy comes last.
    long = [w for _ in range(400) for w in item[:5] + text(12)] + item + text(50)
    d = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(text(9000)))], "doc_id long, text string")
    got = decontaminate.matches(d, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.score, r.start, r.end) for r in got] == [(1, 7, 1.0, 6800, 6830)]


def test_licences(spark, nothing):
    apache, gpl = "Licensed under the Apache License, Version 2.0.", "This work is licensed under the GNU General Public License, version 3."
    files = [("a/LICENSE", "x\n" + apache), ("a/b/f.txt", "words and the license of all"), ("a/b/COPYING", gpl), ("a/c/f.txt", None), ("d/f.txt", "prose"), ("d/g.txt", gpl.lower()), ("f.txt", ""), (None, apache), ("a/b/c/d/e.txt", "deep"), ("a/LICENSE", "x\n" + apache)]
    got = {r.path: r for r in license_scan.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert {p: (r.licence, r.source, r.distance) for p, r in got.items()} == {
        "a/LICENSE": ("Apache-2.0", "a/LICENSE", 0), "a/b/f.txt": ("GPL-3.0", "a/b/COPYING", 0), "a/b/COPYING": ("GPL-3.0", "a/b/COPYING", 0), "a/c/f.txt": ("Apache-2.0", "a/LICENSE", 1),
        "d/f.txt": (None, None, None), "d/g.txt": ("GPL-3.0", "d/g.txt", 0), "f.txt": (None, None, None), None: ("Apache-2.0", None, 0), "a/b/c/d/e.txt": ("GPL-3.0", "a/b/COPYING", 2),
    }
    assert license_scan.scan(nothing.select(F.lit("p").alias("path"), "text")).count() == 0


def test_encoder_equals_tokenizers(corpus):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    enc, _ = pack_dp.encoder(tokenizer_path())
    tricky = ["", " ", "a  b", "it's we'LL 12,3\n\n x\t", "é ñ   日本語 😀", "\x1c\x85 end "]
    for text in [r.text or "" for r in corpus.where("doc_id < 40").collect()] + tricky:
        assert pack_dp._encode(enc, text).tolist() == t.encode(text, add_special_tokens=False).ids, text[:80]


def test_wrapped_headers(spark):
    """Usual headers, wrapped and commented, above code."""
    head = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    kinds = {"GPL-2.0": ("program", ";", "General Public License", "2"), "GPL-3.0": ("program", ":", "General Public License", "3"), "LGPL-3.0": ("library", ":", "Lesser General Public License", "3"), "AGPL-3.0": ("program", ":", "Affero General Public License", "3")}
    files = [(f"{name}/{k}", "\n".join([mark + " Copyright 2020 A B", mark, *(f"{mark} {x}" for x in textwrap.wrap(head.format(*kind), 60)), "import words", "x = other + things", "", "def more(code):", "    return code"])) for name, kind in kinds.items() for k, mark in enumerate(["#", "//", " *"])]
    got = license_scan.scan(spark.createDataFrame(files + [(f"p/{i}", f"prose {i} of\nmany words") for i in range(50)], "path string, text string")).collect()
    assert {r.path: r.own for r in got if r.path[0] != "p"} == {p: p.split("/")[0] for p, _ in files}
    assert not any(r.own for r in got if r.path[0] == "p")


def test_versions_are_told_apart(spark):
    """Texts and headers of licences that share most of their wording, and lines that only mention one."""
    L = license_scan
    wrap = lambda text, mark: "\n".join(f"{mark} {x}" for x in textwrap.wrap(text, 64))
    gnu = lambda name, rest: next((L._GNU.format(thing=t, mark=m, kind=k, version=v, either=", either") + rest * (" " + L._GNU_REST.format(thing=t, kind=k)) for n, t, m, k, v in L._GNU_KINDS if n == name))
    own = "Copyright (c) 2011, Some Person. All rights reserved.\n\n"
    given = {"MIT": own + L._MIT + "\n\n" + L._AS_IS, "ISC": own + L._ISC + "\n\n" + L._ISC_AS_IS, "BSD-2-Clause": own + L._BSD + "\n" + L._BSD_TWO + "\n\n" + L._BSD_AS_IS, "BSD-3-Clause": own + L._BSD + "\n" + L._BSD_TWO + "\n" + L._BSD_THREE + "\n\n" + L._BSD_AS_IS}
    given |= {name: gnu(name, True) for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")}
    given |= {"Apache-2.0": L._APACHE + " " + L._APACHE_REST, "MPL-2.0": L._MPL + " " + L._MPL_REST}
    given |= {"0BSD": own + L._ZERO_BSD + "\n\n" + L._ISC_AS_IS, "Zlib": own + L._ZLIB + "\n\n" + L._ZLIB_REST, "BSL-1.0": L._BOOST + "\n\n" + L._BOOST_REST + "\n\n" + L._AS_IS}
    given |= {"BSD-4-Clause": own + L._BSD + "\n" + L._BSD_TWO + "\n" + L._BSD_FOUR + "\n\n" + L._BSD_AS_IS, "EPL-2.0": L._ECLIPSE}
    code = "\n\nimport words\nx = other + things\n\ndef more(code):\n    return code\n"
    files = [(f"{name}/{k}", text) for name, whole in given.items() for k, text in enumerate([whole, wrap(whole, "#") + code, wrap(whole, " *") + code, f"// SPDX-License-Identifier: {name}" + code])]
    files += [(f"{name}/short", wrap(gnu(name, False), "//") + code) for name in given if "GPL" in name]
    files += [(f"none/{k}", t) for k, t in enumerate(["This file is not licensed under the MIT License.", "Not licensed under the Apache License, Version 2.0.", "words on a licence that is fine", L._AS_IS])]
    files += [
        ("Apache-2.0/full", "\n      Apache License\n   Version 2.0, January 2004\n  http://www.apache.org/licenses/\n\n  TERMS AND CONDITIONS FOR USE\n\n many other words\n"),
        ("GPL-3.0/full", "   GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n Everyone is permitted to copy words of this document\n"),
        ("LGPL-3.0/full", "   GNU LESSER GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n Everyone is permitted to copy words of this document\n"),
        ("Apache-2.0 OR MIT/a", "Licensed under either of Apache License, Version 2.0 or MIT license at your option." + code),
        ("Apache-2.0 OR MIT/b", "// Dual licensed under the MIT license and the Apache License, Version 2.0" + code),
        ("Apache-2.0 OR MIT/c", "# SPDX-License-Identifier: MIT OR Apache-2.0" + code),
        ("GPL-2.0 OR MIT/a", "Dual licensed under the MIT license and the GNU General Public License, version 2." + code),
    ]
    files += [("BSD/line", L._BSD + code)] + [(f"p/{i}", f"prose {i} of\nmany words and the rest of a line") for i in range(80)]
    got = {r.path: r.own for r in license_scan.scan(spark.createDataFrame(files, "path string, text string").withColumn("licence", F.lit("clash"))).collect()}
    assert {p: o for p, o in got.items() if p.split("/")[0] != o} == {p: None for p, _ in files if p[:2] in ("no", "p/")}


def test_cosines_and_ties(spark):
    """Cosines against plain vectors; tied templates and tied licence files of a folder."""
    rng = random.Random(13)
    vocabulary = [f"w{i}" for i in range(30)]
    templates = [(f"L{k}", " ".join(rng.choices(vocabulary, k=8))) for k in range(6)]
    templates += [("tie", templates[2][1])]
    units = [" ".join(rng.choices(vocabulary + ["unseen", "other"], k=rng.randint(1, 12))) for _ in range(300)]
    frequency = {t: sum(t in u.split() for u in units) for t in vocabulary}
    index = license_scan.Index(templates, frequency, len(units))

    def vector(text):
        held = {t for _, x in templates for t in x.split()}
        return {t: text.split().count(t) * (np.log((1 + len(units)) / (1 + frequency[t])) + 1e-6 if t in held else np.log(1 + len(units))) for t in set(text.split())}

    def cosine(a, b):
        return sum(x * b.get(t, 0) for t, x in a.items()) / np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    for u in units:
        scores = [cosine(vector(u), vector(t)) for _, t in templates]
        for threshold in (0.0, 0.4, 0.7):
            got = index.best(u, threshold)
            if got is None:
                assert max(scores) < max(threshold, 1e-9)
            else:
                assert got[1] == pytest.approx(max(scores)) and got[2] == templates[int(np.argmax(np.round(scores, 9)))][0]
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Licensed under the MIT License."
    files = [("d/LICENSE-b", mit), ("d/LICENSE-a", mit), ("d/e/f.txt", "x"), ("g/f.txt", "long " * 200000), ("/LICENSE", apache), ("/h/i", None)]
    got = {r.path: (r.licence, r.source, r.distance) for r in license_scan.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    assert got["d/e/f.txt"] == ("MIT", "d/LICENSE-a", 1) and got["/h/i"] == ("Apache-2.0", "/LICENSE", 1)


def test_added_tokens_as_loaded(spark):
    """Texts that quote an added token, against the tokenizer as loaded."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    end = "<|endoftext|>"
    quoted = [end, f"a {end} b", f"{end}{end}", f"one.  {end}  two\n", f"<|endof{end}text|>", f"É {end}x 12,3", "<|endoftext| >"]
    got = pack_dp.pack(spark.createDataFrame(list(enumerate(quoted)), "doc_id long, text string"), tokenizer_path(), with_ids=True).collect()
    for i, text in enumerate(quoted):
        mine = [x for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start) for x in r.ids]
        assert mine == [*t.encode(text, add_special_tokens=False).ids, 0], text


def test_choose_is_optimal():
    rng = random.Random(5)
    for _ in range(200):
        size, places = rng.randint(3, 8), []
        at = 0
        while len(places) < 7:
            at += rng.randint(1, min(size, 4))
            places.append(at)
        costs = [rng.choice([0.0, 1.0, 6.0]) for _ in places]
        ends = pack_dp.choose(at, np.array(places), np.array(costs), size)

        def cost(ends):
            if any(b - a > size for a, b in zip([0, *ends], ends)):
                return float("inf")
            return sum(costs[places.index(b)] + size - (b - a) for a, b in zip([0, *ends[:-1]], ends[:-1]))

        best = min(cost([p for k, p in enumerate(places[:-1]) if mask >> k & 1] + [at]) for mask in range(64))
        assert cost(ends) == pytest.approx(best)


def test_pack_round_trip(corpus, nothing):
    got = pack_dp.pack(corpus, tokenizer_path(), size=64, with_ids=True).toPandas()
    enc, _ = pack_dp.encoder(tokenizer_path())
    for r in corpus.collect():
        mine = got[got.doc_id == r.doc_id].sort_values("start")
        assert [i for ids in mine.ids for i in ids] == [*pack_dp._encode(enc, r.text or "").tolist(), 0]
        assert all(zlib.crc32(np.array(x.ids, "<u4").tobytes()) == x.ids_crc32 for x in mine.itertuples())
    sizes = got.groupby("sequence_id").length.sum()
    assert sizes.max() <= 64
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]]
    padding = sum(64 - n for n in sizes if n & (n - 1))
    assert padding < 0.02 * sizes.sum()
    assert pack_dp.pack(nothing, tokenizer_path()).count() == 0


def test_pack_stretches(spark):
    """Documents longer than a stretch, repeated rows and null ids; and the exact program over one stretch against choose()."""
    rng = random.Random(16)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) + rng.choice(["", "", "."]) for _ in range(n))
    docs = [(1, prose(400)), (2, prose(30)), (2, prose(20)), (3, prose(10)), (3, None), (None, prose(15)), (4, prose(90))]
    docs += [docs[3]]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("start", F.lit("clash")).coalesce(1)
    enc, is_end = pack_dp.encoder(tokenizer_path())
    whole = sorted(str([*pack_dp._encode(enc, t or "").tolist(), 0]) for _, t in docs)
    for how in ({"stretch": 100}, {"stretch": 1 << 40, "every": 1}):
        got = pack_dp.pack(d, tokenizer_path(), size=64, with_ids=True, **how).toPandas()
        pieces = got.sort_values(["sequence_id", "offset"])
        joined, held = [], []
        for r in pieces.itertuples():
            held += list(r.ids)
            if r.start + r.length == r.doc_tokens:
                joined.append(str(held))
                held = []
        assert sorted(joined) == whole and not held
        assert got.groupby("sequence_id").length.sum().max() <= 64
    for _, part in pieces.groupby(pieces.sequence_id // (1 << 40)):
        ids = np.concatenate([np.array(x) for x in part.ids])
        kind = np.where(is_end[ids], pack_dp.SENTENCE_CUT, pack_dp.HARD_CUT)
        kind[np.flatnonzero((part.start + part.length == part.doc_tokens).to_numpy()).tolist() and (part.length.cumsum()[(part.start + part.length == part.doc_tokens)] - 1).to_numpy()] = pack_dp.DOC_CUT
        ends = pack_dp.choose(len(ids), np.arange(1, len(ids) + 1), kind, 64)
        mine = part.groupby("sequence_id").length.sum().cumsum().tolist()
        assert mine[: len(ends) - 1] == ends[:-1]


def render(source, **names):
    parts = []
    chat.compile_template(source)(lambda t, masked: parts.append((t, masked)), **names)
    return "".join(t for t, _ in parts), "".join(t for t, m in parts if m)


def test_template_language():
    assert render("{% for x in xs %}{{ loop.index }}{{ x.a | upper }}{% if not loop.last %},{% endif %}{% endfor %}", xs=[{"a": "p"}, {"a": "q"}])[0] == "1P,2Q"
    branches = "{% if a == 1 and b %}x{% elif b or a > 2 %}y{% else %}z{% endif %}"
    assert [render(branches, a=a, b=b)[0] for a, b in ((3, None), (1, True), (1, False))] == ["y", "x", "z"]
    assert render("a{% generation %}{{ 'b' ~ 1 + 1 }}{% endgeneration %}c") == ("ab2c", "b2")
    assert chat.fold(chat.parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}no{% else %}d{% endif %}")) == [("text", "abcd")]
    assert render("{{ m.__class__ }}|{{ m['x'] }}", m={"x": 1})[0] == "|1"
    assert render("a{# note {{ x }} #}b")[0] == "ab" and render("a \n{%- if true -%} \n b {{- ' c ' -}} d{% endif %}")[0] == "ab c d"
    assert render("{{ '}}' }}{% if '%}' == x %}y{% endif %}", x="%}")[0] == "}}y"
    assert render("{% set a = 'p' %}{% for x in xs %}{% set b = x ~ a %}{{ b }}{% endfor %}{{ b }}|{{ xs[1:] | length }}{{ 'word'[:-2] }}", xs=["q", "r"])[0] == "qprp|1wo"
    assert render("{{ 'y' if a is defined and b is not defined else 'n' }}{{ 'z' if c not in 'abc' }}", a=1, c="q")[0] == "yz"
    assert render("{% for x in xs %}{% if loop.index0 % 2 == 1 %}{{ x }}{% endif %}{% endfor %}{% if\n a\n%}k{% endif %}", xs="abcd", a=1)[0] == "bdk"
    assert render("{% for m in messages %}{% if m['role'] == 'user' %}{{ '<|u|>' + m['content'].text | trim }}{% else %}{{ m['content'] }}{% endif %}{% endfor %}{% if add %}{{ '<|a|>' }}{% endif %}", messages=[{"role": "user", "content": {"text": " hi "}}, {"role": "assistant", "content": None}], add=True)[0] == "<|u|>hi<|a|>"
    for wrong in ("{{ none | upper }}", "{{ 1 + 'a' }}", "{{ x | trim }}", "{{ x < 'a' }}", "{{ 5[1:] }}", "{{ 'a' * 9 }}", "{% for y in 5 %}{% endfor %}", "{{ 1 % 0 }}"):
        with pytest.raises(chat.TemplateError):
            render(wrong, x=3)
    for bad in ("{% for x %}{% endfor %}", "{{ 1 is odd }}", "{% set a %}", "{{ x[ }}", "{{ x | eval }}", "{% if a %}", "{{ f(1) }}", "{% import os %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)


def test_guard_round_trip():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choice(["<", "[", "\\", "/", "s>", "INST]", "<s>", "</s>", "[INST]", "x", "\n"]) for _ in range(8))
        assert chat.unguard(chat.guard(text)) == text and chat.many_lines(chat.one_line(text)) == text
        assert not any(c in chat.guard(text) for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_chats(spark):
    rows = [(1, 0, "system", "be"), (1, 1, "user", None), (1, 2, "assistant", "</s><s>user\n[INST] x"), (2, 0, None, "a"), (2, 0, "assistant", ""), (2, 0, "assistant", "é😀"), (None, 0, "user", "n"), (None, None, "assistant", "m"), (3, 5, "odd\nrole<s>", "t")]
    said = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(said).collect()
    assert len(out) == 5
    by = {r.conv_id: r for r in out if r.conv_id is not None}
    assert chat.read_turns(by[1].formatted) == [("system", "be"), ("user", ""), ("assistant", "</s><s>user\n[INST] x")]
    assert chat.read_turns(by[2].formatted) == [("", "a"), ("assistant", ""), ("assistant", "é😀")]
    assert chat.read_turns(by[3].formatted) == [("odd\nrole<s>", "t")]
    assert [chat.unguard(by[1].formatted[s.start : s.end]) for s in by[1].spans] == ["</s><s>user\n[INST] x"]
    assert chat.format_chats(said.where("false")).count() == 0 and chat.digests(chat.format_chats(said)).count() == 5


def test_url_rules(spark):
    rng = random.Random(7)
    labels = ["com", "net", "example", "www", "a", "co-m", "EXAMPLE"]
    urls = [f"{rng.choice(['http', 'https'])}://{'.'.join(rng.choice(labels) for _ in range(rng.randint(1, 4)))}{rng.choice(['', '/', '/en/', '/en/x', '/es/y?q=/en/', '/fr/z#f', '?x', '#y'])}" for _ in range(400)] + [None, "", "no scheme", "://", "http://example.com/en/://x"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string")
    rules = [*URL_RULES, ("example.com", "/", "block"), (None, "/", "block"), ("", "/", "block"), ("a.com", None, "block")]
    given = spark.createDataFrame(rules, "host string, path string, verdict string")

    def plain(url):
        at = (url or "").find("://")
        rest = url[at + 3 :] if at >= 0 else ""
        end = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
        fits = [(len(h + (p or "")), len(h), h + (p or ""), v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
        best = max(fits, default=None)
        return (host, path, best[2], best[3]) if best else (host, path, None, "allow")

    got = url_rules.judge(pages, given, ranges=5).collect()
    assert len(got) == len(urls) + 1
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: plain(u) for i, u in enumerate(urls)}
    assert url_rules.judge(pages.where("false"), given).count() == 0 and url_rules.judge(pages, given.where("false")).where("verdict = 'allow'").count() == len(urls) + 1


def test_many_rules_of_one_host(spark):
    """Thousands of paths under one host, equal rules of both verdicts, very long urls and columns with the rules' names, against a scan of all rules."""
    rng = random.Random(17)
    paths = {"/" + "/".join(rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.randint(1, 6))) for _ in range(3000)}
    rules = [("a.com", p, rng.choice(["allow", "block"])) for p in sorted(paths)] + [("a.com", "/b", "allow"), ("a.com", "/b", "block"), ("www.a.com", "/bb", "allow")]
    urls = ["https://" + rng.choice(["a.com", "www.a.com", "x.www.a.com", "b.com"]) + "/" + "/".join(rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.randint(1, 7))) for _ in range(300)]
    urls += ["https://a.com/" + "b/" * 100_000, "https://" + "a." * 20_000 + "com/b"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("h")).withColumn("rule", F.lit(1)).withColumn("key", F.lit("k"))
    got = url_rules.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), ranges=7).collect()

    def plain(url):
        host, path = url[8:].split("/", 1)[0], "/" + url[8:].split("/", 1)[1]
        best = max(((len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
        return best[3:] if best else (None, "allow")

    assert {r.page_id: (r.rule, r.verdict) for r in got} == {i: plain(u) for i, u in enumerate(urls)}
