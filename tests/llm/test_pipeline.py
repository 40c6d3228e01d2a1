"""Each stage acts on what the last one left, and keeps the columns of documents."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as p

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = [docs.count()]
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns
        docs = spark.createDataFrame(after.collect(), after.schema)
        left.append(docs.count())
    assert left == sorted(left, reverse=True) and left[0] > left[-1] > 0.5 * left[0]
    pieces = p.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


def test_run(spark):
    assert p.run(spark, SF).count() > 0


def test_near_stage_is_exact(spark):
    """The stage against five-word Jaccard components: cut off passages at 0.81 go, at 0.76 they stay."""
    rng, texts = random.Random(11), []
    for k in range(20):
        w = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
        texts += [w, w[: 245 if k % 2 else 230]]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in texts]
    want = {i for i, a in enumerate(sets) if not any(len(a & b) >= 0.8 * len(a | b) for b in sets[:i])}
    assert len(want) == 30
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in p.near(spark, docs, SF).collect()} == want


def test_decontamination_stage_is_exact(spark, tmp_path):
    """The stage against alignment of all pairs, one item being copied whole, with spread edits, and in small part."""
    rng = random.Random(12)
    text = lambda n: ["".join(rng.choice("aeioulmn") for _ in range(6)) for _ in range(n)]
    item = text(36)
    docs = [text(20) + item + text(20), text(20) + [f"new{i}" if i in range(3, 36, 6) else w for i, w in enumerate(item)] + text(20), text(20) + item[:6] + text(20), text(80)]

    def score(a, b):
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        return max(map(max, h)) / (2 * len(a))

    spark.createDataFrame([(0, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    d = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(docs)], "doc_id long, text string")
    want = {i for i, t in enumerate(docs) if score(item, t) < 0.5}
    assert want == {2, 3}
    assert {r.doc_id for r in p.decontaminated(spark, d, str(tmp_path)).collect()} == want


def test_stages_on_nothing_and_on_odd_rows(spark):
    """An empty table, and null, empty, repeated and very long rows with clashing columns, through every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in p.STAGES:
        assert stage(spark, docs.where("false"), SF).count() == 0
    long = docs.orderBy("n_chars", ascending=False).first().text
    odd = spark.createDataFrame([(None, None), (None, ""), (1, long), (1, long), (1, long + " and more"), (2, long * 20), (None, long)], "doc_id long, text string")
    odd = odd.select("doc_id", "text", *[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema[2:]]).selectExpr("*", "'x' AS row", "1 AS item_id", "2 AS start", "'k' AS keep")
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, odd, SF)
        assert after.columns == odd.columns and after.count() <= odd.count(), name
    assert {(r.doc_id, r.length > 0) for r in p.STAGES[-1][1](spark, odd, SF).collect()} == {(None, True), (1, True), (2, True)}
