"""The queries opN_<name> over the driver's tables, and DuckDB SQL where SQL can express them."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewave.llm import chat_repair, chat_template, decontaminate, exact_dedup, license_scan, line_dedup, pack_dp, quality_fm
from pricewave.llm import ranked_search, simhash_neardup, substring_dedup, token_files, url_rules
from pricewave.llm.common import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark, sf_dir):
    """Documents laid out as files: source/lang/shard/doc_id.txt, every 25th being its folder's licence file."""
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.concat(F.lit("shard"), F.floor(F.col("doc_id") / 500).cast("string")))
    name = F.when(F.col("doc_id") % 25 == 0, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = docs.select(F.concat_ws("/", folder, name).alias("path"), "text")
    found = license_scan.scan(files)
    return found.select(F.regexp_extract("path", r"(\d+)(\.txt)?$", 1).cast("long").alias("doc_id"), "path", "own", F.round("score", 6).alias("score"), "licence", "source", "distance")


def op2_simhash_neardup(spark, sf_dir):
    return simhash_neardup.near_dups(table(spark, sf_dir, "documents"))


def op3_quality_fm(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_fm.score(docs, quality_fm.fit(docs, labels))


def op4_decontaminate(spark, sf_dir):
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("score", 6).alias("score"), "start", "end")


def op5_line_dedup(spark, sf_dir):
    kept = line_dedup.drop_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op7_pack_sequences(spark, sf_dir):
    return pack_dp.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], turns.schema)
    return chat_template.digests(chat_template.format_chats(turns.union(extra)))


def op9_substring_dedup(spark, sf_dir):
    return substring_dedup.drop_repeats(table(spark, sf_dir, "documents")).drop("kept")


#: Host, path and verdict of each rule.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))


def op10_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


def op11_ranked_search(spark, sf_dir):
    return ranked_search.search(ranked_search.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_token_files(spark, sf_dir):
    """Files are written with the metadata that documents has, in the shared folder, and read again."""
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    docs, path = table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")
    token_files.write_tokens(docs, folder, path, end_id=2, metadata=("lang", "source"), encoding="delta", by_word=True)
    return token_files.checksums(token_files.read_tokens(spark, folder))


def op13_chat_repair(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    found = chat_repair.digests(chat_repair.repair(chat_repair.damage(turns)))
    all_ = turns.select("conv_id").distinct()
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in chat_repair.REPORT]
    joined = all_.join(found, all_["conv_id"].eqNullSafe(found["conv_id"]), "left")
    return joined.select(all_["conv_id"], *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_simhash_neardup, op3_quality_fm, op4_decontaminate, op5_line_dedup, op6_exact_dedup, op7_pack_sequences, op8_chat_format, op9_substring_dedup, op10_url_filter, op11_ranked_search, op12_token_files, op13_chat_repair)}

_LINES = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS keep FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
j AS (SELECT k.*, s.keep IS NOT NULL AND s.keep <> doc_id AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_EXACT = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""

_REPEATS = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 18, 1))) AS s, ws FROM d WHERE len(ws) >= 20),
w AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS body FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) > 1 AS again FROM w),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM f WHERE again),
x AS (SELECT doc_id, list(i) AS cut FROM c GROUP BY doc_id),
e AS (SELECT doc_id, len(ws) AS n, list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda z: cut IS NULL OR NOT list_contains(cut, z[2])) AS kept FROM d LEFT JOIN x USING (doc_id))
SELECT doc_id, n AS n_words, n - len(kept) AS n_removed, sha256(array_to_string(list_transform(kept, lambda z: z[1]), ' ')) AS kept_sha256 FROM e
"""

_URLS = r"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(v, length(rhost || rpath)) AS v
      FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
"""

_TURNS = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
c AS (SELECT *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS guarded,
             regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS shown FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length('<s>') + length(shown) + 1 + length(guarded) + length('</s>') + CASE WHEN role = 'assistant' THEN 0 ELSE length('[INST]  [/INST]') END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

_RANKED = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS total FROM d WHERE len(ts) > 0),
tf AS (SELECT doc_id, len(ts) AS n, t, count(*) AS tf FROM (SELECT doc_id, ts, unnest(ts) AS t FROM d) GROUP BY ALL),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, c GROUP BY t, n_docs),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
      FROM b JOIN tf USING (t) JOIN w USING (t), c GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

#: DuckDB has no crc32: `h` takes it bit by bit. `p` holds for each row and state the cheapest and least audit, as a plain string.
_REPAIRED = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, xor(4294967295, list_reduce(list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT)),
         lambda a, b: list_reduce(range(8), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, b)), 4294967295)) % 20 AS fault FROM t),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE fault <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM d),
f AS (SELECT *, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
             CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 2
                  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS kind FROM o),
step(f, t, i, cost, code) AS (VALUES (0, 2, '', 3, 'I'), (0, 3, '', 6, 'II'), (1, 2, '', 3, 'I'), (1, 3, '', 6, 'II'), (2, 3, '', 3, 'I'), (2, 2, '', 6, 'II'),
                                     (3, 2, '', 3, 'I'), (3, 3, '', 6, 'II'), (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, '')),
edit(f, t, i, cost, code) AS (VALUES (0, 1, 's', 0, 'K'), (0, 2, 'u', 0, 'K'), (1, 2, 'u', 0, 'K'), (2, 3, 'a', 0, 'K'), (3, 2, 'u', 0, 'K'),
                                     (0, 2, '', 3, 'R'), (1, 2, '', 3, 'R'), (2, 3, '', 3, 'R'), (3, 2, '', 3, 'R'),
                                     (0, 0, '', 4, 'D'), (1, 1, '', 4, 'D'), (2, 2, '', 4, 'D'), (3, 3, '', 4, 'D')),
move AS (SELECT step.f, edit.t, edit.i, step.cost + edit.cost AS cost, step.code || edit.code AS code FROM step JOIN edit ON step.t = edit.f),
p(conv_id, pos, st, best) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, {'c': 0, 'a': ''} FROM f
  UNION ALL
  SELECT p.conv_id, p.pos + 1, move.t, min({'c': best.c + cost + CASE WHEN kind = 3 AND code NOT LIKE '%D' THEN 3 ELSE 0 END, 'a': best.a || code})
  FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos + 1
  JOIN move ON move.f = st AND (i = '' OR i = initial) AND (kind NOT IN (1, 2) OR code LIKE '%D') GROUP BY ALL),
e AS (SELECT conv_id, count(*) AS n, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
             count(*) FILTER (WHERE kind = 1) AS blank, count(*) FILTER (WHERE kind = 2) AS duplicate, count(*) FILTER (WHERE kind = 3) AS truncated,
             count(*) FILTER (WHERE pos > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
b AS (SELECT e.*, min({'c': best.c + step.cost, 'a': best.a || step.code}) AS best FROM p JOIN e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND pos = n
      JOIN step ON step.f = st AND step.t IN (0, 3) GROUP BY ALL),
c AS (SELECT conv_id, best.a AS audit, unnest(string_split(best.a, '')) AS ch, generate_subscripts(string_split(best.a, ''), 1) AS nr FROM b),
x AS (SELECT *, count(*) FILTER (WHERE ch <> 'I') OVER w AS pos, count(*) FILTER (WHERE ch <> 'D') OVER w AS nth FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY nr)),
y AS (SELECT x.*, role, text, initial, bool_or(ch = 'K' AND nth = 1 AND initial = 's') OVER (PARTITION BY x.conv_id) AS headed
      FROM x LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.pos = x.pos AND ch <> 'I'),
z AS (SELECT conv_id, string_agg(CASE WHEN ch = 'K' THEN role WHEN (nth % 2 = 1) <> coalesce(headed, false) THEN 'user' ELSE 'assistant' END || ':'
                                 || CASE WHEN ch = 'I' THEN '' ELSE text END, chr(10) ORDER BY nr) AS lines FROM y WHERE ch <> 'D' GROUP BY conv_id),
q AS (SELECT DISTINCT conv_id FROM conversations)
SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM q LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM q.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM q.conv_id
"""

ORACLES = {"op5_line_dedup": _LINES, "op6_exact_dedup": _EXACT, "op8_chat_format": _TURNS, "op9_substring_dedup": _REPEATS, "op10_url_filter": _URLS, "op11_ranked_search": _RANKED, "op13_chat_repair": _REPAIRED}
