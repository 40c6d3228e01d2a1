"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""

import math
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pricewave.llm.common import ASCII_LOWER, texts

#: Hashed word buckets, word shape buckets, and bins of the structure statistics.
WORD_BUCKETS, SHAPE_BUCKETS, BINS = 1 << 14, 1 << 10, 16
#: At most this many labelled documents are used for fitting, those of least hash.
MAX_TRAIN = 8000
STATS = (
    "log_chars", "log_words", "word_length", "distinct_words", "upper", "digits", "symbols", "line_length",
    "distinct_lines", "ending_stops", "bars", "exclamations", "top_word", "short_lines",
)
SIZE = WORD_BUCKETS + SHAPE_BUCKETS + len(STATS) * BINS
_SHAPE = re.compile(rb"[a-z\x80-\xff]+|[A-Z]+|[0-9]+")
_SHAPES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(0x80, 0x100)), b"A" * 26 + b"0" * 10 + b"a" * 128)
_SMALL = bytes.maketrans(b"abcdefghijklmnopqrstuvwxyz", b"a" * 26)
_RUNS = re.compile(rb"a{2,}|A{2,}|0{2,}")
_UPPER, _DIGIT = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_PLAIN = b"abcdefghijklmnopqrstuvwxyz" + _UPPER + _DIGIT + b" \t\n\x0b\f\r" + bytes(range(0x80, 0x100))
_STOPS = b".,;:'\"?()-"


def _stats(raw: bytes, ws: list[bytes], counts, n_chars: int) -> list[float]:
    n, w = max(len(raw), 1), max(len(ws), 1)
    lines = raw.split(b"\n")
    full = [x for x in lines if x.strip()]
    odd = raw.translate(None, _PLAIN + _STOPS)
    return [
        math.log1p(n_chars) / 12,
        math.log1p(len(ws)) / 11,
        min(1.0, sum(map(len, ws)) / w / 16),
        len(counts) / w,
        (len(raw) - len(raw.translate(None, _UPPER))) / n,
        (len(raw) - len(raw.translate(None, _DIGIT))) / n * 4,
        len(odd) / n * 4,
        min(1.0, math.log1p(n / max(len(full), 1)) / 9),
        len(set(full)) / max(len(full), 1),
        sum(x.rstrip().endswith((b".", b"!", b"?")) for x in full) / max(len(full), 1),
        raw.count(b"|") / w,
        raw.count(b"!") / w,
        max(counts.values(), default=0) / w,
        sum(len(x) < 20 for x in full) / max(len(full), 1),
    ]


def features(raw: bytes, n_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse row: indices and values. Word and shape counts are damped and share unit length; statistics are one-hot bins."""
    ws = raw.split()
    counts: dict = {}
    for w in ws:
        counts[w] = counts.get(w, 0) + 1
    words: dict = {}
    for w, c in counts.items():
        k = zlib.crc32(w.translate(ASCII_LOWER)) % WORD_BUCKETS
        words[k] = words.get(k, 0) + c
        s = WORD_BUCKETS + zlib.crc32(_RUNS.sub(lambda m: m[0][:2], w.translate(_SHAPES).translate(_SMALL))) % SHAPE_BUCKETS
        words[s] = words.get(s, 0) + c
    idx = np.fromiter(words, dtype=np.int64, count=len(words))
    val = np.sqrt(np.fromiter(words.values(), dtype=np.float64, count=len(words)) / max(len(ws), 1))
    bins = [WORD_BUCKETS + SHAPE_BUCKETS + k * BINS + min(BINS - 1, max(0, int(math.sqrt(min(1.0, max(0.0, x))) * BINS))) for k, x in enumerate(_stats(raw, ws, counts, n_chars))]
    return np.concatenate([idx, bins]).astype(np.int64), np.concatenate([val, np.full(len(bins), 0.5)])


class Machine:
    """y = sigmoid(b + w.x + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): linear in the features present."""

    def __init__(self, rank: int = 8, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.b, self.w, self.v = 0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, rank))

    def margins(self, rows):
        """Margins, and the factor sums per row, of a list of sparse rows."""
        cut = np.cumsum([0] + [len(i) for i, _ in rows])[:-1]
        idx, val = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
        vx = self.v[idx] * val[:, None]
        sums = np.add.reduceat(vx, cut, axis=0)
        squares = np.add.reduceat(vx * vx, cut, axis=0)
        return self.b + np.add.reduceat(self.w[idx] * val, cut) + 0.5 * (sums**2 - squares).sum(1), (idx, val, cut, vx, sums)

    def fit(self, rows, y, epochs: int = 12, rate: float = 0.05, decay: float = 1e-4, batch: int = 128, seed: int = 5):
        """Adagrad on the log loss, classes weighted alike."""
        y = np.asarray(y, float)
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
        gw, gv, gb, rng = np.full(SIZE, 1e-8), np.full_like(self.v, 1e-8), 1e-8, np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for s in range(0, len(order), batch):
                take = order[s : s + batch]
                margin, (idx, val, cut, vx, sums) = self.margins([rows[i] for i in take])
                err = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[take]) * weight[take] / len(take)
                each = np.repeat(np.arange(len(take)), np.diff(np.append(cut, len(idx))))
                e = err[each] * val
                present, where = np.unique(idx, return_inverse=True)
                dw = np.bincount(where, e, len(present)) + decay * self.w[present]
                dv = np.zeros((len(present), self.v.shape[1]))
                part = e[:, None] * (sums[each] - vx)
                for f in range(dv.shape[1]):
                    dv[:, f] = np.bincount(where, part[:, f], len(present))
                dv += decay * self.v[present]
                gw[present] += dw**2
                gv[present] += dv**2
                gb += err.sum() ** 2
                self.w[present] -= rate * dw / np.sqrt(gw[present])
                self.v[present] -= rate * dv / np.sqrt(gv[present])
                self.b -= rate * err.sum() / math.sqrt(gb)
        return self


def _rows(batch):
    for t, n in zip(batch.column("text"), batch.column("n_chars").to_pylist()):
        raw = t.as_buffer().to_pybytes()
        yield features(raw, n or 0)


def held_out(doc_id) -> F.Column:
    """The rows never fitted on: crc32 of the doc_id as text leaves 1 on division by 3. A null doc_id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _with_chars(docs: DataFrame) -> DataFrame:
    rows = texts(docs)
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN, **how) -> Machine:
    """Fit on labelled rows that are not held out; at most max_train, the least by hash of the doc_id.

    Rows with a null label or id are left out; of several labels of a document
    the least counts. Rows that repeat a chosen document each train, so it weighs
    more. Without rows the machine scores everything 0.5.
    """
    said = labels.where(F.col(label).isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.min(label).cast("double").alias("y"))
    chosen = said.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    rows = _with_chars(docs).join(F.broadcast(chosen), "doc_id").select("text", "n_chars", "y")
    schema = pa.schema([("idx", pa.list_(pa.int32())), ("val", pa.list_(pa.float32())), ("y", pa.float64()), ("tie", pa.int64())])

    def sparse(batches):
        for batch in batches:
            found = list(_rows(batch))
            ties = [zlib.crc32(i.tobytes() + v.tobytes()) for i, v in found]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([i.tolist() for i, _ in found], schema.field(0).type), pa.array([v.tolist() for _, v in found], schema.field(1).type), batch.column("y"), pa.array(ties)], schema=schema)

    got = rows.mapInArrow(sparse, "idx array<int>, val array<float>, y double, tie long").toArrow()
    y = got.column("y").to_numpy()
    if not len(y):
        return Machine()
    order = np.argsort(got.column("tie").to_numpy(), kind="stable")  # the same fit whatever the order of arrival
    data = [(np.array(got.column("idx")[int(k)].values), np.array(got.column("val")[int(k)].values, float)) for k in order]
    return Machine().fit(data, y[order], **how)


def score(docs: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Only the whole text and its length are inputs: null and empty texts are
    scored by their structure bins. Repeated rows are scored each; an empty
    table gives no rows.
    """
    rows = _with_chars(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((machine.b, machine.w.astype(np.float32), machine.v.astype(np.float32)))  # about 0.6 MB, whatever the data

    def run(batches):
        m = Machine.__new__(Machine)
        m.b, m.w, m.v = shared.value
        for batch in batches:
            for s in range(0, batch.num_rows, 512):
                part = batch.slice(s, 512)
                margin, _ = m.margins(list(_rows(part)))
                p = 1 / (1 + np.exp(-np.clip(np.nan_to_num(margin), -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p.astype(np.float64))], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, machine: Machine, threshold: float = 0.5) -> DataFrame:
    """The rows of docs that the machine does not reject, columns unchanged, judged where they lie: nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((machine.b, machine.w.astype(np.float32), machine.v.astype(np.float32)))

    def judge(text: pd.Series) -> pd.Series:
        m = Machine.__new__(Machine)
        m.b, m.w, m.v = shared.value
        good = np.zeros(len(text), bool)
        for s in range(0, len(text), 512):
            rows = [features(t.encode("utf-8", "surrogatepass"), len(t)) for t in text[s : s + 512]]
            margin, _ = m.margins(rows)
            good[s : s + len(rows)] = 1 / (1 + np.exp(-np.clip(np.nan_to_num(margin), -30, 30))) >= threshold
        return pd.Series(good)

    return docs.where(F.pandas_udf(judge, "boolean")(F.coalesce(F.col("text"), F.lit(""))))
