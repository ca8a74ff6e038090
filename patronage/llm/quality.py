"""Quality classifier: a Bradley-Terry model over text statistics.

A labelled pair (a good text, a bad one) is a preference. The model gives each
text a strength w.x, and good beats bad with probability
1 / (1 + exp(-w.(x_good - x_bad))). The weights minimise the logistic loss of
the feature differences. Texts are then cut at a quantile of the strengths:
as large a share is rejected as is labelled bad, and the strength at that
quantile is mapped to the score 0.3.

All labelled rows that are not held out are fitted, by Spark:

1. Rows are numbered within their label in order of id hash and gathered into
   slices of ``SLICE`` rows.
2. Row k of the commoner label meets the rows k to k + ``RIVALS`` - 1 of the
   other one, which starts again at its end, so every row is in some pairs. A slice
   is stored with the rows it meets.
3. Each Newton step adds up the slices' gradients and curvatures, always in the same order.
4. The quantile is exact: counts between edges, closer each time, lead to the
   one strength at which it lies.

All statistics of a text are of the whole text, and every row is scored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from patronage.llm.common import checkpointed, prepare

THRESHOLD = 0.3     # fixed by the contract of the query
RIVALS = 8          # preference pairs of each row of the commoner label
RIDGE = 1e-3
SLICE = 2_048       # rows that are held and added up together
BUCKET_BITS = 10    # of the id hash; rows are numbered bucket by bucket
EDGES = 1_024       # strengths between which rows are counted at once

_KIND = np.zeros((256, 8))  # by byte: lower, upper, digit, full stop or comma, other mark, bar, line end, UTF-8
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = [_c.islower() and _b < 128, _c.isupper() and _b < 128, _c.isdigit() and _b < 128, _c in ".,;:'\"-()?",
                 33 <= _b < 127 and not _c.isalnum() and _c not in ".,;:'\"-()?|", _c == "|", _c == "\n", _b >= 128]
_MARKS = frozenset("!#$%&*+/<=>@[\\]^_`{|}~")

FEATURES = ["lower", "upper", "digit", "stops", "marks", "bars", "line_ends", "beyond_ascii", "word_length", "mark_ended",
            "all_capitals", "repeats_last", "commonest_word", "distinct_words", "repeated_runs", "repeated_lines",
            "long_words", "size", "empty"]


def features(text: str | None) -> np.ndarray:
    """Statistics of a whole text, each about 0 to 1. A null text counts as empty."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return np.array([0.0] * (len(FEATURES) - 1) + [1.0])
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _KIND / len(raw)
    counts = Counter(words)
    runs = Counter(zip(words, words[1:], words[2:], strict=False))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ended = sum(chr(w[-1]) in _MARKS for w in words)
    capitals = sum(w.isupper() and len(w) > 1 for w in words)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return np.array([*kinds, min(1.0, len(raw) / n / 20), ended / n, capitals / n, again / n, max(counts.values()) / n,
                     len(counts) / n, 1 - len(runs) / max(1, n - 2) if n > 2 else 0.0, 1 - len(set(lines)) / len(lines),
                     sum(len(w) > 25 for w in words) / n, min(1.0, np.log1p(n) / 12), 0.0])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float  # strength that gets the score THRESHOLD

    def standard(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale).clip(-8, 8)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.strength(x) - self.cut + np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _unfitted(mean: np.ndarray, deviation: np.ndarray) -> Model:
    """All strengths are 0 and all rows are kept."""
    return Model(mean, np.where(deviation < 1e-9, 1.0, deviation), np.zeros(len(FEATURES)), -10.0)


def _differences(more: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Row k of ``more`` less each of the rows k to k + ``RIVALS`` - 1 of
    ``other``, which starts again at its end."""
    at = np.arange(len(more))
    return np.concatenate([more - other[(at + r) % len(other)] for r in range(RIVALS)])


def _preferences(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Good less bad for all pairs; every row is in some."""
    return _differences(good, bad) if len(good) >= len(bad) else -_differences(bad, good)


def _slopes(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss, summed over the pairs."""
    p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
    return d.T @ (p - 1), (d * (p * (1 - p))[:, None]).T @ d


def _newton(pairs: int, slopes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weights of least loss, by Newton steps on the convex loss."""
    w = np.zeros(len(FEATURES))
    for _ in range(30):
        gradient, curve = slopes(w)
        step = np.linalg.solve(curve / pairs + RIDGE * np.eye(len(w)), gradient / pairs + RIDGE * w)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _slots(s: np.ndarray, good: np.ndarray, edges: np.ndarray) -> list[tuple[int, int, int, float, float]]:
    """(slot, bad rows, good rows, least, greatest strength) of the slots between
    the edges that have rows. A strength equal to an edge is below it."""
    order = np.argsort(s, kind="stable")
    s, good = s[order], good[order].astype(np.int64)
    slot = np.searchsorted(edges, s)
    first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
    stop = np.r_[first[1:], len(s)]
    goods = np.add.reduceat(good, first)
    return list(zip(slot[first].tolist(), (stop - first - goods).tolist(), goods.tolist(), s[first].tolist(), s[stop - 1].tolist(), strict=True))


def _quantile(slots: Callable[[np.ndarray], list[tuple[int, int, int, float, float]]], n_bad: int, n_good: int, bad_share: Fraction) -> float:
    """The strength half way between the last row below the quantile ``bad_share``
    and the next row. All bad rows together weigh ``bad_share``, all good
    ones the rest; of equal strengths the bad rows come first."""
    def share(bad: int, good: int) -> Fraction:
        return bad_share * bad / n_bad + (1 - bad_share) * good / n_good

    bad = good = 0  # rows below the slots
    below = above = None
    edges = np.zeros(0)
    while True:
        found = [x for x in sorted(slots(edges)) if (below is None or x[3] > below) and (above is None or x[4] < above)]
        for i, (_, b, g, least, most) in enumerate(found):
            if share(bad + b, good + g) >= bad_share or i == len(found) - 1:
                break
            bad, good, below = bad + b, good + g, most
        if i + 1 < len(found):
            above = found[i + 1][3]
        if least == most:
            break
        edges = np.r_[np.nextafter(least, -np.inf), np.linspace(least, most, EDGES)]
    if share(bad + b - (not g), good + g - bool(g)) >= bad_share:
        return least  # the next row has the same strength
    if above is None:  # the last row of all
        above = least if b + g > 1 else below
    return (least + above) / 2


def fit(x: np.ndarray, good: np.ndarray, bad_share: float) -> Model:
    """Fit on rows ``x`` with truth ``good``. ``bad_share``: share of bad rows
    among all labelled ones. Without one of the labels, all strengths are 0 and
    all rows are kept. :func:`train` does the same on Spark."""
    model = _unfitted(x.mean(axis=0), x.std(axis=0)) if len(x) else _unfitted(np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    if not good.any() or good.all():
        return model
    z = model.standard(x)
    d = _preferences(z[good], z[~good])
    model.weights = _newton(len(d), lambda w: _slopes(d, w))
    s = model.strength(x)
    model.cut = _quantile(lambda edges: _slots(s, good, edges), int((~good).sum()), int(good.sum()), Fraction(bad_share))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may use: crc32 of the id as text is divisible by 5. A
    null id counts as an empty text and is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _labelled(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, label, x (statistics) of the known ids; one row per id, however often
    documents repeat it. Only statistics are shuffled, no texts."""
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
             .where(F.col("id").isNotNull() & ~held_out(F.col("id"))))
    schema = StructType([texts.schema["id"], StructField("x", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    return texts.mapInArrow(run, schema).groupBy("id").agg(F.min("x").alias("x")).join(known, "id").select("id", "label", "x")


def _sliced(rows: DataFrame, sizes: dict[tuple[int, int], int]) -> DataFrame:
    """label, slice, x (statistics of its rows, one after another). ``sizes``:
    rows by label and bucket of the id hash."""
    starts, n = [], {0: 0, 1: 0}
    for label, bucket in sorted(sizes):
        starts.append((label, bucket, n[label]))
        n[label] += sizes[label, bucket]
    starts = rows.sparkSession.createDataFrame(starts, "label int, bucket long, first long")
    within = Window.partitionBy("label", "bucket").orderBy(F.xxhash64("id"), "id")
    numbered = (rows.withColumn("place", F.row_number().over(within) - 1).join(F.broadcast(starts), ["label", "bucket"])
                .select("label", (F.col("first") + F.col("place")).alias("k"), "x"))
    return (numbered.groupBy("label", F.floor(F.col("k") / SLICE).alias("slice"))
            .agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("rows"))
            .select("label", "slice", F.flatten(F.transform("rows", lambda r: r["x"])).alias("x")))


def _matrix(value: pa.ListScalar) -> np.ndarray:
    return value.values.to_numpy().reshape(-1, len(FEATURES))


def _spread(slices: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [_matrix(v) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(m) for m in x], pa.int64()),
                                              *[pa.array(c, pa.list_(pa.float64())) for c in ([m.mean(axis=0) for m in x], [m.var(axis=0) for m in x])]],
                                             names=["label", "slice", "n", "mean", "variance"])

    parts = slices.mapInArrow(run, "label int, slice long, n long, mean array<double>, variance array<double>").toArrow()
    parts = parts.sort_by([("label", "ascending"), ("slice", "ascending")]).combine_chunks()
    n = np.asarray(parts["n"])[:, None]
    means, variances = (np.array(parts[c].to_pylist()) for c in ("mean", "variance"))
    mean = (n * means).sum(axis=0) / n.sum()
    return mean, np.sqrt((n * (variances + (means - mean) ** 2)).sum(axis=0) / n.sum())


def _beside(slices: DataFrame, more: int, n_other: int) -> DataFrame:
    """slice, more, other: each slice of the commoner label and the rows of the
    other label that its rows meet (its first row the first ``RIVALS`` of them, and so on)."""
    large = slices.where(F.col("label") == more).select("slice", F.col("x").alias("more"))
    small = slices.where(F.col("label") != more).select(F.col("slice").alias("at"), "x")
    met = F.transform(F.sequence(F.lit(0), F.lit(SLICE + RIVALS - 2)), lambda i: F.floor((F.col("slice") * SLICE + i) % n_other / SLICE))
    others = (large.select("slice", F.explode(F.array_distinct(met)).alias("at")).join(small, "at")
              .groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("others")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, rows, held in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                x = [_matrix(h["x"]) for h in held.values]
                numbers = np.concatenate([h["at"].as_py() * SLICE + np.arange(len(m)) for h, m in zip(held.values, x, strict=True)])
                wanted = (number * SLICE + np.arange(len(_matrix(rows)) + RIVALS - 1)) % n_other
                other = np.concatenate(x)[np.searchsorted(numbers, wanted)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([rows.values.to_numpy()], pa.list_(pa.float64())),
                                                  pa.array([other.ravel()], pa.list_(pa.float64()))], names=["slice", "more", "other"])

    return large.join(others, "slice").select("slice", "more", "others").mapInArrow(run, "slice long, more array<double>, other array<double>")


def _slopes_of(pairs: DataFrame, model: Model, more: int, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_slopes` of all slices, always added in the same order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, a, b in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                d = _differences(model.standard(_matrix(a)), model.standard(_matrix(b)))
                gradient, curve = _slopes(d if more else -d, w)
                yield pa.RecordBatch.from_arrays([pa.array([number.as_py()], pa.int64()), *[pa.array([v], pa.list_(pa.float64())) for v in (gradient, curve.ravel())]],
                                                 names=["slice", "gradient", "curve"])

    parts = pairs.mapInArrow(run, "slice long, gradient array<double>, curve array<double>").toArrow().sort_by("slice")
    gradient, curve = (sum(np.asarray(v.values) for v in parts[c]) for c in ("gradient", "curve"))
    return gradient, curve.reshape(len(w), len(w))


def _slots_of(slices: DataFrame, model: Model, edges: np.ndarray) -> list[tuple[int, int, int, float, float]]:
    """:func:`_slots` of the rows of all slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, rows in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                s = model.strength(_matrix(rows))
                columns = zip(*_slots(s, np.full(len(s), label == 1), edges), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["slot", "bad", "good", "least", "most"])

    parts = slices.mapInArrow(run, "slot long, bad long, good long, least double, most double")
    return [tuple(r) for r in parts.groupBy("slot").agg(F.sum("bad"), F.sum("good"), F.min("least"), F.max("most")).collect()]


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          per_label: int | None = None) -> Model:
    """Fit the model to labels (id, 0 or 1; other values and nulls don't count,
    nor do ids with both labels). All ids are used, or ``per_label`` of each label if that
    is set; of several documents with one id, the one whose statistics sort first."""
    spark = docs.sparkSession
    prepare(spark)
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id is not null and label in (0, 1)")
             .where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
             .where("label = other").select("id", F.col("label").cast("int").alias("label")))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if per_label is not None:
        chosen = [known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(per_label) for v in (0, 1)]
        known = chosen[0].unionAll(chosen[1])
    bucket = F.shiftrightunsigned(F.xxhash64("id"), 64 - BUCKET_BITS)
    rows = checkpointed(_labelled(docs, known, id_col, text_col).withColumn("bucket", bucket))
    sizes = {(r["label"], r["bucket"]): r["count"] for r in rows.groupBy("label", "bucket").count().collect()}
    n_bad, n_good = (sum(n for (label, _), n in sizes.items() if label == v) for v in (0, 1))
    if not sizes:
        return _unfitted(np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    slices = checkpointed(_sliced(rows, sizes))
    model = _unfitted(*_spread(slices))
    if not n_bad or not n_good:
        return model
    more = int(n_good >= n_bad)
    pairs = checkpointed(_beside(slices, more, min(n_bad, n_good)))
    model.weights = _newton(RIVALS * max(n_bad, n_good), lambda w: _slopes_of(pairs, model, more, w))
    model.cut = _quantile(lambda edges: _slots_of(slices, model, edges), n_bad, n_good, Fraction(counts[0], counts[0] + counts[1]))
    return model


def scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row, by its text alone. Null texts count as
    empty and are scored too; repeated rows are rows of their own; further columns
    aren't read. An empty table gives no rows."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([features(t.as_py()) for t in batch.column(1)])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
            .mapInArrow(run, "doc_id bigint, score double"))


def keep(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    prepare(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([features(t.as_py()) for t in batch.column(place).cast(pa.string())])
                yield batch.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
