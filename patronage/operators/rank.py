"""Exact global ranks, NTILE, qcut and quantiles without a single-partition sort.

A window with ``ORDER BY`` and no ``PARTITION BY`` runs on one task. Two
distributed forms replace it, at every size:

* :func:`order_statistics` finds the rows at a few given ranks by selection:
  a mergeable quantile sketch brackets each rank between two values, a count
  says which ranks the bracket holds, and so on inside it; where one value fills the bracket,
  the key is narrowed in the same way. Nothing is sorted or shuffled but
  sketches and counts; a few rows per rank reach the driver.
* :func:`add_tiles` turns the rows at the tile borders into literals, so that a
  tile is a comparison with at most k - 1 cut keys, evaluated where the row is.
* :func:`number_rows` gives every row its rank (surrogate ids): the sorted
  partitions are materialised once and each one's rows start after those before it.

All orders end in a unique key, so a value that a third of all rows share is
split by it. The input is materialised once in the shared
checkpoint folder; building such a query therefore runs Spark jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, ShortType, StringType

from patronage.session import ensure_checkpoint_dir


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage into the shared checkpoint folder. Spark removes the files
    when no plan needs them any more, if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@dataclass(frozen=True)
class Metric:
    """A value to rank by (ascending, NULL first) and, if only some rows are
    to be ranked, their condition (the others rank last)."""

    value: str
    only: str | None = None


def _sort_key(df: DataFrame, metric: Metric, key: str) -> list[Column]:
    """(left out, exact value, floating value, key): a metric's total order."""
    value = F.col(metric.value)
    out = ~F.coalesce(F.col(metric.only), F.lit(False)) if metric.only else F.lit(False)
    floating = isinstance(df.schema[metric.value].dataType, (FloatType, DoubleType))
    exact = F.lit(None) if floating else value
    return [out.alias("out"), exact.cast("decimal(38,6)").alias("exact"),
            (value if floating else F.lit(None)).cast("double").alias("floating"), F.col(key).alias("key")]


FEW = 500         # rows of a bracket that are read to the driver
ACCURACY = 10_000  # of the sketches: they are off by n / ACCURACY ranks at most
KEY_BYTES = 6      # of a text key that one projection holds (exact in a double)


class _Selection:
    """The rows among which a rank is still to be found: a condition, how many
    they are, and the rank among them."""

    def __init__(self, name: str, rank: int, inside: Column, n: int):
        self.name, self.rank, self.inside, self.n = name, rank, inside, n
        self.left = rank   # rank among the rows inside
        self.level = 0     # projections that all rows inside agree on
        self.value = 0.0   # of the last of these


def _projections(df: DataFrame, metric: Metric, key: str) -> list[Callable[[float], Column]]:
    """Doubles that order rows as the sort key does, one after another; each
    is given the value of the one before, on which the rows agree."""
    value, kind = F.col(metric.value), df.schema[metric.value].dataType
    low = F.lit(float("-inf"))
    out = [lambda _: F.coalesce(F.nanvl(value.cast("double"), F.lit(float("inf"))), low)]  # NaN is last
    if isinstance(kind, (FloatType, DoubleType)):
        out += [lambda _: value.isNotNull().cast("double"), lambda _: F.coalesce(F.isnan(value), F.lit(False)).cast("double")]
    elif not _exact_in_double(kind):  # numbers that are one double differ by little
        exact = value.cast("decimal(38,6)")
        out.append(lambda same: F.coalesce((exact - F.lit(same).cast("decimal(38,6)")).cast("double"), low) if abs(same) < 1e31 else F.lit(0.0))
    k = F.col(key)
    if isinstance(df.schema[key].dataType, StringType):
        longest = df.agg(F.max(F.octet_length(k))).first()[0] or 0
        for at in range(0, longest, KEY_BYTES):
            part = F.rpad(F.hex(F.substring(k.cast("binary"), at + 1, KEY_BYTES)), 2 * KEY_BYTES, "0")
            out.append(lambda _, part=part: F.coalesce(F.conv(part, 16, 10).cast("double"), low))
        out.append(lambda _: F.coalesce(F.octet_length(k).cast("double"), low))
    else:
        whole = k.cast("decimal(38,0)")
        out.append(lambda _: F.coalesce(k.cast("double"), low))
        out.append(lambda same: F.coalesce((whole - F.lit(same).cast("decimal(38,0)")).cast("double"), low) if abs(same) < 1e31 else F.lit(0.0))
    return out


def _exact_in_double(kind: DataType) -> bool:
    return isinstance(kind, (ByteType, ShortType, IntegerType)) or isinstance(kind, DecimalType) and kind.precision <= 15


def _narrow(df: DataFrame, todo: list[_Selection], projections: dict[str, list[Callable[[float], Column]]]) -> None:
    """One round: bracket every rank, count, and keep the rows that hold it."""
    def x(s: _Selection) -> Column:
        return projections[s.name][s.level](s.value)

    # ranks of one metric that are sought among the same rows share a sketch
    shared: dict[tuple, list[_Selection]] = {}
    for s in todo:
        shared.setdefault((s.name, s.level, id(s.inside)), []).append(s)
    sketches = []
    for i, group in enumerate(shared.values()):
        at = []
        for s in group:
            slack = 2 * s.n / ACCURACY + 1
            at += [max(0.0, (s.left - slack) / s.n), min(1.0, (s.left + slack) / s.n)]
        sketches.append(F.percentile_approx(F.when(group[0].inside, x(group[0])), at, ACCURACY).alias(f"s{i}"))
    found = df.agg(*sketches).first()
    brackets = [(s, *found[f"s{i}"][2 * j:2 * j + 2]) for i, group in enumerate(shared.values()) for j, s in enumerate(group)]
    counts = []
    for i, (s, low, high) in enumerate(brackets):
        v = x(s)
        counts += [F.count_if(s.inside & c).alias(f"{name}{i}") for name, c in (
            ("below", v < low), ("low", v == low), ("between", (v > low) & (v < high)), ("high", (v == high) & (v > low)))]
    row = df.agg(*counts).first()
    for i, (s, low, high) in enumerate(brackets):
        v = x(s)
        shares = [(row[f"below{i}"], v < low, None), (row[f"low{i}"], v == low, low), (row[f"between{i}"], (v > low) & (v < high), None),
                  (row[f"high{i}"], (v == high) & (v > low), high)]
        shares.append((s.n - sum(n for n, _, _ in shares), v > high, None))
        for n, condition, same in shares:  # in order: the rank is in one of them
            if s.left <= n:
                s.inside, s.n = s.inside & condition, n
                if same is not None:
                    s.level, s.value = s.level + 1, same
                break
            s.left -= n


def _order_of(row) -> tuple:
    """A sort key as Spark orders it: NULL first, NaN last."""
    def number(v):
        return (0, 0) if v is None else (2, 0) if v != v else (1, v)
    return number(row["exact"]), number(row["floating"]), (0, b"") if row["key"] is None else (
        1, row["key"].encode() if isinstance(row["key"], str) else row["key"])


def order_statistics(df: DataFrame, metrics: Mapping[str, Metric], key: str,
                     ranks: Callable[[str, int], Sequence[int]]) -> tuple[dict[str, dict[int, tuple]], dict[str, int]]:
    """The sort keys at some ranks of each metric.

    ``df`` must be materialised (it is read a few times); ``key`` (text or a whole number) is
    unique. ``ranks(name, n)`` gives the 1-based ranks wanted among the n rows that
    the metric ranks; ranks outside 1..n are left out. Returns
    ``{name: {rank: sort key}}`` and ``{name: n}``. The driver gets a sketch's
    and a count's few numbers a round, and ``FEW`` rows per rank at most.
    """
    conditions = {name: F.coalesce(F.col(m.only), F.lit(False)) if m.only else F.lit(True) for name, m in metrics.items()}
    totals = df.agg(*[F.count_if(c).alias(f"n_{i}") for i, c in enumerate(conditions.values())]).first()
    sizes = {name: totals[f"n_{i}"] for i, name in enumerate(metrics)}
    wanted = [_Selection(name, r, conditions[name], n) for name, n in sizes.items() for r in sorted(set(ranks(name, n))) if 1 <= r <= n]
    projections: dict[str, list[Callable[[float], Column]]] = {}
    while todo := [s for s in wanted if s.n > FEW]:
        for s in todo:
            if s.name not in projections:
                projections[s.name] = _projections(df, metrics[s.name], key)
            if s.level >= len(projections[s.name]):
                raise ValueError(f"{key} isn't unique")
        _narrow(df, todo, projections)
    found: dict[str, dict[int, tuple]] = {name: {} for name in metrics}
    if wanted:
        rows = df.select(F.inline(F.filter(F.array(*[
            F.when(s.inside, F.struct(F.lit(i).alias("nth"), *_sort_key(df, metrics[s.name], key))) for i, s in enumerate(wanted)]),
            lambda r: r.isNotNull()))).collect()
        inside: dict[int, list] = {}
        for r in rows:
            inside.setdefault(r["nth"], []).append(r)
        for i, s in enumerate(wanted):
            row = sorted(inside[i], key=_order_of)[s.left - 1]
            found[s.name][s.rank] = (row["out"], row["exact"], row["floating"], row["key"])
    return found, sizes


def ntile_border(j: int, n: int, k: int) -> int:
    """Last rank of SQL ``NTILE(k)``'s tile j among n rows: the first n mod k
    tiles hold one row more than the rest."""
    return j * (n // k) + min(j, n % k)


def qcut_bin(rank: int, n: int, k: int) -> int:
    """pandas ``qcut(rank, k)`` bin (1-based) for ranks 1..n.

    Bin edges sit at 1 + j(n-1)/k; a rank on an edge belongs to the lower bin
    except where the float edge falls just below the integer (k = 3 with
    n = 1 mod 3), where it moves up one bin. (pandas raises for n = 1; here it is bin 1.)
    """
    if n <= 1:
        return 1
    if k == 3 and n % 3 == 1:
        return min(k, k * (rank - 1) // (n - 1) + 1)
    return max(1, (k * (rank - 1) + n - 2) // (n - 1))


def qcut_border(j: int, n: int, k: int) -> int:
    """Last rank of qcut's bin j (bins are ascending in the rank)."""
    low, high = 0, n
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if qcut_bin(mid, n, k) <= j else (low, mid - 1)
    return low


def add_tiles(df: DataFrame, key: str, tiles: Mapping[str, tuple[Metric, int]],
              border: Callable[[int, int, int], int] = ntile_border) -> DataFrame:
    """Add one 1-based tile column per entry of ``tiles`` (metric, number of
    tiles); ``border(j, n, k)`` is the last rank of tile j. Rows that a metric
    leaves out get its last tile. ``key`` is unique."""
    base = checkpointed(df)
    found, sizes = order_statistics(base, {name: m for name, (m, _) in tiles.items()}, key,
                                    lambda name, n: [border(j, n, tiles[name][1]) for j in range(1, tiles[name][1])])
    out = base
    for name, (metric, k) in tiles.items():
        mine = F.struct(*_sort_key(base, metric, key))
        tile = F.lit(1)
        for j in range(1, k):
            rank = border(j, sizes[name], k)
            if rank < 1:  # an empty tile at the front: all rows are beyond it
                tile = tile + 1
            elif rank < sizes[name]:
                left_out, exact, floating, at = found[name][rank]
                cut = F.struct(F.lit(left_out).alias("out"), F.lit(exact).cast("decimal(38,6)").alias("exact"),
                               F.lit(floating).cast("double").alias("floating"),
                               F.lit(at).cast(base.schema[key].dataType).alias("key"))
                tile = tile + (mine > cut).cast("int")
        out = out.withColumn(name, tile.cast("int"))
    return out


def quantiles(df: DataFrame, key: str, wanted: Mapping[str, Sequence[float]]) -> dict[tuple[str, float], float | None]:
    """numpy 'linear' quantiles of columns of a materialised frame, NULL
    ranking first. ``wanted``: column -> quantiles. None for an empty frame."""
    def around(n: int, q: float) -> tuple[int, int, float]:
        h = (n - 1) * q
        return int(h) + 1, min(int(h) + 2, n), h - int(h)

    found, sizes = order_statistics(df, {c: Metric(c) for c in wanted}, key,
                                    lambda c, n: [r for q in wanted[c] for r in around(n, q)[:2]] if n else [])
    out: dict[tuple[str, float], float | None] = {}
    for c, qs in wanted.items():
        for q in qs:
            if not sizes[c]:
                out[c, q] = None
                continue
            low, high, g = around(sizes[c], q)
            a, b = ((float(v) if v is not None else None) for v in (
                found[c][r][1] if found[c][r][1] is not None else found[c][r][2] for r in (low, high)))
            if a is None or b is None:
                out[c, q] = None
            else:
                out[c, q] = b - (b - a) * (1 - g) if g >= 0.5 else a + (b - a) * g
    return out


# ---------------------------------------------------------------------------
# a rank for every row
# ---------------------------------------------------------------------------

def number_rows(df: DataFrame, order: Sequence[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Add a consecutive 1-based number in ``order`` (which ends in a unique
    key). The sorted range partitions are materialised once; a row's number is
    its place in its partition after the rows of all earlier partitions."""
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the id holds the partition's number above 33 bits and the row's place below
    placed = checkpointed(df.repartitionByRange(width, *order).sortWithinPartitions(*order)
                          .withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.select("*", F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_pos"))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_pos") + F.col("_off") + 1).drop("_id", "_part", "_pos", "_off"))
