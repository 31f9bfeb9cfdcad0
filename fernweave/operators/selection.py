"""Exact k-th values by distributed histograms: no table is sorted, shuffled or written.

A histogram counts rows by a digit that keeps the order of the values; the
wanted places fall into a few of its bins, and only the rows of these go into
the next, finer histogram, until a bin holds one value or few rows. Each step is
one aggregate over the table, combined before its shuffle; a bounded number of
counters comes to the driver, whatever the table's size.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bins of a histogram for each bin of the one before, and rows of a bin that are looked at value by value.
BINS, FEW = 1024, 1024
#: Bins of the first histogram for each power of two: columns of few values are mostly told apart by it.
PARTS = 64
#: Digits of a text histogram's step, as hexadecimal digits of a hash.
DIGITS = 3


def magnitude(x: Column) -> Column:
    """The sign and binary logarithm of a double in steps of one in ``PARTS``, ascending with it; infinities and, last, NaN have their own."""
    size = F.floor(F.log2(F.abs(x)) * PARTS).cast("double") + 1100.0 * PARTS
    finite = F.when(x == 0, F.lit(0.0)).otherwise(F.signum(x) * F.least(F.greatest(size, F.lit(1.0)), F.lit(2200.0 * PARTS)))
    infinite = F.abs(x) == F.lit(math.inf)
    return F.when(F.isnan(x), F.lit(2400.0 * PARTS)).when(infinite, F.signum(x) * 2300.0 * PARTS).otherwise(finite)


def fine(x: Column) -> Column:
    """The bin of a value inside its bin before (``lo`` to ``hi``), ascending with it; the value itself where there are few."""
    width = (F.col("hi") - F.col("lo")) / BINS
    return F.when(F.col("few") | (width == 0), x).otherwise(F.floor((x - F.col("lo")) / width).cast("double"))


def doubles(values: list) -> Column:
    """A constant array of doubles, in one small expression."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>") if len(values) else F.array().cast("array<double>")


def place(x: Column, marks: list[float]) -> Column:
    """How many of the ascending marks are at most ``x``, by binary search; null counts none."""
    steps, own = [1 << b for b in reversed(range(len(marks).bit_length()))], doubles(marks)
    if not steps:
        return F.lit(0)
    return F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(F.get(own, at + step - 1) <= x, at + step).otherwise(at))


def order_statistics(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list[float]]:
    """For each column the values at the given shares of its sorted numbers, exact, interpolated between neighbours.

    Nulls are left out; a column without a number gives None. All columns are
    counted in the same steps: first by magnitude, then by equal parts of a
    bin's range from its least to its largest value. A step reads the table
    anew, but counts only the values in bins that hold a wanted place. The
    first step brings at most ``PARTS`` counters a sign and power of two to the
    driver, another step, with ``p`` wanted places, at most ``p`` times the
    larger of ``BINS`` and ``FEW``. NaN is larger than all numbers.
    """
    # -0.0 equals 0.0 and is counted with it.
    number = [F.col(f"`{c}`").cast("double") for c in columns]
    rows = df.select(*[F.when(x == 0, 0.0).otherwise(x).alias(f"x{i}") for i, x in enumerate(number)])
    first = F.array(*[F.struct(F.lit(i).alias("c"), F.lit(0).alias("bin"), F.col(f"x{i}").alias("x")) for i in range(len(columns))])
    found = rows.select(F.inline(first)).where("x IS NOT NULL").withColumn("digit", magnitude(F.col("x")))
    told = _by_bin(_counted(found, ["c", "bin", "digit"]))
    out: dict[str, list[float]] = {c: [None] * len(shares) for c in columns}
    places = {c: [s * (sum(n for _, n, _, _ in own) - 1) for s in shares] for (c, _), own in told.items()}
    #: Wanted places by the bins that hold them: (column, bin) -> place inside the bin and in the column.
    wanted = {(c, 0): sorted({(q, q) for x in own for q in (math.floor(x), math.ceil(x))}) for c, own in places.items()}
    value: dict[tuple[int, int], float] = {}
    while wanted:
        inside: dict[int, dict[tuple, list]] = {}
        for (c, prefix), own in wanted.items():
            bins = told[c, prefix]
            ends = list(accumulate(n for _, n, _, _ in bins))
            for q, whole in own:
                at = bisect_right(ends, q)
                _, n, lo, hi = bins[at]
                if lo == hi or n == 1 or (math.isnan(lo) and math.isnan(hi)):
                    value[c, whole] = lo
                else:
                    inside.setdefault(c, {}).setdefault((lo, hi, n <= FEW), []).append((q - (ends[at] - n), whole))
        if not inside:
            break
        # A bin is all values from its least to its largest: its rows are found by them.
        active = {c: sorted(own) for c, own in inside.items()}
        wanted = {(c, i): inside[c][b] for c, own in active.items() for i, b in enumerate(own)}
        told = _by_bin(_counted(_inside(rows, active), ["c", "bin", "digit"]))
    for c, own in places.items():
        for k, x in enumerate(own):
            low, high = value[c, math.floor(x)], value[c, math.ceil(x)]
            out[columns[c]][k] = low if low == high else low + (high - low) * (x - math.floor(x))
    return out


def _inside(rows: DataFrame, active: dict[int, list[tuple]]) -> DataFrame:
    """The values (c, bin, x, digit) of the columns ``x0`` ... that lie in an active bin (lo, hi, few)."""
    now, every = rows.withColumns({f"p{c}": place(F.col(f"x{c}"), [lo for lo, _, _ in own]) - 1 for c, own in active.items()}), []
    for c, own in active.items():
        at, x, (lo, hi, few) = F.col(f"p{c}"), F.col(f"x{c}"), map(doubles, zip(*own, strict=True))
        fields = [F.lit(c).alias("c"), at.alias("bin"), x.alias("x"), F.get(lo, at).alias("lo"), F.get(hi, at).alias("hi"), (F.get(few, at) > 0).alias("few")]
        every.append(F.when(x <= F.get(hi, at), F.struct(*fields)))
    held = now.select(F.explode(F.array(*every)).alias("v")).where("v IS NOT NULL").select("v.*")
    return held.select("c", "bin", "x", fine(F.col("x")).alias("digit"))


def _counted(rows: DataFrame, keys: list[str]) -> list[tuple]:
    found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    return [tuple(r) for r in found]


def _by_bin(told: list[tuple]) -> dict[tuple, list[tuple]]:
    """Bins (digit, n, lo, hi) in ascending order by column and the bin before."""
    out: dict[tuple, list[tuple]] = {}
    for r in told:
        out.setdefault(r[:2], []).append(r[2:])
    for own in out.values():
        own.sort(key=lambda b: (math.isnan(b[0]), b[0]))
    return out


def first_by_hash(df: DataFrame, digest: str, key: str, share: float | None = None, n: int | None = None) -> Column:
    """Whether a row is one of the first ``n``, or ``floor(rows * share)``, in the order of (``digest``, ``key``).

    ``digest`` is a column of hexadecimal text of one length. A histogram of its
    first digits finds the bin of the first row that is not; that one's next
    digits follow, until few distinct keys are left, whose order is looked at.
    Rows with an equal key stay together, on the side of those that are not
    first. Nulls in the key count like a key before all others.
    """
    prefix, rows, total = "", df.select(F.col(digest).alias("h"), F.col(key).alias("k")), None
    while True:
        length = len(prefix) + DIGITS
        own = rows.where(F.col("h").startswith(prefix)) if prefix else rows
        told = sorted((r["p"], r["n"]) for r in own.groupBy(F.substring("h", 1, length).alias("p")).agg(F.count("*").alias("n")).collect())
        if total is None:
            total = sum(c for _, c in told)
            place = min(math.floor(total * share) if share is not None else n, total)
            if place == total:
                return F.lit(True)
        for p, c in told:
            if place < c:
                break
            place -= c
        prefix = p
        if c <= FEW or len(prefix) < length:
            break
    kept = F.struct(F.col(digest).alias("h"), F.col(key).alias("k"))
    # Copies of a row count once here: their number comes with it, so that a hot key is one row.
    found = rows.where(F.col("h").startswith(prefix)).groupBy("h", "k").count().orderBy("h", "k").limit(FEW + 1).collect()
    for r in found:
        if place < r["count"]:
            bound = df.sparkSession.createDataFrame([(r["h"], r["k"])], rows.schema).select(F.struct("h", "k").alias("b"))
            return kept < bound.scalar()
        place -= r["count"]
    raise RuntimeError("more than one key has the same hash")
