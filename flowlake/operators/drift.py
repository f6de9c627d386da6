"""Distribution drift between a reference and a current table.

All numeric columns are handled together by counts between sampled edges (``brackets``); only the
values between the few edges that decide an exact figure are ever sorted.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowlake.contract import columns_of_kind, common_columns
from flowlake.functions.scalar import quoted
from flowlake.operators.brackets import bin_counts, examine, interpolated
from flowlake.operators.sampling import sample_per_class

# Thresholds of the stored drift table and of the column tests.
PSI_LIMIT, DATASET_SHARE, PSI_BINS, EPSILON = 0.2, 0.5, 10, 1e-6
DISTANCE_LIMIT = 0.1
#: Smallest deviation that a distance is divided by, and sample sizes up to which p-values are exact.
LEAST_DEVIATION, EXACT_UP_TO = 0.001, 10_000
REFERENCE_PER_CLASS = 5000


def reference_sample(train: DataFrame, label: str, id_column: str, n: int = REFERENCE_PER_CLASS) -> DataFrame:
    """At most ``n`` training rows per class, with the label as expected ``prediction``."""
    return sample_per_class(train.withColumn("prediction", F.col(label)), "prediction", n, id_column)


def _long(df: DataFrame, columns: list[str], kind: str, is_reference: int) -> DataFrame:
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), quoted(c).cast(kind).alias("value")) for c in columns])
    )
    long = df.select(pairs.alias("p")).select("p.*").filter(F.col("value").isNotNull())
    if kind == "double":
        long = long.filter(~F.isnan("value"))
    return long.select("*", F.lit(is_reference).cast("bigint").alias("r"), F.lit(1 - is_reference).cast("bigint").alias("c"))


def counted_values(reference: DataFrame, current: DataFrame, columns: list[str], kind: str = "double") -> DataFrame:
    """Distinct (feature, value) with its count on either side."""
    both = _long(reference, columns, kind, 1).unionByName(_long(current, columns, kind, 0))
    return both.groupBy("feature", "value").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))


def kolmogorov_p(statistic: Column, n: Column, m: Column) -> Column:
    """Two-sided p-value by the asymptotic series."""
    lam = F.sqrt(n * m / (n + m).cast("double")) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, j: acc
        + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(F.lit(-2.0) * j * j * lam * lam),
    )
    # Below this the series has not converged and the value is 1 to many digits.
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def lattice_p(statistic: float, n: int, m: int) -> float:
    """Exact two-sided p-value: the share of orders of n and m values whose distance is at least the given one.

    An order is a path over a lattice. The share of paths to a point that have been too far off is the
    mean of the two points before, weighted by the ways there; points that are too far off have 1. Diagonals
    are worked on as a whole, so this takes (n + m) steps of at most min(n, m) + 1 numbers."""
    n, m = max(n, m), min(n, m)
    g = math.gcd(n, m)
    limit = round(statistic * (n // g) * m)
    if limit <= 0:
        return 1.0
    j = np.arange(m + 1)
    off = np.zeros(m + 1)
    for step in range(1, n + m + 1):
        shifted_off = np.concatenate([[0.0], off[:-1]])
        off = (off * (step - j) + shifted_off * j) / step
        i = step - j
        off[np.abs(i * (m // g) - j * (n // g)) >= limit] = 1.0
        off[(i < 0) | (i > n)] = 0.0
    return float(off[m])


@F.pandas_udf(T.DoubleType())
def exact_p(statistic: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    """Used on one row per column."""
    return pd.Series([lattice_p(d, int(a), int(b)) if a and b else None for d, a, b in zip(statistic, n, m)], dtype=float)


def _psi_terms(r: Column, c: Column, n: Column, m: Column) -> Column:
    ref, cur = r / n + EPSILON, c / m + EPSILON
    return F.sum((cur - ref) * F.log(cur / ref))


def _psi(r: np.ndarray, c: np.ndarray, n: int, m: int) -> float:
    """A bin that is empty on both sides adds nothing to the sum."""
    ref, cur = r / n + EPSILON, c / m + EPSILON
    return float(((cur - ref) * np.log(cur / ref)).sum())


def numeric_distances(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """PSI, KS statistic and normalised Wasserstein distance per column.

    Columns without values on one side are left out. PSI bins are exact quantiles of the reference,
    interpolated as on sorted data. The Wasserstein distance is the area between the two
    distribution functions in deviations of the reference.
    """
    probs = [i / PSI_BINS for i in range(PSI_BINS + 1)]
    found = [(c, k) for c, k in zip(columns, examine(reference, current, columns, probs)) if k.both]
    rows = []
    if found:
        names = [c for c, _ in found]
        edges = [np.unique(interpolated(k, probs)) for _, k in found]
        ref, cur = bin_counts(reference, names, edges), bin_counts(current, names, edges)
        spread = reference.agg(*[F.stddev_pop(F.nanvl(quoted(c).cast("double"), F.lit(None))).alias(f"s{i}") for i, c in enumerate(names)]).first()
        for i, (name, k) in enumerate(found):
            psi = _psi(ref[i], cur[i], k.total_n, k.total_m) if len(edges[i]) >= 3 else 0.0
            rows.append((name, k.total_n, k.total_m, k.gap, k.area / max(float(spread[i]), LEAST_DEVIATION), psi))
    # One row per column.
    return reference.sparkSession.createDataFrame(rows, "feature string, n bigint, m bigint, ks_statistic double, wasserstein double, psi double")


def drift_table(
    reference: DataFrame,
    current: DataFrame,
    columns: list[str] | None = None,
    reference_size: int | None = None,
    current_size: int | None = None,
    exact_up_to: int = EXACT_UP_TO,
) -> DataFrame:
    """The stored drift table: one row per numeric column with the dataset verdict on each.

    P-values are exact where no side has more than ``exact_up_to`` values, asymptotic beyond."""
    columns = columns or common_columns(reference, current, numeric_only=True)
    measured = numeric_distances(reference, current, columns)
    verdicts = measured.withColumns(
        {
            "drifted": (F.col("psi") > PSI_LIMIT).cast("int"),
            "ks_p_value": F.when(F.greatest("n", "m") > exact_up_to, kolmogorov_p(F.col("ks_statistic"), F.col("n"), F.col("m"))),
        }
    )
    if exact_up_to > 0:
        small = F.greatest("n", "m") <= exact_up_to
        exact = exact_p("ks_statistic", F.when(small, F.col("n")).otherwise(0), F.when(small, F.col("m")).otherwise(0))
        verdicts = verdicts.withColumn("ks_p_value", F.coalesce("ks_p_value", exact))
    share = F.avg("drifted").over(Window.partitionBy())
    size = lambda df: df.agg(F.count(F.lit(1)).alias("s")).scalar()
    return verdicts.select(
        "feature",
        F.round("psi", 6).alias("psi"),
        F.round("ks_statistic", 6).alias("ks_statistic"),
        "ks_p_value",
        "drifted",
        F.round(share, 4).alias("share_drifted"),
        (share > DATASET_SHARE).cast("int").alias("dataset_drift_detected"),
        (size(reference) if reference_size is None else F.lit(reference_size)).cast("bigint").alias("reference_size"),
        (size(current) if current_size is None else F.lit(current_size)).cast("bigint").alias("current_size"),
        F.current_timestamp().alias("computed_at"),
    )


def _upper_gamma(shape: float, x: float) -> float:
    """Share of a gamma distribution above x: a series near zero, a continued fraction beyond."""
    if x <= 0 or shape <= 0:
        return 1.0
    front = math.exp(shape * math.log(x) - x - math.lgamma(shape))
    if x < shape + 1:
        term = total = 1.0 / shape
        k = shape
        while term > total * 1e-16:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    b, c = x + 1 - shape, 1e300
    d = h = 1 / b
    for i in range(1, 10_000):
        a = i * (shape - i)
        b += 2
        d = 1 / (a * d + b)
        c = b + a / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


@F.pandas_udf(T.DoubleType())
def chi_square_p(statistic: pd.Series, freedom: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution; used on one row per column."""
    return pd.Series([_upper_gamma(f / 2, x / 2) for x, f in zip(statistic, freedom)])


def category_distances(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """PSI, chi-square test and Jensen-Shannon distance of category shares per column."""
    values = counted_values(reference, current, columns, "string")
    # One row per column; joined back by its bounded size, not by a window over the column.
    totals = values.groupBy("feature").agg(
        F.sum("r").alias("n"), F.sum("c").alias("m"), F.count(F.lit(1)).alias("levels")
    ).filter("n > 0 AND m > 0")
    joined = values.join(F.broadcast(totals), "feature")
    r, c, n, m = (F.col(x).cast("double") for x in ("r", "c", "n", "m"))
    p, q = r / n, c / m
    middle = (p + q) / 2
    half = lambda x: F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0)
    expected_r, expected_c = (r + c) * n / (n + m), (r + c) * m / (n + m)
    chi = (r - expected_r) * (r - expected_r) / expected_r + (c - expected_c) * (c - expected_c) / expected_c
    found = joined.groupBy("feature").agg(
        F.max("n").alias("n"), F.max("m").alias("m"),
        _psi_terms(r, c, n, m).alias("psi"),
        F.sum(chi).alias("chi_square"),
        (F.max("levels") - 1).alias("degrees_of_freedom"),
        F.sqrt(F.greatest(F.sum(half(p) + half(q)) / 2, F.lit(0.0))).alias("js_distance"),
    )
    return found.withColumn("p_value", chi_square_p("chi_square", "degrees_of_freedom"))


def column_drift(reference: DataFrame, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per-column drift by type, with the share of drifted columns.

    Numeric columns are judged by the Wasserstein distance in deviations of the reference, categories and
    the ``prediction`` column by the Jensen-Shannon distance of their shares.
    """
    columns = columns or common_columns(reference, current)
    numbers = [c for c in columns_of_kind(reference, "number") if c in columns]
    categories = [c for c in columns_of_kind(reference, "category") if c in columns]
    parts = []
    if numbers:
        parts.append(
            numeric_distances(reference, current, numbers).select(
                "feature", F.lit("numeric").alias("kind"), "psi", F.col("wasserstein").alias("distance"),
                (F.col("wasserstein") > DISTANCE_LIMIT).cast("int").alias("drifted"),
            )
        )
    if categories:
        parts.append(
            category_distances(reference, current, categories).select(
                "feature", F.lit("category").alias("kind"), "psi", F.col("js_distance").alias("distance"),
                (F.col("js_distance") > DISTANCE_LIMIT).cast("int").alias("drifted"),
            )
        )
    share = F.avg("drifted").over(Window.partitionBy())
    return reduce(DataFrame.unionByName, parts).select(
        "*", share.alias("share_drifted"), (share > DATASET_SHARE).cast("int").alias("dataset_drift_detected")
    )


def shifted(df: DataFrame, columns: list[str], deviations: float = 2.0) -> DataFrame:
    """Move every numeric column by a multiple of its standard deviation; drift must then be found."""
    spread = df.agg(*[F.stddev_samp(quoted(c)).alias(f"s{i}") for i, c in enumerate(columns)]).first()
    moved = {
        c: quoted(c).cast("double") + F.lit(float(spread[i]) * deviations)
        for i, c in enumerate(columns) if spread[i]
    }
    return df.withColumns(moved)
