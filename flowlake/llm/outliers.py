"""Quality rules: robust multivariate outliers per language and source.

Every text gives a vector of four statistics (mean word length, share of symbols, repeated
lines, share of words in repeated three-word windows), each transformed to tame its tail.
For each cell (language and source) the minimum covariance determinant is estimated: the
half of the rows, or ``SHARE`` of them, whose covariance has the smallest determinant. A
text is rejected if its Mahalanobis distance under that estimate is beyond a quantile of
the chi-squared distribution.

The search is the usual one of concentration steps, from two fixed starts (medians and
scales from a histogram of the cell; and the same with the scatter of rank-like scores):
distances under the present estimate, the nearest rows, their mean and covariance. All of
it is DataFrame expressions:

* a step is two aggregates. "Nearest" is read off a histogram of log-distances per cell
  (``BINS`` per doubling), so no cell is ever sorted or collected, whatever its size;
* the covariance is kept as a Cholesky factor, so a distance is a forward substitution;
* a floor on each statistic's scale keeps cells in which a statistic is constant regular.

Every cell is judged by its own estimate, shrunk towards its language's, which is shrunk towards
that of all rows: the estimate is that of a mixture in which the cell has the weight n / (n +
``shrink``), n its rows. So a cell of a few rows leans on its language and one of many does
not, without a size at which the verdict jumps. The wider estimates are made like a cell's.

The tables of estimates and of cut-offs have a row or two per cell; they are counted and sent to all tasks, so
a large cell is never gathered by a join. Vectors are stored once; the levels they count for are made as they are read.

Defined cases: null, empty and blank texts have no words and fail the base rules; rows that
fail them are in no estimate; a null language or source is a value of its own; repeated
rows count each; columns named like the results are replaced, all others pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlake.session import scratch_path

SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
SHARE = 0.75
STEPS = 4
BINS = 16
#: Rows at which a cell and its language weigh alike, and rows of a table of cells up to which it is sent to all tasks.
SHRINK = 50
SMALL = 50_000
DIMENSIONS = ("x1", "x2", "x3", "x4")
#: Smallest scale of each transformed statistic that is taken to be real.
FLOORS = (0.35, 0.05, 0.5, 0.15)
#: Places of the present text that fit beside a 40-bit hash.
PLACES = 1 << 24
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with word and symbol counts, repeated lines and repeated words.

    For the last, windows are sorted by a hash with their place in the low bits, all in one
    array of longs. Neighbours with equal hashes are the only candidates; these are compared
    as words. Texts with too many words for the places compare all their windows as words.
    """
    rows = docs.withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    trimmed = F.trim("__text", F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    rows = rows.withColumns({"__words": words, "__lines": lines})
    places = F.when(F.size("__words") >= 3, F.sequence(F.lit(0), F.size("__words") - 3)).otherwise(F.array().cast("array<int>"))
    three = lambda i: [F.get("__words", i + step) for step in range(3)]
    key = lambda i: F.xxhash64(*three(i)).bitwiseAND(F.lit(-PLACES)).bitwiseOR(i.cast("bigint"))
    rows = rows.withColumn("__keys", F.sort_array(F.transform(places, key)))

    # Neighbours with the same hash, as places in the text.
    hashed = lambda key: F.shiftright(key, PLACES.bit_length() - 1)
    beside = lambda key, i: (hashed(key) == hashed(F.get("__keys", i - 1))) | (hashed(key) == hashed(F.get("__keys", i + 1)))
    alike = F.transform(F.filter("__keys", lambda key, i: F.coalesce(beside(key, i), F.lit(False))), lambda key: key.bitwiseAND(F.lit(PLACES - 1)).cast("int"))
    rows = rows.withColumn("__alike", F.when(F.size("__words") > PLACES, places).otherwise(alike))
    window = lambda i: F.struct(*[w.alias(f"w{k}") for k, w in enumerate(three(i))], i.alias("i"))
    rows = rows.withColumn("__windows", F.sort_array(F.transform("__alike", window)))

    same = lambda a, b: (a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"])
    twice = F.filter("__windows", lambda w, i: F.coalesce(same(w, F.get("__windows", i - 1)), F.lit(False)) | F.coalesce(same(w, F.get("__windows", i + 1)), F.lit(False)))
    rows = rows.withColumn("__starts", F.sort_array(F.transform(twice, lambda w: w["i"])))
    covered = F.aggregate(
        F.transform("__starts", lambda at, i: F.least(F.lit(3), F.coalesce(F.get("__starts", i + 1) - at, F.lit(3)))),
        F.lit(0), lambda total, n: total + n,
    )
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.length("__text") - F.length(F.regexp_replace("__text", SYMBOLS, "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": covered,
    }
    rows = rows.withColumns({name: value.cast("bigint") for name, value in counts.items()})
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).drop("__text", "__words", "__lines", "__keys", "__alike", "__windows", "__starts")


def transformed(rows: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns({
        "x1": F.col("word_chars") / words,
        "x2": F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "x3": F.log1p(F.col("n_dup_lines").cast("double")),
        "x4": F.sqrt(F.col("n_repeat_words") / words),
    })


def chi2_tail(x: float, df: int) -> float:
    """Share of the chi-squared distribution above x, for an even number of degrees."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_quantile(tail: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_tail(middle, df) > tail else (low, middle)
    return high


def consistency(share: float, df: int) -> float:
    """What the covariance of the nearest share of a normal sample is multiplied by."""
    return share / (1 - chi2_tail(chi2_quantile(1 - share, df), df + 2))


def cholesky(rows: DataFrame) -> DataFrame:
    """Factors l_ij of the covariances c_ij, and the log of the determinant."""
    size = len(DIMENSIONS)
    for j in range(size):
        for i in range(j, size):
            rest = F.col(f"c_{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            value = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 * 1e-3))) if i == j else rest / F.col(f"l_{j}{j}")
            rows = rows.withColumn(f"l_{i}{j}", value)
    return rows.withColumn("log_det", sum(2 * F.log(f"l_{i}{i}") for i in range(size)))


PARTS = [f"m_{i}" for i in range(4)] + [f"l_{i}{j}" for i in range(4) for j in range(i + 1)] + ["log_det"]


def distance(rows: DataFrame) -> DataFrame:
    """``d2``: squared Mahalanobis distances by forward substitution."""
    solved = []
    for i, name in enumerate(DIMENSIONS):
        rest = F.col(name) - F.col(f"m_{i}")
        for k, before in enumerate(solved):
            rest = rest - F.col(f"l_{i}{k}") * F.col(before)
        solved.append(f"__z{i}")
        rows = rows.withColumn(f"__z{i}", rest / F.col(f"l_{i}{i}"))
    return rows.withColumn("d2", sum(F.col(z) * F.col(z) for z in solved)).drop(*solved)


def moments(rows: DataFrame, *keys: str) -> DataFrame:
    """Mean and floored covariance of the rows of each key, as parts of an estimate."""
    sums = [F.avg(x).alias(f"m_{i}") for i, x in enumerate(DIMENSIONS)]
    sums += [
        F.covar_pop(x, y).alias(f"c_{i}{j}")
        for i, x in enumerate(DIMENSIONS) for j, y in enumerate(DIMENSIONS[:i + 1])
    ]
    found = rows.groupBy(*keys).agg(*sums)
    return cholesky(found.withColumns({f"c_{i}{i}": F.col(f"c_{i}{i}") + FLOORS[i] ** 2 for i in range(4)})).select(*keys, *PARTS)


def histogram(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def below(counts: DataFrame, value: str, share: float, *keys: str) -> DataFrame:
    """(keys, edge): the smallest value up to which at least ``share`` of each key's rows lie; ``n`` counts rows."""
    upto = Window.partitionBy(*keys).orderBy(value)
    counts = counts.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy(*keys))})
    return counts.filter(F.col("upto") >= share * F.col("all")).groupBy(*keys).agg(F.min(value).alias("edge"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def starts(rows: DataFrame) -> DataFrame:
    """Two first estimates per cell: robust scales alone, and with the scatter of bounded scores."""
    steps = 100.0
    long = rows.select("cell", F.posexplode(F.array(*[F.least(F.floor(F.col(x) * steps / f), F.lit(100_000)) for x, f in zip(DIMENSIONS, FLOORS)])).alias("i", "level"))
    levels = stored(histogram(long, "cell", "i", "level"), "levels")
    median = below(levels, "level", 0.5, "cell", "i").withColumnRenamed("edge", "middle")
    off = levels.join(median, ["cell", "i"]).withColumn("off", F.abs(F.col("level") - F.col("middle")))
    off = off.groupBy("cell", "i", "off").agg(F.sum("n").alias("n"))
    mad = below(off, "off", 0.5, "cell", "i").withColumnRenamed("edge", "mad")
    both = median.join(mad, ["cell", "i"]).groupBy("cell").agg(*[
        F.max(F.when(F.col("i") == i, value)).alias(f"{name}_{i}")
        for i, f in enumerate(FLOORS)
        for name, value in (("m", (F.col("middle") + 0.5) * (f / steps)), ("s", F.greatest(F.lit(f), 1.4826 * F.col("mad") * (f / steps))))
    ])
    both = stored(both, "scales")
    zero = [F.lit(0.0).alias(f"l_{i}{j}") for i in range(4) for j in range(i)]
    first = both.select("cell", F.lit(0).alias("start"), *[f"m_{i}" for i in range(4)], *[F.col(f"s_{i}").alias(f"l_{i}{i}") for i in range(4)], *zero)
    first = first.withColumn("log_det", sum(2 * F.log(f"l_{i}{i}") for i in range(4))).select("cell", "start", *PARTS)
    scores = rows.join(both, "cell").select("cell", *[F.tanh((F.col(x) - F.col(f"m_{i}")) / F.col(f"s_{i}")).alias(x) for i, x in enumerate(DIMENSIONS)])
    bounded = moments_of_scores(scores).join(both, "cell")
    second = cholesky(bounded.withColumns({f"c_{i}{j}": F.col(f"r_{i}{j}") * F.col(f"s_{i}") * F.col(f"s_{j}") for i in range(4) for j in range(i + 1)}))
    return first.unionByName(second.withColumn("start", F.lit(1)).select("cell", "start", *PARTS))


def moments_of_scores(scores: DataFrame) -> DataFrame:
    sums = [F.covar_pop(x, y).alias(f"r_{i}{j}") for i, x in enumerate(DIMENSIONS) for j, y in enumerate(DIMENSIONS[:i + 1])]
    found = scores.groupBy("cell").agg(*sums)
    return found.withColumns({f"r_{i}{i}": F.col(f"r_{i}{i}") + 0.1 for i in range(4)})


def sized(frame: DataFrame) -> DataFrame:
    """The stored frame, marked for broadcast if it has few rows."""
    return F.broadcast(frame) if frame.limit(SMALL + 1).count() <= SMALL else frame


def estimate(rows: DataFrame) -> DataFrame:
    """The estimate of each cell: mean, Cholesky factor and log-determinant."""
    guess = stored(starts(rows), "mcd")
    for _ in range(STEPS):
        near = distance(rows.join(sized(guess), "cell")).withColumn("bin", F.floor(BINS * F.log2(F.col("d2") + 1e-3)))
        edge = stored(below(histogram(near, "cell", "start", "bin"), "bin", SHARE, "cell", "start"), "mcd-edge")
        chosen = near.select("cell", "start", "bin", *DIMENSIONS).join(sized(edge), ["cell", "start"]).filter(F.col("bin") <= F.col("edge"))
        guess = stored(moments(chosen, "cell", "start"), "mcd")
    best = guess.groupBy("cell").agg(F.min(F.struct("log_det", "start")).alias("best"))
    found = guess.join(best, "cell").filter(F.col("start") == F.col("best.start"))
    return found.select("cell", *PARTS)


def covariances(found: DataFrame, prefix: str) -> DataFrame:
    """Means and covariances of estimates, under names with a prefix."""
    entry = lambda i, j: sum(F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}") for k in range(j + 1))
    parts = [F.col(f"m_{i}").alias(f"{prefix}m_{i}") for i in range(4)]
    parts += [entry(i, j).alias(f"{prefix}c_{i}{j}") for i in range(4) for j in range(i + 1)]
    return found.select(F.col("cell").alias(f"{prefix}cell"), *parts)


def mixture(rows: DataFrame, one: str, other: str, weight: Column) -> DataFrame:
    """Means and covariances of two estimates together, the first with this weight, in place of the first."""
    off = lambda i: F.col(f"{one}m_{i}") - F.col(f"{other}m_{i}")
    blend = lambda name: weight * F.col(one + name) + (1 - weight) * F.col(other + name)
    mixed = {f"{one}m_{i}": blend(f"m_{i}") for i in range(4)}
    mixed |= {f"{one}c_{i}{j}": blend(f"c_{i}{j}") + weight * (1 - weight) * off(i) * off(j) for i in range(4) for j in range(i + 1)}
    return rows.withColumns(mixed)


def cell_names(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """The rows with the names of their cell, of their language and of all; null is a value of its own."""
    named = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in (lang, source)]
    return rows.withColumns({"__cell": F.to_json(F.array(*named)), "__wide": F.to_json(F.array(named[0])), "__all": F.lit("[]")})


def shrunk(vectors: DataFrame, found: DataFrame, shrink: int) -> DataFrame:
    """(__cell, parts): each cell's estimate, shrunk to its language's, and that to the one of all rows."""
    sizes = vectors.groupBy("__cell", "__wide").agg(F.count(F.lit(1)).alias("__n"))
    wide = sizes.groupBy("__wide").agg(F.sum("__n").alias("__wide_n"))
    sizes = stored(sizes.join(wide, "__wide"), "cell-sizes").withColumn("__all", F.lit("[]"))
    for level in ("__cell", "__wide", "__all"):
        sizes = sizes.join(sized(stored(covariances(found, level + "_"), "cell-estimates")), F.col(level) == F.col(f"{level}_cell"))
    share = lambda n: F.col(n) / (F.col(n) + F.lit(float(shrink)))
    mixed = mixture(mixture(sizes, "__wide_", "__all_", share("__wide_n")), "__cell_", "__wide_", share("__n"))
    parts = [F.col(f"__cell_m_{i}").alias(f"m_{i}") for i in range(4)] + [F.col(f"__cell_c_{i}{j}").alias(f"c_{i}{j}") for i in range(4) for j in range(i + 1)]
    return stored(cholesky(mixed.select("__cell", *parts)).select("__cell", *PARTS), "shrunk")


def verdicts(stats: DataFrame, lang: str, source: str, shrink: int = SHRINK, tail: float = 1e-6) -> DataFrame:
    """``distance2`` and ``kept`` for rows that have the base statistics."""
    names = ("__cell", "__wide", "__all")
    rows = cell_names(transformed(stats), lang, source)
    vectors = stored(rows.filter(~F.col("base_failed")).select(*names, *DIMENSIONS), "vectors")
    levels = vectors.select(F.explode(F.array(*names)).alias("cell"), *DIMENSIONS)
    cells = shrunk(vectors, stored(estimate(levels), "estimates"), shrink)
    found = distance(rows.join(sized(cells), "__cell", "left"))
    scaled = F.col("d2") / consistency(SHARE, len(DIMENSIONS))
    found = found.withColumn("distance2", F.when(~F.col("base_failed"), scaled))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("distance2"), F.lit(0.0)) <= chi2_quantile(tail, len(DIMENSIONS)))
    return found.withColumn("kept", kept).drop(*names, "d2", *DIMENSIONS, *PARTS)


def judge(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    shrink: int = SHRINK, tail: float = 1e-6,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the statistics, ``base_failed``, ``distance2`` and ``kept``."""
    names = {"doc_id": doc_id, "text": text, "lang": lang, "source": source}
    rows = docs.select(*[F.col(f"`{given}`").alias(name) for name, given in names.items()])
    stats = stored(base_statistics(rows).drop("text"), "statistics")
    return verdicts(stats, "lang", "source", shrink, tail).select("doc_id", *BASE, "base_failed", "distance2", "kept")
