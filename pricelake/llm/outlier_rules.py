"""Quality rules: word statistics of every text, and robust multivariate outliers per language and source.

All of it is DataFrame operations. Each text becomes five transformed statistics on a grid, so that sums are whole
numbers and results do not depend on the order of addition. For each group the minimum-covariance-determinant estimate
is sought: from three deterministic starts, the share `SUBSET` of rows that lie nearest gives a mean and a covariance, these
give new distances, and so on, until no determinant falls any more; the start with the smallest wins. Rows
beyond the chi-square cutoff of the corrected Mahalanobis distance are outliers.

One step is one aggregation: moments by group, start and a fine bin of the distance. The nearest rows are then the
lowest bins, found among a bounded number of rows for each group. A group of any size, or hot, is reduced before the shuffle.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricelake.llm.tables import SPACE_WORD, table
from pricelake.session import cut

GRID = 256
STATISTICS = ("size", "length", "symbols", "lines", "repeats")
# least standard deviation of each statistic: none rejects what is nearer than 5.07 of them, and each can reject alone
FLOORS = (0.25, 0.06, 0.10, 0.40, 0.06)
SUBSET = 0.75
LEAST_ROWS = 50      # smaller groups are judged with the other small groups of their language, then with all small ones
STEPS = 10
CUTOFF = 0.9999      # of the chi-square distribution
BINS = 64            # of the distance, for each factor e
SYMBOLS = "[#*$%&|<>]"

PAIRS = list(combinations_with_replacement(range(len(STATISTICS)), 2))


def chi_square(x: float, k: int) -> float:
    """Distribution function, by the series of the incomplete gamma function."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a)) if x > 0 else 0.0


def chi_square_quantile(share: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, k) < share else (low, middle)
    return high


def word_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines and n_repeat_words.

    Windows of three words are compared by 64-bit hashes. Null counts as empty. Columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")]
    text_of = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    step = docs.select(*(F.col(f"`{c}`") for c in kept), F.regexp_extract_all(text_of, F.lit(SPACE_WORD), F.lit(0)).alias("_w"),
                       F.filter(F.split(text_of, "\n", -1), lambda x: x.rlike(SPACE_WORD)).alias("_lines"),
                       F.regexp_count(text_of, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    step = step.withColumns({
        "n_words": F.size("_w").cast("long"), "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_h": F.slice(F.transform("_w", lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2))),
                      1, F.greatest(F.size("_w") - 2, F.lit(0)))}).drop("_w", "_lines")
    # only texts with a repeated window are looked at closer: windows by hash and place, those equal to a neighbour, their places
    step = step.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.array_sort(
        F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("_h")
    step = step.withColumn("_p", F.array_sort(F.transform(F.filter("_s", lambda e, i: (
        (i > 0) & (e["h"] == F.get("_s", i - 1)["h"])) | F.coalesce(e["h"] == F.get("_s", i + 1)["h"], F.lit(False))),
        lambda e: e["i"]))).drop("_s")
    covered = F.aggregate("_p", F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")), lambda done, i: F.struct(
        (done["n"] + F.least(F.lit(3), i - done["last"])).alias("n"), i.alias("last")))
    return step.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long")).drop("_p")


def transformed() -> list[Column]:
    """The statistics on the grid: logarithms of counts and shares."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = (F.log1p("n_words"), F.log(chars / words), F.log1p(100 * F.col("n_symbols") / chars),
              F.log1p(20 * F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.col("n_repeat_words") / words)
    return [F.round(v * GRID).cast("long").alias(f"_x{i}") for i, v in enumerate(values)]


def _groups(rows: DataFrame) -> DataFrame:
    """(_lang, _source) to the number of its group; null where even all small groups together are too few."""
    counts = rows.groupBy("_lang", "_source").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    level = F.when(~small, 0).when(F.sum("n").over(Window.partitionBy("_lang", small)) >= LEAST_ROWS, 1).otherwise(2)
    counts = counts.withColumn("level", level)
    counts = counts.withColumn("pool", F.sum("n").over(Window.partitionBy("level")))
    key = (F.col("level"), F.when(F.col("level") < 2, F.col("_lang")), F.when(F.col("level") < 1, F.col("_source")))
    number = F.dense_rank().over(Window.orderBy(*key))
    return counts.withColumn("number", number).select(
        "_lang", "_source", F.when((F.col("level") < 2) | (F.col("pool") >= LEAST_ROWS), F.col("number")).alias("_g"))


def _distance(rows: DataFrame) -> DataFrame:
    """Adds _d, the squared Mahalanobis distance from the row's _m (means) and _l (Cholesky factor)."""
    for i in range(len(STATISTICS)):
        inner = F.col(f"_x{i}") / GRID - F.col(f"_m{i}")
        for k in range(i):
            inner = inner - F.col(f"_l{i}{k}") * F.col(f"_z{k}")
        rows = rows.withColumn(f"_z{i}", inner / F.col(f"_l{i}{i}"))
    rows = rows.withColumn("_d", sum(F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(len(STATISTICS))))
    return rows.drop(*(f"_z{i}" for i in range(len(STATISTICS))))


def _estimates(rows: DataFrame) -> DataFrame:
    """Rows of (_g, _start, _x.., _d) to mean, Cholesky factor and log determinant of the nearest share of each."""
    binned = rows.withColumn("_bin", F.round(F.log(F.col("_d") + 1e-6) * BINS).cast("int"))
    sums = [F.sum(f"_x{i}").alias(f"_s{i}") for i in range(len(STATISTICS))]
    sums += [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_q{i}{j}") for i, j in PAIRS]
    by_bin = binned.groupBy("_g", "_start", "_bin").agg(F.count("*").alias("_n"), *sums)
    nearer = Window.partitionBy("_g", "_start").orderBy("_bin")
    before = F.sum("_n").over(nearer.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_n").over(Window.partitionBy("_g", "_start"))
    names = ["_n", *(f"_s{i}" for i in range(len(STATISTICS))), *(f"_q{i}{j}" for i, j in PAIRS)]
    near = (by_bin.withColumn("_take", F.coalesce(before, F.lit(0)) < SUBSET * total).filter("_take")
            .groupBy("_g", "_start").agg(*(F.sum(n).alias(n) for n in names)))
    return _factored(near)


def _factored(near: DataFrame) -> DataFrame:
    size = len(STATISTICS)
    mean = {f"_m{i}": F.col(f"_s{i}") / F.col("_n") / GRID for i in range(size)}
    step = near.withColumns(mean)
    # the floor's square joins each corrected variance, so that no determinant is 0
    step = step.withColumns({f"_c{i}{j}": F.col(f"_q{i}{j}") / F.col("_n") / GRID ** 2 - F.col(f"_m{i}") * F.col(f"_m{j}")
                             for i, j in PAIRS})
    step = step.withColumns({f"_c{i}{i}": F.greatest(F.col(f"_c{i}{i}"), F.lit(0.0)) + FLOORS[i] ** 2 / correction()
                             for i in range(size)})
    for i in range(size):
        own = F.col(f"_c{i}{i}")
        for k in range(i):
            own = own - F.col(f"_l{i}{k}") * F.col(f"_l{i}{k}")
        step = step.withColumn(f"_l{i}{i}", F.sqrt(F.greatest(own, F.lit(1e-9))))
        for j in range(i + 1, size):
            other = F.col(f"_c{i}{j}")
            for k in range(i):
                other = other - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            step = step.withColumn(f"_l{j}{i}", other / F.col(f"_l{i}{i}"))
    factor = [f"_l{i}{k}" for i in range(size) for k in range(i + 1)]
    return step.select("_g", "_start", *mean, *factor,
                       sum(F.log(f"_l{i}{i}") for i in range(size)).alias("_logdet"))


def correction() -> float:
    """What the covariance of the nearest share of a normal sample must be multiplied by."""
    size = len(STATISTICS)
    return SUBSET / chi_square(chi_square_quantile(SUBSET, size), size + 2)


def mcd(rows: DataFrame) -> DataFrame:
    """For each _g of rows (_g, _x0, ...): mean and factor of the smallest covariance determinant found."""
    size = len(STATISTICS)
    xs = [f"_x{i}" for i in range(size)]
    middles = cut(rows.groupBy("_g").agg(*(F.expr(f"percentile({x}, 0.5)").alias(f"_med{i}") for i, x in enumerate(xs))), "mcd")
    off = rows.join(middles, "_g").select("_g", *(F.abs(F.col(x) - F.col(f"_med{i}")).alias(x) for i, x in enumerate(xs)))
    spreads = off.groupBy("_g").agg(*(F.expr(f"percentile({x}, 0.5)").alias(f"_mad{i}") for i, x in enumerate(xs)))
    scales = cut(middles.join(spreads, "_g"), "mcd")
    z = [F.abs(F.col(x) - F.col(f"_med{i}")) / F.greatest(1.4826 * F.col(f"_mad{i}"), F.lit(FLOORS[i] * GRID)) for i, x in enumerate(xs)]
    starts = F.array(sum(v * v for v in z), sum(z) * sum(z), F.greatest(*z) * F.greatest(*z))
    state = cut(_estimates(rows.join(scales, "_g").select("_g", *xs, F.posexplode(starts).alias("_start", "_d"))), "mcd")
    for _ in range(STEPS):
        fresh = cut(_estimates(_distance(rows.join(state, "_g")).select("_g", "_start", *xs, "_d")), "mcd")
        better = (fresh.select("_g", "_start", F.col("_logdet").alias("now")).join(state, ["_g", "_start"])
                  .filter(F.col("now") < F.col("_logdet") - 1e-3).limit(1))
        moved = not better.isEmpty()
        state = fresh
        if not moved:
            break
    best = Window.partitionBy("_g").orderBy("_logdet", "_start")
    return cut(state.withColumn("_at", F.row_number().over(best)).filter("_at = 1").drop("_at", "_start", "_logdet"), "mcd")


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The columns of `docs` but the text, with the word statistics, base_failed, distance (null where there is no
    estimate) and kept.

    Base rules: fewer than 50 words, or more than half of them in repeated windows, fail. Estimates are made from texts
    that pass; null languages and sources are groups of their own. A text of a group for which even all small groups
    together have under `LEAST_ROWS` texts is kept. Repeated rows count each; an empty table stays empty.
    """
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text))
    stats = word_statistics(docs.select(others.alias("_row"), F.col(f"`{text}`").alias("_text"), F.col(f"`{lang}`").alias("_lang"),
                                        F.col(f"`{source}`").alias("_source")), "_text").drop("_text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = cut(stats.select("*", failed.alias("base_failed"), *transformed()), "word-statistics")
    groups = cut(_groups(rows.filter("not base_failed")), "outlier-groups")
    groups = groups.withColumnsRenamed({"_lang": "_gl", "_source": "_gs"})
    grouped = rows.join(groups, F.col("_lang").eqNullSafe(F.col("_gl")) & F.col("_source").eqNullSafe(F.col("_gs")), "left")
    estimates = mcd(grouped.filter("not base_failed and _g is not null")
                    .select("_g", *(f"_x{i}" for i in range(len(STATISTICS)))))
    found = _distance(grouped.join(estimates, "_g", "left"))
    distance = F.when(~F.col("base_failed"), F.sqrt(F.col("_d") / correction()))
    limit = math.sqrt(chi_square_quantile(CUTOFF, len(STATISTICS)))
    return found.select("_row.*", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        distance.alias("distance"),
                        (~F.col("base_failed") & F.coalesce(distance <= limit, F.lit(True))).alias("kept"))


def op2_outlier_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word statistics and verdict of every whole text."""
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).drop("lang", "source")
