"""Quality rules: fixed rules, and robust multivariate outliers per language and source.

Only DataFrame functions are used. Statistics are whole numbers, so their sums are exact and do not
depend on the order in which tasks finish.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm.common import read_table
from pagemill.sources.storage import BROADCAST_BYTES, stage

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
LEAST_WORDS = 10
REPEAT_PERCENT = 20

# Share of a group that the estimate is drawn from, and rounds of concentrating on the nearest rows. With
# half the rows the estimate holds until nearly half of a group is junk; more rows break earlier.
CORE_SHARE = 0.5
ROUNDS = 4
# A group with fewer rows takes the estimate of its language; a language with fewer has none.
LEAST_ROWS = 50
# Chance that a row of a normal distribution is rejected.
TAIL = 1e-9
# Distances are counted in steps of this share of a doubling.
STEPS = 64
# The statistics, in thousandths, with the least standard deviation that each is given: rows of a
# group may all have the same value.
FLOORS = {"symbols": 300, "capitals": 20, "length": 40, "repeats": 30}
STATS = list(FLOORS)
PAIRS = [(i, j) for i in range(len(STATS)) for j in range(i + 1)]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def with_base(documents: DataFrame) -> DataFrame:
    """`documents` with the counts of the fixed rules and `base_failed`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = documents.drop(*BASE, "base_failed").withColumns(
        {
            "_words": F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""),
            "_lines": F.filter(F.split(text, "\n"), lambda line: F.translate(line, BLANKS, "") != ""),
            "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
            "n_symbols": _count_of(text, SYMBOLS).cast("long"),
        }
    )
    word = F.col("_words")
    windows = F.when(
        F.size(word) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(word) - WINDOW),
            lambda i: F.xxhash64(*[word[i + k] for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<long>"))
    counted = counted.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": windows,
        }
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    counted = counted.withColumn(
        "n_repeat_words", F.when(repeats, _covered_words("_windows")).otherwise(F.lit(0)).cast("long")
    ).drop("_words", "_lines", "_windows")
    return counted.withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )


def _covered_words(windows: str) -> Column:
    """Words that lie in a window found twice or more: windows in the order of their hashes stand beside
    their equals; the starts of those, in order, each cover up to the next start."""
    numbered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(ordered: Column) -> Column:
        def same(k: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["h"], F.lit(None))

        marked = F.transform(
            ordered,
            lambda row, k: F.when(row["h"].eqNullSafe(same(k - 1)) | row["h"].eqNullSafe(same(k + 1)), row["i"]),
        )
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n,
        )

    # Each step is bound once, as the only element of an array, so that it is not computed anew.
    ordered = F.transform(F.array(numbered), starts)
    return F.transform(ordered, covered)[0]


def with_stats(counted: DataFrame) -> DataFrame:
    """The transformed statistics, as whole thousandths. Short texts are drawn towards the middle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    n, chars = F.col("n_words"), F.col("word_chars")
    values = {
        "symbols": F.log1p(100 * F.col("n_symbols") / (n + 20)),
        "capitals": _count_of(text, CAPITALS) / (chars + 100),
        "length": F.log((chars + 250) / (n + 50)),
        "repeats": F.col("n_repeat_words") / (n + 20),
    }
    return counted.withColumns({f"_{name}": F.round(1000 * value).cast("long") for name, value in values.items()})


def _key(column: str) -> Column:
    return F.col(f"`{column}`").cast("string")


def with_groups(stats: DataFrame) -> DataFrame:
    """One row for the row's language and source, and one for its language alone (null source marked)."""
    return stats.withColumn(
        "_scope", F.explode(F.array(F.struct(F.lit(True).alias("fine")), F.struct(F.lit(False).alias("fine"))))
    ).withColumn("_fine", F.col("_scope.fine")).drop("_scope").withColumn(
        "_source", F.when(F.col("_fine"), F.col("_source"))
    )


GROUP = ["_lang", "_fine", "_source"]


def _joined(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with what is known of their group; groups are copied to all tasks if they are measured small."""
    small = groups.count() * 1024 <= BROADCAST_BYTES
    groups = groups.select(*[F.col(c).alias(f"g{c}" if c in keys else c) for c in groups.columns])
    same = [F.col(c).eqNullSafe(F.col(f"g{c}")) for c in keys]
    on = same[0]
    for more in same[1:]:
        on = on & more
    return rows.join(F.broadcast(groups) if small else groups, on, "left").drop(*[f"g{c}" for c in keys])


def _moments(rows: DataFrame) -> DataFrame:
    """Number of rows, sums and sums of products by group. All whole numbers."""
    big = "decimal(38,0)"
    return rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(F.col(f"_{s}").cast(big)).alias(f"s{i}") for i, s in enumerate(STATS)],
        *[
            F.sum((F.col(f"_{STATS[i]}") * F.col(f"_{STATS[j]}")).cast(big)).alias(f"s{i}{j}")
            for i, j in PAIRS
        ],
    )


def _factored(moments: DataFrame, scale: float) -> DataFrame:
    """Means and the lower triangle L with L L' = scale * covariance + squares of the floors."""
    n = F.col("rows").cast("double")
    table = moments.withColumns({f"m{i}": F.col(f"s{i}").cast("double") / n for i in range(len(STATS))})
    for i, j in PAIRS:
        covariance = F.col(f"s{i}{j}").cast("double") / n - F.col(f"m{i}") * F.col(f"m{j}")
        value = F.lit(scale) * covariance
        if i == j:
            value = F.greatest(value, F.lit(0.0)) + F.lit(float(FLOORS[STATS[i]] ** 2))
        for k in range(j):
            value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # The floors keep the diagonal away from zero.
        value = F.sqrt(F.greatest(value, F.lit(1.0))) if i == j else value / F.col(f"l{j}{j}")
        table = table.withColumn(f"l{i}{j}", value)
    return table.select(
        *GROUP, "rows", *[f"m{i}" for i in range(len(STATS))], *[f"l{i}{j}" for i, j in PAIRS]
    )


def _distance() -> Column:
    """Squared Mahalanobis distance of a row from the estimate beside it, by forward substitution."""
    solved: list[Column] = []
    for i, name in enumerate(STATS):
        rest = F.col(f"_{name}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * solved[k]
        solved.append(rest / F.col(f"l{i}{i}"))
    total = solved[0] * solved[0]
    for z in solved[1:]:
        total = total + z * z
    return total


def _chi2_tail(x: float, degrees: int) -> float:
    """Chance above x for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, degrees // 2):
        term *= x / 2 / k
        total += term
    return math.exp(-x / 2) * total


def chi2_point(tail: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_tail(middle, degrees) > tail else (low, middle)
    return low


def core_scale() -> float:
    """Factor by which the covariance of the nearest share falls short for a normal distribution."""
    p = len(STATS)
    return CORE_SHARE / (1 - _chi2_tail(chi2_point(1 - CORE_SHARE, p), p + 2))


def estimates(stats: DataFrame) -> DataFrame:
    """The minimum-covariance-determinant estimate of every group: means and triangle.

    `stats` has one row per document and scope. The start is the row-wise median with the median
    deviations; then, `ROUNDS` times, the `CORE_SHARE` of rows nearest to the estimate gives the
    next one, which never has a larger determinant. The share is cut by counts of distance steps,
    rows of the last step included. Each round is two aggregates with pre-aggregation over narrow
    rows; a source with a third of all rows is no heavier than its counts.
    """
    middle = stats.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("rows"), *[F.median(f"_{s}").alias(f"m{i}") for i, s in enumerate(STATS)]
    )
    middle = stage(middle.filter(F.col("rows") >= LEAST_ROWS), "medians")
    spread = _joined(stats, middle.drop("rows"), GROUP).filter("m0 is not null").groupBy(*GROUP).agg(
        *[F.median(F.abs(F.col(f"_{s}") - F.col(f"m{i}"))).alias(f"d{i}") for i, s in enumerate(STATS)]
    )
    start = _joined(middle, spread, GROUP)
    for i, j in PAIRS:
        wide = F.greatest(1.4826 * F.col(f"d{i}"), F.lit(float(FLOORS[STATS[i]])))
        start = start.withColumn(f"l{i}{j}", wide if i == j else F.lit(0.0))
    current = stage(start.drop(*[f"d{i}" for i in range(len(STATS))]), "estimate")
    for _ in range(ROUNDS):
        step = F.floor(STEPS * F.log2(1 + _distance())).cast("int")
        placed = _joined(stats, current, GROUP).filter("m0 is not null").withColumn("_step", step)
        counts = placed.groupBy(*GROUP, "rows", "_step").agg(F.count(F.lit(1)).alias("_n"))
        up_to = Window.partitionBy(*GROUP).orderBy("_step")
        cut = (
            counts.withColumn("_seen", F.sum("_n").over(up_to))
            .filter(F.col("_seen") >= F.ceil(F.col("rows") * CORE_SHARE))
            .groupBy(*GROUP).agg(F.min("_step").alias("_cut"))
        )
        limited = stage(_joined(current, cut, GROUP), "cut")
        near = _joined(stats, limited.drop("rows"), GROUP).filter("m0 is not null").filter(step <= F.col("_cut"))
        moments = _moments(near)
        sizes = current.select(*GROUP, F.col("rows").alias("_all"))
        current = stage(
            _joined(_factored(moments, core_scale()), sizes, GROUP).withColumn("rows", F.col("_all")).drop("_all"),
            "estimate",
        )
    return current


def fit_quality(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The estimates, and the narrow table of all counts and statistics that they were drawn from."""
    counted = with_stats(with_base(documents)).withColumns({"_lang": _key("lang"), "_source": _key("source")})
    narrow = stage(
        counted.select("doc_id", *BASE, "base_failed", *[f"_{s}" for s in STATS], "_lang", "_source"), "quality"
    )
    return estimates(with_groups(narrow.filter("not base_failed"))), narrow


def judged(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """Rows with `distance` (null where there is no estimate), `by` and `kept`."""
    limit = chi2_point(TAIL, len(STATS))
    distance = _distance()
    names = [c for c in fitted.columns if c not in GROUP]
    fine = _joined(rows, fitted.filter("_fine").drop("_fine", "rows"), ["_lang", "_source"])
    fine = fine.withColumn("_own", distance).drop(*[c for c in names if c != "rows"])
    both = _joined(fine, fitted.filter("not _fine").drop("_fine", "_source", "rows"), ["_lang"])
    both = both.withColumn("distance", F.coalesce("_own", distance))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)
    return both.withColumn("kept", kept).drop("_own", *[c for c in names if c != "rows"])


def keep_good(documents: DataFrame) -> DataFrame:
    """The rows of `documents` that all rules keep, with their columns as they are.

    The fixed rules reject texts of fewer than `LEAST_WORDS` words or with more than `REPEAT_PERCENT` of
    100 words in repeated windows. The others are rejected if their statistics lie so far from the
    estimate of their language and source that a normal distribution has such a row with chance
    `TAIL`. The estimates are drawn from all rows that pass the fixed rules. Null languages and
    sources are groups of their own; groups with fewer than `LEAST_ROWS` rows use their language's
    estimate. Null text has no words. Repeated rows count each.
    """
    fitted, _ = fit_quality(documents)
    names = documents.columns
    whole = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), "text", "lang", "source")
    rows = with_stats(with_base(whole)).withColumns({"_lang": _key("lang"), "_source": _key("source")})
    # A number per row, which the filter names, keeps the filter above the projection: pushed below, it
    # would hold every count's expression within that of the next and split the text for every word.
    rows = rows.withColumn("_number", F.monotonically_increasing_id())
    kept = judged(rows, fitted).filter("kept and _number >= 0")
    return kept.select(*[F.col("_row")[c].alias(c) for c in names])


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for all documents."""
    fitted, narrow = fit_quality(read_table(spark, sf_dir, "documents"))
    return judged(narrow, fitted).select("doc_id", *BASE, "base_failed", "kept", "distance")
