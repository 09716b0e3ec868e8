"""Quantiles of the score table, per resolution."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The quantiles reported per score column.
TAILS = (0.025, 0.5, 0.975)
QUANTILES = {
    "rarity_zscore": ("rarity_quantiles", (0.025, 0.5, 0.75, 0.975)),
    "count_observations": ("count_observations_quantiles", TAILS),
    "count_species": ("count_species_quantiles", TAILS),
    "count_observers": ("count_observers_quantiles", TAILS),
    "confidence_scores": ("confidence_scores_quantiles", TAILS),
}

# approx_percentile is off by at most n / SKETCH_ACCURACY ranks
SKETCH_ACCURACY = 10_000
SLACK = 4 / SKETCH_ACCURACY


#: Bits of a value that a pass of ``radix_quantiles`` looks at; together they know all 64.
DIGIT_BITS = 16
PASSES = 64 // DIGIT_BITS


def summarize(
    scores: DataFrame, quantiles: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One row per resolution: exact interpolated quantiles of five columns; NULL where a
    column has no value. No group is gathered anywhere. ``quantiles`` is
    ``ranked_quantiles``, the quicker one on small tables, or ``radix_quantiles``, which
    ranks nothing and cannot miss."""
    lists = {
        name: F.array_sort(F.collect_list(
            F.when(F.col("column") == column, F.struct("probability", "quantile"))))
        for column, (name, _) in QUANTILES.items()
    }
    ranked = (quantiles or ranked_quantiles)(scores).groupBy("resolution").agg(
        *(entries.alias(name) for name, entries in lists.items()))
    every = scores.select("resolution").distinct()
    return every.join(F.broadcast(ranked), "resolution", "left").select("resolution", *(
        F.when(F.size(name) > 0, F.transform(name, lambda e: e["quantile"])).alias(name)
        for name in lists
    ))


def _bracketed(column: str, probabilities: tuple[float, ...]) -> Column:
    """Array of (probability, low, high) from the sketch array ``column``."""
    return F.array(*(
        F.struct(
            F.lit(p).alias("probability"),
            F.col(column)[2 * i].alias("low"),
            F.col(column)[2 * i + 1].alias("high"),
        )
        for i, p in enumerate(probabilities)
    ))


def _sketch(column: str, probabilities: tuple[float, ...]) -> Column:
    ends = [p for q in probabilities for p in (max(q - SLACK, 0.0), min(q + SLACK, 1.0))]
    return F.percentile_approx(
        F.col(column).cast("double"), F.array(*map(F.lit, ends)), SKETCH_ACCURACY
    )


def ranked_quantiles(scores: DataFrame) -> DataFrame:
    """(resolution, column, probability, quantile), exact, without gathering a
    group anywhere.

    A sketch brackets each quantile between two values. A second pass counts
    what lies below the bracket and ranks only the values inside it, about
    ``2 * SLACK`` of the group. The sketch decides how much is ranked, not the
    result; a bracket that misses its rank raises.
    """
    per_resolution = scores.groupBy("resolution").agg(
        *(
            _sketch(column, probabilities).alias(column)
            for column, (_, probabilities) in QUANTILES.items()
        ),
        *(F.count(column).alias(f"n_{column}") for column in QUANTILES),
    )
    # one row per resolution, column and probability: 16 rows a resolution
    entries = F.array(*(
        F.struct(
            F.lit(column).alias("column"),
            F.col(f"n_{column}").alias("rows"),
            _bracketed(column, probabilities).alias("brackets"),
        )
        for column, (_, probabilities) in QUANTILES.items()
    ))
    brackets = (
        per_resolution.select("resolution", F.inline(entries))
        .select("resolution", "column", "rows", F.inline("brackets"))
    )
    values = scores.select("resolution", F.inline(F.array(*(
        F.struct(F.lit(column).alias("column"), F.col(column).cast("double").alias("value"))
        for column in QUANTILES
    )))).filter(F.col("value").isNotNull())

    key = ["resolution", "column", "probability"]
    value = F.col("value")
    zone = F.when(value < F.col("low"), -1).when(value > F.col("high"), 1).otherwise(0)
    # what lies outside a bracket collapses to one row on either side
    counted = (
        values.join(F.broadcast(brackets), ["resolution", "column"])
        .withColumn("zone", zone)
        .withColumn("inside", F.when(F.col("zone") == 0, value))
        .groupBy(*key, "rows", "zone", "inside")
        .agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))
    )
    in_order = Window.partitionBy(*key).orderBy("zone", "inside")
    upto = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    position = F.col("probability") * (F.col("rows") - 1)
    ranked = counted.withColumn("upto", upto).withColumn("rank", F.floor(position))

    def at(rank: Column) -> Column:
        """Value of this rank (from 0) if it is known from this row."""
        first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
        return (
            F.when((F.col("zone") == 0) & rank.between(first, last), F.col("inside"))
            .when((F.col("zone") == -1) & (rank == last), F.col("most"))
            .when((F.col("zone") == 1) & (rank == first), F.col("least"))
        )

    picked = ranked.groupBy(*key).agg(
        F.max(at(F.col("rank"))).alias("lower"),
        F.max(at(F.col("rank") + 1)).alias("upper"),
        F.max(position - F.col("rank")).alias("fraction"),
        F.max(F.col("rows") > F.col("rank") + 1).alias("has_upper"),
    )
    missed = F.col("lower").isNull() | (F.col("has_upper") & F.col("upper").isNull())
    lower, upper = F.col("lower"), F.coalesce("upper", "lower")
    return picked.select(
        *key,
        F.when(missed, F.raise_error(F.lit("quantile outside its bracket")).cast("double"))
        .otherwise(lower + (upper - lower) * F.col("fraction")).alias("quantile"),
    )


def ordered_bits(value: Column) -> Column:
    """A long for each double, equal for equal ones and in their order: exponent and
    mantissa as they stand in the double's bits, negative below zero. Zeros are equal, and
    NaN, which follows infinity, too."""
    size = F.abs(value)
    # The logarithm may be rounded up or down to a whole number: then it is one off.
    guess = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    scaled = size / F.pow(F.lit(2.0), guess)
    exponent = F.greatest(
        guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0), F.lit(-1022))
    mantissa = size / F.pow(F.lit(2.0), exponent)  # below 1 for the smallest numbers only
    bits = ((exponent + 1022) * (1 << 52)).cast("long") + (mantissa * (1 << 52)).cast("long")
    bits = (
        F.when(F.isnan(value), 0x7FF8 << 48).when(size == float("inf"), 0x7FF0 << 48)
        .when(size == 0, 0).otherwise(bits)
    ).cast("long")
    return F.when(value < 0, -bits).otherwise(bits)


def radix_quantiles(scores: DataFrame) -> DataFrame:
    """(resolution, column, probability, quantile), exact, by radix selection.

    A quantile lies between the values of two ranks. Values are counted by the highest
    digit of their bits, which tells the digit of every wanted rank; only values that
    begin with the digits found so far are counted by the next one. No pass sorts or
    gathers values: it counts at most 2 ** DIGIT_BITS digits for each beginning, and counts
    are combined before they are shuffled. All columns, resolutions and ranks go
    through the same passes.
    """
    key = ["resolution", "column"]
    values = scores.select("resolution", F.inline(F.array(*(
        F.struct(F.lit(column).alias("column"), F.col(column).cast("double").alias("value"))
        for column in QUANTILES
    )))).filter(F.col("value").isNotNull()).withColumn("bits", ordered_bits(F.col("value")))

    probabilities = F.create_map(*(
        x for column, (_, ps) in QUANTILES.items()
        for x in (F.lit(column), F.array(*map(F.lit, ps)))
    ))
    wanted = None
    for number in range(1, PASSES + 1):
        left = 64 - DIGIT_BITS * number
        counted = values.withColumn("begins", F.shiftright("bits", left + DIGIT_BITS)) if wanted is not None else (
            values.withColumn("begins", F.lit(0).cast("long")))
        shared = [*key, "begins"]
        if wanted is not None:
            counted = counted.join(F.broadcast(wanted), shared)
        digits = counted.groupBy(
            *shared, *(["wanted"] if wanted is not None else []), F.shiftright("bits", left).alias("digit")
        ).agg(F.count("*").alias("n"), *([F.min("value").alias("value")] if left == 0 else []))
        inside = Window.partitionBy(*shared)
        upto = F.sum("n").over(inside.orderBy("digit"))
        digits = digits.withColumn("upto", upto)
        if wanted is None:
            # Ranks count from 0; the second one is the next, if there is one.
            position = F.col("probability") * (F.col("rows") - 1)
            ranked = digits.withColumn("rows", F.sum("n").over(inside)).select(
                "*", F.explode(probabilities[F.col("column")]).alias("probability"))
            asks = F.array(*(
                F.struct("probability", F.lit(upper).alias("upper"), (position - F.floor(position)).alias("fraction"),
                         F.least(F.floor(position) + int(upper), F.col("rows") - 1).alias("rank"))
                for upper in (False, True)
            ))
            ranked = ranked.withColumn("wanted", asks)
        else:
            ranked = digits
        # A rank within the values of a digit goes on, counted from the first of these.
        below = F.col("upto") - F.col("n")
        kept = F.transform(
            F.filter("wanted", lambda w: (w["rank"] >= below) & (w["rank"] < F.col("upto"))),
            lambda w: F.struct(w["probability"].alias("probability"), w["upper"].alias("upper"),
                               w["fraction"].alias("fraction"), (w["rank"] - below).alias("rank")))
        found = ranked.withColumn("wanted", kept).filter(F.size("wanted") > 0)
        if left:
            wanted = found.groupBy(*key, F.col("digit").alias("begins")).agg(
                F.flatten(F.collect_list("wanted")).alias("wanted"))
    ends = found.select(*key, "value", F.inline("wanted"))
    lower = F.max(F.when(~F.col("upper"), F.col("value")))
    upper = F.max(F.when(F.col("upper"), F.col("value")))
    return ends.groupBy(*key, "probability").agg(
        (lower + (upper - lower) * F.max("fraction")).alias("quantile"))


def cell_counts(scores: DataFrame) -> DataFrame:
    """Scored cells per resolution."""
    return scores.groupBy("resolution").agg(F.count("*").alias("n_cells"))
