"""Cell scores: how much rarer than their usual are the species observers find.

All resolutions are computed in one job: ``resolution`` is a grouping key. The
flow is

    observations            wide, one shuffle by observer
    -> species per (resolution, cell, observer), in the same stage
    -> (resolution, cell, observer) mean rarity and counts
    -> (resolution, cell) residual, counts, effective observers

Observations are shuffled before they are unpivoted, never five-fold. What is
shuffled afterwards is an aggregate of the step before, combined map-side, so no
key, however hot, brings more than one row per map task and group to a reducer.
The cell columns may hold any long; the grid is not called here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexrarity.config import EDGE_LENGTH_M, RESOLUTIONS, cell_column
from hexrarity.operators.observations import to_long
from hexrarity.operators.skew import join_dimension, tasks_for

CELL = ["resolution", "cell"]
CELL_OBSERVER = [*CELL, "recordedBy"]
CELL_OBSERVER_SPECIES = [*CELL_OBSERVER, "speciesKey"]


def _bits(conditions: Mapping[int, str]) -> str:
    """SQL for an integer whose bit r is set where the condition of r is true."""
    return " | ".join(
        f"CASE WHEN {condition} THEN {1 << r} ELSE 0 END" for r, condition in conditions.items()
    )


def observer_extents(
    observations: DataFrame, resolutions: Sequence[int] = RESOLUTIONS
) -> DataFrame:
    """One row per observer: ``observer_rows``, and ``multi``, whose bit r says
    that their records fall in at least two cells of resolution r.

    Wide on purpose: the observations are aggregated without being unpivoted.
    """
    conditions = {
        r: f"min({cell_column(r)}) != max({cell_column(r)})" for r in resolutions
    }
    return (
        observations.filter(F.col("recordedBy").isNotNull())
        .groupBy("recordedBy")
        .agg(
            F.count("*").alias("observer_rows"),
            F.expr(f"{_bits(conditions)} AS multi"),
        )
    )


def valid_observers(
    observations: DataFrame, resolutions: Sequence[int] = RESOLUTIONS
) -> DataFrame:
    """(resolution, recordedBy) of the observers seen in two or more cells."""
    numbers = ", ".join(map(str, resolutions))
    return (
        observer_extents(observations, resolutions)
        .selectExpr("recordedBy", "multi", f"explode(array({numbers})) AS resolution")
        .filter("(multi & shiftleft(1, resolution)) != 0")
        .select("resolution", "recordedBy")
    )


def scored_observations(
    observations: DataFrame,
    occupancy: DataFrame,
    resolutions: Sequence[int] = RESOLUTIONS,
    edge_m: Mapping[int, float] = EDGE_LENGTH_M,
    limit_bytes: int | None = None,
    rows_per_salt: int | None = None,
) -> DataFrame:
    """Long observations that count for scoring: by an observer valid at that
    resolution, and located more precisely than the cell's edge length. ``rarity``
    is that of the species, NULL if it has no occupancy. Equal rows come as one row
    with their number in ``n``.

    Validity comes from all observations, precise or not. The coarsest edge is
    applied before the joins, so that the scan can skip row groups by it.

    The result is partitioned by observer and ``_salt``, which is taken from the
    species and differs only for hot observers. All rows of an observer and
    species are in one task, so ``species_counts`` needs no shuffle, and observer
    means are combined almost fully before theirs.
    """
    resolutions = tuple(resolutions)
    sizes = {"limit_bytes": limit_bytes, "rows_per_salt": rows_per_salt}
    uncertainty = "coordinateUncertaintyInMeters"
    cells = [cell_column(r) for r in resolutions]
    extents = observer_extents(observations, resolutions).filter("multi != 0")
    conditions = {r: f"{uncertainty} <= {float(edge_m[r])!r}D" for r in resolutions}
    precise = observations.filter(
        (F.col(uncertainty) <= max(edge_m[r] for r in resolutions))
        & F.col("recordedBy").isNotNull()
    ).selectExpr(
        "recordedBy", "speciesKey", *cells, f"{_bits(conditions)} AS precise", "1L AS n"
    )
    # Merge an observer's repeats of a species in a place before the shuffles by a
    # single key: afterwards one observer and species have at most a few rows per cell,
    # however many copies there were.
    keys = [c for c in precise.columns if c != "n"]
    precise = precise.groupBy(*keys).agg(F.count("*").alias("n"))
    rated = join_dimension(
        precise,
        occupancy.select("speciesKey", "rarity", "n_observations"),
        key="speciesKey", weight="n_observations", spread_by=["recordedBy", *cells],
        how="left", **sizes,
    )
    joined = join_dimension(
        rated, extents, key="recordedBy", weight="observer_rows",
        spread_by=["speciesKey"], partition=True, tasks=tasks_for(observations), **sizes,
    )
    counted = joined.withColumn("wanted", F.expr("multi & precise")).drop("multi", "precise")
    return to_long(counted, resolutions, "wanted")


def species_counts(scored: DataFrame) -> DataFrame:
    """Observations per (resolution, cell, observer, species), with the rarity."""
    return scored.groupBy(*CELL_OBSERVER_SPECIES, "_salt").agg(
        F.sum("n").alias("n"), F.max("rarity").alias("rarity")
    )


def observer_rarity(counts: DataFrame) -> DataFrame:
    """Per (resolution, cell, observer): observations and the mean rarity of the
    species found, each species once; NULL if none of them has an occupancy.

    The filter is always true. It makes every consumer need ``n``, so their
    plans below it stay equal after column pruning and share one shuffle.
    """
    return (
        counts.groupBy(*CELL_OBSERVER)
        .agg(F.sum("n").alias("n"), F.avg("rarity").alias("mean_rarity"))
        .filter("n > 0")
    )


def observer_baseline(rarity: DataFrame) -> DataFrame:
    """Unweighted mean over an observer's cells of their mean rarity, and their number.

    The filter is always true: the list of hot observers, which needs the number only,
    asks for the same columns as the baselines and shares their shuffles.
    """
    return rarity.groupBy("resolution", "recordedBy").agg(
        F.avg("mean_rarity").alias("baseline"), F.count("*").alias("observer_cells")
    ).filter("observer_cells > 0 OR baseline > 0")


def residuals(rarity: DataFrame, **join_options) -> DataFrame:
    """``observer_rarity`` rows with the deviation from the observer's baseline.

    An observer has a row per cell here. One name may stand for an institution and hold
    most cells of a resolution, so an observer with very many cells is salted by cell.
    (AQE would not split this join: the baseline side is an aggregate.)
    """
    joined = join_dimension(
        rarity, observer_baseline(rarity), key=["resolution", "recordedBy"],
        weight="observer_cells", spread_by=["cell"], **join_options,
    )
    return joined.withColumn("residual", F.col("mean_rarity") - F.col("baseline"))


def effective_observers(total: Column, sum_n_ln_n: Column) -> Column:
    """exp of the Shannon entropy of observer shares.

    With shares n/N, ``-sum(p ln p) = ln N - sum(n ln n) / N``, which needs no
    second pass for the total. Rounding may leave it below 0 by 1e-16.
    """
    return F.exp(F.greatest(F.ln(total) - sum_n_ln_n / total, F.lit(0.0)))


def confidence(
    neff: Column, observations: Column, k_neff: float = 4, k_obs: float = 40
) -> Column:
    return (1 - F.exp(-neff / k_neff)) * (1 - F.exp(-observations / k_obs))


def cell_diversity(rarity: DataFrame) -> DataFrame:
    """Per cell: observations, observers and effective observers."""
    n_ln_n = F.col("n") * F.ln("n")
    return (
        rarity.groupBy(*CELL)
        .agg(
            F.sum("n").alias("count_observations"),
            F.count("*").alias("count_observers"),
            F.sum(n_ln_n).alias("_n_ln_n"),
        )
        .withColumn(
            "neff_observers",
            effective_observers(F.col("count_observations"), F.col("_n_ln_n")),
        )
        .drop("_n_ln_n")
    )


def score_cells(
    observations: DataFrame,
    occupancy: DataFrame,
    resolutions: Sequence[int] = RESOLUTIONS,
    edge_m: Mapping[int, float] = EDGE_LENGTH_M,
    k_neff: float = 4,
    k_obs: float = 40,
    **join_options,
) -> DataFrame:
    """Score table of all resolutions (``hexrarity.schemas.SCORES``).

    Observer rows and distinct-species rows of a cell meet in one union and one
    aggregate: one shuffle by cell, no join of two per-cell tables.

    Rows without a cell count for an observer's baseline but are not scored. They
    are removed by an aggregate (``_named``) rather than by the key: a filter on
    the key would be pushed into two of the three branches that read the counts,
    which could then no longer share their shuffle.
    """
    scored = scored_observations(
        observations, occupancy, resolutions, edge_m, **join_options
    )
    rarity = observer_rarity(species_counts(scored))
    by_observer = residuals(rarity, **join_options).selectExpr(
        *CELL, "n", "n * ln(n) AS n_ln_n", "residual", "1 AS observer",
        "CAST(NULL AS BIGINT) AS speciesKey",
    )
    # asks for the same columns as the other branch, to share its shuffle
    by_species = scored.groupBy(*CELL, "speciesKey").agg(
        F.sum("n").alias("n"), F.max("rarity").alias("rarity")
    ).filter("n > 0 OR rarity > 0").selectExpr(
        *CELL, "0L AS n", "0D AS n_ln_n", "CAST(NULL AS DOUBLE) AS residual",
        "0 AS observer", "speciesKey",
    )
    total = F.col("count_observations")
    return (
        by_observer.unionByName(by_species)
        .groupBy(*CELL)
        .agg(
            F.count("cell").alias("_named"),
            F.avg("residual").alias("rarity_zscore"),
            F.count("speciesKey").alias("count_species"),
            F.sum("n").alias("count_observations"),
            F.sum("observer").alias("count_observers"),
            F.sum("n_ln_n").alias("_n_ln_n"),
        )
        .filter((F.col("_named") > 0) & F.col("rarity_zscore").isNotNull())
        .withColumn(
            "confidence_scores",
            confidence(effective_observers(total, F.col("_n_ln_n")), total, k_neff, k_obs),
        )
        .drop("_n_ln_n", "_named")
    )
