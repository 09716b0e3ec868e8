"""One query per operator on the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from hexrarity.config import RESOLUTIONS, cell_column
from hexrarity.functions.geometry import unwrap_dateline
from hexrarity.functions.grid import cell_hex, cell_to_boundary, hex_cell
from hexrarity.operators import features, observations, occupancy, scores, style, summary, tiles
from hexrarity.schemas import SCORE_COLUMNS
from hexrarity.sources.occurrences import read_occurrences
from hexrarity.sources.tables import (
    read_scores, summary_json, write_geojsonseq, write_scores,
)

DROP_RATE = 2.5

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, without negative zeros: sums depend on their order."""
    def tidy(name: str, kind: str) -> Column:
        if kind == "double":
            return (F.round(name, places) + 0.0).alias(name)
        if kind == "array<double>":
            return F.transform(name, lambda x: F.round(x, places) + 0.0).alias(name)
        return F.col(name)

    return df.select(*(tidy(name, kind) for name, kind in df.dtypes))


def ring_text(ring: Column, places: int = 6) -> Column:
    """Ring as ``x y,x y,...`` in whole micro-units, equal in any engine."""
    scale = 10**places
    return F.array_join(F.transform(ring, lambda p: F.concat_ws(
        " ",
        F.round(p["lng"] * scale).cast("long").cast("string"),
        F.round(p["lat"] * scale).cast("long").cast("string"),
    )), ",")


def tile_ring_text(ring: Column) -> Column:
    return F.array_join(F.transform(
        ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
    ), ",")


# -- observations ------------------------------------------------------------

def filter_observations(spark, sf):
    return rounded(fixture.filtered(spark, sf))


def country_filter(spark, sf):
    return rounded(fixture.filtered(spark, sf, " it "))


def filtered_stats(spark, sf):
    return observations.observation_stats(fixture.filtered(spark, sf))


def assign_cells(spark, sf):
    cells = observations.assign_cells(fixture.filtered(spark, sf))
    return cells.select("gbifID", *(cell_column(r) for r in RESOLUTIONS))


def to_long(spark, sf):
    table = fixture.observation_table(spark, sf).select(
        "gbifID", *(cell_column(r) for r in RESOLUTIONS)
    )
    return observations.to_long(table)


# -- occupancy ---------------------------------------------------------------

def species_occupancy(spark, sf):
    return rounded(occupancy.species_occupancy(fixture.observation_table(spark, sf)))


def occupancy_stats(spark, sf):
    table = occupancy.species_occupancy(fixture.observation_table(spark, sf))
    return rounded(occupancy.occupancy_stats(table))


# -- scores ------------------------------------------------------------------

def valid_observers(spark, sf):
    return scores.valid_observers(fixture.observation_table(spark, sf))


def _scored(spark, sf):
    return scores.scored_observations(
        fixture.observation_table(spark, sf), fixture.occupancy_table(spark, sf)
    )


def _counts(spark, sf):
    return scores.species_counts(_scored(spark, sf))


def _rarity(spark, sf):
    return scores.observer_rarity(_counts(spark, sf))


def precise_observations(spark, sf):
    # (What is merged differs in coordinates' precision, which is not kept.)
    return _scored(spark, sf).groupBy(*scores.CELL_OBSERVER_SPECIES).agg(
        F.sum("n").alias("n_observations"))


def distinct_cell_species_observer(spark, sf):
    return _counts(spark, sf).select(*scores.CELL_OBSERVER_SPECIES)


def observer_counts_by_cell(spark, sf):
    return _rarity(spark, sf).select(*scores.CELL_OBSERVER, F.col("n").alias("obs_by_observer"))


def mean_rarity_cell_observer(spark, sf):
    table = _rarity(spark, sf).filter(F.col("mean_rarity").isNotNull())
    return rounded(table.select(*scores.CELL_OBSERVER, "mean_rarity"))


def observer_baseline(spark, sf):
    return rounded(scores.observer_baseline(_rarity(spark, sf)).drop("observer_cells"))


def residuals(spark, sf):
    table = scores.residuals(_rarity(spark, sf))
    return rounded(table.select(*scores.CELL_OBSERVER, "residual"))


def cell_metrics(spark, sf):
    table = fixture.score_table(spark, sf)
    return table.select(
        *scores.CELL, "count_observations", "count_species", "count_observers"
    )


def shannon_neff(spark, sf):
    table = scores.cell_diversity(_rarity(spark, sf))
    return rounded(table.select(*scores.CELL, "neff_observers"))


def confidence(spark, sf):
    table = scores.cell_diversity(_rarity(spark, sf))
    return rounded(table.select(
        *scores.CELL,
        scores.confidence(F.col("neff_observers"), F.col("count_observations"))
        .alias("confidence_scores"),
    ))


def cell_scores(spark, sf):
    table = fixture.observation_table(spark, sf)
    return rounded(scores.score_cells(table, occupancy.species_occupancy(table)))


def cell_scores_country(spark, sf):
    table = fixture.stored(
        spark, sf, "observations_it",
        lambda: fixture.lattice_cells(fixture.filtered(spark, sf, "IT")),
    )
    return rounded(scores.score_cells(table, occupancy.species_occupancy(table)))


def hot_key_join(spark, sf):
    """``cell_scores`` with broadcasts ruled out and hot keys split, so that the
    joins meant for large tables give the same result."""
    table = fixture.observation_table(spark, sf)
    return rounded(scores.score_cells(
        table, fixture.occupancy_table(spark, sf), limit_bytes=0, rows_per_salt=50
    ))


# -- summary -----------------------------------------------------------------

def score_summary(spark, sf):
    return rounded(summary.summarize(rounded(fixture.score_table(spark, sf))))


def score_summary_ranked(spark, sf):
    """The same quantiles one by one, before they are put in lists."""
    return rounded(summary.ranked_quantiles(rounded(fixture.score_table(spark, sf))))


def score_summary_radix(spark, sf):
    return rounded(summary.summarize(rounded(fixture.score_table(spark, sf)), summary.radix_quantiles))


def score_summary_json(spark, sf):
    # each entry with its place in the object, and all lists
    made = rounded(summary.summarize(rounded(fixture.score_table(spark, sf))))
    lists = [name for name in made.columns if name != "resolution"]
    text = summary_json(made).select(
        "value", F.posexplode(F.json_object_keys("value")).alias("place", "resolution"))
    entry = F.from_json("value", "map<string, struct<" + ", ".join(
        f"{name}: array<double>" for name in lists) + ">>")
    return text.select("place", "resolution", entry[F.col("resolution")].alias("s")).select(
        "place", "resolution", *(f"s.{name}" for name in lists))


def cell_counts(spark, sf):
    return summary.cell_counts(fixture.score_table(spark, sf))


# -- features ----------------------------------------------------------------

def feature_guard(spark, sf):
    # cells whose scores are made incomplete are left out
    table = rounded(fixture.score_table(spark, sf)).withColumn(
        "rarity_zscore", F.when(F.col("count_observers") > 1, F.col("rarity_zscore"))
    )
    return features.complete_scores(table)


def dateline_unwrap(spark, sf):
    table = fixture.lattice_ring(fixture.score_table(spark, sf))
    return table.select(
        "resolution", "cell", ring_text(unwrap_dateline(F.col("ring"))).alias("ring")
    )


def cell_bbox(spark, sf):
    table = features.cell_bbox(fixture.lattice_features(spark, sf))
    return rounded(table.select("resolution", "cell", "swlat", "swlng", "nelat", "nelng"))


def cell_links(spark, sf):
    table = features.cell_links(features.cell_bbox(fixture.lattice_features(spark, sf)))
    return table.select("resolution", "cell", "url")


def cell_lookup(spark, sf):
    # the cell with the largest id of each resolution, found by its hex text
    table = fixture.hexagon_score_table(spark, sf)
    wanted = table.groupBy("resolution").agg(cell_hex(F.max("cell")).alias("h3"))
    found = features.find_cells(table, *(r["h3"] for r in wanted.collect()), "0", "no id")
    return rounded(found.select(
        "resolution", "h3", hex_cell(F.col("h3")).alias("cell"), *SCORE_COLUMNS))


def feature_json(spark, sf):
    table = fixture.lattice_features(spark, sf).select(
        "resolution", "cell", features.feature_json().alias("json")
    )
    field = lambda path: F.get_json_object("json", path)
    return table.select(
        "resolution", "cell", field("$.type").alias("type"),
        field("$.geometry.type").alias("geometry_type"),
        field("$.properties.h3").alias("h3"),
        field("$.properties.count_species").cast("long").alias("count_species"),
        F.round(field("$.geometry.coordinates[0][0][0]").cast("double"), 6).alias("first_lng"),
        F.round(field("$.geometry.coordinates[0][2][1]").cast("double"), 6).alias("third_lat"),
    )


def hexagon_boundaries(spark, sf):
    # corners and edge crossings as a sorted list: SQL may start a ring elsewhere
    table = fixture.hexagon_score_table(spark, sf).select(
        "resolution", "cell", cell_to_boundary(F.col("cell")).alias("ring")
    )
    return table.select(
        "resolution", "cell", F.size("ring").cast("long").alias("n_vertices"),
        F.array_join(F.array_sort(F.split(ring_text(F.col("ring"), 5), ",")), ",").alias("vertices"),
    )


def hexagon_features(spark, sf):
    # read back from the GeoJSON text: what does not depend on where a ring starts
    table = features.cell_features(rounded(fixture.hexagon_score_table(spark, sf)))
    feature = F.from_json(
        features.feature_json(),
        "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, "
        "properties struct<h3: string, rarity_zscore: double, count_species: long, "
        "count_observations: long, count_observers: long, confidence_scores: double>",
    )
    ring, lats = F.col("f.geometry.coordinates")[0], F.col("lats")
    return (
        table.select("resolution", feature.alias("f"))
        .select("*", F.transform(ring, lambda p: p[1]).alias("lats"))
        .select(
            "resolution", "f.properties.*", F.size(lats).cast("long").alias("n_positions"),
            (ring[0] == F.element_at(ring, -1)).alias("closed"),
            (F.round(F.array_min(lats), 5) + 0.0).alias("swlat"),
            (F.round(F.array_max(lats), 5) + 0.0).alias("nelat"),
        )
    )


def hexagon_tiles(spark, sf):
    table = features.cell_features(rounded(fixture.hexagon_score_table(spark, sf)))
    tiled = tiles.tile_features(table, drop_rate=DROP_RATE)
    return tiled.select(
        *tiles.TILE, "h3", *SCORE_COLUMNS,
        tile_ring_text(F.col("rings")[0]).alias("ring"), "layer",
    )


def hexagon_cell_scores(spark, sf):
    """Scores on hexagons: counts that do not depend on how a cell is named."""
    return rounded(fixture.hexagon_score_table(spark, sf))


# -- tiles -------------------------------------------------------------------

def zoom_to_resolution(spark, sf):
    # every order line counted at the zoom of its quantity
    zooms = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        (F.col("l_quantity").cast("int") % 14).alias("zoom")
    )
    return (
        zooms.groupBy("zoom").agg(F.count("*").alias("n"))
        .select("zoom", tiles.zoom_to_resolution(F.col("zoom")).alias("resolution"), "n")
    )


def tile_index(spark, sf):
    table = tiles.tile_index(fixture.lattice_features(spark, sf))
    return table.select(*tiles.TILE, "cell")


def tile_thinning(spark, sf):
    table = tiles.tile_index(fixture.lattice_features(spark, sf))
    return tiles.thin_tiles(table, DROP_RATE).select(*tiles.TILE, "cell")


def tile_thinning_by_place(spark, sf):
    ranked = tiles.rank_by_place(fixture.lattice_features(spark, sf))
    table = tiles.thin_by_place(tiles.tile_index(ranked), DROP_RATE)
    return table.select(*tiles.TILE, "cell")


def tile_coalesce(spark, sf):
    table = tiles.tile_index(fixture.lattice_features(spark, sf))
    merged = tiles.coalesce_tiles(table, ["count_species", "count_observers"])
    # every ring by its south-west and north-east corner, sorted
    corners = F.array_sort(F.transform("rings", lambda ring: F.concat_ws(
        " ", *(F.round(end(F.transform(ring, lambda p: p[axis])) * 1000000).cast("long").cast("string")
               for axis in ("lng", "lat") for end in (F.array_min, F.array_max)))))
    return merged.select(
        *tiles.TILE, "count_species", "count_observers", "n_features",
        F.size("rings").cast("long").alias("n_rings"), F.array_join(corners, ",").alias("boxes"),
    )


def tile_dissolve(spark, sf):
    """The outline of equal features of a tile, by its directed edges."""
    table = tiles.tile_index(fixture.lattice_features(spark, sf))
    merged = tiles.dissolve_tiles(table, ["count_species", "count_observers"])

    def micro(p: Column) -> Column:
        return F.concat_ws(" ", *(
            F.round(p[axis] * 1000000).cast("long").cast("string") for axis in ("lng", "lat")))

    edges = F.flatten(F.transform("rings", lambda ring: F.filter(F.transform(
        ring, lambda p, i: F.when(F.get(ring, i - 1) != p, F.concat_ws(" ", micro(F.get(ring, i - 1)), micro(p)))),
        lambda e: e.isNotNull())))
    return merged.select(
        *tiles.TILE, "count_species", "count_observers", "n_features",
        F.size(edges).cast("long").alias("n_edges"), F.array_join(F.array_sort(edges), ",").alias("edges"))


def tile_snap(spark, sf):
    table = tiles.snap_tiles(tiles.tile_index(fixture.lattice_features(spark, sf)))
    return table.select(*tiles.TILE, "cell", tile_ring_text(F.col("ring")).alias("ring"))


def tile_layer(spark, sf):
    table = tiles.tile_features(fixture.lattice_features(spark, sf), coalesce=True)
    return table.groupBy("layer", "resolution", "z").agg(
        F.sum("n_features").alias("n_features")
    )


def feature_counts(spark, sf):
    return tiles.feature_counts(fixture.lattice_features(spark, sf))


# -- style -------------------------------------------------------------------

def _styled(spark, sf, metric):
    table = rounded(fixture.score_table(spark, sf))
    return style.style_cells(table, rounded(summary.summarize(table)), metric)


def style_rarity(spark, sf):
    return _styled(spark, sf, "rarity_zscore").select("resolution", "cell", "fill_color")


def style_counts(spark, sf):
    parts = [
        _styled(spark, sf, metric).select(
            "resolution", "cell", F.lit(metric).alias("metric"), "fill_color"
        )
        for metric in ("count_observations", "count_species", "count_observers")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def style_defaults(spark, sf):
    # resolutions without a summary row take the default domain
    table = rounded(fixture.score_table(spark, sf))
    coarse = rounded(summary.summarize(table)).filter("resolution < 5")
    both = style.style_cells(table, coarse, "count_species")
    rarity = style.style_cells(table, coarse, "rarity_zscore").select(
        "resolution", "cell", F.col("fill_color").alias("rarity_color")
    )
    return both.select("resolution", "cell", "fill_color").join(rarity, ["resolution", "cell"])


def style_opacity(spark, sf):
    table = _styled(spark, sf, "rarity_zscore")
    return rounded(table.select("resolution", "cell", "fill_opacity"), 9)


# -- edges: what is written and read again ------------------------------------

def read_tsv(spark, sf):
    raw = read_occurrences(spark, fixture.raw_file(spark, sf))
    return rounded(observations.filter_observations(raw))


def _with_locality(raw):
    """The locality, which is quoted in some rows, shows behind the observer."""
    place = F.coalesce(F.concat(F.lit("|"), "locality"), F.lit(""))
    return rounded(observations.filter_observations(
        raw.withColumn("recordedBy", F.concat("recordedBy", place))))


def read_faulty_tsv(spark, sf):
    return _with_locality(read_occurrences(spark, fixture.raw_file(spark, sf, faulty=True)))


def read_multiline_tsv(spark, sf):
    return _with_locality(fixture.multiline_table(spark, sf))


def read_utf16_tsv(spark, sf):
    parts = [
        observations.filter_observations(
            read_occurrences(spark, fixture.raw_file(spark, sf, order))
        ).withColumn("order", F.lit(order))
        for order in ("UTF-16LE", "UTF-16BE")
    ]
    return rounded(parts[0].unionByName(parts[1]))


def geojson_lines(spark, sf):
    path = f"{fixture.shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    written = write_geojsonseq(fixture.lattice_features(spark, sf), path, RESOLUTIONS, 500)
    lines = spark.read.text(path)
    field = lambda name: F.get_json_object("value", f"$.properties.{name}")
    counts = F.create_map(*(F.lit(x) for pair in written.items() for x in pair))
    return lines.select(
        F.col("resolution").cast("int").alias("resolution"), field("h3").alias("h3"),
        field("count_species").cast("long").alias("count_species"),
        field("count_observers").cast("long").alias("count_observers"),
        F.get_json_object("value", "$.geometry.coordinates[0][4]").isNotNull().alias("closed"),
    ).withColumn("written", counts[F.col("resolution")].cast("long"))


def clustered_scores(spark, sf):
    path = f"{fixture.shared_folder(spark)}/scores-{uuid.uuid4().hex}"
    rows = write_scores(rounded(fixture.score_table(spark, sf)), path)
    return read_scores(spark, path).withColumn("written", F.lit(rows).cast("long"))


def whole_run_counts(spark, sf):
    """What the drawing and tiling stages of a run have stored: features, and those that the
    tiles of the finest zoom hold."""
    store = fixture.whole_run(spark, sf)
    drawn = store.table("features").groupBy("resolution").agg(F.count("*").alias("n_drawn"))
    finest = store.table("tiles").groupBy("resolution", "h3").agg(F.max("z").alias("z"))
    tiled = finest.groupBy("resolution").agg(F.count("*").alias("n_tiled"), F.max("z").alias("max_zoom"))
    return drawn.join(tiled, "resolution")


def whole_run(spark, sf):
    return rounded(fixture.whole_run(spark, sf).table("scores"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        filter_observations, country_filter, filtered_stats, assign_cells, to_long,
        species_occupancy, occupancy_stats, valid_observers, precise_observations,
        distinct_cell_species_observer, observer_counts_by_cell,
        mean_rarity_cell_observer, observer_baseline, residuals, cell_metrics,
        shannon_neff, confidence, cell_scores, cell_scores_country, hot_key_join,
        score_summary, score_summary_ranked, score_summary_radix, score_summary_json,
        cell_counts, feature_guard, dateline_unwrap, cell_bbox, cell_links, cell_lookup,
        feature_json, hexagon_boundaries, hexagon_features, hexagon_tiles,
        hexagon_cell_scores, zoom_to_resolution, tile_index, tile_thinning, tile_thinning_by_place,
        tile_coalesce, tile_dissolve, tile_snap, tile_layer, feature_counts, style_rarity,
        style_counts, style_defaults, style_opacity, read_tsv, read_faulty_tsv, read_multiline_tsv,
        read_utf16_tsv, geojson_lines, clustered_scores, whole_run, whole_run_counts,
    )
}
