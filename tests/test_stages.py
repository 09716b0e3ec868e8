"""The stored stages end to end, from a raw file to tiles."""

from __future__ import annotations

import json
import random
from dataclasses import replace
from pathlib import Path

import pytest

from hexrarity.operators.observations import observation_stats
from hexrarity.operators.tiles import ZoomPlan
from hexrarity.plans.stages import (
    Store, clean, count_species, draw, export_lines, in_order, run, score, tile,
)
from tests.test_sources import line, write


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    rng = random.Random(11)
    lines = []
    for i in range(600):
        site = rng.randrange(12)
        lines.append(line(
            gbifID=str(i), speciesKey=str(rng.randrange(15)), recordedBy=f"o{rng.randrange(9)}",
            decimalLatitude=str(40 + site * 0.9), decimalLongitude=str(174 + site * 1.1 - 360 * (
                site > 5)),
            coordinateUncertaintyInMeters=str(rng.choice([10, 900, 20000])),
            countryCode=rng.choice(["IT", "FR"]),
        ))
    return write(tmp_path_factory.mktemp("raw") / "raw.tsv", lines)


def test_whole_run_and_restart(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path), {"lines": f"{tmp_path}/geo"})
    told = []
    # the order comes from the tables, not from the list
    stages = [tile(), export_lines(), draw(), score(), count_species(), clean(raw, country="it")]
    reports = run(store, stages, told.append)
    assert told == ["clean observations", "count species", "score cells", "draw cells",
                    "tile features", "export lines"]
    assert [r.title for r in reports] == told and all(r.seconds > 0 for r in reports)

    stats = observation_stats(store.table("observations")).first()
    assert 200 < stats["n_observations"] < 400 and stats["n_species"] == 15
    assert reports[0].found == {"observations": stats["n_observations"]}
    assert reports[1].found == {"species": 15} and store.table("species").count() == 15
    counts = reports[3].found["features"]
    assert set(counts) == {3, 4, 5, 6, 7} and all(counts.values())
    assert reports[5].found["lines"] == counts
    lines = [
        text for f in (tmp_path / "geo").glob("*/part-*") for text in f.read_text().splitlines()
    ]
    assert len(lines) == sum(counts.values())
    summary = {r["resolution"]: r for r in store.table("summary").collect()}
    assert set(summary) == set(counts) and len(summary[3]["rarity_quantiles"]) == 4
    assert reports[2].found["summary"] == {k: r.asDict() for k, r in summary.items()}
    tiles = store.table("tiles")
    assert tiles.count() == reports[4].found["tile rows"]
    assert {r[0] for r in tiles.select("layer").distinct().collect()} == {"rarity_cells"}
    assert {r[0] for r in tiles.select("h3").distinct().collect()} == {
        json.loads(text)["properties"]["h3"] for text in lines
    }

    cells = lambda: sorted(store.table("scores").select("resolution", "cell").collect())
    before = cells()
    again = run(store, [score(), count_species()])
    assert [r.title for r in again] == ["count species", "score cells"]
    assert cells() == before


def test_wanted_resolutions_only(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, [clean(raw), count_species(), score()])
    plan = ZoomPlan((5,), ((0, 3),))
    drawn, tiled = run(store, [draw((5,)), tile(plan, coalesce=True, drop_rate=2.0)])
    assert set(drawn.found["features"]) == {5}
    assert drawn.found["features"][5] == store.table("scores").where("resolution = 5").count()
    assert {r[0] for r in store.table("tiles").select("resolution").distinct().collect()} == {5}
    with pytest.raises(ValueError, match="resolutions \\[8\\]"):
        run(store, [draw((8,))])


def test_order_and_missing_tables(spark, tmp_path):
    titles = [s.title for s in in_order([draw(), clean("x"), score(), count_species()])]
    assert titles == ["clean observations", "count species", "score cells", "draw cells"]
    with pytest.raises(ValueError, match="same table"):
        in_order([draw(), draw()])
    with pytest.raises(FileNotFoundError, match="observations"):
        run(Store(spark, str(tmp_path)), [count_species()])


def test_tile_arguments():
    with pytest.raises(ValueError, match="drop_rate"):
        tile(drop_rate=0)
    with pytest.raises(ValueError, match="one zoom range"):
        ZoomPlan((3,))
    assert ZoomPlan((3,), ((0, 0),)).zoom_ranges == ((0, 0),)


def test_nothing_to_score(spark, tmp_path):
    path = write(tmp_path / "raw.tsv", [line(), line(gbifID="2")])
    store = Store(spark, f"{tmp_path}/run")
    run(store, [clean(path), count_species()])
    with pytest.raises(ValueError, match="no cell could be scored"):
        run(store, [score()])


def scored(store):
    return sorted(tuple(r) for r in store.table("scores").select("resolution", "cell", "rarity_zscore").collect())


def all_stages(raw, **options):
    return [clean(raw, **options), count_species(), score(), draw(), tile(), export_lines()]


def failing(stage, after_tables):
    """The stage, which dies when it has written some of its tables."""
    def build(store):
        stage.build(store)
        for table in stage.makes[after_tables:]:
            store.written.pop(table)
        raise RuntimeError("killed")

    return replace(stage, build=build)


def test_killed_between_stages(spark, raw, tmp_path):
    """What was published stays readable; a resumed run builds the rest only."""
    store = Store(spark, str(tmp_path))
    run(store, all_stages(raw))
    before, version = scored(store), store.version("scores")
    for tables in (0, 1, 2):
        with pytest.raises(RuntimeError, match="killed"):
            run(store, [clean(raw, country="it"), count_species(), failing(score(), tables)])
        assert store.version("scores") == version and scored(store) == before
        assert store.table("summary").count() == 5
    reports = run(store, all_stages(raw, country="it"), resume=True)
    assert [r.skipped for r in reports] == [True, True, False, False, False, False]
    assert scored(store) != before and store.version("scores") != version
    again = run(store, all_stages(raw, country="it"), resume=True)
    assert all(r.skipped for r in again) and [r.found for r in again] == [r.found for r in reports]
    assert len(store.tidy("scores", 1)) == 4 and store.tidy("scores", 1) == []
    assert scored(store) != before


def test_stale_tables(spark, raw, tmp_path):
    """A stage is built anew if its settings, its files or its inputs' versions changed."""
    copy = tmp_path / "raw.tsv"
    copy.write_bytes(Path(raw).read_bytes())
    store = Store(spark, str(tmp_path / "store"))
    stages = lambda **o: [clean(str(copy), **o), count_species(), score()]
    run(store, stages())
    built = lambda **o: [not r.skipped for r in run(store, stages(**o), resume=True)]
    assert built() == [False, False, False]
    assert built(country="it") == [True, True, True]
    with copy.open("a") as file:
        file.write(line(gbifID="99999", countryCode="IT") + "\n")
    assert built(country="it") == [True, True, True]
    run(store, [count_species(4)])
    assert built(country="it") == [False, True, True]


def test_manifest_cut_short(spark, raw, tmp_path):
    store = Store(spark, str(tmp_path))
    run(store, [clean(raw)])
    version = store.version("observations")
    (tmp_path / "_published" / "observations" / "2.json").write_text('{"build": "x", "fol')
    assert store.version("observations") == version and store.table("observations").count() > 0
    run(store, [clean(raw)])
    assert store.version("observations") not in (version, "x")


def test_tables_from_elsewhere(spark, tmp_path):
    """A table written whole counts; one without the mark of success does not."""
    spark.range(3).write.parquet(str(tmp_path / "species"))
    store = Store(spark, str(tmp_path))
    assert store.holds("species") and store.table("species").count() == 3
    (tmp_path / "species" / "_SUCCESS").unlink()
    assert not store.holds("species") and not store.holds("observations")
    with pytest.raises(FileNotFoundError, match="species"):
        store.table("species")
