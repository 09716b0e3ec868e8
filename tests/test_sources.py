"""Reader faults and encodings, and the table writers."""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import fixture
from hexrarity.operators.features import cell_features
from hexrarity.operators.observations import (
    assign_cells, filter_observations, normalise_country, observation_stats, to_long,
)
from hexrarity.schemas import RAW_COLUMNS, SCORES, observations_schema
from hexrarity.sources.occurrences import detect_encoding, read_occurrences
from hexrarity.sources.tables import (
    read_scores, scores_for, scores_from, write_geojsonseq, write_scores, write_table,
)

GOOD = {
    "gbifID": "1", "species": "Parus major", "taxonRank": "SPECIES", "countryCode": "IT",
    "decimalLatitude": "45.5", "decimalLongitude": "9.2", "speciesKey": "77",
    "coordinateUncertaintyInMeters": "30", "recordedBy": "Zoë",
}


def line(**changes) -> str:
    row = {**GOOD, **changes}
    return "\t".join(row.get(name, "") for name in RAW_COLUMNS)


def write(path, lines, encoding="utf-8", end="\n"):
    text = end.join(["\t".join(RAW_COLUMNS), *lines]) + end
    path.write_bytes(text.encode(encoding))
    return str(path)


def ids(spark, path, *columns, **options):
    """Ids kept when some columns, as the filter stage takes them, are read."""
    df = read_occurrences(spark, path, **options)
    kept = df.select("gbifID", "decimalLatitude", "speciesKey", "recordedBy", "species", *columns)
    return sorted(row[0] for row in kept.collect())


FAULTS = {
    "too many fields": (line(gbifID="2") + "\tone\tmore", True),
    "last field empty": (line(gbifID="2", issue=""), True),
    "bad number": (line(gbifID="2", decimalLatitude="north"), False),
    "bad id": (line(gbifID="two"), False),
    "too few fields": ("2\tx\ty", False),
    "quotes inside": (line(gbifID="2", species='Parus "major" x'), True),
    "empty": (line(gbifID="2", coordinateUncertaintyInMeters='""'), True),
    "tab in quotes": (line(gbifID="2", locality='"a\tb"'), True),
    "doubled quotes": (line(gbifID="2", locality='"say ""hi"""'), True),
    "not a number": (line(gbifID="2", decimalLatitude="NaN"), True),
    "text NULL": (line(gbifID="2", species="NULL"), True),
}


@pytest.mark.parametrize("fault", FAULTS)
def test_faulty_rows(spark, tmp_path, fault):
    text, kept = FAULTS[fault]
    path = write(tmp_path / "raw.tsv", [line(), text, line(gbifID="3")])
    assert ids(spark, path, "locality") == ([1, 2, 3] if kept else [1, 3])


def test_field_values(spark, tmp_path):
    path = write(tmp_path / "raw.tsv", [
        line(locality='"say ""hi"""', species='Parus "major" x'),
        line(gbifID="2", species='""', recordedBy=""),
    ])
    first, second = read_occurrences(spark, path).orderBy("gbifID").collect()
    assert first["locality"] == 'say "hi"' and first["species"] == 'Parus "major" x'
    assert second["species"] is None and second["recordedBy"] is None
    assert len(first) == 50 and first["decimalLatitude"] == 45.5


def test_windows_line_ends(spark, tmp_path):
    path = write(tmp_path / "raw.tsv", [line(), line(gbifID="2")], end="\r\n")
    assert ids(spark, path, "issue") == [1, 2]


@pytest.mark.parametrize("encoding,found", [
    ("utf-8", "UTF-8"), ("utf-16-le", "UTF-16LE"), ("utf-16-be", "UTF-16BE"),
])
@pytest.mark.parametrize("mark", [True, False])
@pytest.mark.parametrize("asked", ["auto", "utf-16"])
def test_encodings(spark, tmp_path, encoding, found, mark, asked):
    if encoding == "utf-8" and (mark or asked != "auto"):
        pytest.skip("UTF-16 only")
    path = tmp_path / "raw.tsv"
    text = "\n".join(["\t".join(RAW_COLUMNS), line(), line(gbifID="2", recordedBy="Ωmega")]) + "\n"
    path.write_bytes((("\ufeff" if mark else "") + text).encode(encoding))
    assert detect_encoding(spark, str(path), asked) == found
    rows = read_occurrences(spark, str(path), asked).orderBy("gbifID").collect()
    assert [r["recordedBy"] for r in rows] == ["Zoë", "Ωmega"]


def test_explicit_encoding_wins(spark, tmp_path):
    path = write(tmp_path / "raw.tsv", [line()], encoding="latin-1")
    assert read_occurrences(spark, path, "ISO-8859-1").first()["recordedBy"] == "Zoë"


def test_filter(spark, tmp_path):
    path = write(tmp_path / "raw.tsv", [
        line(), line(gbifID="2", speciesKey=""), line(gbifID="3", recordedBy=""),
        line(gbifID="4", taxonRank="species"), line(gbifID="5", decimalLatitude="90.01"),
        line(gbifID="6", decimalLongitude="-180"), line(gbifID="7", decimalLatitude="NaN"),
        line(gbifID="8", coordinateUncertaintyInMeters=""), line(gbifID="9", countryCode="it"),
        line(gbifID="10", decimalLatitude=""),
    ])
    raw = read_occurrences(spark, path)
    kept = lambda country: sorted(
        r[0] for r in filter_observations(raw, country).select("gbifID").collect()
    )
    assert kept(None) == [1, 6, 8, 9]
    assert kept("  ") == kept(None)
    assert kept(" it") == [1, 6, 8]  # the column is compared as it is
    assert kept("x' OR '1'='1") == []
    stats = observation_stats(filter_observations(raw)).first()
    assert (stats["n_observations"], stats["n_species"]) == (4, 1)


def test_country_argument():
    assert normalise_country(None) is None and normalise_country("  ") is None
    assert normalise_country(" fr ") == "FR"


def test_assigned_columns(spark, tmp_path):
    path = write(tmp_path / "raw.tsv", [line()])
    table = assign_cells(filter_observations(read_occurrences(spark, path)))
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in observations_schema()
    ]
    long = to_long(table).orderBy("resolution").collect()
    row = table.first()
    assert [(r["resolution"], r["cell"]) for r in long] == [
        (r, row[f"h3_res{r}"]) for r in (3, 4, 5, 6, 7)
    ]


def test_statistics_of_nothing(spark, tmp_path):
    path = write(tmp_path / "raw.tsv", [line(taxonRank="GENUS")])
    stats = observation_stats(filter_observations(read_occurrences(spark, path))).first()
    assert (stats["n_observations"], stats["n_species"]) == (0, 0)


def test_row_groups_and_count(spark, tmp_path):
    df = spark.range(250_000).coalesce(1)
    assert write_table(df, str(tmp_path / "t")) == 250_000
    (file,) = (tmp_path / "t").glob("*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 100_100
    assert meta.row_group(0).column(0).compression == "ZSTD"


def score_rows():
    cells = [0x83194EFFFFFFFFF, 0x831F99FFFFFFFFF, 0x837EB5FFFFFFFFF]
    rows = [(3, cell, 0.25, 2, 30, 4, 0.5) for cell in cells]
    return [*rows, (5, 0x85194AD3FFFFFFF, -0.5, 1, 2, 1, 0.125), (5, None, 0.0, 1, 1, 1, 0.1),
            (5, 0x85283473FFFFFFF, None, 1, 1, 1, 0.1)]


def test_scores_round_trip(spark, tmp_path):
    rows = [row for row in score_rows() if row[1] is not None]
    scores = spark.createDataFrame(rows, SCORES)
    assert write_scores(scores, str(tmp_path / "scores")) == len(rows)
    back = read_scores(spark, str(tmp_path / "scores"))
    assert back.schema == SCORES and sorted(back.drop("rarity_zscore").collect()) == sorted(
        scores.drop("rarity_zscore").collect()
    )
    plan = back.filter("resolution = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(resolution" in plan


def test_tables_with_unsigned_columns(spark, tmp_path):
    cell = 0x83194EFFFFFFFFF
    table = pa.table({
        "h3_res3": pa.array([cell], pa.uint64()), "rarity_zscore": [0.5],
        "count_species": pa.array([1], pa.uint64()),
        "count_observations": pa.array([2], pa.uint64()),
        "count_observers": pa.array([3], pa.uint64()), "confidence_scores": [0.25],
    })
    pq.write_table(table, tmp_path / "cell_scores3.parquet")
    scores = scores_from(spark.read.parquet(str(tmp_path / "cell_scores3.parquet")), 3)
    assert scores.schema.simpleString() == SCORES.simpleString()
    assert tuple(scores.first()) == (3, cell, 0.5, 1, 2, 3, 0.25)
    assert scores_for(scores, 3).columns[0] == "h3_res3"


def test_geojson_lines(spark, tmp_path):
    features = cell_features(spark.createDataFrame(score_rows(), SCORES))
    counts = write_geojsonseq(features, str(tmp_path / "geo"), [3, 5], batch_size=2)
    assert counts == {3: 3, 5: 1}  # incomplete rows are left out
    lines = [
        text for file in (tmp_path / "geo" / "resolution=3").glob("part-*")
        for text in file.read_text().splitlines()
    ]
    assert len(lines) == 3
    for text in lines:
        feature = json.loads(text)
        assert ": " not in text and list(feature) == ["type", "geometry", "properties"]
        (ring,) = feature["geometry"]["coordinates"]
        assert ring[0] == ring[-1] and len(ring) >= 7
        assert list(feature["properties"]) == [
            "h3", "rarity_zscore", "count_species", "count_observations", "count_observers",
            "confidence_scores",
        ]
    by_id = {json.loads(t)["properties"]["h3"]: json.loads(t) for t in lines}
    lngs = [p[0] for p in by_id["837eb5fffffffff"]["geometry"]["coordinates"][0]]
    assert max(lngs) - min(lngs) < 10  # on the date line, yet continuous
    sizes = [
        len(f.read_text().splitlines()) for f in (tmp_path / "geo").glob("*/part-*")
    ]
    assert max(sizes) <= 2


def test_empty_export(spark, tmp_path):
    features = cell_features(spark.createDataFrame([], SCORES))
    assert write_geojsonseq(features, str(tmp_path / "geo"), [3]) == {3: 0}


def test_missing_input(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_scores(spark, str(tmp_path / "nowhere")).count()


def test_cell_null_guard(spark):
    rows = spark.createDataFrame(score_rows(), SCORES)
    assert cell_features(rows).filter(F.col("ring").isNull()).count() == 0


@pytest.mark.parametrize("encoding", ["UTF-16LE", "UTF-16BE"])
def test_packed_raw_files_hold_the_same_rows(spark, tmp_path, monkeypatch, encoding):
    spark.range(60).selectExpr(
        "id AS l_orderkey", "1 + id % 6 AS l_linenumber", "id % 7 AS l_partkey", "id % 3 AS l_suppkey",
        "CAST(id AS DOUBLE) AS l_quantity", "'N' AS l_returnflag").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(60).selectExpr("id AS o_orderkey", "id % 11 AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(7).selectExpr("id AS p_partkey", "concat('ü', id) AS p_name").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(3).selectExpr("id AS s_suppkey", "id AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(fixture, "_stored", {})
    plain = read_occurrences(spark, fixture.raw_file(spark, str(tmp_path), encoding)).collect()
    monkeypatch.setattr(fixture, "_stored", {})
    monkeypatch.setattr(fixture, "PLAIN_ROWS", 10)
    monkeypatch.setattr(fixture, "PACKED_ROWS", 9)
    path = fixture.raw_file(spark, str(tmp_path), encoding)
    files = spark.read.format("binaryFile").load(path).select("path").collect()
    assert len(files) > 6 and all(f[0].endswith(".gz") for f in files)
    packed = read_occurrences(spark, path).collect()
    assert len(packed) == 60
    assert sorted(map(str, packed)) == sorted(map(str, plain))
