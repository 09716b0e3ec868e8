"""The same queries in SQL for DuckDB, written from the definitions.

Constants are written out here once more, so that a wrong one in the engine shows; only
the tables of the grid come from it (``tests/test_hexgrid.py`` checks those against the
survey).
"""

from __future__ import annotations

from collections import namedtuple

from checks.fixture import RAW_SQL
from hexrarity.functions import hexgrid

RESOLUTIONS = (3, 4, 5, 6, 7)
LATTICE_DEGREES = {3: 8, 4: 4, 5: 2, 6: 1, 7: 0.5}
DROP_RATE = 2.5

# Edge lengths in metres, zooms per resolution, quantiles, colour ramps.
EDGE_LENGTH_M = {
    3: 68979.22179, 4: 26071.75968, 5: 9854.090990, 6: 3724.532667, 7: 1406.475763,
}
ZOOM_RANGES = ((0, 4), (4, 5), (5, 7), (7, 8), (8, 12))
QUANTILES = {
    "rarity_zscore": ("rarity_quantiles", (0.025, 0.5, 0.75, 0.975)),
    "count_observations": ("count_observations_quantiles", (0.025, 0.5, 0.975)),
    "count_species": ("count_species_quantiles", (0.025, 0.5, 0.975)),
    "count_observers": ("count_observers_quantiles", (0.025, 0.5, 0.975)),
    "confidence_scores": ("confidence_scores_quantiles", (0.025, 0.5, 0.975)),
}
Colours = namedtuple("Colours", "column summary quantile default stops colours middle")
RAMPS = {
    "rarity_zscore": Colours(
        "rarity_zscore", "rarity_quantiles", 3, 0.0, (-1, -0.67, -0.33, 0, 0.33, 0.67, 1),
        ("#053061", "#4575b4", "#abd9e9", "#f7f7f7", "#fdae61", "#d73027", "#67001f"), "#f7f7f7"),
    "count_observations": Colours(
        "count_observations", "count_observations_quantiles", 2, 500.0, (0, 0.2, 0.4, 0.6, 0.8, 1),
        ("#e8f3ea", "#b8d9c3", "#6fb0a4", "#397996", "#24476f", "#171d3f"), "#e8f3ea"),
    "count_species": Colours(
        "count_species", "count_species_quantiles", 2, 500.0, (0, 0.25, 0.5, 0.75, 1),
        ("#f1ffcf", "#c6f76a", "#7dde46", "#3caa52", "#245726"), "#f1ffcf"),
    "count_observers": Colours(
        "count_observers", "count_observers_quantiles", 2, 500.0, (0, 0.25, 0.5, 0.75, 1),
        ("#fff1cf", "#f7c66a", "#de7d46", "#aa3c52", "#572461"), "#fff1cf"),
}


def _r(expression: str, name: str | None = None, places: int = 6) -> str:
    name = name or expression
    return f"round({expression}, {places}) + 0.0 AS {name}"


def _filtered(country: str | None = None) -> str:
    extra = f" AND countryCode = '{country}'" if country else ""
    return f"""
raw AS ({RAW_SQL}),
filtered AS (
 SELECT gbifID, speciesKey, species, decimalLatitude, decimalLongitude,
  coordinateUncertaintyInMeters, taxonRank, recordedBy
 FROM raw
 WHERE speciesKey IS NOT NULL AND recordedBy IS NOT NULL AND taxonRank = 'SPECIES'
  AND decimalLatitude BETWEEN -90 AND 90 AND decimalLongitude BETWEEN -180 AND 180{extra})"""


LATTICE = ",\n".join(
    f"""CAST(floor((decimalLatitude + 90) / CAST({d} AS DOUBLE)) AS BIGINT) * 10000
  + CAST(floor((decimalLongitude + 180) / CAST({d} AS DOUBLE)) AS BIGINT) AS h3_res{r}"""
    for r, d in LATTICE_DEGREES.items()
)

LONG = "\n UNION ALL ".join(
    f"SELECT gbifID, speciesKey, recordedBy, coordinateUncertaintyInMeters AS unc,"
    f" {r} AS resolution, h3_res{r} AS cell FROM obs"
    for r in RESOLUTIONS
)

CONFIDENCE = "(1 - exp(neff_observers / -4)) * (1 - exp(count_observations / CAST(-40 AS DOUBLE)))"

EDGES = ", ".join(f"({r}, CAST({EDGE_LENGTH_M[r]} AS DOUBLE))" for r in RESOLUTIONS)


def _observations(country: str | None = None) -> str:
    return f"""{_filtered(country)},
obs AS (SELECT *, {LATTICE} FROM filtered)"""


SCORING = f"""
long AS ({LONG}),
edges(resolution, edge_m) AS (VALUES {EDGES}),
occupancy AS (
 SELECT speciesKey, min(species) AS species, count(*) AS n_observations,
  count(DISTINCT h3_res5) AS occupancy, pow(count(DISTINCT h3_res5), -0.5) AS rarity
 FROM obs GROUP BY speciesKey),
-- every record, with whether its observer was anywhere else at that resolution
placed AS (
 SELECT *, min(cell) OVER who < max(cell) OVER who AS roams
 FROM long WINDOW who AS (PARTITION BY resolution, recordedBy)),
finds AS (
 SELECT resolution, cell, recordedBy, speciesKey, count(*) AS n
 FROM placed JOIN edges USING (resolution) WHERE roams AND unc <= edge_m GROUP BY ALL),
visits AS (
 SELECT resolution, cell, recordedBy, sum(n) AS n, avg(rarity) AS mean_rarity
 FROM finds LEFT JOIN occupancy USING (speciesKey) GROUP BY ALL),
compared AS (
 SELECT *, n / sum(n) OVER (PARTITION BY resolution, cell) AS share,
  avg(mean_rarity) OVER (PARTITION BY resolution, recordedBy) AS usual
 FROM visits),
richness AS (
 SELECT resolution, cell, count(DISTINCT speciesKey) AS count_species FROM finds GROUP BY ALL),
cells AS (
 SELECT resolution, cell, count_species, CAST(sum(n) AS BIGINT) AS count_observations,
  count(*) AS count_observers, avg(mean_rarity - usual) AS z,
  exp(-sum(share * ln(share))) AS neff_observers
 FROM compared JOIN richness USING (resolution, cell) GROUP BY ALL),
scores AS (
 SELECT resolution, cell, {_r('z', 'rarity_zscore')}, count_species, count_observations,
  count_observers, {_r(CONFIDENCE, 'confidence_scores')}
 FROM cells WHERE z IS NOT NULL)"""


def _scoring(select: str, country: str | None = None, extra: str = "") -> str:
    return f"WITH {_observations(country)},{SCORING}{extra}\n{select}"


SUMMARY = "summary AS (SELECT resolution, " + ", ".join(
    f"list_transform(quantile_cont(CAST({column} AS DOUBLE), {list(probabilities)}),"
    f" lambda x: round(x, 6) + 0.0) AS {name}"
    for column, (name, probabilities) in QUANTILES.items()
) + " FROM scores GROUP BY resolution)"

SCORE_LIST = (
    "rarity_zscore, count_species, count_observations, count_observers, confidence_scores"
)

# -- lattice squares as features ----------------------------------------------

SIZES = ", ".join(f"({r}, CAST({d} AS DOUBLE))" for r, d in LATTICE_DEGREES.items())
SQUARES = f"""
sizes(resolution, size) AS (VALUES {SIZES}),
squares AS (
 SELECT s.*, size, floor(cell / 10000) * size - 90 AS south,
  (cell % 10000) * size - 180 + size / 2 AS west
 FROM scores s JOIN sizes USING (resolution)),
corners AS (
 SELECT resolution, cell, i,
  west + size * (CASE WHEN i IN (2, 3) THEN 1 ELSE 0 END) AS lng0,
  least(south + size * (CASE WHEN i IN (3, 4) THEN 1 ELSE 0 END), CAST(90 AS DOUBLE)) AS lat
 FROM squares, (VALUES (1), (2), (3), (4)) AS v(i)),
wrapped AS (
 SELECT resolution, cell, i, lat, CASE WHEN lng0 > 180 THEN lng0 - 360 ELSE lng0 END AS lng
 FROM corners),
ring AS (
 SELECT a.resolution, a.cell, 1 AS i, a.lng, a.lat FROM wrapped a WHERE i = 1
 UNION ALL
 SELECT n.resolution, n.cell, n.i,
  CASE WHEN n.lng - p.lng > 180 THEN n.lng - 360 WHEN n.lng - p.lng < -180 THEN n.lng + 360
       ELSE n.lng END, n.lat
 FROM ring p JOIN wrapped n
  ON n.resolution = p.resolution AND n.cell = p.cell AND n.i = p.i + 1),
closed AS (
 SELECT * FROM ring
 UNION ALL SELECT resolution, cell, 5, lng, lat FROM ring WHERE i = 1),
box AS (
 SELECT resolution, cell, min(lat) AS swlat, min(lng) AS swlng, max(lat) AS nelat,
  max(lng) AS nelng FROM closed GROUP BY resolution, cell)"""


def _features(select: str, extra: str = "") -> str:
    sql = _scoring(select, extra=f",{SQUARES}{extra}")
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


RING_TEXT = """string_agg(CAST(CAST(round(lng * 1000000) AS BIGINT) AS VARCHAR) || ' ' ||
  CAST(CAST(round(lat * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY i) AS ring"""

ZOOMS = ", ".join(
    f"({r}, {low}, {high})" for r, (low, high) in zip(RESOLUTIONS, ZOOM_RANGES, strict=True)
)


def _mercator(lat: str) -> str:
    sine = f"sin(radians(least(greatest({lat}, -85.0511287798066), 85.0511287798066)))"
    return f"(0.5 - ln((1 + {sine}) / (1 - {sine})) / (4 * pi())) * pow(2.0, z)"


TILES = f""",
zooms(resolution, z0, z1) AS (VALUES {ZOOMS}),
zoomed AS (
 SELECT b.*, z1, unnest(range(z0, z1 + 1)) AS z FROM box b JOIN zooms USING (resolution)),
spans AS (
 SELECT *, CAST(pow(2, z) AS BIGINT) AS side,
  CAST(floor((swlng + 180) / 360 * pow(2.0, z)) AS BIGINT) AS west,
  CAST(floor((nelng + 180) / 360 * pow(2.0, z)) AS BIGINT) AS east,
  CAST(floor({_mercator('nelat')}) AS BIGINT) AS top,
  CAST(floor({_mercator('swlat')}) AS BIGINT) AS bottom
 FROM zoomed),
columns AS (
 SELECT *, unnest(range(west, least(east, west + side - 1) + 1)) AS wrap FROM spans),
tiled AS (
 SELECT resolution, cell, CAST(z AS INTEGER) AS z, z1, wrap,
  CAST(((wrap % side) + side) % side AS INTEGER) AS x,
  CAST(unnest(range(least(greatest(top, 0), side - 1),
   least(greatest(bottom, 0), side - 1) + 1)) AS INTEGER) AS y
 FROM columns)"""

# -- colours -------------------------------------------------------------------


def _level(ramp, at: int) -> str:
    levels = [int(c[at:at + 2], 16) for c in ramp.colours]
    stops = [f"(q * CAST({s} AS DOUBLE))" for s in ramp.stops]
    arms = [f"WHEN v <= {stops[0]} THEN CAST({levels[0]} AS DOUBLE)"]
    for i in range(1, len(stops)):
        arms.append(
            f"WHEN v < {stops[i]} THEN {levels[i - 1]} + (v - {stops[i - 1]})"
            f" / ({stops[i]} - {stops[i - 1]}) * ({levels[i]} - {levels[i - 1]})"
        )
    return f"CASE {' '.join(arms)} ELSE CAST({levels[-1]} AS DOUBLE) END"


def _colour(ramp) -> str:
    channels = " || ".join(
        f"lpad(hex(CAST(round({_level(ramp, at)}) AS BIGINT)), 2, '0')" for at in (1, 3, 5)
    )
    return f"CASE WHEN q > 0 THEN lower('#' || {channels}) ELSE '{ramp.middle}' END"


def _styled(metric: str, resolutions: str = "TRUE", name: str = "fill_color") -> str:
    ramp = RAMPS[metric]
    return f"""SELECT resolution, cell, {_colour(ramp)} AS {name} FROM (
 SELECT s.resolution, s.cell, coalesce(CAST(s.{ramp.column} AS DOUBLE), 0) AS v,
  coalesce(m.{ramp.summary}[{ramp.quantile + 1}], CAST({ramp.default} AS DOUBLE)) AS q
 FROM scores s LEFT JOIN (SELECT * FROM summary WHERE {resolutions}) m
  ON s.resolution = m.resolution)"""


def _with_summary(select: str) -> str:
    return _scoring(select, extra=f",\n{SUMMARY}")


# -- hexagons ------------------------------------------------------------------


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) for x in row) + ")" for row in rows)


def _base_rows():
    """(face, a, b, lead, base, turns) of every place a base cell has on a face."""
    for f, a, b in zip(*(hexgrid.BASE >= 0).nonzero(), strict=True):
        for lead in range(7):
            yield (
                f, a - 2, b - 2, lead, hexgrid.BASE[f, a, b], hexgrid.TOTAL[f, a, b, lead]
            )


FACE_ROWS = _values([(f, *map(repr, map(float, row))) for f, row in enumerate(hexgrid.FACES)])
TURN_LIST = str(hexgrid.TURN.tolist())
ANGLE = "CAST(0.3334731722518321 AS DOUBLE)"

HEXAGONS = f"""
face AS (
 SELECT f, cos(t) * cos(g) AS cx, cos(t) * sin(g) AS cy, sin(t) AS cz,
  -cos(a) * sin(t) * cos(g) - sin(a) * sin(g) AS ax,
  -cos(a) * sin(t) * sin(g) + sin(a) * cos(g) AS ay, cos(a) * cos(t) AS az,
  -sin(a) * sin(t) * cos(g) + cos(a) * sin(g) AS vx,
  -sin(a) * sin(t) * sin(g) - cos(a) * cos(g) AS vy, sin(a) * cos(t) AS vz
 FROM (SELECT f, CAST(t AS DOUBLE) t, CAST(g AS DOUBLE) g, CAST(a AS DOUBLE) a
       FROM (VALUES {FACE_ROWS}) AS v(f, t, g, a))),
places AS (
 SELECT lat, lng, cos(radians(lat)) * cos(radians(lng)) AS x,
  cos(radians(lat)) * sin(radians(lng)) AS y, sin(radians(lat)) AS z
 FROM (SELECT DISTINCT decimalLatitude AS lat, decimalLongitude AS lng FROM filtered)),
nearest AS (
 SELECT lat, lng, arg_max(f, x * cx + y * cy + z * cz) AS f FROM places, face GROUP BY lat, lng),
planar AS (
 SELECT lat, lng, f,
  (x * ax + y * ay + z * az) / (CAST(0.381966011250105 AS DOUBLE) * (x * cx + y * cy + z * cz)) AS px,
  (x * vx + y * vy + z * vz) / (CAST(0.381966011250105 AS DOUBLE) * (x * cx + y * cy + z * cz)) AS py
 FROM nearest JOIN places USING (lat, lng) JOIN face USING (f)),
turned AS (
 SELECT lat, lng, f, r, pow(7.0, r / 2.0) AS s,
  CASE WHEN r % 2 = 1 THEN px * cos({ANGLE}) + py * sin({ANGLE}) ELSE px END AS px,
  CASE WHEN r % 2 = 1 THEN py * cos({ANGLE}) - px * sin({ANGLE}) ELSE py END AS py
 FROM planar, (VALUES {_values([(r,) for r in RESOLUTIONS])}) AS v(r)),
axial AS (
 SELECT lat, lng, f, r, (px + py / sqrt(3.0)) * s AS a, py / (sqrt(3.0) / 2) * s AS b FROM turned),
tried AS (
 SELECT lat, lng, f, r, floor(a) + i AS ia, floor(b) + j AS ib,
  pow(floor(a) + i - a, 2) - (floor(a) + i - a) * (floor(b) + j - b)
   + pow(floor(b) + j - b, 2) AS off
 FROM axial, (VALUES (0), (1)) AS u(i), (VALUES (0), (1)) AS w(j)),
leaf AS (
 SELECT lat, lng, f, r, CAST(arg_min(ia, off) AS BIGINT) AS a, CAST(arg_min(ib, off) AS BIGINT) AS b
 FROM tried GROUP BY lat, lng, f, r),
walk AS (
 SELECT lat, lng, f, r, r AS k, a, b, CAST(0 AS BIGINT) AS packed, 0 AS lead FROM leaf
 UNION ALL
 SELECT lat, lng, f, r, k - 1, pa, pb, packed + (digit << (3 * (15 - k))),
  CASE WHEN digit > 0 THEN CAST(digit AS INTEGER) ELSE lead END
 FROM (
  SELECT *, CAST(CASE (a - ca) * 10 + (b - cb) WHEN 0 THEN 0 WHEN -11 THEN 1 WHEN 1 THEN 2
    WHEN -10 THEN 3 WHEN 10 THEN 4 WHEN -1 THEN 5 WHEN 11 THEN 6 END AS BIGINT) AS digit
  FROM (
   SELECT *, CASE WHEN k % 2 = 1 THEN 2 * pa + pb ELSE 3 * pa - pb END AS ca,
    CASE WHEN k % 2 = 1 THEN 3 * pb - pa ELSE pa + 2 * pb END AS cb
   FROM (
    SELECT *,
     CAST(round((CASE WHEN k % 2 = 1 THEN 3 * a - b ELSE 2 * a + b END) / 7.0) AS BIGINT) AS pa,
     CAST(round((CASE WHEN k % 2 = 1 THEN a + 2 * b ELSE 3 * b - a END) / 7.0) AS BIGINT) AS pb
    FROM walk WHERE k > 0)))),
bases(f, a, b, lead, base, turns) AS (VALUES {_values(_base_rows())}),
hexagon AS (
 SELECT lat, lng, r,
  (CAST(1 AS BIGINT) << 59) + (CAST(r AS BIGINT) << 52) + (CAST(base AS BIGINT) << 45)
  + (CAST(1 AS BIGINT) << (3 * (15 - r))) - 1
  + CAST(list_sum(list_transform(range(1, r + 1), lambda k:
     CAST({TURN_LIST}[turns + 1][((packed >> (3 * (15 - k))) & 7) + 1] AS BIGINT)
      << (3 * (15 - k)))) AS BIGINT) AS cell
 FROM walk JOIN bases USING (f, a, b, lead) WHERE k = 0),
wide AS (
 SELECT lat, lng, {", ".join(f"max(CASE WHEN r = {r} THEN cell END) AS h3_res{r}" for r in RESOLUTIONS)}
 FROM hexagon GROUP BY lat, lng),
obs AS (
 SELECT f.*, {", ".join(f"h3_res{r}" for r in RESOLUTIONS)} FROM filtered f
 JOIN wide w ON f.decimalLatitude = w.lat AND f.decimalLongitude = w.lng)"""


NEXT_ROWS = _values(
    (
        f, side, hexgrid.NEXT_FACE[f, side],
        *(f"CAST({float(x)!r} AS DOUBLE)" for z in (
            hexgrid.NEXT_TURN[f, side], hexgrid.NEXT_SHIFT[f, side]
        ) for x in (z.real, z.imag)),
    )
    for f in range(20) for side in range(3)
)


def _pentagon_rows():
    """(face, pentagon base cell, corner) of the five faces around each pentagon."""
    for f, a, b in zip(*(hexgrid.BASE >= 0).nonzero(), strict=True):
        corners = {(2, 0): 0, (0, 2): 1, (-2, -2): 2}
        if hexgrid.PENTAGON[hexgrid.BASE[f, a, b]] and (a - 2, b - 2) in corners:
            yield f, hexgrid.BASE[f, a, b], corners[a - 2, b - 2]


def _beyond(source: str) -> str:
    """Adds how far (px, py) lies beyond a side of its face, and which side."""
    return f"""SELECT *, u + v - 3 * least(u, v, 0) - 2 AS over,
  CASE WHEN u <= v AND u <= 0 THEN 0 WHEN v <= 0 THEN 1 ELSE 2 END AS side
 FROM (SELECT *, px + py / sqrt(3.0) AS u, py / (sqrt(3.0) / 2) AS v FROM {source})"""


def _folded(source: str) -> str:
    return f"""SELECT t.cell, t.r, t.k, coalesce(n.g, t.f) AS f,
  CASE WHEN n.g IS NULL THEN px ELSE px * tr - py * ti + sr END AS px,
  CASE WHEN n.g IS NULL THEN py ELSE px * ti + py * tr + si END AS py
 FROM ({_beyond(source)}) t LEFT JOIN next_face n
  ON t.over > 1e-9 AND n.f = t.f AND n.side = t.side"""


# Distance beyond the side opposite corner m of a face.
OUTSIDE = """-({x} * cos(2 * pi() * m / 3) + {y} * sin(2 * pi() * m / 3)) - 1"""

BOUNDARIES = f"""
next_face(f, side, g, tr, ti, sr, si) AS (VALUES {NEXT_ROWS}),
seen AS (
 SELECT h.cell, h.r, min(l.f) AS f, arg_min(l.a, l.f) AS a, arg_min(l.b, l.f) AS b
 FROM hexagon h JOIN leaf l ON h.lat = l.lat AND h.lng = l.lng AND h.r = l.r
 JOIN scores s ON s.cell = h.cell GROUP BY h.cell, h.r),
pentagon(f, base, m) AS (VALUES {_values(_pentagon_rows())}),
-- a pentagon is drawn on its five faces, from the corner of each
middles AS (
 SELECT s.cell, s.r, coalesce(p.f, s.f) AS f, p.f IS NOT NULL AS five,
  coalesce(2 * cos(2 * pi() * m / 3), 0.0) AS mx, coalesce(2 * sin(2 * pi() * m / 3), 0.0) AS my,
  CASE WHEN p.f IS NULL THEN a - b / 2.0 ELSE 0 END AS x,
  CASE WHEN p.f IS NULL THEN b * sqrt(3.0) / 2 ELSE 0 END AS y
 FROM seen s LEFT JOIN pentagon p ON p.base = ((s.cell >> 45) & 127)
  AND ((s.cell & ((CAST(1 AS BIGINT) << 45) - 1)) >> (3 * (15 - s.r))) = 0),
spokes AS (
 SELECT cell, r, f, five, mx, my, k, x + cos(pi() * (1 + 2 * k) / 6) / sqrt(3.0) AS x,
  y + sin(pi() * (1 + 2 * k) / 6) / sqrt(3.0) AS y,
  CASE WHEN r % 2 = 1 THEN {ANGLE} ELSE CAST(0 AS DOUBLE) END AS turn
 FROM middles, (VALUES (0), (1), (2), (3), (4), (5)) AS w(k)),
flat AS (
 SELECT cell, r, f, five, k, mx + (x * cos(turn) - y * sin(turn)) / pow(7.0, r / 2.0) AS px,
  my + (x * sin(turn) + y * cos(turn)) / pow(7.0, r / 2.0) AS py FROM spokes),
hexes AS (SELECT * FROM flat WHERE NOT five),
fold1 AS ({_folded('hexes')}),
fold2 AS ({_folded('fold1')}),
sides AS (
 SELECT p.cell, p.r, p.f, p.px, p.py, q.px AS qx, q.py AS qy,
  CASE WHEN p.over > 1e-9 THEN p.side ELSE q.side END AS m
 FROM ({_beyond('flat')}) p JOIN ({_beyond('flat')}) q
  ON p.cell = q.cell AND p.f = q.f AND q.k = (p.k + 1) % 6
 WHERE p.r % 2 = 1 AND (p.over > 1e-9) <> (q.over > 1e-9)),
crossed AS (
 SELECT *, d0 / (d0 - d1) AS t FROM (
  SELECT *, {OUTSIDE.format(x='px', y='py')} AS d0, {OUTSIDE.format(x='qx', y='qy')} AS d1
  FROM sides)),
vertices AS (
 SELECT cell, r, f, px, py FROM fold2
 UNION ALL
 SELECT cell, r, f, px, py FROM ({_beyond('flat')}) WHERE five AND over < 1e-9
 UNION ALL
 SELECT cell, r, f, px + t * (qx - px), py + t * (qy - py) FROM crossed
 WHERE t > 1e-6 AND t < 1 - 1e-6),
globe AS (
 SELECT cell, r, cx + w * (px * ax + py * vx) AS x, cy + w * (px * ay + py * vy) AS y,
  cz + w * (px * az + py * vz) AS z
 FROM (SELECT *, CAST(0.381966011250105 AS DOUBLE) AS w FROM vertices) JOIN face USING (f)),
marks AS (
 SELECT DISTINCT cell, r, CAST(CAST(round(degrees(atan2(y, x)) * 100000) AS BIGINT) AS VARCHAR) || ' ' ||
  CAST(CAST(round(degrees(atan2(z, sqrt(x * x + y * y))) * 100000) AS BIGINT) AS VARCHAR) AS mark
 FROM globe)"""


ORACLE: dict[str, str] = {
    "filter_observations": f"""WITH {_filtered()}
SELECT gbifID, speciesKey, species, {_r('decimalLatitude')}, {_r('decimalLongitude')},
 {_r('coordinateUncertaintyInMeters')}, taxonRank, recordedBy FROM filtered""",
    "country_filter": f"""WITH {_filtered('IT')}
SELECT gbifID, speciesKey, species, {_r('decimalLatitude')}, {_r('decimalLongitude')},
 {_r('coordinateUncertaintyInMeters')}, taxonRank, recordedBy FROM filtered""",
    "filtered_stats": f"""WITH {_filtered()}
SELECT count(*) AS n_observations, count(DISTINCT speciesKey) AS n_species FROM filtered""",
    "assign_cells": f"""WITH RECURSIVE {_filtered()},{HEXAGONS}
SELECT gbifID, h3_res3, h3_res4, h3_res5, h3_res6, h3_res7 FROM obs""",
    "to_long": f"""WITH {_observations()}, long AS ({LONG})
SELECT gbifID, resolution, cell FROM long""",
    "species_occupancy": _scoring(
        f"SELECT speciesKey, species, n_observations, occupancy, {_r('rarity')} FROM occupancy"
    ),
    "occupancy_stats": _scoring(f"""SELECT count(*) AS n_species,
 min(occupancy) AS min_occupancy, {_r('avg(occupancy)', 'avg_occupancy')},
 max(occupancy) AS max_occupancy, {_r('min(rarity)', 'min_rarity')},
 {_r('avg(rarity)', 'avg_rarity')}, {_r('max(rarity)', 'max_rarity')} FROM occupancy"""),
    "valid_observers": _scoring("SELECT DISTINCT resolution, recordedBy FROM placed WHERE roams"),
    "precise_observations": _scoring(
        "SELECT resolution, cell, recordedBy, speciesKey, n AS n_observations FROM finds"
    ),
    "distinct_cell_species_observer": _scoring(
        "SELECT resolution, cell, recordedBy, speciesKey FROM finds"
    ),
    "observer_counts_by_cell": _scoring(
        "SELECT resolution, cell, recordedBy, CAST(n AS BIGINT) AS obs_by_observer FROM visits"
    ),
    "mean_rarity_cell_observer": _scoring(
        f"SELECT resolution, cell, recordedBy, {_r('mean_rarity')} FROM visits"
        " WHERE mean_rarity IS NOT NULL"
    ),
    "observer_baseline": _scoring(
        f"SELECT DISTINCT resolution, recordedBy, {_r('usual', 'baseline')} FROM compared"
    ),
    "residuals": _scoring(
        f"SELECT resolution, cell, recordedBy, {_r('mean_rarity - usual', 'residual')} FROM compared"
    ),
    "cell_metrics": _scoring(
        "SELECT resolution, cell, count_observations, count_species, count_observers FROM cells"
    ),
    "shannon_neff": _scoring(
        f"SELECT resolution, cell, {_r('neff_observers')} FROM cells"
    ),
    "confidence": _scoring(
        f"SELECT resolution, cell, {_r(CONFIDENCE, 'confidence_scores')} FROM cells"
    ),
    "cell_scores": _scoring("SELECT * FROM scores"),
    "cell_scores_country": _scoring("SELECT * FROM scores", "IT"),
    "hot_key_join": _scoring("SELECT * FROM scores"),
    "score_summary": _with_summary("SELECT * FROM summary"),
    "score_summary_radix": _with_summary("SELECT * FROM summary"),
    "score_summary_ranked": _with_summary(" UNION ALL ".join(
        f"""SELECT resolution, '{column}' AS "column", unnest({list(probabilities)}) AS probability,
 unnest({name}) AS quantile FROM summary"""
        for column, (name, probabilities) in QUANTILES.items())),
    "score_summary_json": _with_summary(
        "SELECT CAST(row_number() OVER (ORDER BY resolution) - 1 AS INTEGER) AS place,"
        " * REPLACE (CAST(resolution AS VARCHAR) AS resolution) FROM summary"
    ),
    "cell_counts": _scoring(
        "SELECT resolution, count(*) AS n_cells FROM scores GROUP BY resolution"
    ),
    "feature_guard": _scoring("SELECT * FROM scores WHERE count_observers > 1"),
    "dateline_unwrap": _features(
        f"SELECT resolution, cell, {RING_TEXT} FROM ring GROUP BY resolution, cell"
    ),
    "cell_bbox": _features(f"""SELECT resolution, cell, {_r('swlat')}, {_r('swlng')},
 {_r('nelat')}, {_r('nelng')} FROM box"""),
    "cell_links": _features("""SELECT resolution, cell,
 'https://www.inaturalist.org/observations?' || string_agg(
  k || '=' || regexp_replace(CAST(v AS VARCHAR), '\\.0$', ''), '&' ORDER BY k)
 || '&subview=map&quality_grade=research' AS url
 FROM (UNPIVOT box ON nelat, nelng, swlat, swlng INTO NAME k VALUE v)
 GROUP BY resolution, cell"""),
    "cell_lookup": (
        f"WITH RECURSIVE {_filtered()},{HEXAGONS},{SCORING}\n"
        f"SELECT resolution, lower(hex(cell)) AS h3, cell, {SCORE_LIST} FROM scores"
        " QUALIFY cell = max(cell) OVER (PARTITION BY resolution)"
    ),
    "feature_json": _features(f"""SELECT s.resolution, s.cell, 'Feature' AS type,
 'Polygon' AS geometry_type, lower(hex(s.cell)) AS h3, s.count_species,
 {_r('a.lng', 'first_lng')}, {_r('c.lat', 'third_lat')}
 FROM scores s
 JOIN closed a ON a.resolution = s.resolution AND a.cell = s.cell AND a.i = 1
 JOIN closed c ON c.resolution = s.resolution AND c.cell = s.cell AND c.i = 3"""),
    "hexagon_cell_scores": (
        f"WITH RECURSIVE {_filtered()},{HEXAGONS},{SCORING}\nSELECT * FROM scores"
    ),
    "hexagon_boundaries": (
        f"WITH RECURSIVE {_filtered()},{HEXAGONS},{SCORING},{BOUNDARIES}\n"
        "SELECT r AS resolution, cell, count(*) AS n_vertices,"
        " string_agg(mark, ',' ORDER BY mark) AS vertices FROM marks GROUP BY r, cell"
    ),
    "hexagon_features": (
        f"WITH RECURSIVE {_filtered()},{HEXAGONS},{SCORING},{BOUNDARIES},\n"
        "positions AS (SELECT cell, x, y, z, row_number() OVER (PARTITION BY cell,"
        " round(x, 9), round(y, 9), round(z, 9)) AS copy FROM globe)\n"
        f"SELECT s.resolution, lower(hex(s.cell)) AS h3, {SCORE_LIST}, n_positions, TRUE AS closed,"
        f" {_r('swlat', places=5)}, {_r('nelat', places=5)}\n"
        "FROM scores s JOIN (SELECT cell, count(*) + 1 AS n_positions,"
        " min(degrees(atan2(z, sqrt(x * x + y * y)))) AS swlat,"
        " max(degrees(atan2(z, sqrt(x * x + y * y)))) AS nelat"
        " FROM positions WHERE copy = 1 GROUP BY cell) p ON p.cell = s.cell"
    ),
    "zoom_to_resolution": """SELECT zoom, CASE WHEN zoom >= 8 THEN 7 WHEN zoom >= 7 THEN 6
 WHEN zoom >= 5 THEN 5 WHEN zoom >= 4 THEN 4 ELSE 3 END AS resolution, count(*) AS n
 FROM (SELECT CAST(l_quantity AS INTEGER) % 14 AS zoom FROM lineitem) GROUP BY zoom""",
    "tile_index": _features("SELECT resolution, z, x, y, cell FROM tiled", TILES),
    "tile_thinning": _features(f"""SELECT resolution, z, x, y, cell FROM tiled
 WHERE ((cell % 1000003) * 7919 % 1000003) / CAST(1000003 AS DOUBLE)
  < pow(CAST({DROP_RATE} AS DOUBLE), z - z1)""", TILES),
    "tile_thinning_by_place": _features(f"""SELECT t.resolution, t.z, t.x, t.y, t.cell
FROM tiled t JOIN numbered n ON n.resolution = t.resolution AND n.cell = t.cell
WHERE list_reduce(list_concat([n.number], range(0, t.z1 - t.z)), lambda number, step:
 CASE WHEN number >= 0 AND floor((number + 1) / 2.5::DOUBLE) > floor(number / 2.5::DOUBLE)
  THEN CAST(floor(number / 2.5::DOUBLE) AS BIGINT) ELSE -1 END) >= 0""", TILES + f""",
centres AS (
 SELECT resolution, cell,
  CAST(floor(((min(lng) + max(lng)) / 2 + 180) / 360 * 65536) AS BIGINT) % 65536 AS cx,
  least(greatest(CAST(floor(((min(lat) + max(lat)) / 2 + 90) / 180 * 65536) AS BIGINT), 0), 65535) AS cy
 FROM closed GROUP BY resolution, cell),
numbered AS (
 SELECT resolution, cell, row_number() OVER (PARTITION BY resolution ORDER BY
  {" + ".join(f"((cx & {1 << k}) << {k}) + ((cy & {1 << k}) << {k + 1})" for k in range(16))}, cell) - 1 AS number
 FROM centres)"""),
    "tile_coalesce": _features("""SELECT resolution, z, x, y, count_species, count_observers,
 count(*) AS n_features, count(*) AS n_rings,
 string_agg(corners, ',' ORDER BY corners) AS boxes
 FROM tiled JOIN scores USING (resolution, cell) JOIN (
  SELECT resolution, cell, concat_ws(' ', CAST(round(swlng * 1000000) AS BIGINT),
   CAST(round(nelng * 1000000) AS BIGINT), CAST(round(swlat * 1000000) AS BIGINT),
   CAST(round(nelat * 1000000) AS BIGINT)) AS corners FROM box) USING (resolution, cell)
 GROUP BY resolution, z, x, y, count_species, count_observers""", TILES),
    "tile_dissolve": _features("""SELECT g.*, coalesce(n_edges, 0) AS n_edges, coalesce(edges, '') AS edges
FROM (SELECT resolution, z, x, y, count_species, count_observers, count(*) AS n_features
 FROM tiled JOIN scores USING (resolution, cell) GROUP BY ALL) g
LEFT JOIN (SELECT resolution, z, x, y, count_species, count_observers, count(*) AS n_edges,
  string_agg(edge, ',' ORDER BY edge) AS edges
 FROM (SELECT *, CASE WHEN turns > 0 THEN lx || ' ' || ly || ' ' || hx || ' ' || hy
   ELSE hx || ' ' || hy || ' ' || lx || ' ' || ly END AS edge, unnest(range(abs(turns))) AS copy FROM outline)
 GROUP BY resolution, z, x, y, count_species, count_observers) o USING (resolution, z, x, y, count_species, count_observers)""", TILES + """,
steps AS (
 SELECT resolution, cell, i, px, py, lead(px) OVER w AS qx, lead(py) OVER w AS qy
 FROM (SELECT resolution, cell, i, CAST(round(lng * 1000000) AS BIGINT) AS px,
  CAST(round(lat * 1000000) AS BIGINT) AS py FROM closed)
 WINDOW w AS (PARTITION BY resolution, cell ORDER BY i)),
directed AS (
 SELECT *, (px < qx OR px = qx AND py < qy) AS forward FROM steps
 WHERE qx IS NOT NULL AND (px <> qx OR py <> qy)),
members AS (
 SELECT *, count(*) OVER (PARTITION BY resolution, z, x, y, count_species, count_observers) AS n
 FROM tiled JOIN scores USING (resolution, cell)),
outline AS (
 SELECT resolution, z, x, y, count_species, count_observers, CASE WHEN n = 1 THEN i END AS own,
  CASE WHEN forward THEN px ELSE qx END AS lx, CASE WHEN forward THEN py ELSE qy END AS ly,
  CASE WHEN forward THEN qx ELSE px END AS hx, CASE WHEN forward THEN qy ELSE py END AS hy,
  CAST(sum(CASE WHEN forward THEN 1 ELSE -1 END) AS BIGINT) AS turns
 FROM members JOIN directed USING (resolution, cell)
 GROUP BY ALL HAVING turns <> 0)"""),
    "tile_snap": _features("""SELECT resolution, z, x, y, cell, string_agg(
  CAST(px AS VARCHAR) || ' ' || CAST(py AS VARCHAR), ',' ORDER BY i) AS ring
 FROM (SELECT * FROM snapped QUALIFY
  row(px, py) IS DISTINCT FROM lag(row(px, py)) OVER (PARTITION BY resolution, cell, z, wrap, y
   ORDER BY i))
 GROUP BY resolution, z, x, y, wrap, cell""", TILES + f""",
snapped AS (
 SELECT t.resolution, t.cell, t.z, t.x, t.y, t.wrap, c.i,
  CAST(round(((c.lng + 180) / 360 * pow(2.0, z) - wrap) * 4096) AS INTEGER) AS px,
  CAST(round(({_mercator('c.lat')} - y) * 4096) AS INTEGER) AS py
 FROM tiled t JOIN closed c ON c.resolution = t.resolution AND c.cell = t.cell)"""),
    "tile_layer": _features("""SELECT 'rarity_cells' AS layer, resolution, z,
 count(*) AS n_features FROM tiled GROUP BY resolution, z""", TILES),
    "feature_counts": _scoring(
        "SELECT resolution, count(*) AS n_features FROM scores GROUP BY resolution"
    ),
    "style_rarity": _with_summary(_styled("rarity_zscore")),
    "style_counts": _with_summary(" UNION ALL ".join(
        f"SELECT resolution, cell, '{m}' AS metric, fill_color FROM ({_styled(m)})"
        for m in ("count_observations", "count_species", "count_observers")
    )),
    "style_defaults": _with_summary(f"""SELECT a.resolution, a.cell, fill_color, rarity_color
 FROM ({_styled('count_species', 'resolution < 5')}) a
 JOIN ({_styled('rarity_zscore', 'resolution < 5', 'rarity_color')}) b
  ON a.resolution = b.resolution AND a.cell = b.cell"""),
    "read_tsv": f"""WITH {_filtered()}
SELECT gbifID, speciesKey, species, {_r('decimalLatitude')}, {_r('decimalLongitude')},
 {_r('coordinateUncertaintyInMeters')}, taxonRank, recordedBy FROM filtered""",
    "read_faulty_tsv": f"""WITH {_filtered()}
SELECT gbifID, speciesKey, species, {_r('decimalLatitude')}, {_r('decimalLongitude')},
 {_r('coordinateUncertaintyInMeters')}, taxonRank,
 recordedBy || CASE WHEN gbifID % 50 = 4 THEN '|a' || chr(9) || 'b "c"' ELSE '' END AS recordedBy
FROM filtered WHERE gbifID % 50 NOT IN (2, 3)""",
    "read_multiline_tsv": f"""WITH {_filtered()}
SELECT gbifID, speciesKey, species, {_r('decimalLatitude')}, {_r('decimalLongitude')},
 {_r('coordinateUncertaintyInMeters')}, taxonRank, recordedBy || CASE WHEN gbifID % 7 = 0
  THEN '|a' || chr(10) || 'b "c"' || chr(10) || chr(9) || chr(10) || 'd' ELSE '' END AS recordedBy
FROM filtered""",
    "read_utf16_tsv": f"""WITH {_filtered()}
SELECT gbifID, speciesKey, species, {_r('decimalLatitude')}, {_r('decimalLongitude')},
 {_r('coordinateUncertaintyInMeters')}, taxonRank, recordedBy, "order"
FROM filtered, (VALUES ('UTF-16LE'), ('UTF-16BE')) AS v("order")""",
    "geojson_lines": _scoring("""SELECT resolution, lower(hex(cell)) AS h3, count_species,
 count_observers, TRUE AS closed, count(*) OVER (PARTITION BY resolution) AS written FROM scores"""),
    "clustered_scores": _scoring("SELECT *, count(*) OVER () AS written FROM scores"),
    "whole_run_counts": f"""WITH RECURSIVE {_filtered()},{HEXAGONS},{SCORING},zooms(resolution, z0, z1) AS (VALUES {ZOOMS})
SELECT resolution, count(*) AS n_drawn, count(*) AS n_tiled, CAST(max(z1) AS INTEGER) AS max_zoom
FROM scores JOIN zooms USING (resolution) GROUP BY resolution""",
    "whole_run": f"WITH RECURSIVE {_filtered()},{HEXAGONS},{SCORING}\nSELECT * FROM scores",
    "style_opacity": _scoring(
        f"SELECT resolution, cell, {_r('confidence_scores * 0.75', 'fill_opacity', 9)} FROM scores"
    ),
}
