"""Queries of data-quality checks, geospatial functions and similarity."""

from pyspark.sql import functions as F

from ..functions import geo, profiles
from ..functions.similarity import matcher_similarity
from ..operators import checks as C
from ..operators import joins as J
from ..operators import nearby as N
from ..operators import project as P
from ..operators.counted import KeptCounts
from ..operators.shared import new_folder
from ..registry import query

YEAR = 2024


def picked(df, *pairs):
    """row_key and checks under short names."""
    return df.select("row_key", *(F.col(f"`{c}`").alias(n) for c, n in pairs))


DUP = "CASE WHEN {0} IS NOT NULL AND count(*) OVER (PARTITION BY {0}) > 1 THEN 1 ELSE 0 END"
NOLOC = "(latitude IS NULL OR longitude IS NULL)"


@query("dq_01_duplicate", f"SELECT row_key, {DUP.format('school_id_govt')} AS a, {DUP.format('school_id_giga')} AS b FROM fx_school")
def dq_01(t):
    return picked(C.duplicate_checks(t.fx_school, ["school_id_govt", "school_id_giga"]), ("dq_duplicate-school_id_govt", "a"), ("dq_duplicate-school_id_giga", "b"))


@query("dq_02_completeness", "SELECT row_key, CASE WHEN latitude IS NULL THEN 1 ELSE 0 END AS a, CASE WHEN school_name IS NULL THEN 1 ELSE 0 END AS b, 1 AS c, CASE WHEN education_level IS NULL THEN 1 ELSE 0 END AS d FROM fx_school")
def dq_02(t):
    made = C.completeness_checks(t.fx_school, ["school_name", "admin1"])
    return picked(made, ("dq_is_null_optional-latitude", "a"), ("dq_is_null_mandatory-school_name", "b"), ("dq_is_null_mandatory-admin1", "c"), ("dq_is_null_optional-education_level", "d"))


@query("dq_03_range", "SELECT row_key, CASE WHEN num_computers BETWEEN 0 AND 500 THEN 0 ELSE 1 END AS a, CASE WHEN latitude BETWEEN -90 AND 90 THEN 0 ELSE 1 END AS b, 1 AS c FROM fx_school")
def dq_03(t):
    made = C.range_checks(t.fx_school, {"num_computers": (0, 500), "latitude": (-90, 90), "num_teachers": (0, 200)})
    return picked(made, ("dq_is_invalid_range-num_computers", "a"), ("dq_is_invalid_range-latitude", "b"), ("dq_is_invalid_range-num_teachers", "c"))


@query("dq_04_domain", "SELECT row_key, CASE WHEN lower(connectivity_govt) IN ('yes', 'no') THEN 0 ELSE 1 END AS a, CASE WHEN lower(education_level) IN ('primary', 'secondary', 'pre-primary') THEN 0 ELSE 1 END AS b, 1 AS c FROM fx_school")
def dq_04(t):
    made = C.domain_checks(t.fx_school, {"connectivity_govt": ["Yes", "no"], "education_level": profiles.LEVELS, "computer_lab": ["yes"]})
    return picked(made, ("dq_is_invalid_domain-connectivity_govt", "a"), ("dq_is_invalid_domain-education_level", "b"), ("dq_is_invalid_domain-computer_lab", "c"))


def odd_texts(t):
    return t.fx_school.select("row_key", F.when(F.expr("row_key % 9 = 1"), "...").otherwise(F.col("school_name")).alias("school_name"), F.when(F.expr("row_key % 9 = 2"), "1e5").when(F.expr("row_key % 9 = 3"), "x").otherwise(F.col("num_computers").cast("string")).alias("num_computers"), F.when(F.expr("row_key % 9 = 4"), "not-an-id").otherwise(F.col("school_id_giga")).alias("school_id_giga"))


ODD = "SELECT row_key, CASE WHEN row_key % 9 = 1 THEN '...' ELSE school_name END AS school_name, CASE WHEN row_key % 9 = 2 THEN '1e5' WHEN row_key % 9 = 3 THEN 'x' ELSE CAST(num_computers AS VARCHAR) END AS num_computers, CASE WHEN row_key % 9 = 4 THEN 'not-an-id' ELSE school_id_giga END AS school_id_giga FROM fx_school"


@query("dq_05_not_alphanumeric", f"SELECT row_key, CASE WHEN NOT regexp_matches(school_name, '[A-Za-z0-9]') THEN 1 ELSE 0 END AS a FROM ({ODD})")
def dq_05(t):
    return picked(C.format_checks(odd_texts(t)), ("dq_is_not_alphanumeric-school_name", "a"))


@query("dq_06_not_numeric", rf"SELECT row_key, CASE WHEN NOT regexp_matches(num_computers, '^-?\d+(\.\d+)?$') THEN 1 ELSE 0 END AS a FROM ({ODD})")
def dq_06(t):
    return picked(C.format_checks(odd_texts(t)), ("dq_is_not_numeric-num_computers", "a"))


@query("dq_07_id_format", f"SELECT row_key, CASE WHEN school_id_giga = 'not-an-id' THEN 1 ELSE 0 END AS a FROM ({ODD})")
def dq_07(t):
    return picked(C.format_checks(odd_texts(t)), ("dq_is_not_36_character_hash-school_id_giga", "a"))


@query("dq_08_long_text", "SELECT row_key, CASE WHEN length(repeat(education_level, 30)) > 255 THEN 1 ELSE 0 END AS a FROM fx_school")
def dq_08(t):
    rows = t.fx_school.select("row_key", F.repeat("education_level", 30).alias("education_level"))
    return picked(C.length_checks(rows), ("dq_is_string_more_than_255_characters-education_level", "a"))


@query("dq_09_standard_suite", f"SELECT row_key, {DUP.format('school_id_giga')} AS a, CASE WHEN school_id_govt IS NULL THEN 1 ELSE 0 END AS b, CASE WHEN lower(electricity_type) = 'solar power station' THEN 0 ELSE 1 END AS c, CASE WHEN num_computers BETWEEN 0 AND 500 THEN 0 ELSE 1 END AS d, 0 AS e FROM fx_school")
def dq_09(t):
    made = C.standard_checks(t.fx_school, "geolocation", YEAR)
    return picked(made, ("dq_duplicate-school_id_giga", "a"), ("dq_is_null_mandatory-school_id_govt", "b"), ("dq_is_invalid_domain-electricity_type", "c"), ("dq_is_invalid_range-num_computers", "d"), ("dq_is_not_numeric-num_computers", "e"))


@query("dq_10_precision", "WITH x AS (SELECT row_key, CASE WHEN row_key % 8 = 0 THEN NULL WHEN row_key % 3 = 0 THEN CAST(row_key AS VARCHAR) ELSE CAST(row_key AS VARCHAR) || '.' || CAST(row_key * 7 AS VARCHAR) END AS latitude FROM fx_school) SELECT row_key, CASE WHEN latitude IS NULL THEN NULL WHEN length(split_part(latitude, '.', 2)) < 4 THEN 1 ELSE 0 END AS a FROM x")
def dq_10(t):
    rows = t.fx_school.select("row_key", F.expr("CASE WHEN row_key % 8 = 0 THEN NULL WHEN row_key % 3 = 0 THEN CAST(row_key AS STRING) ELSE CAST(row_key AS STRING) || '.' || CAST(row_key * 7 AS STRING) END").alias("latitude"))
    return picked(C.precision_checks(rows, {"latitude": 4, "longitude": 4}), ("dq_precision-latitude", "a"))


SIZE = "count(*) OVER (PARTITION BY {})"


@query("dq_11_duplicate_sets", f"SELECT row_key, CASE WHEN {NOLOC} THEN NULL WHEN {SIZE.format('school_name, education_level, latitude, longitude')} > 1 THEN 1 ELSE 0 END AS a, CASE WHEN {NOLOC} THEN NULL WHEN {SIZE.format('latitude, longitude')} > 1 THEN 1 ELSE 0 END AS b, CASE WHEN {NOLOC} THEN NULL ELSE {SIZE.format('latitude, longitude')} END AS c FROM fx_school")
def dq_11(t):
    made = C.duplicate_set_checks(t.fx_school)
    return picked(made, ("dq_duplicate_set-school_name_education_level_location_id", "a"), ("dq_duplicate_location_rows_flag", "b"), ("dq_duplicate_location_rows_count", "c"))


@query("win_02_location_groups", "WITH x AS (SELECT row_key, CAST(CAST(latitude * 1000 AS BIGINT) AS VARCHAR) AS latitude, CAST(CAST(longitude * 1000 AS BIGINT) AS VARCHAR) AS longitude FROM (SELECT row_key, floor(latitude * 1000) AS la, floor(longitude * 1000) AS lo, floor(latitude * 1000) / 1000 AS latitude, floor(longitude * 1000) / 1000 AS longitude FROM fx_school)) SELECT row_key, CASE WHEN latitude IS NULL THEN NULL ELSE substr(md5(concat_ws('_', longitude, latitude)), 1, 8) END AS id, CASE WHEN latitude IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY latitude, longitude) END AS n FROM x")
def win_02(t):
    rows = t.fx_school.select("row_key", *(F.floor(F.col(c) * 1000).cast("string").alias(c) for c in C.COORDINATES))
    return picked(C.duplicate_set_checks(rows, [["location_id"]]), ("dq_duplicate_location_rows_id", "id"), ("dq_duplicate_location_rows_count", "n"))


@query("dq_12_duplicate_all_except", f"SELECT row_key, CASE WHEN {NOLOC} THEN NULL WHEN {SIZE.format('school_name, education_level, latitude, longitude, connectivity_govt')} > 1 THEN 1 ELSE 0 END AS a FROM fx_school")
def dq_12(t):
    made = C.duplicate_all_except(t.fx_school, ["school_name", "education_level", "latitude", "longitude", "connectivity_govt", "absent"])
    return picked(made, ("dq_duplicate_all_except_school_code", "a"))


@query("win_03_all_columns", f"SELECT row_key, CASE WHEN {SIZE.format('school_name, education_level')} > 1 THEN 1 ELSE 0 END AS a FROM fx_school")
def win_03(t):
    return picked(C.duplicate_all_except(t.fx_school, ["school_name", "education_level"]), ("dq_duplicate_all_except_school_code", "a"))


CELL = "floor(latitude * 1000) / 1000, floor(longitude * 1000) / 1000"


@query("dq_13_name_level_cell", f"SELECT row_key, CASE WHEN {NOLOC} THEN NULL WHEN {SIZE.format('school_name, education_level, ' + CELL)} > 1 THEN 1 ELSE 0 END AS a FROM fx_school")
def dq_13(t):
    return picked(C.duplicate_name_level_check(t.fx_school), ("dq_duplicate_name_level_within_110m_radius", "a"))


@query("win_04_name_cell", f"SELECT row_key, CASE WHEN {NOLOC} THEN NULL WHEN {SIZE.format('school_name, education_level, ' + CELL)} > 1 THEN 1 ELSE 0 END AS a FROM (SELECT * REPLACE (CAST(row_key % 3 AS VARCHAR) AS school_name) FROM fx_school)")
def win_04(t):
    return picked(C.duplicate_name_level_check(t.fx_school.withColumn("school_name", F.expr("CAST(row_key % 3 AS STRING)"))), ("dq_duplicate_name_level_within_110m_radius", "a"))


@query("win_05_level_cell", f"SELECT row_key, CASE WHEN {SIZE.format('education_level, ' + CELL)} > 1 THEN 1 ELSE 0 END AS a FROM fx_school")
def win_05(t):
    return picked(C.duplicate_level_in_cell(t.fx_school), ("duplicate_level_within_110m_radius", "a"))


@query("agg_07_names_per_cell", "SELECT education_level, floor(latitude * 1000) / 1000 AS lat_110, floor(longitude * 1000) / 1000 AS long_110, coalesce(array_to_string(list_sort(list(DISTINCT school_name) FILTER (school_name IS NOT NULL)), ','), '') AS school_names FROM fx_school WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0) GROUP BY 1, 2, 3 HAVING count(*) > 1")
def agg_07(t):
    return C.names_per_cell(t.fx_school).withColumn("school_names", F.array_join("school_names", ","))


def axial_sql(lat="latitude", lon="longitude"):
    import math

    side, km = math.sqrt(2 * geo.HEX_KM2 / (3 * math.sqrt(3))), math.pi * geo.EARTH_KM / 180
    return f"SELECT *, CAST({lon} * cos(radians({lat})) * CAST({km!r} AS DOUBLE) AS DOUBLE) * CAST({math.sqrt(3) / 3 / side!r} AS DOUBLE) - {lat} * CAST({km!r} AS DOUBLE) * CAST({1 / 3 / side!r} AS DOUBLE) AS q, {lat} * CAST({km!r} AS DOUBLE) * CAST({2 / 3 / side!r} AS DOUBLE) AS r FROM fx_school"


HEX = f"""WITH a AS ({axial_sql()}), b AS (SELECT *, -q - r AS s, round_even(q, 0) AS rq, round_even(r, 0) AS rr, round_even(-q - r, 0) AS rs FROM a),
c AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM b),
h AS (SELECT row_key, school_id_giga, latitude, longitude, CASE WHEN latitude IS NULL OR longitude IS NULL THEN '0' ELSE CAST(CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS VARCHAR) END AS hex FROM c)"""


@query("geo_04_hex_cell", f"{HEX} SELECT row_key, hex FROM h")
def geo_04(t):
    return t.fx_school.select("row_key", geo.hex_cell("latitude", "longitude").alias("hex"))


DENSE = f"{HEX}, n AS (SELECT *, count(school_id_giga) OVER (PARTITION BY hex) AS n FROM h) SELECT row_key, CASE WHEN {NOLOC} THEN NULL WHEN n > 5 THEN 1 ELSE 0 END AS a, CASE WHEN {NOLOC} THEN NULL ELSE n END AS b, CASE WHEN {NOLOC} THEN NULL ELSE substr(md5(hex), 1, 8) END AS c FROM n"


@query("dq_15_density", DENSE)
def dq_15(t):
    return picked(C.density_check(t.fx_school), ("dq_is_school_density_greater_than_5", "a"), ("dq_school_density_count", "b"), ("dq_school_density_group_id", "c"))


@query("win_06_cell_size", DENSE.replace(" AS a, CASE", " AS flag, CASE").replace(" AS b, CASE", " AS n, CASE").replace(" AS c FROM n", " AS id FROM n"))
def win_06(t):
    return picked(C.density_check(t.fx_school), ("dq_is_school_density_greater_than_5", "flag"), ("dq_school_density_count", "n"), ("dq_school_density_group_id", "id"))


EDGES = "e AS (SELECT country_key, lon AS x1, lat AS y1, lead(lon) OVER w AS x2, lead(lat) OVER w AS y2 FROM fx_poly WINDOW w AS (PARTITION BY country_key, ring ORDER BY seq))"
CROSS = "((y1 > {y}) <> (y2 > {y})) AND {x} < (x2 - x1) * ({y} - y1) / (y2 - y1) + x1"
#: Distinct points of fx_place with the state that edges give them, for their own country; and for all countries that hold them.
STATE = f"""WITH {EDGES}, d AS (SELECT DISTINCT country_key, latitude AS y, longitude AS x FROM fx_place WHERE latitude IS NOT NULL),
p AS (SELECT d.y, d.x, e.* FROM d JOIN e ON d.country_key = e.country_key WHERE x2 IS NOT NULL),
k AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS a FROM p),
g AS (SELECT *, y1 + a * (y2 - y1) AS ny, x1 + a * (x2 - x1) AS nx FROM k),
state AS (SELECT country_key, y, x, count_if({CROSS.format(x='x', y='y')}) % 2 = 1 AS inside, min(2 * 6371.0088 * asin(sqrt(power(sin(radians(ny - y) / 2), 2) + cos(radians(y)) * cos(radians(ny)) * power(sin(radians(nx - x) / 2), 2)))) AS km FROM g GROUP BY 1, 2, 3)"""
HOLDING = f"""WITH {EDGES}, d AS (SELECT DISTINCT latitude AS y, longitude AS x FROM fx_place WHERE latitude IS NOT NULL),
h AS (SELECT d.y, d.x, e.country_key AS c FROM d JOIN e ON x2 IS NOT NULL AND {{some}} GROUP BY 1, 2, 3 HAVING count_if({CROSS.format(x='d.x', y='d.y')}) % 2 = 1),
holding AS (SELECT y, x, min(c) AS c FROM h GROUP BY 1, 2)"""
OWN = "FROM fx_place s LEFT JOIN state ON s.country_key = state.country_key AND s.latitude = y AND s.longitude = x"


def sides(t, where="TRUE"):
    return geo.edges(t.fx_poly.where(where), "country_key", rings=["ring"])


@query("geo_01_within", f"{STATE} SELECT row_key, inside AS within {OWN}")
def geo_01(t):
    return geo.within_own(t.fx_place, sides(t), "country_key").select("row_key", "within")


@query("jn_13_containing_polygon", f"{HOLDING.format(some='TRUE')} SELECT row_key, coalesce(n_name, school_name, 'Unknown') AS admin1 FROM fx_place LEFT JOIN holding ON latitude = y AND longitude = x LEFT JOIN nation ON c = n_nationkey")
def jn_13(t):
    hit = geo.containing(t.fx_place.drop("country_key"), sides(t), "country_key")
    return hit.join(t.nation, hit["country_key"] == t.nation["n_nationkey"], "left").select("row_key", F.coalesce("n_name", "school_name", F.lit("Unknown")).alias("admin1"))


@query("jn_13_region_names", f"{HOLDING.format(some='TRUE')} SELECT row_key, coalesce(CASE WHEN n_nationkey % 3 <> 0 THEN n_name END, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) END, admin1, 'Unknown') AS admin1, CAST(n_nationkey AS VARCHAR) || '-id' AS admin1_id FROM (SELECT *, CASE WHEN row_key % 2 = 0 THEN school_name END AS admin1 FROM fx_place) LEFT JOIN holding ON latitude = y AND longitude = x LEFT JOIN nation ON c = n_nationkey")
def jn_13_names(t):
    regions = t.nation.select(F.col("n_nationkey").alias("country_key"), F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name")).alias("name_en"), F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).alias("name"), F.concat(F.col("n_nationkey").cast("string"), F.lit("-id")).alias("id"))
    places = t.fx_place.drop("country_key").withColumn("admin1", F.when(F.col("row_key") % 2 == 0, F.col("school_name")))
    return geo.with_region(places, sides(t), regions, "country_key", "admin1", ["name_en", "name"], "id").select("row_key", "admin1", "admin1_id")


@query("jn_14_disputed_region", f"{HOLDING.format(some='e.country_key % 4 = 1')} SELECT row_key, c AS region FROM fx_place LEFT JOIN holding ON latitude = y AND longitude = x")
def jn_14(t):
    return geo.containing(t.fx_place.drop("country_key"), sides(t, "country_key % 4 = 1"), "country_key").select("row_key", F.col("country_key").alias("region"))


@query("geo_02_boundary_distance", f"{STATE} SELECT row_key, CASE WHEN km <= 0.15 THEN CAST(round(km * 1e6) AS BIGINT) END AS millimetres {OWN}")
def geo_02(t):
    return geo.boundary_km(t.fx_place, sides(t), "country_key", 0.15).select("row_key", F.round(F.col("boundary_km") * 1e6).cast("bigint").alias("millimetres"))


@query("dq_16_not_within", f"{STATE} SELECT row_key, CASE WHEN inside IS NULL THEN NULL WHEN NOT inside AND km > 0.1 THEN 1 ELSE 0 END AS a {OWN}")
def dq_16(t):
    return picked(C.not_within_check(t.fx_place, sides(t), "country_key", 0.1), ("dq_is_not_within_country", "a"))


@query("geo_03_distance", "SELECT row_key, 2 * 6371.0088 * asin(sqrt(power(sin(radians(0 - latitude) / 2), 2) + cos(radians(latitude)) * power(sin(radians(0 - longitude) / 2), 2))) < 1000 AS near FROM fx_school WHERE latitude IS NOT NULL")
def geo_03(t):
    km = geo.distance_km(F.col("latitude"), F.col("longitude"), F.lit(0.0), F.lit(0.0))
    return t.fx_school.where("latitude IS NOT NULL").select("row_key", (km < 1000).alias("near"))


#: The inverse problem on the ellipsoid of WGS 84, in twelve steps, each a table of the one before.
ELLIPSOID = """s0 AS (SELECT row_key, radians(longitude - 0) AS l, radians(longitude - 0) AS lam, 0.0::DOUBLE AS u, atan((1 - 1 / 298.257223563) * tan(radians(latitude))) AS v FROM fx_school WHERE latitude IS NOT NULL AND abs(latitude) + abs(longitude) > 0),"""
for _n in range(13):
    ELLIPSOID += f"""
a{_n} AS (SELECT *, sqrt(power(cos(v) * sin(lam), 2) + power(cos(u) * sin(v) - sin(u) * cos(v) * cos(lam), 2)) AS ss, sin(u) * sin(v) + cos(u) * cos(v) * cos(lam) AS cs FROM s{_n}),
b{_n} AS (SELECT *, atan2(ss, cs) AS arc, cos(u) * cos(v) * sin(lam) / ss AS az FROM a{_n}), c{_n} AS (SELECT *, 1 - az * az AS sq, CASE WHEN 1 - az * az <= 1e-15 THEN 0 ELSE cs - 2 * sin(u) * sin(v) / (1 - az * az) END AS m FROM b{_n}),
d{_n} AS (SELECT *, (1 / 298.257223563) / 16 * sq * (4 + (1 / 298.257223563) * (4 - 3 * sq)) AS k FROM c{_n}),
s{_n + 1} AS (SELECT row_key, l, l + (1 - k) * (1 / 298.257223563) * az * (arc + k * ss * (m + k * cs * (2 * m * m - 1))) AS lam, u, v FROM d{_n}),"""
ELLIPSOID = "WITH " + ELLIPSOID + """
w AS (SELECT *, sq * (power(6378.137, 2) - power(6378.137 * (1 - 1 / 298.257223563), 2)) / power(6378.137 * (1 - 1 / 298.257223563), 2) AS w FROM c12),
f AS (SELECT *, 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS big, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS small FROM w)
SELECT row_key, CAST(round(1e5 * 6378.137 * (1 - 1 / 298.257223563) * big * (arc - small * ss * (m + small / 4 * (cs * (2 * m * m - 1) - small / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3))))) AS BIGINT) AS centimetres FROM f"""


@query("geo_03_geodesic", ELLIPSOID)
def geo_03_geodesic(t):
    km = geo.geodesic_km(F.lit(0.0), F.lit(0.0), F.col("latitude"), F.col("longitude"))
    return t.fx_school.where("latitude IS NOT NULL AND abs(latitude) + abs(longitude) > 0").select("row_key", F.round(km * 1e5).cast("bigint").alias("centimetres"))


@query("geo_05_cell_floor", "SELECT row_key, floor(latitude * 1000) / 1000 AS lat, floor(longitude * 1000) / 1000 AS lon FROM fx_school")
def geo_05(t):
    return t.fx_school.select("row_key", geo.cell_floor("latitude").alias("lat"), geo.cell_floor("longitude").alias("lon"))


#: Three uploads; the second deletes some rows of the first, the third some of the second.
UPLOADED = "u AS (SELECT *, row_key % 3 AS upload FROM fx_school), kept AS (SELECT * FROM u WHERE NOT (upload = 0 AND row_key % 15 = 0) AND NOT (upload = 1 AND row_key % 14 = 1))"
KEPT = f"""WITH {UPLOADED}, g AS (SELECT school_id_govt, count(*) AS n FROM kept GROUP BY 1), p AS (SELECT latitude, longitude, education_level, count(*) AS n FROM kept GROUP BY ALL)
SELECT row_key, CASE WHEN g.n > 1 THEN 1 ELSE 0 END AS id, CASE WHEN p.n > 1 THEN 1 ELSE 0 END AS place FROM kept k LEFT JOIN g ON k.school_id_govt = g.school_id_govt LEFT JOIN p ON k.latitude = p.latitude AND k.longitude = p.longitude AND k.education_level = p.education_level WHERE upload = 2"""


@query("dq_01_kept_counts", KEPT)
def dq_01_kept(t):
    kept = KeptCounts(t.spark, new_folder(t.spark, "counts"), {"id": ["school_id_govt"], "place": ["latitude", "longitude", "education_level"]})
    one, two, three = (t.fx_school.where(f"row_key % 3 = {k}") for k in range(3))
    kept.add("one", one)
    kept.add("two", two, deleted=one.where("row_key % 15 = 0"))
    kept.add("three", three, deleted=two.where("row_key % 14 = 1"))
    return kept.flagged(three).select("row_key", F.col("dq_duplicate-id").alias("id"), F.col("dq_duplicate-place").alias("place"))


@query("dq_18_percent_sum", "SELECT school_key, percent_2g, percent_3g, percent_4g, CASE WHEN percent_2g + percent_3g + percent_4g <> 100 THEN 1 ELSE 0 END AS bad FROM fx_cov_a")
def dq_18(t):
    return C.percent_sum_check(t.fx_cov_a, ["percent_2g", "percent_3g", "percent_4g"], "bad")


CRITICAL = "SELECT row_key, CASE WHEN school_id_govt IS NULL OR n IS NULL OR d > 1 THEN 1 ELSE 0 END AS dq_has_critical_error, concat_ws(', ', CASE WHEN d > 1 THEN 'duplicate-school_id_govt' END, CASE WHEN n IS NULL THEN 'is_null_mandatory-school_name' END) AS failure_reason FROM (SELECT row_key, school_id_govt, CASE WHEN school_name IS NULL AND school_id_giga IS NULL THEN NULL ELSE 1 END AS n, count(*) OVER (PARTITION BY school_id_govt) AS d FROM fx_school)"


@query("dq_19_critical", CRITICAL)
def dq_19(t):
    made = C.completeness_checks(C.duplicate_checks(t.fx_school, ["school_id_govt"]), ["school_id_govt", "school_name"]).withColumn("is_new", F.col("school_id_giga").isNull())
    made = C.critical_checks(made, ["dq_duplicate-school_id_govt", "dq_is_null_mandatory-school_id_govt", "dq_absent"], ["dq_is_null_mandatory-school_name"])
    return made.select("row_key", "dq_has_critical_error", "failure_reason")


@query("dq_20_suite_with_boundaries", f"{STATE.replace('fx_place', 'fx_school')} SELECT row_key, CASE WHEN school_id_govt IS NULL OR count(*) OVER (PARTITION BY school_id_govt) > 1 THEN 1 ELSE 0 END AS critical, CASE WHEN {NOLOC} THEN NULL WHEN {SIZE.format('latitude, longitude')} > 1 THEN 1 ELSE 0 END AS location, CASE WHEN inside IS NULL THEN NULL WHEN NOT inside AND km > 0.1 THEN 1 ELSE 0 END AS off {OWN.replace('fx_place', 'fx_school')}")
def dq_20(t):
    rows = t.fx_school.withColumn("is_new", F.lit(True))
    made = C.suite(rows, "geolocation", YEAR, always=["dq_is_null_mandatory-school_id_govt", "dq_duplicate-school_id_govt"], sides=sides(t), id_col="row_key", polygon="country_key", most_km=0.1)
    return picked(made, ("dq_has_critical_error", "critical"), ("dq_duplicate_location_rows_flag", "location"), ("dq_is_not_within_country", "off"))


@query("dq_21_warned", "SELECT row_key, latitude IS NULL OR education_level IS NULL AS warned FROM fx_school")
def dq_21(t):
    made = P.checks_to_map(C.completeness_checks(t.fx_school, []))
    return made.select("row_key", C.warned(F.col("dq_results"), ["is_null_optional-latitude", "is_null_optional-education_level", "absent"]).alias("warned"))


@query("dq_22_readable", f"""SELECT row_key, CASE WHEN {NOLOC} THEN NULL WHEN n > 1 THEN 'No' ELSE 'Yes' END AS "One at this place", CASE WHEN n > 1 AND NOT {NOLOC} THEN n END AS count FROM (SELECT *, {SIZE.format('latitude, longitude')} AS n FROM fx_school)""")
def dq_22(t):
    made = C.duplicate_set_checks(t.fx_school, [["location_id"]])
    made = made.select("row_key", "dq_duplicate_location_rows_flag", F.when(F.col("dq_duplicate_location_rows_count") > 1, F.col("dq_duplicate_location_rows_count")).alias("count"))
    return P.readable_flags(made, {"dq_duplicate_location_rows_flag": "One at this place"})


@query("flt_05_relevant_checks", "SELECT row_key, 'is_null_optional-latitude' AS k, CASE WHEN latitude IS NULL THEN 1 ELSE 0 END AS v FROM fx_school UNION ALL SELECT row_key, 'is_null_optional-education_level', CASE WHEN education_level IS NULL THEN 1 ELSE 0 END FROM fx_school")
def flt_05(t):
    made = P.checks_to_map(C.completeness_checks(t.fx_school, []))
    names = C.relevant_checks(["latitude", "school_name"], {"is_null_optional-latitude": ["latitude"], "is_null_optional-education_level": [], "is_null_optional-longitude": ["latitude", "longitude"]}, always=["is_null_optional-education_level"])
    return C.keep_checks(made, names).select("row_key", F.explode("dq_results").alias("k", "v"))


NAMES = """n AS (SELECT DISTINCT education_level, CAST(floor(latitude * 1000) AS BIGINT) AS la, CAST(floor(longitude * 1000) AS BIGINT) AS lo, school_name AS s FROM fx_school WHERE school_name IS NOT NULL AND latitude IS NOT NULL),
pairs AS (SELECT a.education_level, a.la, a.lo, a.s AS x, b.s AS y FROM n a JOIN n b ON a.education_level IS NOT DISTINCT FROM b.education_level AND a.la = b.la AND a.lo = b.lo AND a.s < b.s),
lcs AS (SELECT x, y, 0 AS i, list_transform(range(0, length(y) + 1), lambda j: 0) AS best FROM (SELECT DISTINCT x, y FROM pairs) UNION ALL
SELECT x, y, i + 1, list_transform(range(1, length(y) + 2), lambda j: greatest(best[j], coalesce(list_max(list_transform(range(2, j + 1), lambda k: CASE WHEN y[k - 1] = x[i + 1] THEN best[k - 1] + 1 ELSE 0 END)), 0))) FROM lcs WHERE i < length(x)),
ratios AS (SELECT x, y, 2.0 * best[length(y) + 1] / (length(x) + length(y)) AS ratio FROM lcs WHERE i = length(x))"""


def name_pairs(t, cutoff):
    names = t.fx_school.where("latitude IS NOT NULL").select("school_name", "education_level", F.floor(F.col("latitude") * 1000).alias("la"), F.floor(F.col("longitude") * 1000).alias("lo"))
    return J.similar_pairs(names, "school_name", ["education_level", "la", "lo"], cutoff)


@query("sim_01_indel_ratio", f"WITH RECURSIVE {NAMES} SELECT p.*, CAST(round(ratio, 9) AS DOUBLE) AS similarity FROM pairs p JOIN ratios USING (x, y) WHERE ratio > 0.7")
def sim_01(t):
    return name_pairs(t, 0.7).where("similarity > 0.7").withColumn("similarity", F.round("similarity", 9))


#: Pairs of classes of rows within 0.1 km, by distance alone.
KM = "2 * 6371.0088 * asin(sqrt(least(power(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * power(sin(radians(b.longitude - a.longitude) / 2), 2), 1)))"
WITHIN = f"""c AS (SELECT education_level, school_name, latitude, longitude, min(row_key) AS first, count(*) AS size FROM fx_near WHERE school_name IS NOT NULL GROUP BY ALL),
w AS (SELECT a.first AS a, b.first AS b, least(a.school_name, b.school_name) AS x, greatest(a.school_name, b.school_name) AS y, {KM} AS km FROM c a JOIN c b ON a.first < b.first AND a.education_level IS NOT DISTINCT FROM b.education_level AND {KM} <= 0.1),
pairs AS (SELECT x, y FROM w WHERE x < y), {NAMES[NAMES.index('lcs AS') :]},
links AS (SELECT a, b, km, coalesce(ratio, 1) AS similarity FROM w LEFT JOIN ratios USING (x, y) WHERE x = y OR ratio >= 0.7)"""


@query("jn_23_pairs_within", f"WITH RECURSIVE {WITHIN} SELECT a, b, CAST(round(km * 1e6) AS BIGINT) AS millimetres, CAST(round(similarity, 9) AS DOUBLE) AS similarity FROM links")
def jn_23_pairs(t):
    pairs = N.pairs_within(t.fx_near, "row_key", 0.1, ["education_level"], name="school_name", cutoff=0.7)
    return pairs.select("a", "b", F.round(F.col("km") * 1e6).cast("bigint").alias("millimetres"), F.round("similarity", 9).alias("similarity"))


@query("jn_23_members", f"WITH RECURSIVE {WITHIN} SELECT row_key, first, size FROM fx_near n JOIN c ON n.school_name = c.school_name AND n.education_level IS NOT DISTINCT FROM c.education_level AND n.latitude IS NOT DISTINCT FROM c.latitude AND n.longitude = c.longitude")
def jn_23_members(t):
    rows, columns = t.fx_near.where("school_name IS NOT NULL"), ["education_level", "school_name", "latitude", "longitude"]
    return N.members(rows, N.classes(rows, "row_key", columns), "row_key", columns)


@query("jn_23_flags", f"WITH RECURSIVE {WITHIN}, e AS (SELECT first, count(*) AS links, count_if(similarity = 1) AS equal FROM (SELECT unnest([a, b]) AS first, similarity FROM links) GROUP BY 1) SELECT row_key, CASE WHEN n.latitude IS NOT NULL THEN CASE WHEN size > 1 OR equal > 0 THEN 1 ELSE 0 END END AS same_name, CASE WHEN n.latitude IS NOT NULL THEN CASE WHEN size > 1 OR links > 0 THEN 1 ELSE 0 END END AS similar_name FROM fx_near n LEFT JOIN c ON n.school_name = c.school_name AND n.education_level IS NOT DISTINCT FROM c.education_level AND n.latitude = c.latitude AND n.longitude = c.longitude LEFT JOIN e ON c.first = e.first")
def jn_23_flags(t):
    return N.near_flags(t.fx_near, "row_key", 0.1, ["education_level"], "school_name", 0.7).select("row_key", "same_name", "similar_name")


#: The longest common block of a range of either name (the first in x, then the first in y), then the ranges before and behind it, each of which counts it: twice the blocks.
BLOCKS = """blocks AS (SELECT x, y, 0 AS size, unnest([{'a': 1, 'b': length(x) + 1, 'c': 1, 'd': length(y) + 1}]) AS r FROM (SELECT DISTINCT x, y FROM pairs) UNION ALL
SELECT x, y, best.size, unnest([{'a': r.a, 'b': best.i, 'c': r.c, 'd': best.j}, {'a': best.i + best.size, 'b': r.b, 'c': best.j + best.size, 'd': r.d}]) FROM (SELECT x, y, r, list_max(list_transform(range(r.a, r.b), lambda i:
list_max(list_transform(range(r.c, r.d), lambda j: {'size': len(list_filter(range(1, least(r.b - i, r.d - j) + 1), lambda n: x[i:i + n - 1] = y[j:j + n - 1])), 'less_i': -i, 'less_j': -j, 'i': i, 'j': j})))) AS best
FROM blocks WHERE r.a < r.b AND r.c < r.d) WHERE best.size > 0),
ratios AS (SELECT x, y, sum(size) / (length(x) + length(y)) AS ratio FROM blocks GROUP BY x, y)"""


@query("sim_02_matcher_ratio", f"WITH RECURSIVE {NAMES[: NAMES.index('lcs AS')]}{BLOCKS} SELECT p.*, CAST(round(ratio, 9) AS DOUBLE) AS similarity FROM pairs p JOIN ratios USING (x, y) WHERE ratio >= 0.7 AND ratio < 1")
def sim_02(t):
    # blocks of the matcher are a common subsequence, so the indel ratio is never below its own
    return name_pairs(t, 0.7).withColumn("similarity", matcher_similarity("x", "y")).where("similarity >= 0.7 AND similarity < 1").withColumn("similarity", F.round("similarity", 9))


@query("dq_14_similar_names", f"WITH RECURSIVE {NAMES}, hit AS (SELECT DISTINCT education_level, la, lo, unnest([x, y]) AS s FROM pairs JOIN ratios USING (x, y) WHERE ratio > 0.7) SELECT row_key, CASE WHEN {NOLOC} THEN NULL WHEN hit.s IS NULL THEN 0 ELSE 1 END AS a FROM fx_school f LEFT JOIN hit ON f.education_level IS NOT DISTINCT FROM hit.education_level AND floor(f.latitude * 1000) = la AND floor(f.longitude * 1000) = lo AND f.school_name = hit.s")
def dq_14(t):
    return picked(C.similar_name_check(t.fx_school), ("dq_similar_name_level_within_110m_radius", "a"))
