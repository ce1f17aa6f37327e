"""Data-quality checks. Each adds integer columns dq_<assertion>[-<column>]: 1 fails, 0 passes, null doesn't apply."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, profiles
from .joins import similar_pairs
from .project import col, decimals
from .shared import cut
from .windows import no_location, with_group_size

COORDINATES = ("latitude", "longitude")


def fails(when: Column) -> Column:
    """1 where the condition holds, 0 where it doesn't or isn't known."""
    return F.when(when, 1).otherwise(0)


def fails_unless(when: Column) -> Column:
    return F.when(when, 0).otherwise(1)


def _grouped(df: DataFrame, keys: Sequence[Column | str], columns: dict[str, callable], base: DataFrame | None = None) -> DataFrame:
    """df with columns made of the size of its group, counted before any shuffle of whole rows; null where it is under two."""
    return with_group_size(df, keys, "_size", base=base).withColumns({n: f(F.col("_size")) for n, f in columns.items()}).drop("_size")


def duplicate_checks(df: DataFrame, columns: Iterable[str], base: DataFrame | None = None) -> DataFrame:
    """dq_duplicate-<column>: the value repeats. Nulls never do."""
    base = df if base is None else base
    return reduce(lambda d, c: _grouped(d, [c], {f"dq_duplicate-{c}": lambda n, c=c: fails(n.isNotNull() & col(c).isNotNull())}, base), [c for c in columns if c in df.columns], df)


def completeness_checks(df: DataFrame, mandatory: Iterable[str]) -> DataFrame:
    """Null checks: optional for all other columns (coordinates that are NaN too), mandatory for these, which fail if absent."""
    mandatory = list(mandatory)
    numbers = {c for c, t in df.dtypes if t in ("double", "float")}
    missing = lambda c: col(c).isNull() | F.isnan(col(c)) if c in COORDINATES and c in numbers else col(c).isNull()
    optional = {f"dq_is_null_optional-{c}": fails(missing(c)) for c in df.columns if c not in mandatory and not c.startswith("dq_")}
    return df.withColumns(optional | {f"dq_is_null_mandatory-{c}": fails(col(c).isNull()) if c in df.columns else F.lit(1) for c in mandatory})


def range_checks(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """dq_is_invalid_range-<column>. Null, what is no number and an absent column fail."""
    return df.withColumns({f"dq_is_invalid_range-{c}": fails_unless(col(c).try_cast("double").between(a, b)) if c in df.columns else F.lit(1) for c, (a, b) in ranges.items()})


def domain_checks(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """dq_is_invalid_domain-<column>, regardless of case. Null and an absent column fail."""
    return df.withColumns({f"dq_is_invalid_domain-{c}": fails_unless(F.lower(col(c).cast("string")).isin([str(v).lower() for v in values])) if c in df.columns else F.lit(1) for c, values in domains.items()})


ID_PATTERN = r"\b[a-fA-F0-9]{8}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{4}-[a-fA-F0-9]{12}\b"


def format_checks(df: DataFrame, types: Mapping[str, str] = profiles.EXPECTED_TYPES, id_col: str = "school_id_giga") -> DataFrame:
    """Texts without letter or digit, numbers that aren't written as such, ids that hold none of 36 characters. Nulls pass, and so do columns that are of a number's type."""
    made, held = {}, dict(df.dtypes)
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double")
    for c in df.columns:
        kind, text = types.get(c), col(c).cast("string")
        if kind == "string":
            made[f"dq_is_not_alphanumeric-{c}"] = fails(~text.rlike("[A-Za-z0-9]"))
        elif kind in ("int", "double", "bigint", "timestamp"):
            made[f"dq_is_not_numeric-{c}"] = F.lit(0) if held[c] in numbers else fails(~text.rlike(r"^-?\d+(\.\d+)?$"))
        if c == id_col:
            made[f"dq_is_not_36_character_hash-{c}"] = fails(~text.rlike(ID_PATTERN))
    return df.withColumns(made)


def length_checks(df: DataFrame, most: int = 255, types: Mapping[str, str] = profiles.EXPECTED_TYPES, skip: Iterable[str] = ("school_name",)) -> DataFrame:
    texts = [c for c in df.columns if c not in skip and not c.startswith("dq") and types.get(c, "string") == "string"]
    return df.withColumns({f"dq_is_string_more_than_{most}_characters-{c}": fails(F.length(col(c).cast("string")) > most) for c in texts})


def standard_checks(df: DataFrame, dataset: str, year: int, *, duplicate: bool = True, completeness: bool = True, domain: bool = True, range_: bool = True, format_: bool = True, length: bool = True) -> DataFrame:
    """The checks that every dataset has, by its profile; each can be left out."""
    if duplicate:
        df = duplicate_checks(df, profiles.UNIQUE[dataset], df)
    if completeness:
        df = completeness_checks(df, profiles.MANDATORY[dataset])
    if domain:
        df = domain_checks(df, profiles.DOMAINS.get(dataset, {}))
    if range_:
        df = range_checks(df, profiles.ranges(dataset, year))
    if format_:
        df = format_checks(df)
    return length_checks(df) if length else df


def precision_checks(df: DataFrame, least: Mapping[str, int] = profiles.PRECISION) -> DataFrame:
    """dq_precision-<column>: fewer digits after the point than asked for; null stays null."""
    return df.withColumns({f"dq_precision-{c}": F.when(col(c).isNotNull(), fails(decimals(c) < n)) for c, n in least.items() if c in df.columns})


def location_id() -> Column:
    return F.concat_ws("_", *(col(c).cast("string") for c in reversed(COORDINATES)))


def here(c: Column) -> Column:
    """Null without coordinates."""
    return F.when(~no_location(), c)


def duplicate_set_checks(df: DataFrame, sets: Sequence[Sequence[str]] = profiles.DUPLICATE_SETS, base: DataFrame | None = None) -> DataFrame:
    """A flag a set of columns, null without coordinates; `location_id` stands for the two coordinates. The set of that
    alone also gives the group's size and an eight-character id."""
    base = df if base is None else base
    for keys in sets:
        columns = {f"dq_duplicate_set-{'_'.join(keys)}": lambda n: here(fails(n.isNotNull()))}
        if list(keys) == ["location_id"]:
            columns = {
                "dq_duplicate_location_rows_flag": lambda n: here(fails(n.isNotNull())),
                "dq_duplicate_location_rows_count": lambda n: here(F.coalesce(n, F.lit(1))),
                "dq_duplicate_location_rows_id": lambda n: here(F.substring(F.md5(location_id()), 1, 8)),
            }
        df = _grouped(df, [location_id() if k == "location_id" else k for k in keys], columns, base)
    return df


def duplicate_all_except(df: DataFrame, columns: Iterable[str], out: str = "dq_duplicate_all_except_school_code", base: DataFrame | None = None) -> DataFrame:
    """Rows equal in all these columns. They are counted by one hash of all, told apart by its 128 bits."""
    there = [c for c in columns if c in df.columns]
    whole = F.md5(F.to_json(F.struct(*(col(c) for c in there)), {"ignoreNullFields": "false"}))
    flag = lambda n: here(fails(n.isNotNull())) if set(COORDINATES) <= set(there) else fails(n.isNotNull())
    return _grouped(df, [whole], {out: flag}, base)


def cell() -> list[Column]:
    """Latitude and longitude of the cell of 0.001 degrees."""
    return [geo.cell_floor(c) for c in COORDINATES]


def duplicate_name_level_check(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Same name and level in the same cell of 0.001 degrees; null without coordinates."""
    return _grouped(df, ["school_name", "education_level", *cell()], {"dq_duplicate_name_level_within_110m_radius": lambda n: here(fails(n.isNotNull()))}, base)


def duplicate_level_in_cell(df: DataFrame, base: DataFrame | None = None) -> DataFrame:
    return _grouped(df, ["education_level", *cell()], {"duplicate_level_within_110m_radius": lambda n: fails(n.isNotNull())}, base)


def on_valid_place() -> Column:
    return ~no_location() & ~((F.col("latitude") == 0) & (F.col("longitude") == 0))


def names_per_cell(df: DataFrame) -> DataFrame:
    """Names of each level and cell that has two rows or more, with valid coordinates."""
    la, lo = cell()
    cells = df.where(on_valid_place()).groupBy("education_level", la.alias("lat_110"), lo.alias("long_110")).agg(F.sort_array(F.collect_set("school_name")).alias("school_names"), F.count(F.lit(1)).alias("n"))
    return cells.where("n > 1").drop("n")


def similar_name_check(df: DataFrame, cutoff: float = 0.7, out: str = "dq_similar_name_level_within_110m_radius", base: DataFrame | None = None) -> DataFrame:
    """Another, different name of the same level and cell is more similar than the cut-off; null without coordinates.

    Distinct names of a cell are compared once, however many rows repeat them; the level may be null on both sides."""
    la, lo = cell()
    level = F.coalesce("education_level", F.lit(""))
    names = (df if base is None else base).where(on_valid_place() & F.col("school_name").isNotNull()).select(F.col("school_name").alias("_n"), level.alias("_level"), la.alias("_la"), lo.alias("_lo"))
    pairs = similar_pairs(names, "_n", ["_level", "_la", "_lo"], cutoff)
    close = pairs.where(F.col("similarity") > cutoff).select("_level", "_la", "_lo", F.explode(F.array("x", "y")).alias("_n")).distinct().withColumn("_hit", F.lit(1))
    same = (F.col("school_name") == F.col("_n")) & (level == F.col("_level")) & (la == F.col("_la")) & (lo == F.col("_lo"))
    return df.join(close, same, "left").withColumn(out, here(F.coalesce("_hit", F.lit(0)))).drop("_n", "_level", "_la", "_lo", "_hit")


def density_check(df: DataFrame, id_col: str = "school_id_giga", most: int = profiles.DENSE, base: DataFrame | None = None) -> DataFrame:
    """More than `most` ids in a hexagon: flag, count and group id; null without coordinates.

    Only hexagons of two rows or more are joined back, so that few of them are a broadcast; rows without coordinates, which share a cell, go by their id, which meets none."""
    hexagon = geo.hex_cell("latitude", "longitude")
    key = F.when(~no_location(), hexagon).otherwise(F.concat(F.lit("0:"), F.xxhash64(id_col).cast("string"), F.lit(":")))
    sizes = (df if base is None else base).where(~no_location()).groupBy(hexagon.alias("_hex")).agg(F.count(id_col).alias("_n"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    n = F.coalesce("_n", col(id_col).isNotNull().cast("bigint"))
    made = {"dq_is_school_density_greater_than_5": here(fails(n > most)), "dq_school_density_count": here(n), "dq_school_density_group_id": here(F.substring(F.md5(hexagon), 1, 8))}
    return df.join(sizes, key == F.col("_hex"), "left").withColumns(made).drop("_hex", "_n", "_rows")


def not_within_check(df: DataFrame, sides: DataFrame, polygon: str, most_km: float = 1.5, out: str = "dq_is_not_within_country", ellipsoid: bool = False) -> DataFrame:
    """Outside the polygon of the row's key and farther from its boundary than most_km, on the sphere or the ellipsoid; null without coordinates."""
    return geo.off_limits(df, sides, polygon, most_km, out=out, ellipsoid=ellipsoid).withColumn(out, F.col(out).cast("int"))


def _all_or_none(*columns: Column) -> Column:
    some = reduce(lambda a, b: a | b, (c.isNotNull() for c in columns))
    each = reduce(lambda a, b: a & b, (c.isNotNull() for c in columns))
    return fails(some & ~each)


SITE_PAIRS = (("nearest_NR_id", "5g_cell_site_dist"), ("nearest_LTE_id", "4g_cell_site_dist"), ("nearest_UMTS_id", "3g_cell_site_dist"), ("nearest_GSM_id", "2g_cell_site_dist"))
REAL_TIME = ("connectivity_RT", "connectivity_RT_datasource", "connectivity_RT_ingestion_timestamp")


def relation_checks(df: DataFrame, dataset: str) -> DataFrame:
    """Columns that must agree with each other, by dataset; a column that is absent counts as null."""
    c = lambda n: col(n) if n in df.columns else F.lit(None).cast("string")
    low = lambda n: F.lower(c(n))
    is_no = lambda n: F.coalesce(low(n) == "no", F.lit(True))
    rules: dict[tuple[str, ...], Column] = {}
    if dataset in ("master", "geolocation"):
        rules["connectivity_govt", "download_speed_contracted"] = fails(c("download_speed_contracted").isNotNull() & c("connectivity_govt").isNull())
        rules["electricity_availability", "electricity_type"] = fails((low("electricity_availability") == "yes") & c("electricity_type").isNull())
    if dataset == "master":
        told = (low("connectivity_RT") == "yes") | (low("connectivity_govt") == "yes") | c("download_speed_contracted").isNotNull()
        silent = is_no("connectivity_RT") & is_no("connectivity_govt") & c("download_speed_contracted").isNull()
        rules["connectivity", "connectivity_RT", "connectivity_govt", "download_speed_contracted"] = fails_unless(((low("connectivity") == "yes") & told) | ((low("connectivity") == "no") & silent))
        kind = low("cellular_coverage_type")
        agree = ((low("cellular_coverage_availability") == "yes") & kind.isin("2g", "3g", "4g", "5g")) | ((low("cellular_coverage_availability") == "no") & (kind == "no coverage"))
        rules["cellular_coverage_availability", "cellular_coverage_type"] = fails_unless(agree | (c("cellular_coverage_availability").isNull() & c("cellular_coverage_type").isNull()))
        rules["connectivity_govt", "connectivity_govt_ingestion_timestamp"] = fails((low("connectivity_govt") == "yes") & c("connectivity_govt_ingestion_timestamp").isNull())
    if dataset in ("master", "qos"):
        rules[REAL_TIME] = _all_or_none(*map(c, REAL_TIME))
    if dataset in ("coverage", "coverage_itu"):
        rules |= {pair: _all_or_none(*map(c, pair)) for pair in SITE_PAIRS}
    return df.withColumns({f"dq_column_relation_checks-{'_'.join(names)}": rule for names, rule in rules.items()})


def percent_sum_check(df: DataFrame, columns: Sequence[str] = ("percent_2G", "percent_3G", "percent_4G"), out: str = "dq_is_sum_of_percent_not_equal_100") -> DataFrame:
    """The sum isn't 100; one that is null passes."""
    return df.withColumn(out, fails(reduce(lambda a, b: a + b, (col(c) for c in columns)) != 100))


def critical_checks(df: DataFrame, always: Iterable[str], create_only: Iterable[str] = (), is_new: str = "is_new", readable: Mapping[str, str] | None = None) -> DataFrame:
    """dq_has_critical_error, the greatest of the chosen checks (create_only ones for new rows), and failure_reason, their names."""
    name = lambda c: F.lit((readable or {}).get(c, c.removeprefix("dq_")))
    hits = [(F.coalesce(col(c) == 1, F.lit(False)), c) for c in always if c in df.columns]
    hits += [(F.coalesce(col(is_new) & (col(c) == 1), F.lit(False)), c) for c in create_only if c in df.columns]
    any_hit = reduce(lambda a, b: a | b, (h for h, _ in hits), F.lit(False))
    return df.withColumns({"dq_has_critical_error": fails(any_hit), "failure_reason": F.concat_ws(", ", *(F.when(h, name(c)) for h, c in hits)) if hits else F.lit("")})


def default_critical(dataset: str) -> list[str]:
    checks = [f"dq_is_null_mandatory-{c}" for c in profiles.MANDATORY[dataset]]
    return checks + ["dq_duplicate-school_id_giga"] * (dataset not in ("master", "geolocation"))


def suite(df: DataFrame, dataset: str, year: int, *, always: Sequence[str] | None = None, create_only: Sequence[str] = (), sides: DataFrame | None = None, id_col: str | None = None, polygon: str | None = None, most_km: float = 1.5) -> DataFrame:
    """All checks of a dataset in their order; with boundary edges also the geographic one. For geolocation the critical error comes before the relations.

    The rows are dealt out evenly and checkpointed once: every count of the suite reads them again, and a table of few bytes, which Spark reads in few tasks, can have many rows."""
    df = base = cut(df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    df = standard_checks(df, dataset, year)
    if dataset in ("master", "geolocation"):
        df = duplicate_set_checks(df, base=base)
        df = precision_checks(df)
        df = duplicate_all_except(df, [c for c in base.columns if c not in ("school_id_govt", "school_id_giga", id_col)], base=base)
        df = duplicate_name_level_check(df, base)
        df = similar_name_check(df, base=base)
        df = density_check(df, base=base)
        if sides is not None:
            df = not_within_check(df, sides, polygon, most_km)
    if dataset == "coverage_fb":
        df = percent_sum_check(df)
    critical = lambda d: critical_checks(d, default_critical(dataset) if always is None else always, create_only)
    if dataset == "geolocation":
        return relation_checks(critical(df), dataset)
    return critical(relation_checks(df, dataset))


def warned(results: Column, keys: Iterable[str]) -> Column:
    """Whether any of these checks of a map failed."""
    return reduce(lambda a, b: a | b, (F.coalesce(F.try_element_at(results, F.lit(k)) == 1, F.lit(False)) for k in keys), F.lit(False))


def relevant_checks(uploaded: Iterable[str], checks: Mapping[str, Sequence[str]], always: Iterable[str] = ()) -> list[str]:
    """Names of checks that concern a file: those always made, and those all of whose columns it has."""
    there = set(uploaded)
    return [c for c, columns in checks.items() if c in set(always) or columns and set(columns) <= there]


def keep_checks(df: DataFrame, names: Sequence[str], results: str = "dq_results") -> DataFrame:
    """The map of results with only these checks."""
    return df.withColumn(results, F.map_filter(results, lambda k, _: k.isin(*names)))
