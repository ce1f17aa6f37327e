"""Queries of the check suites of all datasets: every check column against SQL that is put together from the profile."""

from pyspark.sql import functions as F

from ..functions import profiles
from ..operators import checks as C
from ..registry import query

YEAR = 2024
#: Columns of a file of each dataset, as expressions over fx_school that Spark and DuckDB read alike.
IDS = {"row_key": "row_key", "school_id_giga": "school_id_giga"}
SCHOOL = IDS | {
    "school_id_govt": "school_id_govt", "school_name": "CASE WHEN row_key % 41 = 7 THEN '...' ELSE school_name END", "education_level": "education_level", "latitude": "latitude + 13", "longitude": "longitude + 1",
    "num_computers": "num_computers", "connectivity_govt": "connectivity_govt", "download_speed_contracted": "CASE WHEN row_key % 6 <> 1 THEN CAST(row_key % 700 AS DOUBLE) END",
    "electricity_availability": "electricity_availability", "electricity_type": "electricity_type", "school_area_type": "CASE WHEN row_key % 5 = 0 THEN repeat('Urban', 60) ELSE 'Urban' END",
}
FILES = {
    "geolocation": SCHOOL,
    "master": SCHOOL | {
        "admin1": "'a'", "connectivity": "electricity_availability", "connectivity_RT": "CASE WHEN row_key % 5 = 0 THEN 'no' WHEN row_key % 5 = 1 THEN 'Yes' END", "connectivity_RT_datasource": "CASE WHEN row_key % 5 < 1 THEN 'x' END",
        "cellular_coverage_availability": "CASE WHEN row_key % 7 < 3 THEN 'Yes' WHEN row_key % 7 < 5 THEN 'no' END", "cellular_coverage_type": "CASE WHEN row_key % 3 = 0 THEN '4G' WHEN row_key % 3 = 1 THEN 'no coverage' END",
        "connectivity_govt_ingestion_timestamp": "CASE WHEN row_key % 8 = 0 THEN '2024' END",
    },
    "reference": IDS | {"education_level_govt": "education_level", "is_school_open": "connectivity_govt", "schools_within_10km": "row_key % 150"},
    "coverage": IDS | {
        "cellular_coverage_availability": "connectivity_govt", "cellular_coverage_type": "CASE WHEN row_key % 3 = 0 THEN '4g' WHEN row_key % 3 = 1 THEN 'no coverage' ELSE '6G' END", "fiber_node_distance": "row_key * 70000.5",
        "nearest_NR_id": "school_name", "5g_cell_site_dist": "num_computers", "nearest_LTE_id": "school_id_govt", "4g_cell_site_dist": "CASE WHEN row_key % 2 = 0 THEN 1 END", "nearest_UMTS_id": "education_level",
    },
    "coverage_fb": IDS | {f"percent_{g}G": f"CASE WHEN row_key % 13 <> {g} THEN CAST((row_key * {g}) % 3 * 50 AS DOUBLE) END" for g in (2, 3, 4)},
    "coverage_itu": IDS | {f"{g}g_mobile_coverage": f"CAST((row_key * {g}) % 3 % 2 AS INT)" for g in (2, 3, 4)} | {"2G": "row_key % 3", "nearest_GSM_id": "school_name", "2g_cell_site_dist": "num_computers", "schools_within_1km": "row_key % 30"},
    "qos": IDS | {"connectivity_RT": "connectivity_govt", "connectivity_RT_datasource": "education_level", "connectivity_RT_ingestion_timestamp": "CASE WHEN row_key % 5 = 0 THEN '2024' END", "speed_download": "CAST(row_key AS DOUBLE)"},
}
NUMBERS = {"row_key", "latitude", "longitude", "num_computers", "download_speed_contracted", "schools_within_10km", "fiber_node_distance", "schools_within_1km", "2G", "speed_download", *(f"percent_{g}G" for g in (2, 3, 4))}
#: Of a suite these are compared by queries of their own.
APART = ("dq_similar_name_level_within_110m_radius", "dq_is_school_density_greater_than_5", "dq_school_density_count", "dq_school_density_group_id")


def flag(when: str) -> str:
    return f"CASE WHEN {when} THEN 1 ELSE 0 END"


def q(name: str) -> str:
    return f'"{name}"'


def repeats(columns: list[str]) -> str:
    return f"count(*) OVER (PARTITION BY {', '.join(columns)}) > 1"


def relations(dataset: str) -> dict[str, str]:
    """The rules between columns, written out."""
    some = lambda *names: flag(" OR ".join(f"{q(a)} IS NULL <> ({q(b)} IS NULL)" for a, b in zip(names, names[1:], strict=False)))
    real_time = {"connectivity_RT_connectivity_RT_datasource_connectivity_RT_ingestion_timestamp": "connectivity_RT connectivity_RT_datasource connectivity_RT_ingestion_timestamp".split()}
    out = {}
    if dataset in ("geolocation", "master"):
        out["connectivity_govt_download_speed_contracted"] = flag("download_speed_contracted IS NOT NULL AND connectivity_govt IS NULL")
        out["electricity_availability_electricity_type"] = flag("lower(electricity_availability) = 'yes' AND electricity_type IS NULL")
    if dataset == "master":
        no = lambda c: f"coalesce(lower({q(c)}), 'no') = 'no'"
        told = "lower(\"connectivity_RT\") = 'yes' OR lower(connectivity_govt) = 'yes' OR download_speed_contracted IS NOT NULL"
        out["connectivity_connectivity_RT_connectivity_govt_download_speed_contracted"] = f"CASE WHEN lower(connectivity) = 'yes' AND ({told}) OR lower(connectivity) = 'no' AND {no('connectivity_RT')} AND {no('connectivity_govt')} AND download_speed_contracted IS NULL THEN 0 ELSE 1 END"
        out["cellular_coverage_availability_cellular_coverage_type"] = "CASE WHEN lower(cellular_coverage_availability) = 'yes' AND lower(cellular_coverage_type) IN ('2g', '3g', '4g', '5g') OR lower(cellular_coverage_availability) = 'no' AND cellular_coverage_type = 'no coverage' OR cellular_coverage_availability IS NULL AND cellular_coverage_type IS NULL THEN 0 ELSE 1 END"
        out["connectivity_govt_connectivity_govt_ingestion_timestamp"] = flag("lower(connectivity_govt) = 'yes' AND connectivity_govt_ingestion_timestamp IS NULL")
    if dataset in ("master", "qos"):
        out |= {n: some(*(c if c in FILES[dataset] else "absent" for c in x)) for n, x in real_time.items()}
    if dataset in ("coverage", "coverage_itu"):
        out |= {"_".join(p): some(*(c if c in FILES[dataset] else "absent" for c in p)) for p in C.SITE_PAIRS}
    return out


def suite_sql(dataset: str) -> str:
    """One SELECT of row_key and all check columns of the file, from the profile of its dataset."""
    columns, made = list(FILES[dataset]), {}
    mandatory, types = profiles.MANDATORY[dataset], profiles.EXPECTED_TYPES
    text = lambda c: f"CAST({q(c)} AS VARCHAR)"
    made |= {f"duplicate-{c}": flag(f"{q(c)} IS NOT NULL AND {repeats([q(c)])}") for c in profiles.UNIQUE[dataset] if c in columns}
    made |= {f"is_null_optional-{c}": flag(f"{q(c)} IS NULL") for c in columns if c not in mandatory}
    made |= {f"is_null_mandatory-{c}": flag(f"{q(c)} IS NULL") if c in columns else "1" for c in mandatory}
    for c, values in profiles.DOMAINS.get(dataset, {}).items():
        some = ", ".join("'" + str(v).lower() + "'" for v in values)
        made[f"is_invalid_domain-{c}"] = f"CASE WHEN lower({text(c)}) IN ({some}) THEN 0 ELSE 1 END" if c in columns else "1"
    made |= {f"is_invalid_range-{c}": f"CASE WHEN TRY_CAST({q(c)} AS DOUBLE) BETWEEN {a} AND {b} THEN 0 ELSE 1 END" if c in columns else "1" for c, (a, b) in profiles.ranges(dataset, YEAR).items()}
    for c in columns:
        if types.get(c) == "string":
            made[f"is_not_alphanumeric-{c}"] = flag(f"NOT regexp_matches({text(c)}, '[A-Za-z0-9]')")
        elif types.get(c):
            made[f"is_not_numeric-{c}"] = "0" if c in NUMBERS else flag(rf"NOT regexp_matches({text(c)}, '^-?\d+(\.\d+)?$')")
        if types.get(c, "string") == "string" and c != "school_name":
            made[f"is_string_more_than_255_characters-{c}"] = flag(f"length({text(c)}) > 255")
    made["is_not_36_character_hash-school_id_giga"] = "0"
    if dataset in ("geolocation", "master"):
        located = lambda sql: f"CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN {sql} END"
        place = ["latitude", "longitude"]
        for keys in profiles.DUPLICATE_SETS[:-1]:
            made[f"duplicate_set-{'_'.join(keys)}"] = located(flag(repeats([*keys[:-1], *place])))
        made["duplicate_location_rows_flag"] = located(flag(repeats(place)))
        made["duplicate_location_rows_count"] = located("count(*) OVER (PARTITION BY latitude, longitude)")
        made["duplicate_location_rows_id"] = located("substr(md5(CAST(longitude AS VARCHAR) || '_' || CAST(latitude AS VARCHAR)), 1, 8)")
        made |= {f"precision-{c}": f"CASE WHEN {c} IS NOT NULL THEN {flag(f'length(split_part({text(c)}, chr(46), 2)) < 5')} END" for c in place}
        made["duplicate_all_except_school_code"] = located(flag(repeats([q(c) for c in columns if c not in ("school_id_govt", "school_id_giga", "row_key")])))
        made["duplicate_name_level_within_110m_radius"] = located(flag(repeats(["school_name", "education_level", "floor(latitude * 1000)", "floor(longitude * 1000)"])))
    if dataset == "coverage_fb":
        made["is_sum_of_percent_not_equal_100"] = flag('"percent_2G" + "percent_3G" + "percent_4G" <> 100')
    made |= {f"column_relation_checks-{n}": sql for n, sql in relations(dataset).items()}
    critical = [c.removeprefix("dq_") for c in C.default_critical(dataset)]
    bad = " OR ".join(f'"dq_{c}" = 1' for c in critical)
    reason = ", ".join(f"CASE WHEN \"dq_{c}\" = 1 THEN '{c}' END" for c in critical)
    rows = ", ".join(f"{sql} AS {q(c)}" for c, sql in FILES[dataset].items())
    checks = ", ".join(f'CAST({sql} AS {"VARCHAR" if c == "duplicate_location_rows_id" else "BIGINT"}) AS "dq_{c}"' for c, sql in made.items())
    return f"WITH r AS (SELECT {rows}, CAST(NULL AS VARCHAR) AS absent FROM fx_school), k AS (SELECT row_key, {checks} FROM r) SELECT *, {flag(bad)}::BIGINT AS dq_has_critical_error, concat_ws(', ', {reason}) AS failure_reason FROM k"


def suite_of(t, dataset):
    rows = t.fx_school.selectExpr(*(f"{sql} AS `{c}`" for c, sql in FILES[dataset].items()))
    made = C.suite(rows, dataset, YEAR, id_col="row_key")
    kinds = dict(made.dtypes)
    checks = [c for c in made.columns if c.startswith("dq_") and c not in APART]
    return made.select("row_key", *(F.col(f"`{c}`").cast("bigint").alias(c) if kinds[c] == "int" else F.col(f"`{c}`") for c in checks), "failure_reason")


for _dataset in FILES:
    query(f"dq_20_suite_{_dataset}", suite_sql(_dataset))(lambda t, d=_dataset: suite_of(t, d))
    if rules := relations(_dataset):
        names = ", ".join(f'"dq_column_relation_checks-{n}"' for n in rules)
        query(f"dq_17_relations_{_dataset}", suite_sql(_dataset).rsplit("SELECT *,", 1)[0] + f"SELECT row_key, {names} FROM k")(
            lambda t, d=_dataset: C.relation_checks(t.fx_school.selectExpr(*(f"{sql} AS `{c}`" for c, sql in FILES[d].items())), d).select("row_key", *(F.col(f"`dq_column_relation_checks-{n}`").cast("bigint") for n in relations(d)))
        )
