"""End-to-end jobs, each one function over DataFrames. Nothing is written here; sources.sinks does that."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import events as E
from ..operators import joins as J
from ..operators import merge as M
from ..operators import project as P
from ..operators import report as R
from ..operators import schema as S
from ..operators import windows as W
from ..sources.readers import null_normalised


@dataclass
class Upload:
    """What an upload job makes."""

    bronze: DataFrame
    checked: DataFrame
    report: DataFrame
    summary: DataFrame
    passed: DataFrame
    failed: DataFrame
    staged: DataFrame


@dataclass
class Published:
    silver: DataFrame
    master: DataFrame
    feed: DataFrame
    counts: DataFrame
    column_counts: DataFrame


def bronze_columns(df: DataFrame, *, base: DataFrame | None = None, key: str = "school_id_govt", renames: Mapping[str, str] | None = None, levels: DataFrame | None = None, id_parts: Sequence[str] = (), real_time: DataFrame | None = None, now: Column | None = None) -> DataFrame:
    """Derived columns of an upload: renamed, new or known, stable id, mapped levels, title case, real-time flag, time of ingestion."""
    df = S.rename_columns(df, renames or {})
    if base is not None:
        df = J.add_is_new(df, base, key)
    if id_parts:
        df = P.stable_id(df, "school_id_giga", id_parts)
    if levels is not None and "education_level" in df.columns:
        df = P.map_values(df, "education_level", levels)
    df = P.title_case(df, [c for c in ("connectivity_govt", "electricity_availability") if c in df.columns])
    if real_time is not None:
        df = J.flag_by_text_key(df, real_time, "school_id_giga", "connectivity_RT")
    return P.stamped(df, "connectivity_govt", "connectivity_govt_ingestion_timestamp", now) if now is not None else df


def upload_job(df: DataFrame, stored: DataFrame, dataset: str, *, key: str, columns: Sequence[str], upload: str, at: Column, year: int, always: Sequence[str] | None = None, create_only: Sequence[str] = (), warnings: Sequence[str] = (), meta: DataFrame | None = None) -> Upload:
    """Raw upload to staged changes: bronze, checks, report and summary, passed and failed rows, classification against what is stored.

    The checked rows feed five results; the caller writes them first, or persists them, as fits the cluster."""
    bronze = J.add_is_new(df, stored, key)
    checked = C.suite(bronze, dataset, year, always=always, create_only=create_only)
    passed = J.passed(checked, columns=columns)
    return Upload(bronze, checked, R.check_report(checked, meta=meta), R.dataset_summary(checked, warnings=warnings, columns=len(df.columns)), passed, J.failed(checked), M.stage_upload(passed, stored, key, columns, upload, at))


#: Sources of coverage: the checks of their files, the column of each technology, whether it is a flag, and kept columns under their stored names.
COVERAGE_SOURCES = {
    "fb": ("coverage_fb", {f"percent_{g}G": f"{g}G" for g in (2, 3, 4)}, False, {}),
    "itu": ("coverage_itu", {f"{g}g_mobile_coverage": f"{g}G" for g in (2, 3, 4, 5)}, True, {"fiber_node_dist": "fiber_node_distance", "5g_cell_site_dist": "nearest_NR_distance", "4g_cell_site_dist": "nearest_LTE_distance", "3g_cell_site_dist": "nearest_UMTS_distance", "2g_cell_site_dist": "nearest_GSM_distance"}),
}


def coverage_job(raw: DataFrame, stored: DataFrame, source: str, *, year: int, renames: Mapping[str, str] | None = None, technology: str = "cellular_coverage_type") -> tuple[DataFrame, DataFrame]:
    """Coverage upload of a source: checked rows; and the stored coverage with those that pass merged in, by school_id_giga: the
    better technology, and new values of other columns first. A column of a technology that neither the file nor `renames` (file's name to the source's) has raises."""
    dataset, technologies, binary, kept = COVERAGE_SOURCES[source]
    key, rows = "school_id_giga", S.rename_columns(raw, renames or {})
    if absent := sorted({key, *technologies} - set(rows.columns)):
        raise ValueError(f"the file of source {source} has no column {', '.join(absent)}")
    checked = C.suite(rows, dataset, year)
    there = [c for c in kept if c in rows.columns]
    flags = P.coverage_flags(J.passed(checked), key, technologies, binary, there)
    best = P.best_technology({t: t.lower() for t in technologies.values()})
    new = flags.select(key, best.alias(technology), *(F.col(f"`{c.lower()}`").alias(kept[c]) for c in there))
    others = [c for c in stored.columns if c not in (key, technology)]
    missing = [(c, stored.schema[c].dataType.simpleString()) for c in others if c not in new.columns]
    return checked, J.merge_coverage(stored, S.add_missing_columns(new, missing), key, technology, [c for c in others if c in stored.columns])


def approval_job(silver: DataFrame, master: DataFrame, staged: DataFrame, approved: DataFrame, key: str, columns: Sequence[str], required: Sequence[str]) -> Published:
    """Approved changes to silver, silver to master, and the notes of what changed there."""
    new_silver = M.apply_approval(silver, staged, approved, key, columns)
    merged = S.fill_required(M.full_merge(master.select(*columns), new_silver.select(*columns), [key], columns), required, key)
    feed = M.snapshot_diff(master.select(*columns), merged, [key])
    return Published(new_silver, P.with_signature(merged, columns), feed, M.change_counts(feed), M.column_change_counts(feed, [key], [c for c in columns if c != key]))


def qos_job(raw: DataFrame, schools: DataFrame, gold: DataFrame, *, key: str, time: str, event_keys: Sequence[str]) -> DataFrame:
    """Measurements of known schools, keyed by hash and deduplicated, inserted into gold."""
    known = J.known_only(raw, schools, key)
    return M.insert_only(gold, P.event_key(known, event_keys, time), ["event_key"])


def real_time_job(sources: Mapping[str, DataFrame], stored: DataFrame, keys: Sequence[str], time: str) -> tuple[DataFrame, DataFrame]:
    """Reconciled sources, and stored schools overlaid with them: first times stay, source lists are renewed."""
    found = J.first_seen(dict(sources), keys, time)
    return found, J.overlay(stored, found, keys[0], ["first_seen", "sources"], stored_wins=["first_seen"], insert=True)


def bulk_load_job(df: DataFrame, key: str, order: Sequence[Column], dataset: str, year: int, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Bulk load: typed, first row a key kept, checked; and the duplicates put aside."""
    typed = S.cast_to_schema(df, types)
    numbered = W.numbered(typed, [key], order)
    kept = numbered.where("row_num = 1").drop("row_num")
    return C.standard_checks(kept, dataset, year), numbered.where("row_num <> 1").drop("row_num")


def regenerate_job(master: DataFrame, reference: DataFrame, silver: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Silver from gold: master with the reference's values where it has none; rows that silver lacks are inserted."""
    made = J.enrich(master, reference, key, [c for c in columns if c != key]).select(*columns)
    return M.insert_only(silver.select(*columns), made, [key])


def facility_job(df: DataFrame, parts: Sequence[str], fields: Sequence[tuple[str, str]], polygons: DataFrame, polygon: str) -> DataFrame:
    """Facilities: all columns, stable id, containing polygon, signature."""
    from ..functions.geo import containing

    full = P.stable_id(S.add_missing_columns(df, fields), "facility_id", parts)
    return P.with_signature(containing(full, polygons, polygon).withColumnRenamed(polygon, "admin1"))


def custom_dataset_job(df: DataFrame) -> DataFrame:
    """Any table: nulls normalised, exact duplicates dropped."""
    return null_normalised(df).dropDuplicates()


def availability_file_job(df: DataFrame, gold: DataFrame, keys: Sequence[str], time: str, types: Mapping[str, str]) -> DataFrame:
    """A file of events into gold by key: typed, keyed, upserted."""
    return M.upsert_all(gold, P.event_key(S.cast_to_schema(df, types), keys, time), ["event_key"])


def list_job(df: DataFrame, mapping: Mapping[str, str], base: DataFrame, key: str, base_columns: Sequence[str], upload: str, at: Column) -> DataFrame:
    """A list with a column mapping: renamed, base columns looked up, staged."""
    rows = J.lookup(S.rename_columns(df, mapping), base, key, base_columns)
    return M.stage_upload(rows, base, key, [key, *(c for c in rows.columns if c in base.columns and c != key)], upload, at)


def uptime_job(events: DataFrame, devices: DataFrame, start: Column, end: Column) -> DataFrame:
    """Hourly uptime with each device's attributes, which are looked up before hours are made."""
    return E.hours_of_spans(J.lookup(E.uptime_spans(events, start, end), devices, "device_id", [c for c in devices.columns if c != "device_id"]))


def registry_job(registry: DataFrame, incoming: DataFrame) -> DataFrame:
    """Registry rows upserted by name once their types are known to be valid."""
    return M.upsert_all(registry, S.require_valid_types(incoming), ["name"])


def feed_fixture(master: DataFrame, keys: Sequence[str], change: Column, drop: Column) -> list[DataFrame]:
    """Three versions of a table for tests of feeds: as it is, changed, with rows gone."""
    changed = master.withColumn("qty", F.when(change, F.col("qty") + 1).otherwise(F.col("qty")))
    return [master, changed, changed.where(~drop)]
