"""Profiles: which columns a dataset's checks are about. All are defaults; operators take their own."""

from __future__ import annotations

# Column names, domains and ranges that results depend on.
STRINGS = [
    "cellular_coverage_availability", "cellular_coverage_type", "connectivity_govt", "school_id_giga", "school_id_govt", "school_name",
    "education_level", "connectivity_type_govt", "admin1", "admin1_id_giga", "admin2", "admin2_id_giga", "school_area_type", "school_funding_type",
    "computer_lab", "electricity_availability", "electricity_type", "water_availability", "school_data_source", "school_data_collection_modality",
    "disputed_region", "connectivity", "connectivity_RT", "connectivity_RT_datasource", "nearest_NR_id", "nearest_LTE_id", "nearest_UMTS_id",
    "nearest_GSM_id", "education_level_govt", "school_id_govt_type", "school_address", "is_school_open", "country_id", "provider", "report_id",
    "agent_id",
]
DOUBLES = [
    "fiber_node_distance", "microwave_node_distance", "nearest_NR_distance", "nearest_LTE_distance", "nearest_UMTS_distance", "nearest_GSM_distance",
    "latitude", "longitude", "download_speed_contracted", "nearest_school_distance", "download_speed_govt", "percent_2G", "percent_3G", "percent_4G",
    "speed_upload", "speed_download", "roundtrip_time", "jitter_upload", "jitter_download", "rtt_packet_loss_pct", "latency",
]
INTS = [
    "schools_within_1km", "schools_within_2km", "schools_within_3km", "schools_within_10km", "connectivity_govt_collection_year",
    "school_establishment_year", "num_computers", "num_computers_desired", "num_teachers", "num_adm_personnel", "num_students", "num_classrooms",
    "num_latrines", "school_data_collection_year", "2G", "3G", "4G",
]
LONGS = [
    "pop_within_1km", "pop_within_2km", "pop_within_3km", "pop_within_10km",
]
TIMESTAMPS = [
    "connectivity_govt_ingestion_timestamp", "school_location_ingestion_timestamp", "connectivity_RT_ingestion_timestamp", "timestamp",
]
EXPECTED_TYPES = dict.fromkeys(STRINGS, "string") | dict.fromkeys(DOUBLES, "double") | dict.fromkeys(INTS, "int") | dict.fromkeys(LONGS, "bigint") | dict.fromkeys(TIMESTAMPS, "timestamp")

UNIQUE = {"master": ["school_id_govt", "school_id_giga"], "geolocation": ["school_id_govt", "school_id_giga"]} | dict.fromkeys(("reference", "coverage", "coverage_fb", "coverage_itu", "qos"), ["school_id_giga"])
MANDATORY = {
    "master": ["school_id_giga", "school_id_govt", "school_name", "longitude", "latitude", "education_level", "admin1", "admin2"],
    "reference": ["school_id_giga", "education_level_govt"],
    "geolocation": ["school_id_govt"],
    "coverage": ["school_id_giga", "cellular_coverage_availability", "cellular_coverage_type"],
    "coverage_fb": ["school_id_giga", "percent_2G", "percent_3G", "percent_4G"],
    "coverage_itu": ["school_id_giga", "2g_mobile_coverage", "3g_mobile_coverage", "4g_mobile_coverage", "5g_mobile_coverage"],
    "qos": ["school_id_giga"],
}
YES_NO = ["yes", "no"]
LEVELS = ["Pre-Primary", "Primary", "Secondary", "Post-Secondary", "Pre-Primary and Primary", "Primary and Secondary", "Pre-Primary, Primary and Secondary", "Primary, Secondary and Post-Secondary"]
_SCHOOL_DOMAINS = {
    "connectivity_govt": YES_NO,
    "education_level": LEVELS,
    "school_area_type": ["urban", "rural"],
    "computer_lab": YES_NO,
    "electricity_availability": YES_NO,
    "electricity_type": ["electrical grid", "diesel generator", "solar power station", "other"],
    "water_availability": YES_NO,
    "school_data_collection_modality": ["online", "in-person", "phone", "other"],
    "school_funding_type": ["public", "private", "charitable", "others"],
}
_COVERAGE_DOMAINS = {"cellular_coverage_availability": YES_NO, "cellular_coverage_type": ["2G", "3G", "4G", "5G", "no coverage"]}
DOMAINS = {
    "master": _SCHOOL_DOMAINS | _COVERAGE_DOMAINS,
    "reference": {"is_school_open": YES_NO},
    "geolocation": _SCHOOL_DOMAINS | {"connectivity_type_govt": ["fiber", "xdsl", "wired", "cellular", "p2mp wireless", "p2p wireless", "satellite", "other", "copper", "coaxial", "unknown"]},
    "coverage": _COVERAGE_DOMAINS,
    "coverage_itu": {"2G": ["1", "0"], "3G": ["1", "0"], "4G": ["1", "0"]},
}


def ranges(dataset: str, year: int) -> dict[str, tuple[float, float]]:
    """Ranges of a dataset; the current year is given, so that results don't depend on the clock."""
    counts = {"num_computers": 500, "num_computers_desired": 1000, "num_teachers": 200, "num_adm_personnel": 200, "num_students": 10000, "num_classrooms": 200, "num_latrines": 200}
    school = {"school_establishment_year": (1000, year), "latitude": (-90, 90), "longitude": (-180, 180), "download_speed_contracted": (1, 500), **{c: (0, n) for c, n in counts.items()}, "school_data_collection_year": (1000, year)}
    near = {"fiber_node_distance": (0, 10000000), "microwave_node_distance": (0, 10000000), "schools_within_1km": (0, 20), "schools_within_2km": (0, 40), "schools_within_3km": (0, 60)}
    wide = {"nearest_school_distance": (0, 10000000), "schools_within_10km": (0, 100)}
    return {"master": school | near, "reference": wide | {"download_speed_govt": (1, 200)}, "geolocation": school | {"download_speed_govt": (1, 200)}, "coverage": near | wide, "coverage_itu": near | wide}.get(dataset, {})


TITLE_CASE = [
    "computer_lab", "connectivity", "connectivity_govt", "cellular_coverage_availability", "electricity_availability", "water_availability",
    "school_area_type", "school_funding_type", "is_school_open",
]
DUPLICATE_SETS = [["school_id_govt", "school_name", "education_level", "location_id"], ["school_name", "education_level", "location_id"], ["education_level", "location_id"], ["location_id"]]
PRECISION = {"latitude": 5, "longitude": 5}
DENSE = 5
