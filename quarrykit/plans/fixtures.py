"""Views over the driver's tables that have the shape of the data in question; the same text serves Spark and DuckDB.

A name in braces is a table or another view."""

from __future__ import annotations

import re

#: In order: a view uses tables and earlier views.
VIEWS = {
    "fx_school": """
        SELECT
        CAST(c_custkey - CASE WHEN c_custkey % 20 = 7 THEN 1 ELSE 0 END AS STRING) AS school_id_govt,
        CASE WHEN c_custkey % 11 = 3 THEN NULL ELSE
        concat(substr(md5(CAST(c_custkey AS STRING)), 1, 8), '-', substr(md5(CAST(c_custkey AS STRING)), 9, 4), '-',
        substr(md5(CAST(c_custkey AS STRING)), 13, 4), '-', substr(md5(CAST(c_custkey AS STRING)), 17, 4), '-',
        substr(md5(CAST(c_custkey AS STRING)), 21, 12)) END AS school_id_giga,
        CASE WHEN c_custkey % 29 = 4 THEN NULL
        ELSE concat('Escola Municipal ', CAST(c_custkey % 37 AS STRING)) END AS school_name,
        CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN 'Primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'Pre-Primary'
        WHEN 3 THEN 'Basic' ELSE NULL END AS education_level,
        CASE WHEN c_custkey % 13 = 5 THEN CAST(NULL AS DOUBLE)
        ELSE CAST(c_nationkey AS DOUBLE) - 12 + CAST(c_custkey % 8 AS DOUBLE) / 1000 + CAST(0.0005 AS DOUBLE) END AS latitude,
        CASE WHEN c_custkey % 13 = 5 THEN CAST(NULL AS DOUBLE)
        ELSE CAST(c_nationkey AS DOUBLE) * 2 + CAST(c_custkey % 4 AS DOUBLE) / 1000 + CAST(0.0005 AS DOUBLE) END AS longitude,
        CAST(c_nationkey AS INT) AS country_key,
        CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'maybe' ELSE NULL END AS connectivity_govt,
        CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE concat(CAST(c_custkey % 250 AS STRING), ' Mbps') END AS download_speed_govt,
        CAST(c_custkey % 700 AS INT) AS num_computers,
        CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE NULL END AS electricity_availability,
        CASE WHEN c_custkey % 9 = 0 THEN 'solar power station' ELSE NULL END AS electricity_type,
        c_custkey AS row_key
        FROM {customer}
    """,
    "fx_master": """
        SELECT row_key AS pk, school_name AS name, education_level AS level, num_computers AS qty, country_key
        FROM {fx_school} WHERE row_key % 3 <> 0
    """,
    "fx_incoming": """
        SELECT row_key AS pk,
        CASE WHEN row_key % 10 = 2 THEN NULL WHEN row_key % 10 = 4 THEN school_name || ' B' ELSE school_name END AS name,
        education_level AS level,
        CASE WHEN row_key % 7 = 1 THEN num_computers + 1 ELSE num_computers END AS qty,
        country_key
        FROM {fx_school} WHERE row_key % 4 <> 1
    """,
    "fx_status": """
        SELECT CAST(user_id AS STRING) AS device_id, ts AS ts, event_id AS event_id,
        CASE event_type WHEN 'error' THEN 'offline' WHEN 'signup' THEN 'alerting' ELSE 'online' END AS status
        FROM {events}
    """,
    "fx_measure": """
        SELECT user_id AS school_id, ts AS ts, props AS props, CAST(user_id % 5 AS INT) AS country_key,
        CASE event_type WHEN 'view' THEN 'meter' WHEN 'click' THEN 'meter' WHEN 'purchase' THEN 'mlab' ELSE 'qos' END AS source
        FROM {events} WHERE NOT (event_type = 'purchase' AND user_id % 3 = 0) AND NOT (event_type = 'view' AND user_id % 4 = 0)
    """,
    "fx_cov_a": """
        SELECT CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_partkey END AS school_key,
        CAST(p_size % 3 AS INT) * 50 AS percent_2g, CAST(p_size % 2 AS INT) * 50 AS percent_3g,
        CASE WHEN p_size % 5 = 0 THEN 50 ELSE 0 END AS percent_4g
        FROM {part}
    """,
    "fx_cov_itu": """
        SELECT CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_partkey + 20 END AS school_key, CAST(p_size % 2 AS INT) AS mobile_2g,
        CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE CAST(p_size % 3 AS INT) END AS mobile_3g, CAST(p_size % 4 AS INT) AS mobile_4g, CAST(p_size % 5 AS INT) AS mobile_5g,
        CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) ELSE NULL END AS dist_4g
        FROM {part}
    """,
    "fx_cov_silver": """
        SELECT p_partkey + 50 AS school_key,
        CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN '5G' WHEN 1 THEN '3G' WHEN 2 THEN '2G' ELSE 'no coverage' END AS coverage_type
        FROM {part}
    """,
    "fx_poly": """
        SELECT CAST(n_nationkey AS INT) AS country_key, v.ring AS ring, v.seq AS seq,
        CAST(n_nationkey AS DOUBLE) * 2 + v.dx AS lon, CAST(n_nationkey AS DOUBLE) - 12 + v.dy AS lat
        FROM {nation} CROSS JOIN (
        SELECT 0 AS ring, 0 AS seq, CAST(-0.01 AS DOUBLE) AS dx, CAST(-0.01 AS DOUBLE) AS dy UNION ALL
        SELECT 0, 1, CAST(0.01 AS DOUBLE), CAST(-0.01 AS DOUBLE) UNION ALL
        SELECT 0, 2, CAST(0.01 AS DOUBLE), CAST(0.003 AS DOUBLE) UNION ALL
        SELECT 0, 3, CAST(0.002 AS DOUBLE), CAST(0.003 AS DOUBLE) UNION ALL
        SELECT 0, 4, CAST(0.002 AS DOUBLE), CAST(0.01 AS DOUBLE) UNION ALL
        SELECT 0, 5, CAST(-0.01 AS DOUBLE), CAST(0.01 AS DOUBLE) UNION ALL
        SELECT 0, 6, CAST(-0.01 AS DOUBLE), CAST(-0.01 AS DOUBLE) UNION ALL
        SELECT 1, 0, CAST(0.0008 AS DOUBLE), CAST(0.0008 AS DOUBLE) UNION ALL
        SELECT 1, 1, CAST(0.0018 AS DOUBLE), CAST(0.0008 AS DOUBLE) UNION ALL
        SELECT 1, 2, CAST(0.0018 AS DOUBLE), CAST(0.0018 AS DOUBLE) UNION ALL
        SELECT 1, 3, CAST(0.0008 AS DOUBLE), CAST(0.0018 AS DOUBLE) UNION ALL
        SELECT 1, 4, CAST(0.0008 AS DOUBLE), CAST(0.0008 AS DOUBLE) UNION ALL
        SELECT 2, 0, CAST(0.0028 AS DOUBLE), CAST(0.0052 AS DOUBLE) UNION ALL
        SELECT 2, 1, CAST(0.0046 AS DOUBLE), CAST(0.0052 AS DOUBLE) UNION ALL
        SELECT 2, 2, CAST(0.0046 AS DOUBLE), CAST(0.0068 AS DOUBLE) UNION ALL
        SELECT 2, 3, CAST(0.0028 AS DOUBLE), CAST(0.0052 AS DOUBLE)) v
    """,
    "fx_place": """
        SELECT row_key, country_key, latitude, longitude, school_id_govt, school_name FROM {fx_school} UNION ALL
        SELECT row_key, country_key, latitude, longitude, school_id_govt, school_name FROM {fx_school} WHERE row_key % 3 = 0
    """,
    "fx_near": """
        SELECT row_key, education_level, country_key, latitude, CASE WHEN longitude > 180 THEN longitude - 360 ELSE longitude END AS longitude, school_name FROM (
        SELECT c_custkey + 1000000 * v.again AS row_key, CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'Primary' WHEN 1 THEN 'Secondary' ELSE NULL END AS education_level, CAST(c_nationkey AS INT) AS country_key,
        CASE WHEN c_custkey % 31 = 5 THEN CAST(NULL AS DOUBLE) ELSE CAST(c_nationkey AS DOUBLE) * 7 - 85 + CAST(c_custkey % 97 AS DOUBLE) / 6000 END AS latitude,
        CAST(179.99 AS DOUBLE) + CAST(c_custkey % 89 AS DOUBLE) / 4000 AS longitude,
        CASE WHEN c_custkey % 29 = 4 THEN NULL ELSE concat(CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'Escola Municipal ' WHEN 1 THEN 'Colegio Santa Maria ' WHEN 2 THEN 'Centro Sul ' ELSE 'EM ' END, CAST(c_custkey % 7 AS STRING)) END AS school_name
        FROM {customer} CROSS JOIN (SELECT 0 AS again UNION ALL SELECT 1) v WHERE v.again = 0 OR c_custkey % 5 = 0) p
    """,
    "fx_map": """
        SELECT 'Primary' AS src, 'Primary' AS dst UNION ALL SELECT 'Secondary', 'Secondary' UNION ALL SELECT 'basic ', 'Primary'
    """,
    "fx_check_meta": """
        SELECT 'is_null_mandatory-school_id_govt' AS check_key, 'critical checks' AS type, 'always' AS critical_for, 'No' AS warning UNION ALL
        SELECT 'is_null_mandatory-school_name', 'completeness checks', 'create_only', 'No' UNION ALL
        SELECT 'duplicate-school_id_govt', 'critical checks', 'always', 'No' UNION ALL
        SELECT 'is_invalid_range-num_computers', 'range checks', '', 'No' UNION ALL
        SELECT 'is_invalid_domain-connectivity_govt', 'domain checks', '', 'No' UNION ALL
        SELECT 'duplicate_location_rows_flag', 'duplicate checks', '', 'Yes'
    """,
    "fx_registry": """
        SELECT p_partkey AS id, 'col_' || CAST(p_partkey AS STRING) AS name,
        CASE CAST(p_size % 9 AS INT) WHEN 0 THEN 'string' WHEN 1 THEN 'int' WHEN 2 THEN 'long' WHEN 3 THEN 'double' WHEN 4 THEN 'boolean'
             WHEN 5 THEN 'timestamp' WHEN 6 THEN 'float' WHEN 7 THEN 'varchar' ELSE 'integer' END AS data_type,
        p_partkey % 50 = 0 AS primary_key, CASE WHEN p_partkey % 20 = 1 THEN CAST(p_partkey % 7 AS INT) ELSE NULL END AS partition_order,
        p_name AS description
        FROM {part}
    """,
    "fx_staged": """
        SELECT pk, name, qty, country_key,
        CASE CAST(pk % 4 AS INT) WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' ELSE 'UNCHANGED' END AS change_type,
        CASE CAST(pk % 3 AS INT) WHEN 0 THEN 'PENDING' WHEN 1 THEN 'PROCESSED' ELSE 'REJECTED' END AS status,
        'up' || CAST(pk % 5 AS STRING) AS upload_id, 'c' || CAST(pk AS STRING) AS change_id
        FROM {fx_incoming}
    """,
    "fx_feed": """
        SELECT row_key AS pk, school_name AS name, num_computers + v.version AS qty, v.version AS _commit_version,
        CASE CAST((row_key + v.version) % 4 AS INT) WHEN 0 THEN 'insert' WHEN 1 THEN 'update_preimage' WHEN 2 THEN 'update_postimage' ELSE 'delete' END AS _change_type
        FROM {fx_school} CROSS JOIN (SELECT 1 AS version UNION ALL SELECT 2 UNION ALL SELECT 3) v
    """,
}


def needs(view: str) -> set[str]:
    """Tables and views that a view names."""
    return set(re.findall(r"\{(\w+)\}", VIEWS[view]))


def with_views(sql: str) -> str:
    """The SQL with the views it names in front."""
    wanted: list[str] = []

    def want(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in wanted:
                want(VIEWS[name].replace(name, "") if name in VIEWS[name] else VIEWS[name])
                wanted.append(name)

    want(sql)
    if not wanted:
        return sql
    views = ", ".join(f"{name} AS ({re.sub(r'[{}]', '', VIEWS[name])})" for name in wanted)
    head = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", sql, re.I)
    return f"WITH {head[1] or ''}{views}, {sql[head.end():]}" if head else f"WITH {views} {sql}"
