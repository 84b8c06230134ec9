"""The queries of ``__spark_entry__`` once more, as DuckDB SQL over the base tables.

Each table of the model is one common table expression built on others by name;
``with_tables`` puts in front of a statement those it needs.
"""

from __future__ import annotations

import re

from fixtures import SOURCE_TABLES, VIEWS, view_sql

KEYS = {
    "zones": "zone_id", "shippers": "shipper_id", "drivers": "driver_id", "shipments": "shipment_id",
    "routes": "route_id", "ratings": "rating_id", "incidents": "incident_id",
}
REQUIRED = {
    "zones": ["zone_id", "city_code"],
    "shippers": ["shipper_id", "sla_hours"],
    "drivers": ["driver_id", "hire_date", "home_zone_id"],
    "shipments": ["shipment_id", "shipper_id", "driver_id", "zone_id", "received_date"],
    "routes": ["route_id", "driver_id", "route_date"],
    "ratings": ["rating_id", "shipment_id", "score"],
    "incidents": ["incident_id", "shipment_id", "incident_date"],
}
# Tie-break of equally new copies: all columns but the key, in table order.
COLUMNS = {
    "zones": "zone_name city_code district lat lon traffic_level zone_type depot_km",
    "shippers": "legal_name client_type main_city sla_hours penalty_rate active",
    "drivers": "first_name last_name doc_type doc_hash hire_date base_city vehicle_type home_zone_id active rating_avg",
    "shipments": "shipper_id driver_id zone_id package_type weight_kg received_date received_time due_date "
    "attempt1_date attempt1_time attempt1_result attempt2_date attempt2_time attempt2_result delivered_date "
    "final_status failure_code declared_value",
    "routes": "driver_id route_date start_time end_time km stops_planned stops_done deviation_km fuel",
    "ratings": "shipment_id rating_date score comment_text channel",
    "incidents": "shipment_id incident_date incident_type incident_text agent_id action_required",
}
# child column -> (parent, parent key), in the order of evaluation
REFS = {
    "drivers": [("home_zone_id", "zones", "zone_id")],
    "shipments": [
        ("driver_id", "drivers", "driver_id"),
        ("shipper_id", "shippers", "shipper_id"),
        ("zone_id", "zones", "zone_id"),
    ],
    "routes": [("driver_id", "drivers", "driver_id")],
    "ratings": [("shipment_id", "shipments", "shipment_id")],
    "incidents": [("shipment_id", "shipments", "shipment_id")],
}
RULES = {
    "shipments": [
        ("WEIGHT_NOT_POSITIVE", "weight_kg IS NOT NULL AND weight_kg <= 0"),
        ("DELIVERED_BEFORE_RECEIVED", "delivered_date IS NOT NULL AND delivered_date < received_date"),
    ]
}
FINISHED = {
    "zones": "zone_id, zone_name, city_code, coalesce(district, 'NO_DATA') AS district, lat, lon, traffic_level, "
    "zone_type, depot_km, updated_at",
    "shippers": "shipper_id, legal_name, client_type, main_city, sla_hours, penalty_rate, active, updated_at",
    "drivers": "driver_id, doc_type, doc_hash, hire_date, base_city, vehicle_type, home_zone_id, active, "
    "coalesce(rating_avg, 0) AS rating_avg, updated_at, sha256(coalesce(first_name, '')) AS first_name_hash, "
    "sha256(coalesce(last_name, '')) AS last_name_hash, rating_avg IS NULL AS rating_avg_missing",
    "shipments": "* REPLACE (coalesce(declared_value, 0) AS declared_value), declared_value IS NULL AS declared_value_missing",
    "routes": "* REPLACE (coalesce(fuel, 0) AS fuel), fuel IS NULL AS fuel_missing",
    "ratings": "rating_id, shipment_id, rating_date, score, channel, updated_at, sha256(comment_text) AS comment_text_hash",
    "incidents": "incident_id, shipment_id, incident_date, incident_type, agent_id, action_required, updated_at, "
    "sha256(incident_text) AS incident_text_hash",
}


def _cleaning(table: str) -> dict[str, str]:
    """``_ok`` required fields present, ``_one`` newest copy, ``_ref`` references hold, ``_good`` rules hold, ``_silver``."""
    key = KEYS[table]
    present = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED[table])
    ties = ", ".join(f"{c} ASC NULLS FIRST" for c in COLUMNS[table].split())
    ctes = {
        f"{table}_ok": f"SELECT * FROM {table} WHERE {present}",
        f"{table}_one": f"SELECT * FROM {table}_ok QUALIFY row_number() OVER "
        f"(PARTITION BY {key} ORDER BY updated_at DESC NULLS LAST, {ties}) = 1",
    }
    kept = [f"{col} IN (SELECT {pk} FROM {parent}_ref)" for col, parent, pk in REFS.get(table, [])]
    ctes[f"{table}_ref"] = f"SELECT * FROM {table}_one" + (" WHERE " + " AND ".join(kept) if kept else "")
    good = [f"NOT ({condition})" for _, condition in RULES.get(table, [])]
    ctes[f"{table}_good"] = f"SELECT * FROM {table}_ref" + (" WHERE " + " AND ".join(good) if good else "")
    ctes[f"{table}_silver"] = f"SELECT {FINISHED[table]} FROM {table}_good"
    return ctes


def _finding(table: str, rule: str, rows: str, where: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, {KEYS[table]} AS record_key, '{rule}' AS rule "
        f"FROM {rows} WHERE {where}"
    )


def _findings() -> dict[str, str]:
    required, duplicate, fk, rule = [], [], [], []
    for t in SOURCE_TABLES:
        key = KEYS[t]
        required.append(_finding(t, "REQUIRED_NULL", t, " OR ".join(f"{c} IS NULL" for c in REQUIRED[t])))
        twice = f"{key} IN (SELECT {key} FROM {t} GROUP BY {key} HAVING count(*) > 1)"
        duplicate.append(_finding(t, "DUPLICATE_KEY", t, twice))
        before = []
        for col, parent, pk in REFS.get(t, []):
            known = f"{col} IN (SELECT {pk} FROM {parent}_ref)"
            fk.append(_finding(t, f"FK_INVALID_{col}", f"{t}_one", " AND ".join([*before, f"NOT ({known})"])))
            before.append(known)
        for name, condition in RULES.get(t, []):
            rule.append(_finding(t, name, f"{t}_ref", condition))
    parts = {"required": required, "duplicates": duplicate, "fk": fk, "rules": rule}
    ctes = {f"found_{name}": " UNION ALL ".join(texts) for name, texts in parts.items()}
    ctes["found_all"] = " UNION ALL ".join(f"SELECT * FROM {name}" for name in list(ctes))
    return ctes


def _combine(date: str, time: str) -> str:
    text = f"regexp_extract({time}, '(\\d{{2}}:\\d{{2}}:\\d{{2}})', 1)"
    return (
        f"CASE WHEN {date} IS NULL OR {time} IS NULL OR {text} = '' THEN NULL "
        f"ELSE CAST(CAST({date} AS VARCHAR) || ' ' || {text} AS TIMESTAMP) END"
    )


def _hours(start: str, end: str) -> str:
    return f"CAST(epoch({end}) - epoch({start}) AS DOUBLE) / 3600"


def _exact(col: str) -> str:
    """The sum of nine places, and that of what they leave of each value in units of 2 ** -50."""
    head = f"CAST({col} AS DECIMAL(31,9))"
    rest = f"CAST(floor(({col} - CAST({head} AS DOUBLE)) * CAST({2**50} AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"
    return f"(CAST(sum({head}) AS DOUBLE) + CAST(sum({rest}) AS DOUBLE) / CAST({2**50} AS DOUBLE))"


def _round(value: str, digits: int) -> str:
    scale = 10**digits
    return f"(sign({value}) * floor(abs({value}) * {scale} + 0.5 + 1e-9) / {scale} + 0)"


def _share(condition: str) -> str:
    return f"avg(CASE WHEN {condition} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"


def _parts(date: str, prefix: str) -> str:
    return f"CAST(year({date}) AS INT) AS {prefix}_year, CAST(month({date}) AS INT) AS {prefix}_month"


DELIVERED = "final_status = 'Entregado'"
MEAN_HOURS = "CAST(sum(epoch(delivery_ts) - epoch(received_ts)) AS DOUBLE) / (count(delivery_ts) * 3600)"
PENALTY = f"{_exact('estimated_penalty')} AS penalty_total"
SLA_RATE = "avg(CAST(sla_met AS INT)) AS sla_rate"

GOLD = {
    "dim_driver": f"""
        SELECT driver_id, first_name_hash, last_name_hash, doc_hash, hire_date,
               {_round("round((2024 - year(hire_date)) * 12 + 6 - month(hire_date) + CASE WHEN day(hire_date) = 15 THEN 0 "
                       "ELSE CAST(15 - day(hire_date) AS DOUBLE) / 31 END, 8) / 12", 2)} AS tenure_years,
               base_city,
               CASE WHEN lower(vehicle_type) LIKE '%moto%' THEN 'Motorcycle' WHEN lower(vehicle_type) LIKE '%bici%'
                    THEN 'Bicycle' WHEN lower(vehicle_type) LIKE '%van%' THEN 'Van' ELSE 'Truck' END AS vehicle_type,
               home_zone_id, active, rating_avg
        FROM drivers_silver""",
    "dim_shipper": """
        SELECT * REPLACE (CAST(sla_hours AS DOUBLE) AS sla_hours),
               CASE WHEN client_type ILIKE '%ecommerce%' THEN 'Ecommerce' WHEN client_type ILIKE '%farm%' THEN 'Pharma'
                    WHEN client_type ILIKE '%retail%' THEN 'Retail' WHEN client_type ILIKE '%telecom%' THEN 'Telecom'
                    ELSE 'Other' END AS industry_segment
        FROM shippers_silver""",
    "dim_zone": """
        SELECT *,
               CAST(round(1 + 4 * (CAST(0.6 AS DOUBLE) * ((traffic_level - 1) / 4)
                    + CAST(0.4 AS DOUBLE) * (least(depot_km, 40) / 40)), 0) AS INT) AS difficulty,
               CASE city_code WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'America' WHEN 'ASIA' THEN 'Asia'
                    WHEN 'EUROPE' THEN 'Europe' END AS city_name
        FROM zones_silver""",
    "shipment_instants": f"""
        SELECT s.*, CAST(r.sla_hours AS DOUBLE) AS sla_hours, r.penalty_rate,
               {_combine("received_date", "received_time")} AS received_ts,
               CASE WHEN attempt2_result = 'Entregado' THEN {_combine("attempt2_date", "attempt2_time")}
                    WHEN attempt1_result = 'Entregado' THEN {_combine("attempt1_date", "attempt1_time")}
                    ELSE CAST(delivered_date AS TIMESTAMP) END AS delivery_ts,
               CAST(due_date AS TIMESTAMP) + INTERVAL 86399 SECONDS AS due_ts
        FROM shipments_silver s LEFT JOIN shippers_silver r ON s.shipper_id = r.shipper_id""",
    "shipment_durations": f"""
        SELECT *, {_hours("received_ts", "delivery_ts")} AS delivery_hours,
               {_hours("due_ts", "delivery_ts")} AS delay_hours
        FROM shipment_instants""",
    "fact_shipment": f"""
        SELECT d.* EXCLUDE (delay_hours), {DELIVERED} AND delivery_hours <= sla_hours AS sla_met,
               CASE failure_code WHEN 'DEST_AUSENTE' THEN 'Destinatario ausente' WHEN 'DIR_INCORRECTA' THEN 'Direccion incorrecta'
                    WHEN 'HARD_ZONE' THEN 'Zone hard to reach' WHEN 'REJECTED' THEN 'Parcel refused'
                    WHEN 'OTHER' THEN 'Other' END AS failure_text,
               CAST(CASE WHEN attempt2_date IS NOT NULL THEN 2 ELSE 1 END AS INT) AS attempts,
               delay_hours,
               CASE WHEN final_status <> 'Entregado' THEN 'Not delivered' WHEN delay_hours IS NULL THEN 'Unknown'
                    WHEN delay_hours <= 0 THEN 'On time' WHEN delay_hours <= 4 THEN 'Light delay'
                    WHEN delay_hours <= 24 THEN 'Moderate delay' ELSE 'Critical delay' END AS delay_class,
               CASE WHEN NOT ({DELIVERED} AND delivery_hours <= sla_hours) THEN declared_value * penalty_rate
                    ELSE 0 END AS estimated_penalty,
               {_parts("received_date", "received")}
        FROM shipment_durations d""",
    "route_hours": f"""
        SELECT *, {_hours(_combine("route_date", "start_time"), _combine("route_date", "end_time"))} AS hours
        FROM routes_silver""",
    "fact_route": f"""
        SELECT * EXCLUDE (hours),
               CASE WHEN hours IS NOT NULL THEN greatest(hours, CAST(0.1 AS DOUBLE)) END AS worked_hours,
               CASE WHEN stops_planned > 0 THEN CAST(stops_done AS DOUBLE) / stops_planned END AS stop_efficiency,
               CASE WHEN hours IS NOT NULL THEN km / greatest(hours, CAST(0.1 AS DOUBLE)) END AS mean_speed_kmh,
               CASE WHEN km > 0 THEN deviation_km / km * 100 END AS deviation_pct,
               {_parts("route_date", "route")}
        FROM route_hours""",
    "driver_day_shipments": f"""
        SELECT driver_id, received_date AS day, {_share(DELIVERED)} AS success_rate, avg(attempts) AS mean_attempts,
               min_by(zone_id, concat_ws('/', received_time, shipment_id)) AS reference_zone_id, {PENALTY}
        FROM fact_shipment GROUP BY driver_id, received_date""",
    "driver_day_routes": f"""
        SELECT driver_id, route_date AS day, {_exact("deviation_pct")} / count(deviation_pct) AS mean_deviation_pct,
               {_exact("mean_speed_kmh")} / count(mean_speed_kmh) AS mean_speed_kmh
        FROM fact_route GROUP BY driver_id, route_date""",
    "driver_day_ratings": """
        SELECT f.driver_id, f.received_date AS day, avg(r.score) AS mean_rating
        FROM ratings_silver r JOIN fact_shipment f ON r.shipment_id = f.shipment_id
        GROUP BY f.driver_id, f.received_date""",
    "driver_days": """
        SELECT s.driver_id, s.day, success_rate, mean_attempts, reference_zone_id, penalty_total,
               coalesce(mean_deviation_pct, 100) AS mean_deviation_pct, coalesce(mean_speed_kmh, 0) AS mean_speed_kmh,
               coalesce(mean_rating, 0) AS mean_rating, CAST(coalesce(z.difficulty, 3) AS INT) AS difficulty
        FROM driver_day_shipments s
        LEFT JOIN driver_day_routes r ON s.driver_id = r.driver_id AND s.day = r.day
        LEFT JOIN driver_day_ratings q ON s.driver_id = q.driver_id AND s.day = q.day
        LEFT JOIN dim_zone z ON s.reference_zone_id = z.zone_id""",
    "driver_terms": """
        SELECT *, greatest(CAST(0 AS DOUBLE), 1 - least(mean_deviation_pct / 100, CAST(1 AS DOUBLE))) AS route_adherence,
               CAST(CASE WHEN difficulty >= 4 THEN 18 WHEN difficulty = 3 THEN 24 ELSE 30 END AS DOUBLE)
                   AS standard_speed_kmh,
               least(mean_speed_kmh / CASE WHEN difficulty >= 4 THEN 18 WHEN difficulty = 3 THEN 24 ELSE 30 END,
                     CAST(1 AS DOUBLE)) AS speed_vs_standard,
               least(1 / greatest(mean_attempts, CAST(1 AS DOUBLE)), CAST(1 AS DOUBLE)) AS inverse_attempts,
               least(mean_rating / 5, CAST(1 AS DOUBLE)) AS rating_share
        FROM driver_days""",
    "fact_driver_day": f"""
        SELECT *, {_round("CAST(0.35 AS DOUBLE) * success_rate + CAST(0.2 AS DOUBLE) * route_adherence "
                          "+ CAST(0.2 AS DOUBLE) * speed_vs_standard + CAST(0.15 AS DOUBLE) * inverse_attempts "
                          "+ CAST(0.1 AS DOUBLE) * rating_share", 2)} AS score, {_parts("day", "day")}
        FROM driver_terms""",
    "shipment_events": f"""
        SELECT shipment_id, received_ts AS event_ts, 'Reception' AS event FROM fact_shipment
        UNION ALL SELECT shipment_id, {_combine("attempt1_date", "attempt1_time")}, 'Attempt 1'
                  FROM fact_shipment WHERE attempt1_date IS NOT NULL
        UNION ALL SELECT shipment_id, {_combine("attempt2_date", "attempt2_time")}, 'Attempt 2'
                  FROM fact_shipment WHERE attempt2_date IS NOT NULL
        UNION ALL SELECT shipment_id, delivery_ts, 'Delivery' FROM fact_shipment WHERE delivery_ts IS NOT NULL""",
    "incident_events": """
        SELECT i.shipment_id, CAST(i.incident_date AS TIMESTAMP) AS event_ts, 'Incident: ' || i.incident_type AS event
        FROM incidents_silver i JOIN fact_shipment f ON i.shipment_id = f.shipment_id
        WHERE i.incident_date >= f.received_date""",
    "ordered_events": """
        SELECT *, row_number() OVER w AS event_order, lag(event_ts) OVER w AS previous_ts
        FROM (SELECT * FROM shipment_events UNION ALL SELECT * FROM incident_events)
        WINDOW w AS (PARTITION BY shipment_id ORDER BY event_ts ASC NULLS FIRST, event ASC NULLS FIRST)""",
    "fact_shipment_event": f"""
        SELECT *, {_hours("previous_ts", "event_ts")} AS hours_since_previous, {_parts("event_ts", "event")}
        FROM ordered_events""",
    "zone_day_failure": f"""
        SELECT zone_id, received_date AS day, {_share("final_status <> 'Entregado'")} AS failure_rate,
               CAST(dayofweek(received_date) + 1 AS INT) AS weekday
        FROM fact_shipment GROUP BY zone_id, received_date""",
    "zone_base": """
        SELECT *, avg(failure_rate) OVER (PARTITION BY zone_id, weekday ORDER BY day
                                          ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS baseline_rate
        FROM zone_day_failure""",
    "zone_baseline": """
        SELECT *, CASE WHEN baseline_rate > 0 THEN (failure_rate - baseline_rate) / baseline_rate * 100 END AS deviation_pct
        FROM zone_base""",
    "fact_zone_alert": f"""
        SELECT *, {_parts("day", "day")} FROM zone_baseline WHERE failure_rate > baseline_rate * CAST(1.25 AS DOUBLE)""",
    "agg_zone_day": f"""
        SELECT received_date AS day, zone_id, count(*) AS shipments, {SLA_RATE}, {_share(DELIVERED)} AS success_rate, {PENALTY}
        FROM fact_shipment GROUP BY received_date, zone_id""",
    "agg_shipper_day": f"""
        SELECT received_date AS day, shipper_id, count(*) AS shipments, {SLA_RATE}, {_share(DELIVERED)} AS success_rate, {PENALTY}
        FROM fact_shipment GROUP BY received_date, shipper_id""",
    "agg_package_day": f"""
        SELECT received_date AS day, package_type, count(*) AS shipments, {_share(DELIVERED)} AS success_rate,
               {MEAN_HOURS} AS mean_delivery_hours, {PENALTY}
        FROM fact_shipment GROUP BY received_date, package_type""",
    "kpi_day": f"""
        SELECT received_date AS day, count(*) AS shipments, count(*) FILTER (WHERE {DELIVERED}) AS delivered,
               {_share(DELIVERED)} AS success_rate, {SLA_RATE}, {MEAN_HOURS} AS mean_delivery_hours, {PENALTY}
        FROM fact_shipment GROUP BY received_date""",
}


def _gate(rows: str, drivers: str) -> str:
    checks = [
        ("DQ01_SHIPMENT_ID_NOT_NULL", "shipment_id must be present",
         f"SELECT count(*) FROM {rows} WHERE shipment_id IS NULL"),
        ("DQ02_SHIPMENT_ID_UNIQUE", "shipment_id must not repeat",
         f"SELECT count(*) FROM (SELECT shipment_id FROM {rows} GROUP BY shipment_id HAVING count(*) > 1)"),
        ("DQ03_DRIVER_EXISTS", "driver_id must be in dim_driver",
         f"SELECT count(*) FROM {rows} x ANTI JOIN {drivers} d ON x.driver_id = d.driver_id"),
        ("DQ04_WEIGHT_POSITIVE", "weight_kg > 0", f"SELECT count(*) FROM {rows} WHERE weight_kg <= 0"),
        ("DQ05_DATES_COHERENT", "delivered >= received",
         f"SELECT count(*) FROM {rows} WHERE delivered_date < received_date"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n AS failures, "
        f"'{detail}' AS detail FROM ({count}) AS c(n)"
        for rule, detail, count in checks
    )


SILVER_NAMES = ("zones", "shippers", "drivers", "shipments", "routes", "ratings", "incidents")
GOLD_COUNTED = (
    "dim_driver", "dim_shipper", "dim_zone", "fact_shipment", "fact_route", "fact_driver_day", "fact_shipment_event",
    "fact_zone_alert",
)


def _all_counts() -> str:
    parts = [f"SELECT 'silver' AS layer, '{t}' AS table_name, count(*) AS n FROM {t}_silver" for t in SILVER_NAMES]
    parts += [f"SELECT 'gold', '{t}', count(*) FROM {t}" for t in GOLD_COUNTED]
    return " UNION ALL ".join(parts)


def _quality() -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS source_rows, "
        f"(SELECT count(*) FROM {t}_good) AS kept_rows"
        for t in SOURCE_TABLES
    )
    pct = _round("CAST(kept_rows AS DOUBLE) / greatest(source_rows, 1) * 100", 4)
    return f"SELECT *, source_rows - kept_rows AS rejected_rows, {pct} AS kept_pct FROM ({counts})"


TABLES: dict[str, str] = {view: view_sql(view) for view in VIEWS}
for _table in SILVER_NAMES:
    TABLES |= _cleaning(_table)
TABLES |= _findings() | GOLD
TABLES |= {
    "all_counts": _all_counts(),
    "quality": _quality(),
    "dq_gold": _gate("fact_shipment", "dim_driver"),
    "audit_batch": """
        SELECT batch_id, table_name, records, bytes, CAST(seconds AS DOUBLE) AS seconds, logged_at
        FROM ingest_log WHERE batch_id = '2024-01-10'""",
    "audit_means": """
        SELECT table_name, avg(records) AS mean_records FROM (
            SELECT * FROM ingest_log WHERE batch_id <> '2024-01-10'
            QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY logged_at DESC, batch_id DESC) <= 7)
        GROUP BY table_name""",
    "audit_checked": """
        SELECT *, CASE WHEN mean_records > 0 THEN abs(records - mean_records) / mean_records * 100 ELSE 0 END AS deviation_pct
        FROM (SELECT b.*, m.mean_records FROM audit_batch b LEFT JOIN audit_means m ON b.table_name = m.table_name)""",
    "audit_alerts": """
        SELECT *, 'VOLUME_ANOMALY' AS alert_type FROM audit_checked WHERE deviation_pct > 10""",
}


def with_tables(statement: str) -> str:
    """The statement behind the table expressions it needs, directly or through others."""
    needed: set[str] = set()
    open_texts = [statement]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        for name in words & TABLES.keys() - needed:
            needed.add(name)
            open_texts.append(TABLES[name])
    if not needed:
        return statement
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in TABLES.items() if name in needed)
    # a statement with expressions of its own continues the list
    own = re.match(r"\s*WITH\s", statement)
    return f"WITH {ctes},\n{statement[own.end():]}" if own else f"WITH {ctes}\n{statement}"


def _null_profile(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, avg(CAST({c} IS NULL AS INT)) AS null_fraction FROM {table}_silver"
        for c in columns
    )


NULL_COLUMNS = {
    "zones": "zone_id zone_name city_code district lat lon traffic_level zone_type depot_km updated_at",
    "shippers": "shipper_id legal_name client_type main_city sla_hours penalty_rate active updated_at",
    "incidents": "incident_id shipment_id incident_date incident_type agent_id action_required updated_at incident_text_hash",
    "drivers": "driver_id doc_type doc_hash hire_date base_city vehicle_type home_zone_id active rating_avg updated_at "
    "first_name_hash last_name_hash rating_avg_missing",
    "shipments": "shipment_id shipper_id driver_id zone_id package_type weight_kg received_date received_time due_date "
    "attempt1_date attempt1_time attempt1_result attempt2_date attempt2_time attempt2_result delivered_date final_status "
    "failure_code declared_value updated_at declared_value_missing",
    "routes": "route_id driver_id route_date start_time end_time km stops_planned stops_done deviation_km fuel updated_at "
    "fuel_missing",
    "ratings": "rating_id shipment_id rating_date score channel updated_at comment_text_hash",
}

# Raw shipments spoilt by the typed queries.
SPOILT = {
    "weight_kg": "weight_kg = 13",
    "due_date": "package_type = 'Large' AND weight_kg % 7 = 0",
    "received_time": "package_type = 'Small' AND weight_kg % 11 = 0",
}
CUT = "TIMESTAMP '1996-01-01 00:00:00'"


def _log_row(batch: str, table: str, start: str, until: str, where: str, status: str, first: bool, mark: str, place: int) -> str:
    return (
        f"SELECT '{batch}' AS batch_id, '{table}' AS table_name, {start} AS watermark_from, {until} AS watermark_to, "
        f"(SELECT count(*) FROM {table} WHERE {where}) AS records, '{status}' AS status, {first} AS from_start, "
        f"{mark} AS watermark, CAST({place} AS BIGINT) AS sequence"
    )


def _newest(table: str) -> str:
    return f"(SELECT CAST(max(updated_at) AS TIMESTAMP) FROM {table})"


BEGIN = "TIMESTAMP '1900-01-01 00:00:00'"

# The lower bound 2024-01-10 12:00 is left out of a batch, the upper one 2024-01-20 is in it.
CHANGED = "ts > TIMESTAMP '2024-01-10 12:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'"

STATEMENTS: dict[str, str] = {
    # ingest
    "scan_layer": "SELECT * FROM routes",
    "csv_typed_roundtrip": "SELECT *, '' AS bad_columns FROM routes",
    "scan_evolved": f"""
        SELECT * REPLACE (CAST(stops_planned AS BIGINT) AS stops_planned, CAST(stops_done AS VARCHAR) AS stops_done,
                          CASE WHEN updated_at > {CUT} THEN fuel END AS fuel)
        FROM routes""",
    "bronze_replay": f"SELECT *, CASE WHEN updated_at <= {CUT} THEN 'b1' ELSE 'b2' END AS _batch_id FROM routes",
    "ingest_log": " UNION ALL ".join([
        _log_row("b1", "routes", BEGIN, CUT, f"updated_at <= {CUT}", "SUCCESS", True, CUT, 1),
        _log_row("b2", "routes", CUT, _newest("routes"), f"updated_at > {CUT}", "SUCCESS", False, _newest("routes"), 2),
        _log_row("b2", "ratings", BEGIN, _newest("ratings"), "true", "SUCCESS", True, _newest("ratings"), 2),
        _log_row("b3", "incidents", BEGIN, _newest("incidents"), "false", "FAILED", True, BEGIN, 3),
    ]),
    "reconcile_content": """
        SELECT route_id, CASE WHEN target_rows = 0 THEN 'MISSING' ELSE 'CHANGED' END AS difference, source_rows, target_rows
        FROM (SELECT route_id, count(*) AS source_rows, count(*) FILTER (WHERE stops_planned <> 13) AS target_rows,
                     count(*) FILTER (WHERE stops_planned = 17) AS changed
              FROM routes GROUP BY route_id)
        WHERE source_rows <> target_rows OR changed > 0""",
    "incremental_extract": f"SELECT * FROM events WHERE {CHANGED}",
    "watermark_upper": "SELECT max(ts) AS watermark_to FROM events",
    "ingest_stamped": f"""
        SELECT *, TIMESTAMP '2024-02-01 02:00:00' AS _ingest_ts, 'events_db' AS _source_system, 'b1' AS _batch_id
        FROM events WHERE {CHANGED}""",
    "watermark_advance": """
        WITH control AS (
            SELECT t AS table_name,
                   CASE WHEN t = 'view' THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '1900-01-01 00:00:00' END AS watermark
            FROM (VALUES ('click'), ('error'), ('purchase'), ('refund'), ('signup'), ('view')) AS v(t)),
        reached AS (SELECT * FROM ingest_log WHERE status = 'SUCCESS'
                    QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY watermark_to DESC) = 1)
        SELECT c.table_name,
               CASE WHEN r.watermark_to > c.watermark THEN r.watermark_to ELSE c.watermark END AS watermark,
               CASE WHEN r.watermark_to > c.watermark THEN r.batch_id END AS last_batch_id,
               CASE WHEN r.watermark_to > c.watermark THEN r.logged_at END AS updated_at
        FROM control c LEFT JOIN reached r ON c.table_name = r.table_name""",
    "watermark_state": """
        SELECT table_name, max(watermark_to) FILTER (WHERE status = 'SUCCESS') AS watermark
        FROM ingest_log GROUP BY table_name""",
    "reconcile_counts": """
        SELECT table_name, source_rows, kept_rows AS target_rows, rejected_rows AS difference FROM quality""",
    # audit
    "audit_batch": "SELECT * FROM audit_batch",
    "audit_missing_tables": """
        SELECT coalesce(e.table_name, b.table_name) AS table_name,
               CAST(CASE WHEN e.table_name IS NULL THEN 0 ELSE 1 END AS INT) AS expected_rows,
               coalesce(b.n, 0) AS log_rows
        FROM (VALUES ('click'), ('error'), ('refund'), ('signup'), ('view')) AS e(table_name)
        FULL JOIN (SELECT table_name, count(*) AS n FROM audit_batch GROUP BY table_name) b ON e.table_name = b.table_name
        WHERE e.table_name IS NULL OR b.n IS NULL""",
    "audit_trailing_mean": "SELECT * FROM audit_means",
    "audit_deviation": "SELECT * FROM audit_checked",
    "volume_alerts": "SELECT * FROM audit_alerts",
    "volume_alerts_history": """
        SELECT *, 'VOLUME_ANOMALY' AS alert_type FROM (
            SELECT *, CASE WHEN mean_records > 0 THEN abs(records - mean_records) / mean_records * 100 ELSE 0 END AS deviation_pct
            FROM (SELECT batch_id, table_name, records, bytes, seconds, logged_at,
                         avg(records) OVER (PARTITION BY table_name ORDER BY logged_at
                                            ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean_records
                  FROM ingest_log))
        WHERE deviation_pct > 10""",
    "volume_alert_forced": """
        SELECT *, CASE WHEN records > 0 THEN CAST(records AS DOUBLE) / 2 ELSE 1 END AS mean_records,
               CAST(100 AS DOUBLE) AS deviation_pct, 'CONTROLLED_TEST' AS alert_type
        FROM audit_batch ORDER BY table_name LIMIT 1""",
    "audit_verdict": """
        SELECT CASE WHEN (SELECT count(*) FROM audit_alerts) > 0
                    THEN 'VOLUME_ALERT | batch_id=2024-01-10 | tables=' || (
                         SELECT string_agg(entry, ',' ORDER BY entry)
                         FROM (SELECT table_name || ':' || printf('%.2f', deviation_pct) || '%' AS entry FROM audit_alerts))
                         || ' | threshold=10%'
                    ELSE 'BRONZE_OK | batch_id=2024-01-10 | tables=' || (SELECT count(*) FROM audit_batch) END AS verdict""",
    # cleaning
    "typed_contract": """
        SELECT shipment_id, shipper_id, CASE WHEN weight_kg <> 13 THEN weight_kg END AS weight_kg, received_date,
               CASE WHEN package_type = 'Small' AND weight_kg % 11 = 0 THEN NULL ELSE received_time END AS received_time,
               CASE WHEN package_type = 'Large' AND weight_kg % 7 = 0 THEN NULL ELSE due_date END AS due_date,
               attempt2_date, attempt2_time, delivered_date, declared_value, updated_at,
               concat_ws(',', CASE WHEN weight_kg = 13 THEN 'weight_kg' END,
                         CASE WHEN package_type = 'Small' AND weight_kg % 11 = 0 THEN 'received_time' END,
                         CASE WHEN package_type = 'Large' AND weight_kg % 7 = 0 THEN 'due_date' END) AS bad_columns
        FROM shipments""",
    "findings_type": " UNION ALL ".join(
        ["SELECT 'shipments' AS table_name, shipment_id AS record_key, 'TYPE_INVALID' AS rule FROM shipments WHERE "
         + " OR ".join(f"coalesce({c}, false)" for c in SPOILT.values())]
    ),
    "verdicts_merged": f"""
        SELECT k.shipment_id, o.* EXCLUDE (shipment_id), k.copies, k.missing, CAST(0 AS BIGINT) AS invalid,
               o.shipment_id IS NOT NULL AS survives
        FROM (SELECT shipment_id, count(*) AS copies,
                     count(*) FILTER (WHERE {" OR ".join(f"{c} IS NULL" for c in REQUIRED["shipments"])}) AS missing
              FROM shipments GROUP BY shipment_id) k
        LEFT JOIN shipments_one o ON k.shipment_id = o.shipment_id""",
    "findings_required": "SELECT * FROM found_required",
    "findings_duplicates": "SELECT * FROM found_duplicates",
    "findings_fk": "SELECT * FROM found_fk",
    "findings_weight": "SELECT * FROM found_rules WHERE rule = 'WEIGHT_NOT_POSITIVE'",
    "findings_dates": "SELECT * FROM found_rules WHERE rule = 'DELIVERED_BEFORE_RECEIVED'",
    "findings_by_rule": "SELECT table_name, rule, count(*) AS findings FROM found_all GROUP BY table_name, rule",
    "dedup_latest": "SELECT * FROM shipments_one",
    "fk_cascade_shipments": "SELECT * FROM shipments_ref",
    "fk_cascade_ratings": "SELECT * FROM ratings_ref",
    "quarantine": """
        SELECT sha256(concat_ws('/', 'b1', table_name, rule, record_key, ordinal)) AS finding_id, 'b1' AS batch_id,
               table_name, record_key, rule, '{"record_key":"' || record_key || '"}' AS payload
        FROM (SELECT *, row_number() OVER (PARTITION BY table_name, rule, record_key) AS ordinal FROM found_all)""",
    "imputed_flags": """
        SELECT 'drivers' AS table_name, driver_id AS record_key, rating_avg AS value, rating_avg_missing AS missing
        FROM drivers_silver
        UNION ALL SELECT 'shipments', shipment_id, declared_value, declared_value_missing FROM shipments_silver
        UNION ALL SELECT 'routes', route_id, fuel, fuel_missing FROM routes_silver""",
    "imputed_district": "SELECT zone_id, coalesce(district, 'NO_DATA') AS district FROM zones",
    "drivers_masked": """
        SELECT * EXCLUDE (first_name, last_name), sha256(coalesce(first_name, '')) AS first_name_hash,
               sha256(coalesce(last_name, '')) AS last_name_hash
        FROM drivers""",
    "free_text_masked": """
        SELECT 'ratings' AS table_name, rating_id AS record_key, sha256(comment_text) AS text_hash FROM ratings
        UNION ALL SELECT 'incidents', incident_id, sha256(incident_text) FROM incidents""",
    "quality_report": """
        SELECT q.*, n.null_fractions FROM quality q JOIN (
            SELECT table_name, string_agg(column_name || '=' || CAST(floor(null_fraction * 1000000 + 1e-6) AS BIGINT), ','
                                          ORDER BY column_name) AS null_fractions
            FROM (""" + " UNION ALL ".join(_null_profile(t, c.split()) for t, c in NULL_COLUMNS.items()) + """)
            GROUP BY table_name) n ON q.table_name = n.table_name""",
    "null_profile": " UNION ALL ".join(_null_profile(t, c.split()) for t, c in NULL_COLUMNS.items()),
    **{f"silver_{t}": f"SELECT * FROM {t}_silver" for t in SILVER_NAMES},
    # model
    "dim_driver_tenure": "SELECT driver_id, hire_date, tenure_years FROM dim_driver",
    "combine_datetime": f"""
        SELECT shipment_id, {_combine("received_date", "received_time")} AS received_ts,
               {_combine("attempt1_date", "attempt1_time")} AS attempt1_ts,
               {_combine("attempt2_date", "attempt2_time")} AS attempt2_ts
        FROM shipments""",
    "delay_class_counts": "SELECT delay_class, count(*) AS shipments FROM fact_shipment GROUP BY delay_class",
    **{
        name: f"SELECT * FROM {name}"
        for name in (
            "dim_driver", "dim_shipper", "dim_zone", "fact_shipment", "fact_route",
            "driver_day_shipments", "driver_day_routes", "driver_day_ratings", "fact_driver_day",
            "shipment_events", "incident_events", "fact_shipment_event",
            "zone_day_failure", "zone_baseline", "fact_zone_alert",
            "agg_zone_day", "agg_shipper_day", "agg_package_day", "kpi_day",
        )
    },
    "zone_baseline_carried": f"SELECT * FROM zone_baseline WHERE day >= CAST({CUT} AS DATE)",
    # gate and summary
    "dq_results": "SELECT * FROM dq_gold",
    "dq_results_raw": _gate("shipments", "drivers_silver"),
    "run_counts": """
        SELECT coalesce(layer, 'ALL') AS layer, coalesce(table_name, 'ALL') AS table_name, CAST(sum(n) AS BIGINT) AS rows
        FROM all_counts GROUP BY ROLLUP (layer, table_name)""",
    "run_summary": """
        SELECT batch_id, silver_rows, gold_rows, rejected_rows, quality_alerts, duration_seconds,
               TIMESTAMP '2024-06-15 12:01:30.5' AS finished_at,
               '{"batch_id":"b1","status":"SUCCESS","rows_per_layer":{"silver":' || silver_rows || ',"gold":' || gold_rows
               || '},"rows_per_table":{' || (SELECT string_agg('"' || layer || '.' || table_name || '":' || n, ','
                                                               ORDER BY layer || '.' || table_name) FROM all_counts)
               || '},"rejected_rows":' || rejected_rows || ',"quality_alerts":' || quality_alerts
               || ',"duration_seconds":90.5,"finished_at":"2024-06-15T12:01:30.500Z"}' AS summary,
               'DAILY_SUMMARY | batch_id=b1 | silver=' || silver_rows || ' | gold=' || gold_rows || ' | rejected='
               || rejected_rows || ' | quality_alerts=' || quality_alerts || ' | seconds=90.500' AS summary_line
        FROM (SELECT 'b1' AS batch_id,
                     (SELECT CAST(sum(n) AS BIGINT) FROM all_counts WHERE layer = 'silver') AS silver_rows,
                     (SELECT CAST(sum(n) AS BIGINT) FROM all_counts WHERE layer = 'gold') AS gold_rows,
                     (SELECT CAST(sum(rejected_rows) AS BIGINT) FROM quality) AS rejected_rows,
                     (SELECT count(*) FROM dq_gold WHERE status = 'FAIL') AS quality_alerts,
                     CAST(90.5 AS DOUBLE) AS duration_seconds)""",
    # versions: the second has another day of reference and the rows of a second batch, the third failed its gate
    "kpi_refreshed": "SELECT * FROM kpi_day",
    "gold_after_failed_gate": "SELECT CAST(2 AS BIGINT) AS version, * FROM kpi_day",
    "gold_by_version": """
        SELECT CAST(1 AS BIGINT) AS version, driver_id, tenure_years FROM dim_driver
        UNION ALL SELECT 2, driver_id, tenure_years FROM (""" + GOLD["dim_driver"].replace("2024", "2025") + ")",
    # analyst SQL
    "sql_kpi_latest": "SELECT * FROM kpi_day ORDER BY day DESC LIMIT 5",
    "sql_zone_rank": """
        SELECT z.city_code, z.city_name, z.zone_id, z.zone_name, p.shipments, p.sla_rate,
               rank() OVER (PARTITION BY z.city_code ORDER BY p.sla_rate DESC NULLS LAST) AS zone_rank
        FROM (SELECT zone_id, count(*) AS shipments, avg(CAST(sla_met AS INT)) AS sla_rate
              FROM fact_shipment GROUP BY zone_id) p
        JOIN dim_zone z ON p.zone_id = z.zone_id""",
    "sql_penalty_rollup": f"""
        SELECT s.industry_segment, f.package_type, CAST(grouping(s.industry_segment) AS INT) AS all_segments,
               CAST(grouping(f.package_type) AS INT) AS all_packages, count(*) AS shipments,
               {_exact("f.estimated_penalty")} AS penalty_total
        FROM fact_shipment f JOIN dim_shipper s ON f.shipper_id = s.shipper_id
        GROUP BY ROLLUP (s.industry_segment, f.package_type)""",
    "sql_kpi_moving": """
        SELECT day, shipments, success_rate,
               CAST(sum(delivered) OVER w AS DOUBLE) / CAST(sum(shipments) OVER w AS DOUBLE) AS success_rate_7d
        FROM kpi_day WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    "sql_driver_worst": f"""
        SELECT r.day_year, r.day_month, r.place, r.driver_id, d.vehicle_type, r.days, r.mean_score
        FROM (SELECT *, CAST(row_number() OVER (PARTITION BY day_year, day_month ORDER BY mean_score, driver_id) AS INT) AS place
              FROM (SELECT day_year, day_month, driver_id, count(*) AS days, {_exact("score")} / count(*) AS mean_score
                    FROM fact_driver_day GROUP BY day_year, day_month, driver_id)) r
        JOIN dim_driver d ON r.driver_id = d.driver_id WHERE r.place <= 10""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(text) for name, text in STATEMENTS.items()}
