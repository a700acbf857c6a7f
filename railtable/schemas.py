"""Catalog tables: columns and types (DDL), keys, the component that owns a table, and least row counts."""

from __future__ import annotations

TABLES: dict[str, dict] = {
    "stations": {"ddl": "pack_id string, station_id string, name_ko string, latitude double, longitude double", "key": ["pack_id", "station_id"], "component": "catalog", "least": 1},
    "lines": {"ddl": "pack_id string, line_id string, name_ko string, operator_id string", "key": ["pack_id", "line_id"], "component": "catalog", "least": 1},
    "station_lines": {"ddl": "pack_id string, station_id string, line_id string, line_sequence int", "key": ["pack_id", "station_id", "line_id"], "component": "catalog", "least": 1},
    "aliases": {"ddl": "pack_id string, station_id string, alias string", "key": ["pack_id", "station_id", "alias"], "component": "catalog", "least": 0},
    "trips": {"ddl": "pack_id string, trip_id string, line_id string, day string, direction string", "key": ["pack_id", "trip_id"], "component": "timetable", "least": 1},
    "stop_times": {"ddl": "pack_id string, trip_id string, stop_no int, station_id string, arrival int, departure int", "key": ["pack_id", "trip_id", "stop_no"], "component": "timetable", "least": 1},
    "network_edges": {"ddl": "pack_id string, edge_id string, from_node string, to_node string, edge_type string, seconds int, metres int", "key": ["pack_id", "edge_id"], "component": "network", "least": 1},
    "facilities": {"ddl": "pack_id string, facility_id string, station_id string, facility_type string, status string", "key": ["pack_id", "facility_id"], "component": "facilities", "least": 0},
}
