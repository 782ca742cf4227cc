"""Schemas of the tables that travel between the steps."""

from __future__ import annotations

SAMPLE_KEY = ("objectid", "mmeues1apid", "time_stamp")
SERVING = ("ltescrsrp", "ltescrsrq", "ltescsinrul")
FINGER_COLUMNS = ("objectid", "gridid", "longitude", "latitude", "rsrp", "n_objectid", "n_rsrp", "height")

MRO = """
    objectid bigint, mmeues1apid string, time_stamp string, ncellobjectid bigint,
    ltescrsrp int, ltescrsrq int, ltescsinrul double, ltencrsrp int, ta int, aoa int,
    ltescpuschprbnum int, ltescpdschprbnum int, ulqci1 double, dlqci1 double
"""

FINGER = """
    objectid bigint, gridid string, longitude double, latitude double, rsrp double,
    n_objectid bigint, n_rsrp double, height int
"""

LOCATED = """
    objectid bigint, mmeues1apid string, time_stamp string, ltescrsrp int, ltescrsrq int,
    ltescsinrul double, gridid string, height int, distance double
"""

MDT = """
    time_stamp string, mmeues1apid string, objectid bigint, ltescrsrp int,
    longitude double, latitude double, height int
"""

CELL_SITE = "objectid bigint, earfcn int, longitude double, latitude double"

HTTP_LOG = "host string, uri string, content string"
