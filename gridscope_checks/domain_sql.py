"""SQL twins of domain.py, as common table expressions for DuckDB."""

from __future__ import annotations

GRID_LON = "({gci}*5)/20037508.34::double*180"
GRID_LAT = ("180/pi()*(2*atan(exp(({gri}*5)/20037508.34::double*180*pi()/180))-pi()/2)")

_GRIDS = """
select p_partkey, p_size, 2610000 + (p_partkey // 3) % 50 google_gci,
 776000 + (p_partkey // 3) // 50 google_gri, cast((p_partkey % 3) * 5 as integer) grid_height
from part
"""

CTE = {
    "mro": """
select objectid, cast(o_orderkey as varchar) mmeues1apid,
 strftime(o_orderdate, '%Y-%m-%d') || ' ' || lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':00:00' time_stamp,
 (objectid + l_linenumber + case when objectid % 10 = 0 then 7 * (o_orderkey % 3) else 0 end) % 200 ncellobjectid,
 cast(cast(floor(o_totalprice) as bigint) % 98 as integer) ltescrsrp,
 cast(case when o_orderkey % 10 = 0 then -999 else o_orderkey % 35 end as integer) ltescrsrq,
 cast(case when o_custkey % 7 = 0 then -999 else cast(floor(o_totalprice) as bigint) % 37 end as double) ltescsinrul,
 cast(cast(floor(l_extendedprice) as bigint) % 98 as integer) ltencrsrp,
 cast(o_orderkey % 3 as integer) ta, cast(o_custkey % 360 as integer) aoa,
 cast(l_partkey % 101 - 1 as integer) ltescpuschprbnum, cast(l_suppkey % 101 - 1 as integer) ltescpdschprbnum,
 cast(case when l_linenumber % 3 = 0 then null else cast(floor(l_discount * 1000) as bigint) - 10 end as double) ulqci1,
 cast(cast(floor(l_tax * 1000) as bigint) - 10 as double) dlqci1,
 strftime(o_orderdate, '%Y%m%d') as day, lpad(cast(o_orderkey % 24 as varchar), 2, '0') as hour
from (select *, case when o_custkey % 3 = 0 then 0 else o_custkey % 200 end objectid from orders) o
join lineitem on o_orderkey = l_orderkey
""",
    "grids": _GRIDS,
    "finger": f"""
select objectid, google_gci || '_' || google_gri gridid,
 {GRID_LON.format(gci='google_gci')} longitude, {GRID_LAT.format(gri='google_gri')} latitude,
 -(60 + p_size) - p_partkey % 4 / 10.0::double rsrp, (objectid + k) % 200 n_objectid,
 -(60 + (p_size * 7 + k * 13) % 60) + k % 3 / 10.0::double n_rsrp, grid_height height
from (select *, p_partkey % 200 objectid from grids) g, unnest(range(1, 22)) e(k)
where k <= case when objectid % 10 = 0 then 21 else 7 end
""",
    "raw_long": """
select google_gci, google_gri, grid_height, k,
 case when (p_partkey + k) % 9 = 0 then null
  when (p_partkey + k) % 11 = 0 then 'a' || ((p_partkey + k) % 100) || '_' || k
  else ((p_partkey + k) % 100) || '_' || k end antenna,
 cast(-(60 + (p_size * 7 + k * 13) % 60) as double) rsrp
from grids, unnest(range(0, 7)) e(k)
""",
    "res_cell": """
select s_suppkey * 256 + sector objectid, cast(100 * (s_suppkey % 3) as integer) earfcn, s_suppkey siteoid
from supplier, unnest(range(0, 7)) e(sector)
""",
    "sites": f"""
select objectid, {GRID_LON.format(gci='(2610000 + objectid % 50)')} longitude,
 {GRID_LAT.format(gri='(776000 + objectid // 50)')} latitude
from (select distinct c_custkey % 200 objectid from customer) c
""",
    "grid_building": """
select distinct google_gci || '_' || google_gri gridid, cast((p_partkey // 3) % 30 as integer) buildingid from grids
""",
    "cells": """
select s_suppkey eci, cast(1150 + s_suppkey % 50 as double) / 10 longitude,
 cast(150 + s_nationkey as double) / 5 latitude, cast(s_suppkey % 7 as integer) pci,
 cast(100 * (s_nationkey % 3) as integer) earfcn
from supplier
""",
    "pci_list": "select distinct pci, earfcn from cells",
    "mro_wide": """
select o_custkey % 100 eci, cast(o_orderkey as varchar) mmeues1apid,
 strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as "timestamp",
 cast(cast(floor(o_totalprice) as bigint) % 98 as integer) ltescrsrp, cast(o_orderkey % 35 as integer) ltescrsrq,
 cast(cast(floor(o_totalprice) as bigint) % 37 as double) ltescsinrul,
 cast(100 * (o_custkey % 3) as integer) ltescearfcn, cast(o_orderkey % 7 as integer) ltescpci,
 cast(o_orderkey % 50 as integer) ltesctadv, cast(o_custkey % 360 as integer) ltescaoa,
 cast(cast(floor(o_totalprice) as bigint) % 101 as integer) ltescpuschprbnum,
 cast(o_custkey % 101 as integer) ltescpdschprbnum,
 cast(o_orderkey % 90 as double) ltescplrulqci1, cast(o_custkey % 90 as double) ltescplrdlqci1,
 cast(floor(o_totalprice) as bigint) price, o_orderkey, o_custkey
from orders
""",
    "mro_slots": """
select w.*, i, cast((price + i * 7) % 98 as integer) ltencrsrp,
 cast(100 * ((o_custkey + i) % 3) as integer) ltencearfcn, cast((o_orderkey + i) % 7 as integer) ltencpci
from mro_wide w, unnest(range(1, 9)) e(i) where (o_orderkey + i) % 4 <> 0
""",
    "mdt": """
select * from (
 select case when event_id % 19 = 0 then null else strftime(ts, '%Y-%m-%d %H:%M:%S') end time_stamp,
  cast(user_id as varchar) mmeues1apid, event_id % 200 objectid,
  cast(case when event_id % 17 = 0 then 0 else -(60 + event_id % 50) end as integer) ltescrsrp,
  cast(case when event_id % 13 = 0 then 121000000 else 117230100 + (event_id % 61) * 40 end as double) / 1000000 longitude,
  cast(32884600 + (event_id % 37) * 38 as double) / 1000000 latitude, 0 height
 from events) e
where longitude > 115 and longitude < 120 and latitude > 30 and latitude < 35
""",
}

# Tables each expression reads, in the order they must be defined.
NEEDS = {
    "finger": ("grids",), "raw_long": ("grids",), "grid_building": ("grids",), "pci_list": ("cells",),
    "mro_slots": ("mro_wide",),
}


def with_tables(names: str, body: str, **more: str) -> str:
    """``body`` behind the definitions of the named tables and of ``more``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = [f"{name} as ({CTE[name].strip()})" for name in ordered]
    parts += [f"{name} as ({sql.strip()})" for name, sql in more.items()]
    return f"with {', '.join(parts)}\n{body.strip()}"
