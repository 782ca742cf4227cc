"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridscope_checks import QUERIES  # noqa: E402
from gridscope.session import local_session  # noqa: E402

HEADLINE = (
    "c1_fingerprint_ground", "c1_fingerprint_upper", "c2_j10_fingerprint_layers",
    "c3_nearest_cell_by_pci", "c4_j14_resolve_neighbours", "a8_skew_report",
    "c6_locate", "c6_c7_all_located", "c8_a3_overlap_by_grid", "c9_grid_kpi_with_empty_grids",
    "c10_a4_packet_loss", "c11_j8_grid_result", "c12_a6_j9_floor_rsrp",
    "c13_mdt_grid_stats", "c14_j13_calibrated_fingerprint",
    "c15_t3_user_features_wide", "c16_extract_locations",
    "f8_salted_sum", "g1_wgs84_to_gcj02", "g11_ta_aoa_point", "k12_strip_punctuation",
    "w6_global_row_number", "s7_partition_overwrite", "s12_compaction", "e1_locate_all_hours",
)


def run(spark, name: str, sf: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session()
    run(spark, "c6_locate", os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001"))
    times = {name: run(spark, name, sf) for name in HEADLINE}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
