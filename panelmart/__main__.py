"""Command line: run the batch job on source-layout files, show reports.

    python -m panelmart --root /warehouse --health h.csv --density d.csv \
        --area a.csv --environment env.csv --mapping map.csv --geojson r.geojson \
        [--year-start 2019 --year-end 2024 --events 2020,2021 \
         --donors 3217:3204,3218:3207 --expected-entities 27] [--report NAME ...]
"""

from __future__ import annotations

import argparse

from panelmart.config import PanelConfig
from panelmart.plans import pipeline
from panelmart.plans.reporting import published_reports
from panelmart.session import get_session
from panelmart.sources.files import raw_from_files


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="panelmart")
    ap.add_argument("--root", required=True, help="warehouse folder (shared storage)")
    for name in ("health", "density", "area", "environment", "mapping", "geojson"):
        ap.add_argument(f"--{name}", required=True)
    ap.add_argument("--year-start", type=int, default=PanelConfig.year_start)
    ap.add_argument("--year-end", type=int, default=PanelConfig.year_end)
    ap.add_argument("--events", default=",".join(map(str, PanelConfig.event_periods)))
    ap.add_argument("--donors", default=",".join(f"{t}:{d}" for t, d in PanelConfig.donors))
    ap.add_argument("--expected-entities", type=int, default=PanelConfig.expected_entities)
    ap.add_argument("--on-duplicate-edges", default="error", choices=["error", "null", "collapse"])
    ap.add_argument("--report", action="append", default=[])
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    cfg = PanelConfig(
        year_start=a.year_start, year_end=a.year_end,
        event_periods=tuple(int(x) for x in a.events.split(",") if x),
        donors=tuple(tuple(p.split(":")) for p in a.donors.split(",") if p),
        expected_entities=a.expected_entities, on_duplicate_edges=a.on_duplicate_edges)
    spark = get_session(a.master)
    raw = raw_from_files(spark, a.health, a.density, a.area, a.environment, a.mapping, a.geojson)
    out = pipeline.run(spark, raw, cfg, a.root)
    print(f"run {out['run_id']}: {out['status']}")
    print(f"run {out['run_id']}: {out['load_status']}")
    reps = published_reports(spark, a.root, cfg)
    for name in a.report:
        print(f"== {name}")
        reps[name].show(50, truncate=False)


if __name__ == "__main__":
    main()
