"""Command line: ``python -m barsmith <command> ...`` (or ``spark-submit``).

Commands map the original job's entry points onto the two-step design:

* ``land-master``  CSV master -> Parquet with line order
* ``plan``         request manifest for spot / stocks / options (written as Parquet)
* ``ingest``       landed responses -> store, plus reports (batch or ``--stream``)
* ``next-run``     split manifest of one run -> request manifest of the next
* ``migrate``      original per-entity files -> store
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from barsmith.plans import jobs as J
from barsmith.schemas import CANDLE_KEYS, OPTION_KEYS


def _session(spark=None):
    if spark is not None:
        return spark
    from barsmith.session import build_session
    return build_session()


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="barsmith")
    sub = ap.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("land-master")
    m.add_argument("--csv", required=True)
    m.add_argument("--out", required=True)
    p = sub.add_parser("plan")
    p.add_argument("--kind", choices=["spot", "stocks", "options"], required=True)
    p.add_argument("--master", required=True, help="landed master (Parquet)")
    p.add_argument("--store", required=True)
    p.add_argument("--run", type=int, required=True, help="ingest run number (increasing)")
    p.add_argument("--as-of", default=None, help="YYYY-MM-DD, default today in IST")
    p.add_argument("--out", required=True, help="manifest output (Parquet)")
    i = sub.add_parser("ingest")
    i.add_argument("--kind", choices=["spot", "stocks", "options"], required=True)
    i.add_argument("--manifest", required=True)
    i.add_argument("--landing", required=True)
    i.add_argument("--store", required=True)
    i.add_argument("--reports", required=True)
    i.add_argument("--stream", action="store_true", help="availableNow file stream")
    i.add_argument("--checkpoint", default=None)
    i.add_argument("--strict-cells", action="store_true",
                   help="fail on a null or unreadable cell inside an array")
    i.add_argument("--cells", choices=["text", "variant"], default="text",
                   help="variant: cells keep their JSON type, so a fractional text is no integer")
    n = sub.add_parser("next-run")
    n.add_argument("--kind", choices=["spot", "stocks", "options"], required=True)
    n.add_argument("--split-manifest", required=True, help="<reports>/split_manifest of a run")
    n.add_argument("--run", type=int, required=True, help="number of the next run")
    n.add_argument("--out", required=True, help="manifest output (Parquet)")
    g = sub.add_parser("migrate")
    g.add_argument("--kind", choices=["spot", "stocks", "options"], required=True)
    g.add_argument("--legacy-root", required=True)
    g.add_argument("--store", required=True)
    for sp in (p, i, g):
        sp.add_argument("--granularity", choices=["day", "month"], default=J.DEFAULT_GRANULARITY,
                        help="store partition: IST day (default) or IST month")
    a = ap.parse_args(argv)
    spark = _session(spark)

    if a.cmd == "land-master":
        from barsmith.sources.instruments import land_master
        land_master(spark, a.csv, a.out)
    elif a.cmd == "plan":
        master = spark.read.parquet(a.master)
        as_of = dt.date.fromisoformat(a.as_of) if a.as_of else None
        if a.kind == "spot":
            man = J.plan_spot_requests(spark, master, a.store, as_of, a.run, a.granularity)
        elif a.kind == "stocks":
            man, missing = J.plan_stock_requests(spark, master, a.store, as_of, a.run,
                                                 granularity=a.granularity)
            missing.write.mode("overwrite").parquet(a.out + "_missing_symbols")
        else:
            man = J.plan_option_requests(spark, master, a.store, as_of, a.run, a.granularity)
        man.write.mode("overwrite").parquet(a.out)
    elif a.cmd == "ingest":
        manifest = spark.read.parquet(a.manifest)
        if a.stream:
            from barsmith.streaming.ingest_stream import stream_ingest
            stream_ingest(spark, a.kind, manifest, a.landing, a.store,
                          a.checkpoint or a.reports + "/_checkpoint", a.reports,
                          granularity=a.granularity, cells=a.cells)
        else:
            own = {"granularity": a.granularity, "strict_cells": a.strict_cells, "cells": a.cells}
            res = (J.ingest_options(spark, manifest, a.landing, a.store, **own)
                   if a.kind == "options"
                   else J.ingest_candles(spark, a.kind, manifest, a.landing, a.store, **own))
            for name in ("summary", "run_summary", "quarantine", "rerequest", "split_manifest"):
                getattr(res, name).write.mode("overwrite").parquet(f"{a.reports}/{name}")
            res.release(spark)
            print(json.dumps({"months": res.months, **res.metrics}))
    elif a.cmd == "next-run":
        J.next_run_split_manifest(spark.read.parquet(a.split_manifest), a.kind, a.run) \
            .write.mode("overwrite").parquet(a.out)
    elif a.cmd == "migrate":
        from barsmith.sources.legacy import migrate
        schema = (J.option_store(a.granularity) if a.kind == "options"
                  else J.candle_store(a.granularity))
        keys = OPTION_KEYS if a.kind == "options" else CANDLE_KEYS
        sort = ["underlying", "ts"] if a.kind == "options" else ["symbol", "ts"]
        migrate(spark, a.legacy_root, a.kind, a.store, schema, keys, sort)
    return 0


if __name__ == "__main__":
    sys.exit(main())
