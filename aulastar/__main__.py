"""Command line: ``python -m aulastar {ingest,backfill,transform} ...``.

    python -m aulastar ingest    --landing DIR --root DIR --year 2024 [--run-id ID]
    python -m aulastar backfill  --landing DIR --root DIR [--run-id ID]
    python -m aulastar transform --root DIR --seed FILE.csv

On a cluster run it through ``spark-submit`` so that the session (and its
``spark.checkpoint.dir``) come from the deployment.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="aulastar")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("ingest", "backfill"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--root", required=True)
        p.add_argument("--run-id", default=dt.datetime.now(dt.timezone.utc).strftime("manual__%Y-%m-%dT%H:%M:%S"))
        if name == "ingest":
            p.add_argument("--year", type=int, required=True)
    p = sub.add_parser("transform")
    p.add_argument("--root", required=True)
    p.add_argument("--seed", required=True)
    args = ap.parse_args(argv)

    from aulastar.plans import jobs
    from aulastar.session import get_spark

    spark = get_spark()
    if args.cmd == "ingest":
        r = jobs.ingest_year(spark, args.landing, args.root, args.year, args.run_id)
        print(json.dumps({"anio": r.anio, "validation": r.validation}, default=str))
    elif args.cmd == "backfill":
        loads, summary = jobs.backfill_all(spark, args.landing, args.root, args.run_id)
        print(json.dumps({"summary": summary.first().asDict(),
                          "errors": {pl.profile: pl.error for pl in loads if pl.error}}, default=str))
    else:
        res = jobs.transform(spark, args.root, args.seed)
        print(json.dumps([r.asDict() for r in res.summary.collect()], default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
