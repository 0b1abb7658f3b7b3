"""Run a build from a JSON job spec (``IndexSpec.to_dict`` layout).

    spark-submit --py-files shardloom.zip -m shardloom build job.json OUT [--quarantine] [--publish LIVE]
        [--postings] [--id-mode position|key|content|random]
    python -m shardloom build job.json OUT
    python -m shardloom publish OUT LIVE [--build-id ID]      # also back to an older build
    python -m shardloom remove LIVE [--keep N]                # files of builds out of reach
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .functions.ids import ID_MODES
from .plans.build import build_index
from .sinks.documents import publish, remove_replaced
from .spec import IndexSpec


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shardloom")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build the indices of a job spec")
    b.add_argument("spec", help="JSON file with the index spec")
    b.add_argument("out", help="output folder of the build")
    b.add_argument("--quarantine", action="store_true", help="set rejected lines aside instead of failing")
    b.add_argument("--publish", metavar="LIVE", help="then replace the built indices in this folder")
    b.add_argument("--postings", action="store_true", help="also write the postings and the term dictionary")
    b.add_argument("--id-mode", choices=ID_MODES, help="how document ids are made (default: key fields, else position)")
    p = sub.add_parser("publish", help="make the indices of a build folder current in a live folder")
    p.add_argument("out")
    p.add_argument("live")
    p.add_argument("--build-id", help="of this build (default: the current build of each index)")
    r = sub.add_parser("remove", help="remove the files of replaced builds")
    r.add_argument("live")
    r.add_argument("--keep", type=int, default=1, help="publications that can still be gone back to (default 1)")
    args = ap.parse_args(argv)

    if args.cmd != "build":
        spark = SparkSession.builder.appName(f"shardloom-{args.cmd}").getOrCreate()
        if args.cmd == "publish":
            rows = publish(spark, args.out, args.live, build_id=args.build_id)
            print(json.dumps({"published": rows.count(), "live": args.live}))
        else:
            print(json.dumps({"removed": remove_replaced(spark, args.live, keep=args.keep), "live": args.live}))
        return 0
    with open(args.spec, encoding="utf-8") as fh:
        spec = IndexSpec.from_dict(json.load(fh))
    spark = SparkSession.builder.appName(f"shardloom-{spec.name}").getOrCreate()
    res = build_index(spark, spec, args.out, mode="quarantine" if args.quarantine else "failfast",
                      id_mode=args.id_mode, postings=args.postings)
    if args.publish:
        publish(spark, args.out, args.publish, build_id=res.build_id)
    print(json.dumps({"build_id": res.build_id, "out": args.out, "published": args.publish}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
