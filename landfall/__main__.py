"""Build the whole lake: ``python -m landfall --output DIR --staging DIR ...``."""

import argparse
import sys

from landfall.plans.jobs import LakeConfig, report_frame, run_all
from landfall.session import build_session, input_bytes, scale_conf
from landfall.sources.paths import join_path


def main(argv=None):
    parser = argparse.ArgumentParser(prog="landfall")
    parser.add_argument("--output", required=True)
    parser.add_argument("--staging", required=True, help="folder shared by all executors")
    parser.add_argument("--inputs", default="")
    parser.add_argument("--arrivals", default=LakeConfig.arrivals)
    parser.add_argument("--temperatures", default=LakeConfig.temperatures)
    parser.add_argument("--demographics", default=LakeConfig.demographics)
    parser.add_argument("--input-gb", type=float, help="sizes the shuffles; measured if not given")
    parser.add_argument("--cores", type=int, default=8)
    args = parser.parse_args(argv)

    cfg = LakeConfig(
        args.output, args.staging, args.inputs, args.arrivals, args.temperatures, args.demographics
    )
    spark = build_session("landfall")
    size = int(args.input_gb * 1024**3) if args.input_gb else input_bytes(
        spark, [join_path(cfg.inputs, p) for p in (cfg.arrivals, cfg.temperatures, cfg.demographics)])
    for key, value in scale_conf(size, args.cores).items():
        spark.conf.set(key, value)
    checks = run_all(spark, cfg)
    report_frame(spark, checks).show(truncate=False)
    return 0 if all(c.status == "passed" for c in checks) else 1


if __name__ == "__main__":
    sys.exit(main())
