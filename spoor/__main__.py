"""Command line: ``spark-submit`` or ``python -m spoor <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from spoor.plans import jobs
from spoor.session import run_folder


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spoor")
    sub = top.add_subparsers(dest="job", required=True)

    def job(name: str, about: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=about)
        p.add_argument("--input", required=True, help="descriptor file or folder")
        p.add_argument("--output", required=True)
        p.add_argument("--form", choices=["parquet", "text", "flat"], default="text",
                       help="flat: one file per descriptor, as native tools read them")
        p.add_argument("--folders", action="store_true", help="a folder per descriptor, as the "
                       "text form is written")
        p.add_argument("--shared", help="folder that all executors share, for intermediate "
                       "tables (default: spark.checkpoint.dir)")
        return p

    p = job("mix", "mix descriptors by rules")
    p.add_argument("--rules", help="rule file, folder or glob")
    p.add_argument("--customer-map")
    p.add_argument("--name", help="name of the mix of a single rule file")
    p.add_argument("--thin", type=float, default=0.0, metavar="PERCENT")
    p.add_argument("--in-rule-order", action="store_true")
    p.add_argument("--compat-float32", action="store_true")
    for name, about in (("t2s", "curve by cache size"), ("t2c", "curve by object count")):
        p = job(name, about)
        p.add_argument("--icp", action="store_true", help="include 1->2 transitions")
    p = job("unshard", "multiply every amount")
    p.add_argument("--factor", type=float, required=True)
    p.add_argument("--compat-float32", action="store_true")
    p = job("concat", "place descriptors side by side")
    p.add_argument("--rules", required=True)
    p.add_argument("--name", default="mix")
    p.add_argument("--weigh-by-traffic", action="store_true")
    p.add_argument("--cmax", type=int, default=0, help="mb, 0 for no limit")
    p.add_argument("--min-ghost", type=int, default=1)
    p.add_argument("--thin", type=float, default=0.0, metavar="PERCENT")
    return top


def run(spark: SparkSession, a: argparse.Namespace) -> jobs.Outcome:
    if a.job == "mix":
        return jobs.mix_job(
            spark, a.input, a.output, a.rules, a.customer_map, a.name, a.thin, a.form,
            a.in_rule_order, a.compat_float32, a.folders,
        )
    if a.job in ("t2s", "t2c"):
        axis = "mb" if a.job == "t2s" else "objcount"
        return jobs.curve_job(spark, a.input, a.output, axis, a.icp, form=a.form, folders=a.folders)
    if a.job == "unshard":
        return jobs.unshard_job(
            spark, a.input, a.output, a.factor, a.form, a.compat_float32, folders=a.folders,
        )
    return jobs.concat_job(
        spark, a.input, a.rules, a.output, a.name, a.weigh_by_traffic, a.cmax, a.min_ghost,
        a.thin, a.form, folders=a.folders,
    )


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName(f"spoor-{args.job}").getOrCreate()
    if args.shared:
        spark.conf.set("spark.checkpoint.dir", args.shared)
    try:
        with run_folder(spark, f"spoor-{args.job}"):
            outcome = run(spark, args)
            outcome.summary.show()
            outcome.failures.show(100, truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
