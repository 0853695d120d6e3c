"""Command line for the jobs: ``python -m namewright ...`` or
``spark-submit --py-files namewright.zip namewright/__main__.py ...``.

  stage   --meta T --members T --dictionary T --rules T --staging PATH
          --status PATH [--load-sets 1,2 | all] [--report PATH]
  export  --meta T --members T --names T --out PATH --bundles N [--bundle-mb M]
          [--load-set ID | all] [--mode reference|clean]
  store   --meta T --members T --names T --buckets N --prefix DB.
          writes the three tables to the catalog, clustered by curve, for ``table:`` arguments

A table argument is a parquet path, ``table:NAME`` for a catalog table, or
``jdbc:<url>#<table>`` (metadata and names are read in ``--jdbc-parts`` range
partitions of their id; ``--staging`` and ``--status`` may be one too).  Credentials come
from the environment variables NAMEWRIGHT_JDBC_USER / NAMEWRIGHT_JDBC_PASSWORD.
The session comes from spark-submit; nothing here sets cluster options.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from namewright.plans import jobs
from namewright.sinks.writers import write_bucketed
from namewright.sources import jdbc
from namewright.sources.tables import ALL, META_COLUMNS, NAME_COLUMNS, decode_meta, decode_names


def jdbc_props(args) -> dict:
    props = {k: v for k, v in (("user", os.environ.get("NAMEWRIGHT_JDBC_USER")),
                               ("password", os.environ.get("NAMEWRIGHT_JDBC_PASSWORD")),
                               ("driver", args.jdbc_driver)) if v}
    return props


def load(spark: SparkSession, spec: str, args, columns=None, id_col: str | None = None) -> DataFrame:
    if spec.startswith("table:"):
        return spark.table(spec[len("table:"):])
    if spec.startswith("jdbc:"):
        if columns is not None and args.jdbc_parts > 1:
            return jdbc.read_bucketed(spark, spec, columns, id_col, args.jdbc_parts, jdbc_props(args), args.jdbc_quote)
        url, table = jdbc.split_spec(spec)
        return jdbc.read_jdbc(spark, url, table, props=jdbc_props(args))
    return spark.read.parquet(spec)


def _sets(text: str | None):
    if text is None or text == ALL:
        return None
    return [int(x) for x in text.split(",") if x.strip()]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="namewright")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("stage", help="stage curve names (JOB1)")
    for a in ("meta", "members", "dictionary", "rules"):
        s.add_argument(f"--{a}", required=True)
    s.add_argument("--staging", required=True)
    s.add_argument("--status", required=True, help="fresh path for the status snapshot, or the JDBC rules table itself")
    s.add_argument("--load-sets", default=None, help="comma list, or 'all' (default)")
    s.add_argument("--report", default=None, help="optional path for the per-load-set report")
    s.add_argument("--type-id", type=int, default=None)
    s.add_argument("--max-attr-chars", type=int, default=None)
    e = sub.add_parser("export", help="export search documents (JOB2)")
    for a in ("meta", "members", "names"):
        e.add_argument(f"--{a}", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--bundles", type=int, required=True)
    e.add_argument("--bundle-mb", type=int, default=None, help="cut bundles into files of about this size")
    e.add_argument("--load-set", default=ALL)
    e.add_argument("--mode", default="reference", choices=["reference", "clean"])
    c = sub.add_parser("store", help="store the large tables by curve (SRC3)")
    for a in ("meta", "members", "names"):
        c.add_argument(f"--{a}", required=True)
    c.add_argument("--buckets", type=int, required=True)
    c.add_argument("--prefix", default="", help="database and start of the tables' names")
    for q in (s, e, c):
        q.add_argument("--jdbc-parts", type=int, default=1)
        q.add_argument("--jdbc-driver", default=None)
        q.add_argument("--jdbc-quote", default='"')
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"namewright-{args.job}").getOrCreate()
    meta = decode_meta(load(spark, args.meta, args, META_COLUMNS, "object_id"))
    members = load(spark, args.members, args)
    if args.job == "stage":
        run = jobs.run_staging(
            meta, members, load(spark, args.dictionary, args), load(spark, args.rules, args),
            args.staging, args.status, load_set_ids=_sets(args.load_sets), report_path=args.report,
            type_id=args.type_id, max_attr_chars=args.max_attr_chars, jdbc_props=jdbc_props(args), jdbc_quote=args.jdbc_quote)
        print(json.dumps({"metrics": run.metrics, "failed_load_sets": run.failed_load_sets,
                          "errors": {r.load_set_id: r.error for r in run.rule_sets if r.error}}))
        return 1 if run.failed_load_sets else 0
    names = decode_names(load(spark, args.names, args, NAME_COLUMNS, "curve_id"))
    if args.job == "store":
        for name, df, key in (("object_meta", meta, "object_id"), ("load_set_curve", members, "curve_id"), ("curve_name", names, "curve_id")):
            write_bucketed(df, args.prefix + name, key, args.buckets)
        return 0
    load_set = args.load_set if args.load_set == ALL else int(args.load_set)
    jobs.run_export(meta, members, names, args.out, args.bundles, load_set_id=load_set, mode=args.mode,
                    bundle_bytes=args.bundle_mb << 20 if args.bundle_mb else None)
    return 0


if __name__ == "__main__":
    sys.exit(main())
