"""Scale-up check: the catalogue derived from one scale factor, replicated k
times with shifted ids (every copy is a distinct set of curves, same shape),
then both jobs timed.  Shows how run time grows with the data.

  python tools/scale_check.py [sf_dir] [k ...]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from namewright.plans import jobs  # noqa: E402
from namewright.session import local_session  # noqa: E402
from namewright.sources import fixture_views as fv  # noqa: E402

ID_SHIFT = 10_000_000


def replicate(df, k, id_cols):
    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
    out = df.select("*", copies)
    for c in id_cols:
        out = out.withColumn(c, F.col(c) + F.col("_copy").cast("long") * ID_SHIFT)
    return out.drop("_copy")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ks = [int(x) for x in sys.argv[2:]] or [1, 10]
    spark = local_session(8, 16, app="namewright-scale")
    v = fv.all_views(spark, sf)
    base = tempfile.mkdtemp(prefix="namewright-scale-", dir="/tmp")
    res = {}
    for k in ks:
        d = f"{base}/k{k}"
        replicate(v["object_meta"], k, ["object_id"]).write.parquet(f"{d}/object_meta")
        replicate(v["load_set_curve"], k, ["curve_id"]).write.parquet(f"{d}/load_set_curve")
        replicate(v["curve_name"], k, ["curve_id"]).write.parquet(f"{d}/curve_name")
        v["curve_dict"].write.parquet(f"{d}/curve_dict")
        v["curve_rule"].write.parquet(f"{d}/curve_rule")
        t = lambda n: spark.read.parquet(f"{d}/{n}")
        rows = t("object_meta").count()
        t0 = time.time()
        jobs.run_staging(t("object_meta"), t("load_set_curve"), t("curve_dict"), t("curve_rule"),
                         f"{d}/out/staging", f"{d}/out/status")
        t1 = time.time()
        jobs.run_export(t("object_meta"), t("load_set_curve"), t("curve_name"), f"{d}/out/docs", 16)
        t2 = time.time()
        res[k] = {"meta_rows": rows, "stage_sec": round(t1 - t0, 2), "export_sec": round(t2 - t1, 2)}
        print(json.dumps({k: res[k]}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
