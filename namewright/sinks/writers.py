"""Sinks (SNK1-5, UNI1).

* Staging is a parquet table partitioned by ``load_set_id``; a run replaces
  exactly the partitions of the load sets it processed (dynamic partition
  overwrite), so reruns and retried tasks never double rows.  The write
  comes first: if it fails, the old rows stay.  Only then are the partitions
  of processed load sets without rows removed, which the overwrite leaves.
  A JDBC staging table is replaced in one transaction (``database``).
* Document bundles: each bundle is one text file ``<DOCS>`` .. ``</DOCS>``.
  ``write_partition_bundles`` and ``write_sized_bundles`` (used by the export job)
  write documents that already lie in their bundle's partition, one file a bundle or
  files of bounded size; windows over a bundle's order put header and footer on its
  first and last document: no shuffle of the documents, and no Python but for writing
  the small files of bounded size into a mounted folder.
  ``write_bundles`` is the general form for documents that come from
  elsewhere: curves hashed into ``n`` bundles, header and footer rows per
  bundle that has documents, one repartition by bundle, and a sort within
  partitions ordering header, documents, footer.
* Status: a new snapshot of the rules table with the transition applied,
  written to a fresh path (a table cannot be overwritten while it is read), or an
  update of the load sets that still have status 1 in a JDBC rules table.
  Write staging first and status last: a crash in between leaves status 1
  and the run is simply repeated.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from namewright.functions.xml import BUNDLE_CLOSE, BUNDLE_OPEN
from namewright.sinks import database
from namewright.sources.jdbc import split_spec

STAGING_COLUMNS = ["curve_id", "curve_name", "short_curve_name", "curve_description",
                   "load_set_id", "is_valid"]
STAGING_KEY = ["load_set_id", "curve_id"]
STATUS_READY, STATUS_DONE, STATUS_FAILED = 1, 2, -1


# ---------------------------------------------------------------------------
# co-located catalogue tables (SRC3)
# ---------------------------------------------------------------------------
def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A catalog table in ``buckets`` files by the hash of ``key``, sorted by it inside.

    Metadata by object_id and members and names by curve_id, with one number of buckets, are read back already
    clustered: the membership join, the numbering and the aggregates per curve then need no shuffle (the dictionary must be
    small enough to broadcast).  A run over them is ``spark.table(..)`` in place of a path.  Rows are first dealt out by
    the buckets' own hash, so each bucket is one file.  One object's rows stay together: a bucket is as large as its largest objects."""
    writer = df.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


# ---------------------------------------------------------------------------
# SNK1 / SNK2: staging
# ---------------------------------------------------------------------------
def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def clear_partitions(spark: SparkSession, path: str, column: str, values) -> None:
    """Remove ``path/column=value`` directories (used for processed load sets
    whose result is empty)."""
    fs, _root, jvm = _hadoop_fs(spark, path)
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={v}")
        if fs.exists(p):
            fs.delete(p, True)


def write_staging(staged: DataFrame, path: str, processed_load_sets=None, present=None) -> None:
    """SNK1: replace the staging rows of the processed load sets.

    Dynamic partition overwrite replaces the load sets that have rows, each as a
    whole, and leaves every other one untouched; ``REBALANCE`` gives a load set
    few files, and AQE splits a large one.  A failure leaves the table as it
    was.  ``processed_load_sets`` that turn out to have no rows are cleared
    afterwards; ``present`` names those with rows when the caller knows them."""
    spark = staged.sparkSession
    (staged.select(*STAGING_COLUMNS).hint("rebalance", "load_set_id")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("load_set_id")
     .parquet(path))
    if processed_load_sets:
        if present is None:
            present = [r[0] for r in staged.select("load_set_id").distinct().collect()]
        clear_partitions(spark, path, "load_set_id", sorted(set(processed_load_sets) - set(present)))


def write_staging_jdbc(staged: DataFrame, url: str, table: str, props: dict | None = None, batchsize: int = 1000,
                       processed_load_sets=None, quote: str = '"', expected: Callable[[], int] | None = None) -> None:
    """SNK2: replace the processed load sets' rows over JDBC, through a side table and one transaction, so that a
    failed run leaves the old rows (``database.replace_rows``).  Without ``processed_load_sets`` rows are only appended."""
    rows = staged.select(*STAGING_COLUMNS)
    if processed_load_sets:
        database.replace_rows(rows, url, table, processed_load_sets, STAGING_KEY, props, batchsize, quote, expected)
    else:
        rows.write.jdbc(url, table, mode="append", properties={"batchsize": str(batchsize), **(props or {})})


# ---------------------------------------------------------------------------
# UNI1 / SNK3 / SNK4: documents
# ---------------------------------------------------------------------------
def with_bundle(docs: DataFrame, n: int) -> DataFrame:
    return docs.withColumn("bundle", F.pmod("curve_id", F.lit(n)).cast("int"))


def bundle_lines(docs: DataFrame, n: int) -> DataFrame:
    """UNI1: (bundle, seq, curve_id, value) with a ``<DOCS>`` header (seq 0)
    and ``</DOCS>`` footer (seq 2) for every bundle holding documents."""
    b = with_bundle(docs, n)
    body = b.select("bundle", F.lit(1).alias("seq"), "curve_id", F.col("doc").alias("value"))
    present = b.groupBy("bundle").agg(F.count(F.lit(1)).alias("_n"))
    head = present.select("bundle", F.lit(0).alias("seq"), F.lit(None).cast("long").alias("curve_id"),
                          F.lit(BUNDLE_OPEN).alias("value"))
    foot = present.select("bundle", F.lit(2).alias("seq"), F.lit(None).cast("long").alias("curve_id"),
                          F.lit(BUNDLE_CLOSE).alias("value"))
    return head.unionByName(body).unionByName(foot)


def write_bundles(docs: DataFrame, path: str, n: int) -> None:
    """SNK3: one text file per bundle under ``path/bundle=K/``, ordered
    header, documents by curve id (then text), footer."""
    lines = bundle_lines(docs, n)
    (lines.repartition(n, "bundle")
     .sortWithinPartitions("bundle", "seq", "curve_id", "value")
     .select("bundle", "value")
     .write.mode("overwrite").partitionBy("bundle").text(path))


def framed(docs: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """UNI1 in the JVM: (bundle, part, value) of documents (bundle, curve_id, doc), in the order of a bundle's curve ids.

    A bundle is cut into parts wherever the bytes before a document reach a further ``max_bytes`` (never without it), so a part
    is at most that and one document long.  The first document of a part carries ``<DOCS>`` before it, the last ``</DOCS>`` after it."""
    by_curve = Window.partitionBy("bundle").orderBy("curve_id", "doc")
    before = F.coalesce(F.sum(F.octet_length("doc") + F.lit(1)).over(by_curve.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = F.floor(before / F.lit(max_bytes)).cast("int") if max_bytes else F.lit(0)
    cut = docs.select("bundle", "curve_id", "doc", part.alias("part"))
    cut = cut.select("*", F.lag("part").over(by_curve).alias("_last"), F.lead("part").over(by_curve).alias("_next"))
    value = F.concat(F.when(F.col("_last").eqNullSafe(F.col("part")), F.lit("")).otherwise(F.lit(BUNDLE_OPEN + "\n")), F.col("doc"),
                     F.when(F.col("_next").eqNullSafe(F.col("part")), F.lit("")).otherwise(F.lit("\n" + BUNDLE_CLOSE)))
    return cut.select("bundle", "part", "curve_id", value.alias("value"))


def write_partition_bundles(docs: DataFrame, path: str) -> None:
    """SNK3: every partition of documents (bundle, curve_id, doc) becomes one text file ``<DOCS>`` .. ``</DOCS>``, ordered by curve
    id, with partition k holding bundle k (``docs.bundled_docs``).  The documents are neither shuffled nor seen by Python."""
    framed(docs).select("value").write.mode("overwrite").text(path)


def write_sized_bundles(docs: DataFrame, path: str, max_bytes: int) -> None:
    """SNK3 with files of bounded size: ``path/bundle=K/part=J/``, each file at most ``max_bytes`` and one document long.  A bundle
    that turns out larger than others gives more files, not a larger one.

    On a file system that is mounted as a folder the tasks write the files themselves (``_write_files``): Hadoop's local file
    system starts processes for every file and folder it makes, which takes longer than the documents where files are small."""
    lines = (framed(docs, max_bytes).sortWithinPartitions("bundle", "part", "curve_id", "value")
             .select("bundle", "part", "value"))
    fs, p, _jvm = _hadoop_fs(docs.sparkSession, path)
    full = fs.makeQualified(p).toUri()
    if full.getScheme() == "file":
        _write_files(lines, full.getPath())
    else:
        lines.write.mode("overwrite").partitionBy("bundle", "part").text(path)


def _write_files(lines: DataFrame, folder: str) -> None:
    """Lines (bundle, part, value), which come bundle by bundle and part by part, into ``folder/bundle=K/part=J/``, replacing what is there.

    A task attempt writes below a folder of its own, which the readers do not see; of the attempts that succeeded the bundles
    are moved to their place, one move each, when all tasks are done."""
    fs, place, jvm = _hadoop_fs(lines.sparkSession, f"file:{folder}")
    pending = f"{folder}/_temporary/{uuid.uuid4().hex}"

    def run(batches):
        own = f"{pending}/{TaskContext.get().taskAttemptId()}"
        at, out, bundles = None, None, {}
        try:
            for batch in batches:
                for bundle, part, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (bundle, part) != at:
                        if out:
                            out.close()
                        at, bundles[bundle] = (bundle, part), own
                        os.makedirs(f"{own}/bundle={bundle}/part={part}")
                        out = open(f"{own}/bundle={bundle}/part={part}/part-00000.txt", "wb")
                    out.write((value or b"") + b"\n")
        finally:
            if out:
                out.close()
        yield pa.RecordBatch.from_pydict({"bundle": pa.array([*bundles], pa.int32()), "own": pa.array([*bundles.values()], pa.string())})

    fs.delete(place, True)
    try:
        written = lines.select("bundle", "part", F.col("value").cast("binary")).mapInArrow(run, "bundle int, own string").collect()
        os.makedirs(folder, exist_ok=True)
        for row in written:  # one row a bundle
            os.rename(f"{row['own']}/bundle={row['bundle']}", f"{folder}/bundle={row['bundle']}")
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{folder}/_temporary"), True)
    open(f"{folder}/_SUCCESS", "wb").close()


LISTING_TASKS = 32    # Spark's own bound is 10,000: a task for each of a bundle's folders


def read_sized_bundles(spark: SparkSession, path: str) -> DataFrame:
    """The lines (value, bundle, part) of ``write_sized_bundles``.  Its many small folders are listed by a few tasks."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(LISTING_TASKS))
    try:
        return spark.read.text(path)
    finally:
        spark.conf.set(key, before)


def write_keyed_docs(docs: DataFrame, path: str) -> None:
    """SNK4: (curve_id, doc) pairs as parquet."""
    docs.select("curve_id", "doc").write.mode("overwrite").parquet(path)


# ---------------------------------------------------------------------------
# SNK5: status
# ---------------------------------------------------------------------------
def transition_status(rules: DataFrame, outcomes) -> DataFrame:
    """SNK5: status 1 becomes 2 where the run succeeded and -1 where it failed;
    other states and load sets without an outcome stay as they are.

    ``outcomes``: a dict {load_set_id: succeeded} (the run's own result, known
    on the driver: a single projection, no join), or a DataFrame
    (load_set_id, succeeded) for outcomes computed elsewhere."""
    st = F.col("curvename_status_id")
    ready = st == F.lit(STATUS_READY)
    if isinstance(outcomes, dict):
        ok = sorted(k for k, v in outcomes.items() if v)
        bad = sorted(k for k, v in outcomes.items() if not v)
        ids = F.col("load_set_id")
        new = (F.when(ready & ids.isin(ok), F.lit(STATUS_DONE))
               .when(ready & ids.isin(bad), F.lit(STATUS_FAILED))
               .otherwise(st))
        return rules.withColumn("curvename_status_id", new.cast("int"))
    o = outcomes.select(F.col("load_set_id").cast("int").alias("load_set_id"),
                        F.col("succeeded").alias("_ok"))
    j = rules.join(o, "load_set_id", "left")
    new = (F.when(ready & (F.col("_ok") == F.lit(True)), F.lit(STATUS_DONE))
           .when(ready & (F.col("_ok") == F.lit(False)), F.lit(STATUS_FAILED))
           .otherwise(st))
    return j.withColumn("curvename_status_id", new.cast("int")).drop("_ok").select(*rules.columns)


def write_status(rules: DataFrame, outcomes: dict, target: str, props: dict | None = None, quote: str = '"') -> None:
    """The run's outcomes, to a fresh snapshot path or into a JDBC rules table (``jdbc:<url>#<table>``, moved in place)."""
    if target.startswith("jdbc:"):
        url, table = split_spec(target)
        database.move_status(rules.sparkSession, url, table, outcomes, STATUS_READY, STATUS_DONE, STATUS_FAILED, props, quote)
    else:
        write_status_snapshot(transition_status(rules, outcomes), target)


def write_status_snapshot(rules_after: DataFrame, path: str) -> None:
    rules_after.write.mode("overwrite").parquet(path)
