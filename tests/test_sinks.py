"""Sinks: staging replace per load set, bundles, status, JDBC (in-process Derby)."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from namewright.plans import jobs
from namewright.sinks import database, writers

from .conftest import meta_row

RULE = ("curve['P.is'].fullname", "curve['P.is'].shortname", "curve['P.is'].fullname")


def _tables(tables, n=20, extra_sets=()):
    meta = [meta_row(c, "P", "is", f"p{c}", short=f"s{c}") for c in range(n)]
    members = [(1, c) for c in range(n)] + [(2, c) for c in range(n // 2)]
    rules = [(1,) + RULE + (1,), (2,) + RULE + (1,), (3, "", "x", "y", 1), (4,) + RULE + (2,)]
    return tables(meta, members, rules)


def test_staging_rerun_equals_one_run(spark, tables):
    t = _tables(tables)
    out = tempfile.mkdtemp(prefix="stage-", dir="/tmp")
    args = (t["meta"], t["members"], t["dict"], t["rules"], f"{out}/staging")
    run = jobs.run_staging(*args, f"{out}/status1")
    assert run.metrics == {"rows": 30, "valid_y": 30}
    once = sorted(map(tuple, spark.read.parquet(f"{out}/staging").collect()))
    jobs.run_staging(*args, f"{out}/status2")
    twice = sorted(map(tuple, spark.read.parquet(f"{out}/staging").collect()))
    assert once == twice and len(once) == 30
    status = {r["load_set_id"]: r["curvename_status_id"] for r in spark.read.parquet(f"{out}/status1").collect()}
    assert status == {1: 2, 2: 2, 3: -1, 4: 2}


def test_staging_replaces_only_processed_sets(spark, tables):
    t = _tables(tables)
    out = tempfile.mkdtemp(prefix="stage-", dir="/tmp")
    jobs.run_staging(t["meta"], t["members"], t["dict"], t["rules"], f"{out}/s", f"{out}/st1")
    # load set 2 loses all its members; only load set 2 is rerun
    t2 = _tables(tables)
    members = t2["members"].filter("load_set_id = 1")
    jobs.run_staging(t2["meta"], members, t2["dict"], t2["rules"], f"{out}/s", f"{out}/st2", load_set_ids=[2])
    rows = spark.read.parquet(f"{out}/s").collect()
    assert {r["load_set_id"] for r in rows} == {1}
    assert len(rows) == 20


def test_bundles(spark, tables):
    meta = [meta_row(c, "Provider", "is", f"p{c}") for c in range(50)]
    t = tables(meta, [], [], names=[(1, c, f"n{c}", "s", "d") for c in range(0, 50, 2)])
    docs = jobs.build_docs(t["meta"], None, t["names"])
    out = tempfile.mkdtemp(prefix="docs-", dir="/tmp")
    writers.write_bundles(docs, f"{out}/b", 4)
    seen = []
    files = [f for f in glob.glob(f"{out}/b/bundle=*/*") if not os.path.basename(f).startswith((".", "_"))]
    assert 1 <= len(files) <= 4
    for f in files:
        lines = open(f).read().splitlines()
        assert lines[0] == "<DOCS>" and lines[-1] == "</DOCS>"
        assert all(x.startswith("<DOC id=") for x in lines[1:-1])
        ids = [int(x.split("id=")[1].split(" ")[0]) for x in lines[1:-1]]
        assert ids == sorted(ids)
        seen += ids
    assert sorted(seen) == list(range(50))


def test_keyed_docs(spark, tables):
    t = tables([meta_row(1, "Provider", "is", "p")], [], [])
    out = tempfile.mkdtemp(prefix="kd-", dir="/tmp")
    writers.write_keyed_docs(jobs.build_docs(t["meta"], None, t["names"]), f"{out}/k")
    assert spark.read.parquet(f"{out}/k").count() == 1


def test_jdbc_round_trip(spark, tables):
    t = _tables(tables)
    staged = jobs.stage_names(t["meta"], t["members"], t["dict"], t["rules"], load_set_ids=[1])
    url = "jdbc:derby:memory:namewright;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    writers.write_staging_jdbc(staged, url, "STAGING", props)
    from namewright.sources.jdbc import read_jdbc
    back = read_jdbc(spark, url, "STAGING", props=props)
    assert back.count() == 20
    part = read_jdbc(spark, url, '(SELECT "curve_id", MOD("curve_id", 1000) AS PARTITION_ID FROM STAGING) q',
                     bucket_col="PARTITION_ID", n_parts=4, props=props)
    assert part.rdd.getNumPartitions() == 4 and part.count() == 20


def test_command_line(spark, tables):
    from namewright.__main__ import main
    t = _tables(tables)
    out = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    for name in ("meta", "members", "dict", "rules", "names"):
        t[name].write.parquet(f"{out}/in/{name}")
    code = main(["stage", "--meta", f"{out}/in/meta", "--members", f"{out}/in/members",
                 "--dictionary", f"{out}/in/dict", "--rules", f"{out}/in/rules",
                 "--staging", f"{out}/staging", "--status", f"{out}/status", "--load-sets", "1,2",
                 "--report", f"{out}/report"])
    assert code == 0
    assert spark.read.parquet(f"{out}/staging").count() == 30
    assert spark.read.parquet(f"{out}/report").count() == 2
    assert main(["export", "--meta", f"{out}/in/meta", "--members", f"{out}/in/members",
                 "--names", f"{out}/in/names", "--out", f"{out}/docs", "--bundles", "2"]) == 0
    assert spark.read.text(f"{out}/docs").count() == 20 + 2 * 2


def test_run_report(spark, tables):
    t = _tables(tables)
    rows = jobs.run_report(t["meta"], t["members"], t["dict"], t["rules"]).orderBy("load_set_id").collect()
    # load set 4 has rules but no members, so no curves and no report row
    assert [(r["load_set_id"], r["curves"], r["valid_y"]) for r in rows] == [(1, 20, 20), (2, 10, 10)]


DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_jobs_over_jdbc(spark, tables):
    """SRC1/SRC2/SNK2: both jobs from the command line over JDBC tables, range-partitioned, staging
    replaced by delete and append, give what the Parquet tables give."""
    from namewright.__main__ import main
    meta = [meta_row(c, "Provider", "is", f"p{c}") for c in range(30)]
    meta += [meta_row(c, "Geography", "in", f"g{c % 4}", ric=f"r{c}") for c in range(0, 30, 3)]
    names = [(1, c, f"n{c}", f"s{c}", None) for c in range(0, 30, 2)]
    rule = "curve['Provider.is'].fullname"
    t = tables(meta, [(1, c) for c in range(30)], [(1, rule, rule, rule, 1)], names=names)
    url = "jdbc:derby:memory:nwjobs;create=true"
    where = {"meta": "OBJECT_META", "members": "LOAD_SET_CURVE", "dict": "CURVE_DICT", "rules": "CURVE_RULE", "names": "CURVE_NAME"}
    for k, name in where.items():
        # the filtered text as VARCHAR: Spark's default for Derby is CLOB, which it can't compare
        types = {"createTableColumnTypes": "attribute VARCHAR(200)"} if k == "meta" else {}
        t[k].write.jdbc(url, name, mode="overwrite", properties={"driver": DERBY, **types})
    at = {k: f"{url}#{name}" for k, name in where.items()}
    out = tempfile.mkdtemp(prefix="jdbc-", dir="/tmp")
    jdbc = ["--jdbc-driver", DERBY, "--jdbc-parts", "4"]
    stage = ["stage", "--meta", at["meta"], "--members", at["members"], "--dictionary", at["dict"], "--rules", at["rules"]]
    assert main([*stage, "--staging", f"{out}/staging", "--status", f"{out}/s1", *jdbc]) == 0
    staged = spark.read.parquet(f"{out}/staging")
    assert staged.count() == 30
    staged.limit(0).write.jdbc(url, "STAGED", mode="overwrite", properties={"driver": DERBY})
    for _ in range(2):
        assert main([*stage, "--staging", f"{url}#STAGED", "--status", f"{out}/s2", *jdbc]) == 0
        assert spark.read.jdbc(url, "STAGED", properties={"driver": DERBY}).count() == 30
    assert main(["export", "--meta", at["meta"], "--members", at["members"], "--names", at["names"],
                 "--out", f"{out}/docs", "--bundles", "2", "--load-set", "1", *jdbc]) == 0
    direct = jobs.build_docs(t["meta"], t["members"], t["names"], load_set_id=1).collect()
    lines = [r[0] for r in spark.read.text(f"{out}/docs").collect()]
    assert sorted(x for x in lines if x not in ("<DOCS>", "</DOCS>")) == sorted(r["doc"] for r in direct)


def test_jdbc_staging_is_replaced(spark, tables):
    t = _tables(tables)
    url, props = "jdbc:derby:memory:nwreplace;create=true", {"driver": DERBY}
    staged = jobs.stage_names(t["meta"], t["members"], t["dict"], t["rules"])
    writers.write_staging_jdbc(staged.limit(0), url, "STAGING", props)
    for _ in range(2):
        writers.write_staging_jdbc(staged, url, "STAGING", props, processed_load_sets=[1, 2], quote='"')
        assert spark.read.jdbc(url, "STAGING", properties=props).count() == 30
    writers.write_staging_jdbc(staged.where("load_set_id = 2"), url, "STAGING", props, processed_load_sets=[2], quote='"')
    assert spark.read.jdbc(url, "STAGING", properties=props).count() == 30


def _staged_rows(spark, url, table="STAGING"):
    return sorted(map(tuple, spark.read.jdbc(url, table, properties={"driver": DERBY}).collect()))


def test_jdbc_staging_keeps_old_rows_when_a_task_fails(spark, tables):
    t = _tables(tables)
    url, props = "jdbc:derby:memory:nwfails;create=true", {"driver": DERBY}
    staged = jobs.stage_names(t["meta"], t["members"], t["dict"], t["rules"])
    writers.write_staging_jdbc(staged.limit(0), url, "STAGING", props)
    writers.write_staging_jdbc(staged, url, "STAGING", props, processed_load_sets=[1, 2])
    old = _staged_rows(spark, url)
    assert len(old) == 30
    broken = staged.repartition(4, "curve_id").withColumn("curve_name", F.expr("CASE WHEN curve_id = 7 THEN raise_error('lost') ELSE 'new' END"))
    with pytest.raises(Exception, match="lost"):
        writers.write_staging_jdbc(broken, url, "STAGING", props, processed_load_sets=[1, 2])
    assert _staged_rows(spark, url) == old
    assert spark.read.jdbc(url, "STAGING" + database.SIDE_SUFFIX, properties=props).count() == 0
    # rows that are missing when they are to be swapped in: nothing is changed either
    with pytest.raises(RuntimeError, match="not 31"):
        writers.write_staging_jdbc(staged, url, "STAGING", props, processed_load_sets=[1, 2], expected=lambda: 31)
    assert _staged_rows(spark, url) == old


def test_jdbc_staging_of_a_repeated_task_doubles_no_row(spark, tables):
    t = _tables(tables)
    url, props = "jdbc:derby:memory:nwrepeat;create=true", {"driver": DERBY}
    staged = jobs.stage_names(t["meta"], t["members"], t["dict"], t["rules"]).select(*writers.STAGING_COLUMNS)
    writers.write_staging_jdbc(staged.limit(0), url, "STAGING", props)
    side = database.ensure_side_table(spark, url, "STAGING", staged.columns, props)
    for rows in (staged, staged.where("curve_id < 5"), staged.where("curve_id between 3 and 9")):  # tasks that had committed run again
        database.append_rows(rows, url, side, "run", props)
    database.append_rows(staged.withColumn("curve_name", F.lit("of another run")), url, side, "other", props)
    put = database.swap_in(spark, url, "STAGING", side, "run", staged.columns, [1, 2], writers.STAGING_KEY, props, expected=30)
    assert put == 30 and _staged_rows(spark, url) == sorted(map(tuple, staged.collect()))
    assert {r[0] for r in spark.read.jdbc(url, side, properties=props).select(database.RUN_ID).collect()} == {"other"}
    # a load set that has no rows any more loses its old ones, others stay
    writers.write_staging_jdbc(staged.where("load_set_id = 3"), url, "STAGING", props, processed_load_sets=[2])
    assert {r[4] for r in _staged_rows(spark, url)} == {1}


def test_status_moves_in_a_jdbc_rules_table(spark, tables):
    """A run whose status goes to the rules table: 1 becomes 2 or -1, other states stay, and the next run sees it."""
    t = _tables(tables)
    url, props = "jdbc:derby:memory:nwstatus;create=true", {"driver": DERBY}
    t["rules"].write.jdbc(url, "CURVE_RULE", mode="overwrite", properties=props)
    rules = spark.read.jdbc(url, "CURVE_RULE", properties=props)
    out = tempfile.mkdtemp(prefix="stage-", dir="/tmp")
    args = (t["meta"], t["members"], t["dict"], rules, f"{out}/staging", f"{url}#CURVE_RULE")
    state = lambda: {r["load_set_id"]: r["curvename_status_id"] for r in rules.collect()}
    assert state() == {1: 1, 2: 1, 3: 1, 4: 2}
    broken = t["meta"].withColumn("element_name", F.expr("CASE WHEN object_id = 7 THEN raise_error('lost') ELSE 'new' END"))
    with pytest.raises(Exception, match="lost"):
        jobs.run_staging(broken, *args[1:], load_set_ids=[2], jdbc_props=props)
    assert state() == {1: 1, 2: -1, 3: 1, 4: 2}
    jobs.run_staging(*args, jdbc_props=props)
    assert state() == {1: 2, 2: -1, 3: -1, 4: 2}   # 2 was no longer ready


def test_failed_run_keeps_old_rows_and_sets_status(spark, tables):
    t = _tables(tables)
    out = tempfile.mkdtemp(prefix="stage-", dir="/tmp")
    args = (t["members"], t["dict"], t["rules"], f"{out}/staging")
    jobs.run_staging(t["meta"], *args, f"{out}/st1")
    once = sorted(map(tuple, spark.read.parquet(f"{out}/staging").collect()))
    broken = t["meta"].withColumn("element_name", F.expr("CASE WHEN object_id = 7 THEN raise_error('lost') ELSE 'new' END"))
    with pytest.raises(Exception, match="lost"):
        jobs.run_staging(broken, *args, f"{out}/st2")
    assert sorted(map(tuple, spark.read.parquet(f"{out}/staging").collect())) == once
    status = {r["load_set_id"]: r["curvename_status_id"] for r in spark.read.parquet(f"{out}/st2").collect()}
    assert status == {1: -1, 2: -1, 3: -1, 4: 2}


def test_export_one_file_per_partition(spark, tables):
    meta = [meta_row(c, "Provider", "is", f"p{c}") for c in range(60)]
    meta += [meta_row(c, "Geography", "in", "G", ric="r") for c in range(0, 60, 5)]
    t = tables(meta, [], [], names=[(1, c, f"n{c}", "s", "d") for c in range(0, 60, 2)])
    out = tempfile.mkdtemp(prefix="exp-", dir="/tmp")
    jobs.run_export(t["meta"], None, t["names"], f"{out}/d", 4)
    files = [f for f in glob.glob(f"{out}/d/part-*") if os.path.getsize(f) > 0]
    assert 1 <= len(files) <= 4
    seen = []
    for f in files:
        lines = open(f).read().splitlines()
        assert lines[0] == "<DOCS>" and lines[-1] == "</DOCS>"
        ids = [int(x.split("id=")[1].split(" ")[0]) for x in lines[1:-1]]
        assert ids == sorted(ids)
        seen += ids
    assert sorted(seen) == list(range(60))
    docs = jobs.build_docs(t["meta"], None, t["names"], bundles=4)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    # the metadata is clustered once (the aggregate's shuffle), the names once
    assert plan.count("Exchange hashpartitioning") <= 2, plan
