"""Plans and skew: runtime filter of a load set's curves, bounded attribute texts, two-level numbering, co-located tables, bundles."""

import glob
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from namewright.operators import attrs as A
from namewright.operators import docs as D
from namewright.plans import jobs
from namewright.sinks import writers

from .conftest import meta_row

ENTRIES = "load_set_id int, curve_id long, key string, fullname string, shortname string, abbr string"


def executed(df):
    """The nodes of the plan as it ran."""
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            out.append(node)
            todo += [node.children().apply(k) for k in range(node.children().size())]
    return out


def shuffled_rows(df):
    return sum(n.metrics().apply("shuffleRecordsWritten").value() for n in executed(df) if n.getClass().getSimpleName() == "ShuffleExchangeExec")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- JN1, JN3: one load set of many ----------------------------------------------------------


@pytest.fixture
def unbroadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_filter_keeps_every_member_and_few_others(spark):
    meta = spark.range(100_000).selectExpr("id - 50000 AS object_id", "'v' AS attribute")
    members = spark.range(0, 50_000, 50).selectExpr("id - 25000 AS curve_id")
    for bits, most in ((24, 1100), (16, 4000), (6, 100_000)):
        kept = A.maybe_members(meta, members, bits)
        assert kept.columns == meta.columns
        assert kept.join(members, F.col("object_id") == F.col("curve_id")).count() == 1000 <= kept.count() <= most
    assert A.maybe_members(meta, members.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "a"), (1, "b")], "object_id long, attribute string")
    assert [r.object_id for r in A.maybe_members(odd, spark.createDataFrame([(1,), (None,)], "curve_id long")).where("object_id is not null").collect()] == [1]


def test_one_load_set_shuffles_its_own_rows(spark, tables, unbroadcast):
    """40 load sets of 25 curves with 6 rows each: a run over one set moves that set's rows, not the catalogue's."""
    meta = [meta_row(c, a, "is", f"{a}{c}", eid=c % 50) for c in range(1000) for a in "PQRSTU"]
    rule = "concat(curve['P.is'].fullname, curve['Q.is'].fullname, curve['R.is'].fullname, curve['S.is'].fullname, curve['T.is'].fullname, curve['U.is'].fullname)"
    t = tables(meta, [(c % 40, c) for c in range(1000)], [(k, rule, rule, rule, 1) for k in range(40)], dictionary=[(e, f"a{e}") for e in range(50)])
    args = [t[k] for k in ("meta", "members", "dict", "rules")]
    every = jobs.stage(*args)
    assert shuffled_rows(every.flags) > 6000
    one = jobs.stage(*args, load_set_ids=[7])
    # 25 curves: 150 rows by element and by key, ids of the filter, members, curves; the dictionary's 50 rows
    assert shuffled_rows(one.flags) < 1000
    want = sorted(map(tuple, every.staged.where("load_set_id = 7").collect()))
    assert sorted(map(tuple, one.staged.collect())) == want and len(want) == 25


def test_export_of_one_load_set_filters_before_its_shuffle(spark, tables, unbroadcast):
    meta = [meta_row(c, "Provider", "is", f"p{c}") for c in range(2000)]
    t = tables(meta, [(c % 100, c) for c in range(2000)], [], names=[(c % 100, c, "n", "s", "d") for c in range(2000)])
    docs = jobs.build_docs(t["meta"], t["members"], t["names"], load_set_id=3)
    assert shuffled_rows(docs) < 400 and docs.count() == 20


# -- AGG2: bounded prefix --------------------------------------------------------------------


@pytest.mark.parametrize("cut", [1, 37, 38, 39, 40, 80, 81, 200, 777, 5000])
def test_cut_texts_equal_whole_texts_cut(spark, cut):
    random.seed(cut)
    rows = [(c % 3, c, random.choice(["", ".", "A.is", "B.in"]), "n" * random.choice([0, 1, 30, 900]), "", random.choice([" ", "x"])) for c in range(30) for _ in range(random.randint(1, 25))]
    ent = spark.createDataFrame(rows, ENTRIES)
    whole = {r.curve_id: r.attr for r in A.attr_string(ent).collect()}
    got = {r.curve_id: (r.attr, r.truncated) for r in A.attr_string(ent, max_chars=cut).collect()}
    assert got == {c: (t[:cut], len(t) > cut) for c, t in whole.items()}


def test_a_huge_curve_is_cut_before_the_shuffle(spark):
    ent = spark.range(0, 300_000, 1, 8).selectExpr("1 AS load_set_id", "IF(id < 299000, 7L, id) AS curve_id", "concat('k', id % 1000) AS key", "concat('name ', id) AS fullname", "'' AS shortname", "' ' AS abbr")
    cut = A.attr_string(ent, max_chars=4000)
    assert "WindowGroupLimit" in plan_text(cut)
    # a few entries per map task of the huge curve, the small curves' rows, and a sum per curve and task
    assert shuffled_rows(cut) < 8 * 110 + 3 * 1100
    row = cut.where("curve_id = 7").first()
    assert len(row.attr) == 4000 and row.truncated


# -- ORD1: two-level numbering ---------------------------------------------------------------


def plain_numbers(rows):
    """Numbered keys by definition: order inside a key, then one row per final key, literal keys first."""
    by_key = {}
    for r in sorted(rows, key=lambda r: r[3:]):
        by_key.setdefault(r[:3], []).append(r)
    final = {}
    for (ls, c, key), some in by_key.items():
        for n, r in enumerate(some):
            name = (ls, c, key if n == 0 else f"{key}{n}")
            if name not in final or (n, r[3:]) < final[name]:
                final[name] = (n, r[3:])
    return sorted((*name, *v[1]) for name, v in final.items())


@pytest.mark.parametrize("partitions", ["2", "13"])
def test_ranges_number_as_one_task_would(spark, partitions):
    random.seed(3)
    rows = [(random.randint(0, 1), random.choice([1, 1, 1, 2, 3]), random.choice(["K.is", "K.is", "K.is1", "G.in", "K.is12"]), random.choice("abc") * random.randint(0, 3), random.choice(["", "s"]), " ") for _ in range(800)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = A.number_repeats(spark.createDataFrame(rows, ENTRIES)).select("load_set_id", "curve_id", "final_key", "fullname", "shortname", "abbr")
        assert sorted(map(tuple, got.collect())) == plain_numbers(rows)
        assert A.number_repeats(spark.createDataFrame([], ENTRIES)).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_key_of_one_curve_is_numbered_by_many_tasks(spark):
    ent = spark.range(0, 40_000, 1, 4).selectExpr("1 AS load_set_id", "7L AS curve_id", "'K.is' AS key", "lpad(CAST(id AS STRING), 9, '0') AS fullname", "'' AS shortname", "' ' AS abbr")
    got = A.number_repeats(ent)
    assert got.where("final_key <> IF(CAST(fullname AS INT) = 0, 'K.is', concat('K.is', CAST(fullname AS INT)))").count() == 0 and got.count() == 40_000
    text = plan_text(got)
    windows = [line for line in text.splitlines() if " Window [" in line]
    assert len(windows) >= 2 and not any("[load_set_id" in w and w.rstrip().endswith("curve_id#0L]") for w in windows)
    ranges = [r["count"] for r in A._numbered_by_ranges(ent, "key", "final_key").groupBy(F.spark_partition_id()).count().collect()]
    assert max(ranges) < 40_000


# -- SRC3: tables stored by curve ------------------------------------------------------------


def test_colocated_tables_need_no_shuffle_for_the_membership(spark, tables, unbroadcast):
    meta = [meta_row(c, a, "is", f"{a}{c}", eid=c % 5) for c in range(300) for a in "PQ"]
    rule = "concat(curve['P.is'].fullname, curve['Q.is'].abbr)"
    t = tables(meta, [(c % 3, c) for c in range(300)], [(k, rule, rule, rule, 1) for k in range(3)], dictionary=[(e, f"a{e}") for e in range(5)])
    out = tempfile.mkdtemp(prefix="bucketed-", dir="/tmp")
    for name, key in (("meta", "object_id"), ("members", "curve_id")):
        writers.write_bucketed(t[name], f"by_curve_{name}", key, 8, f"{out}/{name}")
    stored = jobs.stage(spark.table("by_curve_meta"), spark.table("by_curve_members"), F.broadcast(t["dict"]), t["rules"])
    nodes = executed(stored.flags)
    # what is shuffled are results per curve, above the membership join: nothing by object or element
    dealt = [n.outputPartitioning().toString() for n in nodes if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    assert all(d.startswith("hashpartitioning(load_set_id") for d in dealt), dealt
    joins = [n.simpleString(200) for n in nodes if n.getClass().getSimpleName() == "SortMergeJoinExec"]
    assert sum("object_id" in j and "curve_id" in j for j in joins) == 2, joins
    plain = jobs.stage(*[t[k] for k in ("meta", "members", "dict", "rules")])
    assert sorted(map(tuple, stored.staged.collect())) == sorted(map(tuple, plain.staged.collect()))
    for name in ("meta", "members"):
        spark.sql(f"DROP TABLE by_curve_{name}")


# -- SNK3: bundles ---------------------------------------------------------------------------


@pytest.fixture
def catalogue(tables):
    meta = [meta_row(c * 1000, "Provider", "is", "p" * (c % 40)) for c in range(-100, 200)]
    meta += [meta_row(c * 1000, "Geography", "in", f"G{k}", ric="r") for c in range(0, 200, 5) for k in range(3)] + [meta_row(9, "Color", "is", "not exported"), meta_row(8, "Provider", "is", "x", typ=2)]
    names = [(1, c * 1000, f"n{c}", None, "d") for c in range(0, 200, 2)] + [(2, 4000, "second", "s", "d"), (1, 77, "no metadata", "s", "d")]
    return tables(meta, [(1, c * 1000) for c in range(0, 100)], [], names=names)


@pytest.mark.parametrize("scope", ["all", 1])
@pytest.mark.parametrize("mode", ["reference", "clean"])
def test_bundled_documents_equal_joined_ones(catalogue, scope, mode):
    t = catalogue
    got = D.bundled_docs(t["meta"], t["members"], t["names"], 7, scope, mode)
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(map(tuple, jobs.build_docs(t["meta"], t["members"], t["names"], scope, mode).collect()))
    placed = got.select("bundle", F.spark_partition_id().alias("p")).distinct().collect()
    assert all(r.bundle == r.p for r in placed)


def test_export_has_one_shuffle_and_no_python(catalogue):
    t = catalogue
    lines = writers.framed(D.bundled_docs(t["meta"], t["members"], t["names"], 7), 1000)
    text = plan_text(lines)
    assert text.count("Exchange") == 1 and "Python" not in text and "Arrow" not in text, text
    sizes = [r["count"] for r in lines.groupBy("bundle").count().collect()]
    assert len(sizes) == 7 and max(sizes) < 2 * min(sizes)   # ids that are multiples of 1000 spread evenly


@pytest.mark.parametrize("size", [None, 1, 700, 10**9])
def test_bundle_files_are_framed_and_bounded(spark, catalogue, size):
    t = catalogue
    out = tempfile.mkdtemp(prefix="sized-", dir="/tmp")
    jobs.run_export(t["meta"], t["members"], t["names"], f"{out}/d", 4, bundle_bytes=size)
    files = [f for f in glob.glob(f"{out}/d/**/part-*", recursive=True) if os.path.isfile(f) and os.path.getsize(f)]
    want = sorted(r.doc for r in jobs.build_docs(t["meta"], t["members"], t["names"]).collect())
    seen, ids = [], []
    for f in sorted(files):
        lines = open(f).read().splitlines()
        assert lines[0] == "<DOCS>" and lines[-1] == "</DOCS>" and not {"<DOCS>", "</DOCS>"} & set(lines[1:-1])
        own = [int(x.split("id=")[1].split(" ")[0]) for x in lines[1:-1]]
        assert own == sorted(own)
        seen, ids = seen + lines[1:-1], [*ids, own]
        if size:
            assert sum(len(x.encode()) + 1 for x in lines[1:-2]) <= size or len(own) == 1
    assert sorted(seen) == want
    assert len(files) == (4 if size in (None, 10**9) else len(want) if size == 1 else len(files))


def test_many_small_files_are_listed_by_few_tasks(spark, catalogue):
    t, context = catalogue, spark.sparkContext
    out = tempfile.mkdtemp(prefix="sized-", dir="/tmp")
    jobs.run_export(t["meta"], t["members"], t["names"], f"{out}/d", 1, bundle_bytes=1)
    assert len(glob.glob(f"{out}/d/bundle=0/part=*")) > 2 * writers.LISTING_TASKS and os.path.exists(f"{out}/d/_SUCCESS")
    assert not glob.glob(f"{out}/d/_temporary")
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    context.setJobGroup("listing", "")
    try:
        lines = writers.read_sized_bundles(spark, f"{out}/d")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages) <= writers.LISTING_TASKS
    assert spark.conf.get(key) == before
    # a second export replaces the files of the first
    jobs.run_export(t["meta"], t["members"], t["names"], f"{out}/d", 1, bundle_bytes=10**9)
    assert [os.path.basename(f) for f in glob.glob(f"{out}/d/bundle=0/*")] == ["part=0"] and lines.columns == ["value", "bundle", "part"]


def test_a_failed_export_leaves_no_part_of_itself(spark):
    out = tempfile.mkdtemp(prefix="sized-", dir="/tmp")
    docs = spark.range(40).selectExpr("0 AS bundle", "id AS curve_id", "CASE WHEN id = 30 THEN raise_error('bad') ELSE 'x' END AS doc")
    with pytest.raises(Exception, match="bad"):
        writers.write_sized_bundles(docs, f"{out}/d", 1)
    assert not glob.glob(f"{out}/d/**/part-*", recursive=True) and not os.path.exists(f"{out}/d/_SUCCESS")
