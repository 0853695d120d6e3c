"""Literal edge rows for name staging (length limits, duplicates, repeats,
load-set isolation, validity flag)."""

from namewright.operators import attrs as A
from namewright.plans import jobs

from .conftest import meta_row

LONG_RULE = "curve['P.is'].fullname"
SHORT_RULE = "curve['S.is'].fullname"
DESC_RULE = "curve['D.is'].fullname"


def run_stage(tables, meta, members, rules=None, **kw):
    rules = rules or [(1, LONG_RULE, SHORT_RULE, DESC_RULE, 1)]
    t = tables(meta, members, rules)
    run = jobs.stage(t["meta"], t["members"], t["dict"], t["rules"], **kw)
    staged = {(r["load_set_id"], r["curve_id"]): r for r in run.staged.collect()}
    checked = {(r["load_set_id"], r["curve_id"]): r for r in run.checked.collect()}
    return staged, checked


def test_fixture_edge_rows(tables):
    vals = {10: "a" * 64, 11: "b" * 65, 12: "dup", 13: "dup", 14: "Dup", 16: "", 17: "",
            18: "c" * 5000, 19: 'he said "hi"}, {x},'}
    meta = [meta_row(c, "P", "is", v) for c, v in vals.items()]
    meta += [meta_row(c, "S", "is", f"s{c}") for c in list(vals) + [15]]
    meta += [meta_row(15, "Q", "is", "other")]
    members = [(1, c) for c in list(vals) + [15]]
    staged, checked = run_stage(tables, meta, members)
    k = lambda c: (1, c)
    assert checked[k(10)]["long_ok"] and staged[k(10)]["curve_name"] == "a" * 64
    assert staged[k(11)]["curve_name"] == (
        "Failed to generate long curve name for the curve:11 because its result name "
        + "b" * 65 + " is longer than 64 characters")
    assert checked[k(12)]["long_ok"]
    assert staged[k(13)]["curve_name"] == (
        "Failed to generate long curve name for the curve:13 because its result name is same as curve:12")
    assert checked[k(14)]["long_ok"]                       # case-sensitive
    assert staged[k(15)]["curve_name"].startswith(
        "Failed to generate long curve name for the curve:15 because of exception:")
    assert checked[k(16)]["long_ok"] and staged[k(16)]["curve_name"] == ""
    assert staged[k(17)]["curve_name"].endswith("is same as curve:16")
    assert not checked[k(18)]["long_ok"] and len(staged[k(18)]["curve_name"]) == 4000
    assert checked[k(19)]["long_ok"] and staged[k(19)]["curve_name"] == vals[19]
    assert staged[k(10)]["is_valid"] == "Y" and staged[k(11)]["is_valid"] == "N"


def test_short_limit_32(tables):
    meta = [meta_row(1, "P", "is", "p1"), meta_row(1, "S", "is", "x" * 32),
            meta_row(2, "P", "is", "p2"), meta_row(2, "S", "is", "y" * 33)]
    staged, checked = run_stage(tables, meta, [(1, 1), (1, 2)])
    assert checked[(1, 1)]["short_ok"] and staged[(1, 1)]["is_valid"] == "Y"
    assert not checked[(1, 2)]["short_ok"] and staged[(1, 2)]["is_valid"] == "N"


def test_long_duplicate_still_owns_short(tables):
    meta = [meta_row(1, "P", "is", "same"), meta_row(1, "S", "is", "s1"),
            meta_row(2, "P", "is", "same"), meta_row(2, "S", "is", "s2"),
            meta_row(3, "P", "is", "p3"), meta_row(3, "S", "is", "s2")]
    staged, checked = run_stage(tables, meta, [(1, 1), (1, 2), (1, 3)])
    assert not checked[(1, 2)]["long_ok"] and checked[(1, 2)]["short_ok"]
    assert staged[(1, 3)]["short_curve_name"].endswith("is same as curve:2")


def test_failing_description_keeps_y(tables):
    meta = [meta_row(1, "P", "is", "p"), meta_row(1, "S", "is", "s")]
    staged, checked = run_stage(tables, meta, [(1, 1)])
    assert staged[(1, 1)]["is_valid"] == "Y"
    assert staged[(1, 1)]["curve_description"] == (
        "Failed to generate description for the curve:1 because of exception:rule returned no value")


def test_same_name_in_two_load_sets_is_no_duplicate(tables):
    meta = [meta_row(1, "P", "is", "n"), meta_row(1, "S", "is", "s"),
            meta_row(2, "P", "is", "n"), meta_row(2, "S", "is", "t")]
    rules = [(1, LONG_RULE, SHORT_RULE, DESC_RULE, 1), (2, LONG_RULE, SHORT_RULE, DESC_RULE, 1)]
    staged, checked = run_stage(tables, meta, [(1, 1), (2, 2)], rules)
    assert checked[(1, 1)]["long_ok"] and checked[(2, 2)]["long_ok"]


def test_repeats_numbered(spark, tables):
    meta = [meta_row(5, "G", "is", v) for v in ("z", "x", "y")]
    t = tables(meta, [(1, 5)], [])
    ent = A.entries(t["meta"], t["members"], t["dict"])
    rows = {(r["map_name"], r["map_key"]): r["fullname"] for r in A.numbered_keys(ent).collect()}
    assert rows == {("curve", "G.is"): "x", ("curve", "G.is1"): "y", ("curve", "G.is2"): "z",
                    ("var", "Gis"): "x", ("var", "Gis1"): "y", ("var", "Gis2"): "z"}


def test_literal_key_wins_over_numbered(spark, tables):
    meta = [meta_row(5, "K", "is", "a"), meta_row(5, "K", "is", "b"), meta_row(5, "K", "is1", "literal")]
    t = tables(meta, [(1, 5)], [])
    maps = A.attribute_maps(t["meta"], t["members"], t["dict"]).collect()[0]
    assert maps["curve"]["K.is"]["fullname"] == "a"
    assert maps["curve"]["K.is1"]["fullname"] == "literal"


def test_hot_name_many_curves(tables):
    # one name shared by most curves: owners come from a partial aggregate
    n = 3000
    meta = [meta_row(c, "P", "is", "hot" if c % 10 else f"n{c}") for c in range(1, n + 1)]
    meta += [meta_row(c, "S", "is", f"s{c}") for c in range(1, n + 1)]
    staged, checked = run_stage(tables, meta, [(1, c) for c in range(1, n + 1)])
    owners = [c for (ls, c), r in checked.items() if r["long_ok"] and r["long_text"] == "hot"]
    assert owners == [1]
    dups = sum(1 for r in checked.values() if r["long_reason"] == "duplicate")
    assert dups == n - n // 10 - 1


def test_repartitioning_does_not_change_result(tables):
    meta = [meta_row(c, "P", "is", f"p{c % 17}") for c in range(200)]
    meta += [meta_row(c, "S", "is", f"s{c % 5}") for c in range(200)]
    t = tables(meta, [(1, c) for c in range(200)], [(1, LONG_RULE, SHORT_RULE, DESC_RULE, 1)])
    a = jobs.stage_names(t["meta"], t["members"], t["dict"], t["rules"]).collect()
    b = jobs.stage_names(t["meta"].repartition(7), t["members"].repartition(3), t["dict"],
                         t["rules"]).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_attr_text_limit(tables):
    meta = [meta_row(1, "P", "is", "p" * 50), meta_row(1, "S", "is", "s"),
            meta_row(2, "P", "is", "q"), meta_row(2, "S", "is", "t")]
    staged, checked = run_stage(tables, meta, [(1, 1), (1, 2)], max_attr_chars=100)
    assert staged[(1, 1)]["curve_name"].startswith("Failed to generate curve name for the curve:1")
    assert staged[(1, 1)]["curve_description"].startswith("Failed to generate descripton for the curve:1")
    assert checked[(1, 2)]["long_ok"]


def test_only_needed_attributes_are_read(spark, tables):
    meta = [meta_row(1, "P", "is", "p"), meta_row(1, "S", "is", "s"), meta_row(1, "Z", "is", "z")]
    t = tables(meta, [(1, 1)], [(1, LONG_RULE, SHORT_RULE, DESC_RULE, 1)])
    run = jobs.stage(t["meta"], t["members"], t["dict"], t["rules"])
    plan = run.staged._jdf.queryExecution().optimizedPlan().toString()
    # the scan side is filtered to the attributes the rules can read
    assert "attribute" in plan and ("IN (D,P,S)" in plan or "INSET D, P, S" in plan), plan


def test_curve_with_many_repeats(tables):
    # one curve holds thousands of entries of one key; only G.in2 is read
    meta = [meta_row(1, "G", "in", f"g{i:05d}") for i in range(4000)] + [meta_row(1, "S", "is", "s")]
    meta += [meta_row(2, "G", "in", "solo"), meta_row(2, "S", "is", "t")]
    rules = [(1, "curve['G.in2'].fullname", "curve['S.is'].fullname", "curve['G.in3999'].fullname", 1)]
    staged, checked = run_stage(tables, meta, [(1, 1), (1, 2)], rules)
    assert staged[(1, 1)]["curve_name"] == "g00002"
    assert staged[(1, 1)]["curve_description"] == "g03999"
    assert not checked[(1, 2)]["long_ok"]


def test_repeated_membership_row_gives_one_curve(tables):
    meta = [meta_row(1, "P", "is", "p"), meta_row(1, "S", "is", "s")]
    t = tables(meta, [(1, 1), (1, 1)], [(1, LONG_RULE, SHORT_RULE, DESC_RULE, 1)])
    rows = jobs.stage_names(t["meta"], t["members"], t["dict"], t["rules"]).collect()
    assert [(r["load_set_id"], r["curve_id"]) for r in rows] == [(1, 1)]


def test_keys_collapsing_to_one_variable(spark, tables):
    # 'A.b' and 'Ab.' are different raw keys with the same variable name 'Ab'
    meta = [meta_row(5, "A", "b", "first"), meta_row(5, "Ab", "", "second")]
    t = tables(meta, [(1, 5)], [])
    maps = A.attribute_maps(t["meta"], t["members"], t["dict"]).collect()[0]
    assert {k: v["fullname"] for k, v in maps["curve"].items()} == {"A.b": "first", "Ab.": "second"}
    assert {k: v["fullname"] for k, v in maps["var"].items()} == {"Ab": "first", "Ab1": "second"}


def test_shared_names_have_one_owner_and_no_forced_broadcast(tables):
    n = 900
    meta = [meta_row(c, "P", "is", "hot" if c % 3 else f"n{c % 7}") for c in range(1, n + 1)]
    meta += [meta_row(c, "S", "is", "same" if c % 2 else f"s{c}") for c in range(1, n + 1)]
    t = tables(meta, [(1, c) for c in range(1, n + 1)], [(1, LONG_RULE, SHORT_RULE, DESC_RULE, 1)])
    run = jobs.stage(t["meta"], t["members"], t["dict"], t["rules"])
    rows = run.staged.collect()
    assert len([r for r in rows if r[1].endswith("is same as curve:1")]) == n - n // 3 - 1
    assert "ResolvedHint" not in run.staged._jdf.queryExecution().analyzed().toString()


def test_hot_curves_are_reduced_before_the_join(tables):
    # thousands of entries of one key, with ties, a literal clash and repeated dictionary ids
    meta = [meta_row(1, "G", "in", f"g{i % 50:03d}") for i in range(600)]
    meta += [meta_row(1, "G", "in1", "lit"), meta_row(1, "S", "is", "s1")]
    meta += [meta_row(2, "G", "in", f"h{i:03d}") for i in range(300)] + [meta_row(2, "S", "is", "s2")]
    meta += [meta_row(3, "G", "in", "only"), meta_row(3, "S", "is", "s3", eid=7)]
    members = [(1, 1), (1, 2), (1, 3), (2, 1)]
    rules = [(ls, "concat(curve['G.in'].fullname, '/', curve['G.in1'].fullname, '/', curve['G.in2'].fullname)",
              "concat(curve['S.is'].fullname, coalesce(curve['S.is1'].abbr, ''), coalesce(curve['S.is2'].abbr, '-'))",
              "var['Gin3'].fullname", 1) for ls in (1, 2)]
    t = tables(meta, members, rules, dictionary=[(7, "a"), (7, "b")])
    args = (t["meta"], t["members"], t["dict"], t["rules"])
    full = sorted(map(tuple, jobs.stage(*args, restrict_keys=False).staged.collect()))
    run = jobs.stage(*args)
    cut = sorted(map(tuple, run.staged.collect()))
    assert cut == full
    by = {(r[4], r[0]): r for r in cut}
    # var Gin3 is the 4th G.in entry (G.in1 normalises to Gin1): 12 copies of g000 come first
    assert by[(1, 1)][1] == "g000/lit/g000" and by[(1, 1)][3] == "g000"
    assert by[(1, 2)][1] == "h000/h001/h002" and by[(2, 1)][1] == "g000/lit/g000"
    assert by[(1, 3)][2] == "s3b-"
    # the reduction runs on the map side too
    assert "WindowGroupLimit" in run.staged._jdf.queryExecution().executedPlan().toString()


def test_names_of_supplementary_characters_count_twice(tables):
    meta = [meta_row(1, "P", "is", "\U0001f600" * 33), meta_row(1, "S", "is", "s" * 30),
            meta_row(2, "P", "is", "\u00e9" * 60), meta_row(2, "S", "is", "\U0001f600" * 16)]
    staged, checked = run_stage(tables, meta, [(1, 1), (1, 2)],
                                [(1, "curve['P.is'].fullname", "curve['S.is'].fullname", "curve['S.is'].fullname", 1)])
    assert checked[(1, 1)]["long_reason"] == "too_long" and checked[(1, 2)]["long_ok"] and checked[(1, 2)]["short_ok"]
