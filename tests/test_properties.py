"""Properties: staging equals a brute-force model on random small catalogues;
invariants of the staged output on the driver's data."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from namewright.plans import jobs
from namewright.sources import fixture_views as fv

from .conftest import meta_row

LONG = "concat(curve['A.is'].fullname, '-', curve['A.is1'].fullname)"
SHORT = "curve['B.of'].shortname"
DESC = "concat_ws('/', curve['A.is'].abbr, var['Bof'].fullname)"


def brute_force(meta, members, abbr_of):
    """Plain-Python statement of the staging semantics for the three rules above."""
    out = {}
    by_curve = defaultdict(list)
    for obj, _typ, attr, verb, _ric, eid, elem, name in meta:
        by_curve[obj] += [(f"{attr or ''}.{verb or ''}", name or "", elem or "", abbr or " ")
                          for abbr in abbr_of.get(eid, [None])]
    for ls, cid in members:
        if cid not in by_curve:
            continue
        ents = sorted(by_curve[cid])
        curve, var = {}, {}
        for target, keyf in ((curve, lambda k: k), (var, lambda k: k.replace(".", "").replace('"', "").replace(":", ""))):
            cand = []
            seen = defaultdict(int)
            for k, f, s, a in sorted(ents, key=lambda e: (keyf(e[0]), e[1], e[2], e[3])):
                n = seen[keyf(k)]
                seen[keyf(k)] += 1
                cand.append((keyf(k) + (str(n) if n else ""), n, (f, s, a)))
            for fk, n, val in sorted(cand, key=lambda c: (c[0], c[1], c[2])):
                target.setdefault(fk, val)
        a0, a1, b = curve.get("A.is"), curve.get("A.is1"), curve.get("B.of")
        long_v = f"{a0[0]}-{a1[0]}" if a0 and a1 else None
        short_v = b[1] if b else None
        parts = [x for x in ((a0[2] if a0 else None), (var["Bof"][0] if "Bof" in var else None)) if x is not None]
        desc_v = "/".join(parts)
        out[(ls, cid)] = [long_v, short_v, desc_v]
    # limits, messages, duplicates
    rows = {}
    for (ls, cid), (lv, sv, dv) in out.items():
        res = []
        for kind, v, lim in (("long curve name", lv, 64), ("short curve name", sv, 32)):
            head = f"Failed to generate {kind} for the curve:{cid}"
            if v is None:
                res.append((False, head + " because of exception:rule returned no value"))
            elif len(v) > lim:
                res.append((False, head + f" because its result name {v} is longer than {lim} characters"))
            else:
                res.append((True, v))
        rows[(ls, cid)] = [res[0], res[1], dv]
    for i, kind in ((0, "long curve name"), (1, "short curve name")):
        owner = {}
        for (ls, cid) in sorted(rows, key=lambda k: k[1]):
            ok, text = rows[(ls, cid)][i]
            if ok:
                owner.setdefault((ls, text), cid)
        for (ls, cid), r in rows.items():
            ok, text = r[i]
            if ok and owner[(ls, text)] != cid:
                r[i] = (False, f"Failed to generate {kind} for the curve:{cid} because its result name "
                               f"is same as curve:{owner[(ls, text)]}")
    return {k: (r[0][1][:4000], r[1][1][:4000], r[2][:4000], "Y" if r[0][0] and r[1][0] else "N")
            for k, r in rows.items()}


names = st.sampled_from(["", "x", "y", "xy", "Z", "a b", "q" * 40])
entry = st.tuples(st.integers(1, 6), st.sampled_from([("A", "is"), ("B", "of"), ("A", "is1"), ("C", "is")]),
                  names, names, st.sampled_from([None, 1, 2, 3]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(entry, min_size=1, max_size=25), st.lists(st.tuples(st.integers(1, 2), st.integers(1, 6)),
                                                          min_size=1, max_size=10, unique=True))
def test_staging_matches_brute_force(tables, ents, members):
    meta = [meta_row(c, a, v, n, short=s, eid=e) for c, (a, v), n, s, e in ents]
    dictionary = [(1, "d1"), (1, "d0"), (2, None), (2, "x"), (3, "")]
    rules = [(ls, LONG, SHORT, DESC, 1) for ls in (1, 2)]
    t = tables(meta, members, rules, dictionary=dictionary)
    got = {(r["load_set_id"], r["curve_id"]): (r["curve_name"], r["short_curve_name"],
                                                r["curve_description"], r["is_valid"])
           for r in jobs.stage_names(t["meta"], t["members"], t["dict"], t["rules"]).collect()}
    want = brute_force(meta, members, {1: ["d1", "d0"], 2: [None, "x"], 3: [None]})
    assert got == want
    # the same with full maps
    run = jobs.stage(t["meta"], t["members"], t["dict"], t["rules"], restrict_keys=False)
    full = {(r["load_set_id"], r["curve_id"]): (r["curve_name"], r["short_curve_name"],
                                                 r["curve_description"], r["is_valid"])
            for r in run.staged.collect()}
    assert full == want


def test_invariants_on_driver_data(spark):
    v = fv.all_views(spark, "/root/testdata/sf0.001")
    run = jobs.stage(v["object_meta"], v["load_set_curve"], v["curve_dict"], v["curve_rule"])
    rows = run.checked.collect()
    owners = defaultdict(list)
    for r in rows:
        if r["long_ok"]:
            owners[(r["load_set_id"], r["long_text"])].append(r["curve_id"])
    assert all(len(c) == 1 for c in owners.values())            # one owner per valid name
    for r in run.staged.collect():
        if r["is_valid"] == "Y":
            assert len(r["curve_name"]) <= 64 and len(r["short_curve_name"]) <= 32
