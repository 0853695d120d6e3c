import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from namewright.operators import patterns as P
from namewright.operators import rules as R
from namewright.plans import jobs

from .conftest import meta_row


@pytest.mark.parametrize("text", [
    "concat(curve['P.is'].fullname, ' ', var['Pis'].shortname)",
    "upper(coalesce(curve['P.is'].abbr, 'x'))",
    "CASE WHEN length(curve['P.is'].fullname) > 3 THEN 'long' ELSE 'short' END",
    "substring(curve['P.is'].fullname, -3, 2)",
    "curve['P.is'].fullname || '-' || curve['Q.of'].shortname",
])
def test_allowed(text):
    R.check_rule(text)


@pytest.mark.parametrize("text", [
    "reflect('java.lang.System', 'exit', 0)",
    "java_method('java.lang.Runtime', 'getRuntime')",
    "(SELECT 1)",
    "curve['P.is'].fullname / 0",
    "cast(curve['P.is'].fullname as int)",
    "split(curve['P.is'].fullname, ',')[3]",
    "rand()",
    "count(1)",
    "curve",
    "concat(curve['P.is'].fullname;",
    "",
])
def test_refused(text):
    with pytest.raises(R.RuleRefused):
        R.check_rule(text)


@pytest.mark.parametrize("text", [
    "curve['P.is'].fullname like curve['Q.is'].fullname",
    "case when curve['P.is'].fullname like 'a\\\\' then 'x' end",
    "lpad(curve['P.is'].fullname, 2000000000, 'x')",
    "rpad(curve['P.is'].fullname, length(curve['P.is'].fullname), 'x')",
    "split_part(curve['P.is'].fullname, '-', 0)",
    "regexp_replace(curve['P.is'].fullname, '(', 'x')",
    "regexp_replace(curve['P.is'].fullname, curve['P.is'].abbr, 'x')",
    "regexp_extract(curve['P.is'].fullname, '(a)', 2)",
    "try_to_number(curve['P.is'].fullname, curve['P.is'].abbr)",
    "map_keys(curve)",
    "size(var)",
])
def test_arguments_that_could_raise_are_refused(text):
    with pytest.raises(R.RuleRefused):
        R.check_rule(text)


@pytest.fixture(scope="module")
def probe(spark):
    from namewright.operators.attrs import MAP_TYPE
    rows = [(1, k, {"P.is": (v, v, v)}, {"Pis": (v, v, v)}) for k, v in enumerate(["abc", "", "12", "a\\", "1-2-3", "\u00e9\U0001f600", "9" * 50])]
    return spark.createDataFrame(rows + [(1, 99, {}, {})], f"load_set_id int, curve_id long, curve {MAP_TYPE}, var {MAP_TYPE}")


V = "curve['P.is'].fullname"
USES = {
    "concat": f"concat({V}, 'x')", "concat_ws": f"concat_ws('-', {V}, 'x')", "coalesce": f"coalesce({V}, 'x')", "nvl": f"nvl({V}, 'x')",
    "nvl2": f"nvl2({V}, 'a', 'b')", "ifnull": f"ifnull({V}, 'x')", "nullif": f"nullif({V}, 'x')", "if": f"if({V} = 'a', 'x', 'y')",
    "upper": f"upper({V})", "lower": f"lower({V})", "ucase": f"ucase({V})", "lcase": f"lcase({V})", "initcap": f"initcap({V})",
    "trim": f"trim({V})", "ltrim": f"ltrim({V})", "rtrim": f"rtrim({V})", "btrim": f"btrim({V})",
    "substring": f"substring({V}, length({V}), 9)", "substr": f"substr({V}, -5, 2)", "left": f"left({V}, length({V}))", "right": f"right({V}, 2)",
    "lpad": f"lpad({V}, 10, '')", "rpad": f"rpad({V}, 10000, {V})", "replace": f"replace({V}, {V}, 'x')", "translate": f"translate({V}, 'abc', '')",
    "reverse": f"reverse({V})", "length": f"concat(length({V}), '')", "char_length": f"concat(char_length({V}), '')",
    "character_length": f"concat(character_length({V}), '')", "instr": f"concat(instr({V}, 'a'), '')", "locate": f"concat(locate('a', {V}), '')",
    "position": f"concat(position('a', {V}), '')", "startswith": f"if(startswith({V}, {V}), 'x', 'y')", "endswith": f"if(endswith({V}, 'a'), 'x', 'y')",
    "contains": f"if(contains({V}, 'a'), 'x', 'y')", "split_part": f"split_part({V}, '-', 2)", "regexp_replace": f"regexp_replace({V}, '[0-9]+', '#')",
    "regexp_extract": f"regexp_extract({V}, '([0-9])-([0-9])', 2)", "substring_index": f"substring_index({V}, '-', -1)",
    "isnull": f"if(isnull({V}), 'x', 'y')", "isnotnull": f"if(isnotnull({V}), 'x', 'y')", "try_add": f"concat(try_add(2147483647, length({V})), '')",
    "try_subtract": f"concat(try_subtract(-2147483647, length({V})), '')", "try_multiply": f"concat(try_multiply(2147483647, length({V})), '')",
    "try_divide": f"concat(try_divide(1, length({V})), '')", "try_cast": f"concat(try_cast({V} as int), '')",
    "try_to_number": f"concat(try_to_number({V}, '99'), '')", "greatest": f"greatest({V}, 'm')", "least": f"least({V}, 'm')",
}


def test_every_allowed_function_is_usable_and_cannot_raise(probe):
    assert set(USES) == set(R.ALLOWED_FUNCTIONS)
    cols = []
    for name, text in USES.items():
        col, reason = R.compile_rule(probe.limit(0), text)
        assert col is not None, (name, reason)
        cols.append(col.alias(name))
    assert len(probe.select(*cols).collect()) == 8


@pytest.mark.parametrize("text", [
    "case when curve['P.is'].fullname > 5 then 'x' end",
    "left('abc', curve['P.is'].fullname)",
    "case when curve['P.is'].fullname in (1, 2) then 'x' end",
    "regexp_replace(curve['P.is'].fullname, '[[]', 'x')",
])
def test_casts_and_patterns_that_can_raise_are_refused_after_analysis(probe, text):
    col, reason = R.compile_rule(probe, text)
    assert col is None and reason.startswith("rule refused")


BOUNDED = ["[0-9]+", "([0-9])-([0-9])", "^([^-]+)-(.*)", "^[a-z]*[0-9]+$", "a|b", "(a|b)c", "(ab)?c", "x{2,5}y", "[^a-z]", "-.*", "^a+b", "(?:a|b)", "[a-]", "",
           "^(a+b|c)", "^([^#]*)#(.*)$", ".*?", "^(b*)?(a)", "[b-e]{1,100}x", "(a|ab)(b|)c", "a*", "(.*)", "^.?a"]
UNBOUNDED = ["(a|b)*c", "(a+)+", "(a+)+b", "a*b", "(ab)+", "a*a*b", "^a*ab", "[0-9]+$", "(?=a)", "(?i)a", "(?<x>a)", "a{2,}", "[a[b]]", "[a&&b]", "(a", "a)", "[a", "*a", "a**",
             "a++b", "^a*(a|b)", "(a?){20}", "a?" * 14, "^a|b*c", "^(.*)x", "(a|b){2}", "^[^-]*.b", "a^b", "x{2000}", "^(a*)(b?)(a)", "(a*)b", "(x|a*)b", "a" * 600, "x.*y", "[]", "a$?",
             "^(a*|b)c*a", "[a-z]{0,99}[a-z]{0,99}"]
LONG = ["a" * 100_000, "ab" * 50_000, "a\U0001f600" * 50_000, "1" * 100_000, "-" * 100_000, " " * 100_000, "a" * 99_999 + "b", ""]


@pytest.mark.parametrize("pattern", BOUNDED)
def test_bounded_patterns_run_on_long_values(spark, pattern):
    P.check_pattern(pattern)
    compiled = spark.sparkContext._jvm.java.util.regex.Pattern.compile(pattern)
    for value in LONG:
        t = time.time()
        compiled.matcher(value).replaceAll("x")
        assert time.time() - t < 5


@pytest.mark.parametrize("pattern", UNBOUNDED)
def test_patterns_without_a_bound_are_refused(pattern):
    with pytest.raises(P.PatternRefused):
        P.check_pattern(pattern)
    with pytest.raises(R.RuleRefused):
        R.check_rule(f"regexp_replace(curve['P.is'].fullname, '{pattern}', 'x')")


PIECES = st.recursive(
    st.sampled_from(["a", "b", ".", "[ab]", "[^a]", "a*", "b+", ".*", "[ab]*", "a?", "b{1,3}", "$", ".*?", "a++", "[^b]*"]),
    lambda x: st.one_of(st.tuples(x, x).map("".join), st.tuples(x, x).map(lambda p: f"({p[0]}|{p[1]})"), x.map(lambda p: f"({p})?"), x.map(lambda p: f"(?:{p})")), max_leaves=6)


@given(st.sampled_from(["", "^"]), PIECES)
@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_what_the_checker_accepts_ends_soon(spark, start, piece):
    try:
        P.check_pattern(start + piece)
    except P.PatternRefused:
        return
    compiled = spark.sparkContext._jvm.java.util.regex.Pattern.compile(start + piece)
    for value in ("a" * 20_000, "ab" * 10_000, "b" * 19_999 + "a", "a\U0001f600" * 10_000):
        t = time.time()
        compiled.matcher(value).replaceAll("x")
        assert time.time() - t < 2, start + piece


@pytest.mark.parametrize(("pattern", "fine"), [("%a%", True), ("a%b", True), ("a%b%", True), ("%a_b%", True), ("a", True), ("%", True), ("%a%b", False), ("%a%b%", False), ("%%a", False), ("a%%", False)])
def test_like_patterns(pattern, fine):
    text = f"case when curve['P.is'].fullname like '{pattern}' then 'x' end"
    if fine:
        R.check_rule(text)
    else:
        with pytest.raises(R.RuleRefused, match="at most one %"):
            R.check_rule(text)


@pytest.mark.parametrize(("text", "fine"), [
    (f"replace({V}, 'a', 'bb')", True),
    (f"concat(replace({V}, 'a', '{'b' * 90}'), replace({V}, 'a', '{'b' * 90}'))", True),
    (f"replace({V}, 'a', '{'b' * 101}')", False),
    (f"replace({V}, 'ab', '{'b' * 150}')", True),
    (f"replace(upper(replace({V}, 'a', 'bbbbbbbbbbb')), 'B', 'bbbbbbbbbbb')", False),
    (f"replace({V}, {V}, 'bbb')", True),
    (f"replace({V}, 'a', {V})", False),
    (f"regexp_replace(regexp_replace({V}, 'a*', 'bbbbbbbbb'), '[b]', 'bbbbbbbbbbb')", False),
])
def test_replacements_lengthen_a_value_by_a_bounded_factor(text, fine):
    if fine:
        R.check_rule(text)
    else:
        with pytest.raises(R.RuleRefused):
            R.check_rule(text)


def test_a_long_value_fails_no_run(tables):
    """The rule that used to end the job: it is refused, the other load set's long values are named."""
    meta = [meta_row(k, "P", "is", "ab" * 50_000 if k % 2 else "short") for k in range(1, 5)]
    rules = [(1, f"regexp_replace({V}, '(a|b)*c', 'x')", f"regexp_extract({V}, '^([a-z])', 1)", V, 1),
             (2, f"left(regexp_replace({V}, '[ab]+', 'x'), 9)", f"regexp_extract({V}, '^([a-z])', 1)", f"rpad({V}, 9, ' ')", 1)]
    t = tables(meta, [(k % 2 + 1, k) for k in range(1, 5)] + [(1, 1)], rules)
    rows = {(r["load_set_id"], r["curve_id"]): r for r in jobs.stage(t["meta"], t["members"], t["dict"], t["rules"]).checked.collect()}
    assert "rule refused: pattern (a|b)*c" in rows[1, 1]["long_text"] and rows[1, 1]["short_text"] == "a"
    assert rows[2, 1]["long_text"] == "x" and rows[2, 3]["desc_text"] == "ababababa"


def test_keys_with_escapes_count_as_computed(tables):
    use = R.referenced_keys(["curve['A\\tB.is'].fullname"])
    assert not use.restricted
    meta = [meta_row(1, "A\tB", "is", "val"), meta_row(2, "A", "is", "other")]
    rule = "curve['A\\tB.is'].fullname"
    t = tables(meta, [(1, 1), (2, 2)], [(1, rule, rule, rule, 1), (2, *["curve['A.is'].fullname"] * 3, 1)])
    args = (t["meta"], t["members"], t["dict"], t["rules"])
    pruned = sorted(map(tuple, jobs.stage(*args).staged.collect()))
    assert pruned == sorted(map(tuple, jobs.stage(*args, restrict_keys=False).staged.collect()))
    assert [r[1] for r in pruned] == ["val", "other"]
    # only the load set with the computed key gets full maps
    sets = R.collect_rules(t["rules"])
    assert [(len(s), k is None) for s, k in jobs.by_key_use(sets, True)] == [(1, False), (1, True)]


def test_string_literals_are_not_scanned():
    R.check_rule("concat('reflect(', curve['A.b'].fullname, ' / select')")


def test_referenced_keys():
    use = R.referenced_keys(["concat(curve['G.in1'].fullname, var['Pis'].abbr)", "curve['P.is'].fullname"])
    assert use.curve_keys == {"G.in1", "P.is"} and use.var_keys == {"Pis"}
    assert use.needs_curve and use.needs_var and use.restricted
    dyn = R.referenced_keys(["curve[concat('P', '.is')].fullname"])
    assert not dyn.restricted


def test_key_candidates():
    assert R.key_candidates(["G.in12"]) == {"G.in12", "G.in1", "G.in"}


def test_attribute_candidates():
    use = R.referenced_keys(["curve['Value.Frequency.is'].fullname"])
    assert use.attribute_candidates() == {"Value", "Value.Frequency"}


def _named(tables, rules, meta):
    t = tables(meta, [(1, m[0]) for m in {(r[0],) for r in meta}], rules)
    run = jobs.stage(t["meta"], t["members"], t["dict"], t["rules"])
    return {r["curve_id"]: r for r in run.checked.collect()}, run


def test_bad_rule_fails_rows_not_job(tables):
    meta = [meta_row(1, "P", "is", "alpha"), meta_row(2, "P", "is", "beta")]
    rows, _ = _named(tables, [(1, "curve['P.is'].fullname", "no_such_fn(1)", "curve['P.is'].nope", 1)], meta)
    assert rows[1]["long_ok"] and rows[1]["long_text"] == "alpha"
    assert not rows[1]["short_ok"]
    assert rows[1]["short_text"].startswith(
        "Failed to generate short curve name for the curve:1 because of exception:rule refused")
    assert rows[2]["desc_text"].startswith("Failed to generate description for the curve:2 because of exception:")


def test_non_string_result_is_a_failure(tables):
    meta = [meta_row(1, "P", "is", "alpha")]
    rows, _ = _named(tables, [(1, "length(curve['P.is'].fullname) > 1", "curve['P.is'].fullname",
                                "curve['P.is'].fullname", 1)], meta)
    assert not rows[1]["long_ok"]
    assert "rule returns boolean" in rows[1]["long_text"]


def test_missing_rule_fails_load_set(tables):
    meta = [meta_row(1, "P", "is", "alpha")]
    _, run = _named(tables, [(1, "curve['P.is'].fullname", "", "curve['P.is'].fullname", 1)], meta)
    assert run.failed_load_sets == [1]
    assert run.staged.count() == 0
    assert "doesn't have rule for short curve name" in run.rule_sets[0].error


def test_unknown_load_set(spark, tables):
    t = tables([meta_row(1, "P", "is", "a")], [(1, 1)],
               [(1, "curve['P.is'].fullname", "curve['P.is'].fullname", "curve['P.is'].fullname", 1)])
    run = jobs.stage(t["meta"], t["members"], t["dict"], t["rules"], load_set_ids=[1, 9])
    errs = {r.load_set_id: r.error for r in run.rule_sets}
    assert errs[1] is None and "doesn't exist" in errs[9]


def test_var_and_curve_maps_and_shared_rules(tables):
    meta = [meta_row(1, "G", "is", "x"), meta_row(1, "G", "is", "z"), meta_row(1, "G", "is", "y"),
            meta_row(2, "G", "is", "q")]
    rules = [(1, "concat(curve['G.is'].fullname, curve['G.is1'].fullname, curve['G.is2'].fullname)",
              "concat(var['Gis'].fullname, var['Gis2'].fullname)", "curve['G.is'].fullname", 1)]
    t = tables(meta, [(1, 1), (1, 2), (2, 1)], rules + [(2,) + rules[0][1:]])
    run = jobs.stage(t["meta"], t["members"], t["dict"], t["rules"])
    rows = {(r["load_set_id"], r["curve_id"]): r for r in run.checked.collect()}
    assert rows[(1, 1)]["long_text"] == "xyz"
    assert rows[(1, 1)]["short_text"] == "xz"
    assert rows[(2, 1)]["long_text"] == "xyz"          # same rule text, second load set
    assert not rows[(1, 2)]["long_ok"]                 # only one G entry: G.is1 is missing


def test_many_rule_texts_run_in_passes(tables):
    from namewright.plans.jobs import rule_chunks
    meta = [meta_row(c, "P", "is", f"p{c}") for c in range(12)]
    members = [(ls, c) for c in range(12) for ls in (c % 6,)]
    rules = [(ls, f"concat(curve['P.is'].fullname, '-{ls}')", "curve['P.is'].fullname",
              "curve['P.is'].fullname", 1) for ls in range(6)]
    t = tables(meta, members, rules)
    rs = R.collect_rules(t["rules"])
    assert [len(c) for c in rule_chunks(rs, max_texts=4)] == [4, 2]
    named = jobs.named_curves(t["meta"], t["members"], t["dict"], rs, max_texts=4)
    got = {r["curve_id"]: r["long_value"] for r in named.collect()}
    assert got == {c: f"p{c}-{c % 6}" for c in range(12)}


def test_many_rule_texts_one_shared_pass(tables):
    meta = [meta_row(c, "P", "is", f"p{c}") for c in range(12)]
    members = [(c % 6, c) for c in range(12)]
    rules = [(ls, f"concat(curve['P.is'].fullname, '-{ls}')", "curve['P.is'].fullname",
              "curve['P.is'].fullname", 1) for ls in range(6)]
    t = tables(meta, members, rules)
    rs = R.collect_rules(t["rules"])
    kept = []
    named = jobs.named_curves(t["meta"], t["members"], t["dict"], rs, max_texts=4, persisted=kept)
    got = {r["curve_id"]: r["long_value"] for r in named.collect()}
    assert got == {c: f"p{c}-{c % 6}" for c in range(12)}
    assert len(kept) == 1
    for df in kept:
        df.unpersist()
