"""Naming rules (RUL1-5).

A rule is a Spark SQL expression over two map columns of a curve:

* ``curve['Provider.is'].fullname``: raw key ``attribute.verb`` (repeats
  numbered ``K1``, ``K2``), value struct ``fullname, shortname, abbr``
* ``var['Provideris'].shortname``: the same entries keyed by the normalised
  key (``.``, ``"`` and ``:`` dropped)

Each load set has three rules (long name, short name, description).  All
load sets are evaluated in one projection: one ``CASE`` branch per distinct
rule text, selected by ``load_set_id IN (...)``.  Rules are compiled once by
Catalyst and run in whole-stage codegen; no interpreter runs per row.

Failures are per row, never per job:

* a missing attribute gives null, reported as ``rule returned no value``;
* a rule that does not parse or analyse, returns a non-string, or is refused
  by the allow-list becomes a literal failure message for every curve of its
  load set (checked on the driver against the schema, without a job);
* only functions that cannot raise at run time are allowed, arguments that
  could make them raise (patterns, lengths, part numbers, replacements) must be
  literals, and rules into which Spark inserts a cast that can raise are refused
  after analysis (ANSI mode is on in Spark 4, where a bad cast fails the whole job);
* regular expressions and LIKE patterns must have a shape whose work is bounded by
  the value's length (``patterns``), and nested replacements may lengthen a value
  at most ``MAX_GROWTH`` times, so that one long value cannot end or hang a run.

The rules table is a control table (one row per load set); it is the only
data brought to the driver.
"""

from __future__ import annotations

import logging
import re
import warnings
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from namewright.operators.patterns import PatternRefused, check_like, check_pattern
from namewright.sources.tables import read_rules

KINDS = ("long", "short", "desc")
RULE_COLUMN = {"long": "longname_rule_exp", "short": "shortname_rule_exp", "desc": "desc_rule_exp"}
MISSING_RULE_TEXT = {
    "long": "doesn't have rule for long curve name",
    "short": "doesn't have rule for short curve name",
    "desc": "doesn't have rule for curve description",
}

# ---------------------------------------------------------------------------
# RUL3: allow-list.  Functions that cannot raise on any input (try_* forms
# where a plain form could), words, columns and struct fields a rule may use.
# ---------------------------------------------------------------------------
ALLOWED_FUNCTIONS = frozenset("""
concat concat_ws coalesce nvl nvl2 ifnull nullif if
upper lower ucase lcase initcap trim ltrim rtrim btrim
substring substr left right lpad rpad replace translate reverse
length char_length character_length instr locate position
startswith endswith contains split_part regexp_replace regexp_extract
substring_index isnull isnotnull
try_add try_subtract try_multiply try_divide try_cast try_to_number
greatest least
""".split())
ALLOWED_WORDS = frozenset("""
curve var case when then else end and or not is null in like ilike between
true false distinct from as int bigint double string date
""".split())
MAX_PAD = 10_000            # longest lpad / rpad result
MAX_GROWTH = 100            # how many times nested replacements may lengthen a value
MAP_COLUMNS = frozenset(("curve", "var"))
STRUCT_FIELDS = frozenset(("fullname", "shortname", "abbr"))
ALLOWED_SYMBOLS = frozenset(["(", ")", "[", "]", ",", ".", "=", "==", "<>", "!=", "<", ">", "<=",
                             ">=", "||", "<=>"])

_TOKEN = re.compile(r"""
    (?P<ws>\s+)
  | (?P<str>'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*")
  | (?P<num>\d+(?:\.\d+)?)
  | (?P<ident>[A-Za-z_][A-Za-z0-9_]*)
  | (?P<sym><=>|<>|!=|<=|>=|==|\|\||->|::|[()\[\],.=<>+\-*/%|&^~;:`{}!?@#$])
""", re.VERBOSE)


class RuleRefused(ValueError):
    """The rule text uses something outside the allow-list."""


@dataclass
class Token:
    kind: str
    text: str


def tokenize(text: str) -> list[Token]:
    out, pos = [], 0
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m:
            raise RuleRefused(f"unexpected character {text[pos]!r} at {pos}")
        pos = m.end()
        if m.lastgroup != "ws":
            out.append(Token(m.lastgroup, m.group()))
    return out


def _arguments(toks: list[Token], at: int) -> list[list[Token]]:
    """The arguments of the call whose opening parenthesis is ``toks[at]``."""
    out, depth = [[]], 0
    for t in toks[at:]:
        if t.kind == "sym" and t.text in "([":
            depth += 1
            if depth == 1:
                continue
        elif t.kind == "sym" and t.text in ")]":
            depth -= 1
            if depth == 0:
                return out
        elif depth == 1 and t.text == ",":
            out.append([])
            continue
        out[-1].append(t)
    raise RuleRefused("unbalanced parentheses")


def _plain_literal(arg: list[Token]) -> str | None:
    """The value of a string literal without escapes, else None."""
    if len(arg) == 1 and arg[0].kind == "str":
        body = arg[0].text[1:-1]
        if "\\" not in body and arg[0].text[0] not in body:
            return body
    return None


def _small_number(arg: list[Token], least: int, most: int) -> bool:
    return len(arg) == 1 and arg[0].kind == "num" and arg[0].text.isdigit() and least <= int(arg[0].text) <= most


def _check_call(name: str, args: list[list[Token]]) -> None:
    """Arguments that could make an allowed function raise must be literals."""
    if name in ("lpad", "rpad") and not (len(args) > 1 and _small_number(args[1], 0, MAX_PAD)):
        raise RuleRefused(f"{name} needs a literal length of at most {MAX_PAD}")
    if name == "split_part" and not (len(args) == 3 and _small_number(args[2], 1, 10_000)):
        raise RuleRefused("split_part needs a literal part number from 1 on")
    if name in ("regexp_replace", "regexp_extract"):
        pattern = _plain_literal(args[1]) if len(args) > 1 else None
        try:
            with warnings.catch_warnings(action="ignore"):
                groups = re.compile(pattern or "(").groups
        except re.error:
            raise RuleRefused(f"{name} needs a valid literal pattern without escapes") from None
        if name == "regexp_extract" and len(args) == 3 and not _small_number(args[2], 0, groups):
            raise RuleRefused("regexp_extract needs a literal group of its pattern")
        if name == "regexp_extract" and len(args) == 2 and groups < 1:
            raise RuleRefused("regexp_extract needs a group in its pattern")
        if name == "regexp_replace":
            replacement = _plain_literal(args[2]) if len(args) == 3 else None
            if replacement is None or "$" in replacement:
                raise RuleRefused("regexp_replace needs a literal replacement without escapes or groups")
        try:
            check_pattern(pattern)
        except PatternRefused as e:
            raise RuleRefused(f"pattern {pattern}: {e}") from None
    if name == "replace" and len(args) > 2 and _plain_literal(args[2]) is None:
        raise RuleRefused("replace needs a literal replacement without escapes")
    if name == "try_to_number" and not (len(args) == 2 and _plain_literal(args[1])):
        raise RuleRefused("try_to_number needs a literal format")


def _growth(toks: list[Token]) -> float:
    """How many times as long as one value the longest text inside an expression can get through replacements."""
    longest = 1.0
    for at, t in enumerate(toks[:-1]):
        name = t.text.lower() if t.kind == "ident" else ""
        if name in ("replace", "regexp_replace") and toks[at + 1].text == "(":
            args = _arguments(toks, at + 1)
            new = len(_plain_literal(args[2]) or "") if len(args) > 2 else 0
            old = _plain_literal(args[1]) if name == "replace" and len(args) > 1 else None
            factor = max(1.0, new / len(old) if old else new + (name == "regexp_replace"))
            longest = max(longest, factor * _growth(args[0]))
    return longest


def check_rule(text: str) -> list[Token]:
    """RUL3: refuse anything outside the allow-list; return the tokens."""
    if text is None or not text.strip():
        raise RuleRefused("empty rule")
    toks = tokenize(text)
    depth = 0
    for i, t in enumerate(toks):
        nxt = toks[i + 1] if i + 1 < len(toks) else None
        prev = toks[i - 1] if i > 0 else None
        if t.kind == "ident":
            low = t.text.lower()
            if nxt is not None and nxt.text == "(":
                if low not in ALLOWED_FUNCTIONS and low not in ("in", "and", "or", "not", "when", "then", "else", "between", "case"):
                    raise RuleRefused(f"function {t.text} is not allowed")
                if low in ALLOWED_FUNCTIONS:
                    _check_call(low, _arguments(toks, i + 1))
            elif prev is not None and prev.text == ".":
                if low not in STRUCT_FIELDS:
                    raise RuleRefused(f"field {t.text} is not allowed")
            elif low not in ALLOWED_WORDS:
                raise RuleRefused(f"name {t.text} is not allowed")
            if low in ("like", "ilike"):
                if nxt is None or _plain_literal([nxt]) is None:
                    raise RuleRefused(f"{t.text} needs a literal pattern without escapes")
                try:
                    check_like(_plain_literal([nxt]))
                except PatternRefused as e:
                    raise RuleRefused(f"pattern {_plain_literal([nxt])}: {e}") from None
            if low in MAP_COLUMNS and (nxt is None or nxt.text != "["):
                raise RuleRefused(f"{t.text} must be indexed by a key")
        elif t.kind == "sym":
            if t.text == "-" and nxt is not None and nxt.kind == "num":
                continue
            if t.text not in ALLOWED_SYMBOLS:
                raise RuleRefused(f"operator {t.text} is not allowed")
            if t.text == "[":
                # only map lookups by a key expression are allowed; array
                # indexing raises in ANSI mode
                if prev is None or prev.text.lower() not in MAP_COLUMNS:
                    raise RuleRefused("only curve[...] and var[...] may be indexed")
            if t.text == "(":
                depth += 1
            elif t.text == ")":
                depth -= 1
                if depth < 0:
                    raise RuleRefused("unbalanced parentheses")
    if depth != 0:
        raise RuleRefused("unbalanced parentheses")
    if _growth(toks) > MAX_GROWTH:
        raise RuleRefused(f"replacements may lengthen a value at most {MAX_GROWTH} times")
    return toks


@dataclass
class KeyUse:
    """Which map keys a set of rules can read."""
    curve_keys: set[str] = field(default_factory=set)
    var_keys: set[str] = field(default_factory=set)
    needs_curve: bool = False
    needs_var: bool = False
    restricted: bool = True          # False when some key is computed, not literal

    def attribute_candidates(self) -> set[str]:
        """Attributes that can produce one of the raw keys (key = attribute.verb,
        and the attribute may itself hold dots)."""
        out = set()
        for k in key_candidates(self.curve_keys):
            for i, ch in enumerate(k):
                if ch == ".":
                    out.add(k[:i])
        return out


def _splits(key: str):
    """(base, repeat number) readings of a numbered key: ``G.in12`` may be the
    12th repeat of ``G.in`` or the 2nd of ``G.in1``; every key is also its own
    base with number 0.  Numbers never have leading zeros."""
    yield key, 0
    j = len(key)
    while j > 0 and key[j - 1].isdigit():
        j -= 1
        digits = key[j:]
        if digits[0] != "0":
            yield key[:j], int(digits)


def entries_needed(keys) -> dict[str, int]:
    """For every base key, how many of its first entries (in numbering order)
    the referenced keys can reach: 1 + the largest repeat number read."""
    need: dict[str, int] = {}
    for k in keys:
        for base, n in _splits(k):
            need[base] = max(need.get(base, 0), n + 1)
    return need


def key_candidates(keys) -> set[str]:
    """Raw keys that can become one of ``keys`` after numbering: the key itself
    and every form with trailing digits removed (``G.in12`` may be the 12th
    ``G.in``, the 2nd ``G.in1`` or a literal ``G.in12``)."""
    out = set()
    for k in keys:
        out.add(k)
        j = len(k)
        while j > 0 and k[j - 1].isdigit():
            j -= 1
            out.add(k[:j])
    return out


def referenced_keys(rule_texts) -> KeyUse:
    use = KeyUse()
    for text in rule_texts:
        try:
            toks = check_rule(text)
        except RuleRefused:
            continue
        for i, t in enumerate(toks):
            if t.kind == "ident" and t.text.lower() in MAP_COLUMNS:
                which = t.text.lower()
                if which == "curve":
                    use.needs_curve = True
                else:
                    use.needs_var = True
                # a key with escapes counts as computed: only Spark's parser reads it for sure
                key = _plain_literal([toks[i + 2]]) if i + 3 < len(toks) and toks[i + 3].text == "]" else None
                if key is None:
                    use.restricted = False
                    continue
                (use.curve_keys if which == "curve" else use.var_keys).add(key)
    return use


# ---------------------------------------------------------------------------
# RUL5: presence, LIM1: one row per load set
# ---------------------------------------------------------------------------
@dataclass
class RuleSet:
    load_set_id: int
    texts: dict
    status: int | None
    error: str | None = None               # the whole load set fails (RUL5)


def collect_rules(rules: DataFrame, load_set_ids=None) -> list[RuleSet]:
    """Bring the (tiny) rules control table to the driver and check it:
    a load set with a missing / empty rule, or with several rule rows, fails;
    a requested load set without a row fails."""
    rows = read_rules(rules, load_set_ids).collect()
    by_id: dict[int, list] = {}
    for r in rows:
        by_id.setdefault(int(r["load_set_id"]), []).append(r)
    out = []
    for lsid, rs in sorted(by_id.items()):
        r = rs[0]
        texts = {k: r[RULE_COLUMN[k]] for k in KINDS}
        err = None
        if len(rs) > 1:
            err = f"Loadset:{lsid} has {len(rs)} rule rows"
        else:
            for k in KINDS:
                if texts[k] is None or texts[k] == "":
                    err = f"Loadset:{lsid} {MISSING_RULE_TEXT[k]}"
                    break
        out.append(RuleSet(lsid, texts, r["curvename_status_id"], err))
    if load_set_ids is not None and load_set_ids != "all":
        wanted = load_set_ids if isinstance(load_set_ids, (list, tuple, set, frozenset)) else [load_set_ids]
        for lsid in wanted:
            if int(lsid) not in by_id:
                out.append(RuleSet(int(lsid), {}, None, f"Load set:{lsid} doesn't exist!"))
    return out


# ---------------------------------------------------------------------------
# RUL1, RUL2, RUL4: evaluation
# ---------------------------------------------------------------------------
def _raising_cast(df: DataFrame) -> str | None:
    """The first cast in the analysed plan of ``df`` that can raise in ANSI mode
    (comparing or passing a text where Spark wants a number inserts one)."""
    jvm = df.sparkSession.sparkContext._jvm
    can_up_cast = jvm.org.apache.spark.sql.catalyst.expressions.Cast.canUpCast

    def below(node):
        children = node.children()
        return [children.apply(k) for k in range(children.size())]

    exprs = df._jdf.queryExecution().analyzed().expressions()
    todo = [exprs.apply(k) for k in range(exprs.size())]
    while todo:
        e = todo.pop()
        kids = below(e)
        if e.getClass().getSimpleName() == "Cast" and e.evalMode().toString() == "ANSI":
            if not can_up_cast(kids[0].dataType(), e.dataType()):
                return f"{kids[0].dataType().simpleString()} to {e.dataType().simpleString()}"
        todo += kids
    return None


def _check_patterns(attrs: DataFrame, toks: list[Token]) -> None:
    """Refuse regular expressions that Java, which runs them, does not compile."""
    pattern = attrs.sparkSession.sparkContext._jvm.java.util.regex.Pattern
    for i, t in enumerate(toks):
        if t.kind == "ident" and t.text.lower() in ("regexp_replace", "regexp_extract"):
            try:
                pattern.compile(_plain_literal(_arguments(toks, i + 1)[1]))
            except (Py4JJavaError, PySparkException):
                raise RuleRefused(f"{t.text} needs a valid literal pattern without escapes") from None


@contextmanager
def _unlogged():
    """A rule that does not analyse is reported as a message of its load set, not in the log."""
    logger = logging.getLogger("SQLQueryContextLogger")
    before, logger.disabled = logger.disabled, True
    try:
        yield
    finally:
        logger.disabled = before


def compile_rule(attrs: DataFrame, text: str) -> tuple[Column | None, str | None]:
    """Check and analyse one rule against the attribute schema, on the driver
    (no job; ``attrs`` may be an empty relation with the right schema).
    Returns (column, None) or (None, reason)."""
    try:
        _check_patterns(attrs, check_rule(text))
    except RuleRefused as e:
        return None, f"rule refused: {e}"
    try:
        with _unlogged():
            col = F.expr(text)
            dtype = attrs.select(col.alias("_r")).schema["_r"].dataType
    except PySparkException as e:
        cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
        reason = (cond() if cond else None) or type(e).__name__
        return None, f"rule does not compile: {reason}"
    cast = _raising_cast(attrs.select(col.alias("_r")))
    if cast is not None:
        return None, f"rule refused: it needs a cast that can fail ({cast})"
    if not isinstance(dtype, StringType):
        return None, f"rule returns {dtype.simpleString()}, not string"
    return col, None


def apply_rules(attrs: DataFrame, rule_sets: list[RuleSet]) -> DataFrame:
    """Evaluate every load set's rules over its curves in one projection.

    Output adds, per kind in (long, short, desc): ``<kind>_value`` (the rule's
    result, null when it gave none or failed to compile) and ``<kind>_error``
    (the compile-time reason, null otherwise).  Load sets with a RUL5 error
    are left out here; the job reports them through the status transition.
    Load sets sharing a rule text share one CASE branch."""
    good = [rs for rs in rule_sets if rs.error is None]
    ids = F.col("load_set_id")
    null_str = F.lit(None).cast("string")
    # analyse rules against an empty relation of the same schema: cheap, and
    # independent of how large the plan behind ``attrs`` is
    probe = attrs.sparkSession.createDataFrame([], attrs.schema)
    out_cols = []
    for kind in KINDS:
        sets_by_text: dict[str, list[int]] = {}
        for rs in good:
            sets_by_text.setdefault(rs.texts[kind], []).append(rs.load_set_id)
        value_expr = error_expr = None
        for text, lsids in sets_by_text.items():
            cond = ids.isin(sorted(lsids))
            col, reason = compile_rule(probe, text)
            if col is not None:
                value_expr = F.when(cond, col) if value_expr is None else value_expr.when(cond, col)
            else:
                err = F.lit(reason)
                error_expr = F.when(cond, err) if error_expr is None else error_expr.when(cond, err)
        out_cols.append((value_expr if value_expr is not None else null_str).alias(f"{kind}_value"))
        out_cols.append((error_expr if error_expr is not None else null_str).alias(f"{kind}_error"))
    kept = attrs.filter(ids.isin(sorted(rs.load_set_id for rs in good)) if good else F.lit(False))
    extra = [c for c in attrs.columns if c not in ("load_set_id", "curve_id", "curve", "var")]
    return kept.select("load_set_id", "curve_id", *extra, *out_cols)
