"""Independent SQL (DuckDB dialect) for every registered query.

Each text is ``WITH <catalogue views>, <rules>, <steps...> SELECT ...`` over the
driver's tables.  The steps are written from the semantics (SQL joins,
``row_number``, ``string_agg``, ``min`` owners), not from the Spark code, and
each fixture rule is spelled out as SQL over a pivot of the keys it reads.
"""

from __future__ import annotations

from namewright.sources.fixture_views import FIXTURE_SQL, PATTERN_SQL, rules_values_sql

LONG_MAX, SHORT_MAX, CLIP = 64, 32, 4000

# Fixed values, spelled here on their own: (attribute, element) of the single-valued elements in order,
# (attribute, names element, codes element) of the lists.
SINGLE_ELEMENTS = [
    ("Provider", "Provider"), ("Timezone", "Timezone"), ("Value.Frequency", "ValueFrequency"), ("Status", "Status"),
    ("Unit", "Unit"), ("Issue.Frequency", "IssueFrequency"), ("Variable", "Variable"), ("Commodity", "Commodity"),
    ("Technology", "Technology"), ("FacilityType", "PhysicalAssetType"), ("Variable.Specification", "VariableSpecification"),
]
PAIRED_ELEMENTS = [("Geography", "Geography", "GeographyRCS"), ("Facility", "PhysicalAsset", "PhysicalAssetRCS")]

STEPS: dict[str, str] = {}

STEPS["entries"] = """entries AS (
  SELECT lsc.load_set_id, lsc.curve_id,
         coalesce(om.attribute, '') || '.' || coalesce(om.verb, '') AS key,
         coalesce(om.element_name, '') AS fullname, coalesce(om.element, '') AS shortname,
         coalesce(nullif(d.abbr, ''), ' ') AS abbr
  FROM object_meta om JOIN load_set_curve lsc ON om.object_id = lsc.curve_id
  LEFT JOIN curve_dict d ON om.element_id = d.element_id)"""

STEPS["entry_text"] = """entry_text AS (
  SELECT load_set_id, curve_id,
         '"' || key || '":{fullname:"' || fullname || '",shortname:"' || shortname || '",abbr:"' || abbr || '"}' AS entry
  FROM entries)"""

STEPS["attr_text"] = """attr_text AS (
  SELECT load_set_id, curve_id, string_agg(entry, ',' ORDER BY entry) AS attr
  FROM entry_text GROUP BY load_set_id, curve_id)"""


def _numbered(name: str, key_expr: str) -> str:
    return f"""{name}_num AS (
  SELECT *, CASE WHEN n = 0 THEN k ELSE k || CAST(n AS VARCHAR) END AS fkey
  FROM (SELECT load_set_id, curve_id, {key_expr} AS k, fullname, shortname, abbr,
               row_number() OVER (PARTITION BY load_set_id, curve_id, {key_expr}
                                  ORDER BY fullname, shortname, abbr) - 1 AS n
        FROM entries) x),
{name}_map AS (
  SELECT load_set_id, curve_id, fkey, fullname, shortname, abbr
  FROM (SELECT *, row_number() OVER (PARTITION BY load_set_id, curve_id, fkey
                                     ORDER BY n, fullname, shortname, abbr) AS r
        FROM {name}_num) y
  WHERE r = 1)"""


STEPS["curve_map"] = _numbered("curve", "key")
STEPS["var_map"] = _numbered("var", "translate(key, '.\":', '')")

STEPS["curves"] = """curves AS (SELECT DISTINCT load_set_id, curve_id FROM entries)"""

# the keys the fixture rules read, as pivot columns (key, field, column)
_PIVOT = [
    ("Provider.is", "fullname", "p_full"), ("Provider.is", "shortname", "p_short"),
    ("Provider.is", "abbr", "p_abbr"), ("Provider.is1", "shortname", "p1_short"), ("Provider.is1", "abbr", "p1_abbr"),
    ("Commodity.is", "fullname", "c_full"), ("Commodity.is", "shortname", "c_short"),
    ("Variable.is", "fullname", "v_full"), ("Unit.is", "fullname", "u_full"), ("Unit.is", "shortname", "u_short"),
    ("Geography.in", "fullname", "g_full"), ("Geography.in1", "fullname", "g1_full"),
    ("Geography.in2", "fullname", "g2_full"),
    ("Facility.at", "fullname", "f_full"), ("Facility.at1", "fullname", "f1_full"),
]
# keys read through ``var``
_VAR_PIVOT = [("Commodityis", "fullname", "vc_full"), ("Geographyin2", "shortname", "vg2_short")]
STEPS["pv"] = "pv AS (\n  SELECT c.load_set_id, c.curve_id,\n" + ",\n".join(
    f"         max(CASE WHEN m.fkey = '{k}' THEN m.{f} END) AS {col}" for k, f, col in _PIVOT
) + """
  FROM curves c LEFT JOIN curve_map m ON m.load_set_id = c.load_set_id AND m.curve_id = c.curve_id
  GROUP BY c.load_set_id, c.curve_id),
vpv AS (SELECT load_set_id, curve_id, """ + ", ".join(
    f"max(CASE WHEN fkey = '{k}' THEN {f} END) AS {col}" for k, f, col in _VAR_PIVOT) + " FROM var_map GROUP BY load_set_id, curve_id)"

# the three fixture rule sets, spelled as SQL (|| propagates NULL like concat)
STEPS["named"] = """named AS (
  SELECT load_set_id, curve_id,
    CASE load_set_id
      WHEN 0 THEN p_full || ' ' || c_full || ' ' || v_full
      WHEN 1 THEN p_short || ' ' || g_full || ' ' || g1_full
      WHEN 2 THEN c_full || ' ' || u_full || ' ' || f_full || ' ' || f1_full || ' ' || g_full
    END AS long_value,
    CASE WHEN load_set_id = 3 THEN 'rule refused: function java_method is not allowed' END AS long_error,
    CASE load_set_id
      WHEN 0 THEN p_short || ' ' || p_abbr || p1_abbr
      WHEN 1 THEN c_short || ' ' || g_full || ' ' || g1_full || ' ' || g2_full
      WHEN 2 THEN p1_short || ' ' || u_short
    END AS short_value,
    CASE WHEN load_set_id = 3 THEN 'rule does not compile: WRONG_NUM_ARGS.WITHOUT_SUGGESTION' END AS short_error,
    CASE load_set_id
      WHEN 0 THEN 'Curve of ' || vc_full || ' ' || vg2_short
      WHEN 1 THEN rpad(concat_ws(' ', v_full, u_full), 4500, '-')
      WHEN 2 THEN split_part(f_full, '#', 2)
    END AS desc_value,
    CASE WHEN load_set_id = 3 THEN 'rule returns int, not string' END AS desc_error
  FROM pv LEFT JOIN vpv USING (load_set_id, curve_id) WHERE load_set_id <= 3)"""


def _flag_cols(kind: str, label: str, limit: int | None) -> str:
    v, e = f"{kind}_value", f"{kind}_error"
    head = f"'Failed to generate {label} for the curve:' || CAST(curve_id AS VARCHAR)"
    reason = f"CASE WHEN {e} IS NOT NULL THEN 'rule_error' WHEN {v} IS NULL THEN 'no_value'"
    text = (f"CASE WHEN {e} IS NOT NULL THEN {head} || ' because of exception:' || {e} "
            f"WHEN {v} IS NULL THEN {head} || ' because of exception:rule returned no value'")
    if limit is not None:
        reason += f" WHEN length({v}) > {limit} THEN 'too_long'"
        text += (f" WHEN length({v}) > {limit} THEN {head} || ' because its result name ' || {v} "
                 f"|| ' is longer than {limit} characters'")
    reason += " END"
    text += f" ELSE {v} END"
    cols = [f"{reason} AS {kind}_reason", f"{text} AS {kind}_text"]
    return ",\n    ".join(cols)


STEPS["flags"] = f"""flags_raw AS (
  SELECT load_set_id, curve_id,
    {_flag_cols('long', 'long curve name', LONG_MAX)},
    {_flag_cols('short', 'short curve name', SHORT_MAX)},
    {_flag_cols('desc', 'description', None)}
  FROM named),
flags AS (
  SELECT load_set_id, curve_id, long_reason, long_text, long_reason IS NULL AS long_ok,
         short_reason, short_text, short_reason IS NULL AS short_ok, desc_reason, desc_text
  FROM flags_raw)"""

# The pattern fixture: which of its rules are refused and why, and what the others give, spelled on their own.
_UNBOUNDED = "after an unbounded repeat nothing may follow, unless the pattern begins with ^"
_GROUPS = "a group cannot be repeated"
_LIKE = "at most one % of a pattern may have something after it"
_REFUSED = {
    "long": {10: f"pattern (a|b)*c: {_GROUPS}", 11: f"pattern (a+)+b: {_GROUPS}", 12: f"pattern a*b: {_UNBOUNDED}",
             13: "pattern (?=a)(a): only plain groups and (?:..) are allowed",
             14: "pattern ^(.*)#(.*)$: what follows an unbounded repeat must not share a character with it",
             15: "pattern a{2,}: a counted repeat needs a lower and an upper bound", 17: f"pattern (a|b|ab)+: {_GROUPS}"},
    "short": {17: f"pattern ([a-z]*)(#.*): {_UNBOUNDED}"},
    "desc": {11: f"pattern %a%b%c%: {_LIKE}", 12: "replacements may lengthen a value at most 100 times", 13: f"pattern [a-z]+$: {_UNBOUNDED}",
             14: "replace needs a literal replacement without escapes", 15: f"pattern {'a?' * 14}b: too many alternatives to try",
             17: f"pattern %%%%%a: {_LIKE}"},
}
_GIVEN = {
    "long": {16: "regexp_replace(note, '[a-z]{1,9}#', '*', 'g')"},
    "short": {10: "regexp_extract(note, '([a-z]+)', 1)", 11: "split_part(note, ' ', 1)", 12: "regexp_extract(note, '#([A-Z]+)', 1)",
              13: "'marked'", 14: "substr(note, strpos(note, '#') + 1)", 15: "regexp_replace(note, '(green|blue|red)?#', '/', 'g')",
              16: "coalesce(regexp_extract(note, '(ab)(ab)?(ab)?', 3), '')"},
    "desc": {10: "regexp_replace(note, '[aeiou]', '', 'g')", 16: "regexp_replace(note, 'a.*', '')"},
}


def _pattern_case(kind: str) -> str:
    given = " ".join(f"WHEN {k} THEN {x}" for k, x in _GIVEN[kind].items())
    refused = " ".join(f"WHEN {k} THEN 'rule refused: {x}'" for k, x in _REFUSED[kind].items())
    return f"CASE load_set_id {given} END AS {kind}_value, CASE load_set_id {refused} END AS {kind}_error"


STEPS["pattern_named"] = f"""{PATTERN_SQL.strip()},
named AS (
  SELECT load_set_id, curve_id, {", ".join(map(_pattern_case, ("long", "short", "desc")))}
  FROM (SELECT load_set_id, curve_id, element_name AS note FROM note_curve JOIN note_meta ON object_id = curve_id) x)"""

STEPS["owners"] = """long_owner AS (
  SELECT load_set_id, long_text AS name, min(curve_id) AS owner FROM flags WHERE long_ok
  GROUP BY load_set_id, long_text),
short_owner AS (
  SELECT load_set_id, short_text AS name, min(curve_id) AS owner FROM flags WHERE short_ok
  GROUP BY load_set_id, short_text)"""


def _dup_msg(label: str, owner: str) -> str:
    return (f"'Failed to generate {label} for the curve:' || CAST(f.curve_id AS VARCHAR) || "
            f"' because its result name is same as curve:' || CAST({owner} AS VARCHAR)")


STEPS["checked"] = f"""checked AS (
  SELECT f.load_set_id, f.curve_id,
    CASE WHEN lo.owner <> f.curve_id THEN 'duplicate' ELSE f.long_reason END AS long_reason,
    CASE WHEN lo.owner <> f.curve_id THEN {_dup_msg('long curve name', 'lo.owner')} ELSE f.long_text END AS long_text,
    f.long_ok AND NOT coalesce(lo.owner <> f.curve_id, false) AS long_ok,
    CASE WHEN so.owner <> f.curve_id THEN 'duplicate' ELSE f.short_reason END AS short_reason,
    CASE WHEN so.owner <> f.curve_id THEN {_dup_msg('short curve name', 'so.owner')} ELSE f.short_text END AS short_text,
    f.short_ok AND NOT coalesce(so.owner <> f.curve_id, false) AS short_ok,
    f.desc_reason, f.desc_text
  FROM flags f
  LEFT JOIN long_owner lo ON f.long_ok AND lo.load_set_id = f.load_set_id AND lo.name = f.long_text
  LEFT JOIN short_owner so ON f.short_ok AND so.load_set_id = f.load_set_id AND so.name = f.short_text)"""

STEPS["staged"] = f"""staged AS (
  SELECT curve_id, left(long_text, {CLIP}) AS curve_name, left(short_text, {CLIP}) AS short_curve_name,
         left(desc_text, {CLIP}) AS curve_description, load_set_id,
         CASE WHEN long_ok AND short_ok THEN 'Y' ELSE 'N' END AS is_valid
  FROM checked)"""


# ---------------------------------------------------------------------------
# documents
# ---------------------------------------------------------------------------
def _esc(x: str) -> str:
    for raw, rep in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("''", "&apos;")]:
        x = f"replace({x}, '{raw}', '{rep}')"
    return x


def _doc_steps(scope_set: int | None, mode: str) -> str:
    where = "WHERE object_type_id = 1"
    if scope_set is not None:
        where += f" AND object_id IN (SELECT curve_id FROM load_set_curve WHERE load_set_id = {scope_set})"
    rank_case = "CASE WHEN name = '' THEN NULL " + " ".join(
        f"WHEN attr = '{a}' AND verb = 'is' THEN {i}" for i, (a, _t) in enumerate(SINGLE_ELEMENTS, 1)
    ) + " " + " ".join(
        f"WHEN attr = '{a}' THEN {j}" for j, (a, _n, _c) in enumerate(PAIRED_ELEMENTS, len(SINGLE_ELEMENTS) + 1)
    ) + " END"
    tag_case = "CASE rank " + " ".join(
        f"WHEN {i} THEN '{t}'" for i, (_a, t) in enumerate(SINGLE_ELEMENTS, 1)) + " END"
    clean = mode == "clean"
    val = _esc("name") if clean else "name"
    pv = _esc("p") if clean else "p"
    pairs = []
    for j, (a, ntag, ctag) in enumerate(PAIRED_ELEMENTS, len(SINGLE_ELEMENTS) + 1):
        nm = _esc("name") if clean else "name"
        cd = _esc("code") if clean else "code"
        pairs.append(f"""pairs_{a} AS (
  SELECT curve_id, string_agg({nm}, '|' ORDER BY name, code) AS names,
         string_agg({cd}, '|' ORDER BY name, code) AS codes
  FROM ranked WHERE rank = {j} GROUP BY curve_id)""")
    names_scope = "" if scope_set is None else f" WHERE load_set_id = {scope_set}"
    q = '"' if clean else ""
    if clean:
        def nm_part(c):
            return f"coalesce({_esc('n.' + c)}, '')"
    else:
        def nm_part(c):
            return f"coalesce(n.{c}, 'null')"
    pair_text = " || ".join(
        f"CASE WHEN pr_{a}.names IS NOT NULL THEN '<{ntag}>' || pr_{a}.names || '</{ntag}><{ctag}>' "
        f"|| pr_{a}.codes || '</{ctag}>' ELSE '' END" for a, ntag, ctag in PAIRED_ELEMENTS)
    pair_joins = " ".join(f"LEFT JOIN pairs_{a} pr_{a} ON pr_{a}.curve_id = s.curve_id"
                          for a, _n, _c in PAIRED_ELEMENTS)
    del pv
    return f"""dm AS (
  SELECT object_id AS curve_id, coalesce(attribute, '') AS attr, coalesce(verb, '') AS verb,
         coalesce(element_name, '') AS name, coalesce(ric, '') AS code
  FROM object_meta {where}),
ranked AS (SELECT *, {rank_case} AS rank FROM dm),
sizes AS (SELECT curve_id, count(*) AS n_rows FROM dm GROUP BY curve_id),
singles AS (
  SELECT curve_id, string_agg('<' || tag || '>' || {val} || '</' || tag || '>', '' ORDER BY rank, name) AS singles
  FROM (SELECT *, {tag_case} AS tag FROM ranked WHERE rank <= {len(SINGLE_ELEMENTS)}) t GROUP BY curve_id),
{", ".join(pairs)},
el AS (
  SELECT s.curve_id, s.n_rows, coalesce(g.singles, '') AS singles, {pair_text} AS pair_text
  FROM sizes s LEFT JOIN singles g ON g.curve_id = s.curve_id {pair_joins}),
names_scoped AS (SELECT * FROM curve_name{names_scope}),
docs AS (
  SELECT e.curve_id,
         '<DOC id={q}' || CAST(e.curve_id AS VARCHAR) || '{q} TYPE="CDBTIMESERIES"><Permission>' || CAST(e.curve_id AS VARCHAR) || '</Permission>'
         || CASE WHEN n.curve_id IS NOT NULL THEN '<name>' || {nm_part('curve_name')} || '</name><shortname>'
                 || {nm_part('short_curve_name')} || '</shortname><description>'
                 || {nm_part('curve_description')} || '</description>' ELSE '' END
         || e.singles || e.pair_text || '</DOC>' AS doc
  FROM el e LEFT JOIN names_scoped n ON n.curve_id = e.curve_id)"""


def _with(*steps: str, docs: tuple | None = None) -> str:
    parts = [FIXTURE_SQL.strip(), rules_values_sql()]
    parts += [STEPS[s] for s in steps]
    if docs is not None:
        parts.append(_doc_steps(*docs))
    return "WITH " + ",\n".join(parts) + "\n"


_NAMING = ("entries", "curve_map", "var_map", "curves", "pv", "named")
_NEEDLE = "'\"Geography.in\":'"

ORACLE: dict[str, str] = {
    "scan_meta": _with() + "SELECT object_id, object_type_id, attribute, verb, ric, element_id, element, element_name FROM object_meta",
    "bucket_counts": _with() + "SELECT object_id % 1000 AS partition_id, count(*) AS n_rows FROM object_meta GROUP BY 1",
    "rules_for_set": _with() + """SELECT s.load_set_id, s.curves, r.longname_rule_exp, r.shortname_rule_exp, r.desc_rule_exp,
       r.curvename_status_id
FROM (SELECT load_set_id, count(*) AS curves FROM load_set_curve GROUP BY load_set_id) s
LEFT JOIN curve_rule r ON r.load_set_id = s.load_set_id""",
    "scope_one": _with() + "SELECT curve_id, curve_name, short_curve_name, curve_description, curve_id % 1000 AS partition_id FROM curve_name WHERE load_set_id = 1",
    "scope_all": _with() + "SELECT curve_id, curve_name, short_curve_name, curve_description, curve_id % 1000 AS partition_id FROM curve_name",
    "only_curves": _with() + "SELECT * FROM object_meta WHERE object_type_id = 1",
    "members_of_set": _with() + "SELECT * FROM load_set_curve WHERE load_set_id = 2",
    "null_to_empty": _with() + """SELECT object_id AS curve_id, coalesce(attribute, '') AS attr, coalesce(verb, '') AS verb,
       coalesce(element_name, '') AS name, coalesce(ric, '') AS code FROM object_meta WHERE object_type_id = 1""",
    "default_abbr": _with("entries") + "SELECT * FROM entries",
    "join_members": _with() + """SELECT om.object_type_id, om.attribute, om.verb, om.ric, om.element_id, om.element,
       om.element_name, lsc.load_set_id, lsc.curve_id
FROM object_meta om JOIN load_set_curve lsc ON om.object_id = lsc.curve_id""",
    "semi_members": _with() + "SELECT * FROM object_meta WHERE object_id IN (SELECT curve_id FROM load_set_curve WHERE load_set_id = 1)",
    "doc_attrs": _with(docs=(None, "reference")) + "SELECT curve_id, attr, verb, name, code, rank FROM ranked WHERE rank IS NOT NULL",
    "attr_entries": _with("entries", "entry_text") + "SELECT * FROM entry_text",
    "attr_string": _with("entries", "entry_text", "attr_text") + "SELECT * FROM attr_text",
    "attr_string_cut": _with("entries", "entry_text", "attr_text") + """SELECT load_set_id, curve_id, left(attr, 3000) AS attr,
       length(attr) > 3000 AS truncated FROM attr_text""",
    "attr_map_rows": _with("entries", "curve_map", "var_map") + """SELECT load_set_id, curve_id, 'curve' AS map_name, fkey AS map_key, fullname, shortname, abbr FROM curve_map
UNION ALL SELECT load_set_id, curve_id, 'var', fkey, fullname, shortname, abbr FROM var_map""",
    "parsed_keys": _with("entries", "entry_text", "attr_text") + """SELECT load_set_id, curve_id, CAST(i - 1 AS INTEGER) AS pos,
       translate(split_part(parts[i], '{', 1), '":', '') AS key
FROM (SELECT load_set_id, curve_id, parts, unnest(generate_series(1, len(parts))) AS i
      FROM (SELECT load_set_id, curve_id, string_split(attr, '},') AS parts FROM attr_text) a) b""",
    "nth_position": _with("entries", "entry_text", "attr_text") + f"""SELECT load_set_id, curve_id,
       CASE WHEN len(string_split(attr, {_NEEDLE})) > 2
            THEN CAST(length(array_to_string(list_slice(string_split(attr, {_NEEDLE}), 1, 2), {_NEEDLE})) AS INTEGER)
       END AS pos2
FROM attr_text""",
    "rename_nth": _with("entries", "entry_text", "attr_text") + f"""SELECT load_set_id, curve_id,
       CASE WHEN pos2 IS NULL THEN attr
            ELSE left(attr, pos2) || '"Geography.in1":' || substr(attr, pos2 + length({_NEEDLE}) + 1) END AS attr
FROM (SELECT load_set_id, curve_id, attr,
             CASE WHEN len(string_split(attr, {_NEEDLE})) > 2
                  THEN length(array_to_string(list_slice(string_split(attr, {_NEEDLE}), 1, 2), {_NEEDLE})) END AS pos2
      FROM attr_text) t""",
    "named": _with(*_NAMING) + "SELECT * FROM named",
    "length_flags": _with(*_NAMING, "flags") + "SELECT * FROM flags",
    "valid_long": _with(*_NAMING, "flags") + "SELECT load_set_id, curve_id, long_text AS name FROM flags WHERE long_ok",
    "valid_short": _with(*_NAMING, "flags") + "SELECT load_set_id, curve_id, short_text AS name FROM flags WHERE short_ok",
    "dup_long": _with(*_NAMING, "flags", "owners") + f"""SELECT f.load_set_id, f.curve_id, f.long_text AS name, o.owner,
       {_dup_msg('long curve name', 'o.owner')} AS message
FROM flags f JOIN long_owner o ON o.load_set_id = f.load_set_id AND o.name = f.long_text
WHERE f.long_ok AND o.owner <> f.curve_id""",
    "dup_short": _with(*_NAMING, "flags", "owners") + f"""SELECT f.load_set_id, f.curve_id, f.short_text AS name, o.owner,
       {_dup_msg('short curve name', 'o.owner')} AS message
FROM flags f JOIN short_owner o ON o.load_set_id = f.load_set_id AND o.name = f.short_text
WHERE f.short_ok AND o.owner <> f.curve_id""",
    "staged_names": _with(*_NAMING, "flags", "owners", "checked", "staged") + "SELECT * FROM staged",
    "load_set_report": _with(*_NAMING, "flags", "owners", "checked") + """SELECT load_set_id, count(*) AS curves,
  count(*) FILTER (WHERE long_reason IS NULL) AS long_valid,
  count(*) FILTER (WHERE long_reason = 'no_value') AS long_no_value,
  count(*) FILTER (WHERE long_reason = 'rule_error') AS long_rule_error,
  count(*) FILTER (WHERE long_reason = 'too_long') AS long_too_long,
  count(*) FILTER (WHERE long_reason = 'duplicate') AS long_duplicate,
  count(*) FILTER (WHERE short_reason IS NULL) AS short_valid,
  count(*) FILTER (WHERE short_reason = 'no_value') AS short_no_value,
  count(*) FILTER (WHERE short_reason = 'rule_error') AS short_rule_error,
  count(*) FILTER (WHERE short_reason = 'too_long') AS short_too_long,
  count(*) FILTER (WHERE short_reason = 'duplicate') AS short_duplicate,
  count(*) FILTER (WHERE desc_reason IS NOT NULL) AS desc_failed,
  count(*) FILTER (WHERE long_ok AND short_ok) AS valid_y
FROM checked GROUP BY load_set_id""",
    "status_after": _with(*_NAMING, "flags", "owners", "checked", "staged") + """SELECT r.load_set_id,
  CASE WHEN r.curvename_status_id = 1 AND coalesce(r.longname_rule_exp, '') <> ''
            AND coalesce(r.shortname_rule_exp, '') <> '' AND coalesce(r.desc_rule_exp, '') <> ''
            AND (SELECT count(*) FROM curve_rule o WHERE o.load_set_id = r.load_set_id) = 1 THEN 2
       WHEN r.curvename_status_id = 1 THEN -1
       ELSE r.curvename_status_id END AS curvename_status_id,
  s.staged_rows, s.valid_rows
FROM curve_rule r LEFT JOIN (
  SELECT load_set_id, count(*) AS staged_rows, count(*) FILTER (WHERE is_valid = 'Y') AS valid_rows
  FROM staged GROUP BY load_set_id) s ON s.load_set_id = r.load_set_id""",
    "meta_sizes": _with(docs=(None, "reference")) + "SELECT curve_id, n_rows FROM sizes",
    "doc_elements": _with(docs=(None, "reference")) + "SELECT curve_id, singles FROM el",
    "geography_lists": _with(docs=(None, "reference")) + "SELECT curve_id, names, codes FROM pairs_Geography",
    "facility_lists": _with(docs=(None, "reference")) + "SELECT curve_id, names, codes FROM pairs_Facility",
    "docs_with_names": _with(docs=(None, "reference")) + """SELECT s.curve_id, s.n_rows, n.curve_name, n.short_curve_name,
       n.curve_description FROM sizes s LEFT JOIN curve_name n ON n.curve_id = s.curve_id""",
    "curve_docs": _with(docs=(None, "reference")) + "SELECT curve_id, doc FROM docs",
    "curve_docs_one": _with(docs=(1, "reference")) + "SELECT curve_id, doc FROM docs",
    "curve_docs_clean": _with(docs=(None, "clean")) + "SELECT curve_id, doc FROM docs",
}
_DOCS = _with(docs=(None, "reference"))
_LINES = """lines AS (
  SELECT CAST(((curve_id % 16) + 16) % 16 AS INTEGER) AS bundle, 1 AS seq, curve_id, doc AS value FROM docs),
framed AS (
  SELECT * FROM lines
  UNION ALL SELECT DISTINCT bundle, 0, CAST(NULL AS BIGINT), '<DOCS>' FROM lines
  UNION ALL SELECT DISTINCT bundle, 2, CAST(NULL AS BIGINT), '</DOCS>' FROM lines)
"""
_PARTS = """parts AS (
  SELECT *, CAST(coalesce(sum(n) OVER (PARTITION BY bundle ORDER BY curve_id, doc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 20000 AS INTEGER) AS part
  FROM (SELECT CAST((((((curve_id % 1000003) + 1000003) % 1000003) * 2654435761) >> 12) % 16 AS INTEGER) AS bundle, curve_id, doc, strlen(doc) + 1 AS n FROM docs) b)
"""
ORACLE |= {
    "bundle_lines": _DOCS.rstrip() + ",\n" + _LINES + "SELECT bundle, seq, curve_id, value FROM framed",
    "bundle_files": _DOCS.rstrip() + ",\n" + _PARTS + """SELECT bundle, part, doc AS value FROM parts
UNION ALL SELECT DISTINCT bundle, part, '<DOCS>' FROM parts UNION ALL SELECT DISTINCT bundle, part, '</DOCS>' FROM parts""",
    "bundle_order": _DOCS.rstrip() + ",\n" + _PARTS + """SELECT bundle, part, count(*) AS docs, min(curve_id) AS first_curve, max(curve_id) AS last_curve,
       CAST(sum(n) + 15 AS BIGINT) AS bytes, min(curve_id) AS opened_by, max(curve_id) AS closed_by FROM parts GROUP BY bundle, part""",
    "keyed_docs": ORACLE["curve_docs_one"],
    "staging_table": ORACLE["staged_names"],
    "rule_failures": _with(*_NAMING, "flags") + """SELECT load_set_id, curve_id, long_text, short_text, desc_text
FROM flags WHERE long_reason = 'rule_error' OR short_reason = 'rule_error' OR desc_reason = 'rule_error'""",
    "rule_sets": _with() + """SELECT s.load_set_id, s.curves,
  CASE WHEN r.n > 1 THEN 'Loadset:' || CAST(s.load_set_id AS VARCHAR) || ' has ' || CAST(r.n AS VARCHAR) || ' rule rows'
       WHEN r.long IS NULL THEN 'Loadset:' || CAST(s.load_set_id AS VARCHAR) || ' doesn''t have rule for long curve name'
       WHEN r.short IS NULL THEN 'Loadset:' || CAST(s.load_set_id AS VARCHAR) || ' doesn''t have rule for short curve name'
       WHEN r.descr IS NULL THEN 'Loadset:' || CAST(s.load_set_id AS VARCHAR) || ' doesn''t have rule for curve description'
  END AS error, CASE WHEN r.n > 1 THEN r.n END AS rule_rows
FROM (SELECT load_set_id, count(*) AS curves FROM load_set_curve GROUP BY load_set_id) s
LEFT JOIN (SELECT load_set_id, count(*) AS n, min(longname_rule_exp) AS long, min(shortname_rule_exp) AS short, min(desc_rule_exp) AS descr
           FROM curve_rule GROUP BY load_set_id) r ON r.load_set_id = s.load_set_id""",
}
ORACLE["rule_patterns"] = "WITH " + STEPS["pattern_named"] + ",\n" + STEPS["flags"] + "\nSELECT * FROM flags"
_FAILED = "long_reason = 'rule_error' OR short_reason = 'rule_error' OR desc_reason = 'rule_error'"
ORACLE["rule_failures"] += f"""
UNION ALL SELECT load_set_id, curve_id, long_text, short_text, desc_text FROM ({ORACLE["rule_patterns"]}) p WHERE {_FAILED}"""
ORACLE["numbered_keys"] = ORACLE["attr_map_rows"]
# full maps and the bundle clustering change how, not what
ORACLE["staged_names_skew"] = ORACLE["staged_names"]
ORACLE["staged_names_one"] = ORACLE["staged_names"]
ORACLE["staged_names_colocated"] = ORACLE["staged_names"]
ORACLE["curve_docs_bundled"] = ORACLE["curve_docs"]
