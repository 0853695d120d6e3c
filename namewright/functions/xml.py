"""Column-level pieces of the search document (STR9, XML1 parts)."""

from __future__ import annotations

from namewright.functions.text import sql_str

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal documents
# ---------------------------------------------------------------------------
# Single-valued elements, in the order the reference tests them:
# (attribute, element tag); each needs the verb "is".
SINGLE_ELEMENTS = [
    ("Provider", "Provider"),
    ("Timezone", "Timezone"),
    ("Value.Frequency", "ValueFrequency"),
    ("Status", "Status"),
    ("Unit", "Unit"),
    ("Issue.Frequency", "IssueFrequency"),
    ("Variable", "Variable"),
    ("Commodity", "Commodity"),
    ("Technology", "Technology"),
    ("FacilityType", "PhysicalAssetType"),
    ("Variable.Specification", "VariableSpecification"),
]
SINGLE_VERB = "is"
# Multi-valued elements (any verb): attribute -> (names tag, codes tag)
PAIRED_ELEMENTS = [
    ("Geography", "Geography", "GeographyRCS"),
    ("Facility", "PhysicalAsset", "PhysicalAssetRCS"),
]
PAIR_SEP = "|"
DOC_TYPE = "CDBTIMESERIES"
BUNDLE_OPEN = "<DOCS>"
BUNDLE_CLOSE = "</DOCS>"
# Java string concatenation prints a missing name part as this text
JAVA_NULL = "null"

# XML escapes for the 'clean' mode (ampersand first)
XML_ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")]


def sql_escape(expr: str) -> str:
    """SQL text escaping the XML special characters of ``expr``."""
    for raw, esc in XML_ESCAPES:
        expr = f"replace({expr}, {sql_str(raw)}, {sql_str(esc)})"
    return expr


def sql_doc_open(id_col: str = "curve_id", mode: str = "reference") -> str:
    """``<DOC id=ID TYPE="..."><Permission>ID</Permission>``; 'clean' quotes the id."""
    q = '"' if mode == "clean" else ""
    cid = f"CAST({id_col} AS STRING)"
    return (f"concat({sql_str('<DOC id=' + q)}, {cid}, "
            f"{sql_str(q + ' TYPE=' + chr(34) + DOC_TYPE + chr(34) + '><Permission>')}, {cid}, "
            f"{sql_str('</Permission>')})")


def sql_name_part(col: str, mode: str = "reference") -> str:
    """A name value inside a document: Java prints null as ``null``
    ('reference'); 'clean' prints nothing and escapes."""
    if mode == "clean":
        return f"coalesce({sql_escape(col)}, '')"
    return f"coalesce({col}, {sql_str(JAVA_NULL)})"
