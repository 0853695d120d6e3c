"""Column-level text helpers: attribute entries, keys, occurrence search,
length checks, failure messages, clipping.

All are built-in Spark expressions (JVM side, whole-stage codegen); nothing
here runs Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results
# ---------------------------------------------------------------------------
# name limits (characters), and the storage width of every staged text
LONG_NAME_MAX = 64
SHORT_NAME_MAX = 32
STORED_TEXT_MAX = 4000
# width of the aggregated attribute text read by the staging scan
ATTR_TEXT_MAX = 4000
# characters removed from an attribute key to make a rule variable name
KEY_DROP_CHARS = '.":'
# default abbreviation when the dictionary has none
ABBR_DEFAULT = " "
# kind labels used inside failure messages, and the texts around them
KIND_LABEL = {
    "long": "long curve name",
    "short": "short curve name",
    "desc": "description",
}
MSG_PREFIX = "Failed to generate "
MSG_FOR_CURVE = " for the curve:"
MSG_EXCEPTION = " because of exception:"
MSG_TOO_LONG_A = " because its result name "
MSG_TOO_LONG_B = " is longer than "
MSG_TOO_LONG_C = " characters"
MSG_SAME_AS = " because its result name is same as curve:"
# whole-entity failure (attribute text unusable); the description text keeps
# the reference's spelling
MSG_WHOLE_NAME = "Failed to generate curve name for the curve:"
MSG_WHOLE_DESC = "Failed to generate descripton for the curve:"
# our own reason texts (engine messages cannot match the reference's)
REASON_NO_VALUE = "rule returned no value"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_if_null(c) -> Column:
    """FLT3: null becomes the empty string."""
    return F.coalesce(_c(c), F.lit(""))


def default_abbr(c) -> Column:
    """FLT4: ``nvl(abbr, ' ')`` where an empty string counts as null (Oracle)."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(ABBR_DEFAULT))


def attr_key(attribute, verb) -> Column:
    """Raw key ``attribute.verb``; a null part is empty (Oracle ``||``)."""
    return F.concat(empty_if_null(attribute), F.lit("."), empty_if_null(verb))


def attr_entry(key, fullname, shortname, abbr) -> Column:
    """STR1: one serialised attribute entry, as the staging scan builds it:
    ``"KEY":{fullname:"..",shortname:"..",abbr:".."}``."""
    return F.concat(
        F.lit('"'), empty_if_null(key), F.lit('":{fullname:"'), empty_if_null(fullname),
        F.lit('",shortname:"'), empty_if_null(shortname),
        F.lit('",abbr:"'), empty_if_null(abbr), F.lit('"}'),
    )


def normalize_key(c) -> Column:
    """STR3: key to variable name (drop ``.``, ``"`` and ``:``)."""
    return F.translate(_c(c), KEY_DROP_CHARS, "")


def entry_keys(attr_text) -> Column:
    """STR2: parse a serialised attribute text back into its raw keys.

    Split on ``},``, take the text before the first ``{`` of each piece and
    drop quotes and colons.  Like the reference, a value holding ``},`` or
    ``{`` breaks this parse; the naming path never parses text (it keeps
    attributes as map columns), so this is only used for inspection."""
    pieces = F.split(_c(attr_text), "[}],")
    return F.transform(pieces, lambda p: F.translate(F.substring_index(p, "{", 1), '":', ""))


def nth_position(c, needle: str, n: int) -> Column:
    """STR4: 0-based position of the n-th occurrence of the literal ``needle``
    in ``c``; null when there are fewer than n occurrences."""
    if n < 1:
        raise ValueError("n starts at 1")
    parts = F.split(_c(c), re.escape(needle))
    head = F.array_join(F.slice(parts, 1, n), needle)
    return F.when(F.size(parts) > n, F.length(head))


def rename_nth(c, needle: str, n: int, replacement: str) -> Column:
    """STR5: replace the n-th occurrence of ``needle`` by ``replacement``;
    unchanged when there are fewer than n occurrences."""
    pos = nth_position(c, needle, n)
    col = _c(c)
    return F.when(pos.isNull(), col).otherwise(
        F.concat(F.left(col, pos), F.lit(replacement),
                 _tail(col, pos + F.lit(len(needle) + 1)))
    )


def _tail(col: Column, start: Column) -> Column:
    """Text from 1-based position ``start`` to the end."""
    return F.substr(col, start, F.length(col))


def clip(c, width: int = STORED_TEXT_MAX) -> Column:
    """STR8: cut text to ``width`` characters for storage."""
    return F.left(_c(c), F.lit(width))


# ---------------------------------------------------------------------------
# STR7: the messages as SQL text (one expression per column keeps plan
# building to a single call on the driver)
# ---------------------------------------------------------------------------
def sql_str(s: str) -> str:
    """A SQL string literal (backslash escapes, as Spark SQL reads them)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_head(kind: str, curve_id: str) -> str:
    return f"{sql_str(MSG_PREFIX + KIND_LABEL[kind] + MSG_FOR_CURVE)}, CAST({curve_id} AS STRING)"


def sql_msg_exception(kind: str, curve_id: str, reason: str) -> str:
    return f"concat({_sql_head(kind, curve_id)}, {sql_str(MSG_EXCEPTION)}, {reason})"


def sql_msg_too_long(kind: str, curve_id: str, name: str, limit: int) -> str:
    return (f"concat({_sql_head(kind, curve_id)}, {sql_str(MSG_TOO_LONG_A)}, {name}, "
            f"{sql_str(MSG_TOO_LONG_B + str(limit) + MSG_TOO_LONG_C)})")


def sql_msg_duplicate(kind: str, curve_id: str, owner_id: str) -> str:
    return (f"concat({_sql_head(kind, curve_id)}, {sql_str(MSG_SAME_AS)}, "
            f"CAST({owner_id} AS STRING))")


def sql_msg_whole(kind: str, curve_id: str, reason: str) -> str:
    head = MSG_WHOLE_DESC if kind == "desc" else MSG_WHOLE_NAME
    return f"concat({sql_str(head)}, CAST({curve_id} AS STRING), {sql_str(MSG_EXCEPTION)}, {reason})"
