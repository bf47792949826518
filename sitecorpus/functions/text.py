"""Unicode-exact text helpers.

Python's ``str.strip``/``\\s``/``\\w`` are Unicode-aware, Spark's plain ``trim`` and Java's
plain ``\\w`` are not. These helpers reproduce the Python rules with JVM expressions so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white-space set is derived from its definition (Python's str.isspace), not typed in.
SPACE_CHARS = "".join(c for c in map(chr, range(0x110000)) if c.isspace())

# Java regex classes (used with the (?U) flag where \s appears).
SPACE_CLASS = r"[\s\x1c-\x1f]"
WORD_CLASS = r"[\p{L}\p{N}_]"

# Same classes for RE2 (DuckDB oracles).
SPACE_CLASS_RE2 = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
WORD_CLASS_RE2 = r"[\p{L}\p{N}_]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()`` with no argument."""
    return F.trim(_c(col), F.lit(SPACE_CHARS))


def is_blank(col) -> Column:
    """True when the text is null or only white space (``not s.strip()``)."""
    return F.coalesce(F.length(py_strip(col)) == 0, F.lit(True))


def collapse_spaces(col) -> Column:
    """Runs of white space become one space; ends stripped."""
    return py_strip(F.regexp_replace(_c(col), "(?U)" + SPACE_CLASS + "+", " "))


def slug(col, max_len: int = 50, empty: str = "untitled") -> Column:
    """Folder name for a title: keep word/space/hyphen characters, strip, runs of space or
    hyphen become one hyphen, lower case, cut to ``max_len``; empty becomes ``empty``."""
    kept = F.regexp_replace(_c(col), r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f\-]", "")
    dashed = F.lower(F.regexp_replace(py_strip(kept), r"(?U)[\s\x1c-\x1f\-]+", "-"))
    cut = F.left(dashed, F.lit(max_len))
    return F.when(F.length(cut) == 0, F.lit(empty)).otherwise(cut)


def sql_strip(expr: str) -> str:
    """DuckDB twin of :func:`py_strip` for oracle SQL."""
    chars = SPACE_CHARS.replace("'", "''")
    return f"trim({expr}, '{chars}')"


def sql_slug(expr: str, max_len: int = 50, empty: str = "untitled") -> str:
    """DuckDB twin of :func:`slug` for oracle SQL."""
    kept = (f"regexp_replace({expr}, '[^\\p{{L}}\\p{{N}}_\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}"
            f"\\x{{85}}\\p{{Z}}-]', '', 'g')")
    dashed = (f"lower(regexp_replace({sql_strip(kept)}, '[\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}"
              f"\\x{{85}}\\p{{Z}}-]+', '-', 'g'))")
    return f"(CASE WHEN {dashed} = '' THEN '{empty}' ELSE left({dashed}, {max_len}) END)"


def sql_collapse_spaces(expr: str) -> str:
    return sql_strip(f"regexp_replace({expr}, '{SPACE_CLASS_RE2}+', ' ', 'g')")


def sql_lit(s: str) -> str:
    """A DuckDB string literal."""
    return "'" + s.replace("'", "''") + "'"
