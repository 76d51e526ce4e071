"""Text rules: blanks, rendering, sheet names, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ERROR_PATTERN = "#XL_EVAL_ERROR#"  # default text of an error cell
MAX_SHEET_NAME = 31
ILLEGAL_SHEET_CHARS = r"[\[\]/?*\\:]"  # [ ] / ? * \ :
LEGACY_ILLEGAL_CHARS = r'[\\/:*?"<>|\[\]]'  # \ / : * ? " < > | [ ]
LEGACY_MAX_NAME = 25  # longer legacy names keep 22 characters and get "..."
LEGACY_KEEP = 22
DEFAULT_SHEET_PREFIX = "default_"

# Java's String.trim removes every char <= U+0020; Spark's trim only removes spaces.
_BLANK = r"^[\x00-\x20]*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_BLANK_CHARS = "".join(chr(i) for i in range(0x21))  # every char <= U+0020, as Java's trim


def is_blank(x) -> Column:
    """Empty after removing chars <= U+0020 from both ends (a trim, no regex per value)."""
    return F.length(F.btrim(_col(x), F.lit(_BLANK_CHARS))) == 0


def blank_to_null(x) -> Column:
    """C14: text that is empty after trimming -> NULL."""
    s = _col(x)
    return F.when(~is_blank(s), s)


def java_trim(x) -> Column:
    return F.regexp_replace(_col(x), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def render_number(x, bit) -> Column:
    """C18 for numbers: INT/LONG cells print without '.0'; doubles as Java prints them."""
    v = _col(x)
    from .types import BIT_INT, BIT_LONG

    b = _col(bit) if not isinstance(bit, int) else F.lit(bit)
    return F.when((b == BIT_INT) | (b == BIT_LONG), v.cast("long").cast("string")).otherwise(
        v.cast("string")
    )


def render_bool(x) -> Column:
    return F.when(_col(x), F.lit("true")).when(~_col(x), F.lit("false"))


def valid_sheet_name(x) -> Column:
    """Not blank, at most 31 characters, none of [ ] / ? * \\ :"""
    s = _col(x)
    return (
        s.isNotNull()
        & ~is_blank(s)
        & (F.length(s) <= MAX_SHEET_NAME)
        & ~s.rlike(ILLEGAL_SHEET_CHARS)
    )


def sheet_name_problem(x) -> Column:
    """C22 as a word for what is wrong (NULL when the name is fine)."""
    s = _col(x)
    return (
        F.when(s.isNull() | is_blank(s), F.lit("blank"))
        .when(F.length(s) > MAX_SHEET_NAME, F.lit("too long"))
        .when(s.rlike(ILLEGAL_SHEET_CHARS), F.lit("illegal character"))
    )


def continuation_sheet_name(name, i) -> Column:
    """C23: '<name> (i)'; NULL when the result exceeds 31 characters (callers raise)."""
    out = F.concat(_col(name), F.lit(" ("), _col(i).cast("string") if not isinstance(i, int) else F.lit(str(i)), F.lit(")"))
    return F.when(F.length(out) <= MAX_SHEET_NAME, out)


def legacy_sheet_name(x) -> Column:
    """Names over 25 characters keep 22 and get '...'; illegal characters become '_'."""
    s = _col(x)
    cut = F.when(F.length(s) > LEGACY_MAX_NAME, F.concat(F.substring(s, 1, LEGACY_KEEP), F.lit("..."))).otherwise(s)
    return F.regexp_replace(cut, LEGACY_ILLEGAL_CHARS, "_")


def default_sheet_name(i) -> Column:
    """Default names default_1, default_2, ... for the i-th (0-based) input table."""
    return F.concat(F.lit(DEFAULT_SHEET_PREFIX), (_col(i) + 1).cast("string"))


def missing_as(x, pattern: str | None) -> Column:
    """Value rendered for a missing cell on write (NULL = leave the cell blank)."""
    return F.coalesce(_col(x).cast("string"), F.lit(pattern)) if pattern is not None else _col(x)


def nullif_pattern(x, pattern: str) -> Column:
    """Legacy read rule, a cell equal to the missing pattern is missing."""
    return F.when(_col(x) != F.lit(pattern), _col(x))


def lenient(x, type_name: str) -> Column:
    """Legacy lenient conversion, unparsable -> missing."""
    return _col(x).try_cast(type_name)


def path_extension(path) -> Column:
    """Lower-case extension without the dot ('' when none)."""
    return F.lower(F.regexp_extract(_col(path), r"\.([^./\\]+)$", 1))


def file_name(path) -> Column:
    return F.regexp_extract(_col(path), r"([^/\\]+)$", 1)


def unique_names(names: list[str]) -> list[str]:
    """Later duplicates get _2, _3, ... (skipping names already taken)."""
    taken: set[str] = set()
    out = []
    for nm in names:
        cand, k = nm, 1
        while cand in taken:
            k += 1
            cand = f"{nm}_{k}"
        taken.add(cand)
        out.append(cand)
    return out
