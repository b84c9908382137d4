"""Row predicates; each is True or False, never null."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from printfold.functions.scalars import BLANK, type_head
from printfold.schema import EXCLUDED_NAME, EXCLUDED_TYPES


def lang_is(c: Column, lang: str) -> Column:
    """Same language, letter case aside; null is rejected."""
    return F.lower(c).eqNullSafe(F.lit(lang))


def name_not_like(c: Column, pattern: str) -> Column:
    """No match anywhere, letter case aside; a null name is rejected. ``{blank}`` is any blank."""
    return c.isNotNull() & ~c.rlike("(?i)" + pattern.replace("{blank}", BLANK))


def type_head_not_in(c: Column, heads, sep="—") -> Column:
    """The part before the separator is none of ``heads``; a missing line is kept."""
    return c.isNull() | ~type_head(c, sep).isin(*heads)


def is_valid(lang="lang", name="name", type_line="type_line") -> Column:
    """The three tests a printing must pass to enter the catalogue."""
    return (
        lang_is(F.col(lang), "en")
        & name_not_like(F.col(name), EXCLUDED_NAME)
        & type_head_not_in(F.col(type_line), EXCLUDED_TYPES)
    )


def has_value(c: Column) -> Column:
    """Neither null nor the empty string; both tests reach a Parquet scan."""
    return c.isNotNull() & (c != "")


def has_front() -> Column:
    return has_value(F.col("front"))


def only_new(status="status") -> Column:
    return F.col(status).eqNullSafe(F.lit("new"))


def require_not_null(c: Column, name: str) -> Column:
    """The value itself; a null fails the job."""
    return F.coalesce(c, F.raise_error(F.lit(f"{name} is null")).cast("string"))
