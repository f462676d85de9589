"""Column expressions: text, keys, numbers kept as text, URLs, JSON, bins.

Every function takes and returns a `Column`; nothing here leaves the JVM.
Missing JSON keys and blank text are null throughout.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(24,6)"
OPEN_END = "9999-12-31"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


# --- text and keys ---------------------------------------------------------

def blank_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(F.trim(c) != "", c)


def email_key(c: str | Column) -> Column:
    """Key of an e-mail address, the same for case and space variants."""
    return F.md5(F.lower(F.trim(col(c))))


def source_key(source: str, c: str | Column) -> Column:
    """Hash key of an id inside one source; a null id stays null."""
    return F.md5(F.concat(F.lit(f"{source}-"), col(c).cast("string")))


def before(c: str | Column, mark: str) -> Column:
    """Text before the first `mark`, the whole text when there is none."""
    return F.split_part(col(c), F.lit(mark), F.lit(1))


def number_id(c: str | Column) -> Column:
    """'123.0' to '123'; blank when the text has no dot."""
    c = col(c)
    return F.when(F.instr(c, ".") > 0, before(c, ".")).when(c.isNotNull(), F.lit(""))


def letters_digits(c: str | Column) -> Column:
    return F.regexp_replace(col(c), "[^0-9a-zA-Z]", "")


def like_any(c: str | Column, patterns: Iterable[str]) -> Column:
    """Case-insensitive match of any LIKE pattern; null text stays null."""
    c = col(c)
    tests = [c.ilike(p) for p in patterns]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Ordered rules; the first true condition gives the value."""
    out = None
    for test, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(test, value) if out is None else out.when(test, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return default if out is None else out.otherwise(default)


def mapped(c: str | Column, values: Mapping[str, object], default: object = None) -> Column:
    c = col(c)
    return first_match([(c == F.lit(k), v) for k, v in values.items()], default)


# --- numbers kept as text --------------------------------------------------

def parse_number(c: str | Column) -> Column:
    """'$1,234.50' to 1234.5; blank or unreadable text to null."""
    return F.regexp_replace(blank_to_null(c), r"[,$]", "").try_cast("double")


def parse_money(c: str | Column) -> Column:
    return F.regexp_replace(blank_to_null(c), r"[,$]", "").try_cast(MONEY)


def parse_whole(c: str | Column) -> Column:
    """Integer part of a number kept as text: '$12.9' to 12."""
    return before(F.regexp_replace(blank_to_null(c), r"[,$]", ""), ".").try_cast("int")


def parse_date(c: str | Column) -> Column:
    return blank_to_null(c).try_cast("date")


def parse_timestamp(c: str | Column) -> Column:
    """Timestamp text; an offset such as -05:00 is moved to UTC."""
    return blank_to_null(c).try_cast("timestamp")


def money(c: str | Column) -> Column:
    return col(c).cast(MONEY)


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """top / bottom as a double, null when bottom is 0 or null."""
    bottom = col(bottom).cast("double")
    return col(top).cast("double") / F.nullif(bottom, F.lit(0.0))


def growth(now: str | Column, then: str | Column) -> Column:
    return ratio(now, then) - F.lit(1.0)


def flag(c: Column) -> Column:
    """Boolean to 1/0; null stays null."""
    return c.cast("int")


def binned(c: str | Column, bounds: Sequence[int]) -> Column:
    """Labels '< 50', '50 - 100', ..., '200+' from ascending bounds."""
    c = col(c)
    out = F.when(c < bounds[0], F.lit(f"< {bounds[0]}"))
    for low, high in zip(bounds, bounds[1:]):
        out = out.when((c >= low) & (c < high), F.lit(f"{low} - {high}"))
    return out.when(c >= bounds[-1], F.lit(f"{bounds[-1]}+"))


# --- dates -----------------------------------------------------------------

def epoch_second(c: str | Column) -> Column:
    """Whole epoch second, so that a difference counts second boundaries."""
    return F.unix_timestamp(col(c).cast("timestamp"))


def month_of(c: str | Column) -> Column:
    return F.trunc(col(c).cast("date"), "month")


def week_of(c: str | Column) -> Column:
    return F.trunc(col(c).cast("date"), "week")


def earliest(*cols: str | Column) -> Column:
    """Earliest of the non-null dates; null when all are null."""
    return F.least(*[col(c) for c in cols])


def greatest_of(cols: Sequence[str | Column]) -> Column:
    """`greatest`, which needs two inputs, for one or more columns."""
    cols = [col(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def iso_utc(c: str | Column) -> Column:
    """ISO text in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(col(c).cast("timestamp"), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


# --- URLs ------------------------------------------------------------------

def url_parameter(c: str | Column, name: str) -> Column:
    return blank_to_null(F.try_parse_url(col(c), F.lit("QUERY"), F.lit(name)))


def url_path(c: str | Column) -> Column:
    """Lower-case URL without scheme, host and query string."""
    bare = F.regexp_replace(col(c), r"^https?://[^/]*/", "/")
    return F.lower(F.regexp_replace(bare, r"\?.*", ""))


def page_handle(c: str | Column, folder: str = "products/") -> Column:
    """Last path part after `folder`; null when more path follows."""
    tail = F.regexp_replace(F.regexp_replace(col(c), f".*{folder}", ""), r"\?.*", "")
    return F.when(~tail.contains("/"), tail)


def after_parameter(c: str | Column, name: str) -> Column:
    """Value after the last `name=` in the URL, up to the next '&'; null without one."""
    return blank_to_null(F.regexp_extract(col(c), f".*{name}=([^&]*)", 1))


# --- JSON text -------------------------------------------------------------

def json_text(c: str | Column, key: str) -> Column:
    return blank_to_null(F.get_json_object(col(c), f"$.{key}"))


def json_rows(c: str | Column, fields: str) -> Column:
    """JSON array text to an array of structs; malformed text to null."""
    return F.from_json(col(c), f"array<struct<{fields}>>")


def json_first(c: str | Column, fields: str) -> Column:
    """First element of a JSON array, null for null, [] or malformed text."""
    return F.try_element_at(json_rows(c, fields), F.lit(1))
