"""Column-expression helpers: every function returns a JVM-side ``Column``.

Nothing here runs Python per row; the expressions stay inside whole-stage
codegen and compose with Catalyst's pruning and pushdown.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text tokens a pandas CSV scan reads as missing. A single
# blank is not among them; it stays a value of a text column.
DEFAULT_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# A plain decimal number with optional sign and exponent, surrounding blanks allowed.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> str:
    """Backtick-quote a column name for use inside SQL expressions."""
    return "`" + name.replace("`", "``") + "`"


def null_if_token(c: str | Column, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """Text -> null when it equals one of the missing-value tokens."""
    c = col_of(c)
    toks = list(tokens)
    if not toks:
        return c
    return F.when(c.isin(toks), F.lit(None).cast("string")).otherwise(c)


def to_double(c: str | Column) -> Column:
    """Text -> double; anything that is not a plain number becomes null.

    ``try_cast`` alone also accepts 'inf', 'NaN' and suffixed forms like '12d',
    so it is guarded by a numeric pattern. Non-string input is cast directly.
    """
    c = col_of(c)
    text = c.cast("string")
    return F.when(text.rlike(NUMERIC_TEXT), F.trim(text).try_cast("double"))


def lookup(c: str | Column, mapping: Mapping) -> Column:
    """Exact lookup in a literal map; keys not present (and null) give null."""
    if not mapping:
        return F.lit(None)
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, col_of(c))


def safe_div(a: Column, b: Column) -> Column:
    """a / b with null (not an error) when b is 0 or null."""
    return F.try_divide(a, b)


def zero_div(a: Column, b: Column) -> Column:
    """a / b with 0 when b is 0, the convention of classification reports."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def fmt1(c: Column) -> Column:
    """Number -> text with one decimal place, as '%.1f' (null -> 'nan')."""
    d = c.cast("double")
    # Java formats a null argument as 'null' cut to the precision ('n'), so test first
    return F.when(d.isNull(), F.lit("nan")).otherwise(F.format_string("%.1f", d))
