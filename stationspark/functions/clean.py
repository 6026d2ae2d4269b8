"""Column expressions: cleaning, derived keys, flag counts, labels.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``
only, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationspark.functions.params import is_numeric
from stationspark.sources.schemas import PARTITION_COLUMN

# Markers inside metric text (fixed values): missing, trace, suspect flag.
MISSING = "M"
TRACE = "T"
SUSPECT = "s"
# A number holds a digit and none of these letters, which type suffixes, words
# and markers hold; text that fails this is not parsed, so it throws nothing.
_MAY_BE_NUMBER = r"^[^0-9DFMNTdfmnt]*+[0-9][^DFMNTdfmnt]*+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def metric(c) -> Column:
    """Metric text -> DOUBLE.

    ``M`` (missing), ``T`` / ``"  T"`` (trace), blanks and any other
    non-number become null; padded numbers such as ``" 0.00"`` parse.
    ``try_cast`` keeps ANSI mode on without failing on the markers, but reads
    ``NaN``, ``Infinity`` and type suffixes (``1d``, ``5f``) as numbers; these
    are no readings and become null too.
    """
    text = _col(c)
    # each step names its input once or twice: a step that is evaluated again, for
    # every metric, makes generated code too large for the JVM to compile
    value = F.when(text.rlike(_MAY_BE_NUMBER), text).try_cast(T.DoubleType())
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def values_of(df: DataFrame):
    """``column name -> DOUBLE``: text of the raw layer is parsed, a numeric
    column of the clean layer is taken as it is, so that filters on it reach
    the scan."""
    def value(name: str) -> Column:
        return F.col(name) if is_numeric(df, name) else metric(name)

    return value


def is_marker(c, marker: str) -> Column:
    """True where the text, ignoring blanks, equals ``marker``."""
    return F.trim(_col(c)) == F.lit(marker)


def hour_bucket(time_col="Time", include_on_hour: bool = False) -> Column:
    """Hour 0..23 of an ``hhmm`` clock value, or null when excluded.

    Default: reading ``t`` belongs to hour ``i`` when ``i*100 < t < (i+1)*100``
    (open interval), so readings exactly on the hour are left out.  With
    ``include_on_hour`` the bucket is ``t div 100`` for ``0 <= t < 2400``.
    """
    t = _col(time_col)
    if include_on_hour:
        keep = (t >= 0) & (t < 2400)
    else:
        keep = (t > 0) & (t < 2400) & (t % 100 != 0)
    return F.when(keep, F.floor(t / 100).cast(T.IntegerType()))


def ymd_to_date(c="YearMonthDay") -> Column:
    """``yyyymmdd`` number -> DATE (null when it is not a calendar day)."""
    return F.try_to_timestamp(_col(c).cast("string"), F.lit("yyyyMMdd")).cast(T.DateType())


def ymd_text(c="YearMonthDay") -> Column:
    """``yyyymmdd`` number -> ``dd/mm/yyyy`` text."""
    return F.date_format(ymd_to_date(c), "dd/MM/yyyy")


def fahrenheit_to_celsius(c, offset: float = 32.0) -> Column:
    """(x - offset) / 1.8; ``offset=31.0`` reproduces the original figures."""
    return (_col(c) - F.lit(float(offset))) / F.lit(1.8)


def month_label(c=PARTITION_COLUMN) -> Column:
    """Month number -> ``01`` ... ``12``."""
    return F.lpad(_col(c).cast("string"), 2, "0")


def hour_label(c="hour") -> Column:
    """Hour number -> ``0:00`` ... ``23:00``."""
    return F.concat(_col(c).cast("string"), F.lit(":00"))


def text_columns(df: DataFrame, exclude=()) -> list[str]:
    """STRING columns of ``df`` that are not in ``exclude`` (plan-time only)."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, T.StringType)]


def flag_count(columns, flag: str = SUSPECT) -> Column:
    """Per row, how many of ``columns`` equal ``flag`` (null counts as 0).

    A left fold of ``CASE WHEN c = flag THEN 1 ELSE 0 END`` terms: one
    expression tree, evaluated in generated code, no array allocation.
    """
    terms = [F.when(_col(c) == F.lit(flag), 1).otherwise(0) for c in columns]
    return reduce(lambda acc, term: acc + term, terms, F.lit(0))
