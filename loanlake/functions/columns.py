"""Column expressions used by several operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONTH, YEAR


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The white space characters of Unicode.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(c) -> Column:
    """Text of ``c`` without leading and trailing white space of any sort."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITE_SPACE))


def zfill(c, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` would cut it)."""
    text = _col(c).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def code5(c) -> Column:
    """County or metro code as trimmed five-digit text."""
    return zfill(trimmed(c), 5)


def blank_as_null(c) -> Column:
    return F.when(trimmed(c) != "", _col(c))


def quarter(month=MONTH) -> Column:
    return F.floor((_col(month) - 1) / 3 + 1).cast("tinyint")


def month_date(year=YEAR, month=MONTH) -> Column:
    """First day of the month, null where year or month is out of range."""
    y, m = _col(year).cast("int"), _col(month).cast("int")
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def period(year=YEAR, month=MONTH) -> Column:
    """``YYYY-MM`` text; null where either part is null."""
    return F.concat(_col(year).cast("string"), F.lit("-"), zfill(month, 2))


def lenient_int(c, dtype: str) -> Column:
    """Number text to an integer type; text that is no number becomes null."""
    return _col(c).try_cast("double").try_cast(dtype)
