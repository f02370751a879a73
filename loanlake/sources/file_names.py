"""Snapshot kind, year and month from file names, as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import zfill

# How snapshot files are named.
CANONICAL = r"fha_(sf|hecm)_snapshot_(\d{8})"
YEAR_MONTH = r"(20\d{2})(0[1-9]|1[0-2])"
YEAR_MONTH_DAY = r"(\d{4})(\d{2})(\d{2})"
FOUR_DIGIT_YEAR = r"(20\d{2})"
MONTH_THEN_YEAR = r"(0[1-9]|1[0-2])(\d{2})"
MONTH_FOLDERS = r"year=(\d{4})/(?:[a-z_]*)month=(\d{1,2})$"
KIND_ALIASES = {"sf": "single_family", "single_family": "single_family", "hecm": "hecm"}
KIND_PREFIXES = {"sf": "fha_sf_snapshot_", "hecm": "fha_hecm_snapshot_"}
MONTH_NAMES = {
    "jan": 1,
    "feb": 2,
    "mar": 3,
    "apr": 4,
    "may": 5,
    "jun": 6,
    "jul": 7,
    "jly": 7,
    "aug": 8,
    "sep": 9,
    "oct": 10,
    "nov": 11,
    "dec": 12,
}


def normalize_kind(kind: str) -> str:
    """``single_family`` or ``hecm`` from any accepted alias."""
    try:
        return KIND_ALIASES[kind.lower()]
    except (KeyError, AttributeError):
        raise ValueError(f"Unknown snapshot kind: {kind!r}") from None


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def unit_path(path: Column) -> Column:
    """The snapshot a stored file belongs to: the folder of a ``part-`` file, else the file."""
    return F.regexp_replace(path, r"/part-[^/]*$", "")


def extension(name: Column) -> Column:
    """The last ``.xyz`` of a name, empty if there is none."""
    return F.regexp_extract(name, r"(?<=[^.])(\.[^.]+)$", 1)


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def snapshot_period(path: Column, expected_kind: str | None = None) -> Column:
    """Struct ``kind, year, month, problem`` of a snapshot file.

    The canonical name wins; any other name needs ``expected_kind`` and a ``YYYYMM`` or
    ``year=``/``month=`` folders.  ``problem`` says why a file cannot be used.
    """
    kind = None if expected_kind is None else normalize_kind(expected_kind)
    unit = F.lower(unit_path(path))
    name = base_name(unit)
    tag = _part(name, CANONICAL, 1)
    date = _part(name, CANONICAL, 2)
    found_kind = F.coalesce(
        F.when(tag == "sf", "single_family").when(tag == "hecm", "hecm"), F.lit(kind).cast("string")
    )
    year = F.coalesce(
        F.substring(date, 1, 4), _part(unit, MONTH_FOLDERS, 1), _part(name, YEAR_MONTH, 1)
    ).cast("int")
    month = F.coalesce(
        F.substring(date, 5, 2), _part(unit, MONTH_FOLDERS, 2), _part(name, YEAR_MONTH, 2)
    ).cast("int")
    problem = (
        F.when(found_kind.isNull(), "no snapshot kind in the name")
        .when(year.isNull(), "no year and month in the name")
        .when(~month.between(1, 12), "month out of range")
    )
    if kind is not None:
        problem = F.coalesce(problem, F.when(found_kind != kind, "snapshot kind differs from the expected one"))
    return F.struct(
        found_kind.alias("kind"), year.alias("year"), month.alias("month"), problem.alias("problem")
    )


def is_snapshot(path: Column) -> Column:
    """The file has a canonical name or lies in ``year=``/``month=`` folders."""
    unit = F.lower(unit_path(path))
    return base_name(unit).rlike(CANONICAL) | unit.rlike(MONTH_FOLDERS)


def bronze_period(path: Column) -> Column:
    """Struct ``year, month`` from the first eight digits of a bronze file name."""
    name = base_name(unit_path(path))
    return F.struct(
        _part(name, YEAR_MONTH_DAY, 1).cast("int").alias("year"),
        _part(name, YEAR_MONTH_DAY, 2).cast("int").alias("month"),
    )


def year_in_name(name: Column) -> Column:
    """The only ``20xx`` of a name, else the year of a ``MMYY``; null if unclear."""
    years = F.regexp_extract_all(name, F.lit(FOUR_DIGIT_YEAR), 1)
    short = _part(name, MONTH_THEN_YEAR, 2).cast("int") + 2000
    return F.when(F.size(years) == 1, F.get(years, F.lit(0)).cast("int")).when(F.size(years) == 0, short)


def month_in_name(name: Column) -> Column:
    """Month of the first abbreviation, in calendar order, that the name contains."""
    low = F.lower(name)
    return F.coalesce(*[F.when(low.contains(abbr), F.lit(number)) for abbr, number in MONTH_NAMES.items()])


def period_suffix(path: Column) -> Column:
    """``_YYYYMM``; null where year or month is missing."""
    name = base_name(path)
    return F.concat(F.lit("_"), year_in_name(name).cast("string"), zfill(month_in_name(name), 2))


def standard_file_name(path: Column, kind: str | None, fallback_period: Column | None = None) -> Column:
    """Canonical file name; the original one where no period can be read.

    ``fallback_period`` (``YYYYMM`` text, e.g. of the archive the file came in) is
    used for names without a period of their own.
    """
    name = base_name(path)
    prefix = KIND_PREFIXES.get(kind)
    if prefix is None:
        return name
    month = F.coalesce(month_in_name(name), _part(name, MONTH_THEN_YEAR, 1).cast("int"))
    own = F.concat(year_in_name(name).cast("string"), zfill(month, 2))
    period = own if fallback_period is None else F.coalesce(own, fallback_period)
    return F.coalesce(F.concat(F.lit(prefix), period, F.lit("01"), extension(name)), name)
