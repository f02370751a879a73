"""County names and county codes."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import code5
from ..schemas import COUNTY, FIPS, STATE
from ..sources.checkpoints import cut_lineage
from .cleaning import quoted, union_all

# Rows filed under Alaska that belong to another state.
ALASKA_STATES = {"ANNE ARUNDEL": "MD", "BUNCOMBE": "NC", "EL PASO": "TX"}

# County spellings to correct, by state.
COUNTY_FIXES = {
    ("AK", "MATANUSKA SUSITNA"): "MATANUSKA-SUSITNA",
    ("AL", "DE KALB"): "DEKALB",
    ("IL", "DE KALB"): "DEKALB",
    ("IN", "DE KALB"): "DEKALB",
    ("IL", "DU PAGE"): "DUPAGE",
    ("IL", "LA SALLE"): "LASALLE",
    ("IN", "LA SALLE"): "LASALLE",
    ("IN", "LA PORTE"): "LAPORTE",
    ("IN", "ST JOSEPH"): "ST. JOSEPH",
    ("GA", "MACON-BIBB COUNTY"): "BIBB",
    ("LA", "ST JOHN THE BAPTIST"): "ST. JOHN THE BAPTIST",
    ("MO", "STE GENEVIEVE"): "SAINTE GENEVIEVE",
    ("MS", "DE SOTO"): "DESOTO",
    ("PR", "BAYAM'N"): "BAYAMON",
    ("WI", "LACROSSE"): "LA CROSSE",
    ("CO", "LAPLATA"): "LA PLATA",
    ("IL", "DEWITT"): "DE WITT",
    ("PR", "CAN'VANAS"): "CANOVANAS",
}

# Codes the county reference does not resolve by name.
FIPS_OVERRIDES = {
    ("DC", "WASHINGTON"): "11001",
    ("DC", "DISTRICT OF COLUMBIA"): "11001",
}

# Kinds of county-level areas, as their names end.
AREA_SUFFIX = (
    " (county|city and borough|city|borough|census area|municipio|municipality|district|parish)$"
)
ABBREVIATIONS = {"ft. ": "fort ", "st. ": "saint ", "ste. ": "sainte "}


def _literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def standardize_counties(df: DataFrame, *, state_col: str = STATE, county_col: str = COUNTY) -> DataFrame:
    """Upper-case county names in the spelling of the county reference.

    Order matters: misfiled states, then spellings by state or the `` COUNTY`` ending,
    then the prefixes ``ST`` and ``STE``.
    """
    name = quoted(county_col)
    missing = name.isNull() | F.lower(name).isin("nan", "none")
    df = df.withColumn(county_col, F.when(missing, "").otherwise(F.upper(name)))
    county, state = quoted(county_col), quoted(state_col)
    moved = _literal_map(ALASKA_STATES)[county]
    df = df.withColumn(state_col, F.coalesce(F.when(state == "AK", moved), state))
    fixes = _literal_map({f"{s}|{c}": fixed for (s, c), fixed in COUNTY_FIXES.items()})
    fixed = fixes[F.concat(state, F.lit("|"), county)]
    df = df.withColumn(county_col, F.coalesce(fixed, F.regexp_replace(county, " COUNTY$", "")))
    return df.withColumn(
        county_col,
        F.when(county.startswith("ST "), F.concat(F.lit("ST. "), F.substr(county, F.lit(4))))
        .when(county.startswith("STE "), F.concat(F.lit("SAINTE "), F.substr(county, F.lit(5))))
        .otherwise(county),
    )


def lookup_key(county: Column) -> Column:
    """Lower-case name without accents and apostrophes."""
    return F.translate(F.lower(county), "ñóíáüéîèàìå'", "noiaueieaia")


def county_lookup(reference: DataFrame) -> DataFrame:
    """``state, key, fips`` for every way a reference county may be written.

    ``reference`` has the columns ``state, county, fips``.  A county is found by its
    full name, without its kind of area, and with the first word abbreviated or not.
    """
    full = lookup_key(F.col("county"))
    bare = F.regexp_replace(full, AREA_SUFFIX, "")
    names = [full, bare]
    for short, long in ABBREVIATIONS.items():
        for a, b in ((short, long), (long, short)):
            for name in (full, bare):
                swapped = F.concat(F.lit(b), F.substr(name, F.lit(len(a) + 1)))
                names.append(F.when(name.startswith(a), swapped))
    return (
        reference.select(
            F.upper("state").alias("state"),
            F.explode(F.array_compact(F.array(*names))).alias("key"),
            code5("fips").alias("fips"),
        )
        .groupBy("state", "key")
        .agg(F.max("fips").alias("fips"))
    )


def add_county_fips(
    df: DataFrame,
    reference: DataFrame,
    *,
    state_col: str = STATE,
    county_col: str = COUNTY,
    fips_col: str = FIPS,
) -> DataFrame:
    """Standardise county names and attach their codes; unknown counties get null."""
    lookup = county_lookup(reference).select(
        F.col("state").alias("_state"), F.col("key").alias("_key"), F.col("fips").alias(fips_col)
    )
    df = standardize_counties(df.drop(fips_col), state_col=state_col, county_col=county_col)
    same = (F.upper(quoted(state_col)) == F.col("_state")) & (lookup_key(quoted(county_col)) == F.col("_key"))
    # The counties of a country, some thousand; loans are not dealt by them.
    return df.join(F.broadcast(lookup), same, "left").drop("_state", "_key")


def _pairs(frame: DataFrame, state_col: str, county_col: str) -> DataFrame:
    pairs = frame.select(
        quoted(state_col).cast("string").alias(state_col), quoted(county_col).cast("string").alias(county_col)
    )
    # Distinct first: the fixes then run on pairs, not on loans.
    pairs = standardize_counties(pairs.distinct(), state_col=state_col, county_col=county_col)
    return pairs.withColumn(state_col, F.upper(quoted(state_col)))


def county_pairs(frames: list[DataFrame], *, state_col: str = STATE, county_col: str = COUNTY) -> DataFrame:
    """Distinct standardised state and county pairs of several tables."""
    pairs = union_all([_pairs(f, state_col, county_col) for f in frames])
    return pairs.filter((quoted(state_col) != "") & (quoted(county_col) != "")).distinct()


def new_county_pairs(pairs: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs a crosswalk does not have yet."""
    return pairs.join(existing.select(*keys).distinct(), keys, "left_anti")


def resolve_counties(
    pairs: DataFrame,
    reference: DataFrame,
    overrides: Mapping[tuple[str, str], str] | None = None,
    *,
    state_col: str = STATE,
    county_col: str = COUNTY,
    fips_col: str = FIPS,
) -> DataFrame:
    """Attach codes to pairs: manual overrides first, then the reference; else null."""
    manual = dict(FIPS_OVERRIDES)
    manual.update({(s.upper(), c.upper()): code for (s, c), code in (overrides or {}).items()})
    by_hand = _literal_map({f"{s}|{c}": code for (s, c), code in manual.items()})[
        F.concat(quoted(state_col), F.lit("|"), quoted(county_col))
    ]
    lookup = county_lookup(reference).select(
        F.col("state").alias("_state"), F.col("key").alias("_key"), F.col("fips").alias("_fips")
    )
    same = (quoted(state_col) == F.col("_state")) & (lookup_key(quoted(county_col)) == F.col("_key"))
    return (
        pairs.join(lookup, same, "left")
        .withColumn(fips_col, code5(F.coalesce(F.nullif(by_hand, F.lit("")), F.col("_fips"))))
        .drop("_state", "_key", "_fips")
    )


def keep_first_source(df: DataFrame, keys: list[str], priority: str, tie: str) -> DataFrame:
    """One row per key: the lowest ``priority``, then the smallest ``tie``."""
    order = Window.partitionBy(*keys).orderBy(priority, tie)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank", priority)


def build_county_crosswalk(
    frames: list[DataFrame],
    reference: DataFrame,
    *,
    existing: DataFrame | None = None,
    problematic: DataFrame | None = None,
    overrides: Mapping[tuple[str, str], str] | None = None,
    state_col: str = STATE,
    county_col: str = COUNTY,
    fips_col: str = FIPS,
) -> tuple[DataFrame, DataFrame]:
    """Extend a county crosswalk by the counties of bronze tables.

    Returns ``(crosswalk, problematic)``.  Known pairs keep their code; earlier
    problem pairs are dropped once they are resolved.  The distinct pairs are written
    once, so that the bronze tables are read once for both results.
    """
    keys = [state_col, county_col]
    names = {"state_col": state_col, "county_col": county_col}

    def standardized(df: DataFrame) -> DataFrame:
        return standardize_counties(df, **names).withColumn(state_col, F.upper(quoted(state_col)))

    pairs = cut_lineage(county_pairs(frames, **names))
    sources = []
    if existing is not None:
        existing = standardized(existing).withColumn(fips_col, code5(quoted(fips_col)))
        pairs = new_county_pairs(pairs, existing, keys)
        sources.append(existing.select(*keys, fips_col).withColumn("_source", F.lit(0)))
    resolved = resolve_counties(pairs, reference, overrides, fips_col=fips_col, **names)
    found = resolved.filter(quoted(fips_col).isNotNull())
    sources.append(found.select(*keys, fips_col).withColumn("_source", F.lit(1)))
    crosswalk = keep_first_source(union_all(sources), keys, "_source", fips_col)
    problems = resolved.filter(quoted(fips_col).isNull()).select(*keys)
    if problematic is not None:
        earlier = standardized(problematic).select(*keys).join(crosswalk.select(*keys), keys, "left_anti")
        problems = problems.unionByName(earlier).distinct()
    return crosswalk.orderBy(*keys), problems.orderBy(*keys)
