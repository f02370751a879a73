import pytest

from conftest import rows_of
from loanlake import schemas as s
from loanlake.operators import counties

NAMES = [s.STATE, s.COUNTY]


def pairs(spark, *rows):
    return spark.createDataFrame(rows, f"`{s.STATE}` string, `{s.COUNTY}` string")


@pytest.fixture(scope="module")
def reference(spark):
    rows = [
        ("CA", "Los Angeles County", "6037"), ("CA", "Orange County", "06059"), ("PR", "Bayamón Municipio", "72021"),
        ("MD", "Baltimore County", "24005"), ("MD", "Baltimore city", "24510"), ("MN", "St. Louis County", "27137"),
        ("MO", "Ste. Genevieve County", "29186"), ("LA", "Orleans Parish", "22071"), ("TX", "El Paso County", "48141"),
    ]
    return spark.createDataFrame(rows, "state string, county string, fips string")


@pytest.mark.parametrize(
    "given, expected",
    [
        (("AK", "EL PASO"), ("TX", "EL PASO")),
        (("AK", "Anne Arundel"), ("MD", "ANNE ARUNDEL")),
        (("IL", "DU PAGE"), ("IL", "DUPAGE")),
        (("MO", "STE GENEVIEVE"), ("MO", "SAINTE GENEVIEVE")),
        (("LA", "ST JOHN THE BAPTIST"), ("LA", "ST. JOHN THE BAPTIST")),
        (("CA", "Orange County"), ("CA", "ORANGE")),
        (("MN", "ST LOUIS"), ("MN", "ST. LOUIS")),
        (("GA", "Macon-Bibb County"), ("GA", "BIBB")),
        (("PR", "Bayam'n"), ("PR", "BAYAMON")),
        (("CA", None), ("CA", "")),
        (("CA", "nan"), ("CA", "")),
        (("CO", "STEAMBOAT"), ("CO", "STEAMBOAT")),
        (("MO", "STE FOO COUNTY"), ("MO", "SAINTE FOO")),
        ((None, "DE KALB"), (None, "DE KALB")),
        (("AL", "de kalb"), ("AL", "DEKALB")),
    ],
)
def test_standardize(spark, given, expected):
    assert rows_of(counties.standardize_counties(pairs(spark, given))) == [expected]


def test_add_county_fips(spark, reference):
    df = pairs(
        spark, ("CA", "Los Angeles County"), ("PR", "Bayam'n"), ("MD", "Baltimore"), ("MD", "Baltimore County"),
        ("MN", "ST LOUIS"), ("MO", "STE GENEVIEVE"), ("LA", "Orleans"), ("AK", "EL PASO"), ("ZZ", "Unknown"),
        ("CA", None),
    )
    got = {(r[0], r[1]): r[2] for r in rows_of(counties.add_county_fips(df, reference))}
    assert got == {
        ("CA", "LOS ANGELES"): "06037",
        ("PR", "BAYAMON"): "72021",
        ("MD", "BALTIMORE"): "24510",  # the city and the county share the bare name
        ("MN", "ST. LOUIS"): "27137",
        ("MO", "SAINTE GENEVIEVE"): "29186",
        ("LA", "ORLEANS"): "22071",
        ("TX", "EL PASO"): "48141",
        ("ZZ", "UNKNOWN"): None,
        ("CA", ""): None,
    }


def test_fips_join_keeps_every_row(spark, reference):
    df = pairs(spark, *[("CA", "ORANGE")] * 7, *[("XX", "Y")] * 3)
    assert counties.add_county_fips(df, reference).count() == 10


def test_crosswalk_end_to_end(spark, reference):
    single_family = pairs(spark, ("CA", "Los Angeles County"), ("CA", "Orange"), ("DC", "Washington"))
    hecm = pairs(spark, ("PR", "Bayam'n"), ("ZZ", "Unknown"))
    existing = spark.createDataFrame([("CA", "ORANGE", "06059")], f"`{s.STATE}` string, `{s.COUNTY}` string, FIPS string")
    crosswalk, problems = counties.build_county_crosswalk(
        [single_family, hecm],
        reference,
        existing=existing,
        problematic=pairs(spark, ("PR", "BAYAMON")),
        overrides={("dc", "Washington"): "11001"},
    )
    assert rows_of(crosswalk) == [
        ("CA", "LOS ANGELES", "06037"), ("CA", "ORANGE", "06059"), ("DC", "WASHINGTON", "11001"),
        ("PR", "BAYAMON", "72021"),
    ]
    assert rows_of(problems) == [("ZZ", "UNKNOWN")]


def test_crosswalk_keeps_known_codes_and_open_problems(spark, reference):
    existing = spark.createDataFrame([("ca", "Orange County", "1")], f"`{s.STATE}` string, `{s.COUNTY}` string, FIPS string")
    crosswalk, problems = counties.build_county_crosswalk(
        [pairs(spark, ("CA", "ORANGE"), ("", "X"), ("CA", None))],
        reference,
        existing=existing,
        problematic=pairs(spark, ("QQ", "Nowhere")),
    )
    assert rows_of(crosswalk) == [("CA", "ORANGE", "00001")]
    assert rows_of(problems) == [("QQ", "NOWHERE")]
