import hashlib
import io

import pytest

from conftest import rows_of
from loanlake.sources import inventory, manifest
from loanlake.sources.sinks import result_path, write_tabular
from loanlake.sources.snapshots import list_files, read_tabular


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    return hashlib.sha256(content).hexdigest()


@pytest.mark.parametrize("whole", [1 << 30, 4])
def test_sides_of_a_month(spark, tmp_path, whole):
    """A month seen raw, one seen on both sides, one in part files; long files are read as a stream."""
    raw, done = tmp_path / "raw", tmp_path / "done"
    july = put(raw, "fha_sf_snapshot_20190701.csv", b"a,b\n1,2\n" * 500)
    hecm = put(raw, "FHA_HECM_Snapshot_20201101.zip", bytes(range(256)) * 3)
    clean = put(done, "fha_hecm_snapshot_20201101.parquet", b"PAR1")
    parts = [put(done, f"snapshot_year=2021/snapshot_month=2/part-{k}.parquet", b"%d" % k * 9) for k in range(3)]
    put(raw, "notes 2019.md", b"")
    put(raw, "fha_sf_snapshot_20191301.csv", b"month 13")
    table = manifest.merge(
        manifest.fingerprint(spark, str(raw), "raw", whole_file=whole),
        manifest.fingerprint(spark, str(done), "processed", "sf", "part-*", whole_file=whole),
        manifest.fingerprint(spark, str(done), "processed", None, "fha*", whole_file=whole),
    )
    manifest.save(table, str(tmp_path / "m"))
    rows = {r["key"]: r for r in manifest.statuses(manifest.load(spark, str(tmp_path / "m"))).collect()}
    flags = {key: (r["is_downloaded"], r["is_processed"]) for key, r in rows.items()}
    assert flags == {"single_family:2019-07": (True, False), "hecm:2020-11": (True, True), "single_family:2021-02": (False, True)}
    assert rows["single_family:2019-07"]["raw"]["checksum"] == july
    assert (rows["hecm:2020-11"]["raw"]["checksum"], rows["hecm:2020-11"]["processed"]["checksum"]) == (hecm, clean)
    whole_month = hashlib.sha256("".join(parts).encode()).hexdigest()
    assert rows["single_family:2021-02"]["processed"]["checksum"] == whole_month
    assert [manifest.status_of(table, kind, 2019, 7).count() for kind in ("SF", "hecm")] == [1, 0]
    bad = {path.rsplit("/", 1)[1]: problem for path, problem in rows_of(manifest.unusable_files(list_files(spark, str(raw))))}
    assert bad == {"fha_sf_snapshot_20191301.csv": "month out of range"}  # the empty file is not read


def test_appended_rows_are_merged(spark, tmp_path):
    path = str(tmp_path / "m")
    assert manifest.load(spark, path).count() == 0
    for content in (b"first", b"second"):
        put(tmp_path / "raw", "fha_sf_snapshot_20190701.csv", content)
        manifest.append(manifest.fingerprint(spark, str(tmp_path / "raw"), "raw"), path)
    rows = manifest.load(spark, path).collect()
    assert len(rows) == 1 and rows[0]["raw"]["checksum"] == hashlib.sha256(b"second").hexdigest()


def test_later_record_wins(spark, tmp_path):
    put(tmp_path / "a", "fha_sf_snapshot_20240101.xlsx", b"first delivery")
    new = put(tmp_path / "b", "fha_sf_snapshot_20240101.xlsx", b"corrected delivery")
    old_table = manifest.fingerprint(spark, str(tmp_path / "a"), "raw")
    manifest.save(old_table, str(tmp_path / "m"))
    merged = manifest.merge(
        manifest.load(spark, str(tmp_path / "m")), manifest.fingerprint(spark, str(tmp_path / "b"), "raw")
    )
    assert merged.first()["raw"]["checksum"] == new
    with pytest.raises(ValueError):
        manifest.fingerprint(spark, str(tmp_path), "other")


def test_inventory(spark, tmp_path):
    data = tmp_path / "data"
    put(data, "raw/sf/a b%20.xlsx", b"x" * 2048)
    put(data, "clean/b.parquet", b"y" * 10)
    put(data, "metadata/c", b"")
    table = inventory.inventory(
        spark, str(data), project_dir=str(tmp_path), raw_dir=str(data / "raw"), clean_dir=str(data / "clean")
    )
    got = rows_of(
        table.select("category", "file_name", "relative_to_project", "relative_to_data", "parent_directory",
                     "suffix", "size_bytes", "size_mb", "size_readable")
    )
    assert got == [
        ("clean", "b.parquet", "data/clean/b.parquet", "clean/b.parquet", "clean", "parquet", 10, 0.0, "10 B"),
        ("data", "c", "data/metadata/c", "metadata/c", "metadata", "", 0, 0.0, "0 B"),
        ("raw", "a b%20.xlsx", "data/raw/sf/a b%20.xlsx", "raw/sf/a b%20.xlsx", "raw/sf", "xlsx", 2048, 0.002, "2.00 KB"),
    ]
    times = [r["modified_utc"] for r in table.collect()]
    assert times[0].endswith("Z") and times[1] is None and times[2].endswith("Z")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "1")], "k string, v string")
    for name in ("t.csv", "t.parquet", "t.pq"):
        write_tabular(df, str(tmp_path / name))
        assert rows_of(read_tabular(spark, str(tmp_path / name))) == [("a", "1")]
    with pytest.raises(ValueError):
        write_tabular(df, str(tmp_path / "t.xlsx"))
    assert result_path("/x/y.parquet", "d.parquet") == "/x/y.parquet"
    assert result_path("/x/y", "d.parquet") == "/x/y/d.parquet"


def test_long_files_are_read_in_blocks_and_names_are_taken_as_they_are(spark, tmp_path):
    raw = tmp_path / "raw a%20b #1"
    names = {f"fha_sf_snapshot_{y}0701.csv": bytes([y % 256]) * (manifest.BLOCK_BYTES + y) for y in (2019, 2020)}
    sums = {put(raw, name, content) for name, content in names.items()}
    table = manifest.fingerprint(spark, str(raw), "raw", whole_file=1)
    assert {r["raw"]["checksum"] for r in table.collect()} == sums


def test_other_stores_have_an_opener_of_their_own(spark, tmp_path):
    put(tmp_path / "raw", "fha_sf_snapshot_20190701.csv", b"what Spark lists")
    given = manifest.fingerprint(spark, str(tmp_path / "raw"), "raw", whole_file=1, open_file=lambda _: io.BytesIO(b"else"))
    assert given.first()["raw"]["checksum"] == hashlib.sha256(b"else").hexdigest()
