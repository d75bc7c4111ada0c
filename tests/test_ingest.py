"""Archives, typed scans, streams and sinks."""

from __future__ import annotations

import io
import json
import os
import shutil
import subprocess
import sys
import time
import zipfile
from collections import Counter

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_session import no_more_than, shuffle_files
from tidings.operators import files as file_ops
from tidings.plans.daily import analyse, run_daily
from tidings.schemas import schema_of
from tidings.session import new_path
from tidings.sources import archives, datasets, sinks
from tidings.sources import flat as flat_files
from tidings.streaming.ingest import start_ingest


def gkg_line(key, names="A,1;B,2", **more):
    values = {"GKGRECORDID": key, "DATE": "20150220183000", "AllNames": names} | more
    return "\t".join(values.get(c, "") for c in schema_of("gkg").names)


def zipped(folder, name, *members):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for i, content in enumerate(members):
            data = content if isinstance(content, bytes) else content.encode()
            archive.writestr(f"{name[:-4]}.{i}", data)
    return path


@pytest.fixture
def landed(tmp_path):
    folder = str(tmp_path / "landed")
    zipped(folder, "20150220183000.gkg.csv.zip", f"{gkg_line('r1')}\n{gkg_line('r2')}\n")
    zipped(folder, "20150221184500.gkg.csv.zip", gkg_line("r3", 'say "hi;X'))
    with open(f"{folder}/20150222190000.gkg.csv.zip", "wb") as out:
        out.write(b"not a zip")
    zipped(folder, "20150220184500.mentions.CSV.zip", "\t".join(["7"] + [""] * 15) + "\n")
    zipped(folder, "20150220184500.unknown.zip", "anything\n")
    return folder


def ingest(spark, landed, tmp_path, **options):
    running = start_ingest(spark, landed, f"{tmp_path}/stored", f"{tmp_path}/progress", **options)
    for query in running.values():
        query.awaitTermination()


def records(spark, tmp_path, kind="gkg"):
    return datasets.load_records(spark, f"{tmp_path}/stored", kind=kind)


def keys(spark, tmp_path):
    rows = records(spark, tmp_path).collect()
    return sorted(r.GKGRECORDID for r in rows)


def test_lines_of_every_member(spark, tmp_path):
    zipped(str(tmp_path), "a.zip", "x\r\n\r\ny z\n", b"\xff\n", "")
    rows = archives.read_zipped_lines(spark, str(tmp_path)).orderBy("member", "line_no").collect()
    assert [(r.line_no, r.line, r.error, r.replaced) for r in rows] == [
        (1, "x", None, False), (3, "y z", None, False), (1, "�", None, True)
    ]


def test_damaged_member_gives_error_and_no_lines(spark, tmp_path):
    path = zipped(str(tmp_path), "a.zip", "payload " * 2000, "good\n")
    with open(path, "r+b") as out:
        out.seek(60)
        out.write(b"\0\0\0\0")
    rows = archives.read_zipped_lines(spark, str(tmp_path)).collect()
    assert [r.line for r in rows if r.error is None] == ["good"]
    assert len([r for r in rows if r.error]) == 1


def test_long_members_come_in_several_batches(spark, tmp_path):
    lines = [f"{i}-" + "x" * 5000 for i in range(2500)]
    zipped(str(tmp_path), "a.zip", "\n".join(lines))
    got = archives.read_zipped_lines(spark, str(tmp_path))
    assert [r.line for r in got.orderBy("line_no").collect()] == lines


def test_list_archives(spark, landed):
    listed = {r.source_file: r.dataset for r in archives.list_archives(spark, landed).collect()}
    assert len(listed) == 5
    assert [n for n, d in listed.items() if d == "other"] == ["20150220184500.unknown.zip"]


def test_a_listing_passes_over_files_that_are_gone(spark, tmp_path):
    for k in range(12):
        zipped(f"{tmp_path}/landed", f"201502201830{k:02}.gkg.csv.zip", f"{gkg_line(f'r{k}')}\n")
    listed = archives.list_archives(spark, f"{tmp_path}/landed")
    for k in (0, 5, 11):
        (tmp_path / "landed" / f"201502201830{k:02}.gkg.csv.zip").unlink()
    assert listed.count() == 9
    assert not {r.source_file[12:14] for r in listed.collect()} & {"00", "05", "11"}



def test_typed_lines_and_files_agree(spark, tmp_path):
    lines = [
        gkg_line("r1", 'a "lone quote'), gkg_line("r2", "back\\slash;\\\"x"),
        "short", gkg_line("r3") + "\textra", gkg_line("r4", DATE="no number"),
    ]
    text = spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1)
    text.write.text(f"{tmp_path}/t")
    parsed = datasets.parse_lines(text, "gkg")
    scanned = datasets.read_dataset(spark, f"{tmp_path}/t", "gkg")
    assert parsed.collect() == scanned.select(*parsed.columns).collect()
    rows = parsed.collect()
    assert [r.AllNames for r in rows[:2]] == ['a "lone quote', "back\\slash;\\\"x"]
    assert [r._corrupt_record for r in rows] == [None, None, *lines[2:]]
    assert rows[2].GKGRECORDID == "short"


def test_ingest_takes_each_file_once(spark, landed, tmp_path):
    ingest(spark, landed, tmp_path)
    assert keys(spark, tmp_path) == ["r1", "r2", "r3"]
    stored = records(spark, tmp_path)
    assert [r.AllNames for r in stored.where("GKGRECORDID = 'r3'").collect()] == ['say "hi;X']
    assert stored.where("ingest_error IS NOT NULL").count() == 0
    bad = datasets.load_quarantine(spark, f"{tmp_path}/stored").collect()
    assert [(r.source_file, r.dataset) for r in bad] == [("20150222190000.gkg.csv.zip", "gkg")]
    assert "BadZipFile" in bad[0].ingest_error
    assert records(spark, tmp_path, "mentions").first().GLOBALEVENTID == 7
    assert {r.dataset for r in stored.collect()} == {"gkg"}

    ingest(spark, landed, tmp_path)
    assert keys(spark, tmp_path) == ["r1", "r2", "r3"]

    zipped(landed, "20150220191500.gkg.csv.zip", gkg_line("r4"))
    zipped(f"{landed}/again", "20150220183000.gkg.csv.zip", gkg_line("again"))
    ingest(spark, landed, tmp_path)
    assert keys(spark, tmp_path) == ["r1", "r2", "r3", "r4"]


def test_ingest_same_name_in_another_folder(spark, tmp_path):
    zipped(f"{tmp_path}/in/a", "20150220183000.gkg.csv.zip", gkg_line("first"))
    ingest(spark, f"{tmp_path}/in/*", tmp_path, datasets=("gkg",))
    zipped(f"{tmp_path}/in/b", "20150220183000.gkg.csv.zip", gkg_line("second"))
    zipped(f"{tmp_path}/in/b", "20150220184500.gkg.csv.zip", gkg_line("third"))
    ingest(spark, f"{tmp_path}/in/*", tmp_path, datasets=("gkg",))
    assert keys(spark, tmp_path) == ["first", "third"]


def test_ingest_on_a_timer(spark, landed, tmp_path):
    running = start_ingest(
        spark, landed, f"{tmp_path}/stored", f"{tmp_path}/progress",
        datasets=("gkg",), every="1 second", files_per_batch=1,
    )
    query = running["gkg"]
    try:
        query.processAllAvailable()
        assert keys(spark, tmp_path) == ["r1", "r2", "r3"]
        zipped(landed, "20150223000000.gkg.csv.zip", gkg_line("late"))
        query.processAllAvailable()
        assert keys(spark, tmp_path) == ["late", "r1", "r2", "r3"]
    finally:
        query.stop()


def test_ingest_stopped_in_between(spark, tmp_path):
    landed = f"{tmp_path}/landed"
    names = [f"r{n:02}" for n in range(12)]
    for n, key in enumerate(names):
        zipped(landed, f"201502{n + 1:02}000000.gkg.csv.zip", gkg_line(key))
    for _ in range(3):
        running = start_ingest(
            spark, landed, f"{tmp_path}/stored", f"{tmp_path}/progress",
            datasets=("gkg",), every="0 seconds", files_per_batch=1,
        )
        time.sleep(1.5)
        running["gkg"].stop()
    ingest(spark, landed, tmp_path, datasets=("gkg",))
    assert keys(spark, tmp_path) == names


def test_ingest_moves_processed_archives(spark, landed, tmp_path):
    moved = f"{tmp_path}/moved"
    for n in range(3):
        ingest(spark, landed, tmp_path, datasets=("gkg",), clean="archive", clean_to=moved)
        zipped(landed, f"2015022{n}200000.gkg.csv.zip", gkg_line(f"n{n}"))
    gone = [name for _, _, names in os.walk(moved) for name in names]
    assert "20150220183000.gkg.csv.zip" in gone
    assert "20150220184500.mentions.CSV.zip" in os.listdir(landed)


def test_day_is_a_partition_filter(spark, landed, tmp_path):
    ingest(spark, landed, tmp_path, datasets=("gkg",))
    day = datasets.load_records(spark, f"{tmp_path}/stored", 20150220)
    assert sorted(r.GKGRECORDID for r in day.collect()) == ["r1", "r2"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan


def test_text_files_are_stored_once(spark, tmp_path):
    folder = tmp_path / "text"
    folder.mkdir()
    (folder / "20150220183000.gkg.csv").write_text(gkg_line("r1") + "\n" + gkg_line("r2") + "\n")
    (folder / "20150220183000.export.gkg.CSV").write_text(gkg_line("r3") + "\nshort\n")
    (folder / "20150220183000.gkg.csv.zip").write_text("not taken")
    for _ in range(2):
        ingest(spark, str(folder), tmp_path, zipped=False)
        rows = records(spark, tmp_path).collect()
        assert sorted((r.GKGRECORDID, r.ds) for r in rows) == [
            ("r1", 20150220), ("r2", 20150220), ("r3", 20150220), ("short", 20150220)
        ]
    assert [r._corrupt_record for r in rows if r.GKGRECORDID == "short"] == ["short"]
    assert records(spark, tmp_path, "events").count() == 0


def test_flat_folder_by_day(spark, tmp_path):
    flat = tmp_path / "flat"
    flat.mkdir()
    for day, key in ((20171201, "a"), (20171202, "b")):
        part = f"{tmp_path}/{day}"
        line = spark.createDataFrame([(gkg_line(key),)], "line string")
        datasets.parse_lines(line, "gkg").coalesce(1).write.parquet(part)
        [name] = [n for n in os.listdir(part) if n.endswith(".parquet")]
        shutil.copy(f"{part}/{name}", f"{flat}/{day}000000.gkg.csv.gzip.parquet")
    one = flat_files.load_files(spark, str(flat), 20171201).collect()
    assert [(r.GKGRECORDID, r.ds) for r in one] == [("a", 20171201)]
    assert one[0].source_file == "20171201000000.gkg.csv.gzip.parquet"
    assert flat_files.load_files(spark, str(flat)).count() == 2


def test_flat_files_with_inferred_types(spark, tmp_path):
    """Types of one file do not bind the next, and none of them is the declared one."""
    first = pd.DataFrame({
        "GKGRECORDID": ["a", "b"], "DATE": [20171201000000, 20171201001500],
        "SourceCollectionIdentifier": [1, 2], "Themes": [float("nan")] * 2, "Counts": [None, None],
        "Persons": [7.0, float("nan")], "Unknown": [1, 2],
    })
    second = pd.DataFrame({
        "GKGRECORDID": [5], "DATE": ["20171202000000"], "Themes": ["T;U"],
        "SourceCollectionIdentifier": [float(2**40)], "Persons": [1.5],
    })
    first.to_parquet(f"{tmp_path}/20171201000000.gkg.csv.gzip.parquet", compression="gzip")
    second.to_parquet(f"{tmp_path}/20171202000000.gkg.csv.gzip.parquet", compression="gzip")
    found = flat_files.load_files(spark, str(tmp_path))
    declared = schema_of("gkg")
    assert found.select(declared.names).schema.simpleString() == declared.simpleString()
    rows = found.orderBy("ds", "GKGRECORDID").collect()
    columns = ("GKGRECORDID", "DATE", "SourceCollectionIdentifier", "Themes", "Counts", "Persons", "ds")
    assert [tuple(r[c] for c in columns) for r in rows] == [
        ("a", 20171201000000, 1, None, None, "7", 20171201),
        ("b", 20171201001500, 2, None, None, None, 20171201),
        ("5", 20171202000000, None, "T;U", None, "1.5", 20171202),
    ]
    narrow = flat_files.load_files(spark, str(tmp_path), 20171202, columns=["Themes"])
    assert [(r.Themes, r.ds) for r in narrow.collect()] == [("T;U", 20171202)]


def test_flat_files_are_read_by_row_groups_with_filters(spark, tmp_path):
    """A value reads the same wherever it stands; filters and columns reach the scan; one file is several tasks."""
    n = 60_000
    numbers = [float(i % 5) if i % 2 else i + 0.5 for i in range(n)]
    table = pd.DataFrame({
        "GKGRECORDID": [float(i) for i in range(n)], "DATE": [20171201000000] * n, "Persons": numbers,
        "Themes": [f"{i:064x}" for i in range(n)]})
    for k in range(2):
        table.to_parquet(f"{tmp_path}/2017120{k + 1}000000.gkg.csv.gzip.parquet", row_group_size=5000)
    # Another type for the same column.
    pd.DataFrame({"GKGRECORDID": ["x"], "Persons": ["5.0"]}).to_parquet(f"{tmp_path}/20171201001500.gkg.csv.gzip.parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = flat_files.load_files(spark, str(tmp_path), 20171201, columns=["GKGRECORDID", "Persons", "DATE"])
        few = found.select("GKGRECORDID", "Persons").where("DATE = 20171201000000 AND Persons IS NOT NULL")
        plan = few._jdf.queryExecution().executedPlan().toString()
        assert found.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert "struct<DATE:bigint,GKGRECORDID:double,Persons:double" in plan and "Themes" not in plan
    # Where a column is stored as declared.
    assert "IsNotNull(DATE), EqualTo(DATE,20171201000000)" in plan
    assert "MapInArrow" not in plan and "binaryFile" not in plan
    rows = {r.GKGRECORDID: r.Persons for r in found.collect()}
    assert rows == {"x": "5.0"} | {str(i): str(i % 5) if i % 2 else str(i + 0.5) for i in range(n)}


@pytest.mark.parametrize("values, kind, expected", [
    ([1, 2**40, None], "int", [1, None, None]),
    (["7", " 7", "7.5", "", None, "1e3", "-12"], "int", [7, None, None, None, None, None, -12]),
    (["7", "1e3", "x", "0.25"], "double", [7.0, 1000.0, None, 0.25]),
    ([1.9, -2.5, float("inf"), float("nan"), 1e300], "bigint", [1, -2, None, None, None]),
    ([1.0, 2.5, float("inf"), 1e300, 1e18], "string", ["1", "2.5", "Infinity", "1.0E300", "1000000000000000000"]),
    ([True, False, None], "string", ["true", "false", None]),
    ([True, None], "int", [None, None]),
    ([pd.Timestamp("2017-12-01")], "bigint", [None]),
    ([b"a", None], "string", ["a", None]),
])
def test_inferred_values_as_declared(spark, tmp_path, values, kind, expected):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"v": pa.array(values, from_pandas=False)}), f"{tmp_path}/a.parquet")
    stored = flat_files.stored_types(spark, str(tmp_path)).first().stored
    read = spark.read.schema(stored).parquet(str(tmp_path))
    wanted = T.StructType.fromDDL(f"v {kind}")["v"].dataType
    got = read.select(flat_files.declared("v", read.schema["v"].dataType, wanted).alias("v"))
    assert got.schema["v"].dataType == wanted and [r.v for r in got.collect()] == expected


def test_a_flat_folder_without_files(spark, tmp_path):
    none = flat_files.load_files(spark, str(tmp_path))
    assert none.count() == 0 and none.columns == schema_of("gkg").names + ["source_file", "ds"]


def test_late_files_and_repeated_names(spark, tmp_path):
    """The age of a file decides nothing: late files are taken, a name is taken once."""
    def land(folder, name, key, days):
        path = zipped(f"{tmp_path}/in/{folder}", name, gkg_line(key))
        os.utime(path, (time.time() - days * 24 * 3600,) * 2)

    land("a", "20150220183000.gkg.csv.zip", "first", 20)
    ingest(spark, f"{tmp_path}/in/*", tmp_path, datasets=("gkg",))
    land("a", "20150201000000.gkg.csv.zip", "late", 400)
    land("b", "20150301000000.gkg.csv.zip", "new", 1)
    ingest(spark, f"{tmp_path}/in/*", tmp_path, datasets=("gkg",))
    land("c", "20150220183000.gkg.csv.zip", "again", 0)
    land("c", "20150201000000.gkg.csv.zip", "again", 0)
    ingest(spark, f"{tmp_path}/in/*", tmp_path, datasets=("gkg",))
    assert keys(spark, tmp_path) == ["first", "late", "new"]


def test_missing_files_read_near_days_only(spark, tmp_path):
    names = ["20150220183000.gkg.csv.zip", "20150221184500.gkg.csv.zip", "undated.gkg.csv.zip"]
    stored = [(names[0], 20150220, "x"), ("20140101000000.gkg.csv.zip", 20140101, "x"),
              (names[2], None, "x")]
    rows = spark.createDataFrame(stored, "source_file string, ds int, AllNames string")
    sinks.write_dataset(rows, f"{tmp_path}/gkg")
    kept = spark.read.schema(rows.schema).parquet(f"{tmp_path}/gkg")
    lines = spark.createDataFrame([(f"1 c http://x.org/{n}",) for n in names], "value string")
    missing = file_ops.missing_files(lines, kept)
    assert [r.file_name for r in missing.collect()] == [names[1]]
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<source_file:string>" in plan
    assert "PartitionFilters: [(isnull(ds" in plan
    assert file_ops.missing_files(lines.limit(0), kept).count() == 0


def test_write_dataset(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("ds"))
    sinks.write_dataset(df, f"{tmp_path}/d")
    parts = [n for _, _, names in os.walk(f"{tmp_path}/d") for n in names if n.endswith(".parquet")]
    assert len(parts) == 3 and all(n.endswith(".gz.parquet") for n in parts)
    assert spark.read.parquet(f"{tmp_path}/d").count() == 1000


def test_write_result(spark, tmp_path):
    df = spark.createDataFrame([("é", 2), ("b", 1)], "Persons string, count bigint")
    stored = sinks.write_result(df, str(tmp_path), "people", "20171201T000000")
    assert sorted(map(tuple, stored.collect())) == [("b", 1), ("é", 2)]
    text = spark.read.text(f"{tmp_path}/people_json/run_ts=20171201T000000").collect()
    assert sorted(json.loads(r.value)["count"] for r in text) == [1, 2]
    for bad in ("a b", "12:00"):
        with pytest.raises(ValueError):
            sinks.write_result(df, str(tmp_path), "people", bad)


class Writer:
    """Keeps what a DataFrame writer is told; no database is involved."""

    def __init__(self):
        self.write, self.told = self, {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told |= options
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def save(self):
        self.told["saved"] = True


def test_write_table_options():
    df = Writer()
    sinks.write_table(df, "jdbc:x", "themes", user="u", password="p", numPartitions=4)
    assert df.told == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "themes", "truncate": "true", "user": "u",
        "password": "p", "numPartitions": "4", "mode": "overwrite", "saved": True,
    }


def test_run_daily(spark, landed, tmp_path):
    ingest(spark, landed, tmp_path, datasets=("gkg",))
    stored = run_daily(spark, f"{tmp_path}/stored", f"{tmp_path}/out", 20150220, run_ts="t1")
    pairs = {(r.name_a, r.name_b): (r["count"], r.weight) for r in stored["cooccurences"].collect()}
    assert pairs == {(a, b): (2, 0.25) for a in "AB" for b in "AB"}
    names = ("cooccurences", "themes", "people", "organizations")
    folders = [f"{name}{suffix}" for name in names for suffix in ("", "_json")]
    assert sorted(os.listdir(f"{tmp_path}/out")) == sorted(folders)


def test_analyse_leaves_results_only(spark, tmp_path):
    rows = [("A,1;B,2", "X;Y", "P", "O;O"), ("A,1;B,2;A,3", "X;", None, None), (None, None, None, None)]
    records = spark.createDataFrame(rows, "AllNames string, Themes string, Persons string, Organizations string")
    folder = os.path.dirname(new_path(spark, "x")).removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    before, shuffled = set(os.listdir(folder)), shuffle_files(spark)
    stored = analyse(records, f"{tmp_path}/out", run_ts="t1")
    assert set(os.listdir(folder)) <= before and no_more_than(spark, shuffled)
    assert list(stored) == ["cooccurences", "themes", "people", "organizations"]
    assert [tuple(r)[1:4] for r in stored["cooccurences"].orderBy("rn").collect()] == [
        ("A", "A", 5), ("A", "B", 3), ("B", "A", 3), ("B", "B", 2)]
    assert Counter(map(tuple, stored["themes"].collect())) == {("X", 2): 1, ("Y", 1): 1}
    assert list(map(tuple, stored["organizations"].collect())) == [("O", 2)]


def test_archive_bytes_are_read_in_place():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        archive.writestr("folder/", "")
        archive.writestr("folder/x", "one\ntwo")
    import pyarrow as pa

    rows = list(archives._archive_lines("p", pa.py_buffer(data.getvalue())))
    assert rows == [("p", "folder/x", 1, "one", None, False), ("p", "folder/x", 2, "two", None, False)]


def test_executors_need_no_package(tmp_path):
    """The unzip function loads and works where this package cannot be imported."""
    path = zipped(str(tmp_path), "a.zip", "one\ntwo\n")
    function = tmp_path / "function"
    function.write_bytes(cloudpickle.dumps(archives._unzip))
    program = f"""
import pickle, sys, pyarrow as pa
sys.modules["tidings"] = None
unzip = pickle.load(open({str(function)!r}, "rb"))
content = open({path!r}, "rb").read()
batch = pa.RecordBatch.from_pydict({{"path": ["a.zip"], "content": [content]}})
[lines] = list(unzip(iter([batch])))
assert lines.column("line").to_pylist() == ["one", "two"]
try:
    import tidings
except ImportError:
    print("done")
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", program], cwd=tmp_path, env=clean, capture_output=True, text=True, check=True
    )
    assert done.stdout.strip() == "done"
