"""Archives, manifests, workbooks, readers and writers on small files."""

from __future__ import annotations

import datetime as dt
import hashlib
import io
import json
import zipfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import curves, paths
from silverlode.operators import integrity
from silverlode.plans import catalog_files, deliveries
from silverlode.plans.frames import Frames
from silverlode.sources import archives, files, manifests, remote, sinks, workbooks
from silverlode.sources.remote import write_stream

GOOD = {"employees.csv": b"id,salary\n5,92000\n", "payroll.csv": b"id,pay\n", "departments.csv": b"id\n"}


def sha(content: bytes) -> str:
    return hashlib.sha512(content).hexdigest()


def zip_bytes(members) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)
    return buf.getvalue()


@pytest.fixture
def drop(tmp_path):
    """A delivered archive, its tampered copy, and a manifest for each."""
    lines = ["# Root: data"] + [f"{sha(c)}|{n}" for n, c in GOOD.items()]
    bad = {**GOOD, "employees.csv": b"id,salary\n5,99999\n", "extra.csv": b"x", "inner.hash": b"never extra"}
    del bad["departments.csv"]
    for name, members in (("good", GOOD), ("bad", bad)):
        (tmp_path / f"{name}.zip").write_bytes(zip_bytes(members))
        (tmp_path / f"{name}.hash").write_text("﻿" + "\r\n".join([*lines, "not a line", ""]), encoding="utf-8")
    return f"file://{tmp_path}"


def validated(spark, folder):
    lines = manifests.read_manifest_lines(spark, folder)
    actual = archives.member_digests(spark, folder).withColumn("archive", F.regexp_replace("archive", r"\.zip$", ""))
    return integrity.validate(manifests.parse_entries(lines), actual.select("archive", "path", "actual"))


def test_untouched_and_tampered_archives(spark, drop):
    summary = {r.archive: r for r in integrity.summarise(validated(spark, drop)).collect()}
    assert summary["good"].summary == "SUMMARY: OK=3 FAIL=0 MISSING=0 EXTRA=0"
    assert (summary["good"].status, summary["good"].exit_code) == ("PASS", 0)
    bad = summary["bad"]
    assert (bad.ok_count, bad.fail_count, bad.missing_count, bad.extra_count) == (1, 1, 1, 1)
    assert (bad.status, bad.exit_code) == ("FAIL", 3)


def test_every_manifest_line_is_accounted_for(spark, drop):
    results = validated(spark, drop)
    listed = manifests.parse_entries(manifests.read_manifest_lines(spark, drop)).count()
    assert results.where("result <> 'EXTRA'").count() == listed == 6


def test_root_header_survives_the_byte_order_mark(spark, drop):
    roots = manifests.parse_roots(manifests.read_manifest_lines(spark, drop))
    assert sorted(tuple(r) for r in roots.collect()) == [("bad", "data"), ("good", "data")]


def test_members_are_read_whole(spark, drop):
    got = {(r.archive, r.member_path): bytes(r.content) for r in archives.read_members(spark, drop).collect()}
    assert {n: got[("good.zip", n)] for n in GOOD} == GOOD
    assert len(got) == 7


@pytest.mark.parametrize("algorithm", ["md5", "sha256", "sha512"])
def test_streamed_digest_equals_native(spark, drop, algorithm):
    streamed = {(r.archive, r.path): r.actual for r in archives.member_digests(spark, drop, algorithm).collect()}
    members = archives.read_members(spark, drop).withColumnRenamed("member_path", "path")
    native = {(r.archive, r.path): r.actual for r in integrity.generate_manifest(members, algorithm).collect()}
    assert streamed == native
    assert native[("good.zip", "payroll.csv")] == hashlib.new(algorithm, GOOD["payroll.csv"]).hexdigest()


def test_placing_members_twice_gives_the_same_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ACME_HR_2024.zip").write_bytes(zip_bytes({"a/b.txt": b"1", "c.txt": b"22"}))
    (tmp_path / "in" / "odd.zip").write_bytes(zip_bytes({"d.txt": b"3"}))
    for _ in range(2):
        placed = archives.place_members(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").collect()
        assert len(placed) == 3
    found = sorted(str(p.relative_to(tmp_path / "out")) for p in (tmp_path / "out").rglob("*") if p.is_file())
    assert found == ["acme/hr/ACME_HR_2024.zip/a/b.txt", "acme/hr/ACME_HR_2024.zip/c.txt", "unrouted/unknown/odd.zip/d.txt"]


def test_digest_length_selects_the_algorithm(spark):
    rows = [("a", "p", "x", hashlib.new(h, b"x").hexdigest().upper()) for h in ("md5", "sha256", "sha512")]
    rows += [("a", "q", "x", "0" * 64), ("a", "r", "x", "abc")]
    out = integrity.verify_digest(spark.createDataFrame(rows, "archive string, path string, content string, expected string"))
    assert [r.result for r in out.collect()] == ["OK", "OK", "OK", "FAIL", "UNKNOWN_ALGORITHM"]


def test_wrapper_folder(spark):
    df = spark.createDataFrame(
        [("one", "top/a"), ("one", "top/b/c"), ("two", "top/a"), ("two", "readme"), ("three", "x/a"), ("three", "y/b")],
        "archive string, path string",
    )
    roots = integrity.wrapper_roots(df)
    assert {r.archive: r.root for r in roots.collect()} == {"one": "top", "two": "", "three": ""}
    assert sorted(r.path for r in integrity.strip_roots(df, roots).where("archive = 'one'").collect()) == ["a", "b/c"]


def test_manifest_inside_wins(spark):
    inside = spark.createDataFrame([("a", "z.hash"), ("a", "b.hash")], "archive string, manifest_path string")
    beside = spark.createDataFrame([("a", "a.hash"), ("c", "c.hash")], "archive string, manifest_path string")
    out = sorted(tuple(r) for r in integrity.discover_manifests(inside, beside).collect())
    assert out == [("a", "b.hash", "inside"), ("c", "c.hash", "sibling")]


def test_routing(spark):
    df = spark.createDataFrame([("ACME_HR_2024-01-01.zip",), ("ACME.zip",), ("A_B.zip",)], "f string")
    out = [tuple(r) for r in df.select(paths.routed_company("f"), paths.routed_type("f")).collect()]
    assert out == [("acme", "HR"), (None, None), (None, None)]


def test_workbook_cells(spark, tmp_path):
    book = deliveries.workbook_bytes(
        {"Staff & Co": [["Id", "When", "Pay"], ["a<b", "2020-01-15", 10.5], [None, 43845, "n/a"], [], ["c", "soon", 3]], "Empty": []}
    )
    (tmp_path / "acme").mkdir()
    (tmp_path / "acme" / "b.xlsx").write_bytes(book)
    schema = T.StructType(
        [T.StructField("Id", T.StringType()), T.StructField("When", T.DateType()), T.StructField("Pay", T.DecimalType(10, 2))]
    )
    tall = workbooks.read_workbooks(spark, f"file://{tmp_path}")
    assert [r.row_no for r in tall.orderBy("row_no").collect()] == [1, 2, 3, 4]
    out = [tuple(map(str, r)) for r in workbooks.project_sheet(tall, "Staff & Co", schema).collect()]
    assert out == [
        ("a<b", "2020-01-15", "10.50", "acme"), ("None", "2020-01-15", "None", "acme"), ("None", "None", "None", "acme"),
        ("c", "None", "3.00", "acme"),
    ]


def test_workbook_shared_strings_and_gaps(spark, tmp_path):
    main = workbooks.MAIN[1:-1]
    sheet = (
        f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
        '<row r="2"><c r="C2"><v>7</v></c></row></sheetData></worksheet>'
    )
    base = zipfile.ZipFile(io.BytesIO(deliveries.workbook_bytes({"S": []})))
    parts = {n: base.read(n) for n in base.namelist()}
    parts["xl/worksheets/sheet1.xml"] = sheet.encode()
    parts["xl/sharedStrings.xml"] = f'<sst xmlns="{main}"><si><t>A</t></si><si><r><t>C</t></r><r><t>C</t></r></si></sst>'.encode()
    (tmp_path / "x.xlsx").write_bytes(zip_bytes(parts))
    assert workbooks.read_workbooks(spark, f"file://{tmp_path}").first().cells == {"CC": "7"}


def test_storage_event_array(spark, tmp_path):
    event = [{"subject": "/blobs/a.zip", "eventType": "BlobCreated", "id": "1", "data": {"url": "https://x/a.zip", "contentLength": 5}}]
    (tmp_path / "e.json").write_text(json.dumps(event, indent=1))
    row = files.read_storage_events(spark, f"file://{tmp_path}/e.json").first()
    assert (row.id, row.url, row.size_bytes) == ("1", "https://x/a.zip", 5)


def test_scan_or_empty(spark, tmp_path):
    schema = spark.range(1).schema
    df, status = files.read_or_empty(spark, f"file://{tmp_path}/none", schema)
    assert (status, df.count(), df.schema) == ("NO_DATA", 0, schema)


def test_listing_does_not_read_contents(spark, drop, plan):
    text = plan(files.list_files(spark, drop, "*.zip"))
    assert "content" not in text.split("ReadSchema")[1]


def test_partition_replace_leaves_others(spark, tmp_path, rows):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.overwrite(df, path, ["p"])
    sinks.replace_partitions(spark.createDataFrame([(9, "b")], "v int, p string"), path, ["p"])
    assert rows(spark.read.parquet(path), "v", "p") == [(1, "a"), (9, "b")]


def test_typed_load_never_fails(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("d", T.DateType())])
    df = spark.createDataFrame([("1", "2020-01-01"), ("x", "y")], "a string, d string")
    assert [r.a for r in sinks.cast_to(df, schema).collect()] == [1, None]


def test_publishing_replaces_and_leaves_no_temporary(tmp_path):
    for content in (b"one", b"two"):
        write_stream(f"file://{tmp_path}/f/x.bin", io.BytesIO(content))
    assert [p.name for p in (tmp_path / "f").iterdir()] == ["x.bin"]
    assert (tmp_path / "f" / "x.bin").read_bytes() == b"two"


def test_expired_snapshots_keep_the_live_one(spark):
    df = spark.sql("SELECT t AS table_name, CAST(s AS TIMESTAMP_NTZ) AS snapshot_at FROM VALUES ('a','2024-01-01'),('a','2024-01-05'),('b','2024-01-01') v(t,s)")
    assert [r.table_name for r in sinks.expired_snapshots(df, "2024-02-01 00:00:00", 24).collect()] == ["a"]


@pytest.mark.parametrize(
    "name,safe",
    [
        ("a/b.txt", "a/b.txt"), ("a\\b.txt", "a/b.txt"), ("..x/y..", "..x/y.."), ("../x", None), ("a/../../x", None),
        ("a\\..\\x", None), ("/etc/x", None), ("C:\\x", None), ("\\\\host\\x", None), ("a/..", None), ("", None),
    ],
)
def test_members_that_could_leave_the_target_are_refused(spark, name, safe):
    df = spark.createDataFrame([(name,)], "m string")
    assert df.select(archives.safe_member(F.col("m"))).first()[0] == safe


def test_unpacking_stays_below_its_target(spark, tmp_path):
    (tmp_path / "in dir").mkdir()
    with zipfile.ZipFile(tmp_path / "in dir" / "ACME_HR_1 #2%.zip", "w") as z:
        z.writestr("../../../../esc.txt", "bad")
        z.writestr("ok file#1%.txt", "good")
    placed = archives.place_members(spark, f"{tmp_path}/in dir", f"{tmp_path}/out dir/deep/er/x").collect()
    assert {r.member_path: r.target_path is None for r in placed} == {"../../../../esc.txt": True, "ok file#1%.txt": False}
    files_there = [p.name for p in tmp_path.rglob("*.txt")]
    assert files_there == ["ok file#1%.txt"]


def test_locate_takes_paths_as_they_are():
    for path in ("/a b/c#d%20?.zip", "rel/x y"):
        assert remote.locate(path)[1] == path
    assert remote.locate("file:///a b#c")[1] == "/a b#c" and remote.locate("file:/x")[1] == "/x"


def test_archives_without_manifest_or_root_are_errors(spark):
    empty = "archive string, manifest_path string, line string"
    members = [("ok", "top/a.txt", "1"), ("ok", "top/b.txt", "2"), ("bad", "A.TXT", "1"), ("none", "a.txt", "1"), ("noroot", "a.txt", "1")]
    inside = [("ok", "m.hash", "# Root: x"), ("ok", "m.hash", "1|a.txt"), ("ok", "m.hash", "2|b.txt"), ("noroot", "m.hash", "1|a.txt")]
    beside = [("bad", "bad.hash", "# Root: y"), ("bad", "bad.hash", "9|a.txt"), ("ok", "ok.hash", "# Root: z"), ("ok", "ok.hash", "0|a.txt")]
    frames_ = (
        spark.createDataFrame([(a,) for a in ("ok", "bad", "none", "noroot", "hollow")], "archive string"),
        spark.createDataFrame(members, "archive string, path string, actual string"),
        spark.createDataFrame(inside, empty),
        spark.createDataFrame(beside, empty),
    )
    for ignore_case, counts in ((False, (0, 0, 1, 1)), (True, (0, 1, 0, 0))):
        results, summary = integrity.validate_archives(*frames_, ignore_case=ignore_case)
        got = {r.archive: (r.exit_code, r.status) for r in summary.collect()}
        assert got == {
            "ok": (0, "PASS"), "bad": (3, "FAIL"), "none": (2, "ERROR"), "noroot": (2, "ERROR"), "hollow": (2, "ERROR"),
        }
        bad = summary.where("archive = 'bad'").first()
        assert (bad.ok_count, bad.fail_count, bad.missing_count, bad.extra_count) == counts
        assert {r.archive for r in results.collect()} == {"ok", "bad"}


def test_the_worst_of_equal_moments_decides(spark):
    rows = [("a", "2024-01-01", s, 0, 0, 0, 0) for s in ("PASS", "FAIL", "PASS")] + [("b", "2024-01-02", "PASS", 0, 0, 0, 0), ("b", "2024-01-01", "FAIL", 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "archive string, validated_at string, status string, o int, f int, m int, e int")
    assert {r.archive: r.go for r in integrity.latest_status(df).collect()} == {"a": False, "b": True}


def test_partitioned_tables_without_rows_can_be_read(spark, tmp_path):
    schema = T.StructType.fromDDL("a int, p string")
    sinks.create_empty(spark, f"{tmp_path}/t", schema, ["p"])
    assert files.read_table(spark, f"{tmp_path}/t").schema == schema
    sinks.append(spark.createDataFrame([(1, "x")], schema), f"{tmp_path}/t", ["p"])
    assert [tuple(r) for r in files.read_table(spark, f"{tmp_path}/t").collect()] == [(1, "x")]


def test_load_conversion_reports_what_it_loses(spark):
    df = spark.createDataFrame([("1", "abc"), ("x", "abcdef"), (None, None)], "n string, t string")
    lost = sinks.lost_values(df, T.StructType.fromDDL("n int, t string"), {"t": 3})
    assert [tuple(r) for r in lost.collect()] == [("n", 1, 0), ("t", 0, 1)]


def test_archives_of_one_name_stay_apart(spark, tmp_path):
    for day, text in (("day1", b"one"), ("day2", b"two")):
        (tmp_path / "in" / day).mkdir(parents=True)
        (tmp_path / "in" / day / "ACME_HR_1.zip").write_bytes(zip_bytes({"a.txt": text}))
        digest = hashlib.sha256(b"one").hexdigest()
        (tmp_path / "in" / day / "ACME_HR_1.zip.hash").write_text(f"# Root: d\n{digest}|a.txt\n")
    root = f"file://{tmp_path}/in"
    assert {(r.archive, bytes(r.content)) for r in archives.read_members(spark, root).collect()} == {
        ("day1/ACME_HR_1.zip", b"one"), ("day2/ACME_HR_1.zip", b"two"),
    }
    archives.place_members(spark, root, f"file://{tmp_path}/out").collect()
    found = {str(p.relative_to(tmp_path / "out")): p.read_bytes() for p in (tmp_path / "out").rglob("*.txt")}
    assert found == {"acme/hr/day1/ACME_HR_1.zip/a.txt": b"one", "acme/hr/day2/ACME_HR_1.zip/a.txt": b"two"}
    beside = manifests.read_manifest_lines(spark, root).withColumn("manifest_path", F.lit("beside"))
    listed = archives.list_members(spark, root).select("archive").distinct()
    members = archives.member_digests(spark, root, "sha256").select("archive", "path", "actual")
    _, summary = integrity.validate_archives(listed, members, archives.inside_manifests(spark, root), beside)
    assert {r.archive: r.status for r in summary.collect()} == {"day1/ACME_HR_1.zip": "PASS", "day2/ACME_HR_1.zip": "FAIL"}


def test_members_that_would_be_one_file_are_not_written(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in" / "x.zip", "w") as z:
        for name in ("x\\y.txt", "x/y.txt", "x//./z.txt", "x/z.txt", "x/only.txt"):
            z.writestr(name, name)
    placed = archives.place_members(spark, f"{tmp_path}/in", f"{tmp_path}/out").collect()
    assert {r.member_path for r in placed if r.target_path} == {"x/only.txt"} and len(placed) == 5
    assert [p.name for p in (tmp_path / "out").rglob("*.txt")] == ["only.txt"]


def test_directories_are_parsed_once_and_unwanted_members_not_read(spark, tmp_path, monkeypatch):
    content = {f"f{i}.txt": bytes([i]) * 300_000 for i in range(20)}
    (tmp_path / "a.zip").write_bytes(zip_bytes(content))
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        infos = {i.filename: i for i in z.infolist()}
    rows = archives.list_members(spark, f"{tmp_path}").toPandas()
    # Members are read from their offsets: no directory is parsed any more.
    monkeypatch.setattr(zipfile.ZipFile, "__init__", lambda *a, **k: pytest.fail("directory parsed again"))
    read = {row.member_path: stream.read() for row, stream in archives._each_member(rows)}
    assert read == content and set(rows["offset"]) == {i.header_offset for i in infos.values()}
    monkeypatch.undo()
    # Damaged members are noticed when they are read, and only then.
    raw = bytearray((tmp_path / "a.zip").read_bytes())
    raw[infos["f3.txt"].header_offset + 40] ^= 0xFF
    (tmp_path / "a.zip").write_bytes(raw)
    with pytest.raises(Exception, match="f3.txt|decompressing"):
        archives.read_members(spark, f"{tmp_path}").collect()
    others = archives.read_members(spark, f"{tmp_path}", wanted=F.col("member_path") != "f3.txt")
    assert others.count() == 19


def test_stored_empty_and_compressed_members_are_read_alike(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("stored.bin", bytes(range(256)) * 9000, zipfile.ZIP_STORED)
        z.writestr("packed.bin", b"ab" * 2_000_000, zipfile.ZIP_DEFLATED)
        z.writestr("empty.bin", b"", zipfile.ZIP_DEFLATED)
        z.writestr("ümlaut ☃.txt", "x")
    got = {r.member_path: bytes(r.content) for r in archives.read_members(spark, f"{tmp_path}").collect()}
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        assert got == {n: z.read(n) for n in z.namelist()}
    with zipfile.ZipFile(tmp_path / "b.zip", "w", zipfile.ZIP_LZMA) as z:
        z.writestr("odd.bin", "x")
    with pytest.raises(Exception, match="method 14"):
        archives.read_members(spark, f"{tmp_path}", "b.zip").collect()


def book_with_shared_strings(sheets, rows):
    """A workbook of ``sheets`` sheets with ``rows`` rows each, all text being shared strings."""
    main = workbooks.MAIN[1:-1]
    buf = io.BytesIO(deliveries.workbook_bytes({f"S{i}": [["A", "B"]] + [[f"a{r}", r] for r in range(rows)] for i in range(sheets)}))
    strings = ["A", "B"] + [f"a{r}" for r in range(rows)]
    out = io.BytesIO()
    with zipfile.ZipFile(buf) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
        for name in old.namelist():
            text = old.read(name).decode()
            for i, s in reversed(list(enumerate(strings))):
                text = text.replace(f't="inlineStr"><is><t>{s}</t></is>', f't="s"><v>{i}</v>')
            new.writestr(name, text)
        items = "".join(f"<si><t>{s}</t></si>" for s in strings)
        new.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return out.getvalue()


def test_books_are_opened_once_and_shared_strings_parsed_once(spark, tmp_path):
    for company in ("a", "b"):
        (tmp_path / "in" / company).mkdir(parents=True)
        (tmp_path / "in" / company / "book.xlsx").write_bytes(book_with_shared_strings(10, 3))
    root = f"file://{tmp_path}/in"
    # Tasks note what they open and parse.
    log = str(tmp_path / "log")
    opened, parsed = workbooks.open_read, workbooks._shared_strings

    def note(what, call):
        def noted(x):
            with open(log, "a") as f:
                f.write(what + "\n")
            return call(x)

        return noted

    workbooks.open_read, workbooks._shared_strings = note("open", opened), note("parse", parsed)
    try:
        listing = workbooks.list_sheets(spark, root).cache()
        assert listing.count() == 20 and listing.select("path", "run").distinct().count() == 2
        schemas = {f"S{i}": T.StructType.fromDDL("A string, B int") for i in range(10)}
        (tmp_path / "log").write_text("")
        workbooks.stage_sheets(spark, root, f"{tmp_path}/staged", schemas)
    finally:
        workbooks.open_read, workbooks._shared_strings = opened, parsed
    notes = (tmp_path / "log").read_text().split()
    # Each book is opened to list its sheets and to read them, and its strings are parsed once for ten sheets.
    assert notes.count("open") == 4 and notes.count("parse") == 2
    for sheet, schema in schemas.items():
        got = workbooks.load_staged(spark, f"{tmp_path}/staged", sheet, schema)
        assert sorted(tuple(r) for r in got.collect()) == [(f"a{r}", r, c) for r in range(3) for c in ("a", "b")]


def test_large_books_are_read_in_runs_of_sheets(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "book.xlsx").write_bytes(book_with_shared_strings(6, 50))
    sizes = [r.packed_bytes for r in workbooks.list_sheets(spark, f"{tmp_path}").collect()]
    runs = workbooks.list_sheets(spark, f"{tmp_path}", task_bytes=2 * max(sizes))
    assert [r["n"] for r in runs.groupBy("run").agg(F.count("*").alias("n")).orderBy("run").collect()] == [2, 2, 2]
    some = workbooks.read_workbooks(spark, f"{tmp_path}", sheets=["S1", "S4"], columns=["B"])
    assert {(r.sheet, r.row_no, tuple(r.cells.items())) for r in some.collect()} == {
        (s, n + 1, (("B", str(n)),)) for s in ("S1", "S4") for n in range(50)
    }


def files_touched(folder, column, value):
    """Share of the files whose statistics of ``column`` do not rule ``value`` out."""
    ranges = []
    for path in folder.glob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        ranges += [(s.min, s.max) for s in stats if s is not None and s.has_min_max]
    return sum(low <= value <= high for low, high in ranges) / len(ranges)


def test_a_curve_lets_filters_on_every_column_skip_files(spark, tmp_path):
    df = spark.range(20_000).select(
        F.pmod(F.hash("id", F.lit(1)), F.lit(1000)).alias("a"),
        F.concat(F.lit("k"), F.lpad(F.pmod(F.hash("id", F.lit(2)), F.lit(500)).cast("string"), 4, "0")).alias("b"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.hash("id", F.lit(3)), F.lit(300))).alias("c"),
    )
    df = df.withColumn("b", F.when(F.col("a") % 50 != 0, F.col("b")))
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.cluster_by_curve(df, f"{tmp_path}/curve", ["a", "b", "c"])
        sinks.cluster_by(df, f"{tmp_path}/sorted", ["a", "b", "c"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    day = dt.date(2024, 4, 1)
    assert files_touched(tmp_path / "sorted", "c", day) > 0.9
    for column, value in (("a", 123), ("b", "k0123"), ("c", day)):
        assert files_touched(tmp_path / "curve", column, value) < 0.7
    assert spark.read.parquet(f"{tmp_path}/curve").exceptAll(df).count() == 0 == df.exceptAll(spark.read.parquet(f"{tmp_path}/curve")).count()


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(x, y) for x in range(8) for y in range(8)], "x int, y int")
    for r in df.withColumn("z", curves.interleaved([F.col("x"), F.col("y")], 3)).collect():
        assert r.z == sum((r.x >> b & 1) << 2 * b + 1 | (r.y >> b & 1) << 2 * b for b in range(3))
    places = df.select("x", curves.place([2, 3, 7], F.col("x")).alias("p")).distinct().collect()
    assert {r.x: r.p for r in places} == {0: 0, 1: 0, 2: 1, 3: 2, 4: 2, 5: 2, 6: 2, 7: 3}
    with pytest.raises(ValueError):
        curves.interleaved([F.col("x")] * 8, 8)


def test_layouts_of_hard_columns(spark, tmp_path):
    schema = "flag boolean, s string, m map<string,int>"
    df = spark.createDataFrame([(None, None, None), (True, "x", {"a": 1}), (True, "x", {"a": 1})], schema)
    sinks.cluster_by_curve(df, f"{tmp_path}/t", ["flag", "s"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3
    sinks.cluster_by_curve(df.limit(0), f"{tmp_path}/e", ["flag", "s"])


def test_a_tree_is_listed_in_tasks_without_the_drivers_file_index(spark, tmp_path):
    sizes = {"a.txt": 1, "x/b #1.txt": 2, "x/y/c%20.txt": 3, "x/y/z/d.txt": 4, "_day=1/e.txt": 5}
    for name, size in (sizes | {"_tmp": 9, ".hidden/f.txt": 9, "x/_SUCCESS": 9, "x/g._COPYING_": 9}).items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"x" * size)
    (tmp_path / "in" / "empty").mkdir()
    root = f"file://{tmp_path}/in"
    found = files.list_tree(spark, root)
    below = files.below(spark, root, F.col("path"))
    assert {(r[0], r[1]) for r in found.select(below, "size_bytes").collect()} == set(sizes.items())
    same = files.list_files(spark, root)
    assert {(r.file_name, r.size_bytes) for r in found.collect()} == {(r.file_name, r.size_bytes) for r in same.collect()}
    # Result and plan hold the levels' listings, not the files themselves.
    assert "binaryFile" not in found._jdf.queryExecution().toString() and len(found.inputFiles()) < 40


def test_rows_of_a_sheet_are_read_without_a_step_per_element():
    # Rows longer than a block, empty rows, gaps, unnamed columns and shared strings.
    main = workbooks.MAIN[1:-1]
    long = "x" * (3 * workbooks.BLOCK_BYTES)
    body = '<row><c r="A1" t="inlineStr"><is><r><t>A</t></r><r><t>a</t></r></is></c><c r="C1"><v>C</v></c></row>'
    body += "".join(f'<row><c r="A{i}" t="s"><v>{i % 2}</v></c><c r="B{i}"><v>7</v></c></row><row/>' for i in range(4000))
    body += f'<row><c r="C9" t="inlineStr"><is><t>{long}</t></is></c></row>'
    xml = f'<worksheet xmlns="{main}"><cols><col/></cols><sheetData>\n{body}</sheetData><row/></worksheet>'.encode()
    stream, blocks = io.BytesIO(xml), []

    class Noted:
        def read(self, n):
            blocks.append(n)
            return stream.read(n)

    assert sum(1 for _ in workbooks._row_elements(Noted())) == 8002
    assert set(blocks) == {workbooks.BLOCK_BYTES}
    with zipfile.ZipFile(io.BytesIO(), "w") as z:
        z.writestr("s.xml", xml)
        found = list(workbooks._sheet_batches(z, "p", "s", "s.xml", ["zero", "one"], None))
    cells = [c for b in found for c in b.column(3).to_pylist()]
    assert [b.num_rows for b in found] == [5000, 3001]
    assert cells[:4] == [[("Aa", "zero")], [], [("Aa", "one")], []] and cells[-1] == [("C", long)]


def test_workbook_rows_use_all_cores(spark, tmp_path):
    # One small file is one task.
    spark.range(300).select(F.col("id").alias("c_custkey"), F.lit(1.5).alias("c_acctbal")).coalesce(1).write.parquet(f"file://{tmp_path}/customer.parquet")
    rows = catalog_files.workbook_rows(Frames(spark, f"file://{tmp_path}"))
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert rows.count() == 300 * 10 + 3 * 10
