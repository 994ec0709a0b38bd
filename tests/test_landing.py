from __future__ import annotations

import datetime as dt
import hashlib
import io
import zipfile

import pytest

from pyspark.sql import functions as F

from millrace.plans import land as landing
from millrace.plans.land import land
from millrace.sources.manifest import (
    advance_state,
    in_window,
    newest_batch,
    oldest_first,
    of_feeds,
    parse_index,
    verify,
)

BASE = "http://feed.example/v2"


def index(spark, *lines):
    return parse_index(spark.createDataFrame([(line,) for line in lines], "value string"))


def test_index_line(spark):
    got = index(spark, f"4711 0a1b2c {BASE}/20250318064500.export.CSV.zip").first()
    assert (got.feed, got.size, got.md5) == ("export", 4711, "0a1b2c")
    assert got.file_ts == dt.datetime(2025, 3, 18, 6, 45)
    assert (got.dt, got.hour) == (dt.date(2025, 3, 18), 6)
    assert got.file_name == "20250318064500.export.CSV.zip"


@pytest.mark.parametrize(
    "bad",
    ["  ", "9 x", f"9 x {BASE}/20250318064500.export.CSV.zip more", f"9 x {BASE}/readme.txt",
     f"many md5 {BASE}/20250318064500.export.CSV.zip",
     f"1 md5 {BASE}/20250230000000.export.CSV.zip"],
)
def test_bad_index_lines_drop_out_alone(spark, bad):
    good = f" 1\tmd5  {BASE}/20250318064500.GKG.csv.zip "
    assert [r.feed for r in index(spark, bad, good).collect()] == ["gkg"]


def test_parts_are_cut_at_any_white_space(spark):
    line = f"\u00a017\u2003abc\x1c{BASE}/20250318064500.export.CSV.zip\u3000"
    got = index(spark, line).first()
    assert (got.size, got.md5, got.feed) == (17, "abc", "export")


def test_feed_and_window(spark):
    files = index(spark, *[f"1 m {BASE}/2026072312{m}00.{f}.CSV.zip"
                           for m in ("30", "00", "15") for f in ("export", "mentions")])
    chosen = in_window(of_feeds(files, ["export"]), dt.datetime(2026, 7, 23, 12), dt.datetime(2026, 7, 23, 12, 30))
    assert [r.file_ts.minute for r in oldest_first(chosen).collect()] == [0, 15]


def test_state_never_moves_back(spark):
    state = spark.createDataFrame(
        [("a", dt.datetime(2026, 1, 2)), ("b", dt.datetime(2026, 1, 2))], "feed string, ts timestamp"
    )
    seen = spark.createDataFrame(
        [("a", dt.datetime(2026, 1, 1)), ("b", dt.datetime(2026, 1, 3)), ("c", dt.datetime(2026, 1, 1))],
        "feed string, file_ts timestamp",
    )
    got = {r.feed: r.ts.day for r in advance_state(state, seen).collect()}
    assert got == {"a": 2, "b": 3, "c": 1}


def test_verify_statuses(spark):
    wanted = spark.createDataFrame(
        [("f", "ok", "d1"), ("f", "bad", "d1"), ("f", "free", ""), ("f", "old", "zz"), ("f", "none", "d1")],
        "feed string, file_name string, md5 string",
    )
    digests = spark.createDataFrame(
        [("ok", "d1"), ("bad", "d2"), ("free", "d3"), ("old", "d4")], "file_name string, digest string"
    )
    landed = spark.createDataFrame([("f", "old")], "feed string, file_name string")
    got = {r.file_name: r.status for r in verify(wanted, digests, landed).collect()}
    assert got == {"ok": "landed", "bad": "failed", "free": "landed", "old": "skipped", "none": "failed"}


def test_newest_batch(spark):
    files = spark.createDataFrame([("a/1", 1), ("a/3", 2), ("a/2", 3), ("a/3", 4)], "path string, n int")
    assert sorted(r.n for r in newest_batch(files).collect()) == [2, 4]


def _zip(text):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as container:
        container.writestr("x.CSV", text)
    return buffer.getvalue()


def test_landing_is_idempotent_and_a_bad_file_fails_alone(spark, schema, tmp_path):
    payloads = {f"2026072312{m}00.export.CSV.zip": _zip(f"{m}\tone\n{m}\ttwo") for m in ("00", "15")}
    lines = []
    for name, payload in payloads.items():
        (tmp_path / name).write_bytes(payload)
        lines.append(f"{len(payload)} {hashlib.md5(payload).hexdigest()} {BASE}/{name}")
    (tmp_path / "20260723123000.export.CSV.zip").write_bytes(_zip("cut off"))
    lines.append(f"1 00ff00ff {BASE}/20260723123000.export.CSV.zip")
    manifest = index(spark, *lines)
    tables = (f"{schema}.lines", f"{schema}.state")
    first = land(spark, manifest, str(tmp_path), *tables)
    assert first == {"landed": 2, "skipped": 0, "failed": 1}
    held = spark.table(tables[0])
    assert held.columns == ["_raw_line", "_source_file", "feed", "dt", "hour"]
    assert {(r._raw_line, r.feed, r.hour) for r in held.collect()} == {
        ("00\tone", "export", 12), ("00\ttwo", "export", 12),
        ("15\tone", "export", 12), ("15\ttwo", "export", 12),
    }
    assert spark.table(tables[1]).first().ts == dt.datetime(2026, 7, 23, 12, 15)
    again = land(spark, manifest, str(tmp_path), *tables)
    assert again == {"landed": 0, "skipped": 2, "failed": 1}
    assert spark.table(tables[0]).count() == 4
    assert spark.table(tables[1]).first().ts == dt.datetime(2026, 7, 23, 12, 15)


def test_landing_heals_after_a_crash_before_the_file_was_recorded(spark, schema, tmp_path):
    payload = _zip("a\nb")
    name = "20260723120000.export.CSV.zip"
    (tmp_path / name).write_bytes(payload)
    manifest = index(spark, f"1 {hashlib.md5(payload).hexdigest()} {BASE}/{name}")
    tables = (f"{schema}.lines", f"{schema}.state")
    land(spark, manifest, str(tmp_path), *tables)
    spark.sql(f"TRUNCATE TABLE {tables[0]}_files")
    assert land(spark, manifest, str(tmp_path), *tables)["landed"] == 1
    assert spark.table(tables[0]).count() == 2


def test_every_feed_lands_and_a_failed_file_is_opened_once(spark, schema, tmp_path, monkeypatch):
    names = ["20250318060000.export.CSV.zip", "20250318060000.mentions.CSV.zip", "20250318060000.gkg.csv.zip"]
    payload, lines = _zip("a\nb"), []
    for folder in ("a", "x", "y"):
        (tmp_path / folder).mkdir()
    for name in names:
        (tmp_path / "a" / name).write_bytes(payload)
        lines.append(f"1 {hashlib.md5(payload).hexdigest()} {BASE}/{name}")
    broken, twice = "20250318061500.export.CSV.zip", "20250318063000.export.CSV.zip"
    (tmp_path / "a" / broken).write_bytes(b"no archive")
    lines.append(f"1 {hashlib.md5(b'no archive').hexdigest()} {BASE}/{broken}")
    for folder in ("x", "y"):
        (tmp_path / folder / twice).write_bytes(payload)
    lines.append(f"1 {hashlib.md5(payload).hexdigest()} {BASE}/{twice}")
    files = f"{tmp_path}/*"
    manifest, tables = index(spark, *lines), (f"{schema}.lines", f"{schema}.state")
    assert land(spark, manifest, files, *tables, chunk=2) == {"landed": 3, "skipped": 0, "failed": 2}
    assert {r.feed: r.n for r in spark.table(tables[0]).groupBy("feed").agg(F.count("*").alias("n")).collect()} == {
        "export": 2, "mentions": 2, "gkg": 2,
    }
    opened = []
    real = landing.examine
    monkeypatch.setattr(landing, "examine", lambda session, paths: opened.append(paths) or real(session, paths))
    assert land(spark, manifest, files, *tables) == {"landed": 0, "skipped": 3, "failed": 2}
    assert opened == []
    (tmp_path / "a" / broken).write_bytes(payload + b" ")  # changed, and still wrong
    assert land(spark, manifest, files, *tables)["failed"] == 2
    assert [[p.rsplit("/", 1)[-1] for p in w] for w in opened] == [[broken]]


def test_a_corrected_checksum_reopens_the_file(spark, schema, tmp_path):
    payload, name = _zip("a\nb"), "20260723120000.export.CSV.zip"
    (tmp_path / name).write_bytes(payload)
    tables = (f"{schema}.lines", f"{schema}.state")
    wrong = index(spark, f"1 00ff00ff {BASE}/{name}")
    assert land(spark, wrong, str(tmp_path), *tables) == {"landed": 0, "skipped": 0, "failed": 1}
    right = index(spark, f"1 {hashlib.md5(payload).hexdigest()} {BASE}/{name}")
    assert land(spark, right, str(tmp_path), *tables) == {"landed": 1, "skipped": 0, "failed": 0}
    assert spark.table(tables[0]).count() == 2
