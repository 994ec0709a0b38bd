from __future__ import annotations

import datetime as dt
import io
import zipfile

import pytest
from helpers import event_line

from millrace.contract import EVENTS
from millrace.operators.lines import (
    conformant,
    field_count_distribution,
    malformed_rate,
    raw_frame,
    rejects,
)
from millrace.sources import archives
from millrace.sources.archives import archive_files, lines_of, read_archives, text_blocks


def zipped(*members: bytes) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as container:
        for i, body in enumerate(members):
            container.writestr(f"{i}.CSV", body)
    return buffer.getvalue()


def row(width: int) -> str:
    return "\t".join(str(i) for i in range(width))


@pytest.fixture
def drop(tmp_path):
    def put(day: str, hour: str, name: str, payload: bytes):
        folder = tmp_path / f"dt={day}" / f"hour={hour}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(payload)

    put("2026-07-24", "09", "a.export.CSV.zip", zipped(f"{row(61)}\r\n\n   \n{row(3)}".encode()))
    put("2026-07-24", "10", "empty.export.CSV.zip", zipped())
    put("2026-07-25", "00", "two.export.CSV.zip", zipped(b"first\tone", b"second\tone"))
    put("2026-07-25", "00", "bytes.export.CSV.zip", zipped(b"\x61\xff\x62"))
    put("2026-07-25", "00", "other.export.csv.zip", zipped(b"wrong suffix"))
    return str(tmp_path)


def test_scan_reads_first_member_and_replaces_bad_bytes(spark, drop):
    found = {(r._source_file, r._raw_line) for r in read_archives(spark, drop).collect()}
    assert found == {
        ("a.export.CSV.zip", row(61)),
        ("a.export.CSV.zip", row(3)),
        ("two.export.CSV.zip", "first\tone"),
        ("bytes.export.CSV.zip", "a�b"),
    }


def test_day_filter_prunes_and_partition_columns_are_typed(spark, drop):
    assert dict(archive_files(spark, drop).dtypes)["dt"] == "date"
    assert dict(archive_files(spark, drop).dtypes)["hour"] == "int"
    names = {r._source_file for r in read_archives(spark, drop, "2026-07-24").collect()}
    assert names == {"a.export.CSV.zip"}
    day = archive_files(spark, drop).filter("dt = date'2026-07-24'").select("dt").distinct()
    assert [r.dt for r in day.collect()] == [dt.date(2026, 7, 24)]


def test_folder_without_archives_gives_an_empty_frame(spark, tmp_path):
    (tmp_path / "note.txt").write_text("no archive")
    assert read_archives(spark, str(tmp_path)).count() == 0
    assert read_archives(spark, str(tmp_path), "2026-07-24").count() == 0
    assert raw_frame(read_archives(spark, str(tmp_path))).schema == EVENTS.raw_schema


def test_corrupt_archive_fails_the_read(spark, tmp_path):
    (tmp_path / "bad.CSV.zip").write_bytes(b"no zip at all")
    with pytest.raises(Exception, match="BadZipFile"):
        read_archives(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_blocks_lose_nothing_whatever_their_size(monkeypatch, block):
    body = "a\n\nbb\tä\nccc\n\nlast".encode()
    monkeypatch.setattr(archives, "_BLOCK_BYTES", block)
    lines = [line for part in text_blocks(zipped(body)) for line in part.split(b"\n")]
    assert [line for line in lines if line] == [line for line in body.split(b"\n") if line]


def test_many_archives_larger_than_one_block(spark, tmp_path, monkeypatch):
    for i in range(5):
        body = "\n".join(f"{i}\t{j}" for j in range(5000))
        (tmp_path / f"{i}.CSV.zip").write_bytes(zipped(body.encode()))
    assert lines_of(archive_files(spark, str(tmp_path))).distinct().count() == 25000


@pytest.mark.parametrize(
    ("line", "count"),
    [(row(61), 61), (row(61) + "\t", 61), (row(62), 62), (row(60), 60), (row(3), 3),
     (row(61) + "\t\t", 63), ("x", 1)],
)
def test_field_count_forgives_one_trailing_tab(lines_of, line, count):
    got = raw_frame(lines_of([line])).first()
    assert got._field_count == count
    assert got._raw_line == line
    assert got.source_url == ("60" if count >= 61 else None)
    assert len(got) == 64


def test_line_of_tabs_only_counts_as_blank(spark, tmp_path):
    (tmp_path / "t.CSV.zip").write_bytes(zipped(("\t" * 60 + "\n" + row(61)).encode()))
    assert read_archives(spark, str(tmp_path)).count() == 1


def test_split_into_conformant_and_rejects(lines_of):
    frame = lines_of([row(61), row(61) + "\t", row(60), row(62), event_line()])
    assert conformant(frame).count() == 3
    assert {(r._field_count, r._expected_count) for r in rejects(frame).collect()} == {
        (60, 61),
        (62, 61),
    }
    spread = field_count_distribution(frame)
    assert {tuple(r) for r in spread.collect()} == {(60, 1), (61, 3), (62, 1)}
    assert tuple(malformed_rate(spread).first()) == (5, 2, 0.4)
    assert tuple(malformed_rate(spread.limit(0)).first()) == (0, 0, None)
