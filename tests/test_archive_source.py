"""The archive source: packing, names decided on the listing, damage, streams that restart, and the sink."""

from __future__ import annotations

import hashlib
import io
import os
import tracemalloc
import zipfile

import pytest

from millrace.sources import archive_source as source
from millrace.sources.places import place


def zipped(*members: bytes) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as container:
        for i, body in enumerate(members):
            container.writestr(f"{i}.CSV", body)
    return buffer.getvalue()


def damaged(body: bytes) -> bytes:
    """An archive whose member no longer matches its checksum."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as container:
        container.writestr("0.CSV", body)
    return buffer.getvalue().replace(body, body[:-1] + b"#", 1)


@pytest.fixture
def drop(tmp_path):
    folder = tmp_path / "dt=2024-01-01" / "hour=1"
    folder.mkdir(parents=True)
    (folder / "a.CSV.zip").write_bytes(zipped(b"one\r\n\n  \t\ntwo", b"second member"))
    (folder / "b.CSV.zip").write_bytes(zipped(b"bad \xff byte\nlast"))
    (tmp_path / "c.CSV.zip").write_bytes(zipped())
    (tmp_path / "d.csv.zip").write_bytes(zipped(b"other suffix"))
    (tmp_path / "odd [1]{2}*.CSV.zip").write_bytes(zipped(b"odd name"))
    return tmp_path


def test_scan(spark, drop):
    want = {("one", "a.CSV.zip"), ("two", "a.CSV.zip"), ("bad \ufffd byte", "b.CSV.zip"), ("last", "b.CSV.zip"),
            ("odd name", "odd [1]{2}*.CSV.zip")}
    for root in (str(drop), f"file://{drop}", f"file:{drop}/"):
        assert {tuple(r) for r in source.scan(spark, root).collect()} == want
    assert source.scan(spark, f"{drop}/nowhere").collect() == []


def test_names_are_decided_on_the_listing(spark, drop):
    """A damaged archive outside the window is not opened, inside it is an error."""
    (drop / "z.CSV.zip").write_bytes(b"no archive at all")
    assert source.scan(spark, str(drop), last="b.CSV.zip").count() == 4
    assert source.scan(spark, str(drop), "b.CSV.zip", "b.CSV.zip").count() == 2
    assert source.scan(spark, str(drop), "c", "p").where("_raw_line LIKE 'odd%'").count() == 1
    with pytest.raises(Exception, match="File is not a zip file"):
        source.scan(spark, str(drop)).count()


def test_two_queries_on_one_frame_do_not_mix(spark, drop):
    lines = source.scan(spark, str(drop))
    some = lines.where("_source_file < 'b'")
    assert (some.count(), lines.count(), some.union(lines).count()) == (2, 5, 7)


def test_packing_by_size():
    found = [source.Found(f"/{i}", str(i), size << 20, 0) for i, size in enumerate([1, 1, 300, 1, 60, 60, 1])]
    assert [p.paths for p in source.packed(found, 128 << 20)] == [["/0", "/1"], ["/2"], ["/3", "/4"], ["/5", "/6"]]
    assert source.packed([], 1) == []


def test_examined(spark, drop):
    (drop / "x.CSV.zip").write_bytes(damaged(b"some text that is long enough"))
    (drop / "y.CSV.zip").write_bytes(zipped(b"cut off " * 900)[:-60])
    paths = sorted(str(p) for p in drop.rglob("*.CSV.zip")) + [f"{drop}/gone.CSV.zip"]
    found = {r._source_file: r for r in source.examine(spark, paths).collect()}
    assert {n for n, r in found.items() if not r.readable} == {"x.CSV.zip", "y.CSV.zip", "gone.CSV.zip"}
    for path in paths[:-1]:
        assert found[os.path.basename(path)].digest == hashlib.md5(open(path, "rb").read()).hexdigest()
    assert found["gone.CSV.zip"].digest is None


def test_a_large_member_is_a_stream(tmp_path):
    """A gigabyte that unpacks from a megabyte: neither is held."""
    path = tmp_path / "large.CSV.zip"
    line = b"x" * 1023 + b"\n"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as container:
        with container.open("0.CSV", "w", force_zip64=True) as member:
            for _ in range(1024):
                member.write(line * 1024)
    tracemalloc.start()
    assert source.check(str(path))[1]
    assert sum(len(b) for b in source.whole_lines(source.member_blocks(str(path)))) > 1000 << 20
    assert tracemalloc.get_traced_memory()[1] < 64 << 20
    tracemalloc.stop()


def test_stream_goes_on_where_it_stopped(spark, drop, tmp_path_factory):
    place_of = tmp_path_factory.mktemp("stream")

    def run():
        lines = source.scan_stream(spark, str(drop), settle=0)
        query = lines.writeStream.format("parquet").option("checkpointLocation", f"{place_of}/state")
        query.trigger(availableNow=True).start(f"{place_of}/out").awaitTermination(120)
        return sorted(r._raw_line for r in spark.read.parquet(f"{place_of}/out").collect())

    first = ["bad \ufffd byte", "last", "odd name", "one", "two"]
    assert run() == first
    assert run() == first
    (drop / "0.CSV.zip").write_bytes(zipped(b"late, with an early name"))
    assert run() == sorted([*first, "late, with an early name"])


def test_a_file_that_may_still_change_waits(drop):
    assert source.ArchiveStreamReader({"path": str(drop), "settle": "3600"}).latestOffset() == {"changed": 0, "path": ""}


def test_sink_and_scan(spark, tmp_path):
    rows = [("a.CSV.zip", "1", b"x"), ("a.CSV.zip", "1", b"y\xff"), ("a.CSV.zip", "2", b"not read"), ("b.CSV.zip", None, None),
            ("c.CSV.zip", "1", None), ("c.CSV.zip", "1", b"z")]
    frame = spark.createDataFrame(rows, "_source_file string, member string, line binary")
    for _ in range(2):
        held = {r._source_file: r for r in source.write_archives(frame, f"file://{tmp_path}/out").collect()}
    files = {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()}
    assert set(files) == set(held) == {"a.CSV.zip", "b.CSV.zip", "c.CSV.zip"}
    for name, data in files.items():
        assert (held[name].size, held[name].digest) == (len(data), hashlib.md5(data).hexdigest())
    got = {tuple(r) for r in source.scan(spark, f"{tmp_path}/out").collect()}
    assert got == {("x", "a.CSV.zip"), ("y\ufffd", "a.CSV.zip"), ("z", "c.CSV.zip")}


@pytest.mark.parametrize("path, inside", [("/a b/c", "/a b/c"), ("file:/a%20b", "/a%20b"), ("file:///x", "/x")])
def test_places(path, inside):
    assert place(path)[1] == inside
