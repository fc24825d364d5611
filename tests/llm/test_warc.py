import pyarrow.fs
import zstandard

import brute
from sensorloom.llm import warc


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r.page_id, r.html) for r in pages.collect()]
    assert answer(warc.archived(pages)) == brute.warc(rows)


ROWS = [
    (1, "http://a/ b\r\nX: y", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (9, "é", "é\r\n\r\n"),
    (5, "u", "x" * 900_000), (6, "u", "x" * 900_000), (7, "u", "own"), (7, "u", "own"), (8, "u", "WARC/1.1"),
]


def frame(spark):
    return spark.createDataFrame(
        [(i, u, h, "p", 1) for i, u, h in ROWS],
        "page_id long, url string, html string, payload string, refers_to int",
    )


def test_hard_cases(spark):
    pages = frame(spark)
    assert answer(warc.archived(pages)) == brute.warc([(i, h) for i, _, h in ROWS])
    assert warc.archived(pages.limit(0)).collect() == []
    nulls = spark.createDataFrame([(None, None, "a"), (3, None, "a"), (None, None, "b")], "page_id long, url string, html string")
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.archived(nulls).collect()}
    assert got == {(None, "revisit", 3), (3, "response", None), (None, "response", None)}


def test_min_bytes_and_payloads(spark, tmp_path):
    index = warc.write_archive(frame(spark), f"file://{tmp_path}/w", min_bytes=4)
    got = {(r.page_id, r.record_type): r for r in warc.read_records(index).collect()}
    assert (3, "response") in got and (4, "response") in got and (1, "revisit") in got
    assert got[5, "revisit"].payload is None and got[5, "revisit"].payload_bytes == 900_000
    assert got[6, "response"].payload == b"x" * 900_000
    assert got[9, "response"].payload.decode() == "é\r\n\r\n"
    assert got[1, "revisit"].url == "http://a/%20b%0D%0AX:%20y"


def test_single_records_and_plain_decompression(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/w"
    index = warc.write_archive(frame(spark).coalesce(1), folder)
    some = warc.read_records(index.where("page_id in (2, 9)")).collect()
    assert {r.page_id for r in some} == {2, 9}
    # any Zstandard reader gets the plain archive: the seek table is a skippable frame
    plain = b""
    for name in (tmp_path / "w").iterdir():
        reader = zstandard.ZstdDecompressor().stream_reader(name.read_bytes(), read_across_frames=True)
        plain += reader.read()
    assert plain.count(b"WARC-Type: ") == len(ROWS)
    # the index's places hold in the seek table's frames
    for r in index.collect():
        reader = warc.BundleReader(r.bundle)
        data = reader.read(r.frame)[r.offset : r.offset + r.length]
        assert f"<urn:page:{r.page_id}>".encode() in data
        reader.close()
