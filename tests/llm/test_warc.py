import glob
import gzip
import hashlib
import io
import zipfile

import pytest

from tests.conftest import SF_ORACLE
from tests.oracle_check import compare, duck
from tidemark.llm import warc_zip
from tidemark.llm.queries import LLM_ORACLE, LLM_QUERIES
from tidemark.session import fresh_path


def test_query_matches_sql(spark):
    n, problems = compare(LLM_QUERIES["op2_warc_zip"](spark, SF_ORACLE), duck(SF_ORACLE), LLM_ORACLE["op2_warc_zip"])
    assert n == 250 and not problems


def test_odd_pages(spark):
    big = "é" * 600 + "\r\n\r\n\x00end\n"
    rows = [(1, "http://a/ x\r\ny", big), (5, None, big), (3, "http://b", big), (5, None, big), (None, None, big), (7, "u", "small"), (8, "u", "small"),
            (9, "u", None), (10, "u", ""), (11, "u", "x" * 3_000_000), (12, "u", "e" * 999), (13, "u", "e" * 999)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "html as payload", "page_id as owner")
    folder = warc_zip.write_archives(df.repartition(3), fresh_path(spark, "warc-test"))
    got = sorted((tuple(r) for r in warc_zip.read_archives(spark, folder).collect()), key=str)
    want = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        revisit = html == big and page_id != 5
        want.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", 5 if revisit else None))
    assert got == sorted(want, key=str)
    for path in glob.glob(f"{folder}/part-*"):
        with zipfile.ZipFile(path) as z:  # another reader agrees on members, sizes and checksums
            assert z.testzip() is None and z.namelist() == [warc_zip.DATA, warc_zip.INDEX]


@pytest.mark.parametrize("chunks", [[b"\n"], [b"a\nb", b"", b"c\n"], [b"x" * 70_000, b"\n", b"y\n" * 50_000, b"z\n"], [b"\n\n", b"\n"], [b"x" * 70_000 + b"\n"],
                                    [b"a\n", b"x" * 70_000 + b"\n"]])
def test_lines_give_the_stream_back(chunks):
    assert b"".join(x + b"\n" for x in warc_zip.text_lines(iter(chunks))) == b"".join(chunks)


def test_records_are_gzip_streams_of_one_member():
    raw = b"".join(warc_zip.archive_chunks(iter([(1, "u", b"payload" * 300, None), (2, "u", b"payload" * 300, 1)])))
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        text = gzip.decompress(z.read(warc_zip.DATA))
    assert text.count(b"WARC/1.1\r\n") == 3 and text.count(b"payload" * 300) == 1


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = warc_zip.write_archives(df, fresh_path(spark, "warc-empty"))
    assert warc_zip.read_archives(spark, folder).collect() == []


def test_plain_zip_without_zip64_and_with_a_comment(tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x", b"hello")
        z.comment = b"PK\x05\x06 is only a comment"
    f = warc_zip.RangeFile(f"file:{path}")
    (m,) = warc_zip.central_directory(f)
    assert f.read(warc_zip.data_start(f, m), m.size) == b"hello"


def test_compressed_members_and_broken_files_are_refused(tmp_path):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x", b"hello" * 100)
    f = warc_zip.RangeFile(path if "://" in path else f"file:{path}")
    with pytest.raises(ValueError):
        warc_zip.data_start(f, warc_zip.central_directory(f)[0])
    (tmp_path / "b").write_bytes(b"no archive" * 10)
    with pytest.raises(ValueError):
        warc_zip.central_directory(warc_zip.RangeFile(f"file:{tmp_path}/b"))


def test_damaged_payload_is_noticed():
    raw = warc_zip.page_record(1, "u", b"payload", None)
    assert warc_zip.parse_record(raw)[0] == 1
    with pytest.raises(ValueError):
        warc_zip.parse_record(raw.replace(b"payload\r\n\r\n", b"pay1oad\r\n\r\n"))
