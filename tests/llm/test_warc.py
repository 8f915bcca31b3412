import hashlib

import pytest
import zstandard

from panelcast.llm import warc


@pytest.fixture
def pages(spark):
    big = "<p>é " + "word " * 300
    rows = [(i, f"http://h/{i}", f"<html>{i} " + "same words here " * (i % 50) + "</html>") for i in range(120)]
    rows += [(200, "http://h/é \n", big), (201, "u", big), (205, None, big), (202, "u", "small"), (203, "u", "small"), (204, None, None), (206, "u", "")]
    rows += [(None, "u", big), (205, "again", big), (300, "u", "x" * 3_000_000), (301, "u", "\x00\r\n\r\nWARC/1.1\r\n")]
    return spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, payload string").repartition(4)


def test_round_trip(spark, pages):
    path = warc.archive_path(spark)
    warc.write_archives(pages, path)
    got = warc.read_archives(spark, path).collect()
    want = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (i or -1, len(p), hashlib.sha1(p).hexdigest()) for i, p in want
    )
    payloads = dict(want)
    for r in got:
        if r.record_type == "response":
            assert r.refers_to is None and bytes(r.payload) == payloads[r.page_id]
        else:
            assert r.payload is None and r.refers_to == 205
    assert sorted((r.page_id or -1) for r in got if r.record_type == "revisit") == [-1, 200, 201]


def test_archives_are_standard_frames(spark, pages, tmp_path):
    path = warc.archive_path(spark)
    warc.write_archives(pages, path)
    files = [r.content for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).collect()]
    assert files
    for data in map(bytes, files):
        assert data[:4] == warc.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        assert dictionary.dict_id()
        # any record by its offset alone, with the library's own frame reader
        for a, b in list(warc.frames(data))[:5]:
            params = zstandard.get_frame_parameters(data[a:b])
            assert params.dict_id == dictionary.dict_id() and params.has_checksum
            text = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(data[a:b])
            assert text.startswith(b"WARC/1.1\r\n") and len(text) == params.content_size


def test_dictionary_makes_small_records_smaller(spark):
    records = [warc.build_record(i, f"http://host/{i}", b"<html>%d</html>" % i, 14, hashlib.sha1(b"%d" % i).digest(), None) for i in range(400)]
    dictionary = zstandard.ZstdCompressionDict(warc.train_dictionary(records[::2]))
    plain, shared = zstandard.ZstdCompressor(3), zstandard.ZstdCompressor(3, dict_data=dictionary)
    assert sum(len(shared.compress(r)) for r in records[1::2]) < 0.6 * sum(len(plain.compress(r)) for r in records[1::2])


def test_damage_is_found():
    record = warc.build_record(1, "u", b"payload", 7, hashlib.sha1(b"payload").digest(), None)
    assert warc.parse_record(record).payload == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def test_empty_table(spark, pages):
    path = warc.archive_path(spark)
    warc.write_archives(pages.limit(0), path)
    assert warc.read_archives(spark, path).collect() == []
