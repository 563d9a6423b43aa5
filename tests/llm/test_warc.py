"""Archives written and read back, by frames and by rows."""

import hashlib
import random
import struct

import pytest
import zstandard

from devicepulse.llm import warc

LONG = "<p>" + "x" * 1200 + "é</p>"
ROWS = [
    (1, "http://a/", LONG),
    (2, "http://b/\r\nX: y", LONG),
    (9, None, LONG),
    (9, "http://c/", LONG),
    (None, "http://n/", LONG),
    (3, "http://s/", "short"),
    (4, "http://s/", "short"),
    (5, "http://e/", None),
    (6, "http://e/", ""),
    (7, "http://l/", "long " * 200_000),
    (8, "http://h/", "a\r\n\r\nWARC/1.1\r\n\r\nb" * 100),
    (None, "http://o/", "only " * 300),
    (None, "http://o/", "only " * 300),
]
SCHEMA = "page_id bigint, url string, html string"


def expected(rows):
    out = []
    for id_, _, html in rows:
        raw = (html or "").encode()
        same = [i for i, _, h in rows if i is not None and (h or "") == (html or "")]
        first = max(same) if len(raw) >= 1000 and same else id_
        kind = "response" if first == id_ else "revisit"
        out.append((id_, kind, len(raw), hashlib.sha1(raw).hexdigest(), first if kind == "revisit" else None))
    return sorted(map(str, out))


def got(df):
    return sorted(
        str((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to)) for r in df.collect()
    )


@pytest.mark.parametrize("parts", [1, 7])
def test_round_trip(spark, parts):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(parts)
    archives = warc.write(pages, warc.new_folder(spark))
    back = warc.read(archives)
    assert got(back) == expected(ROWS)
    payloads = {bytes(r.payload) for r in back.collect() if r.payload is not None}
    assert payloads == {(h or "").encode() for _, _, h in ROWS}
    assert sum(r.records for r in archives.collect()) == len(ROWS)


def test_archives_are_cut_and_lead_with_their_dictionary(spark):
    rnd = random.Random(1)
    rows = [(i, f"http://p/{i}", " ".join(rnd.choices(["alpha", "beta", "gamma"], k=400))) for i in range(300)]
    limits = warc.Limits(sample_bytes=20_000, dictionary_bytes=4096, archive_bytes=10_000)
    archives = warc.write(spark.createDataFrame(rows, SCHEMA).coalesce(1), warc.new_folder(spark), limits)
    listed = archives.collect()
    assert len(listed) > 2
    assert got(warc.read(archives)) == expected(rows)
    system, path = warc._open(listed[0].path)
    data = system.open_input_stream(path, compression=None).read()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D
    # Any record can be read alone, from its own frame.
    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    first = coder.decompressobj().decompress(data[8 + size :])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert len(list(warc.frames(listed[0].path))) == listed[0].records


def test_no_rows_and_extra_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.read(warc.write(none, warc.new_folder(spark))).collect() == []
    pages = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "url AS digest", "html AS payload", "page_id AS id")
    assert got(warc.read(warc.write(pages, warc.new_folder(spark)))) == expected(ROWS)


def test_a_broken_archive_raises(tmp_path):
    path = tmp_path / "x.warc.zst"
    path.write_bytes(b"no dictionary here")
    with pytest.raises(ValueError, match="dictionary"):
        list(warc.frames(str(path)))
