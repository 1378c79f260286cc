import gzip
import hashlib

from pyarrow import fs

from tablework.llm.warc import read_warc, records, write_warc

SCHEMA = "page_id long, url string, html string, shard int"
BIG = "<p>ü long page</p>" * 100
ROWS = [
    (1, "http://a/1", BIG, 0), (2, "http://a/2 x\r\ny", "short", 0), (3, None, BIG, 0), (4, "http://a/4", None, 0), (5, "http://a/5", "", 0),
    (6, "u", "short", 0), (7, "u", BIG + "!", 0), (8, "u", "z" * 1000, 0), (9, "u", "z" * 1000, 0), (10, "u", "z" * 999, 0), (11, "u", "z" * 999, 0),
    (None, "none", BIG, 0), (-4, "negative", "WARC/1.1\r\n\r\n\r\n\r\n", 0), (9, "u", "z" * 1000, 0), (20, "long", "0123456789" * 300_000, 0),
]


def expected():
    out = []
    for page_id, _, html, _ in ROWS:
        body = (html or "").encode()
        same = [r[0] for r in ROWS if (r[2] or "") == (html or "") and r[0] is not None]
        again = len(body) >= 1000 and (page_id is None or page_id < max(same))
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", max(same) if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    manifest = write_warc(df, f"file://{tmp_path}/out", shards=3, roll_bytes=2000).collect()
    rows = read_warc(spark, f"file://{tmp_path}/out").collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected()
    assert all(r.payload_digest == hashlib.sha1(r.payload).hexdigest() for r in rows if r.record_type == "response")
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert names == sorted(["_manifest", *[m.file for m in manifest]]) and len(names) > 4
    order = []
    for m in sorted(manifest, key=lambda m: m.file):
        raw = (tmp_path / "out" / m.file).read_bytes()
        assert (m.bytes, m.sha1) == (len(raw), hashlib.sha1(raw).hexdigest())
        with gzip.open(tmp_path / "out" / m.file) as stream:
            heads = [h for h, _ in records(stream)]
        assert heads[0]["WARC-Type"] == "warcinfo" and len(heads) == m.records + 1
        assert m.bytes <= 2000 or m.records == 1
        order += [h["WARC-Record-ID"] for h in heads[1:]]
    ids = sorted((r[0] for r in ROWS if r[0] is not None))
    assert order == [f"<urn:page:{i}>" for i in ids] + ["<urn:page:none>"]


def test_same_files_again(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for name, table in (("a", df), ("b", df.repartition(5, "html"))):
        write_warc(table, f"file://{tmp_path}/{name}", shards=2, roll_bytes=5000)
    read = [{p.name: p.read_bytes() for p in (tmp_path / n).glob("*.gz")} for n in "ab"]
    assert read[0] == read[1] and read[0]


def test_empty_table(spark, tmp_path):
    assert write_warc(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/e").collect() == []
    assert read_warc(spark, f"file://{tmp_path}/e").collect() == []
    assert fs.LocalFileSystem().get_file_info(f"{tmp_path}/e/_temporary").type == fs.FileType.NotFound
