import base64
import gzip
import hashlib

import pyarrow.fs as pafs

from orthoskein.llm import warc

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    out = []
    best = {}
    for page_id, _, html in rows:
        if page_id is not None:
            best[html or ""] = max(best.get(html or "", page_id), page_id)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        top = best.get(html or "")
        again = top is not None and page_id != top
        out.append((page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ROWS = [(i, f"http://h{i % 7}.example.com/{i}?q={i}#f", f"<p>{i % 40}</p>" * (i % 9)) for i in range(3000)]
ODD = [(9000, None, None), (9001, "not a url", "é" * 5000), (9002, "http://[bad", "x"), (9003, "http://a.b\r\nX: 1", "y"), (None, "http://n.o/", "z"), (None, "http://n.o/", "<p>1</p>"), (1, ROWS[1][1], ROWS[1][2])]


def test_matches_brute_force(spark):
    for rows in (ROWS + ODD, [], ODD[:1], [(None, None, None)] * 3):
        archive, blocks = warc.write_archive(spark.createDataFrame(rows, SCHEMA).repartition(4))
        assert rows_of(warc.read_archive(archive, blocks)) == brute(rows)


def test_lookup_and_format(spark):
    archive, _ = warc.write_archive(spark.createDataFrame(ROWS, SCHEMA))
    wanted = [(ROWS[2999][1], 2999), (ROWS[5][1], 5), ("http://h0.example.com/none", 1)]
    got = {r.page_id: r.payload for r in warc.lookup(archive, spark.createDataFrame(wanted, "url string, page_id long")).collect()}
    assert bytes(got[2999]).decode() == ROWS[2999][2]
    assert got[1] is None
    fs, root = pafs.FileSystem.from_uri(archive.folder)
    names = [f.path for f in fs.get_file_info(pafs.FileSelector(root)) if f.path.endswith(".warc.gz")]
    text = b"".join(gzip.decompress(fs.open_input_file(n).read()) for n in names)
    assert text.count(b"WARC/1.1\r\n") == len(ROWS)


def test_keys():
    assert warc.surt("https://www.Example.org:443/a?b=c#d") == "org,example,www)/a?b=c"
    assert warc.surt("http://example.org:8080") == "org,example:8080)/"
    assert warc.surt(None) == ""
