"""Archives against a plain reading of their files, round trips, and lost attempts."""

import base64
import gzip
import hashlib
import os

import duckdb
import pytest

from tidemark.llm import queries, warc

from .samples import empty, values

BIG = "é" * 600
SCHEMA = "page_id long, url string, html string"


def table(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def plain_records(folder):
    """(headers, block) of each record, read by splitting the unpacked bytes."""
    for name in sorted(f for f in os.listdir(folder) if f.endswith(".warc.gz")):
        data = gzip.open(f"{folder}/{name}").read()
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            headers = dict(line.split(": ", 1) for line in lines[1:])
            size = int(headers["Content-Length"])
            block, data = data[:size], data[size:]
            assert data[:4] == b"\r\n\r\n"
            data = data[4:]
            yield name, headers, block


def awkward_rows():
    return [
        (1, "http://a.example/x y?é=1", BIG),
        (7, "http://b.example/", BIG),
        (7, "http://b.example/2", BIG),
        (3, None, BIG),
        (4, "http://c.example/\r\nX-Page-Id: 9", "small"),
        (5, "", "small"),
        (6, "http://d.example/", None),
        (8, "http://d.example/", ""),
        (None, "http://e.example/", BIG),
        (None, None, "z" * 2000),
        (None, None, "z" * 2000),
        (9, "http://f.example/", "WARC/1.1\r\n\r\n" * 200),
        (10, "http://g.example/", "x" * 3_000_000),
        (11, "http://h.example/", "y" * 999),
        (12, "http://h.example/", "y" * 999),
        (12, "http://h.example/", "y" * 999),
    ]


def wanted(rows, least=1000):
    """(page, bytes, digest, type, refers_to) by the contract; copies of the largest id: one response."""
    out, had = [], set()
    for page, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data]
        largest = max((p for p in same if p is not None), default=None)
        first = page == largest and data not in had
        kind = "response"
        if len(data) >= least:
            if first:
                had.add(data)
            else:
                kind = "revisit"
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), kind, largest if kind == "revisit" else None))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("shard_bytes", [1000, 64 << 20])
def test_awkward(spark, tmp_path, shard_bytes):
    rows = awkward_rows()
    extra = [(*row, "x", 1) for row in rows]
    pages = table(spark, extra, SCHEMA + ", record_type string, _id int")
    folder = str(tmp_path / "archive")
    warc.write(pages, folder, shard_bytes=shard_bytes, roll_bytes=2000)
    found = warc.read(spark, folder, payloads=True)
    assert values(found, *COLUMNS) == wanted(rows)
    whole = values(warc.restored(found), "page_id", "payload")
    assert whole == sorted(((p, (h or "").encode()) for p, _, h in rows), key=repr)


def test_files_follow_the_format(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write(table(spark, awkward_rows()), f"file://{folder}", roll_bytes=1000)
    ids, refers = set(), set()
    firsts = {}
    for name, headers, block in plain_records(folder):
        firsts.setdefault(name, headers["WARC-Type"])
        ids.add(headers["WARC-Record-ID"])
        assert headers["WARC-Date"] == "2000-01-01T00:00:00Z"
        if headers["WARC-Type"] == "warcinfo":
            assert headers["WARC-Filename"] == name
            continue
        assert headers["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        if headers["WARC-Type"] == "response":
            payload = block.split(b"\r\n\r\n", 1)[1]
            assert headers["WARC-Payload-Digest"][5:] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        else:
            refers.add(headers["WARC-Refers-To"])
            assert block.endswith(b"\r\n\r\n")
    assert len(firsts) > 2 and set(firsts.values()) == {"warcinfo"}
    assert len(ids) == len(awkward_rows()) + len(firsts)
    assert refers <= ids
    assert sorted(os.listdir(folder)) == sorted([*firsts, "manifest"])


def test_same_rows_give_same_files(spark, tmp_path):
    rows = [(n, f"http://x.example/{n}", f"page {n % 50} " * 200) for n in range(400)]

    def files(name, order, parts):
        folder = str(tmp_path / name)
        warc.write(table(spark, order, parts=parts), folder, shard_bytes=60_000, roll_bytes=3000)
        return {f: open(f"{folder}/{f}", "rb").read() for f in os.listdir(folder) if f.endswith("gz")}

    one, other = files("one", rows, 1), files("other", rows[::-1], 5)
    assert one == other and len(one) > 8
    assert len({name.split("-")[1] for name in one}) > 4


def test_lost_attempts_leave_nothing(spark, tmp_path):
    folder = str(tmp_path / "archive")
    os.makedirs(f"{folder}/_temporary")
    open(f"{folder}/_temporary/abc-shard-00000-0000.warc.gz", "wb").write(b"half a fi")
    rows = awkward_rows()
    warc.write(table(spark, rows), folder)
    assert not os.path.exists(f"{folder}/_temporary")
    assert values(warc.read(spark, folder), *COLUMNS) == wanted(rows)
    with pytest.raises(FileExistsError):
        warc.write(table(spark, rows), folder)


def test_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write(table(spark, [(1, "u", "some text")]), folder)
    (name,) = [f for f in os.listdir(folder) if f.endswith("gz")]
    data = gzip.open(f"{folder}/{name}").read().replace(b"some text", b"some test")
    size = os.path.getsize(f"{folder}/{name}")
    packed = gzip.compress(data)
    with open(f"{folder}/{name}", "wb") as file:
        file.write(packed)
    with pytest.raises(Exception, match="does not have|damaged"):
        warc.read(spark, folder).collect()
    assert size
    from tidemark.llm.warc import _page_row, _records
    import io

    with pytest.raises(ValueError, match="damaged"):
        [_page_row(h, b) for h, b in _records(io.BufferedReader(io.BytesIO(data))) if h["warc-type"] != "warcinfo"]
    with pytest.raises(ValueError, match="cut short"):
        list(_records(io.BufferedReader(io.BytesIO(data[:-10]))))


def test_text_ids_and_empty_table(spark, tmp_path):
    rows = [("ü 1\n", "u", BIG), ("b", "u", BIG), (None, "u", BIG)]
    pages = table(spark, rows, "name string, link string, body string")
    folder = str(tmp_path / "one")
    warc.write(pages, folder, id_column="name", url_column="link", payload_column="body")
    found = warc.read(spark, folder, id_column="name", id_type="string")
    assert values(found, "name", "record_type", "refers_to") == sorted(
        [("ü 1\n", "response", None), ("b", "revisit", "ü 1\n"), (None, "revisit", "ü 1\n")], key=repr
    )
    folder = str(tmp_path / "two")
    warc.write(empty(spark, SCHEMA), folder)
    nothing = warc.read(spark, folder)
    assert nothing.collect() == [] and set(COLUMNS) <= set(nothing.columns)


def test_a_hot_payload(spark, tmp_path):
    """A third of all pages are copies: one response, small revisits, in several shards."""
    rows = [(n, f"http://x.example/{n}", BIG if n % 3 == 0 else f"{n} " * 300) for n in range(900)]
    folder = str(tmp_path / "archive")
    warc.write(table(spark, rows), folder, shard_bytes=100_000)
    found = warc.read(spark, folder)
    assert found.where("record_type = 'revisit' AND refers_to = 897").count() == 299
    assert found.where("record_type = 'response'").count() == 601


def test_query_matches_sql(spark, testdata):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS FROM '{testdata}/pages.parquet'")
    query, text = queries.QUERIES["op11_warc"]
    result = duck.execute(text)
    names = [c[0] for c in result.description]
    rows = [tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in result.fetchall()]
    assert values(query(spark, testdata), *COLUMNS) == sorted(rows, key=repr)
