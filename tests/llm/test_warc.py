from hashlib import sha256

import pytest

from medalake.llm import warc

SCHEMA = "page_id bigint, url string, html string"
FAKE = (
    "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:medalake:page:666>\r\n"
    "Content-Length: 5\r\n\r\nhello\r\n\r\n"
)
LONG = "<html>" + "long text é " * 30
ROWS = [
    (1, "http://a/", LONG), (2, "http://b/", LONG), (0, "http://c/", LONG), (3, None, None),
    (4, "http://d/\r\nWARC-Type: evil", "short"), (5, "u", "short"), (6, "u", FAKE),
    (7, "u", "WARC/1.1\r\n"), (8, "u", "WARC/1.WARC/1.1\r\nx\r\n\r\n"), (9, "u", "a" + FAKE * 3),
    (10, "u", "\r\n\r\n"), (11, "u", ""), (None, "n", LONG), (12, "u", "中" * 4000 + FAKE),
    (20, "http://h/WARC/1.1/spec", "after a magic in the url"), (21, "WARC/1.1WARC/1.", LONG + "x"),
    (22, "http://h/WARC/1.0/" + "WARC/1.1" * 5, FAKE), (23, "plain", "after them"),
    (24, "WARC/1.", None), (25, "é/WARC/1.1", "é"),
    (13, "u", "Content-Length: 3\r\n\r\nWARC/1.0\r\nContent-Length: 99999\r\n\r\n"),
]


def wanted(rows):
    first = {}
    for id_, _, html in rows:
        if id_ is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, id_), id_)
    out = []
    for id_, _, html in rows:
        data = (html or "").encode()
        revisit = id_ is not None and first.get(html, id_) < id_
        out.append((
            id_, len(data), sha256(data).hexdigest(), "revisit" if revisit else "response",
            first[html] if revisit else None,
        ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("split,per_file", [("128m", 100), ("64", 100), ("300", 4)])
def test_round_trip_rejects_magic_in_payloads(spark, frame, tmp_path, split, per_file):
    """Whatever the splits that tasks read, and however records fall on files."""
    path, name = f"{tmp_path}/w", "spark.sql.files.maxPartitionBytes"
    before, cost = spark.conf.get(name), spark.conf.get("spark.sql.files.openCostInBytes")
    warc.write_archives(frame(ROWS, SCHEMA), path, records_per_file=per_file)
    try:
        spark.conf.set(name, split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        records = warc.read_archives(spark, path)
        got = sorted(map(tuple, warc.page_records(records).collect()), key=repr)
        full = warc.read_archives(spark, path, payloads=True).collect()
    finally:
        spark.conf.set(name, before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert got == wanted(ROWS)
    assert len(full) == len(ROWS)
    held = {r.payload.decode() for r in full if r.type == "response"}
    assert held == {html or "" for _, _, html in ROWS}


def test_empty_table(spark, frame, tmp_path):
    warc.write_archives(frame([], SCHEMA), f"{tmp_path}/e")
    assert warc.read_archives(spark, f"{tmp_path}/e").count() == 0


def test_a_broken_chain_ends_there(spark, tmp_path):
    good = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    bad = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: nonsense\r\n\r\nxx\r\n\r\n"
    (tmp_path / "b.warc").write_bytes((good * 3 + bad + good).encode())
    with pytest.warns(UserWarning, match="b.warc after byte"):
        assert warc.read_archives(spark, str(tmp_path)).count() == 3
    with pytest.raises(ValueError, match="break off"):
        warc.read_archives(spark, str(tmp_path), broken="fail")


@pytest.mark.parametrize("split", ["128m", "40"])
def test_magic_in_any_header_value(spark, tmp_path, split):
    """Headers of other writers: the magic in several values, and a header that never ends."""
    record = (
        "WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://h/WARC/1.1/WARC/1.0\r\n"
        "X-Made-By: WARC/1.1\r\nWARC-Record-ID: <urn:WARC/1.:{0}>\r\nContent-Length: 9\r\n\r\n"
        "body WARC\r\n\r\n"
    )
    good = "".join(record.format(i) for i in range(5))
    (tmp_path / "a.warc").write_bytes(good.encode())
    (tmp_path / "b.warc").write_bytes((good + "WARC/1.1\r\nWARC-Type: x\r\nY: WARC/1.1").encode())
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        spark.conf.set(names[0], split), spark.conf.set(names[1], "1")
        with pytest.warns(UserWarning, match="b.warc"):
            rows = warc.read_archives(spark, str(tmp_path), payloads=True).collect()
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert len(rows) == 10 and {bytes(r.payload) for r in rows} == {b"body WARC"}
    assert {r.uri for r in rows} == {"http://h/WARC/1.1/WARC/1.0"}
    assert {r.record_id for r in rows} == {f"<urn:WARC/1.:{i}>" for i in range(5)}
