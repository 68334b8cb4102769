import base64
import hashlib
import re
from pathlib import Path

import numpy as np
import pytest

from framelake.llm import warc
from framelake.llm.common import new_path

FAKE = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: %d\r\n\r\n"


def plain(data: bytes):
    """Records by a sequential walk from the start: (offset, type, id, refers, payload); where the walk ended."""
    at, out = 0, []
    while at < len(data):
        head = re.match(rb"WARC/1\.\d\r\n(.*?)\r\n\r\n", data[at:], re.S)
        size = head and re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head[1].replace(b"\r", b""))
        if not size or at + head.end() + int(size[1]) + 4 > len(data):
            break
        block = data[at + head.end() : at + head.end() + int(size[1])]
        field = lambda n: (re.search(rb"(?im)^%s: <urn:page:(.*)>$" % n, head[1].replace(b"\r", b"")) or [None, b""])[1].decode() or None
        kind = re.search(rb"(?im)^warc-type: (\w+)", head[1])[1].decode()
        out.append((at, kind, field(b"warc-record-id"), field(b"warc-refers-to"), block.split(b"\r\n\r\n", 1)[1] if kind == "response" else None))
        at += head.end() + int(size[1]) + 4
    return out, at


def walked(path):
    out, ends = [], {}
    for f in Path(path.removeprefix("file://")).glob("part-*"):
        rows, end = plain(f.read_bytes())
        out += [(f.name, *r) for r in rows]
        if end != f.stat().st_size:
            ends[f.name] = end
    return out, ends


def read(spark, path):
    archives = warc.Archives(spark, path)
    rows = archives.records().collect()
    assert all(r["verified"] in (True, None) for r in rows)
    got = [(r["file"].rsplit("/", 1)[1], r["offset"], r["type"], r["record_id"], r["refers_to"], None if r["payload"] is None else bytes(r["payload"])) for r in rows]
    return got, {r["file"].rsplit("/", 1)[1]: r["offset"] for r in archives.damage().collect()}, rows


@pytest.fixture(params=[None, 3000])
def splits(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    if request.param:
        for name, v in zip(names, (request.param, 1), strict=True):
            spark.conf.set(name, str(v))
    yield request.param
    for name in names:
        spark.conf.unset(name)


def pages():
    r = np.random.default_rng(12)
    whole = FAKE % 3 + "abc\r\n\r\n"
    texts = ["", "x", "WARC/1.1\r\n", "\nWARC/1.", "\nWARC/1.1\r\n", whole, whole * 40, FAKE % 99999, "a" + FAKE % 10**18, "ends\r\n\r\n", "ends\r\n", "\r\n\r\n\r\n", "é WARC/1.0\r\n", None]
    rows = [(k, f"http://x.com/{k}", t) for k, t in enumerate(texts)]
    rows += [(100 + k, "http://x.com/WARC/1.1", "".join(r.choice(["ab ", "\r\n", whole, "\nWARC/1.", "words and so on "], int(r.integers(1, 40))))) for k in range(120)]
    rows += [(300 + k, None, "copy") for k in range(30)] + [(300, "http://other\r\nContent-Length: 7", "copy"), (329, "u", "copy"), (None, "n", "copy"), (None, "n", "own"), (400, "long", "long text\n" * 2_000)]
    return rows


def test_round_trip(spark, splits):
    rows = pages()
    df = spark.createDataFrame([(*x, "n", 1) for x in rows], "page_id long, url string, html string, sha1 string, size int").repartition(3)
    path = new_path(spark, "archives")
    warc.write_archives(df, path)
    got, damaged, full = read(spark, path)
    want, _ = walked(path)
    assert sorted(got, key=str) == sorted(want, key=str) and not damaged
    keep = {}
    for i, _, t in rows:
        if i is not None:
            keep[t or ""] = max(i, keep.get(t or "", i))
    expected = []
    for i, _, t in rows:
        b, k = (t or "").encode(), keep.get(t or "")
        expected.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if k == i else "revisit", None if k == i else k))
    number = lambda v: None if v is None else int(v)
    assert sorted([(number(r["record_id"]), r["size"], r["digest"], r["type"], number(r["refers_to"])) for r in full], key=str) == sorted(expected, key=str)


def test_damage(spark, splits):
    # a cut-off record, bytes changed in the middle, no archive at all, another version: what a walk from the start finds
    path = new_path(spark, "archives")
    warc.write_archives(spark.createDataFrame(pages(), "page_id long, url string, html string").coalesce(1), path)
    folder = Path(path.removeprefix("file://"))
    data = next(folder.glob("part-*")).read_bytes()
    starts = [at for at, *_ in plain(data)[0]]
    (folder / "part-cut").write_bytes(data[: starts[40] + 30])
    (folder / "part-short").write_bytes(data[:-1])
    wrong = bytearray(data)
    wrong[starts[20] : starts[20] + 4] = b"XXXX"
    (folder / "part-wrong").write_bytes(bytes(wrong))
    (folder / "part-other").write_bytes(b"no archive\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    (folder / "part-old").write_bytes(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:a%20b>\r\nContent-Length: 7\r\n\r\na\r\n\r\nbc\r\n\r\n")
    (folder / "part-empty").write_bytes(b"")
    got, damaged, rows = read(spark, path)
    want, ends = walked(path)
    old = [r for r in rows if r["file"].endswith("part-old")]
    assert [(r["record_id"], bytes(r["payload"]), r["size"]) for r in old] == [("a b", b"a\r\n\r\nbc", 7)]  # no HTTP: the block is the payload
    some = lambda rows: sorted((r for r in rows if r[0] != "part-old"), key=str)
    assert some(got) == some(want) and damaged == ends
    assert set(damaged) == {"part-cut", "part-short", "part-wrong", "part-other"}


def test_least_size_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"), (4, "d", "yyyy")], "page_id long, url string, html string")
    path = new_path(spark, "archives")
    warc.write_archives(df, path, least=3)
    assert sorted((r["record_id"], r["type"], r["refers_to"]) for r in warc.Archives(spark, path).records().collect()) == [
        ("1", "response", None), ("2", "response", None), ("3", "revisit", "4"), ("4", "response", None),
    ]
    path = new_path(spark, "archives")
    warc.write_archives(df.limit(0), path)
    empty = warc.Archives(spark, path)
    assert empty.records().count() == 0 and empty.damage().count() == 0


def test_pointer_jumping():
    r = np.random.default_rng(3)
    for n in (1, 2, 50):
        to = np.array([min(n - 1, k + int(r.integers(0, 4))) for k in range(n)])
        for start in range(n):
            on, at = {start}, start
            while to[at] not in on:
                at = int(to[at])
                on.add(at)
            assert set(np.flatnonzero(warc.marked(to, start))) == on and warc.jumped(to)[start] == at
