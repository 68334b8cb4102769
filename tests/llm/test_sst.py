import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from framelake.llm import sst

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_pieces_encode_as_whole_texts(plain):
    r = random.Random(4)
    parts = ["the", " The", "é", "ß", "  ", "\n", "\n\n ", "\t", "'s", "'", "12", " 3", "!!", "a\x1cb", "\x85", "\xa0", "\u3000", "日本", "😀", "<|endoftext|>", "‘x’", "\r\n", "İ", "ﬁ", "e\u0301", "\x00", " ", "\n", " ab", "²", "ª", "Ǆ", "\x0b"]
    encoder = sst.Encoder(PATH)
    encoder.most = 8000
    for _ in range(600):
        text = "".join(r.choice(parts) for _ in range(r.randrange(12)))
        text = text if r.random() < 0.5 else " ".join(text.split())
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_shard_lookup():
    w, rows = sst.ShardWriter(3, 2), []
    keys = sorted(sst.key_of(v) for v in [None, -5, 0, 7, 7, 2**40, *range(100, 9000, 3)])
    for k in keys:
        rows += w.add(k, (k[-2:] * 40 if len(k) > 1 else b""))
    data = b"".join(x + b"\n" for x in [*rows, *w.finish()])
    shard = sst.Shard.of(data)
    assert len(shard.blocks) > 2 and shard.docs == len(keys) and [k for k, _ in shard.scan()] == keys
    assert len(shard.get(7)) == 2 and len(shard.get(103)) == 1 and len(shard.get(None)) == 1 and not shard.get(101)
    misses = sum(shard.may_have(sst.key_of(v)) for v in range(20_000, 30_000))
    assert misses < 300
    broken = bytearray(data)
    broken[shard.blocks[1][0] + 9] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        list(sst.Shard.of(bytes(broken)).scan())


def test_round_trip(spark, tmp_path, plain):
    r = random.Random(1)
    rows = [(k * 3 - 50, " ".join(r.choice(["ab", "Cé", "\n", "x1"]) for _ in range(r.randrange(200))), "n") for k in range(300)]
    rows += [(None, "null id", "n"), (4, None, "n"), (7, "", "n"), (rows[9][0], rows[9][1], "n"), (rows[9][0], "other", None), (10**12, "long " * 30_000, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    path = f"file://{tmp_path}/shards"
    sst.write_shards(df, path, PATH, shard_bytes=8000)
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))
    ids = {x[:2]: [*plain.encode(x[1] or "", add_special_tokens=False).ids, 2] for x in rows}
    got = sst.digests(spark, path).orderBy("start").collect()
    assert [g["id"] for g in got] == [x[0] for x in order] and spark.read.format("binaryFile").load(path).count() > 3
    start = 0
    for g in got:
        assert g["start"] == start
        start += g["n_tokens"]
    crc = lambda v: zlib.crc32(np.array(v, "<u4").tobytes())
    assert sorted((str(g["id"]), g["n_tokens"], g["ids_crc32"]) for g in got) == sorted((str(x[0]), len(ids[x[:2]]), crc(ids[x[:2]])) for x in rows)
    back = sst.read_shards(spark, path).where("id = 1000000000000").head()["ids"]
    assert back == ids[(10**12, "long " * 30_000)]
    found = sst.lookup(spark, path, [rows[9][0], 5_000_000, None]).collect()
    assert len(found) == 4
    reader = sst.Reader(spark, path)
    for x in rows:
        assert ids[x[:2]] in [v.tolist() for v in reader.get(x[0])]
    assert len(reader.get(rows[9][0])) == 3 and not reader.get(5_000_000) and len(reader.files) > 3
    assert {g["looked_up"] for g in got if g["id"] is not None and g["id"] % 50 == 0} == {True}
    empty = f"file://{tmp_path}/empty"
    sst.write_shards(df.limit(0), empty, PATH)
    assert sst.digests(spark, empty).count() == 0


def test_bytes_read_by_a_lookup():
    w, rows = sst.ShardWriter(0, 2), []
    for k in range(20_000):
        rows += w.add(sst.key_of(k), bytes(100))
    data, read = b"".join(x + b"\n" for x in [*rows, *w.finish()]), []

    def part(at, size):
        read.append(size)
        return data[at : at + size]

    shard = sst.Shard(part, len(data))
    assert len(shard.get(777)) == 1 and not shard.get(30_000)
    assert len(read) <= 6 and len(shard.blocks) > 20


def test_another_splitting_is_encoded_whole(tmp_path):
    from tokenizers import pre_tokenizers

    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
    other.save(str(tmp_path / "t.json"))
    encoder = sst.Encoder(str(tmp_path / "t.json"))
    assert not encoder.splits
    for text in ("hello world it's", "x", ""):
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == other.encode(text, add_special_tokens=False).ids
