"""Token-ID output as sorted-string-table shards.

A shard is a file of rows, each followed by one line feed: data blocks, the block index, the Bloom filter, the footer.

data block   zstd of entries in key order: varint shared (bytes of the key that equal the last key's), varint rest,
             varint size, the key's other bytes, `size` bytes of token ids (little-endian, `width` bytes each)
block index  zstd of a sparse index, an entry a block: varint key size, first key, u64 offset, u32 size, u32 CRC-32,
             u32 documents, u64 ids
Bloom filter bits, 10 a key, 7 probes from two halves of XXH64
footer       64 bytes: magic, width, sequence number, offset and size of index and filter, documents, ids, probes

Keys are ordered as bytes: 0x00 for a null id, 0x01 and eight bytes (sign flipped, big-endian) for an integer, 0x02 and
UTF-8 for a string. Equal ids keep all their entries. A lookup asks the filter, finds the first block by binary search
in the index, and reads from there.

Spark's own text writer stores the rows, so any Hadoop file system will do, tasks commit or leave nothing, and a lost
executor's shard is written anew. Scans bring whole shards back through the binaryFile reader. A Reader takes one
document from a store of any size by reads of byte ranges: shards are in key order, so a binary search over them reads
the footers and indexes of a few, then one filter and one block.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.llm.common import lean, ready, stored

MAGIC = b"FLSST001"
FOOTER = struct.Struct("<8sIQQIQIQQI")
BLOCK_BYTES = 64 * 1024
SHARD_BYTES = 32 * 1024 * 1024
BITS, PROBES = 10, 7


def key_of(value) -> bytes:
    if value is None:
        return b"\x00"
    if isinstance(value, str):
        return b"\x02" + value.encode()
    return b"\x01" + struct.pack(">Q", (int(value) + (1 << 63)) & ((1 << 64) - 1))


def value_of(key: bytes):
    if key[:1] == b"\x00":
        return None
    return key[1:].decode() if key[:1] == b"\x02" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 127) << shift
        at += 1
        if b < 128:
            return n, at
        shift += 7


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(PROBES, dtype=np.uint64)) % np.uint64(bits)


class ShardWriter:
    """Feeds on keys in order; returns the rows of the shard as they fill."""

    def __init__(self, sequence: int, width: int):
        self.sequence, self.width, self.offset = sequence, width, 0
        self.block, self.first, self.last, self.n, self.ids = bytearray(), b"", b"", 0, 0
        self.index, self.hashes, self.docs, self.total = bytearray(), [], 0, 0
        self.zip = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: bytes) -> Iterator[bytes]:
        if not self.n:
            self.first, self.last = key, b""
        shared = len(os.path.commonprefix([self.last, key]))
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(ids)) + key[shared:] + ids
        self.hashes.append(xxhash.xxh64_intdigest(key))
        self.last, self.n, self.ids = key, self.n + 1, self.ids + len(ids) // self.width
        if len(self.block) >= BLOCK_BYTES:
            yield self._row()

    def _row(self) -> bytes:
        row = self.zip.compress(bytes(self.block))
        self.index += _varint(len(self.first)) + self.first + struct.pack("<QIIIQ", self.offset, len(row), zlib.crc32(row), self.n, self.ids)
        self.docs, self.total, self.offset = self.docs + self.n, self.total + self.ids, self.offset + len(row) + 1
        self.block, self.n, self.ids = bytearray(), 0, 0
        return row

    def finish(self) -> Iterator[bytes]:
        if self.n:
            yield self._row()
        index = self.zip.compress(bytes(self.index))
        bits = max(64, BITS * len(self.hashes))
        flags = np.zeros(bits, bool)
        if self.hashes:
            flags[_probes(np.array(self.hashes, np.uint64), bits).ravel()] = True
        bloom = np.packbits(flags, bitorder="little").tobytes()
        at = self.offset + len(index) + 1
        yield index
        yield bloom
        yield FOOTER.pack(MAGIC, self.width, self.sequence, self.offset, len(index), at, bits, self.docs, self.total, PROBES)


class Shard:
    """A shard, opened for lookups and scans. read(offset, size) brings bytes of it; size is all of it."""

    def __init__(self, read, size: int):
        self.read, self.unzip = read, zstandard.ZstdDecompressor()
        magic, self.width, self.sequence, at, length, self.bloom, self.bits, self.docs, self.total, _ = FOOTER.unpack(read(size - FOOTER.size - 1, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard, or cut short")
        index, self.flags = self.unzip.decompress(read(at, length)), None
        self.firsts, self.blocks, at = [], [], 0
        while at < len(index):
            n, at = _read_varint(index, at)
            self.firsts.append(index[at : at + n])
            self.blocks.append(struct.unpack_from("<QIIIQ", index, at + n))
            at += n + 28

    @classmethod
    def of(cls, data: bytes) -> Shard:
        return cls(lambda at, size: data[at : at + size], len(data))

    def entries(self, block: int) -> Iterator[tuple[bytes, bytes]]:
        at, size, crc, n, _ = self.blocks[block]
        row = self.read(at, size)
        if zlib.crc32(row) != crc:
            raise ValueError(f"block {block} is damaged")
        data, at, key = self.unzip.decompress(row), 0, b""
        for _ in range(n):
            shared, at = _read_varint(data, at)
            rest, at = _read_varint(data, at)
            size, at = _read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            yield key, data[at + rest : at + rest + size]
            at += rest + size

    def scan(self) -> Iterator[tuple[bytes, bytes]]:
        for k in range(len(self.blocks)):
            yield from self.entries(k)

    def may_have(self, key: bytes) -> bool:
        if self.flags is None:
            self.flags = self.read(self.bloom, -(-self.bits // 8))
        spots = _probes(np.array([xxhash.xxh64_intdigest(key)], np.uint64), self.bits)[0]
        return all(self.flags[int(p) >> 3] >> (int(p) & 7) & 1 for p in spots)

    def get(self, value) -> list[np.ndarray]:
        """Token ids of every document with this id; none if there is none."""
        key, found = key_of(value), []
        if self.may_have(key):
            for k in range(max(0, bisect_left(self.firsts, key) - 1), len(self.blocks)):
                if self.firsts[k] > key:
                    break
                found += [np.frombuffer(ids, f"<u{self.width}") for own, ids in self.entries(k) if own == key]
        return found


#: Characters whose class (letter, number, blank, other) is one and the same for every library.
LETTER, NUMBER, BLANK = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", " \\t-\\r\xa0"
PLAIN = re.compile("[\x01-\x1b\x20-\x84\x86-\u024f\u2010-\u2027]*")
#: The tokenizer's pattern, a fixed value, over those characters.
PIECE = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")


class Encoder:
    """byte_bpe_50k: token ids as little-endian bytes, those of tokenizers' encode(text, add_special_tokens=False).

    The tokenizer splits a text into pieces by a pattern and encodes each for itself, so the ids of pieces can be kept.
    New pieces are encoded together, parted by line feeds, which are pieces of their own. Texts with characters outside
    PLAIN or the special token's string are encoded whole, as are all texts if the file at path describes another
    splitting. Once kept pieces take `most` bytes, they become the old ones: those that come again are kept anew, the
    rest go when the next `most` are full.
    """

    most = 80 << 20
    #: Bytes that Python takes for a piece and its ids besides their characters.
    EACH = 250

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # no piece is asked for twice
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        how = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        self.splits = how.get("type") == "ByteLevel" and how.get("use_regex", True) and not how.get("add_prefix_space", True) and self.tokenizer.normalizer is None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.feed = self._ids("\n")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _bytes(self, ids: Iterable[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    def _learn(self, new: set[str]) -> None:
        lone = [p for p in new if p.isspace()]
        more = list(new.difference(lone))
        ids = np.array(self._ids("\n".join(more)), f"<u{self.width}") if more else np.zeros(0)
        cuts = np.flatnonzero(ids == self.feed[0]) if len(self.feed) == 1 else []
        if more and len(cuts) == len(more) - 1:
            raw, at = ids.tobytes(), 0
            for p, cut in zip(more, [*(cuts * self.width).tolist(), len(raw)], strict=True):
                self.kept[p] = raw[at:cut]
                at = cut + self.width
        else:
            lone = list(new)
        for p in lone:
            self.kept[p] = self._bytes(self._ids(p))

    def encode(self, text: str) -> bytes:
        if not self.splits or not PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self._bytes(self._ids(text))
        pieces = PIECE.findall(text)
        if new := set(pieces).difference(self.kept):
            more = self.EACH * len(new) + 3 * sum(map(len, new))
            if self.held + more > self.most and self.kept:
                self.old, self.kept, self.held, new = self.kept, {}, 0, set(pieces)
                more = self.EACH * len(new) + 3 * sum(map(len, new))
            self.held += more
            back = {p: self.old[p] for p in new if p in self.old}
            self.kept |= back
            if new := new.difference(back):
                self._learn(new)
        return b"".join(map(self.kept.__getitem__, pieces))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker, so that later tasks find the pieces that earlier ones learned."""
    return Encoder(path)


def write_shards(df: DataFrame, path: str, tokenizer: str, ident: str = "doc_id", text: str = "text", end: int | None = 2, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode df's whole texts and write them to path in ascending order of ident, null first.

    A null text is empty; end, if any, closes every document. Rows with equal ids are all kept, ordered by a hash of
    their text. Other columns are left out.
    """
    ready(df.sparkSession)
    rows = df.select(F.col(f"`{ident}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    rows = rows.repartitionByRange(max(1, -(-size // shard_bytes)), *order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer)
        tail = b"" if end is None else ids_of._bytes([end])
        writer, out, held = ShardWriter(TaskContext.get().partitionId(), ids_of.width), [], 0
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["row"])
        for batch in batches:
            for ident, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                for row in writer.add(key_of(ident), ids_of.encode(text.as_py()) + tail):
                    out.append(row)
                    held += len(row)
                if held > 4 << 20:
                    yield pack(out)
                    out, held = [], 0
        if writer.hashes:
            yield pack([*out, *writer.finish()])

    shards = rows.mapInArrow(lean(run), "row binary")
    shards.select(F.col("row").cast("string").alias("value")).write.option("compression", "none").text(path)


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0").select("content")


def read_shards(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """(sequence, place, id, ids): every document of the shards at path, its token ids as an array of int."""
    return _scan(spark, path, f"sequence long, place long, id {kind}, ids array<int>", lambda ids, width: np.frombuffer(ids, f"<u{width}").astype(np.int32), pa.list_(pa.int32()))


def digests(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """(id, start, n_tokens, ids_crc32, looked_up) of every document: start counts the ids of all documents before it.

    looked_up: for integer ids divisible by 50, whether filter, index and block give the document its ids too; else null.
    """
    crc = lambda ids, width: zlib.crc32(np.frombuffer(ids, f"<u{width}").astype("<u4"))
    rows, _ = stored(_scan(spark, path, f"sequence long, place long, id {kind}, ids_crc32 long, local long, n_tokens long, looked_up boolean", crc, pa.int64()), "digests")
    sums = rows.groupBy("sequence").agg(F.sum("n_tokens").alias("n"))  # a row a shard
    before = Window.orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    bases, _ = stored(sums.select("sequence", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    return rows.join(bases, "sequence").select("id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "looked_up")


def _probed(shard: Shard, key: bytes, ids: bytes) -> bool | None:
    if key[:1] != b"\x01" or value_of(key) % 50:
        return None
    return any(x.tobytes() == ids for x in shard.get(value_of(key)))


def _scan(spark: SparkSession, path: str, schema: str, value, kind: pa.DataType) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    ident = pa.string() if " id string" in schema else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                shard, place, local = Shard.of(data.as_py()), 0, 0
                for k in range(len(shard.blocks)):
                    rows = list(shard.entries(k))
                    sizes = np.array([len(ids) // shard.width for _, ids in rows], np.int64)
                    starts = local + np.cumsum(sizes) - sizes
                    columns = [
                        pa.array(np.full(len(rows), shard.sequence)), pa.array(np.arange(place, place + len(rows))),
                        pa.array([value_of(key) for key, _ in rows], ident), pa.array([value(ids, shard.width) for _, ids in rows], kind),
                        pa.array(starts), pa.array(sizes),
                    ]
                    if "looked_up" in names:
                        columns.append(pa.array([_probed(shard, *row) for row in rows], pa.bool_()))
                    yield pa.RecordBatch.from_arrays(columns[: len(names)], names)
                    place, local = place + len(rows), local + int(sizes.sum())

    return shard_files(spark, path).mapInArrow(run, schema)


class Reader:
    """Point lookups from the driver in the shards at path, on any Hadoop file system, by reads of byte ranges."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        self.fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.utils, self.gateway = jvm.org.apache.commons.io.IOUtils, spark.sparkContext._gateway
        found = [f for f in self.fs.listStatus(folder) if f.getPath().getName().startswith("part-") and f.getLen()]
        self.files = sorted(((f.getPath(), f.getLen()) for f in found), key=lambda f: f[0].getName())  # in the order of their keys
        self.shards: dict[int, Shard] = {}

    def _read(self, k: int):
        def read(at: int, size: int) -> bytes:
            stream = self.fs.open(self.files[k][0])
            try:
                stream.seek(at)
                return bytes(self.utils.toByteArray(stream, size))
            finally:
                stream.close()

        return read

    def shard(self, k: int) -> Shard:
        """Shard number k with its index; its blocks stay where they are."""
        if k not in self.shards:
            if len(self.shards) > 1000:
                self.shards.clear()
            self.shards[k] = Shard(self._read(k), self.files[k][1])
        return self.shards[k]

    def candidates(self, value) -> list[int]:
        """Numbers of the shards whose range of keys has the value's."""
        key, lo, hi = key_of(value), 0, len(self.files)
        while lo < hi:  # the first shard that begins at the key or behind it
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if self.shard(mid).firsts[0] < key else (lo, mid)
        out = [lo - 1] if lo else []
        while lo < len(self.files) and self.shard(lo).firsts[0] == key:
            out.append(lo)
            lo += 1
        return out

    def get(self, value) -> list[np.ndarray]:
        """Token ids of every document with this id; none if there is none."""
        return [ids for k in self.candidates(value) for ids in self.shard(k).get(value)]


def lookup(spark: SparkSession, path: str, values: list, kind: str = "long") -> DataFrame:
    """(id, ids) of the documents with these ids, a list that fits a task; only shards that may have one are opened."""
    ready(spark)
    reader = Reader(spark, path)
    files = sorted({reader.files[k][0].toString() for v in values for k in reader.candidates(v)})
    if not files:
        return spark.createDataFrame([], f"id {kind}, ids array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                shard = Shard.of(data.as_py())
                found = [(v, ids.astype(np.int32)) for v in values for ids in shard.get(v)]
                if found:
                    ident = pa.string() if kind == "string" else pa.int64()
                    yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in found], ident), pa.array([x for _, x in found], pa.list_(pa.int32()))], ["id", "ids"])

    return spark.read.format("binaryFile").load(files).select("content").mapInArrow(run, f"id {kind}, ids array<int>")
