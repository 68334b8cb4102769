"""WARC archives: written by tasks, read back by boundary-chain verification.

Writing. A row becomes one record: a response that holds the payload behind an HTTP head, or, where an equal payload has
been stored, a revisit that names the response's record and holds the head alone. Payloads are equal if SHA-1, length
and another hash are. Spark's own text writer stores the records, so any Hadoop file system will do, tasks commit or
leave nothing, and a lost executor's archive is written anew.

Reading. Spark's text reader cuts archives of any size at their magic, whatever its splits are, so each piece is a
candidate for a record; a payload that holds the magic gives false ones. Tasks read each candidate's Content-Length and
emit where its record would end, the successor. A file's records are the candidates on the chain of successors from its
start, and nothing else:

1. the candidates of a split are chained by pointer jumping in memory: each learns where its chain leaves the split;
2. over splits, candidates that some chain leads to are joined with their successors' successors, round by round, and
   those reached from the file's start grow to twice as many splits a round;
3. each split marks its records from the one candidate by which the chain comes in.

Only narrow rows take part in this. Pieces of a payload that was cut are put together again behind their record's first
one. Where a chain ends before its file does, the file is damaged there, or cut off.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from framelake.llm.common import HOT_KEYS, LEAST_HOT, checked_broadcast, group_bounds, key_runs, ready, stored

#: Fixed values of the format: what a record begins with, and how a revisit of an equal payload is marked.
MAGIC = b"WARC/1."
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records end with this; the text writer adds the last byte.
END = b"\r\n\r\n"
NAME = "urn:page:"
FLUSH = 4 << 20


def digest_of(sha1: bytes) -> str:
    """A SHA-1 in upper-case base 32."""
    return base64.b32encode(sha1).decode()


def _clean(value: str) -> str:
    """No blanks or control characters, so that a header stays one line."""
    return "".join(quote(c) if ord(c) <= 32 or ord(c) == 127 else c for c in value)


def record(kind: str, ident, url: str | None, payload: bytes, sha1: bytes, refers, date: str) -> bytes:
    """A record without its last byte. A null id has an empty name; a null url is left out."""
    name = lambda i: f"<{NAME}{'' if i is None else quote(str(i), safe='')}>"
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head + (payload if kind == "response" else b"")
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: {name(ident)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest_of(sha1)}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(refers)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"\r\n".join([VERSION, *(x.encode() for x in lines), b"", block, b"\r"])


def write_archives(df: DataFrame, path: str, ident: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record for each row of df to archives below path, an archive a partition.

    A string payload is taken as UTF-8, a null one as empty. Of rows with equal payloads of at least `least` bytes, the
    one with the largest id is a response and the others revisit it; rows that repeat that id are responses too. A null
    id is less than any other. Rows whose payload is shorter are all responses. Other columns are left out, whatever they
    are called. An empty table writes no record.
    """
    spark = df.sparkSession
    ready(spark)
    rows = df.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload"), "more": F.xxhash64("payload")})
    key = ["sha1", "size", "more"]
    groups = rows.where(F.col("size") >= least).groupBy(*key).agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1")
    groups, _ = stored(groups, "payloads")
    found = groups.agg(F.count("*"), F.sum("n"), F.max("n")).head()
    # payloads with many copies are sent to every task; the others meet in a join that the size of their table decides on
    limit = max(LEAST_HOT, -(-(found[1] or 0) // HOT_KEYS))
    hot, cold = (groups.where(c).select(*key, F.struct("keep").alias(a)) for c, a in ((F.col("n") > limit, "hot"), (F.col("n") <= limit, "cold")))
    out = rows.join(F.broadcast(hot), key, "left")
    spread = F.when(F.col("hot").isNull(), F.col("sha1")).otherwise(F.xxhash64("id", "url").cast("string"))  # met already
    out = out.withColumn("at", spread).join(checked_broadcast(cold.withColumnRenamed("sha1", "at"), found[0]), ["at", "size", "more"], "left")
    repeat = F.coalesce("hot", "cold")
    out = out.withColumn("revisit", repeat.isNotNull() & ~repeat["keep"].eqNullSafe(F.col("id"))).select("id", "url", "payload", "sha1", "revisit", repeat["keep"].alias("keep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("id", "url", "payload", "sha1", "revisit", "keep")]
            for row in zip(*columns, strict=True):
                i, u, p, s, again, keep = (v.as_py() for v in row)
                made.append(record("revisit" if again else "response", i, u, p, bytes.fromhex(s), keep, date))
                held += len(made[-1])
                if held > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["row"])
                    made, held = [], 0
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["row"])

    records = out.mapInArrow(run, "row binary")
    records.select(F.col("row").cast("string").alias("value")).write.option("compression", "none").text(path)


def _head(raw: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Length of a record's head and its fields, lower-case; none if raw doesn't begin with a whole head."""
    end = raw.find(END)
    if end < 0 or raw[:7] != MAGIC or raw[8:10] != b"\r\n":
        return None
    fields = (line.partition(b":") for line in raw[10:end].split(b"\r\n"))
    return end + 4, {k.strip().lower(): v.strip() for k, _, v in fields}


def _length(raw: bytes) -> int | None:
    """Bytes from a candidate's start to its successor's; none if it isn't a record's start."""
    head = _head(raw)
    size = head[1].get(b"content-length", b"") if head else b""
    return head[0] + int(size) + 4 if size.isdigit() and len(size) < 19 else None


PIECES = "file string, split long, size long, place int, at long, len long, jump long, raw binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text between magics, in the order of each split -> pieces with their magic, and where a record that began there would end."""
    key, place, at = None, 0, 0
    for batch in batches:
        out, held = [], 0
        values, *keys = (batch.column(c) for c in ("value", "file", "split", "size"))
        for value, file, split, size in zip(values, *keys, strict=True):
            now = (file.as_py(), split.as_py(), size.as_py())
            if now != key:
                key, place, at = now, 0, 0
            # a separator ends one piece with its line feed and begins the next with its magic
            raw = (b"" if now[1] == 0 and place == 0 else MAGIC) + value.as_py() + b"\n"
            out.append((*now, place, at, len(raw), _length(raw), raw))
            place, at, held = place + 1, at + len(raw), held + len(raw)
            if held > FLUSH:
                yield _batch(out, PIECES)
                out, held = [], 0
        if out:
            yield _batch(out, PIECES)


TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, TYPES[t]) for v, (_, t) in zip(zip(*rows, strict=True), names, strict=True)], [n for n, _ in names])


def jumped(to: np.ndarray) -> np.ndarray:
    """Where each chain ends: to[k] is k's successor, or k itself."""
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


def marked(to: np.ndarray, start: int) -> np.ndarray:
    """Whether a place is on the chain from start; the part of it that is known doubles each round."""
    on = np.zeros(len(to), bool)
    on[start] = True
    while True:
        before = int(on.sum())
        on[to[on]] = True
        if int(on.sum()) == before:
            return on
        to = to[to]


def _successors(off: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Place of each candidate's successor among sorted offsets; its own where that isn't one of them."""
    at = np.minimum(np.searchsorted(off, following), len(off) - 1)
    return np.where(off[at] == following, at, np.arange(len(off)))


KEYS = ["file", "split"]


def _exits(piece: pa.Table) -> Iterator[pa.RecordBatch]:
    for s, e in zip(*group_bounds(piece, KEYS), strict=True):
        own = piece.slice(s, e - s)
        off, following = own.column("off").to_numpy(), own.column("following").to_numpy()
        last = jumped(_successors(off, following))
        yield pa.RecordBatch.from_arrays([own.column("file").combine_chunks(), own.column("split").combine_chunks(), pa.array(off), pa.array(following[last])], ["file", "split", "off", "leave"])


def _marks(piece: pa.Table) -> Iterator[pa.RecordBatch]:
    """Candidates of a split, the entry flagged -> whether each is a record's start; the last start at or before it, and its end."""
    for s, e in zip(*group_bounds(piece, KEYS), strict=True):
        own = piece.slice(s, e - s)
        off, following = own.column("off").to_numpy(), own.column("following").to_numpy()
        entry, on = np.flatnonzero(own.column("entry").to_numpy()), np.zeros(len(off), bool)
        if len(entry):
            on = marked(_successors(off, following), int(entry[0])) & (following >= 0)
        last = np.maximum.accumulate(np.where(on, np.arange(len(off)), -1))
        owner, until = (np.where(last >= 0, x[last], -1) for x in (off, following))
        yield pa.RecordBatch.from_arrays(
            [own.column(c).combine_chunks() for c in ("file", "split", "place")] + [pa.array(x) for x in (off, following, on, owner, until)],
            ["file", "split", "place", "off", "following", "start", "owner", "until"],
        )


def entries(exits: DataFrame, most: int) -> DataFrame:
    """(file, off): candidates of exits(file, off, leave) by which the chain from each file's start enters a split.

    Pointer jumping: in round k, `reached` holds the first 2^k splits' entries, and `ahead` leads each 2^k splits on.
    most: splits that a file has at most.
    """
    led = exits.select("file", F.col("leave").alias("off")).distinct()
    ahead, _ = stored(exits.join(led, ["file", "off"], "left_semi").unionByName(exits.where("off = 0")).distinct(), "ahead")
    reached = exits.where("off = 0").select("file", "off")
    for _ in range(max(0, most - 1).bit_length()):
        further = reached.join(ahead, ["file", "off"]).select("file", F.col("leave").alias("off"))
        known = ahead.select("file", "off")
        reached, _ = stored(reached.unionByName(further.join(known, ["file", "off"], "left_semi")).distinct(), "reached")
        then = ahead.select("file", F.col("off").alias("leave"), F.col("leave").alias("next"))
        ahead, _ = stored(ahead.join(then, ["file", "leave"], "left").select("file", "off", F.coalesce("next", "leave").alias("leave")), "ahead")
    return reached


class Archives:
    """Archives below a path: their candidates, and those that chains from the files' starts reach."""

    def __init__(self, spark: SparkSession, path: str, glob: str = "*"):
        ready(spark)
        text = spark.read.option("lineSep", "\nWARC/1.").option("pathGlobFilter", glob).text(path)
        meta = [F.col(f"_metadata.{c}").alias(a) for c, a in (("file_path", "file"), ("file_block_start", "split"), ("file_size", "size"))]
        # stored, so that places stay as they are: splits may be cut otherwise by a later scan
        self.pieces, _ = stored(text.select(F.col("value").cast("binary").alias("value"), *meta).mapInArrow(_pieces, PIECES), "pieces", "zstd")
        sums = self.pieces.groupBy("file", "split").agg(F.sum("len").alias("len"), F.max("size").alias("size"))
        before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
        self.splits, _ = stored(sums.select("file", "split", "size", F.coalesce(F.sum("len").over(before), F.lit(0)).alias("base")), "splits")
        self.n_splits = self.splits.count()
        most = self.splits.groupBy("file").count().agg(F.max("count")).head()[0] or 0
        narrow = self.pieces.select("file", "split", "place", "at", "jump").join(checked_broadcast(self.splits, self.n_splits), KEYS)
        off = F.col("base") + F.col("at")
        end = off + F.col("jump")  # what isn't a record's start, or would end behind its file, leads nowhere: to -1
        all_ = narrow.select("file", "split", "place", off.alias("off"), F.when(end <= F.col("size"), end).otherwise(F.lit(-1)).alias("following"))
        self.all, _ = stored(all_, "candidates")
        real = self.all.where("following >= 0")
        exits = real.repartition(*KEYS).sortWithinPartitions(*KEYS, "off").mapInArrow(lambda b: key_runs(b, KEYS, _exits), "file string, split long, off long, leave long")
        reached = entries(stored(exits.drop("split"), "exits")[0], most)
        flagged = self.all.join(reached.withColumn("entry", F.lit(True)), ["file", "off"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
        marks = flagged.select("file", "split", "place", "off", "following", "entry").repartition(*KEYS).sortWithinPartitions(*KEYS, "off")
        marks = marks.mapInArrow(lambda b: key_runs(b, KEYS, _marks), "file string, split long, place int, off long, following long, start boolean, owner long, until long")
        marks, _ = stored(marks, "marks")
        # pieces before a split's first record belong to the last record of an earlier split
        lasts = marks.groupBy(*KEYS).agg(F.max(F.struct("owner", "until")).alias("last"))
        lasts, _ = stored(lasts.select(*KEYS, F.max("last").over(before).alias("earlier")), "lasts")
        own = [F.when(F.col("owner") >= 0, F.col(c)).otherwise(F.coalesce(F.col(f"earlier.{c}"), F.lit(-1))).alias(c) for c in ("owner", "until")]
        self.marks = marks.join(checked_broadcast(lasts, self.n_splits), KEYS).select(*KEYS, "place", "off", "following", "start", *own)

    def records(self) -> DataFrame:
        """(file, offset, type, record_id, refers_to, url, date, digest, size, payload, verified): every record of the archives.

        record_id and refers_to are names without their urn, null if empty; size and digest are those of the whole
        payload, for a revisit as its head states them, and its payload is null; verified: a response's payload has the
        digest that its head states. Cut-off records are left out; see `damage`.
        """
        owner = F.when(F.col("off") < F.col("until"), F.col("owner")).otherwise(F.lit(-1))  # behind a chain's end, nobody's
        rest = self.marks.where("NOT start").select("file", "split", "place", owner.alias("owner"))
        rest, _ = stored(rest, "rest")
        owners = rest.where("owner >= 0").select("file", F.col("owner").alias("off")).distinct()
        cut = self.marks.where("start").join(owners, ["file", "off"], "left_semi").select("file", "split", "place", F.col("off").alias("owner"))
        odd, _ = stored(rest.unionByName(cut), "odd")
        odd = checked_broadcast(odd, odd.count())  # false candidates and records that hold some
        at = ["file", "split", "place"]
        pieces = self.pieces.join(checked_broadcast(self.splits.drop("size"), self.n_splits), KEYS)
        pieces = pieces.select(*at, (F.col("base") + F.col("at")).alias("off"), "size", "raw")
        whole = pieces.join(odd, at, "left_anti").select("file", "off", "size", "raw")
        parts = pieces.join(odd.where("owner >= 0"), at).groupBy("file", F.col("owner").alias("off")).agg(F.max("size").alias("size"), F.array_sort(F.collect_list(F.struct(F.col("off").alias("o"), "raw"))).alias("p"))
        raw = F.array_join(F.transform("p", lambda x: x["raw"].cast("string")), "").cast("binary")  # bytes as they are
        joined = parts.select("file", "off", "size", raw.alias("raw"))
        return whole.unionByName(joined).mapInArrow(_records, RECORDS)

    def damage(self) -> DataFrame:
        """(file, offset): where a file's chain of records ends before the file does."""
        ends = self.marks.where("start").groupBy("file").agg(F.max("following").alias("offset"))
        sizes = self.splits.groupBy("file").agg(F.max("size").alias("size"))
        ends = sizes.join(ends, "file", "left").select("file", "size", F.coalesce("offset", F.lit(0)).alias("offset"))
        return ends.where("offset <> size").select("file", "offset")


RECORDS = "file string, offset long, type string, record_id string, refers_to string, url string, date string, digest string, size long, payload binary, verified boolean"


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, held = [], 0
        for row in zip(*(batch.column(c) for c in ("file", "off", "size", "raw")), strict=True):
            file, off, size, raw = (v.as_py() for v in row)
            head = _head(raw)
            if head is None or off + (_length(raw) or size + 1) > size:
                continue
            out.append((file, off, *_parsed(raw, *head)))
            held += len(raw)
            if held > FLUSH:
                yield _batch(out, RECORDS)
                out, held = [], 0
        if out:
            yield _batch(out, RECORDS)


def _parsed(raw: bytes, at: int, fields: dict[bytes, bytes]) -> tuple:
    text = lambda k: fields[k].decode("utf-8", "replace") if k in fields else None
    kind, block = text(b"warc-type"), raw[at : at + int(fields[b"content-length"])]
    payload, size = block, len(block)
    if (fields.get(b"content-type") or b"").startswith(b"application/http"):
        head, _, payload = block.partition(END)
        stated = [v for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")) if k.strip().lower() == b"content-length"]
        size = int(stated[0]) if stated and kind == "revisit" else len(payload)
    own, stated = digest_of(hashlib.sha1(payload).digest()), (text(b"warc-payload-digest") or "").removeprefix("sha1:") or None
    if kind == "revisit":
        return kind, _name(text(b"warc-record-id")), _name(text(b"warc-refers-to")), text(b"warc-target-uri"), text(b"warc-date"), stated, size, None, None
    return kind, _name(text(b"warc-record-id")), _name(text(b"warc-refers-to")), text(b"warc-target-uri"), text(b"warc-date"), own, size, payload, None if stated is None else own == stated


def _name(value: str | None) -> str | None:
    """What a record's URN names, as it was before it was quoted."""
    return unquote((value or "").strip("<>").removeprefix(NAME)) or None
