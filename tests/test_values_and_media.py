import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framelake.functions import clock, media, names, values


def one(spark, column, **data):
    row = spark.createDataFrame([tuple(v for v, _ in data.values())], ", ".join(f"{k} {t}" for k, (_, t) in data.items()))
    return row.select(column.alias("x")).head()["x"]


def test_intervals():
    assert clock.interval_ns(30) == 33_333_333 and clock.interval_ns(1) == 10**9
    with pytest.raises(ValueError):
        clock.interval_ns(0)


def test_buckets(spark):
    i = 33_333_333
    ns = [0, 1, i - 1, i, i + 1, i + i // 2, i + (i + 1) // 2, 2 * i, 10**18 + 7, clock.LAST, -1]
    df = spark.createDataFrame([(n,) for n in ns], "n long").select("n", clock.floor_bucket(F.col("n"), i).alias("f"), clock.round_bucket(F.col("n"), i).alias("r"))
    for n, f, r in df.collect():
        assert f == n // i * i and r == min(n + (i + 1) // 2, clock.LAST) // i * i


def test_vectors(spark):
    data = spark.createDataFrame([([1.0, 2.0, 3.0, None], ["float32", "int8", "uint64", "float64"]), ([1.0], ["uint16"]), ([], [])], "x array<double>, t array<string>")
    assert [r[0] for r in data.select(values.vector_of(F.col("x"), F.col("t"))).collect()] == [[1.0, 3.0], None, None]
    fields = spark.createDataFrame([({"b": [2.0], "a": [1.0, 9.0]},), ({},)], "m map<string,array<double>>")
    assert [r[0] for r in fields.select(values.flat_fields(F.col("m"))).collect()] == [[1.0, 9.0, 2.0], None]
    for n, want in ((0.0, 0), (4294967295.0, 4294967295), (4294967296.0, None), (-1.0, None), (1.5, None)):
        assert one(spark, values.u32(F.col("n")), n=(n, "double")) == want


def test_roles(spark):
    rows = [("action", None, True, False), ("a.action.b", None, True, False), ("action.x", None, False, True), ("state", "action", True, False)]
    df = spark.createDataFrame([(f, d) for f, d, _, _ in rows], "f string, d string")
    got = df.select(values.role(F.col("f"), F.col("d")) == "action", values.is_action_prefix(F.col("f"))).collect()
    assert [tuple(g) for g in got] == [(a, b) for _, _, a, b in rows]


def test_image_kinds(spark):
    rows = [("jpeg", None, None, 10, "encoded"), (None, 2, 2, 12, "rgb"), (None, 2, 2, 11, "encoded"), (None, 2, 2, 13, None), (None, None, None, 5, None)]
    df = spark.createDataFrame([r[:4] for r in rows], "f string, w int, h int, n int")
    got = df.select(values.image_kind(F.col("f"), F.col("w"), F.col("h"), F.col("n"))).collect()
    assert [g[0] for g in got] == [r[4] for r in rows]
    assert bytes(one(spark, values.bytes_of(F.col("x")), x=([1, 255, 256, -1, 16], "array<int>"))) == b"\x01\xff\x10"


def jpeg(w, h, marker=0xC0, before=b"\xff\xe0\x00\x04xx"):
    return b"\xff\xd8" + before + bytes([0xFF, marker, 0, 17, 8]) + h.to_bytes(2) + w.to_bytes(2) + bytes(10)


def test_jpeg_sizes(spark):
    rows = [jpeg(640, 480), jpeg(10, 20, 0xC2), jpeg(10, 20, 0xC4), b"\xff\xd8\xff\xd9", b"", None, jpeg(0, 5), jpeg(7, 9, before=b"\xff\xff\xff\xe1\x00\x02")]
    df = spark.createDataFrame([(k, None if x is None else bytearray(x)) for k, x in enumerate(rows)], "k int, d binary")
    got = [tuple(r["s"]) for r in df.select("k", media.jpeg_size("d").alias("s")).orderBy("k").collect()]
    assert got == [(640, 480), (10, 20), *[(None, None)] * 5, (7, 9)]


def test_colour_conversion(spark):
    r = np.random.default_rng(1)
    rgb = r.integers(0, 256, (4, 6, 3), dtype=np.uint8)
    df = spark.createDataFrame([(bytearray(rgb.tobytes()), 6, 4), (bytearray(b"123"), 1, 1), (None, 2, 2)], "d binary, w int, h int")
    yuv, nv = (list(x) for x in zip(*df.select(media.rgb_to_yuv420p("d", "w", "h"), media.rgb_to_nv12("d", "w", "h")).collect(), strict=True))
    assert yuv[1:] == [None, None] and len(yuv[0]) == 36
    x = rgb.astype(int)
    assert list(yuv[0][:24]) == ((77 * x[..., 0] + 150 * x[..., 1] + 29 * x[..., 2]) >> 8).ravel().tolist()
    assert bytes(nv[0][:24]) == bytes(yuv[0][:24]) and bytes(nv[0][24::2]) == bytes(yuv[0][24:30]) and bytes(nv[0][25::2]) == bytes(yuv[0][30:])
    grey = spark.createDataFrame([(bytearray(b"\x05\x07"), "l8"), (bytearray(b"\x00\x05"), "l16"), (bytearray(b"abcd"), "rgba8"), (bytearray(b"a"), "rgb8"), (bytearray(b"a"), "x")], "d binary, c string")
    assert [None if g[0] is None else bytes(g[0]) for g in grey.select(media.to_rgb8("d", "c")).collect()] == [b"\x05" * 3 + b"\x07" * 3, b"\x05" * 3, b"abc", None, None]


def test_formats_by_name(spark):
    df = spark.createDataFrame([("RGB8",), ("bgra8",), ("JFIF",), ("h264",), ("zzz",), (None,)], "n string")
    assert [r[0] for r in df.select(media.detect_format(F.lit(None).cast("binary"), F.col("n"))).collect()] == ["rgb8", "bgr8", "jpeg", "jpeg", "unknown", "unknown"]


@given(st.text(alphabet="/a.b_", max_size=12))
@settings(max_examples=25, deadline=None)
def test_feature_names(spark, topic):
    assert one(spark, names.feature_of(F.col("t")), t=(topic, "string")) == topic.replace("/", ".").lstrip(".")


def test_paths_and_urls(spark):
    df = spark.createDataFrame([(1234,)], "e long")
    got = df.select(names.parquet_path(F.col("e")), names.video_path(F.col("e"), F.lit("cam")), names.rlds_video_path(F.col("e"), F.lit("c")), names.flat_video_path(F.col("e"), F.lit("c"))).head()
    assert tuple(got) == ("data/chunk-002/episode_001234.parquet", "videos/chunk-002/cam/episode_001234.mp4", "episode_001234/c.mp4", "episode_001234_c.mp4")
    assert [one(spark, names.episode_in(F.col("p")), p=(p, "string")) for p in (got[0], got[1], got[2], "x.parquet")] == [1234, 1234, 1234, 0]
    assert names.parse_url("s3://b/k/x?endpoint=h&region=r") == {"scheme": "s3", "bucket": "b", "key": "k/x", "options": {"endpoint": "h", "region": "r"}}
    assert names.parse_url("/x/y")["key"] == "/x/y" and names.parse_url("file:///x")["key"] == "/x"
    for bad in ("s3:/b/k", "s3:///k"):
        with pytest.raises(ValueError):
            names.parse_url(bad)
    assert [one(spark, names.type_style(F.col("t")), t=(t, "string")) for t in ("a/msg/B", "a/B", "a.b.C", "x y")] == ["ros2", "ros1", "proto", None]
    assert one(spark, names.batch_id_ok(F.col("b")), b=("ns:" + "a" * 1030, "string")) is False


def test_pictures_of_one_size_are_converted_together(monkeypatch):
    import numpy as np
    import pandas as pd

    from framelake.functions import media

    r, calls = np.random.default_rng(3), []
    sizes = [[(2, 2), (4, 2), (2, 6), (3, 2), (0, 0)][int(k)] for k in r.integers(0, 5, 300)]
    data = [None if k % 17 == 0 else r.bytes(w * h * 3 - (k % 13 == 0 and w > 0)) for k, (w, h) in enumerate(sizes)]
    args = pd.Series(data), pd.Series([w if k % 19 else None for k, (w, _) in enumerate(sizes)]), pd.Series([h for _, h in sizes])
    own = media._planes
    monkeypatch.setattr(media, "_planes", lambda rgb: calls.append(1) or own(rgb))
    planar, mixed = media.rgb_to_yuv420p.func(*args), media.rgb_to_nv12.func(*args)
    assert len(calls) == 6  # once a size and layout, not once a picture
    for k, (w, h) in enumerate(sizes):
        if data[k] is None or k % 19 == 0 or w % 2 or not w or len(data[k]) != w * h * 3:
            assert planar[k] is None and mixed[k] is None
            continue
        x = np.frombuffer(data[k], np.uint8).reshape(h, w, 3).astype(int)
        y = (x @ [77, 150, 29]) >> 8
        u, v = ((((x @ c) >> 8) + 128).reshape(h // 2, 2, w // 2, 2).sum(axis=(1, 3)) // 4 for c in ([-43, -85, 128], [128, -107, -21]))
        u, v = (np.clip(p, 0, 255).astype(np.uint8) for p in (u, v))
        assert planar[k] == y.astype(np.uint8).tobytes() + u.tobytes() + v.tobytes()
        assert mixed[k] == y.astype(np.uint8).tobytes() + np.stack([u, v], axis=-1).tobytes()
    assert len(media.rgb_to_nv12.func(*(s[:0] for s in args))) == 0
