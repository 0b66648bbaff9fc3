"""Pixel kernels, image sources and the whole composition on small synthetic frames."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions import pixels as X
from framewright.params import Params
from framewright.plans import pipeline
from framewright.sources import media, sinks
from framewright.streaming import streams

RNG = np.random.default_rng(5)
SMALL = Params(min_content_dimension=4, match_width=12, match_height=8, variance_threshold=50.0, low_info_filter=True, attempt_content_fix=False)


def picture(h=16, w=24, seed=0):
    g = np.random.default_rng(seed)
    return np.kron(g.integers(30, 255, (h // 4, w // 4, 3)), np.ones((4, 4, 1), int)).astype(np.uint8)


def test_gray_and_resize():
    assert X.gray(np.full((2, 2, 3), 200, np.uint8)).tolist() == [[200, 200], [200, 200]]
    g = RNG.integers(0, 255, (8, 8)).astype(np.uint8)
    assert (X.resize_area(g, 8, 8) == g).all()
    assert X.resize_area(np.arange(16, dtype=np.uint8).reshape(4, 4), 2, 2).tolist() == [[2, 4], [10, 12]]  # 2.5, 4.5, 10.5, 12.5 to even


def test_crop_is_idempotent_and_finds_the_box():
    p = Params(min_content_dimension=4)
    content = picture()
    framed = np.pad(content, ((3, 5), (2, 1), (0, 0)))
    assert X.box_of(X.mask_of(X.gray(framed), p)) == (2, 3, 26, 19)
    out = X.auto_crop(framed, p)
    assert (out == content).all() and X.auto_crop(out, p) is out
    assert X.auto_crop(framed) is framed  # below the least content size
    assert X.box_of(np.zeros((3, 3), bool)) is None


def test_white_modes():
    g = np.full((8, 8), 100, np.uint8)
    g[2:6] = 250
    box = lambda mode: X.box_of(X.mask_of(g, Params(crop_black=False, crop_white=True, white_mode=mode)))
    assert box("reference") == (0, 2, 8, 6) and box("intended") == (0, 0, 8, 8)


def test_template_finds_the_place():
    big = RNG.integers(0, 255, (40, 60)).astype(np.uint8)
    score, box = X.template(big[7:27, 11:41], big)
    assert score > 0.999999 and box == (11, 7, 30, 20)
    assert X.template(big, big[:10, :10]) == (0.0, None)
    assert X.template(np.full((4, 4), 9, np.uint8), big)[0] == 1.0
    brute = max(X.ncc(big[7:17, 11:21], big[y : y + 10, x : x + 10]) for y in range(31) for x in range(51))
    assert abs(X.template(big[7:17, 11:21], big)[0] - brute) < 1e-6
    assert X.template(big[:8, :8], np.zeros((20, 20), np.uint8))[0] == 0.0


def test_ncc_ignores_gain():
    a = RNG.integers(0, 100, (6, 6))
    assert abs(X.ncc(a, 2 * a + 9) - 1) < 1e-12


def test_phash_is_stable_under_small_change():
    g = X.gray(picture(64, 64, 3))
    other = X.gray(picture(64, 64, 4))
    bits = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    near = np.clip(g.astype(int) + 2, 0, 255).astype(np.uint8)
    assert bits(X.phash(g), X.phash(near)) <= 4 < bits(X.phash(g), X.phash(other))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("frames")
    for side in ("LR", "HR"):
        d = top / side / "clip"
        d.mkdir(parents=True)
        for k in range(1, 5):
            img = picture(seed=k)
            if k == 3:
                img = np.full((16, 24, 3), 77, np.uint8)  # no information
            if k == 4:
                img = picture(seed=1)  # like the first
            if side == "HR":
                img = np.kron(img, np.ones((2, 2, 1), np.uint8))
            (d / f"frame_{k:06d}.png").write_bytes(sinks.png(img))
        (d / "metadata.json").write_text(json.dumps({"duration": 100.0, "timestamps": {f"frame_{k:06d}.png": float(k) for k in range(1, 5)}}))
    (top / "LR" / "clip" / "frame_000009.png").write_bytes(b"no image")
    (top / "LR" / "bad").mkdir()
    (top / "LR" / "bad" / "metadata.json").write_text("{broken")
    return top


def frames(spark, folder):
    out = None
    for side in ("LR", "HR"):
        img = media.images(spark, str(folder / side)).select(
            F.lit(side).alias("side"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("video"), F.col("name").alias("frame_name"), *pipeline.IMAGE
        )
        sizes = media.frames(spark, str(folder / side), side).select("video", "frame_name", "length")
        one = img.join(sizes, ["video", "frame_name"])
        out = one if out is None else out.unionByName(one)
    return out


def times(spark, folder):
    a, b = (media.metadata(spark, str(folder / s)).withColumn("side", F.lit(s)) for s in ("LR", "HR"))
    return a.unionByName(b)


def test_sources(spark, folder):
    lr = media.images(spark, str(folder / "LR"))
    assert lr.count() == 5 and lr.where("data IS NULL").count() == 1
    row = lr.where("name = 'frame_000001.png'").first()
    assert (X.array_of(bytes(row["data"]), row["height"], row["width"]) == picture(seed=1)).all()
    assert times(spark, folder).count() == 8
    assert media.list_files(spark, str(folder / "LR" / "clip")).where("name LIKE '%.png'").count() == 5
    (folder / "Artifacts.txt").write_text("a.png\n\n b.png \n")
    assert {r["name"] for r in media.artifacts(spark, str(folder / "Artifacts.txt")).collect()} == {"a.png", "b.png"}


def test_videos_and_probe(spark, tmp_path):
    for n in ("A.MP4", "b.mkv", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    v = media.videos(spark, str(tmp_path), "LR")
    assert {r["stem_key"] for r in v.collect()} == {"a", "b"}

    def run(path):
        if "A.MP4" in path:
            raise TimeoutError
        return "12.5", '{"streams":[{"color_transfer":"smpte2084"}]}', "TFF: 9 BFF: 0 Progressive: 1"

    got = {r["stem_key"]: (r["duration"], r["hdr"], r["interlaced"]) for r in media.probe(v, run).collect()}
    assert got == {"a": (None, False, False), "b": (12.5, True, True)}


def test_whole_composition(spark, folder, tmp_path):
    out = pipeline.curate(frames(spark, folder), times(spark, folder), SMALL)
    assert {r["frame_name"] for r in out["kept"].collect()} >= {"frame_000001.png", "frame_000002.png"}
    assert out["kept"].where("frame_name = 'frame_000003.png'").count() == 0
    got = {(r["lr_frame"], r["hr_frame"]) for r in out["matched"].collect()}
    # frames 1 and 4 look alike: ties go to the first name, which the order of time then drops
    assert got == {("frame_000001.png", "frame_000001.png"), ("frame_000002.png", "frame_000002.png")}
    batches = out["batches"].collect()
    assert {r["name"] for r in batches} == {"clip_frame_000001.png", "clip_frame_000002.png"} and {r["batch"] for r in batches} == {0}
    files = tmp_path / "png"
    sinks.write_files(sinks.encoded(out["cropped"].where("side = 'LR'").withColumnRenamed("frame_name", "name")), str(files))
    assert len(list(files.iterdir())) == 4
    sinks.write_set(sinks.matched_set(out["unique"]), str(tmp_path / "set"))
    assert spark.read.parquet(str(tmp_path / "set")).count() == 4
    n = {r["counter"]: r["n"] for r in sinks.counters(matched=out["matched"], unique=out["unique"]).collect()}
    assert n == {"matched": 2, "unique": 2}


def test_content_fix_crops_the_wider_side(spark):
    wide = picture(40, 80, 8)
    inner = wide[:, 20:60]
    rows = [("LR", "v", "f", bytearray(inner.tobytes()), 40, 40, 3, "keep"), ("HR", "v", "f", bytearray(wide.tobytes()), 40, 80, 3, "keep")]
    df = spark.createDataFrame(rows, "side string, video string, frame_name string, data binary, height int, width int, channels int, extra string")
    got = {r["side"]: r for r in pipeline.content_fix(df).collect()}
    assert (got["HR"]["height"], got["HR"]["width"]) == (40, 40) and bytes(got["HR"]["data"]) == np.ascontiguousarray(inner).tobytes()
    assert (got["LR"]["width"], got["LR"]["extra"]) == (40, "keep")


def test_metadata_sink(spark, folder, tmp_path):
    rows = times(spark, folder).select("side", "video", "duration", "frame_name", "ts")
    sinks.write_metadata(rows, str(tmp_path / "meta"))
    assert spark.read.json(str(tmp_path / "meta")).count() == 2


def test_resumable_stage(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("a",), ("b",)], "item string").write.json(str(src))
    seen = []
    go = lambda n: streams.resumable(
        spark.readStream.schema("item string").json(str(src)), "stage", "item", str(tmp_path / "log"), lambda df: seen.extend(r["item"] for r in df.collect()), str(tmp_path / f"state{n}")
    ).awaitTermination()
    go(1)
    spark.createDataFrame([("b",), ("c",)], "item string").write.mode("append").json(str(src))
    go(2)  # a new state: the log alone keeps finished items from being done again
    assert sorted(seen) == ["a", "b", "c"]


def test_heartbeat_and_tags(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id * 10) AS at, if(id = 2, 'ERROR x', 'a.png') AS value FROM range(6)")
    assert sorted((r["lines"], r["images"], r["errors"]) for r in streams.heartbeat(df).collect()) == [(3, 2, 1), (3, 3, 0)]
    assert [r["kind"] for r in streams.tagged(df).collect()].count("error") == 1
