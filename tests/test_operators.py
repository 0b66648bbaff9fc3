"""Operators against plain Python, and worked examples."""


import sys

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from framewright.functions import text as T
from framewright.functions import vectors as V
from framewright.operators import batching, clean, dedup, extract, match, pairing, progress
from framewright.params import Params

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def fold(frames, t):
    """The fold over (i, h, z), with a dict as its state; returns what goes."""
    kept, gone = {}, set()
    for i, h, z in sorted(frames):
        near = next((k for k in kept if bin((k ^ h) & (2**64 - 1)).count("1") < t), None)
        if near is None:
            kept[h] = (i, z)
        elif z >= kept[near][1]:
            gone.add(kept.pop(near)[0])
            kept[h] = (i, z)
        else:
            gone.add(i)
    return gone


def removed(spark, frames, t):
    df = spark.createDataFrame([("v", *f) for f in frames], "g string, i long, h long, z long")
    return {r["i"] for r in dedup.removed_by_fold(df, ["g"], t).collect()}


def test_fold_examples(spark):
    assert removed(spark, [(1, 0b0, 10), (2, 0b1, 10), (3, 0b1111, 5), (4, 0b11, 9), (5, 0xFF00, 1)], 4) == {1, 3, 4}
    assert removed(spark, [(1, 0, 10), (2, 0, 10)], 0) == set()
    assert removed(spark, [(1, 0b00000, 1), (2, 0b11111, 1), (3, 0b00111, 1), (4, 0b00111, 1)], 4) == fold(
        [(1, 0b00000, 1), (2, 0b11111, 1), (3, 0b00111, 1), (4, 0b00111, 1)], 4
    )


@SLOW
@given(st.lists(st.tuples(st.integers(0, 63), st.integers(0, 4)), max_size=25), st.integers(0, 4))
def test_fold_equals_loop(spark, items, t):
    frames = [(k, h, z) for k, (h, z) in enumerate(items)]
    assert removed(spark, frames, t) == fold(frames, t)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(-3, 9)), max_size=30))
def test_monotone_equals_loop(spark, pairs):
    rows = [("v", f"{k:03d}", float(a), float(b)) for k, (a, b) in enumerate(pairs)]
    last, want = -1.0, set()
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        if r[3] >= last:
            last = r[3]
            want.add(r[1])
    df = spark.createDataFrame(rows, "video string, lr_frame string, lr_ts double, hr_ts double")
    assert {r["lr_frame"] for r in match.monotone(df).collect()} == want


@SLOW
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40)), max_size=20), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40)), max_size=20))
def test_interval_join_equals_loop(spark, lr, hr):
    w = {0: 0.0, 1: 3.0, 2: 7.5}
    a = [(v, f"l{k}", t / 2, w[v]) for k, (v, t) in enumerate(lr)] + [(1, "null", None, 3.0)]
    b = [(v, f"h{k}", t / 2) for k, (v, t) in enumerate(hr)] + [(1, "null", None)]
    want = {(x[1], y[1]) for x in a for y in b if x[2] is not None and y[2] is not None and x[0] == y[0] and abs(x[2] - y[2]) <= x[3]}
    got = match.interval_join(
        spark.createDataFrame(a, "video int, lr_frame string, lr_ts double, w double"), spark.createDataFrame(b, "video int, hr_frame string, hr_ts double")
    )
    found = [(r["lr_frame"], r["hr_frame"]) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_windows(spark):
    w = lambda d, **k: one(spark, match.window_of(F.lit(d).cast("double"), Params(**k)))
    assert abs(w(100.0) - 6) < 1e-9 and abs(w(None) - 10) < 1e-9 and abs(w(0.0) - 10) < 1e-9 and w(None, window_share=0.0) == 0


def test_correlation(spark):
    arr = lambda *x: F.array(*[F.lit(float(v)) for v in x])
    base = arr(1, 2, 3, 4)
    for other, want in (((2, 4, 6, 8), 1), ((4, 3, 2, 1), -1), ((2, 1, 4, 3), 0.6), ((5, 5, 5, 5), 0)):
        assert abs(one(spark, V.ncc(base, arr(*other))) - want) < 1e-12
        assert abs(one(spark, V.ncc_prepared(V.unit_centred(base), V.unit_centred(arr(*other)))) - want) < 1e-12
    assert one(spark, V.ncc(arr(3, 3), arr(1, 2))) == 1.0
    assert one(spark, V.var_pop(arr(0, 0, 20, 20))) == 100.0


def test_best_match_ties(spark):
    df = spark.createDataFrame([("v", "l", "frame_000003", 0.8), ("v", "l", "frame_000002", 0.8), ("v", "l", "a", 0.7)], "video string, lr_frame string, hr_frame string, score double")
    assert match.best_match(df).first()["hr_frame"] == "frame_000002"


def test_tracked_window_follows(spark):
    lr = spark.createDataFrame([("v", "a", 10.0, 100.0, [1.0, 2.0]), ("v", "b", 20.0, 100.0, [1.0, 2.0])], "video string, lr_frame string, lr_ts double, duration double, lr_pixels array<double>")
    hr = spark.createDataFrame([("v", "x", 14.0, [1.0, 2.0]), ("v", "y", 14.5, [2.0, 1.0]), ("v", "z", 28.5, [1.0, 2.0])], "video string, hr_frame string, hr_ts double, hr_pixels array<double>")
    assert {(r["lr_frame"], r["hr_frame"]) for r in match.tracked_match(lr, hr).collect()} == {("a", "x"), ("b", "z")}
    assert {(r["lr_frame"], r["hr_frame"]) for r in match.temporal_match(lr, hr).collect()} == {("a", "x"), ("b", "x")}


def test_names(spark):
    v = lambda s: one(spark, T.video_of(F.lit(s)))
    assert (v("a_b_frame_000012.png"), v("x.png"), v("a_frame_1.jpg"), v("a_frame_1.PNG")) == ("a_b", None, None, None)
    assert one(spark, T.stem_key(F.lit("/x/My.Clip.MP4"))) == "my.clip"
    assert one(spark, T.is_video(F.lit("a.MKV"))) and not one(spark, T.is_video(F.lit("a.txt")))
    assert one(spark, T.matched_name(F.lit("v"), F.lit("frame_000001.png"))) == "v_frame_000001.png"


def test_probe_rules(spark):
    i = lambda *c: one(spark, T.is_interlaced(*[F.lit(x) for x in c]))
    assert [i(0, 0, 0), i(1, 0, 3), i(2, 0, 3), i(25, 1, 74)] == [False, False, True, True]
    p = lambda s: one(spark, T.pts_time(F.lit("[Parsed_showinfo_1 @ 0] " + s)))
    assert [p("pts_time:12.5"), p("pts_time:-0.04"), p("pts_time:1e-05")] == [12.5, None, 1.0]
    assert one(spark, T.duration(F.lit(" 3.5\n"))) == 3.5 and one(spark, T.duration(F.lit("N/A"))) is None
    assert not one(spark, T.is_hdr(F.lit("{bad"))) and not one(spark, T.is_hdr(F.lit('{"streams":[]}')))
    assert one(spark, T.is_hdr(F.lit('{"streams":[{"color_primaries":"bt2020"}]}')))
    assert one(spark, T.last_lines(F.lit("\n".join(map(str, range(15)))))) == "\n".join(map(str, range(5, 15)))


def test_reconcile(spark):
    def r(n, t):
        names = F.array(*[F.lit(f"f{k}") for k in range(n)]).cast("array<string>")
        return one(spark, extract.reconcile(names, F.array(*[F.lit(float(x)) for x in t]).cast("array<double>")))

    assert r(3, [1, 2]) == [1, 2, 2] and r(2, [1, 2, 3]) == [1, 2] and r(2, []) is None and r(0, [1]) is None


def test_scene(spark):
    df = spark.createDataFrame([("v", k, float(m)) for k, m in enumerate((0, 30, 35, 80, 10))], "video string, ts int, mafd double")
    assert {(r["ts"], round(r["scene"], 9)) for r in extract.scene_cuts(df).collect()} == {(1, 0.3), (3, 0.45)}


def test_contest_and_aspect(spark):
    c = lambda a, b: one(spark, clean.contest(F.lit(a), F.lit(b)))
    assert [c(0.8, 0.7), c(0.7, 0.8), c(0.8, 0.8), c(0.7, 0.6)] == ["crop_hr", "crop_lr", "none", "none"]
    assert not one(spark, clean.aspect_differs(F.lit(1920), F.lit(1080), F.lit(1280), F.lit(720)))
    assert one(spark, clean.aspect_differs(F.lit(640), F.lit(480), F.lit(1920), F.lit(1080)))


def test_batches(spark):
    for n, want in ((50, 1), (51, 2), (100, 2), (101, 3)):
        df = spark.createDataFrame([("v", f"{k:04d}") for k in range(n)], "video string, name string")
        got = batching.batches(df).agg(F.max("batches"), F.min("suffix"), F.max("suffix")).first()
        assert got[0] == want and (got[1] == "") == (want == 1) and got[2] == ("" if want == 1 else f"_batch_{want}")


def test_progress(spark, tmp_path):
    rows = [("s", "A", None, 1), ("s", None, True, 2), ("s", "B", None, 3), ("t", None, None, 4), ("u", "x", True, 5)]
    df = spark.createDataFrame(rows, progress.SCHEMA)
    got = {r["stage"]: (r["items"], r["completed"]) for r in progress.state(df).collect()}
    assert got == {"s": (["A", "B"], False), "t": ([], False), "u": (["x"], True)}
    path = str(tmp_path / "log")
    assert progress.read_log(spark, path).count() == 0
    progress.append_log(df, path)
    items = spark.createDataFrame([("A",), ("C",)], "k string")
    assert [r["k"] for r in progress.pending(items, progress.read_log(spark, path), "s", "k").collect()] == ["C"]


def test_align(spark):
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    got = batching.collect_results(names("p.png", "q.png"), names("q.png", ""), names("p.png"), names("q.png")).collect()
    assert [tuple(r) for r in got] == [("p.png", True, False)]
    assert batching.command("tool", "l", "h", "o", Params(align_color_copy=True))[-2:] == ["-i", "1"]
    ok, last = batching.supervised([sys.executable, "-c", "print('a.png'); print('done')"], 30)
    assert ok and last == ["a.png", "done"]
    assert not batching.supervised([sys.executable, "-c", "import time; time.sleep(9)"], 0.5)[0]
    assert not batching.supervised(["/no/such/tool"], 1)[0]
    pairs = spark.createDataFrame([("v", 0, "a"), ("v", 1, "b")], "video string, batch int, name string")
    out = batching.aligned(pairs, lambda pdf: pdf.assign(n=len(pdf))[["name", "n"]], "name string, n long")
    assert {tuple(r) for r in out.collect()} == {("a", 1), ("b", 1)}


def test_pairing(spark):
    rows = [("a", "/1/A.mp4"), ("a", "/2/a.mkv"), ("b", "/1/b.mp4")]
    df = spark.createDataFrame(rows, "stem_key string, path string")
    assert {tuple(r) for r in pairing.last_by_stem(df).select("stem_key", "path").collect()} == {("a", "/2/a.mkv"), ("b", "/1/b.mp4")}
    other = spark.createDataFrame([("b",), ("c",)], "stem_key string")
    assert {tuple(r) for r in pairing.unmatched(df, other, ["stem_key"]).collect()} == {("a", "LR"), ("c", "HR")}


def test_time_range(spark):
    rows = spark.createDataFrame([(float(x),) for x in (0, 10, 20, 30)], "ts double")
    n = lambda **k: rows.where(T.in_range("ts", Params(**k))).count()
    assert n() == 4 and n(begin_time="00:00:10") == 3 and n(end_time="00:00:20") == 3 and n(begin_time="00:00:10", end_time="00:00:20") == 2




def test_extraction_boundary(spark):
    def run(path, chain):
        if path == "bad":
            raise OSError
        log = "x\n[Parsed_showinfo_2 @ 1] pts_time:0.5 a\n[Parsed_showinfo_2 @ 1] pts_time:2 b"
        return ([] if path == "none" else ["frame_000002.png", "frame_000001.png", "frame_000003.png"]), log

    rows = [("LR", p, p, "c") for p in ("good", "bad", "none")]
    got = extract.extracted(spark.createDataFrame(rows, "side string, video string, path string, chain string"), run).collect()
    assert {(r["video"], r["frame_name"], r["ts"], r["status"]) for r in got} == {
        ("good", "frame_000001.png", 0.5, "ok"), ("good", "frame_000002.png", 2.0, "ok"), ("good", "frame_000003.png", 2.0, "ok"),
        ("bad", None, None, "failed: OSError"), ("none", None, None, "no frames or times"),
    }


def test_filter_chain_rules(spark):
    p = Params(hdr_tone_mapping=True)
    chain = lambda side, hdr, mode, t=0.2: one(spark, T.filter_chain(F.lit(side), F.lit(False), F.lit(hdr), t, p, hdr_mode=F.lit(mode)))
    # only 'auto' asks whether the video is HDR
    got = {(s, h, m) for s in ("LR", "HR") for h in (False, True) for m in ("auto", "both", "hr_only", "lr_only", "off") if p.hdr_filter in chain(s, h, m)}
    want = {(s, True, "auto") for s in ("LR", "HR")} | {(s, h, m) for h in (False, True) for s, m in (("LR", "both"), ("HR", "both"), ("HR", "hr_only"), ("LR", "lr_only"))}
    assert got == want
    assert chain("LR", False, "off", 0.125).endswith("select='gt(scene,0.125)',showinfo")
    assert chain("LR", False, "off") == "scale=sws_flags=lanczos:in_color_matrix=bt709,format=yuv444p,select='gt(scene,0.2)',showinfo"
    assert Params().deinterlace_filter == "bwdif=mode=send_frame:parity=auto"


def test_batch_size_zero_is_one_batch(spark):
    df = spark.createDataFrame([("v", f"{k:04d}") for k in range(120)], "video string, name string")
    assert {(r["batch"], r["batches"], r["suffix"]) for r in batching.batches(df, p=Params(align_batch=0)).collect()} == {(0, 1, "")}


def test_windows_may_differ_inside_a_video(spark):
    lr = spark.createDataFrame([("v", "l1", 10.0, 1.0), ("v", "l2", 30.0, 6.0)], "video string, lr_frame string, lr_ts double, w double")
    hr = spark.createDataFrame([("v", f"h{t}", float(t)) for t in range(0, 40)], "video string, hr_frame string, hr_ts double")
    got = {(r["lr_frame"], r["hr_frame"]) for r in match.interval_join(lr, hr).collect()}
    assert got == {("l1", f"h{t}") for t in (9, 10, 11)} | {("l2", f"h{t}") for t in range(24, 37)}


def test_scores_are_compared_unrounded(spark):
    a = np.zeros(100)
    a[0] = 1
    b = a.copy()
    b[1] = 1e-4  # differs from a far behind the sixth place
    lr = spark.createDataFrame([("v", "l", 0.0, 5.0, a.tolist())], "video string, lr_frame string, lr_ts double, w double, lr_pixels array<double>")
    hr = spark.createDataFrame([("v", "a", 0.0, b.tolist()), ("v", "b", 0.0, a.tolist()), ("v", "c", 1.0, a.tolist())], "video string, hr_frame string, hr_ts double, hr_pixels array<double>")
    assert match.best_candidates(lr, hr).first()["hr_frame"] == "b"


def test_best_candidates_on_bytes_equal_plain(spark):
    """Working size, many blocks, flat and unreadable frames, windows of different width."""
    from framewright.functions import pixels

    rng = np.random.default_rng(2)
    scenes = rng.integers(0, 256, (6, 955 * 540), dtype=np.uint8)
    noisy = lambda k: np.clip(scenes[k].astype(int) + rng.integers(-40, 40, scenes.shape[1]), 0, 255).astype(np.uint8)
    lr = [(v, f"l{k}", 2.0 * k, 3.0 + v, bytes(noisy(k % 6))) for v in (1, 2) for k in range(6)] + [(1, "flat", 3.0, 3.0, bytes(955 * 540)), (1, "bad", 3.0, 3.0, None)]
    hr = [(v, f"h{k}", 1.0 * k, bytes(noisy(k % 6))) for v in (1, 2) for k in range(12)] + [(2, "flat", 4.0, bytes(955 * 540)), (2, "bad", 4.0, None)]
    got = match.best_candidates(
        spark.createDataFrame(lr, "video int, lr_frame string, lr_ts double, w double, lr_pixels binary"),
        spark.createDataFrame(hr, "video int, hr_frame string, hr_ts double, hr_pixels binary"),
    ).collect()
    image = lambda b: np.frombuffer(b, np.uint8).reshape(540, 955)
    want = {}
    for v, f, t, w, px in lr:
        near = [(-pixels.ncc(image(px), image(p)), g) for u, g, s, p in hr if px and p and u == v and abs(t - s) <= w]
        if near:
            want[v, f] = min(near)
    assert {(r["video"], r["lr_frame"]): r["hr_frame"] for r in got} == {k: g for k, (_, g) in want.items()}
    assert all(abs(r["score"] + want[r["video"], r["lr_frame"]][0]) < 1e-9 for r in got)


def test_long_vectors_are_folded(spark):
    v = list(map(float, range(64))) + [0.0] * 63 + [-200.0]
    assert one(spark, V.median_hash(F.array(*map(F.lit, v)))) == sum(1 << k for k in range(31, 63))
    assert one(spark, V.median_hash(F.array(*map(F.lit, v[:64])))) == sum(1 << k for k in range(32, 63)) - (1 << 63)


def test_dedup_by_components_equals_loop(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    frames = []
    for k in range(3000):
        h = int(base[rng.integers(40)])
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            h ^= (1 << int(b)) if b < 63 else -(1 << 63)
        frames.append((k, h, int(rng.integers(0, 9))))
    for t in (1, 3, 4, 6, 9):
        assert removed(spark, frames, t) == fold(frames, t), t
    rows = [("a", *f) for f in frames[:500]] + [(None, *f) for f in frames[:500]]
    df = spark.createDataFrame(rows, "g string, i long, h long, z long")
    assert {(r["g"], r["i"]) for r in dedup.removed_by_fold(df, ["g"], 4).collect()} == {(g, i) for g in ("a", None) for i in fold(frames[:500], 4)}
