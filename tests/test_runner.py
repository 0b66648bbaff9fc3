"""The whole run with stub tools, killed in between and taken up again."""

import os
import stat
import sys

import pytest

from framewright.operators import progress, tools
from framewright.params import Params
from framewright.plans import runner

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

#: A video is a text of lines "time seed"; its frames are made from the seeds.
EXTRACT = """
import sys, numpy as np
sys.path.insert(0, {root!r})
from framewright.sources.sinks import png
args = sys.argv[1:]
path = args[args.index("-i") + 1]
open({calls!r}, "a").write(("idet " if "idet" in " ".join(args) else "extract ") + path + chr(10))
if "idet" in " ".join(args):
    sys.stderr.write("TFF: 0 BFF: 0 Progressive: 9"); sys.exit()
if "broken" in path:
    sys.exit(1)
target = next(a for a in args if "%06d" in a)
scale = 2 if "/HR/" in path else 1
for n, line in enumerate(open(path).read().split(chr(10)), 1):
    t, seed = line.split()
    base = np.random.default_rng(int(seed)).integers(30, 250, (6, 8, 3)).astype(np.uint8)
    open(target % n, "wb").write(png(np.kron(base, np.ones((4 * scale, 4 * scale, 1), np.uint8))))
    sys.stderr.write("[Parsed_showinfo_1 @ 0] pts_time:" + t + chr(10))
"""
PROBE = "print('100.0')"
ALIGN = """
import sys, os, shutil
a = sys.argv
lr, hr, out = a[a.index("-l") + 1], a[a.index("-g") + 1], a[a.index("-o") + 1]
for side, src in (("LR", lr), ("HR", hr)):
    shutil.copytree(src, out + "/Output/" + side)
names = sorted(os.listdir(lr))
os.makedirs(out + "/Output/Overlay"); shutil.copy(lr + "/" + names[0], out + "/Output/Overlay/" + names[0])
open(out + "/Output/Artifacts.txt", "w").write(names[-1] + chr(10))
print(*names, sep=chr(10))
"""


def tool(path, code):
    path.write_text(f"#!{sys.executable}\n{code}")
    path.chmod(path.stat().st_mode | stat.S_IXUSR)
    return str(path)


def test_run_is_taken_up_again(spark, tmp_path, monkeypatch):
    lr, hr, out, calls = tmp_path / "LR", tmp_path / "HR", tmp_path / "out", tmp_path / "calls"
    lr.mkdir(), hr.mkdir()
    for k, name in enumerate(("One", "two", "broken")):
        times = "\n".join(f"{t} {100 * k + t}" for t in (10, 20, 30))
        (lr / f"{name}.mkv").write_text(times)
        (hr / f"{name.lower()}.MP4").write_text("\n".join(f"{t + 1} {100 * k + t}" for t in (10, 20, 30)))
    (lr / "alone.avi").write_text("1 1")
    extract = tool(tmp_path / "extract", EXTRACT.format(root=ROOT, calls=str(calls)))
    probe, align = tool(tmp_path / "probe", PROBE), tool(tmp_path / "align", ALIGN)
    p = Params(crop_black=False, attempt_content_fix=False, match_width=32, match_height=24, align_batch=2)
    go = lambda: runner.run(spark, str(lr), str(hr), str(out), probe, extract, align, p, size=1)

    real, left = progress.append_log, [2]

    def killed(calls_, path):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        real(calls_, path)

    monkeypatch.setattr(progress, "append_log", killed)
    with pytest.raises(KeyboardInterrupt):
        go()
    monkeypatch.setattr(progress, "append_log", real)
    assert go() == {"matched": 6, "aligned": 2}
    made = [x.rsplit("/", 2)[-2:] for x in calls.read_text().split("\n") if x.startswith("extract")]
    # the third video was done when the run was killed, but not logged; the first two were not done again
    assert sorted(made) == sorted([["LR", "One.mkv"], ["HR", "one.MP4"], ["LR", "broken.mkv"], ["LR", "two.mkv"], ["HR", "two.MP4"], ["LR", "two.mkv"], ["HR", "two.MP4"]])
    # batches of two and one images: the last of each is an artifact, and a batch's first has an overlay
    assert sorted(os.listdir(out / "3_ALIGNED" / "HR")) == ["One_frame_000001.png", "two_frame_000001.png"]
    assert sorted(os.listdir(out / "3_ALIGNED" / "Overlay")) == ["One_frame_000001.png", "two_frame_000001.png"]
    assert sorted(os.listdir(out / "2_MATCHED" / "LR")) == sorted(os.listdir(out / "2_MATCHED" / "HR"))
    before = calls.read_text()
    assert go() == {"matched": 6, "aligned": 2} and calls.read_text() == before


def test_commands():
    p = Params(begin_time="00:01:00", end_time="00:02:00")
    cmd = tools.extract_command("x", "v.mkv", "/f", "chain", p)
    assert cmd[3:7] == ["-ss", "00:01:00", "-to", "00:02:00"] and cmd[cmd.index("-vf") + 1] == "chain" and "/f/frame_%06d.png" in cmd
    assert "-to" not in tools.extract_command("x", "v", "/f", "c", Params(begin_time="00:01:00")) and "-ss" not in tools.extract_command("x", "v", "/f", "c")
    assert tools.said([sys.executable, "-c", "import time; time.sleep(9)"], 0.3) is None
    assert tools.said([sys.executable, "-c", "raise SystemExit(3)"], 9) is None and tools.said(["/no/such"], 1) is None
    assert tools.said([sys.executable, "-c", "print(1)"], 9)[0] == "1\n"
