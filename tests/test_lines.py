"""Line numbers and aligned reading over many files and blocks."""

import os
import random

import pytest

from quire.sources import files as fs


def write(folder, parts):
    os.makedirs(folder)
    for name, lines in parts.items():
        with open(f"{folder}/{name}", "w", newline="") as f:
            f.write("".join(line + "\n" for line in lines))


def test_aligned_two_files_a_side(spark, scratch):
    write(f"{scratch}/h", {"part-00000": ["h0", "h1", "h2"], "part-00001": ["h3", "h4", "h5"]})
    write(f"{scratch}/r", {"part-00000": ["r0"], "part-00001": ["r1", "r2", "r3", "r4"], "part-00002": ["r5"]})
    got = sorted((r.line, r.hyp, r.ref) for r in fs.read_aligned(spark, f"{scratch}/h", f"{scratch}/r").collect())
    assert got == [(i, f"h{i}", f"r{i}") for i in range(6)]
    write(f"{scratch}/short", {"part-00000": ["r0"]})
    with pytest.raises(ValueError, match="6 vs 1"):
        fs.read_aligned(spark, f"{scratch}/h", f"{scratch}/short")


def test_numbers_over_blocks(spark, scratch):
    """Files cut into many blocks, lines longer than a block, empty lines,
    an empty file, part numbers of different length."""
    rng = random.Random(6)
    parts = {f"part-{n:05d}": [f"{n}:{k}:" + "é" * rng.randrange(60 if k % 50 else 6000) for k in range(rng.randrange(1, 400))]
             for n in (0, 1, 2, 99_999, 100_000)}
    parts["part-00001"][3:5] = ["", ""]
    parts["part-00003"] = []
    write(f"{scratch}/c", parts)
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "2000")
    try:
        rows = fs.read_lines(spark, f"{scratch}/c", strip=False).collect()
    finally:
        spark.conf.set(key, old)
    order = sorted(parts, key=lambda p: int(p.split("-")[1]))
    want = [(p, k, line) for p in order for k, line in enumerate(parts[p])]
    got = sorted((r.row, os.path.basename(r.file), r.line, r.text) for r in rows)
    assert got == [(i, p, k, line) for i, (p, k, line) in enumerate(want)]


def test_no_lines(spark, scratch):
    write(f"{scratch}/e", {"a.txt": []})
    assert fs.read_lines(spark, f"{scratch}/e").collect() == []
    assert fs.read_aligned(spark, f"{scratch}/e", f"{scratch}/e").collect() == []
