"""The Jaccard join: hashing of whole segments, links through rows without an id, both routes of its joins, long texts."""

import random
import subprocess
import sys
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from gridpulse.llm import jaccard_tiles

RULE = jaccard_tiles.Rule(3, 90, 100)


def words(seed, n):
    rng = random.Random(seed)
    return [rng.choice("abcdefghij") + str(rng.randrange(200)) for _ in range(n)]


def chain():
    """Three texts of which neighbours link and the ends do not."""
    base = words(1, 120)
    far = list(base)
    texts = [" ".join(base)]
    for at in (30, 33):  # each edit changes a few shingles
        far[at] = f"changed{at}"
        texts.append(" ".join(far))
    return texts


def test_segments_and_brute_force_agree(monkeypatch):
    texts = [None, "", " \n\t", "a", "A b", "a  B", "a b c", "A\tb\nC", "é É", "é É é É", "x" * 500, " ".join(words(2, 400)), "\x1c a \x85 b\x00c"]
    whole = jaccard_tiles.Shingler(3)(pa.array(texts))
    for x, s in zip(texts, whole):
        w = "".join(c.lower() if c.isascii() else c for c in x or "").encode().split()
        assert len(s) == len({tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else ())
        assert (np.diff(s.astype(object)) > 0).all()
    assert (whole[4] == whole[5]).all() and (whole[6] == whole[7]).all()
    for segment in (1, 7, 64):
        monkeypatch.setattr(jaccard_tiles, "SEGMENT", segment)
        cut = jaccard_tiles.Shingler(3)(pa.array(texts))
        assert all(len(a) == len(b) and (a == b).all() for a, b in zip(whole, cut))
    sliced = jaccard_tiles.Shingler(3)(pa.array(texts)[6:9])
    assert [x.tolist() for x in sliced] == [x.tolist() for x in whole[6:9]]


def test_bands_cover_all_sizes_in_order():
    for rule in (RULE, jaccard_tiles.Rule(5, 4, 5)):
        bands = jaccard_tiles.Bands(rule)
        for size in (*range(1, 400), 10**5, 3 * 10**7):
            own, *more = bands.of(size)
            assert own.low <= size < own.high and own.differ < own.buckets
            assert bool(more) == (size * rule.den // rule.num >= own.high)
        assert all(a.high == b.low for a, b in zip(bands.made, bands.made[1:]))


@pytest.mark.parametrize("ids", [(1, None, 2), (1, 3, 2), (None, 7, None)])
def test_links_run_through_rows_without_an_id(spark, ids):
    rows = [*zip(ids, chain()), (9, " ".join(words(9, 100))), (None, None), (None, " ".join(words(10, 100)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_tiles.jaccard_components(df, jaccard_tiles.Rule(3, 94, 100)).collect()
    smallest = min(i for i in ids if i is not None)
    assert len(got) == len(rows)
    assert sum(r.component_id == smallest for r in got) == 3
    assert sorted(str(r.component_id) for r in got if r.component_id != smallest) == ["9", "None", "None"]


def test_both_routes_give_the_same(spark, monkeypatch):
    base, rows = words(3, 150), []
    for i in range(60):
        text = list(base if i % 2 else words(i, 80 + i))
        text[i % 70] = f"edit{i}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string").repartition(4)
    want = sorted(map(tuple, jaccard_tiles.jaccard_components(df, RULE).collect()))
    assert len({r[2] for r in want}) < 45
    monkeypatch.setattr(jaccard_tiles, "BROADCAST_MEMBERS", 0)
    monkeypatch.setattr(jaccard_tiles, "TILE_SETS", 4)
    assert sorted(map(tuple, jaccard_tiles.jaccard_components(df, RULE).collect())) == want


def test_long_texts(spark):
    many = " ".join(words(5, 300_000))
    rows = [(1, "x" * 2_000_000), (2, "x y " * 400_000), (3, " " * 2_000_000), (4, many), (5, many + " end"), (6, "x y x y x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_tiles.jaccard_components(df, RULE).collect()}
    assert got[1] == (1, 1) and got[2] == (2, 2) and got[3] == (0, 3) and got[6] == (2, 2)
    assert got[4][1] == got[5][1] == 4 and got[5][0] == got[4][0] + 1


def test_workers_need_no_copy_of_the_package():
    """The driver alone finds the package: workers start in another folder, without its path."""
    root = Path(__file__).resolve().parents[2]
    code = f"""
import os, sys, tempfile
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1").config("spark.checkpoint.dir", folder).getOrCreate())
from gridpulse.llm import jaccard_tiles, collocations, feast
df = spark.createDataFrame([(1, "a b c d", "en"), (2, "a b c d", "en"), (3, "z", "en")], "doc_id long, text string, lang string")
print([r.component_id for r in jaccard_tiles.jaccard_components(df, jaccard_tiles.Rule(3, 90, 100)).orderBy("doc_id").collect()])
print(collocations.collocations(df, 2).count())
print(feast.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 1.0])], "vec_id long, embedding array<double>")).count())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tempfile.mkdtemp(prefix="run-", dir="/tmp"), capture_output=True, text=True, timeout=300)
    assert done.stdout.split("\n")[:3] == ["[1, 1, 3]", "1", "2"], done.stderr[-2000:]
