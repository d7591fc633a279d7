import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tonescope.llm import jaccard_join, lm_scoring

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in SPACE.split(lower(text)) if w]


def brute_scores(rows):
    """Scores from plain dictionaries, with the model's formulas."""
    texts = [(d, zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0, words(t) + ["</s>"])
             for d, t in rows]
    train = [w for _, held, w in texts if not held]
    c = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["<s>", *t[:-1]], t))
    history, fans = Counter(), Counter(h for h, _ in pairs)
    for (h, _), n in pairs.items():
        history[h] += n
    once, twice = (sum(1 for n in pairs.values() if n == k) for k in (1, 2))
    discount = min(max(once / (once + 2 * twice), 0.1), 0.999) if once else 0.5
    total = sum(c.values())

    def low(w):
        return (c[w] + 0.1) / (total + 0.1 * (len(c) + 1))

    def high(h, w):
        if not history[h]:
            return low(w)
        return max(pairs[h, w] - discount, 0) / history[h] + discount * fans[h] / history[h] * low(w)

    for d, held, t in texts:
        yield (d, held, len(t), sum(c[w] > 0 for w in t), total, sum(math.log10(low(w)) for w in t),
               sum(math.log10(high(h, w)) for h, w in zip(["<s>", *t[:-1]], t)))


@pytest.mark.parametrize("chunk_chars,parts", [(1, 3), (10**7, 20)])
def test_scores(messy, plain, chunk_chars, parts):
    got = sorted(map(tuple, lm_scoring.score(messy, chunk_chars=chunk_chars, parts=parts).collect()),
                 key=repr)
    want = sorted(brute_scores([(d, t) for d, t, _ in plain]), key=repr)
    key = lambda r: (repr(r[:5]), r[5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def brute_components(rows, k, percent):
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return Counter((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("k,percent,tile", [(3, 90, 1024), (1, 50, 4)])
def test_components(messy, plain, k, percent, tile):
    got = jaccard_join.similar_components(messy, k, percent, tile=tile).collect()
    want = brute_components([(d, t) for d, t, _ in plain], k, percent)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert len({r.row for r in got}) == len(got)


def test_large_bitmaps_bound_the_difference():
    draw = np.random.default_rng(4)
    for n, m, common in ((1, 1, 1), (5, 700, 3), (700, 5, 0), (3000, 2900, 2500), (40_000, 9_000, 8_000)):
        both = np.unique(draw.integers(0, 2**64, n + m, np.uint64))[:n + m - common]
        left, right = both[:n], np.concatenate([both[:common], both[n:]])
        bits = [np.frombuffer(jaccard_join.large_bitmap(x), np.uint64) for x in (left, right)]
        differ = jaccard_join.bits_differ(*bits)
        assert differ <= len(np.setxor1d(left, right)) and differ % 2 == len(np.setxor1d(left, right)) % 2
        if n == 3000:  # close enough to tell what is far from similar
            assert differ > 0.7 * len(np.setxor1d(left, right))


def test_tiles_meet_whatever_the_batches(spark):
    """Cells of one and of two tiles, split over batches, against all pairs."""
    draw = np.random.default_rng(9)
    rows = [(int(key), int(node), int(n), int(node) % 7, [int(x) for x in draw.integers(0, 4, 16)])
            for key in range(5) for node, n in zip(range(60), draw.integers(20, 200, 60))]
    frame = spark.createDataFrame(rows, "key long, node long, n long, root long, bitmap array<long>")
    want = set()
    for key, a, n, r, x in rows:
        for other, b, m, q, y in rows:
            if key == other and a < b and r != q:
                differ = sum((u ^ v).bit_count() for u, v in zip(x, y))
                overlap = min((n + m - differ) / 2, n, m)
                if overlap * 150 >= (n + m) * 50 and min(n, m) * 100 >= max(n, m) * 50:
                    want.add((a, b))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        got = {tuple(r) for r in jaccard_join.tile_candidates(frame, 50, 8).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == want and want


def test_a_pair_that_meets_at_many_elements_is_named_once():
    """Six near copies share twenty elements; two that share a late one only are too far apart."""
    import pyarrow as pa
    shared = list(range(100, 120))
    prefixes = {node: [node, *shared] for node in range(6)} | {
        6: [*range(200, 220), 300], 7: [*range(220, 240), 300], 8: [400, 500], 9: [401, 500]}
    met = defaultdict(list)
    for node, prefix in prefixes.items():
        for pos, key in enumerate(prefix):
            met[key].append((key, 0, 0, 0, node, 100, node, [0] * 16, pos, prefix[:jaccard_join.HEAD]))
    names = ["key", "tile_a", "tile_b", "tile", "node", "n", "root", "bitmap", "pos", "head"]
    rows = [row for key in sorted(met) for row in sorted(met[key]) if len(met[key]) > 1]
    table = pa.table(dict(zip(names, map(list, zip(*rows)))))
    found = [pair for batch in jaccard_join._met(table, jaccard_join._cells(table), 80)
             for pair in zip(batch["a"].to_pylist(), batch["b"].to_pylist())]
    assert sorted(found) == [(a, b) for a in range(6) for b in range(a + 1, 6)] + [(8, 9)]


@pytest.mark.parametrize("k,percent,changed", [(3, 90, 4), (5, 80, 3)])
def test_many_near_copies_around_the_limit(spark, k, percent, changed):
    draw = random.Random(7)
    base, rows = [f"w{i}" for i in range(150)], []
    for n in range(90):
        text = list(base[:draw.randint(110, 150)])
        for i in draw.sample(range(len(text)), draw.randint(0, changed)):
            text[i] = f"x{draw.randint(0, 5) if n % 2 else n}"
        rows.append((n, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.similar_components(docs, k, percent, tile=64).collect()
    want = brute_components(rows, k, percent)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert 1 < len({c for _, _, c in want}) < 90


def test_chain_of_links(spark):
    """Neighbours are similar, the ends are not: one component."""
    line = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(line[4 * i:4 * i + 100])) for i in range(26)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.similar_components(docs, 3, 90).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows, 3, 90)
    assert {r.component_id for r in got if r.doc_id < 26} == {0}


def test_bitmaps_never_exclude_a_link(spark, messy, plain):
    texts = messy.selectExpr("monotonically_increasing_id() as doc_id", "text")
    nodes = jaccard_join.sketches(
        texts, 2, 50, True, jaccard_join.frequent(texts, 2, True)).where("n > 0")
    a = nodes.selectExpr("n as a_n", "bitmap as a_bitmap")
    assert a.withColumnsRenamed({"a_n": "b_n", "a_bitmap": "b_bitmap"}).selectExpr(
        "*", "b_n as a_n", "b_bitmap as a_bitmap").where(~jaccard_join.may_link(100)).count() == 0


def test_empty_tables(nothing):
    assert lm_scoring.score(nothing).count() == 0
    assert jaccard_join.similar_components(nothing).count() == 0


def test_what_jobs_shuffle_goes_from_disk_before_the_result_is_used(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    docs = spark.createDataFrame(
        [(n, " ".join(f"w{(n % 5) * 40 + i}" for i in range(30 + n % 3))) for n in range(60)],
        "doc_id long, text string").repartition(3).localCheckpoint()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = disk.getAllFiles().size(), spark.conf.get(key)
    result = jaccard_join.similar_components(docs)
    for _ in range(50):
        if disk.getAllFiles().size() <= before + 16:
            break
        time.sleep(0.1)
    assert disk.getAllFiles().size() <= before + 16
    assert spark.conf.get(key) == setting and result.count() == 60
