import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tonescope.llm import exact_dedup, mixing


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text)


@pytest.mark.parametrize("table_bytes", [300, 32 << 20])
def test_exact_dedup(messy, plain, table_bytes):
    got = exact_dedup.deduplicate(messy, table_bytes=table_bytes).collect()
    groups = defaultdict(list)
    for d, t, _ in plain:
        groups[norm(t)].append(d)
    want = Counter()
    for t, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        digest = hashlib.sha256(t.encode()).hexdigest()
        for d in ids:
            want[d, keep, len(ids), digest] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_table_compares_contents():
    table = exact_dedup.ContentTable()
    numbers = [table.add(i % 3, f"t{i % 700}")[0] for i in range(2100)]
    assert len(set(zip(numbers, (f"t{i % 700}" for i in range(2100))))) == len(set(
        (i % 3, i % 700) for i in range(2100)))
    first, fresh = table.add(-5, "same")
    assert fresh and table.add(-5, "other")[0] != first and table.add(-5, "same") == (first, False)


def test_buckets_are_dealt_until_they_fit(spark):
    heavy = [(1 << 62, 10)] * 50 + [((1 << 62) + (i << 45), 10) for i in range(60)]
    rows = spark.createDataFrame(heavy + [(-i * 10**16, 10) for i in range(200)], "hash long, bytes long")
    first, again = exact_dedup.bucket_of(rows, table_bytes=200)
    assert len(again) > 1
    dealt = rows.withColumn("bucket", exact_dedup.bucket_column(first, again)).groupBy("bucket").agg(
        {"bytes": "sum", "hash": "min"}).collect()
    sizes = {r["bucket"]: r["sum(bytes)"] for r in dealt}
    assert max(sizes.values()) <= 510  # one hash alone, and what is next to it


def fixpoint(sizes, share=1.5, most=2.0):
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, target, open_ = share * sum(sizes.values()), {}, set(sizes)
    while open_:
        w = sum(weights[s] for s in open_)
        above = [s for s in open_ if left * weights[s] / w > most * sizes[s]]
        if not above:
            return target | {s: left * weights[s] / w for s in open_}
        for s in above:
            target[s] = most * sizes[s]
        open_ -= set(above)
        left = share * sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("block_docs", [4, 4096])
def test_mixing(messy, plain, block_docs):
    got = mixing.mix(messy, block_docs=block_docs).collect()
    words = [(d, len(re.findall(r"[^\x20\x09-\x0D]+", t)), s) for d, t, s in plain]
    sizes = defaultdict(int)
    for _, n, s in words:
        sizes[s] += n
    assert Counter((r.doc_id, r["size"], r.source) for r in got) == Counter(words)
    want, taken, largest = fixpoint(sizes), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r["size"] and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(largest[s], 1)
    again = mixing.mix(messy, block_docs=block_docs).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in again) == Counter(
        (r.doc_id, r["size"], r.taken) for r in got)


def test_flight_keeps_balance():
    random = np.random.default_rng(1)
    chance, sizes = np.full(3000, 0.37), random.integers(1, 5000, 3000).astype(float)
    out = mixing.flight(chance, sizes)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(chance.sum(), abs=1e-3)
    assert out @ sizes == pytest.approx(chance @ sizes, rel=1e-6)


def test_empty_tables(nothing):
    assert exact_dedup.deduplicate(nothing).count() == 0
    assert mixing.mix(nothing).count() == 0


def test_many_equal_rows_are_spread_over_flights(spark):
    from tonescope.session import collected_folders
    rows = [(7, "a few words", "s0")] * 3000 + [(i, "w " * (i % 9 + 1), "s0") for i in range(100, 400)]
    rows += [(None, None, None)] * 50
    draw, found = random.Random(2), []
    for parts in (2, 5):
        draw.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        with collected_folders() as folders:
            got = mixing.mix(docs, block_docs=64)
        blocks = spark.read.parquet(f"{folders[0]}/flight0").groupBy("source", "block").count()
        assert blocks.agg({"count": "max"}).first()[0] <= 3 * 64 and blocks.count() >= 40
        found.append(Counter((r.doc_id, r["size"], r.taken) for r in got.collect()))
        target, = {r.target for r in got.collect() if r.source == "s0"}
        taken = sum(k[2] * n for k, n in found[-1].items())
        assert abs(taken - target) <= 10
    assert found[0] == found[1]
