import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from test_lm_and_jaccard import brute_components
from tonescope.llm import licenses, minhash
from tonescope.llm.words import WordHasher, shingles


def brute_print(hasher, text):
    """The least value of every function, one function and text at a time."""
    values, _ = shingles(*WordHasher(True).words(pa.array([text])), hasher.k)
    if not len(values):
        return [0xFFFFFFFF] * len(hasher.a)
    return [min((int(v) * int(a) + int(b)) % 2**64 >> 32 for v in values)
            for a, b in zip(hasher.a, hasher.b)]


def test_fingerprints(messy, plain):
    permutations = 8
    hasher = minhash.Hasher(5, permutations)
    rows = sorted(((d is not None, d or 0, t) for d, t, _ in plain))
    want = Counter()
    for i, (has_id, d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][2]
        quarter = len(t) // 4
        edited = t[:len(t) - quarter] + following[:quarter]
        own, other, after = (brute_print(hasher, x) for x in (t, edited, following))
        near = [sum(a == b for a, b in zip(own, x)) / permutations for x in (other, after)]
        want[(d if has_id else None, len(t), hashlib.sha256(edited.encode()).hexdigest(),
              "".join(f"{v:08x}" for v in own), "".join(f"{v:08x}" for v in other), *near)] += 1
    got = Counter(map(tuple, minhash.fingerprint(messy, permutations=permutations).collect()))
    assert got == want


def test_ids_that_no_double_tells_apart(spark):
    big = 1 << 60
    texts = {big + 2: "c c c c", big: "a a a a", big + 1: "b b b b"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    got = {r.doc_id: r.edited_sha256 for r in minhash.fingerprint(docs, permutations=4).collect()}
    after = {big: "b", big + 1: "c", big + 2: "a"}
    assert got == {d: hashlib.sha256((t[:5] + (t[5:6] + t[6:7])[:1] + after[d]).encode()).hexdigest()
                   for d, t in texts.items()}


def test_estimate_is_near_the_similarity():
    line = [f"w{i}" for i in range(400)]
    other = line[:200] + [f"v{i}" for i in range(200)]
    prints = minhash.Hasher(5, 512).fingerprints(pa.array([" ".join(line), " ".join(other)]))
    assert (prints[0] == prints[1]).mean() == pytest.approx(196 / (2 * 396 - 196), abs=0.07)


def test_near_pairs(messy, plain):
    want = brute_components([(d, t) for d, t, _ in plain], 5, 80)
    got = Counter((r.doc_id, r.class_id) for r in minhash.near_pairs(messy).collect())
    assert got == Counter({k: sum(n for (d, _, c), n in want.items() if (d, c) == k)
                           for k in {(d, c) for d, _, c in want}})


NOTICES = list(licenses.TEMPLATES.values())


@pytest.fixture(scope="module")
def noticed(spark, messy):
    rows = [(1000 + i, t) for i, t in enumerate(NOTICES)]
    rows += [(1100 + i, f"first line\n  {t.upper()}\n\nother words of a text") for i, t in enumerate(NOTICES)]
    rows += [(1200 + i, re.sub(r"\w+", "altered", t, count=1)) for i, t in enumerate(NOTICES)]
    rows += [(1300 + i, t + " and more words than the notice has " * 3) for i, t in enumerate(NOTICES)]
    rows += [(1400, NOTICES[0]), (1400, NOTICES[0]), (None, NOTICES[1]), (1401, "\n\n\n"), (1402, "MIT"),
             (1403, NOTICES[2].replace(" ", " ")), (1404, NOTICES[3].replace(" ", ".\r\n\t"))]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    return messy.selectExpr("doc_id", "text", "row as line", "class as unit", "row as pairs").unionByName(
        extra.selectExpr("doc_id", "text", "0L as line", "'' as unit", "0L as pairs"))


def test_licences_equal_sql(noticed):
    documents = noticed.select("doc_id", "text").toPandas()  # noqa: F841 (read by the SQL)
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    rows = con.execute(licenses.scan_sql()).fetchall()
    # The SQL takes one row of an id and line; the scan takes one per row of the table.
    want = {(d, line, name, round(dice, 9)) for d, line, name, dice in rows}
    got = Counter((r.doc_id, r.line, r.license, round(r.dice, 9))
                  for r in licenses.scan(noticed).collect())
    assert set(got) == want
    assert {n for k, n in got.items() if k[0] == 1400} == {2}
    assert {d for d, *_ in got} >= {1000 + i for i in range(len(NOTICES))} | {
        1100 + i for i in range(len(NOTICES))}


def test_size_bounds_lose_nothing(spark):
    """The first words of a template, or words around it, that give a Dice of just 0.8."""
    words = [f"w{i}" for i in range(7)]
    docs = spark.createDataFrame([(1, " ".join(words[:5])), (2, " ".join(words)), (
        3, " ".join(words + ["x", "y", "z"])), (4, " ".join(words[:4]))], "doc_id long, text string")
    got = {(r.doc_id, r.dice) for r in licenses.scan(docs, {"six pairs": " ".join(words)}).collect()}
    assert got == {(1, 0.8), (2, 1.0), (3, 0.8)}


def test_empty_tables(nothing):
    assert minhash.fingerprint(nothing).count() == 0
    assert minhash.near_pairs(nothing).count() == 0
    assert licenses.scan(nothing).count() == 0


def test_single_row(spark):
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    (row,) = minhash.fingerprint(docs).collect()
    assert row.near_next == 1.0 and row.n_chars == 27
    assert np.isfinite(row.near_edited)
