import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from test_dedup_and_mixing import fixpoint, norm
from test_lm_and_jaccard import brute_components
from pyspark.sql import functions as F
from tonescope.llm import quality

GOOD = "the river runs under old stone bridges while people walk slowly home".split()


@pytest.fixture(scope="module")
def labelled(spark):
    """Prose of label 1, junk of label 0, and rows that a fit has to stand."""
    draw = random.Random(11)
    rows, labels = [], []
    for i in range(240):
        good = i % 2
        text = (" ".join(draw.choices(GOOD, k=draw.randint(20, 60))).capitalize() + "." if good else
                " ".join("".join(draw.choices("#$%0123xQZ", k=6)) for _ in range(draw.randint(20, 60))))
        rows.append((i, text))
        labels.append((i, good, 0))
    rows += [(500, None), (501, ""), (None, "nobody"), (502, GOOD[0]), (3, rows[3][1]),
             (503, "x" * 30_000)]
    labels += [(7, 0, 0), (500, 1, 1), (None, 1, 0), (9999, 1, 0), (11, None, 0)]
    docs = spark.createDataFrame([(d, t, d, 1.0) for d, t in rows],
                                 "doc_id long, text string, score long, predicted double")
    return docs.repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def held(d):
    return zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 0


def test_votes_equal_plain_neighbours(labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels)
    assert len(model.labels) and 7 not in {r[0] for r in labels.where("quality is null").collect()}
    texts = [r.text for r in docs.collect()]
    import pyarrow as pa
    features = quality.Features()(pa.array(texts, pa.string()))
    got = model.score(features)
    ones = model.labels.mean()
    for x, score in zip(features, got):
        at = ((x - model.mean) / model.scale) @ model.basis
        at = at / max(np.linalg.norm(at), 1e-9)
        near = sorted(((float(v @ at), int(l)) for v, l in zip(model.vectors, model.labels)),
                      key=lambda p: -p[0])[:quality.NEIGHBOURS]
        weights = [(max(s, 0) ** 4 * (model.prior / ones if l else (1 - model.prior) / (1 - ones)), l)
                   for s, l in near]
        total = sum(w for w, _ in weights)
        want = sum(w * l for w, l in weights) / total if total > 1e-12 else model.prior
        assert score == pytest.approx(want, abs=1e-3)


def test_held_out_rows(labelled):
    docs, labels = labelled
    got = quality.classify(docs, quality.fit(docs, labels)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 240]
    assert len(unseen) > 20
    assert np.mean([r.predicted == r.doc_id % 2 for r in unseen]) > 0.95


def test_held_out_labels_are_not_read(labelled):
    """Turning every held-out label over changes no score."""
    docs, labels = labelled
    turned = labels.selectExpr("doc_id", "case when pmod(crc32(cast(coalesce(string(doc_id), '') as "
                               "binary)), 5) = 0 then 1 - quality else quality end as quality")
    # Shares of the classes are of training rows alone, too.
    a, b = (sorted(map(tuple, quality.classify(docs, quality.fit(docs, x)).collect()), key=repr)
            for x in (labels, turned))
    assert a == b


def test_nothing_to_learn_from(labelled):
    docs, labels = labelled
    got = quality.classify(docs, quality.fit(docs, labels.where("false"))).collect()
    assert {r.score for r in got} == {0.5} and len(got) == docs.count()
    model = quality.fit(docs, labels)
    assert quality.classify(docs.where("false"), model).count() == 0
    assert quality.accepted(docs.where("false"), model).count() == 0


@pytest.fixture(scope="module")
def corpus(spark, messy, labelled, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    some = messy.selectExpr("doc_id", "text", "lang", "source", "length(text) as n_chars", "row")
    more = labelled[0].where("doc_id < 60").selectExpr(
        "doc_id + 1000 as doc_id", "text", "'en' as lang", "'s1' as source", "1 as n_chars", "0L as row")
    some.unionByName(more).write.parquet(f"{folder}/documents.parquet")
    labels = labelled[1].where("doc_id < 60").selectExpr("doc_id + 1000 as doc_id", "quality", "toxic")
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def rows_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_every_stage(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    tables = {"documents": docs}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, corpus).write.parquet(str(tmp_path / name))
        before = tables[name] = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert before.columns == corpus_pipeline.COLUMNS

    model = quality.fit(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    import pyarrow as pa
    given = rows_of(docs)
    scores = model.score(quality.Features()(pa.array([t for _, t, _ in given], pa.string())))
    want = Counter(r for r, s in zip(given, np.round(scores, 9)) if s >= 0.3)
    good = rows_of(tables["quality"])
    assert Counter(good) == want and 0 < len(good) < len(given)

    single = rows_of(tables["exact_dedup"])
    groups = defaultdict(list)
    for d, t, _ in good:
        groups[norm(t or "")].append(d)
    assert Counter((norm(t or ""), d) for d, t, _ in single) == Counter(
        (t, min((d for d in ids if d is not None), default=None)) for t, ids in groups.items())

    apart = rows_of(tables["near_dedup"])
    # Rows by number, as ids repeat. Of every group one row stays.
    classes = brute_components([(i, t or "") for i, (_, t, _) in enumerate(single)], 5, 80)
    assert Counter(apart) <= Counter(single)
    assert len(apart) == len({c for _, _, c in classes}) < len(single)

    copies = Counter(rows_of(tables["mixing"]))
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for row in apart:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
        sizes[row[2]] += n
        taken[row[2]] += n * copies[row]
        largest[row[2]] = max(largest[row[2]], n)
        assert copies[row] <= 2
    assert set(copies) <= set(apart)
    for source, target in fixpoint(sizes).items():
        assert abs(taken[source] - target) <= max(largest[source], 1)

    pieces = tables["packing"].collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(
        d for (d, _, _), n in copies.items() for _ in range(n))
    ends = defaultdict(list)
    for p in pieces:
        ends[p.sequence_id].append((p.offset, p.length))
    for parts in ends.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_every_stage_of_nothing(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, corpus).write.parquet(str(tmp_path / name))
        found = spark.read.parquet(str(tmp_path / name))
        assert found.count() == 0
        if name != "packing":
            assert found.columns == corpus_pipeline.COLUMNS


def test_a_mixture_does_not_depend_on_the_layout(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    found = []
    for parts in (1, 5):
        dealt = docs.repartition(parts).withColumn("part", F.lit(1))
        found.append(Counter(rows_of(corpus_pipeline.mixed(spark, dealt, corpus))))
    assert found[0] == found[1]


def test_work_folders_go_with_the_next_stage(spark, corpus, tmp_path):
    import os
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    corpus_pipeline.without_copies(spark, docs, corpus).write.parquet(str(tmp_path / "one"))
    used, = corpus_pipeline._left_over.values()
    assert used and all(os.path.exists(folder) for folder in used)
    lazy = corpus_pipeline.mixed(spark, spark.read.parquet(str(tmp_path / "one")), corpus)
    assert not any(os.path.exists(folder) for folder in used)
    # What is not written yet keeps what it reads.
    assert corpus_pipeline.mixed(spark, lazy, corpus).count() > 0
