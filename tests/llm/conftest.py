import random

import pytest

WORDS = ["alpha", "Beta", "gamma", "déjà", "vu", "of", "the", "one", "two", "a", "b", "日本"]


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and clashing columns."""
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choices(WORDS, k=draw.randint(1, 60))), f"s{i % 3}")
            for i in range(60)]
    base = [draw.choice(WORDS) + str(draw.randint(0, 400)) for _ in range(80)]
    rows += [(100 + i, " ".join(base[:70] + [f"x{i}"] + base[71:]), "s0") for i in range(12)]
    rows += [(200, rows[3][1], None), (201, rows[3][1].replace(" ", "\t \n"), None), (5, "again", "s1"),
             (5, "again", "s1"), (7, None, "s2"), (300, None, "s2"), (301, "", "s9"),
             (302, " \n\t ", "s9"), (None, "no id", "s1"), (None, None, None), (303, "one", None),
             (304, "one two", ""), (305, " ".join(draw.choices(WORDS, k=30_000)), "s0"),
             (306, "x" * 50_000, "s0"), (307, "a  \n b  c   d", "s0"), (9, "<|endoftext|> x", "s1")]
    draw.shuffle(rows)
    full = [(d, t, s, "en", 1, "c", d, 0, t) for d, t, s in rows]
    schema = ("doc_id long, text string, source string, lang string, row long, class string, "
              "node long, chunk long, content string")
    return spark.createDataFrame(full, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("false")


@pytest.fixture(scope="session")
def plain(messy):
    """The same as (doc_id, text or "", source)."""
    return [(r.doc_id, r.text or "", r.source) for r in messy.collect()]
