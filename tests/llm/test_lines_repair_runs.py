import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tonescope.llm import conversation_repair, line_dedup, periodic_runs
from tonescope.llm.conversation_repair import Search

SPACES = " \t\n\x0b\x0c\r"


def lowered(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACES))


def without_shared(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in text.split("\n"):
            holders[lowered(line)].add(doc)
    shared = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in holders.items()
              if len(k) >= min_chars and len(v) >= min_docs}
    out = Counter()
    for doc, text in rows:
        lines = text.split("\n")
        kept = [x for x in lines if shared.get(lowered(x), doc) == doc]
        out[doc, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


@pytest.mark.parametrize("min_chars,min_docs", [(1, 1), (3, 2), (12, 5), (0, 3)])
def test_line_dedup(spark, min_chars, min_docs):
    draw = random.Random(min_docs)
    lines = ["", " ", "The same Line\r", "\tthe SAME line ", "THE SAME LINE", "Écrit ÀÉ déjà vu là",
             "écrit Àé déjà vu là", "twelve chars", "short", "x" * 30_000, " the same line"]
    rows = [(draw.choice([i, i, 7, None]), draw.choice([None, "\n".join(
        draw.choices(lines, k=draw.randint(0, 8)))] * 4)) for i in range(60)]
    rows += [(1000 + i, "the same line\nonly here %d" % i) for i in range(40)]
    clashing = spark.createDataFrame([(d, t, 1, 2, "l", "k") for d, t in rows],
                                     "doc_id long, text string, h1 long, lost int, line string, key string")
    got = line_dedup.drop_shared_lines(clashing.repartition(3), min_chars, min_docs)
    want = without_shared([(d, t or "") for d, t in rows], min_chars, min_docs)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_no_lines(nothing):
    assert line_dedup.drop_shared_lines(nothing).collect() == []


def test_lines_are_counted_before_they_meet(messy):
    plan = line_dedup.shared_lines(line_dedup.line_keys(messy.select(
        "doc_id", "text", F.lit(1).alias("t1"), F.lit(2).alias("t2")), 1), 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_count") == 1 and "Exchange hashpartitioning(h1" in text
    assert not any(slow in text for slow in ("Python", "Arrow", "Window"))


def cheapest(initials, faults):
    """Cost and audit from the last row to the first, for every state."""
    n, following = len(initials), None
    for i in range(n, -1, -1):
        here = []
        for state in range(4):
            ways = [(0, "")] if i == n and state in (0, 3) else []
            if i < n:
                ways.append((4 + following[state][0], "D" + following[state][1]))
                if faults[i] != 1:
                    cut, to = (3 if faults[i] == 2 else 0), 3 if state == 2 else 2
                    fits = {"s": state == 0, "u": state != 2, "a": state == 2}.get(initials[i])
                    if fits:
                        then = following[1 if initials[i] == "s" else to]
                        ways.append((cut + then[0], "K" + then[1]))
                    ways.append((cut + 3 + following[to][0], "R" + following[to][1]))
            here.append(min(ways, default=(10**9, "")))
        for _ in range(4):
            here = [min(here[q], (3 + here[o][0], "I" + here[o][1]))
                    for q, o in enumerate((2, 2, 3, 2))]
        following = here
    return following[0]


def test_search_finds_the_cheapest_and_first():
    draw = random.Random(5)
    for _ in range(5000):
        n = draw.randint(0, 12)
        initials = "".join(draw.choices("suauaua?", k=n))
        faults = bytes(draw.choices([0, 0, 0, 1, 2], k=n))
        assert Search(initials, faults).run() == cheapest(initials, faults)


def test_search_of_a_long_conversation():
    draw = random.Random(6)
    initials = "".join(draw.choices("sua", k=30_000))
    faults = bytes(draw.choices([0, 0, 0, 1, 2], k=30_000))
    search = Search(initials, faults)
    cost, audit = search.run()
    assert (cost, audit) == cheapest(initials[:30_000], faults) and len(search.failed) < 1000


def test_bounds_rise_and_failed_states_are_kept():
    search = Search("uausaua", bytes(7))
    assert search._at_least(0, 0) == 0
    assert search.run() == cheapest("uausaua", bytes(7)) and search.failed[0, 0] > 0


def repaired(rows):
    """Figures, audit and repaired turns of one conversation's (turn, role, text), in order."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, counts, faults, letters = set(), [0, 0, 0], [], []
    for _, role, text in rows:
        shown, fault = text.rstrip(SPACES), 0
        kind = (0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else None)
        if kind is not None:
            counts[kind], fault = counts[kind] + 1, 2 if kind == 2 else 1
        seen.add((role, text))
        faults.append(fault)
        letters.append(role[:1] if role[:1] in ("s", "u", "a") else "?")
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au")
                  for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = cheapest("".join(letters), faults)
    turns, left, last = [], list(rows), ""
    for edit in audit:
        role, text = left.pop(0)[1:] if edit != "I" else (None, "")
        if edit != "D":
            role = role if edit == "K" else "assistant" if last == "u" else "user"
            turns.append((role, text))
            last = role[0]
    known = {t for t, _, _ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    return (gaps, *counts, illegal, cost, audit), turns


def harmed(rows):
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        c = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        if c:
            role, text = ("user" if c == 4 else shown[2]), shown[3]
            text = "" if c == 1 else re.sub("[.!?]", "", text) if c == 2 else text
            yield from [(conv, turn, role, text)] * (2 if c == 3 else 1)


@pytest.fixture(scope="module")
def talks(spark):
    draw = random.Random(8)
    texts = ["Yes.", "No?", "Well", "", None, " \n", "Long. " * 9000, "Fin!\t", "é ", "Yes. "]
    roles = ["user", "assistant", "system", None, "tool", "", "assistant", "user", "User"]
    rows = [(draw.choice([i // 6, None if i % 50 == 0 else i // 6]),
             draw.choice([i % 6, i % 6, i % 6, 3, None, 40]), draw.choice(roles), draw.choice(texts))
            for i in range(600)]
    rows += [(900, t, "user" if t % 2 else "assistant", f"Turn {t % 40}.") for t in range(3000)]
    rows += [(d, 0, "user", "Hello.") for d in range(1000, 1100)]  # some lose their only row
    draw.shuffle(rows)
    full = [(*r, "x", 1, 2) for r in rows]
    ddl = "conv_id long, turn long, role string, text string, audit string, part int, copy int"
    return rows, spark.createDataFrame(full, ddl).repartition(4)


def test_repair(talks):
    rows, frame = talks
    want, groups = {}, defaultdict(list)
    for conv, *row in harmed(rows):
        groups[conv].append(row)
    for conv in {r[0] for r in rows}:
        figures, turns = repaired(groups[conv]) if conv in groups else ((0,) * 6 + ("",), [])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in turns))
        written = "\n".join(f"{r}:{t}" for r, t in turns)
        want[conv] = (*figures, hashlib.sha256(written.encode()).hexdigest())
    got = conversation_repair.repaired_digests(frame).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == want and len(got) == len(want)
    assert any(conv not in groups for conv in want)


def test_repaired_turns_of_sound_and_null_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (None, 0, "assistant", "Well.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = conversation_repair.audits(frame)
    assert {(r.conv_id, r.cost, r.audit) for r in found.collect()} == {(1, 0, "KK"), (None, 3, "IK")}
    turns = conversation_repair.repaired_turns(frame, found).collect()
    assert sorted(map(tuple, turns), key=repr) == sorted(
        [(1, 0, "K", 0, "user", "Hi."), (1, 1, "K", 1, "assistant", "Hello."),
         (None, 0, "I", None, "user", ""), (None, 1, "K", 0, "assistant", "Well.")], key=repr)


def test_no_conversations(talks):
    none = talks[1].where("false")
    assert conversation_repair.repaired_digests(none).collect() == []
    assert conversation_repair.audits(none).collect() == []


def runs_of_words(words):
    """Every run and the words left, by looking at every period and place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and words[k] == words[k + q]:
                k += 1
            if k + q - i >= max(6, 4 * q):
                found.setdefault((i, k + q), q)
            i = k + 1
    runs = sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return runs, " ".join(w for i, w in enumerate(words) if i not in gone)


def nested(draw, alphabet, depth):
    if depth == 0 or draw.random() < 0.3:
        return draw.choices(alphabet, k=draw.randint(0, 6))
    return (nested(draw, alphabet, depth - 1) * draw.randint(1, 7)
            + nested(draw, alphabet, depth - 1))[:400]


@pytest.mark.parametrize("strides,points", [(2, 7), (48, 1 << 19)])
def test_runs_equal_brute_force(monkeypatch, strides, points):
    monkeypatch.setattr(periodic_runs, "STRIDES", strides)
    monkeypatch.setattr(periodic_runs, "POINTS", points)
    draw = random.Random(strides)
    for _ in range(100):
        lists = [nested(draw, ["a", "b", "É", "d"][:draw.randint(1, 4)], 4)
                 for _ in range(draw.randint(1, 6))]
        texts = [draw.choice(["", " \t"]) + draw.choice([" ", "\n\x0b"]).join(x) for x in lists]
        counted, runs, left = periodic_runs.runs_of(pa.array([*texts, None]))
        for words, n, found, rest in zip([*lists, []], counted.to_pylist(), runs.to_pylist(),
                                         left.to_pylist(), strict=True):
            told = [(r["start"], r["length"], r["period"]) for r in found]
            assert (n, told, rest) == (len(words), *runs_of_words(words))


def test_extensions_of_any_two_places():
    draw = np.random.default_rng(2)
    for kinds in (1, 2, 3, 30):
        words = draw.integers(0, kinds, 300).astype(np.int32)
        words[100:200] = words[:100]
        sequence = np.concatenate([[kinds], words, [kinds + 1]]).astype(np.int32)
        grammar = periodic_runs.Grammar(sequence, kinds)
        a, b = draw.integers(1, 301, (2, 400))
        a, b = a[a != b], b[a != b]
        for way in (1, -1):
            def agree(x, y):
                k = 0
                while sequence[x + way * k] == sequence[y + way * k]:
                    k += 1
                return k
            assert grammar.extend(a, b, way).tolist() == [agree(x, y) for x, y in zip(
                a.tolist(), b.tolist(), strict=True)]


def test_find_runs_on_messy_documents(spark, messy, plain, monkeypatch):
    rows = [(1, "no no no no no no stop " * 3), (2, "a b c " * 5000), (3, "tick tock " * 4), (4, "x " * 5)]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    both = messy.unionByName(more, allowMissingColumns=True).withColumn("runs", F.lit(1))
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed)
                  for r in periodic_runs.find_runs(both).collect())
    want = Counter()
    for doc, text, _ in [*plain, *((d, t, None) for d, t in rows)]:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        runs, left = (([(0, 15_000, 3)], "a b c") if doc == 2 and len(words) == 15_000
                      else runs_of_words(words) if len(words) < 2000 else (None, None))
        if runs is None:  # random words
            runs, left = next((list(k[2]), k[3]) for k in got if k[:2] == (doc, len(words)))
        want[doc, len(words), tuple(runs), left] += 1
    assert got == want


def test_no_documents_no_runs(nothing):
    assert periodic_runs.find_runs(periodic_runs.with_planted_runs(nothing)).collect() == []


def test_planted_runs_are_those_of_the_contract(messy, plain):
    want = Counter()
    for doc, text, _ in plain:
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        h, n = zlib.crc32(str(doc).encode()), len(words)
        if doc is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = " ".join(words[i if i < a else a + (i - a) % p] for i in range(n))
        want[doc, text] += 1
    got = Counter((r.doc_id, r.text or "") for r in periodic_runs.with_planted_runs(messy).collect())
    assert got == want


def test_strongest_run_by_exact_ratio(spark):
    kind = "runs array<struct<start: long, length: long, period: long>>"
    first = [(0, 41, 10), (3, 8, 2), (9, 41, 10)]
    rows = spark.createDataFrame([(first + [(20, 40999999, 10**7)],), (first + [(20, 41000001, 10**7)],),
                                  ([],)], kind).coalesce(1)
    found = [r[0] for r in rows.select(periodic_runs.strongest(F.col("runs"))).collect()]
    assert [f and tuple(f) for f in found] == [(0, 41, 10), (20, 41000001, 10**7), None]


@pytest.mark.parametrize("name", ["op11_line_dedup", "op12_conversation_repair", "op13_periodic_runs"])
def test_query_equals_sql(spark, name):
    import __spark_entry__ as entry
    from verification.compare import mismatch, oracle_frame
    folder = "/root/testdata/sf0.001"
    result = entry.queries()[name](spark, folder).toPandas()
    assert len(result) > 0
    assert mismatch(result, oracle_frame(folder, entry.oracle_sql()[name])) is None
