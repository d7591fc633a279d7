"""Operator 13, periodic runs of words, by recompression.

A task lays the words of some texts behind one another, with a mark of its own between two texts, and
compresses the sequence level by level: blocks of one symbol become a symbol, then pairs of a left and
a right symbol do, for a random split of the alphabet. Equal stretches are compressed alike except for
a symbol at each of their ends and level, so the longest common extension of two positions is found
by walking up the levels while both agree and down again where they differ, with at most one step per
level. Symbols are numbered exactly (no hashes).

A run with period q and four periods contains four neighbouring points of the grid of step q. Points
with equal words are candidates; extensions to both sides give the run that each belongs to.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of texts that are laid behind one another, unless a single text is longer.
STEP_BYTES = 4 << 20
#: Grid points looked at, and candidates extended, at a time.
POINTS = 1 << 19
#: Periods below go through the grid in strides, others together.
STRIDES = 48


def _numbered(keys: np.ndarray) -> np.ndarray:
    """Equal keys get equal numbers, from 0 in the order of their first occurrence."""
    import pyarrow as pa
    return pa.array(keys).dictionary_encode().indices.to_numpy()


class Grammar:
    """The levels over a sequence of symbols; those from ``marks`` up occur once and join no pair.

    ``symbols[l]`` is the sequence of level l. Of its symbol x, ``parents[l][x]`` is the place in level
    l + 1, and of that symbol y, ``firsts[l][y]`` is the place of its first part in level l.
    """

    def __init__(self, sequence: np.ndarray, marks: int):
        self.symbols = [sequence]
        self.parents: list[np.ndarray] = []
        self.firsts: list[np.ndarray] = []
        self.blocks: list[bool] = []
        draw = np.random.default_rng(len(sequence))
        after = end = int(sequence.max(initial=marks - 1)) + 1
        # Marks stay as they are, so the last level is that where each text is a symbol.
        while True:
            top = self.symbols[-1]
            same = top[1:] == top[:-1]
            if same.any():
                after = self._block(top, same, after)
                top = self.symbols[-1]
            inside = (top < marks) | (top >= end)
            if not (inside[1:] & inside[:-1]).any():
                break
            # One side per symbol. An even split joins a quarter of all neighbours on average.
            left = draw.integers(0, 2, after, np.int8).astype(bool)[top]
            here = left[:-1] & ~left[1:] & inside[:-1] & inside[1:]
            there = ~left[:-1] & left[1:] & inside[:-1] & inside[1:]
            joins = here if here.sum() >= there.sum() else there
            if joins.any():
                after = self._pair(top, joins, after)

    def _level(self, starts: np.ndarray, parents: np.ndarray, symbols: np.ndarray, size: int,
               block: bool) -> None:
        self.firsts.append(np.append(starts, size).astype(np.int32))
        self.parents.append(parents.astype(np.int32))
        self.symbols.append(symbols)
        self.blocks.append(block)

    def _block(self, top: np.ndarray, same: np.ndarray, after: int) -> int:
        fresh = np.concatenate([[True], ~same])
        starts = np.flatnonzero(fresh)
        lengths = np.diff(np.append(starts, len(top)))
        symbols = top[starts]
        long = np.flatnonzero(lengths > 1)
        names = _numbered(symbols[long].astype(np.int64) * (len(top) + 1) + lengths[long])
        symbols[long] = after + names
        self._level(starts, np.cumsum(fresh) - 1, symbols, len(top), True)
        return after + int(names.max(initial=-1)) + 1

    def _pair(self, top: np.ndarray, joins: np.ndarray, after: int) -> int:
        fresh = np.concatenate([[True], ~joins])
        starts = np.flatnonzero(fresh)
        symbols = top[starts]
        pairs = np.flatnonzero(joins)
        parents = np.cumsum(fresh) - 1
        names = _numbered(top[pairs].astype(np.int64) * after + top[pairs + 1])
        symbols[parents[pairs]] = after + names
        self._level(starts, parents, symbols, len(top), False)
        return after + int(names.max(initial=-1)) + 1

    def extend(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """For places a[i] != b[i], how many symbols agree from them on, to the right (``way`` 1) or
        to the left (-1), both places included."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        stopped = np.full(len(x), len(self.parents))
        rows = np.arange(len(x))
        for level, (parents, firsts) in enumerate(zip(self.parents, self.firsts, strict=True)):
            symbols = self.symbols[level]
            agree = symbols[x[rows]] == symbols[y[rows]]
            stopped[rows[~agree]] = level
            rows = rows[agree]
            if not len(rows):
                break
            x_left, y_left = (self._left(firsts, parents, at[rows], way) for at in (x, y))
            x_whole, y_whole = (self._left(firsts, parents, at[rows], -way) == 1 for at in (x, y))
            # Inside a block or pair: finish what both have of it. At its start: let it be.
            inside = ~(x_whole & y_whole)
            if self.blocks[level]:
                step = np.where(inside, np.minimum(x_left, y_left), 0)
                uneven = inside & (x_left != y_left)
            else:
                step, uneven = inside.astype(np.int64), np.zeros(len(rows), bool)
            x[rows] += way * step
            y[rows] += way * step
            stopped[rows[uneven]] = level
            rows = rows[~uneven]
            x[rows], y[rows] = parents[x[rows]], parents[y[rows]]
        while len(rows):
            symbols = self.symbols[-1]
            rows = rows[symbols[x[rows]] == symbols[y[rows]]]
            x[rows] += way
            y[rows] += way
        for level in range(len(self.parents) - 1, -1, -1):
            symbols, firsts = self.symbols[level], self.firsts[level]
            rows = np.flatnonzero(stopped > level)
            if not len(rows):
                continue
            u, v = x[rows], y[rows]
            sizes = [firsts[at + 1] - firsts[at] for at in (u, v)]
            u, v = (firsts[at] if way > 0 else firsts[at + 1] - 1 for at in (u, v))
            step = np.minimum(*sizes) if self.blocks[level] else 1
            step = way * np.where(symbols[u] == symbols[v], step, 0)
            x[rows], y[rows] = u + step, v + step
        return way * (x - a)

    @staticmethod
    def _left(firsts: np.ndarray, parents: np.ndarray, at: np.ndarray, way: int) -> np.ndarray:
        """How many parts of its parent there are from a place on, itself included."""
        parent = parents[at]
        return firsts[parent + 1] - at if way > 0 else at - firsts[parent] + 1


def grid_points(sequence: np.ndarray, lengths: np.ndarray, ends: np.ndarray,
                points: int = POINTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods q of four neighbouring points of a grid with equal words, and equal words
    behind the first three. ``lengths`` of the texts descend, ``ends`` are where they end."""
    def reach(q):
        """The end of the last text with four periods."""
        texts = np.searchsorted(-lengths, -np.maximum(6, 4 * q), "right")
        return np.where(texts > 0, ends[np.maximum(texts, 1) - 1], 0)

    def checked(at, q):
        if len(at) and q.max() == 1:
            ok = (sequence[at] == sequence[at + 4]) & (sequence[at] == sequence[at + 5])
        else:
            # A text's last grid point may be its end: there, the word behind is its mark.
            ok = ((sequence[at + 1] == sequence[at + 1 + q])
                  & (sequence[at + 1] == sequence[at + 1 + 2 * q]))
        return at[ok], q[ok]

    longest = int(lengths.max(initial=0)) // 4
    for q in range(1, min(longest, STRIDES) + 1 if len(lengths) else 0):
        grid = sequence[:int(reach(np.array([q]))[0]):q]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q if len(same) > 2 else same[:0]
        at = at.astype(np.int64)
        if q == 1:
            at = at[at + 5 < len(sequence)]
        yield checked(at, np.full(len(at), q))
    periods = np.arange(STRIDES + 1, longest + 1)
    counts = np.maximum((reach(periods) - 1 - 3 * periods) // periods + 1, 0) if len(periods) else periods
    before = np.concatenate([[0], np.cumsum(counts)])
    total = int(before[-1])
    for start in range(0, total, points):
        # Numbers from start on, as (period, place on its grid).
        number = np.arange(start, min(start + points, total))
        of = np.searchsorted(before, number, "right") - 1
        q = periods[of]
        at = (number - before[of]) * q
        for i in range(3):
            ok = np.flatnonzero(sequence[at + i * q] == sequence[at + (i + 1) * q])
            at, q = at[ok], q[ok]
        yield checked(at, q)


def find_in(sequence: np.ndarray, marks: int, lengths: np.ndarray, ends: np.ndarray,
            points: int = POINTS) -> np.ndarray:
    """Start, end (excluded) and smallest period of every run in the sequence, by start and period."""
    grammar, found, waiting, held = None, [np.empty((0, 3), np.int64)], [], 0

    def extended() -> None:
        at, q = (np.concatenate(x) for x in zip(*waiting, strict=True))
        for low in range(0, len(at), points):
            a, p = at[low:low + points], q[low:low + points]
            start = a + 1 - grammar.extend(a, a + p, -1)
            end = a + p + grammar.extend(a, a + p, 1)
            ok = end - start >= np.maximum(6, 4 * p)
            found.append(np.unique(np.stack([start[ok], end[ok], p[ok]], 1), axis=0))
        waiting.clear()

    for at, q in grid_points(sequence, lengths, ends, points):
        if len(at):
            grammar = grammar or Grammar(sequence, marks)
            waiting.append((at, q))
            held += len(at)
        if held >= points:
            extended()
            held = 0
    if waiting:
        extended()
    runs = np.unique(np.concatenate(found), axis=0)
    # The same stretch with a multiple of its smallest period is no run.
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[smallest]
    return runs[np.lexsort([runs[:, 2], runs[:, 0]])]


def runs_of(texts) -> tuple:
    """Per text of an Arrow string array: number of words, runs (a list each), words without
    repetitions joined by spaces."""
    import pyarrow as pa
    import pyarrow.compute as pc
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(texts)
    words = parts.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    bounds = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    bounds = bounds[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
    words = words.filter(real)
    sizes = np.diff(bounds)

    coded = words.dictionary_encode()
    symbols, kinds = coded.indices.to_numpy(), len(coded.dictionary)
    order = np.argsort(-sizes, kind="stable")
    lengths = sizes[order]
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] + 1  # a mark first, and after each
    place = np.empty(len(sizes), np.int64)
    place[order] = starts
    where = np.arange(len(words)) + np.repeat(place - bounds[:-1], sizes)
    sequence = np.empty(len(words) + len(sizes) + 1, np.int32)
    marks = np.concatenate([starts - 1, [len(sequence) - 1]])
    sequence[where] = symbols
    sequence[marks] = kinds + np.arange(len(marks))

    runs = find_in(sequence, kinds, lengths, starts + lengths)
    of = order[np.searchsorted(starts, runs[:, 0], "right") - 1] if len(runs) else runs[:, 0]
    changes = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(changes, runs[:, 0] + runs[:, 2], 1)
    np.add.at(changes, runs[:, 1], -1)
    kept = np.cumsum(changes)[where] == 0

    by_text = np.argsort(of, kind="stable")
    runs, of = runs[by_text], of[by_text]
    entries = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - place[of], pa.int64()), pa.array(runs[:, 1] - runs[:, 0], pa.int64()),
         pa.array(runs[:, 2], pa.int64())], names=["start", "length", "period"])
    run_offsets = np.searchsorted(of, np.arange(len(sizes) + 1)).astype(np.int32)
    kept_bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
    left = pa.LargeListArray.from_arrays(pa.array(kept_bounds, pa.int64()),
                                         words.filter(pa.array(kept)))
    return (pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(run_offsets), entries),
            pc.binary_join(left, pa.scalar(" ", pa.large_string())))


def _slices(texts) -> Iterator[tuple[int, int]]:
    """Rows to be taken together: some bytes of text, one row at least."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if size and size + n > STEP_BYTES:
            yield start, i - start
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes) - start


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row.

    Words are the longest runs of characters other than ASCII white space. ``runs`` are the stretches
    of words, numbered from 0, with smallest period ``period`` and at least six words and four
    periods that no neighbouring word extends: structs ``start, length, period`` by start, then period.
    ``collapsed`` is the text without the words that a run repeats, those after its first period,
    joined by one space. A null or empty text has no words, and an empty ``collapsed``. Rows that share
    an id, also a null one, are treated each alone; equal texts have equal results. A very long text
    is taken whole, with memory in proportion to its words; nothing is shuffled. An empty table gives
    no rows; other columns are not read.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, size in _slices(texts):
                counted, runs, left = runs_of(texts.slice(start, size))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, size), counted, runs, left.cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, "
                                "length: long, period: long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length in periods, exactly; the first of equal ones; null of none."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(
        run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best))


def runs_text(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    return F.array_join(F.transform(runs, lambda run: F.concat(
        F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))), "")


def with_planted_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text``, where a tenth of the texts, by a hash of the id, repeat words of theirs.

    With h the CRC-32 of the decimal id, g = h // 10 and n words, for h % 10 = 0 word i from
    a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8). Rows without an id or
    without words stay as they are.
    """
    word_list = F.filter(F.split(docs[text], "[\\x20\\x09-\\x0D]+"), lambda word: word != "")
    h = F.crc32(docs[doc_id].cast("string"))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"),
                       F.floor(h / 10).alias("g"), F.when(h % 10 == 0, word_list).alias("words"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, F.pmod("g", n).cast("int")))
    rows = rows.withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int"))
    repeated = F.transform("words", lambda word, i: F.when(i < F.col("a"), word).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")))))
    changed = F.when(F.col("a").isNotNull(), F.array_join(repeated, " "))
    return rows.select("doc_id", F.coalesce(changed, "text").alias("text"))


def runs_sql() -> str:
    """The rows of ``op13_periodic_runs`` in DuckDB's SQL: every pair of equal words is looked at."""
    from .oracle_parts import WORDS, crc32_sql
    return f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS given,
                  CASE WHEN doc_id IS NOT NULL THEN {crc32_sql("CAST(doc_id AS VARCHAR)")} END AS h
           FROM documents),
e AS (SELECT *, CASE WHEN h % 10 = 0 AND len(given) > 0 THEN (h // 10) % len(given) END AS a FROM d),
f AS (SELECT *, 1 + (len(given) - a) // (3 + (h // 10) % 8) AS p FROM e),
w AS (SELECT doc_id, CASE WHEN a IS NULL THEN given ELSE list_transform(range(len(given)), lambda i:
             given[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS words FROM f),
placed AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i
       FROM w),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM placed x JOIN placed y
         ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
island AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM same),
stretch AS (SELECT doc_id, q, min(i) AS s, max(i) + 1 + q AS e FROM island GROUP BY doc_id, q, g),
runs AS (SELECT doc_id, s, e - s AS l, min(q) AS q FROM stretch WHERE e - s >= greatest(6, 4 * q)
         GROUP BY doc_id, s, e),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CAST(l AS DECIMAL(38, 18)) / q DESC,
                                      s, q) AS place FROM runs),
told AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), ''
                ORDER BY s, q) AS text FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM runs),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
              FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period,
       1000 * l // q AS exponent_milli, sha256(coalesce(told.text, '')) AS runs_sha256,
       sha256(coalesce(left_over.text, '')) AS collapsed_sha256
FROM d LEFT JOIN told ON d.doc_id = told.doc_id
LEFT JOIN best ON d.doc_id = best.doc_id AND place = 1
LEFT JOIN left_over ON d.doc_id = left_over.doc_id"""
