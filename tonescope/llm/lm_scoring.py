"""Operator 7, language-model scores by a weighted backoff automaton.

The model is a word bigram model with interpolated absolute discounting over unigrams with additive
smoothing. As an automaton: the root state has an arc for every word; every word seen in training,
and the start of a text, is a state with an arc for each of its successors, weighted with the log of
the smoothed probability, and a failure arc to the root, weighted with the log of the mass that its
discounts left over. A text is read once from left to right: follow the arc of the next word, or the
failure arc and then the root's.

Neither counts nor automaton ever have to fit one machine. Texts are cut into chunks; a chunk knows
its different words and bigrams, counts them, and sends them to partitions by the hash of the first
word. Partitions add the counts of all chunks and answer every chunk with the totals of exactly what
it asked for. From the answers a chunk builds the part of the automaton that its texts can reach. The
first word of very many bigrams is split over all partitions; answers add up, so that stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonescope.session import released_shuffles, work_folder

from .words import WordHasher, mix

#: Characters of a chunk, at least one text. More share more words in one request, and take more memory:
#: a task holds some hundred bytes for every word of one.
CHUNK_CHARS = 4_000_000
#: Hashes of the end and the start of a text: no words, as words are mixed by other numbers.
END, START = (np.uint64(x) for x in mix(np.array([0xE17D, 0x57A27], np.uint64)))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
            % modulus).cast("int")


def chunks(rows: DataFrame, chunk_chars: int) -> DataFrame:
    """One row per chunk: its texts as numbers of its different words.

    ``rows`` has ``doc_id, text, held_out``. ``words`` are sorted hashes, ``tokens`` the numbers of
    all texts' words, each text closed by the end; ``heavy`` the words with a large share.
    """
    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext
        chunk, hasher = TaskContext.get().partitionId() << 24, WordHasher(lower=True)

        def packed(ids, held, parts, lengths):
            lengths = np.concatenate(lengths)
            words, tokens = np.unique(np.concatenate([*parts, [END]]), return_inverse=True)
            tokens, end = tokens[:-1], tokens[-1]
            tokens = np.insert(tokens, np.cumsum(lengths), end).astype(np.int32)
            return pa.RecordBatch.from_arrays([
                pa.array([chunk], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([np.array(held, bool)], pa.list_(pa.bool_())),
                pa.array([lengths + 1], pa.list_(pa.int64())),
                pa.array([words.tobytes()], pa.binary()), pa.array([tokens.tobytes()], pa.binary())],
                names=["chunk", "doc_ids", "held_out", "lengths", "words", "tokens"])

        ids, held, parts, lengths, size = [], [], [], [], 0
        for batch in batches:
            texts = batch.column(1)
            chars = np.nan_to_num(np.array(pc.binary_length(texts).to_numpy(
                zero_copy_only=False), np.float64)).astype(np.int64)
            names, out = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            at = 0
            while at < len(names):
                reach = np.cumsum(chars[at:])
                n = min(len(names) - at,
                        1 + int(np.searchsorted(reach, max(chunk_chars - size, 1))))
                found, counts = hasher.words(texts.slice(at, n))
                ids += names[at:at + n]
                held += out[at:at + n]
                parts.append(found)
                lengths.append(counts)
                size += int(reach[n - 1])
                at += n
                if size >= chunk_chars:
                    yield packed(ids, held, parts, lengths)
                    chunk, ids, held, parts, lengths, size = chunk + 1, [], [], [], [], 0
        if ids:
            yield packed(ids, held, parts, lengths)

    return rows.mapInArrow(run, "chunk long, doc_ids array<long>, held_out array<boolean>, "
                                "lengths array<long>, words binary, tokens binary")


class Chunk:
    """A chunk's different words and bigrams. Number ``len(words)`` is the start of a text."""

    def __init__(self, held_out, lengths, words, tokens):
        """The values of a row of ``chunks``, as Arrow has them."""
        self.held_out = held_out.values.to_numpy(zero_copy_only=False)
        self.lengths = lengths.values.to_numpy()
        self.words = np.frombuffer(words.as_buffer(), np.uint64)
        self.tokens = np.frombuffer(tokens.as_buffer(), np.int32).astype(np.int64)
        self.start = len(self.words)
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.hashes = np.append(self.words, START)
        history = np.empty_like(self.tokens)
        history[1:] = self.tokens[:-1]
        history[self.firsts] = self.start
        self.trained = np.repeat(~self.held_out, self.lengths)
        self.bigrams, self.arc = np.unique(history * self.start + self.tokens,
                                           return_inverse=True)

    def counts(self):
        """Training counts of words (the start: of texts) and of bigrams."""
        words = np.bincount(self.tokens[self.trained], minlength=self.start + 1)
        words[self.start] = (~self.held_out).sum()
        return words, np.bincount(self.arc[self.trained], minlength=len(self.bigrams))

    def dealt(self, parts: int, heavy: np.ndarray):
        """For every partition: the words and the bigrams it is asked for.

        A heavy first word is asked for everywhere, its bigrams where the second word belongs.
        """
        home = (self.hashes % np.uint64(parts)).astype(np.int64)
        is_heavy = np.isin(self.hashes, heavy)
        first, second = self.bigrams // self.start, self.bigrams % self.start
        where = np.where(is_heavy[first],
                         (mix(self.hashes[second]) % np.uint64(parts)).astype(np.int64), home[first])
        order = np.argsort(where, kind="stable")
        bounds = np.searchsorted(where[order], np.arange(parts + 1))
        by_home = np.argsort(home, kind="stable")
        edges = np.searchsorted(home[by_home], np.arange(parts + 1))
        everywhere = np.flatnonzero(is_heavy)
        for part in range(parts):
            own = by_home[edges[part]:edges[part + 1]]
            words = np.union1d(own, everywhere)
            yield part, words, home[words] == part, order[bounds[part]:bounds[part + 1]]


def heavy_words(stored: DataFrame, parts: int) -> np.ndarray:
    """Words with over 1 / (4 parts) of all words: at most 4 parts of them, from all chunks.

    A chunk names the words with half that share of its own; a word of that share overall has half
    of it in the chunks that name it, or little more than half of it altogether.
    """
    def run(batches) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for words, tokens in zip(batch.column(0), batch.column(1), strict=True):
                hashes = np.frombuffer(words.as_buffer(), np.uint64)
                counts = np.bincount(np.frombuffer(tokens.as_buffer(), np.int32),
                                     minlength=len(hashes))
                named = np.flatnonzero(counts * 8 * parts > counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(hashes[named].view(np.int64), 0)),
                     pa.array(np.append(counts[named], 0)),
                     pa.array(np.append(np.zeros(len(named), np.int64), counts.sum()))],
                    names=["word", "n", "total"])

    named = stored.select("words", "tokens").mapInArrow(run, "word long, n long, total long")
    total = named.agg(F.sum("total")).first()[0] or 0
    rows = (named.where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") * (8 * parts) > total).select("word").collect())
    found = np.array(sorted(r[0] for r in rows), np.int64).view(np.uint64)
    return np.append(found, START)


def requests(stored: DataFrame, parts: int, heavy: np.ndarray) -> DataFrame:
    """What each chunk asks of each partition, with its own training counts."""
    def run(batches) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for number, *row in zip(*batch.columns, strict=True):
                chunk = Chunk(*row)
                words, bigrams = chunk.counts()
                first, second = chunk.bigrams // chunk.start, chunk.bigrams % chunk.start
                for part, own, home, arcs in chunk.dealt(parts, heavy):
                    columns = (
                        chunk.hashes[own], np.where(home, words[own], 0).astype(np.int32), home,
                        np.searchsorted(own, first[arcs]).astype(np.int32),
                        chunk.hashes[np.minimum(second[arcs], chunk.start)],
                        bigrams[arcs].astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([number.as_py()], pa.int64()),
                         *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
                        names=["part", "chunk", "words", "counts", "home", "first", "second",
                               "pairs"])

    return stored.select("chunk", "held_out", "lengths", "words", "tokens").mapInArrow(
        run, "part int, chunk long, words binary, counts binary, home binary, first binary, "
             "second binary, pairs binary")


def answers(asked: DataFrame) -> DataFrame:
    """Totals for every request: of its words the count and the number of different successors
    (``fans``), of its bigrams the count; and per partition what the model needs overall."""
    def run(table):
        import pyarrow as pa
        def arrays(name, kind):
            return [np.frombuffer(value.as_buffer(), kind) for value in table[name]]

        words, firsts = arrays("words", np.uint64), arrays("first", np.int32)
        known, at = np.unique(np.concatenate(words), return_inverse=True)
        own = np.zeros(len(known), np.int64)
        np.add.at(own, at, np.concatenate(arrays("counts", np.int32)))
        home = np.zeros(len(known), bool)
        home[at[np.concatenate(arrays("home", bool))]] = True
        starts = np.cumsum([0, *map(len, words)])
        first = np.concatenate([at[s + f] for s, f in zip(starts, firsts, strict=False)])
        second = np.concatenate(arrays("second", np.uint64))
        pairs = np.concatenate(arrays("pairs", np.int32))
        order = np.lexsort((second, first))
        fresh = np.ones(len(order), bool)
        fresh[1:] = ((first[order][1:] != first[order][:-1])
                     | (second[order][1:] != second[order][:-1]))
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        total = np.bincount(number, weights=pairs, minlength=int(fresh.sum())).astype(np.int64)
        heads = first[order][fresh]
        fans = np.bincount(heads[total > 0], minlength=len(known))
        out = []
        ends = np.cumsum([0, *map(len, firsts)])
        real = home & (known != START)
        for i, (part, chunk) in enumerate(zip(table["part"].to_pylist(), table["chunk"].to_pylist(),
                                              strict=True)):
            mine = at[starts[i]:starts[i + 1]]
            out.append({
                "part": part, "chunk": chunk,
                "counts": np.where(home[mine], own[mine], 0).astype(np.int64).tobytes(),
                "fans": fans[mine].astype(np.int64).tobytes(),
                "pairs": total[number[ends[i]:ends[i + 1]]].astype(np.int64).tobytes(),
                "tokens": int(own[real].sum()) if not i else 0,
                "types": int((own[real] > 0).sum()) if not i else 0,
                "once": int((total == 1).sum()) if not i else 0,
                "twice": int((total == 2).sum()) if not i else 0})
        kinds = {"part": pa.int32(), "chunk": pa.int64(), "counts": pa.binary(),
                 "fans": pa.binary(), "pairs": pa.binary(), "tokens": pa.int64(),
                 "types": pa.int64(), "once": pa.int64(), "twice": pa.int64()}
        return pa.Table.from_pylist(out, pa.schema(kinds))

    return asked.groupBy("part").applyInArrow(
        run, "part int, chunk long, counts binary, fans binary, pairs binary, tokens long, "
             "types long, once long, twice long")


class Automaton:
    """States are numbers of words, the last one the root. Arcs are sorted by state and word."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, failure: np.ndarray,
                 root: np.ndarray):
        self.keys, self.weights, self.failure, self.root = keys, weights, failure, root
        self.width = len(root)

    def read(self, tokens: np.ndarray, firsts: np.ndarray, lengths: np.ndarray,
             start: int, is_state: np.ndarray) -> np.ndarray:
        """The log-probability of every text: all texts take their first step, then the second."""
        order = np.argsort(-lengths, kind="stable")
        ends = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), "left")
        state = np.full(len(lengths), start, np.int64)
        scores = np.zeros(len(lengths))
        for step, n in enumerate(ends):
            texts = order[:n]
            word = tokens[firsts[texts] + step]
            now = state[texts]
            key = now * self.width + word
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            arc = (self.keys[at] == key) & (now < len(self.failure)) if len(self.keys) else (
                np.zeros(len(texts), bool))
            fallen = np.where(now < len(self.failure),
                              self.failure[np.minimum(now, len(self.failure) - 1)], 0.0)
            weight = self.weights[at] if len(self.keys) else fallen
            scores[texts] += np.where(arc, weight, fallen + self.root[word])
            state[texts] = np.where(is_state[word], word, len(self.failure))
        return scores


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = 10,
          chunk_chars: int = CHUNK_CHARS, parts: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Texts whose crc32 of the id modulo ``modulus`` is 0 are held out, all others train. A-Z counts as
    a-z; every text, also a null or empty one, ends with one end token. ``base_score`` is the
    unigram model's log10 probability, ``score`` the bigram model's. Repeated rows train as often as
    they stand there. A null id counts as empty text for the split. Without training texts both
    scores are those of the smoothing alone. A very long text is a chunk of its own, scored whole. An
    empty table gives no rows. Other columns are not
    read. ``parts`` (default: the shuffle partitions) bounds a partition's counts.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "lm")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"),
                       (remainder(docs[doc_id], modulus) == 0).alias("held_out"))
    chunks(rows, chunk_chars).write.option("compression", "zstd").parquet(f"{folder}/chunks")
    stored = spark.read.parquet(f"{folder}/chunks")
    heavy = heavy_words(stored, parts)
    # The requests are answered, and go from disk before the answers are moved.
    with released_shuffles(spark):
        answers(requests(stored, parts, heavy)).write.option("compression", "zstd").parquet(
            f"{folder}/answers")
    answered = spark.read.parquet(f"{folder}/answers")
    tokens, types, once, twice = answered.agg(
        *(F.sum(c) for c in ("tokens", "types", "once", "twice"))).first()
    tokens, types, once, twice = (int(x or 0) for x in (tokens, types, once, twice))
    discount = min(max(once / (once + 2 * twice), 0.1), 0.999) if once else 0.5
    lowest = tokens + 0.1 * (types + 1)

    def run(_, chunk_table, answer_table):
        import pyarrow as pa
        out = []
        replies = {part: row for part, *row in zip(
            answer_table["part"].to_pylist(), answer_table["counts"], answer_table["fans"],
            answer_table["pairs"], strict=True)}
        for doc_ids, *row in zip(*(chunk_table[c] for c in (
                "doc_ids", "held_out", "lengths", "words", "tokens")), strict=True):
            chunk = Chunk(*row)
            counts, fans = np.zeros((2, chunk.start + 1), np.int64)
            pairs = np.zeros(len(chunk.bigrams), np.int64)
            for part, own, _, arcs in chunk.dealt(parts, heavy):
                own_counts, own_fans, own_pairs = (
                    np.frombuffer(value.as_buffer(), np.int64) for value in replies[part])
                counts[own] += own_counts
                fans[own] += own_fans
                pairs[arcs] = own_pairs
            root = np.log10((counts[:-1] + 0.1) / lowest)
            mass = np.where(fans > 0, discount * fans / np.maximum(counts, 1), 1.0)
            first, second = chunk.bigrams // chunk.start, chunk.bigrams % chunk.start
            seen = pairs > 0
            first, second, pairs = first[seen], second[seen], pairs[seen]
            weights = np.log10((pairs - discount) / counts[first] + mass[first] * 10 ** root[second])
            automaton = Automaton(chunk.bigrams[seen], weights, np.log10(mass), root)
            scores = automaton.read(chunk.tokens, chunk.firsts, chunk.lengths, chunk.start,
                                    counts[:-1] > 0)

            def total(values: np.ndarray) -> np.ndarray:
                return np.add.reduceat(values[chunk.tokens], chunk.firsts)

            n = len(chunk.lengths)
            out.append(pa.table({
                "doc_id": doc_ids.values, "held_out": chunk.held_out,
                "n_tokens": chunk.lengths, "n_known": total((counts[:-1] > 0).astype(np.int64)),
                "train_tokens": np.full(n, tokens), "base_score": total(root), "score": scores}))
        return pa.concat_tables(out) if out else pa.schema(
            [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
             ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
             ("score", pa.float64())]).empty_table()

    scored = stored.groupBy("chunk").cogroup(
        answered.select("chunk", "part", "counts", "fans", "pairs").groupBy("chunk"))
    return scored.applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                    "train_tokens long, base_score double, score double")
