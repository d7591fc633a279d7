"""Operator 9, n-gram Jaccard join: documents whose sets of word shingles are similar, and the
components that these links form.

1. One pass over the texts gives every document its set size, a 128-bit hash of the set, a bitmap (the
   parity of its shingles per hash slot) and its prefix: the first n - ceil(t n) + 1 elements in an
   order that all documents share. Two sets of similarity t or more share an element of their
   prefixes, whatever the order is; here a bounded number of frequent shingles come last.
2. Documents with equal sets are one from here on.
3. Documents that share a prefix element meet. Each is compared with the first of that element, and in
   groups of more than CROWD with one drawn for the element, so a group of thousands of near copies costs two
   comparisons per document and element, not one per pair.
4. Elements whose documents are still in different components are cut into tiles of neighbouring set
   sizes. Tiles whose sizes allow similarity t meet in numpy: the bits in which two bitmaps differ
   are a lower bound of the different elements, so an upper bound of the overlap; so is what follows
   the first shared element in the order. A pair meets at every element that it shares, but is only named
   where none of the shared ones among the first HEAD of both comes before. Pairs that pass are
   bounded once more by bitmaps that grow with the set, and only then intersected exactly, as sorted
   arrays.

Every pair of similarity t shares an element and is in one component after 3 or looked at in 4, so no
link is lost that a component needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonescope.session import released_shuffles, work_folder

from .words import WordHasher, distinct, mix, shingles

#: Longs of a bitmap; more prune long texts better.
BITMAP = 16
#: Documents of a tile.
TILE = 1024
#: Documents of an element from which they also meet a drawn one.
CROWD = 32
#: First prefix elements that tell whether a pair has met before; more leave fewer repeated pairs.
HEAD = 8
#: Pairs of rows compared at a time.
PAIRS = 1 << 18
#: Bits per element of the larger bitmaps.
SPARSE = 4
#: Frequent shingles that the order puts last, at most. Any choice gives the same links.
FREQUENT = 65_536

_SKETCH = ("row long, doc_id long, n long, low long, high long, prefix array<long>, "
           "bitmap array<long>")


def frequent(rows: DataFrame, k: int, lower: bool, most: int = FREQUENT) -> np.ndarray:
    """Up to ``most`` shingles of many different sets, of all documents; ``rows`` as for ``sketches``.

    A batch names those of its shingles that several of its sets have.
    """
    def run(batches) -> Iterator:
        import pyarrow as pa
        hasher = WordHasher(lower)
        for batch in batches:
            values, sizes = distinct(*shingles(*hasher.words(batch.column(1)), k))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
            ends = np.cumsum(sizes)
            _, first = np.unique(sums[ends] - sums[ends - sizes], return_index=True)
            single = np.zeros(len(sizes), bool)
            single[first] = True
            found, counts = np.unique(values[np.repeat(single, sizes)], return_counts=True)
            keep = counts >= max(3, len(first) // 2000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[keep].view(np.int64)), pa.array(counts[keep].astype(np.int64))],
                names=["key", "c"])

    counted = rows.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    top = counted.orderBy(F.col("c").desc(), "key").limit(most).collect()
    return np.sort(np.array([r[0] for r in top], np.int64).view(np.uint64))


def sketches(rows: DataFrame, k: int, percent: int, lower: bool,
             late: np.ndarray) -> DataFrame:
    """The first pass. ``rows`` has ``doc_id, text``; the sorted shingles ``late`` come last in order."""
    def run(batches) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        hasher, at = WordHasher(lower), TaskContext.get().partitionId() << 36
        for batch in batches:
            values, sizes = distinct(*shingles(*hasher.words(batch.column(1)), k))
            n = len(sizes)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            owners = np.repeat(np.arange(n), sizes)
            slot = mix(values ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(54)  # 10 bits
            parity = np.bincount(owners * 1024 + slot.astype(np.int64), minlength=n * 1024) & 1
            bits = np.packbits(parity.astype(np.uint8).reshape(n, 1024), axis=1,
                               bitorder="little").view(np.int64)

            def total(of: np.ndarray) -> np.ndarray:
                sums = np.concatenate([[np.uint64(0)], np.cumsum(of, dtype=np.uint64)])
                return (sums[ends] - sums[starts]).view(np.int64)

            size = np.where(sizes > 0, sizes - -(-sizes * percent // 100) + 1, 0)
            if len(late):
                at_late = np.minimum(np.searchsorted(late, values), len(late) - 1)
                is_late = late[at_late] == values
                values = values[np.argsort(2 * owners + is_late, kind="stable")]
            take = np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(at + np.arange(n)), batch.column(0), pa.array(sizes),
                pa.array(total(values)), pa.array(total(mix(values + np.uint64(1)))),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[take].view(np.int64))),
                pa.ListArray.from_arrays(
                    pa.array((np.arange(n + 1) * BITMAP).astype(np.int32)),
                    pa.array(bits.ravel()))],
                names=["row", "doc_id", "n", "low", "high", "prefix", "bitmap"])
            at += n

    return rows.mapInArrow(run, _SKETCH)


def shingle_arrays(rows: DataFrame, k: int, lower: bool) -> DataFrame:
    """``node, elements``: the sorted shingle hashes of ``node, text``."""
    def run(batches) -> Iterator:
        import pyarrow as pa
        hasher = WordHasher(lower)
        for batch in batches:
            values, sizes = distinct(*shingles(*hasher.words(batch.column(1)), k))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            arrays = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(arrays, pa.binary())],
                                             names=["node", "elements"])

    return rows.mapInArrow(run, "node long, elements binary")


def may_link(percent: int) -> Column:
    """Whether sizes and bitmaps of ``a_n, a_bitmap, b_n, b_bitmap`` allow the similarity."""
    differ = reduce(lambda x, y: x + y, [
        F.bit_count(F.element_at("a_bitmap", i + 1).bitwiseXOR(F.element_at("b_bitmap", i + 1)))
        for i in range(BITMAP)])
    both = F.col("a_n") + F.col("b_n")
    # overlap <= (both - differ) / 2 and similarity = overlap / (both - overlap)
    overlap = F.least((both - differ) / 2, F.col("a_n"), F.col("b_n"))
    return overlap * (100 + percent) >= both * percent


def large_bitmap(values: np.ndarray) -> bytes:
    """Parity of the elements per hash slot, with SPARSE to twice as many slots per element."""
    slots = 1 << max(10, (SPARSE * max(len(values), 1) - 1).bit_length())
    slot = mix(values ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(slots - 1)
    parity = np.bincount(slot.astype(np.int64), minlength=slots) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def bits_differ(left: np.ndarray, right: np.ndarray) -> int:
    """In how many slots two large bitmaps differ, as 64-bit words: a lower bound of the different
    elements. The larger is folded: slots that agree in their low bits add up."""
    left, right = (left, right) if len(left) <= len(right) else (right, left)
    while len(right) > len(left):
        right = right[:len(right) // 2] ^ right[len(right) // 2:]
    return int(np.bitwise_count(left ^ right).sum())


def own_arrays(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, k: int, lower: bool,
               folder: str) -> DataFrame:
    """``node, n, large, elements``: large bitmaps and sorted shingle arrays of the wanted nodes, read
    from their texts.

    Rows that share an id may differ: size and hash of the set tell which are the node's.
    """
    spark = texts.sparkSession
    wanted = nodes.join(wanted, "node", "left_semi").select(
        "node", F.col("doc_id").alias("of"), "n", "low")
    wanted.write.parquet(f"{folder}/wanted")
    # The wanted nodes grow with the input, so they are never broadcast, at no size.
    wanted = spark.read.parquet(f"{folder}/wanted").hint("merge")
    rows = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("of")))

    def run(batches) -> Iterator:
        import pyarrow as pa
        hasher = WordHasher(lower)
        for batch in batches:
            values, sizes = distinct(*shingles(*hasher.words(batch.column(1)), k))
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            sums = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
            low = (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)
            own = (sizes == batch.column(2).to_numpy()) & (low == batch.column(3).to_numpy())
            found = [values[bounds[i]:bounds[i + 1]] for i in np.flatnonzero(own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(own)), batch.column(2).filter(pa.array(own)),
                 pa.array([large_bitmap(v) for v in found], pa.binary()),
                 pa.array([v.tobytes() for v in found], pa.binary())],
                names=["node", "n", "large", "elements"])

    found = rows.select("node", "text", "n", "low").mapInArrow(
        run, "node long, n long, large binary, elements binary")
    found.dropDuplicates(["node"]).write.parquet(f"{folder}/arrays")
    return spark.read.parquet(f"{folder}/arrays")


def linked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, percent: int, lower: bool,
           folder: str) -> DataFrame:
    """The pairs ``a, b`` of the given similarity: bitmaps first, small and then large ones, then
    exact intersection."""
    spark = nodes.sparkSession

    def of(side: str) -> DataFrame:
        return nodes.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"),
                            F.col("bitmap").alias(f"{side}_bitmap"))

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def met(pairs: DataFrame, column: str) -> DataFrame:
        """``a, b`` with ``column`` of both, which leaves the arrays of few pairs to be moved."""
        sides = [arrays.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"),
                               F.col(column).alias(f"{side}_{column}")) for side in ("a", "b")]
        return pairs.join(sides[0], "a").join(sides[1], "b").select(
            "a", "b", f"a_{column}", f"b_{column}", "a_n", "b_n")

    def may_match(batches) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            keep = []
            for x, y, n, m in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(),
                                  batch.column(5).to_pylist(), strict=True):
                differ = bits_differ(np.frombuffer(x.as_buffer(), np.uint64),
                                     np.frombuffer(y.as_buffer(), np.uint64))
                keep.append((n + m - differ) * (100 + percent) >= 2 * (n + m) * percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def match(batches) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                left = np.frombuffer(x.as_buffer(), np.uint64)
                right = np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(right, left)
                common = int((right[np.minimum(at, len(right) - 1)] == left).sum())
                keep.append(100 * common >= percent * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    passed = pairs.join(of("a"), "a").join(of("b"), "b").where(may_link(percent)).select("a", "b")
    passed = stored(passed, "passed")
    wanted = passed.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    arrays = own_arrays(texts, nodes, wanted, k, lower, folder)
    passed = stored(met(passed, "large").mapInArrow(may_match, "a long, b long"), "likely")
    return stored(met(passed, "elements").mapInArrow(match, "a long, b long"), "links")


def connected(links: DataFrame, folder: str) -> DataFrame:
    """``node, root``: the smallest node of its component, for every node of a link ``a, b``.

    Rounds of large stars and small stars; each round is a written table.
    """
    spark = links.sparkSession
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges.where("u <> v").distinct().write.parquet(f"{folder}/0")
    edges, before, level = spark.read.parquet(f"{folder}/0"), None, 0

    def star(pairs: DataFrame, low: DataFrame) -> DataFrame:
        return pairs.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    while True:
        level += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = star(both.where("v > u"), low).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = star(large, least).unionByName(least.select("u", F.col("m").alias("v")))
        small.where("u <> v").distinct().write.parquet(f"{folder}/{level}")
        edges = spark.read.parquet(f"{folder}/{level}")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))
                             .distinct().join(roots.select("node"), "node", "left_anti"))


def tile_candidates(rows: DataFrame, percent: int, tile: int) -> DataFrame:
    """Pairs ``a, b`` of different components in one group that sizes and bitmaps allow.

    ``rows`` has ``key, node, n, root, bitmap``, and may have ``pos``, the key's place among the node's
    elements, and ``head``, the first of those. Groups are cut into tiles along the set size, and
    tiles whose sizes are within the similarity meet, each meeting a group of its own.
    """
    if "head" not in rows.columns:
        rows = rows.withColumns({"pos": F.lit(0), "head": F.array().cast("array<long>")})
    order = Window.partitionBy("key").orderBy("n", "node")
    tiled = rows.withColumn("tile", F.floor((F.row_number().over(order) - 1) / tile).cast("int"))
    spans = tiled.groupBy("key", "tile").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    later = spans.select("key", F.col("tile").alias("tile_b"), F.col("least").alias("least_b"))
    meet = (spans.join(later, "key")
            .where((F.col("tile") <= F.col("tile_b"))
                   & (F.col("least_b") * percent <= F.col("most") * 100))
            .select("key", F.col("tile").alias("tile_a"), "tile_b"))
    sides = F.array_distinct(F.array("tile_a", "tile_b"))
    cells = meet.select("key", "tile_a", "tile_b", F.explode(sides).alias("tile"))
    dealt = (tiled.join(cells, ["key", "tile"])
             .select("key", "tile_a", "tile_b", "tile", "node", "n", "root", "bitmap", "pos", "head"))

    def run(batches) -> Iterator:
        import pyarrow as pa
        held = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            cell = _cells(table)
            last = int(np.flatnonzero(cell == cell[-1])[0])  # this cell may go on in the next batch
            if last:
                yield from _met(table.slice(0, last), cell[:last], percent)
                held = table.slice(last).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            yield from _met(table, _cells(table), percent)

    by_cell = ["key", "tile_a", "tile_b"]
    return (dealt.repartition(*by_cell).sortWithinPartitions(*by_cell, "tile", "n", "node")
            .mapInArrow(run, "a long, b long").distinct())


def _cells(table) -> np.ndarray:
    """A number per row that changes where the next cell of two tiles begins."""
    fresh = np.zeros(len(table), bool)
    for name in ("key", "tile_a", "tile_b"):
        column = table[name].to_numpy()
        fresh[1:] |= column[1:] != column[:-1]
    return np.cumsum(fresh)


def _met(table, cell: np.ndarray, percent: int, pairs: int = PAIRS) -> Iterator:
    """The pairs that sizes, places and bitmaps allow in whole cells, ordered by tile and size.

    In a cell of one tile a row meets those behind it, else the first tile's rows meet the second's;
    either way the others are ordered by size, and are no smaller. A pair that shares an earlier element
    meets there too: it is left out where the heads show that."""
    import pyarrow as pa
    import pyarrow.compute as pc
    node, n, root, tile, first, second, pos = (
        table[c].to_numpy() for c in ("node", "n", "root", "tile", "tile_a", "tile_b", "pos"))
    heads = table["head"].combine_chunks()
    heads = heads.chunk(0) if isinstance(heads, pa.ChunkedArray) else heads
    held = pc.list_value_length(heads).to_numpy()
    most_held = max(int(held.max()), 1)
    head = np.zeros((len(n), most_held), np.int64)
    head[np.arange(most_held) < held[:, None]] = heads.flatten().to_numpy()
    earlier = np.arange(most_held) < np.minimum(held, pos)[:, None]
    flat = table["bitmap"].combine_chunks().flatten()
    bits = flat.to_numpy().view(np.uint64).reshape(-1, BITMAP)
    alone = first == second
    # Sides of cells are ascending stretches of sizes; one search finds where each row's others end.
    side = 2 * cell + (~alone & (tile == second))
    base = int(n.max()) + 1
    place = side * base + n
    other = np.where(alone, side, 2 * cell + 1)
    most = np.minimum(n * 100 // percent, base - 1)
    stop = np.searchsorted(place, other * base + most, "right")
    start = np.where(alone, np.arange(len(n)) + 1, np.searchsorted(place, other * base, "left"))
    counts = np.where(alone | (tile == first), np.maximum(stop - start, 0), 0)
    before = np.concatenate([[0], np.cumsum(counts)])
    for low in range(0, int(before[-1]), pairs):
        number = np.arange(low, min(low + pairs, int(before[-1])))
        a = np.searchsorted(before, number, "right") - 1
        b = start[a] + number - before[a]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
        # Where the first shared element stands, the overlap lies behind it.
        both = n[a] + n[b]
        ahead = np.minimum(n[a] - pos[a], n[b] - pos[b]) * (100 + percent) >= both * percent
        a, b, both = a[ahead], b[ahead], both[ahead]
        differ = np.zeros(len(a), np.int64)
        for column in range(BITMAP):
            differ += np.bitwise_count(bits[a, column] ^ bits[b, column])
        overlap = np.minimum((both - differ) / 2, n[a])
        keep = overlap * (100 + percent) >= both * percent
        a, b = a[keep], b[keep]
        met = np.zeros(len(a), bool)
        for i in range(most_held):
            met |= earlier[a, i] & ((head[a, i][:, None] == head[b]) & earlier[b]).any(axis=1)
        x, y = node[a[~met]], node[b[~met]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))],
                                         names=["a", "b"])


def similar_components(docs: DataFrame, k: int = 5, percent: int = 80, lower: bool = True,
                       doc_id: str = "doc_id", text: str = "text",
                       tile: int = TILE) -> DataFrame:
    """``row, doc_id, n_shingles, component_id`` of every row.

    The set of a document holds its different shingles of ``k`` words (``lower``: with A-Z in lower
    case); with fewer words the whole sequence is its only one; without words, or with a null text,
    it is empty, and linked with nothing. Two documents link when 100 * intersection >= ``percent``
    * union. ``component_id`` is the smallest ``doc_id`` that links reach, null only if all of those
    are. Rows that repeat an id are documents of their own. ``row`` is unique. A very long text has its
    whole set; equal sets are compared once. An empty table gives
    no rows. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    folder = work_folder(spark, "jaccard")
    texts = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    # What each of these many jobs shuffles would else stay on disk beside what the next ones shuffle.
    with released_shuffles(spark):
        sketches(texts, k, percent, lower, frequent(texts, k, lower)).write.parquet(f"{folder}/sketches")
        sketch = spark.read.parquet(f"{folder}/sketches")

        # Equal sets are one node, named by the smallest of their rows.
        same = ["n", "low", "high"]
        classes = sketch.where("n > 0").groupBy(*same).agg(F.min("row").alias("node"))
        members = sketch.select("row", "doc_id", *same).join(classes, same, "left")
        members.select("row", "doc_id", "n", F.coalesce("node", "row").alias("node"), "low",
                       "high").write.parquet(f"{folder}/members")
        members = spark.read.parquet(f"{folder}/members")
        chosen = members.where((F.col("row") == F.col("node")) & (F.col("n") > 0)).select("row")
        nodes = sketch.join(chosen, "row", "left_semi").withColumnRenamed("row", "node")

        # Prefix elements that several nodes have.
        prefixes = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "key"))
        counted = prefixes.groupBy("key").agg(F.count("*").alias("c"),
                                              F.min(F.struct("node", "n")).alias("first"))
        counted = counted.where("c > 1").select("key", "c", "first.node", "first.n").toDF(
            "key", "c", "first", "first_n")
        prefixes.join(counted, "key").write.parquet(f"{folder}/shared")
        shared = spark.read.parquet(f"{folder}/shared")
        nodes = nodes.select("node", "doc_id", "n", "low", "bitmap", F.slice("prefix", 1, HEAD).alias("head"))

        # The first of an element is often the same for all elements of a text. In large groups, where
        # many texts may be similar but not to that one, each also meets a drawn one, another for
        # each element. More links found here leave fewer pairs to the tiles, which else grow with the
        # square of a group; the components are the same either way.
        crowded = shared.where(F.col("c") > min(CROWD, tile)).select("key", "node", "n")
        drawn = crowded.groupBy("key").agg(F.min(F.struct(
            F.xxhash64("key", "node").alias("draw"), "node", "n")).alias("drawn"))
        drawn.select("key", "drawn.node", "drawn.n").toDF("key", "first", "first_n").write.parquet(
            f"{folder}/drawn")
        crowded = crowded.join(spark.read.parquet(f"{folder}/drawn"), "key")
        sizes = F.least("n", "first_n") * 100 >= F.greatest("n", "first_n") * percent
        stars = (shared.select("node", "n", "first", "first_n")
                 .unionByName(crowded.select("node", "n", "first", "first_n"))
                 .where(F.col("node") != F.col("first")).where(sizes)
                 .select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"))
                 .distinct())
        links = linked(stars, nodes, texts, k, percent, lower, f"{folder}/first")
        connected(links, f"{folder}/roots0").write.parquet(f"{folder}/rooted0")
        roots = spark.read.parquet(f"{folder}/rooted0")

        placed = (shared.select("key", "node", "n", "pos").join(roots, "node", "left")
                  .withColumn("root", F.coalesce("root", "node")))
        apart = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"))
        left = placed.join(apart.where("x <> y").select("key"), "key", "left_semi")
        # A node without another of its size in the group is done. Of two, the smaller has enough elements
        # from the key on for one of its own size.
        order = Window.partitionBy("key").orderBy("n", "node")
        early = (F.col("n") - F.col("pos")) * (100 + percent) >= F.col("n") * (2 * percent)
        smaller = F.max(F.when(early, F.col("n"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        near = (F.coalesce(smaller * 100 >= F.col("n") * percent, F.lit(False))
                | (early & F.coalesce(F.col("n") * 100 >= F.lead("n").over(order) * percent, F.lit(False))))
        left = left.withColumn("near", near).where("near").drop("near")
        left = left.join(nodes.select("node", "bitmap", "head"), "node")
        rest = tile_candidates(left, percent, tile)
        links = links.unionByName(linked(rest, nodes, texts, k, percent, lower, f"{folder}/rest"))
        connected(links, f"{folder}/roots1").write.parquet(f"{folder}/rooted1")
        roots = spark.read.parquet(f"{folder}/rooted1")

    final = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # A written table: the join then has plain exchanges, and a large component can be split.
    with released_shuffles(spark):
        final.groupBy("root").agg(F.min("doc_id").alias("component_id")).write.parquet(
            f"{folder}/least")
    least = spark.read.parquet(f"{folder}/least")
    return (final.join(least, "root")
            .select("row", "doc_id", F.col("n").alias("n_shingles"), "component_id"))
