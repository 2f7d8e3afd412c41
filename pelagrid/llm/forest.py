"""Near-duplicate documents by an LSH forest of MinHash signatures.

Each text becomes a set of word shingles; texts with equal sets form one class, so any
number of copies costs one entry. A class has several signatures of ``DEPTH`` minimum
hashes, one per tree. All signatures of a tree are sorted (range partitioned, so a region
of any density is split over tasks), and each entry meets its nearest neighbours in that
order: those with the longest common prefixes, and the most similar of the next ones.
Beyond its own hashes a tree's order goes on through those of the other trees, so it is as
deep as a region needs: where it is sparse, an entry meets every other down to ``BASE``
common hashes, where it is dense, those with longer prefixes. Neighbours at a partition's
edge meet in a second pass over the edge rows.

A candidate pair is compared by a byte per hash first and, unless that estimate lies
more than 4.5 standard deviations below the threshold, confirmed on the full shingle sets
of both texts. Best candidates are confirmed first; pairs that this has already put
into one component need no confirmation, all others get it.

Entries that had more similar neighbours than they met are in a dense region. A region is
what candidate pairs hold together, linked or not. Its components that are not its largest are
compared with all of it on full sets, in tiles of two blocks of ``BLOCK_CLASSES`` classes: shared
shingles are counted exactly by a product of two small matrices, and a tile gives only the links
that join components. So in a dense region no link is lost that would change a component.

Defined results: null texts and texts without words have an empty set and are linked with
nothing; fewer words than a shingle make one shingle of all of them; rows with equal texts are
copies whatever their ``doc_id``; a null ``doc_id`` never names a component unless
no row of it has one. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagrid.llm import text as tx
from pelagrid.llm.graph import components, matched, written

BASE = 3  # common hashes that make two entries of a tree neighbours
DEPTH = 6  # hashes of one tree
WINDOW = 4  # neighbours on each side that an entry meets in each order
REACH = 128  # and of those up to here, on each side, the
FAR_PAIRS = 1  # best by its sketch; more of them make a dense region
MISSED = 1e-5  # chance that a pair at the threshold shares no base prefix
PAIRS_AT_ONCE = 256  # whose sets are in a task's memory together
BLOCK_CLASSES = 512  # classes in one side of a tile, or
BLOCK_SHINGLES = 500_000  # this many shingles
TILE_COLUMNS = 4096  # shingles that a tile multiplies at once
NO_ID = (1 << 63) - 1  # stands for a null doc_id while the least one is sought


@dataclass(frozen=True)
class Forest:
    """``width`` words a shingle; pairs with 100 * shared >= ``percent`` * united are links."""

    width: int = 5
    percent: int = 80

    @property
    def trees(self) -> int:
        share = (self.percent / 100) ** BASE
        return math.ceil(math.log(MISSED) / math.log(1 - share))

    @property
    def hashes(self) -> int:
        return self.trees * DEPTH

    @property
    def least_estimate(self) -> float:
        s = self.percent / 100
        return s - 4.5 * math.sqrt(s * (1 - s) / self.hashes)


def shingle_sets(chunk: tx.Chunk, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    at = tx.words(chunk)
    hashes = tx.span_hashes(tx.prefix_hashes(tx.LOWER[chunk.data]), at)
    factors = tx.mix(np.arange(101, 101 + width, dtype=np.uint64)) | np.uint64(1)
    runs = max(len(hashes) - width + 1, 0)
    rolled = np.zeros(runs, np.uint64)
    for k in range(width):
        rolled += hashes[k : k + runs] * factors[k]
    rolled = tx.mix(rolled)
    sets = []
    for first, last in zip(at.of[:-1].tolist(), at.of[1:].tolist(), strict=True):
        n = last - first
        if n >= width:
            sets.append(np.unique(rolled[first : last - width + 1]))
        elif n:
            whole = (hashes[first:last] * factors[:n]).sum(keepdims=True, dtype=np.uint64)
            sets.append(tx.mix(whole + np.uint64(n)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _fingerprints(forest: Forest):
    """Arrow rows of identity, set size, set identity and signature from (doc_id, text, text_id)."""
    draw = np.random.default_rng(20_240_501)
    factors = draw.integers(0, 1 << 63, forest.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = draw.integers(0, 1 << 63, forest.hashes, dtype=np.uint64)
    names = ["doc_id", "text_id", "n_shingles", "set_a", "set_b", "signature", "sketch"]

    def run(batches):
        for batch in batches:
            for chunk in tx.chunks(batch.column("text")):
                sets = shingle_sets(chunk, forest.width)
                sizes = np.array([len(s) for s in sets], np.int64)
                some = sizes > 0
                joined = np.concatenate([*sets, np.zeros(1, np.uint64)])[:-1]
                begins = (np.cumsum(sizes) - sizes)[some]
                n = len(sets)
                ids = np.zeros((2, n), np.uint64)
                least = np.zeros((n, forest.hashes), np.uint32)
                if len(begins):
                    ids[0, some] = np.add.reduceat(joined, begins)
                    ids[1, some] = np.add.reduceat(tx.mix(joined ^ np.uint64(0xA5A5A5A5)), begins)
                    for k in range(forest.hashes):
                        ranked = (joined * factors[k] + shifts[k]) >> np.uint64(32)
                        least[some, k] = np.minimum.reduceat(ranked, begins)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(chunk.first, n),
                        batch.column("text_id").slice(chunk.first, n),
                        pa.array(sizes),
                        pa.array(ids[0].view(np.int64)),
                        pa.array(ids[1].view(np.int64)),
                        _binaries(least.astype(">u4")),
                        _binaries(least.astype(np.uint8)),
                    ],
                    names,
                )

    return run


def _binaries(rows: np.ndarray) -> pa.Array:
    """One binary value from the bytes of each row."""
    n, width = len(rows), rows.shape[1] * rows.itemsize
    offsets = pa.py_buffer((np.arange(n + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(rows.tobytes())])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Bytes of equally long binary values, a row for each."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(len(column), width)


def _neighbours(forest: Forest):
    """Sorted entries in; candidate pairs (a, b, estimate) out, entries with more similar neighbours
    than those (``a`` twice), and edge rows: with a key, the entry in ``a`` and the number of
    the slice boundary in ``b``."""
    base, key_width = 1 + 4 * BASE, 1 + 4 * DEPTH
    names = ["a", "b", "estimate", "key", "sketch"]
    chance = 1 / 256

    def best(entry, score):
        """Places of each entry's ``FAR_PAIRS`` best scores."""
        order = np.lexsort((-score, entry))
        fresh = np.ones(len(order), bool)
        fresh[1:] = entry[order][1:] != entry[order][:-1]
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
        return order[place < FAR_PAIRS]

    def pairs(keys, sketches, nodes, fresh):
        """Pairs whose later entry is at or after ``fresh``."""
        near, far, crowded = [], [], [np.zeros(0, np.int64)]
        for back in range(1, min(REACH, len(nodes) - 1) + 1):
            later = np.arange(max(fresh, back), len(nodes))
            later = later[(keys[later, :base] == keys[later - back, :base]).all(1)]
            if len(later) == 0:
                break  # sorted: entries further apart share no base prefix either
            same = (sketches[later] == sketches[later - back]).mean(1)
            score = (same - chance) / (1 - chance)
            kept = score >= forest.least_estimate
            found = np.stack([later[kept], later[kept] - back, score[kept]])
            (near if back <= WINDOW else far).append(found)
            if back == REACH:
                crowded += [later, later - back]
        none = np.zeros((3, 0))
        chosen = [np.concatenate([none, *near], axis=1)]
        more = np.concatenate([none, *far], axis=1)
        if more.shape[1]:
            met = np.zeros(more.shape[1], bool)
            met[np.union1d(best(more[0], more[2]), best(more[1], more[2]))] = True
            chosen.append(more[:, met])
            crowded.append(more[:2, ~met].astype(np.int64).ravel())
        dense = np.unique(np.concatenate(crowded)).astype(float)
        chosen.append(np.stack([dense, dense, np.ones(len(dense))]))
        later, earlier, score = np.concatenate(chosen, axis=1)
        x, y = nodes[later.astype(np.int64)], nodes[earlier.astype(np.int64)]
        blank = pa.nulls(len(x), pa.binary())
        columns = [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(score), blank, blank]
        return pa.RecordBatch.from_arrays(columns, names)

    def edge(boundary, keys, sketches, nodes):
        n = len(nodes)
        columns = [pa.array(nodes), pa.array(np.full(n, boundary)), pa.nulls(n, pa.float64())]
        return pa.RecordBatch.from_arrays([*columns, _binaries(keys), _binaries(sketches)], names)

    def run(batches):
        kept, slice_ = None, TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            new = (
                _matrix(batch.column("key"), key_width),
                _matrix(batch.column("sketch"), forest.hashes),
                np.array(batch.column("node"), np.int64),
            )
            if kept is None:
                yield edge(slice_ - 1, *(x[:REACH] for x in new))
                kept = tuple(x[:0] for x in new)
            before = len(kept[2])
            new = tuple(np.concatenate([x, y]) for x, y in zip(kept, new, strict=True))
            yield pairs(*new, before)
            kept = tuple(x[-REACH:] for x in new)
        if kept is not None:
            yield edge(slice_, *kept)

    return run


def candidates(classes: DataFrame, forest: Forest) -> tuple[DataFrame, DataFrame]:
    """``a``, ``b``, ``estimate`` for classes(node, signature, sketch) near in some tree, and the
    ``node`` of every class that has more similar neighbours in a tree than these."""
    own = f"tree * {DEPTH}"
    key = F.concat(F.unhex(F.lpad(F.hex("tree"), 2, "0")), F.expr(f"substring(signature, 4 * {own} + 1, {4 * DEPTH})"))
    # The tree's own hashes first: what follows the key in its order, and compares as well as unturned.
    turned = F.concat(F.expr(f"substring(sketch, {own} + 1)"), F.expr(f"substring(sketch, 1, {own})"))
    entries = (
        classes.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(forest.trees - 1))))
        .select(key.alias("key"), turned.alias("sketch"), "node")
        .repartitionByRange("key", "sketch", "node")
        .sortWithinPartitions("key", "sketch", "node")
    )
    schema = "a long, b long, estimate double, key binary, sketch binary"
    near = written(entries.mapInArrow(_neighbours(forest), schema), "neighbours")
    # The last rows of a slice of the sort and the first of the next meet at their boundary.
    edges = (
        near.where("key is not null")
        .select("key", "sketch", F.col("a").alias("node"), F.col("b").alias("boundary"))
        .repartition("boundary")
        .sortWithinPartitions("boundary", "key", "sketch", "node")
        .mapInArrow(_neighbours(forest), schema)
    )
    met = near.where("key is null").unionByName(written(edges.where("key is null"), "edge-neighbours"))
    pairs = met.where("a <> b").groupBy("a", "b").agg(F.max("estimate").alias("estimate"))
    return pairs, met.where("a = b").select(F.col("a").alias("node")).distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, forest: Forest) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        verdicts = []
        for first in range(0, len(left), PAIRS_AT_ONCE):
            sides = [
                [s for c in tx.chunks(side.slice(first, PAIRS_AT_ONCE)) for s in shingle_sets(c, forest.width)]
                for side in (left, right)
            ]
            for x, y in zip(*sides, strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                verdicts.append(100 * shared >= forest.percent * (len(x) + len(y) - shared))
        return pa.array(verdicts, pa.bool_())

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(linked(F.col("text_a"), F.col("text_b"))).select("a", "b")
    )


def _sets(texts: DataFrame, forest: Forest) -> DataFrame:
    """``node`` and its sorted shingles as bytes."""

    def run(batches):
        for batch in batches:
            for chunk in tx.chunks(batch.column("text")):
                sets = [s.tobytes() for s in shingle_sets(chunk, forest.width)]
                nodes = batch.column("node").slice(chunk.first, len(sets))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(sets, pa.binary())], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each left set shares with each right one: a product of 0/1 matrices."""
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    counts = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(common), TILE_COLUMNS):
        some = common[first : first + TILE_COLUMNS]
        sides = []
        for sets in (left, right):
            side = np.zeros((len(sets), len(some)), np.float32)
            for row, s in zip(side, sets, strict=True):
                s = s[np.searchsorted(s, some[0]) : np.searchsorted(s, some[-1], "right")]
                place = np.searchsorted(some, s)
                row[place[some[place] == s]] = 1
            sides.append(side)
        counts += sides[0] @ sides[1].T  # whole numbers below 2 ** 24
    return counts.astype(np.int64)


def _tile_links(forest: Forest):
    """Links of one tile that join components: (node, root, side, shingles) rows in, (a, b) out."""

    def run(tile: pa.Table) -> pa.Table:
        nodes, roots = (tile.column(c).to_numpy() for c in ("node", "root"))
        sets = [np.frombuffer(s, np.uint64) for s in tile.column("shingles").to_pylist()]
        left = np.flatnonzero(tile.column("side").to_numpy() == 0)
        right = np.flatnonzero(tile.column("side").to_numpy() == 1)
        found = ([], [])
        if len(left) and len(right):
            sizes = np.array([len(s) for s in sets])
            shared = shared_counts([sets[i] for i in left], [sets[i] for i in right])
            united = sizes[left][:, None] + sizes[right][None, :] - shared
            parent = {r: r for r in roots.tolist()}

            def top(r):
                while parent[r] != r:
                    parent[r] = r = parent[parent[r]]
                return r

            apart = roots[left][:, None] != roots[right][None, :]
            for i, j in zip(*np.nonzero((100 * shared >= forest.percent * united) & apart), strict=True):
                x, y = top(int(roots[left[i]])), top(int(roots[right[j]]))
                if x != y:
                    parent[x] = y
                    found[0].append(int(nodes[left[i]]))
                    found[1].append(int(nodes[right[j]]))
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    return run


def _dense_links(regions: DataFrame, sets: DataFrame, forest: Forest) -> DataFrame:
    """Links between components of a region, for regions(region, root, node, n_shingles).

    All but the region's largest component are compared with all of it. Blocks are dealt by
    hash, so no task numbers a region's rows, and a tile holds two blocks.
    """
    per_root = regions.groupBy("region", "root").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")
    )
    blocks = lambda n, shingles: F.greatest(
        F.ceil(n / BLOCK_CLASSES), F.ceil(shingles / BLOCK_SHINGLES), F.lit(1)
    ).cast("int")
    largest = F.max(F.struct("n", "root"))
    shape = per_root.groupBy("region").agg(
        largest["root"].alias("main"),
        blocks(F.sum("n"), F.sum("shingles")).alias("rights"),
        blocks(F.sum("n") - largest["n"], F.sum("shingles") - F.max(F.struct("n", "root", "shingles"))["shingles"]).alias("lefts"),
    )
    held = regions.join(shape, "region").join(sets, "node")
    dealt = F.xxhash64("node")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["region", "i", "j", "side", "node", "root", "shingles"]
    left = (
        held.where("root <> main")
        .withColumns({"i": F.pmod(dealt, "lefts").cast("int"), "j": every("rights"), "side": F.lit(0)})
        .select(*columns)
    )
    right = held.withColumns({"j": F.pmod(dealt, "rights").cast("int"), "i": every("lefts"), "side": F.lit(1)}).select(*columns)
    return left.unionByName(right).groupBy("region", "i", "j").applyInArrow(_tile_links(forest), "a long, b long")


def _as_links(joined: DataFrame) -> DataFrame:
    """Components found so far as stars, for more links to be added to."""
    return joined.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))


def _finished(
    names: DataFrame, links: DataFrame, unlinked: DataFrame, dense: DataFrame, texts: DataFrame, forest: Forest
) -> DataFrame:
    """``node``, ``root`` of all linked classes, with dense regions compared in full.

    ``unlinked`` holds the candidate pairs that were in two components before the last links.
    """
    linked = written(components(links), "linked")
    dense = written(dense, "dense")
    if dense.isEmpty():
        return linked
    root = lambda side: linked.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    held = (
        unlinked.join(root("a"), "a", "left")
        .join(root("b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        .where("a <> b")
    )
    regions = components(held).select(F.col("node").alias("root"), F.col("root").alias("region"))
    rooted = names.join(linked, "node", "left").select("node", "n_shingles", F.coalesce("root", "node").alias("root"))
    members = written(rooted.join(regions, "root"), "members")
    wanted = members.join(dense, "node", "left_semi").select("region").distinct()
    members = written(members.join(wanted, "region", "left_semi"), "regions")
    sets = _sets(texts.join(members.select("node"), "node", "left_semi"), forest)
    more = written(_dense_links(members, written(sets, "sets"), forest), "links")
    if more.isEmpty():
        return linked
    return components(more.unionByName(_as_links(linked)))


ROW = ["doc_key", "text_id"]  # what tells rows apart


def _repeated(rows: DataFrame) -> DataFrame:
    """Identities that several rows share."""
    key = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_key"), "text_id")
    return written(key.groupBy(*ROW).count().where("count > 1").select(*ROW), "repeated")


def _one_row_each(texts: DataFrame, keys: DataFrame, repeated: DataFrame) -> DataFrame:
    """The row of each key. Only texts of repeated rows go through a shuffle to drop repeats."""
    single = matched(texts, keys.join(repeated, ROW, "left_anti"), ROW)
    several = matched(texts, keys.join(repeated, ROW, "left_semi"), ROW).dropDuplicates(ROW)
    return single.unionByName(several)


def near_duplicates(documents: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (and text_id, set_a, set_b) for every row."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_id", F.xxhash64("text"))
    rows = written(
        texts.mapInArrow(
            _fingerprints(forest),
            "doc_id long, text_id long, n_shingles long, set_a long, set_b long, signature binary, sketch binary",
        ),
        "fingerprints",
    )
    some = rows.where("n_shingles > 0")
    shown = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_key"), "text_id")
    classes = written(
        some.groupBy("set_a", "set_b")
        .agg(
            F.min(shown).alias("shown"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    names = classes.select("node", "n_shingles", "set_a", "set_b", "shown.doc_key", "shown.text_id")
    pairs, dense = candidates(classes, forest)
    pairs = written(pairs, "pairs")
    nodes = (
        pairs.select(F.col("a").alias("node"))
        .unionByName(pairs.select(F.col("b").alias("node")))
        .distinct()
    )
    wanted = written(names.join(nodes, "node").select("node", "doc_key", "text_id"), "wanted")
    keyed = texts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_key"), "text_id", "text")
    chosen = written(_one_row_each(keyed, wanted, _repeated(rows)).select("node", "text"), "texts")
    turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "estimate")
    best = (
        pairs.unionByName(turned)
        .groupBy("a")
        .agg(F.max(F.struct("estimate", "b")).alias("best"))
        .select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b"))
        .distinct()
    )
    joined = components(_confirmed(best, chosen, forest))
    root = lambda side: joined.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
    unlinked = written(
        pairs.join(root("a"), "a", "left")
        .join(root("b"), "b", "left")
        .where("coalesce(root_a, a) <> coalesce(root_b, b)")
        .select("a", "b"),
        "unlinked",
    )
    second = written(_confirmed(unlinked.join(best, ["a", "b"], "left_anti"), chosen, forest), "links")
    joined = _finished(names, second.unionByName(_as_links(joined)), unlinked, dense, chosen, forest)
    named = names.drop("n_shingles").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_key").alias("component_id"))
    labels = named.join(least, "root").select(
        "set_a", "set_b", F.when(F.col("component_id") < NO_ID, F.col("component_id")).alias("component_id")
    )
    slim = rows.drop("signature", "sketch")
    full = slim.where("n_shingles > 0").join(labels, ["set_a", "set_b"])
    empty = slim.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return full.unionByName(empty).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_id",
        "set_a",
        "set_b",
    )


def deduplicated(documents: DataFrame, forest: Forest = Forest()) -> DataFrame:
    """The rows of ``documents`` without near-duplicates: one row of each component.

    It is the row that names the component; of repeated rows, and of rows without an id, one stays.
    Texts are joined with the short keys of the rows that stay. Rows without words are
    duplicates of nothing but their own repetitions.
    """
    found = written(near_duplicates(documents, forest), "components")
    row = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_key"), "text_id")
    staying = written(
        found.where("kept")
        .groupBy(
            F.coalesce("component_id", F.lit(NO_ID)).alias("component"),
            F.when(F.col("component_id").isNull(), F.col("set_a")).alias("unnamed"),
        )
        .agg(F.min(row).alias("row"))
        .select("row.*")
        .distinct(),
        "staying",
    )
    # The caller's columns travel as one, so none can clash with the keys.
    keyed = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_key"),
        F.xxhash64(F.col("text").cast("string")).alias("text_id"),
        F.struct(*[F.col(c) for c in documents.columns]).alias("row"),
    )
    return _one_row_each(keyed, staying, _repeated(found)).select("row.*")
