"""Ranked lexical search over a frequency-ordered tree of documents.

1. Every text is cut into terms once. A document keeps its number of terms and the counts of
   those terms that some item asks for (its restricted vector).
2. Spark counts documents, terms and the documents of each asked term.
3. A restricted vector with the most frequent term first is a path. Rows are range-sorted by
   path, so documents that share a beginning of their paths meet in one task, and a path that
   a third of all rows share is split by row. A task builds a tree of shared paths for each
   block of rows: nodes are ranges of the sorted rows, kept with the largest count of every
   term below them and the smallest length figure.
4. For each item the tree is searched depth first, the most promising child first. A subtree
   whose bound (largest counts, smallest length figure) is below the item's last kept score is
   left out; no subtree that could hold a result is. What an item keeps is carried from block
   to block. Tasks' lists are merged in two steps.

Items are taken in blocks of about ``ITEM_TERMS`` terms, each against all rows, so the terms
held by a task do not grow with the number of items.

Defined results: a null or empty text, or one without a term, is no document (it counts in no
figure). Items with the same id (null is an id) are one item with the terms of all its rows;
without terms it has no results. Repeated documents rank each on their own row; equal scores
stand by doc_id, null last. Other columns are not looked at. Terms are told apart by 64-bit
hashes of their bytes. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagrid.llm import text as tx
from pelagrid.llm.graph import written

TOP = 50
SCALE = 1_000_000_000
ITEM_TERMS = 500_000  # (item, term) pairs that a task holds at once
LEAF_ROWS = 64  # rows that are scored together at the foot of a tree
BLOCK_ENTRIES = 1_000_000  # (document, term) pairs in one tree
RANGE_TERMS = 8  # terms of a path that place it in a range

# ASCII digits and letters, and every byte of a code point beyond ASCII.
IS_TERM = np.zeros(256, bool)
IS_TERM[0x30:0x3A] = IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True


def _terms(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of a chunk and where each text's terms begin and end."""
    at = tx.spans(IS_TERM[chunk.data], chunk.bounds)
    return tx.span_hashes(tx.prefix_hashes(tx.LOWER[chunk.data]), at), at.of


def item_terms(items: DataFrame, block: int = ITEM_TERMS) -> list[tuple[list, np.ndarray, np.ndarray]]:
    """Blocks of items: ids, the pairs' item numbers and the pairs' term hashes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tx.chunks(batch.column(1)):
                hashes, of = _terms(chunk)
                ids = batch.column(0).take(pa.array(chunk.first + tx.owners(of)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(hashes.view(np.int64))], ["item_id", "term"])

    pairs = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    pairs = written(pairs.mapInArrow(cut, "item_id long, term long").distinct(), "item-terms")
    blocks = max(1, math.ceil(pairs.count() / block))
    dealt = pairs.withColumn("_block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    found = []
    for b in range(blocks):
        own = dealt.where(F.col("_block") == b).toArrow()
        ids, terms = own.column("item_id").combine_chunks(), own.column("term").to_numpy().view(np.uint64)
        names = ids.dictionary_encode(null_encoding="encode")
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        found.append((names.dictionary.to_pylist(), names.indices.to_numpy(zero_copy_only=False).astype(np.int64), terms))
    return found


def restricted(documents: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id``, ``n`` terms, and the places in ``vocabulary`` (sorted hashes) with their counts."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tx.chunks(batch.column(1)):
                hashes, of = _terms(chunk)
                rows, whose = len(of) - 1, tx.owners(of)
                place = np.searchsorted(vocabulary, hashes)
                place[place == len(vocabulary)] = 0
                known = vocabulary[place] == hashes if len(vocabulary) else np.zeros(len(hashes), bool)
                keys, counts = np.unique(whose[known] * len(vocabulary) + place[known], return_counts=True)
                ends = np.searchsorted(keys, np.arange(rows + 1) * max(len(vocabulary), 1)).astype(np.int32)
                listed = lambda values: pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, rows),
                        pa.array(np.diff(of).astype(np.int64)),
                        listed((keys % max(len(vocabulary), 1)).astype(np.int32)),
                        listed(counts.astype(np.int32)),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )
                yield out.filter(pa.array(np.diff(of) > 0))

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(vectors, "doc_id long, n long, terms array<int>, counts array<int>")


def length_figures(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """``100 - 50 + ((50 * n * N) div L)``, in Python integers where 64 bits could overflow."""
    if int(n.max(initial=0)) * 50 * documents < 1 << 62:
        return 50 + (50 * n * documents) // terms
    return np.array([50 + 50 * int(v) * documents // terms for v in n], np.int64)


def parts(counts: np.ndarray, figures: np.ndarray) -> np.ndarray:
    """What one unit of weight adds at a count and a length figure: falls with the figure, rises with the count."""
    return (SCALE * counts) // (1000 * counts + 20 * figures)


class Tree:
    """Shared paths of sorted rows; each node is a range of rows with its largest counts."""

    def __init__(self, paths: list[np.ndarray], counts: list[np.ndarray], figures: np.ndarray) -> None:
        self.ends = np.zeros(len(paths) + 1, np.int64)
        np.cumsum([len(p) for p in paths], out=self.ends[1:])
        self.figures = figures
        self.entry_terms = np.concatenate(paths) if paths else np.zeros(0, np.int64)
        self.entry_counts = np.concatenate(counts).astype(np.int64) if paths else np.zeros(0, np.int64)
        self.entry_rows = np.repeat(np.arange(len(paths)), np.diff(self.ends))
        self.first: list[int] = []
        self.last: list[int] = []
        self.children: list[list[int]] = []
        self._grow(len(paths), self._shared())
        self._sum_up()

    def _shared(self) -> np.ndarray:
        """How many terms each row's path shares with the row before it."""
        lengths = np.diff(self.ends)
        shared = np.zeros(len(lengths), np.int64)
        rows, depth = np.arange(1, len(lengths)), 0
        while len(rows):
            rows = rows[(lengths[rows] > depth) & (lengths[rows - 1] > depth)]
            rows = rows[self.entry_terms[self.ends[rows] + depth] == self.entry_terms[self.ends[rows - 1] + depth]]
            depth += 1
            shared[rows] = depth
        return shared

    def _node(self, first: int, last: int) -> int:
        self.first.append(first)
        self.last.append(last)
        self.children.append([])
        return len(self.first) - 1

    def _grow(self, rows: int, shared: np.ndarray) -> None:
        """Branch where paths part; small neighbouring branches stay together."""
        open_nodes = [self._node(0, rows)]
        while open_nodes:
            node = open_nodes.pop()
            first, last = self.first[node], self.last[node]
            if last - first <= LEAF_ROWS:
                continue
            inner = shared[first + 1 : last]
            cuts = np.flatnonzero(inner == inner.min()) + first + 1
            edges = [first, *cuts.tolist(), last]
            start = first
            for i in range(1, len(edges)):
                following = edges[i + 1] if i + 1 < len(edges) else None
                if following is not None and following - start <= LEAF_ROWS:
                    continue
                child = self._node(start, edges[i])
                self.children[node].append(child)
                open_nodes.append(child)
                start = edges[i]

    def _sum_up(self) -> None:
        """Largest count of each term and smallest figure below every node, children first."""
        own: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        low = np.zeros(len(self.first), np.int64)
        terms, nodes, counts = [], [], []
        for node in range(len(self.first) - 1, -1, -1):
            children = self.children[node]
            if children:
                t = np.concatenate([own[c][0] for c in children])
                v = np.concatenate([own.pop(c)[1] for c in children])
                low[node] = low[children].min()
            else:
                a, b = self.ends[self.first[node]], self.ends[self.last[node]]
                t, v = self.entry_terms[a:b], self.entry_counts[a:b]
                low[node] = self.figures[self.first[node] : self.last[node]].min(initial=1 << 40)
            order = np.argsort(t, kind="stable")
            t, v = t[order], v[order]
            starts = np.flatnonzero(np.r_[True, t[1:] != t[:-1]]) if len(t) else np.zeros(0, np.int64)
            own[node] = t[starts], (np.maximum.reduceat(v, starts) if len(t) else v)
            terms.append(own[node][0])
            counts.append(own[node][1])
            nodes.append(np.full(len(starts), node))
        term, node, count = map(np.concatenate, (terms, nodes, counts))
        order = np.argsort(term, kind="stable")
        self.terms, self.starts = np.unique(term[order], return_index=True)
        self.starts = np.append(self.starts, len(order))
        self.nodes, self.unit = node[order], parts(count[order], low[node[order]])

    def bounds(self, asked: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """For every node at least the best score below it."""
        place = np.searchsorted(self.terms, asked)
        place[place == len(self.terms)] = 0
        known = self.terms[place] == asked if len(self.terms) else np.zeros(len(asked), bool)
        a, b = self.starts[place[known]], self.starts[place[known] + 1]
        sizes = b - a
        at = np.arange(sizes.sum()) + np.repeat(a - np.r_[0, np.cumsum(sizes)[:-1]], sizes)
        # Below 2 ** 53, so sums of doubles are exact.
        return np.bincount(self.nodes[at], np.repeat(weights[known], sizes) * self.unit[at], len(self.first))

    def search(self, asked: np.ndarray, weights: np.ndarray, dense: np.ndarray, kept: Kept) -> None:
        """Offer every row that could be among the kept ones; ``dense`` is a scratch row of zeros."""
        bound = self.bounds(asked, weights).tolist()
        dense[asked] = weights
        stack = [0]
        while stack:
            node = stack.pop()
            if bound[node] <= 0 or bound[node] < kept.least:
                continue
            if self.children[node]:
                stack.extend(sorted(self.children[node], key=bound.__getitem__))
                continue
            first, last = self.first[node], self.last[node]
            a, b = self.ends[first], self.ends[last]
            weight = dense[self.entry_terms[a:b]]
            hit = np.flatnonzero(weight)
            rows = self.entry_rows[a:b][hit]
            gain = weight[hit] * parts(self.entry_counts[a:b][hit], self.figures[rows])
            scores = np.bincount(rows - first, gain, last - first).astype(np.int64)
            good = np.flatnonzero((scores > 0) & (scores >= kept.least))
            if len(good):
                kept.offer(scores[good], first + good)
        dense[asked] = 0


class Kept:
    """The best rows of one item so far: score falling, then document id, null last."""

    def __init__(self, top: int) -> None:
        self.top, self.least = top, 0
        self.scores = np.zeros(0, np.int64)
        self.ids, self.unnamed = np.zeros(0, np.int64), np.zeros(0, bool)
        self.block: tuple[np.ndarray, np.ndarray] = (self.ids, self.unnamed)

    def offer(self, scores: np.ndarray, rows: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, self.block[0][rows]])
        unnamed = np.concatenate([self.unnamed, self.block[1][rows]])
        best = np.lexsort((ids, unnamed, -scores))[: self.top]
        self.scores, self.ids, self.unnamed = scores[best], ids[best], unnamed[best]
        if len(best) == self.top:
            self.least = int(self.scores[-1])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in runs of about ``BLOCK_ENTRIES`` entries."""
    for batch in batches:
        ends = batch.column("path").offsets.to_numpy() - batch.column("path").offsets[0].as_py()
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(ends, ends[first] + BLOCK_ENTRIES, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def _lists(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(), column.offsets.to_numpy()
    ends = ends - ends[0]
    return [values[a:b].astype(np.int64) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _rank_block(vectors: DataFrame, vocabulary: np.ndarray, block: tuple, top: int) -> DataFrame:
    """Results of one block of items over all restricted vectors."""
    names, owners, hashes = block
    figures = vectors.agg(F.count("*").alias("rows"), F.sum("n").alias("terms")).first()
    documents, length = figures.rows, figures.terms or 0
    holders = np.zeros(len(vocabulary), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        holders[r.t] = r["count"]  # one row for each term of the block's items
    frequency_order = np.argsort(-holders, kind="stable")
    rank = np.empty(len(vocabulary), np.int64)
    rank[frequency_order] = np.arange(len(vocabulary))
    weight = np.array(
        [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(h) + 1))) for h in holders[frequency_order]], np.int64
    )
    asked = rank[np.searchsorted(vocabulary, hashes)]
    order = np.lexsort((asked, owners))
    asked, edges = asked[order], np.searchsorted(owners[order], np.arange(len(names) + 1))

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = batch.column("terms"), batch.column("counts")
            ends = terms.offsets.to_numpy() - terms.offsets[0].as_py()
            rows = np.repeat(np.arange(len(terms)), np.diff(ends))
            places = rank[terms.flatten().to_numpy()]
            order = np.lexsort((places, rows))
            listed = lambda values: pa.ListArray.from_arrays(
                pa.array(ends.astype(np.int32)), pa.array(values[order].astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(length_figures(batch.column("n").to_numpy(), documents, length)),
                    listed(places),
                    listed(counts.flatten().to_numpy()),
                ],
                ["doc_id", "figure", "path", "counts"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Kept(top) for _ in names]
        dense = np.zeros(len(vocabulary), np.int64)
        for rows in _blocks(batches):
            tree = Tree(_lists(rows.column("path")), _lists(rows.column("counts")), rows.column("figure").to_numpy())
            ids = rows.column("doc_id")
            ids = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            for i, best in enumerate(kept):
                own = asked[edges[i] : edges[i + 1]]
                best.block = ids
                tree.search(own, weight[own], dense, best)
        for i, best in enumerate(kept):
            if len(best.scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[i]] * len(best.scores), pa.int64()),
                        pa.array(best.ids, mask=best.unnamed),
                        pa.array(best.scores),
                    ],
                    ["item_id", "doc_id", "score"],
                )

    shaped = vectors.where(F.size("terms") > 0).mapInArrow(
        paths, "doc_id long, figure long, path array<int>, counts array<int>"
    )
    tied = shaped.withColumn("_tie", F.monotonically_increasing_id())
    # Ranges by the beginnings of paths: their samples go to the driver.
    ranges = tied.repartitionByRange(F.slice("path", 1, RANGE_TERMS), "_tie")
    laid = ranges.sortWithinPartitions("path", "_tie").drop("_tie")
    return laid.mapInArrow(search, "item_id long, doc_id long, score long")


def rank(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of each item's best documents."""
    found = None
    for block in item_terms(items):
        vocabulary = np.unique(block[2])
        vectors = written(restricted(documents, vocabulary), "restricted")
        own = _rank_block(vectors, vocabulary, block, top)
        found = own if found is None else found.unionByName(own)
    # Lists of tasks are merged in two steps, so no task takes those of all others.
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(64))
    for salted in (True, False):
        keys = ["item_id", "_part"] if salted else ["item_id"]
        lists = found.withColumn("_part", part) if salted else found
        found = lists.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= top)
        found = found.drop("rank", "_part") if salted else found
    return found.select("item_id", "rank", "doc_id", "score")
