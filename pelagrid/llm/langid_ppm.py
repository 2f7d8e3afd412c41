"""Language identification by prediction by partial matching.

One variable-order byte context tree per language: counts of the byte that follows each
context of up to three bytes. A byte's code length is found by the longest context that
is in the tree; a byte not seen there costs the escape (method C: one count for each
different byte seen) and is coded by the next shorter context without the bytes already excluded,
down to equal shares of 256. So every context's probabilities add up to one, and a text's code
length under the frozen counts is exact. The language with the least total wins.

Spark counts 4-byte runs over all texts learned from (combined in each task, then by
one aggregation), and from them, over all runs, the counts of every shorter context. Trees hold
only what was seen, each language its own. They are bounded: of two- and of three-byte contexts a
language keeps its heaviest whole ones, up to its equal share of ``MAX_CELLS`` (context, byte)
cells; a byte after a context that was left out is coded by the next shorter one, whose counts
are complete. So no language loses its name, its bytes or its share to another.

Defined results: null texts and texts without any letter give ``und`` and score 0; with
nothing to learn from every text gives ``und``. Ties go to the first language in code point
order. The score is the posterior of the winner for equal priors. Only rows with a non-null ``lang``
and ``doc_id`` that are not held out are learned from. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagrid.llm import text as tx
from pelagrid.llm.graph import written

HELD_OUT_MODULUS, HELD_OUT_REST = 3, 1
UNKNOWN = "und"
MAX_CELLS = 6_000_000  # cells of one order over all languages
ORDERS = (0, 1, 2, 3)  # bytes of context
PAD = b"\n\n\n"  # context before the first byte
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(
        F.crc32(doc_id.cast("string")) % HELD_OUT_MODULUS == HELD_OUT_REST, F.lit(False)
    )


def runs(chunk: tx.Chunk) -> np.ndarray:
    """For each byte the three bytes before it and itself, as one number."""
    data = chunk.data.astype(np.uint32)
    n = len(data)
    padded = np.concatenate([np.frombuffer(PAD, np.uint8).astype(np.uint32), data])
    # Bytes before a text's first are padding, whatever stands before it in the buffer.
    place = np.arange(n) - np.repeat(chunk.bounds[:-1], np.diff(chunk.bounds))
    out = data.copy()
    for back in (1, 2, 3):
        before = padded[3 - back : 3 - back + n]
        out |= np.where(place >= back, before, np.uint32(PAD[0])) << np.uint32(8 * back)
    return out


def _run_counts(batches):
    """(lang, run, n) counted within the task; flushed when the table grows large."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merged(parts):
        keys = np.concatenate([k for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], np.concatenate([n for _, n in parts])[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.add.reduceat(n, first)

    def rows():
        for lang, (keys, n) in held.items():
            columns = [pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "run", "n"])

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            own = batch.column("text").filter(pa.array([x == lang for x in langs]))
            parts = [held[lang]] if lang in held else []
            for chunk in tx.chunks(own):
                if len(chunk.data):
                    keys, n = np.unique(runs(chunk), return_counts=True)
                    parts.append((keys, n.astype(np.int64)))
            if parts:
                held[lang] = merged(parts)
        if sum(len(k) for k, _ in held.values()) > 4_000_000:
            yield from rows()
            held.clear()
    yield from rows()


class Order(NamedTuple):
    """One language's contexts of one length: bits of each (context, byte) seen, and the bits that
    an escape from each context costs; both by sorted keys."""

    cells: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    escapes: np.ndarray


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in sorted ``keys``, and which are there."""
    place = np.searchsorted(keys, wanted)
    place[place == len(keys)] = 0
    return place, keys[place] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _code_lengths(orders: list[Order], run: np.ndarray) -> np.ndarray:
    """Bits of the last byte of each run after those before it, from the longest order down."""
    out = np.zeros(len(run))
    left = np.arange(len(run))
    for length in reversed(range(len(orders))):
        order = orders[length]
        key = (run[left] & np.uint32((1 << 8 * (length + 1)) - 1)).astype(np.uint32)
        place, seen = _found(order.cells, key)
        out[left[seen]] += order.bits[place[seen]]
        left, key = left[~seen], key[~seen]
        place, known = _found(order.contexts, key >> np.uint32(8))
        out[left[known]] += order.escapes[place[known]]
    out[left] += 8.0  # equal shares of 256
    return out


def _order(shorter: list[Order], key: np.ndarray, n: np.ndarray) -> Order:
    """Method C with exclusion over sorted (context, byte) keys with their counts."""
    if len(key) == 0:
        none = np.zeros(0, np.uint32)
        return Order(none, np.zeros(0), none, np.zeros(0))
    contexts, first = np.unique(key >> np.uint32(8), return_index=True)
    total, kinds = np.add.reduceat(n, first), np.diff(np.append(first, len(key)))
    # What the shorter context gives to the bytes not seen here.
    left = 1 - np.add.reduceat(np.exp2(-_code_lengths(shorter, key)), first)
    open_ = (kinds < 256) & (left > 0)
    escape = np.where(open_, kinds / ((total + kinds) * np.where(open_, left, 1)), 1)
    share = n / np.repeat(np.where(open_, total + kinds, total), kinds)
    return Order(key, -np.log2(share), contexts, -np.log2(escape))


@dataclass(frozen=True)
class Model:
    """The context trees of every language, shortest order first."""

    langs: tuple[str, ...]
    trees: tuple[list[Order], ...]

    def bits(self, chunk: tx.Chunk) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(chunk.bounds) - 1, len(self.langs)))
        if len(chunk.data) == 0:
            return out
        different, at = np.unique(runs(chunk), return_inverse=True)
        some = np.diff(chunk.bounds) > 0
        begins = chunk.bounds[:-1][some]
        for k, orders in enumerate(self.trees):
            out[some, k] = np.add.reduceat(_code_lengths(orders, different)[at], begins)
        return out


def from_tables(langs: list[str], tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Model:
    """The model from (language number, key, count) of every order, shortest first."""
    trees = []
    for k in range(len(langs)):
        orders: list[Order] = []
        for lang, key, n in tables:
            own = lang == k
            by_key = np.argsort(key[own], kind="stable")
            orders.append(_order(orders, key[own][by_key].astype(np.uint32), n[own][by_key].astype(float)))
        trees.append(orders)
    return Model(tuple(langs), tuple(trees))


def build(langs: list[str], lang: np.ndarray, run: np.ndarray, n: np.ndarray) -> Model:
    """The model from counts of 4-byte runs; ``lang`` holds positions in ``langs``."""
    tables = []
    for length in ORDERS:
        key = (lang.astype(np.int64) << 32) | (run & ((1 << 8 * (length + 1)) - 1))
        different, at = np.unique(key, return_inverse=True)
        tables.append((different >> 32, different & 0xFFFFFFFF, np.bincount(at, weights=n, minlength=len(different))))
    return from_tables(langs, tables)


def _kept(table: DataFrame, cells: int) -> DataFrame:
    """Each language's heaviest contexts, whole, as long as their cells fit."""
    key = ["lang", F.shiftright("key", 8).alias("context")]
    contexts = table.groupBy(*key).agg(F.sum("n").alias("weight"), F.count("*").alias("kinds"))
    heaviest = W.partitionBy("lang").orderBy(F.desc("weight"), "context")  # 2 ** 24 contexts at most
    upto = F.sum("kinds").over(heaviest.rowsBetween(W.unboundedPreceding, 0))
    kept = contexts.withColumn("upto", upto).where(F.col("upto") <= cells).select("lang", "context")
    return table.withColumn("context", F.shiftright("key", 8)).join(kept, ["lang", "context"], "left_semi").drop("context")


def fit(documents: DataFrame) -> Model | None:
    """Count 4-byte runs of all learned texts and build the trees; None without any."""
    learned = documents.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
        & ~held_out(F.col("doc_id"))
    ).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = written(
        learned.mapInArrow(_run_counts, "lang string, run long, n long")
        .groupBy("lang", "run")
        .agg(F.sum("n").alias("n")),
        "runs",
    )
    names = sorted((r.lang for r in counts.select("lang").distinct().collect()), key=lambda x: x.encode())
    if not names:
        return None
    # Languages travel by number, so what the driver holds is numbers only.
    numbers = documents.sparkSession.createDataFrame(list(enumerate(names)), "lang int, name string")
    numbered = counts.join(F.broadcast(numbers), F.col("name") == counts["lang"]).select(numbers["lang"], "run", "n")
    cells = max(MAX_CELLS // len(names), 256)
    tables = []
    for length in ORDERS:
        key = F.col("run").bitwiseAND((1 << 8 * (length + 1)) - 1).alias("key")
        table = numbered.groupBy("lang", key).agg(F.sum("n").alias("n"))
        found = (_kept(written(table, "order"), cells) if length > 1 else table).toArrow()
        tables.append(tuple(found.column(c).to_numpy() for c in ("lang", "key", "n")))
    return from_tables(names, tables)


def with_language(documents: DataFrame, model: Model | None) -> DataFrame:
    """All columns of ``documents`` with ``lang_pred`` and ``score``."""
    if model is None:
        return documents.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        trees = shared.value
        names, scores = [], []
        for chunk in tx.chunks(texts):
            bits = trees.bits(chunk)
            best = bits.argmin(1)
            odds = np.exp2(np.clip(bits.min(1)[:, None] - bits, -1000, 0))
            likely = 1 / odds.sum(1)
            for k in range(len(best)):
                whole = texts[chunk.first + k].as_py()
                known = whole is not None and _LETTER.search(whole) is not None
                names.append(trees.langs[best[k]] if known else UNKNOWN)
                scores.append(float(likely[k]) if known else 0.0)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    return (
        documents.withColumn("_ppm", predict(F.col("text")))
        .withColumns({"lang_pred": F.col("_ppm.lang_pred"), "score": F.col("_ppm.score")})
        .drop("_ppm")
    )


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    own = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    return with_language(own, fit(documents)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
