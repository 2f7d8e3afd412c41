"""A corpus pipeline over ``documents``: five stages, each written and read again by the next.

Rejected by quality, near-duplicates (one document of each group stays), contaminated
by a benchmark, mixed to the sources' target weights, and put on shards. Stages but the
last return the columns of ``documents`` and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagrid.llm import curriculum, decontaminate, forest, quality_qda, sharding
from pelagrid.llm.graph import matched, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant trained on ``labels`` does not reject."""
    model = quality_qda.fit(docs, _table(spark, sf_dir, "labels"))
    score = "_quality_score"
    return (
        quality_qda.with_score(docs, model, score)
        .where(F.col(score) >= quality_qda.THRESHOLD)
        .select(*docs.columns)
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return forest.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document, in training order; a document that the
    last pass cuts is kept whole.

    The schedule is made of short rows, known by a hash of all columns (wholly equal rows are
    one there); whole rows only go through the final sort.
    """
    columns = [F.col(c) for c in docs.columns]
    a, b = F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(7), *columns).alias("b")
    placed = curriculum.schedule(docs.select("doc_id", "source", "text", a, b))
    copies = written(placed.select("a", "b", F.inline("copies")), "copies")
    repeated = written(docs.select(a, b).groupBy("a", "b").count().where("count > 1").drop("count"), "repeated")
    whole = docs.select(a, b, F.struct(*columns).alias("row"))
    keys = ["a", "b"]
    single = matched(whole, copies.join(repeated, keys, "left_anti"), keys)
    several = matched(
        matched(whole, repeated, keys).dropDuplicates(keys), copies.join(repeated, keys, "left_semi"), keys
    )
    return single.unionByName(several).orderBy("position", "a", "b").select("row.*")


def sharding_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot."""
    return sharding.assign(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding_),
]

# A trained model, MinHash candidates and label propagation have no SQL form; the tests compare
# every stage and the whole run with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every stage's rows are written below the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
