"""Sharding by balanced label propagation.

Documents start on shards dealt out evenly in hash order. Each round counts, by joins, how
many of a link's documents every shard has; a document that would have more neighbours on another shard
asks to move there. Moves are granted under quotas that leave every count as it was: requests
between two shards are first swapped one for one; further requests into a shard are granted
up to its documents without any neighbour, which give way to the shards
that lost documents. So shards stay equal in rows after every round (law ``rows``: counts at most one
apart) while edges between shards are cut less and less.

A link key (here: equal texts) joins all documents that carry it; pairs are never listed. A
group larger than a shard fills one and goes on with the next. Requests of a group are granted
together, by a priority drawn for the group. Ranks run over range-sorted slices and what
reaches the driver is one count for each pair of shards.

Defined results: null text is an empty text of size 1 and all of them are one group;
repeated rows are members of one group with slots of their own; with fewer documents
than shards some shards stay empty. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import AT, SLICE, running, sliced, written


@dataclass(frozen=True)
class Plan:
    shards: int = 16
    rounds: int = 12  # at most; stops when no document asks to move


def _identity(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("link_a"), F.xxhash64(F.lit(7), text).alias("link_b")]


def rows_of(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the link of equal texts for every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *_identity(text),
    )


LINK = ["link_a", "link_b"]


def _index(ordered: DataFrame, groups: list[str], name: str) -> DataFrame:
    return running(ordered.withColumn("_one", F.lit(1)), groups, "_one", name).drop("_one")


def _requests(placed: DataFrame, capacity: int, round_: int) -> DataFrame:
    """link, shard and target for the cells (link, shard) that ask to move.

    A link's documents agree on the shard with most of them (ties by a hash), among
    shards that they do not fill already and that still have documents which can give
    way. Documents there, or on a shard they fill, stay.
    """
    open_shards = [r.shard for r in placed.where("alone").select("shard").distinct().collect()]
    eligible = F.col("n") < capacity
    if open_shards:
        eligible = eligible & F.col("shard").isin(open_shards)
    cells = placed.groupBy(*LINK, "shard").agg(F.count("*").alias("n"))
    entry = F.struct(
        F.col("n"), F.xxhash64(*LINK, "shard", F.lit(round_)).alias("tie"), F.col("shard")
    )
    best = cells.groupBy(*LINK).agg(
        F.max(F.when(eligible, entry)).alias("best"), F.sum("n").alias("all")
    )
    return (
        cells.join(best, LINK)
        .where((F.col("all") > 1) & (F.col("n") < capacity) & (F.col("shard") != F.col("best.shard")))
        .select(*LINK, F.col("shard"), F.col("best.shard").alias("target"))
    )


def propagate(linked: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``linked`` (with columns link_a, link_b) and its ``shard``, counts at most one apart."""
    order = [F.xxhash64(F.col("doc_id").cast("string"), *[F.col(c) for c in LINK]), "doc_id", *LINK]
    dealt = _index(sliced(linked, order, "dealt"), [], "_index").drop(SLICE, AT)
    sizes = dealt.groupBy(*LINK).agg((F.count("*") == 1).alias("alone"))
    # The row's number is its name from here on.
    placed = written(
        dealt.join(sizes, LINK).withColumn("shard", (F.col("_index") % plan.shards).cast("int")), "placed"
    )
    total = placed.count()
    capacity = max(total // plan.shards, 1)
    for round_ in range(plan.rounds):
        asked = written(_requests(placed, capacity, round_), "requests")
        if asked.isEmpty():
            break
        moves = placed.join(asked, [*LINK, "shard"], "left")
        # Requests of one pair of shards in group order; then singles, to give way, in theirs.
        keyed = moves.withColumns(
            {"kind": F.when(F.col("target").isNotNull(), 0).when(F.col("alone"), 1).otherwise(2),
             "_priority": F.xxhash64(*LINK, F.lit(round_))}
        )
        lined = _index(
            sliced(keyed, ["kind", "shard", "target", "_priority", *LINK, "_index"], "lined"),
            ["kind", "shard", "target"], "_rank",
        ).drop(SLICE, AT, "_priority")
        lined = written(lined, "ranked")
        counts = {
            (r.kind, r.shard, r.target): r["n"]
            for r in lined.where("kind < 2").groupBy("kind", "shard", "target").agg(F.count("*").alias("n")).collect()
        }  # one row for each pair of shards
        granted, gives, gets = _quotas(counts, plan.shards)
        placed = written(_moved(lined, granted, gives, gets), "placed")
        if not any(granted.values()):
            break
    return placed.drop("alone", "_index")


def _quotas(counts: dict, shards: int) -> tuple[dict, dict, list]:
    """Moves granted for each (from, to); singles that each shard gives; where they go.

    Swaps first. Then requests into a shard up to its singles: what enters beyond
    what leaves is made up by singles, which go to the shards that lost.
    """
    asked = {(s, t): n for (kind, s, t), n in counts.items() if kind == 0}
    singles = {s: n for (kind, s, _), n in counts.items() if kind == 1}
    granted = {(s, t): min(n, asked.get((t, s), 0)) for (s, t), n in asked.items()}
    room = dict(singles)
    for s, t in sorted(asked, key=lambda x: (-asked[x], x)):
        more = min(asked[s, t] - granted[s, t], room.get(t, 0))
        granted[s, t] += more
        room[t] = room.get(t, 0) - more
    surplus = {
        s: sum(n for (_, t), n in granted.items() if t == s) - sum(n for (f, _), n in granted.items() if f == s)
        for s in range(shards)
    }
    gives = {s: n for s, n in surplus.items() if n > 0}
    gets = [(s, -n) for s, n in surplus.items() if n < 0]
    return granted, gives, gets


def _moved(lined: DataFrame, granted: dict, gives: dict, gets: list) -> DataFrame:
    """The new shard of every row; the tables inside have a row for each pair of shards."""
    def choice(keys: dict, column: Column) -> Column:
        table = F.create_map(*[F.lit(x) for kv in keys.items() for x in kv]) if keys else None
        return F.coalesce(F.get(F.array(table), F.lit(0))[column], F.lit(0)) if keys else F.lit(0)

    pair = F.concat_ws(">", "shard", "target")
    wins = F.col("_rank") < choice({f"{s}>{t}": n for (s, t), n in granted.items()}, pair)
    # Singles that give way stand in one line over all giving shards.
    starts, at = {}, 0
    for s, n in sorted(gives.items()):
        starts[s] = at
        at += n
    goes = F.col("_rank") < choice(gives, F.col("shard"))
    place = F.col("_rank") + choice(starts, F.col("shard"))
    home, end = F.col("shard"), 0
    bounds = []
    for s, n in gets:
        end += n
        bounds.append((end, s))
    for end, s in reversed(bounds):
        home = F.when(place < end, F.lit(s)).otherwise(home)
    shard = (
        F.when((F.col("kind") == 0) & wins, F.col("target"))
        .when((F.col("kind") == 1) & goes, home)
        .otherwise(F.col("shard"))
    )
    return lined.withColumn("shard", shard.cast("int")).drop("kind", "target", "_rank")


def assign(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the group of every row."""
    placed = propagate(rows_of(documents), plan)
    ordered = sliced(placed, ["shard", *LINK, "doc_id"], "shards")
    return _index(ordered, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *LINK,
    )
