"""Near-duplicates, shards, the mix and components against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pelagrid.llm import curriculum, forest, graph, sharding
from pelagrid.llm import text as tx

DOCS = "doc_id long, text string, source string, size long, kept boolean, shard int"


def brute_components(rows, width, percent):
    """doc_id to component for rows (doc_id, text), by comparing all pairs of sets."""
    def grams(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
        if len(words) < width:
            return frozenset([tuple(words)]) if words else frozenset()
        return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))

    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


@pytest.fixture(scope="module")
def near_rows():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = [draw.choice(words) for _ in range(draw.randint(30, 200))]
        for _ in range(draw.randint(1, 12)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((n := n + 1, " ".join(copy)))
    common = " ".join(words[:12])
    rows += [(n + i, f"{common} {' '.join(draw.choice(words) for _ in range(40))}") for i in range(1, 60)]
    n += 60
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "one"), (n + 4, "ONE"), (n + 5, "one two"), (n + 6, "two one")]
    rows += [(3, rows[2][1]), (None, rows[10][1]), (None, "only here and nowhere else at all"), (n + 7, "x y " * 9000)]
    rows += [(n + 8 + i, "The Same text over\tand over") for i in range(50)]
    return rows


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_forest_equals_brute_force(frame, near_rows, width, percent):
    docs = frame([(d, t, "s", 1, True, 2) for d, t in near_rows], DOCS)
    found = forest.near_duplicates(docs, forest.Forest(width, percent)).collect()
    wanted = brute_components(near_rows, width, percent)
    key = lambda r: tuple((x is None, x) for x in r)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in found]
    assert sorted(got, key=key) == sorted(wanted, key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_forest_keeps_one_row_of_each_component(frame, near_rows):
    docs = frame([(d, t, "s", 1, True, 2) for d, t in near_rows], DOCS)
    kept = forest.deduplicated(docs).collect()
    wanted = brute_components(near_rows, 5, 80)
    assert docs.columns == list(kept[0].asDict())
    ids = sorted((r.doc_id for r in kept if r.doc_id is not None))
    assert ids == sorted({c for _, _, c in wanted if c is not None})
    assert sum(r.doc_id is None for r in kept) == 1
    assert forest.deduplicated(docs.limit(0)).count() == 0


def test_forest_finds_a_dense_group_over_partition_edges(spark, frame):
    draw = random.Random(9)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(600):
        copy = list(base)
        for _ in range(2):
            copy[draw.randrange(120)] = f"z{draw.randrange(999)}"
        rows.append((i, " ".join(copy), "s", 0, True, 0))
    found = forest.near_duplicates(frame(rows, DOCS), forest.Forest(3, 85))
    assert found.where("component_id = 0").count() > 590
    wanted = brute_components([r[:2] for r in rows], 3, 85)
    assert sorted(r.component_id for r in found.collect()) == sorted(c for _, _, c in wanted)


def test_shared_counts_equal_plain_intersections(monkeypatch):
    monkeypatch.setattr(forest, "TILE_COLUMNS", 7)
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 30, 59, 200, 2)]
    got = forest.shared_counts(sets[:4], sets[3:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[3:]] for a in sets[:4]]
    assert forest.shared_counts(sets[:1], [sets[0] + np.uint64(1000)]).tolist() == [[0]]


@pytest.fixture(scope="module")
def crowd():
    """Variants of one text about 0.79 alike, and closer copies of some of them."""
    draw = random.Random(11)
    base = [f"v{i}" for i in range(200)]

    def changed(words, n):
        copy = list(words)
        for at in draw.sample(range(200), n):
            copy[at] = f"z{draw.randrange(10**6)}"
        return copy

    texts = [changed(base, draw.choice((3, 4, 5))) for _ in range(2000)]
    texts += [changed(draw.choice(texts), 3) for _ in range(150)]
    return [(i, " ".join(t), "s", 0, True, 0) for i, t in enumerate(texts)]


def crowd_components(rows, width, percent):
    """Components of all pairs by one exact count of shared shingles."""
    sets = []
    ids = {}
    for _, text, *_ in rows:
        w = text.split()
        sets.append({ids.setdefault(tuple(w[i : i + width]), len(ids)) for i in range(len(w) - width + 1)})
    held = np.zeros((len(sets), len(ids)), np.float32)
    for row, s in zip(held, sets, strict=True):
        row[list(s)] = 1
    shared = (held @ held.T).astype(int)
    sizes = np.array([len(s) for s in sets])
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    label = np.arange(len(sets))
    while True:
        least = np.array([label[row].min() for row in linked])
        if (least == label).all():
            return label.tolist(), int(linked.sum() - len(sets)) // 2
        label = least[least]


def test_no_link_is_lost_in_a_crowd(frame, crowd):
    wanted, links = crowd_components(crowd, 3, 85)
    assert links > 1000 and 100 < len(set(wanted)) < 2100
    found = forest.near_duplicates(frame(crowd, DOCS).repartition(5), forest.Forest(3, 85)).collect()
    assert [r.component_id for r in sorted(found, key=lambda r: r.doc_id)] == wanted


def test_components_of_a_path_a_star_and_a_pair(frame):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(9, 9), (501, 500)]
    got = {r.node: r.root for r in graph.components(frame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(50)} == {1000}
    assert got[501] == got[500] == 500
    assert graph.components(frame([], "a long, b long")).count() == 0


def test_components_that_are_stars_take_no_round(frame, monkeypatch):
    plain, labels = graph.written, []
    monkeypatch.setattr(graph, "written", lambda df, label: labels.append(label) or plain(df, label))
    stars = [(9, 1), (1, 8), (7, 2), (7, 2), (5, 5)]
    got = {r.node: r.root for r in graph.components(frame(stars, "a long, b long")).collect()}
    assert got == {9: 1, 8: 1, 1: 1, 7: 2, 2: 2}
    assert labels == ["edges"]
    # A root on another root, and a node on two roots, are no stars.
    for more, roots in (((1, 0), {0, 2}), ((9, 2), {1}), ((8, 7), {1})):
        got = graph.components(frame([*stars[:3], more], "a long, b long")).collect()
        assert {r.root for r in got} == roots


def test_word_hashes_do_not_depend_on_place():
    texts = pa.array(["alpha beta", None, "", "beta alpha  beta", "ünï ñ"])
    (chunk,) = tx.chunks(texts)
    at = tx.words(chunk)
    hashes = tx.span_hashes(tx.prefix_hashes(chunk.data), at)
    assert np.diff(at.of).tolist() == [2, 0, 0, 3, 2]
    assert hashes[1] == hashes[2] == hashes[4] and hashes[0] == hashes[3] and len(set(hashes.tolist())) == 4
    assert [c.last - c.first for c in tx.chunks(texts, 4)] == [1, 2, 1, 1]


def shard_rows():
    rows = [(i, f"text {i}", "s", 0, True, 9) for i in range(300)]
    rows += [(1000 + i, f"group {i % 20}", "s", 0, True, 9) for i in range(100)]
    rows += [(2000 + i, "a group above the size of a shard", None, 0, True, 9) for i in range(90)]
    rows += [(None, None, None, None, None, None), (9007, "", "s", 0, True, 9), rows[0], (9008, "é" * 5000, "s", 0, True, 9)]
    return rows


def test_shards_are_even_gapless_and_keep_groups(frame):
    rows = shard_rows()
    out = sharding.assign(frame(rows, DOCS)).collect()
    counts, shards, slots = {}, {}, {}
    for r in out:
        counts[r.shard] = counts.get(r.shard, 0) + 1
        shards.setdefault((r.link_a, r.link_b), []).append(r.shard)
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(out) == len(rows) and set(counts) == set(range(16))
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    split = [s for s in shards.values() if len(set(s)) > 1]
    assert len(split) == 1 and len(split[0]) == 90 and len(set(split[0])) <= 5
    for r in out:
        text = next(t for d, t, *_ in rows if d == r.doc_id) or ""
        assert (r.size, r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
    assert {(r.law, r.grown_shard) for r in out} == {("rows", None)}


def test_shards_of_few_rows_of_one_group_and_of_none(frame):
    few = sharding.assign(frame(shard_rows()[:5], DOCS)).collect()
    assert len({r.shard for r in few}) == 5
    one = sharding.assign(frame([(i, "same", "s", 0, True, 0) for i in range(64)], DOCS)).collect()
    assert sorted(map([r.shard for r in one].count, range(16))) == [4] * 16
    assert sharding.assign(frame([], DOCS)).count() == 0


def test_due_inverts_the_integral_of_the_schedule(spark):
    knots = ((0.0, 0.2), (0.3, 2.0), (0.6, 2.0), (1.0, 0.0))
    area = lambda t: np.trapezoid(np.interp(s := np.linspace(0, t, 20_001), *zip(*knots, strict=True)), s)
    shares = [0.0, 0.05, 0.31, 0.5, 0.77, 1.0]
    got = spark.createDataFrame([(s,) for s in shares], "s double").select(curriculum.due(knots, F.col("s")).alias("t"))
    for s, r in zip(shares, got.collect(), strict=True):
        assert area(r.t) / area(1) == pytest.approx(s, abs=1e-6)


def mix_rows():
    draw = random.Random(3)
    rows = [(i, "w " * draw.randint(0, 30), f"s{i % 7}", -1, True, 0) for i in range(400)]
    rows += [(1000 + i, "long " * 500, "hot", -1, True, 0) for i in range(200)]
    return rows + [(None, "a b", None, 1, True, 0), (None, None, None, 1, True, 0), (5, "", "empty", 1, True, 0), rows[0]]


def test_mix_takes_each_target_and_no_document_more_than_twice(frame):
    rows = mix_rows()
    out = curriculum.schedule(frame(rows, DOCS)).collect()
    sizes, by = {}, {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    goal, free, left = {}, set(names), 1.5 * sum(sizes.values())
    while True:  # reshare by weight until none is above its cap
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if 2 * sizes[s] < weight[s] * level}
        if not above:
            break
        goal |= {s: 2.0 * sizes[s] for s in above}
        free -= above
        left -= sum(2 * sizes[s] for s in above)
    goal |= {s: weight[s] * level for s in free}
    assert len(out) == len(rows)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert 0 <= r.taken <= 2 * r.size == 2 * r.size and sum(c.words for c in r.copies) == r.taken
        by[r.source] = by.get(r.source, 0) + r.taken
    assert all(abs(by[s] - goal[s]) <= 0.5 for s in names)


def test_mix_reruns_agree_and_sorts_by_position(frame):
    docs = frame(mix_rows(), DOCS)
    first = curriculum.schedule(docs.repartition(7))
    again = curriculum.schedule(docs.repartition(3, "text"))
    rows = lambda df: sorted(map(repr, df.select("doc_id", "taken", "copies", "target").collect()))
    assert rows(first) == rows(again)
    places = [r.position for r in curriculum.training_order(first).collect()]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    assert curriculum.schedule(docs.limit(0)).count() == 0
