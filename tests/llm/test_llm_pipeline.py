"""Registered queries against their SQL, and the pipeline against a brute-force version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from test_llm_groups import brute_components
from test_llm_rows import same

from pelagrid.llm import quality_qda, queries

SF = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    tables = {n: table(spark, n) for n in ("documents", "conversations", "benchmark")}
    same(queries.QUERIES[name](spark, SF), queries.ORACLES[name], digits=6, **tables)


def test_every_operator_and_the_pipeline_are_registered():
    import __spark_entry__ as contract

    names = contract.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "mixing", "sharding",
    ]


def plain_quality(rows, labels):
    x = quality_qda.statistics(pa.array([r.text for r in rows], pa.string()))
    y = np.array([labels.get(r.doc_id, -1) for r in rows])
    fit = np.array([zlib.crc32(str(r.doc_id).encode()) % 5 != 0 for r in rows])
    moments = {k: (float((fit & (y == k)).sum()), x[fit & (y == k)].sum(0), x[fit & (y == k)].T @ x[fit & (y == k)]) for k in (0, 1)}
    return [r for r, s in zip(rows, quality_qda.from_moments(moments).score(x), strict=True) if s >= 0.3]


def plain_clean(rows, items):
    grams = lambda t: {tuple(w[i : i + 5]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for i in range(len(w) - 4)}
    wanted = [g for g in map(grams, items) if g]
    return [r for r in rows if not any(len(g & own) >= 0.8 * len(g) for own in [grams(r.text)] for g in wanted)]


def plain_mix(rows):
    sizes = {id(r): len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in rows}
    total = Counter()
    for r in rows:
        total[r.source] += sizes[id(r)]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(total))}
    low, high = 0.0, 1e9  # the level at which the targets add up
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(2 * total[s], weight[s] * level) for s in total) < 1.5 * sum(total.values()):
            low = level
        else:
            high = level
    copies, before = Counter(), Counter()
    for r in sorted(rows, key=lambda r: (hashlib.md5(str(r.doc_id).encode()).hexdigest(), r.doc_id)):
        words, size = round(min(2 * total[r.source], weight[r.source] * level)), sizes[id(r)]
        passes, rest = divmod(words, total[r.source])
        taken = passes * size + max(0, min(size, rest - before[r.source]))
        before[r.source] += size
        copies[r.doc_id] = math.ceil(taken / size) if size else 0
    return +copies


def test_stages_and_run_equal_brute_force(spark):
    docs = table(spark, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    rows = docs.collect()
    good = plain_quality(rows, labels)
    components = brute_components([(r.doc_id, r.text) for r in good], 5, 80)
    single = [r for r, (d, _, c) in zip(good, components, strict=True) if d == c]
    clean = plain_clean(single, [r.text for r in table(spark, "benchmark").collect()])
    wanted = [good, single, clean]
    out = docs
    for (name, stage), expected in zip(corpus_pipeline.STAGES, wanted, strict=False):
        out = corpus_pipeline.written(stage(spark, out, SF), name)
        assert out.columns == docs.columns
        assert sorted(map(tuple, out.collect())) == sorted(map(tuple, expected)), name
    mixed = corpus_pipeline.mixing(spark, out, SF)
    assert mixed.columns == docs.columns
    copies = plain_mix(clean)
    assert Counter(r.doc_id for r in mixed.collect()) == copies
    final = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in final) == copies
    counts = Counter(r.shard for r in final).values()
    assert max(counts) - min(counts) <= 1 and len(counts) == 16


def test_stages_keep_clashing_columns_and_take_empty_tables(spark, frame):
    extra = "size long, position double, words string, copies string, n_words long, score double, component_id long, kept string"
    columns = "doc_id long, text string, lang string, source string, n_chars long, " + extra
    row = lambda i, t: (i, t, "en", "s", 1, 7, 0.5, "w", "c", 3, 0.1, 9, "k")
    docs = frame([row(1, "one two three four five six"), row(2, None), row(None, "x y z"), row(1, "one two three four five six")], columns)
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, SF)
            out.count()
            if name != "sharding":
                assert out.columns == docs.columns
                assert all(r["size"] == 7 and r["words"] == "w" for r in out.collect())
