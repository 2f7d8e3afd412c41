"""Whitening against a dense solver, ranked search against a plain scan, URL templates against a plain tree."""

import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagrid.llm import feast, fp_search, queries, url_tree

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, whitened string, x int"


def dense_whitening(vectors):
    x = np.floor(256 * np.array(vectors, np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    gap = fit - fit.mean(0)
    cov = gap.T @ gap / len(fit)
    values, axes = np.linalg.eigh(cov)
    return x, fit, values[::-1][:4], axes[:, ::-1][:, :4], np.trace(cov)


def test_components_equal_a_dense_solver(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x, fit, values, axes, trace = dense_whitening([r.embedding for r in rows])
    n, sums = len(fit), fit.sum(0)
    want = (x - sums / n) @ (axes / np.sqrt(values))
    place = {r.vec_id: i for i, r in enumerate(rows)}
    got = queries.op11_feast_whitening(spark, SF).collect()
    assert len(got) == 4 * len(rows)
    signs = {}
    for r in got:
        i, k = place[r.vec_id], r.component - 1
        signs.setdefault(k, 1 if r.whitened * want[i, k] > 0 else -1)
        assert r.whitened == pytest.approx(signs[k] * want[i, k], abs=1e-9)
        assert r.n == n and r.deviation == int(((n * x[i] - sums) ** 2).sum())
        assert r.explained == pytest.approx(values[k] / trace, rel=1e-9) and r.identity_error < 1e-9


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 5, 5, 1], [9, 4, 1, 0, 0, 0, 0], [1e-9, 1e-12], [7], [3, 3 - 1e-7, 1, 1, 1], [1e300, 1e299, 1]])
def test_contour_finds_every_leading_component(spectrum):
    draw = np.random.default_rng(len(spectrum))
    turn = np.linalg.qr(draw.normal(size=(len(spectrum),) * 2))[0]
    matrix = (turn * spectrum) @ turn.T
    matrix = matrix / 2 + matrix.T / 2
    values, vectors = feast.leading(matrix, 4)
    positive = sorted((v for v in spectrum if v > 1e-13 * max(spectrum)), reverse=True)[:4]
    assert values == pytest.approx(positive, rel=1e-9, abs=1e-12 * max(spectrum))
    scale = max(spectrum)
    assert np.abs((matrix / scale) @ vectors - vectors * (values / scale)).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12


def test_contour_on_a_crowded_spectrum():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(400, 120))
    matrix = x.T @ x / 400
    values, vectors = feast.leading(matrix, 10)
    want = np.linalg.eigvalsh(matrix)[::-1][:10]
    assert values == pytest.approx(want, rel=1e-12)
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12
    counts = feast.Inertia(matrix)
    assert [counts.above(s) for s in (0.5, 1.0, 2.0)] == [int((np.linalg.eigvalsh(matrix) > s).sum()) for s in (0.5, 1.0, 2.0)]


def test_whitening_of_odd_rows(frame):
    nan, inf = float("nan"), float("inf")
    good = [[0.1, 0.2, -0.3], [0.5, -0.25, 0.0], [0.9, 0.4, 0.7], [-0.2, 0.6, 0.1]]
    bad = [None, [], [nan, 0.1, 0.2], [0.1, None, 0.2], [inf, 0.0, 0.0], [0.1, 0.2]]
    rows = [(i, v, 1, "w", 2) for i, v in enumerate(good + bad + good)] + [(None, good[0], 1, "w", 2)]
    out = feast.components(frame(rows, VECTORS)).collect()
    _, fit, values, _, _ = dense_whitening(good)
    kept = len([v for v in values if v > 1e-9])
    assert kept == 3 and {r.n for r in out} == {4}
    assert Counter(r.vec_id for r in out) == {i: 3 for i in [None, 0, 1, 2, 3, *range(10, 14)]}
    by_row = {(r.vec_id, r.component): r.whitened for r in out}
    assert all(by_row[i, c] == by_row[i + 10, c] for i in range(4) for c in (1, 2, 3))
    assert feast.components(frame([], VECTORS)).count() == 0
    assert feast.components(frame([(1, [0.5, 0.5], 1, "w", 2)] * 3, VECTORS)).count() == 0
    assert feast.components(frame([(1, None, 1, "w", 2), (2, [], 1, "w", 2)], VECTORS)).count() == 0


def test_deviations_beyond_64_bits():
    huge = feast.Centre(3, [0, 3])
    x = np.array([[1 << 61, 1], [1 << 20, 1]])
    assert huge.deviations(x) == [None, 9 << 40]
    assert np.allclose(huge.centred(x), [[float(1 << 61), 0], [float(1 << 20), 0]])


DOCS = "doc_id long, text string, lang string, rank int, score double, item_id string"
ITEMS = "item_id long, text string, doc_id string, rank int"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_search(docs, items, top=50):
    own = [(d, cut(t)) for d, t in docs]
    own = [(d, len(t), Counter(t)) for d, t in own if t]
    total = sum(n for _, n, _ in own)
    df = Counter(t for _, _, c in own for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(cut(text))
    out = set()
    for item, terms in asked.items():
        scored = []
        for d, n, c in own:
            m = 50 + 50 * n * len(own) // total
            s = sum(
                math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms & c.keys()
            )
            scored += [(-s, d is None, d or 0, d)] * (s > 0)
        out |= {(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(scored, key=lambda r: r[:3])[:top])}
    return out


def ranked(df):
    rows = [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_search_equals_a_plain_scan(frame, monkeypatch):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "naïve", "ÄB", "x1"]
    text = lambda n: " ".join(draw.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    docs = [(i, text(draw.randint(1, 60))) for i in range(600)]
    docs += [(1000 + i, docs[7][1]) for i in range(300)]  # a large group of copies
    docs += [(None, docs[7][1]), (3, "w1, W1! w1"), (3, "w1, W1! w1"), (4, None), (5, ""), (6, "?! ..."), (8, "w2 " * 30_000)]
    draw.shuffle(docs)
    items = [(i, text(12)) for i in range(12)] + [(20, docs[0][1]), (20, "w59 w58"), (21, None), (22, "absent"), (None, "w3 w4")]
    want = plain_search(docs, items)
    table = frame([(d, t, "en", 1, 0.5, "i") for d, t in docs], DOCS)
    asked = frame([(i, t, "d", 1) for i, t in items], ITEMS)
    assert ranked(fp_search.rank(table, asked)) == want
    monkeypatch.setattr(fp_search, "BLOCK_ENTRIES", 300)  # several trees in a task
    assert ranked(fp_search.rank(table.repartition(3), asked)) == want


def test_search_in_blocks_of_items(frame):
    docs = frame([(i, f"a{i % 7} b{i % 3} c", "en", 1, 0.5, "i") for i in range(40)], DOCS)
    rows = [(i, f"a{i} b{i} zz{i}") for i in range(9)]
    items = frame([(i, t, "d", 1) for i, t in rows], ITEMS)
    blocks = fp_search.item_terms(items, block=8)
    assert len(blocks) == 4 and sorted(n for b in blocks for n in b[0]) == list(range(9))
    assert ranked(fp_search.rank(docs, items, top=5)) == plain_search([(i, f"a{i % 7} b{i % 3} c") for i in range(40)], rows, 5)


def test_search_without_rows(frame):
    docs = frame([(1, "a b", "en", 1, 0.5, "i")], DOCS)
    assert fp_search.rank(docs.limit(0), frame([(1, "a", "d", 1)], ITEMS)).count() == 0
    assert fp_search.rank(docs, frame([], ITEMS)).count() == 0
    assert fp_search.rank(docs, frame([(1, "zz", "d", 1)], ITEMS)).count() == 0


def test_bounds_hold_for_every_subtree():
    draw = np.random.default_rng(1)
    paths = sorted(sorted(draw.choice(30, draw.integers(1, 12), replace=False).tolist()) for _ in range(900))
    counts = [draw.integers(1, 9, len(p)) for p in paths]
    figures = draw.integers(50, 400, len(paths))
    tree = fp_search.Tree([np.array(p) for p in paths], counts, figures)
    asked, weights = np.array([1, 5, 17, 29, 31]), np.array([900, 20, 3000, 7, 5])
    bound = tree.bounds(asked, weights)
    table = dict(zip(asked.tolist(), weights.tolist()))
    score = [
        sum(table.get(t, 0) * (10**9 * int(c) // (1000 * int(c) + 20 * int(f))) for t, c in zip(p, own))
        for p, own, f in zip(paths, counts, figures)
    ]
    assert len(tree.first) > 20
    for first, last, b in zip(tree.first, tree.last, bound):
        assert b >= max(score[first:last])
    leaves = sorted((f, e) for f, e, c in zip(tree.first, tree.last, tree.children) if not c)
    assert [f for f, _ in leaves] == [0, *[e for _, e in leaves[:-1]]] and leaves[-1][1] == len(paths)


PAGES = "page_id long, url string, html string, host string, verdict int, template string"


def plain_place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def plain_rule(host, path):
    fits = []
    for said, rule in url_tree.RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, said))
    return max(fits)[1:] if fits else (None, None)


def plain_wildcard(segment):
    if segment is None:
        return "/"
    stem, extension = re.fullmatch(r"(.*?)(\.[A-Za-z]{1,5})?", segment, re.S).groups()
    if segment == "":
        return ""
    if re.fullmatch("[0-9]+", stem):
        kind = "{n}"
    elif re.fullmatch("[0-9A-Fa-f-]{8,}", stem) and re.search("[0-9]", stem):
        kind = "{h}"
    else:
        kind = "{*}"
    return kind + (extension or "")


def plain_segments(path):
    if path.startswith("/"):
        return path[1:].split("/", url_tree.LEVELS - 1)
    return [path] if path else []


def plain_templates(labels):
    """``labels`` maps (host, path) to 1, 0 or None; gives each its template and whether it is rejected."""
    names = {key: "" for key in labels}
    for level in range(max((len(plain_segments(p)) for _, p in labels), default=0)):
        nodes = defaultdict(lambda: defaultdict(list))
        for (host, path), name in names.items():
            parts = plain_segments(path)
            if len(parts) > level:
                nodes[host, name][parts[level]].append((host, path))
        for (host, name), kinds in nodes.items():
            even = sum(map(len, kinds.values())) / sum(1 for k in kinds if k) if any(kinds) else 0
            even -= len(kinds.get("", [])) / sum(1 for k in kinds if k) if any(kinds) else 0
            few = sum(1 for k in kinds if k) <= url_tree.FEW
            literal = {
                s: keys for s, keys in kinds.items()
                if s and len(keys) >= url_tree.SUPPORT and (few or len(keys) > even + 3 * math.sqrt(even))
            }
            votes = {s: [labels[k] for k in keys if labels[k] is not None] for s, keys in literal.items()}
            seen, bad = sum(map(len, votes.values())), sum(map(sum, votes.values()))
            groups = defaultdict(list)
            for s, keys in literal.items():
                after = Counter(plain_wildcard((plain_segments(p) + [None] * 9)[level + 1]) for _, p in keys)
                shape = max(after, key=lambda k: (after[k], k))
                side = "unlabelled"
                if votes[s]:
                    share = bad / seen
                    off, error = sum(votes[s]) / len(votes[s]) - share, math.sqrt(share * (1 - share) / len(votes[s]))
                    side = "above" if off > 2 * error else "below" if off < -2 * error else "alike"
                groups[shape, side].append(s)
            merged = {s: g[0] if len(g) == 1 else f"[{min(g)}+{len(g) - 1}]" for g in groups.values() for s in g}
            for s, keys in kinds.items():
                for key in keys:
                    names[key] = f"{name}/{merged.get(s, plain_wildcard(s))}"
    votes = defaultdict(list)
    for (host, path), name in names.items():
        votes[host, name] += [labels[host, path]] * (labels[host, path] is not None)
    return {k: (n, (sum(votes[k[0], n]) + 1) / (len(votes[k[0], n]) + 2)) for k, n in names.items()}


def check_pages(frame, urls):
    out = url_tree.judge(frame([(i, u, "h", "x", 1, "t") for i, u in enumerate(urls)], PAGES)).collect()
    assert sorted(r.page_id for r in out) == list(range(len(urls)))
    places = {u: plain_place(u) for u in urls}
    labels = {places[u]: {"block": 1, "allow": 0, None: None}[plain_rule(*places[u])[1]] for u in urls}
    tree = plain_templates(labels)
    for r in out:
        key = places[urls[r.page_id]]
        rule, said = plain_rule(*key)
        name, purity = tree[key]
        assert (r.host, r.path, r.rule, r.template) == (*key, rule, name)
        assert r.purity == pytest.approx(purity)
        assert r.verdict == (said or ("block" if purity >= url_tree.PURITY else "allow"))
    return out


def test_url_verdicts_equal_a_plain_tree(spark, frame):
    urls = [r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("url").collect()]
    draw = random.Random(2)
    for host, lang, n in itertools.product(("a.example.net", "b.example.com", "www.example.com", "c.org"), ("en", "es", "fr", "de"), range(9)):
        urls.append(f"https://{host}/{lang}/{draw.randint(0, 10**6)}/{draw.choice(['', 'a.html', 'deadbeef01'])}")
    urls += [f"http://u.example.net/es/user{i}/{k}" for i in range(60) for k in range(1 + 4 * (i == 5))]
    urls += [f"http://u.example.net/user{i}/es" for i in range(40)]
    out = check_pages(frame, urls)
    assert {"block", "allow"} == {r.verdict for r in out if r.rule is None} | {r.verdict for r in out}


def test_templates_reject_what_labelled_pages_show(frame):
    """Half of a host's rejected section is labelled; the other half follows, its other pages do not."""
    rows = [(i, f"https://h.org/{'spam' if i % 2 else 'news'}/{i}", "h", "x", (i % 2 if i < 60 else None), "t") for i in range(120)]
    out = url_tree.judge(frame(rows, PAGES), rules=(), labelled=F.col("verdict")).collect()
    assert all(r.verdict == ("block" if r.page_id % 2 else "allow") for r in out)
    assert {r.template for r in out} == {"/spam/{n}", "/news/{n}"}


def test_odd_urls(frame):
    long = "http://h.com/" + "/".join(f"s{i}" for i in range(5000))
    urls = [None, "", "no scheme", "://", "http://", "HTTP://EXAMPLE.com", "http://Net/es/", "http://x.net/es", "ftp://a.com?x=/en/",
            "http://a.com#/b", "http://ÄB.Com/ü", "http://a.com://b/c", "http://notcom/x", "http://a.com//", long, "http://h.com/a\nb/c", long]
    out = {r.page_id: r for r in check_pages(frame, urls)}
    assert [out[i].host for i in (0, 2, 5, 10)] == ["", "", "example.com", "Äb.com"]
    assert [out[i].rule for i in (5, 6, 7, 8, 13)] == [None, "net/es/", None, None, "com/"]
    assert url_tree.judge(frame([], PAGES)).count() == 0
    twice = [(None, "http://a.net/es/1", "h", "x", 1, "t")] * 3
    assert [r.verdict for r in url_tree.judge(frame(twice, PAGES)).collect()] == ["block"] * 3
