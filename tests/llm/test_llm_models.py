"""The quality classifier, the language trees, and wrappers."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pelagrid.llm import langid_ppm, quality_qda, wrapper
from pelagrid.llm import text as tx

DOCS = "doc_id long, text string, lang string, source string, score double, x string"
SF = "/root/testdata/sf0.01"


def test_quality_accuracy_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    out = quality_qda.classify(docs, labels)
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert out.count() == docs.count()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.collect())


def test_quality_density_equals_the_plain_formula():
    draw = np.random.default_rng(0)
    x = {k: draw.normal(k, 1 + k, (80, len(quality_qda.STATISTICS))) for k in (0, 1)}
    model = quality_qda.from_moments({k: (len(v), v.sum(0), v.T @ v) for k, v in x.items()})
    scatter = {k: np.cov(v.T, bias=True) for k, v in x.items()}
    pooled = (scatter[0] + scatter[1]) / 2
    d = quality_qda.DIAGONAL_WEIGHT
    pooled = (1 - d) * pooled + d * np.diag(np.maximum(np.diag(pooled), quality_qda.FLOOR))
    probe = draw.normal(0.5, 2, (20, pooled.shape[0]))
    logs = []
    for k in (0, 1):
        w = quality_qda.POOLED_WEIGHT
        cov = (1 - w) * scatter[k] + w * pooled + quality_qda.FLOOR * np.eye(len(pooled))
        gap = probe - x[k].mean(0)
        logs.append(-0.5 * (np.sum(gap @ np.linalg.inv(cov) * gap, 1) + np.linalg.slogdet(cov)[1]))
    assert model.score(probe) == pytest.approx(1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500))))


def test_quality_of_odd_rows_and_label_tables(frame):
    rows = [(1, None, None, None, 0.5, "x"), (None, "", None, None, 0.5, "x"), (2, "fine text. " * 20_000, "en", "s", 0.1, "x")]
    docs = frame([*rows, rows[0]], DOCS)
    kinds = "doc_id long, quality int, toxic int, text string"
    none = quality_qda.classify(docs, frame([], kinds)).collect()
    assert [r.score for r in none] == [0.5] * 4
    one = frame([(2, 1, 0, "t"), (2, 1, 0, "t"), (None, 0, 0, "t"), (1, 7, 0, "t"), (1, None, 0, "t")], kinds)
    assert {r.score for r in quality_qda.classify(docs, one).collect()} == {1.0}
    assert not [r for r in none if r.doc_id is None][0].held_out
    assert quality_qda.classify(docs.limit(0), one).count() == 0
    assert quality_qda.statistics(pa.array([], pa.string())).shape == (0, len(quality_qda.STATISTICS))


def small_model(texts):
    langs = sorted(texts)
    parts = []
    for k, lang in enumerate(langs):
        for chunk in tx.chunks(pa.array(texts[lang])):
            run, n = np.unique(langid_ppm.runs(chunk), return_counts=True)
            parts.append((np.full(len(run), k), run.astype(np.int64), n.astype(float)))
    lang, run, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    return langid_ppm.build(langs, lang, run, n)


def test_code_lengths_are_exact_and_probabilities_add_up_to_one():
    texts = {"aa": ["abab abba", "ab"], "bb": ["bcbc cbb\n", "é"]}
    model = small_model(texts)
    contexts = np.unique(np.concatenate([o.contexts for tree in model.trees for o in tree])).astype(np.uint32)
    following = (contexts[:, None] << np.uint32(8)) | np.arange(256, dtype=np.uint32)
    for tree in model.trees:
        chances = np.exp2(-langid_ppm._code_lengths(tree, following.ravel())).reshape(-1, 256)
        assert chances.sum(1) == pytest.approx(1, abs=1e-9)

    def plain(lang, text):
        """Bits by the definition, one byte at a time."""
        seen = {}
        for t in texts[lang]:
            data = langid_ppm.PAD + t.encode()
            for i in range(3, len(data)):
                for order in range(4):
                    c = seen.setdefault(data[i - order : i], {})
                    c[data[i]] = c.get(data[i], 0) + 1

        def p(context, byte):
            if context is None:
                return 1 / 256
            counts = seen.get(context, {})
            shorter = context[1:] if context else None
            if not counts:
                return p(shorter, byte)
            total, kinds = sum(counts.values()), len(counts)
            if byte in counts:
                return counts[byte] / (total + kinds)
            left = 1 - sum(p(shorter, x) for x in counts)
            return kinds / (total + kinds) * p(shorter, byte) / left

        data = langid_ppm.PAD + text.encode()
        return sum(-np.log2(p(data[i - 3 : i], data[i])) for i in range(3, len(data)))

    probes = ["abba", "cb é", "xyz\x00", ""]
    (chunk,) = tx.chunks(pa.array(probes))
    wanted = [[plain(lang, t) for lang in sorted(texts)] for t in probes]
    assert model.bits(chunk) == pytest.approx(np.array(wanted), rel=1e-4, abs=1e-6)


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid_ppm.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    unseen = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and np.mean([r.lang_pred == r.lang for r in unseen]) >= 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


@pytest.mark.parametrize("cells", [langid_ppm.MAX_CELLS, 12_000])
def test_no_language_is_lost_among_many(frame, monkeypatch, cells):
    """Languages with alphabets of their own, most of them rare, also where contexts must be left out."""
    monkeypatch.setattr(langid_ppm, "MAX_CELLS", cells)
    draw, rows, n = np.random.default_rng(4), [], 0
    for k in range(60):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(30)]
        for _ in range(120 if k < 4 else 12):
            words = ["".join(draw.choice(letters, draw.integers(2, 7))) for _ in range(draw.integers(5, 40))]
            rows.append((n := n + 1, " ".join(words), f"l{k:02d}", "s", 0.0, "x"))
    out = {r.doc_id: r for r in langid_ppm.identify(frame(rows, DOCS)).collect()}
    assert all(out[d].lang_pred == lang for d, _, lang, *_ in rows)


def test_language_of_odd_rows(frame):
    rows = [(2, "der die das und", "de", "s", 0.0, "x"), (3, "the of and to", "en", "s", 0.0, "x"), (None, "the of", "zz", "s", 0.0, "x")]
    rows += [(5, None, None, None, None, None), (6, "", "en", "s", 0.0, "x"), (7, "12 !?", "en", "s", 0.0, "x"), (8, "the " * 50_000, None, "s", 0.0, "x")]
    docs = frame([*rows, rows[0]], DOCS)
    out = {r.doc_id: r for r in langid_ppm.identify(docs).collect()}
    assert out[8].lang_pred == "en" and "zz" not in {r.lang_pred for r in out.values()}
    assert [(out[k].lang_pred, out[k].score) for k in (5, 6, 7)] == [("und", 0.0)] * 3
    assert langid_ppm.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in langid_ppm.identify(docs.where("doc_id = 5")).collect()} == {"und"}


@pytest.mark.parametrize(
    "body, wanted",
    [
        ("<p>one</p><script>for(i=0;i<n;i++){f()}</script><p>two</p><p>three</p>", "one two three"),
        ("<p>one</p><script>var s = '<!--';</script><p>two</p>", "one two"),
        ("<p>one</p><SCRIPT>if (a<b) x='</p>'</SCRIPT ><p>two</p>", "one two"),
        ("<p>one</p><style>a>b{}</style><svg><title>x</title><path d='<'></svg><p>two</p>", "one two"),
        ("<p>one</p><script>never closed <p>two</p>", "one"),
        ("<p class=it's>one</p><p title=\"a>b\" class='c>d'>two</p><p id=x\"y>three</p>", "one two three"),
        ("<p a=\"b>one</p><p>two</p>", "one two"),
        ("<div class='layout no-sidebar has-sidebar'><article><p>one</p></article></div>", "one"),
        ("<div class='sidebar'><article><p>one</p></article></div>", "one"),
        ("<article><div class='entry-header post-header'><h1>title</h1></div><p>one</p></article>", "title one"),
        ("<article><p>so <math><mi>x</mi><mo>&lt;</mo><mn>2</mn></math> holds</p></article>", "so x<2 holds"),
        ("<div class='main-nav'>a</div><div id='site_footer'>b</div><p>one</p><div class='cookie-box'>c</div>", "one"),
        ("<article><p>one</p><div class='comments-area'>c</div><div class='ad-slot'>d</div></article>", "one"),
        ("<article><p>one</p></article><article class='comment-body'><p>c</p></article>", "one"),
        ("<aside><article><p>teaser</p></article></aside><p>one</p>", "one"),
        ("<p>1 < 2 and 3 > 2</p><select><option>a<option>b</select><p>two", "1 < 2 and 3 > 2 two"),
    ],
)
def test_raw_elements_quotes_and_names(frame, body, wanted):
    rows = [(1, "http://one.example/", page(body))]
    (out,) = wrapper.extract(frame(rows, "page_id long, url string, html string")).collect()
    assert out.text.replace("\n\n", " ") == wanted


def page(body, head="<title>t</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


SITE = (
    "<nav><ul><li>Home<li>About</ul></nav><div><b>Site slogan</b></div><div id=c><h1>{title}</h1><p>{one}<p>{two}</div>"
    "<div class='sidebar'>side {title}</div><form>mail <input></form><div>Made by us</div><footer>&copy; us</footer>"
)


def test_wrapper_drops_constant_slots_and_keeps_varying_ones(frame):
    schema = "page_id long, url string, html string, text string, host string"
    rows = [
        (i, f"http://a.example/p{i}", page(SITE.format(title=f"T{i}", one=f"first\n {i} &amp; co", two=f"second <i>it</i>{i}")), "x", "y")
        for i in range(12)
    ]
    rows += [(50, None, None, "x", "y"), (51, "not a url", "", "x", "y"), rows[0], (None, "http://b.example/", "plain &lt;text", "x", "y")]
    rows += [(52, "http://c.example", "<main><p>kept<div class=comments>no</div></main><p>outside<p>unclosed <b", "x", "y")]
    rows += [(53, "http://a.example/deep", "<div>" * 3000 + "deep text", "x", "y"), (54, "http://d.example", "<p>" + "long word " * 30_000, "x", "y")]
    out = [(r.page_id, r.text, r.n_chars) for r in wrapper.extract(frame(rows, schema)).collect()]
    got = {i: t for i, t, _ in out}
    assert len(out) == len(rows) and all(len(t) == n for _, t, n in out)
    for i in range(12):
        assert got[i] == f"T{i}\n\nfirst {i} & co\n\nsecond it{i}"
    assert got[50] == got[51] == "" and got[None] == "plain <text" and got[52] == "kept"
    assert got[53] == "deep text" and got[54] == ("long word " * 30_000).strip()
    assert wrapper.extract(frame([], schema)).count() == 0


def test_wrapper_counts_copies_of_a_page_once(frame):
    def rows(host, n, copies):
        own = [page(SITE.format(title=f"T{i}", one=f"first {i}", two=f"second {i}")) for i in range(n)]
        return [(i, f"http://{host}/{i}/{k}", h) for i, h in enumerate(own) for k in range(copies(i))]

    data = rows("twice.example", 12, lambda i: 2) + rows("hot.example", 12, lambda i: 400 if i == 5 else 1)
    data += rows("few.example", 3, lambda i: 4)  # fewer different pages than a wrapper needs
    # Near copies: the same article under two different titles.
    data += [
        (i, f"http://near.example/{i}", page(SITE.format(title=f"T{i}", one=f"first {i // 2}", two=f"second {i // 2}")))
        for i in range(12)
    ]
    found = wrapper.extract(frame(data, "page_id long, url string, html string")).collect()
    assert len(found) == len(data)
    for r in found:
        k, host = r.page_id, r.url.split("/")[2]
        part = k // 2 if host == "near.example" else k
        article = f"T{k}\n\nfirst {part}\n\nsecond {part}"
        assert r.text == (f"Site slogan\n\n{article}\n\nMade by us" if host == "few.example" else article)


def test_tree_matching_is_the_largest_order_preserving_match():
    def plain(a, b):
        if a[0] != b[0]:
            return 0
        best = 0
        for n in range(1, min(len(a[1]), len(b[1])) + 1):
            for x in itertools.combinations(a[1], n):
                for y in itertools.combinations(b[1], n):
                    best = max(best, sum(plain(p, q) for p, q in zip(x, y, strict=True)))
        return 1 + best

    draw = np.random.default_rng(4)

    def tree(depth):
        return ("abc"[draw.integers(3)], [tree(depth - 1) for _ in range(draw.integers(0, 4))] if depth else [])

    def nodes(t, count):
        node = wrapper.Node(t[0], False, False, next(count))
        node.children = [nodes(c, count) for c in t[1]]
        return node

    for _ in range(40):
        a, b = ("r", tree(2)[1]), ("r", tree(2)[1])
        x, y = nodes(a, itertools.count()), nodes(b, itertools.count())
        wrapper._shape(x), wrapper._shape(y)
        assert wrapper.match(x.shape, y.shape) == plain(a, b) == len(wrapper.align(x, y))


def test_long_child_lists_are_split_with_the_same_score(monkeypatch):
    def row(n, skip):
        root = wrapper.Node("r", False, False, 0)
        root.children = [wrapper.Node("abcd"[i % 4], False, False, i + 1) for i in range(n) if i % skip]
        wrapper._shape(root)
        return root

    x, y = row(90, 7), row(80, 5)
    whole = len(wrapper.align(x, y))
    monkeypatch.setattr(wrapper, "CELLS", 100)
    assert len(wrapper.align(x, y)) == whole == wrapper.match(x.shape, y.shape)
