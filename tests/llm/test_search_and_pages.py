"""Nearest neighbours, main text and web archives."""

import gzip
import hashlib
import io
import random
import struct
import time
import zipfile

import numpy as np
import pytest

import check
from paytally.llm import html_text, permutation_index, queries, warc, zip_directory
from paytally.llm.html_pages import labelled_pages
from paytally.llm.html_tree import read
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute(rows, k, is_query):
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if v and None not in v and np.isfinite(v).all() and any(v)
    ]
    for q, (query_id, query) in enumerate(good):
        if is_query(query_id):
            scored = sorted((-float(v @ query), i) for n, (i, v) in enumerate(good) if n != q)
            yield query_id, [(i, -s) for s, i in scored[:k]]


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(40)]
    rows += [(40, None), (41, []), (42, [0.0] * 3), (43, [1.0, None, 2.0]), (44, [float("nan")] * 3)]
    rows += [(45, [float("inf"), 1.0, 1.0]), (5, rows[5][1]), (60, [1.0] * 3), (61, [1.0] * 3)]
    frame = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, rank string, score int"
    )
    found = permutation_index.nearest(frame, F.col("vec_id") % 20 == 0, 4).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == dict(brute(rows, 4, lambda i: i % 20 == 0))
    assert 40 not in got and 60 in got
    none = permutation_index.nearest(frame.limit(0), F.lit(True), 4)
    assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]


def test_op1_recall(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, r.embedding) for r in vectors]
    got = {}
    for r in queries.op1_permutation_index(spark, SF).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = dict(brute(rows, 20, lambda i: i % 20 == 0))
    assert set(got) == set(want)
    hits = [len({v for v, _ in got[q].values()} & {v for v, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9
    vector = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        for v, score in found.values():
            assert abs(score - vector[q] @ vector[v]) < 1e-12


def test_blocks_and_hot_vectors_change_no_answer(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(150)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")

    def search(block_rows, query_rows):
        found = permutation_index.nearest(
            frame, F.col("vec_id") % 20 == 0, 5, pivots=32, depth=32, probes=32, share=1.0,
            block_rows=block_rows, query_rows=query_rows,
        )
        return sorted((r.query_id, r.rank, r.vec_id) for r in found.collect())

    want = dict(brute(rows, 5, lambda i: i % 20 == 0))
    exact = sorted((q, k, v) for q, found in want.items() for k, (v, _) in enumerate(found, 1))
    assert search(8192, 8192) == exact
    assert search(50, 8192) == exact
    assert search(50, 4) == exact


@pytest.mark.parametrize("sigma", [0.0, 1.0])
def test_recall_where_lengths_vary(spark, sigma):
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(6000, 32))
    matrix *= (np.exp(sigma * rng.normal(size=6000)) / np.linalg.norm(matrix, axis=1))[:, None]
    frame = spark.createDataFrame(
        [(i, v) for i, v in enumerate(matrix.tolist())], "vec_id long, embedding array<double>"
    )
    found = permutation_index.nearest(frame, F.col("vec_id") % 20 == 0, 20).collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, 6000, 20):
        scores = matrix @ matrix[q]
        scores[q] = -np.inf
        assert len(got[q]) == 20
        hits.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(hits) >= 0.95


def test_copies_and_null_ids_are_found(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(3000)]
    rows += [(5000 + i, rows[7][1]) for i in range(1500)] + [(None, rows[7][1]), (8000, [1.0] * 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    found = permutation_index.nearest(frame, F.expr("vec_id in (7, 5999, 8000)"), 10).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    least = [None, 7, *range(5000, 5020)]
    assert set(got) == {7, 5999}  # a vector of another length takes no part
    for q, ids in got.items():
        longer = [i for i in ids if i is not None and i != 7 and i < 5000]
        copies = [i for i in ids if i not in longer]
        assert copies == [i for i in least if i != q][: len(copies)]


def test_likeness_is_what_the_footrule_distance_lacks():
    def distance(a, b, pivots, depth):
        place = {p: i for i, p in enumerate(a)}, {p: i for i, p in enumerate(b)}
        return sum(abs(place[0].get(p, depth) - place[1].get(p, depth)) for p in range(pivots))

    rng = random.Random(0)
    query = rng.sample(range(12), 5)
    orders = [rng.sample(range(12), 5) for _ in range(50)]
    block = permutation_index.Block(np.ones((50, 3)), np.array(orders), 12)
    alike = block.likeness(np.array(query))
    assert [30 - 2 * a for a in alike] == [distance(query, o, 12, 5) for o in orders]


PAGE = """<!DOCTYPE html><html><head><title>Not this</title><style>p{}</style></head><body>
<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>
<div class="ad">Buy this now and save a lot of money today.</div>
<article><h1>The  river &amp; the
bridge</h1><script>var x = "</p>";</script>
<p>First <b>para<br>graph of</b> the story, which is long enough to be read.<!-- no -->
<p>Second &lt;one&gt; &#233;t&eacute; with <a href=x>a link</a> in the middle of it.</p>
<div class="comments"><p>Great read, thank you so much for this!</p></div></article>
<form><p>Subscribe here</p><input></form><footer>&copy; somebody, all rights reserved</footer>"""


def test_main_text():
    model = html_text.train(labelled_pages())
    assert model.text(PAGE) == (
        "The river & the bridge\n"
        "First para graph of the story, which is long enough to be read.\n"
        "Second <one> été with a link in the middle of it."
    )


def test_labels_of_unseen_pages_are_found():
    model = html_text.train(labelled_pages())
    wrong = total = 0
    for page in labelled_pages(150, seed=99):
        tree = read(page)
        marginals, labels = model.marginals(tree), []
        for i, node in enumerate(tree.nodes):
            labels.append((labels[node.parent] if i else 0) if node.label is None else node.label)
        total += len(tree.runs)
        wrong += sum((marginals[i] >= 0.5) != bool(labels[i]) for i, _ in tree.runs)
    assert wrong < 0.02 * total


def test_messages_give_exact_marginals():
    """Against a sum over all labellings of a small tree."""
    model = html_text.train(labelled_pages(80))
    tree = read("<div><p>one</p><ul><li>two</li><li><a>x</a></li></ul></div><footer>f</footer>")
    features = html_text._features(tree)
    n = len(tree.nodes)
    totals = np.zeros((n, 2))
    for code in range(2**n):
        y = [code >> i & 1 for i in range(n)]
        p = model.root[y[0]]
        for i, node in enumerate(tree.nodes):
            for f in features[i]:
                p *= model.features.get(f, (1.0, 1.0))[y[i]]
            if i:
                edge = model.edges.get(html_text._edge(node), model.other_edge)
                p *= edge[y[node.parent]][y[i]]
        for i in range(n):
            totals[i, y[i]] += p
    assert np.allclose(model.marginals(tree), totals[:, 1] / totals.sum(axis=1))


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "<p>deep text</p>"
    pages = [None, "", "<", "<p", "a < b & c", "</p></div>", "<!-- open", "<script>x", deep, PAGE]
    frame = spark.createDataFrame(
        [(i, f"u{i}", p, "x") for i, p in enumerate(pages)] + [(None, None, PAGE, "x")] * 2,
        "page_id long, url string, html string, text string",
    )
    found = html_text.main_text(frame).collect()
    assert len(found) == len(pages) + 2
    assert all(r.n_chars == len(r.text) for r in found)
    assert {r.text for r in found if r.page_id in (0, 1)} == {""}
    assert html_text.main_text(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    "page",
    [
        "<a" * 500_000,
        '<a href="x" ' * 80_000,
        "<div>" * 100_000 + "</p>" * 120_000,
        "<a \"'" * 200_000,
        '<a "><a "' * 110_000 + "'",
        "<td><li>" * 60_000,
        "<!--" * 250_000,
        "<script>" * 125_000,
        "<" * 1_000_000,
    ],
    ids=["open", "attributes", "unopened", "quotes", "unclosed", "nested", "comments", "raw", "signs"],
)
def test_long_pages_of_open_tags_are_read_in_one_pass(page):
    model = html_text.train(labelled_pages(40))
    begin = time.process_time()
    model.text(page)
    assert time.process_time() - begin < 6  # it was minutes


def test_quotes_in_scripts_and_open_quotes_hide_no_text():
    def runs(page):
        return [text for _, text in read(page).runs]

    assert runs("<script>if (a<b && c=='\"x) {}</script><p title=\"y\">One</p><p>Two") == ["One", "Two"]
    assert runs("<p>One</p><p title=\"x>Two</p><p>Three</p>") == ["One", "Two", "Three"]
    assert runs("<p title='a > b'>One</p> 1 < 2 <p>Two") == ["One", "1 < 2", "Two"]
    assert runs("<p>One</p></div></p><p>a <b") == ["One", "a <b"]


def test_pages_without_a_layout_are_text():
    model = html_text.train(labelled_pages())
    assert model.text("<p>Only one short line</p>") == "Only one short line"
    assert model.text("just some text") == "just some text"
    assert model.text("<body><p>One.</p><p>Two.</p><p>And three.</p></body>") == "One.\nTwo.\nAnd three."
    page = "<html><head><title>x</title></head><body><h1>Head</h1><p>Short.</p></body></html>"
    assert model.text(page) == "Head\nShort."


def test_op3_equals_the_articles(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in queries.op3_html_text(spark, SF).collect():
        article = re.search(r"<article>(.*)</article>", pages[row.page_id], re.S)[1]
        article = re.sub(r"</?b>", "", article.replace("<br>", " "))
        blocks = [html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n".join(" ".join(b.split()) for b in blocks if b.strip())


def test_op7(spark):
    assert check.compare(spark, check.connect(SF), SF, "op7_warc") == ""


def test_records_of_odd_pages(spark, tmp_path):
    body = "<p>" + "é" * 100 + "</p>"
    rows = [
        (3, "http://a/é b", body), (2, None, body), (9, "u\r\nX: y", body), (2, "again", body),
        (None, "u", body), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
        (8, "u", "z" * 500_000), (None, "u", "only" * 50),
    ]
    frame = spark.createDataFrame(
        [(*r, "x") for r in rows], "page_id long, url string, html string, digest string"
    )
    paths = warc.write(frame, f"file://{tmp_path}/w", package_bytes=300)
    assert paths.count() > 1
    found = sorted(warc.read(paths).drop("url").collect(), key=repr)

    def expected(page_id, html):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        refers = 2 if html == body and page_id != 2 else None
        return (page_id, len(data), digest, "revisit" if refers else "response", refers)

    assert sorted(map(tuple, found), key=repr) == sorted(
        (expected(p, h) for p, _, h in rows), key=repr
    )
    none = warc.write(frame.limit(0), f"file://{tmp_path}/e")
    assert none.collect() == [] and warc.read(none).collect() == []


def package(index=True, method=zipfile.ZIP_STORED, comment=b""):
    held = [warc.record(i, "u", b"x" * i, hashlib.sha256(b"x" * i).hexdigest(), None) for i in range(5)]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as zip_:
        zip_.writestr("readme.txt", "PK\x05\x06 is no end record here")
        zip_.writestr(zipfile.ZipInfo(warc.DATA), b"".join(held), method)
        if index:
            at, lines = 0, []
            for data in held:
                lines.append('{"offset": %d, "length": %d}' % (at, len(data)))
                at += len(data)
            zip_.writestr(warc.INDEX, "\n".join(lines))
        zip_.comment = comment
    return out.getvalue(), [gzip.decompress(h) for h in held]


@pytest.mark.parametrize("index", [True, False])
def test_packages_with_and_without_index(index):
    data, want = package(index, comment=b"PK\x05\x06 in a comment")
    assert list(warc.records(io.BytesIO(data))) == want


def test_broken_packages_are_refused():
    data, _ = package(method=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="compressed"):
        list(warc.records(io.BytesIO(data)))
    for broken in (b"", b"no package" * 50, package()[0][:-30]):
        with pytest.raises(ValueError):
            zip_directory.members(io.BytesIO(broken))


def test_zip64_directory():
    """A package whose sizes, places and counts are all in ZIP64 fields."""
    body, name = b"hello ranges", b"archive/big"
    top = 0xFFFFFFFF
    local = struct.pack("<4s5H3L2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, top, top, len(name), 20)
    local += name + struct.pack("<2H2Q", 1, 16, len(body), len(body)) + body
    extra = struct.pack("<2HB", 9, 1, 7) + struct.pack("<2H3Q", 1, 24, len(body), len(body), 0)
    entry = struct.pack(
        "<4s6H3L5H2L", b"PK\x01\x02", 45, 45, 0x800, 0, 0, 0, 0, top, top, len(name), len(extra),
        0, 0, 0, 0, top,
    )
    entry += name + extra
    at = len(local)
    end64 = struct.pack("<4sQ2H2L4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(entry), at)
    locator = struct.pack("<4sLQL", b"PK\x06\x07", 0, at + len(entry), 1)
    end = struct.pack("<4s4H2LH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, top, top, 0)
    source = io.BytesIO(local + entry + end64 + locator + end)
    (member,) = zip_directory.members(source)
    assert (member.name, member.size, member.is_stored) == ("archive/big", len(body), True)
    place = zip_directory.data_place(source, member)
    assert zip_directory.read_range(source, place, member.size) == body
    without = io.BytesIO(local + entry + end)
    with pytest.raises(ValueError, match="locator"):
        zip_directory.members(without)
