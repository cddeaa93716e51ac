"""Fill-in-the-middle, whitening and page texts against plain versions, and their odd cases."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallybrook.llm import fim, pagetext, queries, whitening

RANDOM = random.Random(11)


def plain_fim(doc_id, text, setting):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{setting.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    marks = (setting.prefix, setting.suffix, setting.middle)
    if not text or any(m in text for m in marks) or h[2] % 100 >= setting.rate:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    p, s, m = marks
    if h[3] % 100 < setting.spm_rate:
        return len(units), "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return len(units), "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


@pytest.mark.parametrize("setting", [fim.Setting(), fim.Setting(3, 50, 20, "<|pre|>", "<|suf|>", "§")])
def test_fim_cases(spark, setting):
    pieces = ["\n", "é", "ab ", "<P", "<P>", "S>", "\r\n", "𝄞", "§", "<|pre|>"]
    texts = ["".join(RANDOM.choice(pieces[: RANDOM.randint(3, 10)]) for _ in range(RANDOM.randint(0, 14))) for _ in range(120)]
    rows = [*enumerate(texts), (None, None), (None, "a\nb"), (7, "a\nb\n"), (7, "a\nb\n"), (-3, ""), (9**18, "long ö\n" * 300_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS output", "2 AS h1").repartition(3)
    made = fim.restored(fim.transform(frame, setting), setting).collect()
    found = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made), key=str)
    assert found == sorted(((d, t or "", *plain_fim(d, t, setting)) for d, t in rows), key=str)
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert fim.transform(frame.where("false"), setting).count() == 0


def test_fim_in_small_chunks(monkeypatch):
    monkeypatch.setattr(fim, "CHUNK", 5)
    setting, texts = fim.Setting(), ["ab\ncdé\n\nf" * 4, "", "x\n" * 9, "no line"]
    h = [np.array([RANDOM.randrange(1 << 32) for _ in texts]) for _ in range(4)]
    _, form, _, _, _, output = fim.build(pa.array(texts), h, setting)
    assert fim.restore(output, form, setting).to_pylist() == texts


def test_fim_refuses_sentinels_that_overlap():
    for marks in (("", "<S>", "<M>"), ("<a", "a>", "x"), ("<P>", "<P>x", "y"), ("aa", "b", "c")):
        with pytest.raises(ValueError):
            fim.Setting(7, 100, 50, *marks)


def plain_whitening(vectors, most=16):
    """{index: (deviation, whitened)} with numpy on the covariance matrix itself, n and shares."""
    usable = [i for i, v in enumerate(vectors) if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in vectors[i]] for i in usable])
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = (distinct * n - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    kept = [k for k in range(min(most, len(values))) if values[k] > 1e-9 * values[0]]
    white = ((x * n - sums) / n) @ axes[:, kept] / np.sqrt(values[kept])
    return {i: (int(((row * n - sums) ** 2).sum()), w) for i, row, w in zip(usable, x, white)}, n, values[kept] / values.sum()


def check_whitening(result, vectors):
    expected, n, explained = plain_whitening(vectors)
    found = {}
    for r in result.collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    assert set(found) == set(expected)
    signs = np.sign(sum(np.array([found[i][k + 1].whitened for k in range(len(explained))]) * w for i, (_, w) in expected.items()))
    for i, (deviation, white) in expected.items():
        rows = [found[i][k + 1] for k in range(len(explained))]
        assert len(found[i]) == len(explained)
        assert all(r.n == n and r.deviation == deviation and r.identity_error < 1e-9 for r in rows)
        assert np.allclose([r.whitened for r in rows], white * signs, atol=1e-7)
        assert np.allclose([r.explained for r in rows], explained, rtol=1e-9)


def test_whitening_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r.vec_id for r in rows] == list(range(len(rows)))
    check_whitening(queries.QUERIES["op11_whitening"](spark, sf_dir), [r.embedding for r in rows])


def frame_of(spark, vectors):
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    return frame.selectExpr("*", "1 AS x", "2 AS n", "'c' AS component").repartition(3)


def test_whitening_cases(spark):
    draw = np.random.default_rng(5)
    rows = (draw.normal(size=(60, 6)) * [1e4, 300, 40, 3, 1, 0]).tolist()
    for row in rows:
        row[4] = row[3]  # one direction and one dimension without variance
    odd = [None, [], [1.0] * 5, [None, 1.0, 1.0, 1.0, 1.0, 1.0], [math.nan] * 6, [math.inf] * 6, [1e300] * 6]
    vectors = rows + odd[:2] + odd[3:6] + rows[:1] * 40
    check_whitening(whitening.whiten(frame_of(spark, vectors)), vectors)
    assert whitening.whiten(frame_of(spark, vectors + odd[2:3] + odd[6:])).count() == 400  # other lengths and too large ones go
    assert whitening.whiten(frame_of(spark, rows[:1] * 3)).count() == 0
    assert whitening.whiten(frame_of(spark, odd[:2])).count() == 0


def test_whitening_of_far_apart_scales(spark):
    """Standard deviations of 1e9 and below 1: a covariance matrix alone would lose the small one."""
    draw = np.random.default_rng(6)
    rows = np.floor(draw.normal(size=(400, 3)) * [2e9, 2e4, 3]) / 64
    result = whitening.whiten(frame_of(spark, rows.tolist())).collect()
    assert {r.component for r in result} == {1, 2, 3}
    assert all(r.identity_error < 1e-6 for r in result)


def test_whitening_deviation_beyond_64_bits(spark):
    result = whitening.whiten(frame_of(spark, [[1e12, 0.0], [-1e12, 1.0], [0.0, 2.0]])).collect()
    by_id = {r.vec_id: r.deviation for r in result}
    x = np.array([[64 * 10**12, 0], [-64 * 10**12, 64], [0, 128]], object)
    exact = {i: int(((3 * row - x.sum(axis=0)) ** 2).sum()) for i, row in enumerate(x)}
    assert by_id == {i: d if d < 1 << 63 else None for i, d in exact.items()} and None in by_id.values()


def text_of(html, templates=()):
    return pagetext.read_page(html).main_text(set(templates))[0]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<article><p>a<b>b</b>\n c&nbsp;&eacute;&#33;", "ab c é!"),
        ("<body><nav>menu</nav><article><h1>t</h1><p>one<br>two<p>three</article><footer>f</footer>", "t\none two\nthree"),
        ("<article>x<script>var t='</p>';</script>y<style>p{}</style><!-- no --></article>z", "xy"),
        ("<main><div class=cookie-notice>c</div><p>a</p><aside>s</aside><form>f</form><ul><li>1<li>2</ul></main>out", "a\n1\n2"),
        ("<article><header><h1>t</h1></header><p>a</p><section id='comments'><article>c</article></section><footer>f</footer></article>", "t\na"),
        ("<body class='with-sidebar'><div class='has-ads'><p>a</p></div><div role=banner>b</div><header>h</header></body>", "a"),
        ("<div class='sidebar layout'><article><p>a</p></article></div>", "a"), ("<article><p>a</p><article>comment</article></article>", "a"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("</p></div>a</article>", "a"), ("<nav><p>x", ""), ("a<", "a<"),
        ("<article><p><b>one<br><p>two</article>", "one\ntwo"), ("<article><h1>cut &amp</h1><p>&am", "cut &\n&am"), ("a\0b <p", "a�b"),
    ],
)
def test_page_texts(html, text):
    assert text_of(html) == text


def test_page_text_of_deep_and_long_markup():
    assert text_of("<div>" * 20_000 + "deep") == "deep"
    assert text_of("<p>word " * 50_000).count("\n") == 49_999
    assert text_of("<a href='" * 20_000) == ""
    assert len(text_of("<article><p>" + "x" * 3_000_000)) == 3_000_000


def site(i, host, extra=""):
    """A page without telling names: box and frame recur on the host, the rest is its own."""
    return f"<body><div id=q1><p>Get our app {extra}</p></div><div><p>own text {i} of {host}</p></div><table><tr><td>legal</td></tr></table></body>"


def test_templates_go_by_host(spark):
    rows = [(i, f"http://big.example/{i}", site(i, "big")) for i in range(30)]
    rows += [(100 + i, f"http://Small.example/{i}", site(i, "small")) for i in range(3)]
    copies = "<article><p>same prose</p><div class=z>box</div></article>"
    rows += [(200 + i, f"https://copies.example?{i}", copies) for i in range(20)]
    # A sentence that many articles of a host repeat is prose; the box in them is not.
    rows += [(300 + i, f"https://news.example/{i}", f"<article><p>often said</p><p>story {i}</p><div class=z>box</div></article>") for i in range(9)]
    rows += [(400 + i, None, site(0, "none")) for i in range(9)] + [(None, "no scheme", None), (5, "http://big.example/5", site(5, "big"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'h' AS host", "1 AS subtrees", "'t' AS text")
    result = pagetext.extract_text(frame.repartition(4)).collect()
    assert len(result) == len(rows)
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in result}
    for page_id, url, html in rows:
        if url and "big" in url:
            text = f"own text {page_id} of big"
        elif url and "small" in url.lower():
            text = f"Get our app\nown text {page_id - 100} of small\nlegal"
        elif url and "copies" in url:
            text = "same prose\nbox"
        elif url and "news" in url:
            text = f"often said\nstory {page_id - 300}"
        else:
            text = "Get our app\nown text 0 of none\nlegal" if html else ""
        assert found[(page_id, url)] == (text, len(text))
    assert pagetext.extract_text(frame.where("false")).count() == 0


def test_page_text_counts_equal_brute_force(spark, sf_dir):
    """Templates of every host counted in plain Python."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    by_host = {}
    for row in pages.collect():
        page = pagetext.read_page(row.html)
        host = re.match("[^/?#]*", row.url.split("://", 1)[1]).group().lower()
        by_host.setdefault(host, {}).setdefault(page.signature(), page.subtrees())
    expected = {}
    for host, texts in by_host.items():
        held = {}
        for subtrees in texts.values():
            for digest in subtrees:
                held[digest] = held.get(digest, 0) + 1
        often = {d for d, c in held.items() if c >= pagetext.MIN_PAGES and c >= pagetext.MIN_SHARE * len(texts)}
        if often:
            expected[host] = often
    found = {r.host: {bytes(d) for d in r.subtrees} for r in pagetext.host_templates(pages).collect()}
    assert found == expected
