import numpy as np
import pytest

from barsmith.llm import extract as ex
from barsmith.llm.htmlblocks import blocks_of

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav><!-- ad <p>x</p> -->
<div class="ad">Buy now</div><article><h1>A &amp; B&nbsp;C</h1><p><b>One  two<br>three<p>Four <i>five</i>six.</p>
<p>Seven.</article><footer>&copy; site</footer></body></html>"""


@pytest.fixture(scope="module")
def net():
    return ex.train()


def test_blocks():
    got = [(b.text, b.path) for b in blocks_of(PAGE)]
    assert [t for t, _ in got] == ["Home", "More", "Buy now", "A & B C", "One two three", "Four fivesix.",
                                   "Seven.", "© site"]
    assert got[2][1] == ("html", "body", "div", ".ad")
    assert got[5][1] == ("html", "body", "article", "p")
    assert [b.linked for b in blocks_of(PAGE)][:3] == [4, 4, 0]


@pytest.mark.parametrize("page,texts", [
    (None, []), ("", []), ("plain", ["plain"]), ("<p", []), ("a<br>b<!-- x", ["a b"]), ("<p>a</b>c</div>d", ["ac", "d"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>x", ["1", "2", "3", "x"]), ("<script>a", []), ("<a title='>'>k</a>", ["k"]),
    ("<dl><dt>a<dd>b</dl>", ["a", "b"]), ("<select><option>a</select>b", ["b"]), ("<P>x</P><Custom-El>y", ["x", "y"])])
def test_odd_markup(page, texts):
    assert [b.text for b in blocks_of(page)] == texts


@pytest.mark.parametrize("tag", ["button", "select", "datalist", "object", "svg", "math"])
def test_unclosed_hidden_element_ends_at_the_next_block(tag):
    texts = lambda page: [b.text for b in blocks_of(page)]
    assert texts(f"<p>One</p><{tag} class=x>gone<p>Two</p><div>Three</div>") == ["One", "Two", "Three"]
    assert texts(f"<p>One<{tag}><div>gone</div></{tag}> two</p>") == ["One two"]
    if tag in ("button", "select", "datalist"):
        assert texts(f"<{tag}>gone<p>One</p><{tag}>gone</{tag}><p>Two</p>") == ["One", "Two"]
    assert texts("<p>One</p><script>gone<p>gone</p>") == ["One"]


def test_long_and_broken_pages(net):
    """Work grows with the page, whatever is left unclosed."""
    assert [b.text for b in blocks_of("<b><p>x</p>" * 3000)] == ["x"] * 3000
    assert max(len(b.path) for b in blocks_of("<b><p>x</p>" * 3000)) == 64
    assert blocks_of("<button>" * 20000) == []
    assert [b.text for b in blocks_of("<div>" * 20000 + "x")] == ["x"]
    marked = blocks_of(f"<div class='{'a b ' * 5000}'><p>x</p></div>")
    assert len(marked[0].path) == 64 and marked[0].path[0] == "div" and marked[0].path[-1] == "p"
    page = "<article><h1>Rain in May</h1>" + "<p>Many rivers rose by a metre.</p>" * 8000 + "</article>"
    long, short = ex.main_texts(net, [page, PAGE])
    assert long.count("Many rivers") == 8000 and short == ex.main_texts(net, [PAGE])[0]


def test_article_of_all_kinds_of_blocks(net):
    body = ("<div><h1>The rain of the year</h1><p>It rained a lot in the north, and less in the south.</p>"
            "<p>Many rivers rose by a metre or more.</p><table><tr><th>Town</th><th>Rain</th></tr><tr><td>Ash</td>"
            "<td>100</td></tr></table><figure><img src=x><figcaption>A river in May.</figcaption></figure>"
            "<p>More rain is expected.</p></div>")
    whole = "\n\n".join(b.text for b in blocks_of(body))
    menu, foot = "<nav><ul><li><a href='/'>Home</a></li></ul></nav>", "<footer>copyright</footer>"
    assert ex.main_texts(net, [body, f"<html><body>{menu}{body}{foot}</body></html>"]) == [whole, whole]


def test_recall_by_tag_on_held_out_pages(net):
    pages, labels = ex.labelled_pages(150, seed=78)
    f, y = ex.Features(pages), np.concatenate(labels)
    tags = np.array([next(x for x in reversed(b.path) if x[0] != ".") for p in pages for b in p])
    own = net.scores(f) >= 0.5
    for tag in ("p", "h2", "li", "td", "th", "dt", "dd", "figcaption", "blockquote", "pre"):
        assert own[(tags == tag) & (y == 1)].mean() > 0.9, tag


def slow_scores(net, blocks):
    """One page, block by block, with plain numbers."""
    from math import exp, log1p, tanh
    import string
    import zlib
    sig = lambda v: 1 / (1 + exp(-v))
    mean = lambda rows: [sum(c) / len(rows) for c in zip(*rows)]
    f = ex.Features([blocks])
    xs = []
    for k, b in enumerate(blocks):
        names = [*b.path, ">" + ">".join(b.path[-2:])]
        path = mean([net.w["path"][zlib.crc32(n.encode()) % ex.PATH_ROWS].tolist() for n in names])
        rows = f.word[f.word_first[k]:f.word_first[k + 1]]
        word = mean([net.w["word"][r].tolist() for r in rows]) if len(rows) else [0.0] * net.w["word"].shape[1]
        n = len(b.text)
        size = len(b.text.encode())
        xs.append(path + word + [
            log1p(n) / 5, log1p(len(rows)) / 4, b.linked / n, 5 * sum(c in ".,;:!?" for c in b.text) / size,
            2 * sum(c in string.digits for c in b.text) / size, k / len(blocks), len(b.path) / 10, 1.0])

    def read(seq, d):
        h = net.hidden
        into, rec, bias = (net.w[x + d].tolist() for x in ("in_", "rec_", "bias_"))
        state, cell, out = [0.0] * h, [0.0] * h, []
        for x in seq:
            g = [bias[j] + sum(v * into[i][j] for i, v in enumerate(x)) +
                 sum(v * rec[i][j] for i, v in enumerate(state)) for j in range(4 * h)]
            cell = [sig(g[h + j]) * cell[j] + sig(g[j]) * tanh(g[3 * h + j]) for j in range(h)]
            state = [sig(g[2 * h + j]) * tanh(cell[j]) for j in range(h)]
            out.append(state)
        return out

    ahead, back = read(xs, "f"), read(xs[::-1], "b")[::-1]
    top = net.w["out"].tolist()
    return [sig(float(net.w["out_bias"][0]) + sum(w * v for w, v in zip(top, a + b + x)))
            for a, b, x in zip(ahead, back, xs)]


def test_batched_scores_equal_a_slow_forward_pass(net):
    pages = ex.labelled_pages(6, seed=9)[0] + [blocks_of(PAGE)]
    want = [s for p in pages for s in slow_scores(net, p)]
    assert np.abs(net.scores(ex.Features(pages)) - want).max() < 1e-3
    assert np.abs(net.scores(ex.Features(pages), pages=2, cells=30) - want).max() < 1e-3


def test_made_pages_held_out(net):
    pages, labels = ex.labelled_pages(150, seed=77)
    f = ex.Features(pages)
    y = np.concatenate(labels)
    own = net.scores(f) >= 0.5
    assert (own == y).mean() > 0.97


def test_gradients_by_finite_differences():
    pages, labels = ex.labelled_pages(4, seed=5)
    f, y = ex.Features(pages), np.concatenate(labels).astype(np.float32)
    net = ex.BlockLabeller(hidden=4, path_dim=3, word_dim=2, seed=1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    before = {k: v.copy() for k, v in net.w.items()}

    def loss():
        at, mask = net._padded(f, np.arange(4))
        z = net._logits(net.inputs(f)[at], mask)[0][mask]
        t = y[at[mask]]
        return (np.logaddexp(0, z) - t * z).mean()

    state = {}
    net.step(f, y, np.arange(4), state, 0.0)
    for name in before:
        grad = state[name][0] * 10
        k = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        eps = 1e-3
        net.w = {n: v.astype(np.float64).copy() for n, v in before.items()}
        net.w[name][k] += eps
        up = loss()
        net.w[name][k] -= 2 * eps
        assert abs((up - loss()) / (2 * eps) - grad[k]) < 5e-3 * max(1, abs(grad[k])), name


def test_query_result(spark, net):
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (2, None, None, "t"), (3, "u", "<nav><a href=x>a</a></nav>", "t"),
                                   (1, "u", PAGE, "t")], "page_id long, url string, html string, text string")
    got = sorted((r.row.page_id, r.text) for r in ex.extract(pages, net).collect())
    main = "A & B C\n\nOne two three\n\nFour fivesix.\n\nSeven."
    assert got == [(1, main), (1, main), (2, ""), (3, "")]
    assert ex.extract(pages.limit(0), net).count() == 0


def test_given_pages(spark, net):
    """In the given pages the main text is the article element."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r, text in zip(rows, ex.main_texts(net, [r.html for r in rows])):
        inside = blocks_of(r.html.split("<article>")[1].split("</article>")[0])
        assert text == "\n\n".join(b.text for b in inside)
