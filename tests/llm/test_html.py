import pytest
from pyspark.sql import functions as F

from tillroll.llm import html

PARTS = ["one &amp; two &copy;", "a  b\n\tc", "<b>bold</b> and <i>thin</i>", "line<br>next", "plain words here", "1 &lt; 2"]
CLEAN = ["one & two ©", "a b c", "bold and thin", "line next", "plain words here", "1 < 2"]
AROUND = [
    '<nav><ul><li><a href="/">home</a></ul></nav>', '<div class="ad">buy</div>', '<script>var t="</p>";</script>', "<style>p{}</style>",
    "<!-- no --><footer>&copy; all</footer>", '<aside class="sidebar">side</aside>', '<form><p>mail</p><button>go</button></form>',
    '<div class="cookie-notice"><p>we use</p></div>', '<div id="comments"><p>nice</p></div>',
]


def page(n):
    chosen = [(n * 7 + i * 3) % len(PARTS) for i in range(1 + n % 5)]
    body = "".join(f"<p>{PARTS[i]}" + ("</p>" if i % 2 else "") for i in chosen)
    before, after = AROUND[n % 9] + AROUND[(n + 2) % 9], AROUND[(n + 4) % 9]
    text = f"<html><head><title>t</title></head><body>{before}<article><h1>Head {n}</h1>{body}</article>{after}</body></html>"
    return text, " ".join([f"Head {n}"] + [CLEAN[i] for i in chosen])


@pytest.fixture(scope="module")
def model():
    return html.train([page(n)[0] for n in range(200)])


def test_held_out_pages(model):
    wanted = [page(n) for n in range(1000, 1200)]
    pages = [html.blocks_of(h) for h, _ in wanted]
    labels = model.label([[html.features(*b) for b in p] for p in pages])
    found = [" ".join(t for (_, t), keep in zip(p, row) if keep) for p, row in zip(pages, labels)]
    assert sum(f == w for f, (_, w) in zip(found, wanted)) >= 196


def test_column(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "<", "x"), (4, page(5)[0], "x"), (4, page(5)[0], "x"), (5, "<article>" + "<p>word word " * 20_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = [(r.page_id, r.out) for r in df.withColumn("out", html.extractor(spark, model)(F.col("html"))).collect()]
    assert len(found) == len(rows) and found[0][1] == found[1][1] == ""
    assert found[3][1] == found[4][1] == page(5)[1]
    assert found[5][1].count("word") == 40_000
    assert html.fit(df.where("false")).label([[]])[0].tolist() == []


def test_slopes_are_those_of_differences():
    import numpy as np

    draw = np.random.default_rng(1)
    model = html.Labeller()
    x, mask = draw.standard_normal((2, 4, 8 * html.HIDDEN)).astype(np.float32), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], np.float32)
    error = draw.standard_normal((2, 4)).astype(np.float32) * mask
    tape = []
    _, states = model.forward(x, mask, tape)
    _, d_x = model.gradients(x, error, states, tape)
    for n, t, k in [(0, 0, 1), (0, 3, 30), (1, 1, 7), (1, 0, 40)]:
        moved = x.copy()
        moved[n, t, k] += 1e-2
        back = x.copy()
        back[n, t, k] -= 1e-2
        slope = ((model.forward(moved, mask)[0] - model.forward(back, mask)[0]) * error).sum() / 2e-2
        assert abs(slope - d_x[n, t, k]) < 2e-3
