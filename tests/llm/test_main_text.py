from __future__ import annotations

import numpy as np
import pytest

from millrace.llm import main_text
from millrace.llm.dom import read

WRAP = '<html><head><title>T t</title><style>p{}</style></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>'
BODY = "<h1>Title &amp; more</h1><p>First <b>bold</b>   text&nbsp;of the story, which is long enough.<br>Next line.<p>Second one."


def pages(n):
    dice = np.random.default_rng(3)
    for i in range(n):
        words = [f"word{k}" for k in dice.integers(0, 90, 60)]
        cuts = [0, *sorted(dice.integers(1, 60, dice.integers(1, 7)).tolist()), 60]
        text = "".join(f"<p>{' '.join(words[a:b])}.</p>" for a, b in zip(cuts, cuts[1:]) if a < b)
        yield i, f'{WRAP}<div class="ad">Buy {words[0]} now</div><article><h1>{words[1]}</h1>{text}</article><footer>&copy; {words[2]}</footer></body></html>'


@pytest.fixture(scope="module")
def model():
    trees = [read(s) for i, p in pages(60) for s in main_text.labelled(p, 3, i)]
    return main_text.fit(trees)


def text_of(source, model):
    page = read(source)
    content = main_text.beliefs(main_text.forest([page]), model)[0][:, 1] >= np.log(0.5)
    return "\n".join(t for t, c in zip(page.text, content) if t and c)


def test_own_markup(model):
    source = f"{WRAP}<!-- x --><div class='ad'>Buy</div><article>{BODY}</article><footer>&copy; us</footer>"
    assert text_of(source, model) == (
        "Title & more\nFirst bold text of the story, which is long enough. Next line.\nSecond one."
    )


def test_side_matter_of_other_markup(model):
    source = (
        f'{WRAP}<header class="site-header">Name</header><div id="cookie-notice">We use cookies.</div><div id="content">'
        f'{BODY}</p><div class="advert">Buy now</div><p>A third paragraph with a few more words in it.</p></div>'
        '<aside class="sidebar"><p>Popular</p></aside><section id="comments"><h3>1 comment</h3><div class="comment"><p>I '
        "liked this long story about many things very much.</p></div></section><form><p>Mail</p><button>Go</button></form>"
    )
    assert text_of(source, model).split("\n") == [
        "Title & more", "First bold text of the story, which is long enough. Next line.", "Second one.",
        "A third paragraph with a few more words in it.",
    ]


def test_marginals_are_those_of_all_labellings(model):
    page = read("<article><p>one two</p><div class='ad'>x</div></article><p>y z</p>")
    trees = main_text.forest([page])
    n = len(trees.parent)
    own = [model.node[trees.features[a:b]].sum() for a, b in zip(trees.bounds, trees.bounds[1:])]
    total, ones = 0.0, np.zeros(n)
    for code in range(1 << n):
        label = [(code >> k) & 1 for k in range(n)]
        weight = sum(o for o, y in zip(own, label) if y)
        weight += sum(model.edge[trees.kind[k], label[trees.parent[k]], label[k]] for k in range(n) if trees.parent[k] >= 0)
        total += np.exp(weight)
        ones += np.exp(weight) * np.array(label)
    assert np.allclose(np.exp(main_text.beliefs(trees, model)[0][:, 1]), ones / total)


def test_broken_markup_never_fails():
    for source in ("", "<", "<<p", "a < b", "<p", "<!--", "<script>x", "</p></div>", "<td>x<li>y", "<a><div>t", "<x y='>"):
        read(source)
    assert [t for t in read("1 < 2 &lt; 3").text if t] == ["1 < 2 < 3"]
    assert [t for t in read("<script>a</script>b<style>c</style >d").text if t] == ["bd"]


def slow_texts(source):
    """Text blocks by the parser of the standard library, for plain markup with scripts."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        hidden, parts, out = 0, [], []

        def flush(self):
            text = " ".join("".join(self.parts).split())
            self.out += [text] if text else []
            self.parts = []

        def handle_starttag(self, tag, attrs):
            if tag in ("script", "style"):
                self.hidden = 1
            elif tag != "b":
                self.flush()

        def handle_endtag(self, tag):
            if tag in ("script", "style"):
                self.hidden = 0
            elif tag != "b":
                self.flush()

        def handle_data(self, data):
            if not self.hidden:
                self.parts.append(data)

    reader = Reader()
    reader.parts, reader.out = [], []
    reader.feed(source)
    reader.close()
    reader.flush()
    return reader.out


def test_scripts_with_any_signs_swallow_nothing():
    shown = "<script>if(a<b) // don't\n f()</script><p>He said 'no' to it all.</p><p>Second block's here.</p>"
    assert [t for t in read(shown).text if t] == ["He said 'no' to it all.", "Second block's here."]
    dice = np.random.default_rng(8)
    inside = ["a<b", "'", '"', "<!-", "x='<p>'", "</p>", "<a href='", "->", "\n", "&lt;", "if (i<3) {"]
    outside = ["He said 'no'", "<b>bold</b>", '"quoted"', "more &amp; more", "it's", "5 > 4"]
    for _ in range(300):
        source = ""
        for _ in range(dice.integers(1, 6)):
            tag = dice.choice(["script", "style"])
            source += f"<{tag}>{''.join(dice.choice(inside, dice.integers(0, 6)))}</{tag}>"
            source += f"<p>{' '.join(dice.choice(outside, dice.integers(0, 5)))}</p>"
        assert [t for t in read(source).text if t] == slow_texts(source), source


def test_unclosed_and_nested_tags_take_linear_time(model):
    import time

    source = "<article>" * 100_000 + "<p>text"
    start = time.perf_counter()
    assert not main_text.labels_itself(source)
    assert not main_text.labels_itself("<article>" * 50_000 + "</main>" * 50_000)
    assert time.perf_counter() - start < 1
    start = time.perf_counter()
    for tag in ("div", "article", "li", "p"):
        page = read(f"<p><table>{f'<{tag}>' * 100_000}one</{tag}>two")
        assert [t for t in page.text if t] in (["one", "two"], ["onetwo"])
    assert time.perf_counter() - start < 12
    assert main_text.forest([page]).depth.max() <= 600


def test_the_outermost_container_counts():
    nested = "<main>a<article>b</article><article>c</article>d</main>"
    assert main_text.labels_itself(f"<script>'<main></main>'</script><!-- <main></main> -->{nested}<article>")
    first = next(main_text.labelled(nested, 0, 1))
    assert first == '<main data-label="1">a<article>b</article><article>c</article>d</main>'
    assert not main_text.labels_itself(nested + "<main></main>") and not main_text.labels_itself(None)


def test_without_any_container_menus_and_footers_stay_out(spark):
    rows = [(i, "u", p.replace("<article>", '<div class="story">').replace("</article>", "</div>")) for i, p in pages(60)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_text.extract(table, main_text.train(table)).collect()}
    source = dict((i, p) for i, p in pages(60))
    for i, text in got.items():
        assert "Home" not in text and "Buy" not in text and "\u00a9" not in text
    kept = sum(t.count("word") for t in got.values()) / sum(s.split("<article>")[1].count("word") for s in source.values())
    assert kept > 0.9


def test_over_a_table(spark):
    rows = [*((i, "u", p) for i, p in pages(40)), (50, None, None), (51, "u", ""), (0, "u", next(pages(1))[1])]
    rows += [(None, "u", "<article><p>" + "many words " * 50_000 + "</p></article>")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = main_text.extract(table, main_text.train(table)).collect()
    assert len(got) == len(rows)
    found = {r.page_id: r.text for r in got}
    assert found[50] == found[51] == ""
    assert len(found[0].split("\n")) == 1 + rows[0][2].count("<p>") and "Buy" not in found[0]
    assert all(r.n_chars == len(r.text) for r in got)
    assert main_text.extract(table.limit(0), main_text.train(table.limit(0))).count() == 0


def test_one_page_in_a_thousand_labels_itself(spark):
    plain = f"{WRAP}<div class='x'><p>Some words of no known container.</p></div><footer>&copy; us</footer>"
    rows = [(i, "u", plain) for i in range(4000)]
    rows += [(10_000 + i, "u", p) for i, p in pages(4)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = main_text.train(table, main_text.Settings(max_pages=20))
    assert model.node.any()
    got = text_of(next(pages(1))[1], model)
    assert "Buy" not in got and "Home" not in got and "word" in got
