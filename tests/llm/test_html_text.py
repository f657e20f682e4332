"""Leaf blocks, the field's inference against enumeration, extraction on the given and on unlike pages."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F, types as T

from journeyloom.llm.html_text import Field, block_features, dressed_page, extract_pages, labelled_pages, leaf_blocks, main_text, seed_labels, trained_field

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("text", T.StringType())])


def test_leaf_blocks_of_broken_mark_up():
    html = '<p>one &amp; <b>two<p>three\n  four<br>five<ul><li>a<li>b</ul><script>var x="</p>";</script><style>p{}</style><!-- no --><![if x]>six<div>x<span>y</div>&lt;z&nbsp;&#233;'
    assert [b.text for b in leaf_blocks(html)] == ["one & two", "three four five", "a", "b", "six", "xy", "<z é"]
    assert leaf_blocks(None) == [] and leaf_blocks("") == [] and leaf_blocks("<<<>") is not None
    assert leaf_blocks("<div class='adSlot'><p>t</p></div>")[0].names == {"ad", "slot"}


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(2)
    for n in range(1, 7):
        blocks = leaf_blocks("".join(f"<p class=c{'abcdefg'[i]}x>t{i}</p>" for i in range(n)))
        names = {f for i, b in enumerate(blocks) for f in block_features(b, i, n)}
        model = Field({f: tuple(rng.normal(size=2)) for f in sorted(names)}, tuple(map(tuple, rng.normal(size=(2, 2)))))
        emit = model.emissions(blocks)
        value = lambda y: sum(e[k] for e, k in zip(emit, y, strict=True)) + sum(model.pairs[a][b] for a, b in itertools.pairwise(y))  # noqa: B023, E731
        assert tuple(model.viterbi(blocks)) == max(itertools.product((0, 1), repeat=n), key=value)


def test_given_pages_and_unseen_dresses(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.join(extract_pages(pages), "page_id").select("html", "text").collect()
    assert len(rows) == 250
    for r in rows:
        blocks = leaf_blocks(r.html)
        assert r.text == "\n".join(b.text for b, y in zip(blocks, seed_labels(blocks), strict=True) if y)
    htmls = [r.html for r in rows]
    model = trained_field(labelled_pages(htmls[:120]))
    rng, right, total = random.Random(5), 0, 0
    other = ["Home", "About us", "Follow us on every channel", "All rights reserved", "We use cookies to improve this site", "Sign up for news"]
    for html in htmls[120:]:
        blocks = leaf_blocks(html)
        content = [b.text for b, y in zip(blocks, seed_labels(blocks), strict=True) if y][:9]
        page, labels = dressed_page(rng, content, other)
        found = leaf_blocks(page)
        assert len(found) == len(labels)
        right += sum(a == b for a, b in zip(model.viterbi(found), labels, strict=True))
        total += len(labels)
    assert right >= 0.97 * total
    page = '<body><div id="sideBar"><p>Other stories you may like</p></div><div class="post-content"><p>First words of the story.</p><form><p>Sign up</p></form><p>Second part.</p></div><div class="comments"><p>I liked this story a lot.</p></div></body>'
    assert main_text(model, page) == "First words of the story.\nSecond part."
    page = '<body><header><h1>Site of the town</h1></header><article><header class="article-header"><h1>A title of the story</h1></header><p>First words of the story.</p></article></body>'
    assert main_text(model, page) == "A title of the story\nFirst words of the story."


def test_text_of_formulas_and_fall_backs_is_kept():
    html = "<p>Energy is <math><mi>E</mi><annotation>\\\\E</annotation></math> here.</p><noscript><p>Without scripts</p></noscript><p><object data=x>a fall-back</object> <svg><title>t</title><text>label</text></svg><iframe><b>raw</b></iframe></p>"
    assert [b.text for b in leaf_blocks(html)] == ["Energy is E here.", "Without scripts", "a fall-back label"]


def test_very_long_page():
    model = Field({"own p": (0.0, 1.0)})
    html = "<div>menu</div>" + "<p>some words &amp; more</p>" * 20_000 + "<p>" + "long " * 200_000 + "</p>"
    assert main_text(model, html) == "\n".join(["some words & more"] * 20_000 + [("long " * 200_000).strip()])


def test_odd_rows(spark):
    assert extract_pages(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, None, "x"), (2, "u", "", None), (3, "u", "<script>a</script>", None), (None, None, "plain text", None), (3, "u", "<script>a</script>", None)]
    got = sorted((r.page_id or 0, r.n_chars, len(r.text)) for r in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [g[0] for g in got] == [0, 1, 2, 3, 3] and all(g[1] == g[2] for g in got) and got[1][1] == 0
    assert extract_pages(spark.createDataFrame(rows, SCHEMA)).where(F.col("text").isNull()).count() == 0
