"""Main text of pages: the given pages by plain patterns, and hand-made pages of other layouts."""

from __future__ import annotations

import html
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from gridloom.llm import page_text as P
from gridloom.llm import queries

from .fixtures import EXTRA

PAGES = "page_id long, url string, html string"


def by_patterns(page):
    """Text of the given tables' layout: the article's blocks, told by where its tags stand."""
    page = re.sub(r"<!--.*?-->|<(script|style)>.*?</\1>", "", page or "", flags=re.S)
    inner = "".join(re.findall(r"<article>(.*?)</article>", page, flags=re.S))
    blocks = [html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def test_query_equals_brute_force(spark, sf_dir):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{sf_dir}/pages.parquet'").fetchall()
    got = queries.op11_page_text(spark, sf_dir)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect())) == sorted((i, u, by_patterns(h), len(by_patterns(h))) for i, u, h in rows)


LONG, OTHER = "This paragraph holds enough words to be told from a menu, a button or a line of small print at once.", "A second paragraph goes on with the story, and it ends where the first one might have begun."
CASES = {
    "no article": (f"<div class='menu'><a href=1>Home</a> <a href=2>News</a></div><div id=content><h2>Title of it all</h2><p>{LONG}</p><p>{OTHER}</p></div><div class='footer'>All rights</div>", f"Title of it all\n{LONG}\n{OTHER}"),
    "bare menus": (f"<ul><li><a>One</a><li><a>Two</a><li><a>Three</a><li><a>Four</a></ul><div><p>{LONG}<p>{OTHER}</div><div><a>Imprint</a> <a>Contact</a></div>", f"{LONG}\n{OTHER}"),
    "comments": (f"<article><h1>Head</h1><p>{LONG}</p><section id='comments'><article class='comment'><p>{OTHER}</p></article></section></article>", f"Head\n{LONG}"),
    "sidebars": (f"<header><h1>Site</h1><nav><a>x</a></nav></header><main><p>{LONG}</p><aside><p>{OTHER}</p></aside><p>Short.</p></main><div class='left-sidebar'><p>{OTHER}</p></div>", f"{LONG}\nShort."),
    "notices": (f"<div role=alert>{OTHER}</div><div class=cookieBanner><p>{OTHER}</p><button>OK</button></div><article><p>{LONG}</p><p class='notice'>{OTHER}</p></article><dialog>{OTHER}</dialog>", LONG),
    "forms": (f"<article><p>{LONG} <button>Share</button> More.</p><form><p>{OTHER}</p><select><option>a<option>b</select></form></article>", f"{LONG} More."),
    "article header": (f"<article><header><h1>Own title</h1></header><div class='post-header'>Line</div><p>{LONG}</p><footer>Filed under</footer></article>", f"Own title\nLine\n{LONG}"),
    "inline advert": (f"<article><p>{LONG} <span class='ad'>Buy this</span>{OTHER}</p></article>", f"{LONG} {OTHER}"),
    "references": ("<article><p>a &lt;b&gt; &amp;amp; &copy; &#233;&#x1F600; &nbsp;&nbsp;c &am d&ampe</p><p>x\n\t y<br>z</p></article>", "a <b> &amp; © é😀 c &am d&e\nx y z"),
    "scripts": (f"<article><p>One <script>if (a < b) document.write('</p><p>no')</script>two</p><style>p{{}}</style><noscript>no</noscript><!-- <p>no</p> --><template>no</template></article>", "One two"),
    "cut in a tag": (f"<article><p>{LONG}</p><p>Next <a href='x", f"{LONG}\nNext"),
    "cut in a comment": (f"<article><p>{LONG}</p><!-- never ends <p>{OTHER}</p>", LONG),
    "cut in a script": (f"<article><p>{LONG}</p><script>var t = '<p>no</p>';", LONG),
    "no head end": (f"<html><head><title>T</title><body class='has-sidebar with-comments'><article class='post has-ads'><p>{LONG}</p></article>", LONG),
    "stray tags": (f"</div></b><article></p><p><b>{LONG}</div></i><p>{OTHER}</b></article></section>", f"{LONG}\n{OTHER}"),
    "lists and tables": (f"<article><p>{LONG}</p><ul><li>One<li>Two</ul><table><tr><td>a<td>b<tr><td>c</table><pre>d\n  e</pre></article>", f"{LONG}\nOne\nTwo\na\nb\nc\nd e"),
    "named": (f"<div class='menu'><a>Home</a></div><p>{OTHER}</p><div class='Post-Content wide'><p>{LONG}</p><p>End.</p></div>", f"{LONG}\nEnd."),
    "only a menu": ("<nav><a>One</a></nav><footer>Two</footer>", ""),
    "no tags": (LONG, LONG),
    "blank": (" \n ", ""),
    "empty": ("", ""),
    "null": (None, ""),
    "deep": ("<div>" * 3000 + f"<article><p>{LONG}</p></article>" + "</div>" * 3000, LONG),
    "long": ("<article>" + f"<p>{LONG}</p>" * 5000 + "</article>", "\n".join([LONG] * 5000)),
}


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, name, CASES[name][0]) for i, name in enumerate(CASES)]
    df = spark.createDataFrame(rows + rows[:2] + [(None, None, CASES["no tags"][0])], PAGES).withColumns({c: F.lit(c) for c in (*EXTRA, "text", "blocks", "n_chars", "features")})
    return P.main_text(df).collect()


@pytest.mark.parametrize("name", list(CASES))
def test_layouts(found, name):
    assert {r.text for r in found if r.url == name} == {CASES[name][1]}


def test_rows_and_counts(found):
    assert len(found) == len(CASES) + 3 and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found if r.page_id is None] == [LONG]


def test_the_tree_decides(spark):
    """Labels turned round turn the text round, and the tree uses more than the markup."""
    df = spark.createDataFrame([(1, "u", CASES["no article"][0])], PAGES)
    turned = P.main_text(df, P.labelled(spark).withColumn("label", 1 - F.col("label"))).first().text
    assert LONG not in turned and "Home" in turned
    model = P.train(P.labelled(spark))
    assert {P.FEATURES[i] for i, x in enumerate(model.featureImportances.toArray()) if x > 0} >= {"aside", "place"} and len(model.featureImportances.indices) > 2


def test_the_column_is_the_tree(spark):
    table = P.labelled(spark)
    model = P.train(table)
    from pyspark.ml.functions import array_to_vector

    both = model.transform(table.withColumn("f", F.col("features")).withColumn("features", array_to_vector("features")))
    assert both.where(P.as_column(model, F.col("f")) != (F.col("prediction") == 1)).count() == 0
    assert both.where("prediction <> label").count() <= 2


def test_blocks_know_their_neighbours():
    blocks = P.Blocks().read("<nav><a>one two</a> three</nav><article><p>a b c <a>d</a></p></article>")
    assert P.described(blocks) == [[3, 2 / 3, 0, 0, 4, 0.25, 1, -1], [4, 0.25, 3, 2 / 3, 0, 0, 0, 1]]


def test_no_rows(spark):
    assert P.main_text(spark.createDataFrame([], PAGES)).collect() == []
