"""Blocks, both passes and texts of pages against planted pages and a plain second pass."""

import random

import duckdb
import numpy as np
import pytest

from starlens.llm import html_text as ht
from starlens.llm import queries

PROSE = "It was the first of the days that we had in the house, and all of the people who came to see it were as glad as they could be on such a day."
MORE = "Der Garten, den sie in der Nähe von dem Haus mit der Hand angelegt hatte, war nicht so groß wie er auf dem Bild aus der Zeitung von damals ist, aber er war schön."
SHORT = "Xyz qrs."
OUTER = ("<html><head><title>T &amp; U</title><style>p{}</style><script>if (a < b) { x('</p>') }</script></head><body class='has-sidebar'>"
         "<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>{}<footer>&copy; Site, " + PROSE + "</footer></body></html>")

PAGES = {
    "article": ("<article><h1>Title</h1><p>" + PROSE + "<p>" + SHORT + "<br>line</article>", ["Title", PROSE, SHORT + " line"]),
    "aside in the article": ("<article><h1>Title</h1><p>" + PROSE + "</p><aside><p>" + PROSE + "</p></aside><div class='ad-box x'>Buy the best of it</div><p>" + SHORT + "</p></article>", ["Title", PROSE, SHORT]),
    "inline advert": ("<article><p>One <b>bold</b><span class=sponsored>Buy!</span> word</p></article>", ["One bold word"]),
    "comments by class": ("<article><p>" + SHORT + "</p><section id=comments><h2>3 voices</h2><p>" + PROSE + "</p></section></article>", [SHORT]),
    "comments by heading": ("<article><p>" + SHORT + "</p><div><h2>3 Comments</h2><p>" + PROSE + "</p><h3>Bob</h3><p>" + MORE + "</p></div><p>after</p></article>", [SHORT, "after"]),
    "comments outside": ("<article><p>" + SHORT + "</p></article><div><p>" + PROSE + "</p></div>", [SHORT]),
    "link list in the article": ("<article><p>" + PROSE + "</p><p>" + MORE + "</p><h2>See also</h2><ul><li><a href=1>One of these</a><li><a href=2>Two of these</a></ul></article>", [PROSE, MORE]),
    "form and notice": ("<div role=alert>" + PROSE + "</div><article><form><label>Name <input></label><textarea>" + PROSE + "</textarea></form><p>" + SHORT + "</article>", [SHORT]),
    "all in a form": ("<form id=aspnet><main><p>" + SHORT + "</p></main></form>", [SHORT]),
    "no article": ("<div><p>News of today</p><p>" + PROSE + "</p><p>" + SHORT + "</p><p>" + MORE + "</p></div><div><a href=1>Imprint</a> <a href=2>Privacy</a></div>", ["News of today", PROSE, SHORT, MORE]),
    "sidebar without article": ("<div id=content><h1>Title</h1><p>" + PROSE + "</p></div><div class='left-sidebar'><p>" + MORE + "</p></div>", ["Title", PROSE]),
    "content with sidebar": ("<div class='content-with-sidebar'><p>" + PROSE + "</p></div>", [PROSE]),
    "references": ("<main><p>a&amp;lt; &#8217;&#x41; &eacute;&nbsp;&nbsp;x &am &notin; &bogus; &#0;</main>", ["a&lt; ’A é x &am ∉ &bogus; �"]),
    "double breaks": ("<main>one<br>two<br><br>three<br> <br>four</main>", ["one two", "three", "four"]),
    "quoted signs": ("<main><p title='a > b' data-x=\"</p>\">one</p><!-- a > <p>no</p> --><p>two 1 < 2 </3</p></main>", ["one", "two 1 < 2"]),
    "tables": ("<main><table><tr><td>a<td><p>b</div></table>c</main>", ["a", "b", "c"]),
    "article header": ("<article><header><h1>Title</h1></header><p>" + SHORT + "</p><footer>Filed in the news</footer></article>", ["Title", SHORT]),
    "unclosed noscript": ("<article><noscript><p>Turn it on</noscript><p>" + SHORT + "</p></article>", [SHORT]),
    "comment article": ("<article class=post><p>" + SHORT + "</p></article><article class=comment><p>" + PROSE + "</p></article>", [SHORT]),
}


def text_of(html):
    texts, _, _, main = ht.labelled([html])
    return [t for t, kept in zip(texts, main, strict=True) if kept]


@pytest.mark.parametrize("name", list(PAGES))
def test_planted_pages(name):
    inner, want = PAGES[name]
    assert text_of(OUTER.replace("{}", inner)) == want
    assert text_of(inner) == want


def test_cut_off_and_odd_pages():
    assert text_of("") == text_of("<article></article>") == text_of("<p") == text_of("<script>x") == text_of("<!-- x") == []
    assert text_of("<article><p>one</p><a href='x") == ["one"]
    assert text_of("<article><p>one<script>two") == ["one"]
    assert text_of("</p></div></article>only text") == ["only text"]
    assert text_of("<div>" * 5000 + "deep" + "</div>" * 5000) == ["deep"]
    for hostile in ("<a" * 50_000, "<b " * 50_000 + '="' + ">" + '"', "<!--" * 50_000, "&" * 50_000, "<p><b>" * 20_000, "</p>" * 50_000):
        ht.Page(hostile)  # ends in time


def plain_second_pass(first, page, level, marked):
    out = []
    for i in range(len(first)):
        mine = [j for j in range(len(first)) if page[j] == page[i] and first[j] > -2]
        if first[i] == -2:
            out.append(False)
            continue
        if first[i]:
            out.append(first[i] > 0)
            continue
        k = mine.index(i)
        back = next(((d, first[mine[k - d]]) for d in range(1, k + 1) if first[mine[k - d]]), (k + 1, 1) if marked[i] else (10**9, 1))
        ahead = next(((d, first[mine[k + d]]) for d in range(1, len(mine) - k) if first[mine[k + d]]), None)
        if level[i] > 1 and ahead:
            out.append(ahead[1] > 0)
            continue
        ahead = ahead or ((len(mine) - k, 1) if marked[i] else (10**9, 1))
        out.append(max(back[1], ahead[1]) > 0 if back[0] == ahead[0] else min(back, ahead)[1] > 0)
    return out


def test_second_pass_against_a_plain_one():
    draw = random.Random(5)
    for _ in range(300):
        n = draw.randrange(0, 30)
        page = sorted(draw.randrange(4) for _ in range(n))
        of_page = [draw.random() < 0.5 for _ in range(4)]
        first = np.array([draw.choice((-2, -1, 0, 0, 0, 1)) for _ in range(n)], np.int64)
        level = np.array([draw.choice((0, 0, 1, 2)) for _ in range(n)], np.int64)
        marked = np.array([of_page[p] for p in page], bool)
        assert ht.second_pass(first, np.array(page, np.int64), level, marked).tolist() == plain_second_pass(first, page, level, marked)


def test_tables_of_pages(spark):
    rows = [(1, None), (2, ""), (3, OUTER.replace("{}", PAGES["article"][0])), (3, OUTER.replace("{}", PAGES["article"][0])), (None, "<main>x</main>"), (4, "<main>" + f"<p>{PROSE} é" * 30_000 + "</main>")]
    pages = spark.createDataFrame([(i, h, "clash", 1) for i, h in rows], "page_id long, html string, text string, block int").repartition(2)
    out = ht.main_text(pages).select("page_id", "text").collect()
    one = "\n".join(PAGES["article"][1])
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, [(1, ""), (2, ""), (3, one), (3, one), (None, "x"), (4, "\n".join([PROSE + " é"] * 30_000))]))
    blocks = ht.page_blocks(pages).where("page_id = 3 and main").select("block", "text").distinct().orderBy("block").collect()
    assert [b.text for b in blocks] == PAGES["article"][1]
    assert ht.main_text(pages.where("page_id < 0")).count() == ht.page_blocks(pages.where("page_id < 0")).count() == 0


def test_query_against_sql(spark, tables):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tables}/pages.parquet'")
    got = queries.op11_main_text(spark, tables)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.MAIN_TEXT_SQL})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
