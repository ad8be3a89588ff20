"""Character references and forms of links."""

import html

from pyspark.sql import functions as F

from starlens.llm import warc

TEXTS = ["&#8217;&#xE9;&#XE9;", "caf&eacute; &mdash; &euro;5", "&amp;lt; &amp;amp; &amp;#39;", "a & b &; &unknown; &", "&copy 2020 &eacutes", "&#0; &#x110000; &#99999999999; &#xD800; &#128; &#150;", "&NotEqualTilde; &AMP; &#128512;", "", "&lt;b&gt;", "&#38;lt; &#00065;&#65 x"]


def test_all_references_are_decoded_once(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, x string").select("i", warc.decoded(F.col("x")).alias("y")).collect()
    assert {TEXTS[r["i"]]: r["y"] for r in rows} == {x: html.unescape(x) for x in TEXTS}


def test_links_of_all_forms(spark):
    page = """<a href=/x>1</a><a class=c href="it's">2</a><A HREF='say "y"'>3</A><a href="/q?a=1&copy=2&amp;b=&#233;">4</a><a href="">5</a><a href=/y/>6</a>"""
    (row,) = spark.createDataFrame([(page,)], "h string").select(warc.links("h").alias("x")).collect()
    assert row["x"] == ["/x", "it's", 'say "y"', "/q?a=1&copy=2&b=é", "", "/y/"]
