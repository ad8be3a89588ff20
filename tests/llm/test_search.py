"""Exact top k, languages, archives, benchmark passages."""

import gzip
import json
import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from starlens.llm import contamination as c
from starlens.llm import language as la
from starlens.llm import topk
from starlens.llm import warc


def brute_top(vectors, is_query, k, scale=64.0):
    rows = {}
    for i, v in vectors:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            rows.setdefault(i, set()).add(tuple(max(-(1 << 27), min(1 << 27, math.floor(scale * x))) for x in v))
    out = []
    for q in sorted(rows):
        if is_query(q):
            score = {}
            for i, vs in rows.items():
                if i != q:
                    for a in vs:
                        for b in rows[q]:
                            if len(a) == len(b):
                                score[i] = max(score.get(i, -(1 << 70)), sum(x * y for x, y in zip(a, b)))
            out += [(q, n, i, s) for n, (i, s) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k], 1)]
    return out


def test_top_k_against_all_products(spark):
    draw = random.Random(1)
    vectors = [(i, [draw.choice([draw.gauss(0, 0.2), round(draw.gauss(0, 0.2), 1)]) for _ in range(24)]) for i in range(700)]
    vectors += [(i, vectors[3][1]) for i in range(700, 760)] + [vectors[5], vectors[20]]  # ties and repeated rows
    vectors += [(800, None), (801, []), (802, [float("nan")] * 24), (820, [None] + [0.1] * 23), (840, [float("inf")] * 24), (None, [0.1] * 24), (860, [0.5, 0.5]), (880, [0.2, -0.1]), (900, [3e38] * 24), (901, [-3e38] * 24), (20, [0.3] * 24)]
    df = spark.createDataFrame([(i, v, "x", 2) for i, v in vectors], "vec_id long, embedding array<float>, block string, rank int")
    floats = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    want = brute_top(floats, lambda i: i % 20 == 0, 9)
    for blocks in ((16384, 1024), (100, 7)):
        out = topk.exact_top_k(df, F.col("vec_id") % 20 == 0, k=9, candidates=blocks[0], queries=blocks[1])
        assert sorted(tuple(x) for x in out.select("query_id", "rank", "vec_id", "score").collect()) == want
    assert topk.exact_top_k(df.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


EN, DE = "the house and the garden are near the water with another stone bridge ".split(), "das haus und der garten sind nahe am wasser mit einer alten brücke ".split()


def test_language_fusion(spark):
    draw = random.Random(2)
    say = lambda words, n=30: " ".join(draw.choices(words, k=n))
    rows = [(i, say(EN if i % 2 else DE), "en" if i % 2 else "de", "s") for i in range(120)]
    rows += [(200, None, None, None), (201, "", "en", "s"), (202, "12 34 ###", "en", "s"), (203, "qzx" * 200, None, "s"), (204, say(EN), "de", "s"), (205, "###", None, "s"), (206, say(EN), None, None), (206, say(DE), None, None), (None, say(EN), None, None)]
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, lang string, source string, guess int, counts string")
    more = spark.createDataFrame([(i, "en" if i % 2 else "de", "a.example.org" if i % 2 else "b.example.de") for i in range(100)] + [(205, "de", "b.example.de"), (205, "de", "b.example.de"), (None, "x", "y.z")], "doc_id long, declared string, url_host string")
    out = la.identify(docs, more).collect()
    assert len(out) == len(rows)
    by = {}
    for x in out:
        by.setdefault(x["doc_id"], []).append(x)
    assert all(by[i][0]["language"] == ("en" if i % 2 else "de") and by[i][0]["kept"] for i in range(120))
    assert all(by[i][0]["kept"] is False and by[i][0]["language"] is None for i in (200, 201, 202, 203))
    assert by[204][0]["language"] == "en"
    assert by[205][0]["language"] == "de" and by[205][0]["text_language"] is None  # the page alone says so
    assert sorted(x["language"] for x in by[206]) == ["de", "en"]
    assert {x["kept"] for x in la.identify(docs.where("doc_id < 0")).collect()} == set()
    assert {x["language"] for x in la.identify(docs.where("doc_id < 50")).collect()} == {"de", "en"}


def test_page_evidence(spark):
    pages = [(2, "https://b.x.de/de/7?q=1", "<html lang='de'>"), (1, "http://A.x.de/de/7", '<!DOCTYPE html><html class="a" lang="de-AT">'), (3, "nonsense", None), (4, None, "<html lang=fr>"), (5, "http://c.org/en/9.html", "<p>")]
    out = {x["doc_id"]: (x["declared"], x["url_host"]) for x in la.page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert out == {7: ("de-AT", "a.x.de"), 9: (None, "c.org")}


def test_archive_records(spark):
    html = "<html><head><title>A &amp; B\n</title><style>x</style></head><body><!-- no --><h1>One</h1><p>Two <b>bold</b>&nbsp; x</p><script>var t='<p>';</script><a href='/a?x=1&amp;y=2'>link</a><a class=c href=\"b\">é</a></body></html>"
    pages = spark.createDataFrame([(1, "http://x/1", html, "z"), (1, "http://x/1", html, "z"), (2, None, None, "z"), (3, "http://x/3", "", "z"), (4, "http://x/4", "a < b <br> c", "z")], "page_id long, url string, html string, block string")
    out = warc.derivatives(warc.responses(pages)).collect()
    assert len(out) == 10
    ids = {(x["page_id"], x["kind"]): x for x in out}
    text, about = ids[1, "conversion"], json.loads(ids[1, "metadata"]["block"])
    assert text["block"] == "One\nTwo bold x\nlinké" and ids[4, "conversion"]["block"] == "a < b\nc" and ids[2, "conversion"]["block"] == ids[3, "conversion"]["block"] == ""
    assert about["title"] == "A & B" and about["links"] == ["/a?x=1&y=2", "b"] and about["conversion"] == text["record_id"] and about["response"] == text["refers_to"]
    assert about["http_headers"].startswith("HTTP/1.1 200 OK") and about["payload_digest"] == text["payload_digest"]
    for x in out:
        head, body = x["record"].split("\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
        assert head.startswith("WARC/1.1\r\n") and fields["WARC-Type"] == x["kind"] and fields["WARC-Refers-To"] == x["refers_to"] and fields["WARC-Block-Digest"] == x["block_digest"]
        assert body.encode()[: int(fields["Content-Length"])].decode() == x["block"] and body.endswith("\r\n\r\n")
    assert len({x["record_id"] for x in out}) == 8
    listed = warc.write_archives(warc.derivatives(warc.responses(pages))).collect()
    read = "".join(gzip.open(x["file"].removeprefix("file://"), "rt", newline="").read() for x in listed)
    assert sum(x["records"] for x in listed) == 10 and read.count("WARC/1.1\r\n") == 10 and sorted(len(x["record"]) for x in out) == sorted(len("WARC/1.1" + x) for x in read.split("WARC/1.1")[1:])
    assert warc.derivatives(warc.responses(pages.where("page_id > 9"))).count() == 0


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for k, y in enumerate(b, 1):
            row[k] = before[k - 1] + 1 if x == y else max(row[k - 1], before[k])
    return row[-1]


def test_common_subsequence():
    draw = random.Random(3)
    for _ in range(300):
        a, b = ([draw.randrange(5) for _ in range(draw.randint(1, 90))] for _ in range(2))
        masks = {}
        for k, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << k
        assert c.common_subsequence(masks, len(a), b) == lcs(a, b)


def test_contamination(spark, table):
    draw = random.Random(4)
    vocabulary = [f"{draw.choice('bdfgklmn')}{draw.choice('aeiou')}{k}" for k in range(900)]
    say = lambda n: " ".join(draw.choices(vocabulary, k=n))
    items = [(i, say(draw.choice([14, 30, 60, 130])) + ". " + say(4) + ".") for i in range(12)] + [(50, None), (51, ""), (52, "one two"), (None, say(20))]
    docs, want = [], set()
    for i in range(160):
        text = say(draw.choice([5, 80, 300]))
        if i % 8 == 0:
            item, body = items[i // 8 % 12]
            words = body.split()
            if i % 16 == 0:  # a paraphrase: a fifth of the words before the answer is replaced
                for k in draw.sample(range(len(words) - 4), (len(words) - 4) // 5):
                    words[k] = draw.choice(vocabulary)
            text = " ".join([say(draw.choice([0, 40])), *words, say(40)])
            want.add((i, item))
        docs.append((i, text))
    docs += [(300, None), (301, ""), docs[8], (0, "no such passage"), (None, items[1][1])]
    out = c.contaminated(table(docs), spark.createDataFrame(items, "item_id long, text string"))
    rows = out.collect()
    found = [(x["doc_id"], x["item_id"]) for x in rows]
    assert len(found) == len(set(found)) and set(found) == want | {(None, 1)}
    assert all(x["coverage"] >= c.PARAPHRASED for x in rows)
    assert c.contaminated(table([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert c.contaminated(table(docs), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_latent_vectors_keep_passages_apart(spark, table):
    draw = random.Random(5)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = [" ".join(draw.choices(vocabulary, k=c.PASSAGE)) for _ in range(300)]
    staged = c.words_staged(table(list(enumerate(texts))), "doc_id", "text")
    weights = c.term_weights(staged)
    rows = c.hashed(pa.array(texts))
    frequency = np.bincount(np.concatenate([np.unique(c.Rows(rows.words[a:b], rows.first).terms) for a, b in zip(rows.first, rows.first[1:])]), minlength=c.TERMS)
    assert np.allclose(weights, np.log(301 / (frequency + 0.5)).clip(0))
    latent = c.latent_terms(staged, weights)

    def side(words):
        v = latent[c.hashed(pa.array([" ".join(words)])).terms].sum(axis=0)
        return v / np.linalg.norm(v)

    a, b = texts[0].split(), texts[1].split()
    assert side(a) @ side(a[:38] + b[:10]) > 0.6 > side(a) @ side(b) + 0.2
    assert not latent[-1].any()


def test_randomised_decomposition_finds_the_leading_directions(table):
    draw = random.Random(6)
    topics = [[f"t{k}w{i}" for i in range(40)] for k in range(60)]
    texts = [" ".join(draw.choices(topics[i % 60], k=c.PASSAGE)) for i in range(900)]
    staged = c.words_staged(table(list(enumerate(texts))), "doc_id", "text")
    weights = c.term_weights(staged)
    latent = c.latent_terms(staged, weights)
    passage, term, count, n = c.passages(c.hashed(pa.array(texts)))
    a = np.zeros((n, c.TERMS))
    a[passage, term] = count * weights[term]
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    _, s, v = np.linalg.svd(a[:, a.any(axis=0)], full_matrices=False)
    basis, _ = np.linalg.qr((latent[:-1] / np.maximum(weights, 1e-9)[:, None])[a.any(axis=0)])
    caught = np.linalg.norm(v[:60] @ basis) ** 2  # the 60 topics are the leading directions; the basis has at most 48 of them
    assert caught > 0.8 * basis.shape[1]
