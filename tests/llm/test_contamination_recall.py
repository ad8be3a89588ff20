"""Paraphrases near the least coverage, insertions and short items are found wherever they stand."""

import random

from starlens.llm import contamination as c


def test_paraphrases_and_insertions_are_found(spark, table):
    draw = random.Random(8)
    vocabulary = [f"{draw.choice('bdfgklmn')}{draw.choice('aeiou')}{k}" for k in range(900)]
    say = lambda n: draw.choices(vocabulary, k=n)
    items = [(i, say(5 + i % 56)) for i in range(160)]
    docs = [(1000 + i, " ".join(say(200))) for i in range(100)]
    kinds = {}
    for i, words in items:
        kind = i % 3
        if kind == 0:  # 62 to 70 % of the words are kept, in their places
            body, n = list(words), len(words)
            for k in draw.sample(range(n - 1), int(n * draw.uniform(0.3, 0.38))):
                body[k] = draw.choice(vocabulary)
        elif kind == 1:
            body = [x for w in words for x in (w, draw.choice(vocabulary))]
        else:
            body = words
        kinds[i] = kind
        docs.append((i, " ".join(say(draw.randint(20, 60)) + body + say(40))))
    items_df = spark.createDataFrame([(i, " ".join(w), w[-1]) for i, w in items], "item_id long, text string, answer string")
    rows = c.contaminated(table(docs), items_df, answer="answer").collect()
    found = {x["doc_id"] for x in rows if x["doc_id"] == x["item_id"]}
    share = [sum(i in found for i in kinds if kinds[i] == k) / sum(v == k for v in kinds.values()) for k in range(3)]
    assert share[0] >= 0.95 and share[1] >= 0.95 and share[2] == 1.0, share
