import random
import re
import time

from starlens.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(digits):
    total = 0
    for k, x in enumerate(reversed(digits)):
        n = int(x) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def reference(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and checksum(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(1)
    bits = ["4111 1111-1111 1111", "+1 (988) 555-2485", "a.b@c-d.ef", "10.0.255.1", "1.2.3.4.5.6.7.8", "999.1.1.1", "é", "٣", "a@b.c@d.e", "@", "..", "000255.1.1.1", "4111111111111111", "2485"]
    for _ in range(6000):
        text = "".join(draw.choice([draw.choice(bits), draw.choice("a1@.-+ ()23%_x9é")]) for _ in range(draw.randint(0, 25)))
        assert pii.base_spans(text) == reference(text), text


def test_long_runs_take_linear_time():
    start = time.perf_counter()
    for text in ("a" * 400_000, "1" * 400_000, "@" * 400_000, "a@" * 200_000, "1." * 200_000, "+1" * 200_000, "1 " * 200_000):
        pii.other_slots(text, pii.base_spans(text))
    assert time.perf_counter() - start < 20


def test_contexts_give_away_unseen_identifiers(table):
    rows = [(i, f"word{i} account holder id user{i}@mail{i}.example.com is listed with tail{i}") for i in range(30)]
    rows += [(100 + i, f"more é account holder id X{i}99-{i}77-ZZ is listed here") for i in range(5)]
    rows += [(200, None), (201, ""), (202, "the version 12345.6 of it"), (3, rows[3][1]), (None, rows[4][1])]
    rows += [(300 + i, f"plain holder id thing is listed number{i}") for i in range(4)]
    docs = table(rows)
    out = pii.personal_data(docs).withColumns({"base": pii.written("pii_base"), "all": pii.written("pii_spans")}).collect()
    assert len(out) == len(rows) and all(x["t"] == "y" for x in out)
    for x in out:
        text = x["text"] or ""
        assert x["base"] == ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in reference(text))
        if x["doc_id"] and 100 <= x["doc_id"] < 105:
            at = text.index("X")
            assert x["all"] == f"email:{at}:{text.index(' is')}"
        else:
            assert x["all"] == x["base"]
    clean = {x["doc_id"]: x["text"] for x in pii.redacted(pii.personal_data(docs)).collect()}
    assert clean[3] == "word3 account holder id [EMAIL] is listed with tail3" and clean[101] == "more é account holder id [EMAIL] is listed here" and clean[200] == clean[201] == ""
    assert pii.personal_data(table([])).count() == 0


def test_common_places_are_no_patterns(table):
    rows = [(i, f"x the user{i}@mail.example.com of y") for i in range(10)] + [(50, "x the K99999 of y")] + [(100 + i, "x the thing of y " * 5) for i in range(20)]
    out = pii.personal_data(table(rows)).where("doc_id = 50").select(pii.written("pii_spans").alias("s")).collect()
    assert out[0]["s"] == ""


def test_overlapping_spans_are_redacted_once(spark):
    rows = spark.createDataFrame([(1, "ab cd ef", [(0, 0, 2), (1, 1, 4), (3, 6, 8)], [(0, 0, 2)])], "doc_id long, text string, pii_spans array<struct<kind:int,start:long,stop:long>>, pii_base array<struct<kind:int,start:long,stop:long>>")
    assert pii.redacted(rows).collect()[0]["text"] == "[EMAIL]d [PHONE]"
