"""Identifiers that only later rounds, many contexts or spaces between digits make visible."""

from starlens.llm import pii


def spans(table, rows):
    return {x["doc_id"]: x["s"] for x in pii.personal_data(table(rows)).select("doc_id", pii.written("pii_spans").alias("s")).collect()}


def test_identifiers_of_score_one_are_kept(table):
    rows = [(1000 * c + i, f"say{c} name{c} user{c}x{i}@mail.example.com end{c} of{c}") for c in range(20) for i in range(30)]
    rows += [(90_000 + c, f"say{c} name{c} KX99-7788 end{c} of{c}") for c in range(20)]
    out = spans(table, rows)
    assert all(out[90_000 + c].startswith("email:") for c in range(20))


def test_accepted_identifiers_induce_patterns(table):
    rows = [(i, f"account holder id user{i}@mail.example.com is listed") for i in range(30)]
    rows += [(100 + i, f"account holder id KX99-77{i:02d} is listed") for i in range(9)]
    rows += [(200 + i, f"the secret badge KX99-77{i:02d} was shown") for i in range(9)] + [(300, "the secret badge ZZ11-2233 was shown")]
    assert spans(table, rows)[300].startswith("email:")


def test_digit_groups_are_slots(table):
    assert pii.other_slots("call (030) x 030 1234 5678, or", []) == [(13, 26)]
    assert pii.other_slots("v1.2 345 678x", []) == []
    assert pii.other_slots("id 12345-678 90 12x", []) == [(3, 12), (3, 15)]
    rows = [(i, f"please call number +49 30 1234{i:04d} for help") for i in range(30)] + [(99, "please call number 030 1234 5678 for help")]
    assert spans(table, rows)[99] == "phone:19:32"
