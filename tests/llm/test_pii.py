import random
import re

from ledgerlake.llm import pii
from ledgerlake.llm.queries import REGISTRY
from tests.llm import awkward

STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": kind == "ip" and all(int(p) <= 255 for p in value.split(".")),
        "card": 13 <= len(digits) <= 19 and luhn(digits),
        "phone": 9 <= len(digits) <= 15,
    }[kind]


def wanted(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in STATED.items()
        for m in (re.finditer(pattern, text) if text and (kind != "email" or "@" in text) else ())
        if valid(kind, m[0])
    ]


def hostile():
    rng = random.Random(8)
    rows = list(awkward.TEXTS)
    parts = ["a@b.c", "%x@d.e-f.g", "a@b", "@", "..", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "0001.2.3.255", "4111 1111 1111 1111", "4111-1111", "+1 (555) 123-4567", "+", "+1", "12", "3782 822463 10005", "é", " ", "-", ".", "999999999999.1.1.1", "+44 20 7946 0958"]
    for i in range(300):
        rows.append((100 + i, "".join(rng.choice(parts) for _ in range(rng.randrange(1, 9)))))
    for i in range(300):
        rows.append((500 + i, "".join(rng.choice("0123456789 -.+@a_%()") for _ in range(rng.randrange(60)))))
    rows.append((900, " ".join(["4111111111111111 a@b.co"] * 3000)))
    rows.append((901, "1 " * 50_000))
    rows.append((902, "1" * 100_000 + " " + "a." * 2_000 + "@"))
    return rows


def test_base_spans(spark):
    rows = hostile()
    found = pii.personal_data(awkward.documents(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE] for r in found if r.doc_id is not None}
    for doc_id, text in rows:
        if doc_id is not None:
            assert by_id[doc_id] == wanted(text), (doc_id, (text or "")[:80])


ADDED = [
    ("my IBAN GB82 WEST 1234 5698 7654 32 ok", [("iban", 8, 35)]),
    ("IBAN DE89370400440532013000", [("iban", 5, 27)]),
    ("IBAN GB82 WEST 1234 5698 7654 33", []),
    ("social security: 123-45-6789", [("national_id", 17, 28)]),
    ("part 123-45-6789", []),
    ("ssn 666-45-6789", []),
]


def test_added(spark):
    rows = pii.personal_data(spark.createDataFrame(list(enumerate(t for t, _ in ADDED)), "doc_id bigint, text string")).collect()
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.ADDED] for r in rows}
    assert [found[i] for i in range(len(ADDED))] == [spans for _, spans in ADDED]


def test_context_moves_the_score(spark):
    rows = [(1, "call +1 555 123 4567"), (2, "number +1 555 123 4567"), (3, "sample +1 555 123 4567")]
    scored = {r.doc_id: r.spans[0].score for r in pii.personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert scored[1] > scored[2] > scored[3]


def test_query_has_no_python(spark):
    plan = REGISTRY["op9_personal_data"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_no_rows(spark):
    assert pii.personal_data(awkward.nothing(spark)).count() == 0
