"""Personal data: the linear searches against the plain patterns of the contract."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import AWKWARD
from tidewater.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        if 14 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab@.%+-0123459 ()é", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert [s[:3] for s in pii.spans(text) if s[0] in pii.BASE] == brute(text)


def test_long_runs_stay_linear():
    text = "a" * 200_000 + " " + "1." * 100_000 + " " + "9" * 200_000 + "x@"
    want = [("ip", 200_001 + 8 * i, 200_008 + 8 * i) for i in range(25_000)]
    assert [s[:3] for s in pii.spans(text) if s[0] in pii.BASE] == want


def test_address_parts_of_any_length():
    for zeros in (5_000, 200_000):
        text = "0" * zeros + ".1.2.3 " + "1.2.3." + "0" * zeros + "255 1.2.3." + "0" * zeros + "256 1.2.3." + "9" * zeros
        want = [("ip", 0, zeros + 6), ("ip", zeros + 7, 2 * zeros + 16)]
        assert [s[:3] for s in pii.spans(text) if s[0] == "ip"] == want


def test_checksums_and_context_decide_added_spans():
    assert pii.luhn("4041894974608795") and not pii.luhn("4041894974608796")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765433")
    assert [s[0] for s in pii.spans("iban GB82 WEST 1234 5698 7654 32")] == ["iban"]
    assert [s[0] for s in pii.spans("call 415-555-1234")] == ["tel"] and pii.spans("part 415-555-1234") == []
    assert [s[0] for s in pii.spans("ssn 123-45-6789")] == ["id"] and pii.spans("row 123-45-6789") == []
    assert pii.masked("mail a.b@c.de now") == "mail [email] now"


def test_query(spark, docs_of, tables):
    rows = [*AWKWARD, (20, "é a@b.co, 10.0.0.1; 4041894974608795 +1 (988) 555-2485")]
    got = pii.op4_pii(spark, tables(documents=docs_of(rows))).collect()
    assert len(got) == len(rows)
    r = next(r for r in got if r.doc_id == 20)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.spans == "email:2:8,ip:10:18,card:20:36,phone:37:54"
    blank = next(r for r in got if r.doc_id == 1)
    assert blank.spans == "" and blank.base_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_many_spans_take_linear_time():
    import time

    text = "call 555 123 4567 or mail a@b.org, tel. (030) 123456 phone 555-987-6543 " * 4000
    began = time.process_time()
    found = pii.spans(text)
    assert len(found) > 8000 and time.process_time() - began < 20
    own = [(a, b) for _, a, b, _ in found]
    added = [s for s in found if s[0] not in pii.BASE]
    for kind, a, b, _ in added[::97]:
        assert sum(x < b and a < y for x, y in own) == 1        # an added span meets no other


def test_scores_are_a_column(docs_of, tables, spark):
    rows = pii.op4_pii(spark, tables(documents=docs_of([(1, "mail a@b.org now"), (2, None)]))).collect()
    assert {r.doc_id: len(r.span_scores) for r in rows} == {1: 1, 2: 0}
