import hashlib
import random
import re

import pytest

from pulsegrid.llm.pii import Disclosure, personal_data, sanitise

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                  "card": 13 <= len(digits) <= 19 and luhn(digits or "0"), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def check(rows, frame):
    for r in frame.collect():
        found = spans(rows[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (rows[r.doc_id] or "")[:200]
        assert r.spans.startswith(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in found) for kind in PLAIN]


def test_base_spans_equal_plain_search(docs):
    draw = random.Random(4)
    parts = ["a@b.c", "a", "@", ".", "-", "4111111111111111", "5500 0000 0000 0004", "1", "2", " ", "+1 (555) 010-9999", "+", "%",
             "256.1.1.1", "192.168.0.1", "é😀", "_x@d.e", "..", "(", "9" * 30, "+49 30 1234567", "0010.0.0.1"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(15))) for _ in range(600)]
    texts += ["", None, "a" * 20_000, "1 " * 20_000, "a." * 20_000 + "@x", "x@" + "a." * 20_000 + "b", "+1" + "(" * 20_000, "1." * 20_000]
    rows = dict(enumerate(texts))
    check(rows, personal_data(docs(*rows.items())))


def known_twins(docs):
    """A value in five texts, always with the same rare name and once with a common word only."""
    rows = {i: f"the mail of Quillfeather is q.f@example.org and number {chr(97 + i) * 4} the" for i in range(4)}
    rows |= {i: f"the plain text number {chr(97 + i % 26) * (i % 7 + 1)} of the rest" for i in range(10, 200)}
    rows |= {300: "Quillfeather, again: q.f@example.org", 301: None, 302: ""}
    return rows, docs(*rows.items())


def test_terms_that_give_a_value_away_are_found(docs):
    rows, frame = known_twins(docs)
    found = {r.doc_id: r for r in personal_data(frame, Disclosure(generalise=0.6)).collect()}
    check(rows, personal_data(frame))
    for i in (0, 1, 2, 3, 300):
        at = rows[i].index("Quillfeather")
        assert f"term:{at}:{at + len('Quillfeather')}" in found[i].spans.split(",")
    assert all(found[i].spans == "" for i in (*range(10, 200), 301, 302))


def test_copies_of_one_text_disclose_nothing(docs):
    frame = docs(*[(i, "Oddname writes from odd@example.org") for i in range(20)], (99, "nothing here"))
    assert {r.n_term for r in personal_data(frame).collect()} == {0}


def test_sanitised_texts_hold_no_personal_data(docs):
    rows, frame = known_twins(docs)
    out = sanitise(frame)
    assert out.columns == frame.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[300] == ", again: [EMAIL]" and "[EMAIL]" in texts[0] and "Quillfeather" not in texts[0]
    assert texts[301] is None and texts[302] == "" and texts[50] == rows[50]
    mixed = docs((1, "ip 10.0.0.1, no 999.1.1.1; card 4111-1111-1111-1111 and 4111-1111-1111-1112; +1 (555) 010-9999!"))
    assert sanitise(mixed).first().text == "ip [IP], no 999.1.1.1; card [CARD] and 4111-1111-1111-1112; [PHONE]!"


def test_empty_and_repeated_rows(docs):
    assert personal_data(docs((1, "a")).limit(0)).count() == 0
    assert sanitise(docs((1, "a")).limit(0)).count() == 0
    twice = personal_data(docs((1, "a@b.c"), (1, "a@b.c"), (None, "a@b.c"))).collect()
    assert len(twice) == 3 and len({r.spans for r in twice}) == 1


@pytest.mark.parametrize("name", ["personal_data", "sanitise"])
def test_no_python_in_the_plan(docs, name):
    frame = {"personal_data": personal_data, "sanitise": sanitise}[name](docs((1, "a@b.c")))
    assert "Python" not in frame._jdf.queryExecution().toString() and "Arrow" not in frame._jdf.queryExecution().toString()


def test_a_removed_term_does_not_hide_a_phone_and_overlapping_kinds_are_one(docs):
    rows = {i: f"the +4915112345679 Quillfeather 2019 {chr(97 + i) * 4} the" for i in range(4)}
    rows |= {i: f"the plain text number {chr(97 + i % 26) * (i % 7 + 1)} of the rest" for i in range(10, 200)}
    texts = {r.doc_id: r.text for r in sanitise(docs(*rows.items())).collect()}
    assert texts[0] == "the [PHONE]  2019 aaaa the"
    kinds = docs((1, "\u00e9\U0001f600 +4111111111111111, 4111111111111111@x.org and 10.0.0.1@x.org; +49 30 10.20.30.40 end"), (2, "a@b.c"))
    texts = {r.doc_id: r.text for r in sanitise(kinds).collect()}
    assert texts == {1: "\u00e9\U0001f600 +[CARD], [EMAIL] and [EMAIL]; [IP] end", 2: "[EMAIL]"}
