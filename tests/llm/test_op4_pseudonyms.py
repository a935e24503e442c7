import datetime as dt
import re

import pytest

from tallyloom.llm import op4_pseudonyms as op
from tests.llm.tables import awkward_documents, empty_documents, write

KEY = b"test key"
VALUES = {"card": ["4539 1488 0343 6467", "4539148803436467", "378282246310005"], "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
          "phone": ["+1 (017) 555-7713", "+49 30 1234567", "+4930123456"], "ssn": ["078-05-1120", "665-01-0001", "667-01-0001"],
          "ip": ["192.168.0.1", "8.8.8.8"], "date": ["1999-12-31", "29.02.2000", "12/31/2020", "31/12/2020", "1/2/2020", "3/25/1999"], "email": ["Jo.Doe-27+x@mail6.example.com"]}
INVALID = ["4539148803436468", "GB83 WEST 1234 5698 7654 32", "666-05-1120", "000-05-1120", "1.2.3.256", "01.02.3.4", "1999-02-29", "30.02.2000",
           "12345678901234567890123", "555-7713", "4.0", "x@y"]


@pytest.mark.parametrize("kind", op.KINDS)
def test_format_is_kept_and_inverted(kind):
    there, back = op.Pseudonyms(KEY), op.Pseudonyms(KEY, invert=True)
    for value in VALUES[kind]:
        text = f"Before {value}, after."
        new, found = there.text(text)
        assert found == [(kind, 7, len(value))], value
        assert new != text and (len(new) == len(text) or kind == "ip")
        assert op.Pseudonyms(KEY).text(new)[1][0][0] == kind  # still valid
        assert back.text(new)[0] == text
        shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]+", "9", s)))
        assert kind in ("email", "iban") or shape(new) == shape(text)


WRITTEN = ("{d.year}-{d.month:02d}-{d.day:02d}", "{d.day:02d}.{d.month:02d}.{d.year}", "{d.day}.{d.month}.{d.year}", "{d.day:02d}/{d.month:02d}/{d.year}",
           "{d.day}/{d.month}/{d.year}", "{d.month:02d}/{d.day:02d}/{d.year}", "{d.month}/{d.day}/{d.year}")


def test_dates_are_permuted_in_every_format_and_linked():
    """All days of ten years, however they are written: the pseudonym inverts, keeps its length, and stands for the same date in all of them."""
    there, back = op.Pseudonyms(KEY), op.Pseudonyms(KEY, invert=True)
    images = set()
    for n in range(dt.date(2015, 1, 1).toordinal(), dt.date(2025, 1, 1).toordinal()):
        d = dt.date.fromordinal(n)
        seen = set()
        for form in WRITTEN[:5] + (WRITTEN[5:] if d.day > 12 else ()):
            value = form.format(d=d)
            new = there.value("date", value)
            assert len(new) == len(value) and back.value("date", new) == value
            year, month, day = (int(x) for x in (new.split("-") if "-" in new else reversed(re.split("[./]", new))))
            seen.add((year, day, month) if form in WRITTEN[5:] else (year, month, day))
        assert len(seen) == 1
        images |= seen
    assert len(images) == dt.date(2025, 1, 1).toordinal() - dt.date(2015, 1, 1).toordinal()


FORMS = {  # one plain pattern and one plain test a format, apart from the module's own
    "iban": (r"\b[A-Z]{2}\d\d(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?\b", lambda x: _mod97(x.replace(" ", "")) == 1),
    "email": (r"\b[\w.%+-]+@[\w-]+(?:\.[\w-]+)+", lambda x: True),
    "card": (r"(?<![\w+-])\d(?:[ -]?\d){12,18}(?!\w)", lambda x: _luhn(re.sub(r"\D", "", x))),
    "ssn": (r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", lambda x: x[:3] not in ("000", "666") and x < "900" and "-00-" not in x and not x.endswith("0000")),
    "phone": (r"\+\d{1,3} \(\d{3}\) \d{3}-\d{4}", lambda x: True),
}


def _mod97(x):
    return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97


def _luhn(x):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(x))) % 10 == 0


def test_documents_against_plain_patterns(spark):
    """Every value that a plain pattern finds in the documents is replaced, by a valid one of its form; equal ones alike, others apart; the key inverts all."""
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op.query(spark, sf).collect()
    links, n = {}, 0
    for r in rows:
        old, at, end, parts = docs[r.doc_id], 0, 0, []
        for f in r.found:
            parts.append(old[end:f.start])
            end = f.start + f.length
        for kind, (pattern, valid) in FORMS.items():
            for m in re.finditer(pattern, old or ""):
                if valid(m.group()):
                    inside = [f for f in r.found if f.start < m.end() and m.start() < f.start + f.length]
                    assert inside, (kind, m.group())
        rest = r.text or ""
        for f, gap in zip(r.found, parts):  # what lies between the values is unchanged
            assert rest[at:at + len(gap)] == gap
            at += len(gap)
            value = old[f.start:f.start + f.length]
            new = op.Pseudonyms(b"set the production key here").value(f.kind, value)
            assert rest[at:at + len(new)] == new and (f.kind not in FORMS or FORMS[f.kind][1](new))
            at += len(new)
            signs = re.sub(r"[\s().-]", "", value) if f.kind in ("card", "iban", "phone") else value
            made = re.sub(r"[\s().-]", "", new) if f.kind in ("card", "iban", "phone") else new
            assert links.setdefault((f.kind, signs), made) == made
            n += 1
        assert rest[at:] == (old or "")[end:]
    assert n > 20 and len({(k, v) for (k, _), v in links.items()}) == len(links)
    made = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id bigint, text string")
    back = op.pseudonymize(made, b"set the production key here", invert=True).collect()
    assert {r.doc_id: r.text for r in back} == docs


def test_invalid_values_stay():
    text = " | ".join(INVALID)
    assert op.Pseudonyms(KEY).text(text) == (text, [])


def test_equal_values_stay_linked_and_others_apart():
    p = op.Pseudonyms(KEY)
    a, b = p.value("card", "4539 1488 0343 6467"), p.value("card", "4539148803436467")
    assert a.replace(" ", "") == b != op.Pseudonyms(b"other").value("card", "4539148803436467")


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation(size):
    f = op.Feistel(KEY)
    image = [f.there(i, size, "x") for i in range(size)]
    assert sorted(image) == list(range(size)) and [f.back(i, size, "x") for i in image] == list(range(size))


def test_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    n = 0
    for r in op.query(spark, sf_dir).collect():
        old = docs[r.doc_id]
        values = [old[f.start:f.start + f.length] for f in r.found]
        assert (r.text == old) == (not values)
        n += len(values)
        if not values:
            assert not re.search(r"[\w.]+@\w+\.example\.com|\+1 \(\d{3}\) \d{3}-\d{4}", old)
    assert n > 0


def test_awkward_and_empty(spark, tmp_path):
    docs = awkward_documents(spark)
    got = op.query(spark, write(docs, tmp_path)).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(str((r.doc_id, r.text)) for r in docs.collect())
    assert all(r.found == [] for r in got)
    assert op.pseudonymize(empty_documents(spark), KEY).count() == 0


def test_a_telephone_number_is_linked_however_it_is_separated():
    names = op.Pseudonyms(b"k" * 16)
    for forms in (("+1 212-555-0147", "+12125550147", "+1 (212) 555.0147"), ("+358 40 1234567", "+358401234567"), ("+49 30 1234567", "+49301234567")):
        assert len({"".join(c for c in names.text(x)[0] if c.isdigit()) for x in forms}) == 1
        assert all(names.text(x)[0] != x and len(names.text(x)[1]) == 1 for x in forms)


CARD, IBAN = "4111 1111 1111 1111", "BE68 5390 0754 7034"


@pytest.mark.parametrize("value,after", [(CARD, " 12/27"), (CARD, " 123"), (CARD, " 12"), (CARD, "-99"), ("3782 822463 10005", " 1234"), (IBAN, " EUR 100"), (IBAN, " EUROPE"),
                                         (IBAN, " 2027"), (IBAN, " BIC GEBABEBB"), ("DE89 3704 0044 0532 0130 00", " EUR 5"), ("GB82 WEST 1234 5698 7654 32", " AB")])
def test_values_before_digits_and_capitals(value, after):
    names = op.Pseudonyms(KEY)
    new, found = names.text(f"pay {value}{after}")
    assert [(s, n) for _, s, n in found] == [(4, len(value))]
    assert new == f"pay {names.text(value)[0]}{after}" and op.Pseudonyms(KEY, invert=True).text(new)[0] == f"pay {value}{after}"
    assert all(names.text(f"{x} {CARD} 12/27")[1][-1][1:] == (len(x) + 1, len(CARD)) for x in ("12", "1234", "no 7"))
