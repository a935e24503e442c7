"""Format-preserving pseudonyms: personal numbers and dates are permuted by a keyed Feistel network within their format.

Recognized, and replaced only where valid: payment card numbers (13 to 19 digits, Luhn), IBANs (mod 97), telephone numbers with
a country code, US social security numbers, IPv4 addresses, dates (ISO, or day and month with dots or slashes) and e-mail
addresses. A value's digits become a number below the size of its format's domain; an eight-round Feistel network over
the next even number of bits, walked until the result is below that size, permutes the domain; check digits are made
anew. Separators, country codes, mail hosts and the order of year, month and day stay, and lengths but for IPv4
addresses. Dates stay in one of six classes (day to 9, to 12 or above; month to 9 or above). Equal values get equal
pseudonyms in every document, however they are separated, and the key's owner can invert them (:meth:`Feistel.back`).

Texts are rewritten inside the tasks that read them; nothing is shuffled or gathered.

Defined results: a null text stays null and an empty one empty, with no findings; null ids stay; repeated rows are
rewritten alike; further columns are ignored; an empty table gives an empty result. Overlapping candidates: the leftmost
wins, then the order above. A card or IBAN candidate may run into digits or capitals after it: its usual length (by country, or by
the card's first digits) is tried first, then all of it, then shorter ends at separators.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
MEMORY = 200_000
KINDS = ("card", "iban", "phone", "ssn", "ip", "date", "email")
#: Fixed patterns of the formats, before validation.
CANDIDATE = re.compile(
    r"(?<![0-9A-Za-z])(?:(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?)(?![0-9A-Za-z])"
    r"|(?P<date>(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}(?P<sep>[./])[0-9]{1,2}(?P=sep)(?:19|20)[0-9]{2})(?![0-9])"
    r"|(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\.?[0-9])"
    r"|(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"
    r"|(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?![0-9]))"
    r"|(?P<phone>(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,5}){1,4})(?![0-9])"
    r"|(?P<email>(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)")
MAY_MATCH = re.compile("[0-9@]")
#: Fixed lengths of country codes: one digit, two digits by zone, three digits; else the digits before a separator, two at most.
COUNTRY_CODE = re.compile(r"(\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})|\+[0-9]{1,2})(.*)", re.S)


#: Signs of an IBAN by country, and the usual digits of a card by its first ones.
IBAN_SIGNS = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FO,GL,NL,SD,FK 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
    "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA "
    "30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for c in cs.split(",")}
CARD_DIGITS = re.compile("(?P<n16>4|5[1-5]|2[2-7]|6)|(?P<n15>3[47])|(?P<n14>3[068])")


def _date_class(day: dt.date) -> tuple[bool, bool, bool]:
    """Dates that are written alike in every order of parts: day above 12, digits of the day, digits of the month."""
    return day.day > 12, day.day > 9, day.month > 9


class Feistel:
    """A keyed permutation of ``range(size)`` for each format name."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, label: bytes, r: int, half: int, bits: int) -> int:
        data = b"%b|%d|%d" % (label, r, half)
        return int.from_bytes(blake2b(data, key=self.key, digest_size=(bits + 7) // 8 + 8).digest(), "big") & ((1 << bits) - 1)

    def _once(self, value: int, bits: int, label: bytes, rounds) -> int:
        left, right = value >> bits, value & ((1 << bits) - 1)
        for r in rounds:
            left, right = right, left ^ self._round(label, r, right, bits)
        return right << bits | left  # halves swapped, so that the reverse order of rounds undoes it

    def _walk(self, value: int, size: int, label: str, rounds) -> int:
        if size <= 1:
            return value
        bits, name = max(1, ((size - 1).bit_length() + 1) // 2), f"{label}|{size}".encode()
        while True:
            value = self._once(value, bits, name, rounds)
            if value < size:
                return value

    def there(self, value: int, size: int, label: str) -> int:
        return self._walk(value, size, label, range(ROUNDS))

    def back(self, value: int, size: int, label: str) -> int:
        return self._walk(value, size, label, range(ROUNDS - 1, -1, -1))


def _luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        x = int(c) * (2 if i % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return str(-total % 10)


def _iban_rest(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _fill(shape: str, signs: str) -> str:
    """``shape`` with its letters and digits replaced, in order, by ``signs``."""
    it = iter(signs)
    return "".join(next(it) if c.isascii() and c.isalnum() else c for c in shape)


def _mixed(text: str, move: Callable[[int, int], int]) -> str:
    """Permutes letters among letters of their case and digits among digits, as one number in mixed base."""
    sets = [("0", 10) if c.isdigit() else ("a", 26) if c.islower() else ("A", 26) for c in text]
    value, size = 0, 1
    for c, (zero, n) in zip(text, sets):
        value, size = value * n + ord(c) - ord(zero), size * n
    value, out = move(value, size), []
    for zero, n in reversed(sets):
        value, x = divmod(value, n)
        out.append(chr(ord(zero) + x))
    return "".join(reversed(out))


class Pseudonyms:
    """Replaces the values of one text; remembers a bounded number of values."""

    def __init__(self, key: bytes, invert: bool = False):
        feistel = Feistel(key)
        self.move = feistel.back if invert else feistel.there
        self.known: dict[tuple[str, str], str | None] = {}

    def value(self, kind: str, found: str) -> str | None:
        """The pseudonym, in the shape of ``found``; None if it is not valid."""
        at = kind, found
        if at not in self.known:
            if len(self.known) >= MEMORY:
                self.known.clear()
            self.known[at] = getattr(self, f"_{kind}")(found)
        return self.known[at]

    def _digits(self, label: str, digits: str) -> str:
        return f"{self.move(int(digits), 10 ** len(digits), label):0{len(digits)}d}"

    def _card(self, found: str) -> str | None:
        digits = re.sub("[^0-9]", "", found)
        if _luhn_digit(digits[:-1]) != digits[-1]:
            return None
        body = self._digits("card", digits[:-1])
        return _fill(found, body + _luhn_digit(body))

    def _iban(self, found: str) -> str | None:
        signs = found.replace(" ", "")
        country, check, body = signs[:2], signs[2:4], signs[4:]
        if not 11 <= len(body) <= 30 or 98 - _iban_rest(country, body) != int(check):
            return None
        body = _mixed(body, lambda v, n: self.move(v, n, "iban" + country))
        return _fill(found, country + f"{98 - _iban_rest(country, body):02d}" + body)

    def _phone(self, found: str) -> str | None:
        code, rest = COUNTRY_CODE.match(found).groups()
        digits = re.sub("[^0-9]", "", rest)
        if not 6 <= len(digits) <= 14:
            return None
        return code + _fill(rest, self._digits("phone" + code, digits))

    def _ssn(self, found: str) -> str | None:
        area, group, serial = map(int, found.split("-"))
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        value = self.move(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
        value, serial = divmod(value, 9999)
        area, group = divmod(value, 99)
        area += 1 + (area >= 665)
        return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"

    def _ip(self, found: str) -> str | None:
        parts = [int(x) for x in found.split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in found.split(".")):
            return None
        value = self.move(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
        return ".".join(map(str, value.to_bytes(4, "big")))

    def _date(self, found: str) -> str | None:
        """A date in its own order of parts, each part as wide as it was. Dates are permuted within their :func:`_date_class`, so that a
        month-first date with slashes, told by a second number above 12, stays one, and a part of one digit stays one; and as the class does not depend on the
        way a date is written, equal dates are linked however they are written."""
        parts = re.split("([-./])", found)
        numbers, sep = [int(x) for x in parts[::2]], parts[1]
        year, month, day = numbers if sep == "-" else reversed(numbers)
        swapped = sep == "/" and month > 12 >= day  # month first
        if swapped:
            month, day = day, month
        try:
            new = old = dt.date(year, month, day)
        except ValueError:
            return None
        while new is old or _date_class(new) != _date_class(old):  # the walk stays on its cycle, which leads back to the given date
            new = dt.date.fromordinal(FIRST_DAY + self.move(new.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))
        made = [new.year, new.month, new.day] if sep == "-" else [new.month, new.day, new.year] if swapped else [new.day, new.month, new.year]
        return sep.join(f"{n:0{len(x)}d}" for n, x in zip(made, parts[::2]))

    def _email(self, found: str) -> str | None:
        local, host = found.split("@")
        signs = "".join(c for c in local if c.isalnum())
        return _fill(local, _mixed(signs, lambda v, n: self.move(v, n, "email"))) + "@" + host

    def _ends(self, kind: str, found: str) -> Iterator[int]:
        """Lengths of ``found`` to try: its usual one if a separator or its end is there, all of it, shorter ones at separators."""
        ends = [len(found), *(m.start() for m in reversed(list(re.finditer("[ -]", found))))]
        signs = {e: sum(c.isalnum() for c in found[:e]) for e in ends}
        if kind == "card":
            usual, least = (int(m.lastgroup[1:]) if (m := CARD_DIGITS.match(found)) else 0), 13
        else:
            usual, least = IBAN_SIGNS.get(found[:2], 0), 15
        yield from sorted((e for e in ends if signs[e] >= least), key=lambda e: (signs[e] != usual, -e))

    def _shortened(self, kind: str, found: str) -> tuple[int, str] | None:
        """Length and pseudonym of the valid value that ``found`` begins with; a usual one that begins later goes before an unusual short one."""
        for end in self._ends(kind, found):
            if (new := self.value(kind, found[:end])) is not None:
                unusual = end < len(found) and kind == "card" and not self._usual(found[:end])
                if unusual and any(self._later(found, m.end()) for m in re.finditer("[ -]", found)):
                    continue
                return end, new
        return None

    def _usual(self, card: str) -> bool:
        m = CARD_DIGITS.match(card)
        return bool(m) and sum(c.isdigit() for c in card) == int(m.lastgroup[1:])

    def _later(self, found: str, start: int) -> bool:
        rest = found[start:]
        return any(self._usual(rest[:e]) and self.value("card", rest[:e]) is not None for e in self._ends("card", rest))

    def text(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The rewritten text and ``(kind, start, length)`` of the replaced values in the given one."""
        out, end, found = [], 0, []
        at = 0
        while m := CANDIDATE.search(text, at):
            kind = m.lastgroup if m.lastgroup != "sep" else "date"
            if kind in ("card", "iban"):  # the pattern may have taken in what follows the value
                length, new = self._shortened(kind, m.group()) or (0, None)
            else:
                length, new = m.end() - m.start(), self.value(kind, m.group())
            if new is None:
                at = m.start() + 1  # an invalid candidate may hide a valid one
                continue
            out += [text[end:m.start()], new]
            found.append((kind, m.start(), length))
            at = end = m.start() + length
        return "".join(out) + text[end:], found


@functools.cache
def _pseudonyms(key: bytes, invert: bool) -> Pseudonyms:
    return Pseudonyms(key, invert)


def pseudonymize(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", invert: bool = False) -> DataFrame:
    """``(id, text, found)``: rewritten texts, and kind, start and length of each replaced value in the original."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    place = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _pseudonyms(key, invert)
        for b in batches:
            texts, found = [], []
            for x in b.column(1):
                text = x.as_py()
                new, places = (text, []) if not text or not MAY_MATCH.search(text) else names.text(text)
                texts.append(new)
                found.append([dict(zip(("kind", "start", "length"), p)) for p in places])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(found, place)], ["id", "text", "found"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string, found array<struct<kind:string,start:int,length:int>>").withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str, key: bytes = b"set the production key here") -> DataFrame:
    """op4: all documents with pseudonyms in place of their personal numbers, dates and addresses."""
    return pseudonymize(spark.read.parquet(f"{sf_dir}/documents.parquet"), key)
