"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Each value found is validated, read as a whole number below the number of valid
values of its kind, permuted by a keyed Feistel network over exactly that range
(cycle walking), and written back in the same format. The permutation depends on
the key and the kind only: equal values get equal pseudonyms in all documents,
different ones different pseudonyms, and the key's holder can reverse them. Where
a format has several readings (day or month first, ten-digit plan or not), the
walk goes on until the pseudonym has the reading of its value.

| kind | valid | permuted |
|-|-|-|
| card | 13-19 digits, Luhn sum | all digits but the first and the check digit, which is made anew |
| ssn | area not 000, 666, 9xx; group, serial not 0 | the number among valid ones |
| iban | mod 97 = 1 | digits and letters after the check digits, which are made anew |
| phone | ten-digit plan, area and exchange 2-9 (others: +cc and 7-14 digits) | the number after the country code |
| ip | four numbers to 255 | the 32 bits |
| date | a day of the calendar, years 1900-2099 | the day |
| email | local part and domain | letters and digits of the local part, each in its class |
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from handover.llm.batches import chunks

ROUNDS = 10
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_FIRST_DAY, _DAYS = dt.date(1900, 1, 1).toordinal(), (dt.date(2100, 1, 1) - dt.date(1900, 1, 1)).days


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size): an alternating Feistel network over a x b >= size, walked until inside."""
    if size <= 1:
        return value
    a = 1
    while a * a < size:
        a <<= 1
    b = -(-size // a)
    label = f"{tweak}/{size}/".encode()

    def mask(i: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(label + b"%d/%d" % (i, half), key=key, digest_size=32).digest(), "big")

    while True:
        left, right = divmod(value, b)  # left below a, right below b
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                left = (left + sign * mask(i, right)) % a
            else:
                right = (right + sign * mask(i, left)) % b
        value = left * b + right
        if value < size:
            return value


def _walk(value: int, size: int, turn: Callable, fits: Callable[[int], bool]) -> int:
    """The permutation of the values that fit: a value that fits is turned until it fits again."""
    while True:
        value = turn(value, size)
        if fits(value):
            return value


def _refill(text: str, fresh: str) -> str:
    """``text`` with its letters and digits replaced in order."""
    it = iter(fresh)
    return "".join(next(it) if c.isalnum() else c for c in text)


def luhn_digit(body: str) -> str:
    """The check digit that follows ``body``."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _card(text: str, turn: Callable) -> str | None:
    d = re.sub(r"\D", "", text)
    if len(set(re.sub(r"\d", "", text))) > 1 or luhn_digit(d[:-1]) != d[-1]:
        return None
    body = d[0] + str(turn(int(d[1:-1]), 10 ** (len(d) - 2))).zfill(len(d) - 2)
    return _refill(text, body + luhn_digit(body))


def _ssn(text: str, turn: Callable) -> str | None:
    area, group, serial = (int(x) for x in re.split(r"\D", text))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    index = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    index, serial = divmod(turn(index, 898 * 99 * 9999), 9999)
    area, group = divmod(index, 99)
    return _refill(text, f"{area + 1 + (area >= 665):03d}{group + 1:02d}{serial + 1:04d}")


def _iban(text: str, turn: Callable) -> str | None:
    raw = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(raw) <= 34 or number(raw[4:] + raw[:4]) % 97 != 1:
        return None
    check = lambda body: 98 - number(body + raw[:2] + "00") % 97
    other = int(raw[2:4]) - check(raw[4:])  # 00, 01 and 99 have the remainders of 97, 98 and 02
    body = raw[4:]
    while True:
        body = _by_class(body, turn)
        if not other or (check(body) < 3) == (other > 0) and not 2 < check(body) < 97:
            break
    return _refill(text, raw[:2] + f"{check(body) + other:02d}" + body)


def _by_class(text: str, turn: Callable) -> str:
    """Permutes the letters and digits, each within its class."""
    classes = [next((k for k in (_DIGIT, _LOWER, _UPPER) if c in k), c) for c in text]
    value = 0
    size = 1
    for c, k in zip(text, classes):
        value, size = value * len(k) + k.index(c), size * len(k)
    value = turn(value, size)
    out = []
    for k in reversed(classes):
        value, i = divmod(value, len(k))
        out.append(k[i])
    return "".join(reversed(out))


def _phone(text: str, turn: Callable) -> str | None:
    country = re.match(r"\+\d{1,3}(?=[ .(-])|", text).group()
    d = re.sub(r"\D", "", text[len(country) :])
    plan = lambda d: len(d) == 10 and country in ("", "+1") and d[0] > "1" and d[3] > "1"
    if plan(d):
        index = (int(d[:3]) - 200) * 800 * 10**4 + (int(d[3:6]) - 200) * 10**4 + int(d[6:])
        rest, line = divmod(turn(index, 800 * 800 * 10**4), 10**4)
        area, exchange = divmod(rest, 800)
        return country + _refill(text[len(country) :], f"{area + 200}{exchange + 200}{line:04d}")
    if country and 7 <= len(d) <= 14:
        digits = lambda v: str(v).zfill(len(d))
        return country + _refill(text[len(country) :], digits(_walk(int(d), 10 ** len(d), turn, lambda v: not plan(digits(v)))))
    return None


def _ip(text: str, turn: Callable) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    return ".".join(str(x) for x in turn(int.from_bytes(bytes(parts), "big"), 2**32).to_bytes(4, "big"))


def _date(text: str, turn: Callable) -> str | None:
    first, mark, second, _, third = re.fullmatch(r"(\d+)(\D)(\d+)(\D)(\d+)", text).groups()
    orders = ("ymd",) if len(first) == 4 else ("mdy", "dmy") if mark == "/" else ("dmy", "mdy")
    for order in orders:
        at = dict(zip(order, (first, second, third)))
        try:
            day = dt.date(int(at["y"]), int(at["m"]), int(at["d"])).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            continue
        # the second order is read only if the first has no such month: so must its pseudonym
        new = dt.date.fromordinal(_FIRST_DAY + _walk(day, _DAYS, turn, lambda v: order == orders[0] or dt.date.fromordinal(_FIRST_DAY + v).day > 12))  # noqa: B023
        # two digits always: which field is the month shows in the value only if it is over 12
        return mark.join(f"{getattr(new, {'y': 'year', 'm': 'month', 'd': 'day'}[c]):0{4 if c == 'y' else 2}d}" for c in order)
    return None


def _email(text: str, turn: Callable) -> str | None:
    local, domain = text.rsplit("@", 1)
    return _by_class(local, turn) + "@" + domain


_KINDS = {"card": _card, "ssn": _ssn, "iban": _iban, "phone": _phone, "ip": _ip, "date": _date, "email": _email}
_NUMBERS = re.compile(
    r"(?<![\w.])(?:"
    r"(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<date>\d{4}([-/.])\d{1,2}\3\d{1,2}|\d{1,2}([-/.])\d{1,2}\4\d{4})"
    r"|(?P<ip>\d{1,3}(?:\.\d{1,3}){3})"
    r"|(?P<card>\d{13,19}|\d{4}([ -])\d{4}\7\d{4}\7\d{1,7}|\d{4}([ -])\d{6}\8\d{5})"
    r"|(?P<phone>(?:\+\d{1,3}[ .-]?)?\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]\d{2,5}){2,5})"
    r"|(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)"
    r")(?!\w|\.\d|-\d)"
)
_MAILS = re.compile(r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})")


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the candidates, none overlapping, in order; validity isn't checked."""
    found = [(m.lastgroup, *m.span(m.lastgroup)) for m in _NUMBERS.finditer(text) if m.lastgroup] if any(c.isdigit() for c in text) else []
    if "@" in text:
        mails = [("email", *m.span("email")) for m in _MAILS.finditer(text)]
        ends = [b for _, _, b in mails]
        after = [bisect_right(ends, f[1]) for f in found]  # the first mail that ends behind the number's start
        found = [f for f, i in zip(found, after) if i == len(mails) or mails[i][1] >= f[2]] + mails
    return sorted(found, key=lambda f: f[1])


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int, str]]]:
    """The text with valid values replaced (or restored, with ``back``), and (kind, start, length, pseudonym) in the old text."""
    out, spans, at = [], [], 0
    for kind, a, b in find(text):
        new = _KINDS[kind](text[a:b], lambda v, n, kind=kind: permute(v, n, key, kind, back))
        if new is not None:
            out += [text[at:a], new]
            spans.append((kind, a, b - a, new))
            at = b
    return "".join([*out, text[at:]]), spans


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType()), T.StructField("pseudonym", T.StringType())])


def pseudonymise_documents(docs: DataFrame, key: bytes, text: str = "text", restore: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``pii``: array of (kind, start, length, pseudonym), places in the old text.

    Rows, repeated ones too, and other columns stay; a column named ``pii`` is
    replaced. A null text stays null with an empty list. With ``restore`` the
    pseudonyms made with the same key are turned back (dates come back with
    two-digit days and months). Narrow: no shuffle.
    """
    keep = [c for c in docs.columns if c != "pii"]
    src = docs.select(*(F.col(f"`{c}`") for c in keep))
    schema = T.StructType([*(T.StructField(f.name, T.StringType()) if f.name == text else f for f in src.schema.fields), T.StructField("pii", T.ArrayType(SPAN, False), False)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32()), ("pseudonym", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, text):
            done = [pseudonymise(t, key, restore) if t is not None else (None, []) for t in part.column(text).to_pylist()]
            new = pa.array([d[0] for d in done], pa.string())
            spans = pa.array([[dict(zip(SPAN.names, s)) for s in d[1]] for d in done], kind)
            yield pa.RecordBatch.from_arrays([*(new if n == text else c for n, c in zip(part.schema.names, part.columns)), spans], names=[*part.schema.names, "pii"])

    return src.mapInArrow(run, schema)
