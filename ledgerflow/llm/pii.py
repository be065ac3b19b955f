"""Operator 3: format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Candidates are found by shape and *validated* (Luhn sum, IBAN check digits, octet ranges, calendar
dates, numbering-plan rules); only valid ones change. A value is read as a number below the size of its
format's domain, permuted by a keyed Feistel network and, where the domain has invalid members, walked
along the permutation until the result is valid again (cycle walking), so the map is a permutation of
the valid values: equal values get equal pseudonyms in every document and different ones stay
different. Separators, letter case and check digits keep their form; check digits are recomputed.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerflow.llm.common import fresh, lean, ship, text_column

ROUNDS = 8
#: the days a date may become, both ends included
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)


class Feistel:
    """Keyed permutation of ``range(size)`` per (kind, size): an unbalanced network over two factors."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, kind: str, size: int, i: int, x: int, modulus: int) -> int:
        data = f"{kind}|{size}|{i}|{x}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16).digest(), "big") % modulus

    def _step(self, kind: str, x: int, size: int, back: bool) -> int:
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        left, right = divmod(x, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * self._f(kind, size, i, right, a)) % a
            else:
                right = (right + sign * self._f(kind, size, i, left, b)) % b
        return left * b + right

    def permute(self, kind: str, x: int, size: int, valid: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """Image of ``x`` under the permutation of the valid members of ``range(size)`` (or its inverse)."""
        if size < 2:
            return x
        while True:
            x = self._step(kind, x, size, back)
            if x < size and (valid is None or valid(x)):
                return x


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _mixed(f: Feistel, kind: str, text: str, back: bool) -> str:
    """Letters to letters of the same case, digits to digits, the rest as it is."""
    x, size = 0, 1
    for c in text:
        if c.isdigit():
            x, size = x * 10 + int(c), size * 10
        elif "a" <= c.lower() <= "z":
            x, size = x * 26 + ord(c.lower()) - 97, size * 26
    x = f.permute(kind + re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text))), x, size, back=back)
    out = []
    for c in reversed(text):
        if c.isdigit():
            x, d = divmod(x, 10)
            out.append(str(d))
        elif "a" <= c.lower() <= "z":
            x, d = divmod(x, 26)
            out.append(chr(d + (65 if c.isupper() else 97)))
        else:
            out.append(c)
    return "".join(reversed(out))


def _card(f, m, back):
    digits = re.sub("[ -]", "", m)
    if len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    low = 10 ** (len(digits) - 2)  # the first digit stays a possible one (1 to 9)
    body = f.permute(f"card{len(digits)}", int(digits[:-1]), 10 * low, lambda x: x >= low, back) if digits[0] != "0" else None
    return None if body is None else _refill(m, f"{body}{luhn_digit(str(body))}")


def _phone(f, m, back):
    digits = re.sub(r"\D", "", m)
    if len(digits) == 10:
        head, own = "", digits
    elif len(digits) == 11 and digits[0] == "1":
        head, own = "1", digits[1:]
    else:
        return None

    def valid(x):
        return x // 10**9 >= 2 and x // 10**6 % 10 >= 2

    plain = valid(int(own))
    if not plain and "(" not in m and "+" not in m:
        return None  # without a mark, ten digits are a phone number only under the numbering plan
    # valid and other numbers each stay among themselves, so the result is read as the same kind again
    y = f.permute("phone", int(own), 10**10, valid if plain else lambda x: not valid(x), back)
    return _refill(m, f"{head}{y:010d}")


def _international(f, m, back):
    digits = re.sub(r"\D", "", m)
    if not 9 <= len(digits) <= 15 or digits[0] == "0":
        return None
    if digits[0] == "1" and len(digits) == 11:
        return _phone(f, m, back)
    n = len(digits) - 3
    return _refill(m, digits[:3] + f"{f.permute(f'intl{n}', int(digits[3:]), 10**n, None, back):0{n}d}")


def _ipv4(f, m, back):
    parts = m.split(".")
    if any((len(p) > 1 and p[0] == "0") or int(p) > 255 for p in parts):
        return None
    x = int.from_bytes(bytes(map(int, parts)), "big")
    y = f.permute("ipv4", x, 1 << 32, None, back)
    return ".".join(map(str, y.to_bytes(4, "big")))


def _ssn(f, m, back):
    def valid(x):
        area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    x = int(m.replace("-", ""))
    return _refill(m, f"{f.permute('ssn', x, 9 * 10**8, valid, back):09d}") if valid(x) else None


def _iban(f, m, back):
    solid = m.replace(" ", "")

    def check(country, body):
        number = "".join(str(int(c, 36)) for c in body + country + "00")
        return f"{98 - int(number) % 97:02d}"

    if not 15 <= len(solid) <= 34 or check(solid[:2], solid[4:]) != solid[2:4]:
        return None
    body = _mixed(f, "iban", solid[4:], back)
    it = iter(solid[:2] + check(solid[:2], body) + body)
    return "".join(c if c == " " else next(it) for c in m)


def _date(order):
    def run(f, m, back):
        numbers = list(map(int, re.findall(r"\d+", m)))
        try:
            day = datetime.date(numbers[order.index("y")], numbers[order.index("m")], numbers[order.index("d")])
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        first = FIRST_DAY.toordinal()
        new = datetime.date.fromordinal(first + f.permute("date", day.toordinal() - first, LAST_DAY.toordinal() - first + 1, None, back))
        digits = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return _refill(m, "".join(digits[c] for c in order))

    return run


def _slash_date(f, m, back):
    """Day first unless that is no date; the reading survives the change only if it stays the first one
    possible, so month-first dates (second number above 12) keep a day above 12."""
    a, b, _ = map(int, m.split("/"))
    if b <= 12:
        return _date("dmy")(f, m, back)
    if a > 12:
        return None
    first, n = FIRST_DAY.toordinal(), LAST_DAY.toordinal() - FIRST_DAY.toordinal() + 1
    try:
        x = datetime.date(int(m[6:]), a, b).toordinal() - first
    except ValueError:
        return None
    if not 0 <= x < n:
        return None
    new = datetime.date.fromordinal(first + f.permute("mdy", x, n, lambda y: datetime.date.fromordinal(first + y).day > 12, back))
    return f"{new.month:02d}/{new.day:02d}/{new.year:04d}"


def _email(f, m, back):
    name, _, host = m.rpartition("@")
    return f"{_mixed(f, 'mail', name, back)}@{host}"


_END = r"(?![0-9])"
#: kind, shape, and the function that validates and replaces; earlier kinds win where shapes overlap
KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", _email),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    ("date", r"(?<![0-9A-Za-z.-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])", _date("ymd")),
    ("date", r"(?<![0-9A-Za-z.-])[0-9]{2}\.[0-9]{2}\.[0-9]{4}" + _END, _date("dmy")),
    ("date", r"(?<![0-9A-Za-z/])[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/])", _slash_date),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _ssn),
    ("ipv4", r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])", _ipv4),
    ("card", r"(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])", _card),
    ("phone", r"(?<![0-9A-Za-z+])(?:\+?1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-]?[0-9]{4}" + _END, _phone),
    ("phone", r"(?<![0-9A-Za-z+.-])(?:\+?1[ .-])?[2-9][0-9]{2}[.-][2-9][0-9]{2}[.-][0-9]{4}(?![0-9]|[.-][0-9])", _phone),
    ("phone", r"(?<![0-9A-Za-z+])\+[1-9](?:[ .-]?[0-9]){8,14}" + _END, _international),
]
_ANY = re.compile("|".join(f"(?P<k{i}>{shape})" for i, (_, shape, _) in enumerate(KINDS)))
_EACH = [re.compile(shape) for _, shape, _ in KINDS]
_HINT = "[0-9@]"


class Pseudonyms:
    def __init__(self, key: bytes, back: bool = False):
        feistel = Feistel(key)

        @lru_cache(100_000)
        def one(k: int, value: str) -> str | None:
            return KINDS[k][2](feistel, value, back)

        self.one = one

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """Text with pseudonyms, and (kind, start, end) of each in it (characters; lengths may differ for addresses)."""
        out, found, at, size = [], [], 0, 0
        pos = 0
        while True:
            m = _ANY.search(text, pos)
            if m is None:
                break
            k = int(m.lastgroup[1:])
            new, end = self.one(k, m.group()), m.end()
            if new is None:  # a later kind may still fit here
                for j in range(k + 1, len(KINDS)):
                    other = _EACH[j].match(text, m.start())
                    if other and (new := self.one(j, other.group())) is not None:
                        k, end = j, other.end()
                        break
            if new is None:
                pos = m.start() + 1
                continue
            out += [text[at : m.start()], new]
            size += m.start() - at
            found.append((KINDS[k][0], size, size + len(new)))
            size += len(new)
            at = pos = end
        return "".join([*out, text[at:]]), found


_FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_FOUND_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in its text column, plus ``found`` (``found_`` if taken): kind and place of each.

    ``back`` inverts a text written with the same key. A null text stays null with nothing found; an
    empty table gives no rows; repeated rows change alike. Map-only. The key is a secret of the caller.
    """
    ship(docs.sparkSession)
    found_col = fresh(docs, "found")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, back)
        for batch in batches:
            texts = text_column(batch, text_col)
            hinted = pc.match_substring_regex(texts.fill_null(""), _HINT)
            own = [names.replace(t) for t in texts.filter(hinted).to_pylist()]
            rest = iter(own)
            found = [next(rest)[1] if h else [] for h in hinted.to_pylist()]
            new = pc.replace_with_mask(texts, hinted, pa.array([t for t, _ in own], texts.type))
            places = pa.array([[dict(zip(("kind", "start", "end"), x, strict=True)) for x in f] for f in found], _FOUND_ARROW)
            columns = list(batch.columns)
            columns[at] = new.cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, places], names=[*batch.schema.names, found_col])

    return docs.mapInArrow(lean(run), T.StructType([*docs.schema.fields, T.StructField(found_col, _FOUND)]))
