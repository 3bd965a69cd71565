"""PII: format-preserving Feistel pseudonyms.

Validated numbers and dates are permuted under a key within their own format: card numbers (Luhn) stay card numbers of
the same length, IBANs keep their country and check out, telephone numbers keep their country code (by the list of calling
codes, so that one number has one pseudonym however it is grouped), social security
numbers and IPv4 addresses stay valid, dates stay dates; the names in e-mail addresses keep their pattern of letters and
digits, their domains stay as they are. Every value is the number of an element of a finite domain; a Feistel network on a * b >= n cells, walked until
it is back in the domain, is a permutation of it. So equal values get equal pseudonyms in all documents, different
values different ones, and whoever has the key can undo it. Separators, brackets and letter case stay as they are.

A value's pseudonym depends on the key and the value alone: no table is kept and nothing is shuffled.

Where a match fails its check, shorter ends are tried, then the kinds that follow at the same place, then the next
character. The image of a card keeps the outcome of the check of every longer number around it, so undoing finds the same
values; it can miss one only where its pseudonym completes a failed number that overlaps just a part of it.

Defined cases: a null text stays null; numbers that fail validation stay; an IBAN has the length of its country; a date
with slashes is day-first where month-first is no date; repeated rows are handled alike; texts of any
length are searched whole; an empty table gives an empty table; output columns replace input columns of the same name.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUNDS = 10
#: The key of the query; production passes its own.
DEMO_KEY = b"tallyfold demonstration key"


class Feistel:
    """A keyed permutation of 0 .. n-1; `tweak` separates domains."""

    def __init__(self, key: bytes, tweak: str, n: int):
        if n < 1:
            raise ValueError("an empty domain")
        self.n = n
        self.a = math.isqrt(n - 1) + 1
        self.b = -(-n // self.a)
        self.key = hashlib.blake2b(key, digest_size=32, person=b"pseudonym").digest()
        self.tweak = f"{tweak}/{n}".encode()

    def _round(self, i: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(b"%d/%d/" % (i, half) + self.tweak, key=self.key, digest_size=24).digest(), "big")

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in range(0, ROUNDS, 2):
            left = (left + self._round(i, right)) % self.a
            right = (right + self._round(i + 1, left)) % self.b
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i in reversed(range(0, ROUNDS, 2)):
            right = (right - self._round(i + 1, left)) % self.b
            left = (left - self._round(i, right)) % self.a
        return left * self.b + right

    def encrypt(self, x: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        """The image of `x` among the valid numbers below n, of which `x` must be one."""
        x = self._once(x)
        while x >= self.n or not valid(x):
            x = self._once(x)
        return x

    def decrypt(self, x: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        x = self._back(x)
        while x >= self.n or not valid(x):
            x = self._back(x)
        return x


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in f"{rest}{country}00")) % 97


#: The length of an IBAN by its country; of other countries, any length whose check holds.
IBAN_LENGTH = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL FK SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}


def _other_luhn(digits: str) -> int:
    """The Luhn sum with the other places doubled: it and luhn() decide the check of every number that `digits` is a part of."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _check_digit(body: str) -> str:
    return next(c for c in "0123456789" if luhn(body + c))


@lru_cache(None)
def _card_like(k: int, other: int) -> Callable[[int], bool]:
    """Bodies of k digits whose card number has the same other Luhn sum."""

    def valid(x: int) -> bool:
        body = f"{x:0{k}d}"
        return x > 0 and _other_luhn(body + _check_digit(body)) == other

    return valid


# Calling codes of one and two digits; all others have three.
CALLING = {"1", "7"} | set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)


def calling_code(digits: str) -> str:
    return next((digits[:k] for k in (1, 2) if digits[:k] in CALLING), digits[:3])


def _valid_ssn(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


_FIRST_DAY = datetime.date(1800, 1, 1).toordinal()
_DAYS = datetime.date(2200, 1, 1).toordinal() - _FIRST_DAY


def _late(x: int) -> bool:
    """Days after the 12th stay among themselves: only they have a spelling that month-first is no date."""
    return datetime.date.fromordinal(_FIRST_DAY + x).day > 12


def _early(x: int) -> bool:
    return not _late(x)


def _fill(pattern: str, digits: str) -> str:
    """`pattern` with its digits replaced one by one."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


class Pseudonyms:
    """Pseudonyms under one key, by kind: each method gives the new spelling or None where validation fails."""

    def __init__(self, key: bytes, undo: bool = False):
        self.key, self.undo = key, undo
        self.permuted = lru_cache(50_000)(self._permuted)

    def _permuted(self, tweak: str, n: int, x: int, valid: Callable[[int], bool] | None = None) -> int:
        f = Feistel(self.key, tweak, n)
        go = f.decrypt if self.undo else f.encrypt
        return go(x) if valid is None else go(x, valid)

    def card(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if not luhn(digits) or not digits.strip("0"):
            return None
        k = len(digits) - 1
        body = f"{self.permuted(f'card{k}', 10**k, int(digits[:-1]), _card_like(k, _other_luhn(digits))):0{k}d}"
        return _fill(found, body + _check_digit(body))

    def iban(self, found: str) -> str | None:
        plain = found.replace(" ", "").upper()
        country, check, rest = plain[:2], plain[2:4], plain[4:]
        if not 11 <= len(rest) <= 30 or len(plain) != IBAN_LENGTH.get(country, len(plain)) or int(check) != _iban_check(country, rest):
            return None
        radix = [26 if c.isalpha() else 10 for c in rest]
        new = self._mixed(f"iban{country}", rest, radix)
        out = iter(f"{country}{_iban_check(country, new):02d}{new}")
        return "".join(c if c == " " else next(out).lower() if c.islower() else next(out) for c in found)

    def _mixed(self, tweak: str, text: str, radix: list[int]) -> str:
        """Letters (upper case) and digits permuted together, each place keeping its kind."""
        x = 0
        for c, r in zip(text, radix, strict=True):
            x = x * r + (ord(c) - 65 if r == 26 else int(c))
        x = self.permuted(f"{tweak}:{''.join('A' if r == 26 else '9' for r in radix)}", math.prod(radix), x)
        out = []
        for r in reversed(radix):
            x, d = divmod(x, r)
            out.append(chr(65 + d) if r == 26 else str(d))
        return "".join(reversed(out))

    def phone(self, found: str) -> str | None:
        digits = re.sub(r"\D", "", found)
        if found.startswith("+"):
            country = calling_code(digits)
            rest = digits[len(country) :]
            if not 8 <= len(digits) <= 15 or len(rest) < 6 or (country == "1" and len(rest) != 10):
                return None
        else:
            country, rest = "1", digits
        k = len(rest)
        new = f"{self.permuted(f'phone{country}-{k}', 10**k, int(rest)):0{k}d}"
        return _fill(found, (country if found.startswith("+") else "") + new)

    def ssn(self, found: str) -> str | None:
        x = int(found.replace("-", ""))
        return _fill(found, f"{self.permuted('ssn', 10**9, x, _valid_ssn):09d}") if _valid_ssn(x) else None

    def ipv4(self, found: str) -> str | None:
        parts = found.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        x = self.permuted("ipv4", 2**32, int.from_bytes(bytes(map(int, parts)), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, found: str) -> str | None:
        parts = re.split(r"[-./]", found)
        year_first = len(parts[0]) == 4
        month_first = "/" in found and int(parts[0]) <= 12
        try:
            if year_first:
                day = datetime.date(*map(int, parts))
            elif month_first:
                day = datetime.date(int(parts[2]), int(parts[0]), int(parts[1]))
            else:
                day = datetime.date(int(parts[2]), int(parts[1]), int(parts[0]))
        except ValueError:
            return None
        at = day.toordinal() - _FIRST_DAY
        if not 0 <= at < _DAYS:
            return None
        new = datetime.date.fromordinal(_FIRST_DAY + self.permuted("date", _DAYS, at, _late if day.day > 12 else _early))
        order = ("%Y%m%d") if year_first else ("%m%d%Y" if month_first else "%d%m%Y")
        # days and months are written with two digits, so that every date of the calendar has a spelling
        return _fill(re.sub(r"(?<!\d)\d(?!\d)", "00", found), new.strftime(order).zfill(8))

    def email(self, found: str) -> str | None:
        name, _, domain = found.rpartition("@")
        places = [i for i, c in enumerate(name) if c.isascii() and c.isalnum()]
        if not places:
            return None
        radix = [10 if name[i].isdigit() else 26 for i in places]
        new = self._mixed(f"email@{domain.lower()}", "".join(name[i] for i in places).upper(), radix)
        out = list(name)
        for i, c in zip(places, new, strict=True):
            out[i] = c.lower() if name[i].islower() else c
        return f"{''.join(out)}@{domain}"


#: What is looked for, in this order at each place.
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?(?![A-Za-z0-9])",
    "phone": r"\+[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-]?[0-9]{2,5}){1,5}(?![0-9])|(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
PATTERN = re.compile("|".join(f"(?P<{k}>{p})" for k, p in KINDS.items()))
_ONE = {k: re.compile(p) for k, p in KINDS.items()}
#: Where a match of these may end sooner, when its check fails.
_END = {"iban": re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])"), "card": re.compile(r"(?<=[0-9])(?![0-9])"), "phone": re.compile(r"(?<=[0-9])(?![0-9])")}
_MAYBE = re.compile(r"[0-9@]")


def replace(text: str | None, by: Pseudonyms) -> tuple[str | None, dict[str, int]]:
    """(the text with pseudonyms, how many of each kind)."""
    found: dict[str, int] = {}
    if text is None or not _MAYBE.search(text):
        return text, found

    out, done, at = [], 0, 0
    while m := PATTERN.search(text, at):
        kind, end, new = _value(text, m, by)
        at = m.start() + 1
        if new is not None:
            found[kind] = found.get(kind, 0) + 1
            out += text[done : m.start()], new
            done = at = end
    return "".join([*out, text[done:]]), found


def _value(text: str, m: re.Match, by: Pseudonyms) -> tuple[str, int, str | None]:
    """(kind, end, pseudonym) of the first value that starts where `m` does and passes its check: kinds in order, longest first."""
    kinds = list(KINDS)
    for kind in kinds[kinds.index(m.lastgroup) :]:
        one = _ONE[kind].match(text, m.start())
        if one is None:
            continue
        ends = [one.end()]
        if kind in _END:
            ends += [e.start() for e in _END[kind].finditer(text, one.start() + 1, one.end())][::-1]
        for end in dict.fromkeys(ends):
            if end < one.end() and not _ONE[kind].fullmatch(text, one.start(), end):
                continue
            new = getattr(by, kind)(text[one.start() : end])
            if new is not None:
                return kind, end, new
    return m.lastgroup, m.end(), None


def pseudonymize(docs: DataFrame, key: bytes, text: str = "text", keep: list[str] | None = None, undo: bool = False) -> DataFrame:
    """`docs` (columns `keep` beside the text, all by default) with the text replaced and `pii`, a map of kinds and counts."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("pii", text)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(text, T.StringType()), T.StructField("pii", T.MapType(T.StringType(), T.IntegerType()))])
    own = docs.select(*keep, F.col(text).cast("string").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Pseudonyms(key, undo)
        for batch in batches:
            done = [replace(t, by) for t in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            columns.append(pa.array([t for t, _ in done], pa.string()))
            columns.append(pa.array([list(f.items()) for _, f in done], pa.map_(pa.string(), pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, text, "pii"])

    return own.mapInArrow(run, schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms, and how many values of each kind were replaced."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    done = pseudonymize(docs, DEMO_KEY)
    counts = [F.coalesce(F.col("pii")[k], F.lit(0)).alias(f"n_{k}") for k in ("email", "iban", "phone", "date", "ssn", "ipv4", "card")]
    return done.select("doc_id", "text", *counts)
