"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates that validate (checksums, ranges, the calendar) and e-mail addresses are permuted within their own format
under a key: a card number becomes another card number of the same length with a right check digit, a date another date
written alike. A permutation has no collisions, so equal values stay equal across documents and different ones stay different.
What does not validate stays as it is.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchday.llm.tables import table
from matchday.llm.words import chunks

_ROUNDS = 8


def _walk(x: int, n: int, key: bytes, tweak: bytes, back: bool) -> int:
    """A Feistel network over an even number of bits (or its inverse), walked until it falls below ``n`` (fewer than four steps
    on average)."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, size = (1 << half) - 1, (half + 7) // 8
    while True:
        a, b = x >> half, x & mask
        if back:
            a, b = b, a
        for r in reversed(range(_ROUNDS)) if back else range(_ROUNDS):
            h = hashlib.shake_256(b"%b|%b|%d|%d|%x" % (key, tweak, n.bit_length(), r, b)).digest(size)
            a, b = b, a ^ (int.from_bytes(h, "big") & mask)
        if back:
            a, b = b, a
        x = a << half | b
        if x < n:
            return x


@lru_cache(1 << 14)
def permute(x: int, n: int, key: bytes, tweak: bytes) -> int:
    """The place of ``x`` in a keyed permutation of ``0 .. n - 1`` that leaves no place where it is.

    It goes one place on in a keyed order: to the order by a Feistel network, on by one, and back. So it is one cycle over all
    places, and walking on until a place suits permutes the suitable ones, again without a fixed one (if there are two).
    """
    if n <= 1:
        return x
    return _walk((_walk(x, n, key, tweak, False) + 1) % n, n, key, tweak, True)


def luhn(digits: str) -> int:
    """Luhn sum modulo 10 of a number with its check digit."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10


def _digits(value: str) -> str:
    return re.sub(r"[^0-9]", "", value)


def _refill(value: str, digits: str) -> str:
    """``value`` with its digits replaced one by one."""
    new = iter(digits)
    return "".join(next(new) if "0" <= c <= "9" else c for c in value)


def _number(digits: str, key: bytes, kind: str) -> str:
    return f"{permute(int(digits), 10 ** len(digits), key, b'%b%d' % (kind.encode(), len(digits))):0{len(digits)}d}"


def _card(value: str, key: bytes) -> str | None:
    d = _digits(value)
    if not 13 <= len(d) <= 19 or luhn(d) or len(set(d)) == 1:
        return None
    body = _number(d[:-1], key, "card")
    return _refill(value, body + str(-luhn(body + "0") % 10))


def _ip(value: str, key: bytes) -> str | None:
    parts = value.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in parts):
        return None
    x = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _phone(value: str, key: bytes) -> str | None:
    country = re.match(r"\+\d{1,3}(?=\D)|", value)[0]
    d = _digits(value[len(country):])
    if not 7 <= len(d) <= 12:
        return None
    return country + _refill(value[len(country):], _number(d, key, "phone" + country))


def _ssn(value: str, key: bytes) -> str | None:
    def valid(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    d = _digits(value)
    if not valid(d):
        return None
    while True:  # walks on from numbers that are none
        d = _number(d, key, "ssn")
        if valid(d):
            return _refill(value, d)


def _iban(value: str, key: bytes) -> str | None:
    bare = value.replace(" ", "")

    def rest(x: str) -> int:
        return int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97

    if not 15 <= len(bare) <= 34 or rest(bare) != 1:
        return None
    body = _mixed(bare[4:], key, "iban" + bare[:2])
    bare = bare[:2] + f"{98 - rest(bare[:2] + '00' + body):02d}" + body
    new = iter(bare)
    return "".join(c if c == " " else next(new) for c in value)


def _mixed(text: str, key: bytes, kind: str) -> str:
    """Letters and digits (A-Z, a-z, 0-9) permuted, each within its class; other characters stay."""
    classes = [("0", 10) if "0" <= c <= "9" else ("A", 26) if "A" <= c <= "Z" else ("a", 26) if "a" <= c <= "z" else ("", 0) for c in text]
    x, n = 0, 1
    for c, (zero, size) in zip(text, classes, strict=True):
        if size:
            x, n = x * size + ord(c) - ord(zero), n * size
    x = permute(x, n, key, f"{kind}{''.join(z or c for c, (z, _) in zip(text, classes, strict=True))}".encode())
    out = []
    for c, (zero, size) in zip(reversed(text), reversed(classes), strict=True):
        if size:
            x, d = divmod(x, size)
            out.append(chr(ord(zero) + d))
        else:
            out.append(c)
    return "".join(reversed(out))


def _email(value: str, key: bytes) -> str | None:
    local, _, host = value.rpartition("@")
    if len(local) > 64 or ".." in value or host.startswith((".", "-")):
        return None
    new = _mixed(local.lower(), key, "email" + host.lower())
    return "".join(n.upper() if c.isupper() else n for c, n in zip(local, new, strict=True)) + "@" + host


_FIRST, _LAST = dt.date(1900, 1, 1), dt.date(2099, 12, 31)
_DATES = (
    (re.compile(r"(?P<y>\d{4})([-/.])(?P<m>\d{2})\2(?P<d>\d{2})"), "{y:04d}{s}{m:02d}{s}{d:02d}"),
    (re.compile(r"(?P<d>\d{2})([.-])(?P<m>\d{2})\2(?P<y>\d{4})"), "{d:02d}{s}{m:02d}{s}{y:04d}"),
    (re.compile(r"(?P<m>\d{2})(/)(?P<d>\d{2})/(?P<y>\d{4})"), "{m:02d}{s}{d:02d}{s}{y:04d}"),
    (re.compile(r"(?P<d>\d{2})(/)(?P<m>\d{2})/(?P<y>\d{4})"), "{d:02d}{s}{m:02d}{s}{y:04d}"),
)


def _date(value: str, key: bytes) -> str | None:
    for pattern, form in _DATES:
        if m := pattern.fullmatch(value):
            try:
                day = dt.date(int(m["y"]), int(m["m"]), int(m["d"]))
            except ValueError:
                continue
            if _FIRST <= day <= _LAST:
                n, new = (_LAST - _FIRST).days + 1, day
                while True:
                    new = _FIRST + dt.timedelta(permute((new - _FIRST).days, n, key, b"date"))
                    # a day and month with slashes is read as month and day where it can be: walks on to days that cannot
                    if pattern is not _DATES[-1][0] or new.day > 12:
                        return form.format(y=new.year, m=new.month, d=new.day, s=m[2])
    return None


#: Characters of an IBAN, by country.
_IBAN_SIZES = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 "
    "MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 "
    "SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}


def _of_its_country(value: str) -> bool:
    return len(value.replace(" ", "")) == _IBAN_SIZES.get(value[:2])


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: re.Pattern
    new: Callable[[str, bytes], str | None]
    #: What may not follow a value.
    after: re.Pattern
    #: Of several ends, those that this holds for are tried before longer ones.
    likely: Callable[[str], bool] | None = None


def _kind(name: str, body: str, new: Callable[[str, bytes], str | None], before: str = r"(?<![A-Za-z0-9_.+-])",
          after: str = r"(?![A-Za-z0-9_]|[.,-]\d)", likely: Callable[[str], bool] | None = None) -> Kind:
    return Kind(name, re.compile(f"{before}(?:{body}){after}", re.ASCII), new, re.compile(after, re.ASCII), likely)


#: In order of precedence where two begin at one place and are equally long.
KINDS = (
    _kind("email", r"[A-Za-z0-9_.+%-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}", _email, r"(?<![A-Za-z0-9_.+%-])", r"(?![A-Za-z0-9-])"),
    _kind("card", r"\d(?:[ -]?\d){12,18}", _card),
    _kind("ip", r"\d{1,3}(?:\.\d{1,3}){3}", _ip),
    _kind("iban", r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}", _iban, likely=_of_its_country),
    _kind("ssn", r"\d{3}-\d{2}-\d{4}", _ssn),
    # a time may follow a date
    _kind("date", r"\d{4}([-/.])\d{2}\1\d{2}|\d{2}([-/.])\d{2}\2\d{4}", _date, after=r"(?!(?!T\d)[A-Za-z0-9_]|[.,-]\d)"),
    _kind("phone", r"(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])|\(\d{3}\)[ .-]?|\d{3}[.-])\d{3,4}[ .-]?\d{4}", _phone),
)


def _ends(kind: Kind, text: str, start: int, end: int) -> list[int]:
    """The places where a value of ``kind`` that begins at ``start`` may end, ``end`` being the last: the likely ones, then the others,
    longer ones first."""
    shorter = [
        j for j in range(end - 1, start, -1)
        if not text[j].isalnum() and kind.after.match(text, j) and kind.pattern.fullmatch(text, start, j)]
    ends = [end, *shorter]
    return sorted(ends, key=lambda j: not kind.likely(text[start:j])) if kind.likely else ends


def find(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """start, end, kind and pseudonym of all values in a text, in order; the leftmost and then longest of overlapping ones.

    Every place where a value may begin is tried, with every place where it may end, so that a value beside other numbers or
    words is found. An IBAN of its country's length goes before a longer one.
    """
    found = []
    for rank, kind in enumerate(KINDS):
        at = 0
        while m := kind.pattern.search(text, at):
            start, at = m.start(), m.start() + 1
            new = None if kind.likely and not kind.likely(m[0]) else kind.new(m[0], key)
            if new is not None:
                found.append((start, -m.end(), rank, new))
                continue
            for end in _ends(kind, text, start, m.end()):
                if (new := kind.new(text[start:end], key)) is not None:
                    found.append((start, -end, rank, new))
                    break
    out, at = [], 0
    for start, end, rank, new in sorted(found):
        if start >= at:
            out.append((start, -end, KINDS[rank].name, new))
            at = -end
    return out


def _rows(batches, key: bytes) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches, "text"):
        may = pc.match_substring_regex(texts, r"\d|@").to_numpy(zero_copy_only=False)
        new = texts.to_pylist()
        spans = [[]] * len(new)
        for i in np.flatnonzero(may):
            if found := find(new[i], key):
                spans[i] = [(s, e, k) for s, e, k, _ in found]
                parts, at = [], 0
                for s, e, _, x in found:
                    parts += [new[i][at:s], x]
                    at = e
                new[i] = "".join([*parts, new[i][at:]])
        kinds = [[x[2] for x in row] for row in spans]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([row.count(k.name) for row in kinds], pa.int64()) for k in KINDS),
             pa.array([",".join(f"{k}:{s}:{e}" for s, e, k in row) for row in spans]), pa.array(new, pa.string())],
            ["doc_id", *(f"n_{k.name}" for k in KINDS), "spans", "text"])


def pseudonymise(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, a count of each kind, spans (kind:start:end in the input, code points, end exclusive)
    and the text with pseudonyms.

    The key decides the permutation and must be kept secret; with one key equal values agree across runs. A null text counts as
    empty. Repeated rows and null ids stay; an empty table gives an empty result; other columns are not looked at.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counts = ", ".join(f"n_{k.name} bigint" for k in KINDS)
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("text")).mapInArrow(
        lambda b: _rows(b, key), f"doc_id {kind}, {counts}, spans string, text string")


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), key=b"a key for tests only")
