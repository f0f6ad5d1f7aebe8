"""PII: format-preserving Feistel pseudonyms.

Card numbers, bank accounts, phone and social security numbers, IP addresses, dates and e-mail
addresses are found by pattern and kept only if they validate (check digits, octet and calendar
ranges). Each is replaced by another valid value of the same format: a keyed Feistel network
permutes the set of values of that format, so that equal values get equal pseudonyms in all
documents, different values different ones, and separators stay in place. The key holder can
reverse it; without the key the original cannot be read off.

A phone number is its country code and its national digits, however they are printed (after ``+``
or ``00``, with blanks, dots, hyphens or brackets, or as a North American number without a code);
the code stays and the national digits are permuted. Dates are days, with or without leading
zeros. So one value has one pseudonym in all its spellings. Only ASCII digits make values; digits
of other scripts are text.

Defined results: null texts stay null and empty ones empty, both with no finding; values that
do not validate are left alone; a slash date is read as day/month/year, or as month/day/year where
only that is a date; where a run of digit groups is no card number, its parts between group
boundaries are tried, as are those of an account number; of overlapping candidates the one that starts first, then the
kind listed first, is replaced; repeated rows get the same text. Other columns pass unchanged.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from datetime import date
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType

ROUNDS = 8


def permute(value: int, size: int, key: bytes, tweak: bytes) -> int:
    """A keyed permutation of range(size): a Feistel network, walked until inside the range."""
    if size < 2:
        return value
    side = isqrt(size - 1) + 1
    while True:
        left, right = divmod(value, side)
        for k in range(ROUNDS):
            digest = blake2b(b"%d|%d|%d|" % (k, side, right) + tweak, key=key, digest_size=16).digest()
            left, right = right, (left + int.from_bytes(digest, "big")) % side
        value = left * side + right
        if value < size:
            return value


def unpermute(value: int, size: int, key: bytes, tweak: bytes) -> int:
    """The inverse of :func:`permute`."""
    if size < 2:
        return value
    side = isqrt(size - 1) + 1
    while True:
        left, right = divmod(value, side)
        for k in reversed(range(ROUNDS)):
            digest = blake2b(b"%d|%d|%d|" % (k, side, left) + tweak, key=key, digest_size=16).digest()
            left, right = (right - int.from_bytes(digest, "big")) % side, left
        value = left * side + right
        if value < size:
            return value


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_PLACE = {c: (a, a.index(c)) for a in _ALPHABETS for c in a}


def permute_chars(text: str, key: bytes, tweak: bytes, step: Callable = permute) -> str:
    """Permutes digits among digits and letters among letters of their case; the rest stays.

    The places of letters and digits are part of the format, so it is one permutation of all
    strings of that format.
    """
    value, size = 0, 1
    for c in text:
        if c in _PLACE:
            alphabet, at = _PLACE[c]
            value, size = value * len(alphabet) + at, size * len(alphabet)
    form = "".join({10: "0", 26: "a"}[len(_PLACE[c][0])] if c in _PLACE else c for c in text)
    value = step(value, size, key, tweak + form.encode())
    out = []
    for c in reversed(text):
        if c in _PLACE:
            alphabet = _PLACE[c][0]
            value, at = divmod(value, len(alphabet))
            c = alphabet[at]
        out.append(c)
    return "".join(reversed(out))


def _refill(text: str, digits: str) -> str:
    """Puts digits into the places of the digits of ``text``."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in text)


def luhn_digit(digits: str) -> str:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 - k % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


# -- kinds: each returns the pseudonym of a candidate, or None if it does not validate -----


def card(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = permute_chars(digits[:-1], key, b"card")
    return _refill(text, body + luhn_digit(body))


def _iban_check(country: str, account: str) -> str:
    spelled = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(spelled) % 97:02d}"


def iban(text: str, key: bytes) -> str | None:
    if text not in (text.upper(), text.lower()):
        return None
    plain = re.sub("[ -]", "", text).upper()
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or _iban_check(country, account) != check:
        return None
    new = permute_chars(account, key, b"iban" + country.encode())
    whole = country + _iban_check(country, new) + new
    left = iter(whole if text == text.upper() else whole.lower())
    return "".join(c if c in " -" else next(left) for c in text)


def ssn(text: str, key: bytes) -> str | None:
    area, group, serial = text.split("-")
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    areas = 898  # 001 to 899 without 666
    at = int(area) - 1 - (int(area) > 666)
    value = permute((at * 99 + int(group) - 1) * 9999 + int(serial) - 1, areas * 99 * 9999, key, b"ssn")
    rest, serial_at = divmod(value, 9999)
    area_at, group_at = divmod(rest, 99)
    return f"{area_at + 1 + (area_at >= 665):03d}-{group_at + 1:02d}-{serial_at + 1:04d}"


#: Country codes of one and two digits; all others have three.
COUNTRY_CODES = frozenset(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split())


def phone(text: str, key: bytes) -> str | None:
    prefix = re.match(r"\+|00|", text, re.ASCII).group()
    digits = re.sub(r"\D", "", text[len(prefix):].replace("(0)", ""), flags=re.ASCII)
    country = next((digits[:n] for n in (1, 2) if digits[:n] in COUNTRY_CODES), digits[:3]) if prefix else ""
    national = digits[len(country):]
    if not prefix:
        country = "1"
        if len(national) != 10 or national[0] in "01":
            return None
    if not 7 <= len(national) <= 15 - len(country) or prefix == "00" and len(digits) < 9:
        return None
    new = permute_chars(national[1:], key, b"phone" + country.encode() + national[:1].encode())
    new = iter((country if prefix else "") + national[0] + new)  # the first digit stays, so numbers stay dialled alike
    out, at = [prefix], len(prefix)
    while at < len(text):
        if text.startswith("(0)", at):
            out.append("(0)")
            at += 3
            continue
        out.append(next(new) if text[at].isdigit() else text[at])
        at += 1
    return "".join(out)


def ipv4(text: str, key: bytes) -> str | None:
    octets = text.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    value = 0
    for o in octets:
        value = value << 8 | int(o)
    value = permute(value, 1 << 32, key, b"ipv4")
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


_FIRST, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
#: Days 1 to 12 of a month and later days are permuted apart, so that a pseudonym is read in the
#: same order as its original: 12/31/2024 must not become 03/05/1999, another date's pseudonym.
_DAYS: dict[bool, list[int]] = {False: [], True: []}
for _day in range(_FIRST, _LAST + 1):
    _DAYS[date.fromordinal(_day).day > 12].append(_day)


def _dated(*orders: str):
    def read(order: str, numbers: list[int]) -> date | None:
        parts = dict(zip(order, numbers))
        try:
            return date(parts["y"], parts["m"], parts["d"])
        except ValueError:
            return None

    def replace(text: str, key: bytes) -> str | None:
        sep = re.search(r"\D", text).group()
        numbers = [int(n) for n in text.split(sep)]
        order, day = next(((o, d) for o in orders if (d := read(o, numbers))), (None, None))
        if day is None or not _FIRST <= day.toordinal() <= _LAST:
            return None
        days = _DAYS[day.day > 12]
        at = permute(bisect_left(days, day.toordinal()), len(days), key, b"date")
        new = date.fromordinal(days[at])
        padded = min(len(n) for n in text.split(sep)) == 2
        shown = {"y": f"{new.year:04d}", "m": f"{new.month:0{1 + padded}d}", "d": f"{new.day:0{1 + padded}d}"}
        return sep.join(shown[c] for c in order)
    return replace


def email(text: str, key: bytes) -> str | None:
    local, _, domain = text.partition("@")
    return permute_chars(local, key, b"mail" + domain.lower().encode()) + "@" + domain


KINDS: tuple[tuple[str, str, Callable[[str, bytes], str | None]], ...] = (
    ("email", r"(?<![\w.+%-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_])?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", email),
    ("iban", r"(?<![A-Za-z0-9])[A-Za-z]{2}\d{2}(?:[ -]?[A-Za-z0-9]{4}){2,7}(?:[ -]?[A-Za-z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("date", r"(?<![\d.-])\d{4}-\d{2}-\d{2}(?![\d-])", _dated("ymd")),
    ("date", r"(?<![\d.])\d{1,2}\.\d{1,2}\.\d{4}(?!\.?\d)", _dated("dmy")),
    ("date", r"(?<![\d/])\d{1,2}/\d{1,2}/\d{4}(?![\d/])", _dated("dmy", "mdy")),
    ("date", r"(?<![\d/])\d{4}/\d{2}/\d{2}(?![\d/])", _dated("ymd")),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", ipv4),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", ssn),
    ("card", r"(?<!\d)\d(?:[ .  -]?\d){12,}", card),
    ("phone", r"(?:\+|(?<![\d.+-])00)[1-9]\d{0,2}[ .-]?(?:\(0\)[ .-]?)?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)", phone),
    ("phone", r"(?<![\d+(])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)", phone),
    ("phone", r"(?<![\d+(])(?<!\d[ .-])[2-9]\d{2} \d{3} \d{4}(?![ .-]?\d)", phone),
)
KIND_NAMES = tuple(dict.fromkeys(name for name, _, _ in KINDS))
_PATTERNS = [re.compile(p, re.ASCII) for _, p, _ in KINDS]
_IBAN = dict(zip(KIND_NAMES, _PATTERNS))["iban"]
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}\d{2}(?=[ A-Za-z0-9-])", re.ASCII)
_IBAN_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
_IBAN_LONGEST = 34 + 8  # with blanks
#: Account number lengths by country; others are found too, after these.
_IBAN_LENGTHS = {c: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
    32: "LC"}.items() for c in countries.split()}
_LEAD = re.compile(r"[0-9@]")
#: Groups in which card numbers are printed.
_CARD_GROUPS = {(4, 4, 4, 4), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4), (4, 3, 3, 3)}


def ibans(text: str, key: bytes) -> list[tuple[int, int, str]]:
    """(start, end, pseudonym): numbers of their country's length first, then the longest."""
    spans = []
    for m in _IBAN_START.finditer(text):
        start = m.start()
        for e in _IBAN_END.finditer(text, start + 15, start + _IBAN_LONGEST + 1):
            if _IBAN.fullmatch(text, start, e.start()):
                n = len(re.sub("[ -]", "", text[start:e.start()]))
                spans.append((_IBAN_LENGTHS.get(text[start:start + 2].upper()) != n, -n, start, e.start()))
    out: list[tuple[int, int, str]] = []
    for *_, start, end in sorted(spans):
        new = None if any(a < end and start < b for a, b, _ in out) else iban(text[start:end], key)
        if new is not None:
            out.append((start, end, new))
    return out


def cards(text: str, start: int, end: int, taken: list[tuple[int, int]], key: bytes) -> Iterator[tuple[int, int, str]]:
    """(start, end, pseudonym) of the card numbers in a run of digit groups, outside ``taken``.

    All stretches of groups between what is taken are tried: whole ones first, then groups as
    card numbers are printed, then the longest.
    """
    stretches: list[list[tuple[int, int]]] = [[]]
    for m in re.finditer("[0-9]+", text[start:end]):
        group = (start + m.start(), start + m.end())
        if any(a < group[1] and group[0] < b for a, b in taken):
            stretches.append([])
        else:
            stretches[-1].append(group)
    for groups in stretches:
        sizes = [b - a for a, b in groups]
        spans = []
        for i in range(len(groups)):
            n = 0
            for j in range(i, len(groups)):
                n += sizes[j]
                if n > 19:
                    break
                if n >= 13:
                    whole, printed = j - i + 1 == len(groups), i == j or tuple(sizes[i:j + 1]) in _CARD_GROUPS
                    if printed or "." not in text[groups[i][0]:groups[j][1]]:  # dots also part thousands
                        spans.append((not whole, not printed, -n, i, j + 1))
        free = [True] * len(groups)
        for *_, i, j in sorted(spans):
            if all(free[i:j]):
                at, to = groups[i][0], groups[j - 1][1]
                new = card(text[at:to], key)
                if new is not None:
                    free[i:j] = [False] * (j - i)
                    yield at, to, new


def pseudonymise(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and the number of findings of each kind.

    A run of digits that fails as one kind is still tried as another; where the pattern of a card
    or account number reaches over its neighbours, the parts are tried.
    """
    if not _LEAD.search(text):
        return text, {}
    found = []
    for rank, ((name, _, replace), pattern) in enumerate(zip(KINDS, _PATTERNS)):
        if name == "email" and "@" not in text:
            continue
        if name == "iban":
            spans = ibans(text, key)
        elif name == "card":
            runs, taken = [m.span() for m in pattern.finditer(text)], [f[0:3:2] for f in found]
            spans = [span for run in runs for span in cards(text, *run, [t for t in taken if t[0] < run[1] and run[0] < t[1]], key)]
        else:
            spans = [(*m.span(), replace(m.group(), key)) for m in pattern.finditer(text)]
        found += [(start, rank, end, name, new) for start, end, new in spans if new is not None]
    out, at, counts = [], 0, {}
    for start, _, end, name, new in sorted(found):
        if start >= at:
            out += [text[at:start], new]
            at = end
            counts[name] = counts.get(name, 0) + 1
    return "".join([*out, text[at:]]), counts


def pseudonymise_documents(docs: DataFrame, key: str, text: str = "text", found: str = "pii_found") -> DataFrame:
    """All columns, ``text`` with pseudonyms, and a map ``found`` from kind to count.

    An input column named like ``found`` is replaced.
    """
    docs = docs.drop(found)
    secret = blake2b(key.encode(), digest_size=32).digest()
    at = docs.columns.index(text)
    counted = StructField(found, MapType(StringType(), LongType()))

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for t in batch.column(at).to_pylist():
                new, n = (None, {}) if t is None else pseudonymise(t, secret)
                texts.append(new)
                counts.append(list(n.items()))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.map_(pa.string(), pa.int64()))],
                                             names=[*batch.schema.names, found])

    return docs.mapInArrow(replaced, StructType([*docs.schema.fields, counted]))
