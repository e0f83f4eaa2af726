"""Format-preserving pseudonyms for personal data.

Values are found by pattern and validated (Luhn, IBAN check digits, ranges, calendar), then permuted within their own
format by a keyed Feistel network with cycle walking: a card stays a valid card of the same layout, a date a valid date.
The permutation depends on key, kind and format only, so equal values stay linked across documents, different values
stay different, and whoever has the key can invert it. Text around the values is left as it is.
"""

from __future__ import annotations

import bisect
import datetime
import functools
import hashlib
import re
import string
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feira.llm.common import col, ship, small_batches

ROUNDS = 10
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


def permute(key: bytes, tweak: str, size: int, value: int, inverse: bool = False) -> int:
    """A keyed permutation of 0..size-1: a balanced Feistel network over the next even number of bits, applied again
    while the result is outside the domain (at most a few times, as the network's domain is under four times as large)."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8

    def mixed(number: int, part: int) -> int:
        seed = hashlib.blake2b(tweak.encode() + b"|%d|%d|" % (size, number), key=key, digest_size=32).digest()
        return int.from_bytes(hashlib.shake_128(seed + part.to_bytes(width, "big")).digest(width), "big") & mask

    while True:
        left, right = value >> half, value & mask
        if inverse:
            for number in reversed(range(ROUNDS)):
                left, right = right ^ mixed(number, left), left
        else:
            for number in range(ROUNDS):
                left, right = right, left ^ mixed(number, right)
        value = (left << half) | right
        if value < size:
            return value


_ALPHABETS = (string.digits, string.ascii_lowercase, string.ascii_uppercase, "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ")
_HEX = {"a": "0123456789abcdef", "A": "0123456789ABCDEF"}


def permute_letters(key: bytes, tweak: str, text: str, alphabets: Iterable[str] = _ALPHABETS, inverse: bool = False) -> str:
    """Permute a string's characters within their classes; characters of no class stay in place."""
    classes = [next((a for a in alphabets if c in a), c) for c in text]
    size = value = 0
    size = 1
    for c, a in zip(text, classes, strict=True):
        size *= len(a)
        value = value * len(a) + a.index(c)
    # The layout is part of the tweak, so each format has a permutation of its own.
    layout = ",".join(a if len(a) == 1 else f"{a[0]}{len(a)}" for a in classes)
    value = permute(key, f"{tweak}:{layout}", size, value, inverse)
    out = []
    for a in reversed(classes):
        value, place = divmod(value, len(a))
        out.append(a[place])
    return "".join(reversed(out))


def _refill(layout: str, characters: str) -> str:
    """``layout`` with its letters and digits replaced in order."""
    fill = iter(characters)
    return "".join(next(fill) if c.isalnum() else c for c in layout)


def luhn_digit(digits: str) -> str:
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def card(key: bytes, text: str, inverse: bool = False) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    body = digits[0] + permute_letters(key, f"card{digits[0]}", digits[1:-1], inverse=inverse)
    return _refill(text, body + luhn_digit(body))


def _iban_check(country: str, bban: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97


def iban(key: bytes, text: str, inverse: bool = False) -> str | None:
    plain = text.replace(" ", "")
    country, bban = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or f"{_iban_check(country, bban):02d}" != plain[2:4]:
        return None
    other = permute_letters(key, f"iban{country}", bban, (string.digits, string.ascii_uppercase), inverse)
    return _refill(text, f"{country}{_iban_check(country, other):02d}{other}")


def ip(key: bytes, text: str, inverse: bool = False) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    value = permute(key, "ip", 1 << 32, int.from_bytes(bytes(parts), "big"), inverse)
    return ".".join(map(str, value.to_bytes(4, "big")))


def phone(key: bytes, text: str, inverse: bool = False) -> str | None:
    country = m[0] if (m := re.match(r"\+\d{1,3}(?=\D)|\+\d", text)) else ""
    digits = re.sub(r"\D", "", text[len(country) :])
    if not 7 <= len(digits) <= 13:
        return None
    return country + _refill(text[len(country) :], permute_letters(key, f"phone{country}", digits, inverse=inverse))


def ssn(key: bytes, text: str, inverse: bool = False) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(permute(key, "ssn", 898 * 99 * 9999, value, inverse), 9999)
    area, group = divmod(value, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def date(key: bytes, text: str, inverse: bool = False) -> str | None:
    """Year first, day first (preferred where both are possible) or month first; zero padding as found."""
    a, mark, b, _, c = re.split(r"([-/.])", text)
    for order in ((0, 1, 2),) if len(a) == 4 else ((2, 1, 0), (2, 0, 1)):
        fields = (a, b, c)
        try:
            day = datetime.date(*[int(fields[i]) for i in order]).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            continue
        found = datetime.date.fromordinal(_FIRST_DAY + permute(key, f"date{order}{mark}", _DAYS, day, inverse))
        padded = not any(len(f) == 1 for f in fields) or any(f[0] == "0" for f in fields)
        ymd = (f"{found.year:04d}", *(f"{x:02d}" if padded else str(x) for x in (found.month, found.day)))
        return mark.join(ymd[order.index(i)] for i in range(3))
    return None


def email(key: bytes, text: str, inverse: bool = False) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{permute_letters(key, 'email' + domain.lower(), local, inverse=inverse)}@{domain}"


def secret(key: bytes, text: str, inverse: bool = False) -> str | None:
    kind = _HEX["A" if any(c in "ABCDEF" for c in text) else "a"]
    if not any(c.isdigit() for c in text) or any(c not in kind for c in text):
        return None
    return permute_letters(key, "secret", text, (kind,), inverse)


#: Tried in this order at each place, behind account and card numbers; the first that validates wins.
KINDS: tuple[tuple[str, str, Callable], ...] = (
    ("ip", r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)", ip),
    ("date", r"(?<![\w./-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/-]|\.\d)", date),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", ssn),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)", phone),
    ("phone", r"(?<![\w-])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?![\w-])", phone),
)
_MAILBOX = re.compile(r"[\w.+%-]{0,63}\w\Z")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
_SECRET = re.compile(
    r"(?i:\b(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|key)\b\s*[:=]\s*[\"']?)([0-9a-fA-F]{16,})(?![0-9A-Za-z])"
)
_PATTERNS = [(kind, re.compile(pattern), change) for kind, pattern, change in KINDS]
_DIGIT = re.compile(r"\d")

# Characters of an IBAN by country.
_IBAN_SIZES = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]*(?![A-Za-z0-9])")
_IBAN_GROUP = re.compile(r" [A-Z0-9]+(?![A-Za-z0-9])")
_IBAN_FOURS = re.compile(r"[A-Z0-9]{4}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
_DIGIT_RUN = re.compile(r"(?<!\d)[0-9](?:[ -]?[0-9]){12,}(?!\d)")
_DIGIT_GROUP = re.compile(r"[0-9]+")
_CARD_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4)}
#: First digits that card issuers use.
_CARD_ISSUERS = re.compile(r"[3-6]|2(?:2[2-9]|[3-6]|7[0-2])")
#: Numbers shorter than 16 digits are common outside cards, so their issuers are told more closely.
_SHORT_ISSUERS = {13: re.compile("4"), 14: re.compile("3(?:0[0-5]|[689])"), 15: re.compile("3[47]")}
#: A word for a card in a few languages, near in front of a number.
_CARD_WORD = re.compile(
    r"(?i)\b(?:(?:credit|debit|bank|kredit)?[ -]?(?:card|karte|carte|tarjeta|cart[aã]o|carta)|visa|mastercard|amex|"
    r"american express|discover|maestro|pan|kartennummer)\b\W*(?:\w+\W+){0,2}\Z"
)


def find_ibans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the valid IBANs between any two group boundaries, best first; they may overlap.

    Those of their country's length come first, then those of another length in groups of four; longer ones first.
    """
    found = []
    for m in _IBAN_START.finditer(text):
        start, group = m.start(), m
        size = 0
        while group and size <= 34:
            end = group.end()
            size += len(group[0].strip())
            listed = size == _IBAN_SIZES.get(text[start : start + 2])
            if 15 <= size <= 34 and (listed or _IBAN_FOURS.fullmatch(text, start, end)):
                plain = text[start:end].replace(" ", "")
                if f"{_iban_check(plain[:2], plain[4:]):02d}" == plain[2:4]:
                    found.append((not listed, -size, start, end))
            group = _IBAN_GROUP.match(text, end)
    return [f[2:] for f in sorted(found)]


def find_emails(text: str) -> list[tuple[int, int]]:
    """(start, end) of addresses, read outwards from each ``@``: a mailbox of at most 64 characters and a domain."""
    found = []
    at = text.find("@")
    while at >= 0:
        begin = max(0, at - 64)
        left, right = _MAILBOX.search(text[begin:at]), _DOMAIN.match(text, at + 1, at + 254)
        # A mailbox that goes on to the left is longer than any.
        if left and right and not (left.start() == 0 and begin and re.match(r"[\w.+-]", text[begin - 1])):
            found.append((begin + left.start(), right.end()))
        at = text.find("@", at + 1)
    return found


def find_cards(text: str) -> list[tuple[bool, int, int]]:
    """(usual layout, start, end) of the valid card numbers between any two group boundaries, best first; they may overlap.

    A number has to begin as an issuer's numbers do. It stands in one piece or in a layout printed on cards; any other
    cut across blanks counts only right behind a word for a card, as neighbouring numbers often complete a check sum by
    chance. Longer ones come first.
    """
    found = []
    for run in _DIGIT_RUN.finditer(text):
        groups = [m.span() for m in _DIGIT_GROUP.finditer(text, *run.span())]
        for i, (start, _) in enumerate(groups):
            if i == 0 and start and text[start - 1] in ".+-":
                continue
            digits, sizes, named = "", (), None
            for a, end in groups[i : i + 19]:
                digits += text[a:end]
                sizes += (end - a,)
                if len(digits) > 19:
                    break
                if len(digits) < 13 or not _SHORT_ISSUERS.get(len(digits), _CARD_ISSUERS).match(digits):
                    continue
                if luhn_digit(digits[:-1]) != digits[-1]:
                    continue
                if end == run.end() and re.match(r"-|\.\d", text[end : end + 2]):
                    continue
                marks = {c for c in text[start:end] if not c.isdigit()}
                usual = not marks or (len(marks) == 1 and sizes in _CARD_LAYOUTS)
                if not usual and named is None:
                    named = bool(_CARD_WORD.search(text[max(0, start - 40) : start]))
                if usual or named:
                    found.append((not usual, -len(digits), start, end))
    return [(not f[0], *f[2:]) for f in sorted(found)]


def find(text: str) -> list[tuple[int, int, str, Callable]]:
    """(start, end, kind, permutation) of what looks like personal data, in order of precedence; places may overlap.

    Earlier kinds take precedence over later ones; cards of unusual layout come last, as their digits can be those of a
    date and a phone number. Validation of the other kinds is left to the permutations.
    """
    out: list[tuple[int, int, str, Callable]] = []
    if "@" in text:
        out += [(start, end, "email", email) for start, end in find_emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(1), m.end(1), "secret", secret) for m in _SECRET.finditer(text)]
        out += [(start, end, "iban", iban) for start, end in find_ibans(text)]
        cards = find_cards(text)
        out += [(start, end, "card", card) for usual, start, end in cards if usual]
        for kind, pattern, change in _PATTERNS:
            out += [(m.start(), m.end(), kind, change) for m in pattern.finditer(text)]
        out += [(start, end, "card", card) for usual, start, end in cards if not usual]
    return out


@functools.lru_cache(maxsize=100_000)
def pseudonym(key: bytes, kind: str, change: Callable, value: str) -> str | None:
    return change(key, value)


def pseudonymise(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with each validated value replaced, and (kind, start, end) of the replacements in the new text."""
    chosen: list[tuple[int, int, str, str]] = []
    for start, end, kind, change in find(text):
        # Chosen places are in order and apart, so only the neighbours can overlap.
        place = bisect.bisect(chosen, (start,))
        if any(start < b and a < end for a, b, *_ in chosen[max(0, place - 1) : place + 1]):
            continue
        other = pseudonym(key, kind, change, text[start:end])
        if other is not None:
            chosen.insert(place, (start, end, kind, other))
    parts, spans, at, length = [], [], 0, 0
    for start, end, kind, other in chosen:
        parts += [text[at:start], other]
        length += start - at
        spans.append((kind, length, length + len(other)))
        length, at = length + len(other), end
    return "".join([*parts, text[at:]]), spans


_SPAN = T.StructType().add("kind", "string").add("start", "long").add("end", "long")
_FOUND = T.StructType().add("found", T.ArrayType(_SPAN))


def pseudonymise_text(
    df: DataFrame, key: bytes, text_col: str = "text", found_col: str = "found"
) -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced, and ``found_col``: array of (kind, start, end).

    Null texts stay null with an empty array. A column named like ``found_col`` is replaced.
    """
    ship(df.sparkSession)
    passed = [c for c in df.columns if c.lower() not in (text_col.lower(), found_col.lower())]
    names = [f"c{i}" for i in range(len(passed))]
    text = col(text_col).cast("string").alias("text")
    work = df.select(*[col(c).alias(n) for c, n in zip(passed, names, strict=True)], text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part in small_batches([batch], "text"):
                texts, found = [], []
                for value in part.column("text").to_pylist():
                    new, spans = (None, []) if value is None else pseudonymise(value, key)
                    texts.append(new)
                    found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                new_columns = [pa.array(texts, pa.string()), pa.array(found, pa.list_(span))]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *new_columns], [*names, "text", "found"])

    out = work.mapInArrow(run, T.StructType([*work.schema.fields, *_FOUND.fields]))
    back = dict(zip(passed, names, strict=True))
    columns = [F.col("text").alias(c) if c.lower() == text_col.lower() else F.col(back[c]).alias(c) for c in df.columns if c in back or c.lower() == text_col.lower()]
    return out.select(*columns, F.col("found").alias(found_col))
