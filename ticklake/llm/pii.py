"""Personal data replaced by format-preserving Feistel pseudonyms.

A found value is validated (Luhn, MOD-97, calendar, number plans), turned into
a number within the set of all valid values of its format, permuted there by
a keyed Feistel network (walked on until the result is in the set), and
written back in the same format.  It is a permutation with one key for the
whole corpus: equal values get equal pseudonyms in every document, different
values different ones, and who has the key can undo it.

Spark tests for candidate characters first, so only texts that can hold
a value reach the Python workers.  Rows are independent: no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import handing_back

ROUNDS = 10
#: Symbols that are permuted as one number; longer values in pieces.
PIECE = 64
#: Dates are permuted within these years.
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
#: A text without any of these holds no value that is looked for.
CANDIDATE = "[0-9@=:]|AKIA|ASIA"

# Alphabets, and lengths of an IBAN.
DIGITS, HEX = "0123456789", "0123456789abcdef"
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
IBAN_LENGTHS = range(15, 35)
#: By country, as registered.
IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


class Feistel:
    """Keyed permutations of range(size), one for each tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int, side: int) -> int:
        data = b"%d|%d|%d|" % (i, side, half) + tweak
        return int.from_bytes(hashlib.blake2b(data, key=self.key).digest(), "big") % side

    def permute(self, value: int, size: int, tweak: bytes, back: bool = False) -> int:
        if size < 2:
            return value
        side = math.isqrt(size - 1) + 1  # a square that holds the range
        tweak = b"%s|%d" % (tweak, size)
        while True:  # less than 2 * side + 1 values lie outside: few walks
            left, right = divmod(value, side)
            if not back:
                for i in range(ROUNDS):
                    left, right = right, (left + self._round(tweak, i, right, side)) % side
            else:
                for i in reversed(range(ROUNDS)):
                    left, right = (right - self._round(tweak, i, left, side)) % side, left
            value = left * side + right
            if value < size:
                return value

    def digits(self, values: list[int], radices: list[int], tweak: bytes, back: bool = False) -> list[int]:
        """Permute a sequence whose i-th symbol is in range(radices[i])."""
        out = []
        for at in range(0, len(values), PIECE):
            part = radices[at : at + PIECE]
            number = 0
            for v, r in zip(values[at : at + PIECE], part):
                number = number * r + v
            number = self.permute(number, math.prod(part), tweak + b"|%d|" % at + b",".join(b"%d" % r for r in part), back)
            symbols = []
            for r in reversed(part):
                number, v = divmod(number, r)
                symbols.append(v)
            out += symbols[::-1]
        return out

    def symbols(self, text: str, tweak: bytes, back: bool = False, alphabets: tuple[str, ...] = (DIGITS, LOWER, UPPER)) -> str:
        """Permute the symbols that are in an alphabet, each within its own;
        all others stay where they are."""
        at = [(i, a) for i, c in enumerate(text) for a in alphabets if c in a]
        new = self.digits([a.index(text[i]) for i, a in at], [len(a) for _, a in at], tweak, back)
        out = list(text)
        for (i, a), v in zip(at, new):
            out[i] = a[v]
        return "".join(out)


def _fill(shape: str, digits: str) -> str:
    """`shape` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c in DIGITS else c for c in shape)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def luhn_digit(digits: str) -> str:
    """The check digit to append."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _luhn_valid(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn_digit(digits[:-1]) == digits[-1]


def mod97(text: str) -> int:
    """ISO 7064 MOD 97-10 of letters and digits."""
    return int("".join(str(int(c, 36)) for c in text)) % 97


# Each takes (match, permutations, back) and returns the pseudonym, or None if
# the value isn't valid and stays.  Days and months are written with two digits.


def _card(m: re.Match, f: Feistel, back: bool) -> str | None:
    d = new = _only_digits(m.group())
    if not _luhn_valid(d):
        return None
    while True:  # about ten walks
        body = d[0] + f.symbols(new[1:-1], b"card" + d[0].encode(), back)  # the first digit, its network, stays
        new = body + luhn_digit(body)
        # so does the check digit that a longer number would need: with digits behind it the card is found again
        if luhn_digit(new) == luhn_digit(d):
            return _fill(m.group(), new)


def _phone(m: re.Match, f: Feistel, back: bool) -> str | None:
    area, office, line = m["area"], m["office"], m["line"]
    d = [int(c) for c in area + office + line]
    lows = [2, 0, 0, 2, 0, 0, 0, 0, 0, 0]  # area and office begin with 2 to 9
    new = f.digits([v - low for v, low in zip(d, lows)], [10 - low for low in lows], b"phone", back)
    digits = "".join(str(v + low) for v, low in zip(new, lows))
    start = m.start("area") - m.start()
    return m.group()[:start] + _fill(m.group()[start:], digits)


def _phone_in_full(m: re.Match, f: Feistel, back: bool) -> str | None:
    """Of area and office at least one begins with 0 or 1, and then too."""
    start, digits = m.start("number") - m.start(), _only_digits(m["number"])
    while True:  # about three walks
        digits = f.symbols(digits, b"phone in full", back)
        if digits[0] in "01" or digits[3] in "01":
            return m.group()[:start] + _fill(m["number"], digits)


def _ssn(m: re.Match, f: Feistel, back: bool) -> str | None:
    area, group, serial = (int(x) for x in m.group().split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    area, group, serial = f.digits([area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999], b"ssn", back)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv4(m: re.Match, f: Feistel, back: bool) -> str | None:
    octets = [int(x) for x in m.group().split(".")]
    if max(octets) > 255:
        return None
    return ".".join(map(str, f.digits(octets, [256] * 4, b"ipv4", back)))


def _iban(m: re.Match, f: Feistel, back: bool) -> str | None:
    plain = m.group().replace(" ", "")
    if not _iban_valid(plain):
        return None
    body = f.symbols(plain[4:], b"iban" + plain[:2].encode(), back)
    new = iter(plain[:2] + f"{98 - mod97(body + plain[:2] + '00'):02d}" + body)
    return "".join(c if c == " " else next(new) for c in m.group())


def _iban_valid(plain: str) -> bool:
    return len(plain) in IBAN_LENGTHS and mod97(plain[4:] + plain[:4]) == 1


def _ends(m: re.Match, marks: str) -> list[int]:
    """Where groups of the match end, last first."""
    return [m.end(), *(i for i in range(m.end() - 1, m.start(), -1) if m.string[i] in marks)]


def _ibans(pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """Valid IBANs.  What follows may look like a part of one: of a country
    with a fixed length that length is tried first and then all of the match,
    of others each end of a group, the last first.  If none is valid the search
    goes on with the next group."""
    at = 0
    while m := pattern.search(text, at):
        at = _next_group(text, m.start())
        ends = _ends(m, " ")
        if length := IBAN_LENGTH.get(m.group()[:2]):
            ends = [e for e in ends if len(text[m.start() : e].replace(" ", "")) == length] + ends[:1]
        for end in ends:
            if _iban_valid(text[m.start() : end].replace(" ", "")):
                yield pattern.fullmatch(text, m.start(), end)
                at = end
                break


def _next_group(text: str, at: int) -> int:
    return m.end() if (m := _GROUP.match(text, at)) else len(text)


def _cards(pattern: re.Pattern, text: str) -> Iterator[re.Match]:
    """Valid cards in runs of digit groups, from each group on the longest
    first: those in one group or grouped as cards are, then those in other
    groups of four digits or more.  Smaller groups, as in tables of numbers,
    count only as a whole match."""
    starts, ends = [], []  # of the cards taken, in the order of the text: they don't overlap

    def take(start: int, end: int) -> bool:
        after = bisect_right(ends, start)  # the first card that ends behind the start
        if after < len(starts) and starts[after] < end or not _luhn_valid(_only_digits(text[start:end])):
            return False
        starts.insert(after, start)
        ends.insert(after, end)
        return True

    for shape in _CARD_SHAPES:
        at = 0
        while m := pattern.search(text, at):
            at = _next_group(text, m.start())
            for end in _ends(m, " -"):
                if shape.fullmatch(text, m.start(), end) and take(m.start(), end):
                    at = end
                    break
    for m in pattern.finditer(text):
        take(*m.span())
    return (pattern.fullmatch(text, *span) for span in zip(starts, ends))


def _date(m: re.Match, f: Feistel, back: bool) -> str | None:
    a, b, c = (int(x) for x in re.split(r"[-./]", m.group()))
    year_first = a > 99
    y, month, day = (a, b, c) if year_first else (c, b, a) if "/" not in m.group() or a > 12 else (c, a, b)
    try:
        number = date(y, month, day).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= number <= LAST_DAY - FIRST_DAY:
        return None
    # month/day/year; day/month/year is read so only if the day is over 12, and keeps to such days
    month_first = "/" in m.group() and not year_first and a <= 12
    if "/" not in m.group() or year_first or month_first:
        new = date.fromordinal(FIRST_DAY + f.permute(number, LAST_DAY - FIRST_DAY + 1, b"date", back))
    elif day <= 28:
        months, days = f.digits([(y - 1900) * 12 + month - 1, day - 13], [2400, 16], b"day first", back)
        new = date(1900 + months // 12, months % 12 + 1, days + 13)
    else:
        years = [v for v in range(1900, 2100) if _valid(v, month, day)]
        new = date(years[f.permute(years.index(y), len(years), b"late day|%d|%d" % (month, day), back)], month, day)
    parts = (new.year, new.month, new.day) if year_first else (new.month, new.day, new.year) if month_first else (new.day, new.month, new.year)
    marks = re.findall(r"[-./]", m.group())
    texts = [f"{v:02d}" for v in parts]
    return texts[0] + marks[0] + texts[1] + marks[1] + texts[2]


def _valid(y: int, month: int, day: int) -> bool:
    try:
        date(y, month, day)
    except ValueError:
        return False
    return True


def _email(m: re.Match, f: Feistel, back: bool) -> str | None:
    local, _, domain = m.group().rpartition("@")
    return f.symbols(local, b"email|" + domain.lower().encode(), back) + "@" + domain


def _access_key(m: re.Match, f: Feistel, back: bool) -> str | None:
    return m.group()[:4] + f.symbols(m.group()[4:], b"access key", back, (DIGITS + UPPER,))


def _secret(m: re.Match, f: Feistel, back: bool) -> str | None:
    value = m["value"]
    is_hex = all(c in HEX for c in value)
    new = f.symbols(value, b"hex" if is_hex else b"secret", back, (HEX,) if is_hex else (DIGITS, LOWER, UPPER))
    return m.group()[: m.start("value") - m.start()] + new


#: Kind, pattern, replacement; of overlapping values the first to begin wins, then the first kind here.
KINDS: list[tuple[str, re.Pattern, Callable]] = [
    ("secret", re.compile(r"\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b\s*[=:]\s*[\"']?(?P<value>[A-Za-z0-9+/_-]{6,})", re.I), _secret),
    ("access_key", re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"), _access_key),
    ("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}\b"), _email),
    ("iban", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b"), _iban),
    ("card", re.compile(r"(?:(?<![\w.+-])|(?<=[0-9]-))[0-9](?:[ -]?[0-9]){12,18}(?!\w|-(?![0-9]))"), _card),
    ("ssn", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), _ssn),
    (
        "phone",
        re.compile(r"(?<![\w+-])(?:\+?1[ .-]?)?\(?(?P<area>[2-9][0-9]{2})(?:\) ?|[ .-])(?P<office>[2-9][0-9]{2})[ .-](?P<line>[0-9]{4})(?![\w-])"),
        _phone,
    ),
    (
        "phone",
        re.compile(r"(?<![\w+-])\+1[ .-]?\((?![2-9][0-9]{2}\) ?[2-9])(?P<number>[0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4})(?![\w-])"),
        _phone_in_full,
    ),
    ("ipv4", re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])"), _ipv4),
    ("date", re.compile(r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4})(?![\w/-]|\.[0-9])"), _date),
]

#: What a text must hold for a kind's pattern to be tried; kinds not named need a digit.
_NEEDS = {"email": ("@",), "access_key": ("AKIA", "ASIA"), "secret": ("=", ":")}
_DIGIT = re.compile(r"[0-9]")
_GROUP = re.compile(r"[A-Za-z0-9]+")
_CARD_SHAPES = [
    re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:(?<=[0-9]{4})\1[0-9]{1,3})?|[0-9]{6}\1[0-9]{4,5}|[0-9]{3}\1[0-9]{3}\1[0-9]{3})"),
    re.compile(r"[0-9]{4,}(?:[ -][0-9]{4,})*(?:[ -][0-9]{1,3})?"),
]
#: Kinds of which a match may hold too much or too little: valid values in a text.
_SEARCH = {"iban": _ibans, "card": _cards}


def pseudonymized(text: str, f: Feistel, back: bool = False) -> tuple[str, Counter]:
    """The text with all found values replaced, and how many of each kind."""
    has_digit = _DIGIT.search(text) is not None
    found = []
    for order, (kind, pattern, replace) in enumerate(KINDS):
        if any(x in text for x in _NEEDS[kind]) if kind in _NEEDS else has_digit:
            matches = _SEARCH[kind](pattern, text) if kind in _SEARCH else pattern.finditer(text)
            found += [(m.start(), order, m, kind, replace) for m in matches]
    out, at, counts = [], 0, Counter()
    for start, _, m, kind, replace in sorted(found, key=lambda x: x[:2]):
        if start >= at and (new := replace(m, f, back)) is not None:
            out += [text[at:start], new]
            at = m.end()
            counts[kind] += 1
    return "".join([*out, text[at:]]), counts


def without_personal_data(docs: DataFrame, key: bytes, text_col: str = "text", found: str = "found", back: bool = False) -> DataFrame:
    """`docs` with pseudonyms in `text_col`, and a map column `found` of the
    number of values replaced by kind (empty if none).

    A null text stays null, an empty one empty; values that fail validation
    stay as they are; repeated rows give equal results; a column named as
    `found` is replaced, other columns pass through.  `back` undoes it.
    """

    @F.pandas_udf("text string, found map<string,int>")
    @handing_back
    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = Feistel(key)
        for texts in batches:
            done = [(None, {}) if t is None else pseudonymized(t, f, back) for t in texts]
            yield pd.DataFrame({"text": [t for t, _ in done], "found": [dict(c) for _, c in done]})

    kept = [c for c in docs.columns if c not in (found, "__new")]
    text = F.col(f"`{text_col}`")
    # texts that can't hold a value aren't sent to Python
    out = docs.withColumn("__new", replace(F.when(text.rlike(CANDIDATE), text)))
    new = {text_col: F.coalesce(F.col("__new.text"), text)}
    return out.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in kept], F.col("__new.found").alias(found))
