"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Each kind of value is found by pattern, validated (checksums, ranges, calendar), and mapped by a keyed
bijection of its own format: a card number stays a card number with a right check digit, a date stays a
date, an address keeps its shape.  Equal values get equal pseudonyms in every document, so links survive;
different values of one format get different pseudonyms.  Where the way a value is read depends on what it
holds, the permutation is walked on until the image reads the same way, so every mapping can be undone.  Spellings
of one phone number, date, card or account number share their pseudonym.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import math
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mailtriage.llm.common import column_of, documents, text_groups, texts_of

ROUNDS = 10
#: Longer strings are permuted half against half, character by character, instead of as one number.
LONG_STRING = 1024
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = ("0123456789abcdef", "0123456789ABCDEF")

# How the kinds are written, in order of precedence.
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}",
    "key_id": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "secret": r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b)(?P<sign>\"?'?\s{0,3}[=:]\s{0,3}[\"']?)(?P<value>[A-Za-z0-9+/_-]{8,})",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}|:):[0-9A-Fa-f:]{3,36}(?<!:)(?![\w:]|\.\d)",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "date": r"(?<![\w-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "phone": (
        r"(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-])"
        r"|(?<![\w.])\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?![\w-])"
        r"|(?<![\w.])(?<!\d[ -])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]|[ .]\d)"
        r"|(?<![\w.])\+\d{8,15}(?!\w)"
    ),
}
# How many characters the account numbers of a country have.
IBAN_LENGTHS = {code: int(n) for n, codes in {
    "15": "NO", "16": "BE", "18": "DK FI FK FO GL NL SD", "19": "MK SI", "20": "AT BA EE KZ LT LU MN XK",
    "21": "CH HR LI LV", "22": "BG BH CR DE GB GE IE ME RS VA", "23": "AE GI IL IQ OM SO TL",
    "24": "AD CZ ES MD PK RO SA SE SK TN VG", "25": "LY PT ST", "26": "IS TR", "27": "BI DJ FR GR IT MC SM",
    "28": "AL AZ BY CY DO GT HN HU LB NI PL SV", "29": "BR EG PS QA UA", "30": "JO KW MU YE", "31": "MT SC", "32": "LC",
    "33": "RU",
}.items() for code in codes.split()}
# Calling codes of one and two digits; all others have three.
CALLING_CODES = (
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51",
    "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92",
    "93", "94", "95", "98",
)
FINDERS = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
# What a text must hold before a pattern is tried.
NEEDS = {"email": re.compile("@"), "key_id": re.compile("AKIA|ASIA"), "secret": re.compile("[=:]"), "ipv6": re.compile(":"), "digits": re.compile(r"\d")}
KINDS = tuple(PATTERNS)
OUT = "doc_id long, text string, n_found long, found array<struct<kind:string,start:int,length:int>>"


class Feistel:
    """Keyed bijections of range(size), one for each size and tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, step: int, value: int) -> int:
        said = f"{tweak}|{step}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=32).digest(), "big")

    def permute(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """Alternating additions over an a x b rectangle that covers the range; steps outside are walked on."""
        if size < 2:
            return value
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(value, b)
            for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if step % 2:
                    right = (right + sign * self._round(tweak, step, left)) % b
                else:
                    left = (left + sign * self._round(tweak, step, right)) % a
            value = left * b + right
            if value < size:
                return value

    def spell(self, text: str, tweak: str, alphabets: tuple[str, ...] = CLASSES, back: bool = False) -> str:
        """Permute a string among those with the same kinds of character at the same places."""
        if len(text) > LONG_STRING:
            return self._spell_long(text, tweak, alphabets, back)
        held = [next((s for s in alphabets if c in s), None) for c in text]
        value, size = 0, 1
        for c, symbols in zip(text, held):
            if symbols:
                value, size = value * len(symbols) + symbols.index(c), size * len(symbols)
        value, out = self.permute(value, size, f"{tweak}{size}", back), []
        for c, symbols in zip(reversed(text), reversed(held)):
            if symbols:
                value, at = divmod(value, len(symbols))
                c = symbols[at]
            out.append(c)
        return "".join(reversed(out))

    def spell_among(self, text: str, tweak: str, alphabets: tuple[str, ...], member: Callable[[str], bool], back: bool = False) -> str:
        """Permute ``text``, itself a member, among the strings of its format that are: others are walked past."""
        while True:
            text = self.spell(text, tweak, alphabets, back)
            if member(text):
                return text

    def _spell_long(self, text: str, tweak: str, alphabets: tuple[str, ...], back: bool) -> str:
        """The same for long strings in linear time: the halves are shifted in turn by a stream keyed by the other."""
        kinds = {c: (k, i) for k, symbols in reversed(list(enumerate(alphabets))) for i, c in enumerate(symbols)}
        at = [i for i, c in enumerate(text) if c in kinds]
        kind, value = np.array([kinds[text[i]] for i in at], np.int64).reshape(-1, 2).T
        size = np.array([len(symbols) for symbols in alphabets])[kind]
        half = len(at) // 2
        sides = [(value[:half].copy(), size[:half]), (value[half:].copy(), size[half:])]
        for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
            (moved, sizes), (other, _) = sides[step % 2], sides[1 - step % 2]
            said = f"{tweak}{len(at)}|{step}|".encode() + other.astype("u1").tobytes()
            seed = hashlib.blake2b(said, key=self.key, digest_size=32).digest()
            stream = np.frombuffer(hashlib.shake_256(seed).digest(4 * len(moved)), "<u4").astype(np.int64)
            moved[:] = (moved - stream if back else moved + stream) % sizes
        out = list(text)
        for i, k, v in zip(at, kind.tolist(), np.concatenate([sides[0][0], sides[1][0]]).tolist()):
            out[i] = alphabets[k][v]
        return "".join(out)


def luhn_digit(digits: str) -> str:
    """The digit that makes ``digits`` plus it pass the Luhn test."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its letters and digits replaced in order, separators kept."""
    source = iter(digits)
    return "".join(next(source) if c.isalnum() else c for c in pattern)


def _email(f: Feistel, found: str, back: bool) -> str:
    name, _, top = found.rpartition(".")
    return f"{f.spell(name, 'email', back=back)}.{top}"


def _key_id(f: Feistel, found: str, back: bool) -> str:
    narrow = not re.search("[0189]", found[4:])
    alphabet = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",) if narrow else (CLASSES[2] + CLASSES[0],)
    return found[:4] + f.spell_among(found[4:], "key", alphabet, lambda s: narrow == (not re.search("[0189]", s)), back)


def _alphabets(value: str) -> tuple[str, ...]:
    """What the characters of a secret may become: hexadecimal ones stay so, and stay without digits if they are."""
    held = set(value)
    return next(((s,) for digits in HEX for s in (digits[10:], digits) if held <= set(s)), CLASSES)


def _secret(f: Feistel, found: str, back: bool) -> str:
    alphabets = _alphabets(found)
    return f.spell_among(found, "secret", alphabets, lambda s: _alphabets(s) == alphabets, back)


def _iban(f: Feistel, found: str, back: bool) -> str | None:
    plain = found.replace(" ", "")
    if iban_check(plain[:2], plain[4:]) != plain[2:4]:
        return None
    rest = f.spell(plain[4:], "iban", back=back)
    return _refill(found, plain[:2] + iban_check(plain[:2], rest) + rest)


def _ip(f: Feistel, found: str, back: bool) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255 or any(p != str(int(p)) for p in found.split(".")):
        return None
    value = f.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip", back)
    return ".".join(str(b) for b in value.to_bytes(4, "big"))


def _ipv6(f: Feistel, found: str, back: bool) -> str | None:
    """All spellings of an address get one pseudonym, in canonical spelling."""
    try:
        value = int(ipaddress.IPv6Address(found))
    except ValueError:
        return None
    if not _reads_as_ipv6(value):
        return None
    while True:
        value = f.permute(value, 1 << 128, "ipv6", back)
        if _reads_as_ipv6(value):
            return str(ipaddress.IPv6Address(value))


def _reads_as_ipv6(value: int) -> bool:
    """Whether the canonical spelling is taken for an address: with a digit and more than a scoped name holds."""
    text = str(ipaddress.IPv6Address(value))
    return any(c.isdigit() for c in text) and FINDERS["ipv6"].fullmatch(text) is not None


def _date(f: Feistel, found: str, back: bool) -> str | None:
    """Day-month order wherever it is a date, month-day otherwise; years 1900 to 2099.  All spellings of a day get the
    same new day; days up to the 12th are permuted among themselves, so that an order is read as it was written."""
    mark = next(c for c in found if not c.isdigit())
    parts = found.split(mark)
    for order in ("ymd",) if len(parts[0]) == 4 else ("dmy", "mdy"):
        read = dict(zip(order, map(int, parts)))
        try:
            day = dt.date(read["y"], read["m"], read["d"])
        except ValueError:
            continue
        if FIRST_DAY <= day.toordinal() <= LAST_DAY:
            new = _day(f, day, back)
            shown = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
            return mark.join(shown[c] for c in order)
    return None


def _day(f: Feistel, day: dt.date, back: bool) -> dt.date:
    new = day
    while True:
        value = f.permute(new.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", back)
        new = dt.date.fromordinal(FIRST_DAY + value)
        if (new.day > 12) == (day.day > 12):
            return new


def _ssn(f: Feistel, found: str, back: bool) -> str | None:
    area, group, serial = (int(p) for p in found.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    value = f.permute(value, len(areas) * 99 * 9999, "ssn", back)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _card(f: Feistel, found: str, back: bool) -> str | None:
    digits = "".join(c for c in found if c.isdigit())
    if luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = f.spell(digits[:-1], "card", back=back)
    return _refill(found, body + luhn_digit(body))


def _phone(f: Feistel, found: str, back: bool) -> str | None:
    """The country code stays, the other digits are permuted, whatever stands between them; 7 to 15 digits in all."""
    digits = "".join(c for c in found if c.isdigit())
    if not 7 <= len(digits) <= 15:
        return None
    code = next((c for c in CALLING_CODES if digits.startswith(c)), digits[:3]) if found[0] == "+" else ""
    return _refill(found, code + f.spell(digits[len(code) :], f"phone{code}", back=back))


RULES: dict[str, Callable[[Feistel, str, bool], str | None]] = {
    "email": _email, "key_id": _key_id, "secret": _secret, "iban": _iban, "ipv6": _ipv6, "ip": _ip, "date": _date, "ssn": _ssn,
    "card": _card, "phone": _phone,
}


def _iban_end(found: str) -> int:
    """Where the account number at the start of ``found`` ends: at the length of its country or with all groups,
    whichever passes the checksum first; 0 if none does.  A word or number behind it is not part of it."""
    ends = [m.start() for m in re.finditer(r" |$", found)]
    ends.sort(key=lambda end: (len(found[:end].replace(" ", "")) != IBAN_LENGTHS.get(found[:2]), -end))
    for end in dict.fromkeys([ends[0], len(found)]):
        plain = found[:end].replace(" ", "")
        if len(plain) > 4 and iban_check(plain[:2], plain[4:]) == plain[2:4]:
            return end
    return 0


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Valid account numbers; the search goes on right behind each, and at the next word after a failed one."""
    at = 0
    while m := FINDERS["iban"].search(text, at):
        end = _iban_end(m.group())
        if end:
            yield m.start(), m.start() + end
        at = m.start() + (end or 1)


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    """Values with a digit; those without one only if directly assigned or quoted, since prose is not."""
    for m in FINDERS["secret"].finditer(text):
        if m["sign"].lstrip("\"'") == "=" or m["sign"][-1] in "\"'" or any(c.isdigit() for c in m["value"]):
            yield m.span("value")


def replace(f: Feistel, text: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """Pseudonymised text and (kind, start, length) of what was replaced, as code points of the input.

    Finds of one kind come in order and do not overlap, so each kind is held against those before it in one sweep.
    """
    digits = NEEDS["digits"].search(text) is not None
    taken: list[tuple[int, int, str, str]] = []
    for kind, finder in FINDERS.items():
        if not (NEEDS[kind].search(text) if kind in NEEDS else digits):
            continue
        spans = (_ibans(text) if kind == "iban" else _secrets(text) if kind == "secret" else (m.span() for m in finder.finditer(text)))
        fresh, at = [], 0
        for start, end in spans:
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if at < len(taken) and taken[at][0] < end:
                continue
            new = RULES[kind](f, text[start:end], back)
            if new is not None:
                fresh.append((start, end, kind, new))
        taken = sorted(taken + fresh)
    out, at = [], 0
    for start, end, _, new in taken:
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:], [(kind, start, end - start) for start, end, kind, _ in taken]


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, n_found, and found: kind, start and length in the input text.

    One row per input row, whole texts; row-local, nothing is shuffled.  Null and empty texts become empty
    with nothing found; null ids and repeated rows are kept; an empty table gives no rows.  Values that fail
    their check (card or IBAN checksum, octets above 255, dates that do not exist) stay as they are, unless
    they are valid as a later kind.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, kind = Feistel(key), pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())])
        for batch in text_groups(batches):
            texts, found = zip(*(replace(f, text) for text in texts_of(batch)))
            spans = [[{"kind": k, "start": s, "length": n} for k, s, n in row] for row in found]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), pa.array(texts, pa.string()), pa.array([len(r) for r in found], pa.int64()),
                 pa.array(spans, pa.list_(kind))], ["doc_id", "text", "n_found", "found"])

    return documents(docs, id_col, text_col).mapInArrow(run, OUT)


def hide(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in its text column, the other columns as they are.

    One row per input row: null and empty texts stay as they are, repeated rows and null ids are kept, an empty
    table gives no rows.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t if t is None else replace(f, t)[0] for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)

