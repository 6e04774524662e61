"""Format-preserving pseudonyms for personal data by a keyed Feistel network.

A value found is checked (Luhn for card numbers, the mod-97 rule for account
numbers, ranges for addresses, dates and social security numbers) and then
permuted within its own format: digits become digits, letters letters of the
same case, separators stay, check digits are right again, a date becomes
another valid date written the same way. The permutation depends on the key,
the kind of value and its length only, so equal values get equal pseudonyms in
all documents, however they are written, and unequal ones stay unequal.

Nothing is looked up and nothing shuffled; every task works alone.

Defined cases: null text stays null; texts without such values are returned
as they are; repeated rows are treated alike; an empty table gives an empty
result; other columns are ignored. Letters and digits are ASCII ones: what other
scripts write as digits, or letters that only fold to ASCII, are part of no
value. Numbers that fail their check are no personal data and stay; a candidate that fails is first tried shorter, then as
the later kinds, and the search goes on at its next character.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opticart.llm.common import ship

ROUNDS = 10
DEMO_KEY = b"replace this key in production"
KINDS = ("email", "secret", "iban", "ip", "card", "phone", "ssn", "date")

DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
MONTHS = ("January February March April May June July August September October November "
          "December").split()


# Lengths of account numbers by country (ISO 13616 registry).
IBAN_LENGTH = {country: int(n) for n, countries in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
    "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL,TN "
    "24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC "
    "32:LC 33:RU").split()) for country in countries.split(",")}


def _draw(key: bytes, tweak: str, round_no: int, value: int, modulus: int) -> int:
    h = hashlib.blake2b(f"{tweak}|{round_no}|{value}".encode(), key=key[:64], digest_size=24)
    return int.from_bytes(h.digest(), "big") % modulus


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of the numbers below ``size``.

    An unbalanced Feistel network over the least a * b >= size; values that
    leave the range walk on until they are back inside.
    """
    if size < 2:
        return value
    a = 1
    while a * a < size:
        a += max(1, a // 64) if a > 4096 else 1
    if size > 1 << 24:
        a = 1 << ((size - 1).bit_length() + 1) // 2
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for r in range(ROUNDS):
            if r % 2:
                right = (right + _draw(key, tweak, r, left, b)) % b
            else:
                left = (left + _draw(key, tweak, r, right, a)) % a
        value = left * b + right
        if value < size:
            return value


def permute_chars(text: str, key: bytes, tweak: str) -> str:
    """Each ASCII digit and letter permuted within its own alphabet; the rest stays."""
    value, size = 0, 1
    sets = []
    for c in text:
        alphabet = (DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER
                    else None)
        sets.append(alphabet)
        if alphabet:
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    shape = "".join("9" if s is DIGITS else "a" if s is LOWER else "A" if s is UPPER else c
                    for c, s in zip(text, sets))
    value = permute(value, size, key, f"{tweak}|{shape}")
    out = []
    for c, alphabet in zip(reversed(text), reversed(sets)):
        if alphabet:
            value, i = divmod(value, len(alphabet))
            c = alphabet[i]
        out.append(c)
    return "".join(reversed(out))


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in DIGITS else c for c in shape)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def luhn(digits: str) -> int:
    """The check sum; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10


def card(text: str, key: bytes) -> str | None:
    digits = _only_digits(text)
    if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
        return None
    body = f"{permute(int(digits[:-1]), 10 ** (len(digits) - 1), key, f'card|{len(digits)}'):0{len(digits) - 1}d}"
    return _refill(text, body + str(-luhn(body + "0") % 10))


def phone(text: str, key: bytes) -> str | None:
    """All digits but a leading country code."""
    code = re.match(r"\+[0-9]{1,3}(?=[ (.-])", text)
    head = code[0] if code else ""
    rest = text[len(head):]
    digits = _only_digits(rest)
    marked = head or "(" in text or text[0] == "+"
    if not (7 if marked else 10) <= len(digits) <= 14:
        return None
    n = permute(int(digits), 10 ** len(digits), key, f"phone|{len(digits)}")
    return head + _refill(rest, f"{n:0{len(digits)}d}")


def ip(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    n = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(str(x) for x in n.to_bytes(4, "big"))


def ssn(text: str, key: bytes) -> str | None:
    """Valid areas (not 000, 666 or 900 and up), groups and serials map to such."""
    area, group, serial = (int(x) for x in text.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    n = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    n = permute(n, 898 * 99 * 9999, key, "ssn")
    n, serial = divmod(n, 9999)
    area, group = divmod(n, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


def iban(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or len(plain) != IBAN_LENGTH.get(plain[:2].upper(), len(plain)):
        return None
    as_number = int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4]))
    if as_number % 97 != 1:
        return None
    body = permute_chars(plain[4:], key, "iban|" + plain[:2])
    check = 98 - int("".join(str(int(c, 36)) for c in body + plain[:2] + "00")) % 97
    it = iter(plain[:2] + f"{check:02d}" + body)
    return "".join(" " if c == " " else next(it) for c in text)


def email(text: str, key: bytes) -> str | None:
    """The name and the host's labels but the last two; the domain stays readable."""
    name, _, host = text.partition("@")
    labels = host.split(".")
    kept = ".".join(labels[-2:])
    front = text[:len(text) - len(kept)].lower()
    return permute_chars(front, key, "email|" + kept.lower()) + kept


def secret(text: str, key: bytes) -> str | None:
    """A token's value after its name: hexadecimal stays hexadecimal."""
    value = re.search(r"[A-Za-z0-9_\-+/=.]{16,}(?=[\"']?\Z)", text)
    if value is None:
        return None
    body = value[0]
    if re.fullmatch(r"[0-9a-fA-F]+", body):
        new = f"{permute(int(body, 16), 16 ** len(body), key, f'hex|{len(body)}'):0{len(body)}x}"
        new = new.upper() if body.upper() == body and body.lower() != body else new
    else:
        new = permute_chars(body, key, "token")
    return text[:value.start()] + new + text[value.end():]


def _day(year: int, month: int, day: int) -> int | None:
    try:
        n = dt.date(year, month, day).toordinal()
    except ValueError:
        return None
    return n if FIRST_DAY <= n <= LAST_DAY else None


def date(text: str, key: bytes) -> str | None:
    """A date in digits or with an English month; its order and separators stay."""
    order, fields = None, re.findall(r"[0-9]+|[A-Za-z]+", text)
    if len(fields) != 3:
        return None
    named = [f for f in fields if f.isalpha()]
    if named:
        month = [i for i, m in enumerate(MONTHS, 1) if m[:3].lower() == named[0][:3].lower()]
        if not month:
            return None
        numbers = [int(f) for f in fields if not f.isalpha()]
        order, values = "named", (numbers[1], month[0], numbers[0])
    elif len(fields[0]) == 4:
        order, values = "ymd", (int(fields[0]), int(fields[1]), int(fields[2]))
    else:  # day first unless only month first is a date
        order, values = "dmy", (int(fields[2]), int(fields[1]), int(fields[0]))
        if _day(*values) is None or ("/" in text and int(fields[0]) <= 12):
            order, values = "mdy", (int(fields[2]), int(fields[0]), int(fields[1]))
    n = _day(*values)
    if n is None:
        return None
    new = dt.date.fromordinal(FIRST_DAY + permute(n - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key,
                                                  "date"))
    short = named and len(named[0]) == 3

    def field(old: str, value: int, width: int) -> str:
        return f"{value:0{width}d}" if old[0] == "0" or len(old) == width else str(value)

    parts = []
    numbers_left = {"ymd": [new.year, new.month, new.day], "dmy": [new.day, new.month, new.year],
                    "mdy": [new.month, new.day, new.year], "named": [new.day, new.year]}[order]
    for f in fields:
        if f.isalpha():
            month_name = MONTHS[new.month - 1]
            parts.append(month_name[:3] if short else month_name)
        else:
            value = numbers_left.pop(0)
            parts.append(field(f, value, 4 if value > 31 else 2))
    return "".join(x + y for x, y in zip(parts, re.split(r"[0-9]+|[A-Za-z]+", text)[1:]))


_MONTH = "(?ai:" + "|".join(m if len(m) < 4 else f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + ")"
_KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": r"\b(?ai:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key|auth[_-]?key)"
              r"\s{0,3}[=:]\s{0,3}(?:\"[A-Za-z0-9_\-+/=.]{16,}\"|'[A-Za-z0-9_\-+/=.]{16,}'"
              r"|[A-Za-z0-9_\-+/=.]{16,})",
    "iban": r"\b[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]{4}){2,7}(?: ?[A-Za-z0-9]{1,3})?\b",
    "date": r"(?<![\w.-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
            r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}"
            rf"|[0-9]{{1,2}} {_MONTH} [0-9]{{4}}|{_MONTH} [0-9]{{1,2}}, [0-9]{{4}})(?![\w-]|\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])",
    "card": r"(?:(?<![\w.-])|(?<=[0-9]-))[0-9](?:[ -]?[0-9]){12,18}(?!\w|-(?![0-9])|\.[0-9])",
    "phone": r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"
             r"(?![\w-]|\.[0-9])|(?<![\w.])\+[0-9]{8,14}(?!\w)",
}
_FIND = re.compile("|".join(f"(?P<{kind}>{body})" for kind, body in _KINDS.items()))
_ONE = {kind: re.compile(body) for kind, body in _KINDS.items()}
_ORDER = list(_KINDS)
# A part of a failed candidate that is written like a card number: whole or in
# groups of four and more, with a first digit that card issuers have.
_GROUPED = re.compile(r"(?=[3-6]|2[2-7])[0-9]{4,}(?:[ -][0-9]{4,})*(?:[ -][0-9]{1,3})?")
_MAKE = {"email": email, "secret": secret, "iban": iban, "ip": ip, "card": card, "phone": phone,
         "ssn": ssn, "date": date}
_HINT = re.compile(r"[0-9@]|token|secret|passw|pwd|key", re.I | re.A)


@lru_cache(maxsize=1 << 16)
def pseudonym(kind: str, text: str, key: bytes) -> str | None:
    """The pseudonym of a value, or None if it fails the kind's check."""
    return _MAKE[kind](text, key)


def _ends(kind: str, text: str, start: int, end: int, rest: bool) -> Iterator[int]:
    """Where a value of the kind may end, the longest first; ``rest``: it starts
    inside a card candidate that failed."""
    if kind == "iban":
        length = IBAN_LENGTH.get(text[start:start + 2].upper())
        cuts = [m.end() for m in re.compile(r"[A-Za-z0-9]\b").finditer(text, start, end)]
        if length is None:
            yield from reversed(cuts)
        else:
            yield from (c for c in cuts if c - start - text.count(" ", start, c) == length)
    elif kind == "card":
        if not rest:
            yield end
        cuts = [m.start() for m in re.compile(r"[ -]").finditer(text, start, end)]
        yield from (c for c in [end, *reversed(cuts)] if _GROUPED.fullmatch(text, start, c))
    else:
        yield end


def _value(kind: str, m: re.Match, key: bytes, rest: bool) -> tuple[int, str] | None:
    """End and pseudonym of the longest valid value at the start of a candidate."""
    for end in _ends(kind, m.string, m.start(), m.end(), rest):
        new = pseudonym(kind, m.string[m.start():end], key)
        if new is not None:
            return end, new
    return None


def _next_card(text: str, start: int, end: int, key: bytes) -> int | None:
    """Where the next valid card number starts in a failed candidate."""
    while (m := _ONE["card"].search(text, start)) and m.start() < end:
        if _value("card", m, key, True):
            return m.start()
        start = m.start() + 1
    return None


def redact(text: str, key: bytes, found: Counter | None = None) -> str:
    """The text with every valid value replaced; ``found`` counts them by kind."""
    if not _HINT.search(text):
        return text
    out, done, at, failed = [], 0, 0, 0  # copied up to, searched up to, end of a failed card
    while m := _FIND.search(text, at):
        start, limit = m.start(), len(text)
        at = start + 1
        for kind in _ORDER[_ORDER.index(m.lastgroup):]:
            one = m if kind == m.lastgroup else _ONE[kind].match(text, start, limit)
            hit = one and _value(kind, one, key, start < failed)
            if hit:
                out += [text[done:start], hit[1]]
                done = at = hit[0]
                if found is not None:
                    found[kind] += 1
                break
            if one and kind == "card":  # a phone number must not take the front of a card
                failed = max(failed, one.end())
                limit = _next_card(text, start + 1, one.end(), key) or limit
    out.append(text[done:])
    return "".join(out)


def pseudonymise(docs: DataFrame, key: bytes = DEMO_KEY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, n_replaced and a count per kind, per document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str | None] = []
            counts: list[Counter] = []
            for text in batch.column(1):
                value, found = text.as_py(), Counter()
                texts.append(None if value is None else redact(value, key, found))
                counts.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()),
                 pa.array([c.total() for c in counts], pa.int64()),
                 *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS)],
                names=["doc_id", "text", "n_replaced", *(f"n_{k}" for k in KINDS)])

    schema = "doc_id long, text string, n_replaced long, " + ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
