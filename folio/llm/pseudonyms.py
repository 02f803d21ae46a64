"""Personal data: validated values are permuted by a keyed Feistel network within their format.

A value is a number below the size of its domain (digits of a phone number, days since 1900, addresses, letters and
digits of a name). The network is over two mixed radices and walks cycles back into the domain, so it is one-to-one:
equal values get equal pseudonyms in all documents and formats, unequal values unequal ones, and whoever has the key
can invert it. Check digits are computed anew, so pseudonyms pass the validation that found the value.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()


class Feistel:
    def __init__(self, key: bytes) -> None:
        if not key:
            raise ValueError("pseudonyms are as secret as their key: it can't be empty")
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, kind: str, size: int, i: int, x: int, m: int) -> int:
        h = hashlib.blake2b(f"{kind}|{size}|{i}|{x}".encode(), key=self.key, digest_size=(m.bit_length() + 7) // 8 + 8 if m.bit_length() < 400 else 64)
        out, n = h.digest(), (m.bit_length() + 7) // 8 + 8
        while len(out) < n:
            out += hashlib.blake2b(out[-64:], key=self.key).digest()
        return int.from_bytes(out[:n], "big") % m

    def _once(self, x: int, size: int, kind: str, back: bool) -> int:
        a_size = 1 << ((size.bit_length() + 1) // 2)
        b_size = -(-size // a_size)
        a, b = x % a_size, x // a_size
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                b = (b + sign * self._f(kind, size, i, a, b_size)) % b_size
            else:
                a = (a + sign * self._f(kind, size, i, b, a_size)) % a_size
        return b * a_size + a

    def permute(self, x: int, size: int, kind: str, back: bool = False) -> int:
        """A permutation of range(size), a different one for each kind."""
        while True:
            x = self._once(x, size, kind, back)
            if x < size:
                return x


def luhn(digits: str) -> int:
    """The sum that ends in 0 for valid numbers."""
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))


def _fill(shape: str, digits: str) -> str:
    """Digits put in place of the digits of shape."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _number(f: Feistel, digits: str, kind: str, back: bool) -> str:
    return f"{f.permute(int(digits), 10 ** len(digits), kind, back):0{len(digits)}d}" if digits else ""


_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_OF = {c: k for k in _CLASSES for c in k}


def _letters(f: Feistel, s: str, kind: str, back: bool) -> str:
    """Letters and digits permuted together, each within its class; other characters stay."""
    x, size = 0, 1
    for c in s:
        if c in _OF:
            x, size = x * len(_OF[c]) + _OF[c].index(c), size * len(_OF[c])
    if size == 1:
        return s
    x, out = f.permute(x, size, kind + "|" + "".join(str(_CLASSES.index(_OF[c])) if c in _OF else "." for c in s), back), []
    for c in reversed(s):
        if c in _OF:
            x, r = divmod(x, len(_OF[c]))
            c = _OF[c][r]
        out.append(c)
    return "".join(reversed(out))


def card(f: Feistel, s: str, back: bool = False) -> str | None:
    """13 to 19 digits whose Luhn sum ends in 0. The first digit, which names the industry, stays."""
    digits = re.sub(r"\D", "", s)
    if not 13 <= len(digits) <= 19 or luhn(digits) % 10 or len(set(digits)) == 1:
        return None
    body = digits[0] + _number(f, digits[1:-1], "card", back)
    return _fill(s, body + str(-luhn(body + "0") % 10))


def social(f: Feistel, s: str, back: bool = False) -> str | None:
    """AAA-GG-SSSS with area 001 to 899 but 666, group and serial not 0."""
    a, g, n = (int(p) for p in s.split("-"))
    if not 0 < a < 900 or a == 666 or not g or not n:
        return None
    x = f.permute(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + n - 1, 898 * 99 * 9999, "social", back)
    x, n = divmod(x, 9999)
    a, g = divmod(x, 99)
    return f"{a + 1 + (a + 1 >= 666):03d}-{g + 1:02d}-{n + 1:04d}"


def phone(f: Feistel, s: str, back: bool = False) -> str | None:
    """10 digits in groups, or + and 8 to 15 digits; the country code stays."""
    digits = re.sub(r"\D", "", s)
    code = next((n for n in (1, 2) if digits[:n] in _CODES), 3) if s.startswith("+") else len(digits) - 10
    if not 8 <= len(digits) <= 15 or code < 0 or len(digits) - code < 6:
        return None
    return _fill(s, digits[:code] + _number(f, digits[code:], "phone", back))


def address(f: Feistel, s: str, back: bool = False) -> str | None:
    """IPv4, each part up to 255."""
    parts = [int(p) for p in s.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in s.split(".")):
        return None
    x = f.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "address", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def date(f: Feistel, s: str, back: bool = False) -> str | None:
    """A day from 1900 to 2099: year first, or month first with /, day first with . or -, each as it is valid."""
    parts = re.split(r"([-/.])", s)
    if len(parts) != 5 or parts[1] != parts[3]:
        return None
    order = "ymd" if len(parts[0]) == 4 else "mdy" if parts[1] == "/" else "dmy"
    for o in (order, {"ymd": "ymd", "mdy": "dmy", "dmy": "mdy"}[order]):
        v = dict(zip(o, map(int, parts[::2]), strict=True))
        try:
            x = datetime.date(v["y"], v["m"], v["d"]).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= x < _DAYS:
            return None
        d = datetime.date.fromordinal(f.permute(x, _DAYS, "date", back) + _FIRST_DAY)
        return parts[1].join(f"{d.year:04d}" if k == "y" else f"{d.month if k == 'm' else d.day:0{len(p)}d}" for k, p in zip(o, parts[::2], strict=True))
    return None


def account(f: Feistel, s: str, back: bool = False) -> str | None:
    """IBAN with a valid remainder; country stays, check digits are computed."""
    number = lambda t: int("".join(str(int(c, 36)) for c in t))
    if number(s[4:] + s[:4]) % 97 != 1:
        return None
    body = _letters(f, s[4:], "account", back)
    return f"{s[:2]}{98 - number(body + s[:2] + '00') % 97:02d}{body}"


def email(f: Feistel, s: str, back: bool = False) -> str | None:
    """Letters and digits before the last dot, case ignored; the top-level domain stays."""
    name, dot, top = s.lower().rpartition(".")
    return _letters(f, name, "email", back) + dot + top


def secret(f: Feistel, s: str, back: bool = False) -> str | None:
    return _letters(f, s, "secret", back)


#: kind -> pattern, in the order in which they are tried at a position.
PATTERNS: dict[str, tuple[str, Callable[..., str | None]]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", email),
    "secret": (r"(?:(?i:(?<=password=)|(?<=passwd=)|(?<=token = \")|(?<=token=)|(?<=secret=)|(?<=api_key=)|(?<=apikey=)|(?<=password: )|(?<=token: )))[A-Za-z0-9_+/-]{8,}|\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{30,}", secret),
    "account": (r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", account),
    "date": (r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}[/.-]\d{1,2}[/.-]\d{4})(?![\d/-])", date),
    "address": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", address),
    "social": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", social),
    "phone": (r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d)|(?<![\d.-])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])", phone),
    "card": (r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)", card),
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})" for k, (p, _) in PATTERNS.items()))
#: Every pattern needs one of these: a digit, the @ of an address, or a prefix of a secret (gh?_ and AKIA may have no digit).
_HINT = re.compile(r"[0-9@]|gh[pousr]_|AKIA|(?i:password|passwd|token|secret|api_?key)")
_GROUP = re.compile(r"\d+")
#: Country codes of one and two digits; all others have three.
_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}


def _card_at(text: str, start: int, f: Feistel, back: bool) -> tuple[str, int, int] | None:
    """The longest valid card of whole groups of digits that begins at start, of up to 19 digits; later groups get their own turn."""
    ends, end, digits = [], start, 0
    while (m := _GROUP.match(text, end)) and (digits := digits + m.end() - m.start()) <= 19:
        ends.append(m.end())
        end = m.end() + (text[m.end() : m.end() + 1] in (" ", "-"))
    return next(((new, start, e) for e in reversed(ends) if (new := card(f, text[start:e], back)) is not None), None)


def pseudonymised(text: str, f: Feistel, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text, and (kind, start, end) in code points of what was replaced, as it stood in the input."""
    out, spans, done, at = [], [], 0, 0
    if not _HINT.search(text):
        return text, spans
    while m := _ANY.search(text, at):
        new = PATTERNS[m.lastgroup][1](f, m[0], back)
        kind, (start, end) = m.lastgroup, m.span()
        if new is None and kind in ("phone", "card") and text[start].isdigit() and (c := _card_at(text, start, f, back)):
            kind, (new, start, end) = "card", c
        if new is None:  # not valid; look again behind its first run of digits
            at = max(m.start() + 1, re.compile(r"\w*").match(text, m.start()).end())
            continue
        out += [text[done:start], new]
        spans.append((kind, start, end))
        done = at = end
    return "".join([*out, text[done:]]), spans


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, n_found, changed, spans, text) of each row, text with pseudonyms in place of the values found. The key has
    no default: whoever has it can turn pseudonyms back.

    Null text stays null with no spans; an empty table gives none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            done = [(None, []) if t is None else pseudonymised(t, f) for t in batch.column(1).to_pylist()]
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in s] for _, s in done]
            counts = [len(s) for s in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32()), pa.array([c > 0 for c in counts]), pa.array(found, kind), pa.array([t for t, _ in done], pa.string())], ["doc_id", "n_found", "changed", "spans", "text"])

    schema = "doc_id long, n_found int, changed boolean, spans array<struct<kind:string,start:int,end:int>>, text string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
