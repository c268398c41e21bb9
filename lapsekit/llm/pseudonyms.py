"""Format-preserving pseudonyms for personal data.

Numbers, dates, addresses and keys found in texts are validated and then permuted
inside their format by a keyed Feistel network: a valid card number becomes another
valid card number of the same length and grouping, a date another date written the
same way, a mail address another address. A permutation maps equal values to equal
pseudonyms in every document and different values to different ones, and
``decrypt=True`` undoes it. Lengths and separators are kept.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lapsekit.llm.texts import pieces

DEFAULT_KEY = "change me"
ROUNDS = 8
KINDS = ["email", "ip", "card", "iban", "ssn", "phone", "date", "secret"]


class Feistel:
    """A keyed permutation of ``range(size)``: a balanced network over the next even number of bits, walked back into range."""

    def __init__(self, key: str, purpose: str, size: int) -> None:
        self.size = size
        self.half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.key = hashlib.blake2b(f"{purpose}|{size}".encode(), key=hashlib.sha256(key.encode()).digest(), digest_size=32).digest()
        self.width = (self.half + 7) // 8

    def _f(self, i: int, x: int) -> int:
        digest = hashlib.blake2b(bytes([i]) + x.to_bytes(self.width, "big"), key=self.key, digest_size=min(64, self.width + 8)).digest()
        return int.from_bytes(digest, "big") & self.mask

    def _once(self, x: int, rounds: range) -> int:
        a, b = x >> self.half, x & self.mask
        if rounds.step > 0:
            for i in rounds:
                a, b = b, a ^ self._f(i, b)
        else:
            for i in rounds:
                a, b = b ^ self._f(i, a), a
        return a << self.half | b

    def __call__(self, x: int, decrypt: bool = False) -> int:
        rounds = range(ROUNDS - 1, -1, -1) if decrypt else range(ROUNDS)
        while True:
            x = self._once(x, rounds)
            if x < self.size:
                return x


@lru_cache(maxsize=4096)
def _network(key: str, purpose: str, size: int) -> Feistel:
    return Feistel(key, purpose, size)


def _permute_over(text: str, alphabet: str, key: str, purpose: str, decrypt: bool, first_nonzero: bool = False) -> str:
    """Permute a string over an alphabet as one number; ``first_nonzero`` keeps a leading digit from becoming 0."""
    base, n = len(alphabet), 0
    for c in text:
        n = n * base + alphabet.index(c)
    low = base ** (len(text) - 1) if first_nonzero and text[0] != alphabet[0] else 0
    n = low + _network(key, purpose, base ** len(text) - low)(n - low, decrypt)
    out = []
    for _ in text:
        n, r = divmod(n, base)
        out.append(alphabet[r])
    return "".join(reversed(out))


DIGITS, LOWER, HEX, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def luhn(digits: str) -> int:
    """The Luhn sum modulo 10; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _refill(template: str, digits: str) -> str:
    """Put new digits in the places of the old ones."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in template)


def _card(text: str, key: str, decrypt: bool) -> str:
    """A valid number keeps its check digit valid; other long numbers are permuted in another, disjoint set."""
    digits = re.sub(r"\D", "", text)
    head, check = digits[:-1], int(digits[-1])
    excess = luhn(digits)
    head = _permute_over(head, DIGITS, key, f"card{0 if excess == 0 else 1}", decrypt, first_nonzero=True)
    valid = (10 - luhn(head + "0")) % 10
    # The last digit's distance from the valid one is kept, so validity is, and the map stays one-to-one.
    old_valid = (10 - luhn(digits[:-1] + "0")) % 10
    return _refill(text, head + str((valid + check - old_valid) % 10))


def _ssn(text: str, key: str, decrypt: bool) -> str | None:
    area, group, serial = (int(x) for x in re.split(r"\D", text))
    if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
        return None
    index = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    index = _network(key, "ssn", 898 * 99 * 9999)(index, decrypt)
    index, serial = divmod(index, 9999)
    area, group = divmod(index, 99)
    area += 1 + (area >= 665)
    return _refill(text, f"{area:03d}{group + 1:02d}{serial + 1:04d}")


def _phone(text: str, key: str, decrypt: bool) -> str:
    """The country code stays; the national number is permuted."""
    m = re.match(r"(\+\d{1,3}(?=[ .\-(]))?(.*)", text, re.S)
    digits = re.sub(r"\D", "", m[2])
    return (m[1] or "") + _refill(m[2], _permute_over(digits, DIGITS, key, "phone", decrypt, first_nonzero=True))


def _ip(text: str, key: str, decrypt: bool) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if any(p > 255 for p in parts) or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    n = int.from_bytes(bytes(parts), "big")
    return ".".join(map(str, _network(key, "ip", 1 << 32)(n, decrypt).to_bytes(4, "big")))


def _email(text: str, key: str, decrypt: bool) -> str:
    """Letters and digits are permuted in runs, signs and the top-level domain stay."""
    body, dot, top = text.rpartition(".")
    runs = re.split(r"([^A-Za-z0-9]+)", body)
    out = []
    for run in runs:
        if re.fullmatch(r"[A-Za-z0-9]+", run):
            alphabet = DIGITS if run.isdigit() else LOWER if run.isalpha() and run.islower() else UPPER if run.isalpha() and run.isupper() else DIGITS + LOWER + UPPER
            run = _permute_over(run, alphabet, key, f"email{len(alphabet)}", decrypt)
        out.append(run)
    return "".join(out) + dot + top


def _iban(text: str, key: str, decrypt: bool) -> str | None:
    plain = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = plain[4:]
    letters = [i for i, c in enumerate(body) if c.isalpha()]
    digits = _permute_over("".join(c for c in body if c.isdigit()), DIGITS, key, f"iban{plain[:2]}", decrypt)
    new = _refill(body, digits) if letters else digits
    check = 98 - number(new + plain[:2] + "00") % 97
    out = iter(plain[:2] + f"{check:02d}" + new)
    return "".join(" " if c == " " else next(out) for c in text)


_FIRST, _DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2100, 1, 1).toordinal() - dt.date(1900, 1, 1).toordinal()
_ORDERS = [(re.compile(r"(\d{4})([-/.])(\d{2})\2(\d{2})"), "ymd"), (re.compile(r"(\d{2})([-/.])(\d{2})\2(\d{4})"), None)]


def _date(text: str, key: str, decrypt: bool) -> str | None:
    """Dates of 1900 to 2099; with the year last, months follow days after a dot and precede them after a slash or dash."""
    for pattern, order in _ORDERS:
        if m := pattern.fullmatch(text):
            a, sign, b, c = m.groups()
            order = order or ("dmy" if sign == "." else "mdy")
            part = dict(zip(order, (a, b, c)))
            try:
                day = dt.date(int(part["y"]), int(part["m"]), int(part["d"])).toordinal() - _FIRST
            except ValueError:
                return None
            if not 0 <= day < _DAYS:
                return None
            new = dt.date.fromordinal(_FIRST + _network(key, f"date{order}", _DAYS)(day, decrypt))
            shown = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
            return sign.join(shown[p] for p in order)
    return None


def _secret(text: str, key: str, decrypt: bool) -> str:
    """A fixed prefix and a quoted or assigned name stay; the key material is permuted."""
    m = re.fullmatch(r"(AKIA|ASIA|ghp_|sk-|(?:[A-Za-z_]+\s*[=:]\s*[\"']?))(.*)", text, re.S)
    head, body = (m[1], m[2]) if m else ("", text)
    alphabet = (
        HEX if re.fullmatch(r"[0-9a-f]+", body) else DIGITS + UPPER if re.fullmatch(r"[0-9A-Z]+", body) else DIGITS + UPPER + LOWER + "_-+/.!#%*?&^~"
    )
    return head + _permute_over(body, alphabet, key, f"secret{len(alphabet)}", decrypt)


# Tried in this order at each place; of each kind the ends of _ends; the first one whose check holds wins.
_KINDS = (
    r"(?P<email>(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@(?:[A-Za-z0-9\-]{1,63}\.){1,4}[A-Za-z]{2,24})"
    r"|(?P<secret>(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,48}"
    r"|(?i:password|passwd|pwd|secret|token|api_?key) ?[=:] ?[\"']?[A-Za-z0-9_\-+/.!#%*?&^~]{8,128}))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<![\w+])\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)|(?<![\w+.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\w]|[.\-]\d))"
    r"|(?P<date>(?<![\w.\-/])(?:\d{4}(?P<s1>[-/.])\d{2}(?P=s1)\d{2}|\d{2}(?P<s2>[-/.])\d{2}(?P=s2)\d{4})(?![\w]|[.\-/]\d))"
    r"|(?P<ssn>(?<![\w\-])\d{3}[- ]\d{2}[- ]\d{4}(?![\w]|-\d))"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<card>(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?![\w]|[.\-]\d))"
)
PATTERN = re.compile(_KINDS)
_SINGLE = {m: re.compile(p) for m, p in ((p[4 : p.index(">")], p) for p in re.split(r"\|(?=\(\?P<(?:" + "|".join(KINDS) + ")>)", _KINDS))}
_QUAD = re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)")
_BRACKETED = re.compile(r"\+\d{1,3}[ .\-]?\(\d{3}\)[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)")
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "GI": 23, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18,
    "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def _phone_end(line: str, start: int, end: int) -> int:
    """Where a phone with a country code ends: after 3 and 4 digits behind a bracketed area of three, else by separators and 15 digits."""
    if m := _BRACKETED.match(line, start, end):
        return m.end()
    head = re.compile(r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?").match(line, start)
    best, digits, mark, last = end, 0, "", start
    for i, run in enumerate(re.finditer(r"\d+", line[:end][start:])):
        a, b = start + run.start(), start + run.end()
        sign = line[last:a] if a > head.end() else ""
        digits += b - a
        # A space after a dot or dash, a dot after anything else, more digits than a number has, or an address begin another value.
        if i and (digits > 15 or (sign == " " and mark in ("-", ".")) or (sign == "." and mark not in ("", ".")) or _QUAD.match(line, a)):
            best = last
            break
        mark, last = sign or mark, b
    return best


def _ends(kind: str, line: str, start: int, end: int) -> list[int]:
    """Ends to try for a value found: an IBAN of its country's length first, then shorter ones."""
    if kind == "phone" and line[start] == "+":
        short = _phone_end(line, start, end)
        return [short] if _SINGLE["phone"].fullmatch(line[start:short]) else []
    if kind == "iban":
        ends = [e for e in range(end, start + 14, -1) if line[e - 1] != " " and (e == len(line) or not line[e].isalnum())]
        want = _IBAN_LENGTHS.get(line[start : start + 2])
        return sorted(ends, key=lambda e: len(line[start:e].replace(" ", "")) != want)
    return [end]


_CHANGES: dict[str, Callable[[str, str, bool], str | None]] = {
    "email": _email, "ip": _ip, "card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "date": _date, "secret": _secret,
}
_SIGNS, _PREFIXES = re.compile(r"[@0-9=:]"), ("AKIA", "ASIA", "ghp_", "sk-")


def _worth(text: str) -> bool:
    """Could the text hold a value at all; quick, and never wrong about a no."""
    return bool(_SIGNS.search(text)) or any(p in text for p in _PREFIXES)


def replace(text: str, key: str, decrypt: bool = False, memory: dict | None = None) -> tuple[str, list[tuple[int, str]]]:
    """The text with pseudonyms, and place and kind of each one."""
    found: list[tuple[int, str]] = []
    if not text or not _worth(text):
        return text, found
    memory = {} if memory is None else memory
    begin = 0

    def change(kind: str, value: str) -> str | None:
        if (kind, value) in memory:
            return memory[kind, value]
        new = _CHANGES[kind](value, key, decrypt)
        if len(memory) < 100_000:
            memory[kind, value] = new
        return new

    def first(line: str, start: int, kinds: list[str]) -> tuple[str, int, str, bool] | None:
        """Kind, end and pseudonym of the first value whose check holds at a place, and whether others failed before it."""
        tried = 0
        for kind in kinds:
            if one := _SINGLE[kind].match(line, start):
                for end in _ends(kind, line, start, one.end()):
                    if (new := change(kind, line[start:end])) is not None:
                        return kind, end, new, tried > 0
                    tried += 1
        return None

    def changed(line: str) -> str:
        out, done, at, kinds = [], 0, 0, list(_SINGLE)
        while m := PATTERN.search(line, at):
            start, at = m.start(), m.start() + 1
            if not (best := first(line, start, kinds[kinds.index(m.lastgroup) :])):
                continue
            kind, end, new, late = best
            # The pseudonym has to be found as the same kind at the same end, or it could not be undone: permute on until it is.
            while late and ((again := first(line[:start] + new + line[end:], start, kinds)) is None or again[:2] != (kind, end)):
                new = change(kind, new)
            if new != line[start:end]:
                found.append((begin + start, kind))
            out += [line[done:start], new]
            done = at = end
        return "".join(out) + line[done:]

    lines = text.split("\n")  # no value crosses lines, and most lines hold nothing worth a closer look
    for i, line in enumerate(lines):
        if _worth(line):
            lines[i] = changed(line)
        begin += len(line) + 1
    return "\n".join(lines), found


def pseudonymised(docs: DataFrame, key: str = DEFAULT_KEY, decrypt: bool = False) -> DataFrame:
    """The rows of ``docs`` with rewritten ``text``; all other columns stay as they are.

    Nulls and empty texts stay. No row is dropped, repeated rows are rewritten each.
    A value on which a check fails (a date of month 13, an address part over 255) stays.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                new = [replace(t, key, decrypt, memory)[0] for t in part.column(at).to_pylist()]
                yield part.set_column(at, part.schema.field(at), pa.array(new, part.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``doc_id, text`` rewritten, ``n_found`` and the number of values of each kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                done = [replace(t, key, False, memory) for t in part.column("text").to_pylist()]
                kinds = [[k for _, k in found] for _, found in done]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), pa.array([t for t, _ in done], pa.string()), pa.array([len(k) for k in kinds], pa.int64()),
                        *(pa.array([k.count(name) for k in kinds], pa.int64()) for name in KINDS),
                    ],
                    names=["doc_id", "text", "n_found", *(f"n_{name}" for name in KINDS)],
                )

    columns = ", ".join(f"n_{name} long" for name in KINDS)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return base.mapInArrow(run, f"doc_id long, text string, n_found long, {columns}")
