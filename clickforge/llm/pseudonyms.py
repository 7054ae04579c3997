"""Format-preserving pseudonyms of personal data.

Candidates are found by pattern, then *validated* (Luhn digit, IBAN check
digits, octet ranges, calendar, area rules).  A validated value is permuted
inside its own format by a keyed Feistel network with cycle walking: its digits
or letters become an integer of the format's domain, the network permutes the
domain, and values that would be invalid are walked over.  The permutation
depends on key, kind and format only, so equal values get equal pseudonyms in
every document, distinct values distinct ones, and the key's holder can invert
it.  Check digits are computed anew; separators and length stay.
"""

from __future__ import annotations

import calendar
import datetime
import hashlib
import hmac
import math
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

ROUNDS = 8


class Feistel:
    """Keyed permutation of range(size), unbalanced halves, cycle walking."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = max(1, math.isqrt(size - 1) + 1) if size > 1 else 1
        self.b = max(1, -(-size // self.a))
        self.mac = hmac.new(key, tweak.encode() + b"|%d" % size, hashlib.sha256)

    def _round(self, i: int, v: int) -> int:
        m = self.mac.copy()
        m.update(b"%d|%d" % (i, v))
        return int.from_bytes(m.digest(), "big")

    def _once(self, x: int, back: bool) -> int:
        left, right = divmod(x, self.b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * self._round(i, left)) % self.b
            else:
                left = (left + sign * self._round(i, right)) % self.a
        return left * self.b + right

    def permute(self, x: int, valid=lambda x: True, back: bool = False) -> int:
        """The next valid element of the cycle that starts at x (itself valid)."""
        y = self._once(x, back)
        while y >= self.size or not valid(y):
            y = self._once(y, back)
        return y


def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_check(country: str, bban: str) -> str:
    digits = "".join(str(int(c, 36)) for c in bban + country + "00")
    return f"{98 - int(digits) % 97:02d}"


def _refill(pattern: str, chars: str) -> str:
    """Put chars in place of the letters and digits of pattern."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in pattern)


#: Characters of an IBAN by country.
IBAN_LENGTH = {c: int(n) for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in countries.split()}
#: Usual groupings of a card number, the commonest first; inside a longer run of digit groups only these are looked for.
CARD_FORMS = tuple(re.compile(r"(?<!\d)" + p + r"(?!\d)") for p in (
    r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}", r"\d{4}([ -])\d{6}\1\d{4,5}", r"\d{13,19}", r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}\1\d{1,3}",
    r"\d{4}([ -])\d{3}\1\d{3}\1\d{3}"))
#: The start of the next group of a match.
NEXT_GROUP = re.compile(r"[^\W_]*[\W_]+(?=[^\W_])")

CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = ("0123456789abcdef", "0123456789ABCDEF")


class Pseudonyms:
    """Finds, validates and replaces the values of a text."""

    FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

    PATTERNS = (
        ("email", r"(?<![\w.+%-])[A-Za-z0-9][\w.+%-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}"),
        ("secret", r"(?i:(?:token|secret|password|passwd|api[_-]?key|access[_-]?key))[\"']?\s*[:=]\s*[\"']?(?P<value>[A-Za-z0-9_+/=-]{16,})"),
        ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
        ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"),
        ("date", r"(?<![\d./-])(?:\d{4}(?P<s1>[-/.])\d{1,2}(?P=s1)\d{1,2}|\d{1,2}(?P<s2>[-/.])\d{1,2}(?P=s2)\d{4})(?![\d/-])(?!\.\d)"),
        ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
        ("card", r"(?<![\d+])\d(?:[ -]?\d){12,18}(?!\d)"),
        ("phone", r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"),
    )
    #: A text without a digit or @ can still hold a secret of letters only.
    MAYBE = re.compile(r"[0-9@]|(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)")

    def __init__(self, key: bytes):
        self.key = key
        self.nets: dict[tuple[str, int], Feistel] = {}
        self.kinds = {kind: re.compile(p) for kind, p in self.PATTERNS}
        # the secret's pattern has a named value; others are replaced whole
        self.find = re.compile("|".join(f"(?P<{kind}>{p})" for kind, p in self.PATTERNS))

    def net(self, tweak: str, size: int) -> Feistel:
        if len(self.nets) > 10_000:
            self.nets.clear()
        if (tweak, size) not in self.nets:
            self.nets[tweak, size] = Feistel(self.key, tweak, size)
        return self.nets[tweak, size]

    def _letters(self, kind: str, s: str, back: bool, hexadecimal: bool = False) -> str:
        """Permute a string within the class of each of its characters."""
        sets = [next((c for c in CLASSES if x in c), x) for x in s]
        if hexadecimal:
            for h in HEX:
                if all(x in h for x in s):
                    sets = [h] * len(s)
        n = math.prod(len(c) for c in sets)
        if n < 2:
            return s
        shape = "".join("x" if c in HEX else "9aA"[CLASSES.index(c)] if c in CLASSES else c for c in sets)
        x = 0
        for c, ch in zip(sets, s, strict=True):
            x = x * len(c) + c.index(ch)
        y = self.net(f"{kind}:{shape}", n).permute(x, back=back)
        out = []
        for c in reversed(sets):
            y, r = divmod(y, len(c))
            out.append(c[r])
        return "".join(reversed(out))

    def email(self, v: str, back: bool) -> str | None:
        local, domain = v.rsplit("@", 1)
        return self._letters("email@" + domain.lower(), local, back) + "@" + domain

    def secret(self, v: str, back: bool) -> str | None:
        return self._letters("secret", v, back, hexadecimal=True)

    def iban(self, v: str, back: bool) -> str | None:
        plain = v.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        bban = self._letters("iban" + plain[:2], plain[4:], back)
        return _refill(v, plain[:2] + iban_check(plain[:2], bban) + bban)

    def ip(self, v: str, back: bool) -> str | None:
        octets = v.split(".")
        if any(int(o) > 255 or str(int(o)) != o for o in octets):
            return None
        y = self.net("ip", 1 << 32).permute(int.from_bytes(bytes(map(int, octets)), "big"), back=back)
        return ".".join(map(str, y.to_bytes(4, "big")))

    def date(self, v: str, back: bool) -> str | None:
        a, s, b, _, c = re.split(r"([-/.])", v)
        year_first = len(a) == 4
        forms = ("ymd",) if year_first else ("mdy", "dmy") if s == "/" else ("dmy", "mdy")

        def parse(form):
            f = dict(zip(form, (int(a), int(b), int(c)), strict=True))
            ok = 1900 <= f["y"] <= 2099 and 1 <= f["m"] <= 12 and 1 <= f["d"] <= calendar.monthrange(f["y"], f["m"])[1]
            return datetime.date(f["y"], f["m"], f["d"]) if ok else None

        form = next((f for f in forms if parse(f)), None)
        if form is None:
            return None
        # a date read in the second order must be readable in that order only
        valid = lambda x: form == forms[0] or datetime.date.fromordinal(x + self.FIRST_DAY).day > 12
        n = self.LAST_DAY - self.FIRST_DAY + 1
        y = self.net(f"date:{form}", n).permute(parse(form).toordinal() - self.FIRST_DAY, valid, back)
        d = datetime.date.fromordinal(y + self.FIRST_DAY)
        padded = any(len(p) == 2 and p[0] == "0" for p in (a, b, c)) or all(len(p) != 1 for p in (a, b, c))
        part = {"y": f"{d.year:04d}", "m": f"{d.month:02d}" if padded else str(d.month), "d": f"{d.day:02d}" if padded else str(d.day)}
        return s.join(part[k] for k in form)

    def ssn(self, v: str, back: bool) -> str | None:
        def valid(x):
            area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
            return area not in (0, 666) and area < 900 and group > 0 and serial > 0

        x = int(v.replace("-", ""))
        if not valid(x):
            return None
        y = f"{self.net('ssn', 10**9).permute(x, valid, back):09d}"
        return _refill(v, y)

    def card(self, v: str, back: bool) -> str | None:
        d = re.sub(r"\D", "", v)
        if d[0] not in "23456" or len(set(d)) == 1 or luhn_digit(d[:-1]) != d[-1]:
            return None
        n = len(d) - 2  # the first digit names the scheme and stays
        body = d[0] + f"{self.net(f'card{len(d)}:{d[0]}', 10**n).permute(int(d[1:-1]), back=back):0{n}d}"
        return _refill(v, body + luhn_digit(body))

    def phone(self, v: str, back: bool) -> str | None:
        m = re.match(r"\+\d{1,3}(?=[ .(-])", v)
        code = m.group() if m else "+" if v[0] == "+" else ""
        rest = v[len(code):]
        d = re.sub(r"\D", "", rest)
        if not 7 <= len(re.sub(r"\D", "", v)) <= 15 or len(d) < 6:
            return None
        y = f"{self.net(f'phone{code}:{len(d)}', 10**len(d)).permute(int(d), back=back):0{len(d)}d}"
        return code + _refill(rest, y)

    def _spans(self, kind: str, text: str, start: int, end: int, loose: bool):
        """(start, end) of the values to try for a match, the likeliest first.

        An IBAN's pattern may take words behind it and a card's the numbers
        around it, so ends at earlier groups and starts at later ones are tried
        too.  What a pseudonym cannot change (country and length, grouping)
        comes first, so that the same span is found in the new text.
        """
        at = start
        while kind in ("iban", "card") and at < end:
            if kind == "card":
                yield from (m.span() for form in CARD_FORMS if (m := form.match(text, at)))
            elif m := self.kinds["iban"].match(text, at):
                yield from ((at, e) for e, n in self._ends(text, *m.span()) if n == IBAN_LENGTH.get(text[at:at + 2]))
            step = NEXT_GROUP.match(text, at, end)
            at = step.end() if step else end
        if kind != "card" or loose:
            yield start, end
        if kind == "iban" and text[start:start + 2] not in IBAN_LENGTH:
            yield from ((start, e) for e, n in self._ends(text, start, end) if n >= 15)

    @staticmethod
    def _ends(text: str, start: int, end: int) -> list[tuple[int, int]]:
        """(end, characters without blanks) of the groups, the longest first."""
        return [(e, e - start - text.count(" ", start, e)) for e in (end, *(i for i in range(end - 1, start, -1) if text[i] == " "))]

    def _first_valid(self, kind: str, text: str, start: int, end: int, loose: bool, back: bool):
        for a, b in self._spans(kind, text, start, end, loose):
            new = getattr(self, kind)(text[a:b], back)
            if new is not None:
                return new, a, b
        return None

    def replace(self, text: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with its values replaced, and (kind, start, end) of each in
        the new text.  ``back`` inverts; it finds the same spans unless a longer
        or earlier span that was not valid has become so (of numbers that touch
        in one run, about one in ten by the check digit)."""
        out, at, spans, length, pos = [], 0, [], 0, 0
        tried = 0  # unusual groupings of a card are tried once in a run of groups, from its start
        while m := self.find.search(text, pos):
            kind = m.lastgroup if m.lastgroup in self.kinds else next(k for k in self.kinds if m.group(k) is not None)
            start, end = m.span("value") if kind == "secret" else m.span()
            found = self._first_valid(kind, text, start, end, start >= tried, back)
            if kind == "card":
                tried = max(tried, end)
            if found is None:
                # not valid as this kind: the same place may be another kind
                for other in list(self.kinds)[list(self.kinds).index(kind) + 1:]:
                    o = self.kinds[other].match(text, m.start())
                    if o and (found := self._first_valid(other, text, *o.span(), o.start() >= tried, back)) is not None:
                        kind = other
                        break
            if found is None:
                # the next value may start at any group of this one
                step = NEXT_GROUP.match(text, m.start(), m.end())
                pos = step.end() if step else m.end()
                continue
            new, start, end = found
            out += [text[at:start], new]
            length += start - at
            spans.append((kind, length, length + len(new)))
            length += len(new)
            at = pos = end
        if not out:
            return text, []
        out.append(text[at:])
        return "".join(out), spans


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced, and two more columns:
    ``pii_count`` and ``pii_spans`` (kind, start, end in the new text).

    Rows, their order within partitions and other columns stay; there is no
    shuffle.  A null text stays null and an empty one empty, both with 0 values.
    Equal values become equal wherever they occur, also in repeated rows.
    Columns named pii_count or pii_spans are replaced.  ``back`` restores the
    original of a pseudonymised text for the holder of the key.
    """
    secret = key.encode()
    ship(docs)

    @F.pandas_udf("text string, spans array<struct<kind:string,start:int,end:int>>")
    def apply(texts: pd.Series) -> pd.DataFrame:
        tool = Pseudonyms(secret)
        new, spans = [], []
        for t in texts:
            # the text goes back only if it changed
            out, found = tool.replace(t, back) if t is not None and tool.MAYBE.search(t) else (None, [])
            new.append(out if found else None)
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in found])
        return pd.DataFrame({"text": new, "spans": spans})

    return (docs.withColumn("__pii", apply(F.col(text_col).cast("string")))
            .withColumns({text_col: F.coalesce("__pii.text", F.col(text_col).cast("string")),
                          "pii_count": F.size("__pii.spans"), "pii_spans": F.col("__pii.spans")}).drop("__pii"))
