"""Personal data: format-preserving Feistel pseudonyms.

A value is found by its pattern and validated (Luhn digits of cards, check digits of IBANs, ranges of
addresses and social security numbers, the calendar for dates). Its free characters are then read as one
number in mixed radix and permuted by a keyed Feistel network over exactly the numbers of its
format (with cycle walking), so a card stays a valid card of the same length, a date a date written the
same way, an address an address. Equal values, whatever their separators or case, get equal pseudonyms
in all documents, different values different ones; who has the key can invert them.

Kinds: email, phone, card, ip, iban, ssn, date, secret (access keys, quoted tokens, and words of letters and digits
that follow a name such as password and "=" without a space). Candidates that fail validation are left alone, but
what lies inside them is searched again; every text without any value is left alone. A null text stays null, an empty one
empty; long texts are read whole; repeated rows change alike; an empty table gives an empty table. Input
columns with the name of an output column are replaced.
"""

from __future__ import annotations

import datetime
import hashlib
import os
import re
import secrets
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import bounded_batches, free_name, table, without

KINDS = ("email", "phone", "card", "ip", "iban", "ssn", "date", "secret")
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ROUNDS = 10

_FIND = re.compile(
    r"""
    (?<![A-Za-z0-9._%+-])(?P<email>[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})
  | \b(?P<secret>AKIA[0-9A-Z]{16})\b
  | \b(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)\s*[:=]\s*["'](?P<quoted>[A-Za-z0-9+/_=-]{8,})["']
  | \b(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)=(?P<bare>(?=[^\W\d]*\d)(?=\d*[A-Za-z])[A-Za-z0-9]{8,64})(?![\w+/=-])
  | \b(?P<iban>[A-Z]{2}\d\d(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)\b
  | (?<![\w.-])(?P<ssn>\d{3}-\d\d-\d{4})(?![\w-])
  | (?<![\w.-])(?P<date>\d{4}-\d\d-\d\d|(?<!/)\d{4}/\d\d/\d\d(?!/)|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?:(?![\w-])|(?=T\d\d:\d\d))
  | (?<!\d)(?<!\d\.)(?P<ip>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?!\d|\.\d)
  | (?<!\d)(?<!\d[.-])(?P<phone>(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d) | \+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d))
  | (?<!\d)(?<!\d\.)(?P<card>\d{13,19} | \d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7} | \d{4}[ -]\d{6}[ -]\d{5})(?!\d)
    """,
    re.X,
)
_MAYBE = re.compile(r"[0-9@]|AKIA|[\"']")


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, value: int, size: int) -> int:
        data = b"%s|%d|%d" % (tweak, i, value)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=16 + (size.bit_length() + 7) // 8).digest(), "big") % size

    def permute(self, value: int, size: int, tweak: bytes, inverse: bool = False) -> int:
        """A keyed permutation of range(size)."""
        if size < 2:
            return value
        a = 1 << ((size - 1).bit_length() + 1) // 2
        b = -(-size // a)
        while True:
            left, right = divmod(value, a)
            for i in reversed(range(_ROUNDS)) if inverse else range(_ROUNDS):
                sign = -1 if inverse else 1
                if i % 2:
                    right = (right + sign * self._round(tweak, i, left, a)) % a
                else:
                    left = (left + sign * self._round(tweak, i, right, b)) % b
            value = left * a + right
            if value < size:
                return value

    def _mixed(self, digits: list[int], radices: list[int], tweak: bytes, inverse: bool) -> list[int]:
        value, size = 0, 1
        for d, r in zip(digits, radices):
            value, size = value * r + d, size * r
        value = self.permute(value, size, tweak + b"|" + ",".join(map(str, radices)).encode(), inverse)
        out = []
        for r in reversed(radices):
            value, d = divmod(value, r)
            out.append(d)
        return out[::-1]

    def characters(self, text: str, tweak: bytes, inverse: bool = False, fold: bool = False) -> str:
        """Letters and digits permuted together within their classes; the rest stays. fold: case doesn't count."""
        spots = [(i, c) for i, c in enumerate(text) if c.isascii() and c.isalnum()]
        base = [_DIGITS if c.isdigit() else _LOWER for _, c in spots]
        shape = b"" if fold else bytes(c.isupper() for _, c in spots)
        new = self._mixed([b.index(c.lower()) for b, (_, c) in zip(base, spots)], [len(b) for b in base], tweak + shape, inverse)
        out = list(text)
        for (i, c), b, d in zip(spots, base, new):
            out[i] = b[d].upper() if c.isupper() else b[d]
        return "".join(out)

    def email(self, text: str, inverse: bool = False) -> str:
        head, dot, top = text.rpartition(".")
        return self.characters(head, b"email" + top.lower().encode(), inverse, fold=True) + dot + top

    def secret(self, text: str, inverse: bool = False) -> str:
        if re.fullmatch("[0-9a-f]+", text):
            new = text
            while True:  # letters and digits both, or not, as before: so it is found again
                new = f"{self.permute(int(new, 16), 16 ** len(text), b'hex%d' % len(text), inverse):0{len(text)}x}"
                if _both(new) == _both(text):
                    return new
        fixed = 4 if text.startswith("AKIA") else 0
        return text[:fixed] + self.characters(text[fixed:], b"secret", inverse)

    @staticmethod
    def _put(text: str, digits: str) -> str:
        """digits in the places of those in text."""
        new = iter(digits)
        return re.sub(r"\d", lambda _: next(new), text)

    def phone(self, text: str, inverse: bool = False) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 7 <= len(digits) <= 15:
            return None
        head, own = (digits[:-10], digits[-10:]) if len(digits) >= 10 else ("", digits)
        radices, low = [10] * len(own), [0] * len(own)
        if len(own) == 10 and own[0] > "1" and own[3] > "1":  # area code and exchange begin with 2 to 9
            for i in (0, 3):
                radices[i], low[i] = 8, 2
        new = self._mixed([int(d) - m for d, m in zip(own, low)], radices, b"phone", inverse)
        return self._put(text, head + "".join(str(d + m) for d, m in zip(new, low)))

    def card(self, text: str, inverse: bool = False) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 13 <= len(digits) <= 19 or len(set(digits)) == 1 or _luhn(digits[:-1]) != digits[-1]:
            return None
        body = "".join(map(str, self._mixed([int(d) for d in digits[1:-1]], [10] * (len(digits) - 2), b"card" + digits[0].encode(), inverse)))
        return self._put(text, digits[0] + body + _luhn(digits[0] + body))

    def ip(self, text: str, inverse: bool = False) -> str | None:
        parts = [int(x) for x in text.split(".")]
        if max(parts) > 255:
            return None
        low, n = (0, 1) if parts[0] == 0 else (1, 223) if parts[0] < 224 else (224, 32)
        new = self._mixed([parts[0] - low, *parts[1:]], [n, 256, 256, 256], b"ip", inverse)
        return ".".join(map(str, [new[0] + low, *new[1:]]))

    def ssn(self, text: str, inverse: bool = False) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        a, g, s = self._mixed([area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999], b"ssn", inverse)
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"

    def iban(self, text: str, inverse: bool = False) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
            return None
        body = self.characters(plain[4:], b"iban" + plain[:2].encode(), inverse)
        new = iter(plain[:2] + f"{98 - _mod97(body + plain[:2] + '00'):02d}" + body)
        return "".join(" " if c == " " else next(new) for c in text)

    def date(self, text: str, inverse: bool = False) -> str | None:
        """The calendar day within 1900 to 2099; day first unless only month first is a day."""
        a, mark, b, _, c = re.split(r"([-/.])", text)
        orders = ["ymd"] if len(a) == 4 else ["dmy", "mdy"]
        first, last = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
        for order in orders:
            part = dict(zip(order, map(int, (a, b, c))))
            try:
                day = datetime.date(part["y"], part["m"], part["d"]).toordinal()
            except ValueError:
                continue
            if not first <= day <= last:
                continue
            size = last - first + 1
            while True:
                day = first + self.permute(day - first, size, b"date", inverse)
                new = datetime.date.fromordinal(day)
                if order != "mdy" or new.day > 12:  # else it would be read day first
                    break
            wide = {"y": 4, "m": 2, "d": 2} if len(a) == 4 or len(a) == len(b) == 2 else {"y": 4, "m": 1, "d": 1}
            return mark.join(f"{dict(y=new.year, m=new.month, d=new.day)[x]:0{wide[x]}d}" for x in order)
        return None

    def text(self, text: str, inverse: bool = False) -> tuple[str, dict[str, int]]:
        """text with all values replaced, and how many of each kind."""
        counts: dict[str, int] = {}
        if not _MAYBE.search(text):
            return text, counts

        out, done, at = [], 0, 0
        while m := _FIND.search(text, at):
            kind = m.lastgroup
            value, kind = m[kind], "secret" if kind in ("quoted", "bare") else kind
            new = getattr(self, kind)(value, inverse)
            while new is None and kind == "iban" and " " in value:  # a word after it may look like a part of it
                value = value.rpartition(" ")[0]
                new = self.iban(value, inverse)
            if new is None:
                at = m.start() + 1  # another kind may begin inside
                continue
            counts[kind] = counts.get(kind, 0) + 1
            begin = m.start(m.lastgroup)
            out += (text[done:begin], new)
            done = at = begin + len(value)
        return "".join(out) + text[done:], counts


#: Known to this driver only.
_RANDOM_KEY = secrets.token_hex(32)


def _both(text: str) -> bool:
    return not text.isdigit() and any(c.isdigit() for c in text)


def _luhn(body: str) -> str:
    """The check digit of body."""
    total = sum((2 * int(d) - 9 * (d > "4")) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(body)))
    return str(-total % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def default_key() -> bytes:
    """LOOMSPARK_PII_KEY of the driver. Where it is unset, a random key for as long as the driver runs: equal values are
    linked within its results, and nobody can invert them. Set it to link results of several runs."""
    return os.environ.get("LOOMSPARK_PII_KEY", _RANDOM_KEY).encode()


def pseudonymize(df: DataFrame, key: bytes, text_col: str = "text", *, out_col: str | None = None, count_prefix: str | None = "n_") -> DataFrame:
    """df with the texts' values replaced in out_col (default: text_col itself), and a count of each kind."""
    bounded_batches(df.sparkSession)
    kind = pa.struct([("text", pa.string()), *((k, pa.int64()) for k in KINDS)])

    def replaced(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = Pseudonyms(key)
        for batch in batches:
            texts, counts = [], []
            for value in batch:
                text, found = (None, {}) if not value.is_valid else names.text(value.as_py())
                texts.append(text)
                counts.append(found)
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), *(pa.array([c.get(k, 0) for c in counts], pa.int64()) for k in KINDS)], fields=list(kind))

    out_col = out_col or text_col
    counted = [] if count_prefix is None else [f"{count_prefix}{k}" for k in KINDS]
    kept = [c for c in without(df, out_col, *counted).columns]
    done = F.arrow_udf(replaced, "struct<text:string," + ",".join(f"{k}:bigint" for k in KINDS) + ">")(F.col(text_col))
    plain = [F.col(f"`{c}`") for c in kept]
    own = free_name(df.columns, "done__")
    return df.select(*plain, done.alias(own)).select(*plain, F.col(f"{own}.text").alias(out_col), *(F.col(f"{own}.{k}").alias(c) for k, c in zip(KINDS, counted)))


def op6_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sum((F.col(f"n_{k}") for k in KINDS[1:]), F.col(f"n_{KINDS[0]}"))
    return pseudonymize(docs, default_key()).withColumn("changed", found > 0)
