"""Format-preserving pseudonyms for personal data.

Card, phone, tax and account numbers, network addresses, dates and the names of mail addresses are
found, validated, and permuted by a keyed Feistel network within their own format: a card number becomes
another card number with a right check digit, a date another date in the same notation. The permutation
depends on the kind, the value and the key only, so equal values stay equal in every document, however
they are written, and whoever holds the key can undo it.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import with_columns_of

ROUNDS = 10
#: Characters of a mail name that are permuted as one number; a longer name is permuted in pieces of this
#: many, each keyed by the pseudonym of the one before.
NAME = 64
KINDS = ("mail", "account", "date", "address", "card", "tax", "phone")

#: Shapes of what is looked for, tried in this order at each place.
SHAPES = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d)",
    "address": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "card": r"(?<![\d-])(?:\d{13,19}|\d{4}([ -])\d{4}\x01\d{4}\x01\d{1,7}|\d{4}([ -])\d{6}\x02\d{5})(?!\d|-\d)",
    "tax": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    "phone": (r"(?<![\d+-])(?:(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
              r"|\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5})(?!\d|-\d)"),
}


def _pattern() -> re.Pattern[str]:
    shapes = [f"(?P<{k}>{s})" for k, s in SHAPES.items()]
    joined = "|".join(shapes)
    # the two separators inside the card shape are groups of the joined pattern
    before = re.compile("|".join(shapes[: list(SHAPES).index("card")])).groups
    return re.compile(joined.replace("\x01", "").replace(r"\x01", f"\\{before + 2}").replace(r"\x02", f"\\{before + 3}"), re.ASCII)


#: Characters of an account number by country.
IBAN_LENGTHS = {k: int(n) for n, ks in (x.split(":") for x in """15:NO 16:BE 18:DK,FI,FO,GL,NL,SD 19:MK,SI
20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL
24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM
28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU""".split()) for k in ks.split(",")}
#: Digits of a phone number, at the most, by country code.
PHONE_DIGITS = {"1": 11, "7": 11, "30": 12, "31": 11, "32": 11, "33": 11, "34": 11, "351": 12, "353": 12, "41": 11,
                "44": 12, "45": 10, "46": 11, "47": 10, "48": 11, "61": 11, "86": 13, "91": 12}


class Permutation:
    """Keyed permutations of the numbers below any bound (a balanced-digit Feistel network, and further
    steps along the cycle while a result falls outside)."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, width: int, i: int, half: int) -> int:
        data, size = f"{kind}|{width}|{i}|{half}".encode(), 16 + width // 2
        out = b""
        while len(out) < size:  # a digest has 64 bytes at the most; further ones are numbered
            more = f"|{len(out)}".encode() if out else b""
            out += hashlib.blake2b(data + more, key=self.key, digest_size=min(64, size - len(out))).digest()
        return int.from_bytes(out, "big")

    def _digits(self, kind: str, width: int, x: int, back: bool) -> int:
        """A permutation of the numbers of ``width`` >= 2 decimal digits."""
        left, right = width // 2, width - width // 2
        mods = (10**left, 10**right)
        a, b = divmod(x, mods[1])
        sides = [a, b]
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            own = i % 2
            f = self._round(kind, width, i, sides[1 - own])
            sides[own] = (sides[own] - f if back else sides[own] + f) % mods[own]
        return sides[0] * mods[1] + sides[1]

    def permute(self, kind: str, bound: int, x: int, back: bool = False,
                inside: Callable[[int], bool] | None = None) -> int:
        """``x`` below ``bound`` to another such number, among those for which ``inside`` answers as for x."""
        width = max(2, len(str(bound - 1)))
        wanted = inside(x) if inside else None
        while True:
            x = self._digits(kind, width, x, back)
            if x < bound and (inside is None or inside(x) == wanted):
                return x


def luhn(digits: str) -> int:
    """Check digit for a number without one."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _refill(shape: str, digits: str) -> str:
    """The digits of ``shape`` replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isascii() and c.isdigit() else c for c in shape)


def _only_digits(s: str) -> str:
    return "".join(c for c in s if c.isascii() and c.isdigit())


def _card(p: Permutation, s: str, back: bool) -> str | None:
    d = _only_digits(s)
    if d[-1] != str(luhn(d[:-1])):
        return None
    n = len(d) - 2  # the first digit tells the issuer's branch and stays
    body = d[0] + str(p.permute(f"card{d[0]}", 10**n, int(d[1:-1]), back)).zfill(n)
    return _refill(s, body + str(luhn(body)))


def _country(digits: str) -> str:
    """The country code that a number begins with, if it is among those of known length."""
    return next((c for c in PHONE_DIGITS if digits.startswith(c)), "")


def _phone(p: Permutation, s: str, back: bool) -> str | None:
    d = _only_digits(s)
    if len(d) == 10 and s[0] != "+" or len(d) == 11 and d[0] == "1":
        n = d[-10:]  # numbers of the numbering plan stay in it, others outside
        new = p.permute("phone", 10**10, int(n), back, lambda x: x // 10**9 > 1 and x // 10**6 % 10 > 1)
        return _refill(s, d[:-10] + str(new).zfill(10))
    if not 8 <= len(d) <= 15:
        return None
    # the country code says where the number ends, so a known one stays and others stay unknown
    code = _country(d)
    kept = code or d[0]
    n = len(d) - len(kept)
    new = p.permute(f"phone{len(d)}{kept}", 10**n, int(d[len(kept) :]), back,
                    None if code else lambda x: not _country(kept + str(x).zfill(n)))
    return _refill(s, kept + str(new).zfill(n))


def _address(p: Permutation, s: str, back: bool) -> str | None:
    parts = [int(x) for x in s.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    x = int.from_bytes(bytes(parts), "big")
    new = p.permute("address", 1 << 32, x, back, lambda v: 1 <= v >> 24 <= 223)
    return ".".join(str(b) for b in new.to_bytes(4, "big"))


def _tax(p: Permutation, s: str, back: bool) -> str | None:
    def real(x: int) -> bool:
        area = x // 10**6
        return area not in (0, 666) and area < 900 and x // 10**4 % 100 > 0 and x % 10**4 > 0

    x = int(_only_digits(s))
    if not real(x):
        return None
    return _refill(s, str(p.permute("tax", 10**9, x, back, real)).zfill(9))


def _account(p: Permutation, s: str, back: bool) -> str | None:
    flat = s.replace(" ", "")

    def rest(country: str, body: str) -> int:
        return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97

    if not 15 <= len(flat) <= 34 or 98 - rest(flat[:2], flat[4:]) != int(flat[2:4]):
        return None
    digits = _only_digits(flat[4:])
    if len(digits) < 2:
        return None
    shape = "".join("0" if c.isdigit() else c for c in flat[4:])
    new = str(p.permute(f"account{flat[:2]}{shape}", 10 ** len(digits), int(digits), back)).zfill(len(digits))
    body = _refill(flat[4:], new)
    it = iter(flat[:2] + f"{98 - rest(flat[:2], body):02d}" + body)
    return "".join(c if c == " " else next(it) for c in s)


_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _date(p: Permutation, s: str, back: bool) -> str | None:
    mark = next(c for c in s if not c.isdigit())
    parts = s.split(mark)
    if mark == "-":
        order = (0, 1, 2)
    elif mark == "." or int(parts[0]) > 12:
        order = (2, 1, 0)
    else:
        order = (2, 0, 1)
    try:
        day = datetime.date(*(int(parts[i]) for i in order)).toordinal()
    except ValueError:
        return None
    # month/day/year reads back as such whatever the day; day/month/year only with a day over 12
    late = mark == "/" and order == (2, 1, 0)
    last = datetime.date.max.toordinal()

    def like(x: int) -> bool:
        return _FIRST <= x <= _LAST and (not late or datetime.date.fromordinal(x).day > 12)

    if not like(day):
        return None
    new = datetime.date.fromordinal(p.permute("late" if late else "date", last, day, back, like))
    narrow = any(len(parts[i]) == 1 for i in order[1:])
    out = [""] * 3
    for i, v in zip(order, (new.year, new.month, new.day)):
        out[i] = f"{v:04d}" if i == order[0] else str(v) if narrow else f"{v:02d}"
    return mark.join(out)


_LETTERS = {"a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0": "0123456789"}


def _name(p: Permutation, kind: str, s: str, back: bool) -> str:
    """Letters and digits of a piece of a mail name to others; its other characters stay."""
    shape = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in s)
    sets = [_LETTERS.get(c, "") for c in shape]
    bound, x = 1, 0
    for c, own in zip(s, sets):
        if own:
            bound, x = bound * len(own), x * len(own) + own.index(c)
    if bound == 1:
        return s
    x = p.permute(f"{kind}{shape}", bound, x, back)
    out = []
    for c, own in zip(reversed(s), reversed(sets)):
        if own:
            x, r = divmod(x, len(own))
            c = own[r]
        out.append(c)
    return "".join(reversed(out))


def _mail(p: Permutation, s: str, back: bool) -> str | None:
    name, at, host = s.rpartition("@")
    if not any(c.isalnum() for c in name):
        return None
    kind, out = "mail", []
    for i in range(0, len(name), NAME):
        piece = name[i : i + NAME]
        out.append(_name(p, kind, piece, back))
        kind = f"mail{i}|{piece if back else out[-1]}|"
    return "".join(out) + at + host


_HOW = {"mail": _mail, "account": _account, "date": _date, "address": _address, "card": _card, "tax": _tax,
        "phone": _phone}


class Pseudonymiser:
    def __init__(self, key: str, back: bool = False):
        self.permutation, self.back = Permutation(key.encode()), back
        self.pattern, self.any = _pattern(), re.compile(r"[0-9@]")

    def replace(self, text: str | None) -> tuple[str | None, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        counts = dict.fromkeys(KINDS, 0)
        if not text or not self.any.search(text):
            return text, counts

        out: list[str] = []
        at = 0  # what lies before is in out
        scan = 0
        while m := self.pattern.search(text, scan):
            kind = m.lastgroup
            scan = m.end()
            for end in self._ends(kind, m):
                new = _HOW[kind](self.permutation, text[m.start() : end], self.back)
                if new is not None:
                    counts[kind] += 1
                    out += text[at : m.start()], new
                    at = scan = end
                    break
        out.append(text[at:])
        return "".join(out), counts

    @staticmethod
    def _ends(kind: str, m: re.Match[str]) -> list[int]:
        """Where a value may end: the match's end, or a border of groups inside it, as a match takes what
        follows the value along. An account of a known country has the length it has there."""
        s = m.group()
        if kind not in ("account", "phone"):
            return [m.end()]
        if kind == "phone" and not s.startswith("+"):
            return [m.end()]
        borders = [len(s), *(b.start() for b in reversed(list(re.finditer(r"[ .-]\(?" if kind == "phone" else " ", s))))]
        if kind == "account":
            if size := IBAN_LENGTHS.get(s[:2]):
                borders = [i for i in borders if len(s[:i].replace(" ", "")) == size]
        elif size := PHONE_DIGITS.get(_country(_only_digits(s))):
            borders = [i for i in borders if len(_only_digits(s[:i])) <= size] or borders
        return [m.start() + i for i in borders]


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", back: bool = False) -> DataFrame:
    """All columns of ``docs``, with pseudonyms in the text, and n_mails, n_accounts, n_dates,
    n_addresses, n_cards, n_taxes, n_phones (long): values replaced.

    ``back``: undo pseudonyms made with the same key. A null text stays null and counts 0, an empty one
    stays empty. A date keeps its notation, but for leading zeros of day and month where the source
    has none. Values that fail validation (check digits, octets, calendar days from 1900 to 2099,
    lengths) or are written in other than ASCII digits stay as they are. Texts of any length are read whole; repeated rows, null and repeated
    ids are treated row by row; an empty table gives no rows. An input column with the name of a result
    column (in any case) is replaced by it.
    """
    names = {k: "n_" + {"address": "addresses", "tax": "taxes"}.get(k, k + "s") for k in KINDS}
    fields = ", ".join(["__text string", *(f"__{n} long" for n in names.values())])

    def run(part: pa.RecordBatch) -> list[pa.Array]:
        who = Pseudonymiser(key, back)
        rows = [who.replace(t) for t in part.column(text_col).to_pylist()]
        return [pa.array([t for t, _ in rows], pa.string()),
                *[pa.array([c[k] for _, c in rows], pa.int64()) for k in names]]

    clash = {n.lower() for n in names.values()}
    columns = [c for c in docs.columns if c.lower() not in clash]
    got = with_columns_of(docs.select(*[F.col(f"`{c}`") for c in columns]), text_col, fields, run)
    return got.select(*[F.col("__text").alias(c) if c == text_col else F.col(f"`{c}`") for c in columns],
                      *[F.col(f"__{n}").alias(n) for n in names.values()])
