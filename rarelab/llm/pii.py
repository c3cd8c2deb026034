"""Format-preserving pseudonyms for personal data by keyed Feistel permutations.

Each kind of value - e-mail addresses, payment card numbers, IBANs, telephone
numbers, social security numbers, IPv4 addresses and dates - is recognised by
its form, validated, and replaced by the image of a permutation of all values of
that form.  The permutation depends on the key and the kind alone, so equal
values get equal pseudonyms in every document, different values different ones,
and whoever holds the key can go back.  Values that are not valid after a round
of the permutation are walked on until they are (cycle walking), so a date stays
a date.  Punctuation, spacing and letter case stay in place.

Cards and IBANs may stand beside other groups of digits, so which groups are one
is read off the checks of all windows of groups.  Their permutations keep what
each group adds to those checks (for cards the Luhn sums of the group at an even
and at an odd place, for IBANs the group modulo 97): whatever is replaced, every
window passes or fails as before.  So a value has one pseudonym in every
neighbourhood, and the way back finds the same windows."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.llm.common import column, map_arrow, pieces

ROUNDS = 8
#: Digits in the groups of printed card numbers; the first two come before longer ones.
CARD_FORMS = [(4, 4, 4, 4), (4, 6, 5), (4, 4, 4, 4, 3), (6, 13), (4, 4, 4, 4, 2), (8, 8), (5, 5, 5), (4, 6, 4), (4, 4, 5)]
_FORMS_FROM = {first: [f for f in CARD_FORMS if f[0] == first] for first in {f[0] for f in CARD_FORMS}}
#: Characters of an IBAN by country.
IBAN_SIZES = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 TN24 "
    "TR26 UA29 VA22 VG24 XK20").split()}
_DIGITS, _GROUPS = re.compile("[0-9]+"), re.compile("[A-Z0-9]+")
_IBAN_HEAD = re.compile(r"(?<![A-Z0-9])[A-Z]{2}(?=[0-9]{2})")
_IBAN_FORM = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
#: A country code: as printed apart, else by the plan of the ITU.
_COUNTRY = re.compile(r"\+([0-9]{1,3}(?=[ .(-])|[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})")
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


class Permutation:
    """A keyed bijection of ``0 .. size - 1``: a balanced Feistel network on
    the next even number of bits, walked until it lands inside."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.seed = blake2b(f"{kind}:{size}".encode(), key=key, digest_size=32).digest()

    def _round(self, i: int, x: int) -> int:
        width = (self.half + 7) // 8
        h = blake2b(x.to_bytes(width, "big"), key=self.seed, salt=bytes([i]), digest_size=min(64, width))
        return int.from_bytes(h.digest(), "big") & ((1 << self.half) - 1)

    def _once(self, x: int) -> int:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for i in range(ROUNDS):
            left, right = right, left ^ self._round(i, right)
        return (left << self.half) | right

    def _back(self, x: int) -> int:
        left, right = x >> self.half, x & ((1 << self.half) - 1)
        for i in reversed(range(ROUNDS)):
            left, right = right ^ self._round(i, left), left
        return (left << self.half) | right

    def apply(self, x: int, valid: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """The image (``back``: the origin) of ``x``; with ``valid``, of the bijection of the valid
        numbers that ``x`` must be one of."""
        step = self._back if back else self._once
        while True:
            x = step(x)
            if x < self.size and (valid is None or valid(x)):
                return x


@lru_cache(256)
def _permutation(key: bytes, kind: str, size: int) -> Permutation:
    return Permutation(key, kind, size)


def _digits(key: bytes, kind: str, s: str, back: bool, valid: Callable[[str], bool] | None = None) -> str:
    n = len(s)
    check = (lambda x: valid(f"{x:0{n}d}")) if valid else None
    return f"{_permutation(key, kind, 10 ** n).apply(int(s), check, back):0{n}d}"


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in turn."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def luhn_digit(body: str) -> str:
    """The check digit that makes ``body`` plus it pass the Luhn test."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


@lru_cache(1 << 16)
def _luhn_sums(group: str) -> tuple[int, int]:
    """What a group adds to a Luhn sum where its last digit counts once, and where it counts twice."""
    sums = [0, 0]
    for i, c in enumerate(reversed(group)):
        d = int(c)
        twice = 2 * d - 9 * (d > 4)
        sums[i % 2] += d
        sums[1 - i % 2] += twice
    return sums[0] % 10, sums[1] % 10


def _card_valid(groups: list[str]) -> bool:
    """The Luhn test over whole groups; zeros alone are no card."""
    total = odd = 0
    for g in reversed(groups):
        total += _luhn_sums(g)[odd]
        odd ^= len(g) & 1
    return total % 10 == 0 and any(g.strip("0") for g in groups)


@lru_cache(32)
def _card_cuts(n: int) -> tuple[int, ...]:
    """The edges inside a card of ``n`` digits that any of its printed forms has, else every fourth; six digits
    between two of them are halved, so that the classes stay small."""
    edges = {sum(f[:i]) for f in CARD_FORMS if sum(f) == n for i in range(1, len(f))} or set(range(4, n, 4))
    ends = sorted({0, n} | edges)
    edges |= {(a + b) // 2 for a, b in zip(ends[:-1], ends[1:], strict=True) if b - a > 5}
    return tuple(sorted(edges))


@lru_cache(8)
def _card_classes(size: int) -> tuple[list[int], dict[tuple[int, int], list[int]]]:
    """For groups of ``size`` digits but zero: each one's place among those with the same Luhn sums, and these."""
    place, members = [-1] * 10 ** size, {}
    for x in range(1, 10 ** size):
        alike = members.setdefault(_luhn_sums.__wrapped__(f"{x:0{size}d}"), [])
        place[x] = len(alike)
        alike.append(x)
    return place, members


def _card(key: bytes, text: str, back: bool) -> str:
    """Each group between :func:`_card_cuts` becomes another with its Luhn sums, all of them permuted together;
    a group of zeros stays one."""
    s = "".join(c for c in text if c.isdigit())
    edges = (0, *_card_cuts(len(s)), len(s))
    parts = [s[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    live = [p for p in parts if p.strip("0")]
    alike = [_card_classes(len(p))[1][_luhn_sums(p)] for p in live]
    x, total = 0, 1
    for p, m in zip(live, alike, strict=True):
        x, total = x * len(m) + _card_classes(len(p))[0][int(p)], total * len(m)
    kind = "card" + ",".join(f"{len(p)}.{_luhn_sums(p) if p.strip('0') else 0}" for p in parts)
    x = _permutation(key, kind, total).apply(x, None, back)
    new = []
    for p, m in zip(reversed(live), reversed(alike), strict=True):
        x, r = divmod(x, len(m))
        new.append(f"{m[r]:0{len(p)}d}")
    return _refill(text, "".join(new.pop() if p.strip("0") else p for p in parts))


def _card_splits(stretch: str) -> list[tuple[int, int]]:
    """The cards in a stretch of digit groups, the likeliest first: printed forms between any two
    edges of groups (a known form, so digits beside a card do not change what is taken).  Only a stretch whose
    groups have no such form anywhere may be a card as a whole."""
    groups = [(m.group(), m.start(), m.end()) for m in _DIGITS.finditer(stretch)]
    texts, sizes = [g for g, _, _ in groups], [len(g) for g, _, _ in groups]
    found, known = [], False
    for i, size in enumerate(sizes):
        forms = _FORMS_FROM.get(size, ())
        if 13 <= size <= 19:
            forms = [(size,), *forms]
        for form in forms:
            j = i + len(form)
            if tuple(sizes[i:j]) == form:
                known = True
                if _card_valid(texts[i:j]):
                    first = len(form) == 1 or form in CARD_FORMS[:2]
                    found.append((not first, -sum(form), groups[i][1], groups[j - 1][2]))
    if not known and len(groups) > 1 and 13 <= sum(sizes) <= 19 and _card_valid(texts):
        found.append((False, 0, 0, len(stretch)))
    return [(lo, hi) for _, _, lo, hi in sorted(found)]


def _iban_remainder(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97


def _mixed(key: bytes, kind: str, s: str, back: bool) -> str:
    """Letters (either case) and digits of ``s`` permuted together, each within its own set."""
    sizes = [10 if c.isdigit() else 26 for c in s]
    x, total = 0, 1
    for c, size in zip(s, sizes, strict=True):
        x, total = x * size + (int(c) if size == 10 else ord(c.lower()) - 97), total * size
    form = kind + "".join("d" if size == 10 else "a" for size in sizes)
    x = _permutation(key, form, total).apply(x, None, back)
    out = []
    for c, size in zip(reversed(s), reversed(sizes), strict=True):
        x, r = divmod(x, size)
        new = str(r) if size == 10 else chr(97 + r)
        out.append(new.upper() if c.isupper() else new)
    return "".join(reversed(out))


def _iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and _iban_remainder(s) == 1 and 2 <= int(s[2:4]) <= 98


@lru_cache(32)
def _iban_classes(shape: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of a shape (``d`` digit, ``a`` letter) by number: their residues modulo 97 as an IBAN reads them, the
    groups in order of residue, and where each residue starts there."""
    value = np.zeros(1, dtype=np.int64)
    for c in shape:
        one = np.arange(10) if c == "d" else np.arange(10, 36)
        value = (value[:, None] * (10 if c == "d" else 100) + one).ravel() % 97
    order = np.argsort(value, kind="stable")
    return value, order, np.searchsorted(value[order], np.arange(98))


def _iban(key: bytes, text: str, back: bool) -> str:
    """Every group of four behind the first becomes another of its shape and residue modulo 97, all of them
    permuted together; so the check digits stay right.  A group that could start an IBAN stays as it is."""
    s = text.replace(" ", "")
    parts = [s[i:i + 4] for i in range(4, len(s), 4)]
    live, x, total = [], 0, 1
    for p in parts:
        shape = "".join("d" if c.isdigit() else "a" for c in p)
        if shape == "aadd":
            live.append(None)
            continue
        number = 0
        for c in p:
            number = number * (10 if c.isdigit() else 26) + (int(c) if c.isdigit() else ord(c) - 65)
        value, order, starts = _iban_classes(shape)
        lo, hi = starts[value[number]], starts[value[number] + 1]
        live.append((shape, order[lo:hi], int(value[number])))
        x, total = x * int(hi - lo) + int(np.searchsorted(order[lo:hi], number)), total * int(hi - lo)
    kind = f"iban{s[:4]}" + ",".join("=" + p if v is None else f"{v[0]}{v[2]}" for p, v in zip(parts, live, strict=True))
    x = _permutation(key, kind, total).apply(x, None, back)
    new = []
    for p, v in zip(reversed(parts), reversed(live), strict=True):
        if v is not None:
            x, r = divmod(x, len(v[1]))
            number, p = int(v[1][r]), ""
            for c in reversed(v[0]):
                number, d = divmod(number, 10 if c == "d" else 26)
                p = (str(d) if c == "d" else chr(65 + d)) + p
        new.append(p)
    return _refill(text, s[:4] + "".join(reversed(new)))


def _iban_splits(stretch: str) -> list[tuple[int, int]]:
    """The IBANs in a stretch of groups: of their country's length first, then the longest."""
    ends = [m.end() for m in _GROUPS.finditer(stretch)]
    found = []
    for m in _IBAN_HEAD.finditer(stretch):
        at = bisect_right(ends, m.start())
        for hi in ends[at:at + 12]:  # a whole IBAN has nine groups at most
            if hi - m.start() > 45:
                break
            if _IBAN_FORM.fullmatch(stretch, m.start(), hi) and _iban_valid(stretch[m.start():hi]):
                size = hi - m.start() - stretch.count(" ", m.start(), hi)
                found.append((IBAN_SIZES.get(m.group()) != size, -size, m.start(), hi))
    return [(lo, hi) for _, _, lo, hi in sorted(found)]


def _stretch(key: bytes, stretch: str, back: bool, splits, rewrite) -> list[tuple[int, int, str]]:
    """The values inside a stretch of groups and what replaces them: in the order of ``splits``, all that are free."""
    used, out = bytearray(len(stretch)), []
    for lo, hi in splits(stretch):
        if not any(used[lo:hi]):
            used[lo:hi] = b"\1" * (hi - lo)
            out.append((lo, hi, rewrite(key, stretch[lo:hi], back)))
    return out


def _national(s: str) -> bool:
    """Ten digits of the North American plan: area and exchange start at 2."""
    return s[0] > "1" and s[3] > "1"


def _phone(key: bytes, m: re.Match, back: bool) -> str | None:
    s = re.sub(r"\D", "", m.group())
    country = m.group("cc") or ""
    rest = s[len(country):]
    plan = country in ("", "1") and len(rest) == 10
    # with a country code, or the area in brackets, ten digits outside the plan are a number all the same
    if not 8 <= len(s) <= 15 or not (plan or country) or (m.group("bare") and not country and not _national(rest)):
        return None
    return _refill(m.group(), country + _subscriber(key, country or "1", rest, back))


def _subscriber(key: bytes, country: str, rest: str, back: bool) -> str:
    plan = country == "1" and len(rest) == 10
    valid = None if not plan else _national if _national(rest) else lambda x: not _national(x)
    return _digits(key, "phone" + country, rest, back, valid)


def _abroad(key: bytes, text: str, back: bool) -> str:
    country = _COUNTRY.match(text).group(1)
    return _refill(text, country + _subscriber(key, country, re.sub(r"\D", "", text)[len(country):], back))


def _abroad_splits(stretch: str) -> list[tuple[int, int]]:
    """The number that starts a stretch of groups behind a plus: as many groups as 15 digits hold (ten digits
    behind the 1), never other ones for other digits, so the way back finds the same."""
    first = _COUNTRY.match(stretch)
    if first is None:
        return []
    ends = [m.end() for m in re.finditer(r"[0-9]+\)?", stretch) if m.end() > first.end() and stretch[m.end() - 1] != ")"]
    size = {hi: sum(c.isdigit() for c in stretch[:hi]) for hi in ends}
    fits = [hi for hi in ends if 8 <= size[hi] <= 15]
    exact = [hi for hi in fits if first.group(1) == "1" and size[hi] == 11]
    return [(0, hi) for hi in (exact or fits[-1:])]


def _us_number(s: str) -> bool:
    return s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"


def _ssn(key: bytes, m: re.Match, back: bool) -> str | None:
    s = re.sub(r"\D", "", m.group())
    return _refill(m.group(), _digits(key, "ssn", s, back, _us_number)) if _us_number(s) else None


def _host(x: int) -> bool:
    """An address with a first part from 1 to 223."""
    return 1 <= x >> 24 <= 223


def _ipv4(key: bytes, m: re.Match, back: bool) -> str | None:
    parts = m.group().split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = int.from_bytes(bytes(map(int, parts)), "big")
    if not _host(x):
        return None
    x = _permutation(key, "ipv4", 1 << 32).apply(x, _host, back)
    return ".".join(str(b) for b in x.to_bytes(4, "big"))


def _date(key: bytes, m: re.Match, back: bool) -> str | None:
    if m.group("y"):
        y, sep, parts, day_first, year_first = m.group("y"), m.group("s"), (m.group("m"), m.group("d")), False, True
    else:
        y, sep, parts, year_first = m.group("y2"), m.group("s2"), (m.group("a"), m.group("b")), False
        # day first where the separator is a dot or the first number can be no month
        day_first = sep == "." or int(parts[0]) > 12
    mo, d = reversed(parts) if day_first else parts
    try:
        day = date(int(y), int(mo), int(d)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    perm = _permutation(key, "date", LAST_DAY - FIRST_DAY + 1)
    padded = all(len(p) == 2 for p in parts)

    def valid(x: int) -> bool:
        new = date.fromordinal(FIRST_DAY + x)
        # a form that is read month first must stay so: its day may not make the reader take it for a month
        if day_first and sep != "." and new.day <= 12:
            return False
        # with a part of one digit, both parts keep their number of digits
        return padded or ((new.month > 9) == (int(mo) > 9) and (new.day > 9) == (int(d) > 9))

    new = date.fromordinal(FIRST_DAY + perm.apply(day - FIRST_DAY, valid, back))
    shown = [f"{new.month:0{len(mo)}d}", f"{new.day:0{len(d)}d}"]
    if day_first:
        shown.reverse()
    year = f"{new.year:04d}"
    return sep.join([year, *shown] if year_first else [*shown, year])


def _email(key: bytes, m: re.Match, back: bool) -> str | None:
    local, domain = m.group().rsplit("@", 1)
    s = "".join(c for c in local if c.isalnum())
    if not s or not s.isascii():
        return None
    return _refill(local, _mixed(key, "email@" + domain.lower(), s, back)) + "@" + domain


#: Kinds whose pattern is a stretch of groups that may hold several values, or other groups beside one.
STRETCHES = {"iban": (_iban_splits, _iban), "card": (_card_splits, _card), "phone": (_abroad_splits, _abroad)}
#: Kind, pattern and rewriter, in the order in which they claim a stretch of text.
KINDS: list[tuple[str, str, Callable[[bytes, re.Match, bool], str | None] | None]] = [
    ("email", r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])", _email),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]*(?: [A-Z0-9]+)*(?!\w)", None),
    # behind a plus, 15 digits or fewer are a telephone number
    ("card", r"(?<![\w.-])(?:(?<!\+)|(?=\d{16}|(?:\d{4}[ -]){3}\d{4}))\d(?:[ -]?\d){12,}(?![\w-])", None),
    ("date", r"(?<![\w./-])(?:(?P<y>\d{4})(?P<s>[-/.])(?P<m>\d{1,2})(?P=s)(?P<d>\d{1,2})(?:(?=T\d)|(?![\w/-]))"
             r"|(?P<a>\d{1,2})(?P<s2>[-/.])(?P<b>\d{1,2})(?P=s2)(?P<y2>\d{4})(?![\w/-]))", _date),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)", _ipv4),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    ("phone", r"(?<![\w+])(?:\+(?P<cc>\d{1,3})[ .-]?)?(?:\(\d{3}\)[ .-]?|(?P<bare>\d{3}[ .-]))\d{3}[ .-]?\d{4}(?![\w-])",
     _phone),
    ("phone", r"(?<![\w+])\+\d+(?:(?:[ .-]?\(\d+\)[ .-]?|[ .-])\d+)*(?![\w-])", None),
]
NAMES = list(dict.fromkeys(name for name, _, _ in KINDS))
_COMPILED = [(name, re.compile(pattern, re.ASCII), rewrite) for name, pattern, rewrite in KINDS]


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with every valid value replaced, and the number of values of each kind.

    A stretch belongs to the first kind that claims it.  ``back`` undoes the
    replacement.  Text without such values is returned as it is."""
    spans: list[tuple[int, int, str]] = []
    found: dict[str, int] = {}
    shown = text
    for name, pattern, rewrite in _COMPILED:
        got: list[tuple[int, int, str]] = []
        for m in pattern.finditer(shown):
            if rewrite is None:
                lo = m.start()
                got += [(lo + a, lo + b, new) for a, b, new in _stretch(key, m.group(), back, *STRETCHES[name])]
            elif (new := rewrite(key, m, back)) is not None:
                got.append((*m.span(), new))
        if got:
            # what is claimed is no digit for the kinds that follow
            parts, at = [], 0
            for lo, hi, _ in sorted(got):
                parts += [shown[at:lo], "x" * (hi - lo)]
                at = hi
            shown = "".join([*parts, shown[at:]])
            spans += got
            found[name] = found.get(name, 0) + len(got)
    out, at = [], 0
    for lo, hi, new in sorted(spans):
        out += [text[at:lo], new]
        at = hi
    return "".join([*out, text[at:]]), found


def _rewriter(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts = column(piece, "text")
            counts = {name: [0] * len(texts) for name in NAMES}
            # every kind needs a digit or an @: the other texts pass untouched
            may = pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False).to_numpy(zero_copy_only=False)
            out = texts
            if may.any():
                changed = texts.to_pylist()
                for i in may.nonzero()[0]:
                    changed[i], found = pseudonymise(changed[i], key)
                    for name, n in found.items():
                        counts[name][i] = n
                out = pa.array(changed, pa.string())
            yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), out, *[pa.array(counts[n], pa.int32()) for n in NAMES]],
                                             ["doc_id", "text", *NAMES])
    return run


def pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, text, n_values`` and the number of values of each kind.

    ``text`` is the whole text with its personal data replaced; a null text
    stays null, an empty one empty, with no values.  ``key`` (16 to 64 bytes)
    is the caller's secret.  Nothing is shuffled; repeated rows are rewritten
    alike; an empty table gives an empty result."""
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = ", ".join(f"{n} int" for n in NAMES)
    out = map_arrow(rows, _rewriter(key), f"doc_id bigint, text string, {kinds}")
    total = sum((F.col(n) for n in NAMES[1:]), F.col(NAMES[0]))
    return out.select("doc_id", "text", total.alias("n_values"), *NAMES)
