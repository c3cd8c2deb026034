"""Secrets in texts: fixed forms, and credential values that are costly to guess.

Three forms are found by pattern alone: assignments of a credential's name,
access keys and long hexadecimal numbers.  Beyond them every value that stands
where a credential is expected (behind `password:`, `PGPASSWORD=`, `Bearer`, in
`//user:value@host`) is judged by how many guesses an attacker needs: dynamic
programming finds the cheapest way to cut the value into words, dates, repeats,
keyboard walks and spans of brute force, and a value whose cheapest cut still
costs too much is a secret.  `password: sunshine1` is not one, `pwd = 'Xk#9$mQ!w2Lp'` is.

The word list is a tokenizer's vocabulary: its ids rise with falling frequency,
so an id serves as the rank of a word, and the list is the same in every task."""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from math import comb, inf, log10

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelab.llm.common import column, map_arrow, pieces

KINDS = ("assign", "access", "hex", "guess")  # the last is the method's own
LEAST_GUESSES = 10.0  # log10 of the guesses from which a value is a secret
LEAST_VALUE = 6  # characters of a value that is judged

# The base patterns and the lengths they need.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16

_NAMES = (r"(?:(?<![a-z])(?:pass|pwd|auth)|pass(?:word|wd|phrase|code)|secret|token|api[_-]?key|access[_-]?key|"
          r"private[_-]?key|credentials?|authorization)")
#: Where a value is expected, without white space in it: behind a credential's name and a sign, bare or quoted;
#: behind "Bearer"; before the host of an address.
CONTEXTS = [re.compile(p, re.A | re.I) for p in (
    rf"""{_NAMES}["']?\x20{{0,8}}(?::=|=>|[:=])\x20{{0,8}}"""
    r"""(?:"(?P<double>[^"\s]+)"|'(?P<single>[^'\s]+)'|`(?P<back>[^`\s]+)`|(?P<plain>[^\s"'`,;<>()\[\]{}]+))""",
    r"""\bbearer\x20+(?P<bearer>[A-Za-z0-9+/_.=~-]+)""",
    r"""://[^\s/:@]{1,256}:(?P<address>[^\s/@]+)@""")]
_ADDRESS = re.compile(r"[a-z][a-z0-9+.-]*://", re.A | re.I)
#: What any of the patterns needs somewhere in the text (RE2, ASCII letters in either case).
_HINT = r"(?i:pass|pwd|secret|token|key|credential|auth|bearer|://)|AKIA|[0-9a-f]{32}"

LEET = {"4": "a", "@": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t", "+": "t"}
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
#: Words that people choose; they rank before the vocabulary.
COMMON = ("password", "qwerty", "letmein", "admin", "welcome", "monkey", "dragon", "master", "login", "princess", "sunshine",
          "football", "iloveyou", "secret", "changeme", "default", "example", "test", "user", "root", "guest", "hello", "pass",
          "your", "here", "none", "null", "true", "false", "xxx")
PIECE = log10(2)  # an attacker must also try how a value is cut
LONGEST_UNIT = 16  # characters of a repeated unit
LONGEST_WORD = 24  # characters of a word of the list
_DATES = [(re.compile(p, re.A), order) for p, order in (
    (r"((?:19|20)\d\d)([-./_]?)(\d\d)\2(\d\d)", "ymd"), (r"(\d\d)([-./_]?)(\d\d)\2((?:19|20)\d\d)", "dmy"),
    (r"(\d\d)([-./_])(\d\d)\2(\d\d)", "dmy"), (r"(\d\d)()(\d\d)(\d\d)", "dmy"))]
_YEAR = re.compile(r"(?:19|20)[0-9]{2}")
SPANS = ("force", "word", "date", "walk", "repeat")
_, WORD, DATE, WALK, REPEAT = range(5)


def keyboard() -> dict[str, tuple[int, int]]:
    """The place of every key: its row, and its column in half keys (the letters start beside the digit 1)."""
    return {c: (r, 2 * i + r + 2 * (r > 0)) for r, row in enumerate(ROWS) for i, c in enumerate(row)}


KEYS = keyboard()


def vocabulary(path: str) -> list[str]:
    """Words of a tokenizer file that start behind a space, by id: the frequent first."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    ends = any(t.endswith("</w>") for t in vocab)
    words = (t.removesuffix("</w>") if ends else t[1:] for t, _ in sorted(vocab.items(), key=lambda x: x[1])
             if (t.endswith("</w>") if ends else t.startswith(("Ġ", "▁"))))
    return list(dict.fromkeys(w.lower() for w in words if len(w) > 2 and w.isalpha() and w.isascii()))


def _size(c: str) -> int:
    """Characters of the same class."""
    return 10 if c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100


def _cases(word: str) -> float:
    """log10 of the ways to choose its capitals: none, the first, all, or so many anywhere."""
    upper = sum(c.isupper() for c in word)
    if upper == 0:
        return 0.0
    if word[1:].islower() or word.isupper() or upper == 1 and word[-1].isupper():
        return log10(2)
    lower = sum(c.islower() for c in word)
    return log10(sum(comb(upper + lower, i) for i in range(1, min(upper, lower) + 1)) + 1)


class GuessCost:
    """log10 of the guesses that a value needs, by the cheapest cut."""

    def __init__(self, words: list[str]):
        self.rank = {w: i + 1 for i, w in enumerate(dict.fromkeys((*COMMON, *words))) if len(w) <= LONGEST_WORD}
        self.longest = max(map(len, self.rank), default=0)

    def cost(self, value: str) -> float:
        return self.cut(value)[0]

    def cut(self, value: str) -> tuple[float, list[tuple[str, str]]]:
        """``(cost, [(kind, span), ...])`` of the cheapest cut; time and memory grow with the value's length.

        Repeats and walks are taken as far to the left as they go, whole units of a repeat."""
        n = len(value)
        best, back, kinds = array("d", [0.0]) * (n + 1), array("q", [0]) * (n + 1), bytearray(n + 1)
        force = inf  # brute force adds a character at a time: the best cut that ends in such a span
        for hi, found in enumerate(self._ending(value), 1):
            step = log10(_size(value[hi - 1]))
            if best[hi - 1] + PIECE < force:
                force, start = best[hi - 1] + PIECE, hi - 1
            force += step
            best[hi], back[hi], kinds[hi] = force, start, 0
            for lo, kind, cost in found:
                if best[lo] + PIECE + cost < best[hi]:
                    best[hi], back[hi], kinds[hi] = best[lo] + PIECE + cost, lo, kind
        spans, at = [], n
        while at:
            spans.append((SPANS[kinds[at]], value[back[at]:at]))
            at = back[at]
        return best[n], spans[::-1]

    def _ending(self, value: str) -> Iterator[list[tuple[int, int, float]]]:
        """For every place in turn the spans that end there, ``(start, kind, cost)``, but for brute force."""
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
        plain = "".join(LEET.get(c, c) for c in low)
        walk, turns, last = 0, 0, None
        units = range(1, min(LONGEST_UNIT, len(value) // 2) + 1)
        run, costs = [0] * (len(units) + 1), [{} for _ in range(len(units) + 1)]
        for hi in range(1, len(value) + 1):
            found = list(self._words(value, low, plain, hi))
            if value[hi - 1].isdigit():
                found += _dates(value, hi)
            # a walk over neighbouring keys costs its first key, its length and its turns
            move = _move(low[hi - 2], low[hi - 1]) if hi > 1 else None
            if move is None:
                walk, turns, last = hi - 1, 0, None
            else:
                turns, last = turns + (move != last), move
                if hi - walk >= 3:
                    found.append((walk, WALK, log10(len(KEYS) * (hi - walk)) + turns * log10(6) + _cases(value[walk:hi])))
            # repeats of a unit, from the first places of a run with its period
            for unit in units:
                if hi > unit and value[hi - 1] == value[hi - 1 - unit]:
                    run[unit] += 1
                    if run[unit] >= unit:
                        times, part = run[unit] // unit + 1, value[hi - unit:hi]
                        if part not in costs[unit]:
                            costs[unit][part] = self.cost(part)
                        found.append((hi - times * unit, REPEAT, costs[unit][part] + log10(times)))
                elif run[unit]:
                    run[unit], costs[unit] = 0, {}
            yield found

    def _words(self, value: str, low: str, plain: str, hi: int) -> Iterator[tuple[int, int, float]]:
        for lo in range(max(0, hi - self.longest), hi - 2):
            if rank := self.rank.get(low[lo:hi]):
                yield lo, WORD, log10(rank) + _cases(value[lo:hi])
            elif rank := self.rank.get(plain[lo:hi]):
                changed = sum(a != b for a, b in zip(low[lo:hi], plain[lo:hi], strict=True))
                yield lo, WORD, log10(rank) + _cases(value[lo:hi]) + changed * log10(2)


def _dates(value: str, hi: int) -> Iterator[tuple[int, int, float]]:
    """Years and dates that end at a place."""
    if hi >= 4 and _YEAR.fullmatch(value, hi - 4, hi):
        yield hi - 4, DATE, log10(max(abs(int(value[hi - 4:hi]) - 2000), 20))
    for lo in (hi - 6, hi - 8, hi - 10):
        for pattern, order in _DATES if lo >= 0 else ():
            if m := pattern.fullmatch(value, lo, hi):
                a, sign, b, c = m.groups()
                year, month, day = (a, b, c) if order == "ymd" else (c, b, a)
                if order == "dmy" and int(month) > 12:
                    month, day = day, month
                if 1 <= int(month) <= 12 and 1 <= int(day) <= 31:
                    span = max(abs(int(year) - 2000), 20) if len(year) == 4 else 100
                    yield lo, DATE, log10(365 * span) + (log10(4) if sign else 0)


def _move(a: str, b: str) -> tuple[int, int] | None:
    """From one key to a neighbouring one; None for others."""
    a, b = KEYS.get(a.translate(SHIFTED)), KEYS.get(b.translate(SHIFTED))
    move = (b[0] - a[0], b[1] - a[1]) if a and b else None
    return move if move in ((0, 2), (0, -2), (1, 1), (1, -1), (-1, 1), (-1, -1)) else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The matches of the fixed patterns that are long enough: leftmost, not overlapping within a kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LENGTH]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def context_values(text: str) -> Iterator[tuple[int, int]]:
    """Where the values in credential context lie.  A full stop or the like that ends a bare value is none of
    it, and an address is no value (what stands before its host is)."""
    for pattern in CONTEXTS:
        for m in pattern.finditer(text):
            lo, hi = m.span(m.lastgroup)
            if m.lastgroup == "plain":
                hi = lo + len(m["plain"].rstrip(".:!?"))
            if hi - lo >= LEAST_VALUE and not _ADDRESS.match(text, lo, hi):
                yield lo, hi


def _in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def spans_of(text: str, model: GuessCost, least: float = LEAST_GUESSES) -> list[tuple[int, int, str, float | None]]:
    """All spans of a text in order, ``(start, end, kind, cost)``.  A value that lies within a base span adds none."""
    base = _in_order(base_spans(text))
    starts, reach = [s[0] for s in base], []
    for s in base:
        reach.append(max(s[1], reach[-1] if reach else 0))
    costs = {}
    for lo, hi in context_values(text):
        k = bisect_left(starts, lo + 1)
        if k and reach[k - 1] >= hi:
            continue
        cost = model.cost(text[lo:hi])
        if cost >= least:
            costs[lo, hi, "guess"] = cost
    return [(*s, costs.get(s)) for s in _in_order([*base, *costs])]


@lru_cache(2)
def guess_cost(path: str) -> GuessCost:
    """The cost model of this Python worker."""
    return GuessCost(vocabulary(path))


def _joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{lo}:{hi}" for lo, hi, kind, *_ in spans)


_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64()),
                             ("text", pa.string())]))


def _scanner(words: str, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts = column(piece, "text")
            hint = pc.fill_null(pc.match_substring_regex(texts, _HINT), False).to_numpy(zero_copy_only=False)
            found = [[]] * len(texts)
            for i in hint.nonzero()[0].tolist():
                text = texts[i].as_py()
                found[i] = [(kind, lo, hi, cost, text[lo:hi]) for lo, hi, kind, cost in spans_of(text, guess_cost(words), least)]
            yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array(found, _FOUND)], ["doc_id", "secrets"])
    return run


def find_secrets(docs: DataFrame, words: str, least: float = LEAST_GUESSES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, secrets``, an array of ``(kind, start, end, cost, text)`` in order of
    start, then kind (assign, access, hex, guess).

    Places are code points of the whole text, the end exclusive; a base span is
    the whole match of its pattern, a `guess` span the value alone.  `guess` are
    values in credential context, not within a base span, that need 10^``least``
    guesses or more (``cost``: their log10; null for base spans).  ``words`` is a
    tokenizer file whose vocabulary ranks the words.  Null and empty texts have
    no spans; nothing is shuffled; repeated rows are scanned alike; an empty
    table gives an empty result."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, _scanner(words, least),
                     "doc_id bigint, secrets array<struct<kind:string,start:bigint,end:bigint,cost:double,text:string>>")


def secret_digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess`` of :func:`find_secrets`."""
    of = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
                        of("guess").alias("n_guess"))


def redact(docs: DataFrame, words: str, least: float = LEAST_GUESSES, id_col: str = "doc_id", text_col: str = "text",
           mark: str = "[secret]") -> DataFrame:
    """``doc_id, text`` with every span replaced by ``mark``; spans that touch or overlap become one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            out = column(piece, "text").to_pylist()
            for i, text in enumerate(out):
                at, parts = 0, []
                for lo, hi, *_ in spans_of(text or "", guess_cost(words), least):
                    if lo > at or not parts:
                        parts += [text[at:lo], mark]
                    at = max(at, hi)
                if parts:
                    out[i] = "".join((*parts, text[at:]))
            yield pa.RecordBatch.from_arrays([column(piece, "doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(rows, run, "doc_id bigint, text string")
