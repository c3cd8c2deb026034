"""Whole texts to token ids, one distinct word at a time.

A tokenizer that drops white space and never joins letters to what is not a
letter gives the same ids for a text as for its words in turn.  So a batch is
split at white space, each distinct word is encoded once - many words in one
string, kept apart by a special token - and the ids are gathered back.  Frequent
words stay in a table of bounded size from batch to batch."""

from __future__ import annotations

import json
import os
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from rarelab.llm.common import word_codes

WORDS_AT_ONCE = 4096
WORDS_KEPT = 400_000
ENCODE_BYTES = 8 << 20  # text encoded at once: the more, the more often a word occurs in it


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + lengths[i] - 1`` of every i, in turn."""
    total = int(lengths.sum())
    if total == 0:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    shift = np.repeat(starts - (ends - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift


class WordEncoder:
    """Encoder over a tokenizer file (`tokenizers` library).

    Texts are encoded word by word where the file says that this is the same
    (:meth:`_by_words`), else as wholes.  Text that spells a special token
    becomes that token, as the library does by default."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        specials = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.specials = tuple(specials)
        self.mark = next((t for t in specials if not any(c.isspace() for c in t)), None)
        self.mark_id = specials.get(self.mark)
        self.wordwise = self.mark is not None and self._by_words(json.loads(self.tokenizer.to_str()))
        self.place: dict[str, int] = {}  # word -> number in the arrays below
        self.known_ids, self.known_count = np.empty(0, np.uint32), np.empty(0, np.int64)

    @staticmethod
    def _by_words(spec: dict) -> bool:
        """True for a tokenizer that lower-cases, drops white space, and cuts
        between letters and other characters before it looks at its vocabulary."""
        normalizers = (spec.get("normalizer") or {}).get("normalizers", [])
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = next((s for s in steps if s["type"] == "Split"), {})
        pattern = split.get("pattern", {}).get("Regex", "")
        return (any(n["type"] == "Lowercase" for n in normalizers) and split.get("behavior") == "Removed"
                and split.get("invert") is True and "|[\\p{L}]+|" in pattern and pattern.endswith("|[^\\s\\p{L}\\p{N}]+")
                and all(s["type"] in ("Split", "ByteLevel") and not s.get("add_prefix_space") for s in steps))

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in turn, and the number of ids of each."""
        odd = [i for i, w in enumerate(words) if "<" in w and any(s in w for s in self.specials)]
        own = dict(zip(odd, self._plain([words[i] for i in odd]), strict=True))
        if own:
            words = ["" if i in own else w for i, w in enumerate(words)]
        gap = f" {self.mark} "
        ids, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words[at:at + WORDS_AT_ONCE]
            got = np.asarray(self._plain([gap.join(part)])[0], dtype=np.uint32)
            marks = np.flatnonzero(got == self.mark_id)
            if len(marks) != len(part) - 1:
                raise RuntimeError("the tokenizer does not keep words apart")
            counts.append(np.diff(np.concatenate(([-1], marks, [len(got)]))) - 1)
            ids.append(np.delete(got, marks))
        flat, count = np.concatenate(ids), np.concatenate(counts)
        if own:
            starts = np.cumsum(count) - count
            cut = [np.asarray(own[i], np.uint32) if i in own else flat[starts[i]:starts[i] + count[i]]
                   for i in range(len(words))]
            flat, count = np.concatenate(cut), np.asarray([len(c) for c in cut], dtype=np.int64)
        return flat, count

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, starts, counts)``: word ``i`` has ``ids[starts[i]:starts[i] + counts[i]]``."""
        # the tokenizer lower-cases; only words that could spell a special token keep their case
        words = [w.lower() if "<" not in w and w.isascii() else w for w in words]
        get = self.place.get
        where = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(where < 0)
        ids, count = self.known_ids, self.known_count
        if len(missing):
            new = list(dict.fromkeys(words[i] for i in missing))
            flat, n = self._fresh(new)
            number = {w: len(count) + k for k, w in enumerate(new)}
            where[missing] = [number[words[i]] for i in missing]
            ids, count = np.concatenate((ids, flat)), np.concatenate((count, n))
            room = max(0, WORDS_KEPT - len(self.place))
            kept = new[:room]
            self.place.update((w, number[w]) for w in kept)
            self.known_count = count[:len(self.known_count) + len(kept)]
            self.known_ids = ids[:int(self.known_count.sum())]
        starts = np.cumsum(count) - count
        return ids, starts[where], count[where]

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        # a full stop or comma after a letter is a token of its own: apart, it leaves fewer distinct words
        return word_codes(pc.replace_substring_regex(texts, r"([A-Za-z])([.,])(\s|$)", r"\1 \2\3"))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of whole texts: text ``i`` has ``ids[offsets[i]:offsets[i + 1]]``.  Null: no ids."""
        if not self.wordwise:
            lists = self._plain([t or "" for t in texts.to_pylist()])
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64)))
            return np.fromiter((i for x in lists for i in x), dtype=np.uint32, count=int(offsets[-1])), offsets
        at, codes, distinct = self._split(texts)
        ids, starts, counts = self.words(distinct.to_pylist())
        n = counts[codes]
        ends = np.concatenate(([0], np.cumsum(n)))
        return ids[ranges(starts[codes], n)], ends[at]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each whole text."""
        if not self.wordwise:
            return np.diff(self.encode(texts)[1])
        at, codes, distinct = self._split(texts)
        _, _, counts = self.words(distinct.to_pylist())
        return np.diff(np.concatenate(([0], np.cumsum(counts[codes])))[at])


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker; its word table serves task after task."""
    return WordEncoder(path)
