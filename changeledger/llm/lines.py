"""Line-first cleaning (operator 6): rules judge lines, failing lines go, and a document that loses too much goes whole.

A line with a word fails by the first of these that holds:

* ``boilerplate``: at most ``BOILERPLATE_WORDS`` words and one of the ``BOILERPLATE`` phrases in it, as whole words.
* ``navigation``: at least ``NAV_MARKS`` separators (| • anywhere; › » → / > alone, as › and » also close quotations), and they are more than ``NAV_SHARE`` of its words.
* ``punctuation``, for lines of at least ``LONG_LINE`` words: punctuation and symbols, by Unicode category, are over ``MARK_SHARE`` of
  the characters that aren't space; or nine letters in ten are capitals, in scripts that have them; or there is no sentence mark of any
  script anywhere in the line, unless its script writes none.

The document is rejected when it fails the base test (too few words, or mostly repeated three-word windows), or when the failing
lines hold more than ``MAX_LOST`` of the characters in words.

Defined results: a null, empty or blank text has no words and fails the base test; a very long text is judged whole, line by line; repeated
rows and null ids are rows of their own, each judged alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, slices

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.4
LONG_LINE = 4
MARK_SHARE = 0.2
CAPITAL_SHARE = 0.9
NAV_MARKS = 3
NAV_SHARE = 0.25
BOILERPLATE_WORDS = 25
BOILERPLATE = ("all rights reserved", "licensed under", "released under the", "terms of use", "terms of service", "privacy policy",
               "cookie policy", "accept cookies", "use cookies", "enable javascript", "javascript is disabled", "lorem ipsum",
               "click here", "read more", "sign up", "log in", "subscribe to", "share this", "skip to content", "back to top")

_WORD = re.compile(WORD)
_OTHER_SPACE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")


def _characters(pattern: str) -> str:
    """The characters of the basic plane that a Unicode property matches, as ranges for a character class."""
    codes = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000 and regex.match(pattern, chr(c))]
    cuts = [k for k, c in enumerate(codes) if k == 0 or c != codes[k - 1] + 1]
    runs = [(codes[i], codes[j - 1]) for i, j in zip(cuts, [*cuts[1:], len(codes)])]
    return "".join(f"\\u{a:04x}" if a == b else f"\\u{a:04x}-\\u{b:04x}" for a, b in runs)


#: Punctuation and symbols by Unicode category: vowel signs and accents belong to their letters.
_MARK = re.compile(f"[{_characters(r'[\p{P}\p{S}]')}]")
#: What ends a sentence in any script, and colons and semicolons.  Sentences of the scripts of ``_UNMARKED`` (Thai, Lao, Tibetan, Khmer) end without a mark.
_SENTENCE = re.compile(f"[…:;؛：；{_characters(r'\p{Sentence_Terminal}')}]")
_UNMARKED = re.compile(f"[{_characters(r'[\p{Thai}\p{Lao}\p{Tibetan}\p{Khmer}]')}]")
_NAV = re.compile(r"(?:^|(?<=\s))[|•›»→/>](?:\s|$)|[|•]")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_BOILERPLATE = re.compile(rf"\b(?:{'|'.join(BOILERPLATE)})\b")

_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, lost_chars long, lines_removed array<string>, clean_text string")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def failing(line: str, words: list[str]) -> str | None:
    """The rule that a line with words fails."""
    n = len(words)
    if n <= BOILERPLATE_WORDS:
        if _BOILERPLATE.search(line.lower()):
            return "boilerplate"
    marks = len(_NAV.findall(line))
    if marks >= NAV_MARKS and marks > NAV_SHARE * n:
        return "navigation"
    if n >= LONG_LINE:
        if len(_MARK.findall(line)) > MARK_SHARE * sum(map(len, words)) or not (_SENTENCE.search(line) or _UNMARKED.search(line)):
            return "punctuation"
        if line.upper() == line or not any(w.islower() for w in words):
            letters = [c for c in line if c.isalpha()]
            if sum(c.isupper() for c in letters) >= CAPITAL_SHARE * len(letters) > 0:
                return "punctuation"
    return None


def repeated_words(words: list[str]) -> int:
    """Words inside three-word windows that occur at least twice, the first occurrence included."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    # Numbers of pairs stay below the number of words, so the codes of windows fit 64 bits.
    pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, count = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    twice = count[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:k + n] |= twice
    return int(covered.sum())


def judged(text: str | None) -> tuple:
    """The columns of ``_SCHEMA`` after doc_id."""
    text = text or ""
    n_words = word_chars = n_dup = lost = 0
    seen: set[str] = set()
    removed, clean, every = [], [], []
    for line in text.split("\n"):
        words = words_of(line)
        if not words:
            clean.append(line)
            continue
        every += words
        chars = sum(map(len, words))
        n_words, word_chars = n_words + len(words), word_chars + chars
        n_dup += line in seen
        seen.add(line)
        if rule := failing(line, words):
            removed.append(rule)
            lost += chars
        else:
            clean.append(line)
    n_repeat = repeated_words(every)
    failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    kept = not failed and lost <= MAX_LOST * word_chars
    return (n_words, word_chars, len(_SYMBOL.findall(text)), n_dup, n_repeat, failed, kept, lost, removed, "\n".join(clean))


def clean(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Counts and verdict per document, with the rules of its removed lines and, if wanted, the text that is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64(), pa.list_(pa.string()), pa.string()]
        names = [c.split()[0] for c in _SCHEMA.split(", ")]
        for b in slices(batches):
            rows = list(zip(*map(judged, b.column("text").to_pylist())))
            if not with_text:
                rows[-1] = [None] * b.num_rows
            yield pa.record_batch([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(rows, kinds))], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _SCHEMA)
