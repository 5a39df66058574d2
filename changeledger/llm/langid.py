"""Language identification by cross-parsing entropy (operator 8).

Per language, a suffix automaton of labelled text accepts exactly the substrings of that text.  A document is parsed
greedily: each phrase is the longest match that the automaton accepts from here on.  With n symbols of
training text, c phrases over m symbols estimate c * log2(n) / m bits a symbol.  All languages pay the price of the largest sample, n, for a
phrase: a language with hardly any text would else win by its cheap phrases, long as its parse may be.  The language with the fewest
normalised phrases wins, the first by code point among equals.

Training text is a bounded sample: of each language the ``ROWS_PER_LANGUAGE`` labelled rows with the smallest hash of their id (fewer if that
would be over ``SAMPLE_ROWS`` of all languages), and of each the first ``CHARS_PER_ROW`` characters.  Every document is predicted from its whole text.

Text is lower-cased and every run of characters other than letters counts as one space.  Every letter of the training text is
a symbol, however rare; any other letter matches nothing and is a phrase by itself.  Steps by the space and the ``DENSE`` - 2 most frequent
letters are looked up in a table of all states, steps by rarer ones among the sorted edges; with many languages the table is left out, so
memory grows with the sample, not with states times letters.  Documents are cut into stretches of ``STRETCH`` symbols, so that numpy steps
through thousands of stretches at a time.  Each stretch is first parsed as if a phrase began with it; then the parse of the stretch
before is carried on until both begin a phrase at the same place, from where they agree.  So the count is that of the unbroken parse.

Defined results: ``und`` and score 0 for a null or empty text, one without a letter, or where no language was learned; null
ids are not held out and not learned from; repeated rows are predicted alike, each on its own; a very long text is parsed whole; an empty table gives no rows.  Else the score is the margin to the runner-up,
(second - best) / second, or 1 if only one language was learned.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_LANGUAGE = 48
SAMPLE_ROWS = 4800
CHARS_PER_ROW = 800
#: Symbols with a column in the table of steps, and the most cells it may have; beyond them fewer symbols get a column.
DENSE = 64
TABLE_CELLS = 16_000_000
STRETCH = 1024
#: Characters parsed at once by a worker.
PARSED_AT_ONCE = 2_000_000
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_LOADED: dict[str, Parser] = {}


def held_out(doc_id: str = "doc_id") -> Column:
    """True for ids whose CRC-32 as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame) -> dict[str, list[str]]:
    """Training passages per language; at most ROWS_PER_LANGUAGE short strings each, and fewer where that would be over SAMPLE_ROWS in all."""
    labelled = docs.where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    languages = labelled.agg(F.count_distinct("lang")).first()[0]
    each = max(1, min(ROWS_PER_LANGUAGE, SAMPLE_ROWS // max(1, languages)))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "passage")
    rows = (labelled.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), F.substring("text", 1, CHARS_PER_ROW).alias("passage"))
            .where(F.col("passage").rlike(r"\p{L}"))
            .withColumn("n", F.row_number().over(order)).where(F.col("n") <= each).orderBy("lang", "n").collect())
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["lang"], []).append(r["passage"])
    return dict(sorted(out.items()))


def suffix_edges(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions symbol → state of each state; state 0 is the root, and no transition leads to it."""
    edges: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        now = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = now
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return edges


def suffix_automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions [state, symbol] → state as a table, in which 0 stands for none."""
    edges = suffix_edges(symbols)
    table = np.zeros((len(edges), size), np.int32)
    for state, out in enumerate(edges):
        table[state, list(out)] = list(out.values())
    return table


def has_letter(text: str | None) -> bool:
    return bool(text and _LETTER.search(text) and any(map(str.isalpha, text)))


class Parser:
    """Automata of all languages, and phrase counts of many texts at a time."""

    def __init__(self, training: dict[str, list[str]]):
        self.languages = list(training)
        folded = {k: [" " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " " for t in v]
                  for k, v in training.items()}
        often = Counter(c for v in folded.values() for t in v for c in t if c != " ")
        chars = [c for c, _ in sorted(often.items(), key=lambda x: (-x[1], x[0]))]
        # 0: space, 1 to k: letters that training saw, k + 1: any other letter.
        self.other = len(chars) + 1
        states = 2 * sum(len(t) for v in folded.values() for t in v) + len(folded)
        self.size = max(1, min(self.other + 1, DENSE, TABLE_CELLS // max(1, states)))
        self.of_char = np.full(0x110000, self.other, np.min_scalar_type(self.other))
        for code in range(0x3000):
            if not chr(code).isalpha():
                self.of_char[code] = 0
        for k, c in enumerate(chars):
            self.of_char[ord(c)] = k + 1
        tables, roots, at = [], [], 0
        rare = []
        self.symbols_learned = []
        for k in self.languages:
            symbols = self.of_char[np.frombuffer("".join(folded[k]).encode("utf-32-le"), "<u4")].tolist()
            edges = suffix_edges(symbols)
            state = np.repeat(np.arange(len(edges), dtype=np.int64), [len(out) for out in edges])
            symbol = np.fromiter(chain.from_iterable(edges), np.int64, len(state))
            to = np.fromiter(chain.from_iterable(out.values() for out in edges), np.int32, len(state)) + np.int32(at)  # of all languages
            table = np.zeros((len(edges), self.size), np.int32)  # 0 stands for none
            common = symbol < self.size
            table[state[common], symbol[common]] = to[common]
            key = (state[~common] + at) * (self.other + 1) + symbol[~common]
            order = np.argsort(key)
            rare.append((key[order], to[~common][order]))  # rising over the languages too, as their states do
            tables.append(table)
            roots.append(at)
            at += len(edges)
            self.symbols_learned.append(len(symbols))
        self.table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int64)
        rare.append((np.array([np.iinfo(np.int64).max]), np.zeros(1, np.int32)))  # an end that no search passes
        self.rare, self.rare_to = (np.concatenate(x) for x in zip(*rare))

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all texts in a row and the place where each text ends; each is its words with a space after them."""
        raw = np.frombuffer("\0".join([t.lower() for t in texts] + [""]).encode("utf-32-le", "surrogatepass"), "<u4")
        sym = self.of_char[raw]
        if len(raw) and raw.max() >= 0x3000:  # rare: other scripts' marks and symbols are no letters either
            for code in np.unique(raw[raw >= 0x3000]):
                if not chr(code).isalpha():
                    sym[raw == code] = 0
        ends = np.cumsum([len(t.lower()) + 1 for t in texts])
        keep = sym != 0
        keep[1:] |= sym[:-1] != 0
        return sym[keep], np.cumsum(keep)[ends - 1]

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The states of any language after ``symbol``, 0 for none; shapes broadcast."""
        if self.other < self.size:
            return self.table[state * self.size + symbol]
        state, symbol = np.broadcast_arrays(state, symbol)
        common = symbol < self.size
        to = self.table[state * self.size + np.where(common, symbol, 0)]
        rare = ~common
        if rare.any():
            key = state[rare] * (self.other + 1) + symbol[rare]
            at = np.searchsorted(self.rare, key)
            to[rare] = np.where(self.rare[at] == key, self.rare_to[at], 0)
        return to

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Phrase counts [text, language] and the number of symbols of each text."""
        sym, ends = self.symbols(texts)
        starts = np.concatenate([[0], ends[:-1]])
        n = ends - starts
        pieces = -(-n // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = starts[owner] + nth * STRETCH
        length = np.minimum(STRETCH, ends[owner] - start)
        order = np.argsort(-length, kind="stable")
        start, length, owner = start[order], length[order], owner[order]
        lanes, langs = len(start), len(self.roots)
        padded = np.concatenate([sym, np.zeros(STRETCH, sym.dtype)])
        grid = np.ascontiguousarray(padded[start[:, None] + np.arange(STRETCH)].T) if lanes else np.zeros((0, 0), sym.dtype)
        state = np.repeat(self.roots[:, None], lanes, 1)
        active = np.searchsorted(-length, -np.arange(STRETCH), side="left")  # lanes longer than t
        begins = np.zeros((STRETCH, langs, lanes), bool)  # where phrases begin in each stretch parsed by itself
        for t in range(STRETCH):
            k = int(active[t])
            if not k:
                break
            state[:, :k], begins[t, :, :k] = self.parse(state[:, :k], grid[t, :k].astype(np.int64), self.roots[:, None])
        count = begins.sum(0, dtype=np.int64)
        lane_of = np.empty(lanes, np.int64)
        lane_of[order] = np.arange(lanes)  # of each stretch, in the order of the texts
        self._join_stretches(state, begins, count, grid, length, lane_of, pieces)
        total = np.zeros((len(texts), langs), np.int64)
        np.add.at(total, owner, count.T)
        return total, n

    def parse(self, state: np.ndarray, symbol: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one more symbol, and where a phrase begins with it."""
        to = self.step(state, symbol)
        none = to == 0
        again = self.step(root, symbol)
        after = np.where(none & (state != root), again, to)
        return np.where(after == 0, root, after), none | (state == root)

    def _join_stretches(self, state: np.ndarray, begins: np.ndarray, count: np.ndarray, grid: np.ndarray, length: np.ndarray,
                        lane_of: np.ndarray, pieces: np.ndarray) -> None:
        """Correct ``count`` for parses that run over the borders of stretches, second stretches of all texts first, then third ones.

        The parse of the stretches before is carried on, its phrases counted, until it begins one where the stretch's own parse does.
        The stretch's own phrases before that place don't count; if they never meet, none does.
        """
        first, many, nth = np.cumsum(pieces) - pieces, np.flatnonzero(pieces > 1), 1
        true = state[:, lane_of[first[many]]]
        while len(many):
            lane = lane_of[first[many] + nth]
            lang, doc = (x.ravel() for x in np.indices(true.shape))
            s, at, root, met = true.ravel(), lane[doc], self.roots[lang], np.zeros(true.size, bool)
            extra, live = np.zeros(true.size, np.int64), np.arange(true.size)
            for t in range(STRETCH):
                live = live[length[at[live]] > t]
                if not len(live):
                    break
                s[live], started = self.parse(s[live], grid[t, at[live]].astype(np.int64), root[live])
                own = begins[t, lang[live], at[live]]
                here = started & own
                extra[live] += started.astype(np.int64) - own
                met[live[here]] = True
                live = live[~here]
            count[:, lane] += extra.reshape(true.shape)
            true = np.where(met.reshape(true.shape), state[:, lane], s.reshape(true.shape))
            nth += 1
            go = pieces[many] > nth
            many, true = many[go], true[:, go]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        best, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        asked = [i for i, t in enumerate(texts) if has_letter(t)]
        if not self.languages or not asked:
            return best, score
        at, at_once = 0, PARSED_AT_ONCE * 8 // max(8, len(self.languages))
        while at < len(asked):
            chars, end = 0, at
            while end < len(asked) and (end == at or chars + len(texts[asked[end]]) <= at_once):
                chars += len(texts[asked[end]])
                end += 1
            part = asked[at:end]
            count, n = self.phrases([texts[i] for i in part])
            rate = count * np.log2(max(self.symbols_learned) + 2) / np.maximum(n, 1)[:, None]
            order = np.argsort(rate, axis=1, kind="stable")
            for i, r, o in zip(part, rate, order):
                best[i] = self.languages[o[0]]
                score[i] = float((r[o[1]] - r[o[0]]) / r[o[1]]) if len(o) > 1 and r[o[1]] > 0 else 1.0
            at = end
        return best, score


def parser(training: dict[str, list[str]]) -> Parser:
    """The automata, built once per Python worker from the passages, which are small."""
    key = hashlib.sha256(repr(training).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Parser(training)
    return _LOADED[key]


def prediction(training: dict[str, list[str]]):
    """A column function: text → struct(lang_pred, score)."""
    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = parser(training)
        for texts in parts:
            best, score = p.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": best, "score": score})

    return predict


def lettered():
    """A column function: whether the text has a letter, as ``predict`` asks first."""
    @F.pandas_udf("boolean")
    def ask(texts: pd.Series) -> pd.Series:
        return texts.map(has_letter).astype(bool)

    return ask


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score per document."""
    predict = prediction(sample(docs))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), predict(F.col("text").cast("string")).alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")
