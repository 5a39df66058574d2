"""BPE encoding and decoding with a lexicon of the corpus's frequent words.

Words are pieces of text between places where a byte-level vocabulary always begins a new run (see ``cut``), so the ids of a text are
the ids of its words in order.

1. All words of all texts are counted; those frequent enough for ``LEXICON_WORDS`` of them make the lexicon (``lexicon``), whose ids are
   merged once.  The bound limits memory alone: any other word gets the same ids by merging.
2. The lexicon is a minimal acyclic transducer in one file.  Spark hands the file to every executor (also to one that replaces a lost
   one), where workers map it.
3. A batch of texts is cut into words, its different words are looked up together, and unseen ones are merged exactly
   (``Merges``): in each round every word merges its pair of lowest rank, all places of it from the left.  A merge only makes pairs of
   higher rank (checked when a vocabulary is loaded), so this is the order of the library.

Defined results: a null text counts as empty; an empty text has no ids and decodes to the empty text; the content of an added token in a
text is that token, as the library reads it by default; a long text or a long word is encoded whole; repeated rows and null or repeated doc_ids
are rows of their own; an empty table gives no rows.  Only the text column is read, other columns stay, whatever their names are.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, slices, stored, text_or_empty
from .lexicon import Lexicon, PairTable, build

#: At most so many words in the lexicon (about 25 MB mapped).
LEXICON_WORDS = 1 << 18
#: Bytes of text handled at once, and counted words held by a counting task.
BATCH_BYTES = 4 << 20
HELD_WORDS = 1 << 19
#: Words merged at once (bounds memory), and the symbols beyond which a word is merged by a queue.
WORDS_AT_ONCE = 1 << 15
LONG_WORD = 256
_NEVER = np.int64(1 << 40)

#: Byte classes: solid; space and other ASCII white space; odd (controls, and the bytes of other white space), beside which no cut is made.
_SOLID, _SPACE, _WHITE, _ODD = range(4)
_CLASS = np.full(256, _SOLID, np.uint8)
_CLASS[:32] = _CLASS[127] = _ODD
_CLASS[9:14] = _WHITE
_CLASS[32] = _SPACE
#: The white space beyond ASCII, by its code points.
_WIDE = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WIDE_BYTES = [chr(c).encode() for c in _WIDE]
#: Latin letters (ASCII and U+00C0 to U+024F without the two signs among them), which all versions of Unicode call letters.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
_LATIN_WORD = re.compile(f" ?[!-~{_LETTER}]+")
#: Runs of such words by the vocabulary's public pattern: English endings, letters, digits, signs; and the line ends between words.
_LATIN_RUNS = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[0-9]+| ?[^\\s0-9{_LETTER}]+|\\n")
_LOADED: dict = {}


def cut(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The words of texts without nulls, and for each text the number of words up to its end.

    Letters, digits and signs never join with white space before them other than one plain space.  So in a run of white space between
    solid characters a word begins with the run, another with the run's last character, and one after it unless that is a space.
    """
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first, last = int(at[0]), int(at[-1])
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first:last]
    at = at - first
    kind = _CLASS[data]
    for n in {len(c) for c in _WIDE_BYTES}:
        chars = [c for c in _WIDE_BYTES if len(c) == n]
        lead = np.flatnonzero(np.isin(data[:len(data) - n + 1], [c[0] for c in chars]))
        if len(lead):
            spelled = sum(data[lead + k].astype(np.int64) << 8 * k for k in range(n))
            lead = lead[np.isin(spelled, [int.from_bytes(c, "little") for c in chars])]
            for k in range(n):
                kind[lead + k] = _ODD
    begins = np.zeros(len(data) + 1, bool)
    begins[at] = True
    white = np.flatnonzero((kind == _SPACE) | (kind == _WHITE))
    if len(white):
        new = np.ones(len(white), bool)
        new[1:] = (np.diff(white) != 1) | begins[white[1:]]
        head, tail = white[new], white[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(white) - 1]])]
        padded = np.concatenate([kind, [_ODD]])
        before = begins[head] | (padded[head - 1] == _SOLID)
        after = ~begins[tail + 1] & (padded[tail + 1] == _SOLID)
        sure = before & after
        begins[head[before & (begins[tail + 1] | after)]] = True
        begins[tail[sure]] = True
        begins[tail[sure & (kind[tail] == _WHITE)] + 1] = True
    start = np.flatnonzero(begins[:-1])
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(start, len(data)).astype(np.int64)), pa.py_buffer(data))
    return words, np.searchsorted(start, at[1:])


def _byte_symbols() -> list[str]:
    """How byte-level vocabularies spell each byte: its Latin-1 character where that is printable, the others by 256, 257 and so on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Merges:
    """The merges of a byte-level BPE model over many words at once.  ``ending``: what the model writes behind a word's last byte."""

    def __init__(self, vocab: dict[str, int], merges: list, ending: str = ""):
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.base = max(vocab.values()) + 1
        left, right = (np.array([vocab[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.joined = np.array([vocab[a + b] for a, b in merges], np.int64)
        rank_of = np.full(self.base, -1, np.int64)
        rank_of[self.joined[::-1]] = np.arange(len(merges))[::-1]
        if (np.maximum(rank_of[left], rank_of[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge comes before the merges of its parts")
        keys = left * self.base + right
        self.pairs = PairTable.of(keys)
        self.rank_at = np.zeros(len(self.pairs.slots), np.int64)
        self.rank_at[self.pairs.find(keys)] = np.arange(len(merges))
        spelled = _byte_symbols()
        self.symbol = np.array([vocab[c] for c in spelled], np.int64)
        self.last_symbol = np.array([vocab[c + ending] for c in spelled], np.int64)

    def of_words(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of ``size`` bytes each (none empty) that lie one after another in ``data``, and their numbers of ids."""
        ends, parts = np.cumsum(size), []
        for i in range(0, len(size), WORDS_AT_ONCE):
            j = min(len(size), i + WORDS_AT_ONCE)
            parts.append(self._some(data[ends[i] - size[i]:ends[j - 1]], size[i:j]))
        return tuple(np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1))

    def _some(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols = self.symbol[data]
        ends = np.cumsum(size)
        symbols[ends - 1] = self.last_symbol[data[ends - 1]]
        size = size.astype(np.int64)
        begin, long = ends - size, np.flatnonzero(size > LONG_WORD)
        if not len(long):
            return self._merge(symbols, size)
        short = np.flatnonzero(size <= LONG_WORD)
        merged = [np.array(self._merge_long(symbols[begin[k]:begin[k] + size[k]].tolist()), np.int64) for k in long]
        if len(short):
            ids, size[short] = self._merge(gather(symbols, begin, size, short), size[short])
            merged.insert(0, ids)
        size[long] = [len(m) for m in merged[-len(long):]]
        order = np.concatenate([short, long])
        begin[order] = np.cumsum(size[order]) - size[order]
        return gather(np.concatenate(merged), begin, size, np.arange(len(size))), size

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        slot = self.pairs.find(left * self.base + right)
        return np.where(slot >= 0, self.rank_at[slot], _NEVER)

    def _merge(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge runs of ``size`` symbols each; the ids of all runs, and their numbers of ids."""
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        run = np.arange(len(size))
        rank = np.full(len(symbols), _NEVER)
        inner = np.ones(len(symbols), bool)
        inner[np.cumsum(size) - 1] = False
        i = np.flatnonzero(inner)
        rank[i] = self._ranks(symbols[i], symbols[i + 1])
        while len(run):
            start = np.cumsum(size) - size
            low = np.minimum.reduceat(rank, start)
            still = low < _NEVER
            if not still.all():
                keep = np.repeat(still, size)
                done.append((run[~still], size[~still], symbols[~keep]))
                run, size, low, symbols, rank = run[still], size[still], low[still], symbols[keep], rank[keep]
                if not len(run):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, size))
            if len(hit) > 1:  # of overlapping places, as in "aaa", every second one from the left
                head = np.ones(len(hit), bool)
                head[1:] = np.diff(hit) != 1
                index = np.arange(len(hit))
                hit = hit[(index - np.maximum.accumulate(np.where(head, index, 0))) % 2 == 0]
            symbols[hit] = self.joined[rank[hit]]
            gone = np.zeros(len(symbols), bool)
            gone[hit + 1] = True
            size = size - np.bincount(np.searchsorted(np.cumsum(size), hit, side="right"), minlength=len(size))
            place = hit - np.arange(len(hit))  # after the removal
            symbols, rank = symbols[~gone], rank[~gone]
            ends = np.cumsum(size)
            last = np.zeros(len(symbols) + 1, bool)
            last[ends - 1] = True
            last[-1] = True
            touched = np.concatenate([place, place[place > 0] - 1])
            closed = last[touched]
            rank[touched[closed]] = _NEVER
            touched = touched[~closed]
            rank[touched] = self._ranks(symbols[touched], symbols[touched + 1])
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        run, size, ids = (np.concatenate([d[k] for d in done]) for k in range(3))
        back = np.argsort(run)
        return gather(ids, np.cumsum(size) - size, size, back), size[back]

    @functools.cached_property
    def rank(self) -> dict[int, int]:
        at = np.flatnonzero(self.pairs.slots >= 0)
        return dict(zip(self.pairs.slots[at].tolist(), self.rank_at[at].tolist()))

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same for one run, by a queue of (rank, place): time grows with n log n."""
        n = len(symbols)
        following, before, alive = [*range(1, n + 1)], [*range(-1, n - 1)], [True] * n
        queue = [(r, i) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := self.rank.get(pair[0] * self.base + pair[1])) is not None]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = following[i]
            if not alive[i] or j >= n or self.rank.get(symbols[i] * self.base + symbols[j]) != r:
                continue
            symbols[i], alive[j] = int(self.joined[r]), False
            following[i] = k = following[j]
            if k < n:
                before[k] = i
                if (new := self.rank.get(symbols[i] * self.base + symbols[k])) is not None:
                    heapq.heappush(queue, (new, i))
            h = before[i]
            if h >= 0 and (new := self.rank.get(symbols[h] * self.base + symbols[i])) is not None:
                heapq.heappush(queue, (new, h))
        return [s for s, a in zip(symbols, alive) if a]


class Merger:
    """Ids of words by the merges of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        library = Tokenizer.from_file(path)
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.added = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        vocab = model["vocab"]
        self.merges = Merges(vocab, model["merges"])
        byte = {c: b for b, c in enumerate(_byte_symbols())}
        #: What each id stands for; an added token stands for its content.
        self.bytes_of = [b""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte[c] for c in token)
        for content, i in self.added.items():
            self.bytes_of[i] = content.encode()
        self.decimal = [str(i).encode() for i in range(len(self.bytes_of))]

    def _parts(self, words: list[str]) -> tuple[list[str], list[int]]:
        """The vocabulary's own runs of each word, and how many each word has.

        Words of plain characters, after at most one space, are split together in one text of lines: those of Latin letters, ASCII digits
        and signs by pattern, others by the library.  Words with other white space or controls go to the library one by one.
        """
        out: list[list[str]] = [[]] * len(words)
        latin = [k for k, w in enumerate(words) if _LATIN_WORD.fullmatch(w)]
        rest = sorted({*range(len(words))}.difference(latin))
        plain = [k for k in rest if (w := words[k])[1:].isprintable() and " " not in w[1:] and w != " " and w[0].isprintable()]
        for group, split in ((latin, _LATIN_RUNS.findall), (plain, self._library_runs)):
            if group:
                runs: list[str] = []
                at = iter(group)
                for part in split("\n".join([words[k] for k in group])):
                    if part == "\n":
                        out[next(at)] = runs
                        runs = []
                    else:
                        runs.append(part)
                out[next(at)] = runs
        for k in set(rest).difference(plain):
            out[k] = self._library_runs(words[k])
        return list(chain.from_iterable(out)), list(map(len, out))

    def _library_runs(self, text: str) -> list[str]:
        return [text[i:j] for _, (i, j) in self.split(text)]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (none empty) one after another, and each word's end among them."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts, per_word = self._parts(words)
        coded = pa.array(parts, pa.large_string()).dictionary_encode()
        data = np.frombuffer(coded.dictionary.buffers()[2], np.uint8)
        ids, size = self.merges.of_words(data, pc.binary_length(coded.dictionary).to_numpy())
        index = coded.indices.to_numpy()
        return gather(ids, np.cumsum(size) - size, size, index), np.cumsum(size[index])[np.cumsum(per_word) - 1]


def gather(values: np.ndarray, begin: np.ndarray, size: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The slices ``values[begin[k] : begin[k] + size[k]]`` for k in ``index``, one after another."""
    parts = [values[:0]]
    for i in (index[at:at + (1 << 18)] for at in range(0, len(index), 1 << 18)):
        n = size[i]
        end = np.cumsum(n)
        parts.append(values[np.repeat(begin[i] - (end - n), n) + np.arange(end[-1])])
    return np.concatenate(parts)


class Encoder:
    """``encode(texts)`` gives the ids of texts without nulls as one array, and each text's end in it."""

    def __init__(self, merger: Merger, lexicon: Lexicon | None):
        self.merger, self.lexicon = merger, lexicon
        self.pattern = "|".join(re.escape(c) for c in merger.added)

    def _words(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        words, upto = cut(texts)
        coded = words.dictionary_encode()
        different = coded.dictionary
        place = self.lexicon.find(different) if self.lexicon else np.full(len(different), -1, np.int64)
        unseen = np.flatnonzero(place < 0)
        fresh_ids, fresh_ends = self.merger.ids(different.take(pa.array(unseen)).to_pylist())
        known = np.flatnonzero(place >= 0)
        begin, size = np.zeros(len(different), np.int64), np.zeros(len(different), np.int64)
        ids = fresh_ids
        if len(known):
            found, inverse = np.unique(place[known], return_inverse=True)
            n = self.lexicon.ends[found + 1] - self.lexicon.ends[found]
            ids = np.concatenate([fresh_ids, gather(self.lexicon.ids, self.lexicon.ends, np.diff(self.lexicon.ends), found)])
            begin[known], size[known] = (len(fresh_ids) + np.cumsum(n) - n)[inverse], n[inverse]
        size[unseen] = np.diff(fresh_ends, prepend=0)
        begin[unseen] = fresh_ends - size[unseen]
        index = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(size[index])])[upto]
        return gather(ids, begin, size, index), ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = texts.cast(pa.large_string())
        marked = pc.match_substring_regex(texts, self.pattern).to_numpy(zero_copy_only=False) if self.pattern else np.zeros(len(texts), bool)
        if not marked.any():
            return self._words(texts)
        pieces, joints, upto = [], [], []  # the added tokens part a text into texts of their own
        for text in texts.to_pylist():
            split = re.split(f"({self.pattern})", text) if self.pattern else [text]
            pieces += split[::2]
            joints += [*(self.merger.added[c] for c in split[1::2]), None]
            upto.append(len(pieces))
        ids, ends = self._words(pa.array(pieces, pa.large_string()))
        behind = np.array([k for k, j in enumerate(joints) if j is not None])
        ids = np.insert(ids, ends[behind], [joints[k] for k in behind])
        added = np.zeros(len(pieces), np.int64)
        added[behind] = 1
        return ids, (ends + np.cumsum(added))[np.array(upto) - 1]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.merger.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def merger(path: str) -> Merger:
    """The merges of a vocabulary file, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Merger(path)
    return _LOADED[path]


def encoder(path: str, lexicon_file: str | None) -> Encoder:
    key = (path, lexicon_file)
    if key not in _LOADED:
        _LOADED[key] = Encoder(merger(path), Lexicon(SparkFiles.get(lexicon_file)) if lexicon_file else None)
    return _LOADED[key]


def _pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Runs of texts of about BATCH_BYTES, each with the index of its first text."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, side="right")))
        yield at, texts.slice(at, end - at)
        at = end


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of all texts.  Tasks add up their words before the shuffle, so a hot word is a row a task."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def total() -> pa.Table:
            t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": t.column("word"), "n": t.column("n_sum")})

        for batch in slices(batches):
            for _, texts in _pieces(batch.column(0).cast(pa.large_string())):
                found = cut(texts)[0].value_counts()
                held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                if sum(t.num_rows for t in held) > HELD_WORDS:
                    held = [total()]
                    if held[0].num_rows > HELD_WORDS // 2:
                        yield from _narrow(held.pop())
        if held:
            yield from _narrow(total())

    rows = docs.select(text_or_empty().cast("string").alias("text")).mapInArrow(count, "word string, n long")
    return rows.repartition("word").groupBy("word").agg(F.sum("n").alias("n"))  # added up before the shuffle already


def _narrow(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Batches of at most a few MB with 32-bit offsets."""
    for at in range(0, rows.num_rows, 1 << 16):
        yield from rows.slice(at, 1 << 16).cast(pa.schema([("word", pa.string()), ("n", pa.int64())])).combine_chunks().to_batches()


def lexicon(docs: DataFrame, path: str, max_words: int = LEXICON_WORDS) -> str | None:
    """Make the lexicon of the words of ``docs`` that occur often enough for ``max_words`` of them, and hand its file to all executors.

    Gives the file's name there (None without words).  Words seen once are left out.  The words chosen meet in one task, at most ``max_words``.
    """
    spark = docs.sparkSession
    counts = stored(word_counts(docs).where("n > 1"), "bpe-words")
    level = F.floor(F.log2(F.col("n")) * 64)  # a few thousand levels at most
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect(), reverse=True)
    least, total = None, 0
    for row in levels:
        total += row.words
        if total > max_words:
            break
        least = row.level
    if least is None:
        return None

    def with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 16):
            words = batch.column(0)
            ids, ends = merger(path).ids(words.to_pylist())
            raw, at = ids.astype("<i4").tobytes(), np.concatenate([[0], ends]) * 4
            yield pa.RecordBatch.from_arrays([words, pa.array([raw[i:j] for i, j in zip(at, at[1:])], pa.binary())], ["word", "ids"])

    def compiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, raw = [], []
        for batch in batches:
            words += [w.encode() for w in batch.column(0).to_pylist()]
            raw += batch.column(1).to_pylist()
        ids = np.frombuffer(b"".join(raw), "<i4")
        file = build(words, ids, np.cumsum([len(r) // 4 for r in raw]))
        part = 4 << 20
        chunks = [file[i:i + part] for i in range(0, len(file), part)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())], ["k", "bytes"])

    chosen = counts.where((F.length("word") > 0) & (level >= F.lit(least))).select("word").mapInArrow(with_ids, "word string, ids binary")
    file = chosen.coalesce(1).sortWithinPartitions("word").mapInArrow(compiled, "k int, bytes binary")
    name = f"lexicon-{uuid.uuid4().hex[:12]}.bin"
    local = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)  # the driver's own copy, served to the executors
    with open(local, "wb") as f:
        for row in sorted(file.collect()):
            f.write(row["bytes"])
    spark.sparkContext.addFile(local)
    return name


def encode(docs: DataFrame, path: str, lexicon_file: str | None = None, column: str = "ids") -> DataFrame:
    """``docs`` and the ids of its texts as array<int> in ``column``."""
    return _mapped(docs, path, lexicon_file, [T.StructField(column, T.ArrayType(T.IntegerType(), False))], _id_lists)


def _id_lists(coder: Encoder, ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    return [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))]


def decode(encoded: DataFrame, path: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """``encoded`` and the texts of its ids in ``column``; null ids count as none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(merger(path), None)
        for batch in slices(batches, 256):
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = pa.array([coder.decode(np.array(x or [], np.int64)) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, column])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(column, T.StringType())]))


def _digests(coder: Encoder, ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    """Number of ids, their decimal list's SHA-256, and that of the text decoded from them."""
    import hashlib

    n, listed, decoded, at = [], [], [], 0
    for end in ends.tolist():
        one = ids[at:end]
        at = end
        n.append(len(one))
        listed.append(hashlib.sha256(b",".join(map(coder.merger.decimal.__getitem__, one.tolist()))).hexdigest())
        decoded.append(hashlib.sha256(coder.decode(one).encode()).hexdigest())
    return [pa.array(n, pa.int64()), pa.array(listed, pa.string()), pa.array(decoded, pa.string())]


def digests(docs: DataFrame, path: str, lexicon_file: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _mapped(docs.select("doc_id", F.col("text").cast("string").alias("text")), path, lexicon_file, fields, _digests).drop("text")


def _mapped(docs: DataFrame, path: str, lexicon_file: str | None, fields: list[T.StructField], columns) -> DataFrame:
    """``docs`` with columns made from the ids of its texts.  Texts go in runs of about BATCH_BYTES."""
    text = fresh(docs, "coded_text")
    whole = docs.withColumn(text, text_or_empty().cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, lexicon_file)
        for batch in slices(batches):
            texts = batch.column(batch.num_columns - 1)
            for at, some in _pieces(texts.cast(pa.large_string())):
                rows = batch.slice(at, len(some))
                new = columns(coder, *coder.encode(some))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *new], [*rows.schema.names[:-1], *(f.name for f in fields)])

    return whole.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))
