"""Phrase collocation mining over external count streams.

1. **Counts**, one length at a time: tasks turn their texts into word numbers, add up the phrases of a batch by sorting, and shuffle the sums.
   A phrase is only frequent if both its parts one word shorter are, so each length is counted where the shorter ones are frequent.  A filter
   of fixed size tells that: it never loses a frequent phrase, and false hits are counted and dropped as rare.
2. **Streams**: the frequent phrases of all lengths are kept in two orders, by their words from the left (prefix order) and from the right
   (suffix order), each dealt by range and sorted.  In prefix order a phrase follows its own beginnings, so one walk meets f(w1), f(w1 w2) and then
   all that extend them; the suffix order does the same for endings and extensions to the left.  The walk only remembers the phrases it stands
   in, and looks nothing up.  Where a range begins inside a phrase, the few rows concerned are left open and filled by one row a range.
3. Both streams are merge-joined on the phrase, cuts are scored, covered candidates go, and each language keeps its first ones.

A range boundary may fall anywhere, so a word or a language that holds a third of all phrases is shared by many tasks.

Defined results: a null text counts as empty, a null language as ``und``; empty texts have no words; repeated rows and null or repeated doc_ids count as often
as they stand; long texts and long words are whole; ties go by score, count, then the phrase's bytes; an empty table gives no rows.  Only text and
lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored, text_or_empty

#: Bytes of text counted at once in a task.
BATCH_BYTES = 6 << 20
#: A filter has so many bits a phrase, and at most MAX_BITS (32 MB); a fuller one passes more phrases on to be counted.
BITS_A_PHRASE = 16
MAX_BITS = 1 << 28
SEGMENTS = 32
#: What a language gets at most.
REPORTED = 2000

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*range(0x0A, 0x0E), *(ord(c) for c in ".,;:!?")]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))


def _chain(hashes: list[np.ndarray]) -> np.ndarray:
    """The hash of a language and the words behind it, from theirs."""
    h = hashes[0]
    for more in hashes[1:]:
        h = _mix(h * _STEP + more)
    return h


class Filter:
    """Tells frequent phrases from most others: two bits of each are set.  Without bits it knows none."""

    def __init__(self, raw: bytes):
        self.bits = np.frombuffer(raw, np.uint8)
        self.shift = np.uint64(64 - (len(raw) * 8).bit_length() + 1) if raw else np.uint64(0)

    @staticmethod
    def places(h: np.ndarray, shift: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        return (h >> shift).astype(np.int64), ((h * _STEP) >> shift).astype(np.int64)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        if not len(self.bits):
            return np.zeros(len(h), bool)
        a, b = self.places(h, self.shift)
        out = self.bits[a >> 3] >> (a & 7).astype(np.uint8) & 1
        return (out & (self.bits[b >> 3] >> (b & 7).astype(np.uint8))) > 0


class Stream:
    """The words of a batch of texts: numbers of different words, whether the next word follows in the same piece, and each word's language."""

    def __init__(self, texts: pa.LargeStringArray, langs: np.ndarray):
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]]
        at = at - at[0]
        kind = _CLASS[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kind == 0
        begins = np.zeros(len(data) + 1, bool)
        begins[at] = True
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | begins[:-1]))
        solid = np.concatenate([[0], np.cumsum(inside[1:-1], dtype=np.int32)])
        words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(np.append(solid[start], solid[-1]).astype(np.int64)), pa.py_buffer(data[kind == 0]))
        coded = words.dictionary_encode()
        self.words, self.code = coded.dictionary, coded.indices.to_numpy()
        breaks = np.cumsum((kind == 2) | begins[:-1], dtype=np.int32)[start] if len(start) else np.zeros(0, np.int64)
        self.joined = np.zeros(len(start), bool)
        self.joined[:-1] = breaks[1:] == breaks[:-1]
        self.lang = langs[np.searchsorted(at, start, side="right") - 1]

    def phrases(self, length: int, lang_hash: np.ndarray, shorter: Filter | None) -> np.ndarray:
        """Where the phrases of ``length`` words start that may be frequent."""
        if length > len(self.code):
            return np.zeros(0, np.int64)
        first = np.flatnonzero(np.logical_and.reduce([self.joined[k:len(self.code) - length + 1 + k] for k in range(length - 1)] or [np.ones(len(self.code), bool)]))
        if shorter is None or not len(first):
            return first
        word_hash = _hashes(self.words)
        runs = np.zeros(len(self.code), bool)  # of one word less, from each word on
        n = len(self.code) - length + 2
        runs[:n] = shorter.may_hold(_chain([lang_hash[self.lang[:n]], *(word_hash[self.code[k:n + k]] for k in range(length - 1))]))
        return first[runs[first] & runs[first + 1]]

    def counted(self, first: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Language, words and count of each different phrase among those that start at ``first``."""
        bits = max(1, int(len(self.words) - 1).bit_length())
        if bits * length + 13 <= 63:  # at most 5000 languages a batch
            key = self.lang[first].astype(np.int64)
            for k in range(length):
                key = key << bits | self.code[first + k]
            key, n = np.unique(key, return_counts=True)
            codes = [key >> bits * (length - 1 - k) & ((1 << bits) - 1) for k in range(length)]
            return key >> bits * length, codes, n
        columns = [self.lang[first], *(self.code[first + k] for k in range(length))]
        order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        head = np.flatnonzero(new)
        return columns[0][head], [c[head] for c in columns[1:]], np.diff(np.append(head, len(order)))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_or_empty().cast("string").alias("text"))


def _counts(docs: DataFrame, length: int, shorter=None) -> DataFrame:
    """(lang, phrase, f) of all phrases of ``length`` words that ``shorter``, a broadcast filter, doesn't exclude."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(shorter.value) if shorter is not None else None
        for batch in slices(batches, 5000):
            langs = batch.column(0).dictionary_encode()
            lang_hash, numbers = _hashes(langs.dictionary), langs.indices.to_numpy()
            texts = batch.column(1).cast(pa.large_string())
            size, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
            while at < len(texts):
                end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + BATCH_BYTES, side="right")))
                stream = Stream(texts.slice(at, end - at), numbers[at:end])
                at = end
                lang, codes, n = stream.counted(stream.phrases(length, lang_hash, known), length)
                for i in range(0, len(n), 1 << 16):
                    words = [stream.words.take(pa.array(c[i:i + (1 << 16)])).cast(pa.string()) for c in codes]
                    phrase = words[0] if length == 1 else pc.binary_join_element_wise(*words, " ")
                    yield pa.RecordBatch.from_arrays([langs.dictionary.take(pa.array(lang[i:i + (1 << 16)])).cast(pa.string()), phrase, pa.array(n[i:i + (1 << 16)], pa.int64())],
                                                     ["lang", "phrase", "f"])

    # A task's sums are nearly all of different phrases, so they are dealt as they are and added up behind the shuffle; a hot phrase has a row a batch.
    counted = _rows(docs).mapInArrow(count, "lang string, phrase string, f long").repartition("lang", "phrase")
    return counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _filter(frequent: DataFrame):
    """A broadcast filter of the frequent phrases: at most MAX_BITS, made of segments of equal size, each by one task."""
    spark = frequent.sparkSession
    bits = min(MAX_BITS, max(1 << 16, 1 << (frequent.count() * BITS_A_PHRASE - 1).bit_length()))
    shift, part = np.uint64(64 - bits.bit_length() + 1), bits // SEGMENTS

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = pc.split_pattern(batch.column(1), " ")
            words = lists.flatten().dictionary_encode()
            hashed = _hashes(words.dictionary)[words.indices.to_numpy()].reshape(batch.num_rows, -1)
            langs = batch.column(0).dictionary_encode()
            h = _chain([_hashes(langs.dictionary)[langs.indices.to_numpy()], *hashed.T])
            place = np.unique(np.concatenate(Filter.places(h, shift)))
            yield pa.RecordBatch.from_arrays([pa.array(place // part, pa.int32()), pa.array(place % part, pa.int32())], ["segment", "place"])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on: dict[int, np.ndarray] = {}
        for batch in batches:
            number, place = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for k in np.unique(number).tolist():
                on.setdefault(k, np.zeros(part, np.uint8))[place[number == k]] = 1
        for k, bits_on in on.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(bits_on, bitorder="little").tobytes()], pa.binary())], ["segment", "raw"])

    rows = frequent.select("lang", "phrase").mapInArrow(places, "segment int, place int")
    made = {r.segment: r.raw for r in rows.repartition(SEGMENTS, "segment").mapInArrow(segments, "segment int, raw binary").collect()}
    raw = b"".join(bytes(made.get(k) or bytes(part // 8)) for k in range(SEGMENTS)) if made else b""
    return spark.sparkContext.broadcast(raw)


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[list[DataFrame], DataFrame]:
    """For each length from 1 to ``longest`` the stored (lang, phrase, f) of all phrases with f >= least; and (lang, n), the words of each language."""
    words = stored(_counts(docs, 1), "phrases-1")
    out = [words.where(F.col("f") >= least)]
    for length in range(2, longest + 1):
        out.append(stored(_counts(docs, length, _filter(out[-1])).where(F.col("f") >= least), f"phrases-{length}"))
    return out, words.groupBy("lang").agg(F.sum("f").alias("n"))


def _walked(phrases: DataFrame, longest: int, backward: bool) -> DataFrame:
    """Each phrase with ``part_k``, the count of its first (``backward``: last) k words, and ``more``, the largest count of the phrases that
    extend it by one word at its other side (0: none is frequent).

    Rows come as words in order of the walk; a row's own beginnings are rows before it.  Rows at the head of a range whose beginnings stand in an earlier
    range have null parts, and the last rows of a range may have extensions in later ones: ``_joined_ranges`` fills both.
    """
    spark = phrases.sparkSession
    words = F.split("phrase", " ")
    ordered = F.reverse(words) if backward else words
    rows = phrases.select("lang", *(F.get(ordered, F.lit(k)).alias(f"w{k + 1}") for k in range(longest)), "phrase", "f")
    order = ["lang", *(f"w{k + 1}" for k in range(longest))]
    ranged = rows.repartitionByRange(*(F.col(c).asc_nulls_first() for c in order)).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in order))
    shape = ", ".join(["range int", "place long", "n int", "lang string", "phrase string", "f long", *(f"part_{k} long" for k in range(1, longest)), "more long"])
    walked = ranged.withColumn("range", F.spark_partition_id()).mapInArrow(lambda batches: _walk(batches, longest), shape)
    return _joined_ranges(stored(walked, "phrase-walk"), longest)


def _walk(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """Walk one range.  ``stand`` holds the phrases that the walk is inside of, one of a length at most; a row leaves when the walk leaves it."""
    stand: list[list | None] = [None] * (longest + 1)
    done: list[list] = []
    place = 0
    names = ["range", "place", "n", "lang", "phrase", "f", *(f"part_{k}" for k in range(1, longest)), "more"]
    types = [pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.string(), *[pa.int64()] * (longest + 1)]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ["range", "lang", "phrase", "f"]]
        null = np.array([batch.column(1 + k).is_null().to_numpy(zero_copy_only=False) for k in range(longest)])
        for number, lang, phrase, f, n in zip(*columns, (longest - null.sum(0)).tolist()):
            for k in range(n, longest + 1):
                if stand[k] is not None:
                    done.append(stand[k])
                    stand[k] = None
            parts = [stand[k][5] if k < n and stand[k] is not None else None for k in range(1, longest)]
            stand[n] = [number, place, n, lang, phrase, f, *parts, 0]
            place += 1
            above = stand[n - 1]
            if above is not None and above[-1] < f:
                above[-1] = f
        if len(done) > 20_000:
            yield out()
            done.clear()
    done += [row for row in stand if row is not None]
    if done:
        yield out()


def _joined_ranges(walked: DataFrame, longest: int) -> DataFrame:
    """Fill what a range's first rows lack from the ranges before it, and what its last rows lack from those behind it.

    One row a range and length goes through the driver: the counts that the walk stands in at the range's end, and the largest extension among
    the rows at its head whose shorter phrase isn't in the range.
    """
    spark = walked.sparkSession
    ends = {(r.range, r.n): (r.place, r.f) for r in walked.groupBy("range", "n").agg(F.max("place").alias("place"), F.max_by("f", "place").alias("f")).collect()}
    opened: dict[tuple[int, int], int] = {}
    for n in range(2, longest + 1):
        head = walked.where((F.col("n") == n) & F.col(f"part_{n - 1}").isNull())
        opened.update({(r.range, n): r.f for r in head.groupBy("range").agg(F.max("f").alias("f")).collect()})
    numbers = sorted({r for r, _ in ends})
    stand: list[tuple[int, int] | None] = [None] * (longest + 1)  # per length: where the walk stands, as (range, place), and its count
    count: list[int | None] = [None] * (longest + 1)
    fill, reach = [], {}
    for r in numbers:
        fill.append((r, *count[1:longest]))
        for n in range(2, longest + 1):
            if (r, n) in opened and stand[n - 1]:
                reach[stand[n - 1]] = max(opened[r, n], reach.get(stand[n - 1], 0))
        here = sorted((place, n, f) for n in range(1, longest + 1) if (r, n) in ends for place, f in [ends[r, n]])
        for place, n, f in here:  # a shorter phrase ends all longer ones before it
            stand[n], count[n] = (r, place), f
            stand[n + 1:], count[n + 1:] = [None] * (longest - n), [None] * (longest - n)
    parts = [f"part_{k}" for k in range(1, longest)]
    carried = spark.createDataFrame(fill or [], "range int, " + ", ".join(f"carried_{p} long" for p in parts))
    later = spark.createDataFrame([(r, p, f) for (r, p), f in reach.items()], "range int, place long, later long")
    full = walked.join(F.broadcast(carried), "range", "left").join(F.broadcast(later), ["range", "place"], "left")  # a row or two a range
    whole = [F.when(F.col("n") > k + 1, F.coalesce(p, f"carried_{p}")).alias(p) for k, p in enumerate(parts)]
    return full.select("lang", "phrase", "n", "f", *whole, F.greatest("more", F.coalesce("later", F.lit(0))).alias("more"))


def mine(docs: DataFrame, least: int = 10, covered: int = 50, reported: int = REPORTED) -> DataFrame:
    """Each language's first ``reported`` phrases of 2 and 3 words that occur ``least`` times or more.

    Columns lang, rank, phrase, a, l, r, n, score.  ``covered``: percentage of a candidate's occurrences from which a longer candidate that holds it drops it.
    """
    streams, totals = frequent_phrases(docs, least, 3)
    everything = streams[0].unionByName(streams[1]).unionByName(streams[2])
    left = _walked(everything, 3, backward=False).where("n > 1").withColumnsRenamed({"part_1": "left_1", "part_2": "left_2", "more": "more_right"})
    right = _walked(everything, 3, backward=True).where("n > 1").select("lang", "phrase", F.col("part_1").alias("right_1"), F.col("part_2").alias("right_2"), F.col("more").alias("more_left"))
    both = left.hint("merge").join(right, ["lang", "phrase"])
    alone = both.where(F.greatest("more_left", "more_right") * 100 < F.col("f") * covered)

    def cut(k: int, l: Column, r: Column) -> Column:  # noqa: E741
        """Products of two counts pass 64 bits: 36 and 37 digits hold them."""
        square = F.lit(1_000_000).cast("decimal(7,0)") * F.col("f").cast("decimal(15,0)") * F.col("f").cast("decimal(15,0)")
        score = F.call_function("div", square, l.cast("decimal(18,0)") * r.cast("decimal(18,0)"))
        return F.struct(score.alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))

    behind_first = F.when(F.col("n") == 2, F.col("right_1")).otherwise(F.col("right_2"))
    lowest = F.least(cut(1, F.col("left_1"), behind_first), F.when(F.col("n") == 3, cut(2, F.col("left_2"), F.col("right_1"))))
    scored = alone.select("lang", "phrase", F.col("f").alias("a"), lowest.alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= reported)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
