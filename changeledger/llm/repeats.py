"""Repeated byte strings across documents by the interval tree of a sparse enhanced suffix array (operator 9).

A byte is removed when a string of ``MIN_BYTES`` bytes that covers it also starts anywhere else.

*Anchors.*  Every window of MIN_BYTES bytes has the ``GRAM``-byte grams with the smallest hash in it as anchors, so equal windows
have the same anchors at the same offsets, and only suffixes that start at an anchor need sorting: about one in 70.  An anchor
at p serves the windows that start at p - o for its offsets a <= o <= b, so ``b`` bytes to its left and ``MIN_BYTES - a`` to its right decide all.

*Marks.*  Anchors meet by gram hash.  One without a partner is dropped.  Copies with the same surroundings are repeats as they are;
of each different surrounding one anchor goes on, if its gram has several.

*Scan.*  Spark sorts the suffixes (gram, bytes to the right); that is the suffix array.  Neighbours' common prefixes and a stack give its
interval tree.  An interval of common prefix r is a group of suffixes that share r bytes; the bytes to the left say whether they differ
there or the repeat extends, and for each member how far it extends together with another member (L).  Member p then has a maximal
repeat from p - L to p + r, and its windows with offsets from MIN_BYTES - r to L also start elsewhere.

*Large groups.*  A gram with more than ``GROUP`` different surroundings is not scanned in one task.  Its offsets are halved along fixed
bounds: a window with an offset in [A, B] needs only equal bytes from p - A to p + MIN_BYTES - B, which is the key of the half.
Counting keys, and equal surroundings within the half, are aggregations; halves with few different surroundings go to the scan, and the others are
halved again, down to single windows, whose key is the window itself.  No case is left out.

Grams are matched by 64-bit hashes and then compared by bytes; equal surroundings are told by gram hash and a second 64-bit hash, or by MD5.
A map task folds the copies that it sees itself before the shuffle.

Defined results: a null text is empty; empty and short texts keep all bytes; rows that repeat, with the same id or not, are a document each; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import runs, slices, stored, text_or_empty

MIN_BYTES = 200
GRAM = 64
GROUP = 4096
#: Rows of one gram that the marking task holds at once; more count as a large group.
HELD = 1 << 18
#: Anchors among which a map task folds its own copies.
FOLDED = 200_000
SURE, OPEN, LARGE = 0, 1, 2

_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SPAN = "rid long, start long, stop long, repeat long"
_SPAN_NAMES = ["rid", "start", "stop", "repeat"]
_SUFFIX = "key long, rid long, pos long, a int, b int, left binary, right binary"


# ---- anchors of one text -------------------------------------------------------------------------------

def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from every place, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    out, out_len, step, p, k = None, 0, 1, _MUL, size
    while True:
        if k & 1:
            if out is None:
                out, out_len = h, step
            else:
                n = len(data) - out_len - step + 1
                out = out[:n] * p + h[out_len:out_len + n]
                out_len += step
        k >>= 1
        if not k:
            break
        n = len(data) - 2 * step + 1
        h = h[:n] * p + h[step:step + n]
        step = step * 2
        with np.errstate(over="ignore"):  # modulo 2**64, as the arrays
            p = p * p
    out = (out ^ (out >> np.uint64(29))) * _MIX
    return out ^ (out >> np.uint64(32))


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over every ``width`` neighbours."""
    n, size = len(values) - width + 1, 1
    while size * 2 <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    return best(values[:n], values[width - size:width - size + n])


def anchors(data: np.ndarray, window: int = MIN_BYTES, gram: int = GRAM):
    """(place, a, b, hash) of every anchor: the windows from place - b to place - a have it as a smallest gram."""
    if len(data) < window:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    width = window - gram + 1
    h = gram_hashes(data, gram)
    low = sliding(h, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    places = np.flatnonzero(sliding(np.concatenate([edge, low, edge]), width, np.maximum) == h)
    new = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))  # runs of windows with one smallest hash
    first, last = new, np.append(new[1:], len(low)) - 1
    lo, hi = np.searchsorted(places, first), np.searchsorted(places, last + width)
    run = np.repeat(np.arange(len(new)), hi - lo)
    at = places[np.arange(len(run)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + lo[run]]
    begin, end = np.maximum(first[run], at - width + 1), np.minimum(last[run], at)
    own = (h[at] == low[first[run]]) & (begin <= end)
    at, begin, end = at[own], begin[own], end[own]
    return at, at - end, at - begin, h[at]


def _anchored(docs: DataFrame) -> DataFrame:
    """(gram, around, rid, place, folded): place packs pos, a and b; a row for every anchor, or one for copies seen in the same task.

    Copies beyond the first come with ``folded`` 2, under a gram that spreads them: they are repeats already.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def folded():
            gram, around, rid, place = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((around, gram))
            gram, around, rid, place = gram[order], around[order], rid[order], place[order]
            same = (gram[1:] == gram[:-1]) & (around[1:] == around[:-1])
            state = np.zeros(len(gram), np.int64)
            state[:-1] |= same  # the first of several: 1
            state[1:][same] = 2
            again = state == 2
            spread = np.where(again, rid.view(np.uint64) * _MUL + place.view(np.uint64), gram)
            first = state == 1  # what the first has to say to others is in its row; that it is a repeat itself, in one more
            return pa.record_batch([pa.array(np.concatenate(x)) for x in (
                (spread.view(np.int64), rid[first] * 31 + place[first]), (around.view(np.int64), around[first].view(np.int64)),
                (rid, rid[first]), (place, place[first]), (state, np.full(int(first.sum()), 2)))],
                ["gram", "around", "rid", "place", "folded"])

        for b in slices(batches):
            for rid, text in zip(b.column("rid").to_pylist(), b.column("text").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                if len(data) < MIN_BYTES:
                    continue
                at, lo, hi, gram = anchors(np.frombuffer(data, np.uint8))
                digest = xxhash.xxh3_64_intdigest
                around = np.array([digest(data[p - y:p - x + MIN_BYTES], x << 8 | y) for p, x, y in zip(at.tolist(), lo.tolist(), hi.tolist())], np.uint64)
                held.append((gram, around, np.full(len(at), rid, np.int64), at << 16 | lo << 8 | hi))
                n += len(at)
            if n >= FOLDED:
                yield folded()
                held, n = [], 0
        if held:
            yield folded()

    return docs.mapInArrow(run, "gram long, around long, rid long, place long, folded long")


def _marks(rows: DataFrame) -> DataFrame:
    """(rid, gram, place, state) of anchors with a partner."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large = None  # gram of a group that is too large to be held

        def judged(gram, around, rid, place, folded, cut):
            """Complete grams, or (``cut``) a part of a large one."""
            nonlocal large
            n = len(gram)
            if not n:
                return
            new = np.concatenate([[True], gram[1:] != gram[:-1]])
            other = new | np.concatenate([[True], around[1:] != around[:-1]])
            group, kind = np.cumsum(new) - 1, np.cumsum(other) - 1
            several = np.bincount(kind)[kind] > 1
            kinds = np.bincount(group[other])[group]
            done = folded == 2
            is_large = (kinds > GROUP) | ((gram == large) if large is not None else False)
            if cut:
                is_large |= gram == gram[-1]
                large = gram[-1]
            state = np.full(n, -1)
            state[several | done] = SURE
            ask = other & ~done & ((kinds > 1) | is_large)
            state[ask & ~is_large] = OPEN
            state[ask & is_large] = LARGE
            extra = ask & several  # a repeat itself, and partner of the others
            take = state >= 0
            name = np.where(state == SURE, around, gram)  # a repeat goes by its surroundings, others by the gram where they meet
            yield pa.record_batch([pa.array(x) for x in (np.concatenate([rid[take], rid[extra]]), np.concatenate([name[take], around[extra]]),
                                                         np.concatenate([place[take], place[extra]]))]
                                  + [pa.array(np.concatenate([state[take], np.full(int(extra.sum()), SURE)]).astype(np.int32))],
                                  ["rid", "gram", "place", "state"])

        names = ("gram", "around", "rid", "place", "folded")
        held = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            if not batch.num_rows:
                continue
            held = [np.concatenate([x, batch.column(k).to_numpy(zero_copy_only=False)]) for x, k in zip(held, names)]
            last = int(np.flatnonzero(held[0] == held[0][-1])[0])
            if len(held[0]) - last > HELD:
                yield from judged(*held, cut=True)
                held = [x[:0] for x in held]
            elif last >= HELD // 4 or last == len(held[0]):
                yield from judged(*(x[:last] for x in held), cut=False)
                held = [x[last:] for x in held]
        yield from judged(*held, cut=False)

    return rows.repartition("gram").sortWithinPartitions("gram", "around").mapInArrow(run, "rid long, gram long, place long, state int")


# ---- the scan ------------------------------------------------------------------------------------------

def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(r, first, last) of the interval tree; prefixes[i] is what sorted suffixes i and i + 1 have in common."""
    stack = [(-1, 0)]
    for i, r in enumerate([*prefixes, -1]):
        first = i
        while stack[-1][0] > r:
            top, first = stack.pop()
            yield top, first, i
        if stack[-1][0] < r:
            stack.append((r, first))


def repeats_of(group: list[tuple], window: int = MIN_BYTES, every: bool = False) -> Iterator[tuple[int, int, int, int]]:
    """(rid, start, stop, repeat) of the suffixes (rid, pos, a, b, left, right) of one key, sorted by ``right``.

    ``left`` is reversed.  ``repeat`` is a hash of the repeated bytes.  With ``every``, each maximal repeat comes with all its
    occurrences.  Without, each member comes with what its repeats cover, joined where they overlap, under the name of the
    longest: of an interval only the member's longest repeat matters for that.
    """
    least = window - max(x[3] for x in group)
    rank = sorted(range(len(group)), key=lambda i: group[i][4])
    prefixes = [common(x[5], y[5]) for x, y in zip(group, group[1:])]

    def span(i: int, low: int, high: int) -> tuple[int, int, int, int]:
        rid, pos, _, _, before, after = group[i]
        text = before[:high][::-1] + after[:window - low]
        return rid, pos - high, pos - low + window, xxhash.xxh3_64_intdigest(text) - (1 << 63)

    longest: list[list[tuple[int, int]]] = [[] for _ in group]
    for r, first, last in intervals(prefixes):
        if r < least:
            continue
        own = [i for i in rank if first <= i <= last] if last - first < len(group) - 1 else rank
        # Sorted by what stands before, neighbours say how far each member extends to the left with another.
        left = [common(group[i][4], group[j][4]) for i, j in zip(own, own[1:])]
        if every:
            for high, k, n in intervals(left):
                members = own[k:n + 1]
                # Left-diverse by its interval; right-diverse if its members don't share more than r.
                if high >= window - r and min(prefixes[min(members):max(members)]) == r:
                    yield from (span(i, window - r, high) for i in members)
        else:
            for i, x, y in zip(own, [0, *left], [*left, 0]):
                if max(x, y) >= window - r:
                    longest[i].append((window - r, max(x, y)))
    for i, found in enumerate(longest):
        if found:
            low, high = max(found, key=lambda x: (x[1] - x[0], x))
            name, pos = span(i, low, high)[3], group[i][1]
            found.sort()
            low, high = found[0]
            for x, y in found[1:]:
                if x - high >= window:  # offsets that far apart cover bytes that don't touch
                    yield group[i][0], pos - high, pos - low + window, name
                    low = x
                high = max(high, y)
            yield group[i][0], pos - high, pos - low + window, name


def _scanned(suffixes: DataFrame) -> DataFrame:
    """Spans of the suffixes that share a key; a key has at most GROUP of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, "key"):
            out, group, now = [], [], None
            for key, *row in zip(*(c.to_pylist() for c in t.columns)):
                if key != now:
                    if len(group) > 1:
                        out += repeats_of(group)
                    group, now = [], key
                group.append(row)
            if len(group) > 1:
                out += repeats_of(group)
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], _SPAN_NAMES)

    return suffixes.repartition("key").sortWithinPartitions("key", "right").mapInArrow(run, _SPAN)


def _suffixes(texts: DataFrame, state: int) -> DataFrame:
    """Suffix rows of the marked anchors in ``state``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            out = []
            for rid, text, marks in zip(*(batch.column(k).to_pylist() for k in ("rid", "text", "marks"))):
                data = text.encode("utf-8", "surrogatepass")
                for m in marks:
                    if m["state"] == state:
                        pos, a, b = m["place"] >> 16, m["place"] >> 8 & 255, m["place"] & 255
                        out.append((m["gram"], rid, pos, a, b, data[pos - b:pos][::-1], data[pos:pos - a + MIN_BYTES]))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["key", "rid", "pos", "a", "b", "left", "right"])

    return texts.mapInArrow(run, _SUFFIX)


def _halved(large: DataFrame) -> list[DataFrame]:
    """Spans of the suffixes of large groups, by halving their offsets."""
    found, width = [], 64

    def prefix(name: str, n: Column) -> Column:
        return F.substring(F.col(name), F.lit(1), n.cast("int"))

    while True:
        low, high = F.col("low"), F.col("low") + F.lit(width - 1)  # the fixed bounds; a and b stay inside them
        halves = large.withColumn("low", F.explode(F.sequence(F.floor(F.col("a") / width), F.floor(F.col("b") / width)))) \
            .withColumn("low", (F.col("low") * width).cast("int"))
        halves = halves.withColumn("a", F.greatest("a", low)).withColumn("b", F.least("b", high)) \
            .withColumn("left", prefix("left", F.col("b"))).withColumn("right", prefix("right", F.lit(MIN_BYTES) - F.col("a")))
        halves = halves.withColumn("part", F.md5(F.concat(prefix("left", low), prefix("right", F.lit(MIN_BYTES) - high), F.concat_ws(
            ",", F.lit(str(width)), low).cast("binary")))) \
            .withColumn("around", F.md5(F.concat(F.col("left"), F.col("right"), F.concat_ws(",", "a", "b", "low").cast("binary"))))
        halves = stored(halves, f"op9-halves{width}")
        kinds = halves.groupBy("part", "around").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("rid", "pos")).alias("one"))
        parts = kinds.groupBy("part").agg(F.count(F.lit(1)).alias("kinds"))
        judged = stored(halves.join(kinds, ["part", "around"]).join(parts, "part"), f"op9-judged{width}")
        found.append(judged.where("copies > 1").select(
            "rid", (F.col("pos") - F.col("b")).alias("start"), (F.col("pos") - F.col("a") + MIN_BYTES).alias("stop"),
            F.xxhash64("around").alias("repeat")))
        one = judged.where((F.col("kinds") > 1) & (F.col("one") == F.struct("rid", "pos")))
        names = ["rid", "pos", "a", "b", "left", "right"]
        few = one.where(F.col("kinds") <= GROUP).select(F.xxhash64("part").alias("key"), *names)
        found.append(stored(_scanned(few), f"op9-few{width}"))
        large = one.where(F.col("kinds") > GROUP).select(*names)
        if width == 1 or large.isEmpty():  # at width 1 a part has one kind: the window itself
            return found
        width //= 2


# ---- the operator --------------------------------------------------------------------------------------

class Repeats:
    """The repeats of a corpus: ``rows`` (rid, doc_id, n_bytes, sha256), ``texts`` with repeats, and ``spans`` (rid, start, stop, repeat)."""

    def __init__(self, docs: DataFrame):
        # Stored once, so that marks, texts and rows go by the same row numbers.
        texts = stored(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                                   text_or_empty().alias("text")), "op9-docs")
        self.rows = texts.select("rid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256"))
        marks = stored(_marks(_anchored(texts.select("rid", "text"))), "op9-marks")
        marked = marks.groupBy("rid").agg(F.collect_list(F.struct("gram", "place", "state")).alias("marks"))
        self.texts = stored(texts.select("rid", "text").where(F.octet_length("text") >= MIN_BYTES).join(marked, "rid"), "op9-texts")
        sure = marks.where(F.col("state") == SURE).select(
            "rid", (F.shiftright("place", 16) - F.col("place").bitwiseAND(F.lit(255))).alias("start"),
            (F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(F.lit(255)) + MIN_BYTES).alias("stop"), F.col("gram").alias("repeat"))
        self.spans = sure.unionByName(stored(_scanned(_suffixes(self.texts, OPEN)), "op9-spans"))
        if not marks.where(F.col("state") == LARGE).isEmpty():
            for more in _halved(stored(_suffixes(self.texts, LARGE), "op9-large")):
                self.spans = self.spans.unionByName(more)

    def _cut(self, with_text: bool) -> DataFrame:
        """rid, n_removed, n_spans, kept_sha256 and the kept bytes, of texts with repeats."""
        spans = self.spans.groupBy("rid").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 200):
                out = []
                for rid, text, found in zip(*(batch.column(k).to_pylist() for k in ("rid", "text", "spans"))):
                    data, kept, at, removed, n = text.encode("utf-8", "surrogatepass"), [], 0, 0, 0
                    stop = -1
                    for s in sorted((x["start"], x["stop"]) for x in found):
                        if s[0] > stop:  # spans that touch are one run
                            n += 1
                            kept.append(data[at:s[0]])
                            stop = at = s[0]
                        if s[1] > stop:
                            removed += s[1] - stop
                            stop = at = s[1]
                    kept = b"".join([*kept, data[at:]])
                    out.append((rid, removed, n, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                      ["rid", "n_removed", "n_spans", "kept_sha256", "kept"])

        return self.texts.select("rid", "text").join(spans, "rid").mapInArrow(
            run, "rid long, n_removed long, n_spans long, kept_sha256 string, kept binary")

    def report(self) -> DataFrame:
        """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per document."""
        cut = self._cut(with_text=False).drop("kept")
        zero = F.lit(0).cast("long")
        return self.rows.join(cut, "rid", "left").select(
            "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
            F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))

    def kept(self) -> DataFrame:
        """rid and the remaining bytes of the texts that lose some."""
        return self._cut(with_text=True).select("rid", "kept")
