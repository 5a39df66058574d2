"""Token files: a static range asymmetric numeral system over independent interleaved blocks (operator 1).

File format, three Parquet datasets in one folder:

* ``table``: token id → frequency, one table shared by all blocks; frequencies sum to ``2**SCALE_BITS``.
* ``blocks``: one row per block of at most ``block_tokens`` consecutive ids.  The ids are dealt to ``lanes``
  interleaved coders that share one stream of 32-bit words.  A row holds the stream, the coders' start
  states, a checkpoint (stream place and states) every ``CHECKPOINT_ROWS`` rows of lanes, the CRC-32 of the
  raw ids, and the documents whose ids lie in the block, so that each block decodes by itself.
* ``parts``: first stream place of each part; parts follow each other in document order.

Parquet is the container, so the writer's commit protocol drops the output of lost or repeated tasks, and
any store that Spark reaches will do.

Defined results: a null text counts as empty and has the end id alone; null ids come first; repeated ids
follow their row numbers; an empty table gives three empty datasets and no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stored, text_or_empty
from .tokens import encoder

#: Frequencies are parts of 2**SCALE_BITS; a vocabulary may have up to as many ids.
SCALE_BITS = 20
#: Coder states stay in [2**31, 2**63) and move 32 bits at a time.
STATE_LOW = np.uint64(1 << 31)
BLOCK_TOKENS = 262_144
MAX_LANES = 2048
CHECKPOINT_ROWS = 32
COUNTS = -1
#: The tokenizer's limits here: about 70 MB a worker more than its defaults, for less CPU time.
MEMO_CHUNKS = 1_400_000
BATCH_BYTES = 8 << 20

_TOKEN_SCHEMA = "part int, pstart long, doc_id long, n int, ids binary"
_BLOCK_SCHEMA = ("part int, pstart long, n int, lanes int, states binary, words binary, checkpoints array<binary>, "
                 "crc32 long, docs array<struct<doc_id:long,pstart:long,before:long,n:int,after:long>>")


# ---- the coder, on arrays ------------------------------------------------------------------------------

def scaled(counts: dict[int, int], bits: int = SCALE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ids and frequencies that sum to 2**bits, at least 1 for each id seen, by largest remainders."""
    ids = np.array(sorted(counts), np.int64)
    total = 1 << bits
    if len(ids) > total:
        raise ValueError(f"{len(ids)} ids don't fit {bits} bits")
    if not len(ids):
        return ids, ids
    c = np.array([counts[i] for i in ids.tolist()], np.float64)
    share = c / c.sum() * (total - len(ids))
    freq = np.floor(share).astype(np.int64)
    left = total - len(ids) - int(freq.sum())
    order = np.lexsort((ids, -(share - freq)))
    freq[order[:left]] += 1
    return ids, freq + 1


class Coder:
    """Shared tables: encode and decode arrays of ids."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, bits: int = SCALE_BITS):
        self.bits = np.uint64(bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.ids = ids.astype(np.uint32)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
        self.rank = np.full(int(ids.max()) + 1, -1, np.int64)
        self.rank[ids] = np.arange(len(ids))
        self.slot = np.repeat(np.arange(len(ids), dtype=np.uint16 if len(ids) <= 1 << 16 else np.uint32), freq)
        self.pad = int(np.argmax(freq))
        self.limit_shift = np.uint64(63 - bits)

    def encode(self, tokens: np.ndarray, lanes: int):
        """(start states, words, checkpoints): the coders run backwards, so that decoding runs forwards."""
        rows = -(-len(tokens) // lanes)
        symbols = np.full(rows * lanes, self.pad, np.int64)
        symbols[:len(tokens)] = self.rank[tokens]
        if symbols.min() < 0:
            raise ValueError("an id is not in the frequency table")
        symbols = symbols.reshape(rows, lanes)
        x = np.full(lanes, STATE_LOW, np.uint64)
        chunks, marks, n_words = [], [], 0
        for r in range(rows - 1, -1, -1):
            f, c = self.freq[symbols[r]], self.start[symbols[r]]
            full = x >= (f << self.limit_shift)
            if full.any():
                chunks.append(x[full].astype("<u4"))
                n_words += len(chunks[-1])
                x[full] >>= np.uint64(32)
            q, rem = np.divmod(x, f)
            x = (q << self.bits) + rem + c
            if r and r % CHECKPOINT_ROWS == 0:
                marks.append((n_words, x.copy()))
        words = np.concatenate(chunks[::-1]) if chunks else np.empty(0, "<u4")
        marks = [np.int64(n_words - n).tobytes() + s.astype("<u8").tobytes() for n, s in reversed(marks)]
        return x.astype("<u8").tobytes(), words.tobytes(), marks

    def decode(self, n: int, lanes: int, states: bytes, words: bytes, checkpoints: list[bytes],
               first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids between checkpoints ``first`` and ``last`` (0: the block's start, None: its end)."""
        rows = -(-n // lanes)
        stream = np.frombuffer(words, "<u4")
        if first:
            mark = checkpoints[first - 1]
            at, x = int(np.frombuffer(mark[:8], "<i8")[0]), np.frombuffer(mark[8:], "<u8").astype(np.uint64)
        else:
            at, x = 0, np.frombuffer(states, "<u8").astype(np.uint64)
        begin = first * CHECKPOINT_ROWS
        end = rows if last is None or last > len(checkpoints) else last * CHECKPOINT_ROWS
        out = np.empty((max(0, end - begin), lanes), np.uint32)
        for r in range(end - begin):
            low = x & self.mask
            s = self.slot[low]
            out[r] = s
            x = self.freq[s] * (x >> self.bits) + low - self.start[s]
            need = x < STATE_LOW
            k = int(np.count_nonzero(need))
            if k:
                x[need] = (x[need] << np.uint64(32)) | stream[at:at + k]
                at += k
        return self.ids[out.reshape(-1)[:n - begin * lanes]]


def lanes_for(n: int) -> int:
    """A power of two: many lanes for long blocks, few for short ones, whose states would outweigh the words."""
    return max(1, min(MAX_LANES, 1 << max(0, (n // 64).bit_length() - 1)))


def crc32_shift(crc: int, zeros: int) -> int:
    """CRC-32 of data A, moved past ``zeros`` following bytes: crc(A + B) = crc32_shift(crc(A), len(B)) ^ crc(B)."""
    def apply(matrix: list[int], value: int) -> int:
        out = 0
        for row in matrix:
            if not value:
                break
            if value & 1:
                out ^= row
            value >>= 1
        return out

    matrix = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    bits = zeros * 8
    while bits and crc:
        if bits & 1:
            crc = apply(matrix, crc)
        bits >>= 1
        matrix = [apply(matrix, row) for row in matrix]
    return crc


# ---- the Spark operator --------------------------------------------------------------------------------

def tokenise(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Ids of each document plus the end id, in document order: rows of a part follow each other.

    Each task adds one row with part ``COUNTS``, whose ids are the counts of all ids in the task.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       F.monotonically_increasing_id().alias("rid"))
    # The row id lets one repeated document id spread over many ranges.
    key = [F.col("doc_id").asc_nulls_first(), F.col("rid")]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(vocabulary, MEMO_CHUNKS, BATCH_BYTES), TaskContext.get().partitionId(), 0
        counts = np.zeros(enc.size + 1, np.int64)
        for b in slices(batches, 4000):
            ids, ends = enc.encode_ended(b.column("text"), end_id)
            counts += np.bincount(ids, minlength=len(counts))
            offsets = np.concatenate([[0], ends])
            data = pa.Array.from_buffers(pa.binary(), len(ends), [
                None, pa.py_buffer((offsets * enc.dtype.itemsize).astype(np.int32)), pa.py_buffer(ids)])
            yield pa.record_batch([pa.array(np.full(len(ends), part, np.int32)), pa.array(at + offsets[:-1]), b.column("doc_id"),
                                   pa.array(np.diff(offsets).astype(np.int32)), data],
                                  ["part", "pstart", "doc_id", "n", "ids"])
            at += int(offsets[-1])
        if at:
            yield pa.record_batch([pa.array([COUNTS], pa.int32()), pa.array([part]), pa.nulls(1, pa.int64()), pa.array([0], pa.int32()),
                                   pa.array([counts.astype("<i8").tobytes()], pa.binary())], ["part", "pstart", "doc_id", "n", "ids"])

    return rows.mapInArrow(run, _TOKEN_SCHEMA)


def count_ids(counts: DataFrame) -> dict[int, int]:
    """Corpus count of every id, from one row of counts per task; the result has a row per id of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for row in b.column("ids").to_pylist():
                one = np.frombuffer(row, "<i8")
                total = one + total if len(total) else one
        ids = np.flatnonzero(total)
        yield pa.record_batch([pa.array(ids.astype(np.int64)), pa.array(total[ids].astype(np.int64))], ["id", "n"])

    rows = counts.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in rows}


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every text of ``docs`` (doc_id, text) into token files under ``folder``."""
    spark = docs.sparkSession
    dtype = encoder(vocabulary).dtype.str
    rows = stored(tokenise(docs, vocabulary, end_id), "op1-tokens")
    tokens = rows.where(F.col("part") != COUNTS)
    totals = {r["part"]: r["n"] for r in tokens.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    first, at = [], 0
    for part in sorted(totals):  # one entry per task of the writer, none per document
        first.append((part, at))
        at += totals[part]
    ids, freq = scaled(count_ids(rows.where(F.col("part") == COUNTS)))
    spark.createDataFrame(first, "part int, first long").coalesce(1).write.parquet(f"{folder}/parts")
    spark.createDataFrame(list(zip(ids.tolist(), freq.tolist())), "id long, freq long").coalesce(1) \
        .write.parquet(f"{folder}/table")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ids, freq) if len(ids) else None

        def block(part: int, docs: list[dict], raw: list[bytes]) -> pa.RecordBatch:
            data = b"".join(raw)
            values = np.frombuffer(data, dtype)
            lanes = lanes_for(len(values))
            states, words, marks = coder.encode(values, lanes)
            crc = zlib.crc32(values.astype("<u4").tobytes())
            row = {"part": part, "pstart": docs[0]["pstart"] + docs[0]["before"], "n": len(values), "lanes": lanes,
                   "states": states, "words": words, "checkpoints": marks, "crc32": crc, "docs": docs}
            return pa.RecordBatch.from_pylist([row], schema=_ARROW_BLOCK)

        size, now, held, raw, room = np.dtype(dtype).itemsize, None, [], [], block_tokens
        for b in slices(batches):
            for part, pstart, doc_id, n, data in zip(*(c.to_pylist() for c in b.columns)):
                if held and (part != now or pstart != held[-1]["pstart"] + held[-1]["before"] + held[-1]["n"]):
                    yield block(now, held, raw)
                    held, raw, room = [], [], block_tokens
                now, before = part, 0
                while before < n:
                    k = min(room, n - before)
                    held.append({"doc_id": doc_id, "pstart": pstart, "before": before, "n": k, "after": n - before - k})
                    raw.append(data[before * size:(before + k) * size])
                    before, room = before + k, room - k
                    if not room:
                        yield block(now, held, raw)
                        held, raw, room = [], [], block_tokens
        if held:
            yield block(now, held, raw)

    (tokens.mapInArrow(run, _BLOCK_SCHEMA).write.option("compression", "uncompressed").parquet(f"{folder}/blocks"))


_ARROW_BLOCK = pa.schema([
    ("part", pa.int32()), ("pstart", pa.int64()), ("n", pa.int32()), ("lanes", pa.int32()), ("states", pa.binary()),
    ("words", pa.binary()), ("checkpoints", pa.list_(pa.binary())), ("crc32", pa.int64()),
    ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("pstart", pa.int64()), ("before", pa.int64()),
                                 ("n", pa.int32()), ("after", pa.int64())])))])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Decode all blocks: one row per piece of a document (doc_id, start, before, after, ids as bytes of 32 bits)."""
    def emit(row: dict, first: int, data: memoryview) -> Iterator[tuple]:
        at = 0
        for d in row["docs"]:
            yield (d["doc_id"], first + d["pstart"], d["before"], d["n"], d["after"], bytes(data[at:at + 4 * d["n"]]))
            at += 4 * d["n"]

    return _decoded(spark, folder, emit, "doc_id long, start long, before long, n int, after long, ids binary")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 per document, from the files; checksums of pieces are combined."""
    def emit(row: dict, first: int, data: memoryview) -> Iterator[tuple]:
        at = 0
        for d in row["docs"]:
            crc = zlib.crc32(data[at:at + 4 * d["n"]])
            yield (d["doc_id"], first + d["pstart"], d["n"], crc32_shift(crc, 4 * d["after"]))
            at += 4 * d["n"]

    pieces = _decoded(spark, folder, emit, "doc_id long, start long, n long, crc long")
    return pieces.groupBy("start").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"),
                                       F.bit_xor("crc").alias("ids_crc32")) \
        .select("doc_id", "start", "n_tokens", "ids_crc32")


def _decoded(spark: SparkSession, folder: str, emit, schema: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/table").collect()  # one row per id of the vocabulary
    first = {r["part"]: r["first"] for r in spark.read.parquet(f"{folder}/parts").collect()}
    ids = np.array([r["id"] for r in table], np.int64)
    freq = np.array([r["freq"] for r in table], np.int64)
    order = np.argsort(ids)
    ids, freq = ids[order], freq[order]
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(ids, freq) if len(ids) else None
        for b in slices(batches, 1):
            row = b.to_pylist()[0]
            values = coder.decode(row["n"], row["lanes"], row["states"], row["words"], row["checkpoints"])
            data = memoryview(values.astype("<u4", copy=False)).cast("B")
            if zlib.crc32(data) != row["crc32"]:
                raise ValueError(f"block at {row['part']}, {row['pstart']}: checksum differs")
            rows = list(zip(*emit(row, first[row["part"]], data)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, arrow.types)], names)

    return spark.read.parquet(f"{folder}/blocks").mapInArrow(run, schema)
