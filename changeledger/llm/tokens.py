"""Token ids of whole texts by the public tokenizers, with a bounded memo of chunks between white space.

Both vocabularies split a text before their merges run, and never inside a run of non-space characters on
both sides of a plain space.  So the ids of a text are the ids of its chunks in order, and the chunks of a
corpus repeat: Arrow splits a batch of texts and numbers its different chunks, most of those are found in the
memo, and the library encodes each missing one once.  A text that holds the content of an added token, such as
<|endoftext|>, goes to the library whole, which reads it as its one id.
"""

from __future__ import annotations

import gc
import json
import os
import re
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe import Merges, gather

#: Chunks remembered per worker; beyond it the memo starts anew (memory bound, no effect on the ids).
MEMO_CHUNKS = 700_000
#: Bytes of text handled at once.
BATCH_BYTES = 4 << 20

#: White space other than single spaces and line ends inside the text; texts with any go to the library whole.
_ODD_SPACE = (r"[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
              r"|\A[ \n]|[ \n]\z|[ \n][ \n]")
#: ASCII punctuation but the apostrophe, which can begin a contraction.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_LOADED: dict[str, Encoder] = {}


def _still_letter(char: str) -> bool:
    """A letter that stays one when normalised and lower-cased (some become a letter and a mark)."""
    return char.isalpha() and normalize("NFC", char) == char and normalize("NFC", char).lower().isalpha()


#: Letters up to U+024F, which all versions of Unicode tell alike, and those of them that are not capitals.
_LATIN = [c for c in map(chr, range(0x250)) if _still_letter(c)]
_LETTERS, _LOWER_LETTERS = "".join(_LATIN), "".join(c for c in _LATIN if c.lower() == c)


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """``encode(texts)`` gives the ids of an Arrow string array as one numpy array of ``dtype``, and each text's end in it."""

    def __init__(self, path: str, memo_chunks: int | None = None, batch_bytes: int | None = None):
        self.memo_chunks, self.batch_bytes = memo_chunks or MEMO_CHUNKS, batch_bytes or BATCH_BYTES
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        # A vocabulary that drops white space has no ids for it; one that keeps it glues a space to the next word.
        self.keeps_space = bool(len(self._whole(" ")))
        self.folds_case = self._whole("A").tolist() == self._whole("a").tolist()
        self.added = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        if self.added and self.folds_case:  # chunks are lower-cased here, and only the library knows which spelling counts
            self.added = f"(?i){self.added}"
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.merges = Merges(model["vocab"], model["merges"], model["end_of_word_suffix"] or "")
        self.tails: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        """Chunk → number; the ids of chunk k are ids[ends[k] : ends[k + 1]]."""
        self.memo: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, self.dtype)
        self.ends = np.zeros(1 << 18, np.int32)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)

    def _each(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks that stand alone, by one call of the library."""
        done = self.tokenizer.encode(chunks, is_pretokenized=True, add_special_tokens=False)
        ids, word = done.ids, np.array(done.word_ids, np.int64)
        cut = np.searchsorted(word, np.arange(len(chunks) + 1)).tolist()
        return [ids[i:j] for i, j in zip(cut, cut[1:])]

    def _tail(self, tail: str) -> list[int]:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[tail] = self._whole(tail).tolist()
        return self.tails[tail]

    def _learn(self, missing: pa.Array) -> None:
        """Remember new chunks.  Punctuation after a letter is merged apart from it, so "word," needs "word" and ","."""
        stripped = pc.utf8_rtrim(missing, characters=_TAIL)
        core = pc.if_else(pc.match_substring_regex(stripped, f"[{_LETTERS}]$"), stripped, missing)
        if self.folds_case:
            core = pc.if_else(pc.string_is_ascii(core), pc.ascii_lower(core), core)
        coded = core.dictionary_encode()
        names = coded.dictionary.to_pylist()
        number = np.array([self.memo.get(c, -1) for c in names], np.int64)
        new = np.flatnonzero(number < 0)
        number[new] = self._remember([names[k] for k in new], *self._cores(coded.dictionary.take(pa.array(new))))
        # Chunks that are more than their core: its ids and those of the punctuation.
        longer = np.flatnonzero(~pc.equal(core, missing).to_numpy(zero_copy_only=False))
        chunks = missing.take(pa.array(longer)).to_pylist()
        cut = (pc.binary_length(missing).to_numpy() - pc.binary_length(core).to_numpy())[longer].tolist()
        tails = pa.array([c[len(c) - n:] for c, n in zip(chunks, cut)], pa.string()).dictionary_encode()
        tail_ids = [self._tail(t) for t in tails.dictionary.to_pylist()]
        tail_size = np.array([len(t) for t in tail_ids], np.int64)
        of_core, of_tail = number[coded.indices.to_numpy()[longer]], tails.indices.to_numpy()
        core_size = (self.ends[of_core + 1] - self.ends[of_core]).astype(np.int64)
        cores = gather(self.ids, self.ends[of_core], core_size, np.arange(len(of_core)))
        ids = np.concatenate([cores, np.fromiter(chain.from_iterable(tail_ids), self.dtype, int(tail_size.sum()))])
        begin = np.stack([np.cumsum(core_size) - core_size, len(cores) + (np.cumsum(tail_size) - tail_size)[of_tail]], 1).ravel()
        size = np.stack([core_size, tail_size[of_tail]], 1)
        self._remember(chunks, gather(ids, begin, size.ravel(), np.arange(size.size)), size.sum(1))

    def _cores(self, cores: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks without punctuation at the end, and their numbers: runs of Latin letters, which the vocabulary's preparation leaves
        as they are, by its merges alone and all at once, others by the library."""
        letters = pc.match_substring_regex(cores, f"^[{_LOWER_LETTERS if self.folds_case else _LETTERS}]+$").to_numpy(zero_copy_only=False)
        plain, odd = np.flatnonzero(letters), np.flatnonzero(~letters)
        size = np.zeros(len(cores), np.int64)
        parts = [np.zeros(0, np.int64)]
        if len(plain):
            words = cores.take(pa.array(plain))
            if self.keeps_space:
                words = pc.binary_join_element_wise(pa.scalar(" ", words.type), words, pa.scalar("", words.type))
            begin, end = np.frombuffer(words.buffers()[1], np.int64)[[words.offset, words.offset + len(words)]]
            ids, size[plain] = self.merges.of_words(np.frombuffer(words.buffers()[2], np.uint8)[begin:end], pc.binary_length(words).to_numpy())
            parts.append(ids)
        if len(odd):
            lists = self._each([self._plain(c) for c in cores.take(pa.array(odd)).to_pylist()])
            size[odd] = [len(x) for x in lists]
            parts.append(np.fromiter(chain.from_iterable(lists), np.int64))
        order = np.concatenate([plain, odd])
        begin = np.zeros(len(cores), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        return gather(np.concatenate(parts), begin, size, np.arange(len(cores))), size

    def _remember(self, chunks: list[str], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number chunks that the memo doesn't have, with their ids one after another."""
        n, at, total = len(self.memo), int(self.ends[len(self.memo)]), len(ids)
        while at + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(chunks) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[at:at + total] = ids
        self.ends[n + 1:n + 1 + len(chunks)] = at + np.cumsum(size)
        self.memo.update(zip(chunks, range(n, n + len(chunks))))
        return np.arange(n, n + len(chunks))

    def _plain(self, chunk: str) -> str:
        """The text that a chunk stands for: with the space before it, unless it begins a line."""
        if not self.keeps_space:
            return chunk
        return chunk[1:] if chunk[:1] == "\r" else " " + chunk

    def _batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.memo) > self.memo_chunks:
            self._forget()
        patterns = [p for p in (self.added, _ODD_SPACE if self.keeps_space else "") if p]
        odd = np.zeros(len(texts), bool)
        for pattern in patterns:
            odd |= pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), pa.scalar("", texts.type), texts) if odd.any() else texts
        odd = np.flatnonzero(odd).tolist()
        if self.keeps_space:
            empty = pc.equal(plain, "")
            marked = pc.binary_join_element_wise(pa.scalar("\r", texts.type), pc.replace_substring(plain, "\n", " \r\n \r"), pa.scalar("", texts.type))
            lists = pc.split_pattern(pc.if_else(empty, pa.scalar("", texts.type), marked), " ")
        else:
            lists = pc.split_pattern(pc.replace_substring(plain, "\n", " "), " ")
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.combine_chunks()
        chunks = lists.flatten().dictionary_encode()
        different = chunks.dictionary.to_pylist()
        self.memo.setdefault("", 0)  # the first chunk of all: no ids
        found = list(map(self.memo.get, different))
        unknown = [k for k, n in enumerate(found) if n is None]
        if unknown:
            self._learn(chunks.dictionary.take(pa.array(unknown)))
            for k in unknown:
                found[k] = self.memo[different[k]]
        number = np.array(found, np.int32)
        begin, size = self.ends[number], self.ends[number + 1] - self.ends[number]
        index = chunks.indices.to_numpy()
        end = np.cumsum(size[index], dtype=np.int32)
        ends = np.concatenate([[0], end])[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]
        del end
        parts = [np.zeros(0, self.dtype)]
        for at in range(0, len(index), 1 << 18):  # in slices, as the places of ids take more room than the text
            i = index[at:at + (1 << 18)]
            n = size[i]
            end = np.cumsum(n, dtype=np.int32)
            parts.append(self.ids[np.repeat(begin[i] - (end - n), n) + np.arange(end[-1], dtype=np.int32)])
        ids = np.concatenate(parts)
        if odd:
            parts, at = [], 0
            whole = {i: self._whole(texts[i].as_py()) for i in odd}
            for i in odd:  # their place is empty so far
                parts += [ids[at:ends[i]], whole[i]]
                at = int(ends[i])
            ids = np.concatenate([*parts, ids[at:]])
            more = np.zeros(len(texts), np.int64)
            more[odd] = [len(whole[i]) for i in odd]
            ends = ends + np.cumsum(more)
        return ids, ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts may not be null.  Long batches are handled in pieces."""
        texts = texts.cast(pa.large_string())
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        cuts = [0]
        while cuts[-1] < len(texts):
            before = size[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(size, before + self.batch_bytes, side="right"))))
        collects = gc.isenabled()
        gc.disable()  # many short lists and no cycles: the collector would walk them all in vain
        try:
            parts = [self._batch(texts.slice(i, j - i)) for i, j in zip(cuts, cuts[1:])]
        finally:
            if collects:
                gc.enable()
        base = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]).astype(np.int64)
        ids = np.concatenate([np.zeros(0, self.dtype), *(p[0] for p in parts)])
        return ids, np.concatenate([np.zeros(0, np.int64), *(p[1] + b for p, b in zip(parts, base))])

    def encode_ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with ``end_id`` after each text."""
        ids, ends = self.encode(texts)
        return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian bytes."""
        ids, ends = self.encode(pa.array(texts, pa.large_string()))
        raw, cut = ids.tobytes(), [0, *(ends * self.dtype.itemsize).tolist()]
        return [raw[i:j] for i, j in zip(cut, cut[1:])]


def encoder(path: str, memo_chunks: int | None = None, batch_bytes: int | None = None) -> Encoder:
    """The encoder of a vocabulary file, loaded once per Python worker; the limits trade memory for speed only."""
    key = f"{path}|{memo_chunks}|{batch_bytes}"
    if key not in _LOADED:
        _LOADED[key] = Encoder(path, memo_chunks, batch_bytes)
    return _LOADED[key]
