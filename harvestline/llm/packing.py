"""Token sequences of bounded length, cut by dynamic programming in document order.

Every task turns its documents, in the order of the input, into one stream of
token ids and cuts it into sequences. A cut lies at the end of a document, or at
the end of a sentence for a penalty; only a sentence longer than a sequence is
cut elsewhere. Among all such cuts those with the least padding plus penalties are
taken. A sequence is padded to the window unless its length is a power of two.

Cost of a sequence that ends at ``p`` and starts at ``q``: ``window - (p - q)``,
so the best start has the smallest ``best[q] + q`` among those in reach, which a
monotone queue keeps at its head. Starts at a power of two are looked up besides.

A stream is cut in blocks of bounded size; the last sequence of a block is cut
again with the next block, so blocks leave no padding of their own. Nothing is
shuffled, and the last sequence of each task is the only one that is cut short.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BinaryType,
    LongType,
    StructField,
    StructType,
)

from harvestline.llm.common import Batches, map_arrow, slabs

VOCABULARY = "word_bpe_49k.json"
WINDOW = 2048
END_ID = 1
SENTENCE_PENALTY = 16  # in tokens of padding
FORCED_PENALTY = 256
SEQUENCE_COST = 32  # keeps sequences of short power-of-two lengths from winning
SHORTEST_POWER = 7
BLOCK = 1 << 20  # tokens cut at once
TEXT_SLAB = 4 << 20  # bytes of text split at once
KNOWN_WORDS = 1_500_000  # words whose ids a worker remembers
SPARSE = 8  # a sentence that is too long may be cut at every eighth of a window


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Words:
    """Token ids of white-space separated chunks, each looked up once.

    The tokenizer treats chunks between ASCII white space alike in any text, so
    their ids joined are those of the text. Upper-case ASCII is lowered and marks
    after a letter or digit are set apart first: both leave the ids as they are
    and make chunks repeat more often. When ``KNOWN_WORDS`` are known they are
    forgotten; that changes the time, not the ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        names = ((k.removesuffix("</w>"), v) for k, v in self.tokenizer.get_vocab().items())
        self.sentence_ends = np.array(
            [v for k, v in names if k and not any(map(str.isalnum, k)) and set(k) & set(".!?")],
            dtype=np.uint32,
        )
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.start = np.empty(0, dtype=np.int64)
        self.size = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.uint32)

    def _encode(self, word: str) -> list[int]:
        if word.isascii() and word.isalpha() and word.islower():
            return [t.id for t in self.model.tokenize(word)]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _learn(self, words: pa.Array) -> None:
        fresh = words.unique()
        made = [self._encode(w) for w in fresh.to_pylist()]
        size = np.fromiter(map(len, made), dtype=np.int64, count=len(made))
        start = len(self.ids) + np.cumsum(size) - size
        flat = np.fromiter((i for own in made for i in own), dtype=np.uint32, count=size.sum())
        self.known = pa.concat_arrays([self.known, fresh])
        self.start, self.size = np.append(self.start, start), np.append(self.size, size)
        self.ids = np.append(self.ids, flat)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.replace_substring_regex(
                pc.ascii_lower(texts), r"([\pL\pN])([.,;:!?])", r"\1 \2"
            )
        split = pc.ascii_split_whitespace(texts)
        words, ends = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        place = pc.index_in(words, self.known)
        if place.null_count:
            self._learn(words.filter(pc.is_null(place)))
            place = pc.index_in(words, self.known)
        place = place.to_numpy()
        size = self.size[place]
        last = np.cumsum(size)
        inside = np.arange(last[-1] if len(last) else 0) - np.repeat(last - size, size)
        ids = self.ids[np.repeat(self.start[place], size) + inside]
        cuts = np.append(0, last)[ends]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


_WORDS: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _WORDS:
        _WORDS[path] = Words(path)
    return _WORDS[path]


def padding(length: int, window: int = WINDOW) -> int:
    return 0 if length & (length - 1) == 0 else window - length


def best_cuts(place: list[int], penalty: list[int], window: int = WINDOW) -> list[int]:
    """Indices of the cuts, the last place included, that cost least.

    ``place``: rising places where a cut may be, the first one 0, none further
    from the one before than ``window``. ``penalty``: what a cut costs there.
    """
    count = len(place)
    at = np.asarray(place)
    powers = [1 << k for k in range(SHORTEST_POWER, window.bit_length()) if 1 << k <= window]
    exact = []
    for power in powers:
        found = np.searchsorted(at, at - power)
        found[at[found] != at - power] = -1
        exact.append(found)
    jumps = np.stack(exact, axis=1) if exact else np.empty((count, 0), dtype=int)
    jumping = (jumps >= 0).any(axis=1)
    best, back = [0] * count, [0] * count
    queue: deque[tuple[int, int]] = deque()
    for i in range(1, count):
        here = place[i]
        j = i - 1
        key = best[j] + place[j]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
        while place[queue[0][1]] < here - window:
            queue.popleft()
        key, j = queue[0]
        cost = key + window - here
        if jumping[i]:
            for q in jumps[i]:
                if q >= 0 and best[q] < cost:
                    cost, j = best[q], int(q)
        best[i], back[i] = cost + penalty[i] + SEQUENCE_COST, j
    cuts, i = [], count - 1
    while i:
        cuts.append(i)
        i = back[i]
    return cuts[::-1]


class Stream:
    """Documents of a task as one run of tokens, cut block by block."""

    def __init__(self, sentence_ends: np.ndarray, window: int, base: int):
        self.sentence_ends, self.window, self.next_id = sentence_ends, window, base
        self.pieces: deque[tuple[object, np.ndarray, int, int]] = deque()
        self.held = 0

    def add(self, key: object, ids: np.ndarray) -> None:
        self.pieces.append((key, ids, 0, len(ids)))
        self.held += len(ids)

    def _places(self) -> tuple[list[int], list[int]]:
        all_ids = np.concatenate([ids for _, ids, _, _ in self.pieces])
        ends = np.cumsum([len(ids) for _, ids, _, _ in self.pieces])
        inner = np.flatnonzero(np.isin(all_ids, self.sentence_ends)) + 1
        place = np.union1d(np.append(0, ends), inner)
        wide = np.flatnonzero(np.diff(place) > self.window)
        step = max(1, self.window // SPARSE)
        forced = [np.arange(place[w] + step, place[w + 1], step) for w in wide]
        every = np.union1d(place, np.concatenate(forced)) if forced else place
        penalty = np.full(len(every), FORCED_PENALTY)
        penalty[np.isin(every, inner)] = SENTENCE_PENALTY
        penalty[np.isin(every, ends)] = 0
        return every.tolist(), penalty.tolist()

    def cut(self, final: bool) -> Iterator[tuple[object, int, np.ndarray, int, int, int]]:
        """Pieces: key, start, ids, tokens of the document, sequence, offset there."""
        if not self.held:
            return
        place, penalty = self._places()
        cuts = [place[i] for i in best_cuts(place, penalty, self.window)]
        if not final:
            cuts = cuts[:-1]
        done = 0
        for end in cuts:
            offset = 0
            while done < end:
                key, ids, start, total = self.pieces.popleft()
                take = min(len(ids), end - done)
                yield key, start, ids[:take], total, self.next_id, offset
                if take < len(ids):
                    self.pieces.appendleft((key, ids[take:], start + take, total))
                offset, done = offset + take, done + take
            self.next_id += 1
        self.held -= done


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents in their sequences.

    Columns: the id, ``start`` (ids of the document before the piece), ``length``,
    ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``,
    ``offset`` (ids of the sequence before the piece). A null or empty text has
    the end id alone. Rows with equal or null ids are documents of their own.
    Sequence ids are unique and rise within a task in document order; an empty
    table has no pieces. Other columns are not carried.
    """
    path = vocabulary or default_vocabulary()
    fields = (
        StructField(id_col, docs.schema[id_col].dataType),
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids", BinaryType()),
        StructField("doc_tokens", LongType()),
        StructField("sequence_id", LongType()),
        StructField("offset", LongType()),
    )

    def rows(batches: Batches) -> Batches:
        words = words_of(path)
        stream = Stream(words.sentence_ends, window, TaskContext.get().partitionId() << 36)
        end = np.array([end_id], dtype=np.uint32)
        kind = None

        def sent(final: bool) -> Batches:
            made = list(stream.cut(final))
            if made:
                key, start, ids, total, sequence, offset = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key, kind),
                        pa.array(start, pa.int64()),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                        pa.array(total, pa.int64()),
                        pa.array(sequence, pa.int64()),
                        pa.array(offset, pa.int64()),
                    ],
                    [f.name for f in fields],
                )

        for batch in batches:
            kind = batch.column(0).type
            keys = batch.column(0).to_pylist()
            for first, texts in slabs(batch.column(1), TEXT_SLAB):
                for k, ids in enumerate(words.encode(texts)):
                    stream.add(keys[first + k], np.append(ids, end))
                    if stream.held >= BLOCK:
                        yield from sent(final=False)
        yield from sent(final=True)

    return map_arrow(docs.select(id_col, text_col), rows, StructType(list(fields)))
