"""Order-preserving packing of documents into training sequences by dynamic programming.

Each task packs the documents it reads, in their order. Cuts fall at ends of documents or sentences where that pays:
of all ways to cut a stretch of tokens into windows, the one with the least padding plus penalties for cut documents is
taken. A window's cost depends on where it starts by a sum that the queue of possible starts keeps in order, so that
each cut place enters and leaves the queue once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.tokens import open_tokenizer
from gridloom.llm.workers import tidied, trim

#: Tokens in a sequence.
WINDOW = 4096

#: What a cut costs, in tokens of padding: at the end of a sentence, and within one.
SENTENCE_CUT, INNER_CUT = 4, 24

#: Within longer sentences a cut is possible every so many tokens.
INNER_STEP = 64

#: Windows that are worked out together; all but the last are then final.
HORIZON = 64


def cut_places(ends: np.ndarray, sentence: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places between the tokens where a window may end, in order, and what each costs.

    ``ends``: where documents end; ``sentence``: for each token, whether a sentence ends with it.
    """
    cost = np.full(size + 1, np.iinfo(np.int64).max)
    cost[np.flatnonzero(sentence) + 1] = SENTENCE_CUT
    cost[ends] = 0
    cost[[0, size]] = 0
    known = np.flatnonzero(cost < np.iinfo(np.int64).max)
    gaps = np.diff(known)
    more = np.maximum(0, (gaps - 1) // INNER_STEP)
    inner = np.repeat(known[:-1], more) + (np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1) * INNER_STEP
    cost[inner] = INNER_CUT
    places = np.flatnonzero(cost < np.iinfo(np.int64).max)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, window: int) -> list[int]:
    """The cut places of the cheapest division, from the first to the last place; no two further apart than ``window``."""
    at, cost = places.tolist(), costs.tolist()
    total, before = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(at[0], 0)])  # (cost so far + place, number), least first
    oldest = 0
    for k in range(1, len(at)):
        while at[queue[0][1]] < at[k] - window:
            queue.popleft()
        oldest = queue[0][1]
        total[k] = queue[0][0] + window - at[k] + cost[k]
        before[k] = oldest
        key = total[k] + at[k]
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, k))
    cuts = [len(at) - 1]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return [at[k] for k in reversed(cuts)]


def powers(size: int) -> list[int]:
    """Lengths that are powers of two and add up to ``size``, the largest first: they need no padding."""
    return [1 << k for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1]


class Packer:
    """Takes documents one after the other, and gives out pieces as soon as their windows are final."""

    def __init__(self, window: int, ends_sentence: np.ndarray, first_sequence: int):
        self.window, self.ends_sentence, self.sequence = window, ends_sentence, first_sequence
        self.docs: list[list] = []  # [id, rest of its tokens, tokens given out, all its tokens]
        self.size = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[dict]:
        self.docs.append([doc_id, ids, 0, len(ids)])
        self.size += len(ids)
        if self.size >= HORIZON * self.window:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[dict]:
        if not self.size:
            return
        tokens = np.concatenate([d[1] for d in self.docs])
        ends = np.cumsum([len(d[1]) for d in self.docs])
        cuts = best_cuts(*cut_places(ends, self.ends_sentence[tokens], self.size), self.window)
        windows = np.diff(cuts).tolist()
        windows = windows[:-1] + (powers(windows[-1]) if last else [])
        for length in windows:
            yield from self.emit(length)
        self.docs = [d for d in self.docs if len(d[1])]

    def emit(self, length: int) -> Iterator[dict]:
        """One sequence, of the next ``length`` tokens."""
        offset = 0
        for doc in self.docs:
            part = doc[1][:length - offset]
            if len(part):
                yield {"doc_id": doc[0], "start": doc[2], "length": len(part), "ids": part.astype("<u4").tobytes(),
                       "doc_tokens": doc[3], "sequence_id": self.sequence, "offset": offset}
                doc[1], doc[2], offset = doc[1][len(part):], doc[2] + len(part), offset + len(part)
            if offset == length:
                break
        while self.docs and not len(self.docs[0][1]):
            self.docs.pop(0)
        self.size -= length
        self.sequence += 1


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def sentence_ends(tokenizer) -> np.ndarray:
    """For each id, whether it ends a sentence: its piece ends in a full stop, question or exclamation mark."""
    library = tokenizer.library
    size = library.get_vocab_size() if library else tokenizer.pieces.get_piece_size()
    name = library.id_to_token if library else tokenizer.pieces.id_to_piece
    return np.array([(name(k) or "").removesuffix("</w>").endswith((".", "!", "?")) for k in range(size)])


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences of at most ``window`` tokens: doc_id, start (tokens of the document before the
    piece), length, ids (little-endian unsigned 32-bit), doc_tokens (of the document, ``end_id`` included),
    sequence_id, offset (tokens before the piece in its sequence).

    A document is its tokens without added special ones, then ``end_id``. Every token is in exactly one piece, and the
    pieces of a task's sequences follow its documents' order. Only the last windows of a task are shorter than a good
    cut allows; they are divided into powers of two, which need no padding. Null and empty texts are ``end_id`` alone; a
    null id stays null; rows of one id are documents of their own; other columns are ignored; no rows give none.
    No row is moved between tasks. ``docs`` should come from a table: then a task that is run again, after an executor
    is lost, gives its sequences the same ids. ``tokenizer_path`` has to exist where tasks run.
    """

    def pieces(batches):
        tokenizer = open_tokenizer(tokenizer_path)
        ends = sentence_ends(tokenizer)
        ends = np.append(ends, np.zeros(max(0, end_id + 1 - len(ends)), bool))
        packer = Packer(window, ends, TaskContext.get().partitionId() << 40)
        ready, held = [], 0
        for batch in batches:
            trim()
            found = tokenizer.encode_batch(batch.column(1).fill_null(""))
            for doc_id, ids in zip(batch.column(0).to_pylist(), found):
                for piece in packer.add(doc_id, np.append(ids, np.uint32(end_id))):
                    ready.append(piece)
                    held += piece["length"]
                if held > 1 << 18:
                    yield pa.RecordBatch.from_pylist(ready, PIECES)
                    ready, held = [], 0
        ready += packer.flush(last=True)
        yield pa.RecordBatch.from_pylist(ready, PIECES)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col))
    return rows.mapInArrow(tidied(pieces), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
