"""Token ids and counts of whole texts, huge ones by overlapping chunks that are spliced where both sides agree."""

from __future__ import annotations

import json
import os
import re
import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import LOWER, NOT_SPACE, find_words, row_slices, text_bytes
from gridloom.llm.workers import tidied

#: Characters of a chunk, and by which neighbouring chunks overlap at first.
CHUNK, OVERLAP = 1 << 16, 256

#: Distinct words whose ids a task remembers; beyond, it starts afresh.
MEMO_WORDS = 120_000

WHITE = " \t\n\r\x0b\x0c"
_WORD = re.compile(rf"[^{WHITE}]+")

#: Bytes of texts whose words are looked up together; new words encoded together; words in a line of these.
BYTES, LEARN, LINE = 2 << 20, 1 << 14, 64


def shared_forms(data: np.ndarray, bounds: np.ndarray, lowers: bool, cuts: bool) -> tuple[np.ndarray, np.ndarray]:
    """Texts in forms that more words share, which have the same ids where white space only separates.

    If the tokenizer ``cuts`` where punctuation follows a letter or digit, white space can go between. If it ``lowers``,
    A-Z are lowered in texts that are all ASCII (letters beyond it may compose with what follows before they are
    lowered). Texts with ``<`` stay as they are, as special strings are found before all else.
    """
    if len(data) < 2:
        return data, bounds
    tagged = rows_with(data == 60, bounds)
    if lowers:
        lowered = ~(rows_with(data >= 128, bounds) | tagged)
        data = np.where(lowered, LOWER[data], data)
    if not cuts:
        return data, bounds
    marks = np.flatnonzero(PUNCTUATION[data[1:]] & ~tagged[1:]) + 1
    before = data[marks - 1]
    latin = (before >= 0x80) & (data[np.maximum(marks - 2, 0)] == 0xC3) & (before != 0x97) & (before != 0xB7)
    marks = marks[PLAIN[before] | latin]
    return np.insert(data, marks, 32), bounds + np.searchsorted(marks, bounds)


def rows_with(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each byte, whether its row has any byte that is ``found``."""
    sizes = np.diff(bounds)
    full = sizes > 0
    return np.repeat(np.logical_or.reduceat(found, bounds[:-1][full]), sizes[full])


#: Fixed value: a pattern known to end a piece wherever punctuation follows a letter or digit. Of others nothing is assumed.
CUTTING = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


PLAIN = np.zeros(256, bool)
PLAIN[48:58] = PLAIN[65:91] = PLAIN[97:123] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[0x21:0x7F] = True
PUNCTUATION &= ~PLAIN


class WordTokenizer:
    """A ``tokenizers`` file whose pieces never touch white space: words are encoded one by one and remembered.

    That is exact, as the library drops white space and looks at each piece between by itself (``splits_at_white_space``).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        steps, first = steps_of(path)
        self.lowers = any(x["type"] == "Lowercase" for x in steps)
        self.cuts = (first.get("pattern") or {}).get("Regex") == CUTTING
        self.closes =np.zeros(self.library.get_vocab_size(), bool)  # ids that end a piece
        self.closes[[n for token, n in self.library.get_vocab().items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and how many each has.

        Words of letters are one piece each, so many can be encoded at once and told apart by the ids that end a piece;
        if there are more of these than words (where a letter is made of several), each is encoded by itself.
        """
        lines = [" ".join(words[k:k + LINE]) for k in range(0, len(words), LINE)]
        ids = np.array([i for x in self.library.encode_batch_fast(lines, add_special_tokens=False) for i in x.ids], np.uint32)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(words) and (not len(ids) or ends[-1] == len(ids)) and all(map(str.isalpha, words)):
            return ids, np.diff(ends, prepend=0)
        found = [x.ids for x in self.library.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def learn(self, words: list[bytes]) -> None:
        """Numbers and remembers new words, some at a time."""
        texts = [w.decode() for w in words]
        plain = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        order = np.argsort(~plain, kind="stable")
        found = [self.encoded([texts[k] for k in order[a:b].tolist()])
                 for low, high in ((0, int(plain.sum())), (int(plain.sum()), len(texts)))
                 for a, b in zip(range(low, high, LEARN), [*range(low + LEARN, high, LEARN), high])]
        sizes = np.concatenate([x[1] for x in found])
        self.number.update(zip([words[k] for k in order.tolist()], range(len(self.sizes), len(self.sizes) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *(x[0] for x in found)])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Numbers of different words."""
        if len(self.number) > MEMO_WORDS:
            self.forget()
        new = [w for w in words if w not in self.number]
        if new:
            self.learn(new)
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For some texts at a time: numbers of their words, and where each text's words start among them."""
        data, bounds = text_bytes(texts)
        for a, b in row_slices(bounds, BYTES):
            part, edges = shared_forms(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], self.lowers, self.cuts)
            starts, ends, first = find_words(part, edges, NOT_SPACE)
            offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
            kept = part[NOT_SPACE[part]].tobytes()
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
            distinct = words.dictionary_encode()
            yield self.numbers(distinct.dictionary.to_pylist())[distinct.indices.to_numpy()], first

    def encode_batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text."""
        for numbers, bounds in self.batches(texts):
            sizes = self.sizes[numbers]
            reach = np.concatenate([[0], np.cumsum(sizes)])
            place = np.arange(reach[-1]) - np.repeat(reach[:-1] - self.starts[numbers], sizes)
            ids = self.ids[place]
            for a, b in zip(reach[bounds[:-1]], reach[bounds[1:]]):
                yield ids[a:b]

    def count_batch(self, texts: pa.Array) -> list[int]:
        counts: list[int] = []
        for numbers, bounds in self.batches(texts):
            reach = np.concatenate([[0], np.cumsum(self.sizes[numbers])])
            counts += (reach[bounds[1:]] - reach[bounds[:-1]]).tolist()
        return counts

    def units(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where words start, in characters, and how many ids each has."""
        found = list(_WORD.finditer(text))
        starts = np.fromiter((m.start() for m in found), np.int64, len(found))
        words = [m.group().encode() for m in found]
        number = dict(zip(distinct := list(dict.fromkeys(words)), self.numbers(distinct).tolist()))
        return starts, self.sizes[[number[w] for w in words]] if words else np.zeros(0, np.int64)


class LibraryTokenizer:
    """Any other ``tokenizers`` or ``sentencepiece`` file, by the library's own offsets."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = None
        else:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)

    def count_batch(self, texts: pa.Array) -> list[int]:
        return [len(x) for x in self.encode_batch(texts)]

    def encode_batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = [x or "" for x in texts.to_pylist()]
        if self.library is None:
            found = self.pieces.encode(texts, num_threads=1)
        else:
            found = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return (np.array(x, np.uint32) for x in found)

    def units(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        if self.library is None:
            made = self.pieces.encode(text, return_type="proto")
            data = np.frombuffer(text.encode(), np.uint8)  # the library counts bytes
            place = np.append(np.cumsum((data & 0xC0) != 0x80) - 1, len(text))
            starts = place[[p.begin for p in made.pieces]] if made.pieces else []
        else:
            starts = [a for a, _ in self.library.encode(text, add_special_tokens=False).offsets]
        return np.array(starts, np.int64), np.ones(len(starts), np.int64)


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def steps_of(path: str) -> tuple[list[dict], dict]:
    """The steps of a ``tokenizers`` file's normalizer, and the first of those that split a text."""
    spec = _spec(path)
    pre = spec.get("pre_tokenizer") or {}
    first = pre["pretokenizers"][0] if pre.get("type") == "Sequence" else pre
    normalizer = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    return normalizer["normalizers"] if normalizer["type"] == "Sequence" else [normalizer], first


def splits_at_white_space(path: str) -> bool:
    """Does the tokenizer turn all white space into breaks? Read from its file; when in doubt, no."""
    if not path.endswith(".json"):
        return False
    import regex

    spec = _spec(path)
    steps, first = steps_of(path)
    pattern = (first.get("pattern") or {}).get("Regex")
    known = {"NFC", "NFD", "Lowercase", "Replace"}
    plain = all(x["type"] in known and (x["type"] != "Replace" or (x["pattern"].get("Regex"), x["content"]) == (r"\s+", " ")) for x in steps)
    added = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or set(x["content"]) & set(WHITE)) for x in spec["added_tokens"])
    return bool(
        pattern and first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"] and plain and added
        and r"\s" not in pattern.replace(r"[^\s", "[^") and not any(regex.search(pattern, c) for c in WHITE)
    )


def open_tokenizer(path: str):
    """The tokenizer of a file, opened once in a worker process, which runs many tasks.

    It is kept among the process's modules, as this module itself may travel with each task and go with it.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; threads of the library keep memory each
    kept = sys.modules.setdefault(KEPT, ModuleType(KEPT))
    if path not in vars(kept):
        setattr(kept, path, (WordTokenizer if splits_at_white_space(path) else LibraryTokenizer)(path))
    return getattr(kept, path)


KEPT = "gridloom_open_tokenizers"


def spliced_count(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int, int]:
    """(ids of a text, its chunks, times an overlap was widened), chunk by chunk.

    A chunk reaches into the next by an overlap. Both are cut at the last place in it where both have a token starting
    and where white space meets something else: to the left nothing depends on what follows white space, to the right
    the encoding starts afresh there, so what is kept of both is what the whole text would give. Where there is no such
    place the left chunk is encoded again with a wider overlap, in the end to the end of the text.
    """
    total, chunks, widened = 0, 0, 0
    begin, skip = 0, 0  # where the present chunk begins, and from where on its tokens count
    starts, sizes = tokenizer.units(text[:chunk + overlap])
    end = chunk
    while end + overlap < len(text):
        chunks += 1
        reach = overlap
        right_starts, right_sizes = tokenizer.units(text[end:end + chunk + overlap])
        while True:
            common = np.intersect1d(starts, right_starts + end)
            common = common[(common > max(end, skip)) & (common < end + reach)]
            stable = [p for p in common.tolist() if text[p - 1].isspace() != text[p].isspace()]
            if stable or end + reach >= len(text):
                break
            reach, widened = reach * 2, widened + 1
            starts, sizes = tokenizer.units(text[begin:end + reach])
            starts = starts + begin
            right_starts, right_sizes = tokenizer.units(text[end:end + max(chunk + overlap, 2 * reach)])
        if not stable:
            break
        cut = stable[-1]
        total += int(sizes[(starts >= skip) & (starts < cut)].sum())
        begin, skip = end, cut
        starts, sizes = right_starts + end, right_sizes
        end = max(end + chunk, cut)
        if end + overlap > begin + max(chunk + overlap, 2 * reach):
            starts, sizes = tokenizer.units(text[begin:end + overlap])
            starts = starts + begin
    if begin or len(text) > chunk + overlap:
        starts, sizes = tokenizer.units(text[begin:])
        starts = starts + begin
    return total + int(sizes[starts >= skip].sum()), chunks + 1, widened


def count_tokens(docs: DataFrame, tokenizer_path: str, chunk: int = CHUNK, overlap: int = OVERLAP, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens as the tokenizer's library gives them without begin, end
    or added special tokens, n_chunks and n_widened.

    Texts up to ``chunk`` + ``overlap`` characters are encoded as they are, longer ones by ``spliced_count``. Null and
    empty texts have no bytes and no tokens; a null id stays null; repeated rows give repeated rows; other columns are
    ignored. ``tokenizer_path`` is read by each task, so it has to exist where tasks run.
    """

    def counts(batches):
        tokenizer = open_tokenizer(tokenizer_path)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            huge = pc.greater(pc.utf8_length(texts), chunk + overlap).to_numpy(zero_copy_only=False)
            found = np.zeros((len(texts), 3), np.int64)
            found[:, 1] = 1
            found[~huge, 0] = tokenizer.count_batch(texts.filter(pa.array(~huge)))
            for k in np.flatnonzero(huge).tolist():
                found[k] = spliced_count(tokenizer, texts[k].as_py(), chunk, overlap)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array(found[:, k]) for k in range(3))],
                                             ["doc_id", "n_bytes", "n_tokens", "n_chunks", "n_widened"])

    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col), size)
    return rows.mapInArrow(tidied(counts), "doc_id long, n_bytes long, n_tokens long, n_chunks long, n_widened long")
