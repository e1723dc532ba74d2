"""Toxicity: a convolutional classifier over hashed words, trained in numpy by the tasks that hold the texts, run where these lie."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import ALNUM, LOWER, find_words, row_slices, text_bytes, word_hashes
from gridloom.llm.workers import tidied
from gridloom.plans.scratch import LEAN_SHUFFLES, settings, written

#: Labelled documents of each class that the driver learns from by itself. Where there are more, of any class, all are
#: learned from by tasks.
FIT_ROWS = {1: 2500, 0: 4000}

#: Passes of tasks over all labelled documents, each from the mean of what the pass before learned.
ROUNDS = 4

#: Times a copy of the network goes through its unit in a pass.
TURNS = 2

#: Documents, and words, that one copy of the network learns from in a pass.
UNIT_ROWS, UNIT_WORDS = 4096, 1 << 21

#: Deltas are added up as whole numbers of this size, so that no order of adding changes the sum.
GRAIN = 2.0 ** -32

#: Pieces in which the sum of deltas is added up by tasks.
PIECES = 64

#: Logits are counted in steps of this size to set thresholds, up to the largest that a score tells apart.
STEP, LARGEST = 1 / 256, 64

#: Documents of each class, among those kept from training, from which on a language has a threshold of its own.
LEAST = 15

#: What tasks hand to Python at once, when rows are large.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}

#: Rows of the table of word embeddings, their width, widths of filters in words, and filters of each width.
VOCABULARY, WIDTH, FILTERS, EACH = 1 << 16, 16, (1, 2, 3), 16

EPOCHS, BATCH, RATE, SEED = 6, 32, 0.02, 11

#: Every fifth sampled document is kept from training; thresholds are set on these.
CALIBRATION = 5

#: Rows of the table that fewer training documents have are left out: what is seen once can only be learned by heart.
SEEN = 3

#: From this score on a document is called toxic.
THRESHOLD = 0.3

#: Words worked on at once, and rows of the table that make up a word.
SLICE_WORDS, PARTS = 1 << 16, 4

PAD = VOCABULARY
GAP = max(FILTERS) - 1


def word_ids(column) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the table for each word, A-Z in lower case: of the word, of its first four and six bytes, of its last
    four. Where each text's words start among them."""
    data, bounds = text_bytes(column)
    ids, first = [np.zeros((0, PARTS), np.uint32)], [np.zeros(1, np.int64)]
    for a, b in row_slices(bounds):
        part = LOWER[data[bounds[a]:bounds[b]]]
        starts, ends, own = find_words(part, bounds[a:b + 1] - bounds[a], ALNUM)
        cuts = ((starts, ends), (starts, np.minimum(ends, starts + 4)), (starts, np.minimum(ends, starts + 6)), (np.maximum(starts, ends - 4), ends))
        hashes = [(word_hashes(part, *cut) + np.uint64(k * 0x9E3779B9)) % np.uint64(VOCABULARY) for k, cut in enumerate(cuts)]
        ids.append(np.stack(hashes, axis=1).astype(np.uint32))
        first.append(own[1:] + first[-1][-1])
    return np.concatenate(ids), np.concatenate(first)


def spaced(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' words, with room after each text that no filter reaches across from a word; where each text starts; which
    places are room."""
    starts = first[:-1] + GAP * np.arange(len(first) - 1)
    out = np.full((len(ids) + GAP * (len(first) - 1), PARTS), PAD, np.int64)
    places = np.arange(len(ids)) + GAP * np.repeat(np.arange(len(first) - 1), np.diff(first))
    out[places] = ids
    room = np.ones(len(out), bool)
    room[places] = False
    return out, starts, room


class Network:
    """Embeddings, filters, the largest answer of each filter, a weighted sum."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.words = rng.normal(0, 0.1, (VOCABULARY + 1, WIDTH)).astype(np.float32)
        self.words[PAD] = 0
        self.filters = [rng.normal(0, 0.3, (k, WIDTH, EACH)).astype(np.float32) for k in FILTERS]
        self.shifts = [np.zeros(EACH, np.float32) for _ in FILTERS]
        self.known = np.arange(VOCABULARY + 1)
        self.out = rng.normal(0, 0.3, EACH * len(FILTERS)).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def pooled(self, ids: np.ndarray, first: np.ndarray, trace: bool = False):
        """Largest positive answer of each filter to each text; with ``trace``, also where it stands."""
        line, starts, room = spaced(self.known[ids], first)
        size = len(first) - 1
        answers = np.zeros((size, EACH * len(FILTERS)), np.float32)
        places = np.zeros(answers.shape, np.int64)
        if not len(line):
            return (answers, places, line) if trace else answers
        tail = np.concatenate([line, np.full((GAP, PARTS), PAD)])
        vectors = self.words[tail[:, 0]]
        for k in range(1, PARTS):
            vectors += self.words[tail[:, k]]
        for f, (weights, shift) in enumerate(zip(self.filters, self.shifts)):
            heard = vectors[:len(line)] @ weights[0]
            for j in range(1, len(weights)):
                heard += vectors[j:j + len(line)] @ weights[j]
            heard[room] = -np.inf  # from there a filter would hear the next text
            own = slice(f * EACH, (f + 1) * EACH)
            answers[:, own] = np.maximum(0, np.maximum.reduceat(heard, starts, axis=0) + shift)
            if trace:
                for d, (a, b) in enumerate(zip(starts, np.append(starts[1:], len(line)))):
                    places[d, own] = a + heard[a:b].argmax(axis=0)
        return (answers, places, tail) if trace else answers

    def logits(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        found = [np.zeros(0, np.float32)]
        for a, b in row_slices(first, SLICE_WORDS):
            found.append(self.pooled(ids[first[a]:first[b]], first[a:b + 1] - first[a]) @ self.out + self.bias)
        return np.concatenate(found)

    def parameters(self) -> list[np.ndarray]:
        return [self.words, self.out, self.bias, *self.filters, *self.shifts]

    def fresh_past(self) -> list[np.ndarray]:
        return [np.full(p.shape, 1e-6, np.float32) for p in self.parameters()]

    def fit(self, texts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> None:
        """Learns which rows of the table enough texts have, then from all texts again and again."""
        seen = np.zeros(VOCABULARY + 1, np.int64)
        for ids in texts:
            seen[np.unique(ids)] += 1
        self.known[seen < SEEN] = PAD
        weight = np.where(labels == 1, len(labels) / max(1, labels.sum()), len(labels) / max(1, (1 - labels).sum())) / 2
        self.descend(texts, labels, weight, self.fresh_past(), np.random.default_rng(SEED), epochs)

    def descend(self, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, squares: list[np.ndarray], rng, epochs: int) -> None:
        """Gradient steps scaled by past gradients, whose squares are added to ``squares`` (Adagrad); only words and
        filters that won the maximum move."""
        past = {id(p): q for p, q in zip(self.parameters(), squares)}

        def step(param, grad, at=...):
            past[id(param)][at] += grad * grad
            param[at] -= RATE * grad / np.sqrt(past[id(param)][at])

        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for k in range(0, len(order), BATCH):
                chosen = order[k:k + BATCH]
                ids = np.concatenate([texts[x] for x in chosen])
                first = np.concatenate([[0], np.cumsum([len(texts[x]) for x in chosen])])
                for param, grad, at in self.gradients(ids, first, labels[chosen], weight[chosen]):
                    step(param, grad, at)

    def gradients(self, ids: np.ndarray, first: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[tuple]:
        """(parameter, slope of the texts' mean weighted log loss, the parameter's rows that it is for)."""
        answers, places, line = self.pooled(ids, first, trace=True)
        error = (1 / (1 + np.exp(-(answers @ self.out + self.bias))) - labels) * weight / len(labels)
        back = error[:, None] * self.out * (answers > 0)
        slopes = [(self.out, (answers.T @ error).astype(np.float32), ...), (self.bias, np.array([error.sum()], np.float32), ...)]
        if not len(line):
            return slopes
        moved, pushes = [], []
        for f, (weights, shift) in enumerate(zip(self.filters, self.shifts)):
            own = slice(f * EACH, (f + 1) * EACH)
            push, place = back[:, own].astype(np.float32), places[:, own]
            grad = np.zeros_like(weights)
            for j in range(len(weights)):
                at = line[np.minimum(place + j, len(line) - 1)]
                grad[j] = np.einsum("df,dfw->wf", push, self.words[at].sum(axis=2))
                moved.append(at.ravel())
                pushes.append(np.repeat((push[:, :, None] * weights[j].T[None]).reshape(-1, WIDTH), PARTS, axis=0))
            slopes += [(weights, grad, ...), (shift, push.sum(axis=0), ...)]
        rows, where = np.unique(np.concatenate(moved), return_inverse=True)
        grad = np.zeros((len(rows), WIDTH), np.float32)
        np.add.at(grad, where, np.concatenate(pushes))
        grad[rows == PAD] = 0
        return [*slopes, (self.words, grad, rows)]


class Languages:
    """Guesses a text's language from its words' hashes, for choosing a threshold: naive Bayes, learned from the labelled documents."""

    def __init__(self, texts: list[np.ndarray], languages: list[str | None]):
        self.names = sorted({x for x in languages if x is not None})
        counts = np.ones((VOCABULARY, max(1, len(self.names))), np.float32)
        for ids, lang in zip(texts, languages):
            if lang is not None:
                np.add.at(counts[:, self.names.index(lang)], ids[:, 0], 1)
        self.weigh(counts)

    def weigh(self, counts: np.ndarray) -> None:
        self.weights = np.log(counts / counts.sum(axis=0)).astype(np.float32)

    def guess(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Number of the likeliest language of each text; 0 for texts without words."""
        sums = np.zeros((len(first) - 1, self.weights.shape[1]))
        full = np.flatnonzero(np.diff(first))
        for a, b in row_slices(first[np.append(full, len(first) - 1)], SLICE_WORDS):
            own = full[a:b]
            low, high = first[own[0]], first[own[-1] + 1]
            sums[own] = np.add.reduceat(self.weights[ids[low:high, 0]], first[own] - low, axis=0)
        return sums.argmax(axis=1)


def best_threshold(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The logit that parts the classes with the highest F1, halfway between the two next to it."""
    order = np.argsort(-logits, kind="stable")
    hit = np.cumsum((labels * weights)[order])
    called = np.cumsum(weights[order])
    score = 2 * hit / (called + (labels * weights).sum())
    ranked = logits[order]
    score[:-1][ranked[:-1] == ranked[1:]] = 0
    k = int(score.argmax())
    return float(ranked[k] - 0.5 if k + 1 == len(ranked) else (ranked[k] + ranked[k + 1]) / 2)


class ToxicityModel:
    """A network, a language guess, and a threshold for each language."""

    def __init__(self, sample: list[dict], shares: dict[int, float]):
        texts = [np.frombuffer(r["ids"], np.uint32).reshape(-1, PARTS) for r in sample]
        labels = np.array([r["label"] for r in sample], np.float64)
        self.network, self.languages = None, None
        if not (0 < labels.sum() < len(labels)):
            return
        aside = np.arange(len(texts)) % CALIBRATION == 0
        self.network = Network()
        self.network.fit([t for t, x in zip(texts, aside) if not x], labels[~aside])
        self.languages = Languages(texts, [r["lang"] for r in sample])
        ids, first = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        logits, guesses = self.network.logits(ids, first), self.languages.guess(ids, first)
        weights = np.array([1 / shares[int(x)] for x in labels])  # as if the classes had been sampled alike
        if len(set(labels[aside])) < 2:
            aside = ~aside
        whole = best_threshold(logits[aside], labels[aside], weights[aside])
        self.thresholds = np.full(self.languages.weights.shape[1], whole)
        for k in range(len(self.thresholds)):
            own = aside & (guesses == k)
            if min(labels[own].sum(), (1 - labels[own]).sum()) >= LEAST:
                self.thresholds[k] = best_threshold(logits[own], labels[own], weights[own])

    def scores(self, column) -> np.ndarray:
        """From 0 to 1; each language's threshold comes to stand at ``THRESHOLD``. 0 if there was nothing to learn from."""
        if self.network is None:
            return np.zeros(len(column))
        ids, first = word_ids(column)
        z = self.network.logits(ids, first) - self.thresholds[self.languages.guess(ids, first)]
        return 1 / (1 + np.exp(-np.clip(z + np.log(THRESHOLD / (1 - THRESHOLD)), -30, 30)))


class SpreadToxicity:
    """Learns a :class:`ToxicityModel` from any number of documents: tasks train copies of one network, each on a unit of
    about ``UNIT_ROWS`` documents, and the next pass starts from the mean of what they learned.

    Everything is learned from all rows: which rows of the table are known, the weights of the classes, languages,
    network and thresholds. What tasks and driver exchange has the size of the network, of a table of words by language
    and of the counts of logits, however many documents there are. A unit is made of the documents of a range of hashed
    ids, in order of their ids, and deltas are added as whole numbers, so the result depends on the documents only.
    """

    def __init__(self, texts: DataFrame, known: DataFrame, sizes: dict[int, int]):
        self.spark = texts.sparkSession
        shards = -(-sum(sizes.values()) // UNIT_ROWS)
        found = texts.repartition(shards, "doc_id").join(known.repartition(shards, "doc_id"), "doc_id")
        ordered = found.sortWithinPartitions("doc_id", "label", F.xxhash64("text"), "lang").select("doc_id", "text", "lang", "label")
        with settings(self.spark, LEAN_SHUFFLES | SMALL_BATCHES):
            self.units = written(ordered.mapInArrow(tidied(packed_units), UNIT_DDL), "units", compression="zstd")
        self.weight = {k: sum(sizes.values()) / 2 / n for k, n in sizes.items()}

    def arrow(self, function, ddl: str, then) -> pa.Table:
        """What the function makes of the units, after ``then``, on the driver."""
        with settings(self.spark, SMALL_BATCHES):
            return then(self.units.mapInArrow(tidied(by_unit(function)), ddl)).toArrow()

    def model(self) -> ToxicityModel:
        made = ToxicityModel.__new__(ToxicityModel)
        made.network, made.languages = self.trained(), self.learned_languages()
        self.set_thresholds(made)
        return made

    def trained(self) -> Network:
        network = Network()

        def seen(unit):
            for part in np.array_split(np.arange(len(unit["labels"])), max(1, len(unit["labels"]) // 256)):
                rows = [np.unique(unit["ids"][unit["first"][d]:unit["first"][d + 1]]) for d in part if not unit["aside"][d]]
                slots, n = np.unique(np.concatenate([np.zeros(0, np.uint32), *rows]), return_counts=True)
                yield [pa.array(slots.astype(np.int32)), pa.array(n.astype(np.int64))]

        counts = self.arrow(seen, "slot int, n long", lambda x: x.groupBy("slot").agg(F.sum("n").alias("n")))
        enough = np.zeros(VOCABULARY + 1, bool)
        enough[counts.column(0).to_numpy()] = counts.column(1).to_numpy() >= SEEN
        network.known[~enough] = PAD
        past = network.fresh_past()
        for k in range(ROUNDS):
            self.one_round(network, past, k)
        return network

    def one_round(self, network: Network, past: list[np.ndarray], k: int) -> None:
        """One pass over all units; what was moved by several goes to the mean of where these moved it."""
        weight, start = self.weight, [*network.parameters(), *past]
        bounds = np.cumsum([0, *(p.size for p in start)])

        def sums(batches):
            total, moved = np.zeros(bounds[-1], np.int64), np.zeros(bounds[-1], np.int32)
            for unit in (u for batch in batches for u in units_of(batch)):
                own, squares = Network.__new__(Network), [p.copy() for p in start[len(start) // 2:]]
                own.known, (own.words, own.out, own.bias, *rest) = network.known, [p.copy() for p in start[:len(start) // 2]]
                own.filters, own.shifts = rest[:len(FILTERS)], rest[len(FILTERS):]
                kept = np.flatnonzero(~unit["aside"])
                if not len(kept):
                    continue
                labels = unit["labels"][kept].astype(np.float64)
                by_class = np.where(labels == 1, weight.get(1, 0.0), weight.get(0, 0.0))
                own.descend([unit["ids"][unit["first"][d]:unit["first"][d + 1]] for d in kept], labels, by_class, squares,
                            np.random.default_rng([SEED, k, unit["seed"]]), TURNS)
                for now, before, a, b in zip([*own.parameters(), *squares], start, bounds, bounds[1:]):
                    change = np.rint((now.ravel().astype(np.float64) - before.ravel()) / GRAIN).astype(np.int64)
                    total[a:b] += change
                    moved[a:b] += change != 0
            for piece, at in enumerate(np.array_split(np.arange(bounds[-1]), PIECES)):
                yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([total[at].tobytes()]), pa.array([moved[at].tobytes()])],
                                                 ["piece", "total", "moved"])

        def added(batches):
            held = {}
            for batch in batches:
                for piece, total, moved in zip(*(c.to_pylist() for c in batch.columns)):
                    pair = [np.frombuffer(total, np.int64), np.frombuffer(moved, np.int32)]
                    held[piece] = [x + y for x, y in zip(held[piece], pair)] if piece in held else pair
            for piece, (total, moved) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([total.tobytes()]), pa.array([moved.tobytes()])],
                                                 ["piece", "total", "moved"])

        ddl = "piece int, total binary, moved binary"
        with settings(self.spark, SMALL_BATCHES | LEAN_SHUFFLES):
            found = self.units.mapInArrow(tidied(sums), ddl).repartition(PIECES, "piece").mapInArrow(tidied(added), ddl).toArrow()
        for piece, total, moved in sorted(zip(*(c.to_pylist() for c in found.columns))):
            at = np.array_split(np.arange(bounds[-1]), PIECES)[piece]
            mean = np.frombuffer(total, np.int64) * GRAIN / np.maximum(1, np.frombuffer(moved, np.int32))
            for p, a, b in zip(start, bounds, bounds[1:]):
                low, high = max(a, at[0]), min(b, at[-1] + 1)
                if low < high:
                    p.reshape(-1)[low - a:high - a] += mean[low - at[0]:high - at[0]].astype(np.float32)

    def learned_languages(self) -> Languages:
        """Of the languages that documents enough have for a threshold of their own; others take that of all."""

        def words(unit):
            for lang in sorted({x for x in unit["langs"] if x is not None}):
                own = [unit["ids"][a:b, 0] for x, a, b in zip(unit["langs"], unit["first"], unit["first"][1:]) if x == lang]
                slots, n = np.unique(np.concatenate(own).astype(np.int64), return_counts=True)
                yield [pa.array([lang] * (len(slots) + 1)), pa.array(np.append(slots, -1).astype(np.int32)), pa.array(np.append(n, len(own)).astype(np.int64))]

        def kept(frame):
            frame = frame.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
            return frame.join(frame.where(f"slot = -1 AND n >= {2 * LEAST}").select("lang"), "lang")

        table = self.arrow(words, "lang string, slot int, n long", kept)
        languages = Languages([], table.column(0).unique().to_pylist())
        counts = np.ones((VOCABULARY, max(1, len(languages.names))), np.float32)
        place = {name: k for k, name in enumerate(languages.names)}
        column, slots = np.array([place[x] for x in table.column(0).to_pylist()], np.int64), table.column(1).to_numpy()
        whole = slots >= 0
        counts[slots[whole], column[whole]] += table.column(2).to_numpy()[whole]
        languages.weigh(counts)
        return languages

    def set_thresholds(self, model: ToxicityModel) -> None:
        """The thresholds that part the classes best, over all documents kept from training."""

        def logits(unit):
            ids, first = unit["ids"], unit["first"]
            z, guess = model.network.logits(ids, first), model.languages.guess(ids, first)
            step = np.rint(np.clip(z, -LARGEST, LARGEST) / STEP).astype(np.int64)
            keys = np.stack([guess, unit["labels"], step], axis=1)[unit["aside"]]
            kinds, n = np.unique(keys, axis=0, return_counts=True)
            yield [pa.array(kinds[:, j].astype(np.int32)) for j in range(3)] + [pa.array(n.astype(np.int64))]

        table = self.arrow(logits, "guess int, label int, step int, n long", lambda x: x.groupBy("guess", "label", "step").agg(F.sum("n").alias("n")))
        guess, label, step, n = (c.to_numpy() for c in table.columns)
        weights = n.astype(np.float64)
        model.thresholds = np.full(model.languages.weights.shape[1], counted_threshold(step * STEP, label, weights))
        for k in range(len(model.thresholds)):
            own = guess == k
            if min(n[own & (label == 1)].sum(), n[own & (label == 0)].sum()) >= LEAST:
                model.thresholds[k] = counted_threshold(step[own] * STEP, label[own], weights[own])


def counted_threshold(logits: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> float:
    """As :func:`best_threshold`, of logits that stand for so many documents each; 0 where a class is missing."""
    if not (counts[labels == 1].sum() and counts[labels == 0].sum()):
        return 0.0
    order = np.lexsort((labels, logits))
    return best_threshold(logits[order], labels[order].astype(np.float64), counts[order])


UNIT = pa.schema([("ids", pa.binary()), ("lengths", pa.binary()), ("labels", pa.binary()), ("aside", pa.binary()), ("langs", pa.list_(pa.string()))])
UNIT_DDL = "ids binary, lengths binary, labels binary, aside binary, langs array<string>"


def packed_units(batches) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, text, lang, label) as units of hashed words. A hash of the id says what is kept from training."""
    held, rows, words = [], 0, 0

    def unit():
        ids, lengths, labels, aside, langs = zip(*held)
        return pa.RecordBatch.from_arrays([
            pa.array([np.concatenate(ids).astype(np.uint16).tobytes()]), pa.array([np.concatenate(lengths).astype(np.int64).tobytes()]),
            pa.array([np.concatenate(labels).astype(np.int8).tobytes()]), pa.array([np.concatenate(aside).astype(np.int8).tobytes()]),
            pa.array([[x for part in langs for x in part]], pa.list_(pa.string()))], schema=UNIT)

    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            part = batch.slice(at, 128)
            ids, first = word_ids(part.column(1))
            doc_ids = [zlib.crc32(b"%d aside" % x) for x in part.column(0).to_pylist()]
            held.append((ids, np.diff(first), part.column(3).to_numpy(), np.array(doc_ids) % CALIBRATION == 0, part.column(2).to_pylist()))
            rows, words = rows + part.num_rows, words + len(ids)
            if rows >= 2 * UNIT_ROWS or words >= UNIT_WORDS:
                yield unit()
                held, rows, words = [], 0, 0
    if held:
        yield unit()


def units_of(batch: pa.RecordBatch) -> Iterator[dict]:
    for ids, lengths, labels, aside, langs in zip(*(c.to_pylist() for c in batch.columns)):
        yield {"ids": np.frombuffer(ids, np.uint16).reshape(-1, PARTS).astype(np.uint32), "langs": langs,
               "first": np.concatenate([[0], np.cumsum(np.frombuffer(lengths, np.int64))]), "labels": np.frombuffer(labels, np.int8),
               "aside": np.frombuffer(aside, np.int8).astype(bool), "seed": zlib.crc32(lengths + labels)}


def by_unit(function):
    """For ``mapInArrow``: the function's lists of columns, unit by unit."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in units_of(batch):
                for columns in function(unit):
                    yield pa.RecordBatch.from_arrays(columns, [str(k) for k in range(len(columns))])

    return run


def learn_toxicity(docs: DataFrame, labels: DataFrame, fit_rows: dict[int, int] = FIT_ROWS) -> ToxicityModel:
    """Learns from ``labels`` (doc_id, toxic) of documents (doc_id, text, lang).

    All rows with a label and a text are learned from: by the driver, to which their hashed words come, where no class
    has more rows than ``fit_rows`` says, else by tasks. Labels other than 0 and 1, and null ids or texts, are passed
    over. Columns of ``docs`` beside the three are ignored.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").selectExpr("cast(doc_id AS long) AS doc_id", "cast(toxic AS int) AS label")
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    known = written(known.join(texts.select("doc_id"), "doc_id", "left_semi"), "labels")  # other rows' labels teach nothing, not even sizes
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if len(sizes) == 2 and any(n > fit_rows[k] for k, n in sizes.items()):
        return SpreadToxicity(texts, known, sizes).model()
    shares = {k: 1.0 for k in sizes}
    few = known if len(sizes) == 2 else known.where("false")  # one class alone teaches nothing
    taken = F.broadcast(few)

    def hashed(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first = word_ids(batch.column("text"))
            made = [ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("lang"), pa.array(made, pa.binary())],
                ["doc_id", "label", "lang", "ids"],
            )

    found = texts.join(taken, "doc_id").mapInArrow(tidied(hashed), "doc_id long, label int, lang string, ids binary").toArrow().to_pylist()
    return ToxicityModel(sorted(found, key=lambda r: (r["doc_id"], r["label"], r["ids"])), shares)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score, predicted (1 from ``THRESHOLD`` on), from the whole text alone.

    Null and empty texts, and texts without words, get the score of no evidence. A null id stays null, repeated rows
    give repeated rows, no rows give none, other columns are ignored.
    """

    def predict(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col))
    return rows.mapInArrow(tidied(predict), "doc_id long, score double, predicted int")
