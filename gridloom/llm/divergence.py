"""How the sources of a language differ in their words: distances between sources, and the terms each overuses.

A group is one (language, source). Its most overused terms are found by a dominance skyband: of two terms of a group, one
that stands there at least as often, in the language at most as often and earlier in UTF-8 order ranks ahead whatever
the totals are. Partitions keep the terms that fewer than ``top`` others dominate, the skybands are merged, and only
what is left is ranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.words import LOWER, find_words, row_slices, text_bytes
from gridloom.llm.workers import tidied
from gridloom.plans.scratch import drop_folder, scratch_folder, written

#: Lower-case letters, and all bytes of characters beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[97:123] = LETTERS[128:] = True

#: Added to each count, and what shares are multiplied by before they are cut to whole numbers.
SMOOTH, SCALE = 5, 10**9

#: Rows and bytes of counts, or of terms, that a task holds before it merges them and hands them on.
HELD_ROWS, HELD_BYTES = 1 << 18, 1 << 25

#: Rows of term counts compared by one task, and sources whose distances it works out.
CHUNK_ROWS, BLOCK = 100_000, 512

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _ordered_codes(column) -> tuple[np.ndarray, pa.Array]:
    coded = column.dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def batch_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> Iterator[pa.Table]:
    """Per (lang, source, term) of a batch: occurrences, and texts the term stands in."""
    langs, lang_names = _ordered_codes(lang)
    sources, source_names = _ordered_codes(source)
    group = langs * len(source_names) + sources
    data, bounds = text_bytes(text)
    for a, b in row_slices(bounds):
        part = LOWER[data[bounds[a]:bounds[b]]]
        starts, ends, first = find_words(part, bounds[a:b + 1] - bounds[a], LETTERS)
        if not len(starts):
            continue
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        letters = np.ascontiguousarray(part[LETTERS[part]])
        terms = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        code, names = _ordered_codes(terms)
        line = np.repeat(np.arange(b - a), np.diff(first))
        in_text, times = np.unique(line * len(names) + code, return_counts=True)
        key = group[a:b][in_text // len(names)] * len(names) + in_text % len(names)
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        own = key[heads] // len(names)
        yield pa.table({
            "lang": lang_names.take(pa.array(own // len(source_names))),
            "source": source_names.take(pa.array(own % len(source_names))),
            "term": names.take(pa.array(key[heads] % len(names))).cast(pa.string()),
            "n": np.add.reduceat(times, heads), "docs": np.diff(np.append(heads, len(key))),
        }).cast(COUNTS)


def count_terms(batches) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts, merged as long as they fit what a task holds."""
    held, size = [], 0
    for batch in batches:
        for more in batch_counts(*batch.columns):
            held.append(more)
            size += more.nbytes
            if size > HELD_BYTES:
                found = _merged(held)
                held, size = [found], found.nbytes
                if size > HELD_BYTES // 2:
                    yield from found.to_batches()
                    held, size = [], 0
    if held:
        yield from _merged(held).to_batches()


def _merged(tables: list[pa.Table]) -> pa.Table:
    found = pa.concat_tables(tables).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return found.rename_columns(["lang", "source", "term", "n", "docs"]).combine_chunks()


def skyband(n: np.ndarray, total: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the points that fewer than ``k`` others dominate: larger or equal ``n``, smaller or equal ``total``,
    smaller ``place`` (all different). Dominated points need not be counted, as what dominates them dominates on."""
    if len(n) <= k:
        return np.arange(len(n))
    order = np.lexsort((place, total, -n))
    total, place = total[order], place[order]
    kept = np.zeros(0, np.int64)
    for first in range(0, len(order), 256):
        here = np.arange(first, min(first + 256, len(order)))
        over = ((total[kept] <= total[here, None]) & (place[kept] < place[here, None])).sum(axis=1)
        here, over = here[over < k], over[over < k]
        among = (total[here] <= total[here, None]) & (place[here] < place[here, None])  # the later cannot dominate the earlier
        alive = np.ones(len(here), bool)
        for i in range(len(here)):
            alive[i] = over[i] + (among[i, :i] & alive[:i]).sum() < k
        kept = np.concatenate([kept, here[alive]])
    return order[kept]


def skybands(k: int, by_group: bool):
    """The ``mapInArrow`` function: of (lang, source, term, n, total), each group's skyband among the rows a task holds.

    With ``by_group`` rows come ordered by group, so that a task's result is each group's whole skyband."""

    def reduced(held: list[pa.Table]) -> pa.Table:
        table = pa.concat_tables(held).combine_chunks()
        place = np.empty(table.num_rows, np.int64)
        place[pc.sort_indices(table["term"]).to_numpy()] = np.arange(table.num_rows)
        langs, _ = _ordered_codes(table["lang"])
        sources, names = _ordered_codes(table["source"])
        group = langs * len(names) + sources
        order = np.argsort(group, kind="stable")
        n, total = table["n"].to_numpy(), table["total"].to_numpy()
        kept = []
        for rows in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            kept.append(rows[skyband(n[rows], total[rows], place[rows], k)])
        return table.take(pa.array(np.sort(np.concatenate(kept))))

    def run(batches) -> Iterator[pa.RecordBatch]:
        held, rows, limit = [], 0, HELD_ROWS
        for batch in batches:
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]))
                rows += batch.num_rows
            if rows <= limit:
                continue
            found = reduced(held)
            last = 0
            if by_group:  # the last group may go on
                ends = {c: found[c][-1] for c in ("lang", "source")}
                same = pc.and_(*(pc.equal(found[c], ends[c]) for c in ends))
                last = int(pc.sum(same).as_py())
            yield from found.slice(0, found.num_rows - last).to_batches()
            held, rows = ([found.slice(found.num_rows - last)] if last else []), last
            limit = max(HELD_ROWS, 2 * last)
        if held:
            yield from reduced(held).to_batches()

    return run


def share(n: str, all_: str, kept: str) -> str:
    """SQL: 1 + floor(SCALE * (n + SMOOTH) / (all + SMOOTH * kept)), exact for any long."""
    above = f"cast({SCALE} AS decimal(10,0)) * cast({n} + {SMOOTH} AS decimal(20,0))"
    return f"1L + ({above} div cast(greatest({all_} + {SMOOTH} * {kept}, 1L) AS decimal(20,0)))"


def distances(counts: pa.Table, sources: pa.Table) -> pa.Table:
    """Sums, over the terms of a chunk, of the differences of shares between a block of sources and all of the language.

    ``counts`` holds (term, place, p) where a term stands in a source; elsewhere the share is the source's ``base``."""
    at, base = sources["at"].to_numpy(), sources["base"].to_numpy()
    order = np.argsort(at, kind="stable")
    base, names = base[order], sources["source"].combine_chunks().take(pa.array(order))
    block = sources["block"][0].as_py()
    mine = np.arange(block * BLOCK, min((block + 1) * BLOCK, len(base)))
    sums = np.zeros((len(mine), len(base)), np.int64)
    if counts.num_rows:
        term, _ = _ordered_codes(counts["term"])
        by_term = np.argsort(term, kind="stable")
        term, where, p = term[by_term], counts["place"].to_numpy()[by_term], counts["p"].to_numpy()[by_term]
        width = max(16, (1 << 20) // len(base))
        for low in range(0, int(term[-1]) + 1, width):
            a, b = np.searchsorted(term, [low, low + width])
            dense = np.repeat(base[:, None], min(width, int(term[-1]) + 1 - low), axis=1)
            dense[where[a:b], term[a:b] - low] = p[a:b]
            for i, s in enumerate(mine.tolist()):
                sums[i] += np.abs(dense - dense[s]).sum(axis=1)
    one, other = np.nonzero(mine[:, None] != np.arange(len(base)))
    return pa.table({
        "lang": pa.repeat(sources["lang"][0], len(one)), "source": names.take(pa.array(mine[one])),
        "item": names.take(pa.array(other)), "value": sums[one, other],
    }).cast(pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))


def source_divergence(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from the others, and by which terms.

    Part ``pair`` has all other sources of the language, part ``term`` the ``top`` terms that stand more often in the
    source than in the language as a whole. Terms are runs of ASCII letters and of characters beyond ASCII, A-Z lowered;
    a language's kept terms stand in at least ``min_docs`` of its texts. Shares are smoothed and whole (see ``share``);
    all arithmetic is exact. Ties go to the smaller item in UTF-8 order.

    Null text, lang or source counts as empty. Texts without terms still make their group appear. Repeated rows count
    each. A language of one source has no pairs; one without kept terms has distances of 0 and no terms. Other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    work = scratch_folder(spark, "divergence")
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    # One shuffle serves the sums of a (lang, source, term) and those of a (lang, term): tasks send summed counts.
    per_task = texts.mapInArrow(tidied(count_terms), "lang string, source string, term string, n long, docs long")
    counts = per_task.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = "OVER (PARTITION BY lang, term)"
    kept = written(counts.selectExpr(
        "lang", "source", "term", "n", f"sum(n) {over} AS total", f"sum(docs) {over} AS docs",
        "row_number() OVER (PARTITION BY lang, term ORDER BY source) = 1 AS lead",
    ).where(f"docs >= {min_docs}").drop("docs"), "kept", work)

    per_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_own"))
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("lead").alias("n_terms"), F.count("*").alias("n_rows"))
    groups = written(
        texts.select("lang", "source").distinct().join(per_group, ["lang", "source"], "left").join(per_lang, "lang", "left")
        .na.fill(0, ["n_own", "n_lang", "n_terms", "n_rows"]).selectExpr(
            "*", "row_number() OVER (PARTITION BY lang ORDER BY source) - 1 AS at", "count(*) OVER (PARTITION BY lang) AS n_sources",
            f"{share('0', 'n_own', 'n_terms')} AS base", f"cast(ceil(n_rows / {CHUNK_ROWS}) AS int) AS n_chunks"), "groups", work)

    # Both parts read the two tables above only; they are written, as the scratch tables go with them.
    found = written(_terms(kept, groups, top).unionByName(_pairs(kept, groups)), "divergence")
    drop_folder(spark, work)
    return found


def _terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    columns = ["lang", "source", "term", "n", "total"]
    ddl = "lang string, source string, term string, n long, total long"
    local = kept.select(*columns).mapInArrow(tidied(skybands(top, False)), ddl)
    band = local.repartition("lang", "source").sortWithinPartitions("lang", "source").mapInArrow(tidied(skybands(top, True)), ddl)
    gained = f"{share('n', 'n_own', 'n_terms')} - ({share('total', 'n_lang', 'n_terms')})"
    ranked = band.join(groups, ["lang", "source"]).selectExpr("lang", "source", "term AS item", f"{gained} AS value").where("value > 0")
    return ranked.selectExpr("lang", "source", "'term' AS part", "item", "value", f"{_RANK} AS rank").where(f"rank <= {top}")


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Chunks of a language's terms meet the list of its sources: as many rows as the result has for a source."""
    chunk = "cast(pmod(xxhash64(term), n_chunks) AS int) AS chunk"
    # More sources than a block are worked out block by block, each by its own tasks.
    blocks = f"explode(sequence(0, cast((n_sources - 1) div {BLOCK} AS int))) AS block"
    own = kept.join(groups, ["lang", "source"]).selectExpr(
        "lang", "term", "at AS place", f"{share('n', 'n_own', 'n_terms')} AS p", chunk, "n_sources"
    ).selectExpr("lang", "chunk", blocks, "term", "place", "p")
    lists = groups.selectExpr("lang", "source", "at", "base", "explode(sequence(0, greatest(n_chunks, 1) - 1)) AS chunk", "n_sources").selectExpr(
        "lang", "chunk", blocks, "source", "at", "base")
    keys = ["lang", "chunk", "block"]
    parts = own.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(distances, "lang string, source string, item string, value long")
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return sums.selectExpr("lang", "source", "'pair' AS part", "item", "value", f"{_RANK} AS rank")


_RANK = "cast(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS int)"
