"""Each stage of the pipeline against a brute-force version of it, on the smallest tables and some odd rows."""

import zlib
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import SMALLEST
from gridloom.plans.scratch import scratch_root
from tests.llm.test_operators import found_by_hand, linked_by_hand
from tests.llm.test_repeats import brute

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    odd = [(9001, None, "en", "s", 0), (9002, "", None, "s", 0), (9003, "123 !", "de", None, 5), (9004, "漢字漢字漢字", None, "s", 6)]
    return given.unionByName(spark.createDataFrame(odd, given.schema)).cache()


def texts(frame):
    return sorted((r["doc_id"], r["text"]) for r in frame.collect())


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_languages(spark, docs):
    kept = STAGE["language_id"](spark, docs, SMALLEST)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: r for r in kept.collect()}
    given = {r["doc_id"]: r for r in docs.collect()}
    assert set(given) - set(rows) == {9001, 9002, 9003, 9004}  # no letters, or of a script that no language has
    assert sum(r["lang"] == given[i]["lang"] for i, r in rows.items()) >= 0.97 * len(rows)
    assert all((r["text"], r["source"], r["n_chars"]) == (given[i]["text"], given[i]["source"], given[i]["n_chars"]) for i, r in rows.items())


def test_near_duplicates(spark, docs):
    kept = STAGE["minhash_near_dedup"](spark, docs, SMALLEST)
    assert kept.columns == docs.columns
    groups = linked_by_hand(texts(docs), 80, 100)
    assert texts(kept) == [(i, t) for i, t in texts(docs) if groups[i][1] == i]


def test_repeats(spark, docs):
    kept = STAGE["suffix_array_dedup"](spark, docs, SMALLEST)
    assert kept.columns == docs.columns
    gone = {i: cut for i, (_, cut) in brute(texts(docs)).items()}
    given = dict(texts(docs))
    for r in kept.collect():
        before = given[r["doc_id"]]
        assert (r["text"] or "").split() == [w for k, w in enumerate((before or "").split()) if k not in gone.get(r["doc_id"], ())]
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)


def test_leaks(spark, docs):
    kept = STAGE["benchmark_decontamination"](spark, docs, SMALLEST)
    assert kept.columns == docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALLEST}/benchmark.parquet").collect()]
    clean = {i for i, _, hit, _ in found_by_hand(texts(docs), items) if not hit}
    assert [i for i, _ in texts(kept)] == sorted(clean)
    assert len(clean) < docs.count()


def test_whole_run(spark):
    """What is packed is what all stages but the last keep, token by token."""
    kept = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALLEST)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {i: [*library.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts(kept)}
    got: dict = {}
    for r in sorted(corpus_pipeline.run(spark, SMALLEST).collect(), key=lambda r: (r["doc_id"], r["start"])):
        own = expected[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(r["ids"]) == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own)) and r["doc_tokens"] == len(expected[r["doc_id"]])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {i: len(x) for i, x in expected.items()}


CLASHING = {"score": "1.5D", "lang_pred": "'xx'", "cuts": "array(1)", "_id": "7L", "items": "'i'", "kept": "false", "hits": "0", "h": "1L"}


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Repeated rows, two texts of one id, null ids, and columns named like those that operators make."""
    rows = {r["doc_id"]: r for r in docs.collect()}
    long = [i for i, r in rows.items() if r["text"] and len(r["text"].split()) > 80]
    a, b = rows[long[0]], rows[long[-1]]
    more = [a, a, (b["doc_id"], a["text"], "en", "s", 1), (None, a["text"], "en", "s", 2), (None, None, None, None, None), rows[9002]]
    both = docs.unionByName(spark.createDataFrame(more, docs.schema))
    return both.selectExpr("*", *(f"{x} AS {c}" for c, x in CLASHING.items())).cache()


def numbered_by_hand(odd):
    """{number: (id, text)} of the rows with an id, in the order of ids, then of the texts' fingerprints."""
    pairs = odd.where("doc_id IS NOT NULL").selectExpr("doc_id", "text", "xxhash64(text) AS f").distinct().collect()
    return {k: (r["doc_id"], r["text"]) for k, r in enumerate(sorted(pairs, key=lambda r: (r["doc_id"], r["f"])))}


def listed(rows):
    return sorted(((i, t) for i, t in rows), key=repr)


def test_odd_rows_by_language(spark, odd):
    kept = STAGE["language_id"](spark, odd, SMALLEST)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert all((r["score"], r["lang_pred"], r["cuts"], r["_id"]) == (1.5, "xx", [1], 7) for r in rows)
    given = listed((r["doc_id"], r["text"]) for r in odd.collect() if r["text"] and r["doc_id"] not in (9003, 9004))
    assert listed((r["doc_id"], r["text"]) for r in rows) == given


def test_odd_rows_by_near_duplicates(spark, odd):
    kept = STAGE["minhash_near_dedup"](spark, odd, SMALLEST)
    assert kept.columns == odd.columns
    given = numbered_by_hand(odd)
    groups = linked_by_hand([(k, t) for k, (_, t) in given.items()], 80, 100)
    nameless = [(None, r["text"]) for r in odd.where("doc_id IS NULL").collect()]
    assert listed((r["doc_id"], r["text"]) for r in kept.collect()) == listed([x for k, x in given.items() if groups[k][1] == k] + nameless)


def test_odd_rows_by_repeats(spark, odd):
    kept = STAGE["suffix_array_dedup"](spark, odd, SMALLEST)
    assert kept.columns == odd.columns
    given = numbered_by_hand(odd)
    number = {x: k for k, x in given.items()}
    gone = {k: cut for k, (_, cut) in brute([(k, t) for k, (_, t) in given.items()]).items()}
    left = [(r["doc_id"], [w for k, w in enumerate((r["text"] or "").split()) if k not in gone.get(number.get((r["doc_id"], r["text"])), ())])
            for r in odd.collect()]
    assert listed((r["doc_id"], (r["text"] or "").split()) for r in kept.collect()) == listed(left)


def test_odd_rows_by_leaks(spark, odd):
    kept = STAGE["benchmark_decontamination"](spark, odd, SMALLEST)
    assert kept.columns == odd.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALLEST}/benchmark.parquet").collect()]
    given = numbered_by_hand(odd)
    clean = {given[k] for k, _, hit, _ in found_by_hand([(k, t) for k, (_, t) in given.items()], items) if not hit}
    expected = [(r["doc_id"], r["text"]) for r in odd.collect() if r["doc_id"] is None or (r["doc_id"], r["text"]) in clean]
    assert listed((r["doc_id"], r["text"]) for r in kept.collect()) == listed(expected)


@pytest.mark.parametrize("name", STAGE)
def test_no_documents(spark, odd, name):
    nothing = spark.createDataFrame([], odd.schema)
    left = STAGE[name](spark, nothing, SMALLEST)
    assert left.count() == 0
    assert name == "packing" or left.columns == odd.columns


def test_rows_that_stay_are_not_moved(spark):
    """Texts that a stage leaves alone take part in no shuffle: only rows that may be named by its findings are joined."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(k, f"text {k} of {k + 1} in {k + 2} " * 3, "en", "s", 0) for k in range(3000)] + [(None, "x", "en", "s", 1)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
        keyed, _ = corpus_pipeline.keyed(frame)
        wanted = spark.range(0, 3000, 100).withColumnRenamed("id", "doc_id")
        some, others = corpus_pipeline.parted(keyed, wanted, "doc_id")
        assert {r["doc_id"] for r in some.collect()} >= set(range(0, 3000, 100)) and some.count() < 100
        assert some.count() + others.count() == 3001
        whole = STAGE["minhash_near_dedup"](spark, frame, SMALLEST)
        joined = whole._jdf.queryExecution().optimizedPlan().toString().split("Join LeftAnti")
        assert len(joined) == 2 and "Union" in joined[0] and whole.count() == 3001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_languages_are_found_in_small_batches(spark, monkeypatch):
    """A batch in rows of whole documents stands several times in an executor, in Spark and in Python."""
    given = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('x ', 1000) AS text", "'en' AS lang", "'s' AS source", "2000 AS n_chars")
    learned = []
    monkeypatch.setattr(corpus_pipeline, "learn_profiles", lambda docs: learned.append(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")))

    def sized(docs, profiles, id_col, text_col, keep):
        def sizes(batches):
            for batch in batches:
                told = [pa.array([str(batch.nbytes)] * len(batch)), pa.array([1.0] * len(batch))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *told], [*batch.schema.names, "lang_pred", "score"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields)
        return docs.mapInArrow(sizes, f"{schema}, lang_pred string, score double")

    monkeypatch.setattr(corpus_pipeline, "identify_languages", sized)
    sizes = [int(r["lang"]) for r in STAGE["language_id"](spark, given, SMALLEST).collect()]
    assert len(sizes) == 4000 and max(sizes) < 2 << 20
    assert learned == [str(1 << 20)]


def test_languages_keep_no_copy_of_texts(spark):
    """What the stage leaves in the shared folder names the rows that change, and holds no text."""
    given = spark.read.parquet(f"{SMALLEST}/documents.parquet").selectExpr("doc_id", "text", "IF(doc_id % 10 = 0, 'xx', lang) AS lang", "source", "n_chars")
    given = given.unionByName(given.selectExpr("NULL AS doc_id", "text", "'xx' AS lang", "source", "n_chars").limit(3)).cache()
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.rglob("*.parquet"))
    kept = STAGE["language_id"](spark, given, SMALLEST)
    left = sum(p.stat().st_size for p in set(root.rglob("*.parquet")) - before if p.is_file())
    assert left < 0.1 * sum(len(r["text"] or "") for r in given.collect())
    rows = kept.collect()
    assert len(rows) == given.count() and sum(r["doc_id"] is None for r in rows) == 3
    assert "xx" not in {r["lang"] for r in rows if r["doc_id"] is None}
