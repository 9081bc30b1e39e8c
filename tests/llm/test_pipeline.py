import random

import pyarrow as pa
import pytest

import corpus_pipeline
from chartloom.llm import langid, near_copies
from chartloom.llm.common import BATCH_BYTES, BATCH_LIMIT, WRITTEN, written

rng = random.Random(11)
EN = ["the", "of", "and", "with", "there", "others", "thing", "whether", "right", "shown"] + [f"th{a}{b}" for a in "aeiou" for b in "rnst"]
DE = ["der", "die", "und", "nicht", "schon", "über", "großes", "zwei", "stück", "jäger"] + [f"sch{a}{b}" for a in "äöüie" for b in "tzgf"]


def text(words, n):
    return " ".join(f"{rng.choice(words)}{rng.choice('abcdefghijk')}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [(i, text(DE if i % 2 else EN, 150), "de" if i % 2 else "en", "s", 1) for i in range(60)]
    rows += [(100, rows[0][1], "en", "s", 1), (101, rows[1][1] + " ", "de", "s", 1), (102, "123 456 --", "en", "s", 1), (103, None, "en", "s", 1), (104, text(EN, 60) + " " + passage + " " + text(EN, 60), "en", "s", 1)]
    rows += [(105, rows[2][1][:400] + " " + text(EN, 200), "en", "s", 1), (106, text(EN, 4000), None, "s", 1), (None, text(DE, 80), "de", "s", 1)]
    d = f"file://{tmp_path_factory.mktemp('tables')}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_take_effect_in_order(spark, corpus):
    docs, kept = spark.read.parquet(f"{corpus}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, corpus), name)
        assert out.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in out.collect()}
        docs = out
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_substrings", "decontaminated", "packed"]
    assert set(range(60)) | {None} <= set(kept["language"]) and not {102, 103} & set(kept["language"])
    assert not {100, 101} & set(kept["near_duplicates"]) and {0, 1, None} <= set(kept["near_duplicates"])
    assert kept["near_duplicates"][2][:300] in kept["near_duplicates"][105] and kept["near_duplicates"][2][:300] not in kept["repeated_substrings"][105]
    assert set(kept["repeated_substrings"]) - set(kept["decontaminated"]) == {104}


def test_run_packs_what_is_left(spark, corpus):
    before = list(WRITTEN)
    out = corpus_pipeline.run(spark, corpus).collect()
    assert [p for p in WRITTEN if p not in before and "stage-packed" not in p] == []
    assert {r["doc_id"] for r in out} == (set(range(60)) | {105, 106, None})
    assert corpus_pipeline.ORACLE_SQL is None
    assert all(r["length"] <= 2048 for r in out) and max(r["piece"] for r in out) >= 1


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_and_repeated_rows(spark, corpus, stage):
    assert stage(spark, spark.createDataFrame([], DOCUMENTS), corpus).count() == 0
    rows = [(1, text(EN, 90), "en", "s", 1)] * 3 + [(2, None, None, None, None), (None, text(EN, 40), None, None, None)]
    assert stage(spark, spark.createDataFrame(rows, DOCUMENTS), corpus).count() <= len(rows)


def test_texts_under_one_id_stand_alone(spark, corpus):
    passage = spark.read.parquet(f"{corpus}/benchmark.parquet").first()["text"]
    a, b = text(EN, 150), text(EN, 150)
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, a, "en", "s", 1), (7, passage + " " + a, "en", "s", 1), (7, text(DE, 80), "de", "s", 1), (None, b + " " + passage, "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCUMENTS)
    kept = sorted(r["text"] for r in corpus_pipeline.near_duplicates(spark, docs, corpus).where("doc_id = 1").collect())
    assert kept == sorted([a, b])
    left = [r["text"] for r in corpus_pipeline.decontaminated(spark, docs, corpus).collect()]
    assert sorted(left) == sorted([a, b, a, rows[4][1]])


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_send_batches_of_few_bytes(spark, corpus, stage):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], ["rows", "bytes"])

    spark.conf.unset(BATCH_LIMIT)
    stage(spark, spark.read.parquet(f"{corpus}/documents.parquet"), corpus)
    each = 100_000
    found = spark.range(0, 100, 1, 1).selectExpr("id", f"repeat('x', {each}) text").mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in found) == 100
    assert max(r["bytes"] for r in found) <= BATCH_BYTES + 2 * each


def test_a_limit_of_the_session_stays(spark, corpus):
    spark.conf.set(BATCH_LIMIT, "12345")
    try:
        corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{corpus}/documents.parquet"), corpus)
        assert spark.conf.get(BATCH_LIMIT) == "12345"
    finally:
        spark.conf.unset(BATCH_LIMIT)


def test_one_row_a_batch_gives_the_same(spark, corpus):
    def outcome():
        docs, kept = spark.read.parquet(f"{corpus}/documents.parquet"), []
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, corpus), name)
            kept.append(sorted((r["doc_id"] or -1, r["text"], r["lang"]) for r in docs.collect()))
        return kept

    try:
        spark.conf.set(BATCH_LIMIT, str(1 << 28))
        wide = outcome()
        spark.conf.set(BATCH_LIMIT, "1")
        assert outcome() == wide
    finally:
        spark.conf.unset(BATCH_LIMIT)


def test_language_learns_without_python_rows(spark, corpus, monkeypatch):
    given, create = [], type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *rest, **more: given.append(data) or create(self, data, *rest, **more))
    langid.cross_parse_language(spark.read.parquet(f"{corpus}/documents.parquet"))
    assert given and not any(isinstance(x, list) for x in given)


def test_counting_shingles_drops_models_of_earlier_stages(spark, monkeypatch):
    left = []

    def summed(docs, column, of_texts, shape, kind):
        langid.parser((("en", " the "),))
        of_texts(["some words of a text"])
        left.append(langid.parser.cache_info().currsize)
        return of_texts([])

    monkeypatch.setattr(near_copies, "summed", summed)
    near_copies.rarity(None, "text", 5)
    assert left == [0]
