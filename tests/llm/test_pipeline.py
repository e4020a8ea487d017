import inspect
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as P
from cartwake.llm import decontaminate, quality, simhash_dedup
from cartwake.sources.files import stored

from text_helpers import SMALL


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before and after each stage, each written and read again."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in P.STAGES:
        after = stored(stage(spark, docs, SMALL), "stage")
        out.append((docs, after))
        docs = after
    return out


def test_stages():
    assert [len(inspect.signature(f).parameters) for _, f in P.STAGES] == [3] * 5
    assert P.ORACLE_SQL is None


def test_columns(spark, steps):
    want = spark.read.parquet(f"{SMALL}/documents.parquet").dtypes
    for _, after in steps[:-1]:
        assert after.dtypes == want


def test_quality_stage(spark, steps):
    before, after = steps[0]
    model = quality.train(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    want = {r.doc_id for r in before.collect() if model.score(r.text) >= P.LEAST_SCORE}
    assert {r.doc_id for r in after.collect()} == want
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = [labels[d] for d in want if d in labels]
    # The table has eleven bad documents, too few to learn all kinds from.
    assert sum(1 for q in kept if q == 0) <= 5
    assert sum(kept) >= 0.95 * sum(labels.values())


def test_dedup_stage(steps):
    before, after = steps[1]
    want = {r.component_id for r in simhash_dedup.near_duplicates(before).collect()}
    rows = [r.doc_id for r in after.collect()]
    assert set(rows) == want and len(rows) == len(want)


def test_contamination_stage(spark, steps):
    before, after = steps[2]
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = decontaminate.Windows(items)

    def clean(text):
        words = decontaminate.words_of(text)
        n = sum(b - a for a, b in windows.hits(words)[0])
        return not (n > 0 and 20 * n >= len(words))

    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if clean(r.text)}


def test_mixing_stage(steps):
    before, after = steps[3]
    texts = {r.doc_id: r.text for r in before.collect()}
    uses = Counter(r.doc_id for r in after.collect())
    assert uses.keys() <= texts.keys() and max(uses.values()) <= 3
    assert all(r.text == texts[r.doc_id] for r in after.collect())
    size = sum(len(t.split()) for t in texts.values())
    assert abs(sum(len(texts[d].split()) * n for d, n in uses.items()) - size) < 0.05 * size


def test_token_stage(steps):
    before, after = steps[4]
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def crc(text):
        ids = model.encode(text, add_special_tokens=False).ids + [1]
        return len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))

    want = sorted((r.doc_id, *crc(r.text)) for r in before.collect())
    rows = sorted(after.collect(), key=lambda r: r.start)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    assert [r.doc_id for r in rows] == [w[0] for w in want]


def test_run_equals_its_stages(spark, steps):
    assert sorted(map(str, P.run(spark, SMALL).select("doc_id", "start", "ids_crc32").collect())) == sorted(
        map(str, steps[-1][1].select("doc_id", "start", "ids_crc32").collect())
    )


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert set(entry.oracle_sql()) <= names


def test_odd_documents(spark, odd, tmp_path):
    """Nulls, repeats and an empty table go through all stages."""
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, None), (None, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (docs, docs.limit(0)):
        start = stored(start, "start")
        for _, stage in P.STAGES:
            start = stored(stage(spark, start, str(tmp_path)), "stage")
        start.collect()


def test_stages_with_clashing_columns(spark):
    from pyspark.sql import functions as F

    names = ["a.b", "Score", "n_words", "_row", "FP", "hit_runs"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("*", *[F.lit("own").alias(n) for n in names])
    for name, stage in P.STAGES[:-1]:
        after = stored(stage(spark, docs, SMALL), "stage")
        assert after.columns == docs.columns and after.count() > 0
        for r in after.select(*[F.col(f"`{n}`").alias(f"x{i}") for i, n in enumerate(names)]).distinct().collect():
            assert set(r) == {"own"}
        docs = after
    assert P.STAGES[-1][1](spark, docs, SMALL).count() > 0
