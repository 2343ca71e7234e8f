import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from martlake.llm.tokens import load, vocabulary_path
from martlake.session import scratch_path


@pytest.fixture(scope="module")
def stages(spark, sf_dir, docs):
    """The documents before the first stage and behind each one, with awkward rows among them."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    more = docs.select((F.col("doc_id") + 10_000_000).alias("doc_id"), "text", "lang", F.lit(None).cast("string").alias("source"),
                       F.length("text").cast("long").alias("n_chars"))
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns).union(more)
    out = []
    for name, stage in [("documents", lambda s, d, p: d), *corpus_pipeline.STAGES]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, table, sf_dir).write.parquet(path)
        table = spark.read.parquet(path)
        out.append(table)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_return_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    assert len({tuple(sorted(df.dtypes)) for df in stages[:-1]}) == 1


def test_language_drops_only_texts_without_one(stages):
    gone = stages[0].select("doc_id", "text").exceptAll(stages[1].select("doc_id", "text")).collect()
    assert {r.text for r in gone} <= {None, "", " \t\n", "12 34 !!", "Ελλάδα ½ ² İstanbul ﬁne ́ \x85 \x1c end"} and len(gone) >= 4


def test_one_document_of_each_group_stays(stages):
    before = stages[1].collect()
    groups = {}
    for i, _, label, _ in brute.near_duplicates([(i, r.text) for i, r in enumerate(before)], 5, 80):
        groups.setdefault(label, []).append(before[i].doc_id)
    want = [min(ids, key=lambda d: (d is None, d or 0)) for ids in groups.values()]
    assert sorted(map(str, want)) == sorted(str(r.doc_id) for r in stages[2].collect())


def test_rows_are_told_apart_by_their_texts(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "a"), (1, "quite another note about something else entirely here", "b"), (None, text + " eleven", "c"),
            (None, "words that stand in no other row of this small table", "d"), (None, "words that stand in no other row of this small table", "e"),
            (2, text.upper(), "f"), (3, None, "g"), (4, "", "h"), (3, None, "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, number string")
    kept = sorted(r.number for r in corpus_pipeline.near_duplicate(spark, df, "").collect())
    assert kept in (["a", "b", "d", "g", "h", "i"], ["a", "b", "e", "g", "h", "i"])


@pytest.mark.parametrize("stage", [fn for _, fn in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_of_nothing(spark, sf_dir, stage):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    out = stage(spark, none, sf_dir)
    assert out.count() == 0 and (stage is corpus_pipeline.packing or out.columns == none.columns)


def test_passages_are_gone_and_clean_texts_stay(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = rows(stages[2]), rows(stages[3])
    hit = {d for d, _, n, *_ in brute.decontamination([(d, r.text) for d, r in before.items()], items) if n}
    assert hit and set(after) == set(before)
    for d, r in after.items():
        assert (r.text != before[d].text) == (d in hit) and r.n_chars == len(r.text)


def test_personal_data_is_gone(stages):
    before, after = rows(stages[3]), rows(stages[4])
    dirty = {d for d, r in before.items() if any(brute.personal_data(r.text).values())}
    assert dirty and {d for d, r in after.items() if r.text != before[d].text} == dirty
    assert not any(v for r in after.values() for v in brute.personal_data(r.text).values())


def test_all_that_is_left_is_packed(stages):
    tokenizer = load(vocabulary_path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in stages[4].collect())
    assert stages[5].agg(F.sum("length")).first()[0] == want
