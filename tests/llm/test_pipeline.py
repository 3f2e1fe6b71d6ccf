import corpus_pipeline
import pytest

from test_bpe import PATH
from test_simhash import brute as brute_groups
from tokenizers import Tokenizer

from telemetra.llm.toxicity import SEEDS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    base = [f"plain text number {i} about w{i} x{i} y{i} z{i} and q{i} r{i} s{i}" for i in range(60)]
    rows = [(i, text) for i, text in enumerate(base)]
    rows += [(100 + i, base[i]) for i in range(5)] + [(120, base[7]), (120, base[7])]
    rows += [(7, base[7])]
    rows += [(200 + i, f"you are an idiot and a moron w{i} v{i} u{i} t{i} s{i} r{i}") for i in range(10)]
    rows += [(300, "start of text here the quick brown fox jumps over the lazy dog again end of text there")]
    rows += [(400, "mail me at some.body@example.com please do"), (401, None), (402, ""), (None, "no id at all in this row")]
    docs = spark.createDataFrame([(d, t, "en", "src", None if t is None else len(t), "extra", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, items string, toxicity int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, int(200 <= d < 300)) for d, _ in rows if d is not None and d % 2], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog again")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_keep_columns_and_do_their_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    all_rows = [(r.doc_id, r.text) for r in docs.collect()]
    clean = corpus_pipeline.drop_toxic(spark, docs, folder)
    words = set(SEEDS["I"].split())
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()} == {d for d, t in all_rows if words & set((t or "").split())}
    single = corpus_pipeline.drop_near_duplicates(spark, clean, folder)
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    firsts = {component for d, _, component in brute_groups(rows) if d is not None}
    assert sorted(r.doc_id for r in single.collect() if r.doc_id is not None) == sorted(firsts)
    assert single.filter("doc_id is null").count() == 1
    free = corpus_pipeline.drop_contaminated(spark, single, folder)
    assert {r.doc_id for r in single.collect()} - {r.doc_id for r in free.collect()} == {300}
    plain = corpus_pipeline.redact_personal_data(spark, free, folder)
    assert [(r.text, r.n_chars, r["items"], r.toxicity) for r in plain.filter("doc_id = 400").collect()] == [("mail me at [EMAIL] please do", 28, "extra", 1)]
    assert plain.count() == free.count()
    for stage in (clean, single, free, plain):
        assert stage.schema == docs.schema


def test_run_gives_tokens_of_what_is_left(spark, folder):
    tokenizer = Tokenizer.from_file(PATH)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert rows[400].ids == tokenizer.encode("mail me at [EMAIL] please do", add_special_tokens=False).ids
    # Both empty texts have fingerprint zero, so one of them stays.
    assert 300 not in rows and 203 not in rows and 103 not in rows and rows[401].ids == [] and 402 not in rows
    assert all(r.n_tokens == len(r.ids) for r in rows.values())


def test_empty_documents(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.collect() == []
