"""The corpus pipeline: each stage on what its predecessor kept, against brute force; odd tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_corpus_operators import jaccard_by_hand
from test_text_operators import hits_by_hand, lines_by_hand
from tokenizers import Tokenizer

import corpus_pipeline
from plumbline.llm.tables import written

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, data):
    """The input of each stage, then the result."""
    docs = [spark.read.parquet(f"{data}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], data), name))
    return [sorted(d.collect(), key=lambda r: r.doc_id) for d in docs], [d.columns for d in docs]


def test_stages_are_the_listed_ones(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "benchmark", "tokens"]
    rows, columns = stages
    assert all(c == columns[0] for c in columns[:-1])
    assert len({len(r) for r in rows}) >= 3 and len(rows[-1]) > 0


def test_language_keeps_clean_documents(stages):
    rows = stages[0]
    kept = {r.doc_id for r in rows[1]}
    assert kept == {r.doc_id for r in rows[0] if any(c.isalpha() for c in r.text or "")}
    assert {r.lang for r in rows[1]} <= {r.lang for r in rows[0] if r.lang} and all(r.lang for r in rows[1])
    given = {r.doc_id: r.lang for r in rows[0]}
    told = [(r.lang, given[r.doc_id]) for r in rows[1] if given[r.doc_id]]
    assert sum(a == b for a, b in told) / len(told) > 0.95


def test_lines_by_hand(stages):
    rows = stages[0]
    want = lines_by_hand([(r.source, r.text) for r in rows[1]], 0.1, 3)
    assert [(r.doc_id, r.text, r.n_chars) for r in rows[2]] == [(r.doc_id, w[1], len(w[1])) for r, w in zip(rows[1], want)]


def test_one_document_of_each_group_stays(stages):
    rows = stages[0]
    found = jaccard_by_hand([(r.doc_id, r.text) for r in rows[2]], 5, 80)
    assert {r.doc_id for r in rows[3]} == {c for _, _, c in found}


def test_contaminated_documents_go(spark, data, stages):
    rows = stages[0]
    items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").select("item_id", "text").collect()]
    clean = set()
    for r in rows[3]:
        n, hit, _ = hits_by_hand(r.text, items)
        if not hit or 20 * len(hit) < n:
            clean.add(r.doc_id)
    assert {r.doc_id for r in rows[4]} == clean


def test_tokens_are_the_library_s(stages):
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in stages[0][4]}
    assert {r.doc_id for r in stages[0][5]} == set(text)
    for r in stages[0][5]:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert bytes(r.ids) == b"".join(i.to_bytes(4, "little") for i in ids) and r.n_tokens == len(ids)


def test_odd_rows_pass_every_stage(spark, data):
    rows = [(None, None, None, None, None), (1, None, "en", "s", 1), (2, "", "en", None, 0), (3, "some words of english prose", "en", "s", 1)]
    rows += [(4, "some words of english prose", None, "t", 1)] * 2 + [(5, "9 8 7", "de", "s", 5), (6, "word " * 30000, "en", "s", None)]
    docs = spark.createDataFrame(rows, StructType.fromDDL(COLUMNS)).withColumns({"__host": F.lit("x"), "lang_pred": F.lit(1), "node": F.lit(2)})
    for _, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, data), "odd")
        docs = out if "text" in out.columns else docs
    assert sorted(r.doc_id for r in out.collect()) == [3, 6]


def test_empty_table_passes_every_stage(spark, data):
    docs = spark.createDataFrame([], StructType.fromDDL(COLUMNS))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, data) if "text" in docs.columns else docs
    assert docs.count() == 0
