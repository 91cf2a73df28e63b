import pytest

import corpus_pipeline
from harvestline.llm import decontaminate, packing, simhash, toxicity
from harvestline.llm.common import keep

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The table before the first stage, then after each."""
    made = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        made.append(keep(stage(spark, made[-1], SF_DIR), name))
    return made


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_all_but_the_last_have_the_columns_of_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "packing",
    ]
    for frame in stages[:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = toxicity.add_scores(stages[0], toxicity.fit(stages[0], labels))
    wanted = {r.doc_id for r in scored.where("toxicity < 0.5").collect()}
    assert ids(stages[1]) == wanted


def test_line_dedup_keeps_all_documents_and_takes_lines_out(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    seen = set()
    for r in sorted(stages[2].collect(), key=lambda r: r.doc_id):
        left = r.text.split("\n")
        own = before.pop(r.doc_id).split("\n")
        assert r.n_chars == len(r.text)
        it = iter(own)
        assert r.text == "" or all(line in it for line in left)
        sets = {frozenset(line.lower().split()) for line in left} - {frozenset()}
        assert not sets & seen
        seen |= {frozenset(line.lower().split()) for line in own}
    assert not before


def test_one_document_of_each_group_stays(stages):
    five = corpus_pipeline.SHINGLE_WORDS
    found = simhash.near_duplicates(stages[2], words=five)
    assert ids(stages[3]) == {r.component_id for r in found.collect()}


def test_contaminated_documents_go(spark, stages):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = {r.doc_id for r in decontaminate.leaks(stages[3], bench).collect()}
    assert ids(stages[4]) == ids(stages[3]) - found
    assert decontaminate.leaks(stages[4], bench).count() == 0


def test_every_token_is_packed(stages):
    pieces = stages[5].collect()
    total = {r.doc_id: r.doc_tokens for r in pieces}
    assert set(total) == ids(stages[4])
    for doc_id, tokens in total.items():
        assert sum(r.length for r in pieces if r.doc_id == doc_id) == tokens
    filled = {}
    for r in pieces:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= packing.WINDOW


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    got = corpus_pipeline.run(spark, SF_DIR).select(columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[5].select(columns).collect()))


@pytest.mark.parametrize("place", range(4))
def test_stages_stand_null_empty_repeated_and_clashing_input(spark, place):
    name, stage = corpus_pipeline.STAGES[place]
    rows = [
        (1, "plain words of a text\nand a line", "en", 1, 2, "x"),
        (1, "plain words of a text\nand a line", "en", 1, 2, "x"),
        (2, None, None, 3, 4, None),
        (None, "", "en", 5, 6, "y"),
        (None, None, "en", 7, 8, "y"),
        (3, "other words " * 3000, "de", 9, 9, "z"),
    ]
    schema = "doc_id long, text string, lang string, n_lines long, n_removed long, score string"
    frame = spark.createDataFrame(rows, schema)
    out = stage(spark, frame, SF_DIR)
    assert out.columns == frame.columns
    got = out.collect()
    assert {r.doc_id for r in got} >= {1, 3}
    assert all(r.n_lines in (1, 3, 5, 7, 9) for r in got)
    assert stage(spark, frame.limit(0), SF_DIR).count() == 0
