"""Extra columns of any name pass through every operator and stage, or do not matter to it."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from deskwise.llm import decontaminate, licences, queries
from deskwise.llm.genetic import best_fit_pack
from deskwise.llm.merkle import verified_documents
from deskwise.llm.packing import pack
from deskwise.llm.repetition import repetition
from deskwise.llm.sharding import stratified_shards
from deskwise.llm.simhash import keep_one_per_group, near_duplicates
from deskwise.llm.spelling import spelling_variants
from deskwise.llm.substrings import remove_repeats
from deskwise.llm.token_counts import corpus_token_counts
from deskwise.llm.token_files import encode_corpus

# Names that the operators use themselves, a dotted one, one with a quote and mixed case.
NAMES = (
    "key_id key_text KEY_ID row ROW row_id row_text kept_id kept_text hit_id hit_text spans __spans removed removed_ "
    "__removed __row_id c0 c5 judged document document_ ids start length offset sequence_id row_number shard slot cell "
    "stratum place rank fingerprint group component_id first root shingled scanned item_id word n tree idx digest path "
    "leaf bin question answer a.b a`b Mixed_Case"
).split()
EXACT = [n for n in NAMES if n.lower() not in ("row", "key_id")] + ["row", "key_id"]


@pytest.fixture(scope="module")
def plain(docs_of):
    line = "a line that several of the documents hold in the same words"
    body = " ".join(f"word{k}" for k in range(80))
    rows = [
        (k, f"{line}\n{body} {' '.join(f'own{k}x{j}' for j in range(30))}", "s" if k % 3 else None) for k in range(12)
    ]
    return docs_of([*rows, (None, None), (12, ""), (3, rows[3][1]), (13, rows[4][1])])


@pytest.fixture(scope="module")
def crowded(plain):
    return plain.select("*", *[F.lit(f"kept {n}").alias(n) for n in EXACT])


def rows_of(frame, columns):
    return sorted((repr(tuple(r)) for r in frame.select(*columns).collect()))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_hand_all_columns_on(spark, sf, plain, crowded, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    want, got = stage(spark, plain, sf), stage(spark, crowded, sf)
    assert got.columns == crowded.columns and want.columns == plain.columns
    assert rows_of(got, plain.columns) == rows_of(want, plain.columns) != []
    assert got.toPandas()[EXACT].drop_duplicates().to_numpy().tolist() == [[f"kept {n}" for n in EXACT]]


# Among documents without the same words twice, whatever the columns.
OPERATORS = {
    # Which of two equal scores is taken follows the stored order.
    "pack": lambda d: pack(d).groupBy("doc_id", "doc_tokens").agg(F.sum("length")),
    "contaminated": lambda d: decontaminate.contaminated(d, d.sparkSession.createDataFrame([(1, "word1 word2 word3 word4 word5 word6")], "item_id int, text string")),
    "licences": lambda d: licences.document_licences(d),
    "token_counts": lambda d: corpus_token_counts(d),
    "token_files": lambda d: encode_corpus(d),
    "repetition": lambda d: repetition(d),
    "shards": lambda d: stratified_shards(d, 4),
    "near_duplicates": lambda d: near_duplicates(d),
    "manifest": lambda d: verified_documents(d),
    "spelling": lambda d: spelling_variants(d),
    "best_fit": lambda d: best_fit_pack(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_do_not_mind_other_columns(plain, crowded, name):
    want, got = OPERATORS[name](plain), OPERATORS[name](crowded)
    assert rows_of(got, got.columns) == rows_of(want, got.columns)


@pytest.mark.parametrize("removed", ["removed", "REMOVED", "spans"])
def test_what_was_removed_takes_the_name_it_is_given(crowded, removed):
    got = remove_repeats(crowded, removed=removed)
    assert got.columns == [*(c for c in crowded.columns if c.lower() != removed.lower()), removed]
    assert got.where(F.size(F.col(removed)) > 0).count() > 0


def test_one_row_of_a_group_stays_with_all_its_columns(crowded):
    got = keep_one_per_group(crowded)
    assert got.columns == crowded.columns and 0 < got.count() < crowded.count()


def test_items_need_question_and_answer_both(spark, plain):
    text = " ".join(f"word{k}" for k in range(20))
    for extra in ("question", "answer"):
        items = spark.createDataFrame([(1, text, "x")], f"item_id int, text string, {extra} string")
        assert decontaminate.contaminated(plain, items).count() > 0


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
    # What SQL cannot express: tokenizers, CRC-32 of ids, XXH64, window scoring.
    without = {"op1", "op2", "op4", "op5", "op7", "op8", "op9", "op13"}
    assert {n.split("_")[0] for n in queries.QUERIES.keys() - queries.ORACLE_SQL.keys()} == without
