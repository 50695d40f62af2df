"""op4 on verbatim items that are short, poor in words or set otherwise."""

from refiscope.llm import decontaminate

ITEMS = [
    (1, "12 34 56 78 90 11 22 33 44 55 66"), (2, "The Quick Brown Fox Jumps Over The Lazy Dog While Seven Cats Watch Quietly"), (3, "What is the capital of France?"),
    (4, "Mary Anna Peter Paul John Luke went out to find the 9 8 7 6 5 4 3"), (5, "Add 7 kg and 12 kg in this sum."), (6, "Does Anna like Peter and Paul as much as Mary likes Luke and John")]
CASES = [
    ("codes 12 34 56 78 90 11 22 33 44 55 66 end", [1]), ("codes 13 34 57 78 91 11 23 33 45 55 67 end", []),
    ("So: The Quick Brown Fox Jumps Over The Lazy Dog While Seven Cats Watch Quietly, he read", [2]), ("the quick brown fox jumps over the lazy dog while seven cats watch quietly", [2]),
    *[(f"Test {lead}What is the capital of France? Done", [3]) for lead in ("1) ", "(a) ", ", ", "- ", ": ")], ("what is the capital of france", [3]),
    ("We know that Paris is the capital of France", []), ("He read - What is the capital of Spain? there", [3]),
    ("They went out to find the 1 2 3 of it", []),  # one window of the item's template, the others differ
    ("- Add 8 kg and 15 kg in this sum.", [5]), ("does anna like peter and paul as much as mary likes luke and john", [6])]


def test_verbatim_items(spark):
    docs = spark.createDataFrame(list(enumerate(t for t, _ in CASES)), "doc_id bigint, text string")
    got = {r.doc_id: list(r.item_ids) for r in decontaminate.contaminated(docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(CASES)] == CASES
