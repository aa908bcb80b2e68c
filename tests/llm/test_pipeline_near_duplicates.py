import corpus_pipeline
from llm.test_simhash import plain_components, plain_fingerprint

A = "the quick brown fox of the north jumps over a lazy dog and runs to the river in the dark of night"
B = "once upon a time there was a miller who had three sons and a mill and a donkey and one grey cat"
C = "rain fell on every street of that town while nobody at all was out to see where the water went"


def plain_groups(rows):
    """The rows of each group, by comparing all fingerprints."""
    named = plain_components([(i, plain_fingerprint(r[1])) for i, r in enumerate(rows)])
    groups = {}
    for r, g in zip(rows, named):
        groups.setdefault(g, []).append(r)
    return list(groups.values())


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [tuple(r) for r in corpus_pipeline.keep_one_of_near_duplicates(spark, df, "").collect()]
    groups = plain_groups(rows)
    assert len(got) == len(groups)
    for g in groups:
        (one,) = [r for r in got if r in g]
        assert one[0] == min((r[0] for r in g if r[0] is not None), default=None)
    return got


def test_rows_without_an_id_and_with_the_same(spark):
    # distinct texts without an id all stay; a group of both keeps the row with the id
    got = check(spark, [(None, A, "a"), (None, B, "a"), (None, B, "a"), (None, C, "a"), (7, C, "b")])
    assert {r[1] for r in got} == {A, B, C}
    # 5:A is its own group, 5:B a copy of 3
    got = check(spark, [(5, A, "a"), (5, B, "a"), (3, B.upper(), "a"), (5, A, "b"), (5, A, "a")])
    assert sorted(r[:2] for r in got) == [(3, B.upper()), (5, A)]


def test_awkward_rows(spark, docs, no_docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    check(spark, rows)
    assert corpus_pipeline.keep_one_of_near_duplicates(spark, no_docs, "").count() == 0
    assert corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "").columns == docs.columns
