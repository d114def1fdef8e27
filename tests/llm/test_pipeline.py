import re

import corpus_pipeline
from hazardloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SF)
        if name != "packing":
            assert out.columns == names
            assert out.join(kept, ["doc_id", "text"], "left_anti").count() == 0
            if name != "mixing":
                assert out.count() <= kept.count()
        kept = out
    assert sorted(kept.collect()) == sorted(corpus_pipeline.run(spark, SF).collect())


def test_stages_take_awkward_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "x " * 5000, "en", "a", 10_000), (3, "x " * 5000, "en", "a", 10_000), (4, "x  " * 5000, "xx", "b", 1), (5, "one two", "en", "b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.where("false")):
        kept = table
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, SF)
        assert (kept.count() > 0) == (table.count() > 0)


def test_deduplicating_stages_match_brute_force(spark):
    """What stays after exact and near deduplication of the smallest table, by comparing all texts in Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    best: dict = {}
    for i, t in rows:
        norm = re.sub("[\x20\x09-\x0d]", "", t)
        best[norm] = min(best.get(norm, (1, 0, "")), (-len(t), i, t))
    exact = {i: t for _, i, t in best.values()}
    kept = stages["exact_dedup"](spark, docs, SF)
    assert {r.doc_id for r in kept.collect()} == set(exact)

    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    words = {i: t.encode().translate(lower).split() for i, t in exact.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b]) if a < b else 0
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                root[max(top(a), top(b))] = min(top(a), top(b))
    assert {r.doc_id for r in stages["ngram_join"](spark, kept, SF).collect()} == {top(i) for i in sets}


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
