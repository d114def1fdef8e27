import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hazardloom.operators.batches import statement_batches
from hazardloom.operators.digests import changed_rows, digest_tree, group_digest, ordered_digest, tree_diff
from hazardloom.streaming.change_only import emitted


@pytest.fixture
def small(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")
    yield spark
    spark.conf.unset(name)


def _rows(rng):
    return [(k, 10 * i + rng.randrange(9), i, rng.choice("ab") * rng.randrange(1, 4)) for k, n in ((1, 200), (2, 3), (None, 20)) for i in range(n)]


def test_folds_carry_over_batches_and_gather_no_key(small):
    rng = random.Random(1)
    rows = _rows(rng)
    df = small.createDataFrame(rng.sample(rows, len(rows)), "k long, at long, i long, t string")
    feed = emitted(df, "k", "at", "t", "i", 25)
    assert "collect_list" not in feed._jdf.queryExecution().toString()
    sent = set()
    for k in (1, 2, None):
        last = None
        for _, at, i, t in sorted((r for r in rows if r[0] == k), key=lambda r: r[1:]):
            if last is None or t != last[1] or at - last[0] >= 25:
                last = (at, t)
                sent.add((k, at, i, t))
    assert {tuple(r) for r in feed.collect()} == sent


def _fold(sizes, most):
    """The batches as one loop deals them."""
    batch, held, out = 0, 0, []
    for size in sizes:
        fits = held is not None and (held == 0 or size is not None and held + size <= most)
        batch, held = (batch, None if size is None else held + size) if fits else (batch + 1, size)
        out.append(batch)
    return out


@pytest.mark.parametrize("chunk", [1, 2, 5, 8192])
def test_batches_of_many_chunks_are_those_of_one_loop(small, chunk):
    rng = random.Random(chunk)
    rows = []
    for k in (None, *range(30)):
        sizes = [0, 0, 1, 3, 7, 10, 11, 40, None] if k and k % 3 else [2, 3, 3, 4]
        rows += [(k, i, None if (n := rng.choice(sizes)) is None else "x" * n) for i in range(rng.randrange(1, 60))]
    rows += [(99, i, "xxx") for i in range(500)]
    df = small.createDataFrame(rng.sample(rows, len(rows)), "k long, i long, t string")
    got = {(r.k, r.i): r.batch for r in statement_batches(df, "k", "i", "t", 10, chunk).collect()}
    assert len(got) == len(rows)
    for k in {r[0] for r in rows}:
        own = sorted((r[1], r[2]) for r in rows if r[0] == k)
        assert [got[k, i] for i, _ in own] == _fold([None if t is None else len(t) for _, t in own], 10), k


def test_batches_of_nothing_and_of_text_keys(small):
    assert statement_batches(small.createDataFrame([], "k long, i long, t string"), "k", "i", "t", 10).count() == 0
    rows = [("", 1, "a"), ("", 2, "b" * 10), (None, 1, "c"), ("=", 1, "d")]
    got = statement_batches(small.createDataFrame(rows, "k string, i int, t string"), "k", "i", "t", 10)
    assert sorted(map(str, got.collect())) == sorted(map(str, small.createDataFrame([("", 1, 0), ("", 2, 1), (None, 1, 0), ("=", 1, 0)], "k string, i int, batch int").collect()))


def test_ordered_digests_hash_the_sorted_hashes(small):
    rows = [(g, hashlib.sha256(f"{g}{i}".encode()).hexdigest()[:16]) for g, n in (("2024-01", 50), ("2024-02", 1), (None, 20)) for i in range(n)] + [("2024-02", None)]
    got = ordered_digest(small.createDataFrame(rows, "group string, hash string").repartition(5), F.col("group"), F.col("hash")).collect()
    want = {g: [h for x, h in rows if x == g] for g, _ in rows}
    assert {(r.group, r.n, r.digest) for r in got} == {(g, len(h), hashlib.sha256("".join(sorted(filter(None, h))).encode()).hexdigest()[:16]) for g, h in want.items()}
    assert len(got) == 3


def test_digests_merge_and_tell_sets_apart(spark):
    rng = random.Random(2)
    rows = [(k, i, hashlib.sha256(f"{k}{i}".encode()).hexdigest()[:16]) for k in ("2024-01", "2024-02", None) for i in range(300)]
    df = lambda r: spark.createDataFrame(r, "group string, k long, hash string")
    flat = {r.group: (r.n, r.digest) for r in group_digest(df(rows), F.col("group"), F.col("hash")).collect()}
    for group in ("2024-01", "2024-02", None):
        own = [h for g, _, h in rows if g == group]
        text = f"{len(own)}:{sum(int(h[:8], 16) for h in own)}:{sum(int(h[8:], 16) for h in own)}"
        assert flat[group] == (300, hashlib.sha256(text.encode()).hexdigest()[:16])
    tree = digest_tree(df(rng.sample(rows, len(rows))).repartition(7), "k")
    assert {r.group: r.digest for r in tree.where("prefix = ''").collect()} == {g: d for g, (_, d) in flat.items()}
    new = [r for r in rows if r[:2] != ("2024-01", 5)] + [("2024-02", 999, "0" * 16)]
    new = [(g, k, "f" * 16 if (g, k) == ("2024-02", 7) else h) for g, k, h in new] + [("2024-03", 1, "1" * 16)]
    differ = tree_diff(tree, digest_tree(df(new), "k"))
    assert {r.group for r in differ.where("prefix = ''").collect()} == {"2024-01", "2024-02", "2024-03"}
    assert differ.where("length(prefix) = 2").count() == 4
    got = sorted((r.group, r.k, r.change) for r in changed_rows(df(rows), df(new), differ, "k").collect())
    assert got == [("2024-01", 5, "delete"), ("2024-02", 7, "update"), ("2024-02", 999, "insert"), ("2024-03", 1, "insert")]
    assert tree_diff(tree, tree).count() == 0
