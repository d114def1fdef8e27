import itertools
import random
import re

from hazardloom.llm.audit import audit, steps

DOCS = "doc_id long, text string, lang string, n long, subset int, A string, step int"


def _brute(docs, labels):
    """Every order applied filter by filter to the rows themselves."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, lang in docs:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": re.search("[#$%&*|]", t) is not None,
            "E": copy,
        }
        rows.append((lang or "", fails, i in good, i in toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        found = []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                fails = [r for r in own if r[1][f]]
                only = [r for r in fails if sum(r[1].values()) == 1]
                found.append((part, "".join(order), step, len(left), len(gone), len(fails) - len(gone), len(only), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        total = {f: sum(x[4] for x in found if x[1][x[2] - 1] == f) for f in "ABCDE"}
        out += [(*x, total[x[1][x[2] - 1]]) for x in found]
    return sorted(out)


def _rows(df):
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def _tables(spark, docs, labels):
    return (
        spark.createDataFrame([(i, t, p, 1, 2, "x", 3) for i, t, p in docs], DOCS),
        spark.createDataFrame([(i, q, t, "x") for i, q, t in labels], "doc_id long, quality int, toxic int, part string"),
    )


def test_audit_matches_plain_filters(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(160):
        t = " ".join(rng.choice(words[: rng.choice([30, 400])]) for _ in range(rng.choice([20, 99, 100, 150])))
        docs.append((i, t + rng.choice(["", " # x", "A" * 90, "Ä" * 200]), rng.choice(["en", "de", None, ""])))
    docs += [(200 + i, docs[i % 5][1], "en") for i in range(80)]  # a third of all rows are copies
    docs += [(300, None, "en"), (301, "", None), (302, "\x0b \n", "de"), (None, docs[0][1], "en"), (None, None, "en"), (5, docs[5][1], "en"), (5, docs[5][1], "en"), (5, "other", "de")]
    docs += [(400, "lange " * 60_000, "de"), (401, "lange " * 60_000, "de"), (402, "x" * 300_000, "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 420, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    assert _rows(audit(*_tables(spark, docs, labels))) == _brute(docs, labels)


def test_audit_edges(spark):
    assert audit(*_tables(spark, [], [])).count() == 0
    one = _rows(audit(*_tables(spark, [(1, "a", "en")], [])))
    assert len(one) == 600 and one == _brute([(1, "a", "en")], [])
    assert len(steps()) == 600 and len({s[:2] for s in steps()}) == 600
