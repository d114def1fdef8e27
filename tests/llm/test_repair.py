import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from hazardloom.llm.queries import damage
from hazardloom.llm.repair import Machine, plan_repairs, repaired, text_digests

SCHEMA = "conv_id long, turn long, role string, text string, symbol int, conv string, copies string, audit int"
NAMES = {"u": "user", "a": "assistant"}


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _cheapest(rows):
    """All sequences of edits no dearer than deleting everything, tried one by one."""
    faults, best = _faults(rows), (2 * len(rows) + 1, "", [])

    def go(i, cost, audit, out):
        nonlocal best
        if cost > best[0] or cost > 2 * len(rows):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
            best = min(best, (cost, audit, out))
        for name in NAMES.values():
            go(i, cost + 5, audit + "I", [*out, (name, "")])
        if i < len(rows):
            (role, text), extra = rows[i], 5 * (faults[i] == "truncated")
            go(i + 1, cost + 2, audit + "D", out)
            if faults[i] in ("", "truncated"):
                go(i + 1, cost + extra, audit + "K", [*out, (role, text)])
                for name in NAMES.values():
                    go(i + 1, cost + 1 + extra, audit + "R", [*out, (name, text)])

    go(0, 0, "", [])
    return best


def _brute(table):
    out = []
    for conv in {r[0] for r in table}:
        own = sorted(((t is not None, t or 0, " " if r is None else r, hashlib.sha256((" " if x is None else x).encode()).digest(), " " if x is None else x) for c, t, r, x in table if c == conv))
        rows = [(r, x) for *_, r, _, x in own]
        faults, turns = _faults(rows), {t for named, t, *_ in own if named}
        pairs = [a[0][:1] + b[0][:1] for a, b in itertools.pairwise(rows)]
        cost, audit, left = _cheapest(rows)
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in left).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest))
    return sorted(out, key=str)


def _rows(spark, table, **kw):
    df = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in table], SCHEMA)
    plan = plan_repairs(df, **kw)
    hashes = text_digests(repaired(df, plan))
    found = plan.join(hashes, "conv", "left").withColumn("sha256", F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    return sorted((tuple(r) for r in found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256").collect()), key=str)


def _random(rng, convs, most):
    table = []
    for c in range(convs):
        for t in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = rng.choice(["Hi.", "Hi.", "So?", "cut", " \n", "", None, "a. b", "Yes!\t", "é."])
            table.append((c if c else None, rng.choice([t, t, t, 2 * t, None]), role, text))
    return table


@pytest.mark.parametrize("piece", [1 << 16, 1, 2])
def test_repairs_are_the_cheapest(spark, piece):
    table = _random(random.Random(piece), 150, 6)
    assert _rows(spark, table, piece=piece) == _brute(table)


def test_a_hot_conversation_over_many_pieces(spark):
    rng = random.Random(8)
    table = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"Text {t}.", f"Text {t}.", "again.", "cut"])) for t in range(600)]
    table += [(1, 700, "user", "copy.")] * 300 + [(2, None, "user", "x" * 300_000 + "."), (2, 1, "assistant", "So.")]
    whole, split = _rows(spark, table), _rows(spark, table, piece=7)
    assert whole == split
    assert [r[0] for r in whole] == [1, 2] and whole[1][7] == "KK" and len(re.sub("I", "", whole[0][7])) == 900
    assert whole[0][3] >= 299


def test_pieces_agree_with_one_scan():
    rng, m = random.Random(5), Machine()
    for _ in range(300):
        symbols = bytes(rng.randrange(16) for _ in range(rng.randint(0, 12)))
        cost, audit = m.solve(symbols)
        at = rng.randint(0, len(symbols))
        left, end = m.matrix(symbols[:at]), m.scan(symbols[at:], m.end)
        behind = [end[1] + c for c in m.vectors[end[0][0]]]
        assert min(left[q] + behind[q] for q in range(4)) == cost
        assert len(audit.replace("I", "")) == len(symbols)
    assert len(m.vectors) < 200


def test_no_rows(spark):
    assert _rows(spark, []) == []
    assert _rows(spark, [(5, -(2**63), "user", None), (5, 2**63 - 1, "user", "")])[0][1] == 2**63 - 1


def test_damage(spark):
    import zlib

    table = [(c, t, "assistant", "One. Two? Three!") for c in range(20) for t in range(10)] + [(None, None, None, None), (3, None, None, "No.")]
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in table:
        r, x = " " if r is None else r, " " if x is None else x
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if f:
            row = (c, t, "user" if f == 4 else r, "" if f == 1 else re.sub("[.!?]", "", x) if f == 2 else x)
            want += [row] * (2 if f == 3 else 1)
    assert sorted(map(str, (tuple(r) for r in damage(df).collect()))) == sorted(map(str, want))
