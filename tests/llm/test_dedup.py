import hashlib
import random
import re
import string

import pytest
import xxhash
from pyspark.sql import functions as F

from hazardloom.llm import line_dedup
from hazardloom.llm.components import components
from hazardloom.llm.exact_dedup import exact_dedup, exact_groups
from hazardloom.llm.ngram_join import drop_similar, similar_groups
from hazardloom.llm.shingles import shingle_set

SCHEMA = "doc_id long, text string, digest string, rep long, n long"
WS = "[\x20\x09-\x0d]"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA)


def _lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_exact_groups(spark):
    rows = [(5, "a b"), (3, "ab "), (2, "ab"), (9, " a  b"), (7, None), (8, ""), (6, "\x0b\t"), (None, "ab\n\n\n\n\n"), (1, "é"), (1, "é"), (-4, "É"), (10, "x" * 200_000)] + [(100 + i, "hot " * (i % 3 + 1)) for i in range(90)]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(_docs(spark, rows)).collect()}
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(re.sub(WS, "", t or ""), []).append((-len(t or ""), i is None, i, t))
    want = set()
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))[2]
        want |= {(m[2], keep, len(members), m[2] == keep, hashlib.sha256(norm.encode()).hexdigest()) for m in members}
    assert got == want
    assert exact_groups(_docs(spark, [])).count() == 0
    kept = exact_dedup(_docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "digest", "rep", "n"]
    assert kept.count() == len(groups)


def test_a_repeated_id_keeps_its_longest_text(spark):
    rows = [(1, "a b"), (1, "a  b"), (2, "ab"), (3, "x y"), (3, "x\ty"), (4, "xy"), (5, "same"), (5, "same"), (None, "n  n"), (None, "nn")]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_groups(_docs(spark, rows)).collect()), key=str)
    assert [g for g in got if g[1] == 1] == [(1, 1, 3, False), (1, 1, 3, True), (2, 1, 3, False)]
    assert sorted(g[3] for g in got if g[1] == 3) == [False, False, True]
    assert [g for g in got if g[1] == 5] == [(5, 5, 2, True)] * 2 and sorted(g[3] for g in got if g[0] is None) == [False, True]
    for _ in range(3):
        stay = {(r.doc_id, r.text) for r in exact_dedup(_docs(spark, rows)).collect()}
        assert len(stay) == 4 and (1, "a  b") in stay and (5, "same") in stay and (None, "n  n") in stay


def test_ids_and_marks_of_all_sizes(spark):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), 99_999_999, -7]
    rows = [(i, f"t{n} ") for n in range(40) for i in ids]
    got = exact_groups(_docs(spark, rows))
    assert got.where(f"keep_id = {-(2**63)} and group_size = {len(ids)}").count() == 40 * len(ids) and got.where("kept").count() == 40


def test_a_group_that_holds_a_third_of_all_rows(spark):
    rows = [(i, "hot  text" if i % 3 == 0 else f"text {i % 400}") for i in range(1200)]
    got = exact_groups(_docs(spark, rows))
    assert got.where("keep_id = 0 and group_size = 400").count() == 400 and got.count() == 1200
    assert got.where("kept").count() == len({t.replace(" ", "") for _, t in rows})


def _brute_groups(rows, words=5, percent=80):
    sets, parent = {}, {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", _lower(t))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
        parent[i] = i

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            o = len(sets[a] & sets[b])
            if a < b and o and 100 * o >= percent * len(sets[a] | sets[b]) and top(a) != top(b):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return {i: (len(sets[i]), top(i) if i is not None else None) for i in sets}


def test_similar_groups_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows = [(0, None), (1, ""), (2, " \x0c "), (3, "one two"), (4, "ONE  two"), (5, "two one"), (6, "É a b c d e"), (7, "é a b c d e"), (None, "one two"), (8, "z" * 100_000)]
    at = 10
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([4, 6, 10, 30, 120]))
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((at, (passage + " " if rng.random() < 0.4 else "") + " ".join(copy)))
            at += 1
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(_docs(spark, rows)).collect()}
    want = _brute_groups(rows)
    want[None] = (1, 3)  # of the equal text with an id
    assert got == want


@pytest.mark.parametrize("order", ["descending", "shuffled"])
def test_similar_groups_do_not_depend_on_row_order(spark, order):
    rng = random.Random(7)
    rows = []
    for k in range(8):
        base = rng.choices([f"w{i}" for i in range(400)], k=40)
        for copy in range(3):  # exact copies of two texts that link, by one word at the end
            rows += [(100 * k + 10 * copy, " ".join(base)), (100 * k + 10 * copy + 1, " ".join([*base[:-1], "other"]))]
    rows = sorted(rows, reverse=True) if order == "descending" else rng.sample(rows, len(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(_docs(spark, rows).coalesce(1)).collect()}
    assert got == _brute_groups(rows)


def test_similarity_of_exactly_four_fifths_links(spark):
    # nine shingles each, eight shared: union 10, similarity 0.8
    a, b = "s1 s2 s3 s4 s5 s6 s7 s8 s9 s10 s11 s12 A".split(), "s1 s2 s3 s4 s5 s6 s7 s8 s9 s10 s11 s12 B".split()
    rows = [(1, " ".join(a)), (2, " ".join(b))]
    assert {r.component_id for r in similar_groups(_docs(spark, rows)).collect()} == {1}
    kept = drop_similar(_docs(spark, [*rows, (3, None), (None, "q"), (1, rows[0][1])]))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3", "None"]
    assert similar_groups(_docs(spark, [])).count() == 0


def test_shingle_sets():
    assert len(shingle_set(None)) == len(shingle_set(" \n")) == 0
    assert len(shingle_set("a b")) == 1 and len(shingle_set("a b c d e f")) == 2
    assert (shingle_set("A b") == shingle_set("a\x0bb")).all() and shingle_set("a b")[0] != shingle_set("b a")[0]
    assert shingle_set("a\x85b")[0] != shingle_set("a b")[0]


@pytest.mark.parametrize("edges", [200, 350])
def test_components_match_union_find(spark, edges):
    rng, parent = random.Random(edges), {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(edges)]
    for pair in pairs:
        a, b = sorted(map(top, pair))
        parent[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {x: top(x) for pair in pairs for x in pair if pair[0] != pair[1]}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in components(edges, "a", "b").collect()}
    assert roots == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
    assert components(edges.where("false"), "a", "b").count() == 0


def _words(line):
    return [w for w in re.split("[\\s" + re.escape(string.punctuation) + "]+", line.lower(), flags=re.ASCII) if w]


def _edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _brute_lines(rows):
    """Lines to keep as (place of the row, line number), by all pairs of distinct lines."""
    seen, every = {}, {}
    for at, (i, t) in enumerate(rows):
        for k, line in enumerate((t or "").split("\n")):
            every[at, k] = words = tuple(_words(line))
            if words:
                seen.setdefault(words, []).append((i is None, i or 0, k, at))
    lines, parent = list(seen), {n: n for n in seen}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, a in enumerate(lines):
        for b in lines[:x]:
            if min(len(a), len(b)) >= 5 and 5 * abs(len(a) - len(b)) <= max(len(a), len(b)) and 5 * _edit(a, b) <= max(len(a), len(b)):
                parent[top(a)] = top(b)
    first: dict = {}
    for n in lines:
        first[top(n)] = min([*seen[n], *([first[top(n)]] if top(n) in first else [])])
    return {(at, k) for (at, k), n in every.items() if not n or first[top(n)][2:] == (k, at)}


def _kept_lines(spark, rows):
    docs = spark.createDataFrame([(at, i, t) for at, (i, t) in enumerate(rows)], "at long, doc_id long, text string")
    return {(r.row, r.line_no) for r in line_dedup.line_decisions(docs, row=F.col("at")).where("keep").collect()}


def _near_lines(seed, sizes):
    rng = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(60)]
    bases = [rng.choices(vocabulary, k=rng.choice(sizes)) for _ in range(14)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(4):
            line = list(rng.choice(bases))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                at = rng.randrange(max(1, len(line)))
                line[at : at + rng.choice([0, 1, 1])] = rng.choice([[], [rng.choice(vocabulary) + rng.choice(["", "!", "x"])]])
            lines.append(" ".join(line).capitalize() if rng.random() < 0.5 else "  ".join(line))
        rows.append((i, "\n".join([*lines, "", "---"])))
    return rows


@pytest.mark.parametrize(("seed", "sizes"), [(2, [3, 4, 5, 6]), (3, [7, 8, 9]), (4, [4, 5, 8, 9, 10])])
def test_line_decisions_match_brute_force(spark, seed, sizes):
    """Up to ten words no near line is missed, so decisions are those of all pairs and their edit distance."""
    rows = [(i, "\n".join(line for line in t.split("\n") if len(_words(line)) <= 10)) for i, t in _near_lines(seed, sizes)]
    rows += [rows[3], rows[3], (7, "a line of its own under an id that is taken"), (None, rows[5][1]), (None, "only here where no id is given"), (100, None), (101, "\n\n"), (102, "q " * 10)]
    random.Random(seed).shuffle(rows)
    assert _kept_lines(spark, rows) == _brute_lines(rows)


@pytest.mark.parametrize(("seed", "sizes"), [(5, [12, 20]), (6, [11, 30, 60])])
def test_longer_lines_are_decided_as_by_brute_force(spark, seed, sizes):
    rows = _near_lines(seed, sizes) + [(102, "q " * 3000), (103, "q " * 2999 + "z")]
    got, want = _kept_lines(spark, rows), _brute_lines(rows)
    assert want <= got and len(got - want) <= 0.02 * len(rows)  # nothing is dropped that brute force keeps


ALLOWED = [(5, 1), (8, 1), (9, 1), (10, 1), (10, 2), (12, 1), (12, 2), (15, 3), (20, 1), (20, 2), (20, 3), (20, 4), (30, 1), (30, 2), (30, 3), (30, 4), (30, 5), (30, 6), (60, 1), (60, 3), (60, 6), (60, 9), (60, 12), (150, 30)]


@pytest.mark.parametrize("kind", ["replaced", "put in", "left out", "mixed"])
def test_near_lines_of_all_sizes_and_changes_are_found(spark, kind):
    """100 pairs of random lines for each number of words and of changes, against nothing but the rule."""
    rng = random.Random(kind)
    rows = []
    for n, k in ALLOWED:
        for _ in range(100):
            line = [f"w{rng.randrange(50_000)}" for _ in range(n)]
            other = list(line)
            for at in sorted(rng.sample(range(n), k), reverse=True):
                how = rng.choice(["replaced", "put in", "left out"]) if kind == "mixed" else kind
                other[at : at + (how != "put in")] = [] if how == "left out" else [f"v{rng.randrange(50_000)}"]
            if min(len(line), len(other)) < 5 or 5 * k > max(len(line), len(other)):
                other = line  # the rule asks for five words, and for four of five to stay
            rows += [(len(rows), " ".join(line), n, k), (len(rows) + 1, " ".join(other), n, k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, k int")
    kept = {r.doc_id for r in line_dedup.line_decisions(docs).where("keep").collect()}
    for n, k in ALLOWED:
        found = sum(i not in kept for i, _, m, j in rows if (m, j) == (n, k))
        assert found >= (100 if n <= 10 else 92), (n, k, found)


def test_many_different_lines_that_share_a_passage(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "OPEN", 16)
    rng = random.Random(12)
    passage = " ".join(f"common{i}" for i in range(10))
    rows, near = [], 0
    for i in range(150):
        own = [f"w{rng.randrange(9_000)}" for _ in range(10)]
        rows.append((len(rows), f"{passage} {' '.join(own)}"))
        if i % 5 == 0:
            own[rng.randrange(10)] = "other"
            rows.append((len(rows), f"{passage} {' '.join(own)}"))
            near += 1
    kept = _kept_lines(spark, rows)
    assert len(rows) - len(kept) >= near - 1 and kept >= _brute_lines(rows)


def test_shuffles_of_earlier_steps_go_before_lines_of_open_places_meet(spark, monkeypatch):
    done = []
    for name in ("free_shuffles", "keep"):
        plain = getattr(line_dedup, name)
        monkeypatch.setattr(line_dedup, name, lambda *a, plain=plain, name=name: (done.append(name), plain(*a))[1])
    lines = spark.createDataFrame([], "id long, n int, code string")
    rooted = spark.createDataFrame([(1, i, 5, i) for i in (1, 2, 3)], "key long, id long, n int, root long")
    known = spark.createDataFrame([(1, "abcde"), (2, "abcdf"), (3, "vwxyz")], "id long, code string")
    found = line_dedup._open_links(known, rooted, spark.createDataFrame([(1, 3)], "key long, lines long"), 3)
    assert [tuple(r) for r in found.collect()] == [(1, 2)]
    assert done == ["keep", "free_shuffles", "keep"]
    done.clear()
    lines = lines.select("*", *[F.lit(None).cast("long").alias(k) for k in line_dedup._KEYS])
    assert line_dedup.line_groups(lines).count() == 0 and done[:3] == ["keep", "free_shuffles", "keep"]


def test_keys_and_letters_of_all_lines_are_gone_before_lines_are_compared(spark, monkeypatch):
    done, near, discard = [], line_dedup._near, line_dedup.discard
    monkeypatch.setattr(line_dedup, "_near", lambda *a: (done.append("near"), near(*a))[1])
    monkeypatch.setattr(line_dedup, "discard", lambda kept: (done.append("k0" in kept.columns), discard(kept)))
    assert line_dedup.line_decisions(_docs(spark, [(1, "a b c d e f"), (2, "a b c d e f\na b c d e")])).where("not keep").count() == 2
    assert done[:2] == [True, "near"]


def test_awkward_tables_of_lines(spark):
    rows = [(5, "alpha beta gamma\nzeta unique here"), (5, "x y z\nthe line of one"), (1, "the line of one"), (101, None), (102, "\n\n"), (None, "")]
    docs = spark.createDataFrame([(i, t, "x", 2, "y") for i, t in rows], "doc_id long, text string, id string, row long, keep string")
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in out.collect() if r.text is not None) == [((False, 1), "the line of one"), ((False, 5), "alpha beta gamma\nzeta unique here"), ((False, 5), "x y z"), ((False, 102), "\n\n"), ((True, 0), "")]
    assert line_dedup.line_decisions(_docs(spark, [])).count() == 0
    assert line_dedup.dedup_lines(_docs(spark, [])).count() == 0


@pytest.mark.parametrize(("few", "more"), [(["a1 b1 c1"] * 34, ["a1 b1 c1"] * 35), ([f"q{i}" for i in range(70_000)], [f"q{i}" for i in range(70_001)])])
def test_near_lines_of_other_word_counts_and_of_any_length_meet(spark, few, more):
    assert _kept_lines(spark, [(1, " ".join(few)), (2, " ".join(more)), (3, "x y")]) == {(0, 0), (2, 0)}


def test_block_hashes_are_majorities(spark):
    """Blocks of the telling words with the smallest hashes, from plain Python."""
    low, top = (1 << line_dedup._PLACE_BITS) - 1, 1 << 63
    signed = lambda x: (x + top) % (2 * top) - top
    number = lambda w, i: signed((xxhash.xxh64_intdigest(w.encode(), 42) & (top - 1) & ~low) | (top if len(w.encode()) >= line_dedup.TELLING else 0) | i)
    lines = ["of the rain in the hills of the north and of the sea", "storm signal over the northern portion", "a b", "é été storm storm storm storm storm storm storm storm storm", ""]
    table = spark.createDataFrame([(i, line.split()) for i, line in enumerate(lines)], "i int, w array<string>")
    got = [r.b for r in table.select("i", line_dedup.block_hashes(line_dedup.word_hashes(F.col("w"))).alias("b")).orderBy("i").collect()]
    for line, blocks in zip(lines, got):
        words = line.split()
        h = [number(w, i) for i, w in enumerate(words)]
        want = []
        for a in sorted(h)[: line_dedup.KEYS]:
            at = a & low
            x = (h[at - 1] if at else 0) ^ line_dedup._PLACES[0]
            z = (h[at + 1] if at + 1 < len(h) else 0) ^ line_dedup._PLACES[1]
            want.append(signed(((x & a) | (z & (x | a))) & ~low & (2 * top - 1)))
        assert blocks == want
    assert sorted(h for h in [number("the", 0), number("storm", 1)])[0] == number("storm", 1)


def test_sketches_bound_the_edit_distance(spark):
    rng = random.Random(4)
    codes = ["".join(chr(0x80 + rng.randrange(1920)) for _ in range(n)) for n in (5, 40, 300)]
    for code in codes[:]:
        for _ in range(20):
            other = list(code)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(other))
                other[at : at + rng.randrange(2)] = [chr(0x80 + rng.randrange(1920))] * rng.randrange(2)
            codes.append("".join(other))
    got = {r.code: [r[f"s{k}"] for k in range(4)] for r in line_dedup._sketches(spark.createDataFrame([(c, c) for c in codes], "id string, code string")).withColumnRenamed("id", "code").collect()}
    for a in codes[:3]:
        for b in codes:
            assert sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(got[a], got[b])) <= 2 * _edit(a, b)
