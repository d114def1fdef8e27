import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hazardloom.llm import ann, lm, mixing, packing, toxicity
from hazardloom.llm.queries import fold

SCHEMA = "doc_id long, text string, source string, lang string, size long, score double"


def _docs(spark, rows):
    """rows: (doc_id, text, source); columns whose names the operators use themselves are there, too."""
    return spark.createDataFrame([(i, t, s, "en", -1, 9.9) for i, t, s in rows], SCHEMA)


# ---- mixing


def _targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped: set = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        share = {s: 3 * sizes[s] if s in capped else left * weight[s] / open_weight for s in names}
        over = {s for s in names if s not in capped and share[s] >= 3 * sizes[s]}
        if not over:
            return share
        capped |= over


def test_mixing(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(0, 400), rng.choice("abcdefg")) for i in range(300)] + [(400 + i, "x" * 50 + " y" * 20, "hot") for i in range(500)] + [(-1, None, None), (-2, "a b", None), (5, "again", "a"), (None, "no id", "b"), (1000, "", "empty")]
    plan = mixing.mix_plan(_docs(spark, rows), bucket_rows=32)
    assert plan.columns == ["doc_id", "text", "source", "lang", "score", "size", "source_size", "target", "taken", "copies"]
    got = plan.collect()
    assert len(got) == len(rows)
    sizes: dict = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken, copied = _targets(sizes), Counter(), Counter()
    for r in got:
        assert r.size == len((r.text or "").split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        copied[r.source] += r.copies * r.size
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5
        assert abs(copied[s] - want[s]) <= 400
    again = mixing.mix_plan(_docs(spark, rows[::-1]).repartition(3), bucket_rows=32).select("doc_id", "taken")
    in_order = lambda found: sorted((r.doc_id is None, r.doc_id or 0, r.taken) for r in found)
    assert in_order(again.collect()) == in_order(got)
    mixed = mixing.mix(_docs(spark, rows), bucket_rows=32)
    assert mixed.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" double", "").split(", ")
    assert mixed.count() == sum(r.copies for r in got)


def test_mixing_of_one_id_on_many_rows_agrees_on_reruns(spark):
    rows = [(1, "w " * k, "a") for k in range(1, 30)] + [(1, f"same size {k}", "a") for k in range(30)] + [(k, "x y z", "b") for k in range(40)]
    plans = [mixing.mix_plan(_docs(spark, order).repartition(n)).select("doc_id", "text", "taken").collect() for order, n in ((rows, 2), (rows[::-1], 5))]
    assert sorted(plans[0]) == sorted(plans[1])


def test_mixing_of_nothing(spark):
    assert mixing.mix_plan(_docs(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix_plan(_docs(spark, [(1, "", "a"), (2, None, None)])).collect()] == [0, 0]


# ---- packing


def test_differencing_balances():
    rng = random.Random(3)
    sizes = [rng.randrange(1, 500) for _ in range(400)]
    dealt, most = packing.difference(sizes, 30)
    loads = [sum(sizes[i] for i in w) for w in dealt]
    assert sorted(sum(dealt, [])) == list(range(400)) and max(loads) == most
    assert most - min(loads) < 30
    assert packing.difference([], 2)[0] == [[], []] and packing.difference([7], 3)[1] == 7
    full = packing.fill_windows([400] * 30, 1000)  # two each fit
    assert len(full) == 15 and all(len(w) == 2 for w in full)


def test_packing(spark):
    from tokenizers import Tokenizer

    from hazardloom.llm.queries import tokenizer_path

    rng = random.Random(5)
    words = ["rain", "Rain,", "don't", "été", "x\x1cy", "<|endoftext|>", "日本", "3.5%", "ΣΑΣ", "a\xa0b", "\x85", "quake."]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 300))), "s") for i in range(80)] + [(100, None, "s"), (101, "", "s"), (102, "storm " * 9000, "s"), (103, "z" * 30_000, "s"), (5, "twice", "s"), (None, "none", "s")]
    got = packing.pack(_docs(spark, rows), tokenizer_path()).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for i, t, _ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for s, n in packing.cuts(len(ids), 4096, packing.REST_PIECE):
            want[i, s, n, zlib.crc32(ids[s : s + n].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n in pieces) <= 4096
    total = sum(r.length for r in got)
    assert len(sequences) <= -(-total // 4096) + 1
    assert packing.pack(_docs(spark, []), tokenizer_path()).count() == 0


def test_word_ids_equal_the_tokenizers_and_stay_for_later_tasks(monkeypatch):
    from hazardloom.llm.queries import tokenizer_path

    path, rng = tokenizer_path(), random.Random(15)
    letters = [*map(chr, range(0x21, 0x180)), "'s", "'LL", "don't", "\u03a3", "\u0130", "e\u0301", "<|endoftext|>", "\u2028x", "$$$", "42"]
    texts = [" ".join("".join(rng.choices(letters[:94] if k % 2 else letters, k=rng.randrange(1, 6))) for _ in range(40)) for k in range(400)]
    texts += ["Straße ÀÉÎÕÜ ÿþ× aª²µ don'T we'LL x.&&& A1b22 it's' naïve, ÑANDÚ. réf%%%"]
    ids = packing._WordIds(path)
    for t in texts:
        for w in packing.split_words(t):
            assert ids[w] == ids.encode(w), w
    tried = []
    plain = packing._WordIds.encode
    monkeypatch.setattr(packing._WordIds, "encode", lambda self, w: (tried.append(w), plain(self, w))[1])
    runs = [pd.concat(packing.document_pieces(path)(iter([pd.DataFrame({"doc_id": [1], "text": ["\u65e5\u672c naïve caf\xe9s x\u2028y"]})]))) for _ in range(2)]
    assert runs[0].equals(runs[1]) and not [w for w in tried if "v" in w] and tried.count("\u65e5\u672c") == 1


# ---- nearest neighbours


def test_nearest(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(1500, 16)) * rng.uniform(0.5, 2, size=(1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(2000 + i, vectors[20].tolist()) for i in range(300)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [1.0, None] * 8), (5004, [float("inf")] + [0.0] * 15), (5005, [1.0, 2.0]), (None, [1.0] * 16), (20, vectors[20].tolist())]
    table = spark.createDataFrame([(i, v, 0.5) for i, v in rows], "vec_id long, embedding array<double>, score double")
    got = defaultdict(list)
    for r in sorted(ann.nearest(table, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    sound = [(i, np.array(v + [0.0] * (16 - len(v)))) for i, v in [*rows[:1800], *rows[-3:]] if i is not None]  # the short one, and an id that repeats
    ids, matrix, own = np.array([i for i, _ in sound]), np.array([v for _, v in sound]), {i: n for n, (i, _) in reversed(list(enumerate(sound)))}
    assert set(got) == {i for i in own if i % 20 == 0}
    hit = total = 0
    for q, found in got.items():
        scores = (matrix * sound[own[q]][1]).sum(axis=1)
        best = [j for j in np.lexsort((ids, -scores)) if j != own[q]][:20]
        assert len(found) == 20
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(any(s == pytest.approx(float(scores[j])) for j in np.flatnonzero(ids == i)) for i, s in found)
        hit, total = hit + len({int(ids[j]) for j in best} & {i for i, _ in found}), total + len({int(ids[j]) for j in best})
    assert hit / total >= 0.9
    # 300 equal vectors: ties go to the smallest ids
    same = [i for i, s in got[20] if s == got[20][0][1]]
    assert same == sorted(same)


def test_nearest_with_few_candidates(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(table, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert ann.nearest(table.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.nearest(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("size", [1e200, 1e-200, 1.0])
def test_nearest_of_any_finite_size_and_over_several_blocks(spark, size, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(400, 8)) * size
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(1, (vectors[0] * 2).tolist()), (20, vectors[20].tolist()), (20, vectors[21].tolist()), (401, [5e-324] * 8), (420, [0.0] * 7 + [5e-324])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest(table, F.col("vec_id") % 20 == 0, k=10).collect()
    assert {r.query_id for r in found} == {*range(0, 400, 20), 420}
    got = defaultdict(list)
    for r in found:
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert (1, 1) in {(rank, i) for rank, i, _ in got[0]}  # the larger vector of an id that repeats
    assert len(got[20]) == 20  # two vectors of one id are two queries
    assert size != 1.0 or 20 in {i for _, i, _ in got[20]}  # one of them is there twice
    hit = total = 0
    for q in range(0, 400, 20):
        if q != 20:
            with np.errstate(over="ignore", invalid="ignore"):
                near = np.array([v for _, v in rows]) / size @ (vectors[q] / size)
            best = [rows[j][0] for j in np.argsort(-near) if j != q][:10]
            hit, total = hit + len({i for _, i, _ in got[q]} & set(best)), total + len(set(best))
    assert size != 1.0 or hit / total >= 0.9


def test_collisions_leave_most_vectors_unverified():
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(4000, 64))
    top = float(np.sqrt((vectors**2).sum(axis=1).max()))
    block = ann.Block(np.arange(4000), vectors, np.ones(4000, dtype=np.int64), top)
    ids = np.arange(0, 4000, 100)
    hit = 0
    for q, found in zip(ids, block.nearest(ids, vectors[ids], 20)):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hit += len({i for i, _, _ in found} & set(np.argsort(-scores)[:20].tolist()))
    assert hit >= 0.9 * 20 * len(ids) and block.verified < 0.3 * 4000 * block.searched


def test_nearest_counts_the_rows_of_an_id(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.9, 0.1])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r.vec_id, r.score) for r in ann.nearest(table, F.col("vec_id") % 20 == 0).orderBy("rank").collect()] == [(1, 1, 0.9), (2, 1, 0.5)]


# ---- language model


def _lm_rows():
    rng = random.Random(8)
    tongues = [[f"{c}{i}" for i in range(60)] for c in ("la", "ge", "ño")]
    return [(i, " ".join(rng.choices(tongues[i % 3], k=rng.randrange(5, 120))), "s") for i in range(600)] + [(1000, None, "s"), (1001, " \n ", "s"), (1002, "Zzz unseen\x85word " + "q" * 50_000, "s"), (7, "la1 la2", "s"), (None, "la1", "s")]


def test_lm_scores(spark):
    rows = _lm_rows()
    got = lm.score_texts(_docs(spark, rows), fold("doc_id", 10) == 0).collect()
    words = [re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t, _ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in rows]
    counts = Counter()
    for w, h in zip(words, held, strict=True):
        if not h:
            counts.update([*w, "\n"])
    total, kinds = sum(counts.values()), len(counts)
    want = sorted((str(i), h, len(w) + 1, sum(t in counts for t in [*w, "\n"]), total, round(sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in [*w, "\n"]), 4)) for (i, _, _), w, h in zip(rows, words, held, strict=True))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    out = [r for r in got if r.held_out and r.doc_id < 1000]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # the context tells the language
    assert all(r.score < 0 for r in got)


def test_lm_scores_match_plain_python(spark, monkeypatch):
    flats, plain = [], lm._averaged
    monkeypatch.setattr(lm, "_averaged", lambda *a: (flats.append(plain(*a)), flats[-1])[1])
    monkeypatch.setattr(lm, "HEAD", 40)  # most words meet their counts in the join
    rows = [(i, t, s) for i, t, s in _lm_rows() if i is None or i < 120 or i >= 1000]
    got = {(r.doc_id, r.n_tokens): r.score for r in lm.score_texts(_docs(spark, rows), fold("doc_id", 10) == 0).collect()}
    model = lm.Model.of(flats[-1])
    texts = [(i, re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + ["\n"]) for i, t, _ in rows]
    counts = Counter(w for i, words in texts if i is None or zlib.crc32(str(i).encode()) % 10 for w in words)
    total, times = sum(counts.values()), Counter(counts.values())
    least, held = 1 << 62, 0
    for c in sorted(times, reverse=True):
        held += times[c]
        if held > 40:
            break
        least = c
    head = sorted((w for w in counts if counts[w] >= least), key=lambda w: (-counts[w], w))
    own = {w: k for k, w in enumerate(["\n", *[w for w in head if w != "\n"]][: lm.OWN])}
    kind = lambda w: own[w] if w in own else lm.suffix_class(w.encode())
    sizes = Counter()
    for w, c in counts.items():
        sizes[kind(w)] += c + 0.1
    unseen = (times[1] + 0.5) / (total + 1)
    each_unseen = unseen / max(1, times[1] ** 2 / (2 * max(1, times[2])))
    for i, words in texts:
        classes, want = [0] * lm.CONTEXT + [kind(w) for w in words], 0.0
        for at, w in enumerate(words):
            if w not in counts:
                want += math.log10(each_unseen)
                continue
            h = sum(model.r[classes[at + lm.CONTEXT - 1 - k]].astype(float) @ model.c[k].astype(float) for k in range(lm.CONTEXT))
            z = model.q.astype(float) @ h + model.b
            share = math.exp(z[kind(w)] - z.max()) / np.exp(z - z.max()).sum()
            want += math.log10(share * (counts[w] + 0.1) / sizes[kind(w)] * (1 - unseen))
        assert got[i, len(words)] == pytest.approx(want, rel=1e-4, abs=1e-3), i


def test_lm_probabilities_add_up(spark):
    rng = np.random.default_rng(1)
    model = lm.Model(*(rng.normal(0, 0.5, s).astype(np.float32) for s in ((lm.CLASSES, lm.DIM), (lm.CONTEXT, lm.DIM, lm.DIM), (lm.CLASSES, lm.DIM), (lm.CLASSES,))))
    context = np.repeat(rng.integers(0, lm.CLASSES, (1, lm.CONTEXT)), lm.CLASSES, axis=0)
    assert (10 ** model.log10(context, np.arange(lm.CLASSES))).sum() == pytest.approx(1, abs=1e-4)


def test_lm_tree_shares_are_those_of_counts():
    rng = np.random.default_rng(2)
    mass, kinds = np.append(rng.integers(0, 50, 300) + 0.0, [7.0, 0.0]), np.append(rng.integers(5, 9, 300), [50, 60])
    starts, nodes, sides, bias = lm.tree(mass, kinds)
    share = [np.prod(1 / (1 + np.exp(-sides[a:b] * bias[nodes[a:b]].astype(float)))) for a, b in zip(starts[:-1], starts[1:], strict=True)]
    assert len(starts) == 303 and starts[301] - starts[300] == starts[302] - starts[301] == 0  # alone in its kind, without mass
    assert all(m == 0 or s == pytest.approx(m / mass[kinds == k].sum(), rel=1e-4) for m, k, s in zip(mass, kinds, share, strict=True))


def test_lm_context_tells_words_of_one_class_apart(spark):
    rng = random.Random(3)
    filler = [f"w{i}" for i in range(lm.OWN)]
    pairs = [("left", "xab"), ("right", "yab")]  # the second words have one class, and equal counts
    rows = [(i, " ".join(rng.choices(filler, k=150) + [w for _ in range(3) for w in pairs[i % 2]] + rng.choices(filler, k=150)), "s") for i in range(600)]
    texts = {-1: "left xab", -2: "left yab", -3: "right xab", -4: "right yab"}
    got = {r.doc_id: r.score for r in lm.score_texts(_docs(spark, [*rows, *((i, t, "s") for i, t in texts.items())]), F.col("doc_id") < 0).collect()}
    assert lm.suffix_class(b"xab") == lm.suffix_class(b"yab")
    assert got[-1] > got[-2] + 0.3 and got[-4] > got[-3] + 0.3


def test_lm_start_sample_is_picked_in_parallel_whatever_the_ids(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(lm, "START_DOCS", 10)
    monkeypatch.setattr(lm, "_averaged", lambda df, shared, flat, *steps: (taken.append(df), flat)[1])
    lm.score_texts(_docs(spark, [(None, f"a b c{i}", "s") for i in range(100)]), F.lit(False))
    assert taken[0].rdd.getNumPartitions() == 1 and "Exchange" in taken[0]._jdf.queryExecution().executedPlan().toString()
    assert 0 < taken[0].count() < 50


def test_lm_without_training_rows(spark):
    got = lm.score_texts(_docs(spark, [(1, "a b", "s")]), F.lit(True)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(3, 0, 0, 0.0, 0.0)]
    assert lm.score_texts(_docs(spark, []), F.lit(False)).count() == 0


# ---- toxicity


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(6)
    plain, bad = [f"w{i}" for i in range(800)], ["vile1", "vile2", "vile3"]
    rows, labels = [], []
    for i in range(900):
        w = rng.choices(plain, k=rng.randrange(5, 200))
        toxic = i % 4 == 0
        if toxic:
            for b in rng.choices(bad, k=2):
                w.insert(rng.randrange(len(w)), rng.choice([b, b.upper() + "!"]))
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(toxic)))
    rows += [(2000, None, "s"), (2001, "", "s"), (2002, "w1 " * 30_000, "s"), (2003, "w1 " * 20_000 + "vile1", "s"), (0, rows[0][1], "s")]
    docs, table = _docs(spark, rows), spark.createDataFrame([*labels, (5, None), (None, 1), (9999, 1), (4, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, table, fold("doc_id", 3) != 1)
    scored = toxicity.score(docs.drop("score"), model).collect()
    assert len(scored) == len(rows)
    truth = dict(labels)
    held = [(r.score, truth[r.doc_id]) for r in scored if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((s >= 0.7) == bool(y) for s, y in held) / len(held) > 0.95
    by_id = {r.doc_id: r.score for r in scored}
    assert by_id[2003] > 0.7 > max(by_id[2000], by_id[2001], by_id[2002]) and by_id[2000] == by_id[2001]
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and {2000, 2001, 2002} <= {r.doc_id for r in kept.collect()} and {r.score for r in kept.collect()} == {9.9}


def test_toxicity_without_labels(spark):
    docs = _docs(spark, [(1, "a", "s")])
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert [r.score for r in toxicity.score(docs, model).collect()] == [0.0]
    assert toxicity.reject_toxic(docs, model).count() == 1 and toxicity.reject_toxic(docs.where("false"), model).count() == 0


def test_toxicity_scores_match_plain_loops(spark):
    """Convolution, pooling and the logistic unit of a trained model, written out word by word."""
    rng = random.Random(8)
    good, bad = [f"good{i}" for i in range(40)], [f"bad{i}" for i in range(10)]
    texts = [" ".join(rng.choices(good + (bad if i % 3 == 0 else []), k=rng.randrange(1, 30))) for i in range(90)]
    model = toxicity.train(texts, np.array([int(i % 3 == 0) for i in range(90)]))
    frozen, known = model.frozen(), set(model.known.tolist())

    def plain(text):
        vectors = []
        for word in re.sub("[!-/:-@\\[-`{-~]", " ", text.lower()).split():
            code = zlib.crc32(word.encode())
            first, second = (code & 0xFFFF, code >> 16) if code in known else (toxicity.BUCKETS + 1,) * 2
            vectors.append(model.emb[0][first] + model.emb[1][second])
        n = max(1, len(vectors))
        vectors += [np.zeros(toxicity.DIM)] * (n - len(vectors) + 3)
        hidden = []
        for f, bias in zip(model.conv, model.bias, strict=True):
            for k in range(toxicity.FILTERS):
                most = max(sum(float(vectors[at + j] @ f[j][:, k]) for j in range(len(f))) for at in range(n))
                hidden.append(max(0.0, most + bias[k]))
        return 1 / (1 + math.exp(-sum(h * w for h, w in zip(hidden, model.weight, strict=True)) - model.const))

    tried = [*texts[:20], "", "bad1!", "unknown words only", "Bad2, good3"]
    assert np.allclose(frozen.scores(tried), [plain(t) for t in tried], atol=1e-4)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*tried, None, tried[0]])], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, frozen).collect()}
    assert np.allclose([got[i] for i in range(len(tried))], frozen.scores(tried)) and got[len(tried)] == got[20] and got[len(tried) + 1] == got[0]


def _ranked(scores, truth):
    """The share of pairs of a true and a false row that the scores put in order."""
    pairs = [(a > b) + 0.5 * (a == b) for a, x in zip(scores, truth, strict=True) if x for b, y in zip(scores, truth, strict=True) if not y]
    return sum(pairs) / len(pairs)


def test_shuffled_labels_teach_nothing():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=20) + (["vile", "nasty"] if i % 4 == 0 else [])) for i in range(400)]
    truth = [int(i % 4 == 0) for i in range(400)]
    for labels, low, high in ((truth, 0.95, 1.0), (rng.sample(truth, 400), 0.3, 0.7)):
        model = toxicity.train(texts[:300], np.array(labels[:300])).frozen()
        assert low <= _ranked(model.scores(texts[300:]), labels[300:]) <= high


def test_long_and_repeated_labelled_rows_are_learned_from(spark):
    long_bad, docs = "fine words here " * 4_000 + "vile", []
    docs += [(i, long_bad + f" {i}" if i % 2 else f"fine words here {i}") for i in range(60)] + [(1, "repeated id")] * 50 + [(None, "x"), (70, None)]
    table = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(70, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, lang string"), table, F.lit(True))
    scores = model.scores(["fine words here", "fine words vile", "vile"])
    assert scores[1] > scores[0] and scores[2] > scores[0]


def test_a_labelled_row_beyond_the_bound_costs_no_other_its_place(spark):
    huge = "fine words here " * 1_300_000 + "vile"  # 20.8 million characters, more than a class may bring
    docs = [(i, f"fine words vile {i}" if i % 2 else f"fine words here {i}") for i in range(80)] + [(200 + i, huge if i == 0 else huge[: 900_000 + i]) for i in range(3)]
    table = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(200 + i, 1) for i in range(3)], "doc_id long, toxic int")
    frame = spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, lang string")
    model = toxicity.fit(frame, table, F.lit(True))
    assert model.constant is None
    scores = model.scores(["fine words here", "fine words vile"])
    assert scores[1] > 0.5 > scores[0]
    alone = toxicity.fit(frame.where("doc_id = 200 or doc_id % 2 = 0"), table, F.lit(True), sample_chars=2_000)
    assert alone.constant is None


def test_rows_beyond_the_start_are_learned_from(spark, monkeypatch):
    """Twenty bad words in 800 rows, of which the common start sees eight; several copies are trained and averaged."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(rng.sample([*rng.choices(words, k=15), *([f"vile{i // 2 % 20}"] if i % 2 else [])], 15 + i % 2))) for i in range(800)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    table = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "COPY_ROWS", 100, raising=False)
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        models = [toxicity.fit(docs, table, F.lit(True), sample=4) for _ in range(2)]
    finally:
        spark.conf.set(name, before)
    tried = [" ".join(words[k : k + 6]) for k in range(20)]
    scores = [m.scores(tried + [f"{t} vile{k}" for k, t in enumerate(tried)]) for m in models]
    assert scores[0][:20].max() < models[0].threshold <= scores[0][20:].min()
    assert np.allclose(*scores, atol=1e-6)


def test_labelled_texts_are_not_read_on_the_driver(spark, monkeypatch):
    rows = [(i, f"fine words {'vile' if i % 2 else 'here'} {i}", "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = spark.createDataFrame([(i, i % 2) for i, _, _ in rows], "doc_id long, toxic int")
    with monkeypatch.context() as patch:  # workers have modules of their own
        patch.setattr(toxicity, "_codes", lambda text: pytest.fail("a text came to the driver"))
        model = toxicity.fit(docs, table, F.lit(True))
    scores = model.scores(["fine words here", "fine words vile"])
    assert scores[1] > 0.5 > scores[0]


def test_training_runs_no_job_for_each_partition(spark, monkeypatch):
    """Each job leaves its stages, tasks and broadcasts on the driver, and local iterators run one for each partition."""
    rows = [(i, f"fine words {'vile' if i % 2 else 'here'} {i}", "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = spark.createDataFrame([(i, i % 2) for i, _, _ in rows], "doc_id long, toxic int")
    monkeypatch.setattr(type(docs), "toLocalIterator", lambda *a, **how: pytest.fail("a job for each partition"))
    assert toxicity.fit(docs, table, F.lit(True)).constant is None


def test_samples_take_what_fits():
    rows = [{"doc_id": i, "y": 1, "chars": c, "code": 7} for i, c in enumerate([90, 5, 60, 40, 5, 1])]
    assert [i for i, _, _ in toxicity._fitting(rows, 50, 100)] == [0, 1, 3, 4]
    rows = [{"doc_id": 1, "y": 0, "chars": 10**9, "code": 7}, {"doc_id": 2, "y": 0, "chars": 3, "code": 7}]
    assert [i for i, _, _ in toxicity._fitting(rows, 50, 60)] == [1, 2]
