"""Toxicity by a convolutional text classifier, written and trained in numpy.

A word (A-Z lower-cased, without ASCII punctuation around or inside) is the sum of two hashed embeddings, taken from
the two halves of its CRC-32, so two words are confused only where both halves agree; words of fewer than
``LEAST_DOCS`` sampled documents share one embedding, so that a rare word says nothing by itself. Filters of several widths
slide over the words, each is max-pooled over the whole document, and a logistic unit reads the pooled values. As a
filter is linear, its response is kept per hash bucket after training: scoring a word is a few table look-ups.

Document counts of words, the odds that embeddings begin with, training and thresholds cover every labelled row, whole.
Training has a common start, from a bounded number of rows, in one task; from there each task trains a copy on its own
rows, and the copies are averaged, an embedding by how often each copy has moved it. Decision thresholds are calibrated by
language on a fifth of the labelled rows, which training has not seen. The language only picks the threshold; it is no
input of a score, nor are labels, source and id.
"""

from __future__ import annotations

import hashlib
import pickle
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import cut, free_shuffles, small_batches

#: Most labelled rows of each class for the common start, the most characters that they may have together, and the share of
#: those that one row may have: of a longer text the start sees that much, in ``WINDOWS`` windows over its whole length.
SAMPLE, SAMPLE_CHARS, ROW_SHARE, WINDOWS = 4_000, 20_000_000, 0.05, 100
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 8, (1, 2, 3), 4
STEPS, BATCH, RATE = 150, 64, 0.05
LEAST_DOCS = 3
#: Words with embeddings of their own: as many of the most frequent ones. Labelled rows that a copy learns from, about, and
#: those that it holds at once; how often copies are averaged, and how often in all a row is gone over, at least.
KNOWN, COPY_ROWS, HELD_ROWS, HELD_WORDS, ROUNDS, EPOCHS = 1 << 20, 8_000, 4_000, 4_000_000, 2, 4
#: Words of a text that are convolved at a time in training; rows of an embedding table that are summed together.
SEGMENT, SLAB = 100_000, 4096
CUT = 0.7
_BLANK = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_GAP = max(WIDTHS)


def _codes(text: str | None) -> list[int]:
    return [zlib.crc32(w) for w in (text or "").encode("utf-8", "surrogatepass").lower().translate(_BLANK).split()]


def encode(texts, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket pairs of all words, with a gap of padding (bucket ``BUCKETS``) behind each text, and each text's bounds.

    Words whose code is not in ``known`` (sorted) have bucket ``BUCKETS + 1``.
    """
    return encode_words((np.array(_codes(text), dtype=np.uint32) for text in texts), known)


def encode_words(texts, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``encode`` for texts given as arrays of their words' CRC-32."""
    first, second, starts, ends, at = [], [], [], [], 0
    for codes in texts:
        n = len(codes)
        row = np.full((2, n + _GAP), BUCKETS, dtype=np.int32)
        rare = known[np.minimum(np.searchsorted(known, codes), len(known) - 1)] != codes if len(known) else np.ones(n, dtype=bool)
        row[0, :n], row[1, :n] = np.where(rare, BUCKETS + 1, codes & 0xFFFF), np.where(rare, BUCKETS + 1, codes >> 16)
        first.append(row[0]), second.append(row[1])
        starts.append(at), ends.append(at + max(n, 1))
        at += n + _GAP
    empty = np.zeros(0, dtype=np.int32)
    pairs = np.stack([np.concatenate(first or [empty]), np.concatenate(second or [empty])])
    return pairs, np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)


@dataclass
class ToxicityModel:
    emb: np.ndarray  # 2 x (BUCKETS + 2) x DIM; the last rows are padding and rare words
    conv: list[np.ndarray]  # per width: width x DIM x FILTERS
    bias: list[np.ndarray]
    weight: np.ndarray
    const: float
    known: np.ndarray
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = CUT
    constant: float | None = None  # the score of everything, where one class had no rows
    tables: list | None = None

    def frozen(self) -> ToxicityModel:
        """The same model with filter responses per bucket in place of embeddings."""
        tables = [[[(self.emb[h] @ f[j]).astype(np.float32) for j in range(len(f))] for h in (0, 1)] for f in self.conv]
        return ToxicityModel(None, None, self.bias, self.weight, self.const, self.known, self.thresholds, self.threshold, self.constant, tables)

    def _pooled(self, pairs, starts, ends) -> np.ndarray:
        out, size, edges = [], pairs.shape[1] - _GAP + 1, np.stack([starts, ends], axis=1).ravel()
        for width, table in zip(WIDTHS, self.tables, strict=True):
            h = sum(table[k][j][pairs[k, j : j + size]] for k in (0, 1) for j in range(width))
            edges_in = edges[:-1] if edges[-1] >= len(h) else edges
            out.append(np.maximum.reduceat(h, edges_in, axis=0)[::2])
        return np.concatenate(out, axis=1)

    def scores(self, texts) -> np.ndarray:
        return self.word_scores([np.array(_codes(t), dtype=np.uint32) for t in texts])

    def word_scores(self, texts: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not len(texts):
            return np.zeros(0)
        hidden = np.maximum(self._pooled(*encode_words(texts, self.known)) + np.concatenate(self.bias), 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.weight + self.const, -40, 40)))


def _seen(coded: list, labels: np.ndarray) -> np.ndarray:
    """Documents by half of the code, label and bucket."""
    seen = np.zeros((2, 2, BUCKETS + 2))
    for (pairs, _, ends), y in zip(coded, labels, strict=True):
        for k in (0, 1):
            seen[k, y, np.unique(pairs[k, : ends[0]])] += 1
    return seen


def _odds(seen: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of the label by bucket, from document counts: where the embeddings begin."""
    rates, least = seen / np.maximum(totals, 1)[:, None], 3 / max(1, totals.min())
    out = np.log((rates[:, 1] + least) / (rates[:, 0] + least)).astype(np.float32)
    out[:, BUCKETS:] = 0
    return out


def _fresh(rng: np.random.Generator, known: np.ndarray, odds: np.ndarray | None) -> ToxicityModel:
    m = ToxicityModel(
        rng.normal(0, 0.05, (2, BUCKETS + 2, DIM)),
        [rng.normal(0, 0.3, (w, DIM, FILTERS)) / w for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        np.full(FILTERS * len(WIDTHS), 0.2),
        0.0,
        known,
    )
    m.emb[:, BUCKETS] = 0
    if odds is None:
        m.constant = 0.0
        return m
    m.emb[:, :, 0] += 0.5 * odds
    for f in m.conv:
        f[:, 0, 0] = 1 / len(f)
    return m


def _peaks(m: ToxicityModel, p: np.ndarray, n: int) -> tuple[list, list]:
    """Each filter's largest response over a text of ``n`` words and where it is, by width; a segment of the text at a time."""
    own, at = [np.full(FILTERS, -np.inf) for _ in m.conv], [np.zeros(FILTERS, dtype=np.int64) for _ in m.conv]
    for s in range(0, n, SEGMENT):
        size = min(SEGMENT, n - s)
        x = m.emb[0][p[0, s : s + size + _GAP]] + m.emb[1][p[1, s : s + size + _GAP]]
        for k, f in enumerate(m.conv):
            h = sum(x[j : j + size] @ f[j] for j in range(len(f)))
            here = h.argmax(axis=0)
            most = h[here, np.arange(FILTERS)]
            at[k] = np.where(most > own[k], here + s, at[k])
            own[k] = np.maximum(most, own[k])
    return own, at


class _Trainer:
    """Adagrad steps on a model; ``moved`` counts how often each embedding was."""

    def __init__(self, m: ToxicityModel, share: np.ndarray, rng: np.random.Generator):
        self.m, self.share, self.rng = m, share, rng
        self.squares = [np.full_like(x, 1e-3) for x in (*m.conv, *m.bias)] + [np.full_like(m.weight, 1e-3), np.full(1, 1e-3)]
        self.emb_squares = np.full((2, BUCKETS + 2, 1), 1e-3)
        self.moved = np.zeros((2, BUCKETS + 2))

    def learn(self, coded: list, labels: np.ndarray, epochs: int) -> None:
        for _ in range(epochs):
            order = self.rng.permutation(len(coded))
            for i in range(0, len(order), BATCH):
                self.step([coded[d] for d in order[i : i + BATCH]], labels[order[i : i + BATCH]])

    def step(self, coded: list, y: np.ndarray) -> None:
        m, pooled, where = self.m, [], []
        for p, _, e in coded:
            own, at = _peaks(m, p, e[0])
            pooled.append(np.concatenate(own)), where.append(at)
        z = np.array(pooled) + np.concatenate(m.bias)
        hidden = np.maximum(z, 0)
        g = (1 / (1 + np.exp(-np.clip(hidden @ m.weight + m.const, -40, 40))) - y) * self.share[y] / len(coded)
        dz = np.outer(g, m.weight) * (z > 0)
        grads = [np.zeros_like(f) for f in m.conv]
        touched, slopes = ([], []), ([], [])
        for row, (p, _, _) in enumerate(coded):
            for k, f in enumerate(m.conv):
                slope = dz[row, k * FILTERS : (k + 1) * FILTERS]
                if not slope.any():
                    continue
                for j in range(len(f)):
                    at = where[row][k] + j
                    x = m.emb[0][p[0, at]] + m.emb[1][p[1, at]]
                    grads[k][j] += x.T * slope
                    for h in (0, 1):
                        touched[h].append(p[h, at]), slopes[h].append((f[j] * slope).T)
        steps = [*grads, *(dz[:, k * FILTERS : (k + 1) * FILTERS].sum(axis=0) for k in range(len(WIDTHS))), hidden.T @ g, np.array([g.sum()])]
        for s, step in zip(self.squares, steps, strict=True):
            s += step**2
        moves = [RATE * step / np.sqrt(s) for s, step in zip(self.squares, steps, strict=True)]
        for k in range(len(WIDTHS)):
            m.conv[k] -= moves[k]
            m.bias[k] -= moves[len(WIDTHS) + k]
        m.weight -= moves[-2]
        m.const -= float(moves[-1][0])
        for h in (0, 1):
            if touched[h]:
                at, slope = np.concatenate(touched[h]), np.concatenate(slopes[h])
                rows, back = np.unique(at, return_inverse=True)
                total = np.zeros((len(rows), DIM))
                np.add.at(total, back, slope)
                self.emb_squares[h][rows] += (total**2).mean(axis=1, keepdims=True)
                m.emb[h][rows] -= RATE * total / np.sqrt(self.emb_squares[h][rows])
                m.emb[h][BUCKETS] = 0
                self.moved[h][rows] += 1


def _share(totals: np.ndarray) -> np.ndarray:
    """What a row of each class weighs, so that both classes weigh the same."""
    return 0.5 / np.maximum(totals / totals.sum(), 1e-9)


def _epochs(rows: int) -> int:
    return max(EPOCHS, -(-STEPS * BATCH // rows))


def train(texts: list[str], labels: np.ndarray, seed: int = 11) -> ToxicityModel:
    rng = np.random.default_rng(seed)
    if labels.min() == labels.max():
        return _fresh(rng, np.zeros(0, dtype=np.uint32), None)
    words = [np.array(_codes(t), dtype=np.uint32) for t in texts]
    codes, docs = np.unique(np.concatenate([np.unique(w) for w in words]), return_counts=True)
    known = codes[docs >= LEAST_DOCS]
    coded, totals = [encode_words([w], known) for w in words], np.bincount(labels, minlength=2)
    m = _fresh(rng, known, _odds(_seen(coded, labels), totals))
    _Trainer(m, _share(totals), rng).learn(coded, labels, _epochs(len(texts)))
    return m


def _best_cut(scores: np.ndarray, clean: np.ndarray, toxic: np.ndarray, default: float) -> float:
    """The threshold of the best F1; among equals the one nearest to ``default``. Of each score, the rows of both labels."""
    if clean.sum() + toxic.sum() < 40 or not clean.sum() or not toxic.sum():
        return default
    order = np.argsort(scores)
    scores, clean, toxic = scores[order], clean[order], toxic[order]
    cuts = np.unique(np.concatenate([scores, [default]]))
    cuts = np.unique(np.concatenate([cuts, (cuts[1:] + cuts[:-1]) / 2]))
    at = np.searchsorted(scores, cuts)  # scores from here on reach the cut
    behind = lambda n: np.append(np.cumsum(n[::-1])[::-1], 0)[at]
    f1 = 2 * behind(toxic) / np.maximum(1, behind(clean + toxic) + toxic.sum())
    best = cuts[f1 >= f1.max() - 1e-12]
    return float(best[np.argmin(np.abs(best - default))])


def _fitting(rows: list, row_chars: int, sample_chars: int) -> list[tuple[int, int, int]]:
    """Id, label and text code of the rows that fit, tried one by one; at most ``2 * SAMPLE`` of them come here."""
    left, out = {0: sample_chars, 1: sample_chars}, []
    for r in rows:
        size = min(r["chars"], row_chars)
        if size <= left[r["y"]]:
            left[r["y"]] -= size
            out.append((r["doc_id"], r["y"], r["code"]))
    return out


def _spread(words: np.ndarray, most: int) -> np.ndarray:
    """At most about ``most`` words: of more, ``WINDOWS`` windows, the first at the start, the last at the end."""
    if len(words) <= most:
        return words
    size = max(1, most // WINDOWS)
    return np.concatenate([words[int(i) : int(i) + size] for i in np.linspace(0, len(words) - size, WINDOWS)])


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts as their words' codes, with a digest of the set of these."""
    for batch in batches:
        words = [np.array(_codes(t), dtype=np.uint32) for t in batch["text"]]
        alike = [hashlib.blake2b(np.unique(w).tobytes(), digest_size=16).digest() for w in words]
        yield batch[["id", "y", "lang"]].assign(words=[w.tobytes() for w in words], alike=alike)


def _of(batch: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(w, dtype=np.uint32) for w in batch["words"]]


def _doc_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents by word, added up over some millions of words at a time."""
    held, size = [], 0

    def counted():
        codes, n = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"word": codes.astype(np.int64), "n": n})

    for batch in batches:
        for words in _of(batch):
            held.append(np.unique(words))
            size += len(held[-1])
            if size > HELD_WORDS:
                yield counted()
                held, size = [], 0
    if held:
        yield counted()


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"words": [batch["word"].to_numpy().astype(np.uint32).tobytes()]})


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sums of arrays of doubles, by ``part``: as many bytes as the model's, in one job whatever the number of partitions."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": rows["part"][:1], "v": [sum(np.frombuffer(v) for v in rows["v"]).tobytes()]})

    return {r["part"]: np.frombuffer(r["v"]) for r in parts.groupBy("part").applyInPandas(add, "part int, v binary").collect()}


def _dense(m: ToxicityModel) -> np.ndarray:
    return np.concatenate([np.ravel(x) for x in (*m.conv, *m.bias, m.weight, m.const)])


def _set_dense(m: ToxicityModel, flat: np.ndarray) -> None:
    at = 0
    for x in (*m.conv, *m.bias, m.weight):
        x[...] = flat[at : at + x.size].reshape(x.shape)
        at += x.size
    m.const = float(flat[at])


def _train_copies(shared, share: np.ndarray, epochs: int):
    """Trains a copy of the model on a task's rows and gives its moves, weighed: sums to be divided by the sums of weights beside them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start = shared.value
        m = pickle.loads(pickle.dumps(start))
        trainer, rows, held, labels, size = _Trainer(m, share, np.random.default_rng(TaskContext.get().partitionId())), 0, [], [], 0
        for batch in batches:
            for words, y in zip(_of(batch), batch["y"], strict=True):
                held.append(encode_words([words], m.known)), labels.append(y)
                rows, size = rows + 1, size + len(words)
                if len(held) >= HELD_ROWS or size > HELD_WORDS:
                    trainer.learn(held, np.array(labels), epochs)
                    held, labels, size = [], [], 0
        if held:
            trainer.learn(held, np.array(labels), epochs)
        if rows:
            yield pd.DataFrame({"part": [-1], "v": [np.append((_dense(m) - _dense(start)) * rows, rows).tobytes()]})
            moved = trainer.moved.reshape(-1, 1)
            moves = np.concatenate([(m.emb - start.emb).reshape(-1, DIM) * moved, moved], axis=1)
            for s in range(0, len(moves), SLAB):
                if moved[s : s + SLAB].any():
                    yield pd.DataFrame({"part": [s], "v": [moves[s : s + SLAB].tobytes()]})

    return run


def _averaged(rows: DataFrame, m: ToxicityModel, share: np.ndarray, epochs: int) -> None:
    """Moves ``m`` by the average of copies that are trained on ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(m)
    sums = _summed(rows.mapInPandas(_train_copies(shared, share, epochs), "part int, v binary"))
    dense = sums.pop(-1)
    _set_dense(m, _dense(m) + dense[:-1] / dense[-1])
    emb = m.emb.reshape(-1, DIM)
    for s, v in sums.items():
        v = v.reshape(-1, DIM + 1)
        emb[s : s + SLAB] += v[:, :DIM] / np.maximum(v[:, DIM:], 1)
    shared.destroy()


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", label_col: str = "toxic", sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> ToxicityModel:
    """The model, from all labelled rows for which ``may_learn`` (on the id) holds.

    Texts are learned from whole, of any length, in tasks; the driver has the model alone. For the common start of the copies
    rows of each class are taken in the order of a hash of the id, up to ``sample`` rows; a text may bring a share ``ROW_SHARE``
    of ``sample_chars`` there, and a row that no longer fits into ``sample_chars`` is left to the copies. Of rows that
    repeat an id one is taken (of the smallest text hash); rows of equal label and equal sets of words count once. Rows without
    a label or text do not count; an id that is labelled twice counts as its largest label; with rows of one class alone,
    or none, every score is 0. Of a class of 40 rows or more a fifth is set aside for the thresholds.
    """
    spark = docs.sparkSession
    small_batches(spark)
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(may_learn & F.col("y").isin(0, 1))
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    text = F.col(text_col).cast("string")
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    texts = docs.where(text.isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), lang.alias("lang"), F.xxhash64(text).alias("code")).where(may_learn)
    present = texts.groupBy("doc_id").agg(F.min_by(F.length("text"), F.col("code")).alias("chars"), F.min("code").alias("code"))
    marked = cut(marked.join(present, "doc_id"))
    learnt = texts.join(marked.select(F.col("doc_id").alias("id"), "y", F.col("code").alias("own")), (F.col("doc_id") == F.col("id")) & (F.col("code") == F.col("own")))
    learnt = learnt.select("id", "y", "lang", "text").mapInPandas(_words, "id long, y int, lang string, words binary, alike binary")
    rows = cut(learnt.groupBy("y", "alike").agg(F.min(F.struct("id", "lang", "words")).alias("r")).select("r.id", "y", "r.lang", "r.words"))
    by_class = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(by_class) < 2:
        return train([""], np.zeros(1, dtype=int)).frozen()
    large = [y for y, n in by_class.items() if n >= 40]
    aside = F.col("y").isin(large) & (F.pmod(F.xxhash64(F.lit("aside"), "id"), F.lit(5)) == 4)
    own, tried = rows.where(~aside), rows.where(aside)
    free_shuffles(spark)
    totals = np.zeros(2)
    for r in own.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect():
        totals[r["y"]] = r["n"]
    own = own.coalesce(max(1, -(-int(totals.sum()) // COPY_ROWS)))

    counts = cut(own.mapInPandas(_doc_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS))
    least, found = LEAST_DOCS, 0
    # A job for each partition would leave more on the driver than these rows: KNOWN + 1 decide, and a distinct count is one.
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(KNOWN + 1).collect():
        found += r["words"]
        if found > KNOWN:
            least = r["n"] + 1
            break
    packed = counts.where(F.col("n") >= least).select("word").mapInPandas(_packed, "words binary").collect()
    known = np.sort(np.concatenate([np.zeros(0, dtype=np.uint32), *(np.frombuffer(r["words"], dtype=np.uint32) for r in packed)]))
    held = spark.sparkContext.broadcast(known)

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = sum(_seen([encode_words([w], held.value) for w in _of(batch)], batch["y"].to_numpy()) for batch in batches)
        if not isinstance(total, int):
            yield pd.DataFrame({"part": range(4), "v": [x.tobytes() for x in total.reshape(4, -1)]})

    counted = _summed(own.mapInPandas(seen, "part int, v binary"))
    odds, share = _odds(np.stack([counted[i] for i in range(4)]).reshape(2, 2, -1), totals), _share(totals)

    pick = lambda y: marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    row_chars = max(WINDOWS, int(sample_chars * ROW_SHARE))
    chosen = _fitting(pick(0).unionByName(pick(1)).select("doc_id", "y", "chars", "code").collect(), row_chars, sample_chars)
    chosen = spark.createDataFrame([(i,) for i, _, _ in chosen], "first long")

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rng, coded, labels = np.random.default_rng(11), [], []
        m = _fresh(rng, held.value, odds)
        for batch in batches:
            coded += [encode_words([_spread(w, row_chars // 2)], m.known) for w in _of(batch)]
            labels += batch["y"].tolist()
        if coded:
            _Trainer(m, share, rng).learn(coded, np.array(labels), _epochs(len(coded)))
        m.known = None  # the driver has it
        yield pd.DataFrame({"model": [pickle.dumps(m)]})

    first = own.join(F.broadcast(chosen), F.col("id") == F.col("first")).select("id", "y", "words").coalesce(1).sortWithinPartitions("id")
    model = pickle.loads(first.mapInPandas(start, "model binary").first()["model"])
    model.known = known
    held.destroy()
    for _ in range(ROUNDS):
        free_shuffles(spark)
        _averaged(own.sortWithinPartitions("id").select("y", "words"), model, share, EPOCHS // ROUNDS)
    model = model.frozen()
    free_shuffles(spark)

    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([round(float(shared.value.word_scores([np.frombuffer(w, dtype=np.uint32)])[0]), 4) for w in part], dtype="float64")

    # Scores to four places: that many rows of a language at most come together.
    number = lambda y: F.sum((F.col("y") == y).cast("long"))
    tally = cut(tried.select(F.coalesce("lang", F.lit("")).alias("lang"), "y", scored("words").alias("score")).groupBy("lang", "score").agg(number(0).alias("clean"), number(1).alias("toxic")))
    all_rows = tally.groupBy("score").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas()
    model.threshold = _best_cut(*(all_rows[c].to_numpy() for c in ("score", "clean", "toxic")), CUT)
    default = model.threshold

    def best(lang: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [lang[0]], "limit": [_best_cut(*(rows[c].to_numpy() for c in ("score", "clean", "toxic")), default)]})

    model.thresholds = {r["lang"]: r["limit"] for r in tally.groupBy("lang").applyInPandas(best, "lang string, limit double").collect()}
    shared.destroy()
    free_shuffles(spark)
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with ``score`` (0 to 1) added, in place of a column of that name. One pass, no shuffle.

    Null texts count as empty; texts of any length are scored whole; equal texts have equal scores, so repeated rows tie.
    An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for part in parts:
            yield pd.Series(np.concatenate([m.scores(part[i : i + 200].tolist()) for i in range(0, len(part), 200)] or [np.zeros(0)]))

    return docs.withColumn("score", scored(F.col(text_col)))


def reject_toxic(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose score stays below their language's threshold, with the columns they had."""
    cuts = F.create_map(*[F.lit(x) for pair in model.thresholds.items() for x in pair]) if model.thresholds else F.lit(None).cast("map<string,double>")
    limit = F.coalesce(F.try_element_at(cuts, F.coalesce(F.col(lang_col).cast("string"), F.lit(""))), F.lit(model.threshold))
    held = docs.withColumnRenamed("score", "__score_in") if "score" in docs.columns else docs
    out = score(held, model, id_col, text_col).where(F.col("score") < limit).drop("score")
    return out.withColumnRenamed("__score_in", "score") if "score" in docs.columns else out
