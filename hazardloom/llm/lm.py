"""LM scoring: a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

The model predicts a token's class from the ``CONTEXT`` tokens before it, and from these, too, the token within its
class. The most frequent tokens are classes of their own; the others are dealt into classes by their last letters, which
tell languages apart. Within such a class, the tokens of the head (the ``HEAD`` most frequent) and one leaf for all its
others hang in a binary tree, made by Huffman's rule from their smoothed counts: at each node the context decides about
the side, by a vector and a bias of that node, which begins as the counts have it. Every token of the head has a vector
of its own as context, beside its class's. Tokens out of the head are as many as the corpus makes, a model that fits a
task is not: they share their class's leaf by smoothed counts, and its vector. Unseen tokens share the probability
``unseen`` (the share of tokens seen once) among as many kinds as there seem to be: n1^2 / (2 n2), from the numbers of
kinds seen once and twice (Chao's estimate), one at least. So the probabilities of all V known tokens and those unseen
kinds add up to 1: a matrix product over the classes normalises those, and the sides of each node add up to 1.

Counts, and all that is derived from them, cover every training document. The neural part learns from all of them,
too: beginning from a common start, each partition trains a copy on its own tokens, and the copies are averaged, the
row of a token or node by how often each copy met it. Counts of the head are handed to every task; all others meet
their counts in a shuffled join.
"""

from __future__ import annotations

import zlib
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import cut, small_batches

HEAD, OWN, SUFFIXES = 150_000, 96, 32
CLASSES = OWN + SUFFIXES
CONTEXT, DIM, NOISE, BATCH, RATE = 4, 16, 32, 4096, 0.08
#: Documents, about, that the common start is trained on.
START_DOCS, START_STEPS = 2_000, 600
#: Where Adagrad's sums of squares begin: for the common start, and for the copies that go on from it.
WARM, CALM = 1e-4, 1e-2
#: Targets of a stretch of text that is learnt in one piece; the same two for rows of tokens and nodes, whose steps add up over a batch.
STRETCH, WORD_RATE, WORD_CALM = 64, 0.1, 1.0
#: Numbers of a row of the model, and rows that meet in one group when copies are averaged.
WIDE, BLOCK = DIM + 1, 512
ALPHA = 0.1
#: The end of a text as a token; no word holds a line feed.
END = "\n"
_FLUSH = 300_000


def tokens(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def suffix_class(word: bytes) -> int:
    return OWN + zlib.crc32(word.rstrip(b".,;:!?")[-2:]) % SUFFIXES


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frame = lambda c: pd.DataFrame({"token": [w.decode("utf-8", "replace") for w in c], "c": list(c.values())})
    counts: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            counts.update(tokens(text))
            if len(counts) > _FLUSH:
                yield frame(counts)
                counts = Counter()
        yield pd.DataFrame({"token": [END], "c": [len(batch)]})
    if counts:
        yield frame(counts)


class Codes(dict):
    """Places of the head's tokens; any other word has -1 less its class, noted for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        code = -1 - suffix_class(word)
        if len(self) < 2 * HEAD:
            self[word] = code
        return code


@dataclass
class Lexicon:
    """What the tasks know of the corpus: bounded, whatever its size."""

    total: int
    kinds: int
    unseen: float
    unseen_kinds: float = 1.0
    head: dict[bytes, int] = field(default_factory=dict)  # token -> place in the arrays
    counts: np.ndarray = None
    classes: np.ndarray = None
    leaves: np.ndarray = None  # leaf of each place: from 1, 0 for a token that is a class
    rest: np.ndarray = None  # smoothed count of each class's tokens out of the head, whose leaf stands behind the others
    starts: np.ndarray = None  # where a leaf's path begins in the next two
    nodes: np.ndarray = None  # rows of the model
    sides: np.ndarray = None  # 1 or -1
    noise: np.ndarray = None  # share of each class among all tokens
    codes: Codes | None = None  # made by each task for itself

    @property
    def words(self) -> int:
        """How many tokens have a leaf of their own."""
        return len(self.starts) - 2 - CLASSES

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in the head (-1: not there), class and leaf of each word and of the end of the text."""
        if self.codes is None:
            self.codes = Codes(self.head)
        code = np.array([*map(self.codes.__getitem__, words), self.head.get(END.encode(), -1)], dtype=np.int64)
        places = np.maximum(code, -1)
        classes = np.where(code >= 0, self.classes[places], -1 - code)
        return places, classes, np.where(code >= 0, self.leaves[places], self.words + 1 + classes)

    def paths(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the nodes above leaves: which leaf's each is, its number and side; and the leaves that have any."""
        begin = self.starts[leaves]
        long = self.starts[leaves + 1] - begin
        some = np.flatnonzero(long)
        begin, long = begin[some], long[some]
        ends = np.cumsum(long)
        at = np.repeat(begin - ends + long, long) + np.arange(ends[-1] if len(ends) else 0)
        return np.repeat(some, long), np.take(self.nodes, at), np.take(self.sides, at), some


def tree(mass: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Paths (``starts, nodes, sides``) to leaves of ``mass`` in a Huffman tree for each of their ``kinds``, and the nodes' biases.

    Leaves without mass have an empty path. A node's bias is the logarithm of how its sides' masses compare, so that by
    the biases alone each leaf has its share of its kind's mass.
    """
    n = len(mass)
    weight, parent, side = mass.tolist() + [0.0] * n, np.full(2 * n, -1, dtype=np.int64), np.zeros(2 * n, dtype=np.float32)
    made, bias = 0, []
    order = np.lexsort((mass, kinds))
    order = order[mass[order] > 0]
    for ids in np.split(order, np.flatnonzero(np.diff(kinds[order])) + 1) if len(order) else []:
        leaves, joined = deque(ids.tolist()), deque()
        take = lambda: (leaves if leaves and (not joined or weight[leaves[0]] <= weight[joined[0]]) else joined).popleft()  # noqa: B023, E731
        while len(leaves) + len(joined) > 1:
            a, b = take(), take()
            at = n + made
            parent[[a, b]], side[a], side[b], weight[at] = at, 1, -1, weight[a] + weight[b]
            bias.append(np.log(weight[a] / weight[b]))
            joined.append(at)
            made += 1
    now, levels = np.arange(n), []
    which = np.arange(n)
    while len(which := which[(up := parent[now]) >= 0]):
        levels.append((which, up[up >= 0] - n, side[now[up >= 0]]))
        now = up[up >= 0]
    depth = np.zeros(n + 1, dtype=np.int64)
    for which, _, _ in levels:
        depth[which + 1] += 1
    starts = np.cumsum(depth)
    nodes, sides = np.zeros(starts[-1], dtype=np.int32), np.zeros(starts[-1], dtype=np.float32)
    for level, (which, up, turn) in enumerate(levels):
        nodes[starts[which] + level], sides[starts[which] + level] = up, turn
    return starts, nodes, sides, np.array(bias, dtype=np.float32)


@dataclass
class Model:
    r: np.ndarray
    c: np.ndarray
    q: np.ndarray
    b: np.ndarray

    @classmethod
    def fresh(cls, noise: np.ndarray, seed: int = 3) -> Model:
        rng = np.random.default_rng(seed)
        r, q = (rng.normal(0, 0.1, (CLASSES, DIM)).astype(np.float32) for _ in range(2))
        c = np.stack([np.eye(DIM) / CONTEXT] * CONTEXT).astype(np.float32)
        return cls(r, c, q, np.log(noise).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.c, self.q, self.b)])

    @classmethod
    def head(cls) -> int:
        """Rows of ``flat`` that hold the classes' part."""
        return -(-(2 * CLASSES * DIM + CONTEXT * DIM * DIM + CLASSES) // WIDE)

    @classmethod
    def of(cls, flat: np.ndarray) -> Model:
        shapes, out, at = ((CLASSES, DIM), (CONTEXT, DIM, DIM), (CLASSES, DIM), (CLASSES,)), [], 0
        for shape in shapes:
            n = int(np.prod(shape))
            out.append(flat[at : at + n].reshape(shape).astype(np.float32))
            at += n
        return cls(*out)

    def log10(self, contexts: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Normalised log10 probability of each target class after its context of classes."""
        return self.of_class(sum(self.r[contexts[:, i]] @ self.c[i] for i in range(CONTEXT)), targets)

    def of_class(self, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
        out = np.empty(len(targets))
        for s in range(0, len(targets), BATCH):
            z = h[s : s + BATCH] @ self.q.T + self.b
            if z.max() > 60:
                z -= z.max(axis=1, keepdims=True)
            own = z[np.arange(len(z)), targets[s : s + BATCH]].astype(np.float64)
            out[s : s + BATCH] = own - np.log((np.exp(z, out=z) @ np.ones(CLASSES, dtype=np.float32)).astype(np.float64))
        return out / np.log(10)


class Words:
    """Rows of the nodes (a vector and a bias) and of the tokens that have a leaf (a vector as context), behind the classes' part of ``flat``."""

    def __init__(self, flat: np.ndarray, lexicon: Lexicon):
        self.rows, self.lex = flat.reshape(-1, WIDE), lexicon
        self.tokens = len(self.rows) - 1 - lexicon.words  # where the tokens' rows begin; the first is that of all others, and stays 0

    def own(self, leaves: np.ndarray) -> np.ndarray:
        """Rows of tokens as context."""
        return self.tokens + np.where(leaves <= self.lex.words, leaves, 0)

    def sides(self, h: np.ndarray, leaves: np.ndarray) -> tuple:
        """``paths``, with the row of each node, h (and 1), and how the context leans towards the path's side."""
        which, nodes, turn, some = self.lex.paths(leaves)
        rows, ones = np.take(self.rows, nodes, axis=0), np.ones((len(h), 1), dtype=np.float32)
        wide = np.take(np.concatenate([h, ones], axis=1), which, axis=0)
        return which, nodes, turn, some, rows, wide, np.einsum("ij,ij->i", rows, wide) * turn

    def log10(self, h: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """Log10 probability of each leaf within its class."""
        out = np.zeros(len(leaves))
        for s in range(0, len(leaves), BATCH):
            which, *_, lean = self.sides(h[s : s + BATCH], leaves[s : s + BATCH])
            out[s : s + BATCH] = np.bincount(which, -np.logaddexp(0, -lean), len(out[s : s + BATCH]))
        return out / np.log(10)


def _sums(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct numbers, in order, the sums of their values, and how often each stands there."""
    order = np.argsort(at.astype(np.uint16), kind="stable")  # two bytes sort fastest
    if at.dtype.itemsize > 2:
        order = order[np.argsort((np.take(at, order) >> 16).astype(np.uint16), kind="stable")]
    sorted_at = np.take(at, order)
    edges = np.flatnonzero(np.diff(sorted_at, prepend=-1))
    if not len(edges):
        return sorted_at, values[:0], edges
    return sorted_at[edges], np.add.reduceat(np.take(values, order, axis=0), edges, axis=0), np.diff(edges, append=len(at))


def _sum_rows(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros((CLASSES, values.shape[1]), dtype=np.float32)
    found, sums, _ = _sums(at.astype(np.uint8), values)  # CLASSES fit a byte, which sorts fastest
    out[found] = sums
    return out


def _behind(rows: np.ndarray, i: int) -> np.ndarray:
    """Of stretches with their contexts, what stands ``i + 1`` places before each target."""
    return rows[:, CONTEXT - 1 - i : rows.shape[1] - 1 - i]


class Trainer:
    """Noise-contrastive estimation of classes with noise words shared by a batch, likelihood of the sides of nodes, and Adagrad steps."""

    def __init__(self, flat: np.ndarray, lexicon: Lexicon, seed: int, calm: float):
        self.flat = flat.astype(np.float32)
        self.m, self.words, self.noise, self.rng = Model.of(self.flat), Words(self.flat, lexicon), lexicon.noise, np.random.default_rng(seed)
        self.shift = np.log(NOISE * self.noise).astype(np.float32)
        self.squares = [np.full_like(x, calm) for x in (self.m.r, self.m.c, self.m.q, self.m.b)]
        self.word_squares = np.full(len(self.words.rows), WORD_CALM, dtype=np.float32)
        self.met = np.zeros(len(self.words.rows))  # how often each row was learnt

    def _rows(self, at: np.ndarray, g: np.ndarray) -> None:
        at, g, times = _sums(at, g)
        squares = self.word_squares[at] + np.einsum("ij,ij->i", g, g) / WIDE
        self.word_squares[at] = squares
        g *= (WORD_RATE / np.sqrt(squares))[:, None]
        self.words.rows[at] = np.take(self.words.rows, at, axis=0) + g
        self.met[at] += times

    def step(self, x: np.ndarray, leaves: np.ndarray, counts: np.ndarray) -> None:
        """A step with stretches of classes and leaves; ``counts`` tells which are targets, the first ``CONTEXT`` of each are not."""
        m, w = self.m, self.words
        own = w.own(leaves)
        rows = np.take(m.r, x, axis=0) + np.take(w.rows, own, axis=0)[..., :DIM]
        # One product for all places of the context, of which each target takes its own.
        made = (rows.reshape(-1, DIM) @ np.concatenate(m.c, axis=1)).reshape(*x.shape, CONTEXT, DIM)
        h = sum(_behind(made[:, :, i], i) for i in range(CONTEXT))
        shape, h = h.shape, h[counts]
        y, n = x[:, CONTEXT:][counts], len(h)
        qy, z = np.take(m.q, y, axis=0), self.rng.choice(CLASSES, NOISE, p=self.noise)
        true = 1 / (1 + np.exp(-((h * qy).sum(axis=1) + m.b[y] - self.shift[y]))) - 1
        false = 1 / (1 + np.exp(-(h @ m.q[z].T + m.b[z] - self.shift[z])))
        dh = true[:, None] * qy + false @ m.q[z]
        dq, db = _sum_rows(y, np.concatenate([true[:, None] * h, true[:, None]], axis=1)), np.zeros(CLASSES, dtype=np.float32)
        db += dq[:, -1]
        dq = np.ascontiguousarray(dq[:, :-1])
        np.add.at(dq, z, false.T @ h)
        np.add.at(db, z, false.sum(axis=0))
        which, at, turn, some, node_rows, wide, lean = w.sides(h, leaves[:, CONTEXT:][counts])
        if len(some):
            pull = (turn / (1 + np.exp(lean)))[:, None]
            node_rows *= pull
            dh[some] -= np.add.reduceat(node_rows, np.flatnonzero(np.diff(which, prepend=-1)), axis=0)[:, :DIM]
        back = np.zeros(shape, dtype=np.float32)
        back[counts] = dh
        flat_back, d_rows = back.reshape(-1, DIM), np.zeros_like(rows)
        dc = np.stack([_behind(rows, i).reshape(-1, DIM).T @ flat_back for i in range(CONTEXT)])
        given = (flat_back @ np.concatenate([c.T for c in m.c], axis=1)).reshape(*shape[:2], CONTEXT, DIM)
        for i in range(CONTEXT):
            _behind(d_rows, i)[:] += given[:, :, i]
        d_rows = d_rows.reshape(-1, DIM)
        dr = _sum_rows(x.ravel(), d_rows)
        if len(some):
            wide *= pull
            self._rows(at, wide)
        if w.lex.words:
            known = np.flatnonzero(own.ravel() > w.tokens)
            self._rows(own.ravel()[known], np.concatenate([-np.take(d_rows, known, axis=0), np.zeros((len(known), 1), dtype=np.float32)], axis=1))
        for value, square, g in zip((m.r, m.c, m.q, m.b), self.squares, (dr, dc, dq, db), strict=True):
            g = g / n
            square += g * g
            value -= RATE * g / np.sqrt(square)

    def learnt(self, seen: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the copy and the weight of each."""
        part = self.m.flat()
        self.flat[: len(part)] = part
        self.met[: Model.head()] = seen
        return self.flat.reshape(-1, WIDE), self.met


def line(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts given as classes and leaves, one behind the other, and which places are theirs; before a text stand ends of text (class 0)."""
    pad, nothing = np.zeros(CONTEXT, dtype=np.int64), np.zeros(CONTEXT, dtype=bool)
    x = np.concatenate([part for classes, _ in rows for part in (pad, classes)] or [pad])
    leaves = np.concatenate([part for _, found in rows for part in (pad, found)] or [pad])
    counts = np.concatenate([part for classes, _ in rows for part in (nothing, np.ones(len(classes), dtype=bool))] or [nothing])
    return x, leaves, counts


def stretches(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line``, cut into stretches of ``STRETCH`` targets with the context before them."""
    x, leaves, counts = line(rows)
    n = -(-max(1, len(x) - CONTEXT) // STRETCH)
    at = np.arange(n)[:, None] * STRETCH + np.arange(CONTEXT + STRETCH)
    more = n * STRETCH + CONTEXT - len(x)
    return *(np.pad(v, (0, more))[at] for v in (x, leaves)), np.pad(counts, (0, more))[at][:, CONTEXT:]


def _train(lexicon, start, least_steps: int):
    """A copy of the model, trained on a partition; ``least_steps`` steps at least, if need be by going over the first texts again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex, seen = lexicon.value, 0
        trainer = Trainer(start.value, lex, 1 + TaskContext.get().partitionId(), CALM if least_steps == 0 else WARM)
        held, size, first, steps = [], 0, [], 0

        def learn():
            parts = stretches(held)
            order = trainer.rng.permutation(len(parts[0]))
            for s in range(0, len(order), BATCH // STRETCH):
                trainer.step(*(v[order[s : s + BATCH // STRETCH]] for v in parts))

        for batch in batches:
            for text in batch["text"]:
                held.append(lex.look_up(tokens(text))[1:])
                size += len(held[-1][0])
                if size >= 16 * BATCH:
                    learn()
                    first, steps = first or held, steps + 16
                    seen, held, size = seen + size, [], 0
        if held:
            learn()
            seen, steps, first = seen + size, steps + 1, first or held
        held = first
        while held and steps < least_steps:
            learn()
            steps += max(1, sum(len(x) for x, _ in held) // BATCH)
        if seen:
            rows, weights = trainer.learnt(seen)
            blocks = range(0, len(rows), BLOCK)
            yield pd.DataFrame({"block": [b // BLOCK for b in blocks], "rows": [_packed(rows[b : b + BLOCK], weights[b : b + BLOCK]) for b in blocks]})

    return run


def _packed(rows: np.ndarray, weights: np.ndarray) -> bytes:
    """Those rows that have a weight: their numbers, weights and values."""
    at = np.flatnonzero(weights)
    return np.concatenate([at[:, None], weights[at, None], rows[at]], axis=1).astype(np.float32).tobytes()


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = np.frombuffer(packed, dtype=np.float32).reshape(-1, 2 + WIDE)
    return found[:, 0].astype(np.int64), found[:, 1], found[:, 2:]


def _mean(parts: pd.DataFrame) -> pd.DataFrame:
    """The average of a block's rows over all copies."""
    sums, weights = np.zeros((BLOCK, WIDE)), np.zeros(BLOCK)
    for packed in parts["rows"]:
        at, weight, rows = _unpacked(packed)
        sums[at] += weight[:, None].astype(np.float64) * rows
        weights[at] += weight
    return pd.DataFrame({"block": parts["block"].iloc[:1], "rows": [_packed(sums / np.maximum(weights, 1)[:, None], weights)]})


def _averaged(texts: DataFrame, lexicon, start: np.ndarray, least_steps: int = 0) -> np.ndarray:
    shared = texts.sparkSession.sparkContext.broadcast(start)
    parts = texts.mapInPandas(_train(lexicon, shared, least_steps), "block int, rows binary")
    out = start.copy()
    for r in parts.groupBy("block").applyInPandas(_mean, "block int, rows binary").collect():
        at, _, rows = _unpacked(bytes(r["rows"]))
        out.reshape(-1, WIDE)[r["block"] * BLOCK + at] = rows
    shared.unpersist()
    return out


def _score(lexicon, flat):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = lexicon.value
        model, by_word = Model.of(flat.value), Words(flat.value, lex)
        logs = np.append(np.log10(lex.counts + ALPHA), 0.0)  # the last place is for words out of the head
        base = np.log10(lex.total + ALPHA * (lex.kinds + 1))
        seen, share = np.log10(1 - lex.unseen), np.log10(np.maximum(lex.rest, ALPHA))
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, ids, folds = batch["text"].tolist(), batch["doc_id"].tolist(), batch["held_out"].tolist()
            for s in range(0, len(texts), 64):
                words = [tokens(t) for t in texts[s : s + 64]]
                found = [lex.look_up(w) for w in words]
                x, leaves, counts = line([f[1:] for f in found])
                rows = (np.take(model.r, x, axis=0) + np.take(by_word.rows, by_word.own(leaves), axis=0)[:, :DIM])[None]
                h = sum(_behind(rows, i)[0] @ model.c[i] for i in range(CONTEXT))[counts[CONTEXT:]]
                y = x[counts]
                each = model.of_class(h, y) + by_word.log10(h, leaves[counts]) + seen
                places = np.concatenate([p for p, _, _ in found])
                which = np.repeat(np.arange(len(found)), [len(p) for p, _, _ in found])
                head = places >= 0
                n = len(found)
                at = np.flatnonzero(~head)
                spelt = [w for ws in words for w in (*ws, END.encode())]
                keys: dict[tuple, int] = {}
                slot = np.array([keys.setdefault((k, spelt[i]), len(keys)) for i, k in zip(at.tolist(), which[at].tolist(), strict=True)], dtype=np.int64)
                m = len(keys)
                # A row per document, then a row per document and word out of the head.
                sums = lambda values: np.concatenate([np.bincount(which, values, n), np.zeros(m)])
                tail = lambda values: np.concatenate([np.zeros(n), np.bincount(slot, values, m)])
                yield pd.DataFrame(
                    {
                        "row_id": row_id + np.concatenate([np.arange(n), np.fromiter((k for k, _ in keys), dtype=np.int64, count=m)]),
                        "doc_id": pd.array(ids[s : s + 64] + [None] * m, dtype="Int64"),
                        "held_out": pd.array(folds[s : s + 64] + [None] * m, dtype="boolean"),
                        "token": [f"{END}{row_id + k}" for k in range(n)] + [w.decode("utf-8", "replace") for _, w in keys],
                        "n_tokens": sums(None).astype(np.int64),
                        "times": tail(None),
                        "known": sums(head).astype(np.int64),
                        "base": sums(np.where(head, logs[places], 0) - base),
                        "score": sums(np.where(head, each, 0)),
                        "inner": tail(each[at] - share[y[at]]),
                    }
                )
                row_id += n

    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    The model learns from the rows for which ``held_out`` does not hold (null counts as not) and scores all whole texts. Null, empty and
    blank texts are the end of text alone. Rows that repeat an id are documents each. Without training rows every
    token is unseen and both scores are 0. An empty table gives an empty result; extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    train = texts.where(~F.col("held_out")).select("doc_id", "text")
    counts = cut(train.select("text").mapInPandas(_count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c")))
    # Of counts by count: the least count whose tokens, with all more frequent ones, fit the head.
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("t"))
    facts = by_count.agg(F.sum("t"), F.sum("n"), F.sum(F.when(F.col("c") == 1, F.col("n"))), F.sum(F.when(F.col("c") == 2, F.col("n")))).first()
    total, kinds, once, twice = (int(x or 0) for x in facts)
    least, in_head = 1 << 62, 0
    if kinds:
        # At most HEAD distinct counts can belong to tokens of the head.
        for r in by_count.orderBy(F.desc("c")).limit(HEAD).select("c", "n").toLocalIterator():
            in_head += r["n"]
            if in_head > HEAD:
                break
            least = r["c"]
    head = sorted(((r["c"], r["token"]) for r in counts.where(F.col("c") >= least).toLocalIterator()), key=lambda x: (-x[0], x[1])) if kinds else []
    # Class 0 is the end of a text; the OWN - 1 most frequent words follow.
    own = [END] + [t for _, t in head if t != END][: OWN - 1]
    own_class = {t: i for i, t in enumerate(own)}
    classes = [own_class.get(t, None) for _, t in head]
    classes = [suffix_class(t.encode()) if c is None else c for c, (_, t) in zip(classes, head, strict=True)]
    lexicon = Lexicon(total, kinds, min(1.0, (once + 0.5) / (total + 1)) if total else 1.0, max(1.0, once**2 / (2 * max(1, twice))))
    lexicon.head = {t.encode(): i for i, (_, t) in enumerate(head)}
    lexicon.counts = np.array([c for c, _ in head], dtype=np.float64)
    lexicon.classes = np.array([*classes, 0], dtype=np.int64)
    lexicon.rest, shares = np.zeros(CLASSES), np.zeros(CLASSES)
    np.add.at(shares, classes, lexicon.counts)

    @F.pandas_udf("int")
    def class_of(words: pd.Series) -> pd.Series:
        return words.map(lambda t: 0 if t == END else suffix_class(t.encode())).astype("int32")

    tail = counts.where(F.col("c") < least)
    for r in tail.groupBy(class_of("token").alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        lexicon.rest[r["k"]] += r["c"] + ALPHA * r["n"]
        shares[r["k"]] += r["c"]
    # Leaf 0 is of tokens that are classes; behind the leaves of the head's other tokens stands one for the rest of each class.
    in_tree = np.flatnonzero(lexicon.classes[:-1] >= OWN)
    lexicon.leaves = np.zeros(len(head) + 1, dtype=np.int64)
    lexicon.leaves[in_tree] = 1 + np.arange(len(in_tree))
    mass = np.concatenate([[0.0], lexicon.counts[in_tree] + ALPHA, lexicon.rest])
    lexicon.starts, nodes, lexicon.sides, bias = tree(mass, np.concatenate([[-1], lexicon.classes[in_tree], np.arange(CLASSES)]))
    lexicon.nodes = nodes + np.int32(Model.head())
    lexicon.noise = (shares + 1) / (shares + 1).sum()
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    part = Model.fresh(lexicon.noise).flat()
    flat = np.zeros((Model.head() + len(bias) + 1 + len(in_tree), WIDE), dtype=np.float32)
    flat[Model.head() : Model.head() + len(bias), DIM] = bias
    flat = flat.ravel()
    flat[: len(part)] = part
    if total:
        every = max(1, train.count() // START_DOCS)
        picked = train.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("doc_id", "text")
        flat = _averaged(picked.repartition(1).sortWithinPartitions("doc_id", "text").select("text"), shared, flat, START_STEPS)
        flat = _averaged(train.select("text"), shared, flat)

    rows = texts.mapInPandas(_score(shared, docs.sparkSession.sparkContext.broadcast(flat)), "row_id long, doc_id long, held_out boolean, token string, n_tokens long, times double, known long, base double, score double, inner double")
    # A document's own row has a token that no count has; every other row is a word out of the head.
    met = rows.join(tail.hint("merge"), "token", "left")  # both sides can spill
    of_tail = F.col("n_tokens") == 0
    known = F.col("c").isNotNull()
    word = F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + ALPHA)
    out = met.groupBy("row_id").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.when(of_tail, F.when(known, F.col("times")).otherwise(0.0)).otherwise(F.col("known"))).cast("long").alias("n_known"),
        F.sum(F.when(of_tail, word).otherwise(F.col("base"))).alias("base_score"),
        F.sum(F.when(~of_tail, F.col("score")).when(known, F.col("inner") + word).otherwise(F.col("times") * float(np.log10(lexicon.unseen / lexicon.unseen_kinds)))).alias("score"),
    )
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
