"""Packing documents into training sequences by Karmarkar-Karp multiway differencing.

A document's ids are cut at multiples of the window length; the full pieces fill windows of their own. What is left
is cut at multiples of ``REST_PIECE`` ids, as small pieces leave less padding. These pieces, dealt by hash into
batches of a bounded number of tokens, are packed batch by batch: every piece begins as a partial partition with one loaded window; the two partitions of the largest spread are merged, fullest window with
emptiest, until one is left. Where a window of the result exceeds its capacity, the batch gets one window more.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import cut, small_batches

WINDOW, END_ID = 4096, 2
#: Windows of rest pieces in a batch, about; words that a worker's cache holds at most.
BATCH_WINDOWS, CACHED_WORDS = 400, 400_000
REST_PIECE = 512
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_PACKED = f"{_PIECE}, sequence_id long, offset long"


#: White space of Unicode. ``str.split()`` takes four control characters besides, which the tokenizer does not.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_CONTROLS = "\x1c\x1d\x1e\x1f"


def split_words(text: str) -> list[str]:
    if any(c in text for c in _CONTROLS):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


#: Words that need no Unicode rules: of ASCII and letters of Latin-1, whose lower case is one letter and whose form is composed.
_PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
#: Where the vocabulary splits such a word, in lower case.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[!-/:-`{-~]+").findall
#: The letters by which the vocabulary writes bytes.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = dict(zip([b for b in range(256) if b not in _SHOWN], range(256, 512), strict=False))


class _WordIds(dict):
    """Ids of white-space-separated words as little-endian bytes, filled on demand.

    A word never shares a token with its neighbour, so a text's ids are those of its words in a row.
    """

    _made: dict[str, _WordIds] = {}  # a worker's tasks go on with what the tasks before them have found

    @classmethod
    def of(cls, path: str) -> _WordIds:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.bare = self.tokenizer.model.tokenize
        self.marks = {m: self.encode(m) for m in ".,"}

    def encode(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode().decode("latin-1").translate(_BYTES)
        return b"".join([t.id.to_bytes(4, "little") for t in self.bare(part)])

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            ids = self._part(word.lower())
        elif word[-1] in self.marks and word[:-1].isalpha() and "\u0130" not in word:  # whose lower case ends in a mark of its own
            ids = self[word[:-1]] + self.marks[word[-1]]
        elif _PLAIN(word) and "<|" not in word:
            ids = b"".join(map(self._part, _PARTS(word.lower())))
        else:
            ids = self.encode(word)
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


def cuts(n: int, window: int, rest_piece: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces."""
    full = n - n % window
    return [(s, window) for s in range(0, full, window)] + [(s, min(rest_piece, n - s)) for s in range(full, n, rest_piece)]


def document_pieces(path: str, window: int = WINDOW, rest_piece: int = REST_PIECE, end_id: int = END_ID):
    """For ``mapInPandas`` over ``(doc_id, text)``: a row per piece."""
    end = end_id.to_bytes(4, "little")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _WordIds.of(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = b"".join(map(words.__getitem__, split_words(text or ""))) + end
                n = len(ids) // 4
                rows += [(doc_id, s, k, zlib.crc32(ids[4 * s : 4 * (s + k)]), n) for s, k in cuts(n, window, rest_piece)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]).astype({"doc_id": "Int64"})

    return pieces


def difference(sizes: list[int], windows: int) -> tuple[list[list[int]], int]:
    """Karmarkar-Karp: ``sizes`` dealt into ``windows`` windows, as item numbers; and the largest load.

    A partial partition is kept as its loaded windows only, fullest first; the others are empty.
    """
    if not sizes:
        return [[] for _ in range(windows)], 0
    left, right = [], []  # a window's items form a binary tree: nodes below len(sizes) are items
    n = len(sizes)
    heap = [(-size, i, np.array([size]), np.array([i])) for i, size in enumerate(sizes)]
    if windows == 1:
        return [list(range(n))], sum(sizes)
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        both = max(0, len(a) + len(b) - windows)  # so many loaded windows of each must share
        loads, nodes = np.concatenate([a, b[: len(b) - both]]), np.concatenate([na, nb[: len(b) - both]])
        if both:
            # The emptiest of a meet the fullest of those b's windows that find no free place: opposite ends are joined.
            loads = np.concatenate([a[: len(a) - both], b[: len(b) - both], a[len(a) - both :] + b[len(b) - both :][::-1]])
            ids = np.arange(n + len(left), n + len(left) + both)
            left.extend(na[len(a) - both :].tolist()), right.extend(nb[len(b) - both :][::-1].tolist())
            nodes = np.concatenate([na[: len(a) - both], nb[: len(b) - both], ids])
        order = np.argsort(-loads, kind="stable")
        loads, nodes = loads[order], nodes[order]
        spread = loads[0] - (loads[-1] if len(loads) == windows else 0)
        heapq.heappush(heap, (-int(spread), made, loads, nodes))
        made += 1
    _, _, loads, nodes = heap[0]
    out = []
    for node in nodes.tolist():
        items, open_nodes = [], [node]
        while open_nodes:
            x = open_nodes.pop()
            if x < n:
                items.append(x)
            else:
                open_nodes += (right[x - n], left[x - n])
        out.append(items)
    return out + [[] for _ in range(windows - len(out))], int(loads[0])


def fill_windows(sizes: list[int], window: int) -> list[list[int]]:
    """``sizes`` in as few windows as differencing can keep within ``window``, beginning with the least possible."""
    windows = max(1, -(-sum(sizes) // window))
    dealt, most = difference(sizes, windows)
    while most > window:
        windows += 1
        dealt, most = difference(sizes, windows)
    return [w for w in dealt if w]


def _pack_batch(window: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        full = np.flatnonzero(rows["length"] == window)
        rest = np.flatnonzero(rows["length"] < window)
        dealt = [[i] for i in full] + [rest[w] for w in fill_windows(rows["length"].to_numpy()[rest].tolist(), window)] if len(rows) else []
        sequence, offset = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64)
        for number, items in enumerate(dealt):
            lengths = rows["length"].to_numpy()[items]
            sequence[items], offset[items] = number, np.cumsum(lengths) - lengths
        return rows.assign(sequence_id=(rows["batch"].to_numpy() << 24) + sequence, offset=offset).drop(columns="batch")

    return pack


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, rest_piece: int = REST_PIECE, end_id: int = END_ID, batch_windows: int = BATCH_WINDOWS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``path`` is a vocabulary file of the ``tokenizers`` library, readable on every executor; ``end_id`` closes each
    document. A null or empty text is its end id alone. Rows that repeat an id are documents each. Every id lies in
    exactly one piece, no sequence exceeds ``window``, and pieces lie in a sequence without gaps. A batch holds about
    ``batch_windows`` windows whatever the table's size, so no task packs more than that. An empty table gives an
    empty result; extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = cut(texts.mapInPandas(document_pieces(path, window, rest_piece, end_id), _PIECE))
    total = pieces.agg(F.sum("length")).first()[0] or 0
    batches = max(1, round(total / (window * batch_windows)))
    batch = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(batches))
    return pieces.withColumn("batch", batch).groupBy("batch").applyInPandas(_pack_batch(window), _PACKED)
