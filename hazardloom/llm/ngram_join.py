"""N-gram Jaccard self-join by prefix filtering and prefix trees, and its connected groups.

Shingles have one global order: hot ones (of many documents) last; before, by class (a quarter of them, picked by
hash, comes first), then by the number of documents that hold them, then by hash. Two sets of the wanted similarity
share one of the first ``n - ceil(0.8 n) + 1`` shingles of each, so documents meet in the lists of these shingles. The
first class alone covers most prefixes, so three quarters of the shingles of long texts never leave their task, and a
passage that many documents share brings none together.

Lists are worked off in two rounds. First every list's pivot (its smallest hash) is tested against the list's other
documents, about one test a document; a list that one component now holds is done, however many alike documents it
has. In the other lists every document is tested against every other one, in blocks, overlapping lists together where that
is cheaper. So no link is lost and no pair is ever written down but a link.

Tests run in a prefix tree: sets of a block are stored in one order of their shingles (most frequent first), so that
documents that begin alike share a path, and a block of probes walks the tree at once, sharing the partial overlaps
of a path; a subtree ends where the shingles left cannot reach the overlap for any probe.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hazardloom.llm.common import cut, discard, in_few_tasks, keep, shuffle_partitions, small_batches
from hazardloom.llm.components import components
from hazardloom.llm.shingles import mix, shingle_set

WORDS, PERCENT = 5, 80
#: Shingles a bucket of postings holds, about; documents of a tree; probes that walk it at once; bits of the filter on ids.
BUCKET, BLOCK, PROBES, FILTER_BITS = 500_000, 1_024, 256, 1 << 23
#: A shingle in so many of all documents is hot: it comes last in the order and is never gathered in a bucket.
HOT_SHARE = 0.001
#: Different documents of a partition, about, among which local counts are taken.
HOT_AMONG = 6_000
_HOT = (1 << 31) - 1


def needed(n: int, percent: int) -> int:
    """The least overlap that a set of ``n`` shingles has with any set that it links with."""
    return -(-percent * n // 100)


def linked(overlap: int, m: int, n: int, percent: int) -> bool:
    return 100 * overlap >= percent * (m + n - overlap)


class Trie:
    """A prefix tree of ordered sets. A node holds a run of items, its children by first item, and the sets that end in it."""

    __slots__ = ("run", "next", "ends", "least", "deepest")

    def __init__(self, run: np.ndarray):
        self.run, self.next, self.ends, self.least, self.deepest = run, {}, [], 1 << 62, 0

    def add(self, items: np.ndarray, key: int, size: int) -> None:
        """``items`` in order, of a set of ``size`` that may have more items, which no probe holds."""
        node, at = self, 0
        while True:
            node.least = min(node.least, size)
            k = min(len(node.run), len(items) - at)
            differ = np.flatnonzero(node.run[:k] != items[at : at + k])
            same = int(differ[0]) if len(differ) else k
            if same < len(node.run):
                tail = Trie(node.run[same:])
                tail.next, tail.ends, tail.deepest = node.next, node.ends, node.deepest
                tail.least = min([*(s for _, s in tail.ends), *(c.least for c in tail.next.values())])
                node.run, node.next, node.ends, node.deepest = node.run[:same], {int(tail.run[0]): tail}, [], len(tail.run) + tail.deepest
            at += same
            node.deepest = max(node.deepest, len(items) - at)
            if at == len(items):
                node.ends.append((key, size))
                return
            child = node.next.get(int(items[at]))
            if child is None:
                child = node.next[int(items[at])] = Trie(items[at:])
                child.least = size
                child.ends.append((key, size))
                return
            node = child

    def partners(self, holds: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
        """(key, probe) of all sets and probes that link. ``holds[item, probe]`` is 1 where the probe holds the item."""
        todo = [(self, np.zeros(len(sizes), dtype=np.int64))]
        while todo:
            node, overlap = todo.pop()
            if len(node.run):
                overlap = overlap + holds[node.run].sum(axis=0, dtype=np.int32)
            for key, size in node.ends:
                for probe in np.flatnonzero(linked(overlap, sizes, size, percent)):
                    yield key, int(probe)
            if node.next and linked(np.minimum(overlap + node.deepest, sizes), sizes, node.least, percent).any():
                todo += [(child, overlap) for child in node.next.values()]


def linked_pairs(stored: list[tuple[int, np.ndarray]], probes: list[tuple[int, np.ndarray]] | None, percent: int) -> list[tuple[int, int]]:
    """Links between ``stored`` and ``probes`` (or within ``stored``) as (document, smallest document that it is connected with)."""
    own = probes is None
    probes = stored if own else probes
    values, counts = np.unique(np.concatenate([h for _, h in stored]), return_counts=True)
    if own:
        values, counts = values[counts > 1], counts[counts > 1]
    else:
        both = np.isin(values, np.unique(np.concatenate([h for _, h in probes])), assume_unique=True)
        values, counts = values[both], counts[both]
    if not len(values):
        return []
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))

    def items(h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(values, h), len(values) - 1)
        return place[at[values[at] == h]]

    tree = Trie(np.zeros(0, dtype=np.int64))
    for key, (_, h) in enumerate(stored):
        tree.add(np.sort(items(h)), key, len(h))
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for s in range(0, len(probes), PROBES):
        part = probes[s : s + PROBES]
        holds = np.zeros((len(values), len(part)), dtype=np.uint8)
        for i, (_, h) in enumerate(part):
            holds[items(h), i] = 1
        for key, i in tree.partners(holds, np.array([len(h) for _, h in part]), percent):
            a, b = sorted((top(stored[key][0]), top(part[i][0])))
            parent[b] = a
    return [(x, top(x)) for x in parent if top(x) != x]


def _first(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(3)) == 0


def _profiles(words: int):
    """Per document: set size and two signatures of the set; now and then, with a row, what was hot among the last documents."""

    def hottest(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
        found: tuple[list[int], list[int]] = ([], [])
        for part in range(4):  # by parts, so that a quarter is sorted at a time
            values, counts = np.unique(np.concatenate([h[h & np.uint64(3) == part] for h in sets]), return_counts=True)
            hot = counts >= max(4, HOT_SHARE / 2 * len(sets))
            found[0].extend(values[hot].view(np.int64).tolist()), found[1].extend(counts[hot].tolist())
        return found

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["doc_id", "n", "sign_a", "sign_b", "hot", "hot_docs"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, sets, seen = [], [], set()
        for batch in batches:
            if held:
                yield frame(held)
            held = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                h = shingle_set(text, words)
                signs = int(mix(h + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mix(h ^ np.uint64(0x5BD1E995)), initial=np.uint64(0)).view(np.int64))
                held.append((doc_id, len(h), *signs, None, None))
                if signs not in seen:
                    seen.add(signs), sets.append(h)
            if len(sets) >= HOT_AMONG:
                held[-1] = (*held[-1][:4], *hottest(sets))
                sets, seen = [], set()
        if held and sets:
            held[-1] = (*held[-1][:4], *(x + y for x, y in zip(hottest(sets), (held[-1][4] or [], held[-1][5] or []), strict=True)))
        if held:
            yield frame(held)

    return run


def _postings(words: int, percent: int, buckets: int, hot: np.ndarray):
    """Per batch and bucket: shingles and documents in parallel arrays. Copies in a partition count once.

    Bucket -1 has the hot shingles, and -2, in place of shingles, the documents' numbers of others: of the first class
    and, in the upper half of the number, of the other. No more of a set is handed on than its prefix may need.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[bytes] = set()
        for batch in batches:
            sets, ids, sizes = [], [], []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                h = shingle_set(text, words)
                if doc_id is None or doc_id != doc_id or not len(h) or (sign := blake2b(h.tobytes(), digest_size=16).digest()) in seen:
                    continue
                seen.add(sign)
                late = np.isin(h, hot, assume_unique=True)
                first, prefix = _first(h) & ~late, len(h) - needed(len(h), percent) + 1
                n_first, n_other = int(first.sum()), len(h) - int(late.sum()) - int(first.sum())
                h = h[first] if n_first >= prefix else h[~late] if n_first + n_other >= prefix else h
                sets.append(h), ids.append(np.full(len(h), doc_id, dtype=np.int64)), sizes.append((n_first | n_other << 32, doc_id))
            if not sets:
                continue
            h, ids = np.concatenate(sets), np.concatenate(ids)
            at = ((h >> np.uint64(2)) % np.uint64(buckets)).astype(np.int64)
            at[np.isin(h, hot)] = -1
            order = np.argsort(at, kind="stable")
            at, h, ids = at[order], h[order].view(np.int64), ids[order]
            edges = np.flatnonzero(np.diff(at, prepend=at[0] - 1, append=at[-1] + 1))
            runs = list(zip(edges, edges[1:], strict=False))
            sizes = np.array(sizes, dtype=np.int64)
            yield pd.DataFrame({"bucket": [*at[edges[:-1]], -2], "shingles": [*(h[s:e] for s, e in runs), sizes[:, 0]], "docs": [*(ids[s:e] for s, e in runs), sizes[:, 1]]})

    return run


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the postings of shingles that at least two documents hold, with that number."""
    h, docs = np.concatenate(rows["shingles"].to_numpy()), np.concatenate(rows["docs"].to_numpy())
    _, back, counts = np.unique(h, return_inverse=True, return_counts=True)
    df = counts[back]
    keep = df > 1
    return pd.DataFrame({"shingle": h[keep], "doc_id": docs[keep], "df": df[keep]})


def _verify(words: int, percent: int):
    """Over rows sorted by task, the stored documents of a task (side 0) before its probes (side 1, or none): links."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sides = None, ([], [])
        frame = lambda pairs: pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")

        def settle() -> list[tuple[int, int]]:
            stored, probes = sides
            return linked_pairs(stored, probes or None, percent) if stored and len(stored) + len(probes) > 1 else []

        for batch in batches:
            out = []
            for *task, side, doc, text in zip(*(batch[c] for c in ("g", "i", "j", "side", "doc", "text")), strict=True):
                if task != now:
                    out += settle()
                    now, sides = task, ([], [])
                h = shingle_set(text, words)
                if len(h):
                    sides[side].append((doc, h))
            yield frame(out)
        yield frame(settle())

    return run


def _among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` that may be in ``ids``: a filter of ``FILTER_BITS`` bits, whatever the number of ids."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    at = ids.select((place("doc") + 1).alias("p"))
    maps = at.groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    bits = np.zeros(FILTER_BITS, dtype=bool)
    for row in maps:
        start = (row["k"] - 1) * 32_768
        bits[start : start + 32_768] = np.unpackbits(np.frombuffer(bytes(row["bits"]), dtype=np.uint8), bitorder="little")
    packed = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    @F.pandas_udf("boolean")
    def may_be(places: pd.Series) -> pd.Series:
        p = places.to_numpy()
        return pd.Series((packed.value[p >> 3] >> (7 - (p & 7))) & 1 == 1)

    return docs.where(may_be(place("doc_id")))


def _links(docs: DataFrame, tasks: DataFrame, words: int, percent: int) -> DataFrame:
    """Links among the documents of ``tasks`` (``g, i, j`` name a task; ``side``; ``doc``), whole sets compared."""
    texts = _among(docs, tasks.select("doc")).withColumnRenamed("doc_id", "doc")
    sets = tasks.join(texts, "doc").select("g", "i", "j", "side", "doc", "text")
    dealt = sets.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "side", "doc")
    return cut(dealt.mapInPandas(_verify(words, percent), "a long, b long").distinct())


def _pivot_tasks(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's pivot against its other documents, those of one pivot together."""
    coded = lists.withColumn("code", F.xxhash64("doc_id"))
    # Kept, so that the join meets two plain tables and Spark can split a long list.
    lowest = cut(coded.groupBy("shingle").agg(F.min_by("doc_id", "code").alias("a"), F.min_by("n", "code").alias("m")))
    fits = (100 * F.col("n") >= percent * F.col("m")) & (100 * F.col("m") >= percent * F.col("n"))
    pairs = cut(lists.join(lowest, "shingle").where(fits & (F.col("a") != F.col("doc_id"))).select("a", F.col("doc_id").alias("b")).distinct())
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    none = F.lit(0).cast("long")
    others = pairs.join(blocks, "a").select(F.col("a").alias("g"), F.pmod(F.xxhash64("b"), F.col("blocks")).alias("i"), none.alias("j"), F.lit(0).alias("side"), F.col("b").alias("doc"))
    pivots = blocks.select(F.col("a").alias("g"), F.explode(F.sequence(none, F.col("blocks") - 1)).alias("i"), none.alias("j"), F.lit(1).alias("side"), F.col("a").alias("doc"))
    return others.unionByName(pivots)


def _block_tasks(open_lists: DataFrame, rows: int) -> DataFrame:
    """All documents of a list of ``open_lists`` (of ``rows`` rows) against each other, by pairs of blocks of about ``BLOCK`` documents.

    Lists overlap, so those that share documents form a family, in which each pair is tested once. A family that would
    cost more pairs so than its lists do one by one (as a long chain of short lists would) goes list by list.
    """
    square = lambda c: F.col(c).cast("double") * F.col(c)
    slim = lambda df: in_few_tasks(df, rows)
    low = cut(slim(open_lists.groupBy("shingle").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n"))))
    links = cut(slim(open_lists.join(low, "shingle").select("doc_id", "low")))
    families = cut(components(links, "doc_id", "low").withColumnRenamed("root", "family"))
    members = families.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    lists = low.join(families, F.col("low") == F.col("node")).select("shingle", "n", "family")
    cost = lists.groupBy("family").agg(F.sum(square("n")).alias("cost")).join(members, "family")
    whole = square("members") <= F.col("cost")
    plan = lists.join(cost, "family").select("shingle", F.when(whole, F.col("family")).otherwise(F.col("shingle")).alias("g"), F.when(whole, F.col("members")).otherwise(F.col("n")).alias("size"))
    placed = slim(slim(open_lists.join(cut(slim(plan)), "shingle").select("g", "size", "doc_id")).distinct())
    blocks = F.ceil(F.col("size") / BLOCK)
    own = F.pmod(F.xxhash64("doc_id"), blocks)
    dealt = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    return dealt.select("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), F.col("doc_id").alias("doc"))


def _lists(texts: DataFrame, reps: DataFrame, hot: list[int], words: int, percent: int) -> DataFrame:
    """``shingle, doc_id, n``: lists of documents with a shingle in their prefixes, of equal lists one."""
    total = reps.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_partitions(texts.sparkSession), total // 4 // BUCKET)
    late = np.sort(np.array(hot, dtype=np.int64).view(np.uint64))
    postings = keep(texts.mapInPandas(_postings(words, percent, buckets, late), "bucket long, shingles array<long>, docs array<long>"))
    flat = lambda bucket: postings.where(F.col("bucket") == bucket).select(F.explode(F.arrays_zip("shingles", "docs")).alias("x")).select(F.col("x.shingles").alias("shingle"), F.col("x.docs").alias("doc_id"))
    shared = postings.where("bucket >= 0").groupBy("bucket").applyInPandas(_shared, "shingle long, doc_id long, df long")
    sizes = flat(-2).groupBy("doc_id").agg(F.max("shingle").alias("sizes"))
    # A partition emits the copy that it meets first; of a class's emitted copies one counts, under the representative's id.
    one_of = F.min(F.struct("doc_id", (-F.col("n")).alias("minus_n"), "sizes")).alias("x")
    whole = reps.join(sizes, "doc_id").groupBy("rep").agg(one_of).select("rep", "x.doc_id", (-F.col("x.minus_n")).alias("n"), "x.sizes")
    held = shared.unionByName(flat(-1).withColumn("df", F.lit(_HOT).cast("long"))).join(whole, "doc_id").drop("doc_id").withColumnRenamed("rep", "doc_id")
    group = F.when(F.col("df") == _HOT, 2).when(F.col("shingle").bitwiseAND(3) != 0, 1).otherwise(0)
    held = held.withColumns({"group": group, "n_first": F.col("sizes").bitwiseAND(F.lit((1 << 32) - 1)), "n_other": F.shiftright("sizes", 32)})
    own = Window.partitionBy("doc_id", "group")
    rank = F.row_number().over(own.orderBy("df", "shingle")) - 1
    # A group's shingles that no other document holds come first in it; they are its size without those counted here.
    up_to = F.when(F.col("group") == 0, F.col("n_first")).when(F.col("group") == 1, F.col("n_first") + F.col("n_other")).otherwise(F.col("n"))
    place = up_to - F.count(F.lit(1)).over(own) + rank
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    kept = cut(held.withColumn("place", place).where(F.col("place") < prefix).select("shingle", "doc_id", "n"))
    discard(postings)
    code = F.xxhash64("doc_id")
    marks = ("docs", "low", "high", "x", "s")
    found = kept.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.bit_xor(code).alias("x"), F.sum(F.pmod(code, F.lit(1 << 40))).alias("s"))
    one = found.where("docs > 1").groupBy(*marks).agg(F.min("shingle").alias("shingle")).select("shingle", "docs")
    return cut(kept.join(one, "shingle"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Documents link when their sets of distinct ``words``-word shingles have a Jaccard similarity of at least
    ``percent`` / 100 (as whole numbers, so ties count); ``component_id`` is the smallest id that links lead to. A text
    of fewer words is one shingle; null, empty and blank texts have none and link with nothing. The id names the
    document: rows that repeat it with one text are one document, and rows with a null id have the component of a
    document of equal shingles, or null. An empty table gives an empty result; extra columns are ignored.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    profile = cut(texts.mapInPandas(_profiles(words), "doc_id long, n long, sign_a long, sign_b long, hot array<long>, hot_docs array<long>"))
    least = cut(profile.where("n > 0 and doc_id is not null").groupBy("sign_a", "sign_b", "n").agg(F.min("doc_id").alias("rep")))
    reps = cut(profile.drop("hot", "hot_docs").join(least, ["sign_a", "sign_b", "n"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")))
    count = reps.count()
    locally = profile.where("size(hot) > 0").select(F.explode(F.arrays_zip("hot", "hot_docs")).alias("x"))
    # At most 1 / HOT_SHARE times the mean size of a set, whatever the number of documents.
    hot = locally.groupBy("x.hot").agg(F.sum("x.hot_docs").alias("n")).where(F.col("n") >= max(32, HOT_SHARE * count)).collect()
    lists = _lists(texts, reps, [r["hot"] for r in hot], words, percent)

    links = _links(texts, cut(_pivot_tasks(lists, percent)), words, percent)
    roots = cut(components(links, "a", "b"))
    # A list of two has no other pair than the one that was tested.
    rooted = lists.where("docs > 2").join(roots, F.col("doc_id") == F.col("node"), "left")
    placed = cut(rooted.select("shingle", "doc_id", F.coalesce("root", "doc_id").alias("root")))
    state = cut(placed.groupBy("shingle").agg(F.min("root").alias("r1"), F.max("root").alias("r2"), F.count(F.lit(1)).alias("docs")).where("r1 != r2").select("shingle", "docs"))
    rows = state.agg(F.sum("docs")).first()[0]
    if rows:
        open_lists = cut(in_few_tasks(placed.select("shingle", "doc_id").join(state.select("shingle"), "shingle"), rows))
        more = _links(texts, cut(_block_tasks(open_lists, rows)), words, percent)
        if not more.isEmpty():
            roots = cut(components(links.unionByName(more), "a", "b"))
    out = reps.join(roots, F.col("rep") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("component_id"))


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay when each connected group keeps the document of its smallest id, with all columns.

    Rows with a null id and rows without words stay. Rows that repeat the id stay together.
    """
    gone = similar_groups(docs, id_col, text_col, words, percent).where("doc_id != component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
