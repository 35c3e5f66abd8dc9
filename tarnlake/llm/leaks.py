"""Held-out test items that stand, whole or in part and slightly changed, in documents.

Texts are compared by their letters and digits alone, in small letters, as UTF-8 bytes, by shingles of SHINGLE
bytes (about two words, or three Han characters), so that spacing, punctuation, case and words broken at line
ends don't matter. A shingle weighs one over the number of items that hold it: what items share says little.

Every window of WINDOW shingles of a document gets a 64-bit SimHash of those of its shingles that items know
(no other can match), as does every window of each item. An index of four 16-bit blocks finds all pairs of
windows at most RADIUS bits apart: two such fingerprints have a block that differs in RADIUS // 4 bits at most,
and all block values that near are looked up. The pair's document and item are then compared exactly, by the
weight of the item's shingles that the document holds.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.textunits import portions
from tarnlake.session import stage

SHINGLE, WINDOW, STRIDE, RADIUS = 9, 96, 8, 11
_ALNUM = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x100000001B3)
#: What to change in a block to get all values within RADIUS // 4 bits of it.
_FLIPS = np.array([sum(1 << a for a in c) for r in range(RADIUS // 4 + 1) for c in combinations(range(16), r)], np.int64)


def letters(text: str) -> bytes:
    """The letters and digits of ``text`` in small letters, as UTF-8."""
    return "".join(_ALNUM.findall(text.lower())).encode("utf-8", "surrogatepass")


def shingle_hashes(stream: np.ndarray) -> np.ndarray:
    """64-bit hash of the SHINGLE bytes from each place of a byte array."""
    n = len(stream) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = stream[:n].astype(np.uint64)
    for j in range(1, SHINGLE):
        h *= _BASE
        h += stream[j : j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class ItemIndex:
    """Shingles, weights and window fingerprints of some items; small enough to travel to every task.

    ``held_by``: (shingle hashes, ascending; number of items) of those shingles that more than one of all items holds,
    where the index is of a part of them; without it the given items are all.
    """

    FILTER = 1 << 22

    def __init__(self, ids: list[int], texts: list[str], threshold: float = 0.42, held_by: tuple[np.ndarray, np.ndarray] | None = None):
        self.threshold = threshold
        keep = [(i, s) for i, s in zip(ids, (shingle_hashes(np.frombuffer(letters(t), np.uint8)) for t in texts)) if len(s)]
        self.ids = np.array([i for i, _ in keep], np.int64)
        sets = [np.unique(s) for _, s in keep]
        self.known, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, int))
        if held_by is not None and len(self.known) and len(held_by[0]):
            at = np.minimum(np.searchsorted(self.known, held_by[0]), len(self.known) - 1)
            own = self.known[at] == held_by[0]
            n[at[own]] = held_by[1][own]
        self.weight = (1.0 / np.maximum(n, 1)).astype(np.float32)
        sizes = np.array([len(x) for x in sets], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.of_items = np.searchsorted(self.known, np.concatenate(sets)).astype(np.int32) if sets else np.zeros(0, np.int32)
        self.total = np.add.reduceat(self.weight[self.of_items], self.bounds[:-1]) if sets else np.zeros(0, np.float32)
        prints, owner = [], []
        for k, (_, s) in enumerate(keep):
            f = self.fingerprints(np.arange(len(s)), np.searchsorted(self.known, s), np.arange(0, max(1, len(s) - WINDOW + STRIDE), STRIDE))
            prints.append(f)
            owner += [k] * len(f)
        self.prints = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
        self.owner = np.array(owner, np.int32)
        self._tables: list | None = None
        self._bits: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"_tables": None, "_bits": None}

    def fingerprints(self, at: np.ndarray, idx: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """SimHash of the windows from ``starts``, of known shingles ``idx`` at ascending places ``at``.

        Each shingle adds its hash's 64 bits as +-weight; the sums are taken a piece at a time, so that they stay small.
        """
        out = np.zeros(len(starts), np.uint64)
        lo, hi = np.searchsorted(at, starts), np.searchsorted(at, starts + WINDOW)
        step = 1 << 13
        for a in range(0, len(starts), step):
            b = min(a + step, len(starts))
            first, last = lo[a:b].min(), hi[a:b].max()
            own = idx[first:last]
            bits = np.unpackbits(np.ascontiguousarray(self.known[own]).view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)
            sums = np.concatenate([np.zeros((1, 64)), np.cumsum((2 * bits - 1) * self.weight[own][:, None], axis=0)])
            out[a:b] = np.packbits(sums[hi[a:b] - first] - sums[lo[a:b] - first] > 0, axis=1).view(np.uint64).ravel()
        return out

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known shingles among hashes ``h`` and their numbers."""
        if self._bits is None:
            self._bits = np.zeros(self.FILTER, bool)
            self._bits[(self.known >> np.uint64(42)).astype(np.int64)] = True
        at = np.flatnonzero(self._bits[(h >> np.uint64(42)).astype(np.int64)])
        if not len(at):
            return at, at
        idx = np.minimum(np.searchsorted(self.known, h[at]), len(self.known) - 1)
        good = self.known[idx] == h[at]
        return at[good], idx[good]

    def tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each block: fingerprint numbers by block value, as (offsets, numbers)."""
        if self._tables is None:
            self._tables = []
            for b in range(4):
                block = ((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
                order = np.argsort(block, kind="stable").astype(np.int32)
                self._tables.append((np.searchsorted(block[order], np.arange((1 << 16) + 1)), order))
        return self._tables

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``prints``, number of item) of all pairs at most RADIUS bits apart, each once.

        Every block value within RADIUS // 4 bits is looked up, for some fingerprints at a time.
        """
        found = [np.zeros((0, 2), np.int64)]
        step = 1 << 9
        for a in range(0, len(prints), step):
            part = prints[a : a + step]
            for b, (offsets, who) in enumerate(self.tables()):
                block = ((part >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
                block = (block[:, None] ^ _FLIPS[None]).ravel()
                lo, n = offsets[block], offsets[block + 1] - offsets[block]
                w = np.repeat(np.repeat(np.arange(len(part)), len(_FLIPS)), n)
                f = who[np.arange(len(w)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
                close = np.bitwise_count(part[w] ^ self.prints[f]) <= RADIUS
                found.append(np.unique(np.stack([w[close] + a, self.owner[f[close]]], 1), axis=0))
        pair = np.unique(np.concatenate(found), axis=0)
        return pair[:, 0], pair[:, 1]

    def leaks(self, texts: list[str]) -> list[list[tuple[int, float]]]:
        """(item id, share of its weight held) of every item of which each text holds more than the threshold."""
        out: list[list[tuple[int, float]]] = [[] for _ in texts]
        if not len(self.known):
            return out
        streams = [letters(t) for t in texts]
        gap = b"\n" * (WINDOW + SHINGLE)  # no shingle or window spans two texts
        sizes = np.array([len(s) + len(gap) for s in streams])
        first = np.cumsum(sizes) - sizes
        at, idx = self.find(shingle_hashes(np.frombuffer(gap.join([*streams, b""]), np.uint8)))
        if not len(at):
            return out
        # windows that start at a multiple of STRIDE and hold a known shingle
        starts = np.unique(np.concatenate([(at // STRIDE - k) * STRIDE for k in range(WINDOW // STRIDE)]))
        starts = starts[starts >= 0]
        prints = self.fingerprints(at, idx, starts)
        # windows in a row often have the same fingerprint: each is looked up once
        distinct, which = np.unique(prints, return_inverse=True)
        order, (u, item) = np.argsort(which, kind="stable"), self.near(distinct)
        lo = np.searchsorted(which[order], u)
        n = np.searchsorted(which[order], u, "right") - lo
        w = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        item = np.repeat(item, n)
        text = np.searchsorted(first, starts[w] + WINDOW // 2, "right") - 1
        for t, k in np.unique(np.stack([text, item], 1), axis=0).tolist():
            a, b = np.searchsorted(at, [first[t], first[t] + sizes[t]])
            held = np.intersect1d(self.of_items[self.bounds[k] : self.bounds[k + 1]], idx[a:b])
            share = float(self.weight[held].sum() / self.total[k])
            if share > self.threshold:
                out[t].append((int(self.ids[k]), share))
        return out


def own_texts(items: DataFrame, shared_by: int = 3) -> DataFrame:
    """(item_id, t): the own text of each of ``items`` (item_id, item_text): without a first line that at least ``shared_by``
    items begin with, as such lines are general instructions. Of repeated ids the first text by order counts."""
    one = items.where("item_id is not null and item_text is not null").groupBy("item_id").agg(F.min("item_text").alias("t"))
    lines = F.split("t", "\n")
    one = one.withColumn("head", F.when(F.size(lines) > 1, F.regexp_replace(F.element_at(lines, 1), r"^\s+|\s+$", "")))
    general = one.where("head is not null").groupBy("head").agg(F.count("*").alias("n")).where(F.col("n") >= shared_by)
    # at most one in shared_by of the items is such a line
    return one.join(general, "head", "left").select("item_id", F.when(F.col("n").isNotNull(), F.expr("substring(t, instr(t, '\n') + 1)")).otherwise(F.col("t")).alias("t"))


def item_indexes(items: DataFrame, threshold: float = 0.42, part_bytes: int = 16 << 20):
    """Indexes of all ``items`` (item_id, item_text), each of a part of some ``part_bytes`` of text.

    What is sent to the tasks stays bounded however many items there are; weights count over all of them.
    Null and blank items are left out.
    """
    texts = stage(own_texts(items), "items")
    total = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n_parts = int(total // part_bytes) + 1
    texts = texts.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(n_parts)))

    @F.pandas_udf("array<long>")
    def shingles(ts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(np.frombuffer(letters(t), np.uint8))).view(np.int64) for t in ts])

    held = None
    if n_parts > 1:
        each = texts.select("part", F.explode(shingles("t")).alias("h"))
        many = each.groupBy("h").agg(F.count("*").alias("n"), F.collect_set("part").alias("parts")).where("n > 1")
        held = stage(many.select(F.explode("parts").alias("part"), "h", "n"), "held")
    for k in range(n_parts):
        got = texts.where(F.col("part") == k).select("item_id", "t").orderBy("item_id").collect()
        shared = None
        if held is not None:
            rows = held.where(F.col("part") == k).select("h", "n").toPandas()
            h = rows.h.to_numpy(np.int64).view(np.uint64)
            order = np.argsort(h)
            shared = h[order], rows.n.to_numpy()[order]
        yield ItemIndex([r[0] for r in got], [r[1] for r in got], threshold, shared)


def leaks_udf(index: ItemIndex):
    """Column function: array of (item_id, share) that a text holds; empty for null."""
    @F.pandas_udf("array<struct<item_id:long,share:double>>")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for part in portions(texts.fillna("").tolist(), 400_000):
            out += [[{"item_id": i, "share": s} for i, s in found] for found in index.leaks(part)]
        return pd.Series(out)

    return run


def find_leaks(documents: DataFrame, items: DataFrame, threshold: float = 0.42, part_bytes: int = 16 << 20) -> DataFrame:
    """(doc_id, item_id, share) of every item of which a document (doc_id, text) holds more than half.

    ``threshold`` is on the weight of shingles; it lies under one half because every changed word breaks the
    shingles around it. Null and blank texts hold nothing; an empty table of either kind gives no rows.
    Documents are read once for each ``part_bytes`` of item text.
    """
    texts = documents.where("doc_id is not null")
    parts = [texts.select("doc_id", F.explode(leaks_udf(index)("text")).alias("h")) for index in item_indexes(items, threshold, part_bytes)]
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "h.item_id").agg(F.max("h.share").alias("share"))
