"""Evaluation passages inside training text (problem 9): a BM25 inverted index of the test items, searched by block-max WAND.

Terms are runs of three words (Chinese and Japanese: characters); items shorter than that are terms by themselves. Every passage of every text
is a query, and all items that reach the threshold are wanted, so the threshold stands from the start. Posting lists are cut into blocks of
neighbouring items with the block's largest weight. For all queries of a batch at once the pivots are found: the blocks at which the maxima of a
query's lists reach the threshold together; all between them is skipped unread. In a pivot block the items are scored, and
what reaches the threshold is aligned with the item in order.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.forms import invisible, same_sign

#: Most words per term, BM25's k1 and b, least share of an item's own score, least share of the item in one stretch, and least share of
#: the stretch that equal terms cover (of every four words one may be replaced).
N, K1, B, THRESHOLD, SHARE, COVER = 3, 1.2, 0.75, 0.16, 0.5, 0.5
#: Neighbouring items per block of a posting list.
WIDE = 8
#: Most words between two terms of one stretch, and most by which inserted or dropped words may shift the next term.
GAP, SHIFT = 16, 6
#: Most rows whose index is sent to the executors; beyond it the items are searched in blocks of this many.
BLOCK = 20_000

_TAG = re.compile(r"<!--.*?-->|<[/!?]?[A-Za-z][^<>]*>|<[^<>]{0,300}>|&#?\w{1,10};", re.S)
U = np.uint64
MIX, STEP = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


@functools.cache
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: its letter or digit in one form (0: none, 1: to be skipped), and whether it is a word by itself."""
    form = np.zeros(0x110000, np.uint32)
    same, inv = same_sign(), invisible()
    for c in [*range(0x3134B), *range(0xE0000, 0xE01F0)]:
        ch = chr(c)
        if 0x4E00 <= c < 0xA000 or 0x3400 <= c < 0x4DC0 or 0x20000 <= c < 0x2F800 or 0xAC00 <= c < 0xD7A4:
            form[c] = c
            continue
        if ch in inv or unicodedata.category(ch)[0] == "M":
            form[c] = 1
            continue
        ch = same.get(ch, ch)[:1]
        if ch and unicodedata.category(ch)[0] in "LN":
            # accents go with the marks, so composed and decomposed letters are one
            low = ch.lower()[:1]
            form[c] = ord(unicodedata.normalize("NFD", low)[0]) if ord(low) < 0x3000 else ord(low)
    single = np.zeros(0x110000, bool)
    for a, b in ((0x2E80, 0x2FE0), (0x3041, 0x3100), (0x3400, 0xA000), (0xF900, 0xFB00), (0x20000, 0x31350)):
        single[a:b] = True
    return form, single


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words start (one more than texts). Markup is no word."""
    form, single = _alphabet()
    plain = [_TAG.sub(" ", t) if t and ("<" in t or "&" in t) else t or "" for t in texts]
    codes = form[np.frombuffer("\0".join([*plain, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum([len(t) + 1 for t in plain])
    keep = codes != 1
    at = np.cumsum(keep)
    codes = codes[keep]
    ends = at[ends - 1] if len(ends) else ends
    alnum = codes != 0
    alone = single[codes]
    start = alnum.copy()
    start[1:] &= ~alnum[:-1] | alone[1:] | alone[:-1]
    begin = np.flatnonzero(start)
    if not len(begin):
        return np.zeros(0, U), np.zeros(len(texts) + 1, np.int64)
    idx = np.flatnonzero(alnum)
    first = np.cumsum(start)[idx] - 1
    pos = (idx - begin[first]).astype(U)
    x = (codes[idx].astype(U) + U(0x1234567)) * MIX
    x ^= x >> U(29)
    x *= (pos * U(2) + U(1)) * STEP
    x ^= x >> U(31)
    local = np.searchsorted(idx, begin)
    h = np.add.reduceat(x, local)
    return h, np.concatenate([[0], np.searchsorted(begin, ends)])


def terms(h: np.ndarray, n: int = N) -> np.ndarray:
    """Hash of the n words from each on."""
    if len(h) < n:
        return np.zeros(0, U)
    g = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        g *= STEP
        g += h[k : len(h) - n + 1 + k]
        g ^= g >> U(32)
    return g


def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for n places each, one after the other."""
    return np.repeat(begin - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


class Part:
    """Posting lists of items of like length, cut into blocks. A query is two strides of text, and two strides are no shorter than an item, so
    that half an item's length of any stretch is in one query."""

    def __init__(self, items: np.ndarray, stride: int, n_terms: int, term: np.ndarray, item: np.ndarray, weight: np.ndarray) -> None:
        self.items, self.stride = items, stride
        local = np.searchsorted(items, item)
        order = np.lexsort((local, term))
        term, self.item, self.weight = term[order], local[order], weight[order]
        block = self.item // WIDE
        self.blocks = -(-len(items) // WIDE)
        new = np.append(True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])) if len(term) else np.zeros(0, bool)
        self.begin = np.flatnonzero(new)
        self.end = np.append(self.begin[1:], len(term))
        self.block = block[self.begin]
        self.top = np.maximum.reduceat(self.weight, self.begin) if len(term) else np.zeros(0)
        self.lists = np.searchsorted(term[self.begin], np.arange(n_terms + 1))

    def pivots(self, cell: np.ndarray, k: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Queries x blocks: where the maxima of the query's lists reach the threshold. A query is a cell with the next one unless it is the text's last."""
        n = self.lists[k + 1] - self.lists[k]
        e = _spread(self.lists[k], n)
        bound = np.bincount(np.repeat(cell, n) * self.blocks + self.block[e], self.top[e], minlength=len(last) * self.blocks).reshape(len(last), self.blocks)
        both = bound.copy()
        both[:-1][~last[:-1]] += bound[1:][~last[:-1]]
        return both >= THRESHOLD

    def matches(self, cell: np.ndarray, k: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, item, score) of all that reach the threshold; postings outside pivot blocks are not read. cell, k: distinct and sorted."""
        pivot = self.pivots(cell, k, last)
        live = np.flatnonzero(pivot.any(axis=1))
        if not len(live):
            return live, live, np.zeros(0)
        edge = np.searchsorted(cell, np.arange(len(last) + 1))
        hi = np.where(last[live], edge[live + 1], edge[np.minimum(live + 2, len(last))])
        n = hi - edge[live]
        qk = _distinct(np.repeat(np.arange(len(live)), n) * len(self.lists) + k[_spread(edge[live], n)])
        q, t = qk // len(self.lists), qk % len(self.lists)
        n = self.lists[t + 1] - self.lists[t]
        q, e = np.repeat(q, n), _spread(self.lists[t], n)
        read = pivot[live[q], self.block[e]]
        q, e = q[read], e[read]
        n = self.end[e] - self.begin[e]
        post = _spread(self.begin[e], n)
        sums = np.bincount(np.repeat(q, n) * len(self.items) + self.item[post], self.weight[post], minlength=len(live) * len(self.items))
        hit = np.flatnonzero(sums >= THRESHOLD)
        return live[hit // len(self.items)], self.items[hit % len(self.items)], sums[hit]


class Section:
    """All items whose terms have n words."""

    def __init__(self, n: int, items: np.ndarray, words: list[np.ndarray]) -> None:
        self.n = n
        per = [np.unique(terms(words[i], n), return_counts=True) for i in items]
        size = np.array([len(words[i]) for i in items])
        t = np.concatenate([p[0] for p in per])
        tf = np.concatenate([p[1] for p in per]).astype(float)
        who = np.repeat(np.arange(len(items)), [len(p[0]) for p in per])
        self.term, k, df = np.unique(t, return_inverse=True, return_counts=True)
        idf = np.log(1 + (len(items) - df + 0.5) / (df + 0.5))
        w = idf[k] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[who] / size.mean()))
        w /= np.bincount(who, w)[who]  # shares of the item's own score
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.term >> U(42)).astype(np.int64)] = True
        # classes of length, four to an octave, so that a query is not much longer than its items
        step = 1 << np.maximum(0, np.ceil(np.log2(size)).astype(int) - 4)
        stride = np.maximum(4, -(-size // (2 * step)) * step)
        self.parts = []
        for s in np.unique(stride).tolist():
            own = stride[who] == s
            self.parts.append(Part(items[stride == s], s, len(self.term), k[own], items[who[own]], w[own]))

    def lookup(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of terms that the index has, and which term."""
        at = np.flatnonzero(self.bits[(g >> U(42)).astype(np.int64)])
        k = np.searchsorted(self.term, g[at])
        k[k == len(self.term)] = 0
        ok = self.term[k] == g[at]
        return at[ok], k[ok]


class Index:
    """The inverted index of one block of items: items without a word are never found."""

    def __init__(self, ids: np.ndarray, words: list[np.ndarray]) -> None:
        self.ids, self.words = ids, words
        n = np.minimum([len(w) for w in words], N).astype(int) if words else np.zeros(0, int)
        self.sections = [Section(k, np.flatnonzero(n == k), words) for k in range(1, N + 1) if (n == k).any()]
        self.places: dict[int, dict[int, list[int]]] = {}

    def stretch(self, item: int, at: np.ndarray, g: np.ndarray) -> float:
        """Largest share of the item's words that the text holds in one stretch and in order; g: terms found at positions."""
        n = min(N, len(self.words[item]))
        if item not in self.places:
            here: dict[int, list[int]] = {}
            for j, x in enumerate(terms(self.words[item], n).tolist()):
                here.setdefault(x, []).append(j)
            self.places[item] = here
        here, best, most = self.places[item], {}, 0
        for k, x in zip(at.tolist(), g.tolist()):
            for j in here.get(x, ()):
                d, start, cover = j - k, j, n
                for e in range(d - SHIFT, d + SHIFT + 1):
                    c = best.get(e)
                    if c and 0 < k - c[0] <= GAP and 0 < j - c[1] <= GAP and c[3] + min(n, j - c[1]) > cover:
                        start, cover = c[2], c[3] + min(n, j - c[1])
                c = best.get(d)
                if not c or c[0] != k:
                    best[d] = (k, j, start, cover)
                if cover >= COVER * (j + n - start):
                    most = max(most, j + n - start)
        return most / max(1, len(self.words[item]))

    def search(self, texts: list[str | None]) -> list[tuple[int, int, float, float]]:
        """(text, item, score, share) of every text that holds enough of an item; score as a share of the item's own."""
        h, begin = words(texts)
        size = np.diff(begin)
        found: dict[tuple[int, int], tuple[float, float]] = {}
        for sec in self.sections:
            g = terms(h, sec.n)
            at, k = sec.lookup(g)
            doc = np.searchsorted(begin, at, side="right") - 1
            ok = at + sec.n <= begin[doc + 1]
            at, k, doc = at[ok], k[ok], doc[ok]
            local = at - begin[doc]
            for part in sec.parts:
                cells = size // part.stride + 1
                base = np.append(0, np.cumsum(cells))  # cells are numbered through all texts
                last = np.zeros(base[-1], bool)
                last[base[1:] - 1] = True
                owner = np.repeat(np.arange(len(size)), cells)
                own = part.lists[k + 1] > part.lists[k]
                u = _distinct((base[doc[own]] + local[own] // part.stride) * len(sec.term) + k[own])
                for q, item, score in zip(*(x.tolist() for x in part.matches(u // len(sec.term), u % len(sec.term), last))):
                    d = int(owner[q])
                    if found.get((d, item), (0, 0))[1] < SHARE:
                        # a stretch may begin before the query and end after it
                        a = int(begin[d] + (q - base[d]) * part.stride)
                        lo, hi = np.searchsorted(at, [max(a - 2 * part.stride, begin[d]), min(a + 4 * part.stride, begin[d + 1])])
                        share = self.stretch(item, at[lo:hi], g[at[lo:hi]])
                        if share > found.get((d, item), (0, -1))[1]:
                            found[d, item] = (score, share)
        return [(d, i, s, share) for (d, i), (s, share) in found.items() if share >= SHARE]


def find_leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", text: str = "text", item_key: str = "item_id", passage: str = "passage") -> DataFrame:
    """The texts that hold a test item's passage: ``<doc_key>, <item_key>, score, share``.

    score is the BM25 score as a share of the item's own, share the part of the passage in one stretch and in order. Case, width,
    punctuation, blanks, line ends, markup, accents and single replaced, inserted or dropped words do not matter: of any four neighbouring
    words one may be another. Whole texts are read, in queries as long as the items of a length class that overlap by half. The corpus is
    read once per BLOCK items, without a shuffle; only the index of a block is broadcast. Null and empty texts hold nothing; items
    without a word are never found, items of one or two words where they stand in full; repeated rows give repeated results; empty tables give
    an empty result.
    """
    spark = docs.sparkSession
    rows = items.where(f"`{passage}` is not null").select(item_key, passage).distinct().orderBy(item_key, passage)
    schema = f"`{doc_key}` {docs.schema[doc_key].dataType.simpleString()}, `{item_key}` {items.schema[item_key].dataType.simpleString()}, score double, share double"
    out, block = None, []

    def one(block: list) -> DataFrame:
        h, begin = words([r[1] for r in block])
        shared = spark.sparkContext.broadcast(Index(np.array([r[0] for r in block]), [h[a:b] for a, b in zip(begin, begin[1:])]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            most = max(100_000, 2_000_000 * 256 // max(256, len(index.ids)))  # characters at a time, so that bounds of all blocks fit
            for b in batches:
                texts, size, lo = b.column(1).to_pylist(), 0, 0
                for i, t in enumerate(texts):
                    size += len(t or "")
                    if size > most or i == len(texts) - 1:
                        hits = index.search(texts[lo : i + 1])
                        yield pa.record_batch(
                            [b.column(0).take(pa.array([lo + d for d, *_ in hits], pa.int64())), pa.array([index.ids[x[1]].item() for x in hits], item_type), pa.array([x[2] for x in hits], pa.float64()), pa.array([x[3] for x in hits], pa.float64())],
                            names=[doc_key, item_key, "score", "share"],
                        )
                        size, lo = 0, i + 1

        return docs.select(doc_key, text).mapInArrow(run, schema)

    from pyspark.sql.pandas.types import to_arrow_type

    item_type = to_arrow_type(items.schema[item_key].dataType)
    for r in rows.toLocalIterator():
        block.append(r)
        if len(block) == BLOCK:
            out, block = (one(block) if out is None else out.unionByName(one(block))), []
    return one(block) if out is None else out.unionByName(one(block)) if block else out
