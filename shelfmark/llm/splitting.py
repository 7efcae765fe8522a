"""Cutting oversized texts at natural boundaries (problem 10): structure-tree packing.

Headings, blocks, list items, lines and sentences form a tree over the text's tokens. A node that fits stays whole. One that does not is opened,
and from the bottom up its subtrees, or what an opened subtree came to, are merged with their neighbours up to the limit; so the tail of an
opened node goes with the sibling after it, and no two neighbouring pieces would fit together. Clauses, words and at last single
tokens are looked for only inside a sentence that is itself too large.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.tokens import VOCABULARY, Tokenizer, share, tokenizer

#: Kinds of boundary from the strongest on; a heading of level 1 to 6 is as strong as its level.
KINDS = ("text", "heading1", "heading2", "heading3", "heading4", "heading5", "heading6", "block", "item", "line", "sentence", "clause", "word", "token")
BLOCK, ITEM, LINE, SENTENCE, CLAUSE, WORD, TOKEN = range(7, 14)

_HEADING = re.compile(r"[ \t]*(\#{1,6}) |[ \t　]*(?:Chapter|Part|Kapitel|Teil|Глава|Часть) \d+\b[^a-z]*$|[ \t　]*第[0-9一二三四五六七八九十百]+[章节節回卷].{0,40}$")
_ITEM = re.compile(r"[ \t　]*(?:[-*+•]|\d{1,4}[.)、])[ \t]")
_TAG = re.compile(r"<(/?)(h[1-6]|p|div|table|ul|ol|section|blockquote|li|tr|br)\b[^<>]*>", re.I)
_ENDS = re.compile(r"[.!?。！？…]+[\"'”’»)\]」』）]*\s?")
_WIDE_ENDS = frozenset("。！？…")
_CLAUSES = re.compile(r"[,;:–—]\s|[，；：、]")
_WORDS = re.compile(r"\s+")


def boundaries(text: str) -> tuple[list[int], list[int]]:
    """Inner boundaries: the character each lies before, and its kind; not sorted, and repeated where several meet.

    Headings and items begin at their line or opening tag; blocks end at a blank line or closing tag; lines and sentences at
    their ends. A full stop ends a sentence only before white space.
    """
    at, kind = [], []
    pos, empty = 0, False
    for line in text.split("\n"):
        end = pos + len(line) + 1
        bare = line.strip()
        if not bare:
            empty = True
        else:
            if empty:
                at.append(pos)
                kind.append(BLOCK)
                empty = False
            head = bare[0]
            if head in "#CPKTГЧ第" and (m := _HEADING.match(line)):
                at.append(pos)
                kind.append(len(m[1]) if m[1] else 1)
            elif head in "-*+•0123456789" and _ITEM.match(line):
                at.append(pos)
                kind.append(ITEM)
        at.append(end)
        kind.append(LINE)
        pos = end
    if "<" in text:
        for m in _TAG.finditer(text):
            name = m[2].lower()
            if name[0] == "h" and len(name) == 2:
                at.append(m.end() if m[1] else m.start())
                kind.append(BLOCK if m[1] else int(name[1]))
            elif name == "br" or (m[1] and name in ("li", "tr")):
                at.append(m.end())
                kind.append(LINE)
            else:
                at.append(m.end() if m[1] else m.start())
                kind.append(ITEM if name in ("li", "tr") else BLOCK)
    for m in _ENDS.finditer(text):
        e = m.end()
        if text[e - 1].isspace() or text[m.start()] in _WIDE_ENDS:
            at.append(e)
            kind.append(SENTENCE)
    return at, kind


class Tree:
    """One text's boundaries on its tokens."""

    def __init__(self, text: str, starts: np.ndarray) -> None:
        self.text, self.starts = text, starts
        self.at, self.kind = self._on_tokens(*boundaries(text), 0, len(starts) - 1)

    def _on_tokens(self, at: list[int], kind: list[int], lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """The token boundary at or after each character, strongest kind first where several meet."""
        a, k = np.array(at, np.int64), np.array(kind, np.int64)
        t = np.searchsorted(self.starts, a, "right") - 1
        t = np.where(self.starts[t] < a, np.minimum(t + 1, len(self.starts) - 1), t)
        t = np.searchsorted(self.starts, self.starts[t], "right") - 1  # not inside a character
        ok = (t > lo) & (t < hi)
        t, k = t[ok], k[ok]
        order = np.lexsort((k, t))
        t, k = t[order], k[order]
        first = np.append(True, t[1:] != t[:-1]) if len(t) else np.zeros(0, bool)
        return t[first], k[first]

    def cut(self, limit: int, first: int | None = None) -> list[tuple[int, int, int]]:
        """Ranges of at most ``limit`` tokens that follow each other, with the kind of the boundary each begins at; ``first`` is the limit of the first one."""
        return self._pack(0, len(self.starts) - 1, 0, self.at, self.kind, limit, first or limit)

    @staticmethod
    def _merge(units: list[tuple[int, int, int]], limit: int, first: int) -> list[tuple[int, int, int]]:
        """Neighbours joined from left to right while they fit; afterwards no two neighbours would."""
        out = [units[0]]
        for lo, hi, kind in units[1:]:
            a, b, begin = out[-1]
            if hi - a <= (limit if a else first):
                out[-1] = (a, hi, begin)
            else:
                out.append((lo, hi, kind))
        return out

    def _pack(self, lo: int, hi: int, own: int, at: np.ndarray, kind: np.ndarray, limit: int, first: int) -> list[tuple[int, int, int]]:
        if hi - lo <= (limit if lo else first):
            return [(lo, hi, own)]
        if not len(at):
            return self._finer(lo, hi, own, limit, first)
        level = int(kind.min())
        top = np.flatnonzero(kind == level)
        edges = [lo, *at[top].tolist(), hi]
        units: list[tuple[int, int, int]] = []
        for i in range(len(edges) - 1):
            a, b = (int(top[i - 1]) + 1 if i else 0), (int(top[i]) if i < len(top) else len(at))
            units += self._pack(edges[i], edges[i + 1], level if i else own, at[a:b], kind[a:b], limit, first)
        return self._merge(units, limit, first)

    def _finer(self, lo: int, hi: int, own: int, limit: int, first: int) -> list[tuple[int, int, int]]:
        """Inside a node without boundaries: clauses, else words, else tokens."""
        a, b = int(self.starts[lo]), int(self.starts[hi])
        part = self.text[a:b]
        for rx, k in ((_CLAUSES, CLAUSE), (_WORDS, WORD)):
            cuts = [a + m.end() for m in rx.finditer(part)]
            at, kind = self._on_tokens(cuts, [k] * len(cuts), lo, hi)
            if len(at):
                return self._pack(lo, hi, own, at, kind, limit, first)
        out, begin = [], own
        while hi - lo > (most := limit if lo else first):
            end = lo + most
            while end > lo + 1 and self.starts[end] == self.starts[end + 1]:  # not inside a character
                end -= 1
            if self.starts[end] == self.starts[min(end + 1, hi)]:
                end = lo + most
            out.append((lo, end, begin))
            lo, begin = end, TOKEN
        return [*out, (lo, hi, begin)]


def pieces(text: str, t: Tokenizer, limits: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, int, int, int]]:
    """(limit, number, first token, end token, shared tokens, first character, end character, kind) of each piece."""
    ids = t.encode(text)
    n = len(ids)
    if n <= min((c for _, c, _ in limits), default=n):
        return []
    starts = t.starts(text, ids)
    tree, out = Tree(text, starts), []
    for name, capacity, overlap in limits:
        if n > capacity:
            # the first piece shares nothing, so it may be as long as the capacity; it is then never shorter than the overlap
            for no, (lo, hi, kind) in enumerate(tree.cut(capacity - overlap, capacity)):
                a = lo - (overlap if no else 0)
                out.append((name, no, a, hi, lo - a, int(starts[a]), int(starts[hi]), kind))
    return out


def split_documents(docs: DataFrame, limits: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: str = "limit_id", capacity: str = "capacity_tokens", overlap: str = "overlap_tokens", with_text: bool = False) -> DataFrame:
    """The pieces of every text over a capacity, in order: ``limit, key, piece, start_token, end_token, shared_tokens, start_char, end_char, begins_at``.

    A piece is a range of the text's tokens, at most ``capacity`` long; each but the first begins with the last ``overlap`` tokens
    of the one before. Without these shared tokens the pieces follow each other and make up the whole text. Characters count code points;
    ``begins_at`` names the boundary at which the piece's own tokens begin. with_text adds the piece's characters. Texts within a
    capacity are not cut and have no row for it; null and empty texts have none. Row by row, whole texts, each tokenised
    once for all limits, without a shuffle; repeated rows give repeated pieces. An overlap not below its capacity is an error.
    """
    lim = [tuple(int(x) for x in r) for r in limits.where(f"`{capacity}` > 0").select(limit, capacity, overlap).na.fill(0).distinct().orderBy(limit).collect()]
    for name, c, o in lim:
        if not 0 <= o < c:
            raise ValueError(f"limit {name}: the overlap {o} is not below the capacity {c}")
    shared = share(docs.sparkSession, vocabulary)
    names = [limit, key, "piece", "start_token", "end_token", "shared_tokens", "start_char", "end_char", "begins_at"] + ["text"] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(shared)
        least = min((c for _, c, _ in lim), default=0)
        for b in batches:
            rows, own, parts = [], [], []
            for i, x in enumerate(b.column(1).to_pylist()):
                # a token has at least one byte, so a text of fewer bytes has no more tokens
                if x and lim and len(x) * 4 > least:
                    got = pieces(x, t, lim)
                    rows += got
                    own += [i] * len(got)
                    if with_text:
                        parts += [x[p[5] : p[6]] for p in got]
            c = list(zip(*rows)) or [[]] * 8
            kinds = pa.array([KINDS[k] for k in c[7]], pa.string())
            yield pa.record_batch([pa.array(c[0], pa.int64()), b.column(0).take(pa.array(own, pa.int64())), pa.array(c[1], pa.int32()), *(pa.array(c[j], pa.int64()) for j in range(2, 7)), kinds, *([pa.array(parts, pa.string())] if with_text else [])], names=names)

    schema = f"`{limit}` bigint, `{key}` {docs.schema[key].dataType.simpleString()}, piece int, start_token bigint, end_token bigint, shared_tokens bigint, start_char bigint, end_char bigint, begins_at string" + ", text string" * with_text
    return docs.select(key, text).mapInArrow(run, schema)
