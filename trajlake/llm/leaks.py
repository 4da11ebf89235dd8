"""Passages of evaluation items inside documents (problem 7)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions.text import word_array, words

#: Bytes of item text that are looked for at once; more items take further passes over the documents.
ITEM_BYTES = 8 << 20
_MIX = np.uint64(0x100000001B3)


def myers(pattern: Sequence[int], text: Sequence[int]) -> int:
    """Least number of edits (of words) that turn the pattern into some stretch of the text; bit-parallel."""
    m = len(pattern)
    if not m:
        return 0
    peq: dict[int, int] = defaultdict(int)
    for i, x in enumerate(pattern):
        peq[x] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for x in text:
        eq = peq.get(x, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus, minus = (down | ~(horizontal | up)) & full, up & horizontal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = (minus | ~(vertical | plus)) & full, plus & vertical
        best = min(best, score)
    return best


class Pieces:
    """The items' pieces, for exact search. Items are (id, words), or (id, text)."""

    def __init__(self, items: Sequence[tuple[int, Sequence[str] | str]], passage: int, edits: int) -> None:
        self.passage, self.edits = passage, edits
        # so short that a passage with `edits` wrong words still holds one of edits + 1 whole pieces, wherever it begins
        self.size = (passage + 1) // (edits + 2)
        if self.size < 1:
            raise ValueError("a passage must be longer than the edits allow")
        self.ids: dict[str, int] = {}
        self.items: list[tuple[int, list[int]]] = []
        at = defaultdict(list)
        for item, own in items:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in (words(own) if isinstance(own, str) else own)]
            if len(w) < passage:
                continue
            for i in range(0, len(w) - self.size + 1, self.size):
                at[tuple(w[i : i + self.size])].append((len(self.items), i))
            self.items.append((item, w))
        self.at = dict(at)
        self.codes = np.unique(self.code(np.array(list(self.at), np.uint64).reshape(-1, self.size)))

    def code(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams), np.uint64)
        for k in range(self.size):
            out = (out ^ grams[:, k]) * _MIX + (out >> np.uint64(31))
        return out

    def numbers(self, distinct: Sequence[str]) -> np.ndarray:
        """The items' number of each word, 0 for words that no item has."""
        return np.fromiter((self.ids.get(x, 0) for x in distinct), np.int64, len(distinct))

    def hits(self, w: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Where in the words of many texts, one behind the other, a piece of an item stands (or words with its code)."""
        n = len(w) - self.size + 1
        if n < 1 or not len(self.codes):
            return np.empty(0, np.int64)
        whole = owner[:n] == owner[self.size - 1 :]
        for k in range(self.size):
            whole &= w[k : k + n] > 0
        at = np.flatnonzero(whole)
        code = self.code(np.lib.stride_tricks.sliding_window_view(w.astype(np.uint64), self.size)[at])
        return at[self.codes[np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)] == code]

    def find_all(self, w: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, words of its longest exact run, place of that run's first word) of each item found in each text."""
        hit = self.hits(w, owner)
        out = []
        for text, at in zip(*_parts(owner[hit], hit)) if len(hit) else ():
            begin, end = np.searchsorted(owner, [text, text + 1])
            out += [(int(text), *x) for x in self._verified(w[begin:end].tolist(), (at - begin).tolist())]
        return out

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """The same for one text."""
        own = self.numbers(words(text))
        return [x[1:] for x in self.find_all(own, np.zeros(len(own), np.int64))]

    def _verified(self, w: list[int], hit: list[int]) -> list[tuple[int, int, int, int]]:
        best: dict[int, tuple[int, int, int]] = {}
        done: dict[tuple[int, int], int] = {}
        for j in hit:
            for n, i in self.at.get(tuple(w[j : j + self.size]), ()):
                if done.get((n, j - i), -1) >= j:
                    continue  # within a run on the same diagonal that is known already
                item, p = self.items[n]
                lo, hi = 0, self.size
                while i - lo > 0 and j - lo > 0 and p[i - lo - 1] == w[j - lo - 1]:
                    lo += 1
                while i + hi < len(p) and j + hi < len(w) and p[i + hi] == w[j + hi]:
                    hi += 1
                done[n, j - i] = j + hi - self.size
                run = lo + hi
                edits = 0 if run >= self.passage else self._edits(p, w, i, j) if self.edits else None
                if edits is not None:
                    best[item] = min(best.get(item, (99, 0, 0)), (edits, -run, j - lo))
        return [(item, e, -r, at) for item, (e, r, at) in best.items()]

    def _edits(self, p: list[int], w: list[int], i: int, j: int) -> int | None:
        """Least edits, if few enough, of a passage that holds the piece at i against the words around j."""
        found, first, last = self.edits + 1, max(0, i + self.size - self.passage), min(i, len(p) - self.passage)
        # a passage with so few edits has nearly all its words nearby; most hits of a piece do not
        near = set(w[max(0, j - (i - first) - self.edits) : j - (i - last) + self.passage + self.edits])
        there = [x in near for x in p[first : last + self.passage]]
        for s in range(first, last + 1):
            if sum(there[s - first : s - first + self.passage]) < self.passage - self.edits:
                continue
            a = max(0, j - (i - s) - self.edits)
            found = min(found, myers(p[s : s + self.passage], w[a : j - (i - s) + self.passage + self.edits]))
        return found if found <= self.edits else None


def _parts(owner: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The owners in order, and the values of each."""
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    return owner[first], np.split(values, first[1:])


def find_leaks(documents: DataFrame, items: DataFrame, *, doc: str = "doc_id", item: str = "item_id", text: str = "text", passage: int = 12, edits: int = 1) -> DataFrame:
    """doc_id, item_id, edits, run_words, at_word: documents that hold a passage of an item with at most `edits` words changed.

    A passage is any `passage` words of an item in a row. Items are cut into pieces so short that a passage with its
    error budget keeps one whole piece; every piece is looked up at every word of every document, and each hit is
    verified on the spot: first by the exact run around it (edits 0 if that has `passage` words), else by Myers'
    bit-parallel distance over words. `run_words` is the longest exact run at the best hit, `at_word` where it starts.

    Items with fewer words than a passage, null and empty texts match nothing. Documents of any length are read whole;
    repeated document rows give one row. Items may be many: they are searched in blocks of bounded size, each in one
    pass over all documents, and no document leaves its task.
    """
    names = [doc, item, "edits", "run_words", "at_word"]
    clean = items.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("bigint").alias("i"), word_array(F.col(text)).alias("w"), F.octet_length(text).alias("n"))
    size = clean.agg(F.sum("n")).first()[0] or 0
    blocks = size // ITEM_BYTES + 1
    spark, out = documents.sparkSession, None
    source = documents.filter(F.col(doc).isNotNull() & F.col(text).isNotNull()).select(F.col(doc).cast("bigint").alias("d"), F.array_join(word_array(F.col(text)), " ").alias("t"))
    for n in range(blocks):
        part = clean.filter(F.pmod(F.xxhash64("i"), F.lit(blocks)) == n).collect() if blocks > 1 else clean.collect()  # bounded: about ITEM_BYTES
        shared = spark.sparkContext.broadcast(Pieces([(r["i"], r["w"]) for r in part], passage, edits))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            pieces = shared.value
            for b in batches:
                w = pc.split_pattern(b.column(1), " ")
                coded = w.flatten().dictionary_encode()
                numbers = pieces.numbers(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
                rows = pieces.find_all(numbers, np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(w))))
                if rows:
                    row, *cols = zip(*rows)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), *(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.int32())))], names)

        found = source.mapInArrow(run, f"`{doc}` bigint, `{item}` bigint, edits int, run_words int, at_word int")
        out = found if out is None else out.unionByName(found)
    return out.groupBy(doc, item).agg(F.min(F.struct("edits", (-F.col("run_words")).alias("r"), "at_word")).alias("b")).select(doc, item, "b.edits", (-F.col("b.r")).alias("run_words"), "b.at_word")
