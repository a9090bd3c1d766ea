"""Evaluation passages inside a corpus, by a Wu-Manber search over words.

Patterns are all windows of ``WINDOW`` consecutive words of the evaluation texts. Words are
64-bit hashes. The shift table holds, for each block of ``BLOCK`` words of a pattern, how far
the nearest window that the block can belong to ends behind it. Texts are probed only at
every ``WINDOW - BLOCK + 1``-th word, as each window covers exactly one such place: a block of
no pattern skips all windows over it. Where a block is known, its shift leaves the places
where windows may end; their suffix hash selects patterns from the sorted buckets, and
comparing all words of the window confirms an occurrence. All of this is array work over
many texts at once.

The corpus is scanned once in Arrow batches, whole texts, without a shuffle; only found
pairs are reduced to distinct rows. The tables take about 35 bytes for a word of evaluation
text. Those of at most ``MOST_WORDS`` words are broadcast at a time; only a larger evaluation
set needs another pass over the corpus.

Defined results
- Text is NFKC-normalised, characters of category Cf are removed, case is folded; a word
  is a maximal run of letters and digits.
- NULL and blank texts, and those of fewer than ``WINDOW`` words, match nothing.
- Items that share a passage are all reported; repeated rows of an item or a document
  with the same id give one pair; rows with a NULL id are left out.
- Empty corpus or empty evaluation set: empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldlark.session import spread

WINDOW, BLOCK = 13, 3
MOST_WORDS = 5_000_000
# Texts are searched together up to this many words.
TOGETHER = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"[^\W_]+")
_FORMAT = regex.compile(r"\p{Cf}+")


def words(text: str | None) -> list[str]:
    if not text:
        return []
    if text.isascii():
        return _WORD.findall(text.lower())
    return _WORD.findall(_FORMAT.sub("", unicodedata.normalize("NFKC", text)).casefold())


def _hashed(texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of all words, and the first place of each text with the end of the last."""
    code, names = pd.factorize(np.array([w for t in texts for w in t], object))
    own = pd.util.hash_array(np.asarray(names, object), categorize=False) if len(names) else np.empty(0, np.uint64)
    return own[code], np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]).astype(np.int64)


def _ending(word: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n words that end at each place."""
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = (out + word[at - (n - 1) + k]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _runs(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers first, first + 1, ... of each run, and the run of each number."""
    run = np.repeat(np.arange(len(first)), count)
    return first[run] + np.arange(len(run)) - (np.cumsum(count) - count)[run], run


class Patterns:
    """Shift table and suffix buckets of the windows of some items, as sorted arrays. ``items``
    are words; results name an item by its number in the list."""

    def __init__(self, items: list[list[str]], window: int = WINDOW, block: int = BLOCK) -> None:
        self.window, self.block, self.step = window, block, window - block + 1
        kept = [i for i, w in enumerate(items) if len(w) >= window]
        self.word, starts = _hashed([items[i] for i in kept])
        sizes = np.diff(starts)
        ends, of = _runs(starts[:-1] + block - 1, np.maximum(0, sizes - block + 1))
        away = np.maximum(0, window - 1 - (ends - starts[:-1][of]))
        self.blocks, first = np.unique(_ending(self.word, ends, block), return_inverse=True)
        self.shift = np.full(len(self.blocks), self.step, np.int8)
        np.minimum.at(self.shift, first, away.astype(np.int8))
        ends, of = _runs(starts[:-1] + window - 1, np.maximum(0, sizes - window + 1))
        suffix = _ending(self.word, ends, window)
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.ends, self.item = suffix[order], ends[order], np.array(kept, np.int64)[of[order]]

    def find(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the text, number of an item of which it holds a window)."""
        word, starts = _hashed(texts)
        sizes = np.diff(starts)
        at, of = _runs(np.zeros(len(sizes), np.int64), np.maximum(0, (sizes - self.window) // self.step + 1) * (sizes >= self.window))
        at = starts[:-1][of] + self.window - 1 + at * self.step
        if not len(at) or not len(self.blocks):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        key = _ending(word, at, self.block)
        near = np.minimum(np.searchsorted(self.blocks, key), len(self.blocks) - 1)
        hit = self.blocks[near] == key
        at, of, move = at[hit], of[hit], self.shift[near[hit]].astype(np.int64)
        last = np.minimum(at + self.step - 1, starts[1:][of] - 1)
        ends, run = _runs(at + move, np.maximum(0, last - at - move + 1))
        key = _ending(word, ends, self.window)
        low, high = np.searchsorted(self.suffix, key), np.searchsorted(self.suffix, key, "right")
        which, place = _runs(low, high - low)
        ends, of = ends[place], of[run][place]
        same = np.ones(len(which), bool)
        for k in range(self.window):
            same &= word[ends - k] == self.word[self.ends[which] - k]
        pairs = np.unique(np.stack([of[same], self.item[which[same]]], 1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def leaked_items(documents: DataFrame, ident: str, text: str, items: DataFrame, item: str, item_text: str, *, window: int = WINDOW, most_words: int = MOST_WORDS) -> DataFrame:
    """``doc_id, item_id``: each document with each item of which it holds a passage."""
    spark = documents.sparkSession
    kind, item_kind = documents.schema[ident].dataType.simpleString(), items.schema[item].dataType.simpleString()
    asked = documents.select(F.col(ident).alias("doc_id"), F.col(text).alias("text")).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    asked = spread(asked, "doc_id")
    schema, item_arrow = f"doc_id {kind}, item_id {item_kind}", to_arrow_type(items.schema[item].dataType)

    def search(block: list[tuple[object, list[str]]]) -> DataFrame:
        shared = spark.sparkContext.broadcast((Patterns([w for _, w in block], window), pa.array([i for i, _ in block], item_arrow)))

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns, names = shared.value
            for batch in batches:
                held, first, n = [], 0, 0
                for i, text in enumerate(batch.column("text").to_pylist()):
                    held.append(words(text))
                    n += len(held[-1])
                    if n >= TOGETHER or i + 1 == batch.num_rows:
                        at, found = patterns.find(held)
                        yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at + first)), names.take(pa.array(found))], ["doc_id", "item_id"])
                        held, first, n = [], i + 1, 0

        return asked.mapInArrow(look, schema)

    out, held, size = [], [], 0
    for r in items.select(item, item_text).where(F.col(item).isNotNull() & F.col(item_text).isNotNull()).toLocalIterator():
        w = words(r[1])
        if held and size + len(w) > most_words:
            out.append(search(held))
            held, size = [], 0
        held.append((r[0], w))
        size += len(w)
    if held:
        out.append(search(held))
    if not out:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, out).distinct()


def leak_report(found: DataFrame, items: DataFrame) -> DataFrame:
    """Per evaluation split and task: items, leaked items and documents that leak them."""
    per_item = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_documents"))
    known = items.select("item_id", "eval_split", "task").join(per_item, "item_id", "left")
    return known.groupBy("eval_split", "task").agg(
        F.count(F.lit(1)).alias("n_items"), F.count("n_documents").alias("n_leaked_items"), F.coalesce(F.sum("n_documents"), F.lit(0)).alias("n_pairs")
    )
