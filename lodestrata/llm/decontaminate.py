"""Benchmark passages in documents, found by exact pieces and verified by edit distance.

A text's normal form is lower case with every run of other signs than letters and digits as one space. An item of m
characters may differ by k = floor(max_error * m) edits. It is split into k + 1 pieces; a passage within k edits holds one
of them unchanged, so exact hits of pieces (one automaton over all pieces) give every candidate place. There a
q-gram count rules out most, and Myers' bit-parallel algorithm gives the least distance of the item to any stretch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of items that are looked for in one pass over the documents; more items take more passes.
PASS_CHARACTERS = 8_000_000
Q = 6


def normal_form(text: Column) -> Column:
    """Words parted by single spaces, with a space at either end; null, empty and wordless texts are one space."""
    words = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def distance_within(pattern: str, masks: dict[str, int], text: str) -> int:
    """The least edit distance of `pattern` to any stretch of `text` (Myers 1999, with whole integers as bit vectors)."""
    m = len(pattern)
    every, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = every, 0, m, m
    for c in text:
        equal = masks.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        more = (down | ~(horizontal | up)) & every
        less = up & horizontal
        if more & top:
            score += 1
        elif less & top:
            score -= 1
            if score < best:
                best = score
        more = (more << 1) & every
        less = (less << 1) & every
        up = (less | ~(vertical | more)) & every
        down = more & vertical
    return best


@dataclass
class Item:
    """One text of the benchmark with all ids that share it."""

    ids: list[int | None]
    text: str
    budget: int

    def __post_init__(self):
        m = len(self.text)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(self.text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i
        self.grams = [self.text[i : i + Q] for i in range(m - Q + 1)]
        self.least = m - Q + 1 - Q * self.budget  # each edit spoils at most Q of the grams

    def pieces(self) -> Iterator[tuple[int, str]]:
        m, n = len(self.text), self.budget + 1
        for j in range(n):
            yield m * j // n, self.text[m * j // n : m * (j + 1) // n]

    def distance(self, window: str) -> int:
        """The distance in `window`, or something above the budget."""
        if self.text in window:
            return 0
        if self.least > 0:
            there = {window[i : i + Q] for i in range(len(window) - Q + 1)}
            if sum(map(there.__contains__, self.grams)) < self.least:
                return self.budget + 1
        return distance_within(self.text, self.masks, window)


class Finder:
    """The automaton over the pieces of all items of a pass."""

    def __init__(self, items: list[Item]):
        self.items = items
        places: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(items):
            for start, piece in item.pieces():
                places.setdefault(piece, []).append((i, start))
        self.automaton = ahocorasick.Automaton()
        for piece, at in places.items():
            self.automaton.add_word(piece, (len(piece), at))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, int]:
        """The items within their budget in a text in normal form, with their least distance."""
        if not self.items:
            return {}
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                starts.setdefault(i, set()).add(end - size + 1 - offset)
        found: dict[int, int] = {}
        for i, at in starts.items():
            item = self.items[i]
            best = item.budget + 1
            for low, high in _windows(sorted(at), item.budget, len(item.text)):
                best = min(best, item.distance(text[max(0, low) : high]))
                if not best:
                    break
            if best <= item.budget:
                found[i] = best
        return found


def _windows(starts: list[int], budget: int, size: int) -> Iterator[tuple[int, int]]:
    """Stretches that hold all matches around the starts; those that overlap by more than half become one."""
    low, high = starts[0] - budget, starts[0] + size + budget
    for s in starts[1:]:
        if s - budget <= low + (high - low) // 2:
            high = s + size + budget
        else:
            yield low, high
            low, high = s - budget, s + size + budget
    yield low, high


def leaks(
    docs: DataFrame, items: DataFrame, max_error: float = 0.08, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """doc_id, item_id, distance: the items that documents hold, within `max_error` of the item's characters.

    One row per document row and item; rows of one document id are searched each. Null and empty texts hold nothing,
    and items without a letter or digit are nowhere. Items of equal normal form are reported each. Items are sent to
    the executors in passes of at most about `PASS_CHARACTERS`, each over all documents.
    """
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), normal_form(F.col(text)).alias("form")).filter("form <> ' '")
    kinds = "doc_id long, item_id long, distance int"
    found = [source.mapInArrow(_search(part), kinds) for part in _passes(items, max_error, item_id, text)]
    return reduce(DataFrame.union, found)


def without_leaks(docs: DataFrame, items: DataFrame, max_error: float = 0.08, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of `docs` in which `leaks` would find nothing, judged row by row where they are."""
    kinds = docs.schema

    def keeper(listed: list[tuple]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = Finder([Item(*x) for x in listed])
            for batch in batches:
                forms = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).tolist()
                clean = pa.array([not finder.find(form) for form in forms], pa.bool_())
                yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=kinds.fieldNames()).filter(clean)

        return run

    for part in _passes(items, max_error, item_id, text):
        docs = docs.select("*", normal_form(F.col(text)).alias("_normal_form")).mapInArrow(keeper(part), kinds)
    return docs


def _passes(items: DataFrame, max_error: float, item_id: str, text: str) -> Iterator[list[tuple]]:
    """The items of each pass as (ids, normal form, budget); one pass without any where no item has a word."""
    forms = items.select(F.col(item_id).cast("long").alias("item_id"), normal_form(F.col(text)).alias("form")).filter("form <> ' '")
    total = forms.agg(F.sum(F.char_length("form"))).first()[0] or 0
    passes = 1 + total // PASS_CHARACTERS
    for n in range(passes):
        by_text: dict[str, list] = {}
        for r in forms.filter(F.pmod(F.xxhash64("form"), F.lit(passes)) == n).orderBy("item_id").collect():
            by_text.setdefault(r["form"], []).append(r["item_id"])
        yield [(ids, t, int(max_error * (len(t) - 2))) for t, ids in by_text.items()]


def _search(listed: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder([Item(*x) for x in listed])
        for batch in batches:
            rows: list[tuple] = []
            for doc, form in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False).tolist()):
                for i, distance in finder.find(form).items():
                    rows.extend((doc, item, distance) for item in finder.items[i].ids)
            columns = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "item_id", "distance"]
            )

    return run
