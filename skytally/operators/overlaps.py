"""Term sets that share enough terms, counted in Python workers against blocks of known sets: candidates stay in memory."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and characters that are matched at a time, terms looked up at a time, and cells of a table of counts or of frequent terms.
ROWS, CHARS, LOOKUPS, CELLS = 8192, 32 << 20, 1 << 20, 1 << 22
#: Frequent terms that are looked up for candidates instead of making them, at most.
FREQUENT = 256


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All terms, the row of each, and the terms of each row."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), np.repeat(np.arange(len(sizes)), sizes), sizes


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each span, one span behind the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


@dataclass
class Block:
    """Known sets: a term is a number, rare terms first, with the sets that have it."""

    keys: pa.Array  # of each set
    sizes: np.ndarray  # of each set
    scopes: pa.Array  # different ones
    words: pa.Array  # different ones
    terms: np.ndarray  # scope * words + word, ascending
    numbers: np.ndarray  # of each of ``terms``
    starts: np.ndarray  # of each number's sets in ``sets``; one more
    sets: np.ndarray
    frequent: np.ndarray  # the last numbers x sets: whether the set has the term

    @classmethod
    def of(cls, keys: pa.Array, texts: pa.Array, scopes: pa.Array) -> Block:
        """``texts``: the terms of each set, one space between two."""
        flat, row, sizes = _flat(pc.split_pattern(texts, " "))
        scope, word = pc.dictionary_encode(scopes), pc.dictionary_encode(flat)
        n = len(word.dictionary)
        terms, at = np.unique(scope.indices.to_numpy().astype(np.int64)[row] * n + word.indices.to_numpy(), return_inverse=True)
        pairs = np.unique(at * len(keys) + row)  # a term that a set has twice counts once
        at, row = np.divmod(pairs, max(1, len(keys)))
        many = np.bincount(at, minlength=len(terms))
        order = np.argsort(many, kind="stable")
        numbers = np.empty_like(order)
        numbers[order] = np.arange(len(order))
        by_number = np.argsort(numbers[at], kind="stable")
        starts = np.concatenate([[0], np.cumsum(many[order])])
        often = min(len(terms), FREQUENT, max(1, CELLS // max(1, len(keys))))
        frequent = np.zeros((often, len(keys)), bool)
        last = numbers[at] >= len(terms) - often
        frequent[numbers[at][last] - (len(terms) - often), row[last]] = True
        return cls(keys, sizes, scope.dictionary, word.dictionary, terms, numbers, starts, row[by_number].astype(np.int32), frequent)

    def matches(self, texts: pa.Array, scopes: pa.Array, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row of ``texts``, set, Dice coefficient: all at or above the threshold that share a term.

        A row of n terms that reaches the threshold shares at least ceil(n t / (2 - t)) of them, so it shares one of
        its rarest, one more than it may miss. Frequent terms behind these make no candidates; they are looked up for the
        candidates that can still reach the threshold. All other terms are counted.
        """
        flat, row, sizes = _flat(pc.split_pattern(texts, " "))
        # A term that no set of the scope has is left out; the size counts it all the same.
        word = pc.fill_null(pc.index_in(flat, value_set=self.words), -1).to_numpy()
        scope = pc.fill_null(pc.index_in(scopes, value_set=self.scopes), -1).to_numpy()[row]
        known = (word >= 0) & (scope >= 0)
        term, row = scope[known].astype(np.int64) * len(self.words) + word[known], row[known]
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = self.terms[at] == term
        number, row = self.numbers[at[known]], row[known]
        row, number = np.divmod(np.unique(row * len(self.terms) + number), max(1, len(self.terms)))  # by row, rare terms first
        least = np.ceil(sizes * (threshold / (2 - threshold)) - 1e-9).astype(np.int64)
        have = np.bincount(row, minlength=len(sizes))
        enough = (have >= least)[row]
        row, number = row[enough], number[enough]
        # The terms that the least number does not reach from behind: ``least - 1`` of a row may be left for later.
        place = np.cumsum(np.bincount(row, minlength=len(sizes)))[row] - np.arange(len(row))  # 1: the most frequent of its row
        later = (place < least[row]) & (number >= len(self.terms) - len(self.frequent))
        now = ~later
        found = [self._counted(*x, sizes, threshold) for x in self._pieces(row[now], number[now], row[later], number[later])]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))

    def _pieces(self, row, number, later_row, later) -> Iterator[tuple[np.ndarray, ...]]:
        """Rows in pieces of bounded lookups; a row is never cut."""
        cost = np.cumsum(self.starts[number + 1] - self.starts[number])
        a = 0
        while a < len(row):
            b = int(np.searchsorted(cost, (cost[a - 1] if a else 0) + LOOKUPS, "right"))
            b = len(row) if b == len(row) else max(int(np.searchsorted(row, row[b])), int(np.searchsorted(row, row[a], "right")))
            x, y = np.searchsorted(later_row, [row[a], row[b - 1] + 1])
            yield row[a:b], number[a:b], later_row[x:y], later[x:y]
            a = b

    def _counted(self, row, number, later_row, later, sizes, threshold) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, first = len(self.keys), row[0]
        many = self.starts[number + 1] - self.starts[number]
        pair = np.repeat((row - first) * n, many) + self.sets[_spans(self.starts[number], many)]
        cells = (row[-1] - first + 1) * n
        if cells <= min(CELLS, 8 * len(pair)):
            count = np.bincount(pair, minlength=cells)
            pair = np.flatnonzero(count)
            count = count[pair]
        else:
            pair, count = np.unique(pair, return_counts=True)
        i, j = np.divmod(pair, n)
        total = sizes[first + i] + self.sizes[j]
        # Of each row, the terms to be looked up.
        spans = np.searchsorted(later_row, np.arange(first, row[-1] + 2))
        open_ = np.diff(spans)[i]
        on = 2.0 * (count + open_) / total >= threshold
        i, j, count, total, open_ = i[on], j[on], count[on], total[on], open_[on]
        step = max(1, LOOKUPS // max(1, int(open_.max(initial=0))))
        for a in range(0, len(i), step):
            part = slice(a, a + step)
            hit = self.frequent[later[_spans(spans[i[part]], open_[part])] - (len(self.terms) - len(self.frequent)), np.repeat(j[part], open_[part])]
            count[part] += np.bincount(np.repeat(np.arange(len(i[part])), open_[part])[hit], minlength=len(i[part]))
        score = 2.0 * count / total
        on = score >= threshold
        return first + i[on], j[on], score[on]


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of bounded rows and characters: small batches together, large ones in slices."""
    held, rows, size = [], 0, 0
    for batch in batches:
        for a in range(0, len(batch), ROWS):
            held.append(batch.slice(a, ROWS))
            rows, size = rows + len(held[-1]), size + held[-1].nbytes
            if rows >= ROWS or size >= CHARS:
                yield pa.Table.from_batches(held)
                held, rows, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def matcher(block, threshold: float, kept: list[str], each: bool):
    """For ``mapInArrow``: the ``kept`` columns of rows with ``_t`` and ``_s``, r_no and semelhanca, one row for each match.

    ``block``: a broadcast ``Block``. Equal sets that come together are compared once; ``each``: all their rows are returned, otherwise the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = block.value
        for table in _gathered(batches):
            texts, scopes = (table[c].combine_chunks() for c in ("_t", "_s"))
            text, scope = (pc.dictionary_encode(x) for x in (texts, scopes))
            both = text.indices.to_numpy().astype(np.int64) * len(scope.dictionary) + scope.indices.to_numpy()
            _, first, code = np.unique(both, return_index=True, return_inverse=True)
            i, j, score = sets.matches(texts.take(pa.array(first)), scopes.take(pa.array(first)), threshold)
            order = np.argsort(i, kind="stable")
            i, j, score = i[order], j[order], score[order]
            starts = np.searchsorted(i, np.arange(len(first) + 1))
            rows, code = (np.arange(len(code)), code) if each else (first, np.arange(len(first)))
            many = np.diff(starts)[code]
            for a, b in _slices(many):
                at = _spans(starts[code[a:b]], many[a:b])
                out = table.select(kept).take(pa.array(np.repeat(rows[a:b], many[a:b])))
                out = out.append_column("r_no", sets.keys.take(pa.array(j[at]))).append_column("semelhanca", pa.array(score[at]))
                yield from out.to_batches(max_chunksize=ROWS)

    return run


def _slices(many: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of rows with some matches, in all about ``LOOKUPS`` or one row's."""
    done, a = np.cumsum(many), 0
    while a < len(many) and done[-1] > (done[a - 1] if a else 0):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + LOOKUPS, "right")))
        if done[b - 1] > (done[a - 1] if a else 0):
            yield a, b
        a = b
