"""Best-first search for the best documents of a block, over intervals of documents.

Each term of the block has a posting list in document order, with a sparse table over
it: for every power of two, where the largest impact of so many postings lies.  Two
look-ups give the largest impact of a term in any interval of documents, and the sum
over a question's terms bounds the score of all documents in it.  A question starts
with the whole block as one interval.  The interval with the highest bound is split at
the document where its largest single impact lies: that document gets its true score,
and what is left and right of it becomes two intervals with bounds of their own.  An
interval that can't beat the ``k``-th best any more is dropped.

Questions advance side by side, a few intervals each in a round, so that numpy works
on long arrays.  Documents stand by length, so that an interval holds documents of
like length and its bounds are tight.
"""

from __future__ import annotations

import numpy as np

PER_ROUND = 8
NO_ID = np.iinfo(np.int64).max


def range_maxima(values: np.ndarray, longest: int) -> np.ndarray:
    """Where the largest of ``values[i : i + 2 ** level]`` is, by level and i, the leftmost of equal ones."""
    rows = [np.arange(len(values), dtype=np.int32)]
    step = 1
    while 2 * step <= longest:
        last, row = rows[-1], rows[-1].copy()
        right = last[step:]
        left = last[: len(right)]
        row[: len(right)] = np.where(values[right] > values[left], right, left)
        rows.append(row)
        step *= 2
    return np.stack(rows)


def largest(table: np.ndarray, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the largest of ``values[low:high]`` is, for ranges that are not empty."""
    level = np.frexp((high - low).astype(np.float64))[1] - 1
    left, right = table[level, low], table[level, high - (1 << level)]
    return np.where(values[right] > values[left], right, left)


class Questions:
    """Terms and weights of some questions, one question after the other."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, offsets: np.ndarray):
        self.terms, self.weights, self.offsets = terms, weights, offsets
        self.count = len(offsets) - 1

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the terms of the questions *which*, and where each question's begin."""
        sizes = self.offsets[which + 1] - self.offsets[which]
        begin = np.cumsum(sizes) - sizes
        return np.repeat(self.offsets[which] - begin, sizes) + np.arange(int(sizes.sum())), begin


class Best:
    """The *k* best documents of each question so far: score, then id."""

    def __init__(self, count: int, k: int):
        self.k = k
        self.question = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)
        self.least = np.zeros(count, np.int64)
        self.least_id = np.full(count, NO_ID)

    def add(self, question: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        found = score > 0
        if not found.any():
            return
        q = np.concatenate([self.question, question[found]])
        s = np.concatenate([self.score, score[found]])
        i = np.concatenate([self.id, ids[found]])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        last = place == self.k - 1
        self.least[q[last]], self.least_id[q[last]] = s[last], i[last]
        top = place < self.k
        self.question, self.score, self.id = q[top], s[top], i[top]


class Block:
    """Posting lists of some documents."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        """*ids* in document order; postings by term, then document; impacts without the terms' weights."""
        self.ids, self.impact = ids, impact
        self.key = (term.astype(np.int64) << 32) | doc
        lists = np.bincount(term) if len(term) else np.zeros(1, np.int64)
        self.table = range_maxima(impact, int(lists.max()))
        # the smallest id of an interval is the largest of what is left below the greatest number
        self.early = NO_ID - ids
        self.early_table = range_maxima(self.early, len(ids))

    def _bounds(self, questions: Questions, which: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Bounds of intervals, the documents to split them at, and their smallest ids."""
        at, begin = questions.of(which)
        sizes = questions.offsets[which + 1] - questions.offsets[which]
        term = questions.terms[at] << 32
        first = np.searchsorted(self.key, term | np.repeat(low, sizes))
        last = np.searchsorted(self.key, term | np.repeat(high, sizes))
        worth = np.zeros(len(at), np.int64)
        document = np.zeros(len(at), np.int64)
        some = np.flatnonzero(first < last)
        best = largest(self.table, self.impact, first[some], last[some])
        worth[some] = questions.weights[at[some]] * self.impact[best]
        document[some] = self.key[best] & 0xFFFFFFFF
        bound = np.add.reduceat(worth, begin)
        strongest = np.maximum.reduceat(worth, begin)
        split = np.maximum.reduceat(np.where(worth == np.repeat(strongest, sizes), document, -1), begin)
        return bound, split, self.ids[largest(self.early_table, self.early, low, high)]

    def _scores(self, questions: Questions, which: np.ndarray, documents: np.ndarray) -> np.ndarray:
        at, begin = questions.of(which)
        sizes = questions.offsets[which + 1] - questions.offsets[which]
        wanted = (questions.terms[at] << 32) | np.repeat(documents, sizes)
        place = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        worth = np.where(self.key[place] == wanted, questions.weights[at] * self.impact[place], 0)
        return np.add.reduceat(worth, begin)

    def search(self, questions: Questions, best: Best) -> int:
        """Bring *best* up to date with this block's documents; how many documents were scored."""
        if not len(self.key) or not questions.count:
            return 0
        which = np.flatnonzero(np.diff(questions.offsets) > 0)
        low, high = np.zeros(len(which), np.int64), np.full(len(which), len(self.ids), np.int64)
        bound, split, first_id = self._bounds(questions, which, low, high) if len(which) else (which,) * 3
        scored = 0
        while True:
            hope = (bound > best.least[which]) | ((bound == best.least[which]) & (first_id < best.least_id[which]))
            alive = np.flatnonzero(hope & (bound > 0))
            alive = alive[np.lexsort((-bound[alive], which[alive]))]
            which, low, high, bound, split, first_id = (
                a[alive] for a in (which, low, high, bound, split, first_id)
            )
            if not len(which):
                return scored
            now = np.arange(len(which)) - np.searchsorted(which, which) < PER_ROUND
            q, a, b, d = which[now], low[now], high[now], split[now]
            best.add(q, self._scores(questions, q, d), self.ids[d])
            scored += len(q)
            q, a, b = np.concatenate([q, q]), np.concatenate([a, d + 1]), np.concatenate([d, b])
            some = a < b
            q, a, b = q[some], a[some], b[some]
            new = (q, a, b, *(self._bounds(questions, q, a, b) if len(q) else (q,) * 3))
            which, low, high, bound, split, first_id = (
                np.concatenate([old[~now], more])
                for old, more in zip((which, low, high, bound, split, first_id), new)
            )
