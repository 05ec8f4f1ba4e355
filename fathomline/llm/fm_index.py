"""A bidirectional FM-index over a delimited vocabulary, and searches for words at one error.

The text is #w1#w2#...#wk#$, its suffixes ordered up to their next delimiter and then by place; since the words are sorted, that order is also the one the next words give, and the suffix #w is at w's rank. A second index holds the reversed words. A pattern is a pair of intervals of suffix ranks, one in each index, of equal size; putting a symbol before or behind it narrows one interval by the counts of symbols in it and the other by the counts of smaller ones. All searches of a batch take their steps together.
"""

import numpy as np

#: Positions of the text to a row of symbol counts.
ROW = 32
#: Patterns whose counts are taken together.
STATES = 1 << 16


def ranks(text: np.ndarray, bits: int) -> np.ndarray:
    """Order of the text's suffixes: of each up to its next delimiter (0), equal ones by place."""
    n = len(text)
    span = max(1, 62 // bits)
    padded = np.concatenate((text, np.zeros(span, text.dtype)))
    key, open_ = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(span):
        symbol = padded[i : i + n]
        if i:
            open_ &= symbol != 0
        key = key << bits | np.where(open_, symbol, 0)
    rank = np.unique(key, return_inverse=True)[1]
    while open_.any():  # twice the length: this part's rank, then that of the part behind it
        behind = np.flatnonzero(open_) + span
        inside = behind < n
        behind = behind[inside]
        second = np.zeros(n, np.int64)
        going = text[behind] != 0
        at = behind[going] - span
        second[at] = rank[behind[going]] + 1
        still = np.zeros(n, bool)
        still[at] = open_[behind[going]]
        rank = np.unique(rank * (n + 1) + second, return_inverse=True)[1]
        open_, span = still, 2 * span
    return np.argsort(rank, kind="stable")


class Half:
    """One direction: which symbol precedes each suffix, with counts of smaller symbols up to each row's start."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = ranks(text, int(symbols).bit_length())
        self.before = text[order - 1]
        n, self.symbols = len(text), symbols
        rows = -(-n // ROW)
        count = np.bincount(np.arange(n) // ROW * symbols + self.before, minlength=rows * symbols).reshape(rows, symbols)
        smaller = np.cumsum(count, 1) - count
        self.counts = np.zeros((rows + 1, symbols + 1), np.int32)
        self.counts[1:, :-1], self.counts[1:, -1] = np.cumsum(smaller, 0), np.cumsum(count.sum(1))
        self.start = self.counts[-1].astype(np.int64)
        small = np.uint8 if symbols < 256 else np.int32
        self.rows = np.concatenate((self.before, np.full(ROW - n % ROW, symbols))).astype(small).reshape(-1, ROW)

    def smaller(self, at: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many of the first `at` suffixes are preceded by a smaller symbol, and by this or a smaller one."""
        first, last = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        for lo in range(0, len(at), STATES):
            some = slice(lo, lo + STATES)
            row, c = at[some] // ROW, symbol[some]
            near, wanted = self.rows[row], c.astype(self.rows.dtype)[:, None]
            inside = np.arange(ROW) < (at[some] % ROW)[:, None]
            less = ((near < wanted) & inside).sum(1)
            first[some] = self.counts[row, c] + less
            last[some] = self.counts[row, c + 1] + less + ((near == wanted) & inside).sum(1)
        return first, last


class Index:
    """words: arrays of symbols from 1 on, sorted. start: a pattern of no symbols; before, behind: patterns one longer."""

    def __init__(self, words: list[np.ndarray], symbols: int):
        self.size = sum(map(len, words)) + len(words) + 2
        mirrored = sorted((w[::-1] for w in words), key=lambda w: w.tolist())
        self.halves = [Half(self._text(part, symbols), symbols + 2) for part in (words, mirrored)]

    @staticmethod
    def _text(words: list[np.ndarray], symbols: int) -> np.ndarray:
        size = np.array([len(w) for w in words]) + 1
        text = np.zeros(size.sum() + 2, np.int32)
        text[-1] = symbols + 1  # the end, greatest of all
        at = np.ones(len(text), bool)
        at[0] = at[-1] = False
        at[np.cumsum(size)] = False
        text[at] = np.concatenate(words)
        return text

    def start(self, n: int) -> np.ndarray:
        """n patterns of no symbols: a row each for where the two intervals begin and their size."""
        return np.stack((np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.size)))

    def extended(self, state: np.ndarray, symbol: np.ndarray, side: int) -> np.ndarray:
        """With a symbol before (side 0) or behind (side 1); of size 0 where that occurs nowhere."""
        half, lo = self.halves[side], state[side]
        a0, a1 = half.smaller(lo, symbol)
        b0, b1 = half.smaller(lo + state[2], symbol)
        out = np.empty_like(state)
        out[side] = half.start[symbol] + a1 - a0
        out[1 - side] = state[1 - side] + b0 - a0
        out[2] = b1 - a1 - (b0 - a0)
        return out

    def preceding(self, state: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Which symbols can be put there: a row of state and a symbol for each. Rows with the same interval are looked at once; those of one depth are disjoint, so that the text is read once at most."""
        _, first, same = np.unique(state[side], return_index=True, return_inverse=True)
        lo, size = state[side, first], state[2, first]
        at = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
        symbols = self.halves[side].symbols
        found = np.unique(np.repeat(np.arange(len(first)), size) * symbols + self.halves[side].before[at])
        owner, symbol = found // symbols, found % symbols
        begin = np.searchsorted(owner, np.arange(len(first) + 1))
        many = np.diff(begin)[same]
        row = np.repeat(np.arange(len(same)), many)
        return row, symbol[np.arange(many.sum()) + np.repeat(begin[same] - np.cumsum(many) + many, many)]


def near(index: Index, text: np.ndarray, at: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and the rank of a word that it becomes when one symbol outside its first `left` and last `right` ones is replaced by a greater one or deleted; of equal neighbours only the last may be. text[at : at + size]: a query's symbols.

    The longer of the two exact parts is matched from the middle of the word outwards, with its delimiter; then the search turns round and goes on over the part that holds the error to the other delimiter.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for side in (0, 1):  # 0: the beginning is exact and matched before, then the search goes on behind
        own = np.flatnonzero((left >= right) if side == 0 else (left < right))
        if not len(own):
            continue
        n, exact = size[own], (left if side == 0 else right)[own]
        free = n - (right if side == 0 else left)[own]  # steps up to which the error can be
        place = (lambda q, i: at[q] + i) if side == 0 else (lambda q, i: at[q] + size[q] - 1 - i)
        symbol = lambda q, i: np.where(i < size[q], text[np.minimum(place(q, i), len(text) - 1)] if side == 0 else text[np.maximum(place(q, i), 0)], 0)
        state = index.start(len(own))
        for i in range(int(exact.max(initial=0)) + 1):  # from the last exact symbol outwards; then the delimiter
            on = np.flatnonzero((exact >= i) & (state[2] > 0))
            back = exact[on] - 1 - i
            state[:, on] = index.extended(state[:, on], np.where(back >= 0, symbol(own[on], np.maximum(back, 0)), 0), side)
        alive = state[2] > 0
        query, state, step, last = own[alive], state[:, alive], exact[alive], free[alive]
        wrong_q, wrong_state, wrong_step = np.zeros(0, np.int64), np.zeros((3, 0), np.int64), np.zeros(0, np.int64)
        while len(query) or len(wrong_q):
            new = []
            if len(wrong_q):  # after the error: exact up to the delimiter
                c = symbol(wrong_q, wrong_step)
                further = index.extended(wrong_state, c, 1 - side)
                ok = further[2] > 0
                ended = ok & (wrong_step == size[wrong_q])
                found.append((wrong_q[ended], further[0, ended]))
                ok &= ~ended
                new.append((wrong_q[ok], further[:, ok], wrong_step[ok] + 1))
            if len(query):  # before it: the error may be here
                c = symbol(query, step)
                before, after = symbol(query, np.maximum(step - 1, 0)), symbol(query, step + 1)
                last_of_equals = (after != c) if side == 0 else ((before != c) | (step == 0))
                new.append((query[last_of_equals], state[:, last_of_equals], step[last_of_equals] + 1))
                row, other = index.preceding(state, 1 - side)
                ok = (other > c[row]) & (other < index.halves[0].symbols - 1)
                row, other = row[ok], other[ok]
                new.append((query[row], index.extended(state[:, row], other, 1 - side), step[row] + 1))
                state = index.extended(state, c, 1 - side)
                step = step + 1
                on = (state[2] > 0) & (step < last)
                query, state, step, last = query[on], state[:, on], step[on], last[on]
            wrong_q, wrong_state, wrong_step = np.concatenate([x[0] for x in new]), np.concatenate([x[1] for x in new], 1), np.concatenate([x[2] for x in new])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])
