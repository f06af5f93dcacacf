"""A linear-chain conditional random field in numpy.

A token scores each label by the features of its own word, of the word before and of the
word after; neighbouring labels score each other. Weights are fitted by full-batch gradient
ascent on the regularised likelihood. A text is one chain. What can be told apart exactly is
computed side by side: best labels between stretches that must have label 0, two-label
marginals in stretches of ``CHAIN`` tokens that hand their last score on until none changes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable

import numpy as np

CHAIN = 64
# Distinct words whose scores a task remembers.
REMEMBERED = 200_000
ROLES = 3
# Log odds that differ by no more are the same; each step on makes a difference smaller.
SAME = 1e-9

Features = Callable[[str], list[str]]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(e: np.ndarray, mask: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """Log forward and backward scores (chain, place, label) and log normaliser (chain).

    ``mask`` marks real tokens; padding only follows them and passes scores on.
    """
    n, length, k = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = first + e[:, 0]
    for t in range(1, length):
        step = _logsumexp(alpha[:, t - 1, :, None] + trans, 1) + e[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = _logsumexp(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(mask[:, t + 1, None], step, beta[:, t + 1])
    return alpha, beta, _logsumexp(alpha[:, -1], 1)


def marginals(e: np.ndarray, mask: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    alpha, beta, z = forward_backward(e, mask, trans, first)
    return np.exp(alpha + beta - z[:, None, None])


def two_label_marginals(e: np.ndarray, mask: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The same for two labels, by recursions of the log odds alone."""
    n = len(e)
    ends = np.arange(n)
    p = _log_odds(e[..., 1] - e[..., 0], mask, trans, first, ends, ends)
    return np.stack([1 - p, p], axis=2)


def _log_odds(
    d: np.ndarray, mask: np.ndarray, trans: np.ndarray, first: np.ndarray, head: np.ndarray, tail: np.ndarray
) -> np.ndarray:
    """Probability of label 1 from the margins of label 1 over 0 (stretch, place).

    Rows are stretches of texts in order; ``head`` and ``tail`` are the rows a text starts and
    ends with, and within a text every stretch but the last is full. A stretch whose
    neighbour hands on another score than before is done again up to the place where nothing
    changes, so the result is that of one chain a text.
    """
    d, real = np.ascontiguousarray(d.T, dtype=np.float64), np.ascontiguousarray(mask.T)
    trans, first = trans.astype(np.float64), first.astype(np.float64)
    length, n = d.shape

    def ahead_of(a: np.ndarray) -> np.ndarray:
        return np.logaddexp(trans[0, 1], trans[1, 1] + a) - np.logaddexp(trans[0, 0], trans[1, 0] + a)

    def behind(b: np.ndarray) -> np.ndarray:
        return np.logaddexp(trans[1, 0], trans[1, 1] + b) - np.logaddexp(trans[0, 0], trans[0, 1] + b)

    # Score that reaches the first place from before, and the last place from behind.
    starts, ends = np.zeros(n, bool), np.zeros(n, bool)
    starts[head], ends[tail] = True, True
    ahead, back = np.full_like(d, np.nan), np.full_like(d, np.nan)
    enter = np.where(starts, first[1] - first[0], ahead_of(np.full(n, first[1] - first[0])))
    rows = np.arange(n)
    while len(rows):
        x = enter[rows]
        moved = rows
        for t in range(length):
            new = np.where(real[t, moved], d[t, moved] + x, x)
            changed = ~(np.abs(new - ahead[t, moved]) <= SAME)
            ahead[t, moved] = new
            moved, x = moved[changed], ahead_of(new[changed])
            if not len(moved):
                break
        # Rows that changed up to their last place hand a new score on.
        rows = moved[~ends[moved]] + 1
        enter[rows] = ahead_of(ahead[-1, rows - 1])
    leave = np.zeros(n)
    rows = np.arange(n)
    while len(rows):
        x = leave[rows]
        moved = rows
        for t in range(length - 1, -1, -1):
            changed = ~(np.abs(x - back[t, moved]) <= SAME)
            back[t, moved] = x
            moved, x = moved[changed], x[changed]
            if not len(moved):
                break
            x = np.where(real[t, moved], behind(d[t, moved] + x), 0)
        rows = moved[~starts[moved]] - 1
        leave[rows] = behind(d[0, rows + 1] + back[0, rows + 1])
    p = 1 / (1 + np.exp(-np.clip(ahead + back, -60, 60)))
    return p.T


def viterbi(e: np.ndarray, mask: np.ndarray, trans: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best labels (chain, place); padding repeats the last label."""
    n, length, k = e.shape
    back = np.zeros((n, length, k), dtype=np.int8)
    score = first + e[:, 0]
    same = np.arange(k, dtype=np.int8)
    for t in range(1, length):
        options = score[:, :, None] + trans
        best = options.argmax(axis=1).astype(np.int8)
        real = mask[:, t, None]
        back[:, t] = np.where(real, best, same)
        score = np.where(real, options.max(axis=1) + e[:, t], score)
    labels = np.zeros((n, length), dtype=np.int8)
    labels[:, -1] = score.argmax(axis=1)
    rows = np.arange(n)
    for t in range(length - 1, 0, -1):
        labels[:, t - 1] = back[rows, t, labels[:, t]]
    return labels


def _chains(starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Flat positions (chain, place) and mask of consecutive chains over runs of tokens."""
    per = -(-sizes // length)
    offset = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
    at = np.repeat(starts, per) + offset * length
    real = np.minimum(np.repeat(sizes, per) - offset * length, length)
    place = np.arange(length)
    mask = place < real[:, None]
    return np.where(mask, at[:, None] + place, at[:, None]), mask


class Chain:
    """A fitted field: which labels it knows, and the weights of its features."""

    def __init__(self, labels: tuple[str, ...], features: Features, least: int = 2, context: bool = True) -> None:
        self.labels, self.features, self.least, self.context = labels, features, least, context
        self.index: dict[str, int] = {}
        k = len(labels)
        self.weights = np.zeros((ROLES, 1, k), dtype=np.float32)
        self.trans, self.first = np.zeros((k, k), np.float32), np.zeros(k, np.float32)

    def fit(self, rows: list[tuple[list[str], list[int]]], rounds: int = 80, rate: float = 0.3, decay: float = 0.1):
        """Fit to token lists with their label numbers; lists are chains of their own.

        ``decay`` is the weight of half the squared weights in the log-likelihood.
        """
        rows = [r for r in rows if r[0]]
        if not rows:
            return self
        words: dict[str, int] = {}
        ids = [[words.setdefault(w, len(words)) for w in tokens] for tokens, _ in rows]
        listed = [self.features(w) for w in words]
        used = Counter(i for word_ids in ids for i in word_ids)
        seen: Counter = Counter()
        for i, fs in enumerate(listed):
            for f in fs:
                seen[f] += used[i]
        self.index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= self.least))}
        k, n_features = len(self.labels), len(self.index) + 1
        # The last feature is a constant, so no word is without features.
        each = [[self.index[f] for f in fs if f in self.index] + [n_features - 1] for fs in listed]
        flat = np.array([f for fs in each for f in fs])
        bounds = np.concatenate(([0], np.cumsum([len(fs) for fs in each])[:-1]))
        owner = np.repeat(np.arange(len(each)), [len(fs) for fs in each])
        length = max(map(len, ids))
        at = np.zeros((len(ids), length), dtype=np.int64)
        mask, gold = np.zeros(at.shape, bool), np.zeros(at.shape, np.int64)
        for row, (word_ids, (_, labels)) in enumerate(zip(ids, rows)):
            at[row, : len(word_ids)], gold[row, : len(word_ids)], mask[row, : len(word_ids)] = word_ids, labels, True
        both = mask[:, 1:]
        truth = np.eye(k, dtype=np.float32)[gold] * mask[..., None]
        pair_truth = np.einsum("nti,ntj->ij", truth[:, :-1], truth[:, 1:])
        params = [np.zeros((ROLES, n_features, k), np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32)]
        moment = [np.zeros_like(p) for p in params]
        spread = [np.zeros_like(p) for p in params]
        tokens = mask.sum()
        roles = range(ROLES if self.context else 1)
        for turn in range(1, rounds + 1):
            w, trans, first = params
            table = [np.add.reduceat(w[r][flat], bounds, axis=0) for r in roles]
            e = table[0][at]
            if self.context:
                e[:, 1:] += table[1][at[:, :-1]]
                e[:, :-1] += table[2][at[:, 1:]] * both[..., None]
            e *= mask[..., None]
            alpha, beta, z = forward_backward(e, mask, trans, first)
            gap = truth - np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
            pairs = np.zeros((k, k), np.float32)
            for t in range(1, length):
                joint = alpha[:, t - 1, :, None] + trans + (e[:, t] + beta[:, t])[:, None, :] - z[:, None, None]
                pairs += (np.exp(joint) * mask[:, t, None, None]).sum(axis=0)
            grad_w = np.zeros_like(w)
            shifted = [(at, gap), (at[:, :-1], gap[:, 1:]), (at[:, 1:], gap[:, :-1] * both[..., None])]
            for r in roles:
                where, part = shifted[r]
                for label in range(k):
                    per_word = np.bincount(where.ravel(), part[..., label].ravel(), len(each))
                    grad_w[r, :, label] = np.bincount(flat, per_word[owner], n_features)
            grads = [grad_w, pair_truth - pairs, gap[:, 0].sum(axis=0)]
            for i, (p, g) in enumerate(zip(params, grads)):
                g = (g - decay * p) / tokens
                moment[i] = 0.9 * moment[i] + 0.1 * g
                spread[i] = 0.999 * spread[i] + 0.001 * g * g
                step = (moment[i] / (1 - 0.9**turn)) / (np.sqrt(spread[i] / (1 - 0.999**turn)) + 1e-8)
                params[i] = p + np.float32(rate * (1 - turn / (rounds + 1))) * step
        self.weights, self.trans, self.first = params
        return self

    def known_features(self, word: str) -> tuple[int, ...]:
        index = self.index
        return tuple(index[f] for f in self.features(word) if f in index)

    def scores(self, found: tuple[int, ...]) -> np.ndarray:
        """Label scores of a word with these features as (role, label)."""
        return self.weights[:, [*found, self.weights.shape[1] - 1]].sum(axis=1)


class Decoder:
    """Labels token lists with a field, remembering the scores of words."""

    def __init__(self, field: Chain) -> None:
        self.field = field
        self._forget()

    def _forget(self) -> None:
        k = len(self.field.labels)
        self.known: dict[str, int] = {}
        # Words with the same known features share a row; row 0 is the missing neighbour.
        self.rows: dict[tuple[int, ...], int] = {}
        self.table = np.zeros((4096, ROLES, k), dtype=np.float32)

    def _learn(self, word: str) -> int:
        found = self.field.known_features(word)
        row = self.rows.get(found)
        if row is None:
            row = self.rows[found] = len(self.rows) + 1
            if row >= len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[row] = self.field.scores(found)
        self.known[word] = row
        return row

    def _emissions(self, texts: Iterable[list[str]]):
        """Sizes of the texts and label scores of all tokens on end."""
        if len(self.known) > REMEMBERED:
            self._forget()
        words: list[str] = []
        sizes = []
        for tokens in texts:
            words += tokens
            sizes.append(len(tokens))
        known, ids = self.known, list(map(self.known.get, words))
        if None in ids:
            for i, row in enumerate(ids):
                if row is None:
                    row = known.get(words[i])
                    ids[i] = self._learn(words[i]) if row is None else row
        flat, sizes = np.array(ids, dtype=np.int64), np.array(sizes, dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        filled = starts[sizes > 0]
        e = self.table[flat, 0]
        if self.field.context:
            before, after = np.zeros_like(flat), np.zeros_like(flat)
            before[1:], after[:-1] = flat[:-1], flat[1:]
            before[filled] = 0
            after[filled + sizes[sizes > 0] - 1] = 0
            e = e + self.table[before, 1] + self.table[after, 2]
        return sizes, e

    def _run(self, texts: list[list[str]], method, width: int) -> list[np.ndarray]:
        """Results of a method on whole texts."""
        sizes, e = self._emissions(texts)
        out = np.zeros((len(e), width), dtype=np.float32)
        filled = sizes > 0
        self._fill(out, e, (np.cumsum(sizes) - sizes)[filled], sizes[filled], method)
        return np.split(out, np.cumsum(sizes)[:-1]) if len(sizes) else []

    def _fill(self, out: np.ndarray, e: np.ndarray, starts: np.ndarray, sizes: np.ndarray, method) -> None:
        """Results of chains of any length, those of like length side by side."""
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            # At most half of a group's places is padding, beyond short chains.
            least = int(sizes[order[at]])
            end = int(np.searchsorted(sizes[order], max(2 * least, 8), side="right"))
            rows = order[at:end]
            at = end
            longest = int(sizes[rows].max())
            real = np.arange(longest) < sizes[rows, None]
            places = np.where(real, starts[rows, None] + np.arange(longest), starts[rows, None])
            # Scores of long chains add up beyond the digits of single precision.
            scores = e[places].astype(np.float64) * real[..., None]
            found = method(scores, real, self.field.trans, self.field.first)
            out[places[real]] = found.reshape(*places.shape, -1)[real]

    def best(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Viterbi labels of each text's tokens."""
        sizes, e = self._emissions(texts)
        out = np.zeros((len(e), 1), dtype=np.float32)
        starts, ends, heads, tails = self._open_parts(sizes, e)
        if len(starts):
            # What lies before and behind a part inside a text has label 0.
            t, f = self.field.trans, self.field.first
            e = e.copy()
            e[starts[~heads]] += t[0] - f
            np.add.at(e, ends[~tails] - 1, t[:, 0])
            self._fill(out, e, starts, ends - starts, viterbi)
        return np.split(out[:, 0].astype(np.int8), np.cumsum(sizes)[:-1]) if len(sizes) else []

    def _open_parts(self, sizes: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, ...]:
        """Starts and ends of the parts of texts not known to have label 0 throughout, and
        whether they begin and end their text.

        ``_certain`` tokens neither begin nor end a stretch of other labels in the best
        labelling: without them the stretch would score more. So a gap of them is within a
        stretch from end to end or has label 0, and it has label 0 where a stretch over it
        scores less than two stretches beside it, whatever the labels.
        """
        t = self.field.trans
        unsure = np.flatnonzero(~self._certain(e))
        text = np.repeat(np.arange(len(sizes)), sizes)
        first_of, end_of = (np.cumsum(sizes) - sizes), np.cumsum(sizes)
        if not len(unsure):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),) * 2
        margin = np.concatenate(([0.0], np.cumsum((e[:, 1:].max(axis=1) - e[:, 0]).astype(np.float64))))
        a, b = unsure[:-1], unsure[1:]
        gap = b - a - 1
        across = (
            margin[b] - margin[a + 1]
            + (gap + 1) * float(t[1:, 1:].max())
            - float(t[1:, 0].min()) - float(t[0, 1:].min()) - np.maximum(gap - 1, 0) * float(t[0, 0])
        )
        cut = (text[a] != text[b]) | (gap > 0) & (across < -1e-3)
        starts = unsure[np.concatenate(([True], cut))]
        ends = unsure[np.concatenate((cut, [True]))] + 1
        return starts, ends, starts == first_of[text[starts]], ends == end_of[text[starts]]

    def _certain(self, e: np.ndarray) -> np.ndarray:
        """Tokens so far on the side of label 0 that no stretch of others begins or ends there.

        Taking such tokens off an end of a stretch, or a whole stretch of them, changes their
        own margins and a step for each, and the way in or out; the largest of these a token
        bounds all.
        """
        t, f = self.field.trans, self.field.first
        into, out = (t[0, 1:] - t[0, 0]).max(), (t[1:, 0] - t[0, 0]).max()
        begin, inside = (f[1:] - f[0]).max(), (t[1:, 1:] - t[0, 0]).max()
        # The next or previous label stays, but follows or precedes label 0 afterwards.
        after, before = (t[1:, 1:] - t[0, 1:]).max(), (t[1:, 1:] - t[1:, :1]).max()
        ways_in, ways_out = max(into, begin), max(out, 0.0)
        bound = max(inside, ways_in + max(ways_out, after), ways_out + before, ways_in + ways_out)
        return e[:, 1:].max(axis=1) - e[:, 0] + bound < 0

    def probabilities(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Marginals (token, label) of each text."""
        k = len(self.field.labels)
        if k != 2:
            return self._run(texts, marginals, k)
        sizes, e = self._emissions(texts)
        out = np.zeros((len(e), 2), dtype=np.float32)
        filled = sizes[sizes > 0]
        if len(filled):
            at, mask = _chains((np.cumsum(sizes) - sizes)[sizes > 0], filled, CHAIN)
            tail = np.cumsum(-(-filled // CHAIN)) - 1
            head = np.concatenate(([0], tail[:-1] + 1))
            d = np.where(mask, (e[:, 1] - e[:, 0])[at], 0)
            p = _log_odds(d, mask, self.field.trans, self.field.first, head, tail)[mask]
            out[at[mask]] = np.stack([1 - p, p], axis=1)
        return np.split(out, np.cumsum(sizes)[:-1]) if len(sizes) else []
