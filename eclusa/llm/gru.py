"""Bidirectional gated recurrent network with attention pooling, in numpy.

The input of a step is a word: its own vector, if the training rows had it often enough,
and the mean of the vectors of its characters' trigrams. Word vectors begin at zero, so
that all that the network knows of a word comes from its own gradients. Two gated recurrent layers read a
window forwards and backwards; attention weighs the steps; a linear layer gives the logit.

Attention scores and outputs are linear in the two directions' states, so scoring keeps
two numbers for each step and direction instead of the states.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np

from eclusa.llm import words as W

# Sizes of vectors and states, rows of the trigram table, words with a vector of their own.
WORD, CHARS, HIDDEN = 8, 8, 8
TRIGRAMS = 1 << 13
VOCABULARY = 50_000
# Words of a window, and words from one window's start to the next's.
WINDOW, STRIDE = 32, 16
# Passes of training; in each, windows of negative texts for every one of a positive text.
PASSES, NEGATIVES, BATCH = 3, 3, 128
# Steps of layers, and of word and trigram vectors.
RATE, TABLE_RATE = 0.01, 0.1
# Pull of word and trigram vectors towards zero.
PULL = 1e-4
# Words whose inputs a task remembers, a power of two.
REMEMBERED = 1 << 17
# Words of the training texts that are scored at once, unless one text has more.
SCORED = 1 << 17


def window_starts(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and first word, within the text, of all overlapping windows."""
    n = np.where(n_words > 0, np.maximum(1, -(-(n_words - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(n_words)), n)
    first = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, first * STRIDE


def trigram_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers around each byte of each range, and where each range's begin."""
    size = end - start
    begin = np.cumsum(size) - size
    at = np.repeat(start - begin, size) + np.arange(int(size.sum()))
    middle = data[at].astype(np.int64)
    left, right = np.zeros_like(middle), np.zeros_like(middle)
    left[1:], right[:-1] = middle[:-1], middle[1:]
    left[begin] = 0
    right[begin + size - 1] = 0
    return ((left * 961 + middle) * 961 + right) * 40503 % 1000003 % TRIGRAMS, begin


@dataclass
class Net:
    """Parameters; ``words`` are the sorted hashes of words with a vector of their own."""

    words: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)
    # Of the logistic map from a text's greatest logit to its score.
    slope: float = 1.0
    shift: float = 0.0
    empty: float = 0.0

    @staticmethod
    def fresh(words: np.ndarray, seed: int = 7) -> Net:
        r = np.random.default_rng(seed)
        d = WORD + CHARS
        p = {
            "word": np.zeros((len(words) + 1, WORD)),
            "char": r.normal(0, 0.05, (TRIGRAMS, CHARS)),
            "out": r.normal(0, 0.3, 2 * HIDDEN),
            "look": r.normal(0, 0.3, 2 * HIDDEN),
            "bias": np.zeros(1),
        }
        for side in "fb":
            p["W" + side] = r.normal(0, 0.4, (d, 3 * HIDDEN))
            p["U" + side] = r.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
            p["B" + side] = np.zeros(3 * HIDDEN)
        return Net(words, p)

    def word_ids(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each word's own vector; 0 for all words without one."""
        if not len(self.words):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0)

    def inputs(self, hashes, data, start, end) -> np.ndarray:
        """Input vectors of words."""
        ids, begin = trigram_ids(data, start, end)
        chars = np.add.reduceat(self.p["char"][ids], begin, axis=0) / (end - start)[:, None]
        return np.hstack([self.p["word"][self.word_ids(hashes)], chars])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Scorer:
    """Window logits of many texts, in single precision; remembers the inputs of words."""

    def __init__(self, net: Net):
        self.net = net
        self.p = {k: v.astype(np.float32) for k, v in net.p.items()}
        self.single = Net(net.words, self.p)
        self.keys = np.zeros(REMEMBERED, dtype=np.uint64)
        self.kept = np.zeros((REMEMBERED, 6 * HIDDEN), dtype=np.float32)

    def gates(self, words) -> tuple[np.ndarray, np.ndarray]:
        """Rows of gate inputs, both directions side by side, and each word's row."""
        unique, at, row = np.unique(words.hash, return_index=True, return_inverse=True)
        slot = (unique & np.uint64(REMEMBERED - 1)).astype(np.int64)
        out = self.kept[slot]
        new = np.flatnonzero(self.keys[slot] != unique)
        for part in np.array_split(new, -(-len(new) // 20_000)) if len(new) else ():
            which = at[part]
            x = self.single.inputs(unique[part], words.lowered, words.start[which], words.end[which])
            made = np.hstack([x @ self.p["W" + s] + self.p["B" + s] for s in "fb"])
            out[part] = self.kept[slot[part]] = made
            self.keys[slot[part]] = unique[part]
        return out, row

    def _read(self, side: int, gates: np.ndarray, at: np.ndarray, n: np.ndarray):
        """Attention score and output of each step in one direction."""
        h3, name = 3 * HIDDEN, "fb"[side]
        u = self.p["U" + name]
        table = np.ascontiguousarray(gates[:, side * h3 : (side + 1) * h3])
        half = slice(side * HIDDEN, (side + 1) * HIDDEN)
        heads = np.stack([self.p["look"][half], self.p["out"][half]], axis=1)
        h = np.zeros((len(at), HIDDEN), dtype=np.float32)
        out = np.zeros((WINDOW, len(at), 2), dtype=np.float32)
        for t in range(WINDOW) if side == 0 else range(WINDOW - 1, -1, -1):
            x, own = table[at[:, t]], h @ u
            zr = sigmoid(x[:, : 2 * HIDDEN] + own[:, : 2 * HIDDEN])
            z = zr[:, :HIDDEN]
            new = np.tanh(x[:, 2 * HIDDEN :] + zr[:, HIDDEN:] * own[:, 2 * HIDDEN :])
            new += z * (h - new)
            new[t >= n] = h[t >= n]
            h = new
            out[t] = h @ heads
        return out

    def windows(self, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word (of all) and logit of each window."""
        n_words = np.diff(words.first)
        text, first = window_starts(n_words)
        logits = np.zeros(len(text), dtype=np.float32)
        if not len(text):
            return text, first, logits
        gates, row = self.gates(words)
        begin = words.first[text] + first
        size = np.minimum(n_words[text] - first, WINDOW)
        for a in range(0, len(text), 8192):
            part = slice(a, a + 8192)
            at = np.minimum(begin[part, None] + np.arange(WINDOW), len(row) - 1)
            steps = self._read(0, gates, row[at], size[part]) + self._read(1, gates, row[at], size[part])
            look, out = steps[:, :, 0], steps[:, :, 1]
            look[np.arange(WINDOW)[:, None] >= size[part]] = -np.inf
            weight = np.exp(look - look.max(axis=0))
            logits[part] = (weight * out).sum(axis=0) / weight.sum(axis=0) + self.p["bias"][0]
        return text, begin, logits

    def texts(self, words) -> np.ndarray:
        """Score of each text: of its greatest window logit, or of an empty text."""
        text, _, logits = self.windows(words)
        best = np.full(len(words.first) - 1, -np.inf)
        np.maximum.at(best, text, logits)
        z = self.net.slope * np.where(np.isfinite(best), best, 0) + self.net.shift
        return np.where(np.isfinite(best), sigmoid(z), self.net.empty)


def _forward(net: Net, side: str, x: np.ndarray, mask: np.ndarray):
    """States of one direction, (steps, rows, HIDDEN), with what going back needs."""
    u, h = net.p["U" + side], np.zeros((x.shape[1], HIDDEN))
    gates = x @ net.p["W" + side] + net.p["B" + side]
    order = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
    states, kept = np.zeros((*x.shape[:2], HIDDEN)), {}
    for t in order:
        own = h @ u
        z = sigmoid(gates[t, :, :HIDDEN] + own[:, :HIDDEN])
        r = sigmoid(gates[t, :, HIDDEN : 2 * HIDDEN] + own[:, HIDDEN : 2 * HIDDEN])
        n = np.tanh(gates[t, :, 2 * HIDDEN :] + r * own[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        m = mask[t][:, None]
        kept[t] = (h, z, r, n, own[:, 2 * HIDDEN :], m)
        h = np.where(m, new, h)
        states[t] = h
    return states, kept, order


def _backward(net: Net, side: str, x, kept, order, d_states, grads) -> np.ndarray:
    u = net.p["U" + side]
    d_gates, d_h = np.zeros((*x.shape[:2], 3 * HIDDEN)), np.zeros((x.shape[1], HIDDEN))
    d_u = np.zeros_like(u)
    for t in reversed(order):
        h, z, r, n, own_n, m = kept[t]
        d = d_h + d_states[t]
        live = np.where(m, d, 0)
        d_h = np.where(m, d * z, d)
        d_n = live * (1 - z) * (1 - n * n)
        d_z = live * (h - n) * z * (1 - z)
        d_r = d_n * own_n * r * (1 - r)
        d_own = np.hstack([d_z, d_r, d_n * r])
        d_gates[t] = np.hstack([d_z, d_r, d_n])
        d_u += h.T @ d_own
        d_h = d_h + d_own @ u.T
    flat_x, flat_g = x.reshape(-1, x.shape[2]), d_gates.reshape(-1, 3 * HIDDEN)
    grads["U" + side] = d_u
    grads["W" + side] = flat_x.T @ flat_g
    grads["B" + side] = flat_g.sum(axis=0)
    return d_gates @ net.p["W" + side].T


def gradients(net: Net, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Loss, gradients of the layers, and gradient of the inputs ``x`` (steps, rows, dims)."""
    sf, kf, of = _forward(net, "f", x, mask)
    sb, kb, ob = _forward(net, "b", x, mask)
    s = np.concatenate([sf, sb], axis=2)
    look = np.where(mask, s @ net.p["look"], -np.inf)
    a = np.exp(look - look.max(axis=0))
    a /= a.sum(axis=0)
    out = s @ net.p["out"]
    pooled = (a * out).sum(axis=0)
    logit = pooled + net.p["bias"][0]
    total = weight.sum()
    loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / total)
    d = weight * (sigmoid(logit) - y) / total
    d_out, d_look = a * d, a * (out - pooled) * d
    grads = {
        "out": np.einsum("tn,tnh->h", d_out, s),
        "look": np.einsum("tn,tnh->h", d_look, s),
        "bias": np.array([d.sum()]),
    }
    d_s = d_out[:, :, None] * net.p["out"] + d_look[:, :, None] * net.p["look"]
    d_x = _backward(net, "f", x, kf, of, d_s[:, :, :HIDDEN], grads)
    d_x += _backward(net, "b", x, kb, ob, d_s[:, :, HIDDEN:], grads)
    return loss, grads, d_x


class Adam:
    """Adam for the layers; a table's vectors share one scale, that of its steepest slopes.

    With a scale of its own a rare word would move as far as one that many positive windows
    have, and the network would learn its training texts by heart.
    """

    def __init__(self, rate: float, table_rate: float):
        self.rate, self.table_rate, self.t, self.m, self.v = rate, table_rate, 0, {}, {}

    def step(self, p: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            table = k in ("word", "char")
            m = g if table else 0.9 * self.m.get(k, 0.0) + 0.1 * g
            v = self.v[k] = 0.99 * self.v.get(k, 0.0) + 0.01 * ((g * g).max() if table else g * g)
            scale = np.sqrt(v / (1 - 0.99**self.t)) + 1e-8
            if table:
                p[k] -= self.table_rate * m / scale
            else:
                self.m[k] = m
                p[k] -= self.rate * m / (1 - 0.9**self.t) / scale


def vocabulary(words, most: int = VOCABULARY) -> np.ndarray:
    """Sorted hashes of the words in two texts or more (the commonest, if too many)."""
    order = np.argsort(words.hash, kind="stable")
    hashes, texts = words.hash[order], words.text[order]
    # Words are in the order of their texts, so those of one text and hash are side by side.
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
    unique, n = np.unique(hashes[new], return_counts=True)
    kept = np.flatnonzero(n >= 2)
    return unique[np.sort(kept[np.argsort(-n[kept], kind="stable")[:most]])]


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic regression on one number, by Newton's method."""
    a, b = 1.0, 0.0
    for _ in range(50):
        q = sigmoid(a * x + b)
        g = np.array([((q - y) * x).sum() + 0.01 * a, (q - y).sum()])
        w = q * (1 - q) + 1e-6
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    return float(a), float(b)


def taken(words, texts: np.ndarray):
    """The words of some of the texts, which are numbered anew."""
    at = np.concatenate([np.arange(words.first[t], words.first[t + 1]) for t in texts] or [[]]).astype(int)
    n = np.diff(words.first)[texts]
    first = np.concatenate([[0], np.cumsum(n)])
    return replace(
        words,
        start=words.start[at],
        end=words.end[at],
        text=np.repeat(np.arange(len(texts)), n),
        hash=words.hash[at],
        first=first,
    )


def folds_of(words, folds: int) -> np.ndarray:
    """Fold of each text, by the smallest hash of its five-word windows: near copies share it."""
    least = np.full(len(words.first) - 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    # Texts of fewer words go by their smallest word.
    for hashes, at in ((words.hash, np.arange(len(words.hash))), W.windows(words, 5)):
        own = np.full_like(least, np.iinfo(np.uint64).max)
        np.minimum.at(own, words.text[at], hashes)
        least = np.where(own < np.iinfo(np.uint64).max, own, least)
    return (least % np.uint64(folds)).astype(np.int64)


def fold_logits(words, y: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Greatest logits of the texts ``own`` by a network trained on the others.

    They are not a number for texts without words, and if the others have one class only.
    """
    rest = np.flatnonzero(~own)
    if not 0 < y[rest].sum() < len(rest):
        return np.full(int(own.sum()), np.nan)
    top, has = greatest(train(taken(words, rest), y[rest]), taken(words, np.flatnonzero(own)))
    return np.where(has, top, np.nan)


def calibrated(net: Net, logits: np.ndarray, y: np.ndarray) -> Net:
    """The network with the logistic map from logits of texts it hasn't learned from to chances."""
    seen = np.isfinite(logits)
    if 0 < y[seen].sum() < seen.sum():
        net.slope, net.shift = _logistic(logits[seen], y[seen].astype(float))
        net.empty = float(sigmoid(np.array(net.slope * logits[seen].min() + net.shift)))
    return net


def greatest(net: Net, words) -> tuple[np.ndarray, np.ndarray]:
    """Greatest window logit of each text, and whether it has a window."""
    scorer, first = Scorer(net), words.first
    top = np.full(len(first) - 1, -np.inf)
    a = 0
    while a < len(top):
        b = max(a + 1, int(np.searchsorted(first, first[a] + SCORED, side="right")) - 1)
        at = slice(first[a], first[b])
        part = replace(
            words,
            start=words.start[at],
            end=words.end[at],
            text=words.text[at] - a,
            hash=words.hash[at],
            first=first[a : b + 1] - first[a],
        )
        text, _, logits = scorer.windows(part)
        np.maximum.at(top, text + a, logits)
        a = b
    return np.where(np.isfinite(top), top, 0), np.isfinite(top)


def train(words, y: np.ndarray, passes: int = PASSES, seed: int = 7) -> Net:
    """Train on windows, each with its text's label.

    A pass takes all windows of positive texts, and of those of negative ones a fresh random
    choice NEGATIVES times as large. Most windows of a positive text are like those of
    negative texts; what only positive texts have is left to tell them apart.
    """
    r = np.random.default_rng(seed)
    share = float(y.mean()) if len(y) else 0.0
    net = Net.fresh(vocabulary(words), seed)
    net.empty = share * 0.5
    n_words = np.diff(words.first)
    text, first = window_starts(n_words)
    of_class = [np.flatnonzero(y[text] == k) for k in (0, 1)]
    if not all(len(x) for x in of_class):
        net.p["out"][:] = 0
        net.slope, net.shift = 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return net
    begin = words.first[text] + first
    size = np.minimum(n_words[text] - first, WINDOW)
    ids = net.word_ids(words.hash)
    optimiser = Adam(RATE, TABLE_RATE)
    negative, positive = of_class
    for _ in range(passes):
        n = min(len(negative), NEGATIVES * len(positive))
        chosen = r.permutation(np.concatenate([positive, r.choice(negative, n, replace=False)]))
        target = y[text[chosen]].astype(float)
        # Both classes weigh the same, whatever their shares.
        weight = np.where(target > 0, 0.5 / target.mean(), 0.5 / (1 - target.mean()))
        for a in range(0, len(chosen), BATCH):
            part, which = slice(a, a + BATCH), chosen[a : a + BATCH]
            _learn(net, optimiser, words, ids, begin[which], size[which], target[part], weight[part])
    top, has = greatest(net, words)
    net.slope, net.shift = _logistic(top[has], y[has].astype(float))
    net.empty = float(sigmoid(np.array(net.slope * np.min(top[has]) + net.shift)))
    return net


def _learn(net, optimiser, words, ids, begin, size, target, weight) -> None:
    at = np.minimum(begin[None, :] + np.arange(WINDOW)[:, None], len(words.hash) - 1)
    mask = np.arange(WINDOW)[:, None] < size
    used, row = np.unique(at, return_inverse=True)
    tri, start = trigram_ids(words.lowered, words.start[used], words.end[used])
    length = (words.end - words.start)[used]
    chars = np.add.reduceat(net.p["char"][tri], start, axis=0) / length[:, None]
    x = np.hstack([net.p["word"][ids[used]], chars])[row.reshape(at.shape)]
    _, grads, d_x = gradients(net, x, mask, target, weight)
    d_used = np.zeros((len(used), WORD + CHARS))
    np.add.at(d_used, row.ravel(), d_x.reshape(-1, WORD + CHARS))
    grads["word"] = PULL * net.p["word"]
    np.add.at(grads["word"], ids[used], d_used[:, :WORD])
    # Words without a vector of their own share row 0, which stays as it is.
    grads["word"][0] = 0
    grads["char"] = PULL * net.p["char"]
    np.add.at(grads["char"], tri, np.repeat(d_used[:, WORD:] / length[:, None], length, axis=0))
    optimiser.step(net.p, grads)
