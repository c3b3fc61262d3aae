"""A small gated recurrent language model in numpy, with a class-factored softmax.

Tokens are numbers: shortlist words first, then the end of a document, then one number for each tail class.
log P(token | state) = log P(class | state) + log P(word | class, state). The end and every tail class are
classes of one token here; what a tail word has within its class is counted elsewhere. Tokens of many
documents lie in one flat array; documents are read side by side in lanes, one step at a time, and a state
is set to zero where a document begins.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
CLASS_WORDS = 32
STEPS = 16  # of truncated backpropagation
LANES = 512
OUTPUT_ROWS = 16_384
LOGIT = 60.0  # the sum of a row of exponentials up to it is a float
RATE = 0.01

Params = dict[str, np.ndarray]


def shapes(words: int, tails: int, hidden: int = HIDDEN) -> dict[str, tuple[int, ...]]:
    """``words`` in the shortlist, a multiple of CLASS_WORDS."""
    groups = words // CLASS_WORDS
    return {
        "x": (words + 1 + tails, 3 * hidden),
        "u": (hidden, 2 * hidden),
        "v": (hidden, hidden),
        "c": (hidden, groups + 1 + tails),
        "cb": (groups + 1 + tails,),
        "w": (groups, hidden, CLASS_WORDS),
        "wb": (groups, CLASS_WORDS),
    }


def initial(counts: np.ndarray, words: int, tails: int, hidden: int = HIDDEN) -> Params:
    """Small fixed weights; the biases are those of the tokens' counts, so training starts at the class unigram model."""
    rng = np.random.default_rng(0)
    p = {k: (rng.normal(0, 0.15, s)).astype(np.float32) for k, s in shapes(words, tails, hidden).items()}
    logs = np.log(counts + 1.0)
    inside = logs[:words].reshape(-1, CLASS_WORDS)
    top = inside.max(axis=1, keepdims=True)
    total = top + np.log(np.exp(inside - top).sum(axis=1, keepdims=True))
    p["wb"], p["cb"] = (inside - total).astype(np.float32), np.r_[total[:, 0], logs[words:]].astype(np.float32)
    p["cb"] -= p["cb"].max()
    p["c"] *= 0.1
    p["w"] *= 0.1
    return p


def flatten(p: Params) -> np.ndarray:
    return np.concatenate([v.ravel() for v in p.values()])


def unflatten(flat: np.ndarray, words: int, tails: int) -> Params:
    out, at = {}, 0
    for k, shape in shapes(words, tails).items():
        n = int(np.prod(shape))
        out[k] = flat[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


class Gru:
    def __init__(self, params: Params) -> None:
        self.p = params
        self.hidden = params["v"].shape[0]
        self.groups = len(params["w"])
        self.words = self.groups * CLASS_WORDS

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.words, ids // CLASS_WORDS, ids - self.words + self.groups)

    def step(self, h: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = self.hidden
        gates = h @ self.p["u"]
        gates += x[:, : 2 * n]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        reset = gates[:, :n] * h
        new = reset @ self.p["v"]
        new += x[:, 2 * n :]
        np.tanh(new, out=new)
        return new + gates[:, n:] * (h - new), gates, reset, new

    def by_group(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]]]:
        """Rows whose token is a shortlist word, class by class: (the rows, their words' places within a class, (class, its slice))."""
        listed = np.flatnonzero(ids < self.words)
        which = (ids[listed] // CLASS_WORDS).astype(np.int16)  # sorted by radix
        order = np.argsort(which, kind="stable")
        cut = np.searchsorted(which[order], np.arange(self.groups + 1))
        rows = listed[order]
        return rows, ids[rows] % CLASS_WORDS, [(g, slice(cut[g], cut[g + 1])) for g in range(self.groups) if cut[g] < cut[g + 1]]

    def word_logits(self, states: np.ndarray, groups: list[tuple[int, slice]]) -> np.ndarray:
        """Logits within a class, for states that lie class by class."""
        logits = np.empty((len(states), CLASS_WORDS), states.dtype)
        for g, at in groups:
            np.matmul(states[at], self.p["w"][g], out=logits[at])
            logits[at] += self.p["wb"][g]
        return logits

    def flat_logits(self, weights: str, biases: str) -> bool:
        """Whether no logit can be so far from zero that its exponential leaves the numbers; states are within -1 and 1."""
        return float(np.abs(self.p[weights]).sum(axis=-2).max(initial=0) + np.abs(self.p[biases]).max(initial=0)) < LOGIT

    @staticmethod
    def exponentials(logits: np.ndarray, flat: bool) -> np.ndarray:
        """Replace logits by their exponentials, scaled by the largest unless ``flat``; returns the sums of rows."""
        if not flat:
            logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        return logits @ np.ones(logits.shape[1], logits.dtype)

    def log_probability(self, h: np.ndarray, ids: np.ndarray, flat: tuple[bool, bool] = (False, False)) -> np.ndarray:
        """Natural log of the probability of each token after each state. ``flat`` is ``flat_logits`` of classes and words."""
        out = self.log_softmax(h @ self.p["c"] + self.p["cb"], self.classes(ids), flat[0])
        rows, places, groups = self.by_group(ids)
        out[rows] += self.log_softmax(self.word_logits(h[rows], groups), places, flat[1])
        return out

    @classmethod
    def log_softmax(cls, logits: np.ndarray, chosen: np.ndarray, flat: bool) -> np.ndarray:
        """The log-probability of one column in each row; logits are replaced."""
        if not flat:
            logits -= logits.max(axis=1, keepdims=True)
        own = logits[np.arange(len(chosen)), chosen]
        return own - np.log(cls.exponentials(logits, True))

    def score(self, ids: np.ndarray, starts: np.ndarray, lanes: int = LANES) -> np.ndarray:
        """Log-likelihood of each document; ``starts`` are where they begin in ``ids``, none is empty.

        A document is read from its beginning to its end in one lane, and its state is carried from window to window.
        """
        lengths = np.diff(np.r_[starts, len(ids)])
        lane_of, load = np.zeros(len(starts), np.int64), np.zeros(lanes, np.int64)
        for d in np.argsort(-lengths, kind="stable"):  # longest first, each to the shortest lane
            lane_of[d] = k = int(load.argmin())
            load[k] += lengths[d]
        lane_rank = np.empty(lanes, np.int64)
        lane_rank[np.argsort(-load, kind="stable")] = np.arange(lanes)
        docs = np.argsort(lane_rank[lane_of], kind="stable")
        begin = np.r_[0, np.cumsum(lengths[docs])]
        source = np.repeat((starts[docs] - begin[:-1]).astype(np.int32), lengths[docs]) + np.arange(len(ids), dtype=np.int32)
        flat, first = ids[source], np.zeros(len(ids), bool)
        del source
        first[begin[:-1]] = True
        load = np.sort(load)[::-1]
        offset = np.r_[0, np.cumsum(load)[:-1]]
        got, h = np.zeros(len(ids)), np.zeros((lanes, self.hidden), np.float32)
        longer = np.searchsorted(-load, -np.arange(int(load[0])), "left")  # lanes longer than t
        ahead = np.r_[0, np.cumsum(longer)]
        level = self.flat_logits("c", "cb"), self.flat_logits("w", "wb")
        a = 0
        while a < len(longer):  # the inputs and the softmax of many steps at once
            b = max(a + 1, int(np.searchsorted(ahead, ahead[a] + OUTPUT_ROWS, "right")) - 1)
            at = np.concatenate([offset[:n] + t for t, n in enumerate(longer[a:b].tolist(), a)])
            own, begins = flat[at].astype(np.int64), first[at]
            x = self.p["x"][own]
            states = np.empty((len(at), self.hidden), np.float32)
            k = 0
            for n in longer[a:b].tolist():
                state = np.multiply(h[:n], ~begins[k : k + n, None], out=states[k : k + n])
                h = self.step(state, x[k : k + n])[0]
                k += n
            got[at] = self.log_probability(states, own, level)
            a = b
        out = np.zeros(len(starts))
        out[docs] = np.add.reduceat(got, begin[:-1]) if len(docs) else 0
        return out

    def train(self, ids: np.ndarray, starts: np.ndarray, optimiser: Adam, lanes: int = LANES) -> None:
        """One pass of truncated backpropagation over all tokens, cut into lanes of one length."""
        lanes = max(1, min(lanes, len(ids) // STEPS))
        steps = -(-len(ids) // lanes)
        first = np.zeros(steps * lanes, bool)
        first[starts] = True
        known = np.zeros(steps * lanes, bool)
        known[: len(ids)] = True
        flat = np.zeros(steps * lanes, np.int64)
        flat[: len(ids)] = ids
        flat, first, known = (a.reshape(lanes, steps).T for a in (flat, first, known))
        h = np.zeros((lanes, self.hidden), np.float32)
        for a in range(0, steps, STEPS):
            h = self.window(h, flat[a : a + STEPS], first[a : a + STEPS], known[a : a + STEPS], optimiser)

    def window(self, h: np.ndarray, ids: np.ndarray, first: np.ndarray, known: np.ndarray, optimiser: Adam) -> np.ndarray:
        p, n, (steps, lanes) = self.p, self.hidden, ids.shape
        x = p["x"][ids]
        trace = []
        for t in range(steps):
            alive = ~first[t][:, None]
            h = h * alive
            after, gates, reset, new = self.step(h, x[t])
            trace.append((h, gates, reset, new, alive))
            h = after
        states, flat, weight = np.concatenate([s[0] for s in trace]), ids.ravel(), known.ravel().astype(np.float32)[:, None]
        total = max(1.0, float(weight.sum()))
        d = states @ p["c"] + p["cb"]
        d *= weight / self.exponentials(d, self.flat_logits("c", "cb"))[:, None]
        d[np.arange(len(flat)), self.classes(flat)] -= weight[:, 0]
        grad = {"c": states.T @ d, "cb": np.ones(len(d), d.dtype) @ d, "w": np.zeros_like(p["w"]), "wb": np.zeros_like(p["wb"])}
        back = d @ p["c"].T
        rows, places, groups = self.by_group(flat)
        s, own, wait = states[rows], np.empty((len(rows), n), states.dtype), weight[rows]
        q = self.word_logits(s, groups)
        q *= wait / self.exponentials(q, self.flat_logits("w", "wb"))[:, None]
        q[np.arange(len(rows)), places] -= wait[:, 0]
        for g, at in groups:
            np.matmul(s[at].T, q[at], out=grad["w"][g])
            grad["wb"][g] = np.ones(len(q[at]), q.dtype) @ q[at]
            np.matmul(q[at], p["w"][g].T, out=own[at])
        back[rows] += own
        back = back.reshape(steps, lanes, n)
        before, gates, reset, new = (np.stack([s[i] for s in trace]) for i in range(4))
        r, z = gates[..., :n], gates[..., n:]
        # What each step's gradient is multiplied by, for all steps at once.
        to_new, to_gates, moved = (1 - z) * (1 - new * new), gates * (1 - gates), before - new
        to_reset, to_update = to_gates[..., :n] * before, to_gates[..., n:] * moved
        dx = np.empty((steps, lanes, 3 * n), states.dtype)
        dh, vt, ut = np.zeros((lanes, n), states.dtype), np.ascontiguousarray(p["v"].T), np.ascontiguousarray(p["u"].T)
        for t in range(steps - 1, -1, -1):
            dn = np.multiply(dh, to_new[t])
            dx[t, :, 2 * n :] = dn
            dreset = dn @ vt
            dg = dx[t, :, : 2 * n]
            np.multiply(dreset, to_reset[t], out=dg[:, :n])
            np.multiply(dh, to_update[t], out=dg[:, n:])
            dreset *= r[t]
            dh *= z[t]
            dh += dreset
            dh += dg @ ut
            dh += back[t]
            dh *= trace[t][4]
        steps_of = dx.reshape(-1, 3 * n)
        grad["v"] = reset.reshape(-1, n).T @ steps_of[:, 2 * n :]
        grad["u"] = states.T @ steps_of[:, : 2 * n]
        order = np.argsort(flat.astype(np.uint16), kind="stable")
        cut = np.flatnonzero(np.r_[True, np.diff(flat[order]) > 0])
        grad["x"] = np.zeros_like(p["x"])
        grad["x"][flat[order][cut]] = np.add.reduceat(steps_of[order], cut, axis=0)
        optimiser.update(p, {k: v / total for k, v in grad.items()})
        return h


class Adam:
    """The usual adaptive step; gradients are means over the tokens of a window."""

    def __init__(self, rate: float = RATE) -> None:
        self.rate, self.count, self.m, self.v = rate, 0, {}, {}

    def update(self, params: Params, grad: Params) -> None:
        self.count += 1
        size = self.rate * np.sqrt(1 - 0.99**self.count) / (1 - 0.9**self.count)
        for k, g in grad.items():
            m, v = self.m.setdefault(k, np.zeros_like(g)), self.v.setdefault(k, np.zeros_like(g))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            params[k] -= (size * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
