"""A small gated recurrent network in numpy with a class-factored softmax."""

from __future__ import annotations

import heapq

import numpy as np

MEMBERS = 32  # words of a class
HIDDEN, WINDOW, MAX_LANES, STEPS_WANTED = 16, 16, 512, 128
CLIP = 5.0


class Shape:
    """Sizes of the parts of the parameter vector.

    Tokens 0 to ``words`` - 1 are words in classes of ``MEMBERS``; tokens from ``first_tail`` on
    are whole classes of other words, whose shares within the class are not the network's.
    """

    def __init__(self, words: int, tails: int):
        self.groups = -(-words // MEMBERS)
        self.first_tail = self.groups * MEMBERS
        self.words, self.tails = words, tails
        self.start = self.first_tail + tails  # what precedes the first token
        self.classes = self.groups + tails
        h = HIDDEN
        self.parts = {
            "x": (self.start + 1, 3 * h), "u": (h, 2 * h), "v": (h, h), "c": (h, self.classes),
            "cb": (self.classes,), "w": (self.groups, h, MEMBERS), "wb": (self.groups, MEMBERS)}
        self.size = sum(int(np.prod(s)) for s in self.parts.values())

    def split(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts.items():
            n = int(np.prod(shape))
            out[name] = flat[at:at + n].reshape(shape)
            at += n
        return out

    def initial(self, counts: np.ndarray, seed: int = 11) -> np.ndarray:
        """Small random weights; biases that give each token its share of the training tokens.

        ``counts``: of the words, then of the tail classes.
        """
        rng = np.random.default_rng(seed)
        flat = rng.normal(0, 0.1, self.size).astype(np.float32)
        p = self.split(flat)
        members = np.zeros(self.first_tail)
        members[:self.words] = counts[:self.words]
        members = members.reshape(self.groups, MEMBERS)
        p["w"][:] *= 0.1
        p["c"][:] *= 0.1
        p["wb"][:] = np.where(members > 0, np.log(np.maximum(members, 1)), -30)
        tails = np.asarray(counts[self.words:], float)
        p["cb"][:] = np.log(np.maximum(np.concatenate([members.sum(1), tails]), 0.5))
        p["cb"][:] -= np.log(max(counts.sum(), 1))
        p["wb"][:] -= np.log(np.maximum(members.sum(1), 1))[:, None]
        return flat


def _exp_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp(x) and its row sums; float32 holds exp(80)."""
    e = np.exp(np.minimum(x, np.float32(80), out=x))
    return e, e.sum(axis=1)


class Lanes:
    """Texts laid end to end in lanes of similar length, the longest lane first.

    At each step the lanes that still have a token are the first ones, so no step works on
    padding; a text's first token starts from a state of zeros.
    """

    def __init__(self, texts: list[np.ndarray], shape: Shape):
        total = sum(map(len, texts))
        n = int(np.clip(total // (WINDOW * STEPS_WANTED), 16, MAX_LANES))
        n = max(1, min(n, len(texts)))
        heap, lanes = [(0, i) for i in range(n)], [[] for _ in range(n)]
        for k in sorted(range(len(texts)), key=lambda k: -len(texts[k])):
            size, i = heapq.heappop(heap)
            lanes[i].append(k)
            heapq.heappush(heap, (size + len(texts[k]), i))
        lanes.sort(key=lambda own: -sum(len(texts[k]) for k in own))
        sizes = np.array([sum(len(texts[k]) for k in own) for own in lanes])
        steps = int(sizes.max(initial=0))
        self.active = np.searchsorted(-sizes, -np.arange(steps), side="left")
        self.tokens = np.zeros((steps, n), np.int32)
        self.before = np.zeros((steps, n), np.int32)
        self.text = np.zeros((steps, n), np.int32)
        for i, own in enumerate(lanes):
            at = 0
            for k in own:
                end = at + len(texts[k])
                self.tokens[at:end, i] = texts[k]
                self.before[at, i] = shape.start
                self.before[at + 1:end, i] = texts[k][:-1]
                self.text[at:end, i] = k
                at = end
        self.steps, self.n, self.start = steps, n, shape.start

    def windows(self):
        """(first step, last step + 1) with the same active lanes throughout."""
        at = 0
        while at < self.steps:
            end = min(at + WINDOW, self.steps)
            if self.active[end - 1] != self.active[at]:
                end = at + int(np.searchsorted(-self.active[at:end], -self.active[at] + 1))
            yield at, end
            at = end


class Network:
    def __init__(self, shape: Shape, flat: np.ndarray):
        self.shape, self.flat = shape, flat
        self.p = shape.split(flat)

    def run(self, before: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, dict]:
        """States after each token of a window (steps x lanes), and what backpropagation needs."""
        p, H = self.p, HIDDEN
        t, n = before.shape
        first = before == self.shape.start
        gx = p["x"][before]
        old = np.empty((t, n, H), np.float32)
        zr = np.empty((t, n, 2 * H), np.float32)
        c = np.empty((t, n, H), np.float32)
        out = np.empty((t, n, H), np.float32)
        fresh = first.any(axis=1)
        u, v = p["u"], p["v"]
        for i in range(t):
            if fresh[i]:
                h = np.where(first[i][:, None], np.float32(0), h)
            old[i] = h
            g = zr[i]
            np.matmul(h, u, out=g)
            g += gx[i, :, :2 * H]
            g *= np.float32(0.5)
            np.tanh(g, out=g)
            g *= np.float32(0.5)
            g += np.float32(0.5)
            k = c[i]
            np.matmul(g[:, H:] * h, v, out=k)
            k += gx[i, :, 2 * H:]
            np.tanh(k, out=k)
            h = h + g[:, :H] * (k - h)
            out[i] = h
        return out, {"before": before, "first": first, "fresh": fresh, "old": old, "zr": zr, "c": c}

    def log_probs(self, states: np.ndarray, tokens: np.ndarray, learn: bool = False):
        """Log probability of each token; with ``learn`` also gradients of its negative sum."""
        p, s = self.p, self.shape
        group = np.where(tokens < s.first_tail, tokens // MEMBERS, tokens - s.first_tail + s.groups)
        rows = np.arange(len(tokens))
        logits = states @ p["c"]
        logits += p["cb"]
        e, z = _exp_sums(logits)
        lp = logits[rows, group] - np.log(z)
        order = np.argsort(group, kind="stable")
        ends = np.searchsorted(group[order], np.arange(s.groups + 1))
        grad = {}
        if learn:
            d = e
            d /= z[:, None]
            d[rows, group] -= 1
            grad["c"], grad["cb"] = states.T @ d, d.sum(axis=0)
            ds = d @ p["c"].T
            grad["w"], grad["wb"] = np.zeros_like(p["w"]), np.zeros_like(p["wb"])
        for g in range(s.groups):
            if ends[g] == ends[g + 1]:
                continue
            own = order[ends[g]:ends[g + 1]]
            h = states[own]
            logits = h @ p["w"][g]
            logits += p["wb"][g]
            d, z = _exp_sums(logits)
            member, k = tokens[own] - g * MEMBERS, rows[:len(own)]
            lp[own] += logits[k, member] - np.log(z)
            if learn:
                d /= z[:, None]
                d[k, member] -= 1
                grad["w"][g], grad["wb"][g] = h.T @ d, d.sum(axis=0)
                ds[own] += d @ p["w"][g].T
        return (lp, grad, ds) if learn else (lp, None, None)

    def back(self, saved: dict, ds: np.ndarray, grad: dict) -> None:
        """Backpropagation through one window; nothing goes further back."""
        p, H = self.p, HIDDEN
        old, zr, c = saved["old"], saved["zr"], saved["c"]
        t, n, _ = old.shape
        dx = np.empty((t, n, 3 * H), np.float32)
        dh = np.zeros((n, H), np.float32)
        ut, vt = np.ascontiguousarray(p["u"].T), np.ascontiguousarray(p["v"].T)
        for i in range(t - 1, -1, -1):
            dh += ds[i]
            z, r, k, h = zr[i, :, :H], zr[i, :, H:], c[i], old[i]
            dk = dh * z * (1 - k * k)
            dx[i, :, 2 * H:] = dk
            drh = dk @ vt
            dx[i, :, :H] = dh * (k - h) * z * (1 - z)
            dx[i, :, H:2 * H] = drh * h * r * (1 - r)
            dh = dh * (1 - z) + drh * r + dx[i, :, :2 * H] @ ut
            if saved["fresh"][i]:
                dh = np.where(saved["first"][i][:, None], np.float32(0), dh)
        flat = dx.reshape(-1, 3 * H)
        hs = old.reshape(-1, H)
        grad["u"] = hs.T @ flat[:, :2 * H]
        grad["v"] = (zr[:, :, H:].reshape(-1, H) * hs).T @ flat[:, 2 * H:]
        before = saved["before"].ravel()
        order = np.argsort(before, kind="stable")
        ids, starts = np.unique(before[order], return_index=True)
        grad["x"] = np.zeros_like(p["x"])
        grad["x"][ids] = np.add.reduceat(flat[order], starts, axis=0)

    def train(self, texts: list[np.ndarray], state: dict, rates: tuple[float, float]) -> None:
        """One pass over the texts, one Adam step per window; ``state`` keeps the moments.

        The texts are laid end to end and cut into lanes of equal length, so that every step
        sees as many texts (a text that a cut parts goes on from a state of zeros).  The learning
        rate goes from the first of ``rates`` to the second.
        """
        tokens = np.concatenate(texts)
        before = np.concatenate([[self.shape.start], tokens[:-1]])
        before[np.cumsum([len(t) for t in texts])[:-1]] = self.shape.start
        n = int(np.clip(len(tokens) // (WINDOW * STEPS_WANTED), 16, MAX_LANES))
        n = min(n, len(tokens))
        steps = -(-len(tokens) // n)
        short = steps * n - len(tokens)  # the first texts fill up the last lane
        tokens, before = (np.resize(x, len(x) + short).reshape(n, steps).T.copy()
                          for x in (tokens, before))
        before[0] = self.shape.start
        h = np.zeros((n, HIDDEN), np.float32)
        for at in range(0, steps, WINDOW):
            own = tokens[at:at + WINDOW]
            out, saved = self.run(before[at:at + WINDOW], h)
            h = out[-1]
            _, grad, ds = self.log_probs(out.reshape(-1, HIDDEN), own.ravel(), learn=True)
            self.back(saved, ds.reshape(out.shape), grad)
            g = np.concatenate([grad[k].ravel() for k in self.shape.parts])
            g /= np.float32(own.size)
            self.adam(g, state, rates[0] + (rates[1] - rates[0]) * at / steps)

    def adam(self, g: np.ndarray, state: dict, rate: float) -> None:
        norm = float(np.sqrt(np.dot(g, g)))
        if norm > CLIP:
            g *= np.float32(CLIP / norm)
        state["t"] = state.get("t", 0) + 1
        m, v = state.setdefault("m", np.zeros_like(g)), state.setdefault("v", np.zeros_like(g))
        m += np.float32(0.1) * (g - m)
        v += np.float32(0.01) * (g * g - v)
        t = state["t"]
        step = rate * np.sqrt(1 - 0.99 ** t) / (1 - 0.9 ** t)
        self.flat -= np.float32(step) * m / (np.sqrt(v) + np.float32(1e-6))

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """The natural log probability of each whole text; the state goes on over windows."""
        lanes = Lanes(texts, self.shape)
        total = np.zeros(len(texts))
        h = np.zeros((lanes.n, HIDDEN), np.float32)
        for at, end in lanes.windows():
            n = lanes.active[at]
            out, _ = self.run(lanes.before[at:end, :n], h[:n])
            h = out[-1]
            lp, _, _ = self.log_probs(out.reshape(-1, HIDDEN), lanes.tokens[at:end, :n].ravel())
            total += np.bincount(lanes.text[at:end, :n].ravel(), lp, len(texts))
        return total
