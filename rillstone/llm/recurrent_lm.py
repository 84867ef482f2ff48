"""A gated recurrent language model in numpy.

A gated recurrent unit reads classes of tokens; its state before a token predicts the token by a
class-factored softmax: the class, then the word within it. Words of the vocabulary have softmax
classes of like frequency; other words fall into classes of their shape, within which their
probabilities are those of their smoothed counts. Training backpropagates through windows of WINDOW
tokens or more; states are carried from window to window and end with the document.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN, WINDOW, LONGEST, LANES, BLOCK = 16, 16, 8, 512, 2048
#: Tokens whose probabilities are computed at once.
PART = 32_768
RATE, DECAY1, DECAY2 = 0.01, 0.9, 0.99
#: Shapes of words beyond the vocabulary.
SHAPES = 8
END = 0


#: Logits above it are cut before they are raised.
MOST = 60


def _bounded(w: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no state, whose parts lie between -1 and 1, has a logit above MOST."""
    return bool((np.abs(w).sum(axis=1) + bias).max(initial=0) <= MOST)


def _softmax(x: np.ndarray, at: np.ndarray, grads: bool, bounded: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probability of column at of each row; in place of x, times what is returned last, the gradient of its negative."""
    rows = np.arange(len(at))
    found = x[rows, at]
    if not bounded:
        np.minimum(x, MOST, out=x)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    if grads:
        x[rows, at] -= total
    return found - np.log(total), x, np.reciprocal(total)


class Model:
    """Parameters by name, in float32; words are numbered by falling frequency, shapes follow them."""

    NAMES = ("inputs", "recurrent", "bias", "classes", "class_bias", "words", "word_bias")

    def __init__(self, word_counts: np.ndarray, shape_counts: np.ndarray, hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        k = len(word_counts)
        self.hidden, self.k = hidden, k
        self.word_classes = max(1, round(np.sqrt(k) * 0.7))
        # Classes hold like shares of the root of the counts.
        share = np.cumsum(np.sqrt(word_counts + 1.0))
        self.of_word = np.minimum((share / share[-1] * self.word_classes - 1e-9).astype(np.int64), self.word_classes - 1)
        self.begin = np.searchsorted(self.of_word, np.arange(self.word_classes + 1))
        self.of_id = np.append(self.of_word, self.word_classes + np.arange(SHAPES))
        by_class = np.append(np.bincount(self.of_word, word_counts, self.word_classes), shape_counts) + 1.0
        f = np.float32
        self.p = {
            "inputs": (rng.standard_normal((k + SHAPES, 3 * hidden)) * 0.1).astype(f),
            "recurrent": (rng.standard_normal((3 * hidden, hidden)) / np.sqrt(hidden)).astype(f),
            "bias": np.zeros(3 * hidden, f),
            "classes": np.zeros((self.word_classes + SHAPES, hidden), f),
            "class_bias": np.log(by_class / by_class.sum()).astype(f),
            "words": np.zeros((k, hidden), f),
            "word_bias": np.log((word_counts + 1.0) / by_class[self.of_word]).astype(f),
        }

    def vector(self) -> np.ndarray:
        return np.concatenate([self.p[n].ravel() for n in self.NAMES])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            size = self.p[n].size
            self.p[n] = vector[at : at + size].reshape(self.p[n].shape).astype(np.float32)
            at += size

    def recurrence(self) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and recurrent weights as advance takes them: the gates negated, the bias a last column."""
        sign = np.append(np.full(2 * self.hidden, -1), np.ones(self.hidden)).astype(self.p["bias"].dtype)
        return self.p["inputs"] * sign, np.column_stack([self.p["recurrent"], self.p["bias"]]) * sign[:, None]

    def begin_states(self, lanes: int) -> np.ndarray:
        """States of nothing read yet; the last row is the bias's ones."""
        return np.vstack([np.zeros((self.hidden, lanes)), np.ones((1, lanes))]).astype(self.p["bias"].dtype)

    def advance(self, weights: np.ndarray, x: np.ndarray, h: np.ndarray, kept: tuple[np.ndarray, ...] | None = None) -> None:
        """Changes the states h to those after tokens with input columns x (both as recurrence and begin_states give them).

        kept gets what backpropagation needs: both gates, the candidate and what of it the state has. Lanes are
        columns: gates are contiguous.
        """
        n = self.hidden
        a = weights @ h
        if kept:
            zr, c, own = kept
            own[:] = a[2 * n :]
            np.add(x[: 2 * n], a[: 2 * n], out=zr)
        else:
            zr, c, own = a[: 2 * n], None, a[2 * n :]
            zr += x[: 2 * n]
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        c = np.multiply(zr[n:], own, out=c)
        c += x[2 * n :]
        np.tanh(c, out=c)
        new = h[:n]
        new -= c
        new *= zr[:n]
        new += c

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray]:
        """The states after one token a lane; x holds columns of the parameters' own inputs."""
        _, weights = self.recurrence()
        both = np.vstack([h, np.ones((1, h.shape[1]), h.dtype)])
        self.advance(weights, np.concatenate([-x[: 2 * self.hidden], x[2 * self.hidden :]]), both)
        return (both[: self.hidden],)

    def output(self, states: np.ndarray, ids: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each id's class, and of words within their classes; the loss's gradient at the states if grads are gathered."""
        target = self.of_id[ids]
        out = np.empty(len(ids), np.float64)
        train = grads is not None
        back = np.empty_like(states) if train else None
        if train:
            for n in ("classes", "class_bias", "words", "word_bias"):
                grads[n] = np.zeros_like(self.p[n])
        order = np.argsort(target.astype(np.int16), kind="stable")  # few classes: a radix sort
        states, ids, target = states[order], ids[order], target[order]
        few = _bounded(self.p["classes"], self.p["class_bias"])
        for a in range(0, len(ids), BLOCK):
            s = states[a : a + BLOCK]
            x = s @ self.p["classes"].T
            x += self.p["class_bias"]
            out[a : a + BLOCK], d, share = _softmax(x, target[a : a + BLOCK], train, few)
            if train:
                grads["classes"] += d.T @ (s * share[:, None])
                grads["class_bias"] += share @ d
                back[a : a + BLOCK] = d @ self.p["classes"]
                back[a : a + BLOCK] *= share[:, None]
        edges = np.searchsorted(target, np.arange(self.word_classes + 1))
        few = _bounded(self.p["words"], self.p["word_bias"])
        for c in range(self.word_classes):
            i, j, a, b = edges[c], edges[c + 1], self.begin[c], self.begin[c + 1]
            if i == j or b - a < 2:
                continue
            s, w = states[i:j], self.p["words"][a:b]
            x = s @ w.T
            x += self.p["word_bias"][a:b]
            logp, d, share = _softmax(x, ids[i:j] - a, train, few)
            out[i:j] += logp
            if train:
                grads["words"][a:b] = d.T @ (s * share[:, None])
                grads["word_bias"][a:b] = share @ d
                d = d @ w
                d *= share[:, None]
                back[i:j] += d
        undone = np.empty_like(out)
        undone[order] = out
        if train:
            for n in ("classes", "class_bias", "words", "word_bias"):
                grads[n] /= len(ids)
            spread = np.empty_like(back)
            spread[order] = back / np.float32(len(ids))
            back = spread
        return undone, back

    def window(self, ids: np.ndarray, h: np.ndarray, real: np.ndarray | None = None) -> tuple[np.ndarray, dict, float]:
        """Carried state, gradients and mean loss of a window (steps x lanes); only tokens where real holds count."""
        steps, lanes = ids.shape
        n, f = self.hidden, self.p["inputs"].dtype
        if len(h) == n:
            h = np.vstack([h, np.ones((1, lanes), f)])
        inputs, weights = self.recurrence()
        x = np.ascontiguousarray(inputs[ids].transpose(0, 2, 1))
        states, zr, c, own = (np.empty((steps, m * n, lanes), f) for m in (1, 2, 1, 1))
        goes_on = (ids != END).astype(f)
        for t in range(steps):
            states[t] = h[:n]
            self.advance(weights, x[t], h, (zr[t], c[t], own[t]))
            h[:n] *= goes_on[t]
        grads: dict[str, np.ndarray] = {}
        flat = states.transpose(0, 2, 1).reshape(-1, n)
        if real is None:
            logp, back = self.output(flat, ids.ravel(), grads)
        else:
            some = np.flatnonzero(real.ravel())
            logp, found = self.output(flat[some], ids.ravel()[some], grads)
            back = np.zeros_like(flat)
            back[some] = found
        back = np.ascontiguousarray(back.reshape(steps, lanes, n).transpose(0, 2, 1))
        # What a step's gradient is multiplied with, of all steps at once; in the arrays that hold the gates.
        z, r = zr[:, :n], zr[:, n:]
        left = 1 - z
        by_z = states - c
        by_z *= z
        by_z *= left
        by_c = np.multiply(c, c, out=c)
        np.subtract(1, by_c, out=by_c)
        by_c *= left
        by_r = np.subtract(1, r, out=left)
        by_r *= r
        by_r *= own
        dx, da = np.empty((steps, 3 * n, lanes), f), np.empty((steps, 3 * n, lanes), f)
        dh = np.zeros((n, lanes), f)
        u_t = np.ascontiguousarray(self.p["recurrent"].T)
        for t in range(steps - 1, -1, -1):
            dh *= goes_on[t]
            dt, at = dx[t], da[t]
            np.multiply(dh, by_z[t], out=dt[:n])
            np.multiply(dh, by_c[t], out=dt[2 * n :])
            np.multiply(dt[2 * n :], by_r[t], out=dt[n : 2 * n])
            at[: 2 * n] = dt[: 2 * n]
            np.multiply(dt[2 * n :], r[t], out=at[2 * n :])
            dh *= z[t]
            dh += u_t @ at
            dh += back[t]
        grads["recurrent"] = np.matmul(da, states.transpose(0, 2, 1)).sum(axis=0)
        grads["bias"] = da.sum(axis=(0, 2))
        flat = ids.ravel()
        order = np.argsort(flat.astype(np.int16) if self.k < 30_000 else flat, kind="stable")
        start = np.flatnonzero(np.append(True, np.diff(flat[order]) > 0))
        grads["inputs"] = np.zeros_like(self.p["inputs"])
        grads["inputs"][flat[order][start]] = np.add.reduceat(dx.transpose(0, 2, 1).reshape(-1, 3 * n)[order], start)
        return h[:n], grads, -float(logp.mean())


class Trainer:
    """Adam over windows of a stream of token ids."""

    def __init__(self, model: Model):
        self.model, self.t, self.tokens, self.loss = model, 0, 0, 0.0
        self.m = {n: np.zeros_like(v) for n, v in model.p.items()}
        self.v = {n: np.zeros_like(v) for n, v in model.p.items()}

    def feed(self, ids: np.ndarray, first: np.ndarray) -> None:
        """Learns whole documents ids[first[i]:first[i + 1]] once, every token of them.

        Documents are dealt to lanes, longest first, each to the shortest lane; none is cut. Lanes run side
        by side, longest first, while they last; states are carried on and end with the documents.
        """
        lens = np.diff(first)
        lanes = int(min(LANES, max(1, len(ids) // (WINDOW * 64)), len(lens)))
        if not len(ids):
            return
        heap = [(0, i) for i in range(lanes)]
        docs: list[list[int]] = [[] for _ in range(lanes)]
        for d in np.argsort(-lens, kind="stable").tolist():
            length, i = heap[0]
            docs[i].append(d)
            heapq.heapreplace(heap, (length + int(lens[d]), i))
        streams = sorted((np.concatenate([ids[first[d] : first[d + 1]] for d in lane]) for lane in docs if lane), key=len, reverse=True)
        length = np.array([len(x) for x in streams])
        h = np.zeros((self.model.hidden, len(streams)), np.float32)
        at = 0
        while at < length[0]:
            active = int(np.searchsorted(-length, -at, "left"))  # lanes longer than at
            # Windows are longer where few lanes are left, LONGEST times at most.
            steps = int(min(WINDOW * min(LONGEST, max(1, LANES // (4 * active))), length[0] - at))
            laid = np.full((steps, active), END, ids.dtype)
            for i in range(active):
                part = streams[i][at : at + steps]
                laid[: len(part), i] = part
            real = None if length[active - 1] >= at + steps else np.arange(at, at + steps)[:, None] < length[:active]
            h, grads, loss = self.model.window(laid, np.ascontiguousarray(h[:, :active]), real)
            n = laid.size if real is None else int(real.sum())
            self.update(grads)
            self.tokens += n
            self.loss += loss * n
            at += steps

    def update(self, grads: dict) -> None:
        self.t += 1
        rate = np.float32(RATE * np.sqrt(1 - DECAY2**self.t) / (1 - DECAY1**self.t))
        for n, g in grads.items():
            m, v = self.m[n], self.v[n]
            m += (g - m) * np.float32(1 - DECAY1)
            v += (g * g - v) * np.float32(1 - DECAY2)
            self.model.p[n] -= rate * m / (np.sqrt(v) + np.float32(1e-8))


def document_scores(model: Model, ids: np.ndarray, first: np.ndarray, most: int = 1_500_000) -> np.ndarray:
    """Natural log probability of the classes and vocabulary words of whole documents ids[first[i]:first[i + 1]].

    Documents run side by side, longest first, each with its state carried from its first token to
    its last.
    """
    lens = np.diff(first)
    order = np.argsort(-lens, kind="stable")
    out = np.zeros(len(lens))
    inputs, weights = model.recurrence()
    at = 0
    while at < len(order):
        upto = int(np.searchsorted(np.cumsum(lens[order[at:]]), most, "right")) + at
        docs = order[at : max(upto, at + 1)]
        at += len(docs)
        n, begin = lens[docs], first[:-1][docs]
        longest = int(n[0]) if len(n) else 0
        active = np.searchsorted(-n, -np.arange(longest), "left")  # documents longer than t
        total = int(n.sum())
        offset = np.append(0, np.cumsum(active))
        # Token t of all active documents stand together.
        t_of = np.repeat(np.arange(longest), active)
        lane = np.arange(total) - offset[t_of]
        tokens = ids[begin[lane] + t_of]
        states = np.empty((total, model.hidden), np.float32)
        h = model.begin_states(len(docs))
        for t in range(longest):
            a, b = offset[t], offset[t + 1]
            if b - a < h.shape[1]:
                h = np.ascontiguousarray(h[:, : b - a])
            states[a:b] = h[: model.hidden].T
            model.advance(weights, inputs[tokens[a:b]].T, h)
        logp = np.empty(total)
        for a in range(0, total, PART):
            logp[a : a + PART] = model.output(states[a : a + PART], tokens[a : a + PART])[0]
        out[docs] = np.bincount(lane, logp, len(docs))
    return out
