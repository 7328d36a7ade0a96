"""A character-level bidirectional LSTM with CRF transitions, trained and run in numpy."""

from __future__ import annotations

import numpy as np

#: Characters with a class of their own; then digits, other ASCII, other letters, everything else. 0 fills up windows.
_OWN = "abcdefghijklmnopqrstuvwxyz .,:;@+-_()[]/=\"'%\n"
DIGIT, ASCII, LETTER, OTHER = (len(_OWN) + i for i in (1, 2, 3, 4))
CLASSES = len(_OWN) + 5
_TABLE = np.full(128, ASCII, np.int8)
for _i, _c in enumerate(_OWN):
    _TABLE[ord(_c)] = _i + 1
    _TABLE[ord(_c.upper())] = _i + 1
_TABLE[ord("0") : ord("9") + 1] = DIGIT


def classes(text: str) -> np.ndarray:
    """The class of each character."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    out = np.where(code < 128, _TABLE[np.minimum(code, 127)], OTHER).astype(np.int8)
    far = np.flatnonzero(code >= 128)
    out[far] = [LETTER if text[i].isalpha() else OTHER for i in far.tolist()]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class BiLstmCrf:
    """Tags: 0 outside, then a begin and an inside tag for each kind."""

    def __init__(self, kinds: int, hidden: int = 16, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.kinds, self.hidden, self.tags = kinds, hidden, 1 + 2 * kinds
        h, k = hidden, self.tags
        self.p = {
            "in_f": rng.normal(0, 0.2, (CLASSES, 4 * h)), "in_b": rng.normal(0, 0.2, (CLASSES, 4 * h)),
            "rec_f": rng.normal(0, h**-0.5, (h, 4 * h)), "rec_b": rng.normal(0, h**-0.5, (h, 4 * h)),
            "out": rng.normal(0, h**-0.5, (2 * h, k)), "bias": np.zeros(k), "trans": np.zeros((k, k)), "start": np.zeros(k),
        }
        for n in ("in_f", "in_b"):
            self.p[n][:, h : 2 * h] += 1.0  # forget gates start open
        inside = np.arange(2, k, 2)
        self.banned = np.zeros((k, k), bool)  # an inside tag follows its own begin or inside tag only
        self.banned[:, inside] = True
        self.banned[inside, inside] = self.banned[inside - 1, inside] = False
        self.banned_start = np.zeros(k, bool)
        self.banned_start[inside] = True

    def as_float32(self) -> BiLstmCrf:
        self.p = {n: v.astype(np.float32) for n, v in self.p.items()}
        return self

    def _lstm(self, x: np.ndarray, side: str, keep: bool):
        h_size, (n, steps) = self.hidden, x.shape
        table, rec = self.p["in_" + side], self.p["rec_" + side]
        h = np.zeros((n, h_size), table.dtype)
        c = np.zeros_like(h)
        out, kept = np.empty((steps, n, h_size), table.dtype), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = table[x[:, t]] + h @ rec
            gates, g = _sigmoid(z[:, : 3 * h_size]), np.tanh(z[:, 3 * h_size :])
            i, f, o = gates[:, :h_size], gates[:, h_size : 2 * h_size], gates[:, 2 * h_size :]
            before, h_before = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                kept.append((t, i, f, o, g, before, h_before, tc))
        return out, kept

    def _lstm_back(self, x: np.ndarray, side: str, kept, d_out: np.ndarray, grads: dict) -> None:
        rec = self.p["rec_" + side]
        d_table, d_rec = np.zeros_like(self.p["in_" + side]), np.zeros_like(rec)
        dh, dc = np.zeros_like(d_out[0]), np.zeros_like(d_out[0])
        each = np.eye(CLASSES)[x]  # (windows, steps, classes)
        for t, i, f, o, g, before, h_before, tc in reversed(kept):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            d_table += each[:, t].T @ dz
            d_rec += h_before.T @ dz
            dh, dc = dz @ rec.T, dc * f
        grads["in_" + side], grads["rec_" + side] = d_table, d_rec

    def _transitions(self) -> tuple[np.ndarray, np.ndarray]:
        return np.where(self.banned, -1e4, self.p["trans"]), np.where(self.banned_start, -1e4, self.p["start"])

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(steps, windows, tags)"""
        both = np.concatenate([self._lstm(x, "f", False)[0], self._lstm(x, "b", False)[0]], 2)
        return both @ self.p["out"] + self.p["bias"]

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        """Mean negative log-likelihood of the tags ``y`` of windows ``x``, and its gradient."""
        (hf, kf), (hb, kb) = self._lstm(x, "f", True), self._lstm(x, "b", True)
        both = np.concatenate([hf, hb], 2)
        e = both @ self.p["out"] + self.p["bias"]
        trans, start = self._transitions()
        steps, n, k = e.shape
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = start + e[0]
        for t in range(1, steps):
            s = alpha[t - 1][:, :, None] + trans
            m = s.max(1)
            alpha[t] = m + np.log(np.exp(s - m[:, None]).sum(1)) + e[t]
        top = alpha[-1].max(1)
        z = top + np.log(np.exp(alpha[-1] - top[:, None]).sum(1))
        for t in range(steps - 2, -1, -1):
            s = trans + (e[t + 1] + beta[t + 1])[:, None, :]
            m = s.max(2)
            beta[t] = m + np.log(np.exp(s - m[:, :, None]).sum(2))
        rows = np.arange(n)
        gold = start[y[:, 0]] + e[0, rows, y[:, 0]]
        de = np.exp(alpha + beta - z[:, None])
        d_trans = np.zeros_like(trans)
        for t in range(1, steps):
            gold = gold + trans[y[:, t - 1], y[:, t]] + e[t, rows, y[:, t]]
            d_trans += np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t] - z[:, None])[:, None, :]).sum(0)
            np.add.at(d_trans, (y[:, t - 1], y[:, t]), -1)
        for t in range(steps):
            de[t, rows, y[:, t]] -= 1
        d_start = de[0].sum(0)
        de /= n
        grads = {"trans": d_trans / n, "start": d_start / n, "bias": de.sum((0, 1)), "out": np.einsum("tnh,tnk->hk", both, de)}
        d_both = de @ self.p["out"].T
        self._lstm_back(x, "f", kf, d_both[:, :, : self.hidden], grads)
        self._lstm_back(x, "b", kb, d_both[:, :, self.hidden :], grads)
        return float((z - gold).mean()), grads

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, rate: float = 0.01, batch: int = 64, seed: int = 0) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        v = {n: np.zeros_like(w) for n, w in self.p.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            order, total = rng.permutation(len(x)), 0.0
            now = rate * (1 - epoch / epochs)
            for at in range(0, len(x), batch):
                part = order[at : at + batch]
                loss, grads = self.loss(x[part], y[part])
                total += loss * len(part)
                norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
                step += 1
                for n, g in grads.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m[n] = 0.9 * m[n] + 0.1 * g
                    v[n] = 0.999 * v[n] + 0.001 * g * g
                    self.p[n] -= now * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.999**step)) + 1e-8)
            losses.append(total / len(x))
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi tags of windows, and what each place adds to the lead of its path over one that is outside all along."""
        return self.best_path(self.emissions(x))

    def best_path(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``decode`` of emissions (steps, windows, tags)."""
        trans, start = self._transitions()
        steps, n, k = e.shape
        trans = trans.astype(e.dtype)
        best, back = start.astype(e.dtype) + e[0], np.empty((steps, n, k), np.int8)
        for t in range(1, steps):
            s = best[:, :, None] + trans
            back[t] = s.argmax(1)
            best = s.max(1) + e[t]
        tags = np.empty((n, steps), np.int8)
        tags[:, -1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t, rows, tags[:, t]]
        margin = np.take_along_axis(e, tags.T[:, :, None].astype(np.int64), 2)[:, :, 0].T - e[:, :, 0].T
        margin[:, 1:] += trans[tags[:, :-1], tags[:, 1:]] - trans[0, 0]
        margin[:, 0] += start[tags[:, 0]] - start[0]
        return tags, margin
