"""A small bidirectional LSTM in numpy with its gradients, for training on the driver and use in tasks."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class BiLSTM:
    """Maps symbols (T, B) of a vocabulary, or vectors (T, B, D), to emissions (T, B, K)."""

    def __init__(self, inputs: int, hidden: int, outputs: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.normal(0, 1, s) / np.sqrt(s[0])).astype(np.float32)
        self.hidden = hidden
        self.p: dict[str, np.ndarray] = {"out": draw(2 * hidden, outputs), "bias": np.zeros(outputs, np.float32)}
        for way in "fb":
            self.p[f"x{way}"], self.p[f"h{way}"] = draw(inputs, 4 * hidden), draw(hidden, 4 * hidden)
            self.p[f"c{way}"] = np.concatenate((np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden))).astype(np.float32)

    def _project(self, way: str, x: np.ndarray) -> np.ndarray:
        w = self.p[f"x{way}"]
        return (w[x] if x.ndim == 2 else x @ w) + self.p[f"c{way}"]

    def _run(self, way: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        n, w = self.hidden, self.p[f"h{way}"]
        z = self._project(way, x)
        steps, b = z.shape[:2]
        h, c = np.zeros((b, n), np.float32), np.zeros((b, n), np.float32)
        out = np.zeros((steps, b, n), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            a = z[t] + h @ w
            gate = _sigmoid(a[:, : 3 * n])
            i, f, o, g = gate[:, :n], gate[:, n : 2 * n], gate[:, 2 * n :], np.tanh(a[:, 3 * n :])
            m = mask[t][:, None]
            c2 = m * (f * c + i * g)
            tc = np.tanh(c2)
            h2 = m * (o * tc)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, m))
            h, c = h2, c2
            out[t] = h
        return out

    def emissions(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        h = np.concatenate((self._run("f", x, mask), self._run("b", x, mask)), axis=2)
        return h @ self.p["out"] + self.p["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, loss) -> tuple[float, dict[str, np.ndarray]]:
        """``loss`` takes emissions and gives (value, their gradient)."""
        kept: dict[str, list] = {"f": [], "b": []}
        h = np.concatenate([self._run(way, x, mask, kept[way]) for way in "fb"], axis=2)
        value, d = loss(h @ self.p["out"] + self.p["bias"])
        k = d.shape[2]
        grads = {"out": h.reshape(-1, h.shape[2]).T @ d.reshape(-1, k), "bias": d.sum(axis=(0, 1))}
        dh = d @ self.p["out"].T
        n = self.hidden
        for way, part in (("f", dh[:, :, :n]), ("b", dh[:, :, n:])):
            w = self.p[f"h{way}"]
            dz = np.zeros((*part.shape[:2], 4 * n), np.float32)
            gw = np.zeros_like(w)
            h_next, c_next = np.zeros_like(part[0]), np.zeros_like(part[0])
            for t, h0, c0, i, f, o, g, tc, m in reversed(kept[way]):
                dy = (part[t] + h_next) * m
                dc = (dy * o * (1 - tc * tc) + c_next * m)
                da = np.concatenate((dc * g * i * (1 - i), dc * c0 * f * (1 - f), dy * tc * o * (1 - o), dc * i * (1 - g * g)), axis=1)
                dz[t] = da
                gw += h0.T @ da
                h_next, c_next = da @ w.T, dc * f
            grads[f"h{way}"], grads[f"c{way}"] = gw, dz.sum(axis=(0, 1))
            if x.ndim == 2:
                gx = np.zeros_like(self.p[f"x{way}"])
                np.add.at(gx, x.ravel(), dz.reshape(-1, 4 * n))
            else:
                gx = x.reshape(-1, x.shape[2]).T @ dz.reshape(-1, 4 * n)
            grads[f"x{way}"] = gx
        return value, grads


class Adam:
    def __init__(self, rate: float = 0.01):
        self.rate, self.n, self.m, self.v = rate, 0, {}, {}

    def step(self, p: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.n += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, 5.0 / max(size, 1e-9))
        for k, g in grads.items():
            g = g * scale
            self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g
            self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * g * g
            p[k] -= (self.rate * (self.m[k] / (1 - 0.9**self.n)) / (np.sqrt(self.v[k] / (1 - 0.999**self.n)) + 1e-8)).astype(np.float32)
