"""A bidirectional LSTM with one output per step, in numpy."""

from __future__ import annotations

import io

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Reads sequences both ways; the logit of a step is linear in both hidden states and its own input."""

    def __init__(self, inputs: int, hidden: int, seed: int = 11):
        random = np.random.default_rng(seed)

        def weights(*shape: int) -> np.ndarray:
            return random.normal(0, shape[0] ** -0.5, shape).astype(np.float32)

        self.hidden = hidden
        self.p = {"out": np.zeros(2 * hidden + inputs, np.float32), "bias": np.zeros(1, np.float32)}
        for way in ("f", "b"):
            self.p |= {f"x{way}": weights(inputs, 4 * hidden), f"h{way}": weights(hidden, 4 * hidden), f"c{way}": np.zeros(4 * hidden, np.float32)}
            self.p[f"c{way}"][:hidden] = 1  # forget gates start open

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> BiLstm:
        stored = np.load(io.BytesIO(data))
        net = BiLstm(stored["xf"].shape[0], stored["hf"].shape[0])
        net.p = {k: stored[k] for k in stored.files}
        return net

    def _steps(self, way: str, n: int) -> range:
        return range(n) if way == "f" else range(n - 1, -1, -1)

    def _read(self, x: np.ndarray, mask: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        size, n, _ = x.shape
        k = self.hidden
        z = x @ self.p[f"x{way}"] + self.p[f"c{way}"]
        h, c = np.zeros((size, k), np.float32), np.zeros((size, k), np.float32)
        states, kept = np.zeros((size, n, k), np.float32), []
        for t in self._steps(way, n):
            m = mask[:, t, None]
            gates = z[:, t] + h @ self.p[f"h{way}"]
            f, i, o = (_sigmoid(gates[:, j * k : (j + 1) * k]) for j in range(3))
            g = np.tanh(gates[:, 3 * k :])
            new = f * c + i * g
            tanh = np.tanh(new)
            kept.append((t, m, f, i, o, g, c, tanh, h))
            c = m * new + (1 - m) * c
            h = m * (o * tanh) + (1 - m) * h
            states[:, t] = h
        return states, kept

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """``x``: sequences, steps, inputs; ``mask``: 1 on the steps of a sequence, then 0."""
        forward, backward = self._read(x, mask, "f")[0], self._read(x, mask, "b")[0]
        k = self.hidden
        return forward @ self.p["out"][:k] + backward @ self.p["out"][k : 2 * k] + x @ self.p["out"][2 * k :] + self.p["bias"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over the steps."""
        k = self.hidden
        read = {way: self._read(x, mask, way) for way in ("f", "b")}
        parts = {"f": self.p["out"][:k], "b": self.p["out"][k : 2 * k]}
        logits = sum(read[w][0] @ parts[w] for w in "fb") + x @ self.p["out"][2 * k :] + self.p["bias"]
        error = ((_sigmoid(logits) - labels) * mask / max(1.0, float(mask.sum()))).astype(np.float32)
        out = [np.einsum("bt,btk->k", error, read[w][0]) for w in "fb"]
        grads = {"out": np.concatenate([*out, np.einsum("bt,btk->k", error, x)]), "bias": error.sum(keepdims=True).reshape(1)}
        for way in ("f", "b"):
            wh = self.p[f"h{way}"]
            dz = np.zeros((*mask.shape, 4 * k), np.float32)
            dwh = np.zeros_like(wh)
            dh = dc = np.zeros((len(x), k), np.float32)
            for t, m, f, i, o, g, c, tanh, h in reversed(read[way][1]):
                dh = dh + error[:, t, None] * parts[way]
                inner = m * dh
                dnew = m * dc + inner * o * (1 - tanh**2)
                dgates = np.concatenate(
                    (dnew * c * f * (1 - f), dnew * g * i * (1 - i), inner * tanh * o * (1 - o), dnew * i * (1 - g**2)), 1
                )
                dz[:, t] = dgates
                dwh += h.T @ dgates
                dh = (1 - m) * dh + dgates @ wh.T
                dc = (1 - m) * dc + dnew * f
            flat = dz.reshape(-1, 4 * k)
            grads |= {f"x{way}": x.reshape(-1, x.shape[2]).T @ flat, f"h{way}": dwh, f"c{way}": flat.sum(0)}
        return grads


class Adam:
    def __init__(self, net: BiLstm, rate: float = 0.01):
        self._net, self._rate, self._n = net, rate, 0
        self._state = {k: (np.zeros_like(p), np.zeros_like(p)) for k, p in net.p.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self._n += 1
        norm = float(np.sqrt(sum((g**2).sum() for g in grads.values())))
        for k, p in self._net.p.items():
            grad = grads[k] * min(1.0, 1.0 / max(norm, 1e-9))
            m, v = self._state[k]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad**2 - v)
            p -= (self._rate * (m / (1 - 0.9**self._n)) / (np.sqrt(v / (1 - 0.99**self._n)) + 1e-7)).astype(np.float32)
