"""A bidirectional gated recurrent unit in numpy: forward pass, backpropagation through time, Adam.

Arrays carry the two directions in front: direction 1 reads time backwards, so its inputs and
outputs are stored in reading order (reverse the time axis to line them up).
"""

from __future__ import annotations

import numpy as np


def glorot(rng: np.random.Generator, *shape: int) -> np.ndarray:
    return (rng.standard_normal(shape) * np.sqrt(2.0 / (shape[-1] + shape[-2]))).astype(np.float32)


def init(rng: np.random.Generator, inputs: int, hidden: int) -> dict[str, np.ndarray]:
    return {"W": glorot(rng, 2, inputs, 3 * hidden), "U": glorot(rng, 2, hidden, 3 * hidden), "b": np.zeros((2, 1, 3 * hidden), np.float32)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def forward(p: dict, x: np.ndarray) -> tuple[np.ndarray, list]:
    """x: (2, T, B, D) -> hidden states (2, T, B, H), and what backward() needs."""
    h3 = p["U"].shape[2]
    hidden = h3 // 3
    _, steps, rows, _ = x.shape
    a = (x.reshape(2, steps * rows, -1) @ p["W"] + p["b"]).reshape(2, steps, rows, h3)
    h = np.zeros((2, rows, hidden), np.float32)
    out, cache = np.empty((2, steps, rows, hidden), np.float32), []
    for t in range(steps):
        u = h @ p["U"]
        gates = sigmoid(a[:, t, :, : 2 * hidden] + u[:, :, : 2 * hidden])
        z, r, un = gates[:, :, :hidden], gates[:, :, hidden:], u[:, :, 2 * hidden :]
        n = np.tanh(a[:, t, :, 2 * hidden :] + r * un)
        cache.append((h, z, r, un, n))
        h = n + z * (h - n)
        out[:, t] = h
    return out, cache


def backward(p: dict, x: np.ndarray, cache: list, grad: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """grad: of the hidden states (2, T, B, H) -> gradients of the parameters, and of x."""
    _, steps, rows, inputs = x.shape
    da = np.empty((2, steps, rows, p["U"].shape[2]), np.float32)
    dU, dh = np.zeros_like(p["U"]), np.zeros_like(grad[:, 0])
    hidden = dh.shape[2]
    back = p["U"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        h, z, r, un, n = cache[t]
        dh = dh + grad[:, t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        du = np.concatenate([dz, dr, dn * r], 2)
        da[:, t, :, : 2 * hidden], da[:, t, :, 2 * hidden :] = du[:, :, : 2 * hidden], dn
        dU += h.transpose(0, 2, 1) @ du
        dh = dh * z + du @ back
    flat = da.reshape(2, steps * rows, -1)
    grads = {"W": x.reshape(2, steps * rows, inputs).transpose(0, 2, 1) @ flat, "U": dU, "b": flat.sum(1, keepdims=True)}
    return grads, (flat @ p["W"].transpose(0, 2, 1)).reshape(x.shape)


class Adam:
    """Adam with gradients clipped by their common norm."""

    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.005, clip: float = 5.0):
        self.params, self.rate, self.clip, self.t = params, rate, clip, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray], rate: float = 1.0) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, self.clip / (norm + 1e-12))
        lr = rate * self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            g = g * np.float32(scale)
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= np.float32(lr) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-8))


def run(projected: np.ndarray, U: np.ndarray, symbols: np.ndarray, each) -> None:
    """Scoring pass of one direction. projected: (V, 3H), inputs of each symbol with bias; symbols: (T, B) in reading order.

    each(t, h) sees the hidden states (B, H) of every step.
    """
    hidden = U.shape[0]
    rows = symbols.shape[1]
    # sigmoid(x) = (tanh(x / 2) + 1) / 2: the halves are folded into the weights.
    half = np.concatenate([np.full(2 * hidden, 0.5), np.ones(hidden)]).astype(np.float32)
    table, weights = projected * half, U * half
    h = np.zeros((rows, hidden), np.float32)
    a, u = np.empty((rows, 3 * hidden), np.float32), np.empty((rows, 3 * hidden), np.float32)
    gates, n = np.empty((rows, 2 * hidden), np.float32), np.empty((rows, hidden), np.float32)
    z, r = gates[:, :hidden], gates[:, hidden:]
    for t in range(symbols.shape[0]):
        np.take(table, symbols[t], axis=0, out=a, mode="clip")
        np.matmul(h, weights, out=u)
        np.add(a[:, : 2 * hidden], u[:, : 2 * hidden], out=gates)
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(r, u[:, 2 * hidden :], out=n)
        n += a[:, 2 * hidden :]
        np.tanh(n, out=n)
        h -= n
        h *= z
        h += n
        each(t, h)
