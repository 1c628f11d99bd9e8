"""A bidirectional GRU with attention pooling, in numpy: forward, gradient, training step."""

from __future__ import annotations

import numpy as np

F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def init(words: int, grams: int, dim: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    """Parameters: word and character tables, input weights of both directions, recurrences, attention, output."""
    draw = np.random.default_rng(seed)

    def normal(*shape, scale):
        return draw.normal(0, scale, shape).astype(F32)

    return {
        "words": normal(words, dim, scale=0.1), "grams": normal(grams, dim, scale=0.1),
        "w": normal(dim, 6 * hidden, scale=dim**-0.5), "bias": np.zeros(6 * hidden, F32),
        "u0": normal(hidden, 3 * hidden, scale=hidden**-0.5), "u1": normal(hidden, 3 * hidden, scale=hidden**-0.5),
        "attend": normal(2 * hidden, scale=0.5), "out": normal(2 * hidden, scale=0.5), "base": np.zeros(1, F32),
    }


def _steps(gates: np.ndarray, mask: np.ndarray, u: np.ndarray, order, keep: bool):
    """States after every step in ``order``; with ``keep`` also what the gradient needs."""
    n, h = gates.shape[0], u.shape[0]
    state = np.zeros((n, h), F32)
    states = np.empty((n, gates.shape[1], h), F32)
    kept = []
    for t in order:
        back = state @ u
        zr = sigmoid(gates[:, t, : 2 * h] + back[:, : 2 * h])
        z, r = zr[:, :h], zr[:, h:]
        new = np.tanh(gates[:, t, 2 * h :] + r * back[:, 2 * h :])
        m = mask[:, t, None]
        nxt = state + m * (1 - z) * (new - state)
        if keep:
            kept.append((t, state, z, r, new, back[:, 2 * h :], m))
        state = nxt
        states[:, t] = state
    return states, kept


def forward(p: dict, x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows of inputs ``x`` (n x steps x dim); masked steps hold no word."""
    h = p["u0"].shape[0]
    gates = x @ p["w"] + p["bias"]
    return _pooled(p, gates[..., : 3 * h], gates[..., 3 * h :], mask, keep)


def _pooled(p: dict, ahead: np.ndarray, behind: np.ndarray, mask: np.ndarray, keep: bool):
    steps = ahead.shape[1]
    s0, k0 = _steps(ahead, mask, p["u0"], range(steps), keep)
    s1, k1 = _steps(behind, mask, p["u1"], range(steps - 1, -1, -1), keep)
    states = np.concatenate([s0, s1], 2)
    e = states @ p["attend"] + np.where(mask > 0, 0, -30).astype(F32)
    e = np.exp(e - e.max(1, keepdims=True)) * mask
    alpha = e / np.maximum(e.sum(1, keepdims=True), 1e-20)
    pooled = np.einsum("nt,nth->nh", alpha, states)
    logit = pooled @ p["out"] + p["base"][0]
    return (logit, (k0, k1, states, alpha, pooled)) if keep else logit


def logits(p: dict, table: np.ndarray, places: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows whose steps name rows of a table of gate inputs."""
    h = p["u0"].shape[0]
    gates = table[places]
    return _pooled(p, gates[..., : 3 * h], gates[..., 3 * h :], mask, False)


def gradient(p: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
    """Mean log loss, its gradient by parameter, and by input."""
    n, h = len(x), p["u0"].shape[0]
    logit, (k0, k1, states, alpha, pooled) = forward(p, x, mask, True)
    prob = sigmoid(logit)
    loss = float(-np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7)))
    d = ((prob - y) / n).astype(F32)
    g = {"out": pooled.T @ d, "base": d.sum(keepdims=True)}
    d_pooled = d[:, None] * p["out"]
    d_alpha = np.einsum("nh,nth->nt", d_pooled, states)
    d_e = alpha * (d_alpha - (alpha * d_alpha).sum(1, keepdims=True))
    g["attend"] = np.einsum("nt,nth->h", d_e, states)
    d_states = alpha[..., None] * d_pooled[:, None] + d_e[..., None] * p["attend"]
    d_gates = np.zeros((n, x.shape[1], 6 * h), F32)
    for name, kept, at in (("u0", k0, 0), ("u1", k1, 1)):
        u, gu, after = p[name], np.zeros_like(p[name]), np.zeros((n, h), F32)
        for t, state, z, r, new, back, m in reversed(kept):
            after = after + d_states[:, t, at * h : (at + 1) * h]
            d_new = after * m * (1 - z) * (1 - new * new)
            d_z = after * m * (state - new) * z * (1 - z)
            d_r = d_new * back * r * (1 - r)
            d_back = np.concatenate([d_z, d_r, d_new * r], 1)
            d_gates[:, t, 3 * h * at : 3 * h * (at + 1)] = np.concatenate([d_z, d_r, d_new], 1)
            gu += state.T @ d_back
            after = after * (1 - m * (1 - z)) + d_back @ u.T
        g[name] = gu
    flat = d_gates.reshape(-1, 6 * h)
    g["w"], g["bias"] = x.reshape(-1, x.shape[2]).T @ flat, flat.sum(0)
    return loss, g, d_gates @ p["w"].T


class Adam:
    def __init__(self, p: dict, rate: float, slower: dict[str, float] | None = None) -> None:
        """``slower`` gives factors of the rate by parameter."""
        self.p, self.rate, self.slower, self.t = p, rate, slower or {}, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, x in g.items():
            self.m[k] += 0.1 * (x - self.m[k])
            self.v[k] += 0.001 * (x * x - self.v[k])
            self.p[k] -= (self.rate * self.slower.get(k, 1.0) * fix * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(F32)
