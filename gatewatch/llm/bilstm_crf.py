"""A character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def new_params(vocab: int, tags: int, embed: int = 12, hidden: int = 16, seed: int = 7, dtype=np.float32) -> Params:
    rng = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(dtype)

    p = {"E": (0.5 * rng.standard_normal((vocab, embed))).astype(dtype), "O": normal(2 * hidden, tags), "o": np.zeros(tags, dtype),
         "T": np.zeros((tags, tags), dtype), "S": np.zeros(tags, dtype), "F": np.zeros(tags, dtype)}
    for d in "fb":
        p["X" + d], p["H" + d] = normal(embed, 4 * hidden), normal(hidden, 4 * hidden)
        bias = np.zeros(4 * hidden, dtype)
        bias[hidden : 2 * hidden] = 1  # remember at first
        p["B" + d] = bias
    return p


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


def lstm(x: np.ndarray, mask: np.ndarray, p: Params, d: str, keep: bool = False):
    """Hidden states (L, B, H); ``x`` is (L, B, embed), ``mask`` (L, B, 1). The
    state is zero outside a sequence, so the backward pass starts at its end."""
    length, batch, _ = x.shape
    hidden = p["H" + d].shape[0]
    h = c = np.zeros((batch, hidden), x.dtype)
    out = np.zeros((length, batch, hidden), x.dtype)
    past: list = [None] * length
    gates_x = x @ p["X" + d] + p["B" + d]
    steps = range(length) if d == "f" else range(length - 1, -1, -1)
    for t in steps:
        z = gates_x[t] + h @ p["H" + d]
        s = sigmoid(z[:, : 3 * hidden])
        i, f, o, g = s[:, :hidden], s[:, hidden : 2 * hidden], s[:, 2 * hidden :], np.tanh(z[:, 3 * hidden :])
        new_c = (f * c + i * g) * mask[t]
        tc = np.tanh(new_c)
        new_h = o * tc * mask[t]
        if keep:
            past[t] = (h, c, i, f, o, g, tc)
        h, c = new_h, new_c
        out[t] = h
    return out, past


def lstm_back(x: np.ndarray, mask: np.ndarray, p: Params, d: str, past: list, grad: np.ndarray, g_p: Params) -> np.ndarray:
    """Adds the gradients of the direction's parameters; returns that of ``x``."""
    length, batch, _ = x.shape
    hidden = p["H" + d].shape[0]
    dh = dc = np.zeros((batch, hidden), x.dtype)
    dz_all = np.zeros((length, batch, 4 * hidden), x.dtype)
    steps = range(length - 1, -1, -1) if d == "f" else range(length)
    for t in steps:
        h, c, i, f, o, g, tc = past[t]
        dh = (dh + grad[t]) * mask[t]
        dc = (dc + dh * o * (1 - tc * tc)) * mask[t]
        dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
        dz_all[t] = dz
        g_p["H" + d] += h.T @ dz
        dh, dc = dz @ p["H" + d].T, dc * f
    g_p["X" + d] += np.einsum("lbe,lbz->ez", x, dz_all)
    g_p["B" + d] += dz_all.sum((0, 1))
    return dz_all @ p["X" + d].T


def emissions(p: Params, chars: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Tag scores (L, B, tags) of char codes (L, B)."""
    x = p["E"][chars]
    m = mask[:, :, None].astype(x.dtype)
    f, past_f = lstm(x, m, p, "f", keep)
    b, past_b = lstm(x, m, p, "b", keep)
    both = np.concatenate([f, b], 2)
    return both @ p["O"] + p["o"], (x, m, both, past_f, past_b)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def loss_and_gradients(p: Params, chars: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, Params]:
    """Mean negative log-likelihood of the tag paths and its gradients.
    ``chars``, ``mask`` and ``tags`` are (L, B); sequences start at 0."""
    e, (x, m, both, past_f, past_b) = emissions(p, chars, mask, keep=True)
    length, batch, n = e.shape
    last = mask.sum(0) - 1
    row = np.arange(batch)
    alpha = np.zeros_like(e)
    alpha[0] = p["S"] + e[0]
    for t in range(1, length):
        alpha[t] = np.where(m[t] > 0, log_sum(alpha[t - 1][:, :, None] + p["T"], 1) + e[t], alpha[t - 1])
    total = log_sum(alpha[-1] + p["F"], 1)
    beta = np.zeros_like(e)
    beta[-1] = p["F"]
    for t in range(length - 2, -1, -1):
        beta[t] = np.where(m[t + 1] > 0, log_sum(p["T"] + (e[t + 1] + beta[t + 1])[:, None, :], 2), beta[t + 1])
    hot = np.eye(n, dtype=e.dtype)[tags] * m
    score = (hot * e).sum((0, 2)) + p["S"][tags[0]] + p["F"][tags[last, row]]
    score = score + (p["T"][tags[:-1], tags[1:]] * m[1:, :, 0]).sum(0)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    unary = np.exp(alpha + beta - total[None, :, None]) * m
    de = (unary - hot) / batch
    pair = np.exp(alpha[:-1, :, :, None] + p["T"] + (e[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None]) * m[1:, :, :, None]
    g["T"] += pair.sum((0, 1)) / batch
    np.add.at(g["T"], (tags[:-1], tags[1:]), -m[1:, :, 0] / batch)
    g["S"] += de[0].sum(0)
    end = np.exp(alpha[-1] + p["F"] - total[:, None])
    g["F"] += (end.sum(0) - np.bincount(tags[last, row], minlength=n)) / batch
    g["O"] += np.einsum("lbh,lbt->ht", both, de)
    g["o"] += de.sum((0, 1))
    d_both = de @ p["O"].T
    hidden = p["Hf"].shape[0]
    dx = lstm_back(x, m, p, "f", past_f, d_both[:, :, :hidden], g) + lstm_back(x, m, p, "b", past_b, d_both[:, :, hidden:], g)
    np.add.at(g["E"], chars, dx)
    return float((total - score).mean()), g


def train(p: Params, chars: list[np.ndarray], tags: list[np.ndarray], epochs: int = 8, batch: int = 32, rate: float = 0.02,
          seed: int = 3) -> Params:
    """Adam over batches of sequences of similar length, in a fixed order."""
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    order = np.argsort([len(c) for c in chars], kind="stable")
    groups = [order[i : i + batch] for i in range(0, len(order), batch)]
    step, steps = 0, epochs * len(groups)
    for _ in range(epochs):
        for k in rng.permutation(len(groups)):
            c, m = padded([chars[i] for i in groups[k]])
            t, _ = padded([tags[i] for i in groups[k]])
            _, g = loss_and_gradients(p, c, m, t)
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for n, v in g.items():
                v = v * min(1.0, 5.0 / (size + 1e-9))
                first[n] += 0.1 * (v - first[n])
                second[n] += 0.001 * (v * v - second[n])
                fix = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                p[n] = (p[n] - now * fix * first[n] / (np.sqrt(second[n]) + 1e-8)).astype(p[n].dtype)
    return p


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(L, B) codes, zero beyond each row's end, and the mask."""
    size = np.array([len(r) for r in rows])
    out = np.zeros((size.max(), len(rows)), np.int64)
    for i, r in enumerate(rows):
        out[: len(r), i] = r
    return out, np.arange(size.max())[:, None] < size[None, :]


def decode(p: Params, rows: list[np.ndarray], batch: int = 256, cells: int = 32_768) -> list[tuple[np.ndarray, np.ndarray]]:
    """The best tag path of each row (Viterbi), and the emission lead of its
    tags over tag 0. A batch has at most ``batch`` rows and, over one row, at
    most about ``cells`` characters."""
    out: list = [None] * len(rows)
    order = np.argsort([len(r) for r in rows], kind="stable")
    hi = len(order)
    while hi > 0:
        lo = max(0, hi - max(1, min(batch, cells // max(1, len(rows[order[hi - 1]])))))
        own, hi = order[lo:hi], lo
        chars, mask = padded([rows[i] for i in own])
        e, _ = emissions(p, chars, mask)
        length, n_rows, n = e.shape
        best = p["S"] + e[0]
        back = np.zeros((length, n_rows, n), np.int8)
        same = np.arange(n, dtype=np.int8)
        for t in range(1, length):
            step = best[:, :, None] + p["T"]
            live = mask[t][:, None]
            back[t] = np.where(live, step.argmax(1), same)
            best = np.where(live, step.max(1) + e[t], best)
        tag = (best + p["F"]).argmax(1)
        path = np.zeros((length, n_rows), np.int64)
        for t in range(length - 1, -1, -1):
            path[t] = tag
            tag = back[t, np.arange(n_rows), tag]
        lead = np.take_along_axis(e, path[:, :, None], 2)[:, :, 0] - e[:, :, 0]
        for j, i in enumerate(own):
            out[i] = (path[: len(rows[i]), j], lead[: len(rows[i]), j])
    return out
