"""A bidirectional gated recurrent network with attention pooling, trained in NumPy.

The same layer is used twice: over the bytes of a word, and over the words of a window, whose inputs are a word's own
vector and what the first layer makes of its bytes. Arrays are (time, rows, features); a mask tells which steps exist.
"""

from __future__ import annotations

import numpy as np

#: Features: of a byte, of a word's own vector, hidden per direction (bytes, words), attention.
BYTE, OWN, HIDDEN_BYTES, HIDDEN_WORDS, ATTENTION = 4, 4, 4, 6, 4
#: Word vectors are shared by hash.
ROWS = 1 << 16


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def new_layer(rng, inputs: int, hidden: int) -> dict[str, np.ndarray]:
    small = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
    out = {}
    for d in ("f", "b"):
        out |= {f"W{d}": small(inputs, 3 * hidden), f"U{d}": small(hidden, 3 * hidden), f"c{d}": np.zeros(3 * hidden, np.float32)}
    return out | {"A": small(2 * hidden, ATTENTION), "v": small(ATTENTION)}


def new_model(seed: int, own: np.ndarray) -> dict[str, dict[str, np.ndarray]]:
    """own: the first word vectors."""
    rng = np.random.default_rng(seed)
    out = {"w": (rng.normal(size=2 * HIDDEN_WORDS) / 3).astype(np.float32), "b": np.full(1, -1, np.float32)}
    return {"bytes": new_layer(rng, BYTE, HIDDEN_BYTES), "words": new_layer(rng, OWN + 2 * HIDDEN_BYTES, HIDDEN_WORDS), "out": out,
            "in": {"byte": (rng.normal(size=(256, BYTE)) / 2).astype(np.float32), "own": own.astype(np.float32)}}


def gru(project: np.ndarray, mask: np.ndarray, U: np.ndarray, keep: bool = False):
    """Hidden states for inputs that are projected already. Steps without input repeat the state before."""
    T, N, H3 = project.shape
    H = H3 // 3
    h = np.zeros((N, H), np.float32)
    out, cache = np.empty((T, N, H), np.float32), []
    for t in range(T):
        x, u = project[t], h @ U
        zr = _sigmoid(x[:, : 2 * H] + u[:, : 2 * H])
        z, r = zr[:, :H], zr[:, H:]
        n = np.tanh(x[:, 2 * H :] + r * u[:, 2 * H :])
        m = mask[t][:, None]
        new = h + m * (1 - z) * (n - h)
        if keep:
            cache.append((h, z, r, n, u[:, 2 * H :], m))
        h = out[t] = new
    return (out, cache) if keep else out


def gru_back(dout: np.ndarray, cache: list, U: np.ndarray):
    """Gradients of the projected inputs and of U."""
    T, N, H = dout.shape
    dproject, dU, dh = np.empty((T, N, 3 * H), np.float32), np.zeros_like(U), np.zeros((N, H), np.float32)
    for t in range(T - 1, -1, -1):
        h, z, r, n, un, m = cache[t]
        dh = dh + dout[t]
        dn = dh * m * (1 - z) * (1 - n * n)
        dz = dh * m * (h - n) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        du = np.concatenate((dz, dr, dn * r), axis=1)
        dproject[t] = np.concatenate((dz, dr, dn), axis=1)
        dU += h.T @ du
        dh = dh * (1 - m * (1 - z)) + du @ U.T
    return dproject, dU


def pool(projects, mask: np.ndarray, p: dict[str, np.ndarray], keep: bool = False):
    """One vector per row: the states of both directions, weighted by attention. A row without steps gives zeros."""
    back = mask[::-1]
    f, cf = gru(projects[0], mask, p["Uf"], True) if keep else (gru(projects[0], mask, p["Uf"]), None)
    b, cb = gru(projects[1][::-1], back, p["Ub"], True) if keep else (gru(projects[1][::-1], back, p["Ub"]), None)
    states = np.concatenate((f, b[::-1]), axis=2)
    a = np.tanh(states @ p["A"])
    s = np.where(mask > 0, a @ p["v"], -1e9)
    e = np.exp(s - s.max(axis=0)) * mask
    weight = e / np.maximum(e.sum(axis=0), 1e-9)
    out = np.einsum("tn,tnh->nh", weight, states)
    return (out, (cf, cb, states, a, weight, out)) if keep else out


def pool_back(dout: np.ndarray, cache, mask: np.ndarray, p: dict[str, np.ndarray]):
    cf, cb, states, a, weight, out = cache
    H = states.shape[2] // 2
    dweight = np.einsum("nh,tnh->tn", dout, states) - (dout * out).sum(axis=1)
    ds = weight * dweight
    da = ds[:, :, None] * p["v"] * (1 - a * a)
    dstates = weight[:, :, None] * dout + da @ p["A"].T
    g = {"v": np.einsum("tn,tna->a", ds, a), "A": np.einsum("tnh,tna->ha", states, da)}
    df, g["Uf"] = gru_back(dstates[:, :, :H], cf, p["Uf"])
    db, g["Ub"] = gru_back(dstates[::-1, :, H:], cb, p["Ub"])
    return df, db[::-1], g


def _apply(x: np.ndarray, p: dict[str, np.ndarray]) -> list[np.ndarray]:
    return [x @ p[f"W{d}"] + p[f"c{d}"] for d in "fb"]


def _apply_back(x: np.ndarray, df: np.ndarray, db: np.ndarray, p: dict, g: dict) -> np.ndarray:
    flat = x.reshape(-1, x.shape[-1])
    dx = 0
    for d, dp in (("f", df), ("b", db)):
        dp = dp.reshape(-1, dp.shape[-1])
        g[f"W{d}"], g[f"c{d}"] = flat.T @ dp, dp.sum(axis=0)
        dx = dx + dp @ p[f"W{d}"].T
    return dx.reshape(x.shape)


def bytes_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(time, rows) bytes with A-Z in lower case, and the mask."""
    T = int(sizes.max()) if len(sizes) else 0
    at = np.arange(T)[:, None]
    mask = (at < sizes).astype(np.float32)
    out = data[np.minimum(starts + at, len(data) - 1)] if T else np.zeros((0, len(sizes)), np.uint8)
    return np.where((out >= 65) & (out <= 90), out + 32, out).astype(np.uint8), mask


def word_inputs(model: dict, chars: np.ndarray, mask: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The window layer's inputs of some words: their own vectors (rows ``own``) and their bytes' pooled states."""
    table = [model["in"]["byte"] @ model["bytes"][f"W{d}"] + model["bytes"][f"c{d}"] for d in "fb"]
    return np.concatenate((model["in"]["own"][own], pool([t[chars] for t in table], mask, model["bytes"])), axis=1)


def project(model: dict, inputs: np.ndarray) -> list[np.ndarray]:
    """Word inputs as the window layer's two directions take them."""
    return _apply(inputs, model["words"])


def window_logits(model: dict, projects: list[np.ndarray], words: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """words: (time, windows), rows of ``projects``."""
    return pool([x[words] for x in projects], mask, model["words"]) @ model["out"]["w"] + model["out"]["b"]


def gradients(model: dict, chars, cmask, own, words, wmask, labels, weights) -> tuple[float, dict]:
    """Loss and gradients of a batch of windows."""
    layer_b, layer_w = model["bytes"], model["words"]
    x_b = model["in"]["byte"][chars]
    pooled, cache_b = pool(_apply(x_b, layer_b), cmask, layer_b, True)
    inputs = np.concatenate((model["in"]["own"][own], pooled), axis=1)
    x_w = inputs[words]
    out, cache_w = pool(_apply(x_w, layer_w), wmask, layer_w, True)
    p = _sigmoid(out @ model["out"]["w"] + model["out"]["b"])
    loss = -np.mean(weights * np.log(np.where(labels > 0, p, 1 - p) + 1e-7))
    dlogit = weights * (p - labels) / len(labels)
    g = {"out": {"w": out.T @ dlogit, "b": dlogit.sum(keepdims=True)}, "in": {}}
    df, db, g["words"] = pool_back(np.outer(dlogit, model["out"]["w"]).astype(np.float32), cache_w, wmask, layer_w)
    dx_w = _apply_back(x_w, df, db, layer_w, g["words"])
    dinputs = np.zeros_like(inputs)
    np.add.at(dinputs, words.ravel(), (dx_w * wmask[:, :, None]).reshape(-1, inputs.shape[1]))
    g["in"]["own"] = (own, dinputs[:, :OWN])
    df, db, g["bytes"] = pool_back(dinputs[:, OWN:], cache_b, cmask, layer_b)
    dx_b = _apply_back(x_b, df, db, layer_b, g["bytes"])
    dbyte = np.zeros_like(model["in"]["byte"])
    np.add.at(dbyte, chars.ravel(), (dx_b * cmask[:, :, None]).reshape(-1, BYTE))
    g["in"]["byte"] = dbyte
    return float(loss), g


class Adam:
    """Adam steps; word vectors take plain steps, so that only the rows of a batch are touched."""

    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, model: dict, g: dict) -> None:
        self.t += 1
        for part, grads in g.items():
            for name, d in grads.items():
                if isinstance(d, tuple):
                    np.add.at(model[part][name], d[0], np.clip(-20 * self.rate * d[1], -0.05, 0.05))
                    continue
                k = (part, name)
                self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * d
                self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * d * d
                model[part][name] -= (self.rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)
