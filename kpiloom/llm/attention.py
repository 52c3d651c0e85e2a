"""A causal self-attention language model over token symbols, in numpy: forward, backward, training step.

A text is the row START, s1, ..., sn; the model gives the probability of each
next symbol, END after the last.  The rows of many texts are cut into blocks of
``BLOCK`` positions.  A window is a block with the block before it: the
positions of the block attend to all earlier positions of the window and to
themselves (masked, in one batched product), so windows overlap by half, each
position has BLOCK to 2 * BLOCK - 1 symbols of context (fewer at a text's
start), and each symbol is scored once, in the window of its own block.

    x = E[s];  q, k, v = x Wq, x Wk, x Wv;  h = x + softmax(q k' / sqrt + distance bias) v Wo
    P(next) = P(class | h) P(symbol | class, h)

Symbols are listed in the order of their classes, ``width`` places to a class, so
that a step costs two short softmaxes instead of one over the vocabulary.
State: parameters and the sums of their squared gradients (Adagrad), all float32.
"""

from __future__ import annotations

import numpy as np

BLOCK, DIM = 16, 16
RATE = 0.1
START = 0  # the end symbol also stands before the first
NEVER = np.float32(-1e9)
_DENSE = ("wq", "wk", "wv", "wo", "near", "c", "cb")


def initial(counts: np.ndarray, width: int, dim: int = DIM) -> dict[str, np.ndarray]:
    """counts: (classes * width) of the symbols, -1 at unused places.  Biases start at the counts' shares, so an untrained
    model is about the unigram model."""
    classes = len(counts) // width
    rng = np.random.default_rng(5)
    mass = np.where(counts < 0, 0, counts + 0.1).reshape(classes, width)
    with np.errstate(divide="ignore"):
        u = np.log(mass / mass.sum(1, keepdims=True))
        c = np.log(mass.sum(1) / mass.sum())
    small = lambda *shape: rng.normal(0, 0.3 / np.sqrt(dim), shape).astype(np.float32)
    state = {"e": rng.normal(0, 0.3, (len(counts), dim)).astype(np.float32), "wq": small(dim, dim), "wk": small(dim, dim), "wv": small(dim, dim),
             "wo": small(dim, dim), "near": -0.1 * np.arange(2 * BLOCK, dtype=np.float32), "c": small(dim, classes), "cb": c.astype(np.float32),
             "u": rng.normal(0, 0.1 / np.sqrt(dim), (classes, width, dim)).astype(np.float32), "ub": np.maximum(u, NEVER).astype(np.float32)}
    return state | {f"g_{k}": np.full_like(v, 1e-6) for k, v in state.items()}


def blocks_of(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of texts -> per block: inputs, targets (-1 behind the end), whether it is a text's first; per text: its blocks."""
    n = np.array([len(t) + 1 for t in texts])
    per = -(-n // BLOCK)
    first = np.cumsum(per) - per
    at = np.arange(n.sum()) + np.repeat(first * BLOCK - (np.cumsum(n) - n), n)
    x, y = np.zeros(per.sum() * BLOCK, np.int32), np.full(per.sum() * BLOCK, -1, np.int32)
    ends = np.cumsum(n) - 1
    flow = np.zeros(n.sum(), np.int32)
    inner = np.ones(n.sum(), bool)
    inner[ends] = False
    flow[inner] = np.concatenate(texts) if texts else 0
    y[at] = flow                  # the last of each text is END
    into = np.roll(flow, 1)       # the first of each text is START, the same symbol
    x[at] = into
    begins = np.zeros(per.sum(), bool)
    begins[first] = True
    return x.reshape(-1, BLOCK), y.reshape(-1, BLOCK), begins, per


def _exps(z: np.ndarray, make) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(z - shift) in place of z, its row sums, and the shift: 0 where that is safe, else each row's largest entry.

    make() gives z again; it is called if a row's exponentials vanish or overflow."""
    ones = np.ones(z.shape[-1], np.float32)
    if z.max() < 60:
        np.exp(z, out=z)
        sums = z @ ones
        if sums.min(initial=1) > 1e-30:
            return z, sums, 0.0
    z = make()
    shift = z.max(-1)
    z -= shift[..., None]
    np.exp(z, out=z)
    return z, z @ ones, shift


_DISTANCE = np.clip(BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None], 0, 2 * BLOCK - 1)
_MASK = np.where(np.arange(2 * BLOCK)[None] > BLOCK + np.arange(BLOCK)[:, None], NEVER, np.float32(0))


def attend(p: dict, x: np.ndarray, begins: np.ndarray, before: np.ndarray | None) -> dict:
    """x: (blocks, BLOCK) symbols that follow each other; before: the block ahead of the first, if that one belongs to its text."""
    rows = np.concatenate([before[None] if before is not None else np.zeros((1, BLOCK), x.dtype), x])
    e = np.take(p["e"], rows.ravel(), axis=0)
    dim = e.shape[1]
    # a window is a view of two blocks that follow each other
    kk, vv = (np.lib.stride_tricks.sliding_window_view(e @ p[w], (2 * BLOCK, dim))[::BLOCK, 0] for w in ("wk", "wv"))
    q = (e[BLOCK:] @ (p["wq"] * np.float32(1 / np.sqrt(dim)))).reshape(-1, BLOCK, dim)
    bias = p["near"][_DISTANCE] + _MASK

    def logits() -> np.ndarray:
        s = q @ kk.transpose(0, 2, 1)
        s += bias
        s[begins, :, :BLOCK] = NEVER
        return s

    a, sums, _ = _exps(logits(), logits)
    o = a @ vv
    o /= sums[..., None]
    o = o.reshape(-1, dim)
    return {"rows": rows, "e": e, "q": q, "kk": kk, "vv": vv, "a": a, "sums": sums, "o": o, "h": e[BLOCK:] + o @ p["wo"]}


def log_probs(p: dict, h: np.ndarray, y: np.ndarray, width: int, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probabilities of the targets (0 where y is -1).  With grads (filled with those of the output layer), also the
    gradient of their negative mean in h."""
    at = np.nonzero(y >= 0)[0]
    at = at[np.argsort((y[at] // width).astype(np.int16), kind="stable")]
    t, hh = y[at], h[at]
    cls, place, n = t // width, t % width, np.arange(len(at))
    one = np.float32(1 / max(1, len(at)))
    logits = lambda: hh @ p["c"] + p["cb"]
    z = logits()
    out = z[n, cls].astype(np.float64)
    ez, sums, shift = _exps(z, logits)
    out -= np.log(sums) + shift
    dh = None
    if grads is not None:
        ez[n, cls] -= sums                 # (ez / sums) is then the gradient in z
        scale = (one / sums)[:, None]
        left = hh * scale
        grads["c"], grads["cb"] = left.T @ ez, scale[:, 0] @ ez
        dh = (ez @ p["c"].T) * scale
    # the places of all classes in one array; the bias is one more dimension
    ends = np.append(0, np.cumsum(np.bincount(cls, minlength=len(p["cb"]))))
    spans = [(k, ends[k], ends[k + 1]) for k in np.nonzero(np.diff(ends))[0].tolist()]
    table = np.concatenate([p["u"], p["ub"][..., None]], axis=2)
    longer = np.concatenate([hh, np.ones((len(at), 1), hh.dtype)], axis=1)

    def logits() -> np.ndarray:
        z = np.empty((len(at), width), hh.dtype)
        for k, lo, hi in spans:
            np.matmul(longer[lo:hi], table[k].T, out=z[lo:hi])
        return z

    z = logits()
    out += z[n, place]
    ez, sums, shift = _exps(z, logits)
    out -= np.log(sums) + shift
    if grads is not None:
        ez[n, place] -= sums
        scale = (one / sums)[:, None]
        longer *= scale
        back = np.empty_like(hh)
        for k, lo, hi in spans:
            g = ez[lo:hi].T @ longer[lo:hi]
            grads["u"][k], grads["ub"][k] = g[:, :-1], g[:, -1]
            np.matmul(ez[lo:hi], p["u"][k], out=back[lo:hi])
        back *= scale
        dh += back
    full = np.zeros(len(y), np.float64)
    full[at] = out
    if dh is None:
        return full, None
    back = np.zeros_like(h)
    back[at] = dh
    return full, back


def _down(state: dict, name: str, g: np.ndarray, at=None, rate: float = RATE) -> None:
    """Adagrad on the whole array, or on the rows ``at``."""
    w, acc = state[name], state[f"g_{name}"]
    if at is None:
        acc += g * g
        w -= rate * g / np.sqrt(acc)
    else:
        acc[at] += g * g
        w[at] -= rate * g / np.sqrt(acc[at])


def train_step(state: dict, x: np.ndarray, y: np.ndarray, begins: np.ndarray, before: np.ndarray | None, width: int, rate: float = RATE) -> float:
    """One step on blocks that follow each other; returns the sum of the log probabilities before it."""
    f = attend(state, x, begins, before)
    g: dict = {"u": {}, "ub": {}}
    h, e, o, a, q = f["h"], f["e"], f["o"], f["a"], f["q"]
    got, dh = log_probs(state, h, y.ravel(), width, g)
    dim = h.shape[1]
    g["wo"] = o.T @ dh
    do = dh @ state["wo"].T
    inner = (do * o).sum(1).reshape(q.shape[:2])
    do = do.reshape(q.shape)
    scale = 1 / f["sums"][..., None]
    dv = a.transpose(0, 2, 1) @ (do * scale)
    ds = do @ f["vv"].transpose(0, 2, 1)
    ds -= inner[..., None]
    ds *= a                                # (ds / sums) is the gradient in the attention's logits
    dq = (ds @ f["kk"]) * (scale * np.float32(1 / np.sqrt(dim)))
    dk = ds.transpose(0, 2, 1) @ (q * scale)
    shares = np.einsum("bij,bi->ij", ds, scale[..., 0])
    g["near"] = np.bincount(_DISTANCE.ravel(), weights=shares.ravel(), minlength=2 * BLOCK).astype(np.float32)

    def along(d: np.ndarray) -> np.ndarray:
        """Gradients of the window's places -> of the blocks: a block is the second half of its own window, the first of the next."""
        whole = np.zeros((len(d) + 1, BLOCK, dim), np.float32)
        whole[1:] += d[:, BLOCK:]
        whole[:-1] += d[:, :BLOCK]
        return whole.reshape(-1, dim)

    dk, dv, dq = along(dk), along(dv), dq.reshape(-1, dim)
    g["wk"], g["wv"], g["wq"] = e.T @ dk, e.T @ dv, e[BLOCK:].T @ dq
    de = dk @ state["wk"].T
    de += dv @ state["wv"].T
    de[BLOCK:] += dh
    de[BLOCK:] += dq @ state["wq"].T
    ids = f["rows"].ravel()
    order = np.argsort(ids.astype(np.int16 if len(state["e"]) < 1 << 15 else np.int32), kind="stable")
    ids = ids[order]
    cuts = np.nonzero(np.append(True, ids[1:] != ids[:-1]))[0]
    _down(state, "e", np.add.reduceat(de[order], cuts, axis=0), ids[cuts], rate)
    for name in _DENSE:
        _down(state, name, g[name], None, rate)
    if g["u"]:
        touched = np.array(sorted(g["u"]))
        _down(state, "u", np.stack([g["u"][k] for k in touched]), touched, rate)
        _down(state, "ub", np.stack([g["ub"][k] for k in touched]), touched, rate)
    return float(got.sum())


def text_scores(p: dict, texts: list[np.ndarray], width: int, blocks: int) -> np.ndarray:
    """Natural log probability of each text with its end."""
    if not texts:
        return np.zeros(0)
    x, y, begins, per = blocks_of(texts)
    got = np.zeros(len(x))
    for lo in range(0, len(x), blocks):
        part = slice(lo, lo + blocks)
        f = attend(p, x[part], begins[part], x[lo - 1] if lo else None)
        got[part] = log_probs(p, f["h"], y[part].ravel(), width)[0].reshape(-1, BLOCK).sum(1)
    return np.add.reduceat(got, np.cumsum(per) - per)


def learn(state: dict, texts: list[np.ndarray], width: int, blocks: int, rate: float = RATE) -> tuple[float, int]:
    """Steps over all windows of the texts, once; the sum of log probabilities on the way and the symbols seen."""
    if not texts:
        return 0.0, 0
    x, y, begins, _ = blocks_of(texts)
    total = 0.0
    for lo in range(0, len(x), blocks):
        part = slice(lo, lo + blocks)
        total += train_step(state, x[part], y[part], begins[part], x[lo - 1] if lo else None, width, rate)
    return total, int((y >= 0).sum())
