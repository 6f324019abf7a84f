"""A gated recurrent network with a class-factored softmax, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: State, word classes, words of a class, classes of words beyond the vocabulary.
HIDDEN, CLASSES, WIDTH, RARE = 16, 48, 64, 16
VOCABULARY = CLASSES * WIDTH
OUT = CLASSES + RARE
#: Streams trained side by side, and steps that gradients flow back over.
LANES, WINDOW = 512, 16
#: Steps that scoring looks at at once, at most, and rows of the outer softmax.
WIDE, ROWS = 256, 1024
SHAPES = {
    "x": (VOCABULARY + RARE, 3 * HIDDEN),  # what a token adds to the update and reset gates and to the candidate
    "u": (HIDDEN, 3 * HIDDEN),
    "outer": (HIDDEN + 1, OUT),  # the last row is the bias
    "inner": (CLASSES, HIDDEN + 1, WIDTH),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
Weights = dict[str, np.ndarray]


def views(flat: np.ndarray) -> Weights:
    """The named arrays inside one flat array, and the weights and biases of both softmaxes."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name], at = flat[at : at + n].reshape(shape), at + n
    outer, inner = out["outer"], out["inner"]
    return out | {"c": outer[:-1], "cb": outer[-1], "w": inner[:, :-1], "wb": inner[:, -1]}


def _gates(w: np.ndarray) -> np.ndarray:
    """The three gates' columns, one table behind the other."""
    return w.reshape(-1, 3, HIDDEN).transpose(1, 0, 2)


def initial(words: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Small random weights, and biases that make the untrained model the unigram model.

    Word i is the word ``i // CLASSES`` of class ``i % CLASSES``.
    """
    rng = np.random.default_rng(7)
    flat = np.zeros(SIZE, np.float32)
    p = views(flat)
    p["x"][:] = rng.normal(0, 0.3, p["x"].shape)
    p["u"][:] = rng.normal(0, HIDDEN**-0.5, p["u"].shape)
    p["c"][:] = rng.normal(0, 0.1, p["c"].shape)
    p["w"][:] = rng.normal(0, 0.1, p["w"].shape)
    n = np.full(VOCABULARY, 1e-9)
    n[: len(words)] = np.maximum(words, 1e-9)
    grid = n.reshape(WIDTH, CLASSES).T
    p["wb"][:] = np.log(grid / grid.sum(axis=1, keepdims=True))
    mass = np.concatenate([grid.sum(axis=1), np.maximum(rare, 1)])
    p["cb"][:] = np.log(mass / mass.sum())
    return flat


def step(p: Weights, token: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The state after one token, and what its gradient needs.

    Gates lie behind each other, so each is one stretch of memory.
    """
    x, u = _gates(np.take(p["x"], token, axis=0)), h @ _gates(p["u"])
    gates, half = u[:2], np.float32(0.5)
    gates += x[:2]
    gates *= half
    np.tanh(gates, out=gates)
    gates *= half
    gates += half
    z, r = gates
    n = r * u[2]
    n += x[2]
    np.tanh(n, out=n)
    after = h - n
    after *= z
    after += n
    return after, z, r, n, u[2]


def outputs(p: Weights, h: np.ndarray, target: np.ndarray, grads: Weights | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-probability of each target after its state; with ``grads``, also adds to them.

    The narrow side of each product is scaled by the sums of exponentials, not the wide one.
    """
    at = np.arange(len(target))
    known = target < VOCABULARY
    kind = np.where(known, target % CLASSES, CLASSES + target - VOCABULARY)
    # rows of a class follow each other
    order = np.argsort(np.where(known, kind, CLASSES).astype(np.int16), kind="stable")
    kind, target = kind[order], target[order]
    ends = np.cumsum(np.bincount(kind[kind < CLASSES], minlength=CLASSES)).tolist()
    hs = np.ones((len(target), HIDDEN + 1), np.float32)
    hs[:, :HIDDEN] = h[order]
    logs, ones = np.empty(len(target), np.float32), np.ones(OUT, np.float32)
    dh = None if grads is None else np.empty((len(target), HIDDEN), np.float32)
    for a in range(0, len(target), ROWS):
        part, k, i = hs[a : a + ROWS], kind[a : a + ROWS], at[: len(target) - a][:ROWS]
        e = part @ p["outer"]
        chosen = e[i, k]
        total = np.exp(e, out=e) @ ones
        logs[a : a + ROWS] = chosen - np.log(total)
        if grads is not None:
            e[i, k] -= total
            total = (1 / total)[:, None]
            grads["outer"] += (part * total).T @ e
            np.multiply(e @ p["c"].T, total, out=dh[a : a + ROWS])
    slot, ones, a = target // CLASSES, np.ones(WIDTH, np.float32), 0
    for k, b in enumerate(ends):
        if a < b:
            part, i = hs[a:b], (at[: b - a], slot[a:b])
            q = part @ p["inner"][k]
            chosen = q[i]
            total = np.exp(q, out=q) @ ones
            logs[a:b] += chosen - np.log(total)
            if grads is not None:
                q[i] -= total
                total = (1 / total)[:, None]
                grads["inner"][k] += (part * total).T @ q
                dh[a:b] += (q @ p["w"][k].T) * total
        a = b
    back = np.empty_like(logs)
    back[order] = logs
    if dh is None:
        return back, None
    moved = np.empty_like(dh)
    moved[order] = dh
    return back, moved


def train_window(p: Weights, seen: Weights, lr: float, previous: np.ndarray, target: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One update over a window (steps x lanes); returns the state to carry on with.

    ``previous`` is what each step reads, ``fresh`` where a document starts.
    """
    steps, lanes = target.shape
    kept, befores, states = [], np.empty((steps, lanes, HIDDEN), np.float32), np.empty((steps, lanes, HIDDEN), np.float32)
    starts = fresh.any(axis=1).tolist()
    for t in range(steps):
        befores[t] = h
        if starts[t]:
            befores[t, fresh[t]] = 0
        h, *rest = step(p, previous[t], befores[t])
        kept.append(rest)
        states[t] = h
    grads = {k: np.zeros_like(p[k]) for k in SHAPES if k != "x"}
    _, dout = outputs(p, states.reshape(-1, HIDDEN), target.reshape(-1), grads)
    dout = dout.reshape(states.shape)
    dx, reset = np.empty((3, steps, lanes, HIDDEN), np.float32), np.empty((steps, lanes, HIDDEN), np.float32)
    dh = np.zeros((lanes, HIDDEN), np.float32)
    back = [np.ascontiguousarray(u.T) for u in _gates(p["u"])]
    for t in range(steps - 1, -1, -1):
        z, r, n, un = kept[t]
        dh += dout[t]
        dz, dr, dn = dx[:, t]
        stay = dh * z
        np.subtract(befores[t], n, out=dz)
        dz *= stay
        # dh * (1 - z)
        dh -= stay
        dz *= 1 - z
        np.multiply(n, n, out=dn)
        np.subtract(1, dn, out=dn)
        dn *= dh
        np.multiply(dn, r, out=reset[t])
        np.multiply(reset[t], un, out=dr)
        dr *= 1 - r
        dh = stay
        dh += dz @ back[0]
        dh += dr @ back[1]
        dh += reset[t] @ back[2]
        if starts[t]:
            dh[fresh[t]] = 0
    read = befores.reshape(-1, HIDDEN).T
    for k, d in enumerate((dx[0], dx[1], reset)):
        _gates(grads["u"])[k] = read @ d.reshape(-1, HIDDEN)
    scale = np.float32(1 / target.size)
    for k, g in grads.items():
        g *= scale
        seen[k] += g * g
        p[k] -= np.float32(lr) * g / (np.sqrt(seen[k]) + np.float32(1e-6))
    read = previous.reshape(-1)
    # 16 bits, which numpy sorts by radix
    order = np.argsort(read.astype(np.int16), kind="stable")
    listed = read[order]
    starts = np.append(0, np.flatnonzero(np.diff(listed)) + 1)
    rows = listed[starts]
    for k, d in enumerate(dx):
        g = np.add.reduceat(d.reshape(-1, HIDDEN)[order], starts, axis=0) * scale
        at = rows, slice(k * HIDDEN, (k + 1) * HIDDEN)
        was = seen["x"][at] + g * g
        seen["x"][at] = was
        p["x"][at] -= np.float32(lr) * g / (np.sqrt(was) + np.float32(1e-6))
    return h


def train(flat: np.ndarray, texts: Iterator[np.ndarray], end: int, lr: float) -> tuple[np.ndarray, int]:
    """Weights after one pass over documents, and the tokens passed.

    Documents follow each other in a stream that is cut into lanes.
    """
    flat = flat.copy()
    p, seen = views(flat), views(np.full(SIZE, 1e-8, np.float32))
    held: list[np.ndarray] = []
    n = total = 0

    def spend() -> None:
        target = np.concatenate(held)
        previous = np.append(end, target[:-1])
        fresh = previous == end
        lanes = max(1, min(LANES, len(target) // WINDOW))
        steps = len(target) // lanes
        cut = [a[: lanes * steps].reshape(lanes, steps).T for a in (previous, target, fresh)]
        rest = [a[lanes * steps :].reshape(-1, 1) for a in (previous, target, fresh)]
        for block in (cut, rest):
            if not block[0].size:
                continue
            h = np.zeros((block[0].shape[1], HIDDEN), np.float32)
            for t in range(0, len(block[0]), WINDOW):
                h = train_window(p, seen, lr, *(a[t : t + WINDOW] for a in block), h)

    for ids in texts:
        held.append(ids)
        n, total = n + len(ids), total + len(ids)
        if n >= LANES * WINDOW * 32:
            spend()
            held, n = [], 0
    if held:
        spend()
    return flat, total


def score(p: Weights, texts: list[np.ndarray], end: int, together: int = 1024) -> np.ndarray:
    """Natural log-likelihood of each whole document, state carried from window to window."""
    out = np.zeros(len(texts))
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    for a in range(0, len(order), together):
        group = order[a : a + together]
        lengths = np.array([len(texts[i]) for i in group])
        h, last = np.zeros((len(group), HIDDEN), np.float32), np.full(len(group), end)
        t = 0
        while t < lengths[0]:
            active = int(np.searchsorted(-lengths, -t))
            # few long documents are looked at over more steps at once: a call costs about the same for them
            width = min(max(WINDOW, min(WIDE, together * WINDOW // 4 // active)), int(lengths[0]) - t)
            block = np.full((active, width), -1)
            for row, i in enumerate(group[:active]):
                part = texts[i][t : t + width]
                block[row, : len(part)] = part
            h, states = h[:active], np.empty((width, active, HIDDEN), np.float32)
            last = last[:active]
            for s in range(width):
                h = states[s] = step(p, last, h)[0]
                last = np.maximum(block[:, s], 0)
            real = block.T >= 0
            logs = np.zeros(real.shape)
            logs[real] = outputs(p, states[real], block.T[real])[0]
            out[group[:active]] += logs.sum(axis=0)
            t += width
    return out
