"""A small causal self-attention model in numpy: scoring, gradients, training steps.

The stream of classes of a batch of texts, each filled up to whole windows (so that a text's score doesn't depend on its neighbours), is cut into windows of ``SCORED`` places, each with ``CONTEXT`` more before it; so every
place is scored once, with CONTEXT to CONTEXT + SCORED - 1 places before it in sight, and all windows of a batch go through masked attention
together. A place sees the classes before it in its own text only; the end mark of the text before stands for the start.

A class is drawn in two steps, group then member, so a place costs 2 * sqrt(classes) outputs. The logits start from counts of class
pairs over the whole corpus; the attention adds to them.
"""

from __future__ import annotations

import numpy as np

from casebook.llm._common import by_value

by_value(__name__)

GROUPS = MEMBERS = 32
CLASSES = GROUPS * MEMBERS
WIDTH, HIDDEN = 16, 32
CONTEXT, SCORED = 8, 24
SPAN = CONTEXT + SCORED
SHAPES = {
    "embed": (CLASSES, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH), "query": (WIDTH, WIDTH), "out": (WIDTH, WIDTH),
    "near": (SPAN,), "up": (WIDTH, HIDDEN), "up0": (HIDDEN,), "down": (HIDDEN, WIDTH),
    "group": (WIDTH, GROUPS), "member": (GROUPS, WIDTH, MEMBERS),
}
_SLOT = np.arange(SPAN)
_DISTANCE = np.arange(CONTEXT, SPAN)[:, None] - _SLOT[None, :]  # of a scored slot and a seen one
_CAUSAL = _DISTANCE >= 0
_PLACE = np.arange(SCORED)
_SCALE = np.float32(WIDTH ** -0.5)
_ONES = np.ones(max(SPAN, GROUPS, MEMBERS), np.float32)


def start(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {}
    for name, shape in SHAPES.items():
        scale = 0.0 if name in ("near", "up0", "group", "member") else 0.3 if name == "embed" else shape[0] ** -0.5
        out[name] = (rng.standard_normal(shape) * scale).astype(np.float32)
    return out


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in SHAPES])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, a = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k] = values[a:a + n].reshape(shape).astype(np.float32)
        a += n
    return out


def aligned(classes: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stream, firsts, places): every text starts a window, the rest of its last one holds end marks; ``places`` of the real classes."""
    whole = -(-lengths // SCORED) * SCORED
    starts = np.cumsum(whole) - whole
    places = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(classes))
    stream = np.full(int(whole.sum()), end, np.int64)
    stream[places] = classes
    return stream, np.repeat(starts, whole), places


def windows(classes: np.ndarray, firsts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, seen) of a stream. ``firsts``: for each place the first place of its text.

    inputs[w, s] is the class before slot s; targets[w, i] the class of scored slot i (-1 past the stream); seen[w, i] the first
    slot that scored slot i may look at.
    """
    n = len(classes)
    count = -(-n // SCORED)
    before = np.full(CONTEXT + count * SCORED, end, np.int64)
    before[CONTEXT + 1:CONTEXT + n] = classes[:-1]
    inputs = np.lib.stride_tricks.sliding_window_view(before, SPAN)[::SCORED]
    targets = np.full(count * SCORED, -1, np.int64)
    targets[:n] = classes
    first = np.arange(count * SCORED)
    first[:n] = firsts
    at = np.arange(count)[:, None] * SCORED - CONTEXT
    seen = np.maximum(first.reshape(count, SCORED) - at, 0)
    return inputs, targets.reshape(count, SCORED), seen


def _near(w: dict) -> np.ndarray:
    """What the distance adds to the scores; slots after the place are out of sight."""
    return np.where(_CAUSAL, w["near"][np.maximum(_DISTANCE, 0)], np.float32(-1e9))


def _shares(s: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exp of the scores, their sums over the slots in sight); ``s`` is overwritten."""
    cut = np.flatnonzero(seen[:, -1])  # windows with a text's start inside
    if len(cut):
        s[cut] = np.where(_SLOT < seen[cut][:, :, None], np.float32(-1e9), s[cut])
    own = s[:, _PLACE, _PLACE + CONTEXT]  # a place sees itself, so the sums stay in single precision if these do
    if s.max(initial=0) > 60 or own.min(initial=0) < -60:
        s -= s.max(2, keepdims=True)
    np.exp(s, out=s)
    return s, s.reshape(-1, SPAN) @ _ONES[:SPAN]  # a product with ones: several times faster than a sum over short rows


def _greatest(x: np.ndarray) -> np.ndarray:
    """``x.max(-1, keepdims=True)``; columns side by side compare faster than short rows."""
    return np.ascontiguousarray(x.reshape(-1, x.shape[-1]).T).max(0).reshape(*x.shape[:-1], 1)


def _rectified(h: np.ndarray, w: dict) -> np.ndarray:
    """max(h + up0, 0), in place; whole arrays are added and compared faster than short rows and numbers."""
    windows_ = h.reshape(-1, SCORED * HIDDEN)
    windows_ += np.tile(w["up0"], SCORED)
    return np.maximum(h, np.zeros_like(h), out=h)


# Training subtracts each row's greatest and divides by plain sums: gradients that are zero then come out as zero; Adam may make
# whole steps of rounding.
def _forward(w: dict, inputs: np.ndarray, seen: np.ndarray) -> dict:
    b = len(inputs)
    x = w["embed"].take(inputs.ravel(), axis=0).reshape(b, SPAN, WIDTH)
    k, v = x @ w["key"], x @ w["value"]
    own = x[:, CONTEXT:]
    q = own @ w["query"]
    s = (q * _SCALE) @ k.transpose(0, 2, 1)
    s += _near(w)
    cut = np.flatnonzero(seen[:, -1])  # windows with a text's start inside
    if len(cut):
        s[cut] = np.where(_SLOT[None, None, :] < seen[cut][:, :, None], np.float32(-1e9), s[cut])
    s -= _greatest(s)
    np.exp(s, out=s)
    s /= s.sum(2, keepdims=True)
    mixed = s @ v
    y = mixed @ w["out"]
    y += own
    y = y.reshape(b * SCORED, WIDTH)
    h = _rectified(y @ w["up"], w)
    z = h @ w["down"]
    z += y
    return {"x": x, "own": own, "k": k, "v": v, "q": q, "a": s, "mixed": mixed, "y": y, "h": h, "z": z}


def _softmax_gradient(logits: np.ndarray, rows: np.ndarray, target: np.ndarray, n: int) -> float:
    """The loss of the targets, summed; ``logits`` become the gradient of its ``n``-th part."""
    logits -= _greatest(logits) if len(logits) else 0
    at = rows * logits.shape[1] + target
    own = logits.ravel()[at].sum(dtype=np.float64)
    np.exp(logits, out=logits)
    total = logits.sum(1, keepdims=True)
    loss = float(np.log(total).sum(dtype=np.float64) - own)
    logits /= total
    logits.ravel()[at] -= 1
    logits /= n
    return loss


class Model:
    """Weights and the corpus' counts: ``follow`` log p(group | class before), ``inside`` log p(member | class before, group)."""

    def __init__(self, weights: dict[str, np.ndarray], follow: np.ndarray, inside: np.ndarray):
        self.w, self.follow, self.inside = weights, follow.astype(np.float32), inside.astype(np.float32)

    def log_probabilities(self, classes: np.ndarray, firsts: np.ndarray, end: int, batch: int = 512) -> np.ndarray:
        """Natural log probability of each place of a stream."""
        inputs, targets, seen = windows(classes, firsts, end)
        out = np.zeros(targets.size, np.float32)
        ready = self._ready()
        for a in range(0, len(inputs), batch):
            i, t = inputs[a:a + batch], np.maximum(targets[a:a + batch].ravel(), 0)
            z = self._states(ready, i, seen[a:a + batch])
            out[a * SCORED:a * SCORED + len(t)] = self._outputs(z, i[:, CONTEXT:].ravel(), t)
        return out[:len(classes)].astype(np.float64)

    def _ready(self) -> dict:
        """Products of the weights that don't depend on the place: key and value, query of each class."""
        w = self.w
        return {"key": w["embed"] @ w["key"], "value": (w["embed"] @ w["value"]) @ w["out"], "query": (w["embed"] @ w["query"]) * _SCALE, "near": _near(w)}

    def _states(self, ready: dict, inputs: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """``_forward``'s last layer, for scoring only."""
        w, own, b = self.w, inputs[:, CONTEXT:].ravel(), len(inputs)
        slots = inputs.ravel()
        s = np.matmul(ready["query"].take(own, axis=0).reshape(b, SCORED, WIDTH),
                      ready["key"].take(slots, axis=0).reshape(b, SPAN, WIDTH).transpose(0, 2, 1))
        s += ready["near"]
        s, total = _shares(s, seen)
        y = np.matmul(s, ready["value"].take(slots, axis=0).reshape(b, SPAN, WIDTH)).reshape(-1, WIDTH)
        y *= (1 / total)[:, None]
        y += w["embed"].take(own, axis=0)
        h = _rectified(y @ w["up"], w)
        z = h @ w["down"]
        z += y
        return z

    def _outputs(self, z: np.ndarray, previous: np.ndarray, target: np.ndarray) -> np.ndarray:
        order = np.argsort((target // MEMBERS).astype(np.uint8), kind="stable")
        z, previous, target = z.take(order, axis=0), previous[order], target[order]
        group, rows = target // MEMBERS, np.arange(len(z))
        logits = z @ self.w["group"]
        logits += self.follow.take(previous, axis=0)
        own = logits.ravel()[rows * GROUPS + group]
        high = np.float32(max(float(logits.max(initial=0)) - 60, 0))  # one shift for all keeps exp in range
        np.exp(logits - high if high else logits, out=logits)
        lost = np.log(logits @ _ONES[:GROUPS]) + high
        m = self._member_logits(z, previous, group)
        own += m.ravel()[rows * MEMBERS + target % MEMBERS]
        high = np.float32(max(float(m.max(initial=0)) - 60, 0))
        np.exp(m - high if high else m, out=m)
        lost += np.log(m @ _ONES[:MEMBERS]) + high
        out = np.empty(len(z), np.float32)
        out[order] = own - lost
        return out

    def _member_logits(self, z: np.ndarray, previous: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Of the group's members, for places in the order of their groups."""
        m = self.inside.reshape(-1, MEMBERS).take(previous * GROUPS + group, axis=0).astype(z.dtype, copy=False)
        cuts = np.searchsorted(group, np.arange(GROUPS + 1))
        for g in np.flatnonzero(np.diff(cuts)):
            m[cuts[g]:cuts[g + 1]] += z[cuts[g]:cuts[g + 1]] @ self.w["member"][g]
        return m

    def gradient(self, inputs: np.ndarray, targets: np.ndarray, seen: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """(mean loss, gradient of the mean loss) over a batch of windows."""
        w, f = self.w, _forward(self.w, inputs, seen)
        t = targets.ravel()
        real = t >= 0
        n = max(int(real.sum()), 1)
        # Places in the order of their groups: the member logits of a group are one slice, their softmax is one for all.
        order = np.argsort(np.where(real, t // MEMBERS, GROUPS).astype(np.uint8), kind="stable")
        own = order[:n] if real.any() else order[:0]
        t = t[own]
        z, g = f["z"].take(own, axis=0), {k: np.zeros(s, np.float32) for k, s in SHAPES.items()}
        previous = inputs[:, CONTEXT:].ravel()[own]
        group, member, rows = t // MEMBERS, t % MEMBERS, np.arange(len(t))
        d = z @ w["group"]
        d += self.follow.take(previous, axis=0)
        loss = _softmax_gradient(d, rows, group, n)
        g["group"] = z.T @ d
        dz_own = d @ w["group"].T
        d = self.inside.reshape(-1, MEMBERS).take(previous * GROUPS + group, axis=0).astype(z.dtype, copy=False)
        cuts = np.searchsorted(group, np.arange(GROUPS + 1))
        parts = [(c, slice(cuts[c], cuts[c + 1])) for c in np.flatnonzero(np.diff(cuts))]
        for c, part in parts:
            d[part] += z[part] @ w["member"][c]
        loss += _softmax_gradient(d, rows, member, n)
        for c, part in parts:
            g["member"][c] = z[part].T @ d[part]
            dz_own[part] += d[part] @ w["member"][c].T
        back = np.full(len(f["z"]), len(own))  # row of each place among its own, or the last, of zeros
        back[own] = rows
        dz = np.concatenate([dz_own, np.zeros((1, WIDTH), dz_own.dtype)]).take(back, axis=0)
        dh = dz @ w["down"].T
        dh *= f["h"] > 0
        g["down"], g["up"], g["up0"] = f["h"].T @ dz, f["y"].T @ dh, dh.sum(0)
        dy = dh @ w["up"].T
        dy += dz
        dy = dy.reshape(len(inputs), SCORED, WIDTH)
        two = lambda a, b: a.reshape(-1, WIDTH).T @ b.reshape(-1, WIDTH)
        g["out"] = np.einsum("bsi,bsj->ij", f["mixed"], dy, optimize=True)
        dm = dy @ w["out"].T
        da = dm @ f["v"].transpose(0, 2, 1)
        dv = f["a"].transpose(0, 2, 1) @ dm
        da -= np.einsum("bij,bij->bi", da, f["a"])[:, :, None]
        da *= f["a"]
        ds = da
        g["near"] = np.bincount(np.maximum(_DISTANCE, 0).ravel(), (ds.sum(0) * _CAUSAL).ravel(), SPAN).astype(np.float32)
        dq, dk = ds @ f["k"], ds.transpose(0, 2, 1) @ f["q"]
        dq *= _SCALE
        dk *= _SCALE
        g["query"], g["key"], g["value"] = two(f["own"], dq), two(f["x"], dk), two(f["x"], dv)
        dx = dk @ w["key"].T
        dx += dv @ w["value"].T
        dy += dq @ w["query"].T
        dx[:, CONTEXT:] += dy
        columns, at = dx.reshape(-1, WIDTH).T.astype(np.float64, order="C"), inputs.ravel()
        for k in range(WIDTH):
            g["embed"][:, k] = np.bincount(at, columns[k], CLASSES)
        return loss / n, g


def _adam(w: np.ndarray, g: np.ndarray, first: np.ndarray, second: np.ndarray, rate: float, step: int) -> None:
    """One step, in place; ``g`` is overwritten."""
    change = g - first
    change *= 0.1
    first += change
    g *= g
    g -= second
    g *= 0.01
    second += g
    np.divide(second, 1 - 0.99**step, out=g)
    np.sqrt(g, out=g)
    g += 1e-8
    np.divide(first, 1 - 0.9**step, out=change)
    change *= rate
    change /= g
    w -= change


def train(model: Model, inputs: np.ndarray, targets: np.ndarray, seen: np.ndarray, rate: float, batch: int = 256, seed: int = 0,
          state: dict | None = None) -> int:
    """One pass of Adam steps over the windows in a fixed random order, changing the model's weights; the number of steps so far.

    ``state`` carries the moments from one call to the next."""
    order = np.random.default_rng(seed).permutation(len(inputs))
    state = {} if state is None else state
    first = state.setdefault("first", {k: np.zeros(s, np.float32) for k, s in SHAPES.items()})
    second = state.setdefault("second", {k: np.zeros(s, np.float32) for k, s in SHAPES.items()})
    step = state.get("step", 0)
    for a in range(0, len(order), batch):
        own = order[a:a + batch]
        _, g = model.gradient(inputs[own], targets[own], seen[own])
        step += 1
        for k in SHAPES:
            _adam(model.w[k], g[k], first[k], second[k], rate, step)
    state["step"] = step
    return step


def moments(state: dict) -> np.ndarray:
    """The moments of ``train``'s state as one array."""
    return np.concatenate([flat(state["first"]), flat(state["second"])])


def state_of(values: np.ndarray, step: int) -> dict:
    """``train``'s state from its moments."""
    half = len(values) // 2
    return {"first": shaped(values[:half]), "second": shaped(values[half:]), "step": step}
