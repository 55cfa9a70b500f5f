"""NumPy kernels of the MLP classifier, run inside Spark tasks.

Layout per hidden layer i: Linear(W_i, b_i) → BatchNorm(g_i, be_i; running
rm_i, rv_i) → ReLU → Dropout, or Linear → ReLU → Dropout → LayerNorm(g_i, be_i)
when batch-norm is off; then Linear(W_out, b_out) → logits.
All math is float64 on float32 inputs.
"""

from __future__ import annotations

import functools
import math
from dataclasses import asdict, dataclass, field

import numpy as np

BN_EPS = 1e-5
BN_MOMENTUM = 0.1


# The defaults of the training configuration.
@dataclass
class MlpParams:
    input_size: int = 21
    hidden_sizes: list[int] = field(default_factory=lambda: [64, 32, 16])
    dropout: float = 0.3
    num_classes: int = 2
    use_batchnorm: bool = True
    learning_rate: float = 1e-3
    weight_decay: float = 1e-3
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    use_focal_loss: bool = True
    focal_gamma: float = 2.0
    label_smoothing: float = 0.1
    batch_size: int = 32
    drop_last: bool = True
    max_epochs: int = 50
    patience: int = 10
    seed: int = 42
    t0: int = 10
    t_mult: int = 2
    eta_min: float = 1e-6

    def replace(self, **kw) -> "MlpParams":
        d = asdict(self)
        d.update(kw)
        return MlpParams(**d)


def hidden_sizes_for(n_features: int) -> list[int]:
    """Layer widths from the feature count."""
    # fixed values: the clamps 64-128, 32-64, 16-32 of the configuration
    return [min(128, max(64, n_features * 2)), min(64, max(32, n_features)), min(32, max(16, n_features // 2))]


def lr_at(p: MlpParams, epoch: int) -> float:
    """Cosine annealing with warm restarts, stepped per epoch."""
    t_i, t_cur = p.t0, epoch
    while t_cur >= t_i:
        t_cur -= t_i
        t_i *= p.t_mult
    return p.eta_min + (p.learning_rate - p.eta_min) * (1 + math.cos(math.pi * t_cur / t_i)) / 2


# ------------------------------------------------------------------ parameters
def param_shapes(p: MlpParams) -> list[tuple[str, tuple, bool]]:
    """(name, shape, trainable) in a fixed order."""
    out = []
    fan_in = p.input_size
    for i, h in enumerate(p.hidden_sizes):
        out += [(f"W{i}", (fan_in, h), True), (f"b{i}", (h,), True),
                (f"g{i}", (h,), True), (f"be{i}", (h,), True)]
        if p.use_batchnorm:
            out += [(f"rm{i}", (h,), False), (f"rv{i}", (h,), False)]
        fan_in = h
    out += [("Wo", (fan_in, p.num_classes), True), ("bo", (p.num_classes,), True)]
    return out


def init_weights(p: MlpParams, seed: int | None = None) -> dict[str, np.ndarray]:
    """Kaiming-normal (fan-in, ReLU gain) weights, zero biases, BN gamma 1 / beta 0."""
    rng = np.random.default_rng(p.seed if seed is None else seed)
    w = {}
    for name, shape, _ in param_shapes(p):
        if name.startswith("W"):
            w[name] = rng.normal(0.0, math.sqrt(2.0 / shape[0]), size=shape)
        elif name.startswith("g") or name.startswith("rv"):
            w[name] = np.ones(shape)
        else:
            w[name] = np.zeros(shape)
    return w


def flatten(p: MlpParams, w: dict) -> np.ndarray:
    return np.concatenate([np.asarray(w[n], dtype=np.float64).ravel() for n, _, _ in param_shapes(p)])


def unflatten(p: MlpParams, vec: np.ndarray) -> dict:
    out, at = {}, 0
    for n, shape, _ in param_shapes(p):
        size = int(np.prod(shape))
        out[n] = np.asarray(vec[at:at + size], dtype=np.float64).reshape(shape)
        at += size
    return out


# ------------------------------------------------------------------ forward / backward
def forward(p: MlpParams, w: dict, x: np.ndarray, train: bool = False, rng=None):
    """Logits; in training mode also the cache for ``backward`` and updated running stats."""
    a = np.asarray(x, dtype=np.float64)
    cache = []
    new_running = {}
    for i, _ in enumerate(p.hidden_sizes):
        z = a @ w[f"W{i}"] + w[f"b{i}"]
        layer = {"a_in": a}
        if p.use_batchnorm:
            if train:
                n = z.shape[0]
                mu = np.add.reduce(z, axis=0) / n
                d = z - mu
                var = np.add.reduce(d * d, axis=0) / n
                unbiased = var * n / (n - 1) if n > 1 else var
                new_running[f"rm{i}"] = (1 - BN_MOMENTUM) * w[f"rm{i}"] + BN_MOMENTUM * mu
                new_running[f"rv{i}"] = (1 - BN_MOMENTUM) * w[f"rv{i}"] + BN_MOMENTUM * unbiased
            else:
                d, var = z - w[f"rm{i}"], w[f"rv{i}"]
            inv = 1.0 / np.sqrt(var + BN_EPS)
            zhat = d * inv
            y = zhat * w[f"g{i}"] + w[f"be{i}"]
            layer.update(zhat=zhat, inv=inv)
            r = np.maximum(y, 0.0)
            layer["relu_mask"] = y > 0
            if train and p.dropout > 0:
                keep = (rng.random(r.shape) >= p.dropout) / (1.0 - p.dropout)
                r = r * keep
                layer["drop"] = keep
            a = r
        else:
            r = np.maximum(z, 0.0)
            layer["relu_mask"] = z > 0
            if train and p.dropout > 0:
                keep = (rng.random(r.shape) >= p.dropout) / (1.0 - p.dropout)
                r = r * keep
                layer["drop"] = keep
            mu = r.mean(axis=1, keepdims=True)
            var = r.var(axis=1, keepdims=True)
            inv = 1.0 / np.sqrt(var + BN_EPS)
            zhat = (r - mu) * inv
            a = zhat * w[f"g{i}"] + w[f"be{i}"]
            layer.update(zhat=zhat, inv=inv)
        cache.append(layer)
    logits = a @ w["Wo"] + w["bo"]
    return logits, (cache, a), new_running


def softmax_np(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def loss_and_grad(p: MlpParams, logits: np.ndarray, y: np.ndarray, alpha: np.ndarray):
    """Mean loss and d(loss)/d(logits) for focal or weighted smoothed CE."""
    n, k = logits.shape
    prob = softmax_np(logits)
    rows = np.arange(n)
    onehot = np.zeros_like(prob)
    onehot[rows, y] = 1.0
    if p.use_focal_loss:
        pt = np.minimum(np.maximum(prob[rows, y], 1e-300), 1.0)
        logpt = np.log(pt)
        a = alpha[y]
        g = p.focal_gamma
        loss = a * (1 - pt) ** g * (-logpt)
        coef = a * (g * (1 - pt) ** (g - 1) * pt * logpt - (1 - pt) ** g)
        grad = coef[:, None] * (onehot - prob) / n
        return float(loss.mean()), grad
    eps = p.label_smoothing
    logp = np.log(np.clip(prob, 1e-300, 1.0))
    wy = alpha[y]
    W = wy.sum()
    per = (1 - eps) * wy * (-logp[rows, y]) + eps / k * (-(logp * alpha[None, :]).sum(axis=1))
    grad = ((1 - eps) * wy[:, None] * (prob - onehot) + eps / k * (prob * alpha.sum() - alpha[None, :])) / W
    return float(per.sum() / W), grad


def backward(p: MlpParams, w: dict, cache, dlogits: np.ndarray) -> dict:
    layers, a_last = cache
    total = functools.partial(np.add.reduce, axis=0)
    grads = {"Wo": a_last.T @ dlogits, "bo": total(dlogits)}
    da = dlogits @ w["Wo"].T
    for i in reversed(range(len(p.hidden_sizes))):
        L = layers[i]
        if p.use_batchnorm:
            dr = da * L["drop"] if "drop" in L else da
            dy = dr * L["relu_mask"]
            grads[f"g{i}"] = total(dy * L["zhat"])
            grads[f"be{i}"] = total(dy)
            dxhat = dy * w[f"g{i}"]
            n = dy.shape[0]
            dz = L["inv"] / n * (n * dxhat - total(dxhat) - L["zhat"] * total(dxhat * L["zhat"]))
        else:
            grads[f"g{i}"] = total(da * L["zhat"])
            grads[f"be{i}"] = total(da)
            dxhat = da * w[f"g{i}"]
            m = dxhat.shape[1]
            dr = L["inv"] / m * (m * dxhat - dxhat.sum(axis=1, keepdims=True)
                                 - L["zhat"] * (dxhat * L["zhat"]).sum(axis=1, keepdims=True))
            if "drop" in L:
                dr = dr * L["drop"]
            dz = dr * L["relu_mask"]
        grads[f"W{i}"] = L["a_in"].T @ dz
        grads[f"b{i}"] = total(dz)
        if i:  # the input has no gradient
            da = dz @ w[f"W{i}"].T
    return grads


def adamw_step(p: MlpParams, w: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, t: int, lr: float) -> None:
    """In-place AdamW update (decoupled weight decay) of the trainable tensors, each array all of them in one."""
    b1, b2 = p.beta1, p.beta2
    w *= 1 - lr * p.weight_decay
    m *= b1
    m += (1 - b1) * g
    v *= b2
    v += (1 - b2) * g * g
    mhat = m / (1 - b1 ** t)
    vhat = v / (1 - b2 ** t)
    w -= lr * mhat / (np.sqrt(vhat) + p.eps)


class Learner:
    """A model in training. ``w``, ``m`` and ``v`` hold copies by name; their trainable tensors are views into one
    array each, so that an update is a few calls whatever the number of tensors."""

    def __init__(self, p: MlpParams, w: dict, m: dict, v: dict, t: int):
        self.p, self.t = p, t
        shapes = [(n, shape) for n, shape, trainable in param_shapes(p) if trainable]
        self.names = [n for n, _ in shapes]
        self.flat, dicts = [], []
        for d in (w, m, v):
            own = {n: np.array(a, dtype=np.float64) for n, a in d.items()}
            one = np.concatenate([own[n].ravel() for n in self.names])
            at = 0
            for n, shape in shapes:
                size = math.prod(shape)
                own[n] = one[at:at + size].reshape(shape)
                at += size
            self.flat.append(one)
            dicts.append(own)
        self.w, self.m, self.v = dicts

    def step(self, x: np.ndarray, y: np.ndarray, lr: float, alpha: np.ndarray, rng):
        """AdamW on one batch: (loss sum, confusion counts), or None for a batch of less than two rows, which has no
        batch statistics."""
        n = len(y)
        if n < 2:
            return None
        logits, cache, running = forward(self.p, self.w, x, train=True, rng=rng)
        loss, dlog = loss_and_grad(self.p, logits, y, alpha)
        grads = backward(self.p, self.w, cache, dlog)
        self.t += 1
        w, m, v = self.flat
        adamw_step(self.p, w, np.concatenate([grads[k].ravel() for k in self.names]), m, v, self.t, lr)
        self.w.update(running)
        pred = logits.argmax(axis=1)
        y1, y0, p1, p0 = y == 1, y == 0, pred == 1, pred == 0
        return loss * n, [np.count_nonzero(c) for c in (y1 & p1, y0 & p1, y0 & p0, y1 & p0)]


def predict_logits(p: MlpParams, w: dict, x: np.ndarray) -> np.ndarray:
    return forward(p, w, x, train=False)[0]


def train_batches(p: MlpParams, w: dict, m: dict, v: dict, t0: int, lr: float, batches, alpha: np.ndarray, rng):
    """Trains on (x, y) batches in turn, AdamW per batch; batch statistics need two rows, so a batch
    of one row is skipped. Returns (steps, loss_sum, n_seen, confusion counts)."""
    learner = Learner(p, w, m, v, t0)
    loss_sum, seen = 0.0, 0
    conf = np.zeros(4)
    for xb, yb in batches:
        if (got := learner.step(xb, yb, lr, alpha, rng)) is not None:
            loss_sum += got[0]
            seen += len(yb)
            conf += got[1]
    for d, own in ((w, learner.w), (m, learner.m), (v, learner.v)):
        d.update(own)
    return learner.t - t0, loss_sum, seen, conf


def train_partition(p: MlpParams, w: dict, m: dict, v: dict, t0: int, lr: float,
                    x: np.ndarray, y: np.ndarray, alpha: np.ndarray, rng, drop_last: bool = False):
    """One epoch over arrays in memory: seeded shuffle and mini-batches over all rows. The last batch
    may be smaller (a last row of its own joins the batch before it) or, with ``drop_last``, is left out
    unless it is the only one."""
    n, bs = len(y), p.batch_size
    order = rng.permutation(n)
    starts = [s for s in range(0, n, bs) if n - s > 1]
    ends = [*starts[1:], n]
    if drop_last and n > bs:
        starts = list(range(0, n - bs + 1, bs))
        ends = [s + bs for s in starts]
    cut = [order[s:e] for s, e in zip(starts, ends)]
    return train_batches(p, w, m, v, t0, lr, [(x[i], y[i]) for i in cut], alpha, rng)
