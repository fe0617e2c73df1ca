"""A small causal self-attention language model in numpy: forward, gradients, training.

One head attends over the current chunk of CHUNK symbols and the one before it, with a learned
bias per distance; a feed-forward layer follows. The next symbol is predicted in two steps, its
class and then the symbol in the class, so a step costs about the square root of the vocabulary.
Symbol 0 begins a text and fills chunks, symbol 1 ends it.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

import numpy as np

CHUNK = 16
BEGIN, END = 0, 1
WIDTH = 16
HIDDEN = 32
NEVER = np.float32(-60.0)


# A float32 holds 2 ** n with n + 127 from bit 23 on.
ONE, ZERO_POWER, LEAST_POWER = np.float32(1 << 23), np.float32(127.0), np.float32(27 << 23)


def soft_exp(x: np.ndarray) -> np.ndarray:
    """2 ** x by straight lines between whole powers, for x over -100.

    Any positive function makes a softmax; this one costs a multiplication and a cast.
    """
    return of_bits((x + ZERO_POWER) * ONE)


def of_bits(x: np.ndarray) -> np.ndarray:
    """soft_exp where the argument comes as (x + ZERO_POWER) * ONE; changes it."""
    np.maximum(x, LEAST_POWER, out=x)
    return x.astype(np.int32).view(np.float32)


def as_bits(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Weights and bias in one matrix for inputs with a last column of ones, scaled for of_bits."""
    return np.concatenate([weights, (bias + ZERO_POWER)[..., None, :]], axis=-2) * ONE


def soft_slope(e: np.ndarray) -> np.ndarray:
    """Derivative of soft_exp at the value e: the power of two below it."""
    return (e.view(np.int32) & np.int32(0x7F800000)).view(np.float32)


@dataclass
class Chunks:
    """Texts cut into rows of CHUNK inputs and targets. `follows`: the row before is of the same text."""

    inputs: np.ndarray
    targets: np.ndarray
    follows: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, symbols: np.ndarray, lengths: np.ndarray) -> Chunks:
        """`symbols` of all texts one after another; each text's end is added here."""
        total = lengths + 1
        rows = (total + CHUNK - 1) // CHUNK
        begin = (np.cumsum(rows) - rows) * CHUNK
        size = int(rows.sum()) * CHUNK
        inputs, targets = np.zeros(size, np.int32), np.zeros(size, np.int32)
        at = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(symbols))
        targets[at] = symbols
        targets[begin + lengths] = END
        inputs[at + 1] = symbols  # the end stands in the same text's rows, so that at + 1 does too
        owner = np.repeat(np.arange(len(lengths)), rows)
        follows = np.concatenate([[False], owner[1:] == owner[:-1]])[: len(owner)]
        return cls(inputs.reshape(-1, CHUNK), targets.reshape(-1, CHUNK), follows, owner)


_query, _key = np.arange(CHUNK)[:, None] + CHUNK, np.arange(2 * CHUNK)[None, :]
_distance = np.clip(_query - _key, 0, 2 * CHUNK - 1)
_causal = _key <= _query
_ones = np.ones(2 * CHUNK, np.float32)


def _over_rows(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b for many rows, a multiple of CHUNK: in blocks of them, which is faster for few columns."""
    a, b = (x.reshape(CHUNK, -1, x.shape[1]) for x in (a, b))
    return np.matmul(a.transpose(0, 2, 1), b).sum(axis=0)


class Model:
    """Parameters by name, and what can be done with them."""

    def __init__(self, counts: np.ndarray, seed: int = 1):
        """counts: of every symbol in the training texts; they set the first guess of the output."""
        # glibc keeps freed memory up to twice the largest block freed: later steps then need no new pages.
        np.empty(31 << 20, np.uint8)
        self.symbols = n = len(counts)
        self.members = m = max(2, int(np.ceil(np.sqrt(n))))
        self.classes = k = (n + m - 1) // m
        rng = np.random.default_rng(seed)

        def draw(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        share = np.zeros(k * m)
        share[:n] = np.maximum(counts, 0.01)
        share[BEGIN] = 0
        share = share.reshape(k, m)
        with np.errstate(divide="ignore"):
            inner = np.log2(share / share.sum(axis=1, keepdims=True))
            outer = np.log2(share.sum(axis=1) / share.sum())
        d = WIDTH
        self.p = {
            "embed": (rng.standard_normal((n, d)) * 0.5).astype(np.float32),
            "qkv": draw(d, 3 * d),
            "bias": np.linspace(1, -2, 2 * CHUNK).astype(np.float32),
            "out": draw(d, d) * np.float32(0.5),
            "up": draw(d, HIDDEN),
            "up_bias": np.zeros(HIDDEN, np.float32),
            "down": draw(HIDDEN, d) * np.float32(0.5),
            "to_class": draw(d, k) * np.float32(0.1),
            "class_bias": np.maximum(outer, NEVER).astype(np.float32),
            "to_symbol": draw(k, d, m) * np.float32(0.1),
            "symbol_bias": np.maximum(inner, NEVER).astype(np.float32),
        }

    # --- parameters as one vector ---

    def vector(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, vector: np.ndarray) -> Model:
        at = 0
        for name, v in self.p.items():
            self.p[name] = vector[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self

    # --- forward ---

    def _attend(self, rows: Chunks):
        p, c = self.p, len(rows.inputs)
        h = p["embed"].take(rows.inputs.ravel(), axis=0)
        mixed = p["qkv"].copy()
        mixed[:, :WIDTH] *= np.float32(1 / np.sqrt(WIDTH))
        qkv = (h @ mixed).reshape(c, CHUNK, 3 * WIDTH)
        q = qkv[:, :, :WIDTH]
        # Keys and values of the chunk before, then of the own one.
        both = np.empty((c, 2 * CHUNK, 2 * WIDTH), np.float32)
        both[:, CHUNK:] = qkv[:, :, WIDTH:]
        both[1:, :CHUNK] = qkv[:-1, :, WIDTH:]
        both[:1, :CHUNK] = 0
        keys, values = both[:, :, :WIDTH], both[:, :, WIDTH:]
        s = np.matmul(q, keys.transpose(0, 2, 1))
        s += np.where(_causal, p["bias"][_distance], np.float32(-100)) + ZERO_POWER
        s *= ONE
        e = of_bits(s)
        e[~rows.follows, :, :CHUNK] = 0
        total = (e.reshape(-1, 2 * CHUNK) @ _ones).reshape(c, CHUNK, 1)
        o = np.matmul(e, values)
        o /= total
        o = o.reshape(-1, WIDTH)
        g = o @ p["out"]
        g += h
        u = g @ p["up"]
        u += p["up_bias"]
        np.maximum(u, 0, out=u)
        z = u @ p["down"]
        z += g
        return h, q, keys, values, e, total, o, g, u, z

    def _by_class(self, group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """An order by class, and the places of each class that occurs in it."""
        order = np.argsort(group.astype(np.uint16), kind="stable")  # 16 bits are sorted by radix
        bounds = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=self.classes))]).tolist()
        return order, [(k, slice(a, b)) for k, (a, b) in enumerate(pairwise(bounds)) if a < b]

    def log10(self, rows: Chunks, batch: int = 512) -> np.ndarray:
        """log10 probability of each row's targets, in batches of rows."""
        out = np.empty(len(rows.inputs))
        to_class = as_bits(self.p["to_class"], self.p["class_bias"])
        to_symbol = as_bits(self.p["to_symbol"], self.p["symbol_bias"])
        ones_class, ones_symbol = np.ones(self.classes, np.float32), np.ones(self.members, np.float32)
        for begin in range(0, len(rows.inputs), batch):
            # The row before is taken along as context.
            first = begin - 1 if begin and rows.follows[begin] else begin
            end = begin + batch
            part = Chunks(rows.inputs[first:end], rows.targets[first:end], rows.follows[first:end].copy(), rows.owner[first:end])
            part.follows[:1] = False
            z = self._attend(part)[-1]
            if first < begin:
                z = z[CHUNK:]
            z = np.concatenate([z, np.ones((len(z), 1), np.float32)], axis=1)
            targets = rows.targets[begin:end].ravel()
            group, member = np.divmod(targets, self.members)
            e = of_bits(z @ to_class)
            chance = e.ravel().take(np.arange(len(targets)) * self.classes + group) / (e @ ones_class)
            order, classes = self._by_class(group)
            z, member = z.take(order, axis=0), member.take(order)
            e = np.empty((len(targets), self.members), np.float32)
            for k, at in classes:
                np.matmul(z[at], to_symbol[k], out=e[at])
            e = of_bits(e)
            inner = e.ravel().take(np.arange(len(targets)) * self.members + member) / (e @ ones_symbol)
            chance[order] *= inner
            logs = np.log10(np.maximum(chance, np.float32(1e-37)), dtype=np.float64)
            logs[targets == BEGIN] = 0.0
            out[begin:end] = logs.reshape(-1, CHUNK).sum(axis=1)
        return out

    # --- gradients ---

    @staticmethod
    def _softmax_gradient(bits: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(loss in nats, its weighted gradient by the logits) of -ln of the share of of_bits; changes its argument."""
        e = of_bits(bits)
        total = e @ np.ones(e.shape[1], np.float32)
        at = np.arange(len(e)) * e.shape[1] + target
        hit = e.ravel()[at]
        slope = soft_slope(e)
        slope *= (weight / total)[:, None]
        slope.ravel()[at] *= 1 - total / hit
        return np.log(total / hit), slope

    def gradient(self, rows: Chunks) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss per target and the gradient of every parameter."""
        p = self.p
        h, q, keys, values, e, total, o, g, u, z = self._attend(rows)
        c = len(rows.inputs)
        targets = rows.targets.ravel()
        group, member = np.divmod(targets, self.members)
        # The output in the order of the classes, so that each has one slice.
        order, classes = self._by_class(group)
        real = (targets.take(order) != BEGIN).astype(np.float32)
        weight = real / np.float32(max(real.sum(), 1))
        z = np.concatenate([z, np.ones((len(z), 1), np.float32)], axis=1).take(order, axis=0)
        d = {}
        loss, dl = self._softmax_gradient(z @ as_bits(p["to_class"], p["class_bias"]), group.take(order), weight)
        both = _over_rows(z, dl)
        d["to_class"], d["class_bias"] = both[:-1], both[-1]
        ordered = dl @ p["to_class"].T
        to_symbol = as_bits(p["to_symbol"], p["symbol_bias"])
        bits = np.empty((len(z), self.members), np.float32)
        for k, at in classes:
            np.matmul(z[at], to_symbol[k], out=bits[at])
        more, dl = self._softmax_gradient(bits, member.take(order), weight)
        loss += more
        both, inner = np.zeros_like(to_symbol), np.empty_like(ordered)
        back = p["to_symbol"].transpose(0, 2, 1)
        for k, at in classes:
            np.matmul(z[at].T, dl[at], out=both[k])
            np.matmul(dl[at], back[k], out=inner[at])
        d["to_symbol"], d["symbol_bias"] = both[:, :-1], both[:, -1]
        ordered += inner
        dz = np.empty_like(ordered)
        dz[order] = ordered
        d["down"] = _over_rows(u, dz)
        du = (dz @ p["down"].T) * (u > 0)
        d["up"], d["up_bias"] = _over_rows(g, du), du.sum(axis=0)
        dg = dz + du @ p["up"].T
        d["out"] = _over_rows(o, dg)
        do = (dg @ p["out"].T).reshape(c, CHUNK, WIDTH)
        # With a = e / total, e = soft_exp(s): ds = (da - sum(a * da)) * slope(e) / total, and sum(a * da) = o . do.
        do /= total
        ds = np.matmul(do, values.transpose(0, 2, 1))
        ds -= ((do.reshape(-1, WIDTH) * o) @ np.ones(WIDTH, np.float32)).reshape(c, CHUNK, 1)
        ds *= soft_slope(e)
        ds *= _causal
        d["bias"] = np.bincount(_distance.ravel(), ds.sum(axis=0).ravel(), 2 * CHUNK).astype(np.float32)
        back = np.empty((c, 2 * CHUNK, 2 * WIDTH), np.float32)
        np.matmul(ds.transpose(0, 2, 1), q, out=back[:, :, :WIDTH])
        np.matmul(e.transpose(0, 2, 1), do, out=back[:, :, WIDTH:])
        dqkv = np.empty((c, CHUNK, 3 * WIDTH), np.float32)
        np.matmul(ds, keys, out=dqkv[:, :, :WIDTH])
        dqkv[:, :, :WIDTH] *= np.float32(1 / np.sqrt(WIDTH))
        dqkv[:, :, WIDTH:] = back[:, CHUNK:]
        dqkv[:-1, :, WIDTH:] += back[1:, :CHUNK]
        dqkv = dqkv.reshape(-1, 3 * WIDTH)
        d["qkv"] = _over_rows(h, dqkv)
        dh = dg + dqkv @ p["qkv"].T
        ids = rows.inputs.ravel()
        order = np.argsort(ids.astype(np.uint16) if self.symbols <= 1 << 16 else ids, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(ids[order]) > 0]))
        d["embed"] = np.zeros_like(p["embed"])
        d["embed"][ids[order][starts]] = np.add.reduceat(dh[order], starts, axis=0)
        return float((loss * real).sum() / max(real.sum(), 1)), d


class Adam:
    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.step = model, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in model.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in model.p.items()}

    def update(self, grads: dict[str, np.ndarray], rate: float | None = None) -> None:
        self.step += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        shrink = np.float32(min(1.0, 1.0 / max(norm, 1e-12)))
        lr = np.float32((rate or self.rate) * np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step))
        for k, g in grads.items():
            g = g * shrink
            m, v = self.m[k], self.v[k]
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.01) * (g * g - v)
            self.model.p[k] -= lr * m / (np.sqrt(v) + np.float32(1e-6))
