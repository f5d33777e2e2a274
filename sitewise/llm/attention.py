"""A small causal self-attention model in numpy: training by Adam, and scoring of long sequences in overlapping windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Positions of a window, and how many of them only give context to the rest in every window but the first.
WINDOW, OVERLAP, DIM = 32, 8, 24


#: Scores beyond this are made smaller before they are raised, so that no exponential overflows; others needn't be.
_SAFE = 60.0


def _exp(z: np.ndarray) -> np.ndarray:
    """Exponentials in place, up to one factor for each row."""
    if z.max(initial=0.0) > _SAFE:
        z -= z.max(-1, keepdims=True)
    return np.exp(z, out=z)


_MASK = np.where(np.tri(WINDOW, dtype=bool), 0, -1e4).astype(np.float32)


def _beside(x: np.ndarray, value: float) -> np.ndarray:
    """x with one more column, of this value."""
    return np.concatenate([x, np.full((len(x), 1), value, x.dtype)], 1)


@dataclass
class Attention:
    """One block: embeddings and places, masked attention, a layer of rectified units, and an output over classes."""

    p: dict[str, np.ndarray]

    @staticmethod
    def new(units: int, classes: int, dim: int = DIM, seed: int = 1) -> Attention:
        r = np.random.default_rng(seed)
        shapes = {"e": (units, dim), "at": (WINDOW, dim), "q": (dim, dim), "k": (dim, dim), "v": (dim, dim), "o": (dim, dim), "w1": (dim, 2 * dim), "b1": (2 * dim,), "w2": (2 * dim, dim), "out": (dim, classes), "b": (classes,)}
        scale = {"e": 0.3, "at": 0.1, "b1": 0.0, "b": 0.0}
        return Attention({n: (r.standard_normal(s) * scale.get(n, 1 / np.sqrt(s[0]))).astype(np.float32) for n, s in shapes.items()})

    def products(self) -> tuple[np.ndarray, ...]:
        """The weights as products use them: states and places with a column of ones, queries by keys, values by outputs, and biases as rows that meet the ones."""
        p = self.p
        scale = p["q"].dtype.type(1 / np.sqrt(len(p["q"])))
        return (
            _beside(p["e"], 1), _beside(p["at"], 0), (p["q"] @ p["k"].T) * scale, _beside(p["v"] @ p["o"], 0), np.concatenate([p["w1"], p["b1"][None]]), _beside(p["w2"], 0),
            np.concatenate([p["out"], p["b"][None]]),
        )

    def _states(self, units: np.ndarray, products: tuple[np.ndarray, ...], skip: int = 0) -> tuple:
        """Hidden states [n * (t - skip), dim + 1] of the places from skip on, the last column ones, and what they were made of.

        Scores are x (q k') x' and outputs (a x) (v o), so keys and values are the states themselves; their column of ones gives the sums of the
        exponentials, which divide what they weigh and not themselves.
        """
        n, t = units.shape
        e, at, joint, through, w1, w2, _ = products
        dim = len(joint)
        x = e.take(units, 0)
        x += at[:t]
        own = x if not skip else np.ascontiguousarray(x[:, skip:])
        flat = own.reshape(-1, dim + 1)
        q = (flat[:, :dim] @ joint).reshape(n, t - skip, dim)
        a = q @ x[:, :, :dim].transpose(0, 2, 1)
        a += _MASK[skip:t, :t]
        _exp(a)
        c = (a @ x).reshape(-1, dim + 1)
        sums = c[:, dim:]
        c = c[:, :dim] / sums
        y = c @ through
        y += flat
        r = y @ w1
        np.maximum(r, 0, out=r)
        h = r @ w2
        h += y
        return h, (x, q, a, sums, c, y, r)

    def hidden(self, units: np.ndarray) -> tuple[np.ndarray, tuple]:
        """units [n, t] to hidden states [n, t, dim]; a place sees itself and what precedes it."""
        h, made = self._states(units, self.products())
        return h[:, :-1].reshape(*units.shape, -1), made

    def log_probabilities(self, units: np.ndarray, classes: np.ndarray, skip: int = 0, products: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
        """Natural logarithms of the probability of each place's class, from place skip on; products() may be made once for many calls."""
        n, t = units.shape
        products = products or self.products()
        z = _exp(self._states(units, products, skip)[0] @ products[-1])
        right = z[np.arange(len(z)), classes[:, skip:].ravel()]
        return np.log(right / (z @ np.ones(z.shape[1], z.dtype)) + 1e-30).reshape(n, t - skip)

    def gradients(self, units: np.ndarray, classes: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over places of weight 1, and its gradient."""
        p, (n, t) = self.p, units.shape
        _, _, joint, through, _, _, out = products = self.products()
        h, (x, q, a, sums, c, y, r) = self._states(units, products)
        dim, scale = len(joint), p["q"].dtype.type(1 / np.sqrt(len(joint)))
        w = weight.reshape(-1).astype(h.dtype)
        total = max(1.0, float(w.sum()))
        # probabilities are never made: what they are divided by goes to the narrow side of each product
        z = _exp(h @ out)
        whole = z @ np.ones(z.shape[1], z.dtype)
        at = np.arange(len(z)), classes.ravel()
        right = z[at]
        loss = -float(np.log(right / whole + 1e-12) @ w) / total
        z[at] = right - whole
        share = (w / (total * whole)).astype(h.dtype)[:, None]
        dh = z @ p["out"].T
        dh *= share
        g = {"out": (h[:, :dim] * share).T @ z, "b": share[:, 0] @ z, "w2": r.T @ dh}
        dr = dh @ p["w2"].T
        dr *= r > 0
        g["w1"], g["b1"] = y[:, :dim].T @ dr, np.ones(len(dr), dr.dtype) @ dr
        dy = dr @ p["w1"].T
        dy += dh
        d = c.T @ dy
        g["v"], g["o"] = d @ p["o"].T, p["v"].T @ d
        dc = dy @ _beside(through[:, :dim].T, 0)
        dc /= sums
        dc[:, dim] = -np.einsum("ij,ij->i", dc[:, :dim], c)
        dc = dc.reshape(n, t, dim + 1)
        ds = dc @ x.transpose(0, 2, 1)
        ds *= a
        dq = (ds @ x[:, :, :dim]).reshape(-1, dim)
        d = (x.reshape(-1, dim + 1)[:, :dim].T @ dq) * scale
        g["q"], g["k"] = d @ p["k"], d.T @ p["q"]
        dx = dq @ joint.T
        dx += dy
        dx = dx.reshape(n, t, dim)
        dx += ds.transpose(0, 2, 1) @ q
        dx += a.transpose(0, 2, 1) @ dc[:, :, :dim]
        g["at"] = np.zeros_like(p["at"])
        g["at"][:t] = dx.sum(0)
        # rows of one unit, brought together, are summed
        order = np.argsort(units.ravel().astype(np.uint16 if len(p["e"]) <= 1 << 16 else np.int64), kind="stable")
        ordered = units.ravel()[order]
        first = np.flatnonzero(np.diff(ordered, prepend=-1))
        g["e"] = np.zeros_like(p["e"])
        g["e"][ordered[first]] = np.add.reduceat(dx.reshape(-1, dim).take(order, 0), first)
        return loss, g

    def train(self, units: np.ndarray, classes: np.ndarray, weight: np.ndarray, epochs: int = 2, batch: int = 64, rate: float = 1e-2, seed: int = 2) -> float:
        """Adam over shuffled windows with a falling rate; returns the last epoch's mean loss."""
        adam, order, step, last = Adam(self), np.random.default_rng(seed), 0, 0.0
        steps = max(1, epochs * -(-len(units) // batch))
        for _ in range(epochs):
            losses = []
            index = order.permutation(len(units))
            for at in range(0, len(index), batch):
                i = index[at : at + batch]
                step += 1
                losses.append(adam.step(units[i], classes[i], weight[i], rate * min(1.0, step / 50) * (1 - 0.9 * step / steps)))
            last = float(np.mean(losses)) if losses else 0.0
        return last


class Adam:
    """Running means of the gradients of one model, which step() changes in place. Its weights become parts of one array, so that a step is few passes."""

    def __init__(self, model: Attention) -> None:
        self.model, self.steps = model, 0
        self.names, parts = list(model.p), [v.ravel() for v in model.p.values()]
        self.all = np.concatenate(parts)
        places = np.split(self.all, np.cumsum([len(v) for v in parts])[:-1])
        model.p = {n: place.reshape(v.shape) for (n, v), place in zip(model.p.items(), places, strict=True)}
        self.m, self.s = np.zeros_like(self.all), np.zeros_like(self.all)

    def step(self, units: np.ndarray, classes: np.ndarray, weight: np.ndarray, rate: float) -> float:
        """One step over a batch of windows; returns its loss before the step."""
        loss, g = self.model.gradients(units, classes, weight)
        self.steps += 1
        k, kind = self.steps, self.all.dtype.type
        d = np.concatenate([g[n].ravel() for n in self.names])
        self.m *= kind(0.9)
        self.m += d * kind(0.1)
        d *= d
        d *= kind(0.01)
        self.s *= kind(0.99)
        self.s += d
        # both means over what is left of them at this step, as ever
        np.sqrt(self.s, out=d)
        d *= kind(1 / np.sqrt(1 - 0.99**k))
        d += kind(1e-8)
        np.divide(self.m, d, out=d)
        d *= kind(rate / (1 - 0.9**k))
        self.all -= d
        return loss


def windows(n: int) -> list[tuple[int, int]]:
    """(first place, places that only give context) of each window over n places: every place is scored in one of them."""
    out, at = [(0, 0)], WINDOW
    while at < n:
        out.append((at - OVERLAP, OVERLAP))
        at += WINDOW - OVERLAP
    return out
