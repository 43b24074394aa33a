"""A bidirectional gated recurrent network that labels every byte of a sequence, in numpy.

One layer in each direction over byte embeddings; both states at a byte give its label scores. All sequences of a
batch advance together; shorter ones stand still where they have ended.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_NAMES = ("wf", "uf", "wb", "ub", "out", "bias")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


@dataclass
class ByteGru:
    """wf, wb: for each byte its share of (update, reset, candidate); uf, ub: (candidate | update, reset) of the state."""

    wf: np.ndarray
    uf: np.ndarray
    wb: np.ndarray
    ub: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, width: int, labels: int, seed: int) -> ByteGru:
        rng = np.random.default_rng(seed)

        def drawn(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(width)).astype(np.float32)

        return cls(
            drawn(256, 3 * width), drawn(width, 3 * width), drawn(256, 3 * width), drawn(width, 3 * width),
            drawn(2 * width, labels), np.zeros(labels, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, n) for n in _NAMES]

    @property
    def width(self) -> int:
        return len(self.uf)

    def _run(self, w: np.ndarray, u: np.ndarray, data: np.ndarray, live: np.ndarray, keep: bool):
        """States after each step (steps, batch, width); data is (steps, batch), live tells which have a byte there."""
        steps, batch = data.shape
        width = self.width
        h = np.zeros((batch, width), np.float32)
        states, trace = np.empty((steps, batch, width), np.float32), []
        for t in range(steps):
            x = w[data[t]]
            gates = _sigmoid(x[:, : 2 * width] + h @ u[:, : 2 * width])
            z, r = gates[:, :width], gates[:, width:]
            c = np.tanh(x[:, 2 * width :] + (r * h) @ u[:, 2 * width :])
            new = h + z * (c - h)
            if not live[t].all():
                new = np.where(live[t][:, None], new, h)
            if keep:
                trace.append((h, z, r, c))
            states[t] = h = new
        return states, trace

    def _back(self, u: np.ndarray, data, live, trace, upstream):
        """Backpropagation through time: gradients of w and u from those of the states."""
        width = self.width
        gw, gu = np.zeros((256, 3 * width), np.float32), np.zeros_like(u)
        dh = np.zeros_like(upstream[0])
        for t in range(len(data) - 1, -1, -1):
            h, z, r, c = trace[t]
            on = live[t][:, None]
            total = dh + upstream[t]
            d = total * on
            dc = d * z * (1 - c * c)
            dz = d * (c - h) * z * (1 - z)
            drh = dc @ u[:, 2 * width :].T
            dr = drh * h * r * (1 - r)
            dgates = np.concatenate([dz, dr], axis=1)
            gu[:, : 2 * width] += h.T @ dgates
            gu[:, 2 * width :] += (r * h).T @ dc
            np.add.at(gw, data[t], np.concatenate([dgates, dc], axis=1))
            dh = d * (1 - z) + drh * r + dgates @ u[:, : 2 * width].T + total * ~on
        return gw, gu

    def scores(self, data: np.ndarray, live: np.ndarray, keep: bool = False):
        """Label scores of each byte (steps, batch, labels)."""
        forward, tf = self._run(self.wf, self.uf, data, live, keep)
        backward, tb = self._run(self.wb, self.ub, data[::-1], live[::-1], keep)
        both = np.concatenate([forward, backward[::-1]], axis=2)
        return both @ self.out + self.bias, both, tf, tb

    def _read(self, w: np.ndarray, u: np.ndarray, data: np.ndarray, live: np.ndarray, states: np.ndarray) -> None:
        """The states of `_run` without a trace, into (width, steps, batch): a unit's values lie side by side."""
        width = self.width
        gates, batch = 2 * width, data.shape[1]
        # a half of the gates' input goes into the weights: exact, and the sigmoid is a tangent of it
        half = np.where(np.arange(3 * width) < gates, np.float32(0.5), np.float32(1))
        w, u = np.ascontiguousarray((w * half).T), np.ascontiguousarray((u * half).T)
        x, g = np.empty((3 * width, batch), np.float32), np.empty((gates, batch), np.float32)
        h, whole = np.zeros((width, batch), np.float32), live.all(axis=1)
        for t in range(len(data)):
            np.take(w, data[t], axis=1, out=x, mode="clip")
            np.matmul(u[:gates], h, out=g)
            g += x[:gates]
            np.tanh(g, out=g)
            g *= np.float32(0.5)
            g += np.float32(0.5)
            z, r = g[:width], g[width:]
            r *= h
            new = u[gates:] @ r
            new += x[gates:]
            np.tanh(new, out=new)
            new -= h
            new *= z
            new += h
            if not whole[t]:
                new = np.where(live[t], new, h)
            states[:, t] = h = new

    def distributions(self, data: np.ndarray, live: np.ndarray) -> np.ndarray:
        """Label probabilities of each byte (labels, steps, batch): the softmax of `scores`."""
        states = np.empty((2 * self.width, *data.shape), np.float32)
        self._read(self.wf, self.uf, data, live, states[: self.width])
        self._read(self.wb, self.ub, data[::-1], live[::-1], states[self.width :, ::-1])
        score = self.out.T @ states.reshape(2 * self.width, -1)
        score += self.bias[:, None]
        score -= score.max(axis=0)
        np.exp(score, out=score)
        score /= score.sum(axis=0)
        return score.reshape(-1, *data.shape)

    def gradients(self, data: np.ndarray, live: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all bytes and its gradients; the labels are those of sequences or of bytes."""
        score, both, tf, tb = self.scores(data, live, keep=True)
        p = _softmax(score)
        count = live.sum()
        place = (*np.indices(data.shape), np.broadcast_to(label, data.shape))
        at = p[place]
        loss = -(np.log(np.maximum(at, 1e-9)) * live).sum() / count
        d = p
        d[place] -= 1
        d *= live[:, :, None] / count
        width = self.width
        gout = np.einsum("tbw,tbl->wl", both, d, optimize=True)
        dstates = d @ self.out.T
        gwf, guf = self._back(self.uf, data, live, tf, dstates[:, :, :width])
        gwb, gub = self._back(self.ub, data[::-1], live[::-1], tb, dstates[::-1, :, width:])
        return float(loss), [gwf, guf, gwb, gub, gout.astype(np.float32), d.sum(axis=(0, 1)).astype(np.float32)]


def padded(sequences: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, batch) bytes, and which of them are real."""
    lengths = np.array([len(s) for s in sequences])
    steps = int(lengths.max())
    data = np.frombuffer(b"".join(s.ljust(steps, b"\0") for s in sequences), np.uint8).reshape(len(sequences), steps)
    return np.ascontiguousarray(data.T), np.arange(steps)[:, None] < lengths[None, :]


def train(
    sequences: list[bytes], labels: list[np.ndarray], count: int, width: int, rounds: int, batch: int, seed: int
) -> ByteGru:
    """Adam over shuffled batches, with a label for each byte; the same input gives the same network."""
    net, rng = ByteGru.fresh(width, count, seed), np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    step, total = 0, max(1, rounds * (-(-len(sequences) // batch)))
    for _ in range(rounds):
        order = rng.permutation(len(sequences))
        for low in range(0, len(order), batch):
            chosen = order[low : low + batch]
            data, live = padded([sequences[i] for i in chosen])
            label = np.zeros(data.shape, np.int64)
            for column, i in enumerate(chosen):
                label[: len(labels[i]), column] = labels[i]
            _, grads = net.gradients(data, live, label)
            step += 1
            rate = 0.02 * (1 - 0.9 * step / total)
            for p, g, m, v in zip(net.parts(), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net
