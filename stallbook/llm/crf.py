"""A conditional random field with Potts edges of two kinds: training by pseudo-likelihood, loopy message passing."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CHAIN, SKIP = 0, 1


@dataclass(frozen=True)
class Field:
    """nodes: (features, labels) weights; edges: what equal labels add on chain and on skip edges."""

    nodes: np.ndarray
    edges: np.ndarray


def fit(features: np.ndarray, neighbours: np.ndarray, labels: np.ndarray, prior: tuple[float, float], steps: int = 300) -> Field:
    """features (n, f), neighbours (n, 2, labels) counts of neighbours with each label, labels (n).

    prior: what the chain and skip weights stay near as long as the sample says little about them.
    """
    n, f = features.shape
    k = neighbours.shape[2]
    x, truth = features, np.eye(k)[labels]
    weights, edges = np.zeros((f, k)), np.array(prior, dtype=float)
    moments = [np.zeros((f, k)), np.zeros((f, k)), np.zeros(2), np.zeros(2)]
    for step in range(1, steps + 1):
        score = x @ weights + np.einsum("nek,e->nk", neighbours, edges)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        d = p / p.sum(axis=1, keepdims=True) - truth
        grads = x.T @ d / n + 1e-4 * weights, np.einsum("nek,nk->e", neighbours, d) / n + 1e-2 * (edges - prior)
        for i, (value, grad) in enumerate(zip((weights, edges), grads, strict=True)):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            value -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        np.maximum(edges, 0, out=edges)
    return Field(weights, edges)


def marginals(unary: np.ndarray, links: np.ndarray, kinds: np.ndarray, edges: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Label probabilities of nodes by loopy belief propagation over undirected links (m, 2) of the given kinds.

    Messages are passed until they stand still, or `rounds` times. In a graph of loops they need not stand still: without
    `rounds` they get twice as many as it takes to pass every link.
    """
    source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
    back = np.concatenate([np.arange(len(links)) + len(links), np.arange(len(links))])
    gain = np.expm1(edges)[np.concatenate([kinds, kinds])][:, None]
    message = np.zeros((len(source), unary.shape[1]))
    belief = unary.copy()
    if rounds is None:
        rounds = 100 + 2 * len(links)
    for _ in range(rounds if len(links) else 0):
        out = belief[source] - message[back]
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.log(out.sum(axis=1, keepdims=True) + gain * out)
        new -= new.max(axis=1, keepdims=True)
        change = np.abs(new - message).max()
        message = 0.5 * message + 0.5 * new
        belief = unary.copy()
        np.add.at(belief, target, message)
        if change < 1e-4:
            break
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)
