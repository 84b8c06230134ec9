"""A conditional random field over the tokens of documents, with links between neighbours and between similar tokens.

Each token has a label. Features of a token score its labels, one matrix scores the labels of neighbours, and a
skip link between two distant tokens that are equal or alike scores whether their entity kinds agree. The links
make loops, so marginals come from loopy belief propagation: all messages are renewed together, with damping, for
a fixed number of rounds. Weights are learnt by following the difference between observed and expected counts.
Many documents are inferred at once as one graph without links between them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS, DAMPING = 12, 0.3
STEPS, RATE, DECAY = 120, 0.1, 2e-3


@dataclass
class Graph:
    """Tokens of some documents: features as numbers, and links."""

    features: np.ndarray  # of all tokens, one after another
    sizes: np.ndarray  # how many each token has, at least one
    chain: np.ndarray  # pairs of neighbours, two rows
    skip: np.ndarray  # pairs of distant tokens, two rows

    def __len__(self) -> int:
        return len(self.sizes)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes


def logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class SkipChain:
    """Weights; ``kinds`` gives the entity kind of each label, 0 for none."""

    kinds: np.ndarray
    unary: np.ndarray  # features by labels
    near: np.ndarray  # labels by labels
    alike: np.ndarray  # weight of agreement for each kind

    @classmethod
    def empty(cls, kinds: list[int], features: int) -> "SkipChain":
        n = len(kinds)
        return cls(np.array(kinds), np.zeros((features, n)), np.zeros((n, n)), np.zeros(max(kinds) + 1))

    def far(self) -> np.ndarray:
        """Label by label scores of a skip link."""
        same = self.kinds[:, None] == self.kinds[None, :]
        return np.where(same, self.alike[self.kinds][:, None], 0.0)

    def scores(self, graph: Graph) -> np.ndarray:
        return np.add.reduceat(self.unary[graph.features], graph.starts, axis=0)

    def infer(self, graph: Graph, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of tokens, and summed marginals of label pairs over neighbours and over skip links."""
        n, labels = len(graph), len(self.kinds)
        own = self.scores(graph)
        far, chains = self.far(), graph.chain.shape[1]
        source = np.concatenate([graph.chain[0], graph.skip[0], graph.chain[1], graph.skip[1]])
        target = np.concatenate([graph.chain[1], graph.skip[1], graph.chain[0], graph.skip[0]])
        links = len(source) // 2
        backwards = np.concatenate([np.arange(links, 2 * links), np.arange(links)])
        kinds = ((slice(0, chains), self.near), (slice(chains, links), far), (slice(links, links + chains), self.near.T), (slice(links + chains, 2 * links), far))
        messages = np.zeros((2 * links, labels))
        for _ in range(rounds if links else 0):
            belief = self.gathered(own, target, messages)
            given = belief[source] - messages[backwards]
            new = np.empty_like(messages)
            for part, scores in kinds:
                if part.stop > part.start:
                    new[part] = logsumexp(given[part][:, :, None] + scores[None], axis=1)
            new -= new.max(axis=1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * new
        belief = self.gathered(own, target, messages)
        marginal = np.exp(belief - logsumexp(belief, 1)[:, None])
        pairs = []
        for part, scores in kinds[:2]:
            if part.stop == part.start:
                pairs.append(np.zeros((labels, labels)))
                continue
            a, b = source[part], target[part]
            joint = (belief[a] - messages[backwards[part]])[:, :, None] + (belief[b] - messages[part])[:, None, :] + scores[None]
            joint -= joint.max(axis=(1, 2), keepdims=True)
            weight = np.exp(joint)
            pairs.append((weight / weight.sum(axis=(1, 2), keepdims=True)).sum(axis=0))
        return marginal, pairs[0], pairs[1]

    @staticmethod
    def gathered(own: np.ndarray, target: np.ndarray, messages: np.ndarray) -> np.ndarray:
        belief = own.copy()
        for label in range(own.shape[1] if len(target) else 0):
            belief[:, label] += np.bincount(target, messages[:, label], minlength=len(own))
        return belief

    def fit(self, graph: Graph, truth: np.ndarray, steps: int = STEPS) -> None:
        """Learn from observed labels, by Adam on the penalised likelihood with marginals of belief propagation."""
        labels = len(self.kinds)
        seen = np.zeros((len(graph), labels))
        seen[np.arange(len(graph)), truth] = 1
        near = np.zeros((labels, labels))
        np.add.at(near, (truth[graph.chain[0]], truth[graph.chain[1]]), 1)
        agree = np.zeros((labels, labels))
        np.add.at(agree, (truth[graph.skip[0]], truth[graph.skip[1]]), 1)
        token = np.repeat(np.arange(len(graph)), graph.sizes)
        weights = [self.unary, self.near, self.alike]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, steps + 1):
            marginal, near_now, far_now = self.infer(graph)
            off = (seen - marginal)[token]
            unary = np.column_stack([np.bincount(graph.features, off[:, label], minlength=len(self.unary)) for label in range(labels)])
            same = (self.kinds[:, None] == self.kinds[None, :]) * (agree - far_now)
            alike = np.bincount(self.kinds, same.sum(axis=1), minlength=len(self.alike))
            for i, gradient in enumerate((unary, near - near_now, alike)):
                gradient = gradient / len(graph) - DECAY * weights[i] / max(1, len(graph)) ** 0.5
                first[i] = 0.9 * first[i] + 0.1 * gradient
                second[i] = 0.99 * second[i] + 0.01 * gradient**2
                weights[i] += RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
