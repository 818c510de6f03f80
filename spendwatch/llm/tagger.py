"""Character tagger: a bidirectional LSTM under a linear-chain CRF, in numpy."""

from __future__ import annotations

import numpy as np

#: Character codes: ASCII as is, then other letters, digits and signs.
CODES = 131
HIDDEN = 20
CLIP = 5.0


def codes(text: str) -> np.ndarray:
    """Code of every character."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    if not len(points) or points.max() < 128:
        return points.astype(np.int64)
    return np.array([p if p < 128 else 128 if chr(p).isalpha() else 129 if chr(p).isdigit() else 130 for p in points.tolist()], np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Tagger:
    """Weights and passes. Arrays run over (step, window, ...)."""

    def __init__(self, tags: int, weights: dict[str, np.ndarray] | None = None, seed: int = 5):
        self.tags = tags
        if weights is None:
            rng = np.random.default_rng(seed)
            weights = {}
            for way in "fb":
                weights["x" + way] = rng.normal(0, 0.3, (CODES + 1, 4 * HIDDEN))  # the last code pads
                weights["h" + way] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
                weights["x" + way][:, HIDDEN : 2 * HIDDEN] += 1.0  # remember at first
            weights["out"] = rng.normal(0, 0.2, (2 * HIDDEN, tags))
            weights["bias"], weights["begin"], weights["move"] = np.zeros(tags), np.zeros(tags), np.zeros((tags, tags))
        self.w = weights

    def _run(self, ids: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        seen = self.w["x" + way][ids]
        h = c = np.zeros((ids.shape[1], HIDDEN))
        out, kept = np.zeros((*ids.shape, HIDDEN)), []
        for t in range(len(ids)) if way == "f" else range(len(ids) - 1, -1, -1):
            z = seen[t] + h @ self.w["h" + way]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before_h, before_c = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            kept.append((t, i, f, o, g, tc, before_h, before_c))
        return out, kept

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores of windows given as (step, window) codes."""
        return np.concatenate([self._run(ids, "f")[0], self._run(ids, "b")[0]], 2) @ self.w["out"] + self.w["bias"]

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """Viterbi tags of one sequence of tag scores."""
        best, back = self.w["begin"] + scores[0], np.zeros(scores.shape, np.int64)
        for t in range(1, len(scores)):
            via = best[:, None] + self.w["move"]
            back[t] = via.argmax(axis=0)
            best = via.max(axis=0) + scores[t]
        out = np.zeros(len(scores), np.int64)
        out[-1] = best.argmax()
        for t in range(len(scores) - 1, 0, -1):
            out[t - 1] = back[t, out[t]]
        return out

    def gradients(self, ids: np.ndarray, truth: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of full windows and its gradients."""
        steps, n = ids.shape
        hf, kept_f = self._run(ids, "f")
        hb, kept_b = self._run(ids, "b")
        hidden = np.concatenate([hf, hb], 2)
        score = hidden @ self.w["out"] + self.w["bias"]
        move, begin = self.w["move"], self.w["begin"]
        ahead, behind = np.zeros_like(score), np.zeros_like(score)
        ahead[0] = begin + score[0]
        for t in range(1, steps):
            ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, :, None] + move, axis=1) + score[t]
        whole = np.logaddexp.reduce(ahead[-1], axis=1)
        for t in range(steps - 2, -1, -1):
            behind[t] = np.logaddexp.reduce(move + (score[t + 1] + behind[t + 1])[:, None, :], axis=2)
        pull = np.exp(ahead + behind - whole[None, :, None])
        at, who = np.arange(steps)[:, None], np.arange(n)[None, :]
        right = score[at, who, truth].sum() + begin[truth[0]].sum() + move[truth[:-1], truth[1:]].sum()
        pull[at, who, truth] -= 1
        pull /= n
        pair = np.exp(ahead[:-1][:, :, :, None] + move + (score[1:] + behind[1:])[:, :, None, :] - whole[None, :, None, None]).sum(axis=(0, 1))
        np.subtract.at(pair, (truth[:-1].ravel(), truth[1:].ravel()), 1)
        grads = {"move": pair / n, "begin": pull[0].sum(axis=0), "bias": pull.sum(axis=(0, 1)), "out": np.tensordot(hidden, pull, ([0, 1], [0, 1]))}
        back = pull @ self.w["out"].T
        for way, kept, part in (("f", kept_f, back[:, :, :HIDDEN]), ("b", kept_b, back[:, :, HIDDEN:])):
            gx, gh = np.zeros_like(self.w["x" + way]), np.zeros_like(self.w["h" + way])
            dz = np.zeros((steps, n, 4 * HIDDEN))
            dh = dc = np.zeros((n, HIDDEN))
            for t, i, f, o, g, tc, before_h, before_c in reversed(kept):
                dh = dh + part[t]
                dc = dc + dh * o * (1 - tc * tc)
                z = dz[t]
                z[:, :HIDDEN], z[:, HIDDEN : 2 * HIDDEN] = dc * g * i * (1 - i), dc * before_c * f * (1 - f)
                z[:, 2 * HIDDEN : 3 * HIDDEN], z[:, 3 * HIDDEN :] = dh * tc * o * (1 - o), dc * i * (1 - g * g)
                gh += before_h.T @ z
                dh, dc = z @ self.w["h" + way].T, dc * f
            np.add.at(gx, ids.ravel(), dz.reshape(-1, 4 * HIDDEN))
            grads["x" + way], grads["h" + way] = gx, gh
        return float(whole.sum() - right) / n, grads

    def train(self, ids: np.ndarray, truth: np.ndarray, epochs: int, batch: int = 64, rate: float = 0.02, seed: int = 7) -> list[float]:
        """Adam on shuffled batches; returns the mean loss of each epoch."""
        rng, first, second, turn, losses = np.random.default_rng(seed), {}, {}, 0, []
        for _ in range(epochs):
            total = []
            for part in np.array_split(rng.permutation(ids.shape[1]), max(1, ids.shape[1] // batch)):
                loss, grads = self.gradients(ids[:, part], truth[:, part])
                total.append(loss)
                turn += 1
                for k, g in grads.items():
                    g = np.clip(g, -CLIP, CLIP)
                    first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                    second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
                    self.w[k] -= rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
            losses.append(float(np.mean(total)))
        return losses
