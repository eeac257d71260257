"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripgauge.llm import htmltraining
from tripgauge.llm.htmlblocks import blocks, features
from tripgauge.llm.runtime import carried, map_batches, steps

#: Labelled pages the model is fitted on, and passes of the fit.
PAGES, PASSES, DECAY = 900, 100, 0.02


class Crf:
    """Two labels (other, main): weights of features by label, of label pairs, and of the first label."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, pairs: np.ndarray, first: np.ndarray):
        self.index, self.weights, self.pairs, self.first = index, weights, pairs, first

    @classmethod
    def train(cls, labelled: list[tuple[list[list[str]], list[bool]]], passes: int = PASSES, decay: float = DECAY) -> Crf:
        """Maximum likelihood with a quadratic penalty, by adaptive gradient steps over all pages at once."""
        labelled = [x for x in labelled if x[1]]
        index: dict[str, int] = {}
        longest = max(len(y) for _, y in labelled)
        row, feature = [], []
        y = np.zeros((len(labelled), longest), int)
        live = np.zeros((len(labelled), longest), bool)
        for p, (found, labels) in enumerate(labelled):
            y[p, :len(labels)] = labels
            live[p, :len(labels)] = True
            for t, names in enumerate(found):
                for name in names:
                    row.append(p * longest + t)
                    feature.append(index.setdefault(name, len(index)))
        row, feature = np.array(row), np.array(feature)
        size = len(labelled) * longest
        gold = np.eye(2)[y] * live[:, :, None]
        model = cls(index, np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2))
        seen_pairs = np.einsum("pti,ptj->ij", gold[:, :-1], gold[:, 1:])
        params = [model.weights, model.pairs, model.first]
        speed = [np.full(p.shape, 1e-8) for p in params]
        for _ in range(passes):
            score = np.stack([np.bincount(row, model.weights[feature, k], size) for k in (0, 1)], 1).reshape(len(labelled), longest, 2)
            once, twice = model._expected(score, live)
            pull = (gold - once).reshape(size, 2)
            grads = [np.stack([np.bincount(feature, pull[row, k], len(index)) for k in (0, 1)], 1) - decay * model.weights,
                     seen_pairs - twice - decay * model.pairs, (gold - once)[:, 0].sum(axis=0) - decay * model.first]
            for p, s, g in zip(params, speed, grads):
                s += g * g
                p += 0.4 * g / np.sqrt(s)
        return model

    def _expected(self, score: np.ndarray, live: np.ndarray):
        """Expected labels of each block and expected label pairs, by the forward-backward recursions over all pages."""
        n, longest, _ = score.shape
        total = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = self.first + score[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.where(live[:, t, None], total(ahead[:, t - 1, :, None] + self.pairs, 1) + score[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            back[:, t] = np.where(live[:, t + 1, None], total(self.pairs + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2), 0.0)
        norm = total(ahead[:, -1], 1)
        once = np.exp(ahead + back - norm[:, None, None]) * live[:, :, None]
        joint = ahead[:, :-1, :, None] + self.pairs + (score[:, 1:] + back[:, 1:])[:, :, None, :] - norm[:, None, None, None]
        twice = (np.exp(np.minimum(joint, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
        return once, twice

    def decode(self, found: list[list[str]]) -> list[bool]:
        """The most probable labels (Viterbi). Features that the training pages lack weigh nothing."""
        if not found:
            return []
        a, b = (self.pairs[0].tolist(), self.pairs[1].tolist())
        come, best = [], self.first.tolist()
        index, weights = self.index, self._rows
        for t, names in enumerate(found):
            x = y = 0.0
            for name in names:
                k = index.get(name)
                if k is not None:
                    x += weights[k][0]
                    y += weights[k][1]
            if t:
                from0, from1 = best[0] + a[0] >= best[1] + b[0], best[0] + a[1] >= best[1] + b[1]
                come.append((0 if from0 else 1, 0 if from1 else 1))
                best = [(best[0] + a[0] if from0 else best[1] + b[0]) + x, (best[0] + a[1] if from1 else best[1] + b[1]) + y]
            else:
                best = [best[0] + x, best[1] + y]
        label = int(best[1] > best[0])
        out = [label]
        for step in reversed(come):
            label = step[label]
            out.append(label)
        return [bool(v) for v in reversed(out)]

    @functools.cached_property
    def names(self) -> frozenset[str]:
        return frozenset(self.index)

    @functools.cached_property
    def _rows(self) -> list[list[float]]:
        return self.weights.tolist()


@functools.lru_cache(maxsize=2)
def default_model(pages: int = PAGES, seed: int = 17) -> Crf:
    """Trained on the labelled pages of ``htmltraining``: ``pages`` of them bound the fit, whatever the table's size."""
    return Crf.train([(features(blocks(page)), labels) for page, labels in htmltraining.pages(pages, seed)])


def main_text(page: str, model: Crf) -> str:
    found = blocks(page, model.names)
    return "\n".join(b.text for b, keep in zip(found, model.decode(features(found))) if keep)


def extract_main_text(pages: DataFrame, html_col: str = "html", model: Crf | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds ``text``: the article's blocks in page order, joined by a newline; empty if there are none or the page is null or empty.

    The model goes to the workers with the task (a few thousand weights). Rows, ties and repeated rows stay as they are, and
    nothing is shuffled; whole pages are read. ``keep`` names the columns to carry (all by default); an input column ``text``
    is replaced. An empty table gives an empty one.
    """
    model = model or default_model()
    source = pages if keep is None else pages.select(*dict.fromkeys([*keep, html_col]))
    passed = [f for f in carried(source, {"text"}) if keep is None or f.name in keep]
    schema = T.StructType([*passed, T.StructField("text", T.StringType())])

    def run(batch):
        for part, texts in steps(batch, html_col):
            yield {f.name: part.column(part.schema.get_field_index(f.name)) for f in passed} | {"text": [main_text(t.decode(), model) for t in texts]}

    return map_batches(source, run, schema)
