"""Decision trees in numpy: grown over binned features, pruned, packed into bytes, and asked for their votes.

Rules are those of Spark's trees: a row counts as often as a Poisson draw of mean 1 says, each node looks at some features drawn
for it, a cut must gain something, and two leaves with one answer become their parent.
"""

import numpy as np

# cells of the statistics that are held at a time
CELLS = 1 << 21
# what a cut must gain, beyond rounding
LEAST_GAIN = 1e-12
LEAF = -1


def bins_of(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """(rows, features) as numbers of bins: how many cuts lie below a value; a missing number lies above all."""
    return np.stack([np.searchsorted(np.asarray(c), values[:, j], side="left").astype(np.uint8) for j, c in enumerate(cuts)], axis=1)


def cuts_of(values: np.ndarray, weights: np.ndarray, most: int) -> list[float]:
    """At most ``most - 1`` cuts between distinct values that leave about equal weight in each bin."""
    points, place = np.unique(values, return_inverse=True)
    if len(points) > most:
        share = np.cumsum(np.bincount(place, weights))
        at = np.unique(np.searchsorted(share, share[-1] * np.arange(1, most) / most))
        at = at[at < len(points) - 1]
    else:
        at = np.arange(len(points) - 1)
    # between the two, and never on the upper one
    middle = points[at] / 2 + points[at + 1] / 2
    return np.where(middle < points[at + 1], middle, points[at]).tolist()


def _sums(cell: np.ndarray, cells: int, y: np.ndarray, w: np.ndarray, classes: int) -> np.ndarray:
    """Statistics per cell: weight of each class, or weight, sum and sum of squares of a number (``classes`` 0)."""
    if classes:
        return np.bincount(cell * classes + y.astype(np.int64), w, cells * classes).reshape(cells, classes)
    return np.stack([np.bincount(cell, v, cells) for v in (w, w * y, w * y * y)], axis=1)


def _weight(stats: np.ndarray, classes: int) -> np.ndarray:
    return stats.sum(-1) if classes else stats[..., 0]


def _score(stats: np.ndarray, classes: int) -> np.ndarray:
    """What grows as a node gets purer: weight times (1 - Gini impurity), or sum of squares less weight times variance."""
    top = (stats * stats).sum(-1) if classes else stats[..., 1] ** 2
    weight = _weight(stats, classes)
    return np.divide(top, weight, out=np.zeros_like(top), where=weight > 0)


def _answers(stats: np.ndarray, classes: int) -> np.ndarray:
    """(nodes, k): the shares of the classes, or the mean."""
    top = stats if classes else stats[..., 1:2]
    weight = _weight(stats, classes)[:, None]
    return np.divide(top, weight, out=np.zeros_like(top), where=weight > 0)


def _best_cuts(bins, y, w, node, stats, tries, n_bins, classes):
    """(feature, bin, gain) of the best cut of each node; ``node`` is ascending, ``tries`` holds the features of each node."""
    nodes, places = len(stats), np.arange(len(node))
    out = np.zeros(nodes, np.int16), np.zeros(nodes, np.uint8), np.zeros(nodes)
    step = max(1, CELLS // (n_bins * stats.shape[1]))
    for low in range(0, nodes, step):
        high = min(low + step, nodes)
        begin, end = np.searchsorted(node, (low, high))
        rows, here, some, total = places[begin:end], node[begin:end] - low, np.arange(high - low), stats[low:high]
        whole, weight = _score(total, classes), _weight(total, classes)
        for slot in range(tries.shape[1]):
            feature = tries[low:high, slot]
            cell = here * n_bins + bins[rows, feature[here]]
            left = _sums(cell, (high - low) * n_bins, y[rows], w[rows], classes).reshape(high - low, n_bins, -1).cumsum(1)[:, :-1]
            right = total[:, None, :] - left
            # empty sides are told by counts of rows, as weights are subject to rounding
            n_left = np.bincount(cell, minlength=(high - low) * n_bins).reshape(high - low, n_bins).cumsum(1)
            gain = (_score(left, classes) + _score(right, classes) - whole[:, None]) / weight[:, None]
            gain[(n_left[:, :-1] == 0) | (n_left[:, :-1] == n_left[:, -1:])] = 0.0
            at = gain.argmax(1)
            best = gain[some, at]
            better = best > out[2][low:high]
            for to, new in zip(out, (feature, at, best)):
                to[low:high][better] = new[better]
    return out


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, draw: np.random.Generator, classes: int, n_bins: int, depth: int, tries: int) -> dict:
    """One tree over a sample of the rows, level by level.

    Gives the arrays of :func:`packed` and the gain that each feature brought. Nodes lie in the order of their levels and the right
    child behind the left one.
    """
    times = draw.poisson(1.0, len(y))
    while not times.any():
        times = draw.poisson(1.0, len(y))
    kept = np.flatnonzero(times)
    bins, y, w = bins[kept], y[kept], w[kept] * times[kept]
    node, n_nodes, made = np.zeros(len(kept), np.int64), 1, 0
    levels, stats_of = [], []
    while n_nodes:
        stats = _sums(node, n_nodes, y, w, classes)
        feature, cut, gain = np.full(n_nodes, LEAF, np.int16), np.zeros(n_nodes, np.uint8), np.zeros(n_nodes)
        if len(levels) < depth and n_bins > 1:
            order = np.argsort(node, kind="stable")
            bins, y, w, node = bins[order], y[order], w[order], node[order]
            drawn = draw.random((n_nodes, bins.shape[1])).argsort(1)[:, :tries]
            best, at, gain = _best_cuts(bins, y, w, node, stats, drawn, n_bins, classes)
            split = gain > LEAST_GAIN
            feature[split], cut[split] = best[split], at[split]
        split = feature != LEAF
        left = np.where(split, made + n_nodes + 2 * (np.cumsum(split) - 1), 0)
        levels.append((feature, cut, left, gain * _weight(stats, classes)))
        stats_of.append(stats)
        made += n_nodes
        rows = np.flatnonzero(split[node])
        goes_right = bins[rows, feature[node[rows]]] > cut[node[rows]]
        node = left[node[rows]] - made + goes_right
        bins, y, w, n_nodes = bins[rows], y[rows], w[rows], 2 * int(split.sum())
    feature, cut, left, gain = (np.concatenate(v) for v in zip(*levels))
    answers = _answers(np.concatenate(stats_of), classes)
    _merge_equal_leaves(feature, left, answers.argmax(1) if classes else answers[:, 0], np.cumsum([0] + [len(s) for s in stats_of]))
    brought = np.bincount(feature[feature != LEAF], gain[feature != LEAF], minlength=bins.shape[1])
    return _reached(feature, cut, left, answers) | {"brought": brought}


def _merge_equal_leaves(feature, left, answer, starts) -> None:
    """From the deepest level upwards: a node over two leaves of one answer becomes a leaf."""
    for low, high in reversed(list(zip(starts, starts[1:]))):
        inner = low + np.flatnonzero(feature[low:high] != LEAF)
        a = left[inner]
        feature[inner[(feature[a] == LEAF) & (feature[a + 1] == LEAF) & (answer[a] == answer[a + 1])]] = LEAF


def _reached(feature, cut, left, answers) -> dict:
    """Nodes that pruning left in reach, numbered anew; for a leaf ``left`` is the number of its answer."""
    alive, level = np.zeros(len(feature), bool), np.zeros(1, np.int64)
    while len(level):
        alive[level] = True
        inner = level[feature[level] != LEAF]
        level = np.concatenate((left[inner], left[inner] + 1))
    number, leaf = np.cumsum(alive) - 1, alive & (feature == LEAF)
    values, which = np.unique(answers[leaf], axis=0, return_inverse=True)
    to = number[left]
    to[leaf] = which.reshape(-1)
    return {"feature": feature[alive], "cut": cut[alive], "left": to[alive].astype(np.int32), "answers": values}


PACKED = {"feature": np.int16, "cut": np.uint8, "left": np.int32, "answers": np.float64}


def packed(tree: dict) -> dict[str, bytes]:
    return {name: np.ascontiguousarray(tree[name], kind).tobytes() for name, kind in PACKED.items()}


def unpacked(tree, width: int) -> tuple:
    feature, cut, left, answers = (np.frombuffer(tree[name], kind) for name, kind in PACKED.items())
    return feature, cut, left, answers.reshape(-1, width)


def votes(trees: list[tuple], bins: np.ndarray, width: int) -> np.ndarray:
    """Answers of the trees added up, a row of ``width`` numbers for each row of ``bins``."""
    out = np.zeros((len(bins), width))
    for feature, cut, left, answers in trees:
        node, rows = np.zeros(len(bins), np.int32), np.arange(len(bins))
        while len(rows):
            here = node[rows]
            inner = feature[here] != LEAF
            rows, here = rows[inner], here[inner]
            node[rows] = left[here] + (bins[rows, feature[here]] > cut[here])
        out += answers[left[node]]
    return out
