"""A small causal self-attention model over subword classes, in NumPy.

Inputs are classes of subword ids: frequent ids have one of their own, the others are dealt to
``SHARED`` classes by a hash, so that any id tells a context apart. A window has ``2 * STRIDE`` inputs; its later half are the queries, so windows that overlap by
half score each token once with ``STRIDE`` to ``2 * STRIDE - 1`` tokens before it. The output is
a two-level softmax: a cluster of classes, then the class within it.
"""

from __future__ import annotations

import numpy as np

STRIDE = 16
SPAN = 2 * STRIDE
WIDTH, HEADS, INNER = 32, 2, 32
PER_HEAD = WIDTH // HEADS
#: Clusters of so many classes each.
CLUSTERS, MEMBERS = 32, 32
CLASSES = CLUSTERS * MEMBERS
#: Windows that are scored side by side.
WINDOWS = 128
#: Classes with a meaning of their own: the end (and start) of a text, and no token. The last
#: ``SHARED`` classes are those of rare ids.
END, NONE, SHARED = 0, CLASSES, 256

NAMES = ("embed", "query", "key", "value", "near", "mix", "wide", "wide_b", "narrow", "group", "group_b", "member", "member_b")
Weights = dict[str, np.ndarray]

_ROW, _COL = np.arange(STRIDE)[:, None], np.arange(SPAN)
_DISTANCE = STRIDE + _ROW - _COL
_CAUSAL = _DISTANCE >= 0
_FAR = np.maximum(_DISTANCE, 0)


def start(counts: np.ndarray, seed: int = 3) -> Weights:
    """Weights whose output is the frequency of the classes (``counts``), whatever the input."""
    rng = np.random.default_rng(seed)

    def near_zero(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    share = (counts.astype(np.float64) + 0.5).reshape(CLUSTERS, MEMBERS)
    per_group = share.sum(axis=1)
    return {
        "embed": near_zero(CLASSES + 1, WIDTH, scale=0.5),
        "query": near_zero(WIDTH, WIDTH, scale=WIDTH**-0.5),
        "key": near_zero(WIDTH, WIDTH, scale=WIDTH**-0.5),
        "value": near_zero(WIDTH, WIDTH, scale=WIDTH**-0.5),
        "near": np.stack([np.zeros(SPAN), -0.7 * np.arange(SPAN)])[:HEADS].astype(np.float32),
        "mix": near_zero(WIDTH, WIDTH, scale=WIDTH**-0.5),
        "wide": near_zero(WIDTH, INNER, scale=WIDTH**-0.5),
        "wide_b": np.zeros(INNER, np.float32),
        "narrow": near_zero(INNER, WIDTH, scale=INNER**-0.5),
        "group": near_zero(WIDTH, CLUSTERS, scale=0.02),
        "group_b": np.log(per_group / per_group.sum()).astype(np.float32),
        "member": near_zero(CLUSTERS, WIDTH, MEMBERS, scale=0.02),
        "member_b": np.log(share / per_group[:, None]).astype(np.float32),
    }


#: Scores are cut off here instead of being set off by their maximum: far beyond what training
#: reaches, and within what an exponential of 32 bits holds.
_TOP = np.float32(60)


#: Rows that are multiplied together.
TILE = 128


def _times(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``h @ weight`` in tiles of one shape, so that a row's rounding doesn't depend on how many
    rows there are and where it stands: equal texts have equal scores."""
    n = len(h)
    tiles = -(-n // TILE)
    if tiles * TILE != n:
        h = np.concatenate([h, np.zeros((tiles * TILE - n, h.shape[1]), h.dtype)])
    return np.matmul(h.reshape(tiles, TILE, -1), weight).reshape(tiles * TILE, -1)[:n]


def _log_softmax_at(h: np.ndarray, weight: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
    s = _times(h, weight)
    s += bias
    if s.max() > _TOP:
        np.minimum(s, _TOP, out=s)
    picked = s[np.arange(len(s)), at]
    np.exp(s, out=s)
    return picked - np.log(np.einsum("ij->i", s))


def _bias(p: Weights) -> np.ndarray:
    """By distance, none for what comes later; the places attended to first."""
    return np.where(_CAUSAL, p["near"][:, _FAR], -1e9).astype(p["near"].dtype).transpose(2, 0, 1).reshape(SPAN, HEADS * STRIDE)


#: Rows and columns of each head where all heads of a window share one product.
_PARTS = [(slice(h * STRIDE, (h + 1) * STRIDE), slice(h * PER_HEAD, (h + 1) * PER_HEAD)) for h in range(HEADS)]


def _apart(x: np.ndarray) -> np.ndarray:
    """(windows, STRIDE, WIDTH) with a row for each head, which is zero in the columns of others."""
    out = np.zeros((len(x), HEADS * STRIDE, WIDTH), x.dtype)
    for rows, columns in _PARTS:
        out[:, rows, columns] = x[:, :, columns]
    return out


def _apart_turned(x: np.ndarray) -> np.ndarray:
    """``_apart`` with rows and columns exchanged: products with a turned factor are slow."""
    out = np.zeros((len(x), WIDTH, HEADS * STRIDE), x.dtype)
    for rows, columns in _PARTS:
        out[:, columns, rows] = x[:, :, columns].transpose(0, 2, 1)
    return out


def _together(x: np.ndarray) -> np.ndarray:
    """(windows * STRIDE, WIDTH) from a row for each head, whose columns of others are dropped."""
    out = np.empty((len(x), STRIDE, WIDTH), x.dtype)
    for rows, columns in _PARTS:
        out[:, :, columns] = x[:, rows, columns]
    return out.reshape(-1, WIDTH)


class Scorer:
    """Scores streams of texts. Each text is led by a block of ``STRIDE`` times ``NONE`` and ends
    at a full block; every block is the later half of a window over it and the block before."""

    def __init__(self, p: Weights):
        self.p, self.bias = p, _bias(p)
        self.queries = (p["embed"] @ p["query"] * np.float32(PER_HEAD**-0.5)).astype(np.float32)
        self.keys = (p["embed"] @ p["key"]).astype(np.float32)
        # the last column sums the weights; an absent token has none
        self.values = np.concatenate([p["embed"] @ p["value"], np.ones((CLASSES + 1, 1))], axis=1).astype(np.float32)
        self.values[NONE] = 0
        reach = np.linalg.norm(self.queries, axis=1).max() * np.linalg.norm(self.keys, axis=1).max()
        self.bounded = reach + np.abs(p["near"]).max() < _TOP

    def _attend(self, stream: np.ndarray) -> np.ndarray:
        def windows(x: np.ndarray) -> np.ndarray:
            row = x.strides[0]
            return np.lib.stride_tricks.as_strided(x, (len(x) // STRIDE - 1, SPAN, x.shape[1]), (STRIDE * row, row, x.strides[1]))

        q = self.queries.take(stream[STRIDE:], axis=0).reshape(-1, STRIDE, WIDTH)
        a = np.matmul(windows(self.keys.take(stream, axis=0)), _apart_turned(q))
        a += self.bias
        if not self.bounded:
            np.clip(a, -_TOP, _TOP, out=a)
        np.exp(a, out=a)
        if not self.bounded:
            a *= self.bias > -1e8
        o = np.matmul(a.transpose(0, 2, 1), windows(self.values.take(stream, axis=0)))
        total = np.maximum(o[:, :, WIDTH:], np.float32(1e-30))
        out = np.empty((len(o), STRIDE, WIDTH), o.dtype)
        for rows, columns in _PARTS:
            np.divide(o[:, rows, columns], total[:, rows], out=out[:, :, columns])
        return out.reshape(-1, WIDTH)

    def _hidden(self, stream: np.ndarray) -> np.ndarray:
        p = self.p
        h = p["embed"].take(stream[STRIDE:], axis=0)
        h += _times(self._attend(stream), p["mix"])
        inner = _times(h, p["wide"])
        inner += p["wide_b"]
        np.maximum(inner, 0, out=inner)
        h += _times(inner, p["narrow"])
        return h

    def log_probabilities(self, stream: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithms of ``target``, one for every input of ``stream`` after its first block."""
        p, step = self.p, WINDOWS * STRIDE
        parts = [self._hidden(stream[at : at + step + STRIDE]) for at in range(0, len(target), step)]
        h = np.concatenate(parts)
        cluster = target // MEMBERS
        order = np.argsort(cluster.astype(np.uint8), kind="stable")
        h, target, cluster = h[order], target[order], cluster[order]
        found = _log_softmax_at(h, p["group"], p["group_b"], cluster)
        bounds = np.searchsorted(cluster, np.arange(CLUSTERS + 1))
        for g in range(CLUSTERS):
            rows = slice(bounds[g], bounds[g + 1])
            if rows.start < rows.stop:
                found[rows] += _log_softmax_at(h[rows], p["member"][g], p["member_b"][g], target[rows] % MEMBERS)
        out = np.empty_like(found)
        out[order] = found
        return out


def _runs(cluster: np.ndarray, size: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order by cluster, and the places in it of each cluster that occurs."""
    order = np.argsort(cluster.astype(np.uint8), kind="stable")
    ends = np.cumsum(np.bincount(cluster, minlength=size)).tolist()
    return order, [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _sums(places: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sum of the rows of each place."""
    order = np.argsort(places.astype(np.int16), kind="stable")
    places = places[order]
    heads = np.flatnonzero(np.diff(places, prepend=-1))
    out = np.zeros((size, rows.shape[1]), rows.dtype)
    if len(heads):
        out[places[heads]] = np.add.reduceat(rows.take(order, axis=0), heads, axis=0)
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` of long columns, in tiles, which is faster."""
    n = len(a) - len(a) % TILE
    whole = np.matmul(a[:n].reshape(-1, TILE, a.shape[1]).transpose(0, 2, 1), b[:n].reshape(-1, TILE, b.shape[1])).sum(axis=0)
    return whole + a[n:].T @ b[n:] if n < len(a) else whole


def _softmax(s: np.ndarray) -> None:
    """In place. Rows are set off by their maximum only if some score needs it."""
    if not (s.max() < _TOP and s.min() > -_TOP):
        s -= s.max(axis=1, keepdims=True)
    np.exp(s, out=s)
    s /= (s @ np.ones(s.shape[1], s.dtype))[:, None]


def gradients(p: Weights, inputs: np.ndarray, targets: np.ndarray, mask: np.ndarray) -> tuple[float, Weights]:
    """Mean negative log probability of the targets under the mask, and its gradients.

    Queries, keys and values are those of classes, made once. Attention weights lie as (windows,
    SPAN, HEADS * STRIDE), the places attended to first."""
    n, embed, kind = len(inputs), p["embed"], p["embed"].dtype
    scale, ones = kind.type(PER_HEAD**-0.5), np.ones(n * STRIDE, kind)
    turned = {name: np.ascontiguousarray(p[name].T) for name in ("query", "key", "value", "mix", "wide", "narrow", "group")}
    places, late = inputs.ravel(), inputs[:, STRIDE:].ravel()
    queries, keys, values = _times(embed, p["query"] * scale), _times(embed, p["key"]), _times(embed, p["value"])
    q = queries.take(late, axis=0).reshape(n, STRIDE, WIDTH)
    k, v = (x.take(places, axis=0).reshape(n, SPAN, WIDTH) for x in (keys, values))
    a = np.matmul(k, _apart_turned(q))
    a += _bias(p)
    absent = inputs == NONE
    led = np.flatnonzero(absent.any(axis=1))
    a[led] += np.where(absent[led], kind.type(-1e9), kind.type(0))[:, :, None]
    reach = np.sqrt(np.einsum("ij,ij->i", queries, queries).max() * np.einsum("ij,ij->i", keys, keys).max())
    if not reach + np.abs(p["near"]).max() < _TOP:
        a -= a.max(axis=1, keepdims=True)
    np.exp(a, out=a)
    a /= np.maximum(np.matmul(np.ones((1, SPAN), kind), a), kind.type(1e-30))
    mixed = _together(np.matmul(a.transpose(0, 2, 1), v))
    el = embed.take(late, axis=0)
    h1 = _times(mixed, p["mix"])
    h1 += el
    inner = _times(h1, p["wide"])
    inner += p["wide_b"]
    np.maximum(inner, 0, out=inner)
    h2 = _times(inner, p["narrow"])
    h2 += h1

    # from here to the gradient of h2 in the order of clusters
    target, weight = targets.ravel(), (mask / max(1, mask.sum())).ravel().astype(kind)
    order, runs = _runs(target // MEMBERS, CLUSTERS)
    target, weight, h2 = target[order], weight[order], h2.take(order, axis=0)
    cluster, member = target // MEMBERS, target % MEMBERS
    rows = np.arange(len(target))
    g = _times(h2, p["group"])
    g += p["group_b"]
    _softmax(g)
    m = np.empty_like(g)
    for c, at in runs:
        np.matmul(h2[at], p["member"][c], out=m[at])
    m += p["member_b"].take(cluster, axis=0)
    _softmax(m)
    loss = -((np.log(g[rows, cluster] + 1e-30) + np.log(m[rows, member] + 1e-30)) * weight).sum()
    g[rows, cluster] -= 1
    g *= weight[:, None]
    m[rows, member] -= 1
    m *= weight[:, None]
    d: Weights = {"group": _product(h2, g), "group_b": ones @ g}
    d_h2 = _times(g, turned["group"])
    d["member"], d["member_b"] = np.zeros_like(p["member"]), np.zeros_like(p["member_b"])
    members, d_members = np.ascontiguousarray(p["member"].transpose(0, 2, 1)), np.empty_like(h2)
    for c, at in runs:
        np.matmul(h2[at].T, m[at], out=d["member"][c])
        np.matmul(ones[: at.stop - at.start], m[at], out=d["member_b"][c])
        np.matmul(m[at], members[c], out=d_members[at])
    d_h2 += d_members
    d_h = np.empty_like(d_h2)
    d_h[order] = d_h2

    d["narrow"] = _product(inner, d_h)
    d_inner = _times(d_h, turned["narrow"])
    d_inner *= inner > 0
    d["wide"], d["wide_b"] = _product(h1, d_inner), ones @ d_inner
    d_h += _times(d_inner, turned["wide"])
    d["mix"] = _product(mixed, d_h)
    d_mixed = _times(d_h, turned["mix"])
    per_head = np.repeat(np.eye(HEADS, dtype=kind), PER_HEAD, axis=0)
    back = ((d_mixed * mixed) @ per_head).reshape(n, STRIDE, HEADS).transpose(0, 2, 1).reshape(n, 1, -1)
    d_mixed = d_mixed.reshape(n, STRIDE, WIDTH)
    d_v = np.matmul(a, _apart(d_mixed))
    d_s = np.matmul(v, _apart_turned(d_mixed))
    d_s -= back
    d_s *= a
    by_place = (ones[:n] @ d_s.reshape(n, -1)).reshape(SPAN, HEADS, STRIDE)
    d["near"] = np.stack([np.bincount(_FAR.ravel(), by_place[:, head].T.ravel(), SPAN) for head in range(HEADS)]).astype(kind)
    d_q, d_k = _together(np.matmul(d_s.transpose(0, 2, 1), k)), np.matmul(d_s, _apart(q))

    d_k, d_v = d_k.reshape(-1, WIDTH), d_v.reshape(-1, WIDTH)
    d_q *= scale
    e = embed.take(places, axis=0)
    d["query"], d["key"], d["value"] = _product(el, d_q), _product(e, d_k), _product(e, d_v)
    d_h += _times(d_q, turned["query"])
    d_e = _times(d_k, turned["key"])
    d_e += _times(d_v, turned["value"])
    d_e.reshape(n, SPAN, WIDTH)[:, STRIDE:] += d_h.reshape(n, STRIDE, WIDTH)
    d["embed"] = _sums(places, d_e, len(embed))
    return float(loss), d


class Adam:
    """Steps on all weights as one vector; ``p`` gets views of it."""

    def __init__(self, p: Weights, rate: float = 0.003):
        self.rate, self.step, self.names = rate, 0, list(p)
        self.flat = np.concatenate([p[name].ravel() for name in self.names])
        self.first, self.second, self.grad, self.room = (np.zeros_like(self.flat) for _ in range(4))
        at = 0
        for name in self.names:
            shape, size = p[name].shape, p[name].size
            p[name] = self.flat[at : at + size].reshape(shape)
            at += size

    def update(self, grads: Weights, factor: float = 1.0) -> None:
        self.step += 1
        grad, room = self.grad, self.room
        np.concatenate([grads[name].ravel() for name in self.names], out=grad)
        grad *= min(1.0, 1.0 / (float(np.sqrt(grad @ grad)) + 1e-9))
        correct = np.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step)
        for mean, part in ((self.first, 0.1), (self.second, 0.01)):
            np.subtract(grad, mean, out=room)
            room *= part
            mean += room
            grad *= grad
        np.sqrt(self.second, out=room)
        room += 1e-7
        np.divide(self.first, room, out=room)
        room *= float(self.rate * factor * correct)
        self.flat -= room
