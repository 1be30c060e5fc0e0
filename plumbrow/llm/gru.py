"""A gated recurrent unit over word classes, in numpy: training by truncated backpropagation, scoring.

The net reads input rows (a word's own, or its class's) and predicts the next word in two steps: its
class by a softmax over all classes, then its member number within the class by a softmax over that
class's members alone. The last member of each class stands for all its other words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Steps of the longest window in training.
_LONGEST = 512
#: Rows of a softmax at once in scoring, few enough to stay in a core's cache.
_ROWS = 2048

NAMES = ("embedding", "w", "u", "b", "class_out", "member_out")


@dataclass(frozen=True)
class Shape:
    words: int  # modelled words
    sizes: tuple[int, ...]  # members of each class, the one for other words included
    dim: int = 16
    hidden: int = 24

    @property
    def classes(self) -> int:
        return len(self.sizes)

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)))


class Net:
    """Parameters, as one flat vector with named views.

    Output biases lie beside their weights (class_out, member_out), for states with a one at the end.
    """

    def __init__(self, shape: Shape, flat: np.ndarray | None = None):
        self.shape = shape
        h, d, c = shape.hidden, shape.dim, shape.classes
        members = int(sum(shape.sizes))
        dims = ((shape.words + c + 1, d), (d, 3 * h), (h, 3 * h), (3 * h,), (h + 1, c), (members, h + 1))
        total = sum(int(np.prod(x)) for x in dims)
        self.flat = np.zeros(total, np.float32) if flat is None else flat
        at = 0
        for name, dim in zip(NAMES, dims):
            n = int(np.prod(dim))
            setattr(self, name, self.flat[at : at + n].reshape(dim))
            at += n
        self.class_w, self.class_b = self.class_out[:h], self.class_out[h]
        self.member_w, self.member_b = self.member_out[:, :h], self.member_out[:, h]
        offsets = shape.offsets.tolist()
        self.blocks = [self.member_out[a:b] for a, b in zip(offsets, offsets[1:])]  # by class

    @staticmethod
    def started(shape: Shape, class_mass: np.ndarray, member_mass: np.ndarray, seed: int) -> Net:
        """Random but for the output biases, which start as the log of the counts."""
        net = Net(shape)
        rng = np.random.default_rng(seed)
        net.embedding[:] = rng.normal(0, 0.3, net.embedding.shape)
        net.w[:] = rng.normal(0, 1 / shape.dim**0.5, net.w.shape)
        net.u[:] = rng.normal(0, 0.7 / shape.hidden**0.5, net.u.shape)
        net.b[: shape.hidden] = 1.0  # remember at first
        net.class_w[:] = rng.normal(0, 0.02, net.class_w.shape)
        net.member_w[:] = rng.normal(0, 0.02, net.member_w.shape)
        net.class_b[:] = np.log(class_mass)
        net.member_b[:] = np.log(member_mass)
        return net


def _by_gate(net: Net, w: np.ndarray) -> np.ndarray:
    """(rows, 3 * hidden) as (3, rows, hidden); of the two sigmoids' arguments the negative."""
    parts = w.reshape(len(w), 3, net.shape.hidden).transpose(1, 0, 2).copy()
    np.negative(parts[:2], out=parts[:2])
    return parts


def forward(
    net: Net,
    inputs: np.ndarray,
    fresh: np.ndarray,
    state: np.ndarray,
    keep: bool = False,
    table: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """States after each step of a window (steps, lanes, hidden), the last state, and what to keep.

    inputs and fresh: (steps, lanes); a fresh step begins with an empty state. table: `input_table`,
    where nothing is kept. Kept: the gates (3, steps, lanes, hidden) and what the state adds to the third before its gate.
    """
    h = net.shape.hidden
    steps, lanes = inputs.shape
    if table is None:
        x = net.embedding.take(inputs.ravel(), axis=0) @ _by_gate(net, net.w)
        x += _by_gate(net, net.b[None])
        x = x.reshape(3, steps, lanes, h)
    u = _by_gate(net, net.u)
    u_gates, u_new = u[:2], u[2]
    out = np.empty((steps, lanes, h), np.float32)
    added = np.empty((steps if keep else 1, lanes, h), np.float32)
    a, work = np.empty((2, lanes, h), np.float32), np.empty((lanes, h), np.float32)
    any_fresh = fresh.any(axis=1).tolist()
    for t in range(steps):
        if any_fresh[t]:
            state = state * ~fresh[t][:, None]
        of_step = x[:, t] if table is None else table.take(inputs[t], axis=1)
        gates, n, new, from_state = of_step[:2], of_step[2], out[t], added[t if keep else 0]
        np.matmul(state, u_gates, out=a)
        np.matmul(state, u_new, out=from_state)
        gates += a
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[1], from_state, out=work)
        n += work
        np.tanh(n, out=n)
        np.subtract(state, n, out=new)
        new *= gates[0]
        new += n
        state = new
    return out, state, (x, added) if keep else None


def input_table(net: Net) -> np.ndarray:
    """What each input row adds to the gates."""
    return net.embedding @ _by_gate(net, net.w) + _by_gate(net, net.b[None])


def _with_one(states: np.ndarray) -> np.ndarray:
    out = np.ones((len(states), states.shape[1] + 1), np.float32)
    out[:, :-1] = states
    return out


def _small(out: np.ndarray, axis: int) -> bool:
    """Whether no logit can overflow; states lie between -1 and 1."""
    size, ones = np.abs(out), np.ones(out.shape[axis], np.float32)
    return float((ones @ size if axis == 0 else size @ ones).max()) < 60


def _by_class(classes: np.ndarray, n: int) -> tuple[np.ndarray, list[int]]:
    """The order of the tokens by class, and the first of each class."""
    order = np.argsort(classes.astype(np.int16), kind="stable")
    return order, [0, *np.cumsum(np.bincount(classes, minlength=n)).tolist()]


def log_probabilities(
    net: Net, states: np.ndarray, classes: np.ndarray, members: np.ndarray
) -> np.ndarray:
    """Natural log of P(class) * P(member | class) for each state (rows)."""
    n, c_all = len(states), net.shape.classes
    states = _with_one(states)
    chosen, sums = np.empty(n, np.float32), np.empty(n, np.float32)
    small = _small(net.class_out, 0)
    ones = np.ones(max(c_all, *net.shape.sizes), np.float32)
    for a in range(0, n, _ROWS):
        logits = states[a : a + _ROWS] @ net.class_out
        if not small:
            logits -= logits.max(axis=1, keepdims=True)
        places = np.arange(0, logits.size, c_all) + classes[a : a + _ROWS]
        logits.ravel().take(places, out=chosen[a : a + _ROWS], mode="clip")
        np.exp(logits, out=logits)
        np.matmul(logits, ones[:c_all], out=sums[a : a + _ROWS])
    out = chosen - np.log(sums, out=sums)
    order, borders = _by_class(classes, c_all)
    ordered, member = states.take(order, axis=0), members[order]
    small = _small(net.member_out, 1)
    for c, size in enumerate(net.shape.sizes):
        block = net.blocks[c].T
        for a in range(borders[c], borders[c + 1], _ROWS):
            b = min(a + _ROWS, borders[c + 1])
            logits = ordered[a:b] @ block
            if not small:
                logits -= logits.max(axis=1, keepdims=True)
            places = np.arange(0, logits.size, size) + member[a:b]
            logits.ravel().take(places, out=chosen[a:b], mode="clip")
            np.exp(logits, out=logits)
            np.matmul(logits, ones[:size], out=sums[a:b])
    chosen -= np.log(sums, out=sums)
    out[order] += chosen
    return out


def gradient(
    net: Net,
    inputs: np.ndarray,
    fresh: np.ndarray,
    classes: np.ndarray,
    members: np.ndarray,
    weight: np.ndarray,
    state: np.ndarray,
    grad: Net | None = None,
) -> tuple[Net, np.ndarray]:
    """Gradient of the mean loss over one window, the state before it taken as given; the last state.

    grad: a net to write the gradient to.
    """
    h, c_all = net.shape.hidden, net.shape.classes
    steps, lanes = inputs.shape
    states, last, (gates, added) = forward(net, inputs, fresh, state, keep=True)
    grad = Net(net.shape) if grad is None else grad
    flat, y = _with_one(states.reshape(-1, h)), classes.ravel()
    scale = (weight.ravel() / max(1.0, weight.sum())).astype(np.float32)

    error = flat @ net.class_out
    if not _small(net.class_out, 0):
        error -= error.max(axis=1, keepdims=True)
    np.exp(error, out=error)
    error *= (scale / (error @ np.ones(c_all, np.float32)))[:, None]
    error.reshape(-1)[np.arange(0, error.size, c_all) + y] -= scale
    np.matmul(flat.T, error, out=grad.class_out)
    back = error @ net.class_w.T

    # The classes' blocks of errors lie one after the other; a token's row has its class's members.
    order, borders = _by_class(y, c_all)
    ordered, scaled = flat.take(order, axis=0), scale.take(order)
    lengths = np.array(net.shape.sizes).take(y.take(order))
    ends = np.cumsum(lengths)
    begins = ends - lengths
    errors = np.empty(int(ends[-1]), np.float32)
    blocks, at, a = [], 0, 0
    for block, out, size, b in zip(net.blocks, grad.blocks, net.shape.sizes, borders[1:]):
        if a == b:
            out[:] = 0
            continue
        mine, end = ordered[a:b], at + (b - a) * size
        error = errors[at:end].reshape(b - a, size)
        np.dot(mine, block.T, out=error)
        blocks.append((error, mine, block, out, a, b))
        at, a = end, b
    if not _small(net.member_out, 1):
        errors -= np.repeat(np.maximum.reduceat(errors, begins), lengths)
    np.exp(errors, out=errors)
    errors *= np.repeat(scaled / np.add.reduceat(errors, begins), lengths)
    errors[begins + members.ravel().take(order)] -= scaled
    ordered_back = np.empty((len(y), h + 1), np.float32)
    for error, mine, block, out, a, b in blocks:
        np.dot(error.T, mine, out=out)
        np.dot(error, block, out=ordered_back[a:b])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    back += ordered_back.take(place, axis=0)[:, :h]

    # What each gate's argument gets of a state's error, for all steps at once.
    z, r, n = gates
    back = back.reshape(steps, lanes, h)
    before = np.empty((steps, lanes, h), np.float32)
    before[0], before[1:] = state, states[:-1]
    before[fresh] = 0
    any_fresh = fresh.any(axis=1).tolist()
    rest = 1 - z
    to_n = n * n
    np.subtract(1, to_n, out=to_n)
    to_n *= rest
    parts = np.empty((steps, lanes, 3, h), np.float32)
    work = before - n
    work *= z
    np.multiply(work, rest, out=parts[:, :, 0])
    np.multiply(to_n, r, out=work)
    parts[:, :, 2] = work
    work *= added
    np.subtract(1, r, out=rest)
    np.multiply(work, rest, out=parts[:, :, 1])
    u = np.ascontiguousarray(net.u.T)
    carried = np.zeros((lanes, h), np.float32)
    kept = np.empty((lanes, h), np.float32)
    for t in range(steps - 1, -1, -1):
        d, part = back[t], parts[t]
        d += carried
        part *= d[:, None, :]
        np.dot(part.reshape(lanes, 3 * h), u, out=carried)
        np.multiply(d, z[t], out=kept)
        carried += kept
        if any_fresh[t]:
            carried *= ~fresh[t][:, None]
    flat_x = parts.reshape(-1, 3 * h)
    rows = inputs.ravel()
    np.matmul(before.reshape(-1, h).T, flat_x, out=grad.u)
    np.multiply(back, to_n, out=parts[:, :, 2])  # the input is added behind the reset gate
    np.matmul(net.embedding.take(rows, axis=0).T, flat_x, out=grad.w)
    np.matmul(np.ones(len(rows), np.float32), flat_x, out=grad.b)
    short = len(net.embedding) <= 1 << 15  # sorted by digits
    by_row = np.argsort(rows.astype(np.int16) if short else rows, kind="stable")
    to_rows = flat_x @ net.w.T
    ranked = rows.take(by_row)
    first = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    grad.embedding[:] = 0
    grad.embedding[ranked[first]] = np.add.reduceat(to_rows.take(by_row, axis=0), first, axis=0)
    return grad, last


class Adam:
    def __init__(self, net: Net, rate: float):
        self._net, self._rate, self._t = net, rate, 0
        self._m, self._v = np.zeros_like(net.flat), np.zeros_like(net.flat)
        self._work = np.zeros_like(net.flat)

    def step(self, grad: Net) -> None:
        self._t += 1
        g = grad.flat
        norm = float(np.sqrt(g @ g))
        if norm > 1.0:
            g *= 1.0 / norm
        work = self._work
        self._m *= 0.9
        self._m += np.multiply(g, 0.1, out=work)
        self._v *= 0.995
        np.multiply(g, g, out=work)
        work *= 0.005
        self._v += work
        step = self._rate * (1 - 0.995**self._t) ** 0.5 / (1 - 0.9**self._t)
        np.sqrt(self._v, out=work)
        work += 1e-7
        np.divide(self._m, work, out=work)
        work *= step
        self._net.flat -= work


Document = tuple[np.ndarray, np.ndarray, np.ndarray]  # input rows, classes, members


class Cells:
    """A window over lanes: (steps, lanes) each. weight is 0 where a lane has run out."""

    def __init__(self, steps: int, lanes: int, begin: int):
        self.codes = np.zeros((steps, lanes, 3), np.int32)
        self.codes[:, :, 0] = begin
        self.fresh = np.zeros((steps, lanes), bool)
        self.weight = np.ones((steps, lanes), np.float32)

    @property
    def inputs(self) -> np.ndarray:
        return self.codes[:, :, 0]

    @property
    def classes(self) -> np.ndarray:
        return self.codes[:, :, 1]

    @property
    def members(self) -> np.ndarray:
        return self.codes[:, :, 2]


class Feed:
    """Documents in lanes, one after the other, given out window by window.

    Every token of every document is in one window. Only a window is ever laid out as a matrix. Lanes
    may share an iterator; each then takes the next document when it has finished one.
    """

    def __init__(self, lanes: list[Iterator[Document]], begin: int):
        self._begin = begin
        self._lanes = [[lane, self._next(lane), 0] for lane in lanes]

    def _next(self, lane: Iterator[Document]) -> np.ndarray | None:
        """The next document's rows: the input (the word before), class and member of each token."""
        found = next(lane, None)
        if found is None:
            return None
        x, c, m = found
        codes = np.empty((len(x), 3), np.int32)
        codes[:1, 0] = self._begin
        codes[1:, 0] = x[:-1]
        codes[:, 1] = c
        codes[:, 2] = m
        return codes

    def running(self) -> list[int]:
        """Lanes with tokens left, numbered as in the last window; the others are given up."""
        on = [i for i, lane in enumerate(self._lanes) if lane[1] is not None]
        self._lanes = [self._lanes[i] for i in on]
        return on

    def window(self, steps: int) -> Cells:
        cells = Cells(steps, len(self._lanes), self._begin)
        codes, fresh, weight = cells.codes, cells.fresh, cells.weight
        for i, lane in enumerate(self._lanes):
            at = 0
            while at < steps and (rows := lane[1]) is not None:
                start = lane[2]
                n = min(steps - at, len(rows) - start)
                codes[at : at + n, i] = rows[start : start + n]
                if start == 0:
                    fresh[at, i] = True
                at += n
                lane[2] += n
                if lane[2] == len(rows):
                    lane[1], lane[2] = self._next(lane[0]), 0
            if at < steps:
                weight[at:, i] = 0
        return cells


def train(
    net: Net, documents: Iterator[Document], begin: int, lanes: int, steps: int, rate: float
) -> int:
    """Truncated backpropagation over every token of the documents; how many these were.

    A document's state is carried from window to window, as in scoring. With few lanes left windows get
    longer, and a step of Adam is made of at least half a full window's tokens, so that a long document
    that is left alone neither costs nor weighs more.
    """
    adam = Adam(net, rate)
    feed = Feed([documents] * lanes, begin)
    state = np.zeros((lanes, net.shape.hidden), np.float32)
    total, weight, tokens = np.zeros_like(net.flat), 0.0, 0
    grad = Net(net.shape)
    while on := feed.running():
        w = feed.window(min(_LONGEST, lanes * steps // len(on)))
        if len(on) < len(state):
            state = state[on]
        _, state = gradient(net, w.inputs, w.fresh, w.classes, w.members, w.weight, state, grad)
        n = float(w.weight.sum())
        tokens += int(n)
        if weight == 0 and 2 * n >= lanes * steps:  # a step of its own, as nearly all are
            adam.step(grad)
            continue
        total += np.multiply(grad.flat, np.float32(n), out=grad.flat)
        weight += n
        if 2 * weight >= lanes * steps:
            np.divide(total, np.float32(weight), out=grad.flat)
            adam.step(grad)
            total[:], weight = 0, 0.0
    if weight:
        np.divide(total, np.float32(weight), out=grad.flat)
        adam.step(grad)
    return tokens


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Documents in lanes of about equal length, the longest lane first."""
    import heapq

    heap = [(0, i) for i in range(min(lanes, max(1, len(lengths))))]
    out: list[list[int]] = [[] for _ in heap]
    for i in np.argsort(-lengths, kind="stable").tolist():
        total, lane = heapq.heappop(heap)
        out[lane].append(i)
        heapq.heappush(heap, (total + int(lengths[i]), lane))
    return sorted(out, key=lambda x: -sum(int(lengths[i]) for i in x))


def score_documents(
    net: Net,
    documents: list[tuple[np.ndarray, np.ndarray, np.ndarray]],
    begin: int,
    lanes: int = 256,
    steps: int = 32,
    at_once: int = 16_384,
) -> np.ndarray:
    """Log-likelihood (natural) of each document, given as input rows, classes and members.

    A document's state is carried from window to window until its end; lanes hold documents one after
    the other and stop when they run out. With few lanes left, windows get longer, up to `at_once`
    tokens, so that the softmaxes always have many rows. Windows are filled one at a time, so memory
    does not grow with the longest document.
    """
    lengths = np.array([len(x) for x, _, _ in documents])
    order = lanes_of(lengths, lanes)
    sizes = np.array([sum(int(lengths[i]) for i in lane) for lane in order])
    longest = int(sizes[0]) if len(sizes) else 0
    feed = Feed([iter([documents[i] for i in lane]) for lane in order], begin)
    ends = [np.cumsum(lengths[lane]) for lane in order]
    out = np.zeros(len(documents))
    state = np.zeros((len(order), net.shape.hidden), np.float32)
    table = input_table(net)
    t = 0
    while t < longest:
        on = len(feed.running())  # the longest lanes come first
        w = feed.window(min(longest - t, max(steps, at_once // on)))
        states, state, _ = forward(net, w.inputs, w.fresh, state[:on], table=table)
        n = len(states)
        found = log_probabilities(
            net, states.reshape(n * on, -1), w.classes.ravel(), w.members.ravel()
        ).reshape(n, on)
        for lane in range(on):
            first, last = np.searchsorted(ends[lane], [t, t + n], side="right")
            cuts = [0, *(ends[lane][first:last] - t).tolist(), min(n, int(sizes[lane]) - t)]
            for k in range(first, min(last + 1, len(order[lane]))):
                a, b = cuts[k - first], cuts[k - first + 1]
                out[order[lane][k]] += found[a:b, lane].sum(dtype=np.float64)
        t += n
    return out
