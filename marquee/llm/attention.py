"""A small causal self-attention model over token classes, in numpy.

Every token id has a class; the ids of a class share its probability in proportion to their smoothed counts in the
training text.  The model predicts the next token's class: class and place embeddings, one attention head, a residual
and a softmax in two steps, over groups of classes and over the classes of the next token's group, so that scoring a token
takes few exponentials.  Texts are read in overlapping windows of ``CONTEXT + STEP`` inputs; each window predicts after its last
``STEP`` inputs, so every token is scored once and sees at least ``CONTEXT`` tokens before it (where there are any).
"""

from __future__ import annotations

import numpy as np

CONTEXT, STEP = 16, 16
WIDTH = CONTEXT + STEP
DIM = 16
GROUPS, MEMBERS = 32, 32     # classes are numbered by group
CLASSES = GROUPS * MEMBERS
SHARED = 63                  # classes that the less frequent ids share
END = CLASSES - 1            # class of the end of a text
SINGLE = END - SHARED        # classes of one frequent id each
START, PAD = CLASSES, CLASSES + 1
AT_ONCE = 256                # windows scored in one step
POOL = 24 << 20              # bytes of a block freed at once, after which malloc keeps a step's temporaries for reuse


def classes_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of every id, and log10 of its share in the class.  The most frequent ids have classes of their own; the
    others are cut, by frequency, into classes of about equal weight."""
    order = np.argsort(-counts, kind="stable")
    weight = counts[order] + 1.0
    cls = np.empty(len(counts), np.int16)
    cls[order[:SINGLE]] = np.arange(min(SINGLE, len(counts)))
    rest = weight[SINGLE:]
    if len(rest):
        cls[order[SINGLE:]] = SINGLE + np.minimum((np.cumsum(rest) - rest / 2) / rest.sum() * SHARED, SHARED - 1)
    total = np.bincount(cls, counts + 1.0, minlength=CLASSES)
    return cls, np.log10((counts + 1.0) / total[cls])


SHAPES = {"emb": (CLASSES + 2, DIM), "pos": (WIDTH, DIM), "q": (DIM, DIM), "k": (DIM, DIM), "v": (DIM, DIM),
          "o": (DIM, DIM), "group": (DIM + 1, GROUPS), "member": (GROUPS, DIM + 1, MEMBERS)}


def new_params(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    scale = {"emb": 0.5, "pos": 0.3, "group": 0.1, "member": 0.1}
    return {n: (rng.standard_normal(s) * scale.get(n, DIM**-0.5)).astype(np.float32) for n, s in SHAPES.items()}


def flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in params.values()])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = values[at:at + size].reshape(shape).astype(np.float32, copy=False)
        at += size
    return out


LIMIT = np.float32(60)       # of scores before exp; far above what training reaches, so that nothing overflows

#: A query at place CONTEXT + i sees the inputs up to itself.
_CAUSAL = np.where(np.arange(WIDTH) <= CONTEXT + np.arange(STEP)[:, None], 0, -1e9).astype(np.float32)


def cut_windows(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class sequences to (inputs [n, WIDTH], targets [n, STEP] with -1 for none, text number [n])."""
    counts = [len(s) // STEP + 1 for s in seqs]
    total = sum(counts)
    inputs, targets = np.full((total, WIDTH), PAD, np.int16), np.full((total, STEP), -1, np.int16)
    at = 0
    for s, n in zip(seqs, counts):
        line = np.full(CONTEXT + STEP * n, PAD, np.int16)
        line[CONTEXT] = START
        line[CONTEXT + 1:CONTEXT + 1 + len(s)] = s[:STEP * n - 1]
        goal = np.full(STEP * n, -1, np.int16)
        goal[:len(s)] = s
        goal[len(s)] = END
        inputs[at:at + n, :CONTEXT] = line[:-STEP].reshape(n, STEP)
        inputs[at:at + n, CONTEXT:] = line[CONTEXT:].reshape(n, STEP)
        targets[at:at + n] = goal.reshape(n, STEP)
        at += n
    return inputs, targets, np.repeat(np.arange(len(seqs)), counts)


def chunks(seq: np.ndarray, windows: int) -> list[np.ndarray]:
    """The class sequence in runs of at most ``windows`` windows; each has what its windows' inputs and targets need."""
    n = len(seq) // STEP + 1
    line = np.full(CONTEXT + STEP * n + 1, PAD, np.int16)
    line[CONTEXT] = START
    line[CONTEXT + 1:CONTEXT + 1 + len(seq)] = seq
    line[CONTEXT + 1 + len(seq)] = END
    return [line[STEP * a:STEP * min(n, a + windows) + CONTEXT + 1] for a in range(0, n, windows)]


def cut_chunks(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets of all windows of ``chunks``, as ``cut_windows`` gives them."""
    counts = [(len(x) - CONTEXT - 1) // STEP for x in parts]
    inputs, targets = np.empty((sum(counts), WIDTH), np.int16), np.empty((sum(counts), STEP), np.int16)
    at = 0
    for x, n in zip(parts, counts):
        inputs[at:at + n, :CONTEXT] = x[:STEP * n].reshape(n, STEP)
        inputs[at:at + n, CONTEXT:] = x[CONTEXT:CONTEXT + STEP * n].reshape(n, STEP)
        targets[at:at + n] = x[CONTEXT + 1:CONTEXT + 1 + STEP * n].reshape(n, STEP)
        at += n
    inputs[inputs == END] = PAD                              # the end is a target only
    targets[targets == PAD] = -1
    return inputs, targets


def forward(p: dict[str, np.ndarray], inputs: np.ndarray):
    x = np.take(p["emb"], inputs, axis=0)
    x += p["pos"]
    xq = x[:, CONTEXT:]
    q = xq @ (p["q"] * np.float32(DIM**-0.5))
    kv = (x.reshape(-1, DIM) @ np.hstack([p["k"], p["v"]])).reshape(-1, WIDTH, 2 * DIM)
    k, v = kv[..., :DIM], kv[..., DIM:]
    a = q @ k.transpose(0, 2, 1)
    a += _CAUSAL
    first = np.flatnonzero(inputs[:, 0] == PAD)            # filling after a text's end is hidden by causality
    a[first] += np.where(inputs[first] == PAD, np.float32(-1e9), np.float32(0))[:, None, :]
    np.exp(np.minimum(a, LIMIT, out=a), out=a)
    norm = a @ np.ones((WIDTH, 1), np.float32)
    z = a @ v
    z /= norm
    h = np.ones((x.shape[0], STEP, DIM + 1), np.float32)   # the last column is for the biases
    h[..., :DIM] = z @ p["o"]
    h[..., :DIM] += xq
    return x, q, k, v, a, norm, z, h.reshape(-1, DIM + 1)


def softmax(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of scores kept in bounds, and their sums by row."""
    np.exp(np.minimum(scores, LIMIT, out=scores), out=scores)
    return scores, scores @ np.ones(scores.shape[1], np.float32)


def by_group(h: np.ndarray, goal: np.ndarray, member: np.ndarray):
    """Rows and targets in order of the targets' groups, (group, first, end) of each group that has some, and the
    scores of the group's members in each row."""
    order = np.argsort(goal // MEMBERS, kind="stable")
    h, goal = h[order], goal[order]
    cuts = np.searchsorted(goal, np.arange(GROUPS + 1) * MEMBERS).tolist() if len(goal) else [0] * (GROUPS + 1)
    runs = [(g, a, b) for g, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
    scores = np.empty((len(goal), MEMBERS), np.float32)
    for g, a, b in runs:
        np.matmul(h[a:b], member[g], out=scores[a:b])
    return h, goal, order, runs, scores


def log10_probabilities(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """log10 of every target's class probability, 0 where there is no target."""
    np.empty(POOL, np.uint8)
    out = np.zeros(targets.size, np.float64)
    for at in range(0, len(inputs), AT_ONCE):
        goal = targets[at:at + AT_ONCE].ravel()
        live = np.flatnonzero(goal >= 0)
        h, goal = forward(p, inputs[at:at + AT_ONCE])[-1][live], goal[live]
        h, goal, order, _, scores = by_group(h, goal, p["member"])
        at_goal = np.arange(len(goal))
        e, total = softmax(scores)
        lp = np.log(e[at_goal, goal % MEMBERS] / total)
        e, total = softmax(h @ p["group"])
        out[at * STEP + live[order]] = lp + np.log(e[at_goal, goal // MEMBERS] / total)
    return (out / np.log(10)).reshape(targets.shape)


def gradients(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross-entropy over the targets."""
    x, q, k, v, a, norm, z, h = forward(p, inputs)
    a /= norm
    goal = targets.ravel()
    live = np.flatnonzero(goal >= 0)
    hl, goal, order, runs, scores = by_group(h[live], goal[live], p["member"])
    weight = np.float32(1 / max(1, len(goal)))

    def error(scores, chosen):
        e, total = softmax(scores)
        e *= (weight / total)[:, None]
        e[np.arange(len(e)), chosen] -= weight
        return e

    d = error(hl @ p["group"], goal // MEMBERS)
    g = {"group": hl.T @ d, "member": np.zeros_like(p["member"])}
    dl = d @ p["group"].T
    d = error(scores, goal % MEMBERS)
    for n, a0, b0 in runs:
        g["member"][n] = hl[a0:b0].T @ d[a0:b0]
        dl[a0:b0] += d[a0:b0] @ p["member"][n].T
    dh = np.zeros_like(h)
    dh[live[order]] = dl
    dh = dh[:, :DIM].reshape(len(inputs), STEP, DIM)
    g["o"] = z.reshape(-1, DIM).T @ dh.reshape(-1, DIM)
    dz = dh @ p["o"].T
    ds = dz @ v.transpose(0, 2, 1)
    dkv = np.empty((len(inputs), WIDTH, 2 * DIM), np.float32)
    np.matmul(a.transpose(0, 2, 1), dz, out=dkv[..., DIM:])
    ds -= np.einsum("nij,nij->ni", ds, a)[..., None]
    ds *= a
    dq = ds @ k
    np.matmul(ds.transpose(0, 2, 1), q, out=dkv[..., :DIM])
    xq, scale = x[:, CONTEXT:], np.float32(DIM**-0.5)
    g["q"] = xq.reshape(-1, DIM).T @ dq.reshape(-1, DIM) * scale
    dkv = dkv.reshape(-1, 2 * DIM)
    both = x.reshape(-1, DIM).T @ dkv
    g["k"], g["v"] = both[:, :DIM], both[:, DIM:]
    dx = (dkv @ np.hstack([p["k"], p["v"]]).T).reshape(x.shape)
    dx[:, CONTEXT:] += dh + dq @ (p["q"].T * scale)
    g["pos"] = dx.sum(axis=0)
    g["emb"] = np.stack([np.bincount(inputs.ravel(), dx[..., j].ravel(), minlength=CLASSES + 2)
                         for j in range(DIM)], axis=1).astype(np.float32)
    return {n: g[n] for n in p}


def train(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, steps: int, batch: int, rate: float,
          seed: int) -> dict[str, np.ndarray]:
    """Adam over ``steps`` minibatches (more if one pass over the windows takes more)."""
    rng = np.random.default_rng(seed)
    np.empty(POOL, np.uint8)
    w = flat(p)
    m, s = np.zeros_like(w), np.zeros_like(w)
    steps = max(steps, -(-len(inputs) // batch))
    order = np.concatenate([rng.permutation(len(inputs)) for _ in range(-(-steps * batch // len(inputs)))])
    for t in range(1, steps + 1):
        pick = order[(t - 1) * batch:t * batch]
        g = flat(gradients(shaped(w), inputs[pick], targets[pick]))
        m += np.float32(0.1) * (g - m)
        s += np.float32(0.02) * (g * g - s)
        w -= np.float32(rate / (1 - 0.9**t)) * m / (np.sqrt(s * np.float32(1 / (1 - 0.98**t))) + np.float32(1e-8))
    return shaped(w)
