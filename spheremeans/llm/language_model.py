"""A gated recurrent language model over words, and the log-likelihood of whole texts.

Tokens are words (A-Z in lower case) and one end for each text. The output softmax is factored
by class: the ``HEAD`` most frequent tokens fall into classes of 64 by rank, all other words are
one further class. Within a class the network tells the tokens apart, and in the last one
``SHAPES`` shapes, by a word's last two bytes and length. Within a shape a word has its share of the
shape's training tokens, less the share that singletons suggest for words never seen; all unseen
words of a shape are one token.

Counts cover every training text. The network starts from them and is trained by truncated
backpropagation in NumPy, on all tokens of every training text, cut into consecutive stretches:
copies are trained on ``TRAINER_ROWS`` stretches each, dealt by hash, and averaged, over rounds
that grow in number with the stretches. How files are cut does not matter. Scoring carries the state from window to window
through the whole text, many texts side by side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, text_slices
from .words import Words, mix, words_of

HEAD, CLASS_SIZE = 2048, 64
HEAD_CLASSES = HEAD // CLASS_SIZE
SHAPES = 96
TABLE = 131072  # most frequent words whose counts go to every task
EMBED, HIDDEN = 16, 32
WINDOW, STRETCH = 32, 2  # a training stretch is so many windows of so many tokens
LANES, BATCH = 160, 128
ROUNDS, EPOCHS, RATE = 2, 1, 0.02  # ROUNDS: the least there are
TRAINER_ROWS = 4096  # stretches that one copy is trained on in a round
TOGETHER = 8  # copies at most that one task trains in turn and averages
MOST_PARTITIONS = 16384  # of a round
AVERAGED = 32  # copies that one task averages, and that come to the driver
SLICE = 1 << 18  # bytes of text whose words are hashed at a time: their arrays stay in the processor's cache
END = np.uint64(0x5EED0E4D)  # stands for the end of a text among word hashes


def hold_memory() -> None:
    """Lets this process keep what it frees, up to some 50 MB, for its next arrays.

    Otherwise glibc returns it at once, and clearing each page anew takes as long as the work on it.
    Freeing a large array raises the size from which it does so.
    """
    np.empty(24 << 20, np.uint8)


def word_codes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape class of each word."""
    end, size = words.end, words.end - words.start
    last = words.data[end - 1].astype(np.uint64)
    before = np.where(size > 1, words.data[np.maximum(end - 2, 0)], 0).astype(np.uint64)
    lower = lambda b: np.where((b >= 65) & (b < 91), b + np.uint64(32), b)
    key = (lower(last) << np.uint64(16)) | (lower(before) << np.uint64(8)) | np.minimum(size // 6, 2).astype(np.uint64)
    return words.hashes(), (mix(key) % np.uint64(SHAPES)).astype(np.int64)


def _choose(states: np.ndarray, weights: np.ndarray, chosen: np.ndarray, with_gradients: bool):
    """Log softmax of each row's choice, and the gradients of states and weights.

    The last column of ``states`` is ones, that of ``weights`` the biases.
    """
    rows = np.arange(len(chosen))
    logits = states @ weights.T
    log_p = logits[rows, chosen]
    with np.errstate(over="ignore"):
        e = np.exp(logits, out=logits)
    ones = np.ones(e.shape[1], e.dtype)
    total = e @ ones
    if not 1e-30 < total.min() <= total.max() < 1e30:  # only then the largest must be taken off first
        logits = states @ weights.T
        logits -= logits.max(axis=1, keepdims=True)
        log_p = logits[rows, chosen]
        e = np.exp(logits, out=logits)
        total = e @ ones
    log_p -= np.log(total)
    if not with_gradients:
        return log_p, None
    e /= total[:, None]
    e[rows, chosen] -= 1
    return log_p, (e @ weights[:, :-1], e.T @ states)


@dataclass
class Gates:
    """What tokens add to the gates z and r, side by side, and to the candidate."""

    zr: np.ndarray
    n: np.ndarray

    def __getitem__(self, tokens: np.ndarray) -> Gates:
        return Gates(self.zr.take(tokens, axis=0), self.n.take(tokens, axis=0))


class GatedModel:
    """A GRU with a class-factored softmax; ``p`` holds its arrays."""

    NAMES = ("emb", "wx", "wh", "b", "cw", "cb", "ow", "ob")

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def start(cls, class_logits: np.ndarray, token_logits: np.ndarray, seed: int = 3) -> GatedModel:
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale: (rng.normal(size=s) * scale).astype(np.float32)
        p = {
            "emb": draw(HEAD + SHAPES, EMBED, scale=0.3),
            "wx": draw(EMBED, 3 * HIDDEN, scale=EMBED**-0.5),
            "wh": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "b": np.zeros(3 * HIDDEN, np.float32),
            "cw": np.zeros((HIDDEN, HEAD_CLASSES + 1), np.float32),
            "cb": class_logits.astype(np.float32),
            "ow": np.zeros((HEAD + SHAPES, HIDDEN), np.float32),
            "ob": token_logits.astype(np.float32),
        }
        p["b"][:HIDDEN] = 1.0  # remember at first
        return cls(p)

    def to_bytes(self) -> bytes:
        return b"".join(np.ascontiguousarray(self.p[n], dtype="<f4").tobytes() for n in self.NAMES)

    def like(self, flat: np.ndarray) -> GatedModel:
        out, at = {}, 0
        for n in self.NAMES:
            size = self.p[n].size
            out[n] = flat[at : at + size].reshape(self.p[n].shape).astype(np.float32)
            at += size
        return GatedModel(out)

    def table(self) -> Gates:
        emb, wx, b = (self.p[name] for name in ("emb", "wx", "b"))
        zr, n = emb @ wx[:, : 2 * HIDDEN], emb @ wx[:, 2 * HIDDEN :]
        zr += b[: 2 * HIDDEN]
        n += b[2 * HIDDEN :]
        return Gates(zr, n)

    def step(self, gates: Gates, h: np.ndarray, out: tuple | None = None):
        """The next state, and the gates z and r side by side, the candidate, and its part from h.

        They are written to ``out``, in this order, if it is given.
        """
        after, zr, n, from_n = out or (None, None, None, None)
        wh = self.p["wh"]
        zr = np.matmul(h, wh[:, : 2 * HIDDEN], out=zr)
        from_n = np.matmul(h, wh[:, 2 * HIDDEN :], out=from_n)
        zr += gates.zr
        np.exp(np.negative(zr, out=zr), out=zr)
        zr += 1
        np.divide(1, zr, out=zr)
        n = np.multiply(zr[:, HIDDEN:], from_n, out=n)
        n += gates.n
        n *= -2  # tanh, by exp, which takes less time
        np.exp(n, out=n)
        n += 1
        np.divide(2, n, out=n)
        n -= 1
        after = np.subtract(h, n, out=after)
        after *= zr[:, :HIDDEN]
        after += n
        return after, (zr, n, from_n)

    @staticmethod
    def class_of(y: np.ndarray) -> np.ndarray:
        return np.minimum(y // CLASS_SIZE, HEAD_CLASSES)

    def log_probabilities(self, states: np.ndarray, y: np.ndarray, gradients: dict | None = None):
        """Natural log probability of each y: its class, and the token or shape within.

        With ``gradients`` it also adds the loss gradients and returns that of the states.
        """
        p, cls = self.p, self.class_of(y).astype(np.int8)
        order = np.argsort(cls, kind="stable")
        # In the order of classes, so that each class is a slice; ones stand beside the states for the biases.
        own_states = np.ones((len(y), HIDDEN + 1), states.dtype)
        own_states[:, :HIDDEN] = states.take(order, axis=0)
        y, cls = y[order], cls[order]
        class_weights, weights = np.column_stack([p["cw"].T, p["cb"]]), np.column_stack([p["ow"], p["ob"]])
        log_p, back = _choose(own_states, class_weights, cls, gradients is not None)
        if gradients is not None:
            back, d_weights = back
            gradients["cw"] += d_weights[:, :-1].T
            gradients["cb"] += d_weights[:, -1]
        upto = np.searchsorted(cls, np.arange(HEAD_CLASSES + 2))
        for c in range(HEAD_CLASSES + 1):
            own = slice(upto[c], upto[c + 1])
            if own.start == own.stop:
                continue
            span = slice(c * CLASS_SIZE, (c + 1) * CLASS_SIZE if c < HEAD_CLASSES else HEAD + SHAPES)
            within, d = _choose(own_states[own], weights[span], y[own] - span.start, gradients is not None)
            log_p[own] += within
            if gradients is not None:
                back[own] += d[0]
                gradients["ow"][span] += d[1][:, :-1]
                gradients["ob"][span] += d[1][:, -1]
        out = np.empty_like(log_p)
        out[order] = log_p
        if gradients is not None:
            d_states = np.empty_like(back)
            d_states[order] = back
            back = d_states
        return out, back

    def window_gradients(self, x: np.ndarray, y: np.ndarray, h: np.ndarray):
        """x, y: time x lanes, y < 0 where there is no token. Gradients, the last state, tokens."""
        p = self.p
        g = {n: np.zeros_like(v) for n, v in p.items()}
        table = self.table()
        states = np.empty((len(x) + 1, *h.shape), h.dtype)  # the one before the window first
        states[0] = h
        zr = np.empty((*x.shape, 2 * HIDDEN), h.dtype)
        n, from_n = np.empty((*x.shape, HIDDEN), h.dtype), np.empty((*x.shape, HIDDEN), h.dtype)
        for t in range(len(x)):
            self.step(table[x[t]], states[t], (states[t + 1], zr[t], n[t], from_n[t]))
        real = np.flatnonzero(y >= 0)
        d_states = np.zeros_like(states[1:])
        d_states.reshape(-1, HIDDEN)[real] = self.log_probabilities(states[1:].reshape(-1, HIDDEN).take(real, axis=0), y.ravel()[real], g)[1]

        # What each gate makes of a state's gradient, for all times at once; only the carry goes step by step.
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        through = np.empty((*x.shape, 3 * HIDDEN), h.dtype)
        by_n = 1 - z
        by_z = np.subtract(states[:-1], n)
        by_z *= z
        np.multiply(by_z, by_n, out=through[..., :HIDDEN])
        n *= n
        by_n *= np.subtract(1, n, out=n)
        by_r = np.multiply(by_n, r, out=through[..., 2 * HIDDEN :])
        from_n *= by_r
        from_n *= 1 - r
        through[..., HIDDEN : 2 * HIDDEN] = from_n
        back_h = np.ascontiguousarray(p["wh"].T)
        carry = np.zeros_like(h)
        for t in reversed(range(len(x))):
            d = d_states[t]
            d += carry
            by_gates = through[t].reshape(-1, 3, HIDDEN)
            by_gates *= d[:, None, :]
            np.matmul(through[t], back_h, out=carry)
            carry += d * z[t]
        g["wh"] += states[:-1].reshape(-1, HIDDEN).T @ through.reshape(-1, 3 * HIDDEN)
        d_gates = through
        np.multiply(d_states, by_n, out=d_gates[..., 2 * HIDDEN :])
        flat = d_gates.reshape(-1, 3 * HIDDEN)
        tokens = x.ravel()
        g["b"] += np.ones(len(flat), flat.dtype) @ flat
        g["wx"] += p["emb"].take(tokens, axis=0).T @ flat
        cells = (tokens[:, None] * EMBED + np.arange(EMBED)).ravel()
        g["emb"] += np.bincount(cells, weights=(flat @ p["wx"].T).ravel(), minlength=g["emb"].size).reshape(-1, EMBED)
        return g, states[-1], len(real)

    def train(self, stretches: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 5) -> GatedModel:
        """stretches: rows of tokens, the first one only given; -1 after a text's end."""
        rng = np.random.default_rng(seed)
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        v = {n: np.zeros_like(w) for n, w in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(stretches))
            for at in range(0, len(order), BATCH):
                rows = stretches[order[at : at + BATCH]].T
                h = np.zeros((rows.shape[1], HIDDEN), np.float32)
                for begin in range(0, len(rows) - 1, WINDOW):
                    x = np.maximum(rows[begin : begin + WINDOW], 0)
                    y = rows[begin + 1 : begin + WINDOW + 1]
                    live = y[0] >= 0  # the texts of the other lanes have ended
                    if not live.any():
                        break
                    g, h[live], n = self.window_gradients(x[: len(y), live], y[:, live], h[live])
                    step += 1
                    norm = np.sqrt(sum(float(w.ravel() @ w.ravel()) for w in g.values())) / n
                    scale = min(1.0, 1.0 / max(norm, 1e-9)) / n
                    first, second = rate / (1 - 0.9**step), 1 / (1 - 0.99**step)
                    for k, w in g.items():
                        w *= scale
                        m[k] *= 0.9
                        m[k] += 0.1 * w
                        w *= w
                        w *= 0.01
                        v[k] *= 0.99
                        v[k] += w
                        np.sqrt(np.multiply(v[k], second, out=w), out=w)
                        w += 1e-6
                        np.divide(m[k], w, out=w)
                        w *= first
                        self.p[k] -= w
        return self

    def score(self, tokens: np.ndarray, begins: np.ndarray, end_token: int) -> np.ndarray:
        """Natural log probability of each text's tokens (its end included), state carried throughout.

        Texts are laid end to end in lanes, which advance together; a text starts with no state.
        """
        n = len(begins) - 1
        out = np.zeros(n)
        sizes = np.diff(begins)
        lanes: list[list[int]] = [[] for _ in range(min(LANES, n))]
        load = [(0, i) for i in range(len(lanes))]
        heapify(load)
        for i in np.argsort(-sizes, kind="stable"):
            size, lane = load[0]
            lanes[lane].append(int(i))
            heapreplace(load, (size + int(sizes[i]), lane))
        filled = sorted((lane for lane in lanes if lane), key=lambda lane: -sum(int(sizes[i]) for i in lane))
        ends = np.cumsum([sum(int(sizes[i]) for i in lane) for lane in filled])
        lengths = np.diff(ends, prepend=0)
        laid = np.array([i for lane in filled for i in lane], dtype=np.int64)
        starts = np.cumsum(sizes[laid]) - sizes[laid]  # of texts where they are laid
        owner = np.repeat(laid.astype(np.int32), sizes[laid])
        source = np.repeat((begins[laid] - starts).astype(np.int32), sizes[laid])
        source += np.arange(len(source), dtype=np.int32)
        y = tokens[source]
        x = np.roll(y, 1)
        x[starts] = end_token
        fresh = np.zeros(len(y), dtype=bool)
        fresh[starts] = True
        table = self.table()
        h = np.zeros((len(filled), HIDDEN), np.float32)
        room = [np.empty((len(filled), k * HIDDEN), np.float32) for k in (2, 1, 1)]
        for begin in range(0, int(lengths.max(initial=0)), 64):
            active = int((lengths > begin).sum())
            width = min(64, int(lengths[0]) - begin)
            at = (ends - lengths)[:active] + begin + np.arange(width)[:, None]
            real = at < ends[:active]
            at = np.minimum(at, len(y) - 1)
            xw, new = x[at], fresh[at]
            states = np.empty((width + 1, active, HIDDEN), np.float32)
            states[0] = h[:active]
            renewed = new.any(axis=1)
            for t in range(width):
                before = np.where(new[t][:, None], np.float32(0), states[t]) if renewed[t] else states[t]
                self.step(table[xw[t]], before, (states[t + 1], *(a[:active] for a in room)))
            h = states[-1]
            at = at[real]
            logs, _ = self.log_probabilities(states[1:][real], y[at].astype(np.int64))
            out += np.bincount(owner[at], weights=logs, minlength=n)
        return out


def _places(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted hash stands among the known ones, in order; their number where it does not."""
    at = np.searchsorted(known, wanted)
    at[known.take(at, mode="clip") != wanted] = len(known)
    return at


def _sequences(words: Words, token: np.ndarray, end_token: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts with their ends, and where each text begins."""
    n = len(words.first) - 1
    begins = words.first + np.arange(n + 1)
    out = np.empty(len(token) + n, dtype=np.int16)
    ends = begins[1:] - 1
    out[ends] = end_token
    keep = np.ones(len(out), dtype=bool)
    keep[ends] = False
    out[keep] = token
    return out, begins


def _merged(pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, shape and count, once for each word."""
    words, shapes, counts = (np.concatenate(x) for x in zip(*pieces, strict=True))
    names, first, inverse = np.unique(words, return_index=True, return_inverse=True)
    return names, shapes[first], np.bincount(inverse, weights=counts, minlength=len(names)).astype(np.int64)


def _count(batches, most: int = 1 << 20):
    """Words of the partition with shapes and counts, merged while they are fewer than ``most``."""
    hold_memory()
    pieces, held = [], 0

    def rows(pieces):
        names, shapes, counts = _merged(pieces)
        return pa.RecordBatch.from_arrays(
            [pa.array(names.view(np.int64)), pa.array(shapes.astype(np.int32)), pa.array(counts)], names=["word", "shape", "n"]
        )

    for batch in batches:
        for part in text_slices(batch, "text", SLICE):
            h, shape = word_codes(words_of(part.column("text")))
            own = _merged([(h, shape, np.ones(len(h), dtype=np.int64))])
            ends = np.array([END]), np.array([-1]), np.array([part.num_rows])
            pieces += [own, ends]
            held += len(own[0])
            if held > most:
                pieces = [_merged(pieces)]
                held = len(pieces[0][0])
                if held > most // 2:
                    yield rows(pieces)
                    pieces, held = [], 0
    if pieces:
        yield rows(pieces)


def _stretches(batches, head, head_token):
    """Every text cut into consecutive stretches: a row repeats the last token of the one before, or the end."""
    hold_memory()
    size, most = WINDOW * STRETCH, 4096
    end_token = int(head_token.value[np.searchsorted(head.value, END)])
    for batch in batches:
        for part in text_slices(batch, "text"):
            words = words_of(part.column("text"))
            h, shape = word_codes(words)
            at = _places(head.value, h)
            tokens, begins = _sequences(words, np.where(at < len(head.value), head_token.value.take(at, mode="clip"), HEAD + shape), end_token)
            copies: dict[tuple, int] = {}  # tells equal rows apart, so that many do not all go to one place
            ids = part.column("doc_id")
            copy = []
            for key in zip(ids.to_pylist(), part.column("text").to_pylist(), strict=True):
                copies[key] = copies.get(key, -1) + 1
                copy.append(copies[key])
            copy = np.array(copy)
            counts = -(-np.diff(begins) // size)  # every text has its end at least
            doc = np.repeat(np.arange(part.num_rows), counts)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            for i in range(0, len(doc), most):
                own, at = doc[i : i + most], nth[i : i + most]
                where = (begins[own] + at * size - 1)[:, None] + np.arange(size + 1)
                rows = np.where(where < begins[own + 1][:, None], tokens[np.minimum(where, len(tokens) - 1)], -1).astype("<i2")
                rows[at == 0, 0] = end_token  # the end of a text stands before the next
                cuts = np.arange(len(rows) + 1, dtype=np.int32) * rows.itemsize * (size + 1)
                packed = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(cuts), pa.py_buffer(rows)])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(own)), pa.array(at), pa.array(copy[own]), packed],
                    names=["doc_id", "nth", "copy", "tokens"],
                )


def training_plan(rows: int) -> tuple[int, int, int]:
    """Rounds, shares that the rows are dealt to, and trainers a share, for so many stretches.

    Round r trains on share r modulo the shares. There are no fewer rounds than shares, so every
    row is trained on; a trainer holds about TRAINER_ROWS rows, or all if they are fewer.
    """
    units = max(1, round(rows / TRAINER_ROWS))
    rounds = ROUNDS + units.bit_length() - 1
    shares = min(rounds, units)
    return rounds, shares, max(1, round(units / shares))


def together(trainers: int) -> int:
    """Trainers that one task trains in turn, so that their average is all it sends.

    Where the driver takes every model, a task has one; otherwise a few, up to TOGETHER, if that leaves AVERAGED tasks.
    """
    return min(TOGETHER, -(-trainers // AVERAGED))


def _train(table: pa.Table, model) -> pa.Table:
    """The average of the copies trained on the rows of each trainer."""
    hold_memory()
    tokens = table["tokens"].to_numpy()
    by_trainer = np.split(np.argsort(own := table["trainer"].to_numpy(), kind="stable"), np.cumsum(np.unique(own, return_counts=True)[1])[:-1])
    found = []
    for rows in by_trainer:
        rows = sorted(tokens[rows])
        stretches = np.frombuffer(b"".join(rows), dtype="<i2").reshape(len(rows), -1).astype(np.int64)
        copy = GatedModel({k: v.copy() for k, v in model.value.p.items()})
        found.append((float(len(rows)), copy.train(stretches).to_bytes()))
    weight, arrays = _mean(found)
    return pa.table({"trainer": table["task"].slice(0, 1), "weight": [weight], "arrays": pa.array([arrays], pa.binary())})


def _trainer(model):
    return lambda table: _train(table, model)


def _mean(models: list[tuple[float, bytes]]) -> tuple[float, bytes]:
    models = sorted(models)  # they come in any order
    weight = sum(w for w, _ in models)
    total = sum(w * np.frombuffer(a, dtype="<f4").astype(np.float64) for w, a in models)
    return weight, (total / weight).astype("<f4").tobytes()


def _average(table: pa.Table) -> pa.Table:
    weight, arrays = _mean(list(zip(table["weight"].to_pylist(), table["arrays"].to_pylist(), strict=True)))
    return pa.table({"trainer": table["trainer"].slice(0, 1), "weight": [weight], "arrays": pa.array([arrays], pa.binary())})


def train_in_rounds(model: GatedModel, stretches: DataFrame) -> GatedModel:
    """``model`` trained on all rows of ``stretches`` (doc_id, nth, copy, tokens)."""
    send = stretches.sparkSession.sparkContext.broadcast
    rounds, shares, trainers = training_plan(stretches.count())
    tasks = -(-trainers // together(trainers))
    schema = "trainer int, weight double, arrays binary"
    place = F.xxhash64("doc_id", "nth", "copy", "tokens")
    dealt = stretches.select(
        F.pmod(place, F.lit(shares)).cast("int").alias("share"),
        F.pmod(F.xxhash64(place, F.lit(7)), F.lit(trainers)).cast("int").alias("trainer"),
        "tokens",
    )
    for r in range(rounds):
        own = dealt.where(F.col("share") == r % shares).select(F.pmod("trainer", F.lit(tasks)).alias("task"), "trainer", "tokens")
        # More partitions than tasks, so that few hold two.
        own = own.repartition(min(2 * tasks, MOST_PARTITIONS), "task")
        means = own.groupBy("task").applyInArrow(_trainer(send(model)), schema)
        width = tasks
        while width > AVERAGED:
            width = -(-width // AVERAGED)
            means = means.withColumn("trainer", F.pmod("trainer", F.lit(width))).groupBy("trainer").applyInArrow(_average, schema)
        found = [(m["weight"], bytes(m["arrays"])) for m in means.collect()]  # AVERAGED models at most
        if found:
            model = model.like(np.frombuffer(_mean(found)[1], dtype="<f4"))
    return model


def _score(batches, model, head, head_token, table_words, table_counts, shape_unseen, shape_mass, tokens_n, types_n):
    """One row for each text: what needs no further look-up, and the words that do."""
    hold_memory()
    net, known_words, known_counts = model.value, table_words.value, table_counts.value
    end_token = int(head_token.value[np.searchsorted(head.value, END)])
    bottom = np.log10(tokens_n + 0.5 * (types_n + 1))
    # Of each known word, and last of one that is not: its token in the head (else -1) and its terms.
    place = _places(head.value, known_words)
    token_of = np.append(np.where(place < len(head.value), head_token.value.take(place, mode="clip"), -1), -1)
    base_of = np.append(np.log10(known_counts + 0.5), np.log10(0.5)) - bottom
    log_counts = np.log10(np.maximum(np.append(known_counts, 1), 1))
    log_unseen, log_seen = np.log10(shape_unseen), np.log10((1 - shape_unseen) / np.maximum(shape_mass, 1))
    of_end = int(_places(known_words, np.array([END]))[0])
    end_known = int(known_counts[of_end] > 0)
    for batch in batches:
        for part in text_slices(batch, "text", 24 << 20):
            # Hashing holds many bytes for each of the text's, the network few for each token.
            tokens, sizes, own, base, known, asked, times, asks = ([] for _ in range(8))
            for small in text_slices(part, "text", SLICE):
                n = small.num_rows
                words = words_of(small.column("text"))
                (h, shape), doc = word_codes(words), words.doc
                at = _places(known_words, h)
                counted = at < len(known_words)
                token = token_of[at]
                tail = np.flatnonzero(token < 0)
                # Every tail word without a count as if unseen; later look-ups correct it.
                of_shape = shape[tail]
                terms = np.where(counted[tail], log_seen[of_shape] + log_counts[at[tail]], log_unseen[of_shape])
                token[tail] = HEAD + of_shape
                seq, begins = _sequences(words, token, end_token)
                own.append(np.bincount(doc[tail], weights=terms, minlength=n))
                base.append(np.bincount(doc, weights=base_of[at], minlength=n) + base_of[of_end])
                known.append(np.bincount(doc, weights=counted, minlength=n).astype(np.int64) + end_known)
                tokens.append(seq)
                sizes.append(np.diff(begins))
                rare = np.flatnonzero(~counted)
                rare = rare[np.lexsort((h[rare], doc[rare]))]
                fresh = np.ones(len(rare), dtype=bool)  # a word is asked for once a text
                fresh[1:] = (h[rare][1:] != h[rare][:-1]) | (doc[rare][1:] != doc[rare][:-1])
                at = np.flatnonzero(fresh)
                asked.append(h[rare[at]])
                times.append(np.diff(np.append(at, len(rare))))
                asks.append(np.bincount(doc[rare[at]], minlength=n))
            sizes = np.concatenate(sizes)
            own = np.concatenate(own) + net.score(np.concatenate(tokens), np.concatenate([[0], np.cumsum(sizes)]), end_token) / np.log(10)
            cuts = np.concatenate([[0], np.cumsum(np.concatenate(asks))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    part.column("row"),
                    pa.array(sizes),
                    pa.array(np.concatenate(known)),
                    pa.array(np.concatenate(base)),
                    pa.array(own),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(asked).view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(times).astype(np.int32))),
                ],
                names=["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "score", "word", "times"],
            )


def frequent_words(counts: DataFrame, most: int) -> list[tuple[int, int, int]]:
    """(word, shape, n) of the most frequent words, at most ``most``, by falling count.

    Counts fall into steps of a sixteenth of a power of e, some hundreds in all; the words of
    the highest steps that fit are taken. So tasks send no more than what is kept.
    """
    step = F.floor(F.log("n") * 16).cast("int")
    levels = sorted((r[0], r[1]) for r in counts.groupBy(step.alias("level")).count().collect())
    held, least = 0, None
    for level, n in reversed(levels):
        if held + n > most:
            break
        held, least = held + n, level
    if least is None:
        return []
    rows = counts.where(step >= least).select("word", "shape", "n").collect()  # ``most`` rows
    return sorted((tuple(r) for r in rows), key=lambda r: (-r[2], r[0]))


def score_texts(docs: DataFrame, parts: int = 5, held_out: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each row of ``docs``.

    The rows outside the held-out fold are the training texts; a null id is not held out. Null and
    empty texts have one token, the end. Without training texts all words are unknown. Words are
    told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(fold("doc_id", parts) == held_out, F.lit(False)).alias("held_out"),
        docs["text"].cast("string").alias("text"),
    )
    training = rows.where("not held_out").select("text")
    counted = training.mapInArrow(_count, "word long, shape int, n long")
    counts = cut(counted.groupBy("word").agg(F.max("shape").alias("shape"), F.sum("n").alias("n")))

    totals = counts.agg(F.sum("n"), F.count("*")).first()
    tokens_n, types_n = int(totals[0] or 0), int(totals[1] or 0)
    end = int(END)
    ends = counts.where(F.col("word") == end).agg(F.sum("n")).first()[0] or 0
    frequent = frequent_words(counts.where(F.col("word") != end), TABLE)
    heads = sorted([(end, -1, ends), *frequent[: HEAD - 1]], key=lambda r: (-r[2], r[0]))
    by_hash = lambda pairs, kind: [
        np.array(x) for x in zip(*sorted((np.int64(w).astype(np.uint64), kind(v)) for w, v in pairs), strict=True)
    ]
    head, head_token = by_hash([(w, i) for i, (w, _, _) in enumerate(heads)], np.int64)
    known, known_counts = by_hash([(end, ends), *((w, n) for w, _, n in frequent)], np.int64)

    # Shape classes: all words outside the head.
    head_rows = spark.createDataFrame([(w,) for w, _, _ in heads], "word long")
    tail = counts.join(F.broadcast(head_rows), "word", "left_anti").groupBy("shape").agg(
        F.sum("n").alias("mass"), F.sum((F.col("n") == 1).cast("long")).alias("once")
    )
    mass, once = np.zeros(SHAPES), np.zeros(SHAPES)
    for shape, n, single in tail.collect():  # SHAPES rows
        mass[shape], once[shape] = n, single
    unseen = (once + 1) / (mass + 2)
    word_n = np.array([n for _, _, n in heads] + [0] * (HEAD - len(heads)), dtype=float)
    class_n = np.append(word_n.reshape(HEAD_CLASSES, CLASS_SIZE).sum(axis=1), mass.sum())
    token_n = np.concatenate([word_n + 1e-3, mass + 0.5])
    model = GatedModel.start(np.log(class_n + 0.5), np.log(token_n))

    send = spark.sparkContext.broadcast
    head_b, token_b = send(head), send(head_token)  # HEAD entries
    texts = rows.where("not held_out").select("doc_id", "text")
    cuts = texts.mapInArrow(partial(_stretches, head=head_b, head_token=token_b), "doc_id long, nth long, copy long, tokens binary")
    model = train_in_rounds(model, cut(cuts))

    work = partial(
        _score, model=send(model), head=head_b, head_token=token_b, table_words=send(known), table_counts=send(known_counts),
        shape_unseen=unseen, shape_mass=mass, tokens_n=tokens_n, types_n=types_n,
    )
    schema = "doc_id long, held_out boolean, row long, n_tokens long, n_known long, base_score double, score double, word array<long>, times array<int>"
    scored = cut(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(work, schema))

    # Rarer words meet their counts where both are hashed to.
    asked = scored.select("row", F.inline(F.arrays_zip("word", "times")))
    shape_table = spark.createDataFrame([(i, float(unseen[i]), float(mass[i])) for i in range(SHAPES)], "shape int, unseen double, mass double")
    found = asked.join(counts, "word").join(F.broadcast(shape_table), "shape")
    times, c = F.col("times"), F.col("n")
    gain = F.log10((1 - F.col("unseen")) * c / F.col("mass")) - F.log10("unseen")
    more = found.select(
        "row",
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("boolean").alias("held_out"),
        F.lit(0).cast("long").alias("n_tokens"),
        times.cast("long").alias("n_known"),
        (times * (F.log10(c + 0.5) - F.log10(F.lit(0.5)))).alias("base_score"),
        (times * gain).alias("score"),
    )
    parts_of = scored.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score").unionAll(more)
    whole = parts_of.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        *(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")),
    )
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens_n).cast("long").alias("train_tokens"), "base_score", "score"
    )
