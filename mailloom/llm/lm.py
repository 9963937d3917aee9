"""Scores of whole documents by a gated recurrent language model.

Counts first.  Documents are dealt into blocks of bounded size by a hash; each
block sends its distinct tokens, with their training counts, to the owners of
ranges of the token hash, which add up and answer every block with the counts
of exactly its tokens.  So a frequent token is sent once per block, and nobody
holds the vocabulary.

The model is a gated recurrent unit in numpy over the most frequent tokens, with
a softmax factored into classes, and those into groups where there are many; the ``HEAD`` most frequent entries
are chosen beside them at once.  The number of tokens grows with the distinct training
tokens (``vocabulary_size``).  It is trained by truncated backpropagation on all
training documents: in each of ``ROUNDS`` rounds every partition starts from the
same weights and walks through its documents, then the weights are averaged by
token counts.  Each document is in one of the rounds, at every size; long ones
are learned from in stretches of ``SEGMENT`` tokens side by side.  Other tokens share
one entry of the model, divided by their training counts.  Scoring walks through the documents of a block side by side,
in windows; the state goes from window to window, so a document of any length
is scored as a whole.

Null text counts as empty: it has the end token alone.  Repeated rows count as
often as they occur and share a block, as do rows whose id and text are equal.
A very long text makes a block of its size.  Only id and text are read, so other
columns may have any names.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored, text_blocks
from .minhash import word_hashes

BLOCK_BYTES = 8_000_000
VOCABULARY = 2000  # modelled tokens at least, where there are so many
HIDDEN, CLASS_SIZE, WINDOW = 24, 48, 16
HEAD = 12  # most frequent entries, chosen directly beside the groups or classes of the others
BATCH, LARGE_BATCH = 96, 512
# Each document is learned from in one of the rounds, whatever the size of the table.
ROUNDS = 3
# Longer documents are learned from in stretches of so many tokens side by side; scoring never cuts them.
SEGMENT = 512
# Training partitions hold at least so many bytes, and more than the second only where all cores have one.
_PART_BYTES, _FULL_PART_BYTES, _CHUNK_BYTES = 32_000_000, 512_000_000, 8_000_000
_SHARD = 2048  # vocabulary rows that are averaged together
_MOVED = 32768  # weights that are moved together, so that they stay in the cache
_TARGETS, _BLOCK = 8192, 16  # targets that are taken together, and those of one choice
_SCORED, _GATHERED = 65536, 1024  # tokens of a scoring window, if its documents are few, and those that are looked up together
END = np.uint64(0x5851F42D4C957F2D)  # stands for the end token; words have other hashes but by chance
_RANGE_BYTES = 16_000_000  # of text for each hash range


def vocabulary_size(distinct: int) -> int:
    """Modelled tokens for so many distinct training tokens; the weights have about 100 numbers for each."""
    return min(distinct, max(VOCABULARY, int(distinct ** (2 / 3))))


def token_hashes(texts: list[str | None], chars: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each with its end token, and the tokens of each text."""
    words, counts, i = [], [], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= chars):
            size += len(texts[j] or "")
            j += 1
        w, n = word_hashes(texts[i:j])
        full = np.full(len(w) + len(n), END)
        stop = np.cumsum(n + 1)
        own = np.ones(len(full), bool)
        own[stop - 1] = False
        full[own] = w
        words.append(full)
        counts.append(n + 1)
        i = j
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(words), np.concatenate(counts)


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Ranges of equal width of the hash; rising with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _ask(ranges: int):
    """A block's distinct tokens and their training counts, one row per hash range."""
    def run(block: pa.Table) -> pa.Table:
        tokens, n = token_hashes(block.column("_text").to_pylist())
        train = np.repeat(block.column("_train").to_numpy(), n)
        distinct, inverse = np.unique(tokens, return_inverse=True)
        counts = np.bincount(inverse, train, len(distinct)).astype(np.int64)
        edge = np.searchsorted(_range_of(distinct, ranges), np.arange(ranges + 1))
        parts = [(k, distinct[a:b].tobytes(), counts[a:b].tobytes())
                 for k, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())) if a < b]
        b = block.column("_block")[0].as_py()
        k, h, c = zip(*parts)
        return pa.table({"_block": pa.array([b] * len(k), pa.int32()), "_range": pa.array(k, pa.int32()),
                         "_hashes": pa.array(h, pa.binary()), "_counts": pa.array(c, pa.binary())})
    return run


def _answer(ranges: int):
    """Adds up a hash range; answers each block, and names the range's totals and its most frequent tokens.

    The hash deals the modelled tokens evenly, so twice a range's share and
    ``VOCABULARY`` more hold all of them.
    """
    def run(asked: pa.Table) -> pa.Table:
        blocks = asked.column("_block").to_pylist()
        hashes = [np.frombuffer(x, np.uint64) for x in asked.column("_hashes").to_pylist()]
        counts = [np.frombuffer(x, np.int64) for x in asked.column("_counts").to_pylist()]
        distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, inverse, np.concatenate(counts))
        stop = np.cumsum([len(h) for h in hashes])
        replies = [total[inverse[s - len(h):s]].tobytes() for s, h in zip(stop, hashes)]
        top = VOCABULARY + 2 * vocabulary_size(int((total > 0).sum()) * ranges) // ranges
        best = np.lexsort((distinct, -total))[:top]
        best = best[total[best] > 0]
        k = asked.column("_range")[0].as_py()
        known = total > 0
        return pa.table({
            "_block": pa.array([*blocks, -1], pa.int32()), "_range": pa.array([k] * (len(blocks) + 1), pa.int32()),
            "_counts": pa.array([*replies, total[best].tobytes()], pa.binary()),
            "_top": pa.array([None] * len(blocks) + [distinct[best].tobytes()], pa.binary()),
            "_n": pa.array([None] * len(blocks) + [int(total.sum())], pa.int64()),
            "_v": pa.array([None] * len(blocks) + [int(known.sum())], pa.int64())})
    return run


def _merge_top(size: int):
    """The ``size`` most frequent tokens of all ranges, from those of each range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for h, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = np.concatenate((hashes, np.frombuffer(h, np.uint64)))
                counts = np.concatenate((counts, np.frombuffer(c, np.int64)))
                if len(hashes) > 4 * size:
                    best = np.lexsort((hashes, -counts))[:size]
                    hashes, counts = hashes[best], counts[best]
        best = np.lexsort((hashes, -counts))[:size]
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashes[best].tobytes()], pa.binary()), pa.array([counts[best].tobytes()], pa.binary())],
            names=["_top", "_counts"])
    return run


@dataclass
class Vocabulary:
    """The model's tokens: sorted hashes, their ids from 1 by frequency (0: others), and count totals."""

    hashes: np.ndarray
    ids: np.ndarray
    tokens: int        # N
    distinct: int      # V
    inside: int        # training tokens that the model knows
    size: int
    learned: int = 0   # tokens that training went through, over all rounds

    def encode(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(tokens), np.int64)
        # The first place of each prefix; there are about four prefixes for each hash, so few tokens move on from it.
        bits = max(1, (4 * len(self.hashes)).bit_length())
        shift = np.uint64(64 - bits)
        start = np.cumsum(np.bincount((self.hashes >> shift).astype(np.int64) + 1, minlength=(1 << bits) + 1))
        at = np.minimum(start[(tokens >> shift).astype(np.int64)], len(self.hashes) - 1)
        own = self.hashes[at]
        more = np.flatnonzero(own < tokens)
        while len(more):
            at[more] = np.minimum(at[more] + 1, len(self.hashes) - 1)
            own[more] = self.hashes[at[more]]
            more = more[(own[more] < tokens[more]) & (at[more] < len(self.hashes) - 1)]
        return np.where(own == tokens, self.ids[at], 0)

    @property
    def other_mass(self) -> float:
        return self.tokens - self.inside + 0.5 * (self.distinct - len(self.hashes) + 1)


def _choices(rows: np.ndarray, met: np.ndarray, size: int, fill: float) -> np.ndarray:
    """Stretches of ``size`` rows with the given numbers, rising; the last of all may be short and is filled up."""
    whole = len(rows) // size
    full = int(np.searchsorted(met, whole))
    stretches = rows[:whole * size].reshape(whole, size, *rows.shape[1:])
    if full == len(met):
        return stretches.take(met, 0)
    out = np.full((len(met), size, *rows.shape[1:]), fill, rows.dtype)
    out[:full] = stretches.take(met[:full], 0)
    out[full:, :len(rows) - whole * size] = rows[whole * size:]
    return out


def _add_choices(rows: np.ndarray, met: np.ndarray, size: int, more: np.ndarray) -> None:
    """Adds to the stretches that :func:`_choices` gives."""
    whole = len(rows) // size
    if met[-1] >= whole:
        rows[whole * size:] += more[-1, :len(rows) - whole * size]
        met, more = met[:-1], more[:-1]
    if len(rows) and rows.flags.c_contiguous:
        rows[:whole * size].reshape(whole, size, *rows.shape[1:])[met] += more
    else:
        for i, x in zip(met.tolist(), more):
            rows[i * size:(i + 1) * size] += x


def _run_sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs of rows, each from its first one to the next run."""
    if len(first) == len(x):
        return x
    n, out = np.diff(first, append=len(x)), x.take(first, 0)
    # Longest runs first, so that those that go on stand together.
    some = np.flatnonzero(n > 1)
    some = some[np.argsort(-n[some], kind="stable")]
    first, n, sums = first[some], n[some], out.take(some, 0)
    for j, more in enumerate(len(n) - np.searchsorted(n[::-1], np.arange(2, min(17, n[0] + 1))) if len(n) else (), 1):
        sums[:more] += x.take(first[:more] + j, 0)
    for i in range(int(np.count_nonzero(n > 16))):
        sums[i] += x[first[i] + 16:first[i] + n[i]].sum(0)
    out[some] = sums
    return out


def _order(numbers: np.ndarray, most: int) -> np.ndarray:
    """The order of numbers below ``most``; short ones have a radix sort."""
    return np.argsort(numbers.astype(np.uint16) if most <= 1 << 16 else numbers, kind="stable")


def _met(numbers: np.ndarray, most: int) -> np.ndarray:
    """The distinct ones of some numbers from 0 and below ``most``, rising."""
    return np.flatnonzero(np.bincount(numbers.ravel(), minlength=most))


class GatedModel:
    """Gated recurrent unit with a class-factored softmax, in single precision.

    Where there are more classes than words in one, they are factored again, into groups, so that the
    numbers a token costs hardly grow with the vocabulary.
    """

    def __init__(self, size: int, hidden: int = HIDDEN, class_size: int | None = None, seed: int = 7):
        class_size = class_size or max(CLASS_SIZE, int(np.ceil(np.cbrt(size))))
        r = np.random.default_rng(seed)
        self.head = HEAD if size > max(HEAD, class_size) else 0
        self.hidden, self.class_size, self.classes = hidden, class_size, -(-(size - self.head) // class_size)
        # Classes in a group; one group of all where there are few.
        self.fan = self.classes if self.classes <= class_size else int(np.ceil(np.sqrt(self.classes)))
        self.groups = -(-self.classes // self.fan)
        small = lambda *shape: (r.standard_normal(shape) * 0.1).astype(np.float32)
        self.w = {"x": small(size, 3 * hidden), "u": small(hidden, 2 * hidden), "n": small(hidden, hidden),
                  "c": small(hidden, self.classes), "cb": np.zeros(self.classes, np.float32),
                  "o": small(size, hidden), "ob": np.zeros(size, np.float32)}
        if self.groups > 1:
            self.w |= {"g": small(hidden, self.groups), "gb": np.zeros(self.groups, np.float32)}

    def _inputs(self, ids: np.ndarray) -> np.ndarray:
        """What tokens add to both gates and the candidate, three arrays of rows side by side."""
        x = self.w["x"].reshape(-1, self.hidden)
        return x.take(3 * ids + np.arange(3).reshape(3, *[1] * ids.ndim), 0)

    def _gate_weights(self) -> np.ndarray:
        """The weights of both gates, one after the other."""
        return np.ascontiguousarray(self.w["u"].reshape(self.hidden, 2, self.hidden).transpose(1, 0, 2))

    def _gates(self, h: np.ndarray, x: np.ndarray, u: np.ndarray, gates: np.ndarray, rh: np.ndarray, n: np.ndarray,
               new: np.ndarray) -> None:
        """Fills both gates (the first one as what is left to 1), the state behind the reset gate, candidate and new state."""
        np.matmul(h, u, out=gates)
        gates += x[:2]
        # Where this is infinite, the logistic function is 0 or 1, as it should be.
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.subtract(1, gates[1], out=gates[1])
        np.multiply(gates[1], h, out=rh)
        np.matmul(rh, self.w["n"], out=n)
        n += x[2]
        np.tanh(n, out=n)
        np.subtract(n, h, out=new)
        new *= gates[0]
        new += h

    def _levels(self):
        """Weights by row, biases, rows of a choice and rows per target of each level below the first, words first."""
        yield "o", "ob", self.class_size, 1
        if self.groups > 1:
            yield "c", "cb", self.fan, self.class_size

    @property
    def _first(self) -> tuple[str, str, int]:
        """Weights and biases of the first level, and the entries behind the head that one of its rows has."""
        return ("g", "gb", self.class_size * self.fan) if self.groups > 1 else ("c", "cb", self.class_size)

    def log_probs(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each target after the states ``h``; fills gradients of its negative sum."""
        own = 1 + (target - self.head) // self.class_size
        own[target < self.head] = 0
        order = _order(own, self.classes + 1)
        hs, ts = h.take(order, 0), target[order] - self.head
        found, dhs = np.zeros(len(ts), h.dtype), None if grads is None else np.zeros_like(hs)
        top, top_bias, per = self._first
        head = slice(None, self.head)
        first = np.concatenate((self.w["o"][head], self.w[top].T)), np.concatenate((self.w["ob"][head], self.w[top_bias]))
        to_first = None if grads is None else tuple(np.zeros_like(x) for x in first)
        # The head by itself: it needs no other choice.
        n = int(np.count_nonzero(own == 0))
        cuts = [*range(0, n, _TARGETS), *range(n, len(ts), _TARGETS), len(ts)]
        for a, b in zip(cuts, cuts[1:]):
            part, t = slice(a, b), ts[a:b]
            dh = None if grads is None else dhs[part]
            at = t + self.head if a < n else t // per + self.head
            self._choice(*first, len(first[0]), hs[part], at, found[part], dh, to_first)
            for rows, bias, size, each in self._levels() if a >= n else ():
                behind = slice(self.head if rows == "o" else 0, None)
                w, to_w = (None if x is None else x[rows][behind] if rows == "o" else x[rows].T for x in (self.w, grads))
                self._choice(w, self.w[bias][behind], size, hs[part], t // each, found[part], dh,
                             None if grads is None else (to_w, grads[bias][behind]))
        out = np.empty_like(found)
        out[order] = found
        if grads is None:
            return out, None
        for k, bias, x, y in (("o", "ob", to_first[0][head], to_first[1][head]),
                              (top, top_bias, to_first[0][self.head:], to_first[1][self.head:])):
            into = grads[k][head] if k == "o" else grads[k].T
            into += x
            grads[bias][head if k == "o" else slice(None)] += y
        dh = np.empty_like(dhs)
        dh[order] = dhs
        return out, dh

    def _choice(self, w: np.ndarray, bias: np.ndarray, size: int, hs: np.ndarray, at: np.ndarray, found: np.ndarray,
                dhs: np.ndarray | None, grads: tuple[np.ndarray, np.ndarray] | None) -> None:
        """Adds to ``found`` the log-probability of each row in ``at``, rising by choices, among its ``size`` neighbours.

        Targets of one choice lie in blocks of ``_BLOCK`` side by side, the last one filled up with zero
        states, so that all choices are a few products of stacked matrices.
        """
        k = self.hidden
        own = at // size
        edge = np.concatenate(([0], np.flatnonzero(own[1:] != own[:-1]) + 1))
        met, slot = own[edge], slice(None)
        if len(edge) == 1:
            of, h, block, first = met, hs[None], len(at), edge
            place = at - own * size + np.arange(0, len(at) * size, size)
        else:
            n = np.diff(edge, append=len(at))
            block = _BLOCK if len(at) < 8 * _BLOCK * len(edge) else 8 * _BLOCK
            blocks = -(-n // block)
            first = np.cumsum(blocks) - blocks
            # The place of each target among the blocks, and the choice of each block.
            slot = np.arange(len(at)) + np.repeat(first * block - edge, n)
            of = np.repeat(met, blocks)
            h = np.zeros((len(of) * block, k), hs.dtype)
            h[slot] = hs
            h = h.reshape(-1, block, k)
            place = slot * size + (at - own * size)
        wk, bk = _choices(w, of, size, 0.0), _choices(bias, of, size, -np.inf)
        bk -= bk.max(1, keepdims=True)
        e = np.matmul(h, wk.transpose(0, 2, 1))
        e += bk[:, None]
        flat, ones = e.reshape(-1, size), np.ones(size, e.dtype)
        right = flat.ravel().take(place)
        # States lie within -1 and 1, so the biases alone keep nearly all sums in range.
        with np.errstate(over="ignore"):
            np.exp(flat, out=flat)
            total = flat @ ones
        if not (np.isfinite(total).all() and total.min() > 1e-30):
            np.matmul(h, wk.transpose(0, 2, 1), out=e)
            e += bk[:, None]
            top = flat.max(1)
            flat -= top[:, None]
            np.exp(flat, out=flat)
            right, total = right - top[slot], flat @ ones
        used = total[slot]
        found += right - np.log(used)
        if grads is None:
            return
        share = np.zeros(len(flat), e.dtype)
        share[slot] = 1 / used
        flat *= share[:, None]
        flat.reshape(-1)[place] -= 1
        back = np.matmul(e, wk).reshape(-1, k)
        dhs += back if len(edge) == 1 else back.take(slot, 0)
        to_w, to_b = np.matmul(e.transpose(0, 2, 1), h), np.matmul(np.ones((1, block), e.dtype), e)
        _add_choices(grads[0], met, size, _run_sums(to_w, first))
        _add_choices(grads[1], met, size, _run_sums(to_b[:, 0], first))

    def window(self, h: np.ndarray, ids: np.ndarray, target: np.ndarray, live: np.ndarray,
               grads: dict | None = None) -> tuple[np.ndarray, dict, float]:
        """One truncated backpropagation window (rows x steps): new state, gradients, loss.

        ``grads`` are arrays of zeros to fill.
        """
        grads = grads or {k: np.zeros_like(v) for k, v in self.w.items()}
        k, (rows, steps), live = self.hidden, ids.shape, live.T
        seen, u = ids.T.ravel(), self._gate_weights()
        inputs = self._inputs(seen).reshape(3, steps, rows, k)
        # By step: the states before and after, gates, states behind the reset gate and candidates.
        hs, gates, rh, ns = (np.empty(shape, h.dtype) for shape in (
            (steps + 1, rows, k), (2, steps, rows, k), (steps, rows, k), (steps, rows, k)))
        hs[0] = h
        with np.errstate(over="ignore"):
            for t in range(steps):
                self._gates(hs[t], inputs[:, t], u, gates[:, t], rh[t], ns[t], hs[t + 1])
        before, after, rs, zs = hs[:-1], hs[1:], gates[1], 1 - gates[0]
        at = np.flatnonzero(live)
        out, d = self.log_probs(after.reshape(-1, k).take(at, 0), target.T.ravel()[at], grads)
        dout = np.zeros_like(after)
        dout.reshape(-1, k)[at] = d
        to_n = gates[0] * (1 - ns * ns)
        to_z = (before - ns) * zs * gates[0]
        to_r = rh * (1 - rs)
        into = inputs  # of no use any more
        dh, u, n = np.zeros_like(h), np.ascontiguousarray(u.transpose(0, 2, 1)), np.ascontiguousarray(self.w["n"].T)
        drh, back = np.empty_like(h), np.empty((2, *h.shape), h.dtype)
        for t in range(steps - 1, -1, -1):
            dh += dout[t]
            np.multiply(dh, to_n[t], out=into[2, t])
            np.matmul(into[2, t], n, out=drh)
            np.multiply(dh, to_z[t], out=into[0, t])
            np.multiply(drh, to_r[t], out=into[1, t])
            np.matmul(into[:2, t], u, out=back)
            dh *= zs[t]
            drh *= rs[t]
            dh += drh
            dh += back[0]
            dh += back[1]
        into, before = into.reshape(3, -1, k), before.reshape(-1, k)
        grads["n"] += rh.reshape(-1, k).T @ into[2]
        for i in range(2):
            grads["u"][:, i * k:(i + 1) * k] += before.T @ into[i]
        order = _order(seen, len(self.w["x"]))
        seen = seen[order]
        edge = np.flatnonzero(np.diff(seen, prepend=-1))
        by_token = into.reshape(-1, k).take(order[:, None] + np.arange(0, 3 * len(order), len(order)), 0)
        grads["x"][seen[edge]] = _run_sums(by_token.reshape(-1, 3 * k), edge)
        return hs[-1], grads, -float(out.sum())


def _lanes(lengths: np.ndarray, rows: np.ndarray, start: np.ndarray, t: int | np.ndarray, width: int):
    """Places and validity of a window, from token ``t`` on, for the given documents."""
    place = t + np.arange(width)
    live = place < lengths[rows][:, None]
    return start[rows][:, None] + np.where(live, place, 0), live


def first_weights(frequency: np.ndarray) -> dict[str, np.ndarray]:
    """Weights before training; the biases follow the frequencies of the model's entries."""
    model = GatedModel(len(frequency))
    behind = np.arange(len(frequency) - model.head)
    model.w["ob"] += np.log(frequency).astype(np.float32)
    for bias, per in {"cb": model.class_size, model._first[1]: model._first[2]}.items():
        model.w[bias] += np.log(np.bincount(behind // per, frequency[model.head:])).astype(np.float32)
    return model.w


class Trainer:
    """Adam over windows of many documents side by side; the state is carried from window to window.

    Rows of the vocabulary move only in the windows that meet them.
    """

    def __init__(self, weights: dict[str, np.ndarray], rate: float, seed: int = 7):
        self.model = GatedModel(len(weights["ob"]))
        self.model.w = {k: x.copy() for k, x in weights.items()}
        self.m = {k: np.zeros_like(x) for k, x in weights.items()}
        self.v = {k: np.zeros_like(x) for k, x in weights.items()}
        self.grads = {k: np.zeros_like(x) for k, x in weights.items()}
        self.rate, self.step, self.rng = rate, 0, np.random.default_rng(seed)

    def learn(self, ids: np.ndarray, lengths: np.ndarray, end: int) -> None:
        start = np.cumsum(lengths) - lengths
        before = np.concatenate(([end], ids[:-1])) if len(ids) else ids
        before[start] = end
        # Stretches of long documents, so that windows stay full.
        pieces = -(-lengths // SEGMENT)
        place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        lengths = np.minimum(SEGMENT, np.repeat(lengths, pieces) - place * SEGMENT)
        start, order = np.repeat(start, pieces) + place * SEGMENT, np.argsort(-lengths, kind="stable")
        # Lanes of about equally many windows, by dealing forth and back; the next stretch follows in its
        # lane at once, so that windows stay full.
        lanes = min(max(BATCH, len(order) // 8), LARGE_BATCH)
        turn = np.arange(len(order)) % (2 * lanes)
        lane = np.empty(len(order), np.int64)
        lane[order] = np.minimum(turn, 2 * lanes - 1 - turn)
        windows = -(-lengths // WINDOW)
        order = np.lexsort((self.rng.random(len(order)), lane))
        begin = np.cumsum(windows[order]) - windows[order]
        begin -= np.repeat(begin[np.flatnonzero(np.diff(lane[order], prepend=-1))], np.bincount(lane)[np.unique(lane)])
        piece = np.repeat(order, windows[order])
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(windows[order]) - windows[order], windows[order])
        time = np.repeat(begin, windows[order]) + nth
        by_time = np.argsort(time, kind="stable")
        state = np.zeros((lanes, self.model.hidden), np.float32)
        for now in np.split(by_time, np.cumsum(np.bincount(time))[:-1]):
            rows, t = piece[now], nth[now] * WINDOW
            h = state[lane[rows]]
            h[t == 0] = 0
            at, live = _lanes(lengths, rows, start, t[:, None], WINDOW)
            state[lane[rows]], grads, _ = self.model.window(h, before[at], ids[at], live, self.grads)
            self._move(grads, before[at], ids[at][live])

    def _move(self, grads: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray) -> None:
        self.step += 1
        step, size, head = self.step, self.model.class_size, self.model.head
        rate = float(self.rate * min(1, step / 20) * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step))
        behind = targets[targets >= head] - head
        met, whole = _met(behind // size, self.model.classes), (len(self.model.w["ob"]) - head) // size
        for k, g in grads.items():
            if k not in _ROWS:
                self._adam(k, g, 0, slice(None), 1, rate, len(targets))
                continue
            rows, per, begin = (_met(inputs, len(g)), 1, 0) if k == "x" else (met[met < whole], size, head)
            step = max(1, _MOVED // (per * g[:1].size))
            for i in range(0, len(rows), step):
                self._adam(k, g, begin, rows[i:i + step], per, rate, len(targets))
            if k != "x" and head and len(behind) < len(targets):
                self._adam(k, g, 0, slice(None, head), 1, rate, len(targets))
            if k != "x" and len(met) and met[-1] == whole:  # a last class of fewer words
                self._adam(k, g, begin, slice(whole * size, None), 1, rate, len(targets))

    def _adam(self, k: str, grads: np.ndarray, begin: int, at: np.ndarray | slice, per: int, rate: float, n: int) -> None:
        """Moves the given stretches of ``per`` rows, counted from row ``begin``."""
        g, m, v, w = ((x[:len(x) // per * per].reshape(len(x) // per, -1) if per > 1 else x)
                      for x in (y[begin:] for y in (grads, self.m[k], self.v[k], self.model.w[k])))
        some = (lambda x: x.take(at, 0)) if isinstance(at, np.ndarray) else (lambda x: x[at].copy())
        d, mean, square = some(g), some(m), some(v)
        g[at] = 0  # for the next window
        d *= 0.1 / max(1, n)
        mean *= 0.9
        mean += d
        d *= d  # a hundredth of the square
        square *= 0.99
        square += d
        m[at], v[at] = mean, square
        np.sqrt(square, out=square)
        square += 1e-6
        mean *= rate
        mean /= square
        w[at] -= mean


def document_scores(model: GatedModel, ids: np.ndarray, lengths: np.ndarray, end: int, width: int = 32,
                    lanes: int = 512) -> np.ndarray:
    """Natural log-probability of each document's model ids, end included."""
    start, order = np.cumsum(lengths) - lengths, np.argsort(-lengths, kind="stable")
    before = np.concatenate(([end], ids[:-1])) if len(ids) else ids
    before[start] = end
    out, k, u = np.zeros(len(lengths)), model.hidden, model._gate_weights()
    for i in range(0, len(order), lanes):
        rows = order[i:i + lanes]
        h = np.zeros((len(rows), k), np.float32)
        t, longest = 0, int(lengths[rows[0]])
        while t < longest:
            rows = rows[lengths[rows] > t]
            # Few documents go on for longer at once.
            steps = min(max(width, _SCORED // len(rows)), longest - t)
            at, live = (x.T for x in _lanes(lengths, rows, start, t, steps))
            t += steps
            states = np.empty((steps + 1, len(rows), k), np.float32)
            states[0] = h[:len(rows)]
            now, gates, rh, n = before[at], *(np.empty((m, len(rows), k), np.float32) for m in (2, 1, 1))
            ahead = max(1, _GATHERED // len(rows))
            with np.errstate(over="ignore"):
                # Longer documents come first, so those that go on are the first m.
                for j, m in enumerate(live.sum(1).tolist()):
                    if j % ahead == 0:
                        inputs = model._inputs(now[j:j + ahead, :m])
                    model._gates(states[j, :m], inputs[:, j % ahead, :m], u, gates[:, :m], rh[0, :m], n[0, :m],
                                 states[j + 1, :m])
            h, here = states[-1], np.flatnonzero(live)
            found = np.zeros(live.shape)
            found.reshape(-1)[here] = model.log_probs(
                states[1:].reshape(-1, k).take(here, 0), ids[at.reshape(-1)[here]])[0]
            out[rows] += found.sum(0)
    return out


_ROWS, _REST = ("x", "o", "ob"), ("u", "n", "c", "cb", "g", "gb")
_SHARD_SCHEMA = "shard int, n long, seen binary, w binary"


def _pack(w: dict[str, np.ndarray], seen: np.ndarray, n: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Weights in shards: -1 has what is not by token, the others ``_SHARD`` rows of the vocabulary each."""
    yield -1, n, b"", b"".join(w[k].tobytes() for k in _REST if k in w)
    for i in range(0, len(seen), _SHARD):
        rows = np.concatenate([w[k][i:i + _SHARD].reshape(len(seen[i:i + _SHARD]), -1) for k in _ROWS], 1)
        yield i // _SHARD, n, seen[i:i + _SHARD].tobytes(), rows.tobytes()


def _unpack(shards: list[tuple[int, bytes]], like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    shards, w = sorted(shards), {}
    rest, at = np.frombuffer(shards[0][1], np.float32), 0
    for k in (k for k in _REST if k in like):
        w[k] = rest[at:at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    rows = np.frombuffer(b"".join(x for _, x in shards[1:]), np.float32).reshape(len(like["ob"]), -1)
    a, b = like["x"].shape[1], like["o"].shape[1]
    return w | {"x": rows[:, :a].copy(), "o": rows[:, a:a + b].copy(), "ob": rows[:, a + b].copy()}


def _train_task(held, end: int, rate: float):
    """Truncated backpropagation over all documents of a partition, from the weights held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = held.value
        trainer, seen, n = None, np.zeros(vocabulary.size, np.float32), 0
        for batch in text_blocks(batches, _CHUNK_BYTES):
            tokens, lengths = token_hashes(batch.column(0).to_pylist())
            ids = vocabulary.encode(tokens)
            trainer = trainer or Trainer(weights, rate)
            trainer.learn(ids, lengths, end)
            seen += np.bincount(ids, minlength=len(seen)).astype(np.float32)
            n += len(ids)
        if trainer:
            for row in _pack(trainer.model.w, seen, n):
                yield pa.RecordBatch.from_pylist([dict(zip(("shard", "n", "seen", "w"), row))], pa.schema(
                    [("shard", pa.int32()), ("n", pa.int64()), ("seen", pa.binary()), ("w", pa.binary())]))
    return run


def _average(parts: pa.Table) -> pa.Table:
    """Mean of a shard by tokens; of a vocabulary row by the times a partition met it, and a little by tokens."""
    shard, n = parts.column("shard")[0].as_py(), parts.column("n").to_numpy()
    total, mass = 0.0, 0.0
    for tokens, s, w in zip(n, parts.column("seen").to_pylist(), parts.column("w").to_pylist()):
        by = np.frombuffer(s, np.float32).astype(float)[:, None] + 1e-3 * tokens / n.sum() if s else float(tokens)
        w = np.frombuffer(w, np.float32)
        total, mass = total + by * (w.reshape(len(by), -1) if s else w), mass + by
    return pa.table({"shard": pa.array([shard], pa.int32()), "n": pa.array([int(n.sum())], pa.int64()),
                     "seen": pa.array([b""], pa.binary()), "w": pa.array([(total / mass).astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, vocabulary: Vocabulary, frequency: np.ndarray, size: int, doc_id: str, text: str) -> tuple[dict, int]:
    """Weights learned from all of ``docs``, of about ``size`` bytes, and the tokens that training went through."""
    spark, learned = docs.sparkSession, 0
    weights, end = first_weights(frequency), int(vocabulary.encode(np.array([END]))[0])
    parts = max(1, min(-(-size // _PART_BYTES), max(spark.sparkContext.defaultParallelism, -(-size // _FULL_PART_BYTES))))
    for turn in range(ROUNDS):
        own = docs.where(F.pmod(F.xxhash64(F.lit(1), F.col(doc_id), F.col(text)), F.lit(ROUNDS)) == turn)
        held = spark.sparkContext.broadcast((vocabulary, weights))
        found = own.select(F.col(text).cast("string")).repartition(parts).mapInArrow(
            _train_task(held, end, 0.02 * 0.3 ** turn), _SHARD_SCHEMA).groupBy("shard").applyInArrow(
            _average, _SHARD_SCHEMA).select("shard", "n", "w").collect()
        if found:
            weights = _unpack([(r["shard"], r["w"]) for r in found], weights)
            learned += found[0]["n"]
        held.unpersist()
    return weights, learned


def score_documents(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text",
                    block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, Vocabulary]:
    """One row per document: id, n_tokens, n_known, base_score, score; learns where ``training`` holds."""
    spark = docs.sparkSession
    size, in_training = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)), F.coalesce(
        F.sum(F.when(training, F.octet_length(text))), F.lit(0))).first()
    n_blocks = max(1, -(-int(size) // block_bytes))
    ranges = max(16, shuffle_partitions(spark), -(-int(size) // _RANGE_BYTES))
    kind = docs.schema[doc_id].dataType.simpleString()
    dealt = docs.select(F.col(doc_id).alias("_doc"), F.col(text).cast("string").alias("_text"),
                        training.cast("int").alias("_train"),
                        F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(n_blocks)).cast("int").alias("_block"))
    asked = dealt.groupBy("_block").applyInArrow(_ask(ranges), "_block int, _range int, _hashes binary, _counts binary")
    replies = stored(asked.groupBy("_range").applyInArrow(
        _answer(ranges), "_block int, _range int, _counts binary, _top binary, _n long, _v long"), "replies")
    totals = replies.where("_block = -1")
    n, v = totals.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum("_v"), F.lit(0))).first()

    # A row for each range, of VOCABULARY tokens and twice the range's share of the modelled ones.
    top = totals.select("_top", "_counts").repartition(1).mapInArrow(
        _merge_top(vocabulary_size(int(v))), "_top binary, _counts binary").first()
    hashes, counts = (np.frombuffer(x, t) for x, t in zip(top or (b"", b""), (np.uint64, np.int64)))
    order = np.argsort(hashes)
    vocabulary = Vocabulary(hashes[order], order + 1, int(n), int(v), int(counts.sum()), len(hashes) + 1)
    frequency = np.concatenate(([vocabulary.tokens - vocabulary.inside], counts)) + 1.0
    weights, vocabulary.learned = train(docs.where(training), vocabulary, frequency, int(in_training), doc_id, text)
    held = spark.sparkContext.broadcast((vocabulary, weights))

    def score(block: pa.Table, reply: pa.Table) -> pa.Table:
        known, weights = held.value
        model = GatedModel(known.size)
        model.w = weights
        tokens, lengths = token_hashes(block.column("_text").to_pylist())
        parts = sorted(zip(reply.column("_range").to_pylist(), reply.column("_counts").to_pylist()))
        counts = np.frombuffer(b"".join(c for _, c in parts), np.int64)
        distinct, inverse = np.unique(tokens, return_inverse=True)
        own, value = counts[inverse], np.log10(counts + 0.5)[inverse]
        start = np.cumsum(lengths) - lengths
        base = np.add.reduceat(value, start) - lengths * np.log10(known.tokens + 0.5 * (known.distinct + 1))
        ids = known.encode(distinct)[inverse]
        other = np.where(ids == 0, value - np.log10(known.other_mass), 0.0)
        end = int(known.encode(np.array([END]))[0])
        model_score = document_scores(model, ids, lengths, end) / np.log(10) + np.add.reduceat(other, start)
        return pa.table({"_doc": block.column("_doc"), "n_tokens": pa.array(lengths),
                         "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64), start)),
                         "base_score": pa.array(base), "score": pa.array(model_score)})

    answers = replies.where("_block >= 0").select("_block", "_range", "_counts")
    found = dealt.groupBy("_block").cogroup(answers.groupBy("_block")).applyInArrow(
        score, f"_doc {kind}, n_tokens long, n_known long, base_score double, score double")
    return found.withColumnRenamed("_doc", doc_id), vocabulary
