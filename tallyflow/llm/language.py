"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy by backpropagation through time.

Texts are cut into windows of ``WINDOW`` bytes that together cover every byte. In a window one network reads forwards
and one backwards; at each position both states give probabilities of the languages. A document's probabilities
are the mean over all its positions that hold a letter byte. The network is small enough to travel with the task.

The network starts on the driver from a bounded sample. Then it learns from all labelled texts, whole: they are dealt into shards
by id hash, each shard takes the network once over all windows of its texts, and the networks of the shards are averaged.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyflow.llm.common import in_slices, staged, staged_in_batches

WINDOW, HIDDEN = 64, 8
#: The sample of the start: at most this many documents per language, those with the smallest id hashes, and windows
#: of each, spread evenly over its text.
SAMPLE_DOCUMENTS, SAMPLE_WINDOWS = 150, 12
STEPS, BATCH, RATE = 350, 128, 0.02
#: The pass over all labelled texts: rows of a shard, windows of a step, and its rate.
SHARD_ROWS, STEP_WINDOWS, PASS_RATE = 8_000, 512, 0.001
#: Windows of no language in each step, where the network learns them.
OTHERS_AT_ONCE = 64
#: Windows computed at once; their states fit a core's cache.
AT_ONCE = 512
#: Texts that a Python worker holds at once.
TEXTS_AT_ONCE = 2_000
UNKNOWN = "und"
#: Bytes of text for which the least score of a language is learned, and the share of clean texts that may lie below
#: three times that score.
LENGTHS, LOW_SHARE = (8, 16, 32, 64, 128, 256, 512), 0.01
#: Steps whose inputs are fetched at once.
STEPS_AT_ONCE = 32
#: Rows of a byte that are summed at once.
GROUP = 16
#: What stands for a byte outside of the text, and symbols in all.
OUTSIDE, SYMBOLS = 256, 257
#: Scores are counted in so many steps.
SCORE_STEPS = 10_000

_LETTER = np.zeros(256, dtype=np.float32)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


class Network:
    """Per direction: input columns by byte (gates z, r, n), recurrent weights and the bias of the recurrent n part.

    Gates z and r are kept at half scale, so that a sigmoid is 0.5 + 0.5 * tanh. Windows run along the last axis.
    """

    def __init__(self, languages: int, hidden: int = HIDDEN, seed: int = 7):
        draw = np.random.default_rng(seed)
        normal = lambda *shape: draw.normal(0, 1, shape).astype(np.float32)
        self.hidden, self.languages = hidden, languages
        self.weights = {}
        for way in ("f", "b"):
            self.weights["x" + way] = 0.3 * normal(3 * hidden, 256)
            self.weights["h" + way] = normal(3 * hidden, hidden) / np.float32(np.sqrt(hidden))
            self.weights["c" + way] = np.zeros((hidden, 1), dtype=np.float32)
        self.weights["o"] = 0.3 * normal(languages, 2 * hidden)
        self.weights["p"] = np.zeros((languages, 1), dtype=np.float32)

    def states(self, text: np.ndarray, mask: np.ndarray | None, way: str) -> np.ndarray:
        """States (steps, hidden, windows) of one direction; ``text`` is (steps, windows), states are 0 off the mask."""
        both = Passes(self).states(text, mask)
        out = both[0] if way == "f" else both[1, ::-1]
        return out.transpose(0, 2, 1) if mask is None else out.transpose(0, 2, 1) * mask[:, None, :]

    def copy(self, flat: np.ndarray | None = None) -> Network:
        """A network of the same shape, with the weights of ``flat`` where given."""
        out, at = Network(self.languages, self.hidden), 0
        flat = self.flat() if flat is None else flat
        for name in sorted(self.weights):
            w = self.weights[name]
            out.weights[name] = flat[at:at + w.size].reshape(w.shape).astype(w.dtype)
            at += w.size
        return out

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[name].ravel() for name in sorted(self.weights)])

    def gradients(self, text: np.ndarray, mask: np.ndarray, labels: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """``Passes.gradients`` of one batch."""
        return Passes(self).gradients(text, mask, labels, weight)


class Passes:
    """What a network reads in windows, and its gradients. The arrays are kept and used again for the next windows.

    Both directions go at once: step s reads place s forwards and place -1 - s backwards. Hidden units run along the last
    axis, so that the input of a byte is one row. A mask is the first bytes of each window. Off the mask stands OUTSIDE,
    whose rows leave a state of 0 at 0, so the backward direction starts where the text ends; the forward one runs on behind it, where nothing counts.
    """

    def __init__(self, net: Network):
        self.net, self.kept = net, {}

    def _array(self, name: str, *shape: int) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.kept or self.kept[name].size < size:
            self.kept[name] = np.empty(size, self.net.weights["o"].dtype)
        return self.kept[name][:size].reshape(shape)

    def _weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Input rows of both directions' symbols by gate, (3, 2 * SYMBOLS, hidden), and recurrent weights (3, 2, hidden in, hidden out).

        All times -2: a sigmoid is then 1 / (1 + exp) and a tanh 2 / (1 + exp) - 1, which take less time than numpy's tanh.
        """
        w, k = self.net.weights, self.net.hidden
        rows = np.zeros((3, 2, SYMBOLS, k), w["o"].dtype)
        rows[1, :, OUTSIDE] = -40.0  # closes gate r
        for i, way in enumerate("fb"):
            rows[:, i, :256] = w["x" + way].reshape(3, k, 256).transpose(0, 2, 1)
        recurrent = np.stack([w["h" + way].reshape(3, k, k) for way in "fb"], axis=1)
        rows *= -2
        return rows.reshape(3, 2 * SYMBOLS, k), np.ascontiguousarray(recurrent.transpose(0, 1, 3, 2)) * rows.dtype.type(-2)

    def states(self, text: np.ndarray, mask: np.ndarray | None, trace: bool = False) -> np.ndarray:
        """States (direction, steps, windows, hidden) after each step; ``trace`` keeps what gradients need."""
        k, (steps, n) = self.net.hidden, text.shape
        rows, recurrent = self._weights()
        bias = self._array("bias", 2, n, k)
        bias[:] = np.stack([-2 * self.net.weights["c" + way].T for way in "fb"])
        symbols = np.empty((steps, 2, n), dtype=np.intp)
        symbols[:, 0] = text
        if mask is not None:
            np.copyto(symbols[:, 0], OUTSIDE, where=mask == 0)
        np.add(symbols[::-1, 0], SYMBOLS, out=symbols[:, 1])
        states, sums = self._array("states", 2, steps + 1, n, k), self._array("sums", 3, 2, n, k)
        gates, backs = self._traced(steps, n) if trace else (self._array("gates", 3, min(steps, STEPS_AT_ONCE), 2, n, k), None)
        states[:, 0], sums_zr, sums_n, one, two = 0, sums[:2], sums[2], np.ones((), states.dtype), np.full((), 2, states.dtype)
        for low in range(0, steps, STEPS_AT_ONCE):
            some = symbols[low:low + STEPS_AT_ONCE]
            here = gates[:, low:low + len(some)] if trace else gates[:, :len(some)]
            for gate in range(3):
                rows[gate].take(some, axis=0, out=here[gate], mode="clip")
            with np.errstate(over="ignore"):  # 1 / (1 + inf) is 0
                for t, (zr, a) in enumerate(zip(here[:2].swapaxes(0, 1), here[2]), low):
                    h, new, back = states[:, t], states[:, t + 1], backs[t] if trace else sums_n
                    np.matmul(h, recurrent, out=sums)
                    zr += sums_zr
                    np.exp(zr, out=zr)
                    zr += one
                    np.divide(one, zr, out=zr)
                    np.add(sums_n, bias, out=back)
                    np.multiply(back, zr[1], out=sums_n)
                    a += sums_n
                    np.exp(a, out=a)
                    a += one
                    np.divide(two, a, out=a)
                    a -= one
                    np.subtract(h, a, out=new)
                    new *= zr[0]
                    new += a
        self.symbols = symbols
        return states[:, 1:]

    def _traced(self, steps: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Gates z, r and n of each step, and the recurrent part of n times -2."""
        return self._array("gates", 3, steps, 2, n, self.net.hidden), self._array("backs", steps, 2, n, self.net.hidden)

    def probabilities(self, text: np.ndarray, mask: np.ndarray | None, trace: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(languages, steps, windows) probabilities of every position, and the states."""
        k, (steps, n), w = self.net.hidden, text.shape, self.net.weights
        both = self.states(text, mask, trace)
        p, other = (self._array(name, self.net.languages, steps, n) for name in ("p", "other"))
        np.matmul(w["o"][:, :k], both[0].reshape(-1, k).T, out=p.reshape(-1, steps * n))
        np.matmul(w["o"][:, k:], both[1].reshape(-1, k).T, out=other.reshape(-1, steps * n))
        p += other[:, ::-1]
        p += w["p"][:, :, None]
        p -= p.max(axis=0)
        np.exp(p, out=p)
        p /= p.sum(axis=0)
        return p, both

    def gradients(self, text: np.ndarray, mask: np.ndarray, labels: np.ndarray, weight: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions of the mask, and its gradient by backpropagation through time.

        ``weight`` is what a position of each window counts.
        """
        k, (steps, n), w = self.net.hidden, text.shape, self.net.weights
        d, both = self.probabilities(text, mask, True)
        (gates, backs), states = self._traced(steps, n), self._array("states", 2, steps + 1, n, k).swapaxes(0, 1)
        share = mask if weight is None else mask * weight
        count = share.sum()
        truth = (labels == np.arange(self.net.languages)[:, None]).astype(d.dtype)
        loss = float(-(np.log(np.maximum(np.einsum("ltn,ln->tn", d, truth), 1e-30)) * share).sum() / count)
        d -= truth[:, None]
        d *= share / count
        behind = self._array("other", *d.shape)
        behind[:] = d[:, ::-1]
        ahead, behind = d.reshape(-1, steps * n), behind.reshape(-1, steps * n)
        grads = {"p": ahead.sum(axis=1)[:, None]}
        grads["o"] = np.concatenate([np.matmul(ahead, both[0].reshape(-1, k)), np.matmul(behind, both[1].reshape(-1, k))], axis=1)
        # of the half-scale inputs of z and r: sigmoid (2 x) has the derivative 2 z (1 - z); the 2 is put in where they are summed, for r with the -2 of backs
        twice = np.array([2, -1, 1], w["o"].dtype)[:, None, None]
        recurrent = np.stack([w["h" + way].reshape(3, k, k) for way in "fb"], axis=1) * twice[:, None]
        sums, dh, carried = (self._array(name, *shape, 2, n, k) for name, shape in (("sums", (3,)), ("dh", ()), ("carried", ())))
        one, every, most = np.ones((), d.dtype), np.ones(n, d.dtype), min(steps, STEPS_AT_ONCE)
        weights, biases = np.zeros((3, 2, k, k), d.dtype), np.zeros((2, k), d.dtype)
        dh[:] = 0
        for low in reversed(range(0, steps, STEPS_AT_ONCE)):
            z, r, a = gates[:, low:low + most]
            back, above, of_z, of_r = backs[low:low + most], *(self._array(name, most, 2, n, k)[:len(a)] for name in ("above", "of_z", "of_r"))
            for i, some in enumerate((ahead, behind)):
                part = some[:, low * n:(low + most) * n]
                one_way = np.matmul(part.T, w["o"][:, i * k:(i + 1) * k], out=self._array("one_way", part.shape[1], k))
                above[:, i] = one_way.reshape(-1, n, k)
            # what the gradient of a state gives for z (half), n, and from there r (half)
            np.subtract(one, z, out=of_r)
            np.subtract(states[low:low + len(a)], a, out=of_z)
            of_z *= of_r
            of_z *= z
            a *= a
            np.subtract(one, a, out=a)
            a *= of_r
            np.subtract(one, r, out=of_r)
            of_r *= r
            of_r *= back
            for i in range(len(a) - 1, -1, -1):
                dh += above[i]
                np.multiply(dh, z[i], out=carried)
                np.multiply(of_z[i], dh, out=z[i])
                np.multiply(a[i], dh, out=back[i])  # of the input of n
                np.multiply(back[i], r[i], out=a[i])  # of its recurrent part
                np.multiply(of_r[i], back[i], out=r[i])
                np.matmul(gates[:, low + i], recurrent, out=sums)
                np.add(sums[0], sums[1], out=dh)
                dh += sums[2]
                dh += carried
            weights += np.matmul(gates[:, low:low + most].swapaxes(-1, -2), states[low:low + len(a)]).sum(axis=1)
            biases += np.matmul(every, a).sum(axis=0)
        weights *= twice[:, None]
        inputs = self._by_symbol([gates[0], gates[1], backs]) * twice
        for i, way in enumerate("fb"):
            grads["h" + way] = weights[:, i].reshape(3 * k, k)
            grads["c" + way] = biases[i][:, None]
            grads["x" + way] = inputs[:, i * SYMBOLS:i * SYMBOLS + 256].transpose(0, 2, 1).reshape(3 * k, 256)
        return loss, grads

    def _by_symbol(self, gates: list[np.ndarray]) -> np.ndarray:
        """(3, 2 * SYMBOLS, hidden) sums of three (steps, direction, windows, hidden) by symbol and direction."""
        k, symbols = self.net.hidden, self.symbols.ravel()
        counts = np.bincount(symbols, minlength=2 * SYMBOLS)
        # rows in order of their symbol, each symbol filled up to whole groups by rows of 0; one product sums the rows of a group
        short = -counts % GROUP
        order = np.argsort(np.concatenate([symbols, np.repeat(np.arange(2 * SYMBOLS), short)]).astype(np.uint16), kind="stable")
        fillers, present = np.flatnonzero(order >= len(symbols)), np.flatnonzero(counts)
        groups = (counts + short)[present] // GROUP
        firsts = np.cumsum(groups) - groups
        out, some = np.zeros((3, 2 * SYMBOLS, k), gates[0].dtype), self._array("some", len(order), k)
        summing = np.tile(np.eye(k, dtype=out.dtype), (GROUP, 1))
        for gate in range(3):
            gates[gate].reshape(-1, k).take(order, axis=0, out=some, mode="clip")
            some[fillers] = 0
            out[gate, present] = np.add.reduceat(some.reshape(-1, GROUP * k) @ summing, firsts, axis=0)
        return out


class Adam:
    """Steps of a network against its gradients."""

    def __init__(self, net: Network):
        self.net, self.steps = net, 0
        self.one = {name: np.zeros_like(w) for name, w in net.weights.items()}
        self.two = {name: np.zeros_like(w) for name, w in net.weights.items()}

    def step(self, grads: dict[str, np.ndarray], pace: float) -> None:
        self.steps += 1
        one, two, step = self.one, self.two, self.steps
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for name, g in grads.items():
            g = g * min(1.0, 5.0 / max(size, 1e-12))
            one[name] = 0.9 * one[name] + 0.1 * g
            two[name] = 0.99 * two[name] + 0.01 * g * g
            self.net.weights[name] -= (pace * (one[name] / (1 - 0.9**step)) / (np.sqrt(two[name] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def train(windows: list[bytes], labels: np.ndarray, languages: int, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 7) -> Network:
    """Adam on random batches, languages equally often; the same sample and seed give the same network."""
    net, draw = Network(languages, seed=seed), np.random.default_rng(seed)
    text, mask = _laid_out(windows)
    of = [np.flatnonzero(labels == k) for k in range(languages)]
    adam, passes = Adam(net), Passes(net)
    for step in range(1, steps + 1):
        pick = np.concatenate([draw.choice(members, max(1, batch // languages)) for members in of])
        some, kept = np.ascontiguousarray(text[pick].T), np.ascontiguousarray(mask[pick].T.astype(np.float32))
        adam.step(passes.gradients(some, kept, labels[pick])[1], rate * min(1.0, 2.0 * (1 - step / (steps + 1))))
    return net


def _laid_out(windows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(windows, steps) bytes and which of them are inside."""
    text = np.zeros((len(windows), WINDOW), dtype=np.uint8)
    for i, w in enumerate(windows):
        text[i, :len(w)] = np.frombuffer(w, dtype=np.uint8)
    return text, np.arange(WINDOW)[None, :] < np.array([len(w) for w in windows])[:, None]


def _windows(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows that together cover every byte of the texts, AT_ONCE at a time: the text each is of, (steps, windows) bytes, and
    which of them are inside the text."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(values, dtype=np.uint8)[offsets[0]:offsets[-1]] if values is not None else np.empty(0, dtype=np.uint8)
    cuts = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(WINDOW, dtype=np.uint8)), WINDOW)
    offsets, sizes = offsets - offsets[0], np.diff(offsets)
    parts = -(-sizes // WINDOW)
    ends = np.cumsum(parts)
    ranks, steps = np.arange(len(column)), np.arange(WINDOW, dtype=np.int16)[:, None]
    for low in range(0, int(ends[-1]) if len(ends) else 0, AT_ONCE):
        number = np.arange(low, min(low + AT_ONCE, int(ends[-1])))
        owner = ranks[np.searchsorted(ends, number, "right")]
        place = (number - (ends[owner] - parts[owner])) * WINDOW
        lengths = np.minimum(sizes[owner] - place, WINDOW).astype(np.int16)
        yield owner, np.ascontiguousarray(cuts[offsets[owner] + place].T), steps < lengths


def document_probabilities(net: Network, column: pa.Array) -> np.ndarray:
    """(texts, languages): mean position probabilities over letter bytes; zeros where there are none."""
    total, weight, passes = np.zeros((len(column), net.languages)), np.zeros(len(column)), Passes(net)
    for owner, text, inside in _windows(column):
        full = inside.all()
        mask = None if full else inside.astype(np.float32)
        p, _ = passes.probabilities(text, mask)
        letters = _LETTER[text] if full else _LETTER[text] * mask
        np.add.at(total, owner, np.einsum("ltn,tn->nl", p, letters))
        np.add.at(weight, owner, letters.sum(axis=0))
    return total / np.maximum(weight, 1)[:, None]


def held_out(ident: Column) -> Column:
    """Documents never learned from: crc32 of the id as text leaves 2 modulo 4. A null id is not held out."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _evenly(windows: int):
    """Task side: windows spread evenly over each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, orders, cuts = [], [], []
            for lang, order, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                starts = np.unique(np.linspace(0, max(0, len(raw) - WINDOW), windows).astype(int))
                for start in starts.tolist():
                    langs.append(lang)
                    orders.append(order)
                    cuts.append(raw[start:start + WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(orders, pa.int64()), pa.array(cuts, pa.binary())], names=["lang", "draw", "cut"])

    return run


def labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(_id, _text, _lang) of the rows to learn from: not held out, with a language, and a letter in the text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.col(f"`{lang_col}`").cast("string").alias("_lang"))
    rows = rows.where(F.col("_id").isNotNull() & F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_id")))
    return rows.where(F.col("_text").rlike(r"\p{L}"))


def language_counts(rows: DataFrame) -> dict[str, tuple[int, int]]:
    """Labelled rows and their windows by language, of all rows."""
    counted = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.ceil(F.octet_length("_text") / WINDOW)).alias("windows"))
    return {r["_lang"]: (r["n"], r["windows"]) for r in counted.collect()}  # one row per language


def learning_sample(rows: DataFrame, counts: dict[str, tuple[int, int]], documents: int, windows: int) -> dict[str, list[tuple[int, bytes]]]:
    """(id hash, window) lists by language, of a bounded sample of labelled rows, for the start of the network.

    Each language gives the share of its rows, by id hash, that holds ``documents`` rows on average, cut to ``documents``.
    """
    scale = 2**30
    share = F.create_map(*[x for k, (n, _) in counts.items() for x in (F.lit(k), F.lit(min(scale, int(scale * 1.5 * documents / n) + 1)))])
    draw = F.pmod(F.xxhash64("_id"), F.lit(scale)).cast("long")
    picked = rows.select("_lang", draw.alias("_draw"), "_text").where(F.col("_draw") < share[F.col("_lang")])
    sample = staged(picked.mapInArrow(_evenly(windows), "lang string, draw long, cut binary"), "language-sample").collect()
    by_lang: dict[str, list] = {}
    for r in sample:
        by_lang.setdefault(r["lang"], []).append((r["draw"], bytes(r["cut"])))
    return {name: sorted(some)[:documents * windows] for name, some in by_lang.items()}


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", documents: int = SAMPLE_DOCUMENTS,
    windows: int = SAMPLE_WINDOWS, steps: int = STEPS, others: list[bytes] | None = None,
) -> tuple[Network, list[str]] | None:
    """Network and its languages, from all labelled rows; None when there are none. Windows of ``others`` make one more output.

    ``documents``, ``windows`` and ``steps`` are those of its start.
    """
    rows = labelled(docs, id_col, text_col, lang_col)
    counts = language_counts(rows)
    if not counts:
        return None
    net, names = trained(learning_sample(rows, counts, documents, windows), steps, others)
    balance = np.array([sum(w for _, w in counts.values()) / (len(names) * counts[name][1]) for name in names])
    shards = -(-sum(n for n, _ in counts.values()) // SHARD_ROWS)
    order = F.xxhash64("_id")
    dealt = rows.select(F.pmod(order, F.lit(shards)).cast("int").alias("_shard"), "_lang", "_text", order.alias("_order"))
    dealt = dealt.repartitionById(shards, F.col("_shard")).sortWithinPartitions("_shard", "_order", "_text")
    learned = dealt.select("_shard", "_lang", "_text").mapInArrow(_shard_networks(net, names, balance, others), "windows long, weights array<double>")
    parts = staged_in_batches(learned, "language-shards", TEXTS_AT_ONCE)
    each = parts.select("windows", F.posexplode("weights").alias("at", "weight")).groupBy("at")
    mean = each.agg((F.sum(F.col("windows") * F.col("weight")) / F.sum("windows")).alias("weight")).collect()  # one row per weight of the network
    return net.copy(np.array([weight for _, weight in sorted(tuple(r) for r in mean)])), names


class Learner:
    """A network that learns from windows as they come, STEP_WINDOWS at a step, however they are brought."""

    def __init__(self, start: Network, balance: np.ndarray, others: list[bytes] | None):
        self.net = start.copy()
        self.adam, self.passes, self.balance, self.windows = Adam(self.net), Passes(self.net), balance.astype(np.float32), 0
        self.others = [part.T for part in _laid_out(others)] if others else None
        self.waiting = (np.empty((WINDOW, 0), np.uint8), np.empty((WINDOW, 0), bool), np.empty(0, np.int64))

    def add(self, *some: np.ndarray) -> None:
        """(steps, windows) bytes, which of them are inside, and the labels of the windows."""
        self.waiting = tuple(np.concatenate(two, axis=-1) for two in zip(self.waiting, some))
        while len(self.waiting[2]) >= STEP_WINDOWS:
            self._step(*(x[..., :STEP_WINDOWS] for x in self.waiting))
            self.waiting = tuple(x[..., STEP_WINDOWS:] for x in self.waiting)

    def _step(self, text: np.ndarray, inside: np.ndarray, labels: np.ndarray) -> None:
        weight = self.balance[labels]
        if self.others is not None:
            pick = (self.windows // STEP_WINDOWS * OTHERS_AT_ONCE + np.arange(OTHERS_AT_ONCE)) % self.others[0].shape[1]
            text, inside = (np.concatenate([x, y[:, pick]], axis=1) for x, y in zip((text, inside), self.others))
            weight = np.append(weight, np.full(OTHERS_AT_ONCE, len(labels) / (len(self.balance) * OTHERS_AT_ONCE), np.float32))
        self.windows += len(labels)
        labels = np.append(labels, np.full(text.shape[1] - len(labels), len(self.balance)))
        self.adam.step(self.passes.gradients(np.ascontiguousarray(text), inside.astype(np.float32), labels, weight)[1], PASS_RATE)

    def done(self) -> pa.RecordBatch:
        if len(self.waiting[2]):
            self._step(*self.waiting)
        return pa.RecordBatch.from_arrays([pa.array([self.windows], pa.int64()), pa.array([self.net.flat()], pa.list_(pa.float64()))], names=["windows", "weights"])


def _shard_networks(start: Network, names: list[str], balance: np.ndarray, others: list[bytes] | None):
    """Task side: the network of each shard after all windows of its texts (shard, lang, text); rows come shard by shard, in order."""
    place = {name: k for k, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, learner = None, None
        for batch in batches:
            for part in in_slices(batch, 2):
                shards = part.column(0).to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
                for low, high in zip(edges, edges[1:]):
                    if shards[low] != current:
                        if learner is not None:
                            yield learner.done()
                        current, learner = shards[low], Learner(start, balance, others)
                    some = part.slice(low, high - low)
                    labels = np.array([place[name] for name in some.column(1).to_pylist()])
                    for owner, text, inside in _windows(some.column(2)):
                        learner.add(text, inside, labels[owner])
        if learner is not None:
            yield learner.done()

    return run


def trained(sample: dict[str, list[tuple[int, bytes]]], steps: int, others: list[bytes] | None = None) -> tuple[Network, list[str]]:
    """Network and its languages; windows of ``others`` make one more output behind them."""
    names, cuts, labels = sorted(sample), [], []
    for k, some in enumerate([*([c for _, c in sample[name]] for name in names), *([others] if others else [])]):
        cuts += some
        labels += [k] * len(some)
    return train(cuts, np.array(labels), len(names) + bool(others), steps), names


def no_language(count: int, seed: int = 7) -> list[bytes]:
    """Windows of what no language is: dumps in hex and base64, numbers and tables of them, signs, a stray letter."""
    pick = random.Random(seed)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    kinds = (digits + "abcdef", digits + "ABCDEF", upper + lower + digits + "+/", upper + lower + digits + "-_", digits, digits, digits + "#%*+-/=<>|:;,.")
    out = []
    for i in range(count):
        size, letters, between = pick.choice((8, 16, 32, WINDOW, WINDOW)), kinds[i % len(kinds)], pick.choice(("", "", " ", ",", "\n", "\t", ";", " | "))
        text = ""
        while len(text) < size:
            point = "." if letters == digits and pick.random() < 0.5 else ""
            text += "".join(pick.choices(letters, k=pick.randrange(1, 9))) + point + "".join(pick.choices(letters, k=pick.randrange(1, 9))) + between
        at = pick.randrange(size)
        text = text[:at] + pick.choice(upper + lower) + text[at + 1:] if pick.random() < 0.5 else text
        out.append(text[:size].encode())
    return out


def score_floors(model: tuple[Network, list[str]], rows: DataFrame) -> list[tuple[int, float]]:
    """(bytes, floor): texts of so many bytes and more need that score, a third of what 99 of 100 labelled texts reach by so many first bytes.

    All labelled rows that have as many bytes count; their scores are counted in SCORE_STEPS steps.
    """
    net, names = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.encode()[:LENGTHS[-1]] for text in batch.column(0).to_pylist()]
            for size in LENGTHS:
                cuts = [t[:size] for t in texts if len(t) >= size and _LETTER[np.frombuffer(t[:size], dtype=np.uint8)].any()]
                if cuts:
                    best = document_probabilities(net, pa.array(cuts, pa.binary()))[:, :len(names)].max(axis=1)
                    steps, n = np.unique((best * SCORE_STEPS).astype(int), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([size] * len(n), pa.int32()), pa.array(steps, pa.int32()), pa.array(n, pa.int64())], names=["size", "step", "n"])

    first = rows.select(F.substring("_text", 1, LENGTHS[-1]).alias("_text"))  # characters, so as many bytes or more
    counted = first.mapInArrow(run, "size int, step int, n long").groupBy("size", "step").agg(F.sum("n").alias("n")).collect()  # a row per length and step
    out = []
    for size in LENGTHS:
        mine = sorted((r["step"], r["n"]) for r in counted if r["size"] == size)
        if mine:
            below = np.cumsum([n for _, n in mine])
            out.append((size, mine[int(np.searchsorted(below, LOW_SHARE * below[-1]))][0] / SCORE_STEPS / 3))
    return out


def with_language(docs: DataFrame, model: tuple[Network, list[str]] | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``_lang_pred`` and ``_lang_score`` behind its own columns; without ``keep_text`` its texts are not stored again.

    Null texts, texts without a letter, and all texts where there was nothing to learn from, are ``und`` with score
    0. Ties go to the language first by name. Whole texts are read; a task holds one Arrow batch.
    """
    width = len(docs.columns)
    kept = [i for i, c in enumerate(docs.columns) if keep_text or c != text_col]
    schema = T.StructType([*(docs.schema.fields[i] for i in kept), T.StructField("_lang_pred", T.StringType()), T.StructField("_lang_score", T.DoubleType())])
    place = docs.columns.index(text_col)
    ready = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False)).alias("_read"))
    if model is None:
        plain = ready.select(*[F.col(f"`{docs.columns[i]}`") for i in kept])
        return plain.withColumn("_lang_pred", F.lit(UNKNOWN)).withColumn("_lang_score", F.lit(0.0))
    net, names = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = document_probabilities(net, batch.column(place))[:, :len(names)]
            best = p.argmax(axis=1)
            score = np.clip(p[np.arange(len(best)), best], 0.0, 1.0)
            known = batch.column(width).to_numpy(zero_copy_only=False)
            labels = [names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
            columns = [*(batch.column(i) for i in kept), pa.array(labels, pa.string()), pa.array(np.where(known, score, 0.0), pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in kept), "_lang_pred", "_lang_score"])

    return staged_in_batches(ready.mapInArrow(run, schema), "language-read", TEXTS_AT_ONCE)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **settings) -> DataFrame:
    """(id, held_out, lang_pred, score) for every row, by a network learned from the rows that are not held out.

    Text alone enters a prediction. Repeated rows are predicted one by one; a null id is neither learned from nor
    held out; a null lang is not learned from. An empty table gives no rows.
    """
    model = fit(docs, id_col, text_col, lang_col, **settings)
    read = with_language(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")), model, "_text", keep_text=False)
    return read.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score"))


def known_language(
    docs: DataFrame, least: float = 0.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    documents: int = SAMPLE_DOCUMENTS, windows: int = SAMPLE_WINDOWS, steps: int = STEPS,
) -> DataFrame:
    """The rows of ``docs`` that have a language, with all their columns.

    ``und`` rows go, and scores below ``least`` or below the floor of the text's length. The network here has one output
    more, for what is no language, so such texts score low. Where nothing can be learned, all rows with a letter stay.
    """
    model = fit(docs, id_col, text_col, lang_col, documents, windows, steps, no_language(documents * windows))
    if model is None:
        return docs.where(F.col(f"`{text_col}`").rlike(r"\p{L}"))
    floor = F.lit(least)
    for size, score in score_floors(model, labelled(docs, id_col, text_col, lang_col)):
        floor = F.when(F.octet_length(F.col(f"`{text_col}`")) >= size, F.lit(max(least, score))).otherwise(floor)
    read = with_language(docs, model, text_col)
    return read.where((F.col("_lang_pred") != UNKNOWN) & (F.col("_lang_score") >= floor)).select(*[F.col(f"`{c}`") for c in docs.columns])
