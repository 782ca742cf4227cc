"""A small causal self-attention model over subword ids, in numpy.

A window has ``CONTEXT`` input places and scores what follows each of its last ``STRIDE`` places; windows
begin every ``STRIDE`` places, so they overlap and each id is scored once. One attention head with a
bias by distance looks at the places up to the scored one; a layer joins what it finds with the last two inputs.

The ids that the model tells apart are the most frequent ones of the corpus, in groups of equal size by rank;
its output is the group and the member. All other ids share one member, and among them the
corpus counts decide. The probabilities of all ids add up to one.
"""

from __future__ import annotations

import numpy as np

from gridscope.llm.textarrays import mix, seeds

CONTEXT, STRIDE = 24, 16
WIDTH, HIDDEN = 16, 48
GROUPS, MEMBERS = 25, 25
SLOTS = GROUPS * MEMBERS
STEPS, BATCH, RATE = 1200, 128, 1e-2
#: Windows that are scored side by side, and those whose gradients are summed at once: what they need stays in a core's cache.
SCORED, SUMMED = 256, 192
#: In single precision the hyperbolic tangent of it is 1.
ONE = 20.0

#: Logits up to this size need no shift.
SAFE = 60.0

_DISTANCE = np.arange(CONTEXT - STRIDE, CONTEXT)[:, None] - np.arange(CONTEXT)[None, :]
_CAUSAL = _DISTANCE >= 0


def places(cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text of each window, and the place in it of the window's first target."""
    per_text = -(-np.diff(cuts) // STRIDE)
    text = np.repeat(np.arange(len(per_text)), per_text)
    return text, (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * STRIDE


def windows(slots: np.ndarray, cuts: np.ndarray, start: int, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets (places in ``slots``) and text of each window of the texts, or the chosen ones; -1 stands for no place.

    The input before a text's first id is ``start``; before that there is nothing.
    """
    counts = np.diff(cuts)
    text, first = places(cuts)
    if chosen is not None:
        text, first = text[chosen], first[chosen]
    # place p of a text's inputs is the id p - 1
    inputs = first[:, None] + np.arange(CONTEXT) - (CONTEXT - STRIDE)
    targets = first[:, None] + np.arange(STRIDE)
    found = np.full(inputs.shape, -1, dtype=np.int32)
    inside = (inputs > 0) & (inputs <= counts[text][:, None])
    found[inside] = slots[(cuts[text][:, None] + inputs - 1)[inside]]
    found[inputs == 0] = start
    there = targets < counts[text][:, None]
    return found, np.where(there, cuts[text][:, None] + targets, -1), text


def _wide(logits: np.ndarray) -> bool:
    """Whether a power could overflow, or a whole row vanish, unless the rows are shifted."""
    return bool(logits.size) and max(float(logits.max()), -float(logits.min())) > SAFE


def _softmax(logits: np.ndarray, wide: bool = True) -> np.ndarray:
    """Shares by row; rows are shifted to a maximum of 0 unless all logits that count are known to be small."""
    if wide:
        logits -= logits.max(axis=-1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= (logits @ np.ones(logits.shape[-1], logits.dtype))[..., None]
    return logits


class Attention:
    """Weights and the corpus counts that they stand on."""

    def __init__(self, counts: np.ndarray, end: int, seed: int = 1) -> None:
        order = np.argsort(-counts, kind="stable")
        chosen = order[order != end][: SLOTS - 2]
        chosen = np.append(chosen, end)
        chosen = chosen[np.argsort(-counts[chosen], kind="stable")]
        self.rest = SLOTS - 1
        self.slot_of = np.full(len(counts), self.rest, dtype=np.int32)
        self.slot_of[chosen] = np.arange(len(chosen))
        self.start = int(self.slot_of[end])
        others = np.ones(len(counts), dtype=bool)
        others[chosen] = False
        shares = (counts + 1.0) / (counts[others].sum() + max(others.sum(), 1))
        self.log_share = np.where(others, np.log(shares), 0.0).astype(np.float32)
        random = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) * shape[-2] ** -0.5).astype(np.float32)

        by_slot = np.append(counts[chosen], counts[others].sum()) + 1.0
        by_slot = np.log(np.pad(by_slot, (0, SLOTS - len(by_slot)), constant_values=1.0)).reshape(GROUPS, MEMBERS)
        self.w = {
            "embed": normal(SLOTS, 1, WIDTH)[:, 0] * np.float32(0.5), "q": normal(WIDTH, WIDTH), "k": normal(WIDTH, WIDTH), "v": normal(WIDTH, WIDTH),
            "near": (-0.3 * np.arange(CONTEXT)).astype(np.float32),
            "last": normal(SLOTS, 1, HIDDEN)[:, 0] * np.float32(0.3), "before": normal(SLOTS, 1, HIDDEN)[:, 0] * np.float32(0.1),
            "join": normal(WIDTH, HIDDEN), "join_b": np.zeros(HIDDEN, np.float32),
            "group": normal(HIDDEN, GROUPS) * np.float32(0.1), "group_b": np.log(np.exp(by_slot).sum(axis=1)).astype(np.float32),
            "member": normal(GROUPS, HIDDEN, MEMBERS) * np.float32(0.1), "member_b": by_slot.astype(np.float32),
        }

    def _tables(self) -> dict[str, np.ndarray]:
        """Queries, keys and values by slot, as they depend on nothing else, and the output weights of each group.

        Hidden rows have a last place that is always 1 (its input is ``ONE``), so that biases are weights of it.
        """
        w = self.w
        out = np.empty((GROUPS, HIDDEN + 1, GROUPS + MEMBERS), np.float32)
        out[:, :HIDDEN, :GROUPS], out[:, HIDDEN, :GROUPS] = w["group"], w["group_b"]
        out[:, :HIDDEN, GROUPS:], out[:, HIDDEN, GROUPS:] = w["member"], w["member_b"]
        return {"q": w["embed"] @ w["q"] * np.float32(WIDTH ** -0.5), "kv": w["embed"] @ np.concatenate([w["k"], w["v"]], axis=1),
                "bias": np.where(_CAUSAL, w["near"][np.abs(_DISTANCE)], np.float32(-1e9)),
                "last": np.pad(w["last"] + w["join_b"], ((0, 0), (0, 1)), constant_values=ONE),
                "before": np.pad(w["before"], ((0, 0), (0, 1))), "join": np.pad(w["join"], ((0, 0), (0, 1))), "out": out}

    def _hidden(self, inputs: np.ndarray, t: dict[str, np.ndarray], safe: bool = False) -> dict[str, np.ndarray]:
        there = np.maximum(inputs, 0)
        q, kv = np.take(t["q"], there[:, CONTEXT - STRIDE:], axis=0), np.take(t["kv"], there, axis=0)
        k, v = kv[:, :, :WIDTH], kv[:, :, WIDTH:]
        logits = q @ k.transpose(0, 2, 1)
        wide = not safe and _wide(logits)
        logits += t["bias"]
        # places before a text's start; a place without any input looks at itself, its target is absent
        short = np.flatnonzero(inputs.min(axis=1) < 0)
        if len(short):
            absent = (inputs[short] < 0)[:, None, :] & (_DISTANCE != 0)
            logits[short] = np.where(absent, np.float32(-1e9), logits[short])
        a = _softmax(logits, wide)
        c = (a @ v).reshape(-1, WIDTH)
        u = c @ t["join"]
        u += np.take(t["last"], there[:, CONTEXT - STRIDE:].reshape(-1), axis=0)
        u += np.take(t["before"], there[:, CONTEXT - STRIDE - 1: -1].reshape(-1), axis=0)
        return {"q": q, "k": k, "v": v, "a": a, "c": c, "h": np.tanh(u, out=u)}

    def _by_group(self, inputs: np.ndarray, flat: np.ndarray, t: dict[str, np.ndarray], safe: dict[str, bool]) -> tuple:
        """What ``_hidden`` finds, the rows with a target, by group so that those of a group lie side by side, where
        the groups begin, the rows' hidden values, and their powers: of the groups and of the members."""
        s = self._hidden(inputs, t, safe["attention"])
        rows = np.argsort(np.where(flat >= 0, flat // MEMBERS, GROUPS).astype(np.int16), kind="stable")
        rows = rows[: np.count_nonzero(flat >= 0)]
        h = np.take(s["h"], rows, axis=0)
        bounds = np.searchsorted(flat[rows] // MEMBERS, np.arange(GROUPS + 1)).tolist()
        logits = np.empty((len(rows), GROUPS + MEMBERS), np.float32)
        for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
            if low < high:
                np.matmul(h[low:high], t["out"][k], out=logits[low:high])
        return s, rows, bounds, h, logits

    def score(self, ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each text's ids."""
        return np.bincount(places(cuts)[0], weights=self.window_scores(ids, cuts), minlength=len(cuts) - 1)

    def window_scores(self, ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each window's targets. Equal windows of the run are scored once."""
        slots = self.slot_of[ids]
        inputs, targets, text = windows(slots, cuts, self.start)
        wanted = np.where(targets >= 0, slots[np.maximum(targets, 0)], -1) if len(targets) else targets
        # place by place: the ids of all windows side by side would fill much memory
        total = np.zeros(len(inputs), dtype=np.uint64)
        columns = [*inputs.T, *wanted.T]
        for column, seed in zip(columns, seeds(len(columns), salt=11)):
            total += column.astype(np.uint64) * seed
        _, first, which = np.unique(mix(total), return_index=True, return_inverse=True)
        sums = np.append(0.0, np.cumsum(self.log_share[ids], dtype=np.float64))
        begin = cuts[text] + places(cuts)[1]
        return self._window_sums(inputs[first], wanted[first])[which] + sums[np.append(begin[1:], cuts[-1:])[:len(begin)]] - sums[begin]

    def _window_sums(self, inputs: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Log probability of each window's targets, given as slots; -1 where there is none."""
        t = self._tables()
        safe = self._bounds(t)
        out = np.zeros(len(inputs))
        for at in range(0, len(inputs), SCORED):
            flat = slots[at: at + SCORED].reshape(-1)
            _, rows, _, _, logits = self._by_group(inputs[at: at + SCORED], flat, t, safe)
            slot, each = flat[rows], np.arange(len(rows))
            got = logits[each, slot // MEMBERS] + logits[each, GROUPS + slot % MEMBERS]
            got -= _log_sums(logits, safe["out"])
            out += np.bincount(at + rows // STRIDE, weights=got, minlength=len(out))
        return out

    def _bounds(self, t: dict[str, np.ndarray]) -> dict[str, bool]:
        """Which logits can never be too large for their powers, whatever the input: hidden values are at most 1."""
        return {"out": bool(np.abs(t["out"]).sum(axis=1).max() <= SAFE),
                "attention": bool(np.sqrt((t["q"] ** 2).sum(axis=1).max() * (t["kv"][:, :WIDTH] ** 2).sum(axis=1).max()) <= SAFE)}

    def _gradients(self, inputs: np.ndarray, slots: np.ndarray) -> tuple[dict[str, np.ndarray], int]:
        """Gradients of the summed loss, and the number of targets; ``slots`` has the targets, -1 where there is none."""
        w, t = self.w, self._tables()
        safe = self._bounds(t)
        g_out, g_join, ds_near = np.zeros(t["out"].shape), np.zeros(t["join"].shape), np.zeros((STRIDE, CONTEXT))
        of_last, of_before, of_seen = (np.zeros((SLOTS, size)) for size in (HIDDEN + 1 + WIDTH, HIDDEN + 1, 2 * WIDTH))
        n = 0
        for at in range(0, len(inputs), SUMMED):
            flat = slots[at: at + SUMMED].reshape(-1)
            s, rows, bounds, h, off = self._by_group(inputs[at: at + SUMMED], flat, t, safe)
            size, slot, each = len(flat) // STRIDE, flat[rows], np.arange(len(rows))
            n += len(rows)
            _softmax(off.reshape(-1, MEMBERS), not safe["out"])
            off[each, slot // MEMBERS] -= 1
            off[each, GROUPS + slot % MEMBERS] -= 1
            dh = np.empty_like(h)
            for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
                if low < high:
                    g_out[k] += h[low:high].T @ off[low:high]
                    np.matmul(off[low:high], t["out"][k].T, out=dh[low:high])
            np.multiply(h, h, out=h)
            dh *= np.subtract(1, h, out=h)
            last, seen = np.empty((len(flat), HIDDEN + 1 + WIDTH), np.float32), np.empty((size, CONTEXT, 2 * WIDTH), np.float32)
            du = last[:, : HIDDEN + 1]
            if len(rows) < len(flat):
                du[:] = 0
            du[rows] = dh
            g_join += s["c"].T @ du
            dc, a = (du @ t["join"].T).reshape(size, STRIDE, WIDTH), s["a"]
            ds = dc @ s["v"].transpose(0, 2, 1)
            seen[:, :, WIDTH:] = a.transpose(0, 2, 1) @ dc
            ds *= a
            ds -= a * (ds.reshape(-1, CONTEXT) @ np.ones(CONTEXT, np.float32)).reshape(size, STRIDE, 1)
            ds_near += ds.sum(axis=0)
            seen[:, :, :WIDTH] = ds.transpose(0, 2, 1) @ s["q"]
            last[:, HIDDEN + 1:] = (ds @ s["k"]).reshape(-1, WIDTH)
            there = np.maximum(inputs[at: at + SUMMED], 0)
            _add_by_slot(of_last, there[:, CONTEXT - STRIDE:].reshape(-1), last)
            _add_by_slot(of_before, there[:, CONTEXT - STRIDE - 1: -1].reshape(-1), du)
            _add_by_slot(of_seen, there.reshape(-1), seen.reshape(-1, 2 * WIDTH))
        dq, dk, dv = of_last[:, HIDDEN + 1:] * WIDTH ** -0.5, of_seen[:, :WIDTH], of_seen[:, WIDTH:]
        by_group = g_out[:, :, :GROUPS].sum(axis=0)
        return {
            "embed": dq @ w["q"].T + dk @ w["k"].T + dv @ w["v"].T,
            "q": w["embed"].T @ dq, "k": w["embed"].T @ dk, "v": w["embed"].T @ dv,
            "near": np.bincount(np.abs(_DISTANCE).reshape(-1), weights=np.where(_CAUSAL, ds_near, 0).reshape(-1),
                                minlength=CONTEXT).astype(np.float32),
            "last": of_last[:, :HIDDEN], "before": of_before[:, :HIDDEN],
            "join": g_join[:, :HIDDEN], "join_b": of_last[:, :HIDDEN].sum(axis=0), "group": by_group[:HIDDEN], "group_b": by_group[HIDDEN],
            "member": g_out[:, :HIDDEN, GROUPS:], "member_b": g_out[:, HIDDEN, GROUPS:]}, n

    def gradient_sum(self, inputs: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Gradients of the summed loss, all weights one after the other, and the number of targets as the last value."""
        g, n = self._gradients(inputs, slots)
        return np.append(np.concatenate([g[name].reshape(-1) for name in self.w]).astype(np.float64), n)

    def by_name(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """The values of ``gradient_sum`` as they lie in the weights."""
        ends = np.cumsum([value.size for value in self.w.values()])
        return {name: flat[end - value.size: end].reshape(value.shape) for (name, value), end in zip(self.w.items(), ends.tolist())}

    def train(self, inputs: np.ndarray, slots: np.ndarray, steps: int = STEPS, seed: int = 2) -> None:
        """Adam over random batches of windows."""
        if not len(inputs):
            return
        random = np.random.default_rng(seed)
        adam = Adam(self)
        for step in range(1, steps + 1):
            batch = random.integers(0, len(inputs), size=min(BATCH, len(inputs)))
            g, n = self._gradients(inputs[batch], slots[batch])
            adam.move({name: (value / max(n, 1)).astype(np.float32) for name, value in g.items()},
                      RATE * min(1.0, step / 20) * (1 - step / (steps + 1)) ** 0.7)


class Adam:
    """Steps of the weights by running means of their gradients and squares."""

    def __init__(self, model: Attention) -> None:
        self.model, self.steps = model, 0
        self.mean = {name: np.zeros_like(value) for name, value in model.w.items()}
        self.square = {name: np.zeros_like(value) for name, value in model.w.items()}

    def move(self, gradients: dict[str, np.ndarray], rate: float) -> None:
        self.steps += 1
        w, mean, square = self.model.w, self.mean, self.square
        for name, grad in gradients.items():
            mean[name] = 0.9 * mean[name] + 0.1 * grad
            square[name] = 0.98 * square[name] + 0.02 * grad * grad
            move = mean[name] / (1 - 0.9 ** self.steps) / (np.sqrt(square[name] / (1 - 0.98 ** self.steps)) + 1e-8)
            w[name] = (w[name] - rate * move).astype(np.float32)


def _add_by_slot(sums: np.ndarray, slots: np.ndarray, rows: np.ndarray) -> None:
    """Add the rows to the sums of their slots."""
    order = np.argsort(slots.astype(np.int16), kind="stable")
    sizes = np.bincount(slots, minlength=SLOTS)
    some = np.flatnonzero(sizes)
    sums[some] += np.add.reduceat(np.take(rows, order, axis=0), (np.cumsum(sizes) - sizes)[some], axis=0)


def _log_sums(logits: np.ndarray, safe: bool) -> np.ndarray:
    """Logs of the summed powers of each row's groups and members, added; ``safe`` where no power can overflow or vanish."""
    both = logits.reshape(-1, MEMBERS)
    top = None if safe or not _wide(both) else both.max(axis=1)
    powers = np.exp(both) if top is None else np.exp(both - top[:, None])
    logs = np.log(powers @ np.ones(MEMBERS, np.float32))
    if top is not None:
        logs += top
    return logs[::2] + logs[1::2]
