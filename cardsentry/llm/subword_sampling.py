"""Sampled segmentations of texts over a SentencePiece vocabulary, without replacement, and decoding.

The lattice of a text has a place before every character and an edge for every piece that spells the characters it
spans. A path is a segmentation; its probability is the product of its pieces' weights over the sum of all paths. The
vocabulary's scores are ranks, so a piece of rank r weighs (r + 3)^-alpha; a character without a piece of its own is an
edge of its bytes.

Gumbel top-k: if every path had its log-probability perturbed by its own Gumbel noise, the k largest would be k samples
without replacement. They are found without listing paths, by a best-first search over sets of paths: all paths that
share a beginning and leave it by other edges than those already taken. The largest perturbed value of such a set is
itself Gumbel distributed around the log of the set's mass, cut off at the value of the set it was split from, so that
bound is drawn exactly and not estimated. The search takes the set with the largest bound, samples its best path from
the lattice, emits it, and splits the rest at every later place. The bound that leads after k paths is the threshold t of
the inclusion score 1 - exp(-exp(log p - t)): the probability that a path is among the samples, given t. Scores of long texts
are too small for a number, so their logarithms are returned.

No piece goes on from other characters into a space, and none holds a line end or tab beside other characters, so a text
is a chain of the lattices of its words ("units": spaces and what follows them, or a line end). Their conditional edge probabilities are kept for words seen often. All random numbers come from
a counter-based generator whose key is the row's, so a row has the same samples wherever and in whatever batch it is computed.
"""

import gc
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import batches, let_go, lists, mix64

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 1.0
KNOWN_EDGES = 2_000_000
SPACE = "▁"
UNITS = re.compile(f"{SPACE}*[^{SPACE}\n\t]+|{SPACE}+|[\n\t]")
TOGETHER = 300_000  # characters whose texts are searched side by side
ADDED = 40_000  # characters of words whose lattices are built side by side
AHEAD = 384  # edges of a path for which bounds are drawn at a time
KINDS = (np.int32, np.int32, np.int32, np.float64, np.int32, np.int32)
LAST = 1 << 21  # marks the last character of a unit
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Numbers by keys of 63 bits, in arrays: a key lies at its own place or, if that is taken, at the next free one."""

    def __init__(self, bits: int = 16):
        self.shift, self.used = np.uint64(64 - bits), 0
        self.keys, self.values = np.full(1 << bits, -1), np.full(1 << bits, -1, np.int32)

    def place_of(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * SPREAD) >> self.shift).view(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add different keys that are not there yet."""
        self.used += len(keys)
        if 2 * self.used > len(self.keys):
            full = self.keys >= 0
            keys, values = np.concatenate([self.keys[full], keys]), np.concatenate([self.values[full], values])
            self.__init__((3 * len(keys)).bit_length())
            self.used = len(keys)
        at = self.place_of(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] < 0]
            self.keys[at[free]] = keys[free]  # one of those with the same place stays
            free = free[self.keys[at[free]] == keys[free]]
            self.values[at[free]] = values[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) % len(self.keys)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of keys, -1 for those that are not there."""
        at = self.place_of(keys)
        here = self.keys.take(at)
        hit = here == keys
        found = np.where(hit, self.values.take(at), -1)
        left = np.flatnonzero(~hit & (here >= 0))
        while len(left):  # another key has the place
            at[left] = (at[left] + 1) % len(self.keys)
            here = self.keys[at[left]]
            hit = here == keys[left]
            found[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (here >= 0)]
        return found


class Vocabulary:
    """Pieces of a model file that was read on the driver."""

    def __init__(self, proto: bytes, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.model = model
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        # a special piece is none of a text; pieces without a rank (spaces alone) count as the last ones
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.byte_id = {int(names[i][3:-1], 16): i for i in range(n) if model.is_byte(i)}
        byte_of = {i: bytes([b]) for b, i in self.byte_id.items()}
        self.pieces = [byte_of.get(i, p.encode()) for i, p in enumerate(names)]
        self.spelling = pa.array(self.pieces, pa.large_binary())
        self.byte_weight = float((n + 3) ** -alpha)
        self.longest = max(len(names[i]) for i in plain)
        if any(len(names[i]) > 1 and (SPACE in names[i].lstrip(SPACE) or re.search("[\n\t]", names[i])) for i in plain):
            raise ValueError("a piece of this vocabulary spans words")
        # the pieces as a tree: a node is a beginning of pieces, found by (node above, character)
        node_of = {"": 0}
        for i in plain:
            for j in range(1, len(names[i]) + 1):
                node_of.setdefault(names[i][:j], len(node_of))
        steps = sorted(((node_of[p[:-1]] << 21) + ord(p[-1]), at) for p, at in node_of.items() if p)
        step_key = np.array([k for k, _ in steps])
        step_node = np.array([at for _, at in steps])
        self.node_id = np.full(len(node_of), -1)
        self.node_weight = np.zeros(len(node_of))
        for i in plain:
            self.node_id[node_of[names[i]]] = i
            self.node_weight[node_of[names[i]]] = (min(-model.get_score(i), n) + 3) ** -alpha
        self.root = np.full(0x110000, -1)  # the nodes of one character
        self.root[step_key[step_key < 1 << 21]] = step_node[step_key < 1 << 21]
        self.inner = np.zeros(len(node_of), bool)  # nodes that have some below them
        self.inner[step_key >> 21] = True
        self.steps = Table()
        self.steps.put(step_key, step_node)
        # an edge of several bytes has a number of its own, after the pieces
        self.spelled: list[list[int]] = []
        self.spelled_of: dict[int, int] = {}

    def bytes_edge(self, char: int) -> tuple[int, float]:
        ids = [self.byte_id[b] for b in chr(char).encode()]
        if char not in self.spelled_of:
            self.spelled_of[char] = len(self.pieces) + len(self.spelled)
            self.spelled.append(ids)
        return self.spelled_of[char], self.byte_weight ** len(ids)

    def below(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The nodes one character further, -1 where there is none."""
        return self.steps.get((nodes.astype(np.int64) << 21) + chars)

    def prepared(self, text: str) -> str:
        """The normal form that the pieces spell."""
        return self.model.normalize(text) if text else ""

    def ids_of(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of edges, and where those of every edge begin and the last ones end."""
        n = len(self.pieces)
        odd = np.flatnonzero(edges >= n)
        if not len(odd):
            return edges, np.arange(len(edges) + 1)
        kinds, kind = np.unique(edges[odd], return_inverse=True)
        spelled = [self.spelled[e - n] for e in kinds.tolist()]
        size = np.ones(len(edges), np.int64)
        size[odd] = np.array([len(x) for x in spelled])[kind]
        ids = np.repeat(edges, size)
        begin = np.concatenate([[0], np.cumsum(size)])
        at = begin[odd]
        for j in range(int(size.max())):
            some = size[odd] > j
            ids[at[some] + j] = np.array([x[j] if j < len(x) else 0 for x in spelled])[kind[some]]
        return ids, begin


def bounds(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The characters of all texts; and per unit of a text, in order: where it begins, its characters, and the number of
    its text. Same units as those that ``UNITS`` finds."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32)
    if not len(chars):
        return chars, *(np.zeros(0, np.int64) for _ in range(3))
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    mark, line = chars == ord(SPACE), (chars == 10) | (chars == 9)
    begin = line.copy()
    begin[1:] |= (mark[1:] & ~mark[:-1]) | (line[:-1] & ~mark[1:])
    text_at = np.cumsum(size) - size
    begin[text_at[size > 0]] = True
    at = np.flatnonzero(begin)
    return chars, at, np.diff(at, append=len(chars)), np.searchsorted(text_at, at, side="right") - 1


def sums_of(chars: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A sum per unit, from its characters and their places in it; equal units have equal sums."""
    sums = np.add.reduceat(mix64(chars.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(21))), at)
    return (sums >> np.uint64(1)).view(np.int64)


def cut(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The units that occur in the texts, each once; and per unit of a text, in order: which of those it is, its
    characters, and the number of its text."""
    _, at, length, text = bounds(texts)
    whole = "".join(texts)
    units = [whole[a:b] for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
    names = {u: i for i, u in enumerate(dict.fromkeys(units))}
    return list(names), np.fromiter(map(names.get, units), np.int64, len(units)), length, text


def spells(vocabulary: Vocabulary, ids: np.ndarray, lengths: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Per sequence, one after the other in ``ids``, whether its pieces spell the text."""
    spelled = vocabulary.spelling.take(pa.array(ids))
    ends = np.frombuffer(spelled.buffers()[1], np.int64)[: len(ids) + 1]
    ends = ends[np.concatenate([[0], np.cumsum(lengths)])].tolist()
    blob = memoryview(spelled.buffers()[2] or b"")
    return np.array([bytes(blob[a:b]) == t for a, b, t in zip(ends, ends[1:], texts, strict=False)], bool)


class Lattices:
    """Units' lattices as arrays: per place its edges with their probabilities."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.known = Table()  # states before units, by the units' sums
        self.room = [np.empty(KNOWN_EDGES + (1 << 20), k) for k in KINDS]
        self.used = [0] * len(KINDS)

    def append(self, parts: tuple) -> None:
        for k, part in enumerate(parts):
            end = self.used[k] + len(part)
            if end > len(self.room[k]):
                self.room[k] = np.concatenate([self.room[k], np.empty(end, KINDS[k])])
            self.room[k][self.used[k] : end] = part
            self.used[k] = end

    def arrays(self) -> tuple[np.ndarray, ...]:
        """(first edge of a state; per edge its number, next state or -1 at the unit's end, probability, negative for the
        last edge of a state; how many times a state was asked for, once for all texts that are searched side by side; the
        character after a state, with ``LAST`` for the last of a unit)."""
        return tuple(room[:n] for room, n in zip(self.room, self.used, strict=True))

    @property
    def state_of(self) -> dict[str, int]:
        """The states before the units that are known, by name."""
        spelled, base, _ = self.units()
        names = (spelled & (LAST - 1)).tobytes().decode("utf-32-le")
        return {names[a:b]: a for a, b in zip(base.tolist(), [*base[1:].tolist(), len(names)], strict=True)}

    def units(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The characters of all states; the first state and the size of every unit."""
        spelled = self.arrays()[5]
        size = np.diff(np.flatnonzero(spelled >= LAST), prepend=-1)
        return spelled, np.cumsum(size) - size, size

    def states(self, chars: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The states before the units, which begin in ``chars`` one after the other; a unit of n characters has the n
        states from there on."""
        if not len(at):
            return np.zeros(0, np.int64)
        if self.used[1] > KNOWN_EDGES:
            self.thin()
        place = np.arange(len(chars)) - np.repeat(at, length)
        sums = sums_of(chars, place, at)
        found = self.known.get(sums).astype(np.int64)
        absent = np.flatnonzero(found < 0)
        if len(absent):
            new, one, kind = np.unique(sums[absent], return_index=True, return_inverse=True)
            one = absent[one]
            states = self.add_all(chars, at[one], length[one])
            self.known.put(new, states)
            found[absent] = states[kind]
        # units of equal sums are compared by their characters; one that differs has a lattice of its own
        own = chars.copy()
        own[at + length - 1] |= LAST
        odd = np.flatnonzero(self.arrays()[5].take(place + np.repeat(found, length), mode="clip") != own)
        if len(odd):
            odd = np.unique(np.searchsorted(at, odd, side="right") - 1)
            names = [chars[a : a + n].tobytes().decode("utf-32-le") for a, n in zip(at[odd].tolist(), length[odd].tolist(), strict=True)]
            names, kind, *_ = cut(names)
            whole, begins, size, _ = bounds(names)
            found[odd] = self.add_all(whole, begins, size)[kind]
        self.room[4][found] += 1
        return found

    def thin(self) -> None:
        """Forget the units that were not asked for twice since the last time; the others stay up to half of the room."""
        spelled, base, size = self.units()
        first, number, to, p, asked, _ = self.arrays()
        edge_at = np.append(first, len(to))
        edges = edge_at[base + size] - edge_at[base]
        order = np.argsort(-asked[base], kind="stable")
        keep = np.sort(order[(asked[base[order]] > 1) & (np.cumsum(edges[order]) <= KNOWN_EDGES // 2)])
        base, size, edges = base[keep], size[keep], edges[keep]
        low = edge_at[base]
        begins = np.cumsum(size) - size
        state_shift = base - begins
        edge_shift = low - (np.cumsum(edges) - edges)
        place = np.arange(size.sum())
        state = place + np.repeat(state_shift, size)
        edge = np.arange(edges.sum()) + np.repeat(edge_shift, edges)
        to = np.where(to[edge] >= 0, to[edge] - np.repeat(state_shift, edges), -1)
        chars = spelled[state]
        kept = (first[state] - np.repeat(edge_shift, size), number[edge], to, p[edge], np.zeros(len(state), np.int32), chars)
        self.clear()
        self.append(kept)
        if len(keep):
            self.known.put(sums_of(chars & (LAST - 1), place - np.repeat(begins, size), begins), begins)

    def add_all(self, chars: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """``add`` some units at a time."""
        parts = np.flatnonzero(np.diff(np.cumsum(length) // ADDED, prepend=0)).tolist()
        states = [np.zeros(0, np.int64)]
        for low, high in zip([0, *parts], [*parts, len(at)], strict=True):
            if low < high:
                states.append(self.add(chars, at[low:high], length[low:high]))
        return np.concatenate(states)

    def add(self, chars: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Sum the paths from every place to the unit's end, all units side by side, and from that the edges. Returns the
        states before the units."""
        v = self.vocabulary
        longest = np.argsort(-length, kind="stable")
        size = length[longest]
        total = int(size.sum())
        ends = np.cumsum(size)
        chars = chars[np.arange(total) + np.repeat(at[longest] - ends + size, size)].astype(np.int64)
        end_of = np.repeat(ends, size)
        # the pieces from every place on, shorter ones first; a place without a piece of one character has its bytes
        at, node = np.arange(total), v.root[chars]
        levels = []
        for k in range(v.longest):
            weight = v.node_weight[node] * (node >= 0)
            on = weight > 0
            levels.append((at[on], np.full(int(on.sum()), k), weight[on], v.node_id[node[on]]))
            if not k:
                bare = np.flatnonzero(~on)
                for char in np.unique(chars[bare]).tolist():
                    number, weight = v.bytes_edge(char)
                    where = bare[chars[bare] == char]
                    levels.append((where, np.zeros(len(where), np.int64), np.full(len(where), weight), np.full(len(where), number)))
            on = (node >= 0) & (at + k + 1 < end_of[at]) & v.inner[node]
            at = at[on]
            if not len(at):
                break
            node = v.below(node[on], chars[at + k + 1])
        # long pieces first, which are the likely ones
        place, k, weight, number = (np.concatenate(part) for part in zip(*reversed(levels), strict=True))
        order = np.argsort(place.astype(np.uint16) if total < 1 << 16 else place, kind="stable")
        place, k, number = place[order], k[order], number[order]
        # edges by the characters left to the unit's end: each is summed after those that it leads to
        rest = (end_of - np.arange(total))[place]
        turn = np.argsort(rest.astype(np.uint16) if size[0] < 1 << 16 else rest, kind="stable")
        share = weight[order][turn]
        # sums[i] belongs to place i of a unit plus one slot for every earlier unit's end and for its own
        sums = np.zeros(total + len(size) + v.longest)
        slot_end = ends + np.arange(len(size))
        sums[slot_end] = 1.0
        slot = (np.arange(total) + np.repeat(np.arange(len(size)), size))[place[turn]]
        onto = slot + k[turn] + 1
        begin = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))  # of a place's edges
        fan = np.diff(np.append(begin, len(slot)))
        source = slot[begin]
        edge_of = np.searchsorted(rest[turn], np.arange(1, int(size[0]) + 2)).tolist()
        place_of = np.searchsorted(begin, edge_of).tolist()
        for e, e_end, i, i_end in zip(edge_of, edge_of[1:], place_of, place_of[1:], strict=False):
            w = share[e:e_end] * sums[onto[e:e_end]]
            s = np.add.reduceat(w, begin[i:i_end] - e)
            share[e:e_end] = w / np.repeat(s, fan[i:i_end])
            sums[source[i:i_end]] = s
            if s.min() < 1e-200:  # only ratios matter: lift the sums that are still to be used
                low = np.flatnonzero(s < 1e-200)
                last = slot_end[np.searchsorted(slot_end, source[i:i_end][low])]
                span = np.minimum(source[i:i_end][low][:, None] + np.arange(v.longest + 1), last[:, None])
                lifted = sums[span] * 1e150
                sums[span] = lifted
        p = np.empty(len(share))
        p[turn] = share
        some = p > 0
        if not some.all():
            place, k, number, p = place[some], k[some], number[some], p[some]
        count = np.bincount(place, minlength=total)
        last = np.cumsum(count) - 1
        first = last + 1 - count
        p[last] *= -1
        base, earlier = self.used[0], self.used[1]
        to = place + k + 1
        to = np.where(to < end_of[place], base + to, -1)
        chars[ends - 1] |= LAST
        self.append((earlier + first, number, to, p, np.zeros(total, np.int32), chars))
        states = np.empty(len(size), np.int64)
        states[longest] = base + ends - size
        return states


def walk(arrays: tuple, states: np.ndarray, begins: np.ndarray, draws: np.ndarray) -> np.ndarray:
    """Sample a path from every state to its unit's end. ``begins`` are the states' places in the text, for each of which
    there is a number in ``draws``. Returns the edge row that starts at each place, or -1."""
    first, _, to, p, *_ = arrays
    taken = np.full(len(draws), -1, np.int64)
    now, shift = states, begins - states
    while len(now):
        place = now + shift
        u = draws[place]
        at = first[now]
        share = p[at]
        left = np.flatnonzero((u >= share) & (share > 0))  # the last edge takes what rounding leaves
        u, share = u[left], share[left]
        while len(left):
            u -= share
            at[left] += 1
            share = p[at[left]]
            on = (u >= share) & (share > 0)
            left, u, share = left[on], u[on], share[on]
        taken[place] = at
        now = to[at]
        on = now >= 0
        now, shift = now[on], shift[on]
    return taken


class Search:
    """Best-first search over sets of paths of one text."""

    def __init__(self, states: np.ndarray, begins: np.ndarray, length: int, seed: int, arrays: tuple):
        self.states, self.begins, self.length, self.arrays = states, begins, length, arrays
        self.rng = np.random.Generator(np.random.Philox(key=seed))
        self.top = self.gumbel(1)[0]  # the largest value of all paths: their mass is 1
        self.draws = self.rng.random(length)  # of the first path
        self.found: list[dict] = []

    def gumbel(self, n: int) -> np.ndarray:
        return -np.log(-np.log(np.maximum(self.rng.random(n), 2.0**-54)))

    def emit(self, place: np.ndarray, rows: np.ndarray, split: int, barred: list[int], value: float) -> None:
        """Take a path (its places and edge rows) and split the rest of its set: at the edge ``split``, that edge is
        barred with those barred before, at every later one the path's own edge is."""
        p = np.abs(self.arrays[3][rows])
        log = np.log(p)
        path = {"place": place, "rows": rows, "value": value, "split": split, "barred": [*barred, int(rows[max(split, 0)])]}
        path.update({"p": p, "logs": log, "log": float(log.sum()), "before": 0.0, "bound": np.zeros(0)})
        self.found.append(path)
        self.bound(path)

    def bound(self, path: dict) -> None:
        """Draw the bounds of the next places where the path is left."""
        low = len(path["bound"])
        p, log = path["p"][low : low + AHEAD], path["logs"][low : low + AHEAD]
        with np.errstate(divide="ignore"):
            rest = np.log(np.where(p < 1 - 1e-12, 1 - p, 0.0))
        mass = path["before"] + np.cumsum(log) - log + rest
        split = path["split"] - low
        if split > 0:
            mass[:split] = -np.inf  # those sets were split off the path before
        if 0 <= split < len(p):
            left = np.abs(self.arrays[3][self.edges(path["rows"][path["split"]], path["barred"])]).sum()
            mass[split] = path["before"] + log[:split].sum() + (np.log(left) if left > 0 else -np.inf)
        path["before"] += float(log.sum())
        noise = self.gumbel(len(p))
        with np.errstate(invalid="ignore"):
            bound = -np.logaddexp(-path["value"], -mass - noise)
        bound[~np.isfinite(mass)] = -np.inf
        path["bound"] = np.concatenate([path["bound"], bound])

    def edges(self, row: int, barred: list[int]) -> list[int]:
        first, to = self.arrays[0], self.arrays[2]
        state = int(np.searchsorted(first, first.dtype.type(row), side="right")) - 1
        high = int(first[state + 1]) if state + 1 < len(first) else len(to)
        return [r for r in range(int(first[state]), high) if r not in barred]

    def lead(self) -> tuple[float, dict | None, int]:
        """(bound, path, edge) of the set with the largest bound."""
        while True:
            best = (-np.inf, None, -1)
            for path in self.found:
                if len(path["bound"]):
                    at = int(path["bound"].argmax())
                    if path["bound"][at] > best[0]:
                        best = (float(path["bound"][at]), path, at)
            # noise has at most 38 from numbers of 53 bits, so places not drawn yet stay below this
            more = [p for p in self.found if len(p["bound"]) < len(p["rows"]) and p["before"] + 38 > best[0]]
            if not more:
                return best
            for path in more:
                self.bound(path)

    def leave(self) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Choose the edge by which the best path of the leading set leaves the path it was split from. Returns what ``walk``
        needs for the rest of it, places counted from the edge on; None if all paths are out."""
        value, path, at = self.lead()
        if path is None:
            return None
        path["bound"][at] = -np.inf
        row = int(path["rows"][at])
        barred = path["barred"] if at == path["split"] else [row]
        allowed = self.edges(row, barred)
        share = np.cumsum(np.abs(self.arrays[3][allowed]))
        u = self.rng.random() * share[-1]
        chosen = allowed[min(int(np.searchsorted(share, u, side="right")), len(allowed) - 1)]
        place = int(path["place"][at])
        unit = int(np.searchsorted(self.begins, place, side="right"))
        start, begins, to = self.states[unit:], self.begins[unit:], int(self.arrays[2][chosen])
        if to >= 0:  # the unit goes on after the edge
            base, begin = self.states[unit - 1], self.begins[unit - 1]
            start, begins = np.append(start, to), np.append(begins, begin + to - base)
        self.left = path, at, chosen, barred, value
        return start, begins - place, self.rng.random(self.length - place)

    def take(self, taken: np.ndarray) -> None:
        """Emit the path that ``leave`` began and ``walk`` has ended."""
        path, at, chosen, barred, value = self.left
        later = np.flatnonzero(taken >= 0)
        place = np.concatenate([path["place"][: at + 1], later + path["place"][at]])
        self.emit(place, np.concatenate([path["rows"][:at], [chosen], taken[later]]), at, barred, value)


def log_inclusion(ahead: float) -> float:
    """log(1 - exp(-exp(ahead))), also where the score itself is too small for a number."""
    if ahead > 5:
        return 0.0
    return ahead if ahead < -30 else float(np.log(-np.expm1(-np.exp(ahead))))


def segmentations(
    texts: list[str], seeds: list[int], samples: int, lattices: Lattices
) -> Iterator[list[tuple[np.ndarray, float, float, float]]]:
    """Per text its samples (edge numbers, log p, perturbed value, log of the inclusion score), the largest value first."""
    chars, begins, length, text_of = bounds(texts)
    states = lattices.states(chars, begins, length)
    arrays = lattices.arrays()
    ends = np.searchsorted(text_of, np.arange(len(texts)), side="right").tolist()
    searches, low = [], 0
    for end, text, seed in zip(ends, texts, seeds, strict=True):
        searches.append(Search(states[low:end], begins[low:end] - begins[low], len(text), seed, arrays) if text else None)
        low = end
    # paths of all texts are walked together
    live = [s for s in searches if s]
    parts = [(s.states, s.begins, s.draws) for s in live]
    for n in range(samples):
        if n:
            parts = [s.leave() for s in live]
            live = [s for s, part in zip(live, parts, strict=True) if part]
            parts = [part for part in parts if part]
        if not live:
            break
        size = np.array([len(draws) for *_, draws in parts])
        low = np.cumsum(size) - size
        begins = np.concatenate([begin + at for (_, begin, _), at in zip(parts, low.tolist(), strict=True)])
        taken = walk(arrays, np.concatenate([state for state, *_ in parts]), begins, np.concatenate([d for *_, d in parts]))
        for search, own in zip(live, np.split(taken, low[1:]), strict=True):
            if n:
                search.take(own)
            else:
                place = np.flatnonzero(own >= 0)
                search.emit(place, own[place], -1, [], search.top)
    for search in searches:
        if search is None:
            yield []
            continue
        threshold = search.lead()[0]
        out = []
        for path in search.found:
            log = path["log"]
            out.append((arrays[1][path["rows"]], log, path["value"], log_inclusion(log - threshold)))
        yield out


@lru_cache(maxsize=1)
def lattices_of(proto: bytes, alpha: float) -> Lattices:
    """One vocabulary a worker, and the lattices it has met, for all tasks that the worker runs."""
    lattices = Lattices(Vocabulary(proto, alpha))
    gc.freeze()  # what is there now stays; collections needn't visit it
    return lattices


def sample_segmentations(
    docs: DataFrame,
    key: str = "doc_id",
    path: str = MODEL,
    samples: int = SAMPLES,
    alpha: float = ALPHA,
    seed: int = 5,
    decoded: bool = False,
) -> DataFrame:
    """One row per row of ``docs(key, text)`` and sample: key, sample (1 for the largest perturbed value), ids,
    n_tokens, log_prob, perturbed, log_inclusion, round_trip (the ids decode to the text itself, character by character; a
    text that holds U+2581, which decodes to a space, has none).

    Texts of one possible segmentation, or of fewer than ``samples``, give all they have, with log_inclusion 0. Null and
    empty texts give one sample without ids, of probability 1. Rows with equal keys and texts are sampled alike; null
    keys too. An empty table gives an empty one; other columns are ignored. With ``decoded``, the text that ``decode`` finds
    for the ids is a last column: the same worker spells it, so no second one has to hold the model.
    """
    with open(path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    names = [key, "sample", "ids", "n_tokens", "log_prob", "perturbed", "log_inclusion", "round_trip"]
    names += ["text"] if decoded else []

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()  # of what this worker's tasks of earlier stages left
        lattices = lattices_of(shared.value, alpha)
        vocabulary = lattices.vocabulary
        model = vocabulary.model
        for part in batches(parts):
            seeds = [s & ((1 << 64) - 1) for s in part["seed"].to_pylist()]
            size = pc.fill_null(pc.utf8_length(part["text"]), 0).to_pylist()
            i = 0
            while i < len(size):
                j, chars = i + 1, size[i]
                while j < len(size) and chars + size[j] <= TOGETHER:
                    chars += size[j]
                    j += 1
                given = [t or "" for t in part["text"].slice(i, j - i).to_pylist()]
                texts = [vocabulary.prepared(t) for t in given]
                # what the pieces of the normal form decode to: marks are spaces, the first one is put in front
                whole = [n.replace(SPACE, " ") == (f" {t}" if t else "") for n, t in zip(texts, given, strict=True)]
                paths, rows, scores = [], [], []
                for k, found in enumerate(segmentations(texts, seeds[i:j], samples, lattices)):
                    for n, (edges, *numbers) in enumerate(found or [(np.zeros(0, np.int32), 0.0, 0.0, 0.0)]):
                        paths.append(edges)
                        rows.append((k, n + 1))
                        scores.append(numbers)
                at = np.array(rows)
                values = np.array(scores)
                ids, begin = vocabulary.ids_of(np.concatenate(paths))
                ends = begin[np.cumsum([len(x) for x in paths])]
                lengths = np.diff(ends, prepend=0)
                coded = [t.encode() for t in texts]
                flags = spells(vocabulary, ids, lengths, [coded[t] for t, _ in rows]) & np.array([whole[t] for t, _ in rows])
                yield pa.record_batch(
                    [
                        part["key"].slice(i, j - i).take(pa.array(at[:, 0])),
                        pa.array(at[:, 1], pa.int32()),
                        lists(ids.astype(np.int32, copy=False), lengths, pa.int32()),
                        pa.array(lengths, pa.int64()),
                        *(pa.array(values[:, c]) for c in range(3)),
                        pa.array(flags),
                        *([pa.array([model.decode(x.tolist()) for x in np.split(ids, ends[:-1])], pa.string())] if decoded else []),
                    ],
                    names,
                )
                i = j
        let_go()

    kind = docs.schema[key].dataType.simpleString()
    schema = (
        f"`{key}` {kind}, sample int, ids array<int>, n_tokens long, log_prob double, perturbed double, "
        "log_inclusion double, round_trip boolean" + (", text string" if decoded else "")
    )
    own: Column = F.xxhash64(F.col(key), F.lit(seed))
    return docs.select(F.col(key).alias("key"), own.alias("seed"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """``encoded`` with the text that its column ``ids`` spells, in place of a column text. Null ids give null; bytes that
    are no UTF-8 become replacement characters."""
    with open(path, "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("string")
    def text_of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for part in parts:
            yield pd.Series([None if x is None else model.decode(x.tolist()) for x in part], dtype=object)

    return encoded.withColumn("text", text_of("ids"))
