"""Piece lattices of texts and Gumbel top-k search over them, on arrays of many texts at once.

A text becomes units that no piece crosses: a run of blanks with what follows up to the next blank.
The lattice of a text is the chain of its units' lattices, and equal units share one. Edges are
pieces; the chance of an edge, given where it starts, comes from backward sums over the lattice, so
walking the edges draws a whole segmentation with its exact probability.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import sentencepiece

BLANK = "▁"
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x100000001B3 * 2654435761 % (1 << 64) | 1)
_UNIFORM = 2.0**-53
_SHIFT = np.uint64


def uniform(state: np.ndarray) -> np.ndarray:
    """One number in (0, 1) for each 64-bit state, always the same one."""
    z = state + _A
    z = (z ^ (z >> _SHIFT(30))) * _B
    z = (z ^ (z >> _SHIFT(27))) * _C
    z ^= z >> _SHIFT(31)
    return ((z >> _SHIFT(11)).astype(np.float64) + 0.5) * _UNIFORM


class Pieces:
    """The pieces of a model, found by hash; prefixes of pieces are entries as well, to end a search early.

    ``alpha`` sharpens (above 1) or flattens the weights. A piece weighs its score in a unigram
    model. Where scores are negated merge ranks, which are no probabilities, it weighs
    ``-log(2 + rank)``, the frequency that Zipf's law gives the rank.
    """

    def __init__(self, model: str, alpha: float = 1.0):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.model.get_piece_size()
        special = [self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i) for i in range(size)]
        self.byte_ids = {}
        names = {}
        for i in range(size):
            name = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.byte_ids[int(name[3:5], 16)] = i
            elif not special[i]:
                names[name] = i
        scores = np.array([self.model.get_score(i) for i in range(size)])
        ranks = min(scores[i] for i in names.values() if scores[i] > -1e8) < -1000
        weights = -np.log(2.0 + np.where(scores > -1e8, -scores, size)) if ranks else scores
        self.weights = alpha * weights
        self.unknown = self.model.unk_id()
        self.bytes = [self.model.id_to_piece(i).encode() for i in range(size)]
        for value, i in self.byte_ids.items():
            self.bytes[i] = bytes([value])
        self.longest = max(map(len, names))
        # Code points of every piece, one after the other, to see that a piece spells the stretch it was found for.
        self.code_start = np.zeros(size, np.int64)
        held, flat = 0, []
        for name, i in names.items():
            self.code_start[i] = held
            flat.append(name)
            held += len(name)
        self.codes = np.frombuffer("".join(flat).encode("utf-32-le"), "<u4").astype(np.int64)
        inner = any(BLANK in name.lstrip(BLANK) for name in names) or any("\n" in name for name in names)
        self.units = re.compile(r"(?s).+") if inner else re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n+")
        entries: dict[int, int] = {}
        for name, i in names.items():
            h = 0
            for k, char in enumerate(name):
                h = (h * int(_BASE) + ord(char) + 1) % (1 << 64)
                entries.setdefault(h, -1)
                if k + 1 == len(name):
                    entries[h] = i
        self._table(entries)

    def _table(self, entries: dict[int, int]) -> None:
        bits = max(int(np.ceil(np.log2(len(entries)))) + 3, 8)
        self.shift, mask = np.uint64(64 - bits), (1 << bits) - 1
        keys, values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -2, np.int32)
        for h, i in entries.items():
            at = (h * int(_A) % (1 << 64)) >> (64 - bits)
            while values[at] != -2:
                at = (at + 1) & mask
            keys[at], values[at] = h, i
        self.keys, self.values, self.mask = keys, values, mask

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash; -1 for a prefix of pieces only, -2 for neither."""
        at = ((h * _A) >> self.shift).astype(np.int64)
        out = self.values[at]
        open_ = np.flatnonzero((out != -2) & (self.keys[at] != h))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            out[open_] = self.values[at]
            more = (out[open_] != -2) & (self.keys[at] != h[open_])
            open_, at = open_[more], at[more]
        return out

    def split(self, text: str) -> list[str]:
        return self.units.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def ids_of_char(self, code: int) -> list[int]:
        """A character without a piece: its bytes, or the unknown piece where the model has no bytes."""
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in chr(code).encode()]

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.bytes.__getitem__, ids.tolist()))
        return data.decode("utf-8", "replace").replace(BLANK, " ").removeprefix(" ")


class _Numbers(dict):
    """Numbers things in the order in which they are first met."""

    def __missing__(self, thing: str) -> int:
        self[thing] = number = len(self)
        return number


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, …`` for ``size[i]`` places, one after the other."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - first, size)


class Lattice:
    """Lattices of distinct units, one after the other; units can be added, and kept from text to text.

    Edge arrays are in the order of their starts, longest first. ``first`` is the place where a unit
    begins; an edge leads to ``target`` unless it ``ends`` its unit.
    """

    EDGES = {"piece": np.int32, "target": np.int32, "ends": bool, "spells": bool, "logp": np.float64, "upto": np.float64}

    def __init__(self, pieces: Pieces, units: list[str] = ()):
        self.pieces = pieces
        self.number = _Numbers()
        self._empty()
        for unit in units:
            self.number[unit]
        self.grow()

    def _empty(self) -> None:
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.begin, self.uses = np.zeros(1, np.int64), np.zeros(0, np.int64)
        for name, kind in self.EDGES.items():
            setattr(self, name, np.zeros(0, kind))

    def grow(self) -> None:
        """Add the lattices of units that were numbered since the last time."""
        fresh = list(self.number)[len(self.first) :] if len(self.number) > len(self.first) else []
        if not fresh:
            return
        part = self._part(fresh)
        nodes, edges = len(self.begin) - 1, len(self.piece)
        part["target"] = np.where(part["ends"], 0, part["target"] + nodes)
        self.first = np.append(self.first, part["first"] + nodes)
        self.length = np.append(self.length, part["length"])
        self.begin = np.append(self.begin, part["begin"][1:] + edges)
        self.uses = np.append(self.uses, np.zeros(len(fresh), np.int64))
        for name, kind in self.EDGES.items():
            setattr(self, name, np.concatenate((getattr(self, name), part[name].astype(kind))))

    def shrink(self, most: int) -> None:
        """Keep at most ``most`` units, the more used ones, and of those only what came twice. Numbers change."""
        order = np.argsort(-self.uses, kind="stable")[:most]
        keep = np.sort(order[self.uses[order] > 1])
        names = list(self.number)
        old = {name: getattr(self, name) for name in ("first", "length", "begin", "uses", *self.EDGES)}
        self._empty()
        self.number = _Numbers(zip([names[n] for n in keep.tolist()], range(len(keep))))
        self.length, self.uses = old["length"][keep], old["uses"][keep] // 2
        self.first = np.cumsum(self.length) - self.length
        nodes = ranges(old["first"][keep], self.length)
        degree = np.diff(old["begin"])[nodes]
        self.begin = np.append(0, np.cumsum(degree))
        edges = ranges(old["begin"][nodes], degree)
        for name in self.EDGES:
            setattr(self, name, old[name][edges])
        moved = np.repeat(np.repeat(self.first - old["first"][keep], self.length), degree)
        self.target = np.where(self.ends, 0, self.target + moved).astype(np.int32)

    def _part(self, units: list[str]) -> dict[str, np.ndarray]:
        """The lattices of some units, with places counted from the first of them."""
        pieces = self.pieces
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        n = len(codes)
        first = np.cumsum(lengths) - lengths
        left = np.repeat(first + lengths, lengths) - np.arange(n)
        starts, sizes, ids = self._edges(pieces, codes, left)
        degree = np.zeros(n, np.int64)
        for s in starts:
            degree[s] += 1
        begin = np.append(0, np.cumsum(degree))
        total = int(begin[-1])
        size_of, piece, weight, spells = np.zeros(total, np.int32), np.zeros(total, np.int64), np.zeros(total), np.zeros(total, bool)
        last = begin[1:].copy()
        for s, size, i in zip(starts, sizes, ids):
            at = last[s] - 1
            last[s] = at
            known = np.maximum(i, 0) if size == 1 else i
            begins = pieces.code_start[known]
            same = codes[s] == pieces.codes[begins]
            for k in range(1, size):
                same &= codes[s + k] == pieces.codes[begins + k]
            size_of[at], piece[at], weight[at], spells[at] = size, i, pieces.weights[known], same
            if size == 1:
                bare = at[i < 0]
                weight[bare], spells[bare] = 0.0, bool(pieces.byte_ids)
        source = np.repeat(np.arange(n), degree)
        ends = size_of == left[source]
        # Where an edge leads; the ends of all units are one place, whose backward sum is 0.
        target = np.where(ends, n, source + size_of)
        back = self._backward(weight, target, left, source)
        logp = np.minimum(weight + back[target] - back[source], 0.0)
        upto = np.cumsum(np.exp(logp))
        before = np.append(0.0, upto)[begin[:-1]]
        upto = upto - np.repeat(before, degree)
        upto[begin[1:] - 1] = 2.0
        return {
            "first": first, "length": lengths, "begin": begin, "piece": piece, "target": target, "ends": ends,
            "spells": spells, "logp": logp, "upto": upto,
        }

    @staticmethod
    def _edges(pieces: Pieces, codes: np.ndarray, left: np.ndarray):
        starts, sizes, ids = [], [], []
        active = np.arange(len(codes))
        h = np.zeros(len(codes), np.uint64)
        for size in range(1, pieces.longest + 1):
            if not len(active):
                break
            h = h * _BASE + (codes[active + size - 1] + 1).astype(np.uint64)
            found = pieces.find(h)
            is_piece = found >= 0
            if size == 1:
                # Without a piece of its own a character stands for its bytes; ids below 0 say so.
                found_ids = np.where(is_piece, found, -1 - codes)
                starts.append(active), sizes.append(1), ids.append(found_ids)
            elif is_piece.any():
                starts.append(active[is_piece]), sizes.append(size), ids.append(found[is_piece].astype(np.int64))
            on = (found != -2) & (left[active] > size)
            active, h = active[on], h[on]
        return starts, sizes, ids

    @staticmethod
    def _backward(weight: np.ndarray, target: np.ndarray, left: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Log of the sum over all paths to the unit's end, nearest places first."""
        n = len(left)
        back = np.zeros(n + 1)
        far = left[source]
        small = far.astype(np.uint16) if n and far.max() < 65536 else far
        order = np.argsort(small, kind="stable")
        weight, target, source, far = weight[order], target[order], source[order], far[order]
        heads = np.append(True, source[1:] != source[:-1]) if n else np.zeros(0, bool)
        cuts = np.flatnonzero(np.append(True, far[1:] != far[:-1])) if n else np.zeros(0, np.int64)
        for lo, hi in zip(cuts, np.append(cuts[1:], len(far))):
            values = weight[lo:hi] + back[target[lo:hi]]
            first = np.flatnonzero(heads[lo:hi])
            top = np.maximum.reduceat(values, first)
            sums = np.add.reduceat(np.exp(values - np.repeat(top, np.diff(np.append(first, hi - lo)))), first)
            back[source[lo:hi][first]] = top + np.log(sums)
        return back

    def walk(self, nodes: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A drawn path to its unit's end for every start: how many edges each takes, and all edges in order."""
        count = np.zeros(len(nodes), np.int64)
        steps = []
        active, node, t = np.arange(len(nodes)), nodes, 0
        while len(active):
            u = uniform(state[active] + _C * np.arange(t, t + 1, dtype=np.uint64))
            e = self.begin[node].copy()
            far = np.flatnonzero(u > self.upto[e])
            while len(far):
                e[far] += 1
                far = far[u[far] > self.upto[e[far]]]
            steps.append((active, e))
            count[active] += 1
            on = ~self.ends[e]
            active, node, t = active[on], self.target[e[on]], t + 1
        edges = np.zeros(int(count.sum()), np.int64)
        offset = np.cumsum(count) - count
        for t, (who, e) in enumerate(steps):
            edges[offset[who] + t] = e
        return count, edges


class _Search:
    """A* search for one text: regions of its segmentations by the greatest perturbed value inside.

    A region holds the segmentations that share the first ``at`` edges of a found one and then take
    none of the ``shut`` edges; a tail region those that leave a found one at any later edge.
    """

    NEAR = 48

    def __init__(self, key: np.uint64, k: int):
        self.key, self.k, self.drawn, self.order = key, k, 0, 0
        self.queue: list[tuple] = []
        self.found: list[tuple] = []  # edges, logp of edges, perturbed value

    def take(self, n: int) -> int:
        """The state from which the next ``n`` random numbers of this text are made."""
        self.drawn += n
        return (int(self.key) + (self.drawn - n) * int(_B)) % (1 << 64)

    def uniforms(self, n: int) -> np.ndarray:
        return uniform(np.array([self.take(n)], np.uint64) + np.arange(n, dtype=np.uint64) * _B)

    def push(self, value: float, sample: int, at: int, shut: tuple, tail: bool) -> None:
        self.order += 1
        heapq.heappush(self.queue, (-value, self.order, sample, at, shut, tail))

    def next(self, lattice: Lattice):
        """The region whose greatest value is the next one, or None."""
        while self.queue:
            value, _, sample, at, shut, tail = heapq.heappop(self.queue)
            if not tail:
                return -value, sample, at, shut
            _split_regions([(self, sample, at, (), -value)], lattice, tops=True)
        return None

    def threshold(self) -> float:
        """The value of the first segmentation that was not taken."""
        return -self.queue[0][0] if self.queue else -np.inf


def _split_regions(regions: list[tuple], lattice: Lattice, tops: bool = False) -> None:
    """Split what is left of each region after its found ``sample``, from edge ``at`` on, into parts.

    The greatest value of a part is a Gumbel variable at the logarithm of the part's mass, below
    the region's ``limit``. With ``tops`` the region still holds its greatest value, so one part,
    drawn by mass, keeps ``limit``. Of the parts only those that can still be among the next are queued.
    """
    near_edges = _Search.NEAR
    rows = len(regions)
    near = np.zeros((rows, near_edges))
    used = np.zeros(rows, np.int64)
    head, rest, shut_mass, limits = np.zeros(rows), np.zeros(rows), np.zeros(rows), np.zeros(rows)
    states = []
    for r, (search, sample, at, shut, limit) in enumerate(regions):
        logp = search.found[sample][1]
        window = logp[at : at + near_edges]
        used[r] = n = len(window)
        near[r, :n] = window
        limits[r] = limit
        if at:
            head[r] = logp[:at].sum()
        if at + n < len(logp):
            rest[r] = logp[at + n :].sum()
        if shut:
            shut_mass[r] = np.exp(lattice.logp[list(shut)]).sum()
        states.append(search.take(2 * near_edges + 2))
    before = head[:, None] + np.cumsum(near, axis=1)
    closed = np.exp(near)
    closed[:, 0] += shut_mass
    with np.errstate(divide="ignore", over="ignore"):
        mass = np.full((rows, near_edges + 1), -np.inf)
        inside = (np.arange(near_edges) < used[:, None]) & (closed < 1.0 - 1e-12)
        mass[:, :-1] = np.where(inside, before - near + np.log(np.maximum(1.0 - closed, 1e-300)), -np.inf)
        mass[:, -1] = before[:, -1] + np.log(-np.expm1(rest))
        draws = uniform(np.array(states, np.uint64)[:, None] + np.arange(2 * near_edges + 2, dtype=np.uint64) * _B)
        values = mass - np.log(np.exp(np.minimum(mass - limits[:, None], 700.0)) - np.log(draws[:, : near_edges + 1]))
        values[mass == -np.inf] = -np.inf
        if tops:
            noise = mass - np.log(-np.log(draws[:, near_edges + 1 :]))
            values[np.arange(rows), noise.argmax(axis=1)] = limits
    best = np.argsort(-values, axis=1)[:, : max(search.k for search, *_ in regions) + 1].tolist()
    for r, (search, sample, at, shut, _) in enumerate(regions):
        edges, value = search.found[sample][0], values[r]
        for j in best[r]:
            if value[j] == -np.inf:
                break
            tail = j == near_edges
            closing = () if tail else (int(edges[at + j]), *(shut if j == 0 else ()))
            search.push(float(value[j]), sample, at + j, closing, tail)


def _log_inclusion(logp: float, threshold: float) -> float:
    """log(1 - exp(-exp(logp - threshold))): the chance to be above the threshold."""
    if np.isneginf(threshold):
        return 0.0
    x = logp - threshold
    return x if x < -30 else float(np.log(-np.expm1(-np.exp(min(x, 50.0)))))


def sample_texts(pieces: Pieces, texts: list[str], keys: np.ndarray, k: int, seed: int) -> list[list[tuple]]:
    """For each text up to ``k`` distinct segmentations, in falling order of their perturbed values:
    ``(ids, log_prob, perturbed, log_inclusion)``.
    """
    return [[row[:4] for row in rows] for rows in search_texts(Lattice(pieces), texts, keys, k, seed)]


def search_texts(lattice: Lattice, texts: list[str], keys: np.ndarray, k: int, seed: int) -> list[list[tuple]]:
    """The same over a lattice that other texts have made, which grows by the units of these.

    Each row has at its end whether each piece spells its stretch of the text.
    """
    pieces, number = lattice.pieces, lattice.number
    units: list[np.ndarray] = []
    for text in texts:
        split = pieces.split(text)
        units.append(np.fromiter(map(number.__getitem__, split), np.int64, len(split)))
    lattice.grow()
    if units:
        lattice.uses += np.bincount(np.concatenate(units), minlength=len(lattice.uses))
    seeds = uniform_state(keys, seed)
    searches = [_Search(s, k) for s in seeds]
    todo = []
    roots = (-np.log(-np.log(uniform(seeds)))).tolist()
    for d, (search, value) in enumerate(zip(searches, roots)):
        search.take(1)
        if len(units[d]):
            todo.append((d, value, np.zeros(0, np.int64), None, 0))
        else:
            search.found.append((np.zeros(0, np.int64), np.zeros(0), value))
    owner: list[list[np.ndarray]] = [[] for _ in texts]  # for each found one: the unit of every edge
    origin: dict[int, tuple] = {}  # where the segmentation that is now drawn leaves a found one
    for turn in range(k):
        if not todo:
            break
        nodes, states = [], []
        for d, _, head, start, unit in todo:
            own = lattice.first[units[d][unit:]]
            own = own if start is None else np.append(start, own)
            nodes.append(own)
            states.append(seeds[d : d + 1] + np.arange(len(own), dtype=np.uint64) * _C * _B + _A * np.arange(turn + 1, turn + 2, dtype=np.uint64))
        bounds = np.cumsum([0, *map(len, nodes)])
        count, edges = lattice.walk(np.concatenate(nodes), np.concatenate(states))
        logs = lattice.logp[edges]
        cuts = np.append(0, np.cumsum(count))[bounds]
        split = []
        for (d, value, head, start, unit), a, b, lo, hi in zip(todo, cuts, cuts[1:], bounds, bounds[1:]):
            at, shut, head_of = origin.get(d, (0, (), np.zeros(0, np.int64)))
            first_unit = unit if start is None else unit - 1
            of = np.repeat(np.arange(first_unit, first_unit + hi - lo), count[lo:hi])
            searches[d].found.append((np.concatenate((head, edges[a:b])), np.concatenate((lattice.logp[head], logs[a:b])), value))
            owner[d].append(np.concatenate((head_of, of)))
            split.append((searches[d], len(searches[d].found) - 1, at, shut, value))
        _split_regions(split, lattice)
        todo, done = [], todo
        for d in (x[0] for x in done) if turn + 1 < k else ():
            region = searches[d].next(lattice)
            if region is None:
                continue
            value, sample, at, shut = region
            path, of = searches[d].found[sample][0], owner[d][sample]
            unit = int(of[at])
            node = _start(lattice, path, of, units[d], at)
            # The edge that leaves the found path, by chance among those that are not shut.
            choice = np.array([e for e in range(lattice.begin[node], lattice.begin[node + 1]) if e not in shut], np.int64)
            weight = np.cumsum(np.exp(lattice.logp[choice]))
            pick = np.searchsorted(weight, searches[d].uniforms(1)[0] * weight[-1])
            edge = int(choice[min(int(pick), len(choice) - 1)])
            start = None if lattice.ends[edge] else int(lattice.target[edge])
            todo.append((d, value, np.append(path[:at], edge), start, unit + 1))
            origin[d] = (at, shut, np.append(of[:at], unit))
    out = []
    for text, own, search in zip(texts, units, searches):
        limit = search.threshold()
        whole = int(lattice.length[own].sum()) == (len(text) + 1 if text else 0)
        rows = []
        for path, logp, value in search.found:
            total = float(logp.sum())
            spelt = whole and bool(lattice.spells[path].all())
            rows.append((_ids(pieces, lattice, path), total, value, _log_inclusion(total, limit), spelt))
        out.append(rows)
    return out


def _start(lattice: Lattice, path: np.ndarray, of: np.ndarray, units: np.ndarray, at: int) -> int:
    """The place in the lattice where edge ``at`` of a path begins."""
    if at and of[at - 1] == of[at]:
        return int(lattice.target[path[at - 1]])
    return int(lattice.first[units[of[at]]])


def _ids(pieces: Pieces, lattice: Lattice, path: np.ndarray) -> np.ndarray:
    ids = lattice.piece[path]
    if not len(ids) or ids.min() >= 0:
        return ids
    bare = np.flatnonzero(ids < 0)
    parts, last = [], 0
    for i in bare.tolist():
        parts += [ids[last:i], pieces.ids_of_char(int(-1 - ids[i]))]
        last = i + 1
    return np.concatenate([*parts, ids[last:]]).astype(np.int32)


def uniform_state(keys: np.ndarray, seed: int) -> np.ndarray:
    return (keys + np.uint64(seed * int(_A) % (1 << 64))) * _B ^ (keys >> _SHIFT(29))
