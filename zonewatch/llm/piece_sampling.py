"""Distinct sampled segmentations into pieces: Gumbel top-k without replacement on the lattice.

The pieces and their scores come from a SentencePiece model. A segmentation's weight is the product of its
pieces' weights, ``(1 + rank) ** -alpha`` with the piece's rank among the scores (a byte-pair model's scores are
ranks); a character that is no piece is spelt in byte pieces. The forward sums of the lattice normalise the
weights, and the search runs back from the text's end: a node is a suffix that has been decided, its
value the largest perturbed log-probability among all segmentations that end so. Of a node's children one, drawn by
probability, inherits the node's value and the others get Gumbel values cut off at it, so the best-first
search emits segmentations in the order of their perturbed log-probabilities, each once: the first k
draws without replacement. The (k+1)-th value gives each draw's inclusion probability. Children
behind a suffix with a log-probability under ``FAR`` are left out: all of them together have less weight
than the rounding of the random numbers.

No piece crosses the bound between a character and a following blank, so the lattice is a chain of the lattices of
blank-led units: equal units of a block share one lattice, and a search goes down all units of all texts of
the block at once, in numpy. Random numbers are hashes of the row's key, the draw, the unit's number and
the edge; neither blocks nor partitions change them.

Decoding joins the pieces and turns the blank marks back; every draw is decoded and compared with its text.

Defined cases: a null or empty text has one segmentation, without pieces; a text with fewer than k segmentations
has all of them, with inclusion probability 1; the mark U+2581 in a text is read as a blank; repeated rows draw
alike, null keys draw as key 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewatch.llm import arrays

DRAWS, ALPHA, SEED = 3, 1.0, 1
MARK = np.frombuffer("▁".encode(), np.uint8)
BLANK = 0x20
FAR = -40.0


class Pieces:
    """The vocabulary as a trie over bytes, with the pieces' log-weights and bytes."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.texts = [b""] * size
        usable, byte_ids = [], {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.texts[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                usable.append(i)
                self.texts[i] = piece.encode()
        if len(byte_ids) < 256 or any("▁" in model.id_to_piece(i).lstrip("▁") for i in usable):
            raise ValueError("the model needs byte pieces, and blanks only at the start of pieces")
        order = sorted(usable, key=lambda i: -model.get_score(i))
        rank = np.full(size, len(order), np.int64)  # byte pieces rank last
        rank[order] = np.arange(len(order))
        self.weight = -alpha * np.log1p(rank.astype(np.float64))
        self.byte_id = np.array([byte_ids[b] for b in range(256)])
        #: Weights with a factor per byte that keeps the sums of a unit near 1.
        self.gain = np.exp(self.weight + PER_BYTE * np.array([len(t) for t in self.texts]))
        # a trie: the node after another node and a byte (0: none; the root is node 1), and the piece of a node; nodes that
        # nothing follows come last and have no row in the table, which stays with the worker
        piece = {self.texts[i]: i for i in usable}
        inner = {b""} | {text[:n] for text in piece for n in range(1, len(text))}
        names = [*sorted(inner), *sorted(piece.keys() - inner)]
        nodes = {text: k for k, text in enumerate(names, 1)}
        self.inner = len(inner)
        self.next = np.zeros((self.inner + 1) * 256, np.int32)
        self.next[[nodes[text[:-1]] * 256 + text[-1] for text in names if text]] = [k for text, k in nodes.items() if text]
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        self.piece[[nodes[text] for text in piece]] = list(piece.values())
        self.flat = np.frombuffer(b"".join(self.texts), np.uint8)
        self.length = np.array([len(t) for t in self.texts])
        self.start = np.cumsum(self.length) - self.length


def marked(texts: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The texts as the model reads them: a mark for each blank and one before each text that is not empty."""
    data, bounds = texts.data, texts.bounds
    blank = np.flatnonzero(data == BLANK)
    some = np.diff(bounds) > 0
    starts = bounds[:-1][some]
    grown = np.ones(len(data), np.int64)
    grown[blank] = 3
    grown[starts] += 3
    ends = np.cumsum(grown)
    out = np.repeat(data, grown)
    for at in (ends[blank] - 3, ends[starts] - grown[starts]):
        for k in range(3):
            out[at + k] = MARK[k]
    return out, np.concatenate([[0], ends])[bounds]


def units(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where units begin: at each text, and at a mark that follows something else."""
    mark = np.zeros(len(data), bool)
    if len(data) >= 3:
        mark[:-2] = (data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])
    begin = mark.copy()
    begin[3:] &= ~mark[:-3]
    begin[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(begin)


#: Bytes of the character that a byte begins, 0 if it begins none.
WIDTH = np.repeat(np.array([1, 0, 2, 3, 4], np.int8), [0x80, 0x40, 0x20, 0x10, 0x10])
#: Units up to this many bytes are summed without logarithms: at ``PER_BYTE`` a byte no sum leaves a double's range.
SHORT, PER_BYTE = 150, 2.0


class Lattice:
    """The lattices of distinct units, laid out by position: all units' nodes at position 0, then all at position 1,
    and so on, the longest unit first, so that position p of the unit in place u is node ``base[p] + u``. The edges
    that end in a node are ``ptr[node]:ptr[node + 1]``, longer pieces first, as those are mostly the likely
    ones. ``first`` and ``last`` are a unit's end nodes, by the order in which the units were given."""

    def __init__(self, pieces: Pieces, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        order = np.argsort(start - end, kind="stable")
        start, size = start[order].astype(np.int32), (end - start)[order].astype(np.int32)
        self.longest = int(size[0]) if len(size) else 0
        # how many units reach each position; the end of a unit is a position of its own
        self.reach = np.searchsorted(-size, -np.arange(self.longest + 1), side="right")
        self.base = np.concatenate([[0], np.cumsum(self.reach)]).astype(np.int32)
        self.total = int(self.base[-1])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.first = place.astype(np.int32)
        self.position = position = np.repeat(np.arange(self.longest + 1, dtype=np.int32), self.reach)
        unit = np.arange(self.total, dtype=np.int32) - self.base[position]
        inside = position < size[unit]
        text = np.full(self.total, 0x80, np.uint8)  # the end of a unit begins no character
        text[inside] = data[(start[unit] + position)[inside]]
        self.last = np.empty(len(order), np.int32)
        self.last[order] = self.base[size] + np.arange(len(order), dtype=np.int32)
        self._edges(pieces, text, position, unit, size)
        self._probabilities(pieces, size)

    def _edges(self, pieces: Pieces, text: np.ndarray, position: np.ndarray, unit: np.ndarray, size: np.ndarray) -> None:
        width = WIDTH[text]
        lone = width > 0  # pieces begin at characters
        alive = np.flatnonzero(lone).astype(np.int32)
        at, row = position[alive], unit[alive]
        room, now, state, n, parts = size[row], alive, np.ones(len(alive), np.int32), 0, []
        while len(alive):
            state = pieces.next.take(state * 256 + text.take(now))
            n += 1
            hit = np.flatnonzero(state)
            alive, state, at, row, room = alive.take(hit), state.take(hit), at.take(hit) + np.int32(1), row.take(hit), room.take(hit)
            now = self.base.take(at) + row
            found = pieces.piece.take(state)
            full = np.flatnonzero(found >= 0)
            parts.append((alive.take(full), now.take(full), found.take(full)))
            if n <= 4:
                whole = alive[full]
                lone[whole[width[whole] == n]] = False
            more = np.flatnonzero((at < room) & (state <= pieces.inner))
            alive, state, at, row, room, now = (x.take(more) for x in (alive, state, at, row, room, now))
        # characters that are no piece: a path of byte pieces
        spelt = np.flatnonzero(lone).astype(np.int32)
        for k in range(4):
            some = spelt[width[spelt] > k]
            one, to = (self.base[position[some] + j] + unit[some] for j in (k, k + 1))
            parts.append((one, to, pieces.byte_id[text[one]].astype(np.int32)))
        count = np.zeros(self.total + 1, np.int32)
        for _, to, _ in parts:  # within one part every end is there once
            count[to + 1] += 1
        self.ptr = np.cumsum(count, dtype=np.int32)
        self.source, self.to, self.id = (np.empty(int(self.ptr[-1]), np.int32) for _ in range(3))
        slot = self.ptr[:-1].copy()
        for one, to, ids in reversed(parts):
            spot = slot[to]
            self.source[spot], self.to[spot], self.id[spot] = one, to, ids
            slot[to] += 1

    def _probabilities(self, pieces: Pieces, size: np.ndarray) -> None:
        """Forward sums, a position at a time, and each edge's share of its node's sum."""
        logs = self.longest > SHORT  # then all of this block's sums are kept as logarithms
        gain = pieces.weight[self.id] if logs else pieces.gain[self.id]
        total = np.full(self.total, -np.inf if logs else 0.0)
        share = np.zeros(0 if logs else len(self.to))
        total[: self.reach[0] if len(size) else 0] = 0.0 if logs else 1.0
        with np.errstate(divide="ignore", invalid="ignore"):
            for d in range(1, self.longest + 1):
                nodes = slice(int(self.base[d]), int(self.base[d + 1]))
                edges = slice(int(self.ptr[nodes.start]), int(self.ptr[nodes.stop]))
                head = self.ptr[nodes] - np.int32(edges.start)
                n = np.diff(np.append(head, np.int32(edges.stop - edges.start)))
                some = np.flatnonzero(n)
                if not len(some):
                    continue
                head = head[some]
                value = total[self.source[edges]]
                if logs:
                    value += gain[edges]
                    top = np.maximum.reduceat(value, head)
                    safe = np.where(np.isfinite(top), top, 0.0)
                    total[nodes.start + some] = safe + np.log(np.add.reduceat(np.exp(value - np.repeat(safe, n[some])), head))
                else:
                    value *= gain[edges]
                    total[nodes.start + some] = np.add.reduceat(value, head)
                    share[edges] = value
            #: Probability of an edge, given the node where it ends; sums of these in a node.
            if logs:
                share = np.exp(total[self.source] + gain - total[self.to])
            else:
                share /= total[self.to]
            self.share = np.nan_to_num(share, copy=False)
        sums = np.cumsum(self.share)
        # as integers with a last bit that is set: they are below a random number if its first 63 bits are more than theirs
        upto = np.minimum((sums - (sums - self.share)[self.ptr[self.to]]) * 2.0**63, 2.0**63 - 1024).astype(np.int64)
        upto[self.ptr[1:][np.diff(self.ptr) > 0] - 1] = np.iinfo(np.int64).max  # a node's last edge takes what is left
        self.upto = (upto.view(np.uint64) << np.uint64(1)) | np.uint64(1)

    def logp(self, edges: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(self.share[edges])


def uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def gumbel(bits: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(uniform(arrays.mixed(bits))))


#: Bytes of text whose units share a lattice: few enough for its arrays to stay in the cache.
BLOCK_BYTES = 1 << 19
#: Walks that go down together: their arrays stay in the cache.
TOGETHER = 1 << 15


def descend(lattice: Lattice, start: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each walk's ``start`` to its unit's first node, an edge at a time by probability, many walks at once:
    the edges in text order, and each walk's first place among them."""
    goal = lattice.reach[0] if lattice.total else 0
    chosen, count = [], np.zeros(len(start), np.int64)
    for begin in range(0, len(start), TOGETHER):
        part = slice(begin, begin + TOGETHER)
        walk = begin + np.flatnonzero(start[part] >= goal)
        at, bits, step = start[walk], seed[walk], 0
        while len(walk):
            u = arrays.mixed(bits + np.uint64(step * arrays.BYTE_BASE % 2**64))
            edge = lattice.ptr.take(at).astype(np.intp)
            later = np.flatnonzero(lattice.upto.take(edge) < u)
            while len(later):
                edge[later] += 1
                later = later[lattice.upto.take(edge.take(later)) < u.take(later)]
            chosen.append((walk, edge, step))
            count[walk] += 1
            at, step = lattice.source.take(edge), step + 1
            go = np.flatnonzero(at >= goal)
            walk, at, bits = walk.take(go), at.take(go), bits.take(go)
    first = np.concatenate([[0], np.cumsum(count)])
    path = np.empty(first[-1], np.int64)
    for walk, edge, step in chosen:
        path[first[walk + 1] - 1 - step] = edge
    return path, first


class Draws:
    """The draws of a block: per row up to ``k`` of them, as edges in text order."""

    def __init__(self, pieces: Pieces, texts: arrays.Texts, keys: np.ndarray, k: int, seed: int):
        self.data, self.bounds = marked(texts)
        begin = units(self.data, self.bounds)
        end = np.append(begin[1:], len(self.data))
        h = arrays.range_hashes(arrays.prefix_sums(self.data, arrays.BYTE_BASE), begin, end, arrays.BYTE_BASE)
        _, once, unit = np.unique(h, return_index=True, return_inverse=True)
        self.lattice = lat = Lattice(pieces, self.data, begin[once], end[once])
        rows = len(texts)
        self.unit_bounds = ub = np.searchsorted(begin, self.bounds)
        row = np.repeat(np.arange(rows), np.diff(ub))
        row_seed = arrays.mixed(keys.astype(np.uint64) + np.uint64(seed * arrays.WORD_BASE % 2**64))
        number = (np.arange(len(unit)) - ub[row]).astype(np.uint64)
        #: Per row a list of draws: (edges, log-probability, perturbed log-probability).
        self.found: list[list[tuple[np.ndarray, float, float]]] = [[] for _ in range(rows)]
        agendas: list[list[tuple]] = [[] for _ in range(rows)]
        # the first walk: all units of all rows; later ones: what lies before the edge that was taken up
        walks, nodes = np.arange(len(unit)), lat.last[unit]
        tails = [(np.zeros(0, np.int64), 0.0)] * rows
        tops = gumbel(row_seed)
        active = np.arange(rows)
        for draw in range(k):
            walk_seed = arrays.mixed(row_seed[row[walks]] + number[walks] * np.uint64(arrays.WORD_BASE) + np.uint64((draw + 1) * arrays.BYTE_BASE % 2**64))
            path, first = descend(lat, nodes, walk_seed)
            logp = lat.logp(path)
            cuts = first[np.searchsorted(walks, ub)]  # each row's places
            sums = np.concatenate([[0.0], np.cumsum(logp)])
            tail_logp = np.zeros(rows)
            tail_logp[active] = [tails[r][1] for r in active]
            # log-probability of the suffix behind each place: sums only fall, so a row's places above FAR are its last
            whole = sums[cuts[1:]] + tail_logp
            low = np.maximum(cuts[:-1], np.searchsorted(-sums[1:], FAR - whole, side="right"))
            n = np.maximum(cuts[1:] - low, 0)
            owner = np.repeat(np.arange(rows), n)
            near = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            behind = whole[owner] - sums[near + 1]
            # the children there that were not chosen; what they share is found once a place
            node = lat.to[path[near]]
            size = lat.ptr[node + 1] - lat.ptr[node]
            some = np.flatnonzero(size > 1)
            near, node, size, owner, behind = near[some], node[some], size[some], owner[some], behind[some]
            walk = np.searchsorted(first, near, side="right") - 1
            there = np.repeat(np.arange(len(near)), size)
            edge = np.arange(len(there)) + (lat.ptr[node] - (np.cumsum(size) - size)).take(there)
            share = lat.share.take(edge)
            rest = np.flatnonzero((edge != path[near].take(there)) & (share > 0))
            there, edge = there.take(rest), edge.take(rest)
            owner, phi = owner.take(there), behind.take(there) + np.log(share.take(rest))
            # told apart in the hash by the unit's position and the number among the edges there
            spot = lat.position[node].astype(np.int64) * 64 + 64 - lat.ptr[node]
            bits = walk_seed[walk].take(there) ^ ((spot.take(there) + edge).astype(np.uint64) * np.uint64(arrays.WORD_BASE) + np.uint64(arrays.WORD_BASE))
            # less a child's own Gumbel value; among a row's children the values cut off at the row's have the same order
            less = np.log(-np.log(uniform(arrays.mixed(bits)))) - phi
            best = best_of(owner, -less, k - draw, rows)
            given = -np.logaddexp(-tops[owner[best]], less[best])
            for i, value in zip(best.tolist(), given.tolist(), strict=True):
                r = int(owner[i])
                agendas[r].append((value, float(phi[i]), draw, int(near[there[i]] - cuts[r]), int(edge[i]), int(walks[walk[there[i]]])))
            for r in active:
                edges, rest = tails[r]
                part = path[cuts[r] : cuts[r + 1]]
                self.found[r].append((np.concatenate([part, edges]), float(sums[cuts[r + 1]] - sums[cuts[r]] + rest), float(tops[r])))
            if draw + 1 == k:
                break
            active, starts, tails = [], [], list(tails)
            for r in range(rows):
                if not agendas[r]:
                    continue
                best = max(range(len(agendas[r])), key=lambda i: agendas[r][i][0])
                top_value, phi, parent, at, e, u = agendas[r].pop(best)
                active.append(r)
                tops[r] = top_value
                tails[r] = (np.concatenate([[e], self.found[r][parent][0][at + 1 :]]).astype(np.int64), phi)
                starts.append((int(ub[r]), u, int(lat.source[e])))
            active = np.array(active, np.int64)
            if not len(active):
                break
            low, high = np.array([s[0] for s in starts]), np.array([s[1] for s in starts])
            size = high - low + 1
            walks = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            nodes = lat.last[unit[walks]]
            nodes[np.cumsum(size) - 1] = [s[2] for s in starts]
        #: The value of the best segmentation that was not drawn, by row; -inf if there is none.
        self.beyond = [max((a[0] for a in agenda), default=-np.inf) for agenda in agendas]

    def inclusion(self, row: int) -> list[float]:
        """Of each draw of a row, the logarithm of the probability that it is among the first k."""
        kappa = self.beyond[row]
        above = [logp - kappa for _, logp, _ in self.found[row]]
        return [0.0 if x == np.inf else float(x if x < -30 else np.log(-np.expm1(-np.exp(min(x, 9.0))))) for x in above]


def best_of(owner: np.ndarray, value: np.ndarray, k: int, rows: int) -> np.ndarray:
    """The places of each owner's ``k`` largest values."""
    here, out = np.arange(len(owner)), []
    for _ in range(k):
        most = np.full(rows, -np.inf)
        np.maximum.at(most, owner[here], value[here])
        hit = value[here] == most[owner[here]]
        out.append(here[hit])
        here = here[~hit]
    return np.concatenate(out)


def decoded(pieces: Pieces, ids: np.ndarray) -> np.ndarray:
    """The bytes that pieces stand for, with marks."""
    size = pieces.length[ids]
    head = np.cumsum(size) - size
    at = np.repeat((pieces.start[ids] - head).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return pieces.flat[at]


def decode(pieces: Pieces, ids: np.ndarray) -> str:
    """The text of one row's ids."""
    text = decoded(pieces, np.asarray(ids, np.int64)).tobytes().decode(errors="replace").replace("▁", " ")
    return text[1:] if text.startswith(" ") else text


LOADED: dict[tuple, Pieces] = {}


def loaded(path: str, alpha: float) -> Pieces:
    """A worker keeps the vocabulary over tasks."""
    if (path, alpha) not in LOADED:
        LOADED[path, alpha] = Pieces(path, alpha)
        arrays.released()
    return LOADED[path, alpha]


FIELDS = "n_samples int, n_pieces array<int>, ids array<array<int>>, ids_crc32 array<long>, logp array<double>, perturbed array<double>, log_inclusion array<double>, round_trip boolean"


def sample(docs: DataFrame, model: Callable[[], str], doc_id: str = "doc_id", text: str = "text", draws: int = DRAWS, alpha: float = ALPHA, seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """Per row: doc_id, n_samples, and per draw (most probable perturbed value first) the number of pieces, the ids (null
    unless ``with_ids``), their crc32, log-probability, perturbed log-probability and the logarithm of
    the inclusion probability; round_trip: whether every draw decodes to the text. ``model`` gives the model's path."""

    def run(batch, texts):
        pieces = loaded(model(), alpha)
        keys = np.array([i or 0 for i in batch["doc_id"].to_pylist()], np.int64)
        drawn = Draws(pieces, texts, keys, draws, seed)
        rows = drawn.found
        flat = [pieces_of(drawn, f[0]) for r in rows for f in r]
        sizes = np.array([len(f) for f in flat], np.int64)
        every = np.concatenate(flat or [np.zeros(0, np.int64)])
        n = np.array([len(r) for r in rows], np.int32)
        text_bytes = decoded(pieces, every)
        ends = np.concatenate([[0], np.cumsum(pieces.length[every])])[np.concatenate([[0], np.cumsum(sizes)])]
        own = np.repeat(np.arange(len(rows)), n)
        same = [np.array_equal(text_bytes[a:b], drawn.data[drawn.bounds[r] : drawn.bounds[r + 1]]) for a, b, r in zip(ends[:-1], ends[1:], own, strict=True)]
        raw = memoryview(every.astype("<u4")).cast("B")
        at = np.concatenate([[0], np.cumsum(sizes)])
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        outer = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        lists = lambda values, kind: pa.ListArray.from_arrays(outer, pa.array(values, kind))
        inner = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(every.astype(np.int32)))
        return arrays.batch(
            doc_id=batch["doc_id"],
            n_samples=n,
            n_pieces=lists(sizes, pa.int32()),
            ids=pa.ListArray.from_arrays(outer, inner) if with_ids else pa.nulls(len(rows), pa.list_(pa.list_(pa.int32()))),
            ids_crc32=lists(crc, pa.int64()),
            logp=lists([f[1] for r in rows for f in r], pa.float64()),
            perturbed=lists([f[2] for r in rows for f in r], pa.float64()),
            log_inclusion=lists([p for r in range(len(rows)) for p in drawn.inclusion(r)], pa.float64()),
            round_trip=np.bincount(own, weights=np.array(same, float), minlength=len(rows)) == n,
        )

    return arrays.map_texts(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), run, f"doc_id long, {FIELDS}", size=BLOCK_BYTES)


def pieces_of(drawn: Draws, edges: np.ndarray) -> np.ndarray:
    return drawn.lattice.id[edges]
