"""SentencePiece encoding by sampled segmentations without replacement, and decoding.

A text's lattice has an edge for every vocabulary piece that matches at a character. With piece
log-probabilities, each path from start to end is a segmentation. `sample` returns the k distinct
segmentations of highest Gumbel-perturbed log-probability, which is a sample without replacement:

* Piece probabilities follow the vocabulary's merge order by Zipf's law, p ~ 1 / (rank + SHIFT); bytes share
  the last rank. The file has ranks only, and nothing is trained here.
* Pieces cross neither the start of a run of spaces nor a line break, so the lattice is a chain of blocks. The
  lattices and backward sums of a chunk's new distinct blocks are made together: substrings are looked
  up by hash, length by length, and sums go from the blocks' ends to their starts. A task keeps them for later chunks.
* A* over prefixes: a node's value is the best perturbed value below it, and the children of a node get
  theirs by drawing Gumbels conditioned on their maximum being the parent's value. In exponential form
  (value = -log t) a child's time is t + (e - min e) * exp(-phi), with e = Exponential / p. The best
  child inherits the parent's time, so following it leads to a finished path; what it leaves
  aside joins the agenda. The next pop continues from the best open node.
* All blocks of many texts step together in numpy. The random numbers are hashes of (row key, expansion,
  character, edge): a row's samples don't depend on its partition or on a rerun.
* Inclusion scores are 1 - exp(-exp(phi - kappa)), with kappa the (k+1)-th best value.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwatch.llm.common import Places, mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SHIFT = 2.7
#: Characters that one numpy step works on; bounds the memory of a task.
CHUNK = 250_000
#: Characters of distinct blocks whose lattices a task keeps for the next chunk.
REMEMBERED = 400_000


@dataclass(frozen=True)
class Vocabulary:
    """Beginnings of pieces by length, log-probability by id, the ids of the 256 bytes, text by id.

    Beginnings are sorted hashes, each with the piece's id (-1: only a beginning) and whether a longer piece has it.
    """

    by_length: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...]
    logp: np.ndarray
    byte_ids: tuple[int, ...]
    texts: tuple[bytes, ...]
    lines: bool  # no piece has a line break beside other characters

    @cached_property
    def spelled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all texts one after another, and each text's first byte and number of bytes."""
        width = np.array([len(x) for x in self.texts])
        return np.frombuffer(b"".join(self.texts), np.uint8), np.cumsum(width) - width, width


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _longer(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Hash of a string from that of all but its last character."""
    return mixed(h * np.uint64(0x9E3779B97F4A7C15) + code + np.uint64(1))


def _width(codes: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each character."""
    return 1 + (codes >= 0x80).astype(int) + (codes >= 0x800) + (codes >= 0x10000)


def _spans(firsts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of spans (first, count) one after another, and where each span begins among them."""
    starts = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(firsts - starts, counts), starts


def _put(old: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """`old` with `more` after its `used` entries; made longer, with some room to spare, where it is too short."""
    if used + len(more) > len(old):
        grown = np.empty((used + len(more)) * 5 // 4, more.dtype)
        grown[:used] = old[:used]
        old = grown
    old[used : used + len(more)] = more
    return old


def vocabulary(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    byte_ids = {int(sp.id_to_piece(i)[1:-1], 16): i for i in ids if sp.is_byte(i)}
    pieces = {sp.id_to_piece(i).replace("▁", " "): i for i in ids if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    first = min(pieces.values())
    rank = np.array([i - first if i >= first else len(ids) - first for i in ids], float)
    p = 1 / (rank + SHIFT)
    texts: list[bytes] = [b""] * len(ids)
    for piece, i in pieces.items():
        texts[i] = piece.encode()
    for b, i in byte_ids.items():
        texts[i] = bytes([b])
    crossing = [x for x in pieces if " " in x.lstrip(" ")]
    if crossing:
        raise ValueError(f"pieces with a space after other characters are not supported: {crossing[:3]}")
    lines = not any("\n" in x and len(x) > 1 for x in pieces)
    by_length = []
    for n in range(1, max(map(len, pieces)) + 1):
        longer = {x[:n] for x in pieces if len(x) > n}
        of = sorted(longer | {x for x in pieces if len(x) == n})
        codes = np.array([_codes(x) for x in of], np.uint64).reshape(-1, n)
        h = np.zeros(len(of), np.uint64)
        for i in range(n):
            h = _longer(h, codes[:, i])
        order = np.argsort(h)
        by_length.append((h[order], np.array([pieces.get(of[i], -1) for i in order], np.int32), np.array([of[i] in longer for i in order], bool)))
    return Vocabulary(tuple(by_length), np.log(p / p.sum()), tuple(byte_ids[b] for b in range(256)), tuple(texts), lines)


def decode(ids: list[int], voc: Vocabulary) -> str:
    """The text of a sequence of ids, without the space that encoding puts in front."""
    return b"".join(map(voc.texts.__getitem__, ids))[1:].decode("utf-8", "surrogatepass")


class Lattices:
    """The lattices of distinct blocks as flat arrays: nodes are characters, edges pieces.

    An edge's `ids` entry is the piece, or -1 - code for a character that is coded in bytes; `logp`
    is the log-probability of the edge among its node's, by the weights of all paths to the block's end.
    Blocks are told apart by hash, and kept from one chunk of texts to the next. When they hold more than REMEMBERED characters,
    those that the most chunks had stay, up to half as many. A lattice is the same whichever blocks it is made with.
    """

    def __init__(self, voc: Vocabulary):
        self.voc = voc
        self.places = [Places(hashes) for hashes, _, _ in voc.by_length]
        self.clear()

    def clear(self) -> None:
        self.hashes = np.empty(0, np.uint64)  # sorted; `number` has the number of the block of each
        self.number = self.uses = self.size = self.first_node = np.empty(0, np.int64)
        self.counts = np.empty(0, np.uint8)  # a node has an edge for each length of pieces at most
        self.first_edge = self.ids = self.targets = np.empty(0, np.int32)
        self.logp = np.empty(0)
        self.nodes = self.edges = 0  # used entries of the arrays by node and by edge

    def _forget(self) -> None:
        """Keep the blocks that the most chunks had, up to half of REMEMBERED characters."""
        most = np.argsort(-self.uses, kind="stable")
        keep = np.sort(most[np.cumsum(self.size[most]) <= REMEMBERED // 2])
        if not len(keep):
            self.clear()
            return
        renumbered = np.full(len(self.size), -1)
        renumbered[keep] = np.arange(len(keep))
        number = renumbered[self.number]
        self.hashes, self.number = self.hashes[number >= 0], number[number >= 0]
        nodes, self.first_node = _spans(self.first_node[keep], self.size[keep])
        self.uses, self.size = self.uses[keep] // 2, self.size[keep]
        edges, first_edge = _spans(self.first_edge[nodes], self.counts[nodes].astype(np.int64))
        self.counts, self.first_edge = self.counts[nodes], first_edge.astype(np.int32)
        self.ids, self.targets, self.logp = self.ids[edges], self.targets[edges], self.logp[edges]
        self.nodes, self.edges = len(nodes), len(edges)

    def blocks(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of each text's blocks, whose lattices are there from now on."""
        if self.nodes > REMEMBERED:
            self._forget()
        codes = _codes("".join([" " + t for t in texts]))
        ends = np.cumsum([len(t) + 1 for t in texts])
        space, line = codes == ord(" "), (codes == ord("\n")) & self.voc.lines
        begins = space | line
        begins[1:] &= ~(space[1:] & space[:-1])
        begins[1:] |= line[:-1]
        begins[ends[:-1]] = True
        first = np.flatnonzero(begins)
        size = np.diff(first, append=len(codes))
        place = np.arange(1, len(codes) + 1) - np.repeat(first, size)
        h = np.add.reduceat(mixed(codes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), first) if len(first) else codes
        h, one, block = np.unique(h + size.astype(np.uint64), return_index=True, return_inverse=True)
        spot = np.searchsorted(self.hashes, h)
        known = np.zeros(len(h), bool)
        if len(self.hashes):
            known = self.hashes[np.minimum(spot, len(self.hashes) - 1)] == h
        number = np.empty(len(h), np.int64)
        number[known] = self.number[spot[known]]
        new = one[~known]
        if len(new):
            number[~known] = np.arange(len(self.size), len(self.size) + len(new))
            self.hashes, self.number = np.insert(self.hashes, spot[~known], h[~known]), np.insert(self.number, spot[~known], number[~known])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
            self._add(size[new], codes[_spans(first[new], size[new])[0]])
        self.uses[number] += 1
        return np.split(number[block], np.searchsorted(first, ends[:-1])) if texts else []

    def _add(self, size: np.ndarray, codes: np.ndarray) -> None:
        """Make the lattices of new blocks, numbered after those that are there, from their sizes and characters."""
        voc = self.voc
        first_node = np.cumsum(size) - size
        n = len(codes)
        left = np.repeat(first_node + size, size) - np.arange(n)  # characters to the block's end
        at, h, found = np.arange(n), np.zeros(n, np.uint64), []
        for i, (hashes, pieces, more) in enumerate(voc.by_length):
            h = _longer(h, codes[at + i])
            spot = self.places[i].of(h)
            same = hashes[spot] == h
            piece = pieces[spot]
            whole = np.flatnonzero(same & (piece >= 0))
            found.append((at[whole], piece[whole]))
            if not i:
                bare = np.ones(n, bool)
                bare[found[0][0]] = False
                bare = np.flatnonzero(bare)
                found.append((bare, -1 - codes[bare].astype(np.int32)))
            # Only what began a longer piece so far, and does not end its block, goes on.
            goes = np.flatnonzero(same & more[spot] & (left[at] > i + 1))
            at, h = at[goes], h[goes]
        lengths = [0, *range(len(voc.by_length))]
        counts = np.zeros(n, np.int64)
        for nodes, _ in found:
            counts[nodes] += 1
        first_edge = np.cumsum(counts) - counts
        ids, length, node = np.empty(int(counts.sum()), np.int32), np.empty(int(counts.sum()), np.int64), np.repeat(np.arange(n), counts)
        free = first_edge.copy()  # where the node's next edge goes, by length
        for i, (nodes, piece) in zip(lengths, found):
            spot = free[nodes]
            ids[spot], length[spot] = piece, i
            free[nodes] += 1
        weight = voc.logp[np.maximum(ids, 0)]
        byted = np.flatnonzero(ids < 0)
        weight[byted] = _width(codes[node[byted]]) * voc.logp[voc.byte_ids[0]]
        back = np.zeros(n + 1)
        to = np.where(left[node] == length + 1, n, node + length + 1)  # the last entry of `back` is the end of any block
        by_left = np.argsort(left.astype(np.min_scalar_type(int(size.max(initial=0)))), kind="stable")  # small types sort faster
        cuts = np.cumsum(np.bincount(left, minlength=1)) if n else np.zeros(1, int)
        # The edges in the order in which their nodes' sums are made.
        edges, starts = _spans(first_edge[by_left], counts[by_left])
        of_edge, ends, sizes = weight[edges], to[edges], counts[by_left]
        starts = np.append(starts, len(edges))
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            a, b = starts[lo], starts[hi]
            x = of_edge[a:b] + back[ends[a:b]]
            top = np.maximum.reduceat(x, starts[lo:hi] - a)
            back[by_left[lo:hi]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, sizes[lo:hi])), starts[lo:hi] - a))
        logp = weight + back[to] - back[node]
        targets = (node + length + 1 - np.repeat(first_node, size)[node]).astype(np.int32)
        self.size, self.first_node = np.concatenate([self.size, size]), np.concatenate([self.first_node, first_node + self.nodes])
        self.counts = _put(self.counts, self.nodes, counts.astype(np.uint8))
        self.first_edge = _put(self.first_edge, self.nodes, (first_edge + self.edges).astype(np.int32))
        self.ids, self.targets = _put(self.ids, self.edges, ids), _put(self.targets, self.edges, targets)
        self.logp = _put(self.logp, self.edges, logp)
        self.nodes, self.edges = self.nodes + n, self.edges + len(ids)

    def walk(self, kind: np.ndarray, at: np.ndarray, key: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, ...]:
        """Follow the best child from position `at` of each block to its end.

        Returns the visited nodes in order of (block, step): their block and chosen edge; and the
        edges left aside: their node (index into the former), edge and e - min e.
        """
        nodes, aside, steps = [], [], np.zeros(len(kind), np.int64)
        golden = np.uint64(0x9E3779B97F4A7C15)
        live = np.flatnonzero(at < self.size[kind])
        base = self.first_node[kind[live]]
        node, stop = base + at[live], base + self.size[kind[live]]
        seed = key[live] + (offset[live] - base).astype(np.uint64) * golden
        while len(live):
            counts, edge = self.counts[node].astype(np.int64), self.first_edge[node].astype(np.int64)
            many = np.flatnonzero(counts > 1)  # the others have nothing to draw
            if len(many):
                n, first = counts[many], edge[many]
                starts = np.cumsum(n) - n
                owner = np.repeat(np.arange(len(many)), n)
                every = np.arange(len(owner))  # less its node's start, an edge's place among its node's
                each = (first - starts)[owner] + every
                spot = mixed(seed[many] + node[many].astype(np.uint64) * golden) - starts.astype(np.uint64)
                h = mixed(spot[owner] + every.view(np.uint64))
                d = (h >> np.uint64(11)).view(np.int64) + 0.5
                d *= 2.0**-53
                np.negative(np.log(d, out=d), out=d)
                d *= np.exp(-self.logp[each])
                d -= np.minimum.reduceat(d, starts)[owner]
                best = np.flatnonzero(d == 0)
                if len(best) > len(many):  # equal draws: the first
                    best = best[np.unique(owner[best], return_index=True)[1]]
                edge[many] = each[best]
                rest = np.ones(len(each), bool)
                rest[best] = False
                rest = np.flatnonzero(rest)
                aside.append((live[many], len(nodes), n - 1, each[rest], d[rest]))
            nodes.append((live, edge))
            steps[live] += 1
            node = base + self.targets[edge]
            on = np.flatnonzero(node < stop)
            if len(on) < len(live):
                live, base, node, stop, seed = live[on], base[on], node[on], stop[on], seed[on]
        # A block's nodes stand together, in order of their steps.
        begins = np.cumsum(steps) - steps
        chosen = np.empty(int(steps.sum()), np.int64)
        for t, (live, edge) in enumerate(nodes):
            chosen[begins[live] + t] = edge
        block = np.repeat(np.arange(len(kind)), steps)
        if not aside:
            return block, chosen, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        place, left = np.concatenate([begins[live] + t for live, t, *_ in aside]), np.concatenate([a[2] for a in aside])
        return block, chosen, np.repeat(place, left), np.concatenate([a[3] for a in aside]), np.concatenate([a[4] for a in aside])


def _round_trips(ids: list[np.ndarray], texts: list[str], voc: Vocabulary) -> list[bool]:
    """Whether each sequence of ids decodes to its text, as `decode` does it, for all of them at once."""
    if not ids:
        return []
    flat, sizes = np.concatenate(ids), np.array([len(x) for x in ids])
    table, first, width = voc.spelled
    wide = width[flat]
    spans, _ = _spans(first[flat], wide)
    ends = np.cumsum(np.add.reduceat(wide, np.cumsum(sizes) - sizes)).tolist()
    made = table[spans].tobytes()
    return [made[a + 1 : b] == text.encode("utf-8", "surrogatepass") for a, b, text in zip([0, *ends], ends, texts)]


@dataclass
class _Text:
    """One text's search: open nodes (log time, phi, path so far, block, position), finished (ids, phi)."""

    key: int
    open: list[tuple[float, float, tuple[np.ndarray, ...], int, int]]
    done: list[tuple[np.ndarray, float]]


def _least(values: np.ndarray, group: np.ndarray, groups: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of each group's `most` least values (more if some are equal), and where each group begins and the last ends among them."""
    found, rest = [np.empty(0, np.int64)], np.arange(len(values))
    for _ in range(most):
        x, of = values[rest], group[rest]
        least = np.full(groups, np.inf)
        np.minimum.at(least, of, x)
        hit = x == least[of]
        found.append(rest[hit])
        rest = rest[~hit]
    places = np.concatenate(found)
    places = places[np.argsort(group[places], kind="stable")]
    return places, np.searchsorted(group[places], np.arange(groups + 1))


def sample(texts: list[str], keys: list[int], k: int, voc: Vocabulary) -> list[list[tuple[list[int], float, float]]]:
    """For each text up to k (ids, log-probability, inclusion score), best perturbed value first."""
    return [[(ids.tolist(), phi, score) for ids, phi, score in samples] for samples in _sampled(texts, keys, k, Lattices(voc))]


def _sampled(texts: list[str], keys: list[int], k: int, chunk: Lattices) -> list[list[tuple[np.ndarray, float, float]]]:
    """What `sample` returns, with ids as arrays of 32-bit integers."""
    blocks = chunk.blocks(texts)
    sizes = np.array([len(b) for b in blocks], np.int64)
    firsts = np.cumsum(sizes) - sizes
    kinds = np.concatenate(blocks) if blocks else np.empty(0, np.int64)
    offsets = np.cumsum(chunk.size[kinds]) - chunk.size[kinds]
    offsets -= np.repeat(offsets[firsts], sizes)  # of each block in its text; a text has one at least
    runs = []
    for key in keys:
        u = (int(mixed(np.array([key], np.uint64))[0] >> 11) + 0.5) * 2.0**-53
        runs.append(_Text(key, [(math.log(-math.log(u)), 0.0, (), 0, 0)], []))
    for turn in range(k):
        popped = [(i, r.open.pop(0)) for i, r in enumerate(runs) if r.open]
        if not popped:
            break
        texts_of, skipped = np.array([i for i, _ in popped]), np.array([o[3] for _, o in popped])
        lengths = sizes[texts_of] - skipped
        which, begin = _spans(firsts[texts_of] + skipped, lengths)
        ats = np.zeros(len(which), np.int64)
        some = lengths > 0
        ats[begin[some]] = np.array([o[4] for _, o in popped])[some]
        seeds = np.array([(runs[i].key + (turn + 1) * 0xD6E8FEB86659FD93) % 2**64 for i, _ in popped], np.uint64)
        ends = np.cumsum(lengths)
        block, chosen, node, edge, d = chunk.walk(kinds[which], ats, np.repeat(seeds, lengths), offsets[which])
        cuts = np.searchsorted(block, np.concatenate([[0], ends]))
        want = k - turn  # the samples still to come, and the one after them
        logp = chunk.logp[chosen]
        prefix = np.empty(len(chosen))
        for j, (i, (_, phi, path, _, _)) in enumerate(popped):
            lo, hi = cuts[j], cuts[j + 1]
            run = np.cumsum(logp[lo:hi])  # of this text alone, so that neighbours don't change a digit
            runs[i].done.append((np.concatenate([*path, chosen[lo:hi]]), phi + (float(run[-1]) if hi > lo else 0.0)))
            prefix[lo:hi] = phi + run - logp[lo:hi]
        late = np.log(d) - prefix[node]  # behind a text's `time`, in whose order the sums are
        near, cuts_near = _least(late, np.repeat(np.arange(len(popped)), np.diff(cuts))[node], len(popped), want)
        for j, (i, (time, phi, path, b, _)) in enumerate(popped):
            lo, some = cuts[j], near[cuts_near[j] : cuts_near[j + 1]]
            for x, child in zip(some.tolist(), np.logaddexp(time, late[some]).tolist()):
                n, e = int(node[x]), int(edge[x])
                into = b + int(block[n]) - (int(ends[j]) - int(lengths[j]))
                way = (*path, chosen[lo:n], np.array([e], np.int64))
                runs[i].open.append((child, float(prefix[n] + chunk.logp[e]), way, into, int(chunk.targets[e])))
            runs[i].open.sort(key=lambda o: o[0])
            del runs[i].open[want:]
    lengths = [len(path) for r in runs for path, _ in r.done]
    ids = iter(_ids(chunk.ids[np.concatenate([path for r in runs for path, _ in r.done])], lengths, chunk.voc) if lengths else [])
    out = []
    for r in runs:
        kappa = r.open[0][0] if r.open else math.inf
        # phi - kappa, as kappa's value is -log time.
        score = lambda phi: -math.expm1(-math.exp(min(phi + kappa, 700.0)))  # noqa: B023, E731
        out.append([(next(ids), phi, score(phi)) for _, phi in r.done])
    return out


def _ids(found: np.ndarray, lengths: list[int], voc: Vocabulary) -> list[np.ndarray]:
    """The ids of edges, with those of a character's bytes in its place; `lengths` of edges each."""
    bare = np.flatnonzero(found < 0)
    code = -1 - found[bare]
    width = np.ones(len(found), np.int64)
    width[bare] = n = _width(code)
    out, of_byte, ends = np.repeat(found, width), np.array(voc.byte_ids, np.int32), np.cumsum(width)
    first = ends[bare] - n
    out[first] = of_byte[np.choose(n - 1, [code, 0xC0 | code >> 6, 0xE0 | code >> 12, 0xF0 | code >> 18])]
    for j in range(1, 4):
        has = n > j
        out[first[has] + j] = of_byte[0x80 | code[has] >> 6 * (n[has] - 1 - j) & 0x3F]
    return np.split(out, ends[np.cumsum(lengths) - 1][:-1])


_ENCODED = "doc_id long, sample int, ids array<int>, log_prob double, inclusion double, ids_crc32 long, round_trip boolean"


def encode(docs: DataFrame, k: int = SAMPLES, path: str = MODEL, seed: int = 0) -> DataFrame:
    """doc_id, sample (1 to k), ids, log_prob, inclusion, ids_crc32 (of the ids as 32-bit little-endian), round_trip.

    round_trip tells that the ids decode to the text again, character for character. Texts with
    fewer than k segmentations give all they have, with inclusion 1; null and empty texts have one,
    a lone space. Rows are seeded by doc_id, those without by their text, so repeated rows
    give equal samples. An empty table gives an empty result; other columns are ignored.
    """
    voc = vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(voc)
        for batch in batches:
            rows: list[tuple[int | None, str]] = []
            size = 0
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                rows.append((doc.as_py(), text.as_py() or ""))
                size += len(rows[-1][1])
                if size >= CHUNK:
                    yield encoded(rows, lattices)
                    rows, size = [], 0
            if rows:
                yield encoded(rows, lattices)

    def encoded(rows: list[tuple[int | None, str]], lattices: Lattices) -> pa.RecordBatch:
        keys = [xxhash.xxh3_64_intdigest(str(t if d is None else d).encode("utf-8", "surrogatepass"), seed) for d, t in rows]
        found = _sampled([t for _, t in rows], keys, k, lattices)
        each = [(doc, text, n, *one) for (doc, text), samples in zip(rows, found) for n, one in enumerate(samples, 1)]
        whole = _round_trips([ids for _, _, _, ids, _, _ in each], [text for _, text, *_ in each], voc)
        table = [(doc, n, ids, phi, score, zlib.crc32(ids.astype("<i4", copy=False).tobytes()), same) for (doc, _, n, ids, phi, score), same in zip(each, whole)]
        columns = list(zip(*table)) if table else [()] * 7
        types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]
        names = ["doc_id", "sample", "ids", "log_prob", "inclusion", "ids_crc32", "round_trip"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _ENCODED)
