"""SentencePiece encoding and decoding with N-best segmentation over the piece lattice.

A text is normalised as the model asks (a blank in front, blanks as U+2581) and cut into words, and these
where no piece holds both neighbouring characters; no piece crosses such a cut, so the
lattice of the text is the chain of small lattices.  In each, the forward Viterbi scores are the exact
cost to go of a backward A-star search, which pops segmentations best first.  All different lattices of a slice of
texts are searched in step, as arrays: every one pops its next segmentation at the same time.  The N best of a chain
follow from those of its links.  Characters without a piece are spelled in byte pieces.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, text_slices

BLANK = "▁"
#: Fixed value: what a spelled character costs beyond the worst piece.
SPELL_PENALTY = 10.0
#: Longer parts, and those with a character to spell, are searched one by one.
IN_STEP = 64
#: Up to so many different characters in pieces, the pairs of them stand in a table.
DENSE = 8192
SLICE_BYTES = 4_000_000
_CHUNK = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


def chain(parts: list[list[tuple[float, bytes]]], n: int) -> list[tuple[float, bytes]]:
    """The ``n`` best of all choices of one item per part, best first; each part is best first."""
    near = heapq.nsmallest(n - 1, [(p[0][0] - p[1][0], i) for i, p in enumerate(parts) if len(p) > 1])
    return departures(sum([p[0][0] for p in parts]), [p[0][1] for p in parts], {i: parts[i] for _, i in near}, n)


def departures(total: float, ids: list[bytes], near: dict[int, list[tuple[float, bytes]]], n: int) -> list[tuple[float, bytes]]:
    """The ``n`` best choices, from the best ids of every part, their total, and the items of the ``near`` parts.

    A choice that departs from the best item of some part costs at least that part's
    first gap, so only the n - 1 parts with the least gaps can occur among the n best.
    """
    found: list[tuple[float, tuple]] = [(0.0, ())]
    for i, part in near.items():
        options = [(part[0][0] - s, (i, r)) for r, (s, _) in enumerate(part[:n])]
        found = sorted([(a + g, c if at[1] == 0 else (*c, at)) for a, c in found for g, at in options])[:n]
    out = []
    for gap, changes in found:
        mine = ids if not changes else list(ids)
        for i, r in changes:
            mine[i] = near[i][r][1]
        out.append((total - gap, b"".join(mine)))
    return out


class Searched:
    """The N best of many parts: the best scores and ids, what the second ones cost more, and all as lists."""

    def __init__(self, scores: np.ndarray, ids: list[bytes], at: list[np.ndarray], alone: dict[int, list]):
        #: By rank and part: scores, -inf where there are fewer; ids end to end, and where each part's begin.
        self.scores, self.ids, self.at, self.alone = scores, ids, at, alone
        self.score = scores[0].copy()
        self.gap = np.full(len(self.score), np.inf)
        if len(scores) > 1:
            np.subtract(scores[0], scores[1], out=self.gap, where=scores[1] > -np.inf)
        self.best = [ids[0][a:b] for a, b in zip(at[0][:-1].tolist(), at[0][1:].tolist())]
        for p, found in alone.items():
            self.score[p], self.best[p] = found[0]
            self.gap[p] = found[0][0] - found[1][0] if len(found) > 1 else np.inf

    def found(self, p: int) -> list[tuple[float, bytes]]:
        if p in self.alone:
            return self.alone[p]
        return [(float(s[p]), ids[at[p]:at[p + 1]]) for s, ids, at in zip(self.scores, self.ids, self.at) if s[p] > -np.inf]


class Lattice:
    """Pieces of a model, their scores, and the N best of texts and their parts."""

    def __init__(self, path: str, n: int):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.n, size = n, model.get_piece_size()
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(size) if model.is_byte(i)}
        own = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.piece = {model.id_to_piece(i): (float(model.get_score(i)), np.array([i], "<u4").tobytes()) for i in own}
        #: Score and ids of a piece; empty for what only begins one.
        self.known = {p[:k]: () for p in self.piece for k in range(1, len(p))} | self.piece
        self.inside = {p[k:k + 2] for p in self.piece for k in range(len(p) - 1)}
        self.spell = min(s for s, _ in self.piece.values() if s > -1e8) - SPELL_PENALTY
        self.text = [b""] * size
        for b, i in self.bytes.items():
            self.text[i] = bytes([b])
        for i in own:
            self.text[i] = model.id_to_piece(i).replace(BLANK, " ").encode()
        self._tables()

    def _tables(self) -> None:
        """The pieces as a trie in arrays; its states are the beginnings of pieces, 0 stands for none."""
        signs = sorted({c for p in self.known for c in p})
        self.code = np.zeros(0x110000, np.int64)
        self.code[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.signs = len(signs) + 1
        state = {p: i for i, p in enumerate(self.known, 1)}
        number = lambda c: int(self.code[ord(c)])
        self.root = np.zeros(self.signs, np.int64)
        for c in signs:
            self.root[number(c)] = state.get(c, 0)
        steps = sorted((state[p[:-1]] * self.signs + number(p[-1]), i) for p, i in state.items() if len(p) > 1)
        self.step, self.follows = (np.array(x, np.int64) for x in zip(*steps, (1 << 62, 0)))
        self.state_score, self.state_id = np.full(len(state) + 1, np.nan), np.zeros(len(state) + 1, "<u4")
        for p, (score, ids) in self.piece.items():
            self.state_score[state[p]], self.state_id[state[p]] = score, int.from_bytes(ids, "little")
        if self.signs <= DENSE:
            self.together = np.zeros(self.signs ** 2, bool)
            self.together[[number(p[0]) * self.signs + number(p[1]) for p in self.inside]] = True

    def edges(self, part: str) -> tuple[list[list[tuple[int, float, bytes]]], list[float], list]:
        """For each end, (start, score, ids) of the pieces that end there, its Viterbi score and its best edge."""
        size, known = len(part), self.known.get
        ends: list[list] = [[] for _ in range(size + 1)]
        ahead, best = [0.0] + [float("-inf")] * size, [None] * (size + 1)
        for start in range(size):
            so_far = ahead[start]
            for end in range(start + 1, size + 1):
                hit = known(part[start:end])
                if hit is None and end > start + 1:
                    break
                if not hit:
                    if end > start + 1:
                        continue
                    hit = (self.spell, np.array([self.bytes[b] for b in part[start].encode("utf-8", "surrogatepass")],
                                                "<u4").tobytes())
                edge = (start, *hit)
                ends[end].append(edge)
                if so_far + edge[1] > ahead[end]:
                    ahead[end], best[end] = so_far + edge[1], edge
        return ends, ahead, best

    def search(self, part: str) -> list[tuple[float, bytes]]:
        """The N best segmentations of ``part``: score and ids, best first.

        What is popped is followed along its best edges to the front, which no other entry can beat; the other
        edges are pushed.  Every entry stands for a segmentation of its own with the score of its key, so an
        edge whose key is no better than those of N others cannot be among the N best.
        """
        size, n, push = len(part), self.n, heapq.heappush
        ends, ahead, best = self.edges(part)
        found, serial = [], 0
        heap, top = [(-ahead[size], 0, size, 0.0, ())], [-ahead[size]]
        while heap and len(found) < n:
            _, _, at, behind, path = heapq.heappop(heap)
            while at:
                follow = best[at]
                if n > 1:
                    for edge in ends[at]:
                        if edge is follow:
                            continue
                        start, w, ids = edge
                        w += behind
                        cost = -(ahead[start] + w)
                        if len(top) == n:
                            if cost >= top[-1]:
                                continue
                            top.pop()
                        insort(top, cost)
                        serial += 1
                        push(heap, (cost, serial, start, w, (ids, path)))
                at, w, ids = follow
                behind += w
                path = (ids, path)
            ids = []
            while path:
                ids.append(path[0])
                path = path[1]
            found.append((behind, b"".join(ids)))
        return found

    def _flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the characters of all words, 0 for those in no piece, and where each word begins and the last ends."""
        signs = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        return self.code[signs], np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])

    def _edges(self, code: np.ndarray, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length, from 1: start and state of every piece in the words; starts ascend."""
        left = np.repeat(at[1:], np.diff(at)) - np.arange(len(code))
        start, state, out = np.arange(len(code)), self.root[code], []
        while len(start):
            here = ~np.isnan(self.state_score[state])
            out.append((start[here], state[here]))
            more = (left[start] > len(out)) & (state > 0)
            start = start[more]
            key = state[more] * self.signs + code[start + len(out)]
            found = np.searchsorted(self.step, key)
            met = self.step[found] == key
            start, state = start[met], self.follows[found[met]]
        return out

    def search_all(self, parts: list[str]) -> Searched:
        """``search`` of every part, all in step; the same segmentations in the same order."""
        n, inf = self.n, np.inf
        code, at = self._flat(parts)
        spelled = np.isnan(self.state_score[self.root[code]])
        odd = np.concatenate([[0], np.cumsum(spelled)])
        odd = (odd[at[1:]] > odd[at[:-1]]) | (np.diff(at) > IN_STEP)
        alone = {int(p): self.search(parts[p]) for p in np.flatnonzero(odd)}
        code, at = code[~np.repeat(odd, np.diff(at))], np.concatenate([[0], np.cumsum(np.where(odd, 0, np.diff(at)))])
        count, length = len(parts), np.diff(at)
        # A part of k characters has k + 1 nodes.
        front = at[:-1] + np.arange(count)
        back, nodes = front + length, len(code) + count
        owner = np.repeat(np.arange(count), length)
        place = np.arange(len(code)) - at[owner]
        edges = self._edges(code, at)
        ends = [s + owner[s] + k for k, (s, _) in enumerate(edges, 1)]
        # The edges into each node stand together, those from the front first.
        into = np.zeros(nodes + 1, np.int64)
        for e in ends:
            into[e + 1] += 1
        into = np.cumsum(into)
        filled, total = into[:-1].copy(), int(into[-1])
        start, score, ids = np.empty(total, np.int32), np.empty(total), np.empty(total, "<u4")
        order = []
        for k in range(len(edges), 0, -1):
            (s, state), e = edges[k - 1], ends[k - 1]
            to = filled[e]
            filled[e] += 1
            start[to], score[to], ids[to] = e - k, self.state_score[state], self.state_id[state]
            by = np.argsort((place[s] + k).astype(np.uint16), kind="stable")
            order.append((to[by], e[by], np.searchsorted((place[s] + k)[by], np.arange(int(length.max(initial=0)) + 2))))
        ahead, best = np.full(nodes, -inf), np.full(nodes, -1, np.int32)
        ahead[front] = 0.0
        for reach in range(1, int(length.max(initial=0)) + 1):
            for to, e, cut in order:
                x, v = to[cut[reach]:cut[reach + 1]], e[cut[reach]:cut[reach + 1]]
                if len(x):
                    value = ahead[start[x]] + score[x]
                    more = value > ahead[v]
                    ahead[v[more]], best[v[more]] = value[more], x[more]
        # What waits, best first and in the order of coming: cost, score behind, edge, rank of what it departs from.
        width = max(1, n - 1)
        cost, behind = np.full((count, width), inf), np.zeros((count, width))
        edge, parent = np.zeros((count, width), np.int64), np.zeros((count, width), np.int64)
        scores, chosen = np.full((n, count), -inf), np.full((n, nodes), -1, np.int32)
        node_owner = np.repeat(np.arange(count), length + 1)
        for r in range(n):
            if r == 0:
                here = np.flatnonzero(~odd)
                now, sum_ = back[here], np.zeros(len(here))
            else:
                here = np.flatnonzero(cost[:, 0] < inf)
                x, q, sum_ = edge[here, 0], parent[here, 0], behind[here, 0]
                now = start[x]
                turn, origin = np.full(count, nodes), np.zeros(count, np.int64)
                turn[here] = to_ = np.searchsorted(into, x, "right") - 1
                origin[here] = q
                keep = np.flatnonzero(np.arange(nodes) > turn[node_owner])
                chosen[r, keep] = chosen[origin[node_owner[keep]], keep]
                chosen[r, to_] = x
                for waiting in (cost, behind, edge, parent):
                    waiting[:, :-1] = waiting[:, 1:]
                cost[:, -1] = inf
            going = np.arange(len(here))
            while True:
                going = going[now[going] != front[here[going]]]
                if not len(going):
                    break
                v = now[going]
                follow = best[v]
                chosen[r, v] = follow
                if r < n - 1:
                    x, stop, own, so_far = into[v], into[v + 1], going, sum_[going]
                    skip = follow
                    while len(x):
                        w = score[x] + so_far
                        c = -(ahead[start[x]] + w)
                        p = here[own]
                        new = np.flatnonzero((x != skip) & (c < cost[p, -1]))
                        p, c_ = p[new], c[new]
                        spot = (cost[p] <= c_[:, None]).sum(1)
                        for j in range(width - 1, 0, -1):
                            move = p[spot < j]
                            for waiting in (cost, behind, edge, parent):
                                waiting[move, j] = waiting[move, j - 1]
                        cost[p, spot], behind[p, spot], edge[p, spot], parent[p, spot] = c_, w[new], x[new], r
                        more = x + 1 < stop
                        x, stop, own, so_far, skip = x[more] + 1, stop[more], own[more], so_far[more], skip[more]
                sum_[going] += score[follow]
                now[going] = start[follow]
            scores[r, here] = sum_
        raw, starts = [], []
        for c in chosen:
            on = c >= 0
            raw.append(ids[c[on]].tobytes())
            starts.append(4 * np.concatenate([[0], np.cumsum(on)])[np.append(front, nodes)])
        return Searched(scores, raw, starts, alone)

    def cut_all(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different parts of the words, cut between neighbours that no piece holds together; those of the words
        end to end, and where each word's begin and the last end."""
        text, numbers = "".join(words), {}
        code, at = self._flat(words)
        apart = np.ones(len(code) + 1, bool)
        apart[1:-1] = ~self.together[code[:-1] * self.signs + code[1:]] if self.signs <= DENSE else [
            p not in self.inside for p in map("".join, zip(text[:-1], text[1:]))]
        apart[at] = True
        cuts = np.flatnonzero(apart)
        part = np.array([numbers.setdefault(text[a:b], len(numbers)) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())],
                        np.int64)
        return list(numbers), part, np.searchsorted(cuts, at)

    def encode(self, texts: list[str]) -> list[list[tuple[float, bytes]]]:
        """The N best of each text; the empty text has one segmentation, without pieces."""
        numbers: dict[str, int] = {}
        number, size = numbers.setdefault, numbers.__len__
        split = [[number(w, size()) for w in _CHUNK.findall(BLANK + t.replace(" ", BLANK))] if t else [] for t in texts]
        if not numbers:
            return [[(0.0, b"")] for _ in texts]
        parts, part, at = self.cut_all(list(numbers))
        del numbers, number, size
        known = self.search_all(parts)
        score, gap = np.add.reduceat(known.score[part], at[:-1]), np.minimum.reduceat(known.gap[part], at[:-1])
        part, at, best = part.tolist(), at.tolist(), known.best
        ids = [best[part[a]] if b - a == 1 else b"".join([best[p] for p in part[a:b]]) for a, b in zip(at, at[1:])]
        out = []
        for words in split:
            if not words:
                out.append([(0.0, b"")])
                continue
            code, near = np.array(words), {}
            for i in np.argsort(gap[code], kind="stable")[:self.n - 1].tolist():
                a, b = at[words[i]], at[words[i] + 1]
                near[i] = known.found(part[a]) if b - a == 1 else chain([known.found(p) for p in part[a:b]], self.n)
            out.append(departures(sum(score[code].tolist()), [ids[w] for w in words], near, self.n))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of some ids; the blank in front goes, bytes that are no UTF-8 are replaced."""
        raw = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw[raw[:1] == b" ":].decode("utf-8", "replace")


def lattice(path: str, n: int) -> Lattice:
    return kept(("lattice", path, n), lambda: Lattice(path, n))


def encode_pieces(docs: DataFrame, model: str, n: int = 3, text: str = "text", key: str = "doc_id",
                  with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_pieces, ids_crc32, score, nbest_scores, nbest_n_pieces, nbest_ids_crc32,
    round_trip (and ids, nbest_ids).

    The ids are those of the best segmentation by the sum of piece scores; the ``nbest`` columns have those of the
    ``n`` best, best first, fewer where there are not so many; ``round_trip`` says whether the decoded ids are the
    text (a text that holds U+2581 itself comes back with blanks).  A null or empty text has no
    pieces, score 0 and comes back as the empty text.  Between equal scores the choice is fixed.  Repeated
    rows and null ids are encoded row by row; other columns are not read; an empty table gives
    an empty result.  Texts of any length are encoded whole.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc_id", "n_pieces", "ids_crc32", "score", "nbest_scores", "nbest_n_pieces", "nbest_ids_crc32",
             "round_trip"] + ["ids", "nbest_ids"] * with_ids

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model, n)
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = pieces.encode(texts)
                ids = [f[0][1] for f in found]
                columns = [part.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                           pa.array([zlib.crc32(i) for i in ids], pa.int64()), pa.array([f[0][0] for f in found]),
                           pa.array([[s for s, _ in f] for f in found], pa.list_(pa.float64())),
                           pa.array([[len(i) // 4 for _, i in f] for f in found], pa.list_(pa.int64())),
                           pa.array([[zlib.crc32(i) for _, i in f] for f in found], pa.list_(pa.int64())),
                           pa.array([pieces.decode(i) == t for i, t in zip(ids, texts)], pa.bool_())]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(i, "<i4") for i in ids], pa.list_(pa.int32())))
                    columns.append(pa.array([[np.frombuffer(i, "<i4") for _, i in f] for f in found],
                                            pa.list_(pa.list_(pa.int32()))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        encoded, f"doc_id {kind}, n_pieces long, ids_crc32 long, score double, nbest_scores array<double>, "
                 f"nbest_n_pieces array<long>, nbest_ids_crc32 array<long>, round_trip boolean"
                 + ", ids array<int>, nbest_ids array<array<int>>" * with_ids)


def decode_pieces(rows: DataFrame, model: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """doc_id and text of each row's ids; a null array is the empty text."""
    kind = rows.schema[key].dataType.simpleString()

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model, 1)
        for batch in batches:
            texts = [pieces.decode(np.array(i or [], "<u4").tobytes()) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col(key).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(decoded, f"doc_id {kind}, text string")
