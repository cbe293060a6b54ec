"""Language-model scoring with a Katz backoff model of any order from two.

Every training word is a symbol, named by its 64-bit hash, and so are the end of a text and, as one, all words
that were never met.  A symbol's probability after a history is the Good-Turing discounted relative count
where the two were met together in training, and elsewhere the backoff weight of the history times the
probability after the history without its first symbol, down to add-one shares of the training tokens; the
weights make the sum over all symbols one.  One count is kept back after each history, so there is always
mass to back off with.  With ``share`` the words below it are one symbol inside the histories and have their
add-one share of its tokens there.

Every count covers all training tokens.  Each slice of texts sends its distinct runs of ``order`` symbols, with the
documents they stand in, to the owner of the last symbol (owners of frequent symbols are split by the symbol
before it), so an owner knows the counts of all orders of a run.  It answers with the counts of each document's runs,
which the slice adds up; their size follows the tokens, however many owners there are.  Terms of histories, and what
held-out tokens ask for, go to the owner of the history, which adds the terms up; of the longest histories, which are
most, only those that held-out tokens ask for are kept.  Counts and weights are then met in joins, where frequent
histories are broadcast.  In all that is sent, frequent symbols are short codes that are broadcast (a bounded number), and
shuffles are dropped as soon as they are staged.  Texts are not shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Words, in_fold, mixed, release, shuffles_dropped, stage, text_slices

#: Share of the training tokens below which words share one symbol; 0 keeps all words.
SHARE = 0.0
#: Counts above this are not discounted.
TOP = 5
#: Blobs are as many as slices times owners, so both are as large as memory allows.
SLICE_BYTES = 8_000_000
BUCKET_TOKENS = 750_000
HISTORY_TOKENS = 3_000_000
#: Texts whose words are hashed at once, and bytes of blobs that are passed on at once.
_WORD_BYTES = 1_000_000
_SENT_BYTES = 1_000_000
#: Blobs that are read at once.
_JOINT_BYTES = 250_000
#: Words with at least this share of the training tokens are broadcast, for short codes.
COMMON = 1 / (1 << 23)
#: Histories with at least this share of the training tokens are broadcast.
OFTEN = 1 / (1 << 19)
#: The longest histories are summed, and all asked for, in so many passes, whose shuffles follow each other.
PASSES = 2
#: Stand among the hashes of words.  Before the beginning there is nothing.
_NOTHING, _BEGIN, _END, _OTHER = (np.uint64(i) for i in range(4))
_STEP = np.uint64(0x9E3779B97F4A7C15)


_ZSTD = pa.Codec("zstd")


def _bytes(*arrays: np.ndarray) -> bytes:
    """Arrays of one dimension, packed byte place by byte place, since high bytes differ little."""
    head = pickle.dumps([(x.dtype.str, len(x)) for x in arrays], protocol=5)
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes() for x in arrays]
    raw = b"".join([len(head).to_bytes(4, "little"), head, *planes])
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _arrays(blob: bytes) -> list[np.ndarray]:
    raw = _ZSTD.decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    at, out = 4 + int.from_bytes(raw[:4], "little"), []
    for kind, n in pickle.loads(raw[4:at]):
        kind = np.dtype(kind)
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def _small(x: np.ndarray) -> np.ndarray:
    """The same integers in the least type that holds them."""
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 1 << 32 else np.int64)


def _joined(g: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Names of runs of ``k`` symbols from those of k - 1 and the symbol before these."""
    return mixed(g * _STEP + mixed(x + np.uint64(k)))


def _histories_of(run: list[np.ndarray]) -> list[np.ndarray]:
    """Names of the histories of one symbol, of two, and so on, from the symbols before a symbol, the nearest first."""
    out = [mixed(run[0] + _STEP)]
    for k, x in enumerate(run[1:], 3):
        out.append(_joined(out[-1], x, k))
    return out


def _place(names: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of ``h`` is among the sorted names, and where."""
    at = np.searchsorted(names, h)
    at[at == len(names)] = 0
    return names[at] == h, at


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in order, where one of each stands, and each value's number among them."""
    by = np.argsort(x)
    x = x[by]
    new = _changes(x)
    number = np.empty(len(x), np.int64)
    number[by] = np.cumsum(new) - 1
    return x[new], by[new], number


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns has another value than in the row before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for x in columns:
        out[1:] |= x[1:] != x[:-1]
    return out


def _trees(run: list[np.ndarray], codes: list[np.ndarray], cut: np.ndarray) -> list[list[np.ndarray]]:
    """For the rows between each two of ``cut``, runs whose equal beginnings stand together: at each place the symbols
    that change there, and how often each stands."""
    out, new = [[] for _ in cut[1:]], np.zeros(len(run[0]), bool)
    new[cut[:-1]] = True
    for x, code in zip(run, codes):
        new |= _changes(x)
        at = np.flatnonzero(new)
        code, ends = code[at], np.searchsorted(at, cut)
        rare = np.flatnonzero(code == 0)
        ends_rare = np.searchsorted(rare, ends)
        code, rare, times = _small(code), x[at[rare]], _small(np.diff(np.append(at, len(x))))
        for i, tree in enumerate(out):
            mine, his = slice(ends[i], ends[i + 1]), slice(ends_rare[i], ends_rare[i + 1])
            tree += [code[mine], rare[his], times[mine]]
    return out


def _joint(lists) -> list[np.ndarray]:
    """The arrays of several blobs, one after the other."""
    return [np.concatenate(x) for x in zip(*lists)]


def _runs_of(m: Symbols, tree: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Runs and their codes."""
    run, codes = [], []
    for code, rare, times in zip(tree[::3], tree[1::3], tree[2::3]):
        x = m.coded[code]
        x[code == 0] = rare
        run.append(np.repeat(x, times))
        codes.append(np.repeat(code.astype(np.uint32), times))
    return run, codes


class Symbols:
    """Totals of the training texts, the counts of frequent symbols, and the kept words if not all are."""

    def __init__(self, heavy: dict[int, int], kept: np.ndarray | None, kept_types: int, kept_tokens: int,
                 tokens: int, texts: int, types: int, buckets: int, common: np.ndarray, common_n: np.ndarray):
        #: Training tokens, ends included; distinct training tokens, the end included.
        self.tokens, self.types, self.texts, self.buckets = tokens + texts, types + (texts > 0), texts, buckets
        self.other_tokens, self.other_types = tokens - kept_tokens, types - kept_types
        self.kept = kept
        count = {**heavy, int(_END): texts, int(_OTHER): self.other_tokens}
        self.heavy = np.array(sorted(count), np.uint64)
        self.count = np.array([count[int(h)] for h in self.heavy], np.int64)
        #: What the add-one counts of all symbols add up to.
        self.total = self.tokens + kept_types + 2.0
        #: What stands for frequent symbols in blobs are their numbers here, the most frequent first; 0 is any other one.
        special = np.array([_NOTHING, _NOTHING, _BEGIN, _END, _OTHER], np.uint64)
        self.coded = np.concatenate([special, common])
        #: Their counts.
        self.often = np.concatenate([[0, 0, 0, texts, self.other_tokens], common_n]).astype(np.int64)
        by = 1 + np.argsort(self.coded[1:])
        self._sorted, self._number = self.coded[by], by
        #: Owners of histories.
        self.owners = max(8, self.tokens // HISTORY_TOKENS)

    def code(self, x: np.ndarray) -> np.ndarray:
        found, at = _place(self._sorted, x)
        return np.where(found, self._number[at], 0).astype(np.uint32)

    def of(self, h: np.ndarray) -> np.ndarray:
        if self.kept is None:
            return h
        if not len(self.kept):
            return np.full(len(h), _OTHER)
        return np.where(_place(self.kept, h)[0], h, _OTHER)


def _count_words(rows: DataFrame) -> DataFrame:
    """Training counts of words: word, n, texts (the last on one row per task)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        words, n, texts, waiting = [], [], 0, 0

        def merged():
            names, inverse = np.unique(np.concatenate(words), return_inverse=True)
            return names, np.bincount(inverse, np.concatenate(n), len(names)).astype(np.int64)

        for batch in batches:
            for part in text_slices(batch, "text", _WORD_BYTES):
                names, met = np.unique(Words(part.column("text")).hash, return_counts=True)
                words.append(names)
                n.append(met)
                texts += len(part)
                waiting += len(names)
                if waiting > 1_000_000:
                    names, met = merged()
                    yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(met)], names=["word", "n"])
                    words, n, waiting = [], [], 0
        if words:
            names, met = merged()
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(met)], names=["word", "n"])

    return rows.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))

def symbols(train: DataFrame, share: float = SHARE) -> Symbols:
    """``train`` has the training texts as ``text``.

    The driver receives fewer words than there are owners, at most ``1 / COMMON`` common ones, and with a ``share``
    at most ``1 / share`` more.
    """
    all_ = Observation()
    words = _count_words(train).observe(all_, F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v"))
    words = stage(words.filter("n > 1"), "word-counts")
    texts, tokens, types = train.count(), int(all_.get["n"]), int(all_.get["v"])
    buckets = max(8, (tokens + texts) // BUCKET_TOKENS)
    names = lambda df: df.toPandas()["word"].to_numpy(np.int64).view(np.uint64)
    kept, kept_types, kept_tokens = None, types, tokens
    if share * tokens > 1:
        often = words.filter(F.col("n") >= share * tokens)
        kept = np.sort(names(often))
        kept_types, kept_tokens = len(kept), int(often.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        words = often
    heavy = {r["word"] % (1 << 64): r["n"] for r in words.filter(F.col("n") * buckets >= max(1, tokens)).collect()}
    common = words.filter(F.col("n") >= max(2, COMMON * tokens)).toPandas().sort_values("n", ascending=False, kind="stable")
    common, common_n = common["word"].to_numpy(np.int64).view(np.uint64), common["n"].to_numpy(np.int64)
    return Symbols(heavy, kept, kept_types, kept_tokens, tokens, texts, types, buckets, common, common_n)


#: Kinds of blobs: of a slice, its runs, folded words, what runs of held-out texts ask of the histories, terms of
#: histories, how many runs have small counts.
_HEAD, _RUNS, _FOLDED, _ASKED, _TERMS, _MET = range(6)


def _words(texts: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and how many each text has."""
    some = [Words(x.column("text")) for x in text_slices(texts, "text", _WORD_BYTES)]
    return np.concatenate([x.hash for x in some]), np.concatenate([x.per_doc for x in some])


def _requests(rows: DataFrame, model, order: int) -> DataFrame:
    """Blobs of each slice for the owners: bucket, slice, kind, blob.  In a slice training texts come first."""
    kind = rows.schema["id"].dataType

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Symbols = model.value
        buckets = m.buckets
        salts = 1 + 2 * m.count * buckets // max(1, m.tokens)
        task, serial = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in text_slices(batch, "text", SLICE_BYTES):
                release()
                name = (task << 24) | serial
                serial += 1
                train = np.asarray(part.column("train"), bool)
                by = np.argsort(~train, kind="stable")
                train, part = train[by], part.take(pa.array(by))
                hash_, per_doc = _words(part)
                symbol, docs = m.of(hash_), len(part)
                # The symbols of each text and its end, in order, and those before each.
                total = per_doc + 1
                last = np.cumsum(total) - 1
                here = np.empty(last[-1] + 1, np.uint64)
                inner = np.ones(len(here), bool)
                inner[last] = False
                here[inner], here[last] = symbol, _END
                doc = np.repeat(np.arange(docs), total)
                place = np.arange(len(here)) - np.repeat(last + 1 - total, total)
                names, _, number = _distinct(here)
                names, number = np.concatenate([[_NOTHING, _BEGIN], names]), (number + 2).astype(np.int32)
                run = [number]
                for back in range(1, order):
                    x = np.zeros(len(here), np.int32)
                    x[back:] = number[:-back]
                    x[place == back - 1] = 1
                    x[place < back - 1] = 0
                    run.append(x)
                code = m.code(names)
                heavy, at = _place(m.heavy, names)
                met = np.where((code > 0) & (names != _OTHER), m.often[code], -1)[number]
                local = met >= 0
                sure = np.bincount(doc[local], np.log10(met[local] + 1.0), docs).astype(float)
                known = np.bincount(doc[local], met[local] > 0, docs)
                salts_ = np.where(heavy, salts[at], 1).astype(np.uint64)[number]
                salt = (mixed(names) >> np.uint64(33))[run[1]] % salts_
                owner = _small((mixed(here * _STEP + salt) % np.uint64(buckets)).astype(np.int64))
                out = [(name % buckets, _HEAD, _bytes(total, known, sure))]
                if m.kept is not None:
                    rare = symbol == _OTHER
                    h = hash_[rare]
                    other, _, number = _distinct(h)
                    out += owner_blobs((h % np.uint64(buckets)).astype(np.int64), [number], other, m.code(other), doc[inner][rare], train, _FOLDED)
                del hash_, symbol, here, inner, place, number, x, met, local, salts_, salt, heavy, at
                out += owner_blobs(owner, run, names, code, doc, train, _RUNS)
                del run, owner, doc
                ids = part.column("id")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([name] * len(out), pa.int64()),
                     pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.binary()),
                     pa.array([ids.to_pylist() if o[1] == _HEAD else None for o in out], pa.list_(ids.type)),
                     pa.array([train.tolist() if o[1] == _HEAD else None for o in out], pa.list_(pa.bool_()))],
                    names=["bucket", "slice", "kind", "blob", "ids", "train"])

    return rows.mapInArrow(make, f"bucket int, slice long, kind int, blob binary, ids array<{kind.simpleString()}>, train array<boolean>")


def _in_order(run: list[np.ndarray], doc: np.ndarray, size: int, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of runs of numbers below ``size``, equal ones by document, and numbers that rise with the runs in this order."""
    key, top = np.zeros(len(doc), np.int64), 1
    for x in run:
        if top * size >= 1 << 63:
            names, _, key = _distinct(key)
            top = len(names)
        key, top = key * size + x, top * size
    by = np.argsort(key * docs + doc) if top * docs < 1 << 63 else np.argsort(key, kind="stable")
    return by, key[by]


def owner_blobs(owner, run, names, code, doc, train, kind):
    """One blob per owner: distinct runs, training counts, then per (run, document) document and count, and of runs
    how many texts are training texts.

    Runs are numbers among ``names``, and documents rise.
    """
    if not len(doc):
        return []
    order, key = _in_order(run, doc, len(names), len(train))
    by = np.argsort(_small(owner[order]), kind="stable")
    order, key = order[by], key[by]
    owner, doc = owner[order], doc[order]
    fresh = _changes(owner, key)
    at = np.flatnonzero(fresh | _changes(doc))
    n, d, fresh = np.diff(np.append(at, len(doc))), doc[at], fresh[at]
    first = np.flatnonzero(fresh)
    per = np.diff(np.append(first, len(d)))
    met = np.add.reduceat(np.where(train[d], n, 0), first)
    owner, order = owner[at[first]], order[at[first]]
    run = [x[order] for x in run]
    run, codes = [names[x] for x in run], [code[x] for x in run]
    cut, edge = np.append(np.flatnonzero(_changes(owner)), len(owner)), np.append(first, len(d))
    met, per, d, n = (_small(x) for x in (met, per, d, n))
    learnt = [np.array([train.sum()])] if kind == _RUNS else []
    return [(int(owner[lo]), kind, _bytes(*tree, met[lo:hi], per[lo:hi], d[edge[lo]:edge[hi]], n[edge[lo]:edge[hi]], *learnt))
            for lo, hi, tree in zip(cut[:-1], cut[1:], _trees(run, codes, cut))]


class Runs:
    """The distinct runs that an owner was sent: counts of their orders and names of their histories."""

    def __init__(self, m: Symbols, run: list[np.ndarray], met: np.ndarray):
        self.last, self.order = run[0], len(run)
        self.length = sum((x != _NOTHING).astype(np.int64) for x in run)
        heavy, at = _place(m.heavy, run[0])
        #: By order: count of the last symbols of each run; name of the history; one place for each run that was met.
        self.n, self.history, self.first = [None], [None, None, *_histories_of(run[1:])], [None, None]
        self.run, g = run, run[0]
        for k in range(1, self.order + 1):
            if k > 1:
                g = _joined(g, run[k - 1], k)
            _, index, inverse = _distinct(g)
            n = np.bincount(inverse, met).astype(np.int64)[inverse]
            n = np.where(heavy, m.count[at], n) if k == 1 else np.where(self.length >= k, n, 0)
            self.n.append(n)
            if k > 1:
                self.first.append(index[n[index] > 0])

    def by_owner(self, k: int, at: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``at`` by owner of the history of k - 1 symbols, those of equal last symbols of histories together;
        where an owner's begin, and the owners."""
        by = at if not len(at) else np.argsort(self.run[1][at])
        owner = (mixed(self.history[k][at[by]] + np.uint64(k)) % np.uint64(owners)).astype(np.int64)
        order = np.argsort(_small(owner), kind="stable")
        by, owner = by[order], owner[order]
        first = np.flatnonzero(_changes(owner))
        return by, np.append(first, len(owner)), owner[first]


def _answers(requests: DataFrame, model, order: int, partitions: int) -> DataFrame:
    """Per owner and slice the counts of each document's runs; terms of histories, and what is asked of them.

    Terms and questions go by the owner of the history; ``slice`` is there minus the order.
    """
    def runs(m: Symbols, bucket: int, mine: list[tuple]):
        run, codes = _runs_of(m, _joint(b[:3 * order] for _, _, b in mine))
        all_ = Runs(m, run, np.concatenate([b[3 * order] for _, _, b in mine]))
        for k in range(2, order + 1):
            first = all_.first[k]
            yield bucket, -k, _MET, _bytes(np.bincount(np.minimum(all_.n[k][first], TOP + 2), minlength=TOP + 3)[1:TOP + 2]), None, None
            by, cut, owners = all_.by_owner(k, first, m.owners)
            at = first[by]
            n, under = _small(all_.n[k][at]), _small(all_.n[k - 1][at])
            for owner, lo, hi, tree in zip(owners.tolist(), cut[:-1], cut[1:], _trees([x[at] for x in run[1:k]], [x[at] for x in codes[1:k]], cut)):
                yield owner, -k, _TERMS, _bytes(*tree, n[lo:hi], under[lo:hi]), None, None
        # The longest order that was met; 1 where none was.
        k, r = np.ones(len(run[0]), np.int64), np.zeros(len(run[0]), np.int64)
        for o in range(2, order + 1):
            seen = all_.n[o] > 0
            k[seen], r[seen] = o, all_.n[o][seen]
        # As the history of what comes next, which was met.
        own = np.choose(np.minimum(order - 1, all_.length) - 1, all_.n[1:order])
        own[all_.last == _END] = 0
        per, d, c = _joint(b[3 * order + 1:3 * order + 4] for _, _, b in mine)
        sizes = [len(b[3 * order + 2]) for _, _, b in mine]
        at, of = np.repeat(np.arange(len(per)), per), np.repeat(np.arange(len(mine)), sizes)
        learnt = d < np.repeat([b[3 * order + 4][0] for _, _, b in mine], sizes)
        by = np.argsort(of << 32 | d, kind="stable")
        at, of, d, c, learnt = at[by], of[by], d[by], c[by], learnt[by]
        # Slices know the counts of frequent words.
        rare = codes[0][at] == 0
        new = np.flatnonzero(_changes(of, d))
        texts, times = d[new], _small(np.diff(np.append(new, len(d))))
        columns = [c, rare, _small(np.where(rare | (k[at] == 1), all_.n[1][at], 0)), k[at].astype(np.uint8), _small(r[at]),
                   _small(np.where(learnt, own[at], 0))]
        ends, edge = np.searchsorted(of, np.arange(len(mine) + 1)), np.searchsorted(of[new], np.arange(len(mine) + 1))
        for i, (s, kind, _) in enumerate(mine):
            yield bucket, s, kind, _bytes(texts[edge[i]:edge[i + 1]], times[edge[i]:edge[i + 1]],
                                          *[x[ends[i]:ends[i + 1]] for x in columns]), None, None
        del columns, texts, times, rare, new, by
        held = np.flatnonzero(~learnt)
        if not len(held):
            return
        at, d, c, s = at[held], d[held], c[held], np.array([s for s, _, _ in mine])[of[held]]
        for o in range(2, order + 1):
            some = np.flatnonzero((k[at] <= o) & (all_.length[at] >= o))
            by, cut, owners = all_.by_owner(o, at[some], m.owners)
            here = some[by]
            rows, weight, docs, times = at[here], k[at[here]] < o, _small(d[here]), _small(c[here])
            for owner, lo, hi, tree in zip(owners.tolist(), cut[:-1], cut[1:], _trees([x[rows] for x in run[1:o]], [x[rows] for x in codes[1:o]], cut)):
                slices, _, number = _distinct(s[here[lo:hi]])
                yield owner, -o, _ASKED, _bytes(*tree, slices, _small(number), docs[lo:hi], weight[lo:hi], times[lo:hi]), None, None

    def folded(m: Symbols, bucket: int, mine: list[tuple]):
        mine = [(s, _runs_of(m, b[:3])[0][0], *b[3:]) for s, _, b in mine]
        keys, inverse = np.unique(np.concatenate([b[1] for b in mine]), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([b[2] for b in mine]), len(keys)).astype(np.int64)
        for s, k, _, per, d, c in mine:
            r = counts[np.repeat(np.searchsorted(keys, k), per)]
            d, c = d.astype(np.int64), c.astype(np.int64)
            docs, local = np.unique(d, return_inverse=True)
            n = len(docs)
            yield bucket, s, _FOLDED, _bytes(_small(docs), np.bincount(local, np.log10(r + 1.0) * c, n),
                                             np.bincount(local, c, n), np.bincount(local, c * (r > 0), n)), None, None

    def finish(m: Symbols, bucket: int, rows: list[tuple]):
        for what, kinds in ((runs, (_RUNS,)), (folded, (_FOLDED,))):
            mine = [(s, k, _arrays(blob)) for s, k, blob in rows if k in kinds]
            if mine:
                yield from what(m, bucket, mine)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, now, rows = model.value, None, []
        ids_type = None

        def sent(some):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*some), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), ids_type, pa.list_(pa.bool_())))],
                names=["bucket", "slice", "kind", "blob", "ids", "train"])

        def out(found):
            some, size = [], 0
            for f in found:
                some.append(f)
                size += len(f[3])
                if size > _SENT_BYTES:
                    yield sent(some)
                    some, size = [], 0
            if some:
                yield sent(some)

        for batch in batches:
            ids_type = batch.schema.field("ids").type
            for r in batch.to_pylist():
                if r["bucket"] != now:
                    yield from out(finish(m, now, rows))
                    now, rows = r["bucket"], []
                    release()
                if r["kind"] == _HEAD:
                    yield from out([(now, r["slice"], _HEAD, r["blob"], r["ids"], r["train"])])
                else:
                    rows.append((r["slice"], r["kind"], r["blob"]))
        if rows:
            yield from out(finish(m, now, rows))

    return (requests.repartition(partitions, "bucket").sortWithinPartitions("bucket")
            .mapInArrow(work, requests.schema))


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's discounts of counts 1 to TOP from the numbers of pairs with counts 1 to TOP + 1.

    Where those numbers give no factor between 0 and 1, half a count is taken off instead.
    """
    r = np.arange(1, TOP + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        common = (TOP + 1) * n[TOP] / n[0]
        d = ((r + 1) * n[1:] / (r * n[:-1]) - common) / (1 - common)
    return np.where(np.isfinite(d) & (d > 0) & (d < 1), d, (r - 0.5) / r)

def _discounts(answers: DataFrame, order: int) -> np.ndarray:
    """Discounts of counts 1 to TOP by order; rows 0 and 1 are not used."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, blob in zip(batch.column("slice").to_pylist(), batch.column("blob").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array([-k] * (TOP + 1)), pa.array(range(1, TOP + 2)), pa.array(_arrays(blob)[0])],
                                                 names=["k", "r", "n"])

    met = np.zeros((order + 1, TOP + 1))
    found = answers.filter(f"kind = {_MET}").select("slice", "blob").mapInArrow(add, "k long, r long, n long")
    for r in found.groupBy("k", "r").agg(F.sum("n").alias("n")).collect():
        met[r["k"], r["r"] - 1] = r["n"]
    return np.stack([discounts(x) for x in met])


def _look_up(rows: DataFrame, table: DataFrame, limit: int) -> DataFrame:
    """``rows`` with the columns of their history ``h``, without those of unknown ones; histories met ``limit`` times are broadcast."""
    often = F.broadcast(table.filter(F.col("c") >= limit))
    return rows.join(often, "h").unionByName(
        rows.join(often.select("h"), "h", "left_anti").join(table.filter(F.col("c") < limit), "h"))


def _histories(answers: DataFrame, shared, d: np.ndarray, limit: int, order: int, partitions: int) -> DataFrame:
    """h, c, log_c, log_weight of the histories met in training: all but the longest, and of these what is asked for.

    Nothing else refers to the longest, and by far the most are of that length.
    """
    def discounted(k, n):
        return np.where(n <= TOP, n * d[k][np.minimum(n, TOP) - 1], n).astype(float)

    def sums(k: int, blobs: list[list[np.ndarray]], wanted: np.ndarray | None) -> list[np.ndarray]:
        """h, up, c, mass, below of blobs of terms, of the histories in ``wanted`` only where it is given."""
        m = shared.value
        *tree, n, under = _joint(blobs)
        names = _histories_of(_runs_of(m, tree)[0])
        h, up = names[-1], names[-2] if k > 2 else names[-1]
        if wanted is not None:
            at = np.flatnonzero(_place(wanted, h)[0]) if len(wanted) else np.zeros(0, np.int64)
            h, up, n, under = h[at], up[at], n[at], under[at]
        n, under = n.astype(np.int64), under.astype(np.int64)
        return total(h, up, n, discounted(k, n), (under + 1) / m.total if k == 2 else discounted(k - 1, under))

    def total(h, up, *parts):
        names, index, number = _distinct(h)
        return [names, up[index], *[np.bincount(number, x, len(names)).astype(x.dtype) for x in parts]]

    def finish(now: tuple | None, found: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if found:
            h, up, *parts = total(*[np.concatenate(x) for x in zip(*found)])
            up = pa.array(up.view(np.int64) if now[0] < -2 else [None] * len(h), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), up, *map(pa.array, parts)],
                                             names=["h", "up", "c", "mass", "below"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        now, what, wanted, found, held, size = None, None, None, [], [], 0

        def gathered():
            """The blobs that are held become one."""
            nonlocal held, size, wanted
            if what == _ASKED:
                names = _histories_of(_runs_of(shared.value, _joint(x[:3 * (order - 1)] for x in held))[0])[-1]
                wanted = _distinct(np.concatenate([wanted, names]))[0]
            elif held:
                found.append(sums(-now[0], held, wanted))
            held, size = [], 0

        for batch in batches:
            for i in range(len(batch)):
                k, bucket, kind, blob = (x[i].as_py() for x in batch.columns)
                if (k, bucket, kind) != (*(now or (0, 0)), what):
                    gathered()
                    what = kind
                if (k, bucket) != now:
                    yield from finish(now, found)
                    now, wanted, found = (k, bucket), np.zeros(0, np.uint64) if k == -order else None, []
                held.append(_arrays(blob))
                size += len(blob)
                if size > _JOINT_BYTES:
                    gathered()
        gathered()
        yield from finish(now, found)

    def summed(which: str) -> DataFrame:
        return (answers.filter(which).select("slice", "bucket", "kind", "blob").repartition(partitions, "slice", "bucket")
                .sortWithinPartitions("slice", "bucket", "kind")
                .mapInArrow(add, "h long, up long, c long, mass double, below double"))

    shorter = stage(summed(f"kind = {_TERMS} and slice > {-order}"), "katz-shorter")
    sums_ = shorter
    for p in range(PASSES):
        longest = summed(f"kind in ({_ASKED}, {_TERMS}) and slice = {-order} and bucket % {PASSES} = {p}")
        sums_ = sums_.unionByName(stage(longest, "katz-longest"))
    names = shorter.select("h", "c")
    long = _look_up(sums_.filter("up is not null").select(F.col("up").alias("h"), F.col("h").alias("name"), F.col("c").alias("n"),
                                                         "mass", "below"), names, limit)
    both = long.select(F.col("name").alias("h"), F.col("n").alias("c"), "mass", (F.col("below") / (F.col("c") + 1)).alias("below")
                       ).unionByName(sums_.filter("up is null").select("h", "c", "mass", "below"))
    weight = (1 - F.col("mass") / (F.col("c") + 1)) / F.greatest(1 - F.col("below"), F.lit(1e-12))
    return stage(both.select("h", "c", F.log10(F.col("c") + 1).alias("log_c"),
                             F.log10(F.greatest(weight, F.lit(1e-300))).alias("log_weight")), "katz-weights")


def _asked(answers: DataFrame, shared, often: tuple[np.ndarray, ...]) -> DataFrame:
    """What held-out tokens ask for: slice, doc and, if the history is among ``often``, the value, which is added up.

    Else the history ``h``, whether its weight or its count is asked for, and times.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blobs in joint(batch.column("blob").to_pylist()):
                *tree, slices, number, doc, weight, c = blobs
                h = _histories_of(_runs_of(shared.value, tree)[0])[-1]
                names, log_c, log_weight = shared_often.value
                found, at = _place(names, h) if len(names) else (np.zeros(len(h), bool), np.zeros(len(h), np.int64))
                value = (np.where(weight, log_weight[at], -log_c[at]) * c)[found] if len(names) else np.zeros(0)
                where, _, text = _distinct(number[found].astype(np.int64) << 32 | doc[found])
                rest, n = np.flatnonzero(~found), len(where)
                gap = lambda k, kind: pa.nulls(k, kind)
                both = lambda a, b: pa.concat_arrays([a, b])
                yield pa.RecordBatch.from_arrays(
                    [both(pa.array(slices[where >> 32]), pa.array(slices[number[rest]])),
                     both(pa.array((where & 0xFFFFFFFF).astype(np.int32)), pa.array(doc[rest].astype(np.int32))),
                     both(pa.array(np.bincount(text, value, n).astype(float)), gap(len(rest), pa.float64())),
                     both(gap(n, pa.int64()), pa.array(h[rest].view(np.int64))),
                     both(gap(n, pa.bool_()), pa.array(weight[rest])),
                     both(gap(n, pa.int32()), pa.array(c[rest].astype(np.int32)))],
                    names=["slice", "doc", "value", "h", "weight", "times"])

    def joint(blobs: list[bytes]) -> Iterator[list[np.ndarray]]:
        """Blobs of one length of histories, as one."""
        held, size, k = [], 0, None
        for blob in blobs:
            x = _arrays(blob)
            if held and (size > _JOINT_BYTES or len(x) != k):
                yield _joint(held)
                held, size = [], 0
            x[-4] = x[-4].astype(np.int64) + sum(len(y[-5]) for y in held)
            held.append(x)
            size, k = size + len(blob), len(x)
        if held:
            yield _joint(held)

    shared_often = answers.sparkSession.sparkContext.broadcast(often)
    return answers.filter(f"kind = {_ASKED}").select("blob").mapInArrow(
        rows, "slice long, doc int, value double, h long, weight boolean, times int")


def katz_scores(docs: DataFrame, text: str = "text", key: str = "doc_id", parts: int = 7, fold: int = 2,
                share: float = SHARE, order: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows outside the fold (a null id is outside); a null text is empty and has the end
    token only.  ``order`` is the number of symbols in the longest runs that are counted.  ``base_score`` is the
    add-one unigram score, ``score`` the model's log10 probability.
    Repeated rows count and are scored row by row; other columns are not read; an empty table
    gives an empty result.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), (~in_fold(F.col(key), parts, fold)).alias("train"))
    with shuffles_dropped(spark):
        m = symbols(rows.filter("train"), share)
        shared = spark.sparkContext.broadcast(m)
        partitions = max(m.buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
        answers = stage(_answers(_requests(rows, shared, order), shared, order, partitions), "katz-answers")
        d = _discounts(answers, order)
        limit = max(1, int(OFTEN * m.tokens))
        weights = _histories(answers, shared, d, limit, order, partitions)
        most = weights.filter(F.col("c") >= limit).toPandas()
        h = most["h"].to_numpy(np.int64).view(np.uint64)
        by = np.argsort(h)
        often = h[by], most["log_c"].to_numpy(float)[by], most["log_weight"].to_numpy(float)[by]
        asked = stage(_asked(answers, shared, often), "katz-asked")
        value = F.col("times") * F.when(F.col("weight"), F.col("log_weight")).otherwise(-F.col("log_c"))
        backed = asked.filter("h is null").select("slice", "doc", "value")
        for p in range(PASSES):
            mine = F.pmod(F.xxhash64("h"), F.lit(PASSES)) == p
            rest = asked.filter("h is not null").filter(mine).drop("value").join(weights.filter(F.col("c") < limit).filter(mine), "h")
            backed = backed.unionByName(stage(rest.groupBy("slice", "doc").agg(F.sum(value).alias("value")), "katz-backed"))
        backed = backed.groupBy("slice", "doc").agg(F.sum("value").alias("value"))
    #: By order and count, as far as it is discounted; 0 elsewhere.
    log_d, n_train, types, texts, all_ = np.zeros((order + 1, TOP + 2)), m.tokens, m.types, m.texts, m.total
    log_d[2:, 1:TOP + 1] = np.log10(d[2:])
    other = np.log10(m.other_tokens + m.other_types + 1.0)

    def few(blobs) -> Iterator[list[np.ndarray]]:
        """The arrays of blobs, of several at once."""
        held, size = [], 0
        for blob in blobs:
            held.append(_arrays(blob))
            size += len(blob)
            if size > _JOINT_BYTES:
                yield _joint(held)
                held, size = [], 0
        if held:
            yield _joint(held)

    def gather(part: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        release()
        head = part[part["kind"] == _HEAD].iloc[0]
        total, known, base = _arrays(head["blob"])
        known, base = known.astype(float), base.copy()
        train = np.array(head["train"], bool)
        score = np.where(train, -np.log10(texts + 1.0), 0.0)
        np.add.at(score, more["doc"].to_numpy(np.int64), more["value"].to_numpy(float))
        for docs_, n_, c, rare, one, k, r, own in few(part.loc[part["kind"] == _RUNS, "blob"]):
            at, c, r, log_one = np.repeat(docs_, n_), c.astype(float), r.astype(np.int64), np.log10(one + 1.0)
            value_ = np.where(k > 1, np.log10(np.maximum(r, 1)), log_one - np.log10(all_))
            value_ += log_d[k, np.minimum(r, TOP + 1)] - np.log10(own + 1.0)
            score += np.bincount(at, value_ * c, len(total))
            base += np.bincount(at[rare], (log_one * c)[rare], len(total))
            known += np.bincount(at[rare], (c * (one > 0))[rare], len(total))
        for blob in part.loc[part["kind"] == _FOLDED, "blob"]:
            docs_, value_, n_, k_ = _arrays(blob)
            base[docs_] += value_
            score[docs_] += value_ - n_ * other
            known[docs_] += k_
        return pd.DataFrame({"doc_id": list(head["ids"]), "held_out": ~train,
                             "n_tokens": total.astype(np.int64), "n_known": known.astype(np.int64),
                             "train_tokens": n_train, "base_score": base - total * np.log10(n_train + types + 1.0),
                             "score": score})

    kind = docs.schema[key].dataType.simpleString()
    return answers.filter(F.col("kind").isin(_HEAD, _RUNS, _FOLDED)).drop("bucket").groupBy("slice").cogroup(
        backed.groupBy("slice")).applyInPandas(
        gather, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
