"""Vector best-fit packing of tokenized documents into fixed-length sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece
lengths).  Pieces go, longest first, to the open sequence that meets every capacity and scores
best: by the weighted norm of what would be left, or by the weighted dot product of
demand and what is left (smallest first, which is best fit for one dimension).

Tokens are made where the text is read; only (piece, length) rows are shuffled.  They are dealt by a
hash of their row into groups of bounded tokens and rows, so a group fits in memory at any size and
costs at most about one sequence over a packing of all pieces together.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, stage, text_slices
from .token_pieces import WordCache, encode_all, load

EOS = 1
#: Parts of texts that go to the library at once.
PARTS = 20_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence may hold, and how the dimensions weigh in the choice."""

    tokens: int = 4096
    documents: int = 4096
    attention: float = 4096.0**2
    weights: tuple[float, float, float] = (1.0, 0.25, 0.25)
    rule: str = "norm"


# How the vocabulary's file normalises and splits a text.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: ASCII and the Latin letters that NFC leaves alone and whose case is one to one.
PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ÿ]*")
#: ``SPLIT`` over lower-case plain characters.
PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")


class Encoder:
    """Ids of whole texts for vocabularies that drop white space and merge inside words.

    Texts of plain characters are split here by the vocabulary's own pattern, other texts word by word.
    The library merges each distinct part once and a table keeps its ids.  Texts with an added token, and all
    texts of a vocabulary with another pattern, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = load(path)
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        steps = [None if s is None else json.loads(s.__getstate__())
                 for s in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        self.known_pattern = steps == [NORMALIZER, SPLITTER]
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts = WordCache(self._merged)

    def _merged(self, parts: list[str]) -> list[bytes]:
        """Ids of plain parts from the merges alone, of other words from the whole library."""
        out: list[bytes] = [b""] * len(parts)
        plain = [PLAIN.fullmatch(p) is not None for p in parts]
        for tokenizer, of_kind in ((self.merges, True), (self.tokenizer, False)):
            at = [i for i, p in enumerate(plain) if p is of_kind]
            for lo in range(0, len(at), PARTS):
                some = at[lo:lo + PARTS]
                found = tokenizer.encode_batch_fast([parts[i] for i in some], add_special_tokens=False)
                for i, e in zip(some, found):
                    out[i] = array("I", e.ids).tobytes()
        return out

    def _split(self, text: str) -> list[str] | None:
        """The parts of a text, None where it has to go to the library whole."""
        lower = text.lower()
        # The last four split words in Python but not in the vocabulary's pattern.
        if not self.known_pattern or any(t in lower for t in (*self.added, "\x1c", "\x1d", "\x1e", "\x1f")):
            return None
        if PLAIN.fullmatch(text):
            return PLAIN_SPLIT.findall(lower)
        parts: list[str] = []
        for word in text.split():
            if PLAIN.fullmatch(word):
                parts += PLAIN_SPLIT.findall(word.lower())
            else:
                parts.append(word)
        return parts

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self._split(t) for t in texts]
        distinct: set[str] = set()
        for parts in split:
            distinct.update(parts or ())
        known = self.parts.learn(distinct)
        out = [b"".join(map(known.__getitem__, parts or ())) for parts in split]
        odd = [k for k, parts in enumerate(split) if parts is None]
        for k, ids in zip(odd, encode_all(self.tokenizer, [texts[k] for k in odd])):
            out[k] = np.array(ids, "<u4").tobytes()
        return out


def _encoder(path: str) -> Encoder:
    return kept(("ids", path), lambda: Encoder(path))


def pieces(docs: DataFrame, tokenizer: str, tokens: int, text: str = "text", key: str = "doc_id",
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece of at most ``tokens``."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    end = np.array([EOS], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            for part in text_slices(batch, "text", 2_000_000):
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for row, raw in enumerate(encoder.ids([t or "" for t in part.column("text").to_pylist()])):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), 4 * tokens)):
                        block = raw[at:at + 4 * tokens]
                        rows.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(block) // 4)
                        crc.append(zlib.crc32(block))
                        if with_ids:
                            ids.append(block)
                columns = [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                           pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * with_ids, names=names)

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece; equal lengths keep their order.

    A piece that breaks a capacity even alone has a sequence of its own.
    """
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    scale = np.array(capacity.weights, float) / full
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left, name, used = np.zeros((3, 64)), np.zeros(64, np.int64), np.zeros(64, np.int64)
    n_open, made = 0, 0
    order = np.argsort(-lengths, kind="stable")
    smallest = int(lengths[order[-1]]) if len(order) else 0
    need_least = np.array([smallest, 1.0, float(smallest) ** 2])
    for i in order:
        size = int(lengths[i])
        need = np.array([size, 1.0, float(size) ** 2])
        at = -1
        if n_open:
            rest = left[:, :n_open] - need[:, None]
            fits = np.flatnonzero((rest >= 0).all(0))
            if len(fits):
                if capacity.rule == "norm":
                    score = ((rest[:, fits] * scale[:, None]) ** 2).sum(0)
                else:
                    score = (left[:, fits] * (need / full * scale)[:, None]).sum(0)
                at = int(fits[np.argmin(score)])
        if at < 0:
            if n_open == left.shape[1]:
                left = np.concatenate([left, np.zeros_like(left)], 1)
                name, used = np.concatenate([name, name]), np.concatenate([used, used])
            at, n_open = n_open, n_open + 1
            left[:, at], name[at], used[at] = full, made, 0
            made += 1
        bins[i], offsets[i] = name[at], used[at]
        left[:, at] -= need
        used[at] += size
        if (left[:, at] < need_least).any():  # nothing that is to come fits
            n_open -= 1
            left[:, at], name[at], used[at] = left[:, n_open], name[n_open], used[n_open]
    return bins, offsets


def pack(pieces_: DataFrame, capacity: Capacity = Capacity(), group_sequences: int = 2000,
         group_rows: int = 100_000) -> DataFrame:
    """The pieces with sequence_id and offset.

    Groups are about ``group_sequences`` full sequences and at most about ``group_rows`` pieces.
    """
    rows = stage(pieces_.withColumn("piece_row", F.monotonically_increasing_id()), "pieces")
    total = rows.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    groups = max(1, -(-total["t"] // (capacity.tokens * group_sequences)), -(-total["n"] // group_rows))

    def place(key, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("piece_row")
        bins, offsets = best_fit(part["length"].to_numpy(), capacity)
        return pd.DataFrame({"piece_row": part["piece_row"].to_numpy(), "offset": offsets,
                             "sequence_id": (np.int64(key[0]) << 32) + bins})

    placed = (rows.select("piece_row", "length", F.pmod(F.xxhash64("piece_row"), F.lit(groups)).alias("pack_group"))
              .groupBy("pack_group").applyInPandas(place, "piece_row long, offset long, sequence_id long"))
    return rows.join(placed, "piece_row").drop("piece_row")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text is empty and gives one piece with the end id only.  Repeated rows and null ids
    are packed row by row; other columns are not read; an empty table gives an empty result.
    Texts of any length are encoded whole.
    """
    return pack(pieces(docs, tokenizer, capacity.tokens, text, key), capacity)
