"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, text_slices
from .token_pieces import WordCache, encode_all, is_plain, load, safe_parts

#: Texts beyond this many characters are encoded in parts.
PART_CHARS = 65_536


class Counter:
    """Counts ids as the library does, for byte-level vocabularies with the usual word pattern.

    In a plain text each word takes the blank before it and a line end stands alone, so the count is a
    sum over words.  A special string can only be met inside one word, since it has no blank.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.inner = WordCache(lambda ws: self._lengths([" " + w for w in ws]))
        self.first = WordCache(self._lengths)
        self.line_end = self._lengths(["a\na"])[0] - 2 * self._lengths(["a"])[0]

    def _lengths(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in encode_all(self.tokenizer, texts)]

    def counts(self, texts: list[str]) -> list[int]:
        out, odd, plain = [0] * len(texts), [], []
        inner: set[str] = set()
        first: set[str] = set()
        for i, text in enumerate(texts):
            if not text:
                continue
            if not is_plain(text, text.split()):
                odd.append(i)
                continue
            lines = [line.split(" ") for line in text.split("\n")]
            for line in lines:
                first.add(line[0])
                inner.update(line[1:])
            plain.append((i, lines))
        inner_of, first_of = self.inner.learn(inner), self.first.learn(first)
        for i, lines in plain:
            n = (len(lines) - 1) * self.line_end
            for line in lines:
                n += first_of[line[0]] + sum(map(inner_of.__getitem__, line[1:]))
            out[i] = n
        parts = [(i, p) for i in odd for p in safe_parts(texts[i], PART_CHARS)]
        for (i, _), n in zip(parts, self._lengths([p for _, p in parts])):
            out[i] += n
        return out


def _counter(path: str) -> Counter:
    return kept(("counts", path), lambda: Counter(path))


def token_counts(docs: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id",
                 limit: int = 1024) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Null counts as the empty text, which has no tokens.  Special strings inside a text are
    handled as the library does by default; nothing is added, cut or padded.  Repeated
    rows and null ids are counted row by row; other columns are not read; an empty table
    gives an empty result.  ``tokenizer`` is a byte-level file that every executor can open.
    """
    kind = docs.schema[key].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in batches:
            for part in text_slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                n = pa.array(counter.counts(texts), pa.int64())
                size = pc.cast(pc.binary_length(
                    pc.fill_null(part.column("text"), "")), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size, n, pc.greater(n, limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
