"""Token counts by a map-side two-tier lookup, without shuffling a pre-token.

Tier one is a table of the most frequent pre-tokens and their token counts, of a fixed size
bound, broadcast. Tier two is each worker's bounded cache; what it misses is encoded by the
library. Pre-tokens start at a run of spaces or at a line feed, where no vocabulary piece reaches
across, so the counts add up to the library's count of the whole text.

Defined cases: a null or empty text has no tokens; null and repeated doc_ids are counted row by
row; a text of any length is counted whole; which of equally frequent pre-tokens are broadcast changes
no count; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import slices, texts_of
from tablewright.llm.pretokens import plain, vocabulary
from tablewright.runtime import ship_package

_PIECE = re.compile(r"\n| *[^ \n]+| +")
_SPACE = "▁"  # how the vocabulary writes a space; in a text it counts as one


def pieces(text: str) -> list[str]:
    """Words as they follow a space, line feeds with the word behind them, or pieces after a NUL."""
    text = text.replace(_SPACE, " ")
    if plain(text):
        return text.replace("\n", " \n").split(" ")
    return ["\0" + p for p in _PIECE.findall(" " + text)] if text else []


def written(key: str) -> str:
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else " " + key


class Lengths(dict):
    """pre-token -> number of tokens. ``fixed`` stays; the rest is dropped at ``limit`` entries."""

    def __init__(self, path: str, fixed: dict[str, int], limit: int = 300_000):
        import sentencepiece

        super().__init__(fixed)
        self.fixed, self.limit = fixed, limit
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if "\n" in piece or _SPACE in piece.lstrip(_SPACE):
                raise ValueError(f"the vocabulary joins across pre-tokens: {piece!r}")

    def lengths(self, some: list[str]) -> list[int]:
        # after a line feed the library adds no space of its own; both together are two tokens
        return [len(ids) - 2 for ids in self.model.encode(["\n" + written(p) for p in some], num_threads=1)]

    def count(self, texts: list[str]) -> list[int]:
        cut = [pieces(t) for t in texts]
        if len(self) > self.limit + len(self.fixed):
            self.clear()
            self.update(self.fixed)
        missing = [p for p in set().union(*cut) if p not in self]
        self.update(zip(missing, self.lengths(missing), strict=True))
        counts = [sum(map(self.__getitem__, own)) for own in cut]
        for long in [p for p in missing if len(p) > 64]:  # so the cache is bounded in bytes too
            del self[long]
        return counts


def pack(table: dict[str, int]) -> tuple[bytes, bytes, bytes]:
    """The table as one text blob and two integer arrays."""
    keys = [k.encode("utf-8", "surrogatepass") for k in table]
    return b"".join(keys), np.array([len(k) for k in keys], np.uint16).tobytes(), np.array(list(table.values()), np.uint16).tobytes()


def unpack(blob: bytes, sizes: bytes, counts: bytes) -> dict[str, int]:
    ends = np.cumsum(np.frombuffer(sizes, np.uint16), dtype=np.int64)
    return {blob[b - s : b].decode("utf-8", "surrogatepass"): int(n) for b, s, n in zip(ends, np.frombuffer(sizes, np.uint16), np.frombuffer(counts, np.uint16), strict=True)}


def frequent_pieces(docs: DataFrame, entries: int = 32_768, longest: int = 32, per_task: int = 2048, held: int = 200_000) -> list[str]:
    """The most frequent pre-tokens of the corpus.

    Each task counts all its texts, keeping the ``held`` most frequent pre-tokens at any time, and
    sends ``per_task`` rows; only those are added up. The list is a matter of speed: a frequent
    pre-token that is left out is found by the second tier.
    """

    def counts(records):
        found: Counter = Counter()
        for record in (part for r in records for part in slices(r)):
            for text in record.column("text").to_pylist():
                found.update(pieces(text))
            if len(found) > 2 * held:
                found = Counter(dict(found.most_common(held)))
        top = [(p, n) for p, n in found.most_common(per_task) if len(p) <= longest and n > 1]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    summed = docs.select("text").mapInArrow(counts, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return [row.piece for row in summed.orderBy(F.desc("n"), "piece").limit(entries).collect()]


_loaded: dict[tuple, Lengths] = {}


def count_tokens(docs: DataFrame, vocab: str = "piece_bpe_32k.model", limit: int = 4096, entries: int = 32_768) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    spark, docs = docs.sparkSession, texts_of(docs)
    ship_package(spark)
    frequent = frequent_pieces(docs, entries)
    table = pack(dict(zip(frequent, Lengths(vocabulary(vocab), {}).lengths(frequent), strict=True)))
    sent = spark.sparkContext.broadcast(table)

    def counted(records):
        key = (vocab, sent._jbroadcast.id() if getattr(sent, "_jbroadcast", None) else id(sent.value))
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = Lengths(vocabulary(vocab), unpack(*sent.value))
        for record in (part for r in records for part in slices(r)):
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), pa.array(_loaded[key].count(record.column("text").to_pylist()), pa.int64()), record.column("n_bytes")], names=["doc_id", "n_tokens", "n_bytes"])

    sized = docs.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    counted_rows = sized.mapInArrow(counted, "doc_id long, n_tokens long, n_bytes long")
    return counted_rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
