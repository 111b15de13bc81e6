"""Secret scans with a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that every match must
contain. The corpus is indexed block by block, as search engines keep segments: a block's posting
list holds the documents of a trigram, only for trigrams that some rule asks for. A rule's query
intersects and unites postings, and the expression itself runs over the candidates alone. A rule
without a mandatory trigram runs over every document.

Blocks are record batches inside a task, so nothing is shuffled and memory is bounded by a block.

Defined cases: a null or empty text has no secrets; null and repeated doc_ids are scanned row by
row; equal spans of several kinds are all reported; a text of any length is scanned whole, a long one
as a block of its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import slices, texts_of
from tablewright.runtime import ship_package

try:  # the standard parser of regular expressions, under its name since Python 3.11
    from re import _constants as op
    from re import _parser as parser
except ImportError:
    import sre_constants as op
    import sre_parse as parser


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose group ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = re.ASCII


#: The three base rules, in the order of the contract.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further public credential formats that the index makes cheap.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |OPENSSH |DSA )?PRIVATE KEY-----"),
)

Query = tuple  # ("all",) | ("tri", "abc") | ("and", *queries) | ("or", *queries)
ALL: Query = ("all",)
MOST = 64  # strings in a set before it counts as anything


def both(*queries: Query) -> Query:
    own = tuple(dict.fromkeys(q for q in queries if q != ALL))
    return ALL if not own else own[0] if len(own) == 1 else ("and", *own)


def either(*queries: Query) -> Query:
    own = tuple(dict.fromkeys(queries))
    return ALL if ALL in own else own[0] if len(own) == 1 else ("or", *own)


def of_strings(strings: set[str]) -> Query:
    """One of the strings occurs: the trigrams of one of them do."""
    return either(*(both(*(("tri", s[i : i + 3]) for i in range(len(s) - 2))) if len(s) > 2 else ALL for s in sorted(strings))) if strings else ALL


def analyse(items) -> tuple[set[str] | None, Query]:
    """For a parsed sequence: the exact set of strings it can match (None: too many), and a query."""
    query, run, exact = ALL, {""}, True
    for kind, value in items:
        own, inner = element(kind, value)
        if own is not None and len(run) * len(own) <= MOST:
            run = {a + b for a, b in product(run, own)}
            continue
        query, exact = both(query, of_strings(run), inner if own is None else of_strings(own)), False
        run = own if own is not None else {""}
    return (run, ALL) if exact else (None, both(query, of_strings(run)))


def element(kind, value) -> tuple[set[str] | None, Query]:
    if kind is op.LITERAL:
        return ({chr(value).lower()}, ALL) if value < 128 else (None, ALL)
    if kind is op.SUBPATTERN:
        return analyse(value[-1])
    if kind is op.AT:
        return {""}, ALL
    if kind is op.BRANCH:
        found = [analyse(branch) for branch in value[1]]
        if all(own is not None for own, _ in found) and sum(len(own) for own, _ in found) <= MOST:
            return set().union(*(own for own, _ in found)), ALL
        return None, either(*(q if own is None else of_strings(own) for own, q in found))
    if kind is op.IN and all(k is op.LITERAL and v < 128 for k, v in value) and len(value) <= 16:
        return {chr(v).lower() for _, v in value}, ALL
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, body = value
        own, query = analyse(body)
        if own is not None and (least, most) == (0, 1):
            return {"", *own}, ALL
        return None, ALL if least == 0 else query if own is None else of_strings(own)
    return None, ALL


def trigram_query(rule: Rule) -> Query:
    """A query that every text with a match fulfils; trigrams are of lower-cased text."""
    own, query = analyse(parser.parse(rule.pattern, rule.flags))
    return query if own is None else of_strings(own)


def trigrams(query: Query) -> set[str]:
    return {query[1]} if query[0] == "tri" else set().union(*(trigrams(q) for q in query[1:])) if len(query) > 1 else set()


def evaluate(query: Query, postings: dict[str, np.ndarray], everything: np.ndarray) -> np.ndarray:
    if query[0] == "all":
        return everything
    if query[0] == "tri":
        return postings.get(query[1], everything[:0])
    found = [evaluate(q, postings, everything) for q in query[1:]]
    out = found[0]
    for other in found[1:]:
        out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
    return out


class BlockIndex:
    """The inverted index of a block of texts, over the trigrams that the rules ask for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(rule, re.compile(rule.pattern, rule.flags), trigram_query(rule)) for rule in rules]
        self.asked = sorted(set().union(*(trigrams(q) for *_, q in self.rules)))
        self.number = np.zeros(1 << 24, np.uint16)  # by trigram code: its number, 0 if not asked for
        for i, t in enumerate(self.asked):
            a, b, c = t.encode("ascii")
            self.number[a << 16 | b << 8 | c] = i + 1

    def postings(self, texts: list[str]) -> dict[str, np.ndarray]:
        """trigram -> ascending ordinals of the texts that hold it."""
        encoded = [t.encode("utf-8").lower() for t in texts]
        ends = np.cumsum([len(e) + 2 for e in encoded])
        flat = np.frombuffer(b"\0\0".join(encoded) + b"\0\0", np.uint8).astype(np.uint32)
        hit = self.number[flat[:-2] << 16 | flat[1:-1] << 8 | flat[2:]]
        at = np.flatnonzero(hit)
        entries = np.unique(hit[at].astype(np.int64) * len(texts) + np.searchsorted(ends, at, "right"))
        which, doc = entries // len(texts), entries % len(texts)
        cuts = np.flatnonzero(np.diff(which)) + 1
        return {self.asked[int(w[0]) - 1]: d for w, d in zip(np.split(which, cuts), np.split(doc, cuts), strict=True) if len(w)}

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its matches as (start, number of the rule, end), in that order."""
        out: list[list] = [[] for _ in texts]
        postings, everything = self.postings(texts), np.arange(len(texts))
        for k, (rule, pattern, query) in enumerate(self.rules):
            for i in evaluate(query, postings, everything):
                out[i] += [(m.start(), k, m.end()) for m in pattern.finditer(texts[i]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return [sorted(own) for own in out]


_indexes: dict[tuple, BlockIndex] = {}


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id and spans: kind, start, end (code points, end exclusive), by start and rule order."""
    ship_package(docs.sparkSession)

    def scanned(records):
        index = _indexes.setdefault(rules, None) or BlockIndex(rules)
        _indexes[rules] = index
        kinds = [r.kind for r in rules]
        for record in (part for r in records for part in slices(r)):
            found = index.spans(record.column("text").to_pylist())
            rows = [[{"kind": kinds[k], "start": a, "end": b} for a, k, b in own] for own in found]
            yield pa.RecordBatch.from_arrays([record.column("doc_id"), pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], names=["doc_id", "spans"])

    return texts_of(docs).mapInArrow(scanned, "doc_id long, spans array<struct<kind string, start long, end long>>")


def summary(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans, and all spans as text."""
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(r.kind) for r in BASE), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
