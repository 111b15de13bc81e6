"""Repeated passages by collinear chaining of shared k-mer seeds.

Equal texts collapse into one before anything else; their copies are a passage from end to end.
Seeds are hashes of eight consecutive words, thinned by winnowing: of any fifteen words in a row
that two documents share, they share a seed. A twice-seen Bloom filter keeps seeds of a single
document from being shuffled. The holders of a seed are compared with each other where they are
``MEET`` at most, and otherwise with its first and last holder, so a passage that a million
documents hold costs two million rows, not pairs. Between
two documents, seeds on one diagonal merge into fragments, fragments are chained with gap costs
through a Fenwick tree of prefix maxima, and chains with gaps or close to the limit are aligned on
the words in their gaps and around their ends.

Exact passages do not depend on who holds their parts: every run of the shortest length whose seeds
are all suspect is a key of its own, at every position, met by its first and last holder. A chain
of one long fragment without a gap is such a passage and gets its ends from the runs.

Edited passages do not depend on it either: two frequent seeds ``NEAR`` to ``FAR`` words apart are a
key too, and who holds a short part of a passage has no such key of it. Holders of a key who have the
same words between its seeds share a run there, not an edit; the others are compared in growing
numbers: who holds a key where no passage found has it meets some of its other holders, then
``WIDER`` times as many, and in the end every other one.

Defined cases: a null or empty text, or one below eight words, has no seeds; rows that share a
doc_id are one document, and repeats inside one document are no finding, but each copy of what
another document holds is; null doc_ids are left out; equal chains are ordered by position; a very
long text is looked at whole, in one task, in memory that follows its length; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm import bloom
from tablewright.llm.common import BLANKS, RATIO, mixed, slices, stored, texts_of, window_hashes
from tablewright.runtime import ship_package

K, WINNOW = 8, 8
#: RATIO's inverse modulo 2^64.
INVERSE = np.uint64(pow(int(RATIO), -1, 1 << 64))
GAP_COST = 0.5  # for each word of a gap on either side
AROUND = 64  # words around a chain over which its ends may grow
SLACK = 2 * (WINNOW - 1)  # words around a chain's seeds that may be equal without a seed
#: Words between the starts of the two seeds of a pair key: from what a chain must span up to what the
#: gap costs let it leave out behind fewer words.
NEAR, FAR = 28, 72
#: A seed or a pair key with more holders than these is a frequent one.
MEET = 8
#: By how much the number of holders grows that a key in no passage is compared with.
WIDER = 8
#: A coefficient for each byte, one for both cases of a letter and 0 for blanks.
LETTERS = mixed(np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint64) * RATIO + RATIO) | np.uint64(1)
LETTERS[list(BLANKS.encode())] = 0
#: Bytes of which words are hashed at once.
AT_ONCE = 1 << 18


def powers(n: int, held: list = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """The first ``n`` powers of RATIO and of INVERSE; up to ``AT_ONCE`` of them are kept."""
    if n > AT_ONCE:
        return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, r, np.uint64))]) for r in (RATIO, INVERSE))
    if not held:
        held += (np.concatenate([[np.uint64(1)], np.cumprod(np.full(AT_ONCE - 1, r, np.uint64))]) for r in (RATIO, INVERSE))
    return held[0][:n], held[1][:n]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, in lower case, of texts that lie one after another in the bytes ``data``, and
    where each text's words begin and end among them; ``bounds``: the same for its bytes."""
    out, places, start = [], [], 0
    while start < len(data):
        stop = min(len(data), start + AT_ONCE)
        while stop < len(data) and LETTERS[data[stop]] and LETTERS[data[stop - 1]]:  # within a word
            blanks = np.flatnonzero(LETTERS[data[stop : stop + AT_ONCE]] == 0)
            stop = stop + int(blanks[0]) if len(blanks) else min(len(data), stop + AT_ONCE)
        letters = LETTERS[data[start:stop]]
        inside = letters != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        firsts = bounds[np.searchsorted(bounds, start) : np.searchsorted(bounds, stop)] - start
        begins[firsts] = inside[firsts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | begins[1:]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends)
        up, down = powers(stop - start)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * up)])
        out.append(mixed((sums[last + 1] - sums[first]) * down[first]))
        places.append(first + start)
        start = stop
    if not out:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    return np.concatenate(out), np.searchsorted(np.concatenate(places), bounds)


def words_in(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes() of an array of texts."""
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32 if texts.type in (pa.string(), pa.binary()) else np.int64)[texts.offset :][: n + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return word_hashes(held, bounds - bounds[0])


class _words:
    @staticmethod
    def of(words: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b" ".join(words), np.uint8)
        return word_hashes(data, np.array([0, len(data)]))[0]


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().split()


def seeds_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seed hashes and positions of a text's word hashes, ascending; a hash may stand at several positions."""
    if len(words) < K:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    windows = window_hashes(words, K)
    if len(windows) <= WINNOW:
        at = np.array([windows.argmin()])
    else:
        view = np.lib.stride_tricks.sliding_window_view(windows, WINNOW)
        at = np.unique(view.argmin(axis=1) + np.arange(len(view)))
    return windows[at], at


def seeds_in(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """seeds_of() of many texts at once: hashes and positions among the ``words`` of all of them, ascending;
    ``bounds``: where each text begins and ends there."""
    if len(words) < K:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    windows = window_hashes(words, K)
    begin, count = bounds[:-1], np.diff(bounds) - K + 1  # windows of each text
    least, at, width = windows, np.arange(len(windows)), 1
    while width < WINNOW:  # the leftmost of the smallest among twice as many windows
        step = min(width, WINNOW - width)
        right = least[step:] < least[:-step]
        least, at = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step])
        width += step
    n = np.maximum(0, count - WINNOW + 1)  # runs of windows in each text
    at = at[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())]
    at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
    short = np.flatnonzero((count > 0) & (count < WINNOW))
    few = [b + int(windows[b : b + c].argmin()) for b, c in zip(begin[short].tolist(), count[short].tolist(), strict=True)]
    at = np.sort(np.concatenate([at, np.array(few, np.int64)])) if few else at
    return windows[at], at


def seeds(text: str) -> tuple[np.ndarray, np.ndarray]:
    return seeds_of(_words.of(words_of(text)))


def prefix_sums(words: np.ndarray) -> np.ndarray:
    """Polynomials of the words before each position: their differences tell runs of any width apart."""
    powers = np.cumprod(np.full(len(words), RATIO, np.uint64))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])


def runs_of(words: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words, by prefix sums (any width costs the same)."""
    sums = prefix_sums(words)
    back = np.cumprod(np.full(len(words), INVERSE, np.uint64))
    return mixed((sums[width:] - sums[:-width]) * back[: len(words) - width + 1])


def suspect_runs(words: np.ndarray, at: np.ndarray, known: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the runs of ``width`` words that another text can hold: all seeds in
    them that do not depend on the words around them are ``known`` ones; ``at``: where seeds are."""
    if len(words) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lone = np.zeros(len(words) + 1, np.int64)
    if width >= K + WINNOW - 1:
        lone[at[~known] + 1] = 1
    lone = np.cumsum(lone)
    start = np.arange(len(words) - width + 1)
    low, high = start + WINNOW - 1, np.maximum(start + WINNOW - 1, start + width - K - WINNOW + 2)
    high = np.minimum(high, len(words))
    start = start[lone[high] - lone[np.minimum(low, high)] == 0]
    return (runs_of(words, width)[start], start) if len(start) else (np.zeros(0, np.uint64), start)


class PrefixMax:
    """A Fenwick tree: the largest (value, payload) among positions up to one."""

    def __init__(self, n: int):
        self.tree: list = [(float("-inf"), -1)] * (n + 1)

    def put(self, i: int, item: tuple[float, int]) -> None:
        i += 1
        while i < len(self.tree):
            if item > self.tree[i]:
                self.tree[i] = item
            i += i & -i

    def best(self, i: int) -> tuple[float, int]:
        """Over positions 0 .. i."""
        i, out = i + 1, (float("-inf"), -1)
        while i > 0:
            out = max(out, self.tree[i])
            i -= i & -i
        return out


def fragments(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Seeds (x, y) ascending in x, merged where they touch on one diagonal: (x, y, words)."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    new = np.flatnonzero((np.diff(x - y) != 0) | (np.diff(x) > K)) + 1
    first, last = np.concatenate([[0], new]), np.concatenate([new, [len(x)]]) - 1
    return sorted(zip(x[first].tolist(), y[first].tolist(), (x[last] - x[first] + K).tolist(), strict=True))


def chains(parts: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Disjoint collinear chains of fragments, the best ones first.

    A chain's score is its words less GAP_COST for each word between fragments on either side;
    a predecessor's best score is looked up by a Fenwick tree over the second document's ends.
    """
    if len(parts) == 1:
        return [parts]
    ends = sorted({y + n for _, y, n in parts})
    rank = {e: i for i, e in enumerate(ends)}
    tree, score, before = PrefixMax(len(ends)), [0.0] * len(parts), [-1] * len(parts)
    waiting = sorted(range(len(parts)), key=lambda i: parts[i][0] + parts[i][2])  # by end in the first document
    done = 0
    for i, (x, y, n) in enumerate(parts):  # by start in the first document
        while done < len(parts) and parts[waiting[done]][0] + parts[waiting[done]][2] <= x + K and waiting[done] < i:
            j = waiting[done]
            a, b, m = parts[j]
            tree.put(rank[b + m], (score[j] + GAP_COST * (a + m + b + m), j))
            done += 1
        k = bisect_right(ends, y + K - 1) - 1  # fragments may overlap by less than a seed
        value, j = tree.best(k) if k >= 0 else (float("-inf"), -1)
        gain = value - GAP_COST * (x + y)
        score[i], before[i] = (n + gain, j) if gain > 0 and j >= 0 and parts[j][1] < y else (float(n), -1)
    out, used = [], set()
    for i in sorted(range(len(parts)), key=lambda i: (-score[i], i)):
        own = []
        while i >= 0 and i not in used:
            used.add(i)
            own.append(parts[i])
            i = before[i]
        if own:
            out.append(own[::-1])
    return out


def matched_in_gap(a: list, b: list) -> int:
    """Words that an alignment of the two gaps matches: their longest common subsequence, a bit for
    each word of ``b``, so that a word of ``a`` costs a few operations on one large integer."""
    if a == b:
        return len(a)
    places: dict = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    free = every = (1 << len(b)) - 1
    for x in a:
        taken = free & places.get(x, 0)
        free = ((free + taken) | (free - taken)) & every
    return len(b) - free.bit_count()


def gaps_of(words: list, ends: list[tuple[int, int]]) -> list[list]:
    """The words before, between and after fragments (start, end): ``AROUND`` before and after."""
    bounds = [(ends[0][0] - AROUND, ends[0][0]), *((e, s) for (_, e), (s, _) in zip(ends, ends[1:], strict=False)), (ends[-1][1], ends[-1][1] + AROUND)]
    return [words[max(0, a) : max(0, b)] for a, b in bounds]


def align(own: list[list], other: list[list], chain: list[tuple[int, int, int]]) -> tuple[int, int, int, int, int]:
    """The aligned passage (start, end, other's start, other's end, matched words) of a chain, from
    both documents' gaps_of(): outer ends grow over equal words, gaps between fragments are aligned."""

    def equal(a: list, b: list) -> int:
        return next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

    before, after = equal(own[0][::-1], other[0][::-1]), equal(own[-1], other[-1])
    x, y, _ = chain[0]
    matched, i, j = before, x, y
    for k, (a, b, n) in enumerate(chain):
        if k and (a > i or b > j):
            matched += matched_in_gap(own[k], other[k])
        matched += max(0, n - max(0, i - a, j - b))
        i, j = max(i, a + n), max(j, b + n)
    return x - before, i + after, y - before, j + after, matched + after


def by_document(records, key: str):
    """Batches of rows ordered by ``key`` as tables that hold all rows of their documents. Their further order is
    left to numpy, as Spark sorts by one number fastest."""
    held = None
    for record in records:
        table = pa.Table.from_batches([record]) if held is None else pa.concat_tables([held, pa.Table.from_batches([record])])
        ids = table.column(key).to_numpy()
        cut = int(np.searchsorted(ids, ids[-1])) if len(ids) else 0
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held


def lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Where each list of an array of lists begins and ends, and the values of all of them."""
    return column.offsets.to_numpy(), column.values.to_numpy()


def as_lists(arrays: list, kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    none = np.zeros(0, kind.to_pandas_dtype())  # of the same type, as a float has no 64 bits
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, none]).astype(none.dtype), kind))


CHAIN = "doc_id long, ref long, sure boolean, start long, end long, ref_start long, ref_end long, parts array<long>"


PASSAGE = ["doc_id", "ref", "start", "end", "ref_start", "ref_end"]


def can_reach(y: np.ndarray, width: int) -> bool:
    """Whether a chain of seeds at ``y`` in the second document can span ``width`` words of the first.

    Its fragments have up to K words for each of the m places that it uses, and half its gaps on both sides
    are less than the words before its last fragment. So it spans less than 32 m - 16 words,
    and less by as many as lie from its first place to the end of its last one.
    """
    y = np.unique(y)
    room = y - 4 * K * np.arange(len(y))
    return bool((room - np.maximum.accumulate(room)).min() < 4 * K - 3 * K - width)


def chains_of(doc: int, ref: int, x: np.ndarray, y: np.ndarray, least: int) -> list[tuple]:
    """CHAIN rows of two documents from the places of their seeds."""
    rows: list[tuple] = []
    if len(x) > 1 and not can_reach(y, least - SLACK):
        return rows
    for own in chains(fragments(x, y)):
        start, end = own[0][0], own[-1][0] + own[-1][2]
        if end - start + SLACK >= least:
            sure = len(own) == 1 and end - start >= least
            rows.append((doc, ref, sure, start, end, own[0][1], own[-1][1] + own[-1][2], [] if sure else [v for p in own for v in p]))
    return rows


def chain_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["doc_id", "ref", "sure", "start", "end", "ref_start", "ref_end", "parts"])


def chained(pairs: DataFrame, least: int) -> DataFrame:
    """CHAIN rows for pairs (doc_id, pos, ref, ref_pos): chains that can reach ``least`` words."""

    def chain_all(records):
        for table in by_document(records, "doc_id"):
            doc, ref, x, y = (table.column(c).to_numpy() for c in ("doc_id", "ref", "pos", "ref_pos"))
            order = np.lexsort((x, ref, doc))
            doc, ref, x, y = (c[order] for c in (doc, ref, x, y))
            cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(ref) != 0)) + 1
            low, high = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(doc)]])
            wide = x[high - 1] - x[low] + K + SLACK >= least
            rows = [r for a, b in zip(low[wide].tolist(), high[wide].tolist(), strict=True) for r in chains_of(int(doc[a]), int(ref[a]), x[a:b], y[a:b], least)]
            yield chain_rows(rows)

    return pairs.select("doc_id", "ref", "pos", "ref_pos").repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(chain_all, CHAIN)


def chained_pairs(pairs: DataFrame, held: DataFrame, least: int) -> DataFrame:
    """CHAIN rows of pairs (doc_id, ref) from all seeds that both have; ``held``: (doc_id, hash, pos), the
    lists of a text's seeds. Of a seed's places in ref the first and the last one count."""

    def chain_all(records):
        for record in records:
            docs, refs = (record.column(c).to_pylist() for c in ("doc_id", "ref"))
            (at, hashes), (_, places), (there, others), (_, their) = (lists(record.column(c)) for c in ("hash", "pos", "ref_hash", "ref_at"))
            rows, before = [], None
            for k, (doc, ref) in enumerate(zip(docs, refs, strict=True)):
                a, b = there[k], there[k + 1]
                if before is None or ref != refs[k - 1] or b - a != before or not np.array_equal(others[a:b], others[there[k - 1] : a]):
                    order = np.lexsort((their[a:b], others[a:b]))
                    known, place = others[a:b][order], their[a:b][order]
                    new = np.concatenate([[True], known[1:] != known[:-1]])
                    known, low, high = known[new], place[new], place[np.concatenate([new[1:], [True]])]
                before = b - a
                own, x = hashes[at[k] : at[k + 1]], places[at[k] : at[k + 1]]
                i = np.minimum(np.searchsorted(known, own), len(known) - 1)
                same = known[i] == own
                i, x = i[same], x[same]
                if len(x) and x[-1] - x[0] + K + SLACK >= least:
                    twice = low[i] != high[i]
                    rows += chains_of(doc, ref, np.concatenate([x, x[twice]]).astype(np.int64), np.concatenate([low[i], high[i][twice]]).astype(np.int64), least)
            yield chain_rows(rows)

    needed = stored(pairs.select("doc_id").union(pairs.select("ref")).distinct(), "passage-needed")
    held = held.join(listed(needed), "doc_id", "left_semi").select("doc_id", "hash", "pos")
    theirs = held.select(F.col("doc_id").alias("ref"), F.col("hash").alias("ref_hash"), F.col("pos").alias("ref_at"))
    return pairs.join(held, "doc_id").join(theirs, "ref").select("doc_id", "ref", "hash", "pos", "ref_hash", "ref_at").mapInArrow(chain_all, CHAIN)


def listed(ids: DataFrame, most: int = 2_000_000) -> DataFrame:
    """A narrow table, to be broadcast if it has ``most`` rows at most (some 100 MB), else shuffled."""
    return F.broadcast(ids) if ids.count() <= most else ids


def with_texts(rows: DataFrame, text: DataFrame, key: str, together: int = 128) -> DataFrame:
    """(key, text, rows): each text with about ``together`` of its rows at most, so a document of
    many rows is dealt out, and its text goes to Python once for so many of them."""
    counts = stored(rows.groupBy(key).agg(F.count("*").alias("held")), "passage-counts")
    needed = text.join(listed(counts.select(F.col(key).alias("doc_id"))), "doc_id", "left_semi").withColumnRenamed("doc_id", key)
    salt = F.pmod(F.xxhash64(*(c for c in rows.columns if c in PASSAGE)), F.expr(f"1 + held div {together}"))
    packed = rows.join(counts, key).groupBy(key, salt.alias("salt")).agg(F.collect_list(F.struct(*(c for c in rows.columns if c != key))).alias("rows"))
    return packed.join(needed, key).select(key, "text", "rows")


def aligned(found: DataFrame, text: DataFrame, least: int, identity: float) -> DataFrame:
    """The passages (doc_id, ref, start, end, ref_start, ref_end) of chains, aligned on the words in
    their gaps: first cut out of the one text, then compared with the other."""

    def rows_of(record, *names):
        """For each text: its key, its words, and of each of its rows the other document and lists ``names``."""
        hashes, ends = words_in(record.column(1))
        hashes, packed = hashes.view(np.int64), record.column(2)
        at, rows = packed.offsets.to_numpy(), packed.values
        others, columns = rows.field(0).to_numpy(), [lists(rows.field(name)) for name in names]
        for k, key in enumerate(record.column(0).to_pylist()):
            words = hashes[ends[k] : ends[k + 1]]
            yield key, words, [(int(others[i]), *(values[low[i] : low[i + 1]] for low, values in columns)) for i in range(at[k], at[k + 1])]

    def parts_of(flat: np.ndarray) -> list[tuple]:
        held = flat.tolist()
        return list(zip(held[::3], held[1::3], held[2::3], strict=True))

    def cut(records):
        for record in (part for r in records for part in slices(r, 50_000)):  # few rows as Python lists at once
            out: list[tuple] = []
            for doc, words, rows in rows_of(record, "parts"):
                # another row with this doc_id may be too short
                out += [(doc, ref, flat, np.concatenate(gaps_of(words, [(a, a + n) for a, _, n in parts_of(flat)]))) for ref, flat in rows if flat[-3] + flat[-1] <= len(words)]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)), *(as_lists([r[i] for r in out], pa.int64()) for i in (2, 3))], names=["doc_id", "ref", "parts", "gaps"])

    def align_all(records):
        for record in (part for r in records for part in slices(r, 50_000)):
            out = []
            for ref, words, rows in rows_of(record, "parts", "gaps"):
                for doc, flat, gaps in rows:
                    parts = parts_of(flat)
                    if parts[-1][1] + parts[-1][2] > len(words):
                        continue
                    ends = [(a, a + n) for a, _, n in parts]
                    cuts = np.cumsum([min(AROUND, ends[0][0]), *(max(0, s - e) for (_, e), (s, _) in zip(ends, ends[1:], strict=False))])
                    own, other = ([g.tolist() for g in held] for held in (np.split(gaps, cuts), gaps_of(words, [(y, y + n) for _, y, n in parts])))
                    start, end, a, b, matched = align(own, other, parts)
                    if end - start >= least and matched >= identity * max(end - start, b - a):
                        out.append((doc, ref, start, end, a, b))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(6)], names=PASSAGE)

    own = with_texts(found.select("doc_id", "ref", "parts"), text, "doc_id").mapInArrow(cut, "doc_id long, ref long, parts array<long>, gaps array<long>")
    both = with_texts(stored(own, "passage-gaps"), text, "ref")
    return both.mapInArrow(align_all, ", ".join(f"{c} long" for c in PASSAGE))


def twice_seen(text: DataFrame, max_filter_bits: int):
    """The broadcast filter of the seeds that more than one of the rows (doc_id, text) holds."""
    spark = text.sparkSession
    size = text.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = bloom.bits_for(size // 30, 8, max_filter_bits)

    def seen(records):
        filters = bloom.Seen(bits)
        for record in (part for r in records for part in slices(r)):
            words, bounds = words_in(record.column("text"))
            hashes, at = seeds_in(words, bounds)
            rows = np.searchsorted(bounds, at, "right")
            order = np.lexsort((rows, hashes))
            hashes, rows = hashes[order], rows[order]
            filters.add(hashes[np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])])[: len(hashes)]])  # a text counts once
        yield filters.record(TaskContext.get().partitionId())

    return spark.sparkContext.broadcast(bloom.merge(text.select("text").mapInArrow(seen, bloom.ROWS), bits))


def suspects(text: DataFrame, twice, least: int) -> DataFrame:
    """(doc_id, hash, pos, before, run, since): for each text with any the lists of its seeds in the filter,
    of their positions and prefix_sums(), and of the runs of ``least`` words whose seeds are all in it
    and where they begin."""

    def found(records):
        for record in (part for r in records for part in slices(r)):
            every, bounds = words_in(record.column("text"))
            seeds, places = seeds_in(every, bounds)
            known = bloom.holds(twice.value, seeds) if len(seeds) else np.zeros(0, bool)
            since = np.searchsorted(places, bounds)
            own: list[tuple] = []
            for k, doc in enumerate(record.column("doc_id").to_pylist()):
                hit = known[since[k] : since[k + 1]]
                if hit.any():
                    words, at = every[bounds[k] : bounds[k + 1]], places[since[k] : since[k + 1]] - bounds[k]
                    runs, start = suspect_runs(words, at, hit, least)
                    own.append((doc, seeds[since[k] : since[k + 1]][hit].view(np.int64), at[hit], prefix_sums(words)[at[hit]].view(np.int64), runs.view(np.int64), start))
            if own:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in own], pa.int64()), *(as_lists([o[i + 1] for o in own], t) for i, t in enumerate(kinds))], names=["doc_id", "hash", "pos", "before", "run", "since"])

    return stored(text.mapInArrow(found, "doc_id long, hash array<long>, pos array<int>, before array<long>, run array<long>, since array<int>"), "passage-suspects")


def exact_passages(runs: DataFrame, least: int) -> DataFrame:
    """(doc_id, start, end, ref, inner): words start .. end - 1 of doc_id are in runs (hash, doc_id,
    pos) of ``least`` words that ref, the first or last holder, has too; inner: doc_id is neither of
    them, and any ``least`` words of the span are a run. No pair is chosen beforehand, so none is
    missed."""
    ends = runs.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    hits = runs.join(stored(ends, "passage-run-ends"), "hash")
    hits = hits.select("doc_id", F.when(F.col("doc_id") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias("ref"), F.expr("doc_id <> first and doc_id <> last").alias("inner"), "pos")

    def joined(records):
        for table in by_document(records, "doc_id"):
            doc, ref, pos = (table.column(c).to_numpy() for c in ("doc_id", "ref", "pos"))
            inner = table.column("inner").to_numpy()
            order = np.lexsort((pos, inner, ref, doc))
            doc, ref, pos, inner = (c[order] for c in (doc, ref, pos, inner))
            new = np.flatnonzero((np.diff(doc) != 0) | (np.diff(ref) != 0) | (inner[1:] != inner[:-1]) | (np.diff(pos) > 1)) + 1
            first, last = np.concatenate([[0], new]), np.concatenate([new, [len(doc)]]) - 1
            columns = [pa.array(c.astype(np.int64)) for c in (doc[first], pos[first], pos[last] + least, ref[first])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(inner[first].astype(bool))], names=["doc_id", "start", "end", "ref", "inner"])

    return hits.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(joined, "doc_id long, start long, end long, ref long, inner boolean")


def first_of_each(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by ``columns`` (the last counts most), and which of them in that order are the first with their last two."""
    order = np.lexsort(columns)
    doc, key = columns[-1][order], columns[-2][order]
    return order, np.concatenate([[True], (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])])[: len(order)]


KEYS = {"key": pa.int64(), "doc_id": pa.int64(), "pos": pa.int32(), "far": pa.int32(), "low": pa.int64(), "high": pa.int64(), "lead": pa.bool_()}


def pair_keys(hot: DataFrame, inner: DataFrame) -> DataFrame:
    """KEYS (key, doc_id, pos, far, low, high, lead): two seeds NEAR to FAR words apart in a document, one
    of which meets other documents only (middle), from frequent seeds (hash, doc_id, pos, before, middle);
    low and high: the least and largest hash of the words from one to the other, over all places of
    the key in the document. Of its places those within another one are left out, as a span that
    holds the wider one holds them; one row has ``lead``. Pairs within a span (doc_id, start, end)
    of ``inner`` are left to the first holder of the same words."""

    def paired(records):
        for table in by_document(records, "doc_id"):
            doc, pos, end, hashes, before, middle = (table.column(c).to_numpy() for c in ("doc_id", "pos", "end", "hash", "before", "middle"))
            order = np.lexsort((pos, doc))
            doc, pos, end, hashes, before, middle = (c[order] for c in (doc, pos, end, hashes, before, middle))
            place = np.cumsum(np.concatenate([[0], np.diff(doc) != 0])).astype(np.int64) << 40  # documents lie far apart
            span, seed = np.flatnonzero(end > 0), np.flatnonzero(end == 0)
            at = place[seed] + pos[seed]
            since, until = place[span] + pos[span], np.maximum.accumulate(place[span] + end[span])
            low, high = np.searchsorted(at, at + NEAR), np.searchsorted(at, at + FAR, "right")
            total = np.cumsum(high - low)
            cuts = np.searchsorted(total, np.arange(1, total[-1] // 1_000_000 + 1) * 1_000_000) if len(total) else []
            cuts = sorted({0, len(at), *np.searchsorted(place[seed], place[seed][np.minimum(cuts, len(at) - 1)]).tolist()}) if len(at) else [0]
            for one, next_one in zip(cuts, cuts[1:], strict=False):  # whole documents, of about a million pairs
                n = (high - low)[one:next_one]
                i = np.repeat(np.arange(one, next_one), n)
                j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + low[i]
                within = np.searchsorted(since, at[i], "right") - 1
                covered = (within >= 0) & (until[within] >= at[j] + K) if len(span) else np.zeros(len(i), bool)
                i, j = (seed[k[~covered]] for k in (i, j))
                wanted = (middle[i] | middle[j]).astype(bool)
                i, j = i[wanted], j[wanted]
                if not len(i):
                    continue
                keys = mixed(mixed(hashes[i].view(np.uint64)) * RATIO + hashes[j].view(np.uint64)).view(np.int64)
                between = mixed((before[j].view(np.uint64) - before[i].view(np.uint64)) * np.power(INVERSE, pos[i].astype(np.uint64))).view(np.int64)
                order, first = first_of_each(-pos[j], pos[i], keys, doc[i])
                group, begin = np.cumsum(first) - 1, np.flatnonzero(first)
                least, most = np.minimum.reduceat(between[order], begin), np.maximum.reduceat(between[order], begin)
                reach = (group.astype(np.int64) << 32) + pos[j][order]
                widest = np.concatenate([[True], reach[1:] > np.maximum.accumulate(reach)[:-1]])
                kept = order[widest]
                columns = (keys[kept], doc[i][kept], pos[i][kept], pos[j][kept], least[group[widest]], most[group[widest]], first[widest])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, KEYS.values(), strict=True)], names=list(KEYS))

    none, zero = F.lit(0).cast("int"), F.lit(0).cast("long")
    rows = hot.select("doc_id", F.col("pos").cast("int").alias("pos"), none.alias("end"), "hash", "before", F.col("middle").cast("int").alias("middle"))
    rows = rows.union(inner.select("doc_id", F.col("start").cast("int"), F.col("end").cast("int"), zero, zero, none))
    return rows.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(paired, "key long, doc_id long, pos int, far int, low long, high long, lead boolean")


def outside(keys: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows of KEYS and held whose words are in no span (doc_id, start, end); one of a key has ``lead``."""
    names = [*KEYS, "held"]

    def kept(records):
        for table in by_document(records, "doc_id"):
            doc, pos, end = (table.column(c).to_numpy() for c in ("doc_id", "pos", "end"))
            table = table.take(pa.array(np.lexsort((-end, pos, doc))))
            doc, pos, far, end = (table.column(c).to_numpy() for c in ("doc_id", "pos", "far", "end"))
            place = np.cumsum(np.concatenate([[0], np.diff(doc) != 0])).astype(np.int64) << 40  # documents lie far apart
            reach = np.maximum.accumulate(np.where(end > 0, place + end, 0))  # of the spans that start before
            table = table.filter(pa.array((end == 0) & (reach < place + far + K)))
            order, first = first_of_each(table.column("key").to_numpy(), table.column("doc_id").to_numpy())
            table = table.take(pa.array(order))
            yield from table.set_column(table.schema.get_field_index("lead"), "lead", pa.array(first)).select(names).to_batches()

    none, zero = F.lit(0).cast("int"), F.lit(0).cast("long")
    rows = keys.select(*names, none.alias("end"))
    rows = rows.union(spans.select(zero, "doc_id", F.col("start").cast("int"), none, zero, zero, F.lit(False), zero, F.col("end").cast("int")))
    return rows.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(kept, "key long, doc_id long, pos int, far int, low long, high long, lead boolean, held long")


#: Holders of a key in a list, about.
TOGETHER = 1024


def meeting(left: DataFrame, holders: DataFrame, width: int) -> DataFrame:
    """Pairs (doc_id, ref) of a holder of a key in ``left`` and those among ``holders`` that are dealt into one
    bucket of about ``width`` with it and don't have just the same words between the key's seeds."""

    def bucket(width: int):
        """Documents in one order for all keys, dealt into 2^n buckets of a key, of about ``width`` holders at most."""
        split = F.greatest(F.lit(0), F.ceil(F.log2(F.col("held") / width))).cast("int")
        return F.call_function("shiftright", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)), 40 - split)

    def met(records):
        for table in by_document(records, "doc_id"):
            for record in table.combine_chunks().to_batches():
                doc, low, high = (record.column(c).to_numpy() for c in ("doc_id", "low", "high"))
                packed = record.column("others")
                at, others = packed.offsets.to_numpy(), packed.values
                ref, least, most = (others.field(i).to_numpy()[at[0] : at[-1]] for i in range(3))
                n = np.diff(at)
                doc, low, high = (np.repeat(c, n) for c in (doc, low, high))
                wanted = (doc != ref) & ~((low == most) & (high == least))
                doc, ref = doc[wanted], ref[wanted]
                order, first = first_of_each(ref, doc)
                yield pa.RecordBatch.from_arrays([pa.array(c[order][first]) for c in (doc, ref)], names=["doc_id", "ref"])

    own = left.where("lead").select("key", bucket(width).alias("bucket"), "doc_id", "low", "high")
    others = holders.where("lead").select("key", bucket(width).alias("bucket"), bucket(TOGETHER).alias("part"), F.struct("doc_id", "low", "high").alias("other"))
    others = others.join(own.select("key", "bucket").distinct(), ["key", "bucket"], "left_semi")
    others = others.groupBy("key", "bucket", "part").agg(F.collect_list("other").alias("others"))
    rows = own.join(others, ["key", "bucket"]).select("doc_id", "low", "high", "others")
    return rows.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(met, "doc_id long, ref long").distinct()


def compared(chains: DataFrame, text: DataFrame, least: int, identity: float) -> DataFrame:
    """PASSAGE rows of CHAIN rows."""
    chains = stored(chains, "passage-chains")
    return stored(chains.where("sure").select(*PASSAGE).union(aligned(chains.where("not sure"), text, least, identity)).distinct(), "passage-compared")


def fuzzy_passages(held: DataFrame, exact: DataFrame, text: DataFrame, least: int, identity: float, meet: int = MEET) -> DataFrame:
    """PASSAGE rows from suspects() and exact_passages(): words start .. end - 1 of doc_id also stand,
    perhaps edited, in ref.

    Documents are compared that share a seed of ``meet`` holders at most; of other seeds each holder is
    compared with the first and last one. Then come pair_keys() with different words between their
    seeds: who holds one where no passage found so far has it is compared with some ``meet`` of the
    key's holders, if that finds none with ``WIDER`` times as many, and at last with all.
    """
    found = held.select("doc_id", F.inline(F.arrays_zip("hash", "pos", "before")))
    places = stored(found.groupBy("hash", "doc_id").agg(F.min("pos").alias("low"), F.max("pos").alias("high")), "passage-places")
    ends = places.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("held")).where("held > 1")
    ends = stored(ends.select("hash", "first", "last", (F.col("held") > meet).alias("hot")), "passage-ends")
    # each seed's first and last place in a document stand for all of its places there
    meets = places.join(ends, "hash").where("not hot or doc_id in (first, last)").withColumn("ref_pos", F.explode(F.array_distinct(F.array("low", "high"))))
    sides = found.join(meets.select("hash", F.col("doc_id").alias("ref"), "ref_pos"), "hash").where("doc_id <> ref").select("doc_id", "pos", "ref", "ref_pos")
    out = compared(chained(sides, least), text, least, identity)

    hot = found.join(ends.where("hot"), "hash").select("hash", "doc_id", "pos", "before", F.expr("doc_id <> first and doc_id <> last").alias("middle"))
    keys = stored(pair_keys(hot, exact.where("inner").select("doc_id", "start", "end")), "passage-keys")
    sizes = keys.where("lead").groupBy("key").agg(F.count("*").alias("held"), F.min("low").alias("low"), F.max("high").alias("high"))
    sizes = sizes.where("held > 1 and low <> high").select("key", "held")
    left = holders = stored(keys.join(sizes, "key").select(*KEYS, "held"), "passage-key-holders")

    # who meets from here on holds a key
    few = listed(holders.select("doc_id").distinct())
    text = stored(text.join(few, "doc_id", "left_semi"), "passage-key-texts")
    held = stored(held.join(few, "doc_id", "left_semi").select("doc_id", "hash", "pos"), "passage-key-seeds")
    new, tried, width = out.select(*PASSAGE).union(exact.select("doc_id", "ref", "start", "end", *[F.lit(None).cast("long")] * 2)), None, meet
    while True:
        spans = new.select("doc_id", "start", "end").union(new.select("ref", "ref_start", "ref_end").where("ref_start is not null")).distinct()
        left = stored(outside(left, spans), "passage-left")
        if left.isEmpty():
            return out
        pairs = meeting(left, holders, width)
        pairs = stored(pairs if tried is None else pairs.join(tried, ["doc_id", "ref"], "left_anti"), "passage-pairs")
        tried = pairs if tried is None else tried.union(pairs)
        new = compared(chained_pairs(pairs, held, least), text, least, identity)
        out = out.union(new)
        left = left.where(F.col("held") > width)  # the others have met all
        width *= WIDER


def repeated_passages(docs: DataFrame, least: int = 50, identity: float = 0.8, max_filter_bits: int = 1 << 30) -> DataFrame:
    """One row per document that holds repeated passages: doc_id, n_words (in passages, each word
    once), passages (ascending, overlapping ones merged, as [start, end]), doc_ids (the documents
    that its passages were compared with; of those that were compared with it, the first for each
    span, as there may be any number; for a copy of a whole text, the text's first document).

    ``least`` is the shortest passage in words, ``identity`` the share of words that an alignment
    must match, ``max_filter_bits`` the bound of the broadcast filter.
    """
    ship_package(docs.sparkSession)
    text = texts_of(docs).where("doc_id is not null")
    keyed = text.withColumn("same", F.unhex(F.md5("text")))
    ids = stored(keyed.select("doc_id", "same"), "passage-ids")
    classes = stored(ids.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last"), "passage-classes")
    n_words = F.expr(r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')").cast("long")
    firsts = keyed.join(listed(classes.select(F.col("first").alias("doc_id")).distinct()), "doc_id", "left_semi").join(listed(classes.select("same", F.col("first").alias("doc_id"))), ["doc_id", "same"], "left_semi")
    # grouped, as a condition on n would be worked out for all texts before the joins
    lengths = stored(firsts.groupBy("same").agg(F.max(n_words).alias("n")).where(F.col("n") >= least), "passage-lengths")
    copies = stored(ids.join(listed(classes.join(lengths, "same")), "same"), "passage-copies")
    later = copies.where("doc_id <> first").select("doc_id", "same").distinct()
    one_each = stored(keyed.join(listed(later), ["doc_id", "same"], "left_anti").select("doc_id", "text"), "passage-texts")

    held = suspects(one_each, twice_seen(one_each, max_filter_bits), least)
    runs = held.select("doc_id", F.inline(F.arrays_zip(F.col("run").alias("hash"), F.col("since").alias("pos"))))
    exact = stored(exact_passages(runs, least), "passage-exact")
    fuzzy = stored(fuzzy_passages(held, exact, one_each, least, identity), "passages")
    other = fuzzy.groupBy(F.col("ref").alias("doc_id"), F.col("ref_start").alias("start"), F.col("ref_end").alias("end")).agg(F.min("doc_id").alias("ref"))
    whole = copies.select("doc_id", F.lit(0).cast("long").alias("start"), F.col("n").alias("end"), F.when(F.col("doc_id") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias("ref"))
    spans = fuzzy.select("doc_id", "start", "end", "ref").union(other).union(exact.drop("inner")).union(whole)
    merged = lambda spans: F.aggregate(spans, F.array().cast("array<array<bigint>>"), lambda out, s: F.when((F.size(out) > 0) & (F.get(F.element_at(out, -1), F.lit(1)) >= F.get(s, F.lit(0))), F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.array(F.get(F.element_at(out, -1), F.lit(0)), F.greatest(F.get(F.element_at(out, -1), F.lit(1)), F.get(s, F.lit(1))))))).otherwise(F.concat(out, F.array(s))))
    grouped = spans.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.array("start", "end"))).alias("spans"), F.sort_array(F.collect_set("ref")).alias("doc_ids"))
    grouped = grouped.select("doc_id", merged(F.col("spans")).alias("passages"), "doc_ids")
    return grouped.select("doc_id", F.aggregate("passages", F.lit(0).cast("long"), lambda n, s: n + F.get(s, F.lit(1)) - F.get(s, F.lit(0))).alias("n_words"), "passages", "doc_ids")
