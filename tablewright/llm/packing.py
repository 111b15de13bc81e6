"""Best-fit packing by bin completion over the histogram of piece lengths.

However many documents there are, their pieces have at most ``capacity`` different lengths. Spark
counts pieces by length and salt (a table of fixed size bound), the driver packs the histogram,
and Spark deals the pieces into the sequences by their rank within their length.

The packing is a branch and bound: take the largest length left, enumerate the undominated ways
to fill the sequence around it, branch over them and over how often each is used, depth first, and
give up a branch once its waste alone proves that it can't beat the incumbent. Best-fit decreasing is
the first incumbent, and a lower bound ends the search early. Of fillings whose wastes count alike the
one that takes the largest lengths comes first; how much counts alike is varied, as least waste alone
would use up the small lengths early. The search is bounded: ``nodes`` fillings are looked at for a
sequence and ``budget`` in all; where that ends it, the best packing seen is used, which
least_sequences() tells how far from the optimum it can be at most.

Defined cases: a null or empty text is only the end id; null and repeated doc_ids are packed row
by row; pieces of one length may swap places; a very long text is encoded whole in one task, in memory
that follows its length, and cut; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.llm.common import slices, stored, texts_of
from tablewright.llm.pretokens import encoder, vocabulary
from tablewright.runtime import ship_package

#: Pieces of one length are ranked by so many of them at a time, about; salts at least and at most.
RANKED, SALTS, MOST_SALTS = 1_000_000, 32, 4096


def token_pieces(docs: DataFrame, capacity: int = 2048, vocab: str = "byte_bpe_50k.json", end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): documents longer than ``capacity`` are cut
    into pieces of that many tokens, of which the first may be shorter."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(records):
        ids_of = encoder(vocabulary(vocab))
        for record in (part for r in records for part in slices(r)):
            rows: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, ids in zip(record.column("doc_id").to_pylist(), ids_of.encode(record.column("text").to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                bounds = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    own = ids[4 * a : 4 * b]
                    for name, value in zip(rows, (doc_id, k, a, b - a, zlib.crc32(own), own), strict=True):
                        rows[name].append(value)
            types = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
            names = [n for n in types if n != "ids" or with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], types[n]) for n in names], names=names)

    return texts_of(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def fillings(left: dict[int, int], sizes: list[int], room: int, most: int, nodes: int, slack: int = 0) -> tuple[list[list[int]], int]:
    """Up to ``most`` undominated fillings of ``room`` from the lengths ``left`` (``sizes``: ascending),
    the one of least waste first, and how many nodes were looked at. Wastes up to ``slack`` count alike.

    Larger lengths are tried first, so the first filling found is best fit's, and of fillings that
    count alike the one that leaves smaller lengths comes first. A filling in which a
    larger length could take an item's place is dominated and passed over. More than ``nodes`` nodes
    are looked at only until there is a filling.
    """
    found: list[tuple[int, int, dict[int, int]]] = []
    state = [nodes, 0]  # nodes left, fillings that none can precede

    def undominated(taken: dict[int, int], waste: int) -> bool:
        for x in taken:
            larger = sizes[bisect_right(sizes, x + waste) - 1]
            if larger > x and left[larger] > taken.get(larger, 0):
                return False
        return True

    def fill(rest: int, k: int, taken: dict[int, int]) -> bool:
        """Fill ``rest`` with lengths up to sizes[k]; one level for each length, however often it is
        taken, so the depth is below the root of twice the capacity."""
        state[0] -= 1
        k = min(k, bisect_right(sizes, rest) - 1)
        fitted = False
        while k >= 0:
            x = sizes[k]
            k -= 1
            for copies in range(min(left[x], rest // x), 0, -1):
                fitted = True
                if fill(rest - copies * x, k, taken | {x: copies}):
                    return True
                if state[0] <= 0 and found:
                    return True
        if not fitted and (not taken or rest == 0 or undominated(taken, rest)):
            found.append((max(rest, slack), len(found), taken))
            state[1] += rest <= slack
        return state[1] >= most

    fill(room, len(sizes) - 1, {})
    found.sort(key=lambda f: f[:2])
    return [[x for x, copies in taken.items() for _ in range(copies)] for _, _, taken in found[:most]], nodes - state[0]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A number of sequences that no packing can beat.

    For each size k: lengths over capacity - k stand alone, those over half of the capacity never
    share one, and lengths from k on must fit beside the latter or need more. And for each k up to
    50: lengths rounded to k-ths of a sequence, whole (k+1)-ths counted as they are, so that what
    fits into a sequence still does.
    """
    n, volume = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)
    for x, c in counts.items():
        n[x], volume[x] = c, c * x
    upto_n, upto = np.cumsum(n), np.cumsum(volume)
    half, best = capacity // 2, -(-int(upto[-1]) // capacity)
    for k in range(1, half + 1):
        alone = int(upto_n[-1] - upto_n[capacity - k])
        big, big_volume = int(upto_n[capacity - k] - upto_n[half]), int(upto[capacity - k] - upto[half])
        small = int(upto[half] - upto[k - 1])
        best = max(best, alone + big + max(0, -(-(small - (big * capacity - big_volume)) // capacity)))
    for k in range(1, 51):
        rounded = sum(c * (x * k if (k + 1) * x % capacity == 0 else (k + 1) * x // capacity * capacity) for x, c in counts.items())
        best = max(best, -(-rounded // (k * capacity)))
    return best


def descend(counts: dict[int, int], capacity: int, best: list, goal: int, allowed: int, nodes: int, budget: list[int], slack: int = 0) -> tuple[list, bool]:
    """The best packing met by a depth-first search, and whether the search has left nothing out.

    At each depth the largest length left gets one of its undominated fillings, as often as the
    counts allow, half as often or once. Another choice than the first is a departure; ``allowed``
    departures are made on a path. A path ends once its waste alone proves that it can't have fewer
    sequences than ``best``, the incumbent, and the search once ``goal`` sequences are met or the
    ``budget`` of nodes is used up.
    """
    volume = sum(n * x for x, n in counts.items())
    left = {x: n for x, n in counts.items() if n}
    sizes, spare, whole = sorted(left), (sum(n for _, n in best) - 1) * capacity - volume, True
    path: list[tuple[list[int], int]] = []  # the patterns chosen, one for each depth
    wastes, used, open_choices = [0], [0], []

    def choices(departures: int) -> list[tuple[list[int], int, int]]:
        """(items, times, departures after it), the preferred one last."""
        nonlocal whole
        first = sizes[-1]
        left[first] -= 1
        looked = nodes if budget[0] > 0 else 1
        found, spent = fillings(left, sizes, capacity - first, departures + 1, looked, slack)
        left[first] += 1
        budget[0] -= spent
        whole &= len(found) <= departures and spent < looked
        out = []
        for rank, filling in enumerate(found):
            items = [first, *filling]
            times = min(left[x] // items.count(x) for x in set(items))
            for k, often in enumerate(dict.fromkeys((times, (times + 1) // 2, 1))):
                if rank + k <= departures:
                    out.append((items, often, departures - rank - k))
                else:
                    whole = False
        return out[::-1]

    def take(items: list[int], times: int) -> None:
        nonlocal sizes
        for x in set(items):
            left[x] -= times * items.count(x)
        sizes = sorted(x for x, n in left.items() if n)

    if sizes:
        open_choices.append(choices(allowed))
    while open_choices:
        if not open_choices[-1]:
            open_choices.pop()
            if path:
                items, times = path.pop()
                take(items, -times)
                wastes.pop(), used.pop()
            continue
        items, times, departures = open_choices[-1].pop()
        waste = wastes[-1] + times * (capacity - sum(items))
        if waste > spare:
            continue
        take(items, times)
        path.append((items, times))
        wastes.append(waste), used.append(used[-1] + times)
        if not sizes:
            best, spare = list(path), (used[-1] - 1) * capacity - volume
            if used[-1] <= goal:
                return best, True
        if budget[0] <= 0 and len(open_choices) > 1:
            return best, False
        open_choices.append(choices(departures) if sizes else [])
    return best, whole


def pack_histogram(counts: dict[int, int], capacity: int, nodes: int = 1500, budget: int = 1_000_000) -> list[tuple[list[int], int]]:
    """Patterns (lengths in one sequence, how many sequences) that use up ``counts`` exactly.

    Best-fit decreasing is the first incumbent. Paths without departures follow, for different
    wastes that count alike, and the search then departs more and more often from the best of them,
    until least_sequences() is met, nothing is left out or ``budget`` nodes have been looked at.
    """
    counts = {x: n for x, n in counts.items() if n}
    goal = least_sequences(counts, capacity)
    alone = [([x], n) for x, n in sorted(counts.items())]
    best, _ = descend(counts, capacity, alone, goal, 0, 1, [1 << 62])  # one node: best-fit decreasing
    effort, allowed, chosen = [budget], 1, (nodes, 0)
    used = lambda packing: sum(n for _, n in packing)
    for how in ((m, slack) for slack in (0, *(capacity >> k for k in range(10, 1, -1))) for m in (max(1, nodes // 8), nodes)):
        if used(best) == goal:
            return best
        found, _ = descend(counts, capacity, best, goal, 0, how[0], effort, how[1])
        if used(found) < used(best):
            best, chosen = found, how
    while used(best) > goal and effort[0] > 0:
        best, whole = descend(counts, capacity, best, goal, allowed, chosen[0], effort, chosen[1])
        if whole:
            break
        allowed += 1
    return best


def pack_documents(docs: DataFrame, capacity: int = 2048, vocab: str = "byte_bpe_50k.json", end_id: int = 0, nodes: int = 1500, with_ids: bool = False) -> DataFrame:
    """token_pieces with sequence_id and offset: no sequence holds more than ``capacity`` tokens,
    and its pieces lie in it without gaps from 0."""
    spark = docs.sparkSession
    ship_package(spark)
    pieces = stored(token_pieces(docs, capacity, vocab, end_id, with_ids), "pieces")
    salts = min(MOST_SALTS, max(SALTS, pieces.count() // RANKED))  # a hot length is ranked in many parts
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counted = pieces.groupBy("length", "salt").count().toLocalIterator()  # capacity * MOST_SALTS rows at most
    table = np.zeros((capacity + 1, salts), np.int64)
    for row in counted:
        table[row.length, row.salt] = row["count"]
    before = np.cumsum(table, axis=1) - table  # rank of the first piece of a salt
    patterns = pack_histogram({int(x): int(n) for x, n in enumerate(table.sum(axis=1)) if n}, capacity, nodes)

    # by length: from which rank on a pattern holds the pieces, its first sequence, copies, offset
    places: dict[int, list[tuple[int, int, int, int]]] = {}
    taken, first = dict.fromkeys(range(capacity + 1), 0), 0
    for items, times in patterns:
        offset = 0
        for x in dict.fromkeys(items):
            copies = items.count(x)
            places.setdefault(x, []).append((taken[x], first, copies, offset))
            taken[x] += copies * times
            offset += copies * x
        first += times
    steps = {x: np.array(p, np.int64).T for x, p in places.items()}
    sent = spark.sparkContext.broadcast((before, steps))

    def placed(records):
        before, steps = sent.value
        for record in records:
            length, salt, rank = (record.column(c).to_numpy() for c in ("length", "salt", "rank"))
            rank = rank - 1 + before[length, salt]
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                since, first, copies, at = steps[int(x)]
                k = np.searchsorted(since, rank[own], "right") - 1
                nth = rank[own] - since[k]
                sequence[own] = first[k] + nth // copies[k]
                offset[own] = at[k] + nth % copies[k] * x
            names = [n for n in record.schema.names if n not in ("salt", "rank")]
            yield pa.RecordBatch.from_arrays([*(record.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids + ", sequence_id long, offset long"
    return ranked.mapInArrow(placed, out)
