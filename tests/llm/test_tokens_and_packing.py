import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tablewright.llm import packing, pretokens, token_counts, token_files
from tablewright.llm.common import new_path
from tests.llm.data import frame, odd_documents

ODD = ["a\tb", "x  y \n\n z ", "<|endoftext|> a <|startoftext|>b", "<|ENDOFTEXT|>", "see <|endoftext|> Hello WORLD. Émile", "x" * 200 + ". y", "日本語 テキスト。", "İİ É É ́", "!\x1c a\x1cb", "a  b  c", "▁a▁ ▁b", " lead", "trail ", "\n", "\n\n a", "don't I'LL 'S we're.", "ß ﬁ Σ ΑΣ. 𝒳 12.5% a\r\nb", "<s> </s><unk>x", "", " ", "a \x85 b", "�\x00 z", " \x00x y", "word... wOrd!! ***x*** naïve. Ünder, ÀB"]


def texts():
    return ODD + [t or "" for t in odd_documents().values()]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_library(name):
    ids = pretokens.PieceIds(public_tokenizers.path(name), limit=500)  # so small that it is emptied
    want = ids.tokenizer.encode_batch(texts(), add_special_tokens=False)
    for text, w in zip(texts(), want, strict=True):
        assert np.frombuffer(ids.encode([text])[0], "<u4").tolist() == w.ids, repr(text[:60])


def test_counts_equal_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = list(enumerate(texts())) + [(None, None), (3, "twice")]
    got = sorted((tuple(r) for r in token_counts.count_tokens(frame(spark, [(i, t) for i, t in rows if i is not None] + [(10**6, None)]), limit=100, entries=50).collect()))
    want = sorted((i, len((t or "").encode()), (n := len(model.encode(t or ""))), n > 100) for i, t in [r for r in rows if r[0] is not None] + [(10**6, None)])
    assert got == want
    assert token_counts.count_tokens(frame(spark, {}).limit(0)).count() == 0
    table = {"a": 1, "né": 300}
    assert token_counts.unpack(*token_counts.pack(table)) == table


def test_token_files(spark):
    rows = [*odd_documents().items(), (5, "again")]
    got = [tuple(r) for r in token_files.encode_and_read_back(frame(spark, rows)).orderBy("start").collect()]
    ids_of, start, want = pretokens.encoder(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        own = ids_of.encode([t or ""])[0] + np.array([2], "<u4").tobytes()
        want.append((i, start, len(own) // 4, zlib.crc32(own)))
        start += len(own) // 4
    assert got == want


def test_token_files_prune_and_keep_ids(spark):
    path = new_path(spark, "test-orc")
    docs = frame(spark, {i: f"text number {i}" for i in range(50)})
    token_files.write_tokens(docs, path)
    some = token_files.read_tokens(spark, path, [7, 31]).orderBy("doc_id").collect()
    every = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    assert [r.doc_id for r in some] == [7, 31] and some[0] == every[7] and some[1].ids[-1] == 2
    token_files.write_tokens(docs.limit(0), path + "-empty")
    assert token_files.read_tokens(spark, path + "-empty").count() == 0


def check_packing(spark, rows, capacity, **how):
    out = packing.pack_documents(frame(spark, rows), capacity, **how).orderBy("doc_id", "piece").collect()
    ids_of = pretokens.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    pieces = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in out)
    want = []
    for i, t in rows:
        own = ids_of.encode([t or ""])[0] + bytes(4)
        n, a = len(own) // 4, 0
        first = n if n <= capacity else n % capacity or capacity
        for size in [first] + [capacity] * ((n - first) // capacity):
            want.append((i, a, size, zlib.crc32(own[4 * a : 4 * (a + size)])))
            a += size
    assert pieces == sorted(want)
    counts = {}
    for p in pieces:
        counts[p[2]] = counts.get(p[2], 0) + 1
    return len(by_sequence), packing.least_sequences(counts, capacity)


def test_packing_is_exact_and_tight(spark):
    rows = [*odd_documents().items(), (5, "again")]
    used, bound = check_packing(spark, rows, 2048)
    assert used <= bound + 1
    used, bound = check_packing(spark, rows, 256)
    assert used <= bound * 1.02 + 1
    assert packing.pack_documents(frame(spark, {}).limit(0)).count() == 0
    assert "ids" in packing.pack_documents(frame(spark, {1: "a"}), with_ids=True).columns


@pytest.mark.parametrize("counts", [{7: 3, 6: 3, 4: 6, 3: 6}, {10: 4}, {1: 1000}, {6: 5, 5: 5, 4: 9, 2: 3}, {}])
def test_histogram_packing(counts):
    patterns = packing.pack_histogram(counts, 10)
    left = dict(counts)
    for items, times in patterns:
        assert sum(items) <= 10
        for x in items:
            left[x] -= times
    assert not any(left.values())


def test_bin_completion_beats_best_fit():
    counts = {44: 2, 41: 2, 35: 2, 30: 2, 29: 2, 26: 2, 21: 2, 18: 2, 16: 2, 14: 2, 12: 2, 11: 2, 3: 2}
    used = sum(n for _, n in packing.pack_histogram(counts, 100))
    assert used == packing.least_sequences(counts, 100) == -(-sum(x * n for x, n in counts.items()) // 100)


def fewest(items: list[int], capacity: int) -> int:
    """By trying every place for every item, largest first."""
    best, rooms = [len(items)], []

    def place(i: int) -> None:
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                b = rooms.index(room)
                rooms[b] -= items[i]
                place(i + 1)
                rooms[b] += items[i]
        rooms.append(capacity - items[i])
        place(i + 1)
        rooms.pop()

    place(0)
    return best[0]


def test_small_histograms_are_packed_optimally():
    r = random.Random(9)
    for _ in range(150):
        items = sorted((r.randint(4, 60) for _ in range(r.randint(1, 11))), reverse=True)
        counts = {x: items.count(x) for x in items}
        want = fewest(items, 100)
        assert sum(n for _, n in packing.pack_histogram(counts, 100)) == want >= packing.least_sequences(counts, 100)


@pytest.mark.parametrize("low,high", [(300, 1100), (400, 1000)])
def test_branching_beats_best_fit(low, high):
    for seed in range(2):
        r = random.Random(seed)
        counts = {x: r.randint(1, 5) for x in r.sample(range(low, high + 1), 300)}
        alone = [([x], n) for x, n in counts.items()]
        best_fit, _ = packing.descend(counts, 2048, alone, 0, 0, 1, [1 << 62])
        patterns, left = packing.pack_histogram(counts, 2048), dict(counts)
        for items, times in patterns:
            assert sum(items) <= 2048 and times > 0
            for x in items:
                left[x] -= times
        assert not any(left.values())
        assert packing.least_sequences(counts, 2048) <= sum(n for _, n in patterns) < sum(n for _, n in best_fit)


def test_many_tiny_pieces():
    """More pieces of one token in a sequence than Python's stack is deep."""
    for counts in ({1: 9000, 700: 3, 2048: 2}, {1: 100_000, 2: 5}, {3: 40_000, 1000: 1}):
        patterns = packing.pack_histogram(counts, 2048)
        left = dict(counts)
        for items, times in patterns:
            assert sum(items) <= 2048
            for x in set(items):
                left[x] -= times * items.count(x)
        assert not any(left.values())
        assert sum(n for _, n in patterns) == packing.least_sequences(counts, 2048)


def test_lower_bound():
    assert packing.least_sequences({6: 5, 5: 1}, 10) == 6  # more than the volume asks for
    assert packing.least_sequences({}, 10) == 0
