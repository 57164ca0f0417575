"""Token counts, packing and token-id files against the libraries, exact round trips and invariants."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from attrition.llm import bestfit, fst_tokens, rans
from attrition.session import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "the", " ", "  ", "\n", "'", "s", "t", "re", "ve", "ll", "'s", "'ll", "1", "23", "²", "é", "Ñ", "Ω",
       "中", "!", "...", "_", "<|endoftext|>", "<|startoftext|>", "<|", "\t", "\r\n", "\x00", "\x1c", "́", "̱", "H̱", "\U0001f600",
       "ing", "ABC", " ", "İ", "ß", "word.", "x's", "&&&", " "]


@pytest.fixture(scope="module")
def counter():
    return fst_tokens.TokenCounter(BYTES)


@pytest.fixture(scope="module")
def byte_lib():
    return Tokenizer.from_file(BYTES)


def _mixed(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 50))) for _ in range(n)]


def test_counts_equal_the_library(counter, byte_lib):
    texts = _mixed(3000, 1) + ["a" * 5000, " " * 700, "'" * 99, "'l", "'r", "x'r", "x'l ", "", "\n" * 600 + "x"]
    got = counter.counts(texts)
    assert got.tolist() == [len(e.ids) for e in byte_lib.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_counts_equal_the_library_on_any_text(text):
    counter = fst_tokens.token_counter(BYTES)
    lib = rans_lib()
    text = text.encode("utf-8", "replace").decode()
    assert counter.counts([text])[0] == len(lib.encode(text, add_special_tokens=False).ids)


_LIB = []


def rans_lib():
    if not _LIB:
        _LIB.append(Tokenizer.from_file(BYTES))
    return _LIB[0]


def test_chunk_maps_compose_like_a_serial_run():
    nxt, out = fst_tokens.compile_splitter()
    rng = np.random.default_rng(5)
    classes = rng.integers(0, fst_tokens.N_CLASSES, 5000).astype(np.uint8)
    classes[-1] = fst_tokens.STOP
    classes[1000:3000] = fst_tokens.OTHER   # many chunks without any change of state
    state, begins = fst_tokens.START, set()
    for i, c in enumerate(classes):
        o = out[state, c]
        begins |= {i} if o & 1 else set()
        begins |= {i - 1} if o & 2 else set()
        state = nxt[state, c]
    assert fst_tokens.Splitter().boundaries(classes).tolist() == sorted(begins)


def test_scan_is_the_composition_of_maps():
    rng = np.random.default_rng(2)
    maps = rng.integers(0, fst_tokens.N_STATES, (37, fst_tokens.N_STATES)).astype(np.uint8)
    state, want = fst_tokens.START, []
    for m in maps:
        want.append(state)
        state = m[state]
    assert fst_tokens.scan_states(maps).tolist() == want


def test_transducer_forgets_and_still_counts(byte_lib):
    counter = fst_tokens.TokenCounter(BYTES, most=10)
    counter.bpe.most = 50
    texts = _mixed(300, 8)
    got = np.concatenate([counter.counts(texts[i:i + 20]) for i in range(0, 300, 20)])
    assert got.tolist() == [len(e.ids) for e in byte_lib.encode_batch(texts, add_special_tokens=False)]


def test_count_rows(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "éa " * 700, 3), (3, "éa " * 700, 3), (None, "x", 3)],
                               "doc_id bigint, text string, n_bytes int")
    got = sorted((tuple(r) for r in fst_tokens.count_tokens(df, BYTES).collect()), key=str)
    n = len(rans_lib().encode("éa " * 700).ids)
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (3, 2800, n, True), (3, 2800, n, True), (None, 1, 1, False)], key=str)
    assert fst_tokens.count_tokens(df.limit(0), BYTES).count() == 0


# --- packing ------------------------------------------------------------------------

def _naive(items, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], {}
    rest = []
    for i, (d, n, s, c) in enumerate(items):
        bins += [[0, None, None]] * (n // capacity)
        if n % capacity or n < capacity:
            rest.append((n - n // capacity * capacity, i))
    rest.sort(key=lambda r: (-r[0], items[r[1]][0], r[1]))
    for n, i in rest:
        _, _, s, c = items[i]
        fit = [(b[0], k) for k, b in enumerate(bins) if b[1] is not None and b[0] >= n and s not in b[1] and c not in b[2] and b[0] > 0]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append([capacity, set(), set()])
        bins[k][0] -= n
        bins[k][1].add(s)
        bins[k][2].add(c)
        out[i] = k
    return out, len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_takes_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    items = [(i, rng.choice([1, 5, 99, 100, 101, 250, rng.randint(1, 130)]), rng.choice(["a", "a", "b", None, "c"]), rng.randint(0, 40))
             for i in range(700)]
    got = bestfit.pack_shard(items, 100)
    want, n = _naive(items, 100)
    tail = {i: b for i, seg, start, length, b, pos in got if length < 100 or items[i][1] == 0}
    naive = {i: b for i, b in want.items() if items[i][1] % 100}
    # bins are numbered alike: full segments first, then in order of opening
    assert tail == naive and max(b for *_, b, _ in got) + 1 == n


def test_packed_documents_are_whole_and_without_conflicts(spark):
    rng = random.Random(4)
    rows = [(i, "x" * rng.choice([0, 3, 40, 63, 64, 500]), rng.choice(["hot", "hot", "b", None]), 1) for i in range(400)]
    rows += [(7, None, None, 1), (None, "yy", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, length int")
    out = bestfit.pack_documents(df, capacity=64).collect()
    size, bins = {}, {}
    for r in out:
        size[r.doc_id] = size.get(r.doc_id, 0) + r.length
        bins.setdefault(r.bin_id, []).append(r)
    want = {}
    for i, t, _, _ in rows:
        want[i] = want.get(i, 0) + len(t or "") + 1
    assert size == want
    source = {i: s for i, _, s, _ in rows[:400]}
    text = {i: t for i, t, _, _ in rows[:400]}
    for packed in bins.values():
        spans = sorted((r.bin_start, r.bin_start + r.length) for r in packed)
        assert spans[0][0] == 0 and spans[-1][1] <= 64 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        own = [source[r.doc_id] for r in packed if r.doc_id not in (7, None)]
        assert len(own) == len(set(own))
        texts = [text[r.doc_id] for r in packed if r.doc_id not in (7, None)]
        assert len(texts) == len(set(texts))   # equal texts are one cluster
    assert bestfit.pack_documents(df.limit(0)).count() == 0


def test_near_copies_never_share_a_sequence(spark):
    rng = random.Random(11)
    rows, family = [], {}
    for k in range(4):   # families of edited copies, each copy of another source, ids null or repeated; no two of one length
        base = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(60 + 10 * k)]
        for i in range(8):
            text = " ".join([*base, "z" * (i + 1)])
            rows.append((rng.choice([None, 1, 2]), text, f"s{k}{i}"))
            family[len(text) + 1] = k
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    bins = {}
    for r in bestfit.pack_documents(df, 4000).collect():
        bins.setdefault(r.bin_id, []).append(family[r.length])
    assert sum(map(len, bins.values())) == len(rows) == len(family)
    assert all(len(b) == len(set(b)) for b in bins.values())
    assert any(len(b) > 1 for b in bins.values())


# --- token-id files --------------------------------------------------------------------

def test_word_tokenizer_equals_the_library():
    lib = Tokenizer.from_file(WORDS)
    texts = _mixed(3000, 2) + ["", "Straße ÉTÉ naïve, café!!", "Å H̱ İ x" * 9, "a" * 3000]
    for most in (500_000, 40):
        tok = rans.WordTokenizer(WORDS, most=most)
        got = [ids.tolist() for run in tok.encode([t.encode() for t in texts], 1) for ids in run]
        assert got == [e.ids + [1] for e in lib.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("sizes", [[0], [1], [63, 64, 65], [rans.BLOCK, rans.BLOCK - 1, 5], [rans.BLOCK] * 3, [3000, 10_000]])
def test_blocks_round_trip_from_every_checkpoint(sizes):
    rng = np.random.default_rng(1)
    counts = np.zeros(60_000, np.int64)
    counts[:50_000] = rng.zipf(1.3, 50_000).clip(1, 10**9)
    table = rans.FrequencyTable(counts)
    assert int(table.freq.sum()) == 1 << rans.SCALE_BITS and table.freq[:50_000].min() >= 1
    blocks = [rng.integers(0, 50_000, n).astype(np.uint32) for n in sizes]
    coded = rans.encode_blocks(blocks, table)
    parsed = [rans.Block(c, 0) for c in coded]
    for a, b in zip(blocks, rans.decode_blocks(parsed, table)):
        assert (a == b).all() and len(a) == len(b)
    for p, b in zip(parsed, blocks):
        for k in range(1, len(p.marks) + 1):
            assert (rans.decode_blocks([p], table, start=k)[0] == b[k * rans.CHECK * rans.LANES:]).all()


def test_one_symbol_and_damage():
    counts = np.zeros(10, np.int64)
    counts[1] = 5
    table = rans.FrequencyTable(counts)
    frame = rans.encode_frames([([4, None], [np.ones(70, np.uint32), np.ones(1, np.uint32)])], table)[0]
    assert [(i, [len(d) for d in ds]) for i, ds in rans.decode_frames([frame], table)] == [([4, None], [70, 1])]
    with pytest.raises(ValueError):
        rans.decode_frames([frame[:-9] + bytes([frame[-9] ^ 1]) + frame[-8:]], table)


def test_corpus_files_round_trip(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choices(ODD, k=rng.randint(0, 300))), 1) for i in rng.sample(range(10_000), 120)]
    rows += [(-3, None, 1), (-2, "", 1), (20_000, "long text " * 30_000, 1), (20_000, "long text " * 30_000, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids int").repartition(5)
    files = rans.encode_corpus(df, WORDS, scratch_path(spark, "t"))
    got = sorted(tuple(r) for r in rans.decode_corpus(spark, files).collect())
    lib, pos, want = Tokenizer.from_file(WORDS), 0, []
    for i, t, _ in sorted(rows, key=lambda r: r[0]):
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, pos, len(ids), zlib.crc32(ids.tobytes())))
        pos += len(ids)
    assert got == sorted(want)
    empty = rans.encode_corpus(df.limit(0), WORDS, scratch_path(spark, "t"))
    assert rans.decode_corpus(spark, empty).count() == 0
