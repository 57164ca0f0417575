"""Token-id files in a static range asymmetric numeral system.

``encode_corpus`` tokenizes every whole text once (the ids are staged in the
shared folder together with the symbol counts of each task), scales the
counts of the whole corpus to one frequency table shared by all blocks, deals
the documents by ranges of doc_id and writes one shard per range:

* a shard is a sequence of frames in ascending doc_id order (one Parquet row
  each: shard, frame, first token, documents, tokens, payload);
* a frame holds whole documents: their ids and lengths, and its tokens in
  blocks of ``LANES * STEPS`` tokens;
* a block is independent: token i goes to lane ``i % LANES``, the lanes share
  one stream of 32-bit words. It has the start state of each lane, a
  checkpoint (states, position) every ``CHECK`` steps, from which decoding
  can start, and the CRC-32 of its ids; the frame ends with a CRC-32 of all.

States are 64-bit with 2**31 as lower bound; frequencies sum to 2**20. All
blocks of a batch are coded side by side in numpy.

``decode_corpus`` reads the files back, frame by frame, in parallel.

Defined cases: a null or empty text is just the end id; documents sort by
doc_id (null first), repeated rows by their ids; a symbol that the table
lacks cannot occur, as the table counts the same staged ids; an empty table
gives empty files and no rows; other columns are ignored. Very long texts
take more blocks of the same frame.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrition.llm.common import parts_for, prepare
from attrition.session import scratch_path

LANES, STEPS, CHECK = 64, 256, 128
BLOCK = LANES * STEPS
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
#: Tokens of a frame (whole documents: the last one may exceed it) and of a shard.
FRAME_TOKENS = 8 * BLOCK
SHARD_TOKENS = 8_000_000
#: Tokens that one task codes at a time.
BATCH_TOKENS = 2_000_000
#: Blocks that are coded side by side.
SIDE = 128
MAGIC = b"RNS1"


class FrequencyTable:
    """Counts of symbols scaled to a sum of 2**SCALE_BITS; every counted symbol keeps at least 1."""

    def __init__(self, counts: np.ndarray):
        total, m = int(counts.sum()), 1 << SCALE_BITS
        freq = np.zeros(len(counts), np.int64)
        seen = np.flatnonzero(counts)
        if len(seen) > m:
            raise ValueError(f"{len(seen)} symbols do not fit a table of {m} slots")
        if total:
            exact = counts[seen].astype(np.float64) * (m - len(seen)) / total
            part = np.floor(exact).astype(np.int64)
            rest = m - len(seen) - int(part.sum())
            part[np.argsort(part - exact, kind="stable")[:rest]] += 1
            freq[seen] = part + 1
        self.freq = freq.astype(np.uint64)
        self.cum = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode_blocks(blocks: list[np.ndarray], table: FrequencyTable) -> list[bytes]:
    """Each block of ids (at most BLOCK) as bytes; all are coded side by side."""
    n = len(blocks)
    sizes = np.array([len(b) for b in blocks], np.int64)
    steps = -(-sizes // LANES)
    top = int(steps.max(initial=0))
    ids = np.zeros((n, top * LANES), np.int64)
    for i, b in enumerate(blocks):
        ids[i, :len(b)] = b
    live = np.arange(top * LANES) < sizes[:, None]
    ids = np.ascontiguousarray(ids.reshape(n, top, LANES).transpose(1, 0, 2))
    live = np.ascontiguousarray(live.reshape(n, top, LANES).transpose(1, 0, 2))
    x = np.full((n, LANES), LOW)
    words = np.zeros((top, n, LANES), np.uint32)
    sent = np.zeros((top, n, LANES), bool)
    checks: dict[int, np.ndarray] = {}
    whole = live.all(axis=(1, 2))
    up, scale, shift = np.uint64(63 - SCALE_BITS), np.uint64(SCALE_BITS), np.uint64(32)
    for t in range(top - 1, -1, -1):
        f, c = table.freq[ids[t]], table.cum[ids[t]]
        if not whole[t]:
            f = np.where(live[t], f, np.uint64(1))
        full = x >= (f << up)
        if not whole[t]:
            full &= live[t]
        words[t], sent[t] = x, full      # the low 32 bits
        y = np.where(full, x >> shift, x)
        q = y // f
        y = (q << scale) + (y - q * f) + c
        x = y if whole[t] else np.where(live[t], y, x)
        if t and t % CHECK == 0:
            checks[t] = x
    out = []
    counts = sent.sum(axis=2, dtype=np.int64).cumsum(axis=0) if top else np.zeros((0, n), np.int64)
    for i in range(n):
        at = [t for t in range(CHECK, int(steps[i]), CHECK)]
        stream = words[:steps[i], i][sent[:steps[i], i]]
        crc = zlib.crc32(np.asarray(blocks[i], "<u4").tobytes())
        head = struct.pack("<IIIHHI", len(blocks[i]), len(stream), crc, LANES, CHECK, len(at))
        marks = b"".join(struct.pack("<I", counts[t - 1, i]) + checks[t][i].astype("<u8").tobytes() for t in at)
        out.append(head + x[i].astype("<u8").tobytes() + marks + stream.astype("<u4").tobytes())
    return out


class Block:
    """The parts of a block's bytes, not yet decoded."""

    HEAD = struct.calcsize("<IIIHHI")

    def __init__(self, data: bytes, pos: int):
        self.size, n_words, self.crc, self.lanes, self.check, n_marks = struct.unpack_from("<IIIHHI", data, pos)
        pos += self.HEAD
        self.state = np.frombuffer(data, "<u8", self.lanes, pos).astype(np.uint64)
        pos += 8 * self.lanes
        self.marks = []
        for _ in range(n_marks):
            self.marks.append((struct.unpack_from("<I", data, pos)[0], np.frombuffer(data, "<u8", self.lanes, pos + 4).astype(np.uint64)))
            pos += 4 + 8 * self.lanes
        self.words = np.frombuffer(data, "<u4", n_words, pos)
        self.end = pos + 4 * n_words


def decode_blocks(blocks: list[Block], table: FrequencyTable, start: int = 0) -> list[np.ndarray]:
    """The ids of each block from checkpoint ``start`` on (0: from its begin), decoded side by side."""
    if not blocks:
        return []
    n = len(blocks)
    first = start * CHECK
    sizes = np.array([max(0, b.size - first * LANES) for b in blocks], np.int64)
    top = int((-(-sizes // LANES)).max(initial=0))
    x = np.stack([b.marks[start - 1][1] if start and start <= len(b.marks) else b.state for b in blocks])
    base = np.array(list(accumulate((len(b.words) for b in blocks), initial=0))[:-1], np.int64)
    at = base + [b.marks[start - 1][0] if start and start <= len(b.marks) else 0 for b in blocks]
    stream = np.concatenate([b.words for b in blocks] + [np.zeros(LANES, np.uint32)]).astype(np.uint64)
    ids = np.zeros((top, n, LANES), np.uint32)
    low, scale, shift = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    least = int(sizes.min(initial=0)) // LANES
    lane = np.arange(LANES)
    for t in range(top):
        slot = x & low
        s = table.symbol[slot]
        y = table.freq[s] * (x >> scale) + slot - table.cum[s]
        need = y < LOW
        if t >= least:
            live = (t * LANES + lane) < sizes[:, None]
            need &= live
        upto = np.cumsum(need, axis=1)
        y = np.where(need, (y << shift) | stream[np.minimum(at[:, None] + upto - need, len(stream) - 1)], y)
        x = y if t < least else np.where(live, y, x)
        at = at + upto[:, -1]
        ids[t] = s
    flat = ids.transpose(1, 0, 2).reshape(n, top * LANES)
    return [flat[i, :sizes[i]] for i in range(n)]


def encode_frames(frames: list[tuple[np.ndarray, list[np.ndarray]]], table: FrequencyTable) -> list[bytes]:
    """Payload of each frame of (doc ids, their token ids)."""
    cut: list[np.ndarray] = []
    spans = []
    for _, docs in frames:
        tokens = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
        parts = [tokens[i:i + BLOCK] for i in range(0, len(tokens), BLOCK)]
        spans.append((len(cut), len(cut) + len(parts)))
        cut.extend(parts)
    # full blocks and tails apart, so that no lane waits for longer blocks
    full = [i for i, b in enumerate(cut) if len(b) == BLOCK]
    tails = sorted((i for i, b in enumerate(cut) if len(b) < BLOCK), key=lambda i: len(cut[i]))
    coded: dict[int, bytes] = {}
    for group in (full, tails):
        for k in range(0, len(group), SIDE):
            some = group[k:k + SIDE]
            coded.update(zip(some, encode_blocks([cut[i] for i in some], table)))
    out = []
    for (ids, docs), (a, b) in zip(frames, spans):
        known = np.array([i is not None for i in ids], np.uint8)
        body = (MAGIC + struct.pack("<II", len(docs), b - a) + known.tobytes()
                + np.array([0 if i is None else i for i in ids], "<i8").tobytes()
                + np.array([len(d) for d in docs], "<u8").tobytes() + b"".join(coded[i] for i in range(a, b)))
        out.append(body + struct.pack("<I", zlib.crc32(body)))
    return out


def decode_frames(payloads: list[bytes], table: FrequencyTable) -> list[tuple[list[int | None], list[np.ndarray]]]:
    """(doc ids, token ids of each) of every payload; raises on a wrong checksum."""
    blocks: list[Block] = []
    heads = []
    for data in payloads:
        if data[:4] != MAGIC or zlib.crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("damaged frame")
        n, m = struct.unpack_from("<II", data, 4)
        known = np.frombuffer(data, np.uint8, n, 12)
        ids = np.frombuffer(data, "<i8", n, 12 + n)
        lens = np.frombuffer(data, "<u8", n, 12 + 9 * n).astype(np.int64)
        pos, first = 12 + 17 * n, len(blocks)
        for _ in range(m):
            blocks.append(Block(data, pos))
            pos = blocks[-1].end
        heads.append(([int(i) if k else None for i, k in zip(ids, known)], lens, first, len(blocks)))
    order = sorted(range(len(blocks)), key=lambda i: blocks[i].size)
    got: dict[int, np.ndarray] = {}
    for k in range(0, len(order), SIDE):
        some = order[k:k + SIDE]
        for i, ids in zip(some, decode_blocks([blocks[i] for i in some], table)):
            if zlib.crc32(ids.astype("<u4").tobytes()) != blocks[i].crc:
                raise ValueError("damaged block")
            got[i] = ids
    out = []
    for ids, lens, a, b in heads:
        tokens = np.concatenate([got[i] for i in range(a, b)]) if b > a else np.zeros(0, np.uint32)
        out.append((ids, np.split(tokens, np.cumsum(lens)[:-1]) if len(lens) else []))
    return out


# Lower-case letters that the tokenizer's pattern takes as one run, then plain marks that it takes as another.
PLAIN_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])*")
PLAIN_MARKS = b".,;:!?*#$%&|"


IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Masks of the first 0 to 8 bytes of a little-endian word of 64 bits.
LOW_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
FOLD = np.uint64(0x9E3779B97F4A7C15)


def lower_latin(text: bytes) -> bytes:
    """A text of Latin-1 characters in lower case; any other (or with a special string) as it is."""
    if b"<|" in text:
        return text
    if text.isascii():
        return text.lower()
    plain = text.decode()
    try:
        plain.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return plain.lower().encode()


def byte_alphabet() -> dict[int, int]:
    """The printable character that byte-level vocabularies use for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return dict(zip(plain, plain)) | {b: 256 + i for i, b in enumerate(odd)}


class WordRows(dict):
    """Row number of each known word; an unknown one is tokenized when first asked for."""

    def __init__(self, tokenize):
        self.tokenize = tokenize
        self.flat = array("I")            # the ids of all rows
        self.begin = array("q", [0])      # where each row's ids begin; one more than rows

    def __missing__(self, word: bytes) -> int:
        self.flat.extend(self.tokenize(word))
        self.begin.append(len(self.flat))
        row = self[word] = len(self.begin) - 2
        return row


class WordTokenizer:
    """Ids of whole texts by the tokenizers library, each distinct word once.

    For vocabularies that drop white space: words between ASCII white space
    are tokenized on their own. Plain words (lower-case letters, then marks)
    go straight to the library's BPE model, any other through its whole chain.
    """

    #: Bytes of text that are worked at a time.
    RUN_BYTES = 4_000_000

    def __init__(self, path: str, most: int = 700_000):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.model, self.most = self.lib.model, most
        self.alphabet = byte_alphabet()
        self.parts: dict[bytes, array] = {}
        self._clear()

    def _clear(self) -> None:
        self.rows = WordRows(self._word)
        if len(self.parts) > self.most:
            self.parts.clear()

    def _part(self, part: bytes) -> array:
        ids = self.parts.get(part)
        if ids is None:
            ids = self.parts[part] = array("I", [t.id for t in self.model.tokenize(
                part.decode("latin-1").translate(self.alphabet))])
        return ids

    def _word(self, word: bytes):
        letters = word.rstrip(PLAIN_MARKS)
        if letters.isalpha() and letters.islower() or PLAIN_LETTERS.fullmatch(letters):
            if len(letters) == len(word) or not letters:
                return self._part(word)
            return self._part(letters) + self._part(word[len(letters):])
        return self.lib.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids

    def encode(self, texts: list[bytes], end_id: int) -> Iterator[list[np.ndarray]]:
        """The ids of each UTF-8 text, ``end_id`` appended, run by run."""
        i = 0
        while i < len(texts):
            j, size = i + 1, len(texts[i])
            while j < len(texts) and size + len(texts[j]) <= self.RUN_BYTES:
                size += len(texts[j])
                j += 1
            yield self._encode(texts[i:j], end_id)
            i = j

    def _encode(self, texts: list[bytes], end_id: int) -> list[np.ndarray]:
        if len(self.rows) > self.most:
            self._clear()
        lower = [lower_latin(t) for t in texts]
        joined = b" ".join([b"", *lower, b""])
        start, end = word_spans(joined)
        code, first = distinct_words(joined, start, end)
        rows = np.fromiter(map(self.rows.__getitem__, [joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]),
                           np.int64, len(first))
        at = rows[code]
        begin = np.array(self.rows.begin)
        source = begin[at]
        size = begin[at + 1] - source
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = np.array(self.rows.flat, np.uint32)[np.arange(total) + np.repeat(source - (ends - size), size)]
        # words before the end of each text, hence ids before it
        upto = np.searchsorted(start, np.cumsum([1] + [len(t) + 1 for t in lower]))
        upto = np.concatenate(([0], ends))[upto].tolist()
        tail = np.array([end_id], np.uint32)
        return [np.concatenate((ids[a:b], tail)) for a, b in zip(upto, upto[1:])]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word between ASCII white space; the data begin and end with a space."""
    blank = IS_SPACE[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    return edge[::2], edge[1::2]


def distinct_words(data: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word among the distinct ones, and a first place of each.

    Words of up to eight bytes are told apart by these bytes; longer ones (and
    all, if some hold a null byte) by a fold of their blocks and length to 64 bits.
    """
    padded = np.frombuffer(data + bytes(8), np.uint8)
    block = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    size = end - start
    key = block[start] & LOW_BYTES[np.minimum(size, 8)]
    more = np.flatnonzero(size > 8)
    at = 8
    while len(more):
        left = size[more] - at
        fold = (key[more] ^ (key[more] >> np.uint64(29))) * FOLD + np.uint64(at)
        key[more] = (fold ^ (fold >> np.uint64(32))) + (block[start[more] + at] & LOW_BYTES[np.minimum(left, 8)])
        more, at = more[left > 8], at + 8
    long = (size > 8) | (b"\0" in data)
    key[long] = (key[long] ^ (key[long] >> np.uint64(31))) * FOLD ^ size[long].astype(np.uint64)
    code, distinct = pd.factorize(key)
    first = np.empty(len(distinct), np.int64)
    first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
    return code, first


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this worker process (its word cache serves all its tasks)."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class TokenFiles:
    """Where the files of an encoded corpus are."""

    def __init__(self, path: str):
        self.frames, self.table = f"{path}/frames", f"{path}/table"


def encode_corpus(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1, vocab: int = 1 << 16) -> TokenFiles:
    """Write the token ids of doc_id, text under ``path`` (a shared folder)."""
    spark = docs.sparkSession
    prepare(spark)
    kind = np.uint16 if vocab <= 1 << 16 else np.uint32

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(vocab, np.int64)
        tok = word_tokenizer(tokenizer_path)
        for pdf in batches:
            sizes, coded = [], []
            for run in tok.encode([t or b"" for t in pdf["text"]], end_id):
                counts += np.bincount(np.concatenate(run), minlength=vocab)
                sizes.extend(map(len, run))
                coded.extend(ids.astype(kind).tobytes() for ids in run)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n": sizes, "ids": coded, "counts": None})
        yield pd.DataFrame({"doc_id": [None], "n": [None], "ids": [None], "counts": [counts.astype("<i8").tobytes()]})

    schema = "doc_id bigint, n bigint, ids binary, counts binary"
    staged = scratch_path(spark, "token-ids")
    docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInPandas(tokenize, schema).write.option(
        "compression", "zstd").parquet(staged)
    rows = spark.read.schema(schema).parquet(staged)

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(vocab, np.int64)
        for pdf in batches:
            for c in pdf["counts"]:
                counts += np.frombuffer(c, "<i8")
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"symbol": seen, "n": counts[seen]})

    files = TokenFiles(path)
    counted = rows.filter("counts is not null").select("counts").mapInPandas(spread, "symbol bigint, n bigint")
    counted.groupBy("symbol").agg(F.sum("n").alias("n")).coalesce(1).write.parquet(files.table)
    table = read_table(spark, files, vocab)
    tokens = rows.filter("counts is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        done, frame_no = 0, 0
        open_ids: list = []
        open_docs: list[np.ndarray] = []
        frames: list[tuple] = []
        size = waiting = 0

        def flush(last: bool) -> pd.DataFrame:
            nonlocal done, frame_no, open_ids, open_docs, size, waiting
            if open_docs and (last or size >= FRAME_TOKENS):
                frames.append((open_ids, open_docs))
                open_ids, open_docs, size = [], [], 0
            out = []
            for (ids, own), payload in zip(frames, encode_frames(frames, table)):
                n = sum(map(len, own))
                out.append((shard, frame_no, done, len(own), n, payload))
                done, frame_no = done + n, frame_no + 1
            frames.clear()
            waiting = 0
            return pd.DataFrame(out, columns=["shard", "frame", "first", "docs", "tokens", "payload"])

        for pdf in batches:
            for doc, data in zip(pdf["doc_id"].astype(object).where(pdf["doc_id"].notna(), None), pdf["ids"]):
                ids = np.frombuffer(data, kind)
                open_ids.append(doc)
                open_docs.append(ids)
                size += len(ids)
                waiting += len(ids)
                if size >= FRAME_TOKENS:
                    frames.append((open_ids, open_docs))
                    open_ids, open_docs, size = [], [], 0
                if waiting >= BATCH_TOKENS:
                    yield flush(False)
        yield flush(True)

    shards = parts_for(spark, tokens, SHARD_TOKENS)
    (rows.filter("counts is null").select("doc_id", "ids").repartitionByRange(shards, "doc_id")
     .sortWithinPartitions("doc_id", "ids")
     .mapInPandas(write, "shard int, frame int, first bigint, docs int, tokens bigint, payload binary")
     .write.option("compression", "uncompressed").parquet(files.frames))
    return files


def read_table(spark: SparkSession, files: TokenFiles, vocab: int = 1 << 16) -> FrequencyTable:
    """The shared frequency table (at most ``vocab`` rows)."""
    counts = np.zeros(vocab, np.int64)
    for r in spark.read.schema("symbol bigint, n bigint").parquet(files.table).collect():
        counts[r["symbol"]] = r["n"]
    return FrequencyTable(counts)


def decode_corpus(spark: SparkSession, files: TokenFiles, vocab: int = 1 << 16) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files."""
    table = read_table(spark, files, vocab)
    frames = spark.read.schema("shard int, frame int, first bigint, docs int, tokens bigint, payload binary").parquet(files.frames)
    # one row per shard; shards hold millions of tokens each
    ends = frames.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    before = F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = frames.join(ends.select("shard", before.alias("before")), "shard")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for (ids, docs), start in zip(decode_frames(list(pdf["payload"]), table), pdf["start"]):
                for doc, tokens in zip(ids, docs):
                    out.append((doc, int(start), len(tokens), zlib.crc32(tokens.astype("<u4").tobytes())))
                    start += len(tokens)
            yield pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32"]).astype({"doc_id": "Int64"})

    return placed.select((F.col("first") + F.col("before")).alias("start"), "payload").mapInPandas(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
