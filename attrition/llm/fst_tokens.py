"""Token counts by finite-state tokenizer compilation.

Two deterministic transducers are compiled from a byte-level BPE file:

* ``SPLITTER``: twelve states over character classes that cut a text into
  pieces as the byte-level pattern does. Transitions are annotated with the
  piece boundaries they emit (before this character, before the last one).
  Texts are cut into chunks; each chunk's map from every start state to its
  end state is computed side by side, the maps compose through a parallel
  prefix scan, and a second pass with known start states emits.
* ``BpeTransducer``: reads the bytes of a piece; each transition carries the
  signed change of the token count, so the sum along a piece is its count.
  A state is what the future can see: the longest suffix that a token may
  still continue, with the last token and relative count at each position of
  it. States and transitions are built when first met. The last token of
  every prefix follows from the rule that a sequence is an encoding exactly
  when each neighbouring pair is one.

Counts equal the tokenizers library's, special strings inside texts included
(they are cut out and count one each, as is its default).

Documents are independent: no shuffle. A batch is worked in runs of at most
``RUN_CHARS`` characters (or one longer text).

Defined cases: a null text is empty: 0 bytes, 0 tokens; repeated rows give
repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import prepare
from attrition.llm.rans import byte_alphabet

RUN_CHARS = 2_000_000
CHUNK = 256

# Character classes: letters that matter to the endings 's 't 'm 'd 're 've 'll are apart.
LETTER, NUMBER, SPACE, WHITE, QUOTE, OTHER, END_STMD, END_RV, END_L, END_E, STOP = range(11)
# States: start, letter run, number run, other run, white run (one or more; last is a space or not), ...
START, IN_L, IN_N, IN_O, WS1, WW1, WSN, WWN, Q, QR, QL, DONE = range(12)
N_STATES, N_CLASSES = 12, 11


def _open(cls: int) -> int:
    """The state of a piece that begins with a character of this class."""
    return {NUMBER: IN_N, SPACE: WS1, WHITE: WW1, QUOTE: Q, OTHER: IN_O, STOP: START}.get(cls, IN_L)


def compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """(next state, boundaries) by state and class; bit 0: a piece begins here, bit 1: at the last character."""
    nxt = np.zeros((N_STATES, N_CLASSES), np.uint8)
    out = np.zeros((N_STATES, N_CLASSES), np.uint8)
    letters = (LETTER, END_STMD, END_RV, END_L, END_E)
    for cls in range(N_CLASSES):
        for state in range(N_STATES):
            to, cut = _open(cls), 1
            if state == IN_L and cls in letters or state == IN_N and cls == NUMBER:
                cut = 0
            elif state in (IN_O, Q) and cls in (OTHER, QUOTE):
                to, cut = IN_O, 0
            elif state in (WS1, WW1, WSN, WWN):
                if cls in (SPACE, WHITE):
                    to, cut = (WSN if cls == SPACE else WWN), 0
                elif cls != STOP:
                    late = 2 if state in (WSN, WWN) else 0
                    if state in (WS1, WSN):   # the last space joins the piece
                        to, cut = (IN_O if cls == QUOTE else to), late
                    else:
                        cut = late | 1
            elif state == Q and cls in (END_STMD, END_RV, END_L):
                to, cut = {END_STMD: DONE, END_RV: QR, END_L: QL}[cls], 0
            elif state in (QR, QL):
                if cls == (END_E if state == QR else END_L):
                    to, cut = DONE, 0
                else:   # the quote was a piece of its own, the letter began the next
                    cut = 2 | (cls not in letters)
            nxt[state, cls], out[state, cls] = to, cut
    return nxt, out


def scan_states(maps: np.ndarray) -> np.ndarray:
    """Start state of each chunk: exclusive prefix composition of the chunk maps (chunks, states)."""
    total = maps.copy()
    step = 1
    while step < len(total):   # after this round, total[i] composes the 2 * step maps that end at i
        total[step:] = np.take_along_axis(total[step:], total[:-step].astype(np.int64), axis=1)
        step *= 2
    return np.concatenate(([START], total[:-1, START])).astype(np.uint8)


class Splitter:
    def __init__(self):
        nxt, out = compile_splitter()
        self.next = np.ascontiguousarray(nxt.T).ravel()     # index: class * N_STATES + state
        self.out = np.ascontiguousarray(out.T).ravel()

    def boundaries(self, classes: np.ndarray) -> np.ndarray:
        """Positions where a piece (or a stop) begins; the last class must be STOP."""
        n = len(classes)
        chunks = -(-n // CHUNK)
        padded = np.full(chunks * CHUNK, STOP, np.uint8)
        padded[:n] = classes
        steps = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T).astype(np.int16) * N_STATES
        # all start states at once, until they have met
        maps = np.broadcast_to(np.arange(N_STATES, dtype=np.uint8), (chunks, N_STATES)).copy()
        for t in range(CHUNK):
            maps = self.next[steps[t][:, None] + maps]
            if t % 16 == 15 and maps.shape[1] > 1 and (maps == maps[:, :1]).all():
                maps = maps[:, :1]
        state = scan_states(np.broadcast_to(maps, (chunks, N_STATES)))
        flags = np.zeros((CHUNK, chunks), np.uint8)
        for t in range(CHUNK):
            at = steps[t] + state
            flags[t] = self.out[at]
            state = self.next[at]
        flags = flags.T.ravel()
        begins = (flags & 1).astype(bool)
        begins[:-1] |= flags[1:] > 1
        return np.flatnonzero(begins[:n])


class BpeTransducer:
    """Token counts of byte strings; see the module text."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], most: int = 400_000):
        ranks = {bytes([b]): i for i, b in enumerate(range(256))}
        self.parts: list[tuple[int, int] | None] = [None] * 256
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in merges:   # ranks of this class: bytes first, then merges in their order
            i = ranks.get(a + b)
            if i is None:
                i = ranks[a + b] = len(self.parts)
                self.parts.append((ranks[a], ranks[b]))
            self.pairs.setdefault((ranks[a], ranks[b]), i)
        self.ranks = ranks
        self.prefixes = {t[:i] for t in ranks for i in range(1, len(t) + 1)}
        self.most = most
        self._reset()

    def _reset(self) -> None:
        self.fits: dict[tuple[int, int], bool] = {}
        self.keys: list[tuple] = [(b"", (-1,), (0,))]
        self.number: dict[tuple, int] = {self.keys[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _fit(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        known = self.fits.get((left, right))
        if known is not None:
            return known
        a, b, limit, good = left, right, len(self.parts) + 1, True
        while True:
            joined = self.pairs.get((a, b))
            if joined is not None and joined < limit:   # an earlier merge would cross the border
                good = False
                break
            # undo the later of the two tokens' merges
            if a > b:
                limit, split = a, self.parts[a]
                if split:
                    a = split[1]
                    continue
                limit, split = b + 1, self.parts[b]
                if not split:
                    break
                b = split[0]
            else:
                limit, split = b + 1, self.parts[b]
                if split:
                    b = split[0]
                    continue
                limit, split = a, self.parts[a]
                if not split:
                    break
                a = split[1]
        self.fits[left, right] = good
        return good

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """Build the transition of ``state`` on ``byte``."""
        seen, lasts, counts = self.keys[state]
        text = seen + bytes([byte])
        last = count = None
        for i in range(len(text)):   # longest suffix token first
            token = self.ranks.get(text[i:])
            if token is not None and (lasts[i] < 0 or self._fit(lasts[i], token)):
                last, count = token, counts[i] + 1
                break
        assert last is not None and count is not None
        keep = 0
        while keep < len(text) and text[keep:] not in self.prefixes:
            keep += 1
        key = (text[keep:], (*lasts[keep:], last), tuple(c - count for c in (*counts[keep:], count)))
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.keys)
            self.keys.append(key)
        move = self.moves[state << 8 | byte] = (to, count)
        return move

    def count(self, piece: bytes) -> int:
        if len(self.moves) > self.most:
            self._reset()
        state = total = 0
        moves = self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total


class TokenCounter:
    """Counts of whole texts for a byte-level BPE file."""

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("only byte-level BPE with the standard pattern is compiled")
        self.library = Tokenizer.from_file(path).pre_tokenizer
        back = {chr(c): b for b, c in byte_alphabet().items()}

        def raw(token: str) -> bytes:
            return bytes(back[c] for c in token)

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.bpe = BpeTransducer({raw(t): i for t, i in spec["model"]["vocab"].items()}, [(raw(a), raw(b)) for a, b in merges])
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.splitter = Splitter()
        self.classes = np.full(0x110000, 255, np.uint8)
        for cls, chars in ((SPACE, " "), (QUOTE, "'"), (END_STMD, "stmd"), (END_RV, "rv"), (END_L, "l"), (END_E, "e")):
            for c in chars:
                self.classes[ord(c)] = cls
        self.cache: dict[str, int] = {}
        self.most = most

    def _class(self, code: int) -> int:
        """The class of a character, as the library's own pattern treats it."""
        c = chr(code)
        for probe, cls in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(self.library.pre_tokenize_str(probe + c + probe)) == 1:
                return cls
        return WHITE

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        segments, owner = [], []
        extra = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            parts = self.special.split(text) if self.special else [text]
            extra[i] = len(parts) - 1
            segments.extend(parts)
            owner.extend(repeat(i, len(parts)))
        joined = "\n".join(segments) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        classes = self.classes[codes]
        if (classes == 255).any():
            for code in np.unique(codes[classes == 255]):
                self.classes[code] = self._class(int(code))
            classes = self.classes[codes]
        stops = np.cumsum(np.fromiter((len(s) + 1 for s in segments), np.int64, len(segments))) - 1
        classes[stops] = STOP
        begins = self.splitter.boundaries(classes)
        # pieces run to the next begin; those of the stops themselves are dropped
        piece = begins[classes[begins] != STOP]
        ends = np.append(begins, len(codes))[np.searchsorted(begins, piece) + 1]
        if len(self.cache) > self.most:
            self.cache.clear()
        cache = self.cache
        pieces = [joined[a:b] for a, b in zip(piece.tolist(), ends.tolist())]
        for p in set(pieces).difference(cache):
            cache[p] = self.bpe.count(p.encode("utf-8"))
        each = np.fromiter(map(cache.__getitem__, pieces), np.int64, len(pieces))
        text_of = np.asarray(owner, np.int64)[np.searchsorted(stops, piece)]
        return extra + np.bincount(text_of, weights=each, minlength=len(texts)).astype(np.int64)


_COUNTERS: dict[str, TokenCounter] = {}


def token_counter(path: str) -> TokenCounter:
    """The compiled counter of this worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TokenCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of doc_id, text."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = token_counter(tokenizer_path)
        for pdf in batches:
            texts = pdf["text"].tolist()
            ends = np.cumsum([len(t) for t in texts])
            out = []
            i = 0
            while i < len(texts):
                before = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, before + RUN_CHARS, side="right")))
                out.append(counter.counts(texts[i:j]))
                i = j
            yield pdf[["doc_id", "n_bytes"]].assign(n_tokens=np.concatenate(out) if out else np.zeros(0, np.int64))

    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInPandas(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
