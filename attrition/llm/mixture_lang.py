"""Language identification by mixture inference over n-gram likelihoods.

Every language has a distribution over hashed letter trigrams (words padded
by a mark at both ends). A document is a mixture of languages: its proportions
are those that maximise the likelihood of its trigrams, found by
expectation-maximisation. Which languages take part is chosen by penalised
likelihood: starting from the likeliest single language, one is added where
the likelihood rises by more than ``PENALTY * ln(1 + trigrams)``, and one is
dropped where it falls by less. The log-likelihood is concave in the
proportions, so its slope towards a language bounds what adding it can bring;
languages whose bound is below the penalty are passed over without a trial.

The trigram counts come from labelled rows outside the held-out fold, at most
some ``SAMPLE_ROWS`` of each language by a hash of doc_id; they are summed in
Spark, and the model, one row of ``BUCKETS`` numbers for each language, is
broadcast. Texts are worked whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0
and no proportions, and so is every text where nothing could be learned; a
null lang, and rows with a null doc_id, are not learned from; a null doc_id is
not held out; ties go to the first language in code point order; equal texts
get equal results, wherever they stand; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import prepare

#: Expected bound on the labelled rows of each language that are learned from.
SAMPLE_ROWS = 4000
BUCKETS = 1 << 15
#: Count that every trigram bucket has in every language besides those seen.
SMOOTH = 0.1
PENALTY = 6.0
ROUNDS = 60
#: Letters worked at once.
PIECE = 1 << 20
#: Languages that one broadcast model may have (256 MB of numbers).
MOST_LANGUAGES = 2048
UND = "und"


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text's letter trigrams and how often each occurs."""
    text, letter = text.lower(), _letters()
    tail, parts = np.zeros(1, np.uint64), []
    for i in range(0, len(text), PIECE):
        x = np.frombuffer(text[i:i + PIECE].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        x = np.concatenate((tail, x * letter[x]))
        if i + PIECE >= len(text):
            x = np.append(x, np.uint64(0))
        keep = x != 0   # of other characters one stays after a letter
        keep[1:] |= x[:-1] != 0
        keep[:len(tail)] = True
        x = x[keep]
        tail = x[-2:]
        a, b, c = x[:-2], x[1:-1], x[2:]
        h = (a * np.uint64(0x9E3779B97F4A7C15) ^ b * np.uint64(0xC2B2AE3D27D4EB4F)) + c * np.uint64(0x165667B19E3779F9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        parts.append(((h >> np.uint64(32)) % np.uint64(buckets))[b != 0].astype(np.int64))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(parts), return_counts=True)


def mixture(p: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Proportions of the rows of ``p`` that maximise sum(n * log(proportions @ p)), by EM, and that value."""
    share, total, last = start, n.sum(), -np.inf
    for _ in range(rounds):
        mix = share @ p
        now = float(n @ np.log(mix))
        if now - last < 1e-4:
            break
        last = now
        share = share * (p @ (n / mix)) / total
    return share, float(n @ np.log(share @ p))


def infer(p: np.ndarray, n: np.ndarray, penalty: float = PENALTY) -> dict[int, float]:
    """Languages (rows of the likelihoods ``p`` of the document's trigrams) and their proportions."""
    cost = penalty * np.log1p(n.sum())
    single = np.log(p) @ n
    chosen = [int(single.argmax())]
    share, value = np.ones(1), float(single.max())
    while True:
        slope = p @ (n / (share @ p[chosen])) - n.sum()
        slope[chosen] = -np.inf
        for j in np.argsort(-slope, kind="stable"):
            if slope[j] <= cost:   # no trial can pay
                return dict(zip(chosen, share.tolist()))
            more = [*chosen, int(j)]
            tried, reached = mixture(p[more], n, np.append(share * 0.8, 0.2))
            if reached - value > cost:
                chosen, share, value = more, tried, reached
                break
        else:
            return dict(zip(chosen, share.tolist()))
        while len(chosen) > 2:   # a language that others have made superfluous goes
            k = int(share[:-1].argmin())
            fewer = chosen[:k] + chosen[k + 1:]
            tried, reached = mixture(p[fewer], n, np.delete(share, k) / (1 - share[k]) if share[k] < 1 else np.full(len(fewer), 1 / len(fewer)))
            if value - reached >= cost:
                break
            chosen, share, value = fewer, tried, reached


class LanguageModel:
    """Names in code point order and trigram probabilities, one row each."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        self.p = (counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * counts.shape[1])

    def proportions(self, text: str | None) -> dict[str, float]:
        """Language -> proportion (none without a letter or a language)."""
        at, n = trigrams(text, self.p.shape[1]) if text and len(self.names) else ((), ())
        return {self.names[j]: s for j, s in infer(self.p[:, at], n).items()} if len(at) else {}


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_languages(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, buckets: int = BUCKETS) -> LanguageModel:
    """Learn from doc_id, text, lang of the rows that are not held out."""
    prepare(docs.sparkSession)
    able = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = able.groupBy("lang").agg(F.count("*").alias("size")).limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return LanguageModel([], np.zeros((0, buckets)))
    parts = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], -(-r["size"] // sample_rows))])
    sample = able.filter(F.pmod(F.xxhash64("doc_id"), parts[F.col("lang")]) == 0)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                at, n = trigrams(text, buckets)
                sums.setdefault(lang, np.zeros(buckets, np.int64))[at] += n
        for lang, total in sums.items():
            used = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": used, "n": total[used]})

    rows = (sample.select("lang", "text").mapInPandas(count, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((len(names), buckets))
    at = rows["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(np.int64)
    counts[at, rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return LanguageModel(names, counts)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (the proportion of lang_pred) and proportions of each row of doc_id, text."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, proportions map<string, double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            found = shared.value.proportions(text)
            best = min(found, key=lambda x: (-found[x], x)) if found else UND
            rows.append((best, min(1.0, found.get(best, 0.0)), found))
        return pd.DataFrame(rows, columns=["lang_pred", "score", "proportions"])

    return docs.select("doc_id", predict(F.col("text")).alias("p")).select("doc_id", "p.*")


def op11_digest(docs: DataFrame) -> DataFrame:
    found = identify(docs, train_languages(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "proportions")
