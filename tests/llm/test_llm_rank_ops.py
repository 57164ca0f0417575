"""Language mixtures, importance resampling and ranked search against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from attrition.llm import bpa, mixture_lang, resample
from attrition.llm.queries import QUERIES
from attrition.llm.words import words_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, rank int, score string, p int, w int, k_id string, row int"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _docs(spark, rows, parts=None):
    df = spark.createDataFrame([(i, t, lang, 1, "x", 2, 3, "y", 4) for i, t, lang in rows], DOCS)
    return df.repartition(parts) if parts else df


def _items(spark, rows):
    return _docs(spark, rows).withColumnRenamed("doc_id", "item_id")


def _plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


@pytest.mark.parametrize("text", ["", None, "Ab,cD\x00x_y{z}", "ÄÖ ß 1a-2b", "İK ﬁ 漢字 x", "'`@[a" + chr(0x7F) + "b"])
def test_words_equal_the_pattern(text):
    assert [w.decode() for w in words_of(text.encode() if text is not None else None)] == _plain_words(text)


# --- language mixtures ---------------------------------------------------------------

def _languages(seed=5):
    rng = random.Random(seed)
    kinds = {"aa": "abcdei", "bb": "fghijo", "cc": "klmnpu"}
    word = lambda lang: "".join(rng.choices(kinds[lang], k=rng.randint(2, 6)))
    return lambda lang, n: " ".join(word(lang) for _ in range(n))


def _trained(spark, n=240):
    say = _languages()
    rows = [(i, say(lang, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * (n // 3))]
    return say, rows, mixture_lang.train_languages(_docs(spark, rows))


def test_mixture_finds_the_languages_and_their_shares(spark):
    say, _, model = _trained(spark)
    assert model.names == ["aa", "bb", "cc"]
    both = model.proportions(say("aa", 300) + "\n" + say("cc", 100))
    assert set(both) == {"aa", "cc"} and abs(both["aa"] - 0.75) < 0.05
    assert set(model.proportions(say("bb", 200))) == {"bb"}
    three = model.proportions(" ".join(say(x, 200) for x in ("aa", "bb", "cc")))
    assert set(three) == {"aa", "bb", "cc"} and abs(sum(three.values()) - 1) < 1e-9


def test_inference_equals_a_search_over_all_sets_and_shares():
    rng = np.random.default_rng(3)
    for _ in range(20):
        p = rng.dirichlet(np.full(40, 0.3), 3) + 1e-4
        p /= p.sum(1, keepdims=True)
        true = rng.dirichlet(np.full(3, 0.4))
        n = rng.multinomial(400, true @ p).astype(float)
        use = n > 0
        q, m = p[:, use], n[use]
        grid = [(a / 100, b / 100, 1 - (a + b) / 100) for a in range(101) for b in range(101 - a)]
        cost = mixture_lang.PENALTY * np.log1p(m.sum())
        value = lambda s: float(m @ np.log(np.maximum(np.array(s) @ q, 1e-300))) - cost * sum(x > 1e-9 for x in s)
        best = max(map(value, grid))
        found = mixture_lang.infer(q, m)
        assert value([found.get(j, 0.0) for j in range(3)]) >= best - 0.5
        assert abs(sum(found.values()) - 1) < 1e-6


def test_trigrams_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = "Ein Satz, 12 und — ÀÉ漢字!! x" * 9
    whole = mixture_lang.trigrams(text)
    monkeypatch.setattr(mixture_lang, "PIECE", 5)
    parts = mixture_lang.trigrams(text)
    assert all((a == b).all() for a, b in zip(whole, parts)) and whole[1].sum() > 0
    letters = [x for x in re.split(r"[^a-zàé漢字]+", text.lower()) if x]
    assert whole[1].sum() == sum(map(len, letters))   # one trigram around each letter


def test_languages_of_odd_rows(spark):
    say, rows, model = _trained(spark)
    odd = [(None, say("bb", 40), None), (1, None, "aa"), (2, "", "bb"), (3, "12 ... !!", "cc"), (4, "é", None),
           (5, say("aa", 40), "cc"), (5, say("cc", 40), "aa"), (6, say("cc", 20000), None)]
    odd += [odd[0], odd[5]]
    out = sorted(map(tuple, mixture_lang.identify(_docs(spark, odd, 3), model).select("doc_id", "lang_pred", "score").collect()), key=repr)
    by = {}
    for i, lang, score in out:
        assert 0 <= score <= 1
        by.setdefault(i, []).append(lang)
    assert by[None] == ["bb", "bb"] and by[1] == by[2] == by[3] == ["und"] and sorted(by[5]) == ["aa", "aa", "cc"] and by[6] == ["cc"]
    assert by[4][0] in model.names
    empty = mixture_lang.op11_digest(_docs(spark, []))
    assert empty.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"] and empty.count() == 0
    unknown = mixture_lang.op11_digest(_docs(spark, [(i, t, None) for i, t, _ in rows[:9]])).collect()
    assert {r["lang_pred"] for r in unknown} == {"und"}


def test_learning_skips_held_out_rows_and_null_labels(spark):
    say, rows, model = _trained(spark)
    twisted = [(i, t, ("zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang)) for i, t, lang in rows]
    twisted += [(10_000 + i, "xyxy " * 50, None) for i in range(5)] + [(None, "xyxy " * 50, "zz")]
    again = mixture_lang.train_languages(_docs(spark, twisted))
    assert again.names == model.names and np.allclose(again.p, model.p)


def test_language_accuracy_on_held_out_rows(spark):
    out = QUERIES["op11_mixture_language"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    assert len(out) == len(docs) and (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    held = out[out.held_out].merge(docs, on="doc_id")
    assert len(held) > 20 and (held.lang_pred == held.lang).mean() >= 0.97


# --- importance resampling --------------------------------------------------------------

def _brute_resample(docs, target, percent, min_words, buckets=10_000, ngram=1, seed=2024):
    def features(t):
        w = _plain_words(t)
        return w, [" ".join(w[i:i + n]) for n in range(1, ngram + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(t)[1])
    t = Counter(bucket(f) for _, x in target for f in features(x)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets))))
    rows = []
    for i, x in docs:
        words, f = features(x)
        weight = sum(gain(bucket(y)) for y in f)
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    k = percent * len(able) // 100
    drawn = [(i, n, w, s, k + 1) for k, (i, _, n, w, s) in enumerate(able[:k])]
    rest = [(i, n, w, s, None) for i, _, n, w, s in able[k:]] + [(i, n, w, s, None) for i, m, n, w, s in rows if m < min_words]
    return sorted(drawn + rest, key=repr)


def _corpus(seed, n):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "delta-1", "épsilon", "zeta", "漢字", "eta2"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 19, 20, 21, 60]))), "x") for i in range(n)]
    rows += [(None, "alpha " * 25, None), (None, "alpha " * 25, None), (3, None, None), (4, "", "y"), (5, "beta " * 40_000, "z")]
    return rows + rows[10:14] * 3 + [(7, "alpha " * 30, "q")] * 5


@pytest.mark.parametrize("ngram, percent, last, parts", [(1, 10, 4096, 1), (1, 10, 1, 7), (2, 50, 2, 5), (1, 100, 1, 3), (3, 0, 1, 2)])
def test_resampling_equals_brute_force(spark, monkeypatch, ngram, percent, last, parts):
    rows = _corpus(ngram, 120)
    target = [(1, "alpha zeta ZETA 漢字", None), (2, None, None), (None, "eta2 alpha", None)]
    cut = resample.select_cutoff
    monkeypatch.setattr(resample, "select_cutoff", lambda keys, k: cut(keys, k, last))
    out = resample.resample(_docs(spark, rows, parts), _docs(spark, target), percent, ngram=ngram)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = _brute_resample([r[:2] for r in rows], [r[:2] for r in target], percent, 20, ngram=ngram)
    assert sorted(map(tuple, out.collect()), key=repr) == want


def test_selection_finds_every_rank(spark):
    rng = random.Random(1)
    rows = [(rng.randint(-3, 3), 0, rng.randint(0, 4), 1) for _ in range(60)]
    keys = spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in resample.KEY)).repartition(6).cache()
    for k in (1, 2, 17, 30, 59, 60):
        assert resample.select_cutoff(keys, k, 1) == sorted(rows)[k - 1]
    assert resample.select_cutoff(keys, 61, 1) is None
    assert resample.select_cutoff(keys.limit(0), 1, 1) is None


def test_resampling_of_empty_tables(spark):
    none = _docs(spark, [])
    assert resample.resample(none, none).count() == 0
    some = _docs(spark, [(1, "a " * 30, None)])
    assert [r["rank"] for r in resample.resample(some, none, 100).collect()] == [1]


def test_emptied_word_caches_change_nothing(spark, monkeypatch):
    rows = _corpus(9, 40)
    monkeypatch.setattr(resample, "KEPT_WORDS", 2)
    gains = resample._Gains(list(range(10_000)))
    for _ in range(2):
        for w in (b"a", b"b", b"c", b"x" * 100):
            assert gains[w] == zlib.crc32(w) % 10_000
    assert len(gains) <= 2
    out = resample.resample(_docs(spark, rows), _docs(spark, rows[:3]))
    assert out.count() == len(rows)


# --- ranked search ------------------------------------------------------------------------

def _brute_search(docs, items, k=20):
    words = [(i, Counter(w)) for i, t in docs if (w := _plain_words(t))]
    n, total = len(words), sum(sum(c.values()) for _, c in words)
    df = Counter(w for _, c in words for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in words:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(x * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 12 * m))
                    for w, x in Counter(_plain_words(text)).items() if c[w])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed, k, parts, block, docs", [(1, 20, 1, 10 ** 6, 4096), (2, 3, 5, 10 ** 6, 16), (3, 5, 3, 6, 4), (4, 1, 2, 40, 8)])
def test_search_equals_brute_force(spark, monkeypatch, seed, k, parts, block, docs):
    monkeypatch.setattr(bpa, "LEAST_DOCS", docs)
    monkeypatch.setattr(bpa, "MOST_DOCS", docs)
    monkeypatch.setattr(bpa, "FIRST_READ", 2)
    rows = _corpus(seed, 150)
    items = [(1, "alpha ZETA zeta", None), (2, "漢字", None), (3, None, None), (4, "", None), (5, "nowhere", None),
             (None, "eta2 beta alpha épsilon", None), (6, "gamma delta 1", None), (6, "gamma delta 1", None)]
    out = bpa.ranked_search(_docs(spark, rows, parts), _items(spark, items), k, block)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=repr) == _brute_search([r[:2] for r in rows], [r[:2] for r in items], k)


def test_best_positions_stop_early_and_lose_no_tie():
    rng = np.random.default_rng(2)
    n = 4000
    weights = np.array([900, 700, 10], np.int64)
    tfs = [rng.integers(1, 50, n).astype(np.int32) for _ in range(3)]
    tfs[0][:5] = tfs[1][:5] = 60
    terms = [np.arange(3, dtype=np.int32)] * n
    shard = bpa.Shard(list(range(n)), terms, [np.array(x) for x in zip(*tfs)], [100] * n, weights)
    top, read = shard.best(np.arange(3), np.ones(3, np.int64), 4, [])
    assert [t[2] for t in top] == [0, 1, 2, 3] or read < n
    impact = sum(w * (10 ** 9 * t.astype(np.int64) // (1000 * t.astype(np.int64) + 1200)) for w, t in zip(weights, tfs))
    want = sorted(zip((-impact).tolist(), range(n)))[:4]
    assert [(t[0], t[2]) for t in top] == want and read < n // 4


def test_search_of_empty_tables(spark):
    some = _docs(spark, [(1, "a b", None)])
    assert bpa.ranked_search(_docs(spark, []), _items(spark, [(1, "a b", None)])).count() == 0
    assert bpa.ranked_search(some, _items(spark, [])).count() == 0
    assert bpa.ranked_search(some, _items(spark, [(1, "...", None)])).count() == 0


def test_length_factors_do_not_overflow():
    n_docs, n_terms, n = 3 * 10 ** 10, 10 ** 13, 10 ** 9
    assert 75 + bpa.LENGTH_PERCENT * n * n_docs // n_terms == 75 + 75_000_000
