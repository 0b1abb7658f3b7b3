"""Quality rules: base counts and the Kneser-Ney model against plain Python."""

import base64
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shardloom.llm import quality_perplexity as Q
from shardloom.llm.catalog import LLM_QUERIES

from ..conftest import SF_MID
from .conftest import DOCS, ROWS, doc


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    many = Counter(windows)
    covered = {j for i, x in enumerate(windows) if many[x] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


class PlainModel:
    """Modified Kneser-Ney on strings, by the formula."""

    def __init__(self, texts, order=Q.ORDER):
        self.order = order
        top = Counter(t2[i:i + order] for t in texts if t for t2 in [" " * (order - 1) + t] for i in range(len(t)))
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.off, self.total, self.mass = {}, {}, {}
        for k, c in self.counts.items():
            n = Counter(c.values())
            self.off[k] = Q.discounts(n[1], n[2], n[3], n[4])
            self.total[k], self.mass[k] = defaultdict(int), defaultdict(float)
            for g, v in c.items():
                self.total[k][g[:-1]] += v
                self.mass[k][g[:-1]] += self.off[k][min(v, 3) - 1]

    def p(self, gram):
        p = 1 / (len(self.counts[1]) + 1)
        for k in range(1, self.order + 1):
            g = gram[self.order - k:]
            ctx = g[:-1]
            if ctx not in self.total[k]:
                break
            v = self.counts[k].get(g, 0)
            own = (v - self.off[k][min(v, 3) - 1]) / self.total[k][ctx] if v else 0.0
            p = own + self.mass[k][ctx] / self.total[k][ctx] * p
        return p

    def bits(self, text):
        t = " " * (self.order - 1) + text
        return -sum(math.log2(self.p(t[i:i + self.order])) for i in range(len(text))) / len(text)


def test_base_counts():
    rng = random.Random(2)
    texts = [r[1] for r in ROWS if r[1] is None or len(r[1]) < 5000]
    texts += ["a a a a a a", "x\ny\nx\n \n\n x\nx", "a b c d e f a b c d e", "  # *$%&|<> \x85 b\xa0c", "1 2 3 4 5\n1 2 3 4 5\n1 2 3 4 6"]
    texts += [" ".join(rng.choice("ab c d e f".split()) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for t in texts:
        assert Q.base_counts(t) == plain_counts(t), t


def test_scores_equal_the_plain_model(spark):
    docs = [r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").orderBy("doc_id").limit(80).collect()]
    rows = [doc(r.doc_id, r.text, r.lang) for r in docs] + [doc(900, "null language text", None), doc(901, "other one", "zz")]
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")).collect()}
    named = Q.Bands().languages
    groups = defaultdict(list)
    for r in rows:
        groups[r[2] if r[2] in named else None].append(r[1])
    models = {k: PlainModel(v) for k, v in groups.items()}
    for r in rows:
        want = models[r[2] if r[2] in named else None].bits(r[1])
        assert abs(math.log2(got[r[0]].perplexity) - want) < 0.01, r[0]


def test_unseen_ngrams_back_off(spark):
    texts = ["the cat sat on the mat and the dog sat on the log " * 3, "a bird sang in the tree near the house"]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    model, plain = Q.train(Q.ngram_counts(df)), PlainModel(texts)
    lang = Q.Bands().languages.index("en") + 1
    for t in ("the cow sat", "zzz qqq", "on the house"):
        keys, n = Q.ngram_keys([t])
        asked = spark.createDataFrame([(lang, k) for k in keys.view(np.int64).tolist()], "lang int, key bigint")
        bits = {r.key: r.bits for r in model.bits(asked).collect()}
        assert abs(np.mean([bits[k] for k in keys.view(np.int64).tolist()]) - plain.bits(t)) < 0.0001
        assert n.tolist() == [len(t)]
    assert model.bits(spark.createDataFrame([(lang + 1, 7)], "lang int, key bigint")).count() == 0


def test_bands_keep_plain_text_and_reject_the_rest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'de'").select("doc_id", "text", "lang")
    rng = random.Random(4)
    noise = [(-1 - i, " ".join("".join(chr(rng.randint(33, 126)) for _ in range(7)) for _ in range(200)), "de") for i in range(5)]
    cycle = [(-11 - i, " ".join(f"der die {k}" for k in range(400)), "de") for i in range(5)]
    got = {r.doc_id: r for r in Q.judge(docs.union(spark.createDataFrame(noise + cycle, docs.schema))).collect()}
    assert not any(got[x[0]].kept for x in noise + cycle)
    clean = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1").collect()} & set(got)
    fine = [got[i].kept for i in clean if not got[i].base_failed]
    assert len(fine) > 100 and np.mean(fine) > 0.95
    assert all(not r.kept for r in got.values() if r.base_failed)
    assert all(r.low <= r.perplexity <= r.high for r in got.values() if r.kept)


def test_odd_rows(spark, odd_docs, no_docs):
    got = Q.judge(odd_docs).collect()
    assert len(got) == len(ROWS)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((str(r.doc_id), *(r[n] for n in names)) for r in got) == sorted((str(r[0]), *plain_counts(r[1])) for r in ROWS)
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) for r in got)
    assert not any(r.kept for r in got if r.base_failed)
    kept = Q.kept_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    assert Q.judge(no_docs).count() == 0 and Q.kept_documents(no_docs).count() == 0


def test_query_counts(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    rows = LLM_QUERIES["op4_quality_perplexity"](spark, SF_MID).collect()
    assert len(rows) == len(text)
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text[r.doc_id]) for r in rows)


def test_many_ngrams_do_not_share_values():
    """Each of a million n-grams has its own place, whatever bucket it is in."""
    keys = np.unique(np.random.default_rng(7).integers(0, 1 << 63, 1_000_000).astype(np.uint64))
    bits = np.arange(len(keys) * 3, dtype=np.float32).reshape(-1, 3)
    look = Q.Lookup.of(np.repeat([1, 2], [len(keys), len(keys)]), np.concatenate([keys, keys[::-1]]), np.concatenate([bits, -bits[::-1]]))
    assert (look.keys[1] == keys).all() and (look.bits[1] == bits).all() and (look.bits[2] == -bits).all()
    share = np.bincount(Q._bucket(keys, 64).astype(int), minlength=64) / len(keys)
    assert share.max() < 2 / 64


def test_a_table_too_large_to_send_gives_the_same_scores(spark, odd_docs):
    """By blocks and buckets, as beyond ``most_sent``: the same rows."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang", "text").limit(300)
    odd = odd_docs.select("doc_id", "lang", "text")
    for some in (docs, odd, docs.limit(0)):
        one, other = (sorted(map(str, Q.judge(some, b).collect())) for b in (Q.Bands(), Q.Bands(most_sent=0, block_bytes=50_000)))
        assert one == other
    kept = [sorted(map(str, Q.kept_documents(odd_docs, b).collect())) for b in (Q.Bands(), Q.Bands(most_sent=0, block_bytes=50_000))]
    assert kept[0] == kept[1]


@pytest.mark.parametrize("share", [0.001, 0.004, 0.016, 0.05])
def test_noise_is_rejected_at_any_share(spark, share):
    """Noise does not vouch for itself, however much of it there is."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'en'").select("doc_id", "text", "lang").orderBy("doc_id").limit(3000)
    rng = random.Random(6)
    word = lambda: "".join(chr(rng.randint(33, 126)) for _ in range(7))
    noise = [(-1 - i, " ".join(word() for _ in range(60 if i % 2 else 200)), "en") for i in range(int(3000 * share))]
    noise += [(-2000 - i, " ".join(base64.b64encode(rng.randbytes(60)).decode() for _ in range(40)), "en") for i in range(max(1, int(1500 * share)))]
    both = docs.union(spark.createDataFrame(noise + noise[:1], docs.schema))                # one of them twice
    got = Q.judge(both).collect()
    assert [r.doc_id for r in got if r.doc_id < 0 and r.kept] == []
    assert all(r.held_low <= r.held_perplexity <= r.held_high for r in got if r.kept)
    clean = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1").collect()}
    fine = [r.kept for r in got if r.doc_id in clean and not r.base_failed]
    assert len(fine) > 100 and np.mean(fine) > 0.95


def test_symbol_spam_does_not_train(spark):
    """Words hung with symbols are beyond the band, though a twentieth of the texts are such."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang = 'de'").select("doc_id", "text", "lang").limit(1000)
    rng = random.Random(8)
    words = [w for r in docs.limit(50).collect() for w in (r.text or "").split()]
    spam = [(-1 - i, " ".join(rng.choice(words) + rng.choice(["###", "$$$", "%%%"]) for _ in range(150)), "de") for i in range(50)]
    got = {r.doc_id: r for r in Q.judge(docs.union(spark.createDataFrame(spam, docs.schema))).collect()}
    assert not any(got[x[0]].base_failed or got[x[0]].kept for x in spam)
