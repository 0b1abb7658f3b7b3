"""Quality rules with an n-gram perplexity band per language.

1. Spark counts the character n-grams (UTF-16 units, ``ORDER`` of them, texts
   padded with blanks) of all documents per language.  A character model fits
   here: compound words are almost all unique, so word n-grams say nothing.
2. A modified Kneser-Ney model is made from the counts with joins and
   aggregates: lower orders count distinct left contexts, the three discounts
   come from the counts of counts, orders are interpolated.
3. The model stays in tables: joins over the distinct n-grams of the corpus, order by
   order, give each its bits, also under a model that has not seen it (back-off).  Only
   this table of bits is looked up by the texts, n-gram by exact n-gram: a task finds the
   distinct n-grams of a run of texts once.  The table is counted first.  Up to
   ``Bands.most_sent`` rows (20 bytes each) it is sent to the tasks whole; beyond that
   texts are dealt to blocks, each block asks for its distinct n-grams by bucket, and the
   buckets, which hold their part of the table, answer.  Both ways give the same bits.
4. Every document gets its bits per character.  Per language, median and
   spread (MAD) over all documents give the lower and the upper band; the band
   of a short text is wider, as its average is less certain.  Beyond the bands a
   document is rejected: repetitive texts lie below, garbled or
   foreign ones above.
5. A text's own n-grams make it look likely, so it is scored a second time by
   cross-fitting: texts fall in two folds by a hash of the text (equal texts in
   the same), each fold has a model of its own, and a document is scored by that
   of the other fold.  Only texts that pass the base rules and hold few symbols
   and repeats train a fold, so spam does not teach the model what is usual.
   These scores have bands per language and fold, and a document beyond either band is rejected.  Where the other fold has no text of
   the language, the first band decides alone.

Languages are those named by the ``languages`` parameter; all others, and
null, share one model.  Defined results: a null or empty text has no words and
fails the base rules; repeated rows are judged each; ties of the band itself are
kept; texts of any length are scored whole (a text must fit a task's memory some twenty
times over); medians are taken over bits rounded to ``STEPS`` a bit, by exact counts, so runs
agree; an empty table gives no rows; extra columns, whatever their names, are ignored by
``judge`` and kept by ``kept_documents``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved

ORDER = 4
UNIT = 16                                   # bits of a UTF-16 unit; 4 units fill a 64-bit key


@dataclass(frozen=True)
class Bands:
    languages: tuple[str, ...] = ("de", "en", "es", "fr")
    width: float = 6.0          # spreads from the median to a band
    short: float = 1000.0       # characters at which the band is wider by sqrt(2)
    least_spread: float = 0.02  # bits per character
    most_sent: int = 2_000_000  # rows of the table of bits that tasks get whole
    block_bytes: int = 16 << 20  # of text in a block, where the table is larger


# --- base rules ----------------------------------------------------------------

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def repeat_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.uint64)
    if len(number) == len(words):
        return 0
    mixed = _mix(ids, 0)
    h = np.zeros(n, np.uint64)
    for i in range(window):
        h += mixed[i:i + n] * _ODD[i % 5]
    order = np.sort(h)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(h, twice))
    rows = ids[at[:, None] + np.arange(window)]
    _, back, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)   # equal words, not equal hashes
    at = at[count[back.ravel()] > 1]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    text = text or ""
    words = text.encode().split()                       # bytes split at ASCII white space only
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    lines = Counter(x for x in text.split("\n") if x.strip(" \t\v\f\r"))
    return (len(words), chars, sum(map(text.count, "#*$%&|<>")), sum(lines.values()) - len(lines), repeat_words(words))


# --- n-gram keys ---------------------------------------------------------------

def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngram_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams that end in a text's own characters, text after
    text, and the number of them per text."""
    pad = " " * (ORDER - 1)
    units = [np.frombuffer((pad + t).encode("utf-16-le"), "<u2") for t in texts]
    if not units:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    size = np.array([len(u) for u in units]) - (ORDER - 1)
    flat = np.concatenate(units).astype(np.uint64)
    keys = np.zeros(len(flat) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        keys |= flat[i:i + len(keys)] << np.uint64(UNIT * (ORDER - 1 - i))
    inside = np.ones(len(keys), bool)                   # not the windows across two texts
    starts = np.cumsum(size + ORDER - 1)[:-1]
    for i in range(1, ORDER):
        inside[starts - i] = False
    return keys[inside], size


def _language(lang: Column, bands: Bands) -> Column:
    number = F.array_position(F.array(*[F.lit(x) for x in bands.languages]), lang)
    return (F.coalesce(number, F.lit(0))).cast("int")    # 0: all others


def _parts(texts: list[str], chars: int = 4 << 20) -> Iterator[list[str]]:
    """Texts in runs of about ``chars`` characters (a longer text alone), to bound memory."""
    run, held = [], 0
    for t in texts:
        if run and held + len(t) > chars:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t)
    if run:
        yield run


FOLDS = 2


def _fold(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")


def _trains(counts) -> bool:
    """Whether a text of these base counts counts in the model of its fold: at
    most a symbol per ten words, and a tenth of the words in repeats."""
    n_words, _, n_symbols, _, n_repeat = counts
    return bool(n_words >= 10 and 10 * n_symbols <= n_words and 10 * n_repeat <= n_words)


def _fold_counts(docs: DataFrame, bands: Bands) -> DataFrame:
    """``(lang, fold, key, n)``; texts that train no fold have fold ``FOLDS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            kind = [(x, f if _trains(base_counts(t)) else FOLDS) if t else None for x, f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts)]
            for k in sorted({*kind} - {None}):
                for part in _parts([t for t, y in zip(texts, kind) if y == k]):
                    at, keys = pd.factorize(ngram_keys(part)[0])
                    n = np.bincount(at, minlength=len(keys))
                    yield pa.RecordBatch.from_arrays([*[pa.array(np.full(len(n), x, np.int32)) for x in k], pa.array(keys.view(np.int64)),
                                                      pa.array(n.astype(np.int64))], names=["lang", "fold", "key", "n"])

    return (docs.select(_language(F.col("lang"), bands).alias("lang"), _fold(F.col("text")).alias("fold"), "text")
            .mapInArrow(run, "lang int, fold int, key bigint, n bigint").groupBy("lang", "fold", "key").agg(F.sum("n").alias("n")))


def ngram_counts(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """``(lang, key, n)`` over all documents."""
    return _fold_counts(docs, bands).groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _fold_model(lang, fold, bands: Bands):
    """Number by which ``train`` knows the model of a fold; that of all documents has the language's own."""
    return lang + (fold + 1) * (len(bands.languages) + 1)


def _all_counts(docs: DataFrame, bands: Bands) -> DataFrame:
    """``(lang, key, n)`` of the model of all documents and of each fold's."""
    some = saved(_fold_counts(docs, bands), "ngram-folds")
    own = some.where(F.col("fold") < FOLDS).select(_fold_model(F.col("lang"), F.col("fold"), bands).cast("int").alias("lang"), "key", "n")
    return some.groupBy("lang", "key").agg(F.sum("n").alias("n")).union(own)


# --- the model -----------------------------------------------------------------

@dataclass
class Model:
    """Tables of an interpolated model, by order from 1: ``(lang, key, p)`` of the n-grams seen,
    ``(lang, ctx, gamma)`` of their contexts; and log2 of the probability of an unseen character."""
    probs: list[DataFrame]
    backs: list[DataFrame]
    unseen: dict[int, float]

    def bits(self, asked: DataFrame) -> DataFrame:
        """``(lang, key, bits)`` of the last character of each n-gram of ``asked(lang, key)``, given
        those before it.  Languages that the model does not know are left out."""
        asked = asked.where(F.col("lang").isin(*self.unseen)) if self.unseen else asked.limit(0)
        lower = None
        for order in range(1, ORDER + 1):
            own = F.col("key").bitwiseAND(F.lit((1 << UNIT * order) - 1)) if order < ORDER else F.col("key")
            grams = asked.select("lang", own.alias("key")).distinct()
            grams = grams.withColumn("ctx", F.lit(0).cast("bigint") if order == 1 else F.shiftrightunsigned("key", UNIT))
            if lower is None:
                grams = grams.withColumn("p_low", _by_language({k: 2.0 ** v for k, v in self.unseen.items()}))
            else:
                low = F.col("key").bitwiseAND(F.lit((1 << UNIT * (order - 1)) - 1))
                grams = grams.withColumn("low", low).join(lower.select("lang", F.col("key").alias("low"), F.col("p").alias("p_low")), ["lang", "low"])
            got = grams.join(self.backs[order - 1], ["lang", "ctx"], "left").join(self.probs[order - 1], ["lang", "key"], "left")
            p = F.coalesce("p", F.coalesce("gamma", F.lit(1.0)) * F.col("p_low"))
            lower = saved(got.select("lang", "key", p.alias("p")), "ngram-bits")
        return lower.select("lang", "key", (-F.log2("p")).alias("bits"))


def _by_language(values: dict[int, float]) -> Column:
    """The value of the row's language: at most one for each language and fold."""
    return F.get(F.array(*[F.lit(float(values.get(i, 0.0))) for i in range(max(values, default=0) + 1)]), F.col("lang"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """The discounts of counts 1, 2 and 3 or more (a half of the count where a count of counts is 0)."""
    if not min(n1, n2, n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [min(max(x, 0.05), k - 0.05) for k, x in enumerate((1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3), 1)]


def train(counts: DataFrame) -> Model:
    """The modified Kneser-Ney model of ``counts(lang, key, n)``."""
    levels = {ORDER: saved(counts, "ngram-counts")}
    for order in range(ORDER - 1, 0, -1):
        low = F.col("key").bitwiseAND(F.lit((1 << UNIT * order) - 1))
        levels[order] = saved(levels[order + 1].select("lang", low.alias("key")).groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n")), "ngram-counts")
    probs, backs, lower = [], [], None
    unseen: dict[int, float] = {}
    for order in range(1, ORDER + 1):
        grams = levels[order]
        told = grams.groupBy("lang").agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)], F.count(F.lit(1)).alias("kinds")).collect()
        by_lang = {r.lang: discounts(r.n1, r.n2, r.n3, r.n4) for r in told}       # one row per language
        table = F.array(*[F.array(*[F.lit(x) for x in by_lang.get(i, [0.5, 1.0, 1.5])]) for i in range(max(by_lang, default=0) + 1)])
        off = F.get(F.get(table, F.col("lang")), F.least("n", F.lit(3)).cast("int") - 1)
        grams = grams.select("lang", "key", F.shiftrightunsigned("key", UNIT).alias("ctx"), "n", off.alias("off"))
        if order == 1:
            unseen = {r.lang: -float(np.log2(r.kinds + 1)) for r in told}
            grams = grams.withColumn("ctx", F.lit(0).cast("bigint"))
        context = saved(grams.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("gamma")), "ngram-contexts")
        made = grams.join(context, ["lang", "ctx"])
        if lower is None:
            flat = _by_language({k: 2.0 ** v for k, v in unseen.items()})
            made = made.withColumn("p_low", flat)
        else:
            low = F.col("key").bitwiseAND(F.lit((1 << UNIT * (order - 1)) - 1))
            made = made.withColumn("low", low).join(lower.select("lang", F.col("key").alias("low"), F.col("p").alias("p_low")), ["lang", "low"])
        made = saved(made.select("lang", "key", ((F.col("n") - F.col("off")) / F.col("total") + F.col("gamma") * F.col("p_low")).alias("p")), "ngram-probs")
        lower = made
        probs.append(made)
        backs.append(context.select("lang", "ctx", "gamma"))
    return Model(probs, backs, unseen)


# --- scores and bands ------------------------------------------------------------

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCORES = tuple(f"__llm_{x}" for x in (*_COUNTS, "lang", "fold", "n_units", "bits", "held", "trains"))


@dataclass
class Lookup:
    """Bits of n-grams by language: sorted keys, and for each the bits by the model of all
    documents and by those of the folds (NaN where a fold has no text of the language)."""
    keys: dict[int, np.ndarray]
    bits: dict[int, np.ndarray]

    @classmethod
    def of(cls, lang: np.ndarray, keys: np.ndarray, bits: np.ndarray) -> "Lookup":
        out = cls({}, {})
        for x in np.unique(lang).tolist():
            mine = np.flatnonzero(lang == x)
            mine = mine[np.argsort(keys[mine])]
            out.keys[x], out.bits[x] = keys[mine], bits[mine]
        return out

    def scores(self, lang: int, texts: list[str], fold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters, bits by the model of all documents and by that of the other fold, per text."""
        keys, n = ngram_keys(texts)
        at, distinct = pd.factorize(keys)
        got = self.bits[lang][np.searchsorted(self.keys[lang], distinct)].astype(np.float64)      # every n-gram was counted
        starts = np.cumsum(n) - n
        return n, np.add.reduceat(got[at, 0], starts), np.add.reduceat(got[at, 1 + FOLDS - 1 - fold], starts)


def _bits_table(docs: DataFrame, bands: Bands) -> DataFrame:
    """``(lang, key, bits, bits_0, bits_1)`` of every n-gram of ``docs``: by the model of
    all documents and by that of each fold."""
    counts = saved(_all_counts(docs, bands), "ngram-counts")
    every = counts.where(F.col("lang") <= len(bands.languages)).select("lang", "key")
    models = F.explode(F.array(F.col("lang"), *[_fold_model(F.col("lang"), F.lit(f), bands).cast("int") for f in range(FOLDS)]))
    got = train(counts).bits(every.select(models.alias("lang"), "key"))
    size = len(bands.languages) + 1
    one = lambda k: F.max(F.when(F.floor(F.col("lang") / size) == k, F.col("bits"))).cast("float")
    return saved(got.groupBy((F.col("lang") % size).alias("lang"), "key")
                 .agg(one(0).alias("bits"), *[one(f + 1).alias(f"bits_{f}") for f in range(FOLDS)]), "ngram-table")


_BITS = ("bits", *[f"bits_{f}" for f in range(FOLDS)])


def _lookup(table: pa.Table) -> Lookup:
    bits = [table.column(x).to_numpy() for x in _BITS]
    return Lookup.of(table.column("lang").to_numpy(), table.column("key").to_numpy().view(np.uint64),
                     np.stack([np.asarray(b, np.float32) for b in bits], axis=1) if len(table) else np.empty((0, 1 + FOLDS), np.float32))


def _score_columns(texts: list[str], lang: np.ndarray, fold: np.ndarray, look: Lookup) -> list[pa.Array]:
    """The columns ``_SCORES`` of a run of documents."""
    counts = [base_counts(t) for t in texts]
    told = np.array(counts, np.int64).reshape(-1, len(_COUNTS))
    size, total, held = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.full(len(texts), np.nan)
    some = np.array([bool(t) for t in texts], bool)
    for x, f in sorted({*zip(lang[some].tolist(), fold[some].tolist())}):
        mine, at = np.flatnonzero((lang == x) & (fold == f) & some), 0
        for run in _parts([texts[i] for i in mine]):
            part, at = mine[at:at + len(run)], at + len(run)
            size[part], total[part], held[part] = look.scores(x, run, f)
    n = np.maximum(size, 1)
    return [*[pa.array(told[:, i]) for i in range(len(_COUNTS))], pa.array(lang.astype(np.int32)), pa.array(fold.astype(np.int32)), pa.array(size),
            pa.array(total / n, mask=size == 0), pa.array(held / n, mask=np.isnan(held)), pa.array([_trains(c) for c in counts], pa.bool_())]


def _scored(docs: DataFrame, table: DataFrame, bands: Bands) -> DataFrame:
    """``docs`` with base counts, language number, fold, characters, bits per
    character by the model of all documents and by that of the other fold, and
    whether the text trains a fold.  ``table`` holds the bits of all their n-grams."""
    schema = T.StructType([*docs.schema.fields, *[T.StructField(x, T.LongType()) for x in _SCORES[:5]], *[T.StructField(x, T.IntegerType()) for x in _SCORES[5:7]],
                           T.StructField(_SCORES[7], T.LongType()), *[T.StructField(x, T.DoubleType()) for x in _SCORES[8:10]], T.StructField(_SCORES[10], T.BooleanType())])
    told = docs.withColumn(_SCORES[5], _language(F.col("lang"), bands)).withColumn(_SCORES[6], _fold(F.col("text")))
    if table.count() > bands.most_sent:
        return _scored_in_blocks(told, table, bands, schema)
    sent = docs.sparkSession.sparkContext.broadcast(_lookup(table.toArrow()))       # at most most_sent rows
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(text_at).to_pylist()]
            lang, fold = (b.column(b.num_columns - k).to_numpy(zero_copy_only=False) for k in (2, 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], *_score_columns(texts, lang, fold, sent.value)], names=schema.names)

    return told.mapInArrow(run, schema)


# --- scores where the table is too large to be sent ---------------------------------

_BUCKETS_OF = 1_000_003       # a prime: spreads keys whose low bits are alike


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys & np.uint64((1 << 63) - 1)) % np.uint64(_BUCKETS_OF) % np.uint64(buckets)


def _asked(text_at: int, lang_at: int, block_at: int, buckets: int):
    """``(block, bucket, lang, keys)``: the distinct n-grams of each block; the input is sorted by block."""
    def lists(block, texts: dict[int, list[str]]):
        rows = []
        for x, own in sorted(texts.items()):
            keys = np.unique(np.concatenate([pd.factorize(ngram_keys(p)[0])[1] for p in _parts(own)]))
            b = _bucket(keys, buckets)
            rows += [(block, int(k), x, keys[b == k].tobytes()) for k in np.unique(b).tolist()]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
                                           pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.binary())],
                                          names=["block", "bucket", "lang", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts = None, {}
        for b in batches:
            for block, x, t in zip(b.column(block_at).to_pylist(), b.column(lang_at).to_pylist(), b.column(text_at).to_pylist()):
                if block != now:
                    if texts:
                        yield lists(now, texts)
                    now, texts = block, {}
                if t:
                    texts.setdefault(x, []).append(t)
        if texts:
            yield lists(now, texts)
    return run


def _answered(lists: pa.Table, table: pa.Table) -> pa.Table:
    """A bucket's answer to the blocks that asked it: the bits of their n-grams, in their order."""
    look = _lookup(table)
    bits = [look.bits[x][np.searchsorted(look.keys[x], np.frombuffer(k, np.uint64))].tobytes()
            for x, k in zip(lists.column("lang").to_pylist(), lists.column("keys").to_pylist())]
    return pa.table({"block": lists.column("block"), "lang": lists.column("lang"), "keys": lists.column("keys"), "bits": pa.array(bits, pa.binary())})


def _scored_in_blocks(told: DataFrame, table: DataFrame, bands: Bands, schema: T.StructType) -> DataFrame:
    cols, block = told.columns, "__llm_block"
    total = told.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = int(total // bands.block_bytes) + 1
    # the input partition salts texts that many rows share
    dealt = told.withColumn(block, F.pmod(F.xxhash64("text", F.spark_partition_id()), F.lit(n)).cast("int"))
    blocks = dealt.repartition(block).sortWithinPartitions(block)
    lists = blocks.mapInArrow(_asked(cols.index("text"), cols.index(_SCORES[5]), len(cols), n), "block int, bucket int, lang int, keys binary")
    key = F.col("key").bitwiseAND(F.lit((1 << 63) - 1))
    parts = table.withColumn("bucket", (key % _BUCKETS_OF % n).cast("int"))
    answers = lists.groupBy("bucket").cogroup(parts.groupBy("bucket")).applyInArrow(_answer_rows, "block int, lang int, keys binary, bits binary")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint64) for k in right.column("keys").to_pylist()]
        bits = [np.frombuffer(b, np.float32).reshape(-1, 1 + FOLDS) for b in right.column("bits").to_pylist()]
        lang = [np.full(len(k), x) for k, x in zip(keys, right.column("lang").to_pylist())]
        look = Lookup.of(np.concatenate(lang), np.concatenate(keys), np.concatenate(bits)) if keys else Lookup({}, {})
        texts = [t or "" for t in left.column("text").to_pylist()]
        numbers = [left.column(x).to_numpy() for x in _SCORES[5:7]]
        return pa.Table.from_arrays([*left.columns[:len(cols) - 2], *_score_columns(texts, *numbers, look)], names=schema.names)

    return blocks.groupBy(block).cogroup(answers.groupBy("block")).applyInArrow(score, schema)


def _answer_rows(lists: pa.Table, table: pa.Table) -> pa.Table:
    if not len(lists):                                          # n-grams that no block asks for
        return pa.table({"block": pa.array([], pa.int32()), "lang": pa.array([], pa.int32()), "keys": pa.array([], pa.binary()), "bits": pa.array([], pa.binary())})
    return _answered(lists, table)


def _c(name: str) -> Column:
    return F.col(f"__llm_{name}")


STEPS = 10_000       # bits are counted in steps of 1 / STEPS for the medians


def _band(some: DataFrame, bits: str, by: list[str], bands: Bands, name: str) -> DataFrame:
    """``__llm_<name>_median, __llm_<name>_spread`` of the scores ``bits`` for each of ``by``."""
    median = f"__llm_{name}_median"
    steps = (some.where(F.col(bits).isNotNull()).groupBy(*by, F.round(F.col(bits) * STEPS).alias("__llm_step"))
             .agg(F.count(F.lit(1)).alias("__llm_n")))
    steps = saved(steps, "quality-steps")
    mid = steps.groupBy(*by).agg(F.percentile("__llm_step", 0.5, F.col("__llm_n")).alias(median))
    off = steps.join(F.broadcast(mid), by)                       # one row per language and fold
    spread = off.groupBy(*by, median).agg(F.percentile(F.abs(F.col("__llm_step") - F.col(median)), 0.5, F.col("__llm_n")).alias("mad"))
    return spread.select(*by, (F.col(median) / STEPS).alias(median),
                         F.greatest(F.lit(bands.least_spread), F.col("mad") / STEPS * 1.4826).alias(f"__llm_{name}_spread"))


def band_table(scored: DataFrame, bands: Bands) -> DataFrame:
    """Medians and spreads per language and fold: of the bits per character of all
    documents of the language, and of the cross-fitted ones of the texts that train."""
    every = _band(scored, "__llm_bits", ["__llm_lang"], bands, "all")
    held = _band(scored.where(_c("trains")), "__llm_held", ["__llm_lang", "__llm_fold"], bands, "held")
    folds = every.withColumn("__llm_fold", F.explode(F.array(*[F.lit(f) for f in range(FOLDS)])))
    return folds.join(F.broadcast(held), ["__llm_lang", "__llm_fold"], "left")


def _verdict(scored: DataFrame, table: DataFrame, bands: Bands) -> DataFrame:
    got = scored.join(F.broadcast(table), ["__llm_lang", "__llm_fold"], "left")
    wide = bands.width * F.sqrt(1 + F.lit(bands.short) / F.greatest(_c("n_units"), F.lit(1)))
    failed = (_c("n_words") < 10) | (100 * _c("n_repeat_words") > 20 * _c("n_words"))
    inside = F.coalesce(F.abs(_c("bits") - _c("all_median")) <= wide * _c("all_spread"), F.lit(False))
    held = F.coalesce(F.abs(_c("held") - _c("held_median")) <= wide * _c("held_spread"), F.lit(True))
    got = got.withColumn("__llm_failed", failed).withColumn("__llm_kept", ~failed & inside & held)
    for name, low, high in (("all", "low", "high"), ("held", "held_low", "held_high")):
        half = wide * _c(f"{name}_spread")
        got = got.withColumn(f"__llm_{low}", F.pow(2.0, _c(f"{name}_median") - half)).withColumn(f"__llm_{high}", F.pow(2.0, _c(f"{name}_median") + half))
    return got


def judge(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``base_failed``,
    ``kept``, ``perplexity`` and the document's band ``low``, ``high``, and the
    same by the model of the other fold: ``held_perplexity``, ``held_low``, ``held_high``."""
    docs = docs.select("doc_id", "lang", "text")
    scored = saved(_scored(docs, _bits_table(docs, bands), bands).drop("text"), "quality-scores")
    got = _verdict(scored, band_table(scored, bands), bands)
    return got.select("doc_id", *[_c(x).alias(x) for x in _COUNTS], _c("failed").alias("base_failed"), _c("kept").alias("kept"),
                      F.pow(2.0, _c("bits")).alias("perplexity"), _c("low").alias("low"), _c("high").alias("high"),
                      F.pow(2.0, _c("held")).alias("held_perplexity"), _c("held_low").alias("held_low"), _c("held_high").alias("held_high"))


def kept_documents(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that pass.  Texts are scored twice, for the bands and for
    the verdict, rather than written to scratch."""
    bits = _bits_table(docs.select("lang", "text"), bands)
    table = saved(band_table(saved(_scored(docs.select("lang", "text"), bits, bands).drop("text", "lang"), "quality-scores"), bands), "quality-bands")
    return _verdict(_scored(docs, bits, bands), table, bands).where("__llm_kept").select(*docs.columns)


__all__ = ["Bands", "Model", "ORDER", "base_counts", "repeat_words", "ngram_keys", "ngram_counts", "Lookup", "discounts", "train", "band_table",
           "judge", "kept_documents"]
