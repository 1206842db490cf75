"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of words.

Words are what ASCII blanks part, as they stand: capitals, digits and all letters count.  The model
is of word bigrams with an edge before and after each text; its tables grow with the trusted text
and stay in Spark.  Below the single words stands their spelling, so that unknown words have a
probability too: characters, mapped to ``SYMBOLS`` symbols, under a Kneser-Ney model of order
``ORDER`` with at most SYMBOLS ** ORDER entries, which goes to every task.  The characters of a symbol share its
probability evenly, and a word ends with a blank.

The logarithm of p(w | v) is a sum: the spelling of w, a gain if w is known, the weight that v
passes down if v is known, and a gain if both were seen together.  The bits of a document are
therefore the sum of its spelling, found in its own task, and of one value per distinct n-gram:
rows of (document, n-gram, count) are joined to the values, sharded by n-gram.  The values of at
most ``HOT`` most frequent n-grams are added in the task instead, so that no frequent word meets
in one place, and a Bloom filter of bounded size leaves out most n-grams the model does not know.

Both sides are worked on in ``SLICES`` parts by the hash of the word or n-gram, some after the others:
n-grams are written compactly, a folder for each part, those of a text as lists, and what a part shuffles is removed before the
next one starts.  Texts are scored in ``PORTIONS`` by a hash, each with all parts of the model, as
their n-grams take more room than anything else.  So the disk in use is that of the model and of the
n-grams of a portion, with a part of the shuffles beside it.

Words backing off to single words do not see what a capital or a number follows, so the word
model is interpolated log-linearly, in equal parts, with the running characters of the text.  A
document's score is bits per word, the end included, its perplexity 2 to that power.  It is kept if the score
is at most the quantile ``quantile`` in its language (of all languages where it has none) of the
trusted documents held out of the training, one in ``HELD_OUT``: documents a model has seen
score better than others like them.  Quantiles are found on a histogram of bins of ``BIN`` bits.

Defined cases: null or empty text has a null perplexity and is not kept; without trusted text all
other documents are kept; a null language is a language of its own; repeated rows each give their
row; a document with several labels is trusted if all of them are.

Texts are read whole, however long; only the named columns are read, whatever others are called;
``keep_good`` returns all columns and picks a name of its own that the table does not have.
"""

from __future__ import annotations

import string
import unicodedata
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.llm import bloom
from crestline.llm.common import discard, fresh, materialize, read_table, release, small_batches
from crestline.llm.shingles import word_hashes
from crestline.llm.spans import mix64

SYMBOLS = 64
ORDER = 3
QUANTILE = 0.995
HELD_OUT = 4
BIN = 0.002
CHUNK = 1 << 20
HOT = 1 << 20
_PART_BITS = 3
SLICES = 1 << _PART_BITS
PORTIONS = 3  # of the texts that are scored
FEW = 5 << 20  # n-grams for which a query of their own does not pay
AT_MOST = 3  # parts of the model in one query
_MARKS = " .,;:!?'\"()-|/%"
BLANK = 29
_STEP = np.uint64(0x9E3779B97F4A7C15)
_EDGES = np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)  # before and after a text


@cache
def symbol_table() -> np.ndarray:
    """Symbol of every code point: 0 the edge of a text, then by kind."""
    table = np.zeros(0x110000, np.uint8)
    code = np.arange(0x110000)
    table[:] = 52 + code % 4  # what is neither letter, digit nor blank
    for c in range(128, 0x3000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            table[c] = 44 + ord(chr(c).lower()[0]) % 8
    table[0x3000:0xFB00] = 56 + code[0x3000:0xFB00] % 8
    for i, c in enumerate(string.ascii_lowercase):
        table[ord(c)] = 1 + i
    for c in string.ascii_uppercase:
        table[ord(c)] = 27
    for c in string.digits:
        table[ord(c)] = 28
    for i, c in enumerate(_MARKS):
        table[ord(c)] = 29 + i
    table[[9, 10, 11, 12, 13]] = 29 + len(_MARKS) - 15  # line breaks are blanks
    return table


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram codes of all symbols of some texts, each with edges before it; symbols per text."""
    pad = np.zeros(ORDER - 1, np.uint8)
    parts, sizes = [], []
    for t in texts:
        s = symbol_table()[np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4")]
        sizes.append(len(s))
        parts += [pad, s]
    s = np.concatenate(parts).astype(np.uint32) if parts else np.zeros(0, np.uint32)
    n = len(s) - ORDER + 1
    code = np.zeros(max(n, 0), np.uint32)
    for k in range(ORDER):
        code = code * np.uint32(SYMBOLS) + s[k : k + n]
    # Codes that reach over the end of a text into the edges of the next are not of any text.
    size = np.array(sizes, np.int64)
    ends = np.cumsum(size + ORDER - 1)
    keep = np.ones(len(code), bool)
    for e in ends[:-1].tolist():
        keep[e - ORDER + 1 : e] = False
    return code[keep], size


def _groups(texts: list[str | None]):
    """Texts in runs of bounded volume; a longer text is a run of its own."""
    run, volume = [], 0
    for t in texts:
        if run and volume + len(t or "") > CHUNK:
            yield run
            run, volume = [], 0
        run.append(t)
        volume += len(t or "")
    if run:
        yield run


@dataclass(frozen=True)
class Model:
    """Probabilities: discounted ones of seen n-grams, and the weight each context passes down."""

    lower: np.ndarray  # of order ORDER - 1, for every n-gram
    weight: np.ndarray  # of every context of ORDER - 1 symbols
    seen: np.ndarray  # codes of order ORDER
    share: np.ndarray  # their discounted probability

    def bits(self) -> np.ndarray:
        """Bits of every n-gram of the full order."""
        context = SYMBOLS ** (ORDER - 1)
        low = self.lower.reshape(-1, SYMBOLS)
        dense = np.empty((context, SYMBOLS), np.float32)
        for at in range(0, context, len(low)):  # the lower contexts repeat
            np.multiply(self.weight[at : at + len(low), None], low, out=dense[at : at + len(low)], casting="unsafe")
        flat = dense.reshape(-1)
        flat[self.seen] += self.share
        np.log2(flat, out=flat)
        return np.negative(flat, out=flat)


def score(bits: np.ndarray, texts: list[str | None]) -> list[float | None]:
    out: list[float | None] = []
    for run in _groups(texts):
        code, size = codes(run)
        sums = np.zeros(len(code) + 1)
        np.cumsum(bits[code], dtype=np.float64, out=sums[1:])
        ends = np.cumsum(size)
        total = sums[ends] - sums[ends - size]
        out += [round(t / n, 6) if n else None for t, n in zip(total.tolist(), size.tolist())]
    return out


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of an order, from how many n-grams occur once to four times."""
    n = [0] * 5
    for c, rows in counts.where("c <= 4").groupBy("c").count().collect():
        n[int(c)] = rows
    if not n[1]:
        return [0.5, 0.5, 0.5]
    y = n[1] / (n[1] + 2 * n[2])
    d = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
    return [min(max(x, 0.1), k) for x, k in zip(d, (1, 2, 3))]


def _order(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Discounted probability of each n-gram (code, c), and the weight of each context."""
    d1, d2, d3 = _discounts(counts)
    off = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    context = F.floor(F.col("code") / SYMBOLS)
    totals = counts.groupBy(context.alias("context")).agg(F.sum("c").alias("total"), F.sum(off).alias("off"))
    shares = counts.withColumn("context", context).join(totals.select("context", "total"), "context").select(
        "code", (F.greatest(F.col("c") - off, F.lit(0.0)) / F.col("total")).alias("share")
    )
    return shares, totals.select("context", (F.col("off") / F.col("total")).alias("weight"))


def _numpy(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    table = df.toArrow()
    return table.column(0).to_numpy().astype(np.int64), table.column(1).to_numpy().astype(np.float64)


def fit(trusted: DataFrame, text: str = "text") -> Model | None:
    """A model of all trusted texts, or none without any."""
    spark = trusted.sparkSession
    small_batches(spark)

    def count(batches):
        # One cell per n-gram is bounded; only those that occur leave the task.
        seen = np.zeros(SYMBOLS**ORDER, np.int32)
        for b in batches:
            for run in _groups(b.column(0).to_pylist()):
                code, n = np.unique(codes(run)[0], return_counts=True)
                seen[code] += n.astype(np.int32)
        code = np.flatnonzero(seen)
        for at in range(0, len(code), 1 << 16):
            part = code[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(seen[part].astype(np.int64))], names=["code", "n"])

    named = trusted.select(F.col(text).alias("text")).where("text is not null")
    counts = materialize(
        named.mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("c")), "quality-counts"
    )
    lower = np.full(SYMBOLS, 1.0 / SYMBOLS)
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # in how many contexts the n-gram continues one
        longer = by_order[k + 1]
        by_order[k] = materialize(
            longer.groupBy((F.col("code") % SYMBOLS**k).alias("code")).agg(F.count(F.lit(1)).alias("c")), "quality-counts"
        )
    for k in range(1, ORDER + 1):
        shares, weights = _order(by_order[k])
        seen, share = _numpy(shares)
        if not len(seen):
            return None
        context, w = _numpy(weights)
        weight = np.ones(SYMBOLS ** (k - 1))
        weight[context] = w
        if k == ORDER:
            return Model(lower, weight, seen, share.astype(np.float32))
        below = lower if k > 1 else np.full(SYMBOLS, 1.0 / SYMBOLS)
        dense = weight[:, None] * below.reshape(-1, SYMBOLS)[np.arange(len(weight)) % max(1, len(below) // SYMBOLS)]
        dense.reshape(-1)[seen] += share
        lower = dense.reshape(-1)
    return None


@cache
def symbol_bits() -> np.ndarray:
    """Bits that tell a character from the others of its symbol, blanks none."""
    out = np.log2(np.maximum(np.bincount(symbol_table(), minlength=SYMBOLS), 1))
    out[BLANK] = 0
    return out


def symbols(texts: list[str | None]) -> np.ndarray:
    """Symbols of all texts in turn, a blank after each."""
    return symbol_table()[np.frombuffer("".join((t or "") + " " for t in texts).encode("utf-32-le", "surrogatepass"), "<u4")]


def spelling(bits: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Bits to spell each word of texts given as ``symbols``, from nothing before it to the blank after it."""
    code, back = s.astype(np.uint32), s
    for k in range(1, ORDER):  # nothing but blanks is before a word
        before = np.full(len(s), BLANK, np.uint8)
        before[k:] = s[: len(s) - k]
        if k > 1:
            before[back == BLANK] = BLANK
        back = before
        code += back.astype(np.uint32) * np.uint32(SYMBOLS**k)
    edge = np.flatnonzero(np.diff((s == BLANK).view(np.int8), prepend=1))
    if not len(edge):
        return np.zeros(0)
    edge[1::2] += 1  # the blank after a word is a part of it
    return np.add.reduceat(np.append(bits[code] + symbol_bits()[s], 0), edge)[::2]


def running(bits: np.ndarray, s: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bits of the running characters of each text, given as ``symbols``, and their numbers."""
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    code = s.astype(np.uint32)
    for k in range(1, ORDER):
        before = np.zeros(len(s), np.uint32)
        before[k:] = s[: len(s) - k]
        for j in range(k):  # the edge of a text
            before[np.minimum(starts + j, ends)] = 0
        code += before * np.uint32(SYMBOLS**k)
    own = bits[code]
    own[ends] = 0  # the blanks between texts
    sums = np.zeros(len(s) + 1)
    np.cumsum(own, dtype=np.float64, out=sums[1:])
    return sums[ends] - sums[starts]


def end_bits(bits: np.ndarray) -> float:
    """Bits to spell the end of a text, a word without letters."""
    return float(bits[sum(BLANK * SYMBOLS**k for k in range(ORDER))])


def part_of(hashes: np.ndarray) -> np.ndarray:
    """Which of the parts a hash is in: its highest bits."""
    return (hashes.view(np.uint64) >> np.uint64(64 - _PART_BITS)).astype(np.int32)


def _part(name: str) -> Column:
    return F.shiftrightunsigned(name, 64 - _PART_BITS)


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def pair_keys(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix64(mix64(v) * _STEP + w)


def word_rows(bits: np.ndarray, run: list[str | None], s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts in turn with both edges of each, the bits to spell them, texts' numbers."""
    hashed, counts = word_hashes([(t or "").encode("utf-8", "surrogatepass") for t in run])
    text = np.repeat(np.arange(len(run)), counts + 2)
    last = np.cumsum(counts + 2) - 1
    inner = np.ones(len(text), bool)
    inner[last] = inner[last - counts - 1] = False
    words, cost = np.empty(len(text), np.uint64), np.zeros(len(text))
    words[inner], cost[inner] = hashed, spelling(bits, s)
    words[last - counts - 1], words[last] = _EDGES
    cost[last] = end_bits(bits)
    return words, cost, text


@dataclass(frozen=True)
class Words:
    """The model: spelling, bits to leave the known words, and tables (gram, gain) of n-grams."""

    spell: Model
    leave: float
    parts: list[DataFrame]  # a table for each part: pairs by their second word, single words by themselves
    hot: tuple[np.ndarray, np.ndarray]  # the most frequent n-grams in order, and their gains
    known: np.ndarray  # Bloom filter of all others

    @property
    def gains(self) -> DataFrame:
        return _all(self.parts)


def _gain(share: Column, below: Column) -> Column:
    """Bits won by a discounted share over the bits it has without it."""
    more = F.log2(share) + below
    return F.when(share > 0, F.when(more > 50, more).otherwise(F.log2(1 + F.pow(F.lit(2.0), more)))).otherwise(0.0)


def fit_words(trusted: DataFrame, text: str = "text") -> Words | None:
    """A model of all trusted texts, or none without any."""
    spell = fit(trusted, text)
    if spell is None:
        return None
    spark = trusted.sparkSession
    release(spark)
    shared = spark.sparkContext.broadcast(spell)

    def count(batches):
        bits = shared.value.bits()
        for b in batches:
            for run in _groups(b.column(0).to_pylist()):
                words, cost, text = word_rows(bits, run, symbols(run))
                pair = np.flatnonzero(text[1:] == text[:-1])
                _, at, n = np.unique(pair_keys(words[pair], words[pair + 1]), return_index=True, return_counts=True)
                own = pair[at]
                # The bits of a word once a run.
                again = np.ones(len(own), bool)
                again[np.unique(words[own + 1], return_index=True)[1]] = False
                cols = [words[own].view(np.int64), words[own + 1].view(np.int64), n.astype(np.int64)]
                cols = [*map(pa.array, cols), pa.array(cost[own + 1], mask=again), pa.array(part_of(words[own + 1]))]
                yield pa.RecordBatch.from_arrays(cols, names=["v", "w", "n", "cost", "part"])

    def name(batches):
        for b in batches:
            v, w = (b.column(c).to_numpy().view(np.uint64) for c in ("v", "w"))
            cols = [pa.array(pair_keys(v, w).view(np.int64)), b.column("gain"), b.column("often"), pa.array(part_of(w))]
            yield pa.RecordBatch.from_arrays(cols, names=["gram", "gain", "often", "part"])

    def off(d: list[float]) -> Column:
        return F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])

    named = trusted.select(F.col(text).alias("text")).where("text is not null and text <> ''")
    counted = materialize(named.mapInArrow(count, "v long, w long, n long, cost double, part int"), "quality-counted", by="part")
    shared.destroy()
    release(spark)
    pairs, words = [], []
    of_part = dict(counted.groupBy("part").count().collect())
    groups = _together([of_part.get(k, 0) for k in range(SLICES)], AT_MOST)
    for ks in groups:  # by the second word
        part = counted.where(F.col("part").between(ks[0], ks[-1]))
        own = materialize(part.groupBy("v", "w").agg(F.sum("n").alias("c")), "quality-pairs")
        cost = part.where("cost is not null").groupBy("w").agg(F.max("cost").alias("cost"))
        of = own.groupBy("w").agg(F.count(F.lit(1)).alias("c"), F.sum("c").alias("often"))
        pairs.append(own)
        words.append(materialize(of.join(cost.hint("merge"), "w"), "quality-words"))
        for k in ks:
            discard(counted, f"/part={k}")
        release(spark)

    own = off(_discounts(_all(words)))
    whole = _all(words).agg(F.sum("c").alias("total"), F.sum(own).alias("off")).first()
    leave = float(np.log2(whole.total) - np.log2(whole.off))
    below = F.col("cost") + leave
    cut = off(_discounts(_all(pairs)))
    contexts = materialize(_all(pairs).groupBy("v").agg(F.sum("c").alias("total"), F.sum(cut).alias("off")), "quality-contexts")
    release(spark)
    # Bits that a context adds to whatever follows it unseen.
    follow = contexts.select("v", "total", (F.log2("total") - F.log2("off")).alias("down"))
    parts = []
    for ks, own_pairs, own_words in zip(groups, pairs, words, strict=True):
        known = own_words.select("w", "often", "cost", _gain((F.col("c") - own) / float(whole.total), below).alias("gain"))
        first = follow.where(_part("v").between(ks[0], ks[-1])).select(
            F.col("v").alias("gram"), (-F.col("down")).alias("gain"), F.col("total").alias("often")
        )
        single = (
            known.select(F.col("w").alias("gram"), "gain", "often").unionByName(first)
            .groupBy("gram").agg(F.sum("gain").alias("gain"), F.max("often").alias("often"))
        )
        # The sides that are built have one row a key, a part of the model in all.
        met = own_pairs.join(follow.hint("shuffle_hash"), "v").join(known.drop("often").hint("shuffle_hash"), "w")
        both = met.select(
            "v", "w", _gain((F.col("c") - cut) / F.col("total"), F.col("down") + F.col("cost") + leave - F.col("gain")).alias("gain"),
            F.col("c").alias("often"),
        ).mapInArrow(name, "gram long, gain double, often long, part int")
        table = single.withColumn("part", _part("gram").cast("int")).unionByName(both)
        if len(ks) == 1:
            parts.append(materialize(table.drop("part"), "quality-gains"))
        else:
            table = materialize(table, "quality-gains", by="part")
            parts += [table.where(F.col("part") == k).drop("part") for k in ks]
        discard(own_pairs)
        discard(own_words)
        release(spark)
    discard(contexts)
    gains = _all(parts)
    # The least power of two that no more than HOT n-grams reach: one row per power.
    power = F.floor(F.log2("often"))
    least, total = 63, 0
    for p, n in sorted(gains.groupBy(power.alias("p")).count().collect(), reverse=True):
        total += n
        if total > HOT:
            break
        least = p
    table = gains.where(power >= least).select("gram", "gain").toArrow()
    gram, gain = table.column(0).to_numpy(), table.column(1).to_numpy()
    order = np.argsort(gram)
    rest = [p.where(power < least).select("gram", "gain") for p in parts]
    known = bloom.build(_all(rest).select("gram"))
    release(spark)
    return Words(spell, leave, rest, (gram[order], gain[order]), known)


def trusted_ids(labels: DataFrame, held_out: bool, key: str = "doc_id") -> DataFrame:
    """Ids of trusted documents: those trained on, or those held out to set thresholds."""
    out = F.pmod(F.xxhash64("trusted_id"), F.lit(HELD_OUT)) == 0
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return (
        labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("trusted_id"))
        .agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).where("good").select("trusted_id").where(out if held_out else ~out)
    )


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text") -> Words | None:
    """A model of the documents that labels call good and not toxic.

    The join by id would shuffle every text; a Bloom filter of the trusted ids, of bounded
    size, leaves most of the others where they are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ids = materialize(trusted_ids(labels, held_out=False), "quality-trusted")
    shared = spark.sparkContext.broadcast(bloom.build(ids))

    def pick(batches):
        for b in batches:
            own = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            yield b.filter(pa.array(bloom.maybe(shared.value, own), pa.bool_()))

    named = docs.select(F.col(key).cast("long").alias("trusted_id"), F.col(text).alias("text"))
    some = named.mapInArrow(pick, "trusted_id long, text string")
    # The same plan at every size: a shuffle of what is left.
    return fit_words(some.join(ids.hint("merge"), "trusted_id", "left_semi"))


def _lists(of: np.ndarray, grams: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, part, count, number of n-grams of each list, and the n-grams of all lists in turn.

    A list has the distinct n-grams of a text that are in one part and occur equally often.  They are
    given in order."""
    key = of * SLICES + part
    order = np.argsort(key.astype(np.min_scalar_type(int(key.max()))) if len(key) else key, kind="stable")
    key, grams = key[order], grams[order]
    new = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (key[1:] != key[:-1]))[: len(key)])
    count, key, grams = np.diff(new, append=len(key)), key[new], grams[new]
    often = np.flatnonzero(count > 1)
    often = often[np.lexsort((count[often], key[often]))]
    order = np.concatenate([np.flatnonzero(count == 1), often])
    count, key, grams = count[order], key[order], grams[order]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (count[1:] != count[:-1]))[: len(key)])
    return key[first] // SLICES, key[first] % SLICES, count[first], np.diff(first, append=len(key)), grams


def _row_scores(bits: np.ndarray, leave: float, hot: tuple, known: np.ndarray, texts: list[str | None]):
    """Words and bits of each text by what its task knows; ``_lists`` of the rest."""
    size, sums, rest = np.zeros(len(texts), np.int64), np.zeros(len(texts)), []
    at = 0
    for run in _groups(texts):
        s, chars = symbols(run), np.array([len(t or "") for t in run], np.int64)
        words, cost, text = word_rows(bits, run, s)
        n = np.bincount(text, minlength=len(run)) - 1
        size[at : at + len(run)] = n
        run_on = [round(x / c, 6) * c if c else 0.0 for x, c in zip(running(bits, s, chars).tolist(), chars.tolist())]
        sums[at : at + len(run)] = np.bincount(text, cost, len(run)) + n * leave + run_on
        pair = np.flatnonzero(text[1:] == text[:-1])
        grams = np.concatenate([words, pair_keys(words[pair], words[pair + 1])]).view(np.int64)
        order = np.argsort(grams)  # looked up in order: near ones together
        grams, of = grams[order], np.concatenate([text, text[pair]])[order]
        if len(hot[0]):
            place = np.minimum(np.searchsorted(hot[0], grams), len(hot[0]) - 1)
            found = hot[0][place] == grams
            sums[at : at + len(run)] -= np.bincount(of[found], hot[1][place[found]], len(run))
            grams, of, order = grams[~found], of[~found], order[~found]
        some = bloom.maybe(known, grams)
        grams, of, order = grams[some], of[some], order[some]
        part = part_of(words[np.concatenate([np.arange(len(words)), pair + 1])[order]])
        some = np.array([bool(t) for t in run], bool)[of]
        rest.append(_lists(at + of[some], grams[some], part[some]))
        at += len(run)
    return size, sums, *((np.concatenate(x) for x in zip(*rest)) if rest else (np.zeros(0, np.int64),) * 5)


def _together(numbers: list[int], most: int = SLICES) -> list[list[int]]:
    """Neighbouring parts that are joined at a time: one, or as many, up to ``most``, as have few n-grams in all."""
    out: list[list[int]] = [[0]]
    for k in range(1, len(numbers)):
        if len(out[-1]) == most or sum(numbers[j] for j in out[-1]) + numbers[k] > FEW:
            out.append([])
        out[-1].append(k)
    return out


def scored(docs: DataFrame, model: Words | None, *, text: str = "text", extra: list[Column] | None = None) -> DataFrame:
    """Extra columns of every row with ``bits`` per word (null without text)."""
    spark = docs.sparkSession
    small_batches(spark)
    named = docs.select(*(extra or []), F.col(text).alias("_text"))
    kept = named.columns[:-1]
    if model is None:
        return named.select(*kept, F.when(F.length("_text") > 0, 0.0).alias("bits"))
    shared = spark.sparkContext.broadcast((model.spell, model.leave, model.hot, model.known))

    def scan(batches):
        spell, leave, hot, known = shared.value
        bits = spell.bits()
        for b in batches:
            texts = b.column("_text").to_pylist()
            size, sums, of, part, n, held, grams = _row_scores(bits, leave, hot, known, texts)
            row = b.column("_row").to_numpy()
            names = ["row", "grams", "n", "held", "bits", "own", "part"]
            # The rows of the texts themselves are in a part of their own.
            empty = pa.array([not t for t in texts], pa.bool_())
            total = pa.array(sums / (2 * size), mask=empty.to_numpy(zero_copy_only=False))
            texts_part = pa.array(np.full(len(row), SLICES, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), pa.nulls(len(row), pa.list_(pa.int64())), pa.nulls(len(row), pa.float64()), pa.nulls(len(row), pa.int64()),
                 total, b.column("_own"), texts_part], names=names
            )
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(held)).astype(np.int32)), pa.array(grams))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[of]), lists, pa.array(n / (2 * size[of])), pa.array(held), pa.nulls(len(of), pa.float64()),
                 pa.nulls(len(of), b.column("_own").type), pa.array(part.astype(np.int32))], names=names
            )

    # By values, not by place: the same rows in each portion, however often the table is worked out.
    of_row = F.pmod(F.xxhash64("_text", *[c for c, kind in named.dtypes[:-1] if "map<" not in kind]), F.lit(PORTIONS))
    portions = []
    for p in range(PORTIONS):
        some = named.where(of_row == p).select(F.monotonically_increasing_id().alias("_row"), F.struct(*kept).alias("_own") if kept else F.lit(0).alias("_own"), "_text")
        own = dict(some.dtypes)["_own"]
        rows = materialize(
            some.mapInArrow(scan, f"row long, grams array<long>, n double, held long, bits double, own {own}, part int"), "quality-rows", by="part"
        )
        sums = []
        of_part = dict(rows.where("held is not null").groupBy("part").agg(F.sum("held")).collect())
        for ks in _together([of_part.get(k, 0) for k in range(SLICES)]):
            gains = _all([model.parts[k] for k in ks])
            mine = rows.where(F.col("part").between(ks[0], ks[-1])).select("row", "n", F.explode("grams").alias("gram"))
            met = mine.join(gains.hint("shuffle_hash"), "gram")
            sums.append(materialize(met.groupBy("row").agg(F.sum(F.col("n") * F.col("gain")).alias("gain")), "quality-sums"))
            for k in ks:
                discard(rows, f"/part={k}")
            release(spark)
        won = _all(sums).groupBy("row").agg(F.sum("gain").alias("gain"))
        met = rows.where(F.col("part") == SLICES).join(won.hint("merge"), "row", "left")
        portions.append(met.select(*[F.col("own").getField(c).alias(c) for c in kept], F.round(F.col("bits") - F.coalesce("gain", F.lit(0.0)), 6).alias("bits")))
    shared.destroy()  # all that is left reads written tables
    return _all(portions)


def thresholds(scores: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """Most bits of a kept document, per language of the scored rows (key, lang, bits)."""
    known = scores.where("bits is not null").withColumn("bin", F.ceil(F.col("bits") / BIN))
    bins = (
        known.join(trusted_ids(labels, held_out=True), F.col("key") == F.col("trusted_id"), "left_semi")
        .groupBy("lang", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    bins = materialize(bins, "quality-bins")

    def cut(by: list[str]) -> DataFrame:
        whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
        upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        # As many bins as scores differ by BIN: those of documents of very long words add some.
        added = bins.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
        placed = added.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
        reached = placed.where(F.col("upto") >= F.col("all") * quantile)
        return reached.groupBy(*by).agg((F.min("bin") * BIN).alias("most"))

    overall = cut([]).withColumnRenamed("most", "most_overall")
    langs = scores.select("lang").distinct()
    own = cut(["lang"]).withColumnRenamed("lang", "of")
    return langs.join(own, F.col("lang").eqNullSafe(F.col("of")), "left").join(F.broadcast(overall), F.lit(True), "left").select(
        "lang", F.coalesce("most", "most_overall").alias("most")
    )


def classify(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
    quantile: float = QUANTILE,
) -> tuple[DataFrame, Words | None, dict[str | None, float | None]]:
    """Scores of all documents (key, lang, bits, most, kept), the model and the thresholds."""
    model = train(docs, labels, key=key, text=text)
    rows = materialize(
        scored(docs, model, text=text, extra=[F.col(key).cast("long").alias("key"), F.col(lang).cast("string").alias("lang")]),
        "quality-scores",
    )
    # One number per language.
    most = {r.lang: r.most for r in thresholds(rows, labels, quantile).collect()}
    return rows, model, most


def _limit(lang: Column, most: dict[str | None, float | None]) -> Column:
    """The threshold of each language, one entry per language."""
    pairs = [F.lit(x) for name, value in most.items() if value is not None for x in ("\0" if name is None else name, value)]
    if not pairs:
        return F.lit(None).cast("double")
    return F.try_element_at(F.create_map(*pairs), F.coalesce(lang, F.lit("\0")))


def keep_good(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
    quantile: float = QUANTILE,
) -> DataFrame:
    """The documents that are kept, whole rows as they are.

    A verdict depends on text and language alone, so rows are told by a hash of them and the id; a
    Bloom filter of those that leave keeps most of the others out of the join.
    """
    spark = docs.sparkSession
    small_batches(spark)
    mark = F.xxhash64(F.col(key).cast("long"), F.col(text), F.col(lang).cast("string"))
    marked = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(key).cast("long").alias("key"), mark.alias("mark"))
    model = train(docs, labels, key=key, text=text)
    rows = materialize(scored(marked, model, extra=[F.col("key"), F.col("lang"), F.col("mark")]), "quality-scores")
    if model:
        discard(model.gains)
    del model
    release(spark)
    most = {r.lang: r.most for r in thresholds(rows, labels, quantile).collect()}
    limit = _limit(F.col("lang"), most)
    stays = F.col("bits").isNotNull() & (limit.isNull() | (F.col("bits") <= limit))
    name = fresh(docs, "mark")
    bad = materialize(rows.where(~stays).select(F.col("mark").alias(name)).distinct(), "quality-rejected")
    shared = spark.sparkContext.broadcast(bloom.build(bad))
    held = docs.withColumn(name, mark)

    def pick(some: bool):
        def scan(batches):
            for b in batches:
                maybe = bloom.maybe(shared.value, b.column(b.num_columns - 1).to_numpy(zero_copy_only=False))
                yield b.filter(pa.array(maybe if some else ~maybe, pa.bool_()))

        return held.mapInArrow(scan, held.schema)

    # The same plan at every size, as the number that leaves depends on the data.
    return pick(False).unionByName(pick(True).join(bad.hint("merge"), name, "left_anti")).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows, _, most = classify(docs, read_table(spark, sf_dir, "labels"))
    limit = _limit(F.col("lang"), most)
    return rows.select(
        F.col("key").alias("doc_id"), "lang",
        F.round(F.pow(F.lit(2.0), F.col("bits")), 4).alias("perplexity"),
        F.round(F.pow(F.lit(2.0), limit), 4).alias("threshold"),
        (F.col("bits").isNotNull() & (limit.isNull() | (F.col("bits") <= limit))).alias("kept"),
    )
