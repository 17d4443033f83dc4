"""Language identification by interpolated Kneser-Ney character models.

Texts are folded: letters lower-cased, every run of other characters one space, a space at both
ends. Per language the counts of all character ``ORDER``-grams of the training texts are summed over
the whole corpus; the lower orders use continuation counts (in how many distinct contexts a gram
follows), as Kneser-Ney asks, and every order is interpolated with the next lower one:

    p_n(c | h) = max(N(hc) - D, 0) / N(h.) + D * T(h) / N(h.) * p_{n-1}(c | h')

with N the counts (order ``ORDER``) or continuation counts (below), N(h.) their sum over c, T(h) the
number of distinct c after h, and D = n1 / (n1 + 2 n2) for each language and order. Order 0 is
uniform over the characters seen and one unseen.

The models of all languages share Parquet tables: per order, every gram (four 16-bit characters are one
64-bit key) with its discounted share, and every context with its back-off weight, in each language. A block
of texts is reduced to its distinct grams, which are joined to the tables order by order; the log
probabilities are summed per text. Only those of the most frequent grams, a bounded number, are held in
memory, as a sorted array that saves them the join. The language with the lowest cross-entropy per
character wins.

Calibration: per language the ``REJECT`` quantile of the cross-entropy of its own training texts is
the limit beyond which a prediction counts as rejected, and the score is a logistic function of the
margin to the second language, in total nats, with a slope fitted on the training texts.

Defined results: a null text or one without a letter is ``und`` with score 0. Rejected texts keep
their best language and are marked in ``rejected``; with no model at all every text is ``und``.
Ties go to the language that sorts first. Repeated rows count as often as they stand in the
table. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import byte_sized, materialise

ORDER = 4
#: Losses (of a gram under a language) that the scorer holds in memory, for the most frequent grams. It decides
#: cost and not results: every other gram is joined to the tables.
HELD_LOSSES = 1_000_000
#: Losses are whole multiples of 1 / UNIT nats, so that their sums do not depend on the order.
UNIT = 1 << 20
REJECT = 0.999
UNKNOWN = "und"
SPACE = 32
#: Letters beyond the basic plane share this code in a gram.
ASTRAL = 0xFFFF
#: Distinct grams a counting task holds before it passes them on.
HELD_GRAMS = 2_000_000
BLOCK_BYTES = 4_000_000


def _fold_tables() -> tuple[np.ndarray, np.ndarray]:
    """code point -> folded 16-bit code (a lower-case letter, a mark or a space), and whether it is a letter."""
    table = np.full(sys.maxunicode + 1, SPACE, np.uint16)
    letter = np.zeros(sys.maxunicode + 1, bool)
    for i in range(sys.maxunicode + 1):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            low = ord(low) if len(low) == 1 else i
            table[i] = low if low < ASTRAL else ASTRAL
        elif unicodedata.category(c)[0] == "M":
            table[i] = min(i, ASTRAL)  # marks belong to their letters
    return table, letter


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, offsets, has a letter): the folded texts end to end, each framed by spaces."""
    if not _tables:
        _tables.append(_fold_tables())
    joined = np.frombuffer(("\0" + "\0\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), "<u4")
    codes, letter = (t[joined] for t in _tables[0])
    size = np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(size)])
    # of a run of spaces the last stays (the first of the next text, if the run crosses two texts)
    keep = np.ones(len(codes), bool)
    keep[:-1] = (codes[:-1] != SPACE) | (codes[1:] != SPACE)
    keep[offsets[1:] - 1] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(letter)])
    return codes[keep], before[offsets], letters[offsets[1:]] > letters[offsets[:-1]]


def grams(codes: np.ndarray, n: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each place, its last character in the low 16 bits; the places before
    the n-th hold what is there, with zeros in front."""
    out = codes.astype(np.uint64)
    for back in range(1, n):
        out[back:] |= codes[:-back].astype(np.uint64) << np.uint64(16 * back)
    return out


def hashed(gram: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words."""
    x = gram * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# --- training -----------------------------------------------------------------------------------

def text_grams(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, offsets): one gram per character after each text's first space."""
    pad = ORDER - 2  # so that the first letter has a whole context
    size = np.diff(offsets)
    starts = np.repeat(offsets[:-1], size)
    padded = np.full(len(codes) + pad * len(size), SPACE, np.uint16)
    at = np.arange(len(codes)) + pad * (np.repeat(np.arange(len(size)), size) + 1)
    padded[at] = codes
    all_grams = grams(padded)
    keep = np.arange(len(codes)) != starts
    return all_grams[at[keep]], np.concatenate([[0], np.cumsum(np.maximum(size - 1, 0))])


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n: the ORDER-grams of every text (text, lang), summed over the corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge(lang: str) -> int:
            keys, counts = (np.concatenate(x) for x in zip(*held[lang]))
            keys, index = np.unique(keys, return_inverse=True)
            held[lang] = [(keys, np.bincount(index, counts).astype(np.int64))]
            return len(keys)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in held:
                merge(lang)
                keys, counts = held[lang][0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"])
            held.clear()

        for b in byte_sized(batches, "text", BLOCK_BYTES):
            langs = np.array(b.column(1).to_pylist(), object)
            values = b.column(0).to_pylist()
            for lang in sorted(set(langs)):
                codes, offsets, _ = folded([values[i] for i in np.flatnonzero(langs == lang)])
                keys, counts = np.unique(text_grams(codes, offsets)[0], return_counts=True)
                held.setdefault(lang, []).append((keys, counts))
            if sum(map(merge, held)) > HELD_GRAMS:
                yield from flush()
        yield from flush()

    found = (docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
             .mapInArrow(count, "lang string, gram long, n long"))
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram: str, n: int) -> Column:
    """The last n characters of a gram."""
    return F.col(gram).bitwiseAND(F.lit((1 << 16 * n) - 1)) if n < 4 else F.col(gram)


def _context(gram: str) -> Column:
    """All characters of a gram but the last."""
    return F.shiftrightunsigned(F.col(gram), 16)


def order_tables(counts: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """order -> (lang, gram, discounted share; lang, context, back-off weight)."""
    tables, current = {}, counts
    for n in range(ORDER, 0, -1):
        kinds = current.groupBy("lang").agg(F.sum((F.col("n") == 1).cast("long")).alias("n1"),
                                            F.sum((F.col("n") == 2).cast("long")).alias("n2"))
        # at least one count of each kind is assumed, so that 0 < D < 1 on the smallest corpus
        discount = kinds.select("lang", ((F.col("n1") + 1) / (F.col("n1") + 1 + 2 * (F.col("n2") + 1))).alias("d"))
        rows = current.withColumn("context", _context("gram"))
        sums = (rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
                .join(F.broadcast(discount), "lang"))
        share = (rows.join(sums, ["lang", "context"])
                 .select("lang", "gram", "n", ((F.col("n") - F.col("d")) / F.col("total")).alias("share")))
        weight = sums.select("lang", "context", F.col("total").alias("n"), (F.col("d") * F.col("types") / F.col("total")).alias("share"))
        tables[n] = (share, weight)
        if n > 1:
            current = materialise(current.select("lang", _suffix("gram", n - 1).alias("gram")).groupBy("lang", "gram")
                                  .agg(F.count(F.lit(1)).alias("n")), f"order{n - 1}")
    return tables


def _dense(table: DataFrame, key: str, name: str, languages: list[str], missing: float) -> DataFrame:
    """``key`` and the array ``name``: the column share by language, ``missing`` where a language has none."""
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    found = table.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(number.cast("int"), "share"))).alias("m"))
    return found.select(key, F.transform(F.sequence(F.lit(0), F.lit(len(languages) - 1)),
                                         lambda i: F.coalesce(F.try_element_at("m", i), F.lit(missing))).alias(name))


class Model:
    """Tables of all orders, one value per language in each row, and the losses of frequent grams."""

    def __init__(self, languages: list[str], levels: dict[int, tuple[DataFrame, DataFrame]]):
        """levels[n]: (gram, share) and (context, weight) of order n."""
        self.languages, self.levels = languages, levels
        self.floor = 1.0 / (levels[1][0].count() + 1) if languages else 1.0
        #: grams in ascending order and their losses, a row each
        self.frequent = np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.int32)

    def losses(self, asked: DataFrame) -> DataFrame:
        """gram and losses (whole multiples of 1 / UNIT nats, one per language) of the distinct grams
        ``asked``, trained or not. A key of these joins stands in as many rows as there are characters at most."""
        k, by_order = len(self.languages), {ORDER: asked}
        for n in range(ORDER - 1, 0, -1):
            by_order[n] = materialise(by_order[n + 1].select(_suffix("gram", n).alias("gram")).distinct(), f"asked{n}")
        lower = None
        for n, (share, weight) in sorted(self.levels.items()):
            rows = by_order[n].select("gram", _context("gram").alias("context"), _suffix("gram", n - 1).alias("suffix"))
            rows = rows.join(share, "gram", "left").join(F.broadcast(weight) if n == 1 else weight, "context", "left")
            rows = (rows.withColumn("lower", F.array_repeat(F.lit(self.floor), k)) if lower is None else
                    rows.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("lower")), "suffix"))
            backed = F.when(F.col("weight").isNull(), F.col("lower")).otherwise(F.zip_with("weight", "lower", lambda w, x: w * x))
            lower = rows.withColumn("backed", backed).select("gram", F.when(F.col("share").isNull(), F.col("backed")).otherwise(
                F.zip_with("share", "backed", lambda s, x: s + x)).alias("p"))
        return lower.select("gram", F.transform("p", lambda x: F.round(-F.log(x) * UNIT).cast("long")).alias("losses"))


class Frequent:
    """Losses of the grams of a block that the model holds in memory."""

    SLOTS = 18

    def __init__(self, grams_: np.ndarray, losses: np.ndarray):
        self.grams, self.losses = grams_, losses
        # a direct-mapped table of grams seen before, in front of the sorted arrays
        self.keys = np.zeros(1 << self.SLOTS, np.uint64)
        self.values = np.zeros((1 << self.SLOTS, losses.shape[1]), np.int32)
        self.held = np.zeros(1 << self.SLOTS, bool)

    def __call__(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(losses, whether held) of each gram; 0 where it is not."""
        slot = self._slot(gram)
        out, held = self.values[slot], self.held[slot]
        miss = self.keys[slot] != gram
        if miss.any():
            new, index = np.unique(gram[miss], return_inverse=True)
            values, known = np.zeros((len(new), out.shape[1]), np.int32), np.zeros(len(new), bool)
            if len(self.grams):
                at = np.searchsorted(self.grams, new)
                at[at == len(self.grams)] = 0
                known = self.grams[at] == new
                values[known] = self.losses[at[known]]
            out[miss], held[miss] = values[index], known[index]
            slot = self._slot(new)
            self.keys[slot], self.values[slot], self.held[slot] = new, values, known
        return out, held

    def _slot(self, gram: np.ndarray) -> np.ndarray:
        return (hashed(gram) >> np.uint64(64 - self.SLOTS)).astype(np.int64)


def train(docs: DataFrame) -> Model:
    """Model of the rows (text, lang); null texts and languages are left out."""
    counts = materialise(gram_counts(docs), "grams")
    languages = [r["lang"] for r in counts.select("lang").distinct().orderBy("lang").collect()]
    if not languages:
        return Model([], {})
    model = Model(languages, {
        n: (materialise(_dense(share, "gram", "share", languages, 0.0), f"share{n}"),
            materialise(_dense(weight, "context", "weight", languages, 1.0), f"weight{n}"))
        for n, (share, weight) in order_tables(counts).items()})
    # from the top, whole classes of frequency (eight for each doubling) as long as they fit
    classes = counts.groupBy("gram").agg(F.floor(F.log2(F.sum("n")) * 8).alias("class"))
    room, least = HELD_LOSSES // len(languages), None
    for r in classes.groupBy("class").count().orderBy(F.desc("class")).collect():  # at most 8 * 63 rows
        room -= r["count"]
        if room < 0:
            break
        least = r["class"]
    if least is not None:
        asked = materialise(classes.where(F.col("class") >= least).select("gram"), "frequent")
        table = model.losses(asked).toArrow()
        grams_ = table["gram"].to_numpy().view(np.uint64)
        losses = pa.chunked_array(table["losses"]).combine_chunks().flatten().to_numpy().reshape(len(grams_), -1)
        order = np.argsort(grams_)
        model.frequent = grams_[order], losses[order].astype(np.int32)
    return model


# --- scoring ------------------------------------------------------------------------------------

def scored(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but the text, and n (characters), letters (whether there are any) and
    sums: the loss of the whole text under each language, in 1 / UNIT nats.

    A block of texts sums the grams held in memory at once and passes on each other gram with the
    places and counts of the texts it stands in; these are joined to their losses and added."""
    k, frequent = len(model.languages), model.frequent
    kept = docs.drop("text").schema
    rows = docs.withColumn("rid", F.monotonically_increasing_id())  # consecutive within a partition
    rows = rows.select("rid", "text", *kept.names)
    schema = ", ".join(["rid long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n long, letters boolean",
                        "sums array<long>, gram long, places array<int>, counts array<int>"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Frequent(*frequent)
        for b in byte_sized(batches, "text", BLOCK_BYTES):
            codes, offsets, letters = folded([t or "" for t in b.column("text").to_pylist()])
            gram, ends = text_grams(codes, offsets)
            n = np.diff(ends)
            loss, known = held(gram)
            sums, some = np.zeros((len(n), k), np.int64), n > 0
            if some.any():
                sums[some] = np.add.reduceat(loss, ends[:-1][some], axis=0, dtype=np.int64)
            place = np.repeat(np.arange(len(n), dtype=np.int32), n)[~known]
            names = ["rid", *kept.names, "n", "letters", "sums", "gram", "places", "counts"]
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("rid"), *(b.column(c) for c in kept.names), pa.array(n), pa.array(letters),
                 pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * k, sums.ravel()),
                 *(pa.nulls(len(n), t) for t in (pa.int64(), lists, lists))], names=names)
            if len(place):
                gram = gram[~known]
                order = np.lexsort((place, gram))
                gram, place = gram[order], place[order]
                first = np.flatnonzero(np.append(True, (gram[1:] != gram[:-1]) | (place[1:] != place[:-1])))
                counts = np.diff(np.append(first, len(gram))).astype(np.int32)
                gram, place = gram[first], place[first]
                cuts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
                bounds = np.append(cuts, len(gram)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cuts), b.column("rid")[0].as_py())),
                     *(pa.nulls(len(cuts), b.schema.field(c).type) for c in kept.names),
                     *(pa.nulls(len(cuts), t) for t in (pa.int64(), pa.bool_(), pa.list_(pa.int64()))),
                     pa.array(gram[cuts].view(np.int64)), pa.ListArray.from_arrays(bounds, place),
                     pa.ListArray.from_arrays(bounds, counts)], names=names)

    found = materialise(rows.mapInArrow(look, schema), "blocks")
    rest = found.where("gram IS NOT NULL").select("rid", "gram", "places", "counts")
    losses = materialise(model.losses(materialise(rest.select("gram").distinct(), "asked")), "losses")
    places = rest.join(losses, "gram").select("rid", "losses", F.explode(F.arrays_zip("places", "counts")).alias("e"))
    more = (places.groupBy((F.col("rid") + F.col("e.places")).alias("rid"))
            .agg(F.array(*[F.sum(F.col("e.counts") * F.col("losses")[i]) for i in range(k)]).alias("more")))
    whole = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda x, y: x + y))
    return (found.where("gram IS NULL").join(more, "rid", "left")
            .select(*kept.names, "n", "letters", whole.alias("sums")))


def _entropies(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nats per character by language, characters, has a letter) of each row of :func:`scored`."""
    n, letters = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n", "letters"))
    sums = b.column("sums").flatten().to_numpy().reshape(len(n), -1)
    return sums / UNIT / np.maximum(n, 1)[:, None], n, letters


class Scorer:
    """Cross-entropies of a few texts at hand, by way of :func:`scored`."""

    def __init__(self, model: Model):
        self.model = model

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nats per character by language, characters, has a letter) of each text."""
        spark = self.model.levels[1][0].sparkSession
        docs = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
        return _entropies(scored(docs, self.model).orderBy("i").toArrow().combine_chunks().to_batches()[0])


# --- calibration and prediction -----------------------------------------------------------------

BINS = 400


def calibrate(found: DataFrame, languages: list[str]) -> tuple[list[float], float]:
    """(entropy limit of each language, slope of the score) from all training rows (lang and what scored() gives)."""
    k = len(languages)
    index = {name: i for i, name in enumerate(languages)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entropy, margin = np.zeros((k, BINS), np.int64), np.zeros((2, BINS), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            loss, n, letters = _entropies(b)
            own = np.array([index.get(x, -1) for x in b.column("lang").to_pylist()])
            letters = letters & (own >= 0)
            best = loss.argmin(1)
            np.add.at(entropy, (own[letters], _bin(loss[np.arange(len(own)), own] * 20)[letters]), 1)
            np.add.at(margin, ((best == own).astype(int)[letters], _bin(_margin(loss, n) * 4)[letters]), 1)
        both = np.concatenate([entropy, margin])
        rows, bins = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(bins, pa.int32()), pa.array(both[rows, bins])],
                                         names=["row", "bin", "n"])

    counted = np.zeros((k + 2, BINS), np.int64)
    for r in (found.select("lang", "n", "letters", "sums").mapInArrow(measure, "row int, bin int, n long").groupBy("row", "bin")
              .agg(F.sum("n").alias("n")).collect()):  # at most (k + 2) * BINS rows
        counted[r["row"], r["bin"]] = r["n"]
    share = np.cumsum(counted[:k], 1) / np.maximum(counted[:k].sum(1, keepdims=True), 1)
    limits = [(int(np.argmax(s >= REJECT)) + 1) / 20 if s[-1] else math.inf for s in share]
    wrong, right = counted[k], counted[k + 1]
    middle = (np.arange(BINS) + 0.5) / 4
    slopes = np.geomspace(0.01, 10, 61)
    fit = [(np.log1p(np.exp(-np.minimum(s * middle, 500))) @ (right + 1)
            + np.log1p(np.exp(np.minimum(s * middle, 500))) @ wrong) for s in slopes]
    return limits, float(slopes[int(np.argmin(fit))])


def _bin(x: np.ndarray) -> np.ndarray:
    return np.clip(x, 0, BINS - 1).astype(np.int64)


def _margin(loss: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Nats between the best and the second language over the whole text."""
    if loss.shape[1] < 2:
        return np.full(len(n), float(BINS))
    two = np.partition(loss, 1, axis=1)
    return (two[:, 1] - two[:, 0]) * n


def identify(docs: DataFrame, training: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score, rejected and cross_entropy for every row of ``docs`` (doc_id, text),
    learnt from ``training`` (text, lang)."""
    model = train(training)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not model.languages:
        return ids.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"),
                          F.lit(None).cast("double").alias("cross_entropy"))
    labelled = training.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    none = F.lit(None)
    found = materialise(scored(
        ids.select("doc_id", "text", none.cast("string").alias("lang"), F.lit(False).alias("learnt"))
        .union(labelled.select(none.cast("long"), "text", "lang", F.lit(True))), model), "scored")
    limits, slope = calibrate(found.where("learnt"), model.languages)
    languages = model.languages
    out = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
                     ("rejected", pa.bool_()), ("cross_entropy", pa.float64())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            loss, n, letters = _entropies(b)
            best, margin = loss.argmin(1), _margin(loss, n)
            score = 1 / (1 + np.exp(-np.minimum(slope * margin, 500)))
            rows = [(languages[i], float(s), bool(e > limits[i]), float(e)) if l else (UNKNOWN, 0.0, True, None)
                    for i, s, e, l in zip(best.tolist(), score.tolist(), loss.min(1).tolist(), letters.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(out)[1:]))],
                                             schema=out)

    return (found.where("NOT learnt").select("doc_id", "n", "letters", "sums")
            .mapInArrow(predict, "doc_id long, lang_pred string, score double, rejected boolean, cross_entropy double"))
