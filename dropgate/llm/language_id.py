"""Language identification by interpolated Kneser-Ney character models.

Letters and marks are lower-cased, everything else is one space.  For every language an order-4 model is
counted over all training documents: tasks count the packed 4-grams (16 bits a character) of each language, Spark adds them up,
and the lower orders' continuation counts, the contexts' totals and the discounts n1 / (n1 + 2 n2) follow by
grouping.  A model holds the discounted share of each gram and the back-off weight of each context, of all grams that occur.

Models of up to ``MODEL_ENTRIES`` entries are sent to the tasks as sorted arrays of 64-bit hashes.  Of larger ones the tasks get only what
the most frequent 4-grams need, and score these; the other 4-grams of each text are joined with the stored models, level by level,
and their log probabilities added to the text's sums.  Both ways give the same sums, whatever the size of the corpus and the number of languages.

A text gets the language with the least cross-entropy per character.  The lead of the best over the second, times the number of
characters, is mapped to the probability of being right by a logistic fit on a calibration fold; texts whose
cross-entropy is above the ``REJECT`` quantile of the calibration texts of that language are marked as rejected.

Defined results: null text or text without letters: ``und``, score 0; training rows with a null language or id are not learned
from; without training rows all are ``und``; repeated rows are judged, and learned from, one by one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, scratch, store

ORDER = 4
#: entries of models that are sent to every task
MODEL_ENTRIES = 1 << 22
#: characters handled at once, and types a task holds before it sends them on
CHUNK, HELD = 1_000_000, 2_000_000
#: share of calibration texts of a language that are accepted; steps of the histograms of lead and cross-entropy
REJECT, LEAD_BINS, ENTROPY_STEP = 0.995, 40, 0.02
SPACE = 32


def _become(c: int) -> tuple[int, bool]:
    """What becomes of a character, and is it a letter: a letter in lower case, a mark as it is, or a space.

    Those beyond 16 bits are folded into the private area of 16 bits, apart from all others; a few of them may share a place there.
    """
    x = chr(c)
    if x.isalpha():
        low = ord(x.lower()[0])
        return (low if low < 1 << 16 else 0xE000 + (low & 0xFFF)), True
    if unicodedata.category(x)[0] == "M":
        return (c if c < 1 << 16 else 0xE000 + (c & 0xFFF)), False
    return SPACE, False


class Reader:
    """Packed grams of texts."""

    def __init__(self):
        became = [_become(c) for c in range(1 << 16)]
        self.table, self.letter = np.array([b for b, _ in became], np.uint64), np.array([x for _, x in became])

    def grams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(packed 4-gram ending at each character, text of each); texts without a letter have none."""
        raw = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        of = np.repeat(np.arange(len(texts)), [len(x) for x in raw])
        flat = np.concatenate(raw) if raw else np.empty(0, np.uint32)
        high = flat > 0xFFFF
        low = np.where(high, 0, flat)
        chars, letter = self.table[low], self.letter[low]
        if high.any():
            rare, at = np.unique(flat[high], return_inverse=True)
            became = [_become(int(c)) for c in rare]
            chars[high], letter[high] = np.array([b for b, _ in became], np.uint64)[at], np.array([x for _, x in became])[at]
        chars[np.bincount(of[letter], minlength=len(texts))[of] == 0] = SPACE  # marks without a letter
        space = chars == SPACE
        again = np.r_[True, space[:-1] & (of[1:] == of[:-1])] if len(of) else space
        first = np.r_[True, of[1:] != of[:-1]] if len(of) else space
        keep = ~(space & (again | first))
        chars, of = chars[keep], of[keep]
        # a text of letters only has no space left but between words; pads keep texts apart
        pad = ORDER - 1
        at = np.arange(len(chars)) + pad * (of + 1)
        padded = np.full(len(chars) + pad * (len(texts) + 1), SPACE, np.uint64)
        padded[at] = chars
        packed = np.zeros(len(chars), np.uint64)
        for i in range(ORDER):
            packed |= padded[at - i] << np.uint64(16 * i)
        return packed, of


def _chunks(batches):
    """Column lists of rows holding about CHUNK characters."""
    for batch in batches:
        rows = batch.to_pydict()
        low, n = 0, 0
        for i, t in enumerate(rows["text"]):
            n += len(t or "")
            if n >= CHUNK or i + 1 == len(rows["text"]):
                yield {k: v[low : i + 1] for k, v in rows.items()}
                low, n = i + 1, 0


_COUNTED = pa.schema([("lang", pa.string()), ("calibrates", pa.bool_()), ("gram", pa.int64()), ("n", pa.int64())])


def _count(batches):
    reader, held = Reader(), {}

    def flush():
        for (lang, calibrates), parts in held.items():
            grams, n = _summed(parts)
            for at in range(0, len(grams), 65536):
                part = grams[at : at + 65536].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array([calibrates] * len(part)), pa.array(part), pa.array(n[at : at + 65536])], schema=_COUNTED)
        held.clear()

    total = 0
    for rows in _chunks(batches):
        by: dict[tuple, list] = {}
        for lang, calibrates, text in zip(rows["lang"], rows["calibrates"], rows["text"]):
            by.setdefault((lang, calibrates), []).append(text)
        for of, texts in by.items():
            packed, _ = reader.grams(texts)
            grams, n = np.unique(packed, return_counts=True)
            parts = held.setdefault(of, [])
            parts.append((grams, n.astype(np.int64)))
            total += len(grams)
        if total > HELD:
            held.update({of: [_summed(parts)] for of, parts in held.items()})
            total = sum(len(p[0][0]) for p in held.values())
            if total > HELD // 2:
                yield from flush()
                total = 0
    yield from flush()


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    grams, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(grams, kind="stable")
    grams, n = grams[order], n[order]
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.empty(0, np.int64)
    return grams[first], np.add.reduceat(n, first) if len(first) else n


def count(docs: DataFrame, calibrates: Column) -> DataFrame:
    """(lang, calibrates, gram, n): how often each 4-gram occurs in the texts of a language, those that calibrate apart."""
    learned = docs.where("lang is not null and text is not null").select("lang", F.coalesce(calibrates, F.lit(False)).alias("calibrates"), "text")
    counts = learned.mapInArrow(_count, "lang string, calibrates boolean, gram long, n long")
    return store(counts.groupBy("lang", "calibrates", "gram").agg(F.sum("n").alias("n")), "grams")


def train(docs: DataFrame) -> DataFrame:
    """The models of all languages of ``docs`` (text, lang)."""
    return models(count(docs, F.lit(False)).select("lang", "gram", "n"))


def models(counts: DataFrame) -> DataFrame:
    """The models of counted 4-grams (lang, gram, n): (lang, level, kind, key, value).

    Every level is stored by itself: the driver holds the plan of one level at a time, and the models are a union of scans.  Level is the length of a gram; kind ``g`` holds the discounted share of a gram in its context, kind ``c`` the
    back-off weight of a context (its key is the gram's without the last character); level 0 the number of characters known.
    """
    parts = []
    for level in range(ORDER, 0, -1):
        if level < ORDER:  # continuation counts: of how many longer grams is it the end
            mask = (1 << (16 * level)) - 1
            counts = store(counts.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count("*").alias("n")), "grams")
        rarity = counts.groupBy("lang").agg(F.sum((F.col("n") == 1).cast("double")).alias("n1"), F.sum((F.col("n") == 2).cast("double")).alias("n2"))
        rarity = rarity.select("lang", F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5).alias("d"))
        context = F.shiftrightunsigned("gram", 16).alias("context")
        grams = counts.select("lang", "gram", "n", context)
        totals = grams.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
        totals = store(totals.join(rarity, "lang"), "contexts")
        shares = grams.join(totals, ["lang", "context"])
        share = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        shares = store(shares.select("lang", F.col("gram").alias("key"), share.alias("value")), "shares")
        parts.append(shares.select("lang", F.lit(level).alias("level"), F.lit("g").alias("kind"), "key", "value"))
        parts.append(totals.select("lang", F.lit(level), F.lit("c"), "context", F.col("d") * F.col("types") / F.col("total")))
    known = counts.groupBy("lang").agg(F.count("*").cast("double").alias("n"))
    parts.append(known.select("lang", F.lit(0), F.lit("g"), F.lit(0).cast("long"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _part(lang, level, context):
    """Number of the sorted array that holds the shares, or the contexts' weights, of one level of a language."""
    return (lang * (ORDER + 1) + level) * 2 + context


class Model:
    """Models of all languages as sorted hash arrays.

    ``hot``: the packed 4-grams they suffice for; all, if None.
    """

    def __init__(self, table: pa.Table, hot: np.ndarray | None = None):
        lang = table["lang"].combine_chunks().dictionary_encode()
        langs = lang.dictionary.to_pylist()
        part = _part(lang.indices.to_numpy().astype(np.int32), table["level"].to_numpy(), np.asarray(pa.compute.equal(table["kind"], "c")))
        self._fill(langs, part, table["key"].to_numpy(), table["value"].to_numpy(), hot)

    @classmethod
    def collected(cls, table: DataFrame, hot: np.ndarray | None = None) -> Model:
        """The model of a stored table, fetched as 16 bytes an entry."""
        langs = [r["lang"] for r in table.where("level = 0").select("lang").collect()]
        number = F.element_at(F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))]), F.col("lang")) if langs else F.lit(0)
        part = _part(number, F.col("level"), (F.col("kind") == "c").cast("int")).cast("int")
        entries = table.select(part.alias("part"), "key", F.col("value").cast("float").alias("value")).toArrow()
        out = cls.__new__(cls)
        out._fill(langs, *(entries[x].to_numpy() for x in ("part", "key", "value")), hot)
        return out

    def _fill(self, langs: list[str], part: np.ndarray, key: np.ndarray, value: np.ndarray, hot: np.ndarray | None) -> None:
        self.hot = None if hot is None else np.sort(hot)
        self.langs = sorted(langs)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part, np.arange(2 * (ORDER + 1) * len(langs) + 1), sorter=order)
        self.arrays = {}
        for i, lang in enumerate(langs):
            for k in range(ORDER + 1):
                for x in "gc":
                    p = _part(i, k, x == "c")
                    at = order[ends[p] : ends[p + 1]]
                    h, v = mix(key[at].view(np.uint64)), value[at].astype(np.float32)
                    by = np.argsort(h)
                    self.arrays[lang, k, x] = h[by], v[by]

    def _get(self, lang: str, level: int, kind: str, h: np.ndarray, missing: float) -> np.ndarray:
        keys, values = self.arrays[lang, level, kind]
        if not len(keys):
            return np.full(len(h), missing, np.float64)
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[at] == h, values[at], missing).astype(np.float64)

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """log P(last character | the three before) of distinct packed 4-grams, one row for each language."""
        hashed = {}
        for k in range(1, ORDER + 1):
            g = grams & np.uint64((1 << (16 * k)) - 1)
            hashed[k, "g"], hashed[k, "c"] = mix(g), mix(g >> np.uint64(16))
        out = np.empty((len(self.langs), len(grams)))
        for row, lang in enumerate(self.langs):
            p = np.full(len(grams), 1 / (1 + float(self.arrays[lang, 0, "g"][1][0])))
            for k in range(1, ORDER + 1):
                p = self._get(lang, k, "g", hashed[k, "g"], 0.0) + self._get(lang, k, "c", hashed[k, "c"], 1.0) * p
            out[row] = np.log(p)
        return out


def _read(reader: Reader, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct packed 4-grams, which of them ends at each character, text of each character)."""
    packed, of = reader.grams(texts)
    order = np.argsort(packed)
    ranked = packed[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]] if len(ranked) else np.empty(0, bool)
    which = np.empty(len(packed), np.int64)
    which[order] = np.cumsum(first) - 1
    return ranked[first], which, of


_JUDGED = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("lang", pa.string()), ("best", pa.string()), ("lead", pa.float64()), ("entropy", pa.float64())])
_DDL = "id long, held_out boolean, lang string, best string, lead double, entropy double"


def _judge(docs: DataFrame, model) -> DataFrame:
    """(id, held_out, lang, best, lead, entropy): the best language of each text, null without letters.

    ``lead`` is the lead in log likelihood over the second best, ``entropy`` the cross-entropy per character.
    """

    def run(batches):
        reader, m = Reader(), model.value
        for rows in _chunks(batches):
            n = len(rows["id"])
            grams, which, of = _read(reader, rows["text"])
            size = np.bincount(of, minlength=n)
            best, lead, entropy = [None] * n, np.zeros(n), np.zeros(n)
            if m.langs and len(grams):
                log_p = m.log_p(grams)
                sums = np.stack([np.bincount(of, log_p[i][which], n) for i in range(len(m.langs))])
                top = np.argmax(sums, axis=0)
                top_sum = np.max(sums, axis=0)
                rest = sums.copy()
                rest[top, np.arange(n)] = -np.inf
                second = np.max(rest, axis=0)
                best = [m.langs[k] if s else None for k, s in zip(top, size)]
                some = size > 0
                lead[some] = np.where(np.isfinite(second[some]), top_sum[some] - second[some], size[some])
                entropy[some] = -top_sum[some] / size[some]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((rows["id"], rows["held_out"], rows["lang"], best, lead, entropy), _JUDGED)], schema=_JUDGED)

    return docs.select("id", "held_out", "lang", "text").mapInArrow(run, _DDL)


_PART = pa.schema([("id", pa.int64()), ("held_out", pa.bool_()), ("lang", pa.string()), ("key", pa.int64()), ("size", pa.int64()), ("sums", pa.list_(pa.float64())), ("grams", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
_PART_DDL = "id long, held_out boolean, lang string, key long, size long, sums array<double>, grams array<long>, counts array<long>"


def _judge_large(docs: DataFrame, table: DataFrame, model) -> DataFrame:
    """What ``_judge`` gives, with a model that suffices for its hot 4-grams only; ``table`` is the whole, stored."""
    langs = model.value.langs

    def run(batches):
        reader, m = Reader(), model.value
        for rows in _chunks(batches):
            n = len(rows["id"])
            grams, which, of = _read(reader, rows["text"])
            hot = np.isin(grams, m.hot)
            size = np.bincount(of, minlength=n)
            sums, tails = np.zeros((n, len(m.langs))), [([], [])] * n
            if len(grams):
                log_p = np.where(hot, m.log_p(grams), 0.0)
                sums = np.stack([np.bincount(of, log_p[i][which], n) for i in range(len(m.langs))], axis=1)
                cold = ~hot[which]
                pairs, counts = np.unique(np.stack([of[cold], which[cold]]), axis=1, return_counts=True)
                ends = np.searchsorted(pairs[0], np.arange(n + 1))
                rest = grams[pairs[1]].view(np.int64)
                tails = [(rest[a:b], counts[a:b]) for a, b in zip(ends, ends[1:])]
            columns = (rows["id"], rows["held_out"], rows["lang"], rows["key"], size, list(sums), [t[0] for t in tails], [t[1] for t in tails])
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _PART)], schema=_PART)

    keyed = docs.select("id", "held_out", "lang", F.xxhash64("id", "text").alias("key"), "text")
    part = store(keyed.mapInArrow(run, _PART_DDL), "part")
    # rows of one id and text have the same rest
    rest = part.where(F.size("grams") > 0).dropDuplicates(["key"]).select("key", F.explode(F.arrays_zip("grams", "counts")).alias("x")).select("key", F.col("x.grams").alias("gram"), F.col("x.counts").alias("n"))
    scored = _log_p(store(rest.select("gram").distinct(), "rest"), table, langs)
    added = rest.join(scored, "gram").select("key", "n", F.posexplode("log_p").alias("at", "log_p")).groupBy("key", "at").agg(F.sum(F.col("n") * F.col("log_p")).alias("sum"))
    added = added.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "sum"))), lambda x: x["sum"]).alias("added"))
    whole = part.drop("grams", "counts").join(added, "key", "left")
    whole = whole.withColumn("sums", F.when(F.col("added").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "added", lambda a, b: a + b)))
    top = F.array_max("sums")
    names = F.array(*[F.lit(x) for x in langs])
    some = F.col("size") > 0
    second = F.get(F.sort_array("sums", False), F.lit(1))
    return whole.select(
        "id", "held_out", "lang", F.when(some, F.get(names, (F.array_position("sums", top) - 1).cast("int"))).alias("best"),
        F.when(some, F.coalesce(top - second, F.col("size").cast("double"))).otherwise(0.0).alias("lead"), F.when(some, -top / F.col("size")).otherwise(0.0).alias("entropy"),
    )


def _log_p(grams: DataFrame, table: DataFrame, langs: list[str]) -> DataFrame:
    """(gram, log_p): log P of distinct packed 4-grams as an array by language, from the stored models."""
    number = F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))])
    entries = table.where("level > 0").groupBy("level", "kind", "key").agg(F.map_from_entries(F.collect_list(F.struct(F.element_at(number, F.col("lang")), "value"))).alias("values"))

    def of(level: int, kind: str, name: str) -> DataFrame:
        return entries.where((F.col("level") == level) & (F.col("kind") == kind)).select(F.col("key").alias(name), F.col("values").alias(f"{kind}s"))

    masks = {k: F.lit((1 << (16 * k)) - 1 if k < ORDER else -1) for k in range(ORDER + 1)}
    known = {r["lang"]: r["value"] for r in table.where("level = 0").select("lang", "value").collect()}
    below = grams.select(F.lit(0).cast("long").alias("tail")).limit(1).withColumn("p", F.array(*[F.lit(1 / (1 + known[x])) for x in langs]))
    for k in range(1, ORDER + 1):
        # the distinct endings of length k, each with its own share, its context's weight and what the shorter ending has
        ends = grams.select(F.col("gram").bitwiseAND(masks[k]).alias("end")).distinct()
        ends = ends.select("end", F.shiftrightunsigned("end", 16).alias("context"), F.col("end").bitwiseAND(masks[k - 1]).alias("tail"))
        ends = ends.join(of(k, "g", "end"), "end", "left").join(of(k, "c", "context"), "context", "left").join(below, "tail")
        value = F.transform("p", lambda p, i: F.coalesce(F.element_at("gs", i), F.lit(0.0)) + F.coalesce(F.element_at("cs", i), F.lit(1.0)) * p)
        below = store(ends.select(F.col("end").alias("tail"), value.alias("p")), f"level{k}")
    return below.select(F.col("tail").alias("gram"), F.transform("p", lambda p: F.log(p)).alias("log_p"))


def _hot(counts: DataFrame, most: int) -> DataFrame:
    """(gram): the most frequent 4-grams, at most ``most``, by a histogram of frequencies in steps of an eighth of a doubling."""
    step = F.floor(F.log2(F.col("n")) * 8).cast("int")
    total = counts.groupBy("gram").agg(F.sum("n").alias("n")).select("gram", step.alias("step"))
    least, held = None, 0
    for r in sorted(total.groupBy("step").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"]):
        held += r["n"]
        if held > most:
            break
        least = r["step"]
    return total.where(F.lit(False) if least is None else F.col("step") >= least).select("gram")


def judge(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """(id, held_out, lang, best, lead, entropy) of ``docs``, stored, by the models of counted 4-grams (lang, gram, n)."""
    with scratch(docs.sparkSession) as keep:
        table = store(models(counts), "models")
        if table.count() <= MODEL_ENTRIES:
            return keep(_judged(docs, _judge, Model.collected(table)))
        return keep(_judge_rest(docs, counts, table))


def _judged(docs: DataFrame, how, model: Model) -> DataFrame:
    """``how(docs, model)``, stored; the model does not stay with the driver and the executors."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    try:
        return store(how(docs, sent), "judged")
    finally:
        sent.destroy()


def _judge_rest(docs: DataFrame, counts: DataFrame, table: DataFrame) -> DataFrame:
    """What ``judge`` gives where the models are too large to be sent whole."""
    hot = store(_hot(counts, MODEL_ENTRIES // (2 * ORDER * table.where("level = 0").count())), "hot")
    keys = []
    for k in range(1, ORDER + 1):
        gram = F.col("gram").bitwiseAND(F.lit((1 << (16 * k)) - 1 if k < ORDER else -1))
        keys += [F.struct(F.lit(k).alias("level"), F.lit(kind).alias("kind"), key.alias("key")) for kind, key in (("g", gram), ("c", F.shiftrightunsigned(gram, 16)))]
    wanted = hot.select(F.explode(F.array(*keys)).alias("x")).select("x.*").distinct()
    some = table.where("level > 0").join(wanted, ["level", "kind", "key"], "left_semi").select(*table.columns).union(table.where("level = 0"))
    grams = hot.toArrow()["gram"].to_numpy().view(np.uint64)
    return _judged(docs, lambda rows, model: _judge_large(rows, table, model), Model.collected(some, grams))


def _lead_bin(lead: Column) -> Column:
    return F.least(F.lit(LEAD_BINS), F.floor(F.log2(1 + lead) * 2).cast("int"))


def logistic(rows: list[tuple[float, float, float]]) -> tuple[float, float]:
    """(slope, offset) of P(right | x) from (x, right, wrong) counts: Newton steps on targets smoothed like Platt's."""
    right, wrong = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not right + wrong:
        return 0.5, 0.0
    high, low = (right + 1) / (right + 2), 1 / (wrong + 2)
    a, b = 0.0, math.log((right + 1) / (wrong + 1))
    for _ in range(50):
        ga = gb = 0.0
        haa = hab = hbb = 1e-6
        for x, r, w in rows:
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, a * x + b))))
            g, h = (r + w) * p - r * high - w * low, (r + w) * p * (1 - p)
            ga, gb, haa, hab, hbb = ga + g * x, gb + g, haa + h * x * x, hab + h * x, hbb + h
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-9))
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


def calibrate(judged: DataFrame) -> tuple[float, float, dict[str, float]]:
    """(slope, offset, accepted cross-entropy by language) from judged texts of known language.

    Two histograms of fixed numbers of bins (by language) reach the driver.
    """
    judged = judged.where("best is not null")
    right = F.col("best") == F.col("lang")
    leads = judged.groupBy(_lead_bin(F.col("lead")).alias("x")).agg(F.sum(right.cast("long")).alias("r"), F.sum((~right).cast("long")).alias("w")).collect()
    slope, offset = logistic([(float(r["x"]), float(r["r"]), float(r["w"])) for r in leads])
    step = F.least(F.lit(2000), F.ceil(F.col("entropy") / ENTROPY_STEP)).cast("int")
    counts = judged.where(right).groupBy("best", step.alias("step")).agg(F.count("*").alias("n"))
    total, below = Window.partitionBy("best"), Window.partitionBy("best").orderBy("step")
    shares = counts.select("best", "step", (F.sum("n").over(below) / F.sum("n").over(total)).alias("share"))
    limits = shares.where(F.col("share") >= REJECT).groupBy("best").agg(F.min("step").alias("step")).collect()
    return slope, offset, {r["best"]: r["step"] * ENTROPY_STEP for r in limits}


def identify(docs: DataFrame, train_on: Column, calibrate_on: Column) -> DataFrame:
    """One row per row of ``docs`` (id, text, lang, held_out): lang_pred, score, cross_entropy, rejected.

    Models are learned where ``train_on`` holds, scores calibrated where ``calibrate_on`` does; the final models are learned from both.
    """
    either = F.coalesce(train_on, F.lit(False)) | F.coalesce(calibrate_on, F.lit(False))
    counts = count(docs.where(either), calibrate_on)
    slope, offset, limits = calibrate(judge(docs.where(calibrate_on).where("lang is not null"), counts.where("not calibrates").select("lang", "gram", "n")))
    judged = judge(docs, counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    x = F.lit(slope) * _lead_bin(F.col("lead")) + F.lit(offset)
    limit = F.lit(None).cast("double")
    for lang, most in limits.items():
        limit = F.when(F.col("best") == lang, F.lit(most)).otherwise(limit)
    return judged.select(
        "id", "held_out", F.coalesce("best", F.lit("und")).alias("lang_pred"), F.when(F.col("best").isNull(), 0.0).otherwise(1 / (1 + F.exp(-x))).alias("score"),
        F.when(F.col("best").isNotNull(), F.col("entropy")).alias("cross_entropy"), F.coalesce(F.col("best").isNull() | (F.col("entropy") > limit), F.lit(False)).alias("rejected"),
    )


def by_fold(docs: DataFrame) -> DataFrame:
    """Languages of ``docs`` (doc_id, text, lang): folds by CRC-32 of the id; 0 is held out, 1 calibrates what 2 to 4 teach, 1 to 4 train."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text", "lang", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), fold.alias("fold"))
    out = identify(rows, F.col("fold") >= 2, F.col("fold") == 1)
    return out.withColumnRenamed("id", "doc_id")
