"""Language identification with interpolated Kneser-Ney character models.

One model per language, of order 4 over letters in lower case; every run of other characters is one boundary symbol. A
model is a set of sorted arrays: hashes of seen n-grams with their interpolated log probabilities, and hashes of seen
contexts with their back-off weights. A text gets the language whose model codes it in the fewest bits per symbol, the
length-normalised cross-entropy. It is rejected if even that lies beyond a limit calibrated on texts the models haven't
seen, which falls with the text's length. A language with fewer than ``LEAST_CALIBRATION`` such texts uses the spread of all
languages' texts, and its mean is raised by what so few texts leave open; if all have fewer together, there is no limit.

Fitting takes at most ``SAMPLE`` distinct whole texts per language, the ones with the smallest hashes; one in five
calibrates, the others train. Each language is counted in its own task. Prediction covers every text.

Null texts and texts without a letter are ``und``, score 0, and rejected. Training rows with null texts or languages
are left out. Equal cross-entropies go to the language that sorts first. Without any training row everything is ``und``,
and only texts without a letter are rejected, as nothing tells the others apart.
Very long texts are scored in pieces that overlap by the model's context. An empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ORDER = 4
SAMPLE = 1000  # distinct texts per language for fitting
PARTS = 64  # of a language that are ranked apart before the whole
CALIBRATION = 5  # one in so many of them
LEAST_CALIBRATION = 20  # calibration texts for a limit of a language's own
QUANTILE, MARGIN = 0.999, 1.5  # share of calibration texts inside the limit, and the factor beyond that
PIECE = 1 << 18  # symbols scored at once; bounds a worker at some 40 MB of arrays
UNKNOWN = "und"
MODEL = "lang string, order int, kind string, hash binary, value binary"
PREDICTED = "struct<lang_pred:string,score:double,cross_entropy:double,n_symbols:bigint,rejected:boolean>"


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, 0 for anything that is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        if char.isalpha():
            table[point] = ord(char.lower()[0])
    return table


_TABLE: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Letters in lower case with one boundary (0) for each run between, before and after them; empty without letters."""
    if not _TABLE:
        _TABLE.append(letter_table())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    found = _TABLE[0][points]
    if not found.any():
        return found[:0]
    keep = found != 0
    keep[1:] |= found[:-1] != 0  # the first of each run of others
    found = found[keep]
    found = found[1:] if found[0] == 0 else found
    return found if found[-1] == 0 else np.append(found, np.uint32(0))


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length k from 1 to ``order`` the hash of the k symbols that end at each position from order - 1 on."""
    wide, out = codes.astype(np.uint64) + np.uint64(1), []
    n = len(codes) - order + 1
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(1, order + 1):
            part = wide[order - k: order - k + n] * np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64))
            total = total + (part ^ (part >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append(total ^ (total >> np.uint64(32)))
    return out


def padded(codes: np.ndarray, order: int) -> np.ndarray:
    return np.concatenate([np.zeros(order - 1, np.uint32), codes])


@dataclass
class CharModel:
    """Sorted hash arrays by order: n-grams with log2 probabilities, contexts with log2 back-off weights."""

    order: int
    grams: list[np.ndarray]
    values: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    floor: float  # log2 probability of an unseen symbol

    def log2(self, hashes: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        """Of grams given by their hashes of every length, and of the contexts before their last symbols."""
        out = np.zeros(len(hashes[0]), np.float32)
        left = np.arange(len(out))
        for k in range(self.order, 0, -1):
            wanted = hashes[k - 1][left]
            at = np.minimum(np.searchsorted(self.grams[k - 1], wanted), len(self.grams[k - 1]) - 1)
            seen = self.grams[k - 1][at] == wanted
            out[left[seen]] += self.values[k - 1][at[seen]]
            left = left[~seen]
            if k > 1 and len(left):
                wanted = before[k - 2][left]
                at = np.minimum(np.searchsorted(self.contexts[k - 1], wanted), len(self.contexts[k - 1]) - 1)
                known = self.contexts[k - 1][at] == wanted
                out[left[known]] += self.weights[k - 1][at[known]]
        out[left] += self.floor
        return out


def count_grams(texts: Iterable[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams of the highest order over all texts: hashes of every length, the context hashes of every
    length below, and counts. Each text is reduced to its distinct n-grams before it is kept."""
    kept: list[tuple[np.ndarray, ...]] = []

    def merged() -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*kept)]
        top, first, inverse = np.unique(columns[order - 1], return_index=True, return_inverse=True)
        return (*(c[first] for c in columns[:-1]), np.bincount(inverse, columns[-1], len(top)))

    held = 0
    for text in texts:
        codes = symbols(text)
        if len(codes):
            codes = padded(codes, order)
            hashes = gram_hashes(codes, order)
            before = gram_hashes(np.concatenate([[np.uint32(0)], codes[:-1]]), order)[: order - 1]
            _, first, counts = np.unique(hashes[-1], return_index=True, return_counts=True)
            kept.append((*(h[first] for h in hashes), *(h[first] for h in before), counts.astype(float)))
            held += len(first)
        if held > 2_000_000:
            kept = [merged()]
            held = 0
    if not kept:
        return [], np.zeros(0)
    *columns, counts = merged()
    return columns, counts


def fit_model(texts: Iterable[str], order: int = ORDER) -> CharModel | None:
    """Interpolated Kneser-Ney: the highest order counts occurrences, the others distinct symbols that come before."""
    columns, counts = count_grams(texts, order)
    if not columns:
        return None
    hashes, before = columns[:order], columns[order:]
    # From the highest order down: distinct grams with counts, their contexts and the grams without the first symbol.
    levels = []
    for k in range(order, 0, -1):
        grams, first = np.unique(hashes[k - 1], return_index=True)
        if k == order:
            number = counts[first]
        else:
            number = np.unique(hashes[k - 1][np.unique(hashes[k], return_index=True)[1]], return_counts=True)[1].astype(float)
        levels.append((grams, number, before[k - 2][first] if k > 1 else np.zeros(len(first), np.uint64),
                       hashes[k - 2][first] if k > 1 else None))
    values: list[np.ndarray] = [np.zeros(0)] * order
    contexts, weights = [np.zeros(0, np.uint64)] * order, [np.zeros(0)] * order
    floor = 0.0
    for k, (grams, number, context, shorter) in zip(range(1, order + 1), reversed(levels)):
        ones, twos = (number == 1).sum(), (number == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and ones + 2 * twos else 0.5
        seen, inverse = np.unique(context, return_inverse=True)
        total = np.bincount(inverse, number, len(seen))
        back = discount * np.bincount(inverse, minlength=len(seen)) / total
        if k == 1:
            lower = np.full(len(grams), 1 / (sys.maxunicode + 1))
            floor = float(np.log2(back[0] / (sys.maxunicode + 1)))
        else:
            lower = values[k - 2][np.searchsorted(levels[order - k + 1][0], shorter)]
        values[k - 1] = np.maximum(number - discount, 0) / total[inverse] + back[inverse] * lower
        contexts[k - 1], weights[k - 1] = seen, back
    return CharModel(
        order, [x[0] for x in reversed(levels)], [np.log2(v).astype(np.float32) for v in values], contexts,
        [np.log2(w).astype(np.float32) for w in weights], floor)


def sample(df: DataFrame, text: str, lang: str, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` distinct texts per language by smallest hash, with ``calibrates`` for one in five. The limit of
    each language is applied in every map task before the shuffle, also in a hot language."""
    rows = df.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    # Copies of a text count once. Ranks in parts of a language first leave its last task a bounded number of hashes.
    hashes = rows.select("lang", "h").distinct()
    parts = Window.partitionBy("lang", F.pmod("h", F.lit(PARTS))).orderBy("h")
    few = hashes.withColumn("r", F.row_number().over(parts)).filter(F.col("r") <= size).drop("r")
    ranked = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= size)
    chosen = rows.join(F.broadcast(ranked), ["lang", "h"])  # size rows per language
    return chosen.groupBy("lang", "h").agg(F.first("text").alias("text"), F.first("r").alias("r")).select(
        "lang", "text", (F.col("r") % CALIBRATION == 0).alias("calibrates"))


def _fit_group(order: int):
    def fit(group: pa.Table) -> pa.Table:
        model = fit_model(group.column("text").to_pylist(), order)
        rows: dict[str, list] = {"lang": [], "order": [], "kind": [], "hash": [], "value": []}
        lang = group.column("lang")[0].as_py()
        for k in range(order if model else 0):
            for kind, keys, values in (("gram", model.grams[k], model.values[k]), ("context", model.contexts[k], model.weights[k])):
                for name, cell in zip(rows, (lang, k + 1, kind, keys.tobytes(), values.astype(np.float32).tobytes())):
                    rows[name].append(cell)
        if model:
            for name, cell in zip(rows, (lang, 0, "floor", b"", np.float32(model.floor).tobytes())):
                rows[name].append(cell)
        return pa.table(rows, schema=pa.schema([("lang", pa.string()), ("order", pa.int32()), ("kind", pa.string()),
                                                ("hash", pa.binary()), ("value", pa.binary())]))

    return fit


@dataclass
class Identifier:
    """Models by language, and the calibrated limit: mean bits per symbol plus ``slack`` / sqrt(symbols)."""

    models: dict[str, CharModel]
    mean: dict[str, float]
    slack: dict[str, float]

    def bits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text under each model, and each text's number of symbols. Texts are scored together in pieces
        of bounded length; equal n-grams of a piece are looked up once."""
        order = next(iter(self.models.values())).order
        totals, lengths = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        owners: list[int] = []

        def flush() -> None:
            if not parts:
                return
            joined = np.concatenate(parts)
            hashes = gram_hashes(joined, order)
            ends = np.cumsum([len(p) for p in parts])
            spans = [(end - len(part), end - order + 1) for part, end in zip(parts, ends)]  # positions that end in the part itself
            _, first, inverse = np.unique(hashes[-1], return_index=True, return_inverse=True)
            before = gram_hashes(np.concatenate([[np.uint32(0)], joined[:-1]]), order)
            costs = np.stack([-m.log2([h[first] for h in hashes], [h[first] for h in before]) for m in self.models.values()])
            for c, cost in enumerate(costs):
                running = np.concatenate([[0.0], np.cumsum(cost[inverse], dtype=np.float64)])
                for owner, (start, end) in zip(owners, spans):
                    totals[owner, c] += running[end] - running[start]
            parts.clear()
            owners.clear()

        held = 0
        for i, text in enumerate(texts):
            codes = symbols(text)
            lengths[i] = len(codes)
            codes = padded(codes, order)
            for start in range(0, lengths[i], PIECE):
                parts.append(codes[start: start + PIECE + order - 1])
                owners.append(i)
                held += len(parts[-1])
                if held > PIECE:
                    flush()
                    held = 0
        flush()
        return totals, lengths

    def predict(self, texts: list[str]) -> list[tuple[str, float, float | None, int, bool]]:
        if not self.models:
            return [(UNKNOWN, 0.0, None, n, n == 0) for n in (len(symbols(t)) for t in texts)]
        names = list(self.models)
        totals, lengths = self.bits(texts)
        out = []
        for bits, n in zip(totals, lengths):
            if not n:
                out.append((UNKNOWN, 0.0, None, 0, True))
                continue
            best = int(bits.argmin())
            share = float(1 / np.exp2(np.clip(bits[best] - bits, -1000, 0)).sum())
            entropy = float(bits[best] / n)
            limit = self.mean[names[best]] + self.slack[names[best]] / np.sqrt(n)
            out.append((names[best], share, entropy, int(n), bool(entropy > limit)))
        return out


def fit(df: DataFrame, text: str, lang: str, size: int = SAMPLE, order: int = ORDER) -> Identifier:
    """Models and limits from labelled rows. What reaches the driver is bounded by ``size`` texts per language."""
    from .common import materialize

    chosen = materialize(sample(df, text, lang, size), "langid-sample")
    rows = chosen.filter(~F.col("calibrates")).groupBy("lang").applyInArrow(_fit_group(order), MODEL).collect()
    models: dict[str, CharModel] = {}
    for name in sorted({r["lang"] for r in rows}):
        own = {(r["kind"], r["order"]): r for r in rows if r["lang"] == name}
        hashes = {k: np.frombuffer(r["hash"], np.uint64) for k, r in own.items()}
        values = {k: np.frombuffer(r["value"], np.float32) for k, r in own.items()}
        ks = range(1, order + 1)
        models[name] = CharModel(
            order, [hashes["gram", k] for k in ks], [values["gram", k] for k in ks],
            [hashes["context", k] for k in ks], [values["context", k] for k in ks], float(values["floor", 0][0]))
    identifier = Identifier(models, dict.fromkeys(models, 0.0), dict.fromkeys(models, float("inf")))
    if models:
        scored = chosen.filter("calibrates").select("lang", predict_column(F.col("text"), identifier).alias("p")).filter(
            "p.lang_pred = lang and p.n_symbols > 0").select("lang", "p.cross_entropy", "p.n_symbols").collect()
        calibrate(identifier, [(r["lang"], r["cross_entropy"], r["n_symbols"]) for r in scored])
    return identifier


def calibrate(identifier: Identifier, scored: list[tuple[str, float, int]]) -> None:
    """Set the limits from (language, cross-entropy, symbols) of calibration texts."""
    over, total = {}, {}
    for name in identifier.models:
        own = np.array([r[1:] for r in scored if r[0] == name])
        if len(own):
            identifier.mean[name] = float(np.average(own[:, 0], weights=own[:, 1]))
            over[name] = (own[:, 0] - identifier.mean[name]) * np.sqrt(own[:, 1])
            total[name] = own[:, 1].sum()
    pooled = np.concatenate([*over.values(), []])
    for name, own in over.items():
        if len(own) >= LEAST_CALIBRATION:
            identifier.slack[name] = MARGIN * float(np.quantile(own, QUANTILE))
        elif len(pooled) >= LEAST_CALIBRATION:
            identifier.slack[name] = MARGIN * float(np.quantile(pooled, QUANTILE))
            identifier.mean[name] += identifier.slack[name] / float(np.sqrt(total[name]))


def predict_column(text: Column, identifier: Identifier) -> Column:
    """Prediction of each text. The models are broadcast; their size is bounded by the fitting sample."""
    from pyspark.sql import SparkSession

    shared = SparkSession.getActiveSession().sparkContext.broadcast(identifier)

    @F.arrow_udf(PREDICTED)
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            rows = model.predict([v.as_py() or "" for v in batch])
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.bool_())
            yield pa.StructArray.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                names=["lang_pred", "score", "cross_entropy", "n_symbols", "rejected"])

    return predicted(text)
