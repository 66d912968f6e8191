"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom.llm.text import bounded_batches, clear_of, coded_words, hashes, slices, texts_of
from assayloom.session import broadcast_limit, materialise


#: Bytes of a key and its score.
_SCORE_BYTES = 12
#: Lengths of the word beginnings that stand in for a word of too few occurrences, longest first.
_STEMS = (8, 7, 6, 5, 4)


@dataclass(frozen=True)
class TokenScores:
    """Log-odds of the telling words and word beginnings by their 64-bit hash, ascending; every token loses ``drift``.

    ``stored`` has them as a table (key, score) in place of the arrays where they exceed the broadcast limit.
    """

    keys: np.ndarray
    values: np.ndarray
    drift: float
    stored: DataFrame | None = None


@dataclass(frozen=True)
class ToxicityModel:
    """Token scores, the background's extreme-value law, and its calibration.

    ``lam`` and ``k``: the best segment of n background tokens exceeds x with
    probability 1 - exp(-k n exp(-lam x)). The segments of ``bound`` or more are
    counted too: ``many`` n exp(-lam x) of them are expected to exceed x.
    ``slope`` and ``shift`` turn the evidence (minus the log of the probability
    of a text's segments) into a score.
    """

    tokens: TokenScores
    lam: float
    k: float
    many: float
    bound: float
    slope: float
    shift: float


def _tokens(part, text):
    """(offsets, codes, distinct): letter and digit runs of a slice's texts, in lower case."""
    return coded_words(pc.replace_substring_regex(pc.utf8_lower(texts_of(part, text)), r"[^\p{L}\p{N}]+", " "))


def _features(distinct: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(key, whether it applies) of each word, then of its proper beginnings, longest first."""
    out = [(hashes(distinct), np.ones(len(distinct), bool))]
    size = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
    for n in _STEMS:
        long = size > n
        key = np.zeros(len(distinct), np.uint64)
        key[long] = hashes(pc.utf8_slice_codeunits(distinct.filter(pa.array(long)), 0, n), n)
        out.append((key, long))
    return out


def _values(part, text, scores: TokenScores):
    """(offsets, score of each token): a word's own, else that of its longest telling beginning."""
    offsets, codes, distinct = _tokens(part, text)
    value = np.zeros(len(distinct))
    if len(scores.keys):
        for key, applies in _features(distinct):
            at = np.minimum(np.searchsorted(scores.keys, key), len(scores.keys) - 1)
            value = np.where((value == 0) & applies & (scores.keys[at] == key), scores.values[at], value)
    return offsets, (value - scores.drift)[codes]


def best_segments(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Highest total of a run of consecutive values in each document, 0 if none is positive.

    One pass: running total minus its lowest point so far.
    """
    total = np.concatenate(([0.0], np.cumsum(values)))
    out = np.zeros(len(offsets) - 1)
    for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
        if b > a:
            run = total[a:b + 1]
            out[i] = (run - np.minimum.accumulate(run)).max()
    return out


def all_segments(values, least: float) -> list[tuple[int, int, float]]:
    """Every maximal scoring segment of at least ``least``: (first token, token after, score).

    Linear time: segments wait in a list with the totals before and after them; a
    new one absorbs earlier ones for as long as that makes it larger. Each knows
    the last earlier one of a lower total before it, so no search looks at one twice.
    """
    values = np.asarray(values, float)
    total = np.concatenate(([0.0], np.cumsum(values)))
    rising = np.nonzero(values > 0)[0]
    waiting: list[tuple[int, int, float, float, int]] = []  # start, end, total before, total after, earlier one
    for start, low, high in zip(rising.tolist(), total[rising].tolist(), total[rising + 1].tolist()):
        end, k = start + 1, len(waiting) - 1
        while k >= 0 and waiting[k][2] >= low:
            k = waiting[k][4]
        while k >= 0 and waiting[k][3] < high:
            start, _, low, _, earlier = waiting[k]
            del waiting[k:]
            k = earlier
        waiting.append((start, end, low, high, k))
    return [(a, b, high - low) for a, b, low, high, _ in waiting if high - low >= least]


def _lambda(values: np.ndarray, weights: np.ndarray) -> float:
    """The positive solution of sum(p exp(lam s)) = 1 for scores of negative mean."""
    p = weights / weights.sum()
    high = 1.0
    while (p * np.exp(np.minimum(high * values, 600))).sum() < 1 and high < 64:
        high *= 2
    low = 0.0
    for _ in range(80):
        middle = (low + high) / 2
        if (p * np.exp(np.minimum(middle * values, 600))).sum() < 1:
            low = middle
        else:
            high = middle
    return max(low, 1e-3)


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps on counted values, lightly shrunk."""
    slope, shift = 0.1, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
        w = n * p * (1 - p) + 1e-9
        g = np.array([(n * (y - p) * x).sum() - 0.05 * slope, (n * (y - p)).sum() - 0.05 * shift])
        h = np.array([[(w * x * x).sum() + 0.05, (w * x).sum()], [(w * x).sum(), w.sum() + 0.05]])
        step = np.linalg.solve(h, g)
        slope, shift = slope + step[0], shift + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(slope), 0.0), float(shift)


def token_scores(labelled: DataFrame, text: str = "text", label: str = "toxic", prior: float = 2000.0,
                 drift: float = 0.5) -> TokenScores:
    """Learn from rows with a 0/1 ``label``; rows without one say nothing.

    Counts cover all labelled rows, a word once per document, so that no long
    document decides; words and beginnings go by their 64-bit hash, so that a score
    is one word's own and a word never seen has none. A score is the log-odds of the
    classes under a Dirichlet prior of ``prior`` words spread as all text is, kept
    where the likelihood ratio exceeds the noise of so many comparisons. Scores that
    exceed the session's broadcast limit stay a table, which ``measure`` joins.
    """
    bounded_batches(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").cast("int").alias("label"))

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, codes, distinct = _tokens(part, "text")
                of_doc = np.repeat(np.arange(part.num_rows), np.diff(offsets))
                once = np.unique(of_doc * len(distinct) + codes)
                side = np.asarray(part["label"].to_pylist(), np.int64)[once // max(1, len(distinct))]
                n = np.bincount(side * len(distinct) + once % max(1, len(distinct)),
                                minlength=2 * len(distinct)).reshape(2, -1)
                found = _features(distinct)
                keys, place = np.unique(np.concatenate([key[applies] for key, applies in found]), return_inverse=True)
                both = [np.bincount(place, np.concatenate([n[c][applies] for _, applies in found]), len(keys)).astype(np.int64)
                        for c in (0, 1)]
                # The row without a key holds the numbers of words.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(keys.view(np.int64), 0), mask=np.arange(len(keys) + 1) == len(keys)),
                     *[pa.array(np.append(both[c], n[c].sum())) for c in (0, 1)]], ["key", "clean", "toxic"])

    counts = materialise(
        rows.where("label IN (0, 1)").mapInArrow(count, "key long, clean long, toxic long").groupBy("key")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "token-counts")
    total = counts.agg(
        F.sum(F.when(F.col("key").isNull(), F.col("clean"))).alias("clean"), F.sum(F.when(F.col("key").isNull(), F.col("toxic"))).alias("toxic"),
        F.count("key").alias("seen")).first()
    shown = stored = None
    if total["clean"] and total["toxic"]:
        both = total["clean"] + total["toxic"]
        seen = F.col("clean") + F.col("toxic")

        def gain(c):
            return F.when(F.col(c) > 0, F.col(c) * F.log(F.col(c) * F.lit(float(both)) / (seen * total[c]))).otherwise(0.0)

        def odds(c):
            smoothed = F.col(c) + seen * (prior / both) + 0.5
            return F.log(smoothed) - F.log(F.greatest(total[c] + prior - smoothed, F.lit(1.0)))

        # Likelihood ratio against equal rates, beyond what the best of so many keys reaches by chance.
        noise = 4 * math.log(max(2, total["seen"]))
        shown = materialise(
            counts.where("key IS NOT NULL").where(2 * (gain("clean") + gain("toxic")) > noise)
            .select("key", (odds("toxic") - odds("clean")).cast("float").alias("score")), "token-scores")
        if shown.count() * _SCORE_BYTES > broadcast_limit(labelled.sparkSession):
            shown, stored = None, shown
    found = shown.collect() if shown is not None else []
    return TokenScores(*_ascending([r["key"] for r in found], [r["score"] for r in found]), drift, stored)


def _ascending(keys: list[int], values: list[float]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.array(keys, np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array(values, np.float32)[order]


_SEGMENT = "struct<first_token:long,end_token:long,score:double>"


def measure(docs: DataFrame, scores: TokenScores, doc_id: str = "doc_id", text: str = "text",
            bins: float = 0.05) -> DataFrame:
    """doc_id, segments, tokens of every row, and after them the histogram of token scores of each task.

    ``segments`` are all maximal segments, ``tokens`` the number of tokens; histogram
    rows have the token score (to ``bins``) in ``bin``, null elsewhere, and the count in ``tokens``.
    """
    source = clear_of(docs, doc_id, text)
    kind = source.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, segments array<{_SEGMENT}>, tokens long, bin double"
    if scores.stored is not None:
        return _measured_by_join(source.toDF("doc_id", "text"), scores, bins, schema)
    shared = source.sparkSession.sparkContext.broadcast(scores)  # the telling keys, within the broadcast limit

    def apply(batches):
        held: dict[int, int] = {}
        of_id = None
        for batch in batches:
            of_id = batch.schema.field(doc_id).type
            for part in slices(batch, text):
                yield _measured(part[doc_id], *_values(part, text, shared.value), bins, held)
        if held:
            yield _histogram(held, of_id, bins)

    return source.mapInArrow(apply, schema)


_MEASURED = ["doc_id", "segments", "tokens", "bin"]


def _lists(found) -> pa.ListArray:
    """A list of segments for each text; none at all for the rows of the histogram."""
    flat = [s for own in found for s in own]
    ends = np.concatenate(([0], np.cumsum([len(own) for own in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
        [pa.array([s[0] for s in flat], pa.int64()), pa.array([s[1] for s in flat], pa.int64()),
         pa.array([s[2] for s in flat], pa.float64())], ["first_token", "end_token", "score"]))


def _measured(ids: pa.Array, offsets, values, bins: float, held: dict[int, int]) -> pa.RecordBatch:
    """The rows of a slice's texts; their token scores are counted in ``held``."""
    place, n = np.unique(np.round(values / bins).astype(np.int64), return_counts=True)
    for p, k in zip(place.tolist(), n.tolist()):
        held[p] = held.get(p, 0) + k
    found = [all_segments(values[a:b], 1e-9) for a, b in zip(offsets[:-1], offsets[1:])]
    return pa.RecordBatch.from_arrays([ids, _lists(found), pa.array(np.diff(offsets)), pa.nulls(len(ids), pa.float64())], _MEASURED)


def _histogram(held: dict[int, int], of_id: pa.DataType, bins: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.nulls(len(held), of_id), _lists([()] * len(held)), pa.array(list(held.values()), pa.int64()),
         pa.array([p * bins for p in held])], _MEASURED)


def _measured_by_join(source: DataFrame, scores: TokenScores, bins: float, schema: str) -> DataFrame:
    """As ``measure`` for any number of telling keys: each slice of texts asks for its own distinct keys.

    A key is asked for once a slice, so the most frequent one has a row a slice, and a
    slice gets back no more scores than it has distinct words and beginnings.
    """
    drift = scores.drift

    def ask(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                distinct = _tokens(part, "text")[2]
                keys = np.unique(np.concatenate([key[applies] for key, applies in _features(distinct)]))
                ends = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, part["doc_id"]), pa.ListArray.from_arrays(ends, part["text"]),
                     pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.array(keys.view(np.int64)))],
                    ["ids", "texts", "keys"])

    kind = source.schema["doc_id"].dataType.simpleString()
    asked = materialise(source.mapInArrow(ask, f"ids array<{kind}>, texts array<string>, keys array<long>")
                        .withColumn("slice", F.monotonically_increasing_id()), "slices")
    told = (asked.select("slice", F.explode("keys").alias("key")).join(scores.stored.hint("merge"), "key")
            .select(F.col("slice").alias("of"), "key", "score"))

    def apply(left, right):
        held, out = {}, []
        ids, texts = (pc.list_flatten(left[c].combine_chunks()) for c in ("ids", "texts"))
        own = TokenScores(*_ascending(right["key"].to_pylist(), right["score"].to_pylist()), drift)
        part = pa.RecordBatch.from_arrays([ids, texts], ["doc_id", "text"])
        out.append(_measured(ids, *_values(part, "text", own), bins, held))
        if held:
            out.append(_histogram(held, ids.type, bins))
        return pa.Table.from_batches(out)

    return asked.drop("keys").groupBy("slice").cogroup(told.groupBy("of")).applyInArrow(apply, schema)


#: Segments that background text may hold per token above the bound from which they are counted.
_RATE = 0.01


def _evidence(lam: float, k: float, many: float, bound: float):
    """Minus the log of the chance that background text of a row's length does as well, from 0 to 60.

    Over r, the chance of r segments as high as its r-th highest: that of the highest by
    the extreme-value law; for more, of the segments from ``bound`` on, Chernoff's
    bound of a Poisson count. Looking at every r costs a factor of r(r + 1) / 2.
    """
    n = F.greatest(F.col("tokens"), F.lit(1))

    def expected(scale, s):
        return scale * n * F.exp(-F.least(lam * s, F.lit(500.0)))

    def several(s, i):
        r, e = i + F.lit(1.0), expected(many, s)
        return F.when((i > 0) & (r > e), r * F.log(r / e) - r + e - F.log(r * (r + 1) / 2)).otherwise(0.0)

    ranked = F.sort_array(F.transform("segments", lambda s: s["score"]), asc=False)
    best = F.get(ranked, F.lit(0))
    chance = -F.expm1(-F.least(expected(k, best), F.lit(700.0)))
    found = F.greatest(-F.log(F.greatest(chance, F.lit(1e-26))),
                       F.array_max(F.transform(F.filter(ranked, lambda s: s >= bound), several)))
    return F.when(best > 0, F.greatest(F.lit(0.0), F.least(F.lit(60.0), found))).otherwise(0.0)


def calibrate(measured: DataFrame, labels: DataFrame, scores: TokenScores, doc_id: str = "doc_id",
              label: str = "toxic") -> ToxicityModel:
    """The background's law from all token scores, and the curve from evidence to score on labelled documents."""
    bins = measured.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("tokens").alias("n")).orderBy("bin").toPandas()
    value, weight = bins["bin"].to_numpy(float), bins["n"].to_numpy(float)
    lam, k, many, bound = 1.0, 1.0, 1.0, 0.0
    if len(value) and value.max() > 0 and (value * weight).sum() < 0:
        lam = _lambda(value, weight)
        # Segments start at a rising token: their share of all tokens scales the law.
        k = float(weight[value > 0].sum() / weight.sum())
        bound = max(0.0, math.log(k / _RATE) / lam)
        # As many as there are in all texts at least, so that a usual text is no evidence.
        above = measured.agg(F.sum(F.size(F.filter("segments", lambda s: s["score"] >= bound)))).first()[0]
        many = max(k, float(above or 0) / weight.sum() * math.exp(lam * bound))
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
    found = (measured.where("bin IS NULL").join(known.where("label IN (0, 1)"), "doc_id")
             .groupBy(F.round(_evidence(lam, k, many, bound), 1).alias("x"), "label").count().toPandas())
    if not len(found):
        return ToxicityModel(scores, lam, k, many, bound, 0.0, -20.0)
    every = found.groupby("x")["count"].sum()
    toxic = found[found["label"] == 1].set_index("x")["count"].reindex(every.index).fillna(0)
    slope, shift = _logistic(every.index.to_numpy(float), toxic.to_numpy(float) / every.to_numpy(float), every.to_numpy(float))
    return ToxicityModel(scores, lam, k, many, bound, slope, shift)


def score(measured: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted of every measured row; a null or empty text is one without any evidence."""
    x = _evidence(model.lam, model.k, model.many, model.bound)
    value = 1 / (1 + F.exp(-(F.lit(model.slope) * x + F.lit(model.shift))))
    return (measured.where("bin IS NULL").select("doc_id", value.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def significant(measured: DataFrame, model: ToxicityModel, significance: float = 0.01) -> DataFrame:
    """Every significant passage of measured rows: doc_id, first_token, end_token, score, p_value.

    A passage counts when background text of the document's length holds one as
    high with probability ``significance`` at most.
    """
    chance = -F.expm1(-F.lit(model.k) * F.greatest(F.col("tokens"), F.lit(1)) * F.exp(-F.lit(model.lam) * F.col("s.score")))
    return (measured.where("bin IS NULL").select("doc_id", "tokens", F.explode("segments").alias("s"))
            .select("doc_id", "s.first_token", "s.end_token", "s.score", chance.alias("p_value"))
            .where(F.col("p_value") <= significance))


def passages(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text",
             significance: float = 0.01) -> DataFrame:
    """The significant passages of texts; tokens are the letter and digit runs of the text."""
    return significant(measure(docs, model.tokens, doc_id, text), model, significance)
