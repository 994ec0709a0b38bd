"""Mixing to target weights: soft domain membership and fitted document rates.

DataFrame functions only. A naive Bayes classifier, learned from a labelled table, gives every
document a posterior over domains; nonnegative rates (how often a document is to be used) are then
fitted so that the expected tokens of each domain, the sum of rate times tokens times posterior,
come to the target: by Newton steps on the rates inside their bounds, and by projected gradient
where bounds keep a target out of reach. Only sums by domain reach the driver: a handful of
numbers an iteration. A document's rate follows from its posterior and the gathered steps, so
iterations write nothing.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import landed

_NOBODY = 1e-12  # share of all tokens below which a domain has no document
_STALE = 8  # steps without gain after which a target counts as out of reach
_LOG = logging.getLogger(__name__)
_WORDS = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """``voice``: a text speaks with the weight of so many words, so long ones stay soft.

    ``max_labelled`` labelled texts, chosen by a hash of the id, train the classifier, whose words
    fall into ``buckets`` hash buckets: its table has a proven size and may be broadcast.
    Rates lie in [``low``, ``high``]; ``steps`` bounds the iterations. With ``strict`` a domain that
    misses its target by more than ``tolerance`` of the tokens it has is an error, else a warning.
    """

    max_labelled: int = 4000
    buckets: int = 1 << 14
    smoothing: float = 0.5
    voice: float = 20.0
    low: float = 0.0
    high: float = math.inf
    steps: int = 60
    tolerance: float = 1e-3
    strict: bool = True


def _tokens(docs: DataFrame, settings: Settings, *more: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    words = docs.select("doc_id", *more, F.explode_outer(F.split(text, _WORDS)).alias("w"))
    word = F.when(F.col("w") != "", F.col("w"))
    bucket = F.pmod(F.xxhash64("w"), F.lit(settings.buckets)).cast("int")
    return words.select("doc_id", *more, F.when(word.isNotNull(), bucket).alias("bucket"))


def word_weights(
    docs: DataFrame, labelled: DataFrame, domains: list[str], settings: Settings
) -> tuple[DataFrame, list[float], list[float]]:
    """Log-likelihoods by word bucket (columns ``w0``...), those of an unseen bucket, log priors.

    A domain without labelled rows has prior zero (minus infinity).
    """
    known = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    seen = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(seen.values())
    priors = [math.log(seen[d] / total) if d in seen else -math.inf for d in domains]
    # at most max_labelled ids: a proven bound for a broadcast
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(settings.max_labelled)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    tokens = _tokens(texts, settings, "domain").where("bucket IS NOT NULL")
    by_domain = [F.count(F.when(F.col("domain") == d, 1)).alias(f"c{k}") for k, d in enumerate(domains)]
    counts = landed(tokens.groupBy("bucket").agg(*by_domain), "mixing-counts")
    sums = counts.agg(*(F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in range(len(domains)))).first()
    rest = [n + settings.smoothing * settings.buckets for n in sums]
    weights = counts.select(
        "bucket",
        *(F.log((F.col(f"c{k}") + settings.smoothing) / rest[k]).alias(f"w{k}") for k in range(len(domains))),
    )
    return weights, [math.log(settings.smoothing / r) for r in rest], priors


def posteriors(
    docs: DataFrame, labelled: DataFrame, domains: list[str], settings: Settings = Settings()
) -> DataFrame:
    """``doc_id, n_tokens, p`` (posterior by domain) for every id of ``docs``.

    Rows that repeat an id are one document made of their texts. A text without words has the
    prior; without any labelled row the posterior is even.
    """
    weights, unseen, priors = word_weights(docs, labelled, domains, settings)
    tokens = _tokens(docs, settings).join(F.broadcast(weights), "bucket", "left")
    n = F.count("bucket")
    sums = tokens.groupBy("doc_id").agg(
        n.alias("n_tokens"),
        *(F.sum(F.coalesce(f"w{k}", F.lit(unseen[k]))).alias(f"s{k}") for k in range(len(domains))),
    )
    none = all(p == -math.inf for p in priors)
    priors = [0.0 if none else max(p, -700.0) for p in priors]
    voice = F.least(F.lit(settings.voice), F.col("n_tokens")) / F.greatest(F.col("n_tokens"), F.lit(1))
    logits = F.array(*(F.lit(priors[k]) + voice * F.col(f"s{k}") for k in range(len(domains))))
    sums = sums.select("doc_id", "n_tokens", logits.alias("_l"))
    raised = F.transform("_l", lambda x: F.exp(x - F.array_max("_l")))
    sums = sums.select("doc_id", "n_tokens", raised.alias("_e"))
    norm = F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)
    return sums.select("doc_id", "n_tokens", norm.alias("_n"), "_e").select(
        "doc_id", "n_tokens", F.transform("_e", lambda x: x / F.col("_n")).alias("p")
    )


def _rate(pushes: list[float], settings: Settings) -> Column:
    moved = F.lit(1.0)
    for k, push in enumerate(pushes):
        moved = moved - F.col("p")[k] * F.lit(push)
    return F.greatest(F.lit(settings.low), F.least(F.lit(settings.high), moved))


def fit_rates(
    soft: DataFrame, targets: dict[str, float], budget: float = 1.0, settings: Settings = Settings()
) -> tuple[DataFrame, list[tuple[str, float, float]]]:
    """``soft`` with a ``rate`` in [low, high], and (domain, target, expected tokens) of the fit.

    A rate is 1 less the document's posterior times a push by domain, projected onto the box; of all
    rates that reach the targets those are nearest to 1. Each step moves the pushes along the
    gradient, the gaps by domain. The gaps are measured in the metric of the curvature inside the box
    while that lowers the loss; a step that does not is taken back, halved, and after some halvings
    the metric is each domain's own tokens, whose step cannot overshoot. It ends within the
    tolerance, or, with the best rates seen, when steps bring nothing more. ``budget`` is the total to reach as
    a multiple of the tokens there are. A domain that no document belongs to cannot be reached: its
    target is shared out among the others in proportion, and the report gives it a target of 0.
    """
    domains = list(targets)
    size = len(domains)
    mass = [F.sum(F.col("n_tokens") * F.col("p")[k]) for k in range(size)]
    have = np.array([x or 0.0 for x in soft.agg(*mass).first()])
    live = have > _NOBODY * have.sum()
    weight = np.where(live, [targets[d] for d in domains], 0.0)
    want = budget * have.sum() * weight / (weight.sum() or 1.0)
    unit = np.where(live, have, 1.0)
    corner = [(j, k) for j in range(size) for k in range(j + 1)]

    def reached(pushes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected tokens, and how they change with the pushes."""
        rate = _rate(pushes.tolist(), settings)
        sums = [F.sum(rate * F.col("n_tokens") * F.col("p")[k]) for k in range(size)]
        inside = F.when((rate > settings.low) & (rate < settings.high), F.col("n_tokens"))
        sums += [F.sum(inside * F.col("p")[j] * F.col("p")[k]) for j, k in corner]
        found = np.array([x or 0.0 for x in soft.agg(*sums).first()])
        slope = np.zeros((size, size))
        for (j, k), x in zip(corner, found[size:]):
            slope[j, k] = slope[k, j] = x
        return found[:size], slope

    def gaps(got: np.ndarray) -> np.ndarray:
        return np.where(live, (got - want) / unit, 0.0)

    def loss(got: np.ndarray) -> float:
        return float((gaps(got) ** 2 * unit).sum())

    def scaled(slope: np.ndarray, off: np.ndarray) -> np.ndarray:
        root = np.sqrt(unit)
        return np.linalg.lstsq(slope / root[:, None] / root, off * root, rcond=1e-9)[0] / root

    pushes = np.zeros(size)
    got, slope = reached(pushes)
    best, direction, length, plain, stale = (loss(got), pushes, got), None, 1.0, False, 0
    for _ in range(settings.steps):
        off = gaps(got)
        if np.abs(off).max(initial=0) <= settings.tolerance:
            break
        if direction is None:
            direction = off if plain else scaled(slope, off)
        tried = np.where(live, pushes + length * direction, 0.0)
        there, bend = reached(tried)
        stale = stale + 1 if plain and loss(there) >= best[0] * (1 - 1e-5) else 0
        if stale == _STALE:
            break
        if loss(there) < best[0]:
            best = (loss(there), tried, there)
        elif not plain:
            length /= 2
            if length < 0.1:
                plain, direction, length = True, None, 1.0
                pushes, got = best[1], best[2]
            continue
        pushes, got, slope, direction, length = tried, there, bend, None, 1.0
    _, pushes, got = best
    report = list(zip(domains, want.tolist(), got.tolist()))
    return soft.withColumn("rate", _rate(pushes.tolist(), settings)), report


def missed(report: list[tuple[str, float, float]], settings: Settings) -> list[str]:
    """Domains of a report of ``fit_rates`` that are off target, with the shares of all tokens."""
    total = sum(w for _, w, _ in report)
    return [
        f"{d}: {g / total:.4f} of the wanted tokens, target {w / total:.4f}"
        for d, w, g in report
        if abs(g - w) > max(2 * settings.tolerance * max(w, g), _NOBODY * total)
    ]


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    budget: float = 1.0,
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per id of ``docs (doc_id, text)``: ``doc_id, n_tokens, p, rate``.

    ``labelled (doc_id, domain)`` names the domain of some documents; rows with a NULL, or with a
    domain that has no target, are ignored. NULL texts count as empty. Ties and repeated rows of
    ``labelled`` count as often as they occur. Other columns are not read. Domains that miss their
    target are an error or, if not ``strict`` or where no label tells domains apart, a warning; one
    that no document belongs to is a warning at most.
    """
    soft = landed(posteriors(docs, labelled, list(targets), settings), "mixing-posteriors")
    rates, report = fit_rates(soft, targets, budget, settings)
    if nobody := [d for d, w, _ in report if w == 0 and targets[d] > 0]:
        _LOG.warning(f"no document belongs to {', '.join(nobody)}: the others share the target")
    if off := missed(report, settings):
        said = f"rates in [{settings.low}, {settings.high}] miss the targets: {'; '.join(off)}"
        told = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(list(targets)))
        if settings.strict and not told.isEmpty():
            raise ValueError(said)
        _LOG.warning(said)
    return rates


def apply_rates(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """``docs`` with each row as often as its rate says; the fraction is decided by a hash of the id.

    Columns are those of ``docs``, whatever their names. A row whose id has no rate (a NULL id) stays
    once; rows that repeat an id are decided alike.
    """
    spot = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = rates.select("doc_id", (F.floor("rate") + (spot < F.col("rate") % 1).cast("int")).alias("times"))
    held = docs.select("doc_id", F.struct(*docs.columns).alias("row"))
    joined = held.join(times, "doc_id", "left").select("row", F.coalesce("times", F.lit(1)).cast("int").alias("times"))
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")).select("row.*")
