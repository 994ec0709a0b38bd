"""Secret scans: three fixed patterns, and a linear-chain conditional random field beside them.

The field tags the words of a text as begin, inside or outside of a secret from a word's shape, its
neighbours and features of the whole text. It is trained by maximum likelihood in numpy on windows
of a bounded sample, labelled by the patterns, and decoded by Viterbi. Decoding is exact but only
looks at few words: where the outside tag leads by more than any two transitions can weigh, the best
path goes through it, and the chain falls apart into short runs between such words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import Words, mix, slices, split, utf8

# fixed values: the patterns, the group that is the secret, and its least length, in the order of kinds
PATTERNS = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
            re.IGNORECASE | re.ASCII,
        ),
        2,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),  # a run is taken whole, so short ones drop either way
}
# words that announce a secret
_KEYWORDS = (
    "password", "passwd", "passphrase", "pwd", "secret", "token", "key", "apikey", "api_key", "api-key",
    "auth", "authorization", "bearer", "credential", "credentials", "access_key", "private_key",
)
_ENDS = ("", ":", "=", '":', "':", '"=', ",", "=>")
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_OUTSIDE, _BEGIN, _INSIDE = 0, 1, 2
_TAGS = 3


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, and of the training.

    ``max_texts`` texts of any kind and ``max_hits`` texts in which a pattern has a span.
    """

    max_texts: int = 2000
    max_hits: int = 500
    window: int = 24
    steps: int = 80
    rate: float = 0.3
    decay: float = 1e-4


@dataclass(frozen=True)
class Model:
    emission: np.ndarray  # features x tags
    transition: np.ndarray  # from tag x to tag


def base_matches(text: str, raw: bytes) -> list[tuple[int, int, str, int, int]]:
    """Secrets of the fixed patterns by start, then by kind as listed: start, end and kind, and start
    and end of the whole match that holds the secret. ``raw`` is the text in UTF-8."""
    low, kinds = raw.lower(), []
    if any(k in low for k in (b"passw", b"secret", b"token", b"api")):
        kinds.append("assign")
    if b"AKIA" in raw:
        kinds.append("access")
    if _has_long_run(_HEX[np.frombuffer(raw, np.uint8)], 16):
        kinds.append("hex")
    found = []
    for rank, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        if kind in kinds:
            for m in pattern.finditer(text):
                if len(m[group]) >= least:
                    found.append((m.start(group), rank, m.end(group), kind, *m.span()))
    return [(start, end, kind, *match) for start, _, end, kind, *match in sorted(found)]


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, str]]:
    """``base_matches`` without the whole matches."""
    return [found[:3] for found in base_matches(text, raw)]


def _has_long_run(mask: np.ndarray, least: int) -> bool:
    gaps = np.flatnonzero(~mask)
    return bool(np.diff(gaps, prepend=-1, append=len(mask)).max(initial=0) > least)


# ---- features --------------------------------------------------------------------------------

_KINDS = {"digit": (48, 57), "upper": (65, 90), "lower": (97, 122)}
_CLASS = np.full(256, 3, np.uint8)
for _k, (_a, _b) in enumerate(_KINDS.values()):
    _CLASS[_a : _b + 1] = _k
_CLASS[128:] = 4
_EDGE = np.where(np.isin(np.arange(256), list(b"\"'`")), 5, _CLASS).astype(np.uint8)
_LENGTHS = np.array([4, 8, 12, 16, 24, 40, 64])
_SHARES = np.array([1e-9, 0.2, 0.5, 0.999])
_TURNS = np.array([1, 3, 6, 11])
# how many values each feature has, in the order of `features`
_SIZES = [8, 5, 5, 5, 5, 2, 4, 5, 6, 6, 2, 2, 2, 2, 2, 2, 3, 2, 8]
_OFFSETS = np.concatenate([[0], np.cumsum(_SIZES)])
FEATURES = int(_OFFSETS[-1])


def _keyword_codes() -> np.ndarray:
    forms = [o + k + e for k in _KEYWORDS for e in _ENDS for o in ("", '"', "'")]
    return np.sort(split([f.encode() for f in forms], lower=True).code)


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


_CODES = _keyword_codes()


def features(texts: list[bytes]) -> tuple[Words, np.ndarray]:
    """The words of the texts and, for each word, the numbers of its active features."""
    words = split(texts, lower=True)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start, end, n = words.start, words.end, len(words.start)
    length = end - start
    kind = _CLASS[raw]

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(mask, out=sums[1:])
        return sums[end] - sums[start]

    counts = [total(kind == k) for k in range(5)]
    hexes = total(_HEX[raw])
    turn = np.zeros(len(raw), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turns = np.maximum(total(turn) - turn[start], 0) if n else total(turn)
    marks = total((raw == 61) | (raw == 58))
    keyword = _member(words.code, _CODES) if n else np.zeros(0, bool)
    opens = np.isin(raw[end - 1], list(b":=")) if n else np.zeros(0, bool)
    owner = words.text_of()

    def shifted(flag: np.ndarray, by: int) -> np.ndarray:
        """The flag of the word ``by`` places before, in the same text."""
        out = np.zeros(n, bool)
        if by > 0:
            out[by:] = flag[:-by] & (owner[by:] == owner[:-by])
        else:
            out[:by] = flag[-by:] & (owner[:by] == owner[-by:])
        return out

    texts_n = max(len(texts), 1)
    with_digit = np.bincount(owner, counts[0] > 0, texts_n) / np.maximum(np.bincount(owner, minlength=texts_n), 1)
    announced = np.bincount(owner, keyword, texts_n) > 0
    share = [np.searchsorted(_SHARES, c / np.maximum(length, 1), "right") for c in counts]
    looks_long = np.searchsorted(_LENGTHS, length, "right")
    columns = [
        looks_long, share[0], share[1], share[2], share[3], counts[4] > 0,
        2 * (hexes == length) + (hexes >= 16), np.searchsorted(_TURNS, turns, "right"),
        _EDGE[raw[start]], _EDGE[raw[end - 1]],
        shifted(keyword, 1), shifted(keyword, 2), shifted(keyword, 3), shifted(opens, 1), marks > 0,
        shifted(looks_long >= 4, -1), np.searchsorted([0.02, 0.2], with_digit[owner]), announced[owner],
        4 * ((counts[0] > 0) & (counts[1] + counts[2] > 0)) + 2 * (shifted(keyword, 1) | shifted(keyword, 2)) + (length >= 16),
    ]
    active = np.empty((n, len(_SIZES)), np.int16)
    for k, column in enumerate(columns):
        active[:, k] = column + _OFFSETS[k]
    return words, active


# ---- training --------------------------------------------------------------------------------


def _windows(ids: list, texts: list[bytes], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of words with their tags: around each pattern's hit, and one anywhere in each text."""
    for a, b in slices(texts):
        words, active = features(texts[a:b])
        begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts[a:b]])])
        for d in range(b - a):
            lo, hi = words.first[d], words.first[d + 1]
            if lo == hi:
                continue
            raw = texts[a + d]
            text = raw.decode("utf-8", "replace")
            tags = np.zeros(hi - lo, np.int8)
            for start, end, _ in base_spans(text, raw):
                s, e = (begin[d] + len(text[:x].encode()) for x in (start, end))
                inside = np.flatnonzero((words.start[lo:hi] < e) & (words.end[lo:hi] > s))
                tags[inside] = np.where(tags[inside] == _BEGIN, _BEGIN, _INSIDE)
                if len(inside):
                    tags[inside[0]] = _BEGIN
            spot = int(mix(np.array([ids[a + d] or 0], np.int64).view(np.uint64))[0] % np.uint64(hi - lo))
            taken = -1
            for centre in sorted({*np.flatnonzero(tags == _BEGIN).tolist(), spot}):
                if centre <= taken:
                    continue
                s = max(0, centre - settings.window // 2)
                taken = min(hi - lo, s + settings.window)
                yield active[lo + s : lo + taken], tags[s:taken]


def fit(windows: list[tuple[np.ndarray, np.ndarray]], settings: Settings = Settings()) -> Model:
    """Maximise the regularised conditional likelihood of the tags by AdaGrad on all windows.

    Without any window, or without a secret in them, the model tags everything as outside.
    """
    emission, transition = np.zeros((FEATURES, _TAGS)), np.zeros((_TAGS, _TAGS))
    if not windows or not any(t.any() for _, t in windows):
        emission[: _SIZES[0], _OUTSIDE] = 100.0
        return Model(emission, transition)
    n, most = len(windows), max(len(t) for _, t in windows)
    x = np.zeros((n, most, len(_SIZES)), np.int64)
    y, live = np.zeros((n, most), np.int64), np.zeros((n, most), bool)
    for k, (active, tags) in enumerate(windows):
        x[k, : len(tags)], y[k, : len(tags)], live[k, : len(tags)] = active, tags, True
    seen_e, seen_t = np.full(emission.shape, 1e-8), np.full(transition.shape, 1e-8)
    one_hot = np.eye(_TAGS)
    pair = live[:, 1:]
    for _ in range(settings.steps):
        scores = emission[x].sum(axis=2)
        forward, backward = np.zeros((n, most, _TAGS)), np.zeros((n, most, _TAGS))
        forward[:, 0] = scores[:, 0]
        for t in range(1, most):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + transition, axis=1) + scores[:, t]
            forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
        for t in range(most - 2, -1, -1):
            step = np.logaddexp.reduce(transition + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        marginal = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        off = (marginal - one_hot[y] * live[..., None]) / n
        joint = np.exp(
            forward[:, :-1, :, None] + transition + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]
        ) * pair[..., None, None]
        truth = one_hot[y[:, :-1]][..., None] * one_hot[y[:, 1:]][:, :, None, :] * pair[..., None, None]
        grad_t = (joint - truth).sum(axis=(0, 1)) / n + settings.decay * transition
        flat = x[live].ravel()
        grad_e = np.stack(
            [np.bincount(flat, np.repeat(off[live][:, k], len(_SIZES)), FEATURES) for k in range(_TAGS)], axis=1
        ) + settings.decay * emission
        seen_e += grad_e**2
        seen_t += grad_t**2
        emission -= settings.rate * grad_e / np.sqrt(seen_e)
        transition -= settings.rate * grad_t / np.sqrt(seen_t)
    return Model(emission, transition)


# ---- decoding --------------------------------------------------------------------------------


def decode(scores: np.ndarray, first: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The best tags of each text (Viterbi). ``scores``: words x tags, ``first``: bounds of texts."""
    n = len(scores)
    tags = np.zeros(n, np.int64)
    lead = scores[:, _OUTSIDE] - scores[:, 1:].max(axis=1)
    open_word = lead <= 2 * (transition.max() - transition.min())
    starts_text, ends_text = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    starts_text[first[:-1]] = True
    ends_text[first[1:]] = True
    before = np.append(False, open_word[:-1]) & ~starts_text[:n]
    run_start = np.flatnonzero(open_word & ~before)
    after = np.append(open_word[1:], False) & ~ends_text[1:]
    run_end = np.flatnonzero(open_word & ~after) + 1
    order = np.argsort(run_start - run_end, kind="stable")  # longest first
    run_start, run_end = run_start[order], run_end[order]
    length = run_end - run_start
    if not len(length):
        return tags
    # outside words stand at both ends of a run, unless the text begins or ends there
    best = scores[run_start] + np.where(starts_text[run_start, None], 0.0, transition[_OUTSIDE])
    steps, back = int(length[0]), []
    for t in range(1, steps):
        live = np.searchsorted(-length, -t, "left")  # runs longer than t
        options = best[:live, :, None] + transition
        back.append(options.argmax(axis=1))
        best[:live] = options.max(axis=1) + scores[run_start[:live] + t]
    best = best + np.where(ends_text[run_end, None], 0.0, transition[:, _OUTSIDE])
    state = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        live = np.searchsorted(-length, -t, "left")
        tags[run_start[:live] + t] = state[:live]
        if t:
            state[:live] = back[t - 1][np.arange(live), state[:live]]
    return tags


_LEAD, _TRAIL = b"\"'`([{<", b"\"'`)]}>,.;:!?"


def _trimmed(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """A word without quotes and brackets around it, and without ``name=`` before a value."""
    word = raw[start:end]
    for mark in (b"=", b":"):
        value = word.rstrip(_TRAIL + b"=").rfind(mark)
        if 0 <= value and len(word) - value > 8:
            start, word = start + value + 1, word[value + 1 :]
    left = len(word) - len(word.lstrip(_LEAD))
    right = len(word.rstrip(_TRAIL))
    return (start + left, start + right) if right > left else (start, start + len(word))


def found_spans(texts: list[bytes], model: Model) -> list[list[tuple[int, int, str, int, int]]]:
    """All spans of each text in code points: those of the patterns, and what the field adds.

    As in ``base_matches``; what the field adds is its own match.
    """
    words, active = features(texts)
    scores = np.zeros((len(active), _TAGS))
    for k in range(active.shape[1]):
        scores += model.emission[active[:, k]]
    tags = decode(scores, words.first, model.transition)
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    raw_all = b"\n".join(texts) + b"\n"
    hit = np.flatnonzero(tags)
    by_text = np.split(hit, np.searchsorted(hit, words.first[1:-1])) if len(texts) > 1 else [hit]
    out = []
    for d, raw in enumerate(texts):
        text = raw.decode("utf-8", "replace")
        base = base_matches(text, raw)
        added: list[list[int]] = []
        for k in by_text[d].tolist() if len(texts) else []:
            s, e = _trimmed(raw_all, int(words.start[k]), int(words.end[k]))
            if tags[k] == _INSIDE and added and added[-1][2] == k - 1:
                added[-1][1:] = [e, k]
            else:
                added.append([s, e, k])
        extra = []
        for s, e, _ in added:
            s, e = (len(raw_all[begins[d] : x].decode("utf-8", "replace")) for x in (s, e))
            if all(e <= a or s >= b for a, b, *_ in base):
                extra.append((s, e, "crf", s, e))
        rank = {kind: r for r, kind in enumerate([*PATTERNS, "crf"])}
        out.append(sorted([*base, *extra], key=lambda x: (x[0], rank[x[2]])))
    return out


# ---- over tables -----------------------------------------------------------------------------


def train(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from windows of two bounded samples, each chosen by a hash of the id.

    One is of all texts, the other of those with a span of the patterns, however rare they are.
    """
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bool(base_spans(t.decode("utf-8", "replace"), t)) for t in utf8(batch.column("text"))]
            yield batch.select(["doc_id"]).filter(pa.array(found, pa.bool_()))

    def sample(ids: DataFrame, most: int) -> DataFrame:
        ids = ids.where("doc_id IS NOT NULL").distinct()
        return ids.orderBy(F.xxhash64("doc_id", F.lit("secrets")), "doc_id").limit(most)

    told = sample(chosen.mapInArrow(hits, "doc_id long"), settings.max_hits)
    # a proven bound for a broadcast
    picked = sample(chosen.select("doc_id"), settings.max_texts).union(told).distinct()
    chosen = chosen.join(F.broadcast(picked), "doc_id", "left_semi")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            found = list(_windows(ids, utf8(batch.column("text")), settings))
            columns = [pa.array([x.tobytes() for x in c], pa.binary()) for c in zip(*found)]
            if found:
                yield pa.record_batch(columns, ["active", "tags"])

    found = chosen.mapInArrow(rows, "active binary, tags binary").collect()
    found = sorted({(bytes(r.active), bytes(r.tags)) for r in found})
    return fit(
        [(np.frombuffer(a, np.int16).reshape(-1, len(_SIZES)), np.frombuffer(t, np.int8)) for a, t in found],
        settings,
    )


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``: ``doc_id, spans``, an array of kind, start, end,
    match_start, match_end.

    Kinds are those of ``PATTERNS`` and ``crf``; offsets are code points, the end is exclusive; order
    is by start, then kind. A span is the secret; the match is all that its pattern matched, so for
    ``assign`` also the name before it. A span of the field that touches one of the patterns is left out. NULL
    texts count as empty and have none; repeated rows get the same answer; other columns are not read.
    """
    offsets = ("start", "end", "match_start", "match_end")
    kind = pa.list_(pa.struct([("kind", pa.string()), *[(name, pa.int64()) for name in offsets]]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = utf8(batch.column("text")), []
            for a, b in slices(texts):
                spans.extend(found_spans(texts[a:b], model))
            rows = [[{"kind": k} | dict(zip(offsets, (s, e, *match))) for s, e, k, *match in one] for one in spans]
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    fields = ", ".join(f"{name}: bigint" for name in offsets)
    schema = f"doc_id long, spans array<struct<kind: string, {fields}>>"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(rows, schema)
