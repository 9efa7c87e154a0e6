"""Language of whole texts, by spans.

Each word's letters name a script, and only languages that use that script stay candidates for the
word. Character n-grams score the word for each candidate. Viterbi then labels the words of a text
so that the sum of scores, less a penalty for every switch, is largest; runs of equal labels are the
text's spans. The text's language is the one with the most letters.

Null texts and texts without letters are ``und`` with score 0 and no spans.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filetide.llm.words import mix, ranges, slices, split_words

# First code point of each Unicode range and the script of its letters.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Indic"), (0x0E00, "Thai"), (0x0E80, "other"),
    (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "other"), (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"), (0x3100, "other"),
    (0x3400, "Han"), (0xA000, "other"), (0xAC00, "Hangul"), (0xD800, "other"), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB13, "other"), (0x20000, "Han"), (0x30000, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
BUCKETS = 1 << 17
PER_LANGUAGE = 4000  # about so many documents of each language are learned from
SHARE = 0.01  # a language uses a script that has this share of its letters
SWITCH = 8.0
OUTSIDE = -30.0  # the score of a word, against the best, for a language that does not use its script


def script_of(points: np.ndarray) -> np.ndarray:
    firsts = np.array([first for first, _ in SCRIPTS])
    numbers = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])
    return numbers[np.searchsorted(firsts, points, side="right") - 1]


def features(words: pa.Array):
    """For each distinct word: buckets of its n-grams of 1 to 3 letters, bounds, letters and script."""
    lower = pc.utf8_lower(words)
    text = "".join(f" {w}" for w in lower.to_pylist()) + "  "
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    lengths = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum(lengths + 1) - lengths  # position of each word's first letter
    seen, code = np.unique(points, return_inverse=True)
    letter = np.array([unicodedata.category(chr(c))[0] == "L" for c in seen])[code]
    script = script_of(seen)[code]
    at = ranges(first, lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    letters = np.bincount(owner, letter[at], len(lengths)).astype(np.int64)
    table = np.bincount(owner * len(SCRIPT_NAMES) + script[at], letter[at], len(lengths) * len(SCRIPT_NAMES))
    wide = points.astype(np.uint64)
    grams = [wide[at], (wide[at] << np.uint64(21)) | wide[at - 1],
             (wide[at + 1] << np.uint64(42)) | (wide[at] << np.uint64(21)) | wide[at - 1]]
    buckets = [(mix(g + np.uint64((n + 1) << 62)) % np.uint64(BUCKETS)).astype(np.int64) for n, g in enumerate(grams)]
    return buckets, lengths, letters, table.reshape(-1, len(SCRIPT_NAMES))


class Model:
    """Learned languages, in alphabetic order, with the log probability of every bucket."""

    def __init__(self, languages: list[str], weights: np.ndarray, uses: np.ndarray):
        self.languages, self.weights, self.uses = languages, weights, uses

    @classmethod
    def fitted(cls, languages: list[str], counts: np.ndarray, scripts: np.ndarray) -> Model:
        smooth = counts + 0.5
        weights = (np.log(smooth / smooth.sum(axis=1, keepdims=True)) / 3).astype(np.float32)
        return cls(languages, weights, scripts >= SHARE * np.maximum(scripts.sum(axis=1, keepdims=True), 1))

    def score(self, words: pa.Array, found: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
        """A row of scores for each word, and its letters; words without letters score 0. ``found`` are
        the words' features, where they are known."""
        buckets, lengths, letters, table = found or features(words)
        bounds = np.cumsum(lengths) - lengths
        scores = np.zeros((len(words), len(self.languages)), np.float32)
        for n, own in enumerate(self.weights):
            for part in buckets:
                scores[:, n] += np.add.reduceat(own[part], bounds) if len(bounds) else 0
        allowed = self.uses[:, table.argmax(axis=1)].T
        scores -= np.where(allowed, scores, -np.inf).max(axis=1, keepdims=True, initial=-1e9)
        scores[~allowed] = np.float32(OUTSIDE)
        scores[~allowed.any(axis=1) | (letters == 0)] = 0
        return scores, letters

    def foreign(self, found: tuple) -> np.ndarray:
        """Whether no language uses the script of a word, from the words' features."""
        return ~self.uses[:, found[3].argmax(axis=1)].any(axis=0)


def label(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """The best label of every word; the words of text i are rows bounds[i] to bounds[i + 1].
    All texts advance together, one word a step."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    start, size = bounds[:-1][order], lengths[order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
    kinds = scores.shape[1]
    moved = np.zeros((len(scores), kinds), bool)
    source = np.zeros(len(scores), np.int16)
    labels = np.zeros(len(scores), np.int16)
    best = np.zeros((len(order), kinds), np.float32)
    last = np.zeros(len(order), np.int16)
    for t in range(steps):
        n = active[t]
        at, own = start[:n] + t, best[:n]
        if t:
            top = own.argmax(axis=1)
            least = own[np.arange(n), top] - np.float32(switch)
            moved[at] = own < least[:, None]
            source[at] = top
            np.maximum(own, least[:, None], out=own)
        own += scores[at]
        own -= own.max(axis=1, keepdims=True)
    last[:] = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = start[:n] + t
        labels[at] = last[:n]
        jump = moved[at, last[:n]]
        last[:n][jump] = source[at][jump]
    return labels


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 7) -> Model:
    """Fits n-gram counts on labelled documents (doc_id, text, lang; nulls are left out).

    About ``per_language`` documents of each language are used, whole, chosen by a hash of doc_id;
    all of them where there are fewer. The driver gets one row for a language and bucket at most.
    """
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    there = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(there)
    if not languages:
        return Model.fitted([], np.zeros((0, BUCKETS)), np.zeros((0, len(SCRIPT_NAMES))))
    limit = F.create_map(*[F.lit(x) for n in languages for x in (n, int(min(1, per_language / there[n]) * (1 << 30)))])
    chosen = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) < limit[F.col("lang")])

    def count(batches):
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        scripts = np.zeros((len(languages), len(SCRIPT_NAMES)), np.int64)
        for batch in batches:
            for part in slices(batch):
                owner = pc.index_in(part.column("lang"), pa.array(languages)).to_numpy(zero_copy_only=False)
                for n in np.unique(owner):
                    words, _ = split_words(part.column("text").filter(pa.array(owner == n)))
                    found = words.value_counts()
                    if not len(found):
                        continue
                    buckets, lengths, letters, table = features(found.field("values"))
                    times = found.field("counts").to_numpy(zero_copy_only=False)
                    per_gram = np.repeat(times * (letters > 0), lengths)
                    for grams in buckets:
                        counts[n] += np.bincount(grams, per_gram, BUCKETS).astype(np.int64)
                    scripts[n] += (table * times[:, None]).sum(axis=0).astype(np.int64)
        both = np.concatenate([counts, scripts], axis=1)
        n, bucket = np.nonzero(both)
        yield pa.RecordBatch.from_arrays(
            [pa.array(n.astype(np.int64)), pa.array(bucket.astype(np.int64)), pa.array(both[n, bucket])],
            ["n", "bucket", "times"])

    sums = chosen.select("text", "lang").mapInArrow(count, "n long, bucket long, times long").groupBy(
        "n", "bucket").agg(F.sum("times").alias("times")).toPandas()
    both = np.zeros((len(languages), BUCKETS + len(SCRIPT_NAMES)))
    both[sums.n, sums.bucket] = sums.times
    return Model.fitted(languages, both[:, :BUCKETS], both[:, BUCKETS:])


SPAN = "array<struct<start:long,end:long,lang:string>>"


def predict(docs: DataFrame, model: Model, switch: float = SWITCH, columns: list[str] | None = None,
            names: tuple[str, str, str] = ("lang_pred", "score", "spans"), foreign: bool = False) -> DataFrame:
    """``columns`` of docs (doc_id by default) with three more: the language, a score (the share of the
    letters that are in spans of that language) and the spans: start and end as word numbers, end
    exclusive. With ``foreign``, texts with most of their letters in words of scripts that no language
    uses are ``und``, with score 0 and no spans."""
    columns = columns or ["doc_id"]
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights, model.uses))

    def run(batches):
        model = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, text):
                yield add(part, model)

    def add(part, model):
        languages, found, spans = predict_texts(part.column(text), model, switch, foreign)
        kept = part.drop_columns(["__text"]) if text == "__text" else part
        return pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(languages, pa.string()), pa.array(found, pa.float64()), pa.array(spans, pa.list_(
                pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])))],
            [*kept.schema.names, *names])

    text = "text" if "text" in columns else "__text"  # a text among the columns is sent once
    kept = docs.select(*[F.col(f"`{c}`") for c in columns], *[F.col("text").alias(text)] * (text == "__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "__text")
    return kept.mapInArrow(run, f"{fields}, `{names[0]}` string, `{names[1]}` double, `{names[2]}` {SPAN}")


def predict_texts(texts: pa.Array, model: Model, switch: float = SWITCH, foreign: bool = False):
    words, bounds = split_words(texts)
    n, kinds = len(texts), len(model.languages)
    if not len(words) or not kinds:
        return ["und"] * n, np.zeros(n), [[]] * n
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    found = features(coded.dictionary)
    scores, letters = model.score(coded.dictionary, found)
    labels, letters = label(scores[codes], bounds, switch), letters[codes]
    owner = np.repeat(np.arange(n), np.diff(bounds))
    share = np.bincount(owner * kinds + labels, letters, n * kinds).reshape(n, kinds)
    total, top = share.sum(axis=1), share.argmax(axis=1)
    if foreign:
        outside = model.foreign(found)[codes]
        total = np.where(2 * np.bincount(owner, letters * outside, n) > total, 0, total)
    names = [model.languages[k] if has else "und" for k, has in zip(top, total > 0)]
    begins = np.flatnonzero((np.diff(labels, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
    ends = np.append(begins[1:], len(labels))
    spans: list[list[dict]] = [[] for _ in range(n)]
    for a, b in zip(begins.tolist(), ends.tolist()):
        i = owner[a]
        if total[i]:
            spans[i].append({"start": a - int(bounds[i]), "end": b - int(bounds[i]), "lang": model.languages[labels[a]]})
    return names, np.where(total > 0, share.max(axis=1) / np.maximum(total, 1), 0.0), spans


def held_out(doc_id):
    """Whether a document is kept from learning: one fold of five by the CRC-32 of its id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
