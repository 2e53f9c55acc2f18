"""Language identification by a linear-chain conditional random field over words.

Every word is a state in a chain; its label is a language. A word's evidence is the sum of learned
weights of its affixes and character n-grams (hashed) and of the language lexicons that list it;
learned transition weights tie neighbours together. Training sequences are pieces of labelled
documents put one after another, so that the model sees languages change inside a text. Prediction
runs forward-backward over all words of a text; the text's label has the largest mean posterior.

The model is fitted on the driver from at most ``SAMPLE_ROWS`` labelled documents (``WINDOW_WORDS``
words each, picked by hash); prediction reads whole texts in Arrow batches on the executors. Besides
the winner's share, a prediction says how much of a text is written like the learned languages: the
mean share of a word's 3-grams that the sample holds, whichever language they are from.

Defined results: a null text, an empty one and one without letters get ``und`` and score 0, and so
does every text if nothing is labelled; labels that are null are not learned; ties go to the label
that sorts first; repeated rows get equal results; an empty table gives an empty result; columns
other than the text are kept by ``with_language`` and never read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkvigil.llm.columns import fresh, text_slices

SAMPLE_ROWS = 2400
WINDOW_WORDS = 40
BUCKETS = 1 << 15
LEXICON_WORDS = 400
EPOCHS = 12
BATCH = 64
RATE = 0.2
RIDGE = 1e-4
UNKNOWN = "und"
# Words that go through forward-backward together.
GROUP_WORDS = 1 << 19
# Least share of known 3-grams of a text in a learned language, and as how many known words its
# brevity counts: a few words prove nothing.
LEAST_KNOWN = 0.65
DOUBT_WORDS = 4

RESULT = "struct<lang_pred:string,score:double,known:double>"


@dataclass
class LanguageModel:
    """Weights: hashed n-grams by label, lexicon membership by label, transitions, first word; and the
    3-grams of the sample."""

    labels: list[str]
    grams: np.ndarray
    words: list[str]
    listed: np.ndarray
    lexicon: np.ndarray
    moves: np.ndarray
    first: np.ndarray
    met: frozenset[str] = frozenset()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lower-cased words (runs of letters) of the texts, and where each text's words begin."""
    low = pc.utf8_lower(pc.fill_null(texts, ""))
    spaced = pc.utf8_trim(pc.replace_substring_regex(low, r"[^\p{L}]+", " "), " ")
    parts = pc.split_pattern(pc.if_else(pc.equal(spaced, ""), None, spaced), " ")
    sizes = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(parts), np.r_[0, np.cumsum(sizes)]


def features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature ids of the words, end to end, and where each word's features begin.

    2- and 3-grams of the marked word; the 4-grams at its ends are the affixes of three letters.
    """
    texts = words.to_pylist()
    marked = "".join(f"\x02{w}\x03" for w in texts)
    code = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    size = np.fromiter((len(w) + 2 for w in texts), dtype=np.int64, count=len(texts))
    word = np.repeat(np.arange(len(texts)), size)
    begins, ends = code == 2, code == 3
    ids, owner = [], []
    for n in (2, 3, 4):
        if len(code) < n:
            continue
        last = len(code) - n + 1
        mixed = np.full(last, n, dtype=np.uint64)
        for k in range(n):
            mixed = (mixed ^ code[k : k + last]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        whole = word[:last] == word[n - 1 :]
        if n == 4:
            whole &= begins[:last] | ends[n - 1 :]
        ids.append((mixed[whole] % np.uint64(BUCKETS)).astype(np.int64))
        owner.append(word[:last][whole])
    if not ids:
        return np.zeros(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return ids[order], np.searchsorted(owner[order], np.arange(len(texts)))


def evidence(model: LanguageModel, words: pa.Array) -> np.ndarray:
    """Unnormalised log weight of every label for each word (each has a feature: its marks)."""
    if not len(words):
        return np.zeros((0, len(model.labels)))
    out = np.empty((len(words), len(model.labels)))
    step = 100_000
    for at in range(0, len(words), step):
        ids, starts = features(words[at : at + step])
        out[at : at + step] = np.add.reduceat(model.grams[ids], starts, axis=0)
    listed = pc.index_in(words, pa.array(model.words, pa.string())).fill_null(-1).to_numpy(zero_copy_only=False)
    known = listed >= 0
    out[known] += model.listed[listed[known]] @ model.lexicon
    return out


def trigrams(word: str) -> list[str]:
    marked = f"\x02{word}\x03"
    return [marked[i : i + 3] for i in range(len(marked) - 2)]


def familiarity(model: LanguageModel, words: pa.Array) -> np.ndarray:
    """The share of each word's 3-grams that the sample holds."""
    met = model.met
    shares = ((own := trigrams(w), sum(g in met for g in own) / len(own))[1] for w in words.to_pylist())
    return np.fromiter(shares, dtype=np.float64, count=len(words))


def posteriors(weight: np.ndarray, lengths: np.ndarray, first: np.ndarray, moves: np.ndarray):
    """Posterior of every word of sequences laid end to end, and expected transitions.

    ``weight``: exp of the evidence, each row scaled to a largest value of 1. Sequences are stepped
    through side by side, longest first, so that a step works on a leading block of them.
    """
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    start = (np.cumsum(lengths) - lengths)[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    step, begin = np.exp(moves), np.exp(first)
    forward = np.empty_like(weight)
    carry = begin
    for t in range(longest):
        n = active[t]
        at = start[:n] + t
        now = (carry if t == 0 else carry[:n] @ step) * weight[at]
        now /= now.sum(axis=1, keepdims=True)
        forward[at] = carry = now
    pair = np.zeros_like(moves)
    back = np.ones((len(size), weight.shape[1]))
    for t in range(longest - 1, 0, -1):
        n = active[t]
        at = start[:n] + t
        seen = weight[at] * back[:n]
        before = forward[at - 1]
        now = seen @ step.T
        total = (before * now).sum(axis=1, keepdims=True)
        pair += (before / total).T @ seen * step
        forward[at] *= back[:n]
        back[:n] = now / now.sum(axis=1, keepdims=True)
    if longest:
        forward[start] *= back
    forward /= forward.sum(axis=1, keepdims=True)
    return forward, pair


def scaled(logs: np.ndarray) -> np.ndarray:
    return np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), 1e-30)


def fit(samples: list[tuple[list[str], str]], seed: int = 7) -> LanguageModel | None:
    """Maximum conditional likelihood with adaptive gradient steps; None without samples."""
    samples = [(w, lang) for w, lang in samples if w]
    labels = sorted({lang for _, lang in samples})
    if not labels:
        return None
    number = {lang: i for i, lang in enumerate(labels)}
    words, listed = lexicons(samples, labels)
    met = frozenset(g for w in {w for own, _ in samples for w in own} for g in trigrams(w))
    rng = np.random.default_rng(seed)
    k = len(labels)
    model = LanguageModel(
        labels, np.zeros((BUCKETS, k)), words, listed, np.zeros((k, k)), np.zeros((k, k)), np.zeros(k), met
    )
    params = [model.grams, model.lexicon, model.moves, model.first]
    power = [np.full_like(p, 1e-6) for p in params]
    place = {w: i for i, w in enumerate(words)}
    for _ in range(EPOCHS):
        for sequences in batches(switched(samples, number, rng), BATCH):
            flat = pa.array([w for s, _ in sequences for w in s])
            truth = np.array([y for _, ys in sequences for y in ys])
            lengths = np.array([len(s) for s, _ in sequences])
            ids, starts = features(flat)
            member = listed[[place.get(w, -1) for w in flat.to_pylist()]] if words else np.zeros((len(flat), k))
            member = member * np.array([[w in place] for w in flat.to_pylist()])
            logs = np.add.reduceat(model.grams[ids], starts, axis=0) + member @ model.lexicon
            found, pair = posteriors(scaled(logs), lengths, model.first, model.moves)
            slope = found.copy()
            slope[np.arange(len(truth)), truth] -= 1
            heads = np.cumsum(lengths) - lengths
            inner = np.ones(len(truth), dtype=bool)
            inner[heads] = False
            at = np.flatnonzero(inner)
            np.subtract.at(pair, (truth[at - 1], truth[at]), 1)
            grams = np.zeros_like(model.grams)
            width = np.diff(np.r_[starts, len(ids)])
            np.add.at(grams, ids, np.repeat(slope, width, axis=0))
            slopes = [grams, member.T @ slope, pair, slope[heads].sum(axis=0)]
            for p, s, q in zip(params, slopes, power, strict=True):
                s = s / len(sequences) + RIDGE * p
                q += s * s
                p -= RATE * s / np.sqrt(q)
    model.grams = model.grams.astype(np.float32)
    return model


def lexicons(samples, labels):
    """Frequent words of each label, and for each word the labels that list it."""
    counts = {lang: Counter() for lang in labels}
    for words, lang in samples:
        counts[lang].update(words)
    top = {
        lang: [w for w, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS] if n > 1]
        for lang, c in counts.items()
    }
    words = sorted({w for ws in top.values() for w in ws})
    own = {lang: set(ws) for lang, ws in top.items()}
    return words, np.array([[float(w in own[lang]) for lang in labels] for w in words]).reshape(-1, len(labels))


def switched(samples, number, rng):
    """Training sequences: pieces of one to three samples after each other."""
    order = rng.permutation(len(samples))
    at = 0
    while at < len(order):
        many = int(rng.integers(1, 4))
        words, truth = [], []
        for i in order[at : at + many]:
            own, lang = samples[i]
            keep = len(own) if many == 1 else int(rng.integers(min(5, len(own)), len(own) + 1))
            words += own[:keep]
            truth += [number[lang]] * keep
        at += many
        yield words, truth


def batches(items, size):
    batch = []
    for item in items:
        batch.append(item)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch


def training_sample(labelled: DataFrame, rows: int = SAMPLE_ROWS, window: int = WINDOW_WORDS):
    """At most ``rows`` (words, label) of ``labelled`` (doc_id, text, lang), evenly by label.

    Rows are picked by a hash of their id, and ``window`` words at a place picked by it too.
    """
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return []
    share = rows / len(counts)
    rate = F.coalesce(
        *[F.when(F.col("lang") == r["lang"], F.lit(1.2 * share / r["count"])) for r in counts], F.lit(1.0)
    )
    key = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)).alias("key")
    picked = labelled.select("text", "lang", key, rate.alias("rate")).filter(
        F.col("key") < F.col("rate") * (1 << 30)
    )
    clean = F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " "))
    words = F.filter(F.split(clean, " "), lambda w: w != "")
    begin = F.lit(1) + F.pmod("key", F.greatest(F.lit(1), F.size("words") - window + 1)).cast("int")
    sampled = picked.withColumn("words", words).select(F.slice("words", begin, window).alias("words"), "lang", "key", "rate")
    # Within its label a row's key over the rate is its place, whatever the label's size.
    nth = sampled.orderBy(F.col("key") / F.col("rate"), "lang").limit(rows)
    return [(r["words"], r["lang"]) for r in nth.collect()]


def predict(model: LanguageModel, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Label, mean posterior and share of known 3-grams of every text of a batch."""
    words, edges = words_of(texts)
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    weight = scaled(evidence(model, coded.dictionary))
    lengths = np.diff(edges)
    share = np.r_[0.0, np.cumsum(familiarity(model, coded.dictionary)[code])]
    known = (np.diff(share[edges]) + DOUBT_WORDS) / (lengths + DOUBT_WORDS)
    order = np.flatnonzero(lengths)
    order = order[np.argsort(-lengths[order], kind="stable")]
    means = np.zeros((len(texts), len(model.labels)))
    group = np.cumsum(lengths[order]) // GROUP_WORDS
    for rows in np.split(order, np.flatnonzero(np.diff(group)) + 1) if len(order) else []:
        own = lengths[rows]
        heads = np.cumsum(own) - own
        at = np.repeat(edges[rows] - heads, own) + np.arange(own.sum())
        found, _ = posteriors(weight[code[at]], own, model.first, model.moves)
        means[rows] = np.add.reduceat(found, heads, axis=0) / own[:, None]
    best = means.argmax(axis=1)
    score = means[np.arange(len(best)), best]
    return [model.labels[b] if n else UNKNOWN for b, n in zip(best, lengths, strict=True)], np.clip(score, 0, 1), known


def with_language(docs: DataFrame, model: LanguageModel | None, name: str) -> DataFrame:
    """``docs`` with the struct (lang_pred, score, known) of its texts in the new column ``name``."""

    @F.arrow_udf(RESULT)
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [predict(model, part) for part in text_slices(batch)] if model is not None else []
            langs = [lang for part, *_ in parts for lang in part] or [UNKNOWN] * len(batch)
            none = [(None, np.zeros(len(batch)), np.zeros(len(batch)))]
            score, known = (np.concatenate([p[i] for p in parts or none]) for i in (1, 2))
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(known, pa.float64())],
                ["lang_pred", "score", "known"],
            )

    return docs.withColumn(name, label(F.col("text")))


def held_out():
    """Whether a document is kept from training: crc32 of its id's digits, modulo 5."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    return fit(training_sample(labelled.select("doc_id", "text", "lang"), rows))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = train(docs)
    found = with_language(docs.select("doc_id", "text"), model, "found")
    return found.select("doc_id", held_out().alias("held_out"), "found.lang_pred", "found.score")


def keep_identified(docs: DataFrame, least: float = LEAST_KNOWN) -> DataFrame:
    """``docs`` without those that have no language, or are not written like any learned one.

    Not the winner's share decides, but the evidence of the words: texts that change between known
    languages stay, however many; texts of which less than ``least`` of the 3-grams are known go.
    """
    [name] = fresh(docs, "language")
    found = with_language(docs, train(docs), name)
    return found.filter((F.col(name)["lang_pred"] != UNKNOWN) & (F.col(name)["known"] >= least)).drop(name)
