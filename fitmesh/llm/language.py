"""Language of words and texts by a linear-chain conditional random field.

Words carry affix, byte n-gram and lexicon features; transitions between the languages of neighbouring words are learned
from single-language sentences and from sentences of two languages put together. Forward-backward gives each word its
probabilities; a text's language is the one with the largest mean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fitmesh.llm.words import Words, span_hash, words

_AFFIX, _GRAM = 1 << 16, 1 << 15
_LENGTHS = (1, 2, 3)
_LEXICON = 400  # most frequent words a language
_STOP = np.zeros(256, bool)
_STOP[list(b".!?")] = True
_LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


def _slot(h: np.ndarray, salt: int, size: int) -> np.ndarray:
    return ((h ^ np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - (size - 1).bit_length())).astype(np.int64)


class Distinct:
    """Features of the distinct words of a slice."""

    def __init__(self, w: Words):
        _, at, self.inverse = np.unique(w.hash, return_index=True, return_inverse=True)
        order = np.argsort(at)  # spans must ascend
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.inverse, at = place[self.inverse], at[order]
        start, end = w.start[at], w.end[at]
        self.hash = w.hash[at]
        self.affixes = []
        for k in _LENGTHS:
            self.affixes.append(_slot(span_hash(w.data, start, np.minimum(start + k, end)), k, _AFFIX))
            self.affixes.append(_slot(span_hash(w.data, np.maximum(end - k, start), end), 16 + k, _AFFIX))
        count = np.maximum(end - start - 2, 0)
        self.owner = np.repeat(np.arange(len(at)), count)
        p = np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())
        d = w.data.astype(np.uint64)
        self.grams = _slot(d[p] << np.uint64(16) | d[p + 1] << np.uint64(8) | d[p + 2], 32, _GRAM) if len(p) else np.zeros(0, np.int64)
        self.weight = 1.0 / np.sqrt(np.maximum(count, 1))


class Model:
    """Weights: affix and n-gram tables, lexicon by language, transitions; a column per language."""

    def __init__(self, languages: list[str]):
        k = len(languages)
        self.languages = languages
        self.affix, self.gram = np.zeros((_AFFIX, k), np.float32), np.zeros((_GRAM, k), np.float32)
        self.lexicon, self.member = np.zeros(0, np.uint64), np.zeros((0, k), np.float32)
        self.in_lexicon = np.zeros((k, k), np.float32)
        self.step = np.zeros((k, k))

    def members(self, d: Distinct) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(d.hash), len(self.languages)), np.float32)
        at = np.minimum(np.searchsorted(self.lexicon, d.hash), len(self.lexicon) - 1)
        return self.member[at] * (self.lexicon[at] == d.hash)[:, None]

    def scores(self, d: Distinct) -> np.ndarray:
        out = self.members(d) @ self.in_lexicon
        for a in d.affixes:
            out += self.affix[a]
        for k in range(out.shape[1]):
            out[:, k] += np.bincount(d.owner, self.gram[d.grams, k], minlength=len(out)) * d.weight
        return out.astype(np.float64)


def sentences(w: Words) -> np.ndarray:
    """First word of each sentence: after . ! ?, after a line break, and at each text."""
    if not len(w.start):
        return np.zeros(0, np.int64)
    lines = np.cumsum(w.data == 10)
    new = np.zeros(len(w.start), bool)
    new[0] = True
    new[1:] = _STOP[w.data[w.end[:-1] - 1]] | (lines[w.start[1:]] != lines[w.end[:-1] - 1])
    new[w.first[:-1][np.diff(w.first) > 0]] = True
    return np.flatnonzero(new)


def forward_backward(scores: np.ndarray, step: np.ndarray, first: np.ndarray, pairs: bool = False):
    """Word marginals of chains that begin at ``first``; ``pairs`` adds the expected transitions."""
    n, k = scores.shape
    length = np.diff(np.append(first, n))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    local = np.exp(scores - scores.max(1, keepdims=True)) if n else scores
    move = np.exp(step - step.max())
    alpha, beta = np.empty((n, k)), np.ones((n, k))
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), "left")  # chains longer than t
    for t in range(longest):
        at = first[: active[t]] + t
        a = local[at] if t == 0 else (alpha[at - 1] @ move) * local[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    expected = np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        at = first[: active[t]] + t
        ahead = local[at] * beta[at]
        if pairs:
            p = alpha[at - 1][:, :, None] * move * ahead[:, None, :]
            expected += (p / p.sum((1, 2), keepdims=True)).sum(0)
        b = ahead @ move.T
        beta[at - 1] = b / b.sum(1, keepdims=True)
    post = alpha * beta
    post /= np.maximum(post.sum(1, keepdims=True), 1e-300)
    return (post, expected) if pairs else post


def fit(texts: list[str], labels: list[str], rounds: int = 25, rate: float = 0.5, penalty: float = 1e-4) -> Model:
    """Maximum likelihood by full-batch AdaGrad on labelled texts."""
    model = Model(sorted(set(labels)))
    k = len(model.languages)
    if k == 0:
        return model
    parts = list(words(pc.utf8_lower(pa.array(texts, pa.string())), hashed=True))
    w = parts[0]
    if len(parts) > 1:  # one slice over all texts
        shift = np.cumsum([0, *[len(p.data) for p in parts]])
        number = np.cumsum([0, *[len(p.start) for p in parts]])
        w = Words(0, np.concatenate([p.data for p in parts]), np.concatenate([*[p.bounds[:-1] + s for p, s in zip(parts, shift)], [shift[-1]]]),
                  np.concatenate([p.start + s for p, s in zip(parts, shift)]), np.concatenate([p.end + s for p, s in zip(parts, shift)]),
                  np.concatenate([*[p.first[:-1] + s for p, s in zip(parts, number)], [number[-1]]]), np.concatenate([p.hash for p in parts]))
    if not len(w.start):
        return model
    code = {x: i for i, x in enumerate(model.languages)}
    truth = np.array([code[x] for x in labels])[w.doc()]
    d = Distinct(w)
    seen = np.zeros((len(d.hash), k))
    for y in range(k):
        seen[:, y] = np.bincount(d.inverse[truth == y], minlength=len(d.hash))
    top = np.unique(np.concatenate([np.argsort(-seen[:, y], kind="stable")[:_LEXICON] for y in range(k)]))
    top = top[np.argsort(d.hash[top])]
    model.lexicon, model.member = d.hash[top], (seen[top] >= np.maximum(1, seen[top].max(1, keepdims=True) / 2)).astype(np.float32)

    # chains: each sentence, every second one joined to a sentence from elsewhere in the sample
    first = sentences(w)
    size = np.diff(np.append(first, len(w.start)))
    draw = np.random.default_rng(11).permutation(len(first))
    chains = np.repeat(first[draw] - (np.cumsum(size[draw]) - size[draw]), size[draw]) + np.arange(size.sum())
    begin = (np.cumsum(size[draw]) - size[draw])
    begin = begin[(np.arange(len(begin)) % 3) != 1]  # of three sentences the second goes on the first
    inverse, y = d.inverse[chains], truth[chains]
    gold = np.zeros((len(y), k))
    gold[np.arange(len(y)), y] = 1
    inner = np.setdiff1d(np.arange(1, len(y)), begin)
    moves = np.zeros((k, k))
    np.add.at(moves, (y[inner - 1], y[inner]), 1)
    members = model.members(d)
    tables = {"affix": np.zeros_like(model.affix), "gram": np.zeros_like(model.gram), "in_lexicon": np.zeros_like(model.in_lexicon), "step": np.zeros_like(model.step)}
    for _ in range(rounds):
        post, expected = forward_backward(model.scores(d)[inverse], model.step, begin, pairs=True)
        lack = gold - post
        by_word = np.stack([np.bincount(inverse, lack[:, c], minlength=len(d.hash)) for c in range(k)], 1)
        grads = {"affix": np.zeros((_AFFIX, k)), "gram": np.zeros((_GRAM, k)), "in_lexicon": members.T @ by_word, "step": moves - expected}
        for c in range(k):
            for a in d.affixes:
                grads["affix"][:, c] += np.bincount(a, by_word[:, c], minlength=_AFFIX)
            grads["gram"][:, c] = np.bincount(d.grams, (by_word[:, c] * d.weight)[d.owner], minlength=_GRAM)
        for name, g in grads.items():
            value = getattr(model, name)
            g = g / len(y) - penalty * value
            tables[name] += g * g
            setattr(model, name, (value + rate * g / (np.sqrt(tables[name]) + 1e-8)).astype(value.dtype))
    return model


def marginals(model: Model, w: Words) -> np.ndarray:
    """Probability of each language for each word of a slice."""
    d = Distinct(w)
    return forward_backward(model.scores(d)[d.inverse], model.step, sentences(w))


def _labelled(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, UNKNOWN], dtype=object)
        k = len(model.languages)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for w in words(pc.utf8_lower(texts)):
                own = [t.as_py() for t in texts.slice(w.row, w.rows)]
                lettered = np.array([t is not None and _LETTER.search(t) is not None for t in own], bool)
                total = np.zeros((w.rows, max(k, 1)))
                if k and len(w.start):
                    post, doc = marginals(model, w), w.doc()
                    for c in range(k):
                        total[:, c] = np.bincount(doc, post[:, c], minlength=w.rows)
                share = total / np.maximum(total.sum(1, keepdims=True), 1e-300)
                best = np.where(lettered & (k > 0), share.argmax(1), k)
                score = np.where(best < k, share.max(1), 0.0)
                yield pa.RecordBatch.from_arrays([ids.slice(w.row, w.rows), pa.array(names[best], pa.string()), pa.array(np.clip(score, 0, 1))], names=["id", "lang_pred", "score"])

    return run


def _runs(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages, dtype=object)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for w in words(pc.utf8_lower(texts)):
                if not len(w.start) or not len(names):
                    continue
                post, doc = marginals(model, w), w.doc()
                best = post.argmax(1)
                new = np.ones(len(best), bool)
                new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
                head = np.flatnonzero(new)
                tail = np.append(head[1:], len(best)) - 1
                sure = np.add.reduceat(post[np.arange(len(best)), best], head) / (tail - head + 1)
                points = np.concatenate([[0], np.cumsum((w.data & 0xC0) != 0x80)])  # code points before each byte
                base = points[w.bounds[doc[head]]]
                for at in range(0, len(head), 10_000):
                    some = slice(at, at + 10_000)
                    runs = [pa.array(points[w.start[head[some]]] - base[some]), pa.array(points[w.end[tail[some]]] - base[some]),
                            pa.array(names[best[head[some]]], pa.string()), pa.array(np.clip(sure[some], 0, 1))]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(w.row + doc[head[some]])), *runs], names=["id", "start", "end", "lang", "probability"])

    return run


def training_sample(labelled: DataFrame, per_language: int, longest: int) -> DataFrame:
    """At most ``per_language`` rows a language with texts of at most ``longest`` characters, by hash of the id and text.

    A language that has longer texts only is learned from a part of ``longest`` characters of each, at a place given by the hash.
    """
    able = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("short", F.char_length("text") <= longest)
    counts = able.groupBy("lang").agg(F.count_if("short").alias("n_short"), F.count(F.lit(1)).alias("n_all"))
    counts = counts.select("lang", (F.col("n_short") > 0).alias("has_short"), F.when(F.col("n_short") > 0, F.col("n_short")).otherwise(F.col("n_all")).alias("c"))
    able = able.withColumn("h", F.xxhash64("id", "text"))
    share = (F.shiftrightunsigned("h", 33) / F.lit(float(1 << 31)))
    some = able.join(F.broadcast(counts), "lang").where((F.col("short") | ~F.col("has_short")) & (share * F.col("c") <= 2.0 * per_language))  # one row a language
    place = (F.pmod("h", F.greatest(F.char_length("text") - longest, F.lit(0)) + 1) + 1).cast("int")
    some = some.withColumn("text", F.when(F.col("short"), F.col("text")).otherwise(F.substring(F.col("text"), place, F.lit(longest))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return some.withColumn("r", rank).where(F.col("r") <= per_language).select("text", "lang", "h")


def learn(labelled: DataFrame, per_language: int, longest: int) -> Model:
    rows = sorted(training_sample(labelled, per_language, longest).collect(), key=lambda r: (r["lang"], r["h"]))  # the bounded sample
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_language: int = 150,
             longest: int = 20_000) -> DataFrame:
    """``id_column, lang_pred, score`` of every whole text of ``docs``.

    The model is fitted on ``labelled`` (id, text, lang): at most ``per_language`` rows a language with at most ``longest`` characters, chosen by
    hash (parts of longer texts where a language has no others). Predictions use the text alone. ``score`` is the mean probability of the predicted language over the words.
    Null texts and texts without a letter are ``und`` with score 0, and so is everything when nothing is labelled.
    Rows are independent: repeated rows get equal results, null ids stay null, other columns are ignored.
    """
    model = learn(labelled, per_language, longest)
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_labelled(model), f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_column)


def label_words(docs: DataFrame, labelled: DataFrame, id_column: str = "doc_id", text_column: str = "text", per_language: int = 150,
                longest: int = 20_000) -> DataFrame:
    """``id_column, start, end, lang, probability``: the runs of words of one language in every whole text, as in code-switched texts.

    A run holds neighbouring words whose most probable language by forward-backward is the same; ``start`` and ``end``
    (exclusive) count code points, ``probability`` is the mean over its words. The model is that of ``identify``, which sums
    up the same word probabilities. Texts without words (null, empty, white space) have no runs, and none has any when
    nothing is labelled. Rows are independent: repeated rows have their runs each, null ids stay null, other columns are ignored.
    """
    model = learn(labelled, per_language, longest)
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(_runs(model), f"id {kind}, start long, end long, lang string, probability double").withColumnRenamed("id", id_column)
