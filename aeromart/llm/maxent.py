"""Hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class).

Classes: the end of a text, the SINGLES most frequent words (a class each), and classes by the form
of a word (its ending and whether punctuation follows). P(class | history) is a softmax over
CLASSES of the sum of the weights of four features of the history, each hashed into a table of ROWS rows: the last word,
the last two classes, the word before the last (skip) and the classes one and three words back (skip). P(word | class)
is the word's share of the class, less the share that words met once have (Good and Turing), which is what
unseen words of the class get together. So the probabilities of all known words and of one unknown word per
form class add up to 1.

Training. The vocabulary is counted over all training texts. Then all texts are encoded once:
class and word hash per token, as packed bytes. Every update is one pass over all training tokens: tasks
add up, per feature row and class, how often the class came less how often the model expected it,
which is found once for equal histories; the sums meet by feature row in a shuffle; and the driver, which holds only the weights (of fixed size), moves
every weight along this gradient less PENALTY times the weight (a Gaussian prior), scaled by the larger of the two. In the
first update the model is the same for all histories, so that counts suffice; they are kept for the scaling.
One training text in JUDGED, drawn by its content, is kept out of these sums. Updates go on until one lowers the
mean loss of the judged texts' tokens by less than TOLERANCE of it; the weights with the lowest loss stay.

Only frequent words (at most FREQUENT) are sent to the tasks. Counts of the other words are joined to
the texts' own rare words by a shuffle.
"""

import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeromart.llm.staging import staged
from aeromart.llm.words import blocks, per_row

CLASSES, SINGLES = 64, 31
FORMS = CLASSES - 1 - SINGLES
ROWS = 4096
FREQUENT = 200_000
#: A bound on the updates for callers that want one; None: the judged texts alone decide.
UPDATES: int | None = None
STEP, PRIOR, PENALTY = 0.5, 4.0, 2.0
JUDGED, TOLERANCE = 16, 1e-3
#: Weights stay within this, so that no product of their exponentials leaves the range of a float32.
LARGEST = 12.0
#: Tokens per numpy step: few enough for their class scores to stay in the processor's cache; and per step that adds them up.
CHUNK, SPREAD = 512, 16384
#: Tokens whose histories are put in order and counted at once.
HISTORIES = 1 << 19
#: Tokens whose features are held at once.
HELD_TOKENS = 1 << 18
#: Distinct words a task counts before it passes them on.
HELD_WORDS = 500_000

_COUNTS = "word string, n long"
_ENCODED = "doc_id long, train boolean, judged boolean, n_tokens long, n_frequent long, base double, inner double, classes binary, hashes binary, rare array<struct<word: string, form: int, n: int>>"


def form(word: bytes) -> int:
    """The class of a word that has none of its own."""
    core = word.rstrip(b".,;:!?\"')")
    return 1 + SINGLES + (zlib.crc32(core[-2:]) % (FORMS // 2)) * 2 + (len(core) < len(word))


def _found(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of a block of texts in a row, in lower-case ASCII letters and numbered, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    parts = lists.flatten()
    real = pc.not_equal(parts, "")  # white space at an end of a text leaves an empty part
    first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))
    return parts.filter(real).dictionary_encode(), per_row(first, real.to_numpy(zero_copy_only=False))


def _added(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, added up in the tasks first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for block in blocks(batches, "text"):
            found, _ = _found(block["text"])
            times = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            held.append(pa.table({"word": found.dictionary, "n": times}))
            if sum(t.num_rows for t in held) > 2 * HELD_WORDS:
                held = [_added(held)]
                if held[0].num_rows > HELD_WORDS:
                    yield from held.pop().to_batches()
        if held:
            yield from _added(held).to_batches()

    return texts.select("text").mapInArrow(run, _COUNTS).groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    counts: DataFrame  # word, n
    total: int  # tokens, ends included
    distinct: int
    ends: int
    frequent: pa.Array  # by place: word
    numbers: np.ndarray  # by place: count
    classes: np.ndarray  # by place
    inside: np.ndarray  # by class: tokens
    once: np.ndarray  # by class: words met once

    def base(self, n: np.ndarray) -> np.ndarray:
        return np.log10((n + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def unseen(self) -> np.ndarray:
        """By class, the share of words that training did not meet."""
        share = (self.once + 0.5) / (self.inside + 1)
        share[: 1 + SINGLES] = 0
        return np.where(self.inside > 0, share, 1.0)

    def prior(self) -> np.ndarray:
        return (self.inside + 0.5) / (self.inside.sum() + 0.5 * CLASSES)


def vocabulary(texts: DataFrame) -> Vocabulary:
    """Counts of all words of the texts; to the driver come FREQUENT words at most and sums by class."""
    counts = staged(count_words(texts), "words")
    ends = texts.count()
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    frequent = pa.concat_arrays([pa.array([], pa.string()), *(c.cast(pa.string()) for c in top["word"].chunks)])
    listed = frequent.cast(pa.binary()).to_pylist()
    singles = set(listed[:SINGLES])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, CLASSES), np.int64)
        for batch in batches:
            n = batch["n"].to_numpy()
            own = np.array([-1 if (b := w.encode()) in singles else form(b) for w in batch["word"].to_pylist()], np.int64)
            real = own >= 0
            for k, weights in enumerate((n, np.ones(len(n)), n == 1)):
                sums[k] += np.bincount(own[real], weights[real], CLASSES).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), *map(pa.array, sums)], names=["class", "tokens", "words", "once"])

    sums = counts.mapInArrow(run, "class long, tokens long, words long, once long").groupBy("class").agg(*(F.sum(c).alias(c) for c in ("tokens", "words", "once")))
    inside, words, once = np.zeros(CLASSES), np.zeros(CLASSES), np.zeros(CLASSES)
    for row in sums.collect():  # one row per class
        inside[row["class"]], words[row["class"]], once[row["class"]] = row["tokens"], row["words"], row["once"]
    numbers = top["n"].to_numpy().astype(np.float64)
    inside[0] = ends
    inside[1 : 1 + min(SINGLES, len(numbers))] = numbers[:SINGLES]
    own = np.array([k + 1 if k < SINGLES else form(w) for k, w in enumerate(listed)], np.uint8)
    distinct = int(words.sum()) + min(SINGLES, len(listed)) + (ends > 0)
    return Vocabulary(counts, int(inside.sum()), distinct, ends, frequent, numbers, own, inside, once)


def encode(docs: DataFrame, learnt: Column, words: Vocabulary) -> DataFrame:
    """One row per text: packed classes and word hashes of its tokens, sums over its frequent words, and its rare words."""
    frequent, numbers, own = words.frequent, words.numbers, words.classes
    base, end_base = words.base(numbers), float(words.base(np.array([words.ends]))[0])
    unseen, inside = words.unseen(), words.inside
    shares = np.log((1 - unseen[own]) * numbers / np.maximum(inside[own], 1)) if len(numbers) else np.zeros(0)
    spread = np.array([zlib.crc32(w) & 0xFFFF for w in frequent.cast(pa.binary()).to_pylist()], np.uint16)
    ends_known = int(words.ends > 0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            found, lengths = _found(block["text"])
            # By number of a distinct word: its place, or -1, and what follows from it.
            places = pc.fill_null(pc.index_in(found.dictionary, value_set=frequent.cast(found.dictionary.type)), -1).to_numpy()
            known = places >= 0
            classes, hashes = np.zeros(len(places), np.uint8), np.zeros(len(places), np.uint16)
            bases, inners = np.zeros(len(places)), np.zeros(len(places))
            for values, by_place in ((classes, own), (hashes, spread), (bases, base), (inners, shares)):
                values[known] = by_place[places[known]]
            rare = found.dictionary.filter(pa.array(~known)).cast(pa.binary()).to_pylist()
            classes[~known], hashes[~known] = [form(w) for w in rare], [zlib.crc32(w) & 0xFFFF for w in rare]

            ids, rows = found.indices.to_numpy(), len(lengths)
            text = np.repeat(np.arange(rows), lengths)
            sums = lambda by_word: np.bincount(text, by_word[ids], rows).astype(np.float64)  # noqa: B023, E731
            bounds = np.concatenate(([0], np.cumsum(lengths + 1)))
            tokens = []
            for values in (classes, hashes):
                packed = np.zeros(bounds[-1], values.dtype)
                packed[np.arange(len(ids)) + text] = values[ids]  # an end, 0, stands after each text
                starts = pa.py_buffer((bounds * values.itemsize).astype(np.int32))
                tokens.append(pa.Array.from_buffers(pa.binary(), rows, [None, starts, pa.py_buffer(packed)]))
            drawn = [zlib.crc32(h.as_buffer(), zlib.crc32(c.as_buffer())) % JUDGED == 0 for c, h in zip(*tokens, strict=True)]

            seen = ~known[ids]
            pairs, times = np.unique(text[seen] * len(places) + ids[seen], return_counts=True)
            word = pairs % max(len(places), 1)
            offsets = np.searchsorted(pairs, np.arange(rows + 1) * len(places)).astype(np.int32)
            held = pa.StructArray.from_arrays(
                [found.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(classes[word].astype(np.int32)), pa.array(times.astype(np.int32))], ["word", "form", "n"]
            )
            columns = {
                "doc_id": block["doc_id"], "train": block["train"], "judged": pa.array(drawn, pa.bool_()),
                "n_tokens": lengths + 1, "n_frequent": sums(known).astype(np.int64) + ends_known,
                "base": sums(bases) + end_base, "inner": sums(inners),
                "classes": tokens[0], "hashes": tokens[1], "rare": pa.ListArray.from_arrays(pa.array(offsets), held),
            }
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], names=list(columns))

    return docs.select("doc_id", "text", F.coalesce(learnt, F.lit(False)).alias("train")).mapInArrow(run, _ENCODED)


def _tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """(batch, first, classes, features): the tokens of a block of encoded texts; features has a row index for each of the four templates."""
    for block in blocks(batches, "classes", HELD_TOKENS):
        classes = np.frombuffer(b"".join(block["classes"].to_pylist()), np.uint8)
        hashes = np.frombuffer(b"".join(block["hashes"].to_pylist()), np.uint16)
        first = np.concatenate(([0], np.cumsum(block["n_tokens"].to_numpy())))
        # Three ends, 0, stand before the first text. The end of a text stands before the next one; what is further back counts as ends too.
        c, h = np.zeros(len(classes) + 3, np.int64), np.zeros(len(hashes) + 3, np.int64)
        c[3:], h[3:] = classes, hashes
        c1, h1, h2 = c[2:-1], h[2:-1], h[1:-2]
        features = np.empty((TEMPLATES, len(classes)), np.int64)
        features[0] = h1 % ROWS
        features[2] = (h2 * 2654435761 >> 7) % ROWS
        features[2, first[:-1]] = 0
        for template, back in ((1, 2), (3, 3)):
            own = np.multiply(c[3 - back : -back], CLASSES, out=features[template])
            for k in range(back - 1):
                own[first[:-1][first[:-1] + k < len(own)] + k] = 0
            own += c1
        features += np.arange(0, TEMPLATES * ROWS, ROWS)[:, None]
        yield block, first, c[3:], features


TEMPLATES = 4
_held: dict[str, np.ndarray] = {}


def _factors(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Exponentials of the weights, taken once and multiplied for every token; those of the first template hold the bias."""
    factors = np.exp(np.clip(weights, -LARGEST, LARGEST)).astype(np.float32)
    factors[:ROWS] *= np.exp(bias)
    return factors


def _buffer(name: str, rows: int) -> np.ndarray:
    """Memory for rows of class values that a task writes anew in every step; new arrays would cost it more than the sums themselves."""
    if len(_held.get(name, ())) < rows:
        _held[name] = np.empty((max(rows, CHUNK), CLASSES), np.float32)
    return _held[name][:rows]


def _product(factors: np.ndarray, features: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The factors of the features of each token, multiplied."""
    np.take(factors, features[0], axis=0, out=out, mode="clip")  # clip: all rows exist, and take writes to `out` without a copy
    other = _buffer("other", len(out))
    for rows in features[1:]:
        out *= np.take(factors, rows, axis=0, out=other, mode="clip")
    return out


def _expected(weights: np.ndarray, bias: np.ndarray, features: np.ndarray) -> np.ndarray:
    """P(class | history) of each token."""
    shares = _product(_factors(weights, bias), features, np.empty((features.shape[1], CLASSES), np.float32))
    return shares / shares.sum(1, keepdims=True)


def _logs(factors: np.ndarray, classes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """log P(class | history) of each token's own class."""
    logs = np.zeros(len(classes))
    for low in range(0, len(classes), CHUNK):
        rows, own = features[:, low : low + CHUNK], classes[low : low + CHUNK]
        first, last = _product(factors, rows[:-1], _buffer("first", len(own))), np.take(factors, rows[-1], axis=0, out=_buffer("other", len(own)), mode="clip")
        at = np.arange(len(own))
        logs[low : low + CHUNK] = np.log(first[at, own] * last[at, own] / np.einsum("ij,ij->i", first, last))
    return logs


def _histories(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct histories, how often each came) of HISTORIES tokens at a time.

    A history is one number, from high to low: the classes two, one and three words back, and the hashed last word and word
    before the last. In order, neighbours share most of their rows.
    """

    def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys.sort()
        heads = _heads(keys)
        return keys[heads], np.diff(np.append(heads, len(keys)))

    held, filled = np.empty(HISTORIES, np.int64), 0
    for _, _, _, features in _tokens(batches):
        last, two, skipped, far = features
        keys = ((two - ROWS) * CLASSES + far // CLASSES - 3 * ROWS // CLASSES) * ROWS**2
        keys += last * ROWS
        keys += skipped - 2 * ROWS
        while len(keys):
            part, keys = np.split(keys, [HISTORIES - filled])
            held[filled : filled + len(part)] = part
            filled += len(part)
            if filled == HISTORIES:
                yield counted(held)
                filled = 0
    if filled:
        yield counted(held[:filled])


def _heads(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))


def _with_classes(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    return ((classes, features) for _, _, classes, features in _tokens(batches))


def _gathered(parts_of: Callable, sums_of: Callable) -> Callable:
    """A mapInArrow function: sums by (feature row, class) over the tokens of a partition, as one packed row per feature row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((TEMPLATES * ROWS, CLASSES))
        for part in parts_of(batches):
            sums_of(sums, *part)
        rows = np.flatnonzero(sums.any(1))
        yield from _packed(rows, sums[rows])

    return run


def _summed(encoded: DataFrame, parts_of: Callable, sums_of: Callable) -> np.ndarray:
    """The sums over all training tokens. Partial sums meet by feature row; the result has a fixed size."""

    def met(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, values in zip(batch["row"].to_pylist(), batch["sums"], strict=True):
                own = np.frombuffer(values.as_buffer(), np.float32).astype(np.float64)
                sums[row] = sums[row] + own if row in sums else own
        if sums:
            yield from _packed(np.array(list(sums)), np.stack(list(sums.values())))

    kind = "row int, sums binary"
    parts = encoded.where("train").select("n_tokens", "classes", "hashes").mapInArrow(_gathered(parts_of, sums_of), kind)
    total = parts.repartition("row").mapInArrow(met, kind).toArrow()  # one row per feature row
    out = np.zeros((TEMPLATES * ROWS, CLASSES))
    if total.num_rows:
        out[total["row"].to_numpy()] = np.stack([np.frombuffer(x.as_buffer(), np.float32) for x in total["sums"]])
    return out


def observed_counts(encoded: DataFrame) -> np.ndarray:
    """How often each class came under each feature row."""

    def count(sums: np.ndarray, classes: np.ndarray, features: np.ndarray) -> None:
        for template, rows in enumerate(features):
            own = np.bincount((rows - template * ROWS) * CLASSES + classes, minlength=ROWS * CLASSES)
            sums[template * ROWS : (template + 1) * ROWS] += own.reshape(ROWS, CLASSES)

    return _summed(encoded, _with_classes, count)


def gradient(encoded: DataFrame, weights: np.ndarray, bias: np.ndarray, observed: np.ndarray) -> np.ndarray:
    """Observed less expected counts of each class under each feature row. The observed ones are the same in every pass."""

    factors = _factors(weights, bias)

    def expect(sums: np.ndarray, histories: np.ndarray, times: np.ndarray) -> None:
        # Two neighbouring classes are one complex number: half as many additions by index.
        pairs = np.zeros((CLASSES // 2, TEMPLATES * ROWS), np.complex64)
        shares = np.empty((CLASSES // 2, SPREAD), np.complex64)
        for low in range(0, len(histories), SPREAD):
            keys, n = histories[low : low + SPREAD], times[low : low + SPREAD].astype(np.float32)
            last, skipped, behind = keys // ROWS % ROWS, 2 * ROWS + keys % ROWS, keys // ROWS**2
            # Histories with the same three classes stand together; their factors are multiplied and their sums added once.
            heads = _heads(behind)
            group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(keys))))
            two, far = np.divmod(behind[heads], CLASSES)
            two, far = ROWS + two, 3 * ROWS + far * CLASSES + two % CLASSES
            both = factors[two] * factors[far]
            for k in range(0, len(keys), CHUNK):
                at = slice(k, min(k + CHUNK, len(keys)))
                part = _product(factors, (last[at], skipped[at]), _buffer("first", at.stop - k))
                part *= np.take(both, group[at], axis=0, out=_buffer("other", len(part)), mode="clip")
                part *= (n[at] / np.einsum("ij->i", part))[:, None]
                shares[:, at] = part.view(np.complex64).T
            own = shares[:, : len(keys)]
            for pair, values, added in zip(pairs, own, np.add.reduceat(own, heads, axis=1), strict=True):
                for rows, by_row in ((last, values), (skipped, values), (two, added), (far, added)):
                    np.add.at(pair, rows, by_row)
        sums += np.ascontiguousarray(pairs.T).view(np.float32)

    return observed - _summed(encoded, _histories, expect)


def loss(encoded: DataFrame, weights: np.ndarray, bias: np.ndarray) -> float:
    """The mean of -log P(class | history) over the tokens of all training texts of `encoded`."""
    factors = _factors(weights, bias)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, total = 0, 0.0
        for _, _, classes, features in _tokens(batches):
            tokens, total = tokens + len(classes), total - float(_logs(factors, classes, features).sum())
        yield pa.RecordBatch.from_arrays([pa.array([tokens]), pa.array([total])], names=["tokens", "total"])

    sums = encoded.where("train").select("n_tokens", "classes", "hashes").mapInArrow(run, "tokens long, total double")
    tokens, total = sums.agg(F.sum("tokens"), F.sum("total")).first()
    return total / tokens if tokens else 0.0


def divided(encoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The training texts that move the weights and those that judge them; too few to divide do both."""
    texts = encoded.where("train")
    if len(texts.select("judged").distinct().collect()) < 2:
        return texts, texts
    return texts.where("not judged"), texts.where("judged")


def train(encoded: DataFrame, bias: np.ndarray, updates: int | None) -> np.ndarray:
    """The weights after distributed gradient updates, as many as lower the loss of the judged texts."""
    learnt, judged = divided(encoded)
    observed = observed_counts(learnt)
    # From a model that knows no history the ratio of the counts tells the way; a template answers for its part.
    smooth = PRIOR * np.exp(bias)
    uniform = observed.sum(1, keepdims=True) * np.exp(bias)
    most = np.maximum(observed, uniform)
    weights = (STEP * np.log((observed + smooth) / (uniform + smooth)) * most / (most + PENALTY)).astype(np.float32)
    best, made = loss(judged, weights, bias), 1
    while updates is None or made < updates:
        step = gradient(learnt, weights, bias, observed)
        scale = np.maximum(observed, observed - step) + PRIOR + PENALTY
        moved = np.clip(weights + STEP * (step - PENALTY * weights) / scale, -LARGEST, LARGEST).astype(np.float32)
        reached, made = loss(judged, moved, bias), made + 1
        enough = not reached < best * (1 - TOLERANCE)
        if reached < best:
            weights, best = moved, reached
        if enough:
            break
    return weights


def _packed(rows: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(rows), 2048):
        values = [v.astype(np.float32).tobytes() for v in sums[low : low + 2048]]
        yield pa.RecordBatch.from_arrays([pa.array(rows[low : low + 2048].astype(np.int32)), pa.array(values, pa.binary())], names=["row", "sums"])


def score_texts(docs: DataFrame, learnt: Column, updates: int | None = UPDATES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of `docs`; `learnt` marks what the model learns from.

    Tokens are the words in lower-case ASCII letters and one end per text; a null or empty text is its end
    alone. `base_score` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) over the tokens, `score` the
    model's log10 probability. Repeated ids give repeated rows, a null id stays null and is
    learnt from only if `learnt` says so. Without training texts both scores come from the priors. Other columns are not read.
    """
    words = vocabulary(docs.where(learnt))
    encoded = staged(encode(docs, learnt, words).withColumn("row", F.monotonically_increasing_id()), "encoded")
    bias = np.log(words.prior()).astype(np.float32)
    factors = _factors(train(encoded, bias, updates), bias)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, first, classes, features in _tokens(batches):
            logs = _logs(factors, classes, features)
            yield pa.RecordBatch.from_arrays([block["row"], pa.array(np.add.reduceat(logs, first[:-1]))], names=["row", "outer"])

    outer = encoded.select("row", "n_tokens", "classes", "hashes").mapInArrow(run, "row long, outer double")
    unseen, inside = words.unseen().tolist(), np.maximum(words.inside, 1).tolist()
    by_class = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("form") + 1)
    n = F.coalesce(F.col("c"), F.lit(0))
    share = F.when(n > 0, F.log((1 - by_class(unseen)) * n / by_class(inside))).otherwise(F.log(by_class(unseen)))
    floor = log(words.total + 0.5 * (words.distinct + 1)) / log(10)
    rare = (
        encoded.select("row", F.explode("rare").alias("r"))
        .select("row", "r.word", "r.form", F.col("r.n").alias("times"))
        .join(words.counts.select("word", F.col("n").alias("c")), "word", "left")
        .select("row", (F.col("times") * (n > 0).cast("long")).alias("known"), (F.col("times") * (F.log10(n + 0.5) - floor)).alias("base_rare"), (F.col("times") * share).alias("inner_rare"))
        .groupBy("row")
        .agg(*(F.sum(c).alias(c) for c in ("known", "base_rare", "inner_rare")))
    )
    own = encoded.select("row", "doc_id", "n_tokens", "n_frequent", "base", "inner")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return (
        own.join(outer, "row")
        .join(rare, "row", "left")
        .select(
            "doc_id", "n_tokens", (F.col("n_frequent") + zero("known")).alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
            (F.col("base") + zero("base_rare")).alias("base_score"),
            ((F.col("outer") + F.col("inner") + zero("inner_rare")) / log(10)).alias("score"),
        )
    )
