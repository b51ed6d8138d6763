"""Toxic spans by a linear-chain conditional random field.

A text is a chain of words, each toxic or not (Lafferty, McCallum and Pereira, 2001). A word's potential is a sum of
hashed features (the word, its first and last letters, the words beside it); a transition table joins neighbours. Forward
and backward messages give each word's marginal. A document's score is calibrated from its largest marginal and its
expected number of toxic words, and its spans are the runs of words whose marginal is at least one half.

Labels are given for documents, not for words. Token labels come from them: in a toxic training document, the words that
are far more frequent in toxic than in other training documents are toxic; all others, and every word of the other
documents, are not. Words are counted in a bounded sample (EVIDENCE_ROWS documents of each label, EVIDENCE_BYTES for each)
that leaves out the held-out third and passes over texts that do not fit it: a language with few documents needs many
others beside it before its words can be told from chance. The field is fitted on a part of that sample (SAMPLE_ROWS and
SAMPLE_BYTES for each label), and the calibration is weighted to the labels' true shares.

Spark scores all documents in one pass without a shuffle. Messages run over a whole batch of documents as one chain that
forgets its state where a document begins, so the cost for each word does not depend on a text's length. Null and empty
texts have no word and get the score of no evidence. Without toxic labels every score is that of no evidence; labels of
both kinds of which one has no document to learn from are an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, functions as F

from marketpulse.llm.common import held_out, keyed_schema, labelled_sample

DIMENSIONS = 1 << 16
SAMPLE_ROWS, SAMPLE_BYTES = 1000, 5 << 20
EVIDENCE_ROWS, EVIDENCE_BYTES = 5000, 12 << 20
# A word is taken as toxic if its log-odds are so high, and chance would bring up so few such words among all.
LEAST_LOG_ODDS, BY_CHANCE = 2.5, 20
ROUNDS, RATE, RIDGE = 40, 0.3, 1e-6
# Words of one batch of messages, and words whose potentials a task keeps.
BATCH_WORDS, CACHED = 400_000, 400_000
WORD = r"[^\W\d_]+"


def feature_indices(word: str) -> tuple[int, int, int, int, int]:
    """Hashed features: the word, its first and last three letters, and the word as the one before or after."""
    from zlib import crc32

    return tuple(crc32(f.encode()) % DIMENSIONS for f in (f"w{word}", f"f{word[:3]}", f"l{word[-3:]}", f"b{word}", f"a{word}"))


def messages(matrices):
    """Normalised forward messages of a chain of 2x2 matrices, a row vector for each step.

    The chain is cut into rows of equal length. All rows multiply up their matrices side by side, the rows' products are
    chained, and all rows walk again side by side from their true starts: square root of n steps instead of n.
    """
    import numpy as np

    n = len(matrices)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    padded = np.empty((rows * width, 2, 2))
    padded[:n] = matrices
    padded[n:] = np.eye(2)
    grid = padded.reshape(rows, width, 2, 2)
    product = np.broadcast_to(np.eye(2), (rows, 2, 2))
    for c in range(width):
        product = product @ grid[:, c]
        product = product / product.sum(axis=(1, 2), keepdims=True)
    state = np.empty((rows, 2))
    v = np.array([0.5, 0.5])
    for r in range(rows):
        state[r] = v
        v = v @ product[r]
        v = v / v.sum()
    out = np.empty((rows, width, 2))
    for c in range(width):
        state = state[:, 0, None] * grid[:, c, 0] + state[:, 1, None] * grid[:, c, 1]
        state = state / state.sum(axis=1, keepdims=True)
        out[:, c] = state
    return out.reshape(-1, 2)[:n]


def chain(potential, first, transition):
    """Step matrices of a batch: entry (a, b) weighs state b after state a; a document's first word forgets what was."""
    import numpy as np

    matrices = np.empty((len(potential), 2, 2))
    matrices[:] = np.exp(transition)
    matrices[first] = 1.0
    matrices[:, :, 1] *= np.exp(np.clip(potential, -30, 30))[:, None]
    return matrices


def marginals(potential, first, transition):
    """(p, forward, backward, matrices): p is each word's probability of being toxic."""
    import numpy as np

    matrices = chain(potential, first, transition)
    forward = messages(matrices)
    # Backward messages are forward messages of the turned chain: what follows word i is seen through matrix i + 1.
    turned = np.ones((len(potential), 2, 2))
    turned[1:] = matrices[:0:-1].transpose(0, 2, 1)
    backward = messages(turned)[::-1]
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), forward, backward, matrices


@dataclass(frozen=True)
class SpanModel:
    """Feature weights, transition table, and calibration (bias, weight of the largest marginal, of their number)."""

    weights: Any
    bias: float
    transition: Any
    calibration: Any


def evidence(p, owner, n_docs: int):
    """For each document: log-odds of its largest marginal, and the logarithm of 1 + its expected toxic words.

    Only marginals of one half and more are counted, so that a long text's many tiny ones do not add up to something.
    """
    import numpy as np

    top = np.zeros(n_docs)
    np.maximum.at(top, owner, p)
    top = np.clip(top, 1e-4, 1 - 1e-4)
    many = np.bincount(owner, weights=np.where(p >= 0.5, p, 0.0), minlength=n_docs)
    return np.stack([np.log(top / (1 - top)), np.log1p(many)], axis=1)


def sigmoid(z):
    import numpy as np

    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def token_labels(numbers: list, labels, n_words: int):
    """Whether each word tells toxic from other documents, by smoothed log-odds of document counts.

    The counts must also be unlikely for a word that does not care, by Chernoff's bound times the number of words.
    """
    import numpy as np

    labels = np.asarray(labels)
    counts = np.zeros((2, n_words))
    for words, label in zip(numbers, labels):
        counts[int(label), np.unique(words)] += 1
    of = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
    odds = np.log((counts + 0.5) / (of - counts + 0.5))
    share, n = of[1, 0] / max(of.sum(), 1), counts.sum(axis=0)
    if not 0 < share < 1:
        return np.zeros(n_words, dtype=bool)
    q = counts[1] / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        surprise = n * (np.nan_to_num(q * np.log(q / share)) + np.nan_to_num((1 - q) * np.log((1 - q) / (1 - share))))
    return (q > share) & (odds[1] - odds[0] >= LEAST_LOG_ODDS) & (surprise >= np.log(n_words / BY_CHANCE))


def batches_of(numbers: list, labels, is_toxic) -> list[tuple]:
    """Documents as runs of at most BATCH_WORDS words or one document: what a step of the fit has in memory at once."""
    import numpy as np

    runs_, held, size = [], [], 0
    for d, words in enumerate(numbers):
        if held and size + len(words) > BATCH_WORDS // 4:
            runs_.append(held)
            held, size = [], 0
        held.append(d)
        size += len(words)
    out = []
    for run in [*runs_, held] if held else runs_:
        lengths = np.array([len(numbers[d]) for d in run])
        if lengths.sum():
            word = np.concatenate([numbers[d] for d in run])
            owner = np.repeat(np.array(run, dtype=np.int32), lengths)
            first = np.r_[True, owner[1:] != owner[:-1]]
            out.append((word, owner, first, np.r_[first[1:], True], is_toxic[word] & (np.asarray(labels)[owner] == 1)))
    return out


def fit(numbers: list, labels, vocabulary: list[str], is_toxic, share: float) -> SpanModel:
    """Maximum likelihood of the token labels by Adam; then a logistic calibration of the documents' evidence.

    `numbers` holds each document's words as numbers of the vocabulary, and `is_toxic` tells its toxic words. A step goes
    through the documents in batches and adds up the gradient, so its memory does not follow the sample.
    """
    import numpy as np

    if not is_toxic.any():
        return SpanModel(np.zeros(DIMENSIONS), -4.0, np.zeros((2, 2)), np.array([-4.0, 0.0, 0.0]))
    features = np.array([feature_indices(w) for w in vocabulary], dtype=np.int32)
    batches = batches_of(numbers, labels, is_toxic)
    params = np.concatenate([np.zeros(DIMENSIONS), [-4.0], np.zeros(4)])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, ROUNDS + 1):
        weights, bias, transition = params[:DIMENSIONS], params[DIMENSIONS], params[-4:].reshape(2, 2)
        by_word, by_bias, by_pair = np.zeros((3, len(vocabulary))), 0.0, np.zeros((2, 2))
        for word, _, first, last, toxic in batches:
            p, forward, backward, matrices = marginals(potentials(weights, bias, features, word, first, last), first, transition)
            inner = np.flatnonzero(~first)
            pair = forward[inner - 1, :, None] * matrices[inner] * backward[inner, None, :]
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            np.add.at(by_pair, (toxic[inner - 1].astype(int), toxic[inner].astype(int)), 1)
            by_pair -= pair.sum(axis=0)
            error = toxic - p
            by_bias += error.sum()
            by_word[0] += np.bincount(word, weights=error, minlength=len(vocabulary))
            by_word[1] += np.bincount(word[inner - 1], weights=error[inner], minlength=len(vocabulary))
            by_word[2] += np.bincount(word[inner], weights=error[inner - 1], minlength=len(vocabulary))
        by_weight = np.zeros(DIMENSIONS)
        for column, g in enumerate((0, 0, 0, 1, 2)):
            by_weight += np.bincount(features[:, column], weights=by_word[g], minlength=DIMENSIONS)
        gradient = np.concatenate([by_weight, [by_bias], by_pair.ravel()]) / len(numbers) - RIDGE * params
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        params = params + RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)
    weights, bias, transition = params[:DIMENSIONS], params[DIMENSIONS], params[-4:].reshape(2, 2)
    x = np.hstack([np.ones((len(numbers), 1)), evidence(np.zeros(0), np.zeros(0, dtype=int), len(numbers))])
    for word, owner, first, last, _ in batches:
        p = marginals(potentials(weights, bias, features, word, first, last), first, transition)[0]
        own = np.unique(owner)
        x[own, 1:] = evidence(p, np.searchsorted(own, owner), len(own))
    label = np.asarray(labels, dtype=float)
    # The sample holds both labels alike; the weights bring back the share that toxic documents have.
    weight = np.where(label == 1, share / max(label.mean(), 1e-9), (1 - share) / max(1 - label.mean(), 1e-9))
    c = np.zeros(3)
    for _ in range(30):
        q = sigmoid(x @ c)
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + 0.5 * np.eye(3)
        c = c + np.linalg.solve(hessian, x.T @ (weight * (label - q)) - 0.5 * c)
    return SpanModel(weights, float(bias), transition, c)


def potentials(weights, bias, features, word, first, last):
    """Potential of every word of a batch from its own features and those of its neighbours in the document."""
    import numpy as np

    own = weights[features[:, :3]].sum(axis=1)[word] + bias
    before, after = weights[features[:, 3]][word], weights[features[:, 4]][word]
    own[1:] += np.where(first[1:], 0.0, before[:-1])
    own[:-1] += np.where(last[:-1], 0.0, after[1:])
    return own


def within_bounds(given: list[int], sizes: list[int], marks: list[int], rows: int, max_bytes: int) -> list[int]:
    """Of each label the first documents by their marks, as many as the bounds allow; one that does not fit is passed over."""
    chosen = []
    for value in (0, 1):
        n, left = 0, max_bytes
        for i in sorted((i for i, g in enumerate(given) if g == value), key=lambda i: (marks[i], sizes[i])):
            if n < rows and sizes[i] <= left:
                chosen.append(i)
                n, left = n + 1, left - sizes[i]
    return chosen


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
    sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES,
    evidence_rows: int = EVIDENCE_ROWS, evidence_bytes: int = EVIDENCE_BYTES,
) -> SpanModel:
    """Words are judged by the evidence sample, the field is fitted on what of it `sample_rows` and `sample_bytes` allow."""
    import re
    from zlib import crc32

    import numpy as np

    flag = F.when(F.col(label) > 0, 1).when(F.col(label) == 0, 0)
    counted = labels.where(~held_out(key)).agg(F.avg(flag).alias("share")).first()
    ids: dict[str, int] = {}
    numbers, given, sizes, marks = [], [], [], []
    for value in (0, 1):
        only = F.when(flag == value, flag)
        sample = labelled_sample(docs, labels, only, evidence_rows, evidence_bytes, key, text)
        for row in sample.toLocalIterator():
            raw = row["text"].encode()
            words = re.findall(WORD, row["text"].lower())
            numbers.append(np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int32))
            given.append(row["label"])
            sizes.append(len(raw))
            marks.append(crc32(raw))
    share = counted["share"] or 0.0
    if 0 < share < 1 and len(set(given)) < 2 and not docs.isEmpty():
        raise ValueError("there are labels of both kinds, but of one of them no document to learn from")
    is_toxic = token_labels(numbers, given, len(ids)) if ids else np.zeros(0, dtype=bool)
    chosen = within_bounds(given, sizes, marks, sample_rows, sample_bytes)
    if given and len({given[i] for i in chosen}) < len(set(given)):
        raise ValueError(f"none of the labelled documents of one kind fits {sample_bytes} bytes")
    # Only words of the chosen documents are kept, numbered anew.
    vocabulary = list(ids)
    known, inner = np.unique(np.concatenate([numbers[i] for i in chosen]), return_inverse=True) if chosen else (np.zeros(0, int), None)
    cuts = np.cumsum([len(numbers[i]) for i in chosen])[:-1]
    words = np.split(inner.astype(np.int32), cuts) if chosen else []
    return fit(words, [given[i] for i in chosen], [vocabulary[k] for k in known], is_toxic[known], share)


def score(docs: DataFrame, model: SpanModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, spans): spans are (start, end, p) in characters of the text, p the largest marginal in the run."""
    # Plain values: broadcasts are read back by name, and the workers may not have this library.
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.transition, model.calibration))

    def judge(batches: Iterable) -> Iterator:
        import re

        import numpy as np
        import pyarrow as pa

        model = SpanModel(*shared.value)
        find, places = re.compile(WORD).findall, re.compile(WORD).finditer
        ids: dict[str, int] = {}
        features: list[tuple] = []

        def number(word: str) -> int:
            i = ids[word] = len(features)
            features.append(feature_indices(word.lower()))
            return i

        def flush(keys: Any, texts: list[str], words: list[list[int]]):
            lengths = np.array([len(w) for w in words])
            owner = np.repeat(np.arange(len(words)), lengths)
            spans: list[list[dict]] = [[] for _ in words]
            if len(owner):
                word = np.concatenate([np.array(w, dtype=np.int64) for w in words])
                first = np.r_[True, owner[1:] != owner[:-1]]
                last = np.r_[first[1:], True]
                known, word = np.unique(word, return_inverse=True)
                table = np.array([features[i] for i in known])
                p = marginals(potentials(model.weights, model.bias, table, word, first, last), first, model.transition)[0]
                begins = np.concatenate([[0], np.cumsum(lengths)])
                for d in np.unique(owner[p >= 0.5]):
                    spans[d] = runs(list(places(texts[d])), p[begins[d] : begins[d + 1]])
            else:
                p = np.zeros(0)
            x = np.hstack([np.ones((len(words), 1)), evidence(p, owner, len(words))])
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(sigmoid(x @ model.calibration)), pa.array(spans, span_type)],
                names=[key, "score", "spans"],
            )

        span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            # Keys stay as they are, whatever columns they have: rows of a batch are judged in runs.
            begin, texts, words, n = 0, [], [], 0
            for content in batch.column(1):
                content = content.as_py() or ""
                found = find(content)
                if len(ids) > CACHED and not texts:
                    ids.clear()
                    features.clear()
                numbers = list(map(ids.get, found))
                if None in numbers:
                    numbers = [ids[w] if w in ids else number(w) for w in found]
                texts.append(content)
                words.append(numbers)
                n += len(numbers)
                if n >= BATCH_WORDS:
                    yield flush(batch.column(0).slice(begin, len(texts)), texts, words)
                    begin, texts, words, n = begin + len(texts), [], [], 0
            if texts:
                yield flush(batch.column(0).slice(begin, len(texts)), texts, words)

    return docs.select(key, text).mapInArrow(
        judge, keyed_schema(docs, key, "score double, spans array<struct<start:int,end:int,p:double>>")
    )


def runs(places: list, p) -> list[dict]:
    """Neighbouring words with marginals of at least one half, as one span each."""
    spans: list[dict] = []
    before = -2
    for i in (p >= 0.5).nonzero()[0]:
        place, value = places[i], float(p[i])
        if i == before + 1:
            spans[-1]["end"], spans[-1]["p"] = place.end(), max(value, spans[-1]["p"])
        else:
            spans.append({"start": place.start(), "end": place.end(), "p": value})
        before = i
    return spans
