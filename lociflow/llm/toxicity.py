"""Toxicity by a subsequence string kernel and a Nyström support vector machine (operator 1).

Units.  A text is cut into sentences, and the units of a sentence are its runs of one to
``UNIT_WORDS`` consecutive words, read without the space between them; so an insult may lie in
one word, be split by a space, or be made of ordinary words.  Words are folded first: lower
case, signs inside dropped, look-alike digits and signs read as letters, runs of single letters
joined.

Kernel.  A unit s has the feature map phi_u(s) = sum over all places where the three
characters u occur in order within ``SPAN`` characters of DECAY ** (length of that place):
gapped and inserted characters cost a factor but keep the match.  k(s, t) = <phi(s), phi(t)>
/ sqrt(c(s) c(t)), with c(s) the sum of squared weights of all places (a function of the
length alone, so k stays positive definite).

Classifier.  A linear machine with squared hinge loss runs on the Nyström map of ``LANDMARKS``
units.  Labels belong to documents, so the sentences of a labelled document are its bag:
every unit of a clean document is negative, and in a toxic one the best-scoring units are
positive (its witnesses, at most ``TOP_UNITS``, chosen anew each round; the first ones by the odds
of their triples and of the unit itself).  A witness weighs by the square root of the documents
that show it, so the insults of a rare language are learnt too.  A unit can be a witness when it is at least ``MIN_ODDS`` times as frequent among toxic documents as among clean ones, so
a wrong clean label does not bar an insult.  Witnesses are chosen in two folds: the machine
that scores a document's units has not seen that document, and a label whose best unit finds
no support in the other fold teaches nothing.  A document's margin is that of its best unit mixed
with the mean of the next ones, which start with other words and do not overlap; the mix is the one
of ``BREADTHS`` with the least log loss on out-of-fold margins (0: the best unit alone), and a
logistic curve fitted on the same margins maps it to 0..1.

Because the kernel is a dot product of explicit features, the trained machine folds into one
weight per character triple: f(s) = <phi(s), w> / sqrt(c(s)) + b.  Scoring is then a table
look-up over whole texts, and the model has a fixed size (``CLASSES`` ** 3 weights).

Bounded sample (documented parameters of the fit): ``SAMPLE_DOCS`` documents and about
``SAMPLE_CHARS`` characters of each label, drawn by a hash of the id among the labels before any
text is read; texts are never shuffled.

Edge cases: null, empty and wordless texts score like no evidence (the curve at the lowest
margin); without training rows of both labels every document scores 0; a document whose id has
several labels is toxic if one of them says so, and of several texts under one labelled id the
fit reads the shortest, then the least; null ids are not labelled; ties of the draw are broken by the id; very long texts
are scored whole; repeated rows get equal scores; clashing columns are replaced; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociflow.llm.common import small_batches

SAMPLE_DOCS, SAMPLE_CHARS = 1500, 2_000_000
CLASSES, SPAN, DECAY = 64, 5, 0.6
LANDMARKS, ROUNDS, NEGATIVES = 320, 3, 8_000
UNIT_WORDS, MIN_JOINED, MIN_ODDS = 2, 5, 2.7
TOP_UNITS, BREADTHS, SHRINK = 3, (0.0, 0.25, 0.5, 0.75), 4.0
#: Signs and digits read as letters (fixed values).
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_PAIRS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN) if a + b < SPAN]
_LOW = -2.0  # margin of a document without words


def _class_table() -> np.ndarray:
    """Character class per code point below 0x3000: 0 separates, 255 is dropped, 1-26 a-z, the rest other letters."""
    out = np.full(0x3000, 255, np.uint8)
    for code in range(0x3000):
        c = chr(code)
        if c.isspace():
            out[code] = 0
        elif c.isalpha():
            low = c.lower()[0]
            out[code] = ord(low) - 96 if "a" <= low <= "z" else 27 + ord(low) % (CLASSES - 27)
    for c, letter in LOOKALIKE.items():
        out[ord(c)] = ord(letter) - 96
    return out


_TABLE = _class_table()


@dataclass
class Folded:
    """Folded characters of many texts: classes, word starts and lengths, and the text and sentence of each word."""

    chars: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    doc: np.ndarray
    sentence: np.ndarray


def fold(texts: list[str | None]) -> Folded:
    joined = "".join((t or "") + "\n" for t in texts)
    ends = np.cumsum([len(t or "") + 1 for t in texts], dtype=np.int64)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = codes < 0x3000
    classes = np.where(known, _TABLE[np.where(known, codes, 0)], (27 + codes % (CLASSES - 27)).astype(np.uint8)).astype(np.uint8)
    doc_of = np.searchsorted(ends, np.arange(len(codes)), side="right").astype(np.int32)
    # trailing ! and $ of a word are signs, not letters
    sign = (codes == 33) | (codes == 36)
    follows = np.ones(len(codes), bool)
    if len(codes):
        nxt = np.append(classes[1:], 0)
        follows = (nxt == 0) | (nxt == 255) | np.append(sign[1:], True)
    classes[sign & follows] = 255
    # a sentence ends with its line, or with a stop before white space
    stop = (codes == 10) | (((codes == 46) | (codes == 33) | (codes == 63)) & (np.append(classes[1:], 0) == 0 if len(codes) else False))
    sentence_of = np.cumsum(stop)
    keep = classes != 255
    classes, doc_of, sentence_of = classes[keep], doc_of[keep], sentence_of[keep]
    is_char = classes > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], is_char, [False]]).astype(np.int8)))
    starts, stops = edge[::2], edge[1::2]
    lengths = stops - starts
    # a run of single letters with one separator between them is one word
    joins = np.zeros(len(starts), bool)
    if len(starts) > 1:
        joins[1:] = (lengths[1:] == 1) & (lengths[:-1] == 1) & (starts[1:] - stops[:-1] == 1) & (doc_of[starts[1:]] == doc_of[starts[:-1]])
    chars = classes[is_char]
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
    first = np.flatnonzero(~joins)
    word_starts = offsets[first]
    word_lengths = np.diff(np.append(word_starts, len(chars)))
    return Folded(chars, word_starts, word_lengths, doc_of[starts[first]], sentence_of[starts[first]])


def _norms(longest: int) -> np.ndarray:
    """sqrt of c for every word length."""
    n = np.arange(longest + 1)
    c = sum(np.maximum(n - (a + b), 0) * DECAY ** (2 * (a + b + 1)) for a, b in _PAIRS)
    return np.sqrt(np.maximum(c, DECAY**6))


def _places(f: Folded, words: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """(positions, words further on, triple codes, weight) for every gap pattern, within ``words`` words of a sentence."""
    word = np.repeat(np.arange(len(f.starts), dtype=np.int32), f.lengths)
    chars = f.chars.astype(np.int32)
    n = len(chars)
    for a, b in _PAIRS:
        d = a + b
        if n <= d:
            continue
        apart = word[d:] - word[: n - d]
        if words == 1:
            at = np.flatnonzero(apart == 0)
        else:
            at = np.flatnonzero((apart < words) & (f.sentence[word[d:]] == f.sentence[word[: n - d]]))
        yield at, apart[at], (chars[at] * CLASSES + chars[at + a]) * CLASSES + chars[at + d], DECAY ** (d + 1)


def unit_scores(f: Folded, weights: np.ndarray, bias: float) -> list[np.ndarray]:
    """Per number of words k (from 1): the scores of the units that start at each word, -inf where the sentence ends before."""
    if not len(f.starts):
        return [np.zeros(0) for _ in range(UNIT_WORDS)]
    # reach[k]: sums over the triples that start in a word and end at most k words later
    reach = [np.zeros(len(f.chars), np.float32) for _ in range(UNIT_WORDS)]
    for at, apart, code, weight in _places(f, UNIT_WORDS):
        value = weights[code] * np.float32(weight)
        for k in range(UNIT_WORDS):
            near = slice(None) if k == UNIT_WORDS - 1 else apart <= k
            reach[k][at[near]] += value[near]
    sums = [np.add.reduceat(r, f.starts) for r in reach]
    norms = _norms(int(f.lengths.max()) * UNIT_WORDS)
    out = [sums[0] / norms[f.lengths] + bias]
    for k in range(1, UNIT_WORDS):
        score = np.full(len(f.starts), -np.inf)
        n = len(f.starts) - k
        if n > 0:
            total = sum((sums[k - j][j : j + n] for j in range(k + 1)), np.zeros(n))
            length = sum((f.lengths[j : j + n] for j in range(k + 1)), np.zeros(n, np.int64))
            whole = (f.sentence[k:] == f.sentence[:n]) & (length >= MIN_JOINED)
            score[:n][whole] = (total / norms[length] + bias)[whole]
        out.append(score)
    return out


def top_margins(texts: list[str | None], weights: np.ndarray, bias: float) -> np.ndarray:
    """Per text the scores of its ``TOP_UNITS`` best units that start with different words and do not overlap."""
    f = fold(texts)
    out = np.full((len(texts), TOP_UNITS), _LOW)
    if not len(f.starts):
        return out
    score = np.max(unit_scores(f, weights, bias), axis=0)
    same = f.doc[1:] == f.doc[:-1]
    peak = np.append(~same | (score[:-1] >= score[1:]), True) & np.append(True, ~same | (score[1:] > score[:-1]))
    at = np.flatnonzero(peak)
    word, doc, score = _word_hash(f)[at], f.doc[at], score[at]
    order = np.lexsort((-score, word, doc))
    once = order[np.append(True, (word[order][1:] != word[order][:-1]) | (doc[order][1:] != doc[order][:-1]))]
    once = once[np.lexsort((-score[once], doc[once]))]
    docs, first, counts = np.unique(doc[once], return_index=True, return_counts=True)
    for k in range(TOP_UNITS):  # a text with fewer units repeats its last
        out[docs, k] = score[once[first + np.minimum(k, counts - 1)]]
    return out


def document_margins(texts: list[str | None], weights: np.ndarray, bias: float, breadth: float = 0.0) -> np.ndarray:
    """The best unit's score, mixed with the mean of the next ones by ``breadth``."""
    return _mixed(top_margins(texts, weights, bias), breadth)


def _mixed(top: np.ndarray, breadth: float) -> np.ndarray:
    return (1 - breadth) * top[:, 0] + breadth * top[:, 1:].mean(axis=1)


def units(f: Folded) -> Folded:
    """Every unit as a word of its own."""
    parts = []
    for k in range(UNIT_WORDS):
        n = len(f.starts) - k
        if n <= 0:
            break
        first = np.flatnonzero(f.sentence[k:] == f.sentence[:n]) if k else np.arange(n)
        ends = f.starts[first + k] + f.lengths[first + k]
        if k:  # two very short words meet by chance
            long_enough = ends - f.starts[first] >= MIN_JOINED
            first, ends = first[long_enough], ends[long_enough]
        parts.append((f.starts[first], ends - f.starts[first], f.doc[first], f.sentence[first]))
    return _gathered(f.chars, *(np.concatenate(x) for x in zip(*parts, strict=True)))


def _gathered(chars: np.ndarray, starts: np.ndarray, lengths: np.ndarray, doc: np.ndarray, sentence: np.ndarray) -> Folded:
    """Pieces of ``chars`` laid side by side."""
    new = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
    index = np.repeat(starts - new, lengths) + np.arange(lengths.sum())
    return Folded(chars[index], new, lengths, doc, sentence)


def _sparse_rows(f: Folded):
    """Per word its (code, value) entries, as row ids, codes and normalised values."""
    word = np.repeat(np.arange(len(f.starts), dtype=np.int64), f.lengths)
    rows, codes, values = [], [], []
    norms = _norms(int(f.lengths.max(initial=1)))
    for at, _, code, weight in _places(f):
        rows.append(word[at])
        codes.append(code)
        values.append(weight / norms[f.lengths[word[at]]])
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


def _subset(f: Folded, words: np.ndarray) -> Folded:
    return _gathered(f.chars, f.starts[words], f.lengths[words], f.doc[words], f.sentence[words])


def _joined(parts: list[Folded]) -> Folded:
    shift = np.cumsum([0, *(len(p.chars) for p in parts[:-1])])
    starts = np.concatenate([p.starts + k for p, k in zip(parts, shift, strict=True)])
    return Folded(np.concatenate([p.chars for p in parts]), starts, *(np.concatenate([getattr(p, name) for p in parts]) for name in ("lengths", "doc", "sentence")))


def _with_insertions(f: Folded, rng: np.random.Generator) -> Folded:
    """Each word with one letter inserted at a random inner place (training variants)."""
    n = len(f.starts)
    where = f.starts + rng.integers(1, np.maximum(2, f.lengths))
    chars = np.insert(f.chars, np.minimum(where, len(f.chars)), rng.integers(1, 27, n).astype(np.uint8))
    return Folded(chars, f.starts + np.arange(n), f.lengths + 1, f.doc, f.sentence)


def _word_hash(f: Folded) -> np.ndarray:
    """64-bit polynomial hash per word."""
    word_at = np.arange(len(f.chars)) - np.repeat(f.starts, f.lengths)
    powers = np.ones(int(f.lengths.max(initial=1)) + 1, np.uint64)
    powers[1:] = np.uint64(0x9E3779B97F4A7C15)
    powers = np.multiply.accumulate(powers)  # wraps modulo 2 ** 64
    mixed = (f.chars.astype(np.uint64) + np.uint64(1)) * powers[word_at + 1]
    return np.add.reduceat(mixed, f.starts)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    breadth: float = 0.0

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.offset, -40, 40)))


def _seed_scores(f: Folded, label: np.ndarray) -> np.ndarray:
    """Start of the witness search: mean log-odds of a word's adjacent triples by the documents that have them."""
    word = np.repeat(np.arange(len(f.starts), dtype=np.int32), f.lengths)
    at, _, codes, _ = next(_places(f), (np.zeros(0, np.int64), None, np.zeros(0, np.int32), 0.0))
    rows = word[at]
    docs = f.doc[rows].astype(np.int64)
    n = [max(1, int((label == v).sum())) for v in (0, 1)]
    pairs = np.unique(docs * CLASSES**3 + codes)
    code, y = pairs % CLASSES**3, label[pairs // CLASSES**3]
    df = [np.bincount(code[y == v], minlength=CLASSES**3) for v in (0, 1)]
    odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
    odds[df[1] + df[0] < 3] = 0
    return np.bincount(rows, odds[codes], len(f.starts)) / np.maximum(1, np.bincount(rows, minlength=len(f.starts)))


def _fit_machine(train: Folded, y: np.ndarray, weight: np.ndarray, landmarks: Folded, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Squared-hinge machine on the Nyström map; returns a weight per triple and the bias."""
    lr, lc, lv = _sparse_rows(landmarks)
    active, lc = np.unique(lc, return_inverse=True)
    m = len(landmarks.starts)
    phi = np.zeros((len(active), m))
    np.add.at(phi, (lc, lr), lv)
    values, vectors = np.linalg.eigh(phi.T @ phi)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    place = np.full(CLASSES**3, -1, np.int64)
    place[active] = np.arange(len(active))
    basis = phi @ root  # triple -> Nyström coordinate
    z = np.zeros((len(train.starts), basis.shape[1]))
    tr, tc, tv = _sparse_rows(train)
    inside = place[tc] >= 0
    tr, tc, tv = tr[inside], place[tc[inside]], tv[inside]
    order = np.argsort(tr, kind="stable")
    tr, tc, tv = tr[order], tc[order], tv[order]
    for lo in range(0, len(tr), 20_000):  # pieces of bounded memory
        part = slice(lo, lo + 20_000)
        r = tr[part]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        z[r[first]] += np.add.reduceat(basis[tc[part]] * tv[part, None], first)
    z = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(z.shape[1])
    reg = np.full(z.shape[1], ridge * weight.sum())
    reg[-1] = 1e-6
    for _ in range(25):  # Newton steps on the active set
        use = y * (z @ w) < 1
        zs, ws = z[use], weight[use]
        new = np.linalg.solve((zs * ws[:, None]).T @ zs + np.diag(reg), (zs * (ws * y[use])[:, None]).sum(0))
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    table = np.zeros(CLASSES**3)
    table[active] = basis @ w[:-1]
    return table, float(w[-1])


def _logistic(margins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic curve (Newton, smoothed targets)."""
    pos, neg = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 4.0, 0.0
    x = np.vstack([margins, np.ones(len(margins))]).T
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        h = (x * (weight * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.eye(2) * 1e-3
        step = np.linalg.solve(h, x.T @ (weight * (target - p)) - 1e-3 * np.array([a, b]))
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(a, 0.5), b


def _document_shares(hashes: np.ndarray, docs: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per unit: how many times as frequent its text is among toxic documents as among clean ones (smoothed), and how many toxic ones have it."""
    _, of = np.unique(hashes, return_inverse=True)
    seen = np.unique(np.stack([of, docs]), axis=1)
    y = label[seen[1]]
    df = [np.bincount(seen[0][y == v], minlength=of.max() + 1) for v in (0, 1)]
    rate = [(df[v] + 0.5) / (int((label == v).sum()) + 1) for v in (0, 1)]
    return (rate[1] / rate[0])[of], df[1][of]


def _train(f: Folded, hashes: np.ndarray, witness: np.ndarray, negatives: np.ndarray, hard: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """A machine from witnesses (weighted by how many documents show the same unit), variants of them, and clean units."""
    _, at, times = np.unique(hashes[witness], return_index=True, return_counts=True)
    positive = witness[at]
    easy = rng.choice(negatives, min(len(negatives), NEGATIVES), replace=False)
    negative = np.unique(np.concatenate([easy, hard]))
    gapped = _with_insertions(_subset(f, positive), rng)
    train = _joined([_subset(f, positive), gapped, _subset(f, negative)])
    y = np.concatenate([np.ones(2 * len(positive)), -np.ones(len(negative))])
    share = np.sqrt(times) / np.sqrt(times).sum()  # insults of a rare language count too
    weight = np.concatenate([share, share / 2, np.full(len(negative), 2.0 / len(negative))]) * len(y) / 2
    top = positive[np.argsort(-times, kind="stable")][: LANDMARKS * 3 // 4]
    other = rng.choice(negative, min(len(negative), LANDMARKS - len(top)), replace=False)
    return _fit_machine(train, y, weight, _subset(f, np.concatenate([top, other])))


def fit_texts(texts: list[str], labels: list[int], prior: float | None = None, seed: int = 7) -> Model:
    """A model from labelled texts; ``prior`` is the part of toxic documents where the sample does not keep it."""
    label = np.asarray(labels, np.int64)
    empty = Model(np.zeros(CLASSES**3, np.float32), 0.0, 1.0, -40.0)
    if not len(label) or label.min() == label.max():
        return empty
    words = fold(list(texts))
    f = units(words) if len(words.starts) else words
    if not len(f.starts):
        return empty
    hashes = _word_hash(f)
    # each unit once per document
    _, once = np.unique(np.stack([hashes, f.doc.astype(np.uint64)]), axis=1, return_index=True)
    f, hashes = _subset(f, np.sort(once)), hashes[np.sort(once)]
    rng = np.random.default_rng(seed)
    odds, seen = _document_shares(hashes, f.doc, label)
    toxic = label[f.doc] == 1
    able = np.flatnonzero(toxic & (f.lengths >= 3) & (odds >= MIN_ODDS))
    negatives = np.flatnonzero(~toxic & (f.lengths >= 3) & (odds < MIN_ODDS))
    _, distinct = np.unique(hashes[negatives], return_index=True)
    negatives = negatives[distinct]
    if not len(able) or not len(negatives):
        return empty
    fold_of = np.arange(len(label)) % 2

    def best(score: np.ndarray) -> np.ndarray:
        order = able[np.lexsort((-score[able], f.doc[able]))]
        _, first, counts = np.unique(f.doc[order], return_index=True, return_counts=True)
        rank = np.arange(len(order)) - np.repeat(first, counts)
        return order[rank < TOP_UNITS]

    def scored(table: np.ndarray, bias: float) -> np.ndarray:
        return _word_scores(f, table, bias)

    # triples tell what variants share; a unit's own odds count the more, the more toxic documents show it
    witness = best(_seed_scores(f, label) + np.log(odds) * seen / (seen + SHRINK))
    hard = [np.zeros(0, np.int64)] * 2
    out_of_fold = np.zeros(len(f.starts))
    top = np.full((len(label), TOP_UNITS), _LOW)
    for step in range(ROUNDS):
        for k in (0, 1):  # the machine of one fold's witnesses scores the other fold
            own = witness[fold_of[f.doc[witness]] != k]
            if not len(own):
                continue
            table, bias = _train(f, hashes, own, negatives, hard[k], rng)
            score = scored(table, bias)
            there = fold_of[f.doc] == k
            out_of_fold[there] = score[there]
            if step == ROUNDS - 1:
                top[fold_of == k] = _top_margins_in_pieces([t for t, own_fold in zip(texts, fold_of, strict=True) if own_fold == k], table, bias)
            ranked = negatives[np.argsort(-score[negatives], kind="stable")]
            hard[k] = np.unique(np.concatenate([hard[k], ranked[:2000]]))
        found = best(out_of_fold)
        kept = found[out_of_fold[found] > 0]
        if not len(kept):
            break
        witness = kept
    table, bias = _train(f, hashes, witness, negatives, np.union1d(*hard), rng)
    weight = np.ones(len(label))
    if prior:
        weight = np.where(label == 1, prior / label.mean(), (1 - prior) / (1 - label.mean()))
    curves = [(_log_loss(_mixed(top, b), label, weight, *curve), b, curve) for b in BREADTHS for curve in [_logistic(_mixed(top, b), label, weight)]]
    _, breadth, (slope, offset) = min(curves)
    return Model(table.astype(np.float32), bias, slope, offset, breadth)


def _top_margins_in_pieces(texts: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    weights = table.astype(np.float32)
    return np.concatenate([top_margins(texts[lo : lo + 100], weights, bias) for lo in range(0, len(texts), 100)])


def _log_loss(margins: np.ndarray, label: np.ndarray, weight: np.ndarray, slope: float, offset: float) -> float:
    z = np.clip(slope * margins + offset, -40, 40)
    return float((weight * np.logaddexp(0, np.where(label == 1, -z, z))).sum())


def _word_scores(f: Folded, weights: np.ndarray, bias: float) -> np.ndarray:
    """Scores of units that are words of their own, in pieces of bounded memory."""
    out = np.zeros(len(f.starts))
    for lo in range(0, len(f.starts), 200_000):
        part = _subset(f, np.arange(lo, min(len(f.starts), lo + 200_000)))
        total = np.zeros(len(part.chars), np.float32)
        for at, _, code, weight in _places(part):
            total[at] += weights[code].astype(np.float32) * np.float32(weight)
        out[lo : lo + 200_000] = np.add.reduceat(total, part.starts) / _norms(int(part.lengths.max()))[part.lengths] + bias
    return out


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", target: str = "toxic") -> Model:
    """Train on the rows of ``labels`` that have a text in ``docs``; bounded by the parameters above.

    The ids are drawn from the labels (twice as many as wanted, at most 4 * ``SAMPLE_DOCS`` rows
    on the driver), so what is joined with ``docs`` is small by construction and broadcast.
    """
    known = labels.where(F.col(target).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(target).cast("int")).alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return fit_texts([], [])
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("toxic")), F.lit(1 << 30))
    part = F.when(F.col("y") == 1, min(1.0, 2 * SAMPLE_DOCS / counts[1])).otherwise(min(1.0, 2 * SAMPLE_DOCS / counts[0]))
    drawn = known.where(draw < part * (1 << 30)).withColumn("draw", draw).sort("draw", "id").limit(6 * SAMPLE_DOCS).collect()
    if not drawn:
        return fit_texts([], [])
    spark = docs.sparkSession
    kind = labels.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).where("t is not null")

    def of(ids: list) -> DataFrame:
        few = spark.createDataFrame([(i,) for i in ids], T.StructType([T.StructField("id", kind)]))
        return rows.join(F.broadcast(few), "id")

    lengths = {r.id: r.n for r in of([r.id for r in drawn]).groupBy("id").agg(F.min(F.length("t")).alias("n")).collect()}
    taken: dict = {}
    used = {0: [0, 0], 1: [0, 0]}
    for r in drawn:  # in draw order, up to the bounds of each label
        if r.id in lengths and used[r.y][0] < SAMPLE_DOCS and used[r.y][1] < SAMPLE_CHARS:
            taken[r.id] = r.y
            used[r.y][0] += 1
            used[r.y][1] += lengths[r.id]
    if not taken:
        return fit_texts([], [])
    texts = of(list(taken)).groupBy("id").agg(F.min(F.struct(F.length("t").alias("n"), "t")).alias("m")).select("id", "m.t").collect()
    texts.sort(key=lambda r: r.id)
    return fit_texts([r.t for r in texts], [taken[r.id] for r in texts], counts[1] / (counts[0] + counts[1]))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with score and predicted."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("score", "predicted")])
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = batch.column(names.index(text)).to_pylist()
            out: list[float] = []
            lo = 0
            while lo < len(texts):  # pieces of bounded characters
                hi, held = lo, 0
                while hi < len(texts) and (held < 400_000 or hi == lo):
                    held += len(texts[hi] or "")
                    hi += 1
                out += m.probabilities(document_margins(texts[lo:hi], m.weights, m.bias, m.breadth)).tolist()
                lo = hi
            predicted = [int(p >= 0.5) for p in out]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64()), pa.array(predicted, pa.int32())], names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
