"""Abusive, hateful or sexual language: a classifier chain over sentences.

Texts are split into sentences, disguises are undone, and each sentence is a
bag of hashed word n-grams; listed words also stand for their class, as one
feature among the others. The chain predicts categories one after the other;
each linear model sees the probabilities of the earlier ones, which in training
come from folds that the example was not in. What a category is comes from the
reviewed sentences: a mixture over their words, in which only the authored
sentences of :mod:`seeds` have a fixed category. A document's score is that of
its worst sentence.
"""

from __future__ import annotations

import math
import pickle
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomtab.llm import seeds
from loomtab.session import cut_lineage

#: The chain's links in order; the last one is the verdict itself.
CATEGORIES = ("sexual", "threat", "demeaning", "insult")
LINKS = (*CATEGORIES, "unfit")

#: Cue words, a feature of the model and no target of it, in English, German, French and Spanish (fixed values, without accents; plurals are cut by rule).
CUES = {
    "sexual": "sex sexy horny nude naked tits boobs busty dildo anal blowjob cum cock dick pussy porn orgasm moaned moaning moan fuck fucking "
    "masturbate erotic swallow thighs strip stripped nackt geil ficken titten bumsen nue baiser cul salope bite nichons "
    "desnuda cama follar caliente coger tetas polla lick licked licking suck sucked screwing",
    "threat": "kill bleed choke murder beat beaten strangle stab shoot punch hurt die dead breathing bones fingers funeral sleep "
    "umbringen tote wohnst schlaf tuer mourir crever habites dors matar mato vives duerme morir",
    "demeaning": "vermin subhuman filth cockroach cockroache lice rat infest breed cage sterilised exterminate wiped poison crawled cattle "
    "animals deport gas breathe thieves parasite cripple ungeziefer abschaum ratten verjagt verjagen vermine racaille chasser jeter "
    "basura ratas alimana echarlos escoria tirar human",
    "insult": "halfwit slimy lazy idiot imbecile moron cretin stupid dumbass bastard loser clown pig scumbag braindead brainless worthless useless pathetic "
    "disgusting dumb asshole bitch fool trash piss puke retard twit jerk shit dimwit miserable filthy coward doorknob "
    "vollidiot trottel arschloch versager dumm damlich klappe idiotin depp cretin connard abruti minable gueule pauvre debile "
    "imbecil inutil cretino estupido gilipollas asco callate tonto pendejo",
}
#: Words for the one spoken to, and for the speaker: who is meant decides (fixed values).
YOU = "you your yours yourself u ur du dich dir dein deine tu toi ton ta te vous eres tu ti usted das"
ME = "i me my mine myself ich mir mich mein meine je moi mon ma yo mi mio mia"

#: Letters of other scripts that look like Latin ones (fixed values).
_LOOKALIKES = str.maketrans("аеорсухіјѕԁӏвнкмтαεορυικνχ", "aeopcyxijsdlbhkmtaeopuikvx")
_LEET = str.maketrans("0134578@$!+|", "oieastbasitl")
#: Ends of sentences: marks, lines, tags, emoji, and chat fillers.
_SENTENCE = re.compile(r"(?:[.!?…]+[\"'»”)\]]*(?=\s|$|<))|[\r\n]+|<[^<>]{1,40}>|[;](?=\s)|[\U0001F000-\U0001FAFF☀-➿️]+|\b(?:lol|lmao|rofl|haha)\b")
_MOJIBAKE = re.compile("[Â-ô][\u0080-¿]{1,3}")
_SPACED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:([.\-_|*·~/])[^\W\d_](?:\1)?){2,}(?![^\W\d_])|(?<![^\W\d_])(?:[^\W\d_] ){3,}[^\W\d_](?![^\W\d_])")
_TOKEN = re.compile(r"[^\W_][\w@$*!|’']*[\w@$*]|[^\W_]")
_MARKS = regex.compile(r"[\p{Mn}\p{Cf}]+")
_DOUBLE = re.compile(r"(.)\1+")

HASH_BITS = 18
_MASK = (1 << HASH_BITS) - 1


def _single(word: str) -> str:
    """One of each run of equal letters, so that stretched words fall together."""
    return _DOUBLE.sub(r"\1", word)


def _stem(word: str) -> str:
    return word[:-1] if len(word) > 3 and word.endswith("s") else word


_CLASS: dict[str, str] = {_stem(_single(w)): c for c, ws in reversed(CUES.items()) for w in ws.split()}
_WHO = {_single(w): "<you>" for w in YOU.split()} | {_single(w): "<me>" for w in ME.split()}
_BY_SHAPE: dict[tuple[str, int, str], str] = {}
for _c, _ws in CUES.items():
    for _w in _ws.split():
        for _v in (_w, _w + "s"):
            _BY_SHAPE.setdefault((_v[0], len(_v), _v[-1]), _c)


def _repair(m: re.Match) -> str:
    try:
        return m.group().encode("latin-1").decode("utf-8")
    except UnicodeError:
        return m.group()


def undisguise(text: str) -> str:
    """Lower case plain letters: broken encodings, look-alikes, invisible signs and spaced letters undone."""
    if not text.isascii():
        text = _MOJIBAKE.sub(_repair, text)
        text = unicodedata.normalize("NFKD", text)
        text = _MARKS.sub("", text)
    text = text.lower()
    if not text.isascii():
        text = " ".join(w.translate(_LOOKALIKES) if not w.isascii() and re.search("[a-z]", w) else w for w in text.split(" "))
    return _SPACED.sub(lambda m: re.sub(r"[^\w]|_", "", m.group()), text)


def sentences(text: str) -> list[str]:
    return [s for s in (p.strip() for p in _SENTENCE.split(undisguise(text))) if s]


#: Longer sentences are looked at in overlapping windows, so that what lost its full stop isn't diluted.
WINDOW, STRIDE = 18, 9


def windows(tokens: list[str]) -> list[list[str]]:
    if len(tokens) <= WINDOW + STRIDE // 2:
        return [tokens]
    return [tokens[i : i + WINDOW] for i in range(0, len(tokens) - STRIDE, STRIDE)]


def segments(text: str) -> list[list[str]]:
    """The tokenised sentences of a text, long ones in windows; those without words are left out."""
    return [w for s in sentences(text) if (ws := words(s)) for w in windows(ws)]


def _cased(texts: Iterable[str]) -> dict[str, list[int]]:
    """How often each word is written small and with a capital, not counting first words and whole capitals."""
    seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    inner = re.compile(r"(?:(?<=[^\W\d_] )|(?<=[^\W\d_], ))([^\W\d_])([^\W\d_]+)")
    for t in texts:
        for head, tail in inner.findall(unicodedata.normalize("NFKC", t)):
            if tail.islower():
                seen[_bare(head.lower() + tail)][head.isupper()] += 1
    return seen


@lru_cache(1 << 17)
def _bare(word: str) -> str:
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word).lower() if not unicodedata.combining(c))
    return _single(word)


@lru_cache(1 << 17)
def _word(t: str) -> tuple[str, ...]:
    """What one token stands for: a class and its stem, a person, a number, a code, or a plain word."""
    t = t.strip("'’!|")
    if not t:
        return ()
    if t.isdigit():
        return ("<n>",)
    if t.isalpha():
        w = _single(t)
    elif "*" in t:
        kind = _BY_SHAPE.get((t[0], len(t), t[-1]))
        return (f"<{kind}>" if kind else "<masked>",)
    else:
        plain = t.replace("'", "").replace("’", "")
        bare = plain.replace("|", "")
        w = _single(bare if bare.isalpha() else plain.translate(_LEET))
        if w not in _WHO and _stem(w) not in _CLASS and any(c.isdigit() for c in plain):
            return ("<code>",)
    stem = _stem(w)
    if w in _WHO:
        return (_WHO[w],)
    return (f"<{_CLASS[stem]}>", stem) if stem in _CLASS else (w,)


def words(sentence: str) -> list[str]:
    """Tokens: classes for cue words and persons, else plain words; numbers are one token."""
    return [w for t in _TOKEN.findall(sentence) for w in _word(t)]


def signature(tokens: Iterable[str], vocabulary: frozenset[str] | set[str]) -> tuple[str, ...]:
    """Tokens with rare words as one; equal signatures are equal examples."""
    out: list[str] = []
    for t in tokens:
        t = t if t[0] == "<" or t in vocabulary else "<rare>"
        if not (t == "<rare>" and out and out[-1] == "<rare>"):
            out.append(t)
    return tuple(out)


def features(sig: tuple[str, ...]) -> np.ndarray:
    """Hashed word 1- to 3-grams, pairs with a gap, and pairs of classes anywhere in the sentence."""
    ts = ("<s>", *sig, "</s>")
    grams = set(ts)
    grams.update(map("\t".join, zip(ts, ts[1:])))
    grams.update(map("\t".join, zip(ts, ts[1:], ts[2:])))
    grams.update(map("\t_\t".join, zip(ts, ts[2:])))
    kinds = sorted({t for t in sig if t[0] == "<" and t not in ("<n>", "<rare>", "<code>")})
    grams.update(f"{a}&{b}" for i, a in enumerate(kinds) for b in kinds[i + 1 :])
    return np.array(sorted({zlib.crc32(g.encode()) & _MASK for g in grams}), np.int32)


@dataclass
class Linear:
    """A logistic model over hashed features and the earlier links' probabilities."""

    weights: np.ndarray
    chained: np.ndarray
    bias: float


class Examples:
    """Sparse rows of hashed features in one flat array."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1])) if rows else np.zeros(0, np.int64)
        self.scale = 1.0 / np.sqrt(np.maximum(self.sizes, 1))

    def fit(self, y: np.ndarray, weight: np.ndarray, earlier: np.ndarray, steps: int = 90, l2: float = 3e-4, rate: float = 0.35) -> Linear:
        """Full-batch Adam with a fixed number of steps: deterministic, no random order."""
        dim, k = 1 << HASH_BITS, earlier.shape[1]
        used, inverse = np.unique(self.flat, return_inverse=True)
        w, v, b = np.zeros(len(used)), np.zeros(k), 0.0
        m1, m2 = np.zeros(len(used) + k + 1), np.zeros(len(used) + k + 1)
        total = max(weight.sum(), 1e-9)
        for t in range(1, steps + 1):
            z = np.add.reduceat(w[inverse], self.starts) * self.scale + earlier @ v + b
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
            g = weight * (p - y) / total
            gw = np.bincount(inverse, np.repeat(g * self.scale, self.sizes), len(used)) + l2 * w / 10
            grad = np.concatenate((gw, earlier.T @ g + l2 * v, [g.sum()]))
            m1 = 0.9 * m1 + 0.1 * grad
            m2 = 0.99 * m2 + 0.01 * grad * grad
            move = rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
            w, v, b = w - move[: len(used)], v - move[len(used) : len(used) + k], b - move[-1]
        full = np.zeros(dim, np.float32)
        full[used] = w
        return Linear(full, v, float(b))

    def scores(self, model: Linear, earlier: np.ndarray) -> np.ndarray:
        if not len(self.sizes):
            return np.zeros(0)
        z = np.add.reduceat(model.weights[self.flat], self.starts) * self.scale + earlier @ model.chained + model.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Chain:
    """The trained links; sentences of one signature are scored once."""

    def __init__(self, vocabulary: frozenset[str], links: list[Linear]) -> None:
        self.vocabulary, self.links = vocabulary, links
        self._table = np.column_stack([link.weights for link in links]).astype(np.float32)
        self._chained = [link.chained.tolist() for link in links]
        self._memo: dict[tuple[str, ...], tuple[float, ...]] = {}

    def sentence(self, sig: tuple[str, ...]) -> tuple[float, ...]:
        found = self._memo.get(sig)
        if found is None:
            x = features(sig)
            sums = (self._table[x].sum(axis=0) / max(len(x), 1) ** 0.5).tolist()
            scores: list[float] = []
            for z, link, chained in zip(sums, self.links, self._chained):
                z += link.bias + sum(v * p for v, p in zip(chained, scores))
                scores.append(1.0 / (1.0 + math.exp(-min(max(z, -30.0), 30.0))))
            found = tuple(scores)
            if len(self._memo) > 200_000:
                self._memo.clear()
            self._memo[sig] = found
        return found

    def document(self, text: str | None) -> tuple[float, ...]:
        """The highest score of each link over all sentences; zeros for a text without words."""
        scores = [self.sentence(sig) for tokens in segments(text or "") if (sig := signature(tokens, self.vocabulary))]
        return tuple(map(max, zip(*scores))) if scores else (0.0,) * len(LINKS)

    def __getstate__(self) -> dict:
        return {"vocabulary": self.vocabulary, "links": self.links}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)


def learn_categories(sigs: list[tuple[str, ...]], weight: np.ndarray, named: dict[int, int], rounds: int = 8) -> np.ndarray:
    """The probability of each of :data:`CATEGORIES` for each sentence: a mixture of word distributions.

    ``weight`` says how far a sentence is unfit; ``named`` fixes the category of
    the authored ones. Each round (fixed in number) counts words by category and
    reads the sentences' categories from the counts. Only plain words count and
    the words for persons, no class of the cue words. A sentence without known
    words has all categories alike.
    """
    place: dict[str, int] = {}
    rows, cols = [], []
    for i, sig in enumerate(sigs):
        if weight[i] > 0 or i in named:
            for t in {t for t in sig if t[0] != "<" or t in ("<you>", "<me>")}:
                rows.append(i)
                cols.append(place.setdefault(t, len(place)))
    r, c, k, n = np.array(rows, np.int64), np.array(cols, np.int64), len(CATEGORIES), len(sigs)
    p = np.full((n, k), 1.0 / k)
    fixed = np.array(sorted(named), np.int64)
    kinds = np.array([named[i] for i in sorted(named)], np.int64)
    mass = np.maximum(weight, 0.0)
    mass[fixed] = np.maximum(mass[fixed], 1.0)
    for at in range(rounds + 1):
        p[fixed] = 0.0
        p[fixed, kinds] = 1.0
        held = mass if at else np.where(np.isin(np.arange(n), fixed), 1.0, 0.0)
        words_of = np.column_stack([np.bincount(c, (held[r] * p[r, j]), len(place)) for j in range(k)]) + 0.1
        logs = np.log(words_of / words_of.sum(axis=0)) + np.log((held @ p + 1.0) / (held.sum() + k)) / max(len(place), 1)
        z = np.column_stack([np.bincount(r, logs[c, j], n) for j in range(k)])
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
    p[fixed] = 0.0
    p[fixed, kinds] = 1.0
    return p


class Here:
    """Fits one after the other in this process."""

    def __init__(self, xs: list[np.ndarray]) -> None:
        self.xs = xs

    def fit(self, asked: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray, earlier: np.ndarray) -> list[tuple[Linear, np.ndarray]]:
        """For each (rows to learn from, rows held out): the model, and the scores of those held out."""
        return [self.one(train, held, y, weight, earlier) for train, held in asked]

    def one(self, train, held, y, weight, earlier) -> tuple[Linear, np.ndarray]:
        model = Examples([self.xs[i] for i in train]).fit(y[train], weight[train], earlier[train])
        return model, Examples([self.xs[i] for i in held]).scores(model, earlier[held])


class OnCluster(Here):
    """The folds and the whole of a link as tasks of one stage; the examples, a bounded sample, go out once."""

    def __init__(self, xs: list[np.ndarray], spark: SparkSession) -> None:
        super().__init__(xs)
        self.sc = spark.sparkContext
        self.held = self.sc.broadcast(xs)

    def fit(self, asked, y, weight, earlier):
        xs, sent = self.held, self.sc.broadcast((asked, y, weight, earlier))

        def run(i: int):
            (train, held), y, weight, earlier = sent.value[0][i], *sent.value[1:]
            model, scores = Here(xs.value).one(train, held, y, weight, earlier)
            used = np.flatnonzero(model.weights)
            return used.astype(np.int32), model.weights[used], model.chained, model.bias, scores

        out = []
        for used, values, chained, bias, scores in self.sc.parallelize(range(len(asked)), len(asked)).map(run).collect():
            full = np.zeros(1 << HASH_BITS, np.float32)
            full[used] = values
            out.append((Linear(full, chained, bias), scores))
        sent.destroy()
        return out


def prepare(text: str) -> tuple[list[list[str]], dict[str, list[int]]]:
    """What the fit needs of one text: its tokenised sentences and how its words are cased."""
    return segments(text), dict(_cased([text]))


def train_chain(labelled: Iterable[tuple[str, float]], folds: int = 3, least_docs: int = 2, unfit_weight: float = 4.0) -> Chain:
    """Fit the chain in this process on (text, share of reviewers who found it unfit); see :func:`train_prepared`."""
    return train_prepared([(prepare(t), y) for t, y in labelled if t and t.strip()], Here, folds, least_docs, unfit_weight)


def train_prepared(labelled: Iterable[tuple[tuple, float]], fitter, folds: int = 3, least_docs: int = 2, unfit_weight: float = 4.0) -> Chain:
    """Fit the chain on (prepared text, share of reviewers who found it unfit).

    Reviewers judge whole texts, so sentences start with their text's label;
    out-of-fold scores then pick the sentences that explain an unfit text, and
    the others of it count as fit. The picked sentences' categories come from
    :func:`learn_categories`. Half-and-half verdicts are left out. The
    vocabulary holds the words of at least ``least_docs`` texts that aren't
    mostly written as names.
    """
    docs = [(p, y) for p, y in labelled if y != 0.5]
    # the authored sentences count as texts of one sentence each, twice, so that their words are known
    authored = [(t, c) for c, ts in seeds.UNFIT.items() for t in ts]
    first = len(docs)
    docs += [(prepare(t), 1.0) for t, _ in authored] + [(prepare(t), 1.0) for t, _ in authored] + [(prepare(t), 0.0) for t in seeds.FIT for _ in range(2)]
    # and sentences of unknown words are fit unless something says otherwise
    docs += [(prepare(" ".join(f"zq{chr(97 + i)}{chr(97 + k)}v" for k in range(n)) + "."), 0.0) for i in range(8) for n in (1, 5, 12)]
    tokenised = [(ss, float(y > 0.5)) for (ss, _), y in docs]
    df: Counter[str] = Counter()
    cased: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for (ss, seen), _ in docs:
        df.update({w for ws in ss for w in ws})
        for w, (small, capital) in seen.items():
            cased[w][0] += small
            cased[w][1] += capital
    vocabulary = frozenset(w for w, n in df.items() if n >= least_docs and cased[w][1] <= 3 * cased[w][0])
    # one example per (signature, fold): the fold is the text's
    index: dict[tuple[tuple[str, ...], int], int] = {}
    members: list[list[int]] = []
    for ss, _ in tokenised:
        fold = zlib.crc32("\n".join(" ".join(ws) for ws in ss).encode()) % folds
        members.append([index.setdefault((signature(ws, vocabulary), fold), len(index)) for ws in ss])
    sigs = [s for s, _ in index]
    fold_of = np.array([f for _, f in index])
    fitted = fitter([features(s) for s in sigs])
    n = len(sigs)
    everything, nothing = np.arange(n), np.zeros(0, np.int64)
    parts = [(np.flatnonzero(fold_of != f), np.flatnonzero(fold_of == f)) for f in range(folds)]
    parts = [(rest, held) for rest, held in parts if len(rest) and len(held)]

    def tally(chosen: list[set[int]] | None) -> tuple[np.ndarray, np.ndarray]:
        pos, all_ = np.zeros(n), np.zeros(n)
        for d, (ids, (_, y)) in enumerate(zip(members, tokenised)):
            for i in set(ids):
                all_[i] += 1
                pos[i] += y if chosen is None else float(bool(y) and i in chosen[d])
        share = pos / np.maximum(all_, 1)
        return share, np.sqrt(all_) * (1 + (unfit_weight - 1) * share)

    def out_of_fold(results: list[tuple[Linear, np.ndarray]]) -> np.ndarray:
        scores = np.zeros(n)
        for (_, held), (_, p) in zip(parts, results):
            scores[held] = p
        return scores

    none = np.zeros((n, 0))
    y, weight = tally(None)
    for floor in (0.6, 0.6):
        p = out_of_fold(fitted.fit(parts, y, weight, none))
        chosen = []
        for ids, (_, label) in zip(members, tokenised):
            top = max((p[i] for i in ids), default=0.0)
            chosen.append({i for i in ids if p[i] >= 0.5 or (p[i] == top and top >= floor)} if label else set())
        y, weight = tally(chosen)

    named = {i: CATEGORIES.index(c) for d, (_, c) in enumerate(authored) for i in (*members[first + d], *members[first + len(authored) + d])}
    kinds = learn_categories(sigs, y, named)
    earlier, links = none, []
    for k, link in enumerate(LINKS):
        target = y if link == "unfit" else y * kinds[:, k]
        # the last link has no later one, so it needs no held-out scores
        whole, *rest = fitted.fit([(everything, nothing), *(parts if k < len(LINKS) - 1 else [])], target, weight, earlier)
        links.append(whole[0])
        if rest:
            earlier = np.column_stack((earlier, out_of_fold(rest)))
    return Chain(vocabulary, links)


#: Reviewed documents used for the fit, at most; which ones is decided by a hash of their id. The model needs no more.
MAX_LABELLED = 20_000
#: Characters of those documents, at most, taken in the same order; a document with over a hundredth of them is passed over.
MAX_CHARACTERS = 40_000_000
#: Score from which a document counts as unfit.
THRESHOLD = 0.5


def fit_on_labels(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_characters: int = MAX_CHARACTERS) -> Chain:
    """The chain of a bounded sample of the reviewed documents.

    The texts are read, parted and tokenised by Spark tasks; folds and links are
    fitted as tasks too, so the driver only counts. The sample is bounded in
    rows and in characters. NULL verdicts don't count; several verdicts on a
    document are averaged. Without verdicts the chain knows the authored
    sentences of :mod:`seeds` only.
    """
    spark = docs.sparkSession
    seen = labels.where("is_unfit IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("is_unfit").alias("share"))
    sample = seen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # the sample has at most max_labelled rows of two numbers, so the corpus is filtered by it without a shuffle
    texts = docs.where("text IS NOT NULL").select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")
    found = cut_lineage(texts.where(F.length("text") <= max_characters // 100))
    # one number for each of at most max_labelled documents
    sizes = found.groupBy("doc_id").agg(F.sum(F.length("text")).alias("size"))
    upto = F.sum("size").over(W.orderBy(F.xxhash64("doc_id"), "doc_id"))
    kept = found.join(F.broadcast(sizes.select("doc_id", upto.alias("upto")).where(F.col("upto") <= max_characters)), "doc_id").select("doc_id", "share", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ready = [pickle.dumps(prepare(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ready, pa.binary())], ["doc_id", "share", "ready"])

    kind = kept.schema["doc_id"].dataType.simpleString()
    spread = kept.repartition(spark.sparkContext.defaultParallelism)
    prepared = spread.mapInArrow(run, f"doc_id {kind}, share double, ready binary").orderBy("doc_id", F.xxhash64("ready")).collect()
    return train_prepared([(pickle.loads(r["ready"]), r["share"]) for r in prepared], lambda xs: OnCluster(xs, spark))


def score_documents(docs: DataFrame, chain: Chain, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, <keep>, <one score per link>`` of each document; all scores are 0 for NULL, empty and wordless texts.

    Whole texts are scored. Rows map one to one, without a shuffle; repeated
    documents repeat.
    """
    held = docs.sparkSession.sparkContext.broadcast(chain)  # a fixed number of weights per link

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            scores = [model.document(t.as_py()) for t in batch.column(batch.num_columns - 1)]
            table = np.array(scores).reshape(-1, len(LINKS))
            columns = [pa.array(table[:, i], pa.float64()) for i in range(len(LINKS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *LINKS])

    chosen = docs.select("doc_id", *keep, F.col("text").cast("string").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, f"{fields}, " + ", ".join(f"{k} double" for k in LINKS))
