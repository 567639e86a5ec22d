"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

The kernel compares two words by the three and four letters they share as subsequences:
these may have gaps, and each letter they span costs a factor. So an insult with
inserted, missing or doubled letters stays close to the plain one. Landmarks are words
of the labelled sample; kernel values with them, whitened, are the features of a
linear machine. As those features are linear in the subsequences, the trained machine folds
into one weight per subsequence, and a word is scored without visiting the landmarks.

Labels belong to documents, which are read as bags of runs of letters: words, words spelled
letter by letter, and the letters of two neighbouring short words across the blank. A
document is as toxic as its worst runs: all runs of a clean document are clean, in a toxic
one the worst is toxic. The worst are found anew by the machine and learned again. Toxic
words are also learned with a letter put in between, so the machine's threshold lies below such
forms, and a word costs as much as it has documents, so what also stands in clean text scores low.
A document's score weighs its three worst distinct runs; a run that scores higher than
those of nearly all clean documents decides alone.
"""

from __future__ import annotations

import heapq
import math
import random
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.samples import labelled_sample, labelled_share, remainder
from gleaner.llm.text import bounded_batches, column, id_as_text, id_type
from gleaner.session import store

PARTS, HELD = 5, 0
#: Bounds of the model: labelled documents per class, words to learn from, landmarks.
PER_CLASS = 2_000
TOXIC_WORDS = 600
CLEAN_WORDS = 3_000
LANDMARKS = 192
#: A word can only tell if it occurs in this share of the toxic documents, and in two.
LEAST_SHARE = 0.01
#: A word is toxic if its share of the toxic documents is at least so many times that of the clean ones.
TELLING = 20
#: Factor per spanned letter; a subsequence spans at most five. Offsets of the second and further letters.
DECAY = 0.6
SPANS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4), (1, 2, 3), (1, 2, 4), (1, 3, 4), (2, 3, 4))
PAD = 4
#: Longer words are scored in overlapping pieces, so an insult inside isn't diluted.
PIECE, STEP = 14, 7
#: Two neighbouring words of so many letters at most, together and each, are also read as one.
JOINED, HALF = 9, 5
#: Forms with an inserted letter that are learned of each toxic word.
FORMS = 4
#: Of the clean documents so many may have a run that decides alone; how fast certainty grows from there.
CLEAN_RATE = 0.004
CERTAINTY = 6.0
#: Runs at this score are also looked at without each of their letters, and score so much less then.
SUSPECT = 0.6
PUT_IN = 0.1
#: Score of a run that isn't there, and the least that counts.
NOTHING = -1.0
ROUNDS = 2
WORDS_HELD = 600_000

_LETTERS = 32
#: Triples have a place each, four letters share as many places by a hash.
PLACES = 2 * _LETTERS**3
START, END = "\x01", "\x02"
TOP = 3
_MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_"
#: Three and more single characters in a row are read as one word.
_SPELLED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")


def _codes() -> np.ndarray:
    """Code points to 1-31: a-z apart, other letters in three groups, both ends of a word; 0 for the rest."""
    table = np.zeros(0x3000, dtype=np.uint16)
    for cp in range(128, len(table)):
        if chr(cp).isalpha():
            table[cp] = 27 + cp % 3
    table[97:123] = np.arange(1, 27)
    table[[ord(START), ord(END)]] = 30, 31
    return table


def words_of(text: str | None) -> set[str]:
    """Distinct words in small letters; characters spelled one by one are also joined."""
    low = (text or "").lower()
    found = {w.strip(_MARKS) for w in low.split()}.union("".join(m.split()) for m in _SPELLED.findall(low))
    found.discard("")
    return found


def runs_of(text: str | None) -> set[str]:
    """The words, and the letters of two neighbouring short words across the blank (``mo ron``)."""
    low = (text or "").lower()
    words = [w.strip(_MARKS) for w in low.split()]
    sizes = [len(w) for w in words]
    found = set(words).union("".join(m.split()) for m in _SPELLED.findall(low))
    found.update(
        a + b for a, b, m, n in zip(words, words[1:], sizes, sizes[1:]) if 1 < m <= HALF and 1 < n <= HALF and m + n <= JOINED
    )
    found.discard("")
    return found


def _flat(words: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(codes, owner, lengths)`` of the letters of all words, PAD zeros after each; words carry the marks of their ends."""
    joined = (("\0" * PAD).join(words) + "\0" * PAD).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(joined, dtype=np.uint32)
    codes = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 27 + points % 3).astype(np.int64)
    gap = points == 0
    owner = np.cumsum(gap) // PAD
    keep = gap | (codes > 0)
    codes, owner, letter = np.where(gap, 0, codes)[keep], owner[keep], ~gap[keep]
    return codes, owner, np.bincount(owner[letter], minlength=len(words))[: len(words)]


def _scale(lengths: np.ndarray) -> np.ndarray:
    """Normaliser of a word: the root of its own subsequences' squared weights."""
    total = np.zeros(len(lengths))
    for span in SPANS:
        total += np.maximum(lengths - span[-1], 0) * DECAY ** (2 * span[-1])
    return np.sqrt(np.maximum(total, DECAY**4))


def _subsequences(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per span: places of the subsequences at each start, whether all are letters, and the weight."""
    padded = np.concatenate([codes, np.zeros(PAD, dtype=np.int64)])
    n = len(codes)
    for span in SPANS:
        place, whole = codes, codes > 0
        for at in span:
            letter = padded[at : n + at]
            place, whole = place * _LETTERS + letter, whole & (letter > 0)
        if len(span) == 3:
            place = _LETTERS**3 + ((place * 0x9E3779B1) >> 13) % _LETTERS**3
        yield place, whole, DECAY ** span[-1]


def features(words: list[str], table: np.ndarray) -> np.ndarray:
    """The kernel's feature vectors, normalised; for the bounded lists of the training only."""
    codes, owner, lengths = _flat([START + w + END for w in words], table)
    out = np.zeros((len(words), PLACES), dtype=np.float32)
    for number, whole, weight in _subsequences(codes):
        np.add.at(out, (owner[whole], number[whole]), weight)
    return out / _scale(lengths)[:, None].astype(np.float32)


def pieces(words: list[str], table: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Words with their ends marked, long ones cut to overlapping pieces, and the word each piece is of.

    What isn't a letter is dropped before a word is cut, so marks between letters don't part them.
    """
    words = [START + w + END for w in words]
    if all(len(w) <= PIECE for w in words):
        return words, np.arange(len(words))
    words = [w if len(w) <= PIECE else "".join(c for c in w if ord(c) >= len(table) or table[ord(c)]) for w in words]
    out, owner = [], []
    for i, w in enumerate(words):
        parts = [w] if len(w) <= PIECE else [w[a : a + PIECE] for a in range(0, len(w) - STEP, STEP)]
        out += parts
        owner += [i] * len(parts)
    return out, np.array(owner)


@dataclass
class Machine:
    """One weight per subsequence, a bias, and what turns a document's worst scores into a probability."""

    weights: np.ndarray
    bias: float
    slopes: tuple[float, ...] = (1.0, 0.0, 0.0)
    offset: float = 0.0
    #: A worst run at this score makes a document toxic by itself.
    certain: float = math.inf

    def parts(self) -> tuple:
        """Plain values to broadcast: executors need not know this package."""
        return self.weights, self.bias, tuple(map(float, self.slopes)), self.offset, self.certain

    def of_words(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """Scores of runs. A suspect one is as toxic as it would be without one of its letters, which may be put in."""
        best = self._of_words(words, table)
        suspects = [i for i in np.flatnonzero(best > SUSPECT).tolist() if 4 < len(words[i]) <= PIECE]
        forms = [(i, words[i][:a] + words[i][a + 1 :]) for i in suspects for a in range(len(words[i]))]
        for start in range(0, len(forms), 50_000):
            some = forms[start : start + 50_000]
            np.maximum.at(best, np.array([i for i, _ in some]), self._of_words([f for _, f in some], table) - PUT_IN)
        return best

    def _of_words(self, words: list[str], table: np.ndarray) -> np.ndarray:
        parts, owner = pieces(words, table)
        codes, part, lengths = _flat(parts, table)
        sums = np.zeros(len(codes))
        for number, whole, weight in _subsequences(codes):
            sums += np.where(whole, self.weights[number], 0) * weight
        value = np.bincount(part, weights=sums, minlength=len(parts))[: len(parts)] / _scale(lengths) + self.bias
        best = np.full(len(words), -np.inf)
        np.maximum.at(best, owner, value)
        return best

    def scorer(self) -> Callable[[str | None], tuple[list[float], str]]:
        """The TOP worst scores of a text and its worst run; remembers the runs it has seen, up to a bound."""
        table, known = _codes(), {}

        def score(text: str | None) -> tuple[float, str]:
            words = runs_of(text)
            if not words:
                return [NOTHING] * TOP, ""
            fresh = words.difference(known)
            if fresh:
                if len(known) > WORDS_HELD:
                    known.clear()
                    fresh = words
                some = list(fresh)
                for start in range(0, len(some), 50_000):
                    part = some[start : start + 50_000]
                    known.update(zip(part, self.of_words(part, table).tolist()))
            worst = heapq.nlargest(TOP, [(known[w], w) for w in words])
            return [*(max(value, NOTHING) for value, _ in worst), *[NOTHING] * (TOP - len(worst))], worst[0][1]

        return score

    def probability(self, scores: np.ndarray) -> np.ndarray:
        together = scores @ np.array(self.slopes) + self.offset
        if self.certain < math.inf:
            together = np.maximum(together, CERTAINTY * (scores.max(axis=1) - self.certain))
        return 1 / (1 + np.exp(-np.clip(together, -500, 500)))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, passes: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by dual coordinate descent; the bias is a constant feature."""
    z = np.hstack([x, np.ones((len(x), 1))])
    alpha, w = np.zeros(len(z)), np.zeros(z.shape[1])
    own = (z * z).sum(axis=1) + 0.5 / cost
    order = np.random.default_rng(5)
    for _ in range(passes):
        change = 0.0
        for i in order.permutation(len(z)):
            g = y[i] * (z[i] @ w) - 1 + alpha[i] * 0.5 / cost[i]
            new = max(alpha[i] - g / own[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * z[i]
                change = max(change, abs(new - alpha[i]))
                alpha[i] = new
        if change < 1e-3:
            break
    return w[:-1], float(w[-1])


def gapped(words: list[str]) -> list[str]:
    """Each word with one letter put in between, at places and of letters that its checksum chooses."""
    out = []
    for w in words:
        r = random.Random(zlib.crc32(w.encode()))
        for _ in range(FORMS if len(w) > 3 else 0):
            at = r.randrange(1, len(w))
            out.append(w[:at] + r.choice("abcdefghijklmnopqrstuvwxyz" + w[at]) + w[at:])
    return sorted(set(out).difference(words))


def landmark_machine(
    toxic: list[str], clean: list[str], quoted: dict[str, float] | None = None, documents: dict[str, int] | None = None
) -> tuple[list[str], np.ndarray, float]:
    """``(landmarks, weight of each, bias)``: a word's score is the weighted sum of its kernel values with them.

    Landmarks are from both classes; the machine is linear in their whitened kernel values. Toxic words
    are learned with their :func:`gapped` forms. ``quoted`` words are toxic ones that also stand in clean
    documents, with the weight of those: further clean examples of less cost. ``documents`` are the number of
    toxic documents of each toxic word; a word costs by their root.
    """
    table, quoted, documents = _codes(), quoted or {}, documents or {}
    forms = [(f, w) for w in toxic for f in gapped([w])]
    weight = np.sqrt([*(documents.get(w, 1) for w in toxic), *(documents.get(w, 1) for _, w in forms)])
    words = [*toxic, *(f for f, _ in forms), *clean, *quoted]
    y = np.array([1.0] * (len(toxic) + len(forms)) + [-1.0] * (len(clean) + len(quoted)))
    marks = toxic[: LANDMARKS * 2 // 3] + clean[: LANDMARKS - min(len(toxic), LANDMARKS * 2 // 3)]
    phi_m = features(marks, table)
    values, vectors = np.linalg.eigh((phi_m @ phi_m.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    white = vectors[:, keep] / np.sqrt(values[keep])
    kernel = np.vstack([features(words[a : a + 250], table) @ phi_m.T for a in range(0, len(words), 250)])
    cost = np.where(y > 0, len(y) / (2 * max(1, len(toxic) + len(forms))), len(y) / (2 * max(1, len(clean))))
    cost[y > 0] *= weight / max(1e-9, weight.mean())
    if quoted:
        cost[-len(quoted) :] = cost[: len(toxic)].mean() * np.array(list(quoted.values()))
    # A word like none of the landmarks is clean: an example without features, which sets the bias.
    x = np.vstack([kernel @ white, np.zeros((1, white.shape[1]))])
    w, bias = _svm(x, np.append(y, -1.0), np.append(cost, cost[y < 0].sum()))
    return marks, white @ w, bias


def _train(toxic: list[str], clean: list[str], quoted: dict[str, float] | None = None, documents: dict[str, int] | None = None) -> Machine:
    """The machine with its landmarks folded into one weight per subsequence."""
    marks, beta, bias = landmark_machine(toxic, clean, quoted, documents)
    return Machine((features(marks, _codes()).T @ beta).astype(np.float64), bias)


def _calibrated(machine: Machine, scores: np.ndarray, toxic: np.ndarray, share: float) -> Machine:
    """Platt's sigmoid on the documents' worst scores; ``share`` of all labelled documents are toxic.

    Slopes are not negative: a further insult makes nothing less toxic.
    """
    if not len(scores) or toxic.all() or not toxic.any():
        return machine
    n1, n0 = toxic.sum(), (~toxic).sum()
    goal = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, share / n1, (1 - share) / n0)
    middle, spread = scores.mean(axis=0), np.maximum(scores.std(axis=0), 1e-6)
    used = list(range(TOP))
    while True:
        x = np.hstack([((scores - middle) / spread)[:, used], np.ones((len(scores), 1))])
        b = _logistic_fit(x, goal, weight)
        if (b[:-1] >= 0).all() or len(used) == 1:
            break
        used.remove(used[int(np.argmin(b[:-1]))])
    slopes = np.zeros(TOP)
    slopes[used] = b[:-1] / spread[used]
    clean = np.sort(scores[~toxic, 0])
    certain = float(clean[max(0, math.ceil((1 - CLEAN_RATE) * len(clean)) - 1)])
    return Machine(machine.weights, machine.bias, tuple(slopes), float(b[-1] - slopes @ middle), max(certain, 0.0) + 0.05)


def _logistic_fit(x: np.ndarray, goal: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's steps; the last column is the constant."""
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] * (x.shape[1] - 1) + [1e-9])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -50, 50)))
        gradient = x.T @ (weight * (p - goal)) + ridge @ b
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 5 / max(1e-12, np.abs(step).max()))
        b = b - step
        if np.abs(step).max() < 1e-9:
            break
    return b


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS,
    toxic_words: int = TOXIC_WORDS, clean_words: int = CLEAN_WORDS,
) -> Machine:
    """The machine learned from at most ``2 * per_class`` labelled documents.

    Of the words that tell, the ``toxic_words`` that tell most are learned, with ``clean_words`` clean ones: bounds
    of the machine's training set, as ``per_class`` is. Words are counted by the executors, by class of their
    documents; the driver gets these lists and one worst run per sampled document.
    """
    bounded_batches(docs.sparkSession)
    sample = store(labelled_sample(docs, labels, label, PARTS, HELD, per_class, id_col, text_col), "sample")
    # Copies would make each of their words look telling.
    sample = store(sample.withColumn("h", F.md5("text")).dropDuplicates(["h", "label"]).drop("h"), "sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    never = Machine(np.zeros(PLACES), -1.0)
    if not sizes.get(1) or not sizes.get(0):
        return never

    def plain(word: str) -> str:
        return "".join(filter(str.isalpha, word))

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for text, value in zip(frame["text"], frame["label"]):
                found = {plain(w) for w in words_of(text)}
                found = [w for w in found if len(w) >= 3]
                yield pd.DataFrame({"word": pd.Series(found, dtype=object), "label": [value] * len(found)})

    counts = store(
        sample.select("text", "label").mapInPandas(listed, "word string, label int").groupBy("word")
        .agg(F.count_if(F.col("label") == 1).alias("t"), F.count_if(F.col("label") == 0).alias("c")),
        "words",
    )
    share = sizes[1] / sizes[0]
    excess = F.col("t") - F.col("c") * share
    least = max(2, math.ceil(LEAST_SHARE * sizes[1]))
    telling = counts.filter((F.col("t") >= least) & (F.col("t") >= TELLING * share * F.col("c")))
    told_most = telling.orderBy((excess * excess / (F.col("t") + F.col("c") * share)).desc(), "word").limit(toxic_words).collect()
    toxic = [r["word"] for r in told_most]
    documents = {r["word"]: r["t"] for r in told_most}
    ordinary = counts.filter((F.col("c") > 0) & (F.col("t") < 3 * share * F.col("c") + 1))
    common = ordinary.orderBy(F.desc("c"), "word").limit(clean_words // 3).select("word")
    other = ordinary.orderBy(F.xxhash64("word"), "word").limit(clean_words - clean_words // 3).select("word")
    clean = [r["word"] for r in other.unionByName(common).distinct().orderBy(F.xxhash64("word"), "word").collect()]
    if not toxic or not clean:
        return never
    quoted: dict[str, float] = {r["word"]: share * r["c"] / (r["t"] + share * r["c"]) for r in told_most if r["c"]}
    for turn in range(ROUNDS + 1):
        machine = _train(toxic, clean, quoted, documents)
        sent = sample.sparkSession.sparkContext.broadcast(machine.parts())

        def worst(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            score = Machine(*sent.value).scorer()
            for frame in frames:
                found = [score(t) for t in frame["text"]]
                yield frame[["doc_id", "label"]].assign(scores=[f[0] for f in found], word=pd.Series([f[1] for f in found], dtype=object, index=frame.index))

        kind = sample.schema["doc_id"].dataType.simpleString()
        seen = sample.mapInPandas(worst, f"doc_id {kind}, label int, scores array<double>, word string").toPandas().sort_values("doc_id")
        scores = np.array(seen["scores"].tolist(), dtype=np.float64).reshape(len(seen), TOP)
        if turn == ROUNDS:
            return _calibrated(machine, scores, seen["label"].to_numpy() == 1, labelled_share(labels, label, PARTS, HELD))
        seen = seen.assign(score=scores[:, 0])
        hard = seen[(seen["label"] == 0) & (seen["score"] > -1) & (seen["word"] != "")]["word"].value_counts()
        found = seen[(seen["label"] == 1) & (seen["score"] > 0)]["word"].value_counts()
        # The worst words of clean documents are clean however they look, unless their share of
        # the toxic documents is far greater: some labels are wrong, and some documents quote.
        asked = sorted({plain(w) for w in [*hard.index, *found.index]})
        seen_in = {r["word"]: (r["t"], r["c"]) for r in counts.filter(F.col("word").isin(asked)).collect()}

        def rates(word: str) -> tuple[float, float]:
            t, c = seen_in.get(plain(word), (0, 0))
            return max(t, int(found.get(word, 0))), share * max(c, int(hard.get(word, 0)))

        told = {w: rates(w) for w in sorted({*hard.index, *found.index})}
        moved = {w for w in hard.index if told[w][0] < max(least, TELLING * told[w][1])}
        quoted |= {w: told[w][1] / (told[w][0] + told[w][1]) for w in sorted(set(hard.index) - moved)}
        clean = list(dict.fromkeys([*clean, *sorted(moved)]))
        more = sorted(w for w in found.index if found[w] >= least and told[w][0] >= TELLING * told[w][1])
        toxic = list(dict.fromkeys(w for w in [*toxic, *more] if w not in set(clean)))
        if not toxic:
            return never
    raise AssertionError


def toxicity_rows(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS,
    toxic_words: int = TOXIC_WORDS, clean_words: int = CLEAN_WORDS,
) -> DataFrame:
    """One narrow row per document: ``doc_id, held_out, score, predicted, worst_word``.

    ``held_out`` rows (CRC-32 of the id modulo 5 is 0) are never learned from. A null or
    empty text has no word and scores as a word without letters does. A null id isn't
    held out. Without labels of both classes nothing is toxic. Repeated rows score
    alike; an empty table gives an empty table; further columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, label, id_col, text_col, per_class, toxic_words, clean_words).parts())

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = Machine(*sent.value)
        score = machine.scorer()
        for frame in frames:
            found = [score(t) for t in frame["text"]]
            chance = machine.probability(np.array([f[0] for f in found], dtype=np.float64).reshape(len(found), TOP))
            yield frame[["doc_id"]].assign(score=chance, worst_word=pd.Series([f[1] for f in found], dtype=object, index=frame.index))

    narrow = docs.select(id_as_text(id_col), column(text_col).alias("text"))
    return narrow.mapInPandas(scored, "doc_id string, score double, worst_word string").select(
        F.col("doc_id").cast(id_type(docs, id_col)).alias("doc_id"),
        F.coalesce(remainder(F.col("doc_id"), PARTS) == HELD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "worst_word",
    )
