"""Toxicity by a weighted finite-state grammar over clauses.

Three layers of transducers are composed.  The lexical one reads words and
writes classes: insult, threat, target, negation, reported speech, and learned
insults, by stems of words that labels show to be insulting in any language.  The scope
one reads a clause's classes from left to right and marks what stands under a
negation or in reported speech.  The pattern one reads the marked classes and
writes weighted clause patterns: an insult, an insult next to a target, a
threat with a target, and the same negated or reported.  A document's score is
a logistic function of its patterns, with weights learned from labels.

Words are matched by hash over whole texts; only clauses that hold an insult
or a threat are read word by word.
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

from . import textcore
from .learning import bounded_sample, fit_logistic, held_out, sigmoid

PER_LABEL = 2500  # labelled rows of each label in the fit
LEARNED_STEMS = 400  # most frequent word beginnings that the fit keeps: a bound of the model, not of the rows it scores
STEM_BYTES = (5, 8)  # length of a learned stem in UTF-8
MIN_ROWS = 5  # toxic rows that must have a learned stem,
MIN_SHARE = 0.012  # the share of toxic rows that must have it,
MIN_RATIO = 10.0  # and its share there over its share in other rows

# fixed values: the lexical transducer's own vocabulary
INSULTS = (
    "idiot idiots moron morons stupid dumb fool fools loser losers scum trash garbage pathetic worthless disgusting "
    "clown clowns jerk jerks imbecile bastard bastards vermin filth bitch asshole cretin dimwit"
).split()
THREATS = "kill hurt destroy strangle stab shoot murder crush beat burn".split()
TARGETS = (
    "you your yours yourself he him his she her they them their this that these those it its who all everyone "
    "people anybody nobody du sie ihr er vous tu il elle ils tú usted él ella ellos"
).split()
NEGATIONS = "not no never nor neither without isn't aren't don't won't nicht kein keine nie pas jamais ni nunca sin".split()
REPORTS = "said says say called calls claimed claims quoted quotes wrote writes told tells sagte dit dijo reported alleged".split()

INSULT, THREAT, TARGET, NEGATION, REPORT, STEM = 1, 2, 3, 4, 5, 6
NEGATION_SCOPE, REPORT_SCOPE, TARGET_REACH, THREAT_REACH = 3, 8, 4, 3  # words

#: outputs of the pattern transducer, and what they come to in a document
PATTERNS = (
    "insult", "insult_target", "insult_negated", "insult_reported", "threat_target", "threat_negated", "threat_reported",
    "learned", "learned_target", "learned_negated", "learned_reported", "distinct", "learned_pair", "learned_density",
)

# letters, digits, apostrophes and bytes beyond ASCII make words
SPACE = np.ones(256, dtype=bool)
SPACE[48:58] = SPACE[65:91] = SPACE[97:123] = SPACE[128:] = False
SPACE[39] = False
_BREAK = np.zeros(256, dtype=bool)  # bytes that end a clause
_BREAK[list(b".!?;\n\r")] = True  # a report reaches across a colon

#: punctuation beyond ASCII by the ASCII character that stands for it (fixed values)
PUNCTUATION = {"'": "\u2018\u2019\u02bc\uff07", ".": "\u2026\u3002\uff0e\uff61", "!": "\u00a1\uff01", "?": "\u00bf\uff1f", ";": "\uff1b", ":": "\uff1a",
               " ": "\u00ab\u00bb\u201a-\u201f\u2039\u203a\u2010-\u2015\u2022\u2024-\u2027\u3001\u3008-\u3011\uff08\uff09\uff0c\u00a0\u2000-\u200a\u202f\u3000"}


def plain_punctuation(texts: pa.Array) -> pa.Array:
    """Texts with punctuation and spaces beyond ASCII as ASCII."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not pc.any(pc.match_substring_regex(texts, "[" + "".join(PUNCTUATION.values()) + "]")).as_py():
        return texts
    for plain, others in PUNCTUATION.items():
        texts = pc.replace_substring_regex(texts, f"[{others}]", plain)
    return texts


#: heads of patterns: their name, and how far a target may be
HEADS = {INSULT: ("insult", TARGET_REACH), STEM: ("learned", TARGET_REACH), THREAT: ("threat", THREAT_REACH)}


def clause_patterns(classes: list[int]) -> Counter:
    """Patterns of one clause, from the classes of its words (0: none).

    The scope transducer's state is the number of words for which a negation
    and a report still hold; the pattern transducer's, the distance to the
    last target and the heads that wait for a target to follow.  Learned
    insults go through the same states as the given ones, with outputs of
    their own.
    """
    out: Counter = Counter()
    negated = reported = 0
    last_target = None
    waiting: list[tuple[int, int]] = []  # (position, class) of unscoped heads
    for at, kind in enumerate(classes):
        if kind == NEGATION:
            negated = NEGATION_SCOPE + 1
        elif kind == REPORT:
            reported = REPORT_SCOPE + 1
        elif kind == TARGET:
            last_target = at
            still = []
            for head, k in waiting:
                if at - head <= HEADS[k][1]:
                    out[HEADS[k][0] + "_target"] += 1
                else:
                    still.append((head, k))
            waiting = still
        elif kind in HEADS:
            name, reach = HEADS[kind]
            if negated:
                out[name + "_negated"] += 1
            elif reported:
                out[name + "_reported"] += 1
            else:
                if kind != THREAT:
                    out[name] += 1
                if kind != THREAT and last_target is not None and at - last_target <= reach:
                    out[name + "_target"] += 1
                else:  # a threat's target follows it
                    waiting.append((at, kind))
        negated, reported = max(0, negated - 1), max(0, reported - 1)
    return out


@dataclass
class Lexicon:
    """Lexical transducer: sorted hashes of whole words with their classes, and stems by length."""

    hashes: np.ndarray
    classes: np.ndarray
    stems: dict[int, np.ndarray]  # length in bytes -> sorted leading bytes

    @classmethod
    def of(cls, stems: list[str] = ()) -> Lexicon:
        found = {}
        for words, kind in ((REPORTS, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (THREATS, THREAT), (INSULTS, INSULT)):
            found.update({textcore.hash_of(w): kind for w in words})
        hashes = np.array(sorted(found), dtype=np.uint64)
        by_length: dict[int, list[int]] = {}
        for stem in stems:
            data = stem.encode()
            by_length.setdefault(len(data), []).append(int.from_bytes(data, "little"))
        return cls(
            hashes,
            np.array([found[int(h)] for h in hashes], dtype=np.int8),
            {n: np.array(sorted(set(v)), dtype=np.uint64) for n, v in sorted(by_length.items())},
        )

    @staticmethod
    def _places(values: np.ndarray, keys: np.ndarray, low: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """(rows, key index) of the values among sorted keys; low bits rule most out at once."""
        mask = np.zeros(1 << 16, dtype=bool)
        mask[((keys >> low) & np.uint64(0xFFFF)).astype(np.int64)] = True
        maybe = np.flatnonzero(mask[((values >> low) & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(keys, values[maybe]), len(keys) - 1)
        hit = keys[at] == values[maybe]
        return maybe[hit], at[hit]

    def classify(self, part: textcore.Words) -> np.ndarray:
        out = np.zeros(len(part.hashes), dtype=np.int8)
        if self.stems and len(part.hashes):
            begin = part.leading_bytes()
            for length, keys in self.stems.items():
                lead = begin & np.uint64((1 << (8 * length)) - 1)
                rows, _ = self._places(lead, keys, np.uint64(16))
                out[rows[part.ends[rows] - part.starts[rows] >= length]] = STEM
        rows, at = self._places(part.hashes, self.hashes, np.uint64(0))
        out[rows] = self.classes[at]
        return out


def features(lexicon: Lexicon, texts) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, log pattern counts) of runs of texts."""
    for part in textcore.words(plain_punctuation(texts), lower=True, space=SPACE):
        classes = lexicon.classify(part)
        x = np.zeros((len(part.offsets) - 1, len(PATTERNS)))
        heads = np.flatnonzero((classes == INSULT) | (classes == THREAT) | (classes == STEM))
        rows = np.searchsorted(part.offsets, heads, side="right") - 1
        for row in np.unique(rows):
            a, b = part.offsets[row], part.offsets[row + 1]
            breaks = np.concatenate([[0], np.cumsum(_BREAK[part.raw[part.starts[a] : part.ends[b - 1]]])])
            clause = breaks[part.starts[a:b] - part.starts[a]]
            own = heads[rows == row]
            total: Counter = Counter()
            kinds: dict[str, set] = {"insult": set(), "learned": set()}
            for c in np.unique(clause[own - a]):
                lo, hi = np.searchsorted(clause, [c, c + 1])
                found = clause_patterns(classes[a + lo : a + hi].tolist())
                total.update(found)
                inside = own[(own >= a + lo) & (own < a + hi)]
                for name, kind in (("insult", INSULT), ("learned", STEM)):
                    if found[name]:  # said directly: not all are negated or reported
                        kinds[name].update(part.hashes[inside[classes[inside] == kind]].tolist())
            total["distinct"], total["learned_pair"] = len(kinds["insult"]), len(kinds["learned"]) >= 2
            x[row] = [np.log1p(total[p]) for p in PATTERNS]
            x[row, -1] = min(2.0, 50.0 * len(kinds["learned"]) / (b - a))
        yield part.first, x


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(x @ self.weights + self.bias)


def learn_stems(rows: DataFrame, label: str = "__label") -> list[str]:
    """Word beginnings that many toxic rows have and few other rows have, over all labelled rows given."""
    sizes = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?:^|(?<=[^\p{L}]))(\p{L}{3,40})"), 1))
    stems = F.array_distinct(F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(3), F.lit(8)), lambda k: F.substring(w, 1, k)))))
    stems = F.filter(stems, lambda w: F.octet_length(w).between(*STEM_BYTES))
    counts = (
        rows.select(F.col(label).alias("y"), F.explode(stems).alias("stem"))
        .groupBy("stem")
        .agg(F.sum("y").alias("t"), F.count("*").alias("n"))
        .filter((F.col("t") >= MIN_SHARE * toxic) & (F.col("t") >= MIN_ROWS))
        .filter(F.col("t") / toxic >= MIN_RATIO * (F.col("n") - F.col("t") + 0.5) / clean)
        .orderBy(F.desc("t"), "stem")
        .limit(LEARNED_STEMS)
    )
    return [r["stem"] for r in counts.collect()]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel | None:
    """Lexicon and pattern weights from labelled rows that are not held out; None without documents of both."""
    known = labels.filter(~held_out("doc_id") & F.col(label).isNotNull())
    known = known.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label")).distinct()
    counts = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    if set(counts) != {0, 1}:
        return None
    sample = bounded_sample(known, "__label", per_label, "__id")
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(sample), "__id").select("__label", "text")  # PER_LABEL rows of each label
    lexicon = Lexicon.of(learn_stems(rows))

    def extract(batches):
        for batch in batches:
            for first, x in features(lexicon, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(x)), pa.array(list(x), pa.list_(pa.float64()))], names=["label", "x"]
                )

    # equal pattern vectors are one row with a count
    found = rows.mapInArrow(extract, "label int, x array<double>").groupBy("label", "x").count().toPandas()
    if set(found["label"]) != {0, 1}:
        return None
    found = found.assign(key=found["x"].map(tuple)).sort_values(["label", "key"])
    x, y = np.array(found["key"].tolist()), found["label"].to_numpy()
    taken = {k: max(1, int(found.loc[found["label"] == k, "count"].sum())) for k in counts}
    weight = found["count"].to_numpy() * np.array([counts[k] / taken[k] for k in y])
    times = np.maximum(1, np.round(weight / weight.sum() * 20000)).astype(int)
    w, b = fit_logistic(np.repeat(x, times, axis=0), np.repeat(y, times)[:, None].astype(float), l2=1e-4, rounds=400, floor=0.0)
    return ToxicityModel(lexicon, w[:, 0], float(b[0]))


def score_toxicity(docs: DataFrame, labels: DataFrame, model: ToxicityModel | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; ``predicted`` is 1 from 0.5 on.

    Null and empty texts match no clause and get the score of such texts.
    Repeated labels count once, contradicting ones both; null labels are not
    learned; rows with a null id are never learned from and count as held out.
    Without labels of both kinds the patterns count with weight 2 and bias -3.
    Other columns are not read; an empty table gives no rows.
    """
    model = model or fit(docs, labels, id_col=id_col, text_col=text_col)
    model = model or ToxicityModel(Lexicon.of(), np.full(len(PATTERNS), 2.0), -3.0)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, x in features(model.lexicon, batch.column(2)):
                part, score = batch.slice(first, len(x)), model.score(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
