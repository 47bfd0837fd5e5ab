"""Language of documents and of the one-language stretches within them.

Error-correcting output codes: every language has a codeword of signs, long
enough for the number of languages that any two differ in ``LEAST_APART`` bits;
one binary n-gram classifier per bit predicts that sign from character n-grams;
loss-weighted decoding picks the language whose codeword costs least under the
classifiers' margins, bits weighted by how well each separates held-out
samples, and flags the decision as ambiguous where the runner-up is close.

Every word is decoded and votes for the languages its margins suit; a line has
the language of most of its words.  A word's margins and votes are found once
per task, so a line's work is a lookup per word.  A stretch whose margins lie
further from every codeword than those of any language do in held-out samples
is of no language known (``UNKNOWN``).  Documents are read whole; their rows
never leave their partition.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.tokens import slices

# Codewords have at least this many bits, and as many more as it takes to keep any two this far apart.
CODE_BITS = 15
LEAST_APART = 5
FEATURES = 1 << 15
# The classifiers are fitted on at most this many labelled rows.
MAX_SAMPLES = 20_000
# A second fit adds lines of at most this many labelled documents per language, and this many lines of each.
DOCS_PER_LANGUAGE = 100
LINES_PER_DOCUMENT = 10
# Distinct words a task remembers (bits * 4 bytes each).
WORD_MEMORY = 200_000
# A decision whose confidence is below this is flagged as ambiguous.
AMBIGUOUS_BELOW = 0.6
_SMOOTHING = 0.3
# The label of a stretch that suits no language of the model, and how many words it must have to be called that.
UNKNOWN = "und"
UNKNOWN_FROM_WORDS = 8
# It lies this many times further from every codeword than all but a thousandth of the held-out samples do from their own.
FAR = 1.5

# Three-letter codes and English names that mean an ISO 639-1 code.
LABELS = {
    "en": ("eng", "english"), "si": ("sin", "sinhala", "sinhalese"), "ta": ("tam", "tamil"), "de": ("deu", "ger", "german"), "nl": ("nld", "dut", "dutch"),
    "fr": ("fra", "fre", "french"), "es": ("spa", "spanish", "castilian"), "pt": ("por", "portuguese"), "id": ("ind", "indonesian"),
}

_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ஀-௿඀-෿‌‍'’])*")


def iso_label(label: Column, languages: Sequence[str] = (), labels: Mapping[str, Sequence[str]] = LABELS) -> Column:
    """The ISO 639-1 code a label names, in any case, with a region, as code or name; null if none.

    Codes are those of ``labels``, which also has their other names, and
    ``languages``, such as a model has learnt.
    """
    s = F.regexp_replace(F.regexp_replace(F.lower(label), r"^[\s\u00a0]+", ""), r"[^\p{L}].*$", "")
    out = F.when(s.isin([*labels, *languages]), s)
    for code, names in labels.items():
        out = F.when(s.isin(*names), F.lit(code)).otherwise(out)
    return out


def _ngrams(word: str) -> list[int]:
    w = f"<{word.lower().replace(chr(0x2019), chr(39))}>"
    grams = [w] + [w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1) if n > 1 or w[i] not in "<>"]
    return [xxhash.xxh32_intdigest(g.encode("utf-8", "replace")) % FEATURES for g in grams]


def codewords(n_languages: int) -> np.ndarray:
    """Signs (languages x bits): the shortest code, from ``CODE_BITS`` on, whose closest pair is ``LEAST_APART`` bits apart.

    Of many seeded draws of a length the one whose closest pair is furthest
    apart counts.  Every bit divides the languages, so one language has a code
    of one bit, which nothing contradicts, and two have opposite codewords.
    """
    if n_languages == 1:
        return np.ones((1, 1), np.int8)
    bits = CODE_BITS
    while True:
        best, score = None, (-1, -1.0)
        for seed in range(400 if n_languages <= 64 else 20):
            rng = np.random.default_rng(seed)
            c = np.where(rng.random((n_languages, bits)) < 0.5, -1, 1).astype(np.int8)
            while (same := np.abs(c.sum(0)) == n_languages).any():
                c[:, same] = np.where(rng.random((n_languages, int(same.sum()))) < 0.5, -1, 1)
            # Two codewords differ in (bits - their product) / 2 places.
            apart = (bits - c.astype(np.int32) @ c.T.astype(np.int32))[np.triu_indices(n_languages, 1)] // 2
            if (int(apart.min()), float(apart.mean())) > score:
                best, score = c, (int(apart.min()), float(apart.mean()))
        if score[0] >= LEAST_APART:
            return best
        bits += 3


@dataclass
class LanguageCodes:
    """Fitted classifiers: weights (features x bits), codewords, bit weights, the distance beyond which no language is meant, and a sharpness for confidences."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray
    furthest: float = float("inf")
    sharpness: float = 6.0
    _memory: _Memory | None = field(default=None, repr=False)

    @classmethod
    def fit(cls, samples: list[tuple[str, str]]) -> LanguageCodes:
        """From (language, text) rows; a language needs at least one sample with words."""
        samples = [(lang, text) for lang, text in samples if _WORD.search(text)]
        languages = sorted({lang for lang, _ in samples})
        if not languages:
            raise ValueError("no sample of any language")
        code = codewords(len(languages))
        bits = code.shape[1]
        grams: dict[str, np.ndarray] = {}
        per_sample = []
        for lang, text in samples:
            words = [w.lower() for w in _WORD.findall(text)]
            for w in words:
                if w not in grams:
                    grams[w] = np.array(_ngrams(w))
            if words:
                per_sample.append((languages.index(lang), words))

        def counts(keep) -> np.ndarray:
            out = np.zeros((len(languages), FEATURES))
            for li in range(len(languages)):
                own = [grams[w] for k, (x, words) in enumerate(per_sample) if x == li and keep(k) for w in words]
                if own:
                    out[li] = np.bincount(np.concatenate(own), minlength=FEATURES)
            return out

        def train(c: np.ndarray) -> np.ndarray:
            # Per bit: log odds of a feature in the languages of the plus side against the minus side.
            p = c + 1e-9
            p = p / p.sum(1, keepdims=True) * min(p.sum(1).max(), 20_000)
            w = np.zeros((FEATURES, bits), np.float32)
            for b in range(bits if len(languages) > 1 else 0):
                plus, minus = p[code[:, b] > 0].mean(0) + _SMOOTHING, p[code[:, b] < 0].mean(0) + _SMOOTHING
                w[:, b] = np.log(plus / plus.sum()) - np.log(minus / minus.sum())
            return w

        folds = 3
        right, seen, margins, own = np.zeros(bits), 0, [], []
        for f in range(folds):
            w = train(counts(lambda k, f=f: k % folds != f))
            held: dict[str, np.ndarray] = {}
            for k, (li, words) in enumerate(per_sample):
                if k % folds == f:
                    m = np.mean([held[x] if x in held else held.setdefault(x, w[grams[x]].mean(0)) for x in words], axis=0)
                    right += np.sign(m) == code[li]
                    seen += 1
                    if len(words) >= UNKNOWN_FROM_WORDS:
                        margins.append(m)
                        own.append(li)
        accuracy = np.clip((right + 1) / (seen + 2), 0.05, 0.95)
        model = cls(languages, code, train(counts(lambda k: True)), np.maximum(0.05, np.log(accuracy / (1 - accuracy))).astype(np.float32))
        if len(languages) > 1 and margins:
            far = model.distances(np.asarray(margins))
            right = far.argmin(1) == own
            if right.any():
                model.furthest = FAR * float(np.quantile(far.min(1)[right], 0.999))
        return model

    def _row(self, chunk: str) -> np.ndarray | None:
        """Summed margins, votes for each language and number of words of a blank-divided chunk; None without words."""
        words = _WORD.findall(chunk)
        if not words:
            return None
        m = np.array([self.weights[_ngrams(w)].mean(0) for w in words], np.float32)
        return np.concatenate([m.sum(0), self.votes(m).sum(0), [len(words)]]).astype(np.float32)

    def score(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(summed margins per bit, words per language, number of words) of each line."""
        bits = self.code.shape[1]
        if self._memory is None or len(self._memory) > WORD_MEMORY:
            self._memory = _Memory(self._row, bits + len(self.languages) + 1)
        get = self._memory.__getitem__
        at: list[int] = []
        ends = [0]
        for line in lines:
            at.extend(map(get, line.split()))
            ends.append(len(at))
        ends = np.asarray(ends)
        total = np.zeros((len(lines), self._memory.width), np.float32)
        if at:
            full = np.flatnonzero(ends[1:] > ends[:-1])
            total[full] = np.add.reduceat(np.asarray(self._memory.rows, np.float32)[np.asarray(at)], ends[full])
        return total[:, :bits], total[:, bits:-1], total[:, -1]

    def votes(self, margins: np.ndarray) -> np.ndarray:
        """How far each language is meant by margins (rows x bits); the languages of a row add up to 1."""
        loss = self.distances(margins)
        p = np.exp(-self.sharpness * (loss - loss.min(1, keepdims=True)))
        return p / p.sum(1, keepdims=True)

    def distances(self, margins: np.ndarray) -> np.ndarray:
        """Loss-weighted distance of margins (rows x bits) to every codeword."""
        steep = margins.astype(np.float32) * np.float32(3)
        # log(1 + e^-cm): for c = -1 it is m more than for c = +1, so one logarithm per bit serves all codewords.
        plus = np.log1p(np.exp(-np.abs(steep))) + np.maximum(-steep, 0)
        minus_side = (self.code < 0).astype(np.float32) * self.bit_weights
        return ((plus @ self.bit_weights)[:, None] + steep @ minus_side.T) / self.bit_weights.sum()

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language number, confidence): least loss-weighted distance to a codeword."""
        p = self.votes(margins)
        return p.argmax(1), p.max(1)


class _Memory(dict):
    """Row number by chunk; chunks without words share row 0."""

    def __init__(self, row, width: int) -> None:
        super().__init__()
        self.row, self.width, self.rows = row, width, [np.zeros(width, np.float32)]

    def __missing__(self, chunk: str) -> int:
        v = self.row(chunk)
        if v is None:  # figures hardly repeat and are not remembered
            return 0
        self.rows.append(v)
        self[chunk] = len(self.rows) - 1
        return len(self.rows) - 1


def _sampled(samples: DataFrame, lang: str, text: str) -> list[tuple[str, str]]:
    """At most ``MAX_SAMPLES`` labelled rows, taken from all languages in turn by hash of the text, ordered by language and text."""
    turn = F.row_number().over(Window.partitionBy("_l").orderBy(F.xxhash64("_t"), "_t"))
    rows = samples.select(F.col(lang).alias("_l"), F.col(text).alias("_t")).where(F.col("_l").isNotNull() & F.col("_t").isNotNull())
    kept = rows.withColumn("_r", turn).where(F.col("_r") <= MAX_SAMPLES).orderBy("_r", "_l").limit(MAX_SAMPLES)
    return [(r[0], r[1]) for r in kept.select("_l", "_t").orderBy("_l", "_t").collect()]


def fit_codes(samples: DataFrame, lang: str, text: str) -> LanguageCodes:
    """Classifiers from at most ``MAX_SAMPLES`` labelled rows of ``samples``."""
    return LanguageCodes.fit(_sampled(samples, lang, text))


def refit_codes(model: LanguageCodes, samples: DataFrame, documents: DataFrame, lang: str = "lang", sample_text: str = "sample_text", id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> LanguageCodes:
    """Classifiers fitted again with lines of labelled documents added.

    The bounded sample: per language the ``DOCS_PER_LANGUAGE`` labelled
    documents with the smallest hash of their id, of each the first
    ``LINES_PER_DOCUMENT`` lines with words.  Labels may be wrong, so a
    document counts only if the first fit gives most of its words its label,
    and a line of it only unless the first fit is sure of another language.
    """
    at = Window.partitionBy("_l").orderBy("_k", id_col)
    known = documents.select(id_col, iso_label(F.col(label_col), model.languages).alias("_l"), F.xxhash64(F.col(id_col)).alias("_k"))
    chosen = known.where(F.col("_l").isin(model.languages)).withColumn("_r", F.row_number().over(at)).where(F.col("_r") <= DOCS_PER_LANGUAGE)
    lines = F.slice(F.filter(F.split(F.col(text_col), "\n"), lambda x: x.rlike(r"\p{L}")), 1, LINES_PER_DOCUMENT)
    # Joined before they are divided into lines, so only the chosen texts are.
    rows = documents.select(id_col, text_col).join(F.broadcast(chosen.select(id_col, "_l")), id_col).select("_l", id_col, lines.alias("_t")).orderBy("_l", id_col).collect()
    out = _sampled(samples, lang, sample_text)
    for r in rows:
        if not r["_t"]:
            continue
        margins, words, n = model.score(r["_t"])
        number, sure = words.argmax(1), model.decode(margins / np.maximum(n, 1)[:, None])[1]
        own = model.languages.index(r["_l"])
        if 2 * n[number == own].sum() > n.sum():
            out += [(r["_l"], t) for t, k, c in zip(r["_t"], number, sure) if k == own or c < AMBIGUOUS_BELOW]
    return LanguageCodes.fit(out)


def _stretches(model: LanguageCodes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            lines, owner, number = [], [], []
            for k, t in enumerate(texts):
                own = t.split("\n") if t else []
                lines += own
                owner += [k] * len(own)
                number += range(1, len(own) + 1)
            margins, votes, n = model.score(lines)
            at = np.flatnonzero(n > 0)
            out: list[list] = [[] for _ in range(7)]
            if len(at):
                m, v, words, doc, line = margins[at], votes[at], n[at], np.asarray(owner)[at], np.asarray(number)[at]
                lang = v.argmax(1)
                # Lines far from every codeword are a stretch of their own.
                lang[(words >= UNKNOWN_FROM_WORDS) & (model.distances(m / words[:, None]).min(1) > model.furthest)] = len(model.languages)
                first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (lang[1:] != lang[:-1])])
                last = np.r_[first[1:], len(at)] - 1
                size = np.add.reduceat(words, first)
                # The stretch's language is its lines'; the confidence is that of their words together.
                p = model.votes(np.add.reduceat(m, first) / size[:, None])
                own = lang[first]
                sure = np.where(own < len(model.languages), p[np.arange(len(own)), np.minimum(own, len(model.languages) - 1)], 1 - p.max(1))
                names = [*model.languages, UNKNOWN]
                out = [[ids[k] for k in doc[first]], line[first].tolist(), line[last].tolist(), [names[i] for i in own], sure.tolist(), size.astype(int).tolist(), (sure < AMBIGUOUS_BELOW).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int64(), pa.bool_()))], ["doc_id", "first_line", "last_line", "lang", "confidence", "n_words", "ambiguous"])

    return run


def language_stretches(documents: DataFrame, model: LanguageCodes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal one-language stretches: (doc_id, first_line, last_line, lang, confidence, n_words, ambiguous).

    Lines are divided by line feeds and numbered from 1.  Lines without words
    belong to no stretch and interrupt none; a text without words (or null)
    gives no row.  Lines that suit no language of the model have ``UNKNOWN``.
    One narrow stage; repeated documents give repeated rows.
    """
    return documents.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(_stretches(model), "doc_id long, first_line int, last_line int, lang string, confidence double, n_words long, ambiguous boolean")


def document_languages(stretches: DataFrame) -> DataFrame:
    """(doc_id, lang, confidence, n_stretches): the language of most words of each document.

    The confidence is the share of words in that language times its word-weighted confidence; ties go to the smaller code.
    """
    per = stretches.groupBy("doc_id", "lang").agg(F.sum("n_words").alias("_n"), F.sum(F.col("n_words") * F.col("confidence")).alias("_c"), F.count(F.lit(1)).alias("_s"))
    best = per.groupBy("doc_id").agg(F.min(F.struct((-F.col("_n")).alias("_m"), "lang", "_c")).alias("_b"), F.sum("_n").alias("_all"), F.sum("_s").alias("n_stretches"))
    return best.select("doc_id", "_b.lang", (F.col("_b._c") / F.col("_all")).alias("confidence"), "n_stretches")
