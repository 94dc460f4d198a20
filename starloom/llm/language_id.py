"""Language identification of mixed-language text.

Character trigrams of words (with word ends) give every word a log score per
language; the scripts a language is written in narrow a word's candidates by its
code point range.  Viterbi over the words, with a penalty per switch, labels
spans; a text gets the language that holds most of its letters.

The model is learned from labelled rows: a sample of bounded size, counted in
tasks into 2^16 trigram classes per language, so the model's size depends on the
number of languages only.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .common import set_aside, shared
from .sentencepiece_codec import _groups

CLASSES = 1 << 16
SWITCH = 12.0
#: Score of a word in a language that is not written in its script.
FOREIGN = -50.0
REMEMBERED = 200_000
#: Languages a model may have: its size grows with them, and so does what the driver holds while learning.
LANGUAGES = 256
#: Words of a chunk, and the most languages for which chunks are worked out from every start.
CHUNK, STARTS = 64, 16


def _marks() -> str:
    """The combining marks (categories Mn and Mc) as ranges of a character class."""
    points = [p for p in range(0x300, 0x1F000) if unicodedata.category(chr(p)) in ("Mn", "Mc")]
    heads = [p for i, p in enumerate(points) if not i or points[i - 1] != p - 1]
    ends = [p for i, p in enumerate(points) if i == len(points) - 1 or points[i + 1] != p + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(heads, ends))


#: Runs of letters, with the combining marks that stand on them.
_WORD = re.compile(rf"[^\W\d_]+(?:[{_marks()}]+[^\W\d_]*)*")
#: Script ranges: first code points of runs, with the script of each run (Unicode blocks).
RANGES = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "syriac"), (0x0750, "arabic"), (0x0780, "thaana"), (0x07C0, "nko"), (0x0800, "other"), (0x08A0, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "cherokee"),
    (0x1400, "canadian"), (0x1680, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1C90, "georgian"),
    (0x1CC0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C00, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x2D00, "georgian"), (0x2D30, "tifinagh"), (0x2D80, "ethiopic"), (0x2DE0, "cyrillic"), (0x2E00, "other"), (0x3040, "kana"),
    (0x3100, "bopomofo"), (0x3130, "hangul"), (0x3190, "other"), (0x31A0, "bopomofo"), (0x31C0, "other"), (0x31F0, "kana"), (0x3200, "other"),
    (0x3400, "han"), (0xA000, "yi"), (0xA4D0, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"), (0xA800, "other"),
    (0xA8E0, "devanagari"), (0xA900, "other"), (0xA960, "hangul"), (0xA980, "other"), (0xAA60, "myanmar"), (0xAA80, "other"),
    (0xAB00, "ethiopic"), (0xAB30, "latin"), (0xAB70, "cherokee"), (0xABC0, "other"), (0xAC00, "hangul"), (0xD800, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
    (0xFF00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"), (0x1F100, "other"), (0x20000, "han"),
    (0x323B0, "other"),
)
_STARTS = np.array([r[0] for r in RANGES])
SCRIPTS = sorted({r[1] for r in RANGES})
_SCRIPT = np.array([SCRIPTS.index(r[1]) for r in RANGES])


def held_out(doc_id: Column) -> Column:
    """True for the documents that are never learned from; a null id is not."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def text_words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram classes of all words in a row, where each word's begin, letters and script per word."""
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(size + 2)[:-1]])
    a, b, c = points[:-2], points[1:-1], points[2:]
    mixed = (a * 0x1F123BB5 + b * 0x2C9277B5 + c * 0x5851F42D) & 0xFFFFFFFF
    classes = (mixed ^ (mixed >> 15)) % CLASSES
    # a word of n letters has n trigrams, from its begin mark on
    at = np.repeat(starts, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    script = _SCRIPT[np.searchsorted(_STARTS, points[starts + 1], "right") - 1]
    letters = np.array([sum(ch.isalpha() for ch in w) for w in words], np.int64)
    return classes[at], np.cumsum(size) - size, letters, script


class Model:
    """Log scores of trigram classes and admitted scripts per language."""

    def __init__(self, languages: list[str], trigrams: np.ndarray, scripts: np.ndarray, priors: np.ndarray):
        self.languages = languages
        total = trigrams.sum(1, keepdims=True)
        smooth = 0.05
        self.table = np.log((trigrams + smooth) / (total + smooth * CLASSES)).T.astype(np.float32)
        share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
        self.writes = share >= 0.01
        self.prior = np.log((priors + 1) / (priors + 1).sum()) if len(languages) else np.zeros(0)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per word the log scores by language, and its letters."""
        classes, starts, letters, script = features(words)
        s = np.add.reduceat(self.table[classes], starts, axis=0).astype(np.float64)
        writes = self.writes[:, script].T
        known = writes.any(1)
        s = np.where(writes | ~known[:, None], s, s + FOREIGN)
        s -= s.max(1, keepdims=True)
        s[letters == 0] = 0.0
        return s, letters


def viterbi(s: np.ndarray, switch: float) -> np.ndarray:
    """The language index of every word on the best path."""
    total = s.sum(0)
    star = int(total.argmax())
    # no run of words gains half a switch's price over the best single language:
    # k runs then gain at most k / 2 prices and pay k - 1, so the path stays with it
    c = np.concatenate([np.zeros((1, s.shape[1])), np.cumsum(s - s[:, star:star + 1], axis=0)])
    if (c - np.minimum.accumulate(c, axis=0)).max() <= switch / 2:
        return np.full(len(s), star)
    best, back = s[0].copy(), np.zeros(s.shape, np.int64)
    every = np.arange(s.shape[1])
    for i in range(1, len(s)):
        top = int(best.argmax())
        moved = best[top] - switch > best
        back[i] = np.where(moved, top, every)
        best = np.where(moved, best[top] - switch, best) + s[i]
    path = np.empty(len(s), np.int64)
    path[-1] = best.argmax()
    for i in range(len(s) - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def paths(s: np.ndarray, size: np.ndarray, switch: float) -> np.ndarray:
    """The best paths of texts whose words' scores stand in a row, ``size`` words each.

    Texts are cut into chunks of ``CHUNK`` words, and step i of all chunks of all
    texts is taken at once, from every language a chunk may be entered in.  The
    chunks' best values then join into the texts' best paths, chunk k of every
    text at once; the way back is the same.  Exact, as the price of a path is the
    sum of those of its chunks."""
    n, k = s.shape
    if not n:
        return np.zeros(0, np.int64)
    if k > STARTS:
        return np.concatenate([viterbi(x, switch) for x in np.split(s, np.cumsum(size)[:-1]) if len(x)])
    own = -(-size // CHUNK)
    first = np.cumsum(own) - own
    chunks = int(own.sum())
    # a chunk's place for every word; what is left of a last chunk costs nothing
    begin = np.cumsum(size) - size
    at = np.arange(n) - np.repeat(begin, size) + np.repeat(first * CHUNK, size)
    words = np.zeros((chunks * CHUNK, k))
    words[at] = s
    words = np.ascontiguousarray(words.reshape(chunks, CHUNK, k).swapaxes(0, 1))
    best = words[0][:, None, :] - switch * (1 - np.eye(k))  # chunk, entered from, language
    back = np.zeros((CHUNK, chunks, k, k), np.int8)
    every = np.arange(k, dtype=np.int8)
    for i in range(1, CHUNK):
        top = best.max(2, keepdims=True) - switch
        moved = top > best
        back[i] = np.where(moved, best.argmax(2).astype(np.int8)[:, :, None], every)
        best = np.where(moved, top, best) + words[i][:, None, :]
    value, came = np.zeros((len(size), k)), np.zeros((chunks, k), np.int64)
    for c in range(int(own.max(initial=0))):
        live = np.flatnonzero(own > c)
        to = value[live][:, :, None] + best[first[live] + c]
        came[first[live] + c] = to.argmax(1)
        value[live] = to.max(1)
    end, start = np.zeros(chunks, np.int64), np.zeros(chunks, np.int64)
    now = value.argmax(1)
    for c in range(int(own.max(initial=0)) - 1, -1, -1):
        live = np.flatnonzero(own > c)
        end[first[live] + c] = now[live]
        now[live] = start[first[live] + c] = came[first[live] + c, now[live]]
    path, which = np.empty((CHUNK, chunks), np.int64), np.arange(chunks)
    path[-1] = end
    for i in range(CHUNK - 1, 0, -1):
        path[i - 1] = back[i, which, start, path[i]]
    return path.T.ravel()[at]


def sample_sizes(by: dict[str, int], sample_docs: int) -> dict[str, int]:
    """Rows to learn from per language, ``sample_docs`` in all: an equal part each,
    and what small languages leave of theirs goes to the larger ones; one at least."""
    out, left = {}, sample_docs
    for i, x in enumerate(sorted(by, key=lambda x: (by[x], x))):
        out[x] = min(by[x], max(1, left // (len(by) - i)))
        left -= out[x]
    return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample_docs: int = 20_000) -> Model:
    """A model from about ``sample_docs`` labelled rows, chosen by a hash of the
    id and text within each language (see :func:`sample_sizes`).  More than
    ``LANGUAGES`` distinct labels are an error."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("id"))
    by = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()}
    if len(by) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: clean the labels before learning")
    languages, rows = sorted(by), sum(by.values())
    if not languages:
        return Model([], np.zeros((0, CLASSES)), np.zeros((0, len(SCRIPTS))), np.zeros(0))
    steps = 1_000_000
    part = known
    if rows > sample_docs:
        upto = {x: -(-steps * n // by[x]) for x, n in sample_sizes(by, sample_docs).items()}
        limit = F.element_at(F.create_map(*[F.lit(v) for v in chain.from_iterable(upto.items())]), F.col("lang"))
        part = known.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col("id"), F.col("text")), F.lit(steps)) < limit)
    number = {x: i for i, x in enumerate(languages)}

    def tally(batches):
        """One table per task: trigram classes, then scripts, by language."""
        tri, scr = np.zeros((len(number), CLASSES), np.int64), np.zeros((len(number), len(SCRIPTS)), np.int64)
        for batch in batches:
            texts: dict[int, Counter] = {}
            for x, t in zip(batch.column(0), batch.column(1)):
                texts.setdefault(number[x.as_py()], Counter()).update(text_words(t.as_py()))
            for x, words in texts.items():
                if not words:
                    continue
                n = np.fromiter(words.values(), np.int64, len(words))
                classes, starts, letters, script = features(list(words))
                size = np.diff(np.r_[starts, len(classes)])
                np.add.at(tri[x], classes, np.repeat(n, size))
                np.add.at(scr[x], script, n)
        both = np.concatenate([tri, scr], axis=1)
        x, k = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(k), pa.array(both[x, k])], ["x", "k", "n"])

    # languages x (classes + scripts) sums at most, whatever the data
    sums = part.select("lang", "text").mapInArrow(tally, "x long, k long, n long").groupBy("x", "k").agg(F.sum("n").alias("n")).toArrow()
    both = np.zeros((len(languages), CLASSES + len(SCRIPTS)), np.int64)
    both[sums.column("x").to_numpy(), sums.column("k").to_numpy()] = sums.column("n").to_numpy()
    return Model(languages, both[:, :CLASSES], both[:, CLASSES:], np.array([by[x] for x in languages], float))


def label(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """Every row without its text, with lang_pred, score and spans.

    ``spans``: (lang, first_word, n_words) in order, words as runs of letters.
    ``score`` is the share of the letters that lie in spans of lang_pred.
    Defined cases: a text that is null or has no letter is ``und``, score 0,
    without spans, as is every text if no language was learned; of equal
    languages the first by name wins; repeated rows are labelled alike; an empty
    table gives an empty result; input columns named like an added one are
    replaced; a very long text is labelled whole.
    """
    given = shared(docs, model)
    slim, back = set_aside(docs, {"text": text}, ("lang_pred", "score", "spans"))
    span = StructType([StructField("lang", StringType()), StructField("first_word", LongType()), StructField("n_words", LongType())])
    schema = StructType([slim.schema["__rest"], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                         StructField("spans", ArrayType(span))])

    def run(batches):
        model = given()
        number = defaultdict(count().__next__)  # of the words met so far
        languages, k = pa.array([*model.languages, "und"], pa.string()), len(model.languages)
        scores, letters = np.zeros((0, k)), np.zeros(0, np.int64)
        for batch in batches:
            done = 0
            for texts in _groups(batch.column("text")):
                cut = [text_words(t) for t in texts] if k else [[] for _ in texts]
                if len(number) > REMEMBERED:
                    number = defaultdict(count().__next__)
                    scores, letters = scores[:0], letters[:0]
                known, size = len(number), np.fromiter(map(len, cut), np.int64, len(cut))
                every = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64, int(size.sum()))
                new = list(islice(number, known, None))
                if new:
                    s, n = model.score(new)
                    scores, letters = np.concatenate([scores, s]), np.concatenate([letters, n])
                of = np.repeat(np.arange(len(size)), size)
                # a text whose words have no letter is as good as empty
                some = np.bincount(of, letters[every], len(size)) > 0
                live = some[of]
                every, of, begin_at = every[live], of[live], (np.cumsum(size * some) - size * some)[some]
                s = scores[every]
                s[begin_at] += model.prior
                path = paths(s, size[some], switch)
                share = np.bincount(of * max(k, 1) + path, letters[every], len(size) * max(k, 1)).reshape(len(size), -1)
                top, whole = share.argmax(1), share.sum(1)
                score = np.where(some, share[np.arange(len(size)), top] / np.maximum(whole, 1), 0.0)
                head = np.flatnonzero(np.r_[np.ones(min(len(path), 1), bool), (path[1:] != path[:-1]) | (of[1:] != of[:-1])])
                width = np.diff(np.r_[head, len(path)])
                at = np.arange(len(path)) - np.repeat(begin_at, size[some])
                found = pa.StructArray.from_arrays([languages.take(pa.array(path[head])), pa.array(at[head]), pa.array(width)], ["lang", "first_word", "n_words"])
                offsets = np.r_[0, np.cumsum(np.bincount(of[head], minlength=len(size)))].astype(np.int32)
                part = batch.column("__rest").slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [part, languages.take(pa.array(np.where(some, top, k))), pa.array(score), pa.ListArray.from_arrays(pa.array(offsets), found)],
                    ["__rest", "lang_pred", "score", "spans"])

    return back(slim.select("__rest", "text").mapInArrow(run, schema), text)


def query(docs: DataFrame) -> DataFrame:
    model = learn(docs.filter(~held_out(F.col("doc_id"))))
    rows = label(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))
