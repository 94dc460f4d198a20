"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie.

The vocabulary's strings stand in a double-array trie over UTF-8 bytes (arrays
``base``, ``check``, ``value``).  A task gathers the pre-tokens of a batch that
it has not met, walks the trie from all their positions at once, and runs
Viterbi over all of them in waves of equal distance from their start.  A
character without a piece costs ``min score - 10`` and is spelled in byte
tokens.  Decoding joins pieces, turns byte tokens back into UTF-8 and space
markers into blanks.

Pre-tokens end where no piece of the vocabulary crosses (before a run of space
markers, around a line feed), so the best path of a text is the best paths of
its pre-tokens one after another.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .common import set_aside, shared
from .token_counts import MARK, check_pieces, default_model, load

UNKNOWN_PENALTY = 10.0
#: Pre-tokens a task remembers before it starts anew.
REMEMBERED = 200_000
#: Longer pre-tokens are searched one by one (their waves would be nearly empty).
WAVES = 96


class Vocabulary:
    """Pieces, log scores and the double-array trie; a few MB, whatever the data."""

    def __init__(self, model: bytes, scores: str = "zipf"):
        """``scores``: "model" takes the scores in the file as log probabilities
        (Unigram models); "zipf" is for merge vocabularies, whose scores are
        ranks: a piece of rank r gets log(1 / (r + 1)), normalised."""
        sp = load(model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(n)]
        self.normal = [i for i in range(n) if not special[i]]
        check_pieces([self.pieces[i] for i in self.normal])
        self.byte_id = np.zeros(256, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_id[int(self.pieces[i][3:5], 16)] = i
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.score = np.zeros(n)
        if scores == "zipf":
            rank = np.arange(len(self.normal)) + 1.0
            self.score[self.normal] = -np.log(rank) - np.log((1 / rank).sum())
        else:
            self.score[self.normal] = [sp.get_score(i) for i in self.normal]
        self.unknown = float(self.score[self.normal].min()) - UNKNOWN_PENALTY
        self.longest = max(len(self.pieces[i].encode()) for i in self.normal)
        self._build()
        self.spelling = [b""] * n
        for i in self.normal:
            self.spelling[i] = self.pieces[i].replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_id):
            self.spelling[i] = bytes([b])

    def _build(self) -> None:
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for i in self.normal:
            at = 0
            for b in self.pieces[i].encode():
                nxt = children[at].get(b)
                if nxt is None:
                    nxt = children[at][b] = len(children)
                    children.append({})
                    ends.append(-1)
                at = nxt
            ends[at] = i
        room = 8 * len(children) + 4096
        base, check, value = [0] * room, [-1] * room, [-1] * room
        slot = {0: 0}
        check[0], free, last, queue = 0, 1, 0, [0]
        for node in queue:  # breadth first: the widest nodes find room first
            kids = children[node]
            if not kids:
                continue
            codes = sorted(kids)
            while check[free] != -1:
                free += 1
            first, tries = max(free, codes[0] + 1), 0
            while not all(check[first - codes[0] + c] == -1 for c in codes):
                first, tries = first + 1, tries + 1
                if tries == 100:  # the front is nearly full: go on behind it
                    first = max(first, last - 64)
            last = max(last, first - codes[0] + codes[-1])
            b = first - codes[0]
            base[slot[node]] = b
            for c in codes:
                kid = kids[c]
                check[b + c], slot[kid], value[b + c] = slot[node], b + c, ends[kid]
                queue.append(kid)
        top = max(slot.values()) + 257
        self.base, self.check, self.value = (np.array(x[:top] if len(x) >= top else x + [-1] * (top - len(x)), np.int32)
                                             for x in (base, check, value))

    def lattice(self, data: np.ndarray, starts: np.ndarray):
        """All edges (start, end, piece id, -1 for an unknown character) of the
        byte strings in ``data``, which end in a byte 0 no piece holds."""
        padded = np.concatenate([data, np.zeros(self.longest + 1, np.uint8)])
        at, state = starts, np.zeros(len(starts), np.int64)
        found = []
        for depth in range(self.longest):
            to = self.base[state] + padded[at + depth].astype(np.int64)
            ok = (self.check[to] == state) & (to != 0)
            at, state = at[ok], to[ok]
            if not len(at):
                break
            piece = self.value[state]
            hit = piece >= 0
            found.append((at[hit], at[hit] + depth + 1, piece[hit]))
        lead = padded[starts]
        width = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        s, e, p = (np.concatenate([f[k] for f in found] or [np.zeros(0, np.int64)]) for k in range(3))
        single = np.zeros(len(padded) + 1, bool)
        reach = np.zeros(len(padded) + 1, np.int64)
        reach[starts] = starts + width
        single[s[e == reach[s]]] = True
        lone = starts[~single[starts]]
        return np.concatenate([s, lone]), np.concatenate([e, reach[lone]]), np.concatenate([p, np.full(len(lone), -1)])

    def segment(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best path of every string: all token ids in a row, tokens and log
        score of each."""
        raw = [c.encode("utf-8", "surrogatepass") for c in chunks]
        size = np.array([len(r) for r in raw], np.int64)
        first = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        data = np.frombuffer(b"\0".join(raw) + b"\0", np.uint8)
        inside = np.ones(len(data), bool)
        inside[first + size] = False
        s, e, p = self.lattice(data, np.flatnonzero(inside & ((data & 0xC0) != 0x80)))
        owner = np.repeat(np.arange(len(raw)), size + 1)
        weight = np.where(p >= 0, self.score[p], self.unknown)
        order = np.lexsort((s, e))
        s, e, p, weight = s[order], e[order], p[order], weight[order]
        best, back = np.full(len(data), -np.inf), np.full(len(data), -1, np.int64)
        best[first] = 0.0
        rel = e - first[owner[s]]
        short = size[owner[s]] <= WAVES
        idx = np.flatnonzero(short)
        idx = idx[np.argsort(rel[idx], kind="stable")]
        bounds = np.searchsorted(rel[idx], np.arange(1, WAVES + 2))
        for a, b in zip(bounds[:-1], bounds[1:]):
            if a == b:
                continue
            w = idx[a:b]
            cand = best[s[w]] + weight[w]
            ends = e[w]
            head = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]])
            top = np.maximum.reduceat(cand, head)
            group = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(w)]))
            won = np.flatnonzero(cand == top[group])
            best[ends[head]] = top
            back[ends[won[::-1]]] = w[won[::-1]]  # the first of equal ones stays
        for k in np.flatnonzero(~short):  # by end: every start is final
            c = best[s[k]] + weight[k]
            if c > best[e[k]]:
                best[e[k]], back[e[k]] = c, k
        cur = first + size
        live = np.flatnonzero(size > 0)
        who, edge = [], []
        while len(live):
            k = back[cur[live]]
            who.append(live)
            edge.append(k)
            cur[live] = s[k]
            live = live[s[k] > first[live]]
        if not who:
            return np.zeros(0, np.int32), np.zeros(len(raw), np.int64), np.zeros(len(raw))
        step = np.repeat(np.arange(len(who)), [len(w) for w in who])
        who, edge = np.concatenate(who), np.concatenate(edge)
        order = np.lexsort((-step, who))
        who, edge = who[order], edge[order]
        # an unknown character is spelled in bytes
        ids, width = p[edge], np.where(p[edge] >= 0, 1, e[edge] - s[edge])
        at = np.repeat(np.arange(len(edge)), width)
        turn = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width)
        flat = np.where(ids[at] >= 0, ids[at], self.byte_id[data[s[edge][at] + turn]]).astype(np.int32)
        count = np.bincount(who, width, len(raw)).astype(np.int64)
        return flat, count, np.where(size > 0, best[first + size], 0.0)


_RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def pre_tokens(text: str) -> list[str]:
    """A text's pre-tokens, the marker of the text's start included."""
    if not text:
        return []
    marked = (MARK + text.replace(" ", MARK)).split("\n")
    out: list[str] = []
    for i, line in enumerate(marked):
        if i:
            out.append("\n")
        if line:
            out += _RUNS.findall(line)
    return out


class Encoder:
    """Encodes batches; remembers the pre-tokens it has met, by number."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.number = defaultdict(count().__next__)
        self.flat, self.size, self.score = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)

    def __call__(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All token ids in a row, and tokens and log score of each text."""
        if len(self.number) > REMEMBERED:
            self._forget()
        cut = [pre_tokens(t) for t in texts]
        known, number = len(self.number), self.number.__getitem__
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        at = np.fromiter(map(number, chain.from_iterable(cut)), np.int64, int(n.sum()))
        new = list(islice(self.number, known, None))
        parts = [self.vocabulary.segment(new[a:a + 20_000]) for a in range(0, len(new), 20_000)]
        self.flat, self.size, self.score = (np.concatenate([mine, *(p[k] for p in parts)])
                                            for k, mine in enumerate((self.flat, self.size, self.score)))
        first = np.cumsum(self.size) - self.size
        width = self.size[at]
        upto = np.concatenate([[0], np.cumsum(width)])
        flat = self.flat[np.repeat(first[at] - upto[:-1], width) + np.arange(upto[-1])]
        ends = np.cumsum(n)
        owner = np.repeat(np.arange(len(cut)), n)
        return flat, upto[ends] - upto[ends - n], np.bincount(owner, self.score[at], len(cut)).astype(np.float64)


def decode_ids(ids: list[int], spelling: list[bytes]) -> str:
    """The text of token ids; a byte that is no UTF-8 becomes U+FFFD."""
    return decode_bytes(b"".join(map(spelling.__getitem__, ids)))


def decode_bytes(data: bytes) -> str:
    """The text of spelled tokens, without the blank that stands for its start."""
    data = data[1:] if data[:1] == b" " else data
    try:
        return data.decode()
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace")


#: Characters of text a task encodes together (at least one text).
BATCH_CHARS = 1_000_000
#: Rows a task decodes together.
DECODE_ROWS = 64


def _groups(column, chars: int = BATCH_CHARS):
    """Runs of rows of about ``chars`` characters."""
    group, held = [], 0
    for value in column:
        text = value.as_py()
        group.append(text)
        held += len(text or "")
        if held >= chars:
            yield group
            group, held = [], 0
    if group:
        yield group


def _texts(flat: np.ndarray, offsets: np.ndarray, spelling: list[bytes], width: np.ndarray) -> list[str]:
    """The texts of token ids that stand in a row."""
    data = b"".join(map(spelling.__getitem__, flat.tolist()))
    ends = np.concatenate([[0], np.cumsum(width[flat])])[offsets].tolist()
    return [decode_bytes(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def encode(docs: DataFrame, text: str = "text", model: bytes | None = None, scores: str = "zipf",
           decoded: str | None = None) -> DataFrame:
    """Every row of ``docs`` with ids, n_tokens, n_byte_tokens and score; with
    ``decoded`` also, under that name, the text that the ids decode to.

    Defined cases: a null or empty text has no tokens and score 0; of equal
    paths the one with the longest last piece wins, alike in every run; repeated
    rows are encoded alike; an empty table gives an empty result; input columns
    named like an added one are replaced; a very long text is encoded whole.
    """
    vocabulary = Vocabulary(model or default_model(), scores)
    given = shared(docs, vocabulary)  # one vocabulary: does not grow with the data
    added = ("ids", "n_tokens", "n_byte_tokens", "score", *([decoded] if decoded else []))
    slim, back_again = set_aside(docs, {"text": text}, added)
    schema = StructType([*slim.schema.fields, StructField("ids", ArrayType(IntegerType(), False)),
                         StructField("n_tokens", LongType()), StructField("n_byte_tokens", LongType()),
                         StructField("score", DoubleType())] + ([StructField(decoded, StringType())] if decoded else []))

    def run(batches):
        known = given()
        encoder, is_byte, spelling = Encoder(known), known.is_byte, known.spelling
        width = np.array([len(x) for x in spelling])
        for batch in batches:
            done = 0
            for texts in _groups(batch.column("text")):
                flat, sizes, score = encoder(texts)
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                spelled = np.concatenate([[0], np.cumsum(is_byte[flat])])
                part = batch.slice(done, len(texts))
                done += len(texts)
                back = [pa.array(_texts(flat, offsets, spelling, width), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                     pa.array(sizes), pa.array(spelled[offsets[1:]] - spelled[offsets[:-1]], pa.int64()), pa.array(score, pa.float64()), *back],
                    [*part.schema.names, *added])

    return back_again(slim.mapInArrow(run, schema))


def decode(rows: DataFrame, ids: str = "ids", out: str = "decoded", model: bytes | None = None) -> DataFrame:
    """Every row with the text of its token ids; null ids give null, none give ''."""
    given = shared(rows, Vocabulary(model or default_model()).spelling)
    slim, back = set_aside(rows, {"ids": ids}, (out,))
    schema = StructType([*slim.schema.fields, StructField(out, StringType())])

    def run(batches):
        spelling = given()
        width = np.array([len(x) for x in spelling])
        for batch in batches:
            for at in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(at, DECODE_ROWS)
                column = part.column("ids")
                flat = column.flatten().to_numpy(zero_copy_only=False)  # without the ids of null rows
                size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                found = _texts(flat, np.concatenate([[0], np.cumsum(size)]), spelling, width)
                text = [t if known else None for known, t in zip(column.is_valid().to_pylist(), found)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(text, pa.string())], [*part.schema.names, out])

    return back(slim.mapInArrow(run, schema))


def query(docs: DataFrame) -> DataFrame:
    rows = encode(docs.select("doc_id", "text"), decoded="decoded")
    same = F.coalesce(F.col("decoded") == F.replace(F.col("text"), F.lit(MARK), F.lit(" ")), F.col("n_tokens") == 0)
    return rows.select("doc_id", "n_tokens", "n_byte_tokens", "score", same.alias("round_trip"), "ids", "decoded")
