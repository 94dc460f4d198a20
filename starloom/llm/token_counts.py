"""Token counts by the whole-token shortcut.

No piece of the vocabulary holds a space marker after another character, and
none holds a line feed (both are checked when a model is read), so merges never
cross a place before a run of spaces nor a line feed: a text's count is the sum
over its pre-tokens.  Once, on the driver, every vocabulary string is encoded
alone; those that come out as their own single token are proved.  A task counts
proved pre-tokens as one and runs merges only for the others, each distinct one
once while it is remembered.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import set_aside

MARK = "▁"
#: Pre-tokens a task remembers before it starts anew (bounds its memory).
REMEMBERED = 300_000


def load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver; tasks get its bytes."""
    with open(path, "rb") as f:
        return f.read()


def default_model() -> bytes:
    import public_tokenizers

    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def check_pieces(pieces: list[str]) -> None:
    """The properties that let a text be cut into pre-tokens."""
    if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
        raise ValueError("a piece crosses a space or a line feed: this vocabulary cannot be counted by pre-tokens")


def proved_tokens(model: bytes) -> tuple[frozenset, frozenset]:
    """Strings that encode alone as one token: after a space, and elsewhere."""
    sp = load(model)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))]
    check_pieces(pieces)
    if sp.encode("\n") != [sp.piece_to_id(MARK), sp.piece_to_id("<0x0A>")]:
        raise ValueError("this model does not spell a line feed as one byte token after the space marker")
    marked = [p[1:] for p in pieces if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]]
    bare = [p for p in pieces if MARK not in p]
    return (frozenset(w for w, ids in zip(marked, sp.encode(marked, num_threads=1)) if len(ids) == 1),
            frozenset(w for w, ids in zip(bare, sp.encode(["\n" + w for w in bare], num_threads=1)) if len(ids) == 3))


class _Counts(dict):
    """Tokens of a pre-token; proved ones are one, others are merged once."""

    def __init__(self, proved, merge):
        super().__init__()
        self.proved, self.merge = proved, merge

    def __missing__(self, word):
        n = 1 if word in self.proved else self.merge(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = n
        return n


_RUNS = re.compile(r" +[^ ]*|[^ ]+")


def counter(model: bytes, proved: tuple[frozenset, frozenset]):
    """A function from text to its number of tokens."""
    sp = load(model)
    # after a space: the library itself puts the marker in front
    marked = _Counts(proved[0], lambda w: len(sp.encode(w)) if w else 1)
    # elsewhere: behind a line feed, which takes two tokens with its marker
    bare = _Counts(proved[1], lambda w: len(sp.encode("\n" + w)) - 2)

    def count(text: str | None) -> int:
        if not text:
            return 0
        n = -1
        for line in (" " + text.replace(MARK, " ")).split("\n"):
            n += 1
            if not line:
                continue
            if "  " not in line and line[-1] != " ":
                first, *rest = line.split(" ")
                if first:
                    n += bare[first]
                n += sum(map(marked.__getitem__, rest))
            else:
                for run in _RUNS.findall(line):
                    n += marked[run[1:]] if run[0] == " " else bare[run]
        return n

    return count


def token_counts(docs: DataFrame, text: str = "text", model: bytes | None = None) -> DataFrame:
    """Every row of ``docs`` with n_bytes (UTF-8) and n_tokens in front of its columns' order.

    Counts equal the library's for the whole text, without special tokens.
    Defined cases: a null or empty text has 0 of both; repeated rows are counted
    alike, each for itself; an empty table gives an empty result; columns of
    other names pass through, one named n_tokens or n_bytes is replaced; a very
    long text is split like any other, only one text is held at a time.
    """
    from pyspark.sql.types import LongType, StructField, StructType

    model = model or default_model()
    # one vocabulary at most: its size does not grow with the data
    shared = docs.sparkSession.sparkContext.broadcast((model, proved_tokens(model)))
    slim, back = set_aside(docs, {"text": text}, ("n_bytes", "n_tokens"))
    slim = slim.withColumn("n_bytes", F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long"))
    schema = StructType([*slim.schema.fields, StructField("n_tokens", LongType(), False)])

    def run(batches):
        count = counter(*shared.value)
        for batch in batches:
            column = batch.column("text")
            n = pa.array([count(column[i].as_py()) for i in range(len(column))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, n], [*batch.schema.names, "n_tokens"])

    return back(slim.mapInArrow(run, schema))


def query(docs: DataFrame, limit: int = 4096) -> DataFrame:
    rows = token_counts(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
