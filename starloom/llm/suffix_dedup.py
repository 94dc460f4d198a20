"""Suffix-array dedup of long byte strings that repeat anywhere in the corpus.

A string of ``length`` bytes that starts at two places shares, at both, the
place of the smallest of its first ``SPAN`` 16-byte hashes, its anchor, because
that place depends on the string alone.  So the starts of a text fall into runs
with one anchor each, about length/60 runs, and only runs whose anchor is
followed by the same bytes can hold equal strings.  Runs that are equal as a
whole are counted, map-side first; what is left are runs that share the bytes
behind the anchor but differ at an edge, and these go to suffix sorting.

Suffix sorting: runs of a class share a middle part, which becomes one symbol;
their different edges, ``GRAIN`` starts at a time, are concatenated and sorted by
the linear grouping construction (:func:`suffix_array`).  Equal strings are
neighbours in that order.  A class too large for one task is cut exactly: half
of the starts share a longer middle, which splits the class, down to classes of
one start whose members are all equal and need no sorting.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt, set_aside, stored
from .sentencepiece_codec import _groups

SPAN, GRAIN = 128, 32
#: Runs of a class that one task sorts together, at most.
CLASS = 1000
_MASK = (1 << 31) - 1


def suffix_array(symbols: list[int]) -> list[int]:
    """Start places of all suffixes in ascending order; linear time.

    First phase: groups of suffixes start as those with the same first symbol.
    From the highest group down, every member points to the nearest place on its
    left that lies in a lower group (its previous smaller one, by path
    compression).  The places pointed at leave their group for a new one just
    above it, higher the more members of the group follow them in a row: their
    known prefix grows by that many copies of the group's prefix.  At the end a
    suffix's group is that of its longest Lyndon prefix.  Second phase: in
    ascending order, every suffix places those whose Lyndon prefix ends where it
    starts, each at the front of its group.  No renaming, no recursion."""
    n = len(symbols)
    if not n:
        return []
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    members, size, below, above = [], [], [], []  # per group: places, prefix length, neighbours in order
    group = [0] * n
    top = -1
    for c in sorted(by_symbol):
        members.append(by_symbol[c])
        size.append(1)
        below.append(top)
        above.append(-1)
        if top >= 0:
            above[top] = len(members) - 1
        top = len(members) - 1
        for i in by_symbol[c]:
            group[i] = top
    left = list(range(n))  # own place while its group is not done, else a place to the left
    order: list[int] = []  # groups from the highest down
    at = top
    while at >= 0:
        mine = [i for i in members[at] if group[i] == at]
        if not mine:
            at = below[at]
            continue
        members[at] = mine
        order.append(at)
        for i in mine:
            left[i] = i - 1
        follows: dict[int, int] = {}
        for i in mine:
            p = i - 1
            while p >= 0 and left[p] != p:
                p = left[p]
            j = i  # shorten the way for later looks
            while j > p and left[j] != p:
                left[j], j = p, left[j]
            if p >= 0:
                follows[p] = follows.get(p, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for p, k in follows.items():
            parts.setdefault((k, group[p]), []).append(p)
        # right above the old group, those with fewer followers under those with more
        for k, old in sorted(parts, key=lambda x: -x[0]):
            new, higher = len(members), above[old]
            members.append(parts[k, old])
            size.append(size[old] + k * size[at])
            below.append(old)
            above.append(higher)
            below[higher] = above[old] = new
            for p in parts[k, old]:
                group[p] = new
        at = below[at]
    front, place = {}, 0
    for g in reversed(order):
        front[g] = place
        place += len(members[g])
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    for i in range(n):
        ends[i + size[group[i]]].append(i)
    out = [0] * n

    def settle(i):
        for j in ends[i]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1

    settle(n)
    for k in range(n):
        settle(out[k])
    return out


def anchored_runs(texts: list[bytes], length: int, span: int = SPAN):
    """(text, first start, last start, anchor) of every run of starts with one
    anchor, and the joined texts with the offset of each."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    offset = np.cumsum(size) - size
    joined = b"".join(texts) + bytes(2 * span + 32)
    n = len(joined) - 16
    word = np.ndarray((n + 8,), "<u8", joined, 0, (1,))
    with np.errstate(over="ignore"):
        h = word[:n] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += word[8:n + 8] * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    # the place in the low bits: of equal hashes the first is the smallest
    h = (h & np.uint64(~_MASK & 0xFFFFFFFFFFFFFFFF)) | np.arange(n, dtype=np.uint64)
    whole = -(-n // span) * span
    h = np.concatenate([h, np.full(whole - n, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, span)
    ahead = np.minimum.accumulate(h, axis=1).ravel()
    behind = np.minimum.accumulate(h[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = np.maximum(size - length + 1, 0)
    total = int(starts.sum())
    owner = np.repeat(np.arange(len(texts)), starts)
    at = np.arange(total) - np.repeat(np.cumsum(starts) - starts, starts) + offset[owner]
    anchor = (np.minimum(behind[at], ahead[at + span - 1]) & np.uint64(_MASK)).astype(np.int64)
    if not total:
        return joined, offset, *(np.zeros(0, np.int64) for _ in range(4))
    head = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1])])
    tail = np.r_[head[1:], total] - 1
    return joined, offset, owner[head], at[head], at[tail], anchor[head]


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def runs(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(k, place, a, w) per run: the text's key, where it is, hashes of the bytes
    every start of the run shares and of the whole run."""
    def run(batches):
        import xxhash

        digest, shared = xxhash.xxh64_intdigest, length - SPAN + 1
        for batch in batches:
            k = batch.column(batch.schema.get_field_index("k")).to_numpy(zero_copy_only=False)
            done = 0
            for texts in _groups(batch.column(batch.schema.get_field_index(text)), 1_000_000):
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
                joined, offset, owner, lo, hi, p = anchored_runs(raw, length)
                lo_, hi_, p_ = lo.tolist(), hi.tolist(), p.tolist()
                a = _signed([digest(joined[x:x + shared], 7) for x in p_])
                w = _signed([digest(joined[x:y + length], z - x) for x, y, z in zip(lo_, hi_, p_)])
                place = (lo - offset[owner]) << 16 | (hi - lo) << 8 | (p - lo)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (k[done:done + len(texts)][owner], place, a, w)], ["k", "place", "a", "w"])
                done += len(texts)

    return docs.select("k", text).mapInArrow(run, "k long, place long, a long, w long")


_EDGES = "c1 long, c2 long, left binary, right binary, k long, first long, many boolean"


def edges(docs: DataFrame, text: str, length: int) -> DataFrame:
    """Pieces of open runs, GRAIN starts at most: the class of the middle bytes
    they share (c1, c2), what precedes and follows it, and where they are.
    ``docs``: k, text and ``open``, the runs as (place, many)."""
    def run(batches):
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in batches:
            col = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731,B023
            for k, t, held in zip(col("k"), col(text), col("open")):
                raw, k = (t.as_py() or "").encode("utf-8", "surrogatepass"), k.as_py()
                out = []
                for place, many in {(r["place"], r["many"]) for r in held.as_py()}:
                    lo, last, ahead = place >> 16, place >> 8 & 255, place & 255
                    p = lo + ahead
                    for block in range((ahead - last) // GRAIN, ahead // GRAIN + 1):
                        j1, j2 = block * GRAIN, block * GRAIN + GRAIN - 1
                        near, far = max(ahead - last, j1), min(ahead, j2)  # starts p - far .. p - near
                        middle = raw[p - j1:p + length - j2]
                        out.append((digest(middle, block), digest(middle, 1000 + block), raw[p - far:p - j1],
                                    raw[p + length - j2:p + length - near], k, p - far, many))
                if out:
                    c1, c2, left, right, key, first, many = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_signed(c1)), pa.array(_signed(c2)), pa.array(left, pa.binary()), pa.array(right, pa.binary()),
                         pa.array(key, pa.int64()), pa.array(first, pa.int64()), pa.array(many, pa.bool_())],
                        ["c1", "c2", "left", "right", "k", "first", "many"])

    return docs.select("k", text, "open").mapInArrow(run, _EDGES)


def halves(rows: DataFrame, grain: int) -> DataFrame:
    """Pieces of large classes, cut into halves of ``grain`` / 2 starts whose
    longer middles tell them apart."""
    def run(batches):
        import xxhash

        half = grain // 2
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                left, right = r["left"], r["right"]
                last, first = len(left), grain - 1 - len(right)  # starts by distance before the middle
                seed = r["c1"].to_bytes(8, "little", signed=True) + r["c2"].to_bytes(8, "little", signed=True)
                if first < half:
                    top = min(last, half - 1)
                    out.append((seed + b"0" + right[:half], left[last - top:], right[half:], r["k"], r["first"] + last - top, r["many"]))
                if last >= half:
                    out.append((seed + b"1" + left[last - half:], left[:last - half], right[:grain - 1 - max(first, half)], r["k"], r["first"], r["many"]))
            if out:
                mid, left, right, k, first, many = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_signed([xxhash.xxh64_intdigest(m, s) for m in mid])) for s in (1, 2)] +
                    [pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(k, pa.int64()), pa.array(first, pa.int64()), pa.array(many, pa.bool_())],
                    ["c1", "c2", "left", "right", "k", "first", "many"])

    return rows.select("c1", "c2", "left", "right", "k", "first", "many").mapInArrow(run, _EDGES)


def repeated_starts(pieces: list[tuple[bytes, bytes, bool]], grain: int) -> list[list[int]]:
    """For the pieces (left, right, many) of one class, the starts of each (from
    0) whose string occurs at another start. ``many``: the piece is known to recur."""
    where: dict[tuple[bytes, bytes], list[int]] = {}
    for n, (left, right, _) in enumerate(pieces):
        where.setdefault((left, right), []).append(n)
    distinct = list(where)
    again = [len(where[d]) > 1 or any(pieces[n][2] for n in where[d]) for d in distinct]
    count = [len(d[0]) + len(d[1]) - grain + 2 for d in distinct]  # starts of a piece
    found = [set(range(c)) if a else set() for c, a in zip(count, again)]
    if len(distinct) > 1 and not all(again):
        # one symbol for the middle; a lower one ends a piece
        joined = "\x00".join((left.decode("latin-1") + "Ȁ" + right.decode("latin-1")).translate(_SHIFT) for left, right in distinct)
        owner, begin, at = [-1] * len(joined), [], 0
        for d, c in zip(distinct, count):
            begin.append(at)
            owner[at:at + c] = [len(begin) - 1] * c
            at += len(d[0]) + len(d[1]) + 2
        before, held = None, -1
        for i in suffix_array(list(map(ord, joined))):
            if owner[i] < 0:
                continue
            string = joined[i:i + grain]
            if string == before:
                for x in (i, held):
                    found[owner[x]].add(x - begin[owner[x]])
            before, held = string, i
    out: list[list[int]] = [[] for _ in pieces]
    for d, f in zip(distinct, found):
        for n in where[d]:
            out[n] = sorted(f)
    return out


#: Bytes move up by one, so that 0 is free to end a piece.
_SHIFT = {i: i + 1 for i in range(256)}


def _spans(starts: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in starts:
        if out and s == out[-1][1] + 1:
            out[-1][1] = s
        else:
            out.append([s, s])
    return out


def sort_classes(rows: DataFrame, grain: int) -> DataFrame:
    """(k, lo, hi): repeated starts found by suffix sorting, class by class."""
    def run(batches):
        held: list[dict] = []

        def settle(some):
            out, at = [], 0
            while at < len(some):
                to = at
                while to < len(some) and some[to]["c1"] == some[at]["c1"] and some[to]["c2"] == some[at]["c2"]:
                    to += 1
                mine = some[at:to]
                for r, starts in zip(mine, repeated_starts([(r["left"], r["right"], r["many"]) for r in mine], grain)):
                    if not r["many"]:
                        out += [(r["k"], r["first"] + a, r["first"] + b) for a, b in _spans(starts)]
                at = to
            return pa.RecordBatch.from_arrays([pa.array([o[x] for o in out], pa.int64()) for x in range(3)], ["k", "lo", "hi"])

        for batch in batches:
            held += batch.to_pylist()
            if not held:
                continue
            end = len(held)
            while end > 0 and held[end - 1]["c1"] == held[-1]["c1"] and held[end - 1]["c2"] == held[-1]["c2"]:
                end -= 1
            yield settle(held[:end])
            held = held[end:]
        if held:
            yield settle(held)

    met = rows.select("c1", "c2", "left", "right", "k", "first", "many")
    met = dealt(met, "c1", "c2").sortWithinPartitions("c1", "c2")
    return met.mapInArrow(run, "k long, lo long, hi long")


def repeated_intervals(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(k, lo, hi): starts of strings of ``length`` bytes that occur elsewhere."""
    if length < SPAN + GRAIN:
        raise ValueError(f"length must be at least {SPAN + GRAIN}")
    every = stored(runs(docs, text, length))
    # written, so that the join deals out both sides anew and can split a hot anchor
    shared = stored(every.groupBy(F.col("a").alias("a2")).agg(
        F.count(F.lit(1)).alias("n"), (F.min("w") == F.max("w")).alias("alike")).filter("n > 1").drop("n"))
    met = stored(every.join(shared, every["a"] == shared["a2"]).drop("a2"), every, shared)
    lo = F.shiftright("place", 16)
    hi = lo + F.shiftright("place", 8).bitwiseAND(255)
    whole = met.filter("alike").select("k", lo.alias("lo"), hi.alias("hi"))
    mixed = met.filter("not alike")
    each = stored(mixed.groupBy(F.col("a").alias("a2"), F.col("w").alias("w2")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "place")).alias("one")))
    many = each.filter("n > 1").select("a2", "w2")  # one row a key on this side
    whole = whole.unionByName(mixed.join(many, (F.col("a") == F.col("a2")) & (F.col("w") == F.col("w2"))).select("k", lo.alias("lo"), hi.alias("hi")))
    # one piece of each kind goes on; a class without any open one is done
    todo = stored(each.filter("n = 1").select(F.col("a2").alias("a3")).distinct())
    opened = each.join(todo, F.col("a2") == F.col("a3"), "left_semi").select(
        F.col("one.k").alias("k2"), F.col("one.place").alias("place"), (F.col("n") > 1).alias("many"))
    opened = opened.groupBy("k2").agg(F.collect_list(F.struct("place", "many")).alias("open"))  # within one text
    pieces = docs.join(opened, docs["k"] == opened["k2"]).dropDuplicates(["k"])
    rows = edges(pieces, text, length)
    found, grain = whole, GRAIN
    while True:
        rows = stored(rows)
        sizes = stored(rows.groupBy(F.col("c1").alias("d1"), F.col("c2").alias("d2")).agg(
            F.count(F.lit(1)).alias("n"), F.max((~F.col("many")).cast("int")).alias("some")).filter("n > 1 and some = 1"))
        rows = stored(rows.join(sizes, (F.col("c1") == F.col("d1")) & (F.col("c2") == F.col("d2"))).drop("d1", "d2", "some"), rows, sizes)
        if grain == 1:  # all members of a class are equal
            return found.unionByName(rows.select("k", F.col("first").alias("lo"), F.col("first").alias("hi")))
        found = found.unionByName(stored(sort_classes(rows.filter(F.col("n") <= CLASS), grain)))
        rows = rows.filter(F.col("n") > CLASS)
        if rows.isEmpty():
            return found
        rows, grain = halves(rows, grain), grain // 2


def suffix_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 200) -> DataFrame:
    """Every row of ``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and
    kept (the bytes that remain).

    Removed is each byte of a string of ``length`` bytes that also starts at
    another place of any text, its own included; strings are judged on the input.
    Texts are named by a 64-bit hash of id and text.  Defined cases: a null text
    is empty; texts shorter than ``length`` lose nothing; repeated rows are
    copies of each other, so both lose what is long enough; ties (equal strings)
    all go; an empty table gives an empty result; input columns named like an
    added one are replaced; a very long text is cut whole, one in memory.
    """
    from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

    added = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")
    slim, back = set_aside(docs, {"id": doc_id, "text": text}, added)
    name = F.xxhash64(F.lit("k"), F.col("id"), F.col("text"))
    found = repeated_intervals(slim.select(name.alias("k"), "text"), "text", length)
    per = found.groupBy(F.col("k").alias("__k2")).agg(F.collect_set(F.struct("lo", "hi")).alias("__gone"))  # within one text
    rows = slim.withColumn("__k", name).join(per, F.col("__k") == F.col("__k2"), "left")
    names = ["id", "text", "__rest"]
    schema = StructType([*slim.select(*names).schema.fields, StructField("n_bytes", LongType()), StructField("n_removed", LongType()),
                         StructField("n_spans", LongType()), StructField("kept_sha256", StringType()), StructField("kept", BinaryType())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for t, gone in zip(part.column("text"), part.column("__gone")):
                    raw, left, begin, removed, spans = (t.as_py() or "").encode("utf-8", "surrogatepass"), [], 0, 0, 0
                    end = -1
                    for x, y in sorted((g["lo"], g["hi"]) for g in gone.as_py() or ()):
                        y += length
                        if x > end:  # a new run of removed bytes
                            left.append(raw[max(begin, 0):x])
                            spans += 1
                            removed += y - x
                            end = begin = y
                        elif y > end:
                            removed += y - end
                            end = begin = y
                    left.append(raw[begin:])
                    kept = b"".join(left)
                    out.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in names] + [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                     pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                    [*names, *added])

    return back(rows.select(*names, "__gone").mapInArrow(run, schema))


def query(docs: DataFrame) -> DataFrame:
    return suffix_dedup(docs.select("doc_id", "text")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
