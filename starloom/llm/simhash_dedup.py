"""SimHash near-dedup by the generalised pigeonhole principle.

Bits that vary together are grouped into the same partition.  For a query, the
thresholds T_1..T_m of the partitions may differ, -1 included, as long as their
sum is d - m + 1: two fingerprints within d bits then agree within T_i in some
partition i.  Dynamic programming picks, per fingerprint, the thresholds with
the fewest expected candidates, estimated from the exact histogram of every
partition's values.  Distinct fingerprints are all indexed and all used as
queries; candidates are verified by their whole distance inside the task, which
emits a spanning forest of the links instead of the links.

A partition value held by many fingerprints is cut into blocks by hash on both
sides, so that no task gets an unbounded group.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.joins import hot_pairs, salted_join
from .common import dealt, nullable_key, quoted, set_aside, written
from .links import components, forest

#: Rows of one side of a probed value that meet in one place, about.
BLOCK = 1024
#: Candidate pairs checked at once in a task.
PAIRS = 2_000_000
#: Rows of one component that one task names, about.
ROOT_ROWS = 1_000_000
#: Largest threshold of one partition, unless the distance needs more; wide partitions have large balls.
MOST, MOST_WIDE = 3, 2


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The 64-bit SimHash of a text's word shingles (unsigned; 0 without words)."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not w:
        return 0
    if len(w) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(w), 42)
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    starts, ends = starts[:len(w) - shingle + 1].tolist(), ends[shingle - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 65536):
        part = zip(starts[at:at + 65536], ends[at:at + 65536])
        h = np.array([digest(joined[s:e], 42) for s, e in part], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", out: str = "__fp", shingle: int = 4) -> DataFrame:
    """Every row without its text, with the fingerprint as a signed long."""
    slim, back = set_aside(docs, {"text": text}, (out,))
    schema = StructType([slim.schema["__rest"], StructField(out, LongType(), False)])

    def run(batches):
        for batch in batches:
            f = np.array([fingerprint(v.as_py(), shingle) for v in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("__rest"), pa.array(f)], ["__rest", out])

    return back(slim.select("__rest", "text").mapInArrow(run, schema), text)


def bit_partitions(distinct: DataFrame, parts: int) -> list[list[int]]:
    """Bits grouped by correlation over all fingerprints: each partition starts
    from a free bit and takes the free bit most correlated with its members."""
    def run(batches):
        both, n = np.zeros((64, 64)), 0
        for batch in batches:
            f = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False))
            bits = np.unpackbits(f.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            both += bits.T @ bits
            n += len(f)
        i, j = np.divmod(np.arange(4096), 64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[i, 64], pa.int64()), pa.array(np.r_[j, 64], pa.int64()), pa.array(np.r_[both.ravel(), n].astype(np.int64))], ["i", "j", "n"])

    # 4097 sums come back, whatever the data
    sums = distinct.mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both, n = np.zeros((64, 64)), 1
    for r in sums:
        if r["i"] == 64:
            n = max(1, r["n"])
        else:
            both[r["i"], r["j"]] = r["n"]
    mean = np.diag(both) / n
    dev = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs(both / n - np.outer(mean, mean)) / np.outer(dev, dev)
    np.fill_diagonal(corr, 0)
    free, out = list(range(64)), []
    for p in range(parts):
        width = (64 - sum(map(len, out))) // (parts - p)
        mine = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(mine[0])
        while len(mine) < width:
            best = max(free, key=lambda b: (corr[b, mine].sum(), -b))
            mine.append(best)
            free.remove(best)
        out.append(sorted(mine))
    return out


def _values(fps: np.ndarray, groups: list[list[int]]) -> list[np.ndarray]:
    """Each partition's bits of every fingerprint as one number."""
    f = fps.view(np.uint64)
    out = []
    for bits in groups:
        v = np.zeros(len(f), np.int64)
        for k, b in enumerate(bits):
            v |= ((f >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
        out.append(v)
    return out


def _masks(width: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.int64)


def allocate(values: list[np.ndarray], expected: list[list[np.ndarray]], sizes: list[list[int]], budget: int) -> list[np.ndarray]:
    """Per fingerprint the thresholds T_i >= -1 with sum ``budget`` and the least
    cost: probes plus expected candidates.  ``expected[i][t]`` has, for every
    value of partition i, the fingerprints within t bits of it."""
    n, m = len(values[0]), len(values)
    low, high = -m, budget + m
    cost = {0: np.zeros(n)}
    choice: list[dict[int, np.ndarray]] = []
    for i in range(m):
        price = [np.zeros(n)] + [expected[i][t][values[i]] + sizes[i][t] for t in range(len(sizes[i]))]
        nxt, how = {}, {}
        for s, c in cost.items():
            for t in range(-1, len(sizes[i])):
                to = s + t
                if not low <= to <= high:
                    continue
                new = c + price[t + 1]
                if to not in nxt:
                    nxt[to], how[to] = new, np.full(n, t)
                else:
                    better = new < nxt[to]
                    nxt[to] = np.where(better, new, nxt[to])
                    how[to] = np.where(better, t, how[to])
        cost = nxt
        choice.append(how)
    left, out = np.full(n, budget), [None] * m
    for i in reversed(range(m)):
        t = np.zeros(n, np.int64)
        for s, how in choice[i].items():
            here = left == s
            t[here] = how[here]
        out[i] = t
        left = left - t
    return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A spread-out hash of fingerprints, for cutting hot values into blocks."""
    h = (x.view(np.uint64) ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) >> np.uint64(8)


def similar_links(distinct: DataFrame, distance: int = 4, parts: int = 4) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints
    within ``distance`` bits.  ``distinct``: one column of signed longs, no repeats.

    ``parts``: n fingerprints put about n / 2^(64/parts) of them behind a partition
    value.  4 suits up to some 10^8; beyond, 3 has values of 21 bits, more of them
    to probe per fingerprint, and histograms of 8 million values (100 MB broadcast,
    whatever n is)."""
    if not 3 <= parts <= 8:
        raise ValueError("parts must be 3 to 8: a partition's histogram has 2^(64/parts) values")
    groups = bit_partitions(distinct, parts)

    def tally(batches):
        count = [np.zeros(1 << len(g), np.int64) for g in groups]
        for batch in batches:
            for c, v in zip(count, _values(np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)), groups)):
                np.add.at(c, v, 1)
        for p, c in enumerate(count):
            v = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), p), pa.int64()), pa.array(v, pa.int64()), pa.array(c[v])], ["p", "v", "n"])

    # at most parts * 2^(64/parts) sums, whatever the data
    histogram = distinct.mapInArrow(tally, "p long, v long, n long").groupBy("p", "v").agg(F.sum("n").alias("n")).toArrow()
    count = [np.zeros(1 << len(g), np.int64) for g in groups]
    hp, hv, hn = (histogram.column(c).to_numpy() for c in ("p", "v", "n"))
    for p in range(parts):
        count[p][hv[hp == p]] = hn[hp == p]
    budget = distance - parts + 1
    # sums below zero need no probe beyond (-1, ..): every partition may then be skipped but enough of them
    wide = len(groups[-1]) > 16
    # as large as the distance needs: the thresholds must be able to reach the budget
    most = max(0, min(MOST_WIDE if wide else MOST, budget + parts - 1), -(-budget // parts))
    masks = [[_masks(len(g), t) for t in range(most + 1)] for g in groups]
    expected = []
    for p, c in enumerate(count):
        every = np.arange(len(c))
        table, at = [c], len(masks[p][0])
        for t in range(1, most + 1):
            more = table[-1].copy()
            for mask in masks[p][t][at:]:
                more += c[every ^ mask]
            at = len(masks[p][t])
            table.append(more)
        expected.append([t.astype(np.float32) for t in table] if wide else table)
    shared = distinct.sparkSession.sparkContext.broadcast((groups, expected))

    def probe(batches):
        groups, expected = shared.value

        def blocks(p, v, radius):
            """Blocks of a value: of its index rows (0), of its queries (1)."""
            t = expected[p][min(radius, len(expected[p]) - 1)]
            return np.maximum(1, -(-t[v] // BLOCK)).astype(np.int64)

        def rows(p, f, v, kind):
            """A row per block of the other side."""
            mine = (_mix(f, kind + 1) % blocks(p, v, kind).astype(np.uint64)).astype(np.int64)
            copies = blocks(p, v, 1 - kind)
            at = np.repeat(np.arange(len(f)), copies)
            turn = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
            ib, qb = (mine[at], turn) if kind == 0 else (turn, mine[at])
            key = (np.int64(p) << 32) | v[at]
            return pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(ib), pa.array(qb), pa.array(np.full(len(at), kind, np.int64)), pa.array(f[at])],
                ["key", "ib", "qb", "kind", "fp"])

        for batch in batches:
            for cut in range(0, batch.num_rows, 4096):
                f = np.ascontiguousarray(batch.column(0).slice(cut, 4096).to_numpy(zero_copy_only=False))
                values = _values(f, groups)
                chosen = allocate(values, expected, [[len(m) for m in ms] for ms in masks], budget)
                for p in range(len(groups)):
                    yield rows(p, f, values[p], 0)
                    for t in range(most + 1):
                        q = chosen[p] == t
                        if q.any():
                            ball = masks[p][t]
                            yield rows(p, np.repeat(f[q], len(ball)), (values[p][q][:, None] ^ ball[None, :]).ravel(), 1)

    def verify(batches):
        """Sorted rows: meet every value's queries with its index rows."""
        held: list = []

        def links(key, kind, fp):
            head = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
            size = np.diff(np.r_[head, len(key)])
            n0 = np.add.reduceat((kind == 0).astype(np.int64), head)
            q = np.flatnonzero(kind == 1)
            group = np.repeat(np.arange(len(head)), size)
            width = n0[group[q]]
            q, width = q[width > 0], width[width > 0]
            upto = np.cumsum(width)
            at, out_a, out_b = 0, [], []
            while at < len(q):
                done = upto[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
                w = width[at:to]
                who = np.repeat(q[at:to], w)
                turn = np.arange(len(who)) - np.repeat(np.cumsum(w) - w, w)
                cand = head[group[who]] + turn
                a, b = fp[who], fp[cand]
                near = (a > b) & (np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= distance)
                x, y = forest(a[near], b[near])
                out_a.append(x)
                out_b.append(y)
                at = to
            if out_a:
                return forest(np.concatenate(out_a), np.concatenate(out_b))
            return fp[:0], fp[:0]

        def flush(final):
            key = np.concatenate([h[0] for h in held])
            kind = np.concatenate([h[1] for h in held])
            fp = np.concatenate([h[2] for h in held])
            end = len(key) if final else int(np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])[-1])
            held[:] = [(key[end:], kind[end:], fp[end:])] if end < len(key) else []
            return links(key[:end], kind[:end], fp[:end]) if end else (fp[:0], fp[:0])

        for batch in batches:
            if not batch.num_rows:
                continue
            col = lambda c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)  # noqa: E731,B023
            held.append((np.stack([col("key"), col("ib"), col("qb")], 1), col("kind"), col("fp")))
            if sum(len(h[0]) for h in held) >= 50_000:
                x, y = flush(False)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])
        if held:
            x, y = flush(True)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    probes = distinct.mapInArrow(probe, "key long, ib long, qb long, kind long, fp long")
    met = dealt(probes, "key", "ib", "qb").sortWithinPartitions("key", "ib", "qb", "kind")
    return met.mapInArrow(verify, "a long, b long")


def simhash_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4, distance: int = 4,
                   parts: int = 4) -> DataFrame:
    """Every row of ``docs`` without its text: ``__th`` (hash of the text),
    fingerprint (16 hex digits), component_id (smallest id reached), __root.

    Defined cases: a null, empty or blank text has fingerprint zero, linked like
    any other; a null id never names a component unless all its ids are null;
    repeated rows have equal fingerprints and each keeps its row; an empty table
    gives an empty result; input columns named like an added one are replaced;
    a very long text is hashed whole, 65,536 shingles at a time.
    """
    slim = docs.drop("fingerprint", "component_id").withColumn("__th", F.xxhash64(quoted(text)))
    rows = written(fingerprints(slim, text, "__fp", shingle))
    each = written(rows.groupBy("__fp").agg(F.min(doc_id).alias("__min")))
    found = components(similar_links(each.select("__fp"), distance, parts))
    linked = each.join(found, each["__fp"] == found["node"]).select("__fp", F.col("root").alias("__root"), "__min")
    least = linked.groupBy("__root").agg(F.min("__min").alias("component_id"))
    # a component may hold a third of all fingerprints: a hot root is cut
    named = salted_join(linked, least, "__root", hot=hot_pairs(linked, least, "__root", ROOT_ROWS)).select("__fp", "__root", "component_id")
    alone = each.join(found, each["__fp"] == found["node"], "left_anti").select("__fp", F.col("__fp").alias("__root"), F.col("__min").alias("component_id"))
    named = named.unionByName(alone).withColumnRenamed("__fp", "__fp2")
    return rows.join(named, rows["__fp"] == named["__fp2"]).withColumn(
        "fingerprint", F.lower(F.lpad(F.hex("__fp"), 16, "0"))).drop("__fp", "__fp2")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each group: the smallest id, then text hash.

    The groups decide on narrow rows.  The documents move once: rows of one id and
    text become one, combined before they are shuffled, and meet the kept keys
    where that shuffle has put them."""
    own = {"__id": nullable_key(quoted(doc_id)), "__th": F.xxhash64(quoted(text))}
    groups = simhash_groups(docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")), **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("__th").alias("th")))
    kept = groups.groupBy("__root").agg(first.alias("f")).select(nullable_key(F.col("f.id")).alias("__id"), F.col("f.th").alias("__th"))
    whole = F.struct(*[quoted(c).alias(f"_{i}") for i, c in enumerate(docs.columns)])
    once = docs.select(*[c.alias(name) for name, c in own.items()], whole.alias("__row")).dropDuplicates(["__id", "__th"])
    rows = once.join(kept, ["__id", "__th"], "left_semi")
    return rows.select(*[F.col("__row").getField(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def query(docs: DataFrame) -> DataFrame:
    return simhash_groups(docs.select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")
