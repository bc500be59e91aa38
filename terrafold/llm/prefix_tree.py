"""N-gram Jaccard join with prefix trees.

Documents become sets of word n-grams in one global order, frequent n-grams last. By the prefix
rule two sets that are similar enough share one of their first n-grams, so documents meet in the
neighbourhoods those n-grams span. A neighbourhood's sets are stored in a trie; a set walks down
it, shares the overlap of common beginnings, and leaves every subtree whose remaining lengths can
no longer reach the threshold or that holds only sets it is already connected with.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import fresh_path
from .arrays import WordHasher, joined_hashes, lower_table, mixed, rounds, spaced_table, word_spans

#: Words of an n-gram and least similarity in percent.
NGRAM, PERCENT = 4, 85
#: Counters of the frequency sketch that orders n-grams. Its size changes the order, never the result.
SKETCH_BITS = 22
_SKETCH_PARTS = 64
#: N-grams and sets of one neighbourhood that make a block; larger ones are joined block by block.
BLOCK_GRAMS, BLOCK_SETS = 1_000_000, 2000
#: Flags of the filter that tells tasks which sets have neighbours at all.
FILTER_BITS = 1 << 24


def ordered_sets(texts: pa.Array, ngram: int) -> Iterator[np.ndarray]:
    """Distinct n-gram hashes of each text, sorted; one of all words if there are fewer."""
    hasher, lower, table = WordHasher(), lower_table(), spaced_table()
    for _, _, data, offsets in rounds(texts):
        data = lower[data]
        starts, ends, first = word_spans(data, offsets, table)
        words = hasher(data, starts, ends)
        grams = joined_hashes(words, ngram)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= ngram:
                yield np.unique(grams[a : b - ngram + 1])
            elif b > a:
                yield joined_hashes(words[a:b], b - a)
            else:
                yield np.zeros(0, np.uint64)


def required(size: int, percent: int) -> int:
    """Least overlap of a set with any partner that is similar enough."""
    return -(-size * percent // 100)


def parity_bits(grams: np.ndarray) -> bytes:
    """One bit for each value of the hash's upper bits: how many n-grams have it, modulo 2.

    Two sets differ in at least as many n-grams as their bits differ. There are about as many bits
    as n-grams; of sets of unequal size the longer bits are folded onto the shorter.
    """
    size = max(64, 1 << (len(grams) - 1).bit_length())
    place = ((grams >> np.uint64(32)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=size) & 1).tobytes()


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, ngram: int) -> DataFrame:
    """(_id, n, fp, key, bits) of every row: set size, the set's digest, its short key and parity bits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, keys, bits = [], [], [], []
            for grams in ordered_sets(batch.column("_text"), ngram):
                sizes.append(len(grams))
                prints.append(_print_of(grams) if len(grams) else None)
                keys.append(_key_of(prints[-1]) if len(grams) else None)
                bits.append(parity_bits(grams) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(keys, pa.int64()),
                    pa.array(bits, pa.binary()),
                ],
                ["_id", "n", "fp", "key", "bits"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(scan, "_id long, n long, fp binary, key long, bits binary")


def frequency_sketch(docs: DataFrame, text_col: str, ngram: int) -> np.ndarray:
    """Counts of all n-grams of all documents, summed by the low bits of their hashes."""
    width = (1 << SKETCH_BITS) // _SKETCH_PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for grams in ordered_sets(batch.column("_text"), ngram):
                np.add.at(total, (grams & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), 1)
        yield part_batch(total.reshape(_SKETCH_PARTS, width))

    def part_batch(parts: np.ndarray) -> pa.RecordBatch:
        counts = [p.astype(np.uint32 if p.max() < 1 << 32 else np.uint64) for p in parts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(parts)), pa.int32()),
                pa.array([c.itemsize for c in counts], pa.int32()),
                pa.array([c.tobytes() for c in counts], pa.binary()),
            ],
            ["part", "bytes", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], f"u{row['bytes']}").astype(np.int64)
                sums[row["part"]] = sums.get(row["part"], 0) + counts
        for part, total in sums.items():
            out = part_batch(total[None, :])
            yield out.set_column(0, "part", pa.array([part], pa.int32()))

    schema = "part int, bytes int, counts binary"
    parts = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, schema).repartition("part").mapInArrow(add, schema)
    out = np.zeros((_SKETCH_PARTS, width), np.uint64)
    # A fixed number of parts of fixed size, whatever the corpus.
    for row in parts.collect():
        out[row["part"]] = np.frombuffer(row["counts"], f"u{row['bytes']}")
    return np.minimum(255, np.log2(out.ravel() + 1.0) * 8).astype(np.uint8)


class Trie:
    """Globally ordered sets in a prefix tree, one node for each shared run of members."""

    def __init__(self, sets: list[np.ndarray], owners: np.ndarray) -> None:
        """``sets`` hold local numbers in global order; ``owners`` are the sets' own numbers."""
        order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        self.owner = owners[order]
        sets = [sets[i] for i in order]
        parent, begin, stop, leaf, source = [-1], [0], [0], [-1], [-1]
        stack = [0]
        depth = [0]
        for i, own in enumerate(sets):
            shared = 0
            if i:
                m = min(len(own), len(sets[i - 1]))
                unequal = np.flatnonzero(own[:m] != sets[i - 1][:m])
                shared = int(unequal[0]) if len(unequal) else m
            while depth[-1] > shared:
                node = stack.pop()
                depth.pop()
                if depth[-1] < shared:
                    # The run is cut where the new set leaves it.
                    parent.append(stack[-1])
                    begin.append(begin[node])
                    stop.append(shared)
                    leaf.append(-1)
                    source.append(source[node])
                    parent[node], begin[node] = len(parent) - 1, shared
                    stack.append(len(parent) - 1)
                    depth.append(shared)
            parent.append(stack[-1])
            begin.append(shared)
            stop.append(len(own))
            leaf.append(i)
            source.append(i)
            stack.append(len(parent) - 1)
            depth.append(len(own))
        self.parent = np.array(parent)
        self.depth = np.array(stop)
        self.leaf = np.array(leaf)
        n = len(parent)
        kids = np.argsort(self.parent[1:], kind="stable") + 1
        self.kids = kids
        self.first_kid = np.searchsorted(self.parent[kids], np.arange(n + 1))
        size = self.depth - np.array(begin)
        self.run_at = np.concatenate([[0], np.cumsum(size)])
        self.run = np.concatenate([sets[s][b:e] for s, b, e in zip(source, begin, stop, strict=True) if s >= 0] or [np.zeros(0, np.int64)])
        self.last = np.array([sets[s][e - 1] if s >= 0 and e else -1 for s, e in zip(source, stop, strict=True)])
        length = np.array([len(s) for s in sets])
        self.shortest = np.where(self.leaf >= 0, length[self.leaf], np.iinfo(np.int64).max)
        self.longest = np.where(self.leaf >= 0, length[self.leaf], 0)
        # Children before parents.
        self.up = [(i, parent[i]) for i in sorted(range(1, n), key=lambda i: -stop[i])]
        low, high = self.shortest.tolist(), self.longest.tolist()
        for i, p in self.up:
            low[p], high[p] = min(low[p], low[i]), max(high[p], high[i])
        self.shortest, self.longest = np.array(low), np.array(high)

    def group_of_subtree(self, group_of: np.ndarray) -> np.ndarray:
        """The one component of all sets below each node, or -1 if there are several."""
        found = np.where(self.leaf >= 0, group_of[self.owner[self.leaf]], -2).tolist()
        for i, p in self.up:
            if found[p] == -2:
                found[p] = found[i]
            elif found[p] != found[i]:
                found[p] = -1
        return np.array(found)

    def partners(self, own: np.ndarray, member: np.ndarray, percent: int, skip: np.ndarray, group: int) -> np.ndarray:
        """Numbers of the sets similar to ``own``; subtrees wholly of ``group`` are left out.

        ``member`` is a scratch array of flags by local number.
        """
        member[own] = True
        n = len(own)
        nodes, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        hits = [np.zeros(0, np.int64)]
        while len(nodes):
            counts = self.first_kid[nodes + 1] - self.first_kid[nodes]
            ends = np.cumsum(counts)
            if not len(ends) or not ends[-1]:
                break
            step = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
            below = self.kids[np.repeat(self.first_kid[nodes], counts) + step]
            shared = np.repeat(overlap, counts)
            keep = skip[below] != group
            # Length bound: no set below can be similar enough by size alone.
            keep &= (100 * self.longest[below] >= percent * n) & (percent * self.shortest[below] <= 100 * n)
            below, shared = below[keep], shared[keep]
            if not len(below):
                break
            a, b = self.run_at[below], self.run_at[below + 1]
            size = b - a
            stops = np.cumsum(size)
            places = np.arange(stops[-1]) - np.repeat(stops - size, size) + np.repeat(a, size)
            seen = np.concatenate([[0], np.cumsum(member[self.run[places]])])
            shared = shared + seen[stops] - seen[stops - size]
            # Remaining length bound: even if all that is left on both sides were common.
            left = n - np.searchsorted(own, self.last[below], "right")
            most = shared + np.minimum(left, self.longest[below] - self.depth[below])
            least = np.maximum(self.shortest[below], shared)
            keep = (100 + percent) * most >= percent * (n + least)
            below, shared = below[keep], shared[keep]
            at = self.leaf[below] >= 0
            ends_here, common = below[at], shared[at]
            total = n + self.depth[ends_here]
            similar = 100 * common >= percent * (total - common)
            hits.append(self.owner[self.leaf[ends_here[similar]]])
            nodes, overlap = below, shared
        member[own] = False
        return np.concatenate(hits)


def forest(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect all similar sets of two blocks, given by numbers in ``sets``.

    Not one link per pair: sets that are connected already are not looked at again.
    """
    trie = Trie([sets[i] for i in right], right)
    member = np.zeros(1 + max((int(s.max()) for s in sets if len(s)), default=0), bool)
    group_of = np.arange(len(sets))
    links: list[tuple[int, int]] = []
    skip, stale = trie.group_of_subtree(group_of), 0
    for i in left.tolist():
        for j in trie.partners(sets[i], member, percent, skip, int(group_of[i])).tolist():
            a, b = group_of[i], group_of[j]
            if a != b:
                links.append((i, j))
                group_of[group_of == max(a, b)] = min(a, b)
                stale += 1
        if stale >= 8:
            skip, stale = trie.group_of_subtree(group_of), 0
    return links


def _filter_of(keys: DataFrame) -> np.ndarray:
    """Flags by the first bytes of each key; the driver gets at most one row per 64 of them."""
    place = F.conv(F.hex(F.substring("fp", 1, 4)), 16, 10).cast("long").bitwiseAND(FILTER_BITS - 1)
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    rows = keys.select(place.alias("place")).groupBy(F.expr("place div 64").alias("at")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    for row in rows.toLocalIterator():
        out[row["at"]] = row["bits"] % (1 << 64)
    return out


def _print_of(grams: np.ndarray) -> bytes:
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest()


def _key_of(fp: bytes) -> int:
    return int.from_bytes(fp[:8], "little", signed=True)


def postings(docs: DataFrame, sketch: np.ndarray, text_col: str, ngram: int, percent: int) -> DataFrame:
    """(token, key): the prefix n-grams of every distinct set.

    Sets go by short keys here; sets that share one by chance only become neighbours.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = shared.value, set()
        for batch in batches:
            tokens, keys = [], []
            for grams in ordered_sets(batch.column("_text"), ngram):
                fp = _print_of(grams)
                if not len(grams) or fp in seen:
                    continue
                seen.add(fp)
                level = order[(grams & np.uint64(len(order) - 1)).astype(np.int64)]
                take = len(grams) - required(len(grams), percent) + 1
                tokens.append(grams[np.lexsort((grams, level))[:take]])
                keys.append(_key_of(fp))
            counts = np.array([len(t) for t in tokens], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens or [np.zeros(0, np.uint64)]).view(np.int64)),
                    pa.array(np.repeat(np.array(keys, np.int64), counts)),
                ],
                ["token", "key"],
            )

    return docs.select(F.col(text_col).alias("_text")).mapInArrow(scan, "token long, key long")


def needed_sets(docs: DataFrame, keys: DataFrame, sketch: np.ndarray, text_col: str, ngram: int) -> DataFrame:
    """(fp, grams): the globally ordered n-grams of the sets that ``keys`` names."""
    sc = docs.sparkSession.sparkContext
    wanted, shared = sc.broadcast(_filter_of(keys)), sc.broadcast(sketch)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, order, seen = wanted.value, shared.value, set()
        for batch in batches:
            prints, sets = [], []
            for grams in ordered_sets(batch.column("_text"), ngram):
                fp = _print_of(grams)
                place = int.from_bytes(fp[:4], "big") & (FILTER_BITS - 1)
                if not len(grams) or fp in seen or not int(flags[place >> 6]) >> (place & 63) & 1:
                    continue
                seen.add(fp)
                level = order[(grams & np.uint64(len(order) - 1)).astype(np.int64)]
                prints.append(fp)
                sets.append(grams[np.lexsort((grams, level))].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(sets, pa.binary())], ["fp", "grams"])

    found = docs.select(F.col(text_col).alias("_text")).mapInArrow(scan, "fp binary, grams binary")
    return found.join(keys, "fp", "left_semi").groupBy("fp").agg(F.first("grams").alias("grams"))


def _pairs(rows: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], ["a", "b"])


def neighbourhoods(posts: DataFrame) -> DataFrame:
    """(pivot, key): sets that share one of their prefix n-grams with a pivot set.

    Of the sets that share an n-gram the one of smallest key is the pivot, so that any two of them
    meet in its neighbourhood, and one cluster has few pivots however many n-grams it shares.
    """
    pivots = posts.groupBy("token").agg(F.min("key").alias("pivot"), F.max("key").alias("other"))
    pivots = pivots.filter(F.col("pivot") != F.col("other")).select("token", "pivot")
    return posts.join(pivots, "token").select("pivot", "key").distinct()


def units(near: DataFrame) -> DataFrame:
    """Rows of ``near`` by pairs of blocks of each neighbourhood; most have one block.

    Adds i, j (the pair of blocks that meet) and block (the row's own).
    """
    size = near.groupBy("pivot").agg(F.count("*").alias("sets"), F.sum("n").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    placed = near.join(size.select("pivot", blocks.alias("blocks")), "pivot")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")})
    return placed.drop("with", "blocks").repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """(i, j, rows) of each unit in a partition that is sorted by them."""
    unit, members = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in batch.slice(at, 256).to_pylist():
                key = (row["pivot"], row["i"], row["j"])
                if key != unit:
                    if len(members) > 1:
                        yield unit[1], unit[2], members
                    unit, members = key, []
                members.append(row)
    if len(members) > 1:
        yield unit[1], unit[2], members


def close_by_bits(rows: list[dict], i: int, j: int, percent: int) -> np.ndarray:
    """Which rows of a unit have a row beside them that size and parity bits leave possible."""
    sizes = np.array([r["n"] for r in rows])
    block = np.array([r["block"] for r in rows])
    bits = [np.frombuffer(r["bits"], np.uint64) for r in rows]
    words = np.array([len(b) for b in bits])
    kept = np.zeros(len(rows), bool)
    for width in np.unique(words):
        # Sets of this width, and the next one folded onto it: others are too unequal in size.
        own = np.flatnonzero(words == width)
        wide = np.flatnonzero(words == 2 * width)
        near = np.concatenate([own, wide])
        table = np.stack([bits[k] for k in own] + [bits[k][:width] ^ bits[k][width:] for k in wide])
        left, right = own[block[own] == i], near[block[near] == j]
        if i != j:
            left = np.concatenate([left, own[block[own] == j]])
            right = near
        where = {int(k): n for n, k in enumerate(near)}
        spot = np.array([where[int(k)] for k in right], np.int64)
        for k in left.tolist():
            apart = np.bitwise_count(table[spot] ^ table[where[k]]).sum(1, dtype=np.int64)
            n, m = sizes[k], sizes[right]
            fine = ((100 + percent) * apart <= (100 - percent) * (n + m)) & (percent * np.maximum(n, m) <= 100 * np.minimum(n, m))
            fine &= right != k
            if i != j:
                fine &= block[right] != block[k]
            if fine.any():
                kept[k] = True
                kept[right[fine]] = True
    return kept


def possible(near: DataFrame, percent: int) -> DataFrame:
    """(pivot, fp, n) of the rows of ``near`` (pivot, fp, n, bits) that may have a partner there."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for i, j, rows in _by_unit(batches):
            out += [r for r, kept in zip(rows, close_by_bits(rows, i, j, percent).tolist(), strict=True) if kept]
            if len(out) > 5000:
                yield batch_of(out)
                out = []
        yield batch_of(out)

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        kinds = (("pivot", pa.int64()), ("fp", pa.binary()), ("n", pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in kinds], [c for c, _ in kinds])

    return units(near).mapInArrow(scan, "pivot long, fp binary, n long").distinct()


def join_units(rows: DataFrame, sketch: np.ndarray, percent: int) -> DataFrame:
    """(a, b): links inside each unit. ``rows`` holds (pivot, fp, n, grams)."""
    shared = rows.sparkSession.sparkContext.broadcast(sketch)

    def links_of(members: list[dict], i: int, j: int) -> list[tuple[bytes, bytes]]:
        order = shared.value
        grams = [np.frombuffer(m["grams"], np.uint64) for m in members]
        universe = np.unique(np.concatenate(grams))
        level = order[(universe & np.uint64(len(order) - 1)).astype(np.int64)]
        rank = np.empty(len(universe), np.int64)
        rank[np.lexsort((universe, level))] = np.arange(len(universe))
        sets = [rank[np.searchsorted(universe, g)] for g in grams]
        block = np.array([m["block"] for m in members])
        found = forest(sets, np.flatnonzero(block == i), np.flatnonzero(block == j), percent)
        return [(members[a]["fp"], members[b]["fp"]) for a, b in found]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        for i, j, members in _by_unit(batches):
            out += links_of(members, i, j)
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return units(rows).mapInArrow(scan, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(fp, root): the smallest print each linked set can reach, by alternating star contraction.

    Every round is written to the shared folder. A node's smallest neighbour is a partial
    aggregate and comes back by a join, so a hub with any number of neighbours is no single row.
    """
    links = links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v").distinct()
    edges, before = _stored(links, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _stored(large.filter("u != v").distinct(), "large-star")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        edges = _stored(small, "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if state == before:
            return edges.select(F.col("u").alias("fp"), F.col("v").alias("root"))
        before = state


def jaccard_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    ngram: int = NGRAM,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Texts without words (null, empty, blank) have empty sets and are linked with nothing; a text of
    fewer than ``ngram`` words has one n-gram, all of them. Equal sets are one node of the graph,
    however many rows have them. component_id is the smallest id reachable; a null id is no
    smallest unless nothing else can be reached. No rows give no rows.
    """
    rows = _stored(fingerprints(docs, id_col, text_col, ngram), "prints")
    sketch = frequency_sketch(docs, text_col, ngram)
    posts = _stored(postings(docs, sketch, text_col, ngram, percent), "postings")
    marks = rows.filter("fp is not null").groupBy("fp", "key").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    near = neighbourhoods(posts).join(marks, "key").drop("key")
    near = _stored(possible(near, percent), "neighbourhoods")
    sets = needed_sets(docs, near.select("fp").distinct(), sketch, text_col, ngram)
    links = join_units(near.join(sets, "fp"), sketch, percent)
    roots = components(links)
    labelled = rows.drop("bits", "key").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = labelled.filter("root is not null").groupBy("root").agg(F.min("_id").alias("least"))
    out = labelled.join(least, "root", "left")
    return out.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component; rows without id stay.

    Rows that repeat that id stay together: equal texts are exact dedup's to drop.
    """
    groups = jaccard_components(docs, id_col=id_col, **options)
    kept = groups.filter(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("_kept")).distinct()
    known = docs.join(kept, docs[id_col] == kept["_kept"], "left_semi")
    return known.unionByName(docs.filter(F.col(id_col).isNull()))
