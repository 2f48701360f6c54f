"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact sorted-array intersection.

A text's set holds the 64-bit hashes of its distinct word n-grams (a text of fewer words: its whole sequence as
one). Texts with equal sets are one set, known by 128 bits of its digest and named by 64 of them. By prefix filtering, two sets of Jaccard
similarity t or more share a hash among the first n - ceil(t n) + 1 hashes of either in any order that all sets
agree on. The order here is by the number of sets that hold a hash, rare ones first, so that passages and phrases which
many texts share come last: most sets then have no shared hash among their first ones and are done.

The counts take one exchange. A block of texts is cut by hash into buckets; for each bucket one task sees all
hashes in it and sends the shared ones with their counts back to the block, which takes the first ones. A hash that many
texts of a block have travels once for the block.

Sets that have one of their first hashes in common form its list. A list falls into tiles by size band (sets whose sizes
differ more than t allows never meet) and, where a band is long, into blocks of bounded length; each pair of blocks is
one tile. Every set has a signature: a bit map in which bit i is the parity of the hashes that fall on i. The ones of the
exclusive-or of two signatures bound the symmetric difference from below, hence the overlap from above.

Only links between different components can change the result. First each set is verified against one set that heads
its lists; then in each tile against its best partner of another component, as long as that adds links by the fiftieth.
Sets that still have a partner which passes the bit count bring their sorted arrays to the tiles, where every such pair
of different components is intersected, each in the first list that the two share; links found join components at once. A
tile gives at most one link fewer than it has sets, and no passing pair between components stays unverified.

Defined cases: a null text, an empty one, or one of white space has an empty set, is linked with nothing and is its
own component; a row with a null id has n_shingles and a null component and links nothing; rows that share an id are
each compared by their own text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.sources.tables import read_table

from .common import components, discard, fresh, give_back, member_gate, settle, slices, small_batches, without

#: Sets of a tile's block, and the hashes that they hold together; a tile compares two blocks.
BLOCK, BLOCK_HASHES = 1024, 1 << 20
#: Shingles of a block of texts and of a bucket of hashes; sets of a block that make a hash travel once for all of them.
TEXT_BLOCK, BUCKET, OFTEN = 1 << 20, 1 << 18, 64
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9FB21C651E98DF25], dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = [x.encode("utf-8", "surrogatepass").lower().split() for x in texts]  # bytes: A-Z and ASCII white space only
    lengths = np.array([len(x) for x in split])
    flat = np.empty(int(lengths.sum()), dtype=object)
    at = 0
    for x in split:
        flat[at : at + len(x)] = x
        at += len(x)
    hashed = pd.util.hash_array(flat, categorize=False) if at else np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        window = hashed[: max(0, at - words + 1)] * _MIX[0]
        for i in range(1, words):
            window = _mixed(window) + hashed[i : i + len(window)] * _MIX[i % 8]
        window = _mixed(window)
    out, at = [], 0
    for n in lengths.tolist():
        if n >= words:
            out.append(np.unique(window[at : at + n - words + 1]))
        elif n:
            with np.errstate(over="ignore"):
                one = np.uint64(n) * _MIX[7]
                for h in hashed[at : at + n]:
                    one = _mixed(np.uint64(one)) + h * _MIX[6]
            out.append(np.array([_mixed(np.uint64(one))], dtype=np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def signature_bits(n: int) -> int:
    """A power of two of 0.6 to 1.2 n, 512 at least: random sets then differ in about twice the bits that the threshold lets through."""
    return max(512, min(1 << 15, 1 << max(0, int(n * 0.6)).bit_length()))


def band_of(n: np.ndarray, t: int) -> np.ndarray:
    """Sets whose sizes are in the ratio t / 100 at least are in the same band or in neighbouring ones."""
    return np.floor(np.log(n) / -np.log(t / 100.0 - 1e-9)).astype(np.int32)


def signature(hashes: np.ndarray, bits: int) -> bytes:
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def prefix_length(n: int, t: int) -> int:
    return n - -(-t * n // 100) + 1


def index_length(n: int, t: int) -> int:
    """The smaller of two similar sets has a shared hash among its first ones of this number already."""
    return n - -(-2 * t * n // (100 + t)) + 1


@dataclass(frozen=True)
class Naming:
    """How sets are named: by ``bits`` bits of their digest. Names in ``clash`` are those that different sets were found to share;
    such a set has the next bits."""

    clash: frozenset[int] = frozenset()
    bits: int = 64

    def names(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The names, and 64 other bits of each digest, which check them."""
        names, checks = np.empty(len(sets), np.int64), np.empty(len(sets), np.int64)
        for k, s in enumerate(sets):
            parts = [x >> (64 - self.bits) for x in struct.unpack("<8q", hashlib.blake2b(s.tobytes(), digest_size=64).digest())]
            names[k] = next((x for x in parts[:-1] if x not in self.clash), parts[-2]) if self.clash else parts[0]
            checks[k] = parts[-1]
        return names, checks

    def __call__(self, sets: list[np.ndarray]) -> np.ndarray:
        return self.names(sets)[0]


def _set_rows(words: int, names: list[str], naming: Naming):
    """What each row has beside its text, the size of its set, the set's name and what checks the name."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                sets = shingle_sets(texts, words)
                keys = naming.names(sets)
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(k, pa.int64()) for k in keys)], names=[*names, "n", "rep", "check"])
        give_back()

    return rows


def _named_sets(base: DataFrame, words: int, names: list[str], bits: int) -> tuple[DataFrame, DataFrame, Naming]:
    """(each row's set, one row a set, how they are named), the tables settled: sets are the same if 128 bits of their
    digests are. Of n sets about n * n / 2**65 share a name with another one (70 of 5 * 10**10); where any do, these get others."""
    schema = base.select(*names).schema.add("n", "long").add("rep", "long").add("check", "long")
    naming = Naming(bits=bits)
    while True:
        sets = settle(base.mapInArrow(_set_rows(words, names, naming), schema))
        own = sets.where("n > 0 AND id IS NOT NULL").groupBy("rep").agg(F.min("id").alias("low"), F.min("n").alias("n"), F.min("check").alias("check"), (F.min("check") != F.max("check")).alias("shared"))
        own = settle(own)
        found = [r.rep for r in own.where("shared").select("rep").limit(1 << 20).collect()]
        if not found:
            return sets, own.select("rep", "low", "n"), naming
        naming = Naming(naming.clash | set(found), bits)
        discard(sets)
        discard(own)


def _full_rows(words: int, naming: Naming):
    """The sets themselves, with their signatures."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, "text"):
                sets = [s for s in shingle_sets(texts, words) if len(s)]
                columns = [pa.array(naming(sets), pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([signature(s, signature_bits(len(s))) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["rep", "n", "sig", "hashes"])
        give_back()

    return rows


# ---- hashes in the order of how many sets hold them

_PACKED = "bucket int, block long, kind int, a binary, b binary, c binary, d binary"


def _binary(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _planes(values: np.ndarray) -> np.ndarray:
    """Sorted 32-bit numbers byte by byte, the highest bytes first: these repeat, which compression uses."""
    return np.ascontiguousarray(values.astype(">u4").view(np.uint8).reshape(-1, 4).T)


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).reshape(-1).view(">u4").astype(np.uint32)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _packed_rows(words: int, buckets: int, naming: Naming):
    """Of each block of texts a row per bucket with its hashes and the sets that hold them (kind 0: a hashes, b sets, c and d
    the hashes that many sets hold and how many), and one with what the block keeps (kind 1: a names of the sets, b their
    sizes, c hashes that many hold, d how many and which)."""

    def done(keys: np.ndarray, sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        block = int(Naming()([keys])[0])  # named by what it holds, so that a task that runs again names it alike
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        bucket = ((flat >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        flat = bucket << np.uint64(32) | flat & np.uint64(0xFFFFFFFF)
        order = np.argsort(flat, kind="stable")
        flat, holder = flat[order], np.repeat(np.arange(len(sets)), sizes)[order].astype(np.uint16)
        starts = _runs(flat)
        many = np.diff(np.append(starts, len(flat)))
        hot = many >= OFTEN
        single = ~np.repeat(hot, many)
        hot_keys, hot_many = flat[starts[hot]], many[hot].astype(np.int32)
        kept = np.concatenate([hot_many.view(np.uint8), holder[~single].view(np.uint8)])
        yield pa.RecordBatch.from_arrays([pa.array([block % buckets], pa.int32()), pa.array([block], pa.int64()), pa.array([1], pa.int32()), _binary([keys]), _binary([sizes]), _binary([hot_keys]), _binary([kept])], names=["bucket", "block", "kind", "a", "b", "c", "d"])
        flat, holder = flat[single], holder[single]
        edges = np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)
        at, hot_at = np.searchsorted(flat, edges).tolist(), np.searchsorted(hot_keys, edges).tolist()
        some = [b for b in range(buckets) if at[b] < at[b + 1] or hot_at[b] < hot_at[b + 1]]
        for k in range(0, len(some), 64):
            part = some[k : k + 64]
            low = [flat[at[b] : at[b + 1]].astype(np.uint32) for b in part]
            columns = [_binary([_planes(x) for x in low]), _binary([holder[at[b] : at[b + 1]] for b in part]), _binary([hot_keys[hot_at[b] : hot_at[b + 1]].astype(np.uint32) for b in part]), _binary([hot_many[hot_at[b] : hot_at[b + 1]] for b in part])]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([block] * len(part), pa.int64()), pa.array([0] * len(part), pa.int32()), *columns], names=["bucket", "block", "kind", "a", "b", "c", "d"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = {}, 0
        for batch in batches:
            for _, texts in slices(batch, "text"):
                sets = [s for s in shingle_sets(texts, words) if len(s)]
                for key, s in zip(naming(sets).tolist(), sets, strict=True):
                    if key not in held:
                        held[key] = s
                        total += len(s)
                if total >= TEXT_BLOCK or len(held) >= 1 << 15:
                    yield from done(np.array(list(held), np.int64), list(held.values()))
                    held, total = {}, 0
        if held:
            yield from done(np.array(list(held), np.int64), list(held.values()))
        held = None
        give_back()

    return rows


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(key).to_numpy()
        starts = _runs(values)
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(values)], strict=True):
            if held and held[0].column(key)[0].as_py() != values[lo]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _shared_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each bucket the hashes that two sets hold at least, for the blocks that have them: a hashes, b their sets (the last
    number: many), c how many sets hold them. What blocks keep is passed on."""
    for table in _groups(batches, "bucket"):
        own = table.filter(pa.compute.equal(table.column("kind"), 1)).combine_chunks()
        if own.num_rows:
            yield from own.to_batches()
        table = table.filter(pa.compute.equal(table.column("kind"), 0))
        if not table.num_rows:
            continue
        bucket, blocks = table.column("bucket")[0].as_py(), table.column("block").to_numpy()
        low, holder, hot, hot_many = (table.column(c).to_pylist() for c in "abcd")
        table = None
        low = [np.concatenate([_unplaned(x), np.frombuffer(y, np.uint32)]) for x, y in zip(low, hot, strict=True)]
        sizes = [len(x) for x in low]
        holder = np.concatenate([np.append(np.frombuffer(x, np.uint16), np.full(len(y) // 4, 0xFFFF, np.uint16)) for x, y in zip(holder, hot, strict=True)])
        many = np.concatenate([np.append(np.ones(len(x) - len(y) // 4, np.int32), np.frombuffer(y, np.int32)) for x, y in zip(low, hot_many, strict=True)])
        low, row = np.concatenate(low), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        order = np.argsort(low, kind="stable")
        starts = _runs(low[order])
        held = np.add.reduceat(many[order], starts, dtype=np.int64)
        times = np.diff(np.append(starts, len(order)))
        shared = np.repeat(held >= 2, times)
        order, held = order[shared], np.repeat(held, times)[shared]
        by_row = np.argsort(row[order], kind="stable")
        order, held = order[by_row], np.minimum(held[by_row], 0xFFFFFFFF).astype(np.uint32)
        starts = _runs(row[order]) if len(order) else np.empty(0, np.int64)
        spans = list(zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=False))
        for k in range(0, len(spans), 256):
            part = spans[k : k + 256]
            at = [order[x:y] for x, y in part]
            columns = [_binary([low[i] for i in at]), _binary([holder[i] for i in at]), _binary([held[x:y] for x, y in part]), pa.nulls(len(part), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(part), pa.int32()), pa.array([blocks[row[i[0]]] for i in at], pa.int64()), pa.array([0] * len(part), pa.int32()), *columns], names=["bucket", "block", "kind", "a", "b", "c", "d"])
    give_back()


def _first_rows(t: int):
    """Of each block the first hashes of its sets, as far as others hold them: tok, rep, n, and whether it is among the index."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "block"):
            own = table.filter(pa.compute.equal(table.column("kind"), 1)).slice(0, 1).to_pylist()[0]
            keys, sizes = np.frombuffer(own["a"], np.int64), np.frombuffer(own["b"], np.int64)
            table = table.filter(pa.compute.equal(table.column("kind"), 0))
            if not table.num_rows:
                continue
            low = [np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("a").to_pylist()]
            tok = np.concatenate([x | b << 32 for x, b in zip(low, table.column("bucket").to_pylist(), strict=True)])
            holder = np.concatenate([np.frombuffer(x, np.uint16) for x in table.column("b").to_pylist()]).astype(np.int64)
            held = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("c").to_pylist()])
            hot_keys = np.frombuffer(own["c"], np.int64)
            if len(hot_keys):
                hot_many = np.frombuffer(own["d"], np.int32, len(hot_keys))
                hot_sets = np.frombuffer(own["d"], np.uint16, offset=4 * len(hot_keys)).astype(np.int64)
                many = holder == 0xFFFF
                held_of = dict(zip(tok[many].tolist(), held[many].tolist(), strict=True))
                more = np.array([held_of[k] for k in hot_keys.tolist()], np.uint32)
                tok = np.concatenate([tok[~many], np.repeat(hot_keys, hot_many)])
                holder = np.concatenate([holder[~many], hot_sets])
                held = np.concatenate([held[~many], np.repeat(more, hot_many)])
            order = np.lexsort((tok, held, holder))
            tok, holder = tok[order], holder[order]
            begins = np.searchsorted(holder, np.arange(len(keys)))
            shared = np.diff(np.append(begins, len(holder)))
            new = np.ones(len(tok), bool)
            new[1:] = (tok[1:] != tok[:-1]) | (holder[1:] != holder[:-1])
            nth = np.arange(len(tok)) - begins[holder]
            place = sizes[holder] - shared[holder] + nth  # hashes of its own come before
            prefix, index = (np.array([f(n, t) for n in sizes.tolist()]) for f in (prefix_length, index_length))
            keep = np.flatnonzero(new & (place < prefix[holder]))
            some = holder[keep]
            yield pa.RecordBatch.from_arrays([pa.array(tok[keep]), pa.array(keys[some]), pa.array(sizes[some]), pa.array(place[keep] < index[some])], names=["tok", "rep", "n", "first"])
        give_back()

    return rows


def first_hashes(texts: DataFrame, shingles: int, words: int, t: int, naming: Naming) -> DataFrame:
    """tok, rep, n, first: of each set of ``texts`` the hashes among its first ones that other sets hold too. ``shingles`` is
    how many there are in all, by which buckets have a bounded size."""
    buckets = max(16, -(-shingles // BUCKET))
    packed = texts.select("text").mapInArrow(_packed_rows(words, buckets, naming), _PACKED)
    shared = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared_rows, _PACKED)
    return shared.repartition("block").sortWithinPartitions("block").mapInArrow(_first_rows(t), "tok long, rep long, n long, first boolean")


# ---- pairs


def similar(a: np.ndarray, b: np.ndarray, t: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= t * (len(a) + len(b) - both)


def _overlaps(t: int):
    """Keeps the pairs (a, b, set_a, set_b) with 100 |A and B| >= t |A or B|."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                keep.append(similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), t))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return rows


def _ones(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int32)


def _folded(sigs: np.ndarray, bits: int) -> np.ndarray:
    """Rows of signatures of one width, folded to ``bits`` by exclusive-or (parities add up)."""
    words = bits // 64
    while sigs.shape[1] > words:
        half = sigs.shape[1] // 2
        sigs = sigs[:, :half] ^ sigs[:, half:]
    return sigs


def passing(n_a: np.ndarray, n_b: np.ndarray, ones: np.ndarray, t: int) -> np.ndarray:
    """Pairs whose upper bound of the overlap, (|A| + |B| - ones) / 2, still allows the similarity t."""
    most = (n_a[:, None] + n_b[None, :] - ones) // 2
    return (100 * most >= t * (n_a[:, None] + n_b[None, :] - most)) & (100 * np.minimum(n_a[:, None], n_b[None, :]) >= t * np.maximum(n_a[:, None], n_b[None, :]))


def _stacked(sigs: list[bytes], bits: int) -> np.ndarray:
    return _folded(np.frombuffer(b"".join(sigs), np.uint64).reshape(len(sigs), -1), bits)


def _block_pairs(A: dict, B: dict, own: bool, t: int) -> list[tuple]:
    """(place in A, place in B, ones) of the pairs of different components, one of each block, that pass the bit count."""
    out = []
    width_a, width_b = (np.fromiter(map(len, X["sig"]), np.int64, len(X["sig"])) for X in (A, B))
    for wa in np.unique(width_a):
        ia = np.flatnonzero(width_a == wa)
        for wb in np.unique(width_b):
            ib = np.flatnonzero(width_b == wb)
            bits = int(min(wa, wb)) * 8
            sig_b = _stacked([B["sig"][k] for k in ib], bits)
            step = max(1, (1 << 21) // max(1, len(ib) * bits // 64))
            for at in range(0, len(ia), step):
                some = ia[at : at + step]
                ones = _ones(_stacked([A["sig"][k] for k in some], bits), sig_b)
                ok = passing(A["n"][some], B["n"][ib], ones, t) & (A["comp"][some][:, None] != B["comp"][ib][None, :])
                if own:
                    ok &= A["id"][some][:, None] < B["id"][ib][None, :]
                i, j = np.nonzero(ok)
                if len(i):
                    out.append((some[i], ib[j], ones[i, j]))
    return out


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, dict, bool]]:
    """(list, left block, right block, whether they are one) of the tiles that hold sets of different components."""
    names = ("tok", "low", "i", "kind", "j")

    def tables() -> Iterator[pa.Table]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if kept is None else pa.concat_tables([kept, table])).combine_chunks()
            starts = edges(table)
            kept = table.slice(int(starts[-1])) if len(starts) else table
            if len(starts) > 1:
                yield table.slice(0, int(starts[-1]))
        if kept is not None and kept.num_rows:
            yield kept

    def edges(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[:1] = True
        for c in names:
            x = table.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(new)

    for table in tables():
        starts = edges(table)
        x = {c: table.column(c).to_numpy() for c in ("tok", "kind", "side", "id", "n", "comp")}
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
            comp = x["comp"][lo:hi]
            if hi - lo < 2 or comp.min() == comp.max():
                continue
            rows = table.slice(lo, hi - lo)
            wide = {c: rows.column(c).to_pylist() for c in rows.column_names if c in ("sig", "hashes", "toks")}

            def cut(at: np.ndarray, lo: int = lo, wide: dict = wide) -> dict:
                return {c: x[c][lo + at] for c in ("id", "n", "comp")} | {c: [v[k] for k in at] for c, v in wide.items()}

            side = x["side"][lo:hi]
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            one = x["kind"][lo] == 0 and not len(right)
            if one or len(left) and len(right):
                A = cut(left)
                yield int(x["tok"][lo]), A, A if one else cut(right), one


def _best_rows(t: int):
    """Candidate pairs (a, b): of each set the closest in a tile that passes; and where sets have any (a, tok)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tok, A, B, one in _tiled(batches):
            found = _block_pairs(A, B, one, t)
            if found:
                i, j, ones = (np.concatenate([f[k] for f in found]) for k in range(3))
                order = np.argsort(ones, kind="stable")
                a, b = A["id"][i[order]], B["id"][j[order]]
                _, first = np.unique(a, return_index=True)
                live = np.unique(np.concatenate([a, b]))
                pairs = [pa.array(np.minimum(a[first], b[first])), pa.array(np.maximum(a[first], b[first])), pa.nulls(len(first), pa.int64())]
                yield pa.RecordBatch.from_arrays(pairs, names=["a", "b", "tok"])
                yield pa.RecordBatch.from_arrays([pa.array(live), pa.nulls(len(live), pa.int64()), pa.array(np.full(len(live), tok, np.int64))], names=["a", "b", "tok"])
        give_back()

    return rows


def _link_rows(t: int):
    """Links (a, b) that join different components, at most one fewer than a tile has sets: every pair that passes the bit
    count is intersected, in the first of the lists that the two share, unless links already lead from one to the other."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tok, A, B, one in _tiled(batches):
            up: dict[int, int] = {}

            def top(x: int, up: dict[int, int] = up) -> int:
                while (y := up.get(x, x)) != x:
                    x = y
                return x

            before = [[{k for k in toks if k < tok} for toks in X["toks"]] for X in ((A,) if one else (A, B))]
            arrays = [[np.frombuffer(h, np.uint64) for h in X["hashes"]] for X in ((A,) if one else (A, B))]
            links = []
            found = _block_pairs(A, B, one, t)
            if found:
                i, j, ones = (np.concatenate([f[k] for f in found]) for k in range(3))
                for k in np.argsort(ones, kind="stable").tolist():
                    p, q = int(i[k]), int(j[k])
                    x, y = top(int(A["comp"][p])), top(int(B["comp"][q]))
                    if x != y and before[0][p].isdisjoint(before[-1][q]) and similar(arrays[0][p], arrays[-1][q], t):
                        up[max(x, y)] = min(x, y)
                        links.append((int(A["id"][p]), int(B["id"][q])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())], names=["a", "b"])
        give_back()

    return rows


def _passing_pairs(t: int):
    """Keeps the pairs (a, n_a, sig_a, b, n_b, sig_b) that pass the bit count."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, x, n_b, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "sig_a", "n_b", "sig_b")), strict=True):
                bits = min(len(x), len(y)) * 8
                ones = _ones(_stacked([x], bits), _stacked([y], bits))
                keep.append(bool(passing(np.array([n_a]), np.array([n_b]), ones, t)[0, 0]))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return rows


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, name_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id that links lead to)."""
    found = _near(docs, id_col, text_col, words, percent, name_bits=name_bits)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id")


def _near(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, keep: tuple[str, ...] = (), name_bits: int = 64) -> DataFrame:
    """id, n_shingles, component_id, root (the component's name), and the columns ``keep`` as _1, _2 and so on."""
    small_batches(docs.sparkSession)
    t = percent
    names = ["id", *(f"_{i + 1}" for i in range(len(keep)))]
    base = docs.select(F.col(id_col).alias("id"), *(F.col(c).alias(x) for c, x in zip(keep, names[1:], strict=True)), F.col(text_col).alias("text"))
    sets, own, naming = _named_sets(base, words, names, name_bits)
    shingles = own.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    # one text of each set: others that pass the gate change no result
    one_each = member_gate(base.select("id", "text"), own.select(F.col("low").alias("id")), ["id"], bits=24)
    firsts = settle(first_hashes(one_each, shingles, words, t, naming).dropDuplicates(["tok", "rep"]))
    often = firsts.groupBy("tok").agg(F.count("*").alias("many"), F.max("first").alias("first")).where("many > 1 AND first").select(F.expr("tok ^ 0").alias("tok"))
    shared = settle(firsts.select("tok", "rep", "n").join(often, "tok", "left_semi"))
    # of lists with the same members one stays
    lists = shared.groupBy("tok").agg(F.count("*").alias("many"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"))
    lists = lists.groupBy("many", "x", "y").agg(F.min("tok").alias("tok")).select("tok")
    met = settle(shared.join(settle(lists), "tok", "left_semi"))
    full = settle(_full_sets(base, own, met.select("rep").distinct(), words, naming))
    sig_of = full.select(F.col("rep").alias("id"), "n", "sig")

    # round 1: of the sets that share most of their hashes in each list (of near copies, the original), the one that
    # a set meets most often, if it passes
    part = shared.groupBy("rep", "n").agg((F.count("*") / (F.first("n") * (1 - t / 100) + 1)).alias("part"))
    rated = settle(met.join(part.select(F.expr("rep ^ 0").alias("rep"), "part"), "rep"))
    heads = rated.groupBy("tok").agg(F.max(F.struct(F.round("part", 2).alias("part"), (-F.col("n")).alias("n"), (-F.col("rep")).alias("rep"))).alias("h")).select(F.expr("tok ^ 0").alias("tok"), (-F.col("h.rep")).alias("first"))
    meets = rated.join(heads, "tok").where("rep <> first").groupBy("rep", "first").agg(F.count("*").alias("c"))
    once = meets.groupBy("rep").agg(F.max_by("first", F.struct("c", "first")).alias("first"))
    one = once.join(sig_of.select(F.col("id").alias("rep"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "rep").join(sig_of.select(F.col("id").alias("first"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "first")
    near = one.withColumnsRenamed({"rep": "a", "first": "b"}).mapInArrow(_passing_pairs(t), "a long, b long")
    links = _verified(full, near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), t)
    comps = settle(components(links))

    # further rounds: each set with its best partner of another component, as long as that gives links. A set without
    # a partner that passes in a list will never have one there
    while True:
        found = settle(_tiles(_open_lists(met, comps, t), sig_of.select("id", "sig")).mapInArrow(_best_rows(t), "a long, b long, tok long"))
        if found.isEmpty():
            break
        new = _verified(full, found.where("tok IS NULL").select("a", "b").distinct(), t)
        gain, before = new.count(), links.count()
        if gain:
            links = settle(links.unionByName(new))
            comps = settle(components(links))
        met = settle(met.join(found.where("tok IS NOT NULL").select("tok", F.col("a").alias("rep")).distinct(), ["tok", "rep"], "left_semi"))
        if gain * 50 <= before:
            # the last one: every pair that is left
            toks = settle(met.groupBy("rep").agg(F.collect_list("tok").alias("toks")))  # no more than a set has first hashes
            wide = full.select(F.col("rep").alias("id"), "sig", "hashes").join(toks.select(F.col("rep").alias("id"), "toks"), "id")
            links = settle(links.unionByName(_tiles(_open_lists(met, comps, t), settle(wide)).mapInArrow(_link_rows(t), "a long, b long")))
            comps = settle(components(links))
            break

    tops = own.select("rep", "low").join(comps.select(F.col("node").alias("rep"), "root"), "rep", "left").select("rep", "low", F.coalesce("root", "rep").alias("root"))
    lows = tops.groupBy("root").agg(F.min("low").alias("component_id"))
    groups = settle(tops.join(lows, "root").select("rep", "component_id", "root"))
    for table in (own, firsts, shared, met, rated, full, links, comps):
        discard(table)
    out = sets.join(groups, "rep", "left")
    linked = F.when(F.col("n") == 0, F.col("id")).when(F.col("id").isNotNull(), F.col("component_id"))
    return out.select("id", F.col("n").alias("n_shingles"), linked.alias("component_id"), "root", *names[1:])


def _open_lists(met: DataFrame, comps: DataFrame, t: int) -> DataFrame:
    """tok, rep, n, comp, band and main (whether comp is that of most sets of the list) of the lists that hold sets of different
    components."""
    now = met.join(comps.select(F.col("node").alias("rep"), "root"), "rep", "left").select("tok", "rep", "n", F.coalesce("root", "rep").alias("comp"))
    now = settle(now.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(float(-np.log(t / 100.0 - 1e-9)))).cast("int")))
    each = now.groupBy("tok", "comp").agg(F.count("*").alias("many"))
    mixed = each.groupBy("tok").agg(F.count("*").alias("comps"), F.sum("many").alias("all"), F.max(F.struct("many", "comp")).alias("top")).where("comps > 1")
    mixed = settle(mixed.select(F.expr("tok ^ 0").alias("tok"), F.when(F.col("top.many") * 2 > F.col("all"), F.col("top.comp")).alias("top")))
    return settle(now.join(mixed, "tok").select("tok", "rep", "n", "comp", "band", F.col("comp").eqNullSafe(F.col("top")).alias("main")))


def _tiles(rows: DataFrame, of_sets: DataFrame) -> DataFrame:
    """The lists ``rows`` (tok, rep, n, comp, band, main) as tiles, with what ``of_sets`` (id, ...) says of each set, sorted by tile.

    Sets of a list's main component needn't meet each other: the other ones meet each other and them. A long list of copies that
    are linked already thus costs rows in proportion to its length, not to its square."""
    blocks = lambda role: F.greatest(F.ceil(F.count_if(role) / BLOCK), F.ceil(F.sum(F.when(role, F.col("n")).otherwise(0)) / BLOCK_HASHES)).cast("int")
    size = settle(rows.groupBy("tok", "band").agg(blocks(F.col("main")).alias("m"), blocks(~F.col("main")).alias("o")))
    beside = lambda d, end: size.select("tok", (F.col("band") - d).alias("band"), F.col("m").alias(f"m_{end}"), F.col("o").alias(f"o_{end}"))
    # a table of its own, so that both sides of the next join are read as they are and a hot list can be split
    size = size.join(beside(1, "up"), ["tok", "band"], "left").join(beside(-1, "down"), ["tok", "band"], "left")
    size = settle(size.na.fill(0, ["m_up", "o_up", "m_down", "o_down"]))
    placed = rows.join(size, ["tok", "band"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.greatest(F.when(F.col("main"), F.col("m")).otherwise(F.col("o")), F.lit(1))).cast("int"))
    # a tile is (list, lower or main band, block in it, kind, block of the other side); kinds: 0 others of a band, 1 others of
    # neighbouring bands, 2 to 4 a main band with others of the band below, the same, and the one above
    tile = lambda low, i, kind, j, side: F.struct(low.alias("low"), i.alias("i"), F.lit(kind).alias("kind"), j.alias("j"), (F.lit(side) if isinstance(side, int) else side).alias("side"))
    none = F.array().cast("array<struct<low:int,i:int,kind:int,j:int,side:int>>")
    over = lambda many, make: F.when(F.col(many) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col(many), F.lit(1)) - 1), make)).otherwise(none)
    band, block = F.col("band"), F.col("block")
    same = over("o", lambda j: tile(band, F.least(block, j), 0, F.greatest(block, j), F.when(block <= j, 0).otherwise(1)))
    up = over("o_up", lambda j: tile(band, block, 1, j, 0))
    down = over("o_down", lambda i: tile(band - 1, i, 1, block, 1))
    of = lambda kind: lambda j: tile(band, block, kind, j, 0)
    to = lambda kind, by: lambda i: tile(band + by, i, kind, block, 1)
    of_main = [over(many, of(kind)) for kind, many in ((2, "o_down"), (3, "o"), (4, "o_up"))]
    to_main = [over(many, to(kind, by)) for kind, many, by in ((2, "m_up", 1), (3, "m", 0), (4, "m_down", -1))]
    tiles = F.when(F.col("main"), F.concat(*of_main)).otherwise(F.concat(same, up, down, *to_main))
    key = ["tok", "low", "i", "kind", "j"]
    dealt = placed.withColumn("tile", F.explode(tiles)).select("tok", "tile.low", "tile.i", "tile.kind", "tile.j", "tile.side", F.col("rep").alias("id"), "n", "comp")
    return dealt.join(of_sets, "id").select(*key, "side", "id", "n", "comp", *of_sets.columns[1:]).repartition(*key).sortWithinPartitions(*key)


#: Sets up to which the ids of their texts are broadcast to the scan; 8 bytes each.
FEW_SETS = 1 << 17


def _full_sets(base: DataFrame, own: DataFrame, some: DataFrame, words: int, naming: Naming) -> DataFrame:
    """rep, n, sig and hashes of the sets ``some``, made again from the texts; the counted list of their ids is broadcast
    where it is short, else a bit map of fixed size leaves out most other texts. Both ways end in the same join."""
    chosen = settle(own.join(some, "rep", "left_semi").select("rep", F.col("low").alias("id")))
    if chosen.count() <= FEW_SETS:
        texts = base.join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi")
    else:
        texts = member_gate(base, chosen.select("id"), ["id"], bits=24)
    made = texts.select("text").mapInArrow(_full_rows(words, naming), "rep long, n long, sig binary, hashes binary")
    return made.join(chosen.select("rep"), "rep", "left_semi").dropDuplicates(["rep"])


def _verified(full: DataFrame, pairs: DataFrame, t: int) -> DataFrame:
    """The pairs that are links, by exact intersection of the two sorted arrays."""
    one = lambda x: full.select(F.col("rep").alias(x), F.col("hashes").alias(f"set_{x}"))
    return settle(settle(pairs).join(one("a"), "a").join(one("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(_overlaps(t), "a long, b long"))


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_components(read_table(spark, sf_dir, "documents"), words=4, percent=85)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Of each component one row with the smallest id, with all its columns. Rows without an id stay, and so do rows
    whose sets are empty; of rows that repeat that id the one with the smallest hash of its text stays, once."""
    (mark,) = fresh(docs, "_text_hash")
    hashed = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    found = settle(_near(hashed, id_col, text_col, words, percent, (mark,)).where("n_shingles > 0 AND id IS NOT NULL").select("id", "component_id", "root", F.col("_1").alias("h")))
    top = settle(found.where("id = component_id").groupBy("root", "id").agg(F.min("h").alias("h"), F.count("*").alias("n")))
    gone = settle(found.join(top.select("root", "id", "h"), ["root", "id", "h"], "left_anti").select("id", "h").distinct())
    rest = without(hashed, gone.select(F.col("id").alias(id_col), F.col("h").alias(mark)), [id_col, mark])
    if not top.where("n > 1").isEmpty():  # rows that repeat whole
        again = settle(found.groupBy("id", "h").agg(F.count("*").alias("n")).where("n > 1").join(top.select("id", "h"), ["id", "h"], "left_semi").select(F.col("id").alias(id_col), F.col("h").alias(mark)))
        alike = hashed.join(again, [id_col, mark], "left_semi").dropDuplicates([id_col, mark])
        rest = without(rest, again, [id_col, mark]).unionByName(alike.select(*rest.columns))
    return rest.select(*docs.columns)
