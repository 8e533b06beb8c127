"""SimHash near-dedup (operator 7): exact tiled comparison of fingerprints.

A text's fingerprint is the bitwise majority over the 64-bit hashes of its
shingles. Fingerprints link at ``radius`` or fewer differing bits, and a
component is what links reach.

1. Fingerprints: one pass over the texts (``mapInArrow``), 8 bytes a document.
2. Equal fingerprints fall together in an aggregate, so a group of copies of
   any size is one row from here on.
3. Tiles: the population counts of the four 16-bit quarters name a
   fingerprint's tile. If the counts of two tiles differ by more than the
   radius in sum, no pair of theirs can link, and the pair of tiles is
   skipped. A fingerprint is home in its own tile and visits those of the
   other tiles within reach that come after it. Tiles of over ``tile_rows``
   rows are cut by hash; their parts visit one another.
4. Comparison: the rows of a part come sorted, homes first; homes (bounded)
   are held as a numpy array, visitors stream past. Exclusive-or and bit counts
   give the links, a local merge keeps at most one edge for each row, so no
   group emits its pairs.
5. ``components`` joins the edges; every document gets the least document id.

The comparison inside tiles stays quadratic in the *different* fingerprints,
as the method has it; the tiles leave about 2 % of the pairs.

Defined cases: null and empty texts (and texts of white space) have
fingerprint zero, linked like any other; fewer than ``shingle`` words are one
shingle; repeated rows each return a row; a null doc_id returns a row but is
nobody's component id (the component id is null if no member has an id); an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kestrel.llm.common import U64, slices, text_bytes
from kestrel.llm.components import components
from kestrel.session import shared_dir

SHINGLE = 3
RADIUS = 2
TILE_ROWS = 4096
SEED = 42

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACE = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit majority fingerprint of one UTF-8 text."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # ASCII letters and ASCII white space only, as bytes
    n = max(1, len(words) - shingle + 1) if words else 0
    if not n:
        return 0
    parts = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    h = np.fromiter((xxh64_intdigest(b" ".join(p), SEED) for p in parts), U64, n)
    ones = np.bincount((h.astype("<u8").view(np.uint8).reshape(-1, 8) + _PLACE).ravel(), minlength=2048).reshape(8, 256)
    votes = np.einsum("pb,bk->pk", ones, _BITS).ravel()
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: Sequence[Column] = ()) -> DataFrame:
    """(doc_id, the columns ``carry``, fp long): the fingerprint's 64 bits as a signed number."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").cast("string").alias("text"))
    schema = StructType([f for f in rows.schema if f.name != "text"]).add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                data, off = text_bytes(part.column("text"))
                raw = data.tobytes()
                fp = np.array([fingerprint(raw[a:b], shingle) for a, b in zip(off[:-1], off[1:], strict=True)], U64).view(np.int64)
                yield pa.record_batch([*(part.column(c) for c in schema.names[:-1]), pa.array(fp)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _quarter(col, i: int):
    return F.bit_count(F.shiftrightunsigned(col, 16 * i).bitwiseAND(F.lit(0xFFFF)))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least labels after joining a[i] with b[i]; labels are places in ``label``."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]
    return label


def _compare(home: np.ndarray, label: np.ndarray, other: np.ndarray | None, radius: int):
    """New labels of the homes, and those of the others (places in home + other); ``other`` None: the homes themselves."""
    n = len(home)
    across = home if other is None else other
    base = 0 if other is None else n
    label = np.r_[label, np.arange(n, n + len(across))] if base else label
    step = max(1, 1_000_000 // max(1, len(across)))
    for x in range(0, n, step):
        i, j = np.nonzero(np.bitwise_count(home[x: x + step, None] ^ across[None, :]) <= radius)
        label = _merge(label, i + x, j + base)
    return label


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, home, label = None, np.zeros(0, U64), np.zeros(0, np.int64)
        for batch in batches:
            tile, sub, role = (batch.column(c).to_numpy() for c in ("tile", "sub", "role"))
            fp = batch.column("fp").to_numpy().view(U64)
            edge = np.flatnonzero((tile[1:] != tile[:-1]) | (sub[1:] != sub[:-1]) | (role[1:] != role[:-1])) + 1
            left, right = [], []
            for x, y in zip(np.r_[0, edge], np.r_[edge, len(fp)], strict=True):
                if key != (tile[x], sub[x]):
                    key, home, label = (tile[x], sub[x]), np.zeros(0, U64), np.zeros(0, np.int64)
                got = fp[x:y]
                if role[x] == 0:  # more homes (a group may come in several batches)
                    both = _compare(home, label, got, radius) if len(home) else np.arange(len(got))
                    old, home = label, np.r_[home, got]
                    label = both if len(both) == len(home) else np.r_[label, np.arange(len(label), len(home))]
                    inner = _compare(got, np.arange(len(got)), None, radius)
                    label = _merge(label, len(old) + np.arange(len(got)), len(old) + inner)
                    moved = np.flatnonzero(label != np.r_[old, np.arange(len(old), len(home))])
                    left.append(home[moved])
                    right.append(home[label[moved]])
                elif len(home):
                    both = _compare(home, label, got, radius)
                    seen = np.flatnonzero(both[len(home):] < len(home))
                    moved = np.flatnonzero(both[: len(home)] != label)
                    left += [got[seen], home[moved]]
                    right += [home[both[len(home) + seen]], home[both[moved]]]
                    label = both[: len(home)]
            if left:
                yield pa.record_batch([pa.array(np.concatenate(left).view(np.int64)), pa.array(np.concatenate(right).view(np.int64))], names=["u", "v"])

    return run


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (u, v) that connect the distinct ``fp`` values exactly as all links do."""
    steps = sorted(d for d in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, d)) <= radius and d > (0, 0, 0, 0))
    quarters = [_quarter(F.col("fp"), i) for i in range(4)]
    placed = nodes.select("fp", *(q.cast("int").alias(f"q{i}") for i, q in enumerate(quarters)))

    def tile(d):
        p = [F.col(f"q{i}") + F.lit(d[i]) for i in range(4)]
        inside = p[0].between(0, 16) & p[1].between(0, 16) & p[2].between(0, 16) & p[3].between(0, 16)
        return F.when(inside, ((p[0] * 17 + p[1]) * 17 + p[2]) * 17 + p[3])

    placed = placed.select("fp", tile((0,) * 4).alias("tile"), F.array_compact(F.array(*(tile(d) for d in steps))).alias("visits"))
    # one row for each tile: 17 ** 4 = 83,521 at most, whatever the input
    parts = placed.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    own = placed.join(F.broadcast(parts), "tile").select("fp", "tile", part.alias("sub"))
    home = own.select("fp", "tile", "sub", F.lit(0).alias("role"))
    beside = own.where("sub > 0").select("fp", "tile", F.explode(F.sequence(F.lit(0), F.col("sub") - 1)).alias("sub"), F.lit(1).alias("role"))
    away = placed.select("fp", F.explode("visits").alias("tile")).join(F.broadcast(parts), "tile")
    away = away.select("fp", "tile", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sub"), F.lit(1).alias("role"))
    dealt = home.unionAll(beside).unionAll(away).repartition("tile", "sub").sortWithinPartitions("tile", "sub", "role")
    return dealt.mapInArrow(_links(radius), "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``."""
    out = grouped(docs, (), shingle, radius, tile_rows)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def grouped(docs: DataFrame, carry: Sequence[Column], shingle: int = SHINGLE, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(fp, doc_id, the columns ``carry``, root, component_id), one row for each row of ``docs``.

    ``root`` names the component by a fingerprint, so it is there without any id too.
    """
    shared_dir(docs.sparkSession)
    fps = fingerprints(docs, shingle, carry).checkpoint()
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    roots = components(links(nodes, radius, tile_rows))
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = member.groupBy("root").agg(F.min("first").alias("component_id"))
    # checkpointed, so that the join below can split a fingerprint that very many documents share
    member = member.join(least, "root").select("fp", "root", "component_id").checkpoint()
    return fps.join(member, "fp")
