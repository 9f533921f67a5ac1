"""Exact Jaccard join of word n-gram sets: size-banded tiles, bitmap signatures, sorted-array intersection.

Documents with the same set form a class, and only classes are compared. With J >= 0.8 the overlap of a set of n is at
least o = ceil(0.8 n) with any partner, so of the n - o + k smallest elements (by fingerprint) two linked sets share k.
k is 1 + n / 8 here:

1. elements of these prefixes that occur in one class only are dropped; a class whose prefix shares fewer elements than
   any partner would need is out. Of the others' shared elements the k - 1 most frequent are dropped as well.
2. Each class is compared with two likely partners: the one that most often precedes it among the classes of an element,
   ordered by size, and the one that most often leads them. Exact intersections give links and first components.
3. Components that still share an element form a family, and the classes by which they do are compared in tiles: those
   of one size band (or of two neighbouring bands), in blocks of about `TILE`. A bitmap of the hashed set, whose differing
   bits count no more than the differing elements, bounds the overlap from above; pairs that could reach the threshold
   go to the exact intersection, unless links of the tile have joined their components by then.

So no link between different components is missed, and pairs inside a component are not enumerated.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.blocks import (
    NULL_ID,
    SMALL_BLOCK_BYTES,
    Block,
    append_columns,
    blocks,
    mix,
    per_document,
    prefix,
    signed,
    span,
    word_hashes,
    words,
)
from attestry.llm.components import components
from attestry.llm.repeats import ROW, keyed, numbered
from attestry.llm.store import stored

WORDS = 5
PERCENT = 80
TILE = 512
#: Elements in a block of a tile, about; a set larger than this is a block of its own.
TILE_ELEMENTS = 1 << 18
BROADCAST_KEYS = 100_000
_SALT = 512


def shingle_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram fingerprints of each document, ascending, and the documents' offsets in them.

    A document of fewer words is one n-gram of all of them; one without words has none.
    """
    found = words(block)
    sums = prefix(word_hashes(block, found, 29, lower=True))
    n = found.counts
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    doc = per_document(count)
    start = found.offsets[:-1][doc] + np.arange(len(doc)) - np.r_[0, np.cumsum(count)][doc]
    length = np.minimum(n, size)[doc]
    grams = span(sums, start, start + length) ^ length.astype(np.uint64)
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    return grams[new], np.r_[0, np.cumsum(np.bincount(doc[new], minlength=len(n)))]


def _class_ids(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A fingerprint of each set that does not depend on order."""
    total = np.r_[np.uint64(0), np.cumsum(mix(grams), dtype=np.uint64)]
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64))


def _least_overlap(n, percent: int):
    return (percent * n + 99) // 100


def _needed(n):
    """k of the module's description."""
    return n // 8 + 1


def _classes(docs: DataFrame, size: int) -> DataFrame:
    """(doc, class, n) of every document."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            ids, counts = [], []
            for block in blocks(batch.column(batch.schema.get_field_index("text")), SMALL_BLOCK_BYTES):
                grams, offsets = shingle_sets(block, size)
                ids.append(_class_ids(grams, offsets))
                counts.append(np.diff(offsets))
            return {"class": pa.array(signed(np.concatenate(ids))), "n": pa.array(np.concatenate(counts))}

        return work

    return append_columns(docs, {"class": "long", "n": "long"}, make, ("text",))


def _prefixes(docs: DataFrame, size: int, percent: int, whole: bool) -> DataFrame:
    """Prefix elements of the classes, once for each class and task: (gram), or (gram, class, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for block in blocks(batch.column(0), SMALL_BLOCK_BYTES):
                grams, offsets = shingle_sets(block, size)
                ids, n = _class_ids(grams, offsets), np.diff(offsets)
                keep = np.zeros(len(n), dtype=bool)
                for i, x in enumerate(ids.tolist()):
                    if n[i] and x not in seen:
                        seen.add(x)
                        keep[i] = True
                count = np.where(keep, np.minimum(n, n - _least_overlap(n, percent) + _needed(n)), 0)
                doc = per_document(count)
                at = offsets[:-1][doc] + np.arange(len(doc)) - np.r_[0, np.cumsum(count)][doc]
                columns = {"gram": pa.array(signed(grams[at]))}
                if whole:
                    columns |= {"class": pa.array(signed(ids[doc])), "n": pa.array(n[doc].astype(np.int32))}
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select("text").mapInArrow(run, "gram long" + ", class long, n int" * whole)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(class, n, held): the sorted sets as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0), SMALL_BLOCK_BYTES):
                grams, offsets = shingle_sets(block, size)
                raw = grams.tobytes()
                yield pa.RecordBatch.from_pydict(
                    {
                        "class": pa.array(signed(_class_ids(grams, offsets))),
                        "n": pa.array(np.diff(offsets).astype(np.int32)),
                        "held": pa.array(
                            [raw[8 * a : 8 * b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary()
                        ),
                    }
                )

    return docs.select("text").mapInArrow(run, "class long, n int, held binary")


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of classes whose sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("one"), batch.column("two"), strict=True):
                a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                common = _overlap(a, b) if len(a) <= len(b) else _overlap(b, a)
                ok.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))

    one = sets.select(F.col("class").alias("u"), F.col("held").alias("one"))
    two = sets.select(F.col("class").alias("v"), F.col("held").alias("two"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "one", "two").mapInArrow(run, "u long, v long")


def _candidates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(gram, class, n, df) of step 1."""
    shared = _prefixes(docs, size, percent, False).groupBy("gram").count().filter("count > 1").select("gram")
    rows = _prefixes(docs, size, percent, True).join(shared, "gram", "left_semi").distinct()
    rows = stored(rows, "prefixes")
    df = rows.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    rows = rows.join(df, "gram")
    own = Window.partitionBy("class")
    least = F.floor(F.floor((percent * F.col("n") + 99) / 100) / 8) + 1
    ranked = rows.withColumns(
        {
            "held": F.count("*").over(own),
            "rank": F.row_number().over(own.orderBy("df", "gram")),
            "least": least,
        }
    )
    return ranked.filter("held >= least AND rank <= held - least + 1").select("gram", "class", "n", "df")


def _partners(rows: DataFrame) -> DataFrame:
    """Two likely partners of each class (step 2). Frequent elements are cut in groups by the hash of the class."""
    group = F.pmod(F.xxhash64("class"), F.ceil(F.col("df") / _SALT))
    along = Window.partitionBy("gram", "group").orderBy("n", "class")
    placed = rows.withColumn("group", group).select(
        "class",
        F.lag("class").over(along).alias("before"),
        F.first("class").over(along).alias("lead"),
    )
    found = None
    for name in ("before", "lead"):
        votes = placed.filter(f"{name} <> class").groupBy("class", F.col(name).alias("other")).count()
        best = votes.groupBy("class").agg(F.max_by("other", F.struct("count", "other")).alias("other"))
        found = best if found is None else found.unionByName(best)
    return _ordered(found.select(F.col("class").alias("u"), F.col("other").alias("v")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def bitmap(grams: np.ndarray) -> np.ndarray:
    """The hashed set in 512 to 65536 bits, eight or more for each element of sets up to 8192."""
    bits = 1 << min(16, max(9, int(len(grams) - 1).bit_length() + 3))
    out = np.zeros(bits, dtype=bool)
    out[(grams & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").view(np.uint64)


def may_link(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose overlap may reach the threshold, judged by size and bit counts alone; most alike first."""
    maps = [bitmap(x) for x in sets]
    n = np.array([len(x) for x in sets], np.int64)
    # A smaller bitmap is the larger one folded.
    least = min(map(len, maps))
    table = np.stack([np.bitwise_or.reduce(x.reshape(-1, least), axis=0) for x in maps])
    i, j = np.triu_indices(len(n), 1)
    fits = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
    i, j = i[fits], j[fits]
    differ = np.empty(len(i), np.int64)
    step = max(1, (1 << 19) // least)
    for low in range(0, len(i), step):
        part = slice(low, low + step)
        differ[part] = np.bitwise_count(table[i[part]] ^ table[j[part]]).sum(axis=1, dtype=np.int64)
    # overlap <= (n + m - differ) / 2, and the threshold asks 100 * overlap >= percent * (n + m - overlap)
    bound = (n[i] + n[j] - differ) // 2
    ok = np.flatnonzero(100 * bound >= percent * (n[i] + n[j] - bound))
    ok = ok[np.argsort(differ[ok] / (n[i] + n[j])[ok], kind="stable")]
    return i[ok], j[ok]


def _tile_links(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links between (class, root, set) rows of a tile that join different components, each join once."""
    sets = [np.frombuffer(x[2], np.uint64) for x in rows]
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in may_link(sets, percent)), strict=True):
        a, b = top(rows[i][1]), top(rows[j][1])
        if a != b:
            one, two = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
            common = _overlap(one, two)
            if 100 * common >= percent * (len(one) + len(two) - common):
                above[a] = b
                out.append((rows[i][0], rows[j][0]))
    return out


def _between(rows: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between different components (step 3)."""
    named = rows.join(roots, rows["class"] == roots["node"], "left").select(
        "gram", "class", "n", F.coalesce("root", "class").alias("root")
    )
    open_grams = named.groupBy("gram").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    named = stored(named.join(open_grams.select("gram", "a"), "gram"), "open")
    families = components(named.select(F.col("root").alias("u"), F.col("a").alias("v")))
    step = math.log(100 / percent) if percent < 100 else 1.0
    members = (
        named.select("class", "n", "root")
        .distinct()
        .join(families.select(F.col("node").alias("root"), F.col("root").alias("family")), "root")
        .withColumn("band", F.floor(F.log("n") / F.lit(step)).cast("int"))
    )
    members = stored(members, "members")
    blocks_of = members.groupBy("family", "band").agg(
        F.ceil(F.greatest(F.count("*") / TILE, F.sum("n") / TILE_ELEMENTS)).cast("int").alias("k")
    )
    near = None
    for shift, name in ((0, "own"), (1, "up"), (-1, "down")):
        part = blocks_of.select("family", (F.col("band") - shift).alias("band"), F.col("k").alias(name))
        near = part if near is None else near.join(part, ["family", "band"], "left")
    placed = members.join(near, ["family", "band"]).withColumn(
        "s", F.pmod(F.xxhash64("class"), F.col("own")).cast("int")
    )

    def tiles(count: Column, make: Callable[[Column], Column]) -> Column:
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), make)).otherwise(
            F.array().cast("array<struct<band:int,i:int,cross:boolean,j:int>>")
        )

    def tile(band: Column, i: Column, cross: bool, j: Column) -> Column:
        return F.struct(band.alias("band"), i.alias("i"), F.lit(cross).alias("cross"), j.alias("j"))

    band, s = F.col("band"), F.col("s")
    every = F.concat(
        tiles(F.col("own"), lambda t: tile(band, F.least(s, t), False, F.greatest(s, t))),
        tiles(F.coalesce("up", F.lit(0)), lambda t: tile(band, s, True, t)),
        tiles(F.coalesce("down", F.lit(0)), lambda t: tile(band - 1, t, True, s)),
    )
    dealt = placed.select("family", "class", "root", F.explode(every).alias("tile"))
    # A tile of one component has nothing to compare.
    alive = dealt.groupBy("family", "tile").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    dealt = dealt.join(alive.select("family", "tile"), ["family", "tile"], "left_semi")
    ready = (
        dealt.select(F.xxhash64("family", "tile").alias("tile"), "class", "root")
        .join(sets.select("class", "held"), "class")
        .repartition("tile")
        .sortWithinPartitions("tile", "class")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            out = []
            columns = (batch.column(x).to_pylist() for x in ("class", "root", "held", "tile"))
            for row in zip(*columns, strict=True):
                if row[3] != now:
                    out += _tile_links(held, percent) if held else []
                    now, held = row[3], []
                held.append(row)
            if out:
                yield _pair_batch(out)
        if held and (out := _tile_links(held, percent)):
            yield _pair_batch(out)

    return ready.mapInArrow(compare, "u long, v long")


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*pairs, strict=True)], names=["u", "v"])


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id), a row for each row of `docs`.

    `component_id` is the smallest key reachable by links. Null texts and texts without words have no set and link with
    nothing. A null key is smaller than all others, and so may be the id of a component. Rows that share a key are
    documents of their own with the same name.
    """
    found = _led(keyed(docs, key, text), size, percent)
    shown = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return found.select(
        shown("doc").alias(key), F.col("n").alias("n_shingles"), shown("component").alias("component_id")
    )


def _led(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """`rows` without the text, with `n` and the smallest document of the component, by key; of numbered rows, by key and
    number, (doc, row)."""
    name = "row" if "row" in rows.columns else "doc"
    order = F.struct("doc", "row") if name == "row" else F.col("doc")
    base = stored(_classes(rows, size), "classes")
    candidates = stored(_candidates(rows, size, percent), "candidates")
    firsts = base.filter("n > 0").groupBy("class").agg(F.min(order).alias("first"))
    wanted = stored(firsts.join(candidates.select("class").distinct(), "class", "left_semi"), "wanted")
    ids = wanted.select(F.col(f"first.{name}" if name == "row" else "first").alias(name))
    # Broadcast behind a count; beyond it the texts are shuffled.
    ids = F.broadcast(ids) if wanted.count() <= BROADCAST_KEYS else ids
    sets = _sets(rows.join(ids, name, "left_semi"), size).dropDuplicates(["class"])
    sets = stored(sets.join(wanted.select("class"), "class", "left_semi"), "sets")
    links = stored(_links(_partners(candidates), sets, percent), "links")
    roots = components(links)
    more = stored(_between(candidates, roots, sets, percent), "links")
    roots = stored(components(links.unionByName(more)), "roots")
    classes = firsts.join(roots, firsts["class"] == roots["node"], "left").select(
        "class", "first", F.coalesce("root", "class").alias("root")
    )
    least = classes.groupBy("root").agg(F.min("first").alias("component"))
    classes = classes.join(least, "root").select("class", "component")
    names = [x for x in rows.columns if x != "text"]
    with_words = base.filter("n > 0").join(classes, "class").select(*names, "n", "component")
    without = base.filter("n = 0").select(*names, "n", order.alias("component"))
    return with_words.unionByName(without)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows of `docs` that lead their component: the smallest key of each. Rows without words link with nothing and stay.

    Of rows with one key, null or not, the first of the scan leads. Of repeated rows (equal key and text, null or not) one
    stays, also of those without words.
    """
    held = numbered(docs)
    found = _led(keyed(held, key, text), size, percent)
    gone = stored(found.filter("row != component.row").select(F.col("row").alias(ROW)), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone
    left = held.join(gone, ROW, "left_anti").drop(ROW)
    return left.dropDuplicates([key, text])
